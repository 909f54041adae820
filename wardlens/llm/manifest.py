"""Merkle dataset manifest by nested-interval labels.

Every node of a group's hash tree carries the interval of leaf ranks that it covers.  A node's
ancestors are the nodes whose interval holds its own; they are found by equality of level and of
the bucket that an interval of that level falls into, and then checked for containment.  A node's
sibling is what its parent's interval has beside its own.

Trees are built and joined in bands of ``BAND`` levels: one shuffle gathers the at most 2^BAND
nodes under each node of the band's top, whatever the size of the group, and a path to the root is
the steps inside the band followed by the path of the node at its top.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from wardlens.operators.keys import join_back
from wardlens.operators.sequences import numbered
from wardlens.sources.staging import stage

#: Levels that are built from one shuffle.
BAND = 6

#: The columns of ``documents`` that a leaf covers.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

#: One step of a proof: the side on which the sibling stands and its digest; ``-`` where there is none.
LEFT, RIGHT, ALONE = "l", "r", "-"


def digest(text: Column) -> Column:
    """Lower-case hexadecimal SHA-256 of a text's UTF-8 bytes."""
    return F.sha2(text.cast("binary"), 256)


def leaf_digest(fields: Sequence[str] = FIELDS, changed: Mapping[str, Column] | None = None) -> Column:
    """Digest of a row: each field as byte count, colon and value, ``-`` for NULL.

    ``changed`` gives other values for some fields, to say what a changed row's digest would be.
    """
    changed = changed or {}
    parts = []
    for name in fields:
        text = changed.get(name, F.col(f"`{name}`")).cast("string")
        sized = F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
        parts.append(F.coalesce(sized, F.lit("-")))
    return digest(F.concat(*parts))


def _width(level: int) -> Column:
    return F.lit(1 << level).cast("bigint")


def _bucket(position: Column, level: int | Column) -> Column:
    """The number of the interval of a level that a leaf rank falls into."""
    return F.call_function("shiftright", position, F.lit(level) if isinstance(level, int) else level)


def _text(node: Column) -> Column:
    """A digest kept in 32 bytes as the text it stands for."""
    return F.lower(F.hex(node))


def _pair_digest(nodes: Column) -> Callable[[Column], Column]:
    """The digest of the k-th two of an array of digests, or of the one that is left."""

    def of(k: Column) -> Column:
        pair = F.transform(F.slice(nodes, (k * 2 + 1).cast("int"), F.lit(2)), _text)
        return F.unhex(digest(F.array_join(pair, "")))

    return of


def _band(bottom: DataFrame, level: int) -> DataFrame:
    """All nodes of the levels ``level`` to ``level + BAND`` above the given ones of ``level``.

    ``bottom`` has g, n (leaves of the group), lo and node (32 bytes), for groups of several nodes.
    The result labels each node with its level and interval from lo to before hi.
    """
    packed = (
        bottom.groupBy("g", "n", _bucket(F.col("lo"), level + BAND).alias("f"))
        .agg(F.sort_array(F.collect_list(F.struct("lo", "node"))).alias("nodes"))
        .withColumn("l0", F.col("nodes.node"))
    )
    for j in range(1, BAND + 1):
        below = F.col(f"l{j - 1}")
        last = F.call_function("div", F.size(below) - 1, F.lit(2)).cast("int")
        several = F.col("n") > _width(level + j - 1)
        parents = F.transform(F.sequence(F.lit(0), last), _pair_digest(below))
        empty = F.array().cast("array<binary>")
        packed = packed.withColumn(f"l{j}", F.when(several, parents).otherwise(empty))
    levels = F.array(*[
        F.struct(F.lit(level + j).alias("level"), F.col(f"l{j}").alias("digests")) for j in range(BAND + 1)
    ])
    each = packed.select("g", "n", "f", F.explode(levels).alias("at")).select(
        "g", "n", "f", "at.level", F.posexplode("at.digests").alias("k", "node")
    )
    start = F.col("f") * _width(level + BAND)
    width = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("level"))
    return each.select(
        "g", "n", "level", (start + F.col("k") * width).alias("lo"),
        F.least(F.col("n"), start + (F.col("k") + 1) * width).alias("hi"), "node",
    )


def _steps(nodes: DataFrame, level: int) -> DataFrame:
    """The steps of all nodes below a band's top, per interval ``f`` of the top: g, f and ``steps``.

    Parents are attached by a containment join on level and bucket.  What the parent's interval
    has before or after the child's is the sibling's interval.
    """
    child = nodes.filter(F.col("level") < level + BAND).select(
        "g", (F.col("level") + 1).alias("up"), _bucket(F.col("lo"), F.col("level") + 1).alias("bucket"),
        "lo", "hi", "node",
    )
    parent = nodes.filter(F.col("level") > level).select(
        F.col("g").alias("pg"), F.col("level").alias("pl"),
        _bucket(F.col("lo"), F.col("level")).alias("pb"), F.col("lo").alias("plo"), F.col("hi").alias("phi"),
    )
    inside = (F.col("plo") <= F.col("lo")) & (F.col("hi") <= F.col("phi"))
    owned = child.join(
        parent, (F.col("g") == F.col("pg")) & (F.col("up") == F.col("pl")) & (F.col("bucket") == F.col("pb")) & inside
    )
    beside = Window.partitionBy("g", "up", "bucket").orderBy("lo")
    before, after = F.lag(F.struct("lo", "hi", "node")).over(beside), F.lead(F.struct("lo", "hi", "node")).over(beside)
    owned = owned.withColumn("before", before).withColumn("after", after)
    is_left = (F.col("before.lo") == F.col("plo")) & (F.col("before.hi") == F.col("lo"))
    is_right = (F.col("after.lo") == F.col("hi")) & (F.col("after.hi") == F.col("phi"))
    step = F.struct(
        "up", "lo", "hi",
        F.when(is_left, F.lit(LEFT)).when(is_right, F.lit(RIGHT)).otherwise(F.lit(ALONE)).alias("side"),
        F.when(is_left, F.col("before.node")).when(is_right, F.col("after.node")).alias("other"),
    )
    return owned.groupBy("g", _bucket(F.col("lo"), level + BAND).alias("f")).agg(
        F.sort_array(F.collect_list(step)).alias("steps")
    )


def _path_of(position: Column, steps: Column, rest: Column) -> Column:
    """The path of the node that begins at a rank: the steps of those that hold it, and the rest."""
    held = F.filter(steps, lambda s: (s["lo"] <= position) & (position < s["hi"]))
    none = F.array().cast(_PATH)
    own = F.transform(held, lambda s: F.struct(s["side"].alias("side"), s["other"].alias("other")))
    return F.concat(F.coalesce(own, none), F.coalesce(rest, none))


_PATH = "array<struct<side:string,other:binary>>"


def _paths(leaves: DataFrame) -> tuple[DataFrame | None, DataFrame]:
    """What each leaf needs for its path to its group's root, and the roots.

    ``leaves`` (staged: g, n, lo, node) gives the trees.  The first result has g, f (leaf rank divided
    by 2^BAND), steps and rest, for groups of several leaves (None where there are no such groups);
    the second g and subroot (32 bytes).
    """
    largest = leaves.agg(F.max("n")).first()[0] or 0
    roots = leaves.filter("n = 1").select("g", F.col("node").alias("subroot"))
    bottom = leaves.filter("n > 1").select("g", "n", "lo", "node")
    bands, level = [], 0
    while largest > 1 << level:
        nodes = stage(_band(bottom, level), "tree")
        bands.append(nodes)
        whole = (F.col("lo") == 0) & (F.col("hi") == F.col("n"))
        roots = roots.union(nodes.filter(whole).select("g", "node"))
        level += BAND
        bottom = nodes.filter((F.col("level") == level) & ~whole)
    above = None
    for k in reversed(range(len(bands))):
        level = k * BAND
        steps = _steps(bands[k], level)
        if above is None:
            steps = steps.withColumn("rest", F.array().cast(_PATH))
        else:
            steps = steps.join(above, (F.col("g") == F.col("ug")) & (F.col("f") == F.col("uf")), "left").drop("ug", "uf")
        steps = stage(steps, "steps")
        if k:
            tops = bands[k].filter(F.col("level") == level).select(
                F.col("g").alias("ug"), F.col("lo").alias("ulo"), _bucket(F.col("lo"), level).alias("uf"),
                _bucket(F.col("lo"), level + BAND).alias("in"),
            )
            path = _path_of(F.col("ulo"), F.col("steps"), F.col("rest")).alias("rest")
            above = tops.join(steps, (F.col("ug") == F.col("g")) & (F.col("in") == F.col("f"))).select("ug", "uf", path)
    return (steps if bands else None), roots


def _with_paths(rows: DataFrame, steps: DataFrame | None, g: str, lo: str, out: str) -> DataFrame:
    """Rows with the path of the leaf at rank ``lo`` of group ``g``."""
    if steps is None:
        return rows.withColumn(out, F.array().cast(_PATH))
    named = steps.select(*[F.col(c).alias(f"_m_s_{c}") for c in ("g", "f", "steps", "rest")])
    same = (F.col(g) == F.col("_m_s_g")) & (_bucket(F.col(lo), BAND) == F.col("_m_s_f"))
    path = _path_of(F.col(lo), F.col("_m_s_steps"), F.col("_m_s_rest"))
    return rows.join(named, same, "left").withColumn(out, path).drop(*named.columns)


def prove(leaves: DataFrame, group: str, order: Sequence[str], leaf: str = "leaf") -> DataFrame:
    """Every leaf with its group's root, the root of all groups, and its proof.

    Leaves of a group ascend by ``order`` and then by digest (NULLs first); every two consecutive
    nodes, or the last one alone, become their digest until one remains, the ``subroot``.
    Subroots, ordered by group (NULL first, by UTF-8 bytes), likewise give ``root``.  ``proof`` is an
    array with one step per level from leaf to root: ``l`` or ``r`` and the sibling's digest, or ``-``.

    Adds subroot, root and proof (columns of these names are replaced).  A NULL group is a group
    like any other, repeated rows are leaves of their own, a lone leaf is its own subroot, and an
    empty table gives no rows.  Columns whose names begin with ``_m_`` are not allowed.
    """
    leaves = leaves.drop("subroot", "root", "proof")
    kept = [F.col(f"`{c}`") for c in leaves.columns if c != leaf]
    rows = stage(leaves.select(*kept, F.unhex(F.col(f"`{leaf}`")).alias("_m_node")), "leaves")
    rows = numbered(rows, group, *order, "_m_node", out="_m_no")
    sizes = rows.groupBy(group).agg(F.min("_m_no").alias("_m_first"), F.count(F.lit(1)).alias("_m_n"))
    groups = stage(numbered(sizes, "_m_first", out="_m_g"), "groups")
    rows = join_back(rows, groups, [group])
    rows = stage(rows.withColumn("_m_lo", F.col("_m_no") - F.col("_m_first")), "ranked")
    steps, subroots = _paths(rows.select(
        F.col("_m_g").alias("g"), F.col("_m_n").alias("n"), F.col("_m_lo").alias("lo"), F.col("_m_node").alias("node"),
    ))
    subroots = stage(subroots, "subroots")
    count = F.lit(subroots.count()).cast("bigint")
    top = subroots.select(
        F.lit(0).cast("bigint").alias("g"), count.alias("n"), (F.col("g") - 1).alias("lo"), F.col("subroot").alias("node"),
    )
    top_steps, top_root = _paths(top)
    root = top_root.first()
    heads = subroots.select(
        F.lit(0).cast("bigint").alias("_m_top"), F.col("g").alias("_m_h"), (F.col("g") - 1).alias("_m_hlo"),
        _text(F.col("subroot")).alias("_m_subroot"),
        F.lit(root[1].hex() if root else None).cast("string").alias("_m_root"),
    )
    heads = stage(_with_paths(heads, top_steps, "_m_top", "_m_hlo", "_m_up"), "roots")
    found = _with_paths(rows, steps, "_m_g", "_m_lo", "_m_path").join(heads, F.col("_m_g") == F.col("_m_h"))
    proof = F.transform(
        F.concat("_m_path", "_m_up"), lambda s: F.concat(s["side"], F.coalesce(_text(s["other"]), F.lit("")))
    )
    columns = [_text(F.col("_m_node")).alias(leaf) if c == leaf else F.col(f"`{c}`") for c in leaves.columns]
    return found.select(
        *columns, F.col("_m_subroot").alias("subroot"), F.col("_m_root").alias("root"), proof.alias("proof")
    )


def siblings_digest(proof: Column) -> Column:
    """Digest of a proof's siblings, concatenated from leaf to root."""
    return digest(F.array_join(F.transform(proof, lambda step: step.substr(F.lit(2), F.lit(64))), ""))


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and a proof lead to."""

    def step(node: Column, at: Column) -> Column:
        side, other = at.substr(F.lit(1), F.lit(1)), at.substr(F.lit(2), F.lit(64))
        joined = F.when(side == LEFT, F.concat(other, node)).otherwise(F.concat(node, other))
        return digest(joined)

    return F.aggregate(proof, leaf, step)


def document_proofs(
    docs: DataFrame, id_col: str = "doc_id", group_col: str = "lang", fields: Sequence[str] = FIELDS,
    changed: Mapping[str, Column] | None = None, changed_where: Column | None = None,
) -> DataFrame:
    """The manifest of a document table: id, leaf, claimed, subroot, root and proof per row.

    ``claimed`` is the digest of the row with the values ``changed`` where ``changed_where`` holds, and
    the leaf itself elsewhere (also where it is NULL): what somebody who holds another copy of the
    row would present.  Only the given fields count; other columns, whatever their names, don't.
    """
    leaf = leaf_digest(fields)
    claimed = F.lit(None).cast("string")
    if changed and changed_where is not None:
        claimed = F.when(changed_where, leaf_digest(fields, changed))
    leaves = docs.select(
        F.col(f"`{id_col}`").alias("id"), F.col(f"`{group_col}`").cast("string").alias("grp"),
        leaf.alias("leaf"), claimed.alias("claimed"),
    )
    proofs = prove(leaves, "grp", ["id"]).withColumn("claimed", F.coalesce("claimed", "leaf"))
    return proofs.withColumnRenamed("id", id_col).drop("grp")
