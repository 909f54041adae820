"""Mixing sources to target weights by a low-discrepancy schedule of equal blocks of words."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from wardlens.llm.common import placed_in_keys, quoted, unused, word_count
from wardlens.sources.staging import stage

GOLDEN = (math.sqrt(5) - 1) / 2
#: Rows that one slice of a source's shuffled stream holds at most, on average.
SLICE_ROWS = 1 << 20


def _marked(column: Column) -> Column:
    """A value as text that no other value and no neighbour in a row of them can pass for."""
    text = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def _key(docs: DataFrame, names: Sequence[str], ties: Column | None) -> Column:
    """A digest of the named columns, ``ties`` behind it."""
    digest = F.md5(F.concat(*(_marked(docs[quoted(name)]) for name in names)))
    return digest if ties is None else F.concat(digest, ties)


def targets(
    sizes: DataFrame, weights: Sequence[int] = (1, 2, 3), most: int = 3
) -> DataFrame:
    """Words to take of each source: ``source``, ``source_size``, ``target``.

    ``sizes`` has ``source`` and ``size`` per document.  Sources in order of code points, NULL
    last, have the weights in turn and share the whole size by them; no target exceeds ``most``
    times its source's size, and what that leaves over is shared by weight among the rest.  With
    sources ordered by cap / weight, those below some place keep to their caps, and the common
    level of the rest is the largest that any such place gives.  The windows here run over one
    row per source.
    """
    sums = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    turn = F.row_number().over(Window.partitionBy().orderBy(F.col("source").asc_nulls_last())) - 1
    marks = F.array(*(F.lit(w) for w in weights))
    ranked = sums.withColumn("weight", F.get(marks, (turn % len(weights)).cast("int")))
    cap = most * F.col("source_size")
    by_cap = Window.partitionBy().orderBy(cap / F.col("weight"), F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    capped = F.coalesce(F.sum(cap).over(by_cap.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    open_weight = F.sum("weight").over(by_cap.rowsBetween(0, Window.unboundedFollowing))
    level = (F.sum("source_size").over(everything) - capped) / open_weight
    return (
        ranked.withColumn("level", level)
        .withColumn("level", F.max("level").over(everything))
        .select(
            "source", "source_size",
            F.least(cap.cast("double"), F.col("level") * F.col("weight")).alias("target"),
        )
    )


def schedule(shares: DataFrame, block: int) -> DataFrame:
    """The order in which blocks are read: ``slot``, ``source``, ``block`` (from 0 per source).

    ``shares`` has ``source`` and ``words``.  Slot t of N takes the point (t * g mod N) / N, g
    being the number nearest to N times the golden ratio that has no divisor in common with N, so
    the points fill [0, 1) evenly at every length and each N-th of it exactly once.  A point falls
    to the source whose share of the cumulative number of blocks holds it; a source's slots are
    ranked and read its blocks in turn.
    """
    spark = shares.sparkSession
    blocks = shares.withColumn("blocks", F.ceil(F.col("words") / block).cast("long"))
    upto = Window.partitionBy().orderBy(F.col("source").asc_nulls_last())
    blocks = stage(
        blocks.withColumn("above", F.sum("blocks").over(upto)).withColumn(
            "below", F.col("above") - F.col("blocks")
        ),
        "shares",
    )
    n = blocks.agg(F.sum("blocks")).first()[0] or 0
    step = max(1, round(n * GOLDEN))
    while n and math.gcd(step, n) != 1:
        step += 1
    product = F.col("slot").cast("decimal(19,0)") * F.lit(step).cast("decimal(19,0)")
    slots = spark.range(n).select(F.col("id").alias("slot")).withColumn(
        "point", (product % F.lit(max(n, 1)).cast("decimal(19,0)")).cast("long")
    )
    width = max(1, n // 1000)
    # Shares are cut at every ``width`` points, so that slots find theirs by equality.
    pieces = blocks.filter("blocks > 0").withColumn(
        "piece", F.explode(F.sequence(F.expr(f"below div {width}"), F.expr(f"(above - 1) div {width}")))
    )
    hit = slots.withColumn("piece", F.expr(f"point div {width}")).join(
        pieces.select("piece", "source", "below", "above"), "piece"
    ).filter("point >= below AND point < above").select("slot", "source", "below")
    stretch = max(1, math.isqrt(n))
    ranked = placed_in_keys(
        hit.withColumn("stretch", F.expr(f"slot div {stretch}")),
        ["below"], ["stretch", "slot"], "block", slice_by=F.col("stretch"),
    )
    return ranked.select("slot", "source", "block")


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
    weights: Sequence[int] = (1, 2, 3),
    most: int = 3,
    block: int = 1024,
    ties: Column | None = None,
) -> tuple[DataFrame, DataFrame]:
    """The documents as placed in their source's stream, and the parts that the mix reads.

    A source's documents, shuffled, are one stream of words that starts again when it ends, at
    most ``most`` times; it is read in blocks of ``block`` words up to its target.  The first
    table has per document ``key`` (a digest of id, source and text that also shuffles), the id,
    ``source``, ``size``, ``rank`` (within the source), ``start`` (words before it),
    ``source_size``, ``target``; the second per part read ``slot``, ``source``, ``rank``, ``pass``,
    ``first`` and ``words``: from which of the document's words on, and how many.  ``ties`` is a
    text that follows the digest, to tell apart rows equal in id, source and text.

    NULL sources are a source, empty ones another; NULL texts and texts without a word have size 0 and are not read.
    Repeated rows are documents of their own, side by side.  An empty table gives no rows.
    """
    key = _key(docs, (id_col, source_col, text_col), ties)
    sized = stage(
        docs.select(
            key.alias("key"), F.col(id_col), F.col(source_col).alias("source"),
            word_count(text_col).alias("size"),
        ),
        "sizes",
    )
    wanted = stage(targets(sized, weights, most), "targets")
    # As many slices as keep each within its rows; the places do not depend on them.
    digits = max(3, math.ceil(math.log(max(sized.count(), 1) / SLICE_ROWS, 16)))
    placed = placed_in_keys(
        sized, ["source"], ["key"], "rank", "size", "start", slice_by=F.substring("key", 1, digits)
    )
    share = wanted.select(F.col("source").alias("_s"), "source_size", "target")
    placed = stage(
        placed.join(share, F.col("source").eqNullSafe(F.col("_s"))).drop("_s"), "placed"
    )
    words: Column = F.floor(F.col("target") + 0.5).cast("long")
    slots = schedule(wanted.select("source", words.alias("words")), block)
    passes = F.explode(F.sequence(F.lit(0), F.lit(most - 1)))
    reads = (
        placed.filter("size > 0")
        .withColumn("pass", passes)
        .withColumn("lo", F.col("pass") * F.col("source_size") + F.col("start"))
        .withColumn("hi", F.least(F.col("lo") + F.col("size"), words))
        .filter("lo < hi")
        .withColumn("_block", F.explode(F.sequence(F.expr(f"lo div {block}"), F.expr(f"(hi - 1) div {block}"))))
    )
    same = F.col("source").eqNullSafe(F.col("_source")) & (F.col("_block") == F.col("block"))
    low = F.greatest("lo", F.col("block") * block)
    high = F.least("hi", (F.col("block") + 1) * block)
    parts = reads.join(slots.withColumnRenamed("source", "_source"), same).select(
        "slot", "source", "rank", "pass", (low - F.col("lo")).alias("first"), (high - low).alias("words")
    )
    return placed, parts


def taken(placed: DataFrame, parts: DataFrame) -> DataFrame:
    """The placed documents with ``taken``, the words that the mix reads of each, repeats counted;
    ``first_slot``, the first slot of the schedule that reads them (NULL if none); and ``n_slots``."""
    sums = parts.groupBy("source", "rank").agg(
        F.sum("words").alias("_taken"), F.min("slot").alias("first_slot"), F.count_distinct("slot").alias("_slots")
    )
    sums = sums.withColumnsRenamed({"source": "_s", "rank": "_r"})
    same = F.col("source").eqNullSafe(F.col("_s")) & (F.col("rank") == F.col("_r"))
    return placed.join(sums, same, "left").withColumns({
        "taken": F.coalesce("_taken", F.lit(0)).cast("long"), "n_slots": F.coalesce("_slots", F.lit(0)),
    }).drop("_s", "_r", "_taken", "_slots")


def mixed(
    docs: DataFrame,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
    slot_col: str | None = None,
    **how,
) -> DataFrame:
    """The mix as documents with their columns: one row per pass that reads at least half of one.

    Only the last document of a source's last block can be read in part, so rounding to whole
    documents moves a source's total by less than one document.  The first document of a source
    with a target comes even if less than half of it is read, so no such source is left out.
    Rows equal in all columns are copies of one document, which comes as often as they do
    together; rows that differ in any column come with their own.  ``slot_col`` names a column to
    add: the first slot of the schedule that reads the pass, the order in which to read the rows.
    """
    names = (id_col, source_col, text_col)
    others = [F.col(quoted(c)) for c in docs.columns if c not in names]
    ties = F.md5(F.to_json(F.struct(*others), {"ignoreNullFields": "false"})) if others else None
    placed, parts = mix(docs, *names, ties=ties, **how)
    read = parts.groupBy("source", "rank", "pass").agg(F.sum("words").alias("_words"), F.min("slot").alias("_slot"))
    read = read.withColumnsRenamed({"source": "_s", "rank": "_r"})
    same = F.col("source").eqNullSafe(F.col("_s")) & (F.col("rank") == F.col("_r"))
    mark, found, slots, slot = (unused(docs, n) for n in ("_key", "_found", "_slots", "_slot"))
    chosen = (
        placed.join(read, same).filter("2 * _words >= size OR (start = 0 AND pass = 0)")
        .groupBy(F.col("key").alias(found)).agg(F.collect_list("_slot").alias(slots))
    )
    keyed = docs.withColumn(mark, _key(docs, names, ties))
    rows = keyed.join(chosen, F.col(mark) == F.col(found)).dropDuplicates([mark])
    rows = rows.withColumn(slot, F.explode(slots))
    columns = [F.col(quoted(c)) for c in docs.columns]
    return rows.select(*columns, *([F.col(slot).alias(slot_col)] if slot_col else []))
