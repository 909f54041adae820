"""Near-duplicates by SimHash: a self-join of binary tries under a budget of differing bits.

The rule for a similarity takes what the tries find as candidates and verifies them by Jaccard; the
pairs that no trie meets are then found by the rarest shingles of their sets, which leaves none out.
"""

from __future__ import annotations

import math
import random
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from wardlens.llm.common import AT_ONCE, arrow_schema, map_batches, text_bytes, unused
from wardlens.llm.components import SpanningForest, components
from wardlens.sources.staging import stage, stage_lean

#: Node pairs that a traversal holds at once.
FRONTIER = 200_000
#: One in so many texts tells which shingles are frequent, and that is a shingle of so many of these texts.
SAMPLE, FREQUENT = 16, 3
#: Frequent shingles that are known at most; more are taken for rare ones.
FREQUENT_MOST = 1 << 19
#: Shingles of a bucket, about; a bucket's shingles from all texts meet in one task.
BUCKET_SHINGLES = 1 << 18
#: Bytes that are sent of a shingle's hash and of a set's digest; no pair is lost where they are equal by chance.
HASH_BYTES, KEY_BYTES = 6, 5


@dataclass(frozen=True)
class Walk:
    """One trie: the fingerprint's bits from ``first`` on, around its end, or the 64 ``picked``
    ones, and how many of the first ``head`` bits may differ; the bits after the head share the
    rule's ``reach``."""

    first: int
    head: int
    errors: int
    picked: tuple[int, ...] = ()


@dataclass(frozen=True)
class Rule:
    """Fingerprints of ``bits`` bits over runs of ``shingle`` words link at ``budget`` differing bits.

    ``reach`` is the most errors in the 64 bits of a trie.  With fixed ``walks`` a pair must keep
    to the head errors of one of them, and what they find is the result.  Without, pairs in budget
    are candidates, and texts link if the Jaccard similarity of their sets of shingles is at least
    ``similarity``.  Each walk then has random bits of its own and starts with a node's path where
    no bit differs, and there are as many walks as a pair at ``similarity`` needs to be met with
    the chance ``recall``; nodes keep about ``node_rows`` fingerprints at any table size.  Pairs that
    are out of budget or not met are found by ``unmet``.  At most about ``together`` sets, or
    ``together_bytes`` of them, are verified in one task.
    """

    shingle: int
    bits: int
    budget: int
    reach: int
    walks: tuple[Walk, ...] = ()
    similarity: float = 0.8
    recall: float = 0.98
    node_rows: int = 1024
    together: int = 256
    together_bytes: int = 1 << 26

    def met(self, depth: int, number: int) -> float:
        """The chance that a pair at ``similarity`` is in budget and meets in one of ``number`` walks.

        Walks share the pair's differing bits, however many those are; they only pick theirs
        independently.
        """
        differs = math.acos(2 * self.similarity / (1 + self.similarity)) / math.pi
        return sum(
            math.comb(self.bits, d) * differs**d * (1 - differs) ** (self.bits - d)
            * (1 - (1 - math.comb(self.bits - d, depth) / math.comb(self.bits, depth)) ** number)
            for d in range(self.budget + 1)
        )

    def walks_for(self, rows: int) -> tuple[Walk, ...]:
        if self.walks:
            return self.walks
        depth = min(32, max(8, math.ceil(math.log2(max(rows, 1) / self.node_rows))))
        number = 1
        while self.met(depth, number) < self.recall:
            number += 1
        return tuple(
            Walk(0, depth, 0, tuple(random.Random(i).sample(range(self.bits), 64))) for i in range(number)
        )


#: Exact: of 4 differing bits the first half has at most 2, or the second at most 1.
FOUR_BITS = Rule(4, 64, 4, 4, (Walk(0, 32, 2), Walk(32, 32, 1)), node_rows=4096)

#: For a Jaccard similarity of 0.8 on 5-word shingles: its cosine is at least 2 * 0.8 / 1.8, an
#: angle that differs in 39 of 256 bits on average, with a deviation of 6, and in 48 for sets of 4
#: and 5, where ties count.  64 leaves room for either.
SIMILAR = Rule(5, 256, 64, 64)


def _shingles(text: bytes, shingle: int) -> list[bytes]:
    """All runs of ``shingle`` words, or the one shorter run, of a text.

    Words are cut at ASCII white space after lower-casing A-Z.
    """
    words = text.lower().split()
    if not words:
        return []
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    stops = (ends - 1)[shingle - 1 :].tolist() or [len(joined)]
    starts = [0, *ends[: max(0, len(words) - shingle)].tolist()]
    return [joined[a:b] for a, b in zip(starts, stops)]


def shingle_set(text: bytes, shingle: int) -> np.ndarray:
    """The set of a text's shingles as sorted hashes."""
    digest = xxhash.xxh64_intdigest
    return np.unique(np.fromiter((digest(g, 42) for g in _shingles(text, shingle)), np.uint64))


def _hashed(grams: Sequence[bytes], seed: int) -> np.ndarray:
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(g, seed) for g in grams), ">u8", len(grams))


def _majority(grams: Sequence[bytes], bits: int, first: np.ndarray | None = None) -> bytes:
    """The bits that over half the hashes of the shingles have; zeros without shingles.

    ``first`` are the hashes by the first seed, if they are known.
    """
    if not grams:
        return bytes(bits // 8)
    out = []
    for seed in range(42, 42 + bits // 64):
        hashes = first if seed == 42 and first is not None else _hashed(grams, seed)
        ones = np.zeros(64, np.int64)
        for block in range(0, len(hashes), 1 << 16):
            part = hashes[block : block + (1 << 16)].view(np.uint8).reshape(-1, 8)
            ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
        out.append(np.packbits(2 * ones > len(grams)).tobytes())
    return b"".join(out)


def fingerprint(text: bytes, shingle: int, bits: int) -> bytes:
    """The SimHash of a text, big-endian; zeros without words.

    A bit is set when over half the hashes of the shingles, repeats included, have it.  Bits
    beyond 64 come from further seeds.
    """
    return _majority(_shingles(text, shingle), bits)


def set_fingerprint(text: bytes, shingle: int, bits: int) -> tuple[bytes, bytes, np.ndarray]:
    """The SimHash of a text's set of shingles, without repeats, a digest of that set, and the set
    as sorted hashes."""
    grams = sorted(set(_shingles(text, shingle)))
    hashes = _hashed(grams, 42)
    digest = xxhash.xxh3_128_digest(b"\n".join(grams))
    return _majority(grams, bits, hashes), digest, np.unique(hashes.astype(np.uint64))


def _least_shared(size: int, similarity: float) -> int:
    """How many members a set has in common, at least, with any set that is similar to it."""
    return max(1, math.ceil(similarity * size - 1e-6)) if size else 0


def rarest(hashes: np.ndarray, frequent: np.ndarray, similarity: float) -> np.ndarray:
    """The first of a set's sorted hashes in an order that puts the ``frequent`` ones last.

    As many as it takes: two sets that are similar have one of these in common, whatever the
    frequent ones are, since all sets follow one order.
    """
    last = np.zeros(len(hashes), bool)
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, hashes), len(frequent) - 1)
        last = frequent[at] == hashes
    number = len(hashes) - _least_shared(len(hashes), similarity) + 1 if len(hashes) else 0
    return np.concatenate([hashes[~last], hashes[last]])[:number]


def frequent_shingles(docs: DataFrame, text_col: str, rule: Rule) -> np.ndarray:
    """Hashes of shingles that many texts have, sorted, by a sample of the different texts.

    They only decide the order in which sets are compared, so the sample changes no result.
    """
    texts = docs.select(text_bytes(text_col).alias("_text"))
    texts = texts.filter(F.pmod(F.xxhash64("_text"), F.lit(SAMPLE)) == 0).distinct()

    def shingles(batch: pa.RecordBatch) -> dict[str, object] | None:
        sets = [shingle_set(t, rule.shingle) for t in batch.column(0).to_pylist()]
        if not sets:
            return None
        found, times = np.unique(np.concatenate(sets), return_counts=True)
        return {"hash": pa.array(found.view(np.int64)), "n": pa.array(times.astype(np.int64))}

    counted = map_batches(texts, shingles, "hash long, n long", AT_ONCE).groupBy("hash").agg(F.sum("n").alias("n"))
    often = stage_lean(counted.filter(F.col("n") >= FREQUENT), "frequent")
    known, least = 0, None
    for n, number in often.groupBy("n").count().orderBy(F.desc("n")).collect():
        known += number
        if known > FREQUENT_MOST:
            break
        least = n
    if least is None:
        return np.zeros(0, np.uint64)
    hashes = often.filter(F.col("n") >= least).select("hash").toArrow().column(0).to_numpy()
    return np.sort(hashes.view(np.uint64))


def _packed(values: np.ndarray, width: int) -> bytes:
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]).tobytes()


def _unpacked(raw: bytes, width: int) -> np.ndarray:
    out = np.zeros((len(raw) // width, 8), np.uint8)
    out[:, :width] = np.frombuffer(raw, np.uint8).reshape(-1, width)
    return out.view("<u8").ravel()


def fingerprints(
    docs: DataFrame, rule: Rule, id_col: str = "doc_id", text_col: str = "text", *more: Column
) -> DataFrame:
    """The id, ``more`` columns and ``fingerprint`` (binary) of every row; a NULL text is an empty one.

    A rule for a similarity has the fingerprints of sets, and adds ``_set``, the set's digest,
    ``_size``, the number of its shingles, ``_rarest``, the upper bytes of the hashes of the rarest, and
    ``_spare``, how many of these are equal to others of the set by chance.
    """
    picked = docs.select(text_bytes(text_col).alias("_text"), id_col, *more)
    kept = picked.columns[1:]
    frequent = np.zeros(0, np.uint64) if rule.walks else frequent_shingles(docs, text_col, rule)

    def rows(batch: pa.RecordBatch) -> dict[str, object]:
        texts = batch.column(0).to_pylist()
        same = {c: batch.column(i + 1) for i, c in enumerate(kept)}
        if rule.walks:
            return {**same, "fingerprint": [fingerprint(t, rule.shingle, rule.bits) for t in texts]}
        prints, digests, sizes, rare, spare = [], [], [], [], []
        for t in texts:
            print_, digest, hashes = set_fingerprint(t, rule.shingle, rule.bits)
            prints.append(print_)
            digests.append(digest)
            sizes.append(len(hashes))
            upper = rarest(hashes, frequent, rule.similarity) >> np.uint64(64 - 8 * HASH_BYTES)
            rare.append(_packed(upper, HASH_BYTES))
            spare.append(len(upper) - len(np.unique(upper)))
        return {**same, "fingerprint": prints, "_set": digests, "_size": sizes, "_rarest": rare, "_spare": spare}

    types = [f"`{c}` {picked.schema[c].dataType.simpleString()}" for c in kept] + ["fingerprint binary"]
    if not rule.walks:
        types += ["`_set` binary", "`_size` int", "`_rarest` binary", "`_spare` int"]
    return map_batches(picked, rows, ", ".join(types), AT_ONCE)


def _words(prints: list[bytes], bits: int) -> np.ndarray:
    """Fingerprints as rows of big-endian 64-bit words."""
    return np.frombuffer(b"".join(prints), ">u8").reshape(-1, bits // 64).astype(np.uint64)


def _turned(words: np.ndarray, first: int) -> np.ndarray:
    """The 64 bits from ``first`` on, around the end."""
    n = words.shape[1]
    at, by = divmod(first, 64)
    if not by:
        return words[:, at]
    left, right = words[:, at], words[:, (at + 1) % n]
    return (left << np.uint64(by)) | (right >> np.uint64(64 - by))


def _keys(words: np.ndarray, walk: Walk) -> np.ndarray:
    """The 64 bits of each fingerprint that the walk's trie is made of."""
    if not walk.picked:
        return _turned(words, walk.first)
    bits = np.unpackbits(np.ascontiguousarray(words.astype(">u8")).view(np.uint8), axis=1)
    chosen = np.packbits(bits[:, list(walk.picked)], axis=1)
    return np.ascontiguousarray(chosen).view(">u8").reshape(-1).astype(np.uint64)


class _Trie:
    """Sorted keys as a binary trie: a node is a range of them."""

    def __init__(self, words: np.ndarray, walk: Walk):
        keys = _keys(words, walk)
        self.order = np.argsort(keys, kind="stable")
        self.keys = keys[self.order]
        self.words = words[self.order]

    def zeros(self, depth: int) -> np.ndarray:
        """Running number of keys whose bit at ``depth`` is 0."""
        unset = ((self.keys >> np.uint64(63 - depth)) & np.uint64(1)) == 0
        return np.concatenate(([0], np.cumsum(unset)))


def linked(
    left: np.ndarray, right: np.ndarray | None, walk: Walk, reach: int, budget: int
) -> tuple[np.ndarray, np.ndarray]:
    """Spanning edges of the pairs that ``walk`` finds within ``budget`` bits.

    ``left`` and ``right`` are fingerprint words; without ``right`` the pairs are those inside
    ``left``.  Edges index the rows of both, those of ``right`` after those of ``left``.  Both
    tries are walked together from pairs of nodes to pairs of their children; a pair of nodes
    whose differing bits exceed the budget is dropped with all below it.
    """
    inside = right is None
    a = _Trie(left, walk)
    b = a if inside else _Trie(right, walk)
    shift = 0 if inside else len(left)
    forest = SpanningForest(len(left) + (0 if inside else len(right)))
    zeros: dict[tuple[int, int], np.ndarray] = {}

    def count(side: int, depth: int) -> np.ndarray:
        if (side, depth) not in zeros:
            zeros[side, depth] = (b if side else a).zeros(depth)
        return zeros[side, depth]

    def verify(x: np.ndarray, y: np.ndarray) -> None:
        differing = np.zeros(len(x), np.int64)
        for word in range(left.shape[1]):
            differing += np.bitwise_count(a.words[x, word] ^ b.words[y, word])
        good = differing <= budget
        forest.add(a.order[x[good]], b.order[y[good]] + shift)

    start = np.array([[0], [len(a.keys)], [0], [len(b.keys)], [0]], np.int64)
    waiting = [(0, start)] if len(a.keys) and len(b.keys) else []
    while waiting:
        depth, (alo, ahi, blo, bhi, errors) = waiting.pop()
        single = (ahi - alo == 1) & (bhi - blo == 1)
        if single.any():
            x, y = alo[single], blo[single]
            if inside:
                x, y = x[x != y], y[x != y]
            verify(x, y)
            alo, ahi, blo, bhi, errors = (v[~single] for v in (alo, ahi, blo, bhi, errors))
        if not len(alo):
            continue
        if depth == 64:
            # Keys equal in all 64 bits of this trie, or within the budget: pair them off in blocks.
            for p in range(len(alo)):
                ys = np.arange(blo[p], bhi[p])
                for x in range(alo[p], ahi[p]):
                    verify(np.full(len(ys), x), ys)
            continue
        za, zb = count(0, depth), count(1, depth)
        am = alo + za[ahi] - za[alo]
        bm = blo + zb[bhi] - zb[blo]
        # Only one of the two mirrored child pairs of a node paired with itself.
        twin = (alo == blo) & (ahi == bhi) if inside else np.zeros(len(alo), bool)
        one = errors + 1
        most = walk.errors if depth < walk.head else reach
        nodes = []
        for low_a, high_a, low_b, high_b, cost, ok in (
            (alo, am, blo, bm, errors, True),
            (am, ahi, bm, bhi, errors, True),
            (alo, am, bm, bhi, one, True),
            (am, ahi, blo, bm, one, ~twin),
        ):
            keep = (high_a > low_a) & (high_b > low_b) & (cost <= most) & ok
            nodes.append(np.stack([low_a[keep], high_a[keep], low_b[keep], high_b[keep], cost[keep]]))
        children = np.concatenate(nodes, axis=1)
        waiting += [
            (depth + 1, children[:, i : i + FRONTIER]) for i in range(0, children.shape[1], FRONTIER)
        ]
    return forest.edges()


def _head_masks(depth: int, errors: int) -> list[int]:
    """The ways to flip at most ``errors`` of ``depth`` bits; 0 first."""
    return [
        sum(1 << bit for bit in flipped)
        for n in range(min(errors, depth) + 1)
        for flipped in combinations(range(depth), n)
    ]


def links(prints: DataFrame, rule: Rule) -> DataFrame:
    """Edges that connect the distinct fingerprints which the rule links: longs ``a``, ``b``.

    ``prints`` holds distinct ``fingerprint``s and a long ``node`` for each.  The top of each
    trie, down to nodes of about ``rule.node_rows`` fingerprints, is laid out as a table of
    nodes; a node that is still much larger, as where near copies crowd, is cut into slices.
    Each pair of nodes within the head errors, by slices, is one group, walked on from there by
    ``linked``; so a group never outgrows a task, and none reports more than a spanning forest
    of its links.
    """
    rows = prints.count()
    walks = rule.walks_for(rows)
    depth = max(5, math.ceil(math.log2(max(rows, 1) / rule.node_rows)))
    depth = min(depth if rule.walks else 64, *(w.head for w in walks))
    if rule.walks:
        ring = F.concat("fingerprint", "fingerprint")
        tops = [
            F.struct(F.lit(i).alias("walk"), F.conv(F.substring(F.lpad(F.conv(F.hex(
                F.substring(ring, w.first // 8 + 1, 5)), 16, 2), 40, "0"), w.first % 8 + 1, depth),
                2, 10).cast("long").alias("p"))
            for i, w in enumerate(walks)
        ]
        keyed = prints.select("node", "fingerprint", F.inline(F.array(*tops)))
    else:
        def paths(batch: pa.RecordBatch) -> dict[str, object]:
            words = _words(batch.column(1).to_pylist(), rule.bits)
            found = np.stack([_keys(words, w) >> np.uint64(64 - depth) for w in walks], axis=1)
            tops = pa.array(found.astype(np.int64).tolist(), pa.list_(pa.int64()))
            return {"node": batch.column(0), "fingerprint": batch.column(1), "tops": tops}

        topped = map_batches(
            prints.select("node", "fingerprint"), paths, "node long, fingerprint binary, tops array<long>"
        )
        keyed = topped.select("node", "fingerprint", F.posexplode("tops").alias("walk", "p"))
    sizes = stage(
        keyed.groupBy("walk", "p").agg(
            F.ceil(F.count("*") / (2 * rule.node_rows)).cast("int").alias("slices")
        ),
        "nodes",
    )
    flips = F.array(*(
        F.array(*(F.lit(m).cast("long") for m in _head_masks(depth, w.errors))) for w in walks
    ))
    pairs = sizes.select("walk", "p", "slices", F.explode(F.get(flips, F.col("walk"))).alias("flip"))
    pairs = pairs.withColumn("q", F.col("p").bitwiseXOR(F.col("flip"))).drop("flip")
    others = sizes.select("walk", F.col("p").alias("q"), F.col("slices").alias("others"))
    copies = keyed.join(pairs.join(others, ["walk", "q"]), ["walk", "p"])
    # A block is a slice of a node; every fingerprint goes to all blocks that its own meets.
    slice_of = F.pmod(F.xxhash64("fingerprint"), F.col("slices"))
    copies = copies.withColumn("mine", F.shiftleft("p", 24) + slice_of).withColumn(
        "theirs", F.explode(F.sequence(F.shiftleft("q", 24), F.shiftleft("q", 24) + F.col("others") - 1))
    )
    blocks = copies.select(
        "walk", F.least("mine", "theirs").alias("x"), F.greatest("mine", "theirs").alias("y"),
        (F.col("mine") > F.col("theirs")).alias("right"), "node", "fingerprint",
    )

    def join(group: pa.Table) -> pa.Table:
        walk = walks[group.column("walk")[0].as_py()]
        nodes = group.column("node").to_numpy()
        words = _words(group.column("fingerprint").to_pylist(), rule.bits)
        if group.column("x")[0] == group.column("y")[0]:
            i, j = linked(words, None, walk, rule.reach, rule.budget)
        else:
            side = group.column("right").to_numpy()
            nodes = np.concatenate([nodes[~side], nodes[side]])
            i, j = linked(words[~side], words[side], walk, rule.reach, rule.budget)
        return pa.table({"a": pa.array(nodes[i], pa.int64()), "b": pa.array(nodes[j], pa.int64())})

    return blocks.groupBy("walk", "x", "y").applyInArrow(join, "a long, b long")


def alike(
    sets: list[np.ndarray], similarity: float, labels: np.ndarray, probing: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Spanning edges of the pairs of sets whose Jaccard similarity is at least ``similarity``.

    Sets with one of the ``labels`` are connected already.  Pairs have an end among ``probing``; a
    set that is connected to all others needs no more counting.
    """
    sizes = np.array([len(x) for x in sets])
    forest = SpanningForest(len(sets))
    first: dict[int, int] = {}
    old = np.array([first.setdefault(x, i) for i, x in enumerate(labels.tolist())])
    forest.add(np.arange(len(sets)), old)
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, name = np.unique(np.concatenate(sets), return_inverse=True)
    holders = owner[np.argsort(name, kind="stable")]
    ends = np.cumsum(np.bincount(name, minlength=1))
    starts = ends - np.bincount(name, minlength=1)
    at = np.cumsum(sizes) - sizes
    found: list[tuple[int, int]] = []
    for i in probing.tolist():
        if (forest.root == forest.root[i]).all():
            continue
        shared = np.zeros(len(sets), np.int64)
        names = name[at[i] : at[i] + sizes[i]]
        for part in range(0, len(names), 4096):
            low, high = starts[names[part : part + 4096]], ends[names[part : part + 4096]]
            width = high - low
            where = np.repeat(low - np.cumsum(width) + width, width) + np.arange(width.sum())
            shared += np.bincount(holders[where], minlength=len(sets))
        near = shared / np.maximum(sizes + sizes[i] - shared, 1) >= similarity
        for j in np.flatnonzero(near & (forest.root != forest.root[i])).tolist():
            if forest.root[i] != forest.root[j]:
                forest.add(np.array([i]), np.array([j]))
                found.append((i, j))
    ends_of = np.array(found, np.int64).reshape(-1, 2)
    return ends_of[:, 0], ends_of[:, 1]


def _verify(grouped, rule: Rule) -> DataFrame:
    """The verified edges of each group of rows ``node``, ``set``, ``label`` and ``probes``."""

    def join(group: pa.Table) -> pa.Table:
        nodes = group.column("node").to_numpy()
        sets = [np.frombuffer(x, np.uint64) for x in group.column("set").to_pylist()]
        probing = np.flatnonzero(group.column("probes").to_numpy())
        i, j = alike(sets, rule.similarity, group.column("label").to_numpy(), probing)
        return pa.table({"a": pa.array(nodes[i], pa.int64()), "b": pa.array(nodes[j], pa.int64())})

    return grouped.applyInArrow(join, "a long, b long")


def _labelled(sets: DataFrame, edges: DataFrame) -> DataFrame:
    """The sets with ``label``, the smallest node that the edges connect each with."""
    reached = components(edges).select(F.col("node").alias("_n"), "component")
    joined = sets.drop("label").join(reached, F.col("node") == F.col("_n"), "left")
    return joined.withColumn("label", F.coalesce("component", "node")).drop("_n", "component")


def similar(members: DataFrame, docs: DataFrame, text_col: str, rule: Rule) -> DataFrame:
    """Edges that connect the texts at ``rule.similarity`` inside each class: longs ``a``, ``b``.

    ``members`` has a long ``node``, its ``class`` of candidates and ``text``, the MD5 of a text.
    Every pair of a class is held against the threshold unless verified links connect it already,
    so a task holds the sets of one class.  A class of more than ``rule.together`` is cut: slices
    of it, by two hashes, are verified each in itself; then what is not in the class's largest
    component meets the whole class, slice by slice.  So a crowd of near copies is read a few
    times, whatever its size, and only texts that link with nothing near are met by all.
    """
    several = members.groupBy("class").agg(F.count("*").alias("_n")).filter("_n > 1")
    wanted = stage(
        members.join(several.select(F.col("class").alias("_c")), F.col("class") == F.col("_c"))
        .select(F.col("text").alias("_md5"), "node", "class"),
        "candidates",
    )
    texts = docs.select(text_bytes(text_col).alias("_text"))
    texts = texts.withColumn("_key", F.unhex(F.md5("_text"))).join(wanted, F.col("_key") == F.col("_md5"))

    def hashed(batch: pa.RecordBatch) -> dict[str, object]:
        found = [shingle_set(t, rule.shingle).tobytes() for t in batch.column(2).to_pylist()]
        return {"node": batch.column(0), "class": batch.column(1), "set": found}

    once = texts.select("node", "class", "_text").dropDuplicates(["node"])
    hashes = stage(map_batches(once, hashed, "node long, class long, set binary", AT_ONCE), "sets")
    slices = F.greatest(
        F.ceil(F.count("*") / rule.together), F.ceil(F.sum(F.octet_length("set")) / rule.together_bytes)
    )
    sized = stage(
        hashes.groupBy("class").agg(slices.cast("int").alias("slices"))
        .select(F.col("class").alias("_c"), "slices"),
        "slices",
    )
    sets = hashes.join(sized, F.col("class") == F.col("_c")).drop("_c").withColumn("label", F.col("node"))
    every = F.lit(True).alias("probes")

    def within(rows: DataFrame, turn: int) -> DataFrame:
        slot = F.pmod(F.xxhash64("node", F.lit(turn)), F.col("slices")).alias("slot")
        grouped = rows.select("class", slot, "node", "set", "label", every).groupBy("class", "slot")
        return _verify(grouped, rule)

    edges = stage(within(sets, 0), "similar")
    if sized.filter("slices > 1").isEmpty():
        return edges
    large = stage(sets.filter("slices > 1"), "large")
    again = stage(within(_labelled(large, edges), 1), "similar")
    edges = edges.union(again)
    labelled = stage(_labelled(large, edges), "labelled")
    counts = labelled.groupBy("class", "label").agg(F.count("*").alias("n"))
    main = stage(
        counts.groupBy("class").agg(F.max(F.struct("n", "label")).alias("m"), F.sum("n").alias("all"))
        .select(F.col("class").alias("_c"), F.col("m.label").alias("_main"),
                F.col("m.n").alias("_inner"), (F.col("all") - F.col("m.n")).alias("_rest"))
        .filter("_rest > 0"),
        "main",
    )
    # Slices of the largest component have the numbers before those of the rest.
    share = F.col("slices") / (F.col("_inner") + F.col("_rest"))
    inner = F.ceil(F.col("_inner") * share).cast("int")
    rest = F.ceil(F.col("_rest") * share).cast("int")
    open_ = (
        labelled.join(main, F.col("class") == F.col("_c"))
        .withColumn("inner", inner).withColumn("upto", inner + rest)
        .withColumn("outside", F.col("label") != F.col("_main"))
    )
    hashed_at = F.xxhash64("node", F.lit(2))
    slot = F.when(F.col("outside"), F.col("inner") + F.pmod(hashed_at, F.col("upto") - F.col("inner")))
    open_ = open_.withColumn("slot", slot.otherwise(F.pmod(hashed_at, F.col("inner"))).cast("int"))
    met = F.when(F.col("outside"), F.sequence(F.lit(0), F.col("upto") - 1)).otherwise(
        F.sequence(F.col("inner"), F.col("upto") - 1)
    )
    blocks = open_.withColumn("other", F.explode(met)).filter("slot <> other")
    blocks = blocks.select(
        "class", F.least("slot", "other").alias("x"), F.greatest("slot", "other").alias("y"),
        "node", "set", "label", (F.col("slot") > F.col("other")).alias("probes"),
    )
    return edges.union(_verify(blocks.groupBy("class", "x", "y"), rule))


def _shared_shingles(rows: DataFrame) -> DataFrame:
    """The rarest shingles that different sets share: longs ``hash`` and ``key``, a set's digest's start.

    Only packed bytes are shuffled, and copies that a batch holds are sent once.
    """
    total = rows.agg(F.sum(F.octet_length("_rarest"))).first()[0] or 0
    buckets = total // (HASH_BYTES * BUCKET_SHINGLES) + 1
    target = arrow_schema("bucket int, hashes binary, keys binary")

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rare = dict(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
            sizes = np.array([len(x) // HASH_BYTES for x in rare.values()], np.int64)
            digests, raw = list(rare), list(rare.values())
            parts = np.cumsum(sizes) // BUCKET_SHINGLES
            for part in np.unique(parts):
                low, high = np.searchsorted(parts, [part, part + 1])
                hashes = _unpacked(b"".join(raw[low:high]), HASH_BYTES)
                keys = np.array([int.from_bytes(d[:KEY_BYTES], "big") for d in digests[low:high]], np.uint64)
                keys = np.repeat(keys, sizes[low:high])
                bucket = ((hashes >> np.uint64(16)) * np.uint64(buckets)) >> np.uint64(8 * HASH_BYTES - 16)
                order = np.argsort(bucket, kind="stable")
                hashes, keys, bucket = hashes[order], keys[order], bucket[order].astype(np.int32)
                full = np.unique(bucket)
                edges = np.r_[np.searchsorted(bucket, full), len(bucket)]
                yield pa.RecordBatch.from_arrays([
                    pa.array(full),
                    pa.array([_packed(hashes[a:b], HASH_BYTES) for a, b in zip(edges, edges[1:])], pa.binary()),
                    pa.array([_packed(keys[a:b], KEY_BYTES) for a, b in zip(edges, edges[1:])], pa.binary()),
                ], schema=target)

    def meet(table: pa.Table) -> pa.Table:
        hashes = _unpacked(b"".join(table.column("hashes").to_pylist()), HASH_BYTES)
        keys = _unpacked(b"".join(table.column("keys").to_pylist()), KEY_BYTES)
        order = np.lexsort((keys, hashes))
        hashes, keys = hashes[order], keys[order]
        new = np.r_[True, (hashes[1:] != hashes[:-1]) | (keys[1:] != keys[:-1])] if len(keys) else []
        hashes, keys = hashes[new], keys[new]
        again = np.r_[False, hashes[1:] == hashes[:-1], False]
        several = again[:-1] | again[1:]
        return pa.table({"hash": hashes[several].astype(np.int64), "key": keys[several].astype(np.int64)})

    sent = rows.select("_set", "_rarest").mapInArrow(send, "bucket int, hashes binary, keys binary")
    return stage_lean(sent.groupBy("bucket").applyInArrow(meet, "hash long, key long"), "shared")


def unmet(members: DataFrame, rows: DataFrame, rule: Rule) -> DataFrame:
    """Pairs of sets that may be similar and have different labels: longs ``a``, ``b``.

    ``members`` has ``node``, ``label``, ``size``, ``spare`` and ``_set``; ``rows`` the shingles.  Sets
    that are similar share one of their rarest shingles, and as many of them as their sizes ask for: up
    to the last one of that set whose last comes first, all that they have in common are among these.
    Of shingles that look equal in the bytes sent only one counts, so as many may be missing as either
    set has to spare.  Sets that look equal in them meet nobody of their own key there: they are pairs.
    """
    key = F.conv(F.hex(F.substring("_set", 1, KEY_BYTES)), 16, 10).cast("long")
    named = members.select(key.alias("_key"), "node", "label", "size", "spare")
    shared = _shared_shingles(rows)
    held = stage_lean(
        shared.join(named, F.col("key") == F.col("_key")).select("hash", "node", "label", "size", "spare"), "held"
    )
    t, slack = F.lit(rule.similarity), F.lit(1e-6)
    told = ("node", "label", "size", "spare")
    left = held.select("hash", *(F.col(c).alias(f"{c}_a") for c in told))
    right = held.select(F.col("hash").alias("_h"), *(F.col(c).alias(f"{c}_b") for c in told))
    smaller = (F.col("size_a") < F.col("size_b")) | (
        (F.col("size_a") == F.col("size_b")) & (F.col("node_a") < F.col("node_b"))
    )
    near = F.col("size_a") >= t * F.col("size_b") - slack
    pairs = left.join(
        right, (F.col("hash") == F.col("_h")) & (F.col("label_a") != F.col("label_b")) & smaller & near
    )
    common = F.ceil(t / (1 + t) * (F.col("size_a") + F.col("size_b")) - slack)
    asked = common - F.greatest(F.ceil(t * F.col("size_b") - slack), F.lit(1)) + 1 - F.least("spare_a", "spare_b")
    counted = pairs.groupBy("node_a", "node_b", asked.alias("asked")).agg(F.count("*").alias("n"))
    near_enough = counted.filter("n >= asked").select(F.col("node_a").alias("a"), F.col("node_b").alias("b"))
    others = named.select(F.col("_key").alias("_k"), F.col("node").alias("b"), F.col("label").alias("_l"))
    same_key = (F.col("_key") == F.col("_k")) & (F.col("node") < F.col("b")) & (F.col("label") != F.col("_l"))
    return near_enough.union(named.join(others, same_key).select(F.col("node").alias("a"), "b"))


def _verified(rows: DataFrame, candidates: DataFrame, docs: DataFrame, id_col: str, text_col: str, rule: Rule):
    """The sets of ``rows`` with their class: ``fingerprint``, ``_set``, ``least``, ``class``."""
    distinct = rows.groupBy("fingerprint", "_set").agg(
        F.min(id_col).alias("least"), F.min("_md5").alias("text"), F.min("_size").alias("size"),
        F.min("_spare").alias("spare"),
    )
    prints = candidates.select(F.col("fingerprint").alias("_print"), "class")
    members = stage_lean(
        distinct.join(prints, F.col("fingerprint") == F.col("_print")).drop("_print")
        .withColumn("node", F.monotonically_increasing_id()),
        "members",
    )
    members = stage_lean(_labelled(members, similar(members, docs, text_col, rule)), "members")
    open_ = stage_lean(unmet(members, rows, rule), "unmet")
    if not open_.isEmpty():
        crowd = components(open_).select(F.col("node").alias("_n"), "component")
        several = members.drop("class").join(crowd, F.col("node") == F.col("_n")).withColumnRenamed("component", "class")
        found = stage_lean(similar(several.select("node", "class", "text"), docs, text_col, rule), "found")
        ends = [members.select(F.col("node").alias(f"_{e}"), F.col("label").alias(f"label_{e}")) for e in "ab"]
        joined = found.join(ends[0], F.col("a") == F.col("_a")).join(ends[1], F.col("b") == F.col("_b"))
        more = components(joined.select(F.col("label_a").alias("a"), F.col("label_b").alias("b")))
        more = more.select(F.col("node").alias("_l"), "component")
        members = members.join(more, F.col("label") == F.col("_l"), "left").withColumn(
            "label", F.coalesce("component", "label")
        )
    return members.select("fingerprint", "_set", "least", F.col("label").alias("class"))


def classes(
    docs: DataFrame, rule: Rule, id_col: str, text_col: str, *more: Column
) -> DataFrame:
    """The id, ``more`` columns and ``fingerprint`` of every row, with its class.

    ``class`` is the same for all rows of a class, ``component`` is the smallest id in it, NULL
    if it has none.
    """
    extra = () if rule.walks else (F.unhex(F.md5(text_bytes(text_col))).alias("_md5"),)
    rows = stage(fingerprints(docs, rule, id_col, text_col, *more, *extra), "fingerprints")
    # One node per distinct fingerprint; copies are counted away before the shuffle.
    distinct = stage(
        rows.groupBy("fingerprint").agg(F.min(id_col).alias("least"))
        .withColumn("node", F.monotonically_increasing_id()),
        "distinct",
    )
    reached = components(links(distinct, rule)).withColumnRenamed("node", "_n")
    classed = distinct.join(reached, F.col("node") == F.col("_n"), "left").select(
        "fingerprint", "least", F.coalesce("component", "node").alias("class")
    )
    keys = ["fingerprint"]
    if not rule.walks:
        classed = stage(_verified(rows, classed, docs, id_col, text_col, rule), "verified")
        keys = ["fingerprint", "_set"]
    # Written first, so that the join below deals both sides anew and large classes can be split.
    least = stage(classed.groupBy("class").agg(F.min("least").alias("component")), "classes")
    found = classed.join(least, "class").select(*keys, "class", "component")
    for key in keys:
        found = found.withColumnRenamed(key, f"_of{key}")
    same = [F.col(key) == F.col(f"_of{key}") for key in keys]
    rows = rows.drop("_size", "_rarest", "_spare")
    return rows.join(found, same).drop(*(f"_of{key}" for key in keys), "_set", "_md5")


def near_duplicates(
    docs: DataFrame, rule: Rule = SIMILAR, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: the id, ``fingerprint`` (hex) and ``component_id``.

    ``component_id`` is the smallest id reachable over links, the row's own included.  By the
    standing rule texts link at a similarity of 0.8, exactly; see ``Rule``.  NULL or empty texts have the fingerprint zero, linked like any other; so are equal texts and repeated
    rows.  Rows that share an id are classed each by its own text.  A row with a NULL id is
    returned with its class, NULL if that has no id.  Other columns are not read.  An empty table
    gives no rows.
    """
    return classes(docs, rule, id_col, text_col).select(
        id_col,
        F.lower(F.hex("fingerprint")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


def keep_one(
    docs: DataFrame, rule: Rule = SIMILAR, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row of each class: that with the smallest id, with all its columns.

    A class without ids keeps a row too.  Which of several rows with one id stays is decided by
    their content, so reruns agree; of repeated rows one stays.
    """
    content, row = F.xxhash64(*docs.columns), unused(docs, "_row")
    # A hash of several columns passes over NULLs, so that one alone takes rows of different texts for one.
    single, cell = F.xxhash64(*(F.xxhash64(c) for c in docs.columns)), unused(docs, "_cell")
    place = F.struct(
        F.col(id_col).isNull(), F.col(id_col).alias("i"), F.col(row).alias("r"), F.col(cell).alias("c")
    )
    firsts = (
        classes(docs, rule, id_col, text_col, content.alias(row), single.alias(cell))
        .groupBy("class").agg(F.min(place).alias("k"))
    )
    kept_id, kept_row, kept_cell = (unused(docs, c) for c in ("_kept_id", "_kept_row", "_kept_cell"))
    firsts = firsts.select(
        F.col("k.i").alias(kept_id), F.col("k.r").alias(kept_row), F.col("k.c").alias(kept_cell)
    )
    marked = docs.withColumn(row, content).withColumn(cell, single)
    same = (
        marked[id_col].eqNullSafe(F.col(kept_id)) & (F.col(row) == F.col(kept_row))
        & (F.col(cell) == F.col(kept_cell))
    )
    return marked.join(firsts, same, "left_semi").dropDuplicates([id_col, row, cell]).select(*docs.columns)
