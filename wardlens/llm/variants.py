"""Spelling variants: words one edit apart, found by comparing dense tiles of code points.

Two words are near if one inserted, deleted or replaced code point makes them equal, that is if
their common prefix and common suffix together reach the longer one's length less one.  The longer
length m is cut into ``PARTS`` parts.  The edit lies in one of them, and all outside it is equal: so
near words meet in a bucket of (m, part, what stands before the part, what stands after it).  A
bucket's words are dealt to blocks of bounded size, each two blocks are a tile, and a tile compares
all of its words at once as matrices of code points, padded on the right for prefixes and on the
left for suffixes.  A pair counts only in the part where its common prefix ends, hence once.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from wardlens.llm.common import arrow_schema
from wardlens.sources.staging import stage

#: Parts that a word is cut into.
PARTS = 3
#: Words of a block; buckets of more words are cut.
BLOCK = 512
#: Rows that one group of tiles is meant to have.
GROUP_ROWS = 20_000
#: Code points that one step compares.
STEP = 1 << 22
#: Different words that a task counts before it hands them on.
COUNTED = 200_000

_RUN = re.compile("[A-Za-zÀ-ÿ]+")


def lowered(run: str) -> str:
    """A run with A-Z, and nothing else, in lower case."""
    return run.encode("latin-1").lower().decode("latin-1")


def with_slips(doc_id: object, run: str, every: int) -> str:
    """A lower-cased run; where ``every`` divides the hash of document and run, less one code point."""
    mark = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
    if every and mark % every == 0:
        at = mark % len(run)
        return run[:at] + run[at + 1 :]
    return run


def word_counts(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shortest: int = 7, slip_every: int = 31
) -> DataFrame:
    """Occurrences ``n`` of every word of at least ``shortest`` code points.

    Words are maximal runs of letters up to U+00FF of the whole texts; A-Z count as a-z.  One of
    ``slip_every`` (document, word) hashes loses a code point (0: none).  NULL texts have no
    words; a NULL id is the empty text in the hash.
    """
    target = arrow_schema("word string, n long")

    def table(counts: Counter) -> pa.RecordBatch:
        arrays = [pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())]
        return pa.RecordBatch.from_arrays(arrays, schema=target)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = Counter(_RUN.findall(text.as_py() or ""))
                low: Counter = Counter()
                for form, n in found.items():
                    if len(form) >= shortest:
                        low[lowered(form)] += n
                for form, n in low.items():
                    word = with_slips(doc_id, form, slip_every)
                    if len(word) >= shortest:
                        counts[word] += n
                if len(counts) > COUNTED:
                    yield table(counts)
                    counts = Counter()
        yield table(counts)

    texts = docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`").cast("string"))
    return texts.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _cut(m: Column, part: Column) -> Column:
    """Where a part of a length begins."""
    return F.call_function("div", m * part, F.lit(PARTS)).cast("int")


def _keyed(words: DataFrame) -> DataFrame:
    """Each word in the buckets where it may have a near one: bucket, part, word and n."""
    length = F.char_length("word")
    spots = F.array(*[
        F.struct((length + more).alias("m"), F.lit(q).alias("q")) for more in (0, 1) for q in range(PARTS)
    ])
    each = words.select("word", "n", F.explode(spots).alias("at")).select("word", "n", "at.m", "at.q")
    head = F.left("word", _cut(F.col("m"), F.col("q")))
    tail = F.right("word", F.col("m") - _cut(F.col("m"), F.col("q") + 1))
    return each.select(
        F.xxhash64("m", "q", head, tail).alias("bucket"), (F.col("m") * PARTS + F.col("q")).alias("part"), "word", "n"
    )


def _tiles(words: DataFrame, block: int) -> DataFrame:
    """The words dealt to tiles: bucket, part, tile (i, j), own block b, word, n and group ``deal``."""
    keyed = _keyed(words)
    sizes = keyed.groupBy("bucket", "part").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    sizes = stage(sizes.withColumn("blocks", F.ceil(F.col("size") / block).cast("int")), "buckets")
    rows = sizes.agg(F.sum(F.col("size") * F.col("blocks"))).first()[0] or 0
    groups = F.lit(int(rows) // GROUP_ROWS + 1).cast("bigint")
    sized = keyed.join(sizes.select(F.col("bucket").alias("k"), F.col("part").alias("p"), "blocks"),
                       (F.col("bucket") == F.col("k")) & (F.col("part") == F.col("p")))
    own = F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int")
    dealt = sized.withColumn("b", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.withColumns({"i": F.least("b", "other"), "j": F.greatest("b", "other")})
    return dealt.select(
        F.pmod(F.xxhash64("bucket", "part", "i", "j"), groups).alias("deal"), "bucket", "part", "i", "j", "b", "word", "n"
    )


def common_ends(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Lengths of the equal beginnings of two stacks of code-point rows."""
    differs = left != right
    first = differs.argmax(-1)
    return np.where(differs.any(-1), first, differs.shape[-1])


def _near_in(
    aligned: np.ndarray, size: np.ndarray, starts: np.ndarray, m: int, low: int, high: int
) -> tuple[np.ndarray, np.ndarray]:
    """Near pairs inside tiles whose longer words have length m: places of both words.

    ``aligned`` holds the words' code points padded on the right, ``starts`` the tiles' first rows and
    the end.  Common prefixes end from ``low`` to before ``high``.  Tiles of about the same size are
    compared in one stack.
    """
    shorter = size == m - 1
    reversed_ = np.where(shorter[:, None], np.roll(aligned, 1, axis=1), aligned)[:, ::-1]
    counts = np.diff(starts)
    left, right = [], []
    widths = 1 << np.ceil(np.log2(np.maximum(counts, 2))).astype(int)
    for width in np.unique(widths):
        tiles = np.flatnonzero(widths == width)
        per_step = max(1, STEP // (width * width * m))
        lines = max(1, min(width, STEP // (width * m)))
        for t in range(0, len(tiles), per_step):
            some = tiles[t : t + per_step]
            place = starts[some][:, None] + np.arange(width)[None, :]
            real = place < starts[some + 1][:, None]
            place = np.where(real, place, 0)
            for at in range(0, width, lines):
                here, has = place[:, at : at + lines], real[:, at : at + lines]
                ok = has[:, :, None] & real[:, None, :]
                ok &= np.maximum(size[here][:, :, None], size[place][:, None, :]) == m
                ok &= here[:, :, None] != place[:, None, :]
                k, a, b = np.nonzero(ok)
                for s in range(0, len(k), max(1, STEP // m)):
                    cut = slice(s, s + max(1, STEP // m))
                    x, y = here[k[cut], a[cut]], place[k[cut], b[cut]]
                    prefix = common_ends(aligned[x], aligned[y])
                    inside = (prefix >= low) & (prefix < high)
                    x, y, prefix = x[inside], y[inside], prefix[inside]
                    near = prefix + common_ends(reversed_[x], reversed_[y]) >= m - 1
                    left.append(x[near])
                    right.append(y[near])
    if not left:
        return np.zeros(0, int), np.zeros(0, int)
    x, y = np.concatenate(left), np.concatenate(right)
    return x, y


_FOUND = "word string, n_near long, best_n long, best string"


def _compare(table: pa.Table) -> pa.Table:
    """The near words inside a group of tiles: per word and tile their number and the most frequent."""
    table = table.sort_by([(c, "ascending") for c in ("part", "bucket", "i", "j", "b")])
    part, bucket, i, j, b, n = (table.column(c).to_numpy() for c in ("part", "bucket", "i", "j", "b", "n"))
    words = table.column("word").to_pylist()
    size = np.fromiter((len(w) for w in words), np.int64, len(words))
    fresh = np.ones(len(words), bool)
    fresh[1:] = (np.diff(part) != 0) | (np.diff(bucket) != 0) | (np.diff(i) != 0) | (np.diff(j) != 0)
    out: dict[str, list] = {"word": [], "n_near": [], "best_n": [], "best": []}
    edges = np.flatnonzero(np.r_[True, np.diff(part) != 0, True]) if len(words) else []
    for first, end in zip(edges[:-1], edges[1:]):
        m, q = divmod(int(part[first]), PARTS)
        own = words[first:end]
        rows = np.array(own, dtype=f"<U{m}").view(np.uint32).reshape(len(own), m)
        if rows.max() < 256:
            rows = rows.astype(np.uint8)
        starts = np.r_[np.flatnonzero(fresh[first:end]), end - first]
        x, y = _near_in(rows, size[first:end], starts, m, m * q // PARTS, m * (q + 1) // PARTS)
        # In a tile of two blocks only pairs across them count; the others have tiles of their own.
        across = (i[first + x] == j[first + x]) | (b[first + x] != b[first + y])
        x, y = x[across], y[across]
        if not len(x):
            continue
        rank = np.argsort(np.argsort(np.array(own)))
        order = np.lexsort((rank[y], -n[first + y], x))
        x, y = x[order], y[order]
        heads = np.flatnonzero(np.r_[True, x[1:] != x[:-1]])
        out["word"] += [own[k] for k in x[heads]]
        out["n_near"] += np.diff(np.r_[heads, len(x)]).tolist()
        out["best_n"] += n[first + y[heads]].tolist()
        out["best"] += [own[k] for k in y[heads]]
    return pa.table(out, schema=pa.schema(
        [("word", pa.string()), ("n_near", pa.int64()), ("best_n", pa.int64()), ("best", pa.string())]
    ))


def near_words(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """For each word with near ones: ``n_near``, and of these the most frequent ``best`` with ``best_n``.

    ``words`` (staged) has different words and their counts ``n``.  Equal counts fall to the word that is
    first in code-point order.
    """
    tiles = _tiles(words, block)
    found = tiles.groupBy("deal").applyInArrow(_compare, _FOUND)
    return found.groupBy("word").agg(
        F.sum("n_near").alias("n_near"),
        F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("word"))).alias("top"),
    ).select("word", "n_near", F.col("top.word").alias("best"), (-F.col("top.less")).alias("best_n"))


def _roots(forms: DataFrame) -> DataFrame:
    """The last word that forms lead to: word and root.  Counts rise along a chain, so it has an end."""
    step = stage(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        onward = step.select(F.col("word").alias("k"), F.col("root").alias("next"))
        joined = step.join(onward, F.col("root") == F.col("k"), "left")
        step = stage(joined.select("word", F.coalesce("next", "root").alias("root"), F.col("k").isNotNull().alias("moved")), "forms")
        if step.filter("moved").isEmpty():
            return step.select("word", "root")
        step = step.drop("moved")


def group_variants(counts: DataFrame, ratio: int = 10, least: int = 2, block: int = BLOCK) -> DataFrame:
    """Words with the form that each is a variant of, and the root that forms lead to.

    ``counts`` has different words and their occurrences ``n``; those of at least ``least`` take part.
    A word's form is its near word of largest n (ties: the first in code-point order) if that is at
    least ``ratio`` times its own; else NULL, and the word is its own root.

    Returns word, form, root, n, n_near (0 if none) and form_n.  NULL words are left out; an empty
    table gives no rows.
    """
    if ratio < 2:
        raise ValueError("ratio must be 2 or more, else forms may lead in a circle")
    words = stage(counts.filter(F.col("word").isNotNull() & (F.col("n") >= least)).select("word", "n"), "words")
    near = near_words(words, block).withColumnRenamed("word", "k")
    formed = F.col("best_n") >= F.col("n") * ratio
    linked = stage(words.join(near, F.col("word") == F.col("k"), "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
        F.when(formed, F.col("best")).alias("form"), F.when(formed, F.col("best_n")).alias("form_n"),
    ), "linked")
    roots = _roots(linked.filter(F.col("form").isNotNull()))
    ends = roots.select(F.col("word").alias("k"), "root")
    out = linked.join(ends, F.col("word") == F.col("k"), "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
