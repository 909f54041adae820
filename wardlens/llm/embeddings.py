"""Near-duplicate vectors by an inverted multi-index over the halves of the vectors."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType

from wardlens.llm.common import AT_ONCE, sliced
from wardlens.llm.components import SpanningForest, components
from wardlens.sources.staging import stage

#: Components of vectors that are multiplied at once when pairs are verified.
VALUES = 1 << 20
#: Rows of vectors and cells that a worker hands over at once.
SPREAD_ROWS = 1 << 13


@dataclass(frozen=True)
class Index:
    """How the index is fitted and searched.

    The codebooks are fitted on at most ``sample_rows`` vectors, those with the smallest hashes,
    and every vector is indexed.  A half's codebook has about the square root of
    (vectors / ``cell_rows``) entries, at most ``most_codes``.  ``recall`` is the share of pairs
    just at the threshold that a search should meet.  Cells with more than ``block_rows`` vectors
    are compared in blocks.
    """

    sample_rows: int = 20_000
    cell_rows: int = 64
    most_codes: int = 1024
    recall: float = 0.99
    block_rows: int = 2_000


PRODUCTION = Index()


@dataclass(frozen=True)
class Codebooks:
    """Two codebooks for vectors of one width, and the margin up to which cells are visited."""

    left: np.ndarray
    right: np.ndarray
    margin: float

    def distances(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Squared distances of the halves to their codes.

        Each is a sum over one row, so a vector has the same figures in every batch.
        """
        cut = self.left.shape[1]
        out = []
        for half, codes in ((unit[:, :cut], self.left), (unit[:, cut:], self.right)):
            near = np.empty((len(half), len(codes)))
            for i, code in enumerate(codes):
                near[:, i] = np.square(half - code).sum(axis=1)
            out.append(near)
        return out[0], out[1]

    def cells(self, unit: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """Each vector's own cell, and the cells to visit, nearest first, up to the margin."""
        a, b = self.distances(unit)
        home = a.argmin(axis=1) * len(self.right) + b.argmin(axis=1)
        a, b = a - a.min(axis=1, keepdims=True), b - b.min(axis=1, keepdims=True)
        rows, columns = np.argsort(a, axis=1), np.argsort(b, axis=1)
        for v in range(len(unit)):
            x, y = a[v, rows[v]], b[v, columns[v]]
            # The two sorted lists are walked together: for each left code, in order, the right
            # codes whose sum stays within the margin.
            reach = np.searchsorted(y, self.margin - x[x <= self.margin], side="right")
            left = np.repeat(rows[v, : len(reach)], reach)
            right = columns[v, np.concatenate([np.arange(r) for r in reach])]
            order = np.argsort(a[v, left] + b[v, right], kind="stable")
            yield int(home[v]), (left * len(self.right) + right)[order]

    def homes(self, unit: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """The own cells of the given rows, each different one measured once."""
        each, at = np.unique(rows, return_inverse=True)
        a, b = self.distances(unit[each])
        return (a.argmin(axis=1) * len(self.right) + b.argmin(axis=1))[at]

    def visits(self, unit: np.ndarray, rows: np.ndarray, cells: np.ndarray) -> np.ndarray:
        """Whether the given rows visit the cells beside them; each different row is measured once."""
        each, at = np.unique(rows, return_inverse=True)
        a, b = self.distances(unit[each])
        left, right = np.divmod(cells, len(self.right))
        # The same comparison as in ``cells``: the right share against what the left one leaves.
        x, y = a[at, left] - a.min(axis=1)[at], b[at, right] - b.min(axis=1)[at]
        return (x <= self.margin) & (y <= self.margin - x)


def _codes(points: np.ndarray, number: int, draws: np.random.Generator) -> np.ndarray:
    """Centres of a few rounds of k-means."""
    number = min(number, len(points))
    centres = points[draws.choice(len(points), number, replace=False)]
    for _ in range(12):
        scores = points @ centres.T - np.square(centres).sum(axis=1) / 2
        nearest = scores.argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, points)
        sizes = np.bincount(nearest, minlength=number)
        centres = np.where(sizes[:, None] > 0, sums / np.maximum(sizes, 1)[:, None], centres)
    return centres


def fit(sample: np.ndarray, rows: int, threshold: float, index: Index) -> Codebooks:
    """Codebooks from unit vectors, and the margin that meets the target recall.

    The margin comes from partners made at just the threshold in random directions: it is the
    quantile, at the target recall, of the smaller of the two margins by which one of the pair
    finds the other's cell.
    """
    draws = np.random.default_rng(17)
    number = 2 ** round(math.log2(max(4, math.sqrt(rows / index.cell_rows))))
    number = min(number, index.most_codes)
    cut = max(1, sample.shape[1] // 2)
    books = Codebooks(_codes(sample[:, :cut], number, draws), _codes(sample[:, cut:], number, draws), 0.0)
    x = sample[draws.integers(0, len(sample), 4000)]
    u = draws.normal(size=x.shape)
    u -= (u * x).sum(axis=1, keepdims=True) * x
    norm = np.linalg.norm(u, axis=1, keepdims=True)
    u = np.where(norm > 0, u / np.where(norm > 0, norm, 1), 0)
    y = threshold * x + math.sqrt(max(0.0, 1 - threshold**2)) * u
    at = np.arange(len(x))
    (ax, bx), (ay, by) = books.distances(x), books.distances(y)

    def margin(a, b, c, d):
        return a[at, c.argmin(axis=1)] - a.min(axis=1) + b[at, d.argmin(axis=1)] - b.min(axis=1)

    nearer = np.minimum(margin(ax, bx, ay, by), margin(ay, by, ax, bx))
    return Codebooks(books.left, books.right, float(np.quantile(nearer, index.recall)))


def _unit(packed: list[bytes], kind: str) -> tuple[np.ndarray, np.ndarray]:
    """The vectors in double precision, and as unit vectors."""
    raw = np.frombuffer(b"".join(packed), kind).reshape(len(packed), -1).astype(np.float64)
    scaled = raw / np.abs(raw).max(axis=1, keepdims=True)
    return raw, scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def _dots(x: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Dot products of the rows ``i`` with the rows ``j``; a part of them at a time, as pairs may be many."""
    step = max(1, VALUES // max(1, x.shape[1]))
    out = np.empty(len(i))
    for lo in range(0, len(i), step):
        out[lo : lo + step] = (x[i[lo : lo + step]] * x[j[lo : lo + step]]).sum(axis=1)
    return out


def _met(
    raw: np.ndarray, node: np.ndarray, is_home: np.ndarray, unit: np.ndarray, threshold: float,
    book: Codebooks | None, cell: int,
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The linked pairs of a cell's visitors and its vectors at home that count there, part by part.

    A cell of near copies has about as many pairs as rows times rows, so nothing but a pair's place
    is held for all of a part: vectors are multiplied some at a time, and measured once each.
    """
    homes, guests = np.flatnonzero(is_home), np.flatnonzero(~is_home)
    at_home, norms = unit[homes], np.sqrt(np.square(raw).sum(axis=1))
    for lo in range(0, len(guests), 512):
        some = guests[lo : lo + 512]
        q, h = np.nonzero(unit[some] @ at_home.T >= threshold - 1e-9)
        q, h = some[q], homes[h]
        other = node[q] != node[h]
        q, h = q[other], h[other]
        # The cosine of the vectors themselves decides.
        good = _dots(raw, q, h) / (norms[q] * norms[h]) >= threshold
        q, h = q[good], h[good]
        if book and len(q):
            own = book.homes(unit, q)
            back = book.visits(unit, h, own)
            # A pair that meets in both cells counts in the first of them.
            once = np.where(own == cell, node[q] < node[h], ~back | (cell < own))
        else:
            once = node[q] < node[h]
        yield q[once], h[once]


def _spread(
    at: np.ndarray, cells: Iterable[tuple[int, np.ndarray]]
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The vectors ``at`` by their cells: the vector, the cell, and whether it is its own, in parts."""
    rows, size = [], 0
    for rest, (i, (home, visits)) in zip(range(len(at) - 1, -1, -1), zip(at, cells)):
        n = 1 + len(visits)
        rows.append((np.full(n, i), np.concatenate(([home], visits)), np.arange(n) == 0))
        size += n
        if size >= SPREAD_ROWS or not rest:
            owner, cell, own = (np.concatenate(x) for x in zip(*rows))
            for lo in range(0, size, SPREAD_ROWS):
                part = slice(lo, lo + SPREAD_ROWS)
                yield owner[part], cell[part], own[part]
            rows, size = [], 0


def linked_vectors(
    vectors: DataFrame,
    threshold: float = 0.93,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    label_col: str = "label",
    index: Index = PRODUCTION,
) -> DataFrame:
    """One row per vector: the id, ``n_links``, ``component_id`` and ``kept``.

    Vectors link when their labels are equal and not NULL and their cosine, in double precision,
    is at least ``threshold``.  ``n_links`` counts the other rows linked directly, copies
    included; ``component_id`` is the smallest id reachable over links, the row's own included;
    ``kept`` tells whether that is the row's own.  NULL, empty and zero vectors, and those with
    NULL or non-finite components, link with nothing; nor do vectors of different widths.
    Repeated rows are vectors of their own and link.  A row with a NULL id is never the smallest;
    where no id is reachable, ``component_id`` is NULL and ``kept`` true.  An empty table gives
    no rows.
    """
    spark = vectors.sparkSession
    double = isinstance(vectors.schema[vec_col].dataType.elementType, DoubleType)
    kind = "<f8" if double else "<f4"
    id_type = vectors.schema[id_col].dataType.simpleString()
    label_type = vectors.schema[label_col].dataType.simpleString()

    def packed(batches):
        for batch in sliced(batches, AT_ONCE):
            out = []
            for values in batch.column(2).to_pylist():
                found = None
                if values and None not in values:
                    x = np.array(values, kind)
                    if np.isfinite(x).all() and x.any():
                        found = x.tobytes()
                out.append(found)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(out, pa.binary())], ["id", "label", "vec"]
            )

    rows = stage(
        vectors.select(id_col, label_col, vec_col).mapInArrow(
            packed, f"id {id_type}, label {label_type}, vec binary"
        ),
        "vectors",
    )
    usable = rows.filter("label IS NOT NULL AND vec IS NOT NULL")
    # Equal vectors of a label are one node with a number of copies.
    distinct = stage(
        usable.groupBy("label", "vec")
        .agg(F.min("id").alias("least"), F.count("*").alias("copies"))
        .withColumn("node", F.monotonically_increasing_id()),
        "nodes",
    )
    total = distinct.count()
    sample = distinct.orderBy(F.xxhash64("vec"), "node").limit(index.sample_rows).select("vec").collect()
    widths: dict[int, list[bytes]] = {}
    for (vec,) in sample:
        widths.setdefault(len(vec), []).append(bytes(vec))
    books = {w: fit(_unit(v, kind)[1], total, threshold, index) for w, v in widths.items()}
    # A width that the sample has none of gets a single cell.
    lone = Codebooks(np.zeros((1, 0)), np.zeros((1, 0)), 0.0)

    def cells(batches):
        for batch in sliced(batches, AT_ONCE):
            names = ["label", "width", "cell", "home", "node", "copies", "vec"]
            vecs = batch.column(batch.schema.get_field_index("vec")).to_pylist()
            sizes = np.array([len(v) for v in vecs], np.int64)
            for width in np.unique(sizes):
                at = np.flatnonzero(sizes == width)
                book = books.get(int(width), lone)
                if book is not lone:
                    found = book.cells(_unit([vecs[i] for i in at], kind)[1])
                else:
                    found = ((0, np.zeros(1, np.int64)) for _ in at)
                for owner, cell, own in _spread(at, found):
                    take = pa.array(owner)
                    columns = {
                        "label": batch.column(batch.schema.get_field_index("label")).take(take),
                        "width": pa.array(np.full(len(owner), width), pa.int64()),
                        "cell": pa.array(cell, pa.int64()),
                        "home": pa.array(own),
                        "node": batch.column(batch.schema.get_field_index("node")).take(take),
                        "copies": batch.column(batch.schema.get_field_index("copies")).take(take),
                        "vec": batch.column(batch.schema.get_field_index("vec")).take(take),
                    }
                    yield pa.RecordBatch.from_arrays([columns[n] for n in names], names)

    spread = distinct.select("label", "node", "copies", "vec").mapInArrow(
        cells,
        f"label {label_type}, width long, cell long, home boolean, node long, copies long, vec binary",
    )
    size = index.block_rows
    key = ["label", "width", "cell"]
    # Written first, so that the join deals both sides anew and a large cell can be split.
    cuts = stage(
        spread.groupBy(*key).agg(
            F.ceil(F.count_if("home") / size).cast("int").alias("homes"),
            F.ceil(F.count_if(~F.col("home")) / size).cast("int").alias("visitors"),
        ).filter("homes > 0"),
        "cells",
    )
    slice_of = F.xxhash64("node")
    placed = spread.join(cuts, key)
    # A vector at home meets the visitors of its cell slice by slice, and a visitor the homes.
    mine = F.when(F.col("home"), F.pmod(slice_of, F.col("homes"))).otherwise(
        F.pmod(slice_of, F.col("visitors"))
    )
    other = F.when(F.col("home"), F.col("visitors")).otherwise(F.col("homes"))
    placed = placed.withColumn("mine", mine).withColumn(
        "other", F.explode(F.sequence(F.lit(0).cast("long"), other - F.lit(1).cast("long")))
    )
    blocks = placed.select(
        *key, "home", "node", "copies", "vec",
        F.when(F.col("home"), F.col("mine")).otherwise(F.col("other")).alias("h"),
        F.when(F.col("home"), F.col("other")).otherwise(F.col("mine")).alias("v"),
    )

    def compare(group: pa.Table) -> pa.Table:
        is_home = group.column("home").to_numpy()
        node, copies = group.column("node").to_numpy(), group.column("copies").to_numpy()
        cell, width = group.column("cell")[0].as_py(), group.column("width")[0].as_py()
        raw, unit = _unit(group.column("vec").to_pylist(), kind)
        forest, links = SpanningForest(len(node)), np.zeros(len(node), np.int64)
        for q, h in _met(raw, node, is_home, unit, threshold, books.get(width), cell):
            np.add.at(links, q, copies[h])
            np.add.at(links, h, copies[q])
            forest.add(q, h)
        some = np.flatnonzero(links)
        child, parent = forest.edges()
        return pa.table({
            "a": pa.array(np.concatenate([node[some], node[child]]), pa.int64()),
            "b": pa.array(np.concatenate([node[some], node[parent]]), pa.int64()),
            "links": pa.array(np.concatenate([links[some], np.zeros(len(child), np.int64)]), pa.int64()),
        })

    # Dealt by block: by cell alone, as the join leaves them, a large cell's blocks meet in one task.
    dealt = blocks.repartition(*key, "h", "v").groupBy(*key, "h", "v")
    met = stage(dealt.applyInArrow(compare, "a long, b long, links long"), "links")
    counts = met.groupBy(F.col("a").alias("_c")).agg(F.sum("links").alias("met"))
    reached = components(met.filter("a <> b").select("a", "b"))
    nodes = (
        distinct.join(counts, F.col("node") == F.col("_c"), "left")
        .join(reached.withColumnRenamed("node", "_n"), F.col("node") == F.col("_n"), "left")
        .withColumn("class", F.coalesce("component", "node"))
    )
    nodes = stage(
        nodes.select("label", "vec", "least", "class",
                     (F.coalesce("met", F.lit(0)) + F.col("copies") - 1).alias("n_links")),
        "classes",
    )
    smallest = nodes.groupBy("class").agg(F.min("least").alias("component_id"))
    named = nodes.join(smallest, "class").select(
        F.col("label").alias("_l"), F.col("vec").alias("_v"), "n_links", "component_id"
    )
    joined = rows.join(named, (F.col("label") == F.col("_l")) & (F.col("vec") == F.col("_v")), "left")
    own = F.when(F.col("_v").isNotNull(), F.col("component_id")).otherwise(F.col("id"))
    return joined.select(
        F.col("id").alias(id_col),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        own.alias("component_id"),
        F.coalesce(F.col("id") == own, own.isNull()).alias("kept"),
    )
