"""Best-fit packing planned on the histogram of lengths."""

from __future__ import annotations

import base64
from bisect import bisect_left, insort
from collections.abc import Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from wardlens.llm.common import map_batches, placed_in_keys, text_bytes
from wardlens.sources.staging import stage

#: Distinct chunks of text whose ids one Python worker remembers.
REMEMBERED = 300_000
_encoders: dict[tuple[str, str], "ChunkEncoder"] = {}


class ChunkEncoder:
    """Token ids of texts, each distinct chunk encoded once.

    The byte-level vocabulary never joins a letter to the space after it, so a text may be cut
    before each space that a visible character follows, and the ids of the chunks in a row are
    those of the text.  ``ranks`` and ``vocabulary`` hold the same byte-pair vocabulary; texts
    that name a special token are left to the full tokenizer.
    """

    def __init__(self, vocabulary: str, ranks: str):
        import re

        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        with open(ranks, "rb") as lines:
            merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.parts = re.compile(r" (?=\S)").split
        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.encode = tiktoken.Encoding(
            "chunks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=merges, special_tokens={}
        ).encode_ordinary
        self.known: dict[str, bytes] = {}

    def ids(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        if any(s in text for s in self.special):
            found = self.tokenizer.encode(text, add_special_tokens=False).ids
            return np.array(found, "<u4").tobytes()
        first, *rest = self.parts(text)
        known = self.known
        out = [np.array(self.encode(first), "<u4").tobytes()]
        try:
            out += map(known.__getitem__, rest)
        except KeyError:
            if len(known) > REMEMBERED:
                known.clear()
            for part in set(rest).difference(known):
                known[part] = np.array(self.encode(" " + part), "<u4").tobytes()
            out[1:] = map(known.__getitem__, rest)
        return b"".join(out)


def encoder(vocabulary: str, ranks: str) -> ChunkEncoder:
    """This worker's encoder for the given files."""
    key = (vocabulary, ranks)
    if key not in _encoders:
        _encoders[key] = ChunkEncoder(*key)
    return _encoders[key]


def cut_documents(
    docs: DataFrame,
    vocabulary: str,
    ranks: str,
    capacity: int = 2048,
    end_id: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Tokenize texts and cut those longer than ``capacity``: one row per piece.

    Columns: the id, ``piece`` (from 0), ``start`` (ids before it), ``length``, ``ids``
    (little-endian unsigned 32-bit).  A document is its ids and ``end_id``.  Of a long one the
    first piece takes the remainder, the others are full.  A NULL or empty text is ``end_id``
    alone.  Ids are copied, NULL or repeated; every row is a document of its own.
    """
    end = np.array([end_id], "<u4").tobytes()
    id_type = docs.schema[id_col].dataType.simpleString()
    width = 4 * capacity

    def rows(batch: pa.RecordBatch) -> dict[str, object]:
        ids_of = encoder(vocabulary, ranks).ids
        owner, piece, start, ids = [], [], [], []
        for i, text in enumerate(batch.column(1).to_pylist()):
            whole = ids_of(text.decode("utf-8", "replace")) + end
            head = len(whole) % width
            cuts = ([0] if head else []) + list(range(head, len(whole), width)) + [len(whole)]
            for j, (a, b) in enumerate(zip(cuts, cuts[1:])):
                owner.append(i)
                piece.append(j)
                start.append(a // 4)
                ids.append(whole[a:b])
        return {
            id_col: batch.column(0).take(pa.array(owner, pa.int64())),
            "piece": piece,
            "start": start,
            "length": [len(x) // 4 for x in ids],
            "ids": ids,
        }

    picked = docs.select(id_col, text_bytes(text_col).alias("_text"))
    schema = f"`{id_col}` {id_type}, piece int, start long, length long, ids binary"
    return map_batches(picked, rows, schema)


def best_fit_plan(counts: Mapping[int, int], capacity: int) -> list[tuple[int, ...]]:
    """Places for ``counts[length]`` items of each length, longest first, each in the tightest gap.

    Returns (length, first rank, end rank, items a sequence, first sequence, offset): the items of
    a length with ranks in [first, end) fill ``items`` places each in consecutive sequences, from
    ``offset`` on.  Work and result depend on the number of lengths, not of items: sequences with
    the same gap are filled together.
    """
    gaps: dict[int, list[tuple[int, int]]] = {}
    sizes: list[int] = []
    plan, opened = [], 0

    def add(gap: int, first: int, number: int) -> None:
        if gap and number:
            if gap not in gaps:
                gaps[gap] = []
                insort(sizes, gap)
            gaps[gap].append((first, number))

    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            at = bisect_left(sizes, length)
            if at < len(sizes):
                gap = sizes[at]
                first, number = gaps[gap].pop()
                if not gaps[gap]:
                    del gaps[gap], sizes[at]
            else:
                gap, first, number = capacity, opened, left
            items = min(gap // length, left)
            filled = min(number, left // items)
            if gap == capacity:
                opened += filled
            else:
                add(gap, first + filled, number - filled)
            add(gap - items * length, first, filled)
            plan.append((length, rank, rank + items * filled, items, first, capacity - gap))
            rank += items * filled
            left -= items * filled
    return plan


def pack(pieces: DataFrame, capacity: int = 2048, id_col: str = "doc_id") -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces of at most ``capacity`` tokens.

    ``pieces`` needs the id, ``piece``, ``start`` and ``length`` (1 to ``capacity``); other
    columns stay.  The driver sees the histogram of lengths, at most ``capacity`` rows, and
    plans on it; pieces then find their place by their rank among those of their length.  Equal
    rows are different pieces.  An empty table gives no rows.
    """
    spark = pieces.sparkSession
    staged = stage(pieces, "pieces")
    counts = {r["length"]: r["n"] for r in staged.groupBy("length").agg(F.count("*").alias("n")).collect()}
    if any(not 1 <= length <= capacity for length in counts):
        raise ValueError(f"pieces must have 1 to {capacity} tokens")
    plan = spark.createDataFrame(
        best_fit_plan(counts, capacity),
        "_length long, _from long, _to long, _items long, _first long, _base long",
    )
    order = [id_col, "piece", "start"]
    ranked = placed_in_keys(staged, ["length"], order, "_rank")
    inside = F.col("_rank") - F.col("_from")
    # The plan has a row per (length, gap) at most: its size is bounded by capacity, not by the data.
    return ranked.join(
        F.broadcast(plan),
        (F.col("length") == F.col("_length"))
        & (F.col("_rank") >= F.col("_from"))
        & (F.col("_rank") < F.col("_to")),
    ).select(
        *staged.columns,
        (F.col("_first") + F.expr("(_rank - _from) div _items")).alias("sequence_id"),
        (F.col("_base") + (inside % F.col("_items")) * F.col("length")).alias("offset"),
    )


def assemble(packed: DataFrame) -> DataFrame:
    """The sequences themselves: ``sequence_id``, ``n_tokens``, ``ids`` from packed pieces with ``ids``.

    A group is one sequence, so it is never longer than the capacity.
    """
    parts = F.array_sort(F.collect_list(F.struct("offset", F.hex("ids").alias("ids"))))
    return packed.groupBy("sequence_id").agg(
        F.sum("length").alias("n_tokens"),
        F.unhex(F.array_join(F.transform(parts, lambda p: p["ids"]), "")).alias("ids"),
    )
