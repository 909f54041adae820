"""Substring deduplication by merged Burrows-Wheeler transforms.

Texts are cut into phrases at places that the bytes around them choose, and the phrases are the symbols.
Documents are dealt to shards of bounded size; each shard sorts its own suffixes once and keeps its
transform: the symbol before each suffix, in suffix order, and where that longer suffix stands.  The
shards' orders are then merged by refinement: what is known after k steps is, for each string of k
symbols that occurs more than once in the corpus, its interval in each shard.  A step takes the symbols
before an interval, which gives the intervals of the strings of k + 1 symbols, and the shards' lists of
these, interleaved by Spark, say which still occur elsewhere.  No suffixes are sorted again.  A suffix's
number of steps is the common prefix that it has with another one.

Symbols stand in the order of their 64-bit hashes, as a string's interval does after the first step: any
order groups equal prefixes.  Byte steps would need 200 rounds over all bytes; with phrases the steps end
after about six, as soon as an interval's string fills the part of a match whose phrases do not depend
on the bytes around the match.  What starts a match in bytes is then decided exactly, by the 200 bytes
at each place left, within the repeated intervals found.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from wardlens.llm.common import arrow_schema, unused
from wardlens.sources.staging import discard, stage_lean

#: Bytes of text that a shard gathers; a longer document is a shard of its own.
SHARD_BYTES = 4 << 20
#: Keys of a bucket, about; a bucket's keys from all shards meet in one task.
BUCKET_KEYS = 1 << 19
#: Symbols up to which intervals are refined; a string of that many short phrases counts as long enough.
STEPS = 12
#: Refinement also ends when fewer than one in so many of the first intervals are left; those count as long enough.
FEW = 100
#: Places that may start a match whose documents are put together in one case, about.
CASE_PLACES = 2 << 20
#: Bytes that choose a cut together, before the window is taken.
GRAM = 8
#: Positions that are hashed in one piece.
PIECE = 1 << 20

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


@dataclass(frozen=True)
class Match:
    """A match is a string of ``length`` bytes.  Any ``window`` places hold a cut, and the cuts from
    ``first`` to ``last`` bytes after a match's start are the same wherever it stands."""

    length: int = 200

    @property
    def window(self) -> int:
        return (self.length - GRAM) // 4

    @property
    def first(self) -> int:
        return self.window - 1

    @property
    def last(self) -> int:
        return self.length - self.window - GRAM + 1


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def _powers(base: int) -> np.ndarray:
    steps = np.full(PIECE + 1, base, np.uint64)
    steps[0] = 1
    return np.cumprod(steps, dtype=np.uint64)


_tables: list[np.ndarray] = []


def _hash_piece(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    if not _tables:
        _tables.extend((_powers(_BASE), _powers(_INVERSE)))
    up, down = _tables
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(77)) * up[: len(data)], dtype=np.uint64, out=sums[1:])
    return _mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def range_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte range; ranges ascend and none is as long as a piece."""
    out, at = np.empty(len(starts), np.uint64), 0
    while at < len(starts):
        base = int(starts[at])
        to = max(at + 1, int(np.searchsorted(ends, base + PIECE, "right")))
        out[at:to] = _hash_piece(data[base : int(ends[to - 1])], starts[at:to] - base, ends[at:to] - base)
        at = to
    return out


def _extreme(x: np.ndarray, width: int, pick: np.ufunc) -> np.ndarray:
    """The least or greatest of each ``width`` consecutive values."""
    step = 1
    while step * 2 <= width:
        x = pick(x[:-step], x[step:])
        step *= 2
    return pick(x[: len(x) - (width - step)], x[width - step :]) if width > step else x


def _cuts_of_piece(data: np.ndarray, window: int) -> np.ndarray:
    grams = len(data) - GRAM + 1
    if grams < window:
        return np.zeros(0, np.int64)
    raw, gram = data.tobytes(), np.empty(grams, np.uint64)
    for k in range(min(GRAM, grams)):
        gram[k::GRAM] = np.frombuffer(raw, "<u8", count=(len(data) - k) // GRAM, offset=k)[: len(gram[k::GRAM])]
    mark = (_mixed(gram) >> np.uint64(32)).astype(np.uint32)
    least = _extreme(mark, window, np.minimum)
    padded = np.zeros(len(least) + 2 * (window - 1), np.uint32)
    padded[window - 1 : window - 1 + len(least)] = least
    return np.flatnonzero(mark == _extreme(padded, window, np.maximum))


def cuts(data: np.ndarray, match: Match) -> np.ndarray:
    """Where phrases begin: places whose gram has the least hash of some window that holds it.

    Equal hashes all count, so a place is a cut by the bytes near it alone.
    """
    reach, found = match.window + GRAM, []
    for start in range(0, len(data), PIECE):
        low, high = max(0, start - reach), min(len(data), start + PIECE + reach)
        here = _cuts_of_piece(data[low:high], match.window) + low
        found.append(here[(here >= start) & (here < start + PIECE)])
    return np.concatenate(found) if found else np.zeros(0, np.int64)


# --- exchange of keys between shards -----------------------------------------------------------


def _buckets_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """The edges of each bucket in sorted keys; buckets are ranges of the keys' upper half."""
    bucket = ((keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    return np.searchsorted(bucket, np.arange(buckets + 1, dtype=np.uint64))


def _packed(keys: np.ndarray, width: int) -> bytes:
    return np.ascontiguousarray(keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]).tobytes()


def _unpacked(raw: bytes, width: int) -> np.ndarray:
    out = np.zeros((len(raw) // width, 8), np.uint8)
    out[:, :width] = np.frombuffer(raw, np.uint8).reshape(-1, width)
    return out.view("<u8").ravel()


def _found_elsewhere(table: pa.Table, width: int) -> pa.Table:
    """Which keys of a bucket more than one shard has: one bit per key sent."""
    sent = [_unpacked(raw.as_py(), width) for raw in table.column("keys")]
    every = np.sort(np.concatenate(sent))
    again = every[1:][every[1:] == every[:-1]]
    bits = []
    for keys in sent:
        place = np.searchsorted(again, keys)
        place[place == len(again)] = 0
        bits.append(np.packbits(again[place] == keys if len(again) else np.zeros(len(keys), bool)).tobytes())
    return pa.table(
        [table.column("shard"), table.column("bucket"), pa.array(bits, pa.binary())], names=["shard", "bucket", "bits"]
    )


def _exchange(senders: DataFrame, keys_of, count: int, width: int) -> tuple[DataFrame, int]:
    """Per shard which of its keys another shard has too, and the number of buckets.

    ``keys_of`` maps a sender's row (a dict) to sorted different 64-bit keys.  ``width`` bytes of each are
    sent, beside the bucket: 4 leave one chance match in 8,000, 7 none.
    """
    buckets = count // BUCKET_KEYS + 1
    target = arrow_schema("shard long, bucket int, keys binary")

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = _row(batch, i)
                keys = keys_of(row)
                edges = _buckets_of(keys, buckets)
                full = np.flatnonzero(np.diff(edges))
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(full), row["shard"], np.int64)), pa.array(full.astype(np.int32)),
                    pa.array([_packed(keys[edges[b] : edges[b + 1]], width) for b in full], pa.binary()),
                ], schema=target)

    sent = senders.mapInArrow(send, "shard long, bucket int, keys binary")
    met = sent.groupBy("bucket").applyInArrow(
        lambda table: _found_elsewhere(table, width), "shard long, bucket int, bits binary"
    )
    answers = met.groupBy(F.col("shard").alias("to")).agg(F.collect_list(F.struct("bucket", "bits")).alias("answers"))
    return stage_lean(answers, "answers"), buckets


def _row(batch: pa.RecordBatch, i: int) -> dict[str, object]:
    return {name: column[i].as_py() for name, column in zip(batch.schema.names, batch.columns)}


def _answered(keys: np.ndarray, answers: list[dict] | None, buckets: int) -> np.ndarray:
    """The answers to a shard's sorted keys as booleans."""
    out, edges = np.zeros(len(keys), bool), _buckets_of(keys, buckets)
    for answer in answers or ():
        low, high = edges[answer["bucket"]], edges[answer["bucket"] + 1]
        out[low:high] = np.unpackbits(np.frombuffer(answer["bits"], np.uint8), count=high - low)
    return out


def _with_answers(shards: DataFrame, answers: DataFrame) -> DataFrame:
    return shards.join(answers, F.col("shard") == F.col("to"), "left").drop("to")


# --- shards and their transforms ---------------------------------------------------------------


def _shards(docs: DataFrame, match: Match, id_type: str) -> DataFrame:
    """The documents' phrases, gathered in shards where the scan reads them."""
    ddl = f"ids array<{id_type}>, rows array<long>, sizes array<int>, counts array<int>, least array<long>, syms binary, begins binary"
    target = arrow_schema(ddl)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, rows, sizes, counts, least, syms, begins, held = [], [], [], [], [], [], [], 0

        def out() -> pa.RecordBatch:
            columns = [[ids], [rows], [sizes], [counts], [least], [b"".join(syms)], [b"".join(begins)]]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, target.field(i).type) for i, c in enumerate(columns)], schema=target
            )

        for batch in batches:
            names = batch.column(0).to_pylist()
            hashes = batch.column(1).to_pylist()
            for k, text in enumerate(batch.column(2)):
                raw = text.as_buffer()
                if raw is None or raw.size < match.length:
                    continue
                data = np.frombuffer(raw, np.uint8)
                at = cuts(data, match)
                ids.append(names[k])
                rows.append(hashes[k])
                sizes.append(len(data))
                counts.append(len(at))
                own = range_hashes(data, at[:-1], at[1:])
                least.append(int(own.min() >> np.uint64(1)) if len(own) else 0)
                syms.append(own.tobytes())
                begins.append(at.astype("<i4").tobytes())
                held += len(data)
                if held >= SHARD_BYTES:
                    yield out()
                    ids, rows, sizes, counts, least, syms, begins, held = [], [], [], [], [], [], [], 0
        if ids:
            yield out()

    gathered = docs.mapInArrow(gather, ddl).withColumn("shard", F.monotonically_increasing_id())
    return stage_lean(gathered.withColumn("n", F.expr("length(syms) div 8")), "shards")


def _symbols(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A shard's different symbols, each phrase's place among them, and how often each occurs."""
    return np.unique(np.frombuffer(row["syms"], "<u8"), return_inverse=True, return_counts=True)


def _suffix_order(seq: np.ndarray) -> np.ndarray:
    """The suffixes of a sequence in the order of their first symbols (at least ``STEPS``)."""
    rank, step = seq.astype(np.int64), 1
    while step < STEPS + 1 and len(seq):
        after = np.zeros(len(rank), np.int64)
        after[: len(rank) - step] = rank[step:] + 1
        _, rank = np.unique(rank * (len(rank) + int(seq.max()) + 2) + after, return_inverse=True)
        step *= 2
    return np.argsort(rank, kind="stable")


_STATE = (
    "shard long, names binary, widths binary, bwt binary, steps binary, low binary, "
    "size binary, id binary, bytes binary, depth int, n long"
)
_TYPES = {
    "names": "<u8", "widths": "<u2", "bwt": "<i4", "steps": "u1", "low": "<i4", "size": "<i4", "id": "<u8",
    "bytes": "<u2",
}


def _arrays(row: dict) -> dict[str, np.ndarray]:
    return {name: np.frombuffer(row[name], kind) for name, kind in _TYPES.items()}


def _transform(row: dict, buckets: int, most: int) -> dict[str, object]:
    """A shard's transform over the symbols that occur more than once in the corpus.

    ``names`` and ``widths`` are these symbols' hashes and bytes; in suffix order, ``bwt`` is the symbol
    before (0: none), ``place`` the phrase.  The first intervals are those of single symbols.
    """
    names, of, times = _symbols(row)
    live = _answered(names, row["answers"], buckets) | (times > 1)
    counts = np.array(row["counts"], np.int64)
    begins = np.frombuffer(row["begins"], "<i4").astype(np.int64)
    is_last = np.zeros(len(begins), bool)
    is_last[np.cumsum(counts[counts > 0]) - 1] = True
    wide = np.diff(begins, append=0)[~is_last]
    owner = np.repeat(np.arange(len(counts)), np.maximum(counts - 1, 0))
    phrase = np.flatnonzero(live[of])
    number = np.cumsum(live)
    # Each row of adjacent live phrases, and a 0 after it.
    gap = np.ones(len(phrase), bool)
    gap[:-1] = (np.diff(phrase) != 1) | (np.diff(owner[phrase]) != 0)
    at = np.arange(len(phrase)) + np.r_[0, np.cumsum(gap)[:-1]] if len(phrase) else np.zeros(0, int)
    seq = np.zeros(len(phrase) + int(gap.sum()), np.int64)
    seq[at] = number[of[phrase]]
    spot = np.full(len(seq), -1, np.int64)
    spot[at] = phrase
    order = _suffix_order(seq)
    prior = order - 1
    bwt = np.where(prior >= 0, seq[prior], 0) if len(seq) else seq
    heads = seq[order]
    low = np.searchsorted(heads, np.arange(1, int(live.sum()) + 1))
    size = np.diff(np.r_[low, len(heads)])
    widths = np.zeros(int(live.sum()), np.int64)
    widths[number[of[phrase]] - 1] = wide[phrase]
    steps = np.where(spot[order] >= 0, 1, 0)
    open_ = widths < most
    return {
        "names": names[live], "widths": widths, "bwt": bwt, "place": spot[order], "steps": steps,
        "low": low[open_], "size": size[open_], "id": names[live][open_], "bytes": widths[open_], "depth": 1,
    }


def _before(bwt: np.ndarray) -> np.ndarray:
    """The place of the suffix that begins one symbol earlier, for each suffix.

    Suffixes that begin with one symbol stand in the order of what follows it, so they are met in the
    transform in their own order.  Suffixes equal in all symbols that are compared may swap places, which
    leaves every interval as it is.
    """
    places = np.arange(len(bwt))
    sorted_ = np.sort((bwt.astype(np.int64) << 32) | places) & 0xFFFFFFFF
    before = np.empty(len(bwt), np.int64)
    before[sorted_] = places
    return before


def _longer(state: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """The intervals of the strings one symbol longer: the symbols before each interval's suffixes."""
    low, size = state["low"].astype(np.int64), state["size"].astype(np.int64)
    which = np.repeat(np.arange(len(low)), size)
    suffix = np.arange(len(which)) - np.repeat(np.cumsum(size) - size, size) + low[which]
    symbol = state["bwt"][suffix]
    which, suffix, symbol = which[symbol > 0], suffix[symbol > 0], symbol[symbol > 0].astype(np.int64)
    group, first, times = np.unique(
        which * (len(state["names"]) + 1) + symbol, return_inverse=True, return_counts=True
    )[0:3]
    which, symbol = group // (len(state["names"]) + 1), group % (len(state["names"]) + 1)
    begin = np.full(len(group), len(state["bwt"]), np.int64)
    np.minimum.at(begin, first, _before(state["bwt"])[suffix])
    ids = _mixed(state["names"][symbol - 1] * np.uint64(_BASE) + state["id"][which])
    # Two strings of one hash are one key; the order makes keys ascend.
    order = np.argsort(ids, kind="stable")
    return {
        "low": begin[order], "size": times[order], "id": ids[order],
        "bytes": state["bytes"][which][order] + state["widths"][symbol - 1][order],
    }


def _refined(row: dict, buckets: int, most: int) -> dict[str, object]:
    """The state one step on: the longer intervals that occur elsewhere, and their suffixes' steps."""
    state, depth = _arrays(row), row["depth"] + 1
    new = _longer(state)
    keys, of, times = np.unique(new["id"], return_inverse=True, return_counts=True)
    live = (_answered(keys, row["answers"], buckets) | (times > 1))[of] | (new["size"] > 1)
    new = {name: values[live] for name, values in new.items()}
    steps = state["steps"].copy()
    which = np.repeat(np.arange(len(new["low"])), new["size"])
    suffix = np.arange(len(which)) - np.repeat(np.cumsum(new["size"]) - new["size"], new["size"]) + new["low"][which]
    steps[suffix] = depth
    open_ = new["bytes"] < most
    return {**state, "steps": steps, **{name: values[open_] for name, values in new.items()}, "depth": depth}


def _states(rows: DataFrame, make, schema: str, *args) -> DataFrame:
    """Apply a step to each shard's row."""
    target = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = _row(batch, i)
                state = make(row, *args)
                columns = {name: np.asarray(state[name]).astype(kind).tobytes() for name, kind in _TYPES.items()}
                columns["place"] = np.asarray(state.get("place", ())).astype("<i4").tobytes()
                columns |= {"shard": row["shard"], "depth": state["depth"], "n": len(state["low"])}
                yield pa.RecordBatch.from_arrays(
                    [pa.array([columns[f.name]], f.type) for f in target], schema=target
                )

    return stage_lean(rows.mapInArrow(run, schema), "transforms")


def _total(rows: DataFrame) -> int:
    return rows.agg(F.sum("n")).first()[0] or 0


def common_prefixes(shards: DataFrame, match: Match) -> tuple[DataFrame, DataFrame, int]:
    """Merge the shards: shard, and per suffix its phrase (``place``) and ``steps``, the symbols that
    it has in common with another suffix, as far as a match's inner part reaches.  The second result
    are the shards without their symbols, which replace ``shards``, the third is the number of symbols
    that counts as long enough.  What no later round reads is deleted as soon as that is so."""
    most = match.last - match.first
    answers, buckets = _exchange(shards.select("shard", "syms"), lambda row: _symbols(row)[0], _total(shards), 4)
    begun = _with_answers(shards.select("shard", "counts", "syms", "begins"), answers)
    first = _states(begun, _transform, f"{_STATE}, place binary", buckets, most)
    bare = stage_lean(shards.drop("syms"), "shards")
    discard(shards)
    state, places, depth, initial = first.drop("place"), first.select("shard", "place"), 1, _total(first)
    while depth < STEPS:
        count = _total(state)
        if count * FEW <= initial:
            break
        answers, buckets = _exchange(state, lambda row: np.unique(_longer(_arrays(row))["id"]), count, 8)
        state, old = _states(_with_answers(state, answers), _refined, _STATE, buckets, most), state
        if depth == 1:
            places = stage_lean(places, "places")
        discard(old)
        depth += 1
    places = places.select(F.col("shard").alias("to"), "place")
    return state.select("shard", "steps").join(places, F.col("shard") == F.col("to")).drop("to"), bare, depth


# --- from repeated intervals to bytes ----------------------------------------------------------


def _ranges_of(
    begins: np.ndarray, steps: np.ndarray, size: int, match: Match, enough: int
) -> tuple[np.ndarray, np.ndarray]:
    """Where a match may start in a document: first and last places.

    For a start whose first inner cut is f, the string of phrases from f up to the last inner cut must
    occur elsewhere, so that cut is at most f's number of steps away, or that number is ``enough``.
    """
    f = np.flatnonzero(steps)
    edges = np.r_[begins, np.full(enough + 2, size + match.length)]
    first = np.where(f > 0, begins[f - 1] - match.first + 1, 0)
    beyond = np.where(steps[f] < enough, edges[f + steps[f] + 1] - match.last - 1, size)
    last = np.minimum(np.minimum(begins[f] - match.first, beyond), size - match.length)
    first = np.maximum(first, 0)
    ok = first <= last
    return _joined(first[ok], last[ok], 1)


def _joined(first: np.ndarray, last: np.ndarray, gap: int) -> tuple[np.ndarray, np.ndarray]:
    """Ascending ranges with those that meet, or lie less than ``gap`` apart, made one."""
    if not len(first):
        return first, last
    top = np.maximum.accumulate(last)
    new = np.r_[True, first[1:] > top[:-1] + gap]
    ends = np.r_[np.flatnonzero(new)[1:] - 1, len(first) - 1]
    return first[new], top[ends]


def _candidates(shards: DataFrame, prefixes: DataFrame, match: Match, enough: int, id_type: str) -> DataFrame:
    """Documents with places where a match may start: id, row, shard, starts, ends and n places.

    Documents with the same least phrase, as most copies of a text have, are put in one new shard, whose
    equal places then go to the exchange once; those of a phrase with many places are dealt to several.
    """
    ddl = f"id {id_type}, row long, least long, starts array<int>, ends array<int>, n long"
    target = arrow_schema(ddl)
    known = prefixes.select(F.col("shard").alias("to"), "place", "steps")
    both = shards.select("shard", "ids", "rows", "sizes", "counts", "least", "begins").join(known, F.col("shard") == F.col("to"))

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row, out = _row(batch, i), []
                begins = np.frombuffer(row["begins"], "<i4").astype(np.int64)
                place = np.frombuffer(row["place"], "<i4")
                counts = np.array(row["counts"], np.int64)
                steps = np.zeros(int(np.maximum(counts - 1, 0).sum()), np.int64)
                steps[place[place >= 0]] = np.frombuffer(row["steps"], "u1")[place >= 0]
                cut, phrase = np.r_[0, np.cumsum(counts)], np.r_[0, np.cumsum(np.maximum(counts - 1, 0))]
                for d in range(len(counts)):
                    own = steps[phrase[d] : phrase[d + 1]]
                    if own.any():
                        first, last = _ranges_of(begins[cut[d] : cut[d + 1]], own, row["sizes"][d], match, enough)
                        if len(first):
                            out.append((row["ids"][d], row["rows"][d], row["least"][d], first.tolist(), last.tolist(),
                                        int((last - first + 1).sum())))
                columns = list(zip(*out)) if out else [[]] * 6
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, target.field(k).type) for k, c in enumerate(columns)], schema=target
                )

    found = both.mapInArrow(spread, ddl)
    # Rows equal in id and text have equal places; one entry stands for them.
    once = found.groupBy("id", "row").agg(F.min(F.struct("least", "starts", "ends", "n")).alias("at"))
    once = stage_lean(once.select("id", "row", "at.*"), "candidates")
    alike = once.groupBy("least").agg(F.sum("n").alias("places"))
    cells = alike.filter(F.col("places") > CASE_PLACES).select(
        F.col("least").alias("many"), F.ceil(F.col("places") / CASE_PLACES).alias("cells")
    )
    cell = F.when(F.col("cells").isNotNull(), F.pmod(F.xxhash64("id", "row"), F.col("cells"))).otherwise(F.lit(0))
    cases = F.lit(_total(once) // CASE_PLACES + 1).cast("bigint")
    dealt = once.join(cells, F.col("least") == F.col("many"), "left").withColumn(
        "shard", F.pmod(F.xxhash64("least", cell), cases)
    )
    return stage_lean(dealt.select("id", "row", "shard", "starts", "ends", "n"), "candidates")


def _cases(keyed: DataFrame, candidates: DataFrame, match: Match, id_type: str) -> DataFrame:
    """Per shard the bytes around all places left, as one row."""
    ddl = f"shard long, ids array<{id_type}>, rows array<long>, counts array<int>, starts binary, ends binary, data binary"
    target = arrow_schema(ddl + ", n long")
    same = F.col("_i").eqNullSafe(F.col("id")) & (F.col("_h") == F.col("row"))
    texts = keyed.join(candidates, same).select("shard", "id", "row", "starts", "ends", "_t")

    def pack(table: pa.Table) -> pa.Table:
        counts, starts, ends, data, n = [], [], [], [], 0
        for first, last, text in zip(table.column("starts"), table.column("ends"), table.column("_t")):
            raw = memoryview(text.as_buffer())
            first, last = first.as_py(), last.as_py()
            counts.append(len(first))
            starts += first
            ends += last
            for a, b in zip(first, last):
                data.append(raw[a : b + match.length])
                n += b - a + 1
        columns = [
            table.column("shard")[0].as_py(), table.column("id").to_pylist(), table.column("row").to_pylist(), counts,
            np.array(starts, "<i4").tobytes(), np.array(ends, "<i4").tobytes(), b"".join(data), n,
        ]
        return pa.Table.from_arrays([pa.array([c], f.type) for c, f in zip(columns, target)], schema=target)

    return stage_lean(texts.groupBy("shard").applyInArrow(pack, ddl + ", n long"), "cases")


def _starts_hashes(row: dict, match: Match) -> np.ndarray:
    """The hash of the bytes of a match at every place of a case."""
    data = np.frombuffer(row["data"], np.uint8)
    first = np.frombuffer(row["starts"], "<i4").astype(np.int64)
    n = np.frombuffer(row["ends"], "<i4").astype(np.int64) - first + 1
    base = np.cumsum(n + match.length - 1) - (n + match.length - 1)
    at = np.repeat(base - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
    return range_hashes(data, at, at + match.length)


def _spans(cases: DataFrame, answers: DataFrame, buckets: int, match: Match, id_type: str) -> DataFrame:
    """The covered bytes of each document: id, row, spans (from, to)."""
    ddl = f"id {id_type}, row long, begins array<int>, ends array<int>"
    target = arrow_schema(ddl)

    def cover(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row, out, at = _row(batch, i), [], 0
                keys, of, times = np.unique(_starts_hashes(row, match), return_inverse=True, return_counts=True)
                hit = (_answered(keys, row["answers"], buckets) | (times > 1))[of]
                first = np.frombuffer(row["starts"], "<i4").astype(np.int64)
                n = np.frombuffer(row["ends"], "<i4").astype(np.int64) - first + 1
                offset = np.cumsum(n) - n
                place = np.repeat(first - offset, n) + np.arange(int(n.sum()))
                for doc, count in enumerate(row["counts"]):
                    low, high = (offset[at], offset[at + count - 1] + n[at + count - 1]) if count else (0, 0)
                    at += count
                    found = place[low:high][hit[low:high]]
                    if len(found):
                        begin, end = _joined(found, found + match.length, 0)
                        out.append((row["ids"][doc], row["rows"][doc], begin.tolist(), end.tolist()))
                columns = list(zip(*out)) if out else [[]] * 4
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, target.field(k).type) for k, c in enumerate(columns)], schema=target
                )

    found = _with_answers(cases, answers).mapInArrow(cover, ddl)
    once = found.groupBy("id", "row").agg(F.min(F.struct("begins", "ends")).alias("at"))
    return stage_lean(once.select("id", "row", F.arrays_zip("at.begins", "at.ends").alias("spans")), "spans")


def repeated_bytes(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", out: str = "repeated", match: Match = Match()
) -> DataFrame:
    """The documents with the byte ranges that a repeated string of ``match.length`` bytes covers.

    ``out`` (array of begins and ends, ascending and apart; a column of that name is replaced) holds the
    maximal ranges, empty if none.  A string counts as repeated if it starts at two places, in one
    document or in two; matches do not cross documents and are judged on the whole input.

    NULL texts count as empty; texts shorter than a match repeat nothing.  Rows equal in id and text are
    two documents that repeat each other.  Repeated ids, NULL ids and extra columns are kept as they are;
    an empty table gives no rows.
    """
    if match.length < 40:
        raise ValueError("a match has at least 40 bytes")
    docs = docs.drop(out)
    id_type = docs.schema[id_col].dataType.simpleString()
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).cast("binary")
    keyed = docs.select(F.col(f"`{id_col}`").alias("_i"), F.xxhash64(text).alias("_h"), text.alias("_t"))
    shards = _shards(keyed, match, id_type)
    prefixes, shards, enough = common_prefixes(shards, match)
    candidates = _candidates(shards, prefixes, match, enough, id_type)
    discard(shards)
    discard(prefixes)
    cases = _cases(keyed, candidates, match, id_type)
    answers, buckets = _exchange(cases, lambda row: np.unique(_starts_hashes(row, match)), _total(cases), 7)
    spans = _spans(cases, answers, buckets, match, id_type)
    row, found, found_row = unused(docs, "_row"), unused(docs, "_id"), unused(docs, "_r")
    known = spans.select(F.col("id").alias(found), F.col("row").alias(found_row), F.col("spans").alias(out))
    same = F.col(f"`{id_col}`").eqNullSafe(F.col(found)) & (F.col(row) == F.col(found_row))
    joined = docs.withColumn(row, F.xxhash64(text)).join(known, same, "left")
    none = F.array().cast("array<struct<begins:int,ends:int>>")
    return joined.select(*[F.col(f"`{c}`") for c in docs.columns], F.coalesce(out, none).alias(out))


def without_ranges(
    df: DataFrame, text_col: str = "text", ranges_col: str = "repeated", out: str = "kept"
) -> DataFrame:
    """Add the bytes of a text that the ranges leave, and their SHA-256 in ``<out>_sha256``."""
    names = [*[c for c in df.columns if c not in (out, f"{out}_sha256")]]
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).cast("binary")
    width = len(names)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, digests = [], []
            for raw, ranges in zip(batch.column(width), batch.column(width + 1)):
                data, parts, at = memoryview(raw.as_buffer()), [], 0
                for r in ranges.as_py() or ():
                    parts.append(data[at : r["begins"]])
                    at = r["ends"]
                parts.append(data[at:])
                kept.append(b"".join(parts))
                digests.append(hashlib.sha256(kept[-1]).hexdigest())
            columns = [*batch.columns[:width], pa.array(kept, pa.binary()), pa.array(digests, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, [*names, out, f"{out}_sha256"])

    fields = [f"`{n}` {df.schema[n].dataType.simpleString()}" for n in names]
    rows = df.select(*[F.col(f"`{n}`") for n in names], text.alias("_t"), F.col(f"`{ranges_col}`").alias("_ranges"))
    return rows.mapInArrow(cut, ", ".join([*fields, f"`{out}` binary", f"`{out}_sha256` string"]))
