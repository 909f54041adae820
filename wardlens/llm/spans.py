"""Substring deduplication by sliding runs of sentences."""

from __future__ import annotations

import re
import struct
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, functions as F

from wardlens.llm.common import map_batches, unused
from wardlens.sources.staging import stage

#: White space after a sentence's end, or any with a line end; what stands before the latter is cut off later.
_BREAK = re.compile(r"[.!?。！？]\s+|\n\s*")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_HALVES = struct.Struct(">qq")


@dataclass(frozen=True)
class Runs:
    """A run starts at a sentence and takes the next ones until it has both ``sentences`` and
    ``words``.  A sentence of more than ``longest`` words counts as pieces of about ``piece`` words,
    cut where its words say, so a passage inside is cut alike wherever it stands."""

    sentences: int = 2
    words: int = 20
    longest: int = 24
    piece: int = 12


PRODUCTION = Runs()


def _cuts(words: list[bytes], runs: Runs) -> list[int]:
    """Where a long sentence is cut: the first of its lower-cased words that start pieces.

    A word starts a piece if the hash of it and the next one is the least of ``piece`` // 2 - 1 on
    either side, the first of equal ones.  What is left longer than 4/3 of ``piece`` is cut at
    its own least hash, as far from both ends.  A last piece that no run would reach joins the
    one before it.
    """
    reach, most = max(1, runs.piece // 2 - 1), max(3, runs.piece * 4 // 3)
    digest = xxhash.xxh64_intdigest
    marks = [digest(a + b" " + b) for a, b in zip(words, words[1:])]
    marks.append(digest(words[-1]))
    n, found, i = len(words), [0], reach
    while i <= n - reach:
        around = marks[i - reach : i + reach + 1]
        least = i - reach + around.index(min(around))
        if least == i:
            found.append(i)
        # No word between this one and a later least one, nor any that an earlier one is near, qualifies.
        i = least if least > i else least + reach + 1
    out = []
    waiting = list(zip(found, [*found[1:], n]))[::-1]
    while waiting:
        start, end = waiting.pop()
        low, high = start + reach, end - reach
        if end - start > most and low <= high:
            at = min(range(low, high + 1), key=marks.__getitem__)
            waiting += [(at, end), (start, at)]
        else:
            out.append(start)
    from_run = [i for i in out[:-1] if n - i >= runs.words]
    if len(out) > 1 and from_run and from_run[-1] < out[-2] and out[-1] - from_run[-1] >= runs.words:
        out.pop()
    return out


def _parts(text: str, runs: Runs) -> list[tuple[int, int, list[bytes]]]:
    """The sentences with a word: start, end and lower-cased words."""
    edges, at = [], 0
    for gap in _BREAK.finditer(text):
        start = gap.start()
        if text[start] == "\n":
            edges.append((at, at + len(text[at:start].rstrip())))
        else:
            edges.append((at, start + 1))
        at = gap.end()
    edges.append((at, len(text)))
    found = []
    for start, end in edges:
        words = text[start:end].lower().encode("utf-8", "replace").split()
        if len(words) > runs.longest:
            places = [m.span() for m in _WORD.finditer(text, start, end)]
            cuts = _cuts(words, runs)
            for i, j in zip(cuts, [*cuts[1:], len(words)]):
                found.append((places[i][0], places[j - 1][1], words[i:j]))
        elif words:
            found.append((start, end, words))
    return found


def sentences(text: str, runs: Runs = PRODUCTION) -> list[tuple[int, int, int]]:
    """The sentences with a word as (start, end, words); white space between belongs to none."""
    return [(start, end, len(words)) for start, end, words in _parts(text, runs)]


def run_hashes(text: str, runs: Runs = PRODUCTION) -> list[tuple[int, int, int, int]]:
    """All runs of a text as (hash, hash, first sentence, sentences); case and spacing don't count."""
    words = [part for _, _, part in _parts(text, runs)]
    sizes = [len(part) for part in words]
    plain = [b" ".join(part) for part in words]
    out, end, total, last = [], 0, 0, len(plain)
    for i in range(last):
        while end < last and (end - i < runs.sentences or total < runs.words):
            total += sizes[end]
            end += 1
        if end - i < runs.sentences or total < runs.words:
            break
        h1, h2 = _HALVES.unpack(xxhash.xxh3_128_digest(b"\n".join(plain[i:end])))
        out.append((h1, h2, i, end - i))
        total -= sizes[i]
    return out


def without(text: str, removed: set[int], runs: Runs = PRODUCTION) -> str:
    """The text less the given sentences, each with the white space after it."""
    parts = sentences(text, runs)
    starts = [a for a, _, _ in parts] + [len(text)]
    kept, at = [], 0
    for i, (a, _, _) in enumerate(parts):
        if i in removed:
            kept.append(text[at:a])
            at = starts[i + 1]
    kept.append(text[at:])
    return "".join(kept).strip() if removed else text


def remove_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    removed_col: str = "removed_sentences",
    runs: Runs = PRODUCTION,
) -> DataFrame:
    """The documents less the sentences that any repeated run covers, but for the run's first place.

    Every run of consecutive sentences is hashed and joined over all documents.  Its first place
    is that with the smallest (id, text hash, position), NULL ids last; at all others its
    sentences go.  The first place of any sentence is never lost, so no text vanishes from the
    corpus.  All columns stay, with the text shortened; ``removed_col`` (array of sentence
    numbers, a column of that name is replaced) says which sentences went, empty if none.

    NULL and empty texts stay as they are.  Rows equal in id and text are one document: they
    don't repeat each other and are cut alike.  Runs repeated within a document go too.  An empty
    table gives no rows.
    """
    if removed_col in docs.columns:
        docs = docs.drop(removed_col)
    id_type = docs.schema[id_col].dataType.simpleString()
    row, found_id, found_row, found_runs = (unused(docs, n) for n in ("_row", "_id", "_r", "_runs"))
    keyed = docs.withColumn(row, F.xxhash64(F.col(text_col)))

    def rows(batch: pa.RecordBatch) -> dict[str, object]:
        owner, found = [], []
        for i, text in enumerate(batch.column(2).to_pylist()):
            hashes = run_hashes(text or "", runs)
            owner += [i] * len(hashes)
            found += hashes
        take = pa.array(owner, pa.int64())
        columns = list(zip(*found)) if found else [[], [], [], []]
        return {
            "h1": columns[0], "h2": columns[1], "i": columns[2], "n": columns[3],
            "_id": batch.column(0).take(take), "_r": batch.column(1).take(take),
        }

    # Written first, so that the texts are read and hashed once for both uses.
    spans = stage(
        map_batches(
            keyed.select(id_col, row, text_col), rows,
            f"h1 long, h2 long, i int, n int, `_id` {id_type}, `_r` long",
        ),
        "runs",
    )
    place = F.struct(F.col("_id").isNull().alias("none"), "_id", "_r", "i")
    # Written first, so that the join deals both sides anew and a frequent run's rows can be split.
    repeated = stage(
        spans.groupBy("h1", "h2")
        .agg(F.min(place).alias("first"), F.max(place).alias("last"))
        .filter("first < last")
        .select("h1", "h2", "first"),
        "repeated",
    )
    later = spans.join(repeated, ["h1", "h2"]).filter(place > F.col("first"))
    covered = later.groupBy(F.col("_id").alias(found_id), F.col("_r").alias(found_row)).agg(
        F.collect_set(F.struct("i", "n")).alias(found_runs)
    )
    same = keyed[id_col].eqNullSafe(F.col(found_id)) & (F.col(row) == F.col(found_row))
    joined = keyed.join(covered, same, "left").select(*docs.columns, found_runs)
    names, at = [*docs.columns, removed_col], docs.columns.index(text_col)

    def cut(batches):
        for batch in batches:
            texts, removed, changed, shorter = batch.column(at), [], [], []
            for i, runs_of in enumerate(batch.column(batch.num_columns - 1).to_pylist()):
                gone = {k for r in runs_of or () for k in range(r["i"], r["i"] + r["n"])}
                if gone:
                    shorter.append(without(texts[i].as_py(), gone, runs))
                changed.append(bool(gone))
                removed.append(sorted(gone))
            columns = batch.columns[:-1]
            columns[at] = pc.replace_with_mask(texts, pa.array(changed, pa.bool_()), pa.array(shorter, texts.type))
            columns.append(pa.array(removed, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, names)

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema]
    return joined.mapInArrow(cut, ", ".join([*fields, f"`{removed_col}` array<int>"]))
