"""Quality rules by compression: whole texts and fixed chunks must lie in a band of zstandard ratios."""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from wardlens.llm.common import AT_ONCE, map_batches, sliced, text_bytes

SYMBOLS = frozenset(b"#*$%&|<>")


@dataclass(frozen=True)
class Bands:
    """Limits on compressed size / size.

    ``whole`` lists (least bytes, lowest ratio, highest ratio) by rising length; a text takes the
    last entry it reaches.  Short texts compress badly whatever they say, long ones well, so the
    band narrows and sinks with the length.  Chunks of ``chunk_bytes`` (the last one only if it is
    at least half as long) have the band ``chunk``; a text fails when more than ``chunk_share`` of
    them lie outside.
    """

    whole: tuple[tuple[int, float, float], ...] = (
        (0, 0.0, 99.0),
        (256, 0.25, 0.90),
        (512, 0.22, 0.80),
        (1024, 0.20, 0.72),
        (8192, 0.17, 0.70),
        (65536, 0.12, 0.70),
    )
    chunk_bytes: int = 4096
    chunk: tuple[float, float] = (0.18, 0.72)
    chunk_share: float = 0.5
    level: int = 3

    def limits(self, size: int) -> tuple[float, float]:
        return next((low, high) for least, low, high in reversed(self.whole) if size >= least)


PRODUCTION = Bands()


def measure_text(text: bytes, bands: Bands, compressor: zstandard.ZstdCompressor) -> tuple:
    """The row of measures of one text; see ``measure``."""
    words = text.split()
    n = len(words)
    chars = sum(len(w.decode("utf-8", "replace")) for w in words)
    symbols = sum(map(text.count, (bytes((s,)) for s in SYMBOLS)))
    lines = [line for line in text.split(b"\n") if line.split()]
    windows = list(zip(words, words[1:], words[2:]))
    counts = Counter(windows)
    repeated, reached = 0, 0
    if len(counts) < len(windows):
        for i, window in enumerate(windows):
            if counts[window] > 1:
                repeated += i + 3 - max(i, reached)
                reached = i + 3
    base_failed = n < 50 or 100 * repeated > 50 * n
    whole, outside = None, 0.0
    good = True
    if text:
        whole = len(compressor.compress(text)) / len(text)
        low, high = bands.limits(len(text))
        good = low <= whole <= high
        size = bands.chunk_bytes
        chunks = [text[i : i + size] for i in range(0, len(text), size)]
        chunks = [c for c in chunks if 2 * len(c) >= size]
        if chunks:
            low, high = bands.chunk
            ratios = (len(compressor.compress(c)) / len(c) for c in chunks)
            outside = sum(not low <= r <= high for r in ratios) / len(chunks)
            good = good and outside <= bands.chunk_share
    kept = good and not base_failed
    return n, chars, symbols, len(lines) - len(set(lines)), repeated, base_failed, kept, whole, outside


MEASURES = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, whole_ratio double, chunks_outside double"
)


def measure(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bands: Bands = PRODUCTION
) -> DataFrame:
    """One row of measures and a verdict per document, in one pass without a shuffle.

    Columns: the id, ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``,
    ``n_repeat_words`` (words inside a 3-word window found twice or more), ``base_failed`` (fewer
    than 50 words, or over half of them repeated), ``kept``, ``whole_ratio``, ``chunks_outside``.

    A NULL text counts as empty: no words, so it fails; its ratio is NULL.  Ids are copied, NULL
    or repeated; equal rows get equal rows.  Other columns are not read.  An empty table gives no
    rows.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    names = [part.split()[0] for part in MEASURES.split(", ")]

    def rows(batch: pa.RecordBatch) -> dict[str, object]:
        compressor = zstandard.ZstdCompressor(level=bands.level)
        found = [measure_text(t, bands, compressor) for t in batch.column(1).to_pylist()]
        columns = list(zip(*found)) if found else [[] for _ in names]
        return {id_col: batch.column(0), **dict(zip(names, columns))}

    picked = docs.select(id_col, text_bytes(text_col).alias("_text"))
    return map_batches(picked, rows, f"`{id_col}` {id_type}, {MEASURES}")


def keep_good(docs: DataFrame, text_col: str = "text", bands: Bands = PRODUCTION) -> DataFrame:
    """The documents whose verdict is ``kept``, with all their columns, whatever their names."""

    def rows(batches):
        compressor = zstandard.ZstdCompressor(level=bands.level)
        at = None
        for batch in sliced(batches, AT_ONCE):
            at = batch.schema.get_field_index(text_col) if at is None else at
            texts = batch.column(at).cast(pa.binary()).to_pylist()
            good = [measure_text(t or b"", bands, compressor)[6] for t in texts]
            yield batch.filter(pa.array(good, pa.bool_()))

    return docs.mapInArrow(rows, docs.schema)
