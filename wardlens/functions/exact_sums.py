"""Sums of doubles that do not depend on the order of addition.

A double is a whole number times a power of two.  Over the range of magnitudes that a column has, it
is written as a few words: whole numbers of 32 bits, each with its own power of two as unit.  Words
are added up by plain ``sum`` of longs, exactly; up to 2^31 rows fit.  The total is turned back into a
double at the end, so partial sums may be made anywhere and joined in any order.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, functions as F

_BITS = 32
#: The exponents of the least double's bit and of the greatest's.
_LEAST, _GREATEST = -1074, 1023


@dataclass(frozen=True)
class Words:
    """Words from the bit 2^low on; ``special`` if there are NaN or infinite values to count."""

    low: int = _LEAST
    count: int = (_GREATEST - _LEAST) // _BITS + 1
    special: bool = True

    def unit(self, k: int) -> Column:
        return F.lit(math.ldexp(1.0, self.low + _BITS * k))


#: Words for any doubles whatever, for values that are not known yet.
ALL_DOUBLES = Words()


def _unusual(x: Column) -> Column:
    return F.isnan(x) | (F.abs(x) == F.lit(math.inf))


def range_aggregates(columns: Mapping[str, Column]) -> list[Column]:
    """Aggregates for each column's least and greatest magnitude and whether it has unusual values."""
    found = []
    for name, column in columns.items():
        x = column.cast("double")
        size = F.when((x != 0) & ~_unusual(x), F.abs(x))
        found += [F.min(size).alias(f"{name}_least"), F.max(size).alias(f"{name}_most"),
                  F.max(_unusual(x)).alias(f"{name}_special")]
    return found


def range_totals(names: Iterable[str]) -> list[Column]:
    """The same over groups that ``range_aggregates`` describes."""
    return [
        fn(f"{name}_{part}").alias(f"{name}_{part}")
        for name in names for fn, part in ((F.min, "least"), (F.max, "most"), (F.max, "special"))
    ]


def words_from(row: Row, names: Iterable[str]) -> dict[str, Words]:
    """The words that each column's values need, by its measured range."""
    out = {}
    for name in names:
        least, most = row[f"{name}_least"], row[f"{name}_most"]
        low = max(_LEAST, math.frexp(least)[1] - 53) if least else 0
        high = math.frexp(most)[1] - 1 if most else 0
        out[name] = Words(low, (high - low) // _BITS + 1, bool(row[f"{name}_special"]))
    return out


def words_for(df: DataFrame, columns: Mapping[str, Column]) -> dict[str, Words]:
    """The words that each column's values need (one job)."""
    return words_from(df.agg(*range_aggregates(columns)).first(), columns)


def addends(x: Column, words: Words) -> list[Column]:
    """What to add up for a column: its words, then if needed marks of NaN, infinity and minus infinity."""
    x = x.cast("double")
    plain = F.when(_unusual(x), F.lit(0.0)).otherwise(x) if words.special else x
    out = []
    for k in range(words.count):
        word = F.rint(plain / words.unit(k))
        if k + 1 < words.count:
            word = word - F.rint(plain / words.unit(k + 1)) * float(1 << _BITS)
        above = words.low + _BITS * k + 86
        if above <= _GREATEST:
            # So large a double has no bit as low as this word's.
            word = F.when(F.abs(plain) >= F.lit(math.ldexp(1.0, above)), F.lit(0.0)).otherwise(word)
        out.append(word.cast("bigint"))
    if words.special:
        for mark in (F.isnan(x), x == F.lit(math.inf), x == F.lit(-math.inf)):
            out.append(F.when(mark, F.lit(1)).otherwise(F.lit(0)).cast("bigint"))
    return out


def total(sums: list[Column], words: Words) -> Column:
    """The double that summed words stand for, NULL if they are; within two roundings of the exact sum."""
    value = _short_total(sums, words) if words.count <= 4 else _long_total(sums, words)
    if words.special:
        nan, up, down = (n > 0 for n in sums[words.count : words.count + 3])
        value = (
            F.when(nan | (up & down), F.lit(math.nan)).when(up, F.lit(math.inf)).when(down, F.lit(-math.inf)).otherwise(value)
        )
    return value


def _short_total(sums: list[Column], words: Words) -> Column:
    """Carries from the lowest word up, then the double from the highest word down."""
    parts, here = [], sums[0]
    for k in range(1, words.count):
        parts.append(here.bitwiseAND(F.lit((1 << _BITS) - 1)))
        here = sums[k] + F.shiftright(here, _BITS)
    value = here.cast("double") * words.unit(words.count - 1)
    for k in reversed(range(words.count - 1)):
        value = value + parts[k].cast("double") * words.unit(k)
    return value


def _long_total(sums: list[Column], words: Words) -> Column:
    """The same for many words, as a fold over an array: written out it would outgrow generated code."""
    start = F.struct(F.lit(0).cast("bigint").alias("carry"), F.array().cast("array<bigint>").alias("parts"))

    def carried(state: Column, word: Column) -> Column:
        here = word + state["carry"]
        low = F.array(here.bitwiseAND(F.lit((1 << _BITS) - 1)))
        return F.struct(F.shiftright(here, _BITS).alias("carry"), F.concat(low, state["parts"]).alias("parts"))

    top = sums[words.count - 1]
    parts = F.aggregate(
        F.array(*sums[: words.count - 1]), start, carried, lambda end: F.concat(F.array(top + end["carry"]), end["parts"])
    )
    units = F.array(*[words.unit(k) for k in reversed(range(words.count))])
    scaled = F.zip_with(parts, units, lambda part, unit: part.cast("double") * unit)
    value = F.aggregate(scaled, F.lit(-0.0), lambda sum_, part: sum_ + part)
    return F.when(sums[0].isNotNull(), value)
