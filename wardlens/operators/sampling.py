"""Random steps that give the same rows on every run and every engine.

The random number of a row comes from the MD5 digest of its unique key and a
seed, not from its place in a partition, so a task that is run again after the
loss of an executor draws the same numbers.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

# 13 hexadecimal digits hold 52 bits, which a double keeps exactly.
_HEX_DIGITS = 13
_STEPS = 1 << (4 * _HEX_DIGITS)


def digest(key: Column, seed: str) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))


def uniform(key: Column, seed: str) -> Column:
    """A number in (0, 1) fixed by the row's key and the seed."""
    number = F.conv(F.substring(digest(key, seed), 1, _HEX_DIGITS), 16, 10).cast("bigint")
    return (number.cast("double") + 0.5) / F.lit(float(_STEPS))


def random_rows(df: DataFrame, key: Sequence[str], n: int, seed: str = "s") -> DataFrame:
    """n random rows: the n smallest digests, kept by a distributed top-n."""
    text = F.concat_ws("|", *[F.col(k).cast("string") for k in key])
    return df.withColumn("_draw", digest(text, seed)).orderBy("_draw", *key).limit(n).drop("_draw")


def random_between(low: Column, high: Column, key: Column, seed: str = "s") -> Column:
    """A uniform whole number from low to high, both included."""
    return (low + F.floor(uniform(key, seed) * (high - low + 1))).cast("bigint")


def random_in_text_range(text: Column, key: Column, seed: str = "s", dash: str = "-") -> Column:
    """A uniform whole number within a textual range such as ``21-29``."""
    low = F.split_part(text, F.lit(dash), F.lit(1)).try_cast("bigint")
    high = F.split_part(text, F.lit(dash), F.lit(2)).try_cast("bigint")
    return random_between(low, high, key, seed)


def normal_draw(mean: Column, sd: float, key: Column, seed: str = "s") -> Column:
    """A normally distributed number (Box-Muller from two uniform ones)."""
    radius = F.sqrt(F.lit(-2.0) * F.log(uniform(key, seed + "r")))
    angle = F.cos(F.lit(2 * math.pi) * uniform(key, seed + "a"))
    return mean + F.lit(float(sd)) * radius * angle
