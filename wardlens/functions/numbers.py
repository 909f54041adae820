"""Number, conversion, array and JSON expressions."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def _as_decimal(x: Column, digits: int) -> tuple[Column, Column]:
    """Whether x is small enough to have decimals, and then x with at least 10 of them.

    A double of 10^17 or more is a whole number, so it needs no rounding.
    """
    scale = max(10, digits + 6)
    small = F.abs(x.cast("double")) < F.lit(float(10 ** min(17, 37 - scale)))
    return small, F.when(small, x).cast(f"decimal(38,{scale})")


def round_half_up(x: Column, digits: int = 2) -> Column:
    """Decimal rounding (half away from zero), returned as a double."""
    small, exact = _as_decimal(x, digits)
    return F.when(small, F.round(exact, digits).cast("double")).otherwise(x.cast("double"))


def truncate(x: Column, digits: int = 2) -> Column:
    """Cut digits off towards zero."""
    small, exact = _as_decimal(x, digits)
    cut = F.floor(F.abs(exact), F.lit(digits))
    return F.when(small, F.when(exact < 0, -cut).otherwise(cut).cast("double")).otherwise(x.cast("double"))


def guarded_ratio(top: Column, bottom: Column) -> Column:
    """top / bottom, NULL where bottom is 0 or NULL."""
    return F.try_divide(top.cast("double"), bottom.cast("double"))


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    """100 * part / whole rounded, NULL where whole is 0."""
    return round_half_up(F.try_divide(part * F.lit(100.0), whole.cast("double")), digits)


def whole_quotient(a: Column, b: Column) -> Column:
    """Integer division cut towards zero."""
    return F.call_function("div", a, b)


def is_even(x: Column) -> Column:
    return F.pmod(x, F.lit(2)) == 0


def parity_label(x: Column) -> Column:
    """Even, Odd, or Null for a missing value."""
    return (
        F.when(x.isNull(), F.lit("Null")).when(is_even(x), F.lit("Even")).otherwise(F.lit("Odd"))
    )


def to_number(text: Column, kind: str = "double") -> Column:
    """Number from text, NULL for text that is no number."""
    return text.try_cast(kind)


def nearly_equal(a: Column, b: Column, tolerance: float) -> Column:
    return F.abs(a - b) <= F.lit(tolerance)


def flag_sum(*flags: Column) -> Column:
    """Sum of 0/1 flags, NULL counting as 0."""
    return reduce(lambda a, b: a + b, [F.coalesce(f, F.lit(0)) for f in flags])


def text_array(*values: Column) -> Column:
    """Array of mixed values, each as text."""
    return F.array(*[v.cast("string") for v in values])


def json_object(*columns: Column) -> Column:
    """JSON text of the columns with NULL fields kept."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def band(x: Column, width: float) -> Column:
    """Number of the half-open band [k*width, (k+1)*width) that holds x."""
    return F.floor(x / F.lit(float(width)))


def score(x: Column, bands: Sequence[tuple[float | None, float | None, int]]) -> Column:
    """Points of the first band ``(low, high, points)`` with low <= x < high, else 0.

    ``None`` leaves a side open; a NULL x scores 0.
    """
    out = F.lit(0)
    for low, high, points in reversed(list(bands)):
        inside = x.isNotNull()
        if low is not None:
            inside = inside & (x >= F.lit(low))
        if high is not None:
            inside = inside & (x < F.lit(high))
        out = F.when(inside, F.lit(points)).otherwise(out)
    return out


# A number written with digits and at most one point.
PLAIN_NUMBER = r"^(?:[0-9]+\.?[0-9]*|\.[0-9]+)$"


def plain_number(text: Column) -> Column:
    """A plain unsigned number from text; NULL, with no failed parse, for any other text."""
    return F.when(text.rlike(PLAIN_NUMBER), text.try_cast("double"))


def range_parts(value: Column, reference: Column, separators: Sequence[str]) -> Column:
    """A struct of ``low``, ``high`` and ``found``: a textual range ``low<sep>high`` and a value in numbers.

    A part is NULL where its text is not a plain unsigned number, or the range has no separator
    or more than one.
    """
    either = "|".join(re.escape(s) for s in separators)
    pattern = f"^((?:(?!{either}).)*)(?:{either})((?:(?!{either}).)*)$"
    ends = [plain_number(F.regexp_extract(reference, pattern, i)) for i in (1, 2)]
    return F.struct(ends[0].alias("low"), ends[1].alias("high"), plain_number(value).alias("found"))


def outside_range(
    df: DataFrame, value: Column, reference: Column, separators: Sequence[str]
) -> DataFrame:
    """The rows whose text ``value`` lies outside the textual range ``reference``.

    Rows where the value or either limit is not a plain unsigned number are not among them.  The
    texts are parsed once, in the scan's stage, and the filter compares the numbers.
    """
    parsed = df.select("*", F.inline(F.array(range_parts(value, reference, separators))))
    beyond = (F.col("found") < F.col("low")) | (F.col("found") > F.col("high"))
    return parsed.filter(F.col("low").isNotNull() & F.col("high").isNotNull() & beyond).select(*df.columns)
