"""Text expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, functions as F


def concat_skip_null(*parts: Column) -> Column:
    """Concatenate, leaving NULL parts out."""
    return F.concat_ws("", *parts)


def csv_line(*parts: Column, missing: str = "N/A") -> Column:
    """Comma-separated text of the parts, a filler standing for NULL."""
    return F.concat_ws(", ", *[F.coalesce(p.cast("string"), F.lit(missing)) for p in parts])


def nth_part(text: Column, separator: str, n: int) -> Column:
    """The n-th part (from 1) of text cut at a separator; empty when there is none."""
    return F.split_part(text, F.lit(separator), F.lit(n))


def is_palindrome(text: Column) -> Column:
    return text == F.reverse(text)


def last_chars(text: Column, n: int) -> Column:
    """The last n characters, NULL for a shorter text."""
    return F.when(F.char_length(text) >= n, F.right(text, F.lit(n)))


def digits_only(text: Column) -> Column:
    return F.regexp_replace(text, r"[^0-9]", "")


def position_of(text: Column, needle: str) -> Column:
    """1-based place of a substring, 0 when absent."""
    return F.instr(text, needle)


def relabel_if_contains(text: Column, token: str, label: str) -> Column:
    """A fixed label for every text that contains the token."""
    return F.when(text.contains(token), F.lit(label)).otherwise(text)


def zero_pad(value: Column, width: int) -> Column:
    return F.lpad(value.cast("string"), width, "0")


def text_bar(
    count: Column, largest: Column, width: int = 50, mark: str = "▰", per_mark: int | None = None
) -> Column:
    """A bar of at most ``width`` marks; the largest count fills it.

    With ``per_mark`` a mark stands for that many rows as long as the largest count
    fits the width.
    """
    share = F.floor(count.cast("double") * width / F.greatest(largest, F.lit(1)))
    if per_mark is not None:
        fits = largest <= F.lit(per_mark * width)
        share = F.when(fits, F.floor(count / per_mark)).otherwise(share)
    return F.repeat(F.lit(mark), F.least(share, F.lit(width)).cast("int"))


def bits_and_chars(text: Column) -> tuple[Column, Column, Column]:
    """Stored bits (UTF-8), nominal bits at 8 per character, and characters."""
    chars = F.char_length(text)
    return F.bit_length(text), chars * 8, chars


def rank_of_label(label: Column, ranks: Mapping[str, int]) -> Column:
    """The rank of a text label from an explicit list; NULL for unknown labels."""
    out = F.lit(None).cast("int")
    for text, rank in ranks.items():
        out = F.when(label == text, F.lit(rank)).otherwise(out)
    return out


def matching_prefixes(text: Column, prefixes: Sequence[str]) -> Column:
    """Array of those prefixes the text starts with."""
    return F.filter(F.array(*[F.lit(p) for p in prefixes]), lambda p: F.startswith(text, p))
