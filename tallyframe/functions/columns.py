"""Expressions used by every operator. All of them stay inside codegen."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, functions as F

# A decimal number in text. Spark and other SQL engines disagree on what else
# casts to a double ("1d", "1_000"), so text is checked before the cast.
NUMBER_TEXT = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def as_col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def finite(c: str | Column) -> Column:
    """NaN and infinities become NULL; missing has one spelling."""
    c = as_col(c)
    return F.when(F.isnan(c) | (F.abs(c) == float("inf")), None).otherwise(c)


def text_to_number(c: str | Column) -> Column:
    """Text to double, NULL when it does not look like a decimal number."""
    c = as_col(c)
    return F.when(c.rlike(NUMBER_TEXT), F.trim(c).try_cast("double"))


def digits_only(c: str | Column) -> Column:
    """Drop every non-digit, then read a number: "-500" gives 500."""
    return F.regexp_replace(as_col(c), "[^0-9]", "").try_cast("double")


def digits_and_dot(c: str | Column) -> Column:
    """Like :func:`digits_only` but the decimal point survives."""
    return text_to_number(F.regexp_replace(as_col(c), "[^0-9.]", ""))


def without_char(c: str | Column, char: str = "_") -> Column:
    """Remove a character everywhere, then read a number."""
    return text_to_number(F.replace(as_col(c), F.lit(char), F.lit("")))


def sentinel_null(c: str | Column, *sentinels: str) -> Column:
    """NULL when the whole value equals a sentinel."""
    c = as_col(c)
    return F.when(c.isin(*sentinels), None).otherwise(c)


def null_outside(c: str | Column, lo: float, hi: float) -> Column:
    c = as_col(c)
    return F.when(c.between(lo, hi), c)


def clip(c: str | Column, lo: float | None = None, hi: float | None = None) -> Column:
    """Clamp to [lo, hi]. least/greatest would turn NULL into a bound."""
    c = as_col(c)
    out = c
    if hi is not None:
        out = F.when(c > hi, F.lit(hi).cast("double")).otherwise(out)
    if lo is not None:
        out = F.when(c < lo, F.lit(lo).cast("double")).otherwise(out)
    return out


def duration_months(c: str | Column) -> Column:
    """"22 Years and 9 Months" to 273; NULL when the text says otherwise."""
    c = as_col(c)
    shape = r"(\d+)\s+Years?\s+and\s+(\d+)\s+Months?"
    years = F.regexp_extract(c, shape, 1).try_cast("int")
    months = F.regexp_extract(c, shape, 2).try_cast("int")
    return years * 12 + months


def map_label(c: str | Column, mapping: Mapping[str, int], unseen: int | None = None) -> Column:
    """Fixed text-to-int map; anything else is NULL or ``unseen``."""
    c = as_col(c)
    out = F.lit(unseen).cast("int")
    for text, code in mapping.items():
        out = F.when(c == text, F.lit(code)).otherwise(out)
    return out


def ratio(a: str | Column, b: str | Column) -> Column:
    """a / b where a zero or missing denominator, or a missing numerator, gives 0."""
    a, b = as_col(a), as_col(b)
    return F.coalesce(finite(a / F.nullif(b, F.lit(0.0))), F.lit(0.0))


def safe_divide(a: str | Column, b: str | Column, default: float = 0.0) -> Column:
    """a / b with a default for b = 0; missing inputs stay missing."""
    a, b = as_col(a), as_col(b)
    return F.when(b == 0, F.lit(default)).otherwise(a / F.nullif(b, F.lit(0.0)))


def pct(part: Column, whole: Column, digits: int = 2) -> Column:
    return F.round(F.coalesce(part / F.nullif(whole, F.lit(0)), F.lit(0.0)) * 100, digits)


def arg_max(probs: str | Column) -> Column:
    """0-based position of the first maximum."""
    probs = as_col(probs)
    return (F.array_position(probs, F.array_max(probs)) - 1).cast("int")


def even_edges(bins: int, lo: float = 0.0, hi: float = 1.0) -> list[float]:
    """Equal steps as floats, spelled once: step i is lo + i * width."""
    width = (hi - lo) / bins
    return [lo + i * width for i in range(bins)] + [hi]
