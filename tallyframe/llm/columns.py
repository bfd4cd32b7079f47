"""Column expressions the operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

BLANKS = " \t\n\x0b\x0c\r"


def words(text: Column) -> Column:
    """Runs of anything but the six ASCII blanks; an empty array for null or blank texts."""
    inner = F.btrim(text, F.lit(BLANKS))
    return F.when(F.length(inner) > 0, F.split(inner, r"[\x20\x09-\x0D]+")).otherwise(
        F.array().cast("array<string>"))


def fenced(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are computed once, however often later expressions name them.

    Catalyst merges neighbouring projections, which would repeat a costly array in every
    place that reads it. The one-row inline keeps it from doing so.
    """
    row = F.struct(*[c.alias(name) for name, c in columns.items()])
    return df.select(*[F.col(f"`{c}`") for c in df.columns], F.inline(F.array(row)))


def same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)
