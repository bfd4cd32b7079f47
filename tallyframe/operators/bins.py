"""Bin numbers by comparison with a literal edge list.

Edges are floats spelled once (0.1 steps are not exact), so bins are found by
comparison and never by multiplying and flooring. The search is MLlib's Bucketizer,
a binary search inside generated code whose cost does not grow with the plan.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, functions as F

OUTSIDE = -1


def add_buckets(df: DataFrame, points: Mapping[str, Sequence[float]], prefix: str = "bucket_"
                ) -> DataFrame:
    """Add ``<prefix><column>``: how many of the ascending points are <= the value."""
    searched = {c: p for c, p in points.items() if p}
    out = df
    if searched:
        raw = {c: f"__raw_{c}" for c in searched}
        out = Bucketizer(
            splitsArray=[[-math.inf, *p, math.inf] for p in searched.values()],
            inputCols=list(searched), outputCols=list(raw.values()), handleInvalid="keep",
        ).transform(df)
    return out.select(*df.columns, *[
        F.expr(f"if(`{c}` is null, null, cast(`__raw_{c}` as int))").alias(f"{prefix}{c}")
        if c in searched else F.expr(f"if(`{c}` is null, null, 0)").alias(f"{prefix}{c}")
        for c in points])


def add_bins(df: DataFrame, edges: Mapping[str, Sequence[float]], closed: str = "left",
             close_end: bool = False, prefix: str = "bin_") -> DataFrame:
    """Add ``<prefix><column>`` for double columns: bin number, OUTSIDE, or NULL for NULL.

    ``closed="left"`` means [a,b), ``"right"`` means (a,b]; ``close_end`` also admits
    the top edge (left-closed) or the bottom edge (right-closed). A border is moved to
    the next double where the bin has to include it.
    """
    borders = {}
    for c, e in edges.items():
        e = [float(v) for v in e]
        if closed == "left":
            moved = {len(e) - 1} if close_end else set()
        else:
            moved = set(range(1 if close_end else 0, len(e)))
        borders[c] = [math.nextafter(v, math.inf) if i in moved else v for i, v in enumerate(e)]
    out = add_buckets(df, borders, "__pos_")
    return out.select(*df.columns, *[
        F.expr(f"case when `__pos_{c}` in (0, {len(e)}) then {OUTSIDE} "
               f"else `__pos_{c}` - 1 end").alias(f"{prefix}{c}")
        for c, e in edges.items()])
