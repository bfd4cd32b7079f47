"""Exact order statistics without sorting a column in one task.

Quantiles, running counts and hash ranks all need a total order. Here the value
range is first cut into buckets, the bucket counts (a small table) are summed up
in order, and rows are sorted only inside their bucket. Cut points are quantiles of a
sample, as for a range partitioning, so buckets hold similar shares of the rows whatever
the distribution; every row is counted in its bucket, so a poor cut costs balance and
never correctness. Small inputs use a single bucket.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections.abc import Mapping, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql import types as T

from tallyframe.functions.columns import finite
from tallyframe.operators.bins import add_buckets

ROWS_PER_SORT = 2_000_000
QUANTILE_ROWS = 1_000_000
#: Buckets of one pass. Where these are too wide, those that hold a wanted rank are cut again.
MAX_BUCKETS = 4096
SAMPLED_PER_BUCKET = 400
#: A bucket with so many times the rows of a sort is looked at again.
WIDE = 4
SETTLE_ROWS = 50_000
SETTLE_TEXT = 1000


def settle(df: DataFrame, max_rows: int = SETTLE_ROWS, max_text: int = SETTLE_TEXT) -> DataFrame:
    """Turn a small result into a local relation, whose size the optimizer knows.

    Joins against it broadcast by themselves and do not recompute it. A result
    over ``max_rows``, or with a text of more than ``max_text`` bytes, is returned as it was and
    joins by shuffling; longer texts are left out while fetching, so what is fetched is bounded.
    """
    texts = [f.name for f in df.schema if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    long = F.greatest(F.lit(0), F.lit(0), *[F.octet_length(F.col(f"`{c}`")) for c in texts]) > max_text
    rows = df.limit(max_rows + 1).select(
        *[F.when(F.octet_length(F.col(f"`{c}`")) <= max_text, F.col(f"`{c}`")).alias(c) if c in texts
          else F.col(f"`{c}`") for c in df.columns], long.alias("__long")).toArrow()
    if rows.num_rows > max_rows or pc.any(rows["__long"]).as_py():
        return df
    return df.sparkSession.createDataFrame(rows.drop_columns("__long"), schema=df.schema)


_ARROW = {"string": pa.string(), "double": pa.float64(), "int": pa.int32(), "bigint": pa.int64()}


def local_rows(spark: SparkSession, rows: Sequence[tuple], schema: Mapping[str, str]) -> DataFrame:
    """A handful of literal rows (grids, rule tables) as a local relation."""
    columns = {name: pa.array([r[i] for r in rows], _ARROW[kind])
               for i, (name, kind) in enumerate(schema.items())}
    return spark.createDataFrame(pa.table(columns))


def bucket_number(rows: int, rows_per_sort: int, at_least: int = 2) -> int:
    """One bucket for small inputs, beyond several times as many as sorts need."""
    if rows <= rows_per_sort:
        return 1
    return min(MAX_BUCKETS, max(at_least, -(-4 * rows // rows_per_sort)))


def cut_points(df: DataFrame, columns: Sequence[str], rows_per_sort: int = ROWS_PER_SORT,
               rows: int | None = None, at_least: int = 2) -> dict[str, list[float]]:
    """Ascending bucket borders per column, empty lists for small inputs.

    The rows brought to the driver are at most MAX_BUCKETS numbers per column. ``rows``
    saves the count when the caller knows an upper bound of it.
    """
    rows = df.count() if rows is None else rows
    buckets = bucket_number(rows, rows_per_sort, at_least)
    if buckets == 1:
        return {c: [] for c in columns}
    # The sketches of all tasks meet in one; sampling bounds what each of them carries.
    shares = [i / buckets for i in range(1, buckets)]
    part = min(1.0, SAMPLED_PER_BUCKET * buckets / rows)
    row = df.select(*columns).sample(part, 42).agg(*[
        F.percentile_approx(finite(F.col(c).cast("double")), shares, 5 * buckets).alias(c)
        for c in columns
    ]).first()
    return {c: sorted(set(row[c] or [])) for c in columns}


def _near_ranks(df: DataFrame, columns: Sequence[str], probs: Sequence[float], names: Sequence[str],
                rows_per_sort: int, rows: int | None) -> DataFrame:
    """``(*by, feature, n, x, hi, c, lo)`` of the values next to a wanted rank, a few for each.

    ``lo`` values are smaller than ``x`` and ``hi`` are not larger. Groups are called ``__by_0``, ...
    """
    columns = list(columns)
    by = [f"__by_{i}" for i in range(len(names))]
    narrow = df.select(*[F.col(b).alias(a) for a, b in zip(by, names)],
                       *[finite(F.col(c).cast("double")).alias(c) for c in columns])
    if by:
        narrow = narrow.dropna(subset=by)
    # Only buckets holding a wanted rank are moved, so there should be many per rank.
    points = cut_points(narrow, columns, rows_per_sort, rows, 16 * len(probs))

    def spread(points: Mapping[str, Sequence[float]]) -> DataFrame:
        return add_buckets(narrow, points).select(*by, F.inline(F.array(*[
            F.expr(f"named_struct('feature', '{c}', 'x', `{c}`, 'bucket', `bucket_{c}`)")
            for c in columns]))).where("x is not null")

    values = spread(points)
    cell = [*by, "feature"]
    ordered = Window.partitionBy(*cell, "bucket").orderBy("x")
    if not any(points.values()):
        counted = values.groupBy(*cell, "bucket", "x").agg(F.count("*").alias("c")).select(
            "*", F.sum("c").over(Window.partitionBy(*cell, "bucket")).alias("n"),
            F.expr("0L").alias("start"))
    else:
        while True:
            need, widest = _needed(values, cell, probs)
            more = _finer(values, need, cell, points, rows_per_sort) if widest > WIDE * rows_per_sort else {}
            if not more:
                break
            points = {c: sorted({*p, *more.get(c, ())}) for c, p in points.items()}
            values = spread(points)
        counted = (values.join(need.drop("in_bucket"), [*cell, "bucket"])
                   .groupBy(*cell, "bucket", "n", "start", "x").agg(F.count("*").alias("c")))
    ranked = counted.select(
        *cell, "n", "x", (F.col("start") + F.sum("c").over(ordered)).alias("hi"), "c",
    ).withColumn("lo", F.expr("hi - c"))

    # Few rows hold a wanted rank. A loose test on the rank share drops the others
    # cheaply; who reads the rest decides exactly.
    return add_buckets(
        ranked.withColumns({"u": F.expr("(lo - 2) / nullif(n - 1, 0)"),
                            "v": F.expr("(hi + 1) / nullif(n - 1, 0)")}),
        {"u": sorted(set(probs)), "v": sorted(set(probs))}, "near_",
    ).where("n = 1 or near_v > near_u").select(*cell, "n", "x", "hi", "c", "lo")


def exact_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float],
                    by: Sequence[str] = (), rows_per_sort: int = QUANTILE_ROWS,
                    rows: int | None = None) -> DataFrame:
    """Linear-interpolation quantiles of many columns, per group.

    One row per group and column that has any value: ``(*by, feature, n,
    quantiles, below)`` in the order of ``probs``; ``below`` is the number of values
    smaller than the quantile. NULL, NaN and infinite values and NULL groups are left out.
    """
    names, probs = list(by), [float(p) for p in probs]
    near = _near_ranks(df, columns, probs, names, rows_per_sort, rows)
    by = [f"__by_{i}" for i in range(len(names))]
    cell = [*by, "feature"]
    picked = near.groupBy(*cell, "n").agg(*[
        F.expr(f"max(case when {rank} >= lo and {rank} < hi then x end)").alias(f"{side}{i}")
        for i, p in enumerate(probs) for side, rank in zip("ab", _ranks(p))], *[
        F.expr(f"max(case when {_ranks(p)[0]} >= lo and {_ranks(p)[0]} < hi then {end} end)").alias(
            f"{end}{i}") for i, p in enumerate(probs) for end in ("lo", "hi")])
    values = [f"a{i} + (b{i} - a{i}) * ({_position(p)} - floor({_position(p)}))"
              for i, p in enumerate(probs)]
    # the lower of the two ranks: its value is the quantile itself or the last one below it
    below = [f"if({v} > a{i}, hi{i}, lo{i})" for i, v in enumerate(values)]
    return picked.select(
        *[F.col(a).alias(b) for a, b in zip(by, names)], "feature", "n",
        F.array(*map(F.expr, values)).alias("quantiles"), F.array(*map(F.expr, below)).alias("below"))


def _needed(values: DataFrame, cell: Sequence[str], probs: Sequence[float]) -> tuple[DataFrame, int]:
    """``(*cell, bucket, n, start, in_bucket)`` of the buckets that hold a wanted rank, and the largest of them.

    Without groups the bucket counts are as few as the cut points, and are summed up on the driver.
    """
    counts = values.groupBy(*cell, "bucket").agg(F.count("*").alias("in_bucket"))
    if list(cell) == ["feature"]:
        found: dict[str, list[tuple[int, int]]] = {}
        for r in counts.collect():
            found.setdefault(r["feature"], []).append((r["bucket"], r["in_bucket"]))
        kept = [row for c, sizes in found.items() for row in _holders(c, sorted(sizes), probs)]
        return local_rows(values.sparkSession, kept, {
            "feature": "string", "bucket": "int", "n": "bigint", "start": "bigint",
            "in_bucket": "bigint"}), max((r[-1] for r in kept), default=0)
    upto = Window.partitionBy(*cell).orderBy("bucket")
    counts = counts.select(
        *cell, "bucket", F.sum("in_bucket").over(Window.partitionBy(*cell)).alias("n"),
        (F.sum("in_bucket").over(upto) - F.col("in_bucket")).alias("start"), "in_bucket")
    wanted = " or ".join(f"({rank} >= start and {rank} < start + in_bucket)"
                         for p in probs for rank in _ranks(p))
    need = settle(counts.where(wanted))
    return need, need.agg(F.max("in_bucket")).first()[0] or 0


def _holders(feature: str, sizes: Sequence[tuple[int, int]], probs: Sequence[float]) -> list[tuple]:
    """Rows of :func:`_needed` for one column from its ascending ``(bucket, count)``."""
    n, start, kept = sum(k for _, k in sizes), 0, []
    ranks = sorted({int(f((n - 1) * p)) for p in probs for f in (math.floor, math.ceil)})
    for bucket, k in sizes:
        if bisect_left(ranks, start) < bisect_left(ranks, start + k):
            kept.append((feature, bucket, n, start, k))
        start += k
    return kept


def _finer(values: DataFrame, need: DataFrame, cell: Sequence[str], points: Mapping[str, Sequence[float]],
           limit: int) -> dict[str, list[float]]:
    """New cut points inside needed buckets with too many different values, none if there is no such bucket.

    Repeats of one value are counted in the tasks, so they are no reason to cut.
    """
    wide = need.where(F.col("in_bucket") > WIDE * limit)
    inside = values.join(wide.select(*cell, "bucket"), [*cell, "bucket"])
    kinds = inside.groupBy(*cell, "bucket").agg(
        F.approx_count_distinct("x").alias("kinds"), F.count("*").alias("n")).where(F.col("kinds") > WIDE * limit)
    crowded = kinds.groupBy("feature", "bucket").agg(F.max("kinds").alias("kinds"), F.sum("n").alias("n")).collect()
    out: dict[str, list[float]] = {}
    for r in crowded:
        pieces = min(MAX_BUCKETS, max(2, -(-2 * r["kinds"] // (WIDE * limit))))
        rows = inside.where((F.col("feature") == r["feature"]) & (F.col("bucket") == r["bucket"]))
        part = min(1.0, SAMPLED_PER_BUCKET * pieces / r["n"])
        shares = [i / pieces for i in range(1, pieces)]
        # Of the different values of the sample, so that repeats do not take all cuts.
        cuts = rows.sample(part, 42).select("x").distinct().agg(F.percentile_approx("x", shares, 5 * pieces)).first()[0]
        out.setdefault(r["feature"], []).extend(x for x in cuts or [] if x not in set(points[r["feature"]]))
    return {c: p for c, p in out.items() if p}


def _position(p: float) -> str:
    return f"(n - 1) * {p!r}D"


def _ranks(p: float) -> tuple[str, str]:
    return f"floor({_position(p)})", f"ceil({_position(p)})"


def rank_neighbours(df: DataFrame, columns: Sequence[str], probs: Sequence[float],
                    rows_per_sort: int = QUANTILE_ROWS, rows: int | None = None
                    ) -> dict[str, tuple[int, list[tuple[float, float, float, int]]]]:
    """Per column with a value: the number of values, and ``(lower, upper, share, below)`` per quantile.

    The quantile lies ``share`` of the way from the lower to the upper of two neighbouring values;
    ``below`` values are smaller than it. A few values per rank reach the driver.
    """
    found: dict[str, list] = {}
    for r in _near_ranks(df, columns, [float(p) for p in probs], (), rows_per_sort, rows).collect():
        found.setdefault(r["feature"], []).append((r["lo"], r["hi"], r["x"], r["n"]))
    out = {}
    for c, near in found.items():
        n, picked = near[0][-1], []

        def at(rank: int) -> tuple:
            return next(r for r in near if r[0] <= rank < r[1])

        for p in probs:
            position = (n - 1) * float(p)
            (lo, hi, a, _), b = at(math.floor(position)), at(math.ceil(position))[2]
            share = position - math.floor(position)
            picked.append((a, b, share, hi if a + (b - a) * share > a else lo))
        out[c] = n, picked
    return out


def quantile_table(df: DataFrame, columns: Sequence[str], probs: Sequence[float],
                   rows_per_sort: int = QUANTILE_ROWS, rows: int | None = None
                   ) -> dict[str, list[float]]:
    """Ungrouped quantiles on the driver: one short list per column."""
    found = rank_neighbours(df, columns, probs, rows_per_sort, rows)
    return {c: [a + (b - a) * share for a, b, share, _ in picked] for c, (_, picked) in found.items()}


def quantile_ranks(df: DataFrame, columns: Sequence[str], probs: Sequence[float],
                   rows_per_sort: int = QUANTILE_ROWS, rows: int | None = None
                   ) -> dict[str, tuple[int, dict[float, int]]]:
    """Per column its number of values, and how many are below each quantile."""
    found = rank_neighbours(df, columns, probs, rows_per_sort, rows)
    return {c: (n, {a + (b - a) * share: below for a, b, share, below in picked})
            for c, (n, picked) in found.items()}


def running_counts(dist: DataFrame, curve: Sequence[str], score: str, measures: Sequence[str],
                   points: Sequence[float] = ()) -> DataFrame:
    """Running and total sums along ``score`` per curve.

    ``dist`` has one row per curve and distinct score. Adds ``cum_<m>`` (up to and
    including the row), ``tot_<m>`` and ``next_score`` (NULL at the end).
    """
    curve = list(curve)
    if not points:
        w = Window.partitionBy(*curve).orderBy(score)
        whole = Window.partitionBy(*curve)
        return dist.select(
            "*",
            *[F.sum(m).over(w).alias(f"cum_{m}") for m in measures],
            *[F.sum(m).over(whole).alias(f"tot_{m}") for m in measures],
            F.lead(score).over(w).alias("next_score"),
        )
    names = dist.columns
    dist = add_buckets(dist, {score: list(points)}).withColumnRenamed(f"bucket_{score}", "bucket")
    sums = dist.groupBy(*curve, "bucket").agg(
        *[F.sum(m).alias(f"bucket_{m}") for m in measures], F.min(score).alias("first_score"))
    w = Window.partitionBy(*curve).orderBy("bucket")
    whole = Window.partitionBy(*curve)
    sums = settle(sums.select(
        *curve, "bucket",
        *[(F.sum(f"bucket_{m}").over(w) - F.col(f"bucket_{m}")).alias(f"before_{m}")
          for m in measures],
        *[F.sum(f"bucket_{m}").over(whole).alias(f"tot_{m}") for m in measures],
        F.lead("first_score").over(w).alias("following"),
    ))
    inside = Window.partitionBy(*curve, "bucket").orderBy(score)
    joined = dist.join(sums, [*curve, "bucket"])
    return joined.select(
        *names,
        *[(F.col(f"before_{m}") + F.sum(m).over(inside)).alias(f"cum_{m}") for m in measures],
        *[F.col(f"tot_{m}") for m in measures],
        F.coalesce(F.lead(score).over(inside), F.col("following")).alias("next_score"),
    )


def running_best(df: DataFrame, curve: Sequence[str], order: str, value: str, out: str,
                 rows_per_sort: int = ROWS_PER_SORT) -> DataFrame:
    """Add the largest ``value`` seen so far along ``order`` within each curve."""
    curve = list(curve)
    points = cut_points(df, [order], rows_per_sort)[order]
    if not points:
        return df.withColumn(out, F.max(value).over(Window.partitionBy(*curve).orderBy(order)))
    parts = add_buckets(df, {order: points})
    bucket = f"bucket_{order}"
    earlier = Window.partitionBy(*curve).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    before = settle(parts.groupBy(*curve, bucket).agg(F.max(value).alias("__m"))
                    .withColumn("__before", F.max("__m").over(earlier)).drop("__m"))
    inside = Window.partitionBy(*curve, bucket).orderBy(order)
    return parts.join(before, [*curve, bucket]).select(
        *[F.col(c) for c in df.columns],
        F.greatest("__before", F.max(value).over(inside)).alias(out))
