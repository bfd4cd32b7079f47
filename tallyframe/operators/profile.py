"""Profiling aggregates: every column in one pass, results as rows."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql import types as T

from tallyframe.functions.columns import even_edges, finite
from tallyframe.operators.bins import add_bins
from tallyframe.operators.order import QUANTILE_ROWS, exact_quantiles, local_rows, settle
from tallyframe.operators.quality import null_rates


def _rows(wide: DataFrame, structs: Sequence[str]) -> DataFrame:
    return wide.select(F.inline(F.array(*[F.expr(s) for s in structs])))


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def describe(df: DataFrame, columns: Sequence[str], rows_per_sort: int = QUANTILE_ROWS) -> DataFrame:
    """``(feature, count, mean, std, min, p25, p50, p75, max)``; exact percentiles.

    NaN and infinite values count as missing everywhere.
    """
    df = _finite(df, columns)
    wide = df.agg(*[
        F.expr(f"named_struct('feature', '{c}', 'count', count({c}), 'mean', avg({c}), "
               f"'std', stddev_samp({c}), 'min', cast(min({c}) as double), "
               f"'max', cast(max({c}) as double))").alias(f"s_{c}") for c in columns])
    moments = wide.select(F.inline(F.array(*[f"s_{c}" for c in columns])))
    quartiles = exact_quantiles(df, columns, [0.25, 0.5, 0.75], rows_per_sort=rows_per_sort)
    return moments.join(settle(quartiles), "feature", "left").select(
        "feature", "count", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"), "min",
        *[F.round(F.get("quantiles", F.lit(i)), 6).alias(f"p{p}") for i, p in enumerate((25, 50, 75))],
        "max")


def _finite(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """These columns alone; fractions that are NaN or infinite become NULL."""
    fractions = (T.DoubleType, T.FloatType)
    return df.select(*[finite(F.col(c).cast("double")).alias(c) if isinstance(df.schema[c].dataType, fractions)
                       else F.col(c) for c in columns])


def top_values(df: DataFrame, columns: Sequence[str], k: int = 15) -> DataFrame:
    """The k most frequent values per column with their share of all rows.

    The rank filter is applied in every task before the shuffle, so a column with very
    many values never meets in one place.
    """
    texts = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    counts = (texts.unpivot([], list(columns), "feature", "value")
              .where(F.col("value").isNotNull()).groupBy("feature", "value")
              .agg(F.count("*").alias("n")))
    rank = F.row_number().over(Window.partitionBy("feature").orderBy(F.desc("n"), "value"))
    top = counts.withColumn("rank", rank).where(F.col("rank") <= k)
    whole = df.agg(F.count("*"))
    return top.select("feature", "value", "n", "rank",
                      F.round(F.col("n") * 100.0 / whole.scalar(), 2).alias("pct"))


def histogram(df: DataFrame, columns: Sequence[str], bins: int) -> DataFrame:
    """``(feature, bin, lo, hi, n)``: equal widths between minimum and maximum, last bin closed."""
    narrow = df.select(*[finite(F.col(c).cast("double")).alias(c) for c in columns])
    span = narrow.agg(*[f(c).alias(f"{n}_{c}") for c in columns
                        for n, f in (("lo", F.min), ("hi", F.max))]).first()
    edges = {}
    for c in columns:
        lo, hi = span[f"lo_{c}"], span[f"hi_{c}"]
        if lo is not None:  # a constant column gets a unit range around its value
            edges[c] = even_edges(bins, lo, hi) if lo < hi else even_edges(bins, lo - 0.5, lo + 0.5)
    binned = add_bins(narrow, edges, "left", close_end=True)
    counts = binned.select(F.inline(F.array(*[
        F.expr(f"named_struct('feature', '{c}', 'bin', bin_{c})") for c in edges]))
    ).where("bin is not null").groupBy("feature", "bin").agg(F.count("*").alias("n"))
    grid = local_rows(
        df.sparkSession, [(c, i, e[i], e[i + 1]) for c, e in edges.items() for i in range(bins)],
        {"feature": "string", "bin": "int", "lo": "double", "hi": "double"})
    return grid.join(counts, ["feature", "bin"], "left").select(
        "feature", "bin", "lo", "hi", F.coalesce("n", F.lit(0).cast("bigint")).alias("n"))


def box_stats(df: DataFrame, columns: Sequence[str], by: str, rows_per_sort: int = QUANTILE_ROWS
              ) -> DataFrame:
    """Quartiles and whiskers per class: the last values inside the 1.5 IQR fences."""
    quartiles = settle(exact_quantiles(df, columns, [0.25, 0.5, 0.75], [by], rows_per_sort))
    fences = quartiles.select(
        by, "feature", "n", *[F.get("quantiles", F.lit(i)).alias(c)
                              for i, c in enumerate(("q1", "median", "q3"))])
    long = df.select(by, *[F.col(c).cast("double").alias(c) for c in columns]).unpivot(
        [by], list(columns), "feature", "x").where("x is not null")
    inside = "x between q1 - 1.5 * (q3 - q1) and q3 + 1.5 * (q3 - q1)"
    return (long.join(fences, [by, "feature"]).where(inside)
            .groupBy(by, "feature", "n", "q1", "median", "q3")
            .agg(F.min("x").alias("low"), F.max("x").alias("high")))


def crosstab_pct(df: DataFrame, row: str, column: str, row_values: Sequence[str],
                 column_values: Sequence[str]) -> DataFrame:
    """Row shares in percent; listed columns always appear, 0 where empty."""
    shown = df.where(F.col(row).isin(*row_values))
    cells = shown.groupBy(row).agg(
        F.count(column).alias("n"),
        *[F.count(F.when(F.col(column) == v, 1)).alias(v) for v in column_values])
    return cells.select(row, *[
        F.round(F.coalesce(F.col(v) * 100.0 / F.nullif("n", F.lit(0)), F.lit(0.0)), 4).alias(v)
        for v in column_values])


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(x, y, r)`` for every unordered pair, pairwise complete; NULL where a side is constant.

    Each task multiplies its Arrow batches, shifted by the means, and only k*k sums per task are
    shuffled. NaN and infinities count as missing, whatever the number of columns.
    """
    columns = list(columns)
    narrow = df.select(*[finite(F.col(c).cast("double")).alias(c) for c in columns])
    means = narrow.agg(*[F.avg(c).alias(c) for c in columns]).first()
    shift = np.array([means[c] or 0.0 for c in columns])

    def products(batches):
        n = sx = sxx = sxy = 0.0
        for batch in batches:
            x = np.column_stack([
                np.asarray(col.to_numpy(zero_copy_only=False), dtype=float) for col in batch.columns])
            filled = (~np.isnan(x)).astype(float)
            x = np.where(np.isnan(x), 0.0, x - shift)
            n, sx = n + filled.T @ filled, sx + x.T @ filled
            sxx, sxy = sxx + (x * x).T @ filled, sxy + x.T @ x
        if isinstance(n, float):
            return
        i, j = np.triu_indices(len(columns), 1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(v) for v in (i, j, n[i, j], sx[i, j], sx[j, i], sxx[i, j], sxx[j, i],
                                   sxy[i, j])], ["i", "j", "n", "sx", "sy", "sxx", "syy", "sxy"])

    sums = narrow.mapInArrow(products, "i long, j long, n double, sx double, sy double, "
                                       "sxx double, syy double, sxy double")
    total = sums.groupBy("i", "j").agg(*[F.sum(c).alias(c)
                                         for c in ("n", "sx", "sy", "sxx", "syy", "sxy")])
    # what is left of a constant after the shift is rounding, far below its square
    spread = " * ".join(f"sqrt(if(n * s{a}{a} - s{a} * s{a} > 1e-12 * n * n * pow(m{a}, 2), "
                        f"n * s{a}{a} - s{a} * s{a}, 0D))" for a in "xy")
    at = F.array(*[F.lit(float(v)) for v in shift])
    total = total.withColumns({"mx": F.get(at, F.col("i")), "my": F.get(at, F.col("j"))})
    names = F.array(*[F.lit(c) for c in columns])
    return total.select(F.get(names, F.col("i")).alias("x"), F.get(names, F.col("j")).alias("y"),
                        F.expr(f"(n * sxy - sx * sy) / nullif({spread}, 0D)").alias("r"))


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Full symmetric matrix as rows; the diagonal is 1, NULL for a constant column."""
    half = correlations(df, columns)
    both = half.unionByName(half.select(F.col("y").alias("x"), F.col("x").alias("y"), "r"))
    span = df.agg(*[F.expr(f"named_struct('x', '{c}', 'y', '{c}', 'r', if(min(v) < max(v), 1D, null))"
                           .replace("(v)", f"(cast(`{c}` as double))")).alias(f"d{j}")
                    for j, c in enumerate(columns)])
    diagonal = span.select(F.inline(F.array(*[f"d{j}" for j in range(len(columns))])))
    return both.unionByName(diagonal).select("x", "y", F.round("r", 6).alias("r"))


def target_correlations(df: DataFrame, columns: Sequence[str], target: str, k: int = 12
                        ) -> DataFrame:
    wide = df.agg(*[F.abs(F.corr(finite(F.col(c).cast("double")), finite(
        F.col(target).cast("double")))).alias(c) for c in columns])
    rows = _rows(wide, [f"named_struct('feature', '{c}', 'abs_r', round(`{c}`, 6))" for c in columns])
    return rows.orderBy(F.desc_nulls_last("abs_r"), "feature").limit(k)


def high_correlations(df: DataFrame, columns: Sequence[str], limit: float = 0.80) -> DataFrame:
    pairs = correlations(df, columns).where(F.abs("r") > limit)
    return pairs.select("x", "y", F.round("r", 4).alias("r")).orderBy(F.desc(F.abs("r")), "x", "y")


def iqr_outliers(df: DataFrame, columns: Sequence[str], rows_per_sort: int = QUANTILE_ROWS
                 ) -> DataFrame:
    """Quartiles, fences, and how many rows lie beyond them; pct is of all rows."""
    found = {r["feature"]: r["quantiles"] for r in exact_quantiles(
        df, columns, [0.25, 0.75], rows_per_sort=rows_per_sort).collect()}
    fences = {}
    for c, (q1, q3) in found.items():
        fences[c] = (q1, q3, q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1))
    wide = df.agg(F.count("*").alias("__rows"), *[
        F.expr(f"count_if({c} < {lo!r}D or {c} > {hi!r}D)").alias(c)
        for c, (_, _, lo, hi) in fences.items()])
    return _rows(wide, [
        f"named_struct('feature', '{c}', 'q1', round({q1!r}D, 6), 'q3', round({q3!r}D, 6), "
        f"'lower', round({lo!r}D, 6), 'upper', round({hi!r}D, 6), 'outliers', `{c}`, "
        f"'pct', round(`{c}` * 100D / __rows, 2))"
        for c, (q1, q3, lo, hi) in fences.items()]).orderBy(F.desc("pct"), "feature")


def variance_rank(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    columns = list(columns or numeric_columns(df))
    wide = _finite(df, columns).agg(*[F.var_samp(F.col(c).cast("double")).alias(c) for c in columns])
    return _rows(wide, [f"named_struct('feature', '{c}', 'variance', round(`{c}`, 6))"
                        for c in columns]).orderBy(F.desc("variance"), "feature")


def group_importance(importance: DataFrame, groups: dict[str, str]) -> DataFrame:
    """Mean importance and number of features per feature group."""
    group: Column = F.lit("other")
    for name, g in groups.items():
        group = F.when(F.col("feature") == name, g).otherwise(group)
    return importance.groupBy(group.alias("feature_group")).agg(
        F.avg("importance").alias("mean_importance"), F.count("*").alias("n"))


def missing_report(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    rates = null_rates(df, columns).where("missing > 0")
    return rates.select("feature", "missing", F.expr("round(missing * 100D / rows, 2)").alias("pct")
                        ).orderBy(F.desc("missing"), "feature")


def insights(df: DataFrame, label: str, codes: Column, numeric: Sequence[str]) -> DataFrame:
    """One row: size, class shares, worst column, strongest predictor."""
    missing = missing_report(df).agg(
        F.count("*").alias("columns_with_missing"),
        F.expr("min_by(feature, struct(-missing, feature))").alias("worst_column"))
    strongest = target_correlations(df.withColumn("__code", codes), numeric, "__code",
                                    len(numeric)).agg(
        F.expr("min_by(feature, struct(-abs_r, feature))"))
    shares = df.groupBy(label).agg(F.count("*").alias("n")).where(F.col(label).isNotNull())
    text = shares.agg(F.array_join(F.array_sort(F.collect_list(
        F.concat(F.col(label), F.lit("="), F.col("n").cast("string")))), ","))
    return missing.select(
        df.agg(F.count("*")).scalar().alias("rows"),
        F.lit(len(df.columns)).cast("bigint").alias("n_columns"), "columns_with_missing",
        "worst_column", text.scalar().alias("class_counts"),
        strongest.scalar().alias("strongest_predictor"))
