"""Population stability, Wasserstein shift, and drift reports."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from tallyframe.functions.columns import even_edges, finite
from tallyframe.operators.bins import add_bins
from tallyframe.operators.order import (QUANTILE_ROWS, ROWS_PER_SORT, cut_points, local_rows,
                                        quantile_ranks, running_counts, settle)

EPSILON = 1e-6
STABLE_BELOW = 0.10
WARNING_BELOW = 0.20


def is_numeric(field: T.StructField) -> bool:
    return isinstance(field.dataType, (T.NumericType, T.BooleanType))


def shared_numeric(reference: DataFrame, current: DataFrame) -> list[str]:
    return [f.name for f in reference.schema if is_numeric(f) and f.name in current.columns]


def psi_status(psi: Column) -> Column:
    return (F.when(psi.isNull(), "unknown").when(psi < STABLE_BELOW, "stable")
            .when(psi < WARNING_BELOW, "warning").otherwise("drift"))


def _literal_map(values: Mapping[str, Column]) -> Column:
    return F.create_map(*[item for k, v in values.items() for item in (F.lit(k), v)])


@dataclass(frozen=True)
class DriftReference:
    """Frozen reference side: bin edges and expected shares per numeric column."""

    edges: dict[str, list[float]]
    shares: dict[str, list[float]]

    @classmethod
    def fit(cls, reference: DataFrame, columns: Sequence[str], bins: int = 10,
            rows_per_sort: int = QUANTILE_ROWS, rows: int | None = None) -> "DriftReference":
        """Edges are quantiles, so their ranks already tell how many values each bin holds."""
        edges, shares = {}, {}
        ranks = quantile_ranks(reference, columns, even_edges(bins), rows_per_sort, rows)
        for c, (n, below) in ranks.items():
            if len(below) >= 2:
                edges[c] = sorted(below)
                upto = [below[e] for e in edges[c][:-1]] + [n]
                shares[c] = [(b - a) / n for a, b in zip(upto, upto[1:])]
        return cls(edges, shares)

    def to_json(self) -> str:
        return json.dumps(asdict(self), sort_keys=True)

    @classmethod
    def from_json(cls, text: str) -> "DriftReference":
        return cls(**json.loads(text))


def bin_rows(df: DataFrame, edges: Mapping[str, Sequence[float]], by: Sequence[str] = ()
             ) -> DataFrame:
    """One row per value: ``(*by, feature, bin)``; no shuffle."""
    if not edges:
        return df.select(*by, F.lit("").alias("feature"), F.lit(0).alias("bin")).limit(0)
    narrow = df.select(*by, *[finite(F.col(c).cast("double")).alias(c) for c in edges])
    binned = add_bins(narrow, edges, "left", close_end=True)
    return binned.select(*by, F.inline(F.array(*[
        F.expr(f"named_struct('feature', '{c}', 'bin', `bin_{c}`)") for c in edges
    ]))).where("bin is not null")


def bin_counts(df: DataFrame, edges: Mapping[str, Sequence[float]], by: Sequence[str] = ()
               ) -> DataFrame:
    """Counts of all columns in one shuffle; partial counts are made before it."""
    return bin_rows(df, edges, by).groupBy(*by, "feature", "bin").agg(F.count("*").alias("n"))


def psi_from_counts(counts: DataFrame, ref: DriftReference, by: Sequence[str] = ()) -> DataFrame:
    """``(*by, feature, n, psi)`` from current bin counts; 6 decimals."""
    widest = max((len(s) for s in ref.shares.values()), default=0)
    return psi_select(counts.groupBy(*by, "feature").agg(
        F.sum("n").alias("n"),
        *[F.expr(f"sum(if(bin = {i}, n, 0L))").alias(f"b{i}") for i in range(widest)],
    ), ref, by)


def psi_by_window(current: DataFrame, ref: DriftReference, by: Sequence[str],
                  columns: Sequence[str]) -> DataFrame:
    """``(*by, feature, n, psi)`` for every window and column, with NULL where nothing can be
    compared: a column without two edges in the reference, or without a value in the window.

    One aggregate, so it runs on streams too; rows without a bin are counted as no value.
    """
    narrow = current.select(*by, *[finite(F.col(c).cast("double")).alias(c) for c in ref.edges])
    binned = add_bins(narrow, ref.edges, "left", close_end=True)
    known = [f"named_struct('feature', '{c}', 'bin', `bin_{c}`)" for c in ref.edges]
    empty = [f"named_struct('feature', '{c}', 'bin', cast(null as int))" for c in columns
             if c not in ref.edges]
    widest = max((len(s) for s in ref.shares.values()), default=0)
    sums = binned.select(*by, F.inline(F.array(*map(F.expr, known + empty)))).groupBy(
        *by, "feature").agg(F.count("bin").alias("n"), *[
            F.expr(f"count_if(bin = {i})").alias(f"b{i}") for i in range(widest)])
    return psi_select(sums, ref, by)


def psi_select(sums: DataFrame, ref: DriftReference, by: Sequence[str] = ()) -> DataFrame:
    """PSI from rows holding the total ``n`` and one count ``b0``, ``b1``, ... per bin."""
    if not ref.shares:
        return sums.select(*by, "feature", "n", F.lit(None).cast("double").alias("psi"))
    widest = max(len(s) for s in ref.shares.values())
    expected = F.element_at(_literal_map({
        c: F.array(*[F.lit(float(x)) for x in s]) for c, s in ref.shares.items()}), F.col("feature"))
    expected = F.when(F.col("feature").isin(*ref.shares), expected)
    terms = []
    for i in range(widest):
        a, e = f"(b{i} / nullif(n, 0) + {EPSILON}D)", f"(expected[{i}] + {EPSILON}D)"
        terms.append(f"if({i} < size(expected), ({a} - {e}) * ln({a} / {e}), 0D)")
    compared = F.col("expected").isNotNull() & (F.col("n") > 0)
    return (sums.withColumn("expected", expected)
            .select(*by, "feature", "n", F.when(
                compared, F.round(F.expr(" + ".join(terms)), 6)).alias("psi")))


def psi_numeric(current: DataFrame, ref: DriftReference, by: Sequence[str] = ()) -> DataFrame:
    return psi_from_counts(bin_counts(current, ref.edges, by), ref, by)


def side_counts(reference: DataFrame, current: DataFrame, columns: Sequence[str]
                ) -> tuple[tuple[int, int], dict[str, tuple[int, int]]]:
    """Rows of both sides, and the values of each column on both, in one aggregate."""
    def flags(df: DataFrame, side: int) -> DataFrame:
        return df.select(F.lit(side).alias("__ref"), *[F.isnotnull(c).alias(c) for c in columns])

    row = flags(reference, 1).unionByName(flags(current, 0)).agg(
        F.sum("__ref").alias("__rows"), F.sum(1 - F.col("__ref")).alias("__others"),
        *[F.count_if(F.col(c) & (F.col("__ref") == side)).alias(f"{c}_{side}")
          for c in columns for side in (1, 0)]).first()
    return (row["__rows"] or 0, row["__others"] or 0), {c: (row[f"{c}_1"], row[f"{c}_0"]) for c in columns}


def psi_categorical(reference: DataFrame, current: DataFrame, columns: Sequence[str],
                    totals: Mapping[str, tuple[int, int]] | None = None) -> DataFrame:
    """``(feature, psi)`` over the union of both category sets.

    Both sides meet in one aggregate keyed by category, which is the full outer join
    of two counts with one shuffle less. ``totals``: values of both sides, where they are known.
    """
    totals = side_counts(reference, current, columns)[1] if totals is None else totals

    def long(df: DataFrame, side: int) -> DataFrame:
        text = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
        return (text.unpivot([], list(columns), "feature", "value")
                .where(F.col("value").isNotNull()).withColumn("is_ref", F.lit(side)))

    counts = (long(reference, 1).unionByName(long(current, 0)).groupBy("feature", "value")
              .agg(F.sum("is_ref").alias("e_n"), F.sum(1 - F.col("is_ref")).alias("a_n")))

    def share(n: str, side: int) -> Column:
        whole = _literal_map({c: F.lit(t[side]).cast("long") for c, t in totals.items()})
        return F.coalesce(F.col(n) / F.nullif(F.element_at(whole, F.col("feature")), F.lit(0)), F.lit(0.0)) + EPSILON

    e, a = share("e_n", 0), share("a_n", 1)
    return counts.groupBy("feature").agg(F.round(F.sum((a - e) * F.ln(a / e)), 6).alias("psi"))


def psi_table(reference: DataFrame, current: DataFrame, columns: Sequence[str] | None = None,
              bins: int = 10, rows_per_sort: int = QUANTILE_ROWS) -> DataFrame:
    """``(feature, psi, status)``, one row per compared column."""
    columns = list(columns) if columns is not None else shared_numeric(reference, current)
    columns = [c for c in columns if c in reference.columns and c in current.columns]
    numeric = [c for c in columns if is_numeric(reference.schema[c])]
    text = [c for c in columns if c not in numeric]
    spark = reference.sparkSession
    (rows, others), totals = side_counts(reference, current, text)
    compared = numeric if others else []  # nothing to compare with an empty table
    ref = DriftReference.fit(reference, compared, bins, rows_per_sort, rows) if compared else DriftReference({}, {})
    # A column that cannot be compared has a row of its own.
    other = [c for c in numeric if c not in ref.edges]
    parts = [local_rows(spark, [(c, None) for c in other] + [(c, 0.0) for c in text if not sum(totals[c])],
                        {"feature": "string", "psi": "double"})]
    if ref.edges:
        parts.append(psi_by_window(current, ref, [], list(ref.edges)).select("feature", "psi"))
    if text:
        parts.append(psi_categorical(reference, current, text, totals))
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return found.select("feature", "psi", psi_status(F.col("psi")).alias("status"))


def psi_summary(table: DataFrame) -> DataFrame:
    """One row: counts per status, extremes, and the drifted columns by name."""
    def n(status: str) -> Column:
        return F.count(F.when(F.col("status") == status, 1)).alias(f"n_{status}")

    return table.agg(
        F.count("*").alias("n_features"), n("stable"), n("warning"), n("drift"),
        F.max("psi").alias("max_psi"), F.round(F.avg("psi"), 6).alias("mean_psi"),
        F.array_join(F.array_sort(F.collect_list(
            F.when(F.col("status") == "drift", F.col("feature")))), ",").alias("drifted_features"),
    )


def overall_status(summary: DataFrame) -> DataFrame:
    status = (F.when(F.col("n_drift") > 0, "drift").when(F.col("n_warning") > 0, "warning")
              .otherwise("stable"))
    return summary.withColumn("overall_status", status)


def drift_report(reference: DataFrame | None, current: DataFrame, window: str = "latest",
                 columns: Sequence[str] | None = None, bins: int = 10) -> DataFrame:
    """PSI rows stamped with window, thresholds and the overall status.

    Without a reference the report has no feature rows and says "skipped".
    """
    if reference is None:
        return current.sparkSession.createDataFrame(
            [(None, None, None, window, STABLE_BELOW, WARNING_BELOW, "skipped")],
            "feature string, psi double, status string, monitoring_window string, "
            "stable_threshold double, warning_threshold double, overall_status string")
    table = settle(psi_table(reference, current, columns, bins))  # one row per column
    overall = overall_status(psi_summary(table)).select("overall_status")
    return table.select(
        "*", F.lit(window).alias("monitoring_window"),
        F.lit(STABLE_BELOW).alias("stable_threshold"),
        F.lit(WARNING_BELOW).alias("warning_threshold"),
        overall.scalar().alias("overall_status"))


def drift_by_window(reference: DataFrame, current: DataFrame, window: Column,
                    columns: Sequence[str], bins: int = 10, rows: int | None = None) -> DataFrame:
    """PSI per window and column against one frozen reference, "unknown" where it has no value.

    ``rows``: at least as many as the reference has, where that is known.
    """
    ref = DriftReference.fit(reference, columns, bins, rows=rows)
    psi = psi_by_window(current.withColumn("monitoring_window", window), ref,
                        ["monitoring_window"], columns)
    return psi.select("monitoring_window", "feature", "n", "psi",
                      psi_status(F.col("psi")).alias("status"))


def wasserstein_by_class(scored: DataFrame, probs: str, is_reference: Column,
                         rows_per_sort: int = ROWS_PER_SORT) -> DataFrame:
    """``(class, w1)``: area between the two score distributions of each class."""
    long = scored.select(is_reference.cast("int").alias("is_ref"),
                         F.posexplode(probs).alias("class", "score"))
    points = cut_points(long, ["score"], rows_per_sort)["score"]
    dist = long.groupBy("class", "score").agg(
        F.sum("is_ref").alias("r"), F.sum(1 - F.col("is_ref")).alias("c"))
    curve = running_counts(dist, ["class"], "score", ["r", "c"], points)
    gap = F.abs(F.col("cum_r") / F.nullif(F.col("tot_r"), F.lit(0))
                - F.col("cum_c") / F.nullif(F.col("tot_c"), F.lit(0)))
    return curve.groupBy("class").agg(F.coalesce(
        F.sum(gap * (F.col("next_score") - F.col("score"))), F.lit(0.0)).alias("w1"))


def label_shift(scored: DataFrame, probs: str, is_reference: Column,
                rows_per_sort: int = ROWS_PER_SORT) -> DataFrame:
    """One row: mean Wasserstein-1 distance over the classes."""
    per_class = wasserstein_by_class(scored, probs, is_reference, rows_per_sort)
    return per_class.agg(F.count("*").alias("n_classes"),
                         F.round(F.avg("w1"), 6).alias("label_shift"))
