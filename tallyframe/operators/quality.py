"""Data contracts, validation verdicts and input-quality reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from tallyframe.functions.columns import text_to_number
from tallyframe.operators.order import settle

HIGH_MISSING = 0.40
CRITICAL_MISSING = 0.80
MIN_ROWS = 1_000
MISSING_ALERT = 0.30


class ContractError(ValueError):
    """A table broke its contract."""


@dataclass(frozen=True)
class Contract:
    columns: Sequence[str]
    may_be_absent: Sequence[str] = ()
    label: str | None = None
    label_domain: Sequence[str] = ()
    min_rows: int = MIN_ROWS
    ranges: Mapping[str, tuple[float, float]] = field(default_factory=dict)
    categories: Sequence[str] = ()

    def expected(self, has_label: bool = True) -> list[str]:
        return [c for c in self.columns if has_label or c != self.label]


def long_rows(df: DataFrame, spec: Mapping[str, Column], value: str, name: str = "feature"
              ) -> DataFrame:
    """Turn a one-row wide aggregate into rows; ``spec`` maps names to columns."""
    return df.select(F.inline(F.array(*[
        F.struct(F.lit(k).alias(name), c.alias(value)) for k, c in spec.items()])))


def schema_diff(df: DataFrame, contract: Contract, has_label: bool = True) -> DataFrame:
    """``(column, issue, affected_rows)``: missing columns and extra ones.

    A missing column affects every row, an extra one the rows where it is filled.
    """
    present, expected = set(df.columns), set(contract.expected(has_label))
    missing = sorted(expected - present - set(contract.may_be_absent))
    extra = sorted(present - expected)
    if not missing and not extra:
        return df.sparkSession.createDataFrame([], "column string, issue string, affected_rows bigint")
    counts = df.agg(F.count("*").alias("all_rows"), *[F.count(c).alias(c) for c in extra])
    return counts.select(F.inline(F.array(
        *[F.struct(F.lit(c).alias("column"), F.lit("missing").alias("issue"),
                   F.col("all_rows").alias("affected_rows")) for c in missing],
        *[F.struct(F.lit(c).alias("column"), F.lit("extra").alias("issue"),
                   F.col(c).alias("affected_rows")) for c in extra])))


def row_count_check(df: DataFrame, name: str, min_rows: int = MIN_ROWS) -> DataFrame:
    return df.agg(F.lit(name).alias("name"), F.count("*").alias("row_count"),
                  (F.count("*") >= min_rows).alias("enough"))


def null_rates(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``(feature, rows, missing, missing_rate)`` of all columns from one pass."""
    columns = list(columns or df.columns)
    wide = df.agg(F.count("*").alias("__rows"), *[F.count(c).alias(c) for c in columns])
    return wide.select(F.inline(F.array(*[
        F.expr(f"named_struct('feature', '{c}', 'rows', __rows, 'missing', __rows - `{c}`)")
        for c in columns]))).withColumn(
            "missing_rate", F.round(F.expr("coalesce(missing / nullif(rows, 0), 0D)"), 4))


def null_severity(rates: DataFrame) -> DataFrame:
    """Strict limits on the unrounded rate; the shown rate has 4 decimals."""
    exact = F.expr("coalesce(missing / nullif(rows, 0), 0D)")
    return rates.withColumn("severity", F.when(exact > CRITICAL_MISSING, "error")
                            .when(exact > HIGH_MISSING, "warning").otherwise("ok"))


def unexpected_values(df: DataFrame, column: str, domain: Sequence[str]) -> DataFrame:
    """Distinct non-null values outside a short allowed list, with their row counts."""
    return (df.where(F.col(column).isNotNull() & ~F.col(column).isin(*domain))
            .groupBy(F.col(column).alias("value")).agg(F.count("*").alias("rows")))


def verdict(df: DataFrame, contract: Contract, has_label: bool = True) -> DataFrame:
    """One row: passed, counts, errors[] and warnings[]; everything from one pass."""
    present, expected = set(df.columns), set(contract.expected(has_label))
    missing = sorted(expected - present - set(contract.may_be_absent))
    extra = sorted(present - expected)
    label = contract.label if has_label else None
    aggs = [F.count("*").alias("row_count"), *[F.count(c).alias(f"__n_{c}") for c in df.columns]]
    if label and label in present:
        odd = F.col(label).isNotNull() & ~F.col(label).isin(*contract.label_domain)
        aggs.append(F.count(F.when(odd, 1)).alias("__odd"))
    errors = [F.when(F.col("row_count") < contract.min_rows,
                     F.concat(F.lit("too few rows: "), F.col("row_count").cast("string")))]
    warnings = []
    if missing:
        errors.append(F.lit("missing columns: " + ",".join(missing)))
    if extra:
        warnings.append(F.lit("extra columns: " + ",".join(extra)))
    for c in sorted(df.columns):
        rate = F.expr(f"coalesce((row_count - `__n_{c}`) / nullif(row_count, 0), 0D)")
        errors.append(F.when(rate > CRITICAL_MISSING, F.lit(f"critical missing: {c}")))
        warnings.append(F.when(rate > HIGH_MISSING, F.lit(f"high missing: {c}")))
    if label and label not in present:
        errors.append(F.lit(f"label missing: {label}"))
    elif label:
        warnings.append(F.when(F.col("__odd") > 0, F.lit(f"unexpected labels: {label}")))
    none = F.lit(None).cast("string")
    return df.agg(*aggs).select(
        "row_count", F.lit(len(df.columns)).cast("bigint").alias("col_count"),
        F.array_compact(F.array(*errors, none)).alias("errors"),
        F.array_compact(F.array(*warnings, none)).alias("warnings"),
    ).select((F.size("errors") == 0).alias("passed"), "*")


def require(df: DataFrame, contract: Contract, has_label: bool = True) -> dict:
    """The verdict as a dict; raises when it holds errors."""
    row = verdict(df, contract, has_label).first().asDict()
    if not row["passed"]:
        raise ContractError("; ".join(row["errors"]))
    return row


def as_number(df: DataFrame, column: str) -> Column:
    text = isinstance(df.schema[column].dataType, T.StringType)
    return text_to_number(column) if text else F.col(column).cast("double")


def range_violations(df: DataFrame, ranges: Mapping[str, tuple[float, float]]) -> DataFrame:
    """``(feature, violations)`` for every ruled column present, one pass."""
    ruled = {c: r for c, r in ranges.items() if c in df.columns}
    wide = df.select(*[as_number(df, c).alias(c) for c in ruled]).agg(*[
        F.expr(f"count_if(`{c}` < {lo!r} or `{c}` > {hi!r})").alias(c)
        for c, (lo, hi) in ruled.items()])
    return long_rows(wide, {c: F.col(c) for c in ruled}, "violations")


def category_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(feature, value)``: distinct non-null values per column, as rows.

    Rows rather than one array per column, so no column has to fit in one cell.
    """
    texts = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    return (texts.unpivot([], list(columns), "feature", "value")
            .where(F.col("value").isNotNull()).distinct())


def category_lists(values: DataFrame) -> DataFrame:
    """Sorted set per column, for columns known to hold few values."""
    return values.groupBy("feature").agg(
        F.array_join(F.array_sort(F.collect_set("value")), "|").alias("categories"),
        F.count("*").alias("n"))


def unseen_categories(df: DataFrame, reference_values: DataFrame, columns: Sequence[str]
                      ) -> DataFrame:
    """Values of ``df`` the reference never held, one row each; only columns it knows."""
    known = settle(reference_values)
    shared = [c for c in columns if c in df.columns]
    covered = known.select("feature").distinct()
    return (category_values(df, shared).join(known, ["feature", "value"], "left_anti")
            .join(covered, "feature", "left_semi"))


def input_quality(df: DataFrame, ranges: Mapping[str, tuple[float, float]],
                  reference_values: DataFrame | None, categories: Sequence[str],
                  label: str, stamp: str) -> DataFrame:
    """Long report ``(timestamp, label, metric, feature, value, issue_type)``."""
    rates = settle(null_rates(df))  # one row per column
    total = rates.limit(1).select(
        F.lit("row_count").alias("metric"), F.lit("ALL").alias("feature"),
        F.col("rows").cast("double").alias("value"), F.lit("volume").alias("issue_type"))
    missing = rates.where("missing > 0").select(
        F.lit("missing_rate").alias("metric"), "feature", F.col("missing_rate").alias("value"),
        F.lit("missing").alias("issue_type"))
    outside = range_violations(df, ranges).where("violations > 0").select(
        F.lit("out_of_range_count").alias("metric"), "feature",
        F.col("violations").cast("double").alias("value"),
        F.lit("range_violation").alias("issue_type"))
    parts = [total, missing, outside]
    if reference_values is not None:
        parts.append(unseen_categories(df, reference_values, categories).groupBy("feature").agg(
            F.count("*").cast("double").alias("value")).select(
            F.lit("unseen_category_count").alias("metric"), "feature", "value",
            F.lit("unseen_category").alias("issue_type")))
    rows = reduce(DataFrame.unionByName, parts)
    return rows.select(F.lit(stamp).alias("timestamp"), F.lit(label).alias("label"),
                       "metric", "feature", "value", "issue_type")


def input_alerts(report: DataFrame) -> DataFrame:
    """``(feature, issue_type, value, threshold, alert)`` for missing rates and range hits."""
    rows = report.where(F.col("metric").isin("missing_rate", "out_of_range_count"))
    is_rate = F.col("metric") == "missing_rate"
    limit = F.when(is_rate, F.lit(MISSING_ALERT)).otherwise(F.lit(0.0))
    return rows.select("feature", F.col("metric").alias("issue_type"), "value",
                       limit.alias("threshold"),
                       F.when(~is_rate | (F.col("value") > limit), "YES").otherwise("NO")
                       .alias("alert"))


def with_violations(df: DataFrame, non_negative: Sequence[str]) -> DataFrame:
    """Add ``violations``: which nullable numbers of the row are below zero or no number."""
    checks = []
    for c in non_negative:
        n = as_number(df, c)
        checks.append(F.when(n < 0, F.lit(f"{c}: negative"))
                      .when(F.col(c).isNotNull() & n.isNull(), F.lit(f"{c}: not a number")))
    return df.withColumn("violations", F.array_compact(F.array(*checks)))


def quarantine(df: DataFrame, non_negative: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(accepted rows, rejected rows with their violations)."""
    checked = with_violations(df, non_negative)
    bad = F.size("violations") > 0
    return checked.where(~bad).drop("violations"), checked.where(bad)
