"""From class probabilities to decisions, votes and distributions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tallyframe.functions.columns import arg_max
from tallyframe.operators.metrics import CLASSES, LOW_CONFIDENCE
from tallyframe.operators.order import QUANTILE_ROWS, exact_quantiles

REVIEW = "manual_review"


@dataclass(frozen=True)
class Outcome:
    bracket: str
    action: str
    risk_level: int


# Fixed values of the decision policy.
POLICY = {
    "Poor": Outcome("High Risk", "reject", 3),
    "Standard": Outcome("Medium Risk", "manual_review", 2),
    "Good": Outcome("Low Risk", "approve", 1),
}


def _pick(label: Column, values: Sequence) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), label + 1)


def apply_decision(scored: DataFrame, probs: str = "probs", threshold: float = LOW_CONFIDENCE,
                   classes: Sequence[str] = CLASSES, policy: Mapping[str, Outcome] = POLICY
                   ) -> DataFrame:
    """Add class, bracket, action and rounded probabilities to every row; no shuffle.

    The threshold is tested on the unrounded confidence.
    """
    df = scored.withColumns({"predicted_label": arg_max(probs), "__conf": F.array_max(probs)})
    label, low = F.col("predicted_label"), F.col("__conf") < threshold
    bracket = _pick(label, [policy[c].bracket for c in classes])
    rounded = F.transform(probs, lambda p: F.round(p, 4))
    return df.withColumns({
        "predicted_class": _pick(label, classes),
        "risk_level": _pick(label, [policy[c].risk_level for c in classes]),
        "decision": F.when(low, F.concat(bracket, F.lit(" (low confidence)"))).otherwise(bracket),
        "action": F.when(low, REVIEW).otherwise(_pick(label, [policy[c].action for c in classes])),
        "probabilities": F.map_from_arrays(F.array(*[F.lit(c) for c in classes]), rounded),
        "confidence": F.round("__conf", 4),
    }).drop("__conf")


def soft_vote(scored: DataFrame, sets: Sequence[str], k: int = 3, out: str = "probs") -> DataFrame:
    """Mean class probabilities over several models' arrays in the same row."""
    mean = F.array(*[F.expr("(" + " + ".join(f"{s}[{i}]" for s in sets) + f") / {len(sets)}")
                     for i in range(k)])
    return scored.withColumn(out, mean)


def prediction_distribution(predicted: DataFrame, classes: Sequence[str] = CLASSES) -> DataFrame:
    """``(class, n, pct)`` with every class present, 0 on empty input."""
    wide = predicted.agg(F.count("*").alias("n"), *[
        F.expr(f"count_if(y_pred = {i})").alias(f"n{i}") for i in range(len(classes))])
    return wide.select(F.inline(F.array(*[F.expr(
        f"named_struct('class', '{c}', 'n', n{i}, "
        f"'pct', round(coalesce(n{i} * 100D / nullif(n, 0), 0D), 2))")
        for i, c in enumerate(classes)])))


def confidence_profile(predicted: DataFrame, threshold: float = LOW_CONFIDENCE,
                       rows_per_sort: int = QUANTILE_ROWS) -> DataFrame:
    """Mean, quantiles and low share of the confidence, one row."""
    q = exact_quantiles(predicted, ["confidence"], [0.1, 0.25, 0.75, 0.9],
                        rows_per_sort=rows_per_sort)
    flat = predicted.agg(
        F.round(F.avg("confidence"), 4).alias("mean"),
        F.expr(f"round(avg(if(confidence < {threshold}D, 1D, 0D)) * 100, 2)").alias("low_conf_pct"))
    return flat.withColumn("quantiles", q.select("quantiles").scalar()).select(
        "mean", *[F.round(F.get("quantiles", F.lit(i)), 4).alias(f"p{p}")
                  for i, p in enumerate((10, 25, 75, 90))], "low_conf_pct")


def scoring_summary(predicted: DataFrame, drift_status: DataFrame, classes: Sequence[str] = CLASSES
                    ) -> DataFrame:
    """One row: rows, share per class (3 decimals), overall drift status."""
    shares = [F.expr(f"round(coalesce(count_if(y_pred = {i}) / nullif(count(*), 0), 0D), 3)")
              .alias(f"share_{c.lower()}") for i, c in enumerate(classes)]
    return predicted.agg(F.count("*").alias("rows"), *shares).withColumn(
        "drift_status", drift_status.select("overall_status").limit(1).scalar())
