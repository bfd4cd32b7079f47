"""Leaderboards, search histories, the model registry, gates and alert rules."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyframe.operators.order import ROWS_PER_SORT, local_rows, running_best

RANK_KEYS = ("f1_macro", "f1_weighted", "accuracy")
# Fixed values of the gates.
GATE_THRESHOLDS = {"f1_macro": 0.70, "accuracy": 0.75}
PROMOTION_TOLERANCE = 0.005
RETRAIN_PSI = 0.2
RETRAIN_LABEL_SHIFT = 0.1

# Fixed values of the alert rules: metric, comparison, limit, type, severity, message, action.
ALERT_RULES = [
    ("psi_max", ">", 0.20, "drift", "HIGH", "PSI drift detected",
     "Look at the moved columns; retrain if they stay where they are."),
    ("f1_macro", "<", 0.65, "performance", "HIGH", "Model F1 degraded",
     "Evaluate on fresh labels and start a retraining run."),
    ("p95_latency_ms", ">", 500.0, "latency", "MEDIUM", "High latency",
     "Find the slow step of scoring; batch requests or use a smaller model."),
    ("missing_rate", ">", 0.30, "data_quality", "MEDIUM", "High missing rate",
     "Ask the source of the column what has changed."),
]


# -- leaderboards -------------------------------------------------------------

def _best_first(keys: Sequence[str], name: str) -> list[Column]:
    return [*[F.desc(k) for k in keys], F.asc(name)]


def rank_models(metrics: DataFrame, keys: Sequence[str] = RANK_KEYS, name: str = "model_name",
                board: Sequence[str] = ()) -> DataFrame:
    """Add ``rank`` 1..n within each board. One row per candidate model goes in."""
    w = Window.partitionBy(*board).orderBy(*_best_first(keys, name))
    return metrics.withColumn("rank", F.row_number().over(w).cast("bigint"))


def top_models(metrics: DataFrame, k: int = 3, keys: Sequence[str] = RANK_KEYS,
               name: str = "model_name") -> DataFrame:
    return metrics.orderBy(*_best_first(keys, name)).limit(k)


def select_final(metrics: DataFrame, is_ensemble: Column, score: str = "f1_macro",
                 name: str = "model_name") -> DataFrame:
    """One row: the ensemble when it reaches the best single model, else that model."""
    def best(rows: Column) -> Column:
        return F.min(F.when(rows, F.struct((-F.col(score)).alias("m"), F.col(name).alias("name"))))

    both = metrics.agg(best(is_ensemble).alias("e"), best(~is_ensemble).alias("s"))
    wins = F.col("e").isNotNull() & (F.col("s").isNull() | (F.col("e.m") <= F.col("s.m")))
    return both.select(
        F.when(wins, F.col("e.name")).otherwise(F.col("s.name")).alias("final_model"),
        F.when(wins, -F.col("e.m")).otherwise(-F.col("s.m")).alias(score),
        F.when(wins, "ensemble").otherwise("single").alias("kind"))


def base_vs_tuned(base: DataFrame, tuned: DataFrame, score: str = "f1_macro",
                  name: str = "model_name") -> DataFrame:
    b = base.select(name, F.col(score).alias("base"))
    t = tuned.select(name, F.col(score).alias("tuned"))
    return b.join(t, name).withColumn("improvement", F.round(F.col("tuned") - F.col("base"), 6))


def pivot_stages(metrics: DataFrame, stages: Sequence[str], score: str = "f1_macro",
                 name: str = "model_name") -> DataFrame:
    return metrics.groupBy(name).pivot("stage", list(stages)).agg(F.max(score))


def search_convergence(trials: DataFrame, rows_per_sort: int = ROWS_PER_SORT) -> DataFrame:
    """Add ``best_so_far`` per model along the trial number; failed trials keep the best."""
    return running_best(trials, ["model"], "trial", "value", "best_so_far", rows_per_sort)


def search_summary(trials: DataFrame) -> DataFrame:
    return trials.groupBy("model").agg(F.max("value").alias("best_value"),
                                       F.count("value").alias("completed"))


def experiment_summary(metrics: DataFrame, score: str = "f1_macro", name: str = "model_name"
                       ) -> DataFrame:
    return metrics.agg(
        F.count("*").alias("n_models"),
        F.expr(f"min_by({name}, struct(-{score}, {name}))").alias("best_model"),
        F.expr(f"min_by({name}, struct({score}, {name}))").alias("worst_model"),
        F.max(score).alias("max_score"), F.min(score).alias("min_score"),
        F.round(F.max(score) - F.min(score), 6).alias("score_range"))


# -- registry -----------------------------------------------------------------

REGISTRY_SCHEMA = ("model_name string, version string, artifact_path string, "
                   "metrics map<string,double>, params map<string,string>, tags map<string,string>, "
                   "registered_at string, status string")


def registry_upsert(registry: DataFrame, entries: DataFrame) -> DataFrame:
    """An entry replaces the registry's row of its (model, version), whatever the time stamps;
    of several entries the latest counts. Combined in the tasks before the shuffle."""
    rows = registry.withColumn("__new", F.lit(0)).unionByName(entries.withColumn("__new", F.lit(1)))
    kept = rows.groupBy("model_name", "version").agg(F.max_by(
        F.struct(*registry.columns), F.struct("__new", "registered_at")).alias("r"))
    return kept.select("r.*")


def registry_promote(registry: DataFrame, model_name: str, version: str, demote: bool = False
                     ) -> tuple[DataFrame, DataFrame]:
    """(registry with the new status, one-row production pointer); unknown is an error.

    Earlier production rows keep their status unless ``demote``; the pointer decides.
    """
    named = (F.col("model_name") == model_name) & (F.col("version") == version)
    if registry.where(named).isEmpty():
        raise KeyError(f"model {model_name} {version} is not registered")
    status = F.when(named, "production")
    if demote:
        status = status.when(F.col("status") == "production", "archived")
    pointer = local_rows(registry.sparkSession, [(model_name, version)],
                         {"model_name": "string", "version": "string"})
    return registry.withColumn("status", status.otherwise(F.col("status"))), pointer


def registry_production(registry: DataFrame, pointer: DataFrame) -> DataFrame:
    return registry.join(pointer, ["model_name", "version"])


def registry_list(registry: DataFrame, model_name: str | None = None) -> DataFrame:
    return registry if model_name is None else registry.where(F.col("model_name") == model_name)


def registry_best(registry: DataFrame, metric: str = "f1_macro") -> DataFrame:
    """The row with the highest metric; rows without it do not count."""
    value = F.col("metrics")[metric]
    rows = registry.where(value.isNotNull())
    order = F.struct((-value).alias("m"), "model_name", "version")
    return rows.agg(F.min_by(F.struct(*registry.columns), order).alias("r")).where(
        "r is not null").select("r.*")


# -- gates --------------------------------------------------------------------

def validation_gate(metrics: DataFrame, thresholds: Mapping[str, float] = GATE_THRESHOLDS,
                    forced: bool = False) -> DataFrame:
    """One row from ``(metric, value)`` rows: passed, failed metrics, deploy. Missing is 0."""
    rules = local_rows(metrics.sparkSession, list(thresholds.items()),
                       {"metric": "string", "threshold": "double"})
    checked = rules.join(metrics.select("metric", "value"), "metric", "left").select(
        "metric", (F.coalesce("value", F.lit(0.0)) >= F.col("threshold")).alias("ok"))
    return checked.agg(
        F.bool_and("ok").alias("passed"),
        F.array_join(F.array_sort(F.collect_list(F.when(~F.col("ok"), F.col("metric")))), ",")
        .alias("failed"),
    ).withColumn("deploy", F.col("passed") | F.lit(forced))


def promotion_gate(scores: DataFrame, old: str = "old_score", new: str = "new_score",
                   tolerance: float = PROMOTION_TOLERANCE) -> DataFrame:
    """Add ``promote``: no old score, or the new one is not worse by more than the tolerance."""
    return scores.withColumn("promote", F.coalesce(
        F.col(old).isNull() | (F.col(new) >= F.col(old) - tolerance), F.lit(False)))


def retrain_gate(psi: DataFrame | None, label_shift: DataFrame | None, has_new_data: bool = True,
                 forced: bool = False, spark=None) -> DataFrame:
    """One row ``(retrain, reason)``; reasons are tried in a fixed order."""
    spark = spark or (psi.sparkSession if psi is not None else None)
    schema = {"flag": "int", "reason": "string"}

    def fixed(flag: bool, reason: str) -> DataFrame:
        return local_rows(spark, [(int(flag), reason)], schema).select(
            (F.col("flag") == 1).alias("retrain"), "reason")

    if forced:
        return fixed(True, "forced")
    if not has_new_data:
        return fixed(False, "no new data")
    if psi is None:
        return fixed(True, "no reference data")
    shift = F.lit(None).cast("double")
    if label_shift is not None:
        shift = label_shift.select("label_shift").scalar()
    seen = psi.agg(F.max("psi").alias("max_psi"), F.coalesce(
        F.bool_or(F.col("psi") > RETRAIN_PSI), F.lit(False)).alias("moved"))
    seen = seen.withColumn("shift", shift)
    labels = F.coalesce(F.col("shift") > RETRAIN_LABEL_SHIFT, F.lit(False))
    return seen.select(
        (F.col("moved") | labels).alias("retrain"),
        F.when(F.col("moved"), "feature drift").when(labels, "label drift")
        .otherwise("no drift").alias("reason"),
        "max_psi", F.col("shift").alias("label_shift"))


# -- alerts -------------------------------------------------------------------

def alert_rules(metrics: DataFrame, rules: Sequence[tuple] = ALERT_RULES) -> DataFrame:
    """Alerts from ``(metric, feature, value)`` rows; a metric without a row raises none."""
    table = local_rows(metrics.sparkSession, rules, {
        "metric": "string", "op": "string", "threshold": "double", "type": "string",
        "severity": "string", "text": "string", "recommended_action": "string"})
    value, limit = F.col("value"), F.col("threshold")
    hit = F.when(F.col("op") == ">", value > limit).otherwise(value < limit)
    message = F.concat("text", F.lit(": "), "feature", F.lit("="), F.format_string("%.4f", "value"),
                       F.lit(" "), "op", F.lit(" "), F.format_string("%.2f", "threshold"))
    return metrics.join(table, "metric").where(hit).select(
        "type", "severity", "feature", "value", message.alias("message"), "recommended_action")


def union_all(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)
