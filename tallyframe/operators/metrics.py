"""Multiclass evaluation. Input rows hold a true label and an array of class scores.

Everything about labels derives from k*k counts taken in one pass; everything about
score order derives from counts per distinct score with bucketed running sums.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tallyframe.functions.columns import arg_max, even_edges
from tallyframe.operators.bins import OUTSIDE, add_bins
from tallyframe.operators.order import (QUANTILE_ROWS, ROWS_PER_SORT, cut_points, exact_quantiles,
                                        local_rows, running_counts, settle)
from tallyframe.operators.profile import histogram

CLASSES = ("Poor", "Standard", "Good")
MIN_GROUP = 10
LOW_CONFIDENCE = 0.60


def with_prediction(scored: DataFrame, probs: str = "probs") -> DataFrame:
    """Add ``y_pred`` (first maximum) and ``confidence``."""
    return scored.withColumns({"y_pred": arg_max(probs), "confidence": F.array_max(probs)})


# -- counts and what follows from them ----------------------------------------

def cell(i: int, j: int) -> str:
    return f"c_{i}_{j}"


def label_counts(df: DataFrame, by: Sequence[str] = (), k: int = 3) -> DataFrame:
    """Wide counts ``c_true_pred`` and ``n`` per group; NULL groups are left out."""
    rows = df.dropna(subset=list(by)) if by else df
    return rows.groupBy(*by).agg(F.count("*").alias("n"), *[
        F.expr(f"count_if(y_true = {i} and y_pred = {j})").alias(cell(i, j))
        for i in range(k) for j in range(k)])


def _sums(k: int) -> tuple[list[str], list[str], list[str]]:
    hit = [cell(i, i) for i in range(k)]
    true = ["(" + " + ".join(cell(i, j) for j in range(k)) + ")" for i in range(k)]
    pred = ["(" + " + ".join(cell(j, i) for j in range(k)) + ")" for i in range(k)]
    return hit, true, pred


def _share(a: str, b: str) -> str:
    return f"coalesce({a} / nullif({b}, 0), 0D)"


def metric_sql(k: int = 3) -> dict[str, str]:
    """Expressions over the wide counts. Macro means run over labels seen on either side."""
    hit, true, pred = _sums(k)
    f1 = [_share(f"2D * {hit[i]}", f"({true[i]} + {pred[i]})") for i in range(k)]
    precision = [_share(hit[i], pred[i]) for i in range(k)]
    recall = [_share(hit[i], true[i]) for i in range(k)]
    seen = " + ".join(f"if({true[i]} + {pred[i]} > 0, 1, 0)" for i in range(k))

    def macro(parts: list[str]) -> str:
        return f"({' + '.join(parts)}) / nullif({seen}, 0)"

    def weighted(parts: list[str]) -> str:
        return "(" + " + ".join(f"{p} * {t}" for p, t in zip(parts, true)) + ") / nullif(n, 0)"

    out = {"accuracy": f"({' + '.join(hit)}) / nullif(n, 0)",
           "f1_macro": macro(f1), "f1_weighted": weighted(f1),
           "precision_macro": macro(precision), "recall_macro": macro(recall),
           "precision_weighted": weighted(precision), "recall_weighted": weighted(recall)}
    for i in range(k):
        out |= {f"precision_{i}": precision[i], f"recall_{i}": recall[i], f"f1_{i}": f1[i],
                f"support_{i}": true[i]}
    return out


def confusion_matrix(df: DataFrame, k: int = 3) -> DataFrame:
    """``(y_true, y_pred, n, row_share)`` with all k*k cells."""
    wide = label_counts(df, (), k)
    _, true, _ = _sums(k)
    return wide.select(F.inline(F.array(*[F.expr(
        f"named_struct('y_true', {i}, 'y_pred', {j}, 'n', {cell(i, j)}, "
        f"'row_share', round({_share(cell(i, j), true[i])}, 6))")
        for i in range(k) for j in range(k)])))


def classification_report(df: DataFrame, k: int = 3, digits: int = 4) -> DataFrame:
    """``(metric, value)`` rows: overall, macro, weighted and per class."""
    wide = label_counts(df, (), k)
    return wide.select(F.inline(F.array(*[
        F.expr(f"named_struct('metric', '{name}', 'value', round(cast({text} as double), {digits}))")
        for name, text in metric_sql(k).items()])))


def group_metrics(df: DataFrame, by: str, min_rows: int = 0, k: int = 3, digits: int = 4
                  ) -> DataFrame:
    """Macro F1, weighted F1 and accuracy per group; groups under ``min_rows`` are left out."""
    m = metric_sql(k)
    return label_counts(df, [by], k).where(F.col("n") >= min_rows).select(
        F.col(by).cast("string").alias(by), "n",
        *[F.expr(f"round({m[name]}, {digits})").alias(name)
          for name in ("f1_macro", "f1_weighted", "accuracy")])


def fairness_by_group(df: DataFrame, group: str) -> DataFrame:
    if group not in df.columns:
        return df.sparkSession.createDataFrame(
            [], "group string, n bigint, f1_macro double, f1_weighted double, accuracy double")
    return (group_metrics(df, group, MIN_GROUP).withColumnRenamed(group, "group")
            .orderBy("f1_macro", "group"))


def fairness_summary(groups: DataFrame) -> DataFrame:
    """One row: spread of macro F1 over the groups; "skipped" without groups."""
    return groups.agg(
        F.count("*").alias("n_groups"), F.max("f1_macro").alias("max_f1_macro"),
        F.min("f1_macro").alias("min_f1_macro"),
        F.round(F.max("f1_macro") - F.min("f1_macro"), 4).alias("disparity_gap"),
        F.expr("min_by(group, struct(f1_macro, group))").alias("worst_group"),
        F.expr("max_by(group, struct(f1_macro, group))").alias("best_group"),
    ).withColumn("status", F.when(F.col("n_groups") == 0, "skipped").otherwise("ok"))


def performance_stability(df: DataFrame, period: str) -> DataFrame:
    return group_metrics(df, period)


def score_stability(df: DataFrame, value: str, period: str, rows_per_sort: int = QUANTILE_ROWS
                    ) -> DataFrame:
    """Mean, population deviation and p10/p50/p90 per period, missing values ignored."""
    moments = df.dropna(subset=[period]).groupBy(period).agg(
        F.avg(value).alias("mean_score"), F.stddev_pop(value).alias("std_score"))
    quantiles = exact_quantiles(df, [value], [0.1, 0.5, 0.9], [period], rows_per_sort)
    return moments.join(quantiles, period).select(
        period, *[F.round(c, 6).alias(c) for c in ("mean_score", "std_score")],
        *[F.round(F.get("quantiles", F.lit(i)), 6).alias(p)
          for i, p in enumerate(("p10", "p50", "p90"))])


# -- ranking metrics ----------------------------------------------------------

def score_curves(scored: DataFrame, probs: str = "probs", k: int = 3,
                 rows_per_sort: int = ROWS_PER_SORT) -> DataFrame:
    """Per class and distinct score: rows of every true label at and up to that score."""
    long = scored.select("y_true", F.posexplode(probs).alias("class", "score"))
    points = cut_points(long, ["score"], rows_per_sort)["score"]
    dist = long.groupBy("class", "score").agg(*[
        F.expr(f"count_if(y_true = {i})").alias(f"n{i}") for i in range(k)])
    return running_counts(dist, ["class"], "score", [f"n{i}" for i in range(k)], points)


def _own(pattern: str, k: int) -> str:
    """Pick the measure of the row's own class: ``pattern`` holds {} for the class."""
    return "case class " + " ".join(f"when {c} then {pattern.format(c)}" for c in range(k)) + " end"


def _with_sides(curves: DataFrame, k: int) -> DataFrame:
    for name in ("n", "cum_n", "tot_n"):
        every = " + ".join(f"{name}{i}" for i in range(k))
        curves = curves.withColumns({
            f"{name}_pos": F.expr(f"cast({_own(name + '{}', k)} as double)"),
            f"{name}_all": F.expr(f"cast({every} as double)")})
    return curves.select("*", *[F.expr(f"{n}_all - {n}_pos").alias(f"{n}_neg")
                                for n in ("n", "cum_n", "tot_n")])


def auc_ovr_by_class(scored: DataFrame, probs: str = "probs", k: int = 3, **how) -> DataFrame:
    sides = _with_sides(score_curves(scored, probs, k, **how), k)
    return sides.groupBy("class").agg(F.expr(
        "sum(n_pos * (cum_n_neg - n_neg / 2)) / nullif(max(tot_n_pos) * max(tot_n_neg), 0)"
    ).alias("auc"))


def auc_ovr(scored: DataFrame, probs: str = "probs", k: int = 3, **how) -> DataFrame:
    """One row: mean one-vs-rest area under the ROC curve, ties count half."""
    per_class = auc_ovr_by_class(scored, probs, k, **how)
    return per_class.agg(F.count("*").alias("n_classes"), F.round(F.avg("auc"), 6).alias("auc_ovr"))


def auc_ovo(scored: DataFrame, probs: str = "probs", k: int = 3, **how) -> DataFrame:
    """One row: mean over class pairs of their two directed areas."""
    curves = score_curves(scored, probs, k, **how)
    directed = []
    for c in range(k):
        for o in range(k):
            if c != o:
                directed.append(F.expr(
                    f"sum(if(class = {c}, cast(n{c} as double) * (cum_n{o} - n{o} / 2), 0D)) / "
                    f"nullif(cast(max(tot_n{c}) as double) * max(tot_n{o}), 0D)").alias(f"a_{c}_{o}"))
    names = [f"a_{c}_{o}" for c in range(k) for o in range(k) if c != o]
    mean = " + ".join(names)
    return curves.agg(*directed).select(
        F.lit(k * (k - 1) // 2).cast("bigint").alias("n_pairs"),
        F.expr(f"round(({mean}) / {len(names)}, 6)").alias("auc_ovo"))


def ks_by_class(scored: DataFrame, probs: str = "probs", k: int = 3, **how) -> DataFrame:
    """Largest gap between the two cumulative shares, read at the end of tie groups."""
    sides = _with_sides(score_curves(scored, probs, k, **how), k)
    gap = F.expr("abs(cum_n_pos / nullif(tot_n_pos, 0D) - cum_n_neg / nullif(tot_n_neg, 0D))")
    return sides.groupBy("class").agg(
        F.round(F.coalesce(F.max(gap), F.lit(0.0)), 4).alias("ks"))


def roc_points(scored: DataFrame, probs: str = "probs", k: int = 3, grid: int | None = None,
               **how) -> DataFrame:
    """``(class, threshold, fpr, tpr)``; ``grid`` thins to one point per curve cell."""
    sides = _with_sides(score_curves(scored, probs, k, **how), k)
    points = sides.select(
        "class", F.col("score").alias("threshold"),
        F.expr("(tot_n_neg - cum_n_neg + n_neg) / nullif(tot_n_neg, 0D)").alias("fpr"),
        F.expr("(tot_n_pos - cum_n_pos + n_pos) / nullif(tot_n_pos, 0D)").alias("tpr"))
    if grid:
        points = points.groupBy("class", F.floor(F.col("fpr") * grid).alias("fx"),
                                F.floor(F.col("tpr") * grid).alias("ty")).agg(
            F.expr("min(struct(threshold, fpr, tpr))").alias("p")).select("class", "p.*")
    return points


# -- calibration --------------------------------------------------------------

def _class_scores(scored: DataFrame, probs: str, keep: Sequence[str] = ()) -> DataFrame:
    return scored.select(*keep, "y_true", F.posexplode(probs).alias("class", "score")).select(
        *keep, "class", "score", F.expr("if(y_true = class, 1D, 0D)").alias("hit"))


def ece_by_class(scored: DataFrame, probs: str = "probs", bins: int = 10) -> DataFrame:
    """Expected calibration error per class over [lo,hi) bins; a score of 1 is in no bin."""
    binned = add_bins(_class_scores(scored, probs), {"score": even_edges(bins)}, "left")
    cells = binned.groupBy("class", "bin_score").agg(
        F.count("*").alias("n"), F.avg("score").alias("conf"), F.avg("hit").alias("acc"))
    return cells.groupBy("class").agg(F.round(F.expr(
        f"sum(if(bin_score = {OUTSIDE}, 0D, n * abs(conf - acc))) / sum(n)"), 4).alias("ece"))


def calibration_before_after(scored: DataFrame, before: str, after: str, bins: int = 10
                             ) -> DataFrame:
    """``(class, ece_before, ece_after)`` plus a "mean" row."""
    b = ece_by_class(scored, before, bins).withColumnRenamed("ece", "ece_before")
    a = ece_by_class(scored, after, bins).withColumnRenamed("ece", "ece_after")
    both = settle(b.join(a, "class")).withColumn("class", F.col("class").cast("string"))
    return both.unionByName(both.agg(
        F.lit("mean").alias("class"), F.round(F.avg("ece_before"), 4).alias("ece_before"),
        F.round(F.avg("ece_after"), 4).alias("ece_after")))


def reliability_curve(scored: DataFrame, probs: str = "probs", bins: int = 10) -> DataFrame:
    """Mean score and observed share per class and filled bin; an inner edge belongs below."""
    binned = add_bins(_class_scores(scored, probs), {"score": even_edges(bins)}, "right",
                      close_end=True)
    return binned.where(F.col("bin_score") != OUTSIDE).groupBy(
        "class", F.col("bin_score").alias("bin")).agg(
        F.count("*").alias("n"), F.round(F.avg("score"), 6).alias("mean_predicted"),
        F.round(F.avg("hit"), 6).alias("fraction_positive"))


# -- error analysis -----------------------------------------------------------

def class_name(code: Column, classes: Sequence[str] = CLASSES) -> Column:
    return F.element_at(F.array(*[F.lit(c) for c in classes]), code + 1)


def error_patterns(predicted: DataFrame, classes: Sequence[str] = CLASSES) -> DataFrame:
    wrong = predicted.where("y_true <> y_pred")
    pattern = F.concat_ws(" -> ", class_name(F.col("y_true"), classes),
                          class_name(F.col("y_pred"), classes))
    return wrong.groupBy(pattern.alias("pattern")).agg(F.count("*").alias("n")).orderBy(
        F.desc("n"), "pattern")


def confidence_by_correctness(predicted: DataFrame, bins: int = 40) -> DataFrame:
    """Histogram and median of the confidence of right and of wrong rows."""
    out = None
    marked = predicted.select("confidence", F.expr("if(y_true = y_pred, 'right', 'wrong')")
                              .alias("outcome"))
    medians = settle(exact_quantiles(marked, ["confidence"], [0.5], ["outcome"]))
    for outcome in ("right", "wrong"):
        part = histogram(marked.where(F.col("outcome") == outcome), ["confidence"], bins)
        part = part.select(F.lit(outcome).alias("outcome"), "bin", "n")
        out = part if out is None else out.unionByName(part)
    return out.join(medians.select("outcome", F.round(F.get("quantiles", F.lit(0)), 6)
                                   .alias("median_confidence")), "outcome")


def low_confidence_error_rate(predicted: DataFrame, threshold: float = LOW_CONFIDENCE) -> DataFrame:
    low, wrong = f"confidence < {threshold}D", "if(y_true <> y_pred, 1D, 0D)"
    return predicted.agg(
        F.count("*").alias("n"), F.expr(f"count_if({low})").alias("n_low"),
        F.expr(f"round(count_if({low}) / count(*), 6)").alias("low_share"),
        F.expr(f"round(avg(if({low}, {wrong}, null)), 6)").alias("error_rate_low"),
        F.expr(f"round(avg(if({low}, null, {wrong})), 6)").alias("error_rate_high"))


def error_rate_by_confidence(predicted: DataFrame, bins: int = 10) -> DataFrame:
    """Error rate and count per (a,b] confidence bin; empty bins are listed."""
    edges = even_edges(bins)
    binned = add_bins(predicted, {"confidence": edges}, "right")
    counts = binned.groupBy(F.col("bin_confidence").alias("bin")).agg(
        F.count("*").alias("n"), F.avg(F.expr("if(y_true <> y_pred, 1D, 0D)")).alias("e"))
    grid = local_rows(predicted.sparkSession, [(i, edges[i], edges[i + 1]) for i in range(bins)],
                      {"bin": "int", "lo": "double", "hi": "double"})
    return grid.join(counts, "bin", "left").select(
        "bin", F.round("lo", 6).alias("lo"), F.round("hi", 6).alias("hi"),
        F.coalesce("n", F.lit(0).cast("bigint")).alias("n"), F.round("e", 6).alias("error_rate"))


def business_impact(predicted: DataFrame) -> DataFrame:
    """Costly errors: risky accepted (A), safe rejected (B), middle class missed (C)."""
    _, true, _ = _sums(3)
    wide = label_counts(predicted)
    parts = {"A": (cell(0, 2), true[0]), "B": (cell(2, 0), true[2]),
             "C": (f"({cell(1, 0)} + {cell(1, 2)})", true[1])}
    return wide.select(F.inline(F.array(*[F.expr(
        f"named_struct('type', '{t}', 'errors', {e}, 'of_class', {n}, "
        f"'rate', round({_share(e, n)}, 6))") for t, (e, n) in parts.items()])))


def metrics_long(predicted: DataFrame, version: str, split: str) -> DataFrame:
    return classification_report(predicted).select(
        F.lit(version).alias("model_version"), F.lit(split).alias("split"), "metric", "value")


def overall_error_rate(predicted: DataFrame, threshold: float = LOW_CONFIDENCE) -> DataFrame:
    """One row: size, errors, most common error, share of low confidence."""
    common = error_patterns(predicted).agg(F.expr("min_by(pattern, struct(-n, pattern))"))
    return predicted.agg(
        F.count("*").alias("n"), F.expr("count_if(y_true <> y_pred)").alias("errors"),
        F.expr("round(avg(if(y_true <> y_pred, 1D, 0D)) * 100, 4)").alias("error_pct"),
        F.expr(f"round(avg(if(confidence < {threshold}D, 1D, 0D)) * 100, 4)").alias("low_conf_pct"),
    ).withColumn("most_common_error", common.scalar())


def feature_means_by_correctness(predicted: DataFrame, features: Sequence[str]) -> DataFrame:
    wide = predicted.agg(*[
        F.expr(f"named_struct('feature', '{c}', 'a', avg(if(y_true = y_pred, {c}, null)), "
               f"'b', avg(if(y_true <> y_pred, {c}, null)))").alias(f"s_{c}") for c in features])
    return wide.select(F.inline(F.array(*[f"s_{c}" for c in features]))).select(
        "feature", F.round("a", 6).alias("mean_right"), F.round("b", 6).alias("mean_wrong"),
        F.expr("round((b - a) / (abs(a) + 1e-9D) * 100, 6)").alias("diff_pct"))
