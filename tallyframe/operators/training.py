"""Distributed training, search, calibration and importance on MLlib."""

from __future__ import annotations

import itertools
import json
import random
import time
from collections.abc import Callable, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import asdict, dataclass, replace

from pyspark import StorageLevel
from pyspark.ml.classification import (LogisticRegression, LogisticRegressionModel,
                                       RandomForestClassificationModel, RandomForestClassifier)
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tallyframe.functions.columns import arg_max
from tallyframe.operators import metrics as m
from tallyframe.operators.boosting import BoostedTrees, fit_boosted
from tallyframe.operators.dictionary import Dictionary
from tallyframe.operators.features import FittedFeatures
from tallyframe.operators.forest import Forest, fit_forest
from tallyframe.operators.isotonic import knots
from tallyframe.operators.order import local_rows
from tallyframe.operators.policy import apply_decision, soft_vote
from tallyframe.operators.splits import (class_weights, seeded_sample, shuffle_digest, stratified_folds,
                                         with_class_weights)

KINDS = {"logistic": LogisticRegressionModel, "forest": RandomForestClassificationModel,
         "binned_forest": Forest, "boosted": BoostedTrees}
PATIENCE = 30
#: Wider vectors stay sparse and go to MLlib's forest.
MAX_CELLS = 256
NODE_MEMORY_MB = 2048


@contextmanager
def kept(df: DataFrame):
    """Hold a matrix for an iterative fit; lost parts are rebuilt from their lineage."""
    held = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield held
    finally:
        held.unpersist()


@dataclass
class ClassModel:
    """One multiclass model, or one binary model per class; both add ``probs``."""

    kind: str
    models: list

    def add_probs(self, df: DataFrame, out: str = "probs") -> DataFrame:
        if self.kind in ("boosted", "binned_forest"):
            return self.models[0].add_probs(df, out)
        if len(self.models) == 1:
            scored = self.models[0].transform(df)
            return scored.select(*df.columns, vector_to_array("probability").alias(out))
        columns, scored = list(df.columns), df
        for k, model in enumerate(self.models):
            model = model.copy().setProbabilityCol(f"__p{k}").setRawPredictionCol(
                f"__r{k}").setPredictionCol(f"__y{k}")
            scored = model.transform(scored)
        ones = [vector_to_array(f"__p{k}")[1] for k in range(len(self.models))]
        return scored.select(*columns, normalised(F.array(*ones)).alias(out))


@dataclass
class Ensemble:
    """Soft vote: the mean of its members' probabilities, all found in the same row."""

    members: list[ClassModel]

    def add_probs(self, df: DataFrame, out: str = "probs") -> DataFrame:
        names = [f"__probs_{i}" for i in range(len(self.members))]
        scored = df
        for name, member in zip(names, self.members):
            scored = member.add_probs(scored, name)
        return soft_vote(scored, names, out=out).select(*df.columns, out)


def normalised(scores: Column) -> Column:
    """Scale an array to sum 1; all-zero rows become uniform."""
    total = F.aggregate(scores, F.lit(0.0), lambda a, x: a + x)
    return F.transform(scores, lambda x: F.when(total > 0, x / total).otherwise(
        F.lit(1.0) / F.size(scores)))


def assemble(matrix: DataFrame, features: Sequence[str], label: str, keep: Sequence[str] = ()
             ) -> DataFrame:
    """``(*keep, y_true, features)`` for rows that have a label."""
    rows = matrix.where(F.col(label).isNotNull())
    table = VectorAssembler(inputCols=list(features), outputCol="features").transform(rows)
    return table.select(*keep, F.col(label).cast("int").alias("y_true"), "features")


# -- estimators ---------------------------------------------------------------

def train_logistic(train: DataFrame, c: float = 1.0, iterations: int = 1000) -> ClassModel:
    """Multinomial, balanced weights. ``c`` is the inverse penalty of a summed loss; MLlib
    averages the loss, so the penalty is divided by the number of rows."""
    weighted = with_class_weights(train, "y_true")
    rows = train.count()
    model = LogisticRegression(
        family="multinomial", labelCol="y_true", weightCol="weight", maxIter=iterations,
        regParam=1.0 / (c * max(rows, 1))).fit(weighted)
    return ClassModel("logistic", [model])


def train_forest(train: DataFrame, trees: int = 200, depth: int = 12, min_rows: int = 2,
                 seed: int = 42, memory_mb: int = NODE_MEMORY_MB) -> ClassModel:
    """All trees level by level on a binned table, balanced weights.

    Vectors of more than ``MAX_CELLS`` features go to MLlib, where ``memory_mb`` bounds the sums a task holds:
    the more, the fewer passes over the rows.
    """
    first = train.select(F.size(vector_to_array("features")).alias("n")).first()
    if first is None or first["n"] <= MAX_CELLS:
        found = {r["class"]: r["weight"] for r in class_weights(train, "y_true").collect()}
        weights = [found.get(k, 0.0) for k in range(max(found, default=0) + 1)]
        return ClassModel("binned_forest", [fit_forest(train, weights, trees, depth, min_rows, seed)])
    model = RandomForestClassifier(
        labelCol="y_true", weightCol="weight", numTrees=trees, maxDepth=depth, minInstancesPerNode=min_rows,
        seed=seed, maxMemoryInMB=memory_mb).fit(with_class_weights(train, "y_true"))
    return ClassModel("forest", [model])


def train_boosted(train: DataFrame, valid: DataFrame | None = None, classes: int = 3,
                  rounds: int = 300, depth: int = 5, rate: float = 0.05, subsample: float = 0.8,
                  seed: int = 42, patience: int = PATIENCE) -> ClassModel:
    """One tree per class and round on softmax gradients, with class weights.

    With validation rows growing stops when the loss on them has not improved for ``patience`` rounds,
    and the rounds up to the best one are kept.
    """
    model = fit_boosted(with_class_weights(train, "y_true"), valid, classes, rounds, depth, rate, subsample,
                        seed, patience)
    return ClassModel("boosted", [model])


def best_round(losses: Sequence[float], patience: int) -> int:
    """Number of rounds up to the lowest loss seen before ``patience`` rounds without a lower one."""
    best = 0
    for i, loss in enumerate(losses):
        if loss < losses[best]:
            best = i
        elif i - best >= patience:
            break
    return best + 1


# -- evaluation ---------------------------------------------------------------

def metric_row(scored: DataFrame) -> dict[str, float]:
    """Label metrics of scored rows; one aggregate over k*k counts."""
    wide = m.label_counts(m.with_prediction(scored))
    names = ["accuracy", "f1_macro", "f1_weighted", "precision_macro", "recall_macro"]
    text = m.metric_sql()
    row = wide.select(*[F.expr(f"round({text[n]}, 4)").alias(n) for n in names]).first()
    return row.asDict()


def train_evaluate(candidates: Mapping[str, Callable[[DataFrame], ClassModel]], train: DataFrame,
                   valid: DataFrame) -> tuple[DataFrame, dict[str, ClassModel]]:
    """Fit every candidate: ``(model_name, train_time_sec, metrics...)`` and the models."""
    rows, models = [], {}
    with kept(train) as t, kept(valid) as v:
        for name, fit in candidates.items():
            began = time.monotonic()
            models[name] = fit(t)
            took = round(time.monotonic() - began, 2)
            with kept(models[name].add_probs(v).select("y_true", "probs")) as scored:  # AUC reads it several times
                auc = m.auc_ovr(scored).first()["auc_ovr"]
                rows.append({"model_name": name, "train_time_sec": took, "auc_ovr": auc,
                             **metric_row(scored)})
    kinds = {c: "string" if c == "model_name" else "double" for c in rows[0]}
    return local_rows(train.sparkSession, [tuple(r.values()) for r in rows], kinds), models


class MacroF1(Evaluator):
    """Macro F1 over the labels present, for cross validation."""

    def _evaluate(self, dataset: DataFrame) -> float:
        predicted = dataset.select("y_true", F.col("prediction").cast("int").alias("y_pred"))
        row = m.label_counts(predicted).select(F.expr(m.metric_sql()["f1_macro"])).first()
        return float(row[0] or 0.0)

    def isLargerBetter(self) -> bool:
        return True


def sample_params(space: Mapping[str, Sequence], trials: int, seed: int) -> list[dict]:
    """Distinct seeded draws from a grid, at most the whole grid."""
    grid = [dict(zip(space, values)) for values in itertools.product(*space.values())]
    return random.Random(seed).sample(grid, min(trials, len(grid)))


def param_search(train: DataFrame, key: str, estimator, space: Mapping[str, Sequence],
                 name: str, trials: int = 20, folds: int = 3, seed: int = 42,
                 parallelism: int = 2, fixed: dict | None = None) -> tuple[dict, DataFrame]:
    """(best parameters, trial table ``(model, trial, value, params)``).

    ``fixed`` parameters skip the search. Folds are stratified and drawn once.
    """
    schema = {"model": "string", "trial": "bigint", "value": "double", "params": "string"}
    if fixed is not None:
        return fixed, local_rows(train.sparkSession, [], schema)
    drawn = sample_params(space, trials, seed)
    maps = [{estimator.getParam(p): v for p, v in d.items()} for d in drawn]
    rows = stratified_folds(with_class_weights(train, "y_true"), key, "y_true", folds, seed)
    with kept(rows) as held:
        found = CrossValidator(estimator=estimator, estimatorParamMaps=maps, evaluator=MacroF1(),
                               numFolds=folds, foldCol="fold", parallelism=parallelism).fit(held)
    table = [(name, i, float(v), json.dumps(d, sort_keys=True))
             for i, (d, v) in enumerate(zip(drawn, found.avgMetrics))]
    best = drawn[max(range(len(drawn)), key=lambda i: (found.avgMetrics[i], -i))]
    return best, local_rows(train.sparkSession, table, schema)


# -- calibration --------------------------------------------------------------

@dataclass
class Calibrator:
    method: str
    models: list

    def apply(self, scored: DataFrame, probs: str = "probs", out: str = "calibrated") -> DataFrame:
        columns, df = list(scored.columns), scored
        for k, model in enumerate(self.models):
            if self.method == "isotonic":
                df = model.copy().setFeaturesCol("__s").setPredictionCol(f"__c{k}").transform(
                    df.withColumn("__s", F.get(probs, F.lit(k)))).drop("__s")
            else:
                one = array_to_vector(F.array(F.get(probs, F.lit(k))))
                done = model.copy().setFeaturesCol("__s").setProbabilityCol("__p").transform(
                    df.withColumn("__s", one))
                df = done.withColumn(f"__c{k}", vector_to_array("__p")[1]).drop(
                    "__s", "__p", model.getRawPredictionCol(), model.getPredictionCol())
        raw = F.array(*[F.col(f"__c{k}") for k in range(len(self.models))])
        return df.select(*columns, normalised(raw).alias(out))


def fit_calibrator(held_out: DataFrame, probs: str = "probs", method: str = "isotonic",
                   classes: int = 3, grid: int | None = None) -> Calibrator:
    """One calibrator per class on rows the scoring model has not seen.

    Equal scores are first grouped with their outcomes and weight; neighbours are then pooled inside each
    range of scores and the ranges merged level by level (``isotonic``), so that the fit itself gets
    the knots of the curve only. With a ``grid`` scores are rounded to its steps first.
    """
    models = []
    for k in range(classes):
        points = held_out.select(
            (F.round(F.get(probs, F.lit(k)) * grid) / grid if grid else F.get(probs, F.lit(k)))
            .alias("cell"),
            (F.col("y_true") == k).cast("double").alias("hit"))
        if method == "isotonic":
            points = points.groupBy(F.col("cell").alias("score")).agg(
                F.sum("hit").alias("total"), F.count("*").cast("double").alias("weight"))
            models.append(IsotonicRegression(featuresCol="score", labelCol="target",
                                             weightCol="weight").fit(knots(points)))
        else:
            points = points.groupBy("cell", "hit").agg(F.count("*").cast("double").alias("weight"))
            points = points.select(array_to_vector(F.array("cell")).alias("score"),
                                   "hit", "weight")
            models.append(LogisticRegression(featuresCol="score", labelCol="hit",
                                             weightCol="weight").fit(points))
    return Calibrator(method, models)


# -- importance ---------------------------------------------------------------

def builtin_importance(spark: SparkSession, model: ClassModel, features: Sequence[str],
                       only: Sequence[str] | None = None) -> DataFrame:
    """``(feature, importance)``, largest first; mean absolute weight for linear models."""
    total = [0.0] * len(features)
    for fitted in model.models:
        if model.kind == "logistic":
            weights = abs(fitted.coefficientMatrix.toArray()).mean(axis=0)
        else:
            weights = fitted.featureImportances
            weights = weights.toArray() if model.kind == "forest" else weights
        total = [t + float(w) / len(model.models) for t, w in zip(total, weights)]
    rows = [(f, v) for f, v in zip(features, total) if only is None or f in only]
    return local_rows(spark, rows, {"feature": "string", "importance": "double"}).orderBy(
        F.desc("importance"), "feature")


def permutation_importance(rows: DataFrame, key: str, model: ClassModel, features: Sequence[str],
                           sample: int = 500, seed: int = 42) -> DataFrame:
    """Loss of macro F1 when one feature is shuffled, on a seeded sample of rows.

    Every feature gives its column another order of the sampled rows, found by joining two
    ranks. All features are scored in one job; the window runs over the sample only.
    """
    taken = seeded_sample(rows, key, sample, seed).select(
        F.col(key).alias("key"), "y_true", vector_to_array("features").alias("x"))
    with kept(taken) as s:
        each = s.withColumn("j", F.explode(F.array(*[F.lit(j) for j in range(len(features))])))
        plain = F.row_number().over(Window.partitionBy("j").orderBy("key"))
        mixed = F.row_number().over(Window.partitionBy("j").orderBy(
            shuffle_digest(F.concat_ws("-", "key", "j"), seed)))
        donors = each.select("j", mixed.alias("rank"), F.get("x", F.col("j")).alias("donor"))
        shuffled = each.withColumn("rank", plain).join(donors, ["j", "rank"]).select(
            "j", "y_true", array_to_vector(F.transform(
                "x", lambda v, i: F.when(i == F.col("j"), F.col("donor")).otherwise(v)))
            .alias("features"))
        score = F.expr(m.metric_sql()["f1_macro"])
        scored = model.add_probs(shuffled).withColumn("y_pred", arg_max("probs"))
        after = m.label_counts(scored, ["j"]).select("j", score.alias("after")).collect()
        plain_rows = s.select("y_true", array_to_vector("x").alias("features"))
        base = m.label_counts(m.with_prediction(model.add_probs(plain_rows))).select(score).first()[0]
    table = [(features[r["j"]], float(base - r["after"])) for r in after]
    return local_rows(rows.sparkSession, table, {"feature": "string", "importance": "double"}
                      ).orderBy(F.desc("importance"), "feature")


# -- bundle -------------------------------------------------------------------

def save_bundle(spark: SparkSession, path: str, state: FittedFeatures,
                model: ClassModel | Ensemble) -> None:
    """Features, models, their order and the dictionary of wide columns under one folder."""
    if state.dictionary:
        state = replace(state, dictionary=asdict(Dictionary(**state.dictionary).copied(spark, f"{path}/dictionary")))
    members = model.members if isinstance(model, Ensemble) else [model]
    for i, member in enumerate(members):
        for k, fitted in enumerate(member.models):
            target = f"{path}/member-{i}/model-{k}"
            if isinstance(fitted, (BoostedTrees, Forest)):
                fitted.save(spark, target)
            else:
                fitted.write().overwrite().save(target)
    head = json.dumps({"members": [[x.kind, len(x.models)] for x in members]})
    local_rows(spark, [(head,), (state.to_json(),)], {"value": "string"}).coalesce(1).write.mode(
        "overwrite").text(f"{path}/state")


def load_bundle(spark: SparkSession, path: str) -> tuple[FittedFeatures, ClassModel | Ensemble]:
    docs = [json.loads(r["value"]) for r in spark.read.text(f"{path}/state").collect()]
    head = next(d for d in docs if "members" in d)
    state = FittedFeatures.from_json(json.dumps(next(d for d in docs if "members" not in d)))
    members = [ClassModel(kind, [KINDS[kind].load(f"{path}/member-{i}/model-{k}") for k in range(n)])
               for i, (kind, n) in enumerate(head["members"])]
    return state, members[0] if len(members) == 1 else Ensemble(members)


def batch_score(df: DataFrame, state: FittedFeatures, model: ClassModel | Ensemble,
                keep: Sequence[str]) -> DataFrame:
    """Original key columns, probabilities and decisions of every row, all narrow."""
    features = VectorAssembler(inputCols=state.inputs, outputCol="features").transform(
        state.transform(df, keep)).select(*keep, "features")
    return apply_decision(model.add_probs(features)).drop("features")
