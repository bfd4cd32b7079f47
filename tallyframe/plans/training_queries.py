"""Training, search, calibration and scoring on the demo view.

Models have no SQL side. Their queries return what SQL can tell of the result all the same: rows per
class, sums of probabilities, decisions that follow from them, and equality of two ways to one score.
"""

from __future__ import annotations

import json
from dataclasses import replace

from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from tallyframe.operators import board, metrics as m, policy, search, splits, training as t
from tallyframe.plans import feature_queries as fq, sql_text as q
from tallyframe.plans.presets import DEMO_CONTRACT, DEMO_SPEC
from tallyframe.plans.views import scores
from tallyframe.sources.registry import RegistryStore
from tallyframe.sources.tables import scratch_path
from tallyframe.streaming import run
from tallyframe.streaming.monitors import counters


def _parts(spark, sf):
    """(state, train rows, validation rows), assembled, keyed by id."""
    return _parts_and_rows(spark, sf)[:3]


def _parts_and_rows(spark, sf):
    """Those and the raw rows.

    The matrix is a written table: iterative fits read it again and again, also after an
    executor is lost. So are the raw rows, which the feature fit, the matrix and a scoring read.
    """
    path = scratch_path(spark, "matrix")
    raw = fq.written_dirty(spark, sf)
    state = fq.fitted(spark, sf, raw)
    t.assemble(state.training_matrix(raw, ["id"]), state.inputs, "label", ["id"]).repartition(
        spark.sparkContext.defaultParallelism).write.parquet(f"{path}/rows")
    rows = spark.read.parquet(f"{path}/rows")
    splits.stratified_split(rows, "id", "y_true", {"train": 0.8, "valid": 0.2}).write.partitionBy(
        "split").parquet(f"{path}/split")
    split = spark.read.parquet(f"{path}/split")
    return (state, split.where("split = 'train'").drop("split"),
            split.where("split = 'valid'").drop("split"), raw)


SUM = "abs(aggregate({}, 0D, (a, x) -> a + x) - 1) < 1e-9"


def _evaluated(fit):
    """Per true class of the validation rows: how many, and whether all have proper probabilities and decisions."""
    def query(spark, sf):
        _, train, valid = _parts(spark, sf)
        with t.kept(train) as rows:
            model = fit(rows, valid)
        scored = m.with_prediction(model.add_probs(valid))
        best = F.expr("array_position(probs, array_max(probs)) - 1")
        return scored.groupBy(F.col("y_true").alias("class")).agg(
            F.count("*").alias("support"), F.expr(f"bool_and({SUM.format('probs')})").alias("probs_sum_to_one"),
            F.bool_and((F.col("y_pred") == best) & (F.col("confidence") == F.array_max("probs"))).alias("decided"))
    return query


def _logistic(train, _valid=None):
    return t.train_logistic(train)


def train_evaluate_table(spark, sf):
    """Every candidate once, with all its scores between 0 and 1."""
    _, train, valid = _parts(spark, sf)
    table, _ = t.train_evaluate({
        "logistic": _logistic, "forest": t.train_forest}, train, valid)
    return _in_range(table)


SCORES = ["accuracy", "f1_macro", "f1_weighted", "precision_macro", "recall_macro", "auc_ovr"]


def _in_range(table):
    proper = " and ".join(f"{c} between 0 and 1" for c in SCORES if c in table.columns)
    return table.select("model_name", F.expr(proper).alias("in_range"))


def _search_logistic(rows, params):
    return t.ClassModel("logistic", [LogisticRegression(
        family="multinomial", labelCol="y_true", weightCol="weight", maxIter=100, **params).fit(rows)])


def _search_forest(rows, params):
    return t.train_forest(rows, params["numTrees"], params["maxDepth"], params["minInstancesPerNode"])


FAMILIES = [
    search.Family("logistic", _search_logistic, {"regParam": [0.0, 0.001, 0.01, 0.1], "elasticNetParam": [0.0, 0.5]}),
    search.Family("forest", _search_forest, {"numTrees": [40, 100], "maxDepth": [4, 8, 12], "minInstancesPerNode": [2, 10]}),
]


def param_search_cv(spark, sf):
    """Trials per family and rung, the rows of the last rung, and whether the best trial was finished."""
    _, train, _ = _parts(spark, sf)
    (family, params), trials = search.halving_search(train, "id", FAMILIES, trials=6, parallelism=4)
    best = (F.col("model") == family) & (F.col("params") == json.dumps(params, sort_keys=True)) & (F.col("state") == "finished")
    top = trials.agg(F.bool_or(best & (F.col("value") >= 0))).scalar()
    return trials.groupBy("model", "rung").agg(
        F.count("*").alias("trials"), F.max(F.when(F.col("rung") == 2, F.col("rows"))).alias("rows"),
        F.bool_and(F.col("value").between(0, 1)).alias("in_range")).withColumn("best_finished", top)


def calibrate_isotonic(spark, sf):
    """Per class: the hits of the rows a curve is fitted on, and whether the calibrated scores sum to them."""
    rows = scores(spark, sf).select("key", "y_true", "probs").where("key % 2 = 1")
    calibrator = t.fit_calibrator(rows)
    for k, model in enumerate(calibrator.models):
        rows = model.copy().setFeaturesCol("__s").setPredictionCol(f"c{k}").transform(
            rows.withColumn("__s", F.get("probs", F.lit(k)))).drop("__s")
    sums = rows.agg(*[F.sum(f"c{k}").alias(f"c{k}") for k in range(3)],
                    *[F.count_if(F.col("y_true") == k).alias(f"n{k}") for k in range(3)])
    return sums.select(F.inline(F.array(*[F.struct(
        F.lit(k).alias("class"), F.col(f"n{k}").alias("hits"),
        (F.abs(F.col(f"c{k}") - F.col(f"n{k}")) < 1e-6 * (1 + F.col(f"n{k}"))).alias("kept")) for k in range(3)])))


def builtin_importance(spark, sf):
    """Importances are shares of one, none below zero, one per feature."""
    state, train, _ = _parts(spark, sf)
    found = t.builtin_importance(spark, t.train_forest(train), state.features)
    return found.agg((F.abs(F.sum("importance") - 1) < 1e-9).alias("sum_to_one"),
                     (F.min("importance") >= 0).alias("none_negative"),
                     (F.count_distinct("feature") == len(state.features)).alias("one_per_feature"))


def permutation_importance(spark, sf):
    state, train, valid = _parts(spark, sf)
    found = t.permutation_importance(valid, "id", _logistic(train), state.features, sample=500)
    return found.agg(F.bool_and(F.abs("importance") <= 1).alias("in_range"),
                     (F.count_distinct("feature") == len(state.features)).alias("one_per_feature"))


def _same(rows, others):
    """``(id, same)``: whether two scorings of the same records agree in everything shown."""
    shown = F.struct("predicted_class", "predicted_label", "decision", "action", "risk_level", "confidence", "probs")
    return rows.select("id", shown.alias("a")).join(others.select("id", shown.alias("b")), "id").select(
        "id", F.col("a").eqNullSafe(F.col("b")).alias("same"))


def save_load_fitted(spark, sf):
    """Scores of the loaded bundle against those of the fitted one."""
    state, train, _, rows = _parts_and_rows(spark, sf)
    path, model = scratch_path(spark, "bundle"), _logistic(train)
    t.save_bundle(spark, path, state, model)
    loaded, again = t.load_bundle(spark, path)
    return _same(t.batch_score(rows, state, model, ["id"]), t.batch_score(rows, loaded, again, ["id"]))


def batch_score(spark, sf):
    """Every record, whether its probabilities sum to one and its decision follows the policy from them."""
    state, train, _, rows = _parts_and_rows(spark, sf)
    scored = t.batch_score(rows, state, _logistic(train), ["id"])
    names = ", ".join(f"'{c}'" for c in policy.POLICY)
    brackets = ", ".join(f"'{o.bracket}'" for o in policy.POLICY.values())
    levels = ", ".join(str(o.risk_level) for o in policy.POLICY.values())
    return scored.select("id", F.expr(SUM.format("probs")).alias("probs_sum_to_one"), F.expr(
        f"""predicted_label = array_position(probs, array_max(probs)) - 1
        and predicted_class = array({names})[predicted_label] and risk_level = array({levels})[predicted_label]
        and startswith(decision, array({brackets})[predicted_label]) and confidence = round(array_max(probs), 4)
        and (array_max(probs) < {policy.LOW_CONFIDENCE}D) = endswith(decision, '(low confidence)')""").alias("decided"))


def _scored_stream(spark, sf):
    """(stream of scores, scores of the same records at once); records arrive as files of the demo view."""
    state, train, _, rows = _parts_and_rows(spark, sf)
    model, path = _logistic(train), scratch_path(spark, "records")
    rows.write.parquet(path)
    return (t.batch_score(run.read_stream(spark, path), state, model, ["id"]),
            t.batch_score(spark.read.parquet(path), state, model, ["id"]))


def stream_score(spark, sf):
    """Scores of the stream against those of a batch."""
    stream, batch = _scored_stream(spark, sf)
    return _same(run.run_append(stream.drop("probabilities"), "scored"), batch)


def stream_score_counts(spark, sf):
    """Predictions per class so far, as a running total of the scoring stream, against the batch."""
    stream, batch = _scored_stream(spark, sf)
    counted = run.run_complete(counters(stream, ["predicted_class"]), "classes")
    both = counted.join(batch.groupBy("predicted_class").agg(F.count("*").alias("m")), "predicted_class", "full")
    return both.agg(F.sum("n").alias("total"), F.bool_and(F.col("n").eqNullSafe(F.col("m"))).alias("same"))


def stream_score_following(spark, sf):
    """A stream across a promotion: every record with the version that scored it."""
    state, train, _, rows = _parts_and_rows(spark, sf)
    path, store = scratch_path(spark, "followed"), RegistryStore(spark, scratch_path(spark, "registry"))
    for version, penalty in (("1", 1.0), ("2", 0.01)):
        t.save_bundle(spark, f"{path}/{version}", state, t.train_logistic(train, penalty, 30))
        store.upsert(spark.createDataFrame([("demo", version, f"{path}/{version}", {}, {}, {}, "2024-02-01", "staging")],
                                           board.REGISTRY_SCHEMA))
    store.promote("demo", "1")
    files = []
    for side in (0, 1):  # the files of the first side, written earlier, are the first micro-batch
        rows.where(f"id % 2 = {side}").write.mode("append").parquet(f"{path}/records")
        files.append(len(spark.read.schema(rows.schema).parquet(f"{path}/records").inputFiles()))
    records = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", files[0]).parquet(f"{path}/records")
    done = run.score_following(records, run.ProductionModel(store, "demo"), ["id"],
                               after=lambda number: store.promote("demo", "2") if number == 0 else None)
    return done.select("id", "model_version")


QUERIES = {
    "train_logistic": _evaluated(_logistic),
    "train_random_forest": _evaluated(lambda rows, v: t.train_forest(rows)),
    "train_boosted": _evaluated(t.train_boosted),
    "train_evaluate_table": train_evaluate_table, "param_search_cv": param_search_cv,
    "calibrate_isotonic": calibrate_isotonic, "builtin_importance": builtin_importance,
    "permutation_importance": permutation_importance, "save_load_fitted": save_load_fitted,
    "batch_score": batch_score, "stream_score": stream_score,
    "stream_score_counts": stream_score_counts, "stream_score_following": stream_score_following,
}

LABELLED = f"""(select case label when 'Poor' then 0 when 'Standard' then 1 when 'Good' then 2 end as class,
    count(*) as n, cast(floor(0.8::double * count(*) + 0.5) as bigint) as learnt
  from {q.DIRTY} where label in ('Poor', 'Standard', 'Good') group by label)"""
EVALUATED = f"select class, n - learnt as support, true as probs_sum_to_one, true as decided from {LABELLED} where n > learnt"
SAME = "select c_custkey as id, true as same from customer"

ORACLES = {
    "train_logistic": EVALUATED, "train_random_forest": EVALUATED, "train_boosted": EVALUATED,
    "train_evaluate_table": "select unnest(['logistic', 'forest']) as model_name, true as in_range",
    # 6 trials a family; a third of them, rounded up, goes on
    "param_search_cv": f"""select model, rung::bigint as rung, trials::bigint as trials,
        case when rung = 2 then (select cast(sum(learnt) as bigint) from {LABELLED}) end as rows,
        true as in_range, true as best_finished
      from (values (0, 6), (1, 2), (2, 1)) as r(rung, trials), (select unnest(['logistic', 'forest']) as model)""",
    "calibrate_isotonic": """select class::integer as class, count(o_orderkey) as hits, true as kept
      from (values (0, 'F'), (1, 'O'), (2, 'P')) as c(class, status) left join orders
        on o_orderkey % 2 = 1 and case when o_orderstatus in ('F', 'O') then o_orderstatus else 'P' end = status
      group by class""",
    "builtin_importance": "select true as sum_to_one, true as none_negative, true as one_per_feature",
    "permutation_importance": "select true as in_range, true as one_per_feature",
    "save_load_fitted": SAME, "stream_score": SAME,
    "batch_score": "select c_custkey as id, true as probs_sum_to_one, true as decided from customer",
    "stream_score_counts": "select count(*) as total, true as same from customer",
    "stream_score_following": "select c_custkey as id, case when c_custkey % 2 = 0 then '1' else '2' end as model_version "
                              "from customer",
}


# -- whole jobs ---------------------------------------------------------------

def _tuned_logistic(train, _valid):
    estimator = LogisticRegression(family="multinomial", labelCol="y_true", weightCol="weight",
                                   maxIter=100)
    best, _ = t.param_search(train, "id", estimator, {"regParam": [0.001, 0.1]}, "logistic")
    return t.ClassModel("logistic", [estimator.copy().setParams(**best).fit(
        splits.with_class_weights(train, "y_true"))])


def _trained(spark, sf):
    """(flows, contract, what training leaves, the demo view as a table that training and scoring read)."""
    from tallyframe.plans import flows
    contract = replace(DEMO_CONTRACT, min_rows=100)
    raw = fq.written_dirty(spark, sf)
    return flows, contract, flows.train(raw.where("label is not null"), "id", "occupation", DEMO_SPEC, contract, {
        "logistic": _logistic, "forest": lambda rows, _: t.train_forest(rows)},
        tuners={"logistic": _tuned_logistic}), raw


def training_run(spark, sf):
    flows, _, done, _ = _trained(spark, sf)
    registry, pointer = flows.publish(done, scratch_path(spark, "published"), "demo", "1",
                                      "2024-02-01T00:00:00")
    produced = registry.join(pointer, ["model_name", "version"]).select("version")
    return _in_range(done.leaderboard).withColumn("registered_version", produced.scalar())


def scoring_run(spark, sf):
    flows, contract, done, raw = _trained(spark, sf)
    done = flows.score(raw, "id", done, contract, "batch", "2024-02-01T00:00:00").summary
    return done.select("rows", F.expr("abs(share_poor + share_standard + share_good - 1) < 0.002").alias("shares_sum_to_one"),
                       F.col("drift_status").isNotNull().alias("drift_known"))


def retraining_run(spark, sf):
    flows, _, done, raw = _trained(spark, sf)
    gate = flows.retrain_decision(raw.where("id % 2 = 0"), raw.where("id % 2 = 1"), done)
    checked = flows.validate(raw, done)
    checked = checked.agg(F.bool_and(F.col("passed") == (F.col("failed") == "")).alias("agrees"))
    return gate.select(
        F.expr("retrain = (max_psi > 0.2 or label_shift > 0.1)").alias("retrain_agrees"),
        F.expr("reason = case when max_psi > 0.2 then 'feature drift' when label_shift > 0.1 then 'label drift' "
               "else 'no drift' end").alias("reason_agrees"), checked.scalar().alias("validation_agrees"))


QUERIES |= {"training_run": training_run, "scoring_run": scoring_run,
            "retraining_run": retraining_run}
ORACLES |= {
    "training_run": "select unnest(['logistic', 'forest', 'logistic_tuned', 'soft_vote']) as model_name, "
                    "true as in_range, '1' as registered_version",
    "scoring_run": "select count(*) as rows, true as shares_sum_to_one, true as drift_known from customer",
    "retraining_run": "select true as retrain_agrees, true as reason_agrees, true as validation_agrees",
}
