"""The four batch jobs end to end: training, scoring, validation gate and retraining.

Each is a composition of the operators. Between stages only small tables and fitted state
come to the driver; rows stay in lazily planned DataFrames.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from tallyframe.operators import board, drift, metrics as m, policy, quality, splits, training as t
from tallyframe.operators.features import FeatureSpec, FittedFeatures
from tallyframe.operators.order import local_rows
from tallyframe.sources import tables as io

PARTS = {"train": 0.70, "valid": 0.15, "test": 0.15}
Fit = Callable[[DataFrame, DataFrame], t.ClassModel]


@dataclass
class Trained:
    state: FittedFeatures
    model: t.ClassModel | t.Ensemble
    leaderboard: DataFrame
    report: DataFrame
    calibration: DataFrame
    importance: DataFrame
    fairness: DataFrame
    reference: drift.DriftReference
    reference_values: DataFrame
    final_model: str


def train(raw: DataFrame, key: str, group: str, spec: FeatureSpec, contract: quality.Contract,
          candidates: Mapping[str, Fit], parts: Mapping[str, float] = PARTS, top: int = 3,
          tuners: Mapping[str, Fit] | None = None, seed: int = 42) -> Trained:
    """Contract, split, features, models, soft vote of the best, evaluation and reports.

    ``tuners`` hold a search per candidate; those of the best candidates are run, and a
    tuned model takes its candidate's place in the vote where it scores higher.
    """
    quality.require(raw, contract)
    label = spec.label
    known = raw.where(F.col(label).isin(*contract.label_domain))
    # Written once: the fits below read the parts many times, and split and features
    # should not be planned again for each of them; nor should rows be scored for every report.
    path = io.scratch_path(raw.sparkSession, "training")
    io.write_parquet(splits.stratified_split(known, key, label, dict(parts), seed), f"{path}/split")
    split = raw.sparkSession.read.parquet(f"{path}/split")
    raw_part = {p: split.where(F.col("split") == p).drop("split") for p in parts}
    state = FittedFeatures.fit(raw_part["train"], spec)

    def matrix(part: str, keep: Sequence[str] = ()) -> DataFrame:
        rows = raw_part[part].withColumn("__group", F.col(group)) if keep else raw_part[part]
        return io.cached(raw.sparkSession, f"{path}/{part}", lambda: t.assemble(
            state.training_matrix(rows, [key, *keep]), state.inputs, label, [key, *keep]))

    fit_rows, valid = matrix("train"), matrix("valid")
    ranked, models = t.train_evaluate(
        {n: (lambda rows, f=f: f(rows, valid)) for n, f in candidates.items()}, fit_rows, valid)
    best = [r["model_name"] for r in board.top_models(ranked, top).collect()]
    searched = {f"{n}_tuned": (lambda rows, f=tuners[n]: f(rows, valid))
                for n in best if n in (tuners or {})}
    if searched:
        tuned, more = t.train_evaluate(searched, fit_rows, valid)
        ranked, models = ranked.unionByName(tuned), models | more
        score = {r["model_name"]: r["f1_macro"] for r in ranked.collect()}
        best = [max((x for x in (n, f"{n}_tuned") if x in models), key=score.get) for n in best]
    vote = t.Ensemble([models[n] for n in best])

    def scored_by(who: t.ClassModel | t.Ensemble, name: str, rows: DataFrame) -> DataFrame:
        return io.cached(raw.sparkSession, f"{path}/{name}", lambda: who.add_probs(rows))

    scored = scored_by(vote, "voted", valid)
    row = {"model_name": "soft_vote", "train_time_sec": 0.0,
           "auc_ovr": m.auc_ovr(scored).first()["auc_ovr"], **t.metric_row(scored)}
    kinds = dict.fromkeys(ranked.columns, "double") | {"model_name": "string"}
    voted = local_rows(raw.sparkSession, [tuple(row[c] for c in ranked.columns)], kinds)
    everyone = ranked.unionByName(voted)
    final = board.select_final(everyone, F.col("model_name") == "soft_vote").first()["final_model"]
    models["soft_vote"] = vote
    model = models[final]
    calibrator = t.fit_calibrator(scored if model is vote else scored_by(model, "chosen", valid))
    importance = t.permutation_importance(valid, key, model, state.features, seed=seed)
    tested = m.with_prediction(scored_by(model, "tested", matrix("test", ["__group"])))
    return Trained(
        state, model, board.rank_models(everyone), m.classification_report(tested),
        m.calibration_before_after(calibrator.apply(tested), "probs", "calibrated"), importance,
        m.fairness_by_group(tested, "__group"),
        drift.DriftReference.fit(state.transform(raw_part["train"]), state.features),
        quality.category_values(raw_part["train"], contract.categories), final)


@dataclass
class Scored:
    rows: DataFrame
    input_report: DataFrame
    distribution: DataFrame
    confidence: DataFrame
    drift: DataFrame
    summary: DataFrame


def score(batch: DataFrame, key: str, trained: Trained, contract: quality.Contract,
          label: str, stamp: str) -> Scored:
    """Decisions for a batch plus its input, output and drift reports."""
    rows = t.batch_score(batch, trained.state, trained.model, [key])
    predicted = rows.select(F.col("predicted_label").alias("y_pred"), "confidence", "probs")
    psi = drift.psi_numeric(trained.state.transform(batch), trained.reference).withColumn(
        "status", drift.psi_status(F.col("psi")))
    overall = drift.overall_status(drift.psi_summary(psi))
    exact = predicted.withColumn("confidence", F.array_max("probs"))
    return Scored(
        rows, quality.input_quality(batch, contract.ranges, trained.reference_values,
                                    contract.categories, label, stamp),
        policy.prediction_distribution(predicted), policy.confidence_profile(exact), psi,
        policy.scoring_summary(predicted, overall))


def validate(labelled: DataFrame, trained: Trained, forced: bool = False) -> DataFrame:
    """Gate on labelled raw rows, with the caps stored at training time."""
    spec = trained.state.spec
    rows = t.assemble(trained.state.training_matrix(labelled), trained.state.inputs, spec.label)
    report = m.classification_report(m.with_prediction(trained.model.add_probs(rows)))
    return board.validation_gate(report, forced=forced)


def retrain_decision(reference: DataFrame, current: DataFrame, trained: Trained) -> DataFrame:
    """Gate row from feature drift and from the shift of the predicted scores."""
    psi = drift.psi_numeric(trained.state.transform(current), trained.reference)

    def scored(df: DataFrame, is_ref: bool) -> DataFrame:
        table = t.batch_score(df, trained.state, trained.model, [])
        return table.select("probs", F.lit(is_ref).alias("is_ref"))

    both = io.cached(reference.sparkSession, io.scratch_path(reference.sparkSession, "shift"),
                     lambda: scored(reference, True).unionByName(scored(current, False)))
    return board.retrain_gate(psi, drift.label_shift(both, "probs", F.col("is_ref")))


def publish(trained: Trained, path: str, name: str, version: str, stamp: str,
            registry: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Save the bundle, register it and point production at it."""
    spark = trained.leaderboard.sparkSession
    t.save_bundle(spark, f"{path}/bundle", trained.state, trained.model)
    io.write_parquet(trained.importance, f"{path}/importance")
    found = {r["metric"]: r["value"] for r in trained.report.collect()}
    entry = spark.createDataFrame(
        [(name, version, f"{path}/bundle", found, {"final_model": trained.final_model}, {}, stamp,
          "staging")], board.REGISTRY_SCHEMA)
    known = entry if registry is None else board.registry_upsert(registry, entry)
    return board.registry_promote(known, name, version)
