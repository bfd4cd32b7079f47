"""Metrics, calibration, drift and policy against plain numpy on small tables."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyframe.operators import drift, metrics as m, policy, profile
from tallyframe.operators.order import local_rows


def scored_frame(spark, probs, truth, extra=None):
    rows = [(i, int(t), *map(float, p)) for i, (t, p) in enumerate(zip(truth, probs))]
    df = local_rows(spark, rows, {"key": "bigint", "y_true": "int", "p0": "double", "p1": "double",
                                  "p2": "double"})
    return df.select("key", "y_true", F.array("p0", "p1", "p2").alias("probs"))


@pytest.fixture(scope="module")
def sample():
    rng = np.random.default_rng(5)
    truth = rng.integers(0, 3, 600)
    raw = rng.random((600, 3)) + 0.6 * np.eye(3)[truth]
    probs = np.round(raw / raw.sum(axis=1, keepdims=True), 2)
    return probs, truth


def auc(score, pos, neg):
    wins = (score[pos][:, None] > score[neg][None, :]).sum() + 0.5 * (
        score[pos][:, None] == score[neg][None, :]).sum()
    return wins / (pos.sum() * neg.sum())


@pytest.mark.parametrize("how", [{}, {"rows_per_sort": 100}])
def test_ranking_metrics(spark, sample, how):
    probs, truth = sample
    df = scored_frame(spark, probs, truth)
    ovr = np.mean([auc(probs[:, k], truth == k, truth != k) for k in range(3)])
    ovo = np.mean([auc(probs[:, a], truth == a, truth == b)
                   for a in range(3) for b in range(3) if a != b])
    assert m.auc_ovr(df, **how).first()["auc_ovr"] == pytest.approx(ovr, abs=1e-6)
    assert m.auc_ovo(df, **how).first()["auc_ovo"] == pytest.approx(ovo, abs=1e-6)
    for r in m.ks_by_class(df, **how).collect():
        k = r["class"]
        gaps = [abs((probs[truth == k, k] <= s).mean() - (probs[truth != k, k] <= s).mean())
                for s in np.unique(probs[:, k])]
        assert r["ks"] == pytest.approx(max(gaps), abs=5e-5)


def test_auc_flips_with_the_score(spark, sample):
    probs, truth = sample
    a = {r["class"]: r["auc"] for r in m.auc_ovr_by_class(scored_frame(spark, probs, truth)).collect()}
    b = {r["class"]: r["auc"] for r in m.auc_ovr_by_class(scored_frame(spark, 1 - probs, truth)).collect()}
    assert all(a[k] + b[k] == pytest.approx(1) for k in a)


def test_ks_is_zero_when_a_side_is_empty(spark):
    df = scored_frame(spark, [[0.2, 0.3, 0.5]] * 4, [0, 0, 0, 0])
    assert {r["ks"] for r in m.ks_by_class(df).collect()} == {0.0}


def test_roc_thinning_keeps_the_shape(spark, sample):
    df = scored_frame(spark, *sample)
    assert m.roc_points(df, grid=10).count() < m.roc_points(df).count()


def test_macro_average_over_labels_seen(spark):
    df = local_rows(spark, [("a", 0, 0)] * 6 + [("a", 0, 1)] * 4 + [("b", 2, 2)] * 9,
                    {"grp": "string", "y_true": "int", "y_pred": "int"})
    rows = m.fairness_by_group(df, "grp").collect()
    assert [(r["group"], r["n"]) for r in rows] == [("a", 10)]  # "b" is under the floor
    assert rows[0]["f1_macro"] == round((2 * 6 / 16 + 0) / 2, 4)
    empty = m.fairness_by_group(df.where("false"), "grp")
    assert m.fairness_summary(empty).first()["status"] == "skipped"
    assert m.fairness_by_group(df, "absent").count() == 0


def test_ece_and_reliability_edges(spark):
    """0.3 lies below the third edge 0.30000000000000004; 1.0 is in no ECE bin."""
    probs = [[0.3, 0.0, 0.7], [0.3, 0.7, 0.0], [1.0, 0.0, 0.0], [0.0, 1.0, 0.0]]
    df = scored_frame(spark, probs, [0, 1, 0, 1])
    ece = {r["class"]: r["ece"] for r in m.ece_by_class(df).collect()}
    want = {}
    edges = np.linspace(0, 1, 11)
    p, t = np.array(probs), np.array([0, 1, 0, 1])
    for k in range(3):
        total = 0
        for lo, hi in zip(edges[:-1], edges[1:]):
            inside = (p[:, k] >= lo) & (p[:, k] < hi)
            if inside.any():
                total += inside.mean() * abs(p[inside, k].mean() - (t[inside] == k).mean())
        want[k] = round(total, 4)
    assert ece == want
    curve = [(r["class"], r["bin"], r["n"]) for r in m.reliability_curve(df).collect()]
    assert (0, 2, 2) in curve and (0, 9, 1) in curve


def numpy_psi(ref, cur, bins=10, eps=1e-6):
    edges = np.unique(np.quantile(ref, np.linspace(0, 1, bins + 1)))
    e = np.histogram(ref, edges)[0] / len(ref) + eps
    a = np.histogram(cur, edges)[0] / len(cur) + eps
    return round(float(((a - e) * np.log(a / e)).sum()), 6)


@pytest.mark.parametrize("rows_per_sort", [100_000, 60])
def test_psi_matches_numpy(spark, rows_per_sort):
    rng = np.random.default_rng(11)
    ref = np.round(rng.normal(0, 1, 1200), 2)
    cur = np.round(rng.normal(0.4, 1.5, 700), 2)  # some rows beyond the reference range
    flat = np.array([1.0] * 400 + [2.0] * 800)

    def table(x, y):
        return local_rows(spark, [(float(a), float(b), "u" if b > 1 else "v", 3.0)
                                  for a, b in zip(x, y)],
                          {"x": "double", "y": "double", "c": "string", "k": "double"})
    before, after = table(ref, flat), table(cur, flat[:700])
    rows = {r["feature"]: r for r in drift.psi_table(
        before, after, ["x", "y", "c", "k", "gone"], rows_per_sort=rows_per_sort).collect()}
    assert set(rows) == {"x", "y", "c", "k"}
    assert rows["x"]["psi"] == pytest.approx(numpy_psi(ref, cur), abs=2e-6)
    assert rows["y"]["psi"] == pytest.approx(numpy_psi(flat, flat[:700]), abs=2e-6)
    assert rows["k"]["psi"] is None and rows["k"]["status"] == "unknown"
    same = drift.psi_table(before, before, ["x", "c"]).collect()
    assert all(r["psi"] == 0 and r["status"] == "stable" for r in same)


def test_psi_of_empty_sides(spark):
    df = local_rows(spark, [(1.0, "a"), (2.0, "b")], {"x": "double", "c": "string"})
    none = df.where("false")
    rows = {r["feature"]: (r["psi"], r["status"]) for r in drift.psi_table(df, none, ["x", "c"]).collect()}
    assert rows["x"] == (None, "unknown") and rows["c"][1] == "drift"
    assert {r["psi"] for r in drift.psi_table(none, none, ["c"]).collect()} == {0.0}


def test_drift_reference_survives_json(spark):
    df = spark.range(100).select(F.col("id").cast("double").alias("x"))
    ref = drift.DriftReference.fit(df, ["x"])
    assert drift.DriftReference.from_json(ref.to_json()) == ref
    report = drift.drift_report(None, df)
    assert report.first()["overall_status"] == "skipped"


@pytest.mark.parametrize("rows_per_sort", [100_000, 50])
def test_wasserstein(spark, sample, rows_per_sort):
    probs, truth = sample
    df = scored_frame(spark, probs, truth)
    is_ref = F.col("key") < 250
    got = {r["class"]: r["w1"] for r in drift.wasserstein_by_class(
        df, "probs", is_ref, rows_per_sort).collect()}
    for k in range(3):
        a, b = probs[:250, k], probs[250:, k]
        grid = np.unique(probs[:, k])
        fa, fb = [(a <= s).mean() for s in grid], [(b <= s).mean() for s in grid]
        want = sum(abs(x - y) * d for x, y, d in zip(fa, fb, np.diff(grid)))
        assert got[k] == pytest.approx(want)
    same = drift.label_shift(df.unionByName(df.withColumn("key", F.col("key") + 1000)), "probs",
                             F.col("key") < 1000)
    assert same.first()["label_shift"] == 0


def test_decisions(spark):
    df = scored_frame(spark, [[0.4, 0.4, 0.2], [0.59999, 0.2, 0.20001], [0.1, 0.1, 0.8], [0.6, 0.4, 0]],
                      [0, 0, 2, 0])
    rows = policy.apply_decision(df).orderBy("key").collect()
    assert [r["predicted_class"] for r in rows] == ["Poor", "Poor", "Good", "Poor"]
    assert [r["action"] for r in rows] == ["manual_review", "manual_review", "approve", "reject"]
    assert rows[1]["confidence"] == 0.6 and rows[1]["decision"] == "High Risk (low confidence)"
    assert rows[2]["probabilities"] == {"Poor": 0.1, "Standard": 0.1, "Good": 0.8}
    none = m.with_prediction(df.where("false"))
    assert [tuple(r) for r in policy.prediction_distribution(none).collect()] == [
        ("Poor", 0, 0.0), ("Standard", 0, 0.0), ("Good", 0, 0.0)]


def test_correlations_agree_between_both_plans(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(1000, 3, (500, 12))
    x[:, 1] = x[:, 0] * 2 + rng.normal(0, 1, 500)
    gaps = rng.random((500, 12)) < 0.1
    rows = [tuple(None if g else float(v) for v, g in zip(r, s)) for r, s in zip(x, gaps)]
    names = [f"c{i}" for i in range(12)]
    df = local_rows(spark, rows, {n: "double" for n in names}).repartition(4)
    many = {(r["x"], r["y"]): r["r"] for r in profile.correlations(df, names).collect()}
    few = {(r["x"], r["y"]): r["r"] for r in profile.correlations(df, names[:5]).collect()}
    assert len(many) == 66
    for pair, r in few.items():
        assert many[pair] == pytest.approx(r, abs=1e-9)


def test_histogram_of_a_constant(spark):
    df = local_rows(spark, [(2.0,), (2.0,), (None,)], {"x": "double"})
    rows = profile.histogram(df, ["x"], 4).collect()
    assert len(rows) == 4 and sum(r["n"] for r in rows) == 2
    assert math.isclose(min(r["lo"] for r in rows), 1.5)


def test_correlations_do_not_depend_on_the_number_of_columns(spark):
    from tallyframe.operators import profile

    df = spark.range(200).selectExpr(
        "cast(id as double) as c0", "if(id % 7 = 0, double('nan'), sin(id)) as c1", "0.1D as c2",
        *[f"cos(id * {k}) as c{k}" for k in range(3, 12)])
    few = {(r.x, r.y): r.r for r in profile.correlation_matrix(df, [f"c{k}" for k in range(4)]).collect()}
    many = {(r.x, r.y): r.r for r in profile.correlation_matrix(df, [f"c{k}" for k in range(12)]).collect()}
    assert few == {k: many[k] for k in few}
    assert few["c0", "c1"] is not None and few["c0", "c2"] is None and few["c2", "c2"] is None


def test_windows_without_values_are_unknown(spark):
    from tallyframe.operators import drift

    ref = spark.range(100).selectExpr("cast(id as double) as a", "0.5D as same")
    cur = spark.range(40).selectExpr("cast(id div 20 as string) as w",
                                     "if(id < 20, cast(id as double), null) as a", "0.5D as same")
    got = {(r.monitoring_window, r.feature): r.status
           for r in drift.drift_by_window(ref, cur, F.col("w"), ["a", "same"]).collect()}
    assert got == {("0", "a"): "drift", ("1", "a"): "unknown", ("0", "same"): "unknown",
                   ("1", "same"): "unknown"}
    only = drift.drift_by_window(ref, cur, F.col("w"), ["same"]).collect()
    assert [r.status for r in only] == ["unknown", "unknown"]


def test_best_round_waits():
    from tallyframe.operators.training import best_round

    losses = [5, 4, 4.5, 4.2, 3, 3.5, 3.2, 2]
    assert best_round(losses, 3) == 8 and best_round(losses, 2) == 2 and best_round([1.0], 3) == 1
