"""Model operators on a small separable table."""

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tallyframe.operators import training as t
from tallyframe.operators.order import local_rows


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(4)
    y = rng.integers(0, 3, 240)
    rows = [(i, int(k), float(k + rng.normal(0, 0.3)), float(rng.normal())) for i, k in enumerate(y)]
    df = local_rows(spark, rows, {"id": "bigint", "y_true": "int", "signal": "double", "noise": "double"})
    return df.select("id", "y_true", array_to_vector(F.array("signal", "noise")).alias("features"))


def test_models_add_probabilities(table):
    for model in (t.train_logistic(table, iterations=30), t.train_forest(table, 5, 4),
                  t.train_boosted(table, table.where("id % 4 = 0"), rounds=3, depth=2)):
        out = model.add_probs(table)
        assert out.columns == ["id", "y_true", "features", "probs"]
        assert out.where("abs(aggregate(probs, 0D, (a, x) -> a + x) - 1) > 1e-9").isEmpty()
        assert t.metric_row(out)["accuracy"] > 0.8


def test_importance_finds_the_signal(spark, table):
    model = t.train_forest(table, 5, 4)
    for got in (t.builtin_importance(spark, model, ["signal", "noise"]),
                t.permutation_importance(table, "id", model, ["signal", "noise"], 200)):
        assert [r["feature"] for r in got.collect()] == ["signal", "noise"]


def test_search(table):
    estimator = LogisticRegression(family="multinomial", labelCol="y_true", weightCol="weight", maxIter=10)
    best, trials = t.param_search(table, "id", estimator, {"regParam": [0.0, 5.0]}, "lr", trials=5)
    assert trials.count() == 2 and best == {"regParam": 0.0}
    fixed, none = t.param_search(table, "id", estimator, {}, "lr", fixed={"regParam": 1.0})
    assert fixed == {"regParam": 1.0} and none.count() == 0


@pytest.mark.parametrize("method", ["isotonic", "sigmoid"])
def test_calibration(spark, table, method):
    scored = t.train_logistic(table, iterations=30).add_probs(table)
    out = t.fit_calibrator(scored, method=method).apply(scored)
    assert out.columns == [*scored.columns, "calibrated"]
    assert out.where("abs(aggregate(calibrated, 0D, (a, x) -> a + x) - 1) > 1e-9").isEmpty()


# -- boosting -----------------------------------------------------------------

def plain_booster(x, y, w, cuts, classes, rounds, depth, rate):
    """Every split by trying all cut points of all features on all rows of a node."""
    cells = np.stack([np.searchsorted(c, x[:, j], "left") for j, c in enumerate(cuts)])
    margins = np.zeros((len(y), classes))
    for _ in range(rounds):
        e = np.exp(margins - margins.max(axis=1, keepdims=True))
        p = e / e.sum(axis=1, keepdims=True)
        g, h = w[:, None] * (p - np.eye(classes)[y]), np.maximum(2 * w[:, None] * p * (1 - p), 1e-16)

        def grow(rows, k, level):
            gs, hs = g[rows, k].sum(), h[rows, k].sum()
            best = (1e-12, None)
            for j in range(len(cuts)):
                for s in range(len(cuts[j])):
                    left = rows[cells[j, rows] <= s]
                    gl, hl = g[left, k].sum(), h[left, k].sum()
                    if hl >= 1 and hs - hl >= 1:
                        gain = gl**2 / (hl + 1) + (gs - gl)**2 / (hs - hl + 1) - gs**2 / (hs + 1)
                        best = max(best, (gain, (j, s)), key=lambda b: b[0] if b[1] is None or b[0] > best[0] + 1e-9 else -1)
            if best[1] is None or level == depth:
                margins[rows, k] += -rate * gs / (hs + 1)
                return
            j, s = best[1]
            grow(rows[cells[j, rows] <= s], k, level + 1)
            grow(rows[cells[j, rows] > s], k, level + 1)

        for k in range(classes):
            grow(np.arange(len(y)), k, 0)
    return margins


@pytest.mark.parametrize("snapshot, rows_per_task", [(20, 50_000), (2, 60)])
def test_boosted_trees_are_those_of_all_splits(spark, monkeypatch, snapshot, rows_per_task):
    from tallyframe.operators import boosting

    monkeypatch.setattr(boosting, "ROWS_PER_TASK", rows_per_task)
    rng = np.random.default_rng(8)
    y = rng.integers(0, 3, 300)
    x = np.stack([y + rng.normal(0, 0.8, 300), np.round(rng.normal(0, 1, 300), 1), rng.integers(0, 3, 300) * 1.0], axis=1)
    w = 0.5 + rng.random(300)
    rows = [(int(k), *map(float, v), float(u)) for k, v, u in zip(y, x, w)]
    df = local_rows(spark, rows, {"y_true": "int", "a": "double", "b": "double", "c": "double", "weight": "double"})
    df = df.select("y_true", "weight", array_to_vector(F.array("a", "b", "c")).alias("features"))
    model = boosting.fit_boosted(df.repartition(3), None, 3, 5, 3, 0.3, 1.1, 1, 30, bins=16, snapshot=snapshot)
    assert model.trees.leaf.shape == (5, 3, 8)
    want = plain_booster(x, y, w, model.cuts, 3, 5, 3, 0.3)
    got = model.trees.margins(boosting.cells_of(x, model.cuts))
    assert np.allclose(got, want)
    scored = model.add_probs(df).collect()
    assert np.allclose(sorted(r["probs"] for r in scored), sorted(boosting.softmax(want).tolist()))


def test_boosting_stops_in_the_loop(table, spark, tmp_path):
    from tallyframe.operators import boosting

    rng = np.random.default_rng(1)
    weighted = table.withColumn("weight", F.lit(1.0))
    noise = weighted.withColumn("y_true", F.col("id").cast("int") * 7 % 3)
    model = boosting.fit_boosted(weighted, noise, 3, 50, 2, 0.3, 0.8, 1, 4)
    best = int(np.argmin(model.losses))
    assert len(model.trees.leaf) == best and len(model.losses) == best + 5 < 51
    good = boosting.fit_boosted(weighted, table, 3, 6, 2, 0.3, 0.8, 1, 4)
    assert len(good.losses) == 7 and good.losses[-1] < good.losses[0] / 2
    assert good.featureImportances.argmax() == 0 and abs(good.featureImportances.sum() - 1) < 1e-9
    good.save(spark, str(tmp_path / "m"))
    again = boosting.BoostedTrees.load(str(tmp_path / "m"))
    assert again.add_probs(table).collect() == good.add_probs(table).collect() and rng is not None


# -- search -------------------------------------------------------------------

def test_halving_search_is_not_behind_the_full_one(table):
    from pyspark.ml.classification import RandomForestClassifier

    from tallyframe.operators import search

    def logistic(rows, params):
        return t.ClassModel("logistic", [LogisticRegression(
            family="multinomial", labelCol="y_true", weightCol="weight", maxIter=10, **params).fit(rows)])

    def forest(rows, params):
        return t.ClassModel("forest", [RandomForestClassifier(
            labelCol="y_true", weightCol="weight", seed=1, **params).fit(rows)])

    families = [search.Family("lr", logistic, {"regParam": [0.0, 0.5, 5.0, 50.0]}),
                search.Family("rf", forest, {"maxDepth": [1, 4], "numTrees": [3]})]
    (name, params), trials = search.halving_search(table, "id", families, trials=4, rungs=2, keep=2, folds=2)
    rows = trials.collect()
    assert [(r["model"], r["rung"]) for r in rows].count(("lr", 0)) == 4 and {r["state"] for r in rows if r["rung"] == 0} == {"promoted", "dropped"}
    last = [r for r in rows if r["rung"] == 1]
    assert all(r["rows"] == 240 for r in last) and all(100 < r["rows"] < 140 for r in rows if r["rung"] == 0)
    assert {r["state"] for r in last} <= {"finished", "pruned"}
    top = max(r["value"] for r in last if r["state"] == "finished")
    full = search.halving_search(table, "id", families, trials=4, rungs=1, folds=2)[1].agg(F.max("value")).first()[0]
    assert top >= full - 0.02 and (name != "lr" or params["regParam"] < 5)
    again = search.halving_search(table, "id", families, trials=4, rungs=2, keep=2, folds=2)
    assert again[0] == (name, params) and again[1].collect() == rows


# -- isotonic -----------------------------------------------------------------

@pytest.mark.parametrize("fan", [2, 16])
@pytest.mark.parametrize("kind", ["ties", "distinct", "rising", "falling"])
def test_pooled_ranges_are_the_plain_fit(spark, kind, fan):
    from tallyframe.operators import isotonic

    rng = np.random.default_rng(2)
    x = np.round(rng.random(600), 2 if kind == "ties" else 9)
    y = (rng.random(600) < (1 - x if kind == "falling" else x)).astype(float)
    if kind == "rising":
        y = x.copy()
    df = local_rows(spark, list(zip(x.tolist(), y.tolist())), {"x": "double", "y": "double"})
    points = df.groupBy(F.col("x").alias("score")).agg(F.sum("y").alias("total"), F.count("*").cast("double").alias("weight"))
    blocks = isotonic.pooled_blocks(points, fan, ranges=9).orderBy("low").collect()
    stack = []
    for score in np.unique(x):
        isotonic.push(stack, score, score, float((x == score).sum()), float(y[x == score].sum()))
    assert np.allclose([(b["low"], b["high"], b["weight"], b["value"]) for b in blocks], [(b[0], b[1], b[2], b[3] / b[2]) for b in stack])
    assert all(a["value"] < b["value"] for a, b in zip(blocks, blocks[1:])) and abs(sum(b["weight"] for b in blocks) - 600) < 1e-9
    from pyspark.ml.regression import IsotonicRegression
    plain = IsotonicRegression(featuresCol="score", labelCol="target", weightCol="weight").fit(
        points.withColumn("target", F.col("total") / F.col("weight")))
    fitted = IsotonicRegression(featuresCol="score", labelCol="target", weightCol="weight").fit(isotonic.knots(points, fan))
    grid = local_rows(spark, [(i / 97,) for i in range(-3, 101)], {"score": "double"})
    a, b = ([r["prediction"] for r in model.transform(grid).orderBy("score").collect()] for model in (plain, fitted))
    assert np.allclose(a, b)
