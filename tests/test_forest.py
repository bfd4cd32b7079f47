import itertools

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tallyframe.operators import forest, training as t
from tallyframe.operators.boosting import NO_SPLIT, cells_of


@pytest.fixture(scope="module")
def noisy(spark):
    """Two features that tell the class but for some noise, and one that tells nothing."""
    rows = spark.range(6000).select("id", (F.col("id") % 37).cast("double").alias("a"), (F.col("id") % 11).cast("double")
                                    .alias("b"), (F.col("id") * 7919 % 101).cast("double").alias("c"))
    return rows.select("id", F.expr("case when id % 29 = 0 then id % 3 when a < 12 then 0 when b < 5 then 1 else 2 end")
                       .cast("int").alias("y_true"), array_to_vector(F.array("a", "b", "c")).alias("features"))


def gini(counts, weights):
    mass = [c * w for c, w in zip(counts, weights)]
    return sum(mass) - sum(m * m for m in mass) / sum(mass) if sum(mass) else 0.0


def test_best_split_is_that_of_all_splits():
    draw = np.random.default_rng(1)
    counts = draw.integers(0, 6, (7, 2, 5, 3))
    counts[:, 1] = counts[:, 0][:, draw.permutation(5)]  # the same rows under two features
    features, weights = np.array([[4, 9]] * 7), [1.0, 0.5, 2.0]
    found = forest.best_splits(counts, features, weights, 4)
    for node, row in zip(counts, found):
        whole = node[0].sum(axis=0)
        tried = {}
        for slot, step in itertools.product(range(2), range(5)):
            left = node[slot, :step + 1].sum(axis=0)
            if left.sum() >= 4 and (whole - left).sum() >= 4:
                tried[features[0][slot], step] = gini(whole, weights) - gini(left, weights) - gini(whole - left, weights)
        assert row[0] == pytest.approx(max(tried.values()))
        assert tried[int(row[1]), int(row[2])] == pytest.approx(row[0])
        assert row[-3:].tolist() == whole.tolist()


def test_forest_learns_and_comes_back_from_its_files(noisy, spark, tmp_path):
    model = t.train_forest(noisy, 12, 6)
    assert model.kind == "binned_forest"
    fitted = model.models[0]
    assert t.metric_row(model.add_probs(noisy))["accuracy"] > 0.9
    assert fitted.featureImportances.sum() == pytest.approx(1.0)
    assert fitted.featureImportances[2] < 0.1
    fitted.save(spark, str(tmp_path / "forest"))
    again = forest.Forest.load(str(tmp_path / "forest"))
    values = np.array([r["features"].toArray() for r in noisy.limit(200).collect()])
    assert again.cuts == fitted.cuts
    assert (again.probs(cells_of(values, again.cuts)) == fitted.probs(cells_of(values, fitted.cuts))).all()


@pytest.mark.parametrize("per_row, merge", [(256, 64 << 20), (3, 1 << 10)])
def test_counts_of_all_tasks_meet(noisy, monkeypatch, per_row, merge):
    """Node ranges and the number of merging tasks change how counts travel, not what is grown."""
    monkeypatch.setattr(forest, "ROWS_PER_TASK", 1000)
    plain = forest.fit_forest(noisy.repartition(3, "id").sortWithinPartitions("id"), [1.0, 1.0, 1.0], 3, 5, 2, 7)
    monkeypatch.setattr(forest, "NODES_PER_ROW", per_row)
    monkeypatch.setattr(forest, "MERGE_BYTES", merge)
    other = forest.fit_forest(noisy.repartition(3, "id").sortWithinPartitions("id"), [1.0, 1.0, 1.0], 3, 5, 2, 7)
    assert (plain.step != NO_SPLIT).sum() > 20
    assert (plain.feature == other.feature).all() and (plain.step == other.step).all()
    assert (plain.leaf == other.leaf).all()


def test_passes_do_not_grow_with_the_trees(noisy, spark):
    """One job a level for all trees: as many jobs for sixty trees as for two."""
    sc, jobs = spark.sparkContext, []
    for trees in (2, 60):
        sc.setJobGroup(f"forest-{trees}", "")
        t.train_forest(noisy, trees, 4)
        jobs.append(len(sc.statusTracker().getJobIdsForGroup(f"forest-{trees}")))
    assert jobs[0] == jobs[1]


def test_one_class_and_no_rows(noisy):
    one = t.train_forest(noisy.where("y_true = 0"), 3, 4)
    assert one.add_probs(noisy.limit(5)).select("probs").distinct().collect()[0][0] == [1.0]
