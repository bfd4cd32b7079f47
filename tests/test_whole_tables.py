"""Jobs that read a view once, search on all rows, and give no side of a stream to one task."""

from pathlib import Path

import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tallyframe.operators import search
from tallyframe.plans import feature_queries as fq, training_queries as tq
from tallyframe.plans.views import dirty


class Constant:
    def add_probs(self, df):
        return df.select("*", F.expr("array(1D, 0D, 0D)").alias("probs"))


def test_last_rung_has_all_rows(spark):
    rows = spark.range(210_000).select("id", (F.col("id") % 3).cast("int").alias("y_true"),
                                       array_to_vector(F.array(F.lit(1.0))).alias("features"))
    _, trials = search.halving_search(rows, "id", [search.Family("same", lambda r, p: Constant(), {"x": [1, 2]})], trials=2)
    assert {r["rung"]: r["rows"] for r in trials.collect()}[2] == 210_000


@pytest.mark.parametrize("key", ["scoring_run", "stream_score"])
def test_view_is_built_once(key, spark, sf, monkeypatch):
    built = []
    monkeypatch.setattr(fq, "dirty", lambda *a: built.append(a) or dirty(*a))
    assert tq.QUERIES[key](spark, sf).count() > 0
    assert len(built) == 1


def test_sides_of_a_stream_keep_their_files(spark, sf, tmp_path, monkeypatch):
    dirty(spark, sf).repartition(4, "id").write.parquet(str(tmp_path / "view"))
    monkeypatch.setattr(fq, "written_dirty", lambda *a: spark.read.parquet(str(tmp_path / "view")))
    base = Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(base.glob("followed-*"))
    found = tq.stream_score_following(spark, sf)
    assert found.where("model_version <> if(id % 2 = 0, '1', '2')").isEmpty() and found.count() == 150
    new, = set(base.glob("followed-*")) - before
    assert len(list((new / "records").glob("*.parquet"))) >= 6
