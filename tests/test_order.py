"""Order statistics: the bucketed plans must give what one sort gives."""

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tallyframe.operators import order, splits
from tallyframe.operators.bins import OUTSIDE, add_bins
from tallyframe.operators.order import (cut_points, exact_quantiles, local_rows, quantile_table,
                                        running_best, running_counts, settle)

PROBS = [0.0, 0.1, 0.25, 0.5, 0.9, 0.99, 1.0]


def frame(spark, values, groups=None):
    groups = groups or ["g"] * len(values)
    return local_rows(spark, list(zip(groups, values)), {"g": "string", "x": "double"})


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share one value, the rest has a heavy tail and gaps."""
    rng = np.random.default_rng(7)
    values = [5.0] * 1000 + list(np.round(rng.lognormal(1, 2, 1900), 3)) + [None] * 60 + [float("nan")] * 40
    groups = ["hot" if i % 3 else f"g{i % 7}" for i in range(3000)]
    return frame(spark, values, groups), values, groups


@pytest.mark.parametrize("rows_per_sort", [10_000, 50])
def test_quantiles_match_numpy(skewed, rows_per_sort):
    df, values, _ = skewed
    clean = [v for v in values if v is not None and not np.isnan(v)]
    got = quantile_table(df, ["x"], PROBS, rows_per_sort=rows_per_sort)["x"]
    assert got == pytest.approx(np.quantile(clean, PROBS))


@pytest.mark.parametrize("rows_per_sort", [10_000, 50])
def test_grouped_quantiles(skewed, rows_per_sort):
    df, values, groups = skewed
    rows = exact_quantiles(df, ["x"], PROBS, ["g"], rows_per_sort).collect()
    assert {r["g"] for r in rows} == set(groups)
    for r in rows:
        mine = [v for v, g in zip(values, groups) if g == r["g"] and v is not None and not np.isnan(v)]
        assert r["n"] == len(mine)
        assert list(r["quantiles"]) == pytest.approx(np.quantile(mine, PROBS))


def test_quantiles_of_one_row_and_none(spark):
    df = frame(spark, [3.0, None], ["a", "b"])
    rows = exact_quantiles(df, ["x"], [0.0, 0.5, 1.0], ["g"]).collect()
    assert [(r["g"], list(r["quantiles"])) for r in rows] == [("a", [3.0, 3.0, 3.0])]


def test_cut_points_bound_and_balance(skewed):
    df, _, _ = skewed
    points = cut_points(df, ["x"], 50)["x"]
    assert points == sorted(set(points)) and len(points) < 240


@pytest.mark.parametrize("rows_per_sort", [10_000, 40])
def test_running_counts(spark, rows_per_sort):
    rng = np.random.default_rng(3)
    rows = [(c, float(v), int(n)) for c in ("a", "b")
            for v, n in zip(np.unique(rng.integers(0, 400, 300)), rng.integers(1, 9, 300))]
    dist = local_rows(spark, rows, {"c": "string", "s": "double", "n": "bigint"})
    points = cut_points(dist, ["s"], rows_per_sort)["s"]
    got = running_counts(dist, ["c"], "s", ["n"], points).orderBy("c", "s").collect()
    for c in ("a", "b"):
        mine = sorted(r[1:] for r in rows if r[0] == c)
        out = [r for r in got if r["c"] == c]
        assert [r["cum_n"] for r in out] == list(np.cumsum([n for _, n in mine]))
        assert {r["tot_n"] for r in out} == {sum(n for _, n in mine)}
        assert [r["next_score"] for r in out] == [s for s, _ in mine][1:] + [None]


@pytest.mark.parametrize("rows_per_sort", [10_000, 10])
def test_running_best(spark, rows_per_sort):
    values = [None, 0.3, 0.1, None, 0.7, 0.2] * 20
    rows = [("m", i, v) for i, v in enumerate(values)]
    df = local_rows(spark, rows, {"m": "string", "t": "bigint", "v": "double"})
    got = [r["best"] for r in running_best(df, ["m"], "t", "v", "best", rows_per_sort)
           .orderBy("t").collect()]
    best, want = None, []
    for v in values:
        best = v if best is None else best if v is None else max(best, v)
        want.append(best)
    assert got == want


def test_settle_keeps_large_results(spark):
    assert settle(spark.range(100), 1000).collect() == spark.range(100).collect()
    assert settle(spark.range(100), 10).count() == 100


EDGES = [i * 0.1 for i in range(10)] + [1.0]


@settings(max_examples=20, deadline=None)
@given(st.lists(st.sampled_from(EDGES + [0.3, 0.6, 0.7, -0.1, 1.1, 0.55]), min_size=1, max_size=30))
def test_bins_compare_with_literal_edges(spark, values):
    df = local_rows(spark, [(v,) for v in values], {"x": "double"})
    left = [r[1] for r in add_bins(df, {"x": EDGES}, "left", close_end=True).collect()]
    right = [r[1] for r in add_bins(df, {"x": EDGES}, "right", close_end=True).collect()]
    pairs = list(zip(EDGES, EDGES[1:]))
    for v, a, b in zip(values, left, right):
        want_a = [i for i, (lo, hi) in enumerate(pairs) if lo <= v < hi or (i == 9 and v == hi)]
        want_b = [i for i, (lo, hi) in enumerate(pairs) if lo < v <= hi or (i == 0 and v == lo)]
        assert [a] == (want_a or [OUTSIDE]) and [b] == (want_b or [OUTSIDE])


@pytest.mark.parametrize("rows_per_sort", [100_000, 300, 20])
def test_split_is_exact_disjoint_and_complete(spark, rows_per_sort):
    """Strata of very different size, one of them NULL; digests are cut at 0, 1 and 2 digits."""
    df = spark.range(3000).select("id", F.expr(
        "case when id % 3 = 0 then 'hot' when id % 50 = 1 then 'rare' when id % 7 = 2 then null "
        "else 'rest' end").alias("s"))
    parts = {"train": 0.7, "valid": 0.15, "test": 0.15}
    out = splits.stratified_split(df, "id", "s", parts, 42, rows_per_sort=rows_per_sort)
    rows = out.collect()
    assert sorted(r["id"] for r in rows) == list(range(3000))
    for s in {r["s"] for r in rows}:
        mine = [r for r in rows if r["s"] == s]
        done = 0.0
        for name, share in parts.items():
            size = sum(r["split"] == name for r in mine)
            before, done = done, done + share
            assert size == int(done * len(mine) + 0.5) - int(before * len(mine) + 0.5)
    again = splits.stratified_split(df.repartition(5), "id", "s", parts, 42)
    assert {(r["id"], r["split"]) for r in again.collect()} == {(r["id"], r["split"]) for r in rows}


def test_split_shares_have_to_sum_to_one(spark):
    with pytest.raises(ValueError):
        splits.stratified_split(spark.range(5), "id", "id", {"a": 0.5, "b": 0.4})


def test_folds_are_balanced(spark):
    df = spark.range(1000).withColumn("s", F.col("id") % 3)
    sizes = splits.stratified_folds(df, "id", "s", 4).groupBy("s", "fold").count().collect()
    for s in range(3):
        mine = [r["count"] for r in sizes if r["s"] == s]
        assert len(mine) == 4 and max(mine) - min(mine) <= 1


def test_class_weights(spark):
    df = local_rows(spark, [("a",)] * 6 + [("b",)] * 2, {"c": "string"})
    got = {r["class"]: r["weight"] for r in splits.class_weights(df, "c").collect()}
    assert got == {"a": 8 / (2 * 6), "b": 8 / (2 * 2)}


def test_settle_leaves_long_texts_where_they_are(spark):
    from tallyframe.operators.order import settle

    short = spark.range(20).selectExpr("id", "repeat('x', 5) as t")
    assert settle(short).collect() == short.collect() and settle(short) is not short
    long = spark.range(20).selectExpr("id", "repeat('x', if(id = 7, 5000, 5)) as t")
    assert settle(long) is long


@pytest.mark.parametrize("buckets, rows_per_sort", [(4, 5), (3, 20), (8, 2)])
def test_wanted_buckets_are_cut_again(skewed, monkeypatch, buckets, rows_per_sort):
    """A pass of very few buckets is refined until sorts are small; a third of the rows share one value."""
    from tallyframe.operators import order

    monkeypatch.setattr(order, "MAX_BUCKETS", buckets)
    passes, finer = [], order._finer
    monkeypatch.setattr(order, "_finer", lambda *a: passes.append(finer(*a)) or passes[-1])
    df, values, groups = skewed
    clean = [v for v in values if v is not None and not np.isnan(v)]
    got = quantile_table(df, ["x"], PROBS, rows_per_sort=rows_per_sort)["x"]
    assert got == pytest.approx(np.quantile(clean, PROBS)) and len(passes) > 1 and not passes[-1]
    rows = exact_quantiles(df, ["x"], [0.5], ["g"], rows_per_sort).collect()
    for r in rows:
        mine = [v for v, g in zip(values, groups) if g == r["g"] and v is not None and not np.isnan(v)]
        assert r["quantiles"][0] == pytest.approx(np.median(mine))


def test_one_value_is_never_cut(spark, monkeypatch):
    from tallyframe.operators import order

    monkeypatch.setattr(order, "MAX_BUCKETS", 4)
    df = frame(spark, [7.0] * 500 + [1.0, 9.0])
    assert quantile_table(df, ["x"], [0.0, 0.5, 1.0], rows_per_sort=2)["x"] == [1.0, 7.0, 9.0]


@pytest.mark.parametrize("rows_per_sort, digits", [(100_000, 3), (40, 1), (3, 1), (3, 2)])
def test_split_with_a_key_of_a_third_of_the_rows(spark, monkeypatch, rows_per_sort, digits):
    """Equal keys land together, at the first cut whose rank they reach; the others as if ranked one by one."""
    import hashlib

    monkeypatch.setattr(splits, "HEAD_DIGITS", digits)
    keys = [f"k{i}" for i in range(400)] + ["same"] * 200
    df = local_rows(spark, [(k, ("a", "b", None)[i % 3]) for i, k in enumerate(keys)], {"k": "string", "s": "string"})
    parts = {"x": 0.5, "y": 0.2, "none": 0.0, "z": 0.3}
    got = {(r["k"], r["s"], r["split"]) for r in splits.stratified_split(df, "k", "s", parts, 1, rows_per_sort=rows_per_sort).collect()}
    want = set()
    for s in ("a", "b", None):
        own = sorted((hashlib.md5(f"{k}-1".encode()).hexdigest(), k) for i, k in enumerate(keys) if ("a", "b", None)[i % 3] == s)
        cuts = [own[int(share * len(own) + 0.5) - 1][0] for share in (0.5, 0.7, 0.7)]
        for digest, k in own:
            want.add((k, s, next((n for n, c in zip(parts, cuts) if digest <= c), "z")))
    assert got == want


def test_moments_leave_out_what_percentiles_leave_out(spark):
    from tallyframe.operators import profile

    df = frame(spark, [1.0, 2.0, 3.0, float("nan"), float("inf"), None])
    row = profile.describe(df, ["x"]).first()
    assert (row["count"], row["mean"], row["std"], row["min"], row["p50"], row["max"]) == (3, 2.0, 1.0, 1.0, 2.0, 3.0)
    assert profile.variance_rank(df, ["x"]).first()["variance"] == 1.0


def test_driver_ranks_equal_grouped_ones(spark):
    """The two ways to a quantile agree, with one bucket, many buckets and buckets cut again."""
    df = spark.range(3000).select(
        F.expr("if(id % 3 = 0, 7D, cast(pmod(id * 7919, 3001) as double) / 8)").alias("x"),
        F.expr("if(id % 50 = 0, null, cast(id % 4 as double))").alias("y"),
        F.expr("if(id = 5, 2.5D, null)").alias("one"), F.lit(None).cast("double").alias("none"), F.lit(1).alias("g"))
    columns, probs = ["x", "y", "one", "none"], [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]
    for limit in (10_000, 500, 5):
        grouped = {r["feature"]: (r["n"], r["quantiles"], r["below"])
                   for r in order.exact_quantiles(df, columns, probs, ["g"], limit).collect()}
        found = order.rank_neighbours(df, columns, probs, limit)
        assert {c: (n, [a + (b - a) * s for a, b, s, _ in p], [k for *_, k in p])
                for c, (n, p) in found.items()} == grouped
        assert set(grouped) == {"x", "y", "one"}
