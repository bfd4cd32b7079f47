"""Hard negatives against all pairs."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallyframe.llm import negatives
from tallyframe.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<double>, label int"


def cut(x, scale=256):
    return math.floor(scale * x) if abs(x) < 1e9 else int(x) * scale


def plain(rows, step=50, positives=5, negatives_=3, low=50, high=95):
    rows = [(i, tuple(v), y) for i, v, y in dict.fromkeys((i, None if v is None else tuple(v), y) for i, v, y in rows)
            if y is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    whole = [[cut(x) for x in v] for _, v, _ in rows]
    out = []
    for a, (i, _, y) in enumerate(rows):
        if i is None or i % step:
            continue
        scored = sorted(((-sum(p * q for p, q in zip(whole[a], whole[b])), r[0] is None, r[0] or 0, r[2])
                         for b, r in enumerate(rows) if b != a))
        for s, none, p, _ in [r for r in scored if r[3] == y][:positives]:
            inside = [r for r in scored if r[3] != y and low * -s <= 100 * -r[0] <= high * -s][:negatives_]
            out += [(i, None if none else p, k + 1, None if r[1] else r[2], -s, -r[0]) for k, r in enumerate(inside)]
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def made(seed, n, wide, labels=4, near=0.5):
    draw = random.Random(seed)
    centre = [draw.gauss(0, 1) for _ in range(wide)]
    return [(k, [near * c + draw.gauss(0, 1) for c in centre], draw.randrange(labels)) for k in range(n)]


@pytest.mark.parametrize("cells", [1 << 19, 300])
@pytest.mark.parametrize("wide, near", [(1, 0.5), (6, 0.0), (20, 0.7)])
def test_hard_negatives(spark, wide, near, cells):
    rows = made(wide, 230, wide, near=near)
    df = spark.createDataFrame(rows, SCHEMA)
    found = negatives.hard_negatives(df, F.col("id") % 10 == 0, block_cells=cells)
    assert got(found) == plain(rows, 10)


def test_copies_ties_and_odd_rows(spark):
    rows = made(3, 60, 5)
    rows += [(100 + k, rows[7][1], rows[7][2]) for k in range(80)] + [(200 + k, rows[8][1], k % 4) for k in range(60)]
    rows += [(300, None, 1), (310, [1.0, None, 2.0], 1), (320, [1.0, float("nan")], 1), (330, [float("inf")], 2),
             (340, rows[1][1], None), (350, [], 1), (360, [1.0, 2.0], 1), (None, rows[7][1], 0), (None, rows[9][1], 1),
             rows[10], rows[10], (10, rows[11][1], rows[10][2]), (10, rows[10][1], (rows[10][2] + 1) % 4)]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"id": F.lit(1), "block": F.lit("x"), "key": F.lit(None)})
    for cells in (1 << 19, 100):
        assert got(negatives.hard_negatives(df, F.col("id") % 10 == 0, block_cells=cells)) == plain(rows, 10)
    none = negatives.hard_negatives(df.limit(0), F.col("id") % 10 == 0)
    assert none.count() == 0 and none.columns == ["anchor_id", "positive_id", "rank", "negative_id",
                                                  "positive_score", "negative_score"]


def test_numbers_beyond_doubles(spark):
    draw = random.Random(4)
    rows = [(k, [draw.choice((1, -1)) * 10.0 ** draw.uniform(0, 7), draw.gauss(0, 1), 10.0 ** draw.uniform(0, 7)], k % 3)
            for k in range(90)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert got(negatives.hard_negatives(df, F.col("id") % 10 == 0)) == plain(rows, 10)
    # Held at the limit: row 1 opens a window below it, row 2 is at the limit itself.
    huge = spark.createDataFrame([(0, [1e300, 1.0], 0), (1, [1e300, 2.0], 0), (2, [6e299, 1.0], 1)], SCHEMA)
    assert got(negatives.hard_negatives(huge, F.col("id") == 0)) == []
    limit = 2**63 - 1
    assert negatives._clipped([10**30, -10**30, 5]).to_pylist() == [limit, -limit - 1, 5]


def test_bounds_clear_candidates_early():
    """Most candidates go before their last dimension is read, and none that matters."""
    draw = np.random.default_rng(5)
    vectors = draw.normal(0, 1, (4000, 64)) * np.linspace(3, 0.05, 64)
    batch = pa.record_batch([pa.array(range(4000)), pa.array(range(4000)), pa.array(draw.integers(0, 3, 4000)),
                             pa.array(list(vectors), pa.list_(pa.float64()))], ["id", "key", "label", "vector"])
    block, read = negatives.Block(batch, 256), []
    anchor = {"id": 5, "key": 5, "label": int(batch.column("label")[5].as_py()), "query": negatives.whole(vectors[5], 256)}

    def alive(low, high):
        read.append(len(low))
        return high >= np.partition(low, -5)[-5]

    rows, score = negatives.scan(block, anchor["query"], np.ones(4000, bool), alive)
    want = negatives.whole(vectors, 256) @ anchor["query"]
    best = np.sort(want)[-5:]
    assert np.sort(score)[-5:].tolist() == best.tolist() and read[-1] < 400


def test_query_keeps_its_contract(spark, sf):
    rows = [(r.vec_id, r.embedding, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label)
            for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    df = QUERIES["op12_hard_negatives"](spark, sf)
    assert df.dtypes == [("anchor_id", "bigint"), ("positive_id", "bigint"), ("rank", "int"), ("negative_id", "bigint"),
                         ("positive_score", "bigint"), ("negative_score", "bigint")]
    assert got(df) == plain(rows)
