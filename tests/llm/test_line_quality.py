"""The field over lines against enumeration of all labellings, and its accuracy on held-out rows."""

import zlib
from itertools import product

import numpy as np
from pyspark.sql import functions as F

from tallyframe.llm import line_quality as lq
from tallyframe.llm.queries import QUERIES


def drawn_field(seed):
    draw = np.random.default_rng(seed)
    return lq.Field(draw.normal(0, 1, lq.SIZE), float(draw.normal()), draw.normal(0, 2, (2, 2)))


def log_weight(field, own, labels):
    total = labels[0] * field.first + sum(y * u for y, u in zip(labels, own))
    return total + sum(field.pairs[a, b] for a, b in zip(labels, labels[1:]))


def test_passes_are_the_marginals_of_all_labellings():
    draw = np.random.default_rng(1)
    sizes = np.array([3, 1, 6, 2, 6, 1])
    own = draw.normal(0, 2, sizes.sum())
    for seed in range(5):
        field = drawn_field(seed)
        ahead, back = lq.passes(field, own, sizes)
        got, at = lq._chance(ahead + back), 0
        for size in sizes:
            every = list(product((0, 1), repeat=int(size)))
            weight = np.exp([log_weight(field, own[at:at + size], y) for y in every])
            want = (weight[:, None] * np.array(every)).sum(axis=0) / weight.sum()
            assert np.allclose(got[at:at + size], want)
            at += size


def test_gradient_is_that_of_the_likelihood():
    draw = np.random.default_rng(2)
    sizes = np.array([4, 1, 3])
    rows = np.stack([draw.integers(0, lq.SIZE, 8), draw.integers(0, 5, 8)], axis=1)
    labels = draw.integers(0, 2, 8).astype(float)
    values = drawn_field(3).packed()

    def likelihood(values):
        field, total, at = lq.Field.unpacked(values), 0.0, 0
        own = field.weights[rows].sum(axis=1)
        for size in sizes:
            part, y = own[at:at + size], labels[at:at + size].astype(int)
            every = [log_weight(field, part, z) for z in product((0, 1), repeat=int(size))]
            total += log_weight(field, part, y) - np.logaddexp.reduce(every)
            at += size
        return total

    got = lq.gradient(lq.Field.unpacked(values), rows, sizes, labels)
    for k in {*rows.ravel().tolist(), *range(lq.SIZE, lq.SIZE + 5)}:
        step = np.zeros(len(values))
        step[k] = 1e-5
        assert np.isclose(got[k], (likelihood(values + step) - likelihood(values - step)) / 2e-5, atol=1e-6)


def test_features_of_lines():
    lines = lq.lines_of("Good line, here.\n \n\nJUNK!! JUNK!! ###\nGood line, here.")
    assert lines == ["Good line, here.", "JUNK!! JUNK!! ###", "Good line, here."] and lq.lines_of(None) == [""] == lq.lines_of("\n ")
    rows = lq.features([*lines, ""], np.array([3, 1])) - lq.STARTS
    names = list(lq.OWN)
    own = {n: rows[:, k].tolist() for k, n in enumerate(names)}
    assert own["repeated"] == [0, 0, 1, 0] and own["stop_at_end"] == [1, 0, 1, 0]
    assert own["capitals"] == [0, 10, 0, 11] and own["echoes"] == [0, 3, 0, 11] and own["words"] == [2, 2, 2, 0]
    around = {(n, s): rows[:, len(names) + 2 * k + s].tolist() for k, n in enumerate(lq.AROUND) for s in (0, 1)}
    assert around["capitals", 0] == [12, 0, 10, 12] and around["capitals", 1] == [10, 0, 12, 12]
    assert (rows >= 0).all() and (rows < np.array(lq.STEPS)).all()


def test_counts_do_not_depend_on_blocks(monkeypatch, prose):
    lines = [prose(k, 1 + 7 * k) for k in range(20)]
    docs = np.repeat([0, 1], 10)
    want = lq._numbers(lines, docs)
    monkeypatch.setattr(lq, "BLOCK_CHARS", 50)
    assert (lq._numbers(lines, docs) == want).all()


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    rows = QUERIES["op13_line_quality"](spark, sf)
    assert rows.dtypes == [("doc_id", "bigint"), ("held_out", "boolean"), ("score", "double"), ("predicted", "int")]
    rows = {r.doc_id: r for r in rows.collect()}
    assert len(rows) == 1000 and all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in rows.items())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows.values())
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    for side, least in ((0, 0.85), (1, 0.97)):
        own = [i for i, y in labels.items() if y == side and rows[i].held_out]
        assert np.mean([rows[i].predicted == side for i in own]) >= least


def test_held_out_labels_and_other_columns_do_not_matter(spark, sf):
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    turned = labels.withColumn("quality", F.when(lq.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    others = docs.withColumns({"lang": F.lit("xx"), "source": F.lit(None).cast("string"), "label": F.lit(3), "part": F.lit(0)})
    want = lq.classified(docs, labels).orderBy("id").collect()
    assert lq.classified(others, turned).orderBy("id").collect() == want


def test_odd_and_empty_tables(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1), (2, 1), (6, 0), (7, 0), (7, 1), (8, None), (None, 1), (9, 5)], "doc_id long, quality int")
    rows = lq.classified(odd_docs, labels).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert {r.id for r in rows if r.n_lines == 1} >= {3, 4, 5}
    assert [r.score for r in lq.classified(odd_docs, labels.limit(0)).collect()] == [0.5] * len(rows)
    assert lq.classified(no_docs, labels).count() == 0
    lines = lq.line_labels(odd_docs, lq.Field.zero())
    assert [r.text for r in lines.where("id = 5").collect()] == [""] and lines.where("good <> 0.5").count() == 0


def test_a_fit_does_not_depend_on_partitions(spark, sf):
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    one = lq.fit(docs.coalesce(1), labels).packed()
    assert np.allclose(one, lq.fit(docs.repartition(7), labels).packed(), rtol=0, atol=1e-12)
