"""Importance resampling against plain Python."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from tallyframe.llm import importance
from tallyframe.llm.queries import QUERIES

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain_buckets(text, most=1, buckets=10_000):
    w = plain_words(text)
    runs = [" ".join(w[i:i + n]) for n in range(1, most + 1) for i in range(len(w) - n + 1)]
    return [zlib.crc32(r.encode()) % buckets for r in runs]


def plain_resample(docs, target, most=1, buckets=10_000, percent=10, least=20, seed=2024):
    """``(id, n_features, weight, score, rank)`` of every row, sorted."""
    own = [(i, plain_words(t), plain_buckets(t, most, buckets)) for i, t in docs]
    s, t = Counter(b for _, _, f in own for b in f), Counter(b for x in target for b in plain_buckets(x, most, buckets))
    n, m = float(s.total()), float(t.total())
    gain = {b: math.floor(1000 * math.log((t[b] + 1.0) * (n + buckets) / ((s[b] + 1.0) * (m + buckets)))) for b in s}
    rows = []
    for i, w, f in own:
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append((i, len(w), len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[4], r[0] is not None, r[0] or 0))
    draws = len(able) * percent // 100
    ranks = [(r, k + 1 if k < draws else None) for k, r in enumerate(able)] + [(r, None) for r in rows if r[1] < least]
    return sorted(((r[0], *r[2:], k) for r, k in ranks), key=str)


def got(df):
    return sorted(((r.id, r.n_features, r.weight, r.score, r["rank"]) for r in df.collect()), key=str)


@given(st.text(st.sampled_from("abAB09 .\n-éÄ中_\x00\x7f\x80"), max_size=60), st.integers(1, 4), st.integers(1, 12))
@settings(max_examples=300, deadline=None)
def test_automaton_payloads_compose_to_buckets(text, most, size):
    data = importance.folded(text)
    pieces = list(importance._pieces(data, size))
    assert b"".join(pieces) == data
    machine = importance.dictionary(set(data.split()))
    found = np.concatenate([importance.payloads(machine, p) for p in pieces])
    assert (importance.composed(found, most) % 10_000).tolist() == plain_buckets(text, most)


def test_crc_of_joined_strings(prose):
    parts = [prose(k, 1 + k).encode() for k in range(40)] + [b"", b"x" * 70_000]
    first, second = np.array([zlib.crc32(p) for p in parts], np.uint32), np.array([zlib.crc32(p) for p in parts[::-1]], np.uint32)
    lengths = np.array([len(p) for p in parts[::-1]])
    want = [zlib.crc32(a + b) for a, b in zip(parts, parts[::-1])]
    assert importance.joined(first, second, lengths).tolist() == want


@pytest.mark.parametrize("most, buckets, percent", [(1, 10_000, 10), (3, 70_000, 35), (2, 7, 100), (1, 10_000, 0)])
def test_resampled(spark, prose, most, buckets, percent):
    docs = [(k, prose(k % 30, 5 + k)) for k in range(90)] + [(k, prose(3, 50)) for k in range(90, 120)]
    docs += [(None, prose(2, 30)), (None, None), (200, ""), (201, " .;\n"), (5, docs[60][1]), *[docs[70]] * 25]
    target = [prose(k, 40) for k in range(4)] + [None, ""]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame([(t,) for t in target], "text string")
    found = importance.resampled(df, bench, most=most, buckets=buckets, percent=percent)
    assert got(found) == plain_resample(docs, target, most, buckets, percent)


def test_equal_rows_have_ranks_of_their_own(spark, prose, monkeypatch):
    monkeypatch.setattr(importance, "STEP", 4)
    df = spark.createDataFrame([(1, prose(1, 30))] * 30 + [(k, prose(k, 30)) for k in range(2, 12)], "doc_id long, text string")
    ranks = [r["rank"] for r in importance.resampled(df, df.select("text"), percent=80).collect()]
    assert sorted(r for r in ranks if r) == list(range(1, 33)) and len(ranks) == 40


def test_drawn_rows_and_odd_tables(spark, odd_docs, no_docs, prose):
    bench = spark.createDataFrame([(prose(1, 60),)], "text string")
    rows = importance.resampled(odd_docs, bench, percent=50)
    assert got(rows) == plain_resample([(r.doc_id, r.text) for r in odd_docs.collect()], [prose(1, 60)], percent=50)
    kept = importance.drawn(odd_docs, bench, percent=50)
    assert kept.columns == odd_docs.columns and 0 < kept.count() < odd_docs.count()
    assert importance.resampled(no_docs, bench).count() == 0
    alone = importance.resampled(odd_docs, bench.limit(0), percent=50)
    assert got(alone) == plain_resample([(r.doc_id, r.text) for r in odd_docs.collect()], [], percent=50)


def test_query_keeps_its_contract(spark, sf):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    items = [r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    df = QUERIES["op11_importance"](spark, sf)
    assert df.dtypes == [(n, "bigint") for n in ("doc_id", "n_features", "weight", "score", "rank")]
    assert sorted((tuple(r) for r in df.collect()), key=str) == plain_resample(docs, items)
