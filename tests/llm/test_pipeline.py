"""The pipeline stage by stage against plain versions, and its guard in the entry module."""

import subprocess
import sys
from collections import Counter
from pathlib import Path

import duckdb
import pytest

import corpus_pipeline
from plain import components, fingerprint, held_items, targets, words
from tallyframe.llm.sql import ORACLES

ROOT = Path(__file__).resolve().parents[2]


@pytest.fixture(scope="module")
def stages(spark, sf):
    """The rows that each stage returned, by name, and the input."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = {"input": docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.cut(stage(spark, docs, sf), name)
        out[name] = docs.collect()
    return out


def ids(rows):
    return sorted(r.doc_id for r in rows)


def test_stages_return_document_columns(stages):
    columns = stages["input"][0].__fields__
    for name in ("quality_rules", "simhash_dedup", "decontaminate", "mix_sources"):
        assert stages[name][0].__fields__ == columns
    assert stages["shard"][0].__fields__ == [*columns, "shard", "slot"]
    whole = set(stages["input"])
    assert all(set(stages[name]) <= whole for name in ("quality_rules", "simhash_dedup", "mix_sources"))


def test_quality_stage(stages, sf):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{sf}/documents.parquet'")
    kept = con.execute(f"select doc_id from ({ORACLES['op6_quality_rules']}) where kept").fetchall()
    assert ids(stages["quality_rules"]) == sorted(k for k, in kept)


def test_dedup_stage(stages):
    fps = {r.doc_id: fingerprint(r.text) for r in stages["quality_rules"]}
    found = components(fps, lambda a, b: (fps[a] ^ fps[b]).bit_count() <= 3)
    assert ids(stages["simhash_dedup"]) == sorted(set(found.values()))


def test_decontamination_stage(stages, spark, sf):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    before = stages["simhash_dedup"]
    held = {d for d, _ in held_items([(r.doc_id, r.text) for r in before], items)}
    assert held and ids(stages["decontaminate"]) == [d for d in ids(before) if d not in held]


def test_mix_stage(stages):
    before, taken = stages["decontaminate"], Counter(ids(stages["mix_sources"]))
    sizes, got, longest = Counter(), Counter(), Counter()
    for r in before:
        n = len(words(r.text))
        sizes[r.source] += n
        got[r.source] += n * taken[r.doc_id]
        longest[r.source] = max(longest[r.source], n)
    want = targets(sizes)
    assert set(taken.values()) <= {1, 2} and set(taken) <= set(ids(before))
    assert all(abs(got[s] - want[s]) <= longest[s] for s in want)


def test_shard_stage(stages):
    rows = stages["shard"]
    assert ids(rows) == ids(stages["mix_sources"])
    counts = Counter(r.shard for r in rows)
    n = corpus_pipeline.N_SHARDS
    assert set(counts) <= set(range(n)) and max(counts.values()) - min(counts.get(s, 0) for s in range(n)) <= 1
    for s in counts:
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(counts[s]))


def test_run_applies_the_stages(stages, spark, sf):
    assert Counter(corpus_pipeline.run(spark, sf).collect()) == Counter(stages["shard"])


def test_stages_take_odd_and_empty_tables(spark, odd_docs, no_docs, sf):
    for docs in (odd_docs, no_docs):
        for name, stage in corpus_pipeline.STAGES:
            docs = corpus_pipeline.cut(stage(spark, docs, sf), name)
        docs.collect()


def test_entry_works_without_this_package():
    code = """
import sys
sys.modules['corpus_pipeline'] = None
sys.modules['tallyframe.llm'] = None
import __spark_entry__ as e
assert e.queries() and not any(k.startswith('op1_') or k == 'pipeline' for k in e.queries())
"""
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
