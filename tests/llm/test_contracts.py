"""Registered queries without SQL against plain versions, with the columns their contracts name."""

import hashlib
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from plain import components, fingerprint, repeated_bytes, targets, words
from tallyframe.llm.queries import QUERIES
from test_texts import base_spans


@pytest.fixture(scope="module")
def docs(spark, sf):
    return {r.doc_id: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}


def run(spark, sf, name, types):
    df = QUERIES[name](spark, sf)
    assert dict(df.dtypes).items() >= types.items()
    rows = {r.doc_id: r for r in df.collect()}
    return rows


def test_op1(spark, sf, docs):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    rows = run(spark, sf, "op1_token_counts", {"doc_id": "bigint", "n_bytes": "bigint", "n_tokens": "bigint", "over_limit": "boolean"})
    for i, d in docs.items():
        n = len(library.encode(d.text or ""))
        assert rows[i][:4] == (i, len((d.text or "").encode()), n, n > 4096)
    assert rows.keys() == docs.keys()


def test_op3(spark, sf, docs):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rows = run(spark, sf, "op3_token_store", {"doc_id": "bigint", "start": "bigint", "n_tokens": "bigint", "ids_crc32": "bigint"})
    start = 0
    for i in sorted(docs):
        ids = [*library.encode(docs[i].text or "", add_special_tokens=False).ids, 1]
        got = rows[i]
        assert (got.start, got.n_tokens, got.ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert rows.keys() == docs.keys()


def test_op4(spark, sf, docs):
    rows = run(spark, sf, "op4_simhash", {"doc_id": "bigint", "fingerprint": "string", "component_id": "bigint"})
    fps = {i: fingerprint(d.text) for i, d in docs.items()}
    found = components(fps, lambda a, b: (fps[a] ^ fps[b]).bit_count() <= 3)
    assert {i: (r.fingerprint, r.component_id) for i, r in rows.items()} == {i: (f"{fps[i]:016x}", found[i]) for i in docs}


def test_op5(spark, sf, docs):
    rows = run(spark, sf, "op5_shuffle_shards", {"doc_id": "bigint", "size": "bigint", "text_crc32": "bigint", "law": "string",
                                                 "shard": "int", "slot": "bigint", "grown_shard": "int"})
    texts = {i: (d.text or "").encode() for i, d in docs.items()}
    assert {i: (r.size, r.text_crc32, r.law, r.grown_shard) for i, r in rows.items()} == {
        i: (len(t) + 16, zlib.crc32(t), "rows", None) for i, t in texts.items()}
    counts = Counter(r.shard for r in rows.values())
    assert set(counts) <= set(range(40)) and max(counts.values()) - min(counts[s] for s in range(40)) <= 1
    for s in counts:
        assert sorted(r.slot for r in rows.values() if r.shard == s) == list(range(counts[s]))


def test_op7(spark, sf, docs):
    rows = run(spark, sf, "op7_personal_data", {"doc_id": "bigint", **{f"n_{k}": "bigint" for k in ("email", "ip", "card", "phone")},
                                                "base_sha256": "string", "spans": "string"})
    for i, d in docs.items():
        base = base_spans(d.text or "")
        text = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        counts = Counter(k for k, _, _ in base)
        assert tuple(rows[i][f"n_{k}"] for k in ("email", "ip", "card", "phone")) == tuple(
            counts[k] for k in ("email", "ip", "card", "phone"))
        assert rows[i].base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert set(filter(None, text.split(","))) <= set(rows[i].spans.split(","))


def test_op8(spark, sf, docs):
    rows = run(spark, sf, "op8_mix_sources", {"doc_id": "bigint", "size": "bigint", "source_size": "bigint", "target": "double", "taken": "bigint"})
    sizes = {i: len(words(d.text)) for i, d in docs.items()}
    of_source, taken = Counter(), Counter()
    for i, d in docs.items():
        of_source[d.source] += sizes[i]
        taken[d.source] += rows[i].taken
        assert rows[i].size == sizes[i] and 0 <= rows[i].taken <= 2 * sizes[i]
    want = targets(of_source)
    for i, d in docs.items():
        assert rows[i].source_size == of_source[d.source] and rows[i].target == pytest.approx(want[d.source])
    assert all(abs(taken[s] - want[s]) <= max(n for i, n in sizes.items() if docs[i].source == s) for s in want)


def test_op9(spark, sf, docs):
    rows = run(spark, sf, "op9_suffix_dedup", {"doc_id": "bigint", "n_bytes": "bigint", "n_removed": "bigint", "n_spans": "bigint",
                                               "kept_sha256": "string"})
    order = sorted(docs)
    for i, flags in zip(order, repeated_bytes([docs[i].text for i in order])):
        data = (docs[i].text or "").encode()
        kept = bytes(b for b, gone in zip(data, flags) if not gone)
        runs = sum(gone and not before for before, gone in zip(b"\0" + flags, flags))
        assert rows[i][:4] == (i, len(data), sum(flags), runs) and rows[i].kept_sha256 == hashlib.sha256(kept).hexdigest()
