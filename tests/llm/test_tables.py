"""Near copies, repeats, quality, mix, shards and benchmark items against plain versions."""

import random
from collections import Counter
from itertools import groupby

import numpy as np
import pytest

from plain import (components, fingerprint, held_items, quality_counts, repeated_bytes, targets, words)
from tallyframe.llm import decontam, mixing, quality, shards, simhash, suffixes
from tallyframe.llm.components import components as spark_components


def changed(text, draw, n):
    w = text.split(" ")
    for _ in range(n):
        w[draw.randrange(len(w))] = "changed" + str(draw.randrange(10))
    return " ".join(w)


@pytest.mark.parametrize("edges", [
    [(i, i + 1) for i in range(60)], [(random.Random(k).randrange(80), random.Random(-k).randrange(80))
                                      for k in range(1, 60)], [(5, 5)], []])
def test_components(spark, edges):
    df = spark.createDataFrame(edges, "a long, b long")
    linked = {frozenset(e) for e in edges}
    nodes = {n for a, b in edges if a != b for n in (a, b)}
    want = components(nodes, lambda a, b: frozenset((a, b)) in linked)
    assert {r.node: r.component for r in spark_components(df).collect()} == want


@pytest.fixture(scope="module")
def copies(prose):
    draw = random.Random(3)
    texts = [prose(k, draw.choice((3, 40, 200))) for k in range(20)]
    return [(k, draw.choice((t, changed(t, draw, 1), changed(t, draw, 2)))) for k, t in
            enumerate(draw.choice(texts[:6] if k % 3 else texts) for k in range(150))]


@pytest.mark.parametrize("limit", [simhash.KEY_LIMIT, 2])
def test_near_duplicates(spark, copies, limit):
    rows = simhash.near_duplicates(spark.createDataFrame(copies, "doc_id long, text string"), limit=limit).collect()
    fps = {d: fingerprint(t) for d, t in copies}
    want = components(fps, lambda a, b: (fps[a] ^ fps[b]).bit_count() <= 3)
    assert {r.id: (r.fp % 2**64, r.component) for r in rows} == {d: (fps[d], want[d]) for d in fps}


@pytest.mark.parametrize("limit", [simhash.KEY_LIMIT, 3])
def test_links_keep_components(spark, limit):
    draw = random.Random(9)
    centres = [draw.getrandbits(64) for _ in range(4)] + [0]
    fps = set()
    for _ in range(250):
        x = draw.choice(centres)
        for _ in range(draw.randrange(6)):
            x ^= 1 << draw.randrange(64)
        fps.add(x)
    nodes = spark.createDataFrame([(x - (x >> 63 << 64),) for x in fps], "fp long")
    edges = [(r.a % 2**64, r.b % 2**64) for r in simhash.links(nodes, limit).collect()]
    joined = {frozenset(e) for e in edges}
    assert components(fps, lambda a, b: frozenset((a, b)) in joined) == components(
        fps, lambda a, b: (a ^ b).bit_count() <= 3)


def test_keep_first(spark, odd_docs, no_docs, copies):
    df = spark.createDataFrame(copies, "doc_id long, text string")
    fps = {d: fingerprint(t) for d, t in copies}
    want = set(components(fps, lambda a, b: (fps[a] ^ fps[b]).bit_count() <= 3).values())
    assert sorted(r.doc_id for r in simhash.keep_first(df).collect()) == sorted(want)
    kept = simhash.keep_first(odd_docs)
    assert kept.columns == odd_docs.columns
    ids = Counter(r.doc_id for r in kept.collect())
    # 1 = 2, empty texts 3 = 4 = 5, the rows without id are one, 7 has two different texts
    assert ids == Counter({1: 1, 3: 1, 6: 1, None: 1, 7: 2, 8: 1, 9: 1, 10: 1})
    assert simhash.keep_first(no_docs).count() == 0


def plain_removal(texts):
    out = []
    for text, flags in zip(texts, repeated_bytes(texts)):
        data = (text or "").encode()
        out.append((len(data), sum(flags), flags.count(b"\0\1") + flags.startswith(b"\1"),
                    bytes(d for d, f in zip(data, flags) if not f)))
    return out


@pytest.mark.parametrize("limit", [suffixes.KEY_LIMIT, 2])
def test_repeats(spark, prose, limit):
    passage, draw = prose(77, 120), random.Random(5)
    texts = [prose(k, 150) for k in range(12)]
    texts += [prose(100 + k, 40) + passage + prose(200 + k, 30) for k in range(5)]
    texts += [prose(300, 10) + passage[50:50 + n] + "é" * k for k, n in enumerate((398, 399, 400, 401, 430, 500))]
    texts += [passage[:410] + passage[:405], "ab" * 400, "z" * 1500, "", None, prose(1, 150), prose(1, 150)]
    texts += [changed(prose(k, 400), draw, 2) for k in (400, 400, 400, 400, 401, 401)]
    texts += ["é" * 250 + prose(9, 10), "é" * 250]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = sorted(suffixes.without_repeats(df, limit=limit).collect())
    got = [(r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in rows]
    assert got == plain_removal(texts)


def test_repeats_in_long_texts(spark, prose):
    passage = prose(5, 300)
    long = prose(6, 90_000)
    texts = [long[:200_000] + passage + long[200_000:], prose(7, 50) + passage[:700] + prose(8, 10),
             long[262_000:262_500], long[-405:]]
    assert len(texts[0]) > 1.2 * suffixes.PIECE
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = sorted(suffixes.without_repeats(df).collect())
    assert [(r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in rows] == plain_removal(texts)


@pytest.mark.parametrize("limit", [suffixes.KEY_LIMIT, 2])
def test_passages_shorter_than_a_removed_one(spark, prose, limit):
    passages = [prose(500 + k, n) for k, n in enumerate((30, 48, 55, 60, 70, 90, 120))]
    texts = [prose(600 + k, 60) + "\n" + passages[k % 7] + "\n" + prose(700 + k, 60) for k in range(21)]
    texts += [prose(800 + k, 150) for k in range(8)] + [prose(900, 55), prose(900, 55), "a b " * 80, "x" * 300, "", None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = sorted(suffixes.without_repeats(df, limit=limit).collect())
    assert [(r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in rows] == plain_removal(texts)
    want = []
    for text, flags in zip(texts, repeated_bytes(texts, suffixes.SHORT)):
        data, at, n = (text or "").encode(), 0, 0
        for gone, run in groupby(flags):
            size = len(list(run))
            n += bool(gone) and len(data[at:at + size].split()) >= suffixes.PASSAGE_WORDS
            at += size
        want.append(n)
    assert [r.n_passages for r in rows] == want
    planted = [k for k in range(21) if len(passages[k % 7].split()) > 50 and len(passages[k % 7]) >= suffixes.SHORT]
    assert len(planted) > 10 and all(want[k] for k in planted) and not any(want[21:29])


def test_repeats_of_odd_rows(odd_docs, no_docs):
    rows = suffixes.without_repeats(odd_docs).collect()
    texts = [r.text for r in odd_docs.collect()]
    want = Counter((n, gone) for n, gone, _, _ in plain_removal([t if len(t or "") < 9000 else "" for t in texts]))
    got = Counter((r.n_bytes, r.n_removed) if r.n_bytes < 9000 else (0, r.n_removed) for r in rows)
    assert got == want
    assert suffixes.without_repeats(no_docs).count() == 0


def test_levels_merge_and_mark():
    family, draw = suffixes.IndexFamily(), np.random.default_rng(1)
    every = draw.integers(0, 3000, 4000).astype(np.uint64)
    for k in range(0, 4000, 250):
        family.add(every[k:k + 250], np.arange(k, k + 250))
        sizes = [len(d) for d, _, _ in family.levels]
        assert sizes == sorted(sizes, reverse=True) and len(sizes) < 6
    counts = Counter(every.tolist())
    assert sorted(family.repeated()) == [i for i, x in enumerate(every.tolist()) if counts[x] > 1]


def test_quality(spark, odd_docs, no_docs, prose):
    rows = quality.quality(odd_docs).collect()
    assert Counter((r.doc_id, r._q_words, r._q_word_chars, r._q_n_symbols, r._q_n_dup_lines, r._q_n_repeat_words)
                   for r in rows) == Counter((r.doc_id, *quality_counts(r.text)) for r in odd_docs.collect())
    assert all(r._q_failed == (r._q_words < 50 or 2 * r._q_n_repeat_words > r._q_words) for r in rows)
    assert not any(r._q_kept for r in rows if r._q_failed)
    assert quality.quality(no_docs).count() == 0
    texts = [prose(k, 100) + "\n" + prose(-k, 20) for k in range(300)]
    junk = [" ".join(w + "$$#" for w in prose(1000 + k, 100).split()) for k in range(20)]
    docs = [(k, t, "en", "web" if k % 3 else "rare") for k, t in enumerate(texts + junk)]
    kept = {r.doc_id for r in quality.quality(spark.createDataFrame(
        docs, "doc_id long, text string, lang string, source string")).where("_q_kept").collect()}
    assert kept == set(range(300))


def test_sketch_bins_and_merge(spark):
    cells = spark.createDataFrame([("en", "a", "_q_words", x, 1) for x in range(100)],
                                  "lang string, source string, measure string, bin long, n long")
    merged = quality.merge(cells, ["lang"])
    assert merged.agg({"n": "sum"}).first()[0] == 100


def test_mix(spark, odd_docs, no_docs, prose):
    draw = random.Random(4)
    docs = [(k, prose(k, draw.choice((0, 5, 30, 90))) if k % 50 else None,
             draw.choice(["a", "a", "a", "b", "c", "d", None])) for k in range(900)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string")
    rows = mixing.sized(df)
    sizes = Counter()
    for _, t, s in docs:
        sizes[s] += len(words(t))
    want = targets(sizes)
    got = {r.source: r.target for r in mixing.source_targets(rows).collect()}
    assert got == pytest.approx(want)
    settled = mixing.copies(rows, mixing.source_targets(rows), seed=1).collect()
    assert Counter((r.id, r.size) for r in settled) == Counter((k, len(words(t))) for k, t, _ in docs)
    taken = Counter()
    for r in settled:
        ratio = want[r.source] / sizes[r.source]
        assert int(ratio) <= r.copies <= int(ratio) + 1 and r.copies <= 2
        taken[r.source] += r.size * r.copies
    assert all(abs(taken[s] - want[s]) <= 90 for s in want)
    assert Counter(settled) == Counter(mixing.copies(rows, mixing.source_targets(rows), seed=1).collect())
    mixed = Counter(r.doc_id for r in mixing.mix(df, seed=1).collect())
    assert mixed == Counter({r.id: r.copies for r in settled if r.copies})
    assert mixing.mix(odd_docs).columns == odd_docs.columns
    assert mixing.mix(odd_docs).where("doc_id = 8").count() <= 2
    assert mixing.mix(no_docs).count() == 0


def test_mix_is_unbiased(spark):
    """Over many seeds each document is taken at its expected rate."""
    rows = spark.createDataFrame([(k, k, "a" if k < 6 else "b", 10 + k) for k in range(12)],
                                 "id long, tie long, source string, size long")
    share = {r.source: r.target / r.source_size for r in mixing.source_targets(rows).collect()}
    n, copies = 25, Counter()
    for seed in range(n):
        for r in mixing.copies(rows, mixing.source_targets(rows), seed).collect():
            copies[r.source] += r.copies / 6 / n
    assert copies == pytest.approx(share, abs=0.12)


def test_shards(odd_docs, no_docs, spark):
    many = spark.range(5000).selectExpr("id % 4000 as doc_id", "cast(id % 4000 as string) as text")
    rows = shards.shard(many, 7, ["doc_id", "text"], bucket_rows=400)
    got = rows.collect()
    assert Counter(r.doc_id for r in got) == Counter(k % 4000 for k in range(5000))
    counts = Counter(r._s_shard for r in got)
    assert set(counts) == set(range(7)) and max(counts.values()) - min(counts.values()) <= 1
    for s, n in counts.items():
        assert sorted(r._s_slot for r in got if r._s_shard == s) == list(range(n))
    again = shards.shard(many.repartition(3), 7, ["doc_id", "text"], bucket_rows=400).collect()
    assert sorted(got) == sorted(again)
    first = [r.doc_id for r in sorted(got, key=lambda r: (r._s_shard, r._s_slot))]
    assert abs(np.corrcoef(first, range(5000))[0, 1]) < 0.06
    odd = shards.shard(odd_docs, 40, ["doc_id", "text"])
    assert odd.columns[:-2] == odd_docs.columns and odd.count() == odd_docs.count()
    assert odd.groupBy("_s_shard").count().agg({"count": "max"}).first()[0] == 1
    assert shards.shard(no_docs, 40, ["doc_id"]).count() == 0


def test_read_shards(spark, odd_docs, no_docs, tmp_path):
    """What is read back is what was dealt, also for an empty table and clashing columns."""
    for k, df in enumerate((odd_docs, no_docs)):
        rows = shards.shard(df, 3, ["doc_id", "text"])
        shards.write_shards(rows, str(tmp_path / str(k)))
        back = shards.read_shards(spark, str(tmp_path / str(k)), df.schema)
        key = lambda r: (r._s_shard, r._s_slot)
        assert sorted(back.select(*rows.columns).collect(), key=key) == sorted(rows.collect(), key=key)


def test_write_shards(spark, tmp_path):
    rows = shards.shard(spark.range(100).withColumnRenamed("id", "doc_id"), 4, ["doc_id"], bucket_rows=10)
    shards.write_shards(rows, str(tmp_path / "s"))
    assert spark.read.parquet(str(tmp_path / "s")).groupBy("_s_shard").count().where("count = 25").count() == 4


def test_leaks(spark, odd_docs, no_docs, prose):
    items = [(k, prose(500 + k, n)) for k, n in enumerate((14, 20, 37, 59, 9, 8, 3))] + [(90, None), (91, "")]
    bench = spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, id string")
    draw, docs = random.Random(2), []
    for k in range(60):
        item = draw.choice(items[:5])[1]
        w = item.upper().replace(" ", ", ").split(" ")
        for i in draw.sample(range(len(w)), draw.choice((0, 1, len(w) // 5))):
            w[i] = "swapped"
        docs.append((k, prose(k, 100) + ". " + " ".join(w) + "! " + prose(-k, 50) if k % 2 else prose(k, 200)))
    docs += [(70, items[2][1]), (71, " ".join(items[3][1].split()[10:])), (72, items[5][1]), (73, None)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {(r.id, r.item_id) for r in decontam.leaks(df, bench).collect()}
    long_enough = [i for i in items if len((i[1] or "").split()) >= decontam.GROUP]
    want = held_items(docs, long_enough)
    assert got == want and len(want) > 25
    clean = {r.doc_id for r in decontam.without_leaks(df, bench).collect()}
    assert clean == {d for d, _ in docs} - {d for d, _ in want}
    assert decontam.without_leaks(odd_docs, bench).count() == odd_docs.count()
    assert decontam.without_leaks(no_docs, bench).count() == 0
    assert decontam.leaks(df, bench.limit(0)).count() == 0
