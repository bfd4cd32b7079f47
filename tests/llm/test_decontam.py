"""Benchmark items at every placement of substitutions."""

import random
from itertools import combinations

import pytest
from plain import held_items
from tallyframe.llm import decontam


def test_all_placements_of_substitutions(spark, prose):
    items, docs = [], []
    for n in range(1, 17):
        words = [f"i{n}x{k}" for k in range(n)]
        items.append((n, " ".join(words)))
        for e in range(n // 5 + 2):
            for at in combinations(range(n), min(e, n)):
                swapped = ["other" if k in at else w for k, w in enumerate(words)]
                docs.append((len(docs), "before it " + " ".join(swapped) + " and after"))
    items.append((40, prose(1, 40)))
    docs.append((len(docs), " ".join("other" if k % 5 == 4 else w for k, w in enumerate(prose(1, 40).split()))))
    bench = spark.createDataFrame(items, "item_id long, text string")
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {(r.id, r.item_id) for r in decontam.leaks(df, bench).collect()}
    assert got == held_items(docs, [i for i in items if len(i[1].split()) >= decontam.GROUP])


def test_many_placements_in_long_items(spark, prose):
    """Regular, bunched and drawn placements at the limit of one token in five, and beyond the text's ends."""
    draw, items, docs = random.Random(6), [(n, prose(90 + n, n)) for n in (17, 23, 40, 61, 100)], []
    for n, text in items:
        words = text.split()
        least = -(-4 * n // 5)
        wrong = [set(range(k, n, 5)) for k in range(5)] + [set(range(n - least)), set(range(least, n))]
        wrong += [set(draw.sample(range(n), n - least + more)) for more in (0, 0, 0, 0, 1) for _ in range(6)]
        for at in wrong:
            docs.append(" ".join("other" if k in at else w for k, w in enumerate(words)))
        docs += [" ".join(words[n - least:]), " ".join(words[:least]), " ".join(words[:least - 1])]
    docs = list(enumerate(docs))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = decontam.leaks(df, bench).collect()
    assert {(r.id, r.item_id) for r in found} == held_items(docs, items) and len(found) > 150


@pytest.mark.parametrize("seeds", [decontam.BLOCK_SEEDS, 40])
def test_blocks_of_seeds(spark, prose, monkeypatch, seeds):
    monkeypatch.setattr(decontam, "BLOCK_SEEDS", seeds)
    items = [(k, prose(k, 30)) for k in range(6)]
    docs = [(k, f"{prose(50, 9)} {prose(k % 8, 30)}") for k in range(20)]
    df, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert {(r.id, r.item_id) for r in decontam.leaks(df, bench).collect()} == held_items(docs, items)
    assert {r.id for r in decontam.excerpts(df, bench).collect()} == {d for d, _ in held_items(docs, items)}


def test_short_items_must_be_lines(spark, prose):
    """A common word as an item takes out nothing but the documents with a line of it."""
    docs = [(k, f"the {prose(k, 20)} the 42 and the end") for k in range(30)]
    docs += [(100, f"{prose(1, 9)}\nThe!\n{prose(2, 9)}"), (101, "42"), (102, "and, THE end"), (103, "and the end now"),
             (104, "a\nand\nthe end"), (105, None), (None, "the")]
    items = [(1, "the"), (2, "42"), (3, "And the end."), (4, ""), (5, None), (6, "...")]
    df, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = {(r.id, r.item_id, r.n_match) for r in decontam.leaks(df, bench).collect()}
    assert got == {(100, 1, 1), (101, 2, 1), (102, 3, 3), (None, 1, 1)}
    for excerpts in (False, True):
        kept = {r.doc_id for r in decontam.without_leaks(df, bench, with_excerpts=excerpts).collect()}
        assert kept == {d for d, _ in docs} - {100, 101, 102, None}


def test_empty_benchmarks(spark, odd_docs, no_docs):
    for items in ([], [(1, None), (None, ""), (2, " ,. ")]):
        bench = spark.createDataFrame(items, "item_id long, text string")
        assert decontam.leaks(odd_docs, bench).count() == 0 == decontam.excerpts(odd_docs, bench).count()
        assert decontam.without_leaks(odd_docs, bench, with_excerpts=True).count() == odd_docs.count()
    bench = spark.createDataFrame([(1, "one two three four five six"), (2, "one")], "item_id long, text string")
    assert decontam.without_leaks(no_docs, bench, with_excerpts=True).count() == 0


def quoted(doc, item):
    """Most places of the item in runs of three equal tokens on five neighbouring alignments."""
    d, w = doc.lower().split(), item.lower().split()
    runs = {(p - k, k) for p in range(len(d) - 2) for k in range(len(w) - 2) if d[p:p + 3] == w[k:k + 3]}
    return max((len({k + j for s, k in runs if first <= s <= first + 4 for j in range(3)}) for first, _ in runs), default=0)


def test_excerpts(spark, prose):
    items = [(k, prose(800 + k, n)) for k, n in enumerate((100, 60, 24, 14, 10, 6, 3, 2))]
    parts = []
    for k, t in items:
        w = t.split()
        half = len(w) // 2
        parts += [w[:half], w[half:], w[:19], w[5:25], w[10:80], w[:half] + ["added"] + w[half:],
                  w[:half] + w[half + 1:], w[:half] + ["a", "b", "c", "d"] + w[half:],
                  w[:half] + ["many"] * 5 + w[half:], w[half:] + w[:half],
                  ["other" if k % 5 == 4 else x for k, x in enumerate(w)]]
    docs = [(k, f"{prose(k, 30)} {' '.join(p)} {prose(-k, 20)}") for k, p in enumerate(parts)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    df = spark.createDataFrame([*docs, (None, docs[4][1]), (999, None)], "doc_id long, text string")
    got = {(r.id, r.item_id): r.n_places for r in decontam.excerpts(df, bench).collect() if r.id is not None}
    places = {(d, i): quoted(t, w) for d, t in docs for i, w in items}
    need = {i: min(20, -(-4 * len(w.split()) // 5)) for i, w in items}
    want = {(d, i): n for (d, i), n in places.items() if n >= need[i] and len(items[i][1].split()) >= decontam.GROUP}
    assert got == want and (4, 0) in want and (11 * 3 + 5, 3) in want
    clean = {r.doc_id for r in decontam.without_leaks(df, bench, with_excerpts=True).collect()}
    assert not clean & {4, 5, 6, 11 * 3 + 5, None} and 999 in clean
