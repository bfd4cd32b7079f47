"""Passages of ``LENGTH`` bytes that occur twice in a corpus, whatever the documents.

Those are removed. Passages of ``SHORT`` bytes and ``PASSAGE_WORDS`` words, the size of a paragraph, are found
by the same index and counted only (``n_passages``).

Full suffix arrays take several times the corpus, so the arrays here are sparse. The first pass takes
*anchors*: of every ``SHORT`` bytes of a document, the ``GRAM`` bytes with the smallest hash. Two equal
passages have the same anchor at the same place, so only anchors whose bytes occur twice can lie in a
repeat. Anchors are dealt by these bytes. If even the whole surroundings of two anchors (all
passages around them) are equal, the surroundings are repeats, and nothing else is asked. That is looked for in
each batch of documents first, so a passage that many documents share goes on once per batch.

The rest, the borders of repeats, go to the index family. A task reads the surroundings of its anchors in
batches. A batch becomes a suffix array: the starts of its passages, in the order of the digests of
the ``LENGTH`` or ``SHORT`` bytes that follow. It is merge-scanned against the levels that are there; starts with
equal passages, old and new, are marked. Then it becomes a level itself, and levels merge while the
newer is as large as the older one, so there are few of them and each start moves a few times.
Anchors with more than ``KEY_LIMIT`` different surroundings, such as those in a common line, are not held by
one task. A passage reaches ``SIDE`` bytes to the left or to the right of its anchor, so such an anchor
is asked for twice, with these bytes on either side and for the passages that reach further to that side,
and only where they occur again. What is still too
common is compared by digests that Spark groups.

Texts are UTF-8 bytes, null is empty. Copies of a document repeat each other as any others do;
rows with the same id and text are two documents with equal results; null ids are kept. Documents
shorter than a passage lose nothing, those shorter than a short one count none. An empty table has an empty result; other columns are not
read. Long documents are read in pieces that overlap; the result does not depend on the cuts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallyframe.llm.storage import cut

LENGTH, SHORT, GRAM = 400, 250, 96
LENGTHS = (LENGTH, SHORT)
LEFT, SIDE = LENGTH - GRAM, (SHORT - GRAM + 1) // 2
PASSAGE_WORDS = 50
KEY_LIMIT = 20_000
CONTEXTS_PER_TASK = 5_000
CONTEXTS_PER_BATCH = 1_000
PIECE = 1 << 18

U = np.uint64
_MULTIPLIER, _MIX = 0x9E3779B97F4A7C15, U(0xBF58476D1CE4E5B9)
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)


@lru_cache(maxsize=1)
def _byte_values() -> np.ndarray:
    return np.random.default_rng(7).integers(1, 1 << 63, 256, np.uint64) * U(2) + U(1)


@lru_cache(maxsize=4)
def _powers(base: int, size: int) -> np.ndarray:
    factors = np.full(size, base, np.uint64)
    factors[0] = 1
    return np.multiply.accumulate(factors)


def slices(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """Smaller batches, for steps that hold many bytes for each row."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def _room(size: int) -> int:
    return max(1 << 20, 1 << (size - 1).bit_length())


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(30))) * _MIX
    return x ^ (x >> U(29))


class Rolling:
    """Hashes of any parts of a byte array, from prefix sums of a polynomial modulo 2**64."""

    def __init__(self, data: np.ndarray):
        size = _room(len(data) + 1)
        self.back = _powers(_INVERSE, size)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_byte_values()[data] * _powers(_MULTIPLIER, size)[:len(data)], out=self.sums[1:])

    def every(self, length: int) -> np.ndarray:
        n = len(self.sums) - length
        return mixed((self.sums[length:] - self.sums[:n]) * self.back[:n])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mixed((self.sums[ends] - self.sums[starts]) * self.back[starts])


def window_places(values: np.ndarray, width: int) -> np.ndarray:
    """For each full window of ``width`` values the place of its smallest, the first of equals."""
    n = len(values)
    packed = (values & ~U((1 << 24) - 1)) | np.arange(n, dtype=np.uint64)
    blocks = np.full(-(-n // width) * width, ~U(0))
    blocks[:n] = packed
    blocks = blocks.reshape(-1, width)
    forward = np.minimum.accumulate(blocks, axis=1).ravel()
    backward = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return (np.minimum(backward[:n - width + 1], forward[width - 1:n]) & U((1 << 24) - 1)).astype(np.int64)


def anchors(data: bytes) -> Iterator[tuple[np.ndarray, ...]]:
    """``(places, hashes of the gram, of the surroundings, of the gram with the side before it and with the
    one behind it)`` of one document, by pieces. A side that the document cuts off is 0."""
    done = -1
    for cut_at in range(0, max(1, len(data) - SHORT + 1), PIECE):
        if len(data) < SHORT:
            return
        # passages that start in the piece, with all that surrounds their anchors
        low = max(0, cut_at - LENGTH)
        high = min(len(data), cut_at + PIECE + 3 * LENGTH)
        last = min(len(data) - SHORT, cut_at + PIECE - 1) - low
        part = np.frombuffer(data, np.uint8)[low:high]
        rolling = Rolling(part)
        grams = rolling.every(GRAM)
        found = window_places(grams, SHORT - GRAM + 1)[cut_at - low:last + 1]
        places = found[np.r_[True, found[1:] != found[:-1]]]
        places = places[places + low > done]
        if not len(places):
            continue
        done = int(places[-1]) + low
        starts = np.maximum(places - LEFT, 0 if low == 0 else -1)
        ends = np.minimum(places + LENGTH, len(part))
        sides = mixed(((places - starts) * 1024 + (ends - places)).astype(np.uint64) * U(_MULTIPLIER))
        wide = (np.maximum(places - SIDE, 0), places + GRAM), (places, np.minimum(places + GRAM + SIDE, len(part)))
        before, after = (np.where(end - start == GRAM + SIDE, mixed(rolling.of(start, end) + U(side)), U(0))
                         for side, (start, end) in enumerate(wide))
        yield places + low, grams[places], rolling.of(starts, ends) ^ sides, before, after


ANCHORS = "deal long, key long, ctx long, id long, tie long, pos long, state int, before long, after long"
#: States of an anchor: it goes on; it goes on for several equal ones; one of those, done.
ONE, SEVERAL, DONE = 0, 1, 2


def _combined(ids: pa.Array, ties: pa.Array, rows: list[tuple]) -> pa.RecordBatch:
    """Anchors of a batch: equal surroundings are repeats already, and one of them goes on.

    What is done is dealt out by its place and not by its key, which may be a very common one.
    """
    places, keys, contexts, before, after = (np.concatenate(parts) for parts in zip(*(r[1] for r in rows)))
    docs = np.repeat([r[0] for r in rows], [len(r[1][0]) for r in rows])
    order = np.lexsort((contexts, keys))
    keys, contexts, places, docs, before, after = (x[order] for x in (keys, contexts, places, docs, before, after))
    alike = (keys[1:] == keys[:-1]) & (contexts[1:] == contexts[:-1])
    state = np.where(np.r_[False, alike], DONE, np.where(np.r_[alike, False], SEVERAL, ONE))
    own = ties.take(pa.array(docs))
    deal = np.where(state == DONE, mixed(np.asarray(own).view(np.uint64) + places.astype(np.uint64)), keys)
    return pa.record_batch([
        deal.view(np.int64), keys.view(np.int64), contexts.view(np.int64), ids.take(pa.array(docs)), own,
        places, pa.array(state, pa.int32()), before.view(np.int64), after.view(np.int64)],
        ["deal", "key", "ctx", "id", "tie", "pos", "state", "before", "after"])


def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, ties = batch.column(0), batch.column(1)
        rows, size = [], 0
        for i, text in enumerate(batch.column(2).cast(pa.large_binary())):
            for part in anchors(text.as_py()):
                rows.append((i, part))
                size += len(part[0])
            if size > 500_000:
                yield _combined(ids, ties, rows)
                rows, size = [], 0
        if rows:
            yield _combined(ids, ties, rows)


FOUND = "key long, id long, tie long, start long, end long, pos long, single boolean, before long, after long"


def _sort_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Anchors sorted by key and surroundings. Equal surroundings give repeats (``start, end``
    around the anchor, clipped later); of a key with several, one of each is asked for (``pos``)."""
    held = None

    def out(table, repeat, ask, single):
        chosen = repeat | ask
        if not chosen.any():
            return
        t = table.filter(pa.array(chosen))
        pos = np.asarray(t["pos"])
        repeat, ask, single = repeat[chosen], ask[chosen], single[chosen]
        yield from pa.table({
            "key": t["key"], "id": t["id"], "tie": t["tie"],
            "start": pa.array(pos - LEFT, mask=~repeat), "end": pa.array(pos + LENGTH, mask=~repeat),
            "pos": pa.array(pos, mask=~ask), "single": pa.array(single),
            "before": pa.array(np.asarray(t["before"]), mask=~ask),
            "after": pa.array(np.asarray(t["after"]), mask=~ask)}).to_batches()

    def done(batch):
        """Spans of the anchors that are settled, and the others."""
        settled = np.asarray(batch["state"]) == DONE
        every = settled[settled]
        if len(every):
            yield from out(batch.filter(pa.array(settled)), every, ~every, ~every)
        return pa.Table.from_batches([batch.filter(pa.array(~settled))])

    def sort_out(table, before, after):
        """``before`` and ``after``: key and surroundings of the rows next to the table."""
        key = np.r_[before[0], np.asarray(table["key"]), after[0]]
        ctx = np.r_[before[1], np.asarray(table["ctx"]), after[1]]
        there = np.r_[before[2], np.ones(len(key) - 2, bool), after[2]]
        next_key = (key[1:] == key[:-1]) & there[1:] & there[:-1]
        next_ctx = next_key & (ctx[1:] == ctx[:-1])
        repeat = next_ctx[:-1] | next_ctx[1:] | (np.asarray(table["state"]) == SEVERAL)
        first = ~next_ctx[:-1]  # the first of its surroundings
        return repeat, first, next_key

    # A row needs its neighbours; whether the key has other surroundings is known for the first of a
    # run by the row before it or by the row after the run. So runs are closed one batch late.
    before = (0, 0, False)
    for batch in batches:
        table = yield from done(batch)
        held = table if held is None else pa.concat_tables([held, table])
        key, ctx = np.asarray(held["key"]), np.asarray(held["ctx"])
        if not len(key) or (key[0] == key[-1] and ctx[0] == ctx[-1]):
            if len(key) > 2:  # a long run of equal surroundings: all but its first row can go
                middle = held.slice(1, len(key) - 2)
                every = np.ones(len(key) - 2, bool)
                yield from out(middle, every, ~every, ~every)
                held = pa.concat_tables([held.slice(0, 1), held.slice(len(key) - 1)])
            continue
        last = int(np.flatnonzero((key != key[-1]) | (ctx != ctx[-1]))[-1]) + 1
        yield from out(*_judged(held.slice(0, last), before, (key[last], ctx[last], True), sort_out))
        before = (key[last - 1], ctx[last - 1], True)
        held = held.slice(last)
    if held is not None and len(held):
        yield from out(*_judged(held, before, (0, 0, False), sort_out))


def _judged(table, before, after, sort_out):
    repeat, first, next_key = sort_out(table, before, after)
    # the run that a row starts ends where the next first row stands
    starts = np.flatnonzero(first)
    ends = np.r_[starts[1:], len(first)]
    others = np.zeros(len(first), bool)
    others[starts] = next_key[:-1][starts] | next_key[ends]
    ask = first & others
    return table, repeat, ask, ask & ~repeat


#: Which passages around an anchor are meant: all, those that reach further to the left, or to the right.
BOTH, BEFORE, AFTER = 0, 1, 2
CONTEXTS = "key long, id long, tie long, pos long, left int, single boolean, body binary, side int"


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["key", "id", "tie", "pos", "left", "single", "body", "side"]
    for batch in slices(batches, 200):
        rows = []
        for id_, tie, text, asked in zip(*(c.to_pylist() for c in batch.columns)):
            data = text.encode()
            for a in asked:
                start = max(0, a["pos"] - LEFT)
                rows.append((a["key"], id_, tie, a["pos"], a["pos"] - start, a["single"],
                             data[start:a["pos"] + LENGTH], a["side"]))
            if len(rows) >= 2000:
                yield _context_batch(rows, names)
                rows = []
        if rows:
            yield _context_batch(rows, names)


def _context_batch(rows, names):
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.binary(), pa.int32()]
    return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)


def passages(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(digest, row, offset, kind)`` of all passages around the anchors of a batch; ``kind`` counts ``LENGTHS``.

    The digest covers the key, the kind and the offset from anchor to passage: only passages that lie
    alike around equal anchors can be equal by it.
    """
    bodies = batch.column(6).to_pylist()
    sizes = np.array([len(b) for b in bodies])
    left = np.asarray(batch.column(4)).astype(np.int64)
    keys, side = np.asarray(batch.column(0)).view(np.uint64), np.asarray(batch.column(7))
    rolling = Rolling(np.frombuffer(b"".join(bodies), np.uint8))
    base = np.r_[0, np.cumsum(sizes)[:-1]]
    parts = []
    for kind, length in enumerate(LENGTHS):
        nearest = np.where(side == BEFORE, (length - GRAM + 1) // 2, 0)
        farthest = np.where(side == AFTER, (length - GRAM) // 2, length - GRAM)
        first = np.maximum(0, left - farthest)
        count = np.maximum(0, np.minimum(left - nearest, sizes - length) - first + 1)
        row = np.repeat(np.arange(len(bodies)), count)
        at = first[row] + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        offset = left[row] - at
        starts = base[row] + at
        place = (offset + 1 + kind * 1024).astype(np.uint64)
        digest = rolling.of(starts, starts + length) ^ mixed(keys[row] * U(_MULTIPLIER) + place)
        parts.append((digest, row, offset, np.full(len(row), kind)))
    return tuple(np.concatenate(p) for p in zip(*parts))


class IndexFamily:
    """Sorted levels of passage starts; each knows which of its passages occur again."""

    def __init__(self):
        self.levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def add(self, digests: np.ndarray, owners: np.ndarray) -> None:
        order = np.argsort(digests)
        digests, owners = digests[order], owners[order]
        again = np.zeros(len(digests), bool)
        twice = digests[1:] == digests[:-1]
        again[1:] |= twice
        again[:-1] |= twice
        for known, _, marked in self.levels:
            at = np.searchsorted(known, digests)
            hit = known[np.minimum(at, len(known) - 1)] == digests
            again |= hit
            marked[at[hit]] = True  # equal ones behind it are marked since they met
        self.levels.append((digests, owners, again))
        while len(self.levels) > 1 and len(self.levels[-1][0]) >= len(self.levels[-2][0]):
            newer, older = self.levels.pop(), self.levels.pop()
            joined = [np.concatenate(pair) for pair in zip(older, newer)]
            order = np.argsort(joined[0], kind="stable")  # two sorted runs: a merge
            self.levels.append(tuple(part[order] for part in joined))

    def repeated(self) -> np.ndarray:
        """Owners of the passages that occur again."""
        return np.concatenate([o[m] for _, o, m in self.levels] or [np.array([], np.int64)])


#: ``length``: of the passages that make the span, or null for whole surroundings of an anchor.
SPANS = "id long, tie long, start long, end long, length int"


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    family, asked, rows = IndexFamily(), [], 0
    for batch in slices(batches, CONTEXTS_PER_BATCH):
        digest, row, offset, kind = passages(batch)
        family.add(digest, ((row + rows) * len(LENGTHS) + kind) * 512 + offset)
        asked.append(batch.select(["id", "tie", "pos", "single"]))
        rows += batch.num_rows
    if rows:
        yield from _spans(pa.Table.from_batches(asked), family.repeated(), rows)


def _spans(asked: pa.Table, owners: np.ndarray, rows: int) -> Iterator[pa.RecordBatch]:
    """All passages of one kind around one anchor overlap, so the repeated ones make one span."""
    group, offset = owners >> 9, owners & 511
    low, high = np.full(rows * len(LENGTHS), 512), np.full(rows * len(LENGTHS), -1)
    np.minimum.at(low, group, offset)
    np.maximum.at(high, group, offset)
    single = np.asarray(asked["single"])
    for kind, length in enumerate(LENGTHS):
        nearest, farthest = low[kind::len(LENGTHS)], high[kind::len(LENGTHS)]
        chosen = (farthest >= 0) & single
        t = asked.filter(pa.array(chosen))
        pos = np.asarray(t["pos"])
        yield from pa.table({
            "id": t["id"], "tie": t["tie"], "start": pos - farthest[chosen],
            "end": pos - nearest[chosen] + length,
            "length": pa.array(np.full(len(pos), length), pa.int32())}).to_batches()


def _digest_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, CONTEXTS_PER_BATCH):
        digest, row, offset, kind = passages(batch)
        take = pa.array(row)
        yield pa.record_batch([
            digest.view(np.int64), *(batch.column(n).take(take) for n in ("id", "tie", "pos")),
            batch.column("single").take(take), offset, pa.array(np.array(LENGTHS)[kind], pa.int32())],
            ["digest", "id", "tie", "pos", "single", "offset", "length"])


def _grouped(contexts: DataFrame) -> DataFrame:
    """The same as :func:`_index` for anchors with very many surroundings, by shuffles."""
    rows = contexts.mapInArrow(_digest_rows, "digest long, id long, tie long, pos long, "
                                             "single boolean, offset long, length int")
    twice = rows.groupBy("digest").agg(F.count("*").alias("n")).where("n > 1").select("digest")
    return (rows.where("single").join(twice, "digest").groupBy("id", "tie", "pos", "length")
            .agg(F.min("offset").alias("low"), F.max("offset").alias("high"))
            .selectExpr("id", "tie", "pos - high as start", "pos - low + length as end", "length"))


def narrow(df: DataFrame, id_column: str, text: str) -> DataFrame:
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    return df.select(F.col(f"`{id_column}`").cast("long").alias("id"), F.xxhash64(body).alias("tie"),
                     body.alias("body"))


def of_document(docs: DataFrame, rows: DataFrame, values: str, how: str) -> DataFrame:
    """``docs`` with the list of its ``rows (id, tie, ...)`` as a column."""
    lists = rows.groupBy(F.col("id").alias("of"), F.col("tie").alias("of_tie")).agg(
        F.collect_list(F.struct(*[c for c in rows.columns if c not in ("id", "tie")])).alias(values))
    return docs.join(lists, F.col("id").eqNullSafe(F.col("of")) & (F.col("tie") == F.col("of_tie")),
                     how).select("id", "tie", "body", values)


def repeats(docs: DataFrame, limit: int = KEY_LIMIT) -> DataFrame:
    """Spans ``(id, tie, start, end, length)`` of repeated bytes of ``narrow`` documents.

    They overlap and may reach over the borders of the text.
    """
    rows = docs.where(F.octet_length("body") >= SHORT).mapInArrow(_anchor_rows, ANCHORS)
    found = cut(rows.repartition("deal").sortWithinPartitions("key", "ctx").drop("deal")
                .mapInArrow(_sort_out, FOUND), "anchors")
    spans = found.where("start is not null").select("id", "tie", "start", "end", F.lit(None).cast("int").alias("length"))
    asked = found.where("pos is not null").drop("start", "end").withColumn("side", F.lit(BOTH))
    hot = cut(asked.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > limit).select("key"), "hot-anchors")
    if hot.isEmpty():
        return spans.unionByName(_indexed(docs, asked))
    sides = cut(asked.join(hot, "key", "left_semi").select(
        "id", "tie", "pos", "single", F.inline(F.array(
            F.struct(F.col("before").alias("key"), F.lit(BEFORE).alias("side")),
            F.struct(F.col("after").alias("key"), F.lit(AFTER).alias("side"))))).where("key <> 0"), "sides")
    again = sides.join(sides.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "key")
    asks = ["id", "tie", "pos", "key", "single", "side"]
    usual = asked.join(hot, "key", "left_anti").select(asks).unionByName(again.where(F.col("n") <= limit).select(asks))
    return spans.unionByName(_indexed(docs, usual)).unionByName(
        _grouped(_around(docs, again.where(F.col("n") > limit))))


def _around(docs: DataFrame, asked: DataFrame) -> DataFrame:
    asked = asked.select("id", "tie", "pos", "key", "single", "side")
    return of_document(docs, asked, "asked", "inner").mapInArrow(_contexts, CONTEXTS)


def _indexed(docs: DataFrame, asked: DataFrame) -> DataFrame:
    tasks = max(1, -(-asked.count() // CONTEXTS_PER_TASK))
    return _around(docs, asked).repartition(tasks, "key").mapInArrow(_index, SPANS)


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s in sorted(spans):
        if out and s[0] <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], s[1]))
        else:
            out.append(s)
    return out


def runs(spans: list[dict], size: int) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """Runs of bytes in repeats of ``LENGTH`` bytes, and of those in repeats of ``SHORT`` bytes.

    Surroundings of an anchor are a long repeat unless the whole document is shorter.
    """
    ends = [(max(0, s["start"]), min(size, s["end"])) for s in spans]
    long = [e for e, s in zip(ends, spans) if s["length"] != SHORT and e[1] - e[0] >= LENGTH]
    return merged(long), merged(ends)


REMOVED = "id long, n_bytes long, n_removed long, n_spans long, n_passages long, kept_sha256 string, kept binary"


def _remove(batches: Iterator[pa.RecordBatch], with_text: bool) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, 500):
        rows = []
        for id_, text, spans in zip(*(c.to_pylist() for c in batch.columns)):
            data = text.encode()
            gone, repeated = runs(spans or [], len(data))
            n_passages = sum(len(data[start:end].split()) >= PASSAGE_WORDS for start, end in repeated)
            parts, at = [], 0
            for start, end in gone:
                parts.append(data[at:start])
                at = end
            kept = b"".join([*parts, data[at:]])
            rows.append((id_, len(data), len(data) - len(kept), len(gone), n_passages,
                         hashlib.sha256(kept).hexdigest(), kept if with_text else None))
        types = [pa.int64()] * 5 + [pa.string(), pa.binary()]
        yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), types)],
                              ["id", "n_bytes", "n_removed", "n_spans", "n_passages", "kept_sha256", "kept"])


def without_repeats(df: DataFrame, id_column: str = "doc_id", text: str = "text",
                    with_text: bool = True, limit: int = KEY_LIMIT) -> DataFrame:
    """``id, n_bytes, n_removed, n_spans, n_passages, kept_sha256, kept`` per row; ``kept`` are bytes.

    ``n_passages``: runs covered by repeats of ``SHORT`` bytes that have ``PASSAGE_WORDS`` words or more, removed or not.
    """
    docs = narrow(df, id_column, text)
    # Both joins of the documents are by the same keys: their texts are shuffled once.
    joined = of_document(docs, repeats(docs, limit), "spans", "left")
    return joined.select("id", "body", "spans").mapInArrow(lambda b: _remove(b, with_text), REMOVED)
