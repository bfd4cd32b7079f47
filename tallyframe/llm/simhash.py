"""SimHash fingerprints and all links between those that differ in at most three bits.

Multi-index hashing: a fingerprint is cut into two segments of 32 bits. If two fingerprints differ in
three bits at most, one of the segments differs in one bit at most. So each fingerprint stands in
the table of a segment under its value, and asks at the values of the small Hamming ball of
radius one. It is enough to ask with one set bit cleared: of two values that differ in one
bit, one becomes the other that way. Entries meet by key, and whole distances are verified there.

Exact copies share a fingerprint and are one entry. A key with up to ``KEY_LIMIT`` entries is
searched in its task, which emits a spanning forest of the links, not all pairs. A longer key
is dealt out once more: two fingerprints that agree in one segment and differ in at most three bits of
the other have a point between them, at one bit from one and two from the other. Every
entry goes to the points around it, and all that meet at a point are tied to one that is next to it;
this takes a fixed number of rows per entry, whatever the size of the group.

A null text counts as empty; texts without words have fingerprint zero and are linked like any
other. Repeated rows get a row each, a null id is kept and names no component unless all are null;
an empty table has an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tallyframe.llm.components import components
from tallyframe.llm.storage import cut

SHINGLE, BITS = 3, 3
KEY_LIMIT = 4096


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """A bit is 1 if it is set in more than half of the XXH64 hashes (seed 42) of the shingles."""
    import xxhash

    words = (text or "").encode().lower().split()  # bytes: lowers A-Z, splits at the six blanks
    if not words:
        return 0
    if len(words) < shingle:
        parts = [b" ".join(words)]
    else:
        parts = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    hashes = b"".join(map(xxhash.xxh64_digest, parts, repeat(42)))
    bits = np.unpackbits(np.frombuffer(hashes, np.uint8)).reshape(-1, 64)
    set_ = bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * set_ > len(bits)).tobytes(), "big", signed=True)


def _fingerprints(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [fingerprint(t.as_py(), shingle) for t in batch.column(2)]
        yield pa.record_batch([batch.column(0), batch.column(1), pa.array(found, pa.int64())],
                              ["id", "tie", "fp"])


def fingerprints(df: DataFrame, id_column: str = "doc_id", text: str = "text",
                 shingle: int = SHINGLE) -> DataFrame:
    """``(id, tie, fp)`` per row; ``tie`` is a digest of the text."""
    body = F.col(f"`{text}`")
    narrow = df.select(F.col(f"`{id_column}`").cast("long").alias("id"),
                       F.xxhash64(body).alias("tie"), body.alias("body"))
    return narrow.mapInArrow(lambda b: _fingerprints(b, shingle), "id long, tie long, fp long")


ENTRIES = """
select fp, part, case when bit < 0 then value else value ^ shiftleft(1L, bit) end
             | shiftleft(cast(part as bigint), 32) as key
from (select fp, part, shiftrightunsigned(fp, 32 * part) & 4294967295L as value
      from (select fp, explode(array(0, 1)) as part from {nodes})) as values
lateral view explode(sequence(-1, 31)) as bit
where bit < 0 or (value & shiftleft(1L, bit)) <> 0
"""


def _forest(fps: np.ndarray) -> Iterator[tuple[int, int]]:
    """A spanning star of each set of entries that are linked, directly or through others."""
    rest = fps
    while len(rest):
        root, waiting, rest = rest[0], [rest[0]], rest[1:]
        while waiting and len(rest):
            near = np.bitwise_count(rest ^ waiting.pop()) <= BITS
            waiting += list(rest[near])
            yield from ((int(root), int(x)) for x in rest[near])
            rest = rest[~near]


def _search(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    """Entries sorted by key: links of each key, or the entries themselves of a long one."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("key", pa.int64())])
    keys, fps, long_key = np.array([], np.int64), np.array([], np.int64), None

    def links(keys, fps):
        starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        sizes = np.diff(np.r_[starts, len(keys)])
        shift = np.where(keys >> 32 == 0, 0, 32).astype(np.uint64)
        own = (fps.view(np.uint64) >> shift) & np.uint64(0xFFFFFFFF)
        in_table = np.add.reduceat(own == (keys & 0xFFFFFFFF).astype(np.uint64), starts)
        pairs = []
        for at in np.flatnonzero((sizes > 1) & (in_table > 0)):
            pairs += _forest(fps.view(np.uint64)[starts[at]:starts[at] + sizes[at]])
        if pairs:
            a, b = np.array(pairs, np.uint64).view(np.int64).T
            yield pa.record_batch([a, b, pa.nulls(len(a), pa.int64())], schema=schema)

    def long_entries(key, fps):
        yield pa.record_batch([fps, pa.nulls(len(fps), pa.int64()), np.full(len(fps), key)],
                              schema=schema)

    for batch in batches:
        new_keys, new_fps = (np.asarray(c) for c in batch.columns)
        if long_key is not None:
            more = int(np.searchsorted(new_keys, long_key, "right"))
            if more:
                yield from long_entries(long_key, new_fps[:more])
            if more == len(new_keys):
                continue
            new_keys, new_fps, long_key = new_keys[more:], new_fps[more:], None
        keys, fps = np.r_[keys, new_keys], np.r_[fps, new_fps]
        last = int(np.searchsorted(keys, keys[-1])) if len(keys) else 0
        ends = np.flatnonzero(np.r_[keys[1:] != keys[:-1], False]) + 1
        sizes = np.diff(np.r_[0, ends])
        for end, size in zip(ends[sizes > limit], sizes[sizes > limit]):
            yield from long_entries(keys[end - size], fps[end - size:end])
        if last:
            short = np.repeat(sizes <= limit, sizes)
            if short.any():
                yield from links(keys[:last][short], fps[:last][short])
        keys, fps = keys[last:], fps[last:]
        if len(keys) > limit:
            long_key = keys[0]
            yield from long_entries(long_key, fps)
            keys, fps = keys[:0], fps[:0]
    if len(keys):
        yield from links(keys, fps)


AROUND = """
select key, fp, in_table, steps, key_part,
  shiftrightunsigned(fp, 32 * (1 - key_part)) & 4294967295L as value
from (select key, a as fp, cast(shiftrightunsigned(key, 32) as int) as key_part,
        (shiftrightunsigned(a, 32 * cast(shiftrightunsigned(key, 32) as int)) & 4294967295L)
          = (key & 4294967295L) as in_table
      from {long}) as entries
lateral view explode(case when in_table then array(0, 1, 2) else array(0, 1) end) as steps
"""


def _long_links(long: DataFrame) -> DataFrame:
    """Links of keys with many entries, through the points between them."""
    spark = long.sparkSession
    entries = spark.sql(AROUND, long=long)
    first = entries.withColumn("i", F.explode(F.expr(
        "case when steps = 0 then array(-1) else sequence(0, 31) end")))
    second = first.withColumn("j", F.explode(F.expr(
        "case when steps = 2 then (case when i < 31 then sequence(i + 1, 31) else array() end) "
        "else array(-1) end")))
    point = ("value ^ case when i < 0 then 0L else shiftleft(1L, i) end "
             "^ case when j < 0 then 0L else shiftleft(1L, j) end")
    met = second.select("key", "fp", F.expr(point).alias("point"),
                        F.expr("in_table and steps < 2").alias("next_to"))
    centres = met.where("next_to").groupBy("key", "point").agg(F.min("fp").alias("centre"))
    return (met.join(centres, ["key", "point"]).where("fp <> centre")
            .select(F.col("fp").alias("a"), F.col("centre").alias("b")).distinct())


def links(nodes: DataFrame, limit: int = KEY_LIMIT) -> DataFrame:
    """Edges ``(a, b)`` between distinct fingerprints ``nodes (fp)`` that keep all components."""
    entries = nodes.sparkSession.sql(ENTRIES, nodes=nodes.select("fp")).select("key", "fp")
    found = cut(entries.repartition("key").sortWithinPartitions("key")
                .mapInArrow(lambda b: _search(b, limit), "a long, b long, key long"), "links")
    long = found.where("key is not null")
    near = found.where("key is null").select("a", "b")
    return near if long.isEmpty() else near.unionByName(_long_links(long))


def near_duplicates(df: DataFrame, id_column: str = "doc_id", text: str = "text",
                    limit: int = KEY_LIMIT) -> DataFrame:
    """``(id, tie, fp, component, root)``: ``component`` is the smallest id reachable over links,
    ``root`` the smallest fingerprint, which is the component's own even where ids repeat."""
    rows = cut(fingerprints(df, id_column, text), "fingerprints")
    nodes = cut(rows.groupBy("fp").agg(F.min("id").alias("first")), "nodes")
    found = components(links(nodes, limit)).withColumnRenamed("component", "root")
    rooted = nodes.join(found, F.col("fp") == F.col("node"), "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"))
    named = rooted.groupBy("root").agg(F.min("first").alias("component"))
    return rows.join(rooted.join(named, "root").select("fp", "component", "root"), "fp").select(
        "id", "tie", "fp", "component", "root")


def keep_first(df: DataFrame, id_column: str = "doc_id", text: str = "text",
               marked: DataFrame | None = None) -> DataFrame:
    """One row of each component: smallest id, then digest of the text.

    ``marked (id, tie, root)`` names the components; without it they are those of ``near_duplicates``.
    """
    marked = near_duplicates(df, id_column, text) if marked is None else marked
    best = cut(marked.groupBy("root").agg(F.min(F.struct("id", "tie")).alias("best")).select(
        F.col("best.id").alias("_k_id"), F.col("best.tie").alias("_k_tie")), "kept")
    keyed = df.withColumn("_k_text", F.xxhash64(F.col(f"`{text}`")))
    kept = keyed.join(best, F.col(f"`{id_column}`").eqNullSafe(F.col("_k_id"))
                      & (F.col("_k_text") == F.col("_k_tie")), "left_semi")
    if not marked.groupBy("id", "tie").count().where("count > 1").isEmpty():
        same = Window.partitionBy(F.col(f"`{id_column}`"), "_k_text").orderBy("_k_text")
        kept = kept.withColumn("_k_n", F.row_number().over(same)).where("_k_n = 1")
    return kept.select(*[F.col(f"`{c}`") for c in df.columns])
