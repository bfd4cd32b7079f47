"""Hard negatives of anchors, by a vertical scan with bounds (branch and bound on dimensions).

Vectors are cut to whole numbers, ``floor(scale * x)``; a score is the inner product. Rows are dealt
into blocks of bounded size by hash. A block stores its vectors by dimension, with the least and
the largest value of each. An anchor reads the dimensions of a block in descending order of its own
magnitudes. After some dimensions, what the others can still add lies between sums of least and
largest products, so each candidate has bounds of its score; candidates that cannot matter are cleared
in a bitmap, and when most are gone the others move together. Nothing is estimated: a candidate
goes only if its bounds exclude it, and the rows that stay have exact scores at the end.

The first scan finds each anchor's positives, the best other rows of its label. Each of them opens
a window of scores; the second scan finds the best rows of other labels inside every window. A
block returns at most as many rows per window as are asked for, and the best of all blocks are taken.
The anchors are a stated part of the rows and visit all blocks; what is shuffled is one copy of them
per block.

Rows with a null label, a null vector, or a null or non-finite component take no part. A shorter
vector counts as zero where a longer one goes on. Rows that are equal in id, label and vector count once;
equal ids with other vectors are rows of their own; a null id comes after all others among ties.
Anchors without positives or without negatives in a window have no rows there; an empty table gives an
empty result; other columns are not read. A score beyond 64 bits is held at their limit, so the window of such
a positive ends below it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyframe.llm.storage import cut

#: Components in a block, and dimensions that are read between two looks at the bounds.
BLOCK_CELLS, STRIDE = 1 << 19, 8
LONG = 1 << 63
#: Below this, doubles hold every whole number.
DOUBLE = float(1 << 53)


def vectors(df: DataFrame, id_column: str, vector: str, label: str) -> DataFrame:
    """``(id, key, label, vector)`` of the distinct rows that take part; ``key`` tells rows apart."""
    own = F.col(f"`{vector}`")
    own = own if dict(df.dtypes)[vector] == "array<float>" else own.cast("array<double>")
    rows = df.select(F.col(f"`{id_column}`").cast("long").alias("id"), F.col(f"`{label}`").cast("long").alias("label"),
                     own.alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(F.col("label").isNotNull() & F.col("vector").isNotNull() & finite)
    return rows.distinct().withColumn("key", F.xxhash64("id", "label", "vector"))


def whole(values: np.ndarray, scale: int) -> np.ndarray:
    """``floor(scale * x)``: doubles, or Python's numbers where doubles could not hold them."""
    values = values.astype(np.float64)
    if np.abs(values).max(initial=0) * scale < DOUBLE:
        return np.floor(scale * values)
    out = [int(np.floor(scale * x)) if abs(x) * scale < DOUBLE else int(x) * scale for x in values.ravel().tolist()]
    return np.array([*out, None], object)[:-1].reshape(values.shape)


def exact(values: np.ndarray) -> np.ndarray:
    """The same whole numbers as Python's."""
    return values if values.dtype == object else np.vectorize(int, otypes=[object])(values)


def _matrix(column: pa.ListArray, scale: int) -> np.ndarray:
    """The vectors as columns, shorter ones filled with zeros."""
    lengths = np.diff(column.offsets.to_numpy())
    values = whole(column.flatten().to_numpy(zero_copy_only=False), scale)
    wide = int(lengths.max(initial=0))
    if (lengths == wide).all():
        return np.ascontiguousarray(values.reshape(len(lengths), wide).T)
    out = np.zeros((len(lengths), wide), values.dtype)
    out[np.arange(wide) < lengths[:, None]] = values
    return np.ascontiguousarray(out.T)


class Block:
    """Rows by dimension, ordered by label and id."""

    def __init__(self, rows: pa.RecordBatch, scale: int):
        dims, labels = _matrix(rows.column("vector"), scale), rows.column("label").to_numpy()
        ids, nulls = rows.column("id").fill_null(0).to_numpy(), rows.column("id").is_null().to_numpy(zero_copy_only=False)
        order = np.lexsort((ids, nulls, labels))
        self.dims, self.labels = dims[:, order], labels[order]
        self.ids, self.nulls, self.keys = ids[order], nulls[order], rows.column("key").to_numpy()[order]
        self.low, self.high = self.dims.min(axis=1), self.dims.max(axis=1)

    def of_label(self, label: int) -> slice:
        return slice(*np.searchsorted(self.labels, (label, label + 1)).tolist())


def scan(block: Block, query: np.ndarray, bitmap: np.ndarray,
         alive: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Candidates that stay, and their exact scores.

    ``alive`` gets the least and the largest possible scores of the candidates and tells which of
    them still matter.
    """
    size = min(len(query), len(block.dims))
    query, dims, low, high = query[:size], block.dims[:size], block.low[:size], block.high[:size]
    reach = np.maximum(np.abs(low), np.abs(high))
    if object in (query.dtype, dims.dtype) or float((np.abs(query) * reach).sum()) >= DOUBLE:
        query, dims, low, high = exact(query), exact(dims), exact(low), exact(high)
    order = np.argsort(-np.abs(query), kind="stable")
    ends = np.stack([query * low, query * high])
    least, most = ends.min(axis=0)[order], ends.max(axis=0)[order]
    # What the dimensions from place k on can add at least and at most.
    rest = [np.append(np.cumsum(side[::-1])[::-1], 0) for side in (least, most)]
    rows = np.flatnonzero(bitmap)
    here: slice | np.ndarray = slice(int(rows[0]), int(rows[-1]) + 1) if len(rows) else slice(0, 0)
    bitmap = bitmap[here].copy()
    rows = np.arange(here.start, here.stop)
    total = np.zeros(len(rows), query.dtype)
    dims = dims[:, here]
    for at in range(0, size, STRIDE):
        for d in order[at:at + STRIDE]:
            total += query[d] * dims[d]
        done = min(at + STRIDE, size)
        bitmap &= alive(np.where(bitmap, total + rest[0][done], -np.inf), np.where(bitmap, total + rest[1][done], -np.inf))
        left = int(bitmap.sum())
        if not left:
            break
        if 2 * left < len(rows):
            rows, total, dims, bitmap = rows[bitmap], total[bitmap], dims[:, bitmap], bitmap[bitmap]
    return rows[bitmap], total[bitmap]


def _best(block: Block, rows: np.ndarray, score: np.ndarray, n: int) -> np.ndarray:
    """Places of the ``n`` highest scores, ties by id, null ids last."""
    by_id = np.lexsort((block.ids[rows], block.nulls[rows]))
    return by_id[np.argsort(-score[by_id], kind="stable")[:n]]


def positives_in(block: Block, anchor: dict, n: int) -> list[tuple]:
    """``(id, key, score)`` of the best rows of the anchor's label, the anchor itself left out."""
    bitmap = np.zeros(len(block.ids), bool)
    bitmap[block.of_label(anchor["label"])] = True
    bitmap &= ~((block.keys == anchor["key"]) & (block.ids == anchor["id"]))

    def alive(low: np.ndarray, high: np.ndarray) -> np.ndarray:
        return high >= np.partition(low, -n)[-n] if len(low) > n else np.ones(len(low), bool)

    rows, score = scan(block, anchor["query"], bitmap, alive)
    return [(None if block.nulls[r] else int(block.ids[r]), int(block.keys[r]), int(score[i]))
            for i in _best(block, rows, score, n) for r in [rows[i]]]


def negatives_in(block: Block, anchor: dict, n: int, low_share: int, high_share: int) -> list[tuple]:
    """``(place, id, key, score)``: for each positive the best rows of other labels in its window."""
    windows = [(-(-low_share * p // 100), high_share * p // 100) for p in anchor["scores"]]
    open_ = [(i, a, b) for i, (a, b) in enumerate(windows) if a <= b]
    bitmap = np.ones(len(block.ids), bool)
    bitmap[block.of_label(anchor["label"])] = False
    spans = sorted({(a, b) for _, a, b in open_})
    if not spans:
        return []

    def alive(low: np.ndarray, high: np.ndarray) -> np.ndarray:
        out = np.zeros(len(low), bool)
        for a, b in spans:
            sure = low[(low >= a) & (high <= b)]
            bar = np.partition(sure, -n)[-n] if len(sure) >= n else a
            out |= (high >= bar) & (low <= b)
        return out

    rows, score = scan(block, anchor["query"], bitmap, alive)
    out = []
    for place, a, b in open_:
        inside = np.flatnonzero((score >= a) & (score <= b))
        for i in inside[_best(block, rows[inside], score[inside], n)]:
            r = rows[i]
            out.append((place, None if block.nulls[r] else int(block.ids[r]), int(block.keys[r]), int(score[i])))
    return out


def _visits(batches: Iterator[pa.RecordBatch], scale: int) -> Iterator[tuple[Block, list[dict]]]:
    """Blocks with their anchors; a block's rows come before its anchors."""
    held: list[pa.RecordBatch] = []
    number, block = None, None
    for batch in batches:
        marks = np.stack([batch.column("block").to_numpy(), batch.column("kind").to_numpy()])
        edges = np.flatnonzero((marks[:, 1:] != marks[:, :-1]).any(axis=0)) + 1
        for start, end in zip(np.r_[0, edges], np.r_[edges, batch.num_rows]):
            part = batch.slice(start, end - start)
            if marks[0, start] != number:
                number, held, block = marks[0, start], [], None
            if marks[1, start] == 0:
                held.append(part)
                continue
            if block is None and held:
                rows = pa.Table.from_batches(held).combine_chunks().to_batches()
                block, held = Block(rows[0], scale), []
            if block is not None:
                anchors = part.select([c for c in part.schema.names if c != "vector"]).to_pylist()
                for anchor, vector in zip(anchors, part.column("vector")):
                    anchor["query"] = whole(vector.values.to_numpy(zero_copy_only=False), scale)
                yield block, anchors


def _clipped(scores: list[int]) -> pa.Array:
    return pa.array([min(max(s, -LONG), LONG - 1) for s in scores], pa.int64())


def _found(batches: Iterator[pa.RecordBatch], scale: int, search: Callable[[Block, dict], list[tuple]]
           ) -> Iterator[pa.RecordBatch]:
    """``(anchor_id, anchor_key, place, id, key, score)`` of one block's anchors at a time."""
    for block, anchors in _visits(batches, scale):
        out = [(a["id"], a["key"], *hit) for a in anchors for hit in search(block, a)]
        columns = list(zip(*out)) or [[]] * 6
        yield pa.record_batch([*(pa.array(c, pa.int64()) for c in columns[:5]), _clipped(columns[5])],
                              ["anchor_id", "anchor_key", "place", "id", "key", "score"])


HITS = "anchor_id long, anchor_key long, place long, id long, key long, score long"


def _visited(rows: DataFrame, anchors: DataFrame, blocks: int) -> DataFrame:
    """Every block followed by all anchors, in its partition."""
    none = F.lit(None).cast("array<long>")
    grid = rows.select("block", F.lit(0).alias("kind"), "id", "key", "label", "vector", none.alias("scores"))
    asked = anchors.select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"),
                           F.lit(1).alias("kind"), "id", "key", "label", "vector", "scores")
    return grid.unionByName(asked).repartition(blocks, "block").sortWithinPartitions("block", "kind")


def hard_negatives(df: DataFrame, anchors: Column, id_column: str = "vec_id", vector: str = "embedding",
                   label: str = "label", positives: int = 5, negatives: int = 3, low_share: int = 50,
                   high_share: int = 95, scale: int = 256, block_cells: int = BLOCK_CELLS) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    ``anchors`` is a condition on ``id`` and ``label``. Negatives of a positive with score ``p`` have scores
    from ``low_share`` to ``high_share`` hundredths of ``p``.
    """
    rows = cut(vectors(df, id_column, vector, label), "vectors")
    size = rows.agg(F.count("*").alias("n"), F.max(F.size("vector")).alias("wide")).first()
    blocks = max(1, -(-size["n"] * max(size["wide"] or 1, 1) // block_cells))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("key", "id"), F.lit(blocks)).cast("int"))
    asking = rows.where(anchors).withColumn("scores", F.lit(None).cast("array<long>"))

    near = _visited(rows, asking, blocks).mapInArrow(
        lambda b: _found(b, scale, lambda block, a: [(0, *hit) for hit in positives_in(block, a, positives)]), HITS)
    own = Window.partitionBy("anchor_id", "anchor_key").orderBy(F.desc("score"), F.asc_nulls_last("id"), "key")
    best = cut(near.withColumn("at", F.row_number().over(own)).where(F.col("at") <= positives), "positives")
    # At most `positives` entries in a list.
    lists = best.groupBy("anchor_id", "anchor_key").agg(F.sort_array(F.collect_list(F.struct("at", "score"))).alias("own"))
    asking = asking.drop("scores").join(
        lists, F.col("id").eqNullSafe(F.col("anchor_id")) & (F.col("key") == F.col("anchor_key"))
    ).withColumn("scores", F.col("own.score"))

    hits = _visited(rows, asking, blocks).mapInArrow(
        lambda b: _found(b, scale, lambda block, a: negatives_in(block, a, negatives, low_share, high_share)), HITS)
    window = Window.partitionBy("anchor_id", "anchor_key", "place").orderBy(F.desc("score"), F.asc_nulls_last("id"), "key")
    hits = hits.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= negatives)
    of = best.select(F.col("anchor_id").alias("a"), F.col("anchor_key").alias("k"), (F.col("at") - 1).alias("p"),
                     F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    return hits.join(of, F.col("anchor_id").eqNullSafe(F.col("a")) & (F.col("anchor_key") == F.col("k"))
                     & (F.col("place") == F.col("p"))).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"))
