"""Random forest on a binned table: all trees grow together, one aggregate per level.

Rows become the blocks of ``boosting``, one byte per cell. On a level every task walks its rows down to their nodes,
draws their bags again from seeds, and counts classes per tree, node, feature and step, over the features drawn for
the node. Counts are whole numbers, so they do not depend on the order of the tasks; those of all tasks meet by tree
and node range, where the best step of every node is found. A task holds its cells and the counts of one tree. What
reaches the driver is one candidate per open node, whatever the number of rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyframe.operators.boosting import BLOCKS, NO_SPLIT, _held, _packed, cells_of, cut_steps, node_of
from tallyframe.sources.tables import scratch_path

BINS, ROWS_PER_TASK, CHUNK_ROWS, NODES_PER_ROW = 32, 5_000, 262_144, 256
#: Bytes of counts that one merging task is meant to get, at two bytes a count.
MERGE_BYTES = 64 << 20
COUNTS = "tree int, part int, size int, counts binary"
COUNT_NAMES = [c.split()[0] for c in COUNTS.split(", ")]
#: Copies of a row in a bag by a random 16-bit number: Poisson with mean one, as a sample with replacement.
BAG = np.searchsorted(np.cumsum([math.exp(-1) / math.factorial(i) for i in range(12)]),
                      (np.arange(1 << 16) + 0.5) / (1 << 16)).astype(np.uint8)


@dataclass
class Forest:
    """A fitted model: trees as full binary heaps; a node without a split sends all rows to the left."""

    cuts: list[list[float]]
    feature: np.ndarray  # (trees, nodes)
    step: np.ndarray
    leaf: np.ndarray  # (trees, leaves, classes): shares
    gains: np.ndarray  # (trees, features)

    @property
    def featureImportances(self) -> np.ndarray:  # noqa: N802  as on MLlib's tree models
        own = self.gains.sum(axis=1, keepdims=True)
        shares = np.divide(self.gains, own, out=np.zeros_like(self.gains), where=own > 0).sum(axis=0)
        return shares / shares.sum() if shares.sum() else shares

    def probs(self, cells: np.ndarray) -> np.ndarray:
        """(rows, classes): the mean of the shares in the leaves that the rows come to."""
        out = np.zeros((cells.shape[1], self.leaf.shape[2]))
        for feature, step, leaf in zip(self.feature, self.step, self.leaf):
            out += leaf[node_of(cells, feature, step)]
        return out / len(self.leaf)

    def add_probs(self, df: DataFrame, out: str = "probs") -> DataFrame:
        cuts, probs = self.cuts, self.probs

        @F.pandas_udf("array<double>")
        def scored(rows: pd.Series) -> pd.Series:
            values = np.stack(rows.to_numpy()) if len(rows) else np.zeros((0, len(cuts)))
            return pd.Series(list(probs(cells_of(values, cuts))))

        return df.select(*df.columns, scored(vector_to_array("features")).alias(out))

    def save(self, spark: SparkSession, path: str) -> None:
        """A row per tree and one with number -1 for the cut points."""
        cuts = [np.array([len(c) for c in self.cuts], "<i4").tobytes(), np.array([x for c in self.cuts for x in c], "<f8")
                .tobytes(), np.array(self.leaf.shape, "<i4").tobytes(), b""]
        trees = [[a.astype(kind).tobytes() for a, kind in zip(tree, ("<i4", "<i4", "<f8", "<f8"))]
                 for tree in zip(self.feature, self.step, self.leaf, self.gains)]
        columns = [pa.array(range(-1, len(trees)), pa.int32()), *[pa.array(c, pa.binary()) for c in zip(cuts, *trees)]]
        spark.createDataFrame(pa.table(columns, ["tree", "feature", "step", "leaf", "gains"])).coalesce(1).write.mode(
            "overwrite").parquet(path)

    @classmethod
    def load(cls, path: str) -> Forest:
        head, *rows = sorted(SparkSession.active().read.parquet(path).collect(), key=lambda r: r["tree"])
        sizes, values = np.frombuffer(head["feature"], "<i4"), np.frombuffer(head["step"], "<f8")
        shape = np.frombuffer(head["leaf"], "<i4")
        cuts = [c.tolist() for c in np.split(values, np.cumsum(sizes)[:-1])] if len(sizes) else []
        return cls(cuts, np.stack([np.frombuffer(r["feature"], "<i4") for r in rows]),
                   np.stack([np.frombuffer(r["step"], "<i4") for r in rows]),
                   np.stack([np.frombuffer(r["leaf"], "<f8").reshape(shape[1:]) for r in rows]),
                   np.stack([np.frombuffer(r["gains"], "<f8") for r in rows]))


# -- one level ----------------------------------------------------------------

@dataclass
class _Level:
    """What a task has to know: the trees down to this level and the open nodes, numbered per tree."""

    feature: np.ndarray
    step: np.ndarray
    open: list[np.ndarray]
    level: int
    seed: int
    width: int
    drawn: int
    bins: int
    weights: list[float]
    min_rows: int
    per_row: int

    def features_of(self, tree: int) -> np.ndarray:
        """(open nodes, drawn) features each node may split on."""
        order = np.random.default_rng((self.seed, tree, self.level)).random((len(self.open[tree]), self.width))
        return np.argsort(order, axis=1)[:, :self.drawn]

    def counts(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Per tree and range of open nodes the task's (node, drawn, step, class) counts."""
        chunks = list(_chunks(batches))
        for tree, nodes in enumerate(self.open):
            if not len(nodes):
                continue
            number = np.full(1 << self.level, -1, np.int64)
            number[nodes] = np.arange(len(nodes))
            features, classes, total = self.features_of(tree), len(self.weights), 0
            for cells, label, blocks in chunks:
                bag = BAG[np.concatenate([np.random.default_rng((self.seed, block, tree)).integers(
                    0, 1 << 16, n, np.uint16) for block, n in blocks])]
                rows = np.flatnonzero(bag)
                at = number[_walk(cells, rows, self.feature[tree], self.step[tree], self.level)]
                rows, at = rows[at >= 0], at[at >= 0]
                copies, own = bag[rows].astype(np.float64), label[rows].astype(np.int64)
                for slot in range(self.drawn):
                    value = cells[features[at, slot], rows]
                    place = ((at * self.drawn + slot) * self.bins + value) * classes + own
                    total = total + np.bincount(place, copies, features.size * self.bins * classes)
            if isinstance(total, int):
                continue
            whole = total.reshape(len(nodes), -1)
            for first in range(0, len(nodes), self.per_row):
                part = whole[first:first + self.per_row]
                if not part.any():
                    continue
                kind = next(k for k in ("<u1", "<u2", "<u4", "<u8") if part.max() <= np.iinfo(k).max)
                yield pa.record_batch([pa.array([tree], pa.int32()), pa.array([first // self.per_row], pa.int32()), pa.array(
                    [int(kind[2])], pa.int32()), pa.array([part.astype(kind).tobytes()], pa.binary())], COUNT_NAMES)

    def best(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Counts of all tasks by tree and node range; per node gain, feature, step and both sides' counts."""
        key, held = None, None

        def found() -> pa.RecordBatch:
            tree, part = key
            features = self.features_of(tree)[part * self.per_row:(part + 1) * self.per_row]
            answer = best_splits(held.reshape(*features.shape, self.bins, len(self.weights)), features, self.weights, self.min_rows)
            return pa.record_batch([pa.array([tree], pa.int32()), pa.array([part], pa.int32()), pa.array([8], pa.int32()),
                                    pa.array([answer.tobytes()], pa.binary())], COUNT_NAMES)

        for batch in batches:
            for tree, part, size, data in zip(*(batch.column(i).to_pylist() for i in range(3)), batch.column(3)):
                values = np.frombuffer(data.as_buffer(), f"<u{size}")
                if (tree, part) != key:
                    if key is not None:
                        yield found()
                    key, held = (tree, part), values.astype(np.int64)
                else:
                    held += values.astype(np.int64)
        if key is not None:
            yield found()


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, list[tuple[int, int]]]]:
    """Blocks of a task side by side: cells, labels, and number and size of each block."""
    held, rows = [], 0

    def joined() -> tuple:
        return (np.concatenate([np.frombuffer(b["cells"], np.uint8).reshape(-1, b["n"]) for b in held], axis=1),
                np.concatenate([np.frombuffer(b["label"], np.uint8) for b in held]), [(b["number"], b["n"]) for b in held])

    for batch in batches:
        for block in batch.select(["number", "n", "cells", "label"]).to_pylist():
            held.append(block)
            rows += block["n"]
            if rows >= CHUNK_ROWS:
                yield joined()
                held, rows = [], 0
    if held:
        yield joined()


def _walk(cells: np.ndarray, rows: np.ndarray, feature: np.ndarray, step: np.ndarray, levels: int) -> np.ndarray:
    """The node that each of some rows has come to after some levels."""
    node = np.zeros(len(rows), np.int64)
    for level in range(levels):
        at = node + (1 << level) - 1
        node = 2 * node + (cells[feature[at], rows] > step[at])
    return node


def best_splits(counts: np.ndarray, features: np.ndarray, weights: Sequence[float], min_rows: int) -> np.ndarray:
    """(nodes, 3 + 2 * classes): gain, feature, step, then counts to the left and in all.

    The gain is the drop of weighted Gini impurity times the node's weight; -inf where no step leaves ``min_rows``
    on both sides.
    """
    left = counts.cumsum(axis=2)
    whole = left[:, :, -1:]
    right, w = whole - left, np.asarray(weights)

    def impure(x: np.ndarray) -> np.ndarray:
        mass = (x * w).sum(axis=-1)
        return mass - np.divide(((x * w) ** 2).sum(axis=-1), mass, out=np.zeros_like(mass), where=mass > 0)

    gain = impure(whole) - impure(left) - impure(right)
    gain[(left.sum(axis=-1) < min_rows) | (right.sum(axis=-1) < min_rows)] = -np.inf
    flat = gain.reshape(len(counts), -1)
    at = flat.argmax(axis=1)
    nodes, slot, step = np.arange(len(counts)), at // counts.shape[2], at % counts.shape[2]
    return np.concatenate([np.stack([flat[nodes, at], features[nodes, slot], step], axis=1), left[nodes, slot, step],
                           whole[:, 0, 0]], axis=1).astype("<f8")


def fit_forest(train: DataFrame, weights: Sequence[float], trees: int, depth: int, min_rows: int, seed: int,
               bins: int = BINS) -> Forest:
    """``train (y_true, features)``; ``weights`` per class, class numbers are 0, 1, ...

    Every node splits on the best of as many drawn features as the root of their number, rounded up. Bags
    hang on the rows of a block, which are those of the partitioning of ``train``.
    """
    spark, path = train.sparkSession, scratch_path(train.sparkSession, "forest")
    rows = train.select(F.col("y_true").alias("y"), vector_to_array("features").alias("x"), F.lit(1.0).alias("w"),
                        F.lit(False).alias("valid"))
    n_rows, classes = rows.count(), len(weights)
    cuts = cut_steps(rows, n_rows, bins)
    width, parallel = len(cuts), spark.sparkContext.defaultParallelism
    tasks = max(1, min(parallel, n_rows // ROWS_PER_TASK), n_rows // 1_000_000)
    rows.repartition(tasks).mapInArrow(lambda b: _packed(b, cuts, 0), BLOCKS).write.parquet(f"{path}/0")
    held = _held(spark, f"{path}/0", tasks)
    feature = np.zeros((trees, (1 << depth) - 1), np.int32)
    step = np.full(feature.shape, NO_SPLIT, np.int32)
    leaf, gains = np.full((trees, 1 << depth, classes), 1.0 / classes), np.zeros((trees, width))
    opened = [np.zeros(1, np.int64) if width and n_rows else np.zeros(0, np.int64) for _ in range(trees)]
    drawn, w = math.ceil(math.sqrt(width)), np.asarray(weights)
    try:
        for level in range(depth):
            if not any(map(len, opened)):
                break
            job = _Level(feature[:, :(1 << level) - 1], step[:, :(1 << level) - 1], opened, level, seed, width, drawn, bins,
                         list(weights), min_rows, NODES_PER_ROW)
            counts = held.mapInArrow(job.counts, COUNTS)
            if tasks > 1:  # the counts of one task need no exchange
                size = 2 * tasks * sum(map(len, opened)) * drawn * bins * classes
                counts = counts.repartition(max(parallel, -(-size // MERGE_BYTES)), "tree", "part").sortWithinPartitions("tree", "part")
            answer = {(r["tree"], r["part"]): np.frombuffer(r["counts"], "<f8").reshape(-1, 3 + 2 * classes)
                      for r in counts.mapInArrow(job.best, COUNTS).collect()}
            for tree, nodes in enumerate(opened):
                opened[tree] = _grow(answer, tree, nodes, level, depth, min_rows, w, feature[tree], step[tree], leaf[tree], gains[tree])
    finally:
        held.unpersist()
    return Forest(cuts, feature, step, leaf, gains)


def _grow(answer: dict[tuple[int, int], np.ndarray], tree: int, nodes: np.ndarray, level: int, depth: int, min_rows: int,
          weights: np.ndarray, feature: np.ndarray, step: np.ndarray, leaf: np.ndarray, gains: np.ndarray) -> np.ndarray:
    """Write the splits of a level into a tree, and the leaves that end there; the nodes open on the next level."""
    classes, found = len(weights), [(nodes[part * NODES_PER_ROW:(part + 1) * NODES_PER_ROW], answer[tree, part])
                                    for part in range(-(-len(nodes) // NODES_PER_ROW)) if (tree, part) in answer]
    if not found:  # no row of the bag came here
        return np.zeros(0, np.int64)
    nodes, table = np.concatenate([n for n, _ in found]), np.concatenate([t for _, t in found])
    left, whole = table[:, 3:3 + classes], table[:, 3 + classes:]
    split = table[:, 0] > 1e-12
    _end(leaf, nodes[~split] << (depth - level), whole[~split] * weights)
    nodes, table, left, whole = nodes[split], table[split], left[split], whole[split]
    at = (1 << level) - 1 + nodes
    feature[at], step[at] = table[:, 1].astype(int), table[:, 2].astype(int)
    np.add.at(gains, feature[at], table[:, 0])
    child = np.stack([2 * nodes, 2 * nodes + 1], axis=1).ravel()
    own = np.stack([left, whole - left], axis=1).reshape(-1, classes)
    more = (own.sum(axis=1) >= 2 * min_rows) & (np.count_nonzero(own, axis=1) > 1) & (level + 1 < depth)
    _end(leaf, child[~more] << (depth - level - 1), own[~more] * weights)
    return child[more]


def _end(leaf: np.ndarray, at: np.ndarray, mass: np.ndarray) -> None:
    total = mass.sum(axis=1)
    leaf[at[total > 0]] = mass[total > 0] / total[total > 0, None]
