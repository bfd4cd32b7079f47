"""Multiclass boosting on a binned table: one tree per class and round, one aggregate per level.

Features are cut into at most ``bins`` steps at quantiles of a sample, once. Rows become blocks of one
byte per cell with label, weight and the margins of the last snapshot, and are written as a table.
A level is one Spark job: each task brings its blocks' margins up to date with the trees grown since the
snapshot, sums gradients and curvatures of its rows per class, node, feature and step, and hands one
row per feature on; the sums of all tasks meet by feature, where the best step of every node is
found. What reaches the driver is one candidate per class, node and feature, whatever the number
of rows. The loss on validation rows comes out of the same jobs, so patience is checked inside the loop and
no round is grown twice. Every ``snapshot`` rounds the margins are written anew; a lost executor
costs the tasks of one level.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyframe.functions.columns import finite
from tallyframe.operators.order import local_rows
from tallyframe.sources.tables import scratch_path

BINS, BLOCK_ROWS, SNAPSHOT, SAMPLE_ROWS, ROWS_PER_TASK = 64, 32_768, 20, 200_000, 50_000
NO_SPLIT = 255


@dataclass
class Trees:
    """Trees of some rounds as full binary heaps; a node without a split sends all rows to the left."""

    feature: np.ndarray  # (rounds, classes, nodes)
    step: np.ndarray
    leaf: np.ndarray  # (rounds, classes, leaves)

    @staticmethod
    def none(classes: int, depth: int) -> Trees:
        inner = (0, classes, (1 << depth) - 1)
        return Trees(np.zeros(inner, np.int32), np.full(inner, NO_SPLIT, np.int32), np.zeros((0, classes, 1 << depth)))

    def with_round(self, feature: np.ndarray, step: np.ndarray, leaf: np.ndarray) -> Trees:
        return Trees(np.concatenate([self.feature, feature[None]]), np.concatenate([self.step, step[None]]),
                     np.concatenate([self.leaf, leaf[None]]))

    def first(self, rounds: int) -> Trees:
        return Trees(self.feature[:rounds], self.step[:rounds], self.leaf[:rounds])

    def margins(self, cells: np.ndarray) -> np.ndarray:
        """(rows, classes) sums of leaves for ``cells`` (features, rows)."""
        out = np.zeros((cells.shape[1], self.leaf.shape[1]))
        for feature, step, leaf in zip(self.feature, self.step, self.leaf):
            for k in range(len(leaf)):
                out[:, k] += leaf[k][node_of(cells, feature[k], step[k])]
        return out


def node_of(cells: np.ndarray, feature: np.ndarray, step: np.ndarray, levels: int | None = None) -> np.ndarray:
    """The node each row has come to after some levels of one tree."""
    levels = int(np.log2(len(feature) + 1)) if levels is None else levels
    rows, node = np.arange(cells.shape[1]), np.zeros(cells.shape[1], np.int64)
    for level in range(levels):
        at = node + (1 << level) - 1
        node = 2 * node + (cells[feature[at], rows] > step[at])
    return node


def cells_of(values: np.ndarray, cuts: list[list[float]]) -> np.ndarray:
    """Numbers of steps, (features, rows): values up to the first cut are in step 0."""
    out = [np.searchsorted(c, values[:, j], "left") for j, c in enumerate(cuts)]
    return np.stack(out).astype(np.uint8) if out else np.zeros((0, len(values)), np.uint8)


def softmax(margins: np.ndarray) -> np.ndarray:
    e = np.exp(margins - margins.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


@dataclass
class BoostedTrees:
    """A fitted model: cut points, trees, and the gain each feature has brought."""

    cuts: list[list[float]]
    trees: Trees
    gains: list[float]
    losses: list[float]

    @property
    def featureImportances(self) -> np.ndarray:  # noqa: N802  as on MLlib's tree models
        total = sum(self.gains)
        return np.array(self.gains) / total if total else np.array(self.gains)

    def add_probs(self, df: DataFrame, out: str = "probs") -> DataFrame:
        cuts, trees = self.cuts, self.trees

        @F.pandas_udf("array<double>")
        def scored(rows: pd.Series) -> pd.Series:
            values = np.stack(rows.to_numpy()) if len(rows) else np.zeros((0, len(cuts)))
            return pd.Series(list(softmax(trees.margins(cells_of(values, cuts)))))

        return df.select(*df.columns, scored(vector_to_array("features")).alias(out))

    def save(self, spark: SparkSession, path: str) -> None:
        t = self.trees
        text = json.dumps({"cuts": self.cuts, "feature": t.feature.tolist(), "step": t.step.tolist(),
                           "leaf": t.leaf.tolist(), "shape": t.leaf.shape, "gains": self.gains, "losses": self.losses})
        local_rows(spark, [(text,)], {"value": "string"}).coalesce(1).write.mode("overwrite").text(path)

    @classmethod
    def load(cls, path: str) -> BoostedTrees:
        d = json.loads(SparkSession.active().read.text(path).first()["value"])
        rounds, classes, leaves = d["shape"]
        inner = (rounds, classes, leaves - 1)
        return cls(d["cuts"], Trees(np.array(d["feature"], np.int32).reshape(inner), np.array(d["step"], np.int32)
                                    .reshape(inner), np.array(d["leaf"]).reshape(d["shape"])), d["gains"], d["losses"])


# -- the binned table ---------------------------------------------------------

def cut_steps(rows: DataFrame, n_rows: int, bins: int) -> list[list[float]]:
    """Cut points of every feature: quantiles of about ``SAMPLE_ROWS`` rows, without repeats."""
    part = min(1.0, SAMPLE_ROWS / max(n_rows, 1))
    shares = [i / bins for i in range(1, bins)]
    width = rows.agg(F.max(F.size("x"))).first()[0] or 0
    if not width:
        return []
    sampled = rows.sample(part, 42) if part < 1 else rows
    row = sampled.agg(*[F.percentile_approx(finite(F.get("x", F.lit(j))), shares, 20 * bins).alias(f"q{j}")
                        for j in range(width)]).first()
    return [sorted(set(row[f"q{j}"] or [])) for j in range(width)]


def _packed(batches: Iterator[pa.RecordBatch], cuts: list[list[float]], classes: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        valid = batch.column("valid").to_numpy(zero_copy_only=False)
        for kind in (False, True):
            rows = batch.filter(pa.array(valid == kind))
            for at in range(0, rows.num_rows, BLOCK_ROWS):
                part = rows.slice(at, BLOCK_ROWS)
                n = part.num_rows
                values = part.column("x").flatten().to_numpy(zero_copy_only=False).reshape(n, len(cuts))
                label = part.column("y").to_numpy().astype(np.uint8)
                number = zlib.crc32(label.tobytes() + values[:1].tobytes(), at)  # the same in every run
                yield pa.record_batch([pa.array([x]) for x in (
                    number, bool(kind), n, cells_of(values, cuts).tobytes(), label.tobytes(),
                    part.column("w").to_numpy().astype("<f8").tobytes(), np.zeros((n, classes)).tobytes())], BLOCK_NAMES)


BLOCKS = "number long, valid boolean, n long, cells binary, label binary, weight binary, margins binary"
BLOCK_NAMES = [c.split()[0] for c in BLOCKS.split(", ")]


@dataclass
class _Block:
    number: int
    valid: bool
    cells: np.ndarray
    label: np.ndarray
    weight: np.ndarray
    margins: np.ndarray


def _blocks(batch: pa.RecordBatch, classes: int) -> Iterator[_Block]:
    for row in batch.to_pylist():
        n = row["n"]
        yield _Block(row["number"], row["valid"], np.frombuffer(row["cells"], np.uint8).reshape(-1, n),
                     np.frombuffer(row["label"], np.uint8), np.frombuffer(row["weight"], "<f8"),
                     np.frombuffer(row["margins"], "<f8").reshape(n, classes))


# -- one level ----------------------------------------------------------------

@dataclass
class _Level:
    """What a task has to know: trees since the snapshot, the trees of this round so far."""

    trees: Trees
    feature: np.ndarray
    step: np.ndarray
    level: int
    turn: int
    seed: int
    subsample: float
    bins: int

    def sums(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One row per feature with the task's (class, node, step, 2) sums; feature -1 is the loss."""
        classes, nodes, total, loss = len(self.feature), 1 << self.level, None, np.zeros(2)
        for batch in batches:
            for block in _blocks(batch, classes):
                margins = block.margins + self.trees.margins(block.cells)
                chance = softmax(margins)
                own = chance[np.arange(len(chance)), block.label]
                if block.valid:
                    loss += -np.log(np.maximum(own, 1e-300)).sum(), len(own)
                    continue
                draw = np.random.default_rng((self.seed, block.number, self.turn)).random(len(own)) < self.subsample
                cells, weight = block.cells[:, draw], block.weight[draw, None]
                hit = np.eye(classes)[block.label[draw]]
                slope = weight * (chance[draw] - hit)
                bend = np.maximum(2 * weight * chance[draw] * (1 - chance[draw]), 1e-16)
                if total is None:
                    total = np.zeros((len(cells), classes, nodes * self.bins, 2))
                for k in range(classes):
                    at = node_of(cells, self.feature[k], self.step[k], self.level) * self.bins
                    for j, column in enumerate(cells):
                        place = at + column
                        total[j, k, :, 0] += np.bincount(place, slope[:, k], nodes * self.bins)
                        total[j, k, :, 1] += np.bincount(place, bend[:, k], nodes * self.bins)
        numbers, packed = [-1], [loss.tobytes()]
        if total is not None:
            numbers += range(len(total))
            packed += [t.tobytes() for t in total]
        yield pa.record_batch([pa.array(numbers, pa.int32()), pa.array(packed, pa.binary())], ["feature", "sums"])

    def best(self, batches: Iterator[pa.RecordBatch], penalty: float, least: float) -> Iterator[pa.RecordBatch]:
        """Sums of all tasks by feature; per class and node gain, step, and sums to the left and in all."""
        shape, feature, held = (len(self.feature), 1 << self.level, self.bins, 2), None, None

        def found() -> pa.RecordBatch:
            answer = held if feature < 0 else best_steps(held.reshape(shape), penalty, least)
            return pa.record_batch([pa.array([feature], pa.int32()), pa.array([answer.tobytes()], pa.binary())],
                                   ["feature", "sums"])

        for batch in batches:
            for number, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                values = np.frombuffer(data.as_buffer(), "<f8")
                if number != feature:
                    if feature is not None:
                        yield found()
                    feature, held = number, values.copy()
                else:
                    held += values
        if feature is not None:
            yield found()

    def grown(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The blocks with up-to-date margins."""
        for batch in batches:
            new = [(b.margins + self.trees.margins(b.cells)).tobytes() for b in _blocks(batch, len(self.feature))]
            yield batch.set_column(6, "margins", pa.array(new, pa.binary()))


def best_steps(sums: np.ndarray, penalty: float, least: float) -> np.ndarray:
    """(classes, nodes, 6): gain, step, slope and bend to the left, slope and bend in all."""
    left, whole = sums.cumsum(axis=2), sums.sum(axis=2)[:, :, None]
    right = whole - left

    def worth(x: np.ndarray) -> np.ndarray:
        return x[..., 0] ** 2 / (x[..., 1] + penalty)

    gain = worth(left) + worth(right) - worth(whole)
    gain[(left[..., 1] < least) | (right[..., 1] < least)] = -np.inf
    step = gain.argmax(axis=2)
    at = (*np.indices(step.shape), step)
    return np.concatenate([gain[at][..., None], step[..., None], left[at], whole[:, :, 0]], axis=2)


def fit_boosted(train: DataFrame, valid: DataFrame | None, classes: int, rounds: int, depth: int, rate: float,
                subsample: float, seed: int, patience: int, bins: int = BINS, penalty: float = 1.0,
                least: float = 1.0, snapshot: int = SNAPSHOT) -> BoostedTrees:
    """``train (y_true, features, weight)``; ``valid`` rows decide how many rounds are kept.

    Growing stops when the loss on ``valid`` has not improved for ``patience`` rounds; the rounds up to
    the best one are kept. Without ``valid`` all rounds are.
    """
    spark, path = train.sparkSession, scratch_path(train.sparkSession, "boosting")
    narrow = [F.col("y_true").alias("y"), vector_to_array("features").alias("x")]
    rows = train.select(*narrow, F.col("weight").alias("w"), F.lit(False).alias("valid"))
    n_rows = rows.count()
    cuts = cut_steps(rows, n_rows, bins)
    both = rows if valid is None else rows.unionByName(valid.select(*narrow, F.lit(1.0).alias("w"), F.lit(True).alias("valid")))
    tasks = max(1, min(spark.sparkContext.defaultParallelism, n_rows // ROWS_PER_TASK))
    tasks = max(tasks, n_rows // 1_000_000)
    both.repartition(tasks).mapInArrow(lambda b: _packed(b, cuts, classes), BLOCKS).write.parquet(f"{path}/0")
    held = _held(spark, f"{path}/0", tasks)
    trees, since = Trees.none(classes, depth), Trees.none(classes, depth)
    gains, losses, best = np.zeros(len(cuts)), [], 0
    merging = max(1, min(spark.sparkContext.defaultParallelism, len(cuts) // 8))
    try:
        for turn in range(rounds + 1):
            feature, step = np.zeros((classes, (1 << depth) - 1), np.int32), np.full((classes, (1 << depth) - 1), NO_SPLIT, np.int32)
            leaf = np.zeros((classes, 1 << depth))
            for level in range(depth):
                job = _Level(since, feature, step, level, turn, seed, subsample, bins)
                sums = held.mapInArrow(job.sums, "feature int, sums binary")
                if tasks > 1:  # the sums of one task need no exchange
                    sums = sums.repartition(merging, "feature")
                answer = {r["feature"]: np.frombuffer(r["sums"], "<f8") for r in sums.sortWithinPartitions("feature")
                          .mapInArrow(lambda b, j=job: j.best(b, penalty, least), "feature int, sums binary").collect()}
                if level == 0 and valid is not None:
                    loss, n = answer[-1]
                    losses.append(float(loss / max(n, 1)))
                    best = turn if losses[-1] < losses[best] else best
                if level == 0 and (turn == rounds or turn - best >= patience and valid is not None):
                    break
                _choose(answer, level, depth, rate, penalty, feature, step, leaf, gains, len(cuts))
            else:
                trees, since = trees.with_round(feature, step, leaf), since.with_round(feature, step, leaf)
                if len(since.leaf) == snapshot and turn + 1 < rounds:
                    held, since = _snapshot(spark, held, since, f"{path}/{turn + 1}", classes, depth, tasks)
                if turn + 1 < rounds or valid is not None:
                    continue
            break
    finally:
        held.unpersist()
    kept = trees.first(best) if valid is not None else trees
    return BoostedTrees(cuts, kept, gains.tolist(), losses)


def _choose(answer: dict[int, np.ndarray], level: int, depth: int, rate: float, penalty: float, feature: np.ndarray,
            step: np.ndarray, leaf: np.ndarray, gains: np.ndarray, width: int) -> None:
    """Write the best split of every node of a level into the trees, on the last one also the leaves."""
    nodes, classes = 1 << level, len(feature)
    if 0 not in answer:
        return
    table = np.stack([answer[j].reshape(classes, nodes, 6) for j in range(width)])
    for k in range(classes):
        for node in range(nodes):
            j = int(table[:, k, node, 0].argmax())
            gain, at, ls, lb, s, b = table[j, k, node]
            split = gain > 1e-12
            if split:
                feature[k, nodes - 1 + node], step[k, nodes - 1 + node] = j, int(at)
                gains[j] += gain
            if level == depth - 1:
                leaf[k, 2 * node] = -rate * (ls / (lb + penalty) if split else s / (b + penalty))
                leaf[k, 2 * node + 1] = -rate * (s - ls) / (b - lb + penalty) if split else 0.0


def _snapshot(spark: SparkSession, held: DataFrame, since: Trees, path: str, classes: int, depth: int,
              tasks: int) -> tuple[DataFrame, Trees]:
    blank = np.zeros((classes, (1 << depth) - 1), np.int32)
    job = _Level(since, blank, blank, 0, 0, 0, 1.0, 1)
    held.mapInArrow(job.grown, BLOCKS).write.parquet(path)
    held.unpersist()
    return _held(spark, path, tasks), Trees.none(classes, depth)


def _held(spark: SparkSession, path: str, tasks: int) -> DataFrame:
    """The blocks, kept in memory as far as it goes; lost parts are read again."""
    blocks = spark.read.parquet(path)
    return (blocks.coalesce(1) if tasks == 1 else blocks).persist()
