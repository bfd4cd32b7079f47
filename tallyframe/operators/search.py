"""Parameter search over several model families by successive halving.

Trials of every family start on a small share of the rows; on each rung the best of them go on with
``keep`` times as many rows and one fold more, the others stop. On a rung of several folds a trial whose
mean so far is below the median of its family stops before the next fold. Rungs are nested and
folds fixed by digests of the keys, so a search is the same under the same seed. All
families share one written table of all labelled rows, or of about ``max_rows`` of them where a caller
asks for a bound; fits and their scores are Spark jobs, several of them side by side.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from statistics import fmean, median

from pyspark.sql import DataFrame, functions as F

from tallyframe.operators import metrics as m
from tallyframe.operators.order import local_rows
from tallyframe.operators.splits import stratified_folds, with_class_weights
from tallyframe.operators.training import ClassModel, sample_params
from tallyframe.sources.tables import scratch_path

#: Rows per file of a fold, so that the tasks of a fit share the rows of a fold.
ROWS_PER_FILE = 20_000
UNIT = 1 << 30


@dataclass(frozen=True)
class Family:
    """A model family: ``fit(rows, params)`` takes ``(y_true, features, weight)``."""

    name: str
    fit: Callable[[DataFrame, dict], ClassModel]
    space: Mapping[str, Sequence]


@dataclass
class _Trial:
    family: Family
    number: int
    params: dict
    values: list[float] = field(default_factory=list)

    @property
    def value(self) -> float:
        return fmean(self.values)


def halving_search(train: DataFrame, key: str, families: Sequence[Family], trials: int = 9, rungs: int = 3,
                   keep: int = 3, folds: int = 3, seed: int = 42, max_rows: int | None = None, parallelism: int = 2
                   ) -> tuple[tuple[str, dict], DataFrame]:
    """((family, parameters) of the best trial, trial table).

    The table has one row per trial and rung: ``(model, trial, rung, rows, folds, value, params, state)`` with
    the mean macro F1; ``state`` is promoted, dropped (not among the best of its rung), pruned (stopped
    between folds) or finished (on the last rung). The best trial is the one with the highest value on the
    last rung, the earlier family and trial on ties.
    """
    spark = train.sparkSession
    n_rows = train.count()
    share = min(1.0, max_rows / max(n_rows, 1)) if max_rows else 1.0
    place = F.pmod(F.xxhash64(F.col(key).cast("string"), F.lit(seed)), F.lit(UNIT)) / F.lit(float(UNIT))
    rows = with_class_weights(train, "y_true").withColumn("__place", place).where(F.col("__place") < share)
    files = max(1, min(spark.sparkContext.defaultParallelism, int(n_rows * share) // (folds * ROWS_PER_FILE)))
    path = scratch_path(spark, "search")
    stratified_folds(rows, key, "y_true", folds, seed).select(
        "y_true", "features", "weight", "fold", "__place").repartition(
        files * folds, "fold", F.floor(F.col("__place") * UNIT).cast("long") % files).write.partitionBy("fold").parquet(path)
    table = spark.read.parquet(path).persist()
    alive = [_Trial(f, i, p) for f in families for i, p in enumerate(sample_params(f.space, trials, seed))]
    out: list[tuple] = []
    try:
        for rung in range(rungs):
            last = rung == rungs - 1
            own = table.where(F.col("__place") < share / keep ** (rungs - 1 - rung))
            size, used = own.count(), folds if last else min(folds, rung + 1)
            running = list(alive)
            for trial in alive:
                trial.values = []
            for fold in range(used):
                with ThreadPoolExecutor(parallelism) as pool:  # only the driver's calls; Spark runs the fits
                    found = list(pool.map(lambda t, f=fold: _value(own, t, f), running))
                for trial, value in zip(running, found):
                    trial.values.append(value)
                if fold + 1 < used:
                    bar = {f.name: median(t.value for t in running if t.family is f) for f in families
                           if any(t.family is f for t in running)}
                    running = [t for t in running if t.value >= bar[t.family.name]]
            promoted = []
            for f in families:
                of_family = sorted((t for t in running if t.family is f), key=lambda t: (-t.value, t.number))
                promoted += of_family[:max(1, -(-sum(t.family is f for t in alive) // keep))]
            for t in alive:
                state = ("pruned" if t not in running else "finished" if last
                         else "promoted" if t in promoted else "dropped")
                out.append((t.family.name, t.number, rung, size, len(t.values), float(t.value),
                            json.dumps(t.params, sort_keys=True), state))
            alive = running if last else promoted
    finally:
        table.unpersist()
    best = max(alive, key=lambda t: (t.value, -list(families).index(t.family), -t.number))
    kinds = {"model": "string", "trial": "bigint", "rung": "bigint", "rows": "bigint", "folds": "bigint",
             "value": "double", "params": "string", "state": "string"}
    return (best.family.name, best.params), local_rows(spark, out, kinds)


def _value(rows: DataFrame, trial: _Trial, fold: int) -> float:
    """Macro F1 on one fold of a fit on the others; 0 where either side is empty."""
    learn, test = rows.where(F.col("fold") != fold), rows.where(F.col("fold") == fold)
    if learn.isEmpty() or test.isEmpty():
        return 0.0
    model = trial.family.fit(learn.select("y_true", "features", "weight"), trial.params)
    row = m.label_counts(m.with_prediction(model.add_probs(test.select("y_true", "features")))).select(
        F.expr(m.metric_sql()["f1_macro"])).first()
    return float(row[0] or 0.0)
