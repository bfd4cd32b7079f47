"""Running monitors as Structured Streaming queries, and the state they keep."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor

from tallyframe.operators.drift import DriftReference, psi_by_window, psi_status
from tallyframe.operators.training import batch_score, load_bundle
from tallyframe.sources.registry import RegistryStore
from tallyframe.sources.tables import scratch_path
from tallyframe.streaming.monitors import TICK_SECONDS, event_time

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def rocksdb_state(spark: SparkSession):
    """The store that stateful processors need, for the queries started inside."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def read_stream(spark: SparkSession, folder: str, name: str = "*.parquet", schema=None) -> DataFrame:
    """Parquet files of a folder as a stream; the schema is that of the files there."""
    if schema is None:
        schema = spark.read.option("pathGlobFilter", name).parquet(folder).schema
    return spark.readStream.schema(schema).option("pathGlobFilter", name).parquet(folder)


def run_append(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Process what is available and return the table the stream appended to."""
    spark = df.sparkSession
    path = path or scratch_path(spark, name)
    query = (df.writeStream.outputMode("append").format("parquet")
             .option("checkpointLocation", f"{path}-checkpoint")
             .trigger(availableNow=True).start(path))
    query.awaitTermination()
    return spark.read.schema(df.schema).parquet(path)


def save_slot(df: DataFrame, path: str, number: int) -> None:
    """Write the table of a batch over that of the last but one.

    A batch that is repeated after a failure finds the table before it untouched, and what
    is kept does not grow with the number of batches.
    """
    df.withColumn("__batch", F.lit(number)).write.mode("overwrite").parquet(f"{path}/slot={number % 2}")


def newest_slot(spark: SparkSession, path: str) -> DataFrame:
    """The table of the latest batch, found from the files alone."""
    both = spark.read.parquet(path)
    latest = both.agg(F.max("__batch")).first()[0]
    return both.where(F.col("__batch") == latest).drop("__batch", "slot")


def run_complete(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Same for running totals: the table of the newest batch replaces the others."""
    spark = df.sparkSession
    path = path or scratch_path(spark, name)
    run_batches(df, lambda batch, number: save_slot(batch, path, number), path, "complete")
    return newest_slot(spark, path)


def run_batches(df: DataFrame, save: Callable[[DataFrame, int], None], path: str,
                mode: str = "append") -> None:
    query = (df.writeStream.outputMode(mode).foreachBatch(save)
             .option("checkpointLocation", f"{path}-checkpoint").trigger(availableNow=True).start())
    query.awaitTermination()


# -- last N requests ----------------------------------------------------------

class LastN:
    """Keeps the last n requests and the totals over a stream.

    Each batch is cut to its own last n before it meets the kept ones, so whatever the
    traffic only 2n rows are merged. State lies in two slots that batches write in turn: a
    repeated batch starts again from the state before it, also in a new process.
    """

    def __init__(self, spark: SparkSession, n: int, latency: str, is_error: str,
                 order: tuple[str, ...], path: str | None = None):
        self.spark, self.n, self.latency, self.is_error = spark, n, latency, is_error
        self.order, self.path = order, path or scratch_path(spark, "last_n")

    def _previous(self, number: int, kind: str) -> DataFrame | None:
        if number == 0:
            return None
        before = self.spark.read.parquet(f"{self.path}/{kind}/slot={(number - 1) % 2}")
        return before.where(F.col("__batch") == number - 1).drop("__batch")

    def save(self, batch: DataFrame, number: int) -> None:
        newest = [F.desc(c) for c in self.order]
        last = batch.orderBy(*newest).limit(self.n).select(*self.order, self.latency)
        totals = batch.agg(F.count("*").alias("request_count"),
                           F.expr(f"count_if({self.is_error})").alias("error_count"))
        kept, before = self._previous(number, "last"), self._previous(number, "totals")
        if kept is not None:
            last = last.unionByName(kept).orderBy(*newest).limit(self.n)
            totals = totals.unionByName(before).agg(
                F.sum("request_count").alias("request_count"),
                F.sum("error_count").alias("error_count"))
        save_slot(last, f"{self.path}/last", number)
        save_slot(totals, f"{self.path}/totals", number)

    def tables(self) -> tuple[DataFrame, DataFrame]:
        return newest_slot(self.spark, f"{self.path}/last"), newest_slot(self.spark, f"{self.path}/totals")


# -- alerts held over time ----------------------------------------------------

class AlertHold(StatefulProcessor):
    """Pending until the breach lasted the hold time without a missing tick, then firing.

    Input per series are window results, one row per tick, so the state is two numbers and
    a batch holds few rows whatever the traffic.
    """

    def __init__(self, hold_ticks: int):
        self.hold_ticks = hold_ticks

    def init(self, handle) -> None:
        self.run = handle.getValueState("run", "first bigint, last bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues
                        ) -> Iterator[pd.DataFrame]:
        batch = pd.concat(list(rows)).sort_values("tick")
        first, last = self.run.get() if self.run.exists() else (None, None)
        found = []
        for tick, breach in zip(batch["tick"], batch["breach"]):
            if not breach:
                first = last = None
                continue
            if last is None or tick != last + 1:
                first = tick
            last = tick
            found.append((key[0], tick, "firing" if tick - first >= self.hold_ticks else "pending"))
        if last is None:
            self.run.clear()
        else:
            self.run.update((int(first), int(last)))
        yield pd.DataFrame(found, columns=["series", "tick", "state"])

    def close(self) -> None:
        pass


def held_alerts_stream(ticks: DataFrame, hold_seconds: int = 120, step: int = TICK_SECONDS
                       ) -> DataFrame:
    """``ticks`` is a stream of ``(series, tick, breach)`` in tick order across batches."""
    return ticks.select("series", "tick", "breach").groupBy("series").transformWithStateInPandas(
        statefulProcessor=AlertHold(hold_seconds // step),
        outputStructType="series string, tick bigint, state string",
        outputMode="append", timeMode="None")


# -- sources that fall silent -------------------------------------------------

class SilenceWatch(StatefulProcessor):
    """One timer per source, set anew by every batch with rows of it.

    It runs on the clock and not on event time, so a source is reported although no row of any
    source arrives any more. State is one row per source.
    """

    def __init__(self, limit_ms: int):
        self.limit_ms = limit_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.heard = handle.getValueState("heard", "newest bigint, due bigint, silent boolean")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        newest, found = int(max(batch["newest"].max() for batch in rows)), []
        if self.heard.exists():
            before, due, silent = self.heard.get()
            newest = max(newest, before)
            if silent:
                found.append((key[0], newest, "back"))
            else:
                self.handle.deleteTimer(due)
        due = timerValues.getCurrentProcessingTimeInMs() + self.limit_ms
        self.handle.registerTimer(due)
        self.heard.update((newest, due, False))
        yield _silences(found)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        newest, due, _ = self.heard.get()
        self.heard.update((newest, due, True))
        yield _silences([(key[0], newest, "silent")])

    def close(self) -> None:
        pass


def _silences(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["source", "newest", "state"]).astype({"newest": "int64"})


def _newest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per source and Arrow batch, so that a busy source is not shuffled row by row."""
    for batch in batches:
        found = pa.Table.from_batches([batch]).group_by("source").aggregate([("newest", "max")])
        yield from found.rename_columns(["source", "newest"]).cast(batch.schema).to_batches()


def silence_stream(events: DataFrame, source: str, limit_seconds: float, ts: str = "ts") -> DataFrame:
    """``(source, last_seen, state)`` from a stream: ``silent`` when no row of a source has arrived for so
    long by the clock, ``back`` when one arrives after that. Rows without source or time are left out."""
    rows = events.select(F.col(source).cast("string").alias("source"), F.unix_micros(F.col(ts).cast("timestamp"))
                         .alias("newest")).dropna()
    found = rows.mapInArrow(_newest, rows.schema).groupBy("source").transformWithStateInPandas(
        statefulProcessor=SilenceWatch(int(limit_seconds * 1000)), outputStructType="source string, newest bigint, state string",
        outputMode="append", timeMode="ProcessingTime")
    return found.select("source", F.timestamp_micros("newest").alias("last_seen"), "state")


def run_until_quiet(df: DataFrame, name: str, quiet_seconds: float, path: str | None = None) -> DataFrame:
    """Run a stream, empty batches included, until no row has come in for so long; what it appended."""
    spark = df.sparkSession
    path = path or scratch_path(spark, name)
    query = (df.writeStream.outputMode("append").format("parquet").option("checkpointLocation", f"{path}-checkpoint")
             .trigger(processingTime="500 milliseconds").start(path))
    seen, since = -1, time.monotonic()
    while query.isActive and time.monotonic() - since < quiet_seconds:
        last = query.lastProgress
        if last is None or (last["batchId"] > seen and last["numInputRows"] > 0):
            seen, since = -1 if last is None else last["batchId"], time.monotonic()
        time.sleep(0.1)
    failed = query.exception()
    query.stop()
    if failed:
        raise failed
    return spark.read.schema(df.schema).parquet(path)


# -- scoring under the production pointer -------------------------------------

class ProductionModel:
    """The bundle the registry points at; read again only when the pointer has moved."""

    def __init__(self, store: RegistryStore, name: str):
        self.store, self.name = store, name
        self.version: str | None = None
        self.bundle: tuple = ()

    def current(self) -> tuple:
        """(version, fitted features, model)."""
        _, version, path = self.store.production(self.name)
        if version is None:
            raise KeyError(f"no version of {self.name} is in production")
        if version != self.version:
            self.bundle, self.version = load_bundle(self.store.spark, path), version
        return (self.version, *self.bundle)


def score_following(records: DataFrame, production: ProductionModel, keep: Sequence[str], path: str | None = None,
                    after: Callable[[int], None] | None = None) -> DataFrame:
    """Score a stream, each micro-batch under the version in production when it starts.

    A promotion takes over with the next batch, without a restart. Rows carry ``model_version``. A batch that is repeated
    after a failure replaces what it wrote. ``after`` is called with the number of each finished batch.
    """
    spark = records.sparkSession
    path = path or scratch_path(spark, "scored")

    def save(batch: DataFrame, number: int) -> None:
        version, state, model = production.current()
        scored = batch_score(batch, state, model, keep).withColumn("model_version", F.lit(version))
        scored.write.mode("overwrite").parquet(f"{path}/batch={number}")
        if after:
            after(number)

    run_batches(records, save, path)
    return spark.read.parquet(path).drop("batch")


# -- drift on streams ---------------------------------------------

def drift_stream(events: DataFrame, ref: DriftReference, length: str = "1 day",
                 columns: Sequence[str] | None = None) -> DataFrame:
    """PSI per tumbling window and column against frozen edges, one stateful aggregate."""
    df = event_time(events).withColumn("w", F.window("ts", length))
    psi = psi_by_window(df, ref, ["w"], list(columns or ref.edges))
    return psi.select(F.date_format("w.start", "yyyy-MM-dd").alias("monitoring_window"), "feature",
                      "n", "psi", psi_status(F.col("psi")).alias("status"))
