"""Registry and gates; monitors on static tables against the same on streams."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyframe.operators import board
from tallyframe.operators.order import local_rows
from tallyframe.sources import tables as io
from tallyframe.streaming import monitors as mon, run


def registry(spark, *rows):
    return spark.createDataFrame(
        [(n, v, "p", {"f1_macro": s} if s is not None else {}, {}, {}, at, "staging")
         for n, v, s, at in rows], board.REGISTRY_SCHEMA)


def test_registry(spark):
    old = registry(spark, ("a", "1", 0.7, "2024-01"), ("b", "1", None, "2024-01"))
    new = registry(spark, ("a", "1", 0.6, "2024-02"), ("a", "2", 0.6, "2024-02"))
    merged = board.registry_upsert(old, new)
    assert {(r["model_name"], r["version"], r["metrics"].get("f1_macro")) for r in merged.collect()} == {
        ("a", "1", 0.6), ("a", "2", 0.6), ("b", "1", None)}
    best = board.registry_best(merged).first()
    assert (best["model_name"], best["version"]) == ("a", "1")
    assert board.registry_best(merged, "absent").count() == 0
    first, _ = board.registry_promote(merged, "a", "1")
    both, pointer = board.registry_promote(first, "a", "2")
    assert both.where("status = 'production'").count() == 2
    assert board.registry_production(both, pointer).first()["version"] == "2"
    demoted, _ = board.registry_promote(first, "a", "2", demote=True)
    assert demoted.where("status = 'production'").count() == 1
    with pytest.raises(KeyError):
        board.registry_promote(merged, "a", "9")


def test_gates(spark):
    metrics = local_rows(spark, [("f1_macro", 0.8)], {"metric": "string", "value": "double"})
    row = board.validation_gate(metrics).first()
    assert (row["passed"], row["failed"], row["deploy"]) == (False, "accuracy", False)
    assert board.validation_gate(metrics, forced=True).first()["deploy"]
    scores = local_rows(spark, [(None, 0.1), (0.8, 0.796), (0.8, 0.79)],
                        {"old_score": "double", "new_score": "double"})
    assert [r["promote"] for r in board.promotion_gate(scores).collect()] == [True, True, False]


def test_retrain_gate(spark):
    def psi(*values):
        return local_rows(spark, [(v,) for v in values], {"psi": "double"})

    def shift(v):
        return local_rows(spark, [(v,)], {"label_shift": "double"})

    def reason(*args, **kw):
        row = board.retrain_gate(*args, **kw).first()
        return row["retrain"], row["reason"]

    assert reason(psi(0.1, None), shift(0.05)) == (False, "no drift")
    assert reason(psi(0.1, 0.3), shift(0.05)) == (True, "feature drift")
    assert reason(psi(None), shift(0.2)) == (True, "label drift")
    assert reason(psi(0.5), None, has_new_data=False) == (False, "no new data")
    assert reason(None, None, spark=spark) == (True, "no reference data")
    assert reason(psi(0.0), None, forced=True) == (True, "forced")


def test_alerts(spark):
    rows = local_rows(spark, [("psi_max", "x", 0.2), ("psi_max", "y", 0.21), ("f1_macro", "m", 0.5),
                              ("p95_latency_ms", "api", 500.0), ("unruled", "u", 9.0)],
                      {"metric": "string", "feature": "string", "value": "double"})
    got = {(r["type"], r["feature"], r["severity"]) for r in board.alert_rules(rows).collect()}
    assert got == {("drift", "y", "HIGH"), ("performance", "m", "HIGH")}


def test_bucket_quantile(spark):
    df = local_rows(spark, [(v,) for v in [3.0, 7.0, 8.0, 20.0]], {"v": "double"})
    edges = (5, 10, 25)
    wide = df.agg(*[F.expr(f"count_if(v <= {e}) as le_{i}") for i, e in enumerate(edges)],
                  F.count("*").alias("count"))
    half = wide.select(F.expr(mon.bucket_quantile(0.5, edges))).first()[0]
    assert half == 5 + (10 - 5) * (2 - 1) / 2
    over = wide.withColumn("count", F.lit(100)).select(F.expr(mon.bucket_quantile(0.95, edges)))
    assert over.first()[0] == 25


@pytest.fixture(scope="module")
def requests(spark, tmp_path_factory):
    """Events in time order as eight files, one per later micro-batch."""
    rng = np.random.default_rng(9)
    at = np.cumsum(rng.integers(1, 25, 1600)) + 1_700_000_000
    rows = [(i, int(t), "hot" if i % 3 else f"s{i % 5}", float(v), bool(e)) for i, (t, v, e) in
            enumerate(zip(at, rng.gamma(2, 60, 1600), rng.random(1600) < 0.07))]
    df = spark.createDataFrame(rows, "event_id long, at long, source string, value double, failed boolean")
    df = df.withColumn("ts", F.timestamp_seconds("at"))
    folder = str(tmp_path_factory.mktemp("requests"))
    for k in range(8):
        df.where(f"event_id div 200 = {k}").coalesce(1).write.mode("append").parquet(folder)
    return df, folder


def stream(spark, folder, schema, per_batch=1):
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", per_batch)
            .parquet(folder))


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def test_sliding_windows_stream_like_batch(spark, requests):
    df, folder = requests
    batch = mon.error_rate(df, "failed")
    done = run.run_append(mon.error_rate(stream(spark, folder, df.schema), "failed"), "rates")
    closed = df.agg(F.max("at")).first()[0] - 600
    want = batch.where(F.col("tick") * 30 <= closed)
    assert rows_of(done.select("tick", "errors", "requests")) == rows_of(
        want.select("tick", "errors", "requests"))


def test_counters_stream_like_batch(spark, requests):
    df, folder = requests
    done = run.run_complete(mon.counters(stream(spark, folder, df.schema), ["source"]), "counters")
    assert rows_of(done) == rows_of(mon.counters(df, ["source"]))


def test_state_survives_a_restart_without_new_rows(spark, requests, tmp_path):
    df, folder = requests
    counted = mon.counters(df, ["source"])
    for _ in range(2):  # the second run finds its checkpoint and no new files
        done = run.run_complete(mon.counters(stream(spark, folder, df.schema), ["source"]), "counters",
                                str(tmp_path / "c"))
        assert rows_of(done) == rows_of(counted)
    for _ in range(2):
        keep = run.LastN(spark, 300, "value", "failed", ("ts", "event_id"), str(tmp_path / "n"))
        run.run_batches(stream(spark, folder, df.schema), keep.save, keep.path)
        assert keep.tables()[1].first()["request_count"] == df.count()
    assert len(list((tmp_path / "n" / "last").iterdir())) == 2


def test_last_n_over_many_batches(spark, requests):
    df, folder = requests
    keep = run.LastN(spark, 300, "value", "failed", ("ts", "event_id"))
    run.run_batches(stream(spark, folder, df.schema), keep.save, keep.path)
    got = mon._latency_summary(*keep.tables(), "value").first()
    want = mon.last_n_latency(df, 300, "value", "failed", ["ts", "event_id"]).first()
    assert got.asDict() == want.asDict()
    last = [r["value"] for r in df.orderBy(F.desc("event_id")).limit(300).collect()]
    assert want["p95_ms"] == pytest.approx(np.percentile(last, 95), abs=0.005)


def test_held_alerts_stream_over_many_batches(spark, tmp_path):
    breach = [1, 1, 1, 1, 1, 1, 0, 1, 1, 1, 1, 1, 0, 0, 1]
    rows = [("all", i, bool(b)) for i, b in enumerate(breach) if i != 9]  # tick 9 never came
    ticks = spark.createDataFrame(rows, "series string, tick long, breach boolean")
    want = mon.held_alerts(ticks, ["series"])
    firing = [r["tick"] for r in want.where("state = 'firing'").orderBy("tick").collect()]
    assert firing == [4, 5]
    for k in range(3):
        ticks.where(f"tick div 5 = {k}").coalesce(1).write.mode("append").parquet(str(tmp_path / "t"))
    with run.rocksdb_state(spark):
        held = run.held_alerts_stream(stream(spark, str(tmp_path / "t"), ticks.schema))
        done = run.run_append(held, "held")
        assert rows_of(done) == rows_of(want)


def test_heartbeat_gaps(requests):
    df, _ = requests
    got = mon.heartbeat_gaps(df, "source", 60)
    pdf = df.select("source", "at").toPandas().sort_values(["source", "at"])
    step = pdf.groupby("source")["at"].diff()
    assert got.count() == int((step > 60).sum())
    assert sorted(r["seconds"] for r in got.collect()) == sorted(step[step > 60])


def test_silence_at_the_end_is_reported(requests):
    df, _ = requests
    end = df.agg(F.max("at")).first()[0] + 100
    got = mon.heartbeat_gaps(df, "source", 60, as_of=F.timestamp_seconds(F.lit(float(end))))
    assert got.count() == mon.heartbeat_gaps(df, "source", 60).count() + df.select("source").distinct().count()


def test_registry_entry_replaces_whatever_its_stamp(spark):
    def row(path, stamp):
        return ("m", "1", path, {}, {}, {}, stamp, "staging")
    known = spark.createDataFrame([row("old", "2024-02-01")], board.REGISTRY_SCHEMA)
    for stamp in ("2024-01-01", "2024-02-01", "2024-03-01"):
        entry = spark.createDataFrame([row("new", stamp)], board.REGISTRY_SCHEMA)
        assert [r.artifact_path for r in board.registry_upsert(known, entry).collect()] == ["new"]


def test_scratch_needs_a_shared_folder_off_local(spark):
    class Conf(dict):
        pass

    class Session:
        conf = Conf({"spark.master": "spark://host:7077"})
    with pytest.raises(ValueError):
        io.scratch_path(Session, "x")


def test_sources_and_reports(spark, tmp_path):
    df = local_rows(spark, [(1, 'a "quoted", text'), (2, None)], {"id": "bigint", "t": "string"})
    df.write.option("header", True).option("escape", '"').csv(str(tmp_path / "x"))
    assert rows_of(io.read_table(spark, str(tmp_path / "x"), "id bigint, t string").fillna("-")) == \
        rows_of(df.fillna("-"))
    path = str(tmp_path / "reports")
    io.append_report(df, path, "2024-01-01T00:00:00", "stable")
    io.append_report(df, path, "2024-01-02T00:00:00", "drift")
    assert spark.read.parquet(path).where("report_date = '2024-01-02'").count() == 2
    calls = []

    def compute():
        calls.append(1)
        return df

    for _ in range(2):
        assert io.cached(spark, str(tmp_path / "cache"), compute).count() == 2
    assert calls == [1]
    nested = df.select(F.struct("id", F.struct("t").alias("in")).alias("r"))
    assert io.flatten_struct(nested).columns == ["r.id", "r.in.t"]


def test_a_lone_source_that_falls_silent_is_reported(spark, requests, tmp_path):
    """No row of any source arrives after the first batch: only the clock can tell."""
    df, folder = requests
    with run.rocksdb_state(spark):
        found = run.run_until_quiet(run.silence_stream(stream(spark, folder, df.schema, 8), "source", 1), "silent", 6)
        states = rows_of(found.groupBy("source", "state").count())
    assert states == [(s, "silent", 1) for s in sorted({r["source"] for r in df.select("source").distinct().collect()})]
    newest = {r["source"]: r["m"] for r in df.groupBy("source").agg(F.max("ts").alias("m")).collect()}
    assert {r["source"]: r["last_seen"] for r in found.collect()} == newest


def test_silence_timers(monkeypatch):
    """A row moves the timer on; after a silence the source is reported back, with its newest time."""
    import pandas as pd

    class Value:
        kept = None

        def exists(self):
            return self.kept is not None

        def get(self):
            return self.kept

        def update(self, value):
            self.kept = value

    class Handle:
        def __init__(self):
            self.timers = set()

        def getValueState(self, *_):
            return Value()

        def registerTimer(self, at):
            self.timers.add(at)

        def deleteTimer(self, at):
            self.timers.remove(at)

    class Clock:
        def __init__(self, now):
            self.now = now

        def getCurrentProcessingTimeInMs(self):
            return self.now

    handle, watch = Handle(), run.SilenceWatch(1000)
    watch.init(handle)

    def rows(now, *newest):
        out = watch.handleInputRows(("s",), iter([pd.DataFrame({"newest": newest})]), Clock(now))
        return [tuple(r) for f in out for r in f.itertuples(index=False)]

    assert rows(0, 5, 9) == [] and handle.timers == {1000}
    assert rows(400, 7) == [] and handle.timers == {1400}
    handle.timers.clear()
    fired = [tuple(r) for f in watch.handleExpiredTimer(("s",), Clock(1400), None) for r in f.itertuples(index=False)]
    assert fired == [("s", 9, "silent")]
    assert rows(5000, 8) == [("s", 9, "back")] and handle.timers == {6000}
    assert rows(5500, 20) == [] and handle.timers == {6500}


def test_registry_of_two_writers(spark, tmp_path):
    """A writer that is overtaken between reading and committing starts again; no entry is lost."""
    from concurrent.futures import ThreadPoolExecutor

    from tallyframe.sources.registry import RegistryStore

    def entry(name, version, at="2024-01-01"):
        return spark.createDataFrame([(name, version, f"p/{name}/{version}", {"f1_macro": 0.5}, {}, {}, at, "staging")],
                                     board.REGISTRY_SCHEMA)

    path = str(tmp_path / "registry")
    first, second = RegistryStore(spark, path), RegistryStore(spark, path)
    assert first.state().version == 0 and first.state().entries.count() == 0
    first.upsert(entry("m", "1"))
    put, raced = first._put_if_absent, []

    def overtaken(version, text):
        if not raced:
            raced.append(second.upsert(entry("m", "2")).version)
        return put(version, text)

    first._put_if_absent = overtaken
    assert first.upsert(entry("m", "3")).version == 3 and raced == [2]
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda k: RegistryStore(spark, path).upsert(entry("n", str(k))), range(6)))
    state = second.state()
    assert state.version == 9 and {(r.model_name, r.version) for r in state.entries.collect()} == (
        {("m", str(k)) for k in (1, 2, 3)} | {("n", str(k)) for k in range(6)})
    assert first.production("m") == (9, None, None)
    with pytest.raises(KeyError):
        first.promote("m", "9")
    first.promote("m", "2")
    assert second.production("m") == (10, "2", "p/m/2")
    second.promote("m", "3", demote=True)
    status = {r.version: r.status for r in first.state().entries.where("model_name = 'm'").collect()}
    assert first.production("m")[1] == "3" and status == {"1": "staging", "2": "archived", "3": "production"}


def test_repeated_runs_do_not_double_reports(spark, tmp_path):
    df = local_rows(spark, [(1, "a"), (2, "b")], {"id": "bigint", "t": "string"})
    path = str(tmp_path / "reports")
    for stamp in ("2024-01-01T00:00:00", "2024-01-01T06:00:00", "2024-01-01T00:00:00"):
        io.append_report(df, path, stamp, "stable")
    io.append_report(df.limit(1), path, "2024-01-01T09:00:00", "drift", run_id="2024-01-01T06:00:00")
    rows = rows_of(spark.read.parquet(path).groupBy("timestamp", "overall_status").count())
    assert rows == [("2024-01-01T00:00:00", "stable", 2), ("2024-01-01T09:00:00", "drift", 1)]
