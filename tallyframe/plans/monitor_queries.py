"""Request monitoring on events: static tables and the same monitors on a stream.

``event_type`` stands for the endpoint, ``value`` for the latency in ms and the type
"error" for a failed request.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyframe.operators import drift
from tallyframe.operators.metrics import with_prediction
from tallyframe.plans import drift_queries as dq, score_queries as sq
from tallyframe.plans.views import scores, table
from tallyframe.sources.tables import scratch_path
from tallyframe.streaming import monitors as mon, run

IS_ERROR = "event_type = 'error'"


def _events(spark, sf):
    return table(spark, sf, "events").withColumn(
        "status", F.expr(f"if({IS_ERROR}, 'error', 'success')"))


def _stream(spark, sf):
    return run.read_stream(spark, sf, "events.parquet").withColumn(
        "status", F.expr(f"if({IS_ERROR}, 'error', 'success')"))


def _ticks(df, *columns):
    return df.select(mon.tick_time().alias("window_end"), *columns)


def request_counters(spark, sf):
    return mon.counters(_events(spark, sf), ["event_type", "status"])


def request_counters_stream(spark, sf):
    return run.run_complete(mon.counters(_stream(spark, sf), ["event_type", "status"]), "counters")


def latency_histogram(spark, sf):
    return mon.bucket_histogram(_events(spark, sf), "value", mon.LATENCY_EDGES, ["event_type"]
                                ).withColumn("total", F.round("total", 2))


def latency_histogram_stream(spark, sf):
    wide = mon.bucket_histogram(_stream(spark, sf), "value", mon.LATENCY_EDGES, ["event_type"])
    return run.run_complete(wide, "latency").withColumn("total", F.round("total", 2))


def prediction_class_counter(spark, sf):
    return mon.counters(with_prediction(scores(spark, sf)), ["y_pred"])


def batch_size_histogram(spark, sf):
    sizes = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("size"))
    return mon.bucket_histogram(sizes, "size", mon.BATCH_EDGES)


def _as_stream(df, name):
    """The rows of a table arriving as files."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return run.read_stream(df.sparkSession, path)


def prediction_class_counter_stream(spark, sf):
    rows = _as_stream(with_prediction(scores(spark, sf)).select("y_pred"), "predictions")
    return run.run_complete(mon.counters(rows, ["y_pred"]), "classes")


def batch_size_histogram_stream(spark, sf):
    sizes = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("size"))
    return run.run_complete(mon.bucket_histogram(_as_stream(sizes, "sizes"), "size", mon.BATCH_EDGES),
                            "batch_sizes")


def rolling_last_n_latency(spark, sf):
    return mon.last_n_latency(table(spark, sf, "events"), 1000, "value", IS_ERROR,
                              ["ts", "event_id"])


def rolling_latency_stream(spark, sf):
    keep = run.LastN(spark, 1000, "value", IS_ERROR, ("ts", "event_id"))
    run.run_batches(run.read_stream(spark, sf, "events.parquet"), keep.save, keep.path)
    last, totals = keep.tables()
    return mon._latency_summary(last, totals, "value")


def _rates(ticks):
    return _ticks(ticks, "errors", "requests", F.round("rate", 6).alias("rate"), "breach")


def error_rate_5m(spark, sf):
    return _rates(mon.error_rate(_events(spark, sf), IS_ERROR))


def error_rate_5m_stream(spark, sf):
    return _rates(run.run_append(mon.error_rate(_stream(spark, sf), IS_ERROR), "error_rate"))


def p95_from_buckets_5m(spark, sf):
    return _ticks(mon.p95_from_buckets(_events(spark, sf), "value"), "count",
                  F.round("p95", 4).alias("p95"), "breach")


def p95_from_buckets_5m_stream(spark, sf):
    ticks = run.run_append(mon.p95_from_buckets(_stream(spark, sf), "value"), "p95")
    return _ticks(ticks, "count", F.round("p95", 4).alias("p95"), "breach")


def alert_pending_firing(spark, sf):
    ticks = mon.error_rate(_events(spark, sf), IS_ERROR)
    return _ticks(mon.held_alerts(ticks), "state")


def alert_firing_stream(spark, sf):
    """Two queries: windows into a table of ticks, the table as a stream into the hold rule."""
    path = scratch_path(spark, "ticks")
    rates = mon.error_rate(_stream(spark, sf), IS_ERROR).withColumn("series", F.lit("all"))
    run.run_append(rates, "ticks", path)
    held = run.held_alerts_stream(run.read_stream(spark, path, schema=rates.schema))
    with run.rocksdb_state(spark):
        return _ticks(run.run_append(held, "held"), "state")


def heartbeat_gap(spark, sf):
    """Clicks stop early and never come back; the report is made at the time of the last event."""
    events = table(spark, sf, "events")
    heard = events.where("event_type <> 'click' or ts < timestamp_ntz '2024-01-12 00:00:00'")
    gaps = mon.heartbeat_gaps(heard, "event_type", 3600, as_of=events.agg(F.max("ts")).scalar())
    shown = [F.date_format(c, mon.TIME_FORMAT).alias(c) for c in ("gap_start", "gap_end")]
    return gaps.select("event_type", *shown, F.round("seconds", 3).alias("seconds"))


def heartbeat_sessions_stream(spark, sf):
    s = run.run_append(mon.heartbeat_sessions(_stream(spark, sf), "event_type", 3600), "sessions")
    return s.select("event_type", F.date_format("active_from", mon.TIME_FORMAT).alias("active_from"),
                    F.date_format("silent_from", mon.TIME_FORMAT).alias("silent_from"), "n")


def _known(spark, sf):
    cut = F.lit("2024-01-11").cast("timestamp_ntz")
    early = table(spark, sf, "events").where((F.col("ts") < cut) & (F.col("event_type") != "click"))
    return drift.settle(early.select("event_type").distinct())


def heartbeat_silence_stream(spark, sf):
    """Every source falls silent once the rows have all come in; found by timers, with no further row."""
    with run.rocksdb_state(spark):
        found = run.run_until_quiet(run.silence_stream(_stream(spark, sf), "event_type", 1.5), "silences", 15)
    return found.where("state = 'silent'").select(
        F.col("source").alias("event_type"), F.date_format("last_seen", "yyyy-MM-dd HH:mm:ss").alias("last_seen"))


def input_quality_windows(spark, sf):
    day = F.date_format("ts", "yyyy-MM-dd")
    return mon.input_quality_windows(_events(spark, sf), day, "value", 1, 200, "event_type",
                                     _known(spark, sf))


def stream_input_quality(spark, sf):
    df = mon.event_time(_stream(spark, sf))
    out = mon.input_quality_windows(df, F.window("ts", "1 day"), "value", 1, 200, "event_type",
                                    _known(spark, sf))
    done = run.run_append(out, "input_quality")
    return done.select(F.date_format("window.start", "yyyy-MM-dd").alias("window"),
                       "rows", "missing", "violations", "unseen")


def stream_drift(spark, sf):
    cut = F.lit("2024-01-11").cast("timestamp_ntz")
    ref = drift.DriftReference.fit(table(spark, sf, "events").where(F.col("ts") < cut),
                                   ["value", "user_id"])
    late = dq.with_odd_columns(run.read_stream(spark, sf, "events.parquet").where(F.col("ts") >= cut))
    return run.run_append(run.drift_stream(late, ref, columns=dq.WINDOW_COLUMNS), "drift")


QUERIES = {
    "request_counters": request_counters, "request_counters_stream": request_counters_stream,
    "latency_histogram": latency_histogram, "latency_histogram_stream": latency_histogram_stream,
    "prediction_class_counter": prediction_class_counter,
    "batch_size_histogram": batch_size_histogram,
    "prediction_class_counter_stream": prediction_class_counter_stream,
    "batch_size_histogram_stream": batch_size_histogram_stream,
    "p95_from_buckets_5m_stream": p95_from_buckets_5m_stream,
    "rolling_last_n_latency": rolling_last_n_latency,
    "rolling_latency_stream": rolling_latency_stream,
    "error_rate_5m": error_rate_5m, "error_rate_5m_stream": error_rate_5m_stream,
    "p95_from_buckets_5m": p95_from_buckets_5m, "alert_pending_firing": alert_pending_firing,
    "alert_firing_stream": alert_firing_stream, "heartbeat_gap": heartbeat_gap,
    "heartbeat_sessions_stream": heartbeat_sessions_stream,
    "heartbeat_silence_stream": heartbeat_silence_stream,
    "input_quality_windows": input_quality_windows, "stream_input_quality": stream_input_quality,
    "stream_drift": stream_drift,
}


# -- SQL side -----------------------------------------------------------------

COUNTERS = f"""select event_type, case when {IS_ERROR} then 'error' else 'success' end as status,
  count(*) as n from events group by 1, 2"""


def _histogram(source: str, value: str, edges, by: str, total: str) -> str:
    keys = f"{by}, " if by else ""
    group = f"group by {by}" if by else ""
    parts = [f"select {keys}'{e}' as le, count(*) filter ({value} <= {e}) as n, {total} as total, "
             f"count({value}) as count from {source} {group}" for e in edges]
    parts.append(f"select {keys}'+Inf', count({value}), {total}, count({value}) from {source} {group}")
    return " union all ".join(parts)


HISTOGRAM = _histogram("events", "value", mon.LATENCY_EDGES, "event_type", "round(sum(value), 2)")
LAST_N = f"""select t.request_count, t.error_count, round(t.error_count / t.request_count, 4) as error_rate,
    round(avg(value), 2) as mean_ms, round(quantile_cont(value, 0.5), 2) as p50_ms,
    round(quantile_cont(value, 0.95), 2) as p95_ms, round(quantile_cont(value, 0.99), 2) as p99_ms,
    round(max(value), 2) as max_ms
  from (select value from events order by ts desc, event_id desc limit 1000)
  cross join (select count(*) as request_count, count(*) filter ({IS_ERROR}) as error_count from events) as t
  group by t.request_count, t.error_count"""
SPREAD = """(select *, unnest(range(pane + 1, pane + 11)) as tick
  from (select *, epoch_us(ts) // 30000000 as pane from events))"""
AT = "strftime(make_timestamp(tick * 30000000), '%Y-%m-%d %H:%M:%S')"
# Windows a stream has closed: those ending before the watermark of the last row.
CLOSED = "tick * 30000000 <= (select epoch_us(max(ts)) from events) - 600000000"
TICKS = f"""(select tick, count(*) filter ({IS_ERROR}) as errors, count(*) as requests
  from {SPREAD} group by tick)"""


def _rate_sql(where: str = "true") -> str:
    return f"""select {AT} as window_end, errors, requests, round(errors / requests, 6) as rate,
      errors / requests > 0.05 as breach from {TICKS} where {where}"""


def _held_sql(where: str = "true") -> str:
    return f"""select {AT} as window_end, case when tick - min(tick) over (partition by island) >= 4
        then 'firing' else 'pending' end as state from (
      select tick, tick - row_number() over (order by tick) as island from {TICKS}
      where errors / requests > 0.05 and {where})"""


def _p95_sql() -> str:
    le = ", ".join(f"count(*) filter (value <= {e}) as le_{i}" for i, e in enumerate(mon.LATENCY_EDGES))
    p95 = mon.bucket_quantile(0.95, mon.LATENCY_EDGES).replace("0.95D", "0.95::double")
    return f"""select {AT} as window_end, count, round(p95, 4) as p95, p95 > 500 as breach from (
      select tick, count, {p95} as p95 from (
        select tick, count(value) as count, {le} from {SPREAD} group by tick))"""


SESSIONS = """(select event_type, ts, sum(fresh) over (partition by event_type order by ts) as session
  from (select event_type, ts, case when ts >= lag(ts) over (partition by event_type order by ts)
          + interval 3600 second then 1 else 0 end as fresh from events))"""


def _quality_sql(having: str = "") -> str:
    return f"""select strftime(ts, '%Y-%m-%d') as "window", count(*) as rows,
      count(*) filter (value is null) as missing,
      count(*) filter (value < 1 or value > 200) as violations,
      count(*) filter (event_type not in (select event_type from events
        where ts < timestamp '2024-01-11' and event_type <> 'click')) as unseen
    from events group by 1 {having}"""


DAY_CLOSED = ("(cast(strptime({}, '%Y-%m-%d') as timestamp) + interval 1 day) <= "
              "(select max(ts) - interval 10 minute from events)")

ORACLES = {
    "request_counters": COUNTERS, "request_counters_stream": COUNTERS,
    "latency_histogram": HISTOGRAM, "latency_histogram_stream": HISTOGRAM,
    "prediction_class_counter": f"select y_pred, count(*) as n from {sq.S} group by y_pred",
    "batch_size_histogram": _histogram("(select count(*) as size from lineitem group by l_orderkey)",
                                       "size", mon.BATCH_EDGES, "", "cast(sum(size) as bigint)"),
    "prediction_class_counter_stream": f"select y_pred, count(*) as n from {sq.S} group by y_pred",
    "batch_size_histogram_stream": _histogram(
        "(select count(*) as size from lineitem group by l_orderkey)", "size", mon.BATCH_EDGES, "",
        "cast(sum(size) as bigint)"),
    "rolling_last_n_latency": LAST_N, "rolling_latency_stream": LAST_N,
    "error_rate_5m": _rate_sql(), "error_rate_5m_stream": _rate_sql(CLOSED),
    "p95_from_buckets_5m": _p95_sql(),
    "p95_from_buckets_5m_stream": f"select * from ({_p95_sql()}) where window_end <= strftime("
                                  "(select max(ts) - interval 10 minute from events), '%Y-%m-%d %H:%M:%S')",
    "alert_pending_firing": _held_sql(), "alert_firing_stream": _held_sql(CLOSED),
    "heartbeat_gap": """select event_type, strftime(prev, '%Y-%m-%d %H:%M:%S') as gap_start,
        strftime(ts, '%Y-%m-%d %H:%M:%S') as gap_end,
        round((epoch_us(ts) - epoch_us(prev)) / 1000000, 3) as seconds
      from (select event_type, ts, lag(ts) over (partition by event_type order by ts) as prev from (
          select event_type, ts from events
          where event_type <> 'click' or ts < timestamp '2024-01-12 00:00:00'
          union all select distinct event_type, (select max(ts) from events) from events
          where event_type <> 'click' or ts < timestamp '2024-01-12 00:00:00'))
      where epoch_us(ts) - epoch_us(prev) > 3600000000""",
    "heartbeat_sessions_stream": f"""select event_type, strftime(min(ts), '%Y-%m-%d %H:%M:%S') as active_from,
        strftime(max(ts) + interval 3600 second, '%Y-%m-%d %H:%M:%S') as silent_from, count(*) as n
      from {SESSIONS} group by event_type, session
      having max(ts) + interval 3600 second <= (select max(ts) - interval 10 minute from events)""",
    "heartbeat_silence_stream": "select event_type, strftime(max(ts), '%Y-%m-%d %H:%M:%S') as last_seen "
                                "from events group by event_type",
    "input_quality_windows": _quality_sql(),
    "stream_input_quality": _quality_sql(
        "having date_trunc('day', min(ts)) + interval 1 day <= "
        "(select max(ts) - interval 10 minute from events)"),
    "stream_drift": f"select * from ({dq.ORACLES['drift_by_window']}) where "
                    + DAY_CLOSED.format("monitoring_window"),
}
