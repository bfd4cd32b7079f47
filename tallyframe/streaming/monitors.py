"""Request monitoring. Each monitor is one function for static and streaming tables.

Requests have an event time ``ts``, an endpoint, a latency and an error flag. Sliding
windows are summed from panes of one step, so a row is expanded after aggregation and not
before it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyframe.operators.order import exact_quantiles, settle

# Fixed values of the request metrics.
LATENCY_EDGES = (5, 10, 25, 50, 100, 250, 500, 1000, 2500)
BATCH_EDGES = (1, 2, 5, 10, 25, 50, 100, 250, 500)
ERROR_RATE_LIMIT = 0.05
P95_LIMIT_MS = 500
WATERMARK = "10 minutes"
TICK_SECONDS = 30
WINDOW_SECONDS = 300
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"


def event_time(df: DataFrame, ts: str = "ts") -> DataFrame:
    """Zone-less times become instants; a stream also gets its watermark."""
    df = df.withColumn(ts, F.col(ts).cast("timestamp"))
    return df.withWatermark(ts, WATERMARK) if df.isStreaming else df


def counters(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n"))


def _bucket_aggs(value: str, edges: Sequence[float]) -> list[Column]:
    return [F.expr(f"count_if({value} <= {e}) as le_{i}") for i, e in enumerate(edges)]


def bucket_histogram(df: DataFrame, value: str, edges: Sequence[float], by: Sequence[str] = ()
                     ) -> DataFrame:
    """Cumulative buckets ``(*by, le, n, total, count)`` with a last bucket +Inf."""
    wide = df.groupBy(*by).agg(*_bucket_aggs(value, edges), F.sum(value).alias("total"),
                               F.count(value).alias("count"))
    rows = [f"named_struct('le', '{e}', 'n', le_{i})" for i, e in enumerate(edges)]
    rows.append("named_struct('le', '+Inf', 'n', count)")
    return wide.select(*by, F.inline(F.array(*[F.expr(r) for r in rows])), "total", "count")


def bucket_quantile(q: float, edges: Sequence[float], count: str = "count") -> str:
    """SQL for a quantile interpolated inside cumulative buckets ``le_0``, ``le_1``, ...

    The first bucket starts at 0; a rank beyond the last finite edge gives that edge.
    """
    rank = f"({q}D * {count})"
    arms = []
    for i, e in enumerate(edges):
        lo, below = (0, "0") if i == 0 else (edges[i - 1], f"le_{i - 1}")
        arms.append(f"when le_{i} >= {rank} then {lo} + ({e} - {lo}) * ({rank} - {below}) "
                    f"/ nullif(le_{i} - {below}, 0)")
    return f"case when {count} = 0 then null {' '.join(arms)} else cast({edges[-1]} as double) end"


# -- sliding windows ----------------------------------------------------------

def sliding_sums(df: DataFrame, sums: Mapping[str, str], by: Sequence[str] = (), ts: str = "ts",
                 length: int = WINDOW_SECONDS, step: int = TICK_SECONDS) -> DataFrame:
    """``(*by, tick, <sums>)``: sums over [end - length, end) for every tick that saw a row.

    ``sums`` maps names to additive aggregates; ``tick`` is the window end in steps.
    """
    df = event_time(df, ts)
    aggs = [F.expr(text).alias(name) for name, text in sums.items()]
    if df.isStreaming:
        panes = df.groupBy(*by, F.window(ts, f"{step} seconds").alias("pane")).agg(*aggs)
        out = panes.groupBy(*by, F.window(
            F.window_time("pane"), f"{length} seconds", f"{step} seconds").alias("window")).agg(
            *[F.sum(n).alias(n) for n in sums])
        return out.select(*by, (F.unix_seconds("window.end") / step).cast("bigint").alias("tick"),
                          *sums)
    panes = df.groupBy(*by, F.expr(f"unix_seconds({ts}) div {step}").alias("pane")).agg(*aggs)
    spread = panes.withColumn("tick", F.explode(F.sequence(
        F.col("pane") + 1, F.col("pane") + length // step)))
    return spread.groupBy(*by, "tick").agg(*[F.sum(n).alias(n) for n in sums])


def tick_time(step: int = TICK_SECONDS) -> Column:
    return F.date_format(F.timestamp_seconds(F.col("tick") * step), TIME_FORMAT)


def error_rate(df: DataFrame, is_error: str, by: Sequence[str] = (),
               limit: float = ERROR_RATE_LIMIT) -> DataFrame:
    """Errors over all requests per 5-minute window, evaluated every 30 seconds."""
    s = sliding_sums(df, {"errors": f"count_if({is_error})", "requests": "count(*)"}, by)
    return s.withColumn("rate", F.col("errors") / F.col("requests")).withColumn(
        "breach", F.col("rate") > limit)


def p95_from_buckets(df: DataFrame, value: str, by: Sequence[str] = (),
                     edges: Sequence[float] = LATENCY_EDGES, limit: float = P95_LIMIT_MS
                     ) -> DataFrame:
    sums = {f"le_{i}": f"count_if({value} <= {e})" for i, e in enumerate(edges)}
    s = sliding_sums(df, {**sums, "count": f"count({value})"}, by)
    return s.select(*by, "tick", "count", F.expr(bucket_quantile(0.95, edges)).alias("p95")
                    ).withColumn("breach", F.col("p95") > limit)


def held_alerts(ticks: DataFrame, by: Sequence[str] = (), hold_seconds: int = 120,
                step: int = TICK_SECONDS) -> DataFrame:
    """``(*by, tick, state)`` for every breaching tick: firing once it held without a break.

    A tick supports the following ``hold`` ticks; it fires when all its predecessors back
    to the hold time breached too. Counting support needs no ordered pass over a series.
    """
    hold = hold_seconds // step
    hit = ticks.where("breach").select(*by, "tick")
    support = hit.withColumn("at", F.explode(F.sequence(F.col("tick"), F.col("tick") + hold)))
    counted = support.groupBy(*by, "at").agg(
        F.count("*").alias("n"), F.bool_or(F.col("tick") == F.col("at")).alias("now"))
    return counted.where("now").select(
        *by, F.col("at").alias("tick"),
        F.when(F.col("n") == hold + 1, "firing").otherwise("pending").alias("state"))


def heartbeat_gaps(df: DataFrame, source: str, limit_seconds: float = 60, ts: str = "ts",
                   as_of: Column | None = None) -> DataFrame:
    """``(source, gap_start, gap_end, seconds)``: silences longer than the limit.

    A silence lies between two rows, or between a source's last row and ``as_of``. Rows are
    combined into panes of the limit's length before the shuffle: a longer silence always crosses
    a pane border, so first and last row of each pane are enough, however busy the source.
    """
    width = int(limit_seconds * 1_000_000)
    rows = event_time(df, ts).where(F.col(ts).isNotNull())
    panes = rows.groupBy(source, F.expr(f"unix_micros({ts}) div {width}").alias("pane")).agg(
        F.min(ts).alias("first"), F.max(ts).alias("last"))
    by_time = Window.partitionBy(source).orderBy("pane")
    between = panes.select(source, F.lag("last").over(by_time).alias("gap_start"),
                           F.col("first").alias("gap_end"))
    if as_of is not None:
        between = between.unionByName(rows.groupBy(source).agg(F.max(ts).alias("gap_start")).select(
            source, "gap_start", as_of.cast("timestamp").alias("gap_end")))
    length = (F.unix_micros("gap_end") - F.unix_micros("gap_start")) / 1e6
    return between.where("gap_start is not null").withColumn("seconds", length).where(
        F.col("seconds") > limit_seconds)


def heartbeat_sessions(df: DataFrame, source: str, gap_seconds: int = 60, ts: str = "ts"
                       ) -> DataFrame:
    """Streaming form: one row per session; the source fell silent at ``silent_from``."""
    s = F.session_window(ts, f"{gap_seconds} seconds").alias("session")
    out = event_time(df, ts).groupBy(source, s).agg(F.count("*").alias("n"))
    return out.select(source, F.col("session.start").alias("active_from"),
                      F.col("session.end").alias("silent_from"), "n")


# -- last N requests ----------------------------------------------------------

def last_n_latency(df: DataFrame, n: int, latency: str, is_error: str, order: Sequence[str]
                   ) -> DataFrame:
    """One row: latency statistics of the last n requests, error rate of all of them."""
    last = settle(df.orderBy(*[F.desc(c) for c in order]).limit(n).select(latency), n)
    return _latency_summary(last, df.agg(
        F.count("*").alias("request_count"), F.expr(f"count_if({is_error})").alias("error_count")),
        latency)


def _latency_summary(last: DataFrame, totals: DataFrame, latency: str) -> DataFrame:
    stats = last.agg(F.struct(F.avg(latency).alias("mean"), F.max(latency).alias("max")))
    q = exact_quantiles(last, [latency], [0.5, 0.95, 0.99]).select("quantiles")
    return totals.withColumns({"s": stats.scalar(), "q": q.scalar()}).select(
        "request_count", "error_count",
        F.expr("round(error_count / greatest(request_count, 1), 4)").alias("error_rate"),
        F.round("s.mean", 2).alias("mean_ms"),
        *[F.round(F.get("q", F.lit(i)), 2).alias(f"p{p}_ms") for i, p in enumerate((50, 95, 99))],
        F.round("s.max", 2).alias("max_ms"))


# -- per-window input quality -------------------------------------------------

def input_quality_windows(df: DataFrame, window: Column, value: str, lo: float, hi: float,
                          category: str, known: DataFrame) -> DataFrame:
    """Missing share, range violations and unseen categories per window.

    ``known`` is a small static table with one column ``category`` value per row.
    """
    marked = df.join(known.withColumn("__known", F.lit(True)), category, "left")
    return marked.groupBy(window.alias("window")).agg(
        F.count("*").alias("rows"), F.expr(f"count_if({value} is null)").alias("missing"),
        F.expr(f"count_if({value} < {lo} or {value} > {hi})").alias("violations"),
        F.expr(f"count_if({category} is not null and __known is null)").alias("unseen"))
