"""Drift queries: lineitem before and after a ship date, events by day, model scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyframe.functions.columns import even_edges
from tallyframe.operators import drift
from tallyframe.plans.views import duck_scores, scores, table

CUT = "1998-07-01"
LINE_NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
LINE_TEXT = ["l_returnflag", "l_linestatus"]


def _sides(spark, sf, name, date):
    df = table(spark, sf, name)
    cut = F.lit(CUT).cast("timestamp_ntz")
    return df.where(F.col(date) < cut), df.where(F.col(date) >= cut)


def _lines(spark, sf):
    return _sides(spark, sf, "lineitem", "l_shipdate")


def q_psi_numeric(spark, sf):
    before, after = _lines(spark, sf)
    ref = drift.DriftReference.fit(before, ["l_extendedprice"])
    return drift.psi_numeric(after, ref)


def q_psi_categorical(spark, sf):
    before, after = _sides(spark, sf, "orders", "o_orderdate")
    return drift.psi_categorical(before, after, ["o_orderpriority", "o_orderstatus"])


def q_psi_table(spark, sf):
    before, after = _lines(spark, sf)
    return drift.psi_table(before, after, LINE_NUMERIC + LINE_TEXT)


def q_psi_summary(spark, sf):
    return drift.psi_summary(drift.settle(q_psi_table(spark, sf)))


def q_drift_report(spark, sf):
    before, after = _lines(spark, sf)
    return drift.drift_report(before, after, "after_cut", LINE_NUMERIC + LINE_TEXT)


def q_label_shift(spark, sf):
    return drift.label_shift(scores(spark, sf), "probs", F.col("part") == "reference")


WINDOW_COLUMNS = ["value", "user_id", "same", "gone"]


def with_odd_columns(events):
    """A constant column, and one without values from the cut on."""
    return events.withColumns({"same": F.lit(0.1), "gone": F.expr(
        "if(ts < timestamp_ntz '2024-01-11 00:00:00', value, null)")})


def q_drift_by_window(spark, sf):
    return drift_of_events(table(spark, sf, "events"))


def drift_of_events(events, rows=None):
    events = with_odd_columns(events)
    cut = F.lit("2024-01-11").cast("timestamp_ntz")
    day = F.date_format("ts", "yyyy-MM-dd")
    return drift.drift_by_window(events.where(F.col("ts") < cut), events.where(F.col("ts") >= cut),
                                 day, WINDOW_COLUMNS, rows=rows)


def _edges_sql(x: str) -> str:
    probs = ", ".join(f"cast({p!r} as double)" for p in even_edges(10))
    return f"list_sort(list_distinct(quantile_cont({x}, [{probs}])))"


def psi_numeric_sql(feature: str, ref: str, cur: str, group: str = "") -> str:
    """``ref`` and ``cur`` are selects giving x (and the group for ``cur``)."""
    g = f"{group}, " if group else ""
    on = f"c.{group} = t.{group} and " if group else ""
    return f"""
select {('t.' + group + ', ') if group else ''}'{feature}' as feature, t.n as n,
  round(sum((coalesce(c.n, 0) / t.n + 1e-6 - (coalesce(r.n, 0) / r_all.n + 1e-6))
    * ln((coalesce(c.n, 0) / t.n + 1e-6) / (coalesce(r.n, 0) / r_all.n + 1e-6))), 6) as psi
from (select unnest(range(1, len(e))) as bin from (select {_edges_sql('x')} as e from ({ref}) as q)) as grid
cross join (select {g}count(x) as n from ({cur}) as q {'group by ' + group if group else ''}) as t
cross join (select cast(count(x) as double) as n from ({ref}) as q) as r_all
left join ({_binned_sql(ref, ref, '')}) as r on r.bin = grid.bin
left join ({_binned_sql(cur, ref, g)}) as c on {on}c.bin = grid.bin
group by {('t.' + group + ', ') if group else ''}t.n
"""


def _binned_sql(side: str, ref: str, g: str) -> str:
    return f"""select {g}bin, cast(count(*) as double) as n from (
  select {g}case when x < e[1] or x > e[len(e)] then null when x = e[len(e)] then len(e) - 1
    else len(list_filter(e, lambda v: v <= x)) end as bin
  from ({side}) as q cross join (select {_edges_sql('x')} as e from ({ref}) as q2) as edges)
  where bin is not null group by {g}bin"""


def psi_categorical_sql(feature: str, ref: str, cur: str) -> str:
    def counts(q):
        return (f"select x, count(*) / sum(count(*)) over () as share from ({q}) as q "
                f"where x is not null group by x")
    return f"""
select '{feature}' as feature, round(sum((a - e) * ln(a / e)), 6) as psi
from (select coalesce(r.share, 0) + 1e-6 as e, coalesce(c.share, 0) + 1e-6 as a
      from ({counts(ref)}) as r full outer join ({counts(cur)}) as c on r.x = c.x)"""


def _line_side(column: str, op: str) -> str:
    return f"select {column} as x from lineitem where l_shipdate {op} timestamp '{CUT}'"


PSI_TABLE = "select feature, psi, " + (
    "case when psi is null then 'unknown' when psi < 0.1 then 'stable' "
    "when psi < 0.2 then 'warning' else 'drift' end as status from (") + " union all ".join(
    [f"select feature, psi from ({psi_numeric_sql(c, _line_side(c, '<'), _line_side(c, '>='))})"
     for c in LINE_NUMERIC]
    + [f"select feature, psi from ({psi_categorical_sql(c, _line_side(c, '<'), _line_side(c, '>='))})"
       for c in LINE_TEXT]) + ")"

PSI_SUMMARY = f"""select count(*) as n_features,
  count(*) filter (status = 'stable') as n_stable, count(*) filter (status = 'warning') as n_warning,
  count(*) filter (status = 'drift') as n_drift, max(psi) as max_psi, round(avg(psi), 6) as mean_psi,
  coalesce(string_agg(feature, ',' order by feature) filter (status = 'drift'), '') as drifted_features
from ({PSI_TABLE})"""


def _events_side(column: str, op: str) -> str:
    return (f"select {column} as x, strftime(ts, '%Y-%m-%d') as monitoring_window from events "
            f"where ts {op} timestamp '2024-01-11'")


def _status(q: str) -> str:
    return (f"select *, case when psi < 0.1 then 'stable' when psi < 0.2 then 'warning' "
            f"else 'drift' end as status from ({q})")


LABEL_SHIFT = f"""
with long as (
  select part, 0 as class, p0 as score from ({duck_scores()}) union all
  select part, 1, p1 from ({duck_scores()}) union all
  select part, 2, p2 from ({duck_scores()})),
d as (select class, score, count(*) filter (part = 'reference') as r,
             count(*) filter (part = 'current') as c from long group by class, score),
f as (select class, score, sum(r) over w / sum(r) over (partition by class) as fr,
             sum(c) over w / sum(c) over (partition by class) as fc,
             lead(score) over (partition by class order by score) - score as gap
      from d window w as (partition by class order by score))
select cast(count(*) as bigint) as n_classes, round(avg(w1), 6) as label_shift from (
  select class, sum(abs(fr - fc) * gap) as w1 from f group by class)
"""

QUERIES = {
    "psi_numeric": q_psi_numeric,
    "psi_categorical": q_psi_categorical,
    "psi_table": q_psi_table,
    "psi_summary": q_psi_summary,
    "drift_report": q_drift_report,
    "label_shift_w1": q_label_shift,
    "drift_by_window": q_drift_by_window,
}

ORACLES = {
    "psi_numeric": psi_numeric_sql("l_extendedprice", _line_side("l_extendedprice", "<"),
                                   _line_side("l_extendedprice", ">=")),
    "psi_categorical": " union all ".join(
        psi_categorical_sql(c, f"select {c} as x from orders where o_orderdate < timestamp '{CUT}'",
                            f"select {c} as x from orders where o_orderdate >= timestamp '{CUT}'")
        for c in ("o_orderpriority", "o_orderstatus")),
    "psi_table": PSI_TABLE,
    "psi_summary": PSI_SUMMARY,
    "drift_report": f"""select feature, psi, status, 'after_cut' as monitoring_window,
      cast(0.1 as double) as stable_threshold, cast(0.2 as double) as warning_threshold,
      case when n_drift > 0 then 'drift' when n_warning > 0 then 'warning' else 'stable' end
        as overall_status
      from ({PSI_TABLE}) cross join ({PSI_SUMMARY})""",
    "label_shift_w1": LABEL_SHIFT,
    "drift_by_window": " union all ".join(
        _status(psi_numeric_sql(c, _events_side(c, "<"), _events_side(c, ">="), "monitoring_window"))
        for c in ("value", "user_id")) + "".join(
        f""" union all select distinct strftime(ts, '%Y-%m-%d'), '{c}', 0, null, 'unknown' from events
          where ts >= timestamp '2024-01-11'""" for c in ("same", "gone")),
}
