"""Leaderboards and gates on metric tables derived from lineitem.

A return flag and year stand for a model, a month for a search trial; the "scores" are
mean discounts, taxes and quantities in millionths, so both engines agree on every digit.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyframe.operators import board, drift, metrics as m
from tallyframe.operators.order import exact_quantiles
from tallyframe.operators.quality import null_rates
from tallyframe.plans import drift_queries as dq, score_queries as sq, sql_text as q
from tallyframe.plans.views import DIRTY_COLUMNS, DUCK, SPARK, Dialect, dirty, scores, table


def _mean(d: Dialect, x: str, scale: int, factor: int) -> str:
    total = f"sum(cast(round({x} * {scale}) as bigint)) * {factor}"
    return f"cast({d.div(total, 'count(*)')} as double) / 1000000"


def metric_sql(d: Dialect, keys: dict[str, str]) -> str:
    names = ", ".join(f"{e} as {n}" for n, e in keys.items())
    group = ", ".join(str(i + 1) for i in range(len(keys)))
    return f"""select {names}, {_mean(d, 'l_discount', 100, 100000)} as f1_macro,
      {_mean(d, 'l_tax', 100, 120000)} as f1_weighted, {_mean(d, 'l_quantity', 1, 20000)} as accuracy
    from {d.name('lineitem')} group by {group}"""


YEAR = "cast(year(l_shipdate) as string)"
MODEL_KEYS = {"model_name": f"l_returnflag || '-' || {YEAR}"}
STAGE_KEYS = {**MODEL_KEYS, "stage": "case l_linestatus when 'O' then 'base' else 'tuned' end"}
TRIAL_KEYS = {"model": "l_returnflag",
              "trial": "cast(year(l_shipdate) * 12 + month(l_shipdate) as bigint)"}
ENTRY_KEYS = {"model_name": "l_returnflag", "version": f"'v' || {YEAR}",
              "registered_at": f"{YEAR} || '-' || lpad(cast(month(l_shipdate) as string), 2, '0')"}


def _metrics(spark, sf, keys):
    return spark.sql(metric_sql(SPARK, keys), lineitem=table(spark, sf, "lineitem"))


def _trials(spark, sf):
    t = _metrics(spark, sf, TRIAL_KEYS)
    return t.select("model", "trial", F.expr("if(trial % 7 = 0, null, f1_macro)").alias("value"))


def _entries(spark, sf):
    e = _metrics(spark, sf, ENTRY_KEYS)
    none = F.create_map().cast("map<string,string>")
    found = F.expr("if(version = 'v1995', map('accuracy', accuracy), "
                   "map('accuracy', accuracy, 'f1_macro', f1_macro))")
    return e.select("model_name", "version", F.concat(F.lit("models/"), "model_name", F.lit("/"),
                                                      "version").alias("artifact_path"),
                    found.alias("metrics"), none.alias("params"), none.alias("tags"),
                    "registered_at", F.lit("staging").alias("status"))


def _registry(spark, sf):
    entries = _entries(spark, sf)
    return board.registry_upsert(entries.where("registered_at < '1998-07'"),
                                 entries.where("registered_at >= '1998-07'"))


def registry_upsert(spark, sf):
    """The registry, then corrections: one with an older stamp, one with the same stamp."""
    known = _registry(spark, sf)
    fixed = known.where("model_name in ('A', 'R') and version = 'v1998'").withColumns({
        "artifact_path": F.concat("artifact_path", F.lit("/fixed")),
        "registered_at": F.expr("if(model_name = 'A', '1990-01-01', registered_at)")})
    return _shown(board.registry_upsert(known, fixed))


def _shown(df):
    return df.select("model_name", "version", "artifact_path", "registered_at", "status",
                     F.col("metrics")["f1_macro"].alias("f1_macro"),
                     F.col("metrics")["accuracy"].alias("accuracy"))


def rank_models(spark, sf):
    return board.rank_models(_metrics(spark, sf, MODEL_KEYS))


def select_final_model(spark, sf):
    return board.select_final(_metrics(spark, sf, MODEL_KEYS), F.col("model_name").startswith("R-"))


def base_vs_tuned(spark, sf):
    stages = _metrics(spark, sf, STAGE_KEYS)
    return board.base_vs_tuned(stages.where("stage = 'base'"), stages.where("stage = 'tuned'"))


def registry_promote(spark, sf):
    registry, _ = board.registry_promote(_registry(spark, sf), "A", "v1998")
    return _shown(registry)


def registry_lookup(spark, sf):
    registry, pointer = board.registry_promote(_registry(spark, sf), "A", "v1998")
    return _shown(board.registry_production(registry, pointer)).unionByName(
        _shown(board.registry_list(registry, "N")))


def validation_gate(spark, sf):
    predicted = m.with_prediction(scores(spark, sf))
    return board.validation_gate(m.classification_report(predicted))


def promotion_gate(spark, sf):
    table_ = _metrics(spark, sf, {"model": "l_returnflag", "y": "year(l_shipdate)"})
    old = table_.select("model", (F.col("y") + 1).alias("y"), F.col("f1_macro").alias("old_score"))
    new = table_.select("model", "y", F.col("f1_macro").alias("new_score"))
    return board.promotion_gate(new.join(old, ["model", "y"], "left")).select(
        "model", F.col("y").cast("bigint").alias("y"), "promote")


def retrain_gate(spark, sf):
    before, after = dq._lines(spark, sf)
    psi = drift.psi_table(before, after, dq.LINE_NUMERIC)
    shift = drift.label_shift(scores(spark, sf), "probs", F.col("part") == "reference")
    return board.retrain_gate(psi, shift)


def alert_rules(spark, sf):
    predicted = m.with_prediction(scores(spark, sf))
    f1 = m.performance_stability(predicted, "period").select(
        F.lit("f1_macro").alias("metric"), F.col("period").alias("feature"),
        (F.col("f1_macro") - 0.1).alias("value"))
    events = table(spark, sf, "events")
    rows = events.count()
    latency = events.select(
        F.date_format("ts", "yyyy-MM-dd").alias("day"), (F.col("value") * 4).alias("latency"))
    p95 = exact_quantiles(latency, ["latency"], [0.95], ["day"], rows=rows).select(
        F.lit("p95_latency_ms").alias("metric"), F.col("day").alias("feature"),
        F.get("quantiles", F.lit(0)).alias("value"))
    missing = null_rates(dirty(spark, sf).withColumn("half", F.expr("if(id % 2 = 0, id, null)"))
                         ).select(F.lit("missing_rate").alias("metric"), "feature",
                                  F.col("missing_rate").alias("value"))
    psi = dq.drift_of_events(events, rows).groupBy("feature").agg(F.max("psi").alias("value")).select(
        F.lit("psi_max").alias("metric"), "feature", "value")
    return board.alert_rules(board.union_all([f1, p95, missing, psi])).withColumn("value", F.round("value", 6))


QUERIES = {
    "rank_models": rank_models,
    "top_k_models": lambda s, sf: board.top_models(_metrics(s, sf, MODEL_KEYS)),
    "select_final_model": select_final_model, "base_vs_tuned": base_vs_tuned,
    "pivot_model_stage": lambda s, sf: board.pivot_stages(_metrics(s, sf, STAGE_KEYS),
                                                          ["base", "tuned"]),
    "hpo_convergence": lambda s, sf: board.search_convergence(_trials(s, sf)),
    "hpo_summary": lambda s, sf: board.search_summary(_trials(s, sf)),
    "registry_upsert": registry_upsert,
    "registry_promote": registry_promote, "registry_lookup": registry_lookup,
    "registry_best": lambda s, sf: _shown(board.registry_best(_registry(s, sf))),
    "validation_gate": validation_gate, "promotion_gate": promotion_gate,
    "retrain_gate": retrain_gate,
    "experiment_summary": lambda s, sf: board.experiment_summary(_metrics(s, sf, MODEL_KEYS)),
    "alert_rules": alert_rules,
}

# -- SQL side -----------------------------------------------------------------

MODELS = f"({metric_sql(DUCK, MODEL_KEYS)})"
STAGES = f"({metric_sql(DUCK, STAGE_KEYS)})"
TRIALS = f"""(select model, trial, case when trial % 7 <> 0 then f1_macro end as value
  from ({metric_sql(DUCK, TRIAL_KEYS)}))"""
REGISTRY = f"""(select model_name, version, 'models/' || model_name || '/' || version as artifact_path,
    registered_at, 'staging' as status, case when version <> 'v1995' then f1_macro end as f1_macro, accuracy
  from (select *, row_number() over (partition by model_name, version order by registered_at desc) as r
    from ({metric_sql(DUCK, ENTRY_KEYS)})) where r = 1)"""
PROMOTED = f"""(select * replace (case when model_name = 'A' and version = 'v1998' then 'production'
  else status end as status) from {REGISTRY})"""
BEST = "order by f1_macro desc, f1_weighted desc, accuracy desc, model_name"
BY_YEAR = f"({metric_sql(DUCK, {'model': 'l_returnflag', 'y': 'year(l_shipdate)'})})"
PSI = " union all ".join(
    f"select psi from ({dq.psi_numeric_sql(c, dq._line_side(c, '<'), dq._line_side(c, '>='))})"
    for c in dq.LINE_NUMERIC)


def _alerts(metric: str, rows: str) -> str:
    _, op, limit, kind, severity, text, action = next(
        r for r in board.ALERT_RULES if r[0] == metric)
    return f"""select '{kind}' as type, '{severity}' as severity, feature, round(value, 6) as value,
      '{text}: ' || feature || '=' || printf('%.4f', value) || ' {op} ' || printf('%.2f', {limit})
        as message, '{action}' as recommended_action from ({rows}) where value {op} {limit}"""


from tallyframe.plans.table_queries import _null_rates  # noqa: E402

HALF = f"(select *, case when id % 2 = 0 then id end as half from {q.DIRTY})"

ORACLES = {
    "rank_models": f"select *, row_number() over ({BEST}) as rank from {MODELS}",
    "top_k_models": f"select * from {MODELS} {BEST} limit 3",
    "select_final_model": f"""with e as (select * from {MODELS} where model_name like 'R-%'
          order by f1_macro desc, model_name limit 1),
        s as (select * from {MODELS} where model_name not like 'R-%' order by f1_macro desc, model_name limit 1)
      select case when e.f1_macro >= s.f1_macro then e.model_name else s.model_name end as final_model,
        greatest(e.f1_macro, s.f1_macro) as f1_macro,
        case when e.f1_macro >= s.f1_macro then 'ensemble' else 'single' end as kind from e cross join s""",
    "base_vs_tuned": f"""select b.model_name, b.f1_macro as base, t.f1_macro as tuned,
        round(t.f1_macro - b.f1_macro, 6) as improvement
      from {STAGES} as b join {STAGES} as t on b.model_name = t.model_name
        and b.stage = 'base' and t.stage = 'tuned'""",
    "pivot_model_stage": f"""select model_name, max(f1_macro) filter (stage = 'base') as base,
        max(f1_macro) filter (stage = 'tuned') as tuned from {STAGES} group by model_name""",
    "hpo_convergence": f"""select *, max(value) over (partition by model order by trial
        rows unbounded preceding) as best_so_far from {TRIALS}""",
    "hpo_summary": f"select model, max(value) as best_value, count(value) as completed "
                   f"from {TRIALS} group by model",
    "registry_upsert": f"""select * exclude (fixed) replace (
        case when fixed then artifact_path || '/fixed' else artifact_path end as artifact_path,
        case when fixed and model_name = 'A' then '1990-01-01' else registered_at end as registered_at)
      from (select *, model_name in ('A', 'R') and version = 'v1998' as fixed from {REGISTRY})""",
    "registry_promote": f"select * from {PROMOTED}",
    "registry_lookup": f"""select * from {PROMOTED} where model_name = 'A' and version = 'v1998'
      union all select * from {PROMOTED} where model_name = 'N'""",
    "registry_best": f"""select * from {REGISTRY} where f1_macro is not null
      order by f1_macro desc, model_name, version limit 1""",
    "validation_gate": f"""select f >= 0.7 and a >= 0.75 as passed,
        concat_ws(',', case when a < 0.75 then 'accuracy' end, case when f < 0.7 then 'f1_macro' end) as failed,
        f >= 0.7 and a >= 0.75 as deploy from (
        select max(value) filter (metric = 'f1_macro') as f, max(value) filter (metric = 'accuracy') as a
        from ({sq._report(4)}))""",
    "promotion_gate": f"""select n.model, n.y, o.f1_macro is null or n.f1_macro >= o.f1_macro - 0.005::double
        as promote from {BY_YEAR} as n left join {BY_YEAR} as o on o.model = n.model and o.y + 1 = n.y""",
    "retrain_gate": f"""select max_psi > 0.2 or label_shift > 0.1 as retrain,
        case when max_psi > 0.2 then 'feature drift' when label_shift > 0.1 then 'label drift'
          else 'no drift' end as reason, max_psi, label_shift
      from (select max(psi) as max_psi from ({PSI})) cross join
        (select label_shift from ({dq.LABEL_SHIFT}))""",
    "experiment_summary": f"""select count(*) as n_models, arg_max(model_name, f1_macro) as best_model,
        arg_min(model_name, f1_macro) as worst_model, max(f1_macro) as max_score,
        min(f1_macro) as min_score, round(max(f1_macro) - min(f1_macro), 6) as score_range from {MODELS}""",
    "alert_rules": " union all ".join([
        _alerts("f1_macro", f"select period as feature, f1_macro - 0.1::double as value from "
                            f"({sq._group_metrics('period', 'period', 0)})"),
        _alerts("p95_latency_ms", "select strftime(ts, '%Y-%m-%d') as feature, "
                                  "quantile_cont(value * 4, 0.95) as value from events group by 1"),
        _alerts("missing_rate", "select feature, missing_rate as value from ("
                + _null_rates(HALF, [*DIRTY_COLUMNS, "half"]) + ")"),
        _alerts("psi_max", f"select feature, max(psi) as value from ({dq.ORACLES['drift_by_window']}) "
                           "group by feature")]),
}
