"""Evaluation, calibration, fairness, stability and policy on the score view."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyframe.functions.columns import even_edges
from tallyframe.operators import drift, metrics as m, policy
from tallyframe.plans import drift_queries as dq
from tallyframe.plans.views import arg_max_sql, duck_scores, scores, table


def _pred(spark, sf):
    return m.with_prediction(scores(spark, sf))


def on_scores(op, *args, **kwargs):
    return lambda spark, sf: op(scores(spark, sf), *args, **kwargs)


def on_predictions(op, *args, **kwargs):
    return lambda spark, sf: op(_pred(spark, sf), *args, **kwargs)


def q_roc(spark, sf):
    return m.roc_points(scores(spark, sf)).select(
        "class", "threshold", F.round("fpr", 6).alias("fpr"), F.round("tpr", 6).alias("tpr"))


def q_score_stability(spark, sf):
    events = table(spark, sf, "events").select(
        "value", F.date_format("ts", "yyyy-MM-dd").alias("period"))
    return m.score_stability(events, "value", "period")


def q_feature_means(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_custkey")
    joined = _pred(spark, sf).join(orders, F.col("key") == F.col("o_orderkey"))
    return m.feature_means_by_correctness(joined, ["o_totalprice", "o_custkey"])


def q_decision(spark, sf):
    out = policy.apply_decision(scores(spark, sf))
    return out.select(
        "key", "predicted_class", "predicted_label", "decision", "action", "risk_level",
        "confidence", *[F.col("probabilities")[c].alias(f"p_{c.lower()}") for c in m.CLASSES])


def q_soft_vote(spark, sf):
    voted = m.with_prediction(policy.soft_vote(scores(spark, sf, "ab"), ["probs_a", "probs_b"]))
    return voted.select("key", *[F.round(F.get("probs", F.lit(i)), 6).alias(f"p{i}")
                                 for i in range(3)], "y_pred")


def q_head_sample(spark, sf):
    from tallyframe.operators.splits import head_sample
    rows = head_sample(_pred(spark, sf), "key")
    return rows.select("key", "y_true", "y_pred", (F.col("y_true") == F.col("y_pred")).alias("correct"),
                       *[F.get("probs", F.lit(i)).alias(f"p{i}") for i in range(3)])


def q_scoring_summary(spark, sf):
    before, after = dq._lines(spark, sf)
    status = drift.drift_report(before, after, "after_cut", dq.LINE_NUMERIC)
    return policy.scoring_summary(_pred(spark, sf), status)


QUERIES = {
    "confusion_matrix": on_predictions(m.confusion_matrix),
    "classification_report": on_predictions(m.classification_report, digits=6),
    "auc_ovr": on_scores(m.auc_ovr), "auc_ovo": on_scores(m.auc_ovo),
    "ks_per_class": on_scores(m.ks_by_class), "roc_points": q_roc,
    "ece": on_scores(m.ece_by_class),
    "calibration_before_after": lambda s, sf: m.calibration_before_after(
        scores(s, sf, "ab"), "probs_a", "probs_b"),
    "reliability_curve": on_scores(m.reliability_curve),
    "fairness_by_group": on_predictions(m.fairness_by_group, "grp"),
    "fairness_summary": lambda s, sf: m.fairness_summary(m.fairness_by_group(_pred(s, sf), "grp")),
    "score_stability": q_score_stability,
    "performance_stability": on_predictions(m.performance_stability, "period"),
    "error_patterns": on_predictions(m.error_patterns),
    "confidence_by_correctness": on_predictions(m.confidence_by_correctness),
    "low_confidence_error_rate": on_predictions(m.low_confidence_error_rate),
    "error_rate_by_confidence_bin": on_predictions(m.error_rate_by_confidence),
    "business_impact": on_predictions(m.business_impact),
    "metrics_long": on_predictions(m.metrics_long, "1.0.0", "validation"),
    "overall_error_rate": on_predictions(m.overall_error_rate),
    "feature_means_by_correctness": q_feature_means,
    "head_sample": q_head_sample,
    "apply_decision": q_decision, "soft_vote": q_soft_vote,
    "prediction_distribution": on_predictions(policy.prediction_distribution),
    "confidence_profile": on_predictions(policy.confidence_profile),
    "scoring_summary": q_scoring_summary,
}


# -- SQL side -----------------------------------------------------------------

S = f"({duck_scores()})"
LONG = " union all ".join(
    f"select key, y_true, {k} as class, p{k} as score, case when y_true = {k} then 1.0::double "
    f"else 0 end as hit from {S}" for k in range(3))
CLASS_ROWS = "(values (0, 'Poor'), (1, 'Standard'), (2, 'Good')) as names(code, name)"


def _by_label(group: str) -> str:
    """tp, true and predicted counts per group and label, labels seen on either side."""
    return f"""(select g, n, hits, lab, count(*) filter (y_true = lab and y_pred = lab) as tp,
        count(*) filter (y_true = lab) as tr, count(*) filter (y_pred = lab) as pr
      from (select {group} as g, y_true, y_pred, count(*) over (partition by {group}) as n,
              sum(case when y_true = y_pred then 1 else 0 end) over (partition by {group}) as hits
            from {S}) cross join (values (0), (1), (2)) as labs(lab)
      where g is not null group by g, n, hits, lab
      having count(*) filter (y_true = lab) + count(*) filter (y_pred = lab) > 0)"""


def _group_metrics(group: str, name: str, floor: int) -> str:
    return f"""select g as "{name}", n, round(avg(2.0::double * tp / (tr + pr)), 4) as f1_macro,
        round(sum(2.0::double * tp / (tr + pr) * tr) / n, 4) as f1_weighted,
        round(cast(hits as double) / n, 4) as accuracy
      from {_by_label(group)} where n >= {floor} group by g, n, hits"""


PRF = f"""(select lab, tp, tr, pr, n, hits, case when pr = 0 then 0 else tp / pr end as p,
    case when tr = 0 then 0 else tp / tr end as r, 2.0::double * tp / (tr + pr) as f
  from {_by_label("'all'")})"""


def _report(digits: int) -> str:
    overall = {"accuracy": "max(hits) / max(n)", "f1_macro": "avg(f)", "f1_weighted": "sum(f * tr) / max(n)",
               "precision_macro": "avg(p)", "recall_macro": "avg(r)",
               "precision_weighted": "sum(p * tr) / max(n)", "recall_weighted": "sum(r * tr) / max(n)"}
    parts = [f"select '{name}' as metric, round(cast({e} as double), {digits}) as value from {PRF}"
             for name, e in overall.items()]
    for name, e in {"precision": "p", "recall": "r", "f1": "f", "support": "tr"}.items():
        parts.append(f"select '{name}_' || lab, round(cast({e} as double), {digits}) from {PRF}")
    return " union all ".join(parts)


DIST = f"""(select class, score, cast(sum(hit) as double) as pos, cast(count(*) - sum(hit) as double) as neg
  from ({LONG}) group by class, score)"""
RUN = f"""(select *, sum(pos) over w as cp, sum(neg) over w as cn, sum(pos) over (partition by class) as tp,
  sum(neg) over (partition by class) as tn from {DIST} window w as (partition by class order by score))"""


def _auc_pair(c: int, o: int) -> str:
    return f"""(select sum(pos * (below + neg / 2)) / (sum(pos) * sum(neg)) as auc from (
      select pos, neg, coalesce(sum(neg) over (order by score rows between unbounded preceding
        and 1 preceding), 0) as below from (
        select p{c} as score, cast(count(*) filter (y_true = {c}) as double) as pos,
          cast(count(*) filter (y_true = {o}) as double) as neg from {S}
        where y_true in ({c}, {o}) group by 1)))"""


def _ece(which: str) -> str:
    rows = " union all ".join(
        f"select {k} as class, p{which}{k} as score, case when y_true = {k} then 1.0::double "
        f"else 0 end as hit from {S}" for k in range(3))
    edges = even_edges(10)
    bins = " ".join(f"when score >= {lo!r}::double and score < {hi!r}::double then {i}"
                    for i, (lo, hi) in enumerate(zip(edges, edges[1:])))
    return f"""(select class, round(sum(case when bin is null then 0 else n * abs(c - a) end) / sum(n), 4)
      as ece from (select class, case {bins} end as bin, count(*) as n, avg(score) as c, avg(hit) as a
        from ({rows}) group by 1, 2) group by class)"""


def _upper_bin(x: str) -> str:
    edges = even_edges(10)
    return "case " + " ".join(f"when {x} <= {hi!r}::double then {i}"
                              for i, hi in enumerate(edges[1:])) + " end"


def _hist40(outcome: str, op: str) -> str:
    src = f"(select confidence as x from {S} where y_true {op} y_pred)"
    return f"""select '{outcome}' as outcome, cast(b as int) as bin, count(x) as n, med as median_confidence
      from (select lo, (hi - lo) / 40 as w, hi, unnest(range(0, 40)) as b, med from
        (select min(x) as lo, max(x) as hi, round(median(x), 6) as med from {src}))
      left join {src} as v on x >= lo + b * w and (x < case when b = 39 then hi else lo + (b + 1) * w end
        or (b = 39 and x = hi)) group by b, med"""


FAIR = _group_metrics("grp", "group", 10)
ERR = "case when y_true <> y_pred then 1.0::double else 0 end"
PATTERNS = f"""(select t.name || ' -> ' || p.name as pattern, count(*) as n from {S}
  join {CLASS_ROWS.replace('names(', 't(')} on t.code = y_true
  join {CLASS_ROWS.replace('names(', 'p(')} on p.code = y_pred where y_true <> y_pred group by 1)"""

ORACLES = {
    "confusion_matrix": f"""select cast(t.v as int) as y_true, cast(p.v as int) as y_pred,
        count(key) as n, round(count(key) / sum(count(key)) over (partition by t.v), 6) as row_share
      from (values (0), (1), (2)) as t(v) cross join (values (0), (1), (2)) as p(v)
      left join {S} as s on s.y_true = t.v and s.y_pred = p.v group by t.v, p.v""",
    "classification_report": _report(6),
    "auc_ovr": f"""select count(*) as n_classes, round(avg(auc), 6) as auc_ovr from (
        select class, sum(pos * (cn - neg / 2)) / (max(tp) * max(tn)) as auc from {RUN} group by class)""",
    "auc_ovo": "select cast(3 as bigint) as n_pairs, round(avg(auc), 6) as auc_ovo from ("
               + " union all ".join(f"select auc from {_auc_pair(c, o)}"
                                    for c in range(3) for o in range(3) if c != o) + ")",
    "ks_per_class": f"select class, round(max(abs(cp / tp - cn / tn)), 4) as ks from {RUN} group by class",
    "roc_points": f"""select class, score as threshold, round((tn - cn + neg) / tn, 6) as fpr,
        round((tp - cp + pos) / tp, 6) as tpr from {RUN}""",
    "ece": f"select * from {_ece('a')}",
    "calibration_before_after": f"""with e as (select cast(b.class as varchar) as class,
        b.ece as ece_before, a.ece as ece_after from {_ece('a')} as b join {_ece('b')} as a
        on a.class = b.class)
      select * from e union all select 'mean', round(avg(ece_before), 4), round(avg(ece_after), 4) from e""",
    "reliability_curve": f"""select class, cast({_upper_bin('score')} as int) as bin, count(*) as n,
        round(avg(score), 6) as mean_predicted, round(avg(hit), 6) as fraction_positive
      from ({LONG}) group by 1, 2""",
    "fairness_by_group": FAIR,
    "fairness_summary": f"""select count(*) as n_groups, max(f1_macro) as max_f1_macro,
        min(f1_macro) as min_f1_macro, round(max(f1_macro) - min(f1_macro), 4) as disparity_gap,
        arg_min("group", f1_macro) as worst_group, arg_max("group", f1_macro) as best_group,
        'ok' as status from ({FAIR})""",
    "score_stability": """select strftime(ts, '%Y-%m-%d') as period, round(avg(value), 6) as mean_score,
        round(stddev_pop(value), 6) as std_score, round(quantile_cont(value, 0.1), 6) as p10,
        round(quantile_cont(value, 0.5), 6) as p50, round(quantile_cont(value, 0.9), 6) as p90
      from events group by 1""",
    "performance_stability": _group_metrics("period", "period", 0),
    "error_patterns": f"select * from {PATTERNS}",
    "confidence_by_correctness": _hist40("right", "=") + " union all " + _hist40("wrong", "<>"),
    "low_confidence_error_rate": f"""select count(*) as n, count(*) filter (confidence < 0.6) as n_low,
        round(count(*) filter (confidence < 0.6) / count(*), 6) as low_share,
        round(avg({ERR}) filter (confidence < 0.6), 6) as error_rate_low,
        round(avg({ERR}) filter (confidence >= 0.6), 6) as error_rate_high from {S}""",
    "error_rate_by_confidence_bin": f"""select cast(g.b as int) as bin, round(g.b / 10, 6) as lo,
        round((g.b + 1) / 10, 6) as hi, count(key) as n, round(avg({ERR}) filter (key is not null), 6) as error_rate
      from (select unnest(range(0, 10)) as b) as g
      left join (select *, {_upper_bin('confidence')} as bin from {S}) as s on s.bin = g.b group by g.b""",
    "business_impact": f"""select 'A' as type, count(*) filter (y_true = 0 and y_pred = 2) as errors,
        count(*) filter (y_true = 0) as of_class,
        round(count(*) filter (y_true = 0 and y_pred = 2) / count(*) filter (y_true = 0), 6) as rate from {S}
      union all select 'B', count(*) filter (y_true = 2 and y_pred = 0), count(*) filter (y_true = 2),
        round(count(*) filter (y_true = 2 and y_pred = 0) / count(*) filter (y_true = 2), 6) from {S}
      union all select 'C', count(*) filter (y_true = 1 and y_pred <> 1), count(*) filter (y_true = 1),
        round(count(*) filter (y_true = 1 and y_pred <> 1) / count(*) filter (y_true = 1), 6) from {S}""",
    "metrics_long": f"select '1.0.0' as model_version, 'validation' as split, metric, value "
                    f"from ({_report(4)})",
    "overall_error_rate": f"""select count(*) as n, count(*) filter (y_true <> y_pred) as errors,
        round(avg({ERR}) * 100, 4) as error_pct,
        round(avg(case when confidence < 0.6 then 1.0::double else 0 end) * 100, 4) as low_conf_pct,
        (select pattern from {PATTERNS} order by n desc, pattern limit 1) as most_common_error from {S}""",
    "feature_means_by_correctness": " union all ".join(
        f"""select '{c}' as feature, round(a, 6) as mean_right, round(b, 6) as mean_wrong,
          round((b - a) / (abs(a) + 1e-9) * 100, 6) as diff_pct from (
          select avg({c}) filter (y_true = y_pred) as a, avg({c}) filter (y_true <> y_pred) as b
          from {S} join orders on o_orderkey = key)""" for c in ("o_totalprice", "o_custkey")),
    "head_sample": f"select key, y_true, y_pred, y_true = y_pred as correct, p0, p1, p2 "
                   f"from {S} order by key limit 200",
    "apply_decision": f"""select key, name as predicted_class, y_pred as predicted_label,
        case when confidence < 0.6 then bracket || ' (low confidence)' else bracket end as decision,
        case when confidence < 0.6 then 'manual_review' else action end as action,
        risk as risk_level, round(confidence, 4) as confidence, round(p0, 4) as p_poor,
        round(p1, 4) as p_standard, round(p2, 4) as p_good
      from {S} join (values (0, 'Poor', 'High Risk', 'reject', 3), (1, 'Standard', 'Medium Risk',
        'manual_review', 2), (2, 'Good', 'Low Risk', 'approve', 1)) as pol(code, name, bracket, action, risk)
        on code = y_pred""",
    "soft_vote": f"""select key, round(v0, 6) as p0, round(v1, 6) as p1, round(v2, 6) as p2,
        {arg_max_sql('v0', 'v1', 'v2')} as y_pred from (select key, (pa0 + pb0) / 2 as v0,
        (pa1 + pb1) / 2 as v1, (pa2 + pb2) / 2 as v2 from {S})""",
    "prediction_distribution": f"""select name as class, count(key) as n,
        round(count(key) * 100.0::double / sum(count(key)) over (), 2) as pct
      from {CLASS_ROWS} left join {S} on y_pred = code group by name""",
    "confidence_profile": f"""select round(avg(confidence), 4) as mean,
        round(quantile_cont(confidence, 0.1), 4) as p10, round(quantile_cont(confidence, 0.25), 4) as p25,
        round(quantile_cont(confidence, 0.75), 4) as p75, round(quantile_cont(confidence, 0.9), 4) as p90,
        round(avg(case when confidence < 0.6 then 1.0::double else 0 end) * 100, 2) as low_conf_pct from {S}""",
    "scoring_summary": f"""select count(*) as rows,
        round(count(*) filter (y_pred = 0) / count(*), 3) as share_poor,
        round(count(*) filter (y_pred = 1) / count(*), 3) as share_standard,
        round(count(*) filter (y_pred = 2) / count(*), 3) as share_good,
        (select case when n_drift > 0 then 'drift' when n_warning > 0 then 'warning' else 'stable' end
         from ({dq.PSI_SUMMARY})) as drift_status from {S}""",
}
