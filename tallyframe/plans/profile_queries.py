"""Profiling on lineitem, the demo view and the score view."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyframe.functions.columns import map_label
from tallyframe.operators import profile
from tallyframe.plans import feature_queries as fq, sql_text as q
from tallyframe.plans.views import DIRTY_COLUMNS, LABEL_CODES, dirty, table

LINE = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
RELATED = [*LINE, "net", "charge"]
STATUSES = ["F", "O", "P"]
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW", "6-NONE"]


def _lines(spark, sf):
    """Numeric line columns plus two that depend on the price."""
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_returnflag", *LINE,
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("net"),
        F.expr("if(l_linenumber % 3 = 0, null, l_extendedprice * (1 + l_tax))").alias("charge"))


def describe_numeric(spark, sf):
    return profile.describe(_lines(spark, sf), LINE)


def value_counts_topk(spark, sf):
    return profile.top_values(table(spark, sf, "lineitem"),
                              ["l_returnflag", "l_suppkey", "l_linenumber", "l_discount"], 15)


def histogram_fixed(spark, sf):
    return profile.histogram(_lines(spark, sf), ["l_quantity", "l_extendedprice"], 50).select(
        "feature", "bin", F.round("lo", 6).alias("lo"), F.round("hi", 6).alias("hi"), "n")


def box_stats_by_class(spark, sf):
    out = profile.box_stats(_lines(spark, sf), ["l_extendedprice", "l_quantity"], "l_returnflag")
    return out.select("l_returnflag", "feature", "n", *[
        F.round(c, 6).alias(c) for c in ("q1", "median", "q3", "low", "high")])


def crosstab_row_pct(spark, sf):
    return profile.crosstab_pct(table(spark, sf, "orders"), "o_orderstatus", "o_orderpriority",
                                STATUSES, PRIORITIES)


def target_correlation_rank(spark, sf):
    df = table(spark, sf, "lineitem").withColumn(
        "target", map_label("l_returnflag", {"A": 0, "N": 1, "R": 2}))
    return profile.target_correlations(
        df, [*LINE, "l_linenumber", "l_partkey", "l_suppkey"], "target")


def eda_insights(spark, sf):
    df = dirty(spark, sf)
    return profile.insights(df, "label", map_label("label", LABEL_CODES), ["salary", "cards", "id"])


def group_avg_importance(spark, sf):
    """Importance here is the absolute correlation with the label code."""
    df = dirty(spark, sf).withColumn("code", map_label("label", LABEL_CODES))
    ranked = profile.target_correlations(df, ["salary", "cards", "id"], "code", 12)
    return profile.group_importance(ranked.withColumnRenamed("abs_r", "importance"),
                                    {"salary": "money", "cards": "accounts"}).withColumn(
        "mean_importance", F.round("mean_importance", 6))


QUERIES = {
    "describe_numeric": describe_numeric, "value_counts_topk": value_counts_topk,
    "histogram_fixed": histogram_fixed, "box_stats_by_class": box_stats_by_class,
    "crosstab_row_pct": crosstab_row_pct,
    "correlation_matrix": lambda s, sf: profile.correlation_matrix(_lines(s, sf), RELATED),
    "target_correlation_rank": target_correlation_rank,
    "high_corr_pairs": lambda s, sf: profile.high_correlations(_lines(s, sf), RELATED, 0.80),
    "iqr_outliers": lambda s, sf: profile.iqr_outliers(
        table(s, sf, "events").select("value", "user_id"), ["value", "user_id"]),
    "variance_rank": lambda s, sf: profile.variance_rank(_lines(s, sf), LINE),
    "group_avg_importance": group_avg_importance,
    "missing_report": lambda s, sf: profile.missing_report(dirty(s, sf)),
    "eda_insights": eda_insights,
}

LINES = """(select *, l_extendedprice * (1 - l_discount) as net,
  case when l_linenumber % 3 <> 0 then l_extendedprice * (1 + l_tax) end as charge from lineitem)"""


def _hist(c: str, bins: int) -> str:
    return f"""select '{c}' as feature, cast(b as int) as bin, round(l, 6) as lo, round(h, 6) as hi,
        count(x) as n
      from (select b, lo + b * w as l, case when b = {bins} - 1 then hi else lo + (b + 1) * w end as h, hi
        from (select lo, hi, (hi - lo) / {bins} as w, unnest(range(0, {bins})) as b
          from (select min({c}) as lo, max({c}) as hi from lineitem))) as grid
      left join (select {c} as x from lineitem) as v on x >= l and (x < h or (b = {bins} - 1 and x = h))
      group by b, l, h"""


def _box(c: str) -> str:
    return f"""select l_returnflag, '{c}' as feature, max(n) as n, round(max(q1), 6) as q1,
        round(max(q2), 6) as median, round(max(q3), 6) as q3,
        round(min({c}) filter ({c} >= q1 - 1.5 * (q3 - q1)), 6) as low,
        round(max({c}) filter ({c} <= q3 + 1.5 * (q3 - q1)), 6) as high
      from lineitem join (select l_returnflag as f, count({c}) as n, quantile_cont({c}, 0.25) as q1,
          quantile_cont({c}, 0.5) as q2, quantile_cont({c}, 0.75) as q3 from lineitem group by 1)
        on f = l_returnflag group by l_returnflag"""


def _target(columns: list[str], source: str, target: str) -> str:
    return " union all ".join(
        f"select '{c}' as feature, round(abs(corr(cast({c} as double), {target})), 6) as abs_r "
        f"from {source}" for c in columns)


CODE = "cast(case label when 'Poor' then 0 when 'Standard' then 1 when 'Good' then 2 end as double)"
MISSING = " union all ".join(
    f"select '{c}' as feature, m as missing, round(m * 100.0::double / n, 2) as pct from "
    f"(select count(*) as n, count(*) - count({c}) as m from {q.DIRTY}) where m > 0"
    for c in DIRTY_COLUMNS)
PAIRS = [(a, b) for i, a in enumerate(RELATED) for b in RELATED[i + 1:]]

ORACLES = {
    "describe_numeric": " union all ".join(
        f"""select '{c}' as feature, count({c}) as count, round(avg({c}), 6) as mean,
          round(stddev_samp({c}), 6) as std, min({c}) as min, round(quantile_cont({c}, 0.25), 6) as p25,
          round(quantile_cont({c}, 0.5), 6) as p50, round(quantile_cont({c}, 0.75), 6) as p75,
          max({c}) as max from lineitem""" for c in LINE),
    "value_counts_topk": f"""select feature, value, n, cast(rank as int) as rank,
        round(n * 100.0::double / (select count(*) from lineitem), 2) as pct from (
        select feature, value, count(*) as n, row_number() over (partition by feature
          order by count(*) desc, value) as rank
        from ({q.unpivot(['l_returnflag', 'l_suppkey', 'l_linenumber', 'l_discount'], 'lineitem')})
        group by feature, value) where rank <= 15""",
    "histogram_fixed": _hist("l_quantity", 50) + " union all " + _hist("l_extendedprice", 50),
    "box_stats_by_class": _box("l_extendedprice") + " union all " + _box("l_quantity"),
    "crosstab_row_pct": "select o_orderstatus, " + ", ".join(
        f"""round(count(*) filter (o_orderpriority = '{p}') * 100.0::double / count(*), 4) as "{p}" """
        for p in PRIORITIES) + " from orders where o_orderstatus in ('F', 'O', 'P') group by 1",
    "correlation_matrix": " union all ".join(
        [f"select '{a}' as x, '{b}' as y, round(corr({a}, {b}), 6) as r from {LINES}" for a, b in PAIRS]
        + [f"select '{b}', '{a}', round(corr({a}, {b}), 6) from {LINES}" for a, b in PAIRS]
        + [f"select '{c}', '{c}', 1.0::double" for c in RELATED]),
    "target_correlation_rank": "select * from (" + _target(
        [*LINE, "l_linenumber", "l_partkey", "l_suppkey"], "lineitem",
        "cast(case l_returnflag when 'A' then 0 when 'N' then 1 when 'R' then 2 end as double)")
        + ") order by abs_r desc, feature limit 12",
    "high_corr_pairs": "select x, y, round(r, 4) as r from (" + " union all ".join(
        f"select '{a}' as x, '{b}' as y, corr({a}, {b}) as r from {LINES}" for a, b in PAIRS)
        + ") where abs(r) > 0.8",
    "iqr_outliers": " union all ".join(
        f"""select '{c}' as feature, round(q1, 6) as q1, round(q3, 6) as q3, round(lo, 6) as lower,
          round(hi, 6) as upper, count(*) filter ({c} < lo or {c} > hi) as outliers,
          round(count(*) filter ({c} < lo or {c} > hi) * 100.0::double / count(*), 2) as pct
        from events cross join (select q1, q3, q1 - 1.5 * (q3 - q1) as lo, q3 + 1.5 * (q3 - q1) as hi
          from (select quantile_cont({c}, 0.25) as q1, quantile_cont({c}, 0.75) as q3 from events))
        group by q1, q3, lo, hi""" for c in ("value", "user_id")),
    "variance_rank": " union all ".join(
        f"select '{c}' as feature, round(var_samp({c}), 6) as variance from lineitem" for c in LINE),
    "group_avg_importance": f"""select case feature when 'salary' then 'money' when 'cards' then
        'accounts' else 'other' end as feature_group, round(avg(abs_r), 6) as mean_importance,
        count(*) as n from ({_target(['salary', 'cards', 'id'], q.DIRTY, CODE)}) group by 1""",
    "missing_report": MISSING,
    "eda_insights": f"""select (select count(*) from customer) as rows, cast(13 as bigint) as n_columns,
        count(*) as columns_with_missing,
        (select feature from ({MISSING}) order by missing desc, feature limit 1) as worst_column,
        (select string_agg(label || '=' || n, ',' order by label) from (select label, count(*) as n
          from {q.DIRTY} where label is not null group by label)) as class_counts,
        (select feature from ({_target(['salary', 'cards', 'id'], q.DIRTY, CODE)})
          order by abs_r desc, feature limit 1) as strongest_predictor
      from ({MISSING})""",
}
