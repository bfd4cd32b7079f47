"""Two derived views the catalogue runs on, one text for both SQL engines.

The driver tables carry no dirt and no model scores, so both are made from them by
fixed rules on the keys: ``dirty`` has one row per customer with text-typed numbers,
sentinels and gaps; ``scores`` has one row per order with two sets of class
probabilities. Both grow with the tables.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

LABEL_CODES = {"Poor": 0, "Standard": 1, "Good": 2}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@dataclass(frozen=True)
class Dialect:
    spark: bool

    def two_places(self, x: str) -> str:
        text = f"format_string('%.2f', {x})" if self.spark else f"printf('%.2f', {x})"
        return f"case when {x} is not null then {text} end"

    def hex4(self, digest: str, start: int) -> str:
        part = f"substr({digest}, {start}, 4)"
        if self.spark:
            return f"cast(conv({part}, 16, 10) as bigint)"
        return f"cast('0x' || {part} as bigint)"

    def div(self, a: str, b: str) -> str:
        return f"(({a}) div ({b}))" if self.spark else f"(({a}) // ({b}))"

    def name(self, table_name: str) -> str:
        return "{" + table_name + "}" if self.spark else table_name


SPARK, DUCK = Dialect(True), Dialect(False)

DIRTY_COLUMNS = ["id", "name", "age_txt", "income_txt", "loans_txt", "limit_txt", "balance_txt",
                 "history_txt", "salary", "cards", "occupation", "mix", "label"]


def dirty_sql(d: Dialect) -> str:
    return f"""
select
  c_custkey as id,
  c_name as name,
  case when c_custkey % 97 = 0 then '-500' when c_custkey % 89 = 0 then '200'
       when c_custkey % 11 = 0 then cast(18 + c_custkey % 60 as string) || '_'
       else cast(18 + c_custkey % 60 as string) end as age_txt,
  case when c_custkey % 13 = 0 then ({d.two_places('total')}) || '_'
       else {d.two_places('total')} end as income_txt,
  case when c_custkey % 31 = 0 then '-100'
       when c_custkey % 9 = 0 then cast(coalesce(n_orders, 0) as string) || '_'
       else cast(coalesce(n_orders, 0) as string) end as loans_txt,
  case when c_custkey % 17 = 0 then '_' else {d.two_places('c_acctbal')} end as limit_txt,
  case when c_custkey % 19 = 0 then '__-333333333333333333333333333__'
       else {d.two_places('c_acctbal')} end as balance_txt,
  case when c_custkey % 23 = 0 then 'NA' when c_custkey % 7 = 0 then null
       else cast(c_custkey % 30 as string) || ' Years and '
            || cast(c_custkey % 12 as string) || ' Months' end as history_txt,
  case when c_custkey % 7 = 0 then null when c_custkey % 41 = 0 then cast(0 as double)
       else cast({d.div('cast(round(spend * 100) as bigint)', '12')} as double) / 100 end as salary,
  cast(case when c_custkey % 101 = 0 then 1499 else c_custkey % 9 end as bigint) as cards,
  case when c_custkey % 17 = 0 then '_______' else c_mktsegment end as occupation,
  case when c_custkey % 5 = 0 then '_' when c_custkey % 3 = 0 then 'Bad'
       when c_custkey % 3 = 1 then 'Standard' else 'Good' end as mix,
  case when c_custkey % 211 = 0 then 'Unknown' when last_status = 'F' then 'Poor'
       when last_status = 'O' then 'Standard' when last_status = 'P' then 'Good' end as label
from {d.name('customer')}
left join (
  select o_custkey, count(*) as n_orders, sum(o_totalprice) as total,
         max_by(o_orderstatus, cast(cast(o_orderdate as date) as string)
                || lpad(cast(o_orderkey as string), 18, '0')) as last_status
  from {d.name('orders')} group by o_custkey) as o on o.o_custkey = c_custkey
left join (
  select o_custkey, sum(spend) as spend
  from (select l_orderkey, sum(l_extendedprice) as spend
        from {d.name('lineitem')} group by l_orderkey) as per_order
  join {d.name('orders')} on o_orderkey = l_orderkey
  group by o_custkey) as l on l.o_custkey = c_custkey
"""


def dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(dirty_sql(SPARK), **{
        t: table(spark, sf_dir, t) for t in ("customer", "orders", "lineitem")})


# Weight added to the drawn score of the true class, per score set.
TRUE_CLASS_BONUS = {"a": 30000, "b": 55000}


def scores_sql(d: Dialect) -> str:
    """Probabilities are whole ten-thousandths, so ties and bin-edge values occur."""
    drawn, shares, probs = [], [], []
    for s, bonus in TRUE_CLASS_BONUS.items():
        for k in range(3):
            drawn.append(f"{d.hex4(f'h_{s}', 1 + 4 * k)} + case when y_true = {k} "
                         f"then {bonus} else 0 end as {s}{k}")
        whole = f"{s}0 + {s}1 + {s}2"
        shares += [f"{d.div(f'{s}{k} * 10000', whole)} as i{s}{k}" for k in range(2)]
        probs += [f"cast(i{s}0 as double) / 10000 as p{s}0",
                  f"cast(i{s}1 as double) / 10000 as p{s}1",
                  f"cast(10000 - i{s}0 - i{s}1 as double) / 10000 as p{s}2"]
    return f"""
select key, custkey, y_true, {', '.join(probs)},
  case when key % 53 <> 0 then c_mktsegment end as grp,
  cast(year(o_orderdate) as string) || '-Q' || cast(quarter(o_orderdate) as string) as period,
  case when o_orderdate < cast('1998-07-01' as timestamp) then 'reference' else 'current' end as part
from (
  select *, {', '.join(shares)} from (
    select *, {', '.join(drawn)} from (
      select o_orderkey as key, o_custkey as custkey, o_orderdate,
        cast(case o_orderstatus when 'F' then 0 when 'O' then 1 else 2 end as int) as y_true,
        md5(cast(o_orderkey as string) || '-a') as h_a,
        md5(cast(o_orderkey as string) || '-b') as h_b
      from {d.name('orders')}) as q0) as q1) as q2
left join {d.name('customer')} on c_custkey = custkey
"""


def scores(spark: SparkSession, sf_dir: str, sets: str = "a") -> DataFrame:
    """Score view with an array ``probs_<set>`` per wanted set; ``probs`` is the first.

    The one-row inline is a fence: a filter on a value derived from the scores stays above
    it, instead of being pushed down as a copy of the whole digest arithmetic.
    """
    wide = spark.sql(scores_sql(SPARK), **{
        t: table(spark, sf_dir, t) for t in ("orders", "customer")})
    arrays = F.struct(*[
        F.array(*[f"p{s}{k}" for k in range(3)]).alias(f"probs_{s}") for s in sets])
    fenced = wide.select("key", "custkey", "y_true", "grp", "period", "part",
                         F.inline(F.array(arrays)))
    return fenced.withColumn("probs", F.col(f"probs_{sets[0]}"))


def arg_max_sql(p0: str, p1: str, p2: str) -> str:
    return (f"cast(case when {p0} >= {p1} and {p0} >= {p2} then 0 "
            f"when {p1} >= {p2} then 1 else 2 end as int)")


def duck_scores(which: str = "a") -> str:
    """Score view for the SQL side: p0..p2, y_pred and confidence added."""
    p = [f"p{which}{k}" for k in range(3)]
    return (f"select *, {p[0]} as p0, {p[1]} as p1, {p[2]} as p2, "
            f"{arg_max_sql(*p)} as y_pred, greatest({', '.join(p)}) as confidence "
            f"from ({scores_sql(DUCK)}) as base")
