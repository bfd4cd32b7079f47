"""Sources and sinks, contracts, cleaning, splits, nested records."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyframe.functions import columns as fx
from tallyframe.operators import cleaning, dictionary, quality, splits
from tallyframe.operators.order import quantile_table
from tallyframe.plans.presets import DEMO_CONTRACT, DEMO_RULES
from tallyframe.plans import sql_text as q
from tallyframe.plans.views import DIRTY_COLUMNS, dirty, table
from tallyframe.sources import tables as io

STAMP = "2024-02-01T00:00:00"
NUMERIC_TEXT = ["age_txt", "income_txt", "loans_txt", "limit_txt", "balance_txt"]
CUSTOMER_SCHEMA = ("c_custkey bigint, c_name string, c_nationkey int, c_acctbal string, "
                   "c_mktsegment string")


# -- sources and sinks --------------------------------------------------------

def scan_csv_contract(spark, sf):
    path = io.scratch_path(spark, "customer_csv")
    table(spark, sf, "customer").write.option("header", True).option("escape", '"').csv(path)
    return io.read_csv(spark, path, CUSTOMER_SCHEMA).select(
        "c_custkey", "c_name", "c_nationkey", fx.text_to_number("c_acctbal").alias("c_acctbal"),
        "c_mktsegment")


def scan_by_suffix(spark, sf):
    path = io.scratch_path(spark, "nation_csv")
    table(spark, sf, "nation").write.option("header", True).csv(path)
    nations = io.read_table(spark, path, "n_nationkey int, n_name string, n_regionkey int")
    customers = io.read_table(spark, f"{sf}/customer.parquet")
    return (customers.join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
            .groupBy("n_name").agg(F.count("*").alias("customers"),
                                   F.round(F.sum("c_acctbal"), 2).alias("balance")))


def sink_parquet(spark, sf):
    path = io.scratch_path(spark, "features") + "/features.parquet"
    io.write_parquet(cleaning.clean(dirty(spark, sf), DEMO_RULES), path)
    return io.read_table(spark, path)


def _order_split(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    return splits.stratified_split(orders, "o_orderkey", "o_orderpriority",
                                   {"train": 0.7, "valid": 0.15, "test": 0.15})


def sink_csv_splits(spark, sf):
    path = io.scratch_path(spark, "splits")
    io.write_splits(_order_split(spark, sf), path)
    back = io.read_csv(spark, path, "o_orderkey bigint, o_orderpriority string, "
                                    "o_totalprice double, split string")
    return back.groupBy("split").agg(F.count("*").alias("n"), F.sum("o_orderkey").alias("keys"),
                                     F.round(F.sum("o_totalprice"), 2).alias("price"))


def report_json_roundtrip(spark, sf):
    """A nested report with a date, a decimal and bytes; a value that came back changed loses its row."""
    rates = quality.null_rates(dirty(spark, sf))
    stats = F.struct(*[c for c in rates.columns if c != "feature"])
    extra = F.struct(F.lit("2024-02-01").cast("date").alias("day"), F.expr("12.50BD").alias("cost"),
                     F.col("feature").cast("binary").alias("raw"), F.array(F.lit(1), F.lit(2)).alias("list"))
    report = rates.select("feature", stats.alias("stats"), extra.alias("extra"))
    path = io.scratch_path(spark, "report")
    io.as_document(report).write.text(path)
    docs = spark.read.text(path).withColumnRenamed("value", "document")
    back = io.from_document(docs, report.schema).where(
        "extra.day = date'2024-02-01' and extra.cost = 12.50 and cast(extra.raw as string) = feature "
        "and extra.list = array(1, 2)")
    return back.select("feature", "stats.*").select(*rates.columns)


def append_report(spark, sf):
    path = io.scratch_path(spark, "reports")
    for day in ("2024-02-01", "2024-02-02", "2024-02-01"):  # the first run is repeated
        report = quality.null_rates(table(spark, sf, "orders"))
        io.append_report(report, path, f"{day}T00:00:00", "stable")
    return spark.read.parquet(path).select(
        "feature", "rows", "missing", "timestamp", "overall_status",
        F.col("report_date").cast("string").alias("report_date"))


def cached_features(spark, sf):
    path = io.scratch_path(spark, "cached")

    def compute():
        return cleaning.clean(dirty(spark, sf), DEMO_RULES)

    io.cached(spark, path, compute)
    return io.cached(spark, path, compute)


# -- contracts and quality ----------------------------------------------------

def schema_diff(spark, sf):
    raw = dirty(spark, sf).drop("name", "salary", "mix").withColumnRenamed("cards", "n_cards")
    return quality.schema_diff(raw, DEMO_CONTRACT)


ALL_TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
              "pages benchmark labels conversations").split()


def min_row_count(spark, sf):
    names = ALL_TABLES
    parts = [quality.row_count_check(table(spark, sf, n), n) for n in names]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def null_rate_profile(spark, sf):
    return quality.null_rates(dirty(spark, sf))


def _gappy(spark, sf):
    """Two more columns, 50 % and 90 % empty, so that every severity occurs."""
    return dirty(spark, sf).withColumns({
        "half": F.expr("if(id % 2 = 0, id, null)"), "tenth": F.expr("if(id % 10 = 0, id, null)")})


def null_severity(spark, sf):
    return quality.null_severity(quality.null_rates(_gappy(spark, sf)))


def unexpected_labels(spark, sf):
    return quality.unexpected_values(table(spark, sf, "orders"), "o_orderstatus", ["F", "O"])


def contract_gate(spark, sf):
    v = quality.verdict(_gappy(spark, sf), DEMO_CONTRACT)
    return v.select("passed", "row_count", "col_count",
                    F.array_join("errors", "; ").alias("errors"),
                    F.array_join("warnings", "; ").alias("warnings"))


def range_violations(spark, sf):
    return quality.range_violations(dirty(spark, sf), DEMO_CONTRACT.ranges)


def _early_late(spark, sf):
    orders = table(spark, sf, "orders")
    flag = "concat(o_orderpriority, if(year(o_orderdate) >= 2000, '-NEW', ''))"
    marked = orders.select("o_orderdate", "o_orderstatus", F.expr(flag).alias("priority"))
    cut = F.lit("1999-01-01").cast("timestamp_ntz")
    return marked.where(F.col("o_orderdate") < cut), marked.where(F.col("o_orderdate") >= cut)


def unseen_categories(spark, sf):
    early, late = _early_late(spark, sf)
    cols = ["priority", "o_orderstatus"]
    return quality.unseen_categories(late, quality.category_values(early, cols), cols)


def category_sets(spark, sf):
    """Every value of every column as a row with its code."""
    return dictionary.Dictionary.fit(dirty(spark, sf), DEMO_CONTRACT.categories).codes(spark)


def _quality_report(spark, sf):
    raw = dirty(spark, sf)
    train = raw.where(q.TRAIN + " and occupation <> 'MACHINERY'")
    return quality.input_quality(
        raw.where("not (" + q.TRAIN + ")"), DEMO_CONTRACT.ranges,
        quality.category_values(train, DEMO_CONTRACT.categories), DEMO_CONTRACT.categories,
        "batch", STAMP)


def input_quality_alerts(spark, sf):
    return quality.input_alerts(_quality_report(spark, sf))


def record_constraints(spark, sf):
    accepted, rejected = quality.quarantine(
        dirty(spark, sf).select("id", "limit_txt", "balance_txt", "salary"),
        ["limit_txt", "balance_txt", "salary"])
    return accepted.select("id", F.lit("accepted").alias("verdict"), F.lit("").alias("violations")
                           ).unionByName(rejected.select(
                               "id", F.lit("rejected").alias("verdict"),
                               F.array_join("violations", "; ").alias("violations")))


# -- cleaning -----------------------------------------------------------------

def drop_pii(spark, sf):
    return cleaning.drop_columns(table(spark, sf, "customer"), ["c_name", "ssn"])


def _by_id(expr, *names):
    return lambda spark, sf: dirty(spark, sf).select("id", *[expr(n).alias(n) for n in names])


def coerce_strip_char(spark, sf):
    return _by_id(lambda n: fx.without_char(n, "_"), *NUMERIC_TEXT)(spark, sf)


def sentinel_to_null(spark, sf):
    return dirty(spark, sf).select(
        "id", fx.sentinel_null("occupation", "_______").alias("occupation"),
        fx.sentinel_null("mix", "_").alias("mix"),
        fx.text_to_number(fx.sentinel_null("limit_txt", "_")).alias("limit_txt"),
        fx.text_to_number(fx.sentinel_null("balance_txt", "__-333333333333333333333333333__"))
        .alias("balance_txt"), F.col("label"))


def clip_bounds(spark, sf):
    return dirty(spark, sf).select(
        "id", fx.clip(F.col("cards").cast("double"), 0, 20).alias("cards"),
        fx.clip(fx.without_char("loans_txt"), 0, 10).alias("loans_txt"),
        fx.clip("salary", lo=1000).alias("salary_floor"),
        fx.clip("salary", hi=100000).alias("salary_top"))


def quantile_cap(spark, sf):
    lines = table(spark, sf, "lineitem")
    train = lines.where("l_orderkey % 10 < 7")
    cap = quantile_table(train, ["l_extendedprice"], [0.99])["l_extendedprice"][0]
    capped = lines.select("l_returnflag", "l_extendedprice",
                          fx.clip("l_extendedprice", hi=cap).alias("price"))
    return capped.groupBy("l_returnflag").agg(
        F.count("*").alias("n"), F.expr("count_if(price < l_extendedprice)").alias("n_capped"),
        F.round(F.max("price"), 4).alias("max_price"), F.round(F.sum("price"), 1).alias("total"))


def encode_label(spark, sf):
    codes = {"1-URGENT": 0, "2-HIGH": 1, "3-MEDIUM": 2}
    return cleaning.encode_label(
        table(spark, sf, "orders").select("o_orderkey", "o_orderpriority"), "o_orderpriority",
        codes).groupBy("o_orderpriority").agg(
        F.count("*").alias("n"), F.sum("o_orderkey").alias("keys")).select(
        F.coalesce("o_orderpriority", F.lit(-1)).alias("code"), "n", "keys")


def clean_chain(spark, sf):
    raw = dirty(spark, sf)
    caps = cleaning.fit_caps(raw.where(q.TRAIN), DEMO_RULES)
    keyed = raw.withColumn("key", F.col("id"))
    return cleaning.clean(keyed, DEMO_RULES, caps).withColumnRenamed("key", "id").withColumn(
        "income_txt", F.round("income_txt", 4))


# -- splits -------------------------------------------------------------------

def stratified_split3(spark, sf):
    return _order_split(spark, sf).drop("o_totalprice")


def stratified_split2(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    return splits.stratified_split(c, "c_custkey", "c_mktsegment", {"train": 0.8, "valid": 0.2})


def stratified_kfold(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    return splits.stratified_folds(c, "c_custkey", "c_mktsegment", 3)


def seeded_sample_n(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    return splits.seeded_sample(c, "c_custkey", 200)


def class_distribution(spark, sf):
    return splits.class_distribution(dirty(spark, sf).where("label is not null"), "label")


def balanced_class_weights(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return splits.with_class_weights(orders, "o_orderpriority").groupBy("o_orderpriority").agg(
        F.count("*").alias("n"), F.round(F.max("weight"), 6).alias("weight"),
        F.round(F.sum("weight"), 4).alias("total"))


# -- nested records -----------------------------------------------------------

def flatten_struct(spark, sf):
    events = table(spark, sf, "events").select(
        "event_id", F.from_json("props", "k int").alias("props"),
        F.struct(F.col("user_id").alias("user"), F.struct(F.col("value").alias("ms")).alias("cost"))
        .alias("request"))
    flat = io.flatten_struct(events)
    names = [c for c in flat.columns if c != "event_id"]
    numbers = flat.select(*[F.col(f"`{c}`").cast("double").alias(c) for c in names])
    return numbers.unpivot([], [F.col(f"`{c}`") for c in names], "metric", "value").groupBy(
        "metric").agg(F.count("value").alias("n"), F.round(F.sum("value"), 2).alias("total"),
                      F.max("value").alias("max"))


def safe_divide(spark, sf):
    return dirty(spark, sf).select("id", F.round(fx.safe_divide(
        F.col("salary"), F.col("cards").cast("double"), -1.0), 6).alias("salary_per_card"))


QUERIES = {
    "scan_csv_contract": scan_csv_contract, "scan_by_suffix": scan_by_suffix,
    "sink_parquet": sink_parquet, "sink_csv_splits": sink_csv_splits,
    "report_json_roundtrip": report_json_roundtrip, "append_report": append_report,
    "cached_features": cached_features,
    "schema_diff": schema_diff, "min_row_count": min_row_count,
    "null_rate_profile": null_rate_profile, "null_severity": null_severity,
    "unexpected_labels": unexpected_labels, "contract_gate": contract_gate,
    "range_violations": range_violations, "unseen_categories": unseen_categories,
    "category_sets": category_sets, "input_quality_long": _quality_report,
    "input_quality_alerts": input_quality_alerts, "record_constraints": record_constraints,
    "drop_pii": drop_pii,
    "coerce_digits_only": _by_id(fx.digits_only, "age_txt", "income_txt", "balance_txt"),
    "coerce_strip_char": coerce_strip_char, "sentinel_to_null": sentinel_to_null,
    "null_outside_range": _by_id(lambda n: fx.null_outside(fx.digits_only(n), 18, 100), "age_txt"),
    "clip_bounds": clip_bounds, "quantile_cap": quantile_cap,
    "parse_duration_months": _by_id(fx.duration_months, "history_txt"),
    "coerce_keep_decimal": _by_id(fx.digits_and_dot, *NUMERIC_TEXT),
    "encode_label": encode_label, "clean_chain": clean_chain,
    "stratified_split3": stratified_split3, "stratified_split2": stratified_split2,
    "stratified_kfold": stratified_kfold, "seeded_sample_n": seeded_sample_n,
    "class_distribution": class_distribution, "balanced_class_weights": balanced_class_weights,
    "flatten_struct": flatten_struct, "safe_divide": safe_divide,
}


# -- SQL side -----------------------------------------------------------------

CLEAN_NO_ID = f"select * exclude (id) from {q.CLEAN}"


def _null_rates(source: str, columns: list[str]) -> str:
    return " union all ".join(
        f"select '{c}' as feature, count(*) as rows, count(*) - count({c}) as missing, "
        f"round((count(*) - count({c})) / count(*), 4) as missing_rate from {source}"
        for c in columns)


def _split(source: str, key: str, stratum: str, parts: dict[str, float]) -> str:
    done, cases = 0.0, []
    for name, share in list(parts.items())[:-1]:
        done = round(done + share, 12)
        cases.append(f"when r <= floor(cast({done!r} as double) * n + 0.5) then '{name}'")
    return (f"select {key}, {stratum}, case {' '.join(cases)} else '{list(parts)[-1]}' end as split "
            f"from (select *, row_number() over (partition by {stratum} order by "
            f"md5(cast({key} as varchar) || '-42')) as r, count(*) over (partition by {stratum}) as n "
            f"from {source})")


GAPPY = (f"(select *, case when id % 2 = 0 then id end as half, "
         f"case when id % 10 = 0 then id end as tenth from {q.DIRTY})")
SPLIT3 = _split("orders", "o_orderkey", "o_orderpriority",
                {"train": 0.7, "valid": 0.15, "test": 0.15})
PRIORITY = ("(select *, o_orderpriority || case when year(o_orderdate) >= 2000 then '-NEW' "
            "else '' end as priority from orders)")
RANGES = {"age_txt": q.number("age_txt"), "loans_txt": q.number("loans_txt"),
          "cards": "cast(cards as double)", "salary": "salary"}


def _violations(source: str) -> str:
    return " union all ".join(
        f"select '{c}' as feature, count(*) filter (x < {lo} or x > {hi}) as violations "
        f"from (select {RANGES[c]} as x from {source})"
        for c, (lo, hi) in DEMO_CONTRACT.ranges.items())


def _unseen(new: str, old: str, columns: list[str]) -> str:
    return (f"select distinct feature, value from ({q.unpivot(columns, new)}) as n "
            f"where value is not null and not exists (select 1 from ({q.unpivot(columns, old)}) as o "
            f"where o.feature = n.feature and o.value = n.value)")


BATCH = f"(select * from {q.DIRTY} where not ({q.TRAIN}))"
QUALITY = f"""select '{STAMP}' as timestamp, 'batch' as label, metric, feature, value, issue_type from (
  select 'row_count' as metric, 'ALL' as feature, cast(count(*) as double) as value,
         'volume' as issue_type from {BATCH}
  union all select 'missing_rate', feature, missing_rate, 'missing'
    from ({_null_rates(BATCH, DIRTY_COLUMNS)}) where missing > 0
  union all select 'out_of_range_count', feature, cast(violations as double), 'range_violation'
    from ({_violations(BATCH)}) where violations > 0
  union all select 'unseen_category_count', feature, cast(count(*) as double), 'unseen_category'
    from ({_unseen(BATCH, f"(select * from {q.DIRTY} where {q.TRAIN} and occupation <> 'MACHINERY')",
                   ['occupation', 'mix'])}) group by feature)"""


def _severity(source: str) -> str:
    return (f"select *, case when missing / rows > 0.8 then 'error' when missing / rows > 0.4 "
            f"then 'warning' else 'ok' end as severity from ({source})")


GAPPY_COLUMNS = [*DIRTY_COLUMNS, "half", "tenth"]

ORACLES = {
    "scan_csv_contract": "select c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment from customer",
    "scan_by_suffix": "select n_name, count(*) as customers, round(sum(c_acctbal), 2) as balance "
                      "from customer join nation on c_nationkey = n_nationkey group by n_name",
    "sink_parquet": CLEAN_NO_ID,
    "sink_csv_splits": f"""select split, count(*) as n, cast(sum(s.o_orderkey) as bigint) as keys,
        round(sum(o_totalprice), 2) as price from ({SPLIT3}) as s
        join orders as o on o.o_orderkey = s.o_orderkey group by split""",
    "report_json_roundtrip": _null_rates(q.DIRTY, DIRTY_COLUMNS),
    "append_report": "select feature, rows, missing, d || 'T00:00:00' as timestamp, "
                     "'stable' as overall_status, d as report_date from ("
                     + _null_rates("orders", ["o_orderkey", "o_custkey", "o_orderstatus",
                                              "o_totalprice", "o_orderdate", "o_orderpriority"])
                     + ") cross join (values ('2024-02-01'), ('2024-02-02')) as days(d)",
    "cached_features": CLEAN_NO_ID,
    "schema_diff": f"""select 'cards' as "column", 'missing' as issue, count(*) as affected_rows from {q.DIRTY}
        union all select 'mix', 'missing', count(*) from {q.DIRTY}
        union all select 'salary', 'missing', count(*) from {q.DIRTY}
        union all select 'n_cards', 'extra', count(cards) from {q.DIRTY}""",
    "min_row_count": " union all ".join(
        f"select '{n}' as name, count(*) as row_count, count(*) >= 1000 as enough from {n}"
        for n in ALL_TABLES),
    "null_rate_profile": _null_rates(q.DIRTY, DIRTY_COLUMNS),
    "null_severity": _severity(_null_rates(GAPPY, GAPPY_COLUMNS)),
    "unexpected_labels": "select o_orderstatus as value, count(*) as rows from orders "
                         "where o_orderstatus not in ('F', 'O') group by 1",
    "contract_gate": f"""select errors = '' as passed, row_count, col_count, errors,
        'extra columns: half,tenth' || warned || case when odd > 0 then '; unexpected labels: label'
          else '' end as warnings
      from (select max(rows) as row_count, count(*) as col_count,
          concat_ws('; ', case when max(rows) < 1000 then 'too few rows: ' || max(rows) end,
            string_agg('critical missing: ' || feature, '; ' order by feature)
              filter (missing / rows > 0.8)) as errors,
          coalesce(string_agg('; high missing: ' || feature, '' order by feature)
              filter (missing / rows > 0.4), '') as warned
        from ({_null_rates(GAPPY, GAPPY_COLUMNS)}))
      cross join (select count(*) filter (label not in ('Poor', 'Standard', 'Good')) as odd
                  from {q.DIRTY})""",
    "range_violations": _violations(q.DIRTY),
    "unseen_categories": _unseen(f"(select * from {PRIORITY} where o_orderdate >= timestamp '1999-01-01')",
                                 f"(select * from {PRIORITY} where o_orderdate < timestamp '1999-01-01')",
                                 ["priority", "o_orderstatus"]),
    "category_sets": f"""select feature, value,
        cast(row_number() over (partition by feature order by value) - 1 as integer) as code
      from (select distinct feature, value
          from ({q.unpivot(['occupation', 'mix'], q.DIRTY)}) where value is not null)""",
    "input_quality_long": QUALITY,
    "input_quality_alerts": f"""select feature, metric as issue_type, value,
        cast(case when metric = 'missing_rate' then 0.3 else 0 end as double) as threshold,
        case when metric <> 'missing_rate' or value > 0.3 then 'YES' else 'NO' end as alert
      from ({QUALITY}) where metric in ('missing_rate', 'out_of_range_count')""",
    "record_constraints": "select id, case when v = '' then 'accepted' else 'rejected' end as verdict, "
        "v as violations from (select id, concat_ws('; ', " + ", ".join(
            f"case when {x} < 0 then '{c}: negative' when {c} is not null and {x} is null "
            f"then '{c}: not a number' end" for c, x in (
                ("limit_txt", q.number("limit_txt")), ("balance_txt", q.number("balance_txt")),
                ("salary", "salary"))) + f") as v from {q.DIRTY})",
    "drop_pii": "select c_custkey, c_nationkey, c_acctbal, c_mktsegment from customer",
    "coerce_digits_only": f"select id, {q.digits('age_txt')} as age_txt, {q.digits('income_txt')} as "
                          f"income_txt, {q.digits('balance_txt')} as balance_txt from {q.DIRTY}",
    "coerce_strip_char": "select id, " + ", ".join(
        f"""{q.number(f"replace({c}, '_', '')")} as {c}""" for c in NUMERIC_TEXT) + f" from {q.DIRTY}",
    "sentinel_to_null": f"""select id, nullif(occupation, '_______') as occupation,
        nullif(mix, '_') as mix, {q.number("nullif(limit_txt, '_')")} as limit_txt,
        {q.number("nullif(balance_txt, '__-333333333333333333333333333__')")} as balance_txt, label
        from {q.DIRTY}""",
    "null_outside_range": f"select id, case when {q.digits('age_txt')} between 18 and 100 then "
                          f"{q.digits('age_txt')} end as age_txt from {q.DIRTY}",
    "clip_bounds": f"""select id, {q.clip('cast(cards as double)', 0, 20)} as cards,
        {q.clip(q.number("replace(loans_txt, '_', '')"), 0, 10)} as loans_txt,
        {q.clip('salary', 1000, None)} as salary_floor,
        {q.clip('salary', None, 100000)} as salary_top from {q.DIRTY}""",
    "quantile_cap": """select l_returnflag, count(*) as n,
        count(*) filter (l_extendedprice > cap) as n_capped,
        round(max(case when l_extendedprice > cap then cap else l_extendedprice end), 4) as max_price,
        round(sum(case when l_extendedprice > cap then cap else l_extendedprice end), 1) as total
      from lineitem cross join (select quantile_cont(l_extendedprice, 0.99) as cap
                                from lineitem where l_orderkey % 10 < 7) group by l_returnflag""",
    "parse_duration_months": f"select id, {q.months('history_txt')} as history_txt from {q.DIRTY}",
    "coerce_keep_decimal": "select id, " + ", ".join(
        f"""{q.number(f"regexp_replace({c}, '[^0-9.]', '', 'g')")} as {c}""" for c in NUMERIC_TEXT)
        + f" from {q.DIRTY}",
    "encode_label": """select cast(case o_orderpriority when '1-URGENT' then 0 when '2-HIGH' then 1
        when '3-MEDIUM' then 2 else -1 end as int) as code, count(*) as n,
        cast(sum(o_orderkey) as bigint) as keys from orders group by 1""",
    "clean_chain": f"select * exclude (cap) replace (round(income_txt, 4) as income_txt) from {q.CAPPED}",
    "stratified_split3": SPLIT3,
    "stratified_split2": _split("customer", "c_custkey", "c_mktsegment", {"train": 0.8, "valid": 0.2}),
    "stratified_kfold": "select c_custkey, c_mktsegment, cast(split as int) as fold from (" + _split(
        "customer", "c_custkey", "c_mktsegment", {str(i): 1 / 3 for i in range(3)}) + ")",
    "seeded_sample_n": "select c_custkey, c_mktsegment from customer order by "
                       "md5(cast(c_custkey as varchar) || '-42'), c_custkey limit 200",
    "class_distribution": f"""select label as class, count(*) as n,
        round(count(*) * 100.0::double / sum(count(*)) over (), 2) as pct
        from {q.DIRTY} where label is not null group by label""",
    "balanced_class_weights": """select o_orderpriority, n, round(w, 6) as weight, round(n * w, 4) as total
        from (select o_orderpriority, count(*) as n, (sum(count(*)) over () / count(*) over ())
              / count(*) as w from orders group by o_orderpriority)""",
    "flatten_struct": """select 'props.k' as metric, count(k) as n,
          round(cast(sum(k) as double), 2) as total, cast(max(k) as double) as max
        from (select cast(json_extract_string(props, '$.k') as int) as k from events)
      union all select 'request.user', count(user_id), round(cast(sum(user_id) as double), 2),
          cast(max(user_id) as double) from events
      union all select 'request.cost.ms', count(value), round(sum(value), 2), max(value) from events""",
    "safe_divide": f"select id, round(case when cards = 0 then -1 else salary / cards end, 6) "
                   f"as salary_per_card from {q.DIRTY}",
}
