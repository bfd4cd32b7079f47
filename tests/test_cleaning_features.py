"""Pinned cleaning and feature cases, and the fitted chain on the credit contract."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.functions import columns as fx
from tallyframe.operators import cleaning, drift, features, quality
from tallyframe.operators.order import local_rows
from tallyframe.plans import presets


def credit_schema():
    kinds = {**{c: T.DoubleType() for c in presets.CREDIT_DOUBLES},
             **{c: T.LongType() for c in presets.CREDIT_LONGS}}
    return T.StructType([T.StructField(c, kinds.get(c, T.StringType()))
                         for c in presets.CREDIT_COLUMNS])


def record(**given):
    base = dict(
        ID="1", Customer_ID="c", Month="May", Name="n", Age="25", SSN="s", Occupation="Lawyer",
        Annual_Income="50000", Monthly_Inhand_Salary=4000.0, Num_Bank_Accounts=3, Num_Credit_Card=4,
        Interest_Rate=7, Num_of_Loan="2", Type_of_Loan="Auto", Delay_from_due_date=3,
        Num_of_Delayed_Payment="4", Changed_Credit_Limit="9.5", Num_Credit_Inquiries=2.0,
        Credit_Mix="Good", Outstanding_Debt="800", Credit_Utilization_Ratio=31.0,
        Credit_History_Age="22 Years and 3 Months", Payment_of_Min_Amount="No",
        Total_EMI_per_month=50.0, Amount_invested_monthly="80", Payment_Behaviour="High_spent",
        Monthly_Balance="300", Credit_Score="Poor")
    return tuple({**base, **given}[c] for c in presets.CREDIT_COLUMNS)


@pytest.fixture(scope="module")
def two_rows(spark):
    return spark.createDataFrame([
        record(),
        record(ID="2", Age="30_", Annual_Income="50000_", Credit_History_Age="NA", Credit_Mix="_",
               Payment_of_Min_Amount="NM", Payment_Behaviour="!@9#%8", Num_Bank_Accounts=1500,
               Monthly_Balance="__-333333333333333333333333333__", Delay_from_due_date=-1,
               Amount_invested_monthly="__10000__", Num_of_Loan="-100", Credit_Score="Good"),
    ], credit_schema())


def test_credit_cleaning(two_rows):
    rules = presets.CREDIT_RULES
    caps = cleaning.fit_caps(two_rows, rules)
    assert caps == {"Annual_Income": 50000.0}
    a, b = cleaning.clean(two_rows.orderBy("ID"), rules, caps).collect()
    assert not set(presets.CREDIT_IDENTIFIERS) & set(a.asDict())
    assert (a["Age"], b["Age"]) == (25, 30)
    assert b["Annual_Income"] == 50000.0
    assert (a["Credit_History_Age"], b["Credit_History_Age"]) == (267, None)
    assert b["Credit_Mix"] is b["Payment_of_Min_Amount"] is b["Payment_Behaviour"] is None
    assert b["Monthly_Balance"] is None and b["Amount_invested_monthly"] is None
    assert b["Num_Bank_Accounts"] == 20 and b["Num_of_Loan"] == 0
    assert b["Delay_from_due_date"] == 0
    assert (a["Credit_Score"], b["Credit_Score"]) == (0, 2)


def test_credit_contract(two_rows):
    row = quality.verdict(two_rows, presets.CREDIT_CONTRACT).first()
    assert not row["passed"] and row["errors"] == ["too few rows: 2"]
    with pytest.raises(quality.ContractError):
        quality.require(two_rows.drop("Age"), presets.CREDIT_CONTRACT)
    missing = quality.schema_diff(two_rows.drop("Age", "SSN", "Credit_Score"),
                                  presets.CREDIT_CONTRACT, has_label=False)
    assert [tuple(r) for r in missing.collect()] == [("Age", "missing", 2)]


@pytest.mark.parametrize("text, number", [
    ("12", 12.0), (" 1.5 ", 1.5), ("-3.", -3.0), (".5", 0.5), ("1e3", 1000.0), ("12_", None),
    ("1d", None), ("1_000", None), ("nan", None), ("inf", None), ("", None), ("-", None), (None, None)])
def test_text_to_number(spark, text, number):
    df = local_rows(spark, [(text,)], {"x": "string"})
    assert df.select(fx.text_to_number("x")).first()[0] == number


def test_column_functions(spark):
    df = local_rows(spark, [("-500", "28.5", 22.0, 0.0)], {"a": "string", "b": "string",
                                                          "x": "double", "z": "double"})
    row = df.select(
        fx.digits_only("a"), fx.digits_only("b"), fx.digits_and_dot("b"), fx.clip("x", None, 20),
        fx.clip(F.lit(None).cast("double"), 0, 20), fx.ratio("x", "z"), fx.safe_divide("x", "z", -1.0),
        fx.null_outside("x", 18, 22), fx.finite(F.lit(float("nan")))).first()
    assert tuple(row) == (500.0, 285.0, 28.5, 20.0, None, 0.0, -1.0, 22.0, None)


def test_small_encoders(spark):
    mix = local_rows(spark, [("Good",), ("Bad",), ("Standard",), (None,)], {"m": "string"})
    codes = mix.select(fx.map_label("m", {"Bad": 0, "Standard": 1, "Good": 2}))
    assert [r[0] for r in codes.collect()] == [2, 0, 1, None]
    known = features.fit_categories(local_rows(spark, [("A",), ("B",)], {"o": "string"}), ["o"])
    out = features.one_hot(local_rows(spark, [("A",), ("C",), (None,)], {"o": "string"}), known)
    assert out.columns == ["o_A", "o_B"]
    assert [tuple(r) for r in out.collect()] == [(True, False), (False, False), (False, False)]


def test_medians_and_modes(spark):
    df = local_rows(spark, [(1.0, "A"), (2.0, "A"), (None, "B"), (4.0, None)],
                    {"x": "double", "s": "string"})
    assert features.fit_medians(df, ["x", "absent"]) == {"x": 2.0}
    assert features.fit_modes(df, ["s"]) == {"s": "A"}
    tie = local_rows(spark, [("b",), ("a",)], {"s": "string"})
    empty = local_rows(spark, [(None,)], {"s": "string"})
    assert features.fit_modes(tie, ["s"]) == {"s": "a"}
    assert features.fit_modes(empty, ["s"]) == {"s": ""}


def test_variance_selection(spark):
    df = spark.range(100).select(
        F.col("id").cast("double").alias("wide"), F.lit(1.0).alias("flat"),
        (F.col("id") == 0).alias("flag"), F.lit(0).alias("y"))
    assert features.select_by_variance(df, label="y") == ["wide", "flag", "y"]
    assert features.select_by_variance(df, label="y", include_boolean=True, threshold=0.05) == ["wide", "y"]


@pytest.fixture(scope="module")
def credit(spark):
    rng = random.Random(1)
    jobs, spend = ["Lawyer", "Doctor", "Writer", "_______"], ["High_spent", "Low_spent", "!@9#%8"]
    rows = [record(
        ID=str(i), Age=f"{rng.randint(15, 70)}_", Occupation=rng.choice(jobs),
        Annual_Income=str(rng.randint(1, 99) * 1000), Monthly_Inhand_Salary=rng.choice([None, 0.0, 3000.5]),
        Num_of_Loan=str(rng.randint(-5, 12)), Num_Credit_Card=rng.randint(0, 40),
        Credit_Mix=rng.choice(["Good", "Bad", "_"]), Payment_of_Min_Amount=rng.choice(["NM", "Yes", "No"]),
        Credit_History_Age=rng.choice(["NA", "3 Years and 2 Months"]), Outstanding_Debt=f"{rng.randint(0, 5000)}_",
        Payment_Behaviour=rng.choice(spend), Credit_Score=rng.choice(["Poor", "Standard", "Good"]))
        for i in range(400)]
    return spark.createDataFrame(rows, credit_schema())


def test_credit_chain_leaves_no_gaps(credit):
    train, test = credit.where("cast(ID as int) % 10 < 7"), credit.where("cast(ID as int) % 10 >= 7")
    state = features.FittedFeatures.fit(train, presets.CREDIT_SPEC)
    assert "Occupation_Lawyer" in state.features and "Type_of_Loan" not in state.features
    matrix = state.transform(test.withColumn("Occupation", F.lit("Astronaut")), ["ID"])
    assert matrix.columns == ["ID", *state.features]
    assert quality.null_rates(matrix).where("missing > 0").count() == 0
    labels = {r[0] for r in state.training_matrix(train).select("Credit_Score").distinct().collect()}
    assert labels == {0, 1, 2}
    assert "Exchange" not in matrix._jdf.queryExecution().executedPlan().toString()


def test_fitted_state_survives_json(credit):
    state = features.FittedFeatures.fit(credit, presets.CREDIT_SPEC)
    again = features.FittedFeatures.from_json(state.to_json())
    assert again.features == state.features
    assert state.transform(credit, ["ID"]).exceptAll(again.transform(credit, ["ID"])).isEmpty()


def test_quarantine_keeps_every_row(spark):
    df = local_rows(spark, [(1, "5", 1.0), (2, "-5", None), (3, "x", -1.0), (4, None, None)],
                    {"id": "bigint", "a": "string", "b": "double"})
    accepted, rejected = quality.quarantine(df, ["a", "b"])
    assert sorted(r["id"] for r in accepted.collect()) == [1, 4]
    found = {r["id"]: r["violations"] for r in rejected.collect()}
    assert found == {2: ["a: negative"], 3: ["a: not a number", "b: negative"]}


def test_wide_one_hot_has_no_limit(spark):
    from tallyframe.operators import features

    train = spark.range(1500).selectExpr("concat('v', lpad(id, 4, '0')) as c")
    with pytest.raises(ValueError):
        features.fit_categories(train, ["c"])
    model = features.wide_one_hot(train, ["c"])
    rows = model.transform(spark.createDataFrame([("v0003",), ("new",), (None,)], "c string")).collect()
    assert [list(r.c_vector.indices) for r in rows] == [[3], [], []]
    assert rows[0].c_vector.size == 1500


def test_wide_columns_inside_the_feature_fit(spark, tmp_path):
    """A column with 100 000 values becomes one sparse vector; new and missing values are zero; bundles carry it."""
    from tallyframe.operators import features, training
    from tallyframe.operators.cleaning import CleanRules

    n = 100_000
    train = spark.range(n).selectExpr("id", "id % 7 as x", "concat('v', lpad(id, 6, '0')) as code",
                                      "if(id % 2 = 0, 'a', 'b') as few", "cast(id % 3 as int) as label")
    spec = features.FeatureSpec(CleanRules(), numeric=["x"], categorical=["few"], one_hot=["few", "code"],
                                drop=["id"], label="label")
    state = features.FittedFeatures.fit(train, spec)
    assert state.wide == ["code"] and state.dictionary["sizes"] == {"code": n} and list(state.categories) == ["few"]
    assert state.inputs == [*state.features, "code_vector"] and "code" not in state.features
    again = features.FittedFeatures.from_json(state.to_json())
    asked = spark.createDataFrame([(1, 2, "v000003", "a"), (2, 3, "new", "b"), (3, 4, None, None), (4, 1, "v099999", "c")],
                                  "id long, x long, code string, few string")
    for fitted in (state, again):
        rows = fitted.transform(asked, ["id"]).orderBy("id").collect()
        assert [list(r.code_vector.indices) for r in rows] == [[3], [], [], [n - 1]] and rows[0].code_vector.size == n
        assert [r.x for r in rows] == [2.0, 3.0, 4.0, 1.0]
    known = training.assemble(state.training_matrix(train.where("id < 300"), ["id"]), state.inputs, "label", ["id"])
    model = training.train_logistic(known, iterations=5)
    training.save_bundle(spark, str(tmp_path / "b"), state, model)
    loaded, member = training.load_bundle(spark, str(tmp_path / "b"))
    assert loaded.dictionary["path"].startswith(str(tmp_path))
    want = training.batch_score(asked, state, model, ["id"]).select("id", "predicted_class").orderBy("id").collect()
    assert training.batch_score(asked, loaded, member, ["id"]).select("id", "predicted_class").orderBy("id").collect() == want


def test_dictionary_codes(spark):
    from tallyframe.operators.dictionary import Dictionary

    df = spark.createDataFrame([("b", 3), ("a", 3), (None, 20), ("é", None), ("a", 1), ("B", 100)], "t string, n int")
    codes = Dictionary.fit(df.repartition(5), ["t", "n"])
    assert codes.sizes == {"t": 4, "n": 4}
    assert {(r.feature, r.value): r.code for r in codes.codes(spark).collect()} == {
        ("t", "B"): 0, ("t", "a"): 1, ("t", "b"): 2, ("t", "é"): 3, ("n", "1"): 0, ("n", "100"): 1, ("n", "20"): 2, ("n", "3"): 3}
    empty = Dictionary.fit(df.limit(0), ["t"])
    assert empty.sizes == {"t": 0} and empty.transform(df).count() == 6


def test_caps_and_medians_of_capped_rows(spark):
    """One set of order statistics gives what two fits in turn give, also with infinity in a column."""
    df = spark.sql("""select cast(id as double) as a, if(id % 4 = 0, double('infinity'), id * 2D) as b,
        if(id < 2, id * 99D, null) as few, cast(id % 5 as int) as plain, cast(id as string) as text from range(41)""")
    rules = cleaning.CleanRules(digits=["text"], quantile_caps={"a": 0.9, "b": 0.25, "few": 0.99, "text": 0.4, "gone": 0.5})
    columns = ["a", "b", "few", "plain", "text", "gone"]
    rows, caps, medians = features.fit_caps_and_medians(df, rules, columns)
    assert rows == 41
    assert caps == cleaning.fit_caps(df, rules)
    assert medians == features.fit_medians(cleaning.clean(df, rules, caps), columns)
    assert medians["few"] == (0 + caps["few"]) / 2


def test_modes_and_categories_small_and_large(spark, monkeypatch):
    df = spark.createDataFrame([("x", None), ("y", "k"), ("y", "k"), ("x", "m"), (None, "n")], "p string, q string")
    counts = features.value_counts(df, ["p", "q"])
    small = features.modes_and_categories(counts, ["p", "q", "z"], ["p", "q", "z"])
    assert small == ({"p": "x", "q": "k", "z": ""}, {"p": ["x", "y"], "q": ["k", "m", "n"], "z": []}, [])
    monkeypatch.setattr(features, "MAX_CATEGORIES", 2)
    assert features.modes_and_categories(counts, [], ["p", "q"]) == ({}, {"p": ["x", "y"]}, ["q"])
    monkeypatch.setattr(features, "settle", lambda df: df)
    assert features.modes_and_categories(counts, ["q"], ["p", "q"]) == ({"q": "k"}, {"p": ["x", "y"]}, ["q"])


def test_psi_rows_without_a_counterpart(spark):
    """An empty current side, columns without values and constants all keep their row."""
    df = spark.sql("select cast(id as double) as a, 1D as same, cast(null as double) as gone, "
                   "cast(id % 3 as string) as t, cast(null as string) as empty from range(30)")
    names = ["a", "same", "gone", "t", "empty"]
    whole = {r["feature"]: r["psi"] for r in drift.psi_table(df, df, names).collect()}
    assert whole == {"a": 0.0, "same": None, "gone": None, "t": 0.0, "empty": 0.0}
    bare = {r["feature"]: r["psi"] for r in drift.psi_table(df, df.where("a < 0"), names).collect()}
    assert set(bare) == set(names) and bare["a"] is None and bare["empty"] == 0.0 and bare["t"] > 1
