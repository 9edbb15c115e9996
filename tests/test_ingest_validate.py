"""Reading text extracts and every way an account table can be wrong."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keepwell import contract as C
from keepwell.operators import validate as V
from keepwell.sources import accounts as A
from keepwell.sources import tables
from tests.conftest import GOOD, NO_INTERNET

TEXT = T.StructType([T.StructField(c, T.StringType()) for c in C.COLUMNS])


def text_table(table, *changes):
    asis = lambda d: {k: None if v is None else str(v) for k, v in d.items()}
    return table(*[asis({**GOOD, "Customer_ID": f"A{i}", **c})
                   for i, c in enumerate(changes or ({},))], schema=TEXT)


def failures(df, **kw):
    report = V.validation_report(df, **kw).where("violations > 0")
    return {(r["check"], r["column"]): r["violations"] for r in report.collect()}


def test_csv_round_trip(spark, table, tmp_path):
    df = table({}, {"Offer": "Offer B", "City": 'Say "hi", all'})
    spaced = df.toDF(*[f" {c.replace('_', ' ')} " for c in df.columns])
    spaced.write.option("header", True).option("escape", '"').option(
        "ignoreLeadingWhiteSpace", False).csv(str(tmp_path / "raw"))
    back = A.typed(A.read_accounts(spark, str(tmp_path / "raw")))
    assert back.schema == C.ACCOUNT_SCHEMA
    assert sorted(back.collect()) == sorted(df.collect())


def test_missing_words_become_null(table):
    df = A.blank_to_null(text_table(table, {"Offer": "None"}, {"Offer": "NaN"}, {"Offer": "n/a"},
                                    {"Offer": ""}, {"Offer": "Offer A"}))
    assert df.where("Offer IS NULL").count() == 4


def test_nan_becomes_null(spark):
    df = A.blank_to_null(spark.createDataFrame([(float("nan"),), (1.0,)], "x double"))
    assert [r.x for r in df.orderBy("x").collect()] == [None, 1.0]


@pytest.mark.parametrize("text,value", [("12", 12), (" 12 ", 12), ("1,234", None), ("1d", None),
                                        ("4x", None), ("30.0", 30), ("30.5", None), ("3e1", 30)])
def test_whole_number_parsing(table, text, value):
    assert A.typed(text_table(table, {"Age": text})).first()["Age"] == value


def test_good_table_passes(table):
    df = text_table(table, {}, NO_INTERNET)
    assert failures(df, expected_rows=2) == {}
    V.enforce(V.validation_report(df, 2))


@pytest.mark.parametrize("change,check,column", [
    ({"Age": "1,234"}, "non_numeric", "Age"),
    ({"Age": None}, "unexpected_blank", "Age"),
    ({"Contract": "Monthly"}, "vocabulary", "Contract"),
    ({"Churn_Category": "Weather"}, "vocabulary", "Churn_Category"),
    ({"Online_Backup": None}, "unrepaired_blank", "Online_Backup"),
    ({"Married": "yes "}, "yes_no", "Married"),
])
def test_single_damage_is_reported(table, change, check, column):
    df = text_table(table, {}, change)
    assert failures(df) == {(check, column): 1}
    with pytest.raises(V.AccountTableError, match=check):
        V.enforce(V.validation_report(df))


def test_row_count_duplicates_and_columns(table):
    df = text_table(table, {"Customer_ID": "X"}, {"Customer_ID": "X"}, {"Customer_ID": "X"})
    assert failures(df, expected_rows=2) == {("row_count", "*"): 1,
                                             ("duplicate_id", "Customer_ID"): 2}
    assert failures(text_table(table).drop("City"))[("missing_column", "City")] == 1
    extra = text_table(table).withColumn("Surprise", F.lit("1"))
    assert failures(extra) == {("unexpected_column", "Surprise"): 1}


def test_first_failure_wins(table):
    df = text_table(table, {"Customer_ID": "X", "Age": "x"}, {"Customer_ID": "X"})
    with pytest.raises(V.AccountTableError, match="duplicate_id"):
        V.enforce(V.validation_report(df))


def test_violation_table_names_the_texts(table):
    df = text_table(table, {"Contract": "Monthly"}, {"Contract": "Monthly"}, {"Gender": "m"})
    rows = {(r["column"], r["value"]): r["row_count"] for r in V.vocabulary_violations(df).collect()}
    assert rows == {("Contract", "Monthly"): 2, ("Gender", "m"): 1}


def test_finite_check(spark):
    df = spark.createDataFrame([(1.0,), (None,), (float("nan"),), (float("inf"),)], "x double")
    assert V.finite_check(df, ["x"]).first()["not_finite"] == 3


def test_one_to_one_guard(spark):
    left = spark.createDataFrame([("a",), ("b",)], "Customer_ID string")
    V.require_one_to_one(left, left)
    with pytest.raises(V.AccountTableError):
        V.require_one_to_one(left, left.union(left))
    with pytest.raises(V.AccountTableError):
        V.require_one_to_one(left, left.limit(1))


def test_guards_on_model_inputs(spark):
    df = spark.createDataFrame([("a", 1)], "t string, n int")
    V.require_numeric(df, ["n"])
    with pytest.raises(V.AccountTableError):
        V.require_numeric(df, ["t"])
    V.require_inputs(["a"], ["a", "b"], exact=False)
    for expected, columns, exact in ((["a"], ["a", "b"], True), (["a", "b"], ["b", "a"], True),
                                     (["c"], ["a"], False)):
        with pytest.raises(V.AccountTableError):
            V.require_inputs(expected, columns, exact)


def test_label_contract(spark):
    rows = [("a", "Nurture"), ("a", None), ("b", "Other")]
    df = spark.createDataFrame(rows, "Customer_ID string, Priority_Label string")
    counts = V.label_contract(df).first().asDict()
    assert counts == {"row_count": 3, "null_labels": 1, "unknown_labels": 1,
                      "unused_labels": 3, "extra_copies": 1}
    with pytest.raises(V.AccountTableError):
        V.require_zero(V.label_contract(df), "labels")


def test_table_store(spark, table, tmp_path):
    root = str(tmp_path)
    assert "features" in tables.missing_artifacts(spark, root)
    for fmt in ("parquet", "csv"):
        stored = tables.write_table(table({}, {}), root, f"t_{fmt}", fmt)
        assert stored.schema == C.ACCOUNT_SCHEMA and stored.count() == 2
    assert tables.missing_artifacts(spark, root, ["t_csv"]) == []
    small = spark.createDataFrame([(0.123456, "x")], "v double, s string")
    assert tables.rounded(small).first()["v"] == 0.1235
