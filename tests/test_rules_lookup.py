"""The 2x2 rule, ranking, KPIs and account lookup on a small matrix."""

import pytest
from pyspark.sql import functions as F

from keepwell import contract as C
from keepwell.operators import kpis as K
from keepwell.operators import lookup as LK
from keepwell.operators.validate import AccountTableError
from keepwell.operators import priority as PR

ROWS = [("b7", 0.9, 50.0, "S1", "Churned"), ("A7", 0.9, 10.0, "S1", "Stayed"),
        ("c", 0.5, 30.0, "S2", "Joined"), ("d", 0.1, 40.0, "S2", "Stayed"),
        ("e%1", 0.2, 5.0, "S2", "Stayed")]


@pytest.fixture(scope="module")
def scores(spark):
    return spark.createDataFrame(
        ROWS, "Customer_ID string, Churn_Probability double, Predicted_CLV double, "
              "Segment string, Customer_Status string").cache()


@pytest.fixture(scope="module")
def matrix(scores):
    return PR.label_accounts(scores, PR.median_thresholds(scores)).cache()


def labels(df):
    return {r.Customer_ID: r.Priority_Label for r in df.collect()}


def test_medians_count_as_high(scores, matrix):
    assert PR.median_thresholds(scores) == PR.Thresholds(0.5, 30.0)
    assert labels(matrix) == {"b7": "Immediate Save", "A7": "Nurture", "c": "Immediate Save",
                              "d": "Monitor", "e%1": "Low Priority"}


def test_ranked_list(matrix):
    ranked = PR.ranked_list(matrix).orderBy("rank").collect()
    assert [r.Customer_ID for r in ranked] == ["b7", "c", "A7", "d", "e%1"]


def test_label_counts_keep_empty_labels(matrix):
    only = matrix.where("Priority_Label = 'Nurture'")
    rows = {r.Priority_Label: (r.accounts, r.share) for r in K.label_counts(only).collect()}
    assert rows == {"Immediate Save": (0, 0.0), "Nurture": (1, 1.0), "Monitor": (0, 0.0),
                    "Low Priority": (0, 0.0)}


def test_value_at_risk_and_summary(matrix):
    assert K.value_at_risk(matrix).first().asDict() == {"at_risk_accounts": 3, "value_at_risk": 90.0}
    row = K.business_summary(matrix).first()
    assert (row.total_customers, row.predicted_churners, row.clv_at_risk) == (5, 3, 90.0)


def test_kpis(matrix):
    row = K.kpis(matrix).first()
    assert (row.stayed, row.churned, row.joined, row.resolved) == (3, 1, 1, 4)
    assert row.churn_rate == 0.25 and row.at_risk == 3
    assert sum(row[f"{n.lower().replace(' ', '_')}_share"] for n in C.PRIORITY_LABELS) == pytest.approx(1)
    text = K.kpi_texts(K.kpis(matrix)).first()
    assert tuple(text) == ("5", "25.0%", "3", "$90")


def test_segment_views(spark, matrix):
    rows = [tuple(r) for r in K.immediate_save_by_segment(matrix).collect()]
    assert rows == [("S1", 2, 1), ("S2", 3, 1)]
    profiles = spark.createDataFrame(
        [("S1", 1.0, 2.0)], "segment string, Tenure_in_Months_centroid double, "
                            "Monthly_Charge_centroid double")
    view = {r.Segment: r for r in K.segment_overview(matrix, profiles).collect()}
    assert view["S2"].total_predicted_clv == 75.0 and view["S2"].at_risk_clv == 30.0
    assert view["S1"].Tenure_in_Months_centroid == 1.0
    assert view["S2"].Tenure_in_Months_centroid is None


@pytest.mark.parametrize("text,hits", [("7", {"b7", "A7"}), (" a7 ", {"A7"}), ("%", {"e%1"}),
                                       ("", {"b7", "A7", "c", "d", "e%1"}), ("zz", set())])
def test_search_is_literal(matrix, text, hits):
    assert set(labels(LK.search_accounts(matrix, text))) == hits


def test_empty_filters_mean_all(matrix):
    assert LK.filter_queue(matrix).count() == 5
    assert LK.filter_queue(matrix, labels=["Monitor"]).count() == 1
    assert LK.filter_queue(matrix, segments=["S1"], labels=["Nurture"]).count() == 1


@pytest.mark.parametrize("text,row,want", [("c", 0, "c"), ("", 2, "A7"), ("", 99, "b7"),
                                           ("7", 1, "A7"), ("zz", 0, None)])
def test_pick_account(matrix, text, row, want):
    got = [r.Customer_ID for r in LK.pick_account(PR.ranked_list(matrix), text, row).collect()]
    assert got == ([want] if want else [])


def test_rule_texts(scores, matrix):
    t = PR.median_thresholds(scores)
    row = LK.explain_rule(matrix, t).where("Customer_ID = 'A7'").first()
    assert row.risk_side == "at/above" and row.value_side == "below"
    assert row.risk_margin >= 0 > row.value_margin
    assert row.playbook == C.PLAYBOOK["Nurture"]


def test_record_join_refuses_a_repeated_id(matrix):
    record = matrix.select(C.ID).limit(1)
    twice = record.unionByName(record).withColumn("City", F.lit("X"))
    with pytest.raises(AccountTableError, match="repeated"):
        LK.join_records(matrix, twice)


def test_every_quadrant_and_a_half_split(spark):
    df = spark.range(1001).select(
        F.col("id").cast("string").alias(C.ID), (F.col("id") / 1001).alias(C.PROBABILITY),
        ((F.col("id") * 37) % 1001).cast("double").alias(C.VALUE))
    t = PR.median_thresholds(df)
    row = K.threshold_row(df, t).first()
    assert (row.high_risk, row.high_value) == (501, 501)
    assert {r.Priority_Label for r in PR.label_accounts(df, t).collect()} == set(C.PRIORITY_LABELS)
