"""Contract sizes and the value of every derived feature on hand-made rows."""

import pytest

from keepwell import contract as C
from keepwell.operators import prepare as P
from keepwell.plans import queries as Q
from tests.conftest import NO_INTERNET, NO_PHONE


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0].asDict()


def test_contract_sizes():
    assert len(C.COLUMNS) == 38
    assert len(C.NUMERIC) == 15
    assert len(C.YES_NO_FIELDS) == 13
    assert len(C.BLANKABLE) == 15
    assert len(C.FEATURE_COLUMNS) == 60
    assert len(C.CHURN_PREDICTORS) == 48
    assert len(C.VALUE_PREDICTORS) == 43
    assert not {C.VALUE_TARGET, *C.VALUE_COMPONENTS} & set(C.VALUE_PREDICTORS)


def test_dummy_names_and_reference_levels():
    assert list(C.DUMMIES) == [
        "Offer_Offer_A", "Offer_Offer_B", "Offer_Offer_C", "Offer_Offer_D", "Offer_Offer_E",
        "Internet_Type_DSL", "Internet_Type_Fiber_Optic", "Internet_Type_No_Internet",
        "Contract_One_Year", "Contract_Two_Year",
        "Payment_Method_Credit_Card", "Payment_Method_Mailed_Check"]
    assert [C.reference_level(f) for f in C.ONE_HOT_FIELDS] == [
        "No Offer", "Cable", "Month-to-Month", "Bank Withdrawal"]


def test_plain_account(table):
    row = one(P.build_features(table()))
    assert tuple(row) == C.FEATURE_COLUMNS
    assert row["Total_Services"] == 6            # phone, internet and four add-ons
    assert row["Premium_Services"] == 2
    assert row["Streaming_Services"] == 1
    assert row["Has_Phone_And_Internet"] == 1
    assert row["Monthly_Charge_per_Service"] == 70.0 / 6
    assert row["Tenure_Years"] == 2.0
    assert row["Referrals_per_Tenure_Year"] == 1.5
    assert row["Long_Distance_Dependency"] == 10.0 / 80.0
    assert row["Is_New_Customer"] == 0 and row["Senior_Citizen"] == 0
    assert row["Offer"] == "No Offer" and row["Churn_Reason"] == "No Churn"
    assert row["Contract_One_Year"] == 1 and row["Contract_Two_Year"] == 0
    assert sum(row[c] for c in C.DUMMIES if c.startswith("Offer_")) == 0


def test_no_products_at_all(table):
    row = one(P.build_features(table({**NO_PHONE, **NO_INTERNET})))
    assert row["Total_Services"] == 0
    assert row["Monthly_Charge_per_Service"] == 0.0
    assert row["Internet_Type"] == "No Internet" and row["Internet_Type_No_Internet"] == 1
    assert row["Avg_Monthly_Long_Distance_Charges"] == 0.0
    assert not any(v is None for v in row.values())


def test_repair_overwrites_filled_fields(table):
    row = one(P.repair(table({"Internet_Service": "No", "Phone_Service": "No"})))
    assert row["Internet_Type"] == "No Internet" and row["Online_Security"] == "No"
    assert row["Avg_Monthly_GB_Download"] == 0.0 and row["Multiple_Lines"] == "No"


@pytest.mark.parametrize("bill,calls,share", [(-5.0, 20.0, 0.0), (0.0, 20.0, 0.0), (30.0, 10.0, 0.25)])
def test_call_share_with_credits(table, bill, calls, share):
    change = {"Monthly_Charge": bill, "Avg_Monthly_Long_Distance_Charges": calls}
    assert one(P.build_features(table(change)))["Long_Distance_Dependency"] == share


@pytest.mark.parametrize("months,flag", [(1, 1), (6, 1), (7, 0)])
def test_new_customer_edge(table, months, flag):
    assert one(P.build_features(table({"Tenure_in_Months": months})))["Is_New_Customer"] == flag


@pytest.mark.parametrize("age,flag", [(59, 0), (60, 1)])
def test_senior_edge(table, age, flag):
    assert one(P.build_features(table({"Age": age})))["Senior_Citizen"] == flag


def test_tenure_zero_and_open_blank_are_split_off(table):
    df = P.build_features(table({}, {"Tenure_in_Months": 0}, {"Online_Backup": None},
                                {"Tenure_in_Months": 0, "Number_of_Referrals": 0}))
    good, bad = P.split_rejected(df)
    assert [r.Customer_ID for r in good.collect()] == ["A0"]
    assert sorted(r.Customer_ID for r in bad.collect()) == ["A1", "A2", "A3"]


def test_score_frame_takes_any_case_and_subset(table):
    df = table().select("Customer_ID", "Age", "Contract").toDF("customer_id", "AGE", "contract")
    row = one(P.score_frame(df))
    assert set(row) == {C.ID, *C.SCORE_INPUTS}
    assert row["Age"] == 30 and row["Offer"] is None
    types = dict(P.score_frame(df).dtypes)
    assert types["Monthly_Charge"] == "double" and types["Offer"] == "string"


def test_adapter_is_complete_and_null_free(spark, sf):
    df = Q.features(spark, sf).toPandas()
    assert df.shape == (150, 60) and not df.isna().any().any()
    assert df["Customer_ID"].is_unique
    assert df["Total_Services"].between(0, 10).all()
    assert df["Long_Distance_Dependency"].between(0, 1).all()
    assert df["Customer_Status"].value_counts().to_dict() == {
        "Stayed": 111, "Churned": 33, "Joined": 6}
