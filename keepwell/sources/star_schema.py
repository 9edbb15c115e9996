"""The 38-column account view over an order-entry star schema.

Test and benchmark data come as customer / orders / lineitem / events tables.
This view gives them the account contract. All joins are equi joins on keys
that are unique on one side, and both fact tables are reduced to one row per
key before they are joined, so a hot order or customer is summed up on the
map side and never lands whole in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keepwell import contract as C

_FROM_ORDERS = {"Number_of_Referrals", "Total_Refunds", "Total_Revenue"}
_FROM_EVENTS = {"Total_Extra_Data_Charges", "Total_Revenue"}
_MONEY = "decimal(18,2)"


#: The tables the account view is made of.
SOURCE_TABLES = ("customer", "nation", "orders", "lineitem", "events")


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def order_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per customer: orders that have lines, and the value sent back."""
    lines = (
        load(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(F.sum(F.when(F.col("l_returnflag") == "R",
                          F.col("l_extendedprice").cast(_MONEY))).alias("returned"))
    )
    # o_orderkey is the primary key of orders, so counting joined rows counts
    # distinct orders without a second shuffle for COUNT(DISTINCT).
    return (
        load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
        .join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
        .groupBy("o_custkey")
        .agg(F.count("*").alias("n_orders"), F.sum("returned").alias("returned"))
    )


def purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        load(spark, sf_dir, "events").where("event_type = 'purchase'")
        .groupBy("user_id")
        .agg(F.sum(F.col("value").cast(_MONEY)).alias("extra"))
    )


def _yes_no(condition: str) -> str:
    return f"CASE WHEN {condition} THEN 'Yes' ELSE 'No' END"


def _net(condition: str) -> str:
    return f"CASE WHEN net THEN {_yes_no(condition)} END"


_ACCOUNT_SQL = {
    "Customer_ID": "concat('C', lpad(cast(k AS string), 9, '0'))",
    "Gender": "CASE WHEN f % 2 = 0 THEN 'Male' ELSE 'Female' END",
    "Age": "19 + f % 62",
    "Married": _yes_no("d % 2 = 0"),
    "Number_of_Dependents": "a % 4",
    "City": "n_name",
    "Zip_Code": "90001 + c_nationkey",
    "Latitude": "32.0D + 0.25D * c_nationkey",
    "Longitude": "-114.0D - 0.25D * c_nationkey",
    "Number_of_Referrals": "n_orders % 12",
    "Tenure_in_Months": "tenure",
    "Offer": "CASE f % 11 WHEN 0 THEN 'Offer A' WHEN 1 THEN 'Offer B' WHEN 2 THEN "
             "'Offer C' WHEN 3 THEN 'Offer D' WHEN 4 THEN 'Offer E' END",
    "Phone_Service": _yes_no("phone"),
    "Avg_Monthly_Long_Distance_Charges": "CASE WHEN phone THEN ld0 END",
    "Multiple_Lines": f"CASE WHEN phone THEN {_yes_no('a % 2 = 0')} END",
    "Internet_Service": _yes_no("net"),
    "Internet_Type": "CASE WHEN net THEN CASE b % 3 WHEN 0 THEN 'Cable' "
                     "WHEN 1 THEN 'DSL' ELSE 'Fiber Optic' END END",
    "Avg_Monthly_GB_Download": "CASE WHEN net THEN 2 + d END",
    "Online_Security": _net("a % 3 = 0"),
    "Online_Backup": _net("b % 2 = 0"),
    "Device_Protection_Plan": _net("c % 2 = 0"),
    "Premium_Tech_Support": _net("d % 3 = 0"),
    "Streaming_TV": _net("f % 2 = 1"),
    "Streaming_Movies": _net("f % 5 < 2"),
    "Streaming_Music": _net("f % 7 < 3"),
    "Unlimited_Data": _net("d % 5 <> 0"),
    "Contract": "contract",
    "Paperless_Billing": _yes_no("c % 3 <> 0"),
    "Payment_Method": "CASE WHEN d % 9 < 5 THEN 'Bank Withdrawal' "
                      "WHEN d % 9 < 8 THEN 'Credit Card' ELSE 'Mailed Check' END",
    "Monthly_Charge": "mc",
    "Total_Charges": "tc",
    "Total_Refunds": "rf",
    "Total_Extra_Data_Charges": "extra",
    "Total_Long_Distance_Charges": "tld",
    "Total_Revenue": "tc + tld + extra - rf",
    "Customer_Status": "status",
    "Churn_Category": "CASE WHEN status = 'Churned' THEN CASE f % 5 WHEN 0 THEN 'Attitude' "
                      "WHEN 1 THEN 'Competitor' WHEN 2 THEN 'Dissatisfaction' "
                      "WHEN 3 THEN 'Other' ELSE 'Price' END END",
    "Churn_Reason": "CASE WHEN status = 'Churned' THEN "
                    "concat('Reason ', cast(f % 20 AS string)) END",
}


def accounts(spark: SparkSession, sf_dir: str, columns=C.COLUMNS) -> DataFrame:
    """The account view restricted to ``columns``; fact tables that none of
    them depends on are left out of the plan."""
    wanted = [c for c in C.COLUMNS if c in set(columns)]
    base = load(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "k")
    if "City" in wanted:
        base = base.join(load(spark, sf_dir, "nation").select("n_nationkey", "n_name"),
                         F.col("c_nationkey") == F.col("n_nationkey"), "left")
    if _FROM_ORDERS & set(wanted):
        base = base.join(order_history(spark, sf_dir), F.col("k") == F.col("o_custkey"), "left")
    else:
        base = base.withColumns({"n_orders": F.lit(0), "returned": F.lit(None)})
    if _FROM_EVENTS & set(wanted):
        base = base.join(purchases(spark, sf_dir), F.col("k") == F.col("user_id"), "left")
    else:
        base = base.withColumn("extra", F.lit(None))
    stepped = (
        base.withColumns({
            "tenure": F.expr("cast(1 + (k * 7919 + 13) % 71 AS int)"),
            "a": F.expr("cast((k * 104729 + 7) % 101 AS int)"),
            "b": F.expr("cast((k * 15485863 + 3) % 97 AS int)"),
            "c": F.expr("cast((k * 32452843 + 11) % 89 AS int)"),
            "d": F.expr("cast((k * 49979687 + 5) % 83 AS int)"),
            "f": F.expr("cast((k * 67867967 + 1) % 79 AS int)"),
            "mc": F.expr("cast(floor(c_acctbal) AS decimal(16,0)) * cast(0.01 AS decimal(3,2))"),
            "rf": F.expr("cast(floor(coalesce(cast(returned AS decimal(28,2)), 0) / 100) "
                         "AS decimal(16,0)) * cast(0.01 AS decimal(3,2))"),
            "extra": F.expr("coalesce(cast(extra AS decimal(28,2)), 0)"),
            "n_orders": F.expr("coalesce(n_orders, 0)"),
        })
        .withColumns({
            "phone": F.expr("b % 10 <> 0"),
            "net": F.expr("c % 5 <> 0"),
            "ld0": F.expr(f"cast(b * 0.5 AS {_MONEY})"),
            "contract": F.expr("CASE WHEN a < 51 THEN 'Month-to-Month' "
                               "WHEN a < 73 THEN 'One Year' ELSE 'Two Year' END"),
        })
        .withColumns({
            "tc": F.expr(f"greatest(mc, cast(0 AS {_MONEY})) * tenure"),
            "tld": F.expr(f"CASE WHEN phone THEN ld0 ELSE cast(0 AS {_MONEY}) END * tenure"),
            "status": F.expr(
                "CASE WHEN tenure <= 3 THEN 'Joined' WHEN d < (CASE contract "
                "WHEN 'Month-to-Month' THEN 45 WHEN 'One Year' THEN 10 ELSE 3 END) "
                "- cast(floor(tenure / 6.0) AS int) THEN 'Churned' ELSE 'Stayed' END"),
        })
    )
    kinds = {"text": "string", "int": "int", "double": "double"}
    return stepped.select(*[
        F.expr(_ACCOUNT_SQL[c]).cast(kinds[C.FIELD[c].kind]).alias(c) for c in wanted
    ])


def raw_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same accounts as an unchecked text extract: every column is text,
    and a rule on the key damages rows so that every check has work to do."""
    def damaged(name: str, dtype: str):
        col = F.col(name)
        return {
            "Age": F.when(F.expr("key % 41 = 0"), "4x").otherwise(col.cast("string")),
            "Married": F.when(F.expr("key % 47 <> 0"), col),
            "Contract": F.when(F.expr("key % 43 = 0"), "Monthly").otherwise(col),
            "Offer": F.when(F.expr("key % 53 = 0"), "None").otherwise(col),
            "Tenure_in_Months": F.when(F.expr("key % 61 = 0"), "0")
                                 .otherwise(col.cast("string")),
            "Online_Security": F.when(F.expr("key % 67 <> 0"), col),
            "Payment_Method": F.when(F.expr("key % 37 = 0"), "Cash ").otherwise(col),
            "Churn_Category": F.when(F.expr("key % 71 = 0"), "Weather").otherwise(col),
            "Total_Charges": F.when(F.expr("key % 73 = 0"), "-5.00")
                              .otherwise(col.cast("string")),
        }.get(name, col.cast("string")).alias(name)

    clean = accounts(spark, sf_dir).withColumn(
        "key", F.expr("cast(substring(Customer_ID, 2) AS bigint)"))
    copies = F.when(F.expr("key % 59 = 0"), 2).otherwise(1)
    return (
        clean.withColumn("copy", F.explode(F.sequence(F.lit(1), copies)))
        .select(*[damaged(n, t) for n, t in clean.dtypes if n != "key"])
    )
