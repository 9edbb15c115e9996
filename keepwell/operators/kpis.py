"""Counts and sums behind the overview: all plain group-bys over few keys,
reduced on the map side. Money is summed as DECIMAL, so the result does not
depend on the order in which partitions arrive."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keepwell import contract as C
from keepwell.functions import rules
from keepwell.operators.priority import Thresholds

MONEY = "decimal(28,6)"


def money_sum(value: Column) -> Column:
    return F.coalesce(F.sum(value.cast(MONEY)).cast("double"), F.lit(0.0))


def at_risk(label: str = C.LABEL) -> Column:
    return F.col(label).isin(*C.AT_RISK_LABELS)


def label_counts(matrix: DataFrame) -> DataFrame:
    """Accounts per label with labels nobody carries as 0."""
    counts = matrix.agg(
        F.count("*").alias("base"),
        *[F.count_if(F.col(C.LABEL) == name).alias(f"n{i}")
          for i, name in enumerate(C.PRIORITY_LABELS)])
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(i + 1).alias("position"), F.lit(name).alias(C.LABEL),
                 F.col(f"n{i}").alias("accounts"),
                 F.try_divide(F.col(f"n{i}").cast("double"), F.col("base").cast("double"))
                 .alias("share"))
        for i, name in enumerate(C.PRIORITY_LABELS)
    ])))


def value_at_risk(matrix: DataFrame) -> DataFrame:
    return matrix.agg(
        F.count_if(at_risk()).alias("at_risk_accounts"),
        money_sum(F.when(at_risk(), F.col(C.VALUE))).alias("value_at_risk"))


def immediate_save_by_segment(matrix: DataFrame) -> DataFrame:
    return (
        matrix.groupBy(C.SEGMENT)
        .agg(F.count("*").alias("customers"),
             F.count_if(F.col(C.LABEL) == "Immediate Save").alias("immediate_save"))
        .orderBy(F.desc("immediate_save"), C.SEGMENT)
    )


def segment_overview(matrix: DataFrame, profiles: DataFrame) -> DataFrame:
    """Per segment the size, the save count, its whole predicted value and the
    part of it that is at risk, next to the centroid. ``profiles`` holds one
    row per segment, which bounds the broadcast."""
    stats = matrix.groupBy(C.SEGMENT).agg(
        F.count("*").alias("accounts"),
        F.count_if(F.col(C.LABEL) == "Immediate Save").alias("immediate_save"),
        money_sum(F.col(C.VALUE)).alias("total_predicted_clv"),
        money_sum(F.when(at_risk(), F.col(C.VALUE))).alias("at_risk_clv"))
    centroids = profiles.select(
        F.col("segment").alias("_name"), "Tenure_in_Months_centroid", "Monthly_Charge_centroid")
    return (
        stats.join(F.broadcast(centroids), F.col(C.SEGMENT) == F.col("_name"), "left")
        .drop("_name").orderBy(F.desc("accounts"), C.SEGMENT)
    )


def kpis(matrix: DataFrame) -> DataFrame:
    """One row; ``matrix`` must carry Customer_Status besides label and value."""
    status = {s: F.count_if(F.col("Customer_Status") == s).alias(s.lower()) for s in C.STATUSES}
    labels = {
        name: F.count_if(F.col(C.LABEL) == name).alias(name.lower().replace(" ", "_"))
        for name in C.PRIORITY_LABELS
    }
    counted = matrix.agg(
        F.count("*").alias("base"), *status.values(), *labels.values(),
        money_sum(F.when(at_risk(), F.col(C.VALUE))).alias("value_at_risk"))
    share = {f"{n}_share": F.try_divide(F.col(n).cast("double"), F.col("base").cast("double"))
             for n in (name.lower().replace(" ", "_") for name in C.PRIORITY_LABELS)}
    return counted.withColumns({
        "resolved": F.col("stayed") + F.col("churned"),
        "churn_rate": F.try_divide(F.col("churned").cast("double"),
                                   (F.col("stayed") + F.col("churned")).cast("double")),
        "at_risk": F.col("immediate_save") + F.col("nurture"),
        **share,
    })


def kpi_texts(kpi_row: DataFrame) -> DataFrame:
    """The headline figures the way a report prints them."""
    return kpi_row.select(
        rules.as_count_text(F.col("base")).alias("total_customers"),
        rules.as_percent_text(F.col("churn_rate")).alias("resolved_churn_rate"),
        rules.as_count_text(F.col("at_risk")).alias("predicted_at_risk"),
        rules.as_money_text(F.col("value_at_risk")).alias("clv_at_risk"))


def business_summary(matrix: DataFrame) -> DataFrame:
    """Predicted churners are the at-risk labels, not a 0.5 cut, so the count
    and the value at risk describe the same accounts."""
    return matrix.agg(
        F.count("*").alias("total_customers"),
        F.count_if(at_risk()).alias("predicted_churners"),
        F.count_if(F.col(C.LABEL) == "Immediate Save").alias("immediate_save"),
        F.count_if(F.col(C.LABEL) == "Nurture").alias("nurture"),
        F.count_if(F.col(C.LABEL) == "Monitor").alias("monitor"),
        F.count_if(F.col(C.LABEL) == "Low Priority").alias("low_priority"),
        money_sum(F.when(at_risk(), F.col(C.VALUE))).alias("clv_at_risk"))


def score_range(scores: DataFrame) -> DataFrame:
    return scores.agg(
        F.min(C.PROBABILITY).alias("min_probability"), F.max(C.PROBABILITY).alias("max_probability"),
        F.min(C.VALUE).alias("min_value"), F.max(C.VALUE).alias("max_value"))


def target_stats(df: DataFrame, target: str) -> DataFrame:
    return df.agg(F.count(target).alias("row_count"), F.avg(target).alias("mean"),
                  F.stddev_samp(target).alias("std"))


def threshold_row(matrix: DataFrame, thresholds: Thresholds) -> DataFrame:
    """The medians with the number of accounts at or above each."""
    return matrix.agg(
        F.lit(thresholds.probability).alias("median_probability"),
        F.lit(thresholds.value).alias("median_value"),
        F.count_if(F.col(C.PROBABILITY) >= thresholds.probability).alias("high_risk"),
        F.count_if(F.col(C.VALUE) >= thresholds.value).alias("high_value"))
