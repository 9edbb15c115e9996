"""Small decision rules as columns: levels, labels, words, report formats."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from keepwell import contract as C


def words(col: Column, mapping: dict[str, str]) -> Column:
    out = F.lit(None).cast("string")
    for key, word in reversed(mapping.items()):
        out = F.when(col == key, word).otherwise(out)
    return out


def tercile_level(value: Column, lower, upper) -> Column:
    return F.when(value <= lower, "Low").when(value <= upper, "Mid").otherwise("High")


def segment_name(tenure_level: Column, spend_level: Column) -> Column:
    return F.concat_ws(" ", words(tenure_level, C.TENURE_WORDS),
                       words(spend_level, C.SPEND_WORDS), F.lit("Customers"))


def priority_label(high_risk: Column, high_value: Column) -> Column:
    save, nurture, monitor, low = C.PRIORITY_LABELS
    return (
        F.when(high_risk & high_value, save).when(high_risk, nurture)
        .when(high_value, monitor).otherwise(low)
    )


def label_position(label: Column) -> Column:
    """1 for the most urgent label; NULL for an unknown one."""
    out = F.lit(None).cast("int")
    for i, name in enumerate(C.PRIORITY_LABELS, start=1):
        out = F.when(label == name, i).otherwise(out)
    return out


def risk_rule() -> Column:
    """A transparent stand-in for a churn probability, in (0, 1]."""
    monthly = F.when(F.col("Contract") == "Month-to-Month", 1.0).otherwise(0.0)
    return F.round(
        F.lit(0.6) * monthly + F.lit(0.3) / (F.lit(1.0) + F.col("Tenure_Years"))
        + F.lit(0.1) * (F.lit(1.0) - F.col("Premium_Services") / F.lit(4.0)), 6)


def as_count_text(col: Column) -> Column:
    return F.format_number(col, 0)


def as_money_text(col: Column) -> Column:
    return F.concat(F.lit("$"), F.format_number(col, 0))


def as_percent_text(share: Column, digits: int = 1) -> Column:
    return F.concat(F.format_number(share * 100, digits), F.lit("%"))
