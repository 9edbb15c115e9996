"""Column builders for the model-ready account table.

Each builder is a plain ``Column`` of built-in functions; ``operators.prepare``
puts them into projections that Catalyst runs in one generated stage.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from keepwell import contract as C


def flag(condition: Column) -> Column:
    return condition.cast("int")


def count_of(names) -> Column:
    return reduce(add, [F.col(n) for n in names])


def tenure_years() -> Column:
    return F.col("Tenure_in_Months") / F.lit(12.0)


def charge_per_service() -> Column:
    services = F.col("Total_Services")
    return F.when(services > 0, F.col("Monthly_Charge") / services).otherwise(0.0)


def long_distance_share() -> Column:
    calls, bill = F.col("Avg_Monthly_Long_Distance_Charges"), F.col("Monthly_Charge")
    billed = (bill > 0) & (calls + bill > 0)
    return F.when(billed, calls / (calls + bill)).otherwise(0.0)


def referrals_per_year() -> Column:
    """NULL for tenure 0, where the rate does not exist."""
    return F.try_divide(F.col("Number_of_Referrals").cast("double"), tenure_years())


# Builders that only need repaired and encoded columns, then the ones that
# need those results.
FIRST_DERIVED = {
    "Total_Services": lambda: count_of(C.SERVICES),
    "Premium_Services": lambda: count_of(C.PREMIUM_ADD_ONS),
    "Streaming_Services": lambda: count_of(C.STREAMING_ADD_ONS),
    "Has_Phone_And_Internet":
        lambda: flag((F.col("Phone_Service") == 1) & (F.col("Internet_Service") == 1)),
    "Tenure_Years": tenure_years,
    "Referrals_per_Tenure_Year": referrals_per_year,
    "Long_Distance_Dependency": long_distance_share,
    "Is_New_Customer": lambda: flag(F.col("Tenure_in_Months") <= C.NEW_CUSTOMER_MONTHS),
    "Senior_Citizen": lambda: flag(F.col("Age") >= C.SENIOR_AGE),
}
SECOND_DERIVED = {"Monthly_Charge_per_Service": charge_per_service}


def yes_no_flag(name: str) -> Column:
    return F.when(F.col(name) == "Yes", 1).when(F.col(name) == "No", 0)


def gender_flag() -> Column:
    return F.when(F.col("Gender") == "Male", 1).when(F.col("Gender") == "Female", 0)


def repaired(name: str) -> Column:
    """The column with its documented blanks filled.

    A missing product overwrites whatever the field holds; offers and churn
    fields are only filled where blank.
    """
    col = F.col(name)
    no_phone = F.col("Phone_Service") == "No"
    no_internet = F.col("Internet_Service") == "No"
    if name == "Avg_Monthly_Long_Distance_Charges":
        return F.when(no_phone, 0.0).otherwise(col)
    if name == "Multiple_Lines":
        return F.when(no_phone, "No").otherwise(col)
    if name == "Avg_Monthly_GB_Download":
        return F.when(no_internet, 0.0).otherwise(col)
    if name == "Internet_Type":
        return F.when(no_internet, "No Internet").otherwise(col)
    if name in C.INTERNET_ADD_ONS:
        return F.when(no_internet, "No").otherwise(col)
    if name == "Offer":
        return F.coalesce(col, F.lit("No Offer"))
    if name in ("Churn_Category", "Churn_Reason"):
        return F.coalesce(col, F.lit(C.NO_CHURN))
    return col
