"""Reading the account table and giving it its contract types."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keepwell import contract as C

def normalise_header(df: DataFrame) -> DataFrame:
    return df.toDF(*[name.strip().replace(" ", "_") for name in df.columns])


def blank_to_null(df: DataFrame) -> DataFrame:
    """Turn missing-value words and NaN into NULL, the only blank we use."""
    def clean(name: str, dtype: str) -> Column:
        col = F.col(f"`{name}`")
        if dtype == "string":
            return F.when(~col.isin(*C.MISSING_TOKENS), col).alias(name)
        if dtype in ("double", "float"):
            return F.when(~F.isnan(col), col).alias(name)
        return col
    return df.select(*[clean(n, t) for n, t in df.dtypes])


def read_accounts(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """CSV columns stay text here, so that junk is counted by the validator
    instead of failing the scan; ``typed`` converts them afterwards."""
    if fmt == "csv":
        df = spark.read.option("header", True).option("escape", '"').csv(path)
    else:
        df = spark.read.format(fmt).load(path)
    return blank_to_null(normalise_header(df))


def text_number(col: Column) -> Column:
    """A text as DOUBLE, NULL where it is no plain finite number. Spark's cast
    also takes Java's type suffixes ("1d") and "Infinity", which no CSV tool
    would call a number."""
    number = col.try_cast("double")
    suffixed = F.lower(F.substring(F.rtrim(col), -1, 1)).isin("d", "f")
    return F.when(~suffixed & (F.abs(number) < float("inf")), number)


def numeric_value(name: str, dtype: str, source: Column | None = None) -> Column:
    """The column in its contract type. A fraction in a whole-number column
    becomes NULL, so the validator reports it rather than cutting it off."""
    col = F.col(name) if source is None else source
    number = text_number(col) if dtype == "string" else col.cast("double")
    if C.FIELD[name].kind == "double":
        return number
    if dtype in ("tinyint", "smallint", "int"):
        return col.cast("int")
    # Nearly all values are plain whole numbers; only the rest ("30.0") takes
    # the longer way.
    return F.coalesce(col.try_cast("int") if dtype != "double" else F.lit(None).cast("int"),
                      F.when(number == F.floor(number), number.try_cast("int")))


def typed(df: DataFrame) -> DataFrame:
    """Contract columns in contract order and types; extra columns are dropped."""
    types = dict(df.dtypes)
    return df.select(*[
        (numeric_value(f.name, types[f.name]) if f.kind != "text"
         else F.col(f.name).cast("string")).alias(f.name)
        for f in C.ACCOUNT_FIELDS if f.name in types
    ])
