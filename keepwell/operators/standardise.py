"""Column-wise standardisation without vectors, for reports and checks; model
pipelines use Spark ML's StandardScaler."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def standardise(df: DataFrame, columns, suffix: str = "_z") -> DataFrame:
    """Adds (x - mean) / population deviation per column. The moments are one
    pass and come back as literals, two numbers per column; a constant column
    becomes 0."""
    row = df.agg(*[F.struct(F.avg(c).alias("mean"), F.stddev_pop(c).alias("std")).alias(c)
                   for c in columns]).first()
    return df.withColumns({
        f"{c}{suffix}": (F.col(c) - F.lit(row[c]["mean"])) / F.lit(row[c]["std"] or 1.0)
        for c in columns
    })
