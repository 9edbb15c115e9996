"""Global order without a single-task window: ranks and running totals.

An unpartitioned window pulls the table into one task, and a window over the
sort key puts a hot key into one. Here the rows are range-partitioned on the
full sort key (which ends in a unique column, so no range can be hot), sorted
in place and stored in the shared checkpoint folder together with the number of
their range. From then on that number is data, so the per-range totals and the
rows they are added to always agree, also after a lost executor.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keepwell.session import materialise, shuffle_partitions

# monotonically_increasing_id numbers the rows of a partition in its low bits.
_POSITION_BITS = 33


def ordered_layout(df: DataFrame, keys: list[Column]) -> DataFrame:
    """``df`` plus ``_range`` and ``_position`` (0-based inside the range)."""
    return materialise(
        df.repartitionByRange(shuffle_partitions(df.sparkSession), *keys)
        .sortWithinPartitions(*keys)
        .withColumn("_row", F.monotonically_increasing_id())
        .withColumns({
            "_range": F.shiftright("_row", _POSITION_BITS).cast("int"),
            "_position": F.col("_row").bitwiseAND((1 << _POSITION_BITS) - 1),
        })
        .drop("_row")
    )


def _offsets(layout: DataFrame, totals: dict[str, Column]) -> DataFrame:
    """One row per range with the totals of all ranges before it. The row
    count is the number of shuffle partitions, so the window and the broadcast
    of this table are bounded by configuration, not by data."""
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    per_range = layout.groupBy("_range").agg(*[c.alias(n) for n, c in totals.items()])
    return per_range.select("_range", *[
        F.coalesce(F.sum(n).over(before), F.lit(0)).alias(n) for n in totals
    ])


def rank_global(df: DataFrame, keys: list[Column], name: str = "rank") -> DataFrame:
    """1..n in the order of ``keys``, which must end in a unique column."""
    layout = ordered_layout(df, keys)
    offsets = _offsets(layout, {"_before": F.count("*")})
    return (
        layout.join(F.broadcast(offsets), "_range")
        .withColumn(name, F.col("_before") + F.col("_position") + 1)
        .drop("_range", "_position", "_before")
    )


def running_totals(df: DataFrame, keys: list[Column], values: dict[str, Column]) -> DataFrame:
    """Adds, per name in ``values``, the sum over all rows ordered before this
    one. ``keys`` must order the rows totally."""
    layout = ordered_layout(df, keys)
    offsets = _offsets(layout, {f"_{n}_before": F.sum(v) for n, v in values.items()})
    inside = (Window.partitionBy("_range").orderBy("_position")
              .rowsBetween(Window.unboundedPreceding, -1))
    return (
        layout.join(F.broadcast(offsets), "_range")
        .withColumns({
            n: F.col(f"_{n}_before") + F.coalesce(F.sum(v).over(inside), F.lit(0))
            for n, v in values.items()
        })
        .drop("_range", "_position", *[f"_{n}_before" for n in values])
    )
