"""Gates a table passes while it is written.

The counts are taken by the job that writes the rows (``DataFrame.observe``), so
checking costs no second scan. They sit right before the writer, with no shuffle
in between: Spark counts each written partition once, also after a lost executor.
Rows go to a candidate folder first; only a table whose gates all hold takes its
place, so readers never see a bad or half-written one.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from keepwell.operators.validate import AccountTableError, not_finite
from keepwell.sources import tables

GATE_SCHEMA = "artifact string, gate string, violations long, passed boolean"


@dataclass(frozen=True)
class Written:
    """A candidate table and what was counted on the way."""
    table: DataFrame
    path: str
    counts: dict[str, int]


def observable(df: DataFrame) -> DataFrame:
    """``df`` in a session of its own with the same settings. A session that has
    observed keeps a manager Spark 4.1 cannot ship to executors, and the functions
    of its fitted models ship their session; so no session that fits observes."""
    spark = df.sparkSession
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(key):
            own.conf.set(key, value)
    name = f"observed_{uuid.uuid4().hex}"
    df.createGlobalTempView(name)
    try:
        return own.table(f"global_temp.{name}")
    finally:
        spark.catalog.dropGlobalTempView(name)


def write_counted(df: DataFrame, root: str, counts: dict[str, Column]) -> Written:
    """``df`` in a candidate folder below ``root``, and the aggregates ``counts``
    of its rows, in one job."""
    return write_observed(observable(df), root, counts, df.sparkSession)


def write_observed(df: DataFrame, root: str, counts: dict[str, Column], spark: SparkSession) -> Written:
    """The same for a table that is observable already; the result is ``spark``'s."""
    seen = Observation(f"gates-{uuid.uuid4().hex}")
    candidate = f"_candidate-{uuid.uuid4().hex}"
    table = tables.write_table(
        df.observe(seen, *[c.alias(n) for n, c in counts.items()]), root, candidate)
    return Written(tables.read_table(spark, root, candidate, schema=table.schema),
                   tables.table_path(root, candidate), dict(seen.get))


def publish(written: Written, root: str, name: str) -> DataFrame:
    """The candidate in the place of the table ``name``."""
    spark = written.table.sparkSession
    tables.move(spark, written.path, tables.table_path(root, name))
    return tables.read_table(spark, root, name, schema=written.table.schema)


def write_gated(df: DataFrame, root: str, name: str, gates: dict[str, Column]) -> DataFrame:
    """Stores ``df`` as ``name`` if every gate counts 0; raises and leaves the
    former table in place otherwise."""
    written = write_counted(df, root, gates)
    broken = {n: v for n, v in written.counts.items() if v}
    if broken:
        tables.remove(df.sparkSession, written.path)
        raise AccountTableError(f"{name}: {broken}")
    return publish(written, root, name)


def blanks_gate(df: DataFrame) -> dict[str, Column]:
    """Blank values of all columns together."""
    return {"blanks": sum((F.count_if(F.col(f"`{c}`").isNull()) for c in df.columns), F.lit(0).cast("long"))}


def finite_gates(columns) -> dict[str, Column]:
    return {f"{c}_not_finite": F.count_if(not_finite(F.col(c))) for c in columns}


def rows_gate(expected: int | None) -> dict[str, Column]:
    """Rows too many or too few; any number above 0 is fine without ``expected``."""
    rows = F.count(F.lit(1))
    off = F.when(rows == 0, 1).otherwise(0) if expected is None else F.abs(rows - expected)
    return {"row_count": off.cast("long")}


def gate_rows(artifact: str, counts: dict[str, int], spark) -> DataFrame:
    return spark.createDataFrame(
        [(artifact, gate, n, n == 0) for gate, n in counts.items()], GATE_SCHEMA)
