"""How far a table has drifted from what its readers expect of it.

A reader is the account contract or a fitted model: a list of columns, some of
which must be numbers. The comparison itself reads schemas only and runs no job;
``drift_table`` adds, in one aggregation per table, how many values are concerned.
"""

from __future__ import annotations

from bisect import bisect_left
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keepwell import contract as C
from keepwell.sources.accounts import text_number

MISSING, UNEXPECTED, NO_NUMBER, MOVED = "missing", "unexpected", "not a number", "moved"
DRIFT_SCHEMA = "reader string, position int, column string, drift string, found string"


@dataclass(frozen=True)
class Reader:
    """What one reader expects. ``exact``: no other columns, and in this order."""
    name: str
    columns: tuple[str, ...]
    numbers: frozenset[str]
    exact: bool = True


@dataclass(frozen=True)
class Drift:
    reader: str
    position: int
    column: str
    drift: str
    found: str | None


def account_reader() -> Reader:
    return Reader("accounts", C.COLUMNS, frozenset(C.NUMERIC))


def model_reader(name: str, inputs, exact: bool = True) -> Reader:
    """All inputs of a model are numbers."""
    return Reader(name, tuple(inputs), frozenset(inputs), exact)


def _out_of_order(places: list[int]) -> set[int]:
    """Least set of entries without which ``places`` increases."""
    tails, ends, before = [], [], [-1] * len(places)
    for i, p in enumerate(places):
        at = bisect_left(tails, p)
        before[i] = ends[at - 1] if at else -1
        tails[at:at + 1], ends[at:at + 1] = [p], [i]
    kept, i = set(), ends[-1] if ends else -1
    while i >= 0:
        kept.add(i)
        i = before[i]
    return set(range(len(places))) - kept


def differences(df: DataFrame, reader: Reader, texts_are_typed: bool = True) -> list[Drift]:
    """Missing, unexpected, non-numeric and moved columns. With
    ``texts_are_typed`` off, text is taken as an extract that is yet to be typed,
    so that only booleans and nested types are no numbers."""
    types = dict(df.dtypes)
    place = {c: i for i, c in enumerate(df.columns)}
    out = [Drift(reader.name, i, c, MISSING, None)
           for i, c in enumerate(reader.columns) if c not in types]
    for i, c in enumerate(reader.columns):
        plain = types.get(c, "int").split("(")[0]
        number = plain in ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal")
        if c in reader.numbers and not number and (texts_are_typed or plain != "string"):
            out.append(Drift(reader.name, i, c, NO_NUMBER, types[c]))
    if reader.exact:
        out += [Drift(reader.name, place[c], c, UNEXPECTED, types[c])
                for c in df.columns if c not in set(reader.columns)]
        common = [c for c in reader.columns if c in types]
        moved = _out_of_order([place[c] for c in common])
        out += [Drift(reader.name, reader.columns.index(c), c, MOVED, f"column {place[c]}")
                for k, c in enumerate(common) if k in moved]
    return out


def drift_table(df: DataFrame, readers: list[Reader], texts_are_typed: bool = True) -> DataFrame:
    """One row per difference: reader, position, column, drift, found, ``values``
    (not blank) and ``unusable`` (of them, those that are no finite number where
    a number is expected). One scan of the columns concerned, none if all agree."""
    spark = df.sparkSession
    found = [d for r in readers for d in differences(df, r, texts_are_typed)]
    if not found:
        return spark.createDataFrame([], f"{DRIFT_SCHEMA}, `values` long, unusable long")
    types = dict(df.dtypes)
    numbers = {c for r in readers for c in r.numbers}
    counts = []
    for i, d in enumerate(found):
        col, bad = F.col(d.column), F.lit(False)
        if d.column not in types:
            counts += [F.lit(0).cast("long").alias(f"v{i}"), F.lit(0).cast("long").alias(f"u{i}")]
            continue
        if d.column in numbers and types[d.column] == "string":
            bad = col.isNotNull() & text_number(col).isNull()
        elif d.drift == NO_NUMBER:
            bad = col.isNotNull()
        counts += [F.count(col).alias(f"v{i}"), F.count_if(bad).alias(f"u{i}")]
    counted = df.agg(*counts) if any(d.column in types for d in found) else spark.range(1).select(*counts)
    return counted.select(F.inline(F.array(*[F.struct(
        F.lit(d.reader).alias("reader"), F.lit(d.position).alias("position"), F.lit(d.column).alias("column"),
        F.lit(d.drift).alias("drift"), F.lit(d.found).cast("string").alias("found"),
        F.col(f"v{i}").alias("values"), F.col(f"u{i}").alias("unusable")) for i, d in enumerate(found)])))


def class_presence(df: DataFrame, label: str = "label", classes=(0, 1)) -> DataFrame:
    """(class, members, present) per expected class and per class found: a
    classifier needs members of every expected one."""
    counts = df.groupBy(F.col(label).cast("string").alias("class")).agg(F.count("*").alias("members"))
    wanted = df.sparkSession.createDataFrame([(str(c),) for c in classes], "class string")
    both = wanted.withColumn("expected", F.lit(True)).join(counts, "class", "full")
    return both.select(
        "class", F.coalesce("expected", F.lit(False)).alias("expected"),
        F.coalesce("members", F.lit(0)).alias("members"), F.coalesce(F.col("members") > 0, F.lit(False)).alias("present"))
