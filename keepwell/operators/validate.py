"""Table expectations: what an account table, or a table made from it, must keep.

All per-row checks of the input come from a single aggregation without a
shuffle. Only the duplicate check needs one, on the id column alone, and sums
copies on the map side first, so an id that fills a third of the table is no
hot spot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keepwell import contract as C
from keepwell.functions.features import repaired
from keepwell.sources import accounts as A
from keepwell.sources import tables

REPORT_SCHEMA = "position int, check string, column string, violations bigint"


class AccountTableError(ValueError):
    """The table breaks its contract."""


def missing_columns(df: DataFrame, required=C.COLUMNS) -> list[str]:
    return [c for c in required if c not in df.columns]


def unexpected_columns(df: DataFrame, allowed=C.COLUMNS) -> list[str]:
    return [c for c in df.columns if c not in allowed]


def duplicate_keys(df: DataFrame, key: str = C.ID) -> DataFrame:
    """Keys that occur more than once, with their number of extra copies."""
    return (
        df.groupBy(key).agg((F.count("*") - 1).alias("extra_copies"))
        .where("extra_copies > 0")
    )


def duplicate_count(df: DataFrame, key: str = C.ID) -> DataFrame:
    """One row: keys, extra copies, distinct keys."""
    per_key = df.groupBy(key).agg(F.count("*").alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
        F.count("*").alias("distinct_keys"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("extra_copies"))


def _unknown(col: Column, vocabulary) -> Column:
    return col.isNotNull() & ~col.isin(*vocabulary)


def _row_checks(df: DataFrame) -> list[tuple[int, str, str, Column]]:
    """(position, check, column, condition) of everything seen in a single row."""
    types, present = dict(df.dtypes), set(df.columns)
    checks = []
    for c in C.NUMERIC:
        if c in present:
            bad = F.col(c).isNotNull() & A.numeric_value(c, types[c]).isNull()
            checks.append((5, "non_numeric", c, bad))
    for c in C.COLUMNS:
        if c in present and c not in C.BLANKABLE:
            checks.append((6, "unexpected_blank", c, F.col(c).isNull()))
    for c in C.CATEGORY_FIELDS:
        if c in present:
            position = 8 if c == "Churn_Category" else 7
            checks.append((position, "vocabulary", c, _unknown(F.col(c), C.FIELD[c].vocabulary)))
    if {"Phone_Service", "Internet_Service"} <= present:
        for c in C.BLANKABLE:
            if c in present and c not in C.OUTCOMES:
                checks.append((9, "unrepaired_blank", c, repaired(c).isNull()))
        for c in C.YES_NO_FIELDS:
            if c in present:
                checks.append((10, "yes_no", c, _unknown(repaired(c), C.YES_NO)))
    return checks


def _long(df: DataFrame, checks, totals=()) -> DataFrame:
    """Count every condition in one aggregation, then one output row each;
    ``totals`` are further entries that bring their own aggregate."""
    checks = [(*head, F.count_if(cond)) for *head, cond in checks] + list(totals)
    counted = df.agg(*[count.alias(f"n{i}") for i, (*_, count) in enumerate(checks)])
    rows = [F.struct(F.lit(p).alias("position"), F.lit(name).alias("check"),
                     F.lit(c).alias("column"), F.col(f"n{i}").alias("violations"))
            for i, (p, name, c, _) in enumerate(checks)]
    return counted.select(F.inline(F.array(*rows)))


def column_findings(df: DataFrame) -> list[tuple[int, str, str, int]]:
    """What the schema alone shows, in the rows of the report."""
    return ([(2, "missing_column", c, 1) for c in missing_columns(df)]
            + [(3, "unexpected_column", c, 1) for c in unexpected_columns(df)])


def row_counts(df: DataFrame) -> dict[tuple[int, str, str], Column]:
    """All single-row checks of the report as aggregates, by (position, check, column)."""
    return {(p, name, c): F.count_if(cond) for p, name, c, cond in _row_checks(df)}


def validation_report(df: DataFrame, expected_rows: int | None = None) -> DataFrame:
    """(position, check, column, violations) in the order failures are raised."""
    spark = df.sparkSession
    plan_time = column_findings(df)
    wanted = F.lit(expected_rows) if expected_rows is not None else F.count("*")
    rows = _long(df, _row_checks(df), [(1, "row_count", "*", F.abs(F.count("*") - wanted))])
    if C.ID in df.columns:
        rows = rows.unionByName(duplicate_count(df).select(
            F.lit(4).alias("position"), F.lit("duplicate_id").alias("check"),
            F.lit(C.ID).alias("column"), F.col("extra_copies").alias("violations")))
    if plan_time:
        rows = rows.unionByName(spark.createDataFrame(plan_time, REPORT_SCHEMA))
    return rows


def enforce(report: DataFrame) -> None:
    """Raise on the first violated check. The report has one row per check and
    column of the contract, so fetching it is bounded."""
    enforce_rows([tuple(r) for r in report.where("violations > 0").select(
        "position", "check", "column", "violations").collect()])


def enforce_rows(rows: list[tuple[int, str, str, int]]) -> None:
    """The same for the rows of a report that are here already."""
    broken = sorted(((p, c, check, n) for p, check, c, n in rows if n))
    if broken:
        first = broken[0][2]
        same = [f"{c} ({n})" for _, c, check, n in broken if check == first]
        raise AccountTableError(f"check {first} failed: {', '.join(same)}")


def numeric_coercion(df: DataFrame) -> DataFrame:
    return _long(df, [c for c in _row_checks(df) if c[1] == "non_numeric"]).drop("position", "check")


def blank_profile(df: DataFrame, columns=None) -> DataFrame:
    """Blanks per column, one scan."""
    names = columns or df.columns
    return _long(df, [(0, "blank", c, F.col(c).isNull()) for c in names]).select(
        "column", F.col("violations").alias("blanks"))


def vocabulary_check(df: DataFrame) -> DataFrame:
    return _long(df, [c for c in _row_checks(df) if c[1] == "vocabulary"]).drop("position", "check")


def vocabulary_violations(df: DataFrame) -> DataFrame:
    """The offending texts with their counts, as a table rather than a set in
    memory: a garbage column can hold any number of different texts."""
    pairs = F.array(*[
        F.when(_unknown(F.col(c), C.FIELD[c].vocabulary),
               F.struct(F.lit(c).alias("column"), F.col(c).alias("value")))
        for c in C.CATEGORY_FIELDS if c in df.columns
    ])
    return (
        df.select(F.inline(F.array_compact(pairs)))
        .groupBy("column", "value").agg(F.count("*").alias("row_count"))
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("row_count"))


def not_finite(col: Column) -> Column:
    number = col.cast("double")
    return number.isNull() | F.isnan(number) | number.isin(float("inf"), float("-inf"))


def finite_check(df: DataFrame, columns) -> DataFrame:
    """Per column the values that are blank, NaN or infinite."""
    return _long(df, [(0, "finite", c, not_finite(F.col(c))) for c in columns]).select(
        "column", F.col("violations").alias("not_finite"))


def feature_nulls(features: DataFrame) -> DataFrame:
    """Post-condition of feature building: nothing may be blank. Column names
    are checked at plan time."""
    if len(set(features.columns)) != len(features.columns):
        raise AccountTableError("duplicate column names in the feature table")
    return blank_profile(features)


def score_range_check(scores: DataFrame) -> DataFrame:
    p = F.col(C.PROBABILITY)
    return scores.agg(
        F.count("*").alias("row_count"),
        F.count_if(not_finite(p)).alias("probability_not_finite"),
        F.count_if(~p.between(0.0, 1.0)).alias("probability_out_of_range"),
        F.count_if(not_finite(F.col(C.VALUE))).alias("value_not_finite"))


def assignment_contract(assignments: DataFrame, profiles: DataFrame) -> DataFrame:
    """One row and one known name per account. ``profiles`` has one row per
    cluster, which bounds the broadcast."""
    known = F.broadcast(profiles.select(F.col("segment").alias("known")).distinct())
    named = assignments.join(known, F.col(C.SEGMENT) == F.col("known"), "left")
    rows = named.agg(
        F.count("*").alias("row_count"),
        F.count_if(F.col(C.SEGMENT).isNull()).alias("null_names"),
        F.count_if(F.col(C.SEGMENT).isNotNull() & F.col("known").isNull()).alias("unknown_names"))
    unused = known.join(assignments.select(C.SEGMENT).distinct(),
                        F.col("known") == F.col(C.SEGMENT), "left_anti").agg(F.count("*"))
    extra = duplicate_count(assignments).select("extra_copies")
    return rows.withColumns({"unused_names": unused.scalar(), "extra_copies": extra.scalar()})


def label_contract(matrix: DataFrame) -> DataFrame:
    """Counts that must all be zero except ``row_count``."""
    label = F.col(C.LABEL)
    counts = matrix.agg(
        F.count("*").alias("row_count"),
        F.count_if(label.isNull()).alias("null_labels"),
        F.count_if(_unknown(label, C.PRIORITY_LABELS)).alias("unknown_labels"),
        *[F.count_if(label == name).alias(f"n{i}") for i, name in enumerate(C.PRIORITY_LABELS)])
    unused = sum((F.when(F.col(f"n{i}") == 0, 1).otherwise(0)
                  for i in range(len(C.PRIORITY_LABELS))), F.lit(0))
    extra = duplicate_count(matrix).select("extra_copies")
    return counts.select("row_count", "null_labels", "unknown_labels",
                         unused.cast("bigint").alias("unused_labels"),
                         extra.scalar().alias("extra_copies"))


def require_zero(counts: DataFrame, what: str, ignore=("row_count",)) -> int:
    """Raise unless every counter of a one-row contract table is 0."""
    row = counts.first().asDict()
    broken = {k: v for k, v in row.items() if k not in ignore and v}
    if broken:
        raise AccountTableError(f"{what}: {broken}")
    return row.get("row_count", 0)


def require_one_to_one(left: DataFrame, right: DataFrame, key: str = C.ID) -> None:
    """Both sides unique on the key and the right one covering the left."""
    for side, name in ((left, "left"), (right, "right")):
        require_zero(duplicate_count(side, key), f"{name} side of the join",
                     ignore=("row_count", "distinct_keys"))
    uncovered = left.select(key).join(right.select(key), key, "left_anti")
    if not uncovered.isEmpty():
        raise AccountTableError(f"{key} values without a match on the right side")


def require_numeric(df: DataFrame, columns) -> None:
    types = dict(df.dtypes)
    text = [c for c in columns if types.get(c, "string") in ("string", "boolean")]
    if text:
        raise AccountTableError(f"predictors that are not numbers: {text}")


def require_inputs(expected, columns, exact: bool = True) -> None:
    """Drift guard: a model only scores the columns it was fitted on. The base
    table must offer exactly these, a record may carry more."""
    expected, columns = list(expected), list(columns)
    if exact and expected != columns:
        raise AccountTableError("the feature table changed since the model was fitted")
    absent = [c for c in expected if c not in columns]
    if absent:
        raise AccountTableError(f"columns the model needs are absent: {absent}")


def artifact_gates(spark: SparkSession, root: str, expected_rows: int | None = None) -> DataFrame:
    """(gate, passed, detail) over the stored stage tables: row counts, no
    blanks, number of segments, usable metrics."""
    results = []
    gone = tables.missing_artifacts(spark, root)

    def gate(name, needs, probe):
        absent = [n for n in needs if n in gone]
        passed, detail = (False, f"missing {absent}") if absent else probe()
        results.append((name, bool(passed), detail))

    def read(name):
        return tables.read_table(spark, root, name)

    def features_gate():
        df = read("features")
        n, blanks = df.count(), blank_profile(df).agg(F.sum("blanks")).first()[0]
        return blanks == 0 and (expected_rows is None or n == expected_rows), f"{n} rows, {blanks} blanks"

    def metrics_gate(name):
        def probe():
            df = read(name)
            numbers = [c for c, t in df.dtypes if t in ("double", "bigint", "int")]
            bad = finite_check(df, numbers).agg(F.sum("not_finite")).first()[0]
            size = df.agg(F.sum(sum((F.abs(F.col(c)) for c in numbers), F.lit(0.0)))).first()[0]
            return bad == 0 and bool(size), f"{bad} unusable values"
        return probe

    def segments_gate():
        n = read("segment_profiles").count()
        return n == C.SEGMENT_COUNT, f"{n} segments"

    def matrix_gate():
        row = label_contract(read("priority_matrix")).first()
        ok = not (row["null_labels"] or row["unknown_labels"] or row["extra_copies"])
        return ok and (expected_rows is None or row["row_count"] == expected_rows), \
            f"{row['row_count']} rows, {row['null_labels']} null labels"

    gate("features", ["features"], features_gate)
    gate("churn_model", ["churn_model", "churn_model_comparison"], metrics_gate("churn_model_comparison"))
    gate("clv_model", ["clv_model", "clv_metrics"], metrics_gate("clv_metrics"))
    gate("segmentation_model", ["segmentation_model", "segment_profiles"], segments_gate)
    gate("priority_matrix", ["priority_matrix"], matrix_gate)
    return spark.createDataFrame(results, "gate string, passed boolean, detail string")
