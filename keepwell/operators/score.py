"""Scoring new records against the stored models, names and medians.

``score_records`` uses projections only (models, segment names and the two
medians travel as literals), so one function serves a batch of any size and a
stream. New records are never compared with their own batch's median.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keepwell import contract as C
from keepwell.functions import rules
from keepwell.functions.features import repaired
from keepwell.operators import models as ML
from keepwell.operators.prepare import build_features, score_frame
from keepwell.operators.priority import Thresholds, label_accounts
from keepwell.operators.segments import SegmentModel
from keepwell.operators.validate import require_inputs
from keepwell.sources import tables

BUNDLE_PARTS = ("churn_model", "clv_model", "segmentation_model",
                "segment_profiles", "thresholds")


@dataclass(frozen=True)
class Bundle:
    churn: ML.FittedModel
    value: ML.FittedModel
    segments: SegmentModel
    names: dict[int, str]
    thresholds: Thresholds

    def save(self, root: str) -> None:
        spark = SparkSession.active()
        self.churn.save(tables.table_path(root, "churn_model"))
        self.value.save(tables.table_path(root, "clv_model"))
        self.segments.fitted.save(tables.table_path(root, "segmentation_model"))
        names = spark.createDataFrame(sorted(self.names.items()), "cluster int, segment string")
        if not tables.path_exists(spark, tables.table_path(root, "segment_profiles")):
            tables.write_table(names, root, "segment_profiles")
        cuts = spark.createDataFrame([(self.thresholds.probability, self.thresholds.value)],
                                     "probability double, value double")
        tables.write_table(cuts, root, "thresholds")

    @staticmethod
    def load(root: str) -> "Bundle":
        spark = SparkSession.active()
        gone = tables.missing_artifacts(spark, root, BUNDLE_PARTS)
        if gone:
            raise FileNotFoundError(f"run the pipeline first; missing: {gone}")
        cuts = tables.read_table(spark, root, "thresholds").first()
        rows = tables.read_table(spark, root, "segment_profiles").select(
            "cluster", "segment").collect()          # one row per cluster
        names = {r["cluster"]: r["segment"] for r in rows}
        if len(names) != len(rows):
            raise ValueError("duplicate cluster numbers in the segment profiles")
        segments = SegmentModel.of(ML.FittedModel.load(tables.table_path(root, "segmentation_model")))
        unnamed = set(segments.numbering) - {k for k, name in names.items() if name}
        if unnamed:
            raise ValueError(f"clusters without a segment name: {sorted(unnamed)}")
        return Bundle(
            ML.FittedModel.load(tables.table_path(root, "churn_model")),
            ML.FittedModel.load(tables.table_path(root, "clv_model")),
            segments, names, Thresholds(cuts["probability"], cuts["value"]))


def rejection_reasons() -> Column:
    """All reasons a raw record cannot be scored, as an array; empty if none.
    A value that is no number of its type is blank after ``score_frame`` and
    is reported as such. A field has one reason at most."""
    reasons = []
    for name in C.SCORE_INPUTS:
        field, value = C.FIELD[name], F.col(name)
        blank = repaired(name).isNull() if field.may_be_blank else value.isNull()
        word = "blank that cannot be repaired" if field.may_be_blank else "missing"
        reason = F.when(blank, F.lit(f"{name}: {word}"))
        if field.vocabulary:
            reason = reason.when(value.isNotNull() & ~value.isin(*field.vocabulary), F.lit(f"{name}: unknown value"))
        if name in C.SCORE_BOUNDS:
            low, high = C.SCORE_BOUNDS[name]
            outside = value < low if high is None else (value < low) | (value > high)
            reason = reason.when(outside, F.lit(f"{name}: out of range"))
        if name == "Tenure_in_Months":
            reason = reason.when(value == 0, F.lit(f"{name}: zero, no referral rate"))
        reasons.append(reason)
    return F.array_compact(F.array(*reasons))


def check_records(records: DataFrame) -> DataFrame:
    """Records on the scoring layout plus their ``reasons``."""
    return score_frame(records).withColumn("reasons", rejection_reasons())


def accepted(checked: DataFrame) -> DataFrame:
    return checked.where(F.size("reasons") == 0).drop("reasons")


def rejected(checked: DataFrame) -> DataFrame:
    return checked.where(F.size("reasons") > 0)


def _scored(features: DataFrame, bundle: Bundle) -> DataFrame:
    """``features`` with probability, value, cluster, segment and label."""
    for model in (bundle.churn, bundle.value, bundle.segments.fitted):
        require_inputs(model.inputs, features.columns, exact=False)
    scored = ML.value_scores(bundle.value, ML.churn_scores(bundle.churn, features))
    named = bundle.segments.assign(scored)
    segment = F.lit(None).cast("string")
    for cluster, name in sorted(bundle.names.items()):
        segment = F.when(F.col("cluster") == cluster, name).otherwise(segment)
    return label_accounts(named.withColumn(C.SEGMENT, segment), bundle.thresholds)


OUTPUTS = {"churn_probability": C.PROBABILITY, "predicted_clv": C.VALUE, "segment": C.SEGMENT,
           "priority_label": C.LABEL}


def neutral(name: str) -> Column:
    """A valid value of a column, scored in place of a record that is rejected."""
    field = C.FIELD[name]
    return F.lit(field.vocabulary[0] if field.vocabulary else 1).cast(C.ACCOUNT_SCHEMA[name].dataType)


def score_records(records: DataFrame, bundle: Bundle) -> DataFrame:
    """One row per record: customer_id, accepted, reasons, and the scores, which
    are NULL for a rejected record. Nothing is dropped and nothing is joined:
    rejected records run through the models as neutral ones."""
    checked = check_records(records)
    fine = F.size("reasons") == 0
    safe = checked.select(C.ID, "reasons", *[
        F.when(fine, F.col(c)).otherwise(neutral(c)).alias(c) for c in C.SCORE_INPUTS])
    scored = _scored(build_features(safe, keep=("reasons",)), bundle)
    unnamed = (F.size("reasons") == 0) & F.col(C.SEGMENT).isNull()
    judged = scored.withColumn("reasons", F.when(
        unnamed, F.array(F.lit("cluster: no segment name"))).otherwise(F.col("reasons")))
    fine = F.size("reasons") == 0
    return judged.select(
        F.col(C.ID).alias("customer_id"), fine.alias("accepted"), "reasons",
        *[F.when(fine, F.col(c)).alias(n) for n, c in OUTPUTS.items()])


def score_accounts(records: DataFrame, bundle: Bundle) -> DataFrame:
    """Scores of the accepted records only."""
    return score_records(records, bundle).where("accepted").select("customer_id", *OUTPUTS)
