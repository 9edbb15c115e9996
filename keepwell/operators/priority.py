"""The 2x2 retention rule, segment context and the ranked save list."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keepwell import contract as C
from keepwell.functions import rules
from keepwell.operators.ordering import rank_global
from keepwell.operators.quantiles import exact_quantiles


@dataclass(frozen=True)
class Thresholds:
    """Medians of the whole base. Two numbers, so they enter plans as
    literals: no join, no subquery, and the same values serve a stream."""
    probability: float
    value: float


def median_thresholds(scores: DataFrame) -> Thresholds:
    q = exact_quantiles(scores, [C.PROBABILITY, C.VALUE], [0.5])
    return Thresholds(q[C.PROBABILITY][0], q[C.VALUE][0])


def high_risk(thresholds: Thresholds):
    return F.col(C.PROBABILITY) >= F.lit(thresholds.probability)


def high_value(thresholds: Thresholds):
    return F.col(C.VALUE) >= F.lit(thresholds.value)


def label_accounts(scores: DataFrame, thresholds: Thresholds) -> DataFrame:
    return scores.withColumn(
        C.LABEL, rules.priority_label(high_risk(thresholds), high_value(thresholds)))


def attach_segments(labelled: DataFrame, assignments: DataFrame) -> DataFrame:
    """Left join on the account id. Uniqueness and coverage are the caller's
    ``require_one_to_one``; the plan itself stays lazy."""
    return labelled.join(assignments.select(C.ID, C.SEGMENT), C.ID, "left")


def ranked_list(matrix: DataFrame, name: str = "rank") -> DataFrame:
    """Most urgent first: label order, probability downwards, id as tie-break."""
    return rank_global(
        matrix.withColumn("_label", rules.label_position(F.col(C.LABEL))),
        [F.asc("_label"), F.desc(C.PROBABILITY), F.asc(C.ID)], name,
    ).drop("_label")
