"""Feature table and fitted models, made once per session and state of the data.

Fitting is the expensive part of every model query. The first query that
needs a model fits it; the others reuse it until a source file changes.
``bench.py`` times the fits as lines of their own, so the reuse hides nothing.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keepwell import contract as C
from keepwell.operators import explain
from keepwell.operators import models as ML
from keepwell.operators import priority as PR
from keepwell.operators import segments as SG
from keepwell.operators.prepare import build_features
from keepwell.operators.score import Bundle, score_records
from keepwell.session import checkpoint_dir, materialise
from keepwell.sources.snapshots import per_snapshot
from keepwell.sources.star_schema import SOURCE_TABLES, accounts


def _sources(sf: str) -> list[str]:
    return [f"{sf}/{table}.parquet" for table in SOURCE_TABLES]


kept = per_snapshot(_sources)

@kept
def features(spark: SparkSession, sf: str) -> DataFrame:
    """The stored feature table, the hand-over between pipeline stages. Splits
    and fits scan it many times."""
    return materialise(build_features(accounts(spark, sf)))


@kept
def churn(spark, sf) -> dict[str, ML.FittedModel]:
    train, _ = churn_split(spark, sf)
    return ML.fit_churn_models(train)


@kept
def value(spark, sf) -> ML.FittedModel:
    train, _ = value_split(spark, sf)
    return ML.fit_value_model(train)


@kept
def segments(spark, sf) -> SG.SegmentModel:
    return SG.fit_segments(features(spark, sf))


@kept
def _k_sweep(spark, sf):
    """The sweep's seven result rows and the clusters they were measured on."""
    return SG.sweep(features(spark, sf))


@kept
def _deployed(spark, sf) -> str:
    return ML.best_model(full_comparison(spark, sf)).first()["model"]


def churn_split(spark, sf):
    return ML.split_training_set(ML.churn_training_set(features(spark, sf)), "label")


def value_split(spark, sf):
    return ML.split_training_set(ML.value_training_set(features(spark, sf)), None)


def k_evaluation(spark, sf) -> DataFrame:
    return spark.createDataFrame(_k_sweep(spark, sf)[0], SG.EVALUATION_SCHEMA)


def k_clusters(spark, sf) -> DataFrame:
    return _k_sweep(spark, sf)[1]


@kept
def held_out(spark, sf) -> DataFrame:
    """Predictions of both classifiers for the held-out accounts."""
    _, test = churn_split(spark, sf)
    return materialise(ML.held_out_predictions(churn(spark, sf), test))


@kept
def full_comparison(spark, sf) -> DataFrame:
    """Metrics of both classifiers on the held-out accounts; the deployed model
    is chosen from these, never from rounded ones."""
    return materialise(ML.compare_models(held_out(spark, sf)))


def comparison(spark, sf) -> DataFrame:
    """The same, rounded to 4 places for the report."""
    compared = full_comparison(spark, sf)
    return compared.select("model", *[
        F.round(c, 4).alias(c) for c in compared.columns if c != "model"])


def contributions(spark, sf) -> DataFrame:
    """Over all held-out accounts."""
    _, test = churn_split(spark, sf)
    scratch = f"{checkpoint_dir(spark)}/forest-nodes-{uuid.uuid4().hex}"
    return explain.contribution_summary(churn(spark, sf), test, scratch)


def profiles(spark, sf) -> DataFrame:
    f = features(spark, sf).select(C.ID, *C.SEGMENT_FEATURES)
    model = segments(spark, sf)
    return SG.segment_profiles(model.assign(f), model, SG.population_terciles(f))


def scores(spark, sf) -> DataFrame:
    best = churn(spark, sf)[_deployed(spark, sf)]
    return ML.score_base(features(spark, sf), best, value(spark, sf))


@kept
def bundle(spark, sf) -> Bundle:
    """What scoring needs, fitted on the base."""
    names = {r["cluster"]: r["segment"] for r in
             profiles(spark, sf).select("cluster", "segment").collect()}
    return Bundle(churn(spark, sf)[_deployed(spark, sf)], value(spark, sf), segments(spark, sf), names,
                  PR.median_thresholds(stored_scores(spark, sf)))


@kept
def stored_scores(spark, sf) -> DataFrame:
    return materialise(scores(spark, sf))


def score_new(spark, sf) -> DataFrame:
    """All accounts sent through the scoring function against stored medians."""
    return score_records(accounts(spark, sf), bundle(spark, sf))
