"""Spark ML models: balanced churn classifiers and the value regressor.

Every fit sees the same row layout (hash-partitioned on the id, sorted inside
each partition) because bagging draws per partition: with it a seed means the
same forest on every run.
"""

from __future__ import annotations

import json
import math
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keepwell import contract as C
from keepwell.operators import metrics as M
from keepwell.operators.sampling import exact_split
from keepwell.operators.validate import (
    AccountTableError, finite_check, require_inputs, require_numeric,
)

LOGISTIC, FOREST = C.CHURN_MODEL_NAMES


@dataclass(frozen=True)
class ForestSettings:
    """Library defaults. Depth is bounded where Spark's level-wise growth stays
    affordable, and ``bins`` is the number of candidate cuts per feature (an
    exact search would sort every feature); 100 trees and the feature subset
    rule are the usual defaults."""
    trees: int = 100
    depth: int = 10
    bins: int = 128


@dataclass(frozen=True)
class FittedModel:
    name: str
    inputs: tuple[str, ...]
    pipeline: PipelineModel

    def save(self, path: str) -> None:
        self.pipeline.write().overwrite().save(f"{path}/pipeline")
        spark = SparkSession.active()
        note = json.dumps({"name": self.name, "inputs": list(self.inputs)})
        spark.createDataFrame([(note,)], "value string").coalesce(1).write.mode(
            "overwrite").text(f"{path}/contract")

    @staticmethod
    def load(path: str) -> "FittedModel":
        note = json.loads(SparkSession.active().read.text(f"{path}/contract").first()[0])
        return FittedModel(note["name"], tuple(note["inputs"]),
                           PipelineModel.load(f"{path}/pipeline"))


# --- training sets ----------------------------------------------------------

def churn_training_set(features: DataFrame, predictors=C.CHURN_PREDICTORS) -> DataFrame:
    """Accounts whose outcome is known; recent sign-ups carry no label yet."""
    require_numeric(features, predictors)
    return (
        features.where(F.col("Customer_Status").isin(*C.LABELLED_STATUSES))
        .select(C.ID, (F.col("Customer_Status") == "Churned").cast("double").alias("label"),
                *predictors)
    )


def value_training_set(features: DataFrame, predictors=C.VALUE_PREDICTORS) -> DataFrame:
    """All accounts, including recent sign-ups."""
    require_numeric(features, predictors)
    return features.select(
        C.ID, F.col(C.VALUE_TARGET).try_cast("double").alias("label"), *predictors)


def require_both_classes(counts: dict) -> None:
    if not counts.get(0.0) or not counts.get(1.0):
        raise AccountTableError("a classifier needs churned and stayed accounts")


def require_finite(df: DataFrame, columns) -> None:
    broken = finite_check(df, columns).where("not_finite > 0").collect()
    if broken:
        raise AccountTableError(f"not finite: {[r['column'] for r in broken]}")


@dataclass(frozen=True)
class Layout:
    """How many tasks share a fit's rows: one for each ``few`` rows, up to
    ``tasks`` of them; then these take more rows each, up to ``most``."""
    few: int
    tasks: int
    most: int

    def parts(self, n: int) -> int:
        return max(1, min(self.tasks, math.ceil(n / self.few)), math.ceil(n / self.most))


# Forests do much work per row, but in every pass each task sends the counters of
# all bins of all open nodes, however few rows it has: some hundred MB a fit and
# task. K-means does little per row, and a task sends a row per cluster.
FOREST_LAYOUT = Layout(few=2_000, tasks=12, most=500_000)
KMEANS_LAYOUT = Layout(few=100_000, tasks=2_000, most=100_000)


@contextmanager
def fixed_layout(df: DataFrame, layout: Layout = FOREST_LAYOUT):
    """Cached rows in the layout every fit shares. Bagging draws per partition,
    so the number of partitions follows the row count and these parameters
    alone, never a session setting: the same rows and seed give the same forest
    on any cluster."""
    parts = layout.parts(df.count())
    rows = df.repartition(parts, C.ID).sortWithinPartitions(C.ID).persist(
        StorageLevel.MEMORY_AND_DISK)
    try:
        yield rows
    finally:
        rows.unpersist()


# --- fits -------------------------------------------------------------------

def balanced(train: DataFrame) -> tuple[DataFrame, int]:
    """Adds ``weight`` = n / (2 n_class); the two class sizes come to the
    driver, the weight goes back as a literal."""
    sizes = {r["label"]: r["n"] for r in
             train.groupBy("label").agg(F.count("*").alias("n")).collect()}
    require_both_classes(sizes)
    n = sum(sizes.values())
    weight = F.when(F.col("label") == 1.0, n / (2.0 * sizes[1.0])).otherwise(n / (2.0 * sizes[0.0]))
    return train.withColumn("weight", weight), n


def assembler(inputs, out: str) -> VectorAssembler:
    return VectorAssembler(inputCols=list(inputs), outputCol=out, handleInvalid="error")


def logistic_pipeline(inputs, n: int) -> Pipeline:
    """L2 strength of a unit inverse penalty over n rows. The scaler divides by
    the n-1 deviation; (n-1)/n in the penalty makes up for that."""
    return Pipeline(stages=[
        assembler(inputs, "churn_raw"),
        StandardScaler(inputCol="churn_raw", outputCol="churn_features",
                       withMean=True, withStd=True),
        LogisticRegression(
            featuresCol="churn_features", labelCol="label", weightCol="weight",
            probabilityCol="churn_class_shares", rawPredictionCol="churn_margin",
            predictionCol="prediction", regParam=(n - 1) / n / n, elasticNetParam=0.0,
            standardization=False, maxIter=100),
    ])


def forest_pipeline(inputs, settings: ForestSettings) -> Pipeline:
    return Pipeline(stages=[
        assembler(inputs, "churn_features"),
        RandomForestClassifier(
            featuresCol="churn_features", labelCol="label", weightCol="weight",
            probabilityCol="churn_class_shares", rawPredictionCol="churn_margin",
            predictionCol="prediction", numTrees=settings.trees, maxDepth=settings.depth,
            maxBins=settings.bins, featureSubsetStrategy="sqrt", seed=C.SEED),
    ])


def value_pipeline(inputs, settings: ForestSettings) -> Pipeline:
    return Pipeline(stages=[
        assembler(inputs, "value_features"),
        RandomForestRegressor(
            featuresCol="value_features", labelCol="label", predictionCol=C.VALUE,
            numTrees=settings.trees, maxDepth=settings.depth, maxBins=settings.bins,
            featureSubsetStrategy="all", seed=C.SEED),
    ])


def fit_churn_models(train: DataFrame, inputs=C.CHURN_PREDICTORS,
                     settings: ForestSettings = ForestSettings()) -> dict[str, FittedModel]:
    with fixed_layout(train.select(C.ID, "label", *inputs)) as rows:
        weighted, n = balanced(rows)
        return {
            LOGISTIC: FittedModel(LOGISTIC, tuple(inputs), logistic_pipeline(inputs, n).fit(weighted)),
            FOREST: FittedModel(FOREST, tuple(inputs), forest_pipeline(inputs, settings).fit(weighted)),
        }


def fit_value_model(train: DataFrame, inputs=C.VALUE_PREDICTORS,
                    settings: ForestSettings = ForestSettings()) -> FittedModel:
    with fixed_layout(train.select(C.ID, "label", *inputs)) as rows:
        return FittedModel("Random Forest Regressor", tuple(inputs),
                           value_pipeline(inputs, settings).fit(rows))


# --- use --------------------------------------------------------------------

def churn_scores(model: FittedModel, df: DataFrame) -> DataFrame:
    """Adds the churn probability and the 0/1 prediction."""
    out = model.pipeline.transform(df)
    vectors = [c for c in ("churn_raw", "churn_features", "churn_margin", "churn_class_shares")
               if c in out.columns]
    return out.withColumn(C.PROBABILITY, vector_to_array("churn_class_shares")[1]).drop(*vectors)


def value_scores(model: FittedModel, df: DataFrame) -> DataFrame:
    return model.pipeline.transform(df).drop("value_features")


def score_base(features: DataFrame, churn: FittedModel, value: FittedModel,
               exact_inputs: bool = True) -> DataFrame:
    """Both scores for every account, labelled or not. Rows that were used for
    fitting are scored in-sample, like the rest of the base."""
    offered = [c for c in features.columns if c not in C.IDENTITY_COLUMNS
               and c not in C.ONE_HOT_FIELDS and c not in C.OUTCOMES]
    require_inputs(churn.inputs, offered, exact_inputs)
    value_offered = [c for c in offered
                     if c != C.VALUE_TARGET and c not in C.VALUE_COMPONENTS]
    require_inputs(value.inputs, value_offered, exact_inputs)
    scored = value_scores(value, churn_scores(churn, features))
    return scored.select(C.ID, C.PROBABILITY, C.VALUE)


def held_out_predictions(models: dict[str, FittedModel], test: DataFrame) -> DataFrame:
    """Predictions of all models on the same rows, stacked."""
    parts = [
        churn_scores(m, test).select(
            F.lit(name).alias("model"), C.ID, "label", "prediction", C.PROBABILITY)
        for name, m in models.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def compare_models(predictions: DataFrame, names=C.CHURN_MODEL_NAMES) -> DataFrame:
    """(model, accuracy, precision, recall, f1, roc_auc); ``names`` is the
    short list of fitted models."""
    rates = M.classification_metrics(predictions)
    aucs = None
    for name in names:
        auc = M.roc_auc(predictions.where(F.col("model") == name), C.PROBABILITY)
        auc = auc.select(F.lit(name).alias("model"), "roc_auc")
        aucs = auc if aucs is None else aucs.unionByName(auc)
    return rates.join(F.broadcast(aucs), "model")


def best_model(comparison: DataFrame) -> DataFrame:
    """Highest AUC, F1 on a tie."""
    return comparison.orderBy(F.desc("roc_auc"), F.desc("f1"), "model").limit(1)


def feature_importance(model: FittedModel) -> DataFrame:
    """Impurity shares, largest first; one row per model input."""
    shares = model.pipeline.stages[-1].featureImportances.toArray()
    rows = sorted(zip(model.inputs, map(float, shares)), key=lambda r: (-r[1], r[0]))
    return SparkSession.active().createDataFrame(
        [(i, f, s) for i, (f, s) in enumerate(rows, start=1)],
        "position int, feature string, importance double")


def top_drivers(importance: DataFrame, k: int = 10) -> DataFrame:
    return importance.orderBy(F.desc("importance"), "feature").limit(k)


def value_model_report(model: FittedModel, test: DataFrame) -> DataFrame:
    """One row: rmse, mae, r2 on held-out accounts."""
    return M.regression_metrics(value_scores(model, test), "label", C.VALUE)


def split_training_set(training: DataFrame, strata: str | None) -> tuple[DataFrame, DataFrame]:
    drawn = exact_split(training, strata=strata)
    return drawn.where(~F.col("is_test")).drop("is_test"), drawn.where("is_test").drop("is_test")
