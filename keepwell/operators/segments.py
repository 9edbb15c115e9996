"""K-means segments: number-of-clusters sweep, final fit, readable names."""

from __future__ import annotations

from contextlib import contextmanager
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import StandardScaler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from keepwell import contract as C
from keepwell.functions import rules
from keepwell.operators import lloyd
from keepwell.operators import metrics as M
from keepwell.operators.distances import euclidean_silhouettes
from keepwell.operators.models import (
    KMEANS_LAYOUT, FittedModel, assembler, fixed_layout,
)
from keepwell.operators.quantiles import exact_quantiles
from keepwell.operators.validate import AccountTableError
from keepwell.session import materialise

RESTARTS = 10
THIRDS = (1 / 3, 2 / 3)
EVALUATION_SCHEMA = "k int, inertia double, silhouette double, silhouette_squared double"
SCALED = [f"{c}_scaled" for c in C.SEGMENT_FEATURES]


def scaler_pipeline(inputs=C.SEGMENT_FEATURES) -> Pipeline:
    return Pipeline(stages=[
        assembler(inputs, "segment_raw"),
        StandardScaler(inputCol="segment_raw", outputCol="segment_features",
                       withMean=True, withStd=True),
    ])


def _exact_model(centroids) -> KMeansModel:
    """Spark's model with these centroids: one step over them as the only rows,
    each the first centroid of its own cluster."""
    spark = SparkSession.active()
    rows = spark.createDataFrame([(Vectors.dense(c),) for c in centroids], ["segment_features"])
    return KMeans(k=len(centroids), initMode="random", maxIter=1, seed=C.SEED,
                  featuresCol="segment_features", predictionCol="raw_cluster").fit(rows)


@contextmanager
def _scaled(features: DataFrame):
    """(fitted scaler, cached scaled columns): the rows themselves are only
    cached until the scaler is fitted and the columns are stored."""
    with fixed_layout(features.select(C.ID, *C.SEGMENT_FEATURES), KMEANS_LAYOUT) as rows:
        scaler = scaler_pipeline().fit(rows)
        values = vector_to_array("segment_features")
        points = scaler.transform(rows).select(*[values[i].alias(c) for i, c in enumerate(SCALED)]).persist()
        points.count()
    try:
        yield scaler, points
    finally:
        points.unpersist()


def sweep(features: DataFrame, ks=C.K_RANGE, restarts: int = RESTARTS) -> tuple[list[tuple], DataFrame]:
    """Rows of the evaluation, and the scaled points with the cluster of each k
    (columns ``k2``, ``k3`` ...) the rows were measured on. All fits share their
    passes over the rows, all clusterings their distances."""
    with _scaled(features) as (_, points):
        n = points.count()
        best = lloyd.best_of(lloyd.run_fits(points, SCALED, ks, restarts, C.SEED))
        names = {f"k{k}": fit for k, fit in sorted(best.items())}
        clustered = materialise(lloyd.with_clusters(points, SCALED, names))
    plain = {r["clustering"]: r["silhouette"] for r in
             euclidean_silhouettes(clustered, SCALED, list(names)).collect()}
    with ThreadPool(len(names)) as pool:
        squared = pool.map(lambda c: M.silhouette(clustered, SCALED, c).first()[0], names)
    # The scaler divides by the n-1 deviation; inertia is reported in units of
    # the population deviation.
    return [(fit.k, fit.inertia * n / (n - 1), plain[c], s)
            for (c, fit), s in zip(names.items(), squared)], clustered


def evaluate_k(features: DataFrame, ks=C.K_RANGE, restarts: int = RESTARTS) -> DataFrame:
    """(k, inertia, silhouette, silhouette_squared), all over all rows: the first
    silhouette by plain Euclidean distances, the second by squared ones."""
    return features.sparkSession.createDataFrame(sweep(features, ks, restarts)[0], EVALUATION_SCHEMA)


def best_k(evaluation: DataFrame) -> DataFrame:
    """Largest silhouette, the smaller k on a tie."""
    return evaluation.orderBy(F.desc("silhouette"), "k").limit(1)


@dataclass(frozen=True)
class Terciles:
    """Population thirds per segment feature: six numbers."""
    cuts: dict[str, tuple[float, float]]

    def level(self, column: Column, feature: str) -> Column:
        lower, upper = self.cuts[feature]
        return rules.tercile_level(column, F.lit(lower), F.lit(upper))


def population_terciles(features: DataFrame) -> Terciles:
    cuts = exact_quantiles(features, C.SEGMENT_FEATURES, THIRDS)
    return Terciles({c: (v[0], v[1]) for c, v in cuts.items()})


def name_profiles(profiles: DataFrame, terciles: Terciles) -> DataFrame:
    """Adds levels and names to one row per cluster.

    ``profiles`` carries cluster, customers, share and a ``<feature>_centroid``
    each. Names shared by several clusters get the service level appended on
    all of them.
    """
    level = {f: terciles.level(F.col(f"{f}_centroid"), f) for f in C.SEGMENT_FEATURES}
    tenure, spend, services = C.SEGMENT_FEATURES
    named = profiles.withColumns({
        "tenure_level": level[tenure], "spend_level": level[spend],
        "services_level": level[services],
    }).withColumn("segment", rules.segment_name(F.col("tenure_level"), F.col("spend_level")))
    twins = F.count("*").over(Window.partitionBy("segment"))
    longer = F.concat("segment", F.lit(" ("),
                      rules.words(F.col("services_level"), C.SERVICE_WORDS), F.lit(" Services)"))
    named = named.withColumn("segment", F.when(twins > 1, longer).otherwise(F.col("segment")))
    return named.select(
        "cluster", "segment", "customers", "share", *[f"{f}_centroid" for f in C.SEGMENT_FEATURES],
        "tenure_level", "spend_level", "services_level")


def require_distinct_names(profiles: DataFrame) -> None:
    if profiles.count() != profiles.select("segment").distinct().count():
        raise AccountTableError("segment names are not unique")


@dataclass(frozen=True)
class SegmentModel:
    """Fitted scaler + k-means, and the stable cluster numbers: clusters are
    numbered by centroid (tenure, charge, services), not by draw order."""
    fitted: FittedModel
    numbering: tuple[int, ...]
    centroids: tuple[tuple[float, ...], ...]

    def assign(self, df: DataFrame) -> DataFrame:
        """Adds ``cluster``."""
        number = F.element_at(F.array(*[F.lit(n) for n in self.numbering]),
                              F.col("raw_cluster") + 1)
        return (
            self.fitted.pipeline.transform(df).withColumn("cluster", number)
            .drop("segment_raw", "segment_features", "raw_cluster")
        )

    @staticmethod
    def of(fitted: FittedModel) -> "SegmentModel":
        scaler, kmeans = fitted.pipeline.stages[-2], fitted.pipeline.stages[-1]
        mean, std = scaler.mean.toArray(), scaler.std.toArray()
        original = [tuple(float(x) for x in c * std + mean) for c in kmeans.clusterCenters()]
        order = sorted(range(len(original)), key=lambda i: original[i])
        numbering = [0] * len(original)
        for new, old in enumerate(order):
            numbering[old] = new
        return SegmentModel(fitted, tuple(numbering), tuple(original[i] for i in order))


def fit_segments(features: DataFrame, k: int = C.SEGMENT_COUNT,
                 restarts: int = RESTARTS) -> SegmentModel:
    with _scaled(features) as (scaler, points):
        best = lloyd.best_of(lloyd.run_fits(points, SCALED, [k], restarts, C.SEED))[k]
    kmeans = _exact_model(best.centroids)
    fitted = FittedModel("KMeans", C.SEGMENT_FEATURES, PipelineModel([*scaler.stages, kmeans]))
    return SegmentModel.of(fitted)


def segment_profiles(assigned: DataFrame, model: SegmentModel, terciles: Terciles) -> DataFrame:
    """The named table of k rows: sizes, centroids in original units, levels."""
    spark: SparkSession = assigned.sparkSession
    schema = "cluster int, " + ", ".join(f"{f}_centroid double" for f in C.SEGMENT_FEATURES)
    rows = [(i, *c) for i, c in enumerate(model.centroids)]
    centroids = spark.createDataFrame(rows, schema)
    counts = assigned.groupBy("cluster").agg(F.count("*").alias("customers"))
    total = counts.agg(F.sum("customers")).scalar()
    sized = centroids.join(counts, "cluster", "left").withColumns({
        "customers": F.coalesce("customers", F.lit(0)),
    }).withColumn("share", F.col("customers").cast("double") / total.cast("double"))
    named = name_profiles(sized, terciles)      # names from the full values
    return named.select(*[F.round(c, 2).alias(c) if c.endswith("_centroid") else c for c in named.columns])


def assign_segments(features: DataFrame, model: SegmentModel, profiles: DataFrame) -> DataFrame:
    """(id, cluster, segment). ``profiles`` has one row per cluster, which
    bounds the broadcast; an unknown cluster keeps a NULL name and fails the
    assignment contract."""
    names = F.broadcast(profiles.select("cluster", "segment"))
    assigned = model.assign(features.select(C.ID, *C.SEGMENT_FEATURES)).select(C.ID, "cluster")
    return assigned.join(names, "cluster", "left").select(
        C.ID, F.col("cluster").alias("Cluster"), F.col("segment").alias(C.SEGMENT))
