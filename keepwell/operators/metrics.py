"""Model quality as aggregates: confusion cells, rates, exact AUC, errors,
class weights and the silhouette."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keepwell.operators.ordering import running_totals


def _ratio(top: Column, bottom: Column) -> Column:
    return F.coalesce(F.try_divide(top.cast("double"), bottom.cast("double")), F.lit(0.0))


def classification_metrics(scored: DataFrame, label: str = "label",
                           predicted: str = "prediction", by: str = "model") -> DataFrame:
    """Accuracy, precision, recall, F1 per model; a zero denominator gives 0."""
    y, p = F.col(label) == 1, F.col(predicted) == 1
    counts = scored.groupBy(by).agg(
        F.count_if(y & p).alias("tp"), F.count_if(~y & p).alias("fp"),
        F.count_if(y & ~p).alias("fn"), F.count_if(~y & ~p).alias("tn"))
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return counts.select(
        by,
        _ratio(tp + tn, tp + tn + fp + fn).alias("accuracy"),
        _ratio(tp, tp + fp).alias("precision"),
        _ratio(tp, tp + fn).alias("recall"),
        _ratio(2 * tp, 2 * tp + fp + fn).alias("f1"))


def confusion_matrix(scored: DataFrame, label: str = "label",
                     predicted: str = "prediction", by: str = "model") -> DataFrame:
    """Four tidy rows per model, empty cells included."""
    cells = [(a, p) for a in (0, 1) for p in (0, 1)]
    wide = scored.groupBy(by).agg(*[
        F.count_if((F.col(label) == a) & (F.col(predicted) == p)).alias(f"c{a}{p}")
        for a, p in cells
    ])
    return wide.select(by, F.inline(F.array(*[
        F.struct(F.lit(a).alias("actual"), F.lit(p).alias("predicted"),
                 F.col(f"c{a}{p}").alias("count"))
        for a, p in cells
    ])))


def roc_auc(scored: DataFrame, score: str, label: str = "label") -> DataFrame:
    """Exact area under the ROC curve, ties counted half; one row.

    Rows are first counted per distinct score, so a score shared by a third of
    the base is one row when the order is built. The numerator is an integer
    and kept exact as DECIMAL.
    """
    per_score = scored.groupBy(F.col(score).alias("score")).agg(
        F.count_if(F.col(label) == 1).alias("pos"),
        F.count_if(F.col(label) == 0).alias("neg"))
    ranked = running_totals(per_score, [F.asc("score")], {"neg_before": F.col("neg")})
    won = (F.col("pos").cast("decimal(18,0)")
           * (2 * F.col("neg_before") + F.col("neg")).cast("decimal(19,0)"))
    totals = ranked.agg(F.sum(won).alias("won"), F.sum("pos").alias("pos"),
                        F.sum("neg").alias("neg"))
    return totals.select(F.try_divide(
        F.col("won").cast("double"),
        F.lit(2.0) * F.col("pos").cast("double") * F.col("neg").cast("double")).alias("roc_auc"))


def class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """n / (classes * n_class) per class; aggregated before anything is joined."""
    counts = df.groupBy(label).agg(F.count("*").alias("members"))
    total = counts.agg(F.struct(F.sum("members").alias("n"), F.count("*").alias("k")))
    t = total.scalar()
    return counts.withColumn(
        "weight", t["n"].cast("double") / (t["k"] * F.col("members")).cast("double"))


def regression_metrics(scored: DataFrame, target: str, estimate: str) -> DataFrame:
    """RMSE, MAE and R2 in one pass: the variance aggregate merges central
    moments, which is as stable as taking the mean first."""
    y, e = F.col(target), F.col(target) - F.col(estimate)
    sums = scored.agg(F.avg(e * e).alias("mse"), F.avg(F.abs(e)).alias("mae"),
                      F.var_pop(y).alias("spread"))
    return sums.select(F.sqrt("mse").alias("rmse"), "mae",
                       (1 - F.try_divide("mse", "spread")).alias("r2"))


def silhouette(points: DataFrame, features: list[str], cluster: str = "cluster") -> DataFrame:
    """Mean silhouette over all rows with squared Euclidean distances; one row.

    The mean squared distance from x to the members of a cluster is
    |x|^2 - 2 x.mean + mean |y|^2, so a cluster's size, sums and sum of squares
    are all a row needs: one aggregation to a row per cluster, then one
    projection. The clusters must be few (their statistics are collected); a
    cluster of one row counts 0. ``points`` is scanned twice.
    """
    xs = {f"x{i}": F.col(f).cast("double") for i, f in enumerate(features)}
    packed = points.select(F.col(cluster).cast("int").alias("c"), *[v.alias(n) for n, v in xs.items()])
    # Around the mean, so that large coordinates do not cancel.
    middle = packed.agg(*[F.avg(n).alias(n) for n in xs]).first()
    packed = packed.select("c", *[(F.col(n) - F.lit(middle[n] or 0.0)).alias(n) for n in xs])
    norm = reduce(add, [F.col(n) * F.col(n) for n in xs])
    groups = packed.groupBy("c").agg(
        F.count("*").alias("n"), F.avg(norm).alias("square"), *[F.avg(n).alias(n) for n in xs]).collect()
    own = other = F.lit(None).cast("double")
    size = F.lit(0)
    for g in groups:
        cross = reduce(add, [F.col(n) * g[n] for n in xs])
        far = F.greatest(norm - 2 * cross + g["square"], F.lit(0.0))
        mine = F.col("c") == g["c"]
        size = F.when(mine, g["n"]).otherwise(size)
        own = F.when(mine, far * (g["n"] / max(1, g["n"] - 1))).otherwise(own)
        other = F.least(other, F.when(~mine, far))
    measured = packed.select(size.alias("n"), own.alias("a"), other.alias("b"))
    value = F.when(F.col("n") > 1,
                   F.try_divide(F.col("b") - F.col("a"), F.greatest("a", "b")))
    return measured.agg(F.avg(F.coalesce(value, F.lit(0.0))).alias("silhouette"))
