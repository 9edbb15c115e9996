"""Scalable statistics against brute force, on skewed and tied data too."""

import hashlib
import math

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from keepwell.operators import metrics as M
from keepwell.operators.ordering import rank_global, running_totals
from keepwell.operators.quantiles import exact_quantiles
from keepwell.operators.sampling import deal_test_rows, exact_split, fixed_sample
from keepwell.operators.standardise import standardise

FEW = dict(max_examples=8, deadline=None,
           suppress_health_check=[HealthCheck.function_scoped_fixture])


def frame(spark, values, name="x"):
    return spark.createDataFrame([(None if v is None else float(v),) for v in values], f"{name} double")


CASES = {
    "ties": [5.0] * 40 + list(range(60)),
    "outlier": [1e-9, 1e-8, 3.0, 1e15, -1e12, 0.0],
    "negative": [-3.0, -2.5, -2.5, 0.0],
    "single": [7.0],
    "constant": [2.0] * 9,
    "blanks": [None, 1.0, float("nan"), 4.0],
}


@pytest.mark.parametrize("case", CASES)
def test_quantiles_for_any_bins(spark, case):
    df = frame(spark, CASES[case])
    probs = [0.0, 1 / 3, 0.5, 2 / 3, 1.0]
    wide = exact_quantiles(df, ["x"], probs)["x"]
    narrowed = exact_quantiles(df, ["x"], probs, bins=4)["x"]
    clean = [v for v in CASES[case] if v is not None and not math.isnan(v)]
    assert narrowed == wide
    assert np.allclose(wide, np.quantile(clean, probs), rtol=1e-12)


def test_quantiles_with_infinities_and_a_span_beyond_doubles(spark):
    inf = math.inf
    values = [-inf, *map(float, range(50)), inf, inf]
    got = exact_quantiles(frame(spark, values), ["x"], [0.0, 0.5, 1.0], bins=4)["x"]
    assert got == [-inf, 25.0, inf]
    huge = [-1.7e308, -1.0, 0.0, 1.0, 1.7e308]
    assert exact_quantiles(frame(spark, huge), ["x"], [0.0, 0.25, 0.5, 1.0], bins=4)["x"] == [
        -1.7e308, -1.0, 0.0, 1.7e308]
    assert exact_quantiles(frame(spark, [5e-324, 0.0]), ["x"], [1.0], bins=4)["x"] == [5e-324]


@settings(**FEW)
@given(values=st.lists(st.floats(-1e6, 1e6, allow_nan=False), min_size=1, max_size=60),
       p=st.floats(0, 1))
def test_quantile_property(spark, values, p):
    got = exact_quantiles(frame(spark, values), ["x"], [p], bins=8)["x"][0]
    assert np.isclose(got, np.quantile(values, p), rtol=1e-9, atol=1e-9)


def test_quantile_of_nothing(spark):
    assert exact_quantiles(frame(spark, [None]), ["x"], [0.5]) == {"x": [None]}


def test_split_keeps_a_null_class(spark):
    df = spark.range(100).select("id", F.when(F.col("id") % 4 > 0, F.col("id") % 2).alias("c"))
    drawn = exact_split(df, 0.2, strata="c", id_column="id").where("is_test")
    assert drawn.count() == 20
    assert {r.c: r["count"] for r in drawn.groupBy("c").count().collect()} == {None: 5, 0: 5, 1: 10}


def test_sample_refuses_rows_that_share_an_id(spark):
    df = spark.range(100).select((F.col("id") % 10).alias("id"))
    with pytest.raises(ValueError, match="share an id"):
        fixed_sample(df, 15, "id")
    assert fixed_sample(df, 20, "id").count() == 20


def test_split_refuses_an_id_like_class(spark):
    df = spark.range(1_001).select("id", F.col("id").alias("c"))
    with pytest.raises(ValueError, match="classes"):
        exact_split(df, strata="c", id_column="id")


def skewed(spark, n=900):
    """A third of all rows share one sort value and one class."""
    return spark.range(n).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, 0.5).otherwise(F.rand(1)).alias("s"),
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 2).cast("int").alias("label"))


def test_rank_is_the_sorted_position(spark):
    df = skewed(spark).cache()
    ranked = rank_global(df, [F.desc("s"), F.asc("id")]).orderBy("rank").collect()
    want = sorted(df.collect(), key=lambda r: (-r.s, r.id))
    assert [r["rank"] for r in ranked] == list(range(1, 901))
    assert [r.id for r in ranked] == [r.id for r in want]


def test_rank_spreads_hot_values(spark):
    """The hot value must not end up in one range."""
    from keepwell.operators.ordering import ordered_layout
    layout = ordered_layout(skewed(spark, 9000), [F.desc("s"), F.asc("id")])
    assert layout.groupBy("_range").count().agg(F.max("count")).first()[0] < 3000


def test_running_totals(spark):
    df = spark.createDataFrame([(i, i % 4) for i in range(50)], "k int, v int")
    rows = running_totals(df, [F.asc("k")], {"before": F.col("v")}).orderBy("k").collect()
    assert [r.before for r in rows] == [sum(j % 4 for j in range(i)) for i in range(50)]


def draw(i, seed=42):
    return hashlib.md5(f"{seed}|{i}".encode()).hexdigest()


def test_sample_is_the_smallest_hashes(spark):
    got = {r.id for r in fixed_sample(spark.range(500), 37, "id").collect()}
    assert got == set(sorted(range(500), key=draw)[:37])
    assert fixed_sample(spark.range(5), 37, "id").count() == 5
    assert fixed_sample(spark.range(0), 37, "id").count() == 0


def test_split_is_exact_and_stratified(spark):
    df = skewed(spark).select("id", "label").cache()
    rows = exact_split(df, strata="label", id_column="id").collect()
    sizes = {c: sum(r.label == c for r in rows) for c in (0, 1)}
    want = deal_test_rows(sizes, 0.2)
    for c in (0, 1):
        members = sorted((r.id for r in rows if r.label == c), key=draw)
        assert {r.id for r in rows if r.label == c and r.is_test} == set(members[: want[c]])


def test_split_ignores_order_and_partitions(spark):
    ids = spark.range(300)
    a = {r.id for r in exact_split(ids, id_column="id").where("is_test").collect()}
    b = {r.id for r in exact_split(ids.orderBy(F.rand()).repartition(7), id_column="id")
         .where("is_test").collect()}
    assert a == b and len(a) == 60


@pytest.mark.parametrize("sizes,want", [
    ({0: 4720, 1: 1869}, {0: 944, 1: 374}),      # 1,318 of 6,589
    ({0: 1, 1: 1}, {0: 1, 1: 0}),
    ({0: 10, 1: 0}, {0: 2, 1: 0}),
])
def test_allotment(sizes, want):
    assert deal_test_rows(sizes, 0.2) == want


def brute_auc(scores, labels):
    pos = [s for s, y in zip(scores, labels) if y == 1]
    neg = [s for s, y in zip(scores, labels) if y == 0]
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


def test_auc_with_a_hot_tie(spark):
    df = skewed(spark, 300).withColumn("s", F.round("s", 1)).cache()
    rows = df.collect()
    got = M.roc_auc(df, "s").first()[0]
    assert np.isclose(got, brute_auc([r.s for r in rows], [r.label for r in rows]), rtol=1e-12)


def test_auc_matches_spark_evaluator(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    df = skewed(spark).withColumn("label", F.col("label").cast("double")).cache()
    want = BinaryClassificationEvaluator(rawPredictionCol="s", numBins=0).evaluate(df)
    assert np.isclose(M.roc_auc(df, "s").first()[0], want, rtol=1e-12)


def test_auc_without_both_classes_is_null(spark):
    df = spark.createDataFrame([(0.1, 1)], "s double, label int")
    assert M.roc_auc(df, "s").first()[0] is None


def test_confusion_and_rates(spark):
    df = spark.createDataFrame([("m", 1, 1), ("m", 1, 0), ("m", 0, 0)],
                               "model string, label int, prediction int")
    cells = {(r.actual, r.predicted): r["count"] for r in M.confusion_matrix(df).collect()}
    assert cells == {(0, 0): 1, (0, 1): 0, (1, 0): 1, (1, 1): 1}
    row = M.classification_metrics(df).first()
    assert (row.accuracy, row.precision, row.recall) == (2 / 3, 1.0, 0.5)
    nothing = df.withColumn("prediction", F.lit(0))
    assert M.classification_metrics(nothing).first().precision == 0.0


def test_regression_metrics(spark):
    y, e = np.array([1.0, 2.0, 4.0]), np.array([1.5, 2.0, 3.0])
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(y, e)], "y double, e double")
    row = M.regression_metrics(df, "y", "e").first()
    assert np.isclose(row.rmse, np.sqrt(np.mean((y - e) ** 2)))
    assert np.isclose(row.mae, np.mean(np.abs(y - e)))
    assert np.isclose(row.r2, 1 - ((y - e) ** 2).sum() / ((y - y.mean()) ** 2).sum())


def test_class_weights(spark):
    df = spark.createDataFrame([(0,)] * 3 + [(1,)], "label int")
    assert {r.label: r.weight for r in M.class_weights(df).collect()} == {0: 4 / 6, 1: 2.0}


def brute_silhouette(x, c):
    out = []
    for i in range(len(x)):
        d = ((x - x[i]) ** 2).sum(axis=1)
        own = c == c[i]
        if own.sum() < 2:
            out.append(0.0)
            continue
        a = d[own].sum() / (own.sum() - 1)
        b = min(d[c == o].mean() for o in set(c) if o != c[i])
        out.append((b - a) / max(a, b))
    return np.mean(out)


def test_silhouette(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(60, 2)) + np.repeat([[0, 0], [4, 4], [0, 5]], 20, axis=0)
    c = np.repeat([0, 1, 2], 20)
    c[0] = 9                                       # a cluster of one
    df = spark.createDataFrame([(int(k), *map(float, p)) for k, p in zip(c, x)],
                               "cluster int, a double, b double")
    got = M.silhouette(df, ["a", "b"]).first()[0]
    assert np.isclose(got, brute_silhouette(x, c), rtol=1e-9)


def test_standardise(spark):
    df = spark.createDataFrame([(1.0, 3.0), (2.0, 3.0), (6.0, 3.0)], "x double, k double")
    rows = standardise(df, ["x", "k"]).collect()
    x = np.array([1.0, 2.0, 6.0])
    assert np.allclose([r.x_z for r in rows], (x - x.mean()) / x.std())
    assert [r.k_z for r in rows] == [0.0, 0.0, 0.0]


@pytest.mark.parametrize("bins", [100_000, 50])
def test_quantiles_of_many_columns_take_two_scans(spark, monkeypatch, bins):
    from keepwell.operators import quantiles as Q
    rng = np.random.default_rng(8)
    data = {"a": rng.normal(size=30_000), "b": np.round(rng.exponential(3, 30_000), 1),
            "c": np.where(rng.random(30_000) < 0.4, 7.0, rng.normal(size=30_000))}
    df = spark.createDataFrame(list(zip(*[map(float, v) for v in data.values()])), list(data)).cache()
    rounds, count = [], Q._count
    monkeypatch.setattr(Q, "_count", lambda *a: (rounds.append(1), count(*a)))
    probs = [0.001, 1 / 3, 0.5, 0.9999]
    got = exact_quantiles(df, list(data), probs, bins=bins)
    for c, v in data.items():
        assert np.allclose(got[c], np.quantile(v, probs), rtol=1e-12)
    assert len(rounds) == 1


def test_quantiles_survive_a_wrong_sketch(spark, monkeypatch):
    """Brackets beside the rank are moved, not believed."""
    from keepwell.operators import quantiles as Q
    sketched = Q._sketched

    def wrong(*args):
        found = sketched(*args)
        for c in found:
            c.brackets = {k: (c.low + 3.0, c.low + 4.0) for k in c.brackets}
        return found
    monkeypatch.setattr(Q, "_sketched", wrong)
    values = [float(v) for v in range(100)]
    assert exact_quantiles(frame(spark, values), ["x"], [0.02, 0.5])["x"] == [1.98, 49.5]
