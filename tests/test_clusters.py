"""Batched k-means and the Euclidean silhouette against brute force."""

import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from keepwell.operators import lloyd
from keepwell.operators.distances import Stripe, distance_sums, euclidean_silhouettes
from keepwell.operators.segments import _exact_model

XY = ["x", "y"]


def blobs(n=300, seed=4):
    rng = np.random.default_rng(seed)
    centre = rng.normal(0, 6, (4, 2))
    return centre[rng.integers(4, size=n)] + rng.normal(0, 1, (n, 2))


def table(spark, x, **more):
    names = [*XY, *more]
    return spark.createDataFrame([tuple(map(float, p)) + tuple(int(v[i]) for v in more.values())
                                  for i, p in enumerate(x)],
                                 ", ".join([f"{c} double" for c in XY] + [f"{c} int" for c in more])).select(names)


def plain_lloyd(x, centroids, tol):
    passes = 0
    while True:
        which = ((x[:, None] - centroids[None]) ** 2).sum(axis=2).argmin(axis=1)
        new = np.array([x[which == k].mean(axis=0) if (which == k).any() else c for k, c in enumerate(centroids)])
        moved, centroids, passes = ((new - centroids) ** 2).sum(), new, passes + 1
        if moved <= tol:
            return centroids, ((x[:, None] - centroids[None]) ** 2).sum(axis=2).min(axis=1).sum(), passes


def test_fits_together_equal_fits_alone(spark):
    x = blobs()
    points = table(spark, x).repartition(5).cache()
    fits = lloyd.run_fits(points, XY, [2, 3, 4], 3, seed=1)
    assert [(f.k, f.restart) for f in fits] == [(k, i) for k in (2, 3, 4) for i in range(3)]
    sample = lloyd.seed_sample(points, XY)
    for f in fits:
        want, inertia, passes = plain_lloyd(x, lloyd.first_centroids(sample, f.k, 1 + f.restart), lloyd.TOLERANCE)
        assert np.allclose(f.centroids, want, atol=1e-9) and np.isclose(f.inertia, inertia, rtol=1e-9)
        assert f.passes == passes
        alone = lloyd.run_fits(points, XY, [f.k], f.restart + 1, seed=1)[-1]
        assert np.isclose(alone.inertia, f.inertia, rtol=1e-9)
    best = lloyd.best_of(fits)
    assert all(best[f.k].inertia <= f.inertia for f in fits)


def test_far_seeds_move_to_the_data(spark, monkeypatch):
    """Seeds from a tiny sample: the passes over all rows do the work."""
    monkeypatch.setattr(lloyd, "SEED_ROWS", 4)
    x = blobs(500)
    fits = lloyd.run_fits(table(spark, x).cache(), XY, [4], 10, seed=3)
    assert max(f.passes for f in fits) > 2
    best = lloyd.best_of(fits)[4]
    far = ((x[:, None] - best.centroids[None]) ** 2).sum(axis=2)
    means = [x[far.argmin(axis=1) == k].mean(axis=0) for k in range(4)]
    assert np.allclose(means, best.centroids, atol=0.02)


def test_equal_rows_and_no_rows(spark):
    same = lloyd.run_fits(table(spark, np.ones((20, 2))).cache(), XY, [3], 1, seed=1)[0]
    assert same.inertia == 0 and np.allclose(same.centroids, 1)
    with pytest.raises(ValueError, match="no rows"):
        lloyd.run_fits(table(spark, np.ones((0, 2))), XY, [2], 1, seed=1)


def test_spark_model_keeps_the_centroids(spark):
    centroids = np.array([[0.1, 2.0, 3.0], [-1.5, 0.25, 9.0], [7.0, 7.0, 7.7], [0.1, 2.0, 3.1]])
    model = _exact_model(centroids)
    assert sorted(map(tuple, model.clusterCenters())) == sorted(map(tuple, centroids))


def plain_silhouette(x, c):
    far = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    out = []
    for i in range(len(x)):
        own = (c == c[i]).sum()
        means = [far[i, c == k].mean() for k in set(c.tolist()) if k != c[i]]
        if own == 1 or not means:
            out.append(0.0)
            continue
        a, b = far[i, c == c[i]].sum() / (own - 1), min(means)
        out.append((b - a) / max(a, b) if max(a, b) else 0.0)
    return np.mean(out)


@pytest.mark.parametrize("stripe", [500_000, 7])
def test_euclidean_silhouette_equals_brute_force(spark, stripe):
    rng = np.random.default_rng(2)
    x = np.concatenate([np.round(blobs(120), 0), np.repeat([[3.0, 3.0]], 60, axis=0), [[40.0, 40.0]]])
    one, two = rng.integers(3, size=len(x)), (x[:, 0] > 0).astype(int)
    one[-1] = 9                                   # a cluster of one row
    three = np.zeros(len(x), int)                 # one cluster only
    df = table(spark, x, one=one, two=two, three=three)
    got = {r.clustering: r.silhouette for r in
           euclidean_silhouettes(df, XY, ["one", "two", "three"], stripe_points=stripe).collect()}
    assert np.isclose(got["one"], plain_silhouette(x, one), rtol=1e-9)
    assert np.isclose(got["two"], plain_silhouette(x, two), rtol=1e-9)
    assert got["three"] == 0.0


def test_euclidean_silhouette_of_nothing(spark):
    df = table(spark, np.ones((5, 2)), c=np.zeros(5)).where(F.lit(False))
    assert euclidean_silhouettes(df, XY, ["c"]).first().silhouette is None


def test_distance_sums_hold_one_tile_at_a_time():
    """Tiles of few and of many groups, rows and points over several tiles."""
    rng = np.random.default_rng(4)
    x, points = rng.normal(size=(150, 3)), rng.normal(size=(40_000, 3))
    weight = rng.integers(1, 5, len(points)).astype(float)
    far = np.sqrt(((x[:, None] - points[None]) ** 2).sum(axis=2)) * weight
    for kinds in (1, 2, 9, 30):
        columns = np.stack([rng.integers(kinds, size=len(points)), kinds + rng.integers(kinds, size=len(points))], axis=1)
        want = np.stack([far[:, (columns == c).any(axis=1)].sum(axis=1) for c in range(2 * kinds)], axis=1)
        stripe = Stripe.of(points, weight, columns)
        tracemalloc.start()
        got = distance_sums(x, stripe, 2 * kinds)
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert np.allclose(got, want, rtol=1e-12)
        assert peak < 5_000_000                   # a row of all distances alone has 0.3 MB, all have 48
