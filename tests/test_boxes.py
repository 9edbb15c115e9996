"""Distance sums over cubes against all pairs."""

import numpy as np
import pytest

from keepwell.operators import boxes
from keepwell.operators.distances import Stripe, distance_sums, euclidean_silhouettes
from tests.test_clusters import XY, plain_silhouette, table


def clumps(n, d, seed):
    """Clumps of very different sizes, a dense spot, layers and a point far away."""
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d)) * rng.choice([0.01, 0.3, 2.0], size=(n, 1)) + rng.integers(-2, 3, (n, d))
    x[: n // 10] = 0.5 + 1e-7 * rng.normal(size=(n // 10, d))
    x[n // 10: n // 4, -1] = np.round(x[n // 10: n // 4, -1])
    x[-1] = 50.0
    return x


@pytest.mark.parametrize("d, n", [(1, 3_000), (2, 12_000), (3, 20_000)])
def test_few_pairs_meet_and_the_sums_are_those_of_all(d, n, monkeypatch):
    monkeypatch.setattr(boxes, "_NEAR_PAIRS", 4_096)
    monkeypatch.setattr(boxes, "_FAR_PAIRS", 1_024)
    monkeypatch.setattr(boxes, "_KEPT_POINTS", 64)
    x, rng = clumps(n, d, 3 + d), np.random.default_rng(9)
    weight = rng.integers(1, 5, n).astype(float)
    columns = np.stack([rng.integers(3, size=n), 3 + (x[:, 0] > 0)], axis=1)
    stripe = Stripe.of(x, weight, columns)
    low = x.min(axis=0)
    side, by = float((x.max(axis=0) - low).max()), boxes.tables(d)
    first = boxes.Sources(stripe.coordinates.T, stripe.weight, stripe.group, stripe.columns, 5, low, side, by)
    sources = boxes.Sources(stripe.coordinates.T, stripe.weight, stripe.group, stripe.columns, 5, low, side, by,
                            first.prepared())
    met = []

    def one_by_one(rows, points, width):
        met.append(len(rows) * len(points[1]))
        return distance_sums(rows, Stripe(*points), width)

    asked = x[:3_000]
    got = boxes.cube_sums(asked, sources, one_by_one)
    assert np.allclose(got, distance_sums(asked, stripe, 5), rtol=2e-8)
    assert sum(met) < len(asked) * n / (4 if d < 3 else 2)


@pytest.mark.parametrize("stripe", [500_000, 700])
def test_silhouette_by_cubes_equals_brute_force(spark, monkeypatch, stripe):
    monkeypatch.setattr(boxes, "_NEAR_PAIRS", 4_096)
    monkeypatch.setattr(boxes, "_FAR_PAIRS", 1_024)
    x = np.concatenate([clumps(2_000, 2, 5), np.repeat([[3.0, 3.0]], 60, axis=0)])
    one = np.random.default_rng(2).integers(3, size=len(x))
    one[-1] = 9                                   # a cluster of one row
    two = (x[:, 0] > 0).astype(int)
    got = {r.clustering: r.silhouette for r in euclidean_silhouettes(
        table(spark, x, one=one, two=two), XY, ["one", "two"], stripe_points=stripe, cubes_from=1).collect()}
    assert np.isclose(got["one"], plain_silhouette(x, one), atol=1e-9)
    assert np.isclose(got["two"], plain_silhouette(x, two), atol=1e-9)


def test_blank_coordinates_do_not_meet_in_cubes(spark):
    rows = [(float(i), float(i % 7), i % 2) for i in range(200)] + [(None, 1.0, 0)]
    df = spark.createDataFrame(rows, "x double, y double, c int")
    assert np.isnan(euclidean_silhouettes(df, XY, ["c"], cubes_from=1).first().silhouette)
