"""Forest contributions go tree by tree, many rows at a time."""

import numpy as np
import pytest

from keepwell.operators import explain as E
from tests.test_forest_walk import complete_forest


@pytest.fixture
def forest():
    """Complete trees over three features, each asked several times, with shares."""
    rng = np.random.default_rng(5)
    made = complete_forest(6, 7, 3, rng)
    above = None
    for k, e in enumerate(made.levels):
        e.share[:] = rng.uniform(0.2, 0.8, len(e.parent)) * (above[e.parent, k % 3] if k else 1.0)
        above = np.ones((len(e.parent), 3)) if above is None else above[e.parent]
        above[:, k % 3] = e.share
        if k >= 3:                          # the same feature stands three levels up
            up = e.parent
            for level in (made.levels[k - 1], made.levels[k - 2]):
                up = level.parent[up]
            e.earlier[:] = np.stack([np.full(len(up), k - 3), up], axis=1)
    return made


def by_definition(x, forest):
    """Sums over the leaves, with the integral by many nodes."""
    out, (nodes, weights) = np.zeros(x.shape), np.polynomial.legendre.leggauss(12)
    for value, features, low, high, share in forest:
        hit = (x[:, features] > low) & (x[:, features] <= high)
        for t, w in zip((nodes + 1) / 2, weights / 2):
            factor = (1 - t) * share + t * hit
            for j, f in enumerate(features):
                others = np.delete(factor, j, axis=1).prod(axis=1)
                out[:, f] += w * value * (hit[:, j] - share[j]) * others
    return out


def test_contributions_follow_the_definition(forest):
    x = np.random.default_rng(6).uniform(size=(50, 3))
    assert np.allclose(E.shapley_values(x, forest), by_definition(x, forest), atol=1e-12)


def test_single_trees_have_all_leaves(forest):
    whole = sorted(leaf[0] for leaf in forest)
    assert sorted(leaf[0] for tree in E._single_trees(forest) for leaf in tree) == whole


def test_tiles_change_nothing(forest, monkeypatch):
    x = np.random.default_rng(7).uniform(size=(33, 3))
    whole = E.shapley_values(x, forest)
    monkeypatch.setattr(E, "_TILE_CELLS", 1)
    assert np.allclose(E.shapley_values(x, forest), whole, atol=1e-15)


def test_a_wide_forest_takes_many_rows_at_a_time(monkeypatch):
    """With all trees at once 500,000 cells were 19 rows of this forest."""
    rng, sizes = np.random.default_rng(8), []
    wide, add = complete_forest(100, 8, 8, rng), E._add_tree
    monkeypatch.setattr(E, "_add_tree", lambda out, x, steps: (sizes.append(x.shape[1]), add(out, x, steps)))
    E.shapley_values(rng.uniform(size=(400, 8)), wide)
    assert max(sizes) >= 100 and sum(sizes) == 400 * 100


def test_forests_without_edges(forest):
    assert (E.shapley_values(np.ones((4, 2)), E.Forest([], 3)) == 0).all()
    assert E.shapley_values(np.ones((0, 3)), forest).shape == (0, 3)
