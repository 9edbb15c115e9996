"""Walking the forest's nodes holds few rows at a time, however many a batch has."""

import tracemalloc

import numpy as np

from keepwell.operators import explain as E


def complete_forest(trees, depth, features, rng):
    """Edges of complete trees with one feature per level and random cuts."""
    levels, low, high = [], np.full((trees, features), -np.inf), np.full((trees, features), np.inf)
    for k in range(depth):
        cut = rng.uniform(0.3, 0.7, len(low))
        parent = np.repeat(np.arange(len(low)), 2)
        right = np.tile([False, True], len(low))
        low, high = low[parent].copy(), high[parent].copy()
        f = k % features
        low[right, f] = np.maximum(low[right, f], cut[parent[right]])
        high[~right, f] = np.minimum(high[~right, f], cut[parent[~right]])
        value = rng.uniform(0.1, 1, len(parent)) if k == depth - 1 else np.zeros(len(parent))
        levels.append(E.Edges(parent, np.full(len(parent), f), low[:, f], high[:, f], np.ones(len(parent)),
                              np.full((len(parent), 2), -1), value))
    return E.Forest(levels, trees)


def test_many_rows_and_edges_need_little_memory():
    rng = np.random.default_rng(3)
    forest, x = complete_forest(20, 9, 9, rng), rng.uniform(size=(3_000, 9))
    tracemalloc.start()
    got = E.forest_walk(x, forest)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    one_by_one = np.concatenate([E.forest_walk(row[None], forest) for row in x])
    assert np.allclose(got, one_by_one, rtol=1e-12) and (got > 0).all()
    assert peak < 40_000_000                      # 10,240 edges: 245 MB for all rows at once


def test_a_forest_of_bare_roots():
    assert (E.forest_walk(np.ones((5, 2)), E.Forest([], 3)) == 0).all()
