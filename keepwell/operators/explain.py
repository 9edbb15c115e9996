"""Which features move the churn score, for both classifiers.

The logistic model is explained by column arithmetic alone. For the forest the
exact path-dependent Shapley values of Lundberg et al. (2018) are computed in
Arrow batches. A leaf with value v whose path asks the features P gives feature j

    v * (hit_j - share_j) * integral_0^1 prod_{i in P, i != j}
                                         ((1-t) share_i + t hit_i) dt

where hit_i tells whether the row meets the path's conditions on i and share_i is
the fraction of training weight that does. The integrand is a polynomial of degree
|P|-1, so Gauss-Legendre nodes give it exactly. Leaves share their paths, so the
products are carried down a tree once, level by level for many rows together,
the sums of leaf terms are carried up again, and every edge adds its feature's
part; an edge that asks a feature again takes the place of the earlier one. The
edge table handed to the tasks is bounded by trees * 2^depth, whatever the data.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keepwell import contract as C
from keepwell.operators.models import FOREST, LOGISTIC, FittedModel
from keepwell.session import shuffle_partitions

# Executors get the function itself, so they need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_CELLS = 500_000           # rows times edges of a level held at once
_TILE_CELLS = 200_000      # rows times edges of a tree's level times nodes of the integral


def logistic_contributions(model: FittedModel, df: DataFrame) -> DataFrame:
    """(id, feature, contribution) in log-odds: coefficient times the
    standardised distance from the training mean."""
    scaled = model.pipeline.transform(df)
    weights = model.pipeline.stages[-1].coefficients.toArray()
    values = vector_to_array("churn_features")
    terms = F.array(*[
        F.struct(F.lit(name).alias("feature"), (values[i] * float(w)).alias("contribution"))
        for i, (name, w) in enumerate(zip(model.inputs, weights))
    ])
    return scaled.select(C.ID, F.inline(terms))


@dataclass
class Edges:
    """The edges into the nodes of one depth, of all trees, ordered by feature.
    Numbers in ``parent`` count the edges one level up (the tree at the first),
    ``earlier`` is (level, number) of the last edge above that asks the same
    feature, or level -1. Leaves have their value, other nodes 0."""
    parent: np.ndarray
    feature: np.ndarray
    low: np.ndarray
    high: np.ndarray
    share: np.ndarray
    earlier: np.ndarray
    value: np.ndarray


@dataclass
class Forest:
    levels: list[Edges]
    trees: int

    def __iter__(self) -> Iterator[tuple]:
        """Leaves as (value, features, low, high, share)."""
        paths: list[list[dict]] = [[{} for _ in range(self.trees)]]
        for e in self.levels:
            now = []
            for k, parent in enumerate(e.parent.tolist()):
                path = {**paths[-1][parent], int(e.feature[k]): (e.low[k], e.high[k], e.share[k])}
                now.append(path)
                if e.value[k]:
                    features = sorted(path)
                    low, high, share = zip(*[path[f] for f in features])
                    yield e.value[k], np.array(features), np.array(low), np.array(high), np.array(share)
            paths.append(now)


def forest_paths(model: FittedModel, scratch: str) -> Forest:
    """The edges of the forest, leaf values divided by the number of trees.

    The node table is read from the model's own stored form; its size is set
    by the number and depth of the trees.
    """
    forest = model.pipeline.stages[-1]
    forest.write().overwrite().save(scratch)
    table = forest_nodes(scratch).toPandas().sort_values(["tree", "id"], ignore_index=True)
    node = {c: table[c].to_numpy() for c in table.columns}
    # Ids count from 0 in every tree without gaps, so a node's row is known.
    first = np.searchsorted(node["tree"], np.arange(node["tree"].max() + 1))
    at = first.copy()                              # rows of the nodes one level up
    n_features = len(model.inputs)
    last = np.full((len(at), n_features, 2), -1)   # where a feature was asked last
    levels: list[Edges] = []
    while True:
        inner = np.flatnonzero(node["left"][at] >= 0)
        if not len(inner):
            return Forest(levels, len(first))
        up = np.concatenate([inner, inner])
        right = np.repeat([False, True], len(inner))
        row, feature = at[up], node["feature"][at[up]].astype(int)
        child = first[node["tree"][row]] + np.where(right, node["right"][row], node["left"][row]).astype(int)
        order = np.lexsort((up, feature))
        up, right, row, feature, child = (x[order] for x in (up, right, row, feature, child))
        earlier = last[up, feature]
        low, high, share = np.full(len(up), -np.inf), np.full(len(up), np.inf), np.ones(len(up))
        for k, e in enumerate(levels):
            asked = np.flatnonzero(earlier[:, 0] == k)
            which = earlier[asked, 1]
            low[asked], high[asked], share[asked] = e.low[which], e.high[which], e.share[which]
        cut = node["threshold"][row].astype(float)
        low, high = np.where(right, np.maximum(low, cut), low), np.where(right, high, np.minimum(high, cut))
        share = share * node["weight"][child] / node["weight"][row]
        leaf = node["left"][child] < 0
        levels.append(Edges(up, feature, low, high, share, earlier,
                            np.where(leaf, node["churn_share"][child] / len(first), 0.0)))
        last = last[up]
        last[np.arange(len(up)), feature] = np.stack([np.full(len(up), len(levels) - 1), np.arange(len(up))], axis=1)
        at = child


def forest_nodes(path: str) -> DataFrame:
    """One row per node of a stored random forest."""
    n = F.col("nodeData")
    stats = n["impurityStats"]
    weight = F.aggregate(stats, F.lit(0.0), lambda a, b: a + b)
    return SparkSession.active().read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"), n["id"].alias("id"),
        weight.alias("weight"), (stats[1] / weight).alias("churn_share"),
        n["leftChild"].alias("left"), n["rightChild"].alias("right"),
        n["split"]["featureIndex"].alias("feature"),
        F.try_element_at(n["split"]["leftCategoriesOrThreshold"], F.lit(1)).alias("threshold"))


def forest_walk(x: np.ndarray, forest: Forest) -> np.ndarray:
    """Score of every row: the values of the leaves whose paths it meets."""
    out = np.zeros(len(x))
    rows = _rows_at_once(forest)
    for at in range(0, len(x), rows):
        part = x[at:at + rows]
        alive = np.ones((len(part), forest.trees), bool)
        for e in forest.levels:
            asked = part[:, e.feature]
            alive = alive[:, e.parent] & (asked > e.low) & (asked <= e.high)
            out[at:at + rows] += alive @ e.value
    return out


def _rows_at_once(forest: Forest) -> int:
    return max(1, _CELLS // max((len(e.parent) for e in forest.levels), default=1))


def walked_scores(model: FittedModel, df: DataFrame, scratch: str) -> DataFrame:
    """(id, walked) for every row, from the stored nodes instead of the model."""
    forest, inputs, key = forest_paths(model, scratch), list(model.inputs), C.ID

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({key: batch[key], "walked": forest_walk(batch[inputs].to_numpy(dtype=float), forest)})

    return df.select(key, *inputs).mapInPandas(walk, f"{key} string, walked double")


def counted_importance(model: FittedModel, scratch: str) -> DataFrame:
    """(feature, share) from the gains of the stored nodes: per tree the gain of
    every split times the rows that meet it, as shares, averaged over the trees."""
    forest = model.pipeline.stages[-1]
    forest.write().overwrite().save(scratch)
    n = F.col("nodeData")
    splits = SparkSession.active().read.parquet(f"{scratch}/data").where(n["leftChild"] >= 0).select(
        F.col("treeID").alias("tree"), n["split"]["featureIndex"].alias("i"),
        (n["gain"] * n["impurityStats"][0]).alias("gain"))
    trees = splits.groupBy("tree").agg(F.sum("gain").alias("whole"))
    shares = splits.join(trees, "tree").groupBy("i").agg(F.sum(F.col("gain") / F.col("whole")).alias("part"))
    names = F.array(*[F.lit(f) for f in model.inputs])
    total = shares.agg(F.sum("part")).scalar()
    return shares.select(F.element_at(names, F.col("i") + 1).alias("feature"), (F.col("part") / total).alias("share"))


def _three_ways(e: Edges, levels: list[Edges], t: float) -> tuple[np.ndarray, np.ndarray]:
    """(factor, part) at one node of the integral, each for a row that misses the
    earlier edge of the feature, that meets it but not this one, that meets both.
    The factor turns the parent's product into this one's, the part is what a
    unit of leaf sums below gives the feature."""
    met_earlier, share_earlier = np.ones((2, len(e.share)))
    has = e.earlier[:, 0] >= 0
    for k, other in enumerate(levels):
        asked = e.earlier[:, 0] == k
        share_earlier[asked] = other.share[e.earlier[asked, 1]]
    missed = (1 - t) * e.share
    miss_earlier = np.where(has, (1 - t) * share_earlier, 1.0)
    met_earlier = np.where(has, (1 - t) * share_earlier + t, 1.0)
    neg, pos = -e.share / missed, (1 - e.share) / (missed + t)
    neg_earlier = np.where(has, -share_earlier / miss_earlier, 0.0)
    pos_earlier = np.where(has, (1 - share_earlier) / met_earlier, 0.0)
    return (np.stack([missed / miss_earlier, missed / met_earlier, (missed + t) / met_earlier]),
            np.stack([neg - neg_earlier, neg - pos_earlier, pos - pos_earlier]))


def _single_trees(forest: Forest) -> Iterator[Forest]:
    """The same edges tree by tree, numbered anew."""
    trees, tree_of = [], np.arange(forest.trees)
    for e in forest.levels:
        tree_of = tree_of[e.parent]
        trees.append(tree_of)
    for t in range(forest.trees):
        levels, number = [], []                # number: of an edge of the forest in its tree
        for e, tree in zip(forest.levels, trees):
            own = np.flatnonzero(tree == t)
            if not len(own):
                break
            parent = number[-1][e.parent[own]] if number else np.zeros(len(own), int)
            number.append(np.zeros(len(tree), int))
            number[-1][own] = np.arange(len(own))
            earlier = e.earlier[own]
            for k in range(len(levels)):
                asked = earlier[:, 0] == k
                earlier[asked, 1] = number[k][earlier[asked, 1]]
            levels.append(Edges(parent, *(getattr(e, f)[own] for f in ("feature", "low", "high", "share")),
                                earlier, e.value[own]))
        yield Forest(levels, 1)


def shapley_values(x: np.ndarray, forest: Forest) -> np.ndarray:
    """Contributions of every feature for every row of ``x``, tree by tree and
    as many rows at a time as leave the arrays of a level in the processor's cache."""
    out = np.zeros(x.shape[::-1])
    columns = np.ascontiguousarray(x.T)
    for tree in _single_trees(forest):
        if not tree.levels:
            continue
        nodes, weights = np.polynomial.legendre.leggauss((len(tree.levels) + 1) // 2)
        steps = [_Step.of(e, tree.levels, (nodes + 1) / 2, weights / 2) for e in tree.levels]
        rows = max(1, _TILE_CELLS // (len(nodes) * max(len(e.parent) for e in tree.levels)))
        for at in range(0, len(x), rows):
            _add_tree(out[:, at:at + rows], columns[:, at:at + rows], steps)
    return np.ascontiguousarray(out.T)


@dataclass(frozen=True)
class _Step:
    """A level of one tree: per edge and way, in this order, the ``factor`` and
    ``part`` at all nodes of the integral, the latter times the nodes' weights."""
    edges: Edges
    factor: np.ndarray
    part: np.ndarray
    earlier: list[tuple]           # (level, edges here, the edges there)
    feature_start: np.ndarray
    pairs: np.ndarray              # both children of a parent next to each other

    @staticmethod
    def of(e: Edges, levels: list[Edges], at: np.ndarray, weights: np.ndarray) -> "_Step":
        ways = [_three_ways(e, levels, t) for t in at]
        factor, part = (np.stack([w[i] for w in ways], axis=-1).swapaxes(0, 1).reshape(-1, len(at)) for i in (0, 1))
        earlier = []
        for k in np.unique(e.earlier[e.earlier[:, 0] >= 0, 0]):
            asked = np.flatnonzero(e.earlier[:, 0] == k)
            earlier.append((k, asked, e.earlier[asked, 1]))
        return _Step(e, factor, part * weights, earlier, np.flatnonzero(np.diff(e.feature, prepend=-1)),
                     np.argsort(e.parent, kind="stable"))


def _add_tree(out: np.ndarray, x: np.ndarray, steps: list[_Step]) -> None:
    """Adds a tree's contributions; ``out`` and ``x`` have a row per feature."""
    product = np.ones((1, x.shape[1], steps[0].factor.shape[1]))
    hits, ways, products = [], [], []
    for step in steps:
        e, asked = step.edges, x[step.edges.feature]
        met = (asked > e.low[:, None]) & (asked <= e.high[:, None])
        # Who meets an edge has met the earlier one of its feature.
        way = (3 * np.arange(len(met)) + 1)[:, None] + met
        for k, here, there in step.earlier:
            way[here] -= ~hits[k][there]
        product = product.take(e.parent, axis=0)
        product *= step.factor.take(way, axis=0, mode="clip")
        hits.append(met)
        ways.append(way)
        products.append(product)
    below = None
    for k in range(len(steps) - 1, -1, -1):
        step, sums = steps[k], products[k]
        sums *= step.edges.value[:, None, None]
        if below is not None:
            inner, leaf_sums = below
            sums[inner] += leaf_sums
        gain = step.part.take(ways[k], axis=0, mode="clip")
        gain *= sums
        gain = gain @ np.ones(gain.shape[2])
        out[step.edges.feature[step.feature_start]] += np.add.reduceat(gain, step.feature_start, axis=0)
        # Both children of a parent are edges of this level.
        below = step.edges.parent[step.pairs[::2]], sums[step.pairs[::2]] + sums[step.pairs[1::2]]


def forest_contributions(model: FittedModel, df: DataFrame, scratch: str) -> DataFrame:
    """(id, feature, contribution) in probability units for every row."""
    forest, inputs, key = forest_paths(model, scratch), list(model.inputs), C.ID

    def explain(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            values = shapley_values(batch[inputs].to_numpy(dtype=float), forest)
            yield pd.DataFrame({
                key: np.repeat(batch[key].to_numpy(), len(inputs)),
                "feature": np.tile(inputs, len(batch)),
                "contribution": values.ravel(),
            })

    rows = df.select(key, *inputs).repartition(shuffle_partitions(df.sparkSession), key)
    return rows.mapInPandas(explain, f"{key} string, feature string, contribution double")


def forest_summary(model: FittedModel, df: DataFrame, scratch: str) -> DataFrame:
    """(feature, n, total, total_abs) over all rows, summed inside each batch:
    a batch sends one row per feature, not one per account and feature."""
    forest, inputs = forest_paths(model, scratch), list(model.inputs)

    def explain(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            values = shapley_values(batch[inputs].to_numpy(dtype=float), forest)
            yield pd.DataFrame({"feature": inputs, "n": len(batch), "total": values.sum(axis=0),
                                "total_abs": np.abs(values).sum(axis=0)})

    rows = df.select(C.ID, *inputs).repartition(shuffle_partitions(df.sparkSession), C.ID).select(*inputs)
    return rows.mapInPandas(explain, "feature string, n long, total double, total_abs double").groupBy(
        "feature").agg(*[F.sum(c).alias(c) for c in ("n", "total", "total_abs")])


def logistic_summary(model: FittedModel, df: DataFrame) -> DataFrame:
    """(feature, n, total, total_abs) by one wide aggregation without a shuffle
    of accounts."""
    scaler, last = model.pipeline.stages[-2:]
    terms = df.select(*[
        ((F.col(name).cast("double") - float(mean)) * (float(w) / float(std) if std else 0.0)).alias(f"c{i}")
        for i, (name, w, mean, std) in enumerate(zip(model.inputs, last.coefficients, scaler.mean, scaler.std))])
    sums = terms.agg(F.count("*").alias("n"), *[
        F.struct(F.sum(c).alias("t"), F.sum(F.abs(c)).alias("a")).alias(c) for c in terms.columns])
    return sums.select(F.inline(F.array(*[
        F.struct(F.lit(name).alias("feature"), F.col("n").alias("n"), F.col(f"c{i}.t").alias("total"),
                 F.col(f"c{i}.a").alias("total_abs")) for i, name in enumerate(model.inputs)])))


def contribution_summary(models: dict[str, FittedModel], rows: DataFrame, scratch: str) -> DataFrame:
    """Mean and mean absolute contribution per model and feature over all
    ``rows``, all models tagged."""
    parts = []
    if LOGISTIC in models:
        parts.append(logistic_summary(models[LOGISTIC], rows).withColumn("model", F.lit(LOGISTIC)))
    if FOREST in models:
        parts.append(forest_summary(models[FOREST], rows, scratch).withColumn("model", F.lit(FOREST)))
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part)
    return stacked.select("model", "feature", (F.col("total_abs") / F.col("n")).alias("mean_abs_contribution"),
                          (F.col("total") / F.col("n")).alias("mean_contribution"))
