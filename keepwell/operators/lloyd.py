"""Many k-means fits at once: every pass over the rows advances all of them.

A fit is a number of clusters and a restart. Each pass assigns every row under
all open fits and sends, per task, one partial sum for each fit and cluster, so a
pass costs one scan and a shuffle of a few hundred rows whatever the data size.
A fit is closed when the squared moves of its centroids add up to ``tol`` or less
(coordinates have unit variance); the last pass takes the final centroids' inertia.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Executors get the functions themselves, so they need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Rows the first centroids are drawn from; a stated bound, not a share.
SEED_ROWS = 4_096
SEED_STEPS = 200
MAX_PASSES = 300
TOLERANCE = 1e-4
_CHUNK = 8_192


@dataclass
class Fit:
    k: int
    restart: int
    centroids: np.ndarray
    inertia: float = float("inf")
    passes: int = 0


def matrix(batch: pa.RecordBatch, columns: list[str]) -> np.ndarray:
    return np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in columns], axis=1).astype(float)


def squared_distances(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """By differences, so equal points are exactly 0 apart."""
    out = np.zeros((len(x), len(centroids)))
    for j in range(x.shape[1]):
        step = x[:, j, None] - centroids[None, :, j]
        out += step * step
    return out


def nearest(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid (the first on a tie) and the squared distance."""
    far = squared_distances(x, centroids)
    which = far.argmin(axis=1)
    return which, far[np.arange(len(x)), which]


def _sums(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per cluster: rows, coordinate sums, squared distances."""
    which, far = nearest(x, centroids)
    k = len(centroids)
    return (np.bincount(which, minlength=k),
            np.stack([np.bincount(which, x[:, j], k) for j in range(x.shape[1])], axis=1),
            np.bincount(which, far, k))


def first_centroids(sample: np.ndarray, k: int, seed: int) -> np.ndarray:
    """Spread-out draws of the sample (k-means++), then steps on the sample alone,
    which leave few passes over all rows to do."""
    rng = np.random.default_rng([seed, k])
    picked = [sample[rng.integers(len(sample))]]
    far = squared_distances(sample, np.array(picked))[:, 0]
    while len(picked) < k:
        total = far.sum()
        at = rng.choice(len(sample), p=far / total) if total > 0 else rng.integers(len(sample))
        picked.append(sample[at])
        far = np.minimum(far, squared_distances(sample, sample[at][None])[:, 0])
    centroids = np.array(picked)
    for _ in range(SEED_STEPS):
        n, sums, _ = _sums(sample, centroids)
        moved = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centroids)
        if (moved == centroids).all():
            break
        centroids = moved
    return centroids


def seed_sample(points: DataFrame, columns: list[str]) -> np.ndarray:
    """A fixed choice of rows, by digest of their values."""
    values = [F.col(c).cast("double") for c in columns]
    chosen = points.select(*values, F.xxhash64(*values).alias("_draw")).orderBy("_draw", *columns).limit(SEED_ROWS)
    return np.array([tuple(r)[:-1] for r in chosen.collect()], dtype=float).reshape(-1, len(columns))


def _pass(points: DataFrame, columns: list[str], fits: list[Fit]) -> dict[int, list[tuple]]:
    """Per fit (by place in ``fits``) its clusters' (cluster, rows, cost, sums)."""
    shared = [f.centroids for f in fits]

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = None
        for batch in batches:
            whole = matrix(batch, columns)
            for at in range(0, len(whole), _CHUNK):
                parts = [_sums(whole[at:at + _CHUNK], c) for c in shared]
                totals = parts if totals is None else [
                    tuple(a + b for a, b in zip(t, p)) for t, p in zip(totals, parts)]
        if totals is not None:
            fit = np.repeat(np.arange(len(shared)), [len(c) for c in shared])
            cluster = np.concatenate([np.arange(len(c)) for c in shared])
            n, sums, cost = (np.concatenate([t[i] for t in totals]) for i in range(3))
            yield pa.RecordBatch.from_arrays(
                [pa.array(fit), pa.array(cluster), pa.array(n), pa.array(cost), *[pa.array(s) for s in sums.T]],
                names=["fit", "cluster", "n", "cost", *[f"s{j}" for j in range(len(columns))]])

    names = [f"s{j}" for j in range(len(columns))]
    schema = "fit long, cluster long, n long, cost double, " + ", ".join(f"{s} double" for s in names)
    rows = points.select(*columns).mapInArrow(partial, schema).groupBy("fit", "cluster").agg(
        *[F.sum(c).alias(c) for c in ("n", "cost", *names)]).collect()
    out: dict[int, list[tuple]] = {}
    for r in rows:
        out.setdefault(r["fit"], []).append((r["cluster"], r["n"], r["cost"], [r[s] for s in names]))
    return out


def run_fits(points: DataFrame, columns: list[str], ks, restarts: int, seed: int,
             tol: float = TOLERANCE, max_passes: int = MAX_PASSES) -> list[Fit]:
    """All fits of ``ks`` x ``restarts`` over the whole of ``points``, which must be
    cheap to scan. An empty cluster keeps its centroid."""
    sample = seed_sample(points, columns)
    if not len(sample):
        raise ValueError("no rows to cluster")
    fits = [Fit(k, i, first_centroids(sample, k, seed + i)) for k in ks for i in range(restarts)]
    moving = list(fits)
    while moving:
        found = _pass(points, columns, moving)
        still = []
        for at, fit in enumerate(moving):
            new = fit.centroids.copy()
            for cluster, n, _, sums in found.get(at, []):
                if n:
                    new[cluster] = np.array(sums) / n
            moved = ((new - fit.centroids) ** 2).sum()
            fit.centroids, fit.passes = new, fit.passes + 1
            if moved > tol and fit.passes < max_passes:
                still.append(fit)
        moving = still
    for at, clusters in _pass(points, columns, fits).items():
        fits[at].inertia = sum(cost for _, _, cost, _ in sorted(clusters))
    return fits


def best_of(fits: list[Fit]) -> dict[int, Fit]:
    """Per k the fit of least inertia, the earlier restart on a tie."""
    out: dict[int, Fit] = {}
    for fit in fits:
        if fit.k not in out or fit.inertia < out[fit.k].inertia:
            out[fit.k] = fit
    return out


def with_clusters(points: DataFrame, columns: list[str], fits: dict[str, Fit]) -> DataFrame:
    """``columns`` plus one integer cluster number per named fit."""
    shared = {name: fit.centroids for name, fit in fits.items()}

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch, columns)
            found = [pa.array(nearest(x, c)[0].astype(np.int32)) for c in shared.values()]
            yield pa.RecordBatch.from_arrays([*map(pa.array, x.T), *found], names=[*columns, *shared])

    schema = ", ".join([*[f"{c} double" for c in columns], *[f"{n} int" for n in shared]])
    return points.select(*columns).mapInArrow(assign, schema)
