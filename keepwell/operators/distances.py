"""The silhouette with plain Euclidean distances, over all rows.

Unlike the squared distance, the sum of plain distances to a cluster does not
follow from a few statistics. Equal points are folded into one with a weight first;
then the distinct points stand as a table in the order of a space-filling curve, and
all stripes of at most STRIPE_POINTS of them go out. Every point gets its summed
distance to each cluster, stripe by stripe, of which a task holds one at a time; no
pair of rows or points is ever a row. Several clusterings of the same points share the
distances. Up to CUBES_FROM points every point meets every other; beyond, points of
cubes that do not touch meet through nodes (``boxes.py``), and the work is in
proportion to the points.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keepwell.operators.boxes import MOST_COORDINATES, Sources, cube_sums, tables
from keepwell.operators.lloyd import matrix
from keepwell.operators.ordering import ordered_layout
from keepwell.session import materialise, shuffle_partitions

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Points of one broadcast; at three coordinates about 20 MB.
STRIPE_POINTS = 500_000
#: Different points from which on cubes meet instead of all points.
CUBES_FROM = 150_000
# Rows that go through all stripes together, and cells per side of the curve.
_ROWS, _CELL_BITS = 32_768, 10
# Distances held at once, 0.5 MB: they are gone over nine times.
_TILE_ROWS, _TILE_POINTS = 64, 1_024


def _distinct(points: DataFrame, features: list[str], clusters: list[str]) -> DataFrame:
    """Different points with all their cluster numbers, and how many rows each is."""
    named = points.select(*[F.col(f).cast("double").alias(f"x{i}") for i, f in enumerate(features)],
                          *[F.col(c).cast("int").alias(f"c{i}") for i, c in enumerate(clusters)])
    return named.groupBy(*named.columns).agg(F.count("*").alias("n"))


def _cluster_sizes(distinct: DataFrame, clusters: int) -> list[dict[int, int]]:
    """Per clustering, its cluster values and how many rows each has."""
    each = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.col(f"c{i}").alias("c")) for i in range(clusters)]))
    out: list[dict[int, int]] = [{} for _ in range(clusters)]
    for r in distinct.select(each.alias("e"), "n").groupBy("e.i", "e.c").agg(F.sum("n").alias("n")).collect():
        out[r["i"]][r["c"]] = r["n"]
    return out


@dataclass(frozen=True)
class Stripe:
    """Points in the order of their groups; a group is the points that agree in all
    clusterings, and ``columns`` names the sums of the groups it counts in."""
    coordinates: np.ndarray        # one row per coordinate
    weight: np.ndarray
    group: np.ndarray
    columns: np.ndarray            # a row per group, a column per clustering

    @staticmethod
    def of(points: np.ndarray, weight: np.ndarray, columns: np.ndarray) -> "Stripe":
        named, group = np.unique(columns, axis=0, return_inverse=True)
        order = np.argsort(group.ravel(), kind="stable")
        return Stripe(np.ascontiguousarray(points[order].T), weight[order], group.ravel()[order], named)


def distance_sums(x: np.ndarray, stripe: Stripe, width: int) -> np.ndarray:
    """Per row of ``x`` and column the weighted sum of distances to the stripe's
    points. Tiles of the distances stay in the processor's cache, and a tile is
    summed up by the few groups it meets."""
    got = np.zeros((len(x), width))
    whole, part = np.empty((2, _TILE_ROWS, _TILE_POINTS))
    for first in range(0, len(stripe.weight), _TILE_POINTS):
        tile = slice(first, first + _TILE_POINTS)
        others, group = stripe.coordinates[:, tile], stripe.group[tile]
        n = len(group)
        met = stripe.columns[group[0]:group[-1] + 1]
        by_group = np.zeros((n, len(met)))
        by_group[np.arange(n), group - group[0]] = stripe.weight[tile]
        counts_in = np.zeros((len(met), width))
        counts_in[np.arange(len(met))[:, None], met] = 1.0
        if len(met) > width:
            by_group, counts_in = by_group @ counts_in, np.eye(width)
        for at in range(0, len(x), _TILE_ROWS):
            rows = x[at:at + _TILE_ROWS]
            far, step = whole[:len(rows), :n], part[:len(rows), :n]
            np.subtract(rows[:, 0, None], others[0], out=far)
            np.multiply(far, far, out=far)
            for j in range(1, len(others)):
                np.subtract(rows[:, j, None], others[j], out=step)
                np.multiply(step, step, out=step)
                np.add(far, step, out=far)
            np.sqrt(far, out=far)
            got[at:at + len(rows)] += far @ by_group @ counts_in
    return got


def _opened(shared):
    """The value of a broadcast, which this process does not keep."""
    value = shared.value
    if getattr(shared, "_path", None):
        vars(shared).pop("_value", None)
    return value


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, rows = [], 0
    for batch in batches:
        held.append(batch)
        rows += len(batch)
        if rows >= _ROWS:
            yield pa.concat_batches(held)
            held, rows = [], 0
    if held:
        yield pa.concat_batches(held)


def _one_by_one(rows: np.ndarray, points: tuple, width: int) -> np.ndarray:
    return distance_sums(rows, Stripe(*points), width)


@dataclass(frozen=True)
class Space:
    """The cube that holds all points: its least corner and its side (none if a point
    has a coordinate that is no finite number)."""
    low: tuple
    side: float

    @staticmethod
    def of(distinct: DataFrame, xs: list[str]) -> "Space":
        blank = F.count_if(F.greatest(*[F.col(x).isNull() for x in [xs[0], *xs]]))
        *ends, blanks = distinct.agg(*[f(x) for x in xs for f in (F.min, F.max)], blank).first()
        low, high = tuple(ends[::2]), ends[1::2]
        if blanks or any(v is None or not math.isfinite(v) for v in ends):
            return Space(low, math.nan)
        return Space(low, max(b - a for a, b in zip(low, high)))

    def cell(self, xs: list[str]):
        """Number of a point's cell on a space-filling curve."""
        if not self.side > 0:
            return F.lit(0).cast("long")
        bits = max(1, min(_CELL_BITS, 62 // len(xs)))
        out = F.lit(0).cast("long")
        for i, (x, low) in enumerate(zip(xs, self.low)):
            cell = F.least(F.floor((F.col(x) - low) * (2 ** bits / self.side)), F.lit(2 ** bits - 1)).cast("long")
            for bit in range(bits):
                out = out.bitwiseOR(F.shiftleft(F.shiftright(cell, bit).bitwiseAND(F.lit(1)), bit * len(xs) + i))
        return out


def _with_sums(points: DataFrame, xs: list[str], stripes: list, by, space: Space, width: int) -> DataFrame:
    """``points`` plus ``sums``, their distances to all stripes. With the tables ``by``
    the points meet in cubes, else one by one."""
    low, side = np.array(space.low, dtype=float), space.side
    names = [*points.columns, "sums"]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _gathered(batches):
            x = matrix(batch, xs)
            got = np.zeros((len(x), width))
            for shared in stripes:
                stripe, kept = shared.value if len(stripes) == 1 else _opened(shared)
                if by is None:
                    got += distance_sums(x, Stripe(*stripe), width)
                else:
                    coordinates, weight, group, columns = stripe
                    sources = Sources(coordinates.T, weight, group, columns, width, low, side, by.value, kept)
                    got += cube_sums(x, sources, _one_by_one)
            total = pa.FixedSizeListArray.from_arrays(pa.array(got.ravel()), width)
            yield pa.RecordBatch.from_arrays([*batch.columns, total.cast(pa.list_(pa.float64()))], names=names)

    schema = ", ".join([f"{c} {t}" for c, t in points.dtypes] + ["sums array<double>"])
    return points.mapInArrow(add, schema)


def euclidean_silhouettes(points: DataFrame, features: list[str], clusters: list[str],
                          stripe_points: int = STRIPE_POINTS, cubes_from: int = CUBES_FROM) -> DataFrame:
    """(clustering, silhouette): per column in ``clusters`` the mean over all rows of
    (b - a) / max(a, b), where a is the mean distance to the other rows of the own
    cluster and b the least mean distance to another one. A row alone in its cluster
    counts 0, so does every row of a single cluster; no rows give null. Clusters must
    be few; rows with a null cluster count as one cluster. From ``cubes_from`` different
    points on, of at most three coordinates, the distances of points that are far from
    each other are interpolated."""
    spark = points.sparkSession
    xs = [f"x{i}" for i in range(len(features))]
    cs = [f"c{i}" for i in range(len(clusters))]
    found = materialise(_distinct(points, features, clusters))
    space = Space.of(found, xs)
    distinct = ordered_layout(found.withColumn("_cell", space.cell(xs)), [F.col(c) for c in ["_cell", *xs, *cs]])
    sizes = _cluster_sizes(distinct, len(clusters))
    column = {}                                    # (clustering, cluster) -> column of the sums
    for i, seen in enumerate(sizes):
        for value in sorted(seen, key=lambda v: (v is None, v)):
            column[i, value] = len(column)
    if not column:
        return spark.createDataFrame([(c, None) for c in clusters], "clustering string, silhouette double")

    width, n, sc = len(column), distinct.count(), spark.sparkContext
    by = None
    if n >= cubes_from and len(xs) <= MOST_COORDINATES and math.isfinite(space.side):
        by = sc.broadcast(tables(len(xs)))
    stripes = []
    for stripe in _stripes(distinct, xs, cs, column, stripe_points):
        kept = None if by is None else Sources(
            stripe.coordinates.T, stripe.weight, stripe.group, stripe.columns, width,
            np.array(space.low), space.side, by.value).prepared()
        stripes.append(sc.broadcast((tuple(vars(stripe).values()), kept)))
        vars(stripes[-1]).pop("_value", None)
    tasks = shuffle_partitions(spark)
    if by:
        tasks = min(tasks, max(sc.defaultParallelism, n // _ROWS + 1))
    order = ["_range", "_position"]
    now = distinct.repartitionByRange(tasks, *order).sortWithinPartitions(*order).select(*xs, *cs, "n")
    values = [_value(i, seen, column) for i, seen in enumerate(sizes)]
    rows = materialise(_with_sums(now, xs, stripes, by, space, width).agg(
        *[(F.sum(v * F.col("n")) / F.sum("n")).alias(f"v{i}") for i, v in enumerate(values)]))
    for shared in [*stripes, *([by] if by else [])]:
        shared.destroy()
    return rows.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("clustering"), F.col(f"v{i}").alias("silhouette")) for i, c in enumerate(clusters)])))


def _stripes(distinct: DataFrame, xs: list[str], cs: list[str], column: dict,
             size: int) -> Iterator[Stripe]:
    """The distinct points in pieces of at most ``size``, one on the driver at a
    time: whole ranges of the stored order where they fit, else slices of one."""
    ranges = {r["_range"]: r["n"] for r in distinct.groupBy("_range").agg(F.count("*").alias("n")).collect()}
    pieces, open_ranges, held = [], [], 0
    for k, n in sorted(ranges.items()):
        if n > size:
            pieces += [(F.col("_range") == k) & F.col("_position").between(a, a + size - 1)
                       for a in range(0, n, size)]
            continue
        if held + n > size:
            pieces.append(F.col("_range").isin(open_ranges))
            open_ranges, held = [], 0
        open_ranges.append(k)
        held += n
    if open_ranges:
        pieces.append(F.col("_range").isin(open_ranges))
    for where in pieces:
        table = distinct.where(where).select(*xs, *cs, "n").toArrow()
        n = table.column("n").to_numpy().astype(float)
        columns = np.stack([[column[i, v] for v in table.column(c).to_pylist()] for i, c in enumerate(cs)], axis=1)
        yield Stripe.of(np.stack([table.column(x).to_numpy() for x in xs], axis=1), n, columns)


def _value(i: int, sizes: dict, column: dict):
    """Silhouette of a point under clustering ``i``, from its distance sums."""
    own = other = F.lit(None).cast("double")
    alone = F.lit(False)
    for value, n in sizes.items():
        mine = F.col(f"c{i}").eqNullSafe(F.lit(value))
        total = F.col("sums")[column[i, value]]
        own = F.when(mine, total / max(1, n - 1)).otherwise(own)
        other = F.least(other, F.when(~mine, total / n))
        alone = F.when(mine, F.lit(n == 1)).otherwise(alone)
    score = F.try_divide(other - own, F.greatest(own, other))
    return F.when(alone, 0.0).otherwise(F.coalesce(score, F.lit(0.0)))
