"""Exact, linearly interpolated quantiles in two scans that never gather a column.

Spark's ``percentile`` keeps every distinct value of a group in one aggregation
buffer. Here the first scan takes Spark's mergeable rank sketch of all columns and
reads two values off it for every wanted rank, one surely below and one surely
above. The second scan counts, per column, how many values lie in each stretch
between these brackets, and counts the values inside a bracket one by one; the
counts place every rank exactly. A bracket holds about a thousandth of the rows,
so its values come to the driver only up to ``bins`` of them and are ordered over the
cluster otherwise. Where a sketch should miss a rank all the same, the stretch
that holds it becomes the next bracket.

NaN and blanks are left out; infinities are values like others.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keepwell.operators.ordering import running_totals
from keepwell.session import materialise

#: The sketch errs by one rank in ACCURACY; brackets reach MARGIN to both sides,
#: and SMALL_MARGIN where there are so few rows that one rank is more than that.
ACCURACY = 10_000
MARGIN, SMALL_MARGIN = 0.0005, 0.02
SMALL = 10_000
BINS = 100_000


@dataclass
class _Column:
    """What is known of one column: its rows and, per open rank, a bracket."""
    name: str
    n: int
    low: float | None
    high: float | None
    brackets: dict[int, tuple[float, float]] = field(default_factory=dict)
    values: dict[int, float] = field(default_factory=dict)

    def edges(self) -> list[tuple[float, float]]:
        """Brackets of the open ranks, overlapping ones joined, in order."""
        out: list[tuple[float, float]] = []
        for low, high in sorted(self.brackets.values()):
            if out and low <= out[-1][1]:
                out[-1] = (out[-1][0], max(out[-1][1], high))
            else:
                out.append((low, high))
        return out


def exact_quantiles(df: DataFrame, columns, probabilities, bins: int = BINS) -> dict[str, list[float | None]]:
    """Like ``DataFrame.approxQuantile``, but exact. Blanks are left out; a
    column without any value gives None. Pass a table that is cheap to scan
    twice. ``bins`` counts come to the driver at most; it never changes results."""
    columns, probabilities = list(columns), [float(p) for p in probabilities]
    values = df.select(*[
        F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")).alias(f"v{i}")
        for i, c in enumerate(columns)
    ])
    found = _sketched(values, columns, probabilities)
    while any(c.brackets for c in found):
        _count(values, found, bins)
    return {c.name: [_interpolated(c, p) for p in probabilities] for c in found}


def _ranks(n: int, p: float) -> tuple[int, int]:
    position = p * (n - 1)
    return math.floor(position), math.ceil(position)


def _sketched(values: DataFrame, columns: list[str], probabilities: list[float]) -> list[_Column]:
    """The first scan: counts, ends and brackets of all wanted ranks."""
    around = [min(1.0, max(0.0, p + side * margin))
              for p in probabilities for margin in (MARGIN, SMALL_MARGIN) for side in (-1, 1)]
    row = values.agg(*[F.struct(
        F.count(v).alias("n"), F.min(v).alias("low"), F.max(v).alias("high"),
        F.percentile_approx(v, around, ACCURACY).alias("cuts")).alias(v) for v in values.columns]).first()
    out = []
    for name, v in zip(columns, values.columns):
        r = row[v]
        column = _Column(name, r["n"], r["low"], r["high"])
        for i, p in enumerate(probabilities if r["n"] else []):
            at = 4 * i + (2 if r["n"] < SMALL else 0)
            for k in _ranks(r["n"], p):
                if k in (0, r["n"] - 1) or r["low"] == r["high"]:
                    column.values[k] = r["high"] if k else r["low"]
                else:
                    column.brackets[k] = (r["cuts"][at], r["cuts"][at + 1])
        out.append(column)
    return out


def _stretch(value: Column, edges: list[tuple[float, float]]) -> Column:
    """2 i + 1 inside the i-th bracket, 2 i below it and above those before."""
    out = F.lit(2 * len(edges))
    for i, (low, high) in reversed(list(enumerate(edges))):
        out = F.when(value < low, 2 * i).when(value <= high, 2 * i + 1).otherwise(out)
    return out


def _count(values: DataFrame, columns: list[_Column], bins: int) -> None:
    """The second scan: settles ranks inside their brackets, moves the others'."""
    parts = []
    for i, c in enumerate(columns):
        edges, v = c.edges(), F.col(f"v{i}")
        if edges:
            at = _stretch(v, edges)
            parts.append(F.when(v.isNotNull(), F.struct(
                F.lit(i).alias("i"), at.alias("at"), F.when(at % 2 == 1, v).alias("x"))))
    # A row gives one entry per open column; equal entries fold before the shuffle.
    entry = parts[0] if len(parts) == 1 else F.explode(F.array_compact(F.array(*parts)))
    counted = values.select(entry.alias("t")).where("t IS NOT NULL").groupBy("t.i", "t.at", "t.x").agg(
        F.count("*").alias("n"))
    rows = counted.limit(bins + 1).collect()
    many = None
    if len(rows) > bins:
        many = materialise(counted)
        rows = many.groupBy("i", "at").agg(F.lit(None).cast("double").alias("x"), F.sum("n").alias("n")).collect()
    for i, c in enumerate(columns):
        if c.brackets:
            _settle(c, i, [r for r in rows if r["i"] == i], many)


def _settle(column: _Column, i: int, rows: list, many: DataFrame | None) -> None:
    edges, before = column.edges(), 0
    for at in range(2 * len(edges) + 1):
        mine = sorted((r["x"], r["n"]) for r in rows if r["at"] == at) if at % 2 and many is None else [
            (None, sum(r["n"] for r in rows if r["at"] == at))]
        n = sum(m for _, m in mine)
        for k in [k for k in column.brackets if before <= k < before + n]:
            if at % 2 == 0:                         # the sketch missed it
                low = edges[at // 2 - 1][1] if at else column.low
                high = edges[at // 2][0] if at // 2 < len(edges) else column.high
                column.brackets[k] = (low, high)
                continue
            if many is None:
                seen = before
                for x, m in mine:
                    seen += m
                    if k < seen:
                        break
                column.values[k] = x
            else:
                column.values[k] = _kth(many.where((F.col("i") == i) & (F.col("at") == at)), k - before)
            del column.brackets[k]
        before += n


def _kth(counted: DataFrame, k: int) -> float:
    """The k-th value (from 0) of (x, n) rows, ordered over the cluster."""
    totals = running_totals(counted.select("x", "n"), [F.asc("x")], {"before": F.col("n")})
    return totals.where((F.col("before") <= k) & (k < F.col("before") + F.col("n"))).first()["x"]


def _interpolated(column: _Column, p: float) -> float | None:
    if not column.n:
        return None
    lower, upper = _ranks(column.n, p)
    below, above = column.values[lower], column.values[upper]
    if lower == upper or below == above:
        return below
    position = p * (column.n - 1)
    return (upper - position) * below + (position - lower) * above
