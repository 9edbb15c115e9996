"""Seeded exact-size samples and train/test splits.

A row's place in the draw is md5(seed|id), the same on any engine and for any
partitioning. Finding the n-th smallest hash does not sort the table: hashes are
counted by their next ``_STEP`` hex digits (at most 16 ** _STEP counters per
class, summed on the map side), the bucket that holds the cut is opened and its
rows are counted by the following digits, until the cut is a single hash. The
cut then becomes a literal and every row decides alone: the split itself is a
projection without join or shuffle.

Ids are expected to be unique. Rows that share an id share their draw; where the
cut would fall between such rows no size-true sample exists and the draw raises.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keepwell import contract as C

_STEP = 3
MOST_CLASSES = 1_000


def draw_hash(id_column: str, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}|"), F.col(id_column).cast("string")).cast("binary"))


def _cuts(hashed: DataFrame, take: Callable[[dict], dict]) -> dict:
    """Per class (None among them) the hash of its last drawn row. ``take``
    turns class sizes into the number of rows to draw; classes that draw none
    are left out."""
    sizes = {r["_class"]: r["n"] for r in hashed.groupBy("_class").agg(
        F.count("*").alias("n")).limit(MOST_CLASSES + 1).collect()}
    if len(sizes) > MOST_CLASSES:
        raise ValueError(f"more than {MOST_CLASSES} classes to draw from")
    wanted = {c: n for c, n in take(sizes).items() if n}
    prefix = dict.fromkeys(wanted, "")
    cuts: dict = {}
    while wanted:
        mine = [F.col("_class").eqNullSafe(F.lit(c)) & F.col("_hash").startswith(prefix[c]) for c in wanted]
        done = len(next(iter(prefix.values())))
        rows = hashed.where(reduce(or_, mine)).groupBy(
            "_class", F.substring("_hash", done + 1, _STEP).alias("digits")).agg(
            F.count("*").alias("n"), F.min("_hash").alias("low"), F.max("_hash").alias("high")
        ).orderBy("digits").collect()
        for row in rows:
            c = row["_class"]
            if wanted[c] < 0:
                continue
            if wanted[c] > row["n"]:
                wanted[c] -= row["n"]
                continue
            if row["low"] == row["high"]:
                if row["n"] != wanted[c]:
                    raise ValueError("the cut falls between rows that share an id")
                cuts[c] = row["high"]
            else:
                prefix[c] = row["low"][:done] + row["digits"]
            wanted[c] = -wanted[c]              # found in this round
        wanted = {c: -n for c, n in wanted.items() if c not in cuts}
        prefix = {c: prefix[c] for c in wanted}
    return cuts


def _drawn(df: DataFrame, cls: Column, id_column: str, seed: int, take) -> Column:
    draw = draw_hash(id_column, seed)
    cuts = _cuts(df.select(cls.alias("_class"), draw.alias("_hash")), take)
    out = F.lit(False)
    for value, cut in cuts.items():
        out = F.when(cls.eqNullSafe(F.lit(value)), draw <= cut).otherwise(out)
    return out


def fixed_sample(df: DataFrame, size: int, id_column: str = C.ID, seed: int = C.SEED) -> DataFrame:
    """``size`` rows without replacement (all rows if there are fewer)."""
    def take(sizes):
        return {c: min(size, n) for c, n in sizes.items()}
    return df.where(_drawn(df, F.lit(0), id_column, seed, take))


def deal_test_rows(sizes: dict, test_share: float) -> dict:
    """Test rows per class: ceil(share * n) in all, dealt out in proportion,
    largest remainder first."""
    total = sum(sizes.values())
    n_test = math.ceil(test_share * total)
    out = {c: n_test * n // total for c, n in sizes.items()}
    by_rest = sorted(sizes, key=lambda c: (-(n_test * sizes[c] % total), c is not None, 0 if c is None else c))
    for c in by_rest[: n_test - sum(out.values())]:
        out[c] += 1
    return out


def exact_split(df: DataFrame, test_share: float = C.TEST_SHARE, strata: str | None = None,
                id_column: str = C.ID, seed: int = C.SEED) -> DataFrame:
    """Adds ``is_test``. ``strata`` names a class column with at most
    ``MOST_CLASSES`` values (NULL is one); each class is cut separately, so
    class shares stay equal to a row."""
    cls = F.col(strata) if strata else F.lit(0)
    drawn = _drawn(df, cls, id_column, seed, lambda sizes: deal_test_rows(sizes, test_share))
    return df.withColumn("is_test", drawn)
