"""Hilbert-curve sharding for file pruning in several metadata dimensions.

Every dimension is cut into 2**bits steps: text values by their digest (equal
values share a step, so a filter on a value meets few steps), whole numbers by
equal depth over a log-linear histogram of all rows. The steps are a cell of a
cube, the cell has a place on the Hilbert curve, and the rows in curve order are
cut into runs, one per shard. Near rows on the curve are near in every
dimension, so each shard covers a small range of each: see ``shard_ranges``.

Laws: ``rows`` cuts the order so that counts differ by one at most, ``bytes`` so
that sizes are near equal (each boundary is off by less than one document).
Ties on the curve are ordered by text checksum and id, so equal texts with equal
metadata stand together and a hot value spreads over as many shards as its rows
fill. Sorting is a range partitioning by that whole key; no task sees more than
its range.

Nulls: a null dimension is step 0, a null text has no bytes and checksum 0.
Rows that are equal in every column are ordered arbitrarily among themselves.
An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keepwell.operators.ordering import rank_global, running_totals
from keepwell.session import materialise

BITS = 5
ROW_OVERHEAD = 16
TEXT, NUMBER = "text", "number"


def text_step(value: Column, bits: int) -> Column:
    head = F.conv(F.substring(F.md5(value), 1, 4), 16, 10).cast("int")
    return F.coalesce(F.shiftright(head, 16 - bits), F.lit(0))


def magnitude(value: Column) -> Column:
    """Code of a whole number of 0 or more, increasing with it: its bit length
    and the three bits after the leading one; at most 512 codes."""
    digits = F.bin(F.when(value >= 0, value.cast("long")).otherwise(F.when(value < 0, 0)) + 8)
    return F.length(digits) * 8 + F.conv(F.substring(digits, 2, 3), 2, 10).cast("int")


def depth_steps(codes: DataFrame, bits: int) -> DataFrame:
    """(code, step): rows with smaller codes as a share of all, in steps. One
    row per code, so its size does not depend on the data."""
    counts = codes.where("code IS NOT NULL").groupBy("code").agg(F.count("*").alias("n"))
    order = Window.orderBy("code")
    before = F.coalesce(F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    total = F.sum("n").over(Window.partitionBy())
    return counts.select("code", F.floor(before * (1 << bits) / total).cast("int").alias("step"))


def hilbert_index(steps: list[Column], bits: int) -> Column:
    """Place on the Hilbert curve of a cell: the axes are turned level by level
    into the transposed index, which is Gray-decoded and interleaved."""
    n = len(steps)
    x = F.array(*[s.cast("int") for s in steps])
    levels = F.array(*[
        F.struct(F.lit(1 << k).alias("q"), F.lit(i).alias("i"))
        for k in range(bits - 1, 0, -1) for i in range(n)])

    def turn(state: Column, level: Column) -> Column:
        q, mine, zero = level["q"], F.get(state, level["i"]), F.get(state, F.lit(0))
        swap = zero.bitwiseXOR(mine).bitwiseAND(q - 1)
        inverted = mine.bitwiseAND(q) != 0
        first = zero.bitwiseXOR(F.when(inverted, q - 1).otherwise(swap))
        other = mine.bitwiseXOR(F.when(inverted, 0).otherwise(swap))
        return F.transform(state, lambda v, k: F.when(k == 0, first).when(k == level["i"], other).otherwise(v))

    turned = F.aggregate(levels, x, turn)
    gray = F.transform(turned, lambda _, k: F.aggregate(
        F.slice(turned, F.lit(1), k + 1), F.lit(0), lambda a, b: a.bitwiseXOR(b)))

    def finish(state: Column) -> Column:
        last = F.get(state, F.lit(n - 1))
        flip = F.lit(0)
        for k in range(bits - 1, 0, -1):
            flip = flip.bitwiseXOR(F.when(last.bitwiseAND(F.lit(1 << k)) != 0, (1 << k) - 1).otherwise(0))
        index = F.lit(0).cast("long")
        for k in range(bits - 1, -1, -1):
            for i in range(n):
                bit = F.shiftright(F.get(state, F.lit(i)).bitwiseXOR(flip), k).bitwiseAND(F.lit(1))
                index = index * 2 + bit
        return index

    return F.aggregate(F.array(gray), F.array().cast("array<int>"), lambda _, g: g, finish)


def curve_order(docs: DataFrame, dimensions: dict[str, str], *, bits: int = BITS,
                doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, hilbert) and the dimensions as ``dim_*``,
    stored. ``dimensions`` names columns, ``text`` or ``number`` each."""
    plain = F.coalesce(F.col(text), F.lit(""))
    dims = {f"dim_{k}": F.col(c) for k, c in enumerate(dimensions)}
    narrow = materialise(docs.select(
        F.col(doc_id).alias("doc_id"),
        (F.octet_length(plain) + ROW_OVERHEAD).cast("long").alias("size"),
        F.crc32(plain).alias("text_crc32"), *[c.alias(n) for n, c in dims.items()]))
    steps = []
    for name, kind in zip(dims, dimensions.values()):
        if kind == TEXT:
            steps.append(text_step(F.col(name).cast("string"), bits))
            continue
        code = magnitude(F.col(name))
        known = F.broadcast(depth_steps(narrow.select(code.alias("code")), bits))
        narrow = narrow.join(known.withColumnsRenamed({"code": f"_{name}", "step": f"_step_{name}"}),
                             code == F.col(f"_{name}"), "left")
        steps.append(F.coalesce(F.col(f"_step_{name}"), F.lit(0)))
    return materialise(narrow.select(
        "doc_id", "size", "text_crc32", *dims, hilbert_index(steps, bits).alias("hilbert")))


def shard(docs: DataFrame, dimensions: dict[str, str], shards: int, *, law: str = "rows",
          bits: int = BITS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row with its shard (from 0) and its slot in it (gapless from 0)."""
    if law not in ("rows", "bytes"):
        raise ValueError(f"no such law: {law}")
    order = [F.asc("hilbert"), F.asc("text_crc32"), F.asc("doc_id")]
    rows = curve_order(docs, dimensions, bits=bits, doc_id=doc_id, text=text)
    total = rows.agg(F.count("*").alias("rows"), F.sum("size").alias("bytes")).first()
    if law == "rows":
        n = max(1, total["rows"])
        return _cut_rows(rank_global(rows, order, "_rank"), n, shards)
    placed = running_totals(rows, order, {"_before": F.col("size"), "_rank": F.lit(1)})
    middle = F.expr(f"CAST((2 * _before + size) * {shards}L DIV {2 * max(1, total['bytes'] or 1)}L AS int)")
    cut = materialise(placed.withColumn("shard", F.least(middle, F.lit(shards - 1))))
    first = cut.groupBy("shard").agg(F.min("_rank").alias("_first"))     # one row per shard
    return cut.join(F.broadcast(first), "shard").withColumn(
        "slot", F.col("_rank") - F.col("_first")).drop("_rank", "_first", "_before")


def _cut_rows(ranked: DataFrame, n: int, shards: int) -> DataFrame:
    """Shard s holds the 0-based places from ceil(s n / shards) on."""
    numbered = ranked.withColumn("shard", F.expr(f"CAST((_rank - 1) * {shards}L DIV {n}L AS int)"))
    first = F.expr(f"(shard * {n}L + {shards - 1}L) DIV {shards}L")
    return numbered.withColumn("slot", F.col("_rank") - 1 - first).drop("_rank")


def shard_ranges(sharded: DataFrame) -> DataFrame:
    """Per shard: rows, bytes, and least and greatest value of every dimension,
    the statistics a reader prunes files by."""
    dims = [c for c in sharded.columns if c.startswith("dim_")]
    return sharded.groupBy("shard").agg(
        F.count("*").alias("rows"), F.sum("size").alias("bytes"),
        *[f(c).alias(f"{n}_{c}") for c in dims for n, f in (("min", F.min), ("max", F.max))])
