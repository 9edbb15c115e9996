"""MinHash near-duplicate groups: one permutation, optimal densification, stars.

1. Every document becomes the set of its distinct word shingles (64-bit hashes);
   equal sets are merged into one class, named by its least id.
2. One-permutation hashing: a shingle's hash falls into one of bands * rows bins
   by its leading bits, each bin keeps its least hash, and empty bins borrow from
   the bin a bin-specific permutation finds first (optimal densification).
3. Each band of ``rows`` bins is a bucket key. Instead of all pairs in a bucket,
   each class gets one candidate edge: to the least class it shares any bucket
   with (a star). Edges are confirmed on the full sets.
4. Confirmed stars are merged. What a star may miss are links across the groups
   that remain in one bucket; there the largest group leads, and the classes of
   the others are compared with it and with each other, in blocks of bounded
   size that emit only links. So within the buckets no link is lost, and a group
   of n copies costs n edges, not n * n; only classes that share buckets with a
   group without a link to it are compared with all of it. The bands make a pair
   at the threshold miss all buckets with a probability below one in a million.

Nulls, empty texts and texts without words have no shingles and link with
nothing. A text of fewer words than a shingle is one shingle. A null id links
with nothing and is kept. Rows that share an id count as one document that has
the links of all of them. Empty tables give empty results; extra columns are
ignored or carried (``keep_one``).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keepwell.llm.components import components
from keepwell.llm.textblocks import (
    NOT_SPACE, blocks, mix, text_bytes, window_hashes, words,
)
from keepwell.session import materialise

PAIR_BLOCK_BYTES = 2_000_000
BLOCK_SHINGLES = 200_000


def shingle_sets(column: pa.Array, size: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of every text."""
    found = words(*text_bytes(column), NOT_SPACE)
    full = window_hashes(found.hash, size)
    for first, end in zip(found.first.tolist(), found.first[1:].tolist()):
        if end - first >= size:
            yield np.unique(full[first:end - size + 1])
        else:
            yield window_hashes(found.hash[first:end], end - first) if end > first else full[:0]


class Signature:
    """Bins of one-permutation hashing and their banded bucket keys."""

    def __init__(self, bands: int, rows: int):
        self.bands, self.rows = bands, rows
        self.bins = bands * rows
        self.edges = np.array([(k << 64) // self.bins for k in range(self.bins)], np.uint64)
        rng = np.random.default_rng(1_009)
        self.donors = np.stack([rng.permutation(self.bins) for _ in range(self.bins)])
        self.band = mix(np.arange(1, bands + 1, dtype=np.uint64))

    def keys(self, shingles: np.ndarray) -> np.ndarray:
        at = np.searchsorted(shingles, self.edges)
        filled = np.diff(at, append=len(shingles)) > 0
        donor = np.arange(self.bins)
        if not filled.all():
            empty = np.flatnonzero(~filled)
            order = self.donors[empty]
            donor[empty] = order[np.arange(len(empty)), filled[order].argmax(axis=1)]
        least = shingles[at[donor]].reshape(self.bands, self.rows)
        key = self.band.copy()
        for k in range(self.rows):
            key = mix(key ^ least[:, k]) * np.uint64(0x9E3779B97F4A7C15)
        return key


def signatures(docs: DataFrame, size: int, bands: int, rows: int, doc_id: str, text: str) -> DataFrame:
    """(doc_id, n_shingles, print_a, print_b, keys): the prints name the set."""
    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))

    def run(batches):
        sign = Signature(bands, rows)
        for batch in blocks(batches):
            n, first, second, keys = [], [], [], []
            for s in shingle_sets(batch.column("text"), size):
                n.append(len(s))
                with np.errstate(over="ignore"):
                    first.append(int(mix(s).sum(dtype=np.uint64)) if len(s) else 0)
                    second.append(int(mix(s ^ np.uint64(0xA5A5A5A5)).sum(dtype=np.uint64)) if len(s) else 0)
                keys.append(sign.keys(s).view(np.int64) if len(s) else None)
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array(n, pa.int64()),
                pa.array(np.array(first, np.uint64).view(np.int64)),
                pa.array(np.array(second, np.uint64).view(np.int64)),
                pa.array(keys, pa.list_(pa.int64())),
            ], names=["doc_id", "n_shingles", "print_a", "print_b", "keys"])

    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(
        run, f"doc_id {kind}, n_shingles long, print_a long, print_b long, keys array<long>")


def confirm(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs (a, b) with 100 * |intersection| >= percent * |union|."""
    joined = pairs.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a")
    joined = joined.join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b")

    def run(batches):
        for batch in blocks(blocks(batches, "text_a", PAIR_BLOCK_BYTES), "text_b", PAIR_BLOCK_BYTES):
            sets = zip(shingle_sets(batch.column("text_a"), size), shingle_sets(batch.column("text_b"), size))
            linked = []
            for x, y in sets:
                common = len(np.intersect1d(x, y, assume_unique=True))
                linked.append(common > 0 and 100 * common >= percent * (len(x) + len(y) - common))
            yield batch.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))

    kind = pairs.schema["a"].dataType.simpleString()
    return joined.select("a", "b", "text_a", "text_b").mapInArrow(run, f"a {kind}, b {kind}").distinct()


def _comparisons(buckets: DataFrame, merged: DataFrame) -> DataFrame:
    """Who is still to be compared: (lead, asks, doc_id, component, x_block,
    u_block). In a bucket with several groups the largest leads; every class of
    another group asks, and is compared with all classes of the leading group
    and with all that ask it. That covers each pair of groups in each bucket.

    Both sides of a lead are dealt into blocks of about ``BLOCK_SHINGLES``, and
    each pair of blocks is a work group of bounded size, however large the lead.
    """
    named = materialise(buckets.join(
        merged.withColumnsRenamed({"node": "doc_id"}), "doc_id", "left").select(
        "key", "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component")))
    groups = named.groupBy("key", "component").agg(F.count("*").alias("n"))
    lead = groups.groupBy("key").agg(
        F.max_by("component", F.struct("n", "component")).alias("lead"), F.count("*").alias("groups"))
    asking = materialise(named.join(lead.where("groups > 1"), "key").where("component != lead").select(
        "lead", "doc_id", "n_shingles", "component", F.lit(True).alias("asks")).distinct())
    members = named.select("doc_id", "n_shingles", "component").distinct().join(
        asking.select(F.col("lead").alias("component")).distinct(), "component").select(
        F.col("component").alias("lead"), "doc_id", "n_shingles", "component", F.lit(False).alias("asks"))
    rows = asking.unionByName(members)
    room = rows.groupBy("lead").agg(
        F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES).cast("int").alias("x_blocks"),
        F.ceil(F.sum(F.when(F.col("asks"), F.col("n_shingles"))) / BLOCK_SHINGLES).cast("int").alias("u_blocks"))
    dealt = rows.join(room, "lead").withColumns({
        "x_block": F.pmod(F.xxhash64("doc_id"), "x_blocks").cast("int"),
        "u_block": F.pmod(F.xxhash64("doc_id"), "u_blocks").cast("int")})
    every = lambda count: F.explode(F.sequence(F.lit(0), F.col(count) - 1))
    compared = dealt.select("lead", F.lit(False).alias("asks"), "doc_id", "component", "x_block",
                            every("u_blocks").alias("u_block"))
    asked = dealt.where("asks").select("lead", "asks", "doc_id", "component",
                                       every("x_blocks").alias("x_block"), "u_block")
    return compared.unionByName(asked)


def _compare(work: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Links (a, b) found in the work groups: for every class that asks, the
    least linked class of each group, which is all that merging needs."""
    rows = work.join(texts, "doc_id").select("lead", "x_block", "u_block", "asks", "doc_id", "component", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("doc_id")
        asks = table.column("asks").to_numpy()
        name, group = table.column("doc_id"), table.column("component").to_numpy()
        sets = [s for batch in blocks(table.select(["text"]).to_batches()) for s in
                shingle_sets(batch.column("text"), size)]
        held = np.flatnonzero(~asks)
        count = np.array([len(sets[k]) for k in held])
        owner = np.repeat(np.arange(len(held)), count)
        shingle = np.concatenate([sets[k] for k in held] or [np.zeros(0, np.uint64)])
        order = np.argsort(shingle, kind="stable")
        shingle, owner = shingle[order], owner[order]
        left, right = [], []
        for u in np.flatnonzero(asks):
            low, high = np.searchsorted(shingle, sets[u]), np.searchsorted(shingle, sets[u], "right")
            many = high - low
            at = np.repeat(low - (np.cumsum(many) - many), many) + np.arange(many.sum())
            common = np.bincount(owner[at], minlength=len(held))
            near = (common > 0) & (100 * common >= percent * (count + len(sets[u]) - common))
            near &= group[held] != group[u]
            x = held[near]
            for k in x[np.unique(group[x], return_index=True)[1]]:
                left.append(u)
                right.append(k)
        return pa.table({"a": name.take(pa.array(left, pa.int64())), "b": name.take(pa.array(right, pa.int64()))})

    return rows.groupBy("lead", "x_block", "u_block").applyInArrow(run, f"a {kind}, b {kind}").distinct()


def near_duplicates(docs: DataFrame, *, size: int, percent: int, bands: int = 32, rows: int = 6,
                    doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs``."""
    signed = materialise(signatures(docs, size, bands, rows, doc_id, text))
    usable = signed.where("n_shingles > 0 AND doc_id IS NOT NULL")
    prints = ["print_a", "print_b", "n_shingles"]
    classes = materialise(usable.groupBy(*prints).agg(F.min("doc_id").alias("first")))

    # Buckets with two classes or more; the class is its least id.
    entries = usable.join(classes, prints).where(F.col("doc_id") == F.col("first")).select(
        "doc_id", "n_shingles", F.explode("keys").alias("key"))
    entries = materialise(entries)
    shared = entries.groupBy("key").agg(F.min("doc_id").alias("centre"), F.max("doc_id").alias("last")).where(
        "centre < last").select("key", "centre")
    buckets = materialise(entries.join(shared, "key"))
    stars = materialise(buckets.where("doc_id > centre").groupBy(F.col("doc_id").alias("a")).agg(
        F.min("centre").alias("b")))

    wanted = buckets.select("doc_id").distinct()
    texts = materialise(docs.select(
        F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text")).join(
        wanted, "doc_id", "left_semi"))
    linked = materialise(confirm(stars, texts, size, percent))
    work = materialise(_comparisons(buckets, components(linked)))
    merged = components(linked.unionByName(_compare(work, texts, size, percent)))

    rooted = classes.join(merged.withColumnsRenamed({"node": "first"}), "first", "left").select(
        *prints, F.coalesce("component", "first").alias("component"))
    out = signed.drop("keys").join(rooted, prints, "left")
    component = F.coalesce(F.when(F.col("doc_id").isNotNull(), F.col("component")), "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def keep_one(docs: DataFrame, *, doc_id: str = "doc_id", **options) -> DataFrame:
    """``docs`` without the documents that follow another of their group; same
    columns. Ids that are dropped are found first, the texts join them once."""
    found = near_duplicates(docs, doc_id=doc_id, **options)
    gone = materialise(found.where(~F.col("kept")).select(F.col("doc_id").alias(doc_id)).distinct())
    return docs.join(gone, doc_id, "left_anti").select(*docs.columns)
