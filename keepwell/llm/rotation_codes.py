"""Embedding near-dedup by randomised-rotation binary codes.

1. Equal vectors of a label are merged into one class with a number of its own.
2. A unit vector o is turned by several random rotations stacked to R (M rows);
   its code is the signs of R o. Stored with it: the correction factor
   f = <sign(R o) / sqrt M, R o / |R o|>.
3. Candidates: the code's leading bits are cut into bands of about log2 n bits
   (n: rows of the largest label), so an unrelated pair meets in a band about
   once per n; as many bands as make a pair at the threshold miss all of them
   with a probability below ``MISS``.
4. <code, R q> / (f sqrt M |R q|) is an unbiased estimate of the cosine of a
   candidate pair, and sqrt(1 - f^2) / f * EPSILON / sqrt(M - 1) bounds its error
   but for a probability far below ``MISS``. Only pairs whose upper bound reaches
   the threshold are computed again from the vectors, in double precision.
5. Links are counted with the classes' sizes, components are found on classes.

A group of n different vectors that are all linked has n^2 / 2 links, and their
number is part of the result; apart from those, candidates grow with n log n.

A vector that is null, zero, empty or holds null or non-finite components, and a
row whose label or id is null, links with nothing: 0 links, itself as component
(a null id has none and is kept). Vectors of different lengths never link. Rows
that share an id count one by one. Empty tables give empty results; extra
columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keepwell.llm.components import components
from keepwell.llm.textblocks import mix
from keepwell.session import materialise

MISS = 1e-6
EPSILON = 5.0
LEAST_BAND_BITS = 12


def plan_bands(n: int, threshold: float) -> tuple[int, int]:
    """(bits per band, bands) for labels of up to ``n`` rows."""
    same = 1 - math.acos(threshold) / math.pi
    bits = min(60, max(LEAST_BAND_BITS, math.ceil(math.log2(max(2, n)))))
    return bits, math.ceil(math.log(MISS) / math.log1p(-same**bits))


def rotations(width: int, bits: int) -> np.ndarray:
    """Random orthogonal matrices of ``width``, stacked to ``bits`` rows or more."""
    rng = np.random.default_rng(width)
    parts = []
    for _ in range(math.ceil(bits / width)):
        q, r = np.linalg.qr(rng.standard_normal((width, width)))
        parts.append(q * np.sign(np.diag(r)))
    return np.concatenate(parts)


def matrix(column: pa.Array) -> np.ndarray:
    """Lists of one length as rows of doubles."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def by_width(batches, *vectors: str):
    """Batches split so that the lists in each have one length."""
    for batch in batches:
        width = np.array([len(x) for x in batch.column(vectors[0])], np.int64)
        for w in np.unique(width):
            yield int(w), batch.filter(pa.array(width == w))


def usable(embeddings: DataFrame, vec_id: str, vector: str, label: str) -> DataFrame:
    """(vec_id, label, vector, print_a, print_b, usable) of every row; the
    others cannot link."""
    rows = embeddings.select(
        F.col(vec_id).alias("vec_id"), F.col(label).alias("label"),
        F.col(vector).cast("array<double>").alias("vector"))
    named = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size("vector") > 0)
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    length = F.aggregate("vector", F.lit(0.0), lambda total, x: total + x * x)
    held = F.coalesce(named & finite & (length > 0) & (length < float("inf")), F.lit(False))
    return rows.select("*", F.xxhash64("vector").alias("print_a"), F.xxhash64(F.lit(1), "vector").alias("print_b"),
                       held.alias("usable"))


def encode(classes: DataFrame, band_bits: int, bands: int) -> DataFrame:
    """(class, label, code, factor, keys): keys are the band buckets."""
    def run(batches):
        turned: dict[int, np.ndarray] = {}
        for width, batch in by_width(batches, "vector"):
            if width not in turned:
                turned[width] = rotations(width, bands * band_bits)
            x = matrix(batch.column("vector"))
            y = (x / np.linalg.norm(x, axis=1, keepdims=True)) @ turned[width].T
            sign = y > 0
            factor = np.abs(y).sum(axis=1) / (np.sqrt(y.shape[1]) * np.linalg.norm(y, axis=1))
            banded = sign[:, :bands * band_bits].reshape(len(x), bands, band_bits)
            number = banded @ (np.uint64(1) << np.arange(band_bits, dtype=np.uint64))
            salt = mix(np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(8_191) + np.uint64(width))
            keys = mix(number.astype(np.uint64) ^ salt).view(np.int64)
            yield pa.RecordBatch.from_arrays([
                batch.column("class"), batch.column("label"),
                pa.array([row.tobytes() for row in np.packbits(sign, axis=1)], pa.binary()),
                pa.array(factor), pa.array(list(keys), pa.list_(pa.int64())),
            ], names=["class", "label", "code", "factor", "keys"])

    kinds = {f.name: f.dataType.simpleString() for f in classes.schema}
    return classes.select("class", "label", "vector").mapInArrow(
        run, f"class {kinds['class']}, label {kinds['label']}, code binary, factor double, keys array<long>")


def possible(pairs: DataFrame, threshold: float, bits: int) -> DataFrame:
    """The pairs whose estimate plus its bound reaches the threshold; needs
    columns x_vector (asked in full) and y_code, y_factor."""
    def run(batches):
        turned: dict[int, np.ndarray] = {}
        for width, batch in by_width(batches, "x_vector"):
            if width not in turned:
                turned[width] = rotations(width, bits)
            x = matrix(batch.column("x_vector"))
            y = (x / np.linalg.norm(x, axis=1, keepdims=True)) @ turned[width].T
            y /= np.linalg.norm(y, axis=1, keepdims=True)
            size = y.shape[1]
            code = np.frombuffer(b"".join(batch.column("y_code").to_pylist()), np.uint8)
            sign = np.unpackbits(code.reshape(len(x), -1), axis=1)[:, :size].astype(np.float64) * 2 - 1
            factor = batch.column("y_factor").to_numpy()
            estimate = np.einsum("ij,ij->i", sign, y) / (np.sqrt(size) * factor)
            bound = np.sqrt(np.maximum(0, 1 - factor**2)) / factor * EPSILON / math.sqrt(max(1, size - 1))
            yield batch.select(["x", "y", "x_vector"]).filter(pa.array(estimate + bound >= threshold))

    kind = pairs.schema["x"].dataType.simpleString()
    return pairs.select("x", "y", "x_vector", "y_code", "y_factor").mapInArrow(
        run, f"x {kind}, y {kind}, x_vector array<double>")


def exact(pairs: DataFrame, threshold: float) -> DataFrame:
    """(x, y) of the pairs whose cosine is at least ``threshold``."""
    def run(batches):
        for _, batch in by_width(batches, "x_vector"):
            x, y = matrix(batch.column("x_vector")), matrix(batch.column("y_vector"))
            cosine = np.einsum("ij,ij->i", x, y) / (np.linalg.norm(x, axis=1) * np.linalg.norm(y, axis=1))
            yield batch.select(["x", "y"]).filter(pa.array(cosine >= threshold))

    kind = pairs.schema["x"].dataType.simpleString()
    return pairs.select("x", "y", "x_vector", "y_vector").mapInArrow(run, f"x {kind}, y {kind}")


def near_vectors(embeddings: DataFrame, threshold: float = 0.98, *, vec_id: str = "vec_id",
                 vector: str = "embedding", label: str = "label") -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``embeddings``."""
    judged = usable(embeddings, vec_id, vector, label)
    rows = judged.where("usable")
    prints = ["label", "print_a", "print_b"]
    members = materialise(judged.select("vec_id", *prints, "usable"))
    sizes = materialise(members.where("usable").groupBy(*prints).agg(
        F.min("vec_id").alias("first"), F.count("*").alias("copies")).withColumn(
        "class", F.monotonically_increasing_id()))
    classes = materialise(rows.join(sizes, prints).where(F.col("vec_id") == F.col("first")).select(
        "class", "label", "vector").dropDuplicates(["class"]))
    largest = sizes.groupBy("label").count().agg(F.max("count")).first()[0] or 1
    band_bits, bands = plan_bands(largest, threshold)
    coded = materialise(encode(classes, band_bits, bands))

    buckets = coded.select("class", "label", F.explode("keys").alias("key"))
    x = buckets.withColumnsRenamed({"class": "x"})
    y = buckets.withColumnsRenamed({"class": "y"})
    pairs = x.join(y, ["key", "label"]).where("x < y").select("x", "y").distinct()
    vectors = classes.select("class", "vector")
    asked = pairs.join(vectors.withColumnsRenamed({"class": "x", "vector": "x_vector"}), "x").join(
        coded.select(F.col("class").alias("y"), F.col("code").alias("y_code"), F.col("factor").alias("y_factor")), "y")
    again = possible(asked, threshold, bands * band_bits).join(
        vectors.withColumnsRenamed({"class": "y", "vector": "y_vector"}), "y")
    links = materialise(exact(again, threshold))

    both = links.unionByName(links.select(F.col("y").alias("x"), F.col("x").alias("y")))
    copies = sizes.select(F.col("class").alias("y"), "copies")
    linked = both.join(copies, "y").groupBy(F.col("x").alias("class")).agg(F.sum("copies").alias("others"))
    merged = materialise(components(links, "x", "y").withColumnsRenamed({"node": "class"}).join(
        sizes.select("class", "first"), "class"))
    named = merged.groupBy("component").agg(F.min("first").alias("component_id"))
    found = sizes.join(linked, "class", "left").join(
        merged.join(named, "component").select("class", "component_id"), "class", "left").select(
        *prints, (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"),
        F.coalesce("component_id", "first").alias("component_id"))
    placed = members.where("usable").join(found, prints).select("vec_id", "n_links", "component_id")
    alone = members.where("NOT usable").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return placed.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
