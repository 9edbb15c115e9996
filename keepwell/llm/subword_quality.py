"""Quality classifier: supervised subword embeddings trained by numpy SGD.

A document is the mean of learned vectors of its hashed features: every
white-space word, every run of 3 and of 4 bytes with white space as a blank
(the blanks mark word ends), and each pair of equal neighbouring words, whatever
the word. A softmax over that mean gives class
probabilities. For scoring, each bucket's vector times the output layer is one
number per class, so a document costs a table look-up per feature.

The fit reads a bounded sample of labelled rows (``Settings.sample_rows`` and
``sample_bytes``), drawn by a hash of the id; everything is scored.

Nulls and empty texts have no features and get the score of the bias alone.
Rows without a label, with an unknown document or a null id are not trained on.
Repeated rows are scored each by itself. An empty table gives an empty result;
without two classes to learn from the fit raises ``ValueError``. Extra columns
of the input are carried by ``keep_above`` and ignored elsewhere.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keepwell.llm.textblocks import NOT_SPACE, blocks, text_bytes, words

SCORE_BLOCK_BYTES = 1_000_000
#: The bucket all pairs of equal neighbouring words share.
REPEAT = 0


@dataclass(frozen=True)
class Settings:
    """``sample_rows`` and ``sample_bytes`` bound what the fit reads."""
    bucket_bits: int = 17
    dimensions: int = 8
    epochs: int = 12
    batch: int = 16
    rate: float = 2.0
    sample_rows: int = 4_000
    sample_bytes: int = 20_000
    seed: int = 17


def features(data: np.ndarray, offsets: np.ndarray, bits: int):
    """Yields (positions, buckets): ascending byte positions of features and
    their buckets, one pair per kind of feature."""
    shift = np.uint32(32 - bits)
    blank = np.where(NOT_SPACE[data], data, np.uint8(0x20)).astype(np.uint32)
    ends = np.zeros(len(data) + 1, bool)
    ends[offsets[1:]] = True
    for size in (3, 4):
        n = len(data) - size + 1
        if n < 1:
            continue
        gram = np.full(n, size, np.uint32)
        whole = np.ones(n, bool)
        for k in range(size):
            gram = gram * np.uint32(257) + blank[k:k + n]
            if k:
                whole &= ~ends[k:k + n]
        gram ^= gram >> np.uint32(15)
        at = np.flatnonzero(whole)
        yield at, ((gram * np.uint32(2_654_435_761)) >> shift)[at]
    found = words(data, offsets, NOT_SPACE, lower=False)
    yield found.start, (found.hash >> np.uint64(64 - bits)).astype(np.uint32)
    again = np.flatnonzero(found.hash[1:] == found.hash[:-1]) + 1
    again = again[~np.isin(again, found.first)]
    yield found.start[again], np.full(len(again), REPEAT, np.uint32)


@dataclass
class Model:
    """``weight``: class scores per bucket; ``bias`` per class."""
    classes: list[int]
    weight: np.ndarray
    bias: np.ndarray
    bits: int

    def probabilities(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        total = np.zeros((len(offsets) - 1, len(self.classes)))
        count = np.zeros(len(offsets) - 1)
        for at, bucket in features(data, offsets, self.bits):
            edge = np.searchsorted(at, offsets)
            count += np.diff(edge)
            for c in range(len(self.classes)):
                run = np.zeros(len(at) + 1)
                np.cumsum(self.weight[c].take(bucket), out=run[1:])
                total[:, c] += run[edge[1:]] - run[edge[:-1]]
        z = total / np.maximum(count, 1)[:, None] + self.bias
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)


def _counted(text: str | None, bits: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(buckets, times of each, features) of a text. All rows of the sample stand in
    the driver, so a bucket has four bytes and its times four: shares are taken a
    mini-batch at a time."""
    data, offsets = text_bytes(pa.array([text], pa.string()))
    bucket = np.concatenate([np.zeros(0, np.uint32), *[b for _, b in features(data, offsets, bits)]])
    used, times = np.unique(bucket, return_counts=True)
    return used.astype(np.uint32), times.astype(np.uint32), max(1, len(bucket))


def fit_rows(texts: list[str | None], labels: list[int], settings: Settings = Settings()) -> Model:
    """Mini-batch SGD with a rate that falls to zero, as in one-hidden-layer
    bag-of-subwords models."""
    classes = sorted(set(labels))
    if len(classes) < 2:
        raise ValueError("a quality classifier needs labelled rows of two classes")
    bits, width = settings.bucket_bits, settings.dimensions
    rows = [_counted(text, bits) for text in texts]
    rng = np.random.default_rng(settings.seed)
    embedding = rng.uniform(-1 / width, 1 / width, (1 << bits, width))
    output, bias = np.zeros((width, len(classes))), np.zeros(len(classes))
    target = np.array([classes.index(y) for y in labels])
    steps = settings.epochs * (len(rows) // settings.batch + 1)
    done = 0
    for _ in range(settings.epochs):
        order = rng.permutation(len(rows))
        for at in range(0, len(order), settings.batch):
            chosen = order[at:at + settings.batch]
            rate = settings.rate * (1 - done / steps)
            done += 1
            used = np.concatenate([rows[k][0] for k in chosen])
            times = np.concatenate([rows[k][1] / rows[k][2] for k in chosen])
            doc = np.repeat(np.arange(len(chosen)), [len(rows[k][0]) for k in chosen])
            vectors = embedding[used]
            edge = np.searchsorted(doc, np.arange(len(chosen) + 1))
            run = np.concatenate([np.zeros((1, width)), np.cumsum(vectors * times[:, None], axis=0)])
            mean = run[edge[1:]] - run[edge[:-1]]
            z = mean @ output + bias
            z = np.exp(z - z.max(axis=1, keepdims=True))
            error = z / z.sum(axis=1, keepdims=True)
            error[np.arange(len(chosen)), target[chosen]] -= 1
            error /= len(chosen)
            back = (error @ output.T)[doc] * times[:, None]
            output -= rate * mean.T @ error
            bias -= rate * error.sum(axis=0)
            # A bucket's steps are scaled up: each document moves it by its share only.
            np.add.at(embedding, used, -rate * len(chosen) * back)
    return Model(classes, np.ascontiguousarray((embedding @ output).T.astype(np.float32)), bias, bits)


def fit(docs: DataFrame, labels: DataFrame, *, label: str = "quality", doc_id: str = "doc_id",
        text: str = "text", settings: Settings = Settings()) -> Model:
    """Fits on at most ``sample_rows`` labelled documents of at most
    ``sample_bytes``: those with the smallest hash of the id."""
    known = labels.where(F.col(label).isNotNull()).select(
        F.col(doc_id).alias("_id"), F.col(label).cast("int").alias("_label")).distinct()
    drawn = known.select("_id", "_label", F.xxhash64(F.col("_id"), F.lit("draw")).alias("_draw"))
    # Twice the rows are drawn before the join, since some have no short text.
    drawn = drawn.orderBy("_draw", "_id", "_label").limit(2 * settings.sample_rows)
    texts = docs.select(F.col(doc_id).alias("_id"), F.col(text).cast("string").alias("_text")).where(
        F.octet_length("_text") <= settings.sample_bytes)
    rows = texts.join(F.broadcast(drawn), "_id").orderBy("_draw", "_id", "_label", "_text").limit(
        settings.sample_rows).select("_text", "_label").collect()
    return fit_rows([r[0] for r in rows], [r[1] for r in rows], settings)


def score(docs: DataFrame, model: Model, *, positive: int = 1, doc_id: str = "doc_id",
          text: str = "text") -> DataFrame:
    """(doc_id, score): probability of class ``positive`` for every document."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    column = model.classes.index(positive)

    def run(batches):
        for batch in blocks(batches, limit=SCORE_BLOCK_BYTES):
            found = model.probabilities(*text_bytes(batch.column("text")))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(found[:, column])], names=["doc_id", "score"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, score double")


def keep_above(docs: DataFrame, model: Model, least: float, *, positive: int = 1,
               text: str = "text") -> DataFrame:
    """``docs`` whose score is at least ``least``; same columns, texts unread by
    anything but the classifier."""
    column = model.classes.index(positive)

    def run(batches):
        for batch in blocks(batches, text, SCORE_BLOCK_BYTES):
            found = model.probabilities(*text_bytes(batch.column(text)))
            yield batch.filter(pa.array(found[:, column] >= least))

    return docs.mapInArrow(run, docs.schema)
