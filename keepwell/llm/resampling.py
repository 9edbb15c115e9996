"""Importance resampling towards a target text collection.

Features are the runs of 1 to ``most`` consecutive words, hashed by CRC-32 into
buckets. A bucket's gain is the log ratio of its smoothed shares in the target and
in the corpus, a document's weight the mean gain of its features; a keyed Gumbel
draw on top of it picks the documents.

The vocabulary has a head and a tail. All words (and pairs) of the corpus are
counted; the most frequent go out with their CRC states and buckets, as a
broadcast of at most HEAD entries of at most HEAD_BYTES each. What is not in the
head takes its CRC directly, a longer run from the state of its first words. Both
ways give the same numbers, so bucket totals and weights are exact over all
documents, and totals are summed per task before they are shuffled.

Nulls and empty texts: no features, weight 0; a row without an id has no draw, no
score and no rank. Ties go to the smaller id, repeated rows are drawn each by
itself. Empty tables: an empty corpus gives no rows, an empty target gains that
depend on the corpus alone. Extra columns of the inputs are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keepwell.llm.textblocks import blocks
from keepwell.llm.wordlists import texts, word_lists
from keepwell.operators.ordering import rank_global
from keepwell.session import materialise

BUCKETS = 10_000
LEAST_WORDS = 20
PERCENT = 10
SEED = 2024
#: Entries of the head for each length of run, and bytes of one entry.
HEAD = 65_536
HEAD_BYTES = 64
_HELD = 300_000
_SIZES = 32                # classes of counts per power of two


class _States(dict):
    """CRC state after a word; words outside the head are computed when asked."""

    def __missing__(self, word: bytes) -> int:
        return crc32(word)


class _Buckets(dict):
    """Bucket of a word or, as a tuple, of a pair."""

    def __init__(self, known: dict, states: _States, buckets: int):
        super().__init__(known)
        self.states, self.buckets = states, buckets

    def __missing__(self, run) -> int:
        state = self.states[run] if isinstance(run, bytes) else crc32(b" " + run[1], self.states[run[0]])
        return state % self.buckets


class Vocabulary:
    """Buckets of all features, by the head where they are in it."""

    def __init__(self, words: list[bytes], pairs: list[tuple[bytes, bytes]], buckets: int, most: int):
        self.buckets, self.most = buckets, most
        self.states = _States((w, crc32(w)) for w in words)
        self.words = _Buckets({w: s % buckets for w, s in self.states.items()}, self.states, buckets)
        self.pairs = _Buckets({(a, b): crc32(b" " + b, self.states[a]) % buckets for a, b in pairs},
                              self.states, buckets)

    def of_text(self, raw: bytes) -> Iterator[tuple[int, list[int]]]:
        """(words, buckets of all features that end there) per part of a text."""
        before: list[bytes] = []
        for words in word_lists(raw):
            out = list(map(self.words.__getitem__, words))
            if self.most > 1:
                line = before + words
                skip = len(before)
                out += map(self.pairs.__getitem__, zip(line[max(skip - 1, 0):], line[max(skip, 1):]))
                for size in range(3, self.most + 1):
                    out += (self._long(line[end - size + 1:end + 1])
                            for end in range(max(skip, size - 1), len(line)))
                before = line[-(self.most - 1):]
            yield len(words), out

    def _long(self, run: list[bytes]) -> int:
        state = self.states[run[0]]
        for word in run[1:]:
            state = crc32(b" " + word, state)
        return state % self.buckets


def _head(rows: DataFrame, size: int) -> list[tuple]:
    """The most frequent words or pairs of all texts, HEAD at most. Tasks count
    before they send, and hold _HELD different ones at most."""
    def count(batches):
        held: Counter = Counter()
        for batch in blocks(batches):
            for raw in texts(batch.column("text")):
                last: list[bytes] = []
                for words in word_lists(raw):
                    line = last + words
                    held.update(words if size == 1 else zip(line, line[1:]))
                    last = words[-1:]
                    if len(held) > _HELD:
                        yield _counted(held)
                        held.clear()
        yield _counted(held)

    counted = rows.mapInArrow(count, "run binary, n long").groupBy("run").agg(F.sum("n").alias("n"))
    counted = materialise(counted.where(F.octet_length("run") <= HEAD_BYTES).withColumn(
        "size", F.floor(F.log2("n") * _SIZES).cast("int")))
    # Whole classes of like counts from the top, so the driver gets the head alone.
    least, held = None, 0
    for r in counted.groupBy("size").agg(F.count("*").alias("runs")).orderBy(F.desc("size")).collect():
        held += r["runs"]
        if held > HEAD:
            break
        least = r["size"]
    if least is None:
        return []
    return [tuple(bytes(r.run).split(b" ")) for r in
            counted.where(F.col("size") >= least).select("run").collect()]


def _counted(held: Counter) -> pa.RecordBatch:
    runs = [r if isinstance(r, bytes) else b" ".join(r) for r in held]
    return pa.RecordBatch.from_arrays([pa.array(runs, pa.binary()), pa.array(list(held.values()), pa.int64())],
                                      names=["run", "n"])


def head_vocabulary(docs: DataFrame, *, text: str = "text", buckets: int = BUCKETS, most: int = 1) -> Vocabulary:
    rows = docs.select(F.col(text).cast("string").alias("text"))
    words = [run[0] for run in _head(rows, 1)]
    return Vocabulary(words, _head(rows, 2) if most > 1 else [], buckets, most)


def bucket_totals(docs: DataFrame, vocabulary, *, text: str = "text") -> np.ndarray:
    """Features per bucket over all texts. ``vocabulary`` is a broadcast one."""
    def total(batches):
        sums = np.zeros(vocabulary.value.buckets, np.int64)
        for batch in blocks(batches):
            for raw in texts(batch.column("text")):
                for _, found in vocabulary.value.of_text(raw):
                    sums += np.bincount(np.array(found, np.int64), minlength=len(sums))
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(sums[at], pa.int64())],
                                         names=["bucket", "n"])

    rows = docs.select(F.col(text).cast("string").alias("text")).mapInArrow(total, "bucket long, n long")
    out = np.zeros(vocabulary.value.buckets, np.int64)
    for r in rows.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r.bucket] = r.n
    return out


def bucket_gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of smoothed shares, rounded down."""
    m, all_corpus, all_target = len(corpus), int(corpus.sum()), int(target.sum())
    return np.array([
        math.floor(1000 * math.log(float(t + 1) * float(all_corpus + m) / (float(s + 1) * float(all_target + m))))
        for s, t in zip(corpus.tolist(), target.tolist())], np.int64)


def weights(docs: DataFrame, vocabulary, gains: np.ndarray, *, doc_id: str = "doc_id",
            text: str = "text") -> DataFrame:
    """doc_id, n_words, n_features and weight (the mean gain, rounded down) per row."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def weigh(batches):
        for batch in blocks(batches):
            n_words, n_features, weight = [], [], []
            for raw in texts(batch.column("text")):
                words = features = total = 0
                for n, found in vocabulary.value.of_text(raw):
                    words, features = words + n, features + len(found)
                    total += int(gains[found].sum()) if found else 0
                n_words.append(words)
                n_features.append(features)
                weight.append(total // features if features else 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(x, pa.int64()) for x in (n_words, n_features, weight)]],
                names=["doc_id", "n_words", "n_features", "weight"])

    return rows.mapInArrow(weigh, f"doc_id {kind}, n_words long, n_features long, weight long")


def gumbel_draw(doc_id: Column, seed: int) -> Column:
    """Thousandths of a standard Gumbel number keyed by seed and id, rounded down."""
    head = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), doc_id.cast("string")), 256), 1, 8)
    h = F.conv(head, 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def resample(docs: DataFrame, target: DataFrame, *, doc_id: str = "doc_id", text: str = "text",
             target_text: str = "text", buckets: int = BUCKETS, most: int = 1,
             least_words: int = LEAST_WORDS, percent: int = PERCENT, seed: int = SEED) -> DataFrame:
    """Every row's doc_id, n_words, n_features, weight, score and rank: 1, 2, 3 ...
    by falling score for the drawn share of the rows with ``least_words`` words
    or more, else null."""
    vocabulary = docs.sparkSession.sparkContext.broadcast(
        head_vocabulary(docs, text=text, buckets=buckets, most=most))
    gains = bucket_gains(bucket_totals(docs, vocabulary, text=text),
                         bucket_totals(target, vocabulary, text=target_text))
    scored = weights(docs, vocabulary, gains, doc_id=doc_id, text=text).withColumn(
        "score", F.col("weight") + gumbel_draw(F.col("doc_id"), seed))
    # The stored row number tells repeated rows apart in the order.
    scored = materialise(scored.withColumn("_place", F.monotonically_increasing_id()))
    eligible = (F.col("n_words") >= least_words) & F.col("score").isNotNull()
    drawn = percent * scored.where(eligible).count() // 100
    ranked = rank_global(scored.where(eligible), [F.desc("score"), F.asc("doc_id"), F.asc("_place")])
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank").cast("long")))
    rest = scored.where(~eligible).withColumn("rank", F.lit(None).cast("long"))
    return ranked.unionByName(rest).drop("_place")
