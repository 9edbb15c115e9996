"""Benchmark decontamination with training suffix arrays.

Each block of training documents is a shard. A shard's suffix array holds the
word suffixes in one fixed order of the 64-bit word hashes; only suffixes whose
first two words start some test suffix are kept, the others can never be found.
Every test suffix is binary-searched for its first ``window`` words, and each
occurrence is extended to its longest verbatim match. The test side is read in
blocks of bounded size. Up to one block, documents are read once and never
shuffled; with more, they are stored with row numbers and each block is a scan of
its own with a small result, so one block is in memory anywhere at a time.

Nulls and texts without words: no match, a row all the same. Ties and repeated
rows: every occurrence counts, each row by itself. Empty tables: empty result, or
no hits. Extra columns of the inputs are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keepwell.llm.sides import checked
from keepwell.llm.textblocks import (
    LETTER_OR_DIGIT, blocks, text_bytes, window_hashes, words,
)
from keepwell.session import materialise

WINDOW = 10
BENCHMARK_BLOCK_BYTES = 8_000_000


class BenchmarkSide:
    """All windows of one block of test items, as word-hash rows.

    A window has ``window`` words, or is a whole shorter item; ``need`` is its
    length, ``suffix`` the item's remaining word hashes from its start.
    """

    def __init__(self, items: list[tuple[str, str]], window: int):
        texts = pa.array([text or "" for _, text in items], pa.string())
        found = words(*text_bytes(texts), LETTER_OR_DIGIT)
        self.hash, item, start = found.hash, [], []
        for k in range(len(items)):
            first, end = int(found.first[k]), int(found.first[k + 1])
            for at in range(first, max(end - window + 1, min(first + 1, end))):
                item.append(k)
                start.append(at)
        self.names = [str(name) for name, _ in items]
        self.item = np.array(item, np.int64)
        self.start = np.array(start, np.int64)
        self.first = found.first[:-1][self.item]
        self.end = found.first[1:][self.item]
        self.need = np.minimum(window, self.end - self.start)
        self.pad = np.concatenate([self.hash, np.zeros(window, np.uint64)])
        two = self.need >= 2
        self.pairs = np.unique(window_hashes(self.pad, 2)[self.start[two]])
        self.single = np.unique(self.hash[self.start[~two]])
        self.window = window


def _member(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(known, values), len(known) - 1)
    return known[at] == values


class Shard:
    """The suffix array of one block of training documents."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, tests: BenchmarkSide):
        found = words(data, offsets, LETTER_OR_DIGIT)
        self.first, self.hash = found.first, found.hash
        n = len(self.hash)
        self.doc = found.doc
        self.doc_end = self.first[1:][self.doc] if n else np.zeros(0, np.int64)
        self.pad = np.concatenate([self.hash, np.zeros(tests.window, np.uint64)])
        start = _member(window_hashes(self.pad, 2)[:n], tests.pairs) if n else np.zeros(0, bool)
        start |= _member(self.hash, tests.single)
        at = np.flatnonzero(start)
        keys = [self._word(at, k) for k in range(tests.window)]
        self.suffixes = at[np.lexsort(keys[::-1])] if len(at) else at

    def _word(self, at: np.ndarray, k: int) -> np.ndarray:
        """The k-th word of each suffix, 0 beyond its document."""
        return np.where(at + k < self.doc_end[at], self.pad[at + k], np.uint64(0))

    def _bound(self, tests: BenchmarkSide, right: bool) -> np.ndarray:
        """Binary search of all test suffixes at once by their first words."""
        low = np.zeros(len(tests.start), np.int64)
        high = np.full(len(tests.start), len(self.suffixes), np.int64)
        while True:
            live = np.flatnonzero(low < high)
            if not len(live):
                return low
            mid = (low[live] + high[live]) // 2
            suffix = self.suffixes[mid]
            less, same = np.zeros(len(live), bool), np.ones(len(live), bool)
            for k in range(tests.window):
                mine = self._word(suffix, k)
                theirs = tests.pad[tests.start[live] + k]
                ask = same & (k < tests.need[live])
                less |= ask & (mine < theirs)
                same &= ~ask | (mine == theirs)
            up = less | (same if right else False)
            low[live[up]] = mid[up] + 1
            high[live[~up]] = mid[~up]

    def matches(self, tests: BenchmarkSide) -> tuple[np.ndarray, np.ndarray]:
        """(window number, word position) of every occurrence."""
        if not len(self.suffixes) or not len(tests.start):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        low, high = self._bound(tests, False), self._bound(tests, True)
        count = high - low
        window = np.repeat(np.arange(len(count)), count)
        rank = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        return window, self.suffixes[low[window] + rank]

    def lengths(self, tests: BenchmarkSide, window: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Words in the longest verbatim match from each occurrence on."""
        length = tests.need[window].copy()
        live = np.arange(len(window))
        while len(live):
            mine, theirs = at[live] + length[live], tests.start[window[live]] + length[live]
            more = (mine < self.doc_end[at[live]]) & (theirs < tests.end[window[live]])
            live, mine, theirs = live[more], mine[more], theirs[more]
            live = live[self.hash[mine] == tests.hash[theirs]]
            length[live] += 1
        return length


def benchmark_blocks(benchmark: DataFrame, item_id: str, text: str,
                limit: int = BENCHMARK_BLOCK_BYTES) -> Iterator[tuple[list[tuple[str, str]], bool]]:
    """The test items in hash blocks of about ``limit`` bytes, each with a mark
    for the last; one block is on the driver at a time."""
    rows = benchmark.select(F.col(item_id).cast("string").alias("name"),
                            F.col(text).cast("string").alias("words"))
    total = rows.agg(F.sum(F.coalesce(F.octet_length("words"), F.lit(0)) + 16)).first()[0] or 0
    count = max(1, math.ceil(total / limit))
    for k in range(count):
        part = rows if count == 1 else rows.where(
            F.pmod(F.xxhash64("name", "words"), F.lit(count)) == k)
        items = [(r["name"] or "", r["words"]) for r in part.collect()]
        yield sorted(items, key=lambda r: (r[0], r[1] or "")), k == count - 1


def longest_matches(docs: DataFrame, benchmark: DataFrame, *, doc_id: str = "doc_id",
                    text: str = "text", item_id: str = "item_id", item_text: str = "text",
                    window: int = WINDOW) -> DataFrame:
    """(doc_id, item_id, doc_word, item_word, n_words): every place where a test
    suffix of at least ``window`` words (or a whole shorter item) occurs in a
    document, with the longest verbatim match from there."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    out = None
    for items, last in benchmark_blocks(benchmark, item_id, item_text):
        shared = docs.sparkSession.sparkContext.broadcast(items)

        def find(batches, shared=shared):
            tests = BenchmarkSide(shared.value, window)
            for batch in blocks(batches):
                shard = Shard(*text_bytes(batch.column("text")), tests)
                which, at = shard.matches(tests)
                doc = shard.doc[at]
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").take(pa.array(doc, pa.int64())),
                    pa.array([tests.names[k] for k in tests.item[which]], pa.string()),
                    pa.array(at - shard.first[doc], pa.int64()),
                    pa.array(tests.start[which] - tests.first[which], pa.int64()),
                    pa.array(shard.lengths(tests, which, at), pa.int64()),
                ], names=["doc_id", "item_id", "doc_word", "item_word", "n_words"])

        part = rows.mapInArrow(
            find, f"doc_id {kind}, item_id string, doc_word long, item_word long, n_words long")
        if out is None and last:
            return part
        part = materialise(part)
        shared.destroy()
        out = part if out is None else out.unionByName(part)
    return out


def _found_in(batch: pa.RecordBatch, text: str, tests: BenchmarkSide):
    """The shard of a batch and its (window, word position) matches."""
    shard = Shard(*text_bytes(batch.column(text)), tests)
    return shard, *shard.matches(tests)


_FOUND = "n_words long, spans array<long>, items array<string>, longest long"


def _scan_block(batch: pa.RecordBatch, name: str, tests: BenchmarkSide, all_rows: bool) -> pa.RecordBatch:
    """Per document, or per document with a match: its number of words, hit spans,
    items and longest match. A span is first word << 32 | words; spans are disjoint
    and sorted, null without a match."""
    shard, which, at = _found_in(batch, "text", tests)
    edge = np.zeros(len(shard.hash) + 1, np.int64)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + tests.need[which], -1)
    hit = np.cumsum(edge[:-1]) > 0
    doc = shard.doc[at]
    longest = np.zeros(batch.num_rows, np.int64)
    np.maximum.at(longest, doc, shard.lengths(tests, which, at))
    held: dict[int, set[str]] = {}
    for d, k in np.unique(np.stack([doc, tests.item[which]], axis=1), axis=0).tolist():
        held.setdefault(d, set()).add(tests.names[k])
    rows = range(batch.num_rows) if all_rows else sorted(held)
    spans, items = [], []
    for d in rows:
        if d not in held:
            spans.append(None)
            items.append(None)
            continue
        step = np.diff(hit[shard.first[d]:shard.first[d + 1]].astype(np.int8), prepend=0, append=0)
        first, end = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
        spans.append(((first << 32) | (end - first)).tolist())
        items.append(sorted(held[d]))
    picked = np.array(rows, np.int64)
    return pa.RecordBatch.from_arrays([
        batch.column(name).take(pa.array(picked)), pa.array(np.diff(shard.first)[picked]),
        pa.array(spans, pa.list_(pa.int64())), pa.array(items, pa.list_(pa.string())), pa.array(longest[picked]),
    ], names=[name, "n_words", "spans", "items", "longest"])


def _scan(rows: DataFrame, name: str, items: list[tuple[str, str]], window: int, all_rows: bool):
    """(found per row of ``rows`` by its column ``name``, the broadcast it needs)."""
    shared = rows.sparkSession.sparkContext.broadcast(items)
    kind = rows.schema[name].dataType.simpleString()

    def scan(batches):
        tests = BenchmarkSide(shared.value, window)
        for batch in blocks(batches):
            yield _scan_block(batch, name, tests, all_rows)

    return rows.select(name, "text").mapInArrow(scan, f"{name} {kind}, {_FOUND}"), shared


def _hit_words(spans: Column) -> Column:
    """Words in spans sorted by their first, overlaps counted once."""
    def add(total, span):
        first, end = F.shiftright(span, 32), F.shiftright(span, 32) + span.bitwiseAND(F.lit(0xFFFFFFFF))
        more = F.greatest(end - F.greatest(first, total["end"]), F.lit(0))
        return F.struct(F.greatest(end, total["end"]).alias("end"), (total["n"] + more).alias("n"))

    zero = F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("n"))
    return F.aggregate(F.coalesce(spans, F.array().cast("array<long>")), zero, add, lambda total: total["n"])


def _later_hits(rows: DataFrame, later: Iterator, window: int) -> DataFrame | None:
    """What all further test blocks find in the stored ``rows``, by ``_key``: an
    action and a small table per block, whose broadcast goes when it is done."""
    out = None
    for items, _ in later:
        found, shared = _scan(rows, "_key", items, window, False)
        found = materialise(found)
        shared.destroy()
        out = found if out is None else out.unionByName(found)
    return out


def contamination(docs: DataFrame, benchmark: DataFrame, *, doc_id: str = "doc_id",
                  text: str = "text", item_id: str = "item_id", item_text: str = "text",
                  window: int = WINDOW) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit (words inside any window
    found), items (ids as strings, sorted), longest_match (words of the longest
    verbatim match) and contaminated."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    tests = benchmark_blocks(benchmark, item_id, item_text)
    items, last = next(tests)
    if last:
        found, _ = _scan(rows, "doc_id", items, window, True)
    else:
        rows = materialise(rows.withColumn("_key", F.monotonically_increasing_id()))
        first, shared = _scan(rows, "_key", items, window, True)
        first = materialise(first)
        shared.destroy()
        more = _later_hits(rows, tests, window).unionByName(first.where("spans IS NOT NULL"))
        more = more.groupBy("_key").agg(
            F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
            F.max("longest").alias("longest"))
        found = rows.select("_key", "doc_id").join(first.select("_key", "n_words"), "_key").join(
            more, "_key", "left")
    return found.select(
        "doc_id", "n_words", _hit_words(F.col("spans")).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.coalesce("longest", F.lit(0)).cast("long").alias("longest_match"),
        F.col("spans").isNotNull().alias("contaminated"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, *, text: str = "text",
                  item_id: str = "item_id", item_text: str = "text",
                  window: int = WINDOW) -> DataFrame:
    """``docs`` without the documents that hold any test window; same columns. With
    one test block each row goes to a worker once and is let through or not."""
    tests = benchmark_blocks(benchmark, item_id, item_text)
    items, last = next(tests)
    if last:
        shared = docs.sparkSession.sparkContext.broadcast(items)

        def keep(batches):
            side = BenchmarkSide(shared.value, window)
            for batch in blocks(batches, text):
                shard, _, at = _found_in(batch, text, side)
                hit = np.zeros(batch.num_rows, bool)
                hit[shard.doc[at]] = True
                yield batch.filter(pa.array(~hit))

        return docs.mapInArrow(keep, docs.schema)
    stored = materialise(docs.withColumn("_key", F.monotonically_increasing_id()))
    rows = stored.select("_key", F.col(text).cast("string").alias("text"))
    found, shared = _scan(rows, "_key", items, window, False)
    found = materialise(found)
    shared.destroy()
    hit = materialise(_later_hits(rows, tests, window).unionByName(found).select("_key").distinct())
    return stored.join(checked(hit), "_key", "left_anti").select(*docs.columns)
