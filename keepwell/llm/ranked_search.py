"""Ranked lexical search with the Best Position Algorithm.

The corpus is searched where it lies: each task turns its documents, block by
block, into impact lists of the queries' terms (documents by falling impact).
For a query all its lists are read from the top in parallel; every document met
is scored in full by direct accesses, which also mark its places in the other
lists. The best position of a list is the end of its gapless marked beginning,
which lies at or beyond the last place read; no document still unseen can score
more than the impacts at the best positions add up to. The search of a block
stops once that bound is strictly below the k-th score the task has so far, so
ties stay exact. Only k rows per query and task are shuffled; corpus statistics
come from a scan before.

The queries go out in blocks of at most QUERY_BYTES of text, one at a time, each
with a stored result of its own; a query longer than that is a block by itself.

Nulls and texts without terms: such documents are never found, such queries have
no results. Ties go to the smaller doc_id (null last); repeated rows are ranked
each by itself. Empty tables: empty result. Extra columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keepwell.llm.textblocks import blocks
from keepwell.llm.wordlists import texts, word_lists
from keepwell.session import materialise

TOP = 10
LENGTH_PERCENT = 75
QUERY_BYTES = 8_000_000
BLOCK_BYTES = 8_000_000
FIRST_READ = 16
_MERGE_GROUPS = 1_000


class Queries:
    """One block of queries: terms with their numbers, and per query its distinct
    term numbers with repeats."""

    def __init__(self, items: list[tuple[object, str | None]]):
        self.ids = [item for item, _ in items]
        self.number: dict[bytes, int] = {}
        self.terms: list[tuple[np.ndarray, np.ndarray]] = []
        for _, text in items:
            held: Counter = Counter()
            for words in word_lists((text or "").encode()):
                held.update(words)
            numbers = [self.number.setdefault(w, len(self.number)) for w in held]
            self.terms.append((np.array(numbers, np.int64), np.array(list(held.values()), np.int64)))


class Statistics:
    """Documents with a term, all terms, and the weight of each query term."""

    def __init__(self, found: dict[int, int], terms: int):
        self.n_docs, self.n_terms = found.get(-1, 0), found.get(-2, 0)
        self.weight = np.array([
            math.floor(1000 * math.log((2 * self.n_docs + 2) / (2 * found.get(k, 0) + 1))) if k in found else 0
            for k in range(terms)], np.int64)


class Postings:
    """Terms of one block of documents: (document, term, times) by document, and
    the length of every document in terms."""

    def __init__(self, column: pa.Array, number: dict[bytes, int]):
        doc, term = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        self.length = np.zeros(len(column), np.int64)
        for d, raw in enumerate(texts(column)):
            for words in word_lists(raw):
                self.length[d] += len(words)
                known = [number[w] for w in words if w in number]
                doc.append(np.full(len(known), d))
                term.append(np.array(known, np.int64))
        n = max(len(number), 1)
        pair, self.times = np.unique(np.concatenate(doc) * n + np.concatenate(term), return_counts=True)
        self.doc, self.term = pair // n, pair % n


class ImpactLists:
    """Impact lists of a block and the places of every document in them."""

    def __init__(self, postings: Postings, stats: Statistics, percent: int):
        used = stats.weight[postings.term] > 0
        self.doc, self.term, times = postings.doc[used], postings.term[used], postings.times[used]
        size = 100 - percent + (percent * postings.length * stats.n_docs) // max(stats.n_terms, 1)
        self.impact = (1_000_000_000 * times) // (1_000 * times + 8 * size[self.doc])
        # Entries are kept by document; a list is a run of entry numbers.
        self.lists = np.lexsort((-self.impact, self.term))
        n = len(stats.weight)
        self.begin = np.searchsorted(self.term[self.lists], np.arange(n + 1))
        self.place = np.empty(len(self.lists), np.int64)
        self.place[self.lists] = np.arange(len(self.lists))
        self.first = np.searchsorted(self.doc, np.arange(len(postings.length) + 1))
        self.cost = np.zeros(n, np.int64)          # what one unit of impact adds, per term

    def _entries(self, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entry numbers of ``docs`` and where each document's begin."""
        count = self.first[docs + 1] - self.first[docs]
        start = np.cumsum(count) - count
        return np.arange(count.sum()) - np.repeat(start - self.first[docs], count), start

    def search(self, terms: np.ndarray, repeats: np.ndarray, weight: np.ndarray, k: int,
               least: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and scores, among them all of the best ``k`` that reach the
        score ``least`` of the k-th document found before."""
        terms, repeats = terms[self.begin[terms + 1] > self.begin[terms]], repeats[
            self.begin[terms + 1] > self.begin[terms]]
        low, high = self.begin[terms], self.begin[terms + 1]
        factor = weight[terms] * repeats
        self.cost[terms] = factor
        best = low.copy()                          # first place not marked
        marked = np.zeros(len(self.lists), bool)
        met = np.zeros(len(self.first) - 1, bool)
        docs_found, scores_found, kth, depth = [], [], least, FIRST_READ
        while (best < high).any():
            read = np.concatenate([self.lists[a:min(a + depth, b)] for a, b in zip(best.tolist(), high.tolist())])
            docs = np.unique(self.doc[read])
            docs = docs[~met[docs]]
            met[docs] = True
            if len(docs):
                entry, start = self._entries(docs)
                gain = self.cost[self.term[entry]]
                scores = np.add.reduceat(gain * self.impact[entry], start)
                marked[self.place[entry[gain > 0]]] = True
                docs_found.append(docs)
                scores_found.append(scores)
                top = np.concatenate(scores_found)
                if len(top) >= k:
                    kth = max(least, int(np.partition(top, len(top) - k)[len(top) - k]))
            for j in range(len(terms)):
                ahead = marked[best[j]:high[j]]
                gap = int(ahead.argmin()) if len(ahead) else 0
                best[j] = high[j] if len(ahead) and ahead[gap] else best[j] + gap
            last = np.where(best < high, self.impact[self.lists[np.maximum(best - 1, low)]], 0)
            if int((factor * last).sum()) < kth:
                break
            depth *= 2
        self.cost[terms] = 0
        if not docs_found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(docs_found), np.concatenate(scores_found)


def query_blocks(items: DataFrame, item_id: str, text: str) -> Iterator[list[tuple]]:
    """The queries in hash blocks of about QUERY_BYTES; one is on the driver at a time."""
    rows = items.select(F.col(item_id).alias("item_id"), F.col(text).cast("string").alias("words"))
    total = rows.agg(F.sum(F.coalesce(F.octet_length("words"), F.lit(0)) + 16)).first()[0] or 0
    count = max(1, math.ceil(total / QUERY_BYTES))
    for k in range(count):
        part = rows if count == 1 else rows.where(
            F.pmod(F.xxhash64("item_id", "words"), F.lit(count)) == k)
        held = [(r["item_id"], r["words"]) for r in part.collect()]
        if held:
            yield held


def _statistics(rows: DataFrame, queries) -> Statistics:
    """One scan: documents per query term, documents with a term (-1), all terms (-2)."""
    def count(batches):
        number = queries.value.number
        holders, docs, terms = np.zeros(len(number), np.int64), 0, 0
        for batch in blocks(batches, limit=BLOCK_BYTES):
            found = Postings(batch.column("text"), number)
            holders += np.bincount(found.term, minlength=len(number))
            docs += int((found.length > 0).sum())
            terms += int(found.length.sum())
        at = np.flatnonzero(holders)
        yield pa.RecordBatch.from_arrays([pa.array([-1, -2, *at.tolist()], pa.int64()),
                                          pa.array([docs, terms, *holders[at].tolist()], pa.int64())],
                                         names=["term", "n"])

    counted = rows.select("text").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    return Statistics({r.term: r.n for r in counted.collect()}, len(queries.value.number))


def search(docs: DataFrame, items: DataFrame, *, doc_id: str = "doc_id", text: str = "text",
           item_id: str = "item_id", item_text: str = "text", k: int = TOP,
           length_percent: int = LENGTH_PERCENT) -> DataFrame:
    """(item_id, rank, doc_id, score): per query its ``k`` best documents with a
    score above 0, rank from 1 by falling score, equal scores by doc_id."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    ids = [items.select(F.col(item_id)).schema[0].dataType, rows.schema["doc_id"].dataType]
    out = None
    for held in query_blocks(items, item_id, item_text):
        queries = docs.sparkSession.sparkContext.broadcast(Queries(held))
        found = materialise(_search_block(rows, queries, _statistics(rows, queries), ids, k, length_percent))
        queries.destroy()
        out = found if out is None else out.unionByName(found)
    if out is None:
        return docs.sparkSession.createDataFrame([], T.StructType([
            T.StructField("item_id", ids[0]), T.StructField("rank", T.IntegerType()),
            T.StructField("doc_id", ids[1]), T.StructField("score", T.LongType())]))
    return out


def _search_block(rows: DataFrame, queries, stats: Statistics, ids: list[T.DataType], k: int,
                  length_percent: int) -> DataFrame:
    doc_kind = ids[1].simpleString()

    def run(batches):
        asked = queries.value
        top: list[list[tuple]] = [[] for _ in asked.ids]
        kind = None
        for batch in blocks(batches, limit=BLOCK_BYTES):
            kind = batch.schema.field("doc_id").type
            lists = ImpactLists(Postings(batch.column("text"), asked.number), stats, length_percent)
            for q, (terms, repeats) in enumerate(asked.terms):
                least = top[q][-1][0] if len(top[q]) == k else 0
                docs, scores = lists.search(terms, repeats, stats.weight, k, least)
                good = scores >= max(least, 1)
                docs, scores = docs[good], scores[good]
                if len(docs) > k:
                    good = scores >= np.partition(scores, len(scores) - k)[len(scores) - k]
                    docs, scores = docs[good], scores[good]
                if len(docs):
                    names = batch.column("doc_id").take(pa.array(docs)).to_pylist()
                    top[q] = sorted([*top[q], *zip(scores.tolist(), names)],
                                    key=lambda r: (-r[0], r[1] is None, r[1]))[:k]
        if kind is not None:
            which = [q for q, found in enumerate(top) for _ in found]
            pairs = [pair for found in top for pair in found]
            yield pa.RecordBatch.from_arrays([
                pa.array(which, pa.int32()), pa.array([p[1] for p in pairs], kind),
                pa.array([p[0] for p in pairs], pa.int64())], names=["query", "doc_id", "score"])

    found = rows.mapInArrow(run, f"query int, doc_id {doc_kind}, score long")
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    # Two steps, so that no task gets the rows of all tasks for one query.
    found = found.withColumn("_part", F.spark_partition_id() % _MERGE_GROUPS)
    for keys in (["query", "_part"], ["query"]):
        found = found.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(
            F.col("rank") <= k)
    names = rows.sparkSession.createDataFrame(
        list(enumerate(queries.value.ids)), T.StructType([
            T.StructField("query", T.IntegerType()), T.StructField("item_id", ids[0])]))
    return found.join(F.broadcast(names), "query").select("item_id", "rank", "doc_id", "score")
