"""Importance resampling and ranked search against plain Python."""

import hashlib
import math
import random
from collections import Counter, defaultdict
from zlib import crc32

import pytest

from keepwell.llm import ranked_search, resampling, wordlists
from tests.llm.cases import ALNUM, awkward, documents, lower, prose


def terms(text):
    return ALNUM.findall(lower(text))


@pytest.fixture
def small_pieces(monkeypatch):
    monkeypatch.setattr(wordlists, "PIECE_BYTES", 70)


def test_word_lists_equal_the_pattern(small_pieces):
    for _, text in awkward():
        found = [w.decode() for words in wordlists.word_lists((text or "").encode()) for w in words]
        assert found == terms(text)


# --- resampling -----------------------------------------------------------------

def runs(text, most):
    w = terms(text)
    return [" ".join(w[k:k + size]) for size in range(1, most + 1) for k in range(len(w) - size + 1)]


def plain_resample(rows, target, buckets, most, least, percent, seed):
    def bucket(feature):
        return crc32(feature.encode()) % buckets
    s = Counter(bucket(f) for _, t in rows for f in runs(t, most))
    t = Counter(bucket(f) for x in target for f in runs(x, most))
    all_s, all_t = sum(s.values()), sum(t.values())
    out = []
    for doc, text in rows:
        found = [bucket(f) for f in runs(text, most)]
        gains = [math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets)))) for b in found]
        weight = sum(gains) // len(gains) if gains else 0
        score = None
        if doc is not None:
            h = int(hashlib.sha256(f"{seed}:{doc}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append((doc, len(terms(text)), len(found), weight, score))
    able = sorted((r for r in out if r[1] >= least and r[4] is not None), key=lambda r: (-r[4], r[0]))
    drawn = percent * len(able) // 100
    ranks = defaultdict(list)
    for k, r in enumerate(able, 1):
        ranks[r].append(k if k <= drawn else None)
    return Counter((*r, ranks[r].pop() if ranks[r] else None) for r in out)


@pytest.mark.parametrize("most", [1, 2, 3])
def test_resampling_equals_plain_python(spark, small_pieces, monkeypatch, most):
    monkeypatch.setattr(resampling, "HEAD", 7)
    rng = random.Random(most)
    rows = awkward() + [(100 + k, prose(k, rng.randrange(60), 90)) for k in range(60)] + [(None, prose(3, 50))]
    target = [prose(900 + k, 30, 60) for k in range(5)] + [None, "", "Only here"]
    out = resampling.resample(
        documents(spark, rows), spark.createDataFrame([(t, "x") for t in target], "text string, bucket string"),
        buckets=97, most=most, least_words=15, percent=30, seed=5).collect()
    found = Counter((r.doc_id, r.n_words, r.n_features, r.weight, r.score, r["rank"]) for r in out)
    assert found == plain_resample(rows, target, 97, most, 15, 30, 5)
    ranked = [r["rank"] for r in out if r["rank"]]
    assert sorted(ranked) == list(range(1, len(ranked) + 1)) and ranked


def test_resampling_of_empty_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    one = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    assert resampling.resample(empty, one).count() == 0
    assert resampling.resample(one, empty, least_words=1, percent=100).first()["rank"] == 1


# --- ranked search ----------------------------------------------------------------

def plain_search(rows, items, k, share):
    held = [(doc, Counter(terms(t))) for doc, t in rows]
    sizes = [sum(c.values()) for _, c in held]
    n, total = sum(1 for x in sizes if x), sum(sizes)
    df = Counter(w for _, c in held for w in c)
    out = []
    for item, text in items:
        scores = []
        for (doc, c), size in zip(held, sizes):
            m = 100 - share + (share * size * n) // max(total, 1)
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[w] + 1)))
                        * ((1_000_000_000 * c[w]) // (1_000 * c[w] + 8 * m)) for w in terms(text) if w in c)
            if score > 0:
                scores.append((-score, doc is None, doc))
        scores.sort()
        out += [(item, rank, doc, -score) for rank, (score, _, doc) in enumerate(scores[:k], 1)]
    return Counter(out)


@pytest.mark.parametrize("block,first", [(8_000_000, 16), (3_000, 1)])
def test_search_equals_plain_python(spark, small_pieces, monkeypatch, block, first):
    monkeypatch.setattr(ranked_search, "BLOCK_BYTES", block)
    monkeypatch.setattr(ranked_search, "FIRST_READ", first)
    monkeypatch.setattr(ranked_search, "QUERY_BYTES", 900)
    rows = awkward() + [(100 + k, prose(k % 40, 80, 60)) for k in range(150)] + [(None, prose(3, 50))]
    items = [(k, prose(500 + k, 12, 60)) for k in range(12)] + [
        (50, None), (51, ""), (52, "absent"), (53, prose(1, 25) + " w001 w001"), (54, "word"), (54, "word"), (None, "日本語 WORD")]
    df = spark.createDataFrame([(*r, 1, "x") for r in items], "item_id long, text string, rank int, query string")
    out = ranked_search.search(documents(spark, rows), df, k=5)
    assert Counter((r.item_id, r["rank"], r.doc_id, r.score) for r in out.collect()) == plain_search(rows, items, 5, 75)


def test_search_stops_before_the_lists_end():
    """A few good documents and a long tail: the tail is never scored."""
    queries = ranked_search.Queries([(1, "alpha beta")])
    texts = ["alpha beta " * 5] * 12 + ["alpha " + "filler " * 400] * 3_000 + ["beta " + "filler " * 400] * 3_000
    column = ranked_search.pa.array(texts)
    stats = ranked_search.Statistics({-1: len(texts), -2: sum(len(t.split()) for t in texts), 0: 3_012, 1: 3_012}, 2)
    lists = ranked_search.ImpactLists(ranked_search.Postings(column, queries.number), stats, 75)
    docs, scores = lists.search(*queries.terms[0], stats.weight, 10, 0)
    assert len(docs) < 200 and sorted(docs[scores == scores.max()].tolist()) == list(range(12))
    ties, _ = lists.search(*queries.terms[0], stats.weight, 10, int(scores.max()) + 1)
    assert len(ties) < 200


def test_search_of_empty_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert ranked_search.search(empty, items).count() == 0
    docs = spark.createDataFrame([("d", "a b c")], "doc_id string, text string")
    assert ranked_search.search(docs, items.limit(0)).columns == ["item_id", "rank", "doc_id", "score"]
    assert ranked_search.search(docs, items.limit(0)).count() == 0
