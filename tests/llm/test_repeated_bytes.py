"""Removal of repeated byte strings against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from keepwell.llm import repeated_bytes
from keepwell.llm.lyndon_suffixes import suffix_array
from keepwell.llm.queries import op11_lyndon_suffix_groups
from tests.llm.cases import awkward, documents, prose


@pytest.mark.parametrize("kinds", [1, 2, 3, 9])
def test_suffix_array_is_the_order_of_the_suffixes(kinds):
    rng = random.Random(kinds)
    for _ in range(400):
        values = [rng.randrange(kinds) for _ in range(rng.randrange(40))]
        assert suffix_array(values) == sorted(range(len(values)), key=lambda i: values[i:])


def test_suffix_array_of_deep_texts():
    short, long = [1], [1, 0]
    while len(long) < 2_000:
        short, long = long, long + short
    for values in (long, [1] * 2_000, list(range(2_000)), list(range(2_000))[::-1]):
        assert suffix_array(values) == sorted(range(len(values)), key=lambda i: values[i:])


def brute(rows, size):
    """doc -> (bytes, removed, spans, digest) per row, by counting every string."""
    raw = [(text or "").encode() for _, text in rows]
    times = Counter(t[k:k + size] for t in raw for k in range(len(t) - size + 1))
    out = []
    for (doc, _), t in zip(rows, raw):
        gone = bytearray(len(t))
        for k in range(len(t) - size + 1):
            if times[t[k:k + size]] > 1:
                gone[k:k + size] = b"\1" * size
        spans = sum(1 for k, x in enumerate(gone) if x and not (k and gone[k - 1]))
        kept = bytes(b for b, x in zip(t, gone) if not x)
        out.append((doc, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return Counter(out)


def found(df):
    return Counter((r.doc_id, r.n_bytes, r.n_removed, len(r.spans), r.kept_sha256) for r in df.collect())


def planted():
    rng = random.Random(5)
    passage, other = prose(70, 60), prose(71, 40)
    rows = [(k, prose(100 + k, 30) + passage[rng.randrange(20):len(passage) - rng.randrange(20)] + prose(200 + k, 30))
            for k in range(40)]
    rows += [(50, other + "x" + other), (51, other[5:]), (52, "ab" * 900), (53, "ba" * 450 + "c"), (54, "é" * 300),
             (55, "z" * 5_000), (None, passage), (56, passage)]
    return rows


@pytest.mark.parametrize("most_classes", [4_096, 3])
def test_removed_bytes_equal_brute_force(spark, most_classes):
    rows = planted()
    df = documents(spark, rows + [rows[0]])
    out = repeated_bytes.remove_repeats(df, size=100, gram=40, most_classes=most_classes)
    assert found(out) == brute(rows + [rows[0]], 100)


def test_awkward_texts_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(repeated_bytes, "BLOCK_BYTES", 3_000)
    rows = awkward()
    out = repeated_bytes.remove_repeats(documents(spark, rows), size=200, gram=60)
    assert found(out) == brute(rows, 200)
    for r in out.collect():
        if r.kept is not None:
            text = dict(rows)[r.doc_id].encode()
            edges = [0, *[x for s in r.spans for x in (s.low, s.high)], len(text)]
            assert bytes(r.kept) == b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))
    assert repeated_bytes.remove_repeats(documents(spark, rows).limit(0)).count() == 0


def test_query_equals_brute_force(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    out = op11_lyndon_suffix_groups(spark, sf).collect()
    assert Counter(map(tuple, out)) == brute(rows, 400)


def test_order_and_lengths_of_one_array():
    rng = np.random.default_rng(3)
    texts = [bytes(rng.integers(97, 99, 300, dtype=np.uint8)) for _ in range(6)]
    texts += [texts[0][50:250] + b"q" * 40, texts[1][:260]]
    array = repeated_bytes.SegmentArray(texts, np.array([len(t) - 79 for t in texts]), np.ones(len(texts), np.int64), 80)
    data = array.data.tobytes()
    places = array.places[array.order].tolist()
    owner = np.searchsorted(array.begin, array.places[array.order], "right") - 1
    ends = [int(array.begin[k]) + len(texts[k]) for k in owner]
    suffixes = [data[p:e] + b"\xff" * 40 for p, e in zip(places, ends)]
    assert suffixes == sorted(suffixes)
    times = Counter(t[k:k + 80] for t in texts for k in range(len(t) - 79))
    want = [times[t[k:k + 80]] > 1 for t in texts for k in range(len(t) - 79)]
    assert array.repeated().tolist() == want and any(want) and not all(want)
