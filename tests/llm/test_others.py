"""Embeddings, archives, components, the pipeline and the registration."""

import gzip
import hashlib
import io
import random
import re

import numpy as np
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from keepwell.llm import queries, rotation_codes, warc_merge
from keepwell.llm.components import components
from tests.llm.cases import groups, prose
from tests.llm.test_documents import gone_lines, hits, shingles, similar


# --- components -----------------------------------------------------------------

@pytest.mark.parametrize("seed", range(3))
def test_components_equal_brute_force(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(80), rng.randrange(80)) for _ in range(60)] + [(200 + k, 201 + k) for k in range(30)]
    edges += [(300, 300 + k) for k in range(1, 40)] + [(5, 5), edges[0]]
    df = spark.createDataFrame(edges + [(None, 3), (4, None)], "a long, b long")
    pairs = {tuple(sorted(e)) for e in edges}
    want = groups(sorted({i for e in edges for i in e}), lambda i, j: (i, j) in pairs)
    got = {r.node: r.component for r in components(df).collect()}
    assert all(want[i] == c for i, c in got.items())
    assert set(got) == {i for a, b in edges if a != b for i in (a, b)}
    assert components(df.limit(0)).count() == 0


# --- 3: embeddings -----------------------------------------------------------------

def test_near_vectors_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    base = rng.standard_normal((30, 24))
    rows = []
    for k in range(200):
        v = base[rng.integers(30)] + rng.standard_normal(24) * rng.choice([0.0, 0.05, 0.15, 0.25])
        rows.append((k, [float(x) for x in np.float32(v)], int(k % 3)))
    rows += [(300, rows[0][1], rows[0][2]), (301, [2 * x for x in rows[0][1]], rows[0][2]), (302, None, 1), (303, [], 1),
             (304, [0.0] * 24, 1), (305, [float("nan")] + [1.0] * 23, 1), (306, rows[5][1], None), (307, [1.0, 2.0], 1),
             (308, [1.0, 2.0], 1), (309, [None] + [1.0] * 23, 1), (310, [float("inf")] * 24, 1)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows],
                               "vec_id long, embedding array<float>, label int, first string, copies int")
    out = {r.vec_id: r for r in rotation_codes.near_vectors(df, 0.98).collect()}
    held = {i: (np.array(v, float), lab) for i, v, lab in rows
            if lab is not None and v and None not in v and np.isfinite(v).all() and any(v)}

    def linked(i, j):
        if i not in held or j not in held or held[i][1] != held[j][1] or len(held[i][0]) != len(held[j][0]):
            return False
        x, y = held[i][0], held[j][0]
        return x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.98

    ids = [r[0] for r in rows]
    want = groups(ids, linked)
    assert sorted(out) == ids
    for i in ids:
        assert out[i].n_links == sum(linked(min(i, j), max(i, j)) for j in ids if j != i)
        assert (out[i].component_id, out[i].kept) == (want[i], want[i] == i)
    assert rotation_codes.near_vectors(df.limit(0)).count() == 0


def test_rows_that_share_an_id_count_one_by_one(spark):
    a, b = [1.0, 2.0, 3.0, 4.0], [4.0, -3.0, 2.0, -1.0]
    near_a, near_b = [1.0, 2.0, 3.0, 4.01], [4.0, -3.0, 2.0, -1.01]
    rows = [(1, a, 0), (1, b, 0), (2, near_a, 0), (3, near_b, 0), (1, a, 1), (4, a, 1), (5, a, 2), (5, None, 2), (5, [0.0] * 4, 2)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    out = sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in rotation_codes.near_vectors(df, 0.98).collect())
    assert out == [(1, 1, 1, True)] * 3 + [(2, 1, 1, False), (3, 1, 1, False), (4, 1, 1, False)] + [(5, 0, 5, True)] * 3


def test_estimates_are_unbiased_and_bounded():
    rng = np.random.default_rng(1)
    turn = rotation_codes.rotations(32, 256)
    x, y = rng.standard_normal((4_000, 32)), rng.standard_normal((4_000, 32))
    y = 0.6 * x + 0.8 * y
    u, v = ((m / np.linalg.norm(m, axis=1, keepdims=True)) @ turn.T for m in (x, y))
    u, v = (m / np.linalg.norm(m, axis=1, keepdims=True) for m in (u, v))
    true = (u * v).sum(axis=1)
    factor = np.abs(u).sum(axis=1) / 16
    estimate = (np.sign(u) * v).sum(axis=1) / (16 * factor)
    bound = np.sqrt(1 - factor**2) / factor * rotation_codes.EPSILON / np.sqrt(255)
    assert abs((estimate - true).mean()) < 3e-3 and (np.abs(estimate - true) <= bound).all()


def test_bands_meet_the_miss_rate():
    for n in (2, 10_000, 10**8):
        bits, bands = rotation_codes.plan_bands(n, 0.98)
        same = 1 - np.arccos(0.98) / np.pi
        assert (1 - same**bits)**bands <= rotation_codes.MISS


# --- 10: archives -------------------------------------------------------------------

def pages(spark):
    big = "<p>" + "é\r\n\r\nWARC/1.1\r\n" * 100
    rows = [(1, "http://www.Ex.org/a#x", big), (2, "https://b.example.com/q?x=1", "small"), (3, None, None), (4, "x.org", big),
            (5, "http://ex.org/a", big), (6, "http://b.example.com/q?x=1", "small"), (7, "http://z.org/\n", ""), (None, "n.org", big),
            (8, "http://z.org", "y" * 300_000), (2, "https://b.example.com/q?x=1", "small")]
    return rows, spark.createDataFrame([(*r, "clash", 1) for r in rows],
                                       "page_id long, url string, html string, archive string, offset int")


def test_archives_are_read_back_in_one_order(spark, monkeypatch):
    monkeypatch.setattr(warc_merge, "RECORDS_PER_ARCHIVE", 2)
    rows, df = pages(spark)
    out = warc_merge.archive_pages(df).orderBy("position").collect()
    assert [r.position for r in out] == list(range(len(rows)))
    keys = [(r.url_key, r.captured_at) for r in out]
    assert keys == sorted(keys)
    html = {i: (h or "").encode() for i, _, h in rows}
    for r in out:
        body = html[r.page_id]
        assert (r.payload_bytes, r.payload_digest) == (len(body), hashlib.sha1(body).hexdigest())
        largest = max((i for i, b in html.items() if b == body and i is not None), default=None)
        again = len(body) >= 1_000 and r.page_id is not None and r.page_id != largest
        assert (r.record_type, r.refers_to) == (("revisit", largest) if again else ("response", None))
    assert warc_merge.url_key("http://www.Ex.org/a#x") == "org,ex)/a" and warc_merge.url_key("x.org") == "org,x)/"
    assert warc_merge.archive_pages(df.limit(0)).count() == 0


def test_page_ids_of_any_size(spark):
    ids = [(1 << 62) + 1, -(1 << 62), 0, -1, 10**14]
    big = "<p>" * 400
    df = spark.createDataFrame([(i, f"http://s{k}.org/", big) for k, i in enumerate(ids)], "page_id long, url string, html string")
    out = {r.page_id: r for r in warc_merge.archive_pages(df).collect()}
    assert set(out) == set(ids) and sorted(r.position for r in out.values()) == list(range(len(ids)))
    assert {i for i in ids if out[i].record_type == "response"} == {max(ids)}
    assert out[max(ids)].captured_at.startswith("9999-12-") and out[min(ids)].captured_at.startswith("0001-01-01")
    assert out[-1].captured_at == "2023-12-31T23:59:59Z"


def test_archives_are_valid_records(spark, tmp_path):
    _, df = pages(spark)
    warc_merge.write_archives(warc_merge.classify(df), str(tmp_path / "w"))
    for file in (tmp_path / "w").glob("*.gz"):
        raw = gzip.decompress(file.read_bytes())
        for offset, fields, body in warc_merge.records(io.BytesIO(raw)):
            assert raw[offset:].startswith(b"WARC/1.1\r\nWARC-Type: " + fields["WARC-Type"].encode())
            assert len(body) == int(fields["Content-Length"])


def test_loser_tree_merges_any_number_of_runs():
    rng = random.Random(2)
    for k in (0, 1, 2, 3, 7, 20):
        runs = [sorted((None, "%03d" % rng.randrange(50), "t", f"run{j}", i) for i in range(rng.randrange(9))) for j in range(k)]
        runs = [sorted(r, key=warc_merge._order) for r in runs]
        assert list(warc_merge.LoserTree([iter(r) for r in runs])) == sorted((x for r in runs for x in r), key=warc_merge._order)


# --- registration and pipeline ---------------------------------------------------------

def test_one_query_per_operator():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert set(queries.ORACLES) <= set(queries.QUERIES) and "pipeline" in entry.queries()


def test_pipeline_equals_its_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    counts, now = [docs.count()], docs
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        now = stage(spark, now, sf).persist()
        counts.append(now.count())
        if k < 4:
            assert now.columns == docs.columns
    assert counts == sorted(counts, reverse=True) and counts[-1] == counts[-2] < counts[0]
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted(map(tuple, corpus_pipeline.run(spark, sf).select(*names).collect())) == sorted(
        map(tuple, now.select(*names).collect()))


def test_pipeline_equals_plain_python_after_the_scores(spark, tmp_path):
    passage, leak = prose(90, 40).replace("\n", " "), prose(91, 14).replace("\n", " ")
    good = {k: prose(k, 60) + f"\nown{k} line{k}\n" for k in range(40)}
    near = good[3].replace("\n", " ").split(" ")
    good |= {50: good[1], 51: "Ja\nJa\u00a0\nkurz", 52: "kurz\nJa", 53: passage + "\nfresh words", 54: "lead in\n" + passage,
             55: good[2] + leak, 56: " ".join(near[:30]) + "\nx\ty", 57: " ".join(near[30:]) + "\nx y", 58: "", 59: None}
    # Near copies as documents whose lines differ: cut at other places.
    words = prose(92, 200).replace("\n", " ").split(" ")
    good |= {60: "\n".join(" ".join(words[k:k + 20]) for k in range(0, 200, 20)),
             61: "\n".join(" ".join(words[max(k, 0):k + 20]) for k in range(-10, 200, 20))}
    texts = good | {100 + k: " ".join(w + "$$$" for w in prose(k, 60).split(" ")) for k in range(40)}
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in texts.items()],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, int(i < 100)) for i in texts if i % 100 < 40], "doc_id long, quality int").write.parquet(
        f"{tmp_path}/labels.parquet")
    tests = [(1, leak), (2, None), (3, "nothing of this stands in any text at all today")]
    spark.createDataFrame(tests, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()

    left = {r.doc_id: r.text for r in corpus_pipeline.STAGES[0][1](spark, docs, str(tmp_path)).collect()}
    gone = gone_lines([(i, t and re.sub(r"[^\S\n]", " ", t)) for i, t in left.items()], least=1)
    assert {(52, 0), (52, 1), (54, 1)} <= gone
    for i in {i for i, _ in gone}:
        left[i] = "\n".join(line for k, line in enumerate(left[i].split("\n")) if (i, k) not in gone)
        if not left[i].strip():
            del left[i]
    sets = {i: shingles(t, 5) for i, t in left.items()}
    first = groups(sorted(sets), lambda i, j: similar(sets[i], sets[j], 80))
    left = {i: t for i, t in left.items() if first[i] == i and not hits(t, tests)[1]}
    assert 1 in left and not {50, 52, 55, 61} & set(left)
    plain = Tokenizer.from_file(queries.vocabulary())
    ids = {i: np.array(plain.encode(t or "", add_special_tokens=False).ids, "<u4") for i, t in left.items()}
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in out} == {
        i: (len(x), hashlib.sha256(x.tobytes()).hexdigest(), hashlib.sha256((left[i] or "").encode()).hexdigest())
        for i, x in ids.items()}


def test_no_copy_survives_the_pipeline_stage(spark, sf):
    text = " ".join(f"w{k}" for k in range(40))
    docs = spark.createDataFrame([(1, text, "en", "s", 1), (2, text, "en", "s", 1), (3, text + " more", "en", "s", 1), (4, "other words here", "en", "s", 1)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    left = corpus_pipeline.STAGES[2][1](spark, corpus_pipeline.STAGES[1][1](spark, docs, sf), sf)
    assert sorted(r.doc_id for r in left.collect()) == [1, 4]
