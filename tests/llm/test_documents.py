"""Document operators against brute force on awkward tables."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from keepwell.llm import (
    byte_language, chunked_bpe, hilbert_shards, line_dedup, minhash_groups, stages, subword_quality,
    suffix_matches, surrogates,
)
from keepwell.llm.queries import vocabulary
from tests.llm.cases import ALNUM, SPACED, awkward, documents, groups, lower, prose

EMPTY = []


# --- 1: Hilbert shards --------------------------------------------------------

def hilbert_point(index, bits, n):
    """Cell of a place on the curve, by the inverse transform."""
    x = [0] * n
    for k in range(bits * n):
        if index >> (bits * n - 1 - k) & 1:
            x[k % n] |= 1 << (bits - 1 - k // n)
    t = x[n - 1] >> 1
    for i in range(n - 1, 0, -1):
        x[i] ^= x[i - 1]
    x[0] ^= t
    q = 2
    while q != 1 << bits:
        for i in range(n - 1, -1, -1):
            if x[i] & q:
                x[0] ^= q - 1
            else:
                t = (x[0] ^ x[i]) & (q - 1)
                x[0] ^= t
                x[i] ^= t
        q <<= 1
    return tuple(x)


@pytest.mark.parametrize("n,bits", [(2, 3), (3, 2)])
def test_curve_visits_every_cell_by_unit_steps(spark, n, bits):
    cells = spark.range(1 << (n * bits)).select(*[
        F.shiftright("id", bits * i).bitwiseAND(F.lit((1 << bits) - 1)).cast("int").alias(f"c{i}") for i in range(n)])
    rows = cells.select("*", hilbert_shards.hilbert_index([F.col(c) for c in cells.columns], bits).alias("h")).collect()
    order = sorted(rows, key=lambda r: r.h)
    assert [r.h for r in order] == list(range(1 << (n * bits)))
    for a, b in zip(order, order[1:]):
        assert sum(abs(a[i] - b[i]) for i in range(n)) == 1
    assert [tuple(r[:n]) for r in order] == [hilbert_point(k, bits, n) for k in range(len(order))]


@pytest.mark.parametrize("law", ["rows", "bytes"])
def test_shards_follow_their_law(spark, law):
    rows = [(k, None if k % 17 == 0 else "t" * (k % 60), None if k % 5 == 0 else f"s{k % 3}", k % 90) for k in range(401)]
    docs = spark.createDataFrame(rows + rows[:3], "doc_id long, text string, source string, size long")
    dims = {"source": hilbert_shards.TEXT, "size": hilbert_shards.NUMBER}
    out = hilbert_shards.shard(docs, dims, 7, law=law).collect()
    assert Counter(r.doc_id for r in out) == Counter(r[0] for r in rows + rows[:3])
    sizes = Counter(r.shard for r in out)
    for s in sizes:
        assert sorted(r.slot for r in out if r.shard == s) == list(range(sizes[s]))
    texts = {r[0]: (r[1] or "").encode() for r in rows}
    assert all(r["size"] == len(texts[r.doc_id]) + 16 and r.text_crc32 == zlib.crc32(texts[r.doc_id]) for r in out)
    if law == "rows":
        assert max(sizes.values()) - min(sizes.values()) <= 1
    else:
        held = Counter()
        for r in out:
            held[r.shard] += r["size"]
        assert max(held.values()) - min(held.values()) <= 2 * max(r["size"] for r in out)
    ranges = hilbert_shards.shard_ranges(hilbert_shards.shard(docs, dims, 7, law=law)).collect()
    assert sum(r["rows"] for r in ranges) == len(out)


def test_no_rows_no_shards(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string, size long")
    dims = {"source": hilbert_shards.TEXT, "size": hilbert_shards.NUMBER}
    assert hilbert_shards.shard(docs, dims, 7).count() == hilbert_shards.shard(docs, dims, 7, law="bytes").count() == 0


# --- 2: MinHash groups --------------------------------------------------------

def shingles(text, size):
    w = SPACED.findall(lower(text))
    return {tuple(w[k:k + size]) for k in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set()


def similar(x, y, percent):
    return bool(x & y) and 100 * len(x & y) >= percent * len(x | y)


def family(n, edits, seed):
    """Copies of one text with a few words replaced each, some too many."""
    rng = random.Random(seed)
    base = prose(seed, 100).split(" ")
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rng.choice(edits)):
            w[rng.randrange(len(w))] = "e%d" % rng.randrange(10**6)
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("size,percent,bands,rows", [(3, 85, 32, 6), (5, 80, 40, 5)])
def test_minhash_groups_equal_brute_force(spark, monkeypatch, size, percent, bands, rows):
    monkeypatch.setattr(minhash_groups, "BLOCK_SHINGLES", 2_000)     # several blocks
    table = awkward() + [(100 + k, t) for k, t in enumerate(family(60, (0, 1, 3, 6, 9), 5))]
    out = minhash_groups.near_duplicates(documents(spark, table), size=size, percent=percent, bands=bands, rows=rows).collect()
    texts = dict(table)
    sets = {i: shingles(t, size) for i, t in texts.items()}
    want = groups(sorted(sets), lambda i, j: similar(sets[i], sets[j], percent))
    assert Counter(r.doc_id for r in out) == Counter(i for i, _ in table)
    for r in out:
        assert (r.n_shingles, r.component_id, r.kept) == (len(sets[r.doc_id]), want[r.doc_id], want[r.doc_id] == r.doc_id)


def test_minhash_keeps_one_and_null_ids(spark):
    docs = documents(spark, [(5, "a b c d e f"), (3, "a b c d e f"), (None, "a b c d e f"), (None, None), (9, None)])
    out = minhash_groups.keep_one(docs, size=3, percent=85)
    assert out.columns == docs.columns
    assert sorted((r.doc_id or 0) for r in out.collect()) == [0, 0, 3, 9]
    assert minhash_groups.near_duplicates(documents(spark, EMPTY), size=3, percent=85).count() == 0


# --- 4: language ----------------------------------------------------------------

def spoken(lang, seed, n=60):
    sounds = {"aa": ["la", "mo", "ri"], "bb": ["sch", "ung", "ei"], "cc": ["ñe", "zo", "ul"]}[lang]
    rng = random.Random(seed)
    return " ".join("".join(rng.choice(sounds) for _ in range(rng.randint(1, 4))) for _ in range(n))


def test_language_is_learned_and_undetermined_is_said(spark):
    rows = [(k, spoken(("aa", "bb", "cc")[k % 3], k), ("aa", "bb", "cc")[k % 3]) for k in range(240)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    settings = byte_language.Settings(units=6, epochs=6, windows=60, batch=32)
    net = byte_language.fit(docs.where("doc_id < 180"), settings=settings)
    test = spark.createDataFrame(
        [r[:2] for r in rows[180:]] + [(1, None), (2, ""), (3, "123 !?"), (4, "x"), (4, "x"), (5, spoken("bb", 7, 9_000))],
        "doc_id long, text string").withColumn("score", F.lit("clash"))
    out = byte_language.predict(test, net).collect()
    assert len(out) == test.count() and all(0 <= r.score <= 1 for r in out)
    found = {r.doc_id: r.lang_pred for r in out}
    assert sum(found[i] == lang for i, _, lang in rows[180:]) >= 58
    assert found[1] == found[2] == found[3] == "und" and found[4] != "und" and found[5] == "bb"
    runs = byte_language.label_runs(test, net).where("doc_id >= 180").collect()
    assert sum(r.bytes for r in runs) == sum(len(t.encode()) for _, t, _ in rows[180:])
    assert byte_language.predict(test.limit(0), net).count() == 0
    with pytest.raises(ValueError):
        byte_language.fit(docs.where("false"))


def test_no_language_is_left_out(spark, monkeypatch):
    rows = [(k, spoken("aa", k, 9), f"l{k % 7}") for k in range(350)] + [(999, spoken("bb", 1, 9), "rare")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    drawn = Counter()
    fit_windows = byte_language.fit_windows

    def counted(texts, languages, settings):
        drawn.update(languages)
        return fit_windows(texts, languages, settings)

    monkeypatch.setattr(byte_language, "fit_windows", counted)
    net = byte_language.fit(docs, settings=byte_language.Settings(units=2, epochs=1, windows=20, most_rows=40))
    assert net.languages == [f"l{k}" for k in range(7)] + ["rare"]
    assert drawn == {**{f"l{k}": 5 for k in range(7)}, "rare": 1}


def test_gradients_match_differences():
    rng = np.random.default_rng(0)
    net = byte_language.Network(["a", "b"], rng.normal(0, .3, (2, 6, 256)), rng.normal(0, .3, (2, 6, 2)),
                                rng.normal(0, 1, (2, 4)), rng.normal(0, 1, (2, 1)))
    net.table[:, :4] += 0.5
    data = rng.integers(97, 103, (5, 3)).astype(np.uint8)
    valid = np.arange(5)[:, None] < np.array([5, 3, 4])
    target, weight = np.array([0, 1, 1]), np.array([1.0, 2.0, 0.5])

    def loss():
        z = (net.out @ net.states(data).reshape(4, -1) + net.bias).reshape(2, 5, 3)
        p = np.exp(z - z.max(axis=0))
        p /= p.sum(axis=0)
        return -(np.log(p[target, :, np.arange(3)]).T * valid * weight).sum() / valid.sum()

    slopes = byte_language._slopes(net, data, valid, target, weight)
    for part, slope in zip(("table", "turn", "out", "bias"), slopes):
        values = getattr(net, part)
        for at in [np.unravel_index(np.abs(slope).argmax(), slope.shape)]:
            kept = values[at]
            values[at] = kept + 1e-6
            up = loss()
            values[at] = kept - 1e-6
            down = loss()
            values[at] = kept
            assert slope[at] == pytest.approx((up - down) / 2e-6, rel=1e-4)


# --- 5: BPE -----------------------------------------------------------------------

def test_encoding_is_the_tokenizers_own(spark, monkeypatch):
    monkeypatch.setattr(chunked_bpe, "LEAST_CHUNK", 8)
    monkeypatch.setattr(chunked_bpe, "CUT_BITS", 4)
    rng = random.Random(4)
    pieces = [" ", "  ", "\n", "<|endoftext|>", "it's", "'ll", "ß", "日本", " ", "12", "!!", "\t", "x" * 40,
              "<|endo", "ftext|>", "👍🏽", "é", "word", " and"]
    mixed = [(200 + k, "".join(rng.choice(pieces) for _ in range(rng.randint(0, 900)))) for k in range(60)]
    table = awkward() + mixed
    docs = documents(spark, table)
    plain = chunked_bpe.Vocabulary(vocabulary()).tokenizer
    out = chunked_bpe.decode(chunked_bpe.encode(docs, vocabulary()), vocabulary()).collect()
    assert Counter(r.doc_id for r in out) == Counter(i for i, _ in table)
    texts = dict(table)
    for r in out:
        want = plain.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        assert np.frombuffer(r.ids, "<u4").tolist() == want
        assert r.decoded == plain.decode(want, skip_special_tokens=False) == (texts[r.doc_id] or "")
    assert chunked_bpe.encode(documents(spark, EMPTY), vocabulary()).count() == 0


def test_chunks_are_reused():
    encoder = chunked_bpe.Encoder(chunked_bpe.Vocabulary(vocabulary()))
    passage = prose(3, 4_000)
    encoder.documents([(prose(k, 50) + passage).encode() for k in range(6)])
    assert encoder.encoded < 0.5 * encoder.reused


def test_chunks_in_use_outlast_others(monkeypatch):
    monkeypatch.setattr(chunked_bpe, "CACHE_BYTES", 60_000)
    vocabulary_held = chunked_bpe.Vocabulary(vocabulary())
    encoder = chunked_bpe.Encoder(vocabulary_held)
    hot = prose(1, 1_000).encode()
    for k in range(12):
        ids = encoder.documents([hot, prose(50 + k, 1_200).encode()])[0]
        assert ids.tolist() == vocabulary_held.encode(hot).tolist()
    assert encoder.reused >= 10 * len(hot) and encoder.held <= 60_000


# --- 6: decontamination -----------------------------------------------------------

def hits(text, tests):
    words = ALNUM.findall(lower(text))
    mark, items = [False] * len(words), set()
    for name, t in tests:
        w = ALNUM.findall(lower(t))
        n = min(10, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            for at in range(len(words) - n + 1):
                if words[at:at + n] == w[k:k + n]:
                    items.add(str(name))
                    mark[at:at + n] = [True] * n
    return len(words), sum(mark), sorted(items)


@pytest.mark.parametrize("limit", [10**7, 200])
def test_windows_found_equal_brute_force(spark, monkeypatch, limit):
    monkeypatch.setattr(suffix_matches.benchmark_blocks, "__defaults__", (limit,))
    table = [r for r in awkward() if len(r[1] or "") < 30_000]
    w = prose(1, 120).split(" ")
    tests = [(1, " ".join(w[20:60])), (2, "changed"), (3, None), (4, "..."), (5, "two WORDS"), (6, " ".join(w[50:59])),
             (7, prose(99, 30)), (1, " ".join(w[100:115]))]
    bench = spark.createDataFrame(tests, "item_id long, text string").withColumn("words", F.lit(1))
    docs = documents(spark, table)
    texts, out = dict(table), suffix_matches.contamination(docs, bench).collect()
    assert Counter(r.doc_id for r in out) == Counter(i for i, _ in table)
    for r in out:
        n, hit, items = hits(texts[r.doc_id], tests)
        assert (r.n_words, r.n_hit, r["items"], r.contaminated) == (n, hit, items, hit > 0)
    kept = suffix_matches.decontaminate(docs, bench)
    assert kept.columns == docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(r.doc_id for r in out if not r.contaminated)
    found = suffix_matches.longest_matches(docs, bench).where("doc_id = 0 AND item_id = '1'").collect()
    assert max(r.n_words for r in found) >= 40 - 10


def test_nothing_to_compare(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    docs = documents(spark, awkward())
    assert suffix_matches.contamination(docs, none).where("contaminated").count() == 0
    assert suffix_matches.contamination(documents(spark, EMPTY), none).count() == 0


# --- 7: lines -----------------------------------------------------------------------

def gone_lines(table, percent=80, least=3):
    lines = [((i, k), frozenset(x for x in line.split(" ") if x))
             for i, t in dict(table).items() if i is not None and t is not None for k, line in enumerate(t.split("\n"))]
    lines = sorted((p, s) for p, s in lines if len(s) >= least)
    return {p for n, (p, s) in enumerate(lines)
            if any(100 * len(s & o) >= percent * len(s | o) for _, o in lines[:n])}


def test_lines_gone_equal_brute_force(spark):
    rng = random.Random(8)
    base = [prose(k, 25).replace("\n", "") for k in range(6)]

    def varied(line):
        w = line.split(" ")
        for _ in range(rng.choice((0, 1, 2, 4))):
            w[rng.randrange(len(w))] = "v%d" % rng.randrange(99)
        return " ".join(w)

    table = [(k, "\n".join(varied(rng.choice(base)) for _ in range(5))) for k in range(40)] + [
        (50, None), (51, ""), (52, "one two\none two"), (53, "a b c\n\na b c\n"), (54, "a  b\tc d\nd a b\tc"),
        (55, prose(70, 9_000)), (None, base[0])]
    table += [table[0], table[42]]
    out = line_dedup.removed_per_document(documents(spark, table)).collect()
    want = gone_lines(table)
    assert Counter(r.doc_id for r in out) == Counter(i for i, _ in table)
    for r in out:
        text = dict(table)[r.doc_id]
        assert r.removed == sorted(k for i, k in want if i == r.doc_id)
        assert r.n_lines == (0 if text is None else len(text.split("\n")))
    docs = documents(spark, table)
    cleaned = line_dedup.dedup_lines(docs)
    assert cleaned.columns == docs.columns
    for r in cleaned.collect():
        text = dict(table)[r.doc_id]
        assert r.text == (None if text is None else "\n".join(
            line for k, line in enumerate(text.split("\n")) if (r.doc_id, k) not in want))
    assert line_dedup.removed_per_document(documents(spark, EMPTY)).count() == 0


def test_emptied_documents_go_on_request(spark):
    docs = documents(spark, [(1, "a b c"), (2, "a b c"), (3, ""), (4, None), (5, "a b c\nd")])
    left = line_dedup.dedup_lines(docs, drop_emptied=True).collect()
    assert {r.doc_id: r.text for r in left} == {1: "a b c", 3: "", 4: None, 5: "d"}


def test_short_lines_and_other_white_space_count_on_request(spark, sf):
    rows = [(1, "Ja\nDer Der Der\na\tb\tc d\n第一行"), (2, "Ja\nnur hier\nDer Der Der"), (3, "Ja\r\n第一行\n\t\u00a0\n"),
            (4, "a\u00a0b c\u3000d e"), (5, "Nein\nJa nein"), (6, "\t"), (7, "x y\nx y z\nz y x\nx y")]
    docs = documents(spark, rows)
    out = line_dedup.removed_per_document(docs, least_words=1, any_space=True).collect()
    assert {r.doc_id: r.removed for r in out} == {1: [], 2: [0, 2], 3: [0, 1], 4: [0], 5: [], 6: [], 7: [2, 3]}
    named = [(i, t, "en", "s", len(t)) for i, t in rows]
    whole = spark.createDataFrame(named, "doc_id long, text string, lang string, source string, n_chars long")
    left = {r.doc_id: r.text for r in stages.lines(spark, whole, sf).collect()}
    assert left == {1: rows[0][1], 2: "nur hier", 5: "Nein\nJa nein", 6: "\t", 7: "x y\nx y z"}


# --- 8: surrogates ------------------------------------------------------------------

def test_surrogates_are_consistent_distinct_and_in_format(spark):
    texts = {1: "Mail jo.doe@mail.example.com or JO.DOE@mail.example.com, call +1 (743) 555-3824 or 743-555-3824.",
             2: "Card 4111 1111 1111 1111 not 4111111111111112; ip 10.20.30.40 not 300.1.1.1",
             3: "Mrs. Anna Berg met Mr Karl Berg and Herr Karl Berg; Frau Анна Петрова too", 4: None, 5: "", 6: "plain text 12",
             7: 'key = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff" again jo.doe@mail.example.com', 8: "ssn 123-45-6789 end"}
    rows = [*texts.items(), (1, texts[1]), (None, texts[8])]
    out = surrogates.replace_entities(documents(spark, rows), "k").collect()
    got = {r.doc_id: r.text for r in out}
    assert len(out) == len(rows)
    assert [got[i] for i in (4, 5, 6)] == [None, "", "plain text 12"]
    for private in ("doe@", "DOE@", "555-3824", "4111 1111", "10.20.30.40", "Anna", "Karl", "Berg", "Анна", "24be64", "45-6789"):
        assert not any(private in (t or "") for t in got.values())
    assert "4111111111111112" in got[2] and "300.1.1.1" in got[2]
    a, b = got[1].split(" ")[1], got[1].split(" ")[3].strip(",")
    assert a == b.lower() and a.split("@")[0] in got[7] and a.endswith(".com") and b.split("@")[0].isupper()
    phones = [x for x in got[1].replace(".", "").split("call ")[1].split(" or ")]
    assert [c for c in phones[0] if c.isdigit()][1:] == [c for c in phones[1] if c.isdigit()]
    card = got[2][5:24]
    digits = [int(c) for c in card if c.isdigit()]
    assert digits[0] == 4 and card.count(" ") == 3
    assert sum(d if k % 2 else (2 * d - 9 if 2 * d > 9 else 2 * d) for k, d in enumerate(digits)) % 10 == 0
    w = got[3].replace(";", "").split(" ")
    assert w[2] == w[6] == w[10] and w[5] == w[9] and w[1].endswith("a") and w[5].endswith("o")
    assert all("а" <= c.lower() <= "я" for c in w[12] + w[13])
    assert {r.doc_id: r.n_entities for r in out}[2] == 2
    assert surrogates.replace_entities(documents(spark, EMPTY), "k").count() == 0
    other = surrogates.replace_entities(documents(spark, rows), "another").collect()
    assert {r.doc_id: r.text for r in other}[1] != got[1]


def test_later_mentions_other_scripts_and_layouts_are_replaced(spark):
    texts = {1: "Mr John Smith came. Smith said that John Smith's car and SMITH are one; smith and Smithers are not.",
             2: "昨天王小明先生来了，王小明说好。", 3: "السيد محمد علي، ثم محمد", 4: "מר כהן, ואז כהן.", 5: "господин Иванов. Иванов ушёл",
             6: "call +15551234567 or (555)123-4567 or +49 30 1234567", 7: "key " + "ab12" * 40 + " end",
             8: "Mr 김민수, 김민수", 9: "昨日は田中さんと田中の家", 10: "Smith, of another document"}
    out = surrogates.replace_entities(documents(spark, [*texts.items()]), "k").collect()
    got = {r.doc_id: r.text for r in out}
    private = {1: ("John", "Smith ", "SMITH", "Smith'"), 2: ("王小明",), 3: ("محمد", "علي"), 4: ("כהן",), 5: ("Иванов",),
               6: ("1234567", "123-4567"), 7: ("ab12ab12",), 8: ("김민수",), 9: ("田中",)}
    for i, names in private.items():
        assert not any(name in got[i] for name in names), (i, got[i])
    w = got[1].replace(".", "").replace("'", " ").split(" ")
    assert w[2] == w[4] == w[8] and w[1] == w[7] and w[12] == w[2].upper() and "; smith and Smithers are not" in got[1]
    assert got[2][2:5] == got[2][10:13] and got[2][5:10] == "先生来了，" and got[2].endswith("说好。")
    name = got[5].split(" ")[1].strip(".")
    assert got[5] == f"господин {name}. {name} ушёл"
    assert got[8] == f"Mr {got[8][3:6]}, {got[8][3:6]}" and len(got[7]) == len(texts[7]) and got[10] == texts[10]
    assert {r.doc_id: r.n_entities for r in out} == {1: 4, 2: 2, 3: 2, 4: 2, 5: 2, 6: 3, 7: 1, 8: 2, 9: 2, 10: 0}


def test_collisions_are_drawn_again(spark, monkeypatch):
    entities = spark.createDataFrame([("ssn", f"{k:09d}") for k in range(40)], "kind string, normal string")
    original = surrogates._stream

    def narrow(key, kind, normal, attempt):        # the first attempt is the same for all
        return F.when(attempt == 0, F.lit("0" * 128)).otherwise(original(key, kind, normal, attempt))

    monkeypatch.setattr(surrogates, "_stream", narrow)
    settled = surrogates.settled(entities, "k").withColumn("raw", F.col("normal"))
    drawn = [r.new for r in surrogates.with_surrogate(settled, "k", "new").collect()]
    assert len(set(drawn)) == 40 and not set(drawn) & {f"{k:09d}" for k in range(40)}


# --- 9: quality ------------------------------------------------------------------------

def test_quality_is_learned_and_everything_is_scored(spark):
    good = [(k, prose(k, 60)) for k in range(120)]
    bad = [(200 + k, " ".join(w + "$$$" for w in prose(k, 60).split(" "))) for k in range(60)]
    docs = documents(spark, good + bad + [(900, None), (901, ""), (902, prose(5, 20_000)), (902, prose(5, 20_000))])
    labels = spark.createDataFrame(
        [(i, 1) for i, _ in good[:80]] + [(i, 0) for i, _ in bad[:40]] + [(7, None), (12345, 1)], "doc_id long, quality int")
    model = subword_quality.fit(docs, labels, settings=subword_quality.Settings(bucket_bits=12, epochs=8))
    out = subword_quality.score(docs, model).collect()
    assert len(out) == docs.count() and all(0 <= r.score <= 1 for r in out)
    score = {r.doc_id: r.score for r in out}
    assert min(score[i] for i, _ in good[80:]) > 0.5 > max(score[i] for i, _ in bad[40:])
    assert score[900] == score[901]
    kept = subword_quality.keep_above(docs, model, 0.5)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, s in score.items() if s >= 0.5}
    assert subword_quality.score(docs.limit(0), model).count() == 0
    with pytest.raises(ValueError):
        subword_quality.fit(docs, labels.where("quality = 1"))


def test_hash_of_a_blockwise_text_is_the_hash_of_the_word(spark):
    from keepwell.llm.textblocks import LETTER_OR_DIGIT, text_bytes, words
    import pyarrow as pa
    text = prose(2, 40_000)
    whole = words(*text_bytes(pa.array([text, None, "w001 w002"])), LETTER_OR_DIGIT)
    named = {}
    spelled = ALNUM.findall(lower(text)) + ["w001", "w002"]
    assert len(spelled) == len(whole.hash) and whole.first.tolist() == [0, len(spelled) - 2, len(spelled) - 2, len(spelled)]
    for w, h in zip(spelled, whole.hash.tolist()):
        assert named.setdefault(w, h) == h
    assert len(set(named.values())) == len(named)


# --- ids of every kind ---------------------------------------------------------------

@pytest.mark.parametrize("kind,name", [("string", lambda i: f"id-{i:03d}"), ("long", lambda i: (1 << 62) + i),
                                       ("long", lambda i: i - (1 << 62))])
def test_near_duplicates_take_ids_of_every_kind(spark, kind, name):
    texts = family(12, [0, 1, 2], 7) + [prose(400 + k, 60) for k in range(4)]
    rows = [(name(i), t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, f"doc_id {kind}, text string")
    sets = {i: shingles(t, 3) for i, t in rows}
    want = groups(sorted(sets), lambda i, j: similar(sets[i], sets[j], 85))
    out = {r.doc_id: r.component_id for r in minhash_groups.near_duplicates(docs, size=3, percent=85).collect()}
    assert out == want
    kept = minhash_groups.keep_one(docs, size=3, percent=85)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i in want if want[i] == i)
