"""Queries of the training-data operators with production parameters.

Each query runs its operator over the whole table and derives the digest
columns from what the operator returns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keepwell.llm import (
    byte_language, chunked_bpe, hilbert_shards, line_dedup, minhash_groups, ranked_search, repeated_bytes,
    resampling, rotation_codes, subword_quality, suffix_matches, surrogates, warc_merge,
)

QUALITY_THRESHOLD = 0.3
SHARDS = 40
#: A deployment passes a secret of its own to ``replace_entities``.
SURROGATE_KEY = "public example key"
#: Bytes of one Arrow batch. Texts are long: the usual 10,000 rows of a batch would
#: stand in the executor and in its Python workers at once, some of them several times.
BATCH_BYTES = 8_000_000
DIMENSIONS = {"source": hilbert_shards.TEXT, "lang": hilbert_shards.TEXT, "n_chars": hilbert_shards.NUMBER}


def load(spark: SparkSession, sf: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{table}.parquet")


def bound_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def op1_hilbert_shards(spark, sf):
    found = hilbert_shards.shard(load(spark, sf, "documents"), DIMENSIONS, SHARDS)
    return found.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                        F.lit(None).cast("int").alias("grown_shard"), "hilbert")


def op2_minhash_groups(spark, sf):
    return minhash_groups.near_duplicates(load(spark, sf, "documents"), size=3, percent=85)


def op3_rotation_codes(spark, sf):
    return rotation_codes.near_vectors(load(spark, sf, "embeddings"), 0.98)


def op4_byte_language(spark, sf):
    docs = load(spark, sf, "documents")
    network = byte_language.fit(docs.where(~held_out()))
    return byte_language.predict(docs, network).select(
        "doc_id", held_out().alias("held_out"), "lang_pred", "score")


def vocabulary() -> str:
    """The public byte-level BPE vocabulary the queries encode with."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def encoding_digests(docs: DataFrame) -> DataFrame:
    decoded = chunked_bpe.encode(docs, vocabulary(), decoded=True)
    return decoded.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op5_chunked_bpe(spark, sf):
    return encoding_digests(load(spark, sf, "documents"))


def op6_suffix_decontamination(spark, sf):
    found = suffix_matches.contamination(load(spark, sf, "documents"), load(spark, sf, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated", "longest_match")


def op7_line_dedup(spark, sf):
    """Every line with a word counts, words split at all white space."""
    found = line_dedup.removed_per_document(load(spark, sf, "documents"), least_words=1, any_space=True)
    return found.select("doc_id", F.col("n_lines").cast("long").alias("n_lines"),
                        F.size("removed").cast("long").alias("n_removed"),
                        F.array_join(F.col("removed").cast("array<string>"), ",").alias("removed_lines"))


def op8_surrogates(spark, sf):
    docs = load(spark, sf, "documents").select("doc_id", "text")
    return surrogates.replace_entities(docs, SURROGATE_KEY).select(
        "doc_id", "n_entities", "entity_kinds", "text")


def held_out(doc_id="doc_id"):
    """Rows no model of a query may learn from; a row without an id is none."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


def quality_model(docs: DataFrame, labels: DataFrame) -> subword_quality.Model:
    return subword_quality.fit(docs, labels.where(~held_out()))


def op9_subword_quality(spark, sf):
    docs = load(spark, sf, "documents")
    model = quality_model(docs, load(spark, sf, "labels"))
    return subword_quality.score(docs, model).select(
        "doc_id", held_out().alias("held_out"), "score",
        (F.col("score") >= QUALITY_THRESHOLD).cast("int").alias("predicted"))


def op10_warc_merge(spark, sf):
    return warc_merge.archive_pages(load(spark, sf, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to",
        "url_key", "captured_at", "position")


def op11_lyndon_suffix_groups(spark, sf):
    bound_batches(spark)
    found = repeated_bytes.remove_repeats(load(spark, sf, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256")


def op12_importance_resampling(spark, sf):
    found = resampling.resample(load(spark, sf, "documents"), load(spark, sf, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


def op13_best_position_search(spark, sf):
    return ranked_search.search(load(spark, sf, "documents"), load(spark, sf, "benchmark"))


QUERIES = {name: fn for name, fn in list(globals().items()) if name.startswith("op")}
ORACLES: dict[str, str] = {}
ORACLES["op7_line_dedup"] = fr"""
WITH lines AS (
  SELECT doc_id, unnest(range(len(parts))) AS line_no, unnest(parts) AS line
  FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents
        WHERE doc_id IS NOT NULL AND text IS NOT NULL)),
sets AS (
  SELECT doc_id, line_no, list_sort(list_distinct(list_filter(
    string_split(regexp_replace(line, '[\t\x0B\f\r\x1C-\x1F\x{{85}}\pZ]', ' ', 'g'), ' '), lambda w: w <> ''))) AS words
  FROM lines),
usable AS (SELECT * FROM sets WHERE len(words) >= 1),
classes AS (
  SELECT words, len(words) AS n, min({{'d': doc_id, 'l': line_no}}) AS place, row_number() OVER () AS id
  FROM usable GROUP BY words),
tokens AS (SELECT id, n, place, unnest(words) AS word FROM classes),
ranked AS (
  SELECT id, n, place, word, row_number() OVER (PARTITION BY id ORDER BY times, word) AS pos
  FROM tokens JOIN (SELECT word, count(*) AS times FROM tokens GROUP BY word) USING (word)),
prefixes AS (
  SELECT * FROM ranked WHERE pos <= n - CAST(ceil(n * {line_dedup.PERCENT} / 100.0) AS BIGINT) + 1),
pairs AS (
  SELECT DISTINCT y.id AS y, x.id AS x FROM prefixes y JOIN prefixes x USING (word)
  WHERE x.place < y.place AND 100 * least(x.n, y.n) >= {line_dedup.PERCENT} * greatest(x.n, y.n)),
alike AS (
  SELECT DISTINCT a.place FROM pairs JOIN classes a ON a.id = y JOIN classes b ON b.id = x
  WHERE 100 * len(list_intersect(a.words, b.words)) >=
    {line_dedup.PERCENT} * (a.n + b.n - len(list_intersect(a.words, b.words)))),
gone AS (
  SELECT DISTINCT doc_id, line_no FROM usable JOIN classes USING (words)
  WHERE {{'d': doc_id, 'l': line_no}} > place OR place IN (SELECT place FROM alike)),
per_doc AS (
  SELECT doc_id, count(*) AS n_removed, string_agg(line_no, ',' ORDER BY line_no) AS removed_lines
  FROM gone GROUP BY doc_id)
SELECT doc_id, CAST(CASE WHEN text IS NULL THEN 0 ELSE len(string_split(text, chr(10))) END AS BIGINT) AS n_lines,
  coalesce(n_removed, 0) AS n_removed, coalesce(removed_lines, '') AS removed_lines
FROM documents LEFT JOIN per_doc USING (doc_id)"""

# The host is everything up to the first slash of what follows the scheme.
ORACLES["op10_warc_merge"] = f"""
WITH parts AS (
  SELECT page_id, coalesce(html, '') AS payload, split_part(coalesce(url, ''), '#', 1) AS whole FROM pages),
bare AS (
  SELECT *, CASE WHEN instr(whole, '://') > 0 AND substr(whole, instr(whole, '://') + 3) <> ''
    THEN substr(whole, instr(whole, '://') + 3) ELSE whole END AS rest FROM parts),
hosts AS (
  SELECT *, regexp_replace(regexp_replace(regexp_replace(lower(split_part(rest, '/', 1)), '^www[.]', ''),
    ':80$', ''), ':443$', '') AS host,
    CASE WHEN instr(rest, '/') > 0 THEN substr(rest, instr(rest, '/')) ELSE '/' END AS path FROM bare),
keyed AS (
  SELECT page_id, octet_length(encode(payload)) AS payload_bytes, sha1(payload) AS payload_digest,
    array_to_string(list_reverse(string_split(host, '.')), ',') || ')' || path AS url_key,
    strftime(TIMESTAMP '{warc_merge.FIRST_CAPTURE}' + to_seconds(page_id), '%Y-%m-%dT%H:%M:%SZ') AS captured_at
  FROM hosts),
grouped AS (
  SELECT *, CASE WHEN payload_bytes >= {warc_merge.LEAST_BYTES}
    THEN max(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS stored FROM keyed)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
  CASE WHEN stored <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN stored <> page_id THEN stored END AS refers_to, url_key, captured_at,
  row_number() OVER (ORDER BY encode(url_key), captured_at, page_id) - 1 AS position
FROM grouped"""


def _hilbert_sql(bits: int) -> str:
    """The curve as one derived table per turn of the axes x0, x1, x2."""
    out = "SELECT *, s0 AS x0, s1 AS x1, s2 AS x2 FROM cells"
    for k in range(bits - 1, 0, -1):
        for i in range(3):
            q, swap = 1 << k, f"(xor(x0, x{i}) & {(1 << k) - 1})"
            new = {0: f"xor(x0, CASE WHEN x{i} & {q} <> 0 THEN {q - 1} ELSE {swap} END)"}
            if i:
                new[i] = f"xor(x{i}, CASE WHEN x{i} & {q} <> 0 THEN 0 ELSE {swap} END)"
            out = f"SELECT * REPLACE ({', '.join(f'{e} AS x{c}' for c, e in new.items())}) FROM ({out})"
    out = f"SELECT * REPLACE (xor(x0, x1) AS x1, xor(xor(x0, x1), x2) AS x2) FROM ({out})"
    flip = "0"
    for k in range(bits - 1, 0, -1):
        flip = f"xor({flip}, CASE WHEN x2 & {1 << k} <> 0 THEN {(1 << k) - 1} ELSE 0 END)"
    out = f"SELECT *, {flip} AS flip FROM ({out})"
    bits_of = [f"((xor(x{i}, flip) >> {k}) & 1) * {1 << (3 * k + 2 - i)}" for k in range(bits) for i in range(3)]
    return f"SELECT *, {' + '.join(bits_of)} AS hilbert FROM ({out})"


_STEP_SQL = "coalesce(CAST('0x' || substr(md5({0}), 1, 4) AS INT) >> {1}, 0)"
_CODE_SQL = "length(bin(greatest(n_chars, 0) + 8)) * 8 + {0}"
_THREE_BITS = " + ".join(f"CAST(substr(bin(greatest(n_chars, 0) + 8), {2 + k}, 1) AS INT) * {4 >> k}" for k in range(3))
ORACLES["op1_hilbert_shards"] = f"""
WITH RECURSIVE crc(b, c, k) AS (
  SELECT range, CAST(range AS BIGINT), 0 FROM range(256)
  UNION ALL SELECT b, xor(c >> 1, (c & 1) * 3988292384), k + 1 FROM crc WHERE k < 8),
steps_of AS (SELECT list(c ORDER BY b) AS t FROM crc WHERE k = 8),
rows AS (
  SELECT doc_id, source, lang, octet_length(encode(coalesce(text, ''))) + 16 AS size,
    hex(encode(coalesce(text, ''))) AS digits, {_CODE_SQL.format(_THREE_BITS)} AS code
  FROM documents),
checked AS (
  SELECT * EXCLUDE (digits), xor(4294967295, list_reduce(
    list_transform(regexp_extract_all(digits, '..'), lambda x: CAST('0x' || x AS BIGINT)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), CAST(4294967295 AS BIGINT))) AS text_crc32
  FROM rows, steps_of),
depth AS (
  SELECT code, CAST(floor((sum(n) OVER (ORDER BY code) - n) * {1 << hilbert_shards.BITS} / sum(n) OVER ()) AS INT) AS step
  FROM (SELECT code, count(*) AS n FROM checked WHERE code IS NOT NULL GROUP BY code)),
cells AS (
  SELECT c.*, {_STEP_SQL.format('source', 16 - hilbert_shards.BITS)} AS s0,
    {_STEP_SQL.format('lang', 16 - hilbert_shards.BITS)} AS s1, coalesce(step, 0) AS s2
  FROM checked c LEFT JOIN depth USING (code)),
placed AS (
  SELECT *, row_number() OVER (ORDER BY hilbert, text_crc32, doc_id) - 1 AS place, count(*) OVER () AS n
  FROM ({_hilbert_sql(hilbert_shards.BITS)}))
SELECT doc_id, CAST(size AS BIGINT) AS size, text_crc32, 'rows' AS law,
  CAST(place * {SHARDS} // n AS INT) AS shard,
  CAST(place - ((place * {SHARDS} // n) * n + {SHARDS - 1}) // {SHARDS} AS BIGINT) AS slot,
  CAST(NULL AS INT) AS grown_shard, CAST(hilbert AS BIGINT) AS hilbert
FROM placed"""

_WORDS = "regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')".format(
    upper="ABCDEFGHIJKLMNOPQRSTUVWXYZ", lower="abcdefghijklmnopqrstuvwxyz")
ORACLES["op12_importance_resampling"] = f"""
WITH RECURSIVE crc(b, c, k) AS (
  SELECT range, CAST(range AS BIGINT), 0 FROM range(256)
  UNION ALL SELECT b, xor(c >> 1, (c & 1) * 3988292384), k + 1 FROM crc WHERE k < 8),
steps_of AS (SELECT list(c ORDER BY b) AS t FROM crc WHERE k = 8),
doc_words AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS words FROM documents),
tokens AS (
  SELECT r, word, count(*) AS n FROM (SELECT r, unnest(words) AS word FROM doc_words) GROUP BY r, word),
aims AS (SELECT word, count(*) AS n FROM (SELECT unnest({_WORDS}) AS word FROM benchmark) GROUP BY word),
buckets AS (
  SELECT word, xor(4294967295, list_reduce(
    list_transform(regexp_extract_all(hex(encode(word)), '..'), lambda x: CAST('0x' || x AS BIGINT)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), CAST(4294967295 AS BIGINT))) % {resampling.BUCKETS} AS bucket
  FROM (SELECT word FROM tokens UNION SELECT word FROM aims), steps_of),
corpus AS (SELECT bucket, sum(n) AS s FROM tokens JOIN buckets USING (word) GROUP BY bucket),
target AS (SELECT bucket, sum(n) AS t FROM aims JOIN buckets USING (word) GROUP BY bucket),
sums AS (SELECT (SELECT coalesce(sum(s), 0) FROM corpus) AS a, (SELECT coalesce(sum(t), 0) FROM target) AS b),
gains AS (
  SELECT bucket, CAST(floor(1000 * ln(
    CAST(coalesce(t, 0) + 1 AS DOUBLE) * CAST(a + {resampling.BUCKETS} AS DOUBLE)
    / (CAST(s + 1 AS DOUBLE) * CAST(b + {resampling.BUCKETS} AS DOUBLE)))) AS BIGINT) AS gain
  FROM corpus LEFT JOIN target USING (bucket), sums),
weighed AS (
  SELECT r, CAST(sum(n) AS BIGINT) AS n_features, CAST(floor(sum(n * gain) / CAST(sum(n) AS DOUBLE)) AS BIGINT) AS weight
  FROM tokens JOIN buckets USING (word) JOIN gains USING (bucket) GROUP BY r),
scored AS (
  SELECT doc_id, r, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((
      CAST('0x' || substr(sha256('{resampling.SEED}:' || doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296.0::DOUBLE))) AS BIGINT) AS score
  FROM doc_words LEFT JOIN weighed USING (r)),
ranked AS (
  SELECT r, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n
  FROM scored WHERE n_features >= {resampling.LEAST_WORDS} AND score IS NOT NULL)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= {resampling.PERCENT} * n // 100 THEN place END AS rank
FROM scored LEFT JOIN ranked USING (r)"""

ORACLES["op13_best_position_search"] = f"""
WITH doc_terms AS (SELECT doc_id, {_WORDS} AS words FROM documents),
sizes AS (SELECT doc_id, len(words) AS n FROM doc_terms WHERE len(words) > 0),
sums AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM sizes),
asked AS (
  SELECT item_id, word, count(*) AS repeats FROM (SELECT item_id, unnest({_WORDS}) AS word FROM benchmark)
  GROUP BY item_id, word),
tokens AS (
  SELECT doc_id, word, count(*) AS tf FROM (SELECT doc_id, unnest(words) AS word FROM doc_terms)
  WHERE word IN (SELECT word FROM asked) GROUP BY doc_id, word),
weighed AS (
  SELECT word, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM (SELECT word, count(*) AS df FROM tokens GROUP BY word), sums),
impacts AS (
  SELECT doc_id, word, w * ((1000000000 * tf) // (1000 * tf + 8 * (
    {100 - ranked_search.LENGTH_PERCENT} + ({ranked_search.LENGTH_PERCENT} * n * docs) // terms))) AS gain
  FROM tokens JOIN weighed USING (word) JOIN sizes USING (doc_id), sums),
scores AS (
  SELECT item_id, doc_id, CAST(sum(gain * repeats) AS BIGINT) AS score
  FROM asked JOIN impacts USING (word) GROUP BY item_id, doc_id)
SELECT item_id, CAST(rank AS INT) AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank
  FROM scores WHERE score > 0) WHERE rank <= {ranked_search.TOP}"""
