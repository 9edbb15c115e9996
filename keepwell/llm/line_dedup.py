"""Line dedup: exact set-similarity join of lines, DataFrame functions only.

A line is the set of its distinct words, which blanks separate, or any white space
with ``any_space``; a run without either is one word in every script. It goes if an earlier line
of the corpus (by doc_id, then line number) has a Jaccard similarity of
``percent`` / 100 or more, whether or not that earlier line goes itself. Lines
of fewer than ``least_words`` distinct words stay; with 1, only those without words.

1. Word counts over all lines, in a fixed number of hash buckets, give every
   word a rarity class. A word's key is its rarity class, then its hash: one
   total order, rarest first.
2. Equal sets are one class, with its first place; later places go. Sets too small
   to be similar to any other set end here.
3. A class's prefix is its rarest n - ceil(t n) + 1 words; similar sets share a
   prefix word. Pairs that meet must pass the length filter (n small against n
   large), the positional filter (what can still match after this word) and
   the bitmap filter: a word that only one of the sets has flips one bit of
   64 (128 between long lines), so the bits that differ bound how many there are.
4. First each class is only compared with the first class it shares one of the
   last words of its prefix with (what near copies differ in is rarer and stands
   before them); near copies of one line go here with a few comparisons each.
   The classes that remain meet all earlier ones. Pairs are verified on the words.

Nulls and texts without words lose nothing. Rows without an id are left as they
are and don't count as earlier lines. Rows that share an id are one document:
equal line numbers in them are the same place. Empty tables give empty results.
Extra columns are carried by ``dedup_lines`` and ignored elsewhere.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keepwell.llm.sides import checked
from keepwell.session import materialise

PERCENT = 80
LEAST_WORDS = 3
RARITY_BUCKETS = 65_536
STAR_WORDS = 6
#: Lines of more words have a bitmap of 128 bits, the others of 64.
LONG_LINE = 80
#: Line numbers a broadcast may hold: some eight megabytes.
BROADCAST_LINES = 2_000_000
_HASH_MASK = (1 << 56) - 1
#: White space inside a line, other than the blank.
_OTHER_SPACE = r"[\t\x0B\f\r\x1C-\x1F\x{85}\p{Z}&&[^ ]]"


def words_of(line: Column) -> Column:
    return F.array_remove(F.split(line, " "), "")


def blanked(text: Column, any_space: bool) -> Column:
    """``text`` with blanks for all white space but line feeds, if asked."""
    return F.regexp_replace(text, _OTHER_SPACE, " ") if any_space else text


def numbered_lines(docs: DataFrame, doc_id: str, text: str, any_space: bool = False) -> DataFrame:
    return docs.where(F.col(doc_id).isNotNull()).select(
        F.col(doc_id).alias("doc_id"),
        F.posexplode(F.split(blanked(F.col(text), any_space), "\n")).alias("line_no", "line"))


def rarity(lines: DataFrame) -> Column:
    """Rarity class of every hash bucket, 0 to 127, in the top byte of a long, as
    one constant array. The table has ``RARITY_BUCKETS`` entries whatever the corpus."""
    counts = lines.select(F.explode(F.split("line", " ")).alias("word")).where("word != ''").select(
        F.pmod(F.xxhash64("word"), F.lit(RARITY_BUCKETS)).alias("bucket")).groupBy("bucket").agg(
        F.least(F.lit(127), F.floor(4 * F.log2(F.count("*") + 1))).cast("int").alias("class")).collect()
    table = [0] * RARITY_BUCKETS
    for row in counts:
        table[row["bucket"]] = row["class"] << 56
    return F.from_json(F.lit("[" + ",".join(map(str, table)) + "]"), "array<bigint>")


def line_keys(lines: DataFrame, percent: int) -> DataFrame:
    """(doc_id, line_no, n, set_a, set_b, prefix) of lines with words. Which have
    enough of them is asked of the stored table: here Spark would move that filter
    below the hashing and hash every word twice."""
    classes = rarity(lines)

    def key(h: Column) -> Column:
        # Never null, so that the keys are sorted as plain longs.
        rank = F.coalesce(F.get(classes, h.bitwiseAND(F.lit(RARITY_BUCKETS - 1)).cast("int")), F.lit(0).cast("long"))
        return rank.bitwiseOR(h.bitwiseAND(F.lit(_HASH_MASK)))

    def flip(bits: Column, k: Column) -> Column:
        return bits.bitwiseXOR(F.call_function(
            "shiftleft", F.lit(1).cast("long"), k.bitwiseAND(F.lit(63)).cast("int")))

    def flip_half(bits: Column, k: Column) -> Column:
        return F.when(k.bitwiseAND(F.lit(64)) == 0, bits).otherwise(flip(bits, k))

    hashed = F.array_distinct(F.transform(words_of(F.col("line")), lambda w: F.xxhash64(w)))
    keyed = lines.where(F.trim("line") != "").select("doc_id", "line_no", hashed.alias("hashed")).select(
        "doc_id", "line_no", F.sort_array(F.transform("hashed", key)).alias("keys"))
    n = F.size("keys")
    length = n - F.floor((n * percent + 99) / 100).cast("int") + 1
    prefix = F.slice("keys", F.lit(1), length)
    star = F.slice("keys", F.greatest(length - STAR_WORDS + 1, F.lit(1)), F.least(length, F.lit(STAR_WORDS)))
    return keyed.select(
        "doc_id", "line_no", n.alias("n"), F.xxhash64("keys").alias("set_a"),
        F.xxhash64(F.lit(1), "keys").alias("set_b"), F.aggregate("keys", F.lit(0).cast("long"), flip).alias("bits"),
        F.when(n > LONG_LINE, F.aggregate("keys", F.lit(0).cast("long"), flip_half)).otherwise(
            F.lit(0).cast("long")).alias("half"),
        F.transform(prefix, lambda k: F.hash(k)).alias("prefix"),
        F.transform(star, lambda k: F.hash(k)).alias("star"))


_CLASS = ("doc", "line", "n", "bits", "half", "at")


def _meet(later: DataFrame, earlier: DataFrame, percent: int, live: bool = False) -> DataFrame:
    """Pairs of classes on a common prefix word that pass the filters. With
    ``live`` only later classes marked 1 take part; that is asked of both sides
    at once, so that both sides of a self-join come from one exchange."""
    columns = (*_CLASS, "live") if live else _CLASS
    y = later.select("word", *[F.col(c).alias(f"y_{c}") for c in columns])
    x = earlier.select("word", *[F.col(c).alias(f"x_{c}") for c in columns])
    both = F.col("x_n") + F.col("y_n")
    may = F.least(F.col("x_n") - F.col("x_at"), F.col("y_n") - F.col("y_at"))
    bits = F.col("x_bits").bitwiseXOR(F.col("y_bits"))
    half = F.col("x_half").bitwiseXOR(F.col("y_half"))
    # Of two long lines the halves of the bitmap are known apart.
    differ = F.when(F.least("x_n", "y_n") > LONG_LINE, F.bit_count(bits.bitwiseXOR(half)) + F.bit_count(half)).otherwise(
        F.bit_count(bits))
    asks = 2 * F.col("y_live") + F.col("x_live") >= 2 if live else F.lit(True)
    return y.join(x, "word").where(
        asks & (100 * F.least("x_n", "y_n") >= percent * F.greatest("x_n", "y_n"))
        & (may * (100 + percent) >= percent * both)
        & (differ * (100 + percent) <= (100 - percent) * both)
        & (F.struct("x_doc", "x_line") < F.struct("y_doc", "y_line")))


def _verify(pairs: DataFrame, docs: DataFrame, percent: int, doc_id: str, text: str, any_space: bool) -> DataFrame:
    """The pairs whose word sets are similar, as (y_doc, y_line, x_doc, x_line)."""
    pairs = materialise(pairs.select("y_doc", "y_line", "x_doc", "x_line").distinct())
    places = pairs.select(F.col("y_doc").alias("doc_id"), F.col("y_line").alias("line_no")).unionByName(
        pairs.select(F.col("x_doc").alias("doc_id"), F.col("x_line").alias("line_no"))).distinct()
    places = materialise(places)
    ids = materialise(places.select("doc_id").distinct())
    some = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).join(
        checked(ids), "doc_id", "left_semi")
    held = materialise(numbered_lines(some, "doc_id", "text", any_space).join(
        checked(places), ["doc_id", "line_no"], "left_semi").select(
        "doc_id", "line_no", F.array_distinct(words_of(F.col("line"))).alias("words")))
    for side in ("y", "x"):
        pairs = pairs.join(held.withColumnsRenamed(
            {"doc_id": f"{side}_doc", "line_no": f"{side}_line", "words": f"{side}_words"}),
            [f"{side}_doc", f"{side}_line"])
    common = F.size(F.array_intersect("y_words", "x_words"))
    union = F.size("y_words") + F.size("x_words") - common
    return pairs.where(100 * common >= percent * union).select("y_doc", "y_line", "x_doc", "x_line")


def later_lines(docs: DataFrame, *, percent: int = PERCENT, least_words: int = LEAST_WORDS,
                any_space: bool = False, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, line_no) of every line that goes; line numbers start at 0."""
    keys = materialise(line_keys(numbered_lines(docs, doc_id, text, any_space), percent)).where(
        F.col("n") >= least_words)
    classes = materialise(keys.groupBy("set_a", "set_b", "n").agg(
        F.min(F.struct("doc_id", "line_no")).alias("place"),
        F.first("bits").alias("bits"), F.first("half").alias("half"), F.first("prefix").alias("prefix"), F.first("star").alias("star")))
    # Of all other sets, one with a word more or less is the most similar.
    narrow = classes.where(100 * F.col("n") >= percent * (F.col("n") + 1)).select("n", "bits", "half", F.col("place.doc_id").alias("doc"),
                            F.col("place.line_no").alias("line"), "prefix", "star")

    rare = narrow.select("n", "bits", "half", "doc", "line", F.lit(0).alias("at"), F.explode("star").alias("word"))
    first = rare.groupBy("word").agg(
        F.min(F.struct("doc", "line", "n", "bits", "half", "at")).alias("first"), F.count("*").alias("times"))
    first = first.where("times > 1").select("word", "first.*")
    stars = materialise(_verify(_meet(rare, first, percent), docs, percent, doc_id, text, any_space).select(
        F.col("y_doc").alias("doc"), F.col("y_line").alias("line")).distinct())
    marked = narrow.join(checked(stars.withColumn("gone", F.lit(True))), ["doc", "line"], "left")
    index = marked.select("n", "bits", "half", "doc", "line", F.col("gone").isNull().cast("int").alias("live"),
                          F.posexplode("prefix").alias("at", "word"))
    others = _verify(_meet(index, index, percent, live=True), docs, percent, doc_id, text, any_space).select(
        F.col("y_doc").alias("doc"), F.col("y_line").alias("line"))
    similar = materialise(stars.unionByName(others).distinct())

    repeated = keys.select("doc_id", "line_no", "set_a", "set_b", "n").join(
        classes.select("set_a", "set_b", "n", "place"), ["set_a", "set_b", "n"])
    decided = repeated.join(similar.select(
        F.struct(F.col("doc").alias("doc_id"), F.col("line").alias("line_no")).alias("place"),
        F.lit(True).alias("similar")), "place", "left")
    return decided.where(
        F.col("similar") | (F.struct("doc_id", "line_no") > F.col("place"))).select(
        "doc_id", "line_no").distinct()


def removed_per_document(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text",
                         **options) -> DataFrame:
    """(doc_id, n_lines, removed) for every row: the numbers of the lines that
    go, ascending."""
    gone = later_lines(docs, doc_id=doc_id, text=text, **options).groupBy("doc_id").agg(
        F.sort_array(F.collect_list("line_no")).alias("removed"))
    lines = F.coalesce(F.size(F.split(F.col(text), "\n")), F.lit(0))
    base = docs.select(F.col(doc_id).alias("doc_id"),
                       F.when(F.col(text).isNull(), 0).otherwise(lines).alias("n_lines"))
    return base.join(gone, "doc_id", "left").select(
        "doc_id", "n_lines", F.coalesce("removed", F.array().cast("array<int>")).alias("removed"))


def dedup_lines(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text",
                drop_emptied: bool = False, any_space: bool = False, **options) -> DataFrame:
    """``docs`` with the later lines taken out of the text; same columns. A
    document that loses all its words keeps a blank text, or goes too with
    ``drop_emptied``; texts without words before stay in either case."""
    gone = materialise(later_lines(docs, doc_id=doc_id, text=text, any_space=any_space, **options).groupBy("doc_id").agg(
        F.collect_list("line_no").alias("removed")).select(
        F.struct("doc_id", "removed").alias("_gone")))
    lines_gone = gone.agg(F.sum(F.size("_gone.removed"))).first()[0] or 0
    side = checked(gone) if lines_gone <= BROADCAST_LINES else gone
    kept = F.filter(F.split(F.col(text), "\n"),
                    lambda line, k: ~F.array_contains(F.col("_gone.removed"), k))
    joined = docs.join(side, F.col(doc_id) == F.col("_gone.doc_id"), "left")
    cleaned = F.when(F.col("_gone").isNull(), F.col(text)).otherwise(F.array_join(kept, "\n"))
    if drop_emptied:
        emptied = F.col("_gone").isNotNull() & (F.trim(blanked(F.array_join(kept, " "), any_space)) == "")
        joined = joined.where(~emptied)
    return joined.select(*[cleaned.alias(c) if c == text else F.col(c) for c in docs.columns])
