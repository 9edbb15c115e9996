"""PII surrogates: keyed, type-consistent replacements, DataFrame functions only.

Detected: e-mail addresses, IPv4 addresses, phone numbers, payment cards (Luhn
and issuer digit), US social security numbers, IBANs, hexadecimal secrets, and
persons. A person is found by a title: up to three capitalised names after it, or
up to two in a script without case; in Han script names stand before the title,
Chinese ones begin with a name of ``HAN_SURNAMES``. All other mentions of these
names in the same document are persons too, if they begin with a capital or an
uncased letter; a single Han character alone is none. A person without a title
anywhere in the document is not found. A mention is cut into parts; a part that is personal has a
type and a normal form (an address in lower case, the digits of a number, one
name of a person), everything else of it stays. A part's surrogate follows from
the key, its type and its normal form alone, so equal entities get equal
surrogates in every document, also in another layout or case: characters are
replaced by characters of the same script and case, digits by digits (cards keep
their first digit and pass Luhn, addresses stay in range), names end as names of
the title's gender do, and punctuation stays.

Collisions: the distinct entities are a table. Where two of a type would get the
same surrogate, or a surrogate is itself an entity of the corpus, the entity is
drawn again with the next attempt (names also grow by a letter) until there are
none, so distinct entities stay distinct.

Nulls, empty texts and texts without mentions are returned as they are. Repeated
rows each get the same replacements. Empty tables give empty results, extra
columns are carried.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keepwell.llm.sides import checked
from keepwell.session import materialise

# --- fixed values: titles, alphabets by script (lower case), vowels ---
MALE_TITLES = ("Mr", "Herr", "Señor", "Monsieur", "господин", "Господин", "г-н", "Г-н", "κύριος", "Κύριος", "السيد", "מר", "श्री")
FEMALE_TITLES = ("Mrs", "Ms", "Miss", "Frau", "Mme", "Mlle", "Señora", "Señorita", "Madame", "госпожа", "Госпожа", "г-жа", "Г-жа",
                 "κυρία", "Κυρία", "السيدة", "الآنسة", "גברת", "श्रीमती")
HAN_TITLES = ("先生", "女士", "小姐", "太太")
JAPANESE_TITLES = ("さん", "様", "氏")
HAN_SURNAMES = ("欧阳", "司马", "诸葛", "上官", *"王李张張刘劉陈陳杨楊赵趙黄黃周吴吳徐孙孫胡朱高林何郭马馬罗羅梁宋郑鄭谢謝韩韓唐冯馮于董萧蕭程曹袁邓鄧许許傅沈曾彭吕呂"
                "苏蘇卢盧蒋蔣蔡贾賈丁魏薛叶葉阎余潘杜戴夏钟鍾汪田任姜范方石姚谭譚廖邹鄒熊金陆陸郝孔白崔康毛邱秦江史顾顧侯邵孟龙龍万萬段雷钱錢汤湯尹黎易常武乔喬贺賀赖賴龚龔文")
ALPHABETS = {
    "latin": "abcdefghijklmnopqrstuvwxyz",
    "greek": "αβγδεζηθικλμνξοπρστυφχψω",
    "cyrillic": "абвгдежзиклмнопрстуфхцчшэюя",
    "hebrew": "אבגדהוזחטיכלמנסעפצקרשת",
    "arabic": "ابتثجحخدذرزسشصضطظعغفقكلمنهوي",
    "han": "王李张刘陈杨赵黄周吴徐孙胡朱高林何郭马罗",
    "hangul": "가나다라마바사아자차하강고구도동미민서선성수영우윤은이재정주준지진철현호희",
    "hiragana": "あいうえおかきくけこさしすせそたちつてとなにぬねのはまみむめもやゆよらりるれわ",
    "katakana": "アイウエオカキクケコサシスセソタチツテトナニヌネノハマミムメモヤユヨラリルレワ",
    "devanagari": "कखगघचछजझटठडढतथदधनपफबभमयरलवशषसह",
}
SCRIPT_RANGES = {
    "greek": r"\p{IsGreek}", "cyrillic": r"\p{IsCyrillic}", "hebrew": r"\p{IsHebrew}",
    "arabic": r"\p{IsArabic}", "han": r"\p{IsHan}",
    "hangul": r"\p{IsHangul}", "hiragana": r"\p{IsHiragana}", "katakana": r"\p{IsKatakana}",
    "devanagari": r"\p{IsDevanagari}", "latin": r"\p{IsLatin}",
}
VOWELS, CONSONANTS = "aeiou", "bdfgklmnprstv"
NAME_ENDINGS = {"latin": {"f": "a", "m": "o"}, "cyrillic": {"f": "а", "m": "н"}, "greek": {"f": "α", "m": "ο"}}
# --- end of fixed values ---

_REST = r"(?:[\p{L}\p{M}-]|['’](?!s(?!\p{L})))"
_NAME = rf"\p{{Lu}}{_REST}+"
_UNCASED = rf"(?!\p{{IsHan}})\p{{Lo}}{_REST}+|\p{{IsHan}}{{1,4}}(?!\p{{L}})"
PATTERNS = {
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]{1,64}+@(?:[\p{L}\p{N}-]{1,63}+\.){1,8}\p{L}{2,24}+(?![\p{L}\p{N}@])",
    "ip": r"(?<![\p{L}\p{N}.])(?:\d{1,3}\.){3}\d{1,3}(?![\p{L}\p{N}]|\.\d)",
    "ssn": r"(?<![\p{L}\p{N}-])\d{3}-\d{2}-\d{4}(?![\p{L}\p{N}-])",
    "phone": r"(?<![\p{L}\p{N}+])(?:\+\d{1,3}[ .-]?)?\(?\d{3}\)?[ .-]\d{3}[ .-]\d{4}(?![\p{L}\p{N}])"
             r"|(?<![\p{L}\p{N}+])(?:\+\d{1,3}[ .-]?)?\(\d{3}\)[ .-]?\d{3}[ .-]?\d{4}(?![\p{L}\p{N}])"
             r"|(?<![\p{L}\p{N}+])\+\d{1,3}(?:[ .-]?\d{2,4}){2,5}(?![\p{L}\p{N}])",
    "card": r"(?<![\p{L}\p{N}])\d(?:[ -]?\d){12,18}(?![\p{L}\p{N}])",
    "iban": r"(?<![\p{L}\p{N}])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![\p{L}\p{N}])",
    "secret": r"(?<![\p{L}\p{N}])[0-9a-fA-F]{32,}+(?![\p{L}\p{N}])",
    "person": r"(?<!\p{L})(?:" + "|".join(MALE_TITLES + FEMALE_TITLES) + rf")\.? (?:{_NAME}(?: {_NAME}){{0,2}}|(?:{_UNCASED})(?: (?:{_UNCASED}))?)",
    "entitled": "(?:" + "|".join(HAN_SURNAMES) + r")\p{IsHan}{0,2}(?:" + "|".join(HAN_TITLES) + ")"
                r"|(?<!\p{IsHan})[\p{IsHan}]{2,4}(?:" + "|".join(JAPANESE_TITLES) + ")",
}
#: Han names begin anywhere in a run of letters, the others do not.
PATTERN = r"(?:(?<![\p{L}\p{N}])(?:" + "|".join(f"(?:{p})" for k, p in PATTERNS.items() if k != "entitled") + f")|{PATTERNS['entitled']})"
_AFTER = "(?:" + "|".join(HAN_TITLES + JAPANESE_TITLES) + ")$"
#: What every mention holds: texts without it are not searched any further.
HINT = "[0-9@]|(?:" + "|".join(MALE_TITLES + FEMALE_TITLES) + ")[. ]|[a-fA-F]{32}|\\p{IsHan}(?:" + "|".join(HAN_TITLES + JAPANESE_TITLES) + ")"


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the last digit checks the others."""
    def add(total: Column, k: Column) -> Column:
        digit = F.substring(digits, F.length(digits) - k, F.lit(1)).cast("int")
        twice = digit * 2
        return total + F.when(k % 2 == 0, digit).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))
    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), add) % 10 == 0


def with_kind(rows: DataFrame) -> DataFrame:
    """``rows`` with a ``mention`` plus its ``digits`` and ``kind``; the kind is
    null for what only looks like a mention, and ``named`` for words that are
    among the document's ``names``."""
    rows = rows.withColumn("digits", _digits(F.col("mention")))
    rows = rows.withColumn("checked", luhn(F.col("digits")))
    mention = F.col("mention")
    octets = F.forall(F.split(mention, "[.]"), lambda x: x.cast("int") <= 255)
    kind = F.lit(None).cast("string")
    for name in reversed(PATTERNS):
        found = mention.rlike(f"^(?:{PATTERNS[name]})$")
        if name == "card":
            found = found & mention.rlike("^[2-6]") & F.col("checked")
        if name == "ip":
            found = found & octets
        kind = F.when(found, name).otherwise(kind)
    named = F.forall(F.split(mention, " "), lambda w: F.map_contains_key("names", F.lower(w)))
    kind = F.coalesce(kind, F.when((F.size("names") > 0) & named, "named"))
    return rows.withColumn("kind", kind).drop("checked")


def with_parts(rows: DataFrame) -> DataFrame:
    """``rows`` of ``with_kind`` with one row per part of the mention: (piece,
    kind, raw, normal); a part without a kind stays as it is."""
    mention, kind = F.col("mention"), F.col("kind")

    def part(k: Column, raw: Column, normal: Column) -> Column:
        return F.struct(k.cast("string").alias("kind"), raw.alias("raw"), normal.alias("normal"))

    rows = rows.withColumns({
        "whole": F.when(kind.isin("card", "ssn"), F.col("digits")).when(
            kind == "phone", F.right("digits", F.lit(10))).when(
            kind.isin("email", "iban"), F.lower(F.replace(mention, F.lit(" "), F.lit("")))).otherwise(mention),
        "words": F.split(mention, " "),
        "given": F.when(F.regexp_replace(F.substring_index(mention, " ", 1), "[.]$", "").isin(*MALE_TITLES),
                        "given_m").otherwise("given_f")})

    def name(word: Column, k: Column) -> Column:
        role = F.when(k == 0, F.lit(None)).when(k == F.size("words") - 1, "surname").otherwise(F.col("given"))
        role = F.when(kind == "named", F.element_at("names", F.lower(word))).otherwise(role)
        return part(role, F.concat(F.when(k > 0, F.lit(" ")).otherwise(""), word), F.lower(word))

    before = F.regexp_replace(mention, _AFTER, "")
    entitled = F.array(part(F.lit("surname"), before, before),
                       part(F.lit(None), F.substring(mention, F.length(before) + 1, F.length(mention)), F.lit("")))
    parts = F.when(kind.isin("person", "named"), F.transform("words", name)).when(
        kind == "entitled", entitled).otherwise(F.array(part(kind, mention, F.col("whole"))))
    kept = [c for c in rows.columns if c not in ("mention", "digits", "kind", "whole", "words", "given", "names")]
    return rows.select(*kept, F.posexplode(parts).alias("piece", "part")).select(*kept, "piece", "part.*")


def _stream(key: str, kind: Column, normal: Column, attempt: Column) -> Column:
    """128 hexadecimal digits that follow from the key and the entity."""
    seed = F.concat_ws("\u001f", F.lit(key), kind, attempt.cast("string"), normal)
    return F.concat(F.sha2(seed, 256), F.sha2(F.concat(seed, F.lit("\u001fmore")), 256))


def _draw(stream: Column, k: Column, size: int) -> Column:
    """A number below ``size``, the k-th of the stream (which repeats)."""
    return F.conv(F.substring(stream, F.pmod(k * 4, F.lit(125)) + 1, F.lit(4)), 16, 10).cast("int") % size


def _pick(alphabet: str, at: Column) -> Column:
    return F.substring(F.lit(alphabet), at + 1, F.lit(1))


def _letter(c: Column, k: Column, stream: Column) -> Column:
    # Letters of a script without an alphabet here become Latin ones.
    out = _pick(ALPHABETS["latin"], _draw(stream, k, len(ALPHABETS["latin"])))
    for script in reversed(SCRIPT_RANGES):
        letters = ALPHABETS[script]
        out = F.when(c.rlike(f"^{SCRIPT_RANGES[script]}$"), _pick(letters, _draw(stream, k, len(letters)))).otherwise(out)
    drawn = F.when(c.rlike("^[0-9]$"), _draw(stream, k, 10).cast("string")).when(c.rlike(r"^\p{L}$"), out).otherwise(c)
    return F.when(c.rlike(r"^\p{Lu}$"), F.upper(drawn)).otherwise(drawn)


def _each(text: Column, change) -> Column:
    return F.array_join(F.transform(F.split(text, ""), change), "")


def _number(raw: Column, stream: Column, keep_first: Column) -> Column:
    """Digits replaced, counted from the right, in the layout of ``raw``; those
    beyond ten from the right stay, but of a card only the first one."""
    count = F.length(_digits(raw))

    def change(c: Column, k: Column) -> Column:
        place = count - F.length(_digits(F.substring(raw, F.lit(1), k + 1)))
        mine = c.rlike("^[0-9]$") & F.when(keep_first, place < count - 1).otherwise(place < 10)
        return F.when(mine, _draw(stream, place, 10).cast("string")).otherwise(c)
    return _each(raw, change)


def _check_digit(body: Column) -> Column:
    """The digit that makes ``body`` and it pass Luhn."""
    def add(total: Column, k: Column) -> Column:
        digit = F.substring(body, F.length(body) - k, F.lit(1)).cast("int")
        twice = digit * 2
        return total + F.when(k % 2 == 1, digit).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))
    total = F.aggregate(F.sequence(F.lit(0), F.length(body) - 1), F.lit(0), add)
    return ((10 - total % 10) % 10).cast("string")


def _ip(stream: Column) -> Column:
    return F.concat_ws(".", *[(_draw(stream, F.lit(k), 254) + 1).cast("string") for k in range(4)])


def _name_text(raw: Column, kind: Column, stream: Column, attempt: Column) -> Column:
    """A name of the same length (one letter longer per attempt), script and
    case; Latin names alternate consonants and vowels."""
    bare = F.ltrim(raw)
    long = F.concat(bare, F.repeat(F.right(bare, F.lit(1)), attempt))
    last = F.length(bare) + attempt - 1

    def change(c: Column, k: Column) -> Column:
        plain = F.when(k % 2 == 0, _pick(CONSONANTS, _draw(stream, k, len(CONSONANTS)))).otherwise(
            _pick(VOWELS, _draw(stream, k, len(VOWELS))))
        latin = F.when(c.rlike(r"^\p{Lu}$"), F.upper(plain)).otherwise(plain)
        out = F.when(c.rlike(r"^\p{IsLatin}$"), latin).otherwise(_letter(c, k, stream))
        for script, ends in NAME_ENDINGS.items():
            for gender, end in ends.items():
                out = F.when((k == last) & (k > 0) & (kind == f"given_{gender}")
                             & c.rlike(f"^{SCRIPT_RANGES[script]}$"), F.lit(end)).otherwise(out)
        return out
    return F.concat(F.when(raw.startswith(" "), F.lit(" ")).otherwise(""), _each(long, change))


def with_surrogate(rows: DataFrame, key: str, name: str) -> DataFrame:
    """``rows`` of (kind, raw, normal, attempt, ...) with the surrogate of the
    raw text as ``name``. In steps, so that nothing is computed per character
    that depends on the entity alone."""
    kind, raw, stream = F.col("kind"), F.col("raw"), F.col("_stream")
    rows = rows.withColumn("_stream", _stream(key, kind, F.col("normal"), F.col("attempt")))
    hexadecimal = _each(raw, lambda c, k: F.when(
        c.rlike("^[A-F]$"), F.upper(_pick("0123456789abcdef", _draw(stream, k, 16)))).otherwise(
        _pick("0123456789abcdef", _draw(stream, k, 16))))
    # The top-level domain of an address and the country of an account stay.
    top = F.substring_index(raw, ".", -1)
    mail = F.concat(_each(F.substring(raw, F.lit(1), F.length(raw) - F.length(top)),
                          lambda c, k: _letter(c, k, stream)), top)
    account = F.concat(F.substring(raw, 1, 2), _each(
        F.substring(raw, F.lit(3), F.length(raw)), lambda c, k: _letter(c, k, stream)))
    drawn = F.when(kind.isNull(), raw).when(kind == "email", mail).when(kind == "ip", _ip(stream)).when(
        kind.isin("card", "phone", "ssn"), _number(raw, stream, kind == "card")).when(
        kind == "iban", account).when(kind == "secret", hexadecimal).otherwise(
        _name_text(raw, kind, stream, F.col("attempt")))
    rows = rows.withColumn("_drawn", drawn)
    rows = rows.withColumn("_body", F.substring("_drawn", F.lit(1), F.length("_drawn") - 1))
    rows = rows.withColumn("_digits", _digits(F.col("_body")))
    card = F.concat("_body", _check_digit(F.col("_digits")))
    return rows.withColumn(name, F.when(kind == "card", card).otherwise(F.col("_drawn"))).drop(
        "_stream", "_drawn", "_body", "_digits")


def mentions(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, print, place, mention, kind) of every valid mention."""
    found = _found(docs, doc_id, text)
    return with_kind(found.select("doc_id", "print", "names", F.posexplode("mentions").alias("place", "mention"))).drop(
        "digits", "names").where("kind IS NOT NULL").withColumn(
        "kind", F.when(F.col("kind").isin("named", "entitled"), "person").otherwise(F.col("kind")))


def _found(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc_id, print, mentions, names, pattern) of the texts with mentions; names
    has the role of each name of a person, pattern finds those names alone."""
    first = docs.where(F.col(text).rlike(HINT)).select(
        F.col(doc_id).cast("string").alias("doc_id"), F.xxhash64(text).alias("print"), F.col(text).alias("text"),
        F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0)).alias("mentions")).where(F.size("mentions") > 0)
    first = first.withColumn("names", names_of(F.col("mentions")))
    first = first.withColumn("pattern", F.when(F.size("names") > 0, name_pattern(F.map_keys("names"))))
    again = F.regexp_extract_all("text", F.concat(F.lit(PATTERN), F.col("pattern")), F.lit(0))
    return first.select("doc_id", "print", F.when(F.col("pattern").isNull(), F.col("mentions")).otherwise(again).alias("mentions"),
                        "names", "pattern")


def names_of(mentions: Column) -> Column:
    """Map from the names of the persons among ``mentions``, in lower case, to
    their roles; a name with several roles is a surname before a given name."""
    def entry(role: Column, word: Column) -> Column:
        return F.struct(role.cast("string").alias("role"), F.lower(word).alias("name"))

    def of(mention: Column) -> Column:
        words = F.split(mention, " ")
        given = F.when(F.regexp_replace(F.element_at(words, 1), "[.]$", "").isin(*MALE_TITLES), "given_m").otherwise("given_f")
        after = F.transform(words, lambda w, k: entry(F.when(k == F.size(words) - 1, "surname").otherwise(given), w))
        return F.when(mention.rlike(f"^(?:{PATTERNS['entitled']})$"), F.array(
            entry(F.lit("surname"), F.regexp_replace(mention, _AFTER, "")))).when(
            mention.rlike(f"^(?:{PATTERNS['person']})$"), F.slice(after, F.lit(2), F.size(words))).otherwise(
            F.slice(after, 1, 0))

    entries = F.array_sort(F.array_distinct(F.flatten(F.transform(mentions, of))))
    # array_sort puts given names first, and later entries of a name win.
    return F.aggregate(entries, F.create_map().cast("map<string,string>"), lambda held, e: F.map_concat(
        F.map_filter(held, lambda name, _: name != e["name"]), F.create_map(e["name"], e["role"])))


def name_pattern(names: Column) -> Column:
    """What PATTERN needs behind it to find the names alone, too; longer names
    first, so that none hides another."""
    names = F.reverse(F.array_sort(names))
    han = F.filter(names, lambda n: n.rlike(r"^\p{IsHan}{2,}$"))
    spaced = F.filter(names, lambda n: ~n.rlike(r"^\p{IsHan}+$"))
    one = F.concat(F.lit(r"(?=[\p{Lu}\p{Lo}])(?iu:"), F.array_join(spaced, "|"), F.lit(r")(?![\p{L}\p{M}\p{N}])"))
    alone = F.concat(F.lit(r"|(?<![\p{L}\p{M}\p{N}])"), one, F.lit("(?: "), one, F.lit("){0,2}"))
    return F.concat(F.when(F.size(spaced) > 0, alone).otherwise(""),
                    F.when(F.size(han) > 0, F.concat(F.lit("|(?:"), F.array_join(han, "|"), F.lit(")"))).otherwise(""))


def settled(entities: DataFrame, key: str) -> DataFrame:
    """(kind, normal, attempt) with distinct surrogates that are no entities."""
    now = materialise(entities.select("kind", "normal").distinct().withColumn("attempt", F.lit(0)))
    while True:
        drawn = materialise(with_surrogate(now.withColumn("raw", F.col("normal")), key, "drawn").withColumn(
            "drawn", F.lower("drawn")))
        first = drawn.groupBy("kind", "drawn").agg(F.min("normal").alias("owner"), F.count("*").alias("n"))
        real = drawn.select("kind", F.col("normal").alias("drawn"), F.lit(True).alias("real"))
        judged = drawn.join(first.where("n > 1").select("kind", "drawn", "owner"), ["kind", "drawn"], "left").join(
            real, ["kind", "drawn"], "left")
        again = F.col("real").isNotNull() | (F.col("owner").isNotNull() & (F.col("owner") != F.col("normal")))
        judged = materialise(judged.select("kind", "normal", (F.col("attempt") + again.cast("int")).alias("attempt"), again.alias("again")))
        if judged.where("again").isEmpty():
            return judged.drop("again")
        now = judged.drop("again")


def replace_entities(docs: DataFrame, key: str, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with surrogates in the text, plus ``n_entities`` (mentions
    replaced) and ``entity_kinds`` (their types, sorted, distinct)."""
    found = materialise(_found(docs, doc_id, text))
    parts = materialise(with_parts(with_kind(found.select(
        "doc_id", "print", "names", F.posexplode("mentions").alias("place", "mention")))).distinct())
    attempts = settled(parts.where("kind IS NOT NULL"), key)
    known = parts.join(attempts, ["kind", "normal"], "left").withColumn("attempt", F.coalesce("attempt", F.lit(0)))
    drawn = with_surrogate(known, key, "new").select("doc_id", "print", "place", "piece", "kind", "new")
    whole = drawn.groupBy("doc_id", "print", "place").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("piece", "new"))), lambda x: x["new"]), "").alias("new"),
        F.max("kind").alias("kind"))
    family = F.when(F.col("kind").isin("surname", "given_m", "given_f"), "person").otherwise(F.col("kind"))
    listed = materialise(whole.groupBy("doc_id", "print").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("place", "new"))), lambda x: x["new"]).alias("new"),
        F.count("kind").alias("n"), F.array_sort(F.collect_set(family)).alias("kinds")).join(
        found.select("doc_id", "print", "pattern").distinct().withColumnsRenamed({"doc_id": "d", "print": "p"}),
        F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("print") == F.col("p"))).select(
        F.struct("doc_id", "print", "new", "n", "kinds", "pattern").alias("_pii")))
    joined = docs.join(
        checked(listed), F.col(doc_id).cast("string").eqNullSafe(F.col("_pii.doc_id"))
        & (F.xxhash64(text) == F.col("_pii.print")), "left")
    pieces = F.split(text, F.concat(F.lit(PATTERN), F.coalesce("_pii.pattern", F.lit(""))), -1)
    woven = F.array_join(F.flatten(F.zip_with(
        pieces, F.col("_pii.new"), lambda a, b: F.array(a, F.coalesce(b, F.lit(""))))), "")
    cleaned = F.when(F.col("_pii").isNull(), F.col(text)).otherwise(woven)
    return joined.select(
        *[cleaned.alias(c) if c == text else F.col(c) for c in docs.columns],
        F.coalesce("_pii.n", F.lit(0)).cast("long").alias("n_entities"),
        F.coalesce(F.array_join("_pii.kinds", ","), F.lit("")).alias("entity_kinds"))
