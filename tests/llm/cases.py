"""Small awkward tables and helpers the operator tests share."""

import random
import re

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
#: Extra columns whose names an operator might use for itself.
CLASHES = "row string, spans int, items int, words int, key int, component string, a int, b int, x int, " \
          "y int, doc string, line string, prefix int, keys int, removed int, first int, n int, _id int, shard string"
CLASH_VALUES = ("r", 1, 2, 3, 4, "c", 5, 6, 7, 8, "d", "l", 9, 10, 11, 12, 13, 14, "s")


def lower(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")


def prose(seed, n, vocabulary=400):
    rng = random.Random(seed)
    words = ["w%03d" % rng.randrange(vocabulary) if rng.random() < 0.9 else "ÉTÉ-%d" % rng.randrange(9)
             for _ in range(n)]
    return " ".join(w + (".\n" if rng.random() < 0.1 else "") for w in words)


def awkward(seed=1):
    """(doc_id, text): plain, near copies, repeated rows, null, empty, blank,
    one word, very long, long without a blank, other white space and scripts."""
    base = prose(seed, 120)
    near = base.split(" ")
    texts = [base, " ".join(near[:60] + ["changed"] + near[61:]), base.upper(), base, None, "", "  \t\n ", "word",
             "two words", prose(seed + 1, 30_000), "x" * 40_000, "a\tb\rc d e　f",
             "日本語 テキスト", "<|endoftext|> and <|endo", base + " tail"]
    rows = list(enumerate(texts))
    return rows + [rows[0], rows[4], rows[5]]


def documents(spark, rows, clashes=True):
    if not clashes:
        return spark.createDataFrame(rows, "doc_id long, text string")
    return spark.createDataFrame([(*r, *CLASH_VALUES) for r in rows], f"doc_id long, text string, {CLASHES}")


def groups(items, linked):
    """Least member reachable by links, per item (brute force)."""
    parent = {i: i for i in items}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in items:
        for j in items:
            if i < j and linked(i, j):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in items}
