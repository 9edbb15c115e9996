"""Removal of long byte strings that occur more than once in a corpus, by suffix
arrays.

Every string of ``size`` bytes is dealt out by its anchor, the least hash of its
``GRAM``-byte pieces: equal strings have equal anchors, so they meet in one place.
Neighbouring strings with one anchor form a segment; equal segments are one class
that counts for all of them. All classes of an anchor that occurs at two places
or more go to one task, which builds a suffix array over the content-defined places of
their bytes (``lyndon_suffixes``). A string repeats if the suffixes with at least
``size`` equal bytes hold it more than once. Texts are never gathered: segments
are some 550 bytes, and an anchor with more than ``MOST_CLASSES`` classes has its
strings counted one by one over the cluster instead, with the same result.

Nulls and empty texts: zero bytes, no spans, a row all the same. Ties and repeated
rows: each row by itself, so a repeated row of ``size`` bytes or more is removed
in every copy. Empty tables: empty result. Extra columns of the input are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keepwell.llm.lyndon_suffixes import suffix_array
from keepwell.llm.sides import checked
from keepwell.llm.textblocks import blocks, mix, text_bytes
from keepwell.llm.wordlists import texts
from keepwell.session import materialise, shuffle_partitions

SIZE = 400
GRAM = 96
#: Places of a suffix array: one in every STEP bytes, by the least hash of PIECE bytes.
PIECE, STEP = 8, 48
MOST_CLASSES = 4_096
MOST_STARTS = 2_048
BLOCK_BYTES = 1_000_000
_PAD = 0xFF                                     # no byte of a UTF-8 text
_BASE = 0xD6E8FEB86659FD93
_rng = np.random.default_rng(11)
_VALUE = _rng.integers(1, 2**63, 256, dtype=np.uint64)
_TAIL = _rng.integers(1, 2**63, (STEP, 256), dtype=np.uint64)


def _gram_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` bytes (len - size + 1), by doubling."""
    n = len(data) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    run, length, out, done = _VALUE[data], 1, np.zeros(n, np.uint64), 0
    while True:
        if size & length:
            out = out * np.uint64(pow(_BASE, length, 2**64)) + run[done:done + n]
            done += length
        if 2 * length > size:
            return mix(out)
        factor = np.uint64(pow(_BASE, length, 2**64))
        run = run[:-length] * factor + run[length:]
        length *= 2


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Least value of every run of ``width`` values, by doubling."""
    length = 1
    while 2 * length <= width:
        values = np.minimum(values[:-length], values[length:])
        length *= 2
    more = width - length
    return np.minimum(values[:len(values) - more], values[more:])


def _least_places(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the first least value of every run of ``width`` values."""
    best, length = np.arange(len(values)), 1
    while 2 * length <= width:
        a, b = best[:-length], best[length:]
        best = np.where(values[b] < values[a], b, a)
        length *= 2
    a, b = best[:len(values) - width + 1], best[width - length:]
    return np.where(values[b] < values[a], b, a)


def segments_of(data: np.ndarray, offsets: np.ndarray, size: int, gram: int) -> tuple[np.ndarray, ...]:
    """(first start, number of starts, anchor, whether the anchor stands at several
    places in it) of the segments of texts that follow each other in ``data``. The
    bytes are read in slices, and a run of one anchor is cut after MOST_STARTS."""
    width = size - gram + 1
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, bool))]
    for low in range(0, len(data) - size + 1, BLOCK_BYTES):
        hashes = _gram_hashes(data[low:low + BLOCK_BYTES + size - 1], gram)
        least = _least(hashes, width)
        at = np.arange(low, low + len(least))
        doc = np.searchsorted(offsets, at, "right") - 1
        fits = at + size <= offsets[doc + 1]
        new = np.ones(len(least), bool)             # the first start of a segment
        new[1:] = (least[1:] != least[:-1]) | (doc[1:] != doc[:-1]) | ~fits[:-1]
        begin = np.flatnonzero(new & fits)
        stop = np.append(np.flatnonzero(new | ~fits), len(least))
        end = stop[np.searchsorted(stop, begin, "right")]
        parts = -(-(end - begin) // MOST_STARTS)
        part = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        begin, end = np.repeat(begin, parts) + part * MOST_STARTS, np.repeat(end, parts)
        n = np.minimum(end - begin, MOST_STARTS)
        view, anchor, last = sliding_window_view(hashes, width), least[begin], begin + n - 1
        several = (begin + (view[begin] == anchor[:, None]).argmax(axis=1)
                   != last + (view[last] == anchor[:, None]).argmax(axis=1))
        found.append((begin + low, n, anchor, several))
    return tuple(np.concatenate(x) for x in zip(*found))


def _segment_rows(batch: pa.RecordBatch, size: int, gram: int) -> pa.RecordBatch:
    data, offsets = text_bytes(batch.column("text"))
    first, starts, anchor, several = segments_of(data, offsets, size, gram)
    doc = np.searchsorted(offsets, first, "right") - 1
    raw = data.tobytes()
    label = [hashlib.blake2b(raw[a:a + k + size - 1], digest_size=16).digest()
             for a, k in zip(first.tolist(), starts.tolist())]
    which = pa.array(doc, pa.int64())
    return pa.RecordBatch.from_arrays(
        [batch.column("doc_id").take(which), batch.column("digest").take(which), pa.array(first - offsets[doc]),
         pa.array(starts), pa.array(anchor.view(np.int64)), pa.array(several), pa.array(label, pa.binary())],
        names=["doc_id", "digest", "first", "starts", "anchor", "several", "label"])


class SegmentArray:
    """The suffix array of several classes of segments.

    ``texts`` are their bytes, ``starts`` their numbers of strings, ``times`` how
    often each class occurs. A place is chosen by the bytes right of it alone, and
    a string belongs to the least piece among its first ones, so equal strings
    have equal places. A symbol is the bytes from a place on up to where the next
    one is settled; symbols have one length, so the order is that of the bytes.
    """

    def __init__(self, texts: list[bytes], starts: np.ndarray, times: np.ndarray, size: int):
        self.size, self.times = size, times
        length = np.array([len(t) for t in texts])
        self.begin = np.cumsum(length + size) - (length + size)
        self.data = np.full(int((length + size).sum()) + STEP + PIECE, _PAD, np.uint8)
        for at, text in zip(self.begin.tolist(), texts):
            self.data[at:at + len(text)] = np.frombuffer(text, np.uint8)
        place = _least_places(_gram_hashes(self.data, PIECE), STEP)
        owner = np.repeat(np.arange(len(texts)), length)
        inside = np.arange(len(owner)) - np.repeat(np.cumsum(length) - length, length)
        string = self.begin[owner] + inside                # every byte of a segment
        is_start = inside < starts[owner]
        self.string, self.owner = string[is_start], owner[is_start]
        own = place[string]
        own = own[own < (self.begin + length)[owner]]
        self.places = np.unique(own)
        self.first_place = np.searchsorted(self.places, place[self.string])
        self.order = self._suffixes(np.searchsorted(self.begin, self.places, "right") - 1)

    def _suffixes(self, owner: np.ndarray) -> np.ndarray:
        width = STEP + PIECE
        symbols = sliding_window_view(self.data, width)[self.places]
        columns = np.ascontiguousarray(symbols).view(">u8").astype(np.uint64)
        by = np.lexsort(columns.T[::-1])
        new = np.ones(len(by), np.int64)
        new[1:] = (columns[by[1:]] != columns[by[:-1]]).any(axis=1)
        rank = np.empty(len(by), np.int64)
        rank[by] = np.cumsum(new)
        # The end of a segment is a symbol below all others.
        slot = np.arange(len(rank)) + owner - owner[0]
        line = np.zeros(int(slot[-1]) + 1, np.int64)
        line[slot] = rank
        back = np.full(len(line), -1)
        back[slot] = np.arange(len(rank))
        order = back[np.array(suffix_array(line.tolist()))]
        return order[order >= 0]

    def _common(self, order: np.ndarray) -> np.ndarray:
        """Equal bytes of each suffix in ``order`` and the one before, up to ``size``."""
        rows = sliding_window_view(self.data, self.size)
        out = np.zeros(len(order), np.int64)
        at = self.places[order]
        for k in range(1, len(order), 4_096):
            now = slice(k, min(k + 4_096, len(order)))
            other = rows[at[k - 1:now.stop - 1]] != rows[at[now]]
            found = other.argmax(axis=1)
            out[now] = np.where(other[np.arange(len(found)), found], found, self.size)
        return out

    def repeated(self) -> np.ndarray:
        """Of every string (``owner``, ``string``): whether it occurs again."""
        used = np.zeros(len(self.places), bool)
        used[self.first_place] = True
        order = self.order[used[self.order]]
        common = self._common(order)
        rank = np.empty(len(self.places), np.int64)
        rank[order] = np.arange(len(order))
        ahead = self.places[self.first_place] - self.string    # bytes before the place
        out = np.zeros(len(self.string), bool)
        tail = np.zeros(len(self.string), np.uint64)
        for d in range(int(ahead.max(initial=0)) + 1):
            now = np.flatnonzero(ahead == d)
            for k in range(d):                              # hash of the bytes before it
                tail[now] += _TAIL[k][self.data[self.string[now] + k]]
            run = np.cumsum(common < self.size - d)[rank[self.first_place[now]]]
            key = mix(tail[now]) + run.astype(np.uint64) * np.uint64(_BASE)
            kind, which = np.unique(key, return_inverse=True)
            total = np.bincount(which, self.times[self.owner[now]], len(kind))
            out[now] = total[which] >= 2
        return out


def _runs(marks: np.ndarray) -> list[dict[str, int]]:
    step = np.diff(marks.astype(np.int8), prepend=0, append=0)
    return [{"low": int(a), "high": int(b)}
            for a, b in zip(np.flatnonzero(step == 1), np.flatnonzero(step == -1))]


_DECIDED = "anchor long, label binary, runs array<struct<low: long, high: long>>"
_RUNS = pa.list_(pa.struct([("low", pa.int64()), ("high", pa.int64())]))


def _decide(rows: list[tuple], size: int) -> pa.RecordBatch:
    """(anchor, label, runs of repeated starts) of classes whose anchors are whole."""
    array = SegmentArray([r[3] for r in rows], np.array([len(r[3]) - size + 1 for r in rows]),
                         np.array([r[2] for r in rows]), size)
    marks = array.repeated()
    cut = np.searchsorted(array.owner, np.arange(len(rows) + 1))
    runs = [_runs(marks[cut[k]:cut[k + 1]]) for k in range(len(rows))]
    kept = [k for k, found in enumerate(runs) if found]
    return pa.RecordBatch.from_arrays([
        pa.array([rows[k][0] for k in kept], pa.int64()), pa.array([rows[k][1] for k in kept], pa.binary()),
        pa.array([runs[k] for k in kept], _RUNS)],
        names=["anchor", "label", "runs"])


def _by_suffix_array(classes: DataFrame, size: int) -> DataFrame:
    """Classes (anchor, label, times, content) whose anchors have few of them."""
    def decide(batches):
        held, seen, total = [], set(), 0
        for batch in batches:
            for row in zip(*[batch.column(c).to_pylist() for c in ("anchor", "label", "times", "content")]):
                if held and row[0] != held[-1][0]:
                    seen.clear()
                    if total >= BLOCK_BYTES:
                        yield _decide(held, size)
                        held, total = [], 0
                if row[1] not in seen:
                    seen.add(row[1])
                    held.append(row)
                    total += len(row[3])
        if held:
            yield _decide(held, size)

    return (classes.select("anchor", "label", "times", "content")
            .repartition(shuffle_partitions(classes.sparkSession), "anchor")
            .sortWithinPartitions("anchor").mapInArrow(decide, _DECIDED))


def _one_by_one(classes: DataFrame, size: int) -> DataFrame:
    """The same for anchors with very many classes: their strings by digest."""
    def strings(batches):
        for batch in batches:
            for anchor, label, times, content in zip(*[
                    batch.column(c).to_pylist() for c in ("anchor", "label", "times", "content")]):
                n = len(content) - size + 1
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(n, anchor), pa.int64()), pa.array([label] * n, pa.binary()),
                    pa.array(np.full(n, times), pa.int64()), pa.array(np.arange(n), pa.int64()),
                    pa.array([hashlib.blake2b(content[k:k + size], digest_size=16).digest() for k in range(n)],
                             pa.binary())], names=["anchor", "label", "times", "start", "string"])

    each = materialise(classes.dropDuplicates(["anchor", "label"]).select(
        "anchor", "label", "times", "content").mapInArrow(
        strings, "anchor long, label binary, times long, start long, string binary"))
    again = each.groupBy("string").agg(F.sum("times").alias("all")).where("all > 1").select("string")
    starts = each.join(again, "string").groupBy("anchor", "label").agg(F.collect_list("start").alias("starts"))

    def join(batches):
        for batch in batches:
            found = [_runs(np.bincount(k) > 0) for k in batch.column("starts").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("anchor"), batch.column("label"),
                                              pa.array(found, _RUNS)], names=["anchor", "label", "runs"])

    return starts.mapInArrow(join, _DECIDED)


def repeated_strings(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text",
                     size: int = SIZE, gram: int = GRAM,
                     most_classes: int = MOST_CLASSES) -> DataFrame:
    """(digest, runs): per different text with repeated strings, its SHA-256 and
    the runs [low, high) of byte places at which strings of ``size`` bytes start
    that also start elsewhere."""
    if not 0 < gram <= size - STEP - PIECE:
        raise ValueError(f"gram must be positive and at least {STEP + PIECE} bytes below size")
    rows = _digested(docs, doc_id, text)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def cut(batches):
        for batch in blocks(batches):
            yield _segment_rows(batch, size, gram)

    long = rows.where(F.octet_length("text") >= size)
    segments = materialise(long.mapInArrow(
        cut, f"doc_id {kind}, digest binary, first long, starts long, anchor long, several boolean, label binary"))
    classes = segments.groupBy("anchor", "label").agg(
        F.count("*").alias("times"), F.max("several").alias("several"), F.min(F.struct("digest", "doc_id", "first", "starts")).alias("at"))
    anchors = classes.groupBy("anchor").agg(F.count("*").alias("classes"), F.sum(F.expr("IF(several, 2, times)")).alias("all"))
    classes = materialise(classes.join(
        anchors.where("all > 1").select("anchor", "classes"), "anchor"))
    content = materialise(_contents(long, classes, kind, size))
    found = _by_suffix_array(content.where(F.col("classes") <= most_classes), size)
    if content.where(F.col("classes") > most_classes).limit(1).count():
        found = found.unionByName(_one_by_one(content.where(F.col("classes") > most_classes), size))
    found = materialise(found)
    # Copies of one text have the same places, so they fold before the list is made.
    places = segments.select("digest", "first", "anchor", "label").join(found, ["anchor", "label"]).select(
        "digest", F.explode(F.transform("runs", lambda r: F.struct(
            (r["low"] + F.col("first")).alias("low"), (r["high"] + F.col("first")).alias("high")))).alias("run"))
    return places.groupBy("digest").agg(F.collect_set("run").alias("runs"))


def _digested(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    rows = docs.select(F.col(doc_id).alias("doc_id"),
                       F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    return rows.withColumn("digest", F.unhex(F.sha2("text", 256)))


def _contents(rows: DataFrame, classes: DataFrame, kind: str, size: int) -> DataFrame:
    """The bytes of one segment per class, cut out of the documents that hold them."""
    wanted = materialise(classes.groupBy("at.digest", "at.doc_id").agg(F.collect_list(F.struct(
        "at.first", "at.starts", "anchor", "label", "times", "classes")).alias("parts")))
    holders = rows.join(checked(wanted.select("digest").distinct()), "digest", "left_semi")
    together = holders.alias("r").join(wanted.alias("w"), (F.col("r.digest") == F.col("w.digest"))
                                       & F.col("r.doc_id").eqNullSafe(F.col("w.doc_id")))

    def take(batches):
        for batch in blocks(batches):
            parts = [(text, p) for text, found in zip(texts(batch.column("text")), batch.column("parts").to_pylist())
                     for p in found]
            yield pa.RecordBatch.from_arrays([
                *[pa.array([p[c] for _, p in parts], kind) for c, kind in (
                    ("anchor", pa.int64()), ("label", pa.binary()), ("times", pa.int64()), ("classes", pa.int64()))],
                pa.array([t[p["first"]:p["first"] + p["starts"] + size - 1] for t, p in parts], pa.binary())],
                names=["anchor", "label", "times", "classes", "content"])

    return together.select("r.text", "w.parts").mapInArrow(
        take, "anchor long, label binary, times long, classes long, content binary")


def remove_repeats(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", size: int = SIZE,
                   gram: int = GRAM, most_classes: int = MOST_CLASSES) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, spans (low and high byte of every maximal
    removed run, in order), kept (the remaining bytes, null where nothing was
    removed) and kept_sha256 (lower-case hex)."""
    rows = _digested(docs, doc_id, text)
    found = materialise(repeated_strings(
        docs, doc_id=doc_id, text=text, size=size, gram=gram, most_classes=most_classes))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def cut(batches):
        for batch in blocks(batches):
            spans, kept, removed = [], [], []
            for raw, runs in zip(texts(batch.column("text")), batch.column("runs").to_pylist()):
                mine = _joined(runs, size)
                edges = [0, *[x for span in mine for x in span], len(raw)]
                kept.append(b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2])))
                spans.append([{"low": a, "high": b} for a, b in mine])
                removed.append(sum(b - a for a, b in mine))
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), batch.column("n_bytes"), pa.array(removed, pa.int64()),
                pa.array(spans, _RUNS),
                pa.array(kept, pa.binary()),
                pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string())],
                names=["doc_id", "n_bytes", "n_removed", "spans", "kept", "kept_sha256"])

    schema = (f"doc_id {kind}, n_bytes long, n_removed long, spans array<struct<low: long, high: long>>, "
              "kept binary, kept_sha256 string")
    listed = checked(found.select("digest"))
    rows = rows.withColumn("n_bytes", F.octet_length("text").cast("long"))
    touched = rows.join(listed, "digest", "left_semi").join(found, "digest").select(
        "doc_id", "n_bytes", "text", "runs").mapInArrow(cut, schema)
    whole = rows.join(listed, "digest", "left_anti").select(
        "doc_id", "n_bytes", F.lit(0).cast("long").alias("n_removed"),
        F.array().cast("array<struct<low: long, high: long>>").alias("spans"),
        F.lit(None).cast("binary").alias("kept"), F.lower(F.hex("digest")).alias("kept_sha256"))
    return touched.unionByName(whole)


def _joined(runs: list[dict[str, int]], size: int) -> list[tuple[int, int]]:
    """Byte spans covered by the strings that start in ``runs``, overlaps and
    touching ones joined."""
    out: list[tuple[int, int]] = []
    for run in sorted(runs, key=lambda r: r["low"]):
        low, high = run["low"], run["high"] - 1 + size
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], high))
        else:
            out.append((low, high))
    return out
