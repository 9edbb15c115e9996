"""Language identification by a bidirectional gated recurrent network over bytes.

A text is read as segments of ``SEGMENT`` bytes, the last one shorter, by two
gated recurrent units, one from each end. Both states at a byte give class
probabilities for that byte; a document's probabilities are their mean over all
bytes of the whole text. The units are of the reset-after kind with piecewise
linear gates (clip instead of sigmoid and tanh), which numpy runs several times
faster. Training is backpropagation through the segment in numpy, with Adam.

The fit reads a bounded sample of labelled rows: about ``windows`` documents per
language, one window of ``window_chars`` characters from each; everything is
predicted. Every language is learned: where ``windows`` of each would be more than
``most_rows`` in all, each has up to ``most_rows`` divided by their number, but one
at least.

A text that is null or has no letter is ``und`` with score 0. Rows without a
language are not learned from. Ties go to the language that sorts first. Repeated
rows are predicted each by itself, an empty table gives an empty result, and
extra columns are ignored. Without a single labelled text the fit raises
``ValueError``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from keepwell.llm.sides import checked
from keepwell.llm.textblocks import blocks, text_bytes
from keepwell.session import materialise

SEGMENT = 64
LANES = 2_048               # segments that advance together
SCORE_BLOCK_BYTES = 1_000_000
UNDETERMINED = "und"


@dataclass(frozen=True)
class Settings:
    """``windows`` per language and ``most_rows`` bound the sample."""
    units: int = 8
    epochs: int = 10
    batch: int = 64
    rate: float = 0.01
    windows: int = 500
    window_chars: int = 256
    most_rows: int = 20_000
    seed: int = 23


@dataclass
class Network:
    """``table`` (2, 3u, 256): what a byte adds to update gate, reset gate and
    candidate, forwards and backwards; ``turn`` (2, 3u, u): what the state adds;
    ``out`` (classes, 2u) and ``bias`` (classes, 1)."""
    languages: list[str]
    table: np.ndarray
    turn: np.ndarray
    out: np.ndarray
    bias: np.ndarray

    def states(self, data: np.ndarray, keep: dict | None = None) -> np.ndarray:
        """States (2u, T, B) of the byte columns ``data`` (T, B); both units run
        side by side. ``keep`` collects what the backward pass needs."""
        steps, lanes = data.shape
        u = self.turn.shape[2]
        kind = self.table.dtype
        both = np.stack([data, data[::-1]])
        h = np.zeros((2, u, lanes), kind)
        out = np.empty((2, u, steps, lanes), kind)
        added = np.empty((2, 3 * u, lanes), kind)
        pushed = np.empty((2, 3 * u, lanes), kind)
        for t in range(steps):
            for d in (0, 1):
                self.table[d].take(both[d, t], axis=1, out=added[d], mode="clip")
            np.matmul(self.turn, h, out=pushed)
            gates, n = added[:, :2 * u], added[:, 2 * u:]
            gates += pushed[:, :2 * u]
            np.maximum(gates, 0, out=gates)
            np.minimum(gates, 1, out=gates)
            if keep is not None:
                keep.setdefault("pushed", []).append(pushed[:, 2 * u:].copy())
                keep.setdefault("before", []).append(h.copy())
            pushed[:, 2 * u:] *= gates[:, u:]
            n += pushed[:, 2 * u:]
            np.maximum(n, -1, out=n)
            np.minimum(n, 1, out=n)
            if keep is not None:
                keep.setdefault("gates", []).append(added.copy())
            h -= n
            h *= gates[:, :u]
            h += n
            out[0, :, t] = h[0]
            out[1, :, steps - 1 - t] = h[1]
        return out.reshape(2 * u, steps, lanes)

    def byte_probabilities(self, data: np.ndarray) -> np.ndarray:
        """(classes, T, B)."""
        steps, lanes = data.shape
        z = self.out @ self.states(data).reshape(self.out.shape[1], -1) + self.bias
        z -= z.max(axis=0)
        np.exp(z, out=z)
        z /= z.sum(axis=0)
        return z.reshape(-1, steps, lanes)

    def document_probabilities(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """(documents, classes): means over all bytes; 0 for empty texts."""
        column, valid, doc = segments(data, offsets)
        total = np.zeros((len(self.languages), len(doc)))
        for at in range(0, len(doc), LANES):
            p = self.byte_probabilities(column[:, at:at + LANES])
            total[:, at:at + LANES] = (p * valid[:, at:at + LANES]).sum(axis=1)
        out = np.stack([np.bincount(doc, row, len(offsets) - 1) for row in total], axis=1)
        return out / np.maximum(1, np.diff(offsets))[:, None]


def segments(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte columns (SEGMENT, n), which of their bytes are real, and the
    document of each column."""
    count = -(-np.diff(offsets) // SEGMENT)
    doc = np.repeat(np.arange(len(count)), count)
    start = offsets[doc] + SEGMENT * (np.arange(len(doc)) - (np.cumsum(count) - count)[doc])
    at = start + np.arange(SEGMENT)[:, None]
    valid = at < offsets[doc + 1]
    return np.where(valid, data[np.minimum(at, max(0, len(data) - 1))], 0) if len(doc) else at.astype(
        np.uint8), valid, doc


def fit_windows(texts: list[str], languages: list[str], settings: Settings = Settings()) -> Network:
    """Backpropagation through time on windows; every byte has its window's
    language as target, every language the same weight."""
    known = sorted(set(languages))
    if not known:
        raise ValueError("no labelled text to learn a language from")
    data, offsets = text_bytes(pa.array(texts, pa.string()))
    column, valid, doc = segments(data, offsets)
    target = np.array([known.index(x) for x in languages])[doc]
    weight = len(target) / (len(known) * np.maximum(1, np.bincount(target, minlength=len(known))))[target]
    u, classes = settings.units, len(known)
    rng = np.random.default_rng(settings.seed)
    net = Network(known, rng.normal(0, 0.3, (2, 3 * u, 256)), rng.normal(0, 0.5 / np.sqrt(u), (2, 3 * u, u)),
                  rng.normal(0, 0.3, (classes, 2 * u)), np.zeros((classes, 1)))
    net.table[:, :2 * u] += 0.5
    parts = ("table", "turn", "out", "bias")
    first = {p: np.zeros_like(getattr(net, p)) for p in parts}
    second = {p: np.zeros_like(getattr(net, p)) for p in parts}
    total = settings.epochs * max(1, len(doc) // settings.batch)
    done = 0
    for _ in range(settings.epochs):
        order = rng.permutation(len(doc))
        for at in range(0, len(order), settings.batch):
            chosen = order[at:at + settings.batch]
            slopes = _slopes(net, column[:, chosen], valid[:, chosen], target[chosen], weight[chosen])
            done += 1
            rate = settings.rate * max(0.02, 1 - done / total)
            for p, g in zip(parts, slopes):
                first[p] += 0.1 * (g - first[p])
                second[p] += 0.001 * (g * g - second[p])
                step = first[p] / (1 - 0.9**done) / (np.sqrt(second[p] / (1 - 0.999**done)) + 1e-8)
                getattr(net, p)[...] -= rate * step
    return Network(known, *(np.ascontiguousarray(getattr(net, p), np.float32) for p in parts))


def _slopes(net: Network, data, valid, target, weight):
    """Gradients of the weighted mean cross-entropy over the real bytes."""
    steps, lanes = data.shape
    u = net.turn.shape[2]
    keep: dict[str, list] = {}
    state = net.states(data, keep).reshape(2 * u, -1)
    z = net.out @ state + net.bias
    z = np.exp(z - z.max(axis=0))
    error = (z / z.sum(axis=0)).reshape(-1, steps, lanes)
    error[target, :, np.arange(lanes)] -= 1
    error *= valid * weight / max(1, valid.sum())
    flat = error.reshape(len(error), -1)
    down = (net.out.T @ flat).reshape(2, u, steps, lanes)
    turn = np.zeros_like(net.turn)
    into = np.empty((2, 3 * u, steps, lanes))
    carry = np.zeros((2, u, lanes))
    for t in range(steps - 1, -1, -1):
        gates, pushed, before = keep["gates"][t], keep["pushed"][t], keep["before"][t]
        update, reset, n = gates[:, :u], gates[:, u:2 * u], gates[:, 2 * u:]
        d = carry + np.stack([down[0, :, t], down[1, :, steps - 1 - t]])
        dn = d * (1 - update) * (np.abs(n) < 1)
        du = d * (before - n) * ((update > 0) & (update < 1))
        dr = dn * pushed * ((reset > 0) & (reset < 1))
        into[:, :, t] = np.concatenate([du, dr, dn], axis=1)
        back = np.concatenate([du, dr, dn * reset], axis=1)
        turn += back @ before.transpose(0, 2, 1)
        carry = d * update + net.turn.transpose(0, 2, 1) @ back
    table = np.zeros_like(net.table)
    for k, seen in enumerate((data, data[::-1])):
        for row in range(3 * u):
            table[k, row] = np.bincount(seen.ravel(), into[k, row].ravel(), 256)
    return table, turn, flat @ state.T, flat.sum(axis=1, keepdims=True)


def fit(docs: DataFrame, *, language: str = "lang", doc_id: str = "doc_id", text: str = "text",
        settings: Settings = Settings()) -> Network:
    """Fits on windows of about ``settings.windows`` documents per language,
    drawn by a hash of the id; rare languages give what they have. Of more than
    ``most_rows / windows`` languages each gives fewer, and none is left out."""
    rows = docs.where(F.col(language).isNotNull() & (F.length(text) > 0)).select(
        F.col(language).alias("lang"), F.col(text).cast("string").alias("text"),
        F.xxhash64(F.col(doc_id).cast("string"), F.lit("draw")).alias("draw"))
    counts = materialise(rows.groupBy("lang").agg(F.count("*").alias("n")))
    most = max(1, settings.most_rows // max(1, counts.count()))
    # Of a small number so many more are drawn that no language is left without.
    aim = settings.windows if settings.windows <= most else 2 * most + 20
    share = F.least(F.lit(1_000_000), F.ceil(F.lit(1_000_000 * aim) / F.col("n")))
    room = F.greatest(F.length("text") - settings.window_chars, F.lit(0)) + 1
    window = F.substr("text", (F.pmod(F.shiftright("draw", 20), room) + 1).cast("int"), F.lit(settings.window_chars))
    drawn = rows.join(checked(counts), "lang").where(F.pmod("draw", F.lit(1_000_000)) < share).select(
        "lang", "draw", window.alias("window"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("draw", "window"))
    found = drawn.withColumn("place", place).where(F.col("place") <= most).orderBy("draw", "window").select(
        "window", "lang").collect()
    return fit_windows([r[0] for r in found], [r[1] for r in found], settings)


def predict(docs: DataFrame, network: Network, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score) for every row of ``docs``."""
    letters = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))
    rows = docs.select(F.col(doc_id).alias("doc_id"),
                       F.when(letters, F.col(text).cast("string")).alias("text"))

    def run(batches):
        names = np.array(network.languages, object)
        for batch in blocks(batches, limit=SCORE_BLOCK_BYTES):
            found = network.document_probabilities(*text_bytes(batch.column("text")))
            best, unknown = found.argmax(axis=1), batch.column("text").is_null().to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array(np.where(unknown, UNDETERMINED, names[best]), pa.string()),
                pa.array(np.where(unknown, 0.0, np.minimum(1.0, found.max(axis=1))))],
                names=["doc_id", "lang_pred", "score"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")


def label_runs(docs: DataFrame, network: Network, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, start, bytes, language): maximal runs of bytes with one label."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))

    def run(batches):
        net = network
        for batch in blocks(batches, limit=SCORE_BLOCK_BYTES):
            data, offsets = text_bytes(batch.column("text"))
            column, valid, _ = segments(data, offsets)
            label = np.concatenate([
                net.byte_probabilities(column[:, at:at + LANES]).argmax(axis=0)
                for at in range(0, column.shape[1], LANES)] or [valid.astype(int)], axis=1).T[valid.T]
            change = np.ones(len(label), bool)
            change[1:] = label[1:] != label[:-1]
            change[offsets[:-1][offsets[:-1] < len(label)]] = True
            start = np.flatnonzero(change)
            doc = np.searchsorted(offsets, start, "right") - 1
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id").take(pa.array(doc)), pa.array(start - offsets[doc]),
                pa.array(np.diff(start, append=len(label))),
                pa.array([net.languages[k] for k in label[start]], pa.string())],
                names=["doc_id", "start", "bytes", "language"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, start long, bytes long, language string")
