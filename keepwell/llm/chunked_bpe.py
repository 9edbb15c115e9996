"""BPE encoding and decoding with content-defined chunk reuse.

A rolling hash over the last ``HASH_WINDOW`` bytes cuts every document where the
text itself says so, hence equal passages of different documents fall into equal
chunks. A chunk's ids are reused for its other occurrences in the task for as long
as it is among the last used ones that fit ``CACHE_BYTES``. Chunks are then joined: around each join the text is encoded again
from the last place in the left chunk to the first place in the right one where
the pre-tokenizer must split whatever stands around it. There, a printable ASCII
character is followed by a blank or line feed: no pre-token has white space
behind anything else, and no special token holds any. Both neighbours' ids must
have a token end at that very byte (exact agreement); otherwise the window grows
to the next such place, at last to the whole document.

The vocabulary file is a parameter. Ids are binary: little-endian unsigned 32-bit.
Nulls are encoded as empty texts, which have no ids. Repeated rows and ties are
encoded each by itself, an empty table gives an empty result, and extra columns
are ignored.
"""

from __future__ import annotations

import json
import os
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keepwell.llm.textblocks import blocks, mix, text_bytes

HASH_WINDOW = 24
CUT_BITS = 10               # a chunk has about 2**10 bytes
LEAST_CHUNK = 256
CACHE_BYTES = 16_000_000    # text and ids kept for reuse by one task
ENTRY_BYTES = 400           # what an entry's objects cost besides
LONG_PIECE = 8_192
ENCODE_BLOCK_BYTES = 500_000
#: Fixed value: the split byte-level pre-tokenizers of this family use.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_SPLIT = re.compile(rb"[\x21-\x7e](?=[ \n])")
_FACTOR = 0x9E3779B97F4A7C15


def cuts(data: np.ndarray) -> list[int]:
    """Chunk ends inside ``data``: positions of characters' first bytes."""
    n = len(data) - HASH_WINDOW + 1
    if n < 1:
        return []
    value = mix(data.astype(np.uint64) + np.uint64(1))
    rolled = np.zeros(n, np.uint64)
    for k in range(HASH_WINDOW):
        rolled = rolled * np.uint64(_FACTOR) + value[k:k + n]
    marked = np.flatnonzero(mix(rolled) >> np.uint64(64 - CUT_BITS) == 0) + HASH_WINDOW
    out, last = [], 0
    for at in marked.tolist():
        if at - last >= LEAST_CHUNK and at < len(data) and data[at] & 0xC0 != 0x80:
            out.append(at)
            last = at
    return out


class Vocabulary:
    """A tokenizer file with the bytes of every id.

    Chunks are encoded by the rank encoder, built from the same file, which
    gives the same ids several times faster for byte-level vocabularies without
    a normaliser whose ids follow their merges; its time is quadratic in words
    without white space, so long pieces go to the tokenizer itself.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tiktoken
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            held = json.load(file)
        split, model = held["pre_tokenizer"] or {}, held["model"]
        if (split.get("type") != "ByteLevel" or not split.get("use_regex") or held["normalizer"]
                or split.get("add_prefix_space") or model["type"] != "BPE"):
            raise ValueError("a byte-level BPE tokenizer without a normaliser is needed")
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.special = {x["content"]: x["id"] for x in held["added_tokens"]}
        byte = {c: b for b, c in enumerate(_byte_characters())}
        ranks = {bytes(byte[c] for c in token): k for token, k in model["vocab"].items()
                 if token not in self.special}
        self.ranks = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks,
                                       special_tokens=self.special)
        self.allowed = set(self.special)
        tokens = {k: token for token, k in ranks.items()} | {
            k: token.encode() for token, k in self.special.items()}
        texts = [tokens.get(k, b"") for k in range(max(tokens) + 1)]
        self.length = np.array([len(x) for x in texts], np.int64)
        self.begin = np.cumsum(self.length) - self.length
        self.data = np.frombuffer(b"".join(texts), np.uint8)

    def encode(self, text: bytes) -> np.ndarray:
        if len(text) > LONG_PIECE:
            found = self.tokenizer.encode(text.decode(), add_special_tokens=False).ids
        else:
            found = self.ranks.encode_to_numpy(text.decode(), allowed_special=self.allowed)
        return np.asarray(found, "<u4")

    def decode(self, ids: np.ndarray) -> bytes:
        """Bytes of the ids, in pieces so that the index arrays stay small."""
        parts = []
        for at in range(0, len(ids), 1 << 18):
            some = ids[at:at + (1 << 18)]
            length = self.length[some]
            shift = self.begin[some] - (np.cumsum(length) - length)
            parts.append(self.data[np.repeat(shift, length) + np.arange(length.sum())].tobytes())
        return b"".join(parts).decode("utf-8", "replace").encode()


def _byte_characters() -> list[str]:
    """The characters byte-level vocabularies write bytes as: printable Latin-1
    stands for itself, the other bytes follow from code 256 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


class Encoder:
    """Encodes documents out of reused chunks; ``encoded`` and ``reused`` count
    bytes."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.known: dict[bytes, tuple[bytes, bytes]] = {}    # least recently used first
        self.kind = "<u2" if len(vocabulary.length) <= 1 << 16 else "<u4"
        self.held = self.encoded = self.reused = 0

    def _learn(self, parts: list[bytes]) -> None:
        fresh = list(dict.fromkeys(x for x in parts if x not in self.known))
        self.reused += sum(map(len, parts)) - sum(map(len, fresh))
        for part in dict.fromkeys(parts):
            if part in self.known:
                self.known[part] = self.known.pop(part)
        for part in fresh:
            ids = self.vocabulary.encode(part)
            ends = np.cumsum(self.vocabulary.length[ids])
            self.known[part] = ids.astype(self.kind).tobytes(), ends.astype(self._ends(part)).tobytes()
            self.held += self._cost(part)
            self.encoded += len(part)

    @staticmethod
    def _ends(part: bytes) -> str:
        return "<u2" if len(part) < 1 << 16 else "<u8"

    def _ids(self, part: bytes) -> np.ndarray:
        return np.frombuffer(self.known[part][0], self.kind)

    def _cost(self, part: bytes) -> int:
        return ENTRY_BYTES + len(part) + sum(map(len, self.known[part]))

    def _forget(self) -> None:
        """Drops the least recently used entries beyond the bound."""
        for part in list(self.known):
            if self.held <= CACHE_BYTES:
                break
            self.held -= self._cost(part)
            del self.known[part]

    def documents(self, texts: list[bytes]) -> list[np.ndarray]:
        chunked = []
        for text in texts:
            edge = [0, *cuts(np.frombuffer(text, np.uint8)), len(text)]
            chunked.append([text[a:b] for a, b in zip(edge, edge[1:])])
        self._learn([c for chunks in chunked for c in chunks])
        plans = [self._plan(chunks) for chunks in chunked]
        self._learn([p for plan in plans for p, low, high in plan if low < 0])
        out = [np.concatenate([self._ids(p)[max(low, 0):high] for p, low, high in plan]).astype("<u4")
               if plan else np.zeros(0, "<u4") for plan in plans]
        self._forget()
        return out

    def _plan(self, chunks: list[bytes]) -> list[tuple[bytes, int, int | None]]:
        """(piece, first id, last id) in order; first id -1: a window to encode."""
        plan, open_text = [], b""
        for k, chunk in enumerate(chunks):
            low = self._agreed(chunk, first=True) if k else (0, 0)
            high = (self._agreed(chunk, first=False) if k + 1 < len(chunks)
                    else (len(chunk), len(self._ids(chunk))))
            if low is None or high is None or high[0] < low[0]:
                open_text += chunk
                continue
            if open_text + chunk[:low[0]]:
                plan.append((open_text + chunk[:low[0]], -1, None))
            if high[1] > low[1]:
                plan.append((chunk, low[1], high[1]))
            open_text = chunk[high[0]:]
        if open_text:
            plan.append((open_text, -1, None))
        return plan

    def _agreed(self, chunk: bytes, first: bool) -> tuple[int, int] | None:
        """(byte, ids before it) of the first or last certain split of the
        chunk at which one of its tokens ends."""
        ends = np.frombuffer(self.known[chunk][1], self._ends(chunk))
        for at in self._splits(chunk, first):
            k = int(np.searchsorted(ends, at))
            if k < len(ends) and ends[k] == at:
                return at, k + 1
        return None

    @staticmethod
    def _splits(chunk: bytes, first: bool):
        if first:
            yield from (m.end() for m in _SPLIT.finditer(chunk))
            return
        end = len(chunk)
        while end:
            begin = max(0, end - 64)
            found = [m.end() for m in _SPLIT.finditer(chunk, begin, min(len(chunk), end + 1))]
            yield from reversed([at for at in found if at <= end])
            end = begin


def encode(docs: DataFrame, vocabulary: str, *, doc_id: str = "doc_id", text: str = "text",
           decoded: bool = False) -> DataFrame:
    """(doc_id, ids): the ids of every whole text, special tokens' strings in it
    taken as such, none added. ``decoded`` adds the text the ids stand for,
    decoded in the same task."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))

    def run(batches):
        encoder = Encoder(Vocabulary(vocabulary))
        for batch in blocks(batches, limit=ENCODE_BLOCK_BYTES):
            data, offsets = text_bytes(batch.column("text"))
            data = data.tobytes()
            ids = encoder.documents([data[a:b] for a, b in zip(offsets.tolist(), offsets[1:].tolist())])
            columns = {"doc_id": batch.column("doc_id"),
                       "ids": pa.array([x.tobytes() for x in ids], pa.binary())}
            if decoded:
                columns["decoded"] = pa.array(
                    [encoder.vocabulary.decode(x) for x in ids], pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_pydict(columns)

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, ids binary" + ", decoded string" * decoded)


def decode(encoded: DataFrame, vocabulary: str, *, ids: str = "ids") -> DataFrame:
    """``encoded`` with the ``decoded`` text; special tokens are not skipped."""
    kind = encoded.select("*", F.lit("").alias("decoded")).schema

    def run(batches):
        held = Vocabulary(vocabulary)
        for batch in batches:
            texts = [held.decode(np.frombuffer(x.as_py() or b"", "<u4")) for x in batch.column(ids)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(texts, pa.binary()).cast(pa.string())],
                names=[*batch.schema.names, "decoded"])

    return encoded.mapInArrow(run, kind)
