"""NumPy helpers over Arrow text columns: blocks of bounded size and word hashes.

A worker never holds arrays for more than about ``BLOCK_BYTES`` of text and one
further document: a word or n-gram costs tens of bytes, so whole Arrow batches
would not fit.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 2_000_000
_HASH_BYTES = 1 << 16
_rng = np.random.default_rng(7_919)
_BYTE_VALUE = _rng.integers(1, 2**63, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Everything but space and the controls tab to carriage return.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
#: Digits, lower-case letters and every byte of a character outside ASCII.
LETTER_OR_DIGIT = np.zeros(256, bool)
LETTER_OR_DIGIT[0x30:0x3A] = LETTER_OR_DIGIT[0x61:0x7B] = LETTER_OR_DIGIT[0x80:] = True


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts in a row and the n + 1 offsets; null is empty."""
    column = pa.array(column.fill_null(""), pa.large_string())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def blocks(batches: Iterator[pa.RecordBatch], text: str = "text",
           limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of at most ``limit`` text bytes, or one document."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = text_bytes(batch.column(text))
        at = 0
        while at < batch.num_rows:
            end = int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1
            end = min(max(end, at + 1), batch.num_rows)
            yield batch.slice(at, end - at)
            at = end


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit scramble (the finaliser of the splitmix64 generator)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers["up"]) <= n:
        inverse = pow(_BASE, -1, 2**64)
        for name, base in (("up", _BASE), ("down", inverse)):
            steps = np.full(n + 1, base, np.uint64)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    return _powers["up"], _powers["down"]


@dataclass
class Words:
    """Words of several documents: byte spans, 64-bit hashes, and per document
    the range ``first[d]:first[d + 1]`` of its words."""
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def words(data: np.ndarray, offsets: np.ndarray, kept: np.ndarray,
          lower: bool = True) -> Words:
    """Maximal runs of ``kept`` bytes inside each document. The hash is a
    polynomial over random byte values mod 2**64, scrambled."""
    if lower:
        data = LOWER[data]
    n = len(data)
    inside = np.zeros(n + 2, bool)
    inside[1:-1] = kept[data]
    cut = np.zeros(n + 1, bool)
    cut[offsets] = True
    start = np.flatnonzero(inside[1:-1] & (~inside[:-2] | cut[:-1]))
    end = np.flatnonzero(inside[1:-1] & (~inside[2:] | cut[1:])) + 1
    out = np.empty(len(start), np.uint64)
    at = 0
    while at < len(start):
        to = max(int(np.searchsorted(end, start[at] + _HASH_BYTES, "right")), at + 1)
        low, high = int(start[at]), int(end[to - 1])
        up, down = _power_tables(high - low)
        total = np.zeros(high - low + 1, np.uint64)
        np.cumsum(_BYTE_VALUE[data[low:high]] * up[:high - low], out=total[1:])
        s, e = start[at:to] - low, end[at:to] - low
        out[at:to] = (total[e] - total[s]) * down[s]
        at = to
    return Words(start, end, mix(out), np.searchsorted(start, offsets))


def window_hashes(values: np.ndarray, size: int) -> np.ndarray:
    """Order-dependent hash of every run of ``size`` values (n - size + 1)."""
    n = max(0, len(values) - size + 1)
    total = np.zeros(n, np.uint64)
    for k in range(size):
        total = total * np.uint64(_BASE) + values[k:k + n]
    return mix(total)
