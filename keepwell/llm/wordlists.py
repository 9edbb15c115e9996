"""Words of UTF-8 texts as byte strings, in lists of bounded size."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa

from keepwell.llm.textblocks import text_bytes

PIECE_BYTES = 4_000_000
#: A-Z to a-z, ASCII other than letters and digits to the blank; the rest stays.
_PLAIN = bytes((b + 32 if 0x41 <= b <= 0x5A else b) if chr(b).isalnum() or b > 0x7F else 0x20
               for b in range(256))


def word_lists(raw: bytes) -> Iterator[list[bytes]]:
    """The words of a text in order: runs of ASCII letters (lower-cased), digits
    and all characters outside ASCII. Long texts come in several lists."""
    at = 0
    while at < len(raw):
        piece = raw[at:at + PIECE_BYTES].translate(_PLAIN)
        end = len(raw)
        if at + PIECE_BYTES < len(raw):
            cut = piece.rfind(b" ")
            if cut < 0:                             # one word fills the piece
                piece = raw[at:].translate(_PLAIN)
                cut = piece.find(b" ")
            if cut >= 0:
                end = at + cut + 1
                piece = piece[:cut]
        yield piece.split()
        at = end


def texts(column: pa.Array) -> Iterator[bytes]:
    """UTF-8 bytes per row; null is empty."""
    data, offsets = text_bytes(column)
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        yield data[a:b].tobytes()
