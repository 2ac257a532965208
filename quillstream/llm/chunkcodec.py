"""Token ids of long texts from tables of parts that were encoded before.

A tokenizer that never merges across a blank gives each blank-separated chunk the same ids wherever
it stands. A chunk is split into the tokenizer's own pieces, each distinct piece is encoded once by
the tokenizers library, and texts are put together from the stored id bytes. A word behind its blank
is one piece and a chunk as well, so it is held once, as a chunk. The tables keep what they met first
and have a bound; later pieces go to a part that is emptied when it is full. Nothing depends on what
happens to be stored. Texts that are ``unsafe`` are encoded whole.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np

#: Entries of the tables: chunks and pieces that stay, pieces that are forgotten together. With keys
#: of ``KEPT_CHARS`` at most and their ids an entry takes some 200 bytes, 400 at most.
STAY = 700_000
RECENT = 80_000
#: Longer chunks and pieces are not kept.
KEPT_CHARS = 48


#: The tables of this worker. Workers stay between stages, so other stages empty these.
_tables: list[ChunkTable] = []


def empty_tables() -> None:
    """Give up what the tables of this worker hold; they learn anew when they are used again."""
    for table in _tables:
        for known in (table.chunks, table.pieces, table.recent):
            known.clear()


class Known(dict):
    """A dict that asks ``learn`` for what it does not hold."""

    def __init__(self, learn: Callable[[str], bytes]):
        self.learn = learn

    def __missing__(self, key: str) -> bytes:
        return self.learn(key)


def pack(ids: list[int]) -> bytes:
    return np.asarray(ids, dtype="<u4").tobytes()


class ChunkTable:
    """``whole``: ids of a text. ``split``: of a chunk that follows a blank, the chunk that its first
    piece is without the blank, and the pieces after it. ``encode``: a piece's ids, packed.
    ``unsafe``: whether a text, not empty, is to be encoded whole."""

    def __init__(self, whole: Callable[[str], list[int]], split: Callable[[str], tuple[str, list[str]]], encode: Callable[[str], bytes], unsafe: Callable[[str], bool]):
        self.whole, self.split, self.encode, self.unsafe = whole, split, encode, unsafe
        self.chunks = Known(self._chunk)
        self.pieces = Known(self._piece)
        self.recent: dict[str, bytes] = {}
        # What the tables do not keep, for the text at hand: each is learnt once a text.
        self.own_chunks: dict[str, bytes] = {}
        self.own_pieces: dict[str, bytes] = {}
        _tables.append(self)

    def _full(self) -> bool:
        return len(self.chunks) + len(self.pieces) >= STAY

    def _chunk(self, chunk: str) -> bytes:
        ids = self.own_chunks.get(chunk)
        if ids is None:
            word, rest = self.split(chunk)
            if rest:
                ids = b"".join([self.chunks[word], *map(self.pieces.__getitem__, rest)])
            else:
                ids = self._encoded(" " + chunk)
            keep = len(chunk) <= KEPT_CHARS and not self._full()
            (self.chunks if keep else self.own_chunks)[chunk] = ids
        return ids

    def _piece(self, piece: str) -> bytes:
        ids = self._encoded(piece)
        if len(piece) <= KEPT_CHARS and not self._full():
            self.pieces[piece] = ids
        return ids

    def _encoded(self, piece: str) -> bytes:
        ids = self.recent.get(piece)
        if ids is None:
            ids = self.own_pieces.get(piece)
        if ids is None:
            ids = self.encode(piece)
            if len(piece) > KEPT_CHARS:
                self.own_pieces[piece] = ids
            elif self._full():
                if len(self.recent) >= RECENT:
                    self.recent.clear()
                self.recent[piece] = ids
        return ids

    def encode_text(self, text: str) -> bytes:
        """The ids of ``text`` as little-endian unsigned 32-bit numbers."""
        if not text:
            return b""
        if self.unsafe(text):
            return pack(self.whole(text))
        head, *rest = text.split(" ")
        ids = b"".join(map(self.chunks.__getitem__, rest))
        self.own_chunks.clear()
        self.own_pieces.clear()
        return pack(self.whole(head)) + ids


def crc32(packed: bytes) -> int:
    return zlib.crc32(packed)
