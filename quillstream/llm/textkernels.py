"""Vectorised word, shingle and window hashing over batches of UTF-8 texts.

A word is a maximal run of bytes outside ``\\x20`` and ``\\x09-\\x0D``; bytes of multi-byte
characters never fall in that set, so bytes and code points give the same words.
"""

from __future__ import annotations

import hashlib

import numpy as np

U = np.uint64
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_KEEP = np.array([(1 << (8 * n)) - 1 for n in range(8)] + [(1 << 64) - 1], dtype=np.uint64)
#: Words of more bytes than this are hashed one by one.
LONG_WORD = 256
STEP = U(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (shift, multiply)."""
    x = x ^ (x >> U(31))
    x = x * U(0x7FB5D329728EA185)
    x ^= x >> U(27)
    x *= U(0x81DADEF4BC2DD44D)
    x ^= x >> U(33)
    return x


class Words:
    """Words of the texts ``data[offsets[k]:offsets[k + 1]]``: byte starts and ends, and per text the
    range ``first[k]:first[k + 1]`` of its words."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        n = len(data)
        self.data, self.offsets = data, offsets
        inside = ~SPACE[data]
        edge = np.zeros(n + 1, bool)
        edge[offsets] = True
        before = np.empty(n, bool)
        after = np.empty(n, bool)
        if n:
            before[0], after[-1] = False, False
            before[1:], after[:-1] = inside[:-1], inside[1:]
        self.starts = np.flatnonzero(inside & (~before | edge[:n]))
        self.ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
        self.first = np.searchsorted(self.starts, offsets)
        self.inside = inside

    def __len__(self) -> int:
        return len(self.starts)

    def text_of(self) -> np.ndarray:
        """The index of each word's text."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word's bytes."""
        size = self.ends - self.starts
        padded = np.concatenate([self.data, np.zeros(8, np.uint8)])
        lanes = np.lib.stride_tricks.as_strided(padded.view(np.uint8), (max(len(padded) - 7, 0), 8), (1, 1))
        out = mix(size.astype(np.uint64) + STEP)
        todo = np.flatnonzero(size <= LONG_WORD)
        at = 0
        while len(todo):
            left = size[todo] - at
            lane = lanes[self.starts[todo] + at].view("<u8").ravel() & _KEEP[np.minimum(left, 8)]
            out[todo] = mix(out[todo] * STEP + lane)
            todo = todo[left > 8]
            at += 8
        for k in np.flatnonzero(size > LONG_WORD):
            word = self.data[self.starts[k] : self.ends[k]].tobytes()
            out[k] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        return out


def rolling(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of ``width`` words, whichever texts they lie in."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = np.zeros(n, np.uint64)
    for k in range(width):
        h *= U(0xD6E8FEB86659FD93)
        h += hashes[k : k + n]
    return mix(h)


def whole_starts(words: Words, width: int) -> np.ndarray:
    """Starts of the runs of ``width`` words that lie in one text."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    open_ = np.ones(n + width, bool)
    sizes = np.diff(words.first)
    for k in range(1, width):  # the last width - 1 words of each text start none
        at = words.first[1:] - k
        open_[at[(sizes >= k)]] = False
    return np.flatnonzero(open_[:n])


def windows(words: Words, hashes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts (word numbers) of all ``width``-word windows that lie in one text, and their hashes."""
    starts = whole_starts(words, width)
    return starts, rolling(hashes, width)[starts]


def covered(length: int, starts: np.ndarray, width: int) -> np.ndarray:
    """Positions below ``length`` that a window of ``width`` from one of ``starts`` covers."""
    change = np.zeros(length + 1, np.int32)
    np.add.at(change, starts, 1)
    np.add.at(change, np.minimum(starts + width, length), -1)
    return np.cumsum(change[:-1]) > 0
