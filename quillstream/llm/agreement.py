"""Posts under which similar sets meet, and sketches that part sets which cannot be similar.

Two sets with Jaccard p / 100 or more differ in at most ``2 n (100 - p) / (100 + p)`` elements, n being
the larger one's size. Elements are dealt over more parts than that by a hash, so the two sets agree
on a whole part that isn't empty: each set is posted under the contents of its parts. A part holds
several elements, so unlike single elements its contents seldom agree by chance, however large the
corpus is. The number of parts is fixed within a band of sizes; a set is posted in its own band, and in
those of the larger sets that it may be similar to.

Nothing is left to chance: a set that fills too few of its parts to be sure of an agreement says how
often the parts must be halved until it fills enough, and its whole band is then posted so.

A sketch has a bit for each class of hash values: whether the set holds an odd number of them. Two
sketches differ in no more bits than their sets in elements.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np

from .textkernels import STEP, U, mix

#: Bands reach to sets of this size.
MOST = 1 << 40
#: Standard deviations that the number of filled parts may lie below its mean without halving.
MARGIN = 6.0
#: The chance of that where parts are few.
CHANCE = 1e-9
#: Sizes of a band for which the number of posted parts is tabulated.
GRID = 256


def difference(n, percent: int):
    """Elements in which a set of ``n`` and one that is not larger differ at most, if similar."""
    return 2 * n * (100 - percent) // (100 + percent)


@dataclass(frozen=True)
class Band:
    first: int
    end: int
    parts: int
    step: int
    posted: np.ndarray  # by steps from ``first``: parts that sets up to this size must post

    def asked(self, n: np.ndarray) -> np.ndarray:
        return self.posted[np.minimum(-(-(n - self.first) // self.step), len(self.posted) - 1)]

    @property
    def bits(self) -> int:
        return max(64, 1 << (self.end - 1).bit_length())


def _many(n: np.ndarray, parts: int, percent: int) -> np.ndarray:
    """Parts of which, but for ``MARGIN`` deviations, more are filled than a set of n may differ in."""
    inside = -np.expm1(n * math.log1p(-1 / parts))
    half = MARGIN * np.sqrt(inside * (1 - inside))
    want = 2 * n * (100 - percent) / (100 + percent) + 1
    return np.ceil(((half + np.sqrt(half * half + 4 * inside * want)) / (2 * inside)) ** 2)


def _few(n: int, parts: int, percent: int) -> float:
    """The same where parts are few: all but d of these are empty with ``CHANCE`` at most."""
    d = difference(n, percent)
    for k in range(d + 1, parts + 1):
        empty = n * math.log1p((d - k) / parts) if k - d < parts else -math.inf
        if math.lgamma(k + 1) - math.lgamma(d + 1) - math.lgamma(k - d + 1) + empty < math.log(CHANCE):
            return k
    return math.inf


def _band(first: int, end: int, percent: int) -> Band:
    step = max(1, -(-(end - first) // GRID))
    sizes = first + np.arange(-(-(end - 1 - first) // step) + 1, dtype=np.float64) * step
    most = difference(end - 1, percent)
    parts = most + 1
    while True:
        posted = _many(sizes, parts, percent) if most >= 60 else np.array([_few(int(n), parts, percent) for n in sizes])
        posted = np.maximum.accumulate(posted)
        if parts > 64 * (most + 1):  # sets so small are posted whole, and halved where need be
            posted = np.full(len(sizes), parts)
        if posted[-1] <= parts:
            return Band(first, end, parts, step, posted.astype(np.int64))
        parts += 1 + parts // 50


class Scheme:
    """The bands for a similarity, and what sets post in them."""

    def __init__(self, percent: int):
        self.percent = percent
        self.bands: list[Band] = []
        first = -(-(100 + percent) // (2 * (100 - percent))) if percent < 100 else MOST
        while first < MOST:  # smaller sets are similar to equal ones alone
            end, d = 2 * first, difference(first, percent)
            if d < 4:
                end = first + 1
                while difference(end, percent) == d:
                    end += 1
            self.bands.append(_band(first, end, percent))
            first = end
        self.firsts = np.array([b.first for b in self.bands], np.int64)

    def band(self, n: np.ndarray) -> np.ndarray:
        """The band of each size; -1 for those that have none."""
        return np.searchsorted(self.firsts, n, side="right") - 1

    def entries(self, n: np.ndarray, own: bool = False) -> list[tuple[int, np.ndarray]]:
        """(band, numbers of the sets that are posted there); with ``own`` each set's own band alone."""
        low = self.band(n)
        high = low if own else self.band(100 * n // self.percent)
        out = []
        for band in range(max(0, int(low.min(initial=0))), int(high.max(initial=-1)) + 1):
            at = np.flatnonzero((low <= band) & (band <= high) & (n > 0))
            if len(at):
                out.append((band, at))
        return out

    def needs(self, sets: list[np.ndarray]) -> np.ndarray:
        """For each set how often its band's parts must be halved."""
        n = np.array([len(s) for s in sets], np.int64)
        out = np.zeros(len(sets), np.int32)
        for number, at in self.entries(n, own=True):
            band = self.bands[number]
            values, owner = _flat(sets, at)
            part = _place(values, band.parts)
            use = part < band.asked(n[at])[owner]
            filled = np.bincount(np.unique(owner[use] * band.parts + part[use]) // band.parts, minlength=len(at))
            for k in np.flatnonzero(filled <= difference(n[at], self.percent)).tolist():
                own, halved = sets[at[k]], 1
                while len(np.unique(_place(own, band.parts << halved))) <= difference(len(own), self.percent):
                    halved += 1
                out[at[k]] = halved
        return out

    def posts(self, sets: list[np.ndarray], halved: dict[int, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(signature, band, number of the set) of all parts to be posted; ``halved``: by band how often."""
        n = np.array([len(s) for s in sets], np.int64)
        out = [(np.zeros(0, np.uint64), np.zeros(0, np.uint8), np.zeros(0, np.int64))]
        for number, at in self.entries(n):
            band, times = self.bands[number], halved.get(number, 0)
            values, owner = _flat(sets, at)
            total = band.parts << times
            part = _place(values, total)
            if not times:  # a larger, similar set of this band asks for no more
                use = part < band.asked(np.minimum(100 * n[at] // self.percent, band.end - 1))[owner]
                values, owner, part = values[use], owner[use], part[use]
            cell = owner * total + part
            if len(at) * total > 8 * len(values) + 1024:
                cells, cell = np.unique(cell, return_inverse=True)
            else:
                cells = np.arange(len(at) * total)
            low = np.bincount(cell, weights=(values & U(0xFFFFFFFF)).astype(np.float64), minlength=len(cells))
            high = np.bincount(cell, weights=(values >> U(32)).astype(np.float64), minlength=len(cells))
            filled = np.flatnonzero(np.bincount(cell, minlength=len(cells)))
            content = low[filled].astype(np.uint64) + (high[filled].astype(np.uint64) << U(32))
            place = (cells[filled] % total).astype(np.uint64)
            signature = mix(content ^ mix(place * STEP + U(number + 64 * times)))
            out.append((signature, np.full(len(filled), number, np.uint8), at[cells[filled] // total]))
        return tuple(np.concatenate(x) for x in zip(*out))

    def sketches(self, sets: list[np.ndarray]) -> list[list[tuple[int, bytes]]]:
        """By set (band, bits) of each band that it is posted in."""
        n = np.array([len(s) for s in sets], np.int64)
        out: list[list[tuple[int, bytes]]] = [[] for _ in sets]
        for number, at in self.entries(n):
            bits = self.bands[number].bits
            values, owner = _flat(sets, at)
            odd = np.bincount(owner * bits + (mix(values ^ STEP) % U(bits)).astype(np.int64), minlength=len(at) * bits) & 1
            for k, row in zip(at.tolist(), np.packbits(odd.reshape(len(at), bits).astype(np.uint8), axis=1)):
                out[k].append((number, row.tobytes()))
        return out

    def may_link(self, a: np.ndarray, b: np.ndarray, n_a, n_b) -> np.ndarray:
        """Whether sets with the sketches ``a`` and ``b`` (rows of 64-bit words) may be similar."""
        apart = np.bitwise_count(a ^ b).sum(axis=-1, dtype=np.int64)
        return (apart <= (n_a + n_b) * (100 - self.percent) // (100 + self.percent)) & (100 * np.minimum(n_a, n_b) >= self.percent * np.maximum(n_a, n_b))


def _flat(sets: list[np.ndarray], at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    chosen = [sets[k] for k in at.tolist()]
    return np.concatenate(chosen), np.repeat(np.arange(len(chosen)), [len(s) for s in chosen])


def _place(values: np.ndarray, parts: int) -> np.ndarray:
    return (mix(values + STEP) % U(parts)).astype(np.int64)
