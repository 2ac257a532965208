"""Bloom filters over 64-bit keys, put together block by block, of a stated size at most.

Beyond ``MOST`` keys a filter stays at its size and lets more keys pass that it was not given; what
callers return does not depend on that."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame

from .textkernels import STEP, U, mix

#: Keys for which a filter has 16 bits each (32 MB); it grows no further.
MOST = 16_000_000
BLOCKS = 32
SCHEMA = "block int, bits binary"


def cells(keys: np.ndarray, size: int) -> np.ndarray:
    """The two cells of each key in a filter of ``size`` bits."""
    return np.concatenate([mix(keys) % U(size), mix(keys + STEP) % U(size)]).astype(np.int64)


def holds(packed: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether the filter may hold each key."""
    at = cells(keys, 8 * len(packed))
    seen = (packed[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1
    return (seen[: len(keys)] & seen[len(keys) :]).astype(bool)


def _merge(pdf: pd.DataFrame) -> pd.DataFrame:
    bits = np.bitwise_or.reduce([np.frombuffer(zlib.decompress(x), np.uint8) for x in pdf["bits"]])
    return pd.DataFrame({"block": pdf["block"].iloc[:1], "bits": [zlib.compress(bits.tobytes(), 1)]})


def key_filter(keys: DataFrame, most: int = MOST) -> np.ndarray:
    """A filter of the column ``key`` with 16 bits a key, for ``most`` keys at most."""
    n = min(keys.count(), most)
    size = max(1 << 16, -(-16 * n // (8 * BLOCKS)) * 8 * BLOCKS)

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(size, bool)
        for batch in batches:
            seen[cells(batch.column(0).to_numpy().view(np.uint64), size)] = True
        if seen.any():
            blobs = [zlib.compress(x.tobytes(), 1) for x in np.split(np.packbits(seen), BLOCKS)]
            yield pa.RecordBatch.from_pydict({"block": pa.array(range(BLOCKS), pa.int32()), "bits": pa.array(blobs, pa.binary())})

    rows = keys.select("key").mapInArrow(part, SCHEMA).groupBy("block").applyInPandas(_merge, SCHEMA).orderBy("block").collect()
    packed = [np.frombuffer(zlib.decompress(bytes(x["bits"])), np.uint8) for x in rows]
    return np.concatenate(packed) if packed else np.zeros(size // 8, np.uint8)
