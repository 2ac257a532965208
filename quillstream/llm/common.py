"""Tables, shared storage and Arrow helpers that the training-data operators share."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

pa.set_memory_pool(pa.system_memory_pool())  # freed batches go back to the system, not to a pool of the worker

#: Rows and bytes of an Arrow batch sent to Python: texts can be long, so a batch holds few of them.
BATCH_ROWS = 1000
BATCH_BYTES = 16 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(spark: SparkSession) -> None:
    """Keep Arrow batches small enough for long texts (session settings, read when a plan is made)."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder (spark.checkpoint.dir); a folder of our own only where it is unset, as in tests."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        app = spark.sparkContext.applicationId
        if app not in _own_dirs:
            _own_dirs[app] = "file://" + tempfile.mkdtemp(prefix="quillstream-")
        named = _own_dirs[app]
    return named.rstrip("/")


_own_dirs: dict[str, str] = {}
#: Paths of the tables of ``stored`` that have not been released.
_written: list[str] = []


def _remove(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration() if hasattr(spark, "_jsc") else spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
    except Exception:  # the session has ended; the cluster's own retention applies
        pass


def stored(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: the lineage is cut, and a lost
    executor costs no recomputation. ``keep``, if given, receives the path, for ``release``."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/quillstream/{uuid.uuid4().hex}"
    df.write.parquet(path)
    _written.append(path)
    if keep is not None:
        keep.append(path)
    atexit.register(_remove, spark, path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession, paths: list[str]) -> None:
    """Delete tables of ``stored`` that no later plan reads."""
    for path in paths:
        _remove(spark, path)
        if path in _written:
            _written.remove(path)
    paths.clear()


def stored_alone(make: Callable[[], DataFrame]) -> tuple[DataFrame, list[str]]:
    """What ``make`` returns, stored, and its path; tables that were stored meanwhile are deleted."""
    before = len(_written)
    kept: list[str] = []
    out = stored(make(), kept)
    release(out.sparkSession, [p for p in _written[before:] if p not in kept])
    return out, kept


def held_out(doc_id) -> F.Column:
    """The documents that no model learns from: crc32 of the id as text, modulo 4, is 2."""
    return F.crc32(F.col(doc_id).cast("string")) % 4 == 2 if isinstance(doc_id, str) else F.crc32(doc_id.cast("string")) % 4 == 2


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column without copying; nulls have length zero."""
    if pa.types.is_large_string(column.type):
        width = np.int64
    else:
        width = np.int32
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], dtype=width)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] is not None and buffers[2].size else np.zeros(0, np.uint8)
    if column.null_count:
        sizes = np.where(column.is_valid().to_numpy(zero_copy_only=False), np.diff(offsets), 0)
        if sizes.sum() != offsets[-1] - offsets[0]:  # a null slot may cover bytes
            data = np.concatenate([data[a : a + n] for a, n in zip(offsets[:-1], sizes)] or [np.zeros(0, np.uint8)])
            offsets = np.concatenate([[0], np.cumsum(sizes)])
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def spans(offsets: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about ``limit`` bytes each; a longer row stands alone."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last
