"""Near-duplicate vectors: random-hyperplane sign hashing in several tables, exact verification,
distributed connected components.

Vectors with the same components are one class. A class's signs against random hyperplanes, cut
into tables of ``bits`` signs, name its buckets. Within a bucket classes are compared by all their
signs: a pair that differs in more than a pair at the threshold does, but for ``MARGIN`` standard
deviations, is ruled out. Only ids and packed signs are shuffled for that. Components of the pairs that
are left are families, to which each vector is sent once; in a family all pairs are compared by matrix
products in double precision, in blocks, and yield counts by vector and at most a spanning forest of
links. Buckets beyond ``LIST`` and families beyond ``block`` vectors are dealt over pairs of blocks.

``bits`` follows the number of vectors, so that buckets stay small as the table grows; the number of
tables follows from ``bits`` so that a pair at the threshold is missed with probability ``MISS`` at
most (pairs nearer than that, far less).

Defined cases: vectors that are null, empty, all zero or with null or non-finite components link
with nothing and are their own components; vectors of different lengths don't link; a row with a null
vec_id links with nothing, has no component and is kept; rows that repeat a vec_id with the same vector
are one vector, and each gets its result; an empty table gives no rows; labels and other columns are
ignored. The result has no order.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, stored
from .components import components, connect_lists, union_find

THRESHOLD = 0.95
MISS = 1e-4
#: Deviations from the mean number of signs in which a pair at the threshold differs.
MARGIN = 6.0
#: Classes of a bucket that a task compares by signs; up to ``SHORT`` pair by pair, together.
LIST = 50_000
SHORT = 96
#: Vectors of a block of a family and of a task, on average, and rows of a matrix product.
BLOCK = 1024
ROWS = 512
SEED = 20_11


def shape(n: int, threshold: float = THRESHOLD, miss: float = MISS) -> tuple[int, int]:
    """Signs a table and tables, for n vectors."""
    bits = min(30, max(6, math.ceil(math.log2(max(n, 1) / 32 + 1))))
    agree = 1 - math.acos(threshold) / math.pi
    return bits, math.ceil(math.log(miss) / math.log1p(-(agree**bits)))


def unit_rows(values: np.ndarray, size: int) -> np.ndarray:
    x = values.reshape(-1, size)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # so that squares neither vanish nor overflow
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _signs(bits: int, tables: int):
    """rep, size, packed signs and the bucket of each table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        place = 1 << np.arange(bits, dtype=np.int64)
        for batch in batches:
            ids = batch.column(0).to_numpy()
            sizes = np.array(batch.column(1).value_lengths())
            values = batch.column(1).flatten().to_numpy(zero_copy_only=False)
            ends = np.concatenate([[0], np.cumsum(sizes)])
            for size in np.unique(sizes).tolist():
                at = np.flatnonzero(sizes == size)
                x = unit_rows(values[(ends[at][:, None] + np.arange(size)).ravel()], size)
                if size not in planes:
                    planes[size] = np.random.default_rng((SEED, size)).normal(size=(size, bits * tables))
                signs = x @ planes[size] > 0
                buckets = (signs.reshape(len(at), tables, bits) * place).sum(axis=2)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1, dtype=np.int32) * tables), pa.array(buckets.ravel()))
                packed = pa.array([row.tobytes() for row in np.packbits(signs, axis=1)], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(ids[at]), pa.array(np.full(len(at), size, np.int32)), packed, lists], names=["rep", "size", "signs", "buckets"])

    return run


def _candidates(most: int):
    """Pairs of a bucket that differ in ``most`` signs at most, as links that connect the same."""

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("size", "ascending"), ("tab", "ascending"), ("bucket", "ascending")])
        node = rows.column("rep").to_numpy()
        signs = np.frombuffer(b"".join(rows.column("signs").to_pylist()), np.uint8).reshape(len(node), -1)
        signs = np.pad(signs, ((0, 0), (0, -signs.shape[1] % 8))).view(np.uint64)
        where = np.stack([rows.column(c).to_numpy().astype(np.int64) for c in ("size", "tab", "bucket")])
        key = np.cumsum(np.concatenate([[0], (where[:, 1:] != where[:, :-1]).any(axis=0)]))
        near = lambda x, y: np.bitwise_count(signs[x] ^ signs[y]).sum(axis=1, dtype=np.int64) <= most
        x, y = connect_lists(key, near, SHORT, 1 << 16)
        nodes, root = union_find(node[x], node[y])
        return pa.table({"a": nodes[nodes != root], "b": root[nodes != root]})

    return run


def _compare(threshold: float):
    """Of a family, or two blocks of one: links counted by vector, and links that connect the same."""

    def family(rows: pd.DataFrame, i: int, j: int) -> list[pd.DataFrame]:
        rows = rows.sort_values("rep")
        unit = np.stack([unit_rows(x, len(x))[0] for x in rows["x"]])
        ids, weight, side = rows["rep"].to_numpy(), rows["copies"].to_numpy(), rows["block"].to_numpy()
        left, right = np.flatnonzero(side == i), np.flatnonzero(side == j)
        links, label = np.zeros(len(ids), np.int64), np.arange(len(ids))
        for a in range(0, len(left), ROWS):
            at = left[a : a + ROWS]
            near = unit[at] @ unit[right].T >= threshold
            if i == j:
                near &= at[:, None] != right[None, :]
            links[at] += near @ weight[right]
            if i != j:
                links[right] += weight[at] @ near
            for row, hit in zip(at.tolist(), near):
                found = right[hit]
                if (label[found] != label[row]).any():
                    joined = np.unique(np.append(label[found], label[row]))
                    label[np.isin(label, joined)] = joined[0]
        counted, tree = np.flatnonzero(links), np.flatnonzero(label != np.arange(len(ids)))
        return [
            pd.DataFrame({"rep": ids[counted], "other": pd.array([None] * len(counted), dtype="Int64"), "links": links[counted]}),
            pd.DataFrame({"rep": ids[tree], "other": pd.array(ids[label[tree]], dtype="Int64"), "links": np.zeros(len(tree), np.int64)}),
        ]

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        i, j = int(pdf["i"].iloc[0]), int(pdf["j"].iloc[0])
        parts = [x for _, rows in pdf.groupby(["family", "size"], sort=False) for x in family(rows, i, j)]
        return pd.concat(parts, ignore_index=True)

    return run


def pairs_of_blocks(rows: DataFrame, blocks: Column) -> DataFrame:
    """Each row goes to every pair (i, j) of blocks that holds its own."""
    rows = rows.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return rows.withColumn("i", F.least("block", "with")).withColumn("j", F.greatest("block", "with"))


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, miss: float = MISS, block: int = BLOCK) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept."""
    spark = vectors.sparkSession
    bounded_batches(spark)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("x"))
    fine = F.coalesce((F.size("x") > 0) & ~F.exists("x", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))) & F.exists("x", lambda v: v != 0), F.lit(False))
    rows = stored(rows.select("vec_id", F.when(fine, F.transform("x", lambda v: v + F.lit(0.0))).alias("x")).withColumn("key", F.when(fine & F.col("vec_id").isNotNull(), F.sha2(F.to_json("x"), 256))))
    once = rows.where("key is not null").select("vec_id", "key").distinct()
    classes = stored(once.groupBy("key").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies")))
    bits, tables = shape(classes.count(), threshold, miss)
    reps = classes.join(rows.select(F.col("vec_id").alias("rep"), "key", "x"), ["key", "rep"]).dropDuplicates(["key"])
    reps = stored(reps.select("rep", "copies", "x"))
    signed = stored(reps.select("rep", "x").mapInArrow(_signs(bits, tables), "rep long, size int, signs binary, buckets array<long>"))
    where = ["size", "tab", "bucket"]
    sizes = signed.select("size", F.posexplode("buckets").alias("tab", "bucket")).groupBy(where).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    member = signed.select("rep", "size", "signs", F.posexplode("buckets").alias("tab", "bucket")).join(stored(sizes), where)
    member = pairs_of_blocks(member, F.ceil(F.col("n") / LIST).cast("int"))
    tasks = 1 + classes.count() * tables // LIST
    member = member.withColumn("task", F.pmod(F.xxhash64(*where), F.when(F.col("blocks") > 1, F.lit(1 << 62)).otherwise(F.lit(tasks))))
    away = 1 - (1 - math.acos(threshold) / math.pi)
    most = math.ceil(bits * tables * away + MARGIN * math.sqrt(bits * tables * away * (1 - away)))
    pairs = member.select(*where, "task", "i", "j", "rep", "signs").groupBy("task", "i", "j").applyInArrow(_candidates(most), "a long, b long")
    families = components(pairs).select(F.col("node").alias("rep"), F.col("component").alias("family"))
    per_family = families.groupBy("family").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("_blocks"))
    held = reps.join(families, "rep").join(stored(per_family), "family").withColumn("size", F.size("x"))
    held = pairs_of_blocks(held, F.col("_blocks"))
    tasks = 1 + classes.count() // block
    held = held.withColumn("task", F.when(F.col("blocks") > 1, F.col("family")).otherwise(F.pmod(F.xxhash64("family"), F.lit(tasks)))).withColumn("large", F.col("blocks") > 1)
    group = ["large", "task", "i", "j"]
    found = stored(held.select(*group, "block", "family", "size", "rep", "copies", "x").groupBy(*group).applyInPandas(_compare(threshold), "rep long, other long, links long"))
    links = found.where("other is null").groupBy("rep").agg(F.sum("links").alias("links"))
    joined = components(found.where("other is not null"), "rep", "other")
    classes = classes.join(links, "rep", "left").join(joined.withColumnRenamed("node", "rep"), "rep", "left")
    classes = stored(classes.select("key", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id")))
    out = rows.where("key is not null").select("vec_id", "key").join(classes, "key", "left").drop("key")
    alone = rows.where("key is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    out = out.unionByName(alone).select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
