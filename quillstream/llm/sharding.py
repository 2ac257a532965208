"""Sharding by extendible hashing: a directory over prefixes of the hash's bits.

A row's hash is the first 60 bits of the MD5 of its key. A bucket is a prefix of these bits; one
that holds more bytes than a shard may is split on its next bit, and only such a one, until every
bucket fits. Byte counts are first summed by cells (prefixes somewhat longer than the shards need),
so buckets are found on a small table; cells that are too large alone are refined further. Rows of
one hash cannot be parted by more bits: where they are over the limit together, they are dealt over
overflow shards of their bucket at full depth, by size: rows of which m fit a shard go together, m to
a shard, so every overflow shard is within the limit and, but for the last of its kind, half full. A
row larger than the limit has a shard of its own; no other shard is over the limit.

Everything is DataFrame work. Defined cases: null text counts no bytes; a null key hashes like an
empty one; repeated rows share a hash; an empty table gives no rows and no shards.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

LIMIT = 4 << 20
DEPTH = 60
#: Bits of a cell beyond what equal shards would take, and bits of each refinement.
SLACK = 4
#: Limits' worth of bytes, on average, within which rows of one hash are numbered in a task.
TURN = 64
#: Rows of an overflow shard at most.
MOST = 1 << 20


def key_hash(key: Column) -> Column:
    """The first 60 bits of the key's MD5."""
    return F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), 1, 15), 16, 10).cast("long")


def directory(rows: DataFrame, limit: int) -> tuple[DataFrame, int]:
    """Leaves (depth, bucket, bytes) of the rows ``h``, ``bytes``, and the bits of the first cells."""
    total = rows.agg(F.sum("bytes")).first()[0] or 0
    first = min(DEPTH, max(0, math.ceil(math.log2(max(1.0, total / limit)))) + SLACK)
    low, open_, leaves = 0, rows.select("h", "bytes"), []
    high = first
    while True:
        cells = stored(open_.groupBy(F.shiftright("h", DEPTH - high).alias("cell")).agg(F.sum("bytes").alias("bytes")))
        # Bytes of every prefix from ``low`` to ``high`` bits; a leaf fits (or is as deep as can be) and its parent doesn't.
        every = cells.withColumn("depth", F.explode(F.sequence(F.lit(low), F.lit(high))))
        every = every.groupBy("depth", F.expr(f"shiftright(cell, {high} - depth)").alias("bucket")).agg(F.sum("bytes").alias("bytes"))
        every = stored(every)
        parents = every.select((F.col("depth") + 1).alias("depth"), F.col("bucket").alias("parent"), F.col("bytes").alias("above"))
        split = every.withColumn("parent", F.shiftright("bucket", 1)).join(parents, ["depth", "parent"], "left")
        top = F.col("depth") == low  # what comes in at the lowest depth is too large above, or the root
        fits = (F.col("bytes") <= limit) | (F.col("depth") == DEPTH)
        leaves.append(split.where(fits & (top | (F.col("above") > limit))).select("depth", "bucket", "bytes"))
        if high == DEPTH:
            break
        large = stored(every.where((F.col("depth") == high) & (F.col("bytes") > limit)).select(F.col("bucket").alias("cell")))
        if large.isEmpty():
            break
        open_ = open_.withColumn("cell", F.shiftright("h", DEPTH - high)).join(large, "cell", "left_semi").select("h", "bytes")
        low, high = high + 1, min(DEPTH, high + 1 + SLACK)
    out = leaves[0]
    for more in leaves[1:]:
        out = out.unionByName(more)
    return stored(out), first


def by_cell(leaves: DataFrame, bits: int) -> DataFrame:
    """By the first ``bits`` of a hash, the leaves there in order of their first hash."""
    leaf = F.struct(F.expr(f"shiftleft(bucket, {DEPTH} - depth)").alias("first"), F.col("depth"), F.col("bucket"), F.col("bytes"))
    wide = F.expr(f"sequence(shiftleft(bucket, {bits} - depth), shiftleft(bucket, {bits} - depth) + shiftleft(1L, {bits} - depth) - 1)")
    deep = F.array(F.expr(f"shiftright(bucket, depth - {bits})"))
    cells = leaves.select(F.explode(F.when(F.col("depth") <= bits, wide).otherwise(deep)).alias("_cell"), leaf.alias("leaf"))
    return cells.groupBy("_cell").agg(F.sort_array(F.collect_list("leaf")).alias("_leaves"))


def overflow(rows: DataFrame, limit: int) -> DataFrame:
    """Shards within the limit for rows of single hashes that are over it together."""
    totals = rows.groupBy("_h").agg((F.sum("n_bytes") / (TURN * limit)).cast("long").alias("_turns"))
    room = F.least(F.floor(F.lit(limit) / F.greatest("n_bytes", F.lit(1))), F.lit(MOST)).cast("long")
    many = F.when(room <= 4, room).otherwise(F.expr("1L") * F.pow(F.lit(2.0), F.floor(F.log2(room))).cast("long"))  # so that kinds are few
    rows = rows.join(totals, "_h").withColumn("_m", many).withColumn("_place", F.monotonically_increasing_id())
    rows = rows.withColumn("_turn", F.pmod(F.xxhash64("_place"), F.col("_turns") + 1))
    kind = ["_h", "_m", "_turn"]
    rank = F.row_number().over(Window.partitionBy(*kind).orderBy("_place")) - 1
    rows = rows.withColumn("_k", F.floor(rank / F.greatest("_m", F.lit(1))))
    rows = rows.withColumn("shard", F.concat("shard", F.lit("+"), F.concat_ws(".", F.col("_m"), F.col("_turn"), F.col("_k"))))
    whole = Window.partitionBy(*kind, "_k")
    return rows.withColumn("shard_bytes", F.sum("n_bytes").over(whole)).drop("_turns", "_m", "_place", "_turn", "_k")


def assign(docs: DataFrame, key: str = "doc_id", text: str = "text", limit: int = LIMIT) -> DataFrame:
    """``docs`` with n_bytes, depth, bucket, shard (bits, with ``+`` and a number for overflow shards) and shard_bytes."""
    docs = docs.drop("n_bytes", "depth", "bucket", "shard", "shard_bytes")
    docs = docs.withColumn("n_bytes", F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long")).withColumn("_h", key_hash(F.col(key)))
    leaves, first = directory(docs.select(F.col("_h").alias("h"), F.col("n_bytes").alias("bytes")), limit)
    out = docs.withColumn("_cell", F.shiftright("_h", DEPTH - first)).join(stored(by_cell(leaves, first)), "_cell")
    out = out.withColumn("_leaf", F.element_at(F.filter("_leaves", lambda x: x["first"] <= F.col("_h")), -1))
    out = out.select(*docs.columns, "_leaf.depth", "_leaf.bucket", F.col("_leaf.bytes").alias("_total"))
    bits = F.lpad(F.conv(F.col("bucket").cast("string"), 10, 2), F.col("depth"), "0")
    out = out.withColumn("shard", F.when(F.col("depth") == 0, F.lit("")).otherwise(bits))
    is_over = (F.col("_total") > limit) & (F.col("depth") == DEPTH)
    fit = out.where(~is_over).withColumn("shard_bytes", F.col("_total"))
    over = leaves.where((F.col("bytes") > limit) & (F.col("depth") == DEPTH))
    if not over.isEmpty():
        fit = fit.unionByName(overflow(stored(out.where(is_over)), limit))
    return fit.drop("_h", "_total")
