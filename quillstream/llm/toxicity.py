"""Toxicity score: a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

Features are n-grams of characters (code points, lower-cased, white space as a blank), known by
64-bit hashes, present or absent in the whole text. Counts by label come from the labelled rows and
are summed before the shuffle; features whose presence depends on the label (likelihood-ratio
statistic of ``LEAST`` or more) are used. A logistic regression over the features times their
log-count ratios weighs them. Training uses at most ``max_rows`` labels (those with the smallest hash
of doc_id), which bounds the features too; scoring reads all rows and whole texts.

Defined cases: null and empty texts have no feature and get the score of the bias; with no labelled
row, or with labels of one kind alone, every score is 0; a document that is labelled both ways counts
as two; of rows that share a doc_id the least text is learnt from; rows with a null label are left
out; an empty table gives no rows; other columns are passed on (score, held_out and predicted are
replaced).
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .chunkcodec import empty_tables
from .common import bounded_batches, held_out, release, spans, stored, utf8
from .textkernels import STEP, U, mix

ORDERS = (3, 4, 5)
#: Labels that training reads at most.
MAX_ROWS = 12_000
#: Least likelihood-ratio statistic of a feature that is used, and what is added to its counts.
LEAST = 16.0
SMOOTH = 0.5
CUTOFF = 0.3
SPAN = 1 << 18
#: Bits of the table that tells which features may be used, before they are looked up.
QUICK_BITS = 22


@dataclass(frozen=True)
class Model:
    chosen: np.ndarray  # the features that are used, sorted
    weight: np.ndarray  # of each
    bias: float


def _folded() -> np.ndarray:
    """Of each code point below 65536 the lower-case one, or a blank for white space."""
    out = np.arange(1 << 16, dtype=np.uint32)
    for k in range(1 << 16):
        c = chr(k)
        if c.isspace():
            out[k] = 32
        elif len(c.lower()) == 1:
            out[k] = ord(c.lower())
    return out


FOLDED = _folded()


def characters(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Folded code points of UTF-8 texts and the offsets of these texts among them."""
    leads = (data & 0xC0) != 0x80
    at = np.flatnonzero(leads)
    point = data[at].astype(np.uint32)
    padded = np.concatenate([data, np.zeros(3, np.uint8)])
    for first, last, mask in ((0xC0, 1, 0x1F), (0xE0, 2, 0x0F), (0xF0, 3, 0x07)):
        several = np.flatnonzero(data[at] >= first)  # longer ones are done again
        point[several] = data[at[several]] & mask
        for k in range(1, last + 1):
            point[several] = point[several] << np.uint32(6) | (padded[at[several] + k] & 0x3F)
    low = point < len(FOLDED)
    point[low] = FOLDED[point[low]]
    return point, np.concatenate([[0], np.cumsum(leads)])[offsets]


def features(data: np.ndarray, offsets: np.ndarray, model: Model | None = None, quick: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, feature) pairs, ordered; with a model only its features, by their numbers."""
    point, offsets = characters(data, offsets)
    n = len(point)
    texts, found = [np.zeros(0, np.int64)], [np.zeros(0, np.int64 if model else np.uint64)]
    h = np.zeros(n, np.uint64)
    for k in range(max(ORDERS)):
        if n - k <= 0:
            break
        h = h[: n - k] * U(0xD6E8FEB86659FD93) + (point[k:].astype(np.uint64) + U(1))
        if k + 1 not in ORDERS:
            continue
        whole = np.ones(n - k, bool)  # none reaches over the end of a text
        for back in range(1, k + 1):
            at = offsets[1:] - back
            whole[at[(at >= 0) & (at < n - k)]] = False
        feature = mix(h + U((k + 1) * int(STEP) % (1 << 64)))
        if model is not None:
            at = np.flatnonzero(whole & quick[(feature & U((1 << QUICK_BITS) - 1)).astype(np.int64)])
            number = np.minimum(np.searchsorted(model.chosen, feature[at]), len(model.chosen) - 1)
            same = model.chosen[number] == feature[at]
            at, feature = at[same], number[same]
        else:
            at = np.flatnonzero(whole)
            feature = feature[at]
        texts.append(np.searchsorted(offsets, at, side="right") - 1)
        found.append(feature)
    text, feature = np.concatenate(texts), np.concatenate(found)
    order = np.lexsort((feature, text))
    text, feature = text[order], feature[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (feature[1:] != feature[:-1])
    return text[new], feature[new]


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """feature and in how many texts of label 0 and of label 1 it is, for runs of rows."""
    empty_tables()
    for batch in batches:
        labels = batch.column(1).to_numpy(zero_copy_only=False)
        data, offsets = utf8(batch.column(0))
        for a, b in spans(offsets, SPAN):
            text, feature = features(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
            feature, at = np.unique(feature, return_inverse=True)
            of_one = np.bincount(at, weights=labels[a:b][text], minlength=len(feature)).astype(np.int64)
            total = np.bincount(at, minlength=len(feature))
            yield pa.RecordBatch.from_arrays([pa.array(feature.view(np.int64)), pa.array(total - of_one), pa.array(of_one)], names=["feature", "c0", "c1"])


def dependence(c0: Column, c1: Column, n0: int, n1: int) -> Column:
    """The likelihood-ratio statistic of presence and label."""

    def part(seen: Column, expected: Column) -> Column:
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    share = (c0 + c1) / F.lit(float(n0 + n1))
    cells = [(c0, share * n0), (c1, share * n1), (n0 - c0, (1 - share) * n0), (n1 - c1, (1 - share) * n1)]
    total = F.lit(0.0)
    for seen, expected in cells:
        total = total + part(seen.cast("double"), expected)
    return 2 * total


def fit_regression(rows: list[np.ndarray], labels: np.ndarray, scale: np.ndarray, steps: int = 150, decay: float = 1e-3) -> tuple[np.ndarray, float]:
    """Weights of scaled binary features by full-batch Adam on the log loss."""
    sizes = np.array([len(x) for x in rows])
    ends = np.concatenate([[0], np.cumsum(sizes)])
    column = np.concatenate(rows).astype(np.intp) if rows else np.zeros(0, np.intp)
    rate = labels.mean()
    w, bias = np.zeros(len(scale)), float(np.log(rate / (1 - rate)))
    m, v = np.zeros(len(scale) + 1), np.zeros(len(scale) + 1)
    for step in range(1, steps + 1):
        total = np.concatenate([[0.0], np.cumsum((scale * w)[column])])
        z = bias + total[ends[1:]] - total[ends[:-1]]
        error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels) / len(rows)
        g = np.append(scale * np.bincount(column, weights=np.repeat(error, sizes), minlength=len(scale)) + decay * w, error.sum())
        m = 0.9 * m + 0.1 * g
        v = 0.99 * v + 0.01 * g * g
        move = 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        w -= move[:-1]
        bias -= move[-1]
    return w, bias


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> Model | None:
    """A model of the labelled rows outside the held-out quarter; None without label 1 or label 0."""
    spark = docs.sparkSession
    bounded_batches(spark)
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("label")).where("doc_id is not null and label in (0, 1)")
    paths: list[str] = []
    known = stored(known.where(~held_out("doc_id")).distinct().orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(max_rows), paths)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    try:
        sample = stored(texts.join(known, "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text")).select("text", "label"), paths)
        totals = {x["label"]: x["count"] for x in sample.groupBy("label").count().collect()}
        if len(totals) < 2:
            return None
        counts = sample.mapInArrow(_counts, "feature long, c0 long, c1 long").groupBy("feature").agg(F.sum("c0").alias("c0"), F.sum("c1").alias("c1")).where("c0 + c1 > 1")
        # As many as ``max_rows`` texts can give.
        got = counts.where(dependence(F.col("c0"), F.col("c1"), totals[0], totals[1]) >= LEAST).toArrow()
        order = np.argsort(got.column("feature").to_numpy().view(np.uint64))
        chosen, c0, c1 = (got.column(c).to_numpy()[order] for c in ("feature", "c0", "c1"))
        chosen = chosen.view(np.uint64)
        if not len(chosen):
            return Model(chosen, np.zeros(0), math.log(totals[1] / totals[0]))
        ratio = np.log((c1 + SMOOTH) / (totals[1] + 2 * SMOOTH)) - np.log((c0 + SMOOTH) / (totals[0] + 2 * SMOOTH))
        plain = Model(chosen, ratio, 0.0)
        shared = spark.sparkContext.broadcast(plain)

        def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            model = shared.value
            quick = quick_table(model)
            for batch in batches:
                data, offsets = utf8(batch.column(0))
                for a, b in spans(offsets, SPAN):
                    text, number = features(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], model, quick)
                    cuts = np.searchsorted(text, np.arange(b - a + 1))
                    number = number.astype("<u4")
                    blobs = [number[x:y].tobytes() for x, y in zip(cuts[:-1], cuts[1:])]
                    yield pa.RecordBatch.from_arrays([batch.column(1).slice(a, b - a), pa.array(blobs, pa.binary())], names=["label", "columns"])

        got = sample.mapInArrow(rows, "label int, columns binary").toArrow()
        pairs = sorted(zip(got.column("label").to_pylist(), got.column("columns").to_pylist()))  # so that sums do not depend on tasks
        truth = np.array([x for x, _ in pairs], float)
        found = [np.frombuffer(x, "<u4") for _, x in pairs]
        w, bias = fit_regression(found, truth, ratio)
        return Model(chosen, w * ratio, bias)
    finally:
        release(spark, paths)


def quick_table(model: Model) -> np.ndarray:
    quick = np.zeros(1 << QUICK_BITS, bool)
    quick[(model.chosen & U((1 << QUICK_BITS) - 1)).astype(np.int64)] = True
    return quick


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """All columns of ``docs`` and ``score``; a ``score`` that ``docs`` has is replaced."""
    docs = docs.drop("score")
    if model is None:
        return docs.withColumn("score", F.lit(0.0))
    spark = docs.sparkSession
    bounded_batches(spark)
    shared = spark.sparkContext.broadcast(model)  # of the features that a bounded sample can give

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        empty_tables()
        model = shared.value
        quick = quick_table(model)
        for texts in batches:
            data, offsets = utf8(pa.array(texts, pa.string(), from_pandas=True))
            out = np.full(len(texts), model.bias)
            for a, b in spans(offsets, SPAN) if len(model.chosen) else ():
                text, number = features(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], model, quick)
                out[a:b] += np.bincount(text, weights=model.weight[number], minlength=b - a)
            yield pd.Series(1 / (1 + np.exp(-np.clip(out, -30, 30))))

    return docs.withColumn("score", scored(F.col("text").cast("string")))


def classify(docs: DataFrame, labels: DataFrame, cutoff: float = CUTOFF, max_rows: int = MAX_ROWS) -> DataFrame:
    """``docs`` with held_out, score and predicted."""
    scored = score(docs, train(docs, labels, max_rows))
    return scored.withColumn("held_out", held_out("doc_id")).withColumn("predicted", (F.col("score") >= cutoff).cast("int"))
