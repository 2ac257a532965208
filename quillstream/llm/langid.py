"""Language identification by a byte convolutional network trained in numpy.

A text is cut into windows of a fixed number of bytes. Byte embeddings pass filters of several
widths; each filter's largest response in a window goes to a softmax over the languages. A text's
prediction sums its windows' log probabilities, weighed by the bytes in them. For prediction the
product of embedding and filter is tabulated by byte pair, so a filter of width w costs w / 2 lookups.

Training uses at most ``max_docs`` documents (those with the smallest hash of doc_id) of known
language outside the held-out quarter, and at most ``WINDOWS`` evenly spaced windows of each.

Defined cases: a null text and a text without a letter get ``und`` and score 0; with no document to
learn from, every text gets ``und``; with a single language known every text with a letter gets it,
with score 1; repeated rows are predicted each; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .chunkcodec import empty_tables
from .common import bounded_batches, held_out, utf8

LENGTH = 192
WIDTHS = (2, 3, 4)
FILTERS = 16
EMBEDDING = 8
MAX_DOCS = 6000
WINDOWS = 4
EPOCHS = 4
BATCH = 128
UNKNOWN = "und"
#: Windows that are predicted at once: their responses stay in a core's cache.
AT_ONCE = 64


@dataclass(frozen=True)
class Network:
    languages: list[str]
    embedding: np.ndarray  # 256 x EMBEDDING
    filters: list[np.ndarray]  # by width: width * EMBEDDING x FILTERS
    biases: list[np.ndarray]
    dense: np.ndarray
    dense_bias: np.ndarray

    def tables(self) -> list[list[np.ndarray]]:
        """By width: responses by byte pair for each two taps, and by byte for a last odd tap."""
        out = []
        for width, filters, bias in zip(WIDTHS, self.filters, self.biases):
            taps = [(self.embedding @ filters[k * EMBEDDING : (k + 1) * EMBEDDING]).astype(np.float32) for k in range(width)]
            taps[0] = taps[0] + bias.astype(np.float32)
            pairs = []
            for k in range(0, width - 1, 2):
                pairs.append((taps[k][:, None, :] + taps[k + 1][None, :, :]).reshape(65536, -1))  # high byte first
            if width % 2:
                pairs.append(taps[-1])
            out.append(pairs)
        return out


def window_matrix(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All windows of all texts, padded with zero bytes, and the range of windows of each text."""
    first = np.concatenate([[0], np.cumsum(-(-np.diff(offsets) // LENGTH))])
    flat = np.zeros(int(first[-1]) * LENGTH, np.uint8)
    for k in range(len(offsets) - 1):
        flat[first[k] * LENGTH : first[k] * LENGTH + offsets[k + 1] - offsets[k]] = data[offsets[k] : offsets[k + 1]]
    return flat.reshape(-1, LENGTH), first


def log_softmax(z: np.ndarray) -> np.ndarray:
    z = z - z.max(axis=1, keepdims=True)
    return z - np.log(np.exp(z).sum(axis=1, keepdims=True))


class Predictor:
    def __init__(self, network: Network):
        self.network, self.tables = network, network.tables()
        self.dense = network.dense.astype(np.float32)

    def windows(self, matrix: np.ndarray) -> np.ndarray:
        """Log probabilities of each window."""
        out = np.empty((len(matrix), len(self.network.languages)), np.float32)
        for a in range(0, len(matrix), AT_ONCE):
            block = matrix[a : a + AT_ONCE]
            pair = (block[:, :-1].astype(np.uint16) << 8) | block[:, 1:]
            pooled = []
            for width, tables in zip(WIDTHS, self.tables):
                n = LENGTH - width + 1
                response = tables[0][pair[:, :n]]
                for k in range(2, width, 2):
                    response += tables[k // 2][pair[:, k : k + n] if k + 1 < width else block[:, k : k + n]]
                pooled.append(np.maximum(response.max(axis=1), 0))
            out[a : a + AT_ONCE] = log_softmax(np.concatenate(pooled, axis=1) @ self.dense + self.network.dense_bias)
        return out

    def texts(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The best language of each text (its number) and its probability."""
        sizes = np.diff(offsets)
        best = np.zeros(len(sizes), np.int64)
        chance = np.zeros(len(sizes))
        for a in range(0, len(sizes), 200):
            b = min(a + 200, len(sizes))
            matrix, first = window_matrix(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
            if not len(matrix):
                continue
            weight = np.count_nonzero(matrix, axis=1) / LENGTH
            logs = self.windows(matrix) * weight[:, None]
            total = np.vstack([np.zeros((1, logs.shape[1])), np.cumsum(logs, axis=0, dtype=np.float64)])
            mass = np.concatenate([[0], np.cumsum(weight)])
            per = (total[first[1:]] - total[first[:-1]]) / np.maximum(1e-9, mass[first[1:]] - mass[first[:-1]])[:, None]
            probability = np.exp(log_softmax(per))
            best[a:b] = probability.argmax(axis=1)
            chance[a:b] = probability.max(axis=1)
        return best, chance


def fit(windows: np.ndarray, truth: np.ndarray, languages: list[str], seed: int = 7) -> Network:
    """Train by mini-batch Adam; classes count alike however many windows they have."""
    rng = np.random.default_rng(seed)
    p = {"e": rng.normal(0, 0.5, (256, EMBEDDING)), "d": rng.normal(0, 0.1, (FILTERS * len(WIDTHS), len(languages))), "c": np.zeros(len(languages))}
    for width in WIDTHS:
        p[f"f{width}"] = rng.normal(0, (width * EMBEDDING) ** -0.5, (width * EMBEDDING, FILTERS))
        p[f"b{width}"] = np.zeros(FILTERS)
    p = {k: v.astype(np.float32) for k, v in p.items()}
    m, v = {k: np.zeros_like(x) for k, x in p.items()}, {k: np.zeros_like(x) for k, x in p.items()}
    share = np.bincount(truth, minlength=len(languages))
    weight = (len(truth) / np.maximum(1, share) / max(1, np.count_nonzero(share)))[truth]
    step = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(windows))
        for a in range(0, len(order), BATCH):
            at = order[a : a + BATCH]
            x, n = windows[at], len(at)
            embedded = p["e"][x]
            pooled, where = [], []
            for width in WIDTHS:
                columns = np.concatenate([embedded[:, k : LENGTH - width + 1 + k] for k in range(width)], axis=2)
                response = columns @ p[f"f{width}"]
                top = response.argmax(axis=1)
                pooled.append(np.take_along_axis(response, top[:, None, :], axis=1)[:, 0] + p[f"b{width}"])
                where.append(top)
            hidden = np.concatenate(pooled, axis=1)
            active = np.maximum(hidden, 0)
            probability = np.exp(log_softmax(active @ p["d"] + p["c"]))
            probability[np.arange(n), truth[at]] -= 1
            delta = (probability * weight[at, None] / n).astype(np.float32)
            g = {"d": active.T @ delta, "c": delta.sum(axis=0), "e": np.zeros_like(p["e"])}
            back = (delta @ p["d"].T) * (hidden > 0)
            for j, width in enumerate(WIDTHS):
                d = back[:, j * FILTERS : (j + 1) * FILTERS]  # only the largest response of a window has a gradient
                g[f"b{width}"] = d.sum(axis=0)
                part = []
                for k in range(width):
                    seen = x[np.arange(n)[:, None], where[j] + k]
                    rows = p["f%d" % width][k * EMBEDDING : (k + 1) * EMBEDDING]
                    part.append(np.einsum("nf,nfe->ef", d, p["e"][seen]))
                    np.add.at(g["e"], seen.ravel(), (d[:, :, None] * rows.T[None]).reshape(-1, EMBEDDING))
                g[f"f{width}"] = np.concatenate(part)
            step += 1
            for k in p:
                m[k] = 0.9 * m[k] + 0.1 * g[k]
                v[k] = 0.999 * v[k] + 0.001 * g[k] ** 2
                p[k] -= (0.004 * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-7)).astype(np.float32)
    return Network(languages, p["e"], [p[f"f{w}"] for w in WIDTHS], [p[f"b{w}"] for w in WIDTHS], p["d"], p["c"])


def training_windows(docs: DataFrame, max_docs: int) -> DataFrame:
    """(lang, windows): evenly spaced windows of the documents to learn from."""
    known = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    known = known.where("text is not null and lang is not null and text rlike '\\\\p{L}'").where(~held_out("doc_id"))
    chosen = known.select("doc_id", F.xxhash64("doc_id").alias("h")).distinct().orderBy("h", "doc_id").limit(max_docs).agg(F.max("h").alias("h")).first()["h"]
    known = known.where(F.xxhash64("doc_id") <= F.lit(chosen if chosen is not None else -(1 << 63)))
    known = known.groupBy("doc_id").agg(F.min(F.struct("text", "lang")).alias("r")).select("r.text", "r.lang")  # a row for each doc_id

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(0))
            matrix, first = window_matrix(data, offsets)
            blobs = []
            for a, b in zip(first[:-1], first[1:]):
                n = min(WINDOWS, b - a)
                blobs.append(matrix[a + (np.arange(n) * (b - a)) // max(n, 1)].tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(blobs, pa.binary())], names=["lang", "windows"])

    return known.select("text", "lang").mapInArrow(cut, "lang string, windows binary")


def train(docs: DataFrame, max_docs: int = MAX_DOCS) -> Network | None:
    bounded_batches(docs.sparkSession)
    got = training_windows(docs, max_docs).toArrow()
    if not got.num_rows:
        return None
    pairs = sorted(zip(got.column("lang").to_pylist(), got.column("windows").to_pylist()))
    languages = sorted({x for x, _ in pairs})
    windows = np.frombuffer(b"".join(x for _, x in pairs), np.uint8).reshape(-1, LENGTH)
    truth = np.repeat([languages.index(x) for x, _ in pairs], [len(x) // LENGTH for _, x in pairs])
    return fit(windows, truth, languages)


def identify(docs: DataFrame, network: Network | None = None, max_docs: int = MAX_DOCS) -> DataFrame:
    """``docs`` with held_out, lang_pred and score (columns of these names are replaced)."""
    docs = docs.drop("held_out", "lang_pred", "score")
    network = network or train(docs, max_docs)
    spark = docs.sparkSession
    bounded_batches(spark)
    text = F.col("text").cast("string")
    readable = F.coalesce(text.rlike("\\p{L}"), F.lit(False))
    out = docs.withColumn("held_out", held_out("doc_id"))
    if network is None:
        return out.withColumn("lang_pred", F.lit(UNKNOWN)).withColumn("score", F.lit(0.0))
    shared = spark.sparkContext.broadcast(network)  # of fixed size

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        empty_tables()
        predictor = Predictor(shared.value)
        names = np.array(shared.value.languages, object)
        for series in texts:
            data, offsets = utf8(pa.array(series, pa.string(), from_pandas=True))
            best, chance = predictor.texts(data, offsets)
            yield pd.DataFrame({"lang_pred": names[best], "score": chance})

    out = out.withColumn("_got", predict(F.when(readable, text)))
    return out.withColumns({"lang_pred": F.when(readable, F.col("_got.lang_pred")).otherwise(UNKNOWN), "score": F.when(readable, F.col("_got.score")).otherwise(0.0)}).drop("_got")
