"""Quality rules whose cutoffs are risk-controlled on labelled texts.

Base measures of a text are counted exactly (see ``measures``). On top of the fixed base rule, each
method rule compares one ratio with a cutoff. For every stratum (texts by number of words) and rule
the candidates of a fixed grid are tested in sequence, the most lenient first, up to the first that
fails: a cutoff is allowed if the exact binomial (Clopper-Pearson) upper bound of the share of good
labelled texts that it rejects is at most ``risk`` divided by the number of rules. The bounds hold
together with probability ``1 - delta``: every sequence has level delta / (strata x rules), which a
fixed sequence need not divide by its candidates. The last allowed cutoff, which rejects most, is
used; where none is allowed, the rule rejects nothing there.

Defined cases: a null text has no words and fails the base rule; with no labels no method rule
rejects; labels of ids that no document has, and null labels, are ignored; a document with several
good labels counts once; repeated rows are judged each; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, spans, stored, utf8
from .textkernels import Words, covered, mix, windows

WIDTH = 8
SPAN = 1 << 20
SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True

RISK = 0.02
DELTA = 0.05
#: Upper ends of the strata, in words; a last stratum has no end.
STRATA = (100, 500, 2000)
#: Each rule's ratio and the grid of its candidates; a text with a ratio above the cutoff is rejected.
RULES: dict[str, tuple[float, ...]] = {
    "symbol_ratio": tuple(k / 100 for k in range(1, 21)),
    "dup_line_ratio": tuple(k / 100 for k in range(2, 62, 3)),
    "repeat_ratio": tuple(k / 100 for k in range(1, 31)),
    "long_word_ratio": tuple(float(k) for k in range(8, 28)),
}

MEASURES = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def repeat_words(words: Words) -> np.ndarray:
    """Of each text, the words in 8-word windows whose words stand twice or more in that text."""
    texts = len(words.first) - 1
    starts, h = windows(words, words.hashes(), WIDTH)
    if not len(starts):
        return np.zeros(texts, np.int64)
    own = np.searchsorted(words.first, starts, side="right") - 1
    key = mix(h + own.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    twice = np.zeros(len(key), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    total = np.concatenate([[0], np.cumsum(covered(len(words), starts[twice], WIDTH))])
    return total[words.first[1:]] - total[words.first[:-1]]


def duplicate_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = text.split(b"\n")
    if len(lines) == 1:
        return 0
    lines = [x for x in lines if x.strip()]
    return len(lines) - len(set(lines))


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = utf8(batch.column(1))
        for a, b in spans(offsets, SPAN):
            part, at = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
            words = Words(part, at)
            code_points = np.concatenate([[0], np.cumsum(words.inside & ((part & 0xC0) != 0x80))])
            symbols = np.concatenate([[0], np.cumsum(SYMBOLS[part])])
            lines = [duplicate_lines(part[x:y].tobytes()) for x, y in zip(at[:-1], at[1:])]
            columns = [np.diff(words.first), code_points[at[1:]] - code_points[at[:-1]], symbols[at[1:]] - symbols[at[:-1]], np.array(lines), repeat_words(words)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(a, b - a), *(pa.array(x.astype(np.int64)) for x in columns)],
                names=["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"],
            )


def measures(docs: DataFrame) -> DataFrame:
    """doc_id and the exact counts of each text."""
    bounded_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(_measure, MEASURES)


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def ratios() -> dict[str, Column]:
    words, chars = F.greatest(F.col("n_words"), F.lit(1)), F.greatest(F.col("word_chars"), F.lit(1))
    return {
        "symbol_ratio": F.col("n_symbols") / chars,
        "dup_line_ratio": 10 * F.col("n_dup_lines") / words,
        "repeat_ratio": F.col("n_repeat_words") / words,
        "long_word_ratio": F.col("word_chars") / words,
    }


def stratum() -> Column:
    out = F.lit(len(STRATA))
    for k in reversed(range(len(STRATA))):
        out = F.when(F.col("n_words") < STRATA[k], k).otherwise(out)
    return out


def log_binomial_tail(k: int, n: int, p: float) -> float:
    """log P(X <= k) for X binomial (n, p), summed from its largest term."""
    if p <= 0 or k >= n:
        return 0.0
    if p >= 1:
        return -math.inf
    log = math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * math.log(p) + (n - k) * math.log1p(-p)
    total, term, j = 1.0, 1.0, k
    while j > 0 and term > 1e-17 * total:
        term *= j / (n - j + 1) * (1 - p) / p
        total += term
        j -= 1
    return min(0.0, log + math.log(total))


def upper_bound(k: int, n: int, level: float) -> float:
    """The exact one-sided upper bound of a share of which k in n were seen: P(X <= k) = level."""
    if n == 0 or k >= n:
        return 1.0
    low, high = k / n, 1.0
    for _ in range(60):
        p = (low + high) / 2
        low, high = (p, high) if log_binomial_tail(k, n, p) > math.log(level) else (low, p)
    return high


def cutoffs(measured: DataFrame, labels: DataFrame, risk: float = RISK, delta: float = DELTA) -> dict[tuple[int, str], float]:
    """The cutoff of each stratum and rule; those without an allowed one are left out.

    What is collected is one row for each stratum: a count for each rule and candidate.
    """
    good = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").alias("_quality")).where("_quality = 1").distinct()
    counts = [
        F.count_if(ratios()[rule] > cutoff).alias(f"{rule}_{k}") for rule, grid in RULES.items() for k, cutoff in enumerate(grid)
    ]
    rows = measured.join(good, "doc_id").where(~base_failed()).groupBy(stratum().alias("stratum")).agg(F.count(F.lit(1)).alias("n"), *counts).collect()
    level = delta / ((len(STRATA) + 1) * len(RULES))
    out = {}
    for row in rows:
        for rule, grid in RULES.items():
            for k in reversed(range(len(grid))):  # grids rise, so the last is the most lenient
                if upper_bound(row[f"{rule}_{k}"], row["n"], level) > risk / len(RULES):
                    break
                out[row["stratum"], rule] = grid[k]
    return out


def judge(measured: DataFrame, chosen: dict[tuple[int, str], float]) -> DataFrame:
    """Add base_failed and kept."""
    rejected = F.lit(False)
    for (band, rule), cutoff in sorted(chosen.items()):
        rejected = rejected | ((stratum() == band) & (ratios()[rule] > cutoff))
    return measured.withColumn("base_failed", base_failed()).withColumn("kept", ~base_failed() & ~rejected)


def apply_rules(docs: DataFrame, labels: DataFrame, risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """One row per document: its measures, base_failed and kept."""
    measured = stored(measures(docs))
    return judge(measured, cutoffs(measured, labels, risk, delta))
