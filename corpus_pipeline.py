"""From raw documents to packed sequences: language, toxicity, near copies, repeats, packing.

Every stage reads what the one before it kept and returns the columns of ``documents``; the last
returns the pieces of sequences.

- language_id: documents without a letter go, and those whose language the network cannot tell (its
  best language is less probable than ``LEAST_CHANCE``).
- toxicity: documents predicted toxic go.
- ngram_jaccard_join: of the documents that links connect (Jaccard of five-word shingles 0.8 or
  more), the one with the least doc_id stays; rows without a doc_id stay, rows that share one stay
  or go together.
- substring_dedup: words in repeated windows go; a text without repeats stays as it is. ``n_chars``
  follows the text.
- best_fit_packing: what is left, as pieces placed in sequences.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstream.llm import jaccard_join, langid, packing, substring_dedup, toxicity
from quillstream.llm.common import release, stored, stored_alone, table
from quillstream.shipping import ship


#: Words of a shingle and similarity in hundredths of the near-copy stage; op3 has its own contract.
NEAR_WIDTH, NEAR_PERCENT = 5, 80


#: Least probability of the best language; of four languages the best has 0.25 at least.
LEAST_CHANCE = 0.4


def _where(docs: DataFrame, judge: Callable[[DataFrame], DataFrame], condition: str, added: tuple[str, ...]) -> DataFrame:
    """The rows of ``docs`` for which ``judge``'s columns ``added`` meet ``condition``; columns of
    ``docs`` with these names stay as they are."""
    aside = {c: f"_aside_{k}" for k, c in enumerate(docs.columns) if c in added}
    judged = judge(docs.withColumnsRenamed(aside)).where(condition)
    return judged.select(*[F.col(aside.get(c, c)).alias(c) for c in docs.columns])


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    condition = f"lang_pred <> '{langid.UNKNOWN}' and score >= {LEAST_CHANCE}"
    return _where(docs, langid.identify, condition, ("lang_pred", "score", "held_out"))


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    labels = table(spark, sf_dir, "labels")
    return _where(docs, lambda d: toxicity.classify(d, labels), "predicted = 0", ("score", "held_out", "predicted"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    copies = jaccard_join.join(docs, width=NEAR_WIDTH, percent=NEAR_PERCENT).where("component_id <> doc_id").select("doc_id").distinct()
    return docs.join(stored(copies), "doc_id", "left_anti").select(*docs.columns)


def remove_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    aside = {c: f"_aside_{k}" for k, c in enumerate(docs.columns) if c in ("n_words", "n_removed")}
    out = substring_dedup.remove_repeats(docs.withColumnsRenamed(aside), untouched=True)
    length = F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
    out = out.withColumn("n_chars", length)
    return out.select(*[F.col(aside.get(c, c)).alias(c) for c in docs.columns])


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return packing.pack_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("toxicity", remove_toxic),
    ("ngram_jaccard_join", drop_near_copies),
    ("substring_dedup", remove_repeats),
    ("best_fit_packing", pack),
]

#: Classifiers and packing are beyond SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; what a stage returns is written and read again by the next, and
    deleted with the stage's own tables once the next is written."""
    docs = table(spark, sf_dir, "documents")
    last: list[str] = []
    for _, stage in STAGES[:-1]:
        docs, path = stored_alone(lambda stage=stage, docs=docs: stage(spark, docs, sf_dir))
        release(spark, last)
        last = path
    return STAGES[-1][1](spark, docs, sf_dir)
