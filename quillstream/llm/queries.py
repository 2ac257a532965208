"""The registered queries of the training-data operators and the SQL that states them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, jaccard_join, langid, neardup_vectors, packing, quality, sentencepiece_codec, sharding, substring_dedup, toxicity
from .common import table


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substring_dedup.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_codec.summary(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.assign(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return placed.select("doc_id", "n_bytes", F.col("depth").cast("int").alias("depth"), "shard", "shard_bytes")


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity.classify(docs, table(spark, sf_dir, "labels")).select("doc_id", "held_out", "score", "predicted")


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    judged = quality.apply_rules(docs, table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op8_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.repair(table(spark, sf_dir, "conversations"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return langid.identify(docs).select("doc_id", "held_out", "lang_pred", "score")


def op10_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup_vectors.near_duplicates(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_sentencepiece": op2_sentencepiece,
    "op3_ngram_jaccard_join": op3_ngram_jaccard_join,
    "op4_sharding": op4_sharding,
    "op5_best_fit_packing": op5_best_fit_packing,
    "op6_toxicity": op6_toxicity,
    "op7_quality_rules": op7_quality_rules,
    "op8_chat_formatting": op8_chat_formatting,
    "op9_language_id": op9_language_id,
    "op10_embedding_near_dedup": op10_embedding_near_dedup,
    "pipeline": pipeline,
}
WORDS = r"""word AS (SELECT doc_id, unnest(range(len(w))) AS k, unnest(w) AS word
        FROM (SELECT doc_id, regexp_extract_all({}, '[^\x20\x09-\x0D]+') AS w FROM documents))"""
ASCII_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _run_of(width: int) -> str:
    """The words from each on, as one text; null where fewer than ``width`` follow."""
    parts = ", ".join(["word", *(f"lead(word, {k}) OVER own" for k in range(1, width))])
    return f"CASE WHEN lead(word, {width - 1}) OVER own IS NOT NULL THEN concat_ws(' ', {parts}) END"


def _covered(column: str, width: int) -> str:
    """Whether a run of ``width`` words that starts at the word or before it has ``column``."""
    return f"max({column}) OVER (PARTITION BY doc_id ORDER BY k ROWS BETWEEN {width - 1} PRECEDING AND CURRENT ROW) = 1"


ORACLE: dict[str, str] = {
    "op1_substring_dedup": f"""
        WITH {WORDS.format("text")}, run AS (
            SELECT doc_id, k, word, {_run_of(substring_dedup.WIDTH)} AS g FROM word WINDOW own AS (PARTITION BY doc_id ORDER BY k)
        ), marked AS (
            SELECT doc_id, k, word, CASE WHEN g IS NOT NULL AND count(*) OVER (PARTITION BY g) > 1 THEN 1 ELSE 0 END AS again FROM run
        ), gone AS (SELECT doc_id, k, word, {_covered("again", substring_dedup.WIDTH)} AS gone FROM marked),
        kept AS (
            SELECT doc_id, count(*) AS n_words, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY k) FILTER (NOT gone) AS text FROM gone GROUP BY doc_id
        )
        SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
        FROM documents d LEFT JOIN kept USING (doc_id)
    """,
    "op3_ngram_jaccard_join": f"""
        WITH RECURSIVE {WORDS.format(ASCII_LOWER)}, run AS (
            SELECT doc_id, {_run_of(jaccard_join.WIDTH)} AS s FROM word WINDOW own AS (PARTITION BY doc_id ORDER BY k)
            UNION ALL SELECT doc_id, string_agg(word, ' ' ORDER BY k) FROM word GROUP BY doc_id HAVING count(*) < {jaccard_join.WIDTH}
        ), shingle AS (SELECT DISTINCT doc_id, s FROM run WHERE s IS NOT NULL),
        size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
        common AS (
            SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM shingle a JOIN shingle b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL
        ), links AS (
            SELECT a, b FROM common JOIN size p ON p.doc_id = a JOIN size q ON q.doc_id = b WHERE 100 * c >= {jaccard_join.PERCENT} * (p.n + q.n - c)
        ), near AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
        reach(a, b) AS (SELECT a, b FROM near UNION SELECT reach.a, near.b FROM reach JOIN near ON reach.b = near.a),
        least AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
        SELECT d.doc_id, coalesce(n, 0) AS n_shingles, least(d.doc_id, coalesce(least.b, d.doc_id)) AS component_id
        FROM documents d LEFT JOIN size USING (doc_id) LEFT JOIN least ON least.a = d.doc_id
    """,
    # Where no stratum has the 1,151 good labels that a cutoff needs, ``kept`` is the base rule; sf0.01 has fewer.
    "op7_quality_rules": f"""
        WITH {WORDS.format("text")}, run AS (
            SELECT doc_id, k, word, {_run_of(quality.WIDTH)} AS g FROM word WINDOW own AS (PARTITION BY doc_id ORDER BY k)
        ), marked AS (
            SELECT doc_id, k, word, CASE WHEN g IS NOT NULL AND count(*) OVER (PARTITION BY doc_id, g) > 1 THEN 1 ELSE 0 END AS again FROM run
        ), covered AS (SELECT doc_id, word, {_covered("again", quality.WIDTH)} AS again FROM marked),
        counted AS (SELECT doc_id, count(*) AS n_words, sum(length(word))::BIGINT AS word_chars, count(*) FILTER (again) AS n_repeat_words FROM covered GROUP BY doc_id),
        line AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents),
        lines AS (SELECT doc_id, (count(*) - count(DISTINCT line))::BIGINT AS n_dup_lines FROM line WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
        measured AS (
            SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars,
                   coalesce(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')), 0)::BIGINT AS n_symbols,
                   coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
            FROM documents d LEFT JOIN counted USING (doc_id) LEFT JOIN lines USING (doc_id)
        )
        SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed, NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AS kept FROM measured
    """,
    "op4_sharding": f"""
        WITH hashed AS (
            SELECT doc_id, coalesce(octet_length(encode(text)), 0)::BIGINT AS n_bytes,
                   ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS h FROM documents
        ), every AS (
            SELECT d AS depth, h >> ({sharding.DEPTH} - d) AS bucket, sum(n_bytes)::BIGINT AS bytes
            FROM hashed, range(0, 25) r(d) GROUP BY ALL
        ), leaf AS (
            SELECT e.depth, e.bucket, e.bytes FROM every e LEFT JOIN every p ON p.depth = e.depth - 1 AND p.bucket = e.bucket >> 1
            WHERE e.bytes <= {sharding.LIMIT} AND (p.bytes IS NULL OR p.bytes > {sharding.LIMIT})
        )
        SELECT doc_id, n_bytes, depth::INTEGER AS depth,
               CASE WHEN depth = 0 THEN '' ELSE lpad(bin(bucket), depth::INTEGER, '0') END AS shard, bytes AS shard_bytes
        FROM hashed JOIN leaf ON leaf.bucket = h >> ({sharding.DEPTH} - depth)
    """,
    "op10_embedding_near_dedup": """
        WITH RECURSIVE fine AS (
            SELECT vec_id, embedding::DOUBLE[] AS x FROM embeddings
            WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0
              AND len(list_filter(embedding, lambda v: v <> 0)) > 0
        ), links AS (
            SELECT p.vec_id AS a, q.vec_id AS b FROM fine p JOIN fine q
              ON p.vec_id <> q.vec_id AND len(p.x) = len(q.x) AND list_cosine_similarity(p.x, q.x) >= 0.95
        ), reach(a, b) AS (
            SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
        ), least AS (SELECT a, min(b) AS b FROM reach GROUP BY a),
        degree AS (SELECT a, count(*) AS n FROM links GROUP BY a)
        SELECT e.vec_id, coalesce(degree.n, 0) AS n_links, least(e.vec_id, coalesce(least.b, e.vec_id)) AS component_id,
               e.vec_id = least(e.vec_id, coalesce(least.b, e.vec_id)) AS kept
        FROM embeddings e LEFT JOIN least ON least.a = e.vec_id LEFT JOIN degree ON degree.a = e.vec_id
    """,
}
