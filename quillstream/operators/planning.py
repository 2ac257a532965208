"""Page windows, cuts and packings: order-dependent plans as folds over arrays or islands of windows."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.markdown import missing_marker


def page_windows(docs: DataFrame, size: int, single: int | None = None) -> DataFrame:
    """(doc_id, pages) → doc_id, idx, start, end; one window where the pages are at most ``single``."""
    whole = F.lit(False) if single is None else F.col("pages") <= single
    starts = F.when(whole, F.array(F.lit(1))).otherwise(F.sequence(F.lit(1), F.col("pages").cast("int"), F.lit(size)))
    out = docs.where("pages >= 1").select("doc_id", "pages", whole.alias("_w"), F.posexplode(starts).alias("idx", "start"))
    return out.select("doc_id", "idx", "start", F.when(F.col("_w"), F.col("pages")).otherwise(F.least(F.col("start") + size - 1, F.col("pages"))).cast("int").alias("end"))


def chunk_plan(docs: DataFrame, oversized: DataFrame, size: int) -> DataFrame:
    """(doc_id, pages) and oversized (doc_id, page) → doc_id, action, start, end: oversized pages are
    skipped alone, runs between them are cut into windows."""
    pages = docs.where("pages >= 1").select("doc_id", F.explode(F.sequence(F.lit(1), F.col("pages").cast("int"))).alias("page"))
    marked = pages.join(oversized.select("doc_id", F.col("page").cast("int").alias("page"), F.lit(1).alias("_skip")).distinct(), ["doc_id", "page"], "left")
    w = Window.partitionBy("doc_id").orderBy("page")
    marked = marked.withColumn("_skip", F.coalesce("_skip", F.lit(0))).withColumn("_island", F.sum("_skip").over(w))
    rank = F.row_number().over(Window.partitionBy("doc_id", "_island", "_skip").orderBy("page"))
    marked = marked.withColumn("_part", F.when(F.col("_skip") == 1, F.lit(-1)).otherwise(F.floor((rank - 1) / size)))
    out = marked.groupBy("doc_id", "_island", "_skip", "_part").agg(F.min("page").alias("start"), F.max("page").alias("end"))
    return out.select("doc_id", F.when(F.col("_skip") == 1, "skip").otherwise("ocr").alias("action"), "start", "end")


def join_chunks(chunks: DataFrame) -> DataFrame:
    """(doc_id, idx, start, end, text) → doc_id, md: in order, with a marker for a chunk without text;
    a document without any text has none."""
    text = F.coalesce("text", missing_marker(F.col("start"), F.col("end")))
    parts = F.transform(F.array_sort(F.collect_list(F.struct("idx", text.alias("t")))), lambda x: x["t"])
    return chunks.groupBy("doc_id").agg(F.when(F.count("text") > 0, F.array_join(parts, "\n\n---\n\n")).alias("md"))


def pack_blocks(blocks: DataFrame, most: int, joint: int = 2) -> DataFrame:
    """(doc_id, block_no, n_chars) → doc_id, block_no, chunk: blocks in order, a new chunk where the
    next would not fit; a block that is too large stands alone. Rows stream by in order, and no more is
    kept of a document than its last chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        doc, used, chunk = object(), 0, -1
        for batch in batches:
            out = []
            for d, n in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if d != doc:
                    doc, used, chunk = d, 0, -1
                if chunk < 0 or (used is not None and n is not None and used + n > most):
                    used, chunk = 0, chunk + 1
                used = None if used is None or n is None else used + n + joint
                out.append(chunk)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.int32())], ["doc_id", "block_no", "chunk"])

    rows = blocks.select("doc_id", "block_no", "n_chars").repartition("doc_id").sortWithinPartitions("doc_id", "block_no", "n_chars")
    types = {f.name: f.dataType.simpleString() for f in rows.schema}
    return rows.mapInArrow(run, f"doc_id {types['doc_id']}, block_no {types['block_no']}, chunk int")


def boundaries(toc: DataFrame, deepest: int = 3) -> DataFrame:
    """(doc_id, ord, level, title, page) → doc_id, page, level, title: the highest entry of each page,
    the first of equals."""
    fine = toc.where((F.col("page") >= 1) & F.col("level").between(1, deepest))
    best = fine.groupBy("doc_id", "page").agg(F.min_by(F.struct("level", "title"), F.struct("level", "ord", "title")).alias("b"))
    return best.select("doc_id", "page", "b.level", "b.title")


def cuts(docs: DataFrame, marks: DataFrame, target: int, least: int, most: int) -> DataFrame:
    """(doc_id, pages) and boundaries (doc_id, page) → doc_id, seg, start, end, reason: segments end
    before the boundary nearest to the target (the smaller of equals), else at the target; what is left
    ends the plan once it is at most ``most`` pages."""
    held = marks.groupBy("doc_id").agg(F.sort_array(F.collect_set(F.col("page").cast("int"))).alias("b"))
    base = docs.where("pages >= 1").select("doc_id", F.col("pages").cast("int").alias("pages")).join(held, "doc_id", "left").withColumn("b", F.coalesce("b", F.array().cast("array<int>")))
    segment = "array<struct<start:int,end:int,reason:string>>"
    start = F.struct(F.lit(1).alias("at"), F.array().cast(segment).alias("out"))
    steps = F.sequence(F.lit(1), F.floor(F.col("pages") / F.lit(max(1, min(least, target)))).cast("int") + 2)

    def step(acc, _):
        at = acc["at"]
        near = F.filter("b", lambda p: (p > 1) & (p <= F.col("pages")) & p.between(at + least, at + most))
        best = F.array_min(F.transform(near, lambda p: F.struct(F.abs(p - (at + target)).alias("d"), p.alias("p"))))["p"]
        final = F.col("pages") - at + 1 <= most
        end = F.when(final, F.col("pages")).when(best.isNotNull(), best - 1).otherwise(F.least(at + target - 1, F.col("pages"))).cast("int")
        reason = F.when(final, "final").when(best.isNotNull(), "section").otherwise("hardcut")
        more = F.concat(acc["out"], F.array(F.struct(at.alias("start"), end.alias("end"), reason.alias("reason"))))
        return F.when(at > F.col("pages"), acc).otherwise(F.struct((end + 1).cast("int").alias("at"), more.alias("out")))

    out = base.select("doc_id", F.posexplode(F.aggregate(steps, start, step)["out"]).alias("seg", "s"))
    return out.select("doc_id", "seg", "s.start", "s.end", "s.reason")


def labels(segments: DataFrame, marks: DataFrame) -> DataFrame:
    """Segments with the label of the last boundary (page, level, title) at or before their start."""
    pairs = segments.join(marks, "doc_id").where("page <= start")
    best = pairs.groupBy("doc_id", "seg").agg(F.max_by(F.struct("level", "title"), "page").alias("m"))
    text = F.concat(F.lit("L"), F.col("m.level").cast("string"), F.when(F.coalesce("m.title", F.lit("")) != "", F.concat(F.lit(":"), F.col("m.title"))).otherwise(""))
    return segments.join(best, ["doc_id", "seg"], "left").select("doc_id", "seg", "start", "end", "reason", F.when(F.col("m").isNotNull(), text).otherwise("").alias("label"))


def is_contiguous(segments: DataFrame, docs: DataFrame) -> DataFrame:
    """doc_id, ok: segments follow one another from page 1 to the last."""
    w = Window.partitionBy("doc_id").orderBy("start")
    steps = segments.withColumn("_ok", F.col("start") == F.coalesce(F.lag("end").over(w) + 1, F.lit(1)))
    per = steps.groupBy("doc_id").agg(F.bool_and("_ok").alias("_ok"), F.sum(F.col("end") - F.col("start") + 1).alias("_n"))
    return docs.join(per, "doc_id", "left").select("doc_id", F.coalesce(F.col("_ok") & (F.col("_n") == F.col("pages")), F.lit(False)).alias("ok"))


def sample_pages(docs: DataFrame, flagged: DataFrame, k: int) -> DataFrame:
    """(doc_id, pages) and flagged (doc_id, page, reason, rank) → doc_id, page, reason: flagged pages, the
    first, the last, and k evenly spaced; the first reason counts."""
    first = docs.select("doc_id", "pages", F.lit(1).alias("page"), F.lit("first-page").alias("reason"), F.lit(1000).alias("rank"))
    last = docs.select("doc_id", "pages", F.col("pages").cast("int").alias("page"), F.lit("last-page").alias("reason"), F.lit(1001).alias("rank"))
    at = F.bround(1 + (F.col("pages") - 1) / F.lit(float(k + 1)) * F.col("i")).cast("int")
    even = docs.where((F.col("pages") > 2) & F.lit(k > 0)).withColumn("i", F.explode(F.sequence(F.lit(1), F.lit(max(k, 1))))).select("doc_id", "pages", at.alias("page"), F.lit("even-spacing").alias("reason"), (F.col("i") + 1001).alias("rank"))
    marked = flagged.join(docs, "doc_id").select("doc_id", "pages", F.col("page").cast("int").alias("page"), "reason", F.col("rank").cast("int").alias("rank"))
    all_ = first.unionByName(last).unionByName(even).unionByName(marked).where(F.col("page").between(1, F.col("pages")))
    return all_.groupBy("doc_id", "page").agg(F.min_by("reason", "rank").alias("reason"))


def budget(pages: DataFrame, most: int) -> DataFrame:
    """Of each document's dense pages the first ``most`` get the costly treatment."""
    dense = F.col("tier") == "dense"
    rank = F.sum(dense.cast("int")).over(Window.partitionBy("doc_id").orderBy("page"))
    return pages.withColumn("costly", dense & (rank <= most))


def keep_longer(rows: DataFrame) -> DataFrame:
    """(…, source_chars, first, second): the second text where the first covers under 30 % of a source of
    120 characters or more and the second is longer."""
    weak = (F.col("source_chars") >= 120) & (F.length(F.coalesce("first", F.lit(""))) < 0.30 * F.col("source_chars"))
    longer = F.length(F.coalesce("second", F.lit(""))) > F.length(F.coalesce("first", F.lit("")))
    return rows.withColumn("text", F.when(weak & longer, F.col("second")).otherwise(F.col("first")))


def clean_ends(objects: DataFrame, pages: DataFrame, band: float = 0.15) -> DataFrame:
    """pages (doc_id, page) and objects (doc_id, page, top, bottom: shares of the page height) → doc_id,
    page, clean: false where something reaches the foot of the page and something the head of the next."""
    per = objects.groupBy("doc_id", "page").agg(F.max("bottom").alias("_foot"), F.min("top").alias("_head"))
    rows = pages.join(per, ["doc_id", "page"], "left")
    following = F.lead("_head").over(Window.partitionBy("doc_id").orderBy("page"))
    return rows.select("doc_id", "page", (~F.coalesce((F.col("_foot") >= 1 - band) & (following <= band), F.lit(False))).alias("clean"))


def snap_ends(segments: DataFrame, ends: DataFrame, most: int, slack: int = 12) -> DataFrame:
    """Segments (doc_id, seg, start, end) whose end moves to the first clean page at or after it, within
    ``slack`` pages more than a segment may have; else it stays."""
    near = segments.join(ends.where("clean").select("doc_id", "page"), "doc_id").where((F.col("page") >= F.col("end")) & (F.col("page") <= F.col("start") + most - 1 + slack))
    best = near.groupBy("doc_id", "seg").agg(F.min("page").alias("_to"))
    return segments.join(best, ["doc_id", "seg"], "left").withColumn("end", F.coalesce("_to", "end")).drop("_to")
