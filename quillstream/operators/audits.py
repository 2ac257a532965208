"""Audit checks: each a DataFrame of findings (doc_id, severity, check, page, detail); their union is the audit."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import markdown as M
from ..functions import tables as G
from ..functions import text as T
from .lines import with_fences, with_pages
from .passes import dedup_headings


def finding(rows: DataFrame, check: str, page: Column | None, detail: Column, severity: str = "fail") -> DataFrame:
    return rows.select("doc_id", F.lit(severity).alias("severity"), F.lit(check).alias("check"), (page if page is not None else F.lit(None)).cast("int").alias("page"), detail.cast("string").alias("detail"))


def coverage(docs: DataFrame, lines: DataFrame, marker: str = "doc") -> DataFrame:
    """docs (doc_id, pages): every page has its marker, and nothing is missing, truncated or thin."""
    want = docs.where("pages >= 1").select("doc_id", F.explode(F.sequence(F.lit(1), F.col("pages").cast("int"))).alias("page"))
    have = lines.select("doc_id", M.page_number(F.col("line")).alias("page")).where("page is not null").distinct()
    absent = finding(want.join(have, ["doc_id", "page"], "left_anti"), "coverage", F.col("page"), F.lit("page marker missing"))
    bad = with_pages(lines).where(F.col("line").contains("<!-- MISSING") | F.col("line").contains("<!-- TRUNCATED") | F.col("line").contains(f"{marker}:coverage-low"))
    return absent.unionByName(finding(bad, "coverage", F.col("page"), T.strip(F.col("line"))))


def heading_repeats(lines: DataFrame) -> DataFrame:
    kept = dedup_headings(lines)
    gone = with_pages(lines).join(kept.select("doc_id", "line_no", "sub_no"), ["doc_id", "line_no", "sub_no"], "left_anti").where(~T.blank(F.col("line")))
    return finding(gone, "heading_repeat", F.col("page"), T.strip(F.col("line")), "warn")


def captions(lines: DataFrame) -> DataFrame:
    """doc_id, line_no, page, kind, number, title, bold, continued of caption lines outside fences."""
    rx = r"(?i)^\s*(?:#{1,6}\s*)?(\**)\s*(table|figure)\s+(\d+)\s*[:.]\s*(.*)$"
    hit = with_pages(with_fences(lines)).where(~F.col("in_fence") & F.col("line").rlike(rx))
    part = lambda k: F.regexp_extract("line", rx, k)
    title = T.strip(F.regexp_replace(part(4), r"\*+$", ""))
    return hit.select("doc_id", "line_no", "page", F.initcap(part(2)).alias("kind"), part(3).alias("number"), M.without_continued(title).alias("title"), (part(1) == "**").alias("bold"), title.rlike(r"(?i)\(continued\)\s*$").alias("continued"))


def caption_checks(lines: DataFrame, evidence: DataFrame) -> DataFrame:
    """Captions against evidence (doc_id, page, kind, number, title): one for one, bold, equal in text."""
    md = captions(lines).where("not continued")
    key = ["doc_id", "page", "kind", "number"]
    m = md.groupBy(*key).agg(F.count(F.lit(1)).alias("n"), F.min("title").alias("md"), F.bool_and("bold").alias("bold"))
    e = evidence.groupBy(*key).agg(F.min("title").alias("vec"))
    both = m.join(e, key, "full_outer")
    what = F.concat_ws(" ", "kind", "number")
    state = F.when(F.col("md").isNull(), "missing").when(F.col("vec").isNull(), "without evidence").when(F.col("n") > 1, "repeated").when(~F.col("bold"), "not bold")
    state = state.when(T.alnum_key(F.col("md")) != T.alnum_key(F.col("vec")), "differs")
    return finding(both.withColumn("_s", state).where("_s is not null"), "captions", F.col("page"), F.concat(what, F.lit(": "), F.col("_s")))


def continued_checks(lines: DataFrame, continuations: DataFrame) -> DataFrame:
    """Captions marked as continued stand only on continuation pages (doc_id, page, number), and all of
    those have one."""
    md = captions(lines).where("continued and kind = 'Table'").select("doc_id", "page", "number")
    c = continuations.select("doc_id", "page", "number")
    key = ["doc_id", "page", "number"]
    return finding(md.join(c, key, "left_anti"), "continued", F.col("page"), F.concat(F.lit("Table "), "number")).unionByName(
        finding(c.join(md, key, "left_anti"), "continued_missing", F.col("page"), F.concat(F.lit("Table "), "number"))
    )


def chains(tops: DataFrame, most_y: float = 110.0) -> DataFrame:
    """Tables (doc_id, page, y0, header: array, number, captioned): which continue the last table of the
    page before: at the top, without a caption, equal header. number is the chain's first one."""
    w = Window.partitionBy("doc_id").orderBy("page", "y0")
    rows = tops.withColumns({"_key": G.header_key(F.col("header")), "_first": F.row_number().over(Window.partitionBy("doc_id", "page").orderBy("y0")) == 1})
    rows = rows.withColumns({"_pk": F.lag("_key").over(w), "_pp": F.lag("page").over(w)})
    goes_on = F.col("_first") & ~F.col("captioned") & (F.col("y0") <= most_y) & (F.col("page") == F.col("_pp") + 1) & (F.col("_key") == F.col("_pk"))
    rows = rows.withColumn("continues", F.coalesce(goes_on, F.lit(False)))
    return rows.withColumn("number", F.last(F.when(~F.col("continues"), F.struct("number")), ignorenulls=True).over(w)["number"]).select(*tops.columns, "continues")


def structure(lines: DataFrame) -> DataFrame:
    """Raw HTML tables outside fences, and tables of a header alone."""
    from .scans import table_blocks

    raw = with_pages(with_fences(lines)).where(~F.col("in_fence") & F.col("line").rlike(M.HTML_TABLE))
    empty = table_blocks(lines).where("rows <= 2").select("doc_id", F.lit(None).cast("int").alias("page"), F.col("first_line").alias("line"))
    return finding(raw, "structure", F.col("page"), F.substring(T.strip(F.col("line")), 1, 120)).unionByName(finding(empty, "structure", F.col("page"), F.concat(F.lit("table without data at line "), F.col("line").cast("string"))))


def order(items: DataFrame, tolerance: float = 2.0) -> DataFrame:
    """Items (doc_id, page, line_no, y) whose y is above that of the item before by more than allowed."""
    w = Window.partitionBy("doc_id", "page").orderBy("line_no")
    back = items.withColumn("_up", F.lag("y").over(w) - F.col("y")).where(F.col("_up") > tolerance)
    return finding(back, "order", F.col("page"), F.concat(F.lit("line "), F.col("line_no").cast("string")))


def cells(md: DataFrame, vec: DataFrame) -> DataFrame:
    """Rows (doc_id, page, tbl, row_no, cells): keys missing from either side, or in another order."""
    key = lambda df: df.withColumn("_k", T.alnum_key(F.array_join("cells", "")))
    per = lambda df, name: key(df).groupBy("doc_id", "page", "tbl").agg(F.transform(F.array_sort(F.collect_list(F.struct("row_no", "_k"))), lambda x: x["_k"]).alias(name))
    both = per(md, "a").join(per(vec, "b"), ["doc_id", "page", "tbl"])
    lost = F.size(F.array_except("b", "a"))
    added = F.size(F.array_except("a", "b"))
    what = F.when(lost + added > 0, F.format_string("%d rows lost, %d added", lost, added)).when(F.col("a") != F.col("b"), F.lit("rows in another order"))
    return finding(both.withColumn("_w", what).where("_w is not null"), "cells", F.col("page"), F.col("_w"))


def prose(blocks: DataFrame, body: DataFrame) -> DataFrame:
    """Source blocks (doc_id, page, block_no, line) all of whose significant lines the body (doc_id, page,
    text) lacks."""
    words = body.groupBy("doc_id", "page").agg(F.array_distinct(F.flatten(F.collect_set(T.tokens(F.col("text"))))).alias("_w"))
    lines = blocks.where(F.size(T.tokens(F.col("line"))) >= 2).join(words, ["doc_id", "page"], "left")
    gone = ~T.covered(F.col("line"), F.coalesce("_w", F.array().cast("array<string>")))
    bad = lines.groupBy("doc_id", "page", "block_no").agg(F.bool_and(gone).alias("_bad"), F.min("line").alias("line")).where("_bad")
    return finding(bad, "prose", F.col("page"), F.substring("line", 1, 120))


def repeated_prose(lines: DataFrame) -> DataFrame:
    """Loose lines of five words or more that a table row of their document contains."""
    keyed = with_pages(lines).withColumn("_k", T.present_key(F.col("line"))).withColumn("_t", M.is_table_line(F.col("line")))
    rows = keyed.where("_t").select("doc_id", F.col("_k").alias("_row"))
    loose = keyed.where(~F.col("_t") & (F.size(F.split("_k", " ")) >= 5))
    hit = loose.join(rows, "doc_id").where(F.contains(F.col("_row"), F.col("_k"))).select("doc_id", "page", "line").distinct()
    return finding(hit, "repeated_prose", F.col("page"), F.substring(T.strip(F.col("line")), 1, 120), "warn")


def audit(*checks: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, checks)


def verdict(findings: DataFrame, docs: DataFrame) -> DataFrame:
    """doc_id, fails, warns, passed of every document."""
    per = findings.groupBy("doc_id").agg(F.count_if(F.col("severity") == "fail").alias("fails"), F.count_if(F.col("severity") == "warn").alias("warns"))
    out = docs.select("doc_id").join(per, "doc_id", "left").select("doc_id", F.coalesce("fails", F.lit(0)).alias("fails"), F.coalesce("warns", F.lit(0)).alias("warns"))
    return out.withColumn("passed", F.col("fails") == 0)
