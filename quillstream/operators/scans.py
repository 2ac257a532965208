"""Scans that count, vote and classify: repetition, runs of table lines, verdicts, tiers, QA signals."""

from __future__ import annotations

import re
from collections import Counter

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import circuits as C
from ..functions import markdown as M
from ..functions import text as T
from .lines import explode_lines, so_far, with_pages


def line_repetition(docs: DataFrame, text: str = "md") -> DataFrame:
    """doc_id, max_rep: how often a document's most frequent line stands (0 without one)."""
    lines = explode_lines(docs, text, all_breaks=True).withColumn("s", T.strip(F.col("line"))).where("s <> ''")
    alike = ["doc_id", F.xxhash64("s").alias("h"), F.length("s").alias("n")]  # hashes are shuffled, not lines
    most = lines.groupBy(*alike).count().groupBy("doc_id").agg(F.max("count").alias("max_rep"))
    return docs.select("doc_id").join(most, "doc_id", "left").select("doc_id", F.coalesce("max_rep", F.lit(0)).cast("long").alias("max_rep"))


#: Where ``one_break`` puts a break; of white space, Python splits at one character that is none for (?U)\s.
BREAKS = re.compile("[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]")
NO_SPACE = "\x1f"


def most_grams(text: str | None, size: int, least_chars: int) -> int:
    """The most repeats of an n-gram with a letter within one line of so many characters."""
    best = 0
    for line in BREAKS.split(text or ""):
        if len(line) < least_chars:
            continue
        words = line.split() if NO_SPACE not in line else [w for w in re.split(f"[{T.SPACE}]+", line) if w]
        for gram, n in Counter(zip(*(words[k:] for k in range(size)))).items():
            if n > best and any(c.isalpha() for w in gram for c in w):
                best = n
    return best


def ngram_repetition(docs: DataFrame, text: str = "md", size: int = 3, least_chars: int = 1000) -> DataFrame:
    """doc_id, max_gram: the most repeats of an n-gram with a letter within one long line. A line is counted
    where its row is: nothing is shuffled."""

    @F.pandas_udf("long")
    def most(texts: pd.Series) -> pd.Series:
        return pd.Series([most_grams(t, size, least_chars) for t in texts], dtype="int64")

    long = F.when(F.length(text) >= least_chars, F.col(text))
    return docs.select("doc_id", F.when(long.isNotNull(), most(long)).otherwise(F.lit(0).cast("long")).alias("max_gram"))


def degenerate(docs: DataFrame, text: str = "md", lines: int = 5, grams: int = 20) -> DataFrame:
    both = line_repetition(docs, text).join(ngram_repetition(docs, text), "doc_id")
    return both.select("doc_id", ((F.col("max_rep") >= lines) | (F.col("max_gram") >= grams)).alias("degenerate"))


def table_blocks(lines: DataFrame, least: int = 2) -> DataFrame:
    """Maximal runs of table lines: doc_id, block_no, first_line, last_line, rows."""
    is_row = F.coalesce(M.is_table_line(F.col("line")), F.lit(False))
    runs = lines.withColumn("_row", is_row).withColumn("_run", F.sum((~F.col("_row")).cast("int")).over(so_far())).where("_row")
    runs = runs.groupBy("doc_id", "_run").agg(F.min("line_no").alias("first_line"), F.max("line_no").alias("last_line"), F.count(F.lit(1)).alias("rows")).where(F.col("rows") >= least)
    return runs.select("doc_id", F.row_number().over(Window.partitionBy("doc_id").orderBy("first_line")).alias("block_no"), "first_line", "last_line", "rows")


def is_toc(lines: DataFrame, block: str = "block_no") -> DataFrame:
    """doc_id, block, is_toc: the first line that counts is a title of contents, or five entries or more."""
    s = T.strip(F.col("line"))
    counts = (s != "") & ~s.startswith("<!--")
    title = F.lower(T.strip(F.regexp_replace(s, r"^#+\s*", "")))
    first = F.min_by(F.when(counts, title), F.when(counts, F.struct("line_no", "sub_no")))
    return lines.groupBy("doc_id", block).agg((F.coalesce(first.isin(*M.TOC_TITLES), F.lit(False)) | (F.count_if(M.is_toc_entry(F.col("line"))) >= 5)).alias("is_toc"))


def toc_tables(lines: DataFrame) -> DataFrame:
    """Rows of lists of contents: doc_id, line_no, section (indented by level), page."""
    hit = lines.where(M.is_toc_entry(F.col("line")))
    part = lambda k: F.regexp_extract("line", M.TOC_ENTRY, k)
    section = F.concat(F.repeat(F.lit("&emsp;"), M.toc_level(part(1), part(2))), T.strip(part(2)))
    return hit.select("doc_id", "line_no", section.alias("section"), part(3).cast("int").alias("page"))


def verdicts(lines: DataFrame) -> DataFrame:
    """(doc_id, run, line_no, line) → the first line's verdict on each designator of a run."""
    rows = lines.select("doc_id", "run", "line_no", "line", F.posexplode(C.designators(F.col("line"))).alias("place", "designator"))
    rows = rows.withColumn("v", C.verdict(F.col("line"), F.col("designator")))
    first = rows.groupBy("doc_id", "run", "designator").agg(F.min_by("v", F.struct("line_no", "place")).alias("v"))
    return first.select("doc_id", "run", "designator", "v.verdict", "v.raw")


def vote(rows: DataFrame, key: list[str], verdict: str = "verdict") -> DataFrame:
    """Quorum vote over the verdicts of each key; absent ones don't count. Two for unreadable win; else
    two for one value without a tie; two or more values are unverified; then two for confirmed; a lone
    flag stands; anything else is unverified."""
    special = [C.UNREADABLE, C.UNVERIFIED, C.CONFIRMED]
    per = rows.where(F.col(verdict) != C.ABSENT).groupBy(*key, verdict).agg(F.count(F.lit(1)).alias("n"))
    value = ~F.col(verdict).isin(*special)
    agg = per.groupBy(*key).agg(
        F.sum("n").alias("total"),
        F.coalesce(F.sum(F.when(F.col(verdict) == C.UNREADABLE, F.col("n"))), F.lit(0)).alias("unreadable"),
        F.coalesce(F.sum(F.when(F.col(verdict) == C.CONFIRMED, F.col("n"))), F.lit(0)).alias("confirmed"),
        F.count_if(value).alias("kinds"),
        F.coalesce(F.max(F.when(value, F.col("n"))), F.lit(0)).alias("top"),
        F.collect_list(F.when(value, F.struct("n", F.col(verdict).alias("v")))).alias("vals"),
        F.min(F.when(~value, F.col(verdict))).alias("flag"),
    )
    best = F.filter("vals", lambda x: x["n"] == F.col("top"))
    final = (
        F.when(F.col("unreadable") >= 2, C.UNREADABLE)
        .when(F.col("top") >= 2, F.when(F.size(best) == 1, F.try_element_at(best, F.lit(1))["v"]).otherwise(C.UNVERIFIED))
        .when(F.col("kinds") >= 2, C.UNVERIFIED)
        .when(F.col("confirmed") >= 2, C.CONFIRMED)
        .when((F.col("total") == 1) & F.col("flag").isNotNull(), F.col("flag"))
        .otherwise(C.UNVERIFIED)
    )
    absent = rows.select(*key).distinct()
    return absent.join(agg.select(*key, final.alias("final")), key, "left").select(*key, F.coalesce("final", F.lit(C.ABSENT)).alias("final"))


def summarise(final: DataFrame, by: list[str], column: str = "final") -> DataFrame:
    flags = [C.UNREADABLE, C.UNVERIFIED, C.CONFIRMED, C.ABSENT]
    return final.groupBy(*by).agg(
        F.count_if(~F.col(column).isin(*flags)).alias("agreed"),
        F.count_if(F.col(column) == C.CONFIRMED).alias("confirmed"),
        F.count_if(F.col(column) == C.UNVERIFIED).alias("unverified"),
        F.count_if(F.col(column) == C.UNREADABLE).alias("unreadable"),
    )


def base_run(runs: DataFrame) -> DataFrame:
    """(doc_id, run, designators, chars) → the run with most designators, then characters, then first."""
    return runs.groupBy("doc_id").agg(F.max_by("run", F.struct("designators", "chars", -F.col("run"))).alias("run"))


def dedup_items(lines: DataFrame) -> DataFrame:
    """Keep the first of item lines with a designator that are the same under ``line_key``."""
    item = M.is_item(F.col("line")) & (F.size(C.designators(F.col("line"))) > 0)
    keyed = lines.withColumn("_key", F.when(item, T.line_key(F.col("line"))))
    rank = F.row_number().over(Window.partitionBy("doc_id", "_key").orderBy("line_no", "sub_no"))
    return keyed.withColumn("_n", rank).where("_key is null or _n = 1").drop("_key", "_n")


def signals(lines: DataFrame) -> DataFrame:
    """doc_id, designators, pin_rows, keywords of each document's lines."""
    tagged = lines.select(
        "doc_id",
        C.designators(F.col("line"), wide=True).alias("d"),
        (F.col("line").rlike(C.PIN_NET) | F.col("line").contains("→")).alias("pin"),
        F.transform(F.regexp_extract_all("line", F.lit(C.KEYWORDS), F.lit(1)), F.lower).alias("k"),
    )
    return tagged.groupBy("doc_id").agg(
        F.size(F.array_distinct(F.flatten(F.collect_set("d")))).alias("designators"),
        F.count_if("pin").alias("pin_rows"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("k")))).alias("keywords"),
    )


def vector_segments(items: DataFrame) -> DataFrame:
    """(doc_id, page, op) → doc_id, page, vector_lines: a line or curve counts 1, a rectangle or quad 4."""
    weight = F.when(F.col("op").isin("l", "c"), 1).when(F.col("op").isin("re", "qu"), 4).otherwise(0)
    return items.groupBy("doc_id", "page").agg(F.sum(weight).alias("vector_lines"))


def tiers(pages: DataFrame) -> DataFrame:
    """pages (…, vector_lines, designators, pin_rows, keywords) with tier and reason."""
    t = C.tier(F.col("vector_lines"), F.col("designators"), F.col("pin_rows"), F.col("keywords"))
    return pages.withColumn("_t", t).select(*pages.columns, "_t.tier", "_t.reason")


def qa_scan(lines: DataFrame, marker: str = "doc") -> DataFrame:
    """Per document: marked HTML tables, low coverage, missing markers, captions, unreadable spots, images."""
    c = F.col("line")
    caption = ~c.rlike("(?i)continued|이어짐|계속")
    return lines.groupBy("doc_id").agg(
        F.count_if(c.contains(f"{marker}:html-table-violation")).alias("html_tables"),
        F.count_if(c.contains(f"{marker}:coverage-low")).alias("low_coverage"),
        F.count_if(c.contains("MISSING")).alias("missing"),
        F.sum(F.when(caption, F.regexp_count(c, F.lit(r"\*\*(Table|Figure)\s+(\d+)"))).otherwise(0)).alias("captions"),
        F.sum(F.regexp_count(c, F.lit(r"\[판독 불가\]"))).alias("unreadable"),
        F.sum(F.regexp_count(c, F.lit(r"!\[[^\]]*\]\(([^)]+)\)"))).alias("images"),
    )


def duplicate_captions(lines: DataFrame) -> DataFrame:
    """doc_id, caption, n of captions that stand twice or more, continued ones left out."""
    found = lines.where(~F.col("line").rlike("(?i)continued|이어짐|계속"))
    found = found.select("doc_id", F.explode(F.regexp_extract_all("line", F.lit(r"\*\*((?:Table|Figure)\s+\d+)"), F.lit(1))).alias("caption"))
    return found.groupBy("doc_id", "caption").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def page_ends(lines: DataFrame) -> DataFrame:
    """doc_id, page, first_kind and last_kind of content: table, caption, image or text; null without."""
    s = T.strip(F.col("line"))
    kind = F.when(M.is_table_line(F.col("line")), "table").when(s.rlike(r"^\s*!\["), "image").when(s.rlike(r"(?i)^\**\s*(table|figure)\s+\d+\s*[:.]"), "caption").otherwise("text")
    paged = with_pages(lines).where("page is not null").withColumn("_k", F.when(~M.is_skip(F.col("line")), kind))
    at = F.when(F.col("_k").isNotNull(), F.struct("line_no", "sub_no"))
    return paged.groupBy("doc_id", "page").agg(F.min_by("_k", at).alias("first_kind"), F.max_by("_k", at).alias("last_kind"))


def font_levels(lines: DataFrame, above: float = 1.12, chain: float = 2.0, most: int = 4) -> DataFrame:
    """(doc_id, size) of text lines → doc_id, size, level: sizes over the body's are chained into levels."""
    counts = lines.groupBy("doc_id", "size").count()
    body = counts.groupBy("doc_id").agg(F.max_by("size", F.struct("count", -F.col("size"))).alias("body"))
    w = Window.partitionBy("doc_id").orderBy(F.desc("size"))
    large = counts.join(body, "doc_id").where(F.col("size") > above * F.col("body"))
    large = large.withColumn("_new", F.coalesce(F.lag("size").over(w) - F.col("size") > chain, F.lit(True)).cast("int"))
    return large.select("doc_id", "size", F.least(F.sum("_new").over(w), F.lit(most)).cast("int").alias("level"))


def watermark_images(images: DataFrame, pages: int = 3) -> DataFrame:
    """doc_id, xref of images on so many different pages or more."""
    return images.groupBy("doc_id", "xref").agg(F.countDistinct("page").alias("pages")).where(F.col("pages") >= pages)


def first_by_hash(images: DataFrame, least_bytes: int = 8192) -> DataFrame:
    """Images of more than so many bytes, the first of each content hash."""
    rank = F.row_number().over(Window.partitionBy("doc_id", "sha256").orderBy("ord"))
    return images.where(F.col("size") > least_bytes).withColumn("_n", rank).where("_n = 1").drop("_n")


def raster_rects(images: DataFrame, left_out: DataFrame, cover: float = 0.03) -> DataFrame:
    """Images (…, x0, y0, x1, y1, pw, ph) that cover so much of their page or more, without those whose
    (doc_id, xref) is in ``left_out``, such as ``watermark_images``."""
    area = F.greatest(F.col("x1") - F.col("x0"), F.lit(0.0)) * F.greatest(F.col("y1") - F.col("y0"), F.lit(0.0))
    return images.where(area / (F.col("pw") * F.col("ph")) >= cover).join(left_out, ["doc_id", "xref"], "left_anti").select(*images.columns)


def tile_groups(images: DataFrame, gap: int = 10) -> DataFrame:
    """Images of equal size whose numbers chain are tiles of one: the first of each chain stays."""
    w = Window.partitionBy("doc_id", "page", "w", "h").orderBy("xref")
    return images.withColumn("_new", F.coalesce(F.col("xref") - F.lag("xref").over(w) > gap, F.lit(True))).where("_new").drop("_new")



def toc_pages(words: DataFrame, dots: int = 4, lines: int = 8, share: float = 0.3) -> DataFrame:
    """(doc_id, page, block, line, word) → doc_id, page of pages with many lines of leader dots."""
    per = words.groupBy("doc_id", "page", "block", "line").agg(F.sum(M.leader_dots(F.col("word"))).alias("dots"))
    pages = per.groupBy("doc_id", "page").agg(F.count_if(F.col("dots") >= dots).alias("n"), F.count(F.lit(1)).alias("total"))
    return pages.where((F.col("n") > 0) & ((F.col("n") >= lines) | (F.col("n") / F.col("total") >= share))).select("doc_id", "page")


def display_headings(lines: DataFrame, gap: float = 0.5, least: float = 6.0) -> DataFrame:
    """Heading-size lines (doc_id, page, y0, y1, text, level) merged over small gaps: text in order, the
    highest level, the top."""
    w = Window.partitionBy("doc_id", "page").orderBy("y0", "y1", "text")
    high = F.col("y1") - F.col("y0")
    rows = lines.withColumns({"_h": high, "_py1": F.lag("y1").over(w), "_ph": F.lag(high).over(w)})
    fresh = F.col("_py1").isNull() | (F.col("y0") - F.col("_py1") > gap * F.greatest(F.col("_ph"), F.col("_h"), F.lit(least)))
    rows = rows.withColumn("_g", F.sum(fresh.cast("int")).over(w))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("y0", "y1", "text"))), lambda x: T.strip(x["text"])), " ")
    out = rows.groupBy("doc_id", "page", "_g").agg(T.collapse(joined).alias("text"), F.min("level").alias("level"), F.min("y0").alias("y0"))
    return out.drop("_g")


def accepts_rewrite(pairs: DataFrame, least_length: float = 0.5, least_kept: float = 0.5, expected: int = 8) -> DataFrame:
    """(…, before, after) with accepted: false where the new text is under half as long, has lost all
    figure headings, or keeps under half of eight or more designators (those on flagged lines aside)."""
    found = lambda c: F.array_distinct(F.transform(C.designators(c), F.upper))
    pairs = pairs.withColumns({"_b": found(F.col("before")), "_a": found(F.col("after"))})
    flagged = F.filter(F.split("after", "\n", -1), lambda x: x.rlike(r"(?i)\[unverified|\[unreadable"))
    pairs = pairs.withColumn("_b", F.array_except("_b", F.flatten(F.transform(flagged, found))))
    kept = F.size(F.array_intersect("_b", "_a")) / F.greatest(F.size("_b"), F.lit(1))
    figures = lambda c: F.col(c).rlike(r"(?m)^#{1,6}[ \t]+[Ff]igure")
    bad = (F.length("after") < least_length * F.length("before")) | (figures("before") & ~figures("after")) | ((F.size("_b") >= expected) & (kept < least_kept))
    return pairs.withColumn("accepted", ~bad).drop("_a", "_b")
