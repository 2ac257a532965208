"""Document passes over exploded lines: each takes and returns (doc_id, line_no, sub_no, line)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import markdown as M
from ..functions import text as T
from .lines import after, before, by_doc, neighbours, rewrite, so_far, with_fences, with_pages

KEY = ["doc_id", "line_no", "sub_no", "line"]
WHOLE = (-(2**63), 2**63 - 1)


def with_inserts(lines: DataFrame, before_: Column | None = None, after_: Column | None = None) -> DataFrame:
    """Each line with a line before or after it where these aren't null. The input is read once, so a
    chain of passes stays as long as it is, where a union with itself would double it each time."""
    parts = []
    if before_ is not None:
        parts.append(F.struct((F.col("sub_no") - 1).alias("sub_no"), before_.alias("line"), before_.isNotNull().alias("use")))
    parts.append(F.struct("sub_no", "line", F.lit(True).alias("use")))
    if after_ is not None:
        parts.append(F.struct((F.col("sub_no") + 1).alias("sub_no"), after_.alias("line"), after_.isNotNull().alias("use")))
    rows = lines.select("doc_id", "line_no", F.explode(F.array(*parts)).alias("p")).where("p.use")
    return rows.select("doc_id", "line_no", "p.sub_no", "p.line")


def renumber_figures(lines: DataFrame) -> DataFrame:
    """Figure headings outside fences are numbered 1, 2, ... through the document; only digits change."""
    pattern = r"^(#{1,6}[ \t]+[Ff]igure[ \t]+)(\d+)"
    marked = with_fences(lines).withColumn("_is", (F.col("line").rlike(pattern) & ~F.col("in_fence")).cast("int"))
    number = F.sum("_is").over(so_far())
    rest = F.regexp_replace("line", pattern, "")
    return rewrite(marked, F.when(F.col("_is") == 1, F.concat(F.regexp_extract("line", pattern, 1), number.cast("string"), rest))).select(*KEY)


def renumber_images(lines: DataFrame, offset: int = 0) -> DataFrame:
    """The n-th image link of a document gets the number n + offset in its alternative text ``Image n``."""
    pattern = r"!\[Image \d+"
    hits = F.regexp_count("line", F.lit(pattern))
    first = F.coalesce(F.sum(hits).over(before()), F.lit(0)) + offset
    parts = F.split("line", r"(?=!\[Image \d)", -1)
    starts = lambda p: F.startswith(p, F.lit("![Image "))
    numbered = F.transform(parts, lambda p, k: F.when(starts(p), F.regexp_replace(p, r"^!\[Image \d+", "![Image §")).otherwise(p))
    start = F.struct(F.lit("").alias("text"), first.cast("long").alias("n"))
    folded = F.aggregate(
        numbered,
        start,
        lambda acc, p: F.struct(
            F.concat(acc["text"], F.replace(p, F.lit("![Image §"), F.concat(F.lit("![Image "), (acc["n"] + 1).cast("string")))).alias("text"),
            (acc["n"] + F.when(F.startswith(p, F.lit("![Image §")), 1).otherwise(0)).alias("n"),
        ),
    )
    return rewrite(lines, F.when(hits > 0, folded["text"])).select(*KEY)


def dedup_headings(lines: DataFrame) -> DataFrame:
    """Of headings with nothing but blanks between, drop those that repeat the chain's anchor: an
    unnumbered one equal to the anchor without its number, or one equal to the anchor. A heading that
    is kept is the next anchor. Blanks before a dropped heading go with it."""
    marked = with_fences(lines)
    heading = F.coalesce(F.col("line").rlike(M.HEADING) & ~F.col("in_fence"), F.lit(False))
    marked = marked.withColumn("_blank", ~F.col("in_fence") & T.blank(F.col("line"))).withColumn("_head", heading)
    # A chain ends at any line that is neither blank nor a heading.
    marked = marked.withColumn("_chain", F.sum((~F.col("_head") & ~F.col("_blank")).cast("int")).over(so_far()))
    title = F.regexp_extract("line", M.HEADING, 2)
    own = F.struct("line_no", "sub_no", T.heading_key(title).alias("core"), T.heading_raw_key(title).alias("raw"), M.has_section_number(title).alias("num"))
    marked = marked.withColumn("h", F.collect_list(F.when(F.col("_head"), own)).over(by_doc("_chain").rowsBetween(*WHOLE)))
    none = F.filter("h", lambda x: F.lit(False))
    start = F.struct(F.lit("").alias("core"), F.lit("").alias("raw"), F.lit(False).alias("any"), none.alias("gone"))

    def step(acc, x):
        repeat = acc["any"] & ((~x["num"] & (acc["core"] == x["raw"])) | (acc["raw"] == x["raw"]))
        return F.struct(
            F.when(repeat, acc["core"]).otherwise(x["core"]).alias("core"),
            F.when(repeat, acc["raw"]).otherwise(x["raw"]).alias("raw"),
            F.lit(True).alias("any"),
            F.when(repeat, F.concat(acc["gone"], F.array(x))).otherwise(acc["gone"]).alias("gone"),
        )

    marked = marked.withColumn("_dropped", F.when(F.size("h") > 1, F.aggregate("h", start, step)["gone"]))
    me = F.exists("_dropped", lambda g: (g["line_no"] == F.col("line_no")) & (g["sub_no"] == F.col("sub_no")))
    joined = marked.withColumn("_gone", F.col("_head") & F.coalesce(me, F.lit(False)))
    # A blank goes if the next line that isn't blank goes.
    following = F.first(F.when(~F.col("_blank"), F.col("_gone")), ignorenulls=True).over(after())
    dropped = F.col("_gone") | (F.col("_blank") & F.coalesce(following, F.lit(False)))
    return joined.withColumn("_drop", dropped).where("not _drop").select(*KEY)


def balance_fences(lines: DataFrame) -> DataFrame:
    """A page with an odd number of fences: its last fence goes if nothing follows on the page, else a
    fence is put after the page's last line of content. The preamble is left alone."""
    mark = F.nullif(F.regexp_extract("line", r"<!-- page (\d+) -->", 1), F.lit(""))
    marked = lines.withColumn("_seg", F.sum(mark.isNotNull().cast("int")).over(so_far()))
    own = (F.col("_seg") > 0) & mark.isNull()
    fence = F.coalesce(own & M.is_fence(F.col("line")), F.lit(False))
    content = own & ~T.blank(F.col("line")) & (T.strip(F.col("line")) != "---")
    whole = by_doc("_seg").rowsBetween(-(2**63), 2**63 - 1)
    at = F.struct("line_no", "sub_no")
    marked = marked.withColumns(
        {
            "_fences": F.sum(fence.cast("int")).over(whole),
            "_last": F.max(F.when(fence, at)).over(whole),
            "_end": F.max(F.when(content, at)).over(whole),
            "_token": F.last(F.when(fence, F.substring(T.lstrip(F.col("line")), 1, 3)), ignorenulls=True).over(whole),
        }
    )
    odd = F.col("_fences") % 2 == 1
    tail = F.col("_end") > F.col("_last")
    kept = marked.where(~F.coalesce(odd & ~tail & (at == F.col("_last")), F.lit(False)))
    closed = F.coalesce(odd & tail & (at == F.col("_end")), F.lit(False))
    return with_inserts(kept, after_=F.when(closed, F.col("_token")))


def normalise_bullets(lines: DataFrame) -> DataFrame:
    """Bullets become Markdown items of two levels, wrapped lines join their item, blanks between items
    go and a group of items gets a blank before it."""
    marked = with_fences(lines)
    free = ~F.col("in_fence") & ~M.is_table_line(F.col("line"))
    kind = F.when(free & F.col("line").rlike(r"^\s*•\s+(.*)$"), 1).when(free & F.col("line").rlike(r"^\s*–\s+(.*)$"), 2).otherwise(0)
    body = T.strip(F.regexp_extract("line", r"^\s*[•–]\s+(.*)$", 1))
    marked = marked.withColumn("_kind", kind).withColumn("_blank", free & T.blank(F.col("line"))).withColumn("_wrap", free & (F.col("_kind") == 0) & M.continues_bullet(F.col("line")))
    # An item takes wrapped lines until something else stands; blanks don't end it.
    stop = (F.col("_kind") > 0) | (~F.col("_blank") & ~F.col("_wrap"))
    marked = marked.withColumn("_item", F.sum(stop.cast("int")).over(so_far()))
    owner = F.first("_kind").over(by_doc("_item"))
    marked = marked.withColumn("_in", F.col("_wrap") & (owner > 0) & (F.col("_item") > 0))
    wraps = F.collect_list(F.when(F.col("_in"), T.strip(F.col("line")))).over(by_doc("_item").rowsBetween(*WHOLE))
    marked = marked.withColumn("_wraps", wraps)
    out = marked.where("not _in").withColumn("_more", F.when(F.size("_wraps") > 0, F.array_join("_wraps", " ")))
    text = F.concat(F.when(F.col("_kind") == 1, "- ").otherwise("  - "), body, F.coalesce(F.concat(F.lit(" "), F.col("_more")), F.lit("")))
    out = out.withColumn("line", F.when(F.col("_kind") > 0, text).otherwise(F.col("line")))
    out = out.withColumn("_is", F.coalesce(M.is_bullet(F.col("line")), F.lit(False)))
    out = out.withColumns({"_b1": F.lag("line").over(by_doc()), "_i2": F.lag("_is", 2).over(by_doc()), "_n1": F.lead("_kind").over(by_doc()), "_p1": F.lag("_is").over(by_doc())})
    tight = T.blank(F.col("line")) & (F.col("_n1") > 0) & F.coalesce(F.col("_p1"), F.lit(False))
    lead = (F.col("_kind") > 0) & F.col("_b1").isNotNull() & ~T.blank(F.col("_b1")) & ~F.coalesce(F.col("_p1"), F.lit(False))
    kept = out.withColumn("_lead", F.coalesce(lead, F.lit(False))).where(~F.coalesce(tight, F.lit(False)))
    return with_inserts(kept, before_=F.when(F.col("_lead"), F.lit("")))


def strip_footer_numbers(lines: DataFrame, footers: DataFrame) -> DataFrame:
    """Page numbers of ``footers`` (doc_id, number) go where a page ends and no table is next to them."""
    near = neighbours(with_fences(lines))
    s = T.strip(F.col("line"))
    near = near.withColumn("number", s)
    ends = (F.col("shown_after") == "") | F.col("shown_after").startswith("<!--") | (F.col("shown_after") == "---")
    free = ~F.col("in_fence") & s.rlike("^[0-9ivxlcIVXLC]{1,6}$") & ends & ~F.col("shown_before").startswith("|") & ~F.col("shown_after").startswith("|")
    drop = near.where(free).join(footers.select("doc_id", "number").distinct(), ["doc_id", "number"], "left_semi").select("doc_id", "line_no", "sub_no")
    return lines.join(drop, ["doc_id", "line_no", "sub_no"], "left_anti").select(*KEY)


def flag_html_tables(lines: DataFrame, marker: str = "doc") -> DataFrame:
    """A marker with the page before each raw HTML table line outside fences, unless it stands there."""
    marked = with_fences(lines)
    page = F.nullif(F.regexp_extract("line", r"(?i)<!--\s*page\s+(\d+)", 1), F.lit(""))
    marked = marked.withColumn("_page", F.last(F.when(~F.col("is_fence"), page), ignorenulls=True).over(so_far()))
    text = F.concat(F.lit(f"<!-- {marker}:html-table-violation p"), F.coalesce("_page", F.lit("?")), F.lit(" -->"))
    marked = marked.withColumn("_mark", text).withColumn("_prev", F.lag("line").over(by_doc()))
    hit = ~F.col("in_fence") & F.col("line").rlike(M.HTML_TABLE) & ~F.coalesce(T.strip(F.col("_prev")) == F.col("_mark"), F.lit(False))
    return with_inserts(marked, before_=F.when(hit, F.col("_mark")))


def style_lines(lines: DataFrame) -> DataFrame:
    """Heading levels from section numbers, bold captions and notes, section headings; fences and tables stay."""
    near = with_fences(lines).withColumns({"_p": F.lag("line").over(by_doc()), "_n": F.lead("line").over(by_doc())})
    new = F.coalesce(M.relevel(F.col("line")), M.bold_caption(F.col("line")), M.section_heading(F.col("line"), F.col("_p"), F.col("_n")))
    return rewrite(near, F.when(~F.col("in_fence") & ~M.is_table_line(F.col("line")), new)).select(*KEY)


def dedup_captions(lines: DataFrame) -> DataFrame:
    """Of a page's captions of one figure keep the best (bold, then in title case, then first); then, if
    all else on the page are labels from its captions, drop them."""
    paged = with_pages(lines).withColumn("page", F.coalesce("page", F.lit(-1)))
    st = T.strip(F.col("line"))
    number = F.nullif(F.regexp_extract(st, M.FIGURE_CAPTION, 1), F.lit(""))
    paged = paged.withColumn("_num", number).withColumn("_score", F.when(number.isNotNull(), M.caption_score(F.col("line"))))
    best = F.max(F.struct("_score", (-F.col("line_no")).alias("l"), (-F.col("sub_no")).alias("s"))).over(by_doc("page", "_num").rowsBetween(-(2**63), 2**63 - 1))
    kept = paged.withColumn("_best", best).where(F.col("_num").isNull() | ((F.col("_best.l") == -F.col("line_no")) & (F.col("_best.s") == -F.col("sub_no"))))
    whole = by_doc("page").rowsBetween(-(2**63), 2**63 - 1)
    body = M.caption_body(F.col("line"))
    pieces = F.concat(F.array(T.label_key(body)), F.filter(F.transform(F.split(body, "[,;]"), T.label_key), lambda p: p != ""))
    kept = kept.withColumn("_pieces", F.flatten(F.collect_set(F.when(F.col("_num").isNotNull(), pieces)).over(whole)))
    other = F.col("_num").isNull() & (st != "") & ~M.is_structural(st)
    kept = kept.withColumn("_other", other).withColumn("_label", F.array_contains("_pieces", T.label_key(F.col("line"))))
    all_labels = F.bool_and(F.when(F.col("_other"), F.col("_label"))).over(whole)
    return kept.withColumn("_all", F.coalesce(all_labels, F.lit(False))).where("not (_all and _other)").select(*KEY)


def promote_bold(lines: DataFrame, labels: DataFrame) -> DataFrame:
    """Lines alone between boundaries whose label is in ``labels`` (doc_id, label) become headings."""
    near = with_fences(lines).withColumns({"_p": T.strip(F.coalesce(F.lag("line").over(by_doc()), F.lit(""))), "_n": T.strip(F.coalesce(F.lead("line").over(by_doc()), F.lit("")))})
    s = T.strip(F.col("line"))
    edge = lambda c: F.col(c).isin("", "---") | F.col(c).startswith("<!--")
    plain = (s != "") & ~s.rlike(r"^(#|\||!\[|\*\*|>|<!--)") & (s != "---") & ~s.rlike(r"^([-*+]\s|\d+\.\s)") & ~s.rlike(r"(?i)^\s*(#{1,6}\s*)?\**\s*(Table|Figure)\s+(\d+)\s*[:.]")
    near = near.withColumn("label", T.label_key(F.col("line"))).withColumn("_can", ~F.col("in_fence") & plain & edge("_p") & edge("_n"))
    known = labels.select("doc_id", "label").distinct().withColumn("_known", F.lit(True))
    out = near.join(known, ["doc_id", "label"], "left")
    return rewrite(out, F.when(F.col("_can") & F.col("_known"), F.concat(T.indent(F.col("line")), F.lit("### "), s))).select(*KEY)


def drop_runaway(lines: DataFrame) -> DataFrame:
    """Truncation markers and runaway lines go; null lines stay."""
    return lines.where(~F.coalesce(M.is_truncation(F.col("line")), F.lit(False))).select(*KEY)


def drop_phrases(lines: DataFrame, labels: Sequence[str] = (), phrases: Sequence[str] = (), signatures: Sequence[str] = ()) -> DataFrame:
    """Leaked instructions: blocks (between blank lines) with a signature go, fenced or not; outside
    fences and tables, lines that are a label or contain a phrase go."""
    marked = with_fences(lines).withColumn("_block", F.sum(T.blank(F.col("line")).cast("int")).over(so_far()))
    has = lambda c, words: F.exists(F.array(*[F.lit(w) for w in words]), lambda w: F.contains(c, w)) if words else F.lit(False)
    whole = by_doc("_block").rowsBetween(-(2**63), 2**63 - 1)
    marked = marked.withColumn("_bad", F.bool_or(F.coalesce(has(F.col("line"), signatures), F.lit(False))).over(whole) & ~T.blank(F.col("line")))
    s = T.strip(F.col("line"))
    free = ~F.col("in_fence") & ~M.is_table_line(F.col("line"))
    bad_line = free & ((s.isin(*labels) if labels else F.lit(False)) | has(F.lower(s), phrases))
    return marked.where(~F.col("_bad") & ~F.coalesce(bad_line, F.lit(False))).select(*KEY)


def drop_label_leaks(blocks: DataFrame, reach: int = 4) -> DataFrame:
    """Of blocks (doc_id, block_no, text): short ones of four words or more that a caption within
    ``reach`` blocks contains. An interval self join, equal on doc_id."""
    caption = r"(?i)^\s*(?:#{1,6}\s*)?\**\s*(?:figure|table)\s+[\w.]+\s*[:.]\s*(.+)$"
    captions = blocks.where(F.col("text").rlike(caption)).select("doc_id", F.col("block_no").alias("_at"), T.figure_key(F.regexp_extract("text", caption, 1)).alias("_cap"))
    own = blocks.where(~F.col("text").rlike(caption) & (F.length(T.strip(F.col("text"))) <= 120)).withColumn("_key", T.figure_key(F.col("text")))
    own = own.where(F.size(F.split("_key", " ")) >= 4)
    near = (F.abs(F.col("block_no") - F.col("_at")) <= reach) & F.contains(F.col("_cap"), F.col("_key"))
    leaks = own.join(captions, "doc_id").where(near).select("doc_id", "block_no").distinct()
    return blocks.join(leaks, ["doc_id", "block_no"], "left_anti")


def merge_straddles(lines: DataFrame) -> DataFrame:
    """A lower-case paragraph line that follows a table's unfinished last cell (markers and blanks in
    between) is put into that cell."""
    near = with_fences(lines).withColumn("_skip", M.is_skip(F.col("line")))
    shown = F.when(~F.col("_skip"), F.struct("line_no", "sub_no", "line"))
    near = near.withColumn("_prev", F.last(shown, ignorenulls=True).over(before()))
    s = T.strip(F.col("line"))
    last = T.strip(F.element_at(F.split(F.regexp_replace(T.strip(F.col("_prev.line")), r"\|$", ""), r"\|"), -1))
    open_ = M.is_table_line(F.col("_prev.line")) & ~M.is_separator(F.col("_prev.line")) & (last != "") & ~last.rlike("[.?!:]$")
    takes = ~F.col("in_fence") & ~F.col("_skip") & s.rlike(r"(?U)^\p{Ll}") & open_
    near = near.withColumn("_takes", F.coalesce(takes, F.lit(False)))
    # What a line takes in is the next line that counts: a line taken in is no table line and takes none.
    following = F.first(F.when(~F.col("_skip"), F.struct(F.col("_takes").alias("t"), s.alias("s"))), ignorenulls=True).over(after())
    near = near.withColumn("_next", following)
    put = F.concat(F.regexp_replace(T.rstrip(F.col("line")), r"\s*\|$", ""), F.lit(" "), F.col("_next.s"), F.lit(" |"))
    return rewrite(near, F.when(~F.col("_skip") & F.col("_next.t"), put)).where("not _takes").select(*KEY)


def front_matter(docs: DataFrame) -> DataFrame:
    """docs (doc_id, md, src) with ``source: src`` first in the front matter, which is made if a text
    has none that is closed; a byte-order mark goes."""
    md = F.regexp_replace("md", "^﻿", "")
    lines = F.split(md, "\n", -1)
    rest = F.slice(lines, F.lit(2), F.greatest(F.size(lines) - 1, F.lit(0)))
    close = F.array_position(F.transform(rest, lambda x: F.regexp_replace(x, r"\r$", "")), "---")
    has = (F.regexp_replace(lines[0], r"\r$", "") == "---") & (close > 0)
    own = F.filter(F.slice(rest, F.lit(1), F.greatest(close - 1, F.lit(0)).cast("int")), lambda x: ~F.startswith(x, F.lit("source:")))
    tail = F.slice(rest, (close + 1).cast("int"), F.greatest(F.size(rest) - close, F.lit(0)).cast("int"))
    line = F.concat(F.lit("source: "), F.col("src"))
    full = F.array_join(F.concat(F.array(F.lit("---"), line), own, F.array(F.lit("---")), tail), "\n")
    return docs.withColumn("md", F.when(has, full).otherwise(F.concat(F.lit("---\n"), line, F.lit("\n---\n"), md)))


def bullet_glyph_merge(lines: DataFrame, gap: float = 40.0, band: float = 3.0) -> DataFrame:
    """Vector lines (doc_id, page, x0, y0, x1, y1, text): a lone bullet glyph joins the line to its right."""
    from pyspark.sql import Window

    w = Window.partitionBy("doc_id", "page").orderBy(F.round("y0", 1), "x0")
    out = lines.withColumn("_glyph", M.bullet_glyph(F.col("text"))).withColumns({c: F.lead(o).over(w) for c, o in (("_nx", "x0"), ("_ny", "y0"), ("_nx1", "x1"), ("_ny1", "y1"), ("_nt", "text"))})
    fits = F.col("_glyph").isNotNull() & (F.abs(F.col("_ny") - F.col("y0")) <= band) & (F.col("_nx") - F.col("x1")).between(0, gap)
    out = out.withColumn("_fits", F.coalesce(fits, F.lit(False))).withColumn("_taken", F.coalesce(F.lag("_fits").over(w), F.lit(False)))
    joined = {"text": F.concat("_glyph", F.lit(" "), F.col("_nt")), "x1": F.col("_nx1"), "y1": F.greatest("y1", "_ny1")}
    out = out.where("not _taken").withColumns({c: F.when(F.col("_fits"), v).otherwise(F.col(c)) for c, v in joined.items()})
    return out.select(*lines.columns)
