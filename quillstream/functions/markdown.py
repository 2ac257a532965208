"""Predicates and rewrites of single Markdown lines, as expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import collapse, indent, lstrip, strip

FENCE = r"^\s*(```|~~~)"
PAGE_MARK = r"^<!-- page (\d+) -->\s*$"
HEADING = r"^(#{1,6})\s+(\S.*)$"
SEPARATOR = r"^\s*\|(?:\s*:?-{2,}:?\s*\|)+\s*$"
NUMERIC = r"^[+\-±~]?\$?\d[\d,]*\.?\d*(?:[eE][+\-]?\d+)?\s*%?$"
TOC_ENTRY = r"^([ \t]*)(\S.*?)\s*(?:\.[ \t]*){3,}(\d+)\s*$"
FIGURE_CAPTION = r"(?i)^\*{0,2}\s*figure\s+(\d+)\s*:"
TABLE_CAPTION = r"(?i)^\s*\*{0,2}\s*table\s+(\d+)\s*[:.]\s*(.*)$"
HTML_TABLE = r"(?i)<table\b|class=\"table"
TRUNCATED = r"(?is)^\s*<!--\s*TRUNCATED\b.*?-->\s*$"
ELLIPSES = r"(?:\.\.\.\s*){2,}|(?:…\s*){2,}"

# Titles of lists of contents, bullet glyphs, and phrases of a model that refuses to translate.
TOC_TITLES = ("table of contents", "list of tables", "list of figures", "contents")
CLEAR_BULLETS = "•●▪‣◦∙◾◼"
OTHER_BULLETS = "-–·"
REFUSALS = (
    "please provide the markdown", "please provide the text", "please provide the content", "it appears that no content",
    "no content was included", "there is no content", "there is no text to translate", "i need the text", "i need the content",
    "i need the markdown", "you would like me to translate", "you haven't provided", "it seems you haven't", "no text was provided",
    "provide the content you would like",
)


def is_fence(c: Column) -> Column:
    return c.rlike(FENCE)


def page_number(c: Column) -> Column:
    return F.nullif(F.regexp_extract(c, PAGE_MARK, 1), F.lit("")).cast("int")


def is_rule(s: Column) -> Column:
    return s.rlike(r"^(-{3,}|\*{3,}|_{3,})$")


def is_comment(s: Column) -> Column:
    return s.startswith("<!--") & s.endswith("-->")


def is_structural(s: Column) -> Column:
    return is_rule(s) | is_comment(s)


def is_skip(c: Column) -> Column:
    s = strip(c)
    return (s == "") | is_structural(s)


def is_separator(c: Column) -> Column:
    cells = F.filter(F.transform(F.split(c, r"\|"), strip), lambda x: x != "")
    return (F.size(cells) > 0) & F.forall(cells, lambda x: x.rlike("^:?-{2,}:?$"))


def is_table_line(c: Column) -> Column:
    return F.startswith(lstrip(c), F.lit("|"))


def is_numeric(c: Column) -> Column:
    s = strip(c)
    return (s != "") & s.rlike(NUMERIC)


def is_bullet(c: Column) -> Column:
    return c.rlike(r"^\s*-\s+")


def continues_bullet(c: Column) -> Column:
    st = strip(c)
    first = F.substring(st, 1, 1)
    lower = (F.lower(first) == first) & (F.upper(first) != first)
    other = st.startswith("#") | st.startswith("|") | st.startswith("![") | st.rlike("^[•–]") | is_bullet(st)
    code = ~st.contains(" ") & (st.contains("_") | (F.length(st) >= 18)) & st.rlike(r"(?U)^[\w.,/+\-]+$")
    return (st != "") & ~other & (lower | st.startswith(",") | code)


def bullet_glyph(c: Column) -> Column:
    """The canonical bullet of a line that is one glyph alone, else null."""
    s = strip(c)
    clear = F.lit(CLEAR_BULLETS + "·").contains(s)
    return F.when(F.length(s) == 1, F.when(clear, "•").when(F.lit(OTHER_BULLETS).contains(s), "–"))


def ambiguous_bullet(c: Column) -> Column:
    s = strip(c)
    return (F.length(s) == 1) & F.lit(OTHER_BULLETS).contains(s)


def is_toc_entry(c: Column) -> Column:
    return c.rlike(TOC_ENTRY)


def toc_level(lead: Column, title: Column) -> Column:
    number = F.regexp_extract(title, r"^(\d+(?:\.\d+)+)", 1)
    dots = F.length(number) - F.length(F.replace(number, F.lit("."), F.lit("")))
    spaces = F.length(F.replace(lead, F.lit("\t"), F.lit("    ")))
    return F.least(F.greatest(dots, F.floor(spaces / 2).cast("int")), F.lit(6))


def has_section_number(title: Column) -> Column:
    return strip(title).rlike(r"^\d+(?:\.\d+)*\s+")


def is_refusal(c: Column) -> Column:
    s = F.lower(strip(F.coalesce(c, F.lit(""))))
    return (s != "") & (F.length(s) <= 400) & F.exists(F.array(*[F.lit(p) for p in REFUSALS]), lambda p: F.contains(s, p))


def needs_translation(c: Column) -> Column:
    """Han without Hangul."""
    return c.rlike("[\u4e00-\u9fff]") & ~c.rlike("[\uac00-\ud7a3]")


def model_size(name: Column) -> Column:
    """Billions of parameters that a model's name states, the most if several."""
    found = F.regexp_extract_all(F.lower(name), F.lit(r"(\d+(?:\.\d+)?)b"), F.lit(1))
    return F.array_max(F.transform(found, lambda x: x.cast("double")))


def is_small_model(models: Column, least: float = 30.0) -> Column:
    """No model of the list states ``least`` billions of parameters or more."""
    return (F.size(models) > 0) & ~F.exists(models, lambda m: F.coalesce(model_size(m) >= least, F.lit(False)))


def caption_score(c: Column) -> Column:
    st = strip(c)
    word = F.regexp_extract(st, r"^\*{0,2}\s*([Ff][Ii][Gg][Uu][Rr][Ee])\b", 1)
    return F.when(st.startswith("**"), 2).otherwise(0) + F.when(word == "Figure", 1).otherwise(0)


def caption_body(c: Column) -> Column:
    return strip(F.regexp_replace(F.regexp_replace(strip(c), r"(?i)^\*{0,2}\s*figure\s+\d+\s*:\s*", ""), r"\*+$", ""))


def caption_number(c: Column) -> Column:
    return F.nullif(F.regexp_extract(F.coalesce(c, F.lit("")), r"(?i)\b(?:figure|fig\.?|table)\s+(\d+)\b", 1), F.lit(""))


def figure_label(c: Column) -> Column:
    number = F.regexp_extract(c, r"(?i)(?:\bfig(?:ure)?\.?\s*|그림\s*)([A-Za-z]?-?\d+(?:[.-]\d+)*)", 1)
    return F.when(number != "", F.concat(F.lit("Figure "), number))


CAPTION_WORD = r"^(?i:(Table|Figure))\s+(\d+):"


def canonical_caption(st: Column) -> Column:
    word = F.regexp_extract(st, CAPTION_WORD, 1)
    return F.when(st.rlike(CAPTION_WORD), F.concat(F.initcap(word), F.substr(st, F.length(word) + 1))).otherwise(st)


def bold_caption(c: Column) -> Column:
    """The line with a bold caption or note, or null where the rule leaves it alone."""
    st = strip(c)
    inner = strip(F.regexp_replace(F.regexp_replace(st, r"^\*\*", ""), r"\*\*$", ""))
    lower = inner.rlike(CAPTION_WORD) & ~F.regexp_extract(inner, CAPTION_WORD, 1).isin("Figure", "Table")
    return (
        F.when(st == "", F.lit(None).cast("string"))
        .when(st.startswith("**"), F.when(lower & st.endswith("**"), F.concat(indent(c), F.lit("**"), canonical_caption(inner), F.lit("**"))))
        .when(st.rlike(CAPTION_WORD), F.concat(indent(c), F.lit("**"), canonical_caption(st), F.lit("**")))
        .when(st.rlike(r"^(?i:Note:)\s"), F.concat(indent(c), F.lit("**Note:** "), lstrip(F.substr(st, F.lit(6)))))
    )


NUMBERED_HEADING = r"^(#{1,6})\s+(\d+(?:\.\d+)+)\.?\s+(\S.*)$"


def relevel(c: Column) -> Column:
    number = F.regexp_extract(c, NUMBERED_HEADING, 2)
    level = F.least(F.size(F.split(number, r"\.")), F.lit(4))
    return F.when(c.rlike(NUMBERED_HEADING), F.concat(F.repeat(F.lit("#"), level), F.lit(" "), number, F.lit(" "), strip(F.regexp_extract(c, NUMBERED_HEADING, 3))))


def section_heading(c: Column, before: Column, after: Column) -> Column:
    """A numbered line alone between blanks as a heading, or null. ``before`` and ``after`` are its
    neighbours, null at the document's ends."""
    st = strip(c)
    alone = F.coalesce(strip(before) == "", F.lit(True)) & F.coalesce(strip(after) == "", F.lit(True))
    plain = (st != "") & ~st.rlike(r"^(#|\||\*\*)") & (F.length(st) <= 90) & ~st.rlike(r"[.!?,;:]$")
    number, title = F.regexp_extract(st, r"^(\d+(?:\.\d+)+)\s+(\S.*)$", 1), F.regexp_extract(st, r"^(\d+(?:\.\d+)+)\s+(\S.*)$", 2)
    parts = F.split(number, r"\.")
    first = F.substring(title, 1, 1)
    lower = (F.lower(first) == first) & (F.upper(first) != first)
    valid = (number != "") & (F.size(parts) <= 4) & ~F.exists(parts, lambda p: p.startswith("0")) & ~lower
    return F.when(alone & plain & valid, F.concat(F.when(F.size(parts) >= 3, "### ").otherwise("## "), number, F.lit(" "), title))


def without_continued(title: Column) -> Column:
    return strip(F.regexp_replace(title, r"(?i)\s*\(continued\)\s*$", ""))


def image_alt(c: Column) -> Column:
    return strip(F.translate(F.coalesce(c, F.lit("")), "[]\n\r", "()  "))


def table_cell(c: Column) -> Column:
    return F.replace(collapse(c), F.lit("|"), F.lit("\\|"))


def escape_cell(c: Column) -> Column:
    s = F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit("|"), F.lit("\\|"))
    return strip(F.replace(s, F.lit("\n"), F.lit("<br>")))


def with_page_marker(md: Column, page: Column) -> Column:
    body = F.regexp_replace(md, r"^\n+", "")
    body = F.regexp_replace(body, r"(?i)^<!--\s*page\s+\d+\s*-->[ \t]*\n*", "")
    return F.concat(F.format_string("<!-- page %d -->\n\n", page), body)


def missing_marker(first: Column, last: Column) -> Column:
    return F.format_string("<!-- MISSING pages %d-%d: extraction failed -->", first, last)


def is_incomplete(md: Column) -> Column:
    return md.contains("<!-- MISSING") | md.contains("<!-- TRUNCATED")


def repeats_in_row(parts: Column, least: int = 20, most_chars: int = 12, code_like: bool = False) -> Column:
    """Whether ``least`` equal parts of at most ``most_chars`` characters follow one another; a blank
    part ends a run, and code-like texts pass over words of letters."""
    start = F.struct(F.lit(None).cast("string").alias("prev"), F.lit(0).alias("run"), F.lit(False).alias("hit"))

    def step(acc: Column, raw: Column) -> Column:
        p = strip(raw)
        run = F.when(p == "", 0).when(p == acc["prev"], acc["run"] + 1).otherwise(1)
        counts = (p != "") & (F.length(p) <= most_chars) & (run >= least)
        counts = counts & ~p.rlike(r"(?U)^\p{L}+$") if code_like else counts
        return F.struct(F.when(p != "", p).alias("prev"), run.alias("run"), (acc["hit"] | counts).alias("hit"))

    return F.aggregate(parts, start, step)["hit"]


#: A short part or word that stands twenty times in a row: without one no run of parts or words can count.
PART_RUN = r"(?U)(?:^|[|,])\s*+((?=\S)[^|,]{1,12}?)\s*+(?:[|,]\s*+\1\s*+){19}"
WORD_RUN = r"(?U)(?:^|\s)(\S{1,12}+)(?:\s+\1){19}"


def is_runaway(c: Column) -> Column:
    """The folds over parts and words run only on lines that have such a run at all."""
    no = F.lit(False)
    enough = F.length(c) - F.length(F.translate(c, "|,", "")) >= 19
    cells = F.when(enough & c.rlike(PART_RUN), repeats_in_row(F.split(c, "[|,]"))).otherwise(no)
    words = F.when((F.length(c) > 200) & c.rlike(WORD_RUN), repeats_in_row(F.split(c, r"(?U)\s+"), code_like=True)).otherwise(no)
    return ((c.contains("|") & c.rlike(ELLIPSES)) | cells | words) & ~is_separator(c)


def is_truncation(c: Column) -> Column:
    return c.rlike(TRUNCATED) | is_runaway(c)


def is_item(c: Column) -> Column:
    s = strip(c)
    row = s.startswith("|") & F.substr(s, F.lit(2)).contains("|") & ~s.rlike(r"^\|[\s:\-|]+\|?$")
    return row | s.rlike(r"^[-*+]\s+")


def longest_backticks(c: Column) -> Column:
    return F.coalesce(F.array_max(F.transform(F.regexp_extract_all(c, F.lit("(`{3,})"), F.lit(1)), F.length)), F.lit(0))


def code_fence(c: Column) -> Column:
    """Three backticks, or one more than the longest run in the code."""
    return F.repeat(F.lit("`"), F.greatest(F.lit(3), longest_backticks(c) + 1))


def without_outer_fence(c: Column) -> Column:
    """The inside of a text that is one fenced block; other texts as they are."""
    s = strip(c)
    body = F.regexp_extract(s, r"(?s)^```[^\n]*\n(.*)\n?```$", 1)
    return F.when(s.rlike(r"(?s)^```[^\n]*\n.*```$") & (F.size(F.regexp_extract_all(s, F.lit("(?m)^(```)"), F.lit(1))) == 2), F.regexp_replace(body, r"\n$", "")).otherwise(c)


def json_array(c: Column) -> Column:
    return F.nullif(F.regexp_extract(c, r"(?s)(\[.*\])", 1), F.lit(""))



def leader_dots(word: Column) -> Column:
    """Dots that a word of leaders stands for; an ellipsis is three."""
    t = strip(word)
    return F.when(t.rlike("^[.·‧…⋯]+$"), F.length(t) + 2 * (F.length(t) - F.length(F.replace(t, F.lit("…"), F.lit(""))))).otherwise(0)


def is_thin(c: Column) -> Column:
    """Fewer than 20 characters, or 15 or more of at most four kinds (white space aside)."""
    s = strip(F.coalesce(c, F.lit("")))
    letters = F.filter(F.split(F.regexp_replace(s, r"(?U)\s+", ""), ""), lambda x: x != "")
    return (F.length(s) < 20) | ((F.size(letters) >= 15) & (F.size(F.array_distinct(letters)) <= 4))


def is_prose(c: Column) -> Column:
    """Two significant tokens or more, or not one short word."""
    from .text import tokens

    s = strip(F.coalesce(c, F.lit("")))
    return (F.size(tokens(s)) >= 2) | s.contains(" ") | (F.length(s) > 3)


def short_or_numeric(word: Column) -> Column:
    t = strip(word)
    return (t != "") & ((F.length(t) <= 6) | t.rlike(r"^[-+]?[\d.,<>=≤≥%/()µ]+$"))


# The notice in place of a table shown as an image, what leads a description of a table, marks of image blocks.
TABLE_NOTICE = "⚠️ 초고밀도 표라 markdown 전사 시 왜곡·환각 발생, 원본 이미지 크롭으로 대체"
DESCRIPTION_LEAD = "> **표 설명 (AI 정밀분석)**:"
IMAGE_BLOCK = r"(?U)>\s*\*\*\[이미지[^\]]*\]\*\*"
PAGE_MARK = r"(?U)<!--\s*page\s+(\d+)\s*-->"


def oversized_figure_id(stem: Column, page: Column, number: Column) -> Column:
    return F.format_string("%s__p%02d_table_oversized%d", stem, page, number)


def slide_number(line: Column) -> Column:
    """The number of a slide marker, null without one."""
    return F.regexp_extract(line, r"(?U)Slide number:\s*(\d+)", 1).try_cast("int")


def image_blocks(section: Column) -> Column:
    """The marks of the image blocks that a section has."""
    return F.regexp_extract_all(section, F.lit(IMAGE_BLOCK), F.lit(0))


def page_excerpt(md: Column, page: Column, most: int = 6000) -> Column:
    """The first ``most`` characters after the first marker of a page, up to the next marker; empty without one."""
    numbers = F.transform(F.regexp_extract_all(md, F.lit(PAGE_MARK), F.lit(1)), lambda x: x.try_cast("long"))
    at = F.array_position(numbers, page.cast("long"))
    part = F.when(at > 0, F.element_at(F.split(md, PAGE_MARK, -1), (at + 1).cast("int"))).otherwise("")
    return F.when(md.isNotNull(), F.substring(strip(part), 1, most))


def block_end(body: Column, start: Column) -> Column:
    """Characters of the body up to the end of the block that begins at ``start`` (from 1): a closed
    HTML table, or all up to an empty line; the whole body where neither end comes."""
    close = F.position(F.lit("</table>"), F.lower(body), start)
    empty = F.position(F.lit("\n\n"), body, start)
    html = F.lower(F.substr(body, start, F.lit(20))).contains("<table")
    return F.when(html & (close > 0), close + 7).when(~html & (empty > 0), empty - 1).otherwise(F.length(body))


def table_as_image(body: Column, marker: Column, path: Column, figure_id: Column, notice: str = TABLE_NOTICE) -> Column:
    """(md, replaced): the block that begins with the marker becomes a notice and an image; where the
    marker is empty or does not stand there exactly once, the body stays."""
    times = (F.length(body) - F.length(F.replace(body, marker, F.lit("")))) / F.length(marker)
    once = F.coalesce((F.length(marker) > 0) & (times == 1), F.lit(False))
    start = F.position(marker, body)
    image = F.concat(F.lit(notice + "\n\n!["), figure_id, F.lit("]("), path, F.lit(")"))
    rest = F.substr(body, block_end(body, start) + 1)
    md = F.concat(F.substr(body, F.lit(1), start - 1), image, rest)
    return F.struct(F.when(once, md).otherwise(body).alias("md"), once.alias("replaced"))


def with_description(body: Column, path: Column, description: Column, reach: int = 400) -> Column:
    """(md, added): a description below the first link to an image, unless it is blank, the link is
    not there or a description follows within ``reach`` characters."""
    link = F.concat(F.lit("]("), path, F.lit(")"))
    at = F.position(link, body)
    end = at + F.length(link)
    told = F.substr(body, end, F.lit(reach)).contains(DESCRIPTION_LEAD)
    add = F.coalesce((strip(description) != "") & (at > 0) & ~told, F.lit(False))
    block = F.concat(F.lit("\n\n" + DESCRIPTION_LEAD + " "), strip(description), F.lit("\n"))
    md = F.concat(F.substr(body, F.lit(1), end - 1), block, F.substr(body, end))
    return F.struct(F.when(add, md).otherwise(body).alias("md"), add.alias("added"))
