"""More registered queries: operators and expressions that the queries of ``queries`` do not reach.

Inputs are derived from whole tables by expressions that both engines share; rows are returned, not
counts of them."""

from __future__ import annotations

from pyspark.sql import functions as F

from .functions import circuits as C
from .functions import markdown as M
from .functions import tables as GT
from .functions import text as T
from .operators import grouped, ledger, matching, planning, scans
from .queries import LINES, STRIP, doc_lines, query, read

ROW = "'|' || replace(line, ', ', '|') || '|'"


def stripped(expression: str) -> str:
    return STRIP.format(expression)


@query(rf"""WITH {LINES}, r AS (SELECT doc_id, line_no, line, {ROW} AS row FROM lines),
    c AS (SELECT *, list_transform(string_split(row, '|')[2:-2], lambda x: {stripped('x')}) AS cells, list_transform(string_split(regexp_replace({stripped('row')}, '^\|+|\|+$', '', 'g'), '|'), lambda x: {stripped('x')}) AS bare FROM r)
    SELECT doc_id, line_no, array_to_string(cells, '~') AS cells, array_to_string(bare, '~') AS bare,
      array_to_string(list_transform(cells, lambda x: lower(regexp_replace(regexp_replace({stripped('x')}, '^\*+|\*+$', '', 'g'), '\s+', ' ', 'g'))), '|') AS header,
      replace(trim(regexp_replace(line, '\s+', ' ', 'g')), '|', '\|') AS cell,
      {stripped("replace(replace(line || '|' || chr(92), chr(92), chr(92) || chr(92)), '|', chr(92) || '|')")} AS escaped,
      {stripped("translate('[' || line || ']', '[]', '()')")} AS alt,
      {stripped(r"regexp_replace(line || ' (Continued) ', '\s*\(continued\)\s*$', '', 'i')")} AS title FROM c""")
def cell_forms(spark, sf_dir):
    line = F.col("line")
    rows = doc_lines(spark, sf_dir).withColumn("row", F.concat(F.lit("|"), F.replace(line, F.lit(", "), F.lit("|")), F.lit("|")))
    cells = GT.parse_row(F.col("row"))
    return rows.select(
        "doc_id",
        "line_no",
        F.array_join(cells, "~").alias("cells"),
        F.array_join(GT.bare_cells(F.col("row")), "~").alias("bare"),
        GT.header_key(cells).alias("header"),
        M.table_cell(line).alias("cell"),
        M.escape_cell(F.concat(line, F.lit("|\\"))).alias("escaped"),
        M.image_alt(F.concat(F.lit("["), line, F.lit("]"))).alias("alt"),
        M.without_continued(F.concat(line, F.lit(" (Continued) "))).alias("title"),
    )


MIXED = "CASE line_no % 6 WHEN 0 THEN '- ' || line WHEN 1 THEN '| ' || line || ' | x |' WHEN 2 THEN '2.' || line_no || ' ' || line WHEN 3 THEN '```' || repeat('`', line_no % 4) || line WHEN 4 THEN repeat('ab', line_no % 30) ELSE line || '<!-- MISSING -->' END"


@query(rf"""WITH {LINES}, m AS (SELECT doc_id, line_no, {MIXED} AS line FROM lines), s AS (SELECT *, {stripped('line')} AS s FROM m)
    SELECT doc_id, line_no, regexp_matches(s, '^[-*+]\s+') OR (starts_with(s, '|') AND contains(substr(s, 2), '|') AND NOT regexp_matches(s, '^\|[\s:\-|]+\|?$')) AS item,
      regexp_matches(s, '^\d+(?:\.\d+)*\s+') AS numbered, regexp_matches(line, '[\x{{4e00}}-\x{{9fff}}]') AND NOT regexp_matches(line, '[\x{{ac00}}-\x{{d7a3}}]') AS foreign_text,
      contains(line, '<!-- MISSING') OR contains(line, '<!-- TRUNCATED') AS incomplete,
      length(s) < 20 OR (length(regexp_replace(s, '\s+', '', 'g')) >= 15 AND len(list_distinct(regexp_extract_all(regexp_replace(s, '\s+', '', 'g'), '.'))) <= 4) AS thin,
      coalesce(list_max(list_transform(regexp_extract_all(line, '`{{3,}}'), lambda x: length(x))), 0)::INTEGER AS backticks FROM s""")
def line_classes(spark, sf_dir):
    line = F.col("line")
    mixed = doc_lines(spark, sf_dir).withColumn("line", F.expr(MIXED))
    return mixed.select(
        "doc_id",
        "line_no",
        M.is_item(line).alias("item"),
        M.has_section_number(line).alias("numbered"),
        M.needs_translation(line).alias("foreign_text"),
        M.is_incomplete(line).alias("incomplete"),
        M.is_thin(line).alias("thin"),
        M.longest_backticks(line).cast("int").alias("backticks"),
    )


ITEMS = "CASE WHEN line_no % 2 = 0 THEN '-  R' || (line_no % 6) || ':  ' || (CASE WHEN line_no % 4 = 0 THEN 'x | ok' ELSE 'X|OK' END) ELSE '~ ' || line END"


@query(rf"""WITH {LINES}, m AS (SELECT doc_id, line_no, {ITEMS} AS line FROM lines),
    k AS (SELECT *, CASE WHEN line_no % 2 = 0 THEN regexp_replace(regexp_replace(lower(line), '\s+', ' ', 'g'), '\s*\|\s*', '|', 'g') END AS key FROM m)
    SELECT doc_id, line_no, line FROM k QUALIFY key IS NULL OR row_number() OVER (PARTITION BY doc_id, key ORDER BY line_no) = 1""")
def item_lines(spark, sf_dir):
    """Item lines with a designator are kept once; all others stay."""
    mixed = doc_lines(spark, sf_dir).withColumn("line", F.expr(ITEMS))
    return scans.dedup_items(mixed).select("doc_id", "line_no", "line")


MODEL = "source || '-' || (doc_id % 90) || '.5b-' || (doc_id % 7) || 'B'"


@query(rf"""WITH m AS (SELECT doc_id, {MODEL} AS name FROM documents), s AS (SELECT *, list_max(list_transform(regexp_extract_all(lower(name), '(\d+(?:\.\d+)?)b', 1), lambda x: x::DOUBLE)) AS size FROM m)
    SELECT doc_id, name, size, NOT coalesce(size >= 30, FALSE) AS small FROM s""")
def model_sizes(spark, sf_dir):
    named = read(spark, sf_dir, "documents").select("doc_id", F.expr(MODEL).alias("name"))
    return named.select("doc_id", "name", M.model_size(F.col("name")).alias("size"), M.is_small_model(F.array("name", F.lit("tiny"))).alias("small"))


@query("""WITH r AS (SELECT doc_id % 997 AS doc_id, (doc_id // 997)::INTEGER AS run, n_chars % 4 AS designators, n_chars AS chars FROM documents)
    SELECT doc_id, run FROM r QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY designators DESC, chars DESC, run) = 1""")
def base_runs(spark, sf_dir):
    runs = read(spark, sf_dir, "documents").select((F.col("doc_id") % 997).alias("doc_id"), F.expr("cast(doc_id div 997 as int)").alias("run"), (F.col("n_chars") % 4).alias("designators"), F.col("n_chars").alias("chars"))
    return scans.base_run(runs).select("doc_id", "run")


FINAL = f"CASE doc_id % 6 WHEN 0 THEN '{C.UNREADABLE}' WHEN 1 THEN '{C.UNVERIFIED}' WHEN 2 THEN '{C.CONFIRMED}' WHEN 3 THEN '{C.ABSENT}' ELSE lang END"


@query(f"""WITH f AS (SELECT source, coalesce({FINAL}, 'none') AS final FROM documents)
    SELECT source, count(*) FILTER (final NOT IN ('{C.UNREADABLE}', '{C.UNVERIFIED}', '{C.CONFIRMED}', '{C.ABSENT}')) AS agreed, count(*) FILTER (final = '{C.CONFIRMED}') AS confirmed,
      count(*) FILTER (final = '{C.UNVERIFIED}') AS unverified, count(*) FILTER (final = '{C.UNREADABLE}') AS unreadable FROM f GROUP BY ALL""")
def vote_summary(spark, sf_dir):
    final = read(spark, sf_dir, "documents").select("source", F.coalesce(F.expr(FINAL), F.lit("none")).alias("final"))
    return scans.summarise(final, ["source"])


@query(rf"""WITH {LINES}, d AS (SELECT doc_id, line_no // 12 AS page, line_no, CASE WHEN line_no % 5 = 0 THEN '....…' ELSE {stripped('line')} END AS w FROM lines),
    k AS (SELECT *, CASE WHEN regexp_full_match(w, '[.·‧…⋯]+') THEN length(w) + 2 * (length(w) - length(replace(w, '…', ''))) ELSE 0 END AS dots FROM d),
    p AS (SELECT doc_id, page, count(*) FILTER (dots >= 4) AS n, count(*) AS total FROM k GROUP BY ALL)
    SELECT doc_id, page::INTEGER AS page FROM p WHERE n > 0 AND (n >= 8 OR n / total >= 0.2)""")
def leader_pages(spark, sf_dir):
    words = doc_lines(spark, sf_dir).select("doc_id", F.floor(F.col("line_no") / 12).cast("int").alias("page"), F.lit(0).alias("block"), F.col("line_no").alias("line"), F.when(F.col("line_no") % 5 == 0, "....…").otherwise(F.col("line")).alias("word"))
    return scans.toc_pages(words, share=0.2)


@query(rf"""WITH {LINES}, r AS (SELECT doc_id, line_no // 9 AS page, line_no * 20.0 - (line_no % 3) * 4 AS y0, line_no * 20.0 - (line_no % 3) * 4 + 12 AS y1, line, 1 + line_no % 4 AS level FROM lines),
    g AS (SELECT *, CASE WHEN coalesce(y0 - lag(y1) OVER w > 6, TRUE) THEN 1 ELSE 0 END AS fresh FROM r WINDOW w AS (PARTITION BY doc_id, page ORDER BY y0)),
    h AS (SELECT *, sum(fresh) OVER (PARTITION BY doc_id, page ORDER BY y0) AS k FROM g)
    SELECT doc_id, page::INTEGER AS page, trim(regexp_replace(string_agg({stripped('line')}, ' ' ORDER BY y0), '\s+', ' ', 'g')) AS text, min(level)::INTEGER AS level, min(y0)::DOUBLE AS y0 FROM h GROUP BY doc_id, page, k""")
def merged_headings(spark, sf_dir):
    n = F.col("line_no")
    top = n * 20.0 - (n % 3) * 4
    lines = doc_lines(spark, sf_dir).select("doc_id", F.floor(n / 9).cast("int").alias("page"), top.alias("y0"), (top + 12).alias("y1"), F.col("line").alias("text"), (1 + n % 4).cast("int").alias("level"))
    return scans.display_headings(lines).select("doc_id", "page", "text", "level", "y0")


@query("""SELECT doc_id, CASE WHEN n_chars * (doc_id % 5) >= 120 AND length(text) < 0.3 * n_chars * (doc_id % 5) THEN text || lang ELSE text END AS text FROM documents""")
def longer_text(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", (F.col("n_chars") * (F.col("doc_id") % 5)).alias("source_chars"), F.col("text").alias("first"), F.concat("text", "lang").alias("second"))
    return planning.keep_longer(docs).select("doc_id", "text")


OBJECTS = "line_no // 5 AS page, (line_no % 5) / 8.0 AS top, (line_no % 5) / 8.0 + (line_no % 3) * 0.2 AS bottom"
ENDS = f"""{LINES}, o AS (SELECT doc_id, {OBJECTS} FROM lines), p AS (SELECT doc_id, page, max(bottom) AS foot, min(top) AS head FROM o GROUP BY ALL),
    e AS (SELECT doc_id, page, NOT coalesce(foot >= 0.85 AND lead(head) OVER (PARTITION BY doc_id ORDER BY page) <= 0.15, FALSE) AS clean FROM p)"""


def _ends(spark, sf_dir):
    n = F.col("line_no")
    objects = doc_lines(spark, sf_dir).select("doc_id", F.floor(n / 5).cast("int").alias("page"), ((n % 5) / 8.0).alias("top"), ((n % 5) / 8.0 + (n % 3) * 0.2).alias("bottom"))
    return planning.clean_ends(objects, objects.select("doc_id", "page").distinct())


@query(f"WITH {ENDS} SELECT doc_id, page::INTEGER AS page, clean FROM e")
def clean_page_ends(spark, sf_dir):
    return _ends(spark, sf_dir)


@query(f"""WITH {ENDS}, s AS (SELECT doc_id, (page // 3)::INTEGER AS seg, min(page)::INTEGER AS first, max(page)::INTEGER AS last FROM e GROUP BY ALL),
    b AS (SELECT s.doc_id, s.seg, min(e.page) AS at FROM s JOIN e ON e.doc_id = s.doc_id AND e.clean AND e.page >= s.last AND e.page <= s.first + 3 - 1 + 12 GROUP BY ALL)
    SELECT s.doc_id, s.seg, s.first AS "start", coalesce(b.at, s.last)::INTEGER AS "end" FROM s LEFT JOIN b USING (doc_id, seg)""")
def snapped_segments(spark, sf_dir):
    ends = _ends(spark, sf_dir)
    segments = ends.groupBy("doc_id", F.expr("cast(page div 3 as int)").alias("seg")).agg(F.min("page").alias("start"), F.max("page").alias("end"))
    return planning.snap_ends(segments, ends, 3).select("doc_id", "seg", "start", "end")


@query("""SELECT source AS key, doc_id AS idx, CASE WHEN doc_id % 3 > 0 AND doc_id % 5 > 0 THEN text END AS text FROM documents""")
def resumed_chunks(spark, sf_dir):
    """Chunks get the cached text where its hash is right (not every third) and the bounds are the same (not every fifth)."""
    docs = read(spark, sf_dir, "documents")
    chunks = docs.select(F.col("source").alias("key"), F.col("doc_id").alias("idx"), F.lit(0).alias("start"), F.col("n_chars").alias("end"))
    cache = docs.select(
        F.col("source").alias("key"),
        F.col("doc_id").alias("idx"),
        F.lit(0).alias("start"),
        F.when(F.col("doc_id") % 5 == 0, F.col("n_chars") + 1).otherwise(F.col("n_chars")).alias("end"),
        "text",
        F.when(F.col("doc_id") % 3 == 0, "other").otherwise(F.sha2("text", 256)).alias("sha"),
    )
    return ledger.resume(chunks, cache).select("key", "idx", "text")


KIND = "CASE doc_id % 4 WHEN 0 THEN 'oversized_table' WHEN 1 THEN 'oversized_matrix' ELSE 'figure' END"


@query(f"""WITH s AS (SELECT doc_id, doc_id % 10 AS figure_id, {KIND} AS kind, CASE WHEN doc_id % 3 = 0 THEN ' ' ELSE lang END AS description FROM documents),
    u AS (SELECT * FROM s WHERE doc_id % 7 > 0 UNION ALL SELECT doc_id, figure_id, kind, 'new' FROM s WHERE doc_id % 7 = 0)
    SELECT doc_id, figure_id, kind, description, kind IN ('oversized_table', 'oversized_matrix') AND trim(coalesce(description, '')) = '' AS missing FROM u""")
def figure_entries(spark, sf_dir):
    """Entries that replace those of the same figure, and whose description is missing."""
    side = read(spark, sf_dir, "documents").select("doc_id", (F.col("doc_id") % 10).alias("figure_id"), F.expr(KIND).alias("kind"), F.when(F.col("doc_id") % 3 == 0, " ").otherwise(F.col("lang")).alias("description"))
    merged = ledger.upsert_figures(side, side.where("doc_id % 7 = 0").withColumn("description", F.lit("new")))
    missing = ledger.without_description(merged).select("doc_id", F.lit(True).alias("missing"))
    return merged.join(missing, "doc_id", "left").withColumn("missing", F.coalesce("missing", F.lit(False)))


X0 = "CASE WHEN line_no % 24 = 7 AND doc_id % 3 = 0 THEN 150.0 WHEN line_no % 2 = 0 THEN 51.0 ELSE 312.0 END"
X1 = "CASE WHEN line_no % 12 = 0 THEN 550.0 WHEN line_no % 2 = 0 THEN 290.0 ELSE 549.0 END"


@query(rf"""WITH {LINES}, v AS (SELECT doc_id, line_no, (line_no // 24)::INTEGER AS page, {X0} AS x0, {X1} AS x1 FROM lines),
    p AS (SELECT *, min(x0) OVER q AS l, max(x1) OVER q - min(x0) OVER q AS w, count(*) OVER q AS n FROM v WINDOW q AS (PARTITION BY doc_id, page)),
    s AS (SELECT *, CASE WHEN x0 > l + 0.25 * w THEN x0 END AS s FROM p), f AS (SELECT *, CASE WHEN count(s) OVER (PARTITION BY doc_id, page, s) >= 4 AND s - l >= 0.3 * w THEN s END AS fit FROM s),
    t AS (SELECT *, CASE WHEN n >= 6 AND w > 50 THEN min(fit) OVER (PARTITION BY doc_id, page) END AS second FROM f),
    c AS (SELECT *, CASE WHEN second IS NULL THEN NULL WHEN x0 >= second - 4.5 THEN 'R' WHEN x0 > l + 0.1 * w THEN 'O' WHEN x1 <= second - 6 THEN 'L' ELSE 'F' END AS k FROM t)
    SELECT doc_id, line_no, page, CASE WHEN avg(CASE WHEN k = 'O' THEN 1.0 ELSE 0.0 END) OVER (PARTITION BY doc_id, page) <= 0.15 THEN k END AS "column" FROM c""")
def page_columns(spark, sf_dir):
    lines = doc_lines(spark, sf_dir)
    shaped = lines.select("doc_id", "line_no", F.expr("cast(line_no div 24 as int)").alias("page"), F.expr(X0).cast("double").alias("x0"), F.expr(X1).cast("double").alias("x1"), F.col("line_no").cast("double").alias("y0"), F.col("line").alias("text"))
    return grouped.two_columns(shaped).select("doc_id", "line_no", "page", "column")


@query(rf"""WITH {LINES}, v AS (SELECT doc_id, line_no, line_no // 10 AS page, (line_no * 37 % 101)::DOUBLE AS y FROM lines),
    b AS (SELECT k.doc_id, k.page, k.line_no, min(o.line_no) AS at FROM v k JOIN v o ON o.doc_id = k.doc_id AND o.page = k.page AND o.line_no % 2 = 0 AND o.y > k.y WHERE k.line_no % 2 = 1 GROUP BY ALL)
    SELECT k.doc_id, k.page::INTEGER AS page, k.line_no AS block_no, coalesce(b.at, -1)::INTEGER AS body_no FROM v k LEFT JOIN b USING (doc_id, page, line_no) WHERE k.line_no % 2 = 1""")
def placed_blocks(spark, sf_dir):
    n = F.col("line_no")
    lines = doc_lines(spark, sf_dir).select("doc_id", F.floor(n / 10).cast("int").alias("page"), n, (n * 37 % 101).cast("double").alias("y"))
    blocks = lines.where(n % 2 == 1).withColumnRenamed("line_no", "block_no")
    return matching.place_blocks(blocks, lines.where(n % 2 == 0).withColumnRenamed("line_no", "body_no")).select("doc_id", "page", "block_no", F.coalesce("body_no", F.lit(-1)).alias("body_no"))


@query(rf"""WITH {LINES} SELECT doc_id, line_no, lower(regexp_replace(regexp_replace({stripped('line')}, '\s+', ' ', 'g'), '\s*\|\s*', '|', 'g')) AS key,
    CASE WHEN strpos(line, 'a') > 0 THEN substr(line, 1, strpos(line, 'a') - 1) || '<a>' || substr(line, strpos(line, 'a') + 1) ELSE line END AS replaced FROM (SELECT doc_id, line_no, replace(line, '`', '') AS line FROM lines)""")
def line_keys(spark, sf_dir):
    lines = doc_lines(spark, sf_dir).withColumn("line", F.replace("line", F.lit("`"), F.lit("")))
    return lines.select("doc_id", "line_no", T.line_key(F.col("line")).alias("key"), T.replace_first(F.col("line"), F.lit("a"), F.lit("<a>")).alias("replaced"))


OP = "CASE line_no % 6 WHEN 0 THEN 'l' WHEN 1 THEN 'c' WHEN 2 THEN 're' WHEN 3 THEN 'qu' WHEN 4 THEN 'm' END"


@query(rf"""WITH {LINES} SELECT doc_id, (line_no // 24)::INTEGER AS page, (count(*) FILTER (line_no % 6 IN (0, 1)) + 4 * count(*) FILTER (line_no % 6 IN (2, 3)))::BIGINT AS vector_lines FROM lines GROUP BY ALL""")
def vector_counts(spark, sf_dir):
    items = doc_lines(spark, sf_dir).select("doc_id", F.expr("cast(line_no div 24 as int)").alias("page"), F.expr(OP).alias("op"))
    return scans.vector_segments(items)


BODY = """coalesce(text, '') || chr(10) || chr(10) || CASE doc_id % 4 WHEN 0 THEN '<TABLE id=1><tr>' || chr(10) || chr(10) || CASE WHEN doc_id % 8 = 0 THEN '</Table>' ELSE '' END || 'tail'
    WHEN 1 THEN '| hot |' || chr(10) || '| 1 |' || CASE WHEN doc_id % 8 = 1 THEN chr(10) || chr(10) || 'tail' ELSE '' END WHEN 2 THEN 'none' ELSE '| two |' || chr(10) || '| two |' END"""
MARKER = "CASE doc_id % 4 WHEN 0 THEN '<TABLE id' WHEN 1 THEN '| hot' WHEN 2 THEN '| absent' ELSE '| two' END"
DESCRIPTION = "CASE WHEN doc_id % 3 = 0 THEN ' ' ELSE ' seen ' || doc_id || ' ' END"


@query(rf"""WITH b AS (SELECT doc_id, {BODY} AS body, {MARKER} AS marker FROM documents), s AS (SELECT *, len(string_split(body, marker)) = 2 AS replaced, split_part(body, marker, 1) AS head, marker || split_part(body, marker, 2) AS block FROM b),
    e AS (SELECT *, CASE WHEN starts_with(block, '<TABLE') THEN CASE WHEN contains(block, '</Table>') THEN substr(block, strpos(block, '</Table>') + 8) ELSE '' END
      WHEN contains(block, chr(10) || chr(10)) THEN substr(block, strpos(block, chr(10) || chr(10))) ELSE '' END AS rest FROM s), i AS (SELECT *, '![' || 's__p' || lpad((doc_id % 120)::VARCHAR, greatest(2, length((doc_id % 120)::VARCHAR))::INTEGER, '0') || '_table_oversized' || (doc_id % 7) || '](i.png)' AS image FROM e)
    SELECT doc_id, replaced, replaced AND doc_id % 3 <> 0 AS added,
      CASE WHEN replaced THEN head || '{M.TABLE_NOTICE}' || chr(10) || chr(10) || image || CASE WHEN doc_id % 3 <> 0 THEN chr(10) || chr(10) || '{M.DESCRIPTION_LEAD} seen ' || doc_id || chr(10) ELSE '' END || rest ELSE body END AS md FROM i""")
def tables_as_images(spark, sf_dir):
    """Crowded tables become images with a description below; a second description changes nothing."""
    i = F.col("doc_id")
    docs = read(spark, sf_dir, "documents").select("doc_id", F.expr(BODY).alias("body"), F.expr(MARKER).alias("marker"), F.expr(DESCRIPTION).alias("description"))
    figure = M.oversized_figure_id(F.lit("s"), i % 120, i % 7)
    docs = docs.withColumn("_t", M.table_as_image(F.col("body"), F.col("marker"), F.lit("i.png"), figure))
    docs = docs.withColumn("_d", M.with_description(F.col("_t.md"), F.lit("i.png"), F.col("description")))
    twice = M.with_description(F.col("_d.md"), F.lit("i.png"), F.col("description"))
    return docs.select("doc_id", "_t.replaced", "_d.added", twice["md"].alias("md"))


PAGED = "'p<!-- page 1 -->' || coalesce(text, '') || '<!--  page 02-->' || chr(10) || ' tail ' || doc_id || ' <!-- page 2 -->x'"


@query(rf"""SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN substr({stripped("coalesce(text, '')")}, 1, 6000) WHEN 1 THEN 'tail ' || doc_id ELSE '' END AS excerpt FROM documents""")
def page_excerpts(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", F.expr(PAGED).alias("md"))
    return docs.select("doc_id", M.page_excerpt(F.col("md"), F.col("doc_id") % 3 + 1).alias("excerpt"))


SLIDE = "CASE line_no % 4 WHEN 0 THEN '<!-- Slide number: ' || line_no || ' -->' || line WHEN 1 THEN line || '> **[이미지 ' || line_no || ']** >  **[이미지]**' WHEN 2 THEN 'Slide number: x' || line ELSE line END"


@query(rf"""WITH {LINES} SELECT doc_id, line_no, CASE WHEN line_no % 4 = 0 AND line IS NOT NULL THEN line_no END AS slide,
    CASE WHEN line IS NULL THEN NULL WHEN line_no % 4 = 1 THEN '> **[이미지 ' || line_no || ']**~>  **[이미지]**' ELSE '' END AS blocks FROM lines""")
def slide_marks(spark, sf_dir):
    line = F.expr(SLIDE)
    return doc_lines(spark, sf_dir).where("line is not null").select("doc_id", "line_no", M.slide_number(line).alias("slide"), F.array_join(M.image_blocks(line), "~").alias("blocks"))


SHOWN = "line_no AS xref, 0.0 AS x0, 0.0 AS y0, CAST(100 * (line_no % 7 - 1) AS DOUBLE) AS x1, CAST(10 * (doc_id % 9) AS DOUBLE) AS y1"


@query(rf"""WITH {LINES}, i AS (SELECT doc_id, (line_no // 24)::INTEGER AS page, {SHOWN} FROM lines)
    SELECT doc_id, page, xref FROM i WHERE xref % 5 <> 0 AND greatest(x1 - x0, 0) * greatest(y1 - y0, 0) / (600.0 * 800.0) >= 0.03""")
def raster_rects(spark, sf_dir):
    images = doc_lines(spark, sf_dir).selectExpr("doc_id", "cast(line_no div 24 as int) AS page", *SHOWN.split(", "), "600.0D AS pw", "800.0D AS ph")
    return scans.raster_rects(images, images.where("xref % 5 = 0").select("doc_id", "xref")).select("doc_id", "page", "xref")
