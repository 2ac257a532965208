import random

from pyspark.sql import functions as F

from quillstream.functions import geometry as G
from quillstream.functions import markdown as M
from quillstream.operators import grouped, matching, planning, scans
from quillstream.operators.lines import assemble, explode_lines, with_pages


def test_continued_captions(spark):
    md = "<!-- page 1 -->\n**Table 3: Codes**\n| A | B |\n| --- | --- |\n| 0 | 1 |\n\n<!-- page 2 -->\n\n| A | B |\n| --- | --- |\n| 1 | 0 |\n<!-- page 3 -->\n| C | D |\n| 5 | 6 |"
    df = with_pages(explode_lines(spark.createDataFrame([(1, md)], "doc_id long, md string"))).select("doc_id", "line_no", "sub_no", "line", "page")
    out = assemble(grouped.continue_captions(df)).first()["md"]
    assert out == md.replace("<!-- page 2 -->\n\n| A", "<!-- page 2 -->\n\n**Table 3: Codes (continued)**\n\n| A")


def test_leaders_and_thin_text(spark):
    row = spark.range(1).select(M.leader_dots(F.lit("..…")).alias("d"), M.is_thin(F.lit("ababababab ababababab")).alias("t"), M.is_thin(F.lit("a text that is long enough")).alias("u")).first()
    assert (row["d"], row["t"], row["u"]) == (5, True, False)
    words = spark.createDataFrame([(1, 1, 0, k, "....") for k in range(3)] + [(1, 2, 0, k, "w") for k in range(9)], "doc_id long, page int, block int, line int, word string")
    assert [r["page"] for r in scans.toc_pages(words).collect()] == [1]


def test_boxes_ends_and_figures(spark):
    b = lambda *x: G.box(*[F.lit(float(v)) for v in x])
    one = spark.createDataFrame([(1, 1, 1)], "doc_id long, page int, id int").withColumn("box", b(0, 0, 2, 2))
    grid = one.select("doc_id", "page").withColumn("box", b(1, 1, 5, 5))
    assert tuple(matching.expand_boxes(one, grid).first()["box"]) == (0, 0, 5, 5)
    pages = spark.createDataFrame([(1, 1), (1, 2), (1, 3)], "doc_id long, page int")
    objects = spark.createDataFrame([(1, 1, 0.5, 0.95), (1, 2, 0.05, 0.4)], "doc_id long, page int, top double, bottom double")
    ends = planning.clean_ends(objects, pages)
    assert [r["clean"] for r in ends.orderBy("page").collect()] == [False, True, True]
    segments = spark.createDataFrame([(1, 0, 1, 1)], "doc_id long, seg int, start int, end int")
    assert planning.snap_ends(segments, ends, 1).first()["end"] == 2
    lines = explode_lines(spark.createDataFrame([(1, "a\nFigure 2: x\nb")], "doc_id long, md string"))
    figures = spark.createDataFrame([(1, "2", 1, "![two]"), (1, "9", 2, "![nine]")], "doc_id long, number string, ord int, block string")
    assert assemble(matching.insert_figures(lines, figures)).first()["md"] == "a\nFigure 2: x\n![two]\nb\n![nine]"


def test_rewrites_and_display_headings(spark):
    pairs = spark.createDataFrame([("# Figure 1\n" + "x" * 50, "x" * 60), ("R1 R2 R3 R4 R5 R6 R7 R8", "R1 R2 R3 and nothing more"), ("a b", "a b c")], "before string, after string")
    assert [r["accepted"] for r in scans.accepts_rewrite(pairs).collect()] == [False, False, True]
    lines = spark.createDataFrame([(1, 1, 0.0, 10.0, "Big", 1), (1, 1, 12.0, 22.0, "Title", 2), (1, 1, 60.0, 70.0, "Next", 2)], "doc_id long, page int, y0 double, y1 double, text string, level int")
    assert [(r["text"], r["level"]) for r in scans.display_headings(lines).orderBy("y0").collect()] == [("Big Title", 1), ("Next", 2)]


def test_reprinted_runs_by_trying_every_start():
    rng = random.Random(0)
    for _ in range(300):
        pool = ["x" * (3 * k + 1) for k in range(rng.randint(1, 12))]
        keys = [rng.choice(pool) for _ in range(rng.randint(0, 40))]
        least, chars, reach = rng.randint(1, 3), rng.randint(1, 40), rng.choice([3, 10, 60])
        best, want = 0, None
        for start in range(len(keys)):
            at, k = start - reach - 1, start
            while k < len(keys) and (later := [q for q in range(max(0, at + 1), start) if keys[q] == keys[k]]):
                at, k = later[0], k + 1
            size = sum(map(len, keys[start:k]))
            if k - start >= least and size >= chars and size > best:
                best, want = size, (start, k - start)
        assert grouped.reprinted_run(keys, least, chars, reach) == want


def test_columns_of_a_page(spark):
    def page(number, rows):
        return [(1, number, x0, float(k), x1, k + 1.0, f"{number}.{k}") for k, (x0, x1) in enumerate(rows)]

    two = [(50.0, 280.0)] * 5 + [(310.0, 550.0)] * 5 + [(50.0, 550.0)]
    rows = page(1, two) + page(2, two[:5] + two[-1:]) + page(3, two + [(120.0, 200.0)] * 3) + page(4, two[:1] + two[5:9]) + page(5, [(50.0, 90.0)] * 6 + [(75.0, 95.0)] * 4)
    lines = spark.createDataFrame(rows, "doc_id long, page int, x0 double, y0 double, x1 double, y1 double, text string")
    got = grouped.two_columns(lines).orderBy("page", "y0").collect()
    by_page = {p: [r["column"] for r in got if r["page"] == p] for p in range(1, 6)}
    assert by_page[1] == ["L"] * 5 + ["R"] * 5 + ["F"]  # a second column from 310 on
    assert by_page[2] == [None] * 6  # no start in 30 % of the width
    assert by_page[3] == [None] * 14  # 3 of 14 lines stand elsewhere
    assert by_page[4] == [None] * 5 and by_page[5] == [None] * 10  # too few lines; too narrow a page
    assert grouped.two_columns(lines.limit(0)).count() == 0


def test_tables_become_images(spark):
    rows = [
        (1, "a\n<table><tr>\n\n</TABLE> z", "<table"),
        (2, "a\n| x |\n| y |\n\nz", "| x"),
        (3, "| x | x |", "x"),  # twice
        (4, "none", "x"),
        (5, "a\n| x |", "| x"),  # to the end of the text
        (6, "a\n<table><tr>\n\nz", "<table"),  # never closed
        (7, "text", ""),
        (8, None, "x"),
        (9, "text", None),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, md string, marker string")
    found = M.table_as_image(F.col("md"), F.col("marker"), F.lit("i.png"), F.lit("f"), "N")
    got = {r.doc_id: (r.md, r.replaced) for r in docs.select("doc_id", found.alias("t")).select("doc_id", "t.*").collect()}
    image = "N\n\n![f](i.png)"
    assert got[1] == (f"a\n{image} z", True) and got[2] == (f"a\n{image}\n\nz", True)
    assert got[5] == got[6] == (f"a\n{image}", True)
    assert [got[k] for k in (3, 4, 7, 8, 9)] == [("| x | x |", False), ("none", False), ("text", False), (None, False), ("text", False)]

    texts = [("![f](i.png) z", "d "), ("![f](i.png) z", " "), ("z", "d"), (f"](i.png)\n\n{M.DESCRIPTION_LEAD} d\n", "e"), (None, "d"), ("](i.png)", None), (f"](i.png){'x' * 400}{M.DESCRIPTION_LEAD}", "d")]
    docs = spark.createDataFrame([(k, *r) for k, r in enumerate(texts)], "k int, md string, told string")
    got = docs.orderBy("k").select(M.with_description(F.col("md"), F.lit("i.png"), F.col("told")).alias("d")).select("d.*").collect()
    assert [r.added for r in got] == [True, False, False, False, False, False, True]
    assert got[0].md == f"![f](i.png)\n\n{M.DESCRIPTION_LEAD} d\n z" and [r.md for r in got[1:6]] == [t for t, _ in texts[1:6]]


def test_page_excerpts_and_marks(spark):
    md = "p<!-- page 1 --> one <!--page  02 -->two<!-- page 2 -->three<!-- page 99999999999999999999 -->"
    docs = spark.createDataFrame([(md, 1), (md, 2), (md, 3), (None, 1), ("", 1)], "md string, page int")
    assert [r[0] for r in docs.select(M.page_excerpt(F.col("md"), F.col("page"), 2)).collect()] == ["on", "tw", "", None, ""]
    lines = spark.createDataFrame([("<!-- Slide number: 3 -->",), ("Slide number: x",), ("Slide number:99999999999",), (None,)], "line string")
    assert [r[0] for r in lines.select(M.slide_number(F.col("line"))).collect()] == [3, None, None, None]
    assert spark.range(1).select(M.oversized_figure_id(F.lit("a"), F.lit(3), F.lit(1))).head()[0] == "a__p03_table_oversized1"


def test_segments_and_rasters(spark):
    items = spark.createDataFrame([(1, 1, o) for o in ("l", "c", "re", "qu", "m", None)] + [(1, 2, None)], "doc_id long, page int, op string")
    assert sorted(map(tuple, scans.vector_segments(items).collect())) == [(1, 1, 10), (1, 2, 0)]
    rows = [(1, 1, 7, 0.0, 0.0, 30.0, 10.0), (1, 1, 8, 0.0, 0.0, 29.0, 10.0), (1, 1, 9, 0.0, 0.0, 90.0, 90.0), (1, 1, 10, 90.0, 90.0, 0.0, 0.0), (2, 1, 9, 0.0, 0.0, 90.0, 90.0)]
    images = spark.createDataFrame([(*r, 100.0, 100.0) for r in rows], "doc_id long, page int, xref long, x0 double, y0 double, x1 double, y1 double, pw double, ph double")
    left_out = spark.createDataFrame([(1, 9)], "doc_id long, xref long")
    assert sorted((r.doc_id, r.xref) for r in scans.raster_rects(images, left_out).collect()) == [(1, 7), (2, 9)]
