"""Operators on lines, each against what its rule says, boundaries included."""

import pytest
from pyspark.sql import functions as F

from quillstream.functions import circuits as C
from quillstream.functions import geometry as G
from quillstream.functions import markdown as M
from quillstream.functions import tables as GT
from quillstream.functions import text as T
from quillstream.operators import grouped, passes, planning, scans
from quillstream.operators.lines import assemble, explode_lines
from quillstream.plans.document import clean


def through(spark, md, *steps):
    df = explode_lines(spark.createDataFrame([(1, md)], "doc_id long, md string"))
    for step in steps:
        df = step(df)
    return assemble(df).first()["md"]


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize("md", ["", "a", "a\n", "\n\na\n \n", "x\ny"])
def test_explode_and_assemble_give_the_text_back(spark, md):
    assert through(spark, md) == md


def test_null_text_stays_null(spark):
    assert through(spark, None) is None


def test_headings_are_compared_with_the_anchor(spark):
    md = "# 1 Overview\n\n# Overview\n# 1 Overview\ntext\n# Overview\n\n## 1.1 Overview"
    out = through(spark, md, passes.dedup_headings)
    assert out == "# 1 Overview\ntext\n# Overview\n\n## 1.1 Overview"
    assert through(spark, out, passes.dedup_headings) == out


def test_headings_in_fences_stay(spark):
    md = "# A\n```\n# A\n# A\n```\n# A"
    assert through(spark, md, passes.dedup_headings) == md


def test_figures_are_numbered_outside_fences(spark):
    assert through(spark, "# Figure 7: a\n```\n# Figure 9\n```\n## Figure 3 b", passes.renumber_figures) == "# Figure 1: a\n```\n# Figure 9\n```\n## Figure 2 b"


def test_open_fence_is_closed_or_dropped(spark):
    assert through(spark, "<!-- page 1 -->\n```\ncode\n\n<!-- page 2 -->\nx\n```\n", passes.balance_fences) == "<!-- page 1 -->\n```\ncode\n```\n\n<!-- page 2 -->\nx\n"


def test_bullets(spark):
    md = "intro\n• one\nand more\n\n• two\n– sub\nEnd."
    assert through(spark, md, passes.normalise_bullets) == "intro\n\n- one and more\n- two\n  - sub\nEnd."


def test_straddled_cell(spark):
    md = "| a | b |\n| --- | --- |\n| 1 | goes on |\n\n<!-- page 2 -->\n\nto the end\nNext"
    assert through(spark, md, passes.merge_straddles) == "| a | b |\n| --- | --- |\n| 1 | goes on to the end |\n\n<!-- page 2 -->\n\nNext"


def test_captions_of_a_page(spark):
    md = "<!-- page 1 -->\nFigure 1: a, b\n**Figure 1: a, b**\nother text"
    assert through(spark, md, passes.dedup_captions) == "<!-- page 1 -->\n**Figure 1: a, b**\nother text"
    assert through(spark, "**Figure 1: a, b**\na\nb", passes.dedup_captions) == "**Figure 1: a, b**"


def test_html_tables_are_marked_once(spark):
    out = through(spark, "<!-- page 3 -->\n<table>", passes.flag_html_tables)
    assert out == "<!-- page 3 -->\n<!-- doc:html-table-violation p3 -->\n<table>"
    assert through(spark, out, passes.flag_html_tables) == out


@pytest.mark.parametrize("n,hit", [(19, False), (20, True)])
def test_runaway_boundary(spark, n, hit):
    assert value(spark, M.is_runaway(F.lit("|".join(["ab"] * n)))) is hit


@pytest.mark.parametrize("cell,numeric", [("-1,200.5", True), ("3e-4", True), ("50 %", True), ("$7", True), ("abc", False), ("", False)])
def test_numeric_cells(spark, cell, numeric):
    assert value(spark, M.is_numeric(F.lit(cell))) is numeric


def test_bold_captions_and_levels(spark):
    assert value(spark, M.bold_caption(F.lit("table 3: x"))) == "**Table 3: x**"
    assert value(spark, M.bold_caption(F.lit("**Table 3: x**"))) is None
    assert value(spark, M.relevel(F.lit("# 1.2.3 Title"))) == "### 1.2.3 Title"
    assert value(spark, M.section_heading(F.lit("2.1 Power"), F.lit(""), F.lit(None).cast("string"))) == "## 2.1 Power"
    assert value(spark, M.section_heading(F.lit("2.0 Power"), F.lit(""), F.lit(""))) is None


def test_unicode_strip_and_keys(spark):
    assert value(spark, T.strip(F.lit(" \t a  "))) == "a"
    assert value(spark, T.heading_raw_key(F.lit("STRAẞE  x"))) == "strasse x"
    assert value(spark, T.tokens(F.lit("The cat and the cat sat"))) == ["cat", "cat", "sat"]


def render(spark, grid):
    df = spark.createDataFrame([(grid,)], "g array<array<string>>")
    return GT.render(df, "g", "md").first()["md"]


def test_grid_rendering(spark):
    grid = [["k", "n", "v"], ["a", "1", "x"], ["", "", "y"], ["b", "2", ""]]
    assert render(spark, grid) == ["| k | n | v |", "| :--- | ---: | :--- |", "| a | 1 | x<br>y |", "| b | 2 |  |"]
    two = [["k", "size", ""], ["", "w", "h"], ["a", "1", "2"]]
    assert render(spark, two)[0] == "| k | size w | size h |"


def test_fragment_without_parent_stays(spark):
    grid = [["k", "n", "v"], ["", "", "y"], ["a", "1", "x"], ["", "", "z"]]
    df = GT.merge_fragments(spark.createDataFrame([(grid,)], "g array<array<string>>"), "g")
    assert df.first()["g"] == [["k", "n", "v"], ["", "", "y"], ["a", "1", "x<br>z"]]


VOTES = [
    (["v", C.UNREADABLE, C.UNREADABLE], C.UNREADABLE),
    (["v", "v", "w"], "v"),
    (["u", "v", "w"], C.UNVERIFIED),
    ([C.CONFIRMED, C.CONFIRMED, C.ABSENT], C.CONFIRMED),
    (["v", C.CONFIRMED, C.CONFIRMED], C.CONFIRMED),
    (["v", C.ABSENT, C.ABSENT], C.UNVERIFIED),
    (["v", "v", "w", "w"], C.UNVERIFIED),
    ([C.ABSENT] * 3, C.ABSENT),
    ([C.UNREADABLE, C.ABSENT], C.UNREADABLE),
]


def test_votes(spark):
    rows = [(k, run, v) for k, (votes, _) in enumerate(VOTES) for run, v in enumerate(votes)]
    got = {r["k"]: r["final"] for r in scans.vote(spark.createDataFrame(rows, "k int, run int, verdict string"), ["k"]).collect()}
    assert [got[k] for k in range(len(VOTES))] == [want for _, want in VOTES]


def test_verdict_of_a_line(spark):
    v = lambda line, d: value(spark, C.verdict(F.lit(line), F.lit(d)))["verdict"]
    assert v("| R1 | 4.7 K (note 5V) |", "R1") == "4.7k"
    assert v("R1 10k R2 22k", "R2") == "22k"
    assert v("R1 [unreadable] 10k", "R1") == C.UNREADABLE
    assert v("R1 10k [unverified]", "R1") == C.UNVERIFIED
    assert v("R1 next to U2", "R1") == C.CONFIRMED


@pytest.mark.parametrize("lines,desig,want", [(199, 4, "text"), (200, 4, "light"), (799, 15, "light"), (800, 15, "dense"), (800, 14, "light"), (2500, 0, "dense")])
def test_tiers(spark, lines, desig, want):
    assert value(spark, C.tier(F.lit(lines), F.lit(desig), F.lit(0), F.array().cast("array<string>")))["tier"] == want


def test_boxes(spark):
    b = lambda *x: G.box(*[F.lit(float(v)) for v in x])
    assert value(spark, G.iou(b(0, 0, 2, 2), b(1, 0, 3, 2))) == pytest.approx(1 / 3)
    kept = value(spark, G.suppress(F.array(b(0, 0, 4, 4), b(0, 0, 4, 3.9), b(9, 9, 10, 10))))
    assert len(kept) == 2


def test_chunk_plan(spark):
    docs, large = spark.createDataFrame([(1, 9)], "doc_id long, pages int"), spark.createDataFrame([(1, 4), (1, 5)], "doc_id long, page int")
    got = [(r["action"], r["start"], r["end"]) for r in planning.chunk_plan(docs, large, 3).orderBy("start").collect()]
    assert got == [("ocr", 1, 3), ("skip", 4, 4), ("skip", 5, 5), ("ocr", 6, 8), ("ocr", 9, 9)]


def test_packing_and_cuts(spark):
    blocks = spark.createDataFrame([(1, k, n) for k, n in enumerate([4, 4, 4, 20, 1, 1])], "doc_id long, block_no int, n_chars long")
    assert [r["chunk"] for r in planning.pack_blocks(blocks, 10).orderBy("block_no").collect()] == [0, 0, 1, 2, 3, 3]
    docs, marks = spark.createDataFrame([(1, 40)], "doc_id long, pages int"), spark.createDataFrame([(1, 12), (1, 10)], "doc_id long, page int")
    segments = planning.cuts(docs, marks, 10, 5, 15)
    assert [(r["start"], r["end"], r["reason"]) for r in segments.orderBy("seg").collect()] == [(1, 9, "section"), (10, 19, "hardcut"), (20, 29, "hardcut"), (30, 40, "final")]
    assert planning.is_contiguous(segments, docs).first()["ok"]


def test_repeated_runs():
    assert grouped.repeated_runs(list("abab")).tolist() == [False, False, True, True]
    assert not grouped.repeated_runs(list("aabb")).any()
    assert grouped.assign_tables(["x", "y", "q"], [{"y"}, {"x"}, {"z"}]) == {0: 1, 1: 0, 2: 2}


def test_clean_is_idempotent(spark):
    md = "<!-- page 1 -->\n# 1 A\n\n# A\n\n• one\nand\n\ntable 1: t\n\n| a |\n| --- |\n| 1 |\n<table>"
    docs = spark.createDataFrame([(1, md), (2, None), (3, "")], "doc_id long, md string")
    once = spark.createDataFrame(clean(docs).collect(), "doc_id long, md string")
    again = {r["doc_id"]: r["md"] for r in clean(once).collect()}
    assert again == {r["doc_id"]: r["md"] for r in once.collect()}
    assert again[2] is None and again[3] == ""
