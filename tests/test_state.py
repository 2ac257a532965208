"""Ledger, matching and streaming."""

from pyspark.sql import functions as F

from quillstream.config import nonempty, setting, truthy
from quillstream.operators import audits, ledger, matching
from quillstream.operators.lines import explode_lines
from quillstream.sources import html, project
from quillstream.streaming.ingest import ingest


def test_names_and_exclusions(spark):
    df = spark.createDataFrame([("a/node_modules/x.py",), ("a/b/x.min.js",), ("a/b/go.sum",), ("a/b/build.py",)], "p string")
    assert [r[0] for r in df.select(ledger.is_excluded_code(F.col("p"))).collect()] == [True, True, True, False]
    files = spark.createDataFrame([("a/X.pdf", "d"), ("b/x.pdf", "d"), ("c/y.pdf", "d")], "src string, domain string")
    owned = spark.createDataFrame([("d", "y.md", "old/y.pdf")], "domain string, md string, src string")
    got = {r["src"]: r["renamed"] for r in ledger.claim_names(files, owned).collect()}
    assert got == {"a/X.pdf": False, "b/x.pdf": True, "c/y.pdf": True}


def test_rerun_has_nothing_to_do(spark):
    files = spark.createDataFrame([("a.pdf", "1"), ("b.md", "2")], "src string, sha256 string")
    led = spark.createDataFrame([("a.pdf", "1", "converted")], "src string, sha256 string, status string")
    assert {r["src"]: r["plan"] for r in ledger.scan(files, led).collect()} == {"a.pdf": "skip", "b.md": "native"}


def test_asof_takes_the_latest_at_or_before(spark):
    left = spark.createDataFrame([(1, 5, "a"), (1, 1, "b"), (2, 9, "c")], "k int, t int, n string")
    right = spark.createDataFrame([(1, 2, "x"), (1, 5, "y"), (1, 6, "z")], "k int, t int, v string")
    got = {r["n"]: r["v"] for r in matching.asof_backward(left, right, ["k"], "t", "t", ["v"]).collect()}
    assert got == {"a": "y", "b": None, "c": None}
    strict = {r["n"]: r["v"] for r in matching.asof_backward(left, right, ["k"], "t", "t", ["v"], strict=True).collect()}
    assert strict["a"] == "x"


def test_resume_needs_the_same_content(spark):
    chunks = spark.createDataFrame([("k", 0, 1, 5), ("k", 1, 6, 9)], "key string, idx int, start int, end int")
    cache = spark.createDataFrame([("k", 0, 1, 5, "t"), ("k", 1, 6, 9, "u")], "key string, idx int, start int, end int, text string").withColumn("sha", F.when(F.col("idx") == 0, F.sha2("text", 256)).otherwise("bad"))
    assert {r["idx"]: r["text"] for r in ledger.resume(chunks, cache).collect()} == {0: "t", 1: None}


def test_html(spark):
    pages = spark.createDataFrame([(1, "<head><title>t</title></head><h1>A &amp; B</h1><p>x <b>y</b></p><ul><li>z</li></ul>"), (2, "")], "page_id long, html string")
    assert {r["page_id"]: r["md"] for r in html.markdown(pages).collect()} == {1: "# A & B\n\nx y\n\n- z", 2: ""}


def test_verdict_json(spark):
    rows = spark.createDataFrame([('so: {"verdict": "match", "reason": "r"}',), ("{broken",), ("none",)], "answer string")
    assert [r["verdict"] for r in project.verdict_json(rows).collect()] == ["match", "unknown", "unknown"]


def test_audit_fires_and_stays_quiet(spark):
    docs = spark.createDataFrame([(1, 1), (2, 2)], "doc_id long, pages int")
    lines = explode_lines(spark.createDataFrame([(1, "<!-- page 1 -->\nx"), (2, "<!-- page 1 -->\n<table>")], "doc_id long, md string"))
    got = {r["doc_id"]: r["fails"] for r in audits.verdict(audits.audit(audits.coverage(docs, lines), audits.structure(lines)), docs).collect()}
    assert got == {1: 0, 2: 2}


def test_settings(monkeypatch):
    assert truthy("yes") and not truthy("0") and nonempty("0")
    monkeypatch.setenv("X_SIZE", "bad")
    assert setting({"a": {"b": "7"}}, "a.b", 1, int, "X_SIZE") == 7


def test_stream_adds_new_content_once(spark, tmp_path):
    root, led, mark = tmp_path / "in", tmp_path / "ledger", tmp_path / "mark"
    root.mkdir()
    (root / "a.txt").write_text("one")
    ingest(spark, str(root), str(led), str(mark))
    (root / "b.txt").write_text("two")
    ingest(spark, str(root), str(led), str(mark))
    ingest(spark, str(root), str(led), str(mark))
    assert spark.read.parquet(str(led)).count() == 2


def test_a_new_checkpoint_does_not_replace_what_is_in_the_ledger(spark, tmp_path):
    root, led = tmp_path / "in", tmp_path / "ledger"
    root.mkdir()
    (root / "a.txt").write_text("one")
    ingest(spark, str(root), str(led), str(tmp_path / "first"))
    (root / "b.txt").write_text("two")
    ingest(spark, str(root), str(led), str(tmp_path / "second"))  # a stream of its own, from batch 0 on
    assert spark.read.parquet(str(led)).count() == 2
