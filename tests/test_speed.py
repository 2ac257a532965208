"""Cheaper ways to the same results: what they must equal, and what they must not do."""

import random

from pyspark.sql import functions as F

from quillstream.functions import markdown as M
from quillstream.functions import text as T


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_trimming_equals_the_pattern_without_one(spark):
    chars = [chr(k) for k in range(1, 0x3100) if not 0xD800 <= k < 0xE000]
    rows = [(f"{c}a{c}b{c}{c}",) for c in chars] + [("",), (None,), (" \t\n",), ("a \n",), ("\u3000\u00a0 x\r\n",)]
    df = spark.createDataFrame(rows, "s string")
    old = {T.strip: r"(?U)^\s+|\s+$", T.lstrip: r"(?U)^\s+", T.rstrip: r"(?U)\s+$"}
    for f, pattern in old.items():
        assert df.where(~f(F.col("s")).eqNullSafe(F.regexp_replace("s", pattern, ""))).count() == 0
    assert "regexp_replace" not in plan(df.select(T.strip(F.col("s"))))


def test_runaway_folds_only_lines_that_can_run(spark):
    r = random.Random(3)
    lines = [None, "", "| --- " * 30 + "|", "word " * 300, "x1\u3000" * 60, "7, " * 19, "7, " * 20, "a b," * 21, "thirteenchars " * 40, "a1 " * 19 + "b " * 200, "a1 " * 20 + "b " * 200]
    lines += ["".join(r.choice(["x1 ", "x1  ", "7,", "| 5 ", "la ", "long-word-here "]) * r.choice([1, 2, 3, 19, 20]) for _ in range(3)) for _ in range(300)]
    df = spark.createDataFrame([(x,) for x in lines], "s string")
    c = F.col("s")
    words = (F.length(c) > 200) & M.repeats_in_row(F.split(c, r"(?U)\s+"), code_like=True)
    whole = ~M.is_separator(c) & ((c.contains("|") & c.rlike(M.ELLIPSES)) | M.repeats_in_row(F.split(c, "[|,]")) | words)
    got = df.select(F.coalesce(M.is_runaway(c), F.lit(False)).alias("a"), F.coalesce(whole, F.lit(False)).alias("b")).collect()
    assert all(x["a"] == x["b"] for x in got) and 20 < sum(x["a"] for x in got) < len(got) - 20
    assert "CASE WHEN" in plan(df.where(M.is_runaway(c)))
