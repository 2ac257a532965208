"""HTML to Markdown lines and CSV to tables, by expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.tables import render
from ..functions.text import collapse


def unescape(c: Column) -> Column:
    for entity, text in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")):
        c = F.replace(c, F.lit(entity), F.lit(text))
    return c


def inner_text(c: Column) -> Column:
    return collapse(unescape(F.regexp_replace(c, r"(?s)<[^>]*>", " ")))


def body(html: Column) -> Column:
    return F.regexp_replace(html, r"(?is)<(script|style|head)\b.*?</\1>|<!--.*?-->", "")


def elements(pages: DataFrame) -> DataFrame:
    """pages (page_id, html) → page_id, pos, tag, text of headings, paragraphs and list items, in order."""
    rx = r"(?is)<(h[1-6]|p|li)\b[^>]*>(.*?)</\1>"
    b = body(F.col("html"))
    both = F.arrays_zip(F.regexp_extract_all(b, F.lit(rx), F.lit(1)).alias("tag"), F.regexp_extract_all(b, F.lit(rx), F.lit(2)).alias("text"))
    rows = pages.select("page_id", F.posexplode(both).alias("pos", "e"))
    return rows.select("page_id", "pos", F.lower("e.tag").alias("tag"), inner_text(F.col("e.text")).alias("text"))


def markdown(pages: DataFrame) -> DataFrame:
    """page_id, md: headings with marks, items with dashes, blocks parted by blank lines."""
    level = F.substring("tag", 2, 1).cast("int")
    line = F.when(F.col("tag").startswith("h"), F.concat(F.repeat(F.lit("#"), level), F.lit(" "), "text")).when(F.col("tag") == "li", F.concat(F.lit("- "), "text")).otherwise(F.col("text"))
    rows = elements(pages).where("text <> ''").withColumn("line", line)
    parts = F.transform(F.array_sort(F.collect_list(F.struct("pos", "line"))), lambda x: x["line"])
    md = rows.groupBy("page_id").agg(F.array_join(parts, "\n\n").alias("md"))
    return pages.select("page_id").join(md, "page_id", "left").select("page_id", F.coalesce("md", F.lit("")).alias("md"))


def read_csv_tables(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """CSV files as Markdown tables: path, md. Rows keep their order within a file (file and position)."""
    rows = spark.read.option("header", "false").schema(", ".join(f"`{c}` string" for c in columns)).csv(path)
    cells = F.array(*[F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in columns])
    rows = rows.select(F.input_file_name().alias("path"), F.monotonically_increasing_id().alias("n"), cells.alias("cells"))
    grid = rows.groupBy("path").agg(F.transform(F.array_sort(F.collect_list(F.struct("n", "cells"))), lambda x: x["cells"]).alias("grid"))
    return render(grid, "grid", "md").select("path", F.array_join("md", "\n").alias("md"))
