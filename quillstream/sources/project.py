"""Files of a project as rows, and typed places for what other programs provide."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Schemas, as DDL, of what parsers and models outside Spark provide.
BOX = "struct<x0:double,y0:double,x1:double,y1:double>"
VECTOR_LINES = "doc_id string, page int, x0 double, y0 double, x1 double, y1 double, text string, dx double, dy double, size double, bold boolean"
GRIDS = f"doc_id string, page int, grid_no int, rows array<array<string>>, bbox {BOX}, cell_boxes array<array<{BOX}>>"
NETLIST = "ok boolean, reason string, nets array<struct<name:string,connections:array<struct<ref:string,pin:string>>>>, no_connects array<struct<x:double,y:double,ref:string,pin:string>>"
FIGURES = f"doc_id string, figure_id string, page int, caption string, figure_no string, type string, kind string, source string, snap_iou double, description string, bbox {BOX}"


def files(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """path, length, modified, sha256, content of all files under a folder, whatever store holds it."""
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(root)
    return raw.select("path", "length", F.col("modificationTime").alias("modified"), F.sha2("content", 256).alias("sha256"), "content")


def netlist_pins(pages: DataFrame) -> DataFrame:
    """(doc_id, page, json) → doc_id, page, net, ref, pin; text that doesn't parse has no rows."""
    net = pages.select("doc_id", "page", F.from_json("json", NETLIST).alias("n")).select("doc_id", "page", F.explode("n.nets").alias("net"))
    return net.select("doc_id", "page", F.col("net.name").alias("net"), F.explode("net.connections").alias("c")).select("doc_id", "page", "net", "c.ref", "c.pin")


def verdict_json(rows: DataFrame) -> DataFrame:
    """(…, answer) with verdict and reason from the JSON in a model's answer; unknown where it fails."""
    text = F.regexp_extract("answer", r"(?s)(\{.*\})", 1)
    got = F.from_json(text, "verdict string, reason string", {"mode": "PERMISSIVE"})
    known = F.when(got["verdict"].isin("match", "suspect", "unknown"), got["verdict"]).otherwise("unknown")
    reason = F.when(text == "", "model returned no JSON").when(got["verdict"].isNull() & got["reason"].isNull(), "model JSON unparseable").otherwise(F.substring(F.coalesce(got["reason"], F.lit("")), 1, 200))
    return rows.withColumn("verdict", known).withColumn("reason", reason)


@dataclass(frozen=True)
class Boundary:
    """A service outside Spark, as a function from one Arrow-sized pandas frame to another."""

    run: Callable
    schema: str

    def apply(self, rows: DataFrame) -> DataFrame:
        call = self.run

        def each(frames):
            for frame in frames:
                yield call(frame)

        return rows.mapInPandas(each, self.schema)
