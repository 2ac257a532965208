"""Incremental ingestion: new files are hashed, compared with the ledger and added to it, batch by batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FILES = "path string, modificationTime timestamp, length long, content binary"


def new_files(spark: SparkSession, root: str) -> DataFrame:
    """A stream of the files that arrive under ``root``: src, sha256, bytes."""
    raw = spark.readStream.format("binaryFile").option("recursiveFileLookup", True).schema(FILES).load(root)
    return raw.select(F.col("path").alias("src"), F.sha2("content", 256).alias("sha256"), F.col("length").alias("bytes"))


def _has_rows(spark: SparkSession, path: str) -> bool:
    """Whether a batch has been written under ``path``."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    found = system.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/run=*/batch=*/*.parquet"))
    return found is not None and len(found) > 0


def append_changed(ledger_path: str):
    """A batch function that appends files whose content the ledger lacks. A batch's folder is named by
    the stream, which a new checkpoint gives another id, and the batch number: one that comes again
    replaces its folder, so repeats after a failure add nothing, and no stream replaces another's."""

    def run(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        stream = spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "none"
        fresh = batch.dropDuplicates(["src", "sha256"])
        if _has_rows(spark, ledger_path):
            known = spark.read.parquet(ledger_path).where((F.col("run") != stream) | (F.col("batch") != number)).select("src", "sha256")
            fresh = fresh.join(known, ["src", "sha256"], "left_anti")
        fresh.write.mode("overwrite").parquet(f"{ledger_path}/run={stream}/batch={number}")

    return run


def ingest(spark: SparkSession, root: str, ledger_path: str, checkpoint: str) -> None:
    """Take in what has arrived since the last call, then stop."""
    query = new_files(spark, root).writeStream.foreachBatch(append_changed(ledger_path)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
