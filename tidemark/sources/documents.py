"""Documents and trace exports in, JSON-lines data sets out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.landing import read_json_array


def read_documents(spark: SparkSession, folder: str, pattern: str = "*.md") -> DataFrame:
    """(`doc`, `text`) of the files of a folder; `doc` sorts by file name."""
    files = spark.read.option("pathGlobFilter", pattern).text(folder, wholetext=True)
    return files.select(F.col("_metadata.file_name").alias("doc"), F.col("value").alias("text"))


def read_trace_export(spark: SparkSession, path: str) -> DataFrame:
    """Root spans of trace exports, files of one JSON array each, in order of arrival."""
    arrays = read_json_array(spark, path)
    return arrays.select(F.struct("file", "block", "pos").alias("trace_ord"), F.col("record").alias("root"))


def read_trace_lines(spark: SparkSession, path: str) -> DataFrame:
    """Root spans of trace exports with one span tree per line, the form to prefer: files can be split."""
    lines = spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        # Rises along the lines of a block, which is all that is asked of it.
        F.monotonically_increasing_id().alias("pos"),
    )
    kept = lines.where(F.trim("value") != "")
    return kept.select(F.struct("file", "block", "pos").alias("trace_ord"), F.parse_json("value").alias("root"))


def write_jsonl(df: DataFrame, folder: str) -> int:
    """Write rows as JSON lines, null fields included; the number of rows written."""
    df.write.option("ignoreNullFields", "false").json(folder)
    return df.sparkSession.read.text(folder).count()
