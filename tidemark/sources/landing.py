"""Landing: each source's delivery of a day as immutable Parquet, and reading what has landed."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.records import parsed
from tidemark.functions.times import from_iso, from_millis
from tidemark.operators.schemas import BRONZE, conform
from tidemark.session import PACKED, cut_lineage, passing, together
from tidemark.sources.folders import Folders

_BRONZE_FILES = T.StructType([*BRONZE.fields, T.StructField("ingest_date", T.StringType())])


def kafka_records(lines: DataFrame, source: str, day: str, with_op: bool) -> DataFrame:
    """Bronze rows from JSON lines (`value`), one Kafka record each; blank lines are skipped.

    The line is kept as it came. A line that is no JSON, or an array of records, is kept too, with
    nulls beside it; `quality.unreadable_records` lists such lines.
    """
    head = parsed(F.col("value"), "timestamp BIGINT, partition INT, offset BIGINT, value STRUCT<op: STRING>")
    return lines.where(F.trim("value") != "").select("value", head.alias("r")).select(
        F.lit(source).alias("_source"),
        F.lit(day).alias("_batch_id"),
        from_millis(F.col("r")["timestamp"]).alias("_ingested_at"),
        F.col("r")["partition"].alias("_kafka_partition"),
        F.col("r")["offset"].alias("_kafka_offset"),
        (F.col("r")["value"]["op"] if with_op else F.lit(None).cast("string")).alias("_op"),
        F.col("value").alias("_payload"),
    )


def export_records(records: DataFrame, source: str, day: str) -> DataFrame:
    """Bronze rows from export objects (`record` variant)."""
    return records.select(
        F.lit(source).alias("_source"),
        F.lit(day).alias("_batch_id"),
        from_iso(F.try_variant_get("record", "$.exported_at", "string")).alias("_ingested_at"),
        F.lit(None).cast("int").alias("_kafka_partition"),
        F.lit(None).cast("bigint").alias("_kafka_offset"),
        F.lit(None).cast("string").alias("_op"),
        F.to_json("record").alias("_payload"),
    )


def _prefix(pieces: DataFrame, column: str, name: str) -> DataFrame:
    """Adds the sum of `column` over the file's pieces before each one, as `name`.

    A block of a file is what one task reads. Blocks are summed first, and those few sums in order of the
    blocks; within a block a piece adds those before it.
    """
    sums = pieces.groupBy("file", "block").agg(F.sum(column).alias("_sum"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("file", "block", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_offset"))
    here = Window.partitionBy("file", "block").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    summed = pieces.withColumn("_here", F.coalesce(F.sum(column).over(here), F.lit(0)))
    return summed.join(offsets, ["file", "block"]).withColumn(name, F.col("_here") + F.col("_offset")).drop("_here", "_offset")


def read_json_array(spark: SparkSession, path: str) -> DataFrame:
    """(`file`, `block`, `pos`, `record` variant) of files that hold one JSON array each, every field kept.

    A file is cut at its closing braces, wherever they stand, and read in as many tasks as it has blocks. How
    many quotes stand before a piece tells whether it begins inside a string; braces and brackets outside
    strings tell where a record ends; both are sums over the pieces before. Pieces of one record are put together
    again, so only a record is one value (Spark's bound for one is 2 GB). `block` and `pos` are in the order
    of the elements. A file that is cut off, or no array, fails the read; one of no bytes has no rows.
    """
    raw = spark.read.option("lineSep", "}").text(path)
    count = lambda text, sign: (F.length(text) - F.length(F.translate(text, sign, ""))).cast("long")
    nests = lambda text: count(text, "{[") - count(text, "]")
    # Only strings have backslashes, and none stands before a brace a piece was cut at.
    plain = F.regexp_replace("value", r"(?s)\\.", "")
    without = lambda text: F.regexp_replace(text, r'"[^"]*("|$)', "")
    outside, from_inside = without(plain), without(F.regexp_replace(plain, r'^[^"]*("|$)', ""))
    place = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("pos")]
    counted = raw.select(*place, "value", count(plain, '"').alias("quotes"), nests(outside).alias("outside"), nests(from_inside).alias("from_inside"))
    pieces = cut_lineage(counted)
    # All sums are over a few numbers for each piece; texts are shuffled only to be put together.
    marks = pieces.drop("value")
    last = marks.groupBy("file").agg(F.max(F.struct("block", "pos")).alias("_last"))
    # What follows the last brace, a bracket if all is well, is not closed by one.
    marked = marks.join(last, "file").withColumn("cut", F.struct("block", "pos") < F.col("_last")).drop("_last")
    inside = _prefix(marked, "quotes", "before").withColumn("inside", F.col("before") % 2 == 1)
    closes = F.col("cut") & ((F.col("before") + F.col("quotes")) % 2 == 0)
    opened = F.when(F.col("inside"), F.col("from_inside")).otherwise(F.col("outside"))
    deep = inside.select("file", "block", "pos", closes.alias("closes"), (opened - closes.cast("long")).alias("step"))
    # An element ends where nothing is open but the array itself.
    ended = _prefix(deep, "step", "depth").withColumn("ends", (F.col("closes") & (F.col("depth") + F.col("step") == 1)).cast("long"))
    numbered = _prefix(ended.select("file", "block", "pos", "ends"), "ends", "number")
    told = pieces.select("pos", "value").join(numbered, "pos")
    texts = F.transform(F.sort_array(F.collect_list(F.struct("block", "pos", "value"))), lambda p: p["value"])
    records = told.groupBy("file", "number").agg(F.array_join(texts, "}").alias("text"), (F.sum("ends") > 0).alias("whole"))
    return _elements(records)


def _elements(records: DataFrame) -> DataFrame:
    """The elements in each part of an array: what stands before a record, if anything, and the record."""
    text = F.regexp_replace(F.col("text"), r"^\s+|\s+$", "")
    text = F.when(F.col("whole"), F.concat(text, F.lit("}"))).otherwise(text)
    sign = F.when(F.col("number") == 0, "[").otherwise(",")
    ends = F.col("whole") | text.endswith("]")
    refused = F.raise_error(F.concat(F.lit("no array: "), F.col("file")))
    # The tail after the last record may be the bracket alone.
    only_bracket = ~F.col("whole") & (F.col("number") > 0) & (text == "]")
    body = F.substring(text, F.lit(2), F.length(text) - F.when(F.col("whole"), 1).otherwise(2))
    listed = F.when(only_bracket, "").when(text.startswith(sign) & ends, body).otherwise(refused.cast("string"))
    blank = F.trim(listed) == ""
    # Nothing but a comma before the end is no array.
    empty = blank & (only_bracket | (F.col("number") == 0))
    found = F.from_json(F.concat(F.lit('{"all":['), listed, F.lit("]}")), "all ARRAY<VARIANT>", {"mode": "FAILFAST"})["all"]
    elements = F.when(blank & ~empty, refused.cast("array<variant>")).otherwise(F.coalesce(found, refused.cast("array<variant>")))
    exploded = records.select("file", F.col("number").alias("block"), F.posexplode(elements).alias("pos", "record"))
    return exploded.withColumn("pos", F.col("pos").cast("bigint"))


def read_json_lines(spark: SparkSession, path: str) -> DataFrame:
    """(`record` variant) of files with one JSON object per line, the form to prefer: lines can be split.

    A line that is no JSON becomes a record that is its text.
    """
    lines = spark.read.text(path).where(F.trim("value") != "")
    as_text = F.parse_json(F.to_json(F.struct("value")))
    record = F.coalesce(F.try_parse_json("value"), F.try_variant_get(as_text, "$.value", "variant"))
    return lines.select(record.alias("record"))


@dataclass(frozen=True)
class Source:
    """Where a source's delivery of a day may lie, below the delivery root, and how it is read."""

    paths: tuple[str, ...]
    read: Callable[[SparkSession, str, str, str], DataFrame]


def _kafka(with_op: bool):
    def read(spark: SparkSession, path: str, source: str, day: str) -> DataFrame:
        return kafka_records(spark.read.text(path), source, day, with_op)

    return read


def _export(spark: SparkSession, path: str, source: str, day: str) -> DataFrame:
    read = read_json_lines if path.endswith(".jsonl") else read_json_array
    return export_records(read(spark, path), source, day)


# The layout the source systems deliver in.
SOURCES = {
    "tickets": Source(("cdc/tickets/{day}.jsonl",), _kafka(with_op=True)),
    "events": Source(("events/{day}.jsonl",), _kafka(with_op=False)),
    "transcripts": Source(("transcripts/{day}.json", "transcripts/{day}.jsonl"), _export),
}


class Bronze:
    """The landed records of all sources below `root`, one folder per source and ingest day."""

    def __init__(self, spark: SparkSession, root: str, deliveries: str):
        self.spark, self.root, self.deliveries = spark, root, deliveries
        self.folders = Folders(spark)

    def _day_folder(self, source: str, day: str) -> str:
        return f"{self.root}/{source}/ingest_date={day}"

    def land(self, source: str, day: str) -> dict:
        """Land one delivery, once. What has landed is never written again."""
        target = self._day_folder(source, day)
        if self.folders.exists(target):
            return {"source": source, "day": day, "status": "already-landed", "rows": self._rows(target)}
        spec = SOURCES[source]
        places = [f"{self.deliveries}/{path.format(day=day)}" for path in spec.paths]
        delivered = [place for place in places if self.folders.exists(place)]
        if not delivered:
            return {"source": source, "day": day, "status": "no-data", "rows": 0}
        # Written aside and renamed: a half-written day is never visible.
        aside = f"{self.root}/{source}/_incoming-{uuid.uuid4().hex}"
        with passing(self.spark):
            # A day may come in several files; all of them are the day's delivery.
            files = [conform(spec.read(self.spark, place, source, day), BRONZE) for place in delivered]
            reduce(DataFrame.unionByName, files).write.option("compression", PACKED).parquet(aside)
        rows = self._rows(aside)
        if not rows:
            return {"source": source, "day": day, "status": "no-data", "rows": 0}
        self.folders.move(aside, target)
        return {"source": source, "day": day, "status": "landed", "rows": rows}

    def land_day(self, day: str) -> dict:
        return together(self.spark, **{source: partial(self.land, source, day) for source in SOURCES})

    def _rows(self, folder: str) -> int:
        return self.spark.read.schema(BRONZE).parquet(folder).count()

    def landed_days(self, source: str) -> list[str]:
        names = self.folders.names(f"{self.root}/{source}")
        return [n.removeprefix("ingest_date=") for n in names if n.startswith("ingest_date=")]

    def scan(self, source: str, batch: str | None = None, upto: str | None = None) -> DataFrame:
        """Landed records: all, those of one batch, or those of batches up to a day.

        Batch and ingest day are the same, so the filter prunes folders. Typed and empty when nothing
        has landed.
        """
        folder = f"{self.root}/{source}"
        if not self.landed_days(source):
            return self.spark.createDataFrame([], BRONZE)
        records = self.spark.read.schema(_BRONZE_FILES).parquet(folder)
        if batch is not None:
            records = records.where(F.col("ingest_date") == batch)
        if upto is not None:
            records = records.where(F.col("ingest_date") <= upto)
        return records.drop("ingest_date")
