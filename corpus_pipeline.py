"""The corpus pipeline: raw documents to balanced shards of a clean mix.

Each stage takes what the one before it kept, written as Parquet, and its decisions take effect:
rejected documents go, one document of each near-duplicate class stays, benchmark passages are cut
out, sources are mixed to their targets, and the mix is dealt over shards.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontamination, mixing, near_dedup, quality_classifier, sharding
from tidemark.llm.common import table
from tidemark.llm.shipping import ship
from tidemark.session import shared_folder, tune

SHARDS = 40


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the quality classifier does not reject.

    Rows without a text, and empty texts, are judged by the model's prior; a very long text is judged
    whole, by one task. Equal texts fare alike. No labels reject nothing; no rows, no result.
    """
    ship(spark)
    return quality_classifier.accepted(docs, table(tune(spark), sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each near-duplicate class.

    Rows without a text are no duplicates but of rows with their id; equal rows, and equal texts under any
    ids, are one class. A very long text is compared whole. No rows, no result.
    """
    ship(spark)
    return near_dedup.first_of_each(docs)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages they share with a benchmark; `n_chars` follows the text.

    Documents without a hit, or without a text, stay as they are; those with nothing else go. A very long
    text is searched whole, equal rows are cut alike. No rows, no result.
    """
    ship(spark)
    clean = decontamination.decontaminate(docs, table(tune(spark), sf_dir, "benchmark"))
    if "n_chars" not in docs.columns:
        return clean
    return clean.select(*[F.length("text").cast("long").alias(c) if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns])


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, whole.

    Rows without a source are a source, the last; documents without words come as often as their source's
    complete epochs, at least once. Keys come from ids and texts, so equal rows are taken alike, and a very
    long text is one document. No rows, no mix.
    """
    tune(spark)
    return mixing.mixed_rows(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix with each row's shard, by a slot map saved beside the results.

    `size`, `virtual_slot`, `shard` and `map_version` are added and take the place of columns so called.
    Rows without an id or a text have a slot by what they have; a very long text is one record of its size,
    and rows equal in id and text share a slot. No rows, no result.
    """
    tune(spark)
    slot_map, _ = sharding.stored_map(docs, SHARDS)
    rows = docs.select(F.col("doc_id"), F.col("text"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    placed = sharding.place_records(rows, slot_map)
    own = [F.col("placed.size"), F.col("placed.virtual_slot"), F.col("placed.shard"), F.col("placed.version").alias("map_version")]
    kept = [F.col(f"row.`{c}`") for c in docs.columns if c not in ("size", "virtual_slot", "shard", "map_version")]
    return placed.select(*kept, *own)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("benchmark_passages", benchmark_passages),
    ("mix", mix),
    ("shards", shards),
]

# The classifier's scores and the signatures are not expressible in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table; each stage's rows are written to the shared folder."""
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4()}"
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
