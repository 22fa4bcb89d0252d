"""Sharding by fixed virtual slots and a versioned map from slots to shards.

Records are hashed into a few thousand slots once and for all. Bytes are summed per slot, and the map
says which shard holds each slot. Balancing, growing and shrinking edit the map; a record's slot never
changes, so only the slots whose entry was edited move.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import store
from tidemark.session import shared_folder

SLOTS = 4096
# Besides its text a record counts for this many bytes.
RECORD_BYTES = 16


def record_size(text: Column) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + RECORD_BYTES).cast("long")


def text_crc32(text: Column) -> Column:
    return F.crc32(F.coalesce(text, F.lit("")).cast("binary"))


def slot_of(doc_id: Column, text: Column, slots: int = SLOTS) -> Column:
    """The slot of a record: of its id, or an empty one, and its text's checksum and size.

    So rows without an id, and texts under one id, are many slots' worth; only rows that are equal in both
    share a slot whatever happens. md5, so that other engines can follow.
    """
    told = F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("")), text_crc32(text).cast("string"), record_size(text).cast("string"))
    return F.pmod(F.conv(F.substring(F.md5(told), 1, 12), 16, 10).cast("long"), F.lit(slots)).cast("int")


def slot_weights(docs: DataFrame, doc_id="doc_id", text="text", slots: int = SLOTS) -> DataFrame:
    """`virtual_slot, bytes, records` for every slot that has records: at most `slots` rows."""
    rows = docs.select(slot_of(F.col(doc_id), F.col(text), slots).alias("virtual_slot"), record_size(F.col(text)).alias("size"))
    return rows.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("records"))


def first_map(weights: DataFrame, shards: int) -> DataFrame:
    """Version 0: slots by falling bytes, each to the shard with the fewest bytes so far.

    The fold runs over one array of at most a few thousand slots, whatever the records are.
    """
    slots = F.array_sort(F.collect_list(F.struct((-F.col("bytes")).alias("rank"), "virtual_slot")))
    fold = """
        aggregate(slots,
            named_struct('loads', array_repeat(0L, {n}), 'placed', CAST(array() AS array<int>)),
            (state, slot) -> named_struct(
                'loads', transform(state.loads, (load, i) -> IF(i = array_position(state.loads, array_min(state.loads)) - 1, load - slot.rank, load)),
                'placed', array_append(state.placed, CAST(array_position(state.loads, array_min(state.loads)) - 1 AS int))),
            state -> state.placed)
    """.format(n=int(shards))
    placed = weights.agg(slots.alias("slots")).select("slots", F.expr(fold).alias("placed"))
    pairs = placed.select(F.posexplode("slots").alias("i", "slot"), "placed")
    return pairs.select(F.lit(0).alias("version"), F.col("slot.virtual_slot").alias("virtual_slot"), F.element_at("placed", F.col("i") + 1).alias("shard"))


def grow_map(current: DataFrame, weights: DataFrame, new_shard: int) -> DataFrame:
    """The next version with one shard more: every shard gives slots to it, none receives any other.

    Each shard gives up its lightest slots as long as they are within the new shard's fair part of
    its bytes, 1 / (number of shards with the new one).
    """
    known = current.join(weights, "virtual_slot", "left").withColumn("bytes", F.coalesce("bytes", F.lit(0)))
    lightest = Window.partitionBy("shard").orderBy("bytes", "virtual_slot").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    held = F.sum("bytes").over(Window.partitionBy("shard"))
    edited = F.when(F.sum("bytes").over(lightest) * (new_shard + 1) <= held, new_shard).otherwise(F.col("shard"))
    return known.select((F.col("version") + 1).alias("version"), "virtual_slot", edited.cast("int").alias("shard"))


def save_map(slot_map: DataFrame, folder: str) -> None:
    """Writes one version; versions before it stay, and a version that is there is never replaced."""
    slot_map.coalesce(1).write.partitionBy("version").mode("append").parquet(folder)


def load_map(spark: SparkSession, folder: str, version: int | None = None) -> DataFrame:
    """A version of the map, by default the newest."""
    versions = spark.read.schema("virtual_slot int, shard int, version int").parquet(folder)
    if version is None:
        version = versions.agg(F.max("version")).first()[0]
    return versions.where(F.col("version") == F.lit(version)).select("version", "virtual_slot", "shard")


def stored_map(docs: DataFrame, shards: int, doc_id="doc_id", text="text", slots: int = SLOTS, folder: str | None = None) -> tuple[DataFrame, DataFrame]:
    """The first map for `docs`, saved as version 0 in `folder`, and the slots' weights, stored.

    Without a folder a new one in the shared folder is taken.
    """
    weights = store(slot_weights(docs, doc_id, text, slots))
    folder = folder or f"{shared_folder(docs.sparkSession)}/slot-map-{uuid.uuid4()}"
    save_map(first_map(weights, shards), folder)
    return load_map(docs.sparkSession, folder, 0), weights


def edited_map(slot_map: DataFrame, weights: DataFrame, new_shard: int, folder: str) -> DataFrame:
    """The newest version of the map after one shard more has been added, saved beside the versions before."""
    save_map(grow_map(slot_map, weights, new_shard), folder)
    return load_map(slot_map.sparkSession, folder)


def place_records(docs: DataFrame, slot_map: DataFrame, doc_id="doc_id", text="text", slots: int = SLOTS) -> DataFrame:
    """All columns of `docs` and a struct `placed`: `size, text_crc32, virtual_slot, shard, version`.

    Null texts have no bytes and the checksum of none, 0; a very long text is one record. Rows without an id
    have slots by their texts. The map has at most `slots` rows, so it is broadcast. A column called `placed`
    is replaced. No rows, no result.
    """
    own = F.struct(
        record_size(F.col(text)).alias("size"),
        text_crc32(F.col(text)).alias("text_crc32"),
        slot_of(F.col(doc_id), F.col(text), slots).alias("virtual_slot"),
    )
    rows = docs.select(F.struct("*").alias("_row"), own.alias("_own"))
    known = slot_map.select(F.struct("virtual_slot", "shard", "version").alias("_map"))
    joined = rows.join(F.broadcast(known), F.col("_own.virtual_slot") == F.col("_map.virtual_slot"))
    kept = [F.col(f"_row.`{c}`") for c in docs.columns if c != "placed"]
    placed = F.struct("_own.size", "_own.text_crc32", "_own.virtual_slot", "_map.shard", "_map.version")
    return joined.select(*kept, placed.alias("placed"))


def place_in_shard(placed: DataFrame, slot_map: DataFrame, weights: DataFrame, order: list[Column]) -> DataFrame:
    """`placed` with `slot`, the record's place within its shard, from 0 without gaps.

    A shard's slots follow each other, so a place is the count of records in the shard's earlier
    slots, known from the map, plus the rank within the virtual slot: no shard is sorted as a whole.
    """
    earlier = Window.partitionBy("shard").orderBy("virtual_slot").rowsBetween(Window.unboundedPreceding, -1)
    offsets = slot_map.join(weights, "virtual_slot").select(
        F.struct("virtual_slot", F.coalesce(F.sum("records").over(earlier), F.lit(0)).alias("offset")).alias("_start")
    )
    within = Window.partitionBy("placed.virtual_slot").orderBy(*order)
    ranked = placed.withColumn("_rank", F.row_number().over(within) - 1)
    joined = ranked.join(F.broadcast(offsets), F.col("placed.virtual_slot") == F.col("_start.virtual_slot"))
    return joined.withColumn("slot", (F.col("_start.offset") + F.col("_rank")).cast("long")).drop("_rank", "_start")
