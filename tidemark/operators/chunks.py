"""Transcripts, document chunks and the embedding cache."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.records import parsed
from tidemark.functions.text import chunk_words, hash_embed, mask_pii, text_hash, transcript_text
from tidemark.operators.keyed import concerned, latest_by, unseen

# Fixed values of the document index.
MODEL_VERSION = "hash-embed-v1"
CHUNK_SIZE = 40
CHUNK_OVERLAP = 8

# A model takes rows (text_hash, chunk_text) and returns rows (text_hash, embedding).
Model = Callable[[DataFrame], DataFrame]

_EXPORT = "ticket_id STRING, turns ARRAY<STRUCT<role: STRING, text: STRING>>"


def decode_exports(bronze: DataFrame) -> DataFrame:
    """One masked transcript per export record."""
    export = bronze.select("*", parsed(F.col("_payload"), _EXPORT).alias("x"))
    return export.select(
        F.col("x")["ticket_id"].alias("ticket_id"),
        F.col("_ingested_at").alias("exported_at"),
        F.size(F.col("x")["turns"]).alias("n_turns"),
        mask_pii(transcript_text(F.col("x")["turns"])).alias("text"),
        "_batch_id",
    )


def latest_exports(exports: DataFrame) -> DataFrame:
    """The newest export of every ticket."""
    # Exports of one ticket at one time are interchangeable; the text only makes the choice stable.
    return latest_by(exports, ["ticket_id"], [F.col("exported_at"), F.col("n_turns"), F.col("text")])


def live_transcripts(transcripts: DataFrame, tickets: DataFrame) -> DataFrame:
    """Transcripts of tickets that exist and are not deleted, with the ticket's attributes."""
    live = tickets.where(~F.col("is_deleted")).select("ticket_id", "category", "priority", "status")
    return transcripts.select("ticket_id", "text").join(live, "ticket_id")


def split_chunks(texts: DataFrame, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP) -> DataFrame:
    """One row per chunk of `text`, with its position and hash; other columns are kept."""
    others = [c for c in texts.columns if c != "text"]
    pieces = texts.select(*others, F.posexplode(chunk_words(F.col("text"), size, overlap)).alias("chunk_idx", "chunk_text"))
    return pieces.withColumn("text_hash", text_hash(F.col("chunk_text")))


def missing_embeddings(
    chunks: DataFrame, cache: DataFrame, model_version: str = MODEL_VERSION, at_most: int | None = None
) -> DataFrame:
    """The distinct (text_hash, chunk_text) the cache has no embedding of this model for.

    Copies collapse before the shuffle, so a text that occurs in a third of all chunks is one row here.
    `at_most` is a bound on the number of chunks, if known; few chunks spare the cache its shuffle.
    """
    known = cache.where(F.col("model_version") == model_version).select("text_hash")
    distinct = chunks.groupBy("text_hash").agg(F.min("chunk_text").alias("chunk_text"))
    return unseen(known, distinct, "text_hash", at_most)


def hash_model(texts: DataFrame) -> DataFrame:
    """The built-in model: column functions only."""
    return texts.select("text_hash", hash_embed(F.col("chunk_text")).alias("embedding"))


def embed(texts: DataFrame, model: Model = hash_model, model_version: str = MODEL_VERSION) -> DataFrame:
    return model(texts).select("text_hash", F.lit(model_version).alias("model_version"), "embedding")


def with_embeddings(
    chunks: DataFrame, cache: DataFrame, model_version: str = MODEL_VERSION, at_most: int | None = None
) -> DataFrame:
    """Chunks joined to their cached embedding of this model.

    The cache has one row per hash and model, so a hot hash is split by the skew join, not multiplied.
    """
    current = concerned(cache.where(F.col("model_version") == model_version), chunks, "text_hash", at_most)
    return chunks.join(current, "text_hash").withColumnRenamed("model_version", "embedding_model_version")
