"""Quality classifier: logistic regression on hashed word n-grams, trained by FTRL, scored everywhere.

Training takes a bounded sample of labelled rows, dealt over shards of a fixed size; each shard is
learned by one task and the shards' weights are averaged, so the model depends on the labels alone and
not on the cluster. Scoring is one sparse dot product per text, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import WordHashes, small_batches, texts
from tidemark.llm.linear import Ftrl, features, score, train

# The labelled rows that are learned from are at most so many, those with the smallest id hashes.
SAMPLE_ROWS = 16_000
# A shard learns from about so many of them.
SHARD_ROWS = 2_000
REJECT_BELOW = 0.3


def held_out(doc_id: Column) -> Column:
    """One id in five is never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def labelled_sample(labels: DataFrame, doc_id="doc_id", label="quality", rows: int = SAMPLE_ROWS) -> DataFrame:
    """`id, label, rank` of at most `rows` labelled documents that are not held out.

    Null ids and null labels are left out. A document labelled more than once counts once, as bad if
    any of its labels says so.
    """
    known = labels.where(F.col(doc_id).isNotNull() & F.col(label).isin(0, 1) & ~held_out(F.col(doc_id)))
    once = known.groupBy(F.col(doc_id).alias("id")).agg(F.min(label).cast("int").alias("label"))
    return once.withColumn("rank", F.xxhash64("id")).orderBy("rank", "id").limit(rows)


def train_model(docs: DataFrame, labels: DataFrame, doc_id="doc_id", text="text", label="quality", rows: int = SAMPLE_ROWS, settings: Ftrl = Ftrl(), shard_rows: int = SHARD_ROWS) -> np.ndarray:
    """The averaged weights: `2 ** bits + 1` numbers, a megabyte, whatever the tables' size.

    Without labelled documents the model is the constant 1/2.
    """
    sample = labelled_sample(labels, doc_id, label, rows)
    shards = max(1, -(-sample.count() // shard_rows))
    # At most `rows` short rows, so they may be sent to every task.
    rows_with_text = small_batches(docs).select(F.col(doc_id).alias("id"), F.col(text).alias("text")).join(F.broadcast(sample), "id")
    # Of an id with several rows one text is learned from, the one with the smallest digest; an id may have a
    # third of all rows, and each task sends one of them at most.
    one = F.struct(F.col("text").isNull().alias("none"), F.sha2("text", 256).alias("digest"))
    rows_with_text = rows_with_text.groupBy("id", "label", "rank").agg(F.min_by("text", one).alias("text"))
    dealt = rows_with_text.repartition(shards, F.pmod("rank", F.lit(shards))).select(F.pmod("rank", F.lit(shards)).cast("int").alias("shard"), "rank", "id", "label", "text")

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, by_shard = WordHashes(), {}
        for batch in batches:
            shard, rank, ids, label, _ = (c.to_pylist() for c in batch.columns[:4] + [batch.column(0)])
            for s, r, i, y, t in zip(shard, rank, ids, label, texts(batch.column(4)), strict=True):
                index, value = features(t, hashes, settings.bits)
                by_shard.setdefault(s, []).append((r, i, index, value, y))
        for s, examples in by_shard.items():
            examples.sort(key=lambda e: e[:2])
            weights = train([e[2:] for e in examples], settings)
            yield pa.RecordBatch.from_arrays([pa.array([s], pa.int32()), pa.array([weights.astype(np.float32).tobytes()], pa.binary())], ["shard", "weights"])

    learned = dealt.mapInArrow(learn, "shard int, weights binary").collect()
    if not learned:
        return np.zeros((1 << settings.bits) + 1, np.float32)
    return np.mean([np.frombuffer(row["weights"], np.float32) for row in sorted(learned, key=lambda r: r["shard"])], axis=0)


def quality_score(docs: DataFrame, weights: np.ndarray, text="text") -> Column:
    """The column of scores, from 0 to 1, for the texts of `docs`; null and empty texts get the prior."""
    small_batches(docs)
    sent = docs.sparkSession.sparkContext.broadcast(weights)
    bits = (len(weights) - 1).bit_length() - 1

    @F.arrow_udf("double")
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        hashes = WordHashes()
        for batch in batches:
            yield pa.array([score(t, sent.value, hashes, bits) for t in texts(batch)], pa.float64())

    return scored(F.col(text))


def score_documents(docs: DataFrame, labels: DataFrame, doc_id="doc_id", text="text", label="quality", threshold: float = REJECT_BELOW, **options) -> DataFrame:
    """`doc_id, held_out, score, predicted` of every row; only the text decides a score.

    Null ids are scored like others and count as not held out. Rows that repeat get equal scores; of a
    labelled id with several texts one is learned from. A very long text is scored whole, by one task; null
    and empty texts get the prior. No rows, no scores.
    """
    weights = train_model(docs, labels, doc_id, text, label, **options)
    scored = docs.select(F.col(doc_id).alias("doc_id"), held_out(F.col(doc_id)).alias("held_out"), quality_score(docs, weights, text).alias("score"))
    return scored.withColumn("predicted", F.when(F.col("score") >= threshold, 1).otherwise(0))


def accepted(docs: DataFrame, labels: DataFrame, text="text", threshold: float = REJECT_BELOW, **options) -> DataFrame:
    """The rows of `docs` whose score reaches the threshold, with their own columns."""
    weights = train_model(docs, labels, text=text, **options)
    return docs.where(quality_score(docs, weights, text) >= threshold)
