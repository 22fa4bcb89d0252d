"""Small helpers the operators share: words as bytes, 64-bit mixing, tables, Arrow batches."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.session import shared_folder

# Words of the contracts that speak of `[^\x20\x09-\x0D]+`.
WORD = r"[^\x20\x09-\x0D]+"
# A batch holds so many rows at most; a document may be long, and a worker holds a batch or two.
BATCH_ROWS = "256"
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_WORD_CACHE = 1_000_000


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def small_batches(df: DataFrame) -> DataFrame:
    """Bounds the rows of an Arrow batch for the session that runs `df`."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return df


# Short rows a task of a stored table has at least; a table known to be small is written in few files.
TASK_ROWS = 50_000


def store(df: DataFrame, rows: int | None = None, task_rows: int = TASK_ROWS) -> DataFrame:
    """Writes `df` to the shared folder and reads it back: computed once, and no lineage to lose.

    `checkpoint()` would compute its last stage twice. The folder belongs to the job, like checkpoint
    files, and goes with them. With `rows`, a bound of their number, a small `df` is written by as many tasks
    as have `task_rows` each, but at least two for each core, whatever number of partitions shuffles have.
    """
    spark = df.sparkSession
    if rows is not None:
        tasks = max(2 * spark.sparkContext.defaultParallelism, -(-rows // task_rows))
        if tasks < int(spark.conf.get("spark.sql.shuffle.partitions")):
            df = df.coalesce(tasks)
    folder = f"{shared_folder(spark)}/tidemark-{uuid.uuid4()}"
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def row_hash(*columns: Column) -> Column:
    """A 128-bit value as two longs: xxhash64 under two seeds."""
    return F.struct(F.xxhash64(*columns).alias("a"), F.xxhash64(F.lit("second"), *columns).alias("b"))


def texts(column: pa.Array) -> list[bytes]:
    """UTF-8 of each text; null counts as empty."""
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def mix64(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64: one good 64-bit hash of each value."""
    x = x + _GOLDEN
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """64-bit hashes of words; words seen before cost one look-up."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh64_intdigest(word)
        if len(self) >= _WORD_CACHE:
            self.clear()
        self[word] = value
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def ngrams(hashes: np.ndarray, n: int) -> np.ndarray:
    """One hash for each run of `n` words, in order; a text with fewer words, but some, is one run."""
    if len(hashes) == 0:
        return hashes
    n = min(n, len(hashes))
    out = np.full(len(hashes) - n + 1, np.uint64(n))
    for k in range(n):
        out = mix64(out ^ hashes[k : len(hashes) - n + 1 + k])
    return out


def chunks(items: Iterable, weight, limit: int) -> Iterator[list]:
    """Consecutive items in lists of about `limit` in total weight; a heavier item stands alone."""
    held, total = [], 0
    for item in items:
        w = weight(item)
        if held and total + w > limit:
            yield held
            held, total = [], 0
        held.append(item)
        total += w
    if held:
        yield held


def positions(rows: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """Adds `pos`, a row's place in its group from 0, and `n`, the group's rows; no group is gathered.

    Rows are sorted over all tasks, groups in a row, and stored with the place that each task gives them;
    the rows before a task's part of a group are summed over tasks. Group columns are never null. Equal
    rows part by their arrival, so that they are no hot key of the sort either.
    """
    arrived = rows.withColumn("_arrival", F.monotonically_increasing_id())
    ordered = arrived.orderBy(*group, *order, "_arrival").drop("_arrival").withColumn("_at", F.monotonically_increasing_id())
    placed = store(ordered).withColumn("_task", F.shiftright("_at", 33))
    parts = placed.groupBy(*group, "_task").agg(F.count(F.lit(1)).alias("_rows"), F.min("_at").alias("_first"))
    whole = Window.partitionBy(*group)
    before = whole.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("*", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"), F.sum("_rows").over(whole).alias("n"))
    found = placed.join(parts.drop("_rows"), [*group, "_task"])
    return found.withColumn("pos", F.col("_at") - F.col("_first") + F.col("_before")).drop("_at", "_task", "_first", "_before")
