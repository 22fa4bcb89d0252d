"""Line dedup: a line that many documents hold stays in one of them.

Texts are split into lines, each line's key is hashed, documents are counted per hash, and the lines
of keys found in too many documents go, but for the document with the smallest id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import row_hash

_BLANKS = " \t\n\x0b\x0c\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    """The line without blanks at both ends, ASCII letters in lower case."""
    return F.translate(F.btrim(line, F.lit(_BLANKS)), _UPPER, _LOWER)


def _keyed_lines(docs: DataFrame, doc_id: str, text: str, min_chars: int) -> DataFrame:
    """A row for each line long enough to count: document, place, 128-bit hash of its key."""
    keys = F.transform(lines_of(F.col(text)), line_key)
    lines = docs.where(F.col(doc_id).isNotNull()).select(
        F.col(doc_id).alias("doc"), F.xxhash64(text).alias("version"), F.posexplode(keys).alias("pos", "line")
    )
    return lines.where(F.length("line") >= min_chars).select("doc", "version", "pos", row_hash(F.col("line")).alias("hash"))


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_chars: int = 10, min_docs: int = 2) -> DataFrame:
    """Per row of `docs`: `doc_id`, `n_lines`, `n_dropped` and the `kept` text.

    Keys of at least `min_chars` code points found in at least `min_docs` documents lose all their
    lines except in the smallest `doc_id`, which keeps every line with the key. A null or empty text
    is one empty line. Rows sharing a `doc_id` are one document for the counts, and each row loses
    its own lines; rows without `doc_id` are returned whole and do not count. No documents, no rows.

    Documents are counted under (hash, document) first, so a line that a third of all documents hold
    is summed from partial counts; the join back is an equi-join that adaptive execution splits.
    """
    lines = _keyed_lines(docs, doc_id, text, min_chars)
    common = (
        lines.groupBy("hash")
        .agg(F.count_distinct("doc").alias("n_docs"), F.min("doc").alias("keeper"))
        .where(F.col("n_docs") >= min_docs)
    )
    dropped = (
        lines.join(common, "hash")
        .where(F.col("doc") != F.col("keeper"))
        # A set: the places of a row that is in the table twice come twice.
        .groupBy("doc", "version")
        .agg(F.sort_array(F.collect_set("pos")).alias("dropped"))
    )
    whole = docs.select(F.col(doc_id).alias("doc"), F.xxhash64(text).alias("version"), F.col(text).alias("text"))
    split = whole.join(dropped, ["doc", "version"], "left").select(
        F.col("doc").alias("doc_id"), lines_of(F.col("text")).alias("lines"), F.coalesce("dropped", F.array().cast("array<int>")).alias("dropped")
    )
    # Reassembled from the pieces between dropped places, so that the work is linear in the lines.
    ends = F.concat("dropped", F.array(F.size("lines")))
    pieces = F.expr(
        "flatten(transform(ends, (e, i) -> slice(lines, IF(i = 0, 1, ends[i - 1] + 2), IF(i = 0, e, e - ends[i - 1] - 1))))"
    )
    return split.withColumn("ends", ends).select(
        "doc_id",
        F.size("lines").cast("long").alias("n_lines"),
        F.size("dropped").cast("long").alias("n_dropped"),
        F.array_join(pieces, "\n").alias("kept"),
    )
