"""Token counts: an exact histogram of encoded lengths that answers every context limit.

Documents are encoded once and only their lengths are kept. Suffix sums over the histogram give, for
any limit, how many documents are longer, how many tokens remain when texts are cut at it, and which
share of documents fits, without another pass over the texts.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import small_batches

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# The pattern that byte-level vocabularies of this kind split a text with; fixed by the vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# Lengths are summed in blocks of so many, then over the blocks.
_BLOCK = 1024
_ENCODERS: dict = {}


def encoder(path: str, special: dict[str, int] | None = None):
    """The vocabulary at `path`, loaded once in each worker."""
    key = (path, tuple((special or {}).items()))
    if key not in _ENCODERS:
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        _ENCODERS[key] = tiktoken.Encoding("tidemark", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special or {})
    return _ENCODERS[key]


def encoded_lengths(docs: DataFrame, text: str = "text", tokenizer: str = TOKENIZER) -> DataFrame:
    """`n_tokens` of each row; a null text has none."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).encode_ordinary
        for batch in batches:
            lengths = [len(encode(t)) if t else 0 for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(lengths, pa.int64())], ["n_tokens"])

    return small_batches(docs).select(F.col(text).alias("text")).mapInArrow(count, "n_tokens long")


def length_histogram(lengths: DataFrame) -> DataFrame:
    """`n_tokens, n_docs`: a row for each length that occurs. Partial counts leave each task."""
    return lengths.groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n_docs"))


def limits(histogram: DataFrame) -> DataFrame:
    """For each length that occurs, as a context limit: what it keeps, cuts and covers.

    `n_docs` documents have exactly this length, `docs_up_to` at most this, `docs_over` more;
    `tokens_up_to` are the tokens of the documents that fit, `tokens_kept` those that remain if every
    text is cut at the limit, `quantile` the share of documents that fit. The smallest limit whose
    quantile is at least q is the q-quantile of lengths; the last row has the totals. Limits between
    two rows follow from the row below: `tokens_kept` grows by `docs_over` with each token more.
    An empty table has no rows.
    """
    rows = histogram.withColumn("block", F.floor(F.col("n_tokens") / _BLOCK)).withColumn("tokens", F.col("n_tokens") * F.col("n_docs"))
    # Blocks first: what is put in order in one task is a row per block, not per length.
    blocks = rows.groupBy("block").agg(F.sum("n_docs").alias("block_docs"), F.sum("tokens").alias("block_tokens"))
    later = Window.orderBy(F.col("block").desc()).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    blocks = blocks.select(
        "block",
        F.coalesce(F.sum("block_docs").over(later), F.lit(0)).alias("later_docs"),
        F.coalesce(F.sum("block_tokens").over(later), F.lit(0)).alias("later_tokens"),
        F.sum("block_docs").over(everything).alias("all_docs"),
        F.sum("block_tokens").over(everything).alias("all_tokens"),
    )
    suffix = Window.partitionBy("block").orderBy(F.col("n_tokens").desc()).rowsBetween(Window.unboundedPreceding, -1)
    over = rows.join(blocks, "block").select(
        "n_tokens", "n_docs", "all_docs", "all_tokens",
        (F.col("later_docs") + F.coalesce(F.sum("n_docs").over(suffix), F.lit(0))).alias("docs_over"),
        (F.col("later_tokens") + F.coalesce(F.sum("tokens").over(suffix), F.lit(0))).alias("tokens_over"),
    )
    fit, kept = F.col("all_docs") - F.col("docs_over"), F.col("all_tokens") - F.col("tokens_over")
    return over.select(
        F.col("n_tokens").alias("context_limit"), "n_docs", fit.alias("docs_up_to"), "docs_over", kept.alias("tokens_up_to"),
        (kept + F.col("docs_over") * F.col("n_tokens")).alias("tokens_kept"),
        (F.col("all_tokens") - kept - F.col("docs_over") * F.col("n_tokens")).alias("tokens_cut"), (fit / F.col("all_docs")).alias("quantile"),
    )


def token_counts(docs: DataFrame, text: str = "text", tokenizer: str = TOKENIZER) -> DataFrame:
    """`limits` over the encoded lengths of all rows, whole texts, each row counted."""
    return limits(length_histogram(encoded_lengths(docs, text, tokenizer)))


def answers(limit_rows: DataFrame, quantiles: list[float], context_limits: list[int]) -> DataFrame:
    """`kind, at, answer` for a few quantiles of lengths and truncated totals at a few limits."""
    q = limit_rows.select(
        F.explode(F.array(*[F.lit(float(x)) for x in quantiles])).alias("at"), "quantile", "context_limit"
    ).where(F.col("quantile") >= F.col("at")).groupBy("at").agg(F.min("context_limit").alias("answer")).select(F.lit("quantile").alias("kind"), "at", "answer")
    base = limit_rows.select(F.explode(F.array(*[F.lit(float(x)) for x in context_limits])).alias("at"), "*")
    below = base.where(F.col("context_limit") <= F.col("at")).groupBy("at").agg(
        F.max(F.struct("context_limit", (F.col("tokens_kept") + F.col("docs_over") * (F.col("at") - F.col("context_limit"))).alias("kept")))["kept"].cast("long").alias("answer")
    )
    first = base.groupBy("at").agg(F.min(F.struct("context_limit", (F.col("docs_over") + F.col("n_docs")).alias("docs")))["docs"].alias("docs"))
    total = first.join(below, "at", "left").select(F.lit("tokens_kept").alias("kind"), "at", F.coalesce("answer", (F.col("docs") * F.col("at")).cast("long")).alias("answer"))
    return q.unionByName(total)
