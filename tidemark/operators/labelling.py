"""Labelling: ask only what was never asked, keep every answer, let only valid labels through."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.labels import PRICE_PER_1K_TOKENS, keyword_answer, parse_label, prompt, token_estimate
from tidemark.functions.text import text_hash
from tidemark.operators.keyed import unseen

# The model that answers and the version of its prompt.
MODEL = "fake-llm-2026-09"
PROMPT_VERSION = "triage-v1"

# A labeller takes rows (input_hash, text, prompt) and returns rows (input_hash, answer).
Labeller = Callable[[DataFrame], DataFrame]


def live_ticket_texts(tickets: DataFrame) -> DataFrame:
    """Text to label per live ticket. A null subject or body makes the whole text null."""
    text = F.concat("subject", F.lit(". "), "body")
    return tickets.where(~F.col("is_deleted")).select("ticket_id", text.alias("text"))


def label_cost(texts: DataFrame, price: float = PRICE_PER_1K_TOKENS) -> DataFrame:
    """Tokens and price of labelling every text once, from the prompts alone."""
    tokens = token_estimate(prompt(F.coalesce("text", F.lit(""))))
    total = texts.agg(F.count(F.lit(1)).alias("n_texts"), F.coalesce(F.sum(tokens), F.lit(0)).alias("n_tokens"))
    return total.select("n_texts", "n_tokens", F.round(F.col("n_tokens") / 1000 * price, 6).alias("usd"))


def with_input_hash(texts: DataFrame) -> DataFrame:
    return texts.withColumn("input_hash", text_hash(F.col("text")))


def unanswered(
    texts: DataFrame,
    cache: DataFrame,
    model: str = MODEL,
    prompt_version: str = PROMPT_VERSION,
    at_most: int | None = None,
) -> DataFrame:
    """The distinct inputs without a cached answer of this model and prompt version.

    `at_most` is a bound on the number of texts, if known; few texts spare the cache its shuffle.
    """
    asked = cache.where((F.col("model") == model) & (F.col("prompt_version") == prompt_version))
    inputs = with_input_hash(texts).where(F.col("text").isNotNull())
    distinct = inputs.groupBy("input_hash").agg(F.min("text").alias("text"))
    fresh = unseen(asked, distinct, "input_hash", at_most)
    return fresh.withColumn("prompt", prompt(F.col("text")))


def keyword_labeller(inputs: DataFrame) -> DataFrame:
    """The built-in labeller: keyword rules as column functions."""
    return inputs.select("input_hash", keyword_answer(F.col("text")).alias("answer"))


def answers(inputs: DataFrame, labeller: Labeller, model: str, prompt_version: str) -> DataFrame:
    """Fresh answers as rows of the answer cache."""
    return labeller(inputs).select(
        "input_hash", F.lit(model).alias("model"), F.lit(prompt_version).alias("prompt_version"), "answer"
    )


def judged(texts: DataFrame, cache: DataFrame, model: str = MODEL, prompt_version: str = PROMPT_VERSION) -> DataFrame:
    """Every text with its cached answer and the label read from it, null when the answer is unusable."""
    current = cache.where((F.col("model") == model) & (F.col("prompt_version") == prompt_version))
    joined = with_input_hash(texts).join(current.select("input_hash", "answer"), "input_hash", "left")
    return joined.select(
        "ticket_id",
        "answer",
        parse_label(F.col("answer")).alias("label"),
        F.lit(model).alias("model"),
        F.lit(prompt_version).alias("prompt_version"),
    )


def gold_labels(judged_rows: DataFrame) -> DataFrame:
    return judged_rows.where(F.col("label").isNotNull()).select("ticket_id", "label", "model", "prompt_version")


def quarantined_labels(judged_rows: DataFrame) -> DataFrame:
    bad = judged_rows.where(F.col("label").isNull())
    reason = F.when(F.col("answer").isNull(), F.lit("no answer")).otherwise(F.lit("answer has no allowed label"))
    return bad.select("ticket_id", "answer", reason.alias("reason"), "model", "prompt_version")
