"""Labelling over conversation turns and documents: cost, fresh inputs, labels, quarantine."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.labels import PROMPT_HEAD, keyword_answer, parse_label
from tidemark.operators import labelling
from tidemark.operators.schemas import TABLES
from tidemark.queries.inputs import table
from tidemark.queries.registry import Registry

registry = Registry()
_PROMPT = PROMPT_HEAD.replace("'", "''")

# Keyword rules for the invented prose of the given tables; the first answer is off-schema on purpose.
RULES = (
    ("queaux|schaft", 'Sure! Here is the label: {"label": "export"}'),
    ("the|und", '{"label": "bug"}'),
    ("tion|keit", '{"label": "billing"}'),
)
DEFAULT = '{"label": "other"}'
_ANSWER_SQL = (
    "CASE "
    + " ".join(f"WHEN regexp_matches(lower(text), '{pattern}') THEN '{answer}'" for pattern, answer in RULES)
    + f" ELSE '{DEFAULT}' END"
)
_TEXT_SQL = "SELECT 'C-' || conv_id || '-' || turn AS ticket_id, role || '. ' || text AS text FROM conversations"
_LABEL_SQL = f"""
SELECT ticket_id, answer, CASE WHEN l IN ('bug', 'billing', 'other') THEN l END AS label
FROM (SELECT ticket_id, answer, regexp_extract(answer, '"label": "(\\w+)"', 1) AS l
      FROM (SELECT ticket_id, {_ANSWER_SQL} AS answer FROM ({_TEXT_SQL})))
"""


def _tickets(spark: SparkSession, sf: str) -> DataFrame:
    """Every turn as a ticket: its role the subject, its text the body."""
    return table(spark, sf, "conversations").select(
        F.concat_ws("-", F.lit("C"), "conv_id", "turn").alias("ticket_id"),
        F.col("role").alias("subject"),
        F.col("text").alias("body"),
        F.lit(False).alias("is_deleted"),
    )


def _texts(spark: SparkSession, sf: str) -> DataFrame:
    return labelling.live_ticket_texts(_tickets(spark, sf))


def _labeller(inputs: DataFrame) -> DataFrame:
    return inputs.select("input_hash", keyword_answer(F.col("text"), RULES, DEFAULT).alias("answer"))


def _answered(texts: DataFrame) -> DataFrame:
    empty = texts.sparkSession.createDataFrame([], TABLES["answer_cache"])
    fresh = labelling.unanswered(texts, empty)
    return labelling.answers(fresh, _labeller, labelling.MODEL, labelling.PROMPT_VERSION)


def _judged(spark: SparkSession, sf: str) -> DataFrame:
    texts = _texts(spark, sf)
    return labelling.judged(texts, _answered(texts))


@registry.query(f"SELECT ticket_id, label, 'fake-llm-2026-09' AS model, 'triage-v1' AS prompt_version FROM ({_LABEL_SQL}) WHERE label IS NOT NULL")
def ticket_labels(spark: SparkSession, sf: str) -> DataFrame:
    """Labels read from cached answers; only allowed ones."""
    return labelling.gold_labels(_judged(spark, sf))


@registry.query(f"SELECT ticket_id, answer, 'answer has no allowed label' AS reason FROM ({_LABEL_SQL}) WHERE label IS NULL")
def ticket_labels_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    return labelling.quarantined_labels(_judged(spark, sf)).select("ticket_id", "answer", "reason")


@registry.query(f"""
SELECT count(*) AS n_texts, CAST(sum(n) AS BIGINT) AS n_tokens, round(CAST(sum(n) AS DOUBLE) / 1000 * 0.002, 6) AS usd
FROM (SELECT len(list_filter(regexp_split_to_array('{_PROMPT}' || text, '\\s+'), lambda w: w <> '')) + 8 AS n FROM ({_TEXT_SQL}))""")
def label_cost(spark: SparkSession, sf: str) -> DataFrame:
    return labelling.label_cost(_texts(spark, sf))


@registry.query(f"""
SELECT DISTINCT sha256(text) AS input_hash, text, '{_PROMPT}' || text AS prompt FROM ({_TEXT_SQL})
WHERE text NOT IN (SELECT text FROM ({_TEXT_SQL}) WHERE text LIKE 'user. %')""")
def label_cache_misses(spark: SparkSession, sf: str) -> DataFrame:
    """Inputs still to be asked when the user turns are answered already."""
    texts = _texts(spark, sf)
    cache = _answered(texts.where(F.col("text").startswith("user. ")))
    return labelling.unanswered(texts, cache)


@registry.query(f"SELECT count(*) AS n_calls FROM (SELECT DISTINCT text FROM ({_TEXT_SQL}))")
def label_new_prompt_version(spark: SparkSession, sf: str) -> DataFrame:
    """A new prompt version asks every distinct input again."""
    texts = _texts(spark, sf)
    fresh = labelling.unanswered(texts, _answered(texts), prompt_version="triage-v2")
    return fresh.agg(F.count(F.lit(1)).alias("n_calls"))


@registry.query("SELECT CAST(0 AS BIGINT) AS n_calls FROM (SELECT count(*) FROM conversations)")
def label_rerun(spark: SparkSession, sf: str) -> DataFrame:
    """The same model and prompt version asks nothing."""
    texts = _texts(spark, sf)
    return labelling.unanswered(texts, _answered(texts)).agg(F.count(F.lit(1)).alias("n_calls"))


@registry.query("""
SELECT doc_id, CASE WHEN contains(text, '{') THEN NULL WHEN lang IN ('en', 'de') THEN 'bug' WHEN lang = 'fr' THEN 'other' END AS label
FROM documents""")
def parse_labels(spark: SparkSession, sf: str) -> DataFrame:
    """Labels read from chatty answers around whole documents: valid, unknown and broken ones.

    The object is taken from the first '{' to the last '}', so a text with a brace of its own spoils it.
    """
    docs = table(spark, sf, "documents")
    tail = (
        F.when(F.col("lang") == "en", '{"label": "bug"}')
        .when(F.col("lang") == "de", '{"why": {"a": 1},\n "label": "bug"}')
        .when(F.col("lang") == "fr", '{"label": "other"} done')
        .otherwise('{"label": bug}')
    )
    return docs.select("doc_id", parse_label(F.concat("text", F.lit("\n"), tail)).alias("label"))
