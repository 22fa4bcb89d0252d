"""Span trees of documents: flattening, rollup, eval and preference sets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import traces
from tidemark.queries.inputs import TURN_SQL, answer_turns, document_trees
from tidemark.queries.registry import Registry

registry = Registry()

_LINES = """
SELECT doc_id, lang, source, n_chars, text, i - 1 AS i, lines[i] AS line
FROM (SELECT *, string_split(text, chr(10)) AS lines, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM documents)
"""
_SPANS = f"""
SELECT 'd' || doc_id AS trace_id, 'd' || doc_id AS span_id, '' AS parent_id, 'document' AS name, 0 AS depth,
       n_chars AS duration_ms, CASE WHEN lang = 'en' THEN 'ok' ELSE 'error' END AS status, source AS model,
       0 AS input_tokens, 0 AS output_tokens, text AS user_input, lang AS agent_output
FROM documents
UNION ALL
SELECT 'd' || doc_id, 'd' || doc_id || '.' || i, 'd' || doc_id, 'line', 1, 0,
       CASE WHEN line = '' THEN 'error' ELSE 'ok' END, '', length(line), 0, NULL, NULL
FROM ({_LINES})
UNION ALL
SELECT 'd' || doc_id, 'd' || doc_id || '.' || i || '.' || (j - 1), 'd' || doc_id || '.' || i, 'sentence', 2, 0,
       'ok', '', 0, length(parts[j]), NULL, NULL
FROM (SELECT *, string_split(line, '. ') AS parts, unnest(range(1, len(string_split(line, '. ')) + 1)) AS j FROM ({_LINES}))
"""


@registry.query(f"""
SELECT trace_id, span_id, parent_id, name, CAST(depth AS INTEGER) AS depth, CAST(duration_ms AS BIGINT) AS duration_ms, status, model,
       CAST(input_tokens AS BIGINT) AS input_tokens, CAST(output_tokens AS BIGINT) AS output_tokens
FROM ({_SPANS})""")
def span_flatten(spark: SparkSession, sf: str) -> DataFrame:
    """One row per span of trees built from whole documents."""
    spans = traces.flatten_spans(document_trees(spark, sf))
    none = F.lit("")
    return spans.select(
        "trace_id", "span_id", F.coalesce("parent_id", none).alias("parent_id"), "name", "depth", "duration_ms", "status",
        F.coalesce("model", none).alias("model"),
        F.coalesce("input_tokens", F.lit(0)).alias("input_tokens"), F.coalesce("output_tokens", F.lit(0)).alias("output_tokens"),
    )


@registry.query(f"""
SELECT trace_id, max(user_input) AS user_input, max(agent_output) AS agent_output,
       max(CASE WHEN depth = 0 THEN status END) AS outcome, CAST(sum(input_tokens + output_tokens) AS BIGINT) AS total_tokens,
       CAST(max(CASE WHEN depth = 0 THEN duration_ms END) AS BIGINT) AS latency_ms, count(*) AS n_spans
FROM ({_SPANS}) GROUP BY trace_id""")
def trace_summary(spark: SparkSession, sf: str) -> DataFrame:
    return traces.trace_summary(traces.flatten_spans(document_trees(spark, sf)))


def _spans(spark: SparkSession, sf: str) -> DataFrame:
    """Questions and answers are in the roots, so no tree is walked."""
    return traces.root_spans(answer_turns(spark, sf))


EVAL_SQL = f"SELECT trace_id, user_input AS input, agent_output AS reference FROM ({TURN_SQL}) WHERE status = 'ok' AND split = 'eval'"


@registry.query(EVAL_SQL)
def eval_set(spark: SparkSession, sf: str) -> DataFrame:
    return traces.eval_set(_spans(spark, sf))


_PAIRS = f"""
SELECT prompt, arg_min(agent_output, doc_id) FILTER (WHERE status = 'ok') AS chosen,
       arg_min(agent_output, doc_id) FILTER (WHERE status <> 'ok') AS rejected
FROM ({TURN_SQL}) GROUP BY prompt HAVING bool_or(status = 'ok') AND bool_or(status <> 'ok')
"""


@registry.query(_PAIRS)
def preference_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Prompts answered well and badly, with the first answer of either kind."""
    return traces.preference_pairs(_spans(spark, sf))


CLEAN_PAIRS_SQL = f"""
SELECT * FROM ({_PAIRS}) WHERE prompt NOT IN (SELECT prompt FROM ({TURN_SQL}) WHERE status = 'ok' AND split = 'eval')"""


@registry.query(CLEAN_PAIRS_SQL)
def decontaminate(spark: SparkSession, sf: str) -> DataFrame:
    """Preference pairs without those whose prompt is an eval input."""
    spans = _spans(spark, sf)
    return traces.decontaminate(traces.preference_pairs(spans), traces.eval_set(spans))


@registry.query(f"""
SELECT * FROM ({_PAIRS}) WHERE prompt NOT IN (SELECT trim(regexp_replace(lower(text), '\\s+', ' ', 'g')) FROM benchmark)""")
def decontaminate_benchmark(spark: SparkSession, sf: str) -> DataFrame:
    """The same against the benchmark items as held-out inputs."""
    held_out = spark.read.parquet(f"{sf}/benchmark.parquet").select(F.col("text").alias("input"))
    return traces.decontaminate(traces.preference_pairs(_spans(spark, sf)), held_out)
