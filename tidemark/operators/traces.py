"""Agent traces: span trees as rows, the rollup per trace, eval and preference sets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import norm_text

# The tree is walked level by level; each level is spread over all tasks anew, so one huge trace is
# not one task's work.
_WALK = """
WITH RECURSIVE spans AS (
  SELECT trace_ord,
         coalesce(nullif(try_variant_get(root, '$.trace_id', 'string'), ''),
                  try_variant_get(root, '$.span_id', 'string')) AS trace_id,
         0 AS depth,
         root AS span
  FROM {roots}
  UNION ALL
  SELECT s.trace_ord, s.trace_id, s.depth + 1, c.value
  FROM spans s, LATERAL variant_explode(try_variant_get(s.span, '$.children', 'variant')) c
)
SELECT * FROM spans
"""


def _get(path: str, kind: str = "string") -> Column:
    return F.try_variant_get("span", path, kind)


def _attribute(name: str, kind: str = "string") -> Column:
    return _get(f'$.attributes["{name}"]', kind)


def root_spans(roots: DataFrame) -> DataFrame:
    """The first row `flatten_spans` has of every tree, without walking down."""
    trace = F.coalesce(F.nullif(F.try_variant_get("root", "$.trace_id", "string"), F.lit("")), F.try_variant_get("root", "$.span_id", "string"))
    return _typed(roots.select("trace_ord", trace.alias("trace_id"), F.lit(0).alias("depth"), F.col("root").alias("span")))


def flatten_spans(roots: DataFrame) -> DataFrame:
    """One row per span of every tree in `roots` (`trace_ord`, `root` variant), however deep.

    Children inherit the trace id of their root. `trace_ord` keeps the order of arrival.
    """
    return _typed(roots.sparkSession.sql(_WALK, roots=roots))


def _typed(spans: DataFrame) -> DataFrame:
    attributes = F.coalesce(F.to_json(_get("$.attributes", "variant")), F.lit("{}"))
    return spans.select(
        "trace_id",
        _get("$.span_id").alias("span_id"),
        _get("$.parent_id").alias("parent_id"),
        _get("$.name").alias("name"),
        "depth",
        F.coalesce(_get("$.duration_ms", "bigint"), F.lit(0).cast("bigint")).alias("duration_ms"),
        F.coalesce(_get("$.status"), F.lit("ok")).alias("status"),
        _attribute("gen_ai.request.model").alias("model"),
        _attribute("gen_ai.usage.input_tokens", "bigint").alias("input_tokens"),
        _attribute("gen_ai.usage.output_tokens", "bigint").alias("output_tokens"),
        _attribute("tool.name").alias("tool_name"),
        _attribute("input").alias("user_input"),
        _attribute("output").alias("agent_output"),
        _attribute("error.type").alias("error_type"),
        _attribute("split").alias("split"),
        attributes.alias("attributes_json"),
        "trace_ord",
    )


def trace_summary(spans: DataFrame) -> DataFrame:
    """Tokens, latency, outcome and size of every trace."""
    root = F.col("depth") == 0
    tokens = F.coalesce("input_tokens", F.lit(0)) + F.coalesce("output_tokens", F.lit(0))
    return spans.groupBy("trace_id").agg(
        F.max("user_input").alias("user_input"),
        F.max("agent_output").alias("agent_output"),
        F.max(F.when(root, F.col("status"))).alias("outcome"),
        F.sum(tokens).alias("total_tokens"),
        F.max(F.when(root, F.col("duration_ms"))).alias("latency_ms"),
        F.count(F.lit(1)).alias("n_spans"),
    )


def eval_set(spans: DataFrame) -> DataFrame:
    """Held-out successful turns: what the agent was asked and the reference answer."""
    held_out = spans.where(
        (F.col("depth") == 0)
        & (F.col("status") == "ok")
        & (F.col("split") == "eval")
        & F.col("user_input").isNotNull()
        & F.col("agent_output").isNotNull()
    )
    return held_out.select("trace_id", F.col("user_input").alias("input"), F.col("agent_output").alias("reference"))


def preference_pairs(spans: DataFrame) -> DataFrame:
    """Per normalised prompt asked with and without success: the first good and the first bad answer.

    One aggregation; of each prompt a map task sends two candidates at most.
    """
    asked = spans.where((F.col("depth") == 0) & F.col("user_input").isNotNull())
    turns = asked.select(
        norm_text(F.col("user_input")).alias("prompt"),
        F.coalesce(F.col("status") == "ok", F.lit(False)).alias("good"),
        "agent_output",
        "trace_ord",
    )
    good, bad = F.col("good"), ~F.col("good")
    first = lambda which: F.min_by("agent_output", F.when(which, F.col("trace_ord")))
    grouped = turns.groupBy("prompt").agg(
        first(good).alias("chosen"), first(bad).alias("rejected"), F.bool_or(good).alias("g"), F.bool_or(bad).alias("b")
    )
    return grouped.where("g AND b").select("prompt", "chosen", "rejected")


def decontaminate(pairs: DataFrame, held_out: DataFrame) -> DataFrame:
    """Pairs whose prompt is no eval input, both compared after normalisation."""
    inputs = held_out.select(norm_text(F.col("input")).alias("_key")).distinct()
    return pairs.join(inputs, norm_text(F.col("prompt")) == F.col("_key"), "left_anti")
