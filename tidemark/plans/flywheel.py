"""Agent traces to training data: spans, eval set, clean preference pairs, feature parity."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import features, traces
from tidemark.operators.schemas import TABLES, conform
from tidemark.sources.documents import read_trace_export, read_trace_lines, write_jsonl


def flywheel(spark: SparkSession, trace_path: str, out: str, events: DataFrame, history: DataFrame) -> dict:
    """Land the spans of a trace export below `out`, write both data sets, and count leaking rows.

    `events` are (user_id, event_ts, ...), `history` (user_id, valid_from, lifetime_spend).
    """
    spans_path = f"{out}/bronze_agent_spans"
    read = read_trace_lines if trace_path.endswith(".jsonl") else read_trace_export
    flat = traces.flatten_spans(read(spark, trace_path))
    conform(flat, TABLES["bronze_agent_spans"]).write.parquet(spans_path)
    spans = spark.read.schema(TABLES["bronze_agent_spans"]).parquet(spans_path)
    held_out = traces.eval_set(spans)
    pairs = traces.preference_pairs(spans)
    clean = traces.decontaminate(pairs, held_out)
    return {
        "n_spans": spans.count(),
        "n_traces": traces.trace_summary(spans).count(),
        "n_eval": write_jsonl(held_out, f"{out}/eval_golden"),
        "n_pairs_raw": pairs.count(),
        "n_pref": write_jsonl(clean, f"{out}/preference_pairs"),
        "leaks": feature_leaks(events, history),
    }


def feature_leaks(events: DataFrame, history: DataFrame) -> int:
    """Rows for which the all-time join shows more than the point-in-time join."""
    right = history.withColumnRenamed("lifetime_spend", "spend_at_event")
    known = features.asof_join(events, right, ["user_id"], "event_ts", "valid_from", ["spend_at_event"])
    both = features.leaky_join(known, history, ["user_id"], "lifetime_spend", "spend_leaky")
    return features.leak_count(both.select(F.col("spend_at_event"), F.col("spend_leaky")), "spend_at_event", "spend_leaky").first()[0]
