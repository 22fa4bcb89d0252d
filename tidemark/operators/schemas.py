"""Schemas of every table, in column order, and the check that a DataFrame keeps to its schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


_TYPES = {
    "STRING": T.StringType(),
    "INT": T.IntegerType(),
    "BIGINT": T.LongType(),
    "BOOLEAN": T.BooleanType(),
    "DATE": T.DateType(),
    "TIMESTAMP_NTZ": T.TimestampNTZType(),
    "ARRAY<DOUBLE>": T.ArrayType(T.DoubleType()),
    # Order of arrival: the file, the block of it one task reads, and the position in that.
    "ORDINAL": T.StructType(
        [T.StructField("file", T.StringType()), T.StructField("block", T.LongType()), T.StructField("pos", T.LongType())]
    ),
}


def _schema(columns: str) -> T.StructType:
    """A schema from 'name TYPE, ...'; unlike `StructType.fromDDL` it needs no running session."""
    pairs = [column.split(" ") for column in columns.split(", ")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


BRONZE = _schema(
    "_source STRING, _batch_id STRING, _ingested_at TIMESTAMP_NTZ, _kafka_partition INT, "
    "_kafka_offset BIGINT, _op STRING, _payload STRING"
)
TABLES = {
    "stage_ticket_changes": _schema(
        "ticket_id STRING, _op STRING, _lsn BIGINT, _changed_at TIMESTAMP_NTZ, user_id STRING, subject STRING, "
        "body STRING, priority STRING, status STRING, category STRING, created_at TIMESTAMP_NTZ, "
        "updated_at TIMESTAMP_NTZ, _batch_id STRING, _ingested_at TIMESTAMP_NTZ, _kafka_offset BIGINT"
    ),
    "stage_events": _schema(
        "event_id STRING, user_id STRING, ticket_id STRING, type STRING, rating STRING, page STRING, "
        "event_time TIMESTAMP_NTZ, reason STRING, _ingested_at TIMESTAMP_NTZ, _batch_id STRING, "
        "_kafka_partition INT, _kafka_offset BIGINT, _payload STRING, unread STRING"
    ),
    "lateness_counts": _schema("lateness_days INT, n BIGINT"),
    "silver_tickets": _schema(
        "ticket_id STRING, user_id STRING, subject STRING, body STRING, priority STRING, status STRING, "
        "category STRING, created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ, is_deleted BOOLEAN, "
        "_lsn BIGINT, _batch_id STRING"
    ),
    "silver_ticket_history": _schema(
        "ticket_id STRING, priority STRING, status STRING, category STRING, is_deleted BOOLEAN, "
        "valid_from TIMESTAMP_NTZ, valid_to TIMESTAMP_NTZ, is_current BOOLEAN, _lsn BIGINT, "
        "_generation BIGINT"
    ),
    "training_state": _schema(
        "ticket_id STRING, _op STRING, subject STRING, body STRING, status STRING, category STRING, "
        "created_at TIMESTAMP_NTZ, _lsn BIGINT, _ingested_at TIMESTAMP_NTZ, _kafka_offset BIGINT, was_created BOOLEAN, "
        "created_priority STRING, created_lsn BIGINT, created_ingested_at TIMESTAMP_NTZ, created_offset BIGINT, "
        "got_negative_feedback BOOLEAN"
    ),
    "silver_events": _schema(
        "event_id STRING, user_id STRING, ticket_id STRING, type STRING, rating STRING, page STRING, "
        "event_time TIMESTAMP_NTZ, _ingested_at TIMESTAMP_NTZ, _batch_id STRING"
    ),
    "quarantine_events": _schema(
        "_batch_id STRING, _kafka_partition INT, _kafka_offset BIGINT, event_id STRING, reason STRING, "
        "_payload STRING"
    ),
    "silver_transcripts": _schema(
        "ticket_id STRING, exported_at TIMESTAMP_NTZ, n_turns INT, text STRING, _batch_id STRING"
    ),
    "gold_feature_daily": _schema(
        "user_id STRING, event_date DATE, n_events BIGINT, n_clicks BIGINT, n_feedback_up BIGINT, "
        "n_feedback_down BIGINT"
    ),
    "gold_training_set": _schema(
        "snapshot_version STRING, ticket_id STRING, text STRING, label STRING, priority_at_creation STRING, "
        "got_negative_feedback BOOLEAN, created_date DATE"
    ),
    "embedding_cache": _schema("text_hash STRING, model_version STRING, embedding ARRAY<DOUBLE>"),
    "gold_doc_chunks": _schema(
        "ticket_id STRING, chunk_idx INT, chunk_text STRING, text_hash STRING, embedding_model_version STRING, "
        "embedding ARRAY<DOUBLE>, category STRING, priority STRING, status STRING, "
        "_generation BIGINT, _gone BOOLEAN"
    ),
    "answer_cache": _schema("input_hash STRING, model STRING, prompt_version STRING, answer STRING"),
    "gold_ticket_labels": _schema("ticket_id STRING, label STRING, model STRING, prompt_version STRING"),
    "llm_label_quarantine": _schema(
        "ticket_id STRING, answer STRING, reason STRING, model STRING, prompt_version STRING"
    ),
    "bronze_agent_spans": _schema(
        "trace_id STRING, span_id STRING, parent_id STRING, name STRING, depth INT, duration_ms BIGINT, "
        "status STRING, model STRING, input_tokens BIGINT, output_tokens BIGINT, tool_name STRING, "
        "user_input STRING, agent_output STRING, error_type STRING, split STRING, attributes_json STRING, "
        "trace_ord ORDINAL"
    ),
}
GOLD_TABLES = ("gold_feature_daily", "gold_training_set", "gold_doc_chunks")


class ContractError(ValueError):
    """A DataFrame does not have the columns and types its table promises."""


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """`df` with its columns in schema order; an error on any missing, extra or differently typed one."""
    got = {f.name: f.dataType for f in df.schema.fields}
    want = {f.name: f.dataType for f in schema.fields}
    wrong = [f"{n}: want {want.get(n)}, got {got.get(n)}" for n in sorted({*got, *want}) if not _same(got.get(n), want.get(n))]
    if wrong:
        raise ContractError("; ".join(wrong))
    return df.select(*[F.col(f"`{n}`") for n in want])


def _same(a: T.DataType | None, b: T.DataType | None) -> bool:
    # Whether a value may be null is not part of the contract.
    return a is not None and b is not None and a.simpleString() == b.simpleString()
