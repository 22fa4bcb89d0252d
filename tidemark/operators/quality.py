"""The event gate, table tests, the PII scan and the profile of raw records."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.records import once
from tidemark.functions.text import has_pii
from tidemark.functions.times import from_event_time

# The reasons a record is refused for.
MISSING = "Field required"
NOT_TEXT = "Input should be a valid string"
TOO_SHORT = "String should have at least 1 character"
NOT_TYPE = "Input should be 'click' or 'feedback'"
NOT_RATING = "Input should be 'up' or 'down'"
NOT_TIME = "Input should be a valid datetime"
NEEDS_RATING = "Value error, feedback event needs rating up/down"
HAS_RATING = "Value error, click event must not carry a rating"
NOT_OBJECT = "value is not an object"
NOT_JSON = "not valid JSON"
NOT_RECORD = "not one record"

_FIELDS = ("event_id", "user_id", "ticket_id", "type", "rating", "page", "event_time")


_VALUE = f"struct<{', '.join(f'{field}: variant' for field in _FIELDS)}>"


def _facts(record: Column, value: Column) -> Column:
    """What the rules ask about a parsed record and the fields of its value: of every field its text and its JSON type.

    The type is 'STRING', 'VOID' for a JSON null and so on; null means the field is absent.
    """
    # The type of the whole value is only asked for where it cannot be an object with an id.
    no_id = value["event_id"].isNull()
    is_record = F.when(no_id, F.schema_of_variant(record).startswith("OBJECT"))
    kind = F.when(no_id, F.schema_of_variant(F.try_variant_get(record, "$.value", "variant")))
    facts = [record.isNotNull().alias("is_json"), is_record.alias("is_record"), kind.alias("value_kind")]
    for field in _FIELDS:
        facts.append(F.try_variant_get(value[field], "$", "string").alias(field))
        facts.append(F.schema_of_variant(value[field]).alias(f"{field}_kind"))
    return F.struct(*facts)


def _kind(field: str) -> Column:
    return F.col(f"{field}_kind")


def _fail(field: str, bad: Column, message: str) -> Column:
    return F.when(bad, F.lit(f"{field}: {message}"))


def _required_text(field: str) -> list[Column]:
    return [
        _fail(field, _kind(field).isNull(), MISSING),
        _fail(field, _kind(field) != "STRING", NOT_TEXT),
        _fail(field, F.col(field) == "", TOO_SHORT),
    ]


def _optional_text(field: str) -> Column:
    return _fail(field, ~_kind(field).isin("STRING", "VOID"), NOT_TEXT)


def _one_of(field: str, values: Sequence[str], message: str) -> Column:
    return _fail(field, (_kind(field) != "STRING") | ~F.col(field).isin(*values), message)


def _reason() -> Column:
    """The first rule a record breaks, rules in field order; null when it keeps all of them."""
    has_rating = F.coalesce(_kind("rating") != "VOID", F.lit(False))
    no_object = ~F.col("value_kind").startswith("OBJECT") & (F.col("value_kind") != "VOID")
    return F.coalesce(
        _fail("record", ~F.col("is_json"), NOT_JSON),
        _fail("record", ~F.col("is_record"), NOT_RECORD),
        _fail("record", no_object, NOT_OBJECT),
        *_required_text("event_id"),
        *_required_text("user_id"),
        _optional_text("ticket_id"),
        _fail("type", _kind("type").isNull(), MISSING),
        _one_of("type", ("click", "feedback"), NOT_TYPE),
        F.when(has_rating, _one_of("rating", ("up", "down"), NOT_RATING)),
        _optional_text("page"),
        _fail("event_time", _kind("event_time").isNull(), MISSING),
        _fail("event_time", F.col("_time").isNull(), NOT_TIME),
        _fail("record", (F.col("type") == "feedback") & ~has_rating, NEEDS_RATING),
        _fail("record", (F.col("type") == "click") & has_rating, HAS_RATING),
    )


def _taken_apart(bronze: DataFrame) -> DataFrame:
    """Event records with what the rules ask about them, each parsed, taken apart and its time read once."""
    read = bronze.select("*", once(F.try_parse_json("_payload")).alias("j"))
    opened = read.select("*", once(F.try_variant_get("j", "$.value", _VALUE)).alias("v"))
    asked = opened.select(*bronze.columns, once(_facts(F.col("j"), F.col("v"))).alias("f")).select(*bronze.columns, "f.*")
    return asked.select("*", once(from_event_time(F.col("event_time"))).alias("_time"))


def _gated() -> list[Column | str]:
    fields = [f for f in _FIELDS if f != "event_time"]
    return [*fields, F.col("_time").alias("event_time"), _reason().alias("reason"), "_ingested_at", "_batch_id", "_kafka_partition", "_kafka_offset", "_payload"]


def gate_events(bronze: DataFrame) -> DataFrame:
    """Event records with their fields typed and `reason` set where a rule is broken.

    One narrow pass that parses a record once, takes its fields apart once and reads its time once. A bad
    record never stops the run; fields not named by the rules are ignored.
    """
    return _taken_apart(bronze).select(*_gated())


def staged_events(bronze: DataFrame) -> DataFrame:
    """Gated events as they are stored: with the raw record of refused ones only.

    `unread` is null where the time is a text, a whole number or null, which the gate reads as any other reader does.
    Else it is the raw record, for `features.staged_lateness`, or '' if that is kept as refused.
    """
    read = F.coalesce(_kind("event_time").isin("STRING", "BIGINT", "VOID"), F.lit(False))
    refused = F.col("reason").isNotNull()
    gated = _taken_apart(bronze).select(*_gated(), read.alias("_read"))
    unread = F.when(~F.col("_read"), F.when(refused, "").otherwise(F.col("_payload")))
    return gated.withColumn("unread", unread).withColumn("_payload", F.when(refused, F.col("_payload"))).drop("_read")


def valid_events(gated: DataFrame) -> DataFrame:
    return gated.where(F.col("reason").isNull()).drop("reason", "_payload")


def quarantined_events(gated: DataFrame) -> DataFrame:
    bad = gated.where(F.col("reason").isNotNull())
    return bad.select("_batch_id", "_kafka_partition", "_kafka_offset", "event_id", "reason", "_payload")


def passing_events(typed: DataFrame) -> DataFrame:
    """The same rules as one predicate over already typed event columns; failing rows are dropped."""
    return typed.where(
        (F.coalesce("event_id", F.lit("")) != "")
        & (F.coalesce("user_id", F.lit("")) != "")
        & F.col("event_time").isNotNull()
        & (
            ((F.col("type") == "click") & F.col("rating").isNull())
            | ((F.col("type") == "feedback") & F.col("rating").isin("up", "down"))
        )
    )


def table_tests(
    df: DataFrame,
    not_null: Sequence[str] = (),
    accepted: Mapping[str, Sequence] | None = None,
    unique: Sequence[Sequence[str]] = (),
) -> DataFrame:
    """(`rule`, `violations`) per rule.

    Null and value rules share one scan. A uniqueness rule counts key values that occur more than
    once, so a key with any number of copies arrives at one task as one partial count per map task.
    """
    checks = {f"not_null({c})": F.col(c).isNull() for c in not_null}
    checks |= {f"accepted_values({c})": ~F.col(c).isin(*values) for c, values in (accepted or {}).items()}
    results = []
    if checks:
        counts = df.agg(*[F.count_if(bad).alias(f"c{n}") for n, bad in enumerate(checks.values())])
        pairs = [F.struct(F.lit(rule).alias("rule"), F.col(f"c{n}").alias("violations")) for n, rule in enumerate(checks)]
        results.append(counts.select(F.inline(F.array(*pairs))))
    for columns in unique:
        repeated = repeated_keys(df, columns, "_copies")
        results.append(repeated.agg(F.lit(f"unique({', '.join(columns)})").alias("rule"), F.count(F.lit(1)).alias("violations")))
    return reduce(DataFrame.unionByName, results)


def repeated_keys(df: DataFrame, columns: Sequence[str], name: str = "n") -> DataFrame:
    """Every combination of `columns` that occurs more than once, with its count as `name`."""
    counted = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_copies")).where(F.col("_copies") > 1)
    return counted.withColumnRenamed("_copies", name)


def pii_scan(texts: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """(`source`, `n_texts`, `n_leaks`) over the text columns of several tables."""
    parts = [df.select(F.lit(name).alias("source"), F.col(column).alias("text")) for name, (df, column) in texts.items()]
    # A null text counts for neither; filtering it out would evaluate a computed text once more.
    every = reduce(DataFrame.unionByName, parts)
    return every.groupBy("source").agg(F.count("text").alias("n_texts"), F.count_if(has_pii(F.col("text"))).alias("n_leaks"))


def _unreadable(record: Column) -> Column:
    """Why a parsed record is none, or null: it is no JSON, or no object."""
    kind = F.schema_of_variant(record)
    return F.when(record.isNull(), NOT_JSON).when(~kind.startswith("OBJECT"), NOT_RECORD)


def unreadable_records(bronze: DataFrame) -> DataFrame:
    """Landed records that are no JSON object, with `reason`; nothing else is done with them."""
    read = bronze.select("*", once(F.try_parse_json("_payload")).alias("j"))
    judged = read.select("*", once(_unreadable(F.col("j"))).alias("reason")).where(F.col("reason").isNotNull())
    return judged.select("_source", "_batch_id", "reason", "_payload")


def bronze_profile(bronze: DataFrame) -> DataFrame:
    """Records, those that cannot be read, tombstones (read, but without an operation) and redeliveries
    (same partition and offset again)."""
    read = bronze.select("*", once(F.try_parse_json("_payload")).alias("j"))
    judged = read.select("*", once(_unreadable(F.col("j")).isNotNull()).alias("bad"))
    place = F.when(~F.col("bad"), F.struct("_kafka_partition", "_kafka_offset"))
    return judged.agg(
        F.count(F.lit(1)).alias("n_records"),
        F.count_if("bad").alias("n_unreadable"),
        F.count_if(F.col("_op").isNull() & ~F.col("bad")).alias("n_tombstones"),
        (F.count_if(~F.col("bad")) - F.count_distinct(place)).alias("n_redeliveries"),
    )
