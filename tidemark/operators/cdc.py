"""Change-data-capture records: decoding, current state, history, state as of a day."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.records import parsed
from tidemark.functions.text import mask_pii
from tidemark.functions.times import from_micros, from_millis
from tidemark.operators.keyed import concerned, first_by, latest_by, small
from tidemark.operators.scan import next_value
from tidemark.session import cut_lineage

_ROW = (
    "STRUCT<ticket_id: STRING, user_id: STRING, subject: STRING, body: STRING, priority: STRING, "
    "status: STRING, category: STRING, created_at: BIGINT, updated_at: BIGINT>"
)
_ENVELOPE = (
    f"value STRUCT<before: STRUCT<ticket_id: STRING>, after: {_ROW}, "
    "source: STRUCT<lsn: BIGINT, ts_ms: BIGINT>>"
)


def decode_changes(bronze: DataFrame) -> DataFrame:
    """One typed row per change record, redeliveries included; tombstones and keyless records dropped.

    A delete has no `after`, so its key comes from `before`. Lines that cannot be read are no changes
    and no tombstones: `quality.unreadable_records` has them.
    """
    changed = bronze.where(F.col("_op").isNotNull()).select("*", parsed(F.col("_payload"), _ENVELOPE).alias("r"))
    value = F.col("r")["value"]
    after = value["after"]
    return changed.select(
        F.coalesce(after["ticket_id"], value["before"]["ticket_id"]).alias("ticket_id"),
        "_op",
        value["source"]["lsn"].alias("_lsn"),
        from_millis(value["source"]["ts_ms"]).alias("_changed_at"),
        *[after[c].alias(c) for c in ("user_id", "subject", "body", "priority", "status", "category")],
        from_micros(after["created_at"]).alias("created_at"),
        from_micros(after["updated_at"]).alias("updated_at"),
        "_batch_id",
        "_ingested_at",
        "_kafka_offset",
    ).where(F.col("ticket_id").isNotNull())


def once_per_change(changes: DataFrame) -> DataFrame:
    """Redelivered changes removed: the earliest copy of every (ticket, lsn)."""
    return first_by(changes, ["ticket_id", "_lsn"], [F.col("_ingested_at"), F.col("_kafka_offset")])


def _earlier_copy() -> list:
    """Order columns by which, among copies of one change, the earliest delivery is the greatest."""
    return [-F.unix_micros(F.col("_ingested_at").cast("timestamp")), -F.col("_kafka_offset")]


def ticket_state(changes: DataFrame) -> DataFrame:
    """The newest change of every ticket as a Silver row: text masked, a delete kept as a row of nulls."""
    newest = latest_by(changes, ["ticket_id"], [F.col("_lsn"), *_earlier_copy()])
    return newest.select(
        "ticket_id",
        "user_id",
        mask_pii(F.col("subject")).alias("subject"),
        mask_pii(F.col("body")).alias("body"),
        "priority",
        "status",
        "category",
        "created_at",
        "updated_at",
        (F.col("_op") == "d").alias("is_deleted"),
        "_lsn",
        "_batch_id",
    )


_VERSION = ("ticket_id", "_lsn", "_op", "_changed_at", "priority", "status", "category", "_ingested_at", "_kafka_offset")


def versions(changes: DataFrame) -> DataFrame:
    """The columns of `changes` that history keeps, each change once."""
    return once_per_change(changes.select(*_VERSION)).select(
        "ticket_id",
        "priority",
        "status",
        "category",
        (F.col("_op") == "d").alias("is_deleted"),
        F.col("_changed_at").alias("valid_from"),
        "_lsn",
    )


def scd2(changes: DataFrame) -> DataFrame:
    """Every version of every ticket with the time it was valid; a delete is a version too."""
    return _closed(next_value(versions(changes), ["ticket_id"], ["_lsn"], "valid_from", "valid_to"))


def _closed(versions: DataFrame) -> DataFrame:
    return versions.select(
        "ticket_id", "priority", "status", "category", "is_deleted", "valid_from", "valid_to", F.col("valid_to").isNull().alias("is_current"), "_lsn"
    )


def history_delta(kept: DataFrame, arrived: DataFrame, at_most: int | None) -> DataFrame:
    """The intervals that `arrived` changes open or end, given the rows `kept` of the history so far.

    Changes come in any order of their sequence numbers. Written anew are the changes themselves and, of the
    versions known before, those that are followed by one of them: at most one for each. Of a ticket's known
    versions only those between the first and the last change that has arrived, and their two neighbours, are
    put in order with them; a version that is known already is no news. Of `kept` rows of one version that of
    the greatest `_generation` holds.
    """
    fresh = versions(arrived)
    met = concerned(kept.select("ticket_id", "_lsn"), fresh, "ticket_id", at_most)
    fresh = cut_lineage(fresh.join(met, ["ticket_id", "_lsn"], "left_anti").select(*fresh.columns))
    reach = fresh.groupBy("ticket_id").agg(F.min("_lsn").alias("_low"), F.max("_lsn").alias("_high"))
    # One row for each ticket of the batch.
    known = kept.join(F.broadcast(reach) if small(at_most) else reach, "ticket_id")
    before = latest_by(known.where(F.col("_lsn") < F.col("_low")), ["ticket_id"], [F.col("_lsn"), F.col("_generation")])
    after = first_by(known.where(F.col("_lsn") > F.col("_high")), ["ticket_id"], [F.col("_lsn"), -F.col("_generation")])
    within = current_versions(known.where((F.col("_lsn") > F.col("_low")) & (F.col("_lsn") < F.col("_high"))))
    around = [df.select(*fresh.columns).withColumn("_new", F.lit(False)) for df in (before, within, after)]
    line = reduce(DataFrame.unionByName, [fresh.withColumn("_new", F.lit(True)), *around])
    told = line.withColumn("_told", F.struct("valid_from", "_new"))
    followed = next_value(told, ["ticket_id"], ["_lsn"], "_told", "_following").withColumn("valid_to", F.col("_following")["valid_from"])
    return _closed(followed.where(F.col("_new") | F.coalesce(F.col("_following")["_new"], F.lit(False))))


def current_versions(kept: DataFrame) -> DataFrame:
    """Of history rows written again the last one for each version."""
    return latest_by(kept, ["ticket_id", "_lsn"], [F.col("_generation")])


_NOW = ("_op", "subject", "body", "status", "category", "created_at", "_lsn", "_ingested_at", "_kafka_offset")
_CREATED = ("priority", "lsn", "ingested_at", "offset")


def feedback_by_ticket(events: DataFrame) -> DataFrame:
    """Whether any feedback on a ticket was negative."""
    feedback = events.where((F.col("type") == "feedback") & F.col("ticket_id").isNotNull())
    return feedback.groupBy("ticket_id").agg(F.bool_or(F.col("rating") == "down").alias("got_negative_feedback"))


def training_state(before: DataFrame | None, changes: DataFrame, events: DataFrame) -> DataFrame:
    """What a snapshot has to know of every ticket, after `changes` and `events`, given what was known `before`.

    The newest change, the first record of the creation, and whether any feedback was negative: all three can
    be merged, so yesterday's state and today's batch give today's state, by one aggregation on the ticket
    that reduces the batch before it is shuffled.
    """
    created = F.col("_op").isin("c", "r")
    first = dict(zip(_CREATED, ("priority", "_lsn", "_ingested_at", "_kafka_offset"), strict=True))
    of_changes = changes.select(
        "ticket_id", F.struct(*_NOW).alias("now"), F.when(created, F.struct(*[F.col(c).alias(n) for n, c in first.items()])).alias("created"),
        F.lit(None).cast("boolean").alias("got_negative_feedback"),
    )
    feedback = events.where((F.col("type") == "feedback") & F.col("ticket_id").isNotNull())
    nothing = [F.lit(None).cast(of_changes.schema[c].dataType).alias(c) for c in ("now", "created")]
    of_events = feedback.select("ticket_id", *nothing, (F.col("rating") == "down").alias("got_negative_feedback"))
    told = of_changes.unionByName(of_events)
    if before is not None:
        had_creation = F.when(F.col("was_created"), F.struct(*[F.col(f"created_{n}").alias(n) for n in _CREATED]))
        had_change = F.when(F.col("_op").isNotNull(), F.struct(*_NOW))
        told = told.unionByName(before.select("ticket_id", had_change.alias("now"), had_creation.alias("created"), "got_negative_feedback"))
    # Copies of one change are equal but for their delivery; the earliest stands for all.
    now = F.col("now")
    newest = F.when(now.isNotNull(), F.struct(now["_lsn"], -F.unix_micros(now["_ingested_at"].cast("timestamp")), -now["_kafka_offset"]))
    made = F.col("created")
    earliest = F.when(made.isNotNull(), F.struct(made["lsn"], made["ingested_at"], made["offset"]))
    folded = told.groupBy("ticket_id").agg(
        F.max_by("now", newest).alias("now"), F.min_by("created", earliest).alias("created"), F.bool_or("got_negative_feedback").alias("got_negative_feedback")
    )
    return folded.select(
        "ticket_id", *[now[c].alias(c) for c in _NOW], made.isNotNull().alias("was_created"),
        *[made[n].alias(f"created_{n}") for n in _CREATED], "got_negative_feedback",
    )


def snapshot_of(state: DataFrame, day: str) -> DataFrame:
    """Closed, labelled, live tickets of a state, with the priority they were created with."""
    wanted = state.where(F.col("was_created") & (F.col("_op") != "d") & (F.col("status") == "closed") & F.col("category").isNotNull())
    return wanted.select(
        F.lit(f"v{day}").alias("snapshot_version"),
        "ticket_id",
        mask_pii(F.concat("subject", F.lit(". "), "body")).alias("text"),
        F.col("category").alias("label"),
        F.col("created_priority").alias("priority_at_creation"),
        F.coalesce("got_negative_feedback", F.lit(False)).alias("got_negative_feedback"),
        F.to_date("created_at").alias("created_date"),
    )


def training_snapshot(changes: DataFrame, events: DataFrame, day: str) -> DataFrame:
    """The snapshot as of ingest day `day`, from the whole log.

    `changes` are decoded Bronze changes and `events` Silver events; later batches of both are ignored.
    """
    known, seen = changes.where(F.col("_batch_id") <= day), events.where(F.col("_batch_id") <= day)
    return snapshot_of(training_state(None, known, seen), day)
