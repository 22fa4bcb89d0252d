"""Ticket changes: decoding, current state, replay, history, snapshots as of a day."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import cdc, keyed, quality
from tidemark.queries.events import silver_events
from tidemark.queries.inputs import CHANGE_SQL, EVENT_SQL, bronze_tickets, ticket_changes
from tidemark.queries.registry import Registry

registry = Registry()
_LATEST = f"SELECT * FROM ({CHANGE_SQL}) QUALIFY row_number() OVER (PARTITION BY ticket_id ORDER BY lsn DESC) = 1"
_STATE = """
SELECT ticket_id, user_id, subject, body, priority, status, category, created_at, op = 'd' AS is_deleted,
       CAST(lsn AS BIGINT) AS lsn, batch_id
"""


def _plain(state: DataFrame) -> DataFrame:
    return state.select(
        "ticket_id", "user_id", "subject", "body", "priority", "status", "category", "created_at", "is_deleted",
        F.col("_lsn").alias("lsn"), F.col("_batch_id").alias("batch_id"),
    )


@registry.query(f"""
SELECT ticket_id, op, CAST(lsn AS BIGINT) AS lsn, changed_at, user_id, priority, status, category, created_at, batch_id
FROM ({CHANGE_SQL})""")
def cdc_decode(spark: SparkSession, sf: str) -> DataFrame:
    """Change records typed; tombstones dropped, deletes keyed from `before`."""
    return ticket_changes(spark, sf, redelivered=False).select(
        "ticket_id", F.col("_op").alias("op"), F.col("_lsn").alias("lsn"), F.col("_changed_at").alias("changed_at"),
        "user_id", "priority", "status", "category", "created_at", F.col("_batch_id").alias("batch_id"),
    )


@registry.query(f"{_STATE} FROM ({_LATEST})")
def cdc_current(spark: SparkSession, sf: str) -> DataFrame:
    """The newest state of every ticket, text masked, deletes kept as rows of nulls."""
    return _plain(cdc.ticket_state(ticket_changes(spark, sf)))


@registry.query(f"{_STATE} FROM ({_LATEST})")
def cdc_replay(spark: SparkSession, sf: str) -> DataFrame:
    """Batches merged in the wrong order, an old one again at the end: the state is the same."""
    changes = ticket_changes(spark, sf)
    early = cdc.ticket_state(changes.where(F.col("_batch_id") <= "2024-01-15"))
    late = cdc.ticket_state(changes.where(F.col("_batch_id") > "2024-01-15"))
    state = keyed.upsert_guarded(late, early, "ticket_id", "_lsn")
    return _plain(keyed.upsert_guarded(state, early, "ticket_id", "_lsn"))


@registry.query(f"""
WITH s AS (SELECT * FROM ({CHANGE_SQL}) WHERE batch_id <= '2024-01-15'
           QUALIFY row_number() OVER (PARTITION BY ticket_id ORDER BY lsn DESC) = 1)
SELECT l.ticket_id, CAST(l.lsn AS BIGINT) AS lsn FROM ({_LATEST}) l LEFT JOIN s ON s.ticket_id = l.ticket_id
WHERE s.lsn IS NULL OR l.lsn > s.lsn""")
def cdc_winning_changes(spark: SparkSession, sf: str) -> DataFrame:
    """What the guarded merge writes when all changes meet the state of mid-month."""
    changes = ticket_changes(spark, sf)
    state = cdc.ticket_state(changes.where(F.col("_batch_id") <= "2024-01-15"))
    winners = keyed.newer_than_state(state, cdc.ticket_state(changes), "ticket_id", "_lsn")
    return winners.select("ticket_id", F.col("_lsn").alias("lsn"))


@registry.query(f"""
SELECT ticket_id, CAST(lsn AS BIGINT) AS lsn, op FROM ({CHANGE_SQL})
WHERE lsn > (SELECT max(lsn) FROM ({CHANGE_SQL}) WHERE batch_id <= '2024-01-15')""")
def cdc_high_water_mark(spark: SparkSession, sf: str) -> DataFrame:
    """Changes above everything a mid-month state has seen."""
    changes = ticket_changes(spark, sf, redelivered=False)
    state = cdc.ticket_state(changes.where(F.col("_batch_id") <= "2024-01-15"))
    fresh = keyed.above_high_water_mark(state, changes, "_lsn")
    return fresh.select("ticket_id", F.col("_lsn").alias("lsn"), F.col("_op").alias("op"))


@registry.query(f"""
SELECT ticket_id, priority, status, category, op = 'd' AS is_deleted, changed_at AS valid_from,
       lead(changed_at) OVER w AS valid_to, lead(changed_at) OVER w IS NULL AS is_current, CAST(lsn AS BIGINT) AS lsn
FROM ({CHANGE_SQL}) WINDOW w AS (PARTITION BY ticket_id ORDER BY lsn)""")
def scd2_history(spark: SparkSession, sf: str) -> DataFrame:
    """Every version of every ticket, from a log in which each change is delivered twice."""
    return cdc.scd2(ticket_changes(spark, sf)).withColumnRenamed("_lsn", "lsn")


def snapshot_sql(day: str) -> str:
    """The snapshot as of a day, given as an SQL expression."""
    return f"""
WITH changes AS (SELECT * FROM ({CHANGE_SQL}) WHERE batch_id <= {day}),
latest AS (SELECT * FROM changes QUALIFY row_number() OVER (PARTITION BY ticket_id ORDER BY lsn DESC) = 1),
created AS (SELECT ticket_id, priority AS priority_at_creation FROM changes WHERE op = 'c'
            QUALIFY row_number() OVER (PARTITION BY ticket_id ORDER BY lsn) = 1),
feedback AS (SELECT ticket_id, bool_or(rating = 'down') AS got_negative_feedback FROM ({EVENT_SQL})
             WHERE reason IS NULL AND type = 'feedback' AND strftime(arrived, '%Y-%m-%d') <= {day} GROUP BY 1)
SELECT 'v' || {day} AS snapshot_version, ticket_id, subject || '. ' || body AS text, category AS label,
       priority_at_creation, coalesce(got_negative_feedback, false) AS got_negative_feedback,
       strftime(created_at, '%Y-%m-%d') AS created_date
FROM latest JOIN created USING (ticket_id) LEFT JOIN feedback USING (ticket_id)
WHERE op <> 'd' AND status = 'closed' AND category IS NOT NULL
"""


@registry.query(snapshot_sql("'2024-01-20'"))
def snapshot_as_of(spark: SparkSession, sf: str) -> DataFrame:
    """The training snapshot of 20 January out of the whole month's log."""
    snapshot = cdc.training_snapshot(ticket_changes(spark, sf), silver_events(spark, sf), "2024-01-20")
    return snapshot.withColumn("created_date", F.col("created_date").cast("string"))


@registry.query(f"""
SELECT ticket_id, bool_or(rating = 'down') AS got_negative_feedback FROM ({EVENT_SQL})
WHERE reason IS NULL AND type = 'feedback' GROUP BY 1""")
def ticket_feedback(spark: SparkSession, sf: str) -> DataFrame:
    return cdc.feedback_by_ticket(silver_events(spark, sf))


@registry.query("""
SELECT 2 * count(*) AS n_records, 2 * count(*) FILTER (WHERE event_type = 'view' AND value >= 100) AS n_unreadable,
       2 * count(*) FILTER (WHERE event_type = 'view' AND value < 100) AS n_tombstones,
       count(*) FILTER (WHERE event_type <> 'view' OR value < 100) AS n_redeliveries FROM events""")
def bronze_profile(spark: SparkSession, sf: str) -> DataFrame:
    """Raw records keep tombstones, redeliveries and lines that cannot be read."""
    return quality.bronze_profile(bronze_tickets(spark, sf))


@registry.query("""
SELECT 'tickets' AS source, CASE event_id % 2 WHEN 0 THEN 'not valid JSON' ELSE 'not one record' END AS reason, 2 * count(*) AS n
FROM events WHERE event_type = 'view' AND value >= 100 GROUP BY ALL""")
def unreadable_changes(spark: SparkSession, sf: str) -> DataFrame:
    """Ticket lines that are no record, listed and not taken for tombstones."""
    found = quality.unreadable_records(bronze_tickets(spark, sf))
    return found.groupBy(F.col("_source").alias("source"), "reason").agg(F.count(F.lit(1)).alias("n"))
