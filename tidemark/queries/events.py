"""Events: the gate, deduplication, daily features, lateness, point-in-time joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import features, keyed, quality
from tidemark.plans.daily import LOOKBACK_DAYS
from tidemark.queries.inputs import EVENT_SQL, bronze_events, gated_events, table
from tidemark.queries.registry import Registry

registry = Registry()
# Ranges of days open at an end.
FIRST_DAY, LAST_DAY = "0001-01-01", "9999-12-30"
_BATCH = "strftime(arrived, '%Y-%m-%d')"
_FEATURES = """
SELECT user_id, strftime(ts, '%Y-%m-%d') AS event_date, count(*) AS n_events,
       count(*) FILTER (WHERE type = 'click') AS n_clicks,
       count(*) FILTER (WHERE type = 'feedback' AND rating = 'up') AS n_feedback_up,
       count(*) FILTER (WHERE type = 'feedback' AND rating = 'down') AS n_feedback_down
"""


def _arrival() -> list:
    return [F.col("_ingested_at"), F.col("_kafka_offset")]


def silver_events(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    """The first copy of every valid event; only the named columns, if any are, are moved."""
    valid = quality.valid_events(gated_events(spark, sf))
    if columns:
        valid = valid.select("event_id", "_ingested_at", "_kafka_offset", *columns)
    return keyed.first_by(valid, ["event_id"], _arrival())


_FEATURE_INPUT = ("user_id", "type", "rating", "event_time")


def _day_as_text(df: DataFrame) -> DataFrame:
    return df.withColumn("event_date", F.col("event_date").cast("string"))


@registry.query(f"{_FEATURES} FROM ({EVENT_SQL}) WHERE reason IS NULL GROUP BY ALL")
def feature_daily(spark: SparkSession, sf: str) -> DataFrame:
    """Raw records, each delivered twice -> gate -> first copy -> features per user and event day."""
    return _day_as_text(features.daily_features(silver_events(spark, sf, *_FEATURE_INPUT)))


@registry.query(f"""
{_FEATURES} FROM ({EVENT_SQL}) WHERE reason IS NULL
  AND (arrived < TIMESTAMP '2024-01-21' OR CAST(ts AS DATE) >= DATE '2024-01-17')
GROUP BY ALL""")
def feature_window_overwrite(spark: SparkSession, sf: str) -> DataFrame:
    """Features known on 20 January, with the days from the 17th on recomputed from all events."""
    events = silver_events(spark, sf)
    known = features.daily_features(events.where(F.col("_batch_id") <= "2024-01-20"))
    rebuilt = features.daily_features_between(events, "2024-01-17", LAST_DAY)
    return _day_as_text(keyed.overwrite_range(known, rebuilt, "event_date", "2024-01-17", LAST_DAY))


@registry.query(f"""
SELECT event_id, user_id, ticket_id, type, rating, page, ts AS event_time, CAST(n AS BIGINT) AS kafka_offset,
       {_BATCH} AS batch_id
FROM ({EVENT_SQL}) WHERE reason IS NULL""")
def event_gate(spark: SparkSession, sf: str) -> DataFrame:
    valid = quality.valid_events(gated_events(spark, sf, redelivered=False))
    return valid.select(
        "event_id", "user_id", "ticket_id", "type", "rating", "page", "event_time",
        F.col("_kafka_offset").alias("kafka_offset"), F.col("_batch_id").alias("batch_id"),
    )


@registry.query(f"""
SELECT CASE WHEN read THEN {_BATCH} END AS batch_id, CASE WHEN read THEN CAST(u % 3 AS INTEGER) END AS kafka_partition,
       CASE WHEN read THEN CAST(n AS BIGINT) END AS kafka_offset, CASE WHEN read THEN event_id END AS event_id, reason
FROM (SELECT *, reason NOT LIKE 'record: not%' AS read FROM ({EVENT_SQL})) WHERE reason IS NOT NULL""")
def event_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    bad = quality.quarantined_events(gated_events(spark, sf, redelivered=False))
    return bad.select(
        F.col("_batch_id").alias("batch_id"), F.col("_kafka_partition").alias("kafka_partition"),
        F.col("_kafka_offset").alias("kafka_offset"), "event_id", "reason",
    )


@registry.query(f"SELECT event_id, user_id, type, rating FROM ({EVENT_SQL}) WHERE reason IS NULL")
def typed_event_filter(spark: SparkSession, sf: str) -> DataFrame:
    """The gate's rules as one predicate over typed columns."""
    return quality.passing_events(gated_events(spark, sf, redelivered=False)).select("event_id", "user_id", "type", "rating")


@registry.query(f"SELECT event_id, user_id, arrived AS ingested_at, {_BATCH} AS batch_id FROM ({EVENT_SQL}) WHERE reason IS NULL")
def event_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """The first copy of every redelivered event."""
    return silver_events(spark, sf).select(
        "event_id", "user_id", F.col("_ingested_at").alias("ingested_at"), F.col("_batch_id").alias("batch_id")
    )


@registry.query(f"SELECT event_id, {_BATCH} AS batch_id FROM ({EVENT_SQL}) WHERE reason IS NULL AND arrived >= TIMESTAMP '2024-01-16'")
def event_insert_new(spark: SparkSession, sf: str) -> DataFrame:
    """What merging all deliveries appends to a state that already holds those of the first half month."""
    valid = quality.valid_events(gated_events(spark, sf))
    state = keyed.first_by(valid.where(F.col("_batch_id") <= "2024-01-15"), ["event_id"], _arrival())
    fresh = keyed.insert_new(state, valid, "event_id", _arrival())
    return fresh.select("event_id", F.col("_batch_id").alias("batch_id"))


@registry.query(f"""
SELECT quantile_cont(d, 0.50) AS p50, quantile_cont(d, 0.95) AS p95, quantile_cont(d, 0.99) AS p99,
       CAST(max(d) AS BIGINT) AS max, count(*) AS n, CAST(ceil(quantile_cont(d, 0.99)) AS BIGINT) AS p99_days
FROM (SELECT date_diff('day', CAST(ts AS DATE), CAST(arrived + again * INTERVAL 1 MINUTE AS DATE)) AS d
      FROM ({EVENT_SQL}), (VALUES (0), (1)) copies(again) WHERE reason IS NULL OR (reason NOT LIKE 'event_time%' AND reason NOT LIKE 'record: not%'))""")
def lateness(spark: SparkSession, sf: str) -> DataFrame:
    """Calendar days from event to arrival, over every raw record that names a readable time."""
    return features.lateness_profile(features.event_lateness(bronze_events(spark, sf)))


@registry.query(f"""
SELECT CAST(ceil(quantile_cont(d, 0.99)) AS BIGINT) AS p99_days, 3 AS lookback_days, ceil(quantile_cont(d, 0.99)) <= 3 AS covered
FROM (SELECT date_diff('day', CAST(ts AS DATE), CAST(arrived + again * INTERVAL 1 MINUTE AS DATE)) AS d
      FROM ({EVENT_SQL}), (VALUES (0), (1)) copies(again) WHERE reason IS NULL OR (reason NOT LIKE 'event_time%' AND reason NOT LIKE 'record: not%'))""")
def lookback_covers_lateness(spark: SparkSession, sf: str) -> DataFrame:
    """Whether the days every run recomputes cover the 99th percentile of lateness."""
    return features.lookback_check(features.event_lateness(bronze_events(spark, sf)), LOOKBACK_DAYS)


@registry.query("""
SELECT round(quantile_cont(d, 0.50), 6) AS p50, round(quantile_cont(d, 0.95), 6) AS p95,
       round(quantile_cont(d, 0.99), 6) AS p99, CAST(max(d) AS BIGINT) AS max, count(*) AS n,
       CAST(ceil(quantile_cont(d, 0.99)) AS BIGINT) AS p99_days
FROM (SELECT date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS d
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey)""")
def shipping_lateness(spark: SparkSession, sf: str) -> DataFrame:
    """The same profile for the days from order to shipment."""
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_shipdate")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    days = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.datediff(F.to_date("l_shipdate"), F.to_date("o_orderdate")).alias("lateness_days")
    )
    profile = features.lateness_profile(days)
    return profile.select(*[F.round(c, 6).alias(c) for c in ("p50", "p95", "p99")], "max", "n", "p99_days")


def _purchases(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").where(F.col("event_type") == "purchase")
    return events.select("event_id", "user_id", F.col("ts").alias("event_ts"))


def _spend(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").where(F.col("event_type") == "signup")
    return events.select("user_id", F.col("ts").alias("valid_from"), F.col("value").alias("lifetime_spend"))


_PAIRS = """
SELECT e.event_id, e.user_id, e.ts AS event_ts, f.value AS spend_at_event,
       (SELECT max(value) FROM events g WHERE g.event_type = 'signup' AND g.user_id = e.user_id) AS spend_leaky
FROM (SELECT * FROM events WHERE event_type = 'purchase') e
ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'signup') f ON e.user_id = f.user_id AND e.ts >= f.ts
"""


def _point_in_time(spark: SparkSession, sf: str) -> DataFrame:
    history = _spend(spark, sf).withColumnRenamed("lifetime_spend", "spend_at_event")
    return features.asof_join(_purchases(spark, sf), history, ["user_id"], "event_ts", "valid_from", ["spend_at_event"])


@registry.query(f"SELECT event_id, user_id, event_ts, spend_at_event FROM ({_PAIRS})")
def asof_features(spark: SparkSession, sf: str) -> DataFrame:
    return _point_in_time(spark, sf)


@registry.query(f"SELECT event_id, user_id, event_ts, spend_leaky FROM ({_PAIRS})")
def leaky_features(spark: SparkSession, sf: str) -> DataFrame:
    return features.leaky_join(_purchases(spark, sf), _spend(spark, sf), ["user_id"], "lifetime_spend", "spend_leaky")


@registry.query(f"SELECT count(*) FILTER (WHERE spend_leaky > spend_at_event) AS n_leaks FROM ({_PAIRS})")
def leak_count(spark: SparkSession, sf: str) -> DataFrame:
    both = features.leaky_join(_point_in_time(spark, sf), _spend(spark, sf), ["user_id"], "lifetime_spend", "spend_leaky")
    return features.leak_count(both, "spend_at_event", "spend_leaky")
