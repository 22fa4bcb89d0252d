"""Event-time features, lateness, and point-in-time against leaky joins."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.records import parsed
from tidemark.functions.times import from_event_time
from tidemark.operators.scan import carry_last

# Where a raw record names its event time.
_NAMED_TIME = "value STRUCT<event_time: STRING>"


def daily_features(events: DataFrame) -> DataFrame:
    """Event counts per user and day of event time."""
    feedback = F.col("type") == "feedback"
    return events.groupBy("user_id", F.to_date("event_time").alias("event_date")).agg(
        F.count(F.lit(1)).alias("n_events"),
        F.count_if(F.col("type") == "click").alias("n_clicks"),
        F.count_if(feedback & (F.col("rating") == "up")).alias("n_feedback_up"),
        F.count_if(feedback & (F.col("rating") == "down")).alias("n_feedback_down"),
    )


def daily_features_between(events: DataFrame, low: str, high: str) -> DataFrame:
    """Features of the days from `low` to `high` only; the filter reaches the scan of the events."""
    start = F.lit(low).cast("date").cast("timestamp_ntz")
    end = F.date_add(F.lit(high).cast("date"), 1).cast("timestamp_ntz")
    return daily_features(events.where((F.col("event_time") >= start) & (F.col("event_time") < end)))


def lateness_counts(lateness_days: DataFrame) -> DataFrame:
    """`lateness_days, n`: how many records came so many days late. Counts of batches can be put together."""
    known = lateness_days.where(F.col("lateness_days").isNotNull())
    return known.groupBy("lateness_days").agg(F.count(F.lit(1)).alias("n"))


def lateness_profile(lateness_days: DataFrame) -> DataFrame:
    """Exact interpolated quantiles of the one integer column `lateness_days`.

    Rows without a lateness are left out; an empty input gives zeros.
    """
    return profile_of_counts(lateness_counts(lateness_days))


def profile_of_counts(counts: DataFrame) -> DataFrame:
    """The profile out of `lateness_counts` of any number of batches: a handful of (days, count) pairs each."""
    counted = counts.groupBy("lateness_days").agg(F.sum("n").alias("count"))
    points = F.array(*[F.lit(p) for p in (0.50, 0.95, 0.99)])
    profile = counted.agg(
        F.percentile("lateness_days", points, F.col("count")).alias("q"),
        F.max("lateness_days").alias("max"),
        F.coalesce(F.sum("count"), F.lit(0)).alias("n"),
    )
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    return profile.select(
        zero(F.col("q")[0]).alias("p50"),
        zero(F.col("q")[1]).alias("p95"),
        zero(F.col("q")[2]).alias("p99"),
        F.coalesce(F.col("max"), F.lit(0)).cast("bigint").alias("max"),
        "n",
        F.ceil(zero(F.col("q")[2])).alias("p99_days"),
    )


def lookback_check(lateness_days: DataFrame, lookback_days: int) -> DataFrame:
    """One row: the 99th percentile in whole days, the lookback, and whether it is `covered`."""
    return lookback_covered(lateness_profile(lateness_days), lookback_days)


def lookback_covered(profile: DataFrame, lookback_days: int) -> DataFrame:
    late = F.col("p99_days").cast("bigint")
    return profile.select(
        late.alias("p99_days"), F.lit(lookback_days).alias("lookback_days"), (late <= lookback_days).alias("covered")
    )


def event_lateness(bronze_events: DataFrame) -> DataFrame:
    """Calendar days from event to arrival, of every raw record that names an event time."""
    read = bronze_events.select("_ingested_at", parsed(F.col("_payload"), _NAMED_TIME).alias("r"))
    return _days_late(read, from_event_time(F.col("r")["value"]["event_time"]))


def staged_lateness(staged: DataFrame) -> DataFrame:
    """The same of `quality.staged_events`, which has the times read already."""
    raw = F.when(F.col("unread") == "", F.col("_payload")).otherwise(F.col("unread"))
    read = staged.select("_ingested_at", "event_time", F.col("unread").isNull().alias("_read"), parsed(raw, _NAMED_TIME).alias("r"))
    return _days_late(read, F.when(F.col("_read"), F.col("event_time")).otherwise(from_event_time(F.col("r")["value"]["event_time"])))


def _days_late(records: DataFrame, happened: Column) -> DataFrame:
    days = F.datediff(F.to_date("_ingested_at"), F.to_date(happened))
    return records.select(days.alias("lateness_days")).where(F.col("lateness_days").isNotNull())


def asof_join(left: DataFrame, right: DataFrame, on: Sequence[str], left_time: str, right_time: str, values: Sequence[str]) -> DataFrame:
    """Every left row with the `values` of the latest right row of its key at or before its time.

    Unmatched left rows stay, with nulls. Both sides form one time line per key, along which the last right
    row is carried forward by a scan over ranges of key and time; nothing is multiplied, and neither a hot
    key nor very many rows of one time are one task's.
    """
    found = F.struct(*[F.col(v).alias(v) for v in values])
    # Rows without a key match nothing; there may be very many, so they go around the time lines.
    apart = reduce(lambda x, y: x | y, [F.col(c).isNull() for c in on])
    a = left.where(~apart).select(*on, F.col(left_time).alias("_t"), F.lit(1).alias("_side"), F.struct(*left.columns).alias("_l"))
    b = right.dropna(subset=[right_time, *on])
    b = b.select(*on, F.col(right_time).alias("_t"), F.lit(0).alias("_side"), found.alias("_r"))
    # At equal times the right row comes first, and among right rows the greatest last.
    line = a.unionByName(b, allowMissingColumns=True).withColumn("_rank", F.col("_r"))
    matched = carry_last(line, on, ["_t", "_side", "_rank"], "_r").where(F.col("_side") == 1)
    found_none = [F.lit(None).cast(right.schema[v].dataType).alias(v) for v in values]
    keyless = left.where(apart).select("*", *found_none)
    return matched.select("_l.*", *[F.col("_r")[v].alias(v) for v in values]).unionByName(keyless)


def leaky_join(left: DataFrame, right: DataFrame, on: Sequence[str], value: str, name: str) -> DataFrame:
    """Every left row with the greatest `value` of its key over all time, future included."""
    overall = right.groupBy(*on).agg(F.max(value).alias(name))
    return left.join(overall, list(on), "left").select(*left.columns, name)


def leak_count(pairs: DataFrame, at_event: str, leaky: str) -> DataFrame:
    """How many rows the leaky feature shows a greater value for than was known at the time."""
    return pairs.agg(F.count_if(F.col(leaky) > F.col(at_event)).alias("n_leaks"))
