import bisect
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators import features, scan

T0 = datetime(2026, 6, 1)


def test_daily_features(spark, rows):
    data = [("u", "click", None, T0), ("u", "feedback", "up", T0), ("u", "feedback", "down", T0 + timedelta(hours=23)), ("u", "click", None, T0 + timedelta(days=1)), ("v", "click", None, T0)]
    df = spark.createDataFrame(data, "user_id string, type string, rating string, event_time timestamp_ntz")
    want = [("u", "2026-06-01", 3, 1, 1, 1), ("u", "2026-06-02", 1, 1, 0, 0), ("v", "2026-06-01", 1, 1, 0, 0)]
    assert rows(features.daily_features(df).withColumn("event_date", F.col("event_date").cast("string"))) == want
    between = features.daily_features_between(df, "2026-06-02", "2026-06-02")
    assert rows(between.withColumn("event_date", F.col("event_date").cast("string"))) == want[1:2]


def test_lateness_is_interpolated_and_zero_when_empty(spark):
    days = spark.createDataFrame([(0,)] * 38 + [(1,), (2,), (3,), (3,), (3,), (None,)], "lateness_days int")
    p = features.lateness_profile(days).first()
    assert (p["n"], p["max"], p["p50"], p["p99_days"]) == (43, 3, 0.0, 3)
    assert p["p95"] == pytest.approx(2.9) and p["p99"] == pytest.approx(3.0)
    assert tuple(features.lateness_profile(days.limit(0)).first()) == (0.0, 0.0, 0.0, 0, 0, 0)


def sample(spark):
    events = [("u100", datetime(2026, 6, 1, 10)), ("u100", datetime(2026, 6, 3, 9)), ("u101", datetime(2026, 6, 2, 12))]
    history = [("u100", datetime(2026, 5, 30), 50.0), ("u100", datetime(2026, 6, 2), 120.0), ("u100", datetime(2026, 6, 4), 300.0), ("u101", datetime(2026, 6, 1), 20.0)]
    return (
        spark.createDataFrame(events, "user_id string, event_ts timestamp_ntz"),
        spark.createDataFrame(history, "user_id string, valid_from timestamp_ntz, lifetime_spend double"),
    )


def test_point_in_time_against_leaky(spark, rows):
    events, history = sample(spark)
    pit = features.asof_join(events, history, ["user_id"], "event_ts", "valid_from", ["lifetime_spend"])
    assert [r[2] for r in rows(pit)] == [50.0, 120.0, 20.0]
    both = features.leaky_join(pit, history, ["user_id"], "lifetime_spend", "leaky")
    assert [r[3] for r in rows(both)] == [300.0, 300.0, 20.0]
    assert features.leak_count(both, "lifetime_spend", "leaky").first()[0] == 2


def random_sides(seed, n=400):
    """Two time lines in which one key holds most rows and many times are equal."""
    rnd = random.Random(seed)
    key = lambda: "hot" if rnd.random() < 0.8 else rnd.choice("abc")
    time = lambda: None if rnd.random() < 0.02 else T0 + timedelta(minutes=rnd.randrange(300))
    left = [(i, rnd.choice([key(), None]) if rnd.random() < 0.05 else key(), time()) for i in range(n)]
    right = [(key() if rnd.random() > 0.03 else None, time(), None if rnd.random() < 0.1 else float(i)) for i in range(n // 2)]
    return left, right


def brute_asof(left, right):
    lines = {}
    for k, t, v in right:
        if k is not None and t is not None:
            lines.setdefault(k, []).append((t, v is not None, v if v is not None else 0.0))
    for line in lines.values():
        line.sort()
    out = []
    for i, k, t in left:
        line = lines.get(k, []) if t is not None else []
        at = bisect.bisect_right(line, (t, True, float("inf"))) if line else 0
        found = line[at - 1] if at else None
        out.append((i, found[2] if found and found[1] else None))
    return sorted(out)


@pytest.mark.parametrize("ranges", [1, 4, 40])
@pytest.mark.parametrize("seed", [1, 2, 3])
def test_asof_equals_brute_force(spark, seed, ranges):
    left, right = random_sides(seed)
    a = spark.createDataFrame(left, "i int, k string, t timestamp_ntz")
    b = spark.createDataFrame(right, "k string, f timestamp_ntz, v double")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", ranges)
    out = features.asof_join(a, b, ["k"], "t", "f", ["v"]).collect()
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert sorted((r["i"], r["v"]) for r in out) == brute_asof(left, right)


def test_one_key_at_one_time_is_many_tasks(spark):
    """All rows have the same key and a third of them the same time; they are dealt over all tasks."""
    line = spark.range(40_000).select(F.lit("k").alias("k"), F.when(F.col("id") % 3 == 0, 500).otherwise(F.col("id") % 1000).alias("o"), F.when(F.col("id") % 500 == 7, F.col("id")).alias("v"))
    sizes = [r["count"] for r in scan._dealt(line, ["k"], ["o"]).groupBy("_task").count().collect()]
    assert len(sizes) == 4 and max(sizes) < 2 * 40_000 / 4
    got = scan.carry_last(line.withColumn("n", F.monotonically_increasing_id()), ["k"], ["o", "n"], "v").collect()
    at, last = {}, None
    for r in sorted(line.withColumn("n", F.monotonically_increasing_id()).collect(), key=lambda r: (r["o"], r["n"])):
        last = r["v"] if r["v"] is not None else last
        at[r["n"]] = last
    assert {r["n"]: r["v"] for r in got} == at


def test_next_values_cross_tasks(spark):
    rows = [("a" if k % 3 else f"b{k % 10}", k, None if k % 7 == 0 else k * 10) for k in range(300)]
    line = spark.createDataFrame(rows, "k string, o long, v long").repartition(5)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 60)
    got = {(r["k"], r["o"]): r["next"] for r in scan.next_value(line, ["k"], ["o"], "v", "next").collect()}
    spark.conf.set("spark.sql.shuffle.partitions", before)
    want = {}
    for key in {r[0] for r in rows}:
        own = sorted(r[1:] for r in rows if r[0] == key)
        want |= {(key, o): (own[n + 1][1] if n + 1 < len(own) else None) for n, (o, _) in enumerate(own)}
    assert got == want
    assert scan.next_value(line.limit(0), ["k"], ["o"], "v", "next").collect() == [] == scan.carry_last(line.limit(0), ["k"], ["o"], "v").collect()


def test_rows_without_a_key_go_around_the_time_lines(spark):
    left = spark.sql("SELECT CAST(id AS INT) AS i, IF(id % 4 = 0, 'a', NULL) AS k, timestamp_seconds(id) AS t FROM range(4000)")
    right = spark.sql("SELECT k, timestamp_seconds(1000) AS f, 7 AS v FROM VALUES ('a'), (NULL) AS x(k)")
    out = features.asof_join(left, right, ["k"], "t", "f", ["v"])
    got = {r["i"]: r["v"] for r in out.collect()}
    assert len(got) == 4000 and all(v == (7 if i % 4 == 0 and i >= 1000 else None) for i, v in got.items())


def test_unix_times_count_as_late_too(spark):
    from tidemark.operators.schemas import BRONZE

    lines = ['{"value": {"event_time": 1709287200}}', '{"value": {"event_time": "2024-03-01T10:00:00Z"}}', '{"value": {"event_time": 99999999999999999999}}']
    bronze = spark.createDataFrame([("e", "d", datetime(2024, 3, 3), 0, 1, None, x) for x in lines], BRONZE)
    assert [r[0] for r in features.event_lateness(bronze).collect()] == [2, 2]
    assert tuple(features.lookback_check(features.event_lateness(bronze), 1).first()) == (2, 1, False)


def test_staged_events_tell_the_lateness_of_raw_records(spark):
    from tidemark.operators import quality
    from tidemark.operators.schemas import BRONZE

    time = '"2024-03-01T10:00:00Z"'
    values = [time, "1709287200", "1709287200.50", "1.7092872e9", "-0", "null", "true", '""', '" 2024-03-01 "', '"1709287200.5"', "99999999999999999999", '{"a": 1}']
    lines = [f'{{"value": {{"event_time": {v}}}}}' for v in values]
    whole = '{"value": {"event_id": "e", "user_id": "u", "ticket_id": null, "type": "click", "rating": null, "page": null, "event_time": %s}}'
    lines += [whole % v for v in values]
    lines += [f"[{lines[0]}]", f"[{lines[0]},{lines[0]}]", lines[0][:-1], lines[0] + " x", "{'value': {'event_time': '2024-03-01'}}", "{}", "null", '{"value": 1}']
    lines += ['{"value": {"event_time": %s}, "value": {"event_time": 5}}' % time, '{"value": {"event_time": %s, "event_time": "2024-02-01"}}' % time]
    for line in lines:
        bronze = spark.createDataFrame([("e", "d", datetime(2024, 3, 3), 0, 1, None, line)], BRONZE)
        staged = quality.staged_events(bronze)
        assert features.staged_lateness(staged).collect() == features.event_lateness(bronze).collect(), line
