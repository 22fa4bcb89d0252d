import itertools

from pyspark.sql import functions as F

from tidemark.operators import keyed

SCHEMA = "k string, v bigint, x string"


def frame(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def test_first_and_latest_put_null_last(spark, rows):
    df = frame(spark, [("a", 2, "two"), ("a", None, "none"), ("a", 1, "one"), ("b", None, "only")])
    assert rows(keyed.first_by(df, ["k"], [F.col("v")]), "k", "x") == [("a", "one"), ("b", "only")]
    assert rows(keyed.latest_by(df, ["k"], [F.col("v")]), "k", "x") == [("a", "two"), ("b", "only")]


def test_whole_row_is_kept_even_where_null(spark, rows):
    df = frame(spark, [("a", 1, "old"), ("a", 2, None)])
    assert rows(keyed.latest_by(df, ["k"], [F.col("v")])) == [("a", 2, None)]


def test_a_key_leaves_each_map_task_once(spark):
    plan = keyed.latest_by(frame(spark, [("a", 1, "x")]), ["k"], [F.col("v")])._jdf.queryExecution().executedPlan().toString()
    before_shuffle = plan[plan.index("Exchange"):]
    assert "partial_max_by" in before_shuffle


def test_equal_or_older_versions_never_win(spark, rows):
    state = frame(spark, [("a", 5, "state"), ("b", 5, "state")])
    batch = frame(spark, [("a", 5, "batch"), ("b", 4, "batch"), ("c", 1, "batch")])
    assert rows(keyed.newer_than_state(state, batch, "k", "v")) == [("c", 1, "batch")]
    assert rows(keyed.upsert_guarded(state, batch, "k", "v")) == [("a", 5, "state"), ("b", 5, "state"), ("c", 1, "batch")]


def test_any_order_and_replay_of_batches_gives_one_state(spark, rows):
    batches = [[("a", 1, "a1"), ("b", 2, "b2")], [("a", 3, "a3")], [("b", 4, "b4"), ("c", 5, "c5")]]
    want = [("a", 3, "a3"), ("b", 4, "b4"), ("c", 5, "c5")]
    for order in itertools.permutations(range(3)):
        state = frame(spark, [])
        for n in [*order, order[0]]:
            state = keyed.upsert_guarded(state, frame(spark, batches[n]), "k", "v")
        assert rows(state) == want


def test_insert_new_keeps_the_first_copy_and_never_updates(spark, rows):
    state = frame(spark, [("a", 1, "seen")])
    batch = frame(spark, [("a", 2, "again"), ("b", 9, "late"), ("b", 3, "first")])
    assert rows(keyed.insert_new(state, batch, "k", [F.col("v")])) == [("b", 3, "first")]


def test_high_water_mark_skips_low_versions_of_new_keys(spark, rows):
    state = frame(spark, [("a", 5, "s")])
    batch = frame(spark, [("b", 4, "skipped"), ("c", 6, "kept")])
    assert rows(keyed.above_high_water_mark(state, batch, "v")) == [("c", 6, "kept")]
    assert len(rows(keyed.above_high_water_mark(state.limit(0), batch, "v"))) == 2


def test_overwrite_range_drops_days_the_rebuild_lacks(spark, rows):
    make = lambda data: spark.createDataFrame(data, "d string, n int").withColumn("d", F.col("d").cast("date"))
    state = make([("2024-01-01", 1), ("2024-01-02", 2), ("2024-01-03", 3), ("2024-01-04", 4)])
    rebuilt = make([("2024-01-03", 30), ("2024-01-09", 90)])
    out = keyed.overwrite_range(state, rebuilt, "d", "2024-01-02", "2024-01-03")
    assert rows(out.select(F.col("d").cast("string"), "n")) == [("2024-01-01", 1), ("2024-01-03", 30), ("2024-01-04", 4)]
