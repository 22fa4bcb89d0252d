import json

import pytest
from pyspark.sql import functions as F

from deliveries import change, event, ticket_row
from tidemark.operators import keyed, quality
from tidemark.operators.keyed import latest_by
from tidemark.plans.lake import Lake
from tidemark.sources.landing import kafka_records
from tidemark.streaming import streams


def put(folder, name, records):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(json.dumps(r) for r in records) + "\n", encoding="utf-8")


def land(spark, tmp_path, source):
    lines = spark.readStream.text(str(tmp_path / "in"))
    streams.finish(streams.land_stream(lines, source, str(tmp_path / "bronze"), str(tmp_path / "c-land")))
    return spark.read.parquet(str(tmp_path / "bronze"))


def test_new_files_land_exactly_once(spark, tmp_path, rows):
    put(tmp_path / "in", "1.jsonl", [event("e1", "u", "2024-03-01T10:00:00")])
    assert land(spark, tmp_path, "events").count() == 1
    put(tmp_path / "in", "2.jsonl", [event("e2", "u", "2024-03-02T10:00:00")])
    land(spark, tmp_path, "events")
    assert rows(land(spark, tmp_path, "events"), "_batch_id", "_op") == [("2024-03-01", None), ("2024-03-02", None)]


def test_changes_merge_in_any_order_of_files(spark, tmp_path, rows):
    row = ticket_row("A", "2024-03-01T08:00:00")
    files = [[change("u", 5, "2024-03-02T08:00:00", "A", {**row, "priority": "high"})], [change("c", 1, "2024-03-01T08:00:00", "A", row)], [change("d", 7, "2024-03-03T08:00:00", "B")]]
    lake = Lake(spark, str(tmp_path / "lake"))
    for n, records in enumerate(files):
        put(tmp_path / "in", f"{n}.jsonl", records)
        schema = land(spark, tmp_path, "tickets").schema
        bronze = spark.readStream.schema(schema).parquet(str(tmp_path / "bronze"))
        streams.finish(streams.upsert_tickets_stream(bronze, lake, str(tmp_path / "c-merge")))
    state = latest_by(lake.read("silver_tickets"), ["ticket_id"], [F.col("_lsn")])
    assert rows(state, "ticket_id", "priority", "is_deleted", "_lsn") == [("A", "high", False, 5), ("B", None, True, 7)]


def test_a_failing_stream_raises(spark, tmp_path):
    put(tmp_path / "in", "1.txt", [])
    broken = spark.readStream.text(str(tmp_path / "in")).select(F.raise_error(F.lit("boom")).alias("x"))
    query = broken.writeStream.format("noop").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    with pytest.raises(Exception, match="boom"):
        streams.finish(query)


def stream_events(spark, tmp_path):
    lines = spark.readStream.option("maxFilesPerTrigger", 1).text(str(tmp_path / "in"))
    gated = quality.gate_events(kafka_records(lines, "events", "", with_op=False))
    lake = Lake(spark, str(tmp_path / "lake"))
    streams.finish(streams.events_stream(gated, lake, str(tmp_path / "c")))
    return lake


def test_redeliveries_are_dropped_across_restarts_however_late(spark, tmp_path, rows):
    for n, at in enumerate(["2024-03-01T10:00:00", "2024-03-30T10:00:00", "2024-06-01T10:00:00"]):
        put(tmp_path / "in", f"{n}.jsonl", [event("e1", "u", "2024-03-01T10:00:00", arrived=at), event(f"new{n}", "u", "2024-03-01T11:00:00", arrived=at)])
        lake = stream_events(spark, tmp_path)
    assert rows(lake.read("silver_events"), "event_id") == [("e1",), ("new0",), ("new1",), ("new2",)]


def test_late_events_update_their_day_and_none_is_too_late(spark, tmp_path, rows):
    files = [
        [event("a", "u", "2024-03-01T10:00:00"), event("b", "u", "2024-03-03T10:00:00")],
        [event("late", "u", "2024-03-01T11:00:00", "feedback", "up"), event("c", "u", "2024-03-20T10:00:00")],
        [event("very late", "u", "2024-03-01T12:00:00"), event("a", "u", "2024-03-01T10:00:00")],
    ]
    for n, records in enumerate(files):
        put(tmp_path / "in", f"{n}.jsonl", records)
    lake = stream_events(spark, tmp_path)
    now = lake.read("gold_feature_daily").withColumn("event_date", F.col("event_date").cast("string"))
    assert rows(now, "event_date", "n_events", "n_feedback_up") == [("2024-03-01", 3, 1), ("2024-03-03", 1, 0), ("2024-03-20", 1, 0)]
    assert len(lake.tables()["silver_events"]) == 3


def test_a_line_without_a_time_lands_on_a_day(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1.jsonl").write_text('{"timestamp": 17092\n', encoding="utf-8")
    landed = land(spark, tmp_path, "tickets").first()
    assert landed["_batch_id"] == str(landed["ingest_date"]) and landed["_op"] is None


def test_fresh_events_never_look_at_the_table(spark, tmp_path, rows, monkeypatch):
    looked = []
    plain = keyed.unseen
    monkeypatch.setattr(streams.keyed, "unseen", lambda state, batch, key, at_most=None: looked.append(sorted(r[key] for r in batch.collect())) or plain(state, batch, key, at_most))
    files = [
        [event("a", "u", "2024-03-10T10:00:00"), event("a", "u", "2024-03-10T10:00:00", arrived="2024-03-10T10:05:00")],
        [event("b", "u", "2024-03-11T10:00:00"), event("a", "u", "2024-03-10T10:00:00", arrived="2024-03-11T10:05:00"), event("c", "u", "2024-03-09T10:00:00")],
        # Beyond the three days: one known, one not.
        [event("old", "u", "2024-03-01T10:00:00"), event("old", "u", "2024-03-01T10:00:00", arrived="2024-03-12T10:00:00"), event("d", "u", "2024-03-12T10:00:00")],
        [event("old", "u", "2024-03-01T10:00:00", arrived="2024-03-13T10:00:00"), event("a", "u", "2024-03-10T10:00:00", arrived="2024-03-13T10:00:00")],
    ]
    for n, records in enumerate(files):
        put(tmp_path / "in", f"{n}.jsonl", records)
        # Stopped after every file, and started again.
        lake = stream_events(spark, tmp_path)
    assert rows(lake.read("silver_events"), "event_id") == [("a",), ("b",), ("c",), ("d",), ("old",)]
    assert looked == [["old"], ["old"]]
    arrived = {r["event_id"]: str(r["_ingested_at"]) for r in lake.read("silver_events").collect()}
    assert arrived["a"].startswith("2024-03-10 10:00") and lake.read("gold_feature_daily").agg(F.sum("n_events")).first()[0] == 5


def test_a_micro_batch_tried_again_adds_nothing(spark, tmp_path, rows):
    put(tmp_path / "in", "0.jsonl", [event("a", "u", "2024-03-10T10:00:00")])
    lake = stream_events(spark, tmp_path)
    # Spark's own record that the first micro-batch is done is lost, the tables have it.
    for file in [*(tmp_path / "c" / "commits").iterdir(), *(tmp_path / "c" / "offsets").iterdir()]:
        number = file.name.removeprefix(".").removesuffix(".crc")
        if number.isdigit() and (file.parent.name == "commits" or number != "0"):
            file.unlink()
    lake = stream_events(spark, tmp_path)
    assert rows(lake.read("silver_events"), "event_id") == [("a",)]
    assert lake.read("gold_feature_daily").agg(F.sum("n_events")).first()[0] == 1


def test_a_table_filled_by_others_is_compared_with(spark, tmp_path, rows):
    put(tmp_path / "in", "0.jsonl", [event("a", "u", "2024-03-10T10:00:00")])
    stream_events(spark, tmp_path)
    # Another stream over the same table, whose state knows nothing.
    lines = spark.readStream.text(str(tmp_path / "in"))
    put(tmp_path / "in", "1.jsonl", [event("b", "u", "2024-03-10T11:00:00")])
    lake = Lake(spark, str(tmp_path / "lake"))
    streams.finish(streams.events_stream(quality.gate_events(kafka_records(lines, "events", "", with_op=False)), lake, str(tmp_path / "c2")))
    lake = stream_events(spark, tmp_path)
    assert rows(lake.read("silver_events"), "event_id") == [("a",), ("b",)]
