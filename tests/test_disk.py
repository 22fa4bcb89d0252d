"""What runs leave on the disk: nothing that no table holds."""

import os
from datetime import datetime, timedelta

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from deliveries import three_days
from tidemark.plans.daily import Warehouse
from tidemark.plans.lake import Lake
from tidemark.queries import runs
from tidemark.session import brief_shuffles, cut_lineage, passing, setting, shared_folder


def labels(spark, *tickets):
    return spark.createDataFrame([(t, "bug", "m", "p") for t in tickets], "ticket_id string, label string, model string, prompt_version string")


def tickets_of(lake):
    return sorted(r["ticket_id"] for r in lake.read("gold_ticket_labels").collect())


def local(folder):
    return folder.removeprefix("file:")


def stored(spark):
    return {name for name in os.listdir(local(shared_folder(spark))) if name.startswith("stored-")}


def files(folder):
    """Data files below a folder."""
    return [os.path.join(d, name) for d, _, names in os.walk(folder) for name in names if name.startswith("part-")]


@pytest.fixture(scope="module")
def tables(tmp_path_factory):
    """Events of ten days and conversations about their users, some rows twice and some fields null."""
    folder = tmp_path_factory.mktemp("tables")
    kinds = ("click", "purchase", "view", "signup", "error")
    begin = datetime(2024, 5, 1, 1)
    events = [
        (n, begin + timedelta(hours=n), n % 7, kinds[(n + n // 7) % 5], float((n * 37) % 130), None if n % 11 == 0 else f'{{"k": {n % 4}}}')
        for n in range(240)
    ]
    turns = [(c, t, "user" if t % 2 == 0 else "agent", f"one two {c}\nthree {t}. four") for c in range(7) for t in range(8) if (c + t) % 5]
    con = duckdb.connect()
    con.execute("CREATE TABLE events (event_id BIGINT, ts TIMESTAMP, user_id BIGINT, event_type VARCHAR, value DOUBLE, props VARCHAR)")
    con.executemany("INSERT INTO events VALUES (?, ?, ?, ?, ?, ?)", events)
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", [*turns, *turns[:3]])
    for name in ("events", "conversations"):
        con.execute(f"COPY {name} TO '{folder}/{name}.parquet' (FORMAT parquet)")
    return str(folder)


def test_a_vacuum_leaves_what_the_last_commit_names(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    run = lake.begin()
    run.put("gold_ticket_labels", "one", labels(spark, "A"))
    run.put_by("gold_ticket_labels", labels(spark, "C", "D"), F.col("ticket_id"), lambda slot: False)
    run.commit()
    run = lake.begin()
    run.aside(labels(spark, "X"))
    run.put("gold_ticket_labels", "one", labels(spark, "B"))
    run.put_by("gold_ticket_labels", labels(spark, "D", "E"), F.col("ticket_id"), lambda slot: slot in ("D", "E"))
    run.commit()
    failed = lake.begin()
    failed.replace("gold_ticket_labels", labels(spark, "Y"))
    assert tickets_of(lake) == ["B", "C", "D", "E"]
    lake.vacuum()
    assert tickets_of(lake) == ["B", "C", "D", "E"]
    held = {f"{lake.root}/{h['path']}" for h in lake.tables()["gold_ticket_labels"].values()}
    assert {os.path.dirname(f) for f in files(lake.root)} == held
    # The table is written and read on as before.
    run = lake.begin()
    run.append("gold_ticket_labels", labels(spark, "F"))
    run.commit()
    lake.vacuum()
    assert tickets_of(lake) == ["B", "C", "D", "E", "F"]


def test_an_empty_lake_is_vacuumed(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    lake.vacuum()
    assert lake.tables() == {} and tickets_of(lake) == []


def test_what_is_stored_in_passing_goes_at_its_end(spark):
    before = stored(spark)
    outside = cut_lineage(spark.range(3))
    with passing(spark):
        inside = cut_lineage(spark.range(4))
        with passing(spark):
            assert cut_lineage(inside).count() == 4
        assert inside.count() == 4
    assert outside.count() == 3 and len(stored(spark) - before) == 1
    with pytest.raises(ZeroDivisionError), passing(spark):
        cut_lineage(spark.range(5))
        1 / 0  # noqa: B018
    assert len(stored(spark) - before) == 1


def test_a_setting_holds_inside_only(spark):
    key = "spark.sql.files.maxRecordsPerFile"
    before = spark.conf.get(key)
    with setting(spark, key, "5"):
        assert spark.conf.get(key) == "5"
        with pytest.raises(ZeroDivisionError), setting(spark, key, "6"):
            1 / 0  # noqa: B018
        assert spark.conf.get(key) == "5"
    assert spark.conf.get(key) == before


def test_frames_are_read_again_after_their_shuffles_have_gone(spark):
    with brief_shuffles(spark):
        df = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
        joined = df.join(df.withColumnRenamed("count", "n"), "k")
        assert sorted(joined.collect()) == sorted(joined.collect()) and joined.count() == 7


def test_runs_leave_no_steps_behind(spark, tmp_path):
    before = stored(spark)
    days = three_days(tmp_path / "in")
    warehouse = Warehouse(spark, str(tmp_path / "in"), str(tmp_path / "bronze"), str(tmp_path / "lake"))
    for day in days:
        warehouse.run_day(day)
    assert stored(spark) == before


def test_deliveries_are_packed_whole_and_in_files_of_bounded_size(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(runs, "FILE_LINES", 100)
    lines = spark.range(0, 1000, numPartitions=2).select(F.format_string('{"id": %d, "text": "the same text in every line"}', "id").alias("value"))
    warehouse = Warehouse(spark, str(tmp_path / "in"), str(tmp_path / "bronze"), str(tmp_path / "lake"))
    day = F.when(F.get_json_object("value", "$.id").cast("int") < 300, "2024-05-01").otherwise("2024-05-02")
    runs._by_day(lines, day, str(tmp_path), "events", warehouse)
    for name, wanted in (("2024-05-01", range(300)), ("2024-05-02", range(300, 1000))):
        folder = f"{tmp_path}/in/events/{name}.jsonl"
        delivered = spark.read.text(folder).select("value", F.get_json_object("value", "$.id").cast("int").alias("id"), F.input_file_name().alias("file"))
        assert sorted(r["id"] for r in delivered.collect()) == list(wanted)
        assert max(r["count"] for r in delivered.groupBy("file").count().collect()) <= 100
        assert sum(map(os.path.getsize, files(folder))) < sum(r["n"] for r in delivered.select(F.length("value").alias("n")).collect()) / 2


def test_a_check_against_a_fresh_build_leaves_one_lake(spark, tables):
    shared = local(shared_folder(spark))
    before = set(os.listdir(shared))
    df = entry_points.queries()["backfill_as_rebuilt"](spark, tables)
    con = duckdb.connect()
    for name in ("events", "conversations"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tables}/{name}.parquet'")
    wanted = con.execute(entry_points.oracle_sql()["backfill_as_rebuilt"]).fetchall()
    assert sorted(map(tuple, df.collect())) == sorted(wanted) and all(n for *_, n in wanted)
    # Of all that was written there is the warehouse: what landed, and the tables of the last commit.
    (work,) = set(os.listdir(shared)) - before
    warehouse, _ = runs._backfilled(spark, tables)
    held = {f"lake/{h['path']}" for slots in warehouse.lake.tables().values() for h in slots.values()}
    found = {os.path.relpath(os.path.dirname(f), f"{shared}/{work}") for f in files(f"{shared}/{work}")}
    assert {f for f in found if not f.startswith("bronze/")} == held
    landed = {f for f in found if f.startswith("bronze/")}
    assert landed == {f"bronze/{s}/ingest_date={d}" for s in ("events", "tickets", "transcripts") for d in warehouse.bronze.landed_days(s)}
