import json
import random
import threading
from functools import reduce

import pytest
from pyspark.sql import functions as F

from deliveries import change, export, three_days, ticket_row, write
from tidemark.functions.fingerprints import checksum
from tidemark.operators import cdc, chunks, features
from tidemark.operators.keyed import newest_generation
from tidemark.plans.daily import LOOKBACK_DAYS, SnapshotImmutableError, Warehouse, fresh_check, rerun_check
from tidemark.plans.flywheel import feature_leaks
from tidemark.plans.lake import Lake
from tidemark.session import together
from tidemark.sources import landing
from tidemark.sources.landing import read_json_array


def labels(spark, *tickets):
    return spark.createDataFrame([(t, "bug", "m", "p") for t in tickets], "ticket_id string, label string, model string, prompt_version string")


def names(lake):
    return sorted(r["ticket_id"] for r in lake.read("gold_ticket_labels").collect())


def test_a_run_is_published_whole_or_not_at_all(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    run = lake.begin()
    run.put("gold_ticket_labels", "one", labels(spark, "A"))
    run.append("gold_ticket_labels", labels(spark, "B"))
    assert names(lake) == [] and sorted(r[0] for r in run.read("gold_ticket_labels").collect()) == ["A", "B"]
    run.commit()
    assert names(lake) == ["A", "B"]
    failed = lake.begin()
    failed.replace("gold_ticket_labels", labels(spark, "C"))
    assert names(lake) == ["A", "B"]


def test_of_two_concurrent_runs_the_second_fails(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    a, b = lake.begin(), lake.begin()
    a.put("gold_ticket_labels", "s", labels(spark, "A"))
    b.put("gold_ticket_labels", "s", labels(spark, "B"))
    a.commit()
    with pytest.raises(FileExistsError):
        b.commit()
    assert names(lake) == ["A"]


def test_slots_of_dropped_values_do_not_survive(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    run = lake.begin()
    assert run.put_by("gold_ticket_labels", labels(spark, "A", "B", "C"), F.col("ticket_id"), lambda slot: False) == 3
    run.commit()
    run = lake.begin()
    run.put_by("gold_ticket_labels", labels(spark, "C", "D"), F.col("ticket_id"), lambda slot: slot in ("B", "C"))
    assert run.rows("gold_ticket_labels") == 3
    run.commit()
    assert names(lake) == ["A", "C", "D"]
    assert [r["ticket_id"] for r in lake.read("gold_ticket_labels", lambda slot: slot == "D").collect()] == ["D"]


def pieces(spark, *tickets):
    schema = "ticket_id string, chunk_idx int, chunk_text string, text_hash string, embedding_model_version string, embedding array<double>, category string, priority string, status string"
    return spark.createDataFrame([(t, k, text, "h", "m", [1.0], None, None, None) for k, (t, text) in enumerate(tickets)], schema)


def test_keys_are_replaced_by_what_is_appended(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "gold_doc_chunks" / "lake"))
    batches = [
        (["A", "B"], pieces(spark, ("A", "a1"), ("B", "b1"))), (["B", "C"], pieces(spark, ("B", "b2"), ("B", "b3"))), (["C", "A"], pieces(spark, ("C", "c3"))), (["A", "D"], pieces(spark)),
    ]
    written, before, rows = [], {}, []
    for n, (keys, rebuilt) in enumerate(batches):
        run = lake.begin()
        touched = spark.createDataFrame([(k,) for k in keys], "ticket_id string")
        written.append(run.append_keys("gold_doc_chunks", "ticket_id", touched, rebuilt, at_most=None if n % 2 else 2))
        rows.append(run.rows("gold_doc_chunks"))
        run.commit()
        # What was written before stays as it is.
        assert before.items() <= lake.tables()["gold_doc_chunks"].items()
        before = lake.tables()["gold_doc_chunks"]
    held = newest_generation(lake.read("gold_doc_chunks"), "ticket_id")
    assert sorted((r["ticket_id"], r["chunk_text"]) for r in held.collect()) == [("B", "b2"), ("B", "b3"), ("C", "c3")]
    # A key the table does not hold leaves no row; one that had rows and has none any more leaves one.
    assert written == [2, 2, 1, 0] and rows == [2, 4, 6, 7]


def test_small_slots_are_written_together(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    run = lake.begin()
    run.append("gold_ticket_labels", labels(spark, *"ABCDEFGH"))
    large = set(run.slots("gold_ticket_labels"))
    for ticket in "IJKL":
        run.append("gold_ticket_labels", labels(spark, ticket))
        run.compact("gold_ticket_labels", 3)
    run.commit()
    slots = lake.tables()["gold_ticket_labels"]
    assert len(slots) <= 3 and large <= set(slots) and names(lake) == list("ABCDEFGHIJKL")


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("warehouse")
    days = three_days(root / "in")
    warehouse = Warehouse(spark, str(root / "in"), str(root / "bronze"), str(root / "lake"))
    results = warehouse.backfill(days[0], days[-1])
    return warehouse, days, results


def test_bronze_lands_once_and_keeps_everything(built):
    warehouse, days, results = built
    assert results[0]["land"]["events"] == {"source": "events", "day": days[0], "status": "landed", "rows": 3}
    again = warehouse.bronze.land("events", days[0])
    assert (again["status"], again["rows"]) == ("already-landed", 3)
    assert warehouse.bronze.land("events", "2024-04-01")["status"] == "no-data"
    tickets = warehouse.bronze.scan("tickets")
    assert tickets.count() == 7 and tickets.where("_op IS NULL").count() == 1
    assert warehouse.bronze.scan("tickets", batch=days[1]).count() == 3
    assert warehouse.bronze.scan("tickets", upto=days[1]).count() == 5
    pruned = warehouse.bronze.scan("tickets", batch=days[1])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ingest_date" in pruned


def test_nothing_landed_is_a_typed_empty_table(spark, tmp_path):
    empty = Warehouse(spark, str(tmp_path), str(tmp_path / "b"), str(tmp_path / "l"))
    assert cdc.decode_changes(empty.bronze.scan("tickets")).count() == 0
    assert empty.lateness()["n"] == 0


def test_a_batch_is_parsed_once(built):
    warehouse, days, results = built
    assert [r["staged"] for r in results] == [{"tickets": [d], "events": [d]} for d in days]
    assert warehouse.stage(warehouse.lake.begin()) == {"tickets": [], "events": []}
    staged = warehouse.lake.read("stage_events")
    assert staged.where("reason IS NULL AND _payload IS NOT NULL").count() == 0


def test_raw_records_are_not_parsed_again_for_their_lateness(spark, tmp_path, monkeypatch):
    days = three_days(tmp_path / "in")
    warehouse = Warehouse(spark, str(tmp_path / "in"), str(tmp_path / "bronze"), str(tmp_path / "lake"))
    expected = warehouse.lateness()
    monkeypatch.setattr(features, "event_lateness", lambda bronze: pytest.fail("parsed again"))
    warehouse.backfill(days[0], days[-1])
    monkeypatch.undo()
    again = reduce(lambda a, b: a.unionByName(b), [features.event_lateness(warehouse.bronze.scan("events", batch=d)) for d in days])
    assert expected["n"] == 0 and warehouse.lateness() == features.lateness_profile(again).first().asDict()


def test_steps_of_a_day_run_together(spark, tmp_path):
    met = threading.Barrier(2, timeout=60)
    assert together(spark, a=lambda: met.wait() >= 0, b=lambda: met.wait() >= 0) == {"a": True, "b": True}
    ended = []
    with pytest.raises(ZeroDivisionError):
        together(spark, a=lambda: 1 // 0, b=lambda: ended.append(spark.range(10).count()))
    assert ended == [10]


def test_silver_tables(built, rows):
    warehouse, _, results = built
    assert rows(warehouse.tickets(warehouse.lake), "ticket_id", "priority", "status", "body", "is_deleted") == [
        ("A", "high", "closed", "write to <EMAIL> or <PHONE>", False), ("B", None, None, None, True), ("C", "low", "closed", "hello", False),
    ]
    history = warehouse.history(warehouse.lake)
    assert rows(history, "ticket_id", "_lsn", "is_current") == [("A", 10, False), ("A", 20, True), ("B", 11, False), ("B", 30, True), ("C", 21, True)]
    assert rows(warehouse.lake.read("silver_events"), "event_id") == [("e1",), ("e2",), ("e3",), ("e4",), ("late1",), ("late2",)]
    assert rows(warehouse.lake.read("quarantine_events"), "event_id", "reason") == [
        ("bad1", "rating: Input should be 'up' or 'down'"), ("bad2", "user_id: Input should be a valid string"),
    ]
    assert rows(warehouse.transcripts(warehouse.lake), "ticket_id", "n_turns") == [("A", 3), ("B", 1), ("X", 1)]
    assert [r["silver_events"]["inserted"] for r in results] == [2, 2, 2]


def test_late_events_reach_their_day_and_features_reconcile(built, rows):
    warehouse, _, _ = built
    got = rows(warehouse.lake.read("gold_feature_daily").withColumn("event_date", F.col("event_date").cast("string")))
    assert got == [("u1", "2024-03-01", 4, 3, 1, 0), ("u2", "2024-03-02", 1, 1, 0, 0), ("u2", "2024-03-03", 1, 0, 0, 1)]
    assert warehouse.features_reconcile()
    assert warehouse.lateness()["p99_days"] <= LOOKBACK_DAYS and warehouse.lookback_covers()


def test_snapshots_are_versions(built, rows):
    warehouse, _, _ = built
    got = rows(warehouse.lake.read("gold_training_set"), "snapshot_version", "ticket_id", "label", "priority_at_creation", "got_negative_feedback")
    assert got == [
        ("v2024-03-01", "B", "billing", "medium", False),
        ("v2024-03-02", "A", "bug", "low", False), ("v2024-03-02", "B", "billing", "medium", False), ("v2024-03-02", "C", "other", "low", False),
        ("v2024-03-03", "A", "bug", "low", False), ("v2024-03-03", "C", "other", "low", True),
    ]


def test_chunks_follow_deletes_and_newest_exports(built, rows):
    warehouse, _, results = built
    assert rows(warehouse.doc_chunks(warehouse.lake), "ticket_id", "chunk_idx", "chunk_text") == [("A", 0, "customer: one two agent: three agent: done")]
    assert results[0]["gold_doc_chunks"]["written"] == 2 and results[2]["gold_doc_chunks"]["embedded_new"] == 0


def test_no_personal_data_behind_bronze(built):
    warehouse, _, _ = built
    assert {r["n_leaks"] for r in warehouse.pii_leaks().collect()} == {0}


def test_promises_of_the_tables_hold(built):
    warehouse, _, _ = built
    tests = warehouse.table_tests().collect()
    assert len(tests) == 14 and {r["violations"] for r in tests} == {0}


def test_old_days_run_again_change_nothing(built):
    warehouse, days, _ = built
    sums = rerun_check(warehouse, days[0], times=2)
    assert sums[0] == sums[1] == sums[2]


def test_rebuild_from_bronze_gives_the_same_gold(built, tmp_path):
    warehouse, days, _ = built
    assert all(held == fresh for held, fresh in fresh_check(warehouse, str(tmp_path / "lake"), days).values())


def test_labels_are_cached_versioned_and_validated(built, rows):
    warehouse, _, _ = built
    assert warehouse.label_tickets() == {"asked": 2, "labelled": 1, "quarantined": 1}
    assert warehouse.label_tickets()["asked"] == 0
    assert warehouse.label_tickets(prompt_version="triage-v2")["asked"] == 2
    assert rows(warehouse.lake.read("gold_ticket_labels")) == [("A", "bug", "fake-llm-2026-09", "triage-v2")]


def test_a_changed_past_is_refused_and_leaves_all_tables(spark, tmp_path):
    root = tmp_path
    row = ticket_row("A", "2024-03-01T08:00:00", status="closed", category="bug")
    write(root / "in", "2024-03-01", tickets=[change("c", 1, "2024-03-01T08:00:00", "A", row)])
    warehouse = Warehouse(spark, str(root / "in"), str(root / "bronze"), str(root / "lake"))
    warehouse.run_day("2024-03-01")
    before, tables = warehouse.gold_checksums(), warehouse.lake.tables()
    # The same day out of another Bronze, against the published snapshot.
    write(root / "other", "2024-03-01", tickets=[change("c", 1, "2024-03-01T08:00:00", "A", {**row, "category": "other"})])
    changed = Warehouse(spark, str(root / "other"), str(root / "bronze2"), str(root / "lake"))
    with pytest.raises(SnapshotImmutableError):
        changed.run_day("2024-03-01")
    assert warehouse.lake.tables() == tables and warehouse.gold_checksums() == before


def test_a_batch_landed_late_cannot_rewrite_a_published_version(spark, tmp_path):
    row = ticket_row("A", "2024-03-01T08:00:00", status="closed", category="bug")
    write(tmp_path / "in", "2024-03-02", tickets=[change("c", 1, "2024-03-02T08:00:00", "A", row)])
    warehouse = Warehouse(spark, str(tmp_path / "in"), str(tmp_path / "bronze"), str(tmp_path / "lake"))
    warehouse.run_day("2024-03-02")
    write(tmp_path / "in", "2024-03-01", tickets=[change("c", 2, "2024-03-01T08:00:00", "B", {**row, "ticket_id": "B"})])
    warehouse.run_day("2024-03-01")
    with pytest.raises(SnapshotImmutableError):
        warehouse.run_day("2024-03-02")
    # History knows both tickets, and the version published first still holds one.
    assert warehouse.history(warehouse.lake).count() == 2
    assert warehouse.lake.read("gold_training_set").where("snapshot_version = 'v2024-03-02'").count() == 1


def test_merged_tables_are_compacted(spark, tmp_path, monkeypatch, rows):
    monkeypatch.setattr("tidemark.plans.daily.MAX_SLOTS", 1)
    root = tmp_path
    row = ticket_row("A", "2024-03-01T08:00:00")
    for n, day in enumerate(["2024-03-01", "2024-03-02"]):
        write(root / "in", day, tickets=[change("c" if n == 0 else "u", n + 1, f"{day}T08:00:00", "A", {**row, "priority": f"p{n}"})])
    warehouse = Warehouse(spark, str(root / "in"), str(root / "bronze"), str(root / "lake"))
    for day in ["2024-03-01", "2024-03-02"]:
        warehouse.bronze.land_day(day)
        run = warehouse.lake.begin()
        warehouse.stage(run)
        warehouse.upsert_tickets(run, day)
        run.commit()
    assert len(warehouse.lake.tables()["silver_tickets"]) == 1
    assert rows(warehouse.tickets(warehouse.lake), "priority", "_lsn") == [("p1", 2)]


def test_feature_leaks(spark):
    from test_features import sample

    assert feature_leaks(*sample(spark)) == 2


def test_incremental_features_equal_the_whole(built):
    warehouse, _, _ = built
    whole = features.daily_features(warehouse.lake.read("silver_events"))
    assert checksum(whole) == checksum(warehouse.lake.read("gold_feature_daily"))


def test_rows_written_follow_the_batch(spark, tmp_path):
    """Each day brings 20 new tickets and a change of an old one; no day writes the days before again."""
    warehouse = Warehouse(spark, str(tmp_path / "in"), str(tmp_path / "bronze"), str(tmp_path / "lake"))
    written = []
    for n, day in enumerate(["2024-03-01", "2024-03-02", "2024-03-03"]):
        fresh = [f"T{n}-{k}" for k in range(20)]
        changes = [change("c", 100 * n + k, f"{day}T08:00:00", t, ticket_row(t, f"{day}T08:00:00")) for k, t in enumerate(fresh)]
        if n:
            changes.append(change("u", 100 * n + 50, f"{day}T09:00:00", "T0-0", ticket_row("T0-0", f"{day}T08:00:00", priority="high")))
        exports = [export(t, f"{day}T10:00:00", ("customer", f"hello {t}")) for t in fresh]
        write(tmp_path / "in", day, tickets=changes, exports=exports)
        done = warehouse.run_day(day)
        written.append((done["silver_history"]["written"], done["gold_doc_chunks"]["written"]))
    # 20 new tickets and a change of an old one, whose last version ends by it.
    assert written == [(20, 20), (22, 21), (22, 21)]
    assert warehouse.history(warehouse.lake).count() == 62 and warehouse.doc_chunks(warehouse.lake).count() == 60


def test_all_files_of_a_day_land_and_arrays_are_read_by_record(spark, tmp_path):
    day = "2024-03-01"
    write(tmp_path / "in", day, exports=[export(t, f"{day}T10:00:00", ("customer", "hi")) for t in "AB"])
    (tmp_path / "in" / "transcripts" / f"{day}.jsonl").write_text(json.dumps(export("C", f"{day}T11:00:00", ("customer", "ho"))) + "\nbroken {\n", encoding="utf-8")
    warehouse = Warehouse(spark, str(tmp_path / "in"), str(tmp_path / "bronze"), str(tmp_path / "lake"))
    assert warehouse.bronze.land("transcripts", day)["rows"] == 4
    kept = chunks.decode_exports(warehouse.bronze.scan("transcripts")).where("ticket_id IS NOT NULL")
    assert sorted(r["ticket_id"] for r in kept.collect()) == ["A", "B", "C"]
    assert [r["reason"] for r in warehouse.unreadable("transcripts").collect()] == ["not one record"]


def test_arrays_keep_every_field_and_broken_ones_are_refused(spark, tmp_path):
    folder = tmp_path / "in" / "transcripts"
    folder.mkdir(parents=True)
    full = {"channel": {}, "exported_at": "2024-03-01T10:00:00Z", "note": None, "ticket_id": "A", "turns": []}
    (folder / "2024-03-01.json").write_text(json.dumps([full, "no object"], indent=1))
    broken = ['[{"ticket_id": "A"}, {"ticket', '[{"ticket_id": "A"}][{"ticket_id": "B"}]', '{"ticket_id": "A"}', "null", "\n"]
    for k, text in enumerate(broken):
        (folder / f"2024-04-0{k + 1}.json").write_text(text)
    warehouse = Warehouse(spark, str(tmp_path / "in"), str(tmp_path / "bronze"), str(tmp_path / "lake"))
    assert warehouse.bronze.land("transcripts", "2024-03-01")["rows"] == 2
    payloads = [json.loads(r["_payload"]) for r in warehouse.bronze.scan("transcripts").collect()]
    assert full in payloads and "no object" in payloads
    assert warehouse.unreadable("transcripts").count() == 1
    for k in range(len(broken)):
        for _ in range(2):
            with pytest.raises(Exception, match="MALFORMED_RECORD_IN_PARSING|no array"):
                warehouse.bronze.land("transcripts", f"2024-04-0{k + 1}")
    assert warehouse.bronze.scan("transcripts").count() == 2


def test_a_day_reads_the_state_before_and_its_batch(spark, tmp_path, monkeypatch):
    """History and snapshot of a later day scan no staged batch of an earlier one."""
    row = lambda t, **more: ticket_row(t, "2024-03-01T07:00:00", status="closed", category="bug", **more)
    days = ["2024-03-01", "2024-03-02", "2024-03-04"]
    for n, day in enumerate(days):
        write(tmp_path / "in", day, tickets=[change("c" if n == 0 else "u", 10 * n + k, f"{day}T08:00:00", f"T{k}", row(f"T{k}", priority=f"p{n}")) for k in range(5 - n)])
    warehouse = Warehouse(spark, str(tmp_path / "in"), str(tmp_path / "bronze"), str(tmp_path / "lake"))
    scanned = []
    from tidemark.plans import lake as lakes

    plain = lakes._scan

    def watched(lake, table, paths):
        scanned.append((table, len(paths)))
        return plain(lake, table, paths)

    monkeypatch.setattr(lakes, "_scan", watched)
    for day in days:
        scanned.clear()
        warehouse.run_day(day)
        assert max(n for table, n in scanned if table == "stage_ticket_changes") == 1
    held = warehouse.lake.read("gold_training_set").groupBy("snapshot_version").count().collect()
    assert sorted((r["snapshot_version"], r["count"]) for r in held) == [("v2024-03-01", 5), ("v2024-03-02", 5), ("v2024-03-04", 5)]
    # A replayed day is folded again from what is there, and is the same.
    sums = rerun_check(warehouse, days[0], times=1) + rerun_check(warehouse, days[1], times=1)
    assert all(s == sums[0] for s in sums)


def test_days_of_a_range(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "in"), str(tmp_path / "bronze"), str(tmp_path / "lake"))
    assert warehouse._days("2024-02-28", "2024-03-01") == ["2024-02-28", "2024-02-29", "2024-03-01"]
    assert warehouse._days("2024-03-02", "2024-03-01") == []


def test_kept_sums_are_those_of_the_rows(built):
    warehouse, days, _ = built
    rerun_check(warehouse, days[0], times=1)
    assert warehouse.gold_checksums() == warehouse.gold_checksums(read=True)
    assert set(warehouse.lake.sums("gold_training_set")) == {f"v{d}" for d in days}


def test_a_difference_names_its_day(spark, tmp_path):
    days = three_days(tmp_path / "in")
    one, two = (Warehouse(spark, str(tmp_path / "in"), str(tmp_path / f"bronze{n}"), str(tmp_path / f"lake{n}")) for n in (1, 2))
    one.backfill(days[0], days[-1])
    # The other one has not seen the last day.
    two.backfill(days[0], days[1])
    differing = one.differing_slots(two)
    assert days[-1] in differing["gold_feature_daily"] and differing["gold_training_set"] == [f"v{days[-1]}"]
    assert one.unreconciled_days() == [] == two.unreconciled_days()
    run = two.lake.begin()
    run.append("silver_events", one.lake.read("silver_events").where("event_id = 'e1'"))
    run.commit()
    assert len(two.unreconciled_days()) == 1


def array_of(spark, path, split_bytes=None):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    if split_bytes:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split_bytes)
        spark.conf.set("spark.sql.files.openCostInBytes", 1)
    try:
        found = read_json_array(spark, str(path)).select("file", "block", "pos", F.to_json("record").alias("r")).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before[0])
        spark.conf.set("spark.sql.files.openCostInBytes", before[1])
    return [json.loads(r["r"]) for r in sorted(found, key=lambda r: (r["file"], r["block"], r["pos"]))]


ODD_TEXTS = ['a } b', '{"not": "a record"}', '}}{{', 'quote " inside', "back\\slash \\\\ and \\\" more", '\\', '"', '}', '{', "é🙂}", "", "[", "]", '],[{"x":"', "line\nbreak }\n{"]


@pytest.mark.parametrize(("split_bytes", "indent"), [(None, None), (400, None), (900, 1)])
def test_one_array_is_read_by_many_tasks(spark, tmp_path, split_bytes, indent):
    rnd = random.Random(3)
    text = lambda: "".join(rnd.choices(ODD_TEXTS, k=rnd.randrange(4)))
    records = [{"id": n, text() + str(n): text(), "deep": [{"a": text(), "b": {"c": [text(), {}]}}, []], "e": {}} for n in range(120)]
    # Elements that are no objects stand between, before and after records.
    mixed = [text(), 5, None, *records[:40], [1, [2, {"z": "}"}]], "x", *records[40:], text(), True, []]
    (tmp_path / "a.json").write_text(json.dumps(mixed, indent=indent, ensure_ascii=False) + "\n", encoding="utf-8")
    assert array_of(spark, tmp_path / "a.json", split_bytes) == mixed


def test_arrays_of_all_shapes(spark, tmp_path):
    good = ["[]", " [ ] \n", "[1]", "[{}]", '[{"a":1}]', '\n[ {"a":1} ,\n {"b":"]"} ]\n', '["}"]', "", '[{"a":{"b":{}}},"x"]', "[[]]"]
    (tmp_path / "good").mkdir()
    for n, text in enumerate(good):
        (tmp_path / "good" / f"{n}.json").write_text(text)
    assert array_of(spark, tmp_path / "good") == [x for text in good if text for x in json.loads(text)]
    bad = ['[{"a":1}', '[{"a":1}}]', '[{"a":1},]', "[,1]", '[{"a":1}{"b":2}]', '{"a":1}', "5", '[{"a":1}]]', '[{"a":1}] []', '["a]', '[{"a":"x}]', '[{"a":1}]{', '[{"a":1},{"b":', "\n", "null", '[{"a":1},,{"b":1}]']
    for n, text in enumerate(bad):
        (tmp_path / f"bad{n}.json").write_text(text)
        with pytest.raises(Exception, match="MALFORMED_RECORD_IN_PARSING|no array"):
            array_of(spark, tmp_path / f"bad{n}.json")


def test_only_numbers_are_shuffled_to_find_where_records_end(spark, tmp_path, monkeypatch):
    summed = []
    plain = landing._prefix
    monkeypatch.setattr(landing, "_prefix", lambda pieces, column, name: summed.append(pieces.columns) or plain(pieces, column, name))
    (tmp_path / "a.json").write_text('[{"a":"\\"}"},\n{"b":{}}]')
    records = landing.read_json_array(spark, str(tmp_path / "a.json")).select(F.to_json("record"))
    assert sorted(r[0] for r in records.collect()) == ['{"a":"\\"}"}', '{"b":{}}']
    assert len(summed) == 3 and not any("value" in columns for columns in summed)


def test_a_line_is_parsed_once_to_find_its_day(spark):
    from tidemark.queries.runs import _ingest_day, _with_arrival

    lines = spark.createDataFrame([(f'{{"timestamp": {86_400_000 * n}}}',) for n in (0, 1, 2, 9)] + [("{",)], "value string")
    split = _with_arrival(lines).select("value", _ingest_day(F.col("arrived"), ["1970-01-01", "1970-01-02", "1970-01-03", "1970-01-04"]).alias("day"))
    assert [r["day"] for r in split.collect()] == ["1970-01-01", "1970-01-02", "1970-01-03", "1970-01-04", "1970-01-04"]
    assert split._jdf.queryExecution().optimizedPlan().toString().count("get_json_object") == 1


def test_sums_of_digests_are_those_of_whole_numbers(spark):
    from tidemark.functions.fingerprints import row_digest, sums_by

    df = spark.range(2000).selectExpr("id", "CAST(id % 3 AS STRING) AS part")
    digests = [r[0] for r in df.select(row_digest(df)).collect()]
    assert sums_by(df)[None] == (2000, sum(int(d[:15], 16) for d in digests), sum(int(d[16:31], 16) for d in digests))
    assert sums_by(df.limit(0)) == {} and sorted(sums_by(df, F.col("part"))) == ["0", "1", "2"]
