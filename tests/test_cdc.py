import json
import random
from functools import reduce

import pytest
from pyspark.sql import functions as F

from deliveries import change, ticket_row, tombstone
from tidemark.operators import cdc
from tidemark.operators.schemas import TABLES, conform
from tidemark.sources.landing import kafka_records


def changes(spark, records, day="2024-03-01"):
    lines = spark.createDataFrame([(json.dumps(r, ensure_ascii=False),) for r in records], "value string")
    return cdc.decode_changes(kafka_records(lines, "tickets", day, with_op=True))


def no_events(spark):
    return spark.createDataFrame([], "ticket_id string, type string, rating string, _batch_id string")


def test_decode_takes_a_deletes_key_from_before_and_drops_tombstones(spark, rows):
    keyless = {**change("u", 9, "2024-03-01T08:00:00", "Z"), "value": {"op": "u", "before": None, "after": {}, "source": {"lsn": 9, "ts_ms": 0}}}
    row = ticket_row("A", "2024-03-01T07:00:00")
    got = changes(spark, [change("c", 1, "2024-03-01T08:00:00", "A", row), change("d", 2, "2024-03-01T09:00:00", "B"), tombstone(3, "2024-03-01T09:00:01"), keyless])
    assert rows(got, "ticket_id", "_op", "_lsn") == [("A", "c", 1), ("B", "d", 2)]
    first = got.where("ticket_id = 'A'").first()
    assert str(first["_changed_at"]) == "2024-03-01 08:00:00" and str(first["created_at"]) == "2024-03-01 07:00:00"


def test_state_masks_text_and_keeps_a_delete_as_nulls(spark, rows):
    low = ticket_row("T-1", "2024-03-01T07:00:00", body="mail a@b.co")
    high = {**low, "priority": "high", "category": "bug"}
    got = cdc.ticket_state(changes(spark, [change("u", 20, "2024-03-01T09:00:00", "T-1", high), change("c", 10, "2024-03-01T08:00:00", "T-1", low), change("d", 30, "2024-03-01T10:00:00", "T-2")]))
    assert rows(got, "ticket_id", "priority", "category", "body", "is_deleted", "_lsn") == [
        ("T-1", "high", "bug", "mail <EMAIL>", False, 20), ("T-2", None, None, None, True, 30),
    ]


def log(seed, n=300):
    rnd = random.Random(seed)
    out = []
    for lsn in range(n):
        ticket = "hot" if rnd.random() < 0.8 else rnd.choice("ABC")
        at = f"2024-03-01T{rnd.randrange(24):02d}:{rnd.randrange(60):02d}:00"
        row = ticket_row(ticket, at, priority=rnd.choice(["low", "high"]))
        record = change("d" if rnd.random() < 0.05 else "u", lsn, at, ticket, row)
        out.append(record)
        if rnd.random() < 0.2:
            out.append({**record, "timestamp": record["timestamp"] + 60000})
    rnd.shuffle(out)
    return out


def brute_history(records):
    versions = {}
    for r in records:
        v = r["value"]
        ticket = (v["after"] or v["before"])["ticket_id"]
        versions.setdefault(ticket, {})[v["source"]["lsn"]] = v
    out = []
    for ticket, by_lsn in versions.items():
        ordered = sorted(by_lsn)
        for lsn, after in zip(ordered, [*ordered[1:], None]):
            end = by_lsn[after]["source"]["ts_ms"] if after is not None else None
            out.append((ticket, lsn, by_lsn[lsn]["op"] == "d", by_lsn[lsn]["source"]["ts_ms"], end, end is None))
    return sorted(out, key=repr)


@pytest.fixture(params=[1, 13])
def ranges(spark, request):
    """Few and many ranges to deal rows over."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", request.param)
    yield request.param
    spark.conf.set("spark.sql.shuffle.partitions", before)


def test_history_equals_brute_force(spark, ranges):
    records = log(7)
    got = cdc.scd2(changes(spark, records))
    ms = lambda c: F.unix_millis(F.col(c).cast("timestamp"))
    out = got.select("ticket_id", "_lsn", "is_deleted", ms("valid_from"), ms("valid_to"), "is_current")
    assert sorted((tuple(r) for r in out.collect()), key=repr) == brute_history(records)


def test_snapshot_is_as_of_its_day(spark, rows):
    low = ticket_row("A", "2024-03-01T07:00:00", priority="low", subject="s", body="b")
    closed = {**low, "priority": "high", "status": "closed", "category": "bug"}
    day1 = changes(spark, [change("c", 1, "2024-03-01T08:00:00", "A", low), change("u", 2, "2024-03-01T09:00:00", "A", closed), change("u", 2, "2024-03-01T09:00:00", "A", closed, arrived="2024-03-01T09:05:00")])
    # B has no creation record, C no subject, D is deleted later.
    b = {**closed, "ticket_id": "B"}
    c = {**closed, "ticket_id": "C", "subject": None}
    d = {**closed, "ticket_id": "D"}
    more = changes(spark, [change("u", 3, "2024-03-01T08:00:00", "B", b), change("c", 4, "2024-03-01T08:00:00", "C", c), change("c", 5, "2024-03-01T08:00:00", "D", d)])
    day2 = changes(spark, [change("d", 6, "2024-03-02T08:00:00", "D")], day="2024-03-02")
    log_ = day1.unionByName(more).unionByName(day2)
    events = spark.createDataFrame(
        [("A", "feedback", "up", "2024-03-01"), ("A", "feedback", "down", "2024-03-02"), (None, "feedback", "down", "2024-03-01"), ("C", "click", None, "2024-03-01")],
        "ticket_id string, type string, rating string, _batch_id string",
    )
    columns = ("snapshot_version", "ticket_id", "text", "priority_at_creation", "got_negative_feedback")
    assert rows(cdc.training_snapshot(log_, events, "2024-03-01"), *columns) == [
        ("v2024-03-01", "A", "s. b", "low", False), ("v2024-03-01", "C", None, "high", False), ("v2024-03-01", "D", "s. b", "high", False),
    ]
    assert rows(cdc.training_snapshot(log_, events, "2024-03-02"), *columns) == [
        ("v2024-03-02", "A", "s. b", "low", True), ("v2024-03-02", "C", None, "high", False),
    ]


def test_snapshot_shuffles_the_log_once(spark):
    row = ticket_row("A", "2024-03-01T07:00:00")
    snapshot = cdc.training_snapshot(changes(spark, [change("c", 1, "2024-03-01T08:00:00", "A", row)]), no_events(spark), "2024-03-01")
    plan = snapshot._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(ticket_id") <= 2


def history_of(spark, batches):
    """Rows written for each batch of records, and the history they leave."""
    kept = spark.createDataFrame([], TABLES["silver_ticket_history"])
    written = []
    for n, records in enumerate(batches):
        delta = cdc.history_delta(kept, changes(spark, records), len(records)).withColumn("_generation", F.lit(n).cast("bigint"))
        delta = spark.createDataFrame(delta.select(kept.columns).collect(), kept.schema)
        written.append(delta.count())
        kept = kept.unionByName(delta)
    return written, cdc.current_versions(kept)


@pytest.mark.parametrize("seed", [3, 4])
def test_history_by_deltas_equals_brute_force(spark, seed):
    # Sequence numbers arrive in any order, redeliveries in other batches.
    records = log(seed)
    batches = [records[k::5] for k in range(5)]
    written, history = history_of(spark, batches)
    ms = lambda c: F.unix_millis(F.col(c).cast("timestamp"))
    out = history.select("ticket_id", "_lsn", "is_deleted", ms("valid_from"), ms("valid_to"), "is_current")
    assert sorted((tuple(r) for r in out.collect()), key=repr) == brute_history(records)
    assert all(n <= 2 * len(batch) for n, batch in zip(written, batches))


def test_a_batch_writes_its_changes_and_their_neighbours(spark):
    row = lambda t: ticket_row(t, "2024-03-01T08:00:00")
    at = lambda lsn, t="A": change("u", lsn, f"2024-03-01T08:{lsn:02d}:00", t, row(t))
    batches = [[at(n) for n in range(10, 30, 2)], [at(30)], [at(15)], [at(5)], [at(15), at(30)], [at(1, "B")]]
    written, history = history_of(spark, batches)
    # All; the new one and the last before; the new one and the one before; the new first one; nothing; another ticket.
    assert written == [10, 2, 2, 1, 0, 1]
    assert history.where("is_current").count() == 2 and history.count() == 14


def test_snapshots_from_the_state_before_and_a_batch(spark, rows):
    records = {day: [] for day in ("2024-03-01", "2024-03-02", "2024-03-03")}
    rnd = random.Random(5)
    for lsn in range(120):
        day, ticket = rnd.choice(list(records)), f"T{rnd.randrange(15)}"
        row = ticket_row(ticket, "2024-03-01T07:00:00", priority=rnd.choice(["low", "high", None]), status=rnd.choice(["open", "closed"]), category=rnd.choice(["bug", None]), subject="s", body="b")
        records[day].append(change(rnd.choice("crud"), lsn, f"{day}T{rnd.randrange(24):02d}:00:00", ticket, row))
    events = spark.createDataFrame(
        [(rnd.choice([f"T{k}", None]), rnd.choice(["feedback", "click"]), rnd.choice(["up", "down"]), rnd.choice(list(records))) for k in range(15)],
        "ticket_id string, type string, rating string, _batch_id string",
    )
    batches = {day: changes(spark, own, day=day) for day, own in records.items()}
    log_ = reduce(lambda a, b: a.unionByName(b), batches.values())
    state = None
    for day, batch in batches.items():
        state = cdc.training_state(state, batch, events.where(F.col("_batch_id") == day))
        state = spark.createDataFrame(state.collect(), state.schema)
        conform(state, TABLES["training_state"])
        assert rows(cdc.snapshot_of(state, day)) == rows(cdc.training_snapshot(log_, events, day))


def test_feedback_by_ticket(spark, rows):
    events = spark.createDataFrame(
        [("A", "feedback", "up"), ("A", "feedback", "down"), ("A", "feedback", "down"), ("B", "feedback", "up"), ("C", "click", None), (None, "feedback", "down")],
        "ticket_id string, type string, rating string",
    )
    assert rows(cdc.feedback_by_ticket(events)) == [("A", True), ("B", False)]
