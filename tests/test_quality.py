import json

import pytest
from pyspark.sql import functions as F

from tidemark.operators import quality
from tidemark.operators.schemas import BRONZE, TABLES, ContractError, conform

OK = {"event_id": "e1", "user_id": "u1", "type": "feedback", "rating": "down", "event_time": "2026-08-12T21:10:00Z", "extra": 5}
CASES = [
    (OK, None),
    ({**OK, "type": "click", "rating": None}, None),
    ({**OK, "rating": "meh"}, "rating: Input should be 'up' or 'down'"),
    ({**OK, "rating": 1}, "rating: Input should be 'up' or 'down'"),
    ({**OK, "user_id": None}, "user_id: Input should be a valid string"),
    ({**OK, "user_id": 7}, "user_id: Input should be a valid string"),
    ({**OK, "user_id": ""}, "user_id: String should have at least 1 character"),
    ({k: v for k, v in OK.items() if k != "event_id"}, "event_id: Field required"),
    ({**OK, "event_id": None, "user_id": None}, "event_id: Input should be a valid string"),
    ({**OK, "type": "click"}, "record: Value error, click event must not carry a rating"),
    ({**OK, "rating": None}, "record: Value error, feedback event needs rating up/down"),
    ({k: v for k, v in OK.items() if k != "rating"}, "record: Value error, feedback event needs rating up/down"),
    ({**OK, "type": "view"}, "type: Input should be 'click' or 'feedback'"),
    ({k: v for k, v in OK.items() if k != "type"}, "type: Field required"),
    ({**OK, "ticket_id": 5}, "ticket_id: Input should be a valid string"),
    ({**OK, "page": ["x"]}, "page: Input should be a valid string"),
    ({**OK, "event_time": 1786784402}, None),
    ({**OK, "event_time": True}, "event_time: Input should be a valid datetime"),
    ({**OK, "event_time": "yesterday"}, "event_time: Input should be a valid datetime"),
    ({k: v for k, v in OK.items() if k != "event_time"}, "event_time: Field required"),
    ({**OK, "rating": "meh", "event_time": "yesterday"}, "rating: Input should be 'up' or 'down'"),
    (None, "event_id: Field required"),
    ("text", "record: value is not an object"),
    ([1], "record: value is not an object"),
]


def bronze(spark, payloads):
    data = [("events", "2026-08-13", None, 0, n, None, p) for n, p in enumerate(payloads)]
    return spark.createDataFrame(data, BRONZE)


def test_every_rule_and_its_reason(spark):
    payloads = [json.dumps({"value": v}) for v, _ in CASES] + ["{broken", '{"timestamp": 1}']
    gated = quality.gate_events(bronze(spark, payloads))
    got = [r["reason"] for r in gated.orderBy("_kafka_offset").collect()]
    assert got == [reason for _, reason in CASES] + ["record: not valid JSON", "event_id: Field required"]


def test_split_is_complete_and_types_the_time(spark):
    gated = quality.gate_events(bronze(spark, [json.dumps({"value": v}) for v, _ in CASES]))
    valid, bad = quality.valid_events(gated), quality.quarantined_events(gated)
    assert valid.count() == 3 and bad.count() == len(CASES) - 3
    assert str(valid.first()["event_time"]) == "2026-08-12 21:10:00"
    assert bad.where(F.col("event_id").isNull() & F.col("_payload").isNull()).count() == 0


def test_zone_is_converted_to_utc(spark):
    gated = quality.gate_events(bronze(spark, [json.dumps({"value": {**OK, "event_time": "2026-08-12T21:10:00+07:00"}})]))
    assert str(gated.first()["event_time"]) == "2026-08-12 14:10:00"


def test_predicate_form_agrees_with_the_gate(spark):
    gated = quality.gate_events(bronze(spark, [json.dumps({"value": v}) for v, _ in CASES if isinstance(v, dict)]))
    # The predicate sees text only, so ids and pages of other types pass it.
    assert {r["reason"] for r in quality.passing_events(gated).collect()} == {
        None, "user_id: Input should be a valid string", "ticket_id: Input should be a valid string", "page: Input should be a valid string",
    }


def test_a_record_is_parsed_once(spark):
    plan = quality.valid_events(quality.gate_events(bronze(spark, ["{}"])))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parseJson") == 1


def test_table_tests(spark, rows):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 1, None), ("a", 2, "y"), (None, 3, "z"), ("b", 4, "x"), ("b", 5, "q")], "k string, n int, c string")
    out = quality.table_tests(df, not_null=["k", "n"], accepted={"c": ["x", "y", "z"]}, unique=[["k"], ["k", "n"]])
    assert dict(rows(out)) == {"not_null(k)": 1, "not_null(n)": 0, "accepted_values(c)": 1, "unique(k)": 2, "unique(k, n)": 1}


def test_pii_scan_counts_leaks_per_source(spark, rows):
    df = spark.createDataFrame([("a@b.co",), ("call 0912345678",), ("clean",), (None,)], "t string")
    assert rows(quality.pii_scan({"one": (df, "t"), "two": (df.where("t = 'clean'"), "t")})) == [("one", 3, 2), ("two", 1, 0)]


def test_profile_counts_tombstones_and_redeliveries(spark):
    data = [("t", "d", None, 0, 1, "c", "{}"), ("t", "d", None, 0, 1, "c", "{}"), ("t", "d", None, 1, 1, None, "{}"), ("t", "d", None, 0, 2, "u", "{}")]
    data += [("t", "d", None, None, None, None, bad) for bad in ('{"value": {"op', '[{"value": null}, {"value": null}]', "7")]
    bronze = spark.createDataFrame(data, BRONZE)
    assert tuple(quality.bronze_profile(bronze).first()) == (7, 3, 1, 1)
    assert sorted(r["reason"] for r in quality.unreadable_records(bronze).collect()) == ["not one record", "not one record", "not valid JSON"]


def test_contract_orders_columns_and_refuses_others(spark):
    schema = TABLES["gold_ticket_labels"]
    good = spark.createDataFrame([("v", "m", "bug", "T")], "prompt_version string, model string, label string, ticket_id string")
    assert conform(good, schema).columns == schema.names
    for wrong in (good.drop("model"), good.withColumn("more", F.lit(1)), good.withColumn("model", F.lit(1))):
        with pytest.raises(ContractError):
            conform(wrong, schema)


def test_gate_takes_a_record_apart_once(spark):
    from tidemark.sources.landing import kafka_records

    lines = spark.createDataFrame([("{}",)], "value string")
    plan = quality.gate_events(kafka_records(lines, "events", "2024-03-01", with_op=False))._jdf.queryExecution().optimizedPlan().toString()
    assert 1 <= plan.count("$.value") <= 2
