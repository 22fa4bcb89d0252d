"""Whole runs over files written from the tables: landing, the daily run, streams.

Deliveries and results go to a new folder below the shared one for every call.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.records import once
from tidemark.operators import features, quality
from tidemark.operators.keyed import latest_by
from tidemark.operators.schemas import TABLES, ContractError
from tidemark.plans.daily import Warehouse, fresh_check
from tidemark.plans.flywheel import flywheel
from tidemark.plans.lake import Lake
from tidemark.queries.events import _FEATURES, _day_as_text, _purchases, _spend
from tidemark.queries.inputs import CHANGE_SQL, EVENT_SQL, EXPORT_SQL, answer_turns, change_lines, event_lines, export_objects, gated_events, table
from tidemark.queries.registry import Registry
from tidemark.queries.texts import _EMBED_SQL, _chunk_sql, _vector, mask_sql
from tidemark.queries.tickets import snapshot_sql
from tidemark.queries.traces import CLEAN_PAIRS_SQL, EVAL_SQL
from tidemark.session import brief_shuffles, setting, shared_folder
from tidemark.sources.folders import Folders
from tidemark.sources.landing import kafka_records
from tidemark.streaming import streams

registry = Registry()
# All rows are delivered on this ingest day.
DAY = "2024-01-31"
# The ingest day of a delivery that is cut off.
BROKEN_DAY = "2024-02-01"


def _work_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/tidemark-{uuid.uuid4().hex}"


def _arrival(lines: DataFrame) -> F.Column:
    return F.timestamp_millis(F.get_json_object("value", "$.timestamp").cast("bigint"))


def _quarter(k: int) -> str:
    """SQL for the k-th of four ingest days: they part the time from the first arrival to the day after the last."""
    return f"""(SELECT strftime(lo + CAST((hi - lo) * {k} // 4 AS INTEGER), '%Y-%m-%d')
                FROM (SELECT CAST(min(arrived) AS DATE) AS lo, CAST(max(arrived) AS DATE) + 1 AS hi FROM ({EVENT_SQL})))"""


def _ingest_days(spark: SparkSession, sf: str) -> tuple[list[str], int]:
    """The four ingest days, and how many days the first event lies before the last of them."""
    events = table(spark, sf, "events")
    arrived = F.to_date(F.timestamp_millis(F.unix_millis(F.col("ts").cast("timestamp")) + (F.floor("value") % 4) * 86_400_000))
    reach = events.agg(F.min(arrived).alias("lo"), F.date_add(F.max(arrived), 1).alias("hi"), F.to_date(F.min("ts")).alias("first"))
    quarter = lambda k: F.date_add("lo", F.expr(f"CAST(datediff(hi, lo) * {k} DIV 4 AS INT)")).cast("string")
    row = reach.select(F.array(*[quarter(k) for k in (1, 2, 3, 4)]).alias("days"), F.datediff("hi", "first").alias("lookback")).first()
    return row["days"], row["lookback"]


def _deliver(spark: SparkSession, sf: str, folder: str, day: str, lookback_days: int) -> Warehouse:
    """The records of each source as one delivery, in lines."""
    event_lines(spark, sf).write.text(f"{folder}/in/events/{day}.jsonl")
    change_lines(spark, sf).write.text(f"{folder}/in/cdc/tickets/{day}.jsonl")
    export_objects(spark, sf).write.text(f"{folder}/in/transcripts/{day}.jsonl")
    return Warehouse(spark, f"{folder}/in", f"{folder}/bronze", f"{folder}/lake", lookback_days)


@registry.query("""
SELECT 'events' AS source, 'landed' AS first, 'already-landed' AS second, 2 * count(*) AS n_rows FROM events
UNION ALL SELECT 'tickets', 'landed', 'already-landed', 2 * count(*) FROM events
UNION ALL SELECT 'transcripts', 'landed', 'already-landed', count(*) FROM conversations""")
def landing(spark: SparkSession, sf: str) -> DataFrame:
    """Records land once, however often the day is run; exports come in two files, lines and arrays.

    Exports have fields that nothing reads, and one that lost them is not counted. An array that is cut
    off is refused and lands nothing.
    """
    folder = _work_folder(spark)
    event_lines(spark, sf).write.text(f"{folder}/in/events/{DAY}.jsonl")
    change_lines(spark, sf).write.text(f"{folder}/in/cdc/tickets/{DAY}.jsonl")
    more = F.concat(F.lit('{"channel":{"name":"chat"},"tags":{},'), F.expr("substr(value, 2)"))
    exports = export_objects(spark, sf).withColumn("in_lines", F.xxhash64("value") % 2 == 0).withColumn("value", more)
    exports.where("in_lines").select("value").write.text(f"{folder}/in/transcripts/{DAY}.jsonl")
    # Files of one array each: the exports of 50 conversations.
    number = F.get_json_object("value", "$.ticket_id").substr(3, 20).cast("bigint")
    listed = exports.where("NOT in_lines").groupBy(F.floor(number / 50).alias("part")).agg(F.collect_list("value").alias("all"))
    array = F.concat(F.lit("[\n"), F.array_join("all", ",\n"), F.lit("\n]"))
    listed.select("part", array.alias("value")).write.partitionBy("part").text(f"{folder}/in/transcripts/{DAY}.json")
    bronze = Warehouse(spark, f"{folder}/in", f"{folder}/bronze", f"{folder}/lake").bronze
    parts = []
    for source in ("events", "tickets", "transcripts"):
        first, second = bronze.land(source, DAY), bronze.land(source, DAY)
        whole = F.col("_payload").contains('"channel":{"name":"chat"}') & F.col("_payload").contains('"tags":{}')
        counted = bronze.scan(source, batch=DAY).agg(F.count_if(whole if source == "transcripts" else F.lit(True)).alias("n_rows"))
        parts.append(counted.select(
            F.lit(source).alias("source"), F.lit(first["status"]).alias("first"), F.lit(second["status"]).alias("second"), "n_rows"
        ))
    cut = exports.orderBy("value").limit(1).select(F.concat(F.lit("[\n"), "value", F.lit(",\n{")).alias("value"))
    cut.write.text(f"{folder}/in/transcripts/{BROKEN_DAY}.json")
    try:
        bronze.land("transcripts", BROKEN_DAY)
    except Exception as refused:
        if "MALFORMED_RECORD_IN_PARSING" not in str(refused) and "no array" not in str(refused):
            raise
    else:
        raise AssertionError("a cut-off array has landed")
    return reduce(DataFrame.unionByName, parts)


@registry.query(f"""
SELECT 'silver_events' AS table_name, count(*) AS n_rows FROM ({EVENT_SQL}) WHERE reason IS NULL
UNION ALL SELECT 'quarantine_events', 2 * count(*) FROM ({EVENT_SQL}) WHERE reason IS NOT NULL
UNION ALL SELECT 'silver_tickets', count(DISTINCT ticket_id) FROM ({CHANGE_SQL})
UNION ALL SELECT 'silver_ticket_history', count(*) FROM ({CHANGE_SQL})
UNION ALL SELECT 'silver_transcripts', count(DISTINCT conv_id) FROM conversations
UNION ALL SELECT 'gold_feature_daily', count(DISTINCT (user_id, CAST(ts AS DATE))) FROM ({EVENT_SQL}) WHERE reason IS NULL""")
def daily_run(spark: SparkSession, sf: str) -> DataFrame:
    """Everything delivered on one day, run, and run again: the tables and their sizes."""
    days, lookback = _ingest_days(spark, sf)
    warehouse = _deliver(spark, sf, _work_folder(spark), days[-1], lookback)
    warehouse.run_day(days[-1])
    again = warehouse.run_day(days[-1])
    assert again["gold_training_set"]["status"] == "unchanged"
    lake = warehouse.lake
    tables = {n: lake.read(n) for n in ("silver_events", "quarantine_events", "silver_tickets", "silver_transcripts", "gold_feature_daily")}
    tables["silver_ticket_history"] = warehouse.history(lake)
    sizes = [df.agg(F.lit(n).alias("table_name"), F.count(F.lit(1)).alias("n_rows")) for n, df in tables.items()]
    return reduce(DataFrame.unionByName, sizes)


def _ingest_day(arrived: F.Column, days: list[str]) -> F.Column:
    """What arrives up to a day is delivered on it, the rest on the last."""
    late = F.lit(days[-1])
    for d in reversed(days[:-1]):
        late = F.when(arrived <= d, d).otherwise(late)
    return late


def _with_arrival(lines: DataFrame) -> DataFrame:
    """Lines with the day they arrived on, for which each is parsed once."""
    return lines.select("value", once(F.date_format(_arrival(lines), "yyyy-MM-dd")).alias("arrived"))


# Lines in one file of a delivery. A packed file is read by one task, so large deliveries come in many.
FILE_LINES = 500_000


def _by_day(lines: DataFrame, day: F.Column, folder: str, source: str, warehouse: Warehouse) -> None:
    """Writes each day's lines as that day's delivery, packed in a sixth of their space."""
    dealt = lines.select("value", day.alias("day")).write.partitionBy("day")
    # With a file open for each of the few days no task sorts its lines by day, which would spill them all.
    with setting(warehouse.spark, "spark.sql.maxConcurrentOutputFileWriters", "8"):
        dealt.option("compression", "lz4").option("maxRecordsPerFile", FILE_LINES).text(f"{folder}/all/{source}")
    for name in warehouse.lake.folders.names(f"{folder}/all/{source}"):
        if name.startswith("day="):
            warehouse.lake.folders.move(f"{folder}/all/{source}/{name}", f"{folder}/in/{source}/{name.removeprefix('day=')}.jsonl")


# Built over the same files in the same session, the tables of a backfill are only read again.
_BUILT: dict[tuple, tuple[Warehouse, list[str]]] = {}


def _backfilled(spark: SparkSession, sf: str) -> tuple[Warehouse, list[str]]:
    """Deliveries of all sources on four days, all run in order, then an old one again."""
    folders = Folders(spark)
    changed = tuple(folders.changed_at(f"{sf}/{name}.parquet") for name in ("events", "conversations"))
    key = (spark.sparkContext.applicationId, sf, changed)
    if key in _BUILT:
        return _BUILT[key]
    folder = _work_folder(spark)
    days, lookback = _ingest_days(spark, sf)
    warehouse = Warehouse(spark, f"{folder}/in", f"{folder}/bronze", f"{folder}/lake", lookback)
    # Exports of the tickets the changes are about; those of later turns come on later days.
    turn = F.hour(F.to_timestamp(F.get_json_object("value", "$.exported_at")))
    by_turn = F.element_at(F.array(*[F.lit(d) for d in days]), F.least(F.floor(turn / 2), F.lit(3)).cast("int") + 1)
    with brief_shuffles(spark):
        for lines, source in ((event_lines, "events"), (change_lines, "cdc/tickets")):
            _by_day(_with_arrival(lines(spark, sf)), _ingest_day(F.col("arrived"), days), folder, source, warehouse)
        _by_day(export_objects(spark, sf, prefix="T-"), by_turn, folder, "transcripts", warehouse)
        for day in (*days, days[1]):
            warehouse.run_day(day)
            warehouse.lake.vacuum()
            # What has landed is not read from its delivery again.
            for source in ("events", "cdc/tickets", "transcripts"):
                folders.remove(f"{folder}/in/{source}/{day}.jsonl")
    _BUILT[key] = warehouse, days
    return _BUILT[key]


@registry.query(f"{_FEATURES} FROM ({EVENT_SQL}) WHERE reason IS NULL GROUP BY ALL")
def backfill_features(spark: SparkSession, sf: str) -> DataFrame:
    """Features after a backfill with late events and a day run again."""
    return _day_as_text(_backfilled(spark, sf)[0].lake.read("gold_feature_daily"))


_SNAPSHOTS_SQL = " UNION ".join(f"SELECT * FROM ({snapshot_sql(_quarter(k))})" for k in (1, 2, 3, 4))


@registry.query(_SNAPSHOTS_SQL)
def backfill_snapshots(spark: SparkSession, sf: str) -> DataFrame:
    """The training snapshot of every day, each as it was then."""
    warehouse, _ = _backfilled(spark, sf)
    return warehouse.lake.read("gold_training_set").withColumn("created_date", F.col("created_date").cast("string"))


@registry.query(f"""
SELECT ticket_id, priority, status, category, op = 'd' AS is_deleted, changed_at AS valid_from,
       lead(changed_at) OVER w AS valid_to, lead(changed_at) OVER w IS NULL AS is_current, CAST(lsn AS BIGINT) AS lsn
FROM ({CHANGE_SQL}) WINDOW w AS (PARTITION BY ticket_id ORDER BY lsn)""")
def backfill_history(spark: SparkSession, sf: str) -> DataFrame:
    """Every version of every ticket, appended interval by interval."""
    warehouse, _ = _backfilled(spark, sf)
    return warehouse.history(warehouse.lake).withColumnRenamed("_lsn", "lsn")


_TRANSCRIPT_SQL = f"""
SELECT x.ticket_id AS doc, {mask_sql('x.text')} AS text, t.priority, t.status
FROM (SELECT * FROM ({EXPORT_SQL.replace("'C-'", "'T-'")}) QUALIFY row_number() OVER (PARTITION BY ticket_id ORDER BY turn DESC) = 1) x
JOIN (SELECT * FROM ({CHANGE_SQL}) QUALIFY row_number() OVER (PARTITION BY ticket_id ORDER BY lsn DESC) = 1) t
  ON t.ticket_id = x.ticket_id AND t.op <> 'd'
"""


@registry.query(f"""
SELECT c.doc AS ticket_id, c.chunk_idx, c.chunk_text, l.priority, l.status, e.vector
FROM ({_chunk_sql(_TRANSCRIPT_SQL)}) c JOIN ({_TRANSCRIPT_SQL}) l ON l.doc = c.doc
JOIN ({_EMBED_SQL % f"(SELECT DISTINCT sha256(chunk_text) AS text_hash, chunk_text FROM ({_chunk_sql(_TRANSCRIPT_SQL)}))"}) e ON e.text_hash = sha256(c.chunk_text)""")
def backfill_chunks(spark: SparkSession, sf: str) -> DataFrame:
    """The document index with vectors: newest exports of tickets that are not deleted."""
    warehouse, _ = _backfilled(spark, sf)
    indexed = warehouse.doc_chunks(warehouse.lake)
    return indexed.select("ticket_id", "chunk_idx", "chunk_text", "priority", "status", _vector(F.col("embedding")).alias("vector"))


@registry.query(f"""
SELECT 'gold_feature_daily' AS table_name, true AS as_rebuilt, count(*) AS n_rows
FROM (SELECT DISTINCT user_id, CAST(ts AS DATE) FROM ({EVENT_SQL}) WHERE reason IS NULL)
UNION ALL SELECT 'gold_training_set', true, count(*) FROM ({_SNAPSHOTS_SQL})
UNION ALL SELECT 'gold_doc_chunks', true, count(*) FROM ({_chunk_sql(_TRANSCRIPT_SQL)})""")
def backfill_as_rebuilt(spark: SparkSession, sf: str) -> DataFrame:
    """Whether each Gold table equals that of a fresh build from the same Bronze."""
    warehouse, days = _backfilled(spark, sf)
    fresh = _work_folder(spark)
    same = {t: a == b for t, (a, b) in fresh_check(warehouse, f"{fresh}/lake", days).items() if t != "gold"}
    # Only the checksums of the fresh build are asked for.
    Folders(spark).remove(fresh)
    sizes = [
        warehouse.gold(t).agg(F.lit(t).alias("table_name"), F.lit(equal).alias("as_rebuilt"), F.count(F.lit(1)).alias("n_rows"))
        for t, equal in same.items()
    ]
    return reduce(DataFrame.unionByName, sizes)


@registry.query(f"""
SELECT 'gold_feature_daily' AS table_name, 'n_events: want LongType(), got StringType()' AS refused, count(*) AS n_rows
FROM (SELECT DISTINCT user_id, CAST(ts AS DATE) FROM ({EVENT_SQL}) WHERE reason IS NULL)
UNION ALL
SELECT 'silver_events', 'note: want None, got StringType(); page: want StringType(), got None', count(*) FROM ({EVENT_SQL}) WHERE reason IS NULL""")
def refused_contracts(spark: SparkSession, sf: str) -> DataFrame:
    """Tables that break their contract are refused with what is wrong, and leave what was there."""
    folder = _work_folder(spark)
    lake = Lake(spark, f"{folder}/lake")
    events = latest_by(quality.valid_events(gated_events(spark, sf)), ["event_id"], [F.col("_ingested_at")])
    sound = {"silver_events": events.select(TABLES["silver_events"].names), "gold_feature_daily": features.daily_features(events)}
    broken = {
        "silver_events": sound["silver_events"].withColumnRenamed("page", "note"),
        "gold_feature_daily": sound["gold_feature_daily"].withColumn("n_events", F.col("n_events").cast("string")),
    }
    run = lake.begin()
    for name, df in sound.items():
        run.append(name, df)
    run.commit()
    told = []
    for name, df in broken.items():
        run = lake.begin()
        try:
            run.append(name, df)
            run.commit()
        except ContractError as error:
            told.append((name, str(error)))
    said = spark.createDataFrame(told, "table_name string, refused string")
    counted = [lake.read(name).agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n_rows")) for name in sound]
    return said.join(reduce(DataFrame.unionByName, counted), "table_name").select("table_name", "refused", "n_rows")


def _flywheel(spark: SparkSession, sf: str, data_set: str, arrays: bool = False) -> DataFrame:
    """One of the data sets the trace job writes as JSON lines, read back."""
    folder = _work_folder(spark)
    lines = answer_turns(spark, sf).select(F.col("trace_ord.pos").alias("pos"), F.to_json("root").alias("value"))
    if arrays:
        # Files of one array each, with 50 traces.
        listed = lines.groupBy(F.floor(F.col("pos") / 50).alias("part")).agg(F.array_join(F.array_sort(F.collect_list("value")), ",\n").alias("all"))
        listed.select("part", F.concat(F.lit("[\n"), "all", F.lit("\n]")).alias("value")).write.partitionBy("part").text(f"{folder}/traces.json")
    else:
        lines.orderBy("pos").select("value").write.text(f"{folder}/traces.jsonl")
    counts = flywheel(spark, f"{folder}/traces.json{'' if arrays else 'l'}", folder, _purchases(spark, sf), _spend(spark, sf))
    assert counts["n_pref"] <= counts["n_pairs_raw"]
    schema = {"eval_golden": "trace_id string, input string, reference string", "preference_pairs": "prompt string, chosen string, rejected string"}
    return spark.read.schema(schema[data_set]).json(f"{folder}/{data_set}")


@registry.query(EVAL_SQL)
def flywheel_eval_arrays(spark: SparkSession, sf: str) -> DataFrame:
    """The held-out set out of trace exports that come as JSON arrays."""
    return _flywheel(spark, sf, "eval_golden", arrays=True)


@registry.query(EVAL_SQL)
def flywheel_eval(spark: SparkSession, sf: str) -> DataFrame:
    return _flywheel(spark, sf, "eval_golden")


@registry.query(CLEAN_PAIRS_SQL)
def flywheel_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return _flywheel(spark, sf, "preference_pairs")


@registry.query(f"SELECT strftime(arrived, '%Y-%m-%d') AS batch_id, event_id, 2 AS copies FROM ({EVENT_SQL}) WHERE reason IS NULL")
def stream_landing(spark: SparkSession, sf: str) -> DataFrame:
    """Files picked up by a stream, started twice, land once; read back, gated and counted per event."""
    folder = _work_folder(spark)
    event_lines(spark, sf).write.text(f"{folder}/in")
    for _ in range(2):
        lines = spark.readStream.text(f"{folder}/in")
        streams.finish(streams.land_stream(lines, "events", f"{folder}/out", f"{folder}/checkpoint"))
    valid = quality.valid_events(quality.gate_events(spark.read.parquet(f"{folder}/out")))
    counted = valid.groupBy("event_id").agg(F.min("_batch_id").alias("batch_id"), F.count(F.lit(1)).cast("int").alias("copies"))
    return counted.select("batch_id", "event_id", "copies")


@registry.query(f"""
SELECT ticket_id, op = 'd' AS is_deleted, CAST(lsn AS BIGINT) AS lsn
FROM (SELECT * FROM ({CHANGE_SQL}) QUALIFY row_number() OVER (PARTITION BY ticket_id ORDER BY lsn DESC) = 1)""")
def stream_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """Change records merged by a stream in several micro-batches."""
    folder = _work_folder(spark)
    # Four files, one for each micro-batch.
    change_lines(spark, sf).repartition(4).write.text(f"{folder}/in")
    landed = streams.land_stream(spark.readStream.text(f"{folder}/in"), "tickets", f"{folder}/bronze", f"{folder}/c1")
    streams.finish(landed)
    schema = spark.read.parquet(f"{folder}/bronze").schema
    lake = Lake(spark, f"{folder}/lake")
    # A file for each ingest day and task of the landing; some dozens of them at a time.
    bronze = spark.readStream.schema(schema).option("maxFilesPerTrigger", 32).parquet(f"{folder}/bronze")
    query = streams.upsert_tickets_stream(bronze, lake, f"{folder}/c2")
    streams.finish(query)
    assert len([p for p in query.recentProgress if p["numInputRows"]]) > 1
    state = latest_by(lake.read("silver_tickets"), ["ticket_id"], [F.col("_lsn")])
    return state.select("ticket_id", "is_deleted", F.col("_lsn").alias("lsn"))


def _streamed_events(spark: SparkSession, sf: str) -> Lake:
    """Both copies of every event, broken lines among them, through a stream of four micro-batches."""
    folder = _work_folder(spark)
    event_lines(spark, sf).repartition(4).write.text(f"{folder}/in")
    records = kafka_records(spark.readStream.option("maxFilesPerTrigger", 1).text(f"{folder}/in"), "events", DAY, with_op=False)
    lake = Lake(spark, f"{folder}/lake")
    query = streams.events_stream(quality.gate_events(records), lake, f"{folder}/checkpoint")
    streams.finish(query)
    assert len([p for p in query.recentProgress if p["numInputRows"]]) == 4
    return lake


@registry.query(f"SELECT event_id, user_id, type, ts AS event_time FROM ({EVENT_SQL}) WHERE reason IS NULL")
def stream_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Every event once, out of a stream that delivers each twice, in different micro-batches."""
    return _streamed_events(spark, sf).read("silver_events").select("event_id", "user_id", "type", "event_time")


@registry.query(f"{_FEATURES} FROM ({EVENT_SQL}) WHERE reason IS NULL GROUP BY ALL")
def stream_feature_daily(spark: SparkSession, sf: str) -> DataFrame:
    """Daily features kept up to date by a stream over the deduplicated events."""
    return _day_as_text(_streamed_events(spark, sf).read("gold_feature_daily"))
