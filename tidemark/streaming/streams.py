"""The daily operators as streams over folders of delivered files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators import cdc, features, keyed, quality
from tidemark.operators.schemas import TABLES
from tidemark.plans.daily import merge_tickets
from tidemark.plans.lake import Lake, Run
from tidemark.session import cut_lineage
from tidemark.sources.landing import kafka_records


def land_stream(lines: DataFrame, source: str, target: str, checkpoint: str) -> StreamingQuery:
    """Land what is new in a folder of JSON lines, every file exactly once, then stop.

    The ingest day is the day a record reached us; of a line that does not say when that was, the day
    it is landed.
    """
    records = kafka_records(lines, source, "", with_op=source == "tickets")
    day = F.date_format(F.coalesce(F.col("_ingested_at").cast("timestamp"), F.current_timestamp()), "yyyy-MM-dd")
    landed = records.withColumn("_batch_id", day).withColumn("ingest_date", day)
    return (
        landed.writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .partitionBy("ingest_date")
        .trigger(availableNow=True)
        .start()
    )


def upsert_tickets_stream(bronze: DataFrame, lake: Lake, checkpoint: str) -> StreamingQuery:
    """Merge change records into `silver_tickets` micro-batch by micro-batch.

    The merge writes winners only, so a micro-batch that is tried again after a failure adds nothing.
    """

    def merge(records: DataFrame, _epoch: int) -> None:
        run = lake.begin()
        batch = cdc.ticket_state(cdc.decode_changes(records))
        merge_tickets(run, "silver_tickets", batch, "_lsn", at_most=records.count())
        run.commit()

    return bronze.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


# Event time a stream looks back for copies of an event in its state; copies beyond it are found in the table.
COPY_DELAY_DAYS = 3
_STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def events_stream(gated: DataFrame, lake: Lake, checkpoint: str, delay_days: int = COPY_DELAY_DAYS) -> StreamingQuery:
    """Merge gated events into `silver_events`, each event once and however late, and add them to the
    features of their days, micro-batch by micro-batch.

    Copies of an event are known by the stream's state, which holds ids for `delay_days` of event time; a
    copy has its event's time. Spark's watermark drops what is later than that from the state's output; those
    rows come beside it and are compared with the table, so no event is too late and no fresh one costs a
    look at the table. Both tables and the number of the micro-batch change with one commit, so a
    micro-batch that is tried again after a failure adds nothing. A stream that meets a table it has not
    filled alone compares every event with it.
    """
    at = F.col("event_time").cast("timestamp")
    timed = quality.valid_events(gated).withColumn("_at", at).withWatermark("_at", f"{delay_days} days")
    first = timed.dropDuplicatesWithinWatermark(["event_id"]).withColumn("_first", F.lit(True))
    both = first.unionByName(timed.withColumn("_first", F.lit(False)))

    def merge(batch: DataFrame, epoch: int) -> None:
        run = lake.begin()
        note = run.note(f"events {checkpoint}") or {"epoch": -1, "latest": 0, "rows": 0, "alone": True}
        if epoch <= note["epoch"]:
            # The tables have it; the state must still be brought as far as this micro-batch.
            batch.write.format("noop").mode("overwrite").save()
            return
        alone = note["alone"] and run.rows("silver_events") == note["rows"]
        low = max(note["latest"] - delay_days * 86_400_000, 0)
        rows = [c for c in batch.columns if c not in ("event_id", "_first")]
        arrival = F.struct("_ingested_at", "_kafka_offset")
        # Of several copies the earliest counts, whichever the state let through.
        once = cut_lineage(batch.groupBy("event_id").agg(F.bool_or("_first").alias("_first"), F.min_by(F.struct(*rows), arrival).alias("e")).select("event_id", "_first", "e.*"))
        fresh = F.col("_first") if alone else F.lit(False)
        late = once.where(~fresh & ((F.unix_millis("_at") <= low) | F.lit(not alone)))
        kept, n_late = once.where(fresh), late.count()
        if n_late:
            kept = kept.unionByName(keyed.unseen(run.read("silver_events"), late, "event_id", n_late))
        if run.append("silver_events", kept.select(TABLES["silver_events"].names)):
            _add_features(run, run.appended("silver_events")[0])
        seen = once.agg(F.max(F.unix_millis("_at"))).first()[0] or 0
        run.keep_note(f"events {checkpoint}", {"epoch": epoch, "latest": max(seen, note["latest"]), "rows": run.rows("silver_events"), "alone": alone})
        run.commit()

    conf = gated.sparkSession.conf
    before = conf.get(_STATE_STORE)
    # A query keeps the settings it was started with.
    conf.set(_STATE_STORE, _ROCKSDB)
    try:
        return both.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    finally:
        conf.set(_STATE_STORE, before)


def _add_features(run: Run, added: DataFrame) -> None:
    """Adds new events to the features of their days; events counted before are not read again."""
    delta = cut_lineage(features.daily_features(added))
    # One short text for each day of the micro-batch.
    days = {str(row["event_date"]) for row in delta.select("event_date").distinct().collect()}
    both = run.read("gold_feature_daily", lambda slot: slot in days).unionByName(delta)
    counts = [c for c in delta.columns if c not in ("user_id", "event_date")]
    summed = both.groupBy("user_id", "event_date").agg(*[F.sum(c).alias(c) for c in counts])
    run.put_by("gold_feature_daily", summed, F.col("event_date"), lambda slot: slot in days)


def finish(query: StreamingQuery) -> None:
    """Wait for an available-now query; its failure is raised here."""
    query.awaitTermination()
