"""One ingest day through all tables, backfill, rebuild, and the checks on the outcome."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.fingerprints import added, checksum, checksum_of, combined_checksum, sums_by
from tidemark.operators import cdc, chunks, features, keyed, labelling, quality
from tidemark.operators.schemas import GOLD_TABLES, TABLES, conform
from tidemark.plans.lake import Lake, Run
from tidemark.session import brief_shuffles, passing, together
from tidemark.sources.landing import Bronze

# Days every run recomputes behind its own: the 99th percentile of measured lateness, rounded up.
LOOKBACK_DAYS = 3
# What the attributes of a ticket may be, apart from null.
TICKET_DOMAINS = {
    "priority": ["low", "medium", "high"],
    "status": ["open", "pending", "closed"],
    "category": ["bug", "billing", "other"],
}
# States of past days kept to go on from.
KEPT_STATES = 3
# Of a merged table with more slots than this the smaller ones are written together.
MAX_SLOTS = 32


class SnapshotImmutableError(RuntimeError):
    """A rebuilt training snapshot differs from the one already published."""


def merge_tickets(run: Run, table: str, batch: DataFrame, version: str, at_most: int) -> int:
    """Guarded upsert by ticket that writes the winning rows only; reads key and version of the state.

    `batch` has one row per ticket and at most `at_most` rows.
    """
    winners = keyed.newer_than_state(run.read(table), batch, "ticket_id", version, at_most)
    written = run.append(table, winners)
    run.compact(table, MAX_SLOTS)
    return written


class Warehouse:
    """Bronze and the tables built from it."""

    def __init__(self, spark: SparkSession, deliveries: str, bronze_root: str, lake_root: str, lookback_days: int = LOOKBACK_DAYS):
        self.spark, self.lookback_days = spark, lookback_days
        self.bronze = Bronze(spark, bronze_root, deliveries)
        self.lake = Lake(spark, lake_root)

    # Staging: every landed record is parsed once. Bronze never changes, so neither does a staged batch.

    def stage(self, run: Run) -> dict[str, list[str]]:
        """Parse the landed batches no run has parsed yet, one slot each; the days staged."""
        return together(
            self.spark,
            tickets=lambda: self._stage(run, "tickets", "stage_ticket_changes", cdc.decode_changes),
            events=lambda: self._stage(run, "events", "stage_events", quality.staged_events),
        )

    def _stage(self, run: Run, source: str, table: str, parse: Callable[[DataFrame], DataFrame]) -> list[str]:
        staged = run.slots_from(table, self.bronze.root)
        fresh = [day for day in self.bronze.landed_days(source) if day not in staged]
        for day in fresh:
            landed = self.bronze.scan(source, batch=day)
            run.put(table, day, parse(landed), origin=self.bronze.root)
            if source == "events":
                counts = features.lateness_counts(features.staged_lateness(run.read(table, lambda slot: slot == day)))  # noqa: B023
                run.put("lateness_counts", day, counts, origin=self.bronze.root)
        return fresh

    # Silver

    def tickets(self, tables: Run | Lake) -> DataFrame:
        """Current tickets. The table holds only winning changes, one slot per batch; newest wins."""
        return keyed.latest_by(tables.read("silver_tickets"), ["ticket_id"], [F.col("_lsn")])

    def transcripts(self, tables: Run | Lake) -> DataFrame:
        return keyed.latest_by(tables.read("silver_transcripts"), ["ticket_id"], [F.col("exported_at")])

    def history(self, tables: Run | Lake) -> DataFrame:
        """Every version of every ticket. An interval that changes is appended anew; the last one wins."""
        return cdc.current_versions(tables.read("silver_ticket_history")).drop("_generation")

    def doc_chunks(self, tables: Run | Lake) -> DataFrame:
        """The document index. A changed ticket's chunks are appended anew; the newest ones hold."""
        return keyed.newest_generation(tables.read("gold_doc_chunks"), "ticket_id")

    def gold(self, table: str) -> DataFrame:
        return self.doc_chunks(self.lake) if table == "gold_doc_chunks" else self.lake.read(table)

    def upsert_tickets(self, run: Run, day: str) -> dict:
        of_day = lambda slot: slot == day
        at_most = run.rows("stage_ticket_changes", of_day)
        if not at_most:
            return {"applied": 0}
        batch = cdc.ticket_state(run.read("stage_ticket_changes", of_day))
        return {"applied": merge_tickets(run, "silver_tickets", batch, "_lsn", at_most)}

    def build_history(self, run: Run, days: list[str]) -> dict:
        """Append the intervals that the batches `days` open or end; older batches are not read."""
        if not days:
            return {"written": 0}
        fresh = lambda slot: slot in days
        at_most = run.rows("stage_ticket_changes", fresh)
        with passing(self.spark):
            delta = cdc.history_delta(run.read("silver_ticket_history"), run.read("stage_ticket_changes", fresh), at_most)
            written = run.append("silver_ticket_history", delta.withColumn("_generation", run.next_generation()))
        run.compact("silver_ticket_history", MAX_SLOTS, holding=cdc.current_versions)
        return {"written": written}

    def upsert_events(self, run: Run, day: str) -> dict:
        of_day = lambda slot: slot == day
        gated, at_most = run.read("stage_events", of_day).drop("unread"), run.rows("stage_events", of_day)
        if not at_most:
            return {"inserted": 0, "quarantined": 0, "silver_rows": run.rows("silver_events")}
        quarantined = run.put("quarantine_events", day, quality.quarantined_events(gated))
        arrival = [F.col("_ingested_at"), F.col("_kafka_offset")]
        valid = quality.valid_events(gated)
        fresh = keyed.insert_new(run.read("silver_events"), valid, "event_id", arrival, at_most)
        inserted = run.append("silver_events", fresh.drop("_kafka_partition", "_kafka_offset"), batch=day)
        return {"inserted": inserted, "quarantined": quarantined, "silver_rows": run.rows("silver_events")}

    def upsert_transcripts(self, run: Run, day: str) -> dict:
        if day not in self.bronze.landed_days("transcripts"):
            return {"applied": 0}
        exports = self.bronze.scan("transcripts", batch=day)
        batch = chunks.latest_exports(chunks.decode_exports(exports))
        return {"applied": merge_tickets(run, "silver_transcripts", batch, "exported_at", exports.count())}

    # Gold

    def build_features(self, run: Run, day: str) -> dict:
        """Recompute the event days [day - lookback, day]; other days keep their folders."""
        if not run.rows("silver_events"):
            return {"window": "", "rows": 0}
        window = self._days(F.date_add(F.lit(day).cast("date"), -self.lookback_days), day)
        rebuilt = features.daily_features_between(run.read("silver_events"), window[0], day)
        run.put_by("gold_feature_daily", rebuilt, F.col("event_date"), lambda slot: slot in window)
        return {"window": f"{window[0]}..{day}", "rows": run.rows("gold_feature_daily")}

    def _days(self, first: Column | str, last: Column | str) -> list[str]:
        """Calendar days from `first` to `last`, both included; none if `last` is before."""
        first, last = (F.lit(d).cast("date") if isinstance(d, str) else d for d in (first, last))
        days = self.spark.range(1).where(first <= last).select(F.explode(F.sequence(first, last).cast("array<string>")).alias("day"))
        return sorted(r["day"] for r in days.collect())

    def training_state(self, run: Run, day: str, staged: list[str], inserted: int) -> DataFrame:
        """The state of all tickets as of `day`, kept for the days to come.

        It is folded from the newest state before and the batches since. What arrives for a day makes the
        states of that day and later ones void: `staged` are the days of change batches staged just now,
        `inserted` the number of the day's new events.
        """
        void = min([*staged, *([day] if inserted else [])], default=None)
        if void is not None:
            run.drop("training_state", lambda slot: slot >= void)
        if day not in run.slots("training_state"):
            base = max((slot for slot in run.slots("training_state") if slot < day), default="")
            since = lambda batch: base < batch <= day
            events = run.from_batches("silver_events", since).where((F.col("_batch_id") > base) & (F.col("_batch_id") <= day))
            before = run.read("training_state", lambda slot: slot == base) if base else None
            run.put("training_state", day, cdc.training_state(before, run.read("stage_ticket_changes", since), events))
        kept = {day, *sorted(run.slots("training_state"))[-KEPT_STATES:]}
        run.drop("training_state", lambda slot: slot not in kept)
        return run.read("training_state", lambda slot: slot == day)

    def build_snapshot(self, run: Run, day: str, staged: list[str], inserted: int) -> dict:
        """Write version `v<day>` once; a rebuild must come out the same."""
        version = f"v{day}"
        snapshot = cdc.snapshot_of(self.training_state(run, day, staged, inserted), day)
        if version not in run.slots("gold_training_set"):
            return {"version": version, "status": "created", "rows": run.put("gold_training_set", version, snapshot)}
        same = lambda slot: slot == version
        if checksum(run.read("gold_training_set", same)) != checksum(snapshot):
            raise SnapshotImmutableError(f"snapshot {version} exists with different content; publish a new version")
        return {"version": version, "status": "unchanged", "rows": run.rows("gold_training_set", same)}

    def build_chunks(self, run: Run, model: chunks.Model = chunks.hash_model, model_version: str = chunks.MODEL_VERSION) -> dict:
        """Index the transcripts of all tickets this run has changed; embed only texts new to the model.

        Tickets that did not change keep their chunks. After a change of model all are indexed anew.
        """
        tickets, transcripts = run.read("silver_tickets"), run.read("silver_transcripts")
        (new_tickets, n_tickets), (new_transcripts, n_transcripts) = run.appended("silver_tickets"), run.appended("silver_transcripts")
        touched, at_most = new_tickets.select("ticket_id").unionByName(new_transcripts.select("ticket_id")), n_tickets + n_transcripts
        outdated = set(run.slots("gold_doc_chunks")) - run.slots_from("gold_doc_chunks", model_version)
        if outdated:
            touched, at_most = transcripts.select("ticket_id"), run.rows("silver_transcripts")
            run.replace("gold_doc_chunks", run.read("gold_doc_chunks").limit(0))
        if not at_most:
            return {"written": 0, "embedded_new": 0}
        live = chunks.live_transcripts(
            keyed.latest_by(keyed.matching(transcripts, touched, "ticket_id", at_most), ["ticket_id"], [F.col("exported_at")]),
            keyed.latest_by(keyed.matching(tickets, touched, "ticket_id", at_most), ["ticket_id"], [F.col("_lsn")]),
        )
        pieces, n_pieces = run.aside(chunks.split_chunks(live))
        missing = chunks.missing_embeddings(pieces, run.read("embedding_cache"), model_version, n_pieces)
        embedded = run.append("embedding_cache", chunks.embed(missing, model, model_version))
        indexed = chunks.with_embeddings(pieces, run.read("embedding_cache"), model_version, n_pieces)
        written = run.append_keys("gold_doc_chunks", "ticket_id", touched, indexed, at_most, origin=model_version)
        run.compact("gold_doc_chunks", MAX_SLOTS)
        return {"written": written, "embedded_new": embedded}

    def label_tickets(
        self,
        labeller: labelling.Labeller = labelling.keyword_labeller,
        model: str = labelling.MODEL,
        prompt_version: str = labelling.PROMPT_VERSION,
    ) -> dict:
        """Label every live ticket; only inputs new to this model and prompt version are asked."""
        run = self.lake.begin()
        texts = labelling.live_ticket_texts(self.tickets(run))
        at_most = run.rows("silver_tickets")
        fresh = labelling.unanswered(texts, run.read("answer_cache"), model, prompt_version, at_most)
        asked = run.append("answer_cache", labelling.answers(fresh, labeller, model, prompt_version))
        judged = labelling.judged(texts, run.read("answer_cache"), model, prompt_version)
        labelled = run.replace("gold_ticket_labels", labelling.gold_labels(judged))
        refused = run.replace("llm_label_quarantine", labelling.quarantined_labels(judged))
        run.commit()
        return {"asked": asked, "labelled": labelled, "quarantined": refused}

    # Jobs

    def run_day(self, day: str) -> dict:
        """Land the day, then bring every table up to date; all of them are published or none."""
        landed = self.bronze.land_day(day)
        run = self.lake.begin()
        staged = self.stage(run)
        # Tables that do not need one another are written at the same time, none by more than one of these.
        built = together(
            self.spark,
            of_tickets=lambda: {
                "silver_tickets": self.upsert_tickets(run, day),
                "silver_transcripts": self.upsert_transcripts(run, day),
                "gold_doc_chunks": self.build_chunks(run),
            },
            of_events=lambda: {
                "silver_events": (events := self.upsert_events(run, day)),
                "gold_feature_daily": self.build_features(run, day),
                "gold_training_set": self.build_snapshot(run, day, staged["tickets"], events["inserted"]),
            },
            of_history=lambda: {"silver_history": self.build_history(run, staged["tickets"])},
        )
        run.commit()
        return {"land": landed, "staged": staged} | built["of_tickets"] | built["of_events"] | built["of_history"]

    def backfill(self, start: str, end: str) -> list[dict]:
        """Every day in order; a day's state depends on the day before."""
        return [self.run_day(day) for day in self._days(start, end)]

    def rebuilt(self, lake_root: str) -> Warehouse:
        """A warehouse over the same Bronze with all other tables still to be built."""
        return Warehouse(self.spark, self.bronze.deliveries, self.bronze.root, lake_root, self.lookback_days)

    # Checks

    def gold_checksums(self, read: bool = False) -> dict[str, str]:
        """Checksums of the Gold tables and of all of them, from the sums kept of each slot when it was written.

        With `read`, and for a table with slots nobody summed, from the rows as they lie.
        """
        sums = {}
        for table in GOLD_TABLES:
            kept = None if read else self.lake.sums(table)
            sums[table] = checksum(self.gold(table)) if kept is None else checksum_of(added(kept.values()))
        return sums | {"gold": combined_checksum(list(sums.values()))}

    def differing_slots(self, other: Warehouse) -> dict[str, list[str]]:
        """The days and versions in which two warehouses differ, of the tables kept by day or version."""
        out = {}
        for table in ("gold_feature_daily", "gold_training_set"):
            mine, theirs = self.lake.sums(table) or {}, other.lake.sums(table) or {}
            out[table] = sorted(slot for slot in {*mine, *theirs} if mine.get(slot, (0, 0, 0)) != theirs.get(slot, (0, 0, 0)))
        return out

    def features_reconcile(self) -> bool:
        """Whether the windowed features equal one aggregate over all events."""
        return not self.unreconciled_days()

    def unreconciled_days(self) -> list[str]:
        """The days whose features differ from the aggregate over their events; the features are not read."""
        whole = conform(features.daily_features(self.lake.read("silver_events")), TABLES["gold_feature_daily"])
        wanted = sums_by(whole, F.col("event_date"))
        kept = self.lake.sums("gold_feature_daily")
        held = sums_by(self.lake.read("gold_feature_daily"), F.col("event_date")) if kept is None else kept
        return sorted(day for day in {*wanted, *held} if wanted.get(day, (0, 0, 0)) != held.get(day, (0, 0, 0)))

    def _lateness(self) -> DataFrame:
        """The profile of all that has landed, from the counts kept of each batch; only batches that have
        landed and are not staged yet are parsed."""
        run = self.lake.begin()
        counted = run.slots_from("lateness_counts", self.bronze.root)
        counts = [run.read("lateness_counts", lambda slot: slot in counted)]
        for day in self.bronze.landed_days("events"):
            if day not in counted:
                counts.append(features.lateness_counts(features.event_lateness(self.bronze.scan("events", batch=day))))
        return features.profile_of_counts(reduce(DataFrame.unionByName, counts))

    def lateness(self) -> dict:
        return self._lateness().first().asDict()

    def lookback_covers(self) -> bool:
        """Whether the lookback covers the 99th percentile of what has landed."""
        return features.lookback_covered(self._lateness(), self.lookback_days).first()["covered"]

    def unreadable(self, source: str) -> DataFrame:
        """Landed records no table is built from, with the reason."""
        return quality.unreadable_records(self.bronze.scan(source))

    def table_tests(self) -> DataFrame:
        """(`table_name`, `rule`, `violations`) for the promises the tables make; all should be 0."""
        tested = {
            "silver_tickets": quality.table_tests(
                self.tickets(self.lake), not_null=["ticket_id", "is_deleted", "_lsn"], accepted=TICKET_DOMAINS, unique=[["ticket_id"]]
            ),
            "silver_events": quality.table_tests(
                self.lake.read("silver_events"), not_null=["event_id", "user_id"], unique=[["event_id"]]
            ),
            "gold_feature_daily": quality.table_tests(
                self.lake.read("gold_feature_daily"), not_null=["user_id", "event_date"], unique=[["user_id", "event_date"]]
            ),
            "gold_doc_chunks": quality.table_tests(self.doc_chunks(self.lake), unique=[["ticket_id", "chunk_idx"]]),
        }
        named = [df.select(F.lit(name).alias("table_name"), "rule", "violations") for name, df in tested.items()]
        return reduce(DataFrame.unionByName, named)

    def pii_leaks(self) -> DataFrame:
        """Texts with personal data left in any table behind Bronze."""
        return quality.pii_scan(
            {
                "silver_tickets": (self.tickets(self.lake), "body"),
                "silver_transcripts": (self.transcripts(self.lake), "text"),
                "gold_training_set": (self.lake.read("gold_training_set"), "text"),
                "gold_doc_chunks": (self.doc_chunks(self.lake), "chunk_text"),
            }
        )


def fresh_check(warehouse: Warehouse, lake_root: str, days: list[str]) -> dict[str, tuple[str, str]]:
    """Gold checksums of the warehouse beside those of a fresh build from the same Bronze."""
    fresh = warehouse.rebuilt(lake_root)
    with brief_shuffles(warehouse.spark):
        for day in days:
            fresh.run_day(day)
            fresh.lake.vacuum()
    again = fresh.gold_checksums()
    return {table: (held, again[table]) for table, held in warehouse.gold_checksums().items()}


def rerun_check(warehouse: Warehouse, day: str, times: int = 3) -> list[dict[str, str]]:
    """Gold checksums before and after running an old day again, `times` times; all should be equal."""
    sums = [warehouse.gold_checksums()]
    for _ in range(times):
        warehouse.run_day(day)
        sums.append(warehouse.gold_checksums())
    return sums
