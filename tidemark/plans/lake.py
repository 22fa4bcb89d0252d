"""Versioned tables over plain Parquet folders.

A table is a set of named slots, each a Parquet folder that is never changed once written. A commit is
one small file that says which folder fills which slot of which table. A run writes new folders and
then publishes all its tables with one commit, or, when it fails, none of them.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable
from itertools import count

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.fingerprints import Sums, added, sums_by
from tidemark.operators.keyed import matching, newest_generation
from tidemark.operators.schemas import GOLD_TABLES, TABLES, conform
from tidemark.session import PACKED, cut_lineage, passing
from tidemark.sources.folders import Folders

# Where commits keep the notes of jobs, beside the tables.
_NOTES = "_notes"
# Of every slot its folder and, where it was counted, its number of rows.
Slots = dict[str, dict]


class Lake:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root
        self.folders = Folders(spark)

    def _commits(self) -> list[str]:
        return [n for n in self.folders.names(f"{self.root}/_commits") if n.endswith(".json")]

    def sums(self, table: str) -> dict[str, Sums] | None:
        """The sums of every slot's rows as counted when they were written; None if a slot was not counted."""
        held = self.tables().get(table, {})
        if any("sums" not in h for h in held.values()):
            return None
        return {slot: tuple(map(int, h["sums"])) for slot, h in held.items()}

    def tables(self) -> dict[str, Slots]:
        commits = self._commits()
        return json.loads(self.folders.read_text(f"{self.root}/_commits/{commits[-1]}")) if commits else {}

    def read(self, table: str, slots: Callable[[str], bool] | None = None) -> DataFrame:
        """A table as last committed; with `slots`, only the slots whose name is accepted."""
        return _read(self, self.tables(), table, slots)

    def empty_folder(self) -> str:
        folder = f"{self.root}/_empty"
        self.folders.make(folder)
        return folder

    def begin(self) -> Run:
        return Run(self)

    def vacuum(self) -> None:
        """Remove the folders the last commit does not name: what it replaced, what runs put aside, what failed ones left.

        Only while no run is writing and nobody reads an older version.
        """
        held = {h["path"] for slots in self.tables().values() for h in slots.values() if "path" in h}
        # A folder written by slot holds those of its slots.
        parents = {path.rsplit("/", 1)[0] for path in held if path.count("/") > 1}
        for table in self.folders.names(self.root):
            if table not in ("_commits", "_empty"):
                self._vacuum(table, held, parents)

    def _vacuum(self, within: str, held: set[str], parents: set[str]) -> None:
        for name in self.folders.names(f"{self.root}/{within}"):
            path = f"{within}/{name}"
            if path in parents:
                self._vacuum(path, held, parents)
            elif path not in held:
                self.folders.remove(f"{self.root}/{path}")


def _slot_of(path: str) -> str:
    """The name of a slot that is called after its folder."""
    return path.rsplit("/", 1)[1]


def _read(lake: Lake, tables: dict[str, Slots], table: str, slots: Callable[[str], bool] | None) -> DataFrame:
    wanted = [held["path"] for slot, held in tables.get(table, {}).items() if slots is None or slots(slot)]
    return _scan(lake, table, wanted)


def _scan(lake: Lake, table: str, paths: list[str]) -> DataFrame:
    # A folder without files stands in for a table without slots; its scan has the same columns.
    folders = [f"{lake.root}/{p}" for p in paths] or [lake.empty_folder()]
    return lake.spark.read.schema(TABLES[table]).parquet(*folders)


def _scan_by_slot(lake: Lake, table: str, folder: str) -> DataFrame:
    """A table written in parts by slot, without the column of the slots."""
    return lake.spark.read.schema(TABLES[table]).option("recursiveFileLookup", "true").parquet(folder)


def _told(sums: Iterable[int]) -> list[str]:
    # As texts, since they are larger than numbers of JSON are read everywhere.
    return [str(n) for n in sums]


class Run:
    """Changes to any number of tables, visible to the run at once and to others after `commit`."""

    def __init__(self, lake: Lake):
        self.lake, self.spark = lake, lake.spark
        self.id = uuid.uuid4().hex[:12]
        commits = lake._commits()
        self._base = int(commits[-1].removesuffix(".json")) if commits else 0
        self.tables = {name: dict(slots) for name, slots in lake.tables().items()}
        # Steps of a run may write at the same time.
        self._written = count(1)
        self._appended: dict[str, list[dict]] = {}

    def read(self, table: str, slots: Callable[[str], bool] | None = None) -> DataFrame:
        return _read(self.lake, self.tables, table, slots)

    def slots(self, table: str) -> list[str]:
        return list(self.tables.get(table, {}))

    def rows(self, table: str, accepted: Callable[[str], bool] | None = None) -> int:
        """Rows of a table's slots as counted when they were written."""
        held = self.tables.get(table, {}).items()
        return sum(h["rows"] for slot, h in held if accepted is None or accepted(slot))

    def _write(self, table: str, df: DataFrame, by: Column | None = None) -> str:
        path = f"{table}/{self.id}-{next(self._written):03d}"
        rows = conform(df, TABLES[table])
        if by is None:
            rows.write.option("compression", PACKED).parquet(f"{self.lake.root}/{path}")
        else:
            # The slot is no column of the files, so a slot's folder is a table of its own.
            rows.withColumn("slot", by.cast("string")).write.partitionBy("slot").option("compression", PACKED).parquet(f"{self.lake.root}/{path}")
        return path

    def aside(self, df: DataFrame) -> tuple[DataFrame, int]:
        """`df` written to a folder of no table, for results a run needs more than once; and its rows."""
        path = f"_aside/{self.id}-{next(self._written):03d}"
        df.write.option("compression", PACKED).parquet(f"{self.lake.root}/{path}")
        return self.spark.read.schema(df.schema).parquet(f"{self.lake.root}/{path}"), self._held(path)["rows"]

    def _held(self, path: str) -> dict:
        # A count of Parquet rows reads the file footers only.
        return {"path": path, "rows": self.spark.read.parquet(f"{self.lake.root}/{path}").count()}

    def put(self, table: str, slot: str, df: DataFrame, origin: str | None = None) -> int:
        """Fill one slot, replacing what it held; the number of rows. `origin` says what it was made from."""
        held = self._held(self._write(table, df)) | {"origin": origin}
        self.tables.setdefault(table, {})[slot] = self._summed(table, held)
        return held["rows"]

    def _summed(self, table: str, held: dict) -> dict:
        """With the sums of what has just been written, for the tables whose checksums are asked for."""
        if table not in GOLD_TABLES:
            return held
        return held | {"sums": _told(sums_by(_scan(self.lake, table, [held["path"]])).get(None, (0, 0, 0)))}

    def slots_from(self, table: str, origin: str) -> set[str]:
        """The slots of a table made from `origin`."""
        return {slot for slot, held in self.tables.get(table, {}).items() if held.get("origin") == origin}

    def append(self, table: str, df: DataFrame, batch: str | None = None) -> int:
        """Add rows in a slot of their own; nothing is added when there are none. `batch` says where they are from."""
        path = self._write(table, df)
        held = self._held(path) | {"origin": batch}
        if held["rows"]:
            self.tables.setdefault(table, {})[_slot_of(path)] = held
            self._appended.setdefault(table, []).append(held)
        return held["rows"]

    def from_batches(self, table: str, wanted: Callable[[str], bool]) -> DataFrame:
        """What was appended from the batches that are wanted; slots that do not say so are read as well."""
        held = self.tables.get(table, {}).values()
        return _scan(self.lake, table, [h["path"] for h in held if h.get("origin") is None or wanted(h["origin"])])

    def drop(self, table: str, dropped: Callable[[str], bool]) -> None:
        """Empty the slots whose name is accepted."""
        self.tables[table] = {slot: held for slot, held in self.tables.get(table, {}).items() if not dropped(slot)}

    def note(self, name: str) -> dict | None:
        """What a job has last committed about itself under this name."""
        return self.tables.get(_NOTES, {}).get(name)

    def keep_note(self, name: str, note: dict) -> None:
        self.tables.setdefault(_NOTES, {})[name] = note

    def next_generation(self) -> Column:
        """The number of this run, greater than that of any run before."""
        return F.lit(self._base + 1).cast("bigint")

    def appended(self, table: str) -> tuple[DataFrame, int]:
        """What this run has appended to a table, and its number of rows."""
        held = self._appended.get(table, [])
        return _scan(self.lake, table, [h["path"] for h in held]), sum(h["rows"] for h in held)

    def replace(self, table: str, df: DataFrame) -> int:
        """Make `df` the whole table."""
        path = self._write(table, df)
        held = self._held(path)
        self.tables[table] = {_slot_of(path): held} if held["rows"] else {}
        return held["rows"]

    def append_keys(self, table: str, key: str, touched: DataFrame, rebuilt: DataFrame, at_most: int | None = None, origin: str | None = None) -> int:
        """Make `rebuilt` all there is of the `touched` keys, at most `at_most`, by appending it; its number of rows.

        Nothing written before is written again: `keyed.newest_generation` tells what holds. A key that
        has had rows and has none any more gets one that says so.
        """
        with passing(self.spark):
            return self._append_keys(table, key, touched, cut_lineage(rebuilt), at_most, origin)

    def _append_keys(self, table: str, key: str, touched: DataFrame, rebuilt: DataFrame, at_most: int | None, origin: str | None) -> int:
        columns = [c for c in TABLES[table].names if c not in ("_generation", "_gone")]
        # What these keys held so far goes, so a slot's sums are those of its rows less those they replace.
        replaced = newest_generation(matching(self.read(table), touched, key, at_most), key).select(columns)
        sums = [sums_by(df).get(None, (0, 0, 0)) for df in (rebuilt.select(columns), replaced)]
        net = [new - old for new, old in zip(*sums, strict=True)]
        held = matching(self.read(table).where(~F.col("_gone")).select(key), touched, key, at_most).distinct()
        gone = held.join(rebuilt.select(key).distinct(), key, "left_anti")
        rows = rebuilt.withColumn("_gone", F.lit(False)).unionByName(gone.withColumn("_gone", F.lit(True)), allowMissingColumns=True)
        path = self._write(table, rows.withColumn("_generation", self.next_generation()))
        held = self._held(path)
        if held["rows"]:
            self.tables.setdefault(table, {})[_slot_of(path)] = held | {"origin": origin, "sums": _told(net)}
        return rebuilt.count()

    def compact(self, table: str, most: int, holding: Callable[[DataFrame], DataFrame] | None = None) -> None:
        """With more than `most` slots, write the smaller ones together as one; large ones stay.

        `holding` leaves out rows that others of the same slots have replaced.

        A row is written again only when its slot is among the smaller half, so about as often as the
        logarithm of the number of batches.
        """
        held = self.tables.get(table, {})
        if len(held) <= most:
            return
        small = sorted(held, key=lambda slot: (held[slot]["rows"], slot))[: len(held) - most // 2]
        together = _scan(self.lake, table, [held[slot]["path"] for slot in small])
        path = self._write(table, holding(together) if holding else together)
        origins = {held[slot].get("origin") for slot in small}
        merged = self._held(path) | {"origin": origins.pop() if len(origins) == 1 else None}
        if all("sums" in held[slot] for slot in small):
            merged["sums"] = _told(added(tuple(map(int, held[slot]["sums"])) for slot in small))
        self.tables[table] = {slot: h for slot, h in held.items() if slot not in small} | {_slot_of(path): merged}

    def put_by(self, table: str, df: DataFrame, by: Column, dropped: Callable[[str], bool]) -> int:
        """Drop the slots `dropped` accepts, then fill one slot per value of `by`; the number of rows.

        A slot that gets no rows stays dropped.
        """
        path = self._write(table, df, by)
        folder = f"{self.lake.root}/{path}"
        kept = {slot: held for slot, held in self.tables.get(table, {}).items() if not dropped(slot)}
        written = 0
        for name in self.lake.folders.names(folder):
            if name.startswith("slot="):
                # Slot values are dates and numbers of ours, so folder names need no unescaping.
                kept[name.removeprefix("slot=")] = {"path": f"{path}/{name}", "rows": None}
        if any(held["rows"] is None for held in kept.values()):
            counted = self.spark.read.parquet(folder).groupBy("slot").count().collect()
            for row in counted:
                kept[str(row["slot"])]["rows"] = row["count"]
                written += row["count"]
            if table in GOLD_TABLES:
                for slot, sums in sums_by(_scan_by_slot(self.lake, table, folder), by).items():
                    kept[slot]["sums"] = _told(sums)
        self.tables[table] = kept
        return written

    def commit(self) -> None:
        """Publish everything. Fails when another run has committed since this one began."""
        # Created only if it is not there, which one of two writers does; a file system that cannot
        # promise this needs a committer that can.
        number = f"{self._base + 1:010d}"
        self.lake.folders.write_text(f"{self.lake.root}/_commits/{number}.json", json.dumps(self.tables, sort_keys=True))
