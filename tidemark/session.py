"""Session settings, and the one shared folder long jobs may cut their lineage in."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import AbstractContextManager, contextmanager
from contextvars import ContextVar
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from tidemark.sources.folders import Folders

# Settings every operator counts on. All are runtime settings, so they can be applied to a session
# somebody else started.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Joins against a unique side split a hot key at run time; force it even where the split costs a
    # later shuffle, because one task with a third of the rows costs far more.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Span trees are flattened by a recursive query; neither its rows nor its depth may be capped.
    "spark.sql.cteRecursionRowLimit": "-1",
    "spark.sql.cteRecursionLevelLimit": "-1",
}

# How the files of Bronze, of the tables behind it and of stored steps are packed: smaller than Spark's default
# by a quarter to two fifths, and about as fast.
PACKED = "zstd"


def tune(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and local measurements. On a cluster, build your own and call `tune`."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tidemark")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach: `spark.checkpoint.dir`, or the checkpoint folder already set.

    Only a local session may fall back to a temporary folder; a cluster without the setting is an error.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-"))
    return context.getCheckpointDir()


# Folders stored in the innermost `passing` of this thread.
_PASSING: ContextVar[list[str] | None] = ContextVar("passing", default=None)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Store `df` in the shared folder, so that later steps neither recompute it nor carry its plan.

    A written table and not `checkpoint()`, which computes what it stores twice. Its folder belongs to
    the job, like checkpoint files, and goes with them, or before at the end of `passing`.
    """
    spark = df.sparkSession
    folder = f"{shared_folder(spark)}/stored-{uuid.uuid4().hex}"
    stored = _PASSING.get()
    if stored is not None:
        stored.append(folder)
    df.write.option("compression", PACKED).parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


@contextmanager
def passing(spark: SparkSession) -> Iterator[None]:
    """What `cut_lineage` stores in here, in this thread, is removed at the end; nothing made of it may be read later."""
    stored: list[str] = []
    outer = _PASSING.set(stored)
    try:
        yield
    finally:
        _PASSING.reset(outer)
        for folder in stored:
            Folders(spark).remove(folder)


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A setting of the session that holds in here only."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def brief_shuffles(spark: SparkSession) -> AbstractContextManager[None]:
    """In here the shuffle files of a job go when it ends, and not when the driver happens to collect its garbage."""
    return setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def together(spark: SparkSession, **steps: Callable[[], Any]) -> dict[str, Any]:
    """What steps return that do not need one another and are run at the same time.

    Jobs of one step take the cores that those of another leave idle. All have ended when the first failure is raised.
    """
    with ThreadPoolExecutor(len(steps)) as pool:
        begun = {name: pool.submit(inheritable_thread_target(spark)(step)) for name, step in steps.items()}
    return {name: step.result() for name, step in begun.items()}
