"""Ordered work along keys as a distributed prefix scan.

Rows are dealt over tasks by ranges of key and order, so that a key of any size, and rows that are equal in
both, are as many tasks as they fill. Each task works along its own part of each key; what has to cross from
one task to a later one of the same key is one value for each task, and those few values are put in order in
a second pass.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import cut_lineage


def _dealt(line: DataFrame, on: Sequence[str], order: Sequence[str]) -> DataFrame:
    """`line` stored with `_task`, the range each row is in, and `_turn`, which parts rows that are equal otherwise."""
    turned = line.withColumn("_turn", F.monotonically_increasing_id())
    # As many ranges as any shuffle has partitions; the number must be given for one by a range of several columns.
    ranges = int(line.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return cut_lineage(turned.repartitionByRange(ranges, *on, *order, "_turn").withColumn("_task", F.spark_partition_id()))


def _key(on: Sequence[str]) -> Column:
    return F.struct(*on)


def carry_last(line: DataFrame, on: Sequence[str], order: Sequence[str], value: str) -> DataFrame:
    """Every row with the last `value` that is not null at or before it, in order along its key.

    Key columns are not null. A task hands on the last value of its last key; a key that goes on into a later
    task starts there with the last one handed on before. That is at most one row for each task.
    """
    dealt = _dealt(line, on, order)
    along = Window.partitionBy("_task", *on).orderBy(*order, "_turn").rowsBetween(Window.unboundedPreceding, 0)
    known = F.col(value).isNotNull()
    place = F.struct(_key(on).alias("k"), *order, "_turn")
    ends = dealt.groupBy("_task").agg(
        F.min(_key(on)).alias("first"), F.max(_key(on)).alias("last"),
        F.max_by(F.struct(_key(on).alias("k"), F.col(value).alias("v")), F.when(known, place)).alias("given"),
    )
    given = F.when(F.col("given")["k"] == F.col("last"), F.col("given")["v"])
    # Before its own end is added, a task takes what the tasks before it have handed on.
    steps = ends.select("_task", F.lit(0).alias("_step"), F.col("first").alias("_of"), F.lit(None).cast(line.schema[value].dataType).alias("_start"))
    steps = steps.unionByName(ends.select("_task", F.lit(1).alias("_step"), F.col("last").alias("_of"), given.alias("_start")))
    so_far = Window.partitionBy("_of").orderBy("_task", "_step").rowsBetween(Window.unboundedPreceding, 0)
    starts = steps.withColumn("_start", F.last("_start", ignorenulls=True).over(so_far)).where("_step = 0 AND _start IS NOT NULL")
    starts = starts.select("_task", *[F.col("_of")[c].alias(c) for c in on], "_start")
    carried = dealt.withColumn(value, F.last(value, ignorenulls=True).over(along))
    # One row for each task at most, however large the input.
    joined = carried.join(F.broadcast(starts), ["_task", *on], "left")
    return joined.withColumn(value, F.coalesce(value, "_start")).select(*line.columns)


def next_value(line: DataFrame, on: Sequence[str], order: Sequence[str], value: str, name: str) -> DataFrame:
    """Every row with `name`, the `value` of the row that follows it along its key; null for the last one.

    Key columns are not null. The last row of a task gets the first value of the next task that has rows, if
    that is of the same key; this is one row for each task.
    """
    dealt = _dealt(line, on, order)
    along = Window.partitionBy("_task", *on).orderBy(*order, "_turn")
    place = F.struct(_key(on).alias("k"), *order, "_turn")
    ends = dealt.groupBy("_task").agg(
        F.min(_key(on)).alias("first"), F.max(_key(on)).alias("last"), F.min_by(F.struct(F.col(value).alias("v")), place).alias("head")
    )
    # As many rows as there are tasks, which is why one window over all of them is no bottleneck.
    tasks = Window.partitionBy(F.lit(0)).orderBy("_task")
    handed = ends.select("_task", "last", F.lead(F.struct("first", "head")).over(tasks).alias("n")).where(F.col("n")["first"] == F.col("last"))
    handed = handed.select("_task", *[F.col("last")[c].alias(c) for c in on], F.col("n")["head"].alias("_head"))
    inside = dealt.withColumn("_next", F.lead(F.struct(F.col(value).alias("v"))).over(along))
    joined = inside.join(F.broadcast(handed), ["_task", *on], "left")
    return joined.withColumn(name, F.coalesce("_next", "_head")["v"]).select(*line.columns, name)
