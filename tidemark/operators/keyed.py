"""Keyed writes as DataFrame functions: first and latest row per key, guarded upsert, insert-only.

Picking one row per key is an aggregation (`min_by` / `max_by` over the whole row), so each map task
sends at most one row per key. A key that holds a third of all rows costs no more than any other.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _rank(order: Sequence[Column], last_wins: bool) -> Column:
    """The order columns as one comparable struct in which null always loses."""
    fields = []
    for n, col in enumerate(order):
        missing = col.isNull()
        fields += [(~missing if last_wins else missing).alias(f"m{n}"), col.alias(f"o{n}")]
    return F.struct(*fields)


def first_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the smallest by `order`, nulls last. `order` should be total per key."""
    return _pick(df, keys, lambda row: F.min_by(row, _rank(order, last_wins=False)))


def latest_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the greatest by `order`, null counting as smallest."""
    return _pick(df, keys, lambda row: F.max_by(row, _rank(order, last_wins=True)))


def _pick(df: DataFrame, keys: Sequence[str], choose: Callable[[Column], Column]) -> DataFrame:
    # Keys come from the grouping itself, so that later joins and windows on them need no new shuffle.
    others = [c for c in df.columns if c not in keys]
    if not others:
        return df.distinct()
    picked = df.groupBy(*keys).agg(choose(F.struct(*others)).alias("_row"))
    return picked.select(*[F.col(c) if c in keys else F.col("_row")[c].alias(c) for c in df.columns])


# A batch of at most this many rows may send its keys to every executor; a key and its slot in the
# hash table take some 100 bytes, so this is about 100 MB.
BROADCAST_ROWS = 1_000_000


def small(at_most: int | None) -> bool:
    """Whether a batch of at most so many rows may be broadcast; not, if its size is unknown."""
    return at_most is not None and at_most <= BROADCAST_ROWS


def matching(state: DataFrame, batch: DataFrame, key: str, at_most: int | None) -> DataFrame:
    """The state rows whose key occurs in a batch of at most `at_most` rows, None if that is unknown.

    The keys of a small batch go to the state, which then is filtered where it lies. Against a large or
    unbounded batch both are shuffled.
    """
    keys = batch.select(key).distinct()
    if small(at_most):
        keys = F.broadcast(keys)
    return state.join(keys, key, "left_semi").select(*state.columns)


def concerned(state: DataFrame, batch: DataFrame, key: str, at_most: int | None) -> DataFrame:
    """The state rows to compare a batch with: filtered by a small batch, all for any other.

    For a large batch the join that follows does the filtering, so that the state is shuffled once.
    """
    return matching(state, batch, key, at_most) if small(at_most) else state


def newer_than_state(state: DataFrame, batch: DataFrame, key: str, version: str, at_most: int | None = None) -> DataFrame:
    """The batch rows an upsert would write: unknown key, or a strictly greater version.

    An equal or older version never wins, so replaying an old batch yields nothing. `batch` has one
    row per key and at most `at_most` rows; of the state only key and version are read.
    """
    met = concerned(state.select(key, version), batch, key, at_most)
    known = met.groupBy(F.col(key).alias("_k")).agg(F.max(version).alias("_v"))
    joined = batch.join(known, F.col(key) == F.col("_k"), "left")
    return joined.where(F.col("_k").isNull() | (F.col(version) > F.col("_v"))).drop("_k", "_v")


def upsert_guarded(state: DataFrame, batch: DataFrame, key: str, version: str) -> DataFrame:
    """The state after the batch: per key the greatest version, the state winning ties."""
    both = state.withColumn("_old", F.lit(1)).unionByName(batch.withColumn("_old", F.lit(0)))
    return latest_by(both, [key], [F.col(version), F.col("_old")]).drop("_old")


def above_high_water_mark(state: DataFrame, batch: DataFrame, version: str) -> DataFrame:
    """The batch rows above the greatest version the state holds anywhere (0 when it is empty)."""
    mark = state.agg(F.coalesce(F.max(version), F.lit(0)).alias("_mark"))
    return batch.where(F.col(version) > mark.scalar())


def unseen(state: DataFrame, batch: DataFrame, key: str, at_most: int | None = None) -> DataFrame:
    """The batch rows whose key the state does not hold. Of the state only the key is read."""
    known = concerned(state.select(key), batch, key, at_most)
    return batch.join(known, key, "left_anti").select(*batch.columns)


def insert_new(
    state: DataFrame, batch: DataFrame, key: str, order: Sequence[Column], at_most: int | None = None
) -> DataFrame:
    """What an insert-only merge appends: the first row of every key never seen before.

    Copies collapse first, before any shuffle; the join with the state then reuses their partitioning.
    """
    return unseen(state, first_by(batch, [key], order), key, at_most)


def newest_generation(df: DataFrame, key: str) -> DataFrame:
    """What holds of a table to which whole keys are appended again: of each key its newest generation.

    A key that has none left has one row marked `_gone` in it.
    """
    newest = df.groupBy(key).agg(F.max("_generation").alias("_newest"))
    held = df.join(newest, key).where((F.col("_generation") == F.col("_newest")) & ~F.col("_gone"))
    return held.select(*[c for c in df.columns if c not in ("_generation", "_gone")])


def overwrite_range(state: DataFrame, rebuilt: DataFrame, column: str, low: str, high: str) -> DataFrame:
    """The state with all rows of `column` in [low, high] replaced by the rebuilt ones.

    Rows of the range disappear even where the rebuild has none.
    """
    inside = F.col(column).between(F.lit(low).cast("date"), F.lit(high).cast("date"))
    return state.where(~inside).unionByName(rebuilt.where(inside))
