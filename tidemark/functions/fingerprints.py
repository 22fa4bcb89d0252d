"""Order-independent fingerprints of whole tables."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def row_digest(df: DataFrame) -> Column:
    """md5 of the row as JSON: sensitive to column names, values and nulls."""
    return F.md5(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}))


def _lane(digest: Column, start: int) -> Column:
    # 15 hex digits stay below 2**60, so the cast is exact.
    return F.conv(F.substring(digest, start, 15), 16, 10).cast("bigint")


# A number of 60 bits is added up in three parts, as whole numbers add up much faster than decimals.
_PART_BITS = 20


def _sum_of(lane: str) -> Column:
    parts = [F.shiftright(lane, n * _PART_BITS).bitwiseAND(F.lit((1 << _PART_BITS) - 1)) for n in range(3)]
    sums = [F.sum(part).cast("decimal(20,0)") * F.lit(1 << (n * _PART_BITS)).cast("decimal(13,0)") for n, part in enumerate(parts)]
    return (sums[0] + sums[1] + sums[2]).cast("decimal(38,0)")


def _lanes(*others: str) -> list[Column]:
    return [*[F.col(c) for c in others], _lane(F.col("d"), 1).alias("hi"), _lane(F.col("d"), 17).alias("lo")]


def lane_sums() -> list[Column]:
    """Aggregates over the two lanes `hi` and `lo` of row digests: `n_rows`, `hi` and `lo`.

    All three are sums, so those of parts of a table add up to the table's, and rows that go are subtracted.
    """
    # Sums of 20-bit numbers in 63 bits: room for 8 * 10**12 rows.
    return [F.count(F.lit(1)).alias("n_rows"), _sum_of("hi").alias("hi"), _sum_of("lo").alias("lo")]


def table_checksum(df: DataFrame) -> DataFrame:
    """One row (`n_rows`, `checksum`), equal for two tables with the same rows in any order.

    Row digests are added up, so the work is one scan with partial sums. No sort, no gathering, and
    duplicates count.
    """
    summed = df.select(row_digest(df).alias("d")).select(*_lanes()).agg(*lane_sums())
    # Only an empty table has no sums; any other null would be an overflow, and gives no checksum.
    lanes = [F.when(F.col("n_rows") == 0, "0").otherwise(F.col(lane).cast("string")) for lane in ("hi", "lo")]
    parts = F.concat(F.col("n_rows").cast("string"), F.lit("|"), lanes[0], F.lit("|"), lanes[1])
    return summed.select("n_rows", F.md5(parts).alias("checksum"))


def checksum(df: DataFrame) -> str:
    return table_checksum(df).first()["checksum"]


# Rows and the two sums of their digests.
Sums = tuple[int, int, int]


def sums_by(df: DataFrame, by: Column | None = None) -> dict[str | None, Sums]:
    """The sums of `df`, or of each of its parts by the text of a column; few parts are meant."""
    digests = df.select(row_digest(df).alias("d"), (F.lit(None) if by is None else by).cast("string").alias("part"))
    rows = digests.select(*_lanes("part")).groupBy("part").agg(*lane_sums()).collect()
    return {r["part"]: (r["n_rows"], int(r["hi"]), int(r["lo"])) for r in rows}


def added(parts: Iterable[Sums]) -> Sums:
    n = hi = lo = 0
    for part in parts:
        n, hi, lo = n + part[0], hi + part[1], lo + part[2]
    return n, hi, lo


def checksum_of(sums: Sums) -> str:
    """The checksum of a table with these sums, equal to that of its rows."""
    return hashlib.md5("|".join(map(str, sums)).encode()).hexdigest()


def combined_checksum(checksums: list[str]) -> str:
    """One checksum for several tables, in the given order."""
    return hashlib.md5("|".join(checksums).encode()).hexdigest()
