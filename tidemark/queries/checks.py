"""Contracts: table tests, repeated keys, checksums, reconciliation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.fingerprints import combined_checksum, checksum
from tidemark.functions.fingerprints import table_checksum as checksum_of
from tidemark.operators import cdc, features, keyed, quality
from tidemark.queries.events import FIRST_DAY, LAST_DAY, silver_events
from tidemark.queries.inputs import CHANGE_SQL, EVENT_SQL, table, ticket_changes
from tidemark.queries.registry import Registry

registry = Registry()


@registry.query("""
SELECT 'not_null(l_orderkey)' AS rule, count(*) FILTER (WHERE l_orderkey IS NULL) AS violations FROM lineitem
UNION ALL SELECT 'not_null(l_shipdate)', count(*) FILTER (WHERE l_shipdate IS NULL) FROM lineitem
UNION ALL SELECT 'accepted_values(l_returnflag)', count(*) FILTER (WHERE l_returnflag NOT IN ('A', 'N')) FROM lineitem
UNION ALL SELECT 'accepted_values(l_linestatus)', count(*) FILTER (WHERE l_linestatus NOT IN ('O', 'F')) FROM lineitem
UNION ALL SELECT 'unique(l_orderkey, l_linenumber)', count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
UNION ALL SELECT 'unique(l_partkey)', count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_partkey HAVING count(*) > 1)""")
def table_tests(spark: SparkSession, sf: str) -> DataFrame:
    return quality.table_tests(
        table(spark, sf, "lineitem"),
        not_null=["l_orderkey", "l_shipdate"],
        accepted={"l_returnflag": ["A", "N"], "l_linestatus": ["O", "F"]},
        unique=[["l_orderkey", "l_linenumber"], ["l_partkey"]],
    )


@registry.query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def unique_combination(spark: SparkSession, sf: str) -> DataFrame:
    return quality.repeated_keys(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@registry.query("""
SELECT count(*) AS n_rows, count(DISTINCT l_orderkey) AS n_orders,
       (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) AS n_order_lines FROM lineitem""")
def distinct_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Rows, distinct keys and distinct pairs of keys."""
    return table(spark, sf, "lineitem").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct("l_orderkey").alias("n_orders"),
        F.count_distinct(F.struct("l_orderkey", "l_linenumber")).alias("n_order_lines"),
    )


def _checksum_sql(source: str) -> str:
    return f"""
SELECT n_rows, md5(n_rows || '|' || hi || '|' || lo) AS checksum
FROM (SELECT count(*) AS n_rows, sum(CAST(CAST('0x' || substr(d, 1, 15) AS BIGINT) AS HUGEINT)) AS hi,
             sum(CAST(CAST('0x' || substr(d, 17, 15) AS BIGINT) AS HUGEINT)) AS lo FROM (SELECT md5(j) AS d FROM ({source})))
"""


_ORDER_JSON = """
SELECT '{"o_orderkey":' || o_orderkey || ',"o_custkey":' || o_custkey || ',"o_orderstatus":"' || o_orderstatus
       || '","o_orderdate":"' || strftime(o_orderdate, '%Y-%m-%d') || '"}' AS j FROM orders"""


@registry.query(_checksum_sql(_ORDER_JSON))
def table_checksum(spark: SparkSession, sf: str) -> DataFrame:
    """Checksum of the order table, rows in any order."""
    orders = table(spark, sf, "orders")
    day = F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate")
    return checksum_of(orders.select("o_orderkey", "o_custkey", "o_orderstatus", day))


@registry.query(_checksum_sql(f"{_ORDER_JSON} UNION ALL {_ORDER_JSON}"))
def table_checksum_duplicated(spark: SparkSession, sf: str) -> DataFrame:
    """Every row twice is another table."""
    orders = table(spark, sf, "orders")
    day = F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate")
    once = orders.select("o_orderkey", "o_custkey", "o_orderstatus", day)
    return checksum_of(once.unionByName(once))


@registry.query(f"""
SELECT md5(a.checksum || '|' || b.checksum) AS checksum
FROM ({_checksum_sql(_ORDER_JSON)}) a, ({_checksum_sql(f"{_ORDER_JSON} UNION ALL {_ORDER_JSON}")}) b""")
def combined_checksums(spark: SparkSession, sf: str) -> DataFrame:
    """One checksum for the order table and its double."""
    orders = table(spark, sf, "orders")
    day = F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate")
    once = orders.select("o_orderkey", "o_custkey", "o_orderstatus", day)
    return spark.createDataFrame([(combined_checksum([checksum(once), checksum(once.unionByName(once))]),)], "checksum string")


def _agreement(name: str, a: DataFrame, b: DataFrame) -> DataFrame:
    """Whether two tables are equal, and the rows of each."""
    right = checksum_of(b).select(F.struct("checksum", "n_rows").alias("r"))
    both = checksum_of(a).withColumn("r", right.scalar())
    return both.select(
        F.lit(name).alias("subject"), (F.col("checksum") == F.col("r.checksum")).alias("agrees"), F.col("n_rows").alias("n_left"), F.col("r.n_rows").alias("n_right")
    )


@registry.query(f"""
SELECT 'gold_feature_daily' AS subject, true AS agrees, n AS n_left, n AS n_right
FROM (SELECT count(DISTINCT (user_id, CAST(ts AS DATE))) AS n FROM ({EVENT_SQL}) WHERE reason IS NULL)""")
def features_reconcile(spark: SparkSession, sf: str) -> DataFrame:
    """Features built in two windows against one aggregate over all events."""
    events = silver_events(spark, sf)
    first = features.daily_features_between(events, FIRST_DAY, "2024-01-15")
    second = features.daily_features_between(events, "2024-01-13", LAST_DAY)
    windowed = keyed.overwrite_range(first, second, "event_date", "2024-01-13", LAST_DAY)
    return _agreement("gold_feature_daily", windowed, features.daily_features(events))


@registry.query(f"""
SELECT 'silver_tickets' AS subject, true AS agrees, n AS n_left, n AS n_right
FROM (SELECT count(DISTINCT ticket_id) AS n FROM ({CHANGE_SQL}))""")
def tickets_parity(spark: SparkSession, sf: str) -> DataFrame:
    """Merging batch by batch against taking the newest change of the whole log."""
    changes = ticket_changes(spark, sf)
    early = cdc.ticket_state(changes.where(F.col("_batch_id") <= "2024-01-10"))
    late = cdc.ticket_state(changes.where(F.col("_batch_id") > "2024-01-10"))
    return _agreement("silver_tickets", keyed.upsert_guarded(early, late, "ticket_id", "_lsn"), cdc.ticket_state(changes))
