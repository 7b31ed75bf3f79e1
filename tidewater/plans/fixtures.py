"""Target/incoming table pairs derived from the driver tables.

A sync writes a change feed into an older snapshot of the same table, so each
pair is cut from one table by its own date column: the target is the table as
of a cut-off, the incoming frame is every row changed since an earlier date
(the overlap is the set of rows that exist on both sides). All work scales
with the tables; nothing is sampled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import read_table

# Cut-off dates used by the catalog queries and their SQL oracles.
ORDERS_TARGET_BEFORE = "1999-01-01"
ORDERS_CHANGED_SINCE = "1998-01-01"
LINEITEM_TARGET_BEFORE = "1998-01-01"
LINEITEM_CHANGED_SINCE = "1997-01-01"
EVENTS_SYNC_DAY = "2024-01-15"
EVENTS_TARGET_BEFORE = "2024-01-15 06:00:00"
# Of the sync day, the part that the whole-table targets lack: from EVENTS_TARGET_BEFORE up to here.
EVENTS_TARGET_AGAIN = "2024-01-15 12:00:00"


def ntz(day: str):
    return F.lit(day).cast(T.TimestampNTZType())


def orders_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    return o.filter(F.col("o_orderdate") < ntz(ORDERS_TARGET_BEFORE))


def orders_changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changed orders: price doubled, status cleared (a NULL that must overwrite)."""
    o = read_table(spark, sf_dir, "orders")
    return o.filter(F.col("o_orderdate") >= ntz(ORDERS_CHANGED_SINCE)).select(
        "o_orderkey",
        "o_custkey",
        F.lit(None).cast("string").alias("o_orderstatus"),
        (F.col("o_totalprice") * 2).alias("o_totalprice"),
        "o_orderdate",
        "o_orderpriority",
    )


def lineitem_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    return li.filter(F.col("l_shipdate") < ntz(LINEITEM_TARGET_BEFORE))


def lineitem_changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    return li.filter(F.col("l_shipdate") >= ntz(LINEITEM_CHANGED_SINCE)).withColumn(
        "l_quantity", F.col("l_quantity") + 1
    )


def events_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An older copy of ``events``, values stale (0). It ends within the sync day,
    so a change window holds both keys it has and keys it lacks."""
    ev = read_table(spark, sf_dir, "events")
    return ev.filter(F.col("ts") < ntz(EVENTS_TARGET_BEFORE)).withColumn("value", F.lit(0.0))


def is_new_event(column: str):
    """Rows that the whole-table targets lack; a null time isn't one of them."""
    c = F.col(column)
    return F.coalesce((c >= ntz(EVENTS_TARGET_BEFORE)) & (c < ntz(EVENTS_TARGET_AGAIN)), F.lit(False))


def events_target_stale(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of ``events`` with stale values (0), but for the part of the sync day that
    the change windows bring: no row is in neither of the two."""
    return read_table(spark, sf_dir, "events").filter(~is_new_event("ts")).withColumn("value", F.lit(0.0))
