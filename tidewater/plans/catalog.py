"""Catalog of runnable queries, one per operator, with DuckDB oracle SQL.

Each query takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
driver tables. ``ORACLE_SQL`` holds the same result as plain SQL over the
pre-registered views; column names are aliased identically on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.filters import filter_daily, filter_document_daily, filter_range
from ..operators.merge import SaveMode, dedup_incoming, merge_state
from ..session import read_table
from . import fixtures as fx
from .jobs import sync

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql.strip()
        return fn

    return deco


# --------------------------------------------------------------- filters

FILTER_RANGE_START = "2024-01-1006:30:00"
FILTER_RANGE_END = "2024-01-1218:45:59"


@register(
    "filter_daily",
    f"SELECT * FROM events WHERE strftime(ts, '%Y-%m-%d') = '{fx.EVENTS_SYNC_DAY}'",
)
def q_filter_daily(spark, sf_dir):
    return filter_daily(read_table(spark, sf_dir, "events"), fx.EVENTS_SYNC_DAY, column="ts")


@register("filter_daily_all", "SELECT * FROM events")
def q_filter_daily_all(spark, sf_dir):
    return filter_daily(read_table(spark, sf_dir, "events"), None, column="ts")


@register(
    "filter_daily_upper",
    "SELECT event_id, ts AS REC_UPD_TS, user_id, event_type, value, props FROM events "
    f"WHERE strftime(ts, '%Y-%m-%d') = '{fx.EVENTS_SYNC_DAY}'",
)
def q_filter_daily_upper(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events").withColumnRenamed("ts", "REC_UPD_TS")
    return filter_daily(ev, fx.EVENTS_SYNC_DAY, column="REC_UPD_TS")


@register(
    "filter_range",
    "SELECT * FROM events WHERE strftime(ts, '%Y-%m-%d%H:%M:%S') "
    f"BETWEEN '{FILTER_RANGE_START}' AND '{FILTER_RANGE_END}'",
)
def q_filter_range(spark, sf_dir):
    return filter_range(read_table(spark, sf_dir, "events"), FILTER_RANGE_START, FILTER_RANGE_END, column="ts")


@register(
    "document_daily",
    "SELECT event_id AS _id, ts AS updateAt, user_id, event_type, value, "
    "CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events "
    f"WHERE strftime(ts, '%Y-%m-%d') = '{fx.EVENTS_SYNC_DAY}'",
)
def q_document_daily(spark, sf_dir):
    from ..functions.records import read_json

    docs = read_table(spark, sf_dir, "events").select(
        F.col("event_id").alias("_id"),
        F.col("ts").alias("updateAt"),
        "user_id",
        "event_type",
        "value",
        "props",
    )
    day = filter_document_daily(docs, fx.EVENTS_SYNC_DAY)
    return day.withColumn("p", read_json("props", "k bigint")).select(
        "_id", "updateAt", "user_id", "event_type", "value", F.col("p.k").alias("k")
    )


# --------------------------------------------------------------- save modes

_ORDERS_T = f"SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '{fx.ORDERS_TARGET_BEFORE}'"
_ORDERS_I = (
    "SELECT o_orderkey, o_custkey, CAST(NULL AS VARCHAR) AS o_orderstatus, "
    "o_totalprice * 2 AS o_totalprice, o_orderdate, o_orderpriority FROM orders "
    f"WHERE o_orderdate >= TIMESTAMP '{fx.ORDERS_CHANGED_SINCE}'"
)
_ORDERS_CTE = f"WITH t AS ({_ORDERS_T}), i AS ({_ORDERS_I}) "


@register("save_append", _ORDERS_CTE + "SELECT * FROM t UNION ALL SELECT * FROM i")
def q_save_append(spark, sf_dir):
    return merge_state(fx.orders_target(spark, sf_dir), fx.orders_changed(spark, sf_dir), SaveMode.APPEND)


@register(
    "save_upsert",
    _ORDERS_CTE
    + "SELECT * FROM t WHERE NOT EXISTS (SELECT 1 FROM i WHERE i.o_orderkey = t.o_orderkey) "
    "UNION ALL SELECT * FROM i",
)
def q_save_upsert(spark, sf_dir):
    return merge_state(
        fx.orders_target(spark, sf_dir), fx.orders_changed(spark, sf_dir), SaveMode.UPSERT, keys=["o_orderkey"]
    )


@register(
    "save_upsert_partial",
    f"WITH t AS ({_ORDERS_T}), i AS (SELECT o_orderkey, o_totalprice * 2 AS o_totalprice FROM orders "
    f"WHERE o_orderdate >= TIMESTAMP '{fx.ORDERS_CHANGED_SINCE}') "
    "SELECT * FROM t WHERE NOT EXISTS (SELECT 1 FROM i WHERE i.o_orderkey = t.o_orderkey) "
    "UNION ALL SELECT i.o_orderkey, t.o_custkey, t.o_orderstatus, i.o_totalprice, t.o_orderdate, "
    "t.o_orderpriority FROM i LEFT JOIN t ON i.o_orderkey = t.o_orderkey",
)
def q_save_upsert_partial(spark, sf_dir):
    inc = fx.orders_changed(spark, sf_dir).select("o_orderkey", "o_totalprice")
    return merge_state(fx.orders_target(spark, sf_dir), inc, SaveMode.UPSERT, keys=["o_orderkey"])


@register(
    "save_ignore_record",
    _ORDERS_CTE
    + "SELECT * FROM t UNION ALL SELECT * FROM i "
    "WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.o_orderkey = i.o_orderkey)",
)
def q_save_ignore_record(spark, sf_dir):
    return merge_state(
        fx.orders_target(spark, sf_dir),
        fx.orders_changed(spark, sf_dir),
        SaveMode.IGNORE_RECORD,
        keys=["o_orderkey"],
    )


_LI_TIES = (
    "l_shipdate DESC NULLS LAST, l_partkey DESC NULLS LAST, l_suppkey DESC NULLS LAST, "
    "l_quantity DESC NULLS LAST, l_extendedprice DESC NULLS LAST, l_discount DESC NULLS LAST, "
    "l_tax DESC NULLS LAST, l_returnflag DESC NULLS LAST, l_linestatus DESC NULLS LAST"
)


@register(
    "save_upsert_composite",
    f"WITH t AS (SELECT * FROM lineitem WHERE l_shipdate < TIMESTAMP '{fx.LINEITEM_TARGET_BEFORE}'), "
    "i0 AS (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity + 1 AS l_quantity, "
    "l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate FROM lineitem "
    f"WHERE l_shipdate >= TIMESTAMP '{fx.LINEITEM_CHANGED_SINCE}'), "
    "i AS (SELECT * FROM i0 QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber "
    f"ORDER BY {_LI_TIES}) = 1) "
    "SELECT * FROM t WHERE NOT EXISTS (SELECT 1 FROM i WHERE i.l_orderkey = t.l_orderkey "
    "AND i.l_linenumber = t.l_linenumber) UNION ALL SELECT * FROM i",
)
def q_save_upsert_composite(spark, sf_dir):
    return merge_state(
        fx.lineitem_target(spark, sf_dir),
        fx.lineitem_changed(spark, sf_dir),
        SaveMode.UPSERT,
        keys=["l_orderkey", "l_linenumber"],
        order_by=["l_shipdate"],
    )


@register(
    "dedup_latest",
    "SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id "
    "ORDER BY ts DESC NULLS LAST, event_id DESC NULLS LAST) = 1",
)
def q_dedup_latest(spark, sf_dir):
    return dedup_incoming(read_table(spark, sf_dir, "events"), keys=["user_id"], order_by=["ts", "event_id"])


# --------------------------------------------------------------- jobs


# --------------------------------------------------------------- key scans

KEY_PATTERN = "cust:1?[57]*"
KEY_PATTERN_NEGATED = "cust:[^1]*0"


def _customer_keys(spark, sf_dir):
    from ..sources.keys import keyed_view

    return keyed_view(read_table(spark, sf_dir, "customer"), "cust:", ["c_custkey"], sep=":")


@register(
    "key_scan",
    "SELECT 'cust:' || CAST(c_custkey AS VARCHAR) AS key, * FROM customer "
    f"WHERE ('cust:' || CAST(c_custkey AS VARCHAR)) GLOB '{KEY_PATTERN}'",
)
def q_key_scan(spark, sf_dir):
    from ..sources.keys import key_scan

    return key_scan(_customer_keys(spark, sf_dir), KEY_PATTERN)


@register(
    "key_scan_negated",
    "SELECT 'cust:' || CAST(c_custkey AS VARCHAR) AS key FROM customer "
    "WHERE ('cust:' || CAST(c_custkey AS VARCHAR)) GLOB 'cust:[!1]*0'",
)
def q_key_scan_negated(spark, sf_dir):
    from ..sources.keys import key_scan

    return key_scan(_customer_keys(spark, sf_dir), KEY_PATTERN_NEGATED, keys_only=True)


@register(
    "key_scan_ranges",
    "SELECT 'order:' || CAST(o_orderkey AS VARCHAR) AS key, * FROM orders "
    "WHERE ('order:' || CAST(o_orderkey AS VARCHAR)) GLOB 'order:1[0-4]*'",
)
def q_key_scan_ranges(spark, sf_dir):
    """A key table stored in key order, about 131,072 rows a range; the scan's prefix
    skips the other row groups, and its matches come in four ranges."""
    from ..session import scratch_path
    from ..sources.keys import key_scan, keyed_view, write_key_layout
    from .layout import shards_for

    orders = read_table(spark, sf_dir, "orders")
    path = write_key_layout(
        keyed_view(orders, "order:", ["o_orderkey"]), scratch_path(spark, "order_keys"), shards_for(orders, 1 << 17)
    )
    return key_scan(spark.read.parquet(path), "order:1[0-4]*", partitions=4)


# --------------------------------------------------------------- JSON records

_PROPS_K = "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events"


@register("read_json", _PROPS_K)
def q_read_json(spark, sf_dir):
    from ..functions.records import read_json

    ev = read_table(spark, sf_dir, "events")
    return ev.select("event_id", read_json("props", "k bigint")["k"].alias("k"))


@register("read_json_strict", _PROPS_K)
def q_read_json_strict(spark, sf_dir):
    from ..functions.records import read_json

    ev = read_table(spark, sf_dir, "events")
    return ev.select("event_id", read_json("props", "k bigint", strict=True)["k"].alias("k"))


@register("read_encoded_json", _PROPS_K)
def q_read_encoded_json(spark, sf_dir):
    from ..functions.records import read_encoded_json

    ev = read_table(spark, sf_dir, "events").withColumn("props_enc", F.url_encode("props"))
    return ev.select("event_id", read_encoded_json("props_enc", "k bigint")["k"].alias("k"))


@register(
    "record_convert",
    "SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS INTEGER) AS o_custkey, "
    "CAST(o_totalprice AS DECIMAL(12,2)) AS o_totalprice, o_orderstatus FROM orders",
)
def q_record_convert(spark, sf_dir):
    from ..functions.records import convert_record

    o = read_table(spark, sf_dir, "orders")
    rec = F.struct("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    schema = "o_orderkey string, o_custkey int, o_totalprice decimal(12,2), o_orderstatus string"
    return o.select(convert_record(rec, schema).alias("r")).select("r.*")


# --------------------------------------------------------------- ids

_ID_COUNTS = "SELECT count(*) AS n, count(*) AS n_distinct, count(*) AS n_ok FROM orders"


def _id_counts(df, entity):
    from ..functions.ids import id_pattern

    return df.agg(
        F.count("*").alias("n"),
        F.countDistinct("id").alias("n_distinct"),
        F.count(F.when(F.col("id").rlike(id_pattern(entity)), 1)).alias("n_ok"),
    )


def _entity_query(entity):
    def q(spark, sf_dir):
        from ..functions.ids import with_entity_id

        return _id_counts(with_entity_id(read_table(spark, sf_dir, "orders"), entity), entity)

    q.__name__ = f"q_entity_ids_{entity}"
    return q


for _entity in ("shop", "coupon", "goods", "comment", "brand", "area"):
    register(f"entity_ids_{_entity}", _ID_COUNTS)(_entity_query(_entity))


@register("entity_ids_deterministic", _ID_COUNTS)
def q_entity_ids_deterministic(spark, sf_dir):
    from ..functions.ids import with_entity_id

    o = read_table(spark, sf_dir, "orders")
    return _id_counts(with_entity_id(o, "shop", deterministic_from=["o_orderkey"]), "shop")


# --------------------------------------------------------------- layout


@register("hash_layout", "SELECT * FROM orders")
def q_hash_layout(spark, sf_dir):
    from ..session import scratch_path
    from .layout import SHARD_COL, shards_for, write_hash_layout

    orders = read_table(spark, sf_dir, "orders")
    path = write_hash_layout(orders, scratch_path(spark, "orders_hash"), "o_orderkey", shards_for(orders, 1 << 20))
    return spark.read.parquet(path).drop(SHARD_COL)


@register("cap_partitions", "SELECT * FROM lineitem")
def q_cap_partitions(spark, sf_dir):
    from .layout import cap_partitions

    # nothing but the scan comes before the cap: no shuffle is due to keep it wide
    return cap_partitions(read_table(spark, sf_dir, "lineitem"), 3, shuffle=False)


# --------------------------------------------------------------- snapshot tables


def _snapshot(spark, name, df):
    from ..session import scratch_path

    path = scratch_path(spark, name)
    df.write.parquet(path)
    return path


@register("save_overwrite", _ORDERS_I)
def q_save_overwrite(spark, sf_dir):
    from ..session import scratch_path
    from ..sinks.snapshot import save_snapshot

    t = _snapshot(spark, "orders_t", fx.orders_target(spark, sf_dir))
    out = save_snapshot(fx.orders_changed(spark, sf_dir), t, scratch_path(spark, "orders_o"), SaveMode.OVERWRITE)
    return spark.read.parquet(out)


@register("save_ignore_table", _ORDERS_T)
def q_save_ignore_table(spark, sf_dir):
    from ..session import scratch_path
    from ..sinks.snapshot import save_snapshot

    t = _snapshot(spark, "orders_t", fx.orders_target(spark, sf_dir))
    out = save_snapshot(fx.orders_changed(spark, sf_dir), t, scratch_path(spark, "orders_i"), SaveMode.IGNORE_TABLE)
    return spark.read.parquet(out)


@register("save_upsert_snapshot", ORACLE_SQL["save_upsert"])
def q_save_upsert_snapshot(spark, sf_dir):
    from ..session import scratch_path
    from ..sinks.snapshot import save_snapshot

    t = _snapshot(spark, "orders_t", fx.orders_target(spark, sf_dir))
    out = save_snapshot(
        fx.orders_changed(spark, sf_dir), t, scratch_path(spark, "orders_u"), SaveMode.UPSERT, keys=["o_orderkey"]
    )
    return spark.read.parquet(out)


# --------------------------------------------------------------- documents

_DOC_SCHEMA = "_id bigint, text string, lang string, source string, n_chars bigint"


def _documents_store(spark, sf_dir):
    from ..session import scratch_path
    from ..sources.documents import DocumentStore, save_collection

    store = DocumentStore(root=scratch_path(spark, "docstore"))
    docs = read_table(spark, sf_dir, "documents").withColumnRenamed("doc_id", "_id")
    save_collection(docs, store, "documents")
    return store


@register("document_scan", "SELECT doc_id AS _id, text, lang, source, n_chars FROM documents")
def q_document_scan(spark, sf_dir):
    from ..sources.documents import read_collection

    store = _documents_store(spark, sf_dir)
    return read_collection(spark, store, "documents", schema=_DOC_SCHEMA)


@register("document_range_splits", "SELECT doc_id AS _id, text, lang, source, n_chars FROM documents")
def q_document_range_splits(spark, sf_dir):
    """The whole collection in sorted ``_id`` ranges of about 64 MB."""
    from ..sources.documents import read_collection

    store = _documents_store(spark, sf_dir)
    return read_collection(spark, store, "documents", schema=_DOC_SCHEMA, split_mb=64)


@register(
    "document_replace",
    "SELECT doc_id AS _id, text, lang, source, n_chars FROM documents WHERE lang IS DISTINCT FROM 'en' "
    "UNION ALL SELECT doc_id AS _id, text, lang, source || '-v2' AS source, CAST(NULL AS BIGINT) AS n_chars "
    "FROM documents WHERE lang = 'en'",
)
def q_document_replace(spark, sf_dir):
    from ..sources.documents import read_collection, save_collection

    store = _documents_store(spark, sf_dir)
    docs = read_table(spark, sf_dir, "documents").filter(F.col("lang") == "en")
    new = docs.select(F.col("doc_id").alias("_id"), "text", "lang", F.concat("source", F.lit("-v2")).alias("source"))
    out = save_collection(new, store, "documents", out_collection="documents_v2")
    return read_collection(spark, store, out, schema=_DOC_SCHEMA)


@register(
    "document_replace_bucketed",
    "SELECT doc_id AS _id, text, lang, source, n_chars FROM documents WHERE lang IS DISTINCT FROM 'en' "
    "UNION ALL SELECT doc_id AS _id, text, lang, source || '-v2' AS source, CAST(NULL AS BIGINT) AS n_chars "
    "FROM documents WHERE lang = 'en'",
)
def q_document_replace_bucketed(spark, sf_dir):
    """The same replacement in a bucketed collection's own folder, with about 1,000
    documents a bucket."""
    from ..sources.documents import bucket_collection, read_collection, save_collection
    from .layout import shards_for

    store = _documents_store(spark, sf_dir)
    docs = read_table(spark, sf_dir, "documents")
    name = bucket_collection(spark, store, "documents", "documents_bucketed", shards_for(docs, 1000))
    new = docs.filter(F.col("lang") == "en").select(
        F.col("doc_id").alias("_id"), "text", "lang", F.concat("source", F.lit("-v2")).alias("source")
    )
    save_collection(new, store, name)
    return read_collection(spark, store, name, schema=_DOC_SCHEMA)


# --------------------------------------------------------------- composed jobs



SYNC_RANGE_START = "2024-01-1412:00:00"
SYNC_RANGE_END = "2024-01-1511:59:59"


# --------------------------------------------------------------- whole tables

# Syncs and saves over every row of their table: no row is in neither target nor change set.
_IS_NEW = "({0} >= TIMESTAMP '" + fx.EVENTS_TARGET_BEFORE + "' AND {0} < TIMESTAMP '" + fx.EVENTS_TARGET_AGAIN + "') IS TRUE"
_EVENTS_T = (
    "SELECT event_id, ts, user_id, event_type, CAST(0.0 AS DOUBLE) AS value, props FROM events "
    f"WHERE NOT {_IS_NEW.format('ts')}"
)
_SYNC_SQL = (
    f"WITH t AS ({_EVENTS_T}), "
    f"i AS (SELECT * FROM events WHERE strftime(ts, '%Y-%m-%d') = '{fx.EVENTS_SYNC_DAY}') "
    "SELECT * FROM t WHERE NOT EXISTS (SELECT 1 FROM i WHERE i.event_id = t.event_id) "
    "UNION ALL SELECT * FROM i"
)


@register("sync_daily_upsert", _SYNC_SQL)
def q_sync_daily_upsert(spark, sf_dir):
    return sync(
        read_table(spark, sf_dir, "events"),
        fx.events_target_stale(spark, sf_dir),
        SaveMode.UPSERT,
        keys=["event_id"],
        day=fx.EVENTS_SYNC_DAY,
        column="ts",
    )


@register("sync_daily_snapshot", _SYNC_SQL)
def q_sync_daily_snapshot(spark, sf_dir):
    from ..session import scratch_path
    from .jobs import sync_to_path

    out = sync_to_path(
        read_table(spark, sf_dir, "events"),
        _snapshot(spark, "events_tw", fx.events_target_stale(spark, sf_dir)),
        scratch_path(spark, "events_sync"),
        SaveMode.UPSERT,
        keys=["event_id"],
        day=fx.EVENTS_SYNC_DAY,
        column="ts",
    )
    return spark.read.parquet(out)


@register(
    "sync_range_ignore_record",
    f"WITH t AS ({_EVENTS_T}), "
    "i AS (SELECT * FROM events WHERE strftime(ts, '%Y-%m-%d%H:%M:%S') "
    f"BETWEEN '{SYNC_RANGE_START}' AND '{SYNC_RANGE_END}') "
    "SELECT * FROM t UNION ALL SELECT * FROM i WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.event_id = i.event_id)",
)
def q_sync_range_ignore_record(spark, sf_dir):
    return sync(
        read_table(spark, sf_dir, "events"),
        fx.events_target_stale(spark, sf_dir),
        SaveMode.IGNORE_RECORD,
        keys=["event_id"],
        start=SYNC_RANGE_START,
        end=SYNC_RANGE_END,
        column="ts",
    )


@register(
    "job_document_daily",
    "WITH d AS (SELECT event_id AS _id, ts AS updateAt, user_id, "
    "CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events), "
    f"t AS (SELECT _id, updateAt, user_id, CAST(0 AS BIGINT) AS k FROM d WHERE NOT {_IS_NEW.format('updateAt')}), "
    f"i AS (SELECT * FROM d WHERE strftime(updateAt, '%Y-%m-%d') = '{fx.EVENTS_SYNC_DAY}') "
    "SELECT * FROM t WHERE NOT EXISTS (SELECT 1 FROM i WHERE i._id = t._id) UNION ALL SELECT * FROM i",
)
def q_job_document_daily(spark, sf_dir):
    from ..functions.records import read_json
    from ..session import scratch_path
    from ..sources.documents import DocumentStore, read_collection, save_collection

    store = DocumentStore(root=scratch_path(spark, "eventdocs"))
    ev = read_table(spark, sf_dir, "events")
    save_collection(ev.select(F.col("event_id").alias("_id"), F.col("ts").alias("updateAt"), "user_id", "props"), store, "events")
    coll = read_collection(spark, store, "events", schema="_id bigint, updateAt timestamp_ntz, user_id bigint, props string")
    typed = coll.select("_id", "updateAt", "user_id", read_json("props", "k bigint")["k"].alias("k"))
    target = typed.filter(~fx.is_new_event("updateAt")).withColumn("k", F.lit(0).cast("long"))
    return merge_state(target, filter_document_daily(typed, fx.EVENTS_SYNC_DAY), SaveMode.UPSERT, keys=["_id"])


@register("save_error_if_exists", "SELECT * FROM orders")
def q_save_error_if_exists(spark, sf_dir):
    from ..session import scratch_path
    from ..sinks.snapshot import save_snapshot

    missing = scratch_path(spark, "orders_missing")
    orders = read_table(spark, sf_dir, "orders")
    return spark.read.parquet(save_snapshot(orders, missing, scratch_path(spark, "orders_ew"), SaveMode.ERROR_IF_EXISTS))


@register(
    "save_upsert_labels",
    "WITH i AS (SELECT doc_id, CAST(CASE WHEN n_chars > 1000 THEN 1 ELSE 0 END AS INTEGER) AS quality FROM documents) "
    "SELECT * FROM labels l WHERE NOT EXISTS (SELECT 1 FROM i WHERE i.doc_id = l.doc_id) "
    "UNION ALL SELECT i.doc_id, i.quality, l.toxic FROM i LEFT JOIN labels l ON i.doc_id = l.doc_id",
)
def q_save_upsert_labels(spark, sf_dir):
    quality = F.when(F.col("n_chars") > 1000, 1).otherwise(0).cast("int").alias("quality")
    inc = read_table(spark, sf_dir, "documents").select("doc_id", quality)
    return merge_state(read_table(spark, sf_dir, "labels"), inc, SaveMode.UPSERT, keys=["doc_id"])


# --------------------------------------------------------------- bucketed tables


@register("save_upsert_bucketed", ORACLE_SQL["save_upsert"])
def q_save_upsert_bucketed(spark, sf_dir):
    """Upsert into a table bucketed by the key: the next merge reads the target
    without shuffling it (only the change set moves)."""
    import uuid

    from ..session import scratch_path
    from ..sinks.table import save_table

    tag = uuid.uuid4().hex[:12]
    # Fixed bucket count for the check tables; a session whose shuffle
    # partition count exceeds it plans a normal shuffle join (same result).
    buckets = 16
    t = save_table(
        fx.orders_target(spark, sf_dir), None, f"tw_orders_{tag}_v1", SaveMode.OVERWRITE,
        keys=["o_orderkey"], path=scratch_path(spark, "orders_b1"), buckets=buckets,
    )
    out = save_table(
        fx.orders_changed(spark, sf_dir), t, f"tw_orders_{tag}_v2", SaveMode.UPSERT,
        keys=["o_orderkey"], path=scratch_path(spark, "orders_b2"), buckets=buckets,
    )
    return spark.table(out)


# --------------------------------------------------------------- partition pruning


@register("filter_daily_partitioned", ORACLE_SQL["filter_daily"])
def q_filter_daily_partitioned(spark, sf_dir):
    """The daily filter on a copy of ``events`` partitioned by day: Spark lists
    and reads only that day's directory (``PartitionFilters``)."""
    from ..session import scratch_path

    path = scratch_path(spark, "events_by_day")
    read_table(spark, sf_dir, "events").withColumn("dt", F.date_format("ts", "yyyy-MM-dd")).write.partitionBy(
        "dt"
    ).parquet(path)
    parted = spark.read.parquet(path)
    return filter_daily(parted, fx.EVENTS_SYNC_DAY, column="ts", partition_column="dt").drop("dt")


# --------------------------------------------------------------- composite keys on text rows

_CONV_T = "SELECT * FROM conversations WHERE turn < 4"
_CONV_I = "SELECT conv_id, turn, role || '-edited' AS role, text FROM conversations WHERE turn >= 2"


def _conversations(spark, sf_dir):
    c = read_table(spark, sf_dir, "conversations")
    target = c.filter(F.col("turn") < 4)
    incoming = c.filter(F.col("turn") >= 2).withColumn("role", F.concat("role", F.lit("-edited")))
    return target, incoming


@register(
    "save_upsert_conversations",
    f"WITH t AS ({_CONV_T}), i AS ({_CONV_I}) "
    "SELECT * FROM t WHERE NOT EXISTS (SELECT 1 FROM i WHERE i.conv_id = t.conv_id AND i.turn = t.turn) "
    "UNION ALL SELECT * FROM i",
)
def q_save_upsert_conversations(spark, sf_dir):
    t, i = _conversations(spark, sf_dir)
    return merge_state(t, i, SaveMode.UPSERT, keys=["conv_id", "turn"])


@register(
    "save_ignore_record_conversations",
    f"WITH t AS ({_CONV_T}), i AS ({_CONV_I}) "
    "SELECT * FROM t UNION ALL SELECT * FROM i "
    "WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.conv_id = i.conv_id AND t.turn = i.turn)",
)
def q_save_ignore_record_conversations(spark, sf_dir):
    t, i = _conversations(spark, sf_dir)
    return merge_state(t, i, SaveMode.IGNORE_RECORD, keys=["conv_id", "turn"])


# --------------------------------------------------------------- partition-local merge


@register(
    "save_upsert_partitioned",
    "WITH l AS (SELECT *, CAST(date_trunc('month', l_shipdate) AS DATE) AS l_month FROM lineitem), "
    f"t AS (SELECT * FROM l WHERE l_shipdate < TIMESTAMP '{fx.LINEITEM_TARGET_BEFORE}'), "
    "i0 AS (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity + 1 AS l_quantity, "
    "l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate, l_month FROM l "
    f"WHERE l_shipdate >= TIMESTAMP '{fx.LINEITEM_CHANGED_SINCE}'), "
    "i AS (SELECT * FROM i0 QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber, l_month "
    f"ORDER BY {_LI_TIES}) = 1) "
    "SELECT * FROM t WHERE NOT EXISTS (SELECT 1 FROM i WHERE i.l_orderkey = t.l_orderkey "
    "AND i.l_linenumber = t.l_linenumber AND i.l_month = t.l_month) UNION ALL SELECT * FROM i",
)
def q_save_upsert_partitioned(spark, sf_dir):
    """Upsert into a snapshot partitioned by month, with the month in the key:
    only the months the change set touches go through the merge joins."""
    from ..session import scratch_path
    from ..sinks.snapshot import save_snapshot

    month = F.trunc(F.to_date("l_shipdate"), "month")
    target = fx.lineitem_target(spark, sf_dir).withColumn("l_month", month)
    base = scratch_path(spark, "lineitem_by_month")
    target.write.partitionBy("l_month").parquet(base)
    keys = ["l_orderkey", "l_linenumber", "l_month"]
    out = save_snapshot(
        fx.lineitem_changed(spark, sf_dir).withColumn("l_month", month),
        base,
        scratch_path(spark, "lineitem_by_month_v2"),
        SaveMode.UPSERT,
        keys=keys,
        order_by=["l_shipdate"],
        partition_by=["l_month"],
    )
    return spark.read.parquet(out)


# --------------------------------------------------------------- spare tables


@register(
    "save_upsert_part",
    "WITH t AS (SELECT * FROM part WHERE p_size < 30), "
    "i AS (SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice * 1.1 AS p_retailprice "
    "FROM part WHERE p_size >= 20) "
    "SELECT * FROM t WHERE NOT EXISTS (SELECT 1 FROM i WHERE i.p_partkey = t.p_partkey) UNION ALL SELECT * FROM i",
)
def q_save_upsert_part(spark, sf_dir):
    p = read_table(spark, sf_dir, "part")
    target = p.filter(F.col("p_size") < 30)
    incoming = p.filter(F.col("p_size") >= 20).withColumn("p_retailprice", F.col("p_retailprice") * 1.1)
    return merge_state(target, incoming, SaveMode.UPSERT, keys=["p_partkey"])


@register(
    "save_ignore_record_supplier",
    "WITH t AS (SELECT * FROM supplier WHERE s_acctbal >= 0), "
    "i AS (SELECT s_suppkey, s_name, s_nationkey, CAST(0.0 AS DOUBLE) AS s_acctbal FROM supplier) "
    "SELECT * FROM t UNION ALL SELECT * FROM i WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.s_suppkey = i.s_suppkey)",
)
def q_save_ignore_record_supplier(spark, sf_dir):
    s = read_table(spark, sf_dir, "supplier")
    target = s.filter(F.col("s_acctbal") >= 0)
    incoming = s.withColumn("s_acctbal", F.lit(0.0))
    return merge_state(target, incoming, SaveMode.IGNORE_RECORD, keys=["s_suppkey"])


@register("hash_layout_spread", "SELECT * FROM lineitem")
def q_hash_layout_spread(spark, sf_dir):
    """Hash layout of ``lineitem`` on ``l_orderkey`` with each shard written by
    up to four tasks (deterministic row-hash salt), read back whole."""
    from ..session import scratch_path
    from .layout import SHARD_COL, write_hash_layout

    path = write_hash_layout(
        read_table(spark, sf_dir, "lineitem"), scratch_path(spark, "lineitem_hash"), "l_orderkey", 8, spread=4
    )
    return spark.read.parquet(path).drop(SHARD_COL)


# --------------------------------------------------------------- streaming

STREAM_ARRIVALS = (("2024-01-10", "2024-01-15"), ("2024-01-15", "2024-01-20"), ("2024-01-20", "2024-02-01"))


@register(
    "stream_sync_upsert",
    f"SELECT event_id, ts, user_id, event_type, CAST(0.0 AS DOUBLE) AS value, props FROM events "
    f"WHERE ts < TIMESTAMP '{STREAM_ARRIVALS[0][0]}' "
    f"UNION ALL SELECT * FROM events WHERE ts >= TIMESTAMP '{STREAM_ARRIVALS[0][0]}'",
)
def q_stream_sync_upsert(spark, sf_dir):
    """Structured Streaming sync: ``events`` arrives in three folders; each is
    consumed by one ``availableNow`` run of the same streaming query, whose
    micro-batch upserts into the latest Parquet snapshot (one version per
    batch). Keys are unique, so the result does not depend on arrival order."""
    from ..session import scratch_path
    from ..streaming.sync_stream import latest_snapshot, run_available, snapshot_batch_writer

    ev = read_table(spark, sf_dir, "events")
    initial = scratch_path(spark, "events_stream_initial")
    ev.filter(F.col("ts") < fx.ntz(fx.EVENTS_TARGET_BEFORE)).withColumn("value", F.lit(0.0)).write.parquet(initial)
    arrivals = scratch_path(spark, "events_arrivals")
    base = scratch_path(spark, "events_stream_table")
    ckpt = scratch_path(spark, "events_stream_ckpt")
    writer = snapshot_batch_writer(base, SaveMode.UPSERT, keys=["event_id"], initial=initial)
    for i, (lo, hi) in enumerate(STREAM_ARRIVALS):
        part = ev.filter((F.col("ts") >= fx.ntz(lo)) & (F.col("ts") < fx.ntz(hi)))
        part.write.parquet(f"{arrivals}/arrival={i}")
        stream = spark.readStream.schema(ev.schema).parquet(f"{arrivals}/arrival=*")
        run_available(stream, writer, ckpt)
    return spark.read.parquet(latest_snapshot(spark, base))


@register("save_upsert_in_place", ORACLE_SQL["save_upsert_partitioned"])
def q_save_upsert_in_place(spark, sf_dir):
    """The month-partitioned upsert written back into the table itself: only
    the touched month directories are rewritten (dynamic partition overwrite)."""
    from ..session import scratch_path
    from ..sinks.snapshot import save_partitions_in_place

    month = F.trunc(F.to_date("l_shipdate"), "month")
    table = scratch_path(spark, "lineitem_in_place")
    fx.lineitem_target(spark, sf_dir).withColumn("l_month", month).write.partitionBy("l_month").parquet(table)
    save_partitions_in_place(
        fx.lineitem_changed(spark, sf_dir).withColumn("l_month", month),
        table,
        SaveMode.UPSERT,
        keys=["l_orderkey", "l_linenumber", "l_month"],
        partition_by=["l_month"],
        order_by=["l_shipdate"],
    )
    return spark.read.parquet(table)


# --------------------------------------------------------------- key scans over stored keys

PAGE_PATTERN = "http?://*/[de]?/*"


@register(
    "key_scan_pages",
    f"SELECT page_id, url, html FROM pages WHERE url GLOB '{PAGE_PATTERN}'",
)
def q_key_scan_pages(spark, sf_dir):
    """A glob over a stored key column (``url``): the literal prefix reaches
    the Parquet scan as ``StringStartsWith``; whole rows (long HTML) come back."""
    from ..sources.keys import key_scan

    return key_scan(read_table(spark, sf_dir, "pages"), PAGE_PATTERN, key="url")
