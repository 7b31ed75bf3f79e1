"""Document collections.

Two backings, one API:

* a folder of JSON-lines files per collection (``root/<collection>/``), read with
  Spark's JSON source - splittable, so scan parallelism follows
  ``spark.sql.files.maxPartitionBytes``;
* a MongoDB deployment through the MongoDB Spark connector (``format("mongodb")``)
  when its jar is on the classpath; reads from the primary with the sample
  partitioner and 1024 MB partitions, as the original jobs did.

``save_collection`` appends documents. A frame with an ``_id`` column replaces
whole documents with the same ``_id`` (connector semantics). For the file backing
this is an upsert on ``_id``:

* a plain collection is written anew, as another folder;
* a bucketed one, with a directory for each hash of ``_id``, has only the buckets
  rewritten that the new documents fall in, so the bytes written follow the change
  set. ``bucket_collection`` makes one of a plain collection.

The new documents are evaluated once, in both.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.merge import dedup_incoming
from ..operators.staged import staged_changes

# Named collections of the original crawl configuration.
NAMED_COLLECTIONS: dict[str, str] = {
    "coupon": "BankCouponInfo",
    "shop": "MainShop5",
}
DEFAULT_SPLIT_MB = 1024
ID_FIELD = "_id"
# Directories of a bucketed collection: ``_buckets=<how many>/_bucket=<which>``.
BUCKETS, BUCKET = "_buckets", "_bucket"
# JSON files keep full microsecond timestamps (Spark's default format keeps
# milliseconds only, which would silently truncate on a round trip).
JSON_FILE_OPTIONS: dict[str, str] = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


@dataclass(frozen=True)
class DocumentStore:
    """Either ``root`` (a folder of JSON-lines collections) or a connector URI."""

    root: str | None = None
    uri: str | None = None
    database: str | None = None
    options: dict[str, str] = field(default_factory=dict)

    def __post_init__(self):
        if (self.root is None) == (self.uri is None):
            raise ValueError("give exactly one of root= (files) or uri= (connector)")
        if self.uri is not None and not self.database:
            raise ValueError("a connector store needs database=")

    def path(self, collection: str) -> str:
        if self.root is None:
            raise ValueError("not a file-backed store")
        return f"{self.root.rstrip('/')}/{collection}"


def read_collection(
    spark: SparkSession,
    store: DocumentStore,
    collection: str,
    schema: T.StructType | str | None = None,
    split_mb: float | None = None,
    split_by: str = ID_FIELD,
    database: str | None = None,
) -> DataFrame:
    """A collection as a DataFrame; the schema is inferred unless given.

    Give the schema for large collections: inference is an extra pass over
    the data. ``database`` overrides the store's database for this read (connector
    only).

    ``split_mb`` asks for parts of about that many megabytes. The connector splits by
    ``_id`` (1024 MB if not given). For files, where the scan's own splits follow
    ``spark.sql.files.maxPartitionBytes``, it makes one shuffle into sorted ranges of
    ``split_by``, as many as the collection's bytes need; see ``range_splits``.
    """
    if store.root is not None:
        reader = spark.read.options(**JSON_FILE_OPTIONS)
        if schema is not None:
            reader = reader.schema(schema)
        docs = reader.json(store.path(collection)).drop(BUCKETS, BUCKET)
        return docs if split_mb is None else range_splits(docs, split_by, split_count(spark, store.path(collection), split_mb))
    reader = (
        spark.read.format("mongodb")
        .option("connection.uri", store.uri)
        .option("database", database or store.database)
        .option("collection", collection)
        .option("readPreference.name", "primary")
        .option("partitioner", "com.mongodb.spark.sql.connector.read.partitioner.SamplePartitioner")
        .option("partitioner.options.partition.size", str(split_mb or DEFAULT_SPLIT_MB))
    )
    for k, v in store.options.items():
        reader = reader.option(k, v)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load()


def split_count(spark: SparkSession, path: str, split_mb: float) -> int:
    """Parts of about ``split_mb`` megabytes in the files under ``path``. Only their
    lengths are read: the scan's ``content`` column is pruned away."""
    if split_mb <= 0:
        raise ValueError("split_mb must be > 0")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "[!_.]*")
    size = files.load(path).agg(F.sum("length")).first()[0] or 0
    return max(1, math.ceil(size / (split_mb * 1024 * 1024)))


def range_splits(df: DataFrame, by: str, parts: int) -> DataFrame:
    """``df`` in ``parts`` ranges of ``by``, near equal in rows, each sorted by it; NULLs
    are in the first. Spark samples the boundaries in the data; the sample steers the
    layout only, every row is in one range. A row number breaks ties, so a key that
    holds a large share of the rows, or NULL, takes several neighbouring ranges."""
    names = [f"c{i}" for i in range(len(df.columns))]
    key = F.col(names[df.columns.index(by)])
    rows = df.toDF(*names).withColumn("tie", F.monotonically_increasing_id())
    return rows.repartitionByRange(parts, key, "tie").sortWithinPartitions(key, "tie").drop("tie").toDF(*df.columns)


def read_named_collection(spark: SparkSession, store: DocumentStore, name: str, **kw) -> DataFrame:
    """``coupon`` / ``shop`` shortcuts to the configured collection names."""
    return read_collection(spark, store, NAMED_COLLECTIONS[name], **kw)


def save_collection(
    df: DataFrame,
    store: DocumentStore,
    collection: str,
    out_collection: str | None = None,
    buckets: int | None = None,
) -> str:
    """Append documents; with ``_id``, replace documents that share it.

    For the file backing, replacement in a plain collection writes
    ``out_collection`` (a new folder, required when ``_id`` is present and the
    collection exists) and returns its name; plain appends add files to the
    collection folder. ``buckets`` makes a new collection a bucketed one; a
    bucketed collection is changed in its own folder, bucket by bucket.
    """
    if store.uri is not None:
        writer = (
            df.write.format("mongodb")
            .mode("append")
            .option("connection.uri", store.uri)
            .option("database", store.database)
            .option("collection", collection)
        )
        for k, v in store.options.items():
            writer = writer.option(k, v)
        writer.save()
        return collection
    path, spark = store.path(collection), df.sparkSession
    if buckets is not None and buckets < 1:
        raise ValueError("buckets must be >= 1")
    current = _read_lines(spark, path)
    if current is not None and BUCKET in current.columns:
        n = current.select(BUCKETS).first()[0]
        if buckets not in (None, n):
            raise ValueError(f"{collection} has {n} buckets")
        _save_in_buckets(df, path, current, n)
        return collection
    if buckets is not None:
        if current is not None and not current.isEmpty():
            raise ValueError("not a bucketed collection: bucket_collection makes one of it")
        _save_in_buckets(df, path, None, buckets)
        return collection
    if ID_FIELD not in df.columns:
        df.write.options(**JSON_FILE_OPTIONS).mode("append").json(path)
        return collection
    if current is None:
        dedup_incoming(df, [ID_FIELD], keep="last").write.options(**JSON_FILE_OPTIONS).mode("errorifexists").json(path)
        return collection
    if not out_collection or out_collection == collection:
        raise ValueError("replacing by _id needs a new out_collection folder")
    with staged_changes(df, [ID_FIELD], keep="last") as changes:
        _replace_lines(current, changes).write.mode("errorifexists").text(store.path(out_collection))
    return out_collection


def bucket_collection(spark: SparkSession, store: DocumentStore, collection: str, out_collection: str, buckets: int) -> str:
    """A plain collection's lines, byte by byte, as a new bucketed collection."""
    lines = _read_lines(spark, store.path(collection))
    if lines is None or BUCKET in lines.columns or buckets < 1:
        raise ValueError("bucket_collection needs a plain collection and one bucket or more")
    placed = _placed(lines.select("value", _line_id().alias(ID_FIELD)), buckets)
    _write_buckets(placed, store.path(out_collection), "errorifexists")
    return out_collection


def _line_id():
    """A line's ``_id`` as text, whether a JSON string or number; null where it has none."""
    return F.from_json("value", f"`{ID_FIELD}` string", JSON_FILE_OPTIONS)[ID_FIELD]


def _json_line(df: DataFrame):
    return F.to_json(F.struct(*["`" + c.replace("`", "``") + "`" for c in df.columns]), JSON_FILE_OPTIONS)


def _placed(lines: DataFrame, n: int) -> DataFrame:
    """``(value, _id)`` with the bucket: by ``_id``, or by the whole line without one."""
    place = F.pmod(F.xxhash64(F.coalesce(ID_FIELD, "value")), F.lit(n)).cast("int")
    return lines.select("value", ID_FIELD, F.lit(n).alias(BUCKETS), place.alias(BUCKET))


def _write_buckets(placed: DataFrame, path: str, mode: str) -> None:
    """One directory a bucket. ``rebalance`` packs small buckets into one task and
    splits a large one. ``overwrite`` swaps the buckets of ``placed`` alone."""
    rows = placed.select("value", BUCKETS, BUCKET).hint("rebalance", BUCKET)
    rows.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(BUCKETS, BUCKET).text(path)


def _save_in_buckets(df: DataFrame, path: str, current: DataFrame | None, n: int) -> None:
    """Documents into a bucketed collection. Without ``_id`` they are added to their
    buckets; with it, each touched bucket is written anew: its lines whose ``_id`` no
    new document has, byte by byte, and the new documents. Other buckets are neither
    read nor written.

    Buckets are written to a staging folder and swapped when the job commits: a lost
    task changes nothing, and a run repeated after a failure gives the same
    collection, but readers meanwhile may see some buckets new and others old, and a
    driver lost amid the commit can leave a bucket missing."""
    if ID_FIELD not in df.columns:
        lines = df.select(_json_line(df).alias("value"), F.lit(None).cast("string").alias(ID_FIELD))
        _write_buckets(_placed(lines, n), path, "append")
        return
    if not isinstance(df.schema[ID_FIELD].dataType, (T.StringType, T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        raise ValueError("a bucketed collection needs a string or integer _id")
    with staged_changes(df, [ID_FIELD], keep="last") as changes:
        new = _placed(changes.select(_json_line(changes).alias("value"), F.col(ID_FIELD).cast("string").alias(ID_FIELD)), n)
        if current is None:
            _write_buckets(new, path, "append")
            return
        touched = [r[0] for r in new.select(BUCKET).distinct().collect()]  # a number for each bucket, n at most
        held = current.where(F.col(BUCKET).isin(touched)).select("value", _line_id().alias(ID_FIELD), BUCKETS, BUCKET)
        gone = new.where(F.col(ID_FIELD).isNotNull()).select(ID_FIELD)
        kept = held.where(F.col(ID_FIELD).isNotNull()).join(gone, ID_FIELD, "left_anti").select(*new.columns)
        _write_buckets(kept.unionByName(held.where(F.col(ID_FIELD).isNull())).unionByName(new), path, "overwrite")


def replace_documents(current: DataFrame, incoming: DataFrame) -> DataFrame:
    """Whole-document replacement on ``_id``: fields missing from the new
    document are gone, new fields are added; the last duplicate wins."""
    inc = dedup_incoming(incoming, [ID_FIELD], keep="last")
    kept = current.join(inc.filter(inc[ID_FIELD].isNotNull()).select(ID_FIELD), ID_FIELD, "left_anti")
    return kept.unionByName(inc, allowMissingColumns=True)


def _replace_lines(lines: DataFrame, changes: DataFrame) -> DataFrame:
    """The collection's JSON lines after replacement by documents of distinct ``_id``.
    Lines whose ``_id`` the new documents do not have stay as they are, byte by byte:
    only their ``_id`` is read, so no schema is inferred and no other value is
    converted. A line that is no JSON object, or has no ``_id`` of the new documents'
    type, stays too."""
    id_type = T.StructType([T.StructField(ID_FIELD, changes.schema[ID_FIELD].dataType)])
    known = lines.withColumn(ID_FIELD, F.from_json("value", id_type, JSON_FILE_OPTIONS)[ID_FIELD])
    gone = changes.filter(changes[ID_FIELD].isNotNull()).select(ID_FIELD)
    return known.join(gone, ID_FIELD, "left_anti").select("value").unionByName(
        changes.select(_json_line(changes).alias("value"))
    )


def _read_lines(spark: SparkSession, path: str) -> DataFrame | None:
    from pyspark.errors import AnalysisException

    try:
        return spark.read.text(path)
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc):
            return None
        raise
