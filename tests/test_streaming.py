from pyspark.sql import functions as F

from conftest import SF_SMALL, rows
from tidewater.operators.merge import dedup_incoming
from tidewater.streaming.sync_stream import committed_versions, latest_snapshot, snapshot_batch_writer, start_sync


def test_stream_upsert_matches_batch(spark, tmp_path):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    src = tmp_path / "src"
    # Three arrival files, one per ten days of events.
    for i, (lo, hi) in enumerate([("2024-01-01", "2024-01-11"), ("2024-01-11", "2024-01-21"), ("2024-01-21", "2024-02-01")]):
        part = ev.filter((F.col("ts") >= F.lit(lo).cast("timestamp_ntz")) & (F.col("ts") < F.lit(hi).cast("timestamp_ntz")))
        part.coalesce(1).write.parquet(str(src / f"f{i}"))
    stream = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(str(src / "*" / "*.parquet"))
    base = str(tmp_path / "table")
    writer = snapshot_batch_writer(base, "upsert", keys=["user_id"], order_by=["ts", "event_id"])
    q = start_sync(stream, writer, str(tmp_path / "ckpt"))
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    assert committed_versions(spark, base) == [0, 1, 2]
    got = spark.read.parquet(latest_snapshot(spark, base))
    want = dedup_incoming(ev, ["user_id"], order_by=["ts", "event_id"])
    assert rows(got) == rows(want)
    # A replayed batch id is a no-op.
    writer(spark.createDataFrame([], ev.schema), 2)
    assert committed_versions(spark, base) == [0, 1, 2]


def test_replay_replaces_an_unfinished_version(spark, tmp_path):
    from tidewater.streaming.sync_stream import version_path

    base = str(tmp_path / "table")
    writer = snapshot_batch_writer(base, "upsert", keys=["k"])
    first = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    writer(first, 0)
    # A crashed attempt of batch 1 left files but no _SUCCESS marker.
    broken = tmp_path / "table" / version_path("", 1).lstrip("/")
    broken.mkdir(parents=True)
    (broken / "part-junk.parquet").write_bytes(b"not parquet")
    assert committed_versions(spark, base) == [0]
    writer(spark.createDataFrame([(2, "B"), (3, "c")], "k int, v string"), 1)
    assert committed_versions(spark, base) == [0, 1]
    got = sorted(tuple(r) for r in spark.read.parquet(latest_snapshot(spark, base)).collect())
    assert got == [(1, "a"), (2, "B"), (3, "c")]
