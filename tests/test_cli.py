from conftest import SF_SMALL, rows
from tidewater.cli import main
from tidewater.operators.merge import merge_state
from tidewater.operators.filters import filter_daily
from tidewater.plans import fixtures as fx


def test_cli_sync(spark, tmp_path, capsys):
    target = str(tmp_path / "v1")
    fx.events_target(spark, SF_SMALL).write.parquet(target)
    out = str(tmp_path / "v2")
    res = main(
        ["sync", "--source", f"{SF_SMALL}/events.parquet", "--target", target, "--out", out, "--mode", "upsert",
         "--keys", "event_id", "--day", "2024-01-15", "--column", "ts"],
        spark=spark,
    )
    assert res["table"] == out and '"table"' in capsys.readouterr().out
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    want = merge_state(spark.read.parquet(target), filter_daily(ev, "2024-01-15", column="ts"), "upsert",
                       keys=["event_id"])
    assert rows(spark.read.parquet(out)) == rows(want)


def test_cli_first_snapshot_without_target(spark, tmp_path):
    out = str(tmp_path / "v1")
    main(["sync", "--source", f"{SF_SMALL}/orders.parquet", "--out", out, "--mode", "append",
          "--start", "1996-01-0100:00:00", "--end", "1996-12-3123:59:59", "--column", "o_orderdate"], spark=spark)
    assert spark.read.parquet(out).count() > 0
