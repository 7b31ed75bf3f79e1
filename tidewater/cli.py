"""Command-line sync job.

    python -m tidewater.cli sync \\
        --source s3://lake/orders --target s3://lake/t/v41 --out s3://lake/t/v42 \\
        --mode upsert --keys o_orderkey --day 2024-01-15 --column o_updated_at

On a cluster, ship the package (``--py-files tidewater.zip``) and submit
``tidewater/cli.py`` with the same arguments.

Reads the source table (Parquet), keeps the changed window, merges it into the
target snapshot under the save mode and writes the new snapshot; prints one
JSON line with the path that now holds the table.
"""

from __future__ import annotations

import argparse
import json
import sys

from tidewater.operators.merge import SaveMode


def _csv(value: str | None) -> list[str] | None:
    return [v.strip() for v in value.split(",") if v.strip()] if value else None


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tidewater")
    sub = p.add_subparsers(dest="command", required=True)
    s = sub.add_parser("sync", help="sync a changed window of a Parquet table into a snapshot")
    s.add_argument("--source", required=True, help="source table path (Parquet)")
    s.add_argument("--target", default=None, help="current snapshot path; omit when there is none yet")
    s.add_argument("--out", required=True, help="path for the new snapshot (must differ from --target)")
    s.add_argument("--mode", default="upsert", choices=[m.value for m in SaveMode])
    s.add_argument("--keys", default=None, help="comma-separated key columns (default: first column)")
    s.add_argument("--order-by", default=None, help="comma-separated columns deciding which duplicate wins")
    s.add_argument("--column", default="rec_upd_ts", help="change timestamp column")
    s.add_argument("--day", default=None, help="yyyy-MM-dd")
    s.add_argument("--start", default=None, help="yyyy-MM-ddHH:mm:ss (inclusive)")
    s.add_argument("--end", default=None, help="yyyy-MM-ddHH:mm:ss (inclusive)")
    s.add_argument("--partition-column", default=None, help="day partition column of the source")
    s.add_argument("--partition-by", default=None, help="comma-separated partition columns of the snapshot")
    s.add_argument("--materialize", default=None, choices=["checkpoint", "persist"])
    s.add_argument("--no-dedup", action="store_true", help="change-set keys are known to be unique")
    s.add_argument("--time-zone", default=None, help="session time zone for wall-clock filters (default: keep)")
    return p


def main(argv: list[str] | None = None, spark=None) -> dict:
    args = parser().parse_args(argv)
    from tidewater.plans.jobs import sync_to_path
    from tidewater.session import build_session

    spark = spark or build_session(app_name="tidewater-sync", time_zone=args.time_zone)
    out = sync_to_path(
        spark.read.parquet(args.source),
        args.target,
        args.out,
        args.mode,
        keys=_csv(args.keys),
        order_by=_csv(args.order_by),
        partition_by=_csv(args.partition_by),
        dedup=not args.no_dedup,
        day=args.day,
        start=args.start,
        end=args.end,
        column=args.column,
        materialize=args.materialize,
        partition_column=args.partition_column,
    )
    result = {"table": out, "mode": args.mode}
    print(json.dumps(result))
    return result


if __name__ == "__main__":
    main(sys.argv[1:])
    sys.exit(0)
