"""Run a merge whose incoming stage fails on every first task attempt; Spark
retries (local[4,3]) and the result must equal the failure-free one."""

import json
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from pyspark import TaskContext  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

from tidewater.functions.ids import with_entity_id  # noqa: E402
from tidewater.operators.merge import SaveMode, merge_state  # noqa: E402
from tidewater.plans import fixtures as fx  # noqa: E402


@F.udf(T.BooleanType())
def flaky(_):
    # Test-only fault injection: every task's first attempt fails.
    if TaskContext.get().attemptNumber() == 0:
        raise RuntimeError("injected task failure")
    return True


def main():
    sf_dir, ckpt = sys.argv[1], sys.argv[2]
    spark = (
        SparkSession.builder.master("local[4,3]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.checkpoint.dir", ckpt)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    target = fx.orders_target(spark, sf_dir)
    inc = fx.orders_changed(spark, sf_dir)
    clean = merge_state(target, inc, SaveMode.UPSERT, keys=["o_orderkey"])
    faulty = merge_state(target, inc.filter(flaky("o_orderkey")), SaveMode.UPSERT, keys=["o_orderkey"])
    a = sorted(tuple(r) for r in clean.collect())
    b = sorted(tuple(r) for r in faulty.collect())
    ids = with_entity_id(inc.filter(flaky("o_orderkey")), "goods", stable=True)
    first = {r.o_orderkey: r.id for r in ids.collect()}
    second = {r.o_orderkey: r.id for r in ids.collect()}
    # A snapshot write whose tasks fail once each: the commit protocol keeps
    # exactly one copy of every row.
    from tidewater.sinks.snapshot import save_snapshot

    base = f"{ckpt}/orders_v1"
    target.write.parquet(base)
    out = save_snapshot(inc.filter(flaky("o_orderkey")), base, f"{ckpt}/orders_v2", "upsert", keys=["o_orderkey"])
    written = sorted(tuple(r) for r in spark.read.parquet(out).collect())
    print(json.dumps({"rows": len(a), "equal": a == b, "ids_stable": first == second, "ids": len(first),
                      "snapshot_equal": written == a}))
    spark.stop()


if __name__ == "__main__":
    main()
