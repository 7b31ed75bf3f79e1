"""Plan-shape guards over the whole catalog (regressions in scale behaviour)."""

import importlib
import os
import sys

import pytest

from conftest import SF_SMALL
from tidewater.plans.catalog import QUERIES

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "scripts"))
audit = importlib.import_module("plan_audit")
E = importlib.import_module("__spark_entry__")

WINDOWED = ["filter_daily", "filter_daily_upper", "filter_range", "document_daily", "sync_daily_upsert",
            "sync_range_ignore_record"]


@pytest.fixture(scope="module")
def summaries(spark):
    return {name: audit.summarise(audit.executed_plan(fn(spark, SF_SMALL))) for name, fn in QUERIES.items()}


def test_no_python_and_no_window_anywhere(summaries):
    assert {n for n, s in summaries.items() if s["python"]} == set()
    assert {n for n, s in summaries.items() if s["windows"]} == set()


@pytest.mark.parametrize("name", WINDOWED)
def test_change_window_reaches_the_scan(summaries, name):
    pushed = summaries[name]["pushed"]
    assert "GreaterThanOrEqual" in pushed and "LessThan" in pushed


def test_merge_shuffle_budget_without_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        budget = {"save_upsert": 3, "save_ignore_record": 2, "save_upsert_partial": 4, "sync_daily_upsert": 3}
        for name, most in budget.items():
            s = audit.summarise(audit.executed_plan(E.queries()[name](spark, SF_SMALL)))
            assert s["shuffles"] <= most, (name, s)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_known_unique_keys_skip_the_dedup_shuffle(spark):
    from conftest import rows
    from tidewater.operators.merge import SaveMode, merge_state
    from tidewater.plans import fixtures as fx

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        t, i = fx.orders_target(spark, SF_SMALL), fx.orders_changed(spark, SF_SMALL)
        fast = merge_state(t, i, SaveMode.UPSERT, keys=["o_orderkey"], dedup=False)
        assert audit.summarise(audit.executed_plan(fast))["shuffles"] <= 2
        assert rows(fast) == rows(merge_state(t, i, SaveMode.UPSERT, keys=["o_orderkey"]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_stored_key_scan_pushes_prefix(summaries):
    assert "StringStartsWith(url,http)" in summaries["key_scan_pages"]["pushed"]
