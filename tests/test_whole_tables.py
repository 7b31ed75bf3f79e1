"""The whole-table queries use every row of their table, and both branches get rows."""

import importlib

import pytest

from conftest import SF_SMALL
from tidewater.plans import fixtures as fx

Q = importlib.import_module("tidewater.plans.catalog").QUERIES


@pytest.mark.parametrize("name", ["sync_daily_upsert", "sync_daily_snapshot", "sync_range_ignore_record", "job_document_daily"])
def test_every_event(spark, name):
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    held = events.filter(~fx.is_new_event("ts")).count()
    assert 0 < held < events.count()
    assert Q[name](spark, SF_SMALL).count() == events.count()


def test_every_order_and_document(spark):
    count = lambda t: spark.read.parquet(f"{SF_SMALL}/{t}.parquet").count()
    assert Q["save_error_if_exists"](spark, SF_SMALL).count() == count("orders")
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id")
    got = Q["save_upsert_labels"](spark, SF_SMALL).filter("quality is not null")
    assert docs.join(got, "doc_id", "left_anti").count() == 0
