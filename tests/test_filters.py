import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, plan_text, rows
from tidewater.operators.filters import (
    BoundError,
    filter_daily,
    filter_daily_by_format,
    filter_range,
    filter_range_by_format,
    parse_day,
    parse_instant,
)

D = dt.datetime


@pytest.fixture()
def change_log(spark):
    data = [
        (1, D(2018, 6, 21, 0, 0, 0)),
        (2, D(2018, 6, 21, 10, 0, 0, 999000)),
        (3, D(2018, 6, 21, 10, 0, 1)),
        (4, D(2018, 6, 21, 23, 59, 59)),
        (5, None),
        (6, D(2018, 6, 22, 0, 0, 0)),
        (7, D(2018, 6, 20, 23, 59, 59, 999999)),
    ]
    return spark.createDataFrame(data, "id int, rec_upd_ts timestamp_ntz")


def ids(df):
    return sorted(r.id for r in df.select("id").collect())


def test_daily_keeps_whole_day(change_log):
    assert ids(filter_daily(change_log, "2018-06-21")) == [1, 2, 3, 4]


def test_daily_none_keeps_everything_including_nulls(change_log):
    assert ids(filter_daily(change_log, None)) == [1, 2, 3, 4, 5, 6, 7]


def test_range_end_inclusive_at_second(change_log):
    out = filter_range(change_log, "2018-06-2100:00:00", "2018-06-2110:00:00")
    assert ids(out) == [1, 2]


def test_range_accepts_space_spelling(change_log):
    out = filter_range(change_log, "2018-06-21 10:00:01", "2018-06-21 23:59:59")
    assert ids(out) == [3, 4]


def test_range_matches_string_form(change_log):
    a = filter_range(change_log, "2018-06-2010:00:00", "2018-06-2123:59:59")
    b = filter_range_by_format(change_log, "2018-06-2010:00:00", "2018-06-2123:59:59")
    assert ids(a) == ids(b)


def test_upper_case_column(change_log):
    up = change_log.withColumnRenamed("rec_upd_ts", "REC_UPD_TS")
    assert ids(filter_daily(up, "2018-06-21", column="REC_UPD_TS")) == [1, 2, 3, 4]


@pytest.mark.parametrize("bad", ["2018-6-1", "2018-06-32", "20180621", "2018-06-21 10:00:00", ""])
def test_strict_day(bad):
    with pytest.raises(BoundError):
        parse_day(bad)


@pytest.mark.parametrize("bad", ["2018-06-21", "2018-06-2110:00", "2018-06-2125:00:00", "x"])
def test_strict_instant(bad):
    with pytest.raises(BoundError):
        parse_instant(bad)


def test_pushdown_in_plan(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    plan = plan_text(filter_daily(ev, "2024-01-15", column="ts"))
    assert "GreaterThanOrEqual(ts" in plan and "LessThan(ts" in plan
    plan_fmt = plan_text(filter_daily_by_format(ev, "2024-01-15", column="ts"))
    assert "GreaterThanOrEqual(ts" not in plan_fmt


def test_range_pushdown_in_plan(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    plan = plan_text(filter_range(ev, "2024-01-1006:30:00", "2024-01-1218:45:59", column="ts"))
    assert "GreaterThanOrEqual(ts" in plan and "LessThan(ts" in plan


@pytest.mark.parametrize("day", ["2024-01-01", "2024-01-15", "2024-01-30", "2024-02-01"])
def test_daily_equals_format_form_on_events(spark, day):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    a = filter_daily(ev, day, column="ts")
    b = filter_daily_by_format(ev, day, column="ts")
    assert rows(a) == rows(b)


def test_ltz_column_dst_repeated_hour(spark):
    # 2018-11-04 01:00-02:00 happens twice in America/New_York.
    prev = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame(
            [(1, "2018-11-04T05:10:00Z"), (2, "2018-11-04T06:10:00Z"), (3, "2018-11-04T06:30:00Z"),
             (4, "2018-11-05T04:59:59Z"), (5, "2018-11-05T05:00:00Z"), (6, "2018-11-04T03:59:59Z")],
            "id int, s string",
        ).select("id", F.to_timestamp("s").alias("rec_upd_ts"))
        for start, end in [("2018-11-0400:00:00", "2018-11-0401:20:00"), ("2018-11-0401:00:00", "2018-11-0401:59:59")]:
            assert ids(filter_range(df, start, end)) == ids(filter_range_by_format(df, start, end))
        assert ids(filter_daily(df, "2018-11-04")) == ids(filter_daily_by_format(df, "2018-11-04"))
        assert ids(filter_daily(df, "2018-11-04")) == [1, 2, 3, 4]
    finally:
        spark.conf.set("spark.sql.session.timeZone", prev)


def test_string_column_bad_text_dropped(spark):
    df = spark.createDataFrame([(1, "2018-06-21 10:00:00"), (2, "garbage"), (3, None), (4, "2018-06-22")],
                               "id int, rec_upd_ts string")
    assert ids(filter_daily(df, "2018-06-21")) == [1]
    assert ids(filter_daily(df, "2018-06-22")) == [4]


def test_date_column(spark):
    df = spark.createDataFrame([(1, dt.date(2018, 6, 21)), (2, dt.date(2018, 6, 22))], "id int, rec_upd_ts date")
    assert ids(filter_daily(df, "2018-06-21")) == [1]
    assert ids(filter_range(df, "2018-06-2100:00:00", "2018-06-2100:00:00")) == [1]


from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

_instants = st.datetimes(min_value=D(2018, 6, 20), max_value=D(2018, 6, 23))


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(ts=st.lists(st.one_of(st.none(), _instants), min_size=1, max_size=20),
       a=_instants, b=_instants, tz=st.sampled_from(["UTC", "America/New_York", "Asia/Kolkata"]))
def test_range_equals_string_form_property(spark, ts, a, b, tz):
    lo, hi = sorted([a.replace(microsecond=0), b.replace(microsecond=0)])
    start, end = lo.strftime("%Y-%m-%d%H:%M:%S"), hi.strftime("%Y-%m-%d%H:%M:%S")
    prev = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", tz)
    try:
        for dtype in ("timestamp_ntz", "timestamp"):
            df = spark.createDataFrame([(i, t) for i, t in enumerate(ts)], f"id int, rec_upd_ts {dtype}")
            assert ids(filter_range(df, start, end)) == ids(filter_range_by_format(df, start, end))
            assert ids(filter_daily(df, lo.strftime("%Y-%m-%d"))) == ids(filter_daily_by_format(df, lo.strftime("%Y-%m-%d")))
    finally:
        spark.conf.set("spark.sql.session.timeZone", prev)


def test_case_switch(change_log):
    up = change_log.withColumnRenamed("rec_upd_ts", "REC_UPD_TS")
    assert ids(filter_daily(up, "2018-06-21", case="upper")) == [1, 2, 3, 4]
    assert ids(filter_range(change_log, "2018-06-2100:00:00", "2018-06-2110:00:00", case="lower")) == [1, 2]
    with pytest.raises(ValueError):
        filter_daily(change_log, "2018-06-21", case="title")


def test_partition_pruning(spark, tmp_path):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    path = str(tmp_path / "by_day")
    ev.withColumn("dt", F.date_format("ts", "yyyy-MM-dd")).write.partitionBy("dt").parquet(path)
    parted = spark.read.parquet(path)
    a = filter_daily(parted, "2024-01-15", column="ts", partition_column="dt")
    plan = plan_text(a)
    assert "PartitionFilters: [isnotnull(dt" in plan and "2024-01-15" in plan
    assert rows(a.drop("dt")) == rows(filter_daily(ev, "2024-01-15", column="ts"))
    r = filter_range(parted, "2024-01-1423:00:00", "2024-01-1601:00:00", column="ts", partition_column="dt")
    assert rows(r.drop("dt")) == rows(filter_range(ev, "2024-01-1423:00:00", "2024-01-1601:00:00", column="ts"))
    dated = spark.read.parquet(path).withColumn("d", F.col("dt").cast("date"))
    assert filter_daily(dated, "2024-01-15", column="ts", partition_column="d").count() == a.count()
    ints = str(tmp_path / "by_int_day")
    ev.withColumn("di", F.date_format("ts", "yyyyMMdd").cast("int")).write.partitionBy("di").parquet(ints)
    by_int = filter_daily(spark.read.parquet(ints), "2024-01-15", column="ts", partition_column="di")
    assert "PartitionFilters: [isnotnull(di" in plan_text(by_int) and by_int.count() == a.count()


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(ts=st.lists(st.one_of(st.none(), _instants), min_size=1, max_size=15), a=_instants, b=_instants)
def test_string_and_date_columns_equal_string_form(spark, ts, a, b):
    lo, hi = sorted([a.replace(microsecond=0), b.replace(microsecond=0)])
    start, end = lo.strftime("%Y-%m-%d%H:%M:%S"), hi.strftime("%Y-%m-%d%H:%M:%S")
    text = [(i, None if t is None else t.strftime("%Y-%m-%d %H:%M:%S")) for i, t in enumerate(ts)]
    sdf = spark.createDataFrame(text, "id int, rec_upd_ts string")
    assert ids(filter_range(sdf, start, end)) == ids(filter_range_by_format(sdf, start, end))
    day = lo.strftime("%Y-%m-%d")
    assert ids(filter_daily(sdf, day)) == ids(filter_daily_by_format(sdf, day))
    ddf = spark.createDataFrame([(i, None if t is None else t.date()) for i, t in enumerate(ts)], "id int, rec_upd_ts date")
    assert ids(filter_daily(ddf, day)) == ids(filter_daily_by_format(ddf, day))


def test_ltz_range_is_pushed(spark, tmp_path):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    path = str(tmp_path / "ltz")
    ev.write.parquet(path)
    df = spark.read.parquet(path)
    out = filter_daily(df, "2024-01-15", column="ts")
    plan = plan_text(out)
    assert "GreaterThanOrEqual(ts" in plan and "LessThan(ts" in plan
    assert ids_of(out) == ids_of(filter_daily_by_format(df, "2024-01-15", column="ts"))


def ids_of(df):
    return sorted(r.event_id for r in df.select("event_id").collect())
