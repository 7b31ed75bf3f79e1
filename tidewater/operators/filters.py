"""Change-window filters: keep one day, or one time range, of rows by an
"updated at" column.

The semantics are those of comparing ``date_format(col, fmt)`` strings
(whole-second precision, both range ends inclusive, a missing day keeps every
row including NULL timestamps) but the predicates are written as plain ranges
on the raw column, so Catalyst pushes them to the scan (``PushedFilters``
shows ``GreaterThanOrEqual``/``LessThan``) and Parquet row groups outside the
window are never decoded.

Column types:

* ``timestamp_ntz`` - the wall-clock value *is* the stored value: exact range.
* ``timestamp`` (with local time zone) - wall clock in the session zone. A
  range on the raw instant is pushed, widened by a margin larger than any
  zone-offset jump, and the exact test runs as a residual on
  ``from_utc_timestamp(col, session_zone)``. Repeated DST hours therefore
  behave like the string form (both instants kept).
* ``date`` - compared as a day.
* ``string`` - parsed with ``try_to_timestamp`` (bad text gives NULL, which a
  bounded filter drops), then as ``timestamp``.
"""

from __future__ import annotations

import datetime as _dt
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Accepted spellings of a day and of an instant bound. The first
# instant form (no separator) is the one the original filter compares with.
DAY_PATTERN = r"(\d{4})-(\d{2})-(\d{2})"
INSTANT_PATTERN = r"(\d{4})-(\d{2})-(\d{2})[ T]?(\d{2}):(\d{2}):(\d{2})"

# More than any recorded change of a zone's UTC offset (a whole skipped day).
_LTZ_MARGIN = _dt.timedelta(hours=26)
_ONE_DAY = _dt.timedelta(days=1)
_ONE_SECOND = _dt.timedelta(seconds=1)


# The change-timestamp column in lower- and upper-case schemas.
CHANGE_COLUMN = {"lower": "rec_upd_ts", "upper": "REC_UPD_TS"}


def _column(column: str | None, case: str) -> str:
    if column is not None:
        return column
    try:
        return CHANGE_COLUMN[case]
    except KeyError as exc:
        raise ValueError("case must be 'lower' or 'upper'") from exc


class BoundError(ValueError):
    """A day or time bound that does not parse strictly."""


def parse_day(value: str | _dt.date) -> _dt.date:
    """Strict ``yyyy-MM-dd``; ``2018-6-1`` is refused rather than matching nothing."""
    if isinstance(value, _dt.datetime):
        raise BoundError(f"expected a day, got a date-time: {value!r}")
    if isinstance(value, _dt.date):
        return value
    m = re.fullmatch(DAY_PATTERN, str(value).strip())
    if not m:
        raise BoundError(f"day must be yyyy-MM-dd, got {value!r}")
    try:
        return _dt.date(int(m[1]), int(m[2]), int(m[3]))
    except ValueError as exc:
        raise BoundError(f"not a calendar day: {value!r}") from exc


def parse_instant(value: str | _dt.datetime) -> _dt.datetime:
    """Strict ``yyyy-MM-ddHH:mm:ss`` (or with a space or ``T``); whole seconds."""
    if isinstance(value, _dt.datetime):
        if value.tzinfo is not None:
            raise BoundError("bounds are wall-clock values; pass a naive datetime")
        return value
    m = re.fullmatch(INSTANT_PATTERN, str(value).strip())
    if not m:
        raise BoundError(f"time bound must be yyyy-MM-ddHH:mm:ss, got {value!r}")
    try:
        return _dt.datetime(*(int(g) for g in m.groups()))
    except ValueError as exc:
        raise BoundError(f"not a valid time: {value!r}") from exc


def _ntz(value: _dt.datetime) -> Column:
    return F.lit(value.isoformat(sep=" ")).cast(T.TimestampNTZType())


def _utc(value: _dt.datetime) -> Column:
    """A ``timestamp`` literal for the instant ``value`` read as UTC."""
    return F.lit(value.replace(tzinfo=_dt.timezone.utc))


def _wall_clock_range(df: DataFrame, column: str, lo: _dt.datetime, hi: _dt.datetime) -> DataFrame:
    """Keep rows whose wall-clock value of ``column`` lies in ``[lo, hi)``."""
    field = df.schema[column] if column in df.columns else _field_ci(df, column)
    dtype = field.dataType
    c = F.col(column)
    if isinstance(dtype, T.TimestampNTZType):
        return df.filter((c >= _ntz(lo)) & (c < _ntz(hi)))
    if isinstance(dtype, T.DateType):
        # A date's wall clock is its midnight.
        return df.filter((c.cast(T.TimestampNTZType()) >= _ntz(lo)) & (c.cast(T.TimestampNTZType()) < _ntz(hi)))
    if isinstance(dtype, (T.TimestampType, T.StringType)):
        inst = c if isinstance(dtype, T.TimestampType) else F.try_to_timestamp(c)
        # Wall clock as "the instant whose UTC rendering is the local time".
        # A cast to timestamp_ntz would read the same, but Catalyst unwraps
        # cast(ts as timestamp_ntz) < literal into ts < literal', which is
        # wrong inside a repeated DST hour; from_utc_timestamp is kept as is.
        tz = df.sparkSession.conf.get("spark.sql.session.timeZone")
        wall = F.from_utc_timestamp(inst, tz)
        cond = (wall >= _utc(lo)) & (wall < _utc(hi))
        if isinstance(dtype, T.TimestampType):
            # Pushable range on the stored instant, widened past any offset jump.
            cond = (c >= _utc(lo - _LTZ_MARGIN)) & (c < _utc(hi + _LTZ_MARGIN)) & cond
        return df.filter(cond)
    raise TypeError(f"column {column!r} has type {dtype.simpleString()}; expected a timestamp, date or string")


def _field_ci(df: DataFrame, column: str) -> T.StructField:
    for f in df.schema.fields:
        if f.name.lower() == column.lower():
            return f
    raise KeyError(f"no column {column!r} in {df.columns}")


def _day_partitions(df: DataFrame, partition_column: str, lo: _dt.date, hi: _dt.date) -> DataFrame:
    """Prune a day-partitioned table to the partitions ``lo..hi`` (inclusive).

    The partition column holds the day of the change column (a ``date``, a
    ``yyyy-MM-dd`` string or a ``yyyyMMdd`` integer); the predicate lands in
    ``PartitionFilters`` and whole directories are skipped before any file is
    opened.
    """
    field = df.schema[partition_column] if partition_column in df.columns else _field_ci(df, partition_column)
    c = F.col(partition_column)
    if isinstance(field.dataType, T.DateType):
        return df.filter((c >= F.lit(lo)) & (c <= F.lit(hi)))
    if isinstance(field.dataType, T.StringType):
        return df.filter((c >= F.lit(lo.isoformat())) & (c <= F.lit(hi.isoformat())))
    if isinstance(field.dataType, (T.IntegerType, T.LongType)):
        return df.filter((c >= F.lit(int(lo.strftime("%Y%m%d")))) & (c <= F.lit(int(hi.strftime("%Y%m%d")))))
    raise TypeError(
        f"partition column {partition_column!r} must be a date, a yyyy-MM-dd string or a yyyyMMdd integer"
    )


def filter_daily(
    df: DataFrame,
    day: str | _dt.date | None = None,
    column: str | None = None,
    case: str = "lower",
    partition_column: str | None = None,
) -> DataFrame:
    """Rows whose ``column`` falls on ``day`` (session-zone wall clock).

    ``day=None`` returns ``df`` unchanged, NULL timestamps included. With a day,
    NULL timestamps drop out. The column defaults to ``rec_upd_ts``
    (``case="upper"``: ``REC_UPD_TS``; name resolution is case-insensitive by
    default anyway). ``partition_column`` names a day partition column of the
    table, so only that day's directory is read.
    """
    if day is None:
        return df
    d = parse_day(day)
    if partition_column:
        df = _day_partitions(df, partition_column, d, d)
    lo = _dt.datetime(d.year, d.month, d.day)
    return _wall_clock_range(df, _column(column, case), lo, lo + _ONE_DAY)


def filter_range(
    df: DataFrame,
    start: str | _dt.datetime,
    end: str | _dt.datetime,
    column: str | None = None,
    case: str = "lower",
    partition_column: str | None = None,
) -> DataFrame:
    """Rows with ``start <= column <= end`` at whole-second precision.

    Both ends are inclusive on the second: an end of ``10:00:00`` keeps
    ``10:00:00.999`` and drops ``10:00:01``. ``partition_column`` prunes a
    day-partitioned table to the days the range touches.
    """
    lo = parse_instant(start)
    hi = parse_instant(end)
    if lo.microsecond or hi.microsecond:
        raise BoundError("range bounds are whole seconds")
    if partition_column:
        df = _day_partitions(df, partition_column, lo.date(), hi.date())
    return _wall_clock_range(df, _column(column, case), lo, hi + _ONE_SECOND)


def filter_document_daily(df: DataFrame, day: str | _dt.date | None = None, column: str = "updateAt") -> DataFrame:
    """The daily filter on a document collection's ``updateAt`` field."""
    return filter_daily(df, day, column=column)


# Reference-style string predicates, kept for comparison and benchmarking.
# They give the same rows but cannot be pushed to the scan.
def filter_daily_by_format(df: DataFrame, day: str, column: str = "rec_upd_ts") -> DataFrame:
    parse_day(day)
    return df.filter(F.date_format(F.col(column), "yyyy-MM-dd") == F.lit(str(day)))


def filter_range_by_format(df: DataFrame, start: str, end: str, column: str = "rec_upd_ts") -> DataFrame:
    s = F.date_format(F.col(column), "yyyy-MM-ddHH:mm:ss")
    return df.filter((s >= F.lit(start)) & (s <= F.lit(end)))
