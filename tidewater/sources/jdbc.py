"""Parallel table reads over JDBC.

Without a partition column a JDBC read is one task, so asking for more partitions
without one is an error. ``read_jdbc`` splits on any ordered column at its
quantiles: the database numbers its values in ``num_partitions`` equal parts and
returns the last value of each (one row a partition), and each part becomes one
predicate, with rows whose column is NULL in a part of their own. Parts are equal
in rows however the values are spread. ``split="width"`` keeps Spark's split of the
value range (one ``MIN``/``MAX`` query, numeric and temporal columns only).
Filters and column selections on the result are pushed into those queries by
Spark's JDBC source.
"""

from __future__ import annotations

import datetime as _dt
import decimal
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from .endpoint import DEFAULT_READ_PARTITIONS, Endpoint


def _bound(v) -> str:
    if isinstance(v, _dt.datetime):
        return v.isoformat(sep=" ")
    if isinstance(v, _dt.date):
        return v.isoformat()
    return str(v)


def column_bounds(spark: SparkSession, endpoint: Endpoint, table: str, column: str):
    """``(min, max)`` of ``column``, computed by the database."""
    row = (
        spark.read.format("jdbc")
        .options(**endpoint.options())
        .option("query", f"SELECT MIN({column}) AS lo, MAX({column}) AS hi FROM {table}")
        .load()
        .first()
    )
    return (row[0], row[1]) if row is not None else (None, None)


def jdbc_read_options(
    endpoint: Endpoint,
    table: str,
    num_partitions: int = DEFAULT_READ_PARTITIONS,
    partition_column: str | None = None,
    lower_bound=None,
    upper_bound=None,
    fetchsize: int | None = None,
) -> dict[str, str]:
    """Reader options; a split only when a column and both bounds are known."""
    opts = dict(endpoint.options())
    opts["dbtable"] = table
    if fetchsize:
        opts["fetchsize"] = str(fetchsize)
    if partition_column and lower_bound is not None and upper_bound is not None:
        opts.update(
            partitionColumn=partition_column,
            lowerBound=_bound(lower_bound),
            upperBound=_bound(upper_bound),
            numPartitions=str(num_partitions),
        )
    return opts


def quantile_query(table: str, column: str, n: int) -> str:
    """The last value of each of ``n`` parts with equally many rows, NULLs left out.
    Plain SQL that PostgreSQL, MySQL 8, DB2 and Spark run alike."""
    return (
        f"SELECT MAX(v) AS hi FROM (SELECT {column} AS v, NTILE({int(n)}) OVER (ORDER BY {column}) AS part "
        f"FROM {table} split_rows WHERE {column} IS NOT NULL) split_parts GROUP BY part ORDER BY hi"
    )


def sql_literal(v) -> str:
    """A boundary as an SQL literal."""
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    if isinstance(v, (int, float, decimal.Decimal)):
        return str(v)
    if isinstance(v, _dt.datetime):
        return f"TIMESTAMP '{v.isoformat(sep=' ')}'"
    if isinstance(v, _dt.date):
        return f"DATE '{v.isoformat()}'"
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    raise TypeError(f"cannot split on values of type {type(v).__name__}")


def quantile_predicates(column: str, last_values: Sequence) -> list[str]:
    """One WHERE clause for each part, given the parts' last values. Every row is in
    exactly one: the first part is open below and the last one open above, a value
    that fills several parts makes one, and rows with NULL are a part of their own."""
    cuts = []
    for v in last_values:
        if v is not None and (not cuts or v != cuts[-1]):
            cuts.append(v)
    cuts = [sql_literal(v) for v in cuts[:-1]]
    parts = [f"{column} <= {b}" if a is None else f"{column} > {a}" if b is None else f"{column} > {a} AND {column} <= {b}"
             for a, b in zip([None, *cuts], [*cuts, None])]
    return [p if cuts else f"{column} IS NOT NULL" for p in parts] + [f"{column} IS NULL"]


def quantiles(spark: SparkSession, endpoint: Endpoint, table: str, column: str, n: int) -> list:
    """Last values of ``n`` equal parts, computed by the database; ``n`` rows return."""
    rows = spark.read.format("jdbc").options(**endpoint.options()).option("query", quantile_query(table, column, n)).load().collect()
    return sorted(r[0] for r in rows if r[0] is not None)


def read_jdbc(
    spark: SparkSession,
    endpoint: Endpoint,
    table: str,
    num_partitions: int | None = None,
    partition_column: str | None = None,
    lower_bound=None,
    upper_bound=None,
    predicates: Sequence[str] | None = None,
    fetchsize: int | None = None,
    split: str = "rows",
) -> DataFrame:
    """Read ``table`` (a name, ``schema.name``, or a parenthesised subquery).

    ``split="rows"`` cuts ``partition_column`` at its quantiles, ``"width"`` into
    ranges of equal width, which is also what given bounds mean. ``predicates`` (one
    WHERE clause per partition) are used as they are. Without a split the read is one
    task, and ``num_partitions`` over 1 is refused.
    """
    if split not in ("rows", "width"):
        raise ValueError("split must be 'rows' or 'width'")
    if num_partitions is not None and num_partitions > 1 and not partition_column and not predicates:
        raise ValueError("num_partitions > 1 needs partition_column or predicates: there is nothing to split on")
    num_partitions = num_partitions or DEFAULT_READ_PARTITIONS
    if partition_column and not predicates and split == "rows" and lower_bound is None and upper_bound is None:
        predicates = quantile_predicates(partition_column, quantiles(spark, endpoint, table, partition_column, num_partitions))
    if predicates:
        props = endpoint.connection_properties()
        if fetchsize:
            props["fetchsize"] = str(fetchsize)
        return spark.read.jdbc(endpoint.resolved_url, table, predicates=list(predicates), properties=props)
    if partition_column and (lower_bound is None or upper_bound is None):
        lo, hi = column_bounds(spark, endpoint, table, partition_column)
        lower_bound = lo if lower_bound is None else lower_bound
        upper_bound = hi if upper_bound is None else upper_bound
    opts = jdbc_read_options(
        endpoint, table, num_partitions, partition_column, lower_bound, upper_bound, fetchsize
    )
    return spark.read.format("jdbc").options(**opts).load()


def read_postgres(spark: SparkSession, endpoint: Endpoint, table: str, **kw) -> DataFrame:
    return read_jdbc(spark, endpoint.require("postgresql"), table, **kw)


def read_mysql(spark: SparkSession, endpoint: Endpoint, table: str, **kw) -> DataFrame:
    return read_jdbc(spark, endpoint.require("mysql"), table, **kw)


def read_db2(spark: SparkSession, endpoint: Endpoint, table: str, **kw) -> DataFrame:
    return read_jdbc(spark, endpoint.require("db2"), table, **kw)
