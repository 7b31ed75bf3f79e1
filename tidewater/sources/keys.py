"""Key-pattern scans over a key/value table.

A key/value store is modelled as a DataFrame with a string key column (plus any
value columns). ``key_scan`` keeps the rows whose key matches a glob pattern
with the usual key-store rules:

* ``*`` any run of characters (newlines included), ``?`` exactly one,
* ``[abc]``, ``[a-z]`` a class, ``[^a]`` a negated class,
* ``\\x`` the literal ``x``; the match is on the whole key, case-sensitive.

The pattern becomes one anchored Java regex (``rlike``, JVM-side), and its
literal prefix becomes a ``startswith`` predicate, which Parquet receives as a
pushed ``StringStartsWith`` filter when the key is a stored column.

``write_key_layout`` stores a key table in key order, cut into ranges, so that this
filter skips all row groups but those that can hold the prefix. ``partitions=n``
returns the matches in n ranges of the key, about equally many rows each.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class GlobError(ValueError):
    pass


def _lit_char(ch: str) -> str:
    # A backslash before a non-alphanumeric character is always literal in
    # Java regex; letters and digits need no escaping.
    return ch if ch.isalnum() or ch == "_" else "\\" + ch


def _class_char(ch: str) -> str:
    return "\\" + ch if ch in "\\[]^-&" else ch


def glob_to_regex(pattern: str) -> str:
    """Anchored Java regex equivalent to a key glob."""
    out: list[str] = []
    i, n = 0, len(pattern)
    while i < n:
        ch = pattern[i]
        if ch == "\\" and i + 1 < n:
            out.append(_lit_char(pattern[i + 1]))
            i += 2
        elif ch == "*":
            out.append(".*")
            i += 1
        elif ch == "?":
            out.append(".")
            i += 1
        elif ch == "[":
            j = i + 1
            negate = j < n and pattern[j] == "^"
            if negate:
                j += 1
            items: list[str] = []
            closed = False
            while j < n:
                c = pattern[j]
                if c == "]":
                    closed = True
                    break
                if c == "\\" and j + 1 < n:
                    items.append(_class_char(pattern[j + 1]))
                    j += 2
                    continue
                if j + 2 < n and pattern[j + 1] == "-" and pattern[j + 2] != "]":
                    lo, hi = c, pattern[j + 2]
                    if lo > hi:
                        lo, hi = hi, lo
                    items.append(f"{_class_char(lo)}-{_class_char(hi)}")
                    j += 3
                    continue
                items.append(_class_char(c))
                j += 1
            if not closed:
                raise GlobError(f"unterminated character class in {pattern!r}")
            if not items:
                # "[]" matches nothing, "[^]" any single character.
                out.append("." if negate else "(?!)")
            else:
                out.append("[" + ("^" if negate else "") + "".join(items) + "]")
            i = j + 1
        else:
            out.append(_lit_char(ch))
            i += 1
    return "\\A(?s:" + "".join(out) + ")\\z"


def literal_prefix(pattern: str) -> str:
    """The characters every matching key starts with."""
    out: list[str] = []
    i = 0
    while i < len(pattern):
        ch = pattern[i]
        if ch == "\\" and i + 1 < len(pattern):
            out.append(pattern[i + 1])
            i += 2
        elif ch in "*?[":
            break
        else:
            out.append(ch)
            i += 1
    return "".join(out)


def key_matches(key: str | Column, pattern: str) -> Column:
    c = F.col(key) if isinstance(key, str) else key
    cond = c.rlike(glob_to_regex(pattern))
    prefix = literal_prefix(pattern)
    if prefix:
        cond = c.startswith(prefix) & cond
    return cond


def _by_key(df: DataFrame, key: str, n: int) -> DataFrame:
    """``df`` in ``n`` ranges of the key. Spark samples the boundaries, which steer
    the layout alone; a hash of the row after the key lets a key that holds a large
    share of the rows fill several ranges. Maps have no hash and are left out of it."""
    if n < 1:
        raise ValueError("the number of key ranges must be >= 1")
    hashed = ["`" + f.name.replace("`", "``") + "`" for f in df.schema if "map<" not in f.dataType.simpleString()]
    return df.repartitionByRange(n, F.col(key), F.xxhash64(*hashed))


def write_key_layout(df: DataFrame, path: str, n: int, key: str = "key", mode: str = "errorifexists") -> str:
    """Write a key table as ``n`` ranges in key order. A scan for a prefix then reads
    the row groups whose smallest and largest key enclose it, and no others."""
    _by_key(df, key, n).sortWithinPartitions(key).write.mode(mode).parquet(path)
    return path


def key_scan(
    df: DataFrame, pattern: str, key: str = "key", keys_only: bool = False, partitions: int | None = None
) -> DataFrame:
    """Rows of a key/value frame whose ``key`` matches ``pattern``; with
    ``partitions``, in so many ranges of the key (one shuffle of the matches)."""
    out = df.filter(key_matches(key, pattern))
    out = out.select(key) if keys_only else out
    return out if partitions is None else _by_key(out, key, partitions)


def keyed_view(df: DataFrame, prefix: str, key_cols: Sequence[str], key: str = "key", sep: str = ":") -> DataFrame:
    """Give a table store-style keys: ``prefix`` + key columns joined by ``sep``."""
    parts = [F.col(c).cast("string") for c in key_cols]
    joined = parts[0] if len(parts) == 1 else F.concat_ws(sep, *parts)
    return df.select(F.concat(F.lit(prefix), joined).alias(key), *df.columns)
