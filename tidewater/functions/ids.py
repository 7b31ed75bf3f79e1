"""Prefixed entity ids: a four-letter entity prefix followed by 32 hex digits.

``entity_id("shop")`` is a column expression (``uuid()`` without dashes), so
ids are minted inside the executors' generated code, one per row, with no
driver round trip. ``uuid()`` is non-deterministic: a recomputed partition gets
new ids. Use ``with_entity_id(..., stable=True)`` to checkpoint the frame in
the shared checkpoint folder, or ``deterministic_from=[cols]`` to derive the
id from a hash of natural-key columns (the same row always gets the same id,
also across retries and reruns).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Entity prefixes of the minted ids.
ENTITY_PREFIXES: dict[str, str] = {
    "shop": "SHOP",
    "coupon": "COPN",
    "goods": "GOOD",
    "comment": "CMMT",
    "brand": "BRND",
    "area": "AREA",
}

ID_REGEX_TEMPLATE = "^{prefix}[0-9a-f]{{32}}$"


def prefix_for(entity: str) -> str:
    try:
        return ENTITY_PREFIXES[entity.lower()]
    except KeyError as exc:
        raise ValueError(f"unknown entity {entity!r}; one of {sorted(ENTITY_PREFIXES)}") from exc


def entity_id(entity: str, deterministic_from: Sequence[str | Column] | None = None) -> Column:
    prefix = F.lit(prefix_for(entity))
    if deterministic_from:
        cols = [F.col(c) if isinstance(c, str) else c for c in deterministic_from]
        # to_json of a struct names every field, so (NULL, 'a') and ('a', NULL)
        # hash differently, unlike a plain concatenation.
        digest = F.sha2(F.to_json(F.struct(*cols)), 256)
        return F.concat(prefix, F.substring(digest, 1, 32))
    return F.concat(prefix, F.regexp_replace(F.expr("uuid()"), "-", ""))


def with_entity_id(
    df: DataFrame,
    entity: str,
    col: str = "id",
    deterministic_from: Sequence[str | Column] | None = None,
    stable: bool = False,
) -> DataFrame:
    out = df.withColumn(col, entity_id(entity, deterministic_from))
    if stable and not deterministic_from:
        from ..session import checkpoint_dir

        checkpoint_dir(out.sparkSession)
        out = out.checkpoint(eager=True)
    return out


def id_pattern(entity: str) -> str:
    return ID_REGEX_TEMPLATE.format(prefix=prefix_for(entity))
