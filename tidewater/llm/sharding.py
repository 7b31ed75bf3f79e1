"""Sharding with a K-d tree over distributed weighted medians.

The tree starts with all rows and splits each node that must hold more than one
shard: along the dimension with the widest spread (relative to the spread over
all rows), at the point where the rows below it weigh as much as the shards
below it should. Leaves are the shards. Medians come from histograms that Spark
reduces: each round cuts the interval that holds the split into ``bins`` parts
and keeps the part in which the weight is reached, down to a single point, so
what comes to the driver is at most ``bins`` sums a node, whatever the input.

Dimensions are taken from the text alone (bytes, bytes beyond one a character,
lines), and a point is followed by the text's CRC-32, so equal texts lie on one
point and share a shard. Only a point heavier than ``slack`` of a shard is cut
through, by a hash of doc_id: else one group of copies would unbalance shards.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpointed, quoted

DIMENSIONS = ("size", "wide", "lines")
WORD = 1 << 32


def measured(docs: DataFrame, key: str, text: str) -> DataFrame:
    t = F.coalesce(quoted(text), F.lit(""))
    return docs.select(
        quoted(key).cast("long").alias("doc_id"),
        (F.octet_length(t) + 1).cast("long").alias("size"),
        (F.octet_length(t) - F.char_length(t)).cast("long").alias("wide"),
        (F.char_length(t) - F.char_length(F.translate(t, "\n", ""))).cast("long").alias("lines"),
        F.crc32(t.cast("binary")).alias("text_crc32"),
    )


def _case(nodes: dict, value) -> F.Column:
    out = F.lit(None)
    for node, x in nodes.items():
        out = F.when(F.col("node") == node, value(x)).otherwise(out)
    return out


def _descend(rows: DataFrame, point: F.Column, spans: dict, wanted: dict, bins: int) -> dict:
    """For each node, the last point that still belongs below the split, the
    weight below and at that point. spans: node -> (low, high) of its points."""
    below = dict.fromkeys(spans, 0)
    at: dict = {}
    open_ = dict(spans)
    while open_:
        steps = {n: -(-(hi - lo + 1) // bins) for n, (lo, hi) in open_.items()}
        lo = _case({n: s[0] for n, s in open_.items()}, lambda x: F.lit(x).cast("long"))
        hi = _case({n: s[1] for n, s in open_.items()}, lambda x: F.lit(x).cast("long"))
        step = _case(steps, lambda x: F.lit(x).cast("long"))
        inside = rows.where(F.col("node").isin(list(open_))).withColumn("p", point).where((F.col("p") >= lo) & (F.col("p") <= hi))
        bin_ = F.expr("(p - lo) div step")
        sums = (
            inside.withColumn("lo", lo).withColumn("step", step)
            .groupBy("node", bin_.alias("bin")).agg(F.sum("size").alias("w")).orderBy("node", "bin").collect()
        )
        by_node: dict = {n: [] for n in open_}
        for r in sums:
            by_node[r["node"]].append((r["bin"], r["w"]))
        for n, parts in by_node.items():
            low, high = open_.pop(n)
            for i, (b, w) in enumerate(parts):
                if below[n] + w >= wanted[n] or i == len(parts) - 1:
                    first = low + b * steps[n]
                    if steps[n] == 1:
                        at[n] = (first, below[n], w)
                    else:
                        open_[n] = (first, min(high, first + steps[n] - 1))
                    break
                below[n] += w
    return at


def kd_shards(docs: DataFrame, shards: int = 8, key: str = "doc_id", text: str = "text", bins: int = 4096, slack: float = 0.02) -> DataFrame:
    """Deal all rows into ``shards`` of nearly equal bytes.

    Returns one row per input row: doc_id, size (UTF-8 bytes of the text plus 1),
    wide, lines, text_crc32, shard (0 to shards-1). The target is the total over
    ``shards``; a node's shards are halved at each split.

    Null text weighs 1, as empty text does, and both share a shard. Null doc_id
    is a value like another. Repeated rows are equal points. An empty table gives
    no rows; fewer distinct points than shards leave shards empty. Extra columns
    are ignored. A single text heavier than a shard cannot be cut."""
    rows = checkpointed(measured(docs, key, text).withColumn("node", F.lit(0)).withColumn("shard", F.lit(0)))
    stats = lambda df: df.agg(F.sum("size").alias("w"), *[f(c).alias(f"{n}_{c}") for c in DIMENSIONS for n, f in (("lo", F.min), ("hi", F.max))])
    whole = stats(rows).first()
    if whole["w"] is None:
        return rows.drop("node")
    spread = {c: max(1, whole[f"hi_{c}"] - whole[f"lo_{c}"]) for c in DIMENSIONS}
    tolerance = slack * whole["w"] / shards
    nodes = {0: (0, shards)}  # node -> first shard, number of shards
    while any(n > 1 for _, n in nodes.values()):
        found = {r["node"]: r for r in stats(rows.where(F.col("node").isin([i for i, (_, n) in nodes.items() if n > 1])).groupBy("node")).collect()}
        axis = {i: max(DIMENSIONS, key=lambda c: (r[f"hi_{c}"] - r[f"lo_{c}"]) / spread[c]) for i, r in found.items()}
        wanted = {i: r["w"] * (nodes[i][1] // 2) / nodes[i][1] for i, r in found.items()}
        point = _case(axis, lambda c: F.col(c) * WORD + F.col("text_crc32"))
        spans = {i: (r[f"lo_{axis[i]}"] * WORD, r[f"hi_{axis[i]}"] * WORD + WORD - 1) for i, r in found.items()}
        at = _descend(rows, point, spans, wanted, bins)
        # a point lies below the split if that is the nearer side, or is cut through
        cut = {i: p for i, (p, low, w) in at.items() if min(wanted[i] - low, low + w - wanted[i]) > tolerance}
        limit = {i: p if low + w - wanted[i] <= wanted[i] - low else p - 1 for i, (p, low, w) in at.items()}
        left = point <= _case(limit, lambda x: F.lit(x).cast("long"))
        if cut:
            spot = _case(cut, lambda x: F.lit(x).cast("long"))
            second = F.coalesce(F.xxhash64("doc_id"), F.lit(0)).bitwiseAND(F.lit((1 << 62) - 1))
            heavy = rows.withColumn("pt", point).where(F.col("node").isin(list(cut))).where(F.col("pt") == spot)
            fine = _descend(heavy, second, {i: (0, (1 << 62) - 1) for i in cut}, {i: wanted[i] - at[i][1] for i in cut}, bins)
            last = _case({i: f[0] for i, f in fine.items()}, lambda x: F.lit(x).cast("long"))
            through = F.col("node").isin(list(cut)) & (point == spot)
            left = F.when(through, second <= last).otherwise(F.when(F.col("node").isin(list(cut)), point < spot).otherwise(left))
        split, children = {}, {}
        for i, (first, n) in nodes.items():
            if i in at:
                children[2 * i + 1] = (first, n // 2)
                children[2 * i + 2] = (first + n // 2, n - n // 2)
                split[i] = first + n // 2
            elif n == 1:
                children[i] = (first, n)
        moved = F.when(left, F.col("node") * 2 + 1).otherwise(F.col("node") * 2 + 2)
        shard = F.when(left, F.col("shard")).otherwise(_case(split, lambda x: F.lit(x)))
        inner = F.col("node").isin(list(split))
        rows = checkpointed(rows.select(
            "doc_id", "size", "wide", "lines", "text_crc32",
            F.when(inner, moved).otherwise(F.col("node")).cast("int").alias("node"),
            F.when(inner, shard).otherwise(F.col("shard")).cast("int").alias("shard"),
        ))
        nodes = children
    return rows.drop("node")


def with_slots(rows: DataFrame, per_bucket: int = 100_000) -> DataFrame:
    """slot: gapless from 0 in each shard, by buckets of doc_id's hash (about
    ``per_bucket`` rows each), so no task holds a whole shard. ``rows`` come from
    ``kd_shards``, which has checkpointed them."""
    buckets = max(64, -(-rows.count() // per_bucket))
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "text_crc32", "size"), F.lit(buckets)))
    counts = rows.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    order = Window.partitionBy("shard", "bucket").orderBy("doc_id", "text_crc32", "size")
    return (
        rows.withColumn("nth", F.row_number().over(order) - 1)
        .join(offsets, ["shard", "bucket"])
        .withColumn("slot", F.col("nth") + F.col("offset"))
        .drop("bucket", "nth", "offset")
    )
