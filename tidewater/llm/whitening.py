"""Embedding whitening with a weighted multiplicity covariance.

Entries become whole numbers x = floor(scale * c) + shift. Equal x vectors are one
row with a count, and the counts (or one) are the fit weights. Sums are whole
numbers, so the mean has no rounding; vectors are centred before the weighted GEMM.
Each task adds up its own d x d partial matrix; rows of it are summed on Spark, and
the driver gets the d x d result alone, which the dimension bounds. Each distinct
vector is whitened once and joined back to the rows that hold it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.session import scratch_path

from .common import join_counted, quoted

#: Vectors that a GEMM takes at a time.
ROWS = 8192
#: |scale * c| beyond this is cut to it, as a long could not hold the sums.
LARGEST = 1 << 46


def _packed(x: np.ndarray) -> list[bytes]:
    """Whole numbers less the shift, in the fewest bytes that hold the vector: one
    form for each vector, so bytes are equal where vectors are."""
    size = np.maximum(x.max(axis=1, initial=0), -1 - x.min(axis=1, initial=0))
    width = np.select([size < 1 << 7, size < 1 << 15, size < 1 << 31], [1, 2, 4], 8)
    out = [b""] * len(x)
    for w in np.unique(width).tolist():
        rows = np.flatnonzero(width == w)
        flat = x[rows].astype(f"<i{w}").tobytes()
        step = w * x.shape[1]
        for i, r in enumerate(rows.tolist()):
            out[r] = flat[i * step : (i + 1) * step]
    return out


def _unpacked(column: pa.Array, d: int) -> np.ndarray:
    out = np.empty((len(column), d), np.int64)
    raw = column.to_pylist()
    size = np.array([len(b) for b in raw], np.int64)
    for n in np.unique(size).tolist():
        rows = np.flatnonzero(size == n)
        out[rows] = np.frombuffer(b"".join(raw[r] for r in rows), f"<i{n // d}").reshape(len(rows), d)
    return out


def whole_vectors(rows: DataFrame, key: str, vector: str, scale: float) -> DataFrame:
    """vec_id, d and the packed x of every row whose vector is usable."""
    v = F.transform(quoted(vector), lambda c: c.cast("double"))
    good = F.col("v").isNotNull() & (F.size("v") > 0) & F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    usable = rows.select(quoted(key).cast("long").alias("vec_id"), v.alias("v")).where(good)

    def run(batches):
        for batch in batches:
            lists = batch.column(1)
            size = np.diff(lists.offsets.to_numpy())
            flat = lists.values.to_numpy(zero_copy_only=False)[lists.offsets[0].as_py() : lists.offsets[-1].as_py()] if len(lists) else np.empty(0)
            start = np.cumsum(size) - size
            x = np.clip(np.floor(scale * flat), -LARGEST, LARGEST).astype(np.int64)
            out = [b""] * len(lists)
            for d in np.unique(size).tolist():
                own = np.flatnonzero(size == d)
                for r, b in zip(own.tolist(), _packed(x[start[own][:, None] + np.arange(d)])):
                    out[r] = b
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(size.astype(np.int32)), pa.array(out, pa.binary())], names=["vec_id", "d", "x"])

    return usable.mapInArrow(run, "vec_id long, d int, x binary")


def _row_sums(parts: DataFrame, d: int) -> np.ndarray:
    """Sum of (i, row) over tasks, rows being ``d`` doubles: each row is reduced on
    its own, one at a time."""

    def add(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, row in zip(batch.column("i").to_pylist(), batch.column("row").to_pylist()):
                own = np.frombuffer(row)
                sums[i] = sums[i] + own if i in sums else own
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([v.tobytes() for v in sums.values()], pa.binary())], names=["i", "row"])

    # sums of some tasks first, then of those
    spread = parts.repartition("i", F.pmod("task", F.lit(32))).mapInArrow(add, "i int, row binary")
    total = spread.repartition("i").mapInArrow(add, "i int, row binary")
    out = np.zeros((d, d))
    for i, row in ((r["i"], r["row"]) for r in total.collect()):
        out[i] += np.frombuffer(bytes(row))
    return out


def _covariance(vectors: DataFrame, d: int, centred, weighted: bool, total: int) -> np.ndarray:
    """Weighted covariance over (x, count); ``centred`` maps packed rows to doubles
    that are less their mean already."""

    def run(batches):
        from pyspark import TaskContext

        sums = None
        for batch in batches:
            for a in range(0, batch.num_rows, ROWS):
                part = batch.slice(a, ROWS)
                rows = centred(part)
                weight = part.column("count").to_numpy().astype(float) if weighted else np.ones(len(rows))
                own = rows.T @ (rows * weight[:, None])
                sums = own if sums is None else sums + own
        n = 0 if sums is None else len(sums)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(n, TaskContext.get().partitionId())), pa.array(np.arange(n, dtype=np.int32)), pa.array([r.tobytes() for r in sums] if n else [], pa.binary())],
            names=["task", "i", "row"],
        )

    out = _row_sums(vectors.mapInArrow(run, "task long, i int, row binary"), d) / total
    return (out + out.T) / 2


def whiten(
    rows: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = 32,
    scale: float = 64.0, shift: int = 1_000_000, weighted: bool = True,
) -> DataFrame:
    """PCA whitening of x = floor(scale * c) + shift.

    Returns for each usable row and component (numbered from 1 by falling
    eigenvalue): vec_id, component, n (the fit list's size), deviation (sum over
    dimensions of (n x - S)^2, exact; null where no long holds it), whitened,
    explained (share of the trace) and identity_error (largest absolute entry of
    the whitened vectors' covariance less the identity, one value).

    With ``weighted`` the fit list is all usable rows (counts are the weights);
    without, each distinct vector once. Rows with a null vector, an empty one, or
    one that holds null or non-finite entries are dropped. Null and repeated keys
    keep their rows. |scale * c| over 2**46 counts as 2**46. A direction without
    variance has no component, so a constant table, one row or an empty table gives
    no rows; vectors of different lengths raise ``ValueError``. Equal vectors get
    equal rows, however many there are; other columns are ignored."""
    spark = rows.sparkSession
    path = scratch_path(spark, "whitening-rows")
    whole_vectors(rows, key, vector, scale).write.parquet(path)
    usable = spark.read.schema("vec_id long, d int, x binary").parquet(path)
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    shape = usable.agg(F.min("d").alias("lo"), F.max("d").alias("hi")).first()
    if shape["lo"] is None:
        return spark.createDataFrame([], schema)
    if shape["lo"] != shape["hi"]:
        raise ValueError(f"vectors of {shape['lo']} and of {shape['hi']} entries: one length is needed")
    d = shape["lo"]

    path = scratch_path(spark, "whitening-distinct")
    usable.groupBy("x").agg(F.count("*").alias("count")).write.parquet(path)
    distinct = spark.read.schema("x binary, count long").parquet(path)

    def sums(batches):
        n, total = 0, [0] * d
        for batch in batches:
            for a in range(0, batch.num_rows, ROWS):
                part = batch.slice(a, ROWS)
                x = _unpacked(part.column("x"), d)
                weight = part.column("count").to_numpy().astype(object) if weighted else np.ones(len(x), object)
                n += int(weight.sum())
                small = np.abs(x).max(initial=0) < 1 << 31 and int(weight.sum()) < 1 << 31
                own = (x * weight.astype(np.int64)[:, None]).sum(axis=0) if small else (x.astype(object) * weight[:, None]).sum(axis=0)
                total = [t + int(s) for t, s in zip(total, own)]
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, d, dtype=np.int32)), pa.array([str(t) for t in (n, *total)])], names=["i", "total"])

    exact = distinct.mapInArrow(sums, "i int, total string").groupBy("i").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    found = {r["i"]: int(r["total"]) for r in exact.collect()}
    n, s = found[-1], np.array([found[i] for i in range(d)], object)
    # x less S / n, as a whole part and a rest below one half
    whole = np.array([int(round_) for round_ in ((2 * t + n) // (2 * n) for t in s)], object)
    rest = np.array([float(t - w * n) / n for t, w in zip(s, whole)])
    near = whole.astype(np.int64)

    def centred(part):
        return (_unpacked(part.column("x"), d) - near) - rest

    value, vectors = np.linalg.eigh(_covariance(distinct, d, centred, weighted, n))
    order = np.argsort(-value, kind="stable")
    value, vectors = value[order], vectors[:, order]
    trace = float(value.sum())
    real = value > max(value[0], 0.0) * d * 1e-13
    k = min(components, int(real.sum()))
    if not k:
        return spark.createDataFrame([], schema)
    project = vectors[:, :k] / np.sqrt(value[:k])
    off = s - whole * n  # n x - S = n (x - whole) - off

    def deviation(x):
        y = x - near
        bound = n * int(np.abs(y).max(initial=0)) + max(abs(int(o)) for o in off)
        if d * bound * bound < 1 << 63:
            z = y * n - off.astype(np.int64)
            return (z * z).sum(axis=1).tolist()
        z = y.astype(object) * n - off
        return [v if v < 1 << 63 else None for v in (z * z).sum(axis=1).tolist()]

    def apply(batches):
        for batch in batches:
            for a in range(0, batch.num_rows, ROWS):
                part = batch.slice(a, ROWS)
                w = centred(part) @ project
                offsets = np.arange(len(w) + 1, dtype=np.int32) * k
                yield pa.RecordBatch.from_arrays(
                    [part.column("x"), part.column("count"), pa.array(deviation(_unpacked(part.column("x"), d)), pa.int64()), pa.ListArray.from_arrays(offsets, w.reshape(-1))],
                    names=["x", "count", "deviation", "whitened"],
                )

    path = scratch_path(spark, "whitening-whitened")
    distinct.mapInArrow(apply, "x binary, count long, deviation long, whitened array<double>").write.parquet(path)
    white = spark.read.schema("x binary, count long, deviation long, whitened array<double>").parquet(path)

    def whitened_rows(part):
        return part.column("whitened").flatten().to_numpy().reshape(part.num_rows, k)

    def mean_part(batches):
        total = np.zeros(k)
        for batch in batches:
            weight = batch.column("count").to_numpy().astype(float) if weighted else np.ones(batch.num_rows)
            total += weight @ whitened_rows(batch)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(k, dtype=np.int32)), pa.array(total)], names=["i", "total"])

    means = white.mapInArrow(mean_part, "i int, total double").groupBy("i").agg(F.sum("total").alias("total")).collect()
    mean = np.zeros(k)
    for r in means:
        mean[r["i"]] = r["total"] / n
    identity = _covariance(white, k, lambda part: whitened_rows(part) - mean, weighted, n)
    error = float(np.abs(identity - np.eye(k)).max())

    joined = join_counted(usable.select("vec_id", "x"), white, "x", n if weighted else usable.count())
    explained = F.array(*[F.lit(float(v / trace)) for v in value[:k]])
    return joined.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened")).select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        F.element_at(explained, F.col("at") + 1).alias("explained"), F.lit(error).alias("identity_error"),
    )
