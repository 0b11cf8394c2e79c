"""Whitening of embeddings by the leading principal components.

1. Vectors become integers ``x = floor(64 c) + 1000000``; one pass counts them and adds
   them up exactly, per dimension.
2. The covariance is summed over all vectors, centred before multiplying; each task
   adds up a matrix of its own, and those are added in two steps (rows of the matrix
   are the keys).  Only that matrix, of the size of a vector squared, reaches the driver.
3. ``eigen`` finds the leading pairs; components with less than ``LEAST_PART`` of the
   largest eigenvalue are noise of rounding and are left out.
4. The broadcast projection maps every vector; one more pass measures how far the
   covariance of the result is from the identity.

Defined results: rows whose vector is NULL, or holds a NULL or non-finite entry or one
beyond 2^31 (``x`` would leave its range), drop out; so do vectors of another length
than the most frequent one (of two such the longer).  A table without remaining rows,
or whose rows are all equal, gives no rows.  Repeated rows and NULL ids count and
return as often as they stand.  Only the id and vector columns are read, so others
never clash.  ``deviation`` is NULL beyond 38 digits.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .eigen import leading_pairs

COMPONENTS = 32
SCALE, OFFSET = 64, 1_000_000
#: Entries up to this size keep x and its sums within 64 bits.
LARGEST = float(1 << 31)
#: Components below this part of the largest eigenvalue are left out.
LEAST_PART = 1e-10
#: Partial matrices are added in so many groups first.
ADD_GROUPS = 64


def clean_vectors(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> tuple[DataFrame, int]:
    """(rows (id, v) whose vectors are whole and of the usual length, that length)."""
    v = F.col(vec_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).alias("id"), v.alias("v")).filter(
        F.col("v").isNotNull() & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) <= F.lit(LARGEST))))
    usual = (rows.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n"))
             .orderBy(F.desc("n"), F.desc("d")).first())
    d = usual["d"] if usual else 0
    return rows.filter(F.size("v") == d), d


def _matrix(batch: pa.RecordBatch, d: int) -> np.ndarray:
    """x of the batch's vectors, one row each."""
    c = batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, d)
    return np.floor(SCALE * c).astype(np.int64) + OFFSET


def exact_sums(rows: DataFrame, d: int) -> tuple[int, list[int]]:
    """(number of rows, sum of x per dimension), exactly."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = 0
        for batch in batches:
            if batch.num_rows:
                total = _matrix(batch, d).sum(axis=0)   # of one batch: within 64 bits
                yield pa.RecordBatch.from_arrays([pa.array(range(d), pa.int32()), pa.array(total)], ["i", "s"])
                n += batch.num_rows
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([d], pa.int32()), pa.array([n])], ["i", "s"])

    got = (rows.select("v").mapInArrow(run, "i int, s bigint").groupBy("i")
           .agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect())
    sums = {r["i"]: int(r["s"]) for r in got}
    return sums.get(d, 0), [sums.get(i, 0) for i in range(d)]


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """x - S / n in double precision: the whole part is taken off as integers."""
    whole = np.array([s // n for s in sums], dtype=np.int64)
    rest = np.array([s % n / n for s in sums])
    return (x - whole) - rest


def _add_up(partial: DataFrame) -> np.ndarray:
    """Sum of the partial matrices' rows (i, g, values), in groups first."""
    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        return pdf.iloc[:1].assign(values=[np.sum(np.stack(pdf["values"].to_numpy()), axis=0)])

    schema = "i int, g int, values array<double>"
    once = partial.groupBy("i", "g").applyInPandas(add, schema)
    rows = once.groupBy("i").applyInPandas(add, schema).orderBy("i").collect()
    return np.array([r["values"] for r in rows])


def _products(rows: DataFrame, d: int, project) -> np.ndarray:
    """Sum over all rows of y yᵀ, and of y in the last row, for y = ``project(x)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                y = project(_matrix(batch, d))
                part = np.vstack([y.T @ y, y.sum(axis=0)])
                total = part if total is None else total + part
        if total is not None:
            g = TaskContext.get().partitionId() % ADD_GROUPS
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(total)), pa.int32()), pa.array([g] * len(total), pa.int32()),
                 pa.array(total.tolist(), pa.list_(pa.float64()))], ["i", "g", "values"])

    return _add_up(rows.select("v").mapInArrow(run, "i int, g int, values array<double>"))


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> pa.Array:
    """Sum over dimensions of (n x - S)^2, exactly."""
    kind = pa.decimal128(38, 0)
    far = n * np.abs(_centred(x, n, sums)).max(initial=0) + 1
    if len(sums) * far * far < 2.0 ** 62 and n * (np.abs(x).max(initial=0) + 1) < 2 ** 62:
        return pa.array(((n * x - np.array(sums, dtype=np.int64)) ** 2).sum(axis=1)).cast(kind)
    exact = [sum((n * a - s) ** 2 for a, s in zip(row, sums)) for row in x.tolist()]
    return pa.array([Decimal(v) if v < 10 ** 38 else None for v in exact], kind)


def whiten(vectors: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id",
           vec_col: str = "embedding") -> DataFrame:
    """One row per remaining vector and component: id, component (from 1), n,
    deviation, whitened, explained, identity_error.  ``vectors`` is read five times."""
    spark = vectors.sparkSession
    rows, d = clean_vectors(vectors, id_col, vec_col)
    n, sums = exact_sums(rows, d)
    values, scaled, explained, error, shift = np.zeros(0), np.zeros((d, 0)), [], 0.0, np.zeros(d)
    if n:
        total = _products(rows, d, lambda x: _centred(x, n, sums))
        shift = total[-1] / n   # what rounding left of the mean
        covariance = total[:-1] / n - np.outer(shift, shift)
        values, axes = leading_pairs((covariance + covariance.T) / 2, components)
        keep = values > max(LEAST_PART * values[0], 0)
        values, scaled = values[keep], axes[:, keep] / np.sqrt(values[keep])
        explained = (values / np.trace(covariance)).tolist() if len(values) else []
    weights = spark.sparkContext.broadcast((scaled, shift))   # one vector's length by the components

    def project(x: np.ndarray) -> np.ndarray:
        scaled, shift = weights.value
        return (_centred(x, n, sums) - shift) @ scaled

    if len(values):
        after = _products(rows, d, project)
        mean = after[-1] / n
        error = float(np.abs(after[:-1] / n - np.outer(mean, mean) - np.eye(len(values))).max())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch, d)
                z = project(x)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(z) + 1) * z.shape[1], pa.int32()),
                                                 pa.array(np.ascontiguousarray(z).ravel()))
                yield pa.RecordBatch.from_arrays([batch.column("id"), _deviations(x, n, sums), lists],
                                                 ["id", "deviation", "z"])

    id_type = rows.schema["id"].dataType.simpleString()
    mapped = (rows if len(values) else rows.limit(0)).mapInArrow(
        run, f"id {id_type}, deviation decimal(38,0), z array<double>")
    parts = F.array(*[F.lit(e) for e in explained]) if explained else F.array().cast("array<double>")
    return mapped.select("id", "deviation", F.posexplode("z").alias("at", "whitened")).select(
        F.col("id").alias(id_col), (F.col("at") + 1).alias("component"), F.lit(n).cast("bigint").alias("n"),
        "deviation", "whitened", F.get(parts, F.col("at")).alias("explained"),
        F.lit(error).alias("identity_error"))
