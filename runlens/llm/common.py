"""Helpers shared by the training-data operators.

Conventions of every operator here:

* only the named input columns are read, so extra columns (also ones named like
  an output column) never clash;
* a NULL text counts as the empty text, a NULL document id as the empty string
  wherever an id is hashed; repeated rows are separate rows;
* intermediate tables go below ``spark.checkpoint.dir`` (``materialize``), never
  into a machine-local folder, so a lost executor only costs a re-read.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

#: Bytes of one Arrow batch handed to Python: bounds a worker's memory whatever
#: the length of the texts.
ARROW_BATCH_BYTES = 8 << 20


def configure(spark: SparkSession) -> None:
    """Bound the Arrow batches by bytes (a runtime setting of the session), and
    let Python workers find this package where it lies on the driver's path
    (clusters install it, or ship it with ``--py-files``) and use one thread each."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BATCH_BYTES))
    spark.sparkContext.environment.update(OMP_NUM_THREADS="1", OPENBLAS_NUM_THREADS="1")
    root = str(Path(__file__).resolve().parents[2])
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def id_remainder(col: str | Column, mod: int) -> Column:
    """crc32(id as text) mod ``mod``; a NULL id counts as the empty text."""
    c = F.col(col) if isinstance(col, str) else col
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")) % F.lit(mod)


def materialize(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back: cuts the
    lineage with a table every executor (and a replacement of one) can read."""
    path = scratch_path(df.sparkSession, f"llm-{name}")
    (df.write.option("compression", compression) if compression else df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_materialized(df: DataFrame) -> None:
    """Delete a table of ``materialize`` that no later plan reads."""
    spark = df.sparkSession
    files = df.inputFiles()
    if files:
        jpath = spark._jvm.org.apache.hadoop.fs.Path(files[0].rsplit("/", 1)[0])
        jpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jpath, True)


def text_blocks(df: DataFrame, block_bytes: int, col: str = "text") -> int:
    """How many blocks of about ``block_bytes`` of text ``df`` holds (one pass
    over the text column, one row to the driver)."""
    total = df.agg(F.sum(F.octet_length(col))).first()[0]
    return max(1, -(-int(total or 0) // block_bytes))


def byte_list(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """UTF-8 bytes of a text column, NULL as empty."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def text_list(column: pa.Array | pa.ChunkedArray) -> list[str]:
    return ["" if x is None else x for x in column.to_pylist()]


def flat_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(all bytes of the column end to end, offsets of len + 1); NULL is empty."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return (raw[offsets[0]:offsets[-1]] if len(offsets) else raw[:0]), offsets - offsets[0]


def slices(column: pa.Array, max_bytes: int) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``max_bytes`` of text each (one row at least)."""
    if len(column) == 0:
        return
    _, offsets = flat_bytes(column)
    start = 0
    while start < len(column):
        end = int(np.searchsorted(offsets, offsets[start] + max_bytes, side="right")) - 1
        end = min(max(end, start + 1), len(column))
        yield start, end
        start = end


def sha_hex(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


class Memo(dict):
    """dict that computes what is missing; forgets everything when full, so that
    a worker's memory stays bounded whatever the vocabulary."""

    def __init__(self, compute, limit: int):
        super().__init__()
        self.compute, self.limit = compute, limit

    def __missing__(self, key):
        if len(self) >= self.limit:
            self.clear()
        value = self[key] = self.compute(key)
        return value
