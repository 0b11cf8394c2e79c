"""Training on every row: rows are dealt to shards of bounded size, each shard is
trained by one task from the models broadcast, and the updates are averaged.

Models are dicts of float32 arrays of fixed shapes.  An entry's update is averaged over
the shards that moved it, so what only one shard knows of is not watered down by the
others.  Updates travel in blocks of ``BLOCK`` entries and are summed row by row, in the
order of the shards; only the averages, of a fixed size, reach the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK = 1 << 16
Model = dict[str, np.ndarray]


def _flat(model: Model) -> np.ndarray:
    return np.concatenate([model[k].ravel() for k in sorted(model)])


def _shaped(flat: np.ndarray, like: Model) -> Model:
    out, at = {}, 0
    for k in sorted(like):
        out[k] = flat[at:at + like[k].size].reshape(like[k].shape).astype(np.float32)
        at += like[k].size
    return out


def chunks(batches: Iterator[pa.RecordBatch], column: str, bytes_col: str, max_bytes: int) -> Iterator[pa.Table]:
    """Rows of one value of ``column`` at a time, which come one after the other; cut
    where their ``bytes_col`` exceeds ``max_bytes``."""
    held, size, last = [], 0, None
    for batch in batches:
        at = 0
        for i, (key, n) in enumerate(zip(batch.column(column).to_pylist(), batch.column(bytes_col).to_pylist())):
            if size and (key != last or size >= max_bytes):
                yield pa.Table.from_batches([*held, batch.slice(at, i - at)])
                held, size, at = [], 0, i
            last, size = key, size + n + 1
        held.append(batch.slice(at))
    if size:
        yield pa.Table.from_batches(held)


def train_round(rows: DataFrame, models: list[Model], local: Callable[[pa.Table, int, Model], Model],
                takes: Callable[[int], list[int]], max_bytes: int) -> list[Model]:
    """One round over ``rows`` (columns ``shard`` and ``size``; the rows of a shard one
    after the other in one file).  ``local(rows, shard, model)`` trains a copy of a model
    on a shard; ``takes(shard)`` says which models learn from it."""
    spark = rows.sparkSession
    shared = spark.sparkContext.broadcast(models)   # fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, table in enumerate(chunks(batches, "shard", "size", max_bytes)):
            shard = table.column("shard")[0].as_py()
            for m in takes(shard):
                before = shared.value[m]
                update = _flat(local(table, shard, {k: v.copy() for k, v in before.items()})) - _flat(before)
                parts = [update[i:i + BLOCK].tobytes() for i in range(0, len(update), BLOCK)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([m] * len(parts), pa.int32()), pa.array(range(len(parts)), pa.int32()),
                     pa.array([shard] * len(parts), pa.int32()), pa.array([part] * len(parts), pa.int32()),
                     pa.array(parts, pa.binary())], ["model", "block", "shard", "part", "moves"])

    def mean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, total, moved = None, None, None

        def done():
            return pa.RecordBatch.from_arrays(
                [pa.array([key[0]], pa.int32()), pa.array([key[1]], pa.int32()),
                 pa.array([(total / np.maximum(moved, 1)).astype(np.float32).tobytes()], pa.binary())],
                ["model", "block", "moves"])
        for batch in batches:
            for m, b, moves in zip(*(batch.column(c).to_pylist() for c in ("model", "block", "moves"))):
                values = np.frombuffer(moves, np.float32)
                if key != (m, b):
                    if key is not None:
                        yield done()
                    key, total, moved = (m, b), np.zeros(len(values)), np.zeros(len(values))
                total += values
                moved += values != 0
        if key is not None:
            yield done()

    updates = rows.mapInArrow(run, "model int, block int, shard int, part int, moves binary")
    got = (updates.repartition("model", "block").sortWithinPartitions("model", "block", "shard", "part")
           .mapInArrow(mean, "model int, block int, moves binary").collect())
    shared.unpersist()
    out = []
    for m, model in enumerate(models):
        flat = _flat(model)
        for r in got:
            if r.model == m:
                flat[r.block * BLOCK:(r.block + 1) * BLOCK] += np.frombuffer(r.moves, np.float32)
        out.append(_shaped(flat, model))
    return out


def dealt(rows: DataFrame, shards: int) -> DataFrame:
    """``rows`` with the rows of each ``shard`` in one partition, in a fixed order."""
    return rows.repartitionById(shards, F.col("shard")).sortWithinPartitions("shard", "key")
