"""Bounded training samples and training in one task.

A sample holds at most ``per_class`` rows of each class, the first by a hash of
the id: the same rows at every run, whatever the partitioning.  Ids and classes are
ranked first; the texts are fetched by a broadcast of that bounded list and ranked again
as rows, so an id with many rows or labels takes no more than its share.  Of a class at
most ``SAMPLE_BYTES`` of text are taken, longer texts last.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Text of a class that a sample takes (a documented bound, as the number of rows).
SAMPLE_BYTES = 256 << 20


def sample_texts(docs: DataFrame, classes: DataFrame, values: list, per_class: int,
                 id_col: str = "doc_id", text_col: str = "text", extra: list[Column] = ()) -> DataFrame:
    """(text, class, *extra) of the sampled rows.  ``classes``: (id, class).  Only the
    named columns of ``docs`` are read, under names of their own."""
    ranked = classes.select(F.col(id_col).alias("__sid"), F.col(classes.columns[1]).alias("class"))
    parts = [ranked.filter(F.col("class") == F.lit(v)).orderBy(F.xxhash64("__sid"), "__sid").limit(per_class)
             for v in values]
    chosen = parts[0]
    for p in parts[1:]:
        chosen = chosen.union(p)
    texts = docs.select(F.col(id_col).alias("__did"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
                        *[c.alias(f"__x{k}") for k, c in enumerate(extra)])
    found = texts.join(F.broadcast(chosen.distinct()), F.col("__did") == F.col("__sid"))   # bounded: per_class a class
    rows = (Window.partitionBy("class").orderBy(F.xxhash64("__sid"), "__sid", F.octet_length("text"), F.xxhash64("text")))
    short = Window.partitionBy("class").orderBy(F.octet_length("text"), "_row").rowsBetween(Window.unboundedPreceding, 0)
    found = found.withColumn("_row", F.row_number().over(rows)).filter(F.col("_row") <= per_class)
    found = found.withColumn("_bytes", F.sum(F.octet_length("text")).over(short)).filter(F.col("_bytes") <= SAMPLE_BYTES)
    names = [c for c in docs.select(*extra).columns] if extra else []
    return found.select("text", "class", *[F.col(f"__x{k}").alias(n) for k, n in enumerate(names)], "__sid")


def train_in_task(sample: DataFrame, train: Callable[[pa.Table], object]):
    """Runs ``train`` on the whole (bounded) sample in one task, in a fixed row
    order, and returns its result."""
    columns = [c for c in sample.columns if c != "__sid"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = list(batches)
        if got:
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(train(pa.Table.from_batches(got)))], pa.binary())],
                                             ["model"])

    rows = (sample.repartition(1).sortWithinPartitions(F.xxhash64("__sid"), "__sid").select(*columns)
            .mapInArrow(run, "model binary").collect())
    return pickle.loads(rows[0]["model"]) if rows else None


class Adam:
    """Adam steps on a dict of arrays."""

    def __init__(self, params: dict, rate: float):
        import numpy as np
        self.params, self.rate, self.t = params, rate, 0
        self.m = {k: np.zeros_like(v) for k, v in params.items()}
        self.v = {k: np.zeros_like(v) for k, v in params.items()}

    def step(self, grads: dict, rate: float | None = None) -> None:
        import numpy as np
        self.t += 1
        rate = (rate or self.rate) * np.sqrt(1 - 0.999 ** self.t) / (1 - 0.9 ** self.t)
        for k, g in grads.items():
            self.m[k] += 0.1 * (g - self.m[k])
            self.v[k] += 0.001 * (g * g - self.v[k])
            self.params[k] -= (rate * self.m[k] / (np.sqrt(self.v[k]) + 1e-8)).astype(self.params[k].dtype)
