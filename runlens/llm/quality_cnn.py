"""Quality classifier: a byte-level convolutional network in numpy.

A document is cut into chunks of ``CHUNK`` bytes that overlap by the filter width,
so that every window of the whole document lies in one chunk.  A filter is one
weight per (place in the window, byte value): its response to a window is a sum of
table entries.  Rectified responses are max-pooled in each chunk; the document's
features are the maximum and the mean (by bytes) of its chunks, and a logistic
layer combines them into one probability.

Training: minibatch Adam through the pooling, on at most ``PER_CLASS`` labelled
documents of each class, whole texts, in one task; the intercept is corrected for
the class shares among all training labels.

Defined results: NULL counts as the empty text; an empty text is one chunk of
padding and gets a score as well; without labelled training rows of both classes
every score is 0.5.  Labels, language, source and id are no inputs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import flat_bytes, id_remainder, slices
from .sampling import Adam, sample_texts, train_in_task

CHUNK = 256
WIDTH = 8
STRIDE = 2
FILTERS = 16
#: Labelled documents of each class that training reads at most.
PER_CLASS = 2000
STEPS, BATCH, RATE = 700, 48, 0.01
HELD_OUT_MOD, HELD_OUT_REST = 5, 0
CUT = 0.3
#: Chunks whose responses are held at a time.
CHUNKS_AT_ONCE = 512


def chunk_grid(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(chunk start bytes in the padded array, first chunk of each text, padded
    bytes).  A text takes whole chunks, one at least, zero bytes behind it."""
    length = np.diff(offsets)
    chunks = np.maximum(1, -(-length // CHUNK))
    first = np.concatenate([[0], np.cumsum(chunks)])
    padded = np.zeros(first[-1] * CHUNK + WIDTH, np.uint8)
    shift = first[:-1] * CHUNK - offsets[:-1]
    padded[np.arange(len(raw)) + np.repeat(shift, length)] = raw
    filled = np.full(first[-1], CHUNK)
    filled[first[1:] - 1] = np.maximum(length - (chunks - 1) * CHUNK, 1)
    return padded, first, filled


def pooled(padded: np.ndarray, filled: np.ndarray, first: np.ndarray, table: np.ndarray, where: bool = False):
    """Max-pooled rectified responses (chunks, filters); with ``where`` also the
    window of each maximum."""
    n = len(filled)
    starts = np.arange(0, CHUNK, STRIDE)
    last = np.zeros(n, bool)
    last[first[1:] - 1] = True
    out = np.zeros((n, table.shape[2]), np.float32)
    at = np.zeros((n, table.shape[2]), np.int64)
    for lo in range(0, n, CHUNKS_AT_ONCE):
        hi = min(lo + CHUNKS_AT_ONCE, n)
        windows = (np.arange(lo, hi) * CHUNK)[:, None] + starts
        response = np.zeros((hi - lo, len(starts), table.shape[2]), np.float32)
        for k in range(WIDTH):
            place = windows + k
            byte = padded[place]
            # behind a text's last chunk stands another text
            byte = np.where(last[lo:hi, None] & (starts + k >= CHUNK), 0, byte)
            response += table[k][byte]
        response[starts[None, :] >= filled[lo:hi, None]] = 0
        if where:
            at[lo:hi] = response.argmax(axis=1)
            out[lo:hi] = np.take_along_axis(response, at[lo:hi][:, None, :], 1)[:, 0]
        else:
            out[lo:hi] = response.max(axis=1)
    return (np.maximum(out, 0), at) if where else np.maximum(out, 0)


def combine(chunk: np.ndarray, first: np.ndarray, filled: np.ndarray) -> np.ndarray:
    """(texts, 2 * filters): maximum over the chunks, mean weighted by bytes."""
    starts = first[:-1]
    total = np.add.reduceat(filled, starts).astype(np.float32)
    mean = np.add.reduceat(chunk * filled[:, None].astype(np.float32), starts, axis=0) / total[:, None]
    return np.concatenate([np.maximum.reduceat(chunk, starts, axis=0), mean], axis=1)


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def probabilities(raw: np.ndarray, offsets: np.ndarray, model: dict) -> np.ndarray:
    if len(offsets) < 2:
        return np.zeros(0)
    padded, first, filled = chunk_grid(raw, offsets)
    features = combine(pooled(padded, filled, first, model["table"]), first, filled)
    return sigmoid((features * model["weights"]).sum(axis=1) + model["bias"][0])


def train_network(texts: list[bytes], labels: np.ndarray, share: float, steps: int = STEPS, seed: int = 7) -> dict:
    """``share``: part of class 1 among all training labels."""
    rng = np.random.default_rng(seed)
    model = {"table": rng.normal(0, 0.3, (WIDTH, 256, FILTERS)).astype(np.float32),
             "weights": rng.normal(0, 0.1, 2 * FILTERS).astype(np.float32), "bias": np.zeros(1, np.float32)}
    sides = [np.flatnonzero(labels == c) for c in (0, 1)]
    adam = Adam(model, RATE)
    for step in range(steps):
        pick = np.concatenate([rng.choice(s, BATCH // 2) for s in sides])
        part = [texts[i] for i in pick]
        raw = np.frombuffer(b"".join(part), np.uint8)
        padded, first, filled = chunk_grid(raw, np.concatenate([[0], np.cumsum([len(t) for t in part])]))
        chunk, at = pooled(padded, filled, first, model["table"], where=True)
        features = combine(chunk, first, filled)
        error = (sigmoid((features * model["weights"]).sum(axis=1) + model["bias"][0]) - labels[pick]) / len(pick)
        error = error.astype(np.float32)
        grads = {"weights": (error[:, None] * features).sum(axis=0) + 1e-4 * model["weights"],
                 "bias": error.sum(keepdims=True)}
        # back through the mean (every chunk) and the maximum (its first best chunk)
        doc = np.repeat(np.arange(len(part)), np.diff(first))
        total = np.add.reduceat(filled, first[:-1])
        back = error[doc][:, None] * model["weights"][FILTERS:] * (filled / total[doc])[:, None].astype(np.float32)
        best = chunk == features[doc][:, :FILTERS]
        ties = np.add.reduceat(best.astype(np.float32), first[:-1], axis=0)[doc]
        back = back + best / np.maximum(ties, 1) * (error[doc][:, None] * model["weights"][:FILTERS])
        back[chunk <= 0] = 0
        c, f = np.nonzero(back)
        grad = np.zeros_like(model["table"])
        last = np.zeros(len(filled), bool)
        last[first[1:] - 1] = True
        start = at[c, f] * STRIDE
        for k in range(WIDTH):
            byte = np.where(last[c] & (start + k >= CHUNK), 0, padded[c * CHUNK + start + k])
            np.add.at(grad[k], (byte, f), back[c, f])
        grads["table"] = grad
        adam.step(grads, RATE * (1 - 0.9 * step / steps))
    model["bias"] = model["bias"] + np.float32(np.log(share / (1 - share)))
    return model


def train_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  label_col: str = "quality", per_class: int = PER_CLASS) -> dict | None:
    known = labels.filter(F.col(label_col).isin(0, 1) & (id_remainder(id_col, HELD_OUT_MOD) != HELD_OUT_REST)
                          ).select(id_col, F.col(label_col).alias("class"))
    counts = {r["class"]: r["n"] for r in known.groupBy("class").agg(F.count("*").alias("n")).collect()}
    if len(counts) < 2:
        return None
    share = counts[1] / (counts[0] + counts[1])

    def train(rows: pa.Table) -> dict | None:
        y = rows.column("class").to_numpy().astype(np.int64)
        if len(set(y.tolist())) < 2:
            return None
        return train_network([t.encode() for t in rows.column("text").to_pylist()], y, share)

    return train_in_task(sample_texts(docs, known, [0, 1], per_class, id_col, text_col), train)


def score_quality(docs: DataFrame, model: dict | None, id_col: str = "doc_id", text_col: str = "text",
                  cut: float = CUT) -> DataFrame:
    """One row per input row: id, held_out, score, predicted.  One pass, no shuffle."""
    id_type = docs.schema[id_col].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)   # fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = np.full(batch.num_rows, 0.5)
            if shared.value is not None:
                for lo, hi in slices(batch.column(2), 1 << 20):
                    score[lo:hi] = probabilities(*flat_bytes(batch.column(2).slice(lo, hi - lo)), shared.value)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(score), pa.array((score >= cut).astype(np.int32))],
                [id_col, "held_out", "score", "predicted"])

    return docs.select(F.col(id_col), (id_remainder(id_col, HELD_OUT_MOD) == HELD_OUT_REST).alias("__out"),
                       F.col(text_col)).mapInArrow(
        run, f"{id_col} {id_type}, held_out boolean, score double, predicted int")


def accept_quality(docs: DataFrame, model: dict | None, text_col: str = "text", cut: float = CUT) -> DataFrame:
    """The rows, all columns, that the classifier does not reject."""
    shared = docs.sparkSession.sparkContext.broadcast(model)   # fixed size
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in slices(batch.column(at), 1 << 20):
                part = batch.slice(lo, hi - lo)
                if shared.value is not None:
                    part = part.filter(pa.array(probabilities(*flat_bytes(part.column(at)), shared.value) >= cut))
                yield part

    return docs.mapInArrow(run, docs.schema)
