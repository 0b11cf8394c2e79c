"""Language identification with string kernels.

The kernel is the blended-spectrum presence kernel: the share of byte n-grams of
orders 1 to 4 that two texts have in common, |A & B| / sqrt(|A| |B|), over presence
sets hashed to ``ROWS`` buckets.  ``LANDMARKS`` training texts of each ``GROUP``
languages give the Nystroem features K(x, L) K(L, L)^-1/2, on which kernel ridge
regression is solved for each of these languages against the rest.  As the kernel is linear in the presence vector,
scoring a batch is one matrix product of presence vectors with the landmarks'
presence vectors weighted by the dual coefficients, divided by sqrt(|x|).

The score is the winning machine's output moved from [-1, 1] to [0, 1]: above 0.5
the machine accepts the text, at or below 0.5 every machine says "the rest".

Training: every language value; at most ``PER_CLASS`` documents of each, whole
texts, a task for each group of languages.  A task also gets about ``REST`` documents
dealt evenly over all languages, so that each machine has seen the other groups (with
more than ``REST`` languages, those of a share of them).  Scoring: one pass over the
texts for each ``PASS_LANGS`` languages, the best machine so far going along.

Defined results: NULL texts and texts without a letter are ``und`` with score 0;
without any training row every text is ``und``; ties go to the first language in
byte order.  Language, source and id are no inputs of a prediction.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import drop_materialized, flat_bytes, id_remainder, materialize, slices

ORDERS = (1, 2, 3, 4)
ROWS = 1 << 16
PER_CLASS = 400
LANDMARKS = 256
RIDGE = 1e-2
#: Languages that share their landmarks, and rows of all languages that a group sees.
GROUP = 16
REST = PER_CLASS * GROUP
#: Languages scored in one pass: 256 KB of broadcast weights each.
PASS_LANGS = 256
#: Sampled ids broadcast to the texts; above, the join is left to the planner.
BROADCAST_IDS = 1 << 18
HELD_OUT_MOD, HELD_OUT_REST = 3, 1
UND = "und"
#: Texts whose presence vectors are held at a time, and bytes hashed at a time.
BATCH_TEXTS = 64
PIECE = 1 << 19

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def presence(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(texts, ROWS) of 0 and 1: the n-grams of each whole text, hashed."""
    out = np.zeros((len(offsets) - 1, ROWS), bool)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    end = offsets[1:]
    low = _LOWER[raw]
    for lo in range(0, len(raw), PIECE):
        hi = min(lo + PIECE, len(raw))
        key = np.zeros(hi - lo, np.uint32)
        at, of = np.arange(lo, hi), doc[lo:hi]
        for n in ORDERS:
            ok = at + n <= end[of]
            key, at, of = key[ok], at[ok], of[ok]
            key = (key << np.uint32(8)) | low[at + n - 1]
            h = (key + np.uint32(n * 0x3C6EF372 & 0xFFFFFFFF)) * np.uint32(0x9E3779B1)
            out[of, (h ^ (h >> np.uint32(15))) * np.uint32(0x85EBCA77) >> np.uint32(16)] = True
    return out


def train_machines(texts: list[bytes], langs: list[str], names: list[str], landmarks: int = LANDMARKS) -> dict:
    """Machines of ``names``, all other rows being the rest.  Rows are taken as given;
    landmarks are dealt over the names in turn."""
    by = {x: [i for i, g in enumerate(langs) if g == x] for x in names}
    turn = [by[x][k] for k in range(max(map(len, by.values()))) for x in names if k < len(by[x])]
    marks = turn[:landmarks]

    def vectors(rows):
        part = [texts[i] for i in rows]
        p = presence(np.frombuffer(b"".join(part), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in part])]))
        p = p.astype(np.float32)
        return p / np.sqrt(np.maximum(1, p.sum(axis=1, keepdims=True)))

    mark = np.concatenate([vectors(marks[i:i + BATCH_TEXTS]) for i in range(0, len(marks), BATCH_TEXTS)])
    value, basis = np.linalg.eigh((mark @ mark.T).astype(np.float64))
    root = basis / np.sqrt(np.maximum(value, 1e-6)) @ basis.T
    gram, target = np.zeros((len(marks), len(marks))), np.zeros((len(marks), len(names)))
    for i in range(0, len(texts), BATCH_TEXTS):
        rows = list(range(i, min(i + BATCH_TEXTS, len(texts))))
        phi = (vectors(rows) @ mark.T).astype(np.float64) @ root
        y = np.where(np.array([langs[r] for r in rows])[:, None] == np.array(names), 1.0, -1.0)
        gram += phi.T @ phi
        target += phi.T @ y
    dual = root @ np.linalg.solve(gram + RIDGE * np.eye(len(marks)), target)
    return {"names": names, "weights": (mark.T @ dual).astype(np.float32)}


def predict(raw: np.ndarray, offsets: np.ndarray, model: dict) -> tuple[np.ndarray, np.ndarray]:
    """(language number, output of its machine) of each text."""
    best, output = [], []
    for lo in range(0, len(offsets) - 1, BATCH_TEXTS):
        part = offsets[lo:lo + BATCH_TEXTS + 1]
        p = presence(raw[part[0]:part[-1]], part - part[0]).astype(np.float32)
        f = p @ model["weights"] / np.sqrt(np.maximum(1, p.sum(axis=1, keepdims=True)))
        f = f.astype(np.float32)
        best.append(f.argmax(axis=1))
        output.append(f.max(axis=1))
    return np.concatenate(best), np.concatenate(output)


def to_score(output: np.ndarray) -> np.ndarray:
    return np.clip((output + 1) / 2, 0, 1)


@dataclass(frozen=True)
class Machines:
    """The machines of all languages, in byte order, as a written table (group, model)."""
    table: DataFrame
    groups: int

    def passes(self) -> Iterator[dict]:
        step = max(1, PASS_LANGS // GROUP)
        for lo in range(0, self.groups, step):
            yield joined(self.table.filter((F.col("group") >= lo) & (F.col("group") < lo + step)).collect())


def joined(rows: list) -> dict:
    """One model of the (group, model) rows."""
    parts = [pickle.loads(r["model"]) for r in sorted(rows, key=lambda r: r["group"])]
    return {"names": [x for p in parts for x in p["names"]],
            "weights": np.concatenate([p["weights"] for p in parts], axis=1)}


def _sample(docs: DataFrame, known: DataFrame, counts: dict[str, int], per_class: int,
            id_col: str, text_col: str, lang_col: str) -> DataFrame:
    """(group, class, own, rank, text): of each language the first ``per_class`` rows by
    a hash of the id, in their group's task, and the first few in every task.

    Ids far above the hash that ``per_class`` of a language lie below are not ranked,
    so no task gets all ids of a frequent language."""
    names = sorted(counts)
    groups, each, share = (len(names) - 1) // GROUP + 1, -(-REST // len(names)), -(-len(names) // REST)
    below = [min((1 << 63) - 1, -(1 << 63) + (1 << 64) * (2 * per_class + 200) // counts[x]) for x in names]
    languages = docs.sparkSession.createDataFrame(
        [(x, k // GROUP, b) for k, (x, b) in enumerate(zip(names, below))], "class string, group int, below long")
    first = Window.partitionBy("class").orderBy("__hash", "__sid")
    chosen = (known.withColumn("__hash", F.xxhash64("__sid")).join(F.broadcast(languages), "class")
              .filter(F.col("__hash") <= F.col("below"))
              .withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= per_class).drop("rank", "below"))
    if len(names) * per_class <= BROADCAST_IDS:
        chosen = F.broadcast(chosen)
    whole = docs.select(F.col(id_col).alias("__id"), F.col(lang_col).alias("__lang"), F.col(text_col).alias("text"))
    # Ranked again, as an id can have many texts.
    sample = (whole.filter(F.col("text").isNotNull())
              .join(chosen, F.col("__id").eqNullSafe(F.col("__sid")) & (F.col("__lang") == F.col("class")))
              .withColumn("rank", F.row_number().over(first.orderBy("__hash", "__sid", F.xxhash64("text"), "text")))
              .filter(F.col("rank") <= per_class))
    own = F.array("group")
    if groups > 1:
        seen = (F.col("rank") <= each) & (F.crc32(F.col("class").cast("binary")) % share == 0)
        own = F.when(seen, F.sequence(F.lit(0), F.lit(groups - 1))).otherwise(own)
        own = F.array_union(own, F.array("group"))
    return (sample.select(F.explode(own).alias("to"), "group", "class", "rank", "text")
            .select(F.col("to").alias("group"), "class", (F.col("to") == F.col("group")).alias("own"), "rank", "text")
            .repartition(groups, "group"))


def train_language_id(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                      per_class: int = PER_CLASS) -> dict | Machines | None:
    """One model, or the table of them where they do not go into one pass."""
    known = docs.filter(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull()
                        & (id_remainder(id_col, HELD_OUT_MOD) != HELD_OUT_REST)).select(
        F.col(id_col).alias("__sid"), F.col(lang_col).alias("class")).distinct()
    counts = {r["class"]: r["n"] for r in known.groupBy("class").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return None

    def train(key: tuple, rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("class", "ascending"), ("rank", "ascending")])
        langs = rows.column("class").to_pylist()
        names = sorted({x for x, mine in zip(langs, rows.column("own").to_pylist()) if mine})
        model = train_machines([t.encode() for t in rows.column("text").to_pylist()], langs, names)
        return pa.table({"group": pa.array([key[0].as_py()], pa.int32()),
                         "model": pa.array([pickle.dumps(model)], pa.binary())})

    trained = _sample(docs, known, counts, per_class, id_col, text_col, lang_col).groupBy("group").applyInArrow(
        train, "group int, model binary")
    if len(counts) <= PASS_LANGS:
        return joined(trained.collect())
    return Machines(materialize(trained, "language-machines"), (len(counts) - 1) // GROUP + 1)


def _scored(docs: DataFrame, model: dict | Machines, text_col: str,
            last: Callable[[pa.RecordBatch, pa.Array, np.ndarray], pa.RecordBatch], schema) -> DataFrame:
    """``last`` of the rows, their language and their machine's output.  One pass for a
    model; else the rows are written between the passes, so that the weights of one
    pass are in memory at a time."""
    at, width = docs.columns.index(text_col), len(docs.columns)

    def step(shared, out):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            m = shared.value
            for batch in batches:
                for lo, hi in slices(batch.column(at), 1 << 20):
                    part = batch.slice(lo, hi - lo)
                    best, output = predict(*flat_bytes(part.column(at)), m)
                    lang = [m["names"][b] for b in best]
                    if part.num_columns > width:
                        before = part.column(width + 1).to_numpy(zero_copy_only=False)
                        lang = [a if y >= x else b for a, b, x, y in
                                zip(part.column(width).to_pylist(), lang, output, before)]
                        output = np.maximum(output, before)
                    yield out(part.select(list(range(width))), pa.array(lang, pa.string()), output)
        return run

    def between(part: pa.RecordBatch, lang: pa.Array, output: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([*part.columns, lang, pa.array(output, pa.float32())],
                                          [*part.schema.names, "__machine", "__output"])

    carried = docs.select("*", F.lit("").alias("__machine"), F.lit(0.0).cast("float").alias("__output")).schema
    context = docs.sparkSession.sparkContext
    passes = [model] if isinstance(model, dict) else model.passes()
    df, shared, written = docs, None, None
    for m in passes:
        if shared is not None:
            df = materialize(df.mapInArrow(step(shared, between), carried), "language-pass")
            shared.destroy()
            if written is not None:
                drop_materialized(written)
            written = df
        shared = context.broadcast(m)   # at most PASS_LANGS columns
    return df.mapInArrow(step(shared, last), schema)


def identify(docs: DataFrame, model: dict | Machines | None, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """One row per input row: id, held_out, lang_pred, score.  No shuffle."""
    id_type = docs.schema[id_col].dataType.simpleString()
    out = (id_remainder(id_col, HELD_OUT_MOD) == HELD_OUT_REST).alias("held_out")
    if model is None:
        return docs.select(F.col(id_col), out, F.lit(UND).alias("lang_pred"), F.lit(0.0).alias("score"))

    def last(part: pa.RecordBatch, lang: pa.Array, output: np.ndarray) -> pa.RecordBatch:
        letter = np.array(part.column(3).to_pylist(), bool)
        return pa.RecordBatch.from_arrays(
            [part.column(0), part.column(1),
             pa.array([x if k else UND for x, k in zip(lang.to_pylist(), letter)], pa.string()),
             pa.array(np.where(letter, to_score(output), 0.0).astype(np.float64))],
            [id_col, "held_out", "lang_pred", "score"])

    return _scored(docs.select(
        F.col(id_col).alias("__id"), out, F.col(text_col).alias("__text"),
        F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False)).alias("__letter")), model, "__text",
        last, f"{id_col} {id_type}, held_out boolean, lang_pred string, score double")


def accept_language(docs: DataFrame, model: dict | Machines | None, text_col: str = "text") -> DataFrame:
    """The rows, all columns, that some machine accepts (score above 0.5); texts
    without a letter go.  Without a model no text has a language: none stays."""
    if model is None:
        return docs.limit(0)
    return _scored(docs.filter(F.col(text_col).rlike(r"\p{L}")), model, text_col,
                   lambda part, lang, output: part.filter(pa.array(to_score(output) > 0.5)), docs.schema)
