"""Toxicity: a convolutional text classifier over hashed word embeddings.

Words are runs of letters, digits and bytes above 0x7F, A-Z in lower case.  A
word's vector is the sum of two learned rows: one of its hash, one of the hash of
its first ``PREFIX`` bytes, which covers inflected and compound forms.  Filters
over one, two and three neighbouring words are rectified and max-pooled over the
whole document, and a logistic layer gives the logit.

Training reads every labelled row, ``SHARD_BYTES`` of text in a task: each starts from
the smoothed log odds of the hash buckets (counted over all rows) and runs Adam through
the pooling over its shard, half of a batch from either class, until it has seen every
row; the shards' updates are averaged, ``ROUNDS`` times.

Thresholds are calibrated by language: a small hashed-word language model learned
from the training rows guesses a text's language from the text alone, and a threshold
on the logit is chosen per language (where it has enough rows of both classes, else for
all).  Its logits are those of all training rows, each from a network that learned from
the other half of them; they are counted in steps of 1/``GRID``.  The score is the
sigmoid of the logit moved so that this threshold is the contract's 0.7.

Defined results: NULL counts as the empty text; a text without words has pooled
features of 0 and gets a score as well; without labelled training rows of both
classes every score is 0.  Labels, language, source and id are no inputs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shards as sharded
from .common import drop_materialized, flat_bytes, id_remainder, materialize, slices
from .sampling import Adam

WORD_ROWS, PREFIX_ROWS = 1 << 15, 1 << 14
PREFIX = 4
DIM = 8
WIDTHS = (1, 2, 3)
FILTERS = 8
#: Text that one task trains on (a longer text is a shard's share all the same).
SHARD_BYTES = 32 << 20
#: Rounds, and steps of a round: more where a shard's larger class has more rows.
ROUNDS, STEPS, BATCH, RATE = 2, 250, 64, 0.01
HELD_OUT_MOD, HELD_OUT_REST = 3, 1
CUT = 0.7
#: Training rows are halved to calibrate: each half's logits come from the other's network.
FOLDS = 2
#: Steps of a logit's unit and the largest logit told apart.
GRID, TOP = 256, 64
#: Rows of either class that a language needs there for a threshold of its own.
MIN_CALIBRATE = 8
ALL = "*"   # the threshold of languages without one of their own

_P = np.uint64(0x9E3779B97F4A7C15)
_M = np.uint64(0xBF58476D1CE4E5B9)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[65:91] = _WORD[97:123] = _WORD[128:] = True


def word_rows(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word rows, prefix rows, words of each text) of texts laid end to end."""
    inside = _WORD[raw]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    starts = offsets[:-1][np.diff(offsets) > 0]
    first[starts] = inside[starts]
    start = np.flatnonzero(first)
    n = np.bincount(np.searchsorted(offsets, start, side="right") - 1, minlength=len(offsets) - 1)
    if not len(start):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), n
    place = np.zeros(len(raw), np.int64)
    place[start[0]:] = np.arange(start[0], len(raw)) - np.repeat(start, np.diff(np.append(start, len(raw))))
    power = np.cumprod(np.full(int(place.max()) + 1, _P), dtype=np.uint64)
    term = np.where(inside, (_LOWER[raw].astype(np.uint64) + np.uint64(1)) * power[place], np.uint64(0))

    def rows(t, size):
        h = np.add.reduceat(t, start)
        h = (h ^ (h >> np.uint64(29))) * _M
        return ((h ^ (h >> np.uint64(32))) % np.uint64(size)).astype(np.int64)
    return rows(term, WORD_ROWS), rows(np.where(place < PREFIX, term, np.uint64(0)), PREFIX_ROWS), n


def _responses(vectors: np.ndarray, kernel: np.ndarray) -> np.ndarray:
    """Windows of ``kernel.shape[0]`` words starting at each word; places behind
    the end count as zero vectors."""
    out = vectors @ kernel[0]
    for k in range(1, len(kernel)):
        out[:-k] += vectors[k:] @ kernel[k]
    return out


def features(word: np.ndarray, prefix: np.ndarray, n: np.ndarray, model: dict, where: bool = False):
    """Max-pooled responses (texts, filters of all widths), and with ``where`` the
    word at which each maximum window starts."""
    out = np.zeros((len(n), FILTERS * len(WIDTHS)), np.float32)
    at = np.zeros(out.shape, np.int64)
    some = np.flatnonzero(n)
    if len(some):
        vectors = model["word"][word] + model["prefix"][prefix]
        ends = np.cumsum(n)
        begin = (ends - n)[some]
        doc_end = np.repeat(ends, n)
        for i, width in enumerate(WIDTHS):
            r = _responses(vectors, model[f"filter{width}"])
            here = slice(i * FILTERS, (i + 1) * FILTERS)
            if width > 1:   # windows over a text's end see only its own words
                for k in range(1, width):
                    over = np.flatnonzero(np.arange(len(r)) + k >= doc_end)
                    inside = over[over + k < len(r)]
                    r[inside] -= vectors[inside + k] @ model[f"filter{width}"][k]
            top = np.maximum.reduceat(r, begin, axis=0)
            out[some, here] = np.maximum(top + model[f"shift{width}"], 0)
            if where:
                for d, (lo, hi) in enumerate(zip(begin, ends[some])):
                    at[some[d], here] = lo + r[lo:hi].argmax(axis=0)
    return (out, at) if where else out


def logits(word, prefix, n, model) -> np.ndarray:
    return features(word, prefix, n, model) @ model["weights"] + model["bias"][0]


def _log_odds(held: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Smoothed log odds of a document of class 1 holding each bucket; ``held``
    documents (class, bucket) of ``total`` (class) do."""
    rate = (held + 1) / (total[:, None] + 2)
    return np.log(rate[1] / rate[0])


def first_network(held: np.ndarray, total: np.ndarray, seed: int = 11) -> dict:
    rng = np.random.default_rng(seed)
    model = {"word": rng.normal(0, 0.05, (WORD_ROWS, DIM)).astype(np.float32),
             "prefix": rng.normal(0, 0.05, (PREFIX_ROWS, DIM)).astype(np.float32),
             "weights": np.full(FILTERS * len(WIDTHS), 0.1, np.float32), "bias": np.full(1, -1, np.float32)}
    odds = _log_odds(held, total) / 4
    model["word"][:, 0], model["prefix"][:, 0] = odds[:WORD_ROWS], odds[WORD_ROWS:]
    for width in WIDTHS:
        model[f"filter{width}"] = rng.normal(0, 0.2, (width, DIM, FILTERS)).astype(np.float32)
        model[f"filter{width}"][:, 0] = np.abs(model[f"filter{width}"][:, 0]) + 0.5 / width
        model[f"shift{width}"] = np.zeros(FILTERS, np.float32)
    return model


def train_network(model: dict, docs: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, seed: list[int],
                  begin: float = 0.0, end: float = 1.0) -> dict:
    """Trains ``model`` on all ``docs`` (word and prefix rows), from the part ``begin`` to
    the part ``end`` of the whole training."""
    rng = np.random.default_rng(seed)
    n = np.array([len(w) for w, _ in docs])
    sides = [s for s in (np.flatnonzero(labels == c) for c in (0, 1)) if len(s)]
    half = BATCH // len(sides)
    steps = max(STEPS, *(-(-len(s) // half) for s in sides))
    turns = [np.concatenate([rng.permutation(s) for _ in range(-(-steps * half // len(s)))]) for s in sides]
    adam = Adam(model, RATE)
    for step in range(steps):
        pick = np.concatenate([t[step * half:(step + 1) * half] for t in turns])
        w = np.concatenate([docs[i][0] for i in pick])
        p = np.concatenate([docs[i][1] for i in pick])
        k = n[pick]
        f, at = features(w, p, k, model, where=True)
        z = f @ model["weights"] + model["bias"][0]
        error = ((1 / (1 + np.exp(-np.clip(z, -40, 40))) - labels[pick]) / len(pick)).astype(np.float32)
        grads = {"weights": error @ f + 1e-4 * model["weights"], "bias": error.sum(keepdims=True)}
        back = error[:, None] * model["weights"] * (f > 0)
        word_grad, prefix_grad = np.zeros_like(model["word"]), np.zeros_like(model["prefix"])
        doc_end = np.cumsum(k)
        for i, width in enumerate(WIDTHS):
            here = slice(i * FILTERS, (i + 1) * FILTERS)
            b, start = back[:, here], at[:, here]
            kernel = model[f"filter{width}"]
            grad = np.zeros_like(kernel)
            grads[f"shift{width}"] = b.sum(axis=0)
            d, c = np.nonzero(b)
            for j in range(width):
                ok = start[d, c] + j < doc_end[d]
                dd, cc = d[ok], c[ok]
                place = start[dd, cc] + j
                vec = model["word"][w[place]] + model["prefix"][p[place]]
                np.add.at(grad[j].T, cc, vec * b[dd, cc][:, None])
                flow = kernel[j].T[cc] * b[dd, cc][:, None]
                np.add.at(word_grad, w[place], flow)
                np.add.at(prefix_grad, p[place], flow)
            grads[f"filter{width}"] = grad
        grads["word"], grads["prefix"] = word_grad, prefix_grad
        adam.step(grads, RATE * (1 - 0.9 * (begin + (end - begin) * step / steps)))
    return model


def guess_language(word: np.ndarray, n: np.ndarray, names: list[str], rates: np.ndarray | None) -> list[str]:
    if not names:
        return [ALL] * len(n)
    votes = np.zeros((len(n), len(names)))
    some = np.flatnonzero(n)
    if len(some):
        votes[some] = np.add.reduceat(rates[word], (np.cumsum(n) - n)[some], axis=0)
    return [names[i] if k else ALL for i, k in zip(votes.argmax(axis=1), n)]


def best_threshold(values: np.ndarray, counts: np.ndarray) -> float:
    """Middle of the widest best cut by balanced accuracy; ``counts`` (class, value) of
    rising ``values``."""
    cuts = np.concatenate([[values[0] - 1], (values[1:] + values[:-1]) / 2, [values[-1] + 1]])
    below = np.concatenate([np.zeros((2, 1)), np.cumsum(counts, axis=1)], axis=1) / np.maximum(1, counts.sum(axis=1))[:, None]
    good = below[0] - below[1]
    best = np.flatnonzero(good >= good.max() - 1e-12)
    return float((cuts[best[0]] + cuts[best[-1]]) / 2)


def _hashed(rows: DataFrame) -> DataFrame:
    """Word and prefix rows (16 bits each) in place of the texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in slices(batch.column(5), 1 << 20):
                word, prefix, n = word_rows(*flat_bytes(batch.column(5).slice(lo, hi - lo)))
                ends = np.cumsum(n)
                cut = [[r[e - k:e].astype(np.uint16).tobytes() for e, k in zip(ends, n)] for r in (word, prefix)]
                yield pa.RecordBatch.from_arrays(
                    [*batch.slice(lo, hi - lo).columns[:5], pa.array([6 * int(k) for k in n], pa.int64()),
                     *(pa.array(c, pa.binary()) for c in cut)],
                    ["shard", "key", "first", "class", "lang", "size", "words", "prefixes"])
    return rows.mapInArrow(run, "shard int, key long, first boolean, class int, lang string, size long, "
                                "words binary, prefixes binary")


def _docs(batch: pa.RecordBatch | pa.Table) -> list[tuple[np.ndarray, np.ndarray]]:
    return [(np.frombuffer(w, np.uint16), np.frombuffer(p, np.uint16))
            for w, p in zip(batch.column("words").to_pylist(), batch.column("prefixes").to_pylist())]


def _counts(hashed: DataFrame, folds: int) -> tuple[np.ndarray, list[str], np.ndarray | None]:
    """(documents that hold a row by fold and class, languages, log rates of their words)
    over all training rows; tasks send sums, which are added up by a shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, words = np.zeros((folds, 2, WORD_ROWS + PREFIX_ROWS), np.int64), {}

        def sums(lang, fold, label, counts):
            at = np.flatnonzero(counts)
            return pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at), pa.string()), pa.array([fold] * len(at), pa.int32()),
                 pa.array([label] * len(at), pa.int32()), pa.array(at, pa.int32()), pa.array(counts[at], pa.int64())],
                ["lang", "fold", "class", "row", "n"])
        for batch in batches:
            batch = batch.filter(batch.column("first"))
            for (w, p), shard, label, lang in zip(_docs(batch), *(batch.column(c).to_pylist()
                                                                  for c in ("shard", "class", "lang"))):
                held[shard % folds, label, np.unique(w)] += 1
                held[shard % folds, label, WORD_ROWS + np.unique(p).astype(np.int64)] += 1
                if lang is not None:
                    if lang not in words and len(words) >= 64:   # bounds the task
                        yield from (sums(x, None, None, c) for x, c in words.items())
                        words.clear()
                    if lang not in words:
                        words[lang] = np.zeros(WORD_ROWS, np.int64)
                    np.add.at(words[lang], w, 1)
        yield from (sums(x, None, None, c) for x, c in words.items())
        yield from (sums(None, f, c, held[f, c]) for f in range(folds) for c in (0, 1))

    got = (hashed.mapInArrow(run, "lang string, fold int, class int, row int, n long")
           .groupBy("lang", "fold", "class", "row").agg(F.sum("n").alias("n")).toArrow())
    row, n = (got.column(c).to_numpy() for c in ("row", "n"))
    held = np.zeros((folds, 2, WORD_ROWS + PREFIX_ROWS))
    of = np.array(got.column("lang").is_null())
    held[got.column("fold").to_numpy()[of].astype(int), got.column("class").to_numpy()[of].astype(int), row[of]] = n[of]
    names = sorted({r.lang for r in hashed.select("lang").distinct().collect() if r.lang is not None})
    if not names:
        return held, names, None
    rates = np.full((len(names), WORD_ROWS), 0.1)
    index = {x: i for i, x in enumerate(names)}
    rates[[index[x] for x in got.column("lang").to_pylist() if x is not None], row[~of]] += n[~of]
    return held, names, np.log(rates / rates.sum(axis=1, keepdims=True)).T.astype(np.float32)


def _thresholds(hashed: DataFrame, models: list[dict], names: list[str], rates: np.ndarray | None) -> dict[str, float]:
    """By guessed language and for all, from the logits of all training rows."""
    shared = hashed.sparkSession.sparkContext.broadcast((models, rates))   # fixed size
    folds = len(models)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        networks, rates = shared.value
        counts: dict[tuple[str, int], list[int]] = {}
        for batch in batches:
            batch = batch.filter(batch.column("first"))
            docs, shard, label = _docs(batch), batch.column("shard").to_numpy(), batch.column("class").to_numpy()
            for fold in range(folds):
                of = np.flatnonzero(shard % folds == fold)
                if not len(of):
                    continue
                word, prefix = (np.concatenate([docs[i][k] for i in of]) for k in (0, 1))
                n = np.array([len(docs[i][0]) for i in of])
                z = np.clip(logits(word, prefix, n, networks[fold]), -TOP, TOP)
                for g, step, y in zip(guess_language(word, n, names, rates), np.floor(z * GRID).astype(int).tolist(), label[of]):
                    counts.setdefault((g, step), [0, 0])[y] += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array([g for g, _ in counts], pa.string()), pa.array([s for _, s in counts], pa.int32()),
             *(pa.array([c[y] for c in counts.values()], pa.int64()) for y in (0, 1))], ["guess", "step", "n0", "n1"])

    got = (hashed.mapInArrow(run, "guess string, step int, n0 long, n1 long").groupBy("guess", "step")
           .agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).collect())
    shared.unpersist()

    def best(rows):
        steps = sorted({r.step for r in rows})
        counts, at = np.zeros((2, len(steps))), {s: i for i, s in enumerate(steps)}
        for r in rows:
            counts[:, at[r.step]] += (r.n0, r.n1)
        return best_threshold((np.array(steps) + 0.5) / GRID, counts), counts.sum(axis=1).min()
    of = {}
    for r in got:
        of.setdefault(r.guess, []).append(r)
    by = {g: best(of[g]) for g in of.keys() & set(names)}
    return {ALL: best(got)[0]} | {g: cut for g, (cut, fewest) in by.items() if fewest >= MIN_CALIBRATE}


def train_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   label_col: str = "toxic", lang_col: str = "lang") -> dict | None:
    known = (labels.filter(F.col(label_col).isin(0, 1) & (id_remainder(id_col, HELD_OUT_MOD) != HELD_OUT_REST))
             .select(F.col(id_col).alias("__sid"), F.col(label_col).cast("int").alias("class")).distinct())
    text = F.coalesce(F.col(text_col), F.lit(""))
    # a row's place is told by its id and text, whatever the partitioning
    training = id_remainder(id_col, HELD_OUT_MOD) != HELD_OUT_REST
    rows = docs.filter(training).select(
        F.col(id_col).alias("__did"), text.alias("text"), F.col(lang_col).alias("lang"),
        F.xxhash64(F.col(id_col), text).alias("key"), F.octet_length(text).alias("size"))

    def labelled(columns: list[str]) -> DataFrame:
        # the labels grow with the texts: the same join at any size, none is broadcast
        return (rows.select("__did", *columns).join(known.hint("merge"), F.col("__did") == F.col("__sid"))
                .drop("__did", "__sid"))

    sizes = (labelled(["key", "size"]).groupBy(F.pmod("key", F.lit(FOLDS)).alias("fold"), "class")
             .agg(F.count("*").alias("n"), F.sum("size").alias("bytes")).collect())
    if len({r["class"] for r in sizes}) < 2:
        return None
    folds = FOLDS if len(sizes) == 2 * FOLDS else 1   # a half without a class calibrates nothing
    shards = max(1, -(-sum(r.bytes for r in sizes) // (folds * SHARD_BYTES)))
    total = np.zeros((folds, 2))
    for r in sizes:
        total[r.fold % folds, r["class"]] += r.n
    # each shard gets rows of both classes: those of a rare one go to several
    copies = [int(min(shards, -(-BATCH // 2 * shards // total[:, c].min()))) for c in (0, 1)]
    spread = F.explode(F.sequence(F.lit(0), F.when(F.col("class") == 1, copies[1]).otherwise(copies[0]) - 1))
    place = F.pmod(F.shiftright("key", 8) + F.col("copy"), F.lit(shards)) * folds + F.pmod("key", F.lit(folds))
    hashed = _hashed(labelled(["text", "lang", "key"]).withColumn("copy", spread).select(
        place.cast("int").alias("shard"), "key", (F.col("copy") == 0).alias("first"), "class", "lang", "text"))
    hashed = materialize(sharded.dealt(hashed, shards * folds), "toxicity-words", "zstd")

    held, names, rates = _counts(hashed, folds)
    # one network of all rows and, with two halves, for either one that has not seen it
    others = [[f for f in range(folds) if f != k] for k in range(folds)] if folds > 1 else []
    learns = [list(range(folds)), *others]
    models = [first_network(held[of].sum(axis=0), total[of].sum(axis=0)) for of in learns]

    for number in range(ROUNDS):
        def local(part: pa.Table, shard: int, model: dict, number: int = number) -> dict:
            return train_network(model, _docs(part), part.column("class").to_numpy(), [11, number, shard],
                                 number / ROUNDS, (number + 1) / ROUNDS)
        models = sharded.train_round(hashed, models, local, lambda shard: [
            m for m, of in enumerate(learns) if shard % folds in of], 4 * SHARD_BYTES)
    thresholds = _thresholds(hashed, models[1:] or models, names, rates)
    drop_materialized(hashed)
    return models[0] | {"names": names, "rates": rates, "thresholds": thresholds}


def probabilities(raw: np.ndarray, offsets: np.ndarray, model: dict) -> np.ndarray:
    word, prefix, n = word_rows(raw, offsets)
    z = logits(word, prefix, n, model)
    cut = np.array([model["thresholds"].get(g, model["thresholds"][ALL])
                    for g in guess_language(word, n, model["names"], model["rates"])])
    return 1 / (1 + np.exp(-np.clip(z - cut + math.log(CUT / (1 - CUT)), -40, 40)))


def score_toxicity(docs: DataFrame, model: dict | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, held_out, score, predicted.  One pass, no shuffle."""
    id_type = docs.schema[id_col].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)   # fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = np.zeros(batch.num_rows)
            if shared.value is not None:
                for lo, hi in slices(batch.column(2), 1 << 20):
                    score[lo:hi] = probabilities(*flat_bytes(batch.column(2).slice(lo, hi - lo)), shared.value)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(score), pa.array((score >= CUT).astype(np.int32))],
                [id_col, "held_out", "score", "predicted"])

    return docs.select(F.col(id_col), (id_remainder(id_col, HELD_OUT_MOD) == HELD_OUT_REST).alias("__out"),
                       F.col(text_col)).mapInArrow(
        run, f"{id_col} {id_type}, held_out boolean, score double, predicted int")
