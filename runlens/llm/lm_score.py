"""Language-model scores by context-tree weighting.

A byte is eight binary decisions.  The context of a decision is the preceding
bytes, ``DEPTH`` of them at the deepest level, so a tree node is (up to ``DEPTH``
bytes, the decision's place in the byte).  The contexts are those of the corpus:
their number and their counts grow with the training documents.

A gram is (context bytes, nearest first; byte) in one long.  Counts of grams are
summed by Spark.  The tree is weighted from the leaves up: a node's probability is
the even mixture of its Krichevsky-Trofimov block probability and the product of
its children's.  The two lowest levels of a context lie in one shard (shards are
dealt by the upper context, which has at most 2 ** 16 grams); the upper levels are
sums by parent node, one row a node.  On the way down each node's share of its own
estimate is joined from parent to child, so a byte is predicted by the mixture of
the estimates of all depths.  Nothing of the model passes the driver.

The log10 probability of a text is the sum over all its bytes (line breaks stand
before a text); ``bits_per_byte`` is its code length.

The base score is an add-one unigram model over all training tokens.  Neither its
vocabulary nor the grams are bounded, so they are never broadcast: texts are dealt
into blocks of about ``BLOCK_BYTES``; each block lists the distinct tokens and
grams it holds, the counts are summed by token and gram and their values joined
back to the blocks, and each block is scored beside its own dictionary.

Defined results: NULL counts as the empty text, which has the end token and a
score of 0 (its probability as a byte string is 1); a NULL id is hashed as the
empty text; repeated rows are separate rows; without training documents every
token is unknown and the tree predicts evenly.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import byte_list, flat_bytes, id_remainder, materialize, slices, text_blocks

#: Bytes of the deepest context; a gram has one more and fits a long.
DEPTH = 4
BLOCK_BYTES = 16 << 20
#: Grams of a shard, on average.
SHARD_GRAMS = 1 << 17
HELD_OUT_MOD, HELD_OUT_REST = 7, 2
END = b""   # the end token; no word is empty


def byte_grams(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The gram of every byte of texts laid end to end: the DEPTH bytes before it,
    nearest first, then itself; line breaks stand before a text."""
    gram = np.zeros(len(raw), np.int64)
    starts = offsets[:-1]
    for back in range(1, DEPTH + 1):
        seen = np.full(len(raw), 10, np.uint8)
        seen[back:] = raw[:-back]
        for ahead in range(back):   # the first bytes of each text
            at = starts + ahead
            seen[at[at < offsets[1:]]] = 10
        gram = (gram << 8) | seen
    return (gram << 8) | raw


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """For x >= 0.5: Stirling's series after eight steps of the recurrence."""
    p = np.ones_like(x)
    for k in range(8):
        p *= x + k
    y = x + 8
    return (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * y ** 3) - np.log(p)


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Natural log of the Krichevsky-Trofimov probability of a block of bits."""
    out = np.zeros(zeros.shape)
    at = np.nonzero(zeros + ones)
    a, b = zeros[at].astype(float), ones[at].astype(float)
    out[at] = _log_gamma(a + 0.5) + _log_gamma(b + 0.5) - math.log(math.pi) - _log_gamma(a + b + 1)
    return out


def _summed(keys: np.ndarray, *columns: np.ndarray) -> list[np.ndarray]:
    """Distinct keys, ascending, and the sum of each column by key."""
    some, where = np.unique(keys, return_inverse=True)
    return [some] + [np.bincount(where, c, len(some)) for c in columns]


def _places(gram: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each bit of a byte: the node that decides it, in the deepest context
    (context << 8 | 2 ** bits so far + those bits), and the bit."""
    for bit in range(8):
        yield gram >> 8 << 8 | 1 << bit | (gram & 255) >> (8 - bit), gram >> (7 - bit) & 1


def _deepest(gram: np.ndarray, n: np.ndarray) -> list[np.ndarray]:
    """Nodes of the deepest contexts, and the zeros and ones seen at each."""
    nodes, bits = (np.concatenate(x) for x in zip(*_places(gram)))
    n = np.tile(n, 8)
    return _summed(nodes, np.where(bits, 0, n), np.where(bits, n, 0))


def _weigh(zeros: np.ndarray, ones: np.ndarray, below: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log weighted probability of inner nodes, ``below`` being the sum of their
    children's, and the weight of each node's own estimate."""
    own = log_kt(zeros, ones)
    both = np.logaddexp(own, below)
    return both - math.log(2), np.exp(own - both)


_NODE = "node bigint, zeros double, ones double, log_w double, stop double"


def _node_rows(node, zeros, ones, below) -> dict:
    log_w, stop = _weigh(zeros, ones, below)
    return {"node": node, "zeros": zeros, "ones": ones, "log_w": log_w, "stop": stop}


def _parent(node):
    """The node of the same decision, one context byte less."""
    return (node >> 16 << 8) | (node & 255)


def _parent_column(node: str) -> Column:
    return F.shiftleft(F.shiftright(node, 16), 8).bitwiseOR(F.col(node).bitwiseAND(F.lit(255)))


def _above(level: DataFrame) -> DataFrame:
    """The weighted parents of a level's nodes: sums by parent, one row a node."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_pydict(_node_rows(*[c.to_numpy() for c in batch.columns]))

    return level.groupBy(_parent_column("node").alias("node")).agg(
        F.sum("zeros"), F.sum("ones"), F.sum("log_w")).mapInArrow(run, _NODE)


def _shares(level: DataFrame, above: DataFrame | None) -> DataFrame:
    """(node, known, rest) of a level: the part of P(1) that this and all upper
    levels fix, and the weight left to the levels below."""
    estimate = (F.col("ones") + 0.5) / (F.col("zeros") + F.col("ones") + 1)
    if above is None:
        return level.select("node", (F.col("stop") * estimate).alias("known"), (1 - F.col("stop")).alias("rest"))
    upper = above.select(F.col("node").alias("up"), "known", "rest")
    return level.withColumn("up", _parent_column("node")).join(upper, "up").select(
        "node", (F.col("known") + F.col("rest") * F.col("stop") * estimate).alias("known"),
        (F.col("rest") * (1 - F.col("stop"))).alias("rest"))


def gram_values(grams: DataFrame) -> DataFrame:
    """(gram, value): log10 P(byte | context) of every row of ``grams`` (gram, n);
    rows with n = 0 are to be predicted but not learned from."""
    shards = max(1, -(-grams.count() // SHARD_GRAMS))

    def shard(node: Column) -> Column:
        return F.pmod(F.xxhash64(F.shiftright(node, 16)), F.lit(shards)).cast("int").alias("shard")

    def up(rows: pa.Table) -> pa.Table:
        nodes, zeros, ones = _deepest(rows.column("gram").to_numpy(), rows.column("n").to_numpy())
        return pa.table(_node_rows(*_summed(_parent(nodes), zeros, ones, log_kt(zeros, ones))))

    def down(rows: pa.Table, upper: pa.Table) -> pa.Table:
        gram = rows.column("gram").to_numpy()
        nodes, zeros, ones = _deepest(gram, rows.column("n").to_numpy())
        order = np.argsort(upper.column("node").to_numpy())
        known, rest = (upper.column(c).to_numpy()[order] for c in ("known", "rest"))
        at = np.searchsorted(upper.column("node").to_numpy()[order], _parent(nodes))
        one = known[at] + rest[at] * (ones + 0.5) / (zeros + ones + 1)
        value = np.zeros(len(gram))
        for node, bit in _places(gram):
            p = one[np.searchsorted(nodes, node)]
            value += np.log10(np.where(bit, p, 1 - p))
        return pa.table({"gram": gram, "value": value})

    dealt = grams.select(shard(F.col("gram")), "gram", "n")
    levels = [materialize(dealt.groupBy("shard").applyInArrow(up, _NODE), "lm-level")]
    for _ in range(DEPTH - 1):
        levels.append(materialize(_above(levels[-1]), "lm-level"))
    shares = None
    for level in reversed(levels):
        shares = _shares(level, shares)
    # a node of the lowest inner level holds its context from bit 8 on
    shares = shares.select(shard(F.shiftleft("node", 8)), "node", "known", "rest")
    return dealt.groupBy("shard").cogroup(shares.groupBy("shard")).applyInArrow(down, "gram bigint, value double")


class _Counts:
    """Summed counts by gram."""

    def __init__(self):
        self.parts, self.rows = [], 0

    def add(self, grams: np.ndarray, learn: bool) -> None:
        some, n = np.unique(grams, return_counts=True)
        self.parts.append((some, n if learn else np.zeros(len(some), np.int64)))
        self.rows += len(some)
        if self.rows > 1 << 20:
            self.merge()

    def merge(self) -> tuple[np.ndarray, np.ndarray]:
        grams, n = (np.concatenate(x) for x in zip(*self.parts))
        some, total = _summed(grams, n)
        self.parts, self.rows = [(some, total.astype(np.int64))], len(some)
        return self.parts[0]


def _stats(texts: DataFrame) -> DataFrame:
    """Rows (block, token, n) and (block, gram, n) for every token and gram of a
    block, n its training count."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens: dict[int, Counter] = {}
        grams: dict[int, _Counts] = {}
        for batch in batches:
            for lo, hi in slices(batch.column(2), 2 << 20):
                part = batch.slice(lo, hi - lo)
                blocks, held = part.column(0).to_numpy(), np.array(part.column(1).to_pylist(), bool)
                for block, out, text in zip(blocks.tolist(), held, byte_list(part.column(2))):
                    words = text.lower().split()
                    counter = tokens.setdefault(block, Counter())
                    if out:
                        for w in {*words, END}:
                            counter.setdefault(w, 0)
                    else:
                        counter.update(words)
                        counter[END] += 1
                for block in np.unique(blocks).tolist():
                    for out in (False, True):
                        raw, offsets = flat_bytes(part.column(2).filter(pa.array((blocks == block) & (held == out))))
                        if len(raw):
                            grams.setdefault(block, _Counts()).add(byte_grams(raw, offsets), not out)
        for block, counter in tokens.items():
            keys = list(counter)
            for i in range(0, len(keys), 100_000):
                part = keys[i:i + 100_000]
                yield _stat_rows(block, part, [None] * len(part), [counter[k] for k in part])
        for block, counts in grams.items():
            some, n = counts.merge()
            for i in range(0, len(some), 100_000):
                part = some[i:i + 100_000]
                yield _stat_rows(block, [None] * len(part), part, n[i:i + 100_000])

    return texts.mapInArrow(run, "block int, token binary, gram bigint, n bigint")


def _stat_rows(block: int, token: list, gram, n) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(token), block, np.int32)), pa.array(token, pa.binary()), pa.array(gram, pa.int64()),
         pa.array(n, pa.int64())], ["block", "token", "gram", "n"])


class GramTable:
    """Values by gram: open addressing, whole arrays at a time."""

    def __init__(self, grams: np.ndarray, values: np.ndarray):
        self.bits = max(4, (3 * len(grams)).bit_length())
        self.keys, self.values = np.full(1 << self.bits, -1, np.int64), np.zeros(1 << self.bits)
        left, at = np.arange(len(grams)), self._slots(grams)
        while len(left):
            free = self.keys[at] < 0
            self.keys[at[free]] = grams[left[free]]
            done = self.keys[at] == grams[left]
            self.values[at[done]] = values[left[done]]
            left, at = left[~done], self._next(at[~done])

    def _slots(self, grams: np.ndarray) -> np.ndarray:
        return ((grams.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def _next(self, at: np.ndarray) -> np.ndarray:
        return (at + 1) & ((1 << self.bits) - 1)

    def of(self, grams: np.ndarray) -> np.ndarray:
        at = self._slots(grams)
        wrong = np.flatnonzero(self.keys[at] != grams)
        while len(wrong):
            if (self.keys[at[wrong]] < 0).any():
                raise KeyError("a gram without a value")
            at[wrong] = self._next(at[wrong])
            wrong = wrong[self.keys[at[wrong]] != grams[wrong]]
        return self.values[at]


def text_scores(raw: np.ndarray, offsets: np.ndarray, table: GramTable) -> np.ndarray:
    """log10 probability of each text; ``table`` holds every gram of theirs."""
    out = np.zeros(len(offsets) - 1)
    some = np.flatnonzero(np.diff(offsets) > 0)
    if len(some):
        out[some] = np.add.reduceat(table.of(byte_grams(raw, offsets)), offsets[some])
    return out


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, held_out, n_tokens, n_known, train_tokens,
    base_score, score, bits_per_byte."""
    id_type = docs.schema[id_col].dataType.simpleString()
    blocks = text_blocks(docs, BLOCK_BYTES, text_col)
    # By id and text: rows without an id, or with one that others share, spread as well.
    texts = docs.select(F.pmod(F.xxhash64(id_col, text_col), F.lit(blocks)).cast("int").alias("block"),
                        (id_remainder(id_col, HELD_OUT_MOD) == HELD_OUT_REST).alias("held_out"),
                        F.col(text_col).alias("__text"), F.col(id_col).alias("__id"))
    stats = materialize(_stats(texts.drop("__id").repartition(blocks, "block")), "lm-stats")
    per_block = stats.filter(F.col("token").isNotNull()).select("block", "token", "n")
    counts = materialize(per_block.groupBy("token").agg(F.sum("n").alias("c")), "lm-counts")
    total, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.when(F.col("c") > 0, 1))).first()
    per_token = total + distinct + 1
    of_block = stats.filter(F.col("gram").isNotNull()).select("block", "gram", "n")
    grams = materialize(of_block.groupBy("gram").agg(F.sum("n").alias("n")), "lm-grams")
    values = gram_values(grams)
    dictionary = (per_block.select("block", "token").join(counts, "token")
                  .select("block", "token", F.lit(None).cast("bigint").alias("gram"), F.col("c").cast("double").alias("value"))
                  .unionByName(of_block.select("block", "gram").join(values, "gram")
                               .select("block", F.lit(None).cast("binary").alias("token"), "gram", "value")))

    def score(texts: pa.Table, entries: pa.Table) -> pa.Table:
        is_word = pc.is_valid(entries.column("token"))
        words, grams = entries.filter(is_word), entries.filter(pc.invert(is_word))
        known = dict(zip(words.column("token").to_pylist(), words.column("value").to_pylist()))
        table = GramTable(*[grams.column(c).to_numpy() for c in ("gram", "value")])
        log10 = math.log10
        value = {w: log10((c + 1) / per_token) for w, c in known.items()}
        unknown = {w for w, c in known.items() if c == 0}
        n_tokens, n_known, base, score, bits = [], [], [], [], []
        column = texts.column("__text").combine_chunks()
        column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
        for text in byte_list(column):
            tokens = text.lower().split()
            tokens.append(END)
            n_tokens.append(len(tokens))
            n_known.append(len(tokens) - sum(map(unknown.__contains__, tokens)) if unknown else len(tokens))
            base.append(math.fsum(map(value.__getitem__, tokens)))
        for lo, hi in slices(column, 1 << 20):
            raw, offsets = flat_bytes(column.slice(lo, hi - lo))
            part = text_scores(raw, offsets, table)
            score.extend(part.tolist())
            bits.extend((-part / math.log10(2) / np.maximum(1, np.diff(offsets))).tolist())
        n = len(n_tokens)
        return pa.Table.from_arrays(
            [texts.column("__id"), texts.column("held_out"), pa.array(n_tokens, pa.int64()),
             pa.array(n_known, pa.int64()), pa.array([total] * n, pa.int64()), pa.array(base, pa.float64()),
             pa.array(score, pa.float64()), pa.array(bits, pa.float64())],
            [id_col, "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte"])

    return texts.groupBy("block").cogroup(dictionary.groupBy("block")).applyInArrow(
        score, f"{id_col} {id_type}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
               "base_score double, score double, bits_per_byte double")
