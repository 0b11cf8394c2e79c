"""MinHash near-duplicates on five-word shingles, without losing a link.

Two documents are linked when 100 * |A & B| >= 85 * |A | B| over their shingle
sets; the result is the connected components of all links.

1. Sketch, one pass: ``HASHES`` minima of universal hashes over the shingles, 16
   bits of each kept.
2. Rows with one and the same word sequence form a class with a number of its own;
   everything after works on one text of each class.
3. Banding: ``BANDS`` keys of ``ROWS`` minima.  A linked pair misses every band
   with a probability of at most (1 - 0.85 ** ROWS) ** BANDS = 4.3e-7.
4. Star: every member of a bucket (band, key) is compared with the smallest
   member.  A group of near copies falls together after one comparison a member.
   Comparisons first check the number of equal minima against a bound that a
   linked pair passes but for about 1e-8 (signature verification), then the full
   shingle sets of both texts.
5. Buckets whose members are not in one component yet: up to ``PAIR_ROWS`` members
   are compared pair by pair; larger buckets are dealt as pairs of sub-blocks, and
   in each one matrix product of shingle incidences gives all intersection sizes,
   of which only a spanning forest of links leaves the task; these are confirmed on the
   full sets like all others.  So every pair of a bucket is linked, compared, or inside
   one component, and no list of pairs grows with the square of a group.
6. Components by alternating large-star and small-star, of classes first, then of
   the components that meet in a document with several texts.

No bucket is gathered in a task and nothing but counts reaches the driver.

Defined results: NULL and empty texts, and texts without words, have 0 shingles
and are linked with nothing; with fewer than five words the whole sequence is the
one shingle; rows with a NULL id stay alone with a NULL component.  Rows that
share an id are one document: it is linked with what any of its texts is linked with.
Only the id and text columns are read, so others never clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import byte_list, flat_bytes, materialize, slices
from .components import connected_components

WORDS = 5
PERCENT = 85
ROWS, BANDS = 5, 25
HASHES = ROWS * BANDS
#: Equal minima that a comparison needs: 0.85 * 125 = 106 are expected at the
#: threshold with a deviation of 4; 82 is six deviations below.
AGREE = 82
#: Members up to which the pairs of a bucket are listed.
PAIR_ROWS = 16
#: Rows and shingles of a sub-block of a larger bucket.
BLOCK_ROWS, BLOCK_SHINGLES = 2048, 1 << 20

_P = np.uint64(0x9E3779B97F4A7C15)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def hash_family(n: int = HASHES) -> tuple[np.ndarray, np.ndarray]:
    """Odd multipliers and addends of multiply-add-shift hashing, from one rule."""
    k = np.arange(1, 2 * n + 1, dtype=np.uint64) * _P
    return _mix(k[:n]) | np.uint64(1), _mix(k[n:])


def words_of(text: bytes) -> list[bytes]:
    """Runs outside 0x20 and 0x09-0x0D, A-Z in lower case."""
    return text.lower().split()


def shingle_set(words: list[bytes], n: int = WORDS) -> set:
    if len(words) < n:
        return {tuple(words)} if words else set()
    return set(zip(*[words[i:] for i in range(n)]))


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def shingle_hashes(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit shingle hashes of many texts end to end, and the offsets of each
    text's shingles.  Word hashes are byte polynomials from running sums."""
    n_docs = len(offsets) - 1
    low = _LOWER[raw]
    space = _SPACE[low]
    inside = ~space
    first = inside.copy()
    first[1:] &= space[:-1]
    starts_here = offsets[:-1][np.diff(offsets) > 0]
    first[starts_here] = inside[starts_here]
    start = np.flatnonzero(first)
    if not len(start):
        return np.zeros(0, np.uint64), np.zeros(n_docs + 1, np.int64)
    last = inside.copy()
    last[:-1] &= space[1:] | first[1:]
    end = np.flatnonzero(last) + 1
    longest = int((end - start).max())
    # polynomial per word: sum of byte * P ** (place in the word)
    place = np.arange(len(low)) - np.repeat(start, np.diff(np.append(start, len(low)))) if start[0] == 0 else None
    if place is None:
        place = np.zeros(len(low), np.int64)
        place[start[0]:] = np.arange(start[0], len(low)) - np.repeat(start, np.diff(np.append(start, len(low))))
    power = np.empty(longest, np.uint64)
    power[0] = 1
    np.cumprod(np.full(longest - 1, _P), out=power[1:], dtype=np.uint64)
    term = np.where(inside, (low.astype(np.uint64) + np.uint64(1)) * power[np.minimum(place, longest - 1)], np.uint64(0))
    word = _mix(np.add.reduceat(term, start) + (end - start).astype(np.uint64) * _M1)
    doc = np.searchsorted(offsets, start, side="right") - 1
    n_words = np.bincount(doc, minlength=n_docs)
    first_word = np.concatenate([[0], np.cumsum(n_words)])
    n_sh = np.where(n_words >= WORDS, n_words - WORDS + 1, (n_words > 0).astype(np.int64))
    bounds = np.concatenate([[0], np.cumsum(n_sh)])
    at = np.arange(bounds[-1]) - np.repeat(bounds[:-1], n_sh) + np.repeat(first_word[:-1], n_sh)
    left = np.repeat(first_word[1:], n_sh) - at   # words from the shingle's start to the text's end
    h = np.zeros(len(at), np.uint64)
    for k in range(WORDS):
        w = word[np.minimum(at + k, len(word) - 1)]
        h = np.where(k < left, _mix(h * _P + w + np.uint64(k + 1)), h)
    return h, bounds


def minima(h: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """(texts, HASHES) minima, low 16 bits; texts without shingles get zeros."""
    a, b = hash_family()
    some = np.flatnonzero(np.diff(bounds) > 0)
    out = np.zeros((len(bounds) - 1, HASHES), dtype="<u2")
    if len(some):
        starts = bounds[some]
        buf = np.empty_like(h)
        for k in range(HASHES):
            np.multiply(h, a[k], out=buf)
            np.add(buf, b[k], out=buf)
            np.right_shift(buf, np.uint64(32), out=buf)
            out[some, k] = (_mix(np.minimum.reduceat(buf, starts)) & np.uint64(0xFFFF)).astype("<u2")
    return out


def text_hash(text_col: str = "text") -> Column:
    """Tells the texts of rows that share an id apart."""
    return F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))


def sketch(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, hash (of the text), n_shingles (size of the set), seq (digest of the word
    sequence), sig."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in slices(batch.column(1), 1 << 20):
                text = batch.column(1).slice(lo, hi - lo)
                sig = minima(*shingle_hashes(*flat_bytes(text)))
                words = [words_of(t) for t in byte_list(text)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), batch.column(2).slice(lo, hi - lo),
                     pa.array([len(shingle_set(w)) for w in words], pa.int64()),
                     pa.array([hashlib.blake2b(b" ".join(w), digest_size=16).digest() for w in words], pa.binary()),
                     pa.array([s.tobytes() for s in sig], pa.binary())],
                    [id_col, "hash", "n_shingles", "seq", "sig"])

    return docs.select(F.col(id_col), F.col(text_col), text_hash(text_col).alias("__hash")).mapInArrow(
        run, f"{id_col} {id_type}, hash bigint, n_shingles bigint, seq binary, sig binary")


def _agree(pairs: DataFrame) -> DataFrame:
    """Signature verification: keeps pairs with at least AGREE equal minima."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), "<u2").reshape(-1, HASHES) for c in (2, 3))
                keep = pa.array((a == b).sum(axis=1) >= AGREE)
                yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)],
                                                 ["a", "b"])
    ids = ", ".join(f"{c} {pairs.schema[c].dataType.simpleString()}" for c in ("a", "b"))
    return pairs.select("a", "b", "sig_a", "sig_b").mapInArrow(run, ids)


def _confirm(pairs: DataFrame) -> DataFrame:
    """Keeps pairs whose full shingle sets reach the threshold."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}   # the last few sets: pairs arrive sorted by their centre

        def of(doc, text):
            found = held.get(doc)
            if found is None:
                if len(held) >= 8:
                    del held[next(iter(held))]
                found = held[doc] = shingle_set(words_of(text))
            return found
        for batch in batches:
            keep = []
            for a, b, ta, tb in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                    byte_list(batch.column(2)), byte_list(batch.column(3))):
                sb, sa = of(b, tb), of(a, ta)
                both = len(sa & sb)
                keep.append(100 * both >= PERCENT * (len(sa) + len(sb) - both))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], ["a", "b"])
    ids = ", ".join(f"{c} {pairs.schema[c].dataType.simpleString()}" for c in ("a", "b"))
    return pairs.select("a", "b", "text_a", "text_b").mapInArrow(run, ids)


def block_links(h: np.ndarray, bounds: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Boolean (left, right) matrix of links between texts with the shingle
    hashes ``h[bounds[i]:bounds[i + 1]]``, by products of their incidences."""
    doc = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    order = np.lexsort((h, doc))
    doc, h = doc[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])
    doc, h = doc[new], h[new]
    size = np.bincount(doc, minlength=len(bounds) - 1)
    _, column, times = np.unique(h, return_inverse=True, return_counts=True)
    shared = times > 1
    number = np.cumsum(shared) - 1
    keep = shared[column]
    doc, column = doc[keep], number[column[keep]]
    by = np.argsort(column, kind="stable")
    doc, column = doc[by], column[by]
    both = np.zeros((len(left), len(right)), np.float32)
    for lo in range(0, int(shared.sum()), 2048):
        at = slice(*np.searchsorted(column, [lo, lo + 2048]))
        x = np.zeros((len(bounds) - 1, 2048), np.float32)
        x[doc[at], column[at] - lo] = 1
        both += x[left] @ x[right].T
    both = both.astype(np.int64)
    union = size[left][:, None] + size[right][None, :] - both
    return 100 * both >= PERCENT * union


def forest(linked: np.ndarray, ids: list) -> list[tuple]:
    """Links (id, id) that span each component of a symmetric link matrix: from its
    smallest id outwards, each other one by a link to one reached before."""
    order = np.array(sorted(range(len(ids)), key=lambda i: ids[i]))
    linked = linked[np.ix_(order, order)]
    seen, out = np.zeros(len(ids), bool), []
    for root in range(len(ids)):
        front = np.array([], int) if seen[root] else np.array([root])
        seen[root] = True
        while len(front):
            reach = linked[front] & ~seen
            new = np.flatnonzero(reach.any(axis=0))
            by = front[reach[:, new].argmax(axis=0)]
            out += [(ids[order[a]], ids[order[b]]) for a, b in zip(new, by)]
            seen[new] = True
            front = new
    return out


def _blocked(rows: DataFrame) -> DataFrame:
    """Spanning links (a, b) of the block pairs in ``rows``: (band, key, lo, hi,
    side, rep, text), sorted within partitions by the first four."""
    id_type = rows.schema["rep"].dataType.simpleString()
    arrow_id = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[id_type]

    def links_of(held: list) -> list[tuple]:
        sides = np.array([r[0] for r in held])
        ids = [r[1] for r in held]
        texts = [r[2] for r in held]
        raw = np.frombuffer(b"".join(texts), np.uint8)
        h, bounds = shingle_hashes(raw, np.concatenate([[0], np.cumsum([len(t) for t in texts])]))
        left, right = np.flatnonzero(sides == 0), np.flatnonzero(sides == 1)
        linked = np.zeros((len(ids), len(ids)), bool)
        if len(right) == 0:
            linked = block_links(h, bounds, left, left)
        elif len(left):
            part = block_links(h, bounds, left, right)
            linked[np.ix_(left, right)] = part
            linked[np.ix_(right, left)] = part.T
        return forest(linked, ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, current = [], None

        def rows_of(found):
            return pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], arrow_id) for i in (0, 1)], ["a", "b"])
        for batch in batches:
            found = []
            for *key, side, rep, text in zip(*[c.to_pylist() for c in batch.columns[:6]], byte_list(batch.column(6))):
                if key != current:
                    found.extend(links_of(held) if len(held) > 1 else ())
                    held, current = [], key
                held.append((side, rep, text))
            yield rows_of(found)
        yield rows_of(links_of(held) if len(held) > 1 else [])

    return rows.select("band", "key", "lo", "hi", "side", "rep", "text").mapInArrow(run, f"a {id_type}, b {id_type}")


def row_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, hash (of its text), n_shingles, component (number of the
    class that its component has; NULL without shingles or id)."""
    sketches = materialize(sketch(docs, id_col, text_col), "sketches")
    some = sketches.filter((F.col("n_shingles") > 0) & F.col(id_col).isNotNull())
    # the number of a class is written with it
    classes = materialize(some.groupBy("seq").agg(
        F.min(F.struct(F.col(id_col).alias("id"), "hash")).alias("owner"), F.first("n_shingles").alias("shingles"),
        F.first("sig").alias("sig")).withColumn("rep", F.monotonically_increasing_id()), "classes")
    keys = classes.select("rep", "shingles", F.posexplode(F.transform(
        F.sequence(F.lit(0), F.lit(BANDS - 1)),
        lambda i: F.substring("sig", i * (2 * ROWS) + 1, F.lit(2 * ROWS)))).alias("band", "key"))
    shared = keys.groupBy("band", "key").agg(F.count("*").alias("n"), F.min("rep").alias("centre")).filter("n > 1")
    members = materialize(keys.join(shared, ["band", "key"]).filter("rep != centre").drop("n"), "buckets")

    reps = members.select(F.col("rep").alias("__rep")).union(members.select("centre")).distinct()
    owners = (classes.join(reps.withColumnRenamed("__rep", "rep"), "rep")
              .select(F.col("rep").alias("__id"), F.col("owner.id").alias("__owner"), F.col("owner.hash").alias("__hash")))
    texts = materialize(docs.select(F.col(id_col).alias("__owner"), text_hash(text_col).alias("__hash"),
                                    F.col(text_col).alias("__text"))
                        .join(owners, ["__owner", "__hash"]).select("__id", "__text").dropDuplicates(["__id"]),
                        "candidate-texts")

    def side(table: DataFrame, key: str, value: str, name: str) -> DataFrame:
        return table.select(F.col(key).alias(name), F.col(value).alias(f"{value.strip('_')}_{name}"))

    def confirmed(pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) that are links by their full sets."""
        return _confirm(pairs.join(side(texts, "__id", "__text", "a"), "a")
                        .join(side(texts, "__id", "__text", "b"), "b"))

    def compared(pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) that are links; neighbouring rows share b."""
        signed = pairs.join(side(classes, "rep", "sig", "a"), "a").join(side(classes, "rep", "sig", "b"), "b")
        return confirmed(_agree(signed))

    stars = materialize(members.select(F.col("rep").alias("a"), F.col("centre").alias("b")).distinct(), "stars")
    links = materialize(compared(stars), "links")
    comps = connected_components(links)

    # centres have met all others; what is left of the buckets not in one component
    of = (members.drop("centre").join(comps.select(F.col("node").alias("rep"), "component"), "rep", "left")
          .withColumn("comp", F.coalesce("component", "rep")).drop("component"))
    size = (of.groupBy("band", "key").agg(
        F.count("*").alias("n"), F.sum("shingles").alias("m"), F.min("comp").alias("c0"), F.max("comp").alias("c1"))
        .filter("c0 < c1").select("band", "key", "n", F.ceil(F.greatest(
            F.col("n") / BLOCK_ROWS, F.col("m") / BLOCK_SHINGLES)).cast("int").alias("blocks")))
    of = materialize(of.join(size, ["band", "key"]), "open-buckets")
    small = of.filter(F.col("n") <= PAIR_ROWS)
    pairs = (small.select("band", "key", F.col("rep").alias("a"), F.col("comp").alias("ca"))
             .join(small.select("band", "key", F.col("rep").alias("b"), F.col("comp").alias("cb")), ["band", "key"])
             .filter("a > b AND ca != cb").select("a", "b").distinct()
             .join(stars, ["a", "b"], "left_anti"))
    large = (of.filter(F.col("n") > PAIR_ROWS).withColumn("own", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .withColumn("lo", F.least("own", "other")).withColumn("hi", F.greatest("own", "other"))
             .withColumn("side", (F.col("own") > F.col("lo")).cast("int"))
             .join(texts.select(F.col("__id").alias("rep"), F.col("__text").alias("text")), "rep")
             .repartition("band", "key", "lo", "hi").sortWithinPartitions("band", "key", "lo", "hi"))
    links = materialize(links.union(compared(pairs)).union(confirmed(_blocked(large).distinct())), "links")
    comps = connected_components(links)

    return (sketches.join(classes.select("seq", "rep"), "seq", "left")
            .join(comps.withColumnRenamed("node", "rep"), "rep", "left")
            .select(id_col, "hash", "n_shingles", F.when(
                (F.col("n_shingles") > 0) & F.col(id_col).isNotNull(), F.coalesce("component", "rep")).alias("component")))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_shingles, component_id, kept."""
    rows = materialize(row_components(docs, id_col, text_col).withColumnRenamed(id_col, "id"), "row-components")
    some = rows.filter(F.col("component").isNotNull())
    # components that meet in a document with several texts are one
    spread = some.groupBy("id").agg(F.min("component").alias("least"), F.max("component").alias("most")).filter(
        "least < most")
    met = connected_components(some.join(spread, "id").select("component", "least"), "component", "least")
    number = (some.join(met.select(F.col("node").alias("component"), F.col("component").alias("whole")), "component", "left")
              .select("id", "component", F.coalesce("whole", "component").alias("whole")))
    least = number.groupBy("whole").agg(F.min("id").alias("component_id"))
    of = number.select("component", "whole").distinct().join(least, "whole").select("component", "component_id")
    return (rows.join(of, "component", "left")
            .select(F.col("id").alias(id_col), "n_shingles",
                    F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id")).alias("component_id"))
            .withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(False))))
