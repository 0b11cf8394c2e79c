"""Near-duplicate embeddings by randomised-rotation binary codes.

Vectors are linked when their cosine, in double precision, is at least 0.9.

1. Identical vectors form a class; one representative goes on with its count.
2. A representative is rotated by a fixed random orthonormal map into
   ``CODE_BITS`` dimensions.  Its code is the signs, its stored correction factor
   the inner product of the vector with its own code.  ``<code, query> / factor``
   is an unbiased estimate of the inner product, and the factor also gives the
   width of its confidence interval.
3. Candidates meet in hash tables keyed by some bits of the code.  The number of
   bits grows with the logarithm of the number of vectors, so buckets keep their
   size.  All tables draw from the same bits of a pair, so the number of tables
   follows from the distribution of the bits in which a pair exactly at the
   threshold differs (closer pairs are missed less).
4. A table row is an id and a code, no vector.  A bucket of any size is dealt as
   pairs of sub-blocks.  In a pair of blocks the differing bits, an unbiased
   estimate of the angle, leave the pairs whose lower bound of the angle allows a
   link, each in the first table where its keys agree.
5. Only vectors with such a pair are fetched, by block pair.  There the estimates
   of all pairs are one matrix product; those whose upper confidence bound reaches
   the threshold are recomputed exactly, so no link is below it.
6. Links are counted without listing them; each block pair also sends a spanning
   forest of its links, and components follow by star rounds.

Defined results: NULL, zero and non-finite vectors, vectors with NULL components,
and rows with a NULL id link with nothing (component their own id).  Vectors of
different lengths are never linked.  Rows that repeat an id count as copies.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_materialized, materialize
from .components import connected_components

THRESHOLD = 0.9
CODE_BITS = 256
#: Width of the confidence interval, in the unit of the bound's deviation.
WIDTH = 4.0
#: Recall asked of the tables for a pair exactly at the threshold.
RECALL = 0.98
#: Vectors that a bucket is meant to hold, and the rows of a sub-block.
BUCKET_ROWS = 64
BLOCK_ROWS = 1024
#: Bytes of vectors gathered at once for exact cosines.
EXACT_BYTES = 32 << 20
SEED = 20240110


@lru_cache(maxsize=4)
def rotation(dim: int) -> np.ndarray:
    """(max(CODE_BITS, dim), dim) with orthonormal columns."""
    rng = np.random.default_rng(SEED + dim)
    return np.linalg.qr(rng.standard_normal((max(CODE_BITS, dim), dim)))[0]


def missed(bits: int, tables: int) -> float:
    """Probability that a pair exactly at the threshold meets in no table: the mean,
    over the number of bits in which its codes differ, of missing every table."""
    turn = math.acos(THRESHOLD) / math.pi
    out = 0.0
    for differ in range(CODE_BITS - bits + 1):
        weight = (math.lgamma(CODE_BITS + 1) - math.lgamma(differ + 1) - math.lgamma(CODE_BITS - differ + 1)
                  + differ * math.log(turn) + (CODE_BITS - differ) * math.log1p(-turn))
        meet = math.comb(CODE_BITS - differ, bits) / math.comb(CODE_BITS, bits)
        out += math.exp(weight) * (1 - meet) ** tables
    return out


def tables_for(n: int) -> tuple[int, int]:
    """(bits of a key, tables) for ``n`` vectors."""
    bits = max(8, math.ceil(math.log2(max(n, 1) / BUCKET_ROWS)))
    low, high = 0, 1
    while missed(bits, high) > 1 - RECALL:
        low, high = high, 2 * high
    while high - low > 1:
        middle = (low + high) // 2
        low, high = (middle, high) if missed(bits, middle) > 1 - RECALL else (low, middle)
    return bits, high


@lru_cache(maxsize=4)
def key_bits(width: int, bits: int, tables: int) -> np.ndarray:
    """(tables, bits) places of the code: every table draws without repeats."""
    rng = np.random.default_rng(SEED + 1)
    return np.stack([rng.permutation(width)[:bits] for _ in range(tables)])


def table_keys(code: np.ndarray, bits: int, tables: int) -> np.ndarray:
    """(rows, tables) integer keys of boolean codes."""
    places = key_bits(code.shape[1], bits, tables)
    return (code[:, places].astype(np.int64) << np.arange(bits)).sum(axis=2)


def encode_vectors(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Boolean codes and correction factors of double rows."""
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    turned = unit @ rotation(vectors.shape[1]).T
    return turned > 0, np.abs(turned).sum(axis=1) / math.sqrt(turned.shape[1])


def links_between(va: np.ndarray, ca: np.ndarray, fa: np.ndarray, vb: np.ndarray) -> np.ndarray:
    """Boolean matrix of links: estimates of <code_a, b>, exact where in doubt."""
    width = ca.shape[1]
    unit = vb / np.linalg.norm(vb, axis=1, keepdims=True)
    turned = (unit @ rotation(vb.shape[1]).T).astype(np.float32)
    signs = np.where(ca, 1.0, -1.0).astype(np.float32) / math.sqrt(width)
    estimate = (signs @ turned.T) / fa[:, None]
    slack = WIDTH * np.sqrt(np.maximum(0, 1 - fa ** 2)) / fa / math.sqrt(width - 1)
    i, j = np.nonzero(estimate + slack[:, None] >= THRESHOLD)
    out = np.zeros((len(va), len(vb)), bool)
    step = max(1, EXACT_BYTES // (8 * va.shape[1]))
    for lo in range(0, len(i), step):
        p, q = i[lo:lo + step], j[lo:lo + step]
        dot = np.einsum("ij,ij->i", va[p], vb[q])
        norm = np.linalg.norm(va[p], axis=1) * np.linalg.norm(vb[q], axis=1)
        ok = dot / norm >= THRESHOLD
        out[p[ok], q[ok]] = True
    return out


def most_differing(width: int) -> float:
    """Bits in which the codes of a link may differ, at the confidence bound."""
    turn = math.acos(THRESHOLD) / math.pi
    return width * turn + WIDTH * math.sqrt(width * turn * (1 - turn))


def first_pairs(table: int, sides: np.ndarray, codes: np.ndarray, bits: int, tables: int):
    """(p, q) rows of one block pair whose codes allow a link and whose keys agree in
    no table before this one; each pair once.  Without rows of side 1 the block is
    paired with itself."""
    signs = np.where(codes, 1, -1).astype(np.float32)
    a, b = np.flatnonzero(sides == 0), np.flatnonzero(sides == 1)
    inner = len(b) == 0
    other = a if inner else b
    differ = (codes.shape[1] - signs[a] @ signs[other].T) / 2
    near = differ <= most_differing(codes.shape[1])
    if inner:
        near = np.triu(near, 1)
    p, q = np.nonzero(near)
    p, q = a[p], other[q]
    keys = table_keys(codes, bits, tables)
    for earlier in range(table):
        if not len(p):
            break
        fresh = keys[p, earlier] != keys[q, earlier]
        p, q = p[fresh], q[fresh]
    return p, q


def _forest(linked: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Smallest id of each row's component under a symmetric link matrix."""
    label = ids.copy()
    while True:
        best = np.where(linked, label[None, :], np.iinfo(np.int64).max).min(axis=1)
        new = np.minimum(label, best)
        if (new == label).all():
            return label
        label = new


def compare_block(table: int, ids, sides, counts, vectors, codes, factors, bits: int, tables: int):
    """(row, its links first met in this table, smallest id of its component here)
    for the linked rows of one block pair."""
    p, q = first_pairs(table, sides, codes, bits, tables)
    rows, cols = np.unique(p), np.unique(q)
    linked = np.zeros((len(ids), len(ids)), bool)
    if len(p):
        part = links_between(vectors[rows], codes[rows], factors[rows], vectors[cols])
        ok = part[np.searchsorted(rows, p), np.searchsorted(cols, q)]
        p, q = p[ok], q[ok]
        linked[p, q] = linked[q, p] = True
    some = np.flatnonzero(linked.any(axis=1))
    if not len(some):
        return some, some, some
    n = np.zeros(len(ids), np.int64)
    np.add.at(n, p, counts[q])
    np.add.at(n, q, counts[p])
    return some, n[some], _forest(linked[np.ix_(some, some)], ids[some])


def _block_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, list]]:
    """((t, key, lo, hi), the other columns) of one block pair at a time."""
    held: list = []
    current = None
    for batch in batches:
        for t, key, lo, hi, *rest in zip(*[c.to_pylist() for c in batch.columns]):
            if (t, key, lo, hi) != current:
                if len(held) > 1:
                    yield current, list(zip(*held))
                held, current = [], (t, key, lo, hi)
            held.append(rest)
    if len(held) > 1:
        yield current, list(zip(*held))


def _unpack(codes, width: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(b"".join(codes), np.uint8).reshape(len(codes), -1), axis=1,
                         count=width).astype(bool)


def near_duplicate_vectors(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """One row per input row: id, n_links, component_id, kept."""
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digest, vec = [], []
            for doc, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                v = None if doc is None or x is None or not x or any(e is None for e in x) else np.array(x, "<f8")
                if v is None or not np.isfinite(v).all() or not v.any():
                    digest.append(None)
                    vec.append(None)
                else:
                    v = v / np.abs(v).max() if np.abs(v).max() > 1e100 or np.abs(v).max() < 1e-100 else v
                    digest.append(hashlib.blake2b(v.tobytes(), digest_size=16).digest())
                    vec.append(v.tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(digest, pa.binary()),
                                              pa.array(vec, pa.binary())], ["id", "digest", "vec"])

    def to_codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vecs = batch.column("vec").to_pylist()
            codes, factors = [b""] * len(vecs), [0.0] * len(vecs)
            for dim in {len(v) for v in vecs}:
                at = [i for i, v in enumerate(vecs) if len(v) == dim]
                code, factor = encode_vectors(np.frombuffer(b"".join(vecs[i] for i in at), "<f8").reshape(len(at), -1))
                for i, packed, f in zip(at, np.packbits(code, axis=1), factor.tolist()):
                    codes[i], factors[i] = packed.tobytes(), f
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(codes, pa.binary()), pa.array(factors)],
                                             [*batch.schema.names, "code", "factor"])

    rows = materialize(vectors.select(F.col(id_col).cast("bigint"), F.col(vec_col)).mapInArrow(
        encode, "id bigint, digest binary, vec binary"), "vectors")
    # The class number is written with the row, so it stays the same when a task is run again.
    classes = materialize(rows.filter(F.col("digest").isNotNull()).groupBy("digest").agg(
        F.min("id").alias("rep"), F.count("*").alias("n"), F.first("vec").alias("vec"))
        .withColumn("cid", F.monotonically_increasing_id()).mapInArrow(
            to_codes, "digest binary, rep bigint, n bigint, vec binary, cid bigint, code binary, factor double"),
        "vector-codes")
    bits, tables = tables_for(classes.count())

    def to_tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("size").to_numpy()
            for dim in np.unique(sizes):
                part = batch.filter(pa.array(sizes == dim))
                keys = table_keys(_unpack(part.column("code").to_pylist(), max(CODE_BITS, int(dim))), bits, tables)
                for t in range(tables):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([t] * part.num_rows, pa.int32()), pa.array(keys[:, t] * 65536 + dim, pa.int64()),
                         *part.columns], ["t", "key", *part.schema.names])

    coded = classes.select("cid", (F.octet_length("vec") / 8).cast("int").alias("size"), "code")
    placed = coded.mapInArrow(to_tables, "t int, key bigint, cid bigint, size int, code binary")
    # Only buckets beyond one block: fewer than a row per BLOCK_ROWS table rows.
    large = materialize(placed.groupBy("t", "key").agg(F.count("*").alias("m")).filter(F.col("m") > BLOCK_ROWS)
                        .select("t", "key", F.ceil(F.col("m") / BLOCK_ROWS).cast("int").alias("blocks")), "vector-large")
    own = F.pmod(F.xxhash64("cid"), F.coalesce("blocks", F.lit(1))).cast("int")
    dealt = (placed.join(large, ["t", "key"], "left").withColumn("own", own)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1)))
             .withColumn("lo", F.least("own", "other")).withColumn("hi", F.greatest("own", "other"))
             .withColumn("side", (F.col("own") > F.col("lo")).cast("int"))
             .select("t", "key", "lo", "hi", "side", "cid", "size", "code")
             .repartition("t", "key", "lo", "hi").sortWithinPartitions("t", "key", "lo", "hi"))

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (t, key, lo, hi), (side, cid, size, code) in _block_pairs(batches):
            if lo < hi and len(set(side)) < 2:   # one block of a pair of two is empty
                continue
            p, q = first_pairs(t, np.array(side), _unpack(code, max(CODE_BITS, size[0])), bits, tables)
            at = np.union1d(p, q).tolist()
            if at:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([t] * len(at), pa.int32()), pa.array([key] * len(at), pa.int64()),
                     pa.array([lo] * len(at), pa.int32()), pa.array([hi] * len(at), pa.int32()),
                     pa.array([side[i] for i in at], pa.int32()), pa.array([cid[i] for i in at], pa.int64())],
                    ["t", "key", "lo", "hi", "side", "cid"])

    hits = materialize(dealt.mapInArrow(candidates, "t int, key bigint, lo int, hi int, side int, cid bigint"),
                       "vector-candidates")
    fetched = (hits.join(classes.select("cid", "rep", "n", "vec", "code", "factor"), "cid")
               .select("t", "key", "lo", "hi", "side", "cid", "rep", "n", "vec", "code", "factor")
               .repartition("t", "key", "lo", "hi").sortWithinPartitions("t", "key", "lo", "hi"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (t, *_), (side, cid, rep, n, vec, code, factor) in _block_pairs(batches):
            v = np.frombuffer(b"".join(vec), "<f8").reshape(len(vec), -1)
            at, links, to = compare_block(t, np.array(rep), np.array(side), np.array(n), v,
                                          _unpack(code, max(CODE_BITS, v.shape[1])), np.array(factor), bits, tables)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.array(cid)[at], pa.int64()), pa.array(np.array(rep)[at], pa.int64()),
                 pa.array(links, pa.int64()), pa.array(to, pa.int64())], ["cid", "node", "links", "to"])

    found = materialize(fetched.mapInArrow(compare, "cid bigint, node bigint, links bigint, to bigint"), "vector-links")
    drop_materialized(hits)
    drop_materialized(large)
    comps = connected_components(found, "node", "to")
    links = found.groupBy("cid").agg(F.sum("links").alias("links"))
    per_class = (classes.select("digest", "cid", "rep", "n").join(links, "cid", "left")
                 .join(comps.withColumnRenamed("node", "rep"), "rep", "left")
                 .select("digest", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
                         F.coalesce("component", "rep").alias("component")))
    out = rows.select(F.col("id").alias(id_col), "digest").join(per_class, "digest", "left")
    comp = F.coalesce("component", id_col)
    return out.select(id_col, F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
                      comp.alias("component_id"), F.coalesce(F.col(id_col) == comp, F.lit(False)).alias("kept"))
