"""Exact deduplication by Patricia tries of whole texts.

Texts are equal when they are identical without the characters 0x20 and
0x09-0x0D.  Of equal texts the row with the most code points stays, then the one
with the smallest id.

1. Each task inserts its normalised texts, as byte strings, into a compressed
   radix trie whose terminal nodes hold the best owner and a count: copies inside
   a task leave as one row.  When the trie outgrows its byte budget, its largest
   subtree is spilled downstream as partial rows.
2. The rows are dealt by (length, content hash) and read in that order; the trie
   of one such key is complete when the key changes, so it is emitted and freed.
   Different texts of one key are told apart by their bytes.
3. The owners go back to the documents by the digest of the normalised text.

Defined results: NULL counts as the empty text, and all empty texts are equal;
a NULL id loses ties; rows that repeat an id are rows of their own in the group
size, and of those only the longest is kept (rows equal in id, text and length are
kept alike); very long texts are inserted whole, and a text beyond the budget is
spilled at once; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import byte_list, sha_hex

BLANKS = " \t\n\x0b\x0c\r"
#: Bytes that a task's trie holds, nodes and labels, before a subtree is spilled.
TRIE_BYTES = 64 << 20
#: Bytes of a node besides its label: list, child table, owner, count.
NODE_BYTES = 400


class PatriciaTrie:
    """Compressed radix trie; a terminal holds (best owner, count)."""

    __slots__ = ("root", "size")

    def __init__(self):
        self.root = [b"", {}, None]   # label, children by first byte, terminal
        self.size = 0

    def insert(self, key: bytes, owner: tuple, count: int = 1) -> None:
        node, at = self.root, 0
        while True:
            if at == len(key):
                node[2] = (owner, count) if node[2] is None else (min(node[2][0], owner), node[2][1] + count)
                return
            child = node[1].get(key[at])
            if child is None:
                node[1][key[at]] = [key[at:], {}, (owner, count)]
                self.size += len(key) - at + NODE_BYTES
                return
            label = child[0]
            if key.startswith(label, at):
                node, at = child, at + len(label)
                continue
            shared = _common(label, key, at)   # split the edge
            middle = [label[:shared], {label[shared]: child}, None]
            child[0] = label[shared:]
            node[1][key[at]] = middle
            self.size += NODE_BYTES
            node, at = middle, at + shared

    @staticmethod
    def _walk(node: list, prefix: bytes) -> Iterator[tuple[bytes, tuple, int]]:
        stack = [(node, prefix)]
        while stack:
            (label, children, end), prefix = stack.pop()
            key = prefix + label
            if end is not None:
                yield key, *end
            stack.extend((c, key) for c in children.values())

    def spill(self) -> Iterator[tuple[bytes, tuple, int]]:
        """Takes out the heaviest subtree below the root."""
        def weight(node):
            total, stack = 0, [node]
            while stack:
                n = stack.pop()
                total += len(n[0]) + NODE_BYTES
                stack.extend(n[1].values())
            return total
        weights = {b: weight(c) for b, c in self.root[1].items()}
        heaviest = max(weights, key=weights.get)
        self.size -= weights[heaviest]
        yield from self._walk(self.root[1].pop(heaviest), b"")

    def drain(self) -> Iterator[tuple[bytes, tuple, int]]:
        yield from self._walk(self.root, b"")
        self.root, self.size = [b"", {}, None], 0


def _common(label: bytes, key: bytes, at: int) -> int:
    """Length of the common prefix of ``label`` and ``key[at:]``, by halving."""
    lo, hi = 0, min(len(label), len(key) - at)
    while lo < hi:
        mid = (lo + hi + 1) // 2
        if label[lo:mid] == key[at + lo:at + mid]:
            lo = mid
        else:
            hi = mid - 1
    return lo


def normalised(text: str | Column) -> Column:
    return F.translate(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")), BLANKS, "")


def text_digest(text: str) -> Column:
    return F.sha2(normalised(text).cast("binary"), 256)


def _owner(points: int, doc_id) -> tuple:
    """Sorts the row that stays first."""
    return (-points, doc_id is None, doc_id)


def owners(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           trie_bytes: int = TRIE_BYTES) -> DataFrame:
    """One row per distinct text: text_sha256, keep_id, keep_points (code points of
    the original text of the row that stays), group_size."""
    id_type = docs.schema[id_col].dataType.simpleString()
    arrow_id = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[id_type]

    def rows(found: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([len(k) for k, _, _ in found], pa.int64()),
             pa.array([_hash(k) for k, _, _ in found], pa.int64()),
             pa.array([k for k, _, _ in found], pa.binary()),
             pa.array([-o[0] for _, o, _ in found], pa.int64()),
             pa.array([o[2] for _, o, _ in found], arrow_id),
             pa.array([n for _, _, n in found], pa.int64())],
            ["len", "hash", "key", "points", "owner", "n"])

    def batched(found: Iterator) -> Iterator[pa.RecordBatch]:
        part, held = [], 0
        for item in found:
            part.append(item)
            held += len(item[0])
            if held >= 8 << 20 or len(part) >= 4096:
                yield rows(part)
                part, held = [], 0
        if part:
            yield rows(part)

    def insert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = PatriciaTrie()
        for batch in batches:
            for key, points, doc_id in zip(byte_list(batch.column(1)), batch.column(2).to_pylist(),
                                           batch.column(0).to_pylist()):
                trie.insert(key, _owner(points, doc_id))
            while trie.size > trie_bytes and trie.root[1]:
                yield from batched(trie.spill())
        yield from batched(trie.drain())

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, current = PatriciaTrie(), None
        for batch in batches:
            done = []
            for n, h, key, points, doc_id, count in zip(*[c.to_pylist() for c in batch.columns]):
                if (n, h) != current:
                    done.extend((sha_hex(k), o[2], -o[0], c) for k, o, c in trie.drain())
                    current = (n, h)
                trie.insert(key, _owner(points, doc_id), count)
            if done:
                yield owned(done)
        done = [(sha_hex(k), o[2], -o[0], c) for k, o, c in trie.drain()]
        if done:
            yield owned(done)

    def owned(done: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([d[0] for d in done], pa.string()), pa.array([d[1] for d in done], arrow_id),
             pa.array([d[2] for d in done], pa.int64()), pa.array([d[3] for d in done], pa.int64())],
            ["text_sha256", "keep_id", "keep_points", "group_size"])

    texts = docs.select(F.col(id_col), normalised(text_col).alias("__key"),
                        F.char_length(F.coalesce(F.col(text_col), F.lit(""))).alias("__points"))
    partial = texts.mapInArrow(
        insert, f"len bigint, hash bigint, key binary, points bigint, owner {id_type}, n bigint")
    dealt = partial.repartition("len", "hash").sortWithinPartitions("len", "hash")
    return dealt.mapInArrow(merge, f"text_sha256 string, keep_id {id_type}, keep_points bigint, group_size bigint")


def _hash(key: bytes) -> int:
    import xxhash
    h = xxhash.xxh64_intdigest(key)
    return h - (1 << 64) if h >> 63 else h


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256."""
    narrow = docs.select(F.col(id_col).alias("__id"), text_digest(text_col).alias("text_sha256"),
                         F.char_length(F.coalesce(F.col(text_col), F.lit(""))).alias("__points"))
    stays = F.col("__id").eqNullSafe(F.col("keep_id")) & (F.col("__points") == F.col("keep_points"))
    return narrow.join(owners(docs, id_col, text_col), "text_sha256").select(
        F.col("__id").alias(id_col), "keep_id", "group_size", stays.alias("kept"), "text_sha256")


def exact_dedup_sql(table: str = "documents") -> str:
    return rf"""
WITH a AS (SELECT doc_id, length(coalesce(text, '')) AS points,
                  sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) AS text_sha256 FROM {table}),
b AS (SELECT text_sha256, count(*) AS group_size, max(points) AS keep_points, arg_min(doc_id, (-points, doc_id)) AS keep_id
      FROM (SELECT text_sha256, doc_id, points FROM a) GROUP BY text_sha256)
SELECT a.doc_id, b.keep_id, b.group_size::BIGINT AS group_size, a.doc_id = b.keep_id AND a.points = b.keep_points AS kept, a.text_sha256
FROM a JOIN b USING (text_sha256)"""
