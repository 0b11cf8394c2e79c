"""Best-fit packing of token sequences by a linear grouping scheme.

1. Documents become pieces of at most ``capacity`` tokens (only longer documents
   are cut; the first piece takes the remainder).
2. Lengths above ``capacity / SMALL_PART`` are large.  From the histogram of
   lengths (at most ``capacity`` rows, whatever the corpus) they are split into
   ``groups`` groups of about equal cardinality, and every length is rounded up to
   the largest of its group.
3. The configurations of the few rounded sizes are optimised: the covering linear
   program over all configurations by column generation (a knapsack finds the
   best new column), rounded down, the rest best-fit.  This needs the histogram
   alone, so the driver's work and memory do not grow with the corpus.
4. Actual pieces take the slots of their group: each gets its rank within the
   group (counted by hash blocks, so neither a hot length nor a group meets in one
   task) and the rank gives sequence and slot.
5. Small pieces are best-fit, longest first, into the room that substitution left,
   in cells of sequences and pieces dealt by hash; what fits nowhere opens
   sequences of its own.

Defined results: NULL counts as the empty text (one piece with the end id only);
repeated rows are packed as often as they occur; an empty table gives no rows; only
the id and text columns are read, so other columns never clash; very long texts are
encoded in parts and become as many pieces as they need.
"""

from __future__ import annotations

import heapq
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .byte_bpe import byte_bpe
from .common import materialize, text_list

CAPACITY = 1024
END_ID = 2
#: Rounded sizes of the linear grouping.
GROUPS = 200
#: Pieces up to capacity / SMALL_PART are placed last, by best fit.
SMALL_PART = 8
#: Pieces a hash block (for ranks) and sequences or small pieces a cell hold.
BLOCK_ROWS = 50_000
CELL_ROWS = 20_000
#: Column generation stops at this many columns (its basis is feasible at any time).
MAX_COLUMNS = 3000

PIECE = "piece int, start bigint, length bigint, ids_crc32 bigint"


def cut_pieces(docs: DataFrame, vocab_path: str, capacity: int = CAPACITY, end_id: int = END_ID,
               id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Piece rows: id, piece, start, length, ids_crc32.  One pass, no shuffle."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(vocab_path)
        for batch in batches:
            rows, cols = [], ([], [], [], [])
            for r, text in enumerate(text_list(batch.column(1))):
                ids = bpe.array(text, end_id)
                start, end = 0, (len(ids) - 1) % capacity + 1
                piece = 0
                while start < len(ids):
                    rows.append(r)
                    for col, v in zip(cols, (piece, start, end - start, zlib.crc32(ids[start:end].tobytes()))):
                        col.append(v)
                    piece, start, end = piece + 1, end, end + capacity
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(cols[0], pa.int32()),
                 *[pa.array(c, pa.int64()) for c in cols[1:]]],
                [id_col, "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, f"{id_col} {id_type}, {PIECE}")


# -- configurations, on the histogram


def linear_groups(counts: dict[int, int], groups: int) -> list[tuple[int, list[int]]]:
    """(rounded size, its lengths), longest first; a length is never split, so a
    group has its share of the pieces or one length."""
    share = max(1, -(-sum(counts.values()) // groups))
    out, taken = [], 0
    for length in sorted(counts, reverse=True):
        if not out or taken >= share:
            out.append((length, []))
            taken = 0
        out[-1][1].append(length)
        taken += counts[length]
    return out


def _best_column(sizes: np.ndarray, value: np.ndarray, capacity: int) -> np.ndarray:
    """Unbounded knapsack: the multiset of sizes with the largest value."""
    best = np.zeros(capacity + 1)
    pick = np.full(capacity + 1, -1)
    order = np.argsort(sizes, kind="stable")
    s, v = sizes[order], value[order]
    fits = np.searchsorted(s, np.arange(capacity + 1), side="right")
    for c in range(1, capacity + 1):
        best[c] = best[c - 1]
        if fits[c]:
            got = best[c - s[:fits[c]]] + v[:fits[c]]
            k = int(np.argmax(got))
            if got[k] > best[c] + 1e-12:
                best[c], pick[c] = got[k], k
    column = np.zeros(len(sizes))
    c = capacity
    while c > 0:
        if pick[c] < 0:
            c -= 1
        else:
            column[order[pick[c]]] += 1
            c -= int(s[pick[c]])
    return column


def optimise(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Configurations with how often each is used; together they hold at least
    ``demand[g]`` slots of every size."""
    n = len(sizes)
    if n == 0:
        return []
    basis = np.diag((capacity // sizes).astype(float))
    inverse = np.diag(1 / np.diag(basis))
    use = demand / np.diag(basis)
    for _ in range(MAX_COLUMNS):
        column = _best_column(sizes, inverse.sum(axis=0), capacity)
        step = (inverse * column).sum(axis=1)
        if step.sum() <= 1 + 1e-6:   # its value at the dual prices: no better column
            break
        ratio = np.where(step > 1e-9, use / np.where(step > 1e-9, step, 1), np.inf)
        leave = int(np.argmin(ratio))
        use = np.maximum(use - ratio[leave] * step, 0)
        use[leave] = ratio[leave]
        basis[:, leave] = column
        row = inverse[leave] / step[leave]
        inverse -= step[:, None] * row
        inverse[leave] = row
    plans: dict[tuple[int, ...], int] = {}
    left = demand.astype(np.int64).copy()
    for p in range(n):
        column = basis[:, p].astype(np.int64)
        times = int(use[p] + 1e-6)
        if times > 0:
            key = tuple(column.tolist())
            plans[key] = plans.get(key, 0) + times
            left -= times * column
    bins: list[tuple[int, list[int]]] = []   # the rest, largest first, best fit
    for g in np.argsort(-sizes, kind="stable"):
        for _ in range(max(0, int(left[g]))):
            at = bisect_left(bins, (int(sizes[g]), []))
            room, slots = bins.pop(at) if at < len(bins) else (capacity, [])
            insort(bins, (room - int(sizes[g]), [*slots, int(g)]))
    for _, slots in bins:
        column = tuple(np.bincount(slots, minlength=n).tolist())
        plans[column] = plans.get(column, 0) + 1
    return sorted(plans.items(), reverse=True)


def slot_ranges(plans: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int, int]]:
    """(group, first rank, end rank, first sequence, slots of the group in one
    sequence, first slot): where the pieces of each rank go."""
    out, taken, sequence = [], {}, 0
    for column, times in plans:
        slot = 0
        for g, each in enumerate(column):
            if each:
                lo = taken.get(g, 0)
                taken[g] = lo + each * times
                out.append((g, lo, taken[g], sequence, each, slot))
                slot += each
        sequence += times
    return out


# -- placing the small pieces


def best_fit(rooms: list[tuple[int, int]], pieces: list[int], capacity: int) -> list[tuple[int, bool]]:
    """For each piece length, taken longest first, (sequence, is new): the
    tightest sequence that has room.  ``rooms``: (room, sequence)."""
    by_room: dict[int, list[int]] = {}
    for room, seq in sorted(rooms):
        by_room.setdefault(room, []).append(seq)
    for seqs in by_room.values():
        heapq.heapify(seqs)
    keys = sorted(by_room)
    out: list[tuple[int, bool]] = [(0, False)] * len(pieces)
    opened = 0
    is_new: set[int] = set()
    for i in sorted(range(len(pieces)), key=lambda i: (-pieces[i], i)):
        need = pieces[i]
        at = bisect_left(keys, need)
        if at < len(keys):
            room = keys[at]
            seq = heapq.heappop(by_room[room])
            if not by_room[room]:
                del by_room[room]
                keys.pop(at)
        else:
            opened += 1
            seq, room = -opened, capacity
            is_new.add(seq)
        out[i] = (seq, seq in is_new)
        if room > need:
            if room - need not in by_room:
                by_room[room - need] = []
                insort(keys, room - need)
            heapq.heappush(by_room[room - need], seq)
    return out


def pack(pieces: DataFrame, capacity: int = CAPACITY, groups: int = GROUPS, id_col: str = "doc_id") -> DataFrame:
    """Adds sequence_id and offset to the rows of ``cut_pieces``.  ``pieces`` is
    read several times: pass a written table."""
    spark = pieces.sparkSession
    key = [id_col, "piece", "start", "length", "ids_crc32"]
    pieces = pieces.select(*key)
    counts = {int(r["length"]): r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    small = capacity // SMALL_PART
    large_counts = {k: n for k, n in counts.items() if k > small}
    grouped = linear_groups(large_counts, groups)
    sizes = np.array([s for s, _ in grouped], dtype=np.int64)
    demand = np.array([sum(large_counts[k] for k in ks) for _, ks in grouped], dtype=np.int64)
    ranges = slot_ranges(optimise(sizes, demand, capacity))
    n_large, n_small = int(demand.sum()), sum(counts.values()) - int(demand.sum())
    blocks = max(1, -(-n_large // BLOCK_ROWS))
    cells = max(1, -(-max(n_large // 2, n_small) // CELL_ROWS))

    # group of a length, and slots by rank: both bounded by the capacity
    group_of = F.broadcast(spark.createDataFrame(
        [(k, g) for g, (_, ks) in enumerate(grouped) for k in ks], "length bigint, __g int"))
    slots = F.broadcast(spark.createDataFrame(
        ranges, "__g int, __lo bigint, __hi bigint, __seq bigint, __each bigint, __slot bigint"))

    spot = F.xxhash64(*key)
    large = (pieces.filter(F.col("length") > small).join(group_of, "length")
             .withColumn("__block", F.pmod(spot, F.lit(blocks))))
    before = (large.groupBy("__g", "__block").agg(F.count("*").alias("__n"))
              .withColumn("__before", F.sum("__n").over(
                  Window.partitionBy("__g").orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)))
              .select("__g", "__block", F.coalesce("__before", F.lit(0)).alias("__before")))
    inside = Window.partitionBy("__g", "__block").orderBy(*key)
    ranked = (large.withColumn("__rn", F.row_number().over(inside)).join(before, ["__g", "__block"])
              .withColumn("__rank", F.col("__before") + F.col("__rn") - 1))
    r = F.col("__rank") - F.col("__lo")
    placed = (ranked.join(slots, "__g")
              .filter((F.col("__rank") >= F.col("__lo")) & (F.col("__rank") < F.col("__hi")))
              .select(*key, (F.col("__seq") + F.floor(r / F.col("__each"))).alias("sequence_id"),
                      (F.col("__slot") + r % F.col("__each")).alias("__slot")))
    placed = materialize(placed, "packed-large")

    rooms = (placed.groupBy("sequence_id").agg((F.lit(capacity) - F.sum("length")).alias("length"))
             .filter(F.col("length") > 0)
             .withColumn("__cell", F.pmod(F.xxhash64("sequence_id"), F.lit(cells))))
    smalls = pieces.filter(F.col("length") <= small).withColumn("__cell", F.pmod(spot, F.lit(cells)))
    out_schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema.fields) + ", sequence_id bigint"

    def place(cell, rooms_pdf: pd.DataFrame, items: pd.DataFrame) -> pd.DataFrame:
        items = items.sort_values(["length", "start", "piece", "ids_crc32"], kind="stable").reset_index(drop=True)
        got = best_fit(list(zip(rooms_pdf["length"], rooms_pdf["sequence_id"])), items["length"].tolist(), capacity)
        # new sequences get negative numbers of their cell
        items["sequence_id"] = [seq - (int(cell[0]) << 32) if new else seq for seq, new in got]
        return items[[*key, "sequence_id"]]

    filled = smalls.groupBy("__cell")
    filled = rooms.groupBy("__cell").cogroup(filled).applyInPandas(place, out_schema)
    every = placed.unionByName(filled.withColumn("__slot", F.lit(capacity).cast("bigint")))
    order = Window.partitionBy("sequence_id").orderBy("__slot", *key).rowsBetween(Window.unboundedPreceding, -1)
    return every.select(*key, "sequence_id", F.coalesce(F.sum("length").over(order), F.lit(0)).alias("offset"))


def pack_documents(docs: DataFrame, vocab_path: str, capacity: int = CAPACITY, end_id: int = END_ID,
                   groups: int = GROUPS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Piece rows of ``docs`` with their sequence and offset."""
    pieces = materialize(cut_pieces(docs, vocab_path, capacity, end_id, id_col, text_col), "pieces")
    return pack(pieces, capacity, groups, id_col)
