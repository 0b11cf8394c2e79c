"""Token ids as grammar-compressed shard files with random access.

1. Texts become ids, with the end id behind each document, in pieces of at most
   ``PIECE_IDS`` ids (one pass, written to the shared folder).
2. Pieces are dealt by ranges of (document id, checksum, row, piece), so rows that
   share an id, or have none, spread over as many ranges as they need.
3. Each range is cut into shards of about ``SHARD_IDS`` ids.  A shard is one record of
   the output files: its number, the documents' index and the ids as a Re-Pair grammar
   (``repair``).  A long document stands in several shards, so a task holds one shard.
4. Reading back numbers the ids: totals per range are summed in order (one row per
   ``RANGE_IDS`` ids), then within each range by shard, then by place in the shard.

Documents stand in ascending order of their id, NULL ids first; rows that share an id
in the order of the checksum of their ids, equal ones in any order.

Defined results: NULL and empty texts hold the end id only; repeated rows are written
as often as they occur; an empty table gives no records; only the id and text columns
are read, so others never clash; very long texts are encoded in parts and written
in pieces.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from . import repair
from .byte_bpe import byte_bpe
from .common import drop_materialized, materialize, text_list

END_ID = 2
#: Ids of a piece: longer documents are written in several.
PIECE_IDS = 1 << 18
#: A shard is closed when it holds so many ids.
SHARD_IDS = 1 << 20
#: Ids of a range, which one task writes.
RANGE_IDS = 1 << 22

INDEX = "ids array<{0}>, lengths array<int>, before array<bigint>, pieces array<int>"
RECORD = "range int, shard int, n_ids bigint, " + INDEX + ", grammar binary"
PIECE = "id {0}, crc bigint, piece int, pieces int, before bigint, n int, width int, tokens binary"
READ = "range int, shard int, doc_id {0}, at bigint, n_tokens bigint, before bigint, pieces int, ids_crc32 bigint"


def token_pieces(docs: DataFrame, vocab_path: str, end_id: int = END_ID, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """Pieces of ids: id, crc (of the whole document's ids), piece, pieces, before
    (ids of the document before the piece), n (its ids), width (bytes an id: two where
    the vocabulary allows it), tokens (little-endian)."""
    names = ["id", "crc", "piece", "pieces", "before", "n", "width", "tokens"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(vocab_path)
        width = 2 if max(bpe.largest, end_id) < 1 << 16 else 4
        for batch in batches:
            rows, cols = [], ([], [], [], [], [], [])
            for r, text in enumerate(text_list(batch.column(1))):
                ids = bpe.array(text, end_id)
                crc, pieces = zlib.crc32(ids), -(-len(ids) // PIECE_IDS)
                for k in range(pieces):
                    rows.append(r)
                    part = ids[k * PIECE_IDS:(k + 1) * PIECE_IDS]
                    tokens = part.astype(f"<u{width}").tobytes()
                    for col, v in zip(cols, (crc, k, pieces, k * PIECE_IDS, len(part), tokens)):
                        col.append(v)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(cols[0], pa.int64()),
                 pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.int32()), pa.array(cols[3], pa.int64()),
                 pa.array(cols[4], pa.int32()), pa.repeat(pa.scalar(width, pa.int32()), len(rows)),
                 pa.array(cols[5], pa.binary())], names)

    id_type = docs.schema[id_col].dataType.simpleString()
    # The number of a row is written with it: the same for all its pieces.
    return (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
            .mapInArrow(run, PIECE.format(id_type))
            .withColumn("row", F.monotonically_increasing_id() - F.col("piece")))


def write_shards(docs: DataFrame, vocab_path: str, path: str, end_id: int = END_ID, id_col: str = "doc_id",
                 text_col: str = "text", shard_ids: int = SHARD_IDS, range_ids: int = RANGE_IDS) -> None:
    """Writes the shard records of ``docs`` as Parquet files below ``path``."""
    pieces = materialize(token_pieces(docs, vocab_path, end_id, id_col, text_col), "token-pieces", "zstd")
    total = pieces.agg(F.sum("n").alias("n")).first()["n"] or 0
    order = ["id", "crc", "row", "piece"]
    ranges = max(1, -(-int(total) // range_ids))
    id_type = pieces.schema["id"].dataType
    record = RECORD.format(id_type.simpleString())

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, shard, held, size = TaskContext.get().partitionId(), 0, [], 0

        def close() -> pa.RecordBatch:
            table = pa.Table.from_batches(held).combine_chunks()
            lengths = table.column("n")
            ids = np.concatenate([np.frombuffer(x.as_py(), dtype=f"<u{w.as_py()}") for x, w in
                                  zip(table.column("tokens"), table.column("width"))])
            index = [pa.ListArray.from_arrays([0, len(lengths)], table.column(c).combine_chunks())
                     for c in ("id", "n", "before", "pieces")]
            return pa.RecordBatch.from_arrays(
                [pa.array([at], pa.int32()), pa.array([shard], pa.int32()), pa.array([len(ids)], pa.int64()), *index,
                 pa.array([repair.encode(ids)], pa.binary())],
                ["range", "shard", "n_ids", "ids", "lengths", "before", "pieces", "grammar"])

        for batch in batches:
            start = 0
            for k, n in enumerate(batch.column("n").to_pylist()):
                size += n
                if size >= shard_ids:
                    held.append(batch.slice(start, k + 1 - start))
                    yield close()
                    shard, held, size, start = shard + 1, [], 0, k + 1
            if start < batch.num_rows:
                held.append(batch.slice(start))
        if held:
            yield close()

    (pieces.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
     .select("id", "before", "pieces", "n", "width", "tokens").mapInArrow(write, record)
     .write.option("compression", "zstd").parquet(path))
    drop_materialized(pieces)


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def _starts(shards: DataFrame) -> DataFrame:
    """(range, shard, first): how many ids stand before each shard.  The window over
    the ranges sees one row per ``RANGE_IDS`` ids, the other one range at a time."""
    ahead = (Window.unboundedPreceding, -1)
    sizes = shards.select("range", "shard", "n_ids")
    ranges = sizes.groupBy("range").agg(F.sum("n_ids").alias("all"))
    ranges = ranges.select("range", F.coalesce(F.sum("all").over(Window.orderBy("range").rowsBetween(*ahead)), F.lit(0))
                           .alias("base"))
    inside = F.sum("n_ids").over(Window.partitionBy("range").orderBy("shard").rowsBetween(*ahead))
    return (sizes.select("range", "shard", F.coalesce(inside, F.lit(0)).alias("inside")).join(ranges, "range")
            .select("range", "shard", (F.col("base") + F.col("inside")).alias("first")))


def read_documents(shards: DataFrame) -> DataFrame:
    """One row per document of the shard records, from their decoded ids: doc_id,
    start, n_tokens, ids_crc32."""
    id_type = shards.schema["ids"].dataType.elementType.simpleString()

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                ids = repair.Encoded(batch.column("grammar")[r].as_py()).ids().astype("<u4")
                lengths = np.asarray(batch.column("lengths")[r].values, dtype=np.int64)
                ends = np.cumsum(lengths)
                crc = [zlib.crc32(ids[a:b]) for a, b in zip(ends - lengths, ends)]
                n = len(lengths)
                yield pa.RecordBatch.from_arrays(
                    [pa.repeat(batch.column("range")[r], n), pa.repeat(batch.column("shard")[r], n),
                     batch.column("ids")[r].values, pa.array(ends - lengths), pa.array(lengths),
                     batch.column("before")[r].values, batch.column("pieces")[r].values, pa.array(crc, pa.int64())],
                    ["range", "shard", "doc_id", "at", "n_tokens", "before", "pieces", "ids_crc32"])

    def joined(pdf: pd.DataFrame) -> pd.DataFrame:
        """Checksum of a document from those of its pieces: appending to a sequence
        shifts its checksum by that of as many zero bytes."""
        pdf, crc = pdf.sort_values("before"), 0
        for own, n in zip(pdf["ids_crc32"], pdf["n_tokens"]):
            zeros = bytes(4 * int(n))
            crc = zlib.crc32(zeros, crc) ^ zlib.crc32(zeros) ^ int(own)
        first = pdf.iloc[:1]
        return first.assign(n_tokens=pdf["n_tokens"].sum(), ids_crc32=crc)

    firsts = _starts(shards)

    def placed(records: DataFrame) -> DataFrame:
        read = records.select("range", "shard", "ids", "lengths", "before", "pieces", "grammar").mapInArrow(
            decode, READ.format(id_type))
        return read.join(firsts, ["range", "shard"]).select(
            "doc_id", (F.col("first") + F.col("at") - F.col("before")).alias("start"), "n_tokens", "ids_crc32",
            "before", "pieces")

    # Records without a part of a long document are decoded once, the others twice.
    parts = placed(shards.filter(F.exists("pieces", lambda p: p > 1))).filter("pieces > 1")
    whole = placed(shards).filter("pieces = 1")
    columns = ["doc_id", "start", "n_tokens", "ids_crc32"]
    return whole.select(*columns).union(parts.groupBy("start").applyInPandas(joined, parts.schema).select(*columns))


def fetch_ids(shards: DataFrame, doc_ids: list) -> DataFrame:
    """(doc_id, before, tokens) of the named documents (a bounded list): only the
    records that hold one are read, and only their own ranges of ids are decoded."""
    id_type = shards.schema["ids"].dataType.elementType
    wanted = set(doc_ids)
    found = shards.filter(F.arrays_overlap("ids", F.array(*[F.lit(d).cast(id_type) for d in doc_ids])))

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                data = repair.Encoded(batch.column("grammar")[r].as_py())
                ids, before = batch.column("ids")[r].values, batch.column("before")[r].values
                ends = np.cumsum(np.asarray(batch.column("lengths")[r].values, dtype=np.int64))
                rows = [k for k, d in enumerate(ids.to_pylist()) if d in wanted]
                parts = [data.range(int(ends[k - 1]) if k else 0, int(ends[k])) for k in rows]
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(rows, pa.int64())), before.take(pa.array(rows, pa.int64())),
                     pa.array([p.tolist() for p in parts], pa.list_(pa.int64()))], ["doc_id", "before", "tokens"])

    return found.select("ids", "lengths", "before", "grammar").mapInArrow(
        fetch, f"doc_id {id_type.simpleString()}, before bigint, tokens array<bigint>")


def token_output(docs: DataFrame, vocab_path: str, end_id: int = END_ID, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """Writes ``docs`` as shard records into the shared folder and reads every
    document back."""
    spark = docs.sparkSession
    path = scratch_path(spark, "llm-token-shards")
    write_shards(docs, vocab_path, path, end_id, id_col, text_col)
    return read_documents(read_shards(spark, path)).withColumnRenamed("doc_id", id_col)
