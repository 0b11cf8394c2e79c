"""Structured Streaming load of landed trade pages.

The reference loads one trading day per run.  As a stream, saved pages land
as Parquet files in a folder; each micro-batch is parsed, given trade ids and
written to the date-partitioned trades table.  Every batch writes its own
``load_batch`` partition with dynamic overwrite, so a batch replayed after a
failure replaces exactly what it wrote before (idempotent sink); the
checkpoint in the shared folder records which files were consumed.
Bad rows go to a quarantine table the same way.  A batch is parsed once and held
while its two parts are written, each by few writers a day: files grow with the rows,
not with days times batches times tasks.  Pages without a landed date take the one they
show; of pages that land twice in a batch the newest file's counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.ingest import dated, one_landing, parse_trade_pages, split_bad, with_trade_ids
from ..schema import PAGES, TRADES
from ..sources.store import MAX_RECORDS_PER_FILE

ADAPTIVE = "spark.sql.adaptive.enabled"


def _write(rows: DataFrame, batch_id: int, path: str) -> None:
    """Rebalanced by date, so a batch leaves few files a day, and a hot day has several writers."""
    (rows.withColumn("load_batch", F.lit(int(batch_id))).hint("rebalance", "date")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
     .partitionBy("date", "load_batch").parquet(path))


def _batch_writer(table_path: str, quarantine_path: str):
    def write(batch: DataFrame, batch_id: int) -> None:
        conf = batch.sparkSession.conf   # the stream's own session, where it is off
        adaptive = conf.get(ADAPTIVE)
        conf.set(ADAPTIVE, "true")
        parsed = parse_trade_pages(one_landing(dated(batch))).persist()
        try:
            good, bad = split_bad(parsed)
            _write(with_trade_ids(good), batch_id, table_path)
            _write(bad, batch_id, quarantine_path)
        finally:
            parsed.unpersist()
            conf.set(ADAPTIVE, adaptive)
    return write


def start_page_stream(spark: SparkSession, landing_dir: str, table_path: str, quarantine_path: str,
                      checkpoint_dir: str, available_now: bool = True, max_files_per_trigger: int | None = None):
    """Start the stream; with ``available_now`` it processes what has landed
    and stops (use ``awaitTermination``)."""
    reader = spark.readStream.schema(PAGES)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    pages = reader.parquet(landing_dir).select("*", F.col("_metadata.file_modification_time").alias("landed"))
    writer = (pages.writeStream.foreachBatch(_batch_writer(table_path, quarantine_path))
              .option("checkpointLocation", checkpoint_dir))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()


def read_streamed_trades(spark: SparkSession, table_path: str) -> DataFrame:
    schema = T.StructType(list(TRADES.fields) + [T.StructField("load_batch", T.LongType(), True)])
    rows = spark.read.schema(schema).parquet(table_path).withColumn("_page", F.expr("id div 100000"))
    # a page that landed again in a later batch counts once, as it landed last
    last = rows.groupBy("_page").agg(F.max("load_batch").alias("load_batch"))
    return rows.join(last, ["_page", "load_batch"], "left_semi").select(*TRADES.fieldNames())
