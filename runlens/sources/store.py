"""Table store: date-partitioned Parquet tables and report files (I-11 ..
I-16, C-10).

Loads overwrite whole trading days (dynamic partition overwrite), so a re-run
of a day replaces it instead of duplicating it, and a failed load leaves the
previous state of that day in place.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import COMPANIES, PRICE_LIST, PRICES, RUN_PIECES, TRADES
from ..operators.ingest import split_bad
from ..session import scratch_path

TARGETS = {"trades": TRADES, "prices": PRICES, "price_list": PRICE_LIST, "companies": COMPANIES,
           "run_pieces": RUN_PIECES}


def _check_target(target: str) -> T.StructType:
    try:
        return TARGETS[target]
    except KeyError:
        # The reference silently writes nothing for an unknown table name.
        raise ValueError(f"unknown target table {target!r}; expected one of {sorted(TARGETS)}") from None


def conform(df: DataFrame, target: str) -> DataFrame:
    """Select and cast the target schema's columns, in order."""
    schema = _check_target(target)
    return df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in schema.fields])


def create_table(spark: SparkSession, path: str, target: str) -> bool:
    """I-10: an empty table of the target's schema, for later appends; a table that
    is there stays as it is.  Returns whether it was made."""
    schema = _check_target(target)
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return False
    out = spark.createDataFrame([], schema).write
    (out.partitionBy("date") if "date" in schema.fieldNames() else out).parquet(path)
    return True


# Rows per written file: keeps files near a few hundred MB at trade-row widths.
MAX_RECORDS_PER_FILE = 5_000_000


def load_days(df: DataFrame, path: str, target: str = "trades") -> None:
    """I-11 / I-13: write rows partitioned by ``date``; the days present in
    ``df`` are replaced, other days are kept.  Rows are rebalanced by date, so a
    day has few files and a hot day several writers; each task sorts its rows by
    (symbol, id), which gives tight Parquet min/max statistics."""
    out = conform(df, target).hint("rebalance", "date")
    if target == "trades":
        out = out.sortWithinPartitions("date", "stock_symbol", "id")
    (out.write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic")
     .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
     .partitionBy("date").parquet(path))


# What a later load replaces: the rows of the same landed page, or the same
# security of a day.
REPLACED = {"trades": ["date", "id div 100000"], "prices": ["date", "stock_name"],
            "price_list": ["date", "stock_name"]}


def append_days(df: DataFrame, path: str, target: str = "trades") -> None:
    """I-11 / I-13: append.  Pages of a day may land in several loads: what the
    table holds of the days in ``df`` stays, but for the pages (trades) or
    securities (prices) that ``df`` brings again."""
    spark = df.sparkSession

    def staged(rows: DataFrame, name: str) -> DataFrame:
        at = scratch_path(spark, name)
        conform(rows, target).write.parquet(at)
        return spark.read.schema(_check_target(target)).parquet(at)

    new = staged(df, "append-new")
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return load_days(new, path, target)
    keys = [F.expr(k).alias(f"_k{i}") for i, k in enumerate(REPLACED[target])]
    names = [f"_k{i}" for i in range(len(keys))]
    old = read_table(spark, path, target).join(new.select("date").distinct(), "date", "left_semi")
    kept = old.select("*", *keys).join(new.select(*keys).distinct(), names, "left_anti").drop(*names)
    load_days(staged(new.unionByName(kept.select(*new.columns)), "append-all"), path, target)


def load_folder(path: str) -> str:
    """Name of a folder of its own, below ``path``, for what one load leaves."""
    return f"{path.rstrip('/')}/load={time.strftime('%Y%m%dT%H%M%S')}-{uuid.uuid4().hex[:8]}"


def keep_parsed(parsed: DataFrame, path: str) -> tuple[DataFrame, DataFrame]:
    """I-8: writes parsed rows once, into a folder of this load below ``path`` (parts
    ``bad=true`` and ``bad=false``), and returns (good, quarantined) rows read from it.
    What earlier loads left there stays."""
    spark = parsed.sparkSession
    load = load_folder(path)
    parsed.write.partitionBy("bad").parquet(load)
    stored = spark.read.schema(parsed.schema).parquet(load).select(*parsed.columns)
    return split_bad(stored)


def read_quarantine(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Quarantined rows of all loads, with the column ``load``."""
    full = T.StructType([*schema.fields, T.StructField("load", T.StringType())])
    return spark.read.schema(full).parquet(path).filter("bad").drop("bad")


def append_companies(df: DataFrame, path: str) -> None:
    """I-14: append listings (page_no, pos, stock_name, stock_symbol, sector) in
    arrival order: their ids follow the table's largest by page and place, so the
    first listing of a name stays the oldest.  The table must exist."""
    spark = df.sparkSession
    last = read_table(spark, path, "companies").agg(F.coalesce(F.max("id"), F.lit(0))).first()[0]
    place = F.col("page_no").cast("bigint") * F.lit(100_000) + F.col("pos") + F.lit(1)
    conform(df.withColumn("id", F.lit(last) + place), "companies").write.mode("append").parquet(path)


def refresh(df: DataFrame, path: str, target: str = "companies") -> None:
    """I-15: replace the whole table (truncate and reload), dated tables by date."""
    out = conform(df, target).write.mode("overwrite").option("partitionOverwriteMode", "static")
    (out.partitionBy("date") if "date" in _check_target(target).fieldNames() else out).parquet(path)


def read_table(spark: SparkSession, path: str, target: str) -> DataFrame:
    """The rows of a table: the live folders of a published one, else all of ``path``."""
    from .publish import is_published, read_published   # built on this module
    _check_target(target)
    return (read_published if is_published(spark, path) else read_plain)(spark, path, target)


def read_plain(spark: SparkSession, path: str, target: str) -> DataFrame:
    schema = _check_target(target)
    return spark.read.schema(schema).parquet(path).select(*schema.fieldNames())


def delete_day(spark: SparkSession, path: str, date: str) -> bool:
    """I-16: drop one trading day of a date-partitioned table (its partition
    folder).  Returns whether the day existed."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    part = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/date={date}")
    fs = part.getFileSystem(conf)
    if not fs.exists(part):
        return False
    return bool(fs.delete(part, True))


def write_report(df: DataFrame, path: str, period: str, fmt: str = "csv") -> None:
    """C-10: one report per period, CSV with a header or Parquet (``period=<start>_<end>``
    folder) or a workbook (``<start>_<end>.xlsx``, rows by symbol and place where the report
    has them, else by its columns); re-writing a period replaces it."""
    from .workbook import write_workbooks
    dated = df.withColumn("period", F.lit(period))
    if fmt == "xlsx":
        places = [c for c in ("stock_symbol", "pos") if c in df.columns] if "pos" in df.columns else df.columns
        return write_workbooks(dated, path, [F.col(c).asc_nulls_last() for c in places])
    w = dated.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("period")
    if fmt == "csv":
        w.option("header", True).csv(path)
    elif fmt == "parquet":
        w.parquet(path)
    else:
        raise ValueError(f"unsupported report format {fmt!r}")


def read_report(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "csv") -> DataFrame:
    if fmt == "xlsx":
        from .workbook import read_workbooks
        return read_workbooks(spark, path, schema)
    full = T.StructType(list(schema.fields) + [T.StructField("period", T.StringType(), True)])
    if fmt == "csv":
        return spark.read.schema(full).option("header", True).csv(path)
    return spark.read.schema(full).parquet(path)
