"""Exchange snapshot source (I-9): JSON records with a fixed schema.

Accepts JSON lines (one object per line, splittable) or, with
``multiline=True``, files holding one JSON array of objects.  ``drifting_snapshot`` also keeps what the
fixed schema has no place for.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import SNAPSHOT

_RAW = "_malformed"


def _read(spark: SparkSession, path: str, multiline: bool, schema: T.StructType, mode: str) -> DataFrame:
    return (spark.read.schema(schema).option("multiLine", str(bool(multiline)).lower())
            .option("mode", mode).option("columnNameOfCorruptRecord", _RAW).json(path))


def read_snapshot(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """All records; a malformed one fails the read (see ``snapshot_parts``)."""
    return _read(spark, path, multiline, SNAPSHOT, "FAILFAST")


def snapshot_parts(spark: SparkSession, path: str, multiline: bool = False) -> tuple[DataFrame, DataFrame]:
    """(records, texts of malformed ones as ``value``): nothing is lost and no
    record comes back with NULLs for what could not be read."""
    schema = T.StructType([*SNAPSHOT.fields, T.StructField(_RAW, T.StringType(), True)])
    rows = _read(spark, path, multiline, schema, "PERMISSIVE")
    # The whole schema stays read beside the raw text: a read of that column alone is refused.
    bad = rows.select(F.when(F.col("id").isNull() | F.col("id").isNotNull(), F.col(_RAW)).alias("value"))
    return rows.filter(F.col(_RAW).isNull()).drop(_RAW), bad.filter(F.col("value").isNotNull())


def drifting_snapshot(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """All records with the column ``extra`` (map<string, variant>): keys that the schema
    does not name, and named ones whose value does not fit their type (NULL in their own
    column).  ``variant_get(extra['key'], '$', 'type')`` reads them.  A malformed record
    fails the read, as in ``read_snapshot``."""
    whole = (spark.read.option("singleVariantColumn", "_v").option("multiLine", str(bool(multiline)).lower())
             .option("mode", "FAILFAST").json(path))
    if multiline:   # a file is one array, or one object
        items = F.expr("coalesce(try_cast(_v AS array<variant>), array(_v))")
        whole = whole.select(F.explode(items).alias("_v"))
    read = [F.try_variant_get("_v", f"$.{f.name}", f.dataType.simpleString()).alias(f.name) for f in SNAPSHOT.fields]
    rows = whole.select(*read, F.expr("try_cast(_v AS map<string, variant>)").alias("_all"))
    unread = F.array_compact(F.array(*[F.when(F.col(f.name).isNull(), F.lit(f.name)) for f in SNAPSHOT.fields]))
    named = F.array(*[F.lit(f.name) for f in SNAPSHOT.fields])
    kept = F.map_filter("_all", lambda k, v: ~F.array_contains(named, k) | (
        F.array_contains(unread, k) & v.isNotNull() & ~F.is_variant_null(v)))
    return rows.select(*[f.name for f in SNAPSHOT.fields], kept.alias("extra"))


def write_snapshot_lines(lines: DataFrame, path: str) -> str:
    """Write a one-column ``value`` DataFrame of JSON objects as text files."""
    lines.select("value").write.mode("overwrite").text(path)
    return path
