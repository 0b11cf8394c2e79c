"""Published tables: loads write beside the live data and are swapped in whole.

A published table is a folder with one folder per load (``load=<name>``, below it
``date=<day>`` for dated tables) and a folder of pointers, ``_published/<version>``.  A
pointer names the live folders, one a line; the highest complete pointer counts.  A load

1. writes its rows into a new load folder, which no reader looks at yet;
2. writes the next pointer, which names the new folders in place of those they replace.

A load that dies before step 2 leaves the table as it was.  A pointer that was not
written to its end lacks its last line and does not count.  Two loads that started from
the same version write the same pointer file, which only one can create: the other
fails and can be run again.  Readers that have listed their folders keep them until
``vacuum`` drops what the last versions do not name.

A pointer holds one line per load and day, and is written by the driver; rows never are.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import store

POINTERS, END_LINE = "_published", "end"


class Conflict(RuntimeError):
    """Another load published first; run this one again."""


def _fs(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, folder = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(folder)) if fs.exists(folder) else []


def exists(spark: SparkSession, path: str) -> bool:
    return bool(_names(spark, path))


def is_published(spark: SparkSession, path: str) -> bool:
    """Also where the first load died before its pointer: that table is empty."""
    return any(n == POINTERS or n.startswith("load=") for n in _names(spark, path))


def live(spark: SparkSession, path: str) -> tuple[int, list[str]]:
    """(number the next pointer takes, live folders)."""
    numbers = sorted((int(n) for n in _names(spark, f"{path}/{POINTERS}") if n.isdigit()), reverse=True)
    for number in numbers:
        folders = _pointer(spark, path, number)
        if folders is not None:
            return numbers[0] + 1, folders
    return (numbers[0] if numbers else 0) + 1, []


def _pointer(spark: SparkSession, path: str, number: int) -> list[str] | None:
    """Folders that a pointer names; None if it was not written to its end."""
    fs, file = _fs(spark, f"{path}/{POINTERS}/{number:09d}")
    stream = fs.open(file)
    try:
        lines = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").split("\n")
    finally:
        stream.close()
    return lines[:-1] if lines[-1] == END_LINE else None


def publish(spark: SparkSession, path: str, version: int, folders: list[str]) -> None:
    """Makes ``folders`` the table, as ``version``; raises ``Conflict`` if that is taken."""
    fs, file = _fs(spark, f"{path}/{POINTERS}/{version:09d}")
    if fs.exists(file):
        raise Conflict(f"version {version} of {path} is taken")
    try:
        stream = fs.create(file, False)
    except Exception as taken:   # created since: the file system refuses a second one
        raise Conflict(f"version {version} of {path} is taken") from taken
    stream.write(bytearray("\n".join([*sorted(folders), END_LINE]), "utf-8"))
    stream.close()


def stage(df: DataFrame, path: str, target: str) -> list[str]:
    """Writes rows into a load folder of their own; returns its folders, not live yet."""
    load = f"load={uuid.uuid4().hex}"
    if "date" not in store.TARGETS[target].fieldNames():
        store.conform(df, target).write.parquet(f"{path}/{load}")
        return [load]
    store.load_days(df, f"{path}/{load}", target)
    return [f"{load}/{n}" for n in _names(df.sparkSession, f"{path}/{load}") if n.startswith("date=")]


def _read(spark: SparkSession, path: str, folders: list[str], target: str) -> DataFrame:
    """Rows of the folders with the column ``load``."""
    schema = store.TARGETS[target]
    full = T.StructType([*schema.fields, T.StructField("load", T.StringType())])
    if not folders:
        return spark.createDataFrame([], full)
    return (spark.read.schema(full).option("basePath", path).parquet(*[f"{path}/{f}" for f in folders])
            .select(*full.fieldNames()))


def read_folders(spark: SparkSession, path: str, folders: list[str], target: str) -> DataFrame:
    """Rows of some folders of the table, live or staged."""
    return _read(spark, path, folders, target).drop("load")


def read_published(spark: SparkSession, path: str, target: str) -> DataFrame:
    return _read(spark, path, live(spark, path)[1], target).drop("load")


def _adopted(spark: SparkSession, path: str, target: str) -> tuple[int, list[str]]:
    """``live``; a plain table that stands at ``path`` becomes the first folders."""
    version, folders = live(spark, path)
    if version == 1 and any(not n.startswith(("_", ".", "load=")) for n in _names(spark, path)):
        folders = stage(store.read_plain(spark, path, target), path, target)
    return version, folders


def publish_table(df: DataFrame, path: str, target: str) -> None:
    """I-15: the rows are the whole new table."""
    version, _ = live(df.sparkSession, path)
    publish(df.sparkSession, path, version, stage(df, path, target))


def publish_days(df: DataFrame, path: str, target: str = "trades") -> None:
    """I-11 / I-13: the days in ``df`` are replaced, other days stay."""
    spark = df.sparkSession
    version, old = _adopted(spark, path, target)
    new = stage(df, path, target)
    days = {f.rpartition("/")[2] for f in new}
    publish(spark, path, version, [f for f in old if f.rpartition("/")[2] not in days] + new)


def publish_append(df: DataFrame, path: str, target: str = "trades") -> None:
    """I-11 / I-13 / I-14: the rows are added; pages (trades) or securities of a day
    (prices) that they bring again are replaced.

    Only the folders that hold such a page are written again, without it; a load that
    brings new pages only writes itself, whatever its days hold already."""
    spark = df.sparkSession
    version, old = _adopted(spark, path, target)
    new = stage(df, path, target)
    days = {f.rpartition("/")[2] for f in new}
    near = [f for f in old if f.rpartition("/")[2] in days] if target in store.REPLACED else []
    if near:
        keys = [F.expr(k).alias(f"_k{i}") for i, k in enumerate(store.REPLACED[target])]
        names = [f"_k{i}" for i in range(len(keys))]
        again = _read(spark, path, new, target).select(*keys).distinct()
        hit = (_read(spark, path, near, target).select("load", F.col("date").alias("_d"), *keys)
               .join(again, names, "left_semi").select("load", "_d").distinct())
        # one row per live folder of these days at most
        changed = [f"load={r['load']}/date={r['_d']}" for r in hit.collect()]
        if changed:
            kept = (_read(spark, path, changed, target).select("*", *keys).join(again, names, "left_anti")
                    .drop("load", *names))
            new = new + stage(kept, path, target)
            old = [f for f in old if f not in set(changed)]
    publish(spark, path, version, old + new)


def unpublish_day(spark: SparkSession, path: str, date: str) -> bool:
    """I-16: drops one trading day.  Returns whether it was there."""
    version, old = live(spark, path)
    kept = [f for f in old if f.rpartition("/")[2] != f"date={date}"]
    if len(kept) < len(old):
        publish(spark, path, version, kept)
    return len(kept) < len(old)


def vacuum(spark: SparkSession, path: str, keep: int = 1) -> list[str]:
    """Deletes the load folders that none of the last ``keep`` complete versions names, and
    the pointers before those.  Run it when no load is running: its folders are not
    named yet."""
    numbers = [int(n) for n in _names(spark, f"{path}/{POINTERS}") if n.isdigit()]
    named = {n: f for n in numbers if (f := _pointer(spark, path, n)) is not None}
    last = sorted(named)[-max(1, keep):]
    used = reduce(set.union, (set(named[n]) for n in last), set())
    gone = []
    for load in _names(spark, path):
        if load.startswith("load="):
            for f in [f"{load}/{n}" for n in _names(spark, f"{path}/{load}") if n.startswith("date=")] or [load]:
                if f not in used:
                    gone.append(f)
    fs, _ = _fs(spark, path)
    for f in gone + [f"{POINTERS}/{n:09d}" for n in numbers if n < last[0]]:
        fs.delete(_fs(spark, f"{path}/{f}")[1], True)
    return gone
