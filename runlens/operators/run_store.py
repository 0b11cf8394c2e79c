"""Run numbers kept up to date by the day (R-3 .. R-6, R-16, R-17).

A day's trades are read once, when they arrive: what is stored of them is one row per
run inside a part (side, day, symbol, segment of ids).  Those rows merge: the last run of
a part and the first of the next are one run if their brokers agree.  So after a new
day, or a day loaded again, all runs are numbered and summed from the stored rows, and no
trade of another day is read; ``stored_totals`` equals ``runs.run_summary`` over all trades.

Parts are put in order by their ids, so the days of one symbol must not interleave
in them (ids of loaded trades begin with the day); ``put_days`` refuses such trades.

``write_index`` stores the run numbers of the parts, sorted by them.  A drill-down reads
the index rows that hold the number, and of the trades only those days, symbols and id
ranges, which prune partitions, files and row groups of a table of ``store``.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..schema import RUN_INDEX
from ..sources import publish
from . import runs

_PART = ["side", "date", "stock_symbol", "seg"]
#: Index rows up to which a drill-down filters by their id ranges; a longer run is
#: fetched by a join with its rows.
MAX_RANGES = 64


def part_pieces(trades: DataFrame, bucket_width: int = runs.DEFAULT_BUCKET_WIDTH) -> DataFrame:
    """Rows of ``schema.RUN_PIECES``: one shuffle of the trades, both sides at once."""
    df, _, seg = runs._segmented(runs.stack_sides(trades), "broker", None, None, (), bucket_width, ["side", "date"])
    return df.groupBy(*seg, "_g0", "stock_symbol", "broker").agg(
        F.min("id").alias("lo"), F.max("id").alias("hi"), F.sum("amount").alias("amount"),
        F.sum("quantity").cast("long").alias("quantity"), F.count("*").alias("trades")).select(
        "side", "date", "stock_symbol", F.col("_seg").alias("seg"), F.col("_g0").alias("local"), "broker",
        "lo", "hi", "amount", "quantity", "trades")


def _parts(pieces: DataFrame) -> DataFrame:
    """One row per part: runs in it, first and last broker, its ids."""
    return pieces.groupBy(*_PART).agg(
        F.max("local").alias("_nb"), F.min_by("broker", "local").alias("_first"), F.max_by("broker", "local").alias("_last"),
        F.min("lo").alias("lo"), F.max("hi").alias("hi"))


def put_days(spark: SparkSession, path: str, trades: DataFrame, bucket_width: int = runs.DEFAULT_BUCKET_WIDTH) -> None:
    """Stores the runs of the days in ``trades`` (whole days; those stored before are
    replaced) in the published table at ``path``.  Raises ValueError where they would
    stand between the ids of another day."""
    version, old = publish.live(spark, path)
    new = publish.stage(part_pieces(trades, bucket_width), path, "run_pieces")
    days = {f.rpartition("/")[2] for f in new}
    folders = [f for f in old if f.rpartition("/")[2] not in days] + new
    parts = _parts(publish.read_folders(spark, path, folders, "run_pieces"))
    ahead = F.lag("hi").over(Window.partitionBy("side", "stock_symbol", "seg").orderBy("lo"))
    mixed = parts.select("date", "stock_symbol", (ahead >= F.col("lo")).alias("mixed")).filter("mixed")
    if not mixed.isEmpty():
        raise ValueError(f"days interleave in the ids of a symbol: {mixed.first().asDict()}")
    publish.publish(spark, path, version, folders)


def _numbered_parts(pieces: DataFrame, fanout) -> tuple[DataFrame, list[str]]:
    """(parts with ``_soff``, their key columns)."""
    key_exprs, keys = runs._key_cols(["stock_symbol"])
    parts = _parts(pieces).select("*", *key_exprs, F.col("seg").alias("_seg"))
    offsets = runs._segment_offsets(parts.select("side", *keys, "_seg", F.col("lo").alias("_lo"), "_nb", "_first", "_last"),
                                    ["side", *keys], [], fanout, ["side"], ["_lo"])
    out = parts.drop("_nb").withColumn("_lo", F.col("lo")).join(offsets, ["side", *keys, "_seg", "_lo"])
    return out, keys


def stored_totals(spark: SparkSession, path: str, start: str | None = None, end: str | None = None,
                  fanout: int | Sequence[int] = runs.DEFAULT_FANOUT) -> DataFrame:
    """R-4 .. R-6 for both sides from the stored rows: side, grp, date, stock_symbol, broker,
    cuml, cumq, trnxs, numbered over the days of the range."""
    pieces = runs.trades_in_range(publish.read_published(spark, path, "run_pieces"), start, end)
    parts, keys = _numbered_parts(pieces, fanout)
    key_exprs, _ = runs._key_cols(["stock_symbol"])
    numbered = (pieces.select("*", *key_exprs).join(parts.select("side", "date", *keys, "seg", "_soff"),
                                                    ["side", "date", *keys, "seg"])
                .select("side", (F.col("local") + F.col("_soff")).cast("long").alias("grp"), "date", "stock_symbol",
                        "broker", F.col("amount").alias("_a"), F.col("quantity").alias("_q"), F.col("trades").alias("_c")))
    return runs._totals(numbered, "broker", ["side"])


def write_index(spark: SparkSession, path: str, index: str, fanout: int | Sequence[int] = runs.DEFAULT_FANOUT) -> None:
    """Stores the run numbers of all parts of the table at ``path``, sorted, as the Parquet
    folder ``index`` (made anew for each version of the table)."""
    parts, _ = _numbered_parts(publish.read_published(spark, path, "run_pieces"), fanout)
    rows = parts.select("side", (F.col("_soff") + 1).cast("long").alias("first_grp"),
                        (F.col("_soff") + F.col("_nb")).cast("long").alias("last_grp"), "date", "stock_symbol", "lo", "hi")
    rows.sort("side", "first_grp").write.parquet(index)


def indexed_run_trades(spark: SparkSession, index: str, trades: DataFrame, side: str, grp: int) -> DataFrame:
    """R-16 / R-17: the trades of one run, in full, found by the index."""
    held = (spark.read.schema(RUN_INDEX).parquet(index)
            .filter((F.col("side") == side) & (F.col("first_grp") <= grp) & (F.col("last_grp") >= grp)))
    found = held.limit(MAX_RANGES + 1).collect()
    if not found:
        return runs.with_run_ids(trades.limit(0), side)
    days = F.col("date").between(*held.agg(F.min("date"), F.max("date")).first())
    if len(found) <= MAX_RANGES:
        inside = reduce(lambda a, b: a | b, [
            F.col("stock_symbol").eqNullSafe(F.lit(r["stock_symbol"]).cast("string")) & (F.col("date") == r["date"])
            & F.col("id").between(r["lo"], r["hi"]) for r in found])
        part = trades.filter(days & inside)
    else:
        at = held.select("date", F.col("stock_symbol").alias("_s"), "lo", "hi")
        part = (trades.filter(days).join(at, "date").filter(F.col("stock_symbol").eqNullSafe(F.col("_s"))
                                                            & F.col("id").between(F.col("lo"), F.col("hi")))
                .select(*trades.columns))
    # Numbered from the first of these parts on: the run is the last of the first part,
    # whole parts, or one inside the only part.
    first = min(r["first_grp"] for r in found) if len(found) <= MAX_RANGES else held.agg(F.min("first_grp")).first()[0]
    numbered = runs.with_run_ids(part, side)
    return numbered.filter(F.col("grp") == grp - first + 1).withColumn("grp", F.lit(grp).cast("long")).select(
        *trades.columns, "r", "grp")
