"""Largest runs with that day's price change (R-7 .. R-15, R-18)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..schema import broker_col
from .runs import DEFAULT_BUCKET_WIDTH, DEFAULT_FANOUT, run_summary, run_summary_sides


#: Groups of tasks of the first merge of a per-side top-n.
TOP_PARTS = 64


def report_order(side: str, all_symbols: bool, broker: str | None = None) -> list:
    """R-10 / R-11 order, NULL placement as the reference's database
    (DESC = NULLS FIRST, ASC = NULLS LAST); ``grp`` makes it total."""
    b = broker or broker_col(side)
    order = [F.col("date").asc_nulls_last(), F.col(b).desc_nulls_first(),
             F.col("cuml").desc_nulls_first(), F.col("grp").asc()]
    if all_symbols:
        order = [F.col("stock_symbol").asc_nulls_last()] + order
    return order


def top_runs(trades: DataFrame, prices: DataFrame, side: str, start: str | None, end: str | None,
             n: int, symbol: str | None = None, break_on: Sequence[str] = (),
             bucket_width: int = DEFAULT_BUCKET_WIDTH, fanout: int = DEFAULT_FANOUT,
             sort: bool = True) -> DataFrame:
    """The ``n`` runs with the largest amount, for one symbol or all, joined
    to the day's percent change (R-12 .. R-15; strict runs with ``break_on``).

    Run numbers come from the whole range; the symbol filter applies after
    numbering, as in the reference.  The limit comes before the inner price
    join, so fewer than ``n`` rows (no price row) or more (duplicate price rows)
    can come back.  Columns: grp, date, stock_symbol, buyer|seller, cuml,
    cumq, trnxs, pc_change.
    """
    if n < 0:
        raise ValueError("n must be >= 0")
    b = broker_col(side)
    totals = run_summary(trades, side, start, end, break_on=break_on,
                         bucket_width=bucket_width, fanout=fanout)
    if symbol is not None:
        totals = totals.filter(F.col("stock_symbol") == F.lit(symbol))
    # Top-n: TakeOrderedAndProject keeps n rows per partition, merges n*P rows.
    top = totals.orderBy(F.col("cuml").desc_nulls_last(), "grp", "date", "stock_symbol").limit(int(n))
    price = prices.select("date", "stock_symbol", "pc_change")
    # The planner knows the limit, so it broadcasts a small top-n by itself.
    joined = top.join(price, ["date", "stock_symbol"], "inner")
    out = joined.select(
        "grp", "date", "stock_symbol", b,
        F.col("cuml").cast("double").alias("cuml"),
        F.col("cumq").cast("long").alias("cumq"),
        F.col("trnxs").cast("long").alias("trnxs"),
        F.col("pc_change").cast("double").alias("pc_change"))
    if sort:
        out = sorted_small(out, report_order(side, symbol is None))
    return out


def with_position(top: DataFrame, side: str, all_symbols: bool) -> DataFrame:
    """The rows of ``top_runs`` (at most its ``n`` and their price rows) with their
    place ``pos`` in the report."""
    return top.select("*", F.row_number().over(Window.orderBy(*report_order(side, all_symbols))).alias("pos"))


def sorted_small(df: DataFrame, order: list) -> DataFrame:
    """Total order for a result bounded by ``n`` rows: one partition sorted in
    place (a range-partitioned ``orderBy`` would first run a sampling job)."""
    return df.repartition(1).sortWithinPartitions(*order)


def top_runs_sides(trades: DataFrame, prices: DataFrame, start: str | None, end: str | None,
                   limits: Mapping[str, int], symbol: str | None = None, break_on: Sequence[str] = (),
                   bucket_width: int = DEFAULT_BUCKET_WIDTH,
                   fanout: int | Sequence[int] = DEFAULT_FANOUT) -> DataFrame:
    """``top_runs`` for several sides in one pipeline: ``limits`` maps a side
    to its ``n`` (e.g. ``{"buy": 800, "sell": 801}``).  Columns: side, grp,
    date, stock_symbol, broker, cuml, cumq, trnxs, pc_change.

    The per-side top-n is merged in two steps, one plan for every ``n``
    (``session.DEFAULT_CONF`` lifts the planner's limit on it): each task keeps the ``n``
    best of its own runs, ``TOP_PARTS`` groups of tasks the best of those, and one task a
    side the best of the groups.  So at most ``n`` rows of a task leave it, and no
    more than ``n * TOP_PARTS`` rows of a side meet at the end."""
    if not limits or min(limits.values()) < 0:
        raise ValueError("limits must map sides to n >= 0")
    totals = run_summary_sides(trades, tuple(limits), start, end, break_on=break_on,
                               bucket_width=bucket_width, fanout=fanout)
    if symbol is not None:
        totals = totals.filter(F.col("stock_symbol") == F.lit(symbol))
    order = [F.col("cuml").desc_nulls_last(), "grp", "date", "stock_symbol"]
    most = F.lit(int(max(limits.values())))
    # Which rows share a group does not matter for the result.
    part = F.pmod(F.spark_partition_id(), F.lit(TOP_PARTS))
    ranked = totals.withColumn("_part", part)
    for by in (["side", "_part"], ["side"]):
        ranked = ranked.withColumn("_rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
        ranked = ranked.filter(F.col("_rank") <= most)
    keep = reduce(lambda a, b: a | b, [(F.col("side") == F.lit(s)) & (F.col("_rank") <= F.lit(int(n)))
                                       for s, n in limits.items()])
    top = ranked.filter(keep)
    price = prices.select("date", "stock_symbol", "pc_change")
    joined = top.join(price, ["date", "stock_symbol"], "inner")
    return joined.select(
        "side", "grp", "date", "stock_symbol", "broker",
        F.col("cuml").cast("double").alias("cuml"),
        F.col("cumq").cast("long").alias("cumq"),
        F.col("trnxs").cast("long").alias("trnxs"),
        F.col("pc_change").cast("double").alias("pc_change"))
