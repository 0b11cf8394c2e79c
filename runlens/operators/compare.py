"""Buying runs beside selling runs (C-1 .. C-9).

Both sides are bounded top-n results, so the positional windows below see at
most ``n`` (one symbol) or ``2n+1`` rows (all symbols).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import rate_1dp, rate_int
from .runs import DEFAULT_BUCKET_WIDTH, DEFAULT_FANOUT
from .top_runs import report_order, sorted_small, top_runs_sides

def with_rate_int(df: DataFrame) -> DataFrame:
    """C-1: ``int(amount / quantity)``; zero quantity gives NULL."""
    return df.withColumn("rate", rate_int("cuml", "cumq"))


def with_rate_1dp(df: DataFrame) -> DataFrame:
    """C-2: ``np.around(amount / quantity, 1)``."""
    return df.withColumn("rate", rate_1dp("cuml", "cumq"))


_FIELDS = {"date": "date", "symbol": "stock_symbol", "amount": "cuml", "quantity": "cumq", "trnxs": "trnxs",
           "pc_change": "pc_change", "rate": "rate", "grp": "grp"}


def _beside(top: DataFrame, keys: list[str]) -> DataFrame:
    """Buy row beside sell row per ``keys`` (symbol and/or position) by one
    conditional aggregation: at most one row per side and key, so no split of
    the pipeline and no join are needed."""
    def pick(side, col):
        return F.max(F.when(F.col("side") == side, F.col(col)))
    aggs = []
    for side, broker in (("buy", "buyer"), ("sell", "seller")):
        aggs += [pick(side, c).alias(f"{side}_{name}") for name, c in _FIELDS.items()]
        aggs.append(pick(side, "broker").alias(broker))
        aggs.append(F.max(F.when(F.col("side") == side, F.lit(True))).alias(f"_has_{side}"))
    return top.groupBy(*keys).agg(*aggs)


def compare_symbol(trades: DataFrame, prices: DataFrame, start: str | None, end: str | None,
                   symbol: str, n: int, bucket_width: int = DEFAULT_BUCKET_WIDTH,
                   fanout=DEFAULT_FANOUT) -> DataFrame:
    """C-4: the i-th buying run beside the i-th selling run of one symbol.

    The reference walks the buy list only, so extra selling runs are dropped
    and a missing selling run is an error there; here it is NULL.
    """
    top = top_runs_sides(trades, prices, start, end, {"buy": n, "sell": n}, symbol=symbol,
                         bucket_width=bucket_width, fanout=fanout)
    top = with_rate_int(top)
    # At most n rows per side.
    w = Window.partitionBy("side").orderBy(*report_order("buy", False, broker="broker"))
    top = top.select("*", F.row_number().over(w).alias("pos"))
    out = _beside(top, ["pos"]).filter(F.col("_has_buy")).drop("_has_buy", "_has_sell")
    return sorted_small(out, [F.col("pos")])


def compare_all(trades: DataFrame, prices: DataFrame, start: str | None, end: str | None,
                n: int, bucket_width: int = DEFAULT_BUCKET_WIDTH, fanout=DEFAULT_FANOUT) -> DataFrame:
    """C-9: per symbol, buying runs (top ``n``) beside selling runs (top
    ``n + 1``, as in the reference) in report order, the shorter side padded
    with NULLs.  Both sides run through one pipeline (``top_runs_sides``)."""
    top = top_runs_sides(trades, prices, start, end, {"buy": n, "sell": n + 1},
                         bucket_width=bucket_width, fanout=fanout)
    top = with_rate_1dp(top)
    # At most 2n + 1 rows.
    w = Window.partitionBy("side", "stock_symbol").orderBy(*report_order("buy", False, broker="broker"))
    top = top.select("*", F.row_number().over(w).alias("pos"))
    out = _beside(top, ["stock_symbol", "pos"]).drop("_has_buy", "_has_sell")
    return sorted_small(out, [F.col("stock_symbol").asc_nulls_last(), F.col("pos")])


def runs_per_symbol(top_sides: DataFrame) -> DataFrame:
    """C-5: listed runs per symbol and side, from ``top_runs_sides``."""
    return top_sides.groupBy("side", "stock_symbol").agg(F.count(F.lit(1)).alias("runs"))


def symbols_either_side(top_sides: DataFrame) -> DataFrame:
    """C-6: distinct symbols listed on either side, from ``top_runs_sides``."""
    return top_sides.select("stock_symbol").distinct()
