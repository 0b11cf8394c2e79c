"""Fixed schemas of the three stored tables, the snapshot and landed pages."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 4)

# One row per trade ("floorsheet").  ``id`` orders trades inside a symbol and
# every run operator depends on it.  ``date`` is ISO text (yyyy-MM-dd) so range
# filters compare as text, exactly as dates; stored tables partition on it.
TRADES = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("date", T.StringType(), True),
    T.StructField("stock_symbol", T.StringType(), True),
    T.StructField("buyer", T.StringType(), True),
    T.StructField("seller", T.StringType(), True),
    T.StructField("quantity", T.IntegerType(), True),
    T.StructField("rate", MONEY, True),
    T.StructField("amount", MONEY, True),
])

# Per-security daily prices.
PRICES = T.StructType([
    T.StructField("date", T.StringType(), True),
    T.StructField("stock_name", T.StringType(), True),
    T.StructField("stock_symbol", T.StringType(), True),
    T.StructField("num_trnx", T.LongType(), True),
    T.StructField("max_price", MONEY, True),
    T.StructField("min_price", MONEY, True),
    T.StructField("closing_price", MONEY, True),
    T.StructField("traded_shares", MONEY, True),
    T.StructField("amount", MONEY, True),
    T.StructField("previous_price", MONEY, True),
    T.StructField("difference", MONEY, True),
    T.StructField("pc_change", T.DoubleType(), True),
])

# Daily prices as loaded: with the id of their arrival.
PRICE_LIST = T.StructType([T.StructField("id", T.LongType(), False), *PRICES.fields])

# Runs inside one part (side, day, symbol, segment of ids) of the trades: ``local`` counts
# them from 1, ``lo`` and ``hi`` are the ids of the run there.
RUN_PIECES = T.StructType([
    T.StructField("side", T.StringType(), False),
    T.StructField("date", T.StringType(), True),
    T.StructField("stock_symbol", T.StringType(), True),
    T.StructField("seg", T.LongType(), False),
    T.StructField("local", T.LongType(), False),
    T.StructField("broker", T.StringType(), True),
    T.StructField("lo", T.LongType(), False),
    T.StructField("hi", T.LongType(), False),
    T.StructField("amount", T.DecimalType(28, 4), True),
    T.StructField("quantity", T.LongType(), True),
    T.StructField("trades", T.LongType(), False),
])

# Run numbers of each part: where a drill-down finds a run's trades.
RUN_INDEX = T.StructType([
    T.StructField("side", T.StringType(), False),
    T.StructField("first_grp", T.LongType(), False),
    T.StructField("last_grp", T.LongType(), False),
    T.StructField("date", T.StringType(), True),
    T.StructField("stock_symbol", T.StringType(), True),
    T.StructField("lo", T.LongType(), False),
    T.StructField("hi", T.LongType(), False),
])

# Security directory.
COMPANIES = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("stock_name", T.StringType(), True),
    T.StructField("stock_symbol", T.StringType(), True),
    T.StructField("sector", T.StringType(), True),
])

# Exchange price snapshot records (19 keys, read from a user JSON file).
SNAPSHOT = T.StructType([
    T.StructField("id", T.LongType(), True),
    T.StructField("businessDate", T.DateType(), True),
    T.StructField("securityId", T.LongType(), True),
    T.StructField("symbol", T.StringType(), True),
    T.StructField("securityName", T.StringType(), True),
    T.StructField("openPrice", MONEY, True),
    T.StructField("highPrice", MONEY, True),
    T.StructField("lowPrice", MONEY, True),
    T.StructField("closePrice", MONEY, True),
    T.StructField("totalTradedQuantity", T.LongType(), True),
    T.StructField("totalTradedValue", MONEY, True),
    T.StructField("previousDayClosePrice", MONEY, True),
    T.StructField("fiftyTwoWeekHigh", MONEY, True),
    T.StructField("fiftyTwoWeekLow", MONEY, True),
    T.StructField("lastUpdatedTime", T.TimestampNTZType(), True),
    T.StructField("lastUpdatedPrice", MONEY, True),
    T.StructField("totalTrades", T.LongType(), True),
    T.StructField("averageTradedPrice", MONEY, True),
    T.StructField("marketCapitalization", T.DecimalType(18, 2), True),
])

# One saved exchange page.
PAGES = T.StructType([
    T.StructField("date", T.StringType(), True),
    T.StructField("page_no", T.IntegerType(), True),
    T.StructField("url", T.StringType(), True),
    T.StructField("html", T.StringType(), True),
])

SIDES = {"buy": "buyer", "sell": "seller"}


def broker_col(side: str) -> str:
    try:
        return SIDES[side]
    except KeyError:
        raise ValueError(f"side must be 'buy' or 'sell', got {side!r}") from None
