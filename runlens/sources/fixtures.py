"""Trade, price, company and snapshot tables derived from the supplied data.

The analysed exchange data itself is not public, so the working tables are
views over the driver's Parquet tables (see FIXTURES.md):

* ``trades_from_events``  (F1): ``events`` as a trade list, long runs, id order
  equals time order.
* ``prices_from_trades``  (F2): one daily price row per (date, symbol).
* ``trades_from_orders``  (F3): ``orders`` joined to ``customer``; id order is
  not date order, 25 symbols, thousands of dates.
* ``companies_from_trades`` / ``companies_from_parts`` (F4): security directory.
* ``snapshot_json_lines`` (F5): exchange snapshot records as JSON text.

Every function is a lazy DataFrame transformation; nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.numeric import pc_change_expr

# Fixed fixture parameters (FIXTURES.md).
F1_RANGE = ("2024-01-02", "2024-01-20")
F1_SYMBOL = "purchase"
F2_DROPPED_SYMBOL = "signup"
F2_DROPPED_DATES = ("2024-01-05", "2024-01-07")
F4_MISSING_SYMBOL = "error"
# Sector per fixture symbol.
F4_SECTORS = {
    "click": "Commercial Banks",
    "purchase": "Hydro Power",
    "signup": "Life Insurance",
    "view": "Microfinance",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A supplied table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def trades_from_events(ev: DataFrame) -> DataFrame:
    """F1."""
    quantity = F.get_json_object("props", "$.k").try_cast("int") + F.lit(1)
    rate = F.col("value").cast("decimal(18,2)")
    out = ev.select(
        F.col("event_id").alias("id"),
        F.date_format("ts", "yyyy-MM-dd").alias("date"),
        F.col("event_type").alias("stock_symbol"),
        (F.col("user_id") % 4).cast("string").alias("buyer"),
        (F.floor(F.col("user_id") / 4).cast("bigint") % 4).cast("string").alias("seller"),
        quantity.alias("quantity"),
        rate.alias("rate"),
        (rate * quantity).cast("decimal(18,2)").alias("amount"),
    )
    return out


def trades_from_orders(orders: DataFrame, customer: DataFrame) -> DataFrame:
    """id order is not date order; 25 symbols."""
    quantity = (F.col("o_orderkey") % 50 + 1).cast("int")
    joined = orders.join(customer, orders.o_custkey == customer.c_custkey, "inner")
    return joined.select(
        F.col("o_orderkey").alias("id"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"),
        F.concat(F.col("c_mktsegment"), F.lit("-"), F.substring("o_orderpriority", 1, 1)).alias("stock_symbol"),
        (F.col("c_nationkey") % 5).cast("string").alias("buyer"),
        (F.col("c_custkey") % 12).cast("string").alias("seller"),
        quantity.alias("quantity"),
        (F.floor(F.col("o_totalprice") * 100 / quantity) / 100).cast("decimal(18,2)").alias("rate"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("amount"),
    )


def replicate_trades(trades: DataFrame, copies: int, stride: int = 10**12) -> DataFrame:
    """``copies`` shifted copies of a trade table (ids + copy * stride, symbols
    suffixed ``#copy``): a larger input with the same run structure per copy,
    for scaling measurements.  Derived row by row (``explode``), no shuffle."""
    copy = F.explode(F.sequence(F.lit(0), F.lit(int(copies) - 1))).alias("_copy")
    rep = trades.select("*", copy)
    cols = [(F.col("id") + F.col("_copy") * F.lit(int(stride))).alias("id") if c == "id"
            else F.concat(F.col(c), F.lit("#"), F.col("_copy").cast("string")).alias(c) if c == "stock_symbol"
            else F.col(c) for c in trades.columns]
    return rep.select(*cols)


def stock_name_expr(symbol_col: str = "stock_symbol"):
    return F.concat(F.upper(F.col(symbol_col)), F.lit(" LTD"))


def prices_from_trades(trades: DataFrame, drop_symbol: str | None = F2_DROPPED_SYMBOL,
                       drop_dates: tuple[str, str] | None = F2_DROPPED_DATES) -> DataFrame:
    """daily price rows per (date, symbol) with previous close and percent
    change.  The previous close is taken before rows are dropped, as the
    exchange would report it."""
    daily = trades.groupBy("date", "stock_symbol").agg(
        F.count(F.lit(1)).alias("num_trnx"),
        F.max("rate").alias("max_price"),
        F.min("rate").alias("min_price"),
        F.max_by("rate", "id").alias("closing_price"),
        F.sum("quantity").cast("decimal(18,2)").alias("traded_shares"),
        F.sum("amount").cast("decimal(18,2)").alias("amount"),
    )
    # One row per trading day of a symbol: bounded by the calendar.
    w = Window.partitionBy("stock_symbol").orderBy("date")
    prev = F.coalesce(F.lag("closing_price").over(w), F.lit(0).cast("decimal(18,2)"))
    daily = daily.select("*", prev.cast("decimal(18,2)").alias("previous_price"))
    diff = (F.when(F.col("previous_price") == 0, F.lit(0).cast("decimal(18,2)"))
            .otherwise(F.col("closing_price") - F.col("previous_price")).cast("decimal(18,2)"))
    daily = daily.select("*", diff.alias("difference"))
    daily = daily.select("*", pc_change_expr("difference", "previous_price").alias("pc_change"))
    if drop_symbol is not None and drop_dates is not None:
        gone = (F.col("stock_symbol") == drop_symbol) & F.col("date").between(*drop_dates)
        daily = daily.filter(~gone)
    return daily.select(
        "date", stock_name_expr().alias("stock_name"), "stock_symbol", "num_trnx",
        "max_price", "min_price", "closing_price", "traded_shares", "amount",
        "previous_price", "difference", "pc_change")


def companies_from_trades(trades: DataFrame) -> DataFrame:
    """F4 over the F1 symbols: one listing per symbol except ``error`` (so the
    lookup has a miss), plus an alias listing of every name under the upper-cased
    symbol with a larger id, so the first-hit rule decides."""
    sym = trades.groupBy("stock_symbol").agg(F.min("id").alias("first_id"), F.max("id").alias("last_id"))
    sym = sym.filter(F.col("stock_symbol") != F4_MISSING_SYMBOL)
    sector = F.create_map(*[x for k, v in F4_SECTORS.items() for x in (F.lit(k), F.lit(v))])
    base = sym.select(
        F.col("first_id").alias("id"), stock_name_expr().alias("stock_name"),
        F.col("stock_symbol"), sector[F.col("stock_symbol")].alias("sector"))
    alias = sym.select(
        (F.col("last_id") + 1).alias("id"), stock_name_expr().alias("stock_name"),
        F.upper("stock_symbol").alias("stock_symbol"), sector[F.col("stock_symbol")].alias("sector"))
    return base.unionByName(alias)


def companies_from_parts(part: DataFrame, min_size: int = 10) -> DataFrame:
    """F4 at scale: ``part`` as the security directory.  Parts of size below
    ``min_size`` are left out so the snapshot back-fill has work."""
    return part.filter(F.col("p_size") >= min_size).select(
        F.col("p_partkey").alias("id"),
        F.col("p_name").alias("stock_name"),
        F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("stock_symbol"),
        F.col("p_brand").alias("sector"))


def sector_map_from_parts(part: DataFrame) -> DataFrame:
    """Symbol -> sector mapping used by the back-fill instead of a console
    prompt.  Only part types starting with ``STANDARD`` or ``PROMO`` are
    mapped, the rest stay NULL."""
    return part.filter(F.col("p_type").startswith("STANDARD") | F.col("p_type").startswith("PROMO")).select(
        F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("stock_symbol"),
        F.substring_index("p_type", " ", 1).alias("sector"))


def snapshot_json_lines(part: DataFrame) -> DataFrame:
    """one exchange snapshot record per part, as JSON text (one object per
    line), with the format quirks of the real snapshot: previous close 0 for
    size-1 parts, integer ``0`` market capitalisation for size-2 parts, 4, 5
    or 6 fractional digits in ``lastUpdatedTime``, and one repeated symbol
    (each part of size 50 appears a second time with a larger id)."""
    p = part.select("p_partkey", "p_name", "p_size", "p_retailprice")
    again = p.filter(F.col("p_size") == 50).withColumn("dup", F.lit(1))
    rows = p.withColumn("dup", F.lit(0)).unionByName(again)
    price = F.col("p_retailprice")
    frac_digits = F.col("p_partkey") % 3 + 4
    micros = F.lpad(((F.col("p_partkey") * 7919) % 1000000).cast("string"), 6, "0")
    ts = F.concat(F.lit("2024-02-15T10:"), F.lpad((F.col("p_partkey") % 60).cast("string"), 2, "0"),
                  F.lit(":17."), F.substring(micros, 1, 6).substr(F.lit(1), frac_digits))
    money = lambda c: F.format_string("%.4f", c)
    fields = [
        ("id", (F.lit(1300000) + F.col("p_partkey") + F.col("dup") * 100000).cast("string"), False),
        ("businessDate", F.lit("2024-02-15"), True),
        ("securityId", F.col("p_partkey").cast("string"), False),
        ("symbol", F.concat(F.lit("P"), F.col("p_partkey").cast("string")), True),
        ("securityName", F.col("p_name"), True),
        ("openPrice", money(price), False),
        ("highPrice", money(price * 1.02), False),
        ("lowPrice", money(price * 0.98), False),
        ("closePrice", money(price * 1.01), False),
        ("totalTradedQuantity", (F.col("p_size") * 25).cast("string"), False),
        ("totalTradedValue", money(price * F.col("p_size") * 25), False),
        ("previousDayClosePrice", F.when(F.col("p_size") == 1, F.lit("0")).otherwise(money(price)), False),
        ("fiftyTwoWeekHigh", money(price * 1.5), False),
        ("fiftyTwoWeekLow", money(price * 0.5), False),
        ("lastUpdatedTime", ts, True),
        ("lastUpdatedPrice", money(price * 1.01), False),
        ("totalTrades", F.col("p_size").cast("string"), False),
        ("averageTradedPrice", money(price), False),
        ("marketCapitalization", F.when(F.col("p_size") == 2, F.lit("0"))
         .otherwise(F.format_string("%.2f", price * 3)), False),
    ]
    parts = []
    for i, (name, value, quoted) in enumerate(fields):
        sep = "{" if i == 0 else ", "
        v = F.to_json(F.struct(value.alias("v"))).substr(F.lit(6), F.length(F.to_json(F.struct(value.alias("v")))) - 6) \
            if quoted else value
        parts += [F.lit(f'{sep}"{name}": '), v]
    parts.append(F.lit("}"))
    return rows.select(F.concat(*parts).alias("value"))
