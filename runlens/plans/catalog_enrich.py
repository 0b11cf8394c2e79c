"""Registered queries: snapshot source and enrichment (I-9, E-1 .. E-4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import enrich
from ..session import scratch_path
from ..sources import fixtures as fx
from ..sources.snapshot import drifting_snapshot, read_snapshot, snapshot_parts, write_snapshot_lines
from . import oracle as O
from .catalog import F1, P1_ALL, as_output, f1_prices_all, f1_trades, register

SECTOR_CASE = ("CASE stock_symbol " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in fx.F4_SECTORS.items())
               + " END")

COMPANIES_F4 = f"""
sym AS (SELECT stock_symbol, min(id) AS first_id, max(id) AS last_id FROM trades GROUP BY stock_symbol),
companies AS (
  SELECT first_id AS id, upper(stock_symbol) || ' LTD' AS stock_name, stock_symbol, {SECTOR_CASE} AS sector
  FROM sym WHERE stock_symbol <> '{fx.F4_MISSING_SYMBOL}'
  UNION ALL
  SELECT last_id + 1 AS id, upper(stock_symbol) || ' LTD' AS stock_name, upper(stock_symbol) AS stock_symbol,
         {SECTOR_CASE} AS sector
  FROM sym WHERE stock_symbol <> '{fx.F4_MISSING_SYMBOL}')"""

SNAPSHOT_F5 = """
snap AS (
  SELECT 1300000 + p_partkey AS id, 'P' || CAST(p_partkey AS VARCHAR) AS symbol, p_name AS security_name,
         p_partkey, p_size, p_retailprice FROM part
  UNION ALL
  SELECT 1300000 + p_partkey + 100000, 'P' || CAST(p_partkey AS VARCHAR), p_name, p_partkey, p_size, p_retailprice
  FROM part WHERE p_size = 50)"""

COMPANIES_PARTS = """
comp AS (
  SELECT p_partkey AS id, p_name AS stock_name, 'P' || CAST(p_partkey AS VARCHAR) AS stock_symbol, p_brand AS sector
  FROM part WHERE p_size >= 10)"""


def _snapshot(spark, sf):
    """F5 written as JSON lines below the shared folder and read back (I-9)."""
    path = scratch_path(spark, "snapshot")
    write_snapshot_lines(fx.snapshot_json_lines(fx.table(spark, sf, "part")), path)
    return read_snapshot(spark, path)


@register("read_snapshot", O.with_ctes(SNAPSHOT_F5) + """
SELECT id, '2024-02-15' AS business_date, symbol, security_name,
       CASE WHEN p_size = 1 THEN 0.0 ELSE round(p_retailprice, 4) END AS previous_close,
       CASE WHEN p_size = 2 THEN 0.0 ELSE round(p_retailprice * 3, 2) END AS market_cap,
       CAST(p_size AS BIGINT) AS total_trades,
       '2024-02-15 10:' || lpad(CAST(p_partkey % 60 AS VARCHAR), 2, '0') || ':17.'
         || rpad(substr(lpad(CAST((p_partkey * 7919) % 1000000 AS VARCHAR), 6, '0'), 1, CAST(p_partkey % 3 + 4 AS INTEGER)),
                 6, '0') AS last_updated
FROM snap""")
def q_read_snapshot(spark, sf):
    s = _snapshot(spark, sf)
    return s.select(
        "id", F.date_format("businessDate", "yyyy-MM-dd").alias("business_date"), "symbol",
        F.col("securityName").alias("security_name"),
        F.col("previousDayClosePrice").cast("double").alias("previous_close"),
        F.col("marketCapitalization").cast("double").alias("market_cap"),
        F.col("totalTrades").alias("total_trades"),
        F.date_format("lastUpdatedTime", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("last_updated"))


@register("read_snapshot_prices", O.with_ctes(SNAPSHOT_F5) + """
SELECT id, CAST(p_partkey AS BIGINT) AS security_id, round(p_retailprice, 4) AS open_price,
       round(p_retailprice * 1.02, 4) AS high_price, round(p_retailprice * 0.98, 4) AS low_price,
       round(p_retailprice * 1.01, 4) AS close_price, CAST(p_size * 25 AS BIGINT) AS traded_quantity,
       round(p_retailprice * p_size * 25, 4) AS traded_value, round(p_retailprice * 1.5, 4) AS year_high,
       round(p_retailprice * 0.5, 4) AS year_low, round(p_retailprice * 1.01, 4) AS last_price,
       round(p_retailprice, 4) AS average_price
FROM snap""")
def q_read_snapshot_prices(spark, sf):
    names = {"openPrice": "open_price", "highPrice": "high_price", "lowPrice": "low_price", "closePrice": "close_price",
             "totalTradedQuantity": "traded_quantity", "totalTradedValue": "traded_value",
             "fiftyTwoWeekHigh": "year_high", "fiftyTwoWeekLow": "year_low", "lastUpdatedPrice": "last_price",
             "averageTradedPrice": "average_price"}
    s = _snapshot(spark, sf)
    return as_output(s.select("id", F.col("securityId").alias("security_id"),
                              *[F.col(k).alias(v) for k, v in names.items()]))


@register("snapshot_malformed", O.with_ctes(SNAPSHOT_F5) + "SELECT id, symbol, p_size = 3 AS bad FROM snap")
def q_snapshot_malformed(spark, sf):
    """Records of size-3 parts lose their closing brace; both parts come back."""
    path = scratch_path(spark, "snapshot-bad")
    lines = fx.snapshot_json_lines(fx.table(spark, sf, "part"))
    cut = F.when(F.contains("value", F.lit('"totalTrades": 3,')), F.expr("left(value, length(value) - 1)"))
    write_snapshot_lines(lines.select(F.coalesce(cut, "value").alias("value")), path)
    good, bad = snapshot_parts(spark, path)
    return good.select("id", "symbol", F.lit(False).alias("bad")).unionByName(bad.select(
        F.regexp_extract("value", r'"id": (\d+)', 1).cast("bigint").alias("id"),
        F.regexp_extract("value", r'"symbol": "([^"]*)"', 1).alias("symbol"), F.lit(True).alias("bad")))


@register("snapshot_drift", O.with_ctes(SNAPSHOT_F5) + """
SELECT id, symbol, CASE WHEN p_size <> 3 THEN CAST(p_size AS BIGINT) END AS total_trades,
       CASE WHEN p_size = 3 THEN 'three' END AS odd_trades, CASE WHEN p_size > 25 THEN CAST(p_size AS BIGINT) END AS lot,
       CASE WHEN p_size > 25 THEN 'B' || CAST(p_size AS VARCHAR) END AS board,
       CAST(CASE WHEN p_size > 25 THEN 2 ELSE 0 END + CASE WHEN p_size = 3 THEN 1 ELSE 0 END AS INTEGER) AS n_extra
FROM snap""")
def q_snapshot_drift(spark, sf):
    """Records of large parts hold two keys more, one of them nested; those of size-3
    parts a word for a count."""
    path = scratch_path(spark, "snapshot-drift")
    lines = fx.snapshot_json_lines(fx.table(spark, sf, "part"))
    trades = F.regexp_extract("value", r'"totalTrades": (\d+)', 1)
    more = F.concat(F.expr("left(value, length(value) - 1)"), F.lit(', "lotSize": '), trades,
                    F.lit(', "listing": {"board": "B'), trades, F.lit('"}}'))
    drift = F.when(trades == "3", F.replace("value", F.lit('"totalTrades": 3,'), F.lit('"totalTrades": "three",'))
                   ).when(trades.cast("int") > 25, more).otherwise(F.col("value"))
    write_snapshot_lines(lines.select(drift.alias("value")), path)
    extra = lambda key, at, kind: F.try_variant_get(F.try_element_at("extra", F.lit(key)), at, kind)
    return drifting_snapshot(spark, path).select(
        "id", "symbol", F.col("totalTrades").alias("total_trades"),
        extra("totalTrades", "$", "string").alias("odd_trades"), extra("lotSize", "$", "bigint").alias("lot"),
        extra("listing", "$.board", "string").alias("board"), F.size("extra").alias("n_extra"))


@register("symbol_lookup", O.with_ctes(F1, P1_ALL, COMPANIES_F4) + """
, firsts AS (SELECT stock_name AS name, arg_min(stock_symbol, id) AS sym FROM companies GROUP BY stock_name)
SELECT p.date, p.stock_name, coalesce(f.sym, '-') AS stock_symbol, p.num_trnx,
       CAST(p.closing_price AS DOUBLE) AS closing_price, p.pc_change
FROM prices p LEFT JOIN firsts f ON p.stock_name = f.name""")
def q_symbol_lookup(spark, sf):
    prices = f1_prices_all(spark, sf)
    companies = fx.companies_from_trades(f1_trades(spark, sf))
    out = enrich.add_symbol(prices, companies)
    return as_output(out.select("date", "stock_name", "stock_symbol", "num_trnx", "closing_price", "pc_change"))


@register("pc_change", O.with_ctes(F1, P1_ALL) + """
SELECT date, stock_name, stock_symbol, num_trnx, CAST(max_price AS DOUBLE) AS max_price,
       CAST(min_price AS DOUBLE) AS min_price, CAST(closing_price AS DOUBLE) AS closing_price,
       CAST(traded_shares AS DOUBLE) AS traded_shares, CAST(amount AS DOUBLE) AS amount,
       CAST(previous_price AS DOUBLE) AS previous_price, CAST(difference AS DOUBLE) AS difference, pc_change
FROM prices""")
def q_pc_change(spark, sf):
    return as_output(enrich.add_pc_change(f1_prices_all(spark, sf).drop("pc_change")))


@register("known_symbols", O.with_ctes(SNAPSHOT_F5, COMPANIES_PARTS) + """
SELECT s.id, s.symbol, EXISTS (SELECT 1 FROM comp c WHERE c.stock_symbol = s.symbol) AS known FROM snap s""")
def q_known_symbols(spark, sf):
    snap = _snapshot(spark, sf)
    comp = fx.companies_from_parts(fx.table(spark, sf, "part"))
    return enrich.flag_known(snap.select("id", "symbol"), comp)


def _existing(test):
    def run(spark, sf):
        snap = _snapshot(spark, sf).select("id", "symbol")
        return test(snap, fx.companies_from_parts(fx.table(spark, sf, "part"))).select("id", "symbol")
    return run


for _name, _test, _sql in (("known_only", enrich.known_symbols, "EXISTS"),
                           ("unknown_only", enrich.unknown_symbols, "NOT EXISTS")):
    register(_name, O.with_ctes(SNAPSHOT_F5, COMPANIES_PARTS) + f"""
SELECT s.id, s.symbol FROM snap s WHERE {_sql} (SELECT 1 FROM comp c WHERE c.stock_symbol = s.symbol)""")(
        _existing(_test))


@register("backfill_companies", O.with_ctes(SNAPSHOT_F5, COMPANIES_PARTS) + """
, firsts AS (SELECT symbol, min(id) AS sid, arg_min(security_name, id) AS name FROM snap GROUP BY symbol),
missing AS (SELECT * FROM firsts f WHERE NOT EXISTS (SELECT 1 FROM comp c WHERE c.stock_symbol = f.symbol)),
sectors AS (
  SELECT 'P' || CAST(p_partkey AS VARCHAR) AS stock_symbol, min(split_part(p_type, ' ', 1)) AS sector
  FROM part WHERE p_type LIKE 'STANDARD%' OR p_type LIKE 'PROMO%' GROUP BY 1),
base AS (SELECT coalesce(max(id), 0) AS mx FROM comp)
SELECT id, stock_name, stock_symbol, sector FROM comp
UNION ALL
SELECT base.mx + m.sid AS id, m.name AS stock_name, m.symbol AS stock_symbol, s.sector
FROM missing m LEFT JOIN sectors s ON s.stock_symbol = m.symbol, base""")
def q_backfill_companies(spark, sf):
    part = fx.table(spark, sf, "part")
    return enrich.backfill_companies(fx.companies_from_parts(part), _snapshot(spark, sf),
                                     fx.sector_map_from_parts(part))
