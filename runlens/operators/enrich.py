"""Enrichment of prices and of the security directory (E-1 .. E-4).

The reference runs one database query per price row (symbol lookup) and per
snapshot record (existence test, back-fill); here each is one join.  The
security directory is a dimension table; joins against it are left to the
planner, and AQE broadcasts it from its measured size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import pc_change_expr

MISSING_SYMBOL = "-"


def first_symbol_per_name(companies: DataFrame) -> DataFrame:
    """The first listing (lowest id) of every name: the reference takes the
    first row its lookup returns, which in an insert-only table is the oldest."""
    return companies.groupBy("stock_name").agg(F.min_by("stock_symbol", "id").alias("_looked_up"))


def add_symbol(prices: DataFrame, companies: DataFrame, name_col: str = "stock_name") -> DataFrame:
    """E-1: ``stock_symbol`` by exact name match, ``'-'`` when there is none.
    The price-side name is not trimmed (the stored name is)."""
    firsts = first_symbol_per_name(companies).withColumnRenamed("stock_name", "_name")
    out = prices.join(firsts, prices[name_col] == firsts["_name"], "left")
    cols = [c for c in prices.columns if c != "stock_symbol"]
    pos = prices.columns.index("stock_symbol") if "stock_symbol" in prices.columns else len(cols)
    sym = F.coalesce(F.col("_looked_up"), F.lit(MISSING_SYMBOL)).alias("stock_symbol")
    ordered = [F.col(c) for c in cols]
    ordered.insert(pos, sym)
    return out.select(*ordered)


def flag_known(snapshot: DataFrame, companies: DataFrame, symbol_col: str = "symbol") -> DataFrame:
    """E-2: every snapshot record with ``known`` = its symbol is listed."""
    listed = (companies.select(F.col("stock_symbol").alias("_listed")).distinct()
              .withColumn("_hit", F.lit(True)))
    out = snapshot.join(listed, snapshot[symbol_col] == listed["_listed"], "left")
    return out.select(*snapshot.columns, F.coalesce(F.col("_hit"), F.lit(False)).alias("known"))


def known_symbols(snapshot: DataFrame, companies: DataFrame, symbol_col: str = "symbol") -> DataFrame:
    """E-2 as an existence test: records whose symbol is listed."""
    return snapshot.join(companies.select(F.col("stock_symbol").alias(symbol_col)), symbol_col, "left_semi")


def unknown_symbols(snapshot: DataFrame, companies: DataFrame, symbol_col: str = "symbol") -> DataFrame:
    """E-2 negated: records whose symbol is not listed."""
    return snapshot.join(companies.select(F.col("stock_symbol").alias(symbol_col)), symbol_col, "left_anti")


def add_pc_change(prices: DataFrame) -> DataFrame:
    """E-3: percent change from difference and previous price."""
    return prices.withColumn("pc_change", pc_change_expr("difference", "previous_price"))


def backfill_companies(companies: DataFrame, snapshot: DataFrame, sectors: DataFrame | None = None) -> DataFrame:
    """E-4: append every snapshot symbol missing from the directory, once.

    The name is the snapshot's (untrimmed) name of the symbol's first record;
    the sector comes from a symbol -> sector mapping (NULL when unmapped)
    instead of a console prompt.  New ids continue after the directory's
    largest id in snapshot order (``max(id) + snapshot id``), so the
    first-listing rule of E-1 still prefers older rows; no global sort needed.
    """
    firsts = snapshot.groupBy("symbol").agg(
        F.min("id").alias("_sid"), F.min_by("securityName", "id").alias("stock_name"))
    missing = unknown_symbols(firsts, companies)
    if sectors is not None:
        sec = sectors.groupBy("stock_symbol").agg(F.min("sector").alias("sector"))
        missing = missing.join(sec.withColumnRenamed("stock_symbol", "symbol"), "symbol", "left")
    else:
        missing = missing.withColumn("sector", F.lit(None).cast("string"))
    # Exactly one row: the directory's largest id (0 when empty).
    base = companies.agg(F.coalesce(F.max("id"), F.lit(0).cast("long")).alias("_base")).withColumn("_one", F.lit(1))
    added = missing.withColumn("_one", F.lit(1)).join(F.broadcast(base), "_one").select(
        (F.col("_base") + F.col("_sid")).cast("long").alias("id"),
        F.col("stock_name"),
        F.col("symbol").alias("stock_symbol"),
        F.col("sector"))
    return companies.select("id", "stock_name", "stock_symbol", "sector").unionByName(added)
