"""Typed extraction of trade, price and company pages (I-5 .. I-8, I-12).

Each parser returns one DataFrame with a boolean ``bad`` column: a row is bad
when a cell is missing or a number cell does not parse (``try_cast``; ANSI
casts would fail the job), and a page without its table or without data rows is
one bad row that says so.  ``split_bad`` turns it into (good, quarantined).
The reference aborts a load half-way on the first bad cell; here the good
rows load and the bad ones are kept for inspection.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import pc_change_expr
from ..sources import pages as P

MONEY = "decimal(18,4)"


def _cell(i: int) -> Column:
    return F.get(F.col("cells"), i)


def _num(i: int, to: str) -> Column:
    return F.trim(_cell(i)).try_cast(to)


def _raw() -> Column:
    """What the quarantine shows of a row: its cells, or why its page has none."""
    return F.coalesce(F.array_join(F.col("cells"), "|"), F.col("problem")).alias("raw")


# Layout of a trade id: day, 10^6 pages, 10^5 rows a page.
PAGES_PER_DAY, ROWS_PER_PAGE = 1_000_000, 100_000


def _undated() -> Column:
    return ~F.coalesce(F.col("date").rlike(r"^\d{4}-\d{2}-\d{2}$"), F.lit(False))


def dated(pages: DataFrame) -> DataFrame:
    """I-3 / I-4: pages that landed without a date get the one they show."""
    return pages.withColumn("date", F.coalesce(F.col("date"), P.page_date(F.col("html"))))


def one_landing(pages: DataFrame) -> DataFrame:
    """One page per (date, page_no) of those that landed more than once: the newest by
    the column ``landed`` where there is one (then by url and html, as without it).
    Pages without a date or number all stay, for the quarantine, and are dealt over
    all tasks."""
    newest = [F.desc_nulls_last("landed")] if "landed" in pages.columns else []
    alone = _undated() | F.col("page_no").isNull()
    deal = F.when(alone, F.xxhash64("url", "html")).otherwise(F.lit(0))
    w = Window.partitionBy("date", "page_no", "_deal").orderBy(*newest, F.desc_nulls_last("url"), F.desc_nulls_last("html"))
    return (pages.withColumn("_deal", deal).withColumn("_landing", F.row_number().over(w))
            .filter((F.col("_landing") == 1) | alone).drop("_landing", "_deal", *(["landed"] if newest else [])))


def _bad(checks: list[Column]) -> Column:
    bad = _undated()
    for c in checks:
        bad = bad | c.isNull()
    return bad


def parse_trade_pages(pages: DataFrame, date_from_page: bool = False) -> DataFrame:
    """I-5 + I-8: trade rows of landed pages.

    Cells: 0 row no. (ignored), 1 contract no., 2 symbol, 3 buyer, 4 seller,
    5 quantity (int), 6 rate, 7 amount.  ``date`` is the landed page's date, or
    with ``date_from_page`` the date shown on the page (I-3).
    """
    src = pages
    if date_from_page:
        src = src.withColumn("date", P.page_date(F.col("html")))
    rows = P.table_rows(src, P.TRADE_TABLE_CLASS, P.TRADE_ROW_SLICE, keep=["date", "page_no"])
    typed = rows.select(
        "date", "page_no", "pos",
        _num(1, "bigint").alias("contract_no"),
        _cell(2).alias("stock_symbol"), _cell(3).alias("buyer"), _cell(4).alias("seller"),
        _num(5, "int").alias("quantity"), _num(6, MONEY).alias("rate"), _num(7, MONEY).alias("amount"),
        _raw())
    checks = [F.col(c) for c in ("stock_symbol", "buyer", "seller", "quantity", "rate", "amount")]
    outside = ~F.coalesce(F.col("page_no").between(0, PAGES_PER_DAY - 1) & (F.col("pos") < ROWS_PER_PAGE),
                          F.lit(False))
    return typed.withColumn("bad", _bad(checks) | outside)


def parse_price_pages(pages: DataFrame, date_from_page: bool = False) -> DataFrame:
    """I-6 + I-8: cells 0 no. (int), 1 name, 2 trades (int), 3..9 prices.
    ``date`` as in ``parse_trade_pages`` (I-4)."""
    if date_from_page:
        pages = pages.withColumn("date", P.page_date(F.col("html")))
    rows = P.table_rows(pages, P.PRICE_TABLE_CLASS, P.PRICE_ROW_SLICE, keep=["date", "page_no"])
    names = ["max_price", "min_price", "closing_price", "traded_shares", "amount", "previous_price", "difference"]
    typed = rows.select(
        "date", "page_no", "pos",
        _num(0, "int").alias("no"),
        _cell(1).alias("stock_name"),
        _num(2, "bigint").alias("num_trnx"),
        *[_num(3 + i, MONEY).alias(n) for i, n in enumerate(names)],
        _raw())
    checks = [F.col(c) for c in ("no", "stock_name", "num_trnx", *names)]
    return typed.withColumn("bad", _bad(checks))


def parse_company_pages(pages: DataFrame) -> DataFrame:
    """I-7 + I-8: cell 0 no. (int), 2 name (newlines removed, trimmed),
    3 symbol, 4 sector."""
    rows = P.table_rows(pages, P.COMPANY_TABLE_CLASS, P.COMPANY_ROW_SLICE, keep=["date", "page_no"])
    typed = rows.select(
        "date", "page_no", "pos",
        _num(0, "bigint").alias("no"),
        F.regexp_replace(F.replace(_cell(2), F.lit("\n"), F.lit("")), r"^\s+|\s+$", "").alias("stock_name"),
        _cell(3).alias("stock_symbol"), _cell(4).alias("sector"),
        _raw())
    checks = [F.col(c) for c in ("no", "stock_name", "stock_symbol", "sector")]
    return typed.withColumn("bad", _bad(checks))


def split_bad(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows without ``bad``/``raw``, quarantined rows)."""
    good = parsed.filter(~F.col("bad")).drop("bad", "raw")
    bad = parsed.filter(F.col("bad")).drop("bad")
    return good, bad


def trade_id(date: Column, page_no: Column, pos: Column) -> Column:
    """I-12: arrival-order surrogate key without a global sort:
    ``yyyymmdd * 10^11 + page_no * 10^5 + pos``: 10^6 pages a day of 10^5 rows.
    ``parse_trade_pages`` quarantines rows outside that layout."""
    day = F.regexp_replace(date, "-", "").try_cast("bigint")
    return day * F.lit(PAGES_PER_DAY * ROWS_PER_PAGE) + page_no.cast("bigint") * F.lit(ROWS_PER_PAGE) + pos.cast("bigint")


def with_trade_ids(good_trades: DataFrame) -> DataFrame:
    """Trades table rows (schema TRADES) from parsed good rows."""
    return good_trades.select(
        trade_id(F.col("date"), F.col("page_no"), F.col("pos")).alias("id"),
        "date", "stock_symbol", "buyer", "seller", "quantity", "rate", "amount")


def arrival_ids(rows: DataFrame, last: int = 0) -> DataFrame:
    """I-13 / I-14: ``id`` = ``last`` + 1, 2, ... in the order of (date, page_no, pos).

    Rows are numbered inside their page; pages are counted, and the counts added up
    inside a day and over the days.  So the rows move once, by page, and no window sees
    more than a page's rows, a day's pages or one row per day of the load."""
    ahead = (Window.unboundedPreceding, -1)
    pages = rows.groupBy("date", "page_no").agg(F.count("*").alias("_n"))
    days = pages.groupBy("date").agg(F.sum("_n").alias("_n")).select(
        "date", F.coalesce(F.sum("_n").over(Window.orderBy("date").rowsBetween(*ahead)), F.lit(0)).alias("_day"))
    before = F.sum("_n").over(Window.partitionBy("date").orderBy("page_no").rowsBetween(*ahead))
    base = (pages.select("date", "page_no", F.coalesce(before, F.lit(0)).alias("_page")).join(days, "date")
            .select("date", "page_no", (F.col("_page") + F.col("_day")).alias("_base")))
    place = F.row_number().over(Window.partitionBy("date", "page_no").orderBy("pos"))
    return (rows.withColumn("_place", place).join(base, ["date", "page_no"])
            .withColumn("id", (F.lit(int(last)) + F.col("_base") + F.col("_place")).cast("bigint"))
            .drop("_place", "_base"))


def prices_table(good_prices: DataFrame, companies: DataFrame) -> DataFrame:
    """Price rows with symbol lookup (E-1), percent change (E-3) and, where they have
    been numbered, their id."""
    from .enrich import add_symbol
    number = ["id"] if "id" in good_prices.columns else []
    withsym = add_symbol(good_prices.withColumn("stock_symbol", F.lit(None).cast("string")), companies)
    return withsym.select(
        *number, "date", "stock_name", "stock_symbol", "num_trnx", "max_price", "min_price", "closing_price",
        "traded_shares", "amount", "previous_price", "difference",
        pc_change_expr("difference", "previous_price").alias("pc_change"))
