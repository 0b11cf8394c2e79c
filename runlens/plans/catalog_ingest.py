"""Registered queries: extraction and loads (I-1 .. I-16, C-10, stream load).

Pages are rendered by Spark from the supplied tables (F6; the supplied
``pages`` table holds no exchange tables), then extracted and loaded; every
result is checked against plain SQL over the same tables.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import compare as cmp
from ..operators import ingest as I
from ..operators import run_store
from ..session import scratch_path
from ..sources import fixtures as fx
from ..sources import pages as P
from ..sources import publish, store
from ..streaming.pages_stream import read_streamed_trades, start_page_stream
from . import oracle as O
from .catalog import END, F1, N_ALL, P1_ALL, START, SYMBOL, COMPARE_ALL_SQL, as_output, f1_prices, f1_prices_all, f1_trades, register
from .catalog_enrich import COMPANIES_F4, COMPANIES_PARTS

PAGE_SIZE = 100          # trades per page in the fixtures (the exchange serves up to 10,000)
LOST_PAGE = 2            # page number that never landed, per day, in the coverage check
DELETED_DAY = "2024-01-10"
UNREADABLE_DAY = "2024-01-11"   # day whose only landed page holds no readable pager
STALE_MIN_SIZE = 30      # the stale directory load before a refresh keeps larger parts only

PAGED = f"""
paged AS (SELECT t.*, id // {PAGE_SIZE} AS block FROM trades t),
paged2 AS (
  SELECT *, CAST(block - min(block) OVER (PARTITION BY date) + 1 AS INTEGER) AS page_no,
         CAST(max(block) OVER (PARTITION BY date) - min(block) OVER (PARTITION BY date) + 1 AS INTEGER) AS pages,
         CAST(row_number() OVER (PARTITION BY date, block ORDER BY id) - 1 AS INTEGER) AS pos
  FROM paged)"""
SQL_PAGED = O.with_ctes(F1, PAGED)
NEW_ID = "CAST(replace(date, '-', '') AS BIGINT) * 100000000000 + CAST(page_no AS BIGINT) * 100000 + pos"


def trade_pages(spark, sf, malformed=False):
    return P.render_trade_pages(f1_trades(spark, sf), PAGE_SIZE, malformed=malformed)


@register("page_date", SQL_PAGED + "SELECT DISTINCT date, page_no, date AS page_date FROM paged2")
def q_page_date(spark, sf):
    pages = trade_pages(spark, sf)
    return pages.select("date", "page_no", P.page_date(F.col("html")).alias("page_date"))


@register("page_count", SQL_PAGED + "SELECT DISTINCT date, pages FROM paged2")
def q_page_count(spark, sf):
    return P.page_count(trade_pages(spark, sf))


@register("missing_pages", SQL_PAGED + f"SELECT DISTINCT date, {LOST_PAGE} AS page_no FROM paged2 WHERE pages >= {LOST_PAGE}")
def q_missing_pages(spark, sf):
    pages = trade_pages(spark, sf)
    landed = pages.filter(F.col("page_no") != LOST_PAGE)
    return P.missing_pages(landed, P.page_count(landed))


@register("parse_trade_pages", SQL_PAGED + """
SELECT date, page_no, pos, id AS contract_no, stock_symbol, buyer, seller, quantity,
       CAST(rate AS DOUBLE) AS rate, CAST(amount AS DOUBLE) AS amount
FROM paged2""")
def q_parse_trade_pages(spark, sf):
    good, _ = I.split_bad(I.parse_trade_pages(trade_pages(spark, sf), date_from_page=True))
    return as_output(good)


@register("quarantine_bad_rows", SQL_PAGED + """
SELECT date, page_no, pos, id AS contract_no FROM paged2
WHERE quantity = 99 OR (quantity = 100 AND amount >= 1000)""")
def q_quarantine(spark, sf):
    _, bad = I.split_bad(I.parse_trade_pages(trade_pages(spark, sf, malformed=True)))
    return bad.select("date", "page_no", "pos", "contract_no")


@register("assign_trade_id", SQL_PAGED + f"SELECT {NEW_ID} AS id, id AS contract_no FROM paged2")
def q_assign_trade_id(spark, sf):
    good, _ = I.split_bad(I.parse_trade_pages(trade_pages(spark, sf)))
    return good.select(I.trade_id(F.col("date"), F.col("page_no"), F.col("pos")).alias("id"), "contract_no")


LOADED_SQL = SQL_PAGED + f"""
SELECT {NEW_ID} AS id, date, stock_symbol, buyer, seller, quantity, CAST(rate AS DOUBLE) AS rate,
       CAST(amount AS DOUBLE) AS amount
FROM paged2"""


def _load_trades(spark, sf):
    path = scratch_path(spark, "trades")
    good, _ = I.split_bad(I.parse_trade_pages(trade_pages(spark, sf)))
    store.load_days(I.with_trade_ids(good), path, "trades")
    return path


@register("load_trades", LOADED_SQL)
def q_load_trades(spark, sf):
    return as_output(store.read_table(spark, _load_trades(spark, sf), "trades"))


def _good_pages(pages):
    return I.with_trade_ids(I.split_bad(I.parse_trade_pages(I.one_landing(pages)))[0])


@register("load_trades_in_parts", LOADED_SQL)
def q_load_trades_in_parts(spark, sf):
    """Two loads of the same days: the second keeps the first one's pages."""
    path, pages = scratch_path(spark, "trades-parts"), trade_pages(spark, sf)
    store.append_days(_good_pages(pages.filter(F.col("page_no") % 2 == 1)), path, "trades")
    store.append_days(_good_pages(pages.filter(F.col("page_no") % 2 == 0)), path, "trades")
    return as_output(store.read_table(spark, path, "trades"))


@register("load_trades_relanded", LOADED_SQL)
def q_load_trades_relanded(spark, sf):
    """The first pages land twice in one load and once more in a later one."""
    path, pages = scratch_path(spark, "trades-relanded"), trade_pages(spark, sf)
    again = pages.filter(F.col("page_no") == 1)
    store.append_days(_good_pages(pages.unionByName(again)), path, "trades")
    store.append_days(_good_pages(again), path, "trades")
    return as_output(store.read_table(spark, path, "trades"))


@register("trade_id_many_pages", SQL_PAGED + f"SELECT {NEW_ID.replace('page_no', 'page_no + 9999')} AS id, "
          "id AS contract_no FROM paged2")
def q_trade_id_many_pages(spark, sf):
    pages = trade_pages(spark, sf).withColumn("page_no", F.col("page_no") + 9999)
    good, _ = I.split_bad(I.parse_trade_pages(pages))
    return good.select(I.trade_id(F.col("date"), F.col("page_no"), F.col("pos")).alias("id"), "contract_no")


@register("quarantine_undated", SQL_PAGED + "SELECT page_no, pos, id AS contract_no FROM paged2 WHERE page_no = 1")
def q_quarantine_undated(spark, sf):
    html = F.when(F.col("page_no") == 1, F.replace("html", F.lit(P.DATE_DIV_CLASS), F.lit("other")))
    pages = trade_pages(spark, sf).withColumn("html", F.coalesce(html, "html"))
    _, bad = I.split_bad(I.parse_trade_pages(pages, date_from_page=True))
    return bad.select("page_no", "pos", "contract_no")


@register("missing_pages_no_pager", SQL_PAGED + f"SELECT DISTINCT date, {LOST_PAGE} AS page_no FROM paged2 WHERE pages > {LOST_PAGE}")
def q_missing_pages_no_pager(spark, sf):
    """The first page's pager holds no link: the day's other pages tell."""
    pager = F.regexp_replace("html", r'(<div class="pager">).*?</div>', "$1</div>")
    pages = trade_pages(spark, sf).filter(F.col("page_no") != LOST_PAGE)
    landed = pages.withColumn("html", F.when(F.col("page_no") == 1, pager).otherwise(F.col("html")))
    return P.missing_pages(landed, P.page_count(landed))


@register("page_gaps", SQL_PAGED + f"""
, kept AS (SELECT DISTINCT date, page_no, pages FROM paged2
           WHERE page_no NOT IN ({LOST_PAGE}, {LOST_PAGE + 1}) AND date NOT IN ('{DELETED_DAY}', '{UNREADABLE_DAY}')),
lost AS (SELECT DISTINCT p.date, p.page_no FROM paged2 p ANTI JOIN kept k ON p.date = k.date AND p.page_no = k.page_no
         WHERE p.date NOT IN ('{DELETED_DAY}', '{UNREADABLE_DAY}')),
islands AS (SELECT *, page_no - row_number() OVER (PARTITION BY date ORDER BY page_no) AS island FROM lost)
SELECT date, CAST(min(page_no) AS INTEGER) AS first_page, CAST(max(page_no) AS INTEGER) AS last_page, 'pages lost' AS reason
FROM islands GROUP BY date, island
UNION ALL SELECT DISTINCT date, 1, CAST(NULL AS INTEGER), 'no page landed' FROM paged2 WHERE date = '{DELETED_DAY}'
UNION ALL SELECT date, 2, NULL, 'no readable pager' FROM paged2 WHERE date = '{UNREADABLE_DAY}' GROUP BY date""")
def q_page_gaps(spark, sf):
    """Two pages of every day are lost; of one day none landed, of another only the
    first, whose pager cannot be read.  The calendar is the trading days."""
    pager = F.regexp_replace("html", r'(<div class="pager">).*?</div>', "$1</div>")
    pages = trade_pages(spark, sf)
    unreadable = F.col("date") == UNREADABLE_DAY
    landed = (pages.filter(F.when(unreadable, F.col("page_no") == 1).otherwise(
        ~F.col("page_no").isin(LOST_PAGE, LOST_PAGE + 1) & (F.col("date") != DELETED_DAY)))
        .withColumn("html", F.when(unreadable, pager).otherwise(F.col("html"))))
    return P.page_gaps(landed, P.page_count(landed), f1_trades(spark, sf).select("date"))


@register("missing_pages_zero", SQL_PAGED + f"SELECT DISTINCT date, {LOST_PAGE} AS page_no FROM paged2 "
          f"WHERE pages >= {LOST_PAGE} AND date <> '{DELETED_DAY}'")
def q_missing_pages_zero(spark, sf):
    """One day's pager reports 0 pages: nothing of it is missing."""
    none = F.regexp_replace("html", r'(<div class="pager"><a href="#">\d+/)\d+', "$10")   # group 1, then 0
    pages = trade_pages(spark, sf).filter(F.col("page_no") != LOST_PAGE)
    landed = pages.withColumn("html", F.when(F.col("date") == DELETED_DAY, none).otherwise(F.col("html")))
    return P.missing_pages(landed, P.page_count(landed))


@register("create_table", LOADED_SQL)
def q_create_table(spark, sf):
    """An empty table, then an append; making it again leaves it as it is."""
    path = scratch_path(spark, "trades-made")
    store.create_table(spark, path, "trades")
    store.append_days(_good_pages(trade_pages(spark, sf)), path, "trades")
    store.create_table(spark, path, "trades")
    return as_output(store.read_table(spark, path, "trades"))


@register("price_page_date", O.with_ctes(F1, P1_ALL) + "SELECT DISTINCT date FROM prices")
def q_price_page_date(spark, sf):
    pages = P.render_price_pages(f1_prices_all(spark, sf)).withColumn("date", F.lit(None).cast("string"))
    return I.split_bad(I.parse_price_pages(pages, date_from_page=True))[0].select("date").distinct()


@register("delete_day", LOADED_SQL + f" WHERE date <> '{DELETED_DAY}'")
def q_delete_day(spark, sf):
    path = _load_trades(spark, sf)
    store.delete_day(spark, path, DELETED_DAY)
    return as_output(store.read_table(spark, path, "trades"))


@register("stream_load_trades", LOADED_SQL)
def q_stream_load_trades(spark, sf):
    landing = scratch_path(spark, "landing")
    # Pages land as files (one file per rendering task); the stream picks them up.
    trade_pages(spark, sf).write.mode("overwrite").parquet(landing)
    table, quarantine = scratch_path(spark, "stream-trades"), scratch_path(spark, "stream-quarantine")
    q = start_page_stream(spark, landing, table, quarantine, scratch_path(spark, "stream-ckpt"),
                          available_now=True, max_files_per_trigger=4)
    q.awaitTermination()
    return as_output(read_streamed_trades(spark, table))


@register("stream_relanded", LOADED_SQL)
def q_stream_relanded(spark, sf):
    """Pages that land again in a later batch count once."""
    landing = scratch_path(spark, "landing-again")
    pages = trade_pages(spark, sf)
    at = [scratch_path(spark, f"stream-again-{n}") for n in ("trades", "bad", "ckpt")]
    for rows in (pages, pages.filter(F.col("page_no") == 1)):
        rows.write.mode("append").parquet(landing)
        start_page_stream(spark, landing, *at, available_now=True).awaitTermination()
    return as_output(read_streamed_trades(spark, at[0]))


PRICE_COLS = ("max_price", "min_price", "closing_price", "traded_shares", "amount", "previous_price", "difference")


@register("parse_price_pages", O.with_ctes(F1, P1_ALL) + "SELECT date, stock_name, num_trnx, "
          + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in PRICE_COLS) + " FROM prices")
def q_parse_price_pages(spark, sf):
    good, _ = I.split_bad(I.parse_price_pages(P.render_price_pages(f1_prices_all(spark, sf))))
    return as_output(good.select("date", "stock_name", "num_trnx", *PRICE_COLS))


@register("load_prices", O.with_ctes(F1, P1_ALL, COMPANIES_F4) + """
, firsts AS (SELECT stock_name AS name, arg_min(stock_symbol, id) AS sym FROM companies GROUP BY stock_name)
SELECT p.date, p.stock_name, coalesce(f.sym, '-') AS stock_symbol, p.num_trnx,
       CAST(p.closing_price AS DOUBLE) AS closing_price, CAST(p.previous_price AS DOUBLE) AS previous_price,
       CAST(p.difference AS DOUBLE) AS difference, p.pc_change
FROM prices p LEFT JOIN firsts f ON p.stock_name = f.name""")
def q_load_prices(spark, sf):
    good, _ = I.split_bad(I.parse_price_pages(P.render_price_pages(f1_prices_all(spark, sf))))
    companies = fx.companies_from_trades(f1_trades(spark, sf))
    path = scratch_path(spark, "prices")
    store.load_days(I.prices_table(good, companies), path, "prices")
    out = store.read_table(spark, path, "prices")
    return as_output(out.select("date", "stock_name", "stock_symbol", "num_trnx", "closing_price",
                                "previous_price", "difference", "pc_change"))


@register("load_prices_quarantine", O.with_ctes(F1, P1_ALL) + f"""
SELECT date, stock_name, stock_symbol = '{SYMBOL}' AS bad FROM prices""")
def q_load_prices_quarantine(spark, sf):
    """Rows of one security have no number of trades; both parts come back."""
    known = F.when(F.col("stock_symbol") != SYMBOL, F.col("num_trnx"))
    pages = P.render_price_pages(f1_prices_all(spark, sf).withColumn("num_trnx", known))
    return I.parse_price_pages(pages).select("date", "stock_name", "bad")


COMPANY_SQL = O.with_ctes(COMPANIES_PARTS.replace(" WHERE p_size >= 10", "")) + "SELECT id, stock_name, stock_symbol, sector FROM comp"


def _company_pages(spark, sf, min_size=0):
    return P.render_company_pages(fx.companies_from_parts(fx.table(spark, sf, "part"), min_size), "2024-02-15")


def _parsed_companies(pages):
    good, _ = I.split_bad(I.parse_company_pages(pages))
    return good.select(F.col("no").alias("id"), "stock_name", "stock_symbol", "sector")


@register("parse_company_pages", COMPANY_SQL)
def q_parse_company_pages(spark, sf):
    return _parsed_companies(_company_pages(spark, sf))


@register("company_names_messy", COMPANY_SQL)
def q_company_names_messy(spark, sf):
    """Names with numeric entities, between carriage returns and tabs."""
    companies = fx.companies_from_parts(fx.table(spark, sf, "part"), 0)
    coded = companies.withColumn("stock_name", F.replace("stock_name", F.lit(" "), F.lit("&#32;")))
    pages = P.render_company_pages(coded, "2024-02-15")
    return _parsed_companies(pages.withColumn("html", F.replace("html", F.lit("\n  "), F.lit("\r\n\t"))))


@register("refresh_companies", COMPANY_SQL)
def q_refresh_companies(spark, sf):
    path = scratch_path(spark, "companies")
    store.refresh(_parsed_companies(_company_pages(spark, sf, STALE_MIN_SIZE)), path, "companies")
    store.refresh(_parsed_companies(_company_pages(spark, sf)), path, "companies")
    return store.read_table(spark, path, "companies")


@register("append_companies", O.with_ctes(COMPANIES_PARTS.replace(" WHERE p_size >= 10", "")) + """
SELECT (id // 400 - (SELECT min(id // 400) FROM comp) + 1) * 100000
         + row_number() OVER (PARTITION BY id // 400 ORDER BY id) AS id, stock_name, stock_symbol, sector
FROM comp""")
def q_append_companies(spark, sf):
    path = scratch_path(spark, "companies-append")
    store.create_table(spark, path, "companies")
    store.append_companies(I.split_bad(I.parse_company_pages(_company_pages(spark, sf)))[0], path)
    return store.read_table(spark, path, "companies")


@register("write_report", f"SELECT *, '{START}_{END}' AS period FROM ({COMPARE_ALL_SQL}) r")
def q_write_report(spark, sf):
    report = cmp.compare_all(f1_trades(spark, sf), f1_prices(spark, sf), START, END, N_ALL)
    path = scratch_path(spark, "reports")
    store.write_report(report, path, f"{START}_{END}")
    return store.read_report(spark, path, report.schema)


@register("write_workbook", f"SELECT *, '{START}_{END}' AS period FROM ({COMPARE_ALL_SQL}) r")
def q_write_workbook(spark, sf):
    """C-10 as a workbook per period, written twice and read back from its sheet."""
    report = cmp.compare_all(f1_trades(spark, sf), f1_prices(spark, sf), START, END, N_ALL)
    path = scratch_path(spark, "workbooks")
    for _ in range(2):
        store.write_report(report, path, f"{START}_{END}", "xlsx")
    return store.read_report(spark, path, report.schema, "xlsx")


@register("delete_price_day", O.with_ctes(F1, P1_ALL) + f"""
SELECT date, stock_name, stock_symbol, num_trnx, CAST(closing_price AS DOUBLE) AS closing_price, pc_change
FROM prices WHERE date <> '{DELETED_DAY}'""")
def q_delete_price_day(spark, sf):
    """I-16 on the price table (where the reference deletes a day): load the
    daily prices partitioned by date, drop one day, read back."""
    path = scratch_path(spark, "prices-del")
    store.load_days(f1_prices_all(spark, sf), path, "prices")
    store.delete_day(spark, path, DELETED_DAY)
    out = store.read_table(spark, path, "prices")
    return as_output(out.select("date", "stock_name", "stock_symbol", "num_trnx", "closing_price", "pc_change"))


# -- nested markup, quarantine of pages and loads

NESTED_QTY = "99"        # quantity of the trades whose row holds a table of its own

@register("parse_nested_tables", SQL_PAGED + f"""
, rows AS (
  SELECT date, page_no, id, 0 AS inner_row, id AS contract_no, stock_symbol, buyer, seller, quantity,
         CAST(rate AS DOUBLE) AS rate, CAST(amount AS DOUBLE) AS amount FROM paged2
  UNION ALL SELECT date, page_no, id, 1, 0, 'IN', '7', '8', 1, 2.5, 2.5 FROM paged2 WHERE quantity = {NESTED_QTY})
SELECT date, page_no, CAST(row_number() OVER (PARTITION BY date, page_no ORDER BY id, inner_row) - 1 AS INTEGER) AS pos,
       contract_no, stock_symbol, buyer, seller, quantity, rate, amount FROM rows""")
def q_parse_nested_tables(spark, sf):
    """A table inside a last cell: its rows are rows, and the outer table goes on
    behind it; the class attribute has more blanks than words."""
    inner = "".join(f"<td>{c}</td>" for c in ("n", "0", "IN", "7", "8", "1", "2.5", "2.5"))
    nested = F.regexp_replace("html", f"(<td>{NESTED_QTY}</td><td>[^<]*</td><td>[^<]*</td>)</tr>",
                              f'$1<td><table class="x"><tr>{inner}</tr></table></td></tr>')
    html = F.replace(nested, F.lit(f'"{P.TRADE_TABLE_CLASS}"'), F.lit('"table  my-table "'))
    good, _ = I.split_bad(I.parse_trade_pages(trade_pages(spark, sf).withColumn("html", html)))
    return as_output(good)


@register("quarantine_no_table", SQL_PAGED + f"""
SELECT DISTINCT date, page_no, CASE WHEN page_no = 1 THEN '{P.NO_TABLE}' ELSE '{P.NO_ROWS}' END AS raw
FROM paged2 WHERE page_no <= 2""")
def q_quarantine_no_table(spark, sf):
    """Each day's first page has another table, its second one no rows."""
    html = (F.when(F.col("page_no") == 1, F.replace("html", F.lit(P.TRADE_TABLE_CLASS), F.lit("other")))
            .when(F.col("page_no") == 2, F.regexp_replace("html", "(?s)(my-table\">).*(</table>)", "$1$2"))
            .otherwise(F.col("html")))
    _, bad = I.split_bad(I.parse_trade_pages(trade_pages(spark, sf).withColumn("html", html)))
    return bad.select("date", "page_no", "raw")


@register("quarantine_two_loads", SQL_PAGED + """
SELECT date, page_no, pos, id AS contract_no FROM paged2
WHERE (quantity = 99 OR (quantity = 100 AND amount >= 1000)) AND page_no % 2 = 1""")
def q_quarantine_two_loads(spark, sf):
    """The odd pages land malformed, then the even ones well: the first load's bad rows
    are still there."""
    path = scratch_path(spark, "quarantine")
    odd = I.parse_trade_pages(trade_pages(spark, sf, malformed=True).filter("page_no % 2 = 1"))
    even = I.parse_trade_pages(trade_pages(spark, sf).filter("page_no % 2 = 0"))
    for parsed in (odd, even):
        store.keep_parsed(parsed, path)
    return store.read_quarantine(spark, path, odd.schema).select("date", "page_no", "pos", "contract_no")


# -- dates of the page, newest landing

@register("load_trades_page_date", LOADED_SQL)
def q_load_trades_page_date(spark, sf):
    """Pages that landed without a date load under the one they show."""
    undated = trade_pages(spark, sf).withColumn("date", F.when(F.col("page_no") % 2 == 0, F.col("date")))
    path = scratch_path(spark, "trades-undated")
    store.load_days(_good_pages(I.dated(undated)), path, "trades")
    return as_output(store.read_table(spark, path, "trades"))


@register("stream_page_date", LOADED_SQL)
def q_stream_page_date(spark, sf):
    landing = scratch_path(spark, "landing-undated")
    trade_pages(spark, sf).withColumn("date", F.lit(None).cast("string")).write.parquet(landing)
    at = [scratch_path(spark, f"stream-undated-{n}") for n in ("trades", "bad", "ckpt")]
    start_page_stream(spark, landing, *at, available_now=True).awaitTermination()
    return as_output(read_streamed_trades(spark, at[0]))


@register("newest_landing", SQL_PAGED + f"SELECT {NEW_ID} AS id, quantity FROM paged2")
def q_newest_landing(spark, sf):
    """Each page landed twice, the older time with a larger url and other quantities."""
    pages = trade_pages(spark, sf)
    older = pages.select("date", "page_no", F.lit("zzz").alias("url"),
                         F.regexp_replace("html", "<td>9", "<td>8").alias("html"), F.lit(1).alias("landed"))
    return _good_pages(pages.withColumn("landed", F.lit(2)).unionByName(older)).select("id", "quantity")


# -- published tables and ids in arrival order

@register("published_append", LOADED_SQL)
def q_published_append(spark, sf):
    """Loads of the odd pages, of the first page again and of the even pages: three
    versions, each swapped in whole."""
    path, pages = scratch_path(spark, "trades-published"), trade_pages(spark, sf)
    for part in ("page_no % 2 = 1", "page_no = 1", "page_no % 2 = 0"):
        publish.publish_append(_good_pages(pages.filter(part)), path, "trades")
    return as_output(publish.read_published(spark, path, "trades"))


@register("published_unswapped", LOADED_SQL + f" WHERE date <> '{DELETED_DAY}'")
def q_published_unswapped(spark, sf):
    """A load that is written but never swapped in (it died) is not seen; a day is taken
    out, and the folders that no version names are deleted."""
    path, good = scratch_path(spark, "trades-unswapped"), _good_pages(trade_pages(spark, sf))
    publish.publish_days(good, path, "trades")
    publish.stage(good.limit(10), path, "trades")
    publish.unpublish_day(spark, path, DELETED_DAY)
    publish.vacuum(spark, path)
    return as_output(publish.read_published(spark, path, "trades"))


@register("load_companies_appended", O.with_ctes(COMPANIES_PARTS.replace(" WHERE p_size >= 10", "")) + f"""
, loads AS (SELECT 2 AS load, * FROM comp UNION ALL SELECT 1, * FROM comp WHERE sector IN (
  SELECT sector FROM comp GROUP BY sector ORDER BY sector LIMIT 2))
SELECT row_number() OVER (ORDER BY load, loads.id) AS id, stock_name, stock_symbol, sector FROM loads""")
def q_load_companies_appended(spark, sf):
    """Two sectors' listings, then all of them: ids go on densely from the largest."""
    path, companies = scratch_path(spark, "companies-ids"), fx.companies_from_parts(fx.table(spark, sf, "part"), 0)
    two = companies.select("sector").distinct().orderBy("sector").limit(2)
    for rows in (companies.join(two, "sector", "left_semi"), companies):
        good, _ = I.split_bad(I.parse_company_pages(P.render_company_pages(rows, "2024-02-15")))
        last = publish.read_published(spark, path, "companies").agg(F.coalesce(F.max("id"), F.lit(0))).first()[0]
        publish.publish_append(I.arrival_ids(good, last), path, "companies")
    return publish.read_published(spark, path, "companies")


@register("load_prices_ids", O.with_ctes(F1, P1_ALL) + """
SELECT row_number() OVER (ORDER BY date, stock_name) AS id, date, stock_name,
       CAST(closing_price AS DOUBLE) AS closing_price FROM prices""")
def q_load_prices_ids(spark, sf):
    """The price table with ids in order of arrival."""
    pages = P.render_price_pages(f1_prices_all(spark, sf))
    companies = fx.companies_from_trades(f1_trades(spark, sf))
    path = scratch_path(spark, "prices-ids")
    good = I.arrival_ids(I.split_bad(I.parse_price_pages(pages))[0])
    publish.publish_days(I.prices_table(good, companies), path, "price_list")
    out = publish.read_published(spark, path, "price_list")
    return as_output(out.select("id", "date", "stock_name", "closing_price"))


# -- runs stored by the day

@register("stored_run_totals_buy", O.with_ctes(F1, PAGED, f"""
loaded AS (SELECT {NEW_ID} AS id, date, stock_symbol, buyer, seller, quantity, rate, amount FROM paged2)""",
          O.runs_sql("buy", None, None, src="loaded"), O.totals_sql("buy")) + """
SELECT grp, date, stock_symbol, buyer, CAST(cuml AS DOUBLE) AS cuml, CAST(cumq AS BIGINT) AS cumq, trnxs FROM run_rows""")
def q_stored_run_totals_buy(spark, sf):
    """The days up to one, then the later ones: all runs from the stored rows."""
    trades = store.read_table(spark, _load_trades(spark, sf), "trades")
    path = scratch_path(spark, "runs-stored")
    for days in (F.col("date") > DELETED_DAY, F.col("date") <= DELETED_DAY):
        run_store.put_days(spark, path, trades.filter(days))
    out = run_store.stored_totals(spark, path).filter(F.col("side") == "buy")
    return out.select("grp", "date", "stock_symbol", F.col("broker").alias("buyer"), F.col("cuml").cast("double").alias("cuml"),
                      F.col("cumq").cast("long").alias("cumq"), "trnxs")
