"""Saved exchange pages: extraction with built-in functions (I-1 .. I-7).

A page is one row ``(date, page_no, url, html)``.  A table is cut out at its
balanced end tag; its rows, and the cells of a row, are all elements of that
tag inside, nested ones too, in the order in which they begin.  Well-formed flat
markup takes one regular expression; only where elements nest or stay open does a
fold over the tags count depths.  Row slices (``rows[2:-3]`` etc.) are ``slice``.
Everything stays in the JVM; pages are independent, so extraction is map-only.

Rendering (``render_*``) turns tables back into pages.  The exchange pages
themselves are not available, so the fixtures render them from the supplied
tables and the round trip is checked against plain SQL.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from functools import lru_cache
from html.entities import html5

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Markup the extractors look for.
TRADE_TABLE_CLASS = "table my-table"
PRICE_TABLE_CLASS = "table table-condensed table-hover"
COMPANY_TABLE_CLASS = "my-table table"
DATE_DIV_CLASS = "col-xs-2 col-md-2 col-sm-0"
PAGER_DIV_CLASS = "pager"
# Rows around the data rows of each table: (leading, trailing).
TRADE_ROW_SLICE = (2, 3)
PRICE_ROW_SLICE = (2, 4)
COMPANY_ROW_SLICE = (2, 1)

# Deepest nesting of rows or cells that is followed; a page beyond it is a problem.
MAX_DEPTH = 16
NO_TABLE, NO_ROWS, TOO_DEEP = "no table", "no data rows", "nested too deeply"
# Why pages of a day are missing.
LOST, NO_PAGER, NO_PAGES = "pages lost", "no readable pager", "no page landed"


def _class_pattern(tag: str, cls: str) -> str:
    words = r"\s+".join(map(re.escape, cls.split()))
    return rf"""(?is)<{tag}\b[^>]*\bclass\s*=\s*["']\s*{words}\s*["'][^>]*>"""


def _numeric_entities(c: Column) -> Column:
    """``&#8211;`` and ``&#x2013;`` as their characters; others stay."""
    def one(part: Column) -> Column:
        digits = F.regexp_extract(part, r"^(x[0-9a-fA-F]{1,6}|[0-9]{1,7});", 1)
        code = F.when(digits.startswith("x"), F.conv(F.substring(digits, 2, 6), 16, 10)).otherwise(digits)
        char = F.decode(F.unhex(F.lpad(F.hex(code.try_cast("bigint")), 8, "0")), "UTF-32")
        rest = F.substring(part, F.length(digits) + F.lit(2), F.length(part))
        return F.when(digits != "", F.concat(char, rest)).otherwise(F.concat(F.lit("&#"), part))
    parts = F.split(c, "&#")
    return F.when(F.contains(c, F.lit("&#")), F.concat(
        F.get(parts, 0), F.array_join(F.transform(F.slice(parts, 2, F.size(parts)), one), ""))).otherwise(c)


@lru_cache(maxsize=1)
def _named_entities() -> str:
    """Name -> characters of every named entity that ends with a semicolon, as JSON."""
    return json.dumps({name[:-1]: chars for name, chars in html5.items() if name.endswith(";")})


def _named(c: Column) -> Column:
    """Named entities as their characters; unknown names stay."""
    # one literal, folded to a map when the query is planned
    table = F.from_json(F.lit(_named_entities()), "map<string,string>")

    def one(part: Column) -> Column:
        name = F.regexp_extract(part, r"^([A-Za-z][A-Za-z0-9]*);", 1)
        char = F.try_element_at(table, name)
        rest = F.substring(part, F.length(name) + F.lit(2), F.length(part))
        return F.when(char.isNotNull(), F.concat(char, rest)).otherwise(F.concat(F.lit("&"), part))
    parts = F.split(c, "&")
    decoded = F.concat(F.get(parts, 0), F.array_join(F.transform(F.slice(parts, 2, F.size(parts)), one), ""))
    return F.when(c.rlike("&[A-Za-z]"), decoded).otherwise(c)


def html_text(c: Column) -> Column:
    """Text of an HTML fragment: tags removed, numeric and all named entities decoded.
    Named ones come first: ``&amp;#32;`` is the text ``&#32;`` (its number stays)."""
    bare = F.regexp_replace(c, r"(?s)<[^>]*>", "")
    plain = _numeric_entities(bare)
    # With an ampersand among them, names are decoded part by part, so that no text is
    # decoded twice.
    return F.when(bare.rlike("&[A-Za-z]"), F.array_join(F.transform(
        F.split(bare, "(?=&)"), lambda part: F.when(part.startswith("&#"), _numeric_entities(part))
        .otherwise(_named(part))), "")).otherwise(plain)


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once (a lambda's variable)."""
    return F.get(F.transform(F.array(value), use), 0)


def _without_comments(html: Column) -> Column:
    return F.when(F.contains(html, F.lit("<!--")), F.regexp_replace(html, "(?s)<!--.*?(-->|$)", "")).otherwise(html)


def elements(html: Column, tag: str) -> Column:
    """Inner HTML of every ``tag`` element of ``html``, nested ones too, in the order in
    which they begin; one that is never closed ends with ``html``.  NULL where they
    nest deeper than ``MAX_DEPTH``.

    If each opening tag begins a match of its own, nothing nests and the matches are
    the elements.  Else the tags cut ``html`` into parts, and a fold keeps the parts
    where the open elements began and (first, last) parts of the closed ones."""
    flat = F.regexp_extract_all(html, F.lit(rf"(?is)<{tag}\b[^>]*>(.*?)</{tag}\s*>"), 1)
    opens = F.regexp_count(html, F.lit(rf"(?i)<{tag}\b"))
    return _once(flat, lambda found: F.when(F.size(found) == opens, found).otherwise(_nested(html, tag)))


def _nested(html: Column, tag: str) -> Column:
    span = "struct<first:int,last:int>"
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("open"),
                     F.array().cast(f"array<{span}>").alias("done"), F.lit(False).alias("deep"))

    def step(s: Column, part: Column) -> Column:
        at = s["at"] + 1
        opening, closing = part.rlike(rf"(?i)^<{tag}\b"), part.rlike(rf"(?i)^</{tag}\b") & (F.size(s["open"]) > 0)
        closed = F.struct(F.element_at(s["open"], -1).alias("first"), s["at"].alias("last"))
        return F.struct(
            at.alias("at"),
            F.when(opening, F.array_append(s["open"], at))
            .when(closing, F.slice(s["open"], 1, F.size(s["open"]) - 1)).otherwise(s["open"]).alias("open"),
            F.when(closing, F.array_append(s["done"], closed)).otherwise(s["done"]).alias("done"),
            (s["deep"] | (F.size(s["open"]) >= MAX_DEPTH)).alias("deep"))

    def cut(parts: Column) -> Column:
        def all_of(s: Column) -> Column:
            left = F.transform(s["open"], lambda o: F.struct(o.alias("first"), s["at"].alias("last")))
            spans = F.array_sort(F.concat(s["done"], left))   # by the part where they begin
            inner = F.transform(spans, lambda x: F.regexp_replace(
                F.array_join(F.slice(parts, x["first"], x["last"] - x["first"] + 1), ""), r"(?s)^<[^>]*>", ""))
            return F.when(~s["deep"], inner)
        return _once(F.aggregate(parts, start, step), all_of)
    return _once(F.split(html, rf"(?i)(?=</?{tag}\b)"), cut)


def first_table(html: Column, cls: str) -> Column:
    """Inner HTML of the first ``<table>`` whose class attribute is exactly ``cls``
    (blanks between its words count as one), up to its own end tag, whatever tables lie
    inside; NULL without such a table."""
    rest = F.regexp_extract(_without_comments(html), _class_pattern("table", cls) + "(.*)$", 1)
    start = F.struct(F.lit(1).alias("depth"), F.lit(0).alias("size"))

    def step(s: Column, part: Column) -> Column:
        depth = s["depth"] + F.when(part.rlike(r"(?i)^<table\b"), 1).when(part.rlike(r"(?i)^</table\b"), -1).otherwise(0)
        inside = s["depth"] > 0
        return F.struct(F.when(inside, depth).otherwise(0).alias("depth"),
                        (s["size"] + F.when(inside & (depth > 0), F.length(part)).otherwise(0)).alias("size"))
    inner = _once(rest, lambda r: F.substring(r, F.lit(1), F.aggregate(
        F.split(r, r"(?i)(?=</?table\b)"), start, step, lambda s: s["size"])))
    return F.when(_without_comments(html).rlike(_class_pattern("table", cls)), inner)


def div_text(html: Column, cls: str) -> Column:
    return html_text(F.regexp_extract(html, _class_pattern("div", cls) + r"(.*?)</div>", 1))


def page_date(html: Column) -> Column:
    """I-3 / I-4: third blank-separated token of the date div's text."""
    return F.get(F.split(div_text(html, DATE_DIV_CLASS), " "), 2)


def pager_total(html: Column) -> Column:
    """I-1: the part after ``/`` in the pager's first link text, as int."""
    pager = F.regexp_extract(html, _class_pattern("div", PAGER_DIV_CLASS) + r"(.*?)</div>", 1)
    a = F.regexp_extract(pager, r"(?is)<a\b[^>]*>(.*?)</a>", 1)
    return F.trim(F.get(F.split(html_text(a), "/"), 1)).try_cast("int")


def page_count(pages: DataFrame, requested: int = 9999) -> DataFrame:
    """I-1 per date: ``requested`` pages, or all the pager reports when
    ``requested`` is the sentinel 9999.  Pages of a day carry the same pager;
    the largest readable one decides, and a day without one has NULL pages."""
    per_day = pages.groupBy("date").agg(F.max(pager_total(F.col("html"))).alias("_total"))
    n = F.col("_total") if requested == 9999 else F.lit(int(requested))
    return per_day.select("date", n.alias("pages"))


def expected_pages(counts: DataFrame, url_template: str = "{page}?limit={limit}", limit: int = 10000) -> DataFrame:
    """I-2: the pages 1..N of every date with their URLs (``{page}`` and
    ``{limit}`` are filled in), one row per page."""
    pre, _, rest = url_template.partition("{page}")
    rest = rest.replace("{limit}", str(int(limit)))
    pre = pre.replace("{limit}", str(int(limit)))
    out = counts.filter(F.col("pages") >= 1).select("date", F.explode(F.sequence(F.lit(1), F.col("pages"))).alias("page_no"))
    return out.select("date", "page_no", F.concat(F.lit(pre), F.col("page_no").cast("string"), F.lit(rest)).alias("url"))


def missing_pages(pages: DataFrame, counts: DataFrame) -> DataFrame:
    """I-2 re-aimed: expected pages 1..N per date that have not landed."""
    expected = expected_pages(counts).select("date", "page_no")
    return expected.join(pages.select("date", "page_no"), ["date", "page_no"], "left_anti")


def page_gaps(pages: DataFrame, counts: DataFrame, calendar: DataFrame | None = None) -> DataFrame:
    """I-2 as intervals: (date, first_page, last_page, reason) of pages that have not
    landed, one row per gap however long, sorted pages of a day being the only list.

    ``counts`` is the result of ``page_count``; ``calendar`` holds the days expected
    (column ``date``), whether a page of theirs landed or not.  Where a day's number of
    pages cannot be told, what follows its last page is an open gap (``last_page``
    NULL): ``NO_PAGER`` where pages landed, ``NO_PAGES`` where none did.  Repeated pages
    count once; pages without a date or a positive number belong to no day.
    """
    days = counts.filter(F.col("date").isNotNull()).select("date", F.col("pages").cast("int").alias("_n"))
    if calendar is not None:
        expected = calendar.select("date").filter(F.col("date").isNotNull()).distinct()
        days = days.join(expected, "date", "full_outer")
    landed = (pages.filter(F.col("date").isNotNull() & (F.col("page_no") >= 1))
              .groupBy("date", "page_no").agg(F.lit(None).cast("int").alias("_n")))
    marks = days.select("date", F.lit(0).alias("page_no"), "_n").unionByName(landed)
    day = Window.partitionBy("date")
    ordered = marks.select("date", "page_no", F.max("_n").over(day).alias("_n"),
                           F.max("page_no").over(day).alias("_top"),
                           F.lead("page_no").over(day.orderBy("page_no")).alias("_next"))
    last = F.least(F.col("_next") - 1, F.col("_n"))   # least skips NULLs
    reason = F.when(last.isNotNull(), LOST).when(F.col("_top") > 0, NO_PAGER).otherwise(NO_PAGES)
    first = F.col("page_no") + 1
    return ordered.filter(last.isNull() | (last >= first)).select(
        "date", first.alias("first_page"), last.alias("last_page"), reason.alias("reason"))


def table_rows(pages: DataFrame, cls: str, row_slice: tuple[int, int], keep: list[str] | None = None) -> DataFrame:
    """One row per data row of the page's table: ``(keep..., pos, cells, problem)``.

    ``pos`` is the 0-based position among the data rows; ``cells`` are the
    texts of the row's ``<td>`` cells (``<th>`` are not cells, as in the
    reference's parser), those of a table inside a cell too.  Rows of inner tables
    are rows of the table.  A page without the table or without data rows gives one row
    with its ``problem`` and neither pos nor cells, so no page is lost unnoticed.
    """
    head, tail = row_slice
    keep = keep if keep is not None else [c for c in pages.columns if c != "html"]
    # rows[head:-tail] as one slice of the materialised array (a lambda that
    # referred to the extraction would re-run it for every element).
    tables = pages.select(*keep, first_table(F.col("html"), cls).alias("_table"))
    sliced = tables.select(*keep, F.col("_table").isNull().alias("_none"), elements(F.col("_table"), "tr").alias("_rows"))
    data = F.slice(F.col("_rows"), head + 1, F.greatest(F.size("_rows") - head - tail, F.lit(0)))
    problem = (F.when(F.col("_none"), NO_TABLE).when(F.col("_rows").isNull(), TOO_DEEP)
               .when(F.size("_rows") <= head + tail, NO_ROWS))
    # Cells are cut before the explode: a filter on them cannot be pushed through
    # it, so each row's cells are extracted once.
    def cells(row: Column) -> Column:
        return F.transform(elements(row, "td"), html_text)
    return (sliced.select(*keep, problem.alias("problem"),
                          F.posexplode_outer(F.when(problem.isNull(), F.transform(data, cells))).alias("pos", "cells"))
            .select(*keep, "pos", "cells", F.when(F.col("pos").isNull(), F.col("problem"))
                    .when(F.col("cells").isNull(), TOO_DEEP).alias("problem")))


# --------------------------------------------------------------------------
# Rendering (fixtures F6)
# --------------------------------------------------------------------------

def _td(c: Column) -> Column:
    return F.concat(F.lit("<td>"), F.coalesce(c.cast("string"), F.lit("")), F.lit("</td>"))


def _tr(cells: list[Column]) -> Column:
    return F.concat(F.lit("<tr>"), *[_td(c) for c in cells], F.lit("</tr>"))


def _page(date: Column, page_no: Column, total: Column, cls: str, n_lead: int, n_trail: int,
          ncols: int, body: Column) -> Column:
    head_row = F.lit("<tr>" + "<th>h</th>" * ncols + "</tr>")
    lead = F.concat(*[head_row] * n_lead) if n_lead else F.lit("")
    trail_row = F.lit("<tr><td colspan=\"%d\">total</td></tr>" % ncols)
    trail = F.concat(*[trail_row] * n_trail) if n_trail else F.lit("")
    return F.concat(
        F.lit("<html><head><title>Exchange</title></head><body>"),
        F.lit(f'<div class="{DATE_DIV_CLASS}">As of '), date, F.lit(" 15:00:00</div>"),
        F.lit(f'<div class="{PAGER_DIV_CLASS}"><a href="#">'), page_no.cast("string"), F.lit("/"),
        total.cast("string"), F.lit('</a> <a href="#">next</a></div>'),
        F.lit('<table class="x-table"><tr><td>not this one</td></tr></table>'),
        F.lit(f'<table class="{cls}">'), lead, body, trail, F.lit("</table></body></html>"))


def _pages_from_rows(rows: DataFrame, block: Column, order: Column, cls: str, row_slice: tuple[int, int],
                     ncols: int, url_prefix: str) -> DataFrame:
    """Group rendered rows into pages: one page per (date, block).  A block
    holds a bounded number of rows (by construction of ``block``), so each
    group collected here is bounded."""
    b = rows.withColumn("_block", block)
    span = b.groupBy("date").agg(F.min("_block").alias("_b0"), F.max("_block").alias("_b1"))
    grouped = b.groupBy("date", "_block").agg(
        F.array_sort(F.collect_list(F.struct(order.alias("k"), F.col("_html").alias("h")))).alias("_rows"))
    # One row per date: small enough for the planner to broadcast by its size.
    grouped = grouped.join(span, "date")
    page_no = (F.col("_block") - F.col("_b0") + 1).cast("int")
    total = (F.col("_b1") - F.col("_b0") + 1).cast("int")
    body = F.array_join(F.transform(F.col("_rows"), lambda s: s["h"]), "")
    lead, trail = row_slice
    return grouped.select(
        "date", page_no.alias("page_no"),
        F.concat(F.lit(url_prefix), F.col("date"), F.lit("/"), page_no.cast("string")).alias("url"),
        _page(F.col("date"), page_no, total, cls, lead, trail, ncols, body).alias("html"))


def render_trade_pages(trades: DataFrame, page_size: int = 500, malformed: bool = False) -> DataFrame:
    """trade pages, one per (date, block of ``page_size`` ids); a page
    therefore holds at most ``page_size`` trades.  ``malformed`` writes the
    amount with thousands separators when quantity is 100 and drops the last
    cell when quantity is 99."""
    block = F.expr(f"(id - pmod(id, {int(page_size)}L)) div {int(page_size)}L")
    amount = F.col("amount").cast("string")
    cells = [(F.col("id") % page_size + 1), F.col("id"), F.col("stock_symbol"), F.col("buyer"),
             F.col("seller"), F.col("quantity"), F.col("rate").cast("string")]
    if malformed:
        amount = F.when(F.col("quantity") == 100, F.format_number(F.col("amount"), 2)).otherwise(amount)
        full = _tr(cells + [amount])
        short = _tr(cells)
        html = F.when(F.col("quantity") == 99, short).otherwise(full)
    else:
        html = _tr(cells + [amount])
    rows = trades.select("date", "id", html.alias("_html"))
    return _pages_from_rows(rows, block, F.col("id"), TRADE_TABLE_CLASS, TRADE_ROW_SLICE, 8, "floorsheet/")


def render_price_pages(prices: DataFrame, page_size: int = 300) -> DataFrame:
    """price pages of ``page_size`` securities by name."""
    cells = [F.lit(0), F.col("stock_name"), F.col("num_trnx"), F.col("max_price"), F.col("min_price"),
             F.col("closing_price"), F.col("traded_shares"), F.col("amount"), F.col("previous_price"),
             F.col("difference")]
    # One row per security of a date: bounded by the listed securities.
    place = F.row_number().over(Window.partitionBy("date").orderBy("stock_name")) - F.lit(1)
    rows = prices.select("date", "stock_name", _tr(cells).alias("_html"),
                         F.floor(place / F.lit(int(page_size))).alias("_page"))
    return _pages_from_rows(rows, F.col("_page"), F.col("stock_name"), PRICE_TABLE_CLASS, PRICE_ROW_SLICE, 10,
                            "todays_price/")


def render_company_pages(companies: DataFrame, date: str, page_size: int = 400) -> DataFrame:
    """company pages of ``page_size`` listings by id; names are wrapped in
    a newline and blanks, as the exchange page does."""
    name = F.concat(F.lit("\n    "), F.col("stock_name"), F.lit("\n  "))
    cells = [F.col("id"), F.lit(""), name, F.col("stock_symbol"), F.col("sector")]
    block = F.expr(f"(id - pmod(id, {int(page_size)}L)) div {int(page_size)}L")
    rows = companies.select(F.lit(date).alias("date"), "id", _tr(cells).alias("_html"))
    return _pages_from_rows(rows, block, F.col("id"), COMPANY_TABLE_CLASS, COMPANY_ROW_SLICE, 5, "company/")
