"""Command line: pages -> tables -> report, end to end on sf0.001."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from runlens.__main__ import main
from runlens.operators import compare
from runlens.plans import catalog
from runlens.schema import PAGES
from runlens.session import scratch_path
from runlens.sources import fixtures as fx
from runlens.sources import pages as P
from runlens.sources import store

from .conftest import SF001


def test_cli_pages_to_report(spark):
    trades = catalog.f1_trades(spark, SF001)
    prices = catalog.f1_prices(spark, SF001)
    companies = fx.companies_from_trades(trades)
    d = {k: scratch_path(spark, f"cli-{k}") for k in
         ("tpages", "ppages", "cpages", "trades", "prices", "companies", "report")}
    P.render_trade_pages(trades, 100).write.parquet(d["tpages"])
    P.render_price_pages(prices).write.parquet(d["ppages"])
    P.render_company_pages(companies, "2024-01-01", 400).write.parquet(d["cpages"])

    assert main(["load-trades", "--pages", d["tpages"], "--table", d["trades"]], spark) == 0
    assert main(["load-companies", "--pages", d["cpages"], "--table", d["companies"]], spark) == 0
    assert main(["load-prices", "--pages", d["ppages"], "--companies", d["companies"],
                 "--table", d["prices"]], spark) == 0
    s, e = catalog.START, catalog.END
    assert main(["report-all", "--trades", d["trades"], "--prices", d["prices"], "--start", s, "--end", e,
                 "--n", "50", "--out", d["report"]], spark) == 0

    loaded = store.read_table(spark, d["trades"], "trades")
    assert loaded.count() == trades.count()
    rep = spark.read.option("header", True).csv(d["report"])
    # Loaded ids are new (date/page/position) but keep the order, so the report
    # equals the one computed on the source trades, run numbers included.  The
    # loaded prices carry looked-up symbols ('-' for the unlisted ERROR LTD).
    loaded_prices = store.read_table(spark, d["prices"], "prices")
    assert loaded_prices.filter(F.col("stock_symbol") == "-").select("stock_name").distinct().collect()[0][0] \
        == "ERROR LTD"
    want = compare.compare_all(trades, loaded_prices, s, e, 50)
    cols = ["stock_symbol", "pos", "buyer", "buy_grp", "seller", "sell_grp"]
    got = sorted(tuple(r) for r in rep.select(*[F.col(c).cast("string") for c in cols]).collect())
    exp = sorted(tuple(r) for r in want.select(*[F.col(c).cast("string") for c in cols]).collect())
    assert got == exp

    assert main(["delete-day", "--table", d["trades"], "--date", "2024-01-03"], spark) == 0
    left = store.read_table(spark, d["trades"], "trades")
    assert left.filter(F.col("date") == "2024-01-03").count() == 0
    assert left.count() == trades.filter(F.col("date") != "2024-01-03").count()


def test_cli_symbol_report_drill_and_backfill(spark, tmp_path):
    import json
    trades = catalog.f1_trades(spark, SF001)
    prices = catalog.f1_prices(spark, SF001)
    d = {k: scratch_path(spark, f"cli2-{k}") for k in ("trades", "prices", "rep", "drill", "companies")}
    store.load_days(trades, d["trades"], "trades")
    store.load_days(prices, d["prices"], "prices")
    s, e = catalog.START, catalog.END
    assert main(["report-symbol", "--trades", d["trades"], "--prices", d["prices"], "--start", s, "--end", e,
                 "--symbol", "purchase", "--n", "5", "--out", d["rep"]], spark) == 0
    rep = spark.read.option("header", True).csv(d["rep"])
    assert 0 < rep.count() <= 5 and {r.buy_symbol for r in rep.collect()} == {"purchase"}
    grp = str(rep.orderBy(F.col("buy_amount").cast("double").desc()).first().buy_grp)
    assert main(["drill", "--trades", d["trades"], "--side", "buy", "--start", s, "--end", e,
                 "--grp", grp, "--out", d["drill"]], spark) == 0
    detail = spark.read.option("header", True).csv(d["drill"])
    assert detail.count() >= 1 and {r.grp for r in detail.collect()} == {grp}
    store.refresh(fx.companies_from_trades(trades), d["companies"], "companies")
    snap = os.path.join(tmp_path, "snap.json")
    with open(snap, "w") as fh:
        json.dump([{"id": 1, "symbol": "error", "securityName": "ERROR LTD"},
                   {"id": 2, "symbol": "view", "securityName": "VIEW LTD"}], fh)
    sectors = os.path.join(tmp_path, "sectors.csv")
    with open(sectors, "w") as fh:
        fh.write("stock_symbol,sector\nerror,Others\n")
    assert main(["backfill", "--companies", d["companies"], "--snapshot", snap, "--multiline",
                 "--sectors", sectors, "--table", d["companies"]], spark) == 0
    got = {r.stock_symbol: r.sector for r in store.read_table(spark, d["companies"], "companies").collect()}
    cut = os.path.join(tmp_path, "cut.json")
    for text in ('{"id": 1, "symbol": \n', '{"id": 2,\n'):   # what the first load refused stays
        with open(cut, "w") as fh:
            fh.write(text)
        assert main(["backfill", "--companies", d["companies"], "--snapshot", cut, "--table", d["companies"]], spark) == 0
    assert spark.read.text(d["companies"] + ".quarantine").count() == 2
    assert got["error"] == "Others" and len(got) == 9   # 8 listings + the back-filled one


def test_coverage_of_landed_pages(spark, tmp_path):
    pages, calendar, out = (os.path.join(tmp_path, x) for x in ("pages", "days.csv", "gaps"))
    pager = '<div class="pager"><a href="#">1/%s</a></div>'
    spark.createDataFrame([("2024-01-02", 2, "u", pager % 4), ("2024-01-03", 1, "u", "")], PAGES).write.parquet(pages)
    with open(calendar, "w") as fh:
        fh.write("date\n2024-01-04\n")
    assert main(["coverage", "--pages", pages, "--calendar", calendar, "--out", out], spark) == 0
    got = {tuple(r) for r in spark.read.schema("date string, a int, b int, reason string").option("header", True)
           .csv(out).collect()}
    assert got == {("2024-01-02", 1, 1, "pages lost"), ("2024-01-02", 3, 4, "pages lost"),
                   ("2024-01-03", 2, None, "no readable pager"), ("2024-01-04", 1, None, "no page landed")}
