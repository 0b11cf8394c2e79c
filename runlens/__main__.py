"""Command line: the reference's script entry points as Spark jobs.

    python -m runlens report-all    --trades T --prices P --start D --end D [--n 800] --out DIR
    python -m runlens report-symbol --trades T --prices P --start D --end D --symbol S [--n 100] --out DIR
    python -m runlens drill         --trades T --side buy|sell --start D --end D --grp G --out DIR
    python -m runlens load-trades   --pages DIR --table DIR [--quarantine DIR]
    python -m runlens load-prices   --pages DIR --companies DIR --table DIR
    python -m runlens load-companies --pages DIR --table DIR [--append]
    python -m runlens coverage      --pages DIR [--calendar CSV] --out DIR
    python -m runlens backfill      --companies DIR --snapshot FILE [--multiline] [--sectors CSV] --table DIR
    python -m runlens delete-day    --table DIR --date D

Tables are published folders (``runlens.sources.publish``): a load that dies leaves
them as they were; plain Parquet folders are read too and become published ones at their
first load.  Pages are Parquet rows ``(date, page_no, url, html)``; those without a date
take the one they show, and of a page that landed twice the newest file's counts.
Reports are CSV with a header, one folder per period.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import functions as F

from .operators import compare, ingest, runs
from .operators.enrich import backfill_companies
from .schema import PAGES
from .session import build_session
from .sources import publish, store
from .sources.pages import page_count, page_gaps
from .sources.snapshot import snapshot_parts


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="python -m runlens")
    p.add_argument("--master", default=None, help="Spark master (default: from the environment)")
    sub = p.add_subparsers(dest="cmd", required=True)

    def report(name, symbol):
        s = sub.add_parser(name)
        s.add_argument("--trades", required=True)
        s.add_argument("--prices", required=True)
        s.add_argument("--start", required=True)
        s.add_argument("--end", required=True)
        s.add_argument("--n", type=int, default=100 if symbol else 800)
        if symbol:
            s.add_argument("--symbol", required=True)
        s.add_argument("--out", required=True)
        s.add_argument("--format", choices=("csv", "parquet", "xlsx"), default="csv")

    report("report-all", False)
    report("report-symbol", True)
    d = sub.add_parser("drill")
    for a in ("--trades", "--start", "--end", "--out"):
        d.add_argument(a, required=True)
    d.add_argument("--side", choices=["buy", "sell"], required=True)
    d.add_argument("--grp", type=int, required=True)
    t = sub.add_parser("load-trades")
    t.add_argument("--pages", required=True)
    t.add_argument("--table", required=True)
    pp = sub.add_parser("load-prices")
    for a in ("--pages", "--companies", "--table"):
        pp.add_argument(a, required=True)
    c = sub.add_parser("load-companies")
    c.add_argument("--pages", required=True)
    c.add_argument("--table", required=True)
    c.add_argument("--append", action="store_true", help="keep the listings of earlier loads")
    for s in (t, pp, c):
        s.add_argument("--quarantine", default=None, help="folder of the parsed rows (default: TABLE.quarantine)")
    b = sub.add_parser("backfill")
    b.add_argument("--companies", required=True)
    b.add_argument("--snapshot", required=True)
    b.add_argument("--multiline", action="store_true")
    b.add_argument("--sectors", default=None, help="CSV with header: stock_symbol,sector")
    b.add_argument("--table", required=True)
    g = sub.add_parser("coverage")
    g.add_argument("--pages", required=True)
    g.add_argument("--calendar", default=None, help="CSV with header: date; days expected")
    g.add_argument("--out", required=True)
    x = sub.add_parser("delete-day")
    x.add_argument("--table", required=True)
    x.add_argument("--date", required=True)
    return p


def _split(args, parsed):
    """Parses once into a folder of this load in the quarantine, reports the counts and
    returns the good rows."""
    path = args.quarantine or args.table.rstrip("/") + ".quarantine"
    good, bad = store.keep_parsed(parsed, path)
    print(f"{args.cmd}: {good.count()} rows good, {bad.count()} quarantined in {path}")
    return good


def _last_id(table) -> int:
    return table.agg(F.coalesce(F.max("id"), F.lit(0))).first()[0]


def main(argv: list[str] | None = None, spark=None) -> int:
    args = _parser().parse_args(argv)
    own = spark is None
    spark = spark or build_session(args.master)
    read = lambda path, target: store.read_table(spark, path, target)

    def pages(path):
        landed = F.col("_metadata.file_modification_time").alias("landed")
        return ingest.one_landing(ingest.dated(spark.read.schema(PAGES).parquet(path).select("*", landed)))

    def last_id(target):
        there = publish.exists(spark, args.table)
        return _last_id(read(args.table, target)) if there else 0

    if args.cmd in ("report-all", "report-symbol"):
        trades, prices = read(args.trades, "trades"), read(args.prices, "prices")
        if args.cmd == "report-all":
            rep = compare.compare_all(trades, prices, args.start, args.end, args.n)
        else:
            rep = compare.compare_symbol(trades, prices, args.start, args.end, args.symbol, args.n)
        store.write_report(rep, args.out, f"{args.start}_{args.end}", args.format)
    elif args.cmd == "drill":
        detail = runs.run_trades(read(args.trades, "trades"), args.side, args.grp, args.start, args.end)
        store.write_report(detail, args.out, f"{args.start}_{args.end}_{args.grp}")
    elif args.cmd == "load-trades":
        good = _split(args, ingest.parse_trade_pages(pages(args.pages)))
        publish.publish_append(ingest.with_trade_ids(good), args.table, "trades")
    elif args.cmd == "load-prices":
        good = ingest.arrival_ids(_split(args, ingest.parse_price_pages(pages(args.pages))), last_id("price_list"))
        rows = ingest.prices_table(good, read(args.companies, "companies"))
        publish.publish_append(rows, args.table, "price_list")
    elif args.cmd == "load-companies":
        # ids go on from the table's largest, also where the load replaces all rows
        good = ingest.arrival_ids(_split(args, ingest.parse_company_pages(pages(args.pages))), last_id("companies"))
        (publish.publish_append if args.append else publish.publish_table)(good, args.table, "companies")
    elif args.cmd == "backfill":
        companies = read(args.companies, "companies")
        sectors = (spark.read.option("header", True).schema("stock_symbol string, sector string").csv(args.sectors)
                   if args.sectors else None)
        records, malformed = snapshot_parts(spark, args.snapshot, args.multiline)
        lost = store.load_folder(args.table.rstrip("/") + ".quarantine")
        malformed.write.text(lost)
        print(f"backfill: {spark.read.text(lost).count()} malformed records in {lost}")
        out = backfill_companies(companies, records, sectors)
        publish.publish_table(out, args.table, "companies")
    elif args.cmd == "coverage":
        days = (spark.read.option("header", True).schema("date string").csv(args.calendar) if args.calendar else None)
        landed = pages(args.pages)
        page_gaps(landed, page_count(landed), days).write.mode("overwrite").option("header", True).csv(args.out)
    elif args.cmd == "delete-day":
        (publish.unpublish_day if publish.is_published(spark, args.table) else store.delete_day)(
            spark, args.table, args.date)
    if own:
        spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
