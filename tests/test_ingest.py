"""Page extraction round trips, malformed pages, loads and the page stream."""

from __future__ import annotations

import json
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from runlens.operators import enrich
from runlens.operators import ingest as I
from runlens.schema import PAGES, TRADES
from runlens.session import scratch_path
from runlens.sources import pages as P
from runlens.sources import store
from runlens.sources.snapshot import drifting_snapshot, read_snapshot, snapshot_parts
from runlens.streaming.pages_stream import read_streamed_trades, start_page_stream


def _trades(spark):
    rows = []
    for i in range(23):
        d = "2024-01-01" if i < 12 else "2024-01-02"
        q = 99 if i == 3 else (100 if i == 4 else i + 1)
        rows.append((i, d, "SYM" if i % 3 else "X&Y", str(i % 4), str(i % 5), q, Decimal("12.50"),
                     Decimal("12.50") * q))
    return spark.createDataFrame(rows, TRADES)


def test_trade_page_round_trip(spark):
    tr = _trades(spark)
    pages = P.render_trade_pages(tr, page_size=5)
    good, bad = I.split_bad(I.parse_trade_pages(pages, date_from_page=True))
    assert bad.count() == 0
    got = good.select(F.col("contract_no").alias("id"), "date", "stock_symbol", "buyer", "seller", "quantity",
                      "rate", "amount")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, tr.collect()))
    # pager and page numbers: ids 0..11 on day 1 -> blocks 0,1,2; ids 12..22 on day 2 -> blocks 2,3,4
    counts = {r.date: r.pages for r in P.page_count(pages).collect()}
    assert counts == {"2024-01-01": 3, "2024-01-02": 3}
    assert {r.date: r.pages for r in P.page_count(pages, requested=2).collect()} == {"2024-01-01": 2, "2024-01-02": 2}


def test_ids_keep_arrival_order(spark):
    tr = _trades(spark)
    good, _ = I.split_bad(I.parse_trade_pages(P.render_trade_pages(tr, page_size=5)))
    rows = I.with_trade_ids(good).join(good.select(F.col("contract_no"), I.trade_id(F.col("date"), F.col("page_no"), F.col("pos")).alias("id")), "id")
    pairs = sorted((r.id, r.contract_no) for r in rows.collect())
    assert [c for _, c in pairs] == sorted(c for _, c in pairs)


def test_malformed_cells_are_quarantined(spark):
    tr = _trades(spark)
    parsed = I.parse_trade_pages(P.render_trade_pages(tr, page_size=5, malformed=True))
    good, bad = I.split_bad(parsed)
    assert sorted(r.contract_no for r in bad.collect()) == [3, 4]   # missing cell; "1,250.00"
    assert good.count() == 21
    assert "1,250.00" in bad.filter(F.col("contract_no") == 4).first().raw


def test_page_without_table_or_rows(spark):
    pages = spark.createDataFrame([
        ("2024-01-01", 1, "u", "<html><body>no table</body></html>"),
        ("2024-01-01", 2, "u", '<table class="table my-table"><tr><th>h</th></tr><tr><th>h</th></tr>'
                               "<tr><td>a</td></tr><tr><td>b</td></tr><tr><td>c</td></tr></table>"),
    ], PAGES)
    good, bad = I.split_bad(I.parse_trade_pages(pages))
    assert good.count() == 0
    assert [(r.page_no, r.pos, r.raw) for r in bad.orderBy("page_no").collect()] == [
        (1, None, P.NO_TABLE), (2, None, P.NO_ROWS)]


def test_missing_pages(spark):
    pages = P.render_trade_pages(_trades(spark), page_size=5)
    landed = pages.filter(~((F.col("date") == "2024-01-02") & (F.col("page_no") == 2)))
    got = [tuple(r) for r in P.missing_pages(landed, P.page_count(landed)).collect()]
    assert got == [("2024-01-02", 2)]
    urls = [r.url for r in P.expected_pages(P.page_count(pages), "index/{page}/?limit={limit}", 500)
            .filter(F.col("date") == "2024-01-01").orderBy("page_no").collect()]
    assert urls == ["index/1/?limit=500", "index/2/?limit=500", "index/3/?limit=500"]


def test_price_and_company_pages(spark):
    prices = spark.createDataFrame(
        [("2024-01-01", "ALPHA LTD", 3, Decimal("10"), Decimal("9"), Decimal("9.5"), Decimal("30"), Decimal("285"),
          Decimal("0"), Decimal("0")),
         ("2024-01-01", "BETA LTD ", 1, Decimal("5"), Decimal("5"), Decimal("5"), Decimal("1"), Decimal("5"),
          Decimal("4"), Decimal("1"))],
        "date string, stock_name string, num_trnx long, max_price decimal(18,2), min_price decimal(18,2), "
        "closing_price decimal(18,2), traded_shares decimal(18,2), amount decimal(18,2), "
        "previous_price decimal(18,2), difference decimal(18,2)")
    good, bad = I.split_bad(I.parse_price_pages(P.render_price_pages(prices)))
    assert bad.count() == 0 and good.count() == 2
    companies = spark.createDataFrame([(1, "ALPHA LTD", "ALP", "Bank"), (2, "BETA LTD", "BET", "Hydro")],
                                      "id long, stock_name string, stock_symbol string, sector string")
    table = {r.stock_name: (r.stock_symbol, r.pc_change) for r in I.prices_table(good, companies).collect()}
    # the untrimmed price-side name misses the trimmed directory name
    assert table == {"ALPHA LTD": ("ALP", 0.0), "BETA LTD ": ("-", 25.0)}
    cpages = P.render_company_pages(companies, "2024-01-01", page_size=400)
    cgood, _ = I.split_bad(I.parse_company_pages(cpages))
    assert sorted((r.no, r.stock_name, r.stock_symbol, r.sector) for r in cgood.collect()) == \
        [(1, "ALPHA LTD", "ALP", "Bank"), (2, "BETA LTD", "BET", "Hydro")]


def test_store_load_delete_refresh(spark):
    tr = _trades(spark)
    path = scratch_path(spark, "test-trades")
    store.load_days(tr, path, "trades")
    store.load_days(tr.filter(F.col("date") == "2024-01-02"), path, "trades")   # re-run of one day
    assert store.read_table(spark, path, "trades").count() == 23                  # replaced, not duplicated
    assert store.delete_day(spark, path, "2024-01-01")
    assert not store.delete_day(spark, path, "2030-01-01")
    assert store.read_table(spark, path, "trades").count() == 11
    with pytest.raises(ValueError):
        store.load_days(tr, path, "floorsheet_dummy")
    cpath = scratch_path(spark, "test-companies")
    c1 = spark.createDataFrame([(1, "A", "A", "x")], "id long, stock_name string, stock_symbol string, sector string")
    c2 = spark.createDataFrame([(7, "B", "B", "y")], "id long, stock_name string, stock_symbol string, sector string")
    store.refresh(c1, cpath)
    store.refresh(c2, cpath)
    assert [r.id for r in store.read_table(spark, cpath, "companies").collect()] == [7]


def test_snapshot_array_file_and_backfill(spark, tmp_path):
    recs = [
        {"id": 2, "businessDate": "2024-02-15", "securityId": 20, "symbol": "NEW", "securityName": "New Co  ",
         "previousDayClosePrice": 0, "marketCapitalization": 0, "lastUpdatedTime": "2024-02-15T10:21:33.70425"},
        {"id": 1, "businessDate": "2024-02-15", "securityId": 10, "symbol": "OLD", "securityName": "Old Co",
         "previousDayClosePrice": 12.5, "marketCapitalization": 7350.25, "lastUpdatedTime": "2024-02-15T10:21:33.7042"},
        {"id": 3, "businessDate": "2024-02-15", "securityId": 20, "symbol": "NEW", "securityName": "New Co again",
         "previousDayClosePrice": 1, "marketCapitalization": 1, "lastUpdatedTime": "2024-02-15T10:21:33.704251"},
    ]
    f = os.path.join(tmp_path, "snap.json")
    with open(f, "w") as fh:
        json.dump(recs, fh, indent=4)
    snap = read_snapshot(spark, f, multiline=True)
    assert snap.count() == 3
    ts = {r.id: r.lastUpdatedTime.microsecond for r in snap.collect()}
    assert ts == {1: 704200, 2: 704250, 3: 704251}
    companies = spark.createDataFrame([(5, "Old Co", "OLD", "Bank")],
                                      "id long, stock_name string, stock_symbol string, sector string")
    sectors = spark.createDataFrame([("NEW", "Hydro")], "stock_symbol string, sector string")
    out = sorted(tuple(r) for r in enrich.backfill_companies(companies, snap, sectors).collect())
    assert out == [(5, "Old Co", "OLD", "Bank"), (7, "New Co  ", "NEW", "Hydro")]
    known = {r.symbol: r.known for r in enrich.flag_known(snap, companies).collect()}
    assert known == {"OLD": True, "NEW": False}
    assert enrich.known_symbols(snap, companies).count() == 1
    assert enrich.unknown_symbols(snap, companies).count() == 2


def test_symbol_lookup_first_hit(spark):
    companies = spark.createDataFrame([(9, "A LTD", "LATE", None), (3, "A LTD", "EARLY", None)],
                                      "id long, stock_name string, stock_symbol string, sector string")
    prices = spark.createDataFrame([("A LTD", "?"), ("Z LTD", "?")], "stock_name string, stock_symbol string")
    got = {r.stock_name: r.stock_symbol for r in enrich.add_symbol(prices, companies).collect()}
    assert got == {"A LTD": "EARLY", "Z LTD": "-"}


def test_page_stream_is_idempotent_per_batch(spark):
    tr = _trades(spark)
    landing = scratch_path(spark, "test-landing")
    P.render_trade_pages(tr, page_size=5).repartition(3).write.parquet(landing)
    table, quarantine, ckpt = (scratch_path(spark, n) for n in ("test-st", "test-sq", "test-ck"))
    start_page_stream(spark, landing, table, quarantine, ckpt, max_files_per_trigger=1).awaitTermination()
    first = read_streamed_trades(spark, table).count()
    # A second availableNow run with the same checkpoint finds nothing new.
    start_page_stream(spark, landing, table, quarantine, ckpt).awaitTermination()
    assert first == read_streamed_trades(spark, table).count() == 23


def test_page_stream_leaves_few_files_a_day(spark):
    """One file per day and batch, of good and of bad rows, whatever the tasks that parse."""
    rows = [(i, f"2024-01-0{1 + i % 2}", "SYM", "1", "2", 7, Decimal("12.50"), Decimal("87.50")) for i in range(200)]
    pages = P.render_trade_pages(spark.createDataFrame(rows, TRADES), page_size=5)
    broken = pages.filter("page_no > 20").withColumn("html", F.lit("<html></html>"))
    landing, table, quarantine, ckpt = (scratch_path(spark, f"test-few-{n}") for n in "ltqc")
    pages.filter("page_no <= 20").unionByName(broken).repartition(4).write.parquet(landing)
    start_page_stream(spark, landing, table, quarantine, ckpt, max_files_per_trigger=2).awaitTermination()
    assert read_streamed_trades(spark, table).count() == 100
    for path, n in ((table, 100), (quarantine, 40)):
        written = spark.read.parquet(path)
        files = written.select("date", "load_batch", F.input_file_name().alias("f")).distinct()
        assert written.count() == n and files.groupBy("date", "load_batch").count().filter("count > 1").count() == 0
        assert files.count() == 4


def test_snapshot_fixture_invariants(spark):
    """SURVEY 5.5: the snapshot profile as data-quality checks, on F5 from sf0.001."""
    from runlens.sources import fixtures as fx
    from runlens.sources.snapshot import write_snapshot_lines
    from .conftest import SF001
    part = fx.table(spark, SF001, "part")
    path = scratch_path(spark, "test-snapshot")
    write_snapshot_lines(fx.snapshot_json_lines(part), path)
    snap = read_snapshot(spark, path)
    n_parts = part.count()
    prof = snap.agg(
        F.count(F.lit(1)).alias("n"),
        F.countDistinct("symbol").alias("symbols"),
        F.sum((F.col("previousDayClosePrice") == 0).cast("int")).alias("zero_prev"),
        F.sum((F.col("marketCapitalization") == 0).cast("int")).alias("zero_cap"),
        F.sum(((F.col("fiftyTwoWeekHigh") >= F.col("highPrice")) & (F.col("fiftyTwoWeekLow") <= F.col("lowPrice")))
              .cast("int")).alias("bracketed"),
        F.sum(F.col("lastUpdatedTime").isNull().cast("int")).alias("bad_ts"),
        F.countDistinct("businessDate").alias("dates")).first()
    assert prof.symbols == n_parts and prof.n > n_parts                # one symbol repeated per size-50 part
    assert prof.zero_prev == part.filter(F.col("p_size") == 1).count()   # the zero guard of E-3 has work
    assert prof.zero_cap == part.filter(F.col("p_size") == 2).count()    # integer 0 parses as a decimal
    assert prof.bracketed == prof.n and prof.bad_ts == 0 and prof.dates == 1


def test_entities_pager_and_names(spark):
    text = "Women&#039;s &#38; Co &ndash; X&#x2013;Y &#; &amp;lt;"
    got = spark.range(1).select(P.html_text(F.lit(text)).alias("t")).first().t
    assert got == "Women's & Co – X–Y &#; &lt;"
    html = '<div class="pager"></div><a href="#">1/7</a>'
    assert spark.range(1).select(P.pager_total(F.lit(html)).alias("n")).first().n is None
    counts = spark.createDataFrame([("2024-01-01", 0), ("2024-01-02", None)], "date string, pages int")
    assert P.expected_pages(counts).count() == 0
    row = '<tr><td>1</td><td></td><td>\r\n\t\tALPHA&#039;S LTD\r\n\t</td><td>ALP</td><td>Bank</td></tr>'
    page = f'<table class="my-table table"><tr></tr><tr></tr>{row}<tr></tr></table>'
    pages = spark.createDataFrame([("2024-01-01", 1, "u", page)], PAGES)
    assert [r.stock_name for r in I.parse_company_pages(pages).collect()] == ["ALPHA'S LTD"]


def test_undated_pages_and_large_page_numbers(spark):
    pages = P.render_trade_pages(_trades(spark), page_size=5)
    undated = pages.withColumn("date", F.lit(None).cast("string"))
    good, bad = I.split_bad(I.parse_trade_pages(undated))
    assert good.count() == 0 and bad.count() == 23
    ids = spark.createDataFrame([("2024-01-10", 10001), ("2024-01-11", 1)], "date string, page_no int").select(
        I.trade_id(F.col("date"), F.col("page_no"), F.lit(0)).alias("id"))
    assert ids.distinct().count() == 2
    _, bad = I.split_bad(I.parse_trade_pages(pages.withColumn("page_no", F.col("page_no") + 1_000_000)))
    assert bad.count() == 23


def test_checkpoint_folder_is_required_off_local_masters(monkeypatch, spark):
    import types
    from runlens.session import ensure_checkpoint_dir
    sc = types.SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host:7077")
    fake = types.SimpleNamespace(sparkContext=sc, conf=types.SimpleNamespace(get=lambda *a: None))
    with pytest.raises(ValueError):
        ensure_checkpoint_dir(fake)


@pytest.mark.parametrize("multiline", [False, True])
def test_malformed_snapshot_records_come_back(spark, tmp_path, multiline):
    f = os.path.join(tmp_path, "snap.json")
    with open(f, "w") as fh:
        fh.write('{"id": 1, "symbol": "A"}\n{"id": 2, "symbol": \n{"id": 3, "symbol": "C"}\n' if not multiline
                 else '[{"id": 1, "symbol": }]')
    good, bad = snapshot_parts(spark, f, multiline)
    assert sorted(r.id for r in good.collect()) == ([] if multiline else [1, 3])
    assert len(bad.collect()) == 1
    with pytest.raises(Exception):
        read_snapshot(spark, f, multiline).collect()


def test_price_pages_of_many_securities(spark):
    prices = spark.range(23).select(
        F.lit("2024-01-01").alias("date"), F.format_string("S%02d LTD", "id").alias("stock_name"),
        F.lit("S").alias("stock_symbol"), F.col("id").alias("num_trnx"),
        *[F.lit(1).cast("decimal(18,2)").alias(c) for c in ("max_price", "min_price", "closing_price", "traded_shares",
                                                            "amount", "previous_price", "difference")])
    pages = P.render_price_pages(prices, 10)
    assert sorted(r.page_no for r in pages.collect()) == [1, 2, 3]
    good, bad = I.split_bad(I.parse_price_pages(pages))
    assert good.count() == 23 and bad.count() == 0


def test_made_table_is_empty_and_stays(spark):
    for target in ("trades", "prices", "companies"):
        path = scratch_path(spark, f"made-{target}")
        assert store.create_table(spark, path, target) and not store.create_table(spark, path, target)
        table = store.read_table(spark, path, target)
        assert table.count() == 0 and table.columns == store.TARGETS[target].fieldNames()


def test_appended_companies_follow_those_there(spark):
    path = scratch_path(spark, "append-companies")
    store.create_table(spark, path, "companies")
    rows = spark.createDataFrame([(1, 0, "A", "A1", "x"), (1, 1, "B", "B1", "x"), (2, 0, "C", "C1", "y")],
                                 "page_no int, pos int, stock_name string, stock_symbol string, sector string")
    store.append_companies(rows, path)
    store.append_companies(rows.withColumn("stock_symbol", F.lower("stock_symbol")), path)
    table = store.read_table(spark, path, "companies")
    assert [r.stock_symbol for r in table.orderBy("id").collect()] == ["A1", "B1", "C1", "a1", "b1", "c1"]
    first = enrich.first_symbol_per_name(table).collect()
    assert {r._looked_up for r in first} == {"A1", "B1", "C1"}


def test_page_gaps(spark):
    """Gaps at the start, inside and at the end; repeats, pages beyond the count, days
    without a pager, without pages, without a date."""
    landed = spark.createDataFrame(
        [("d1", n) for n in (2, 3, 3, 7, 10)] + [("d2", 1), ("d2", 4), ("d3", 2), ("d3", 1), ("d4", 1), ("d4", 5),
                                                 (None, 1), ("d1", None), ("d1", -4)], "date string, page_no int")
    counts = spark.createDataFrame([("d1", 12), ("d2", None), ("d3", 2), ("d4", 2), ("d6", 0), (None, 3)],
                                   "date string, pages int")
    calendar = spark.createDataFrame([("d3",), ("d5",), ("d5",), (None,)], "date string")
    want = {("d1", 1, 1, P.LOST), ("d1", 4, 6, P.LOST), ("d1", 8, 9, P.LOST), ("d1", 11, 12, P.LOST),
            ("d2", 2, 3, P.LOST), ("d2", 5, None, P.NO_PAGER), ("d4", 2, 2, P.LOST)}
    got = [tuple(r) for r in P.page_gaps(landed, counts).collect()]
    assert len(got) == len(want) and set(got) == want
    got = [tuple(r) for r in P.page_gaps(landed, counts, calendar).collect()]
    assert set(got) == want | {("d5", 1, None, P.NO_PAGES)}
    none = landed.limit(0)
    assert P.page_gaps(none, counts.limit(0)).count() == 0
    assert P.page_gaps(none, counts.limit(0), calendar).count() == 2


def test_page_gaps_build_no_list_of_pages(spark):
    """A day of a thousand million expected pages is two rows."""
    landed = spark.createDataFrame([("d", 500)], "date string, page_no int")
    counts = spark.createDataFrame([("d", 10**9)], "date string, pages int")
    got = sorted(tuple(r)[1:3] for r in P.page_gaps(landed, counts).collect())
    assert got == [(1, 499), (501, 10**9)]


@pytest.mark.parametrize("multiline", [False, True])
def test_unknown_snapshot_keys_survive(spark, tmp_path, multiline):
    f = os.path.join(tmp_path, "snap.json")
    records = ['{"id": 1, "symbol": "A", "openPrice": 12.5, "new": {"a": [1, 2]}, "lot": 10}',
               '{"id": "x", "symbol": null, "businessDate": "2024-02-15", "lot": null}', '{"symbol": "C"}']
    with open(f, "w") as fh:
        fh.write("[" + ",".join(records) + "]" if multiline else "\n".join(records))
    snap = drifting_snapshot(spark, f, multiline)
    got = {r.symbol: r for r in snap.selectExpr(
        "id", "symbol", "cast(openPrice as double) AS p", "cast(businessDate as string) AS d", "map_keys(extra) AS keys",
        "try_variant_get(extra['new'], '$.a[1]', 'int') AS second", "cast(extra['id'] as string) AS odd").collect()}
    assert (got["A"].id, got["A"].p, sorted(got["A"].keys), got["A"].second) == (1, 12.5, ["lot", "new"], 2)
    assert (got[None].id, got[None].d, got[None].odd) == (None, "2024-02-15", "x")
    assert sorted(got[None].keys) == ["id", "lot"] and got["C"].keys == []
    path = os.path.join(tmp_path, "kept")
    snap.write.parquet(path)
    assert spark.read.parquet(path).filter("variant_get(extra['lot'], '$', 'int') = 10").count() == 1
