"""Published tables, arrival ids, nested markup, quarantine by load."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from runlens.operators import ingest as I
from runlens.schema import PAGES, TRADES
from runlens.sources import pages as P
from runlens.sources import publish, store


def trades(spark, rows):
    """(id, date, quantity) as trades."""
    return spark.createDataFrame([(i, d, "ABC", "1", "2", q, None, None) for i, d, q in rows], TRADES)


def content(spark, path):
    return sorted((r.id, r.date, r.quantity) for r in store.read_table(spark, path, "trades").collect())


PAGE = 100_000   # ids of a page


def test_a_load_killed_before_the_swap_leaves_the_table(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    publish.publish_append(trades(spark, [(1, "2024-01-01", 5)]), path)
    with monkeypatch.context() as m:
        m.setattr(publish, "publish", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
        for load in (publish.publish_append, publish.publish_days, publish.publish_table):
            with pytest.raises(RuntimeError, match="killed"):
                load(trades(spark, [(1, "2024-01-01", 6)]), path, "trades")
    assert content(spark, path) == [(1, "2024-01-01", 5)]
    assert len(publish.vacuum(spark, path)) == 4   # two of the append: its rows, and those it keeps
    publish.publish_append(trades(spark, [(1, "2024-01-01", 7)]), path)
    assert content(spark, path) == [(1, "2024-01-01", 7)]


def test_an_unfinished_pointer_does_not_count(spark, tmp_path):
    path = str(tmp_path / "t")
    publish.publish_append(trades(spark, [(1, "2024-01-01", 5)]), path)
    (tmp_path / "t" / "_published" / "000000002").write_text("load=gone/date=2024-01-01")
    assert content(spark, path) == [(1, "2024-01-01", 5)]
    publish.publish_append(trades(spark, [(PAGE, "2024-01-01", 6)]), path)
    assert content(spark, path) == [(1, "2024-01-01", 5), (PAGE, "2024-01-01", 6)]
    assert publish.live(spark, path)[0] == 4


def test_of_two_loads_from_one_version_the_second_fails(spark, tmp_path):
    path = str(tmp_path / "t")
    version, old = publish.live(spark, path)
    publish.publish_days(trades(spark, [(1, "2024-01-01", 5)]), path)
    with pytest.raises(publish.Conflict):
        publish.publish(spark, path, version, old)
    assert content(spark, path) == [(1, "2024-01-01", 5)]


def test_appends_rewrite_only_folders_with_pages_that_come_again(spark, tmp_path):
    path = str(tmp_path / "t")
    publish.publish_append(trades(spark, [(0, "2024-01-01", 1), (1, "2024-01-01", 1), (PAGE, "2024-01-01", 1),
                                          (9 * PAGE, "2024-01-02", 1)]), path)
    first = set(publish.live(spark, path)[1])
    publish.publish_append(trades(spark, [(2 * PAGE, "2024-01-01", 2)]), path)
    assert first < set(publish.live(spark, path)[1])
    publish.publish_append(trades(spark, [(2, "2024-01-01", 3), (8 * PAGE, "2024-01-02", 3)]), path)
    assert len(first & set(publish.live(spark, path)[1])) == 1   # the other day's folder stays as written
    want = [(2, "2024-01-01", 3), (PAGE, "2024-01-01", 1), (2 * PAGE, "2024-01-01", 2), (8 * PAGE, "2024-01-02", 3),
            (9 * PAGE, "2024-01-02", 1)]
    assert content(spark, path) == want
    publish.vacuum(spark, path)
    assert content(spark, path) == want
    publish.publish_days(trades(spark, [(3, "2024-01-01", 4)]), path)
    assert content(spark, path) == [(3, "2024-01-01", 4), *want[3:]]
    assert publish.unpublish_day(spark, path, "2024-01-02") and not publish.unpublish_day(spark, path, "2024-01-02")
    assert content(spark, path) == [(3, "2024-01-01", 4)]


def test_a_plain_table_is_taken_over(spark, tmp_path):
    path = str(tmp_path / "t")
    store.load_days(trades(spark, [(1, "2024-01-01", 5), (2, "2024-01-02", 5)]), path)
    publish.publish_append(trades(spark, [(PAGE, "2024-01-01", 6)]), path)
    assert content(spark, path) == [(1, "2024-01-01", 5), (2, "2024-01-02", 5), (PAGE, "2024-01-01", 6)]


def test_arrival_ids_are_dense_and_in_order(spark):
    rows = [(d, p, k) for d in ("2024-01-02", "2024-01-01") for p in (10, 2) for k in (7, 0, 3)]
    got = I.arrival_ids(spark.createDataFrame(rows, "date string, page_no int, pos int"), 40).collect()
    assert [(r.date, r.page_no, r.pos) for r in sorted(got, key=lambda r: r.id)] == sorted(rows)
    assert sorted(r.id for r in got) == list(range(41, 41 + len(rows)))


def page(rows, lead=2, trail=3, cls="table my-table"):
    around = "<tr><th>h</th></tr>"
    return f'<div><table class="{cls}">{around * lead}{"".join(rows)}{around * trail}</table><table><tr><td>x</td></tr></table>'


def cells(spark, *htmls):
    df = spark.createDataFrame([("2024-01-01", k, "u", h) for k, h in enumerate(htmls)], PAGES)
    got = P.table_rows(df, P.TRADE_TABLE_CLASS, P.TRADE_ROW_SLICE).collect()
    return [(r.cells, r.problem) for r in sorted(got, key=lambda r: (r.page_no, r.pos or 0))]


def test_nested_and_open_elements(spark):
    inner = '<table class="table my-table"><tr><td>b</td><td>c</td></tr></table>'
    assert cells(spark, page([f"<tr><td>a{inner}</td><td>d</td></tr>", "<TR><TD>e</TD></TR>"])) == [
        (["abc", "b", "c", "d"], None), (["b", "c"], None), (["e"], None)]
    # what stays open ends with what it stands in
    assert cells(spark, page(["<tr><td>a<td>b</tr>"])) == [(["ab", "b"], None)]
    assert cells(spark, page(["<!-- <tr><td>no</td></tr> --><tr><td>a</td></tr>"], cls=" table \n my-table ")) == [(["a"], None)]


def test_pages_without_rows_say_why(spark):
    deep = "<tr><td>" * 40
    assert cells(spark, None, "", page([], cls="my-table"), page([]), page([deep])) == [
        (None, P.NO_TABLE)] * 3 + [(None, P.NO_ROWS), (None, P.TOO_DEEP)]


def test_all_named_entities(spark):
    from html import unescape
    texts = ["Caf&eacute; &hellip; &copy;", "&amp;eacute; &amp;amp; &amp;#32;", "&nosuch; &eacute &", "&#233;&#xe9;&AMP;&lt;b&gt;",
             "&NotEqualTilde;", "a & b &; &&amp;"]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(P.html_text(F.col("t"))).collect()
    # a name without its semicolon stays, where a browser would guess
    want = [unescape(t) if "&eacute " not in t else t for t in texts]
    assert [r[0] for r in got] == want


def test_newest_landing_counts_and_undated_pages_stay(spark):
    rows = [("2024-01-01", 1, "z", "old", 1), ("2024-01-01", 1, "a", "new", 2), (None, 1, "u", "x", 1), (None, 1, "u", "x", 1),
            ("2024-01-01", None, "u", "y", 1)]
    df = spark.createDataFrame(rows, "date string, page_no int, url string, html string, landed int")
    assert sorted(r.html for r in I.one_landing(df).collect()) == ["new", "x", "x", "y"]
