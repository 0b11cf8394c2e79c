"""Workbooks: format, round trip of odd values, commit and abort."""

import os
import xml.etree.ElementTree as ET
import zipfile

import pytest
from pyspark.sql import functions as F

from runlens.sources import store, workbook

SCHEMA = "stock_symbol string, pos int, amount double, n long, ok boolean"
ROWS = [("A & <B>", 1, 0.1, 7, True), ("_x0041_ \x07\n\ttab", 2, -1e300, 1 << 60, False), (None, 3, None, None, None),
        (" é漢😀 ", 4, float("inf"), -5, True), ("", 5, 2.0, 0, None)]


def test_round_trip_of_odd_values(spark, tmp_path):
    df, path = spark.createDataFrame(ROWS, SCHEMA), str(tmp_path / "books")
    store.write_report(df, path, "a_b", "xlsx")
    back = store.read_report(spark, path, df.schema, "xlsx").orderBy("pos").collect()
    assert [tuple(r) for r in back] == [(*r, "a_b") for r in ROWS]
    assert os.listdir(path) == ["a_b.xlsx"]
    with zipfile.ZipFile(os.path.join(path, "a_b.xlsx")) as book:
        assert book.testzip() is None
        for name in book.namelist():
            ET.fromstring(book.read(name))
        sheet = ET.fromstring(book.read(workbook.SHEET))
    rows = list(sheet.iter(f"{{{workbook.MAIN}}}row"))
    assert ["".join(c.itertext()) for c in rows[0]] == df.columns
    # rows stand in the report's order: by symbol, NULL last
    first = ["".join(r[0].itertext()) if r[0].get("r").startswith("A") else None for r in rows[1:] if len(r)]
    assert first == ["", " é漢😀 ", "A & <B>", "_x005F_x0041_ _x0007_\n\ttab", None]


def test_a_period_is_replaced_and_others_stay(spark, tmp_path):
    path = str(tmp_path / "books")
    df = spark.range(10).selectExpr("id as n", "if(id < 4, 'p1', 'p2') as period")
    workbook.write_workbooks(df, path, [F.col("n")])
    workbook.write_workbooks(df.filter("n = 9").selectExpr("n", "'p2' as period"), path, [F.col("n")])
    back = workbook.read_workbooks(spark, path, df.select("n").schema)
    assert sorted((r.period, r.n) for r in back.collect()) == [("p1", n) for n in range(4)] + [("p2", 9)]
    assert sorted(os.listdir(path)) == ["p1.xlsx", "p2.xlsx"]


@pytest.mark.parametrize("bad", ["if(id = 99, raise_error('lost'), 'p1')", "if(id = 99, null, 'p1')", "if(id < 50, 'p1', 'p/2')"])
def test_a_failed_job_leaves_the_old_workbook(spark, tmp_path, bad):
    path = str(tmp_path / "books")
    old = spark.range(3).selectExpr("id as n", "'p1' as period")
    workbook.write_workbooks(old, path, [F.col("n")])
    with pytest.raises(Exception):
        workbook.write_workbooks(spark.range(100).selectExpr("id as n", f"{bad} as period"), path, [F.col("n")])
    assert os.listdir(path) == ["p1.xlsx"]
    assert workbook.read_workbooks(spark, path, old.select("n").schema).count() == 3


def test_a_period_in_two_tasks_fails(spark, tmp_path):
    path = str(tmp_path / "books")
    df = spark.range(0, 10, 1, 2).selectExpr("id as n", "'p1' as period")
    writer = df.write.format(workbook.FORMAT).mode("append").option("path", workbook._qualified(spark, path))
    with pytest.raises(Exception, match="several places"):
        writer.save()
    assert os.listdir(path) == []


def test_empty_report_and_folder(spark, tmp_path):
    path = str(tmp_path / "books")
    df = spark.range(0).selectExpr("id as n", "'p1' as period")
    workbook.write_workbooks(df, path, [F.col("n")])
    assert workbook.read_workbooks(spark, path, df.select("n").schema).count() == 0


def test_columns_beyond_z():
    assert [workbook.column_name(i) for i in (0, 25, 26, 701, 702)] == ["A", "Z", "AA", "ZZ", "AAA"]
