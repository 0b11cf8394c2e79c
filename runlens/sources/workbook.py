"""Workbooks of reports (C-10): a Python data source, one .xlsx file per period.

Each task writes the workbooks of its periods, row by row, into a staging folder of the
job beside the target; the commit moves them to ``<path>/<period>.xlsx`` once all tasks are
done, so a failed job leaves the earlier workbooks as they were, and files of lost or
repeated task attempts go with the staging folder.  Writing a period again replaces it.

Defined results: NULL is an empty cell; an infinite number or NaN is written as text, and
read back as that number; text keeps every character (control characters by the format's
escape); a period in two tasks, or without a name, and more rows than a sheet holds fail the
job; an empty report writes nothing.
"""

from __future__ import annotations

import math
import posixpath
import re
import sys
import uuid
import zipfile
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from xml.etree import ElementTree
from xml.sax.saxutils import escape

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

FORMAT = "runs_workbook"
PERIOD = "period"

# Fixed values of the spreadsheet format.
SHEET_ROWS = 1_048_576
SHEET = "xl/worksheets/sheet1.xml"
MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
PACKAGE = "http://schemas.openxmlformats.org/package/2006"
OFFICE = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
SPREADSHEET = "application/vnd.openxmlformats-officedocument.spreadsheetml"
PARTS = {
    "[Content_Types].xml":
        f'<Types xmlns="{PACKAGE}/content-types">'
        '<Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
        f'<Override PartName="/xl/workbook.xml" ContentType="{SPREADSHEET}.sheet.main+xml"/>'
        f'<Override PartName="/{SHEET}" ContentType="{SPREADSHEET}.worksheet+xml"/></Types>',
    "_rels/.rels":
        f'<Relationships xmlns="{PACKAGE}/relationships">'
        f'<Relationship Id="r1" Type="{OFFICE}/officeDocument" Target="xl/workbook.xml"/></Relationships>',
    "xl/workbook.xml":
        f'<workbook xmlns="{MAIN}" xmlns:r="{OFFICE}"><sheets>'
        '<sheet name="report" sheetId="1" r:id="r1"/></sheets></workbook>',
    "xl/_rels/workbook.xml.rels":
        f'<Relationships xmlns="{PACKAGE}/relationships">'
        f'<Relationship Id="r1" Type="{OFFICE}/worksheet" Target="worksheets/sheet1.xml"/></Relationships>',
}
XML_HEAD = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
#: What a cell cannot hold as it is, and text that looks like its escape.
ODD = re.compile("[\x00-\x08\x0b-\x1f￾￿]|_(?=x[0-9A-Fa-f]{4}_)")
ESCAPED = re.compile("_x([0-9A-Fa-f]{4})_")


def file_system(path: str):
    """(file system, path in it) of a qualified path, in any task."""
    from pyarrow import fs
    return fs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", path))


def column_name(i: int) -> str:
    """A, B, ..., Z, AA, ... of columns counted from 0."""
    name = ""
    while i >= 0:
        name, i = chr(65 + i % 26) + name, i // 26 - 1
    return name


def cell(value, at: str) -> str:
    if value is None:
        return ""
    if isinstance(value, bool):
        return f'<c r="{at}" t="b"><v>{int(value)}</v></c>'
    if isinstance(value, int) and abs(value) < 1 << 53 or isinstance(value, float) and math.isfinite(value):
        return f'<c r="{at}"><v>{value!r}</v></c>'
    text = escape(ODD.sub(lambda m: f"_x{ord(m[0]):04X}_", str(value)))
    return f'<c r="{at}" t="inlineStr"><is><t xml:space="preserve">{text}</t></is></c>'


def write_book(out, names: Sequence[str], rows: Iterator[Sequence]) -> int:
    """One workbook into the open file ``out``, row by row; returns the number of rows."""
    n = 1
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as book:
        for part, xml in PARTS.items():
            book.writestr(part, XML_HEAD + xml)
        with book.open(SHEET, "w", force_zip64=True) as sheet:
            def line(values):
                cells = "".join(cell(v, f"{column_name(i)}{n}") for i, v in enumerate(values))
                sheet.write(f'<row r="{n}">{cells}</row>'.encode())
            sheet.write(f'{XML_HEAD}<worksheet xmlns="{MAIN}"><sheetData>'.encode())
            line(names)
            for row in rows:
                n += 1
                if n > SHEET_ROWS:
                    raise ValueError(f"a sheet holds {SHEET_ROWS} rows at most")
                line(row)
            sheet.write(b"</sheetData></worksheet>")
    return n - 1


def read_book(source) -> Iterator[dict[str, str]]:
    """Rows after the first as {column of the first row: text of the cell}."""
    def column(reference: str) -> str:
        return reference.rstrip("0123456789")

    names: dict[str, str] | None = None
    with zipfile.ZipFile(source) as book, book.open(SHEET) as sheet:
        for _, row in ElementTree.iterparse(sheet):
            if row.tag != f"{{{MAIN}}}row":
                continue
            found = {column(c.get("r")): ESCAPED.sub(lambda m: chr(int(m[1], 16)), "".join(c.itertext())) for c in row}
            row.clear()
            if names is None:
                names = found
            else:
                yield {names[k]: v for k, v in found.items()}


def typed(text: str | None, kind: T.DataType):
    if text is None:
        return None
    if isinstance(kind, T.BooleanType):
        return text == "1"
    if isinstance(kind, T.IntegralType):
        return int(text)
    return float(text) if isinstance(kind, (T.DoubleType, T.FloatType)) else text


@dataclass
class Staged(WriterCommitMessage):
    books: list   # (period, staged file) of one task


class WorkbookWriter(DataSourceWriter):
    def __init__(self, path: str, names: list[str]):
        self.path, self.names = path, names
        self.staging = posixpath.join(path, f"_staged-{uuid.uuid4().hex}")

    def write(self, rows: Iterator) -> Staged:
        from itertools import groupby
        files, folder = file_system(self.staging)
        at = self.names.index(PERIOD)
        names = self.names[:at] + self.names[at + 1:]
        books = []
        for period, part in groupby(rows, key=lambda r: r[at]):
            if not period or "/" in period or period.startswith(("_", ".")):
                raise ValueError(f"not a name of a period: {period!r}")
            files.create_dir(folder, recursive=True)
            staged = posixpath.join(folder, f"{uuid.uuid4().hex}.xlsx")
            with files.open_output_stream(staged) as out:
                write_book(out, names, (tuple(r[:at]) + tuple(r[at + 1:]) for r in part))
            books.append((period, staged))
        return Staged(books)

    def commit(self, messages: list) -> None:
        books = [b for m in messages if m is not None for b in m.books]
        periods = [p for p, _ in books]
        if len(set(periods)) < len(periods):
            self.abort(messages)
            raise ValueError("rows of one period lie in several places; use write_workbooks")
        files, folder = file_system(self.path)
        for period, staged in books:
            files.move(staged, posixpath.join(folder, f"{period}.xlsx"))
        self.abort(messages)

    def abort(self, messages: list) -> None:
        """Deletes what is still staged."""
        from pyarrow import fs
        files, folder = file_system(self.staging)
        if files.get_file_info(folder).type != fs.FileType.NotFound:
            files.delete_dir(folder)


class WorkbookReader(DataSourceReader):
    def __init__(self, path: str, schema: T.StructType):
        self.path, self.schema = path, schema

    def partitions(self) -> list[InputPartition]:
        from pyarrow import fs
        files, folder = file_system(self.path)
        found = files.get_file_info(fs.FileSelector(folder, allow_not_found=True))
        return [InputPartition(f.path) for f in sorted(found, key=lambda f: f.path) if f.path.endswith(".xlsx")]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        if partition is None or partition.value is None:   # no workbook at all
            return
        files, _ = file_system(self.path)
        period = posixpath.basename(partition.value).removesuffix(".xlsx")
        with files.open_input_file(partition.value) as source:
            for row in read_book(source):
                yield tuple(period if f.name == PERIOD else typed(row.get(f.name), f.dataType) for f in self.schema)


class WorkbookSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema: T.StructType, overwrite: bool) -> DataSourceWriter:
        return WorkbookWriter(self.options["path"], schema.fieldNames())

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return WorkbookReader(self.options["path"], schema)


# The classes travel to the tasks with the job, wherever this package is installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _qualified(spark: SparkSession, path: str) -> str:
    spark.dataSource.register(WorkbookSource)
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(jpath).toString()


def write_workbooks(report: DataFrame, path: str, order: Sequence[Column]) -> None:
    """``report`` (a column ``period`` and the columns of the sheet) as one workbook per
    period, its rows by ``order``.  A period's rows, at most 2n + 1 of a report, are one task."""
    (report.repartition(PERIOD).sortWithinPartitions(PERIOD, *order)
     .write.format(FORMAT).mode("append").option("path", _qualified(report.sparkSession, path)).save())


def read_workbooks(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All workbooks below ``path``: columns of ``schema`` by name, and ``period``."""
    full = T.StructType([*schema.fields, T.StructField(PERIOD, T.StringType())])
    path = _qualified(spark, path)
    return spark.read.format(FORMAT).schema(full).option("path", path).load()
