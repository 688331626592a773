"""Spreadsheets (xlsx): rows of cells of a sheet, without a header. Files are read through Spark, so from any store that it reads; a file is a task's."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterable, Iterator
from xml.etree import ElementTree
from xml.sax.saxutils import escape

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_CELL = re.compile(r"([A-Z]+)\d*")


def _texts(raw: bytes) -> list[str]:
    """The shared strings of a book, runs of a rich text joined; phonetic ones are no part of it."""
    out = []
    for _, item in ElementTree.iterparse(io.BytesIO(raw)):
        if item.tag == f"{_MAIN}si":
            out.append("".join(t.text or "" for part in item if part.tag in (f"{_MAIN}t", f"{_MAIN}r") for t in part.iter(f"{_MAIN}t")))
            item.clear()
    return out


def _column(place: str) -> int:
    """A1 is 0, AA7 is 26."""
    n = 0
    for c in _CELL.match(place)[1]:
        n = n * 26 + ord(c) - 64
    return n - 1


def _first_sheet(book: zipfile.ZipFile) -> str:
    """The part that holds the first sheet in the order of the book."""
    names = book.namelist()
    if "xl/workbook.xml" in names and "xl/_rels/workbook.xml.rels" in names:
        sheets = ElementTree.fromstring(book.read("xl/workbook.xml")).iter(f"{_MAIN}sheet")
        ident = next((v for s in sheets for k, v in s.attrib.items() if k.endswith("}id")), None)
        for link in ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels")):
            if link.get("Id") == ident:
                target = link.get("Target", "")
                return target.lstrip("/") if target.startswith("/") else f"xl/{target}"
    return next(n for n in sorted(names) if n.startswith("xl/worksheets/") and n.endswith(".xml"))


def rows_of(raw: bytes) -> Iterator[tuple[int, list[str | None]]]:
    """Number (from 1) and cells of each row of the first sheet, as text; an empty cell is null. Rows come one by one."""
    with zipfile.ZipFile(io.BytesIO(raw)) as book:
        shared = _texts(book.read("xl/sharedStrings.xml")) if "xl/sharedStrings.xml" in book.namelist() else []
        number = 0
        with book.open(_first_sheet(book)) as sheet:
            for _, row in ElementTree.iterparse(sheet):
                if row.tag != f"{_MAIN}row":
                    continue
                number = int(row.get("r", number + 1))
                cells: list[str | None] = []
                for cell in row.iter(f"{_MAIN}c"):
                    at = _column(cell.get("r")) if cell.get("r") else len(cells)
                    cells += [None] * (at + 1 - len(cells))
                    kind, value = cell.get("t"), cell.findtext(f"{_MAIN}v")
                    if kind == "inlineStr":
                        value = "".join(t.text or "" for t in cell.iter(f"{_MAIN}t"))
                    elif kind == "s" and value is not None:
                        value = shared[int(value)]
                    elif kind is None and value is not None and value.endswith(".0"):
                        value = value[:-2]  # a whole number, as tickers are
                    cells[at] = value or None
                yield number, cells
                row.clear()


def sheet_bytes(rows: Iterable[Iterable[str | int | float | None]]) -> bytes:
    """A book of one sheet of these rows: numbers as numbers, the rest as text."""
    body = []
    for cells in rows:
        out = []
        for x in cells:
            if x is None:
                out.append("<c/>")
            elif isinstance(x, int | float):
                out.append(f"<c><v>{x}</v></c>")
            else:
                out.append(f'<c t="inlineStr"><is><t xml:space="preserve">{escape(x)}</t></is></c>')
        body.append(f"<row>{''.join(out)}</row>")
    main, kinds = _MAIN.strip("{}"), "http://schemas.openxmlformats.org"
    held = io.BytesIO()
    with zipfile.ZipFile(held, "w", zipfile.ZIP_DEFLATED) as book:
        book.writestr("[Content_Types].xml", f'<Types xmlns="{kinds}/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/><Override PartName="/xl/worksheets/sheet1.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/></Types>')
        book.writestr("_rels/.rels", f'<Relationships xmlns="{kinds}/package/2006/relationships"><Relationship Id="r1" Type="{kinds}/officeDocument/2006/relationships/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        book.writestr("xl/workbook.xml", f'<workbook xmlns="{main}" xmlns:r="{kinds}/officeDocument/2006/relationships"><sheets><sheet name="1" sheetId="1" r:id="r1"/></sheets></workbook>')
        book.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="{kinds}/package/2006/relationships"><Relationship Id="r1" Type="{kinds}/officeDocument/2006/relationships/worksheet" Target="worksheets/sheet1.xml"/></Relationships>')
        book.writestr("xl/worksheets/sheet1.xml", f'<worksheet xmlns="{main}"><sheetData>{"".join(body)}</sheetData></worksheet>')
    return held.getvalue()


def read_sheets(spark: SparkSession, folder: str) -> DataFrame:
    """path, number, cells of the rows of all books under the folder."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, raw in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                held: list[tuple] = []
                for row in rows_of(raw.as_py()):
                    held.append((path, *row))
                    if len(held) == 5000:
                        yield _batch(held)
                        held = []
                yield _batch(held)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.xlsx").load(folder)
    return files.select("path", "content").mapInArrow(run, "path string, number int, cells array<string>")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[], [], []]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.int32(), pa.list_(pa.string())), strict=True)], names=["path", "number", "cells"])


def listed(sheets: DataFrame) -> DataFrame:
    """ticker, company: the first two cells of the rows that begin with a ticker of four digits, which a sheet may hold as a number."""
    first = F.btrim(F.get("cells", F.lit(0)))
    return sheets.filter(first.rlike(r"^\d{1,4}$")).select(F.lpad(first, 4, "0").alias("ticker"), F.btrim(F.get("cells", F.lit(1))).alias("company"))
