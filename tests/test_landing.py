"""Sheets, files, streams with state, and the drawing of the graph."""

import datetime
import json

from pyspark.sql import functions as F

from tidemark import sinks
from tidemark.operators import layout as LY
from tidemark.sources import reports as R
from tidemark.sources import sheets as SH
from tidemark.streaming import refresh as ST

REPORT = "ticker string, company string, sector string, path string, content string"


def test_sheets(spark, tmp_path):
    (tmp_path / "in").mkdir()
    rows = [[2330, "甲 & <乙>", 1.5], ["0050", " 丙 ", None], ["x", None, "y"], [], [None, "late"]]
    (tmp_path / "in" / "a.xlsx").write_bytes(SH.sheet_bytes(rows))
    (tmp_path / "in" / "b.xlsx").write_bytes(SH.sheet_bytes([]))
    (tmp_path / "in" / "notes.txt").write_text("no")
    got = sorted(SH.read_sheets(spark, f"file://{tmp_path}/in").select("number", "cells").collect())
    assert [tuple(r) for r in got] == [(1, ["2330", "甲 & <乙>", "1.5"]), (2, ["0050", " 丙 ", None]), (3, ["x", None, "y"]), (4, []), (5, [None, "late"])]
    assert sorted(map(tuple, SH.listed(SH.read_sheets(spark, f"file://{tmp_path}/in")).collect())) == [("0050", "丙"), ("2330", "甲 & <乙>")]


def test_sheets_as_other_programs_write_them():
    """Shared and rich strings, cells out of place, rows that are left out, another name of the sheet's part, numbers with a point."""
    import io
    import zipfile

    main = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    held = io.BytesIO()
    with zipfile.ZipFile(held, "w") as book:
        book.writestr("xl/workbook.xml", f'<workbook {main} xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets><sheet name="z" sheetId="7" r:id="rId9"/></sheets></workbook>')
        book.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" Target="styles.xml"/><Relationship Id="rId9" Target="/xl/worksheets/other.xml"/></Relationships>')
        book.writestr("xl/sharedStrings.xml", f"<sst {main}><si><t>one</t></si><si><r><t>two</t></r><r><t> halves</t></r><rPh><t>sound</t></rPh></si></sst>")
        book.writestr("xl/worksheets/other.xml", f'<worksheet {main}><sheetData><row r="2"><c r="B2" t="s"><v>1</v></c><c r="AA2" t="s"><v>0</v></c></row><row r="9"><c r="A9"><v>2330.0</v></c><c r="B9" t="str"><f>x</f><v>s</v></c></row></sheetData></worksheet>')
        book.writestr("xl/worksheets/sheet1.xml", "<no/>")
    got = list(SH.rows_of(held.getvalue()))
    assert got == [(2, [None, "two halves", *[None] * 24, "one"]), (9, ["2330", "s"])]


def test_files_written_and_found(spark, tmp_path):
    rows = [("A & B/1101_甲 +%41.md", "x\ny"), ("C/1101_乙.md", None), ("C/notes.md", "n")]
    made = sinks.write_files(spark.createDataFrame(rows, "name string, content string"), f"file://{tmp_path}/r")
    assert made.count() == 3
    got = {(r.ticker, r.company, r.sector, r.content) for r in R.read_reports(spark, f"file://{tmp_path}/r").collect()}
    assert got == {("1101", "甲 +%41", "A & B", "x\ny")}  # Spark lists no empty files


def test_stream_keeps_the_newest_without_rewriting(spark, tmp_path):
    """Copies within the time waited for go; a greater path replaces, a lesser one doesn't; a batch writes what it changes; rows that come too late are counted."""
    at = lambda day: datetime.datetime(2026, 1, day)
    schema = REPORT + ", landed_at timestamp"
    batches = [[("1", "c", "s", "/a/1", "old", at(1)), ("2", "c", "s", "/a/2", "two", at(1))], [("1", "c", "s", "/b/1", "new", at(2)), ("1", "c", "s", "/a/1", "old", at(2))], [("3", "c", "s", "/a/3", "three", at(20))], [("1", "c", "s", "/a/0", "lesser", at(20)), ("2", "c", "s", "/z/2", "too late", at(3))]]
    query = None
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/in/{i}")
        stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(f"{tmp_path}/in")
        query = ST.follow_changes(stream, f"{tmp_path}/out", f"{tmp_path}/state")
        query.awaitTermination()
    got = {r.ticker: r.content for r in ST.followed(spark, f"{tmp_path}/out").collect()}
    assert got == {"1": "new", "2": "two", "3": "three"} and ST.late_rows(query) == 1
    assert spark.read.schema(REPORT).parquet(f"{tmp_path}/out/*").count() == 4


def test_layout(spark):
    """The same every time; linked nodes end nearer to each other than others."""
    groups = [[f"a{i}" for i in range(6)], [f"b{i}" for i in range(6)]]
    edge = spark.createDataFrame([(x, y, 5) for g in groups for x in g for y in g if x < y] + [("a0", "nobody", 5)], "source string, target string, weight long")
    node = spark.createDataFrame([(x,) for g in groups for x in g] + [("alone",)], "id string")
    one, two = ({r.id: (r.x, r.y) for r in LY.layout(node.repartition(k), edge.repartition(k), 8).collect()} for k in (1, 3))
    assert one == two and set(one) == {*groups[0], *groups[1], "alone"} and all(0 <= v <= LY.SIDE for p in one.values() for v in p)
    apart = lambda x, y: ((one[x][0] - one[y][0]) ** 2 + (one[x][1] - one[y][1]) ** 2) ** 0.5
    mean = lambda pairs: sum(apart(x, y) for x, y in pairs) / len(pairs)
    linked = [(x, y) for g in groups for x in g for y in g if x < y]
    assert 1.5 * mean(linked) < mean([(x, y) for x in groups[0] for y in groups[1]])
    assert LY.layout(node.filter("false"), edge).count() == 0


def test_page_has_places_search_and_neighbours():
    graph = json.dumps({"nodes": [{"id": "</x>", "count": 3, "category": "c", "color": "#fff"}], "links": []})
    page = sinks.graph_page(graph, places={"</x>": (0.0, 1000.0)})
    assert '"<\\/x>": [100.0, 875.0]' in page and 'type="search"' in page and "near.has" in page and "</x>" not in page
