"""Sinks: pages, graph files and snapshots."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from string import Template

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import dims
from tidemark.functions.text import page_name
from tidemark.sources.sheets import sheet_bytes


def joined_lines(rows: DataFrame, order: list[str], by: list[str] | None = None) -> DataFrame:
    """`page`: the lines of each group in order. For pages, whose lines are few."""
    lines = F.transform(F.array_sort(F.collect_list(F.struct(*order, "line"))), lambda x: x["line"])
    return rows.groupBy(*(by or [])).agg(F.array_join(lines, "\n").alias("page"))


def index_page(index: DataFrame, names: int, reports: int) -> DataFrame:
    """The index as Markdown: `page`, one row. The heads count all names, the lists show the top ones."""
    spec = [(i, c, title, limit) for i, (c, title, limit) in enumerate(dims.INDEX_SECTIONS)]
    sections = index.sparkSession.createDataFrame(spec, "ord int, category string, title string, most int")
    totals = sections.join(index.groupBy("category").agg(F.count("*").alias("total")), "category", "left").withColumn("total", F.coalesce("total", F.lit(0)))
    label = F.when(F.col("most").isNull(), F.format_string(" (%d)", "total")).otherwise(F.format_string(" (%d total, showing top %d)", "total", "most"))
    heads = totals.select("ord", F.lit(0).alias("place"), F.concat(F.lit("## "), "title", label, F.lit("\n")).alias("line"))
    rows = index.join(F.broadcast(sections), "category").filter(F.col("most").isNull() | (F.col("place") <= F.col("most")))
    items = rows.select("ord", "place", F.concat(F.lit("- [["), "name", F.lit("]] ("), F.col("count").cast("string"), F.lit(")")).alias("line"))
    ends = totals.select("ord", F.lit(1 << 30).alias("place"), F.lit("").alias("line"))
    top = index.sparkSession.createDataFrame([(-1, 0, dims.INDEX_HEAD.format(names=names, reports=reports))], "ord int, place int, line string")
    return joined_lines(top.unionByName(heads).unionByName(items).unionByName(ends), ["ord", "place"])


def theme_pages(found: DataFrame, related: DataFrame, themes: DataFrame) -> DataFrame:
    """tag, file, page of every theme with a company."""
    sizes = found.groupBy("tag").agg(F.count("*").alias("n"))
    tail = related.groupBy("tag").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "related", "companies"))), lambda x: F.concat(F.lit("[["), x["related"], F.lit("]] ("), x["companies"].cast("string"), F.lit(")"))), " | ").alias("others"))
    more = F.when(F.col("others").isNotNull(), F.concat(F.lit("\n\n**相關主題:** "), "others")).otherwise("")
    heads = themes.join(sizes, "tag").join(tail, "tag", "left").select("tag", F.lit(0).alias("a"), F.lit("").alias("b"), F.lit("").alias("c"), F.concat(F.lit("# "), "name", F.lit("\n\n> "), "desc", F.lit("\n\n**涵蓋公司數:** "), F.col("n").cast("string"), more, F.lit("\n\n---")).alias("line"))
    ords = F.create_map(*[F.lit(x) for i, (r, _) in enumerate(dims.ROLE_TITLES) for x in (r, 2 * i + 1)])[F.col("role")]
    titles = F.create_map(*[F.lit(x) for r, t in dims.ROLE_TITLES for x in (r, t)])[F.col("role")]
    roles = found.groupBy("tag", "role").agg(F.count("*").alias("n")).select("tag", ords.alias("a"), F.lit("").alias("b"), F.lit("").alias("c"), F.concat(F.lit("\n## "), titles, F.lit(" ("), F.col("n").cast("string"), F.lit(")\n")).alias("line"))
    items = found.select("tag", (ords + 1).alias("a"), F.col("sector").alias("b"), F.col("ticker").alias("c"), F.concat(F.lit("- **"), "ticker", F.lit(" "), "company", F.lit("** ("), "sector", F.lit(")")).alias("line"))
    pages = joined_lines(heads.unionByName(roles).unionByName(items), ["a", "b", "c"], ["tag"])
    return pages.select("tag", F.concat(page_name(F.col("tag")), F.lit(".md")).alias("file"), "page")


def theme_index_page(index: DataFrame) -> DataFrame:
    """The list of the themes built, under all groups."""
    heads = index.select("ord", "group").distinct().select("ord", F.lit(-1).alias("pos"), F.concat(F.lit("## "), "group", F.lit("\n")).alias("line"))
    item = F.concat(F.lit("- ["), "tag", F.lit("]("), page_name(F.col("tag")), F.lit(".md) — "), F.col("companies").cast("string"), F.lit(" 家公司"))
    top = index.sparkSession.createDataFrame([(-1, 0, dims.THEME_INDEX_HEAD)], "ord int, pos int, line string")
    ends = index.select("ord").distinct().select("ord", F.lit(1 << 30).alias("pos"), F.lit("").alias("line"))
    return joined_lines(top.unionByName(heads).unionByName(index.filter("tag is not null").select("ord", "pos", item.alias("line"))).unionByName(ends), ["ord", "pos"])


def _list(row: Column) -> Column:
    return F.array_sort(F.collect_list(row))


def graph_json(node: DataFrame, edge: DataFrame) -> DataFrame:
    """`value`: one JSON object of nodes by falling count and links. A picture's graph is small after its thresholds."""
    n = node.agg(F.transform(_list(F.struct((-F.col("count")).alias("o"), "id", "count", "category", "color")), lambda x: F.struct(x["id"].alias("id"), x["count"].alias("count"), x["category"].alias("category"), x["color"].alias("color"))).alias("nodes"))
    e = edge.agg(_list(F.struct("source", "target", "weight")).alias("links"))
    one = F.lit(1).alias("one")
    return n.select(one, "nodes").join(e.select(one, "links"), "one").select(F.to_json(F.struct("nodes", "links")).alias("value"))


_PAGE = Template("""<!DOCTYPE html>
<html><head><meta charset="utf-8"><title>$title</title><style>body{margin:0;font:14px sans-serif}line{stroke:#999}text{font-size:10px}.dim{opacity:.12}.hit{stroke:#000;stroke-width:3}</style></head>
<body><label>weight <input id="w" type="range" min="1" max="$most" value="$least"></label> <input id="s" type="search" placeholder="name"><svg id="g" width="1200" height="900"></svg>
<script>
const data = $data;
const svg = document.getElementById("g"), slider = document.getElementById("w"), search = document.getElementById("s"), place = $places;
let chosen = null;
data.nodes.forEach((n, i) => { const a = 2.399963 * i, r = 14 * Math.sqrt(i + 1) + 20; place[n.id] = place[n.id] || [600 + r * Math.cos(a), 450 + r * Math.sin(a)]; });
function add(tag, attrs, text) { const e = document.createElementNS("http://www.w3.org/2000/svg", tag); for (const k in attrs) e.setAttribute(k, attrs[k]); if (text) e.textContent = text; svg.appendChild(e); return e; }
function draw() {
  svg.textContent = "";
  const links = data.links.filter(l => l.weight >= +slider.value), ends = new Set(links.flatMap(l => [l.source, l.target])), word = search.value.toLowerCase();
  const near = new Set(links.filter(l => l.source === chosen || l.target === chosen).flatMap(l => [l.source, l.target]));
  const dim = id => chosen !== null && !near.has(id) ? "dim" : "";
  links.forEach(l => add("line", { x1: place[l.source][0], y1: place[l.source][1], x2: place[l.target][0], y2: place[l.target][1], "stroke-width": Math.sqrt(l.weight) / 2, class: chosen === null || l.source === chosen || l.target === chosen ? "" : "dim" }));
  data.nodes.filter(n => ends.has(n.id)).forEach(n => {
    const hit = word && n.id.toLowerCase().includes(word);
    add("circle", { cx: place[n.id][0], cy: place[n.id][1], r: 3 + Math.sqrt(n.count) / 2, fill: n.color, class: hit ? "hit" : dim(n.id) }).onclick = () => { chosen = chosen === n.id ? null : n.id; draw(); };
    if (hit || n.count >= 20) add("text", { x: place[n.id][0] + 8, y: place[n.id][1], class: dim(n.id) }, n.id);
  });
}
slider.oninput = search.oninput = draw; draw();
</script></body></html>
""")


def graph_page(graph: str, title: str = "Graph", least: int = 5, places: dict[str, tuple[float, float]] | None = None) -> str:
    """A page that draws the graph, from its JSON text: a threshold, a search, and a node's neighbours when it is clicked.

    places has x and y of nodes in a square of 1,000, as the force layout gives; others stand in a spiral.
    """
    most = max([least, *(x["weight"] for x in json.loads(graph)["links"])])
    at = {name: [round(100 + x, 1), round(0.85 * y + 25, 1)] for name, (x, y) in (places or {}).items()}
    closed = lambda text: text.replace("</", "<\\/")
    return _PAGE.substitute(title=title, data=closed(graph), places=closed(json.dumps(at, ensure_ascii=False)), most=most, least=least)


def write_text(page: DataFrame, column: str, folder: str) -> None:
    """A page as a single text file in a folder."""
    page.select(column).coalesce(1).write.mode("overwrite").text(folder)


def write_by(reports: DataFrame, column: str, folder: str) -> None:
    """Reports dealt out into folders by a column; a hot folder is written by many tasks."""
    reports.repartitionByRange(column, "ticker").write.mode("overwrite").partitionBy(column).parquet(folder)


def _put(folder: str, name: str, raw: bytes) -> None:
    """A file in a folder that all executors reach; a task that runs again writes it again, whole."""
    files, root = fs.FileSystem.from_uri(folder)
    path = f"{root}/{name}"
    files.create_dir(path.rpartition("/")[0], recursive=True)
    made = f"{path.rpartition('/')[0]}/.{uuid.uuid4().hex}"
    with files.open_output_stream(made) as out:
        out.write(raw)
    files.move(made, path)


def write_files(texts: DataFrame, folder: str) -> DataFrame:
    """Writes each text (name, content) as a file of that name below the folder. name of what was written; nothing happens before it is used."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, text in zip(batch.column("name"), batch.column("content"), strict=True):
                _put(folder, name.as_py(), (text.as_py() or "").encode())
            yield batch.select(["name"])

    return texts.select("name", "content").mapInArrow(run, "name string")


def write_sheets(rows: DataFrame, part: str, columns: list[str], folder: str) -> DataFrame:
    """Writes the rows of each part as a spreadsheet without a header, in the order of its columns; a part must fit a sheet. path of each; nothing happens before it is used."""

    def run(group: pa.Table) -> pa.Table:
        cells = sorted(zip(*(group.column(c).to_pylist() for c in columns), strict=True), key=lambda r: tuple((x is not None, x) for x in r))
        name = f"{group.column(part)[0].as_py()}.xlsx"
        _put(folder, name, sheet_bytes(cells))
        return pa.table({"path": [name]})

    return rows.select(part, *columns).groupBy(part).applyInArrow(run, "path string")


def append_new(fresh: DataFrame, existing: DataFrame, folder: str) -> None:
    """Reports of tickers that are not there yet, added to a snapshot."""
    fresh.join(existing.select("ticker"), "ticker", "left_anti").write.mode("append").partitionBy("sector").parquet(folder)
