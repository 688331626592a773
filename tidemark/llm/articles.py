"""Main text of web pages by wrapper induction.

The pages of a host are folded into one template tree. Like siblings are folded into one node; trees are aligned by simple tree
matching (the greatest number of node pairs with equal labels and order, by dynamic programming over children), aligned
nodes merge, others are added. Spark counts exactly how many different pages of a host have a text at a node: a text that most
pages share is template, and other places are slots. The content root of a host is the deepest container that holds nearly all text of slots.

A page's text is what stands under its host's content root, less the blocks that are wholly template text, in article elements
too; if there are article (else main) elements under the root, all of these are the text, in page order. Parts that are marked as
menus, footers, adverts, comments and the like are left out of template and text: in the given pages they vary as the articles do,
so slots alone can't tell them apart.
"""

from __future__ import annotations

import html
import json
import sys
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import broadcast_if_few, cut_lineage, pick, table
from .dom import BLOCKS, DEEPEST, HEADINGS, Node, parse

#: A text is template if this part of a host's different pages have it at a node, of at least so many pages. Up to FEW_PAGES all must have it:
#: of a few pages some may be versions of one article.
SHARED, LEAST_PAGES, FEW_PAGES = 0.6, 3, 8
#: The content root holds this part of all text in slots.
CONTENT = 0.98
#: Rules up to this many bytes go to every executor at once; more are joined by host.
BROADCAST_BYTES = 16 << 20
#: Elements that are the text by their mark, the surest first.
ARTICLES = ("article", "main")
#: Trees are walked by recursion, as deep as a page may be nested.
sys.setrecursionlimit(max(sys.getrecursionlimit(), 8 * DEEPEST))
_CONTAINERS = frozenset("article main div section body td #root".split())


def text_id(text: str) -> int:
    """A signed 64-bit hash."""
    return int.from_bytes(xxhash.xxh64_digest(text.encode("utf-8", "surrogatepass")), "big", signed=True)


def clean(text: str) -> str:
    return " ".join(html.unescape(text).split())


class Template:
    """A node of a host's tree: label, pages seen, characters of text, children by label in order."""

    __slots__ = ("key", "n", "chars", "kids")

    def __init__(self, key: str) -> None:
        self.key, self.n, self.chars = key, 0, 0
        self.kids: dict[str, Template] = {}

    def dump(self) -> list:
        return [self.key, self.n, self.chars, [k.dump() for k in self.kids.values()]]

    @classmethod
    def load(cls, x: list) -> Template:
        out = cls(x[0])
        out.n, out.chars = x[1], x[2]
        out.kids = {k[0]: cls.load(k) for k in x[3]}
        return out


def fold(node: Node) -> Template:
    """The template of a single page; parts that are marked as no article are left out."""
    out = Template(node.key)
    out.n = 1
    own: list[str] = []
    for kid in node.kids:
        if isinstance(kid, str):
            own.append(kid)
        elif not kid.out:
            one = fold(kid)
            merge(out.kids[one.key], one, same_page=True) if one.key in out.kids else out.kids.setdefault(one.key, one)
    out.chars = len(clean("".join(own)))
    return out


def texts(node: Node, way: tuple[str, ...] = ()) -> Iterator[tuple[tuple[str, ...], str]]:
    """The way and the own text of every node that fold() counts."""
    if text := clean("".join(k for k in node.kids if isinstance(k, str))):
        yield way, text
    for kid in node.kids:
        if isinstance(kid, Node) and not kid.out:
            yield from texts(kid, (*way, kid.key))


def _score(a: Template, b: Template) -> int:
    """Simple tree matching: the most pairs of nodes in an order-keeping match of two trees with one label."""
    x, y = list(a.kids.values()), list(b.kids.values())
    if [k.key for k in x] == [k.key for k in y]:
        return 1 + sum(map(_score, x, y))
    row = [0] * (len(y) + 1)
    for p in x:
        new = [0]
        for j, q in enumerate(y):
            new.append(max(row[j + 1], new[j], row[j] + _score(p, q) if p.key == q.key else 0))
        row = new
    return 1 + row[-1]


def _aligned(a: Template, b: Template) -> set[str]:
    """Labels of the children that the best match pairs."""
    x, y = list(a.kids.values()), list(b.kids.values())
    if [k.key for k in x] == [k.key for k in y]:
        return set(a.kids)
    best = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
    pair = {(i, j): _score(p, q) for i, p in enumerate(x) for j, q in enumerate(y) if p.key == q.key}
    for i in range(len(x)):
        for j in range(len(y)):
            best[i + 1][j + 1] = max(best[i][j + 1], best[i + 1][j], best[i][j] + pair.get((i, j), 0))
    out, i, j = set(), len(x), len(y)
    while i and j:
        if (i - 1, j - 1) in pair and best[i][j] == best[i - 1][j - 1] + pair[i - 1, j - 1]:
            out.add(x[i - 1].key)
            i, j = i - 1, j - 1
        elif best[i][j] == best[i - 1][j]:
            i -= 1
        else:
            j -= 1
    return out


def merge(into: Template, other: Template, same_page: bool = False) -> Template:
    """Aligns and merges two trees with one label. Children out of order in the other tree merge too, as alternatives of the same place."""
    if not same_page:
        into.n += other.n
    into.chars += other.chars
    matched = _aligned(into, other)
    for key, kid in other.kids.items():
        if key in matched or key in into.kids:
            merge(into.kids[key], kid, same_page)
        else:
            into.kids[key] = kid
    if not same_page and matched != set(other.kids):
        # New children stand behind the matched one that they follow.
        order, last = [k for k in into.kids if k not in other.kids or k in matched], None
        for key in other.kids:
            if key not in order:
                order.insert(order.index(last) + 1 if last in order else 0, key)
            last = key
        into.kids = {k: into.kids[k] for k in order}
    return into


def rules(tree: Template, template: dict[int, int]) -> list[str]:
    """The labels on the way to the content root, given the characters of template texts at nodes."""
    slots: dict[tuple[str, ...], int] = {}

    def walk(node: Template, way: tuple[str, ...]) -> int:
        mass = max(0, node.chars - template.get(place(way), 0)) + sum(walk(k, (*way, k.key)) for k in node.kids.values())
        slots[way] = mass
        return mass

    total, node, way, root = walk(tree, ()), tree, (), ()
    while total:
        node = next((k for k in node.kids.values() if slots[(*way, k.key)] >= CONTENT * total), None)
        if node is None:
            break
        way = (*way, node.key)
        if node.key.partition(".")[0] in _CONTAINERS:
            root = way
    return list(root)


def place(way: tuple[str, ...], text: str = "") -> int:
    return text_id("/".join(way) + "\n" + text)


Placed = tuple[Node, tuple[str, ...]]


def _find(node: Node, way: list[str]) -> list[Placed]:
    """The nodes on the way, with their own; an article or main element on it stands for all that is below."""
    found: list[Placed] = [(node, ())]
    for key in way:
        found = [y for x, at in found for y in ([(x, at)] if x.tag in ARTICLES else [(k, (*at, k.key)) for k in x.kids if isinstance(k, Node) and k.key == key])]
    return [(x, at) for x, at in found if not x.out]


def _articles(node: Node, way: tuple[str, ...], tag: str) -> list[Placed]:
    if node.tag == tag:
        return [(node, way)]
    return [x for kid in node.kids if isinstance(kid, Node) and not kid.out for x in _articles(kid, (*way, kid.key), tag)]


def blocks(node: Node, way: tuple[str, ...] = (), shared: frozenset[int] = frozenset()) -> list[str]:
    """Texts of the blocks below a node in order, less those of template texts only: white space is one blank, no block is empty."""
    out: list[str] = []
    run: list[str] = []
    fresh = False

    def flush() -> None:
        nonlocal fresh
        text = clean("".join(run))
        run.clear()
        if text and fresh:
            out.append(text)
        fresh = False

    def walk(x: Node, way: tuple[str, ...], heading_only: bool) -> None:
        nonlocal fresh
        own = "".join(k for k in x.kids if isinstance(k, str)) if shared else ""
        known = bool(own) and place(way, clean(own)) in shared
        for kid in x.kids:
            if isinstance(kid, str):
                if not heading_only:
                    run.append(kid)
                    fresh = fresh or not known and not kid.isspace()
            elif not kid.out:
                block = kid.tag in BLOCKS or kid.tag == "header"
                if block:
                    flush()
                if kid.tag == "br":
                    run.append(" ")
                walk(kid, (*way, kid.key) if shared else way, (heading_only or kid.tag == "header") and kid.tag not in HEADINGS)
                if block:
                    flush()

    walk(node, way, node.tag == "header")
    flush()
    return out


def extract(page: str, way: list[str], shared: frozenset[int]) -> str:
    """The main text of a page under its host's rules."""
    tree = parse(page)
    for nodes in ([x for x in _find(tree, way) if way], [(tree, ())]):
        for tag in ARTICLES:
            if out := [b for n, at in nodes for x, on in _articles(n, at, tag) for b in blocks(x, on, shared)]:
                return "\n".join(out)
        if out := [b for n, at in nodes for b in blocks(n, at, shared)]:
            return "\n".join(out)
    # A page of template texts alone.
    return "\n".join([b for x, _ in _articles(tree, (), "article") for b in blocks(x)] or blocks(tree))


def _with_host(pages: DataFrame) -> DataFrame:
    return pages.withColumn("host", F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)))


PART = "host string, part int, tree string"


def _merged(trees: pa.ChunkedArray) -> Template:
    first, *more = (Template.load(json.loads(raw)) for raw in trees.to_pylist())
    for one in more:
        first = merge(first, one)
    return first


def shared_texts(pages: DataFrame) -> DataFrame:
    """host, node, place, chars: the texts that at least SHARED of a host's different pages (but no fewer than FEW_PAGES, or all) have at a node, and their characters in all pages.

    Counts are exact. Pages with equal HTML are one page; a host with fewer than LEAST_PAGES has no such texts.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["host", "page", "node", "place", "chars"]
        for batch in batches:
            rows: list[list] = [[] for _ in names]
            for host, page in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), strict=True):
                found: dict[tuple[tuple[str, ...], str], int] = defaultdict(int)
                for way, text in texts(parse(page or "")):
                    found[way, text] += len(text)
                ident = text_id(page or "")
                # A row without a place counts the page itself.
                for row in [(host, ident, None, None, 0), *((host, ident, place(way), place(way, text), n) for (way, text), n in found.items())]:
                    for column, value in zip(rows, row, strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(rows[0], pa.string()), *(pa.array(x, pa.int64()) for x in rows[1:])], names=names)

    found = _with_host(pages).select("host", "html").mapInArrow(run, "host string, page long, node long, place long, chars long")
    each = found.groupBy("host", "node", "place", "page").agg(F.sum("chars").alias("chars"))
    counts = each.groupBy("host", "node", "place").agg(F.count("*").alias("n"), F.sum("chars").alias("chars"))
    # What a single page has is no template: neither it nor a host of so few pages has to be kept.
    counts = cut_lineage(counts.filter("n > 1"))
    hosts = counts.filter(F.col("place").isNull() & (F.col("n") >= LEAST_PAGES)).select("host", F.col("n").alias("pages"))
    often = counts.filter("place is not null").join(broadcast_if_few(hosts), "host").filter(F.col("n") >= F.least("pages", F.greatest(F.lit(FEW_PAGES), SHARED * F.col("pages"))))
    return often.select("host", "node", "place", "chars")


def induce(pages: DataFrame) -> DataFrame:
    """host, way, shared: the rules of every host.

    Each task folds the pages it reads into one tree for each host. Trees of a host merge in two steps, first those of 64 parts of
    the tasks, so no task gets a tree from every other, let alone a page. From all pages, none is left out.
    """

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        trees: dict[str, Template] = {}
        for batch in batches:
            for host, page in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), strict=True):
                one = fold(parse(page or ""))
                trees[host] = merge(trees[host], one) if host in trees else one
        part = TaskContext.get().partitionId() % 64
        for host, tree in trees.items():
            yield pa.RecordBatch.from_arrays([pa.array([host]), pa.array([part], pa.int32()), pa.array([json.dumps(tree.dump())])], names=["host", "part", "tree"])

    def join(group: pa.Table) -> pa.Table:
        return pa.table({"host": group.column("host")[:1], "part": group.column("part")[:1], "tree": pa.array([json.dumps(_merged(group.column("tree")).dump())])})

    def last(group: pa.Table, often: pa.Table) -> pa.Table:
        template: dict[int, int] = defaultdict(int)
        for node, chars in zip(often.column("node").to_pylist(), often.column("chars").to_pylist(), strict=True):
            template[node] += chars
        way, shared = rules(_merged(group.column("tree")), template), sorted(often.column("place").to_pylist())
        return pa.table({"host": group.column("host")[:1], "way": pa.array([way], pa.list_(pa.string())), "shared": pa.array([shared], pa.list_(pa.int64()))})

    parts = _with_host(pages).select("host", "html").mapInArrow(local, PART)
    joined = parts.groupBy("host", "part").applyInArrow(join, PART)
    return joined.groupBy("host").cogroup(shared_texts(pages).groupBy("host")).applyInArrow(last, "host string, way array<string>, shared array<long>")


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every row; a null page or one without a text gives an empty text. A null url is a host of its own."""
    pages = pick(pages, "page_id", "url", "html")
    found = cut_lineage(induce(pages))
    size = found.agg(F.sum(F.length(F.to_json(F.struct("host", "way", "shared"))))).first()[0] or 0
    rows = _with_host(pages).join(F.broadcast(found) if size <= BROADCAST_BYTES else found, "host", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 200):
                part = batch.slice(lo, 200)
                texts = [extract(page or "", way or [], frozenset(shared or ())) for page, way, shared in zip(*(part.column(c).to_pylist() for c in ("html", "way", "shared")), strict=True)]
                yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return rows.select("page_id", "url", "html", "way", "shared").mapInArrow(run, pages.select("page_id", "url").schema.add("text", "string").add("n_chars", "long"))


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages"))
