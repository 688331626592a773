"""Searches for a whole table of terms in one pass over the texts."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import dims
from tidemark.functions import text as T
from tidemark.storage import written

#: Terms that may be linked at once.
MOST = 200_000

_BUILT: dict[str, ahocorasick.Automaton] = {}


def _automaton(token: str, terms: list[str]) -> ahocorasick.Automaton:
    """The automaton of these terms, built once in a process."""
    if token not in _BUILT:
        _BUILT.clear()
        made = ahocorasick.Automaton()
        for i, term in enumerate(terms):
            made.add_word(term, i)
        made.make_automaton()
        _BUILT[token] = made
    return _BUILT[token]


def _goes_on(c: str) -> bool:
    """A letter in which a mention may not go on."""
    return "A" <= c <= "Z" or "a" <= c <= "z" or "\u4e00" <= c <= "\u9fff"


def linked_text(made: ahocorasick.Automaton, terms: list[str], text: str) -> tuple[str, int]:
    """The text with all taggable mentions linked, and how many. Of overlapping ones the first counts, of those that start together the longest."""
    spans = []
    for last, i in made.iter(text):
        first, end = last + 1 - len(terms[i]), last + 1
        if text[max(first - 2, 0) : first] != "[[" and text[end : end + 2] != "]]" and not _goes_on(text[end : end + 1]):
            spans.append((first, -end))
    out, at, n = [], 0, 0
    for first, end in sorted(spans):
        if first >= at and not _inside_link(text, first):
            out += [text[at:first], "[[", text[first:-end], "]]"]
            at, n = -end, n + 1
    return "".join([*out, text[at:]]), n


def _inside_link(text: str, at: int) -> bool:
    """Whether a place lies within the brackets of a link, whose name must stay as it is."""
    opened = text.rfind("[[", 0, at)
    return opened >= 0 and text.find("]", opened, at) < 0 and text.find("]]", at) >= 0


def _blocks(terms: DataFrame, most: int) -> Iterator[list[str]]:
    """Different terms, at most about so many at a time."""
    names = terms.select("name").filter("name <> ''").distinct()
    blocks = -(-names.count() // most)
    for b in range(blocks):
        yield sorted(r.name for r in names.filter(F.pmod(F.xxhash64("name"), F.lit(blocks)) == b).collect())


#: Terms whose hashes a task holds at once, 8 bytes each, to find them. More are looked for in several passes.
HASHED = 8_000_000


def _mentioned(text: str, heads: dict[str, list[int]], hashes: np.ndarray) -> dict[str, list[int]]:
    """Each piece of the text that begins and is as long as a term and has the hash of one, with its places in order."""
    firsts, last, at = {h[:1] for h in heads}, len(text), {}
    for i, c in enumerate(text):
        if c in firsts:
            for n in {*heads.get(c, ()), *heads.get(text[i : i + 2], ())}:
                if i + n <= last:
                    at.setdefault(text[i : i + n], []).append(i)
    if not at or not len(hashes):
        return {}
    own = np.array([xxhash.xxh64_intdigest(x.encode(), 42) for x in at], np.uint64).view(np.int64)
    there = hashes[np.minimum(np.searchsorted(hashes, own), len(hashes) - 1)] == own
    return {x: places for (x, places), is_term in zip(at.items(), there, strict=True) if is_term}


def _numbers(text: str, term: str, places: list[int]) -> list[int]:
    """Linked, bare and taggable mentions of a term at these places. They do not overlap."""
    n, ends = [0, 0, 0], [0, 0, 0]
    for first in places:
        end = first + len(term)
        opened, closed = text[max(first - 2, 0) : first] == "[[", text[end : end + 2] == "]]"
        bare = not opened and not closed
        for k, counts in enumerate((opened and closed, bare, bare and not _goes_on(text[end : end + 1]))):
            if counts and first >= ends[k]:
                n[k] += 1
                ends[k] = end
    return n


def find_terms(reports: DataFrame, terms: DataFrame, most: int = HASHED) -> DataFrame:
    """name, ticker, linked, bare, taggable, role of each term (column name) in each report that mentions it before its finance header.

    As `discover` for every term, in one pass: pieces of a text that have the hash of a term are looked up among the terms in the end.
    """
    rows = reports.withColumn("body", T.body(F.col("content")))
    roles, other = [(s, label) for s, label, _ in dims.DISCOVERY_ROLES if s], dims.DISCOVERY_ROLES[-1][1]
    rows = rows.select("ticker", "body", *[T.exact_section(F.col("body"), dims.SECTION_TITLES[s]).alias(s) for s, _ in roles])
    schema = rows.select("ticker").schema.add("name", "string").add("linked", "long").add("bare", "long").add("taggable", "long").add("role", "string")
    names = written(terms.select("name").filter("name <> ''").distinct(), "terms")
    passes, out = -(-names.count() // most), None
    for b in range(passes):
        own = names.filter(F.pmod(F.xxhash64("name"), F.lit(passes)) == b)
        hashed = own.select(F.xxhash64("name").alias("h")).toArrow().column("h").to_numpy()
        heads: dict[str, list[int]] = {}
        for r in own.select(F.left("name", F.lit(2)).alias("head"), F.char_length("name").alias("n")).distinct().collect():
            heads.setdefault(r.head, []).append(r.n)
        held = reports.sparkSession.sparkContext.broadcast((heads, np.unique(hashed).tobytes()))

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            heads, hashes = held.value[0], np.frombuffer(held.value[1], np.int64)
            for batch in batches:
                for i in range(batch.num_rows):
                    text = batch.column("body")[i].as_py() or ""
                    found = {x: _numbers(text, x, places) for x, places in _mentioned(text, heads, hashes).items()}
                    found = {x: n for x, n in found.items() if n[0] or n[1]}
                    parts = [(batch.column(s)[i].as_py() or "", label) for s, label in roles]
                    role = [next((label for part, label in parts if x in part), other) for x in found]
                    values = [list(found), *([n[j] for n in found.values()] for j in range(3)), role]
                    kinds = [pa.string(), *[pa.int64()] * 3, pa.string()]
                    yield pa.RecordBatch.from_arrays([batch.column("ticker").take(pa.array([i] * len(found), pa.int32())), *map(pa.array, values, kinds)], names=["ticker", "name", "linked", "bare", "taggable", "role"])

        part = rows.mapInArrow(run, schema)
        out = part if out is None else out.unionByName(part)
    if out is None:
        return reports.sparkSession.createDataFrame([], schema).select("name", "ticker", "linked", "bare", "taggable", "role")
    return out.join(names, "name", "left_semi").select("name", "ticker", "linked", "bare", "taggable", "role")


def link_terms(reports: DataFrame, terms: DataFrame, most: int = MOST) -> DataFrame:
    """All reports with bare mentions of all terms linked, longest first, and `applied`, how many were. Reports without a finance header stay as they are.

    All terms are needed at once; it is an error if there are more than ``most``.
    """
    blocks = list(_blocks(terms, most))
    if len(blocks) > 1:
        raise ValueError(f"more than {most} terms")
    block, token = blocks[0] if blocks else [], uuid.uuid4().hex
    kept = [c for c in reports.columns if c not in ("content", "applied")]
    schema = reports.select(*kept).schema.add("content", "string").add("applied", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = _automaton(token, block) if block else None
        for batch in batches:
            texts, counts = [], []
            for text in batch.column("content").to_pylist():
                head, mark, rest = (text or "").partition(dims.FINANCE_HEADER)
                head, n = linked_text(made, block, head) if mark and made else (head, 0)
                texts.append(None if text is None else head + mark + rest)
                counts.append(n)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(texts, pa.string()), pa.array(counts, pa.int64())], names=[*kept, "content", "applied"])

    return reports.select(*kept, "content").mapInArrow(run, schema).select(*[c for c in reports.columns if c != "applied"], "applied")
