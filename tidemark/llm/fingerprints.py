"""Document fingerprints by consistent weighted sampling.

A text is the bag of its words, each weighing its number of occurrences. For a term and a sample position, gamma variates
r and c and a uniform beta are fixed; with weight w the sample is t = floor(ln w / r + beta) at height
ln a = ln c - r (t - beta) - r, and the position keeps the term of least height. Two bags keep the same (term, t) with the
probability sum(min) / sum(max) of their weights, the generalised Jaccard similarity.

Variates are functions of the term's hash alone: a Gamma(2, 1) variate is the sum of two exponential ones, taken from fixed
tables at two independent parts of the hash. Nothing is gathered from the corpus; equal texts have equal fingerprints.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from . import arrays
from .common import pick, table

SAMPLES = 64
#: Bytes of text that are fingerprinted at a time.
CHUNK = 1 << 20
#: Terms that are drawn for at a time.
TERMS = 1 << 16
_ROWS = 4096
_tables: dict[int, tuple[np.ndarray, ...]] = {}


def _variates(samples: int) -> tuple[np.ndarray, ...]:
    if samples not in _tables:
        rng = np.random.Generator(np.random.PCG64(7919))
        draw = lambda f: f((_ROWS, samples)).astype(np.float32)
        exp = lambda s: rng.exponential(size=s) + 1e-6
        _tables[samples] = (draw(exp), draw(exp), draw(exp), draw(exp), draw(rng.random), draw(rng.random))
    return _tables[samples]


def _heights(terms: np.ndarray, weights: np.ndarray, samples: int) -> np.ndarray:
    r1, r2, c1, c2, b1, b2 = _variates(samples)
    part = lambda shift: ((terms >> np.uint64(shift)) & np.uint64(_ROWS - 1)).astype(np.int64)
    i, j = part(0), part(20)
    r = r1[i]
    r += r2[j]
    beta = b1[i]
    beta += b2[j]
    beta -= np.floor(beta)
    t = np.log(weights.astype(np.float64)).astype(np.float32)[:, None] / r
    t += beta
    np.floor(t, out=t)
    t -= beta
    t += 1
    t *= r
    i, j = part(32), part(52)
    c = c1[i]
    c += c2[j]
    np.log(c, out=c)
    c -= t
    return c


def _terms(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the different words; text, word and weight of all words of all texts, by text. A long text is read in pieces."""
    n = len(offsets) - 1
    if n == 1 and len(buf) > 2 * arrays.CHUNK_BYTES:
        parts = []
        for _, _, part, part_offsets, _ in arrays.pieces(pa.array([memoryview(buf)], pa.large_binary()), arrays.CHUNK_BYTES):
            starts, ends, _ = arrays.spans(part, part_offsets)
            parts.append(np.unique(arrays.span_hashes(part, starts, ends), return_counts=True))
        vocab, back = np.unique(np.concatenate([h for h, _ in parts]), return_inverse=True)
        weight = np.bincount(back, np.concatenate([c for _, c in parts]), len(vocab)).astype(np.int64)
        return vocab, np.zeros(len(vocab), np.int64), np.arange(len(vocab)), weight
    starts, ends, first = arrays.spans(buf, offsets)
    vocab, ids = np.unique(arrays.span_hashes(buf, starts, ends), return_inverse=True)
    keys = np.sort(np.repeat(np.arange(n), np.diff(first)) * max(1, len(vocab)) + ids)
    at, weight = arrays.runs(keys)
    doc, ids = np.divmod(keys[at], max(1, len(vocab)))
    return vocab, doc, ids, weight


def signatures(buf: np.ndarray, offsets: np.ndarray, samples: int = SAMPLES) -> tuple[np.ndarray, np.ndarray]:
    """Signatures (a row of 16-bit values for each text) and which texts have no word; those have a row of zeros."""
    vocab, doc, ids, weight = _terms(buf, offsets)
    n = len(offsets) - 1
    out, empty = np.zeros((n, samples), np.uint16), np.bincount(doc, minlength=n) == 0
    if not len(doc):
        return out, empty
    # A word of one weight is drawn for once in all texts; many at a time would be large.
    weighted, back = np.unique(ids * np.int64(1 << 31) + weight, return_inverse=True)
    drawn = lambda w: _heights(vocab[w >> 31], w & ((1 << 31) - 1), samples)
    table = drawn(weighted) if len(weighted) <= TERMS else None
    least = np.full((n, samples), np.inf, np.float32)
    for lo in range(0, len(doc), TERMS // 4):
        part = slice(lo, lo + TERMS // 4)
        height = drawn(weighted[back[part]]) if table is None else table[back[part]]
        at, _ = arrays.runs(doc[part])
        rows = doc[part][at]
        least[rows] = np.minimum(least[rows], np.minimum.reduceat(height, at, axis=0))
    out[~empty] = (least[~empty].view(np.uint32) * np.uint32(0x9E3779B1)) >> np.uint32(16)
    return out, empty


def _of_texts(texts: list[str], samples: int) -> tuple[np.ndarray, np.ndarray]:
    found = [signatures(buf, offsets, samples) for *_, buf, offsets in arrays.chunks(pa.array(texts, pa.large_string()), CHUNK)]
    return np.concatenate([x for x, _ in found]), np.concatenate([x for _, x in found])


def likeness(a: np.ndarray, a_empty: np.ndarray, b: np.ndarray, b_empty: np.ndarray) -> np.ndarray:
    """The share of equal samples; two empty texts are alike, an empty and another one are not."""
    return np.where(a_empty | b_empty, (a_empty & b_empty).astype(float), (a == b).mean(axis=1))


def fingerprint(df: DataFrame, text: str = "text", samples: int = SAMPLES, out: str = "fingerprint") -> DataFrame:
    """Adds a column of hexadecimal signatures, 4 digits a sample. Null and blank texts get zeros. No shuffle."""
    schema = df.drop(out).withColumn(out, F.lit("")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            t = pa.Table.from_batches([batch]).select([n for n in batch.schema.names if n != out])
            sigs = [s.astype(">u2").tobytes().hex() for *_, buf, offsets in arrays.chunks(batch.column(text), CHUNK) for s in signatures(buf, offsets, samples)[0]]
            yield from t.append_column(out, pa.array(sigs, pa.string())).to_batches()

    return df.mapInArrow(run, schema)


def whole_id(docs: DataFrame) -> Column:
    """The doc_id as a long, the least one of all for a null. Ids must be whole numbers."""
    kind = docs.schema["doc_id"].dataType
    if not isinstance(kind, IntegralType):
        raise ValueError(f"doc_id must be a whole number, not {kind.simpleString()}")
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)))


def _listed(numbers: list[int]) -> Column:
    """An array of constants, one expression whatever its length."""
    return F.from_json(F.lit(json.dumps(numbers)), "array<long>")


def range_of(key: Column, bounds: list[int]) -> Column:
    """The number of bounds that are not above the key: a binary search in a constant array, so plans do not grow with the bounds."""
    steps = [1 << k for k in range(len(bounds).bit_length() - 1, -1, -1)] if bounds else []
    if not steps:
        return F.lit(0)
    step = lambda at, by: F.when(F.get(_listed(bounds), at + by - 1) <= key, at + by).otherwise(at)
    return F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), step)


def bounds_of(key: Column, docs: DataFrame, n: int) -> list[int]:
    """Keys that cut the rows into about so many equal ranges."""
    return sorted({int(x) for x in docs.select(key.cast("double").alias("key")).approxQuantile("key", [i / n for i in range(1, n)], 0.25 / n)})


def with_successors(docs: DataFrame) -> DataFrame:
    """Deals rows into ranges of ascending doc_id, sorted, one shuffle; the first row of a range also ends the range before it.

    Columns: range, copy (1 for such a row, which only stands for the next document), doc_id, text. The first row of all ends
    the last range. The driver gets one bound and one least id for each range. A null id sorts first; equal ids by text.
    """
    n = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    key = whole_id(docs)
    bounds = bounds_of(key, docs, n)
    keyed = docs.select(key.alias("key"), "doc_id", "text").withColumn("here", range_of(F.col("key"), bounds))
    least = dict(keyed.groupBy("here").agg(F.min("key")).collect())
    order = sorted(least)
    before = {r: order[i - 1] for i, r in enumerate(order)}
    ranges = range(len(bounds) + 1)
    first = F.get(_listed([least.get(r, 0) for r in ranges]), F.col("here")) == F.col("key")
    there = F.get(_listed([before.get(r, 0) for r in ranges]), F.col("here")).cast("int")
    at = lambda r, copy: F.struct(r.alias("range"), F.lit(copy).alias("copy"))
    both = keyed.withColumn("at", F.explode(F.when(first, F.array(at(F.col("here"), 0), at(there, 1))).otherwise(F.array(at(F.col("here"), 0)))))
    return both.select("at.range", "at.copy", "key", "doc_id", "text").repartition(n // 4, "range").sortWithinPartitions("range", "copy", "key", "text").drop("key")


RESULT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _compare(rows: list[tuple[int, int, int, str]], samples: int, carry: bool) -> tuple[pa.RecordBatch, list]:
    """Results of all own rows whose successor is among the rows; the last row is left over if its range may go on."""
    texts = [r[3] or "" for r in rows]
    sig, empty = _of_texts(texts, samples)
    own = [i for i in range(len(rows) - 1) if rows[i][0] == rows[i + 1][0] and not rows[i][1]]
    edited = [texts[i][: len(texts[i]) - len(texts[i]) // 4] + texts[i + 1][: len(texts[i]) // 4] for i in own]
    left = rows[-1:] if carry else []
    if not own:
        return None, left
    e_sig, e_empty = _of_texts(edited, samples)
    at = np.array(own)
    hexed = lambda s: [x.tobytes().hex() for x in s.astype(">u2")]
    columns = [
        pa.array([rows[i][2] for i in own], pa.int64()),
        pa.array([len(texts[i]) for i in own], pa.int64()),
        pa.array([hashlib.sha256(x.encode()).hexdigest() for x in edited]),
        pa.array(hexed(sig[at])),
        pa.array(hexed(e_sig)),
        pa.array(likeness(sig[at], empty[at], e_sig, e_empty)),
        pa.array(likeness(sig[at], empty[at], sig[at + 1], empty[at + 1])),
    ]
    return pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in RESULT.split(", ")]), left


def compare_neighbours(docs: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """Fingerprints of every text and of its edited text, and likeness to that and to the next document's.

    Every row gives one row: a single document follows itself, rows with one doc_id follow each other by text, an empty table
    gives none. Other columns are ignored. A task holds a chunk of about a megabyte of texts at a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for row in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                held.append(row)
                size += len(row[3] or "")
                if size > CHUNK:
                    done, held = _compare(held, samples, True)
                    size = sum(len(r[3] or "") for r in held)
                    if done:
                        yield done
        if held:
            done, _ = _compare(held, samples, False)
            if done:
                yield done

    return with_successors(pick(docs, "doc_id", "text")).mapInArrow(run, RESULT)


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_neighbours(table(spark, sf_dir, "documents"))
