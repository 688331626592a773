"""Scoring texts with an interpolated modified Kneser-Ney bigram model of words.

Counting: each task packs its bigrams, sorted and counted, into one blob for each shard. Shards are cells of a grid, rows by the hash of
the first word and columns by that of the second, so the successors of a hot word are dealt over a row of shards and its predecessors over a
column. A shard's blobs are merged into a sorted hash array of bigrams with counts; what it knows of its contexts (totals, successors seen once,
twice and more) and of its second words (occurrences, distinct contexts) goes on to the shards of contexts and words, which add up. All arrays
are files in the shared folder, which the workers that score map into memory. The number of shards grows with the corpus, and every shard has
its files, empty ones too; nothing of the model passes through the driver but a few sums.

p(w | v) = (c(v, w) - D) / c(v) + g(v) q(w), with q the same over numbers of contexts, then uniform over the words and an unknown one.
Words are known by 64-bit hashes: among a billion different words about 0.03 pairs share one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import arrays, hash_store
from .common import held_out, new_folder, pick, table
from .hash_store import SMALL, top

START, END = np.uint64(0x5A17), np.uint64(0xE4D0)
#: Tokens that a task gathers before it packs them.
GATHER = 3_000_000
#: Bytes of text for each shard: their bigrams take about half as much packed.
SHARD_BYTES = 16 << 20
#: At most so many partitions for the shards.
PARTITIONS = 20_000
CHUNK = 2 << 20


def word_hashes(buf: np.ndarray, offsets: np.ndarray, more: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the tokens of all texts, each text's ended by END, and each text's first. With more, the one text goes on: no end yet."""
    lower = arrays.LOWER[buf]
    starts, ends, first = arrays.spans(lower, offsets)
    hashes, n = arrays.span_hashes(lower, starts, ends), len(offsets) - 1
    if more:
        return hashes, first
    out = np.full(len(starts) + n, END)
    out[np.arange(len(starts)) + np.repeat(np.arange(n), np.diff(first))] = hashes
    return out, first + np.arange(n + 1)


def _tokens(col: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, bool]]:
    """First and end row, tokens, each text's first, the token before each, and whether the text goes on; long texts come in pieces."""
    last = START
    for lo, hi, buf, offsets, more in arrays.pieces(col, CHUNK):
        tokens, first = word_hashes(buf, offsets, more)
        before = np.empty_like(tokens)
        before[1:] = tokens[:-1]
        before[first[:-1][np.diff(first) > 0]] = START
        if len(before) and last != START:
            before[0] = last
        last = (tokens[-1] if len(tokens) else last) if more else START
        yield lo, hi, tokens, first, before, more


def pair_keys(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return arrays.mix(arrays.mix(left) + right)


def _grid(left: np.ndarray, right: np.ndarray, bits: int) -> np.ndarray:
    """The cell of each pair: the top half of the bits are the first word's, the rest the second's."""
    columns = bits // 2
    return (top(left, bits - columns) << columns) | top(right, columns)


def _small(values: np.ndarray) -> tuple[bytes, bytes]:
    """Counts as bytes, those of 255 and more on their own."""
    return np.minimum(values, 255).astype(np.uint8).tobytes(), values[values >= 255].astype("<u8").tobytes()


def _from_small(raw: bytes, large: bytes) -> np.ndarray:
    out = np.frombuffer(raw, np.uint8).astype(np.int64)
    out[out == 255] = np.frombuffer(large, "<u8")
    return out


def _words(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, "<u8")


def _summed(left: np.ndarray, right: np.ndarray, n: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs in order, with the sums of their counts."""
    vocab, ids = np.unique(np.concatenate((left, right)), return_inverse=True)
    packed = ids[: len(left)].astype(np.uint64) << np.uint64(32) | ids[len(left) :].astype(np.uint64)
    if n is None:
        packed.sort()
        at, total = arrays.runs(packed)
    else:
        order = np.argsort(packed)
        packed = packed[order]
        at, _ = arrays.runs(packed)
        total = np.add.reduceat(n[order], at) if len(at) else n
    packed = packed[at]
    return vocab[(packed >> np.uint64(32)).astype(np.int64)], vocab[(packed & np.uint64(0xFFFFFFFF)).astype(np.int64)], total


def _table(schema: str, rows: list[list]) -> pa.Table:
    kinds = {"int": pa.int32(), "string": pa.string(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64())}
    fields = [x.split() for x in schema.split(", ")]
    return pa.table({name: pa.array([r[i] for r in rows], kinds[kind]) for i, (name, kind) in enumerate(fields)})


PACKED = "shard int, lefts binary, spread binary, spread_large binary, rights binary, n binary, n_large binary"


def _pack_pairs(tokens: list[np.ndarray], before: list[np.ndarray], bits: int) -> Iterator[pa.RecordBatch]:
    left, right, n = _summed(np.concatenate(before), np.concatenate(tokens), None)
    shard = _grid(left, right, bits)
    order = np.argsort(shard, kind="stable")
    left, right, n = left[order], right[order], n[order]
    edges = np.searchsorted(shard[order], np.arange((1 << bits) + 1))
    for s in np.flatnonzero(np.diff(edges)).tolist():
        a, b = edges[s], edges[s + 1]
        at, spread = arrays.runs(left[a:b])
        yield from _table(PACKED, [[s, left[a:b][at].tobytes(), *_small(spread), right[a:b].tobytes(), *_small(n[a:b])]]).to_batches()


def pairs(docs: DataFrame, bits: int) -> DataFrame:
    """Blobs of counted bigrams of all whole texts, for each cell of the grid."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, before, size = [], [], 0
        for batch in batches:
            for _, _, t, _, b, _ in _tokens(batch.column("text")):
                tokens.append(t)
                before.append(b)
                size += len(t)
                if size >= GATHER:
                    yield from _pack_pairs(tokens, before, bits)
                    tokens, before, size = [], [], 0
        if size:
            yield from _pack_pairs(tokens, before, bits)

    return pick(docs, "text").mapInArrow(run, PACKED)


PARTS = "kind string, shard int, keys binary, counts binary, large binary, sums array<long>"
#: What is known of a context and of a word, in this order.
CONTEXT, WORD = ("total", "once", "twice", "more"), ("seen", "kinds")


def _merge_pairs(folder: str, bits: int):
    """Writes a cell's bigrams; gives what it knows of its contexts and second words, by their shards, and how many of its bigrams count 1 to 4."""

    def merge(group: pa.Table) -> pa.Table:
        shard = group.column("shard")[0].as_py()
        get = lambda name: group.column(name).to_pylist()
        lefts = [np.repeat(_words(a), _from_small(b, c)) for a, b, c in zip(get("lefts"), get("spread"), get("spread_large"), strict=True)]
        rights = [_words(x) for x in get("rights")]
        ns = [_from_small(a, b) for a, b in zip(get("n"), get("n_large"), strict=True)]
        left, right, n = _summed(np.concatenate(lefts), np.concatenate(rights), np.concatenate(ns))
        keys = pair_keys(left, right)
        order = np.argsort(keys)
        hash_store.write(folder, f"pair{shard}", keys[order], [(SMALL, n[order])])
        at, _ = arrays.runs(left)
        sums = lambda flags: np.add.reduceat(flags.astype(np.int64), at) if len(at) else np.zeros(0, np.int64)
        words, ids = np.unique(right, return_inverse=True)
        known = [("context", left[at], np.stack([sums(n), sums(n == 1), sums(n == 2), sums(n > 2)], axis=1))]
        known.append(("word", words, np.stack([np.bincount(ids, n, len(words)).astype(np.int64), np.bincount(ids, minlength=len(words))], axis=1)))
        rows = [["pair", shard, None, None, None, [int((n == k).sum()) for k in (1, 2, 3, 4)]]]
        # The shard of this number has a row of each kind, so that its files are written even if nothing falls into it.
        rows += [[kind, shard, b"", b"", b"", None] for kind, *_ in known]
        for kind, hashes, counts in known:
            if not len(hashes):
                continue
            to = top(hashes, bits)
            edges = np.searchsorted(to, np.arange(to[0], to[-1] + 2))
            rows += [[kind, int(to[a]), hashes[a:b].tobytes(), *_small(counts[a:b].ravel()), None] for a, b in zip(edges[:-1], edges[1:], strict=True) if a < b]
        return _table(PARTS, rows)

    return merge


def _merge_parts(folder: str):
    """Adds up what the cells know of a shard of contexts or words, writes it, and gives its sums."""

    def merge(group: pa.Table) -> pa.Table:
        kind, shard = group.column("kind")[0].as_py(), group.column("shard")[0].as_py()
        if kind == "pair":
            sums = group.column("sums")[0].as_py()
        else:
            width = len(CONTEXT if kind == "context" else WORD)
            keys, ids = np.unique(np.concatenate([_words(x) for x in group.column("keys").to_pylist()]), return_inverse=True)
            counts = np.concatenate([_from_small(a, b) for a, b in zip(group.column("counts").to_pylist(), group.column("large").to_pylist(), strict=True)]).reshape(-1, width)
            added = [np.bincount(ids, counts[:, k], len(keys)).astype(np.int64) for k in range(width)]
            hash_store.write(folder, f"{kind}{shard}", keys, [(SMALL, x) for x in added])
            sums = [] if kind == "context" else [int(added[0].sum()), len(keys), int(added[1].sum()), *[int((added[1] == k).sum()) for k in (1, 2, 3, 4)]]
        return _table("kind string, shard int, sums array<long>", [[kind, shard, sums]])

    return merge


def _grouped(df: DataFrame, ids: str, n: int, merge, schema: str) -> DataFrame:
    """The rows of each id merged where they meet: partition by partition, an id after the other, each id's partition being its number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, now = [], None
        for batch in batches:
            at, length = arrays.runs(batch.column(ids).to_numpy())
            for a, k in zip(at.tolist(), length.tolist(), strict=True):
                place = batch.column(ids)[a].as_py()
                if held and place != now:
                    yield from merge(pa.Table.from_batches(held)).to_batches()
                    held = []
                now = place
                held.append(batch.slice(a, k))
        if held:
            yield from merge(pa.Table.from_batches(held)).to_batches()

    return df.repartitionById(n, ids).sortWithinPartitions(ids).mapInArrow(run, schema)


def discounts(counts: list[int]) -> np.ndarray:
    """Discounts of counts 0, 1, 2, 3 and more, from the numbers of things counted once to four times."""
    n1, n2, n3, n4 = counts
    y = n1 / (n1 + 2 * n2) if n1 + 2 * n2 else 0.5
    raw = [1 - 2 * y * n2 / n1 if n1 else 0.5, 2 - 3 * y * n3 / n2 if n2 else 1.0, 3 - 4 * y * n4 / n3 if n3 else 1.5]
    return np.array([0.0, *[min(max(d, 0.05), k - 0.05) for k, d in enumerate(raw, 1)]])


@dataclass
class Model:
    """Where the arrays are, how many bits number their shards, and the few numbers beside them."""

    folder: str
    bits: int
    tokens: int
    words: int
    kinds: int
    pair_discount: np.ndarray
    word_discount: np.ndarray
    word_spare: float


def fit(docs: DataFrame, folder: str, shard_bytes: int = SHARD_BYTES) -> Model:
    """Counts all whole texts (null: empty) and writes the model to the folder. An empty table gives a model of nothing."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = max(2, int(np.ceil(np.log2(max(size, 1) / shard_bytes))))
    n = min(1 << bits, PARTITIONS)
    blank = docs.sparkSession.range(1 << bits).select(F.col("id").cast("int").alias("shard"), *(F.lit("").cast("binary").alias(x.split()[0]) for x in PACKED.split(", ")[1:]))
    merged = _grouped(pairs(docs, bits).unionByName(blank), "shard", n, _merge_pairs(folder, bits), PARTS)
    # What is known of contexts has even numbers, of words odd ones; the sums of a cell are a row of their own.
    place = F.when(F.col("kind") == "pair", -1 - F.col("shard")).otherwise(2 * F.col("shard") + (F.col("kind") == "word").cast("int"))
    parts = _grouped(merged.withColumn("place", place), "place", 2 * n, _merge_parts(folder), "kind string, shard int, sums array<long>")
    # Three rows, however many shards there are.
    sums = {r.kind: r.sums for r in parts.groupBy("kind").agg(F.array(*(F.sum(F.get("sums", F.lit(k))) for k in range(7))).alias("sums")).collect()}
    pair_counts, total = sums["pair"][:4], sums["word"]
    d = discounts(total[3:])
    n1, n2 = total[3], total[4]
    spare = float(d[1] * n1 + d[2] * n2 + d[3] * (total[1] - n1 - n2)) / total[2] if total[2] else 1.0
    return Model(folder, bits, total[0], total[1], total[2], discounts(pair_counts), d, spare)


def token_scores(model: Model, tokens: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each token: the count in training, log10 of the model's probability, log10 of the base probability."""
    look = lambda kind, fields, keys, shards: hash_store.find(model.folder, kind, None, (SMALL,) * fields, keys, shards)
    words, at = np.unique(tokens, return_inverse=True)
    seen, kinds = look("word", 2, words, top(words, model.bits))
    q = np.maximum(kinds - model.word_discount[np.minimum(kinds, 3)], 0) / max(model.kinds, 1) + model.word_spare / (model.words + 1)
    base = np.log10((seen + 0.5) / (model.tokens + 0.5 * (model.words + 1)))
    vocab, ids = np.unique(before, return_inverse=True)
    total, once, twice, several = look("context", 4, vocab, top(vocab, model.bits))
    d = model.pair_discount
    spare = np.where(total > 0, (d[1] * once + d[2] * twice + d[3] * several) / np.maximum(total, 1), 1.0)
    pair, back = np.unique(ids * np.int64(len(words)) + at, return_inverse=True)
    left, right = np.divmod(pair, len(words))
    (n,) = look("pair", 1, pair_keys(vocab[left], words[right]), _grid(vocab[left], words[right], model.bits))
    p = np.maximum(n - d[np.minimum(n, 3)], 0) / np.maximum(total[left], 1) + spare[left] * q[right]
    return seen[at], np.log10(p)[back], base[at]


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, n_tokens, n_known, base_score and score of every whole text; null and blank texts are the end token alone. No shuffle.

    Repeated rows each get the same scores. A long text is scored piece by piece.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "n_tokens", "n_known", "base_score", "score"]
        for batch in batches:
            held = [0, 0, 0.0, 0.0]
            for lo, hi, tokens, first, before, more in _tokens(batch.column("text")):
                seen, p, base = token_scores(model, tokens, before)
                add = lambda x: np.add.reduceat(x, first[:-1])  # noqa: B023, E731
                if more:
                    held = [a + b for a, b in zip(held, (len(tokens), int((seen > 0).sum()), base.sum(), p.sum()), strict=True)]
                    continue
                columns = [np.diff(first), add((seen > 0).astype(np.int64)), add(base), add(p)]
                for column, x in zip(columns, held, strict=True):
                    column[0] += x
                held = [0, 0, 0.0, 0.0]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(lo, hi - lo), *map(pa.array, columns)], names=names)

    return pick(docs, "doc_id", "text").mapInArrow(run, docs.select("doc_id").schema.add("n_tokens", "long").add("n_known", "long").add("base_score", "double").add("score", "double"))


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs.filter(~held_out(1)), new_folder(spark, "word-lm"))
    done = score(docs, model)
    return done.select("doc_id", held_out(1).alias("held_out"), "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score")
