"""Suffix-array dedup: removes every byte of a text that a string of 400 bytes covers which starts anywhere else too.

A window is a string of 400 bytes. Its key is the least hash of its grams, so equal windows have equal keys, and a key lasts for some two
hundred windows: a stretch. Keys that occur once have nothing to match and go. The other stretches, cut from the texts with the bytes of their
windows, meet by key; equal ones are one with a count. Whole keys, a megabyte at a time, are a shard. It is sorted by external induced sorting
(``suffixes``), and two neighbours of the suffix order that share 400 bytes are repeats. A stretch that occurs more than once is a repeat as
it stands. Where a text repeats itself closely, a stretch goes on; it counts as two.

A key under which more bytes lie than a sort takes is told apart by more keys, those of halves, quarters and so on of its windows, and what
occurs once goes again; in the end the whole window is the key, so that stretches under one key are equal. No key is cut off.
"""

from __future__ import annotations

import hashlib
import itertools
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import arrays, suffixes
from .common import broadcast_if_few, cut_lineage, new_folder, pick, set_aside, table

#: Bytes of a window and of a gram; bytes of unlike stretches under one key that are sorted at once. A shard of several keys has half of them at most.
LENGTH, GRAM, SHARD = 400, 32, 2 << 20
#: Most partitions that shards and texts are dealt to; a partition holds more of them then.
PARTITIONS = 20_000
#: Windows that are keyed at a time, and bytes of texts to a bucket.
_SEGMENT, _BUCKET = 1 << 16, 32 << 20
#: Bytes of stretches or texts to a file of an intermediate table.
_FILE = 8 << 20
_FACTOR = 0x9E3779B97F4A7C15
_FULL = 99


@lru_cache(maxsize=8)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number modulo 2 ** 64 and of its inverse."""
    out = []
    for base in (_FACTOR, pow(_FACTOR, -1, 1 << 64)):
        row = np.full(n, base, np.uint64)
        row[0] = 1
        out.append(np.multiply.accumulate(row))
    return out[0], out[1]


_BYTES = arrays.mix(np.arange(1, 257, dtype=np.uint64))


def _slid_least(x: np.ndarray, width: int) -> np.ndarray:
    """The least of each stretch of so many values."""
    n = len(x)
    rows = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    rows[:n] = x
    rows = rows.reshape(-1, width)
    ahead, behind = np.minimum.accumulate(rows, axis=1).ravel(), np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def _pairs(grams: np.ndarray, least: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and last window, and key, of those windows that hold a gram twice which is the key of a window around it. All that do are among these."""
    pad = np.full(width - 1, np.iinfo(np.uint64).max, np.uint64)
    greatest = ~_slid_least(np.concatenate((pad, ~least, pad)), width)
    held = np.flatnonzero(greatest == grams)
    near = np.flatnonzero((grams[held[1:]] == grams[held[:-1]]) & (np.diff(held) < width))
    return np.maximum(held[near + 1] - width + 1, 0), np.minimum(held[near], len(least) - 1), grams[held[near]]


def _keys(buf: np.ndarray, level: int, length: int, gram: int, pairs: bool) -> tuple[np.ndarray, tuple[np.ndarray, ...]]:
    """The key of each window: the least gram hashes of its 2 ** level parts, or a hash of all of it where a part is less than a gram; and _pairs() if asked for."""
    up, down = _powers(_SEGMENT + length + 1)
    total = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(_BYTES[buf] * up[: len(buf)], out=total[1:])
    width = (length - gram + 1) >> level if level != _FULL else 0
    n = len(buf) - length + 1
    if not width:
        return arrays.mix((total[length:] - total[:-length]) * down[:n]), ()
    grams = (total[gram:] - total[:-gram]) * down[: len(buf) - gram + 1]
    grams ^= grams >> np.uint64(32)
    grams *= np.uint64(0xBF58476D1CE4E5B9)
    grams ^= grams >> np.uint64(29)
    least = _slid_least(grams, width)
    if not level:
        return least[:n], _pairs(grams, least, width) if pairs else ()
    key = np.zeros(n, np.uint64)
    for k in range(1 << level):
        key = arrays.mix(key * np.uint64(_FACTOR) + least[k * width : k * width + n])
    return key, ()


def stretches(buf: np.ndarray, offsets: np.ndarray, level: int = 0, length: int = LENGTH, gram: int = GRAM, pairs: bool = True) -> tuple[np.ndarray, ...]:
    """Row, first window, end and key of each stretch of windows of one key in the rows of a buffer, and (at level 0, with pairs) whether two of them may be equal.

    Equal windows further apart are in two stretches. Texts are taken a segment at a time.
    """
    found: list[tuple[np.ndarray, ...]] = []
    for lo in range(0, max(len(buf) - length + 1, 0), _SEGMENT):
        part = buf[lo : lo + _SEGMENT + length - 1]
        at = np.arange(lo, lo + len(part) - length + 1)
        row = np.searchsorted(offsets, at, "right") - 1
        inside = at + length <= offsets[row + 1]
        at, row = at[inside], row[inside]
        if not len(at):
            continue
        key, twice = _keys(part, level, length, gram, pairs)
        key = key[at - lo]
        new = np.flatnonzero(np.concatenate(([True], (key[1:] != key[:-1]) | (row[1:] != row[:-1]))))
        end = at[np.append(new[1:], len(at)) - 1] + 1
        twofold = np.zeros(len(new), bool)
        if twice and len(twice[0]):
            first = np.maximum(np.searchsorted(at[new], twice[0] + lo, "right") - 1, 0)
            size = np.maximum(np.searchsorted(at[new], twice[1] + lo, "right") - first, 0)
            which = np.repeat(first - np.cumsum(size) + size, size) + np.arange(size.sum())
            twofold[which[key[new][which] == np.repeat(twice[2], size)]] = True
        found.append((row[new], at[new] - offsets[row[new]], end - offsets[row[new]], key[new], twofold))
    if not found:
        return (*(np.zeros(0, np.int64) for _ in range(3)), np.zeros(0, np.uint64), np.zeros(0, bool))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _in_files(rows: DataFrame, size: int) -> DataFrame:
    """Rows of so many bytes in all, in no more partitions than these bytes need: a small file takes longer than what is in it."""
    return rows.coalesce(max(2 * rows.sparkSession.sparkContext.defaultParallelism, min(size // _FILE + 1, PARTITIONS)))


def _rows(batch: pa.RecordBatch, name: str) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    return arrays.chunks(batch.column(name).cast(pa.large_binary()))


def _keyed(rows: DataFrame, level: int, length: int, gram: int, counted: bool) -> DataFrame:
    """id and key of each stretch of the rows (id, body, copies, twofold), and, if it is counted, the copies of its row, twice as many where two of its windows may be equal."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, buf, offsets in _rows(batch, "body"):
                own = batch.slice(lo, hi - lo)
                row, _, _, key, twofold = stretches(buf, offsets, level, length, gram, pairs=counted)
                copies = (own.column("copies").to_numpy() * (1 + own.column("twofold").to_numpy(zero_copy_only=False)))[row] * (1 + twofold)
                yield pa.RecordBatch.from_arrays([own.column("id").take(pa.array(row)), pa.array(key.view(np.int64)), pa.array(copies)], names=["id", "key", "copies"])

    return rows.select("id", "copies", "twofold", "body").mapInArrow(run, "id binary, key long, copies long")


def _cut(rows: DataFrame, level: int, length: int, gram: int) -> DataFrame:
    """The stretches of the rows whose keys are wanted: text, at (the first window's place in it), key, mark (a hash of body), copies, twofold, body."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, buf, offsets in _rows(batch, "body"):
                own = batch.slice(lo, hi - lo)
                row, start, end, key, twofold = stretches(buf, offsets, level, length, gram)
                twofold |= own.column("twofold").to_numpy(zero_copy_only=False)[row]
                wanted = own.column("wanted")
                size = np.diff(np.asarray(wanted.offsets))
                pairs = np.stack((np.repeat(np.arange(hi - lo), size).astype(np.uint64), np.asarray(wanted.flatten()).view(np.uint64)), axis=1)
                asked = np.sort(arrays.mix(pairs[:, 1] + arrays.mix(pairs[:, 0])))
                mine = arrays.mix(key + arrays.mix(row.astype(np.uint64)))
                at = np.minimum(np.searchsorted(asked, mine), max(len(asked) - 1, 0))
                hit = np.flatnonzero(asked[at] == mine) if len(asked) else np.zeros(0, np.int64)
                row, start, end, key, twofold = (x[hit] for x in (row, start, end, key, twofold))
                raw = memoryview(np.ascontiguousarray(buf))
                # A few megabytes at a time: a stretch's bytes overlap with the next one's.
                size = np.cumsum(end - start + length - 1)
                cuts = np.unique(np.append(np.searchsorted(size, np.arange(0, size[-1] if len(size) else 0, 4 << 20)), len(hit)))
                for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                    bodies = [bytes(raw[offsets[r] + s : offsets[r] + e + length - 1]) for r, s, e in zip(row[a:b].tolist(), start[a:b].tolist(), end[a:b].tolist(), strict=True)]
                    take = pa.array(row[a:b])
                    place = np.asarray(own.column("at").take(take)) + start[a:b]
                    marks = [xxhash.xxh3_128_digest(x) for x in bodies]
                    yield pa.RecordBatch.from_arrays(
                        [own.column("text").take(take), pa.array(place), pa.array(key[a:b].view(np.int64)), pa.array(marks, pa.binary()), own.column("copies").take(take), pa.array(twofold[a:b]), pa.array(bodies, pa.binary())],
                        names=["text", "at", "key", "mark", "copies", "twofold", "body"],
                    )

    return rows.select("id", "text", "at", "copies", "twofold", "wanted", "body").mapInArrow(run, "text binary, at long, key long, mark binary, copies long, twofold boolean, body binary")


def narrowed(rows: DataFrame, level: int, size: int, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """Of rows (id, text, at, copies, twofold, body) of so many bytes in all, each id once, the stretches whose keys occur more than once."""
    repeated = cut_lineage(_in_files(_keyed(rows, level, length, gram, True).groupBy("key").agg(F.sum("copies").alias("n")).filter("n > 1").select("key"), size))
    wanted = _keyed(rows, level, length, gram, False).select("id", "key").join(broadcast_if_few(repeated), "key", "left_semi").groupBy("id").agg(F.collect_set("key").alias("wanted"))
    return _cut(rows.join(wanted, "id"), level, length, gram)


def repeated_windows(bodies: list[np.ndarray], length: int = LENGTH, memory: int = suffixes.MEMORY) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each body the starts and ends of the stretches of windows that start anywhere else too, among all bodies."""
    size = np.array([len(x) for x in bodies], np.int64)
    ends = np.cumsum(size + 1)
    text = suffixes.room(int(ends[-1]) + 1, np.uint16, memory)
    for x, end in zip(bodies, ends.tolist(), strict=True):
        text[end - 1 - len(x) : end - 1] = x.astype(np.uint16) + 2
        text[end - 1] = 1
    order, shared = suffixes.suffix_order(text, 258, length, memory)
    hit = np.flatnonzero(shared >= length)
    flag = np.zeros(len(text) + 1, np.int8)
    # Bodies end in the same number, so only windows that lie within a body count; what one of two neighbours holds, so does the other.
    flag[order[hit]] = 1
    flag[order[hit - 1]] = 1
    begins = ends - size - 1
    for x, end in zip(size.tolist(), ends.tolist(), strict=True):
        flag[max(end - 1 - x, end - length) : end] = 0
    change = np.flatnonzero(np.diff(flag, prepend=0))
    first, last = change[0::2], change[1::2]
    cut = np.searchsorted(first, np.append(begins, ends[-1]))
    return [(first[a:b] - begin, last[a:b] - begin) for a, b, begin in zip(cut[:-1], cut[1:], begins.tolist(), strict=True)]


def _repeats_of_shard(shard: pa.Table, length: int) -> pa.Table:
    """key, mark, begins and ends of the contexts of a shard that have repeated windows."""
    key, n = shard.column("key").to_numpy(), shard.column("n").to_numpy()
    _, of, under = np.unique(key, return_inverse=True, return_counts=True)
    several = np.flatnonzero((under[of] > 1) | shard.column("twofold").to_numpy())
    body = shard.column("body")
    view = lambda i: np.frombuffer(body[i].as_buffer(), np.uint8)
    begins: list[list[int]] = [[] for _ in range(len(key))]
    ends: list[list[int]] = [[] for _ in range(len(key))]
    if len(several):
        for i, (a, b) in zip(several.tolist(), repeated_windows([view(i) for i in several.tolist()], length), strict=True):
            begins[i], ends[i] = a.tolist(), b.tolist()
    for i in np.flatnonzero(n > 1).tolist():
        begins[i], ends[i] = [0], [len(view(i)) - length + 1]
    some = [i for i, x in enumerate(begins) if x]
    keep = pa.array(some, pa.int64())
    lists = lambda x: pa.array([x[i] for i in some], pa.list_(pa.int32()))
    return pa.table({"key": shard.column("key").take(keep), "mark": shard.column("mark").take(keep), "begins": lists(begins), "ends": lists(ends)})


def shards_of(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.Table]:
    """Rows (key, body and others) that come by key, in tables of whole keys: of so many bytes of bodies at most, unless a key alone has more."""
    held: list[pa.RecordBatch] = []
    for batch in itertools.chain(batches, [None]):
        if batch is not None:
            held += [batch] if len(batch) else []
            ends = [x.column("key")[i].as_py() for x in held[-2:] for i in (0, -1)]
            if len(set(ends)) < 2:
                continue
        if not held:
            return
        rows = pa.Table.from_batches(held).combine_chunks()
        starts = np.concatenate(([0], np.flatnonzero(np.diff(rows.column("key").to_numpy())) + 1))
        if batch is None:
            starts = np.append(starts, len(rows))
        # The last key may go on in the next batch.
        size = np.concatenate(([0], np.cumsum(pc.binary_length(rows.column("body")).to_numpy().astype(np.int64) + 1)))[starts]
        at = 0
        while at < len(starts) - 1:
            to = max(int(np.searchsorted(size, size[at] + limit, "right")) - 1, at + 1)
            yield rows.slice(starts[at], starts[to] - starts[at])
            at = to
        held = rows.slice(starts[at]).to_batches()


def _sorted_shards(contexts: DataFrame, partitions: int, limit: int, length: int) -> DataFrame:
    """key, mark and the stretches of repeated windows of each distinct context (key, mark, n, twofold, body). A task sorts its shards one by one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in shards_of(batches, limit):
            yield from _repeats_of_shard(shard, length).to_batches(max_chunksize=5000)
        pa.default_memory_pool().release_unused()

    schema = "key long, mark binary, begins array<int>, ends array<int>"
    dealt = contexts.select("key", "mark", "n", "twofold", "body")
    return dealt.repartition(min(partitions, PARTITIONS), "key").sortWithinPartitions("key").mapInArrow(run, schema)


def _spans(rows: DataFrame, bytes_in: int, length: int, gram: int, shard: int) -> DataFrame:
    """text, first and last: stretches of repeated windows of the texts, rows (id, text, at, copies, twofold, body) of so many bytes in all."""
    spark = rows.sparkSession
    found: list[DataFrame] = []
    level = 0
    while True:
        folder = new_folder(spark, "repeat-stretches")
        _in_files(narrowed(rows, level, bytes_in, length, gram), bytes_in).write.parquet(folder)
        cut = spark.read.parquet(folder)
        folder = new_folder(spark, "repeat-contexts")
        met = cut.groupBy("key", "mark").agg(F.sum("copies").alias("n"), F.max("twofold").alias("twofold"), F.first("body").alias("body"))
        _in_files(met, bytes_in).write.parquet(folder)
        contexts = spark.read.parquet(folder)
        size = F.sum(F.length("body") + 1).alias("size")
        total = contexts.agg(size).first()["size"] or 0
        # No more keys than the bytes make shards.
        heavy = cut_lineage(_in_files(contexts.groupBy("key").agg(size, F.count("*").alias("unlike")).filter((F.col("size") > shard) & (F.col("unlike") > 1)).select("key"), total))
        some = not heavy.isEmpty() and level != _FULL
        light = contexts.join(F.broadcast(heavy), "key", "left_anti") if some else contexts
        marked = _sorted_shards(light, total // shard + 1, shard // 2, length)
        spans = cut.select("text", "at", "key", "mark").join(marked, ["key", "mark"])
        spans = spans.select("text", "at", F.explode(F.arrays_zip("begins", "ends")).alias("span"))
        found.append(spans.select("text", (F.col("at") + F.col("span.begins")).alias("first"), (F.col("at") + F.col("span.ends")).alias("last")))
        if not some:
            break
        own = F.unhex(F.substring(F.sha2(F.concat(F.col("text"), F.encode(F.concat_ws(" ", "at", "key"), "utf-8")), 256), 1, 32))
        rows = cut.join(F.broadcast(heavy), "key", "left_semi").select(own.alias("id"), "text", "at", "copies", "twofold", "body")
        bytes_in = rows.agg(F.sum(F.length("body"))).first()[0] or 0
        level = level + 1 if (length - gram + 1) >> (level + 1) else _FULL
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def _text_id(text: Column) -> Column:
    """128 bits of a cryptographic hash."""
    return F.unhex(F.substring(F.sha2(text, 256), 1, 32))


def kept_bytes(body: bytes, firsts: list[int], lasts: list[int], length: int) -> tuple[bytes, int, int]:
    """What is left without the windows from each first up to each last, the bytes removed and the runs that they form."""
    if not firsts:
        return body, 0, 0
    by = np.argsort(firsts)
    first, last = np.array(firsts)[by], np.maximum.accumulate(np.array(lasts)[by] + length - 1)
    new = np.concatenate(([True], first[1:] > last[:-1]))
    edge = np.flatnonzero(new)
    starts, ends = first[edge], last[np.append(edge[1:], len(first)) - 1]
    pieces, at = [], 0
    for a, b in zip(starts.tolist(), ends.tolist(), strict=True):
        pieces.append(body[at:a])
        at = b
    pieces.append(body[at:])
    return b"".join(pieces), int((ends - starts).sum()), len(starts)


def _texts(spark: SparkSession, ids: DataFrame) -> tuple[DataFrame, str, int]:
    """Each different text once, with its copies, in buckets by id, so that what is found of texts meets them without moving them; the table's name; and the bytes of all texts."""
    # Copies meet in each task before anything moves.
    distinct = ids.groupBy("id").agg(F.count("*").alias("copies"), F.first("body").alias("body"))
    bytes_in = ids.agg(F.sum(F.length("body"))).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(bytes_in // _BUCKET + 1, PARTITIONS))
    name = f"tidemark_texts_{uuid.uuid4().hex}"
    distinct.repartition(buckets, "id").write.format("parquet").bucketBy(buckets, "id").option("path", new_folder(spark, "repeat-texts")).saveAsTable(name)
    return spark.table(name), name, bytes_in


def without_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, shard: int = SHARD, body: bool = False) -> DataFrame:
    """The rows of docs with n_bytes, n_removed, n_spans, kept_sha256 and, if asked for, kept (the bytes that are left).

    A null text is empty, and a text under so many bytes stays whole. Repeated rows are copies of each other, so all their windows repeat. Other
    columns come through; those named like a result are replaced. Hashes choose what is compared; a key or a stretch (128 bits) that two
    share by chance can only bring texts together or take two for one with odds under 2 ** -60.
    """
    spark = docs.sparkSession
    docs = docs.drop("n_bytes", "n_removed", "n_spans", "kept_sha256", "kept")
    docs, back = set_aside(docs, ["text_id"])
    pick(docs, "text")
    raw = F.coalesce("text", F.lit("")).cast("binary")
    texts, name, bytes_in = _texts(spark, docs.select(_text_id(raw).alias("id"), raw.alias("body")))
    spans = _spans(texts.select("id", F.col("id").alias("text"), F.lit(0).cast("long").alias("at"), "copies", F.lit(False).alias("twofold"), "body"), bytes_in, length, gram, shard)
    spans = spans.groupBy("text").agg(F.collect_list("first").alias("firsts"), F.collect_list("last").alias("lasts")).withColumnRenamed("text", "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: list[list] = [[], [], [], [], []]
            for text, firsts, lasts in zip(batch.column("body"), batch.column("firsts").to_pylist(), batch.column("lasts").to_pylist(), strict=True):
                text = text.as_py()
                kept, removed, runs = kept_bytes(text, firsts or [], lasts or [], length)
                for column, value in zip(columns, (len(text), removed, runs, hashlib.sha256(kept).hexdigest(), kept), strict=True):
                    column.append(value)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
            made = [pa.array(x, kind) for x, kind in zip(columns, kinds, strict=True)][: 5 if body else 4]
            yield pa.RecordBatch.from_arrays([batch.column("id"), *made], names=["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"][: len(made) + 1])

    schema = "id binary, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * body
    folder = new_folder(spark, "repeat-kept")
    _in_files(texts.select("id", "body").join(spans, "id", "left").mapInArrow(run, schema), bytes_in).write.parquet(folder)
    spark.sql(f"DROP TABLE {name}")
    found = spark.read.parquet(folder)
    return docs.withColumn("text_id", _text_id(raw)).join(found.withColumnRenamed("id", "text_id"), "text_id").drop("text_id").withColumnsRenamed(back)


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return without_repeats(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


OP13_SQL = """
WITH texts AS (
    SELECT row_number() OVER () AS r, doc_id, encode(coalesce(text, '')) AS t, octet_length(encode(coalesce(text, ''))) AS n FROM documents
),
windows AS (
    SELECT r, n, i, md5_number(array_slice(t, i, i + 399)) AS w FROM (SELECT r, t, n, unnest(range(1, n - 398)) AS i FROM texts WHERE n >= 400)
),
repeated AS (
    SELECT w FROM windows GROUP BY w HAVING count(*) > 1
),
starts AS (
    SELECT r, n, i, i > coalesce(lag(i) OVER (PARTITION BY r ORDER BY i) + 400, 0) AS opens FROM windows WHERE w IN (FROM repeated)
),
spans AS (
    SELECT r, n, min(i) AS a, max(i) + 399 AS b FROM (SELECT *, sum(opens::INT) OVER (PARTITION BY r ORDER BY i) AS span FROM starts) GROUP BY r, n, span
),
pieces AS (
    SELECT r, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) + 1 AS x, a - 1 AS y FROM spans UNION ALL SELECT r, max(b) + 1, n FROM spans GROUP BY r, n
),
cut AS (
    SELECT p.r, string_agg(hex(CASE WHEN y >= x THEN array_slice(t, x, y) ELSE ''::BLOB END), '' ORDER BY x) AS kept FROM pieces p JOIN texts USING (r) GROUP BY p.r
),
totals AS (
    SELECT r, sum(b - a + 1) AS n_removed, count(*) AS n_spans FROM spans GROUP BY r
)
SELECT doc_id, n AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(coalesce(unhex(kept), t)) AS kept_sha256
FROM texts LEFT JOIN totals USING (r) LEFT JOIN cut USING (r)
"""
