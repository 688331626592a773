"""Token-id files in bit planes.

A file is ``TDMK1\\n``, then chunks, then an index, then the index's offset (8 bytes little-endian). Each chunk holds up to BLOCK
32-bit ids, transposed into four byte planes, each compressed with zstandard on its own, so that the nearly constant high planes
shrink to almost nothing. The index (JSON) has for every chunk its offset, plane lengths and number of ids, and for every
document its doc_id, start in the whole table and number of ids.

Files live as rows (file number, bytes) of a Parquet table in the shared folder: Spark's committer makes each whole or absent, on
any file system that Spark writes.
"""

from __future__ import annotations

import json
import re
import struct
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import arrays
from .bpe import vocabulary_path
from .common import broadcast_if_few, new_folder, pick, table
from .fingerprints import bounds_of, range_of, whole_id

MAGIC = b"TDMK1\n"
BLOCK = 1 << 16
END_ID = 0
MODEL = "byte_bpe_50k.json"
#: Units that a worker remembers the ids of; beyond this it starts anew.
MEMORY = 1_000_000
CHUNK = 2 << 20
#: Bytes before which a blank is no cut: white space, and first bytes of characters among which there is white space.
_UNSAFE = np.zeros(256, bool)
_UNSAFE[[0x20, *range(0x09, 0x0E), *range(0x1C, 0x20), 0xC2, 0xE1, 0xE2, 0xE3]] = True
_LETTER = np.zeros(256, bool)
_LETTER[[c for c in range(128) if chr(c).isalpha()]] = True
_MARK = np.zeros(256, bool)
_MARK[[c for c in range(0x21, 0x7F) if not chr(c).isalnum()]] = True


class Encoder:
    """Encodes chunks of texts with the tokenizers library, each distinct unit once.

    Texts are cut before a blank that is followed by another character than white space, between an ASCII letter and a mark, and between
    a lone line feed and an ASCII letter. No match of the pattern crosses these places, nor does one before them look beyond, so the
    ids of a text are those of its units in turn. An added token in a text (as ``<|endoftext|>``) is a unit, as it is for the library, whose
    settings are left as they are; with ``special_as_text`` it is text like any other. Units are known by one 64-bit hash and checked by
    another; a chunk in which they disagree is encoded text by text.
    """

    def __init__(self, path: str, special_as_text: bool = False) -> None:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = special_as_text
        added = self.library.get_added_tokens_decoder().values()
        self.whole = [t.content.encode() for t in added if not (special_as_text and t.special)]
        #: Added tokens that take in what is around them, or are sought in normalised text, let no text be cut.
        self.cuts = self.library.normalizer is None and not any(t.lstrip or t.rstrip or t.single_word for t in added)
        vocab = self.library.get_vocab()
        # In a byte-level vocabulary each character of a token stands for one byte; an added one stands for itself.
        self.width = np.zeros(max(vocab.values()) + 1, np.int64)
        for token, i in vocab.items():
            self.width[i] = len(token)
        for t in added:
            self.width[vocab[t.content]] = len(t.content.encode())
        self._forget()

    def _forget(self) -> None:
        self.at: dict[int, int] = {}
        self.check = np.zeros(1 << 16, np.uint64)
        self.first, self.length, self.ids, self.used = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64), np.zeros(1 << 18, "<u4"), 0

    def _learn(self, hashes: list[int], checks: np.ndarray, spans: list[tuple[int, int]], raw: bytes) -> None:
        joined, alone = [], []
        for h, c, (a, b) in zip(hashes, checks.tolist(), spans, strict=True):
            (joined if b - a > 1 and raw[a] == 0x20 and not _UNSAFE[raw[a + 1]] else alone).append((h, a, b, c))
        groups = [joined[k : k + 1000] for k in range(0, len(joined), 1000)] + [[x] for x in alone]
        texts = [b"".join(raw[a:b] for _, a, b, _ in g).decode() for g in groups]
        for group, found in zip(groups, self.library.encode_batch_fast(texts, add_special_tokens=False), strict=True):
            ids = np.array(found.ids, "<u4")
            ends = np.searchsorted(np.cumsum(self.width[ids]), np.cumsum([b - a for _, a, b, _ in group])) + 1
            n = len(self.at)
            while n + len(group) > len(self.first):
                self.first, self.length, self.check = (np.resize(x, 2 * len(x)) for x in (self.first, self.length, self.check))
            while self.used + len(ids) > len(self.ids):
                self.ids = np.resize(self.ids, 2 * len(self.ids))
            begins = np.concatenate(([0], ends[:-1]))
            self.first[n : n + len(group)], self.length[n : n + len(group)] = begins + self.used, ends - begins
            self.check[n : n + len(group)] = [c for *_, c in group]
            self.ids[self.used : self.used + len(ids)] = ids
            self.used += len(ids)
            self.at.update(zip((h for h, *_ in group), range(n, n + len(group)), strict=True))

    def _plainly(self, buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What encode() gives, by the library alone."""
        texts = [bytes(buf[a:b]).decode() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        found = [np.array(x.ids, "<u4") for x in self.library.encode_batch_fast(texts, add_special_tokens=False)]
        return np.concatenate(found), np.array([len(x) for x in found], np.int64)

    def encode(self, buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of a chunk in a row, and how many each text has."""
        n = len(offsets) - 1
        if not len(buf):
            return np.zeros(0, "<u4"), np.zeros(n, np.int64)
        if not self.cuts:
            return self._plainly(buf, offsets)
        cut = np.zeros(len(buf), bool)
        cut[:-1] = (buf[:-1] == 0x20) & ~_UNSAFE[buf[1:]]
        cut[1:] |= _LETTER[buf[:-1]] & _MARK[buf[1:]]
        cut[2:] |= ((_LETTER | _MARK)[buf[:-2]]) & (buf[1:-1] == 0x0A) & _LETTER[buf[2:]]
        raw = buf.tobytes()
        if any(t in raw for t in self.whole):
            # The library takes the longest added token that begins first.
            for m in re.finditer(b"|".join(map(re.escape, sorted(self.whole, key=len, reverse=True))), raw):
                cut[m.start() + 1 : m.end()] = False
                cut[[m.start(), *([m.end()] if m.end() < len(buf) else [])]] = True
        cut[offsets[:-1][np.diff(offsets) > 0]] = True
        starts = np.flatnonzero(cut)
        ends = np.append(starts[1:], len(buf))
        hashes, checks = arrays.span_hashes(buf, starts, ends), arrays.span_hashes(buf, starts, ends, 1)
        order = np.argsort(hashes)
        at, times = arrays.runs(hashes[order])
        where = order[at]
        hashes = hashes[where]
        if len(self.at) > MEMORY:
            self._forget()
        keys = hashes.tolist()
        new = [i for i, h in enumerate(keys) if h not in self.at]
        if new:
            first = where[new]
            self._learn([keys[i] for i in new], checks[first], list(zip(starts[first].tolist(), ends[first].tolist(), strict=True)), raw)
        unit = np.empty(len(starts), np.int64)
        unit[order] = np.repeat(np.array([self.at[h] for h in keys], np.int64), times)
        if (self.check[unit] != checks).any():
            return self._plainly(buf, offsets)
        length = self.length[unit]
        upto = np.cumsum(length)
        ids = self.ids[np.repeat(self.first[unit] - (upto - length), length) + np.arange(upto[-1])]
        per_text = np.diff(np.concatenate(([0], upto))[np.searchsorted(starts, offsets)])
        return ids, per_text


@cache
def encoder(path: str) -> Encoder:
    """One for each Python worker."""
    return Encoder(path)


def encode_with_end(col: pa.Array, path: str, end_id: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Chunk by chunk: the first row, the ids of its texts, each text's followed by the end id, and where each text's end."""
    for lo, _, buf, offsets in arrays.chunks(col, CHUNK):
        ids, n = encoder(path).encode(buf, offsets)
        ends = np.cumsum(n + 1)
        out = np.full(ends[-1], end_id, "<u4")
        inside = np.ones(ends[-1], bool)
        inside[ends - 1] = False
        out[inside] = ids
        yield lo, out, ends


def pack(ids: np.ndarray, docs: list[list[int]], block: int = BLOCK) -> bytes:
    """The bytes of a file."""
    out, index, squeeze = [MAGIC], [], zstandard.ZstdCompressor(level=3)
    at = len(MAGIC)
    for lo in range(0, len(ids), block):
        part = ids[lo : lo + block].astype("<u4")
        planes = [squeeze.compress(p.tobytes()) for p in part.view(np.uint8).reshape(-1, 4).T]
        index.append([at, [len(p) for p in planes], len(part)])
        out += planes
        at += sum(index[-1][1])
    tail = squeeze.compress(json.dumps({"chunks": index, "docs": docs}).encode())
    return b"".join([*out, tail, struct.pack("<Q", at)])


def read_index(raw: bytes) -> dict:
    if raw[: len(MAGIC)] != MAGIC:
        raise ValueError("not a token file")
    (at,) = struct.unpack("<Q", raw[-8:])
    return json.loads(zstandard.ZstdDecompressor().decompress(raw[at:-8], max_output_size=1 << 31))


def unpack(raw: bytes, first: int = 0, end: int | None = None) -> np.ndarray:
    """Ids first to end of a file; only the chunks that hold them are decompressed."""
    grow, at, out = zstandard.ZstdDecompressor(), 0, []
    for offset, lengths, n in read_index(raw)["chunks"]:
        if at + n > first and (end is None or at < end):
            planes, pos = [], offset
            for length in lengths:
                planes.append(np.frombuffer(grow.decompress(raw[pos : pos + length], max_output_size=n), np.uint8))
                pos += length
            ids = np.ascontiguousarray(np.stack(planes, axis=1)).view("<u4").ravel()
            out.append(ids[max(0, first - at) : None if end is None else max(0, end - at)])
        at += n
    return np.concatenate(out) if out else np.zeros(0, "<u4")


def write_files(docs: DataFrame, folder: str, model: str = MODEL, end_id: int = END_ID, ids_a_file: int = 4 << 20) -> None:
    """Encodes every whole text (null: empty), appends the end id, and writes ids in ascending doc_id order (nulls first, equal ids by text).

    Files hold whole documents, about ``ids_a_file`` ids. Ids of ranges of documents are packed where they were encoded, and
    the starts follow from the ranges' sums, so no text or id passes the driver.
    """
    path = vocabulary_path(model)
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    key = whole_id(docs)
    rows = pick(docs, "doc_id", "text").select(range_of(key, bounds_of(key, docs, 4 * n)).alias("range"), "doc_id", "text")
    dealt = rows.repartition(n, "range").sortWithinPartitions("range", key, "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, seq, ids, listed, size = None, 0, [], [], 0

        def flush() -> pa.RecordBatch:
            raw = pack(np.concatenate(ids), listed)
            return pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([seq], pa.int32()), pa.array([size], pa.int64()), pa.array([raw], pa.binary())], names=["range", "seq", "n_ids", "raw"])

        for batch in batches:
            places, doc_ids = batch.column("range").to_pylist(), batch.column("doc_id").to_pylist()
            for lo, made, ends in encode_with_end(batch.column("text"), path, end_id):
                begin = 0
                for k, end in enumerate(ends.tolist()):
                    place = places[lo + k]
                    if ids and (place != now or size >= ids_a_file):
                        yield flush()
                        seq, ids, listed, size = seq + 1 if place == now else 0, [], [], 0
                    if place != now:
                        now, seq = place, 0
                    listed.append([doc_ids[lo + k], size, end - begin])
                    ids.append(made[begin:end])
                    size += end - begin
                    begin = end
        if ids:
            yield flush()

    dealt.mapInArrow(run, "range int, seq int, n_ids long, raw binary").write.mode("overwrite").parquet(folder)


def read_files(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start (in the whole table), n_tokens, ids (binary, little-endian) of every document of the files.

    Starts come from a running sum over the list of files (one row for each file, not for each document).
    """
    from pyspark.sql import Window

    files = spark.read.schema("range int, seq int, n_ids long, raw binary").parquet(folder)
    sums = files.groupBy("range").agg(F.sum("n_ids").alias("n"))
    before = sums.select("range", F.coalesce(F.sum("n").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    within = Window.partitionBy("range").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    starts = files.select("range", "seq", F.coalesce(F.sum("n_ids").over(within), F.lit(0)).alias("here")).join(before, "range").select("range", "seq", (F.col("here") + F.col("before")).alias("first"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for raw, first in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                raw = raw.as_py()
                docs, ids = read_index(raw)["docs"], unpack(raw)
                for lo in range(0, len(docs), 512):
                    part = docs[lo : lo + 512]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([d for d, *_ in part], pa.int64()), pa.array([first + s for _, s, _ in part], pa.int64()), pa.array([k for *_, k in part], pa.int64()), pa.array([ids[s : s + k].tobytes() for _, s, k in part], pa.binary())],
                        names=["doc_id", "start", "n_tokens", "ids"],
                    )

    # A row of starts for each file.
    return files.join(broadcast_if_few(starts), ["range", "seq"]).select("raw", "first").mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "token-files")
    write_files(table(spark, sf_dir, "documents"), folder)
    return read_files(spark, folder).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
