"""Byte-level BPE encoding and decoding with the tiktoken library and a local rank file.

A long text is cut at safe boundaries first: in front of a blank that follows a character other than white space and comes
before one. No match of the pattern crosses such a place, so the ids of the pieces are the ids of the text. Decoding goes to raw
bytes, so ids that end within a character stay whole.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Callable, Iterator
from functools import cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from .common import pick, table

RANKS = "byte_bpe_multi_50k.tiktoken"
#: Code points of a piece, about.
PIECE = 1 << 16
_SAFE = regex.compile(r"(?<=[^\s\x1c-\x1f]) (?=[^\s\x1c-\x1f])")


def vocabulary_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@cache
def encoding(path: str):
    """The encoding of a rank file; one for each Python worker."""
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def safe_pieces(text: str, piece: int = PIECE) -> Iterator[str]:
    """Runs of about ``piece`` code points that end at safe boundaries; a stretch without one stays whole."""
    at = 0
    while len(text) - at > piece:
        cut = _SAFE.search(text, at + piece)
        if cut is None:
            break
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:]


def encode(text: str, path: str, piece: int = PIECE) -> list[int]:
    enc = encoding(path)
    if len(text) <= piece:
        return enc.encode_ordinary(text)
    return [i for part in safe_pieces(text, piece) for i in enc.encode_ordinary(part)]


def decode(ids: list[int], path: str) -> bytes:
    return encoding(path).decode_bytes(ids)


def _mapped(df: DataFrame, schema: str, text: str, row: Callable[[str], tuple], keep: list[str]) -> DataFrame:
    full = df.select(*keep).schema
    names = [x.split()[0] for x in schema.split(", ")]
    for name, kind in (x.split() for x in schema.split(", ")):
        full = full.add(name, StructType.fromDDL(f"x {kind}")[0].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        types = to_arrow_schema(full)
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                made = list(zip(*map(row, (x or "" for x in part.column(text).to_pylist())), strict=True))
                yield pa.RecordBatch.from_arrays([part.column(k) for k in keep] + [pa.array(v, types.field(n).type) for n, v in zip(names, made, strict=True)], names=[*keep, *names])

    return df.select(*dict.fromkeys([*keep, text])).mapInArrow(run, full)


def add_ids(df: DataFrame, text: str = "text", ranks: str = RANKS, keep: list[str] | None = None) -> DataFrame:
    """Kept columns (all by default) and the ids of every whole text; a null text has no ids. No shuffle."""
    path = vocabulary_path(ranks)
    return _mapped(df, "ids array<int>", text, lambda x: (encode(x, path),), [c for c in keep or df.columns if c != "ids"])


def add_round_trip(df: DataFrame, text: str = "text", ranks: str = RANKS, keep: list[str] | None = None) -> DataFrame:
    """Kept columns (all by default), the number of ids, and SHA-256 of the ids as text and of the bytes they decode to."""
    path = vocabulary_path(ranks)
    new = ("n_tokens", "ids_sha256", "decoded_sha256")

    def row(x: str) -> tuple:
        ids = encode(x, path)
        return len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(decode(ids, path)).hexdigest()

    return _mapped(df, "n_tokens long, ids_sha256 string, decoded_sha256 string", text, row, [c for c in keep or df.columns if c not in new])


def add_checked_ids(df: DataFrame, text: str = "text", ranks: str = RANKS, keep: list[str] | None = None) -> DataFrame:
    """Kept columns (all by default), the number of ids, the ids, and whether they decode to the very bytes of the text."""
    path = vocabulary_path(ranks)
    new = ("n_tokens", "ids", "decodes")

    def row(x: str) -> tuple:
        ids = encode(x, path)
        return len(ids), ids, decode(ids, path) == x.encode()

    return _mapped(df, "n_tokens long, ids array<int>, decodes boolean", text, row, [c for c in keep or df.columns if c not in new])


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return add_round_trip(pick(table(spark, sf_dir, "documents"), "doc_id", "text"), keep=["doc_id"])
