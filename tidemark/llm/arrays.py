"""Numpy helpers over Arrow string columns: chunks of texts, word spans and word hashes.

Texts stay UTF-8 bytes in one flat buffer, so that the per-word work of a task is a handful of numpy passes. A word is a
run of bytes other than 0x20 and 0x09-0x0D, as in ``[^\\x20\\x09-\\x0D]+``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

CHUNK_BYTES = 1 << 19
#: White space.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Spans of more bytes are hashed by XXH64, one by one.
_LONG = 256
_LOW_BYTES = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [(1 << 64) - 1], np.uint64)


def chunks(col: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cuts a string column into runs of rows of about ``limit`` bytes: first row, end row, bytes, row offsets in them.

    A null is an empty text. A row is never cut; one longer than the limit is a chunk of its own.
    """
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if not pa.types.is_large_binary(col.type):
        col = col.cast(pa.large_string()).fill_null("")
    if not len(col):
        return
    offsets = np.frombuffer(col.buffers()[1], np.int64)[col.offset : col.offset + len(col) + 1]
    data = np.frombuffer(col.buffers()[2], np.uint8) if col.buffers()[2] is not None and col.buffers()[2].size else np.zeros(0, np.uint8)
    first = 0
    while first < len(col):
        end = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        yield first, end, data[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first]
        first = end
    # Workers live on between tasks; what batches before held goes back now.
    pa.default_memory_pool().release_unused()


def pieces(col: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, bool]]:
    """As chunks(), but a row longer than the limit comes in several pieces; the last value says whether the row goes on.

    A piece ends where a word begins behind white space, so that no word is cut; a longer stretch without such a place stays whole.
    """
    for first, end, buf, offsets in chunks(col, limit):
        at = 0
        while len(buf) - at > 2 * limit:
            cut, look = 0, at + limit
            while not cut and look < len(buf):
                space = SPACE[buf[look - 1 : look + limit]]
                found = np.flatnonzero(space[:-1] & ~space[1:])
                cut, look = look + int(found[0]) if len(found) else 0, look + limit
            if not cut:
                break
            yield first, end, buf[at:cut], np.array([0, cut - at]), True
            at = cut
        yield first, end, buf[at:], np.array([0, len(buf) - at]) if at else offsets, False


def spans(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and for each text (and the end) the index of its first word."""
    if not len(buf):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    word = ~SPACE[buf]
    edge = np.zeros(len(buf) + 1, bool)
    edge[offsets] = True
    before, after = edge[:-1].copy(), edge[1:].copy()
    before[1:] |= ~word[:-1]
    after[:-1] |= ~word[1:]
    starts, ends = np.flatnonzero(word & before), np.flatnonzero(word & after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit values."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of the bytes of each span, 8 bytes at a time: each block is added to what the blocks before gave, and mixed.

    Seeds give independent hashes. Mixing is no polynomial, so that no family of strings is known to collide.
    """
    if not len(starts):
        return np.zeros(0, np.uint64)
    length = ends - starts
    out = mix(length.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64((seed * 0xC2B2AE3D27D4EB4F + 0x165667B19E3779F9) & ((1 << 64) - 1)))
    padded = np.concatenate((buf, np.zeros(8, np.uint8)))
    block = np.ndarray(len(buf) + 1, "<u8", padded, strides=(1,))
    live = np.flatnonzero((length <= _LONG) & (length > 0))
    at, left, h = starts[live], length[live], out[live]
    while len(live):
        h = mix(h ^ (block[at] & _LOW_BYTES[np.minimum(left, 8)]))
        out[live] = h
        more = left > 8
        live, at, left, h = live[more], at[more] + 8, left[more] - 8, h[more]
    for i in np.flatnonzero(length > _LONG).tolist():
        out[i] = xxhash.xxh64_intdigest(memoryview(padded)[starts[i] : ends[i]], seed)
    return out


def runs(sorted_keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First index and length of each run of equal values."""
    if not len(sorted_keys):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = np.flatnonzero(np.concatenate(([True], sorted_keys[1:] != sorted_keys[:-1])))
    return first, np.diff(np.append(first, len(sorted_keys)))
