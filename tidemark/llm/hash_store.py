"""Sorted hash arrays in the shared folder, memory-mapped by workers.

A store is a folder with a file for each shard of the keys: the keys, ascending, and behind them one array for each field. A task writes a file
under another name and renames it, so a lost or repeated task leaves whole files only. Who writes a store keeps which shards it has, or writes
them all; a file that should be there and isn't is an error.
"""

from __future__ import annotations

import tempfile
import uuid
from functools import lru_cache

import numpy as np
from pyarrow import fs

#: A field of this kind holds whole numbers of any size: a byte each, with those of 255 and more behind them.
SMALL = "small"


def _padded(values: np.ndarray) -> bytes:
    raw = np.ascontiguousarray(values).tobytes()
    return raw + bytes(-len(raw) % 8)


def write(folder: str, name: str, keys: np.ndarray, fields: list[tuple[str, np.ndarray]]) -> None:
    """Writes ascending keys and their fields, (kind, values) each."""
    files, path = fs.FileSystem.from_uri(folder)
    files.create_dir(path, recursive=True)
    part = f"{path}/.{name}-{uuid.uuid4().hex}"
    with files.open_output_stream(part) as out:
        out.write(_padded(np.array([len(keys)], "<u8")) + _padded(keys.astype("<u8")))
        for kind, values in fields:
            if kind == SMALL:
                large = np.flatnonzero(values >= 255)
                out.write(_padded(np.array([len(large)], "<u8")) + _padded(large.astype("<u8")) + _padded(values[large].astype("<u8")))
                out.write(_padded(np.minimum(values, 255).astype(np.uint8)))
            else:
                out.write(_padded(values.astype(kind)))
    files.move(part, f"{path}/{name}")


#: So many files stay mapped in a worker; the oldest go first.
@lru_cache(maxsize=8192)
def mapped(folder: str, name: str, kinds: tuple[str, ...]) -> tuple[np.ndarray, list]:
    """Keys and fields, mapped. From a store that is no local path the file is first copied to an unnamed one, which goes with the process."""
    files, path = fs.FileSystem.from_uri(folder)
    if isinstance(files, fs.LocalFileSystem):
        raw = np.memmap(f"{path}/{name}", np.uint8, "r")
    else:
        held = tempfile.TemporaryFile()  # noqa: SIM115
        with files.open_input_stream(f"{path}/{name}") as source:
            while block := source.read(1 << 22):
                held.write(block)
        held.flush()
        raw = np.memmap(held, np.uint8, "r")
    at = 0

    def take(kind: str, n: int) -> np.ndarray:
        nonlocal at
        size = np.dtype(kind).itemsize * n
        found = raw[at : at + size].view(kind)
        at += size + -size % 8
        return found

    n = int(take("<u8", 1)[0])
    keys, out = take("<u8", n), []
    for kind in kinds:
        if kind == SMALL:
            large = int(take("<u8", 1)[0])
            where, values = take("<u8", large), take("<u8", large)
            out.append((take("u1", n), where, values))
        else:
            out.append(take(kind, n))
    return keys, out


def _at(field: np.ndarray | tuple, at: np.ndarray) -> np.ndarray:
    if not isinstance(field, tuple):
        return field[at]
    small, where, values = field
    out = small[at].astype(np.int64)
    large = np.flatnonzero(out == 255)
    out[large] = values[np.searchsorted(where, at[large])]
    return out


def top(keys: np.ndarray, bits: int) -> np.ndarray:
    """The top bits of the keys as numbers."""
    return (keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)


def find(folder: str, prefix: str, present: np.ndarray | None, kinds: tuple[str, ...], keys: np.ndarray, shards: np.ndarray) -> list[np.ndarray]:
    """The fields of each key, 0 where it is absent; any order of keys. present tells which shards there are; None: all of them."""
    order = np.lexsort((keys, shards))
    keys, shards = keys[order], shards[order]
    out = [np.zeros(len(keys), np.int64 if kind == SMALL else kind) for kind in kinds]
    edges = np.append(np.flatnonzero(np.concatenate(([True], shards[1:] != shards[:-1]))), len(shards)) if len(shards) else np.zeros(1, np.int64)
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        if present is not None and not present[shards[a]]:
            continue
        there, fields = mapped(folder, f"{prefix}{shards[a]}", kinds)
        if not len(there):
            continue
        at = np.minimum(np.searchsorted(there, keys[a:b]), len(there) - 1)
        here = there[at] == keys[a:b]
        for values, field in zip(out, fields, strict=True):
            values[a:b] = np.where(here, _at(field, at), 0)
    back = np.empty(len(order), np.int64)
    back[order] = np.arange(len(order))
    return [x[back] for x in out]


def shards_present(found: list[int], bits: int) -> np.ndarray:
    present = np.zeros(1 << bits, bool)
    present[found] = True
    return present
