"""Arrow helpers for Python stages over whole texts.

Batches are cut into pieces of a bounded number of bytes, so a task's memory follows
CHUNK_BYTES and its longest single text, not the number of rows in a batch.
"""

from __future__ import annotations

import ctypes
import gc
import sys
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 4 << 20


_held: dict = {}


def hold(name: str, release) -> None:
    """Let one operator's caches live in a worker process: another's are released when this one's are used."""
    if _held and name not in _held:
        for f in _held.values():
            f()
        _held.clear()
    _held[name] = release


def settle() -> None:
    """Give freed memory back to the system, at the end of a task: an idle worker stays for a while beside the next stage."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
        if trim:
            trim(0)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts end to end, and where each begins and ends; null: empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    ends = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)[ends[0] : ends[-1]]
    return data, ends - ends[0]


def runs(ends: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """First row and end of runs of rows with up to ``limit`` in all, one row at least; ``ends``: 0 and the sums up to each row."""
    at = 0
    while at < len(ends) - 1:
        to = max(at + 1, int(np.searchsorted(ends, ends[at] + limit, "right")) - 1)
        yield at, to
        at = to


def chunks(batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(rows, bytes, offsets) of runs of rows with about ``limit`` bytes of text, one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        column = batch.column(text)
        data, ends = utf8(column)
        for at, to in runs(ends, limit):
            yield batch.slice(at, to - at), data[ends[at] : ends[to]], ends[at : to + 1] - ends[at]
        pa.default_memory_pool().release_unused()


def ragged(flat: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """flat[start[0]:start[0]+length[0]], flat[start[1]:...], ... end to end."""
    ends = np.cumsum(length)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.repeat(start - (ends - length), length) + np.arange(total)]


def lists(values: np.ndarray, ends: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    """A list column from values end to end and offsets."""
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(values, kind))


def slices(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """Numbers of the byte strings between ``starts`` (and to the end), and the distinct strings."""
    offsets = np.append(starts, len(data)).astype(np.int32)
    array = pa.BinaryArray.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])
    coded = array.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False), coded.dictionary.to_pylist()


class IdCache:
    """Token ids of byte strings, looked up in bulk.

    What is new in a call is encoded together by ``encode_many`` (a list of byte
    strings to a list of id sequences). When more than ``limit`` strings are held, they
    become the older generation, and the one before is dropped; strings found in the
    older one move on to the newer. This bounds memory and changes no result.
    """

    def __init__(self, encode_many, limit: int = 250_000):
        self.encode_many, self.limit = encode_many, limit
        self._begin()
        self.older: tuple | None = None

    def _begin(self) -> None:
        self.place: dict[bytes, int] = {}
        self.flat, self.used = np.zeros(1 << 16, np.int32), 0
        self.start, self.length, self.n = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64), 0

    def _add(self, strings: list[bytes], sizes: np.ndarray, ids: np.ndarray) -> None:
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while self.n + len(strings) > len(self.start):
            self.start = np.concatenate([self.start, np.zeros_like(self.start)])
            self.length = np.concatenate([self.length, np.zeros_like(self.length)])
        self.flat[self.used : self.used + len(ids)] = ids
        self.start[self.n : self.n + len(strings)] = self.used + np.cumsum(sizes) - sizes
        self.length[self.n : self.n + len(strings)] = sizes
        self.place.update(zip(strings, range(self.n, self.n + len(strings)), strict=True))
        self.used += len(ids)
        self.n += len(strings)

    def find(self, strings: list[bytes]) -> np.ndarray:
        """Places of the strings, which are distinct, in start and length."""
        if self.n > self.limit:
            self.older = self.place, self.flat, self.start, self.length
            self._begin()
        at = np.fromiter(map(self.place.get, strings, repeat(-1)), np.int64, len(strings))
        new = np.flatnonzero(at < 0)
        if len(new) and self.older:
            place, flat, start, length = self.older
            old = np.fromiter((place.get(strings[k], -1) for k in new.tolist()), np.int64, len(new))
            known, old, new = new[old >= 0], old[old >= 0], new[old < 0]
            at[known] = self.n + np.arange(len(known))
            self._add([strings[k] for k in known.tolist()], length[old], ragged(flat, start[old], length[old]))
        if len(new):
            missing = [strings[k] for k in new.tolist()]
            ids = self.encode_many(missing)
            sizes = np.fromiter(map(len, ids), np.int64, len(ids))
            at[new] = self.n + np.arange(len(new))
            self._add(missing, sizes, np.fromiter(chain.from_iterable(ids), np.int32, int(sizes.sum())))
        return at

    def encode(self, data: np.ndarray, starts: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all slices of ``data`` end to end, and offsets of the runs of slices that begin at ``firsts``."""
        if not len(starts):
            return np.zeros(0, np.int32), np.zeros(len(firsts) + 1, np.int64)
        code, strings = slices(data, starts)
        at = self.find(strings)[code]
        length = self.length[at]
        ids = ragged(self.flat, self.start[at], length)
        ends = np.append(0, np.cumsum(length))
        return ids, ends[np.append(firsts, len(starts))]


#: Lower case for A-Z, other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def byte_class(ranges: list[tuple[int, int]]) -> np.ndarray:
    """A table of 256 flags, true in the ranges (both ends included)."""
    out = np.zeros(256, bool)
    for a, b in ranges:
        out[a : b + 1] = True
    return out


#: Everything but ASCII white space; letters, digits and all non-ASCII bytes.
NOT_SPACE = ~byte_class([(9, 13), (32, 32)])
ALNUM = byte_class([(0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF)])


def words_of(data: np.ndarray, offsets: np.ndarray, kept: np.ndarray) -> tuple[pa.BinaryArray, np.ndarray]:
    """Runs of ``kept`` bytes in texts end to end, and the offsets of each text's words among them."""
    inside = kept[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    firsts = offsets[:-1][offsets[:-1] < offsets[1:]]
    begins[firsts] = inside[firsts]
    at = np.flatnonzero(begins)
    packed = np.append(0, np.cumsum(inside, dtype=np.int64)).astype(np.int32)
    cut = np.append(packed[at], packed[-1])
    words = pa.BinaryArray.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(cut), pa.py_buffer(data[inside])])
    return words, np.searchsorted(at, offsets)


def per_text(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums of the values of each text."""
    total = np.append(0, np.cumsum(values))
    return total[ends[1:]] - total[ends[:-1]]
