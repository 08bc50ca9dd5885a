"""Byte-level BPE: encoding and decoding whole texts.

Slices come from array operations (pretokenize). Distinct slices of a run of texts are
looked up in a cache; those not in it are merged together, one merge for each slice in
each round, by arrays of pair ranks. The byte where each token begins comes with the ids
and is kept; decoding puts the bytes of all tokens at their offsets at once, and any span
of bytes can be decoded by the tokens that lie in it (decode_span).
"""

from __future__ import annotations

import base64
import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame

from loamwork.llm.pretokenize import slice_starts
from loamwork.llm.texts import IdCache, chunks, hold, lists, ragged, runs, settle

NONE = np.iinfo(np.int32).max
#: Slices up to these many bytes are merged in arrays, longer ones by a heap.
WIDTHS = (4, 8, 12, 16, 24, 48)
#: Bytes of text that are held at once, with their ids and offsets.
_CHUNK = 1 << 20


class Tokens:
    """The tokens' bytes of a rank file, which has base64 bytes and their rank, the token id, on each line."""

    def __init__(self, content: bytes):
        self._read({base64.b64decode(a): int(b) for a, b in map(bytes.split, content.splitlines())})

    def _read(self, ranks: dict[bytes, int]) -> None:
        n = 1 + max(ranks.values())
        tokens = [b""] * n
        for token, rank in ranks.items():
            tokens[rank] = token
        self.blob = np.frombuffer(b"".join(tokens), np.uint8)
        self.length = np.fromiter(map(len, tokens), np.int64, n)
        self.start = np.cumsum(self.length) - self.length

    def decode(self, ids: np.ndarray, begin: np.ndarray, size: int) -> np.ndarray:
        """``size`` bytes with each token's bytes where it begins; bytes that no token covers are zero."""
        length = self.length[ids]
        out = np.zeros(size, np.uint8)
        within = np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length)
        out[np.repeat(begin, length) + within] = ragged(self.blob, self.start[ids], length)
        return out


class Vocabulary(Tokens):
    """A rank file with what merging needs."""

    def __init__(self, content: bytes):
        super().__init__(content)
        self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, content.splitlines())}
        self.byte = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        get, pairs = self.ranks.get, {}
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                a, b = get(token[:cut]), get(token[cut:])
                if a is not None and b is not None:
                    pairs[a << 32 | b] = rank
        self.pairs = pairs
        self.keys = np.array(sorted(pairs), np.int64)
        self.merged = np.array([pairs[k] for k in self.keys.tolist()], np.int32)
        self.cache = IdCache(self.encode_many)

    def pair_rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a.astype(np.int64) << 32 | b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[at] == key) & (a >= 0) & (b >= 0), self.merged[at], NONE)

    def encode_many(self, strings: list[bytes]) -> list:
        out: list = [None] * len(strings)
        by_width: dict[int, list[int]] = {}
        for n, s in enumerate(strings):
            rank = self.ranks.get(s)
            if rank is not None:
                out[n] = (rank,)
            elif len(s) > WIDTHS[-1]:
                out[n] = self.merge_long(s)
            else:
                by_width.setdefault(next(w for w in WIDTHS if w >= len(s)), []).append(n)
        for width, places in by_width.items():
            for at in range(0, len(places), 65536):
                part = places[at : at + 65536]
                for n, ids in zip(part, self.merge_together([strings[k] for k in part], width), strict=True):
                    out[n] = ids
        return out

    def merge_together(self, strings: list[bytes], width: int) -> list[list[int]]:
        """Merge slices of up to ``width`` bytes: in each round, of each, its leftmost pair of least rank."""
        n = len(strings)
        raw = np.frombuffer(b"".join(s.ljust(width, b"\0") for s in strings), np.uint8).reshape(n, width)
        size = np.fromiter(map(len, strings), np.int64, n)
        ids = np.where(np.arange(width) < size[:, None], self.byte[raw], -1)
        ranks = self.pair_rank(ids[:, :-1], ids[:, 1:])
        final = ids.copy()
        rows = np.arange(n)
        columns = np.arange(width)
        while len(rows):
            at = ranks.argmin(1)
            least = ranks[np.arange(len(rows)), at]
            ended = least == NONE
            if ended.any():
                final[rows[ended]] = ids[ended]
                rows, ids, ranks, at, least = rows[~ended], ids[~ended], ranks[~ended], at[~ended], least[~ended]
                if not len(rows):
                    break
            each = np.arange(len(rows))
            take = columns + (columns > at[:, None])
            ids = np.where(take < width, np.take_along_axis(ids, np.minimum(take, width - 1), 1), -1)
            ids[each, at] = least
            take = take[:, :-1]
            ranks = np.where(take < width - 1, np.take_along_axis(ranks, np.minimum(take, width - 2), 1), NONE)
            left, right = np.maximum(at - 1, 0), np.minimum(at + 1, width - 1)
            ranks[each, np.minimum(at, width - 2)] = np.where(at < width - 1, self.pair_rank(ids[each, at], ids[each, right]), NONE)
            ranks[each, left] = np.where(at > 0, self.pair_rank(ids[each, left], ids[each, at]), ranks[each, left])
        counts = (final >= 0).sum(1).tolist()
        return [row[:k] for row, k in zip(final.tolist(), counts, strict=True)]

    def merge_long(self, s: bytes) -> list[int]:
        """The same merges for one long slice, by a heap of (rank, place)."""
        ids = [int(self.byte[b]) for b in s]
        n = len(ids)
        after, before, get = [*range(1, n + 1)], [*range(-1, n - 1)], self.pairs.get
        heap = [(r, k, ids[k], ids[k + 1]) for k in range(n - 1) if (r := get(ids[k] << 32 | ids[k + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            rank, k, a, b = heapq.heappop(heap)
            if ids[k] != a or (j := after[k]) >= n or ids[j] != b:
                continue
            ids[k], ids[j] = rank, -1
            after[k] = after[j]
            if after[k] < n:
                before[after[k]] = k
                if (r := get(rank << 32 | ids[after[k]])) is not None:
                    heapq.heappush(heap, (r, k, rank, ids[after[k]]))
            if (p := before[k]) >= 0 and (r := get(ids[p] << 32 | rank)) is not None:
                heapq.heappush(heap, (r, p, ids[p], rank))
        return [x for x in ids if x >= 0]

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of UTF-8 texts end to end, and the offsets of each text's ids."""
        starts = slice_starts(data, offsets)
        return self.cache.encode(data, starts, np.searchsorted(starts, offsets[:-1]))


_loaded: dict[tuple[type, int], Tokens] = {}


def vocabulary(content: bytes, kind: type = Vocabulary) -> Tokens:
    """The vocabulary of a rank file, or its tokens alone, once in each worker process."""
    hold("vocabulary", _loaded.clear)
    key = kind, zlib.crc32(content)
    if key not in _loaded:
        _loaded[key] = kind(content)
    return _loaded[key]


def _encoded(batches: Iterator[pa.RecordBatch], v: Vocabulary) -> Iterator[pa.RecordBatch]:
    """doc_id, ids and offsets of the texts, in runs of about _CHUNK bytes of text."""
    for rows, data, at in chunks(batches, limit=_CHUNK):
        ids, ends = v.encode(data, at)
        length = v.length[ids]
        begin = np.cumsum(length) - length - np.repeat(at[:-1], np.diff(ends))
        yield pa.RecordBatch.from_pydict({"doc_id": rows.column("doc_id"), "ids": lists(ids, ends, pa.int32()), "offsets": lists(begin, ends, pa.int32())})


def _decoded(batches: Iterator[pa.RecordBatch], v: Tokens) -> Iterator[pa.RecordBatch]:
    """doc_id, ids, offsets and bytes from ids and offsets alone, in runs of about _CHUNK ids and bytes."""
    for batch in batches:
        columns = [c.fill_null([]) if c.null_count else c for c in (batch.column("ids"), batch.column("offsets"))]
        ids, begin = (c.flatten().to_numpy(zero_copy_only=False) for c in columns)
        n = columns[0].value_lengths().to_numpy(zero_copy_only=False)
        ends = np.append(0, np.cumsum(n, dtype=np.int64))
        size = np.zeros(len(n), np.int64)
        last = ends[1:][n > 0] - 1
        size[n > 0] = begin[last] + v.length[ids[last]]
        for a, b in runs(np.append(0, np.cumsum(np.maximum(size, n))), _CHUNK):
            cut = np.append(0, np.cumsum(size[a:b]))
            at = slice(ends[a], ends[b])
            raw = v.decode(ids[at], begin[at] + np.repeat(cut[:-1], n[a:b]), int(cut[-1]))
            texts = pa.LargeBinaryArray.from_buffers(pa.large_binary(), b - a, [None, pa.py_buffer(cut), pa.py_buffer(raw)])
            part = [c.slice(a, b - a) for c in (batch.column("doc_id"), *columns)]
            yield pa.RecordBatch.from_arrays([*part, texts.cast(pa.binary())], ["doc_id", "ids", "offsets", "bytes"])


def _content(df: DataFrame, ranks_path: str) -> Broadcast[bytes]:
    with open(ranks_path, "rb") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())


def encode(docs: DataFrame, ranks_path: str) -> DataFrame:
    """doc_id, ids and offsets (array<int>, the byte where each token begins) of every row of ``docs``.

    Nulls: a null text is empty and has no ids; a null doc_id is kept. Repeated rows
    are each encoded. An empty table gives an empty result. Extra columns are not read.
    The rank file is read on the driver and sent to the workers (a fixed size).
    """
    content = _content(docs, ranks_path)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _encoded(batches, vocabulary(content.value))
        settle()

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, ids array<int>, offsets array<int>")


def decode(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """doc_id, ids, offsets and bytes (binary) of every row, each token's bytes at its offset; null or no ids give no bytes.

    A text has as many bytes as its last token reaches. Repeated rows are each decoded; an
    empty table gives an empty result; extra columns are not read.
    """
    content = _content(encoded, ranks_path)
    kind = encoded.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _decoded(batches, vocabulary(content.value, Tokens))
        settle()

    return encoded.select("doc_id", "ids", "offsets").mapInArrow(run, f"doc_id {kind}, ids array<int>, offsets array<int>, bytes binary")


def encode_decode(docs: DataFrame, ranks_path: str) -> DataFrame:
    """decode(encode(docs)) in one Python stage: a run of texts is encoded, and its ids are decoded, before the next.

    The ids do not go back to a second worker in Arrow batches that count rows and not
    ids. Nulls, repeated rows and empty tables: as encode and decode have them.
    """
    content = _content(docs, ranks_path)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(content.value)
        yield from _decoded(_encoded(batches, v), v)
        settle()

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, ids array<int>, offsets array<int>, bytes binary")


def decode_span(ids: list[int], offsets: list[int], tokens: Tokens, first: int, last: int) -> bytes:
    """The bytes of a text from ``first`` up to ``last``, from the tokens that lie there alone."""
    begin = np.asarray(offsets, np.int64)
    a = max(0, int(np.searchsorted(begin, first, "right")) - 1)
    b = int(np.searchsorted(begin, last))
    if a >= b:
        return b""
    part = np.asarray(ids[a:b], np.int64)
    size = int(begin[b - 1] - begin[a] + tokens.length[part[-1]])
    raw = tokens.decode(part, begin[a:b] - begin[a], size).tobytes()
    return raw[max(0, first - int(begin[a])) : last - int(begin[a])]
