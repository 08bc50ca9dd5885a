"""Near duplicates by SimHash, searched with vantage-point trees.

A fingerprint has a bit for each bit that is set in more than half of the text's
shingle hashes; longer fingerprints mix each hash again for every further 64 bits.
Texts link when fingerprints differ in at most ``radius`` bits.

Search: a Bands plan cuts fingerprints into bands and gives the reach, the bits in
which a band may differ. Each band has a tree over its own Hamming distance with that
small radius, where triangle bounds prune; over all bits at once they would hardly.
EXACT: of two fingerprints within 3 bits, one half differs in at most 1, so no pair is
missed. SIMILAR: 12 bands of 16 bits with reach 1 find a pair whose bits differ with
probability 0.15 (Jaccard similarity 0.8) with probability 0.98, closer ones more surely.

A tree's upper levels deal distinct fingerprints to shards: level by level, by whether
their distance to a vantage point is over the median. One whose distance lies within
the reach of a median may have partners across that boundary, so it also visits those
shards with lower numbers as a query. Inside a shard, a local vantage-point tree goes
on in the same way down to small leaves, where pairs are compared.

What leaves a shard is not its pairs but a spanning forest of them, less than one link
for each fingerprint seen; components over all shards' links are the same. The tree's
depth follows the number of distinct fingerprints; vantage points and medians come from
a bounded sample and decide only how evenly work is dealt, not what is found.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loamwork.llm.texts import chunks, settle
from loamwork.operators.components import components
from loamwork.operators.salted import lookup
from loamwork.session import materialise

RADIUS = 3
HASH_SEED = 42
#: Distinct fingerprints for each shard that the depth aims at, and the sample for medians.
SHARD_ROWS, SAMPLE = 16_384, 20_000
_LEAF = 256
#: Bytes of text that are held at once.
_CHUNK = 1 << 20


@dataclass(frozen=True)
class Bands:
    """Bands of ``width`` bits, ``per_word`` in each of the first ``words`` 64-bit words."""

    words: int
    per_word: int
    width: int
    reach: int

    def __len__(self) -> int:
        return self.words * self.per_word

    def of(self, fp: np.ndarray, band: int) -> np.ndarray:
        word, place = divmod(band, self.per_word)
        return ((fp[:, word] >> np.uint64(place * self.width)) & np.uint64((1 << self.width) - 1)).astype(np.uint32)


EXACT = Bands(words=1, per_word=2, width=32, reach=1)
SIMILAR = Bands(words=3, per_word=4, width=16, reach=1)
#: Words of fingerprints that estimate similarity.
LONG = 8


def radius_of(similarity: float, words: int) -> int:
    """Bits that differ at a Jaccard similarity of sets of equal size, as expected of SimHash."""
    return int(np.arccos(2 * similarity / (1 + similarity)) / np.pi * 64 * words)


def _mixed(hashes: np.ndarray, word: int) -> np.ndarray:
    """The hashes themselves for word 0, else hashes of them (splitmix64)."""
    if not word:
        return hashes
    x = hashes + np.uint64(word * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_hashes(text: bytes, width: int) -> np.ndarray:
    """A hash of each shingle of lower-cased words, in order; none for a text without words."""
    words = text.lower().split()  # bytes: A-Z only, and ASCII white space
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) < width:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[k:] for k in range(width)), strict=False))
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(s, HASH_SEED) for s in shingles), np.uint64, max(1, len(words) - width + 1))


def fingerprint_of(hashes: np.ndarray, n_words: int = 1) -> bytes:
    """SimHash of shingle hashes, big-endian; none give zeros."""
    if not len(hashes):
        return bytes(8 * n_words)
    out = b""
    for word in range(n_words):
        ones = np.zeros(64, np.int64)
        for at in range(0, len(hashes), 255):
            part = _mixed(hashes[at : at + 255], word).byteswap().view(np.uint8).reshape(-1, 8)
            ones += np.unpackbits(part, axis=1).sum(0, dtype=np.uint8)
        out += np.packbits(ones * 2 > len(hashes)).tobytes()
    return out


def fingerprint(text: bytes, width: int, n_words: int = 1, repeats: bool = True) -> bytes:
    """SimHash of lower-cased words' shingles; no words give zeros. With ``repeats`` a shingle counts each time."""
    hashes = shingle_hashes(text, width)
    return fingerprint_of(hashes if repeats else np.unique(hashes), n_words)


def fingerprints(docs: DataFrame, width: int, n_words: int = 1, repeats: bool = True) -> DataFrame:
    """doc_id and fp (binary) of every row; a null text is empty."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, at in chunks(batches, limit=_CHUNK):
            raw = data.tobytes()
            fp = [fingerprint(raw[a:b], width, n_words, repeats) for a, b in zip(at, at[1:], strict=False)]
            yield pa.RecordBatch.from_pydict({"doc_id": rows.column("doc_id"), "fp": pa.array(fp, pa.binary())})
        settle()

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, fp binary")


def _numbers(fp: list[bytes]) -> np.ndarray:
    """Fingerprints as rows of 64-bit words."""
    return np.frombuffer(b"".join(fp), ">u8").reshape(len(fp), -1).astype(np.uint64)


class Forest:
    """The upper levels of all bands' trees: vantage points and medians of each level."""

    def __init__(self, sample: np.ndarray, depth: int, bands: Bands, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.depth, self.bands = depth, bands
        self.points = rng.integers(0, 1 << bands.width, (len(bands), depth), dtype=np.uint32)
        self.medians = np.full((len(bands), depth), bands.width // 2)
        for band, level in product(range(len(bands) if len(sample) else 0), range(depth)):
            self.medians[band, level] = int(np.median(np.bitwise_count(bands.of(sample, band) ^ self.points[band, level])))

    def shards(self, fp: np.ndarray, band: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, shard, home) of fingerprints: their own shard, and lower ones that they may have partners in."""
        value, reach = self.bands.of(fp, band), self.bands.reach
        row, shard = np.arange(len(fp)), np.zeros(len(fp), np.int64)
        own = np.zeros(len(fp), np.int64)
        for level in range(self.depth):
            distance = np.bitwise_count(value ^ self.points[band, level]).astype(np.int64)
            median = self.medians[band, level]
            over = (distance > median).astype(np.int64)
            own |= over << level
            at = distance[row]
            # partners' distances differ by reach at most, and may lie across the boundary
            other = np.where(over[row] == 1, at - reach <= median, at + reach > median)
            row, shard = np.concatenate([row, row[other]]), np.concatenate([shard | over[row] << level, shard[other] | (1 - over[row[other]]) << level])
        home = shard == own[row]
        keep = shard <= own[row]
        return row[keep], shard[keep], home[keep]


class _Union:
    def __init__(self, n: int):
        self.parent = np.arange(n)

    def root(self, k: int) -> int:
        p = self.parent
        while p[k] != k:
            p[k] = p[p[k]]
            k = p[k]
        return int(k)

    def join(self, a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
        """Merge pairs; returns those that joined two groups."""
        root = self.parent
        while (root != root[root]).any():
            root = root[root]
        apart = root[a] != root[b]
        a, b = a[apart], b[apart]
        _, first = np.unique(np.stack([root[a], root[b]], 1), axis=0, return_index=True)
        new = []
        for x, y in zip(a[first].tolist(), b[first].tolist(), strict=True):
            p, q = self.root(x), self.root(y)
            if p != q:
                self.parent[max(p, q)] = min(p, q)
                new.append((x, y))
        return new


def shard_links(fp: np.ndarray, home: np.ndarray, band: int, bands: Bands, radius: int) -> np.ndarray:
    """A spanning forest of the pairs within ``radius`` in one shard: pairs of row numbers.

    Pairs have at least one member that is at home in the shard, and differ by the
    reach at most in the band. The local tree splits homes by their distance to a
    vantage point (one of them) at the median, and sends every query to the sides that
    its own distance, give or take the reach, allows.
    """
    value, reach = bands.of(fp, band), bands.reach
    union, links = _Union(len(fp)), []
    todo = [(np.flatnonzero(home), np.arange(len(fp)))]
    while todo:
        inner, query = todo.pop()
        if not len(inner) or not len(query):
            continue
        if len(inner) > _LEAF:
            point = value[inner[len(inner) // 2]]
            distance = np.bitwise_count(value[inner] ^ point).astype(np.int64)
            limit = int(np.median(distance))
            if distance.max() == limit:  # many at the median: split below it
                limit -= 1
            near = distance <= limit
            if near.any() and not near.all():
                asked = np.bitwise_count(value[query] ^ point).astype(np.int64)
                todo.append((inner[near], query[asked - reach <= limit]))
                todo.append((inner[~near], query[asked + reach > limit]))
                continue
        block = max(1, (1 << 20) // len(query))
        for at in range(0, len(inner), block):
            part = inner[at : at + block]
            a, b = np.nonzero(np.bitwise_count(value[part, None] ^ value[query]) <= reach)
            a, b = part[a], query[b]
            close = (a != b) & (np.bitwise_count(fp[a] ^ fp[b]).sum(1, dtype=np.int64) <= radius)
            links += union.join(a[close], b[close])
    return np.array(links, np.int64).reshape(-1, 2)


def near_links(distinct: DataFrame, radius: int, bands: Bands, shard_rows: int = SHARD_ROWS, sample: int = SAMPLE) -> DataFrame:
    """(a, b): links that connect what pairs of distinct fingerprints (fp) within ``radius`` bits connect."""
    n = distinct.count()
    depth = max(0, int(np.ceil(np.log2(max(1, n) / shard_rows))))
    some = distinct.select("fp").sample(min(1.0, sample / n), seed=3).limit(2 * sample).toArrow()["fp"].to_pylist() if depth else []
    forest = Forest(_numbers(some) if some else np.zeros((0, 1), np.uint64), depth, bands)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            fp = _numbers(batch.column("fp").to_pylist())
            for band in range(len(bands)):
                row, shard, home = forest.shards(fp, band)
                yield pa.RecordBatch.from_pydict({"band": pa.array(np.full(len(row), band, np.int32)), "shard": pa.array(shard), "home": pa.array(home), "fp": batch.column("fp").take(pa.array(row))})
        settle()

    def search(key, rows):
        rows = rows.sort_by("fp")
        pairs = shard_links(_numbers(rows["fp"].to_pylist()), rows["home"].to_numpy(), key[0].as_py(), bands, radius)
        return pa.table({"a": rows["fp"].take(pa.array(pairs[:, 0])), "b": rows["fp"].take(pa.array(pairs[:, 1]))})

    dealt = distinct.select("fp").mapInArrow(deal, "band int, shard long, home boolean, fp binary")
    return dealt.groupBy("band", "shard").applyInArrow(search, "a binary, b binary")


def simhash_components(docs: DataFrame, width: int = 3, radius: int = RADIUS, n_words: int = 1, bands: Bands = EXACT, repeats: bool = True) -> DataFrame:
    """One row per row of ``docs``: doc_id, fp, component_id, the least doc_id reachable by links.

    With the defaults no link within 3 bits is missed. For a similarity of shingle
    sets, take n_words=LONG, bands=SIMILAR, repeats=False and radius_of(similarity, LONG).

    Nulls: a null text is empty (fingerprint zero, linked like any other); null doc_ids
    are not counted among the least. Repeated rows and equal fingerprints are linked.
    An empty table gives an empty result. Extra columns are not read.
    """
    prints = materialise(fingerprints(docs, width, n_words, repeats), "fingerprints")
    least = materialise(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
    groups = components(near_links(least, radius, bands))
    named = least.join(groups, least["fp"] == groups["node"], "left").select("fp", "least", F.coalesce("component", "fp").alias("component"))
    ids = lookup(named, ["component"], ["fp"], named.groupBy("component").agg(F.min("least").alias("component_id"))).select("fp", "component_id")
    return lookup(prints, ["fp"], ["doc_id"], ids).select("doc_id", "fp", "component_id")
