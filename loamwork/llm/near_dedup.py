"""Near duplicates by the Jaccard similarity of shingle sets, found with SimHash and verified exactly.

Fingerprints only propose pairs: a pair is a candidate when its long fingerprints differ
in at most ``radius_of(similarity - SLACK)`` bits and one of the bands of CANDIDATES is
within its reach, and when the sets' sizes allow the similarity. At similarity 0.8 a band
finds a pair with probability 0.28, so 24 bands miss about 3 in 10,000. Every link that
counts has been verified on the two sets of 64-bit shingle hashes.

Texts with the same set are one node. First a spanning forest of the candidates is
verified, close pairs first; its true links join most groups with less than one
comparison for each node. Then all candidates whose members are still in different groups
are verified, so a refuted link of the forest hides no other. Those are many where texts
share a long passage and are not similar enough; so they are verified in the shards that
find them, and no shard gives more links than it has nodes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loamwork.llm.keeping import text_key
from loamwork.llm.simhash import LONG, SAMPLE, SHARD_ROWS, Bands, Forest, _CHUNK, _LEAF, _Union, fingerprint_of, radius_of, shingle_hashes
from loamwork.llm.texts import chunks, settle
from loamwork.operators.components import components
from loamwork.operators.salted import lookup
from loamwork.session import materialise

CANDIDATES = Bands(words=6, per_word=4, width=16, reach=1)
#: How far below the similarity a pair's expected distance may lie and still be compared.
SLACK = 0.12
#: Bytes of a node besides the fingerprint: a hash of the set, and its size.
_EXTRA = 16


def _node(hashes: np.ndarray, n_words: int) -> bytes:
    return fingerprint_of(hashes, n_words) + xxhash.xxh64_digest(hashes.tobytes()) + len(hashes).to_bytes(8, "big")


def nodes(docs: DataFrame, width: int, n_words: int) -> DataFrame:
    """doc_id, text_key and node (fingerprint, hash and size of the shingle set) of every row."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, at in chunks(batches, limit=_CHUNK):
            raw = data.tobytes()
            made = [_node(np.unique(shingle_hashes(raw[a:b], width)), n_words) for a, b in zip(at, at[1:], strict=False)]
            yield pa.RecordBatch.from_pydict({"doc_id": rows.column("doc_id"), "text_key": rows.column("text_key"), "node": pa.array(made, pa.binary())})
        settle()

    return _hashed(docs).mapInArrow(run, f"doc_id {kind}, text_key string, node binary")


def _hashed(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "text", text_key(F.col("text")).alias("text_key"))


def shingle_sets(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """(node, shingles): the sorted distinct shingle hashes of each node of ``wanted`` (node, doc_id, text_key)."""
    wanted = wanted.select("node", F.col("doc_id").alias("__id"), F.col("text_key").alias("__key"))
    texts = _hashed(docs).join(wanted, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("text_key") == F.col("__key"))).select("node", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, at in chunks(batches, limit=_CHUNK):
            raw = data.tobytes()
            sets = [np.unique(shingle_hashes(raw[a:b], width)).tobytes() for a, b in zip(at, at[1:], strict=False)]
            yield pa.RecordBatch.from_pydict({"node": rows.column("node"), "shingles": pa.array(sets, pa.binary())})
        settle()

    return texts.mapInArrow(run, "node binary, shingles binary").dropDuplicates(["node"])


def _split(made: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints as rows of words, and sizes of the sets."""
    table = np.frombuffer(b"".join(made), ">u8").reshape(len(made), -1).astype(np.uint64)
    return np.ascontiguousarray(table[:, :-2]), table[:, -1].astype(np.int64)


def shard_pairs(fp: np.ndarray, size: np.ndarray, home: np.ndarray, group: np.ndarray | None, band: int, bands: Bands, radius: int, similarity: float) -> Iterator[np.ndarray]:
    """Candidate pairs of one shard, as rows of two row numbers.

    A pair belongs to the first band that has it, so no other band gives it again. Without
    ``group``, a spanning forest of the band's pairs, in which close pairs come first in
    each block; with it, all pairs of different groups. The local tree is that of
    simhash.shard_links.
    """
    value, reach = bands.of(fp, band), bands.reach
    earlier = [bands.of(fp, k) for k in range(band)]
    union = _Union(len(fp))
    todo = [(np.flatnonzero(home), np.arange(len(fp)))]
    while todo:
        inner, query = todo.pop()
        if not len(inner) or not len(query):
            continue
        if len(inner) > _LEAF:
            point = value[inner[len(inner) // 2]]
            distance = np.bitwise_count(value[inner] ^ point).astype(np.int64)
            limit = int(np.median(distance))
            if distance.max() == limit:
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
            ok = (a < b) | ((a > b) & ~home[b])
            ok &= np.minimum(size[a], size[b]) >= similarity * np.maximum(size[a], size[b]) - 1e-9
            if group is not None:
                ok &= group[a] != group[b]
            a, b = a[ok], b[ok]
            for other in earlier:  # most pairs leave with the first of them
                if not len(a):
                    break
                ok = np.bitwise_count(other[a] ^ other[b]) > reach
                a, b = a[ok], b[ok]
            distance = np.bitwise_count(fp[a] ^ fp[b]).sum(1, dtype=np.int64)
            ok = distance <= radius
            a, b, distance = a[ok], b[ok], distance[ok]
            if group is not None:
                yield np.stack([a, b], 1)
                continue
            for low in range(0, radius + 1, 16):
                near = (distance >= low) & (distance < low + 16)
                yield np.array(union.join(a[near], b[near]), np.int64).reshape(-1, 2)


def _dealt(made: DataFrame, bands: Bands, shard_rows: int, sample: int) -> DataFrame:
    """(band, shard, home, node, grp): distinct nodes in the shards of every band's tree where they are or may have partners."""
    n = made.count()
    depth = max(0, int(np.ceil(np.log2(max(1, n) / shard_rows))))
    some = made.select("node").sample(min(1.0, sample / n), seed=3).limit(2 * sample).toArrow()["node"].to_pylist() if depth else []
    forest = Forest(_split(some)[0] if some else np.zeros((0, 1), np.uint64), depth, bands)
    rows = made.select("node", (F.xxhash64("component") if "component" in made.columns else F.lit(0).cast("long")).alias("grp"))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            fp, _ = _split(batch.column("node").to_pylist())
            for band in range(len(bands)):
                row, shard, home = forest.shards(fp, band)
                at = pa.array(row)
                yield pa.RecordBatch.from_pydict({"band": pa.array(np.full(len(row), band, np.int32)), "shard": pa.array(shard), "home": pa.array(home), "node": batch.column("node").take(at), "grp": batch.column("grp").take(at)})
        settle()

    return rows.mapInArrow(deal, "band int, shard long, home boolean, node binary, grp long")


def candidate_forest(made: DataFrame, radius: int, similarity: float, bands: Bands = CANDIDATES, shard_rows: int = SHARD_ROWS, sample: int = SAMPLE) -> DataFrame:
    """(a, b): links that connect what the candidate pairs of the distinct nodes in ``made`` connect, fewer in each shard than it has nodes."""

    def search(key, rows):
        rows = rows.sort_by("node")
        fp, size = _split(rows["node"].to_pylist())
        found = [*shard_pairs(fp, size, rows["home"].to_numpy(), None, key[0].as_py(), bands, radius, similarity), np.zeros((0, 2), np.int64)]
        pairs = np.concatenate(found)
        return pa.table({"a": rows["node"].take(pa.array(pairs[:, 0])), "b": rows["node"].take(pa.array(pairs[:, 1]))})

    pairs = _dealt(made, bands, shard_rows, sample).groupBy("band", "shard").applyInArrow(search, "a binary, b binary")
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def links_between_groups(grouped: DataFrame, sets: DataFrame, radius: int, similarity: float, bands: Bands = CANDIDATES, shard_rows: int = SHARD_ROWS, sample: int = SAMPLE) -> DataFrame:
    """(a, b): verified links that connect what all verified candidate pairs of nodes (node, component) in different components connect.

    Shards first name the nodes that have such a pair there. Only those get their sets, and
    the pairs are verified where they are found: what leaves a shard are links that join
    two groups, fewer than it has nodes, never its pairs.
    """
    place = ["band", "shard", "home", "node", "grp"]
    schema = "band int, shard long, home boolean, node binary, grp long"

    def name(key, rows):
        rows = rows.sort_by("node")
        fp, size = _split(rows["node"].to_pylist())
        has = np.zeros(len(fp), bool)
        for pairs in shard_pairs(fp, size, rows["home"].to_numpy(), rows["grp"].to_numpy(), key[0].as_py(), bands, radius, similarity):
            has[pairs.ravel()] = True
        return rows.select(place).filter(pa.array(has))

    def verify(key, rows):
        rows = rows.sort_by("node")
        fp, size = _split(rows["node"].to_pylist())
        group = rows["grp"].to_numpy()
        shingles = [np.frombuffer(x.as_buffer(), np.uint64) for x in rows["shingles"]]
        _, first, again = np.unique(group, return_index=True, return_inverse=True)
        union, links = _Union(len(fp)), []
        union.parent[:] = first[again]
        for pairs in shard_pairs(fp, size, rows["home"].to_numpy(), group, key[0].as_py(), bands, radius, similarity):
            for a, b in pairs.tolist():
                if union.root(a) != union.root(b) and _similar(shingles[a], shingles[b], similarity):
                    union.parent[max(union.root(a), union.root(b))] = min(union.root(a), union.root(b))
                    links.append((a, b))
        found = np.array(links, np.int64).reshape(-1, 2)
        return pa.table({"a": rows["node"].take(pa.array(found[:, 0])), "b": rows["node"].take(pa.array(found[:, 1]))})

    named = _dealt(grouped, bands, shard_rows, sample).groupBy("band", "shard").applyInArrow(name, schema)
    able = lookup(materialise(named, "near-places"), ["node"], ["band", "shard"], sets)
    return able.groupBy("band", "shard").applyInArrow(verify, "a binary, b binary")


def _similar(x: np.ndarray, y: np.ndarray, similarity: float) -> bool:
    """Whether sorted sets of hashes have at least the Jaccard similarity."""
    shared = len(np.intersect1d(x, y, assume_unique=True))
    return shared >= similarity * (len(x) + len(y) - shared) - 1e-9


def verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs whose shingle sets have at least the Jaccard similarity."""
    one = lookup(pairs, ["a"], ["b"], sets.select(F.col("node").alias("a"), F.col("shingles").alias("x")))
    both = lookup(one, ["b"], ["a"], sets.select(F.col("node").alias("b"), F.col("shingles").alias("y")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
                keep.append(_similar(*(np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y)), similarity))
            yield pa.RecordBatch.from_pydict({k: batch.column(k).filter(pa.array(keep, pa.bool_())) for k in ("a", "b")})
        settle()

    return both.select("a", "b", "x", "y").mapInArrow(run, "a binary, b binary")


def near_components(docs: DataFrame, width: int, similarity: float, bands: Bands = CANDIDATES, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row per row of ``docs``: doc_id, text_key, component_id, the least doc_id reachable by verified links, and kept.

    kept is true for the row of each group that has the least doc_id, and of those the
    least text_key. Nulls: a null text is empty (an empty set, which only equals itself);
    a null doc_id comes after all others, and component_id is null where a group has no
    other. Repeated rows and equal sets are linked; rows that repeat the kept one in
    doc_id and text are all marked as kept. An empty table gives an empty result. Extra
    columns are not read.
    """
    radius = radius_of(similarity - SLACK, LONG)
    made = materialise(nodes(docs, width, LONG), "near-nodes")
    # the row that stands for a node
    distinct = materialise(made.groupBy("node").agg(F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_key")).alias("row")), "distinct-nodes")
    forest = materialise(candidate_forest(distinct, radius, similarity, bands, shard_rows), "near-forest")
    near = forest.select(F.col("a").alias("node")).union(forest.select(F.col("b").alias("node"))).distinct()
    near = materialise(distinct.join(near, "node", "left_semi").select("node", "row.doc_id", "row.text_key"), "near-candidates")
    sets = materialise(shingle_sets(docs, near, width), "near-sets")
    sure = materialise(verified(forest, sets, similarity), "near-links")
    grouped = near.select("node").join(components(sure).withColumnRenamed("node", "__of"), F.col("node") == F.col("__of"), "left")
    grouped = materialise(grouped.select("node", F.coalesce("component", "node").alias("component")), "near-groups")
    more = materialise(links_between_groups(grouped, sets, radius, similarity, bands, shard_rows), "near-links")
    groups = components(sure.union(more)) if not more.isEmpty() else grouped
    named = distinct.join(groups.withColumnRenamed("node", "__of"), F.col("node") == F.col("__of"), "left").select("node", "row", F.coalesce("component", "node").alias("component"))
    best = lookup(named, ["component"], ["node"], named.groupBy("component").agg(F.min("row").alias("best"))).select("node", "best")
    return lookup(made, ["node"], ["doc_id"], best).select(
        "doc_id",
        "text_key",
        F.col("best.doc_id").alias("component_id"),
        (F.col("doc_id").eqNullSafe(F.col("best.doc_id")) & (F.col("text_key") == F.col("best.text_key"))).alias("kept"),
    )
