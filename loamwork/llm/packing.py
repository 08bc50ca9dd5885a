"""Packing documents into sequences of a fixed length, as a cutting-stock problem.

A document's ids are cut into full sequences and one rest. The histogram of the rests'
lengths, in classes of GRANULE tokens, is all that the driver sees: its size does not
depend on the input. Column generation solves the linear program over patterns (which
classes share a sequence): a knapsack by dynamic programming prices new patterns by the
dual values. Whole parts of the solution are taken, what is left is packed best-fit
decreasing. Rests are ranked inside their class by a distributed sort, and ranks are
assigned to the patterns' places in order.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loamwork.llm.library_tokenizer import CACHED, library_tokenizer
from loamwork.llm.texts import CHUNK_BYTES, chunks, lists
from loamwork.operators.ordering import with_global_index
from loamwork.session import materialise

LENGTH = 1024
GRANULE = 4
#: The linear program ends when its value is within this share of its lower bound, or
#: falls by less than this share in as many steps as there are sizes.
GAP = 5e-4
#: Steps of the simplex method for each size at most; whole_patterns repacks what is left over.
STEPS = 10


def cut_documents(docs: DataFrame, tokenizer_path: str, end_id: int, length: int = LENGTH, cut: str = "slices", chunk_bytes: int = CHUNK_BYTES, with_ids: bool = True, cached: int = CACHED) -> DataFrame:
    """Pieces of at most ``length`` ids: doc_id, start, length, ids_crc32, doc_tokens, and ids if asked for.

    Each text is encoded whole, ``end_id`` comes after it, and every piece but the last
    has ``length`` ids. Nulls: a null text has the end id alone; a null doc_id is kept.
    """
    with open(tokenizer_path, "rb") as f:
        content = docs.sparkSession.sparkContext.broadcast(f.read())
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = library_tokenizer(content.value, cut, cached)
        for rows, data, at in chunks(batches, limit=chunk_bytes):
            ids, ends = tokenizer.encode(data, at, end_id)
            tokens = np.diff(ends)
            pieces = -(-tokens // length)
            doc = np.repeat(np.arange(len(tokens)), pieces)
            first = np.cumsum(pieces) - pieces
            start = (np.arange(len(doc)) - first[doc]) * length
            begin = ends[doc] + start
            size = np.minimum(length, tokens[doc] - start)
            flat = ids.astype("<u4")
            crc = [zlib.crc32(flat[a : a + n]) for a, n in zip(begin.tolist(), size.tolist(), strict=True)]
            out = {
                "doc_id": rows.column("doc_id").take(pa.array(doc)),
                "start": pa.array(start),
                "length": pa.array(size),
                "ids_crc32": pa.array(crc, pa.int64()),
                "doc_tokens": pa.array(tokens[doc]),
            }
            if with_ids:
                out["ids"] = lists(ids, np.append(0, np.cumsum(size)), pa.int32())
            yield pa.RecordBatch.from_pydict(out)

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long" + ", ids array<int>" * with_ids)


def _best_pattern(dual: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The pattern of greatest total dual value: an unbounded knapsack over sizes 1..capacity."""
    best, choice = np.zeros(capacity + 1), np.zeros(capacity + 1, np.int64)
    for room in range(1, capacity + 1):
        values = dual[:room] + best[room - 1 :: -1]
        k = int(values.argmax())
        if values[k] > best[room - 1] + 1e-12:
            best[room], choice[room] = values[k], k + 1
        else:
            best[room] = best[room - 1]
    pattern, room = np.zeros(capacity, np.int64), capacity
    while room > 0:
        if choice[room]:
            pattern[choice[room] - 1] += 1
            room -= choice[room]
        else:
            room -= 1
    return float(best[capacity]), pattern


def solve_patterns(demand: np.ndarray, gap: float = GAP) -> tuple[np.ndarray, np.ndarray]:
    """Patterns (rows, counts of sizes 1..capacity) and how often each is used in the linear program's solution.

    ``demand``: items of each size. Revised simplex over generated columns; it ends at
    the optimum, when Farley's bound shows the value to be within ``gap``, or when the
    value hardly falls any more.
    """
    capacity = len(demand)
    sizes = np.flatnonzero(demand)
    m = len(sizes)
    if not m:
        return np.zeros((0, capacity), np.int64), np.zeros(0)
    # to begin with, each large size shares a sequence with what fills it up exactly
    have = demand[sizes].astype(float)
    basis = np.diag((capacity // (sizes + 1)).astype(float))
    level = have / np.diag(basis)
    inverse = np.diag(1 / np.diag(basis))
    row_of = {int(c): k for k, c in enumerate(sizes + 1)}
    for c, k in row_of.items():
        j = row_of.get(capacity - c)
        if j is not None and 2 * c > capacity:
            alone, both = (j, k) if have[j] >= have[k] else (k, j)
            basis[[k, j], both] = 1
            level[both] = have[both]
            basis[alone, alone] = capacity // (sizes[alone] + 1)
            level[alone] = (have[alone] - have[both]) / basis[alone, alone]
            # the inverse of the block [[1, 0], [1, copies]]
            inverse[both, both], inverse[alone, both] = 1, -1 / basis[alone, alone]
    earlier = np.inf
    for step in range(STEPS * m):
        if step % max(m, 50) == 0:
            if level.sum() > earlier * (1 - gap):
                break
            earlier = level.sum()
        dual = np.full(capacity, -1.0)
        dual[sizes] = inverse.sum(0)
        value, pattern = _best_pattern(dual, capacity)
        if value <= 1 + 1e-9 or level.sum() * (1 - 1 / value) <= gap * level.sum():
            break
        column = pattern[sizes].astype(float)
        direction = inverse @ column
        ratio = np.where(direction > 1e-9, level / np.where(direction > 1e-9, direction, 1), np.inf)
        leave = int(ratio.argmin())
        basis[:, leave] = column
        move = ratio[leave]
        level = np.maximum(0, level - move * direction)
        level[leave] = move
        row = inverse[leave] / direction[leave]
        inverse -= np.outer(direction, row)
        inverse[leave] = row
    patterns = np.zeros((m, capacity), np.int64)
    patterns[:, sizes] = np.rint(basis.T).astype(np.int64)
    return patterns, level


def whole_patterns(demand: np.ndarray, gap: float = GAP) -> tuple[np.ndarray, np.ndarray]:
    """Patterns and whole numbers of uses that hold exactly the demanded items."""
    capacity = len(demand)
    patterns, level = solve_patterns(demand, gap)
    uses = np.floor(level + 1e-6).astype(np.int64)
    for k in np.flatnonzero(uses):  # rounding must not use more items than there are
        used = patterns.T @ uses
        over = (used > demand) & (patterns[k] > 0)
        if over.any():
            uses[k] -= min(uses[k], int(np.max(-(-(used - demand)[over] // patterns[k][over]))))
    rest = demand - patterns.T @ uses
    bins: list[np.ndarray] = []
    open_by_room: dict[int, list[int]] = {}
    for size in range(capacity, 0, -1):
        for _ in range(int(rest[size - 1])):
            room = next((r for r in range(size, capacity + 1) if open_by_room.get(r)), None)
            if room is None:
                bins.append(np.zeros(capacity, np.int64))
                at, room = len(bins) - 1, capacity
            else:
                at = open_by_room[room].pop()
            bins[at][size - 1] += 1
            open_by_room.setdefault(room - size, []).append(at)
    if bins:
        patterns, uses = np.vstack([patterns, *(b[None] for b in bins)]), np.append(uses, np.ones(len(bins), np.int64))
    return patterns[uses > 0], uses[uses > 0]


def pack(docs: DataFrame, tokenizer_path: str, end_id: int, length: int = LENGTH, granule: int = GRANULE, cut: str = "slices", chunk_bytes: int = CHUNK_BYTES, with_ids: bool = False, cached: int = CACHED) -> DataFrame:
    """Pack all documents: one row per piece with doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, and ids if asked for.

    ``chunk_bytes`` of text are tokenized at once, and about ``cached`` pieces of text
    remembered; less takes less memory and more time.

    Every id lies in one piece; pieces of a sequence lie end to end from offset 0.
    Nulls: see cut_documents. Ties: rests of a length class are ranked by doc_id, and
    rows that tie in everything are alike. Repeated rows are each packed. An empty
    table gives an empty result. Extra columns are not read. All sequences are counted
    as ``length`` long; those that end at a power of two are not sought.
    """
    if length % granule:
        raise ValueError("length must be a multiple of granule")
    pieces = cut_documents(docs, tokenizer_path, end_id, length, cut, chunk_bytes, with_ids, cached)
    pieces = materialise(pieces.withColumn("piece", F.monotonically_increasing_id()), "pieces")
    capacity = length // granule
    size = F.when(F.col("length") == length, F.lit(capacity + 1)).otherwise(F.ceil(F.col("length") / granule)).cast("int")
    # at most capacity + 1 rows
    counts = {row["size"]: row["count"] for row in pieces.groupBy(size.alias("size")).count().collect()}
    demand = np.array([counts.get(k, 0) for k in range(1, capacity + 1)], np.int64)
    patterns, uses = whole_patterns(demand)
    before = np.append(0, np.cumsum(demand))
    base = np.cumsum(uses) - uses
    packed = int(uses.sum())
    # for each size: the first rank of each pattern that holds it, and the pattern
    places = []
    for k in range(capacity):
        users = np.flatnonzero(patterns[:, k]) if len(patterns) else np.zeros(0, np.int64)
        taken = uses[users] * patterns[users, k]
        places.append((np.cumsum(taken) - taken, patterns[users, k], base[users], patterns[users, :k].sum(1)))

    keys = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "piece"]
    placed = with_global_index(pieces.withColumn("size", size).select("size", *keys), ["size", "doc_id", "start", "ids_crc32", "length", "doc_tokens", "piece"], "at")
    kind = docs.schema["doc_id"].dataType.simpleString()

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, at = batch.column("size").to_numpy(), batch.column("at").to_numpy()
            rank = at - before[sizes - 1]
            sequence, slot = packed + rank, np.zeros(len(rank), np.int64)
            for k in np.unique(sizes[sizes <= capacity]):
                rows = sizes == k
                first, copies, start, slots = places[k - 1]
                j = np.searchsorted(first, rank[rows], "right") - 1
                inside = rank[rows] - first[j]
                sequence[rows] = start[j] + inside // copies[j]
                slot[rows] = slots[j] + inside % copies[j]
            yield pa.RecordBatch.from_pydict({c: batch.column(c) for c in keys} | {"sequence_id": pa.array(sequence), "slot": pa.array(slot)})

    schema = f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, piece long, sequence_id long, slot long"
    assigned = placed.mapInArrow(assign, schema)
    # at most ``length`` pieces in a sequence
    earlier = Window.partitionBy("sequence_id").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    full = assigned.filter(F.col("length") == length).withColumn("offset", F.lit(0).cast("long"))
    shared = assigned.filter(F.col("length") < length).withColumn("offset", F.coalesce(F.sum("length").over(earlier), F.lit(0)))
    out = full.unionByName(shared).select(*keys, "sequence_id", "offset")
    if with_ids:
        out = out.join(pieces.select("piece", "ids"), "piece")
    return out.drop("piece")


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id and ids of every sequence, from the rows of pack with their ids.

    A sequence has at most ``length`` ids, so its pieces fit in a row; pieces whose ids are
    null add none. An empty table gives an empty result.
    """
    pieces = F.array_sort(F.collect_list(F.struct("offset", F.coalesce("ids", F.array().cast("array<int>")).alias("ids"))))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(pieces, lambda x: x["ids"])).alias("ids"))
