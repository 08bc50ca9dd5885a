"""What a worker of the byte-level BPE holds at once: runs of texts by their bytes, in one Python stage."""

import base64
import hashlib
import tracemalloc
from types import SimpleNamespace
from unittest.mock import MagicMock

import public_tokenizers as P
import pyarrow as pa
import tiktoken

from loamwork.llm import byte_bpe
from loamwork.llm import queries as Q

PATH = P.path("byte_bpe_multi_50k.tiktoken")
MB = 1 << 20


def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def in_this_process(operator):
    """The function that the operator hands to mapInArrow."""
    df = MagicMock()
    df.sparkSession.sparkContext.broadcast.side_effect = lambda x: SimpleNamespace(value=x)
    df.select.return_value.mapInArrow.side_effect = lambda run, schema: run
    return operator(df, PATH)


def peak_of(run, batch: pa.RecordBatch) -> tuple[float, list]:
    """MB that Python and NumPy held at most while the rows of ``batch`` went through, and what came out."""
    list(run(iter([batch.slice(0, 1)])))  # reads the vocabulary
    tracemalloc.start()
    out = list(run(iter([batch])))
    most = tracemalloc.get_traced_memory()[1] / MB
    tracemalloc.stop()
    return most, out


def test_what_is_held_follows_bytes_and_not_rows():
    texts = ["the cat sat on the mat, and it's 12 é " * 500] * 400
    n_bytes = sum(len(t.encode()) for t in texts)
    assert n_bytes > 7 * MB
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array(range(400)), "text": texts})
    most, out = peak_of(in_this_process(byte_bpe.encode), batch)
    assert most < 64, f"{most:.0f} MB held while {n_bytes / MB:.1f} MB were encoded"
    want = library().encode_ordinary(texts[0])
    ids = pa.Table.from_batches(out).combine_chunks()
    assert ids.column("doc_id").to_pylist() == [*range(400)] and all(x == want for x in ids.column("ids").to_pylist())
    [encoded] = ids.to_batches()
    most, out = peak_of(in_this_process(byte_bpe.decode), encoded)
    assert most < 64, f"{most:.0f} MB held while {n_bytes / MB:.1f} MB were decoded"
    decoded = pa.Table.from_batches(out)
    assert decoded.column("doc_id").to_pylist() == [*range(400)]
    assert [x.decode() for x in decoded.column("bytes").to_pylist()] == texts


def test_runs_part_rows_of_any_size():
    long = "x1 " * 300_000
    texts = ["", None, "a", long, "", long + "y", *["b c"] * 3000, None, "end", ""]
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array(range(len(texts))), "text": pa.array(texts, pa.string())})
    encoded = list(in_this_process(byte_bpe.encode)(iter([batch, batch.slice(0, 0), batch.slice(4, 2)])))
    out = list(in_this_process(byte_bpe.decode)(iter(encoded)))
    assert [x for b in out for x in b.column("doc_id").to_pylist()] == [*range(len(texts)), 4, 5]
    assert [x.decode() for b in out for x in b.column("bytes").to_pylist()] == [t or "" for t in [*texts, *texts[4:6]]]
    # rows without ids, from elsewhere
    none = pa.RecordBatch.from_pydict({"doc_id": [1, 2, 3], "ids": pa.array([None, [], [5]], pa.list_(pa.int32())), "offsets": pa.array([None, [], [2]], pa.list_(pa.int32()))})
    [got] = in_this_process(byte_bpe.decode)(iter([none]))
    assert got.column("bytes").to_pylist() == [b"", b"", b"\0\0" + library().decode_single_token_bytes(5)]


def test_ids_do_not_pass_to_a_second_worker(spark, tmp_path):
    texts = [None, "", " \n\t", "we'll \n\n go  don't İstanbul ß 日本 🙂", "twice", "twice", "the cat 'll 12 é " * 60_000]
    rows = [(k, t) for k, t in enumerate(texts)] + [(5, "twice"), (None, "no id")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    query = Q.op9_byte_bpe(spark, str(tmp_path))
    plan = query._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1
    enc = library()
    want = []
    for k, t in rows:
        ids = enc.encode_ordinary(t or "")
        want.append((k, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    order = lambda r: (-1 if r[0] is None else r[0], r[1:])
    assert sorted(map(tuple, query.collect()), key=order) == sorted(want, key=order)
    by_two = byte_bpe.decode(byte_bpe.encode(docs, PATH), PATH)
    assert sorted(map(str, byte_bpe.encode_decode(docs, PATH).collect())) == sorted(map(str, by_two.collect()))
    empty = spark.createDataFrame([], "doc_id int, text string")
    assert byte_bpe.encode_decode(empty, PATH).schema["doc_id"].dataType.simpleString() == "int" and byte_bpe.encode_decode(empty, PATH).count() == 0
