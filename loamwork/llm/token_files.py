"""Token ids in ORC files.

Documents are dealt out by ranges of doc_id, sorted and encoded; each range becomes one
file whose stripes hold the ids with ORC's integer run-length encoding, a row index
every INDEX_STRIDE rows and Bloom filters on doc_id. Readers split files by stripes and
skip files, stripes and row groups by the minimum, maximum and Bloom filter of doc_id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loamwork.llm.library_tokenizer import library_tokenizer
from loamwork.llm.texts import chunks, lists

STRIPE_BYTES = 16 << 20
INDEX_STRIDE = 1000
SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("part", T.IntegerType()),
        T.StructField("before_in_part", T.LongType()),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids", T.ArrayType(T.IntegerType())),
    ]
)


def write_token_files(
    docs: DataFrame,
    path: str,
    tokenizer_path: str,
    end_id: int,
    cut: str = "words",
    stripe_bytes: int = STRIPE_BYTES,
    index_stride: int = INDEX_STRIDE,
) -> None:
    """Encode whole texts and write their ids, each document's with ``end_id`` after them, in ascending doc_id order.

    Rows: doc_id, part (the file's number, ascending with doc_id), before_in_part (ids
    of the rows before it in its file), n_tokens, ids. Nulls: a null text has the end
    id alone; null doc_ids come first. Repeated doc_ids are ordered by their texts. An
    empty table gives files without rows. Extra columns are not read. The tokenizer
    file is read on the driver and sent to the workers (a fixed size). ``index_stride`` is
    1000 rows at least, as the format asks.
    """
    if index_stride < 1000:
        raise ValueError("a row index has an entry for 1000 rows or more")
    with open(tokenizer_path, "rb") as f:
        content = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, part, before = library_tokenizer(content.value, cut), TaskContext.get().partitionId(), 0
        for rows, data, at in chunks(batches):
            ids, ends = tokenizer.encode(data, at, end_id)
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": rows.column("doc_id"),
                    "part": pa.array(np.full(len(rows), part, np.int32)),
                    "before_in_part": pa.array(before + ends[:-1]),
                    "n_tokens": pa.array(np.diff(ends)),
                    "ids": lists(ids, ends, pa.int32()),
                }
            )
            before += int(ends[-1])

    (
        docs.select(F.col("doc_id").cast("long"), "text")
        .repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id", "text")
        .mapInArrow(run, SCHEMA)
        .write.option("orc.stripe.size", stripe_bytes)
        .option("orc.row.index.stride", index_stride)
        .option("orc.create.index", "true")
        .option("orc.bloom.filter.columns", "doc_id")
        .option("orc.bloom.filter.fpp", "0.01")
        .orc(path)
    )


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """The rows of the files with start: the ids of all documents before each.

    The ids of each file are summed from the n_tokens column alone; one row per file is
    numbered centrally.
    """
    rows = spark.read.schema(SCHEMA).orc(path)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = rows.groupBy("part").agg(F.sum("n_tokens").alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__base"))
    return rows.join(F.broadcast(parts), "part").withColumn("start", F.col("__base") + F.col("before_in_part")).drop("__base")


def read_documents(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """Rows of the given documents: the filter reaches the files' row indexes and Bloom filters.

    Null doc_ids are never among them; rows that repeat a doc_id all are; files without
    rows, and doc_ids that no file has, give none.
    """
    return spark.read.schema(SCHEMA).orc(path).filter(F.col("doc_id").isin(doc_ids))


def with_ids_crc32(rows: DataFrame) -> DataFrame:
    """Replace ids by ids_crc32, the unsigned crc32 of the ids as little-endian unsigned 32-bit integers.

    Null or no ids have that of no bytes, 0. Other columns and repeated rows stay.
    """
    import zlib

    kept = [f for f in rows.schema.fields if f.name != "ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("ids")
            flat = column.flatten().to_numpy(zero_copy_only=False).astype("<u4")
            ends = np.append(0, np.cumsum(column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)))
            crc = [zlib.crc32(flat[a:b]) for a, b in zip(ends, ends[1:], strict=False)]
            yield pa.RecordBatch.from_pydict({f.name: batch.column(f.name) for f in kept} | {"ids_crc32": pa.array(crc, pa.int64())})

    return rows.select(*(f.name for f in kept), "ids").mapInArrow(run, T.StructType([*kept, T.StructField("ids_crc32", T.LongType())]))
