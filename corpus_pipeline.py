"""A pipeline that turns documents into packed training sequences.

Each stage takes (spark, docs, sf_dir), works on all rows that its predecessor kept and
returns a DataFrame; run() writes each stage's rows as Parquet and hands them to the
next. All stages but the last return the columns of documents, whatever their names.
Rows of a stage are written before the next stage begins: a stage first deletes the
tables that earlier stages of this pipeline wrote on their way (no others).

Nulls, empty texts, ties and repeated rows: as the operators say. A row that repeats
another in doc_id and text is an exact copy, and one of them stays; rows that share a
doc_id with different texts, and rows without a doc_id, are told apart by their texts.
An empty table passes through all stages.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loamwork.llm.exact_dedup import exact_dedup
from loamwork.llm.keeping import kept_rows, text_key
from loamwork.llm.near_dedup import near_components
from loamwork.llm.packing import pack
from loamwork.llm.quality import quality_rules
from loamwork.llm.queries import remainder
from loamwork.llm.toxicity import toxicity
from loamwork.session import delete_paths, materialise, steps_into

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
SHINGLE_WORDS, SIMILARITY = 5, 0.8
#: Less than the operator takes alone: here the executors' heaps have grown in earlier stages.
_CHUNK, _CACHED = 1 << 19, 64_000
#: Rows that go to a Python worker at once, where the session allows more.
_ROWS = 1000
#: Tables that the stage before wrote on its way.
_left: list[str] = []


def _within(spark: SparkSession, stage: Callable[[], DataFrame]) -> DataFrame:
    """The stage's rows; tables of the stage before go first. Arrow batches of the session get at most _ROWS rows."""
    delete_paths(spark, _left)
    most = int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"))
    if not 0 < most <= _ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(_ROWS))
    with steps_into(_left):
        return stage()


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not predict to be toxic.

    Null and empty texts have no evidence and stay; repeated rows are each judged.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    judged = _within(spark, lambda: toxicity(docs, labels, remainder(5) == 0, keep=docs.columns))
    return judged.filter("predicted = 0").select("row.*")


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep; null and empty texts are too short and go."""
    return _within(spark, lambda: quality_rules(docs, keep=docs.columns)).filter("kept").select("row.*")


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts (null: empty), the one with the largest doc_id; of rows equal in both, one."""

    def stage() -> DataFrame:
        marks = exact_dedup(docs).select("doc_id", F.col("text_sha256").alias("key"), "kept")
        return kept_rows(docs, marks, F.sha2(F.coalesce("text", F.lit("")), 256))

    return _within(spark, stage)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by similar shingles, the one with the least doc_id (a null one last); of rows equal in doc_id and text, one."""

    def stage() -> DataFrame:
        marks = near_components(docs, SHINGLE_WORDS, SIMILARITY).select("doc_id", F.col("text_key").alias("key"), "kept")
        return kept_rows(docs, marks, text_key(F.col("text")))

    return _within(spark, stage)


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 1024, with their token ids; a null text has the end id alone."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    return _within(spark, lambda: pack(docs, path, end_id=0, length=1024, chunk_bytes=_CHUNK, with_ids=True, cached=_CACHED))


STAGES = [
    ("toxicity", drop_toxic),
    ("quality_rules", drop_low_quality),
    ("exact_dedup", drop_exact_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("packing", pack_documents),
]

#: The stages hold models and tokenizers that SQL cannot express; tests hold them
#: against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; those of the stages before are deleted once they have been read."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, stage in STAGES:
        rows, written = stage(spark, docs, sf_dir), []
        with steps_into(written):
            docs = materialise(rows, f"pipeline-{name}")
        delete_paths(spark, before)
        before = written
    delete_paths(spark, _left)
    return docs
