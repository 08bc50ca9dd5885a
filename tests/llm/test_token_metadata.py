"""What the token files have besides ids: stripes, row indexes and Bloom filters, and that reading uses them."""

import glob
import os

import public_tokenizers as P
import pyarrow.orc as orc
import pytest

from loamwork.llm.token_files import read_documents, read_token_files, write_token_files
from loamwork.session import new_path

TOKENIZER = P.path("word_bpe_49k.json")


def scanned(df):
    """Rows that the scan gave out when ``df`` ran."""
    plan = df._jdf.queryExecution().executedPlan()
    leaves = plan.collectLeaves()
    return sum(leaves.apply(k).metrics().apply("numOutputRows").value() for k in range(leaves.size()))


def test_stripes_and_pruning(spark):
    path = new_path(spark, "tokens")
    docs = spark.range(0, 60_000, 2).selectExpr("id AS doc_id", "concat('text number ', id, ' of many words and more') AS text").repartitionByRange(2, "doc_id")
    write_token_files(docs, path, TOKENIZER, 2, stripe_bytes=1 << 16)
    files = [orc.ORCFile(f) for f in glob.glob(f"{path.removeprefix('file:')}/*.orc")]
    assert sum(f.nrows for f in files) == 30_000 and max(f.nstripes for f in files) > 1
    assert all(f.row_index_stride == 1000 for f in files)
    found = read_documents(spark, path, [40_000])
    assert [r.doc_id for r in found.collect()] == [40_000]
    assert scanned(found) <= 5000  # some row groups, not all 30,000 rows
    between = read_documents(spark, path, [40_001])  # inside the range of a row group: only its Bloom filter knows
    assert between.collect() == [] and scanned(between) == 0
    assert read_documents(spark, path, [-5, 70_000]).count() == 0
    assert sorted(r.start for r in read_token_files(spark, path).select("start").collect())[0] == 0


def test_bloom_filters_are_written(spark):
    path = new_path(spark, "tokens")
    docs = spark.range(3000).selectExpr("id AS doc_id", "'a b' AS text").coalesce(1)
    write_token_files(docs, path, TOKENIZER, 2)
    size = sum(map(os.path.getsize, glob.glob(f"{path}/*.orc")))
    spark.read.orc(path).coalesce(1).write.orc(path + "-plain")
    assert size > sum(map(os.path.getsize, glob.glob(f"{path}-plain/*.orc"))) + 1000
    with pytest.raises(ValueError):
        write_token_files(docs, path + "-x", TOKENIZER, 2, index_stride=500)
