"""Rows dealt over tasks by their number, and filters that come after what they test."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ROWS_A_TASK = 2000


def dealt(rows: DataFrame, *keys: str, each: int = ROWS_A_TASK) -> DataFrame:
    """``rows`` in one partition for every ``each`` of them, by a hash of ``keys``.

    For work that is slow for its bytes: files and shuffles are cut by bytes, which would
    leave such rows to few tasks. ``rows`` is counted, so pass what is cheap to read.
    """
    return rows.repartition(-(-max(1, rows.count()) // each), *keys)


@contextmanager
def shuffled_into(spark: SparkSession, least: int) -> Iterator[None]:
    """Shuffles of what is run inside have ``least`` partitions or more; adaptive execution joins those that are small."""
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, str(max(int(before), least)))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def filtered(rows: DataFrame, condition: Column) -> DataFrame:
    """Rows that meet the condition, tested after the columns of ``rows`` are computed.

    A plain filter would be pushed below them, and what it tests computed twice.
    """
    return rows.withColumn("__at", F.monotonically_increasing_id()).filter((F.col("__at") >= 0) & condition).drop("__at")
