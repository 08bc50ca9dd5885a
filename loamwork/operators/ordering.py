"""Row numbers over a whole table, without gathering it in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loamwork.session import materialise

#: monotonically_increasing_id() keeps the partition above this many bits.
_BITS = 33


def with_global_index(df: DataFrame, order: list[str], index: str = "idx") -> DataFrame:
    """Add ``index``: 0, 1, 2, ... in the order of the columns ``order``.

    Rows are dealt out by ranges of ``order`` and sorted inside each range; only one
    row count per range is summed centrally. A hot first column is split between
    ranges by the columns after it. ``df`` is read twice (once for the range bounds),
    so pass a narrow or written table. Rows that tie in all of ``order`` get numbers
    in any order among themselves. An empty table stays empty.
    """
    placed = materialise(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("__id", F.monotonically_increasing_id())
        .withColumn("__part", F.shiftright("__id", _BITS))
        .withColumn("__pos", F.col("__id").bitwiseAND((1 << _BITS) - 1))
        .drop("__id"),
        "ordered",
    )
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy("__part")
        .agg(F.count("*").alias("__n"))
        .select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    )
    # one row per range: its size is bounded by the number of shuffle partitions
    return placed.join(F.broadcast(starts), "__part").select(
        *df.columns, (F.col("__start") + F.col("__pos")).alias(index)
    )
