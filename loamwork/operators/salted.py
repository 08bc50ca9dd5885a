"""Joins of many rows with one row a key, where a key may hold a large part of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SALTS = 256


def lookup(rows: DataFrame, keys: list[str], within: list[str], values: DataFrame, salts: int = SALTS) -> DataFrame:
    """``rows`` with the columns of ``values``, which has one row for each of the keys.

    A key's rows are dealt over up to ``salts`` tasks by a hash of the columns
    ``within``. The value of a key is repeated only for the salts that its rows have,
    so the repeats are never more than the rows, and one for a key with one row. Rows
    whose key is null or not in ``values`` are left out, as in an inner join; repeated
    rows stay; an empty table gives an empty result.
    """
    dealt = rows.withColumn("__salt", F.pmod(F.xxhash64(*within), F.lit(salts)).cast("int"))
    there = dealt.select(*keys, "__salt").distinct().groupBy(*keys).agg(F.collect_list("__salt").alias("__salts"))
    each = values.join(there, keys).select(*values.columns, F.explode("__salts").alias("__salt"))
    return dealt.join(each, [*keys, "__salt"]).drop("__salt")
