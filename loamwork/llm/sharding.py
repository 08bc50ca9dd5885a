"""Shards that each hold the mixture of the whole, by proportional stratified interleaving.

Rows of each source are shuffled by a seeded hash and ranked; the fractional rank
(rank + 1/2) / rows of the source spreads every source evenly over 0..1. Sorting all
rows by it interleaves the sources in proportion, and cutting the sorted rows into runs
of equal length gives shards whose counts differ by at most one, overall, and by at
most two within each source.

Only DataFrame functions are used. A source that holds a third of all rows is ranked by
range partitions of (source, hash), never in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loamwork.operators.ordering import with_global_index
from loamwork.operators.salted import lookup
from loamwork.session import materialise

SEED = 20240611


def interleaved_shards(docs: DataFrame, n_shards: int = 8, seed: int = SEED) -> DataFrame:
    """One row per row of ``docs``: doc_id, source, size, text_crc32, frac, position, shard, slot.

    size: UTF-8 bytes of the text plus 1. position: 0, 1, ... over all rows in
    interleaved order; shard and slot follow from it. Nulls: a null text is empty (size
    1, crc32 0); rows with a null source are a source of their own; a null doc_id is
    shuffled like any other value. Rows that tie in every key column are alike, and
    take their positions in any order. Fewer rows than shards leave shards empty. An
    empty table gives an empty result. Extra columns are not read.
    """
    text = F.coalesce("text", F.lit(""))
    keyed = materialise(
        docs.select(
            "doc_id",
            "source",
            F.when(F.col("source").isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), "source")).alias("stratum"),
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))).alias("mix"),
        ),
        "shard-keys",
    )
    ties = ["mix", "doc_id", "text_crc32", "size"]
    ranked = with_global_index(keyed, ["stratum", *ties], "at")
    strata = ranked.groupBy("stratum").agg(F.min("at").alias("first"), F.count("*").alias("rows"))
    spread = materialise(
        lookup(ranked, ["stratum"], ["at"], strata).select(
            *keyed.columns, ((F.col("at") - F.col("first") + F.lit(0.5)) / F.col("rows")).alias("frac")
        ),
        "shard-ranks",
    )
    total = max(1, spread.count())
    placed = with_global_index(spread, ["frac", *ties, "stratum"], "position")
    shard = F.expr(f"(position * {n_shards}L) div {total}L")
    return placed.select(
        "doc_id",
        "source",
        "size",
        "text_crc32",
        "frac",
        "position",
        shard.cast("int").alias("shard"),
        (F.col("position") - F.expr(f"((position * {n_shards}L) div {total}L * {total}L + {n_shards - 1}L) div {n_shards}L")).alias("slot"),
    )
