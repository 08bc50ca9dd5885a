"""Exact duplicates by deterministic block naming.

Every text is cut into blocks of a fixed number of bytes. Distinct blocks are sorted
and get their ranks as integer names; then adjacent names of a text are paired and
distinct pairs get their ranks as names, round after round, until each text has a single
name. Two texts are equal if and only if they have the same number of blocks and the same
last name. Names depend on the texts alone, not on how rows are dealt over tasks.

Blocks are sorted and found again by two 64-bit hashes, but only after it has been checked
on all blocks that no two different ones share them; otherwise other seeds are taken. So
the names are free of collisions, not just unlikely to collide.

Only DataFrame functions are used. Equal blocks and pairs are combined before they are
shuffled, so a group that holds a third of all rows costs one row per task; joins back
to documents deal the rows of a hot group over many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loamwork.operators.ordering import with_global_index
from loamwork.operators.salted import lookup
from loamwork.session import materialise

BLOCK_BYTES = 4096


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def blocks_of(text: Column, block_bytes: int) -> Column:
    """The UTF-8 bytes of ``text`` in blocks; an empty text has none."""
    count = F.ceil(F.octet_length(text) / F.lit(block_bytes)).cast("int")
    return F.when(F.octet_length(text) == 0, F.array().cast("array<binary>")).otherwise(
        _let(
            text.cast("binary"),
            lambda b: F.transform(
                F.sequence(F.lit(0), count - 1),
                lambda i: F.substring(b, i * block_bytes + 1, F.lit(block_bytes)),
            ),
        )
    )


def _block_keys(block: Column, seed: int) -> list[Column]:
    return [F.xxhash64(F.lit(2 * seed), block), F.xxhash64(F.lit(2 * seed + 1), block)]


def _names_of_blocks(texts: DataFrame, block_bytes: int) -> tuple[DataFrame, int]:
    """(k1, k2, name) of all distinct blocks, and the seed of the hashes k1 and k2."""
    block = texts.select(F.explode(blocks_of(F.col("text"), block_bytes)).alias("block"))
    seed = 0
    while True:
        k1, k2 = _block_keys(F.col("block"), seed)
        named = materialise(
            block.groupBy(k1.alias("k1"), k2.alias("k2"))
            .agg(F.collect_set("block").alias("same"))
            .select("k1", "k2", F.size("same").alias("n")),
            "blocks",
        )
        if named.filter("n > 1").isEmpty():
            return with_global_index(named.select("k1", "k2"), ["k1", "k2"], "name"), seed
        seed += 1


def identities(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per row of ``docs``: row, doc_id, text_sha256, n_blocks, name.

    (n_blocks, name) is equal for equal texts only. row numbers the rows, so repeated
    doc_ids stay apart. A null text counts as empty; an empty text has n_blocks 0 and
    name -1. Columns other than doc_id and text are not read.
    """
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    names, seed = _names_of_blocks(texts, block_bytes)
    base = materialise(
        texts.select(
            F.monotonically_increasing_id().alias("row"),
            "doc_id",
            F.sha2("text", 256).alias("text_sha256"),
            F.transform(
                blocks_of(F.col("text"), block_bytes),
                lambda b: F.struct(*(k.alias(f"k{n}") for n, k in enumerate(_block_keys(b, seed), 1))),
            ).alias("keys"),
        ),
        "block-keys",
    )
    level = materialise(
        _gathered(lookup(base.select("row", F.posexplode("keys").alias("at", "key")).select("row", "at", "key.k1", "key.k2"), ["k1", "k2"], ["row"], names)),
        "names",
    )
    done = []
    while True:
        done.append(level.filter(F.size("names") == 1).select("row", F.element_at("names", 1).alias("name")))
        level = level.filter(F.size("names") > 1)
        if level.isEmpty():
            break
        level = _paired(level)
    last = done[0]
    for more in done[1:]:
        last = last.unionByName(more)
    return base.join(last, "row", "left").select(
        "row", "doc_id", "text_sha256", F.size("keys").cast("long").alias("n_blocks"), F.coalesce("name", F.lit(-1).cast("long")).alias("name")
    )


def _gathered(named: DataFrame) -> DataFrame:
    """(row, names): the names of a row in the order of ``at``."""
    return named.groupBy("row").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "name"))), lambda x: x["name"]).alias("names"))


def _paired(level: DataFrame) -> DataFrame:
    """One round: adjacent names become pairs, and each distinct pair gets a name."""
    pairs = level.select(
        "row",
        F.posexplode(
            F.transform(
                F.sequence(F.lit(0), F.ceil(F.size("names") / 2).cast("int") - 1),
                lambda i: F.struct(
                    F.get("names", i * 2).alias("a"),
                    F.coalesce(F.get("names", i * 2 + 1), F.lit(-1).cast("long")).alias("b"),
                ),
            )
        ).alias("at", "pair"),
    ).select("row", "at", "pair.a", "pair.b")
    names = with_global_index(materialise(pairs.select("a", "b").distinct(), "pairs"), ["a", "b"], "name")
    return materialise(_gathered(lookup(pairs, ["a", "b"], ["row"], names)), "names")


def exact_dedup(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Mark, of documents with equal texts, the one with the largest doc_id.

    Returns one row per row of ``docs``: doc_id, keep_id, group_size, kept,
    text_sha256, n_blocks, name. Nulls: a null text is an empty text; a null doc_id
    sorts below all others. Repeated rows: of rows equal in doc_id and text one is
    kept. An empty table gives an empty result. Extra columns are not read.
    """
    named = materialise(identities(docs, block_bytes), "identities")
    groups = named.groupBy("n_blocks", "name").agg(
        F.max(F.struct("doc_id", "row")).alias("best"), F.count("*").alias("group_size")
    )
    return lookup(named, ["n_blocks", "name"], ["row"], groups).select(
        "doc_id",
        F.col("best.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("best.row")).alias("kept"),
        "text_sha256",
        "n_blocks",
        "name",
    )
