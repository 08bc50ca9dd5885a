"""The registered queries over the test tables, and SQL for those that SQL can express."""

from __future__ import annotations

import importlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loamwork.llm.byte_bpe import encode_decode
from loamwork.llm.exact_dedup import exact_dedup
from loamwork.llm.licenses import license_scan
from loamwork.llm.log_bilinear import score_documents
from loamwork.llm.packing import pack
from loamwork.llm.quality import (
    COMMON_WORDS,
    MAX_CLASS_DISTANCE,
    MAX_REPEATED_PERCENT,
    MAX_WORD_DISTANCE,
    MIN_CHARS_FOR_CLASSES,
    MIN_WORDS,
    MIN_WORDS_FOR_COMMON,
    OTHER,
    quality_rules,
)
from loamwork.llm.sharding import SEED, interleaved_shards
from loamwork.llm.simhash import simhash_components
from loamwork.llm.token_files import read_token_files, with_ids_crc32, write_token_files
from loamwork.llm.toxicity import toxicity
from loamwork.session import new_path


def remainder(n: int) -> Column:
    """crc32 of doc_id as text, modulo ``n``."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(n))


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score and prediction of every document, learned from labels of documents outside the held-out fifth. Null texts are empty and scored; repeated rows and doc_ids are each scored; an empty table gives no rows."""
    return toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"), remainder(5) == 0)


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of equal texts (null: empty) the row with the largest doc_id stays; every row is returned. Repeated rows are copies; an empty table gives no rows."""
    return exact_dedup(_table(spark, sf_dir, "documents")).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of every document by the unigram and the log-bilinear model, learned outside the held-out seventh. Null texts have the end alone; an empty table gives no rows."""
    return score_documents(_table(spark, sf_dir, "documents"), remainder(7) == 2)


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places of phrases and licence notices in every document. Null texts have none; repeated rows are each scanned; an empty table gives no rows."""
    starts = F.transform("phrases", lambda p: p["word"])
    return license_scan(_table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_words",
        F.size("phrases").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        "base_labels",
        "labels",
        "score",
        "matches",
    )


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document. Texts without words have fingerprint zero and are linked; an empty table gives no rows."""
    return simhash_components(_table(spark, sf_dir, "documents")).select("doc_id", F.lower(F.hex("fp")).alias("fingerprint"), "component_id")


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document as read back from the ORC files. Null texts have the end id alone; rows that repeat a doc_id follow each other by text; an empty table gives no rows."""
    path = new_path(spark, "tokens")
    write_token_files(_table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return with_ids_crc32(read_token_files(spark, path)).select("doc_id", "start", "n_tokens", "ids_crc32")


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, distances and verdict of every document. Null texts fail; repeated rows are each judged; an empty table gives no rows."""
    judged = quality_rules(_table(spark, sf_dir, "documents"))
    return judged.withColumns({c: F.round(c, 6) for c in ("class_distance", "word_distance")})


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document by law "rows". Null texts have size 1; rows that tie in everything are alike; an empty table gives no rows."""
    return interleaved_shards(_table(spark, sf_dir, "documents"), 8).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "source"
    )


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the ids of every document and of what their bytes are when they are decoded at their offsets. Null texts have no ids; an empty table gives no rows."""
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return encode_decode(_table(spark, sf_dir, "documents"), ranks).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"),
    )


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where every piece of every document lies in the sequences. Null texts have the end id alone; repeated rows are each packed; an empty table gives no rows."""
    return pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=0, length=1024)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packed sequences of what the stages of corpus_pipeline keep; see there for nulls, repeats and empty tables."""
    return importlib.import_module("corpus_pipeline").run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_lm_scoring": op3_lm_scoring,
    "op4_license_scan": op4_license_scan,
    "op5_simhash": op5_simhash,
    "op6_token_files": op6_token_files,
    "op7_quality_rules": op7_quality_rules,
    "op8_sharding": op8_sharding,
    "op9_byte_bpe": op9_byte_bpe,
    "op10_packing": op10_packing,
    "pipeline": pipeline,
}

def _sql_distance(own: str, reference: str) -> str:
    """Jensen-Shannon distance of two lists of counts."""
    share = lambda x: f"list_transform({x}, lambda v: v / nullif(list_sum({x}), 0))"
    terms = f"list_transform(list_zip({share(own)}, {share(reference)}), lambda z: {_js('z[1]', 'z[2]')})"
    return f"CASE WHEN list_sum({own}) > 0 AND list_sum({reference}) > 0 THEN sqrt(greatest(0, list_sum({terms}))) ELSE 0.0::DOUBLE END"


def _js(a: str, b: str) -> str:
    return f"(CASE WHEN {a} > 0 THEN {a} * log2(2 * {a} / ({a} + {b})) ELSE 0 END + CASE WHEN {b} > 0 THEN {b} * log2(2 * {b} / ({a} + {b})) ELSE 0 END) / 2"


def _sql_quality() -> str:
    left = lambda p: f"(length(rest) - length(regexp_replace(rest, '{p}', '', 'g')))::DOUBLE"
    listed = " ".join(f"WHEN '{lang}' THEN [{', '.join(f'{chr(39)}{w}{chr(39)}' for w in words)}]" for lang, words in sorted(COMMON_WORDS.items()))
    NUMBER, SPACES = r"\p{N}+", r"[\x09-\x0D\x20]+"  # noqa: N806
    marks = "[.,;:!?''\"()\\-]+"
    n_common = 1 + max(map(len, COMMON_WORDS.values()))
    return rf"""
    WITH t AS (SELECT doc_id, coalesce(text, '') AS t, CASE WHEN lang IN ({', '.join(f"'{x}'" for x in sorted(COMMON_WORDS))}) THEN lang ELSE '{OTHER}' END AS ref, row_number() OVER () AS row FROM documents),
    w AS (SELECT *, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls, regexp_replace(t, '\p{{L}}+', '', 'g') AS rest FROM t),
    g AS (SELECT row, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c FROM (SELECT row, w, unnest(range(1, len(w) - 1)) AS i FROM w WHERE len(w) >= 3)),
    r AS (SELECT row, count(DISTINCT p) AS n_repeat_words FROM (SELECT row, unnest([i, i + 1, i + 2]) AS p FROM (SELECT row, i, count(*) OVER (PARTITION BY row, a, b, c) AS k FROM g) WHERE k > 1) GROUP BY row),
    m AS (SELECT row, doc_id, ref, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars, (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
                 (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, length(t) AS n_chars, [(length(t) - length(rest))::DOUBLE, {left(NUMBER)}, {left(SPACES)}, {left(marks)}] AS four, length(rest) AS n_rest,
                 CASE ref {listed} END AS names, list_transform(w, lambda x: lower(x)) AS low FROM w),
    h AS (SELECT *, list_concat(four, [n_rest - four[2] - four[3] - four[4]]) AS classes, list_transform(names, lambda x: len(list_filter(low, lambda y: y = x))::DOUBLE) AS found FROM m),
    c AS (SELECT *, CASE WHEN found IS NOT NULL THEN list_concat(found, [greatest(0.0::DOUBLE, n_words - list_sum(found))]) END AS common FROM h),
    f AS (SELECT ref, [{', '.join(f'sum(classes[{k}])' for k in range(1, 6))}] AS ref_classes, [{', '.join(f'sum(common[{k}])' for k in range(1, n_common + 1))}] AS ref_common FROM c GROUP BY ref),
    d AS (SELECT c.*, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, CASE WHEN n_chars >= {MIN_CHARS_FOR_CLASSES} THEN {_sql_distance('classes', 'ref_classes')} END AS class_distance,
                 CASE WHEN common IS NOT NULL AND n_words >= {MIN_WORDS_FOR_COMMON} THEN {_sql_distance('common', 'ref_common')} END AS word_distance FROM c JOIN f USING (ref) LEFT JOIN r USING (row)),
    b AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED_PERCENT} * n_words AS base_failed FROM d)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, round(class_distance, 6) AS class_distance, round(word_distance, 6) AS word_distance,
           NOT (base_failed OR coalesce(class_distance, 0) > {MAX_CLASS_DISTANCE}::DOUBLE OR coalesce(word_distance, 0) > {MAX_WORD_DISTANCE}::DOUBLE) AS kept FROM b
    """


#: crc32 by its table of 256 entries, which SQL computes from the polynomial.
_SQL_CRC32 = """
    crc AS (SELECT list(t ORDER BY n) AS tab FROM (SELECT n, list_reduce(list_concat([n], range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS t FROM range(256) r(n)))
"""
_SQL_CRC32_OF = "xor(list_reduce(list_concat([4294967295], list_transform(regexp_extract_all(hex(encode({t})), '..'), lambda x: ('0x' || x)::BIGINT)), lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295)"

#: DuckDB SQL for the queries that it can express. The others need hashes, models or
#: tokenizers that SQL lacks and are tested against brute force.
ORACLE_SQL = {
    "op2_exact_dedup": """
        SELECT doc_id,
               max(doc_id) OVER same AS keep_id,
               count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept,
               sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
    """,
    "op7_quality_rules": _sql_quality(),
    "op8_sharding": f"""
        WITH {_SQL_CRC32},
        k AS (SELECT doc_id, source, CASE WHEN source IS NULL THEN '0' ELSE '1' || source END AS stratum, (strlen(coalesce(text, '')) + 1)::BIGINT AS size, {_SQL_CRC32_OF.format(t="coalesce(text, '')")} AS text_crc32,
                     md5('{SEED}:' || coalesce(doc_id::VARCHAR, '')) AS mix FROM documents, crc),
        f AS (SELECT *, (row_number() OVER (PARTITION BY stratum ORDER BY mix, doc_id, text_crc32, size) - 1 + 0.5::DOUBLE) / count(*) OVER (PARTITION BY stratum) AS frac FROM k),
        p AS (SELECT *, row_number() OVER (ORDER BY frac, mix, doc_id, text_crc32, size, stratum) - 1 AS position, count(*) OVER () AS total FROM f),
        s AS (SELECT *, (position * 8) // total AS shard FROM p)
        SELECT doc_id, size, text_crc32, 'rows' AS law, shard::INT AS shard, (position - (shard * total + 7) // 8)::BIGINT AS slot, NULL::INT AS grown_shard, source FROM s
    """,
}
