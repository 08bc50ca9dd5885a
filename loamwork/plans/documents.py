"""Queries on documents and pages: statistics, cleaning, headings and topics."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from loamwork.functions import text as T
from loamwork.plans import sql as S
from loamwork.plans.registry import register
from loamwork.session import materialise


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_counts(docs):
    """(topic, word, n) of all words of three letters or more in texts (topic, text), written once for what is built on them."""
    words = docs.select("topic", F.explode(F.expr("regexp_extract_all(lower(text), '[a-z]{3,}', 0)")).alias("word"))
    return materialise(words.groupBy("topic", "word").agg(F.count("*").alias("n")), "topic-words")


def class_scores(counts):
    """(topic, word, n, score): class-based TF-IDF of counted words (topic, word, n)."""
    total = counts.groupBy("word").agg(F.sum("n").alias("total"))
    # one row
    mean = counts.agg((F.sum("n") / F.countDistinct("topic")).alias("mean"))
    return counts.join(total, "word").crossJoin(F.broadcast(mean)).select("topic", "word", "n", F.round(F.col("n") * F.log(1 + F.col("mean") / F.col("total")), 6).alias("score"))


@register(
    "topic_keywords",
    """
    WITH w AS (SELECT source AS topic, unnest(regexp_extract_all(lower(text), '[a-z]{3,}')) AS word FROM documents),
    tf AS (SELECT topic, word, count(*) AS n FROM w GROUP BY ALL),
    f AS (SELECT word, sum(n) AS total FROM tf GROUP BY word),
    a AS (SELECT sum(n) / count(DISTINCT topic) AS mean FROM tf),
    s AS (SELECT topic, word, n, round(n * ln(1 + mean / total), 6) AS score FROM tf JOIN f USING (word), a)
    SELECT topic, word, n AS occurrences, score, row_number() OVER (PARTITION BY topic ORDER BY score DESC, word) AS place
    FROM s QUALIFY place <= 10
    """,
)
def topic_keywords(spark, sf_dir):
    """Ten best words of each topic by class-based TF-IDF."""
    scored = class_scores(word_counts(table(spark, sf_dir, "documents").select(F.col("source").alias("topic"), "text")))
    best = Window.partitionBy("topic").orderBy(F.desc("score"), "word")
    return scored.withColumn("place", F.row_number().over(best)).filter("place <= 10").select("topic", "word", F.col("n").alias("occurrences"), "score", F.col("place").cast("long").alias("place"))


@register(
    "page_statistics",
    f"""
    WITH p AS (SELECT conv_id AS doc_id, turn, length(text) AS raw, length({S.strip('text')}) AS n FROM conversations)
    SELECT doc_id, count(*) AS pages, count(*) FILTER (n = 0) AS empty_pages, count(*) FILTER (n BETWEEN 1 AND 100) AS low_pages,
           count(*) FILTER (n BETWEEN 101 AND 1000) AS medium_pages, count(*) FILTER (n > 1000) AS high_pages,
           round(100.0 * count(*) FILTER (n > 50) / count(*), 4) AS coverage, sum(n)::BIGINT AS chars, round(avg(raw), 4) AS mean_raw,
           min(n) AS least, max(n) AS most, median(CASE WHEN n > 0 THEN n END)::DOUBLE AS middle,
           round(coalesce(stddev_samp(CASE WHEN n > 0 THEN n END), 0), 2) AS deviation,
           coalesce(string_agg(turn::VARCHAR, ',' ORDER BY turn) FILTER (n BETWEEN 1 AND 100), '') AS low_page_numbers
    FROM p GROUP BY doc_id
    """,
)
def page_statistics(spark, sf_dir):
    """Extraction statistics of each report's pages in one aggregation."""
    n = F.length(T.strip(F.col("text")))
    p = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("doc_id"), "turn", F.length("text").alias("raw"), n.cast("long").alias("n"))
    filled = F.when(F.col("n") > 0, F.col("n"))
    return p.groupBy("doc_id").agg(
        F.count("*").alias("pages"), F.count_if(F.col("n") == 0).alias("empty_pages"), F.count_if(F.col("n").between(1, 100)).alias("low_pages"),
        F.count_if(F.col("n").between(101, 1000)).alias("medium_pages"), F.count_if(F.col("n") > 1000).alias("high_pages"),
        F.round(F.count_if(F.col("n") > 50) * 100.0 / F.count("*"), 4).alias("coverage"), F.sum("n").alias("chars"), F.round(F.avg("raw"), 4).alias("mean_raw"),
        F.min("n").alias("least"), F.max("n").alias("most"), F.median(filled).alias("middle"), F.round(F.coalesce(F.stddev_samp(filled), F.lit(0.0)), 2).alias("deviation"),
        F.array_join(F.array_sort(F.collect_list(F.when(F.col("n").between(1, 100), F.col("turn")))), ",").alias("low_page_numbers"),
    )


@register(
    "report_text",
    """
    SELECT conv_id AS doc_id, md5(string_agg(text, chr(10) || chr(10) ORDER BY turn)) AS text_md5,
           md5(string_agg(chr(10) || '--- Page ' || turn || ' ---' || chr(10) || text, chr(10) ORDER BY turn)) AS marked_md5 FROM conversations GROUP BY conv_id
    """,
)
def report_text(spark, sf_dir):
    """The text of each report: its pages in order with blank lines between, and with a mark before each page. A report is one row in the end."""
    pages = table(spark, sf_dir, "conversations").groupBy(F.col("conv_id").alias("doc_id")).agg(F.array_sort(F.collect_list(F.struct("turn", "text"))).alias("pages"))
    marked = F.transform("pages", lambda p: F.concat(F.lit("\n--- Page "), p["turn"].cast("string"), F.lit(" ---\n"), p["text"]))
    return pages.select("doc_id", F.md5(F.array_join(F.transform("pages", lambda p: p["text"]), "\n\n")).alias("text_md5"), F.md5(F.array_join(marked, "\n")).alias("marked_md5"))


@register("english_documents", f"SELECT doc_id, round(ratio, 6) AS ratio FROM (SELECT doc_id, {S.printable_ratio('text')} AS ratio FROM documents) WHERE ratio >= 0.7::DOUBLE")
def english_documents(spark, sf_dir):
    return table(spark, sf_dir, "documents").filter(T.is_mostly_english(F.col("text"))).select("doc_id", F.round(T.printable_ratio(F.col("text")), 6).alias("ratio"))


@register("repaired_text", f"SELECT doc_id, md5({S.fix_split_words(S.fix_mashed_words('text'))}) AS text_md5 FROM documents")
def repaired_text(spark, sf_dir):
    """Mashed and split words of whole texts repaired."""
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(T.fix_split_words(T.fix_mashed_words(F.col("text")))).alias("text_md5"))


@register(
    "topic_roll_up",
    "SELECT lang AS category, source AS topic, count(*) AS documents, grouping(lang, source) AS level FROM documents GROUP BY ROLLUP (lang, source)",
)
def topic_roll_up(spark, sf_dir):
    """Documents in total, by category, and by topic of each category."""
    return table(spark, sf_dir, "documents").rollup(F.col("lang").alias("category"), F.col("source").alias("topic")).agg(F.count("*").alias("documents"), F.grouping_id().alias("level"))


@register(
    "largest_documents",
    "SELECT source, doc_id, n_chars, row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id) AS place FROM documents QUALIFY place <= 10",
)
def largest_documents(spark, sf_dir):
    best = Window.partitionBy("source").orderBy(F.desc("n_chars"), "doc_id")
    return table(spark, sf_dir, "documents").select("source", "doc_id", "n_chars", F.row_number().over(best).cast("long").alias("place")).filter("place <= 10")


@register(
    "document_frequency",
    """
    WITH w AS (SELECT doc_id, unnest(list_distinct(regexp_extract_all(lower(text), '[a-z]{3,}'))) AS word FROM documents)
    SELECT word, count(*) AS df FROM w GROUP BY word HAVING count(*) >= 2 AND count(*) <= 0.95 * (SELECT count(*) FROM documents)
    """,
)
def document_frequency(spark, sf_dir):
    """Words in at least two documents and at most 95 percent of them."""
    docs = table(spark, sf_dir, "documents")
    df = docs.select(F.explode(F.array_distinct(F.expr("regexp_extract_all(lower(text), '[a-z]{3,}', 0)"))).alias("word")).groupBy("word").agg(F.count("*").alias("df"))
    return df.crossJoin(F.broadcast(docs.agg(F.count("*").alias("n")))).filter("df >= 2 AND df <= 0.95 * n").select("word", "df")


@register(
    "page_domains",
    r"SELECT page_id, regexp_replace(regexp_extract(lower(url), '^[a-z]+://([^/:?#]+)', 1), '^www\.', '') AS domain, regexp_matches(lower(url), '\.pdf([?#]|$)') AS is_pdf FROM pages",
)
def page_domains(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", T.domain(F.col("url")).alias("domain"), F.lower("url").rlike(r"\.pdf([?#]|$)").alias("is_pdf"))
