"""Queries on tables of topics: names, categories, and which topic each document has.

The sources of documents stand in for topics, and the ten words of each by class-based
TF-IDF for their keywords.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loamwork.functions import text as T
from loamwork.plans import sql as S
from loamwork.plans.documents import table, topic_keywords
from loamwork.plans.registry import register, sql_of
from loamwork.session import materialise

# Words of keywords, in order, and the names that the first hit gives a topic.
READABLE = {
    "energy_emission_reduce": "Energy Efficiency & Emissions Reduction",
    "waste_total_category": "Waste Management & Recycling",
    "water_withdrawal_consumption": "Water Management & Conservation",
    "emission_water_initiative": "Environmental Sustainability Initiatives",
    "plastic_sustainable_source": "Sustainable Materials & Plastic Management",
    "hazard_safety_work": "Occupational Health & Safety",
    "student_school_child": "Education & Community Development",
    "wage_pay_human_right": "Wages & Human Rights",
    "talent_woman_diversity": "Talent Management & Diversity",
    "able_worker_permanent": "Workforce Inclusion & Disability",
    "risk_opportunity_implication": "Risk & Opportunity Management",
    "assurance_perform_engagement": "External Assurance & Verification",
    "appointment_regulation_appoint": "Regulatory Compliance & Appointments",
    "datum_privacy_cyber": "Data Privacy & Cyber Security",
    "stakeholder_identify_key": "Stakeholder Identification & Engagement",
    "complaint_pende_close": "Complaint Handling & Grievance Resolution",
    "grievance_mechanism_brief": "Grievance Redressal Mechanisms",
    "diligence_human_right": "Human Rights Due Diligence",
    "export_contribution_percentage": "Export Operations & Markets",
    "sell_entity_business": "Business Activities & Revenue",
    "procurement_vulnerable_marginalize": "Preferential Procurement & Social Inclusion",
    "input_grievance_community": "Community Engagement & Input Sourcing",
    "vehicle_tyre_market": "Automotive & Chemical Markets",
    "treatment_level_specify": "Wastewater Treatment & Discharge",
    "joint_venture_associate": "Joint Ventures & Subsidiaries",
    "asset_liability_recognise": "Financial Assets & Liabilities",
}
OUTLIER = "Outlier"


def title_case(t: Column) -> Column:
    """Every run of letters begins in upper case and goes on in lower case, also after digits."""
    pieces = F.regexp_extract_all(t, F.lit(r"(\p{L}+|[^\p{L}]+)"), 1)
    return F.array_join(F.transform(pieces, lambda p: F.concat(F.upper(F.substring(p, 1, 1)), F.lower(F.substring(p, 2, 1 << 20)))), "")


def keywords_of(csv: Column) -> Column:
    """Keywords in an array, of a text with commas between."""
    return F.transform(F.split(csv, ",", -1), lambda w: F.trim(w))


def readable_name(topic: Column, csv: Column) -> Column:
    """A topic's name: by the first entry with a word that its first five keywords hold, else by its first plain keywords, else by its number."""
    words = keywords_of(F.lower(csv))
    five = F.array_join(F.slice(words, 1, 5), " ")
    plain = F.filter(F.transform(F.slice(words, 1, 3), lambda w: F.trim(F.replace(w, F.lit("_"), F.lit(" ")))), lambda w: w.rlike(r"^[a-z\s]+$") & (F.length(w) >= 3))
    own = F.when(F.size(plain) > 0, F.array_join(F.slice(F.transform(plain, title_case), 1, 2), " & ")).otherwise(F.concat(F.lit("Topic "), topic.cast("string")))

    def named(v: Column) -> Column:
        return reduce(lambda c, kv: c.when(T.contains_any(v, kv[0].split("_")), F.lit(kv[1])), READABLE.items(), F.when(F.lit(False), F.lit(""))).otherwise(own)

    return T.let(five, named)


def title_label(words: Column) -> Column:
    """The first three keywords in title case, with '&' between."""
    return F.array_join(F.transform(F.slice(words, 1, 3), lambda w: title_case(F.replace(w, F.lit("_"), F.lit(" ")))), " & ")


def numbered_name(topic: Column, words: Column) -> Column:
    """The topic's number and first three keywords, with underscores between."""
    return F.array_join(F.concat(F.array(topic.cast("string")), F.slice(words, 1, 3)), "_")


def shortened(t: Column, n: int = 100) -> Column:
    """The first ``n`` characters, and dots in any case."""
    return F.concat(F.substring(t, 1, n), F.lit("..."))


#: Keywords that the test texts lack, by topic modulo their number.
_FIRST = ["energy, co2e_saved, ", "health, worker_wages, ", "", "board, audit, ", "x9, 7y, z_, "]

_SQL_TOPICS = f"""
    kw AS (SELECT topic, string_agg(word, ', ' ORDER BY place) AS w FROM ({sql_of("topic_keywords")}) GROUP BY topic),
    tc AS (SELECT source AS topic, count(*) AS "Count" FROM documents GROUP BY source),
    tp AS (SELECT (row_number() OVER (ORDER BY topic) - 1)::BIGINT AS "Topic", topic AS source, "Count", w FROM kw JOIN tc USING (topic)),
    tk AS (SELECT "Topic", source, "Count", [{', '.join(map(S.quoted, _FIRST))}]["Topic" % {len(_FIRST)} + 1] || w AS k FROM tp)
"""


def _topics(spark, sf_dir) -> DataFrame:
    """Topic, source, Count and k (keywords as text) of each topic; there are as many as sources, which are few."""
    words = topic_keywords(spark, sf_dir).groupBy("topic").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "word"))), lambda x: x["word"]), ", ").alias("w"))
    sizes = table(spark, sf_dir, "documents").groupBy(F.col("source").alias("topic")).agg(F.count("*").alias("Count"))
    numbered = words.join(sizes, "topic").withColumn("Topic_", (F.row_number().over(Window.orderBy("topic")) - 1).cast("long"))
    first = F.element_at(F.array(*map(F.lit, _FIRST)), (F.col("Topic_") % len(_FIRST) + 1).cast("int"))
    return numbered.select(F.col("Topic_").alias("Topic"), F.col("topic").alias("source"), "Count", F.concat(first, "w").alias("k"))


def _sql_title(t: str) -> str:
    return f"array_to_string(list_transform(regexp_extract_all({t}, '\\p{{L}}+|[^\\p{{L}}]+'), lambda p: upper(p[1]) || lower(p[2:])), '')"


_SQL_READABLE = (
    "CASE " + " ".join(f"WHEN {S.contains_any('five', k.split('_'))} THEN {S.quoted(v)}" for k, v in READABLE.items())
    + f" WHEN len(plain) > 0 THEN array_to_string(list_transform(plain, lambda w: {_sql_title('w')})[1:2], ' & ') ELSE 'Topic ' || \"Topic\" END"
)


@register(
    "topic_names",
    f"""
    WITH {_SQL_TOPICS}, a AS (SELECT *, list_transform(string_split(k, ','), lambda x: trim(x)) AS ws FROM tk),
    f AS (SELECT *, lower(array_to_string(ws[1:5], ' ')) AS five, list_filter(list_transform(ws[1:3], lambda w: trim(replace(lower(w), '_', ' '))), lambda w: regexp_matches(w, '^[a-z\\s]+$') AND length(w) >= 3) AS plain FROM a)
    SELECT "Topic", "Count", {_SQL_READABLE} AS "Readable_Name", "Topic" || '_' || array_to_string(ws[1:3], '_') AS "Name", k AS "Top_Keywords",
           array_to_string(list_transform(ws[1:3], lambda w: {_sql_title("replace(w, '_', ' ')")}), ' & ') AS "Label", {S.category_by_hits('k')} AS "ESG_Category", {S.category_by_order('k')} AS "Category", k[1:80] || '...' AS "Preview" FROM f
    """,
)
def topic_names(spark, sf_dir):
    """Names, labels and categories of topics by their keywords."""
    t = _topics(spark, sf_dir).withColumn("ws", keywords_of(F.col("k")))
    return t.select(
        "Topic", "Count", readable_name(F.col("Topic"), F.col("k")).alias("Readable_Name"), numbered_name(F.col("Topic"), F.col("ws")).alias("Name"), F.col("k").alias("Top_Keywords"),
        title_label(F.col("ws")).alias("Label"), T.category_by_hits(F.col("k")).alias("ESG_Category"), T.category_by_order(F.col("k")).alias("Category"), shortened(F.col("k"), 80).alias("Preview"),
    )


@register(
    "category_totals",
    f"""
    WITH {_SQL_TOPICS}, c AS (SELECT *, {S.category_by_hits('k')} AS category FROM tk)
    SELECT category AS "ESG_Category", sum("Count")::BIGINT AS "Count", count(*) AS topics FROM c GROUP BY category
    """,
)
def category_totals(spark, sf_dir):
    """Documents and topics of each category."""
    named = _topics(spark, sf_dir).select("Count", T.category_by_hits(F.col("k")).alias("ESG_Category"))
    return named.groupBy("ESG_Category").agg(F.sum("Count").alias("Count"), F.count("*").alias("topics"))


@register(
    "keyword_weights",
    f"""
    WITH {_SQL_TOPICS}, a AS (SELECT "Topic", list_transform(string_split(k, ','), lambda x: trim(x)) AS ws FROM tk), u AS (SELECT "Topic", len(ws) AS n, unnest(range(1, len(ws) + 1)) AS i, unnest(ws) AS word FROM a)
    SELECT "Topic", word, i::BIGINT AS place, (n - i + 1)::BIGINT AS weight FROM u
    """,
)
def keyword_weights(spark, sf_dir):
    """Keywords of each topic as rows, weighted by their place from the end, for charts."""
    split = _topics(spark, sf_dir).select("Topic", keywords_of(F.col("k")).alias("ws"))
    rows = split.select("Topic", F.size("ws").alias("n"), F.posexplode("ws").alias("i", "word"))
    return rows.select("Topic", "word", (F.col("i") + 1).cast("long").alias("place"), (F.col("n") - F.col("i")).cast("long").alias("weight"))


def with_topic_names(docs: DataFrame, topics: DataFrame, missing: str = OUTLIER) -> DataFrame:
    """Documents (Topic, ...) with Topic_Name and Topic_Count of their topics (Topic, Name, Count), ``missing`` and null for those of none. Topics are few, but are broadcast only if Spark finds them small."""
    named = topics.select("Topic", F.col("Name").alias("Topic_Name"), F.col("Count").alias("Topic_Count"))
    return docs.join(named, "Topic", "left").withColumn("Topic_Name", F.coalesce("Topic_Name", F.lit(missing)))


@register(
    "document_topics",
    f"""
    WITH {_SQL_TOPICS}, n AS (SELECT *, "Topic" || '_' || array_to_string(list_transform(string_split(k, ','), lambda x: trim(x))[1:3], '_') AS "Name" FROM tk),
    d AS (SELECT doc_id, CASE WHEN length(text) < 300 THEN -1 ELSE "Topic" END AS "Topic", text[1:100] || '...' AS raw_preview FROM documents LEFT JOIN tp USING (source))
    SELECT doc_id, d."Topic", raw_preview, coalesce("Name", 'Outlier') AS "Topic_Name", "Count" AS "Topic_Count" FROM d LEFT JOIN n USING ("Topic")
    """,
)
def document_topics(spark, sf_dir):
    """The topic of each document with its name and size; short texts have none."""
    topics = _topics(spark, sf_dir).withColumn("Name", numbered_name(F.col("Topic"), keywords_of(F.col("k"))))
    topics = materialise(topics, "topics")
    docs = table(spark, sf_dir, "documents").join(topics.select("source", F.col("Topic").alias("t")), "source", "left")
    marked = docs.select("doc_id", F.when(F.length("text") < 300, F.lit(-1).cast("long")).otherwise(F.col("t")).alias("Topic"), shortened(F.col("text")).alias("raw_preview"))
    return with_topic_names(marked, topics).select("doc_id", "Topic", "raw_preview", "Topic_Name", "Topic_Count")


@register(
    "distinct_sets",
    "SELECT lang, array_to_string(list_sort(list_distinct(list(source))), ',') AS topics, count(DISTINCT source) AS n FROM documents GROUP BY lang",
)
def distinct_sets(spark, sf_dir):
    """The topics of each language, sorted. Topics are few."""
    return table(spark, sf_dir, "documents").groupBy("lang").agg(F.array_join(F.array_sort(F.collect_set("source")), ",").alias("topics"), F.countDistinct("source").alias("n"))


@register(
    "document_sizes",
    "SELECT (SELECT round(avg(length(text)), 4) FROM documents) AS mean, doc_id, length(text) AS chars FROM documents QUALIFY row_number() OVER (ORDER BY length(text) DESC, doc_id) <= 10",
)
def document_sizes(spark, sf_dir):
    """The ten longest documents, beside the mean length of all."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.length("text").cast("long").alias("chars"))
    mean = docs.agg(F.round(F.avg("chars"), 4).alias("mean"))
    return docs.orderBy(F.desc("chars"), "doc_id").limit(10).crossJoin(F.broadcast(mean))


def ordered_candidates(results: DataFrame, most: int = 5) -> DataFrame:
    """The best ``most`` search results (query, place, score) of each query in the order to try them: by score, then as they were found."""
    best = Window.partitionBy("query").orderBy(F.desc("score"), "place")
    return results.withColumn("try", F.row_number().over(best).cast("long")).filter(F.col("try") <= most)


@register(
    "result_order",
    """SELECT user_id AS query, event_id AS place, value::BIGINT AS score, row_number() OVER (PARTITION BY user_id ORDER BY value::BIGINT DESC, event_id) AS "try" FROM (SELECT user_id, event_id, floor(value) AS value FROM events) QUALIFY "try" <= 5""",
)
def result_order(spark, sf_dir):
    """The order in which to try the results of each search."""
    return ordered_candidates(table(spark, sf_dir, "events").select(F.col("user_id").alias("query"), F.col("event_id").alias("place"), F.floor("value").cast("long").alias("score")))


#: Words whose runs alone are counted, at most.
PRUNING_WORDS = 20_000


def term_range_counts(docs: DataFrame, first: int, last: int, least: float, most: float, stop: list[str]) -> DataFrame:
    """(term, df): runs of ``first`` to ``last`` neighbouring words (words: an array) that stand in enough and not too many documents.

    Bounds under 1 are shares of all documents, others numbers; both count. Stop words go
    first. A document's terms are made distinct before they are shuffled.

    A run stands in no more documents than each of its words. So words are counted first,
    and runs with one in too few documents are not made, unless there are too many other
    words (PRUNING_WORDS) to ask for.
    """
    words = docs.select(F.filter("words", lambda w: ~w.isin(stop)).alias("w"))
    n = docs.count()
    low, high = least * n if least < 1 else least, most * n if most < 1 else most

    def counted(terms: Column) -> DataFrame:
        return words.select(F.explode(terms).alias("term")).groupBy("term").agg(F.count("*").alias("df")).filter(F.col("df") >= low)

    def runs(k: int, known: list[str] | None) -> Column:
        at = F.sequence(F.lit(1), F.size("v") - k + 1)
        if known is not None:
            at = F.filter(at, lambda i: F.forall(F.slice("v", i, k), lambda w: w.isNotNull()))
        return F.when(F.size("v") >= k, F.transform(at, lambda i: F.array_join(F.slice("v", i, k), " "))).otherwise(F.array().cast("array<string>"))

    single = materialise(counted(F.array_distinct("w")), "frequent-words")
    known = [r["term"] for r in single.limit(PRUNING_WORDS + 1).collect()] if last > 1 else []
    known = known if len(known) <= PRUNING_WORDS else None
    longer = range(max(2, first), last + 1)
    words = words.withColumn("v", F.col("w") if known is None else F.transform("w", lambda w: F.when(w.isin([*known, ""]), w)))
    parts = ([single] if first == 1 else []) + ([counted(F.array_distinct(F.concat(*(runs(k, known) for k in longer))))] if len(longer) else [])
    return reduce(DataFrame.unionByName, parts).filter(F.col("df") <= high).select("term", "df")


_STOP = ["the", "and", "for", "that"]


@register(
    "term_frequency",
    f"""
    WITH w AS (SELECT doc_id, list_filter(regexp_extract_all(lower(text), '[a-z]{{3,}}'), lambda x: x NOT IN ({', '.join(map(S.quoted, _STOP))})) AS w FROM documents),
    g AS (SELECT doc_id, unnest(list_distinct(list_concat(w, list_concat(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]), list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))))) AS term FROM w)
    SELECT term, count(*) AS df FROM g GROUP BY term HAVING count(*) >= 0.03::DOUBLE * (SELECT count(*) FROM documents) AND count(*) <= 0.5::DOUBLE * (SELECT count(*) FROM documents)
    """,
)
def term_frequency(spark, sf_dir):
    """Terms of one to three words in 3 to 50 percent of the documents."""
    docs = table(spark, sf_dir, "documents").select(F.expr("regexp_extract_all(lower(text), '[a-z]{3,}', 0)").alias("words"))
    return term_range_counts(docs, 1, 3, 0.03, 0.5, _STOP)
