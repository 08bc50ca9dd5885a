"""Queries that assess how well texts were extracted."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from loamwork.functions import text as T
from loamwork.plans import sql as S
from loamwork.plans.documents import table
from loamwork.plans.lines import CONTROL, UNUSUAL
from loamwork.plans.registry import register
from loamwork.session import materialise

# What a disclosure report speaks of, and how many of them make one likely.
INDICATORS = {
    "section_a": r"\bsection\s+a\b", "section_b": r"\bsection\s+b\b", "principle": r"\bprinciple\b", "business_responsibility": r"\bbusiness\s+responsibility\b",
    "sustainability": r"\bsustainability\b", "brsr": r"\bbrsr\b", "ngrbc": r"\bngrbc\b", "general_information": r"\bgeneral\s+information\b", "listed_entity": r"\blisted\s+entity\b",
}
LIKELY = 5
RATINGS = [(90, "excellent"), (75, "good"), (60, "fair"), (40, "poor")]
_ODD = r"[^\p{L}\p{N}_.,;:!?()\[\]{}\"'\-" + T.SPACE[1:]

#: The same; letters and spaces are passed over before the class is asked.
_ODD_JAVA = rf"[\x00-\x1F\x21-\x40\x5B-\x60\x{{7B}}-\x{{10FFFF}}&&{_ODD}]"

_FRONT = ["", "Section A: general information. The principle of business responsibility and sustainability. BRSR. ", "\x01— ### @@@ %%% ", "bcd fgh jklm npqr stv wxz " * 40, "A. B. C. D. E. F. G. H. I. J. K. L. "]


def jumble(t: Column) -> Column:
    """Shares behind the signs of a jumbled text: odd, single, no_vowel and mixed, each null where it is not judged."""
    words = T.words(t)

    def of(w: Column) -> Column:
        n, alpha = F.size(w), lambda x: x.rlike(r"^\p{L}+$")
        share = lambda test: F.size(F.filter(w, test)) / n
        plain = lambda x: x.rlike(r"(?s)^(?:\P{Ll}*\p{Lu}\P{Ll}*|\P{Lu}*\p{Ll}\P{Lu}*|\p{Lu}\p{Ll}+)\z")
        return F.struct(
            F.when(F.length(t) > 0, (F.length(t) - F.length(F.regexp_replace(t, _ODD_JAVA, ""))) / F.length(t)).alias("odd"),
            F.when(n > 100, share(lambda x: (F.length(x) == 1) & alpha(x))).alias("single"),
            F.when(n > 0, share(lambda x: (F.length(x) > 2) & ~x.rlike("[aeiouAEIOU]") & alpha(x))).alias("no_vowel"),
            F.when((F.length(t) > 100) & (n > 0), share(lambda x: (F.length(x) > 3) & ~plain(x) & alpha(x))).alias("mixed"),
        )

    return T.let(words, of)


def coherence(t: Column) -> Column:
    """n_words, n_sentences, mean lengths of sentences, words and paragraphs, and the shares of very short and very long sentences."""
    sentences = F.filter(F.transform(F.split(t, "[.!?]+", -1), T.strip), lambda x: x != "")
    paragraphs = F.transform(F.split(t, "\n\n", -1), lambda p: F.size(T.words(p)))
    total = lambda x: F.aggregate(x, F.lit(0).cast("long"), lambda a, v: a + v)

    def of(v: Column) -> Column:
        w, s, p, sizes = v["w"], v["s"], v["p"], v["z"]
        share = lambda test: F.when(F.size(s) > 0, F.size(F.filter(sizes, test)) / F.size(s)).otherwise(F.lit(0.0))
        return F.struct(
            F.size(w).cast("long").alias("n_words"), F.size(s).cast("long").alias("n_sentences"),
            F.when(F.size(s) > 0, F.size(w) / F.size(s)).otherwise(F.lit(0.0)).alias("words_a_sentence"),
            F.when(F.size(w) > 0, total(F.transform(w, F.length)) / F.size(w)).otherwise(F.lit(0.0)).alias("word_length"),
            (total(p) / F.size(p)).alias("words_a_paragraph"), share(lambda n: n < 3).alias("short"), share(lambda n: n > 50).alias("long"),
        )

    sized = lambda s: F.struct(T.words(t).alias("w"), s.alias("s"), paragraphs.alias("p"), F.transform(s, lambda x: F.size(T.words(x))).alias("z"))
    return T.let(T.let(sentences, sized), of)


def indicators(t: Column) -> Column:
    """A map from each indicator to whether the text has it; its first word is looked for before the pattern."""
    word = {k: re.search("[a-z]+", p.removeprefix(r"\b"))[0] for k, p in INDICATORS.items()}
    return T.let(F.lower(t), lambda low: F.create_map(*(x for k, p in INDICATORS.items() for x in (F.lit(k), low.contains(word[k]) & low.rlike(p)))))


def rating(score: Column) -> Column:
    return reduce(lambda c, r: c.when(score >= r[0], F.lit(r[1])), RATINGS, F.when(F.lit(False), F.lit(""))).otherwise("very_poor")


def assessed(docs):
    """doc_id, jumbled, bad_encoding, n_indicators, coherence_issues, quality_score and quality_rating of texts (doc_id, text), row by row."""
    t = F.col("text")
    read = docs.select("doc_id", jumble(t).alias("j"), coherence(t).alias("c"), F.map_values(indicators(t)).alias("i"), (t.rlike(CONTROL) | t.contains("�") | t.rlike(UNUSUAL)).alias("bad_encoding"))
    over = lambda c, x: F.coalesce(F.col(c) > x, F.lit(False))
    jumbled = over("j.odd", 0.1) | over("j.single", 0.15) | over("j.no_vowel", 0.05) | over("j.mixed", 0.3)
    found = read.select(
        "doc_id", jumbled.alias("jumbled"), "bad_encoding", F.size(F.filter("i", lambda x: x)).cast("long").alias("n_indicators"),
        (over("c.short", 0.3).cast("long") + over("c.long", 0.2).cast("long")).alias("coherence_issues"),
    )
    less = lambda c, n: F.when(c, n).otherwise(0)
    score = F.lit(100) - less(F.col("jumbled"), 20) - less(F.col("bad_encoding"), 15) - less(F.col("n_indicators") < LIKELY, 10) - F.col("coherence_issues") * 10
    scored = found.withColumn("quality_score", F.greatest(F.lit(0), F.least(F.lit(100), score)).cast("long"))
    return scored.withColumn("quality_rating", rating(F.col("quality_score")))


def _docs(spark, sf_dir):
    front = F.element_at(F.array(*map(F.lit, _FRONT)), (F.col("doc_id") % len(_FRONT) + 1).cast("int"))
    return table(spark, sf_dir, "documents").select("doc_id", F.concat(front, "text").alias("text"))


_SQL_DOCS = "d AS (SELECT doc_id, [" + ", ".join("chr(1) || '" + x[1:] + "'" if x[:1] == "\x01" else S.quoted(x) for x in _FRONT) + f"][doc_id % {len(_FRONT)} + 1] || text AS t FROM documents)"
_SQL_JUMBLE = f"""
    w AS (SELECT doc_id, t, {S.words('t')} AS w FROM d),
    j AS (SELECT doc_id, t, w, CASE WHEN length(t) > 0 THEN (length(t) - length({S.replaced('t', _ODD, '')}))::DOUBLE / length(t) END AS odd,
                 CASE WHEN len(w) > 100 THEN len(list_filter(w, lambda x: length(x) = 1 AND {S.matches('x', '^\\p{L}+$')}))::DOUBLE / len(w) END AS single,
                 CASE WHEN len(w) > 0 THEN len(list_filter(w, lambda x: length(x) > 2 AND {S.matches('x', '^\\p{L}+$')} AND NOT {S.matches('x', '[aeiouAEIOU]')}))::DOUBLE / len(w) END AS no_vowel,
                 CASE WHEN len(w) > 0 AND length(t) > 100 THEN len(list_filter(w, lambda x: length(x) > 3 AND {S.matches('x', '^\\p{L}+$')} AND NOT (({S.matches('x', '\\p{Lu}')} AND NOT {S.matches('x', '\\p{Ll}')})
                      OR ({S.matches('x', '\\p{Ll}')} AND NOT {S.matches('x', '\\p{Lu}')}) OR {S.matches('x', '^\\p{Lu}\\p{Ll}+$')})))::DOUBLE / len(w) END AS mixed FROM w)
"""
_SQL_COHERENCE = f"""
    s AS (SELECT doc_id, t, w, list_filter(list_transform(regexp_split_to_array(t, '[.!?]+'), lambda x: {S.strip('x')}), lambda x: x <> '') AS s, list_transform(string_split(t, chr(10) || chr(10)), lambda p: len({S.words('p')})) AS p FROM j),
    z AS (SELECT *, list_transform(s, lambda x: len({S.words('x')})) AS z FROM s),
    c AS (SELECT doc_id, len(w) AS n_words, len(s) AS n_sentences, CASE WHEN len(s) > 0 THEN len(w)::DOUBLE / len(s) ELSE 0.0::DOUBLE END AS words_a_sentence,
                 CASE WHEN len(w) > 0 THEN list_sum(list_transform(w, lambda x: length(x)))::DOUBLE / len(w) ELSE 0.0::DOUBLE END AS word_length, list_sum(p)::DOUBLE / len(p) AS words_a_paragraph,
                 CASE WHEN len(s) > 0 THEN len(list_filter(z, lambda n: n < 3))::DOUBLE / len(s) ELSE 0.0::DOUBLE END AS short, CASE WHEN len(s) > 0 THEN len(list_filter(z, lambda n: n > 50))::DOUBLE / len(s) ELSE 0.0::DOUBLE END AS long FROM z)
"""
_ROUNDED = ["odd", "single", "no_vowel", "mixed"], ["words_a_sentence", "word_length", "words_a_paragraph", "short", "long"]


@register(
    "text_coherence",
    f"WITH {_SQL_DOCS}, {_SQL_JUMBLE}, {_SQL_COHERENCE} SELECT c.doc_id, n_words, n_sentences, {', '.join(f'round({c}, 6) AS {c}' for part in _ROUNDED for c in part)} FROM c JOIN j USING (doc_id)",
)
def text_coherence(spark, sf_dir):
    """Measures of how jumbled and how coherent each text is; text is put before some."""
    t = F.col("text")
    read = _docs(spark, sf_dir).select("doc_id", jumble(t).alias("j"), coherence(t).alias("c"))
    return read.select("doc_id", "c.n_words", "c.n_sentences", *(F.round(F.col(f"{p}.{c}"), 6).alias(c) for p, part in zip("jc", _ROUNDED, strict=True) for c in part))


_SQL_ASSESSED = f"""
    {_SQL_DOCS}, {_SQL_JUMBLE}, {_SQL_COHERENCE},
    a AS (SELECT doc_id, coalesce(odd > 0.1::DOUBLE, false) OR coalesce(single > 0.15::DOUBLE, false) OR coalesce(no_vowel > 0.05::DOUBLE, false) OR coalesce(mixed > 0.3::DOUBLE, false) AS jumbled,
                 {S.matches('t', CONTROL)} OR contains(t, chr(65533)) OR {S.matches('t', UNUSUAL)} AS bad_encoding, {' + '.join(f"{S.matches('lower(t)', p)}::BIGINT" for p in INDICATORS.values())} AS n_indicators,
                 (short > 0.3::DOUBLE)::BIGINT + (long > 0.2::DOUBLE)::BIGINT AS coherence_issues FROM j JOIN c USING (doc_id)),
    q AS (SELECT *, greatest(0, least(100, 100 - CASE WHEN jumbled THEN 20 ELSE 0 END - CASE WHEN bad_encoding THEN 15 ELSE 0 END - CASE WHEN n_indicators < {LIKELY} THEN 10 ELSE 0 END - 10 * coherence_issues))::BIGINT AS quality_score FROM a),
    r AS (SELECT *, CASE {' '.join(f"WHEN quality_score >= {n} THEN '{x}'" for n, x in RATINGS)} ELSE 'very_poor' END AS quality_rating FROM q)
"""


@register("quality_assessed", f"WITH {_SQL_ASSESSED} SELECT * FROM r")
def quality_assessed(spark, sf_dir):
    """Quality score of each text: 100 less 20 if jumbled, 15 for bad characters, 10 without enough indicators and 10 for each sign of incoherence."""
    return assessed(_docs(spark, sf_dir))


@register("quality_histogram", f"WITH {_SQL_ASSESSED} SELECT quality_rating, count(*) AS n, round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM r), 4) AS percent, round(avg(quality_score), 4) AS mean FROM r GROUP BY quality_rating")
def quality_histogram(spark, sf_dir):
    """How many texts have each rating, and their mean score; one row for each rating that occurs."""
    # a row for each rating; it is read twice, and texts must not be
    counted = materialise(assessed(_docs(spark, sf_dir)).groupBy("quality_rating").agg(F.count("*").alias("n"), F.sum("quality_score").alias("s")), "ratings")
    whole = counted.agg(F.sum("n").alias("all"))
    return counted.crossJoin(F.broadcast(whole)).select("quality_rating", "n", F.round(F.col("n") * 100.0 / F.col("all"), 4).alias("percent"), F.round(F.col("s") / F.col("n"), 4).alias("mean"))


@register(
    "indicators_found",
    f"WITH {_SQL_DOCS} SELECT doc_id, {', '.join(f'{S.matches('lower(t)', p)} AS {k}' for k, p in INDICATORS.items())}, {' + '.join(f'{S.matches('lower(t)', p)}::INT' for p in INDICATORS.values())} >= {LIKELY} AS is_likely FROM d",
)
def indicators_found(spark, sf_dir):
    """Which indicators of a disclosure report each text has."""
    read = _docs(spark, sf_dir).select("doc_id", indicators(F.col("text")).alias("i"))
    return read.select("doc_id", *(F.col("i")[k].alias(k) for k in INDICATORS), (F.size(F.filter(F.map_values("i"), lambda x: x)) >= LIKELY).alias("is_likely"))


def extraction_rating(with_content: Column, empty: Column, pages: Column) -> Column:
    """How complete an extraction is, by pages with content and empty pages."""
    complete = F.when(pages > 0, with_content * 100.0 / pages).otherwise(F.lit(0.0))
    return F.when((complete >= 95) & (empty <= pages * 0.05), "excellent").when((complete >= 80) & (empty <= pages * 0.1), "good").when(complete >= 60, "fair").otherwise("poor")


@register(
    "extraction_ratings",
    f"""
    WITH p AS (SELECT conv_id AS doc_id, length({S.strip('text')}) - CASE WHEN conv_id % 3 = 0 AND turn = 0 THEN 100000 WHEN conv_id % 4 = 1 AND turn < 3 THEN 100000 ELSE 0 END AS n FROM conversations),
    c AS (SELECT doc_id, count(*) AS pages, count(*) FILTER (n > 50) AS with_content, count(*) FILTER (n <= 0) AS empty_pages FROM p GROUP BY doc_id)
    SELECT doc_id, pages, with_content, empty_pages, CASE WHEN with_content * 100.0::DOUBLE / pages >= 95 AND empty_pages <= pages * 0.05::DOUBLE THEN 'excellent' WHEN with_content * 100.0::DOUBLE / pages >= 80 AND empty_pages <= pages * 0.1::DOUBLE THEN 'good'
           WHEN with_content * 100.0::DOUBLE / pages >= 60 THEN 'fair' ELSE 'poor' END AS rating FROM c
    """,
)
def extraction_ratings(spark, sf_dir):
    """Ratings of reports by their pages; some pages are taken to be empty."""
    k, turn = F.col("conv_id"), F.col("turn")
    gone = F.when((k % 3 == 0) & (turn == 0), 100000).when((k % 4 == 1) & (turn < 3), 100000).otherwise(0)
    pages = table(spark, sf_dir, "conversations").select(k.alias("doc_id"), (F.length(T.strip(F.col("text"))) - gone).alias("n"))
    counted = pages.groupBy("doc_id").agg(F.count("*").alias("pages"), F.count_if(F.col("n") > 50).alias("with_content"), F.count_if(F.col("n") <= 0).alias("empty_pages"))
    return counted.select("*", extraction_rating(F.col("with_content"), F.col("empty_pages"), F.col("pages")).alias("rating"))
