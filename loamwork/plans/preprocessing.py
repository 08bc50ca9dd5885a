"""Queries that prepare texts for topic models: cleaning, filters on words, and the text of nested reports.

A tagger of word classes, names of persons and places, and base forms is a parameter (a
Column function on an array of words). The default has none of the first two and takes
plural endings off; which words of a text are nouns it does not know.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loamwork.functions import text as T
from loamwork.operators.dealing import filtered
from loamwork.plans import sql as S
from loamwork.plans.documents import table
from loamwork.plans.registry import register

# Words of reports that say nothing, words that always stay, and more words that say nothing.
EXCLUDED = ["company", "limited", "ltd", "incorporated", "subsidiary", "group", "report", "financial", "year", "fiscal", "ended", "march", "date", "page", "table", "figure"]
KEPT = ["gigajoule", "tco2e", "kilolitre", "biodiversity", "paternity", "maternity", "grievance", "fiduciary", "vigil", "committee"]
EXTRA = [
    "ltd", "limited", "private", "plc", "corp", "corporation", "inc", "incorporated", "subsidiary", "subsidiaries", "group", "holding", "holdings", "company", "companies",
    "report", "annual", "financial", "statement", "fiscal", "year", "ended", "march", "date", "page", "table", "figure", "section", "annexure", "appendix",
    "board", "directors", "director", "committee", "chairman", "managing", "executive", "shareholder", "shareholders", "meeting", "equity", "shares",
    "mr", "mrs", "ms", "dr", "shri", "smt",
]
ACRONYMS = ["ESG", "GHG", "CO2", "CSR", "SDG", "UN", "NGO", "BRSR", "TCFD", "CDP"]

# Common English words, where no other list is given.
STOP_WORDS = [
    "a", "an", "the", "and", "or", "but", "if", "because", "as", "what", "when", "where", "how", "who", "which", "this", "that", "these", "those", "it", "its", "they", "them", "their",
    "we", "us", "our", "you", "your", "he", "him", "his", "she", "her", "i", "me", "my", "mine", "in", "on", "at", "to", "for", "of", "with", "by", "from", "up", "down",
    "is", "are", "was", "were", "be", "been", "being", "have", "has", "had", "not", "no", "nor", "only", "own", "same", "so", "than", "too", "very",
]

# Words read backwards that a reversed text holds, and what they are; and units that stay without their number.
BACKWARDS = {"htiw": "with", "ruo": "our", "srekrow": "workers", "seeyolpme": "employees", "eht": "the"}
UNITS = "tonnes?|kg|percent|%|MW|GW|kWh|litres?"

#: A character of a word.
_PART = T.WORD.removesuffix("+")

#: A document has at least so many words left, and a model so many documents.
LEAST_WORDS, LEAST_DOCUMENTS = 5, 10


def stop_words(extra: Iterable[str] = EXCLUDED) -> list[str]:
    """Common English words and those of reports, each once, sorted."""
    return sorted({*STOP_WORDS, *extra})


def reversed_back(t: Column) -> Column:
    """The whole text reversed if more of the marks of reversed texts stand in it than of others."""
    hits = lambda low, ws: reduce(lambda a, b: a + b, (low.contains(w).cast("int") for w in ws))
    return F.when(T.let(F.lower(t), lambda low: hits(low, BACKWARDS) > hits(low, BACKWARDS.values())), F.reverse(t)).otherwise(t)


def strictly_cleaned(t: Column, backwards: bool = True, units: bool = False) -> Column:
    """ASCII text without years, fiscal years, addresses and links, in single spaces; the right way round, and units without numbers, if asked for."""
    if backwards:
        t = F.regexp_replace(reversed_back(t), r"[^\x00-\x7F]", "")
    steps = [(r"(?:19|20)(?<=\b..)[0-9]{2}\b", ""), (r"(?i)fy(?<=\bfy)[0-9]{2,4}\b", "")]
    if units:
        steps.append((rf"(?i)[0-9]+\s*({UNITS})", "$1"))
    rest = [(r"http[^\s]+|www[^\s]+", ""), (r"\s{2,}|[\s&&[^ ]]", " ")]
    replaced = lambda c, s: F.regexp_replace(c, *s)
    return F.trim(reduce(replaced, rest, without_addresses(reduce(replaced, steps, t))))


def without_addresses(t: Column) -> Column:
    """Without runs of characters that have an @ inside; the pattern is slow on texts that have none."""
    return T.let(t, lambda x: F.when(x.contains("@"), F.regexp_replace(x, r"[^\s]+@[^\s]+", "")).otherwise(x))


def singular(w: Column) -> Column:
    """A plain stand-in for the base form: plural endings go."""
    return F.when(~F.endswith(w, F.lit("s")), w).when(w.rlike("[a-z]{2}ies$"), F.regexp_replace(w, "ies$", "y")).when(w.rlike("(ss|sh|ch|x)es$"), F.regexp_replace(w, "es$", "")).when(w.rlike("[a-z]{2}[^sui]s$"), F.regexp_replace(w, "s$", "")).otherwise(w)


def content_words(t: Column, stop: Iterable[str], excluded: Iterable[str], kept: Iterable[str] = (), least: int = 3, base: Callable[[Column], Column] = singular) -> Column:
    """Base forms of the words of a text that say something, in order; those of ``kept`` stay as they are.

    Words are runs of letters and digits that begin with a letter, in lower case. Stop
    words, excluded ones (as they are or in their base form) and short ones go.
    """
    stop, excluded, kept = [*stop], [*excluded], [*kept]
    # other words are passed over as a whole, and give nothing
    plain = F.array_remove(F.regexp_extract_all(F.lower(t), F.lit(rf"([a-z][a-z0-9]*+)(?!{_PART})|{T.WORD}"), 1), "")
    dropped = lambda w: w.isin([*{*stop, *excluded}]) | (F.length(w) < least)
    # one value more than ten are looked up by their hash
    spared = lambda x: x.isin([*kept, ""])

    def said(w: Column) -> Column:
        if not kept:
            return F.when(~dropped(w), T.let(base(w), lambda b: F.when(~b.isin(excluded), b)))
        return T.let(base(w), lambda b: F.when(spared(w) | spared(b), w).when(~dropped(w) & ~b.isin(excluded), b))

    return F.filter(F.transform(plain, said), lambda x: x.isNotNull())


def basic_words(t: Column) -> Column:
    """Words for models of single reports: addresses and links go, some words always stay."""
    cleaned = F.regexp_replace(without_addresses(F.lower(t)), r"http[^\s]+|www[^\s]+", "")
    return content_words(cleaned, STOP_WORDS, EXCLUDED, KEPT)


def strict_words(t: Column, backwards: bool = True) -> Column:
    return content_words(strictly_cleaned(t, backwards), STOP_WORDS, EXTRA)


def enhanced_words(t: Column) -> Column:
    """As strict_words, but acronyms stay, and so do units without their numbers."""
    return content_words(strictly_cleaned(t, units=True), STOP_WORDS, EXTRA, [a.lower() for a in ACRONYMS])


def library_stop_words(spark) -> list[str]:
    """The longer list of English stop words that comes with Spark."""
    return StopWordsRemover.loadDefaultStopWords("english")


_DIRTY = ["In FY2023 and 2024 our 12 tonnes of CO2, see www.x.org/a ", "seeyolpme eht htiw srekrow fo puorg ", "The UN committees (mail a@b.c) used 40 % of energies; tco2e ", ""]


def _docs(spark, sf_dir) -> DataFrame:
    front = F.element_at(F.array(*map(F.lit, _DIRTY)), (F.col("doc_id") % len(_DIRTY) + 1).cast("int"))
    return table(spark, sf_dir, "documents").select("doc_id", F.concat(front, F.when(F.col("doc_id") % 4 == 1, F.substring("text", 1, 0)).otherwise(F.col("text"))).alias("text"))


_SQL_DOCS = f"d AS (SELECT doc_id, [{', '.join(map(S.quoted, _DIRTY))}][doc_id % {len(_DIRTY)} + 1] || CASE WHEN doc_id % 4 = 1 THEN '' ELSE text END AS t FROM documents)"


def _sql_cleaned(t: str, backwards: bool = True, units: bool = False) -> str:
    if backwards:
        hits = lambda ws: "(" + " + ".join(f"contains(lower({t}), '{w}')::INT" for w in ws) + ")"
        t = S.replaced(f"CASE WHEN {hits(BACKWARDS)} > {hits(BACKWARDS.values())} THEN reverse({t}) ELSE {t} END", r"[^\x00-\x7F]", "")
    steps = [(r"\b(19|20)[0-9]{2}\b", ""), (r"(?i)\bfy[0-9]{2,4}\b", "")] + ([(rf"(?i)[0-9]+\s*({UNITS})", r"\1")] if units else [])
    return f"trim({reduce(lambda c, s: S.replaced(c, *s), [*steps, (r'[^\s]+@[^\s]+', ''), (r'http[^\s]+|www[^\s]+', ''), (r'\s+', ' ')], t)})"


def _sql_base(w: str) -> str:
    return f"CASE WHEN regexp_matches({w}, '[a-z]{{2}}ies$') THEN regexp_replace({w}, 'ies$', 'y') WHEN regexp_matches({w}, '(ss|sh|ch|x)es$') THEN regexp_replace({w}, 'es$', '') WHEN regexp_matches({w}, '[a-z]{{2}}[^sui]s$') THEN regexp_replace({w}, 's$', '') ELSE {w} END"


def _sql_words(t: str, excluded: Iterable[str], kept: Iterable[str] = ()) -> str:
    listed = lambda ws: "(" + ", ".join(map(S.quoted, [*ws] or ["-"])) + ")"
    spared = f"(w IN {listed(kept)} OR {_sql_base('w')} IN {listed(kept)})"
    stays = f"list_filter(list_filter(regexp_extract_all(lower({t}), '{S.WORD}'), lambda w: regexp_matches(w, '^[a-z][a-z0-9]*$')), lambda w: {spared} OR (w NOT IN {listed(STOP_WORDS)} AND w NOT IN {listed(excluded)} AND {_sql_base('w')} NOT IN {listed(excluded)} AND length(w) >= 3))"
    return f"list_transform({stays}, lambda w: CASE WHEN {spared} THEN w ELSE {_sql_base('w')} END)"


_KINDS = {
    "basic": (_sql_words(S.replaced(S.replaced("lower(t)", r"[^\s]+@[^\s]+", ""), r"http[^\s]+|www[^\s]+", ""), EXCLUDED, KEPT), basic_words),
    "strict": (_sql_words(_sql_cleaned("t"), EXTRA), strict_words),
    "plain": (_sql_words(_sql_cleaned("t", backwards=False), EXTRA), lambda t: strict_words(t, backwards=False)),
    "enhanced": (_sql_words(_sql_cleaned("t", units=True), EXTRA, [a.lower() for a in ACRONYMS]), enhanced_words),
}


@register("strictly_cleaned", f"WITH {_SQL_DOCS} SELECT doc_id, md5({_sql_cleaned('t')}) AS strict_md5, md5({_sql_cleaned('t', backwards=False)}) AS plain_md5, md5({_sql_cleaned('t', units=True)}) AS enhanced_md5 FROM d")
def strictly_cleaned_query(spark, sf_dir):
    """Whole texts cleaned for topic models in three ways."""
    t = F.col("text")
    return _docs(spark, sf_dir).select("doc_id", F.md5(strictly_cleaned(t)).alias("strict_md5"), F.md5(strictly_cleaned(t, backwards=False)).alias("plain_md5"), F.md5(strictly_cleaned(t, units=True)).alias("enhanced_md5"))


@register(
    "content_words",
    f"WITH {_SQL_DOCS}, w AS (SELECT doc_id, {', '.join(f'{q} AS {k}' for k, (q, _) in _KINDS.items())} FROM d) SELECT doc_id, "
    + ", ".join(f"len({k})::BIGINT AS n_{k}, md5(array_to_string({k}, ' ')) AS {k}_md5" for k in _KINDS) + f" FROM w WHERE len(strict) >= {LEAST_WORDS}",
)
def content_words_query(spark, sf_dir):
    """Words of whole texts that topic models see, by four rules; texts with too few words are left out."""
    read = filtered(_docs(spark, sf_dir).select("doc_id", *(f(F.col("text")).alias(k) for k, (_, f) in _KINDS.items())), F.size("strict") >= LEAST_WORDS)
    return read.select("doc_id", *(x for k in _KINDS for x in (F.size(k).cast("long").alias(f"n_{k}"), F.md5(F.array_join(k, " ")).alias(f"{k}_md5"))))


def require_documents(docs: DataFrame, least: int = LEAST_DOCUMENTS) -> DataFrame:
    """The documents, if there are enough of them to model."""
    n = docs.limit(least).count()
    if n < least:
        raise ValueError(f"{n} documents are too few to model, {least} are needed")
    return docs


def report_full_text(json: Column) -> Column:
    """The text of a nested report as JSON: headings and paragraphs in order, parents first, blank lines between; without a structure the JSON itself.

    Content is a list of paragraphs or a text. Levels are nested to a depth of six, more
    than any report of three levels has.
    """
    block = "struct<heading:string,content:string,subsections:array<string>>"

    def texts(raw: Column, depth: int) -> Column:
        b = F.from_json(raw, block)
        content = b["content"]
        listed = F.when(content.startswith("["), F.from_json(content, "array<string>")).when(F.coalesce(content, F.lit("")) != "", F.array(content)).otherwise(F.array().cast("array<string>"))
        own = F.concat(F.when(F.coalesce(b["heading"], F.lit("")) != "", F.array(b["heading"])).otherwise(F.array().cast("array<string>")), F.coalesce(listed, F.array().cast("array<string>")))
        if not depth:
            return own
        return F.concat(own, F.flatten(F.transform(F.coalesce(b["subsections"], F.array().cast("array<string>")), lambda s: texts(s, depth - 1))))

    structure = F.get_json_object(json, "$.structure")
    blocks = F.from_json(structure, "array<string>")
    return F.when(structure.isNull(), json).otherwise(F.array_join(F.flatten(F.transform(blocks, lambda x: texts(x, 5))), "\n\n"))


@register(
    "report_full_texts",
    """
    SELECT conv_id AS doc_id, md5(string_agg(CASE WHEN turn % 3 = 2 THEN role || '-' ELSE role END || chr(10) || chr(10) || text, chr(10) || chr(10) ORDER BY turn)) AS text_md5 FROM conversations GROUP BY conv_id
    """,
)
def report_full_texts(spark, sf_dir):
    """The text of nested reports: turns are sections, each holds the next one up to a depth of three, and some have a text for content."""
    turns = table(spark, sf_dir, "conversations").withColumn("third", F.expr("turn div 3"))
    name = F.when(F.col("turn") % 3 == 2, F.concat("role", F.lit("-"))).otherwise(F.col("role"))
    content = F.when(F.col("turn") % 2 == 0, F.to_json(F.array("text"))).otherwise(F.regexp_replace(F.to_json(F.array("text")), r"^\[|\]$", ""))
    begin = F.concat(F.lit('{"heading":'), F.regexp_replace(F.to_json(F.array(name)), r"^\[|\]$", ""), F.lit(',"content":'), content)
    nested = turns.groupBy("conv_id", "third").agg(F.array_sort(F.collect_list(F.struct("turn", begin.alias("b")))).alias("x"))
    folded = F.concat(F.array_join(F.transform("x", lambda y: y["b"]), ',"subsections":['), F.lit("}"), F.repeat(F.lit("]}"), F.size("x") - 1))
    reports = nested.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("third", folded.alias("j")))).alias("x"))
    json = F.concat(F.lit('{"structure":['), F.array_join(F.transform("x", lambda y: y["j"]), ","), F.lit("]}"))
    return reports.select(F.col("conv_id").alias("doc_id"), F.md5(report_full_text(json)).alias("text_md5"))
