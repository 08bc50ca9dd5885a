"""Queries that score and match texts: reversed cells, search results, fiscal years, companies, kinds of report."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loamwork.functions import text as T
from loamwork.operators.dealing import filtered
from loamwork.plans import sql as S
from loamwork.plans.documents import table
from loamwork.plans.registry import register

# What a search result's title or link must not hold, and points for what it holds.
JUNK = [
    "investor presentation", "earnings call", "transcript", "press release", "media release", "brief", "result update", "corporate presentation",
    "presentation", "investor", "earnings", "call", "release", "outcome", "results",
]
JUNK_TITLES = ["integrated report", "integrated annual report", "annual report"]
TITLE_POINTS = {"business responsibility": 100, "brsr": 100, "sustainability report": 100, "esg report": 80}
LINK_POINTS = {"brsr": 20, "sustainability": 10}

# The fiscal years that count.
FISCAL_YEARS = ["2022-23", "2023-24", "2024-25"]
#: Characters of the cover, where a year is looked for first.
COVER = 2000

# Symbols that stand in many texts as names of exchanges.
AMBIGUOUS_SYMBOLS = ["BSE", "NSE", "SEBI", "NIFTY", "SENSEX", "MCX"]
#: Characters in which a symbol is looked for first.
FIRST_PART = 3000

# Patterns that tell kinds of report.
REPORT_TITLES = [
    r"business\s+responsibility\s+and\s+sustainability\s+report", r"brsr\s+report", r"business\s+responsibility\s+report", r"standalone\s+brsr", r"standalone\s+business\s+responsibility",
]
ANNUAL_TITLES = [r"annual\s+report\s+\d{4}", r"annual\s+report\s+\d{4}[-/]\d{2,4}", r"\d{4}[-/]\d{2,4}\s+annual\s+report", r"integrated\s+annual\s+report"]
CONTENTS_WORDS = [r"table\s+of\s+contents", "contents", "index"]
FINANCIAL_WORDS = [r"financial\s+statements", r"balance\s+sheet", r"profit\s+and\s+loss", r"cash\s+flow", r"notes\s+to\s+accounts", r"auditor['s]?\s+report"]

_WORD = T.WORD


@register(
    "reversed_lines",
    rf"""
    WITH t AS (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'eht rof dna total' || chr(10) || 'sales | latotS | ,eman' || chr(10) ELSE '' END || text AS text FROM documents),
    l AS (SELECT doc_id, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i, unnest(string_split(text, chr(10))) AS line FROM t),
    c AS (SELECT doc_id, i, line, len(string_split(line, '|')) AS n, generate_subscripts(string_split(line, '|'), 1) AS k, unnest(string_split(line, '|')) AS raw FROM l),
    s AS (SELECT *, {S.strip('raw')} AS cell FROM c), o AS (SELECT *, {S.orientation_score('cell')} AS score FROM s),
    f AS (SELECT doc_id, i, max(score >= 0.35::DOUBLE)::BIGINT AS hit, CASE WHEN {S.is_blank('any_value(line)')} THEN any_value(line)
          ELSE string_agg(CASE WHEN score >= 0.35::DOUBLE THEN reverse(cell) ELSE cell END, ' | ' ORDER BY k) END AS line FROM o GROUP BY doc_id, i)
    SELECT doc_id, sum(hit)::BIGINT AS n_lines, md5(string_agg(line, chr(10) ORDER BY i)) AS text_md5 FROM f GROUP BY doc_id HAVING sum(hit) > 0
    """,
)
def reversed_lines(spark, sf_dir):
    """Documents with lines that look reversed, and the md5 of the whole text put right; no shuffle. Such lines are put before some texts."""
    before = F.when(F.col("doc_id") % 3 == 0, "eht rof dna total\nsales | latotS | ,eman\n").otherwise("")
    docs = table(spark, sf_dir, "documents").select("doc_id", T.righted_lines(F.concat(before, "text")).alias("lines"))
    found = filtered(docs.select("doc_id", "lines", F.size(F.filter("lines", lambda x: x["hit"])).cast("long").alias("n_lines")), F.col("n_lines") > 0)
    return found.select("doc_id", "n_lines", F.md5(F.array_join(F.transform("lines", lambda x: x["text"]), "\n")).alias("text_md5"))


def search_score(title, link):
    """Points of a search result; -1000 for junk."""
    t, u = F.lower(F.coalesce(title, F.lit(""))), F.lower(F.coalesce(link, F.lit("")))
    holds = lambda c, words: reduce(lambda a, b: a | b, (c.contains(w) for w in words))
    points = [F.when(c.contains(w), F.lit(n)).otherwise(F.lit(0)) for c, given in ((t, TITLE_POINTS), (u, LINK_POINTS)) for w, n in given.items()]
    return F.when(holds(t, JUNK) | holds(u, JUNK) | holds(t, JUNK_TITLES), F.lit(-1000)).otherwise(reduce(lambda a, b: a + b, points))


def _sql_holds(c: str, words: list[str]) -> str:
    return "(" + " OR ".join(f"contains({c}, '{w}')" for w in words) + ")"


_POINTS = " + ".join(f"CASE WHEN contains({c}, '{w}') THEN {n} ELSE 0 END" for c, given in (("t", TITLE_POINTS), ("u", LINK_POINTS)) for w, n in given.items())


@register(
    "search_scores",
    f"""
    WITH r AS (SELECT page_id, CASE page_id % 9 WHEN 0 THEN 'BRSR report of ' WHEN 1 THEN 'Annual Report of ' WHEN 2 THEN 'Sustainability Report, ' WHEN 3 THEN 'ESG report and earnings of ' WHEN 4 THEN 'Business Responsibility, ' ELSE '' END
                      || regexp_extract(html, '<title>([^<]*)', 1) AS title, url || CASE WHEN page_id % 4 = 0 THEN '/sustainability.pdf' ELSE '' END AS link FROM pages),
    l AS (SELECT page_id, lower(title) AS t, lower(link) AS u FROM r),
    s AS (SELECT page_id, CASE WHEN {_sql_holds('t', JUNK)} OR {_sql_holds('u', JUNK)} OR {_sql_holds('t', JUNK_TITLES)} THEN -1000 ELSE {_POINTS} END AS score,
                 regexp_extract(u, '^[a-z]+://[^/?#]+([^?#]*)', 1) AS path, regexp_extract(u, '[?]([^#]*)', 1) AS query FROM l)
    SELECT page_id, score::BIGINT AS score, contains(path, 'pdf') OR contains(query, 'pdf') AS is_pdf FROM s WHERE score >= 0
    """,
)
def search_scores(spark, sf_dir):
    """Search results that are not junk, with their points and whether they lead to a PDF."""
    k = F.col("page_id") % 9
    kind = F.when(k == 0, "BRSR report of ").when(k == 1, "Annual Report of ").when(k == 2, "Sustainability Report, ").when(k == 3, "ESG report and earnings of ").when(k == 4, "Business Responsibility, ").otherwise("")
    link = F.concat("url", F.when(F.col("page_id") % 4 == 0, "/sustainability.pdf").otherwise(""))
    found = table(spark, sf_dir, "pages").select("page_id", F.concat(kind, F.regexp_extract("html", "<title>([^<]*)", 1)).alias("title"), link.alias("link"))
    u = F.lower("link")
    is_pdf = F.regexp_extract(u, r"^[a-z]+://[^/?#]+([^?#]*)", 1).contains("pdf") | F.regexp_extract(u, r"[?]([^#]*)", 1).contains("pdf")
    return found.select("page_id", search_score(F.col("title"), F.col("link")).cast("long").alias("score"), is_pdf.alias("is_pdf")).filter("score >= 0")


def fiscal_year(t, years: list[str] = FISCAL_YEARS):
    """The first listed year that a text names, by forms in order: YYYY-YY on the cover, then anywhere; FYyy, YYYY-YYYY and YYYY on the cover.

    Texts of under 50 characters, and those without a listed year, give null.
    """
    cover = F.substring(t, 1, COVER)
    full = lambda c: F.regexp_extract_all(c, F.lit(r"\b(20[0-9]{2}-[0-9]{2})\b"), 1)
    known = lambda names: F.get(F.filter(names, lambda y: y.isin(years)), F.lit(0))
    short = F.transform(F.regexp_extract_all(F.lower(cover), F.lit(r"\bfy[\s-]?([0-9]{2})\b"), 1), lambda y: F.concat((F.when(y.cast("int") < 50, 2000).otherwise(1900) + y.cast("int") - 1).cast("string"), F.lit("-"), y))
    two = F.filter(F.regexp_extract_all(cover, F.lit(r"\b(20[0-9]{2}-20[0-9]{2})\b"), 1), lambda y: F.substring(y, 6, 4).cast("int") == F.substring(y, 1, 4).cast("int") + 1)
    long = F.transform(two, lambda y: F.concat(F.substring(y, 1, 5), F.substring(y, 8, 2)))
    first = {y[:4]: y for y in reversed(years)}
    single = F.get(F.filter(F.regexp_extract_all(cover, F.lit(r"\b(20[0-9]{2})\b"), 1), lambda y: y.isin([*first])), F.lit(0))
    named = reduce(lambda c, kv: c.when(single == kv[0], F.lit(kv[1])), first.items(), F.when(F.lit(False), F.lit("")))
    return F.when(F.length(F.trim(t)) >= 50, F.coalesce(known(full(cover)), known(full(t)), known(short), known(long), named))


def _sql_first(names: str) -> str:
    return f"list_filter({names}, lambda y: y IN ({', '.join(repr(y) for y in FISCAL_YEARS)}))[1]"


@register(
    "fiscal_years",
    rf"""
    WITH d AS (SELECT doc_id, CASE doc_id % 6 WHEN 0 THEN 'Year 2023-24. ' WHEN 1 THEN 'FY ' || (20 + doc_id % 9) || ', ' WHEN 2 THEN '2021-2022 and 2022-2023: ' WHEN 3 THEN 'in 2019 and 2024 ' ELSE '' END
                      || text || CASE doc_id % 5 WHEN 0 THEN ' 2019-20 or 2024-25 ' ELSE '' END AS t FROM documents),
    c AS (SELECT *, t[1:{COVER}] AS cover FROM d)
    SELECT doc_id, CASE WHEN length(trim(t)) >= 50 THEN coalesce({_sql_first(r"regexp_extract_all(cover, '\b20[0-9]{2}-[0-9]{2}\b')")}, {_sql_first(r"regexp_extract_all(t, '\b20[0-9]{2}-[0-9]{2}\b')")},
      {_sql_first(r"list_transform(regexp_extract_all(lower(cover), '\bfy[\s-]?([0-9]{2})\b', 1), lambda y: (CASE WHEN y::INT < 50 THEN 2000 ELSE 1900 END + y::INT - 1)::VARCHAR || '-' || y)")},
      {_sql_first(r"list_transform(list_filter(regexp_extract_all(cover, '\b20[0-9]{2}-20[0-9]{2}\b'), lambda y: y[6:9]::INT = y[1:4]::INT + 1), lambda y: y[1:5] || y[8:9])")},
      list_filter([{', '.join(repr(y) for y in FISCAL_YEARS)}], lambda y: starts_with(y, list_filter(regexp_extract_all(cover, '\b20[0-9]{{2}}\b'), lambda s: s IN ({', '.join(repr(y[:4]) for y in FISCAL_YEARS)}))[1]))[1]) END AS year FROM c
    """,
)
def fiscal_years(spark, sf_dir):
    """The fiscal year of each text; years are put before and after the texts, which have none."""
    k = F.col("doc_id")
    before = F.when(k % 6 == 0, "Year 2023-24. ").when(k % 6 == 1, F.concat(F.lit("FY "), (k % 9 + 20).cast("string"), F.lit(", "))).when(k % 6 == 2, "2021-2022 and 2022-2023: ").when(k % 6 == 3, "in 2019 and 2024 ").otherwise("")
    t = F.concat(before, "text", F.when(k % 5 == 0, " 2019-20 or 2024-25 ").otherwise(""))
    return table(spark, sf_dir, "documents").select("doc_id", t.alias("t")).select("doc_id", fiscal_year(F.col("t")).alias("year"))


def companies_in_text(docs: DataFrame, companies: DataFrame) -> DataFrame:
    """(doc_id, symbol, score): the company (symbol, name, place) whose symbol a text (doc_id, text) names.

    A symbol, a single word, counts 100 in the first part of a text, and 100 more if a
    word of the company's name stands there too; of the best, the least place wins. Where
    none is there, the whole text is searched, and a word of the name is needed. Symbols
    of exchanges never count. A text's words are joined with symbols by equality, so
    work is in proportion to words, not to words times companies. Nulls match nothing.
    """
    words = lambda c: F.regexp_extract_all(T.upper(c), F.lit(f"({_WORD})"), 1)
    head = F.substring("text", 1, FIRST_PART)
    rows = docs.select("doc_id", F.explode(F.array_distinct(words(F.col("text")))).alias("symbol"))
    bare = F.transform(F.filter(F.split(T.lower(F.col("name")), r"\s+"), lambda w: F.length(w) > 2), lambda w: F.regexp_replace(w, "[.,;:]+$", ""))
    names = companies.select(T.upper(F.col("symbol")).alias("symbol"), "place", F.filter(bare, lambda w: w != "").alias("parts")).filter(~F.col("symbol").isin(AMBIGUOUS_SYMBOLS))
    # a text's symbols are few; they meet the text once
    hits = rows.join(names, "symbol").groupBy("doc_id").agg(F.collect_list(F.struct("symbol", "place", "parts")).alias("found"))
    near = docs.select("doc_id", T.lower(F.col("text")).alias("t"), T.lower(head).alias("h"), words(head).alias("w")).join(hits, "doc_id")
    named = lambda c, parts: F.exists(parts, lambda w: F.contains(c, w))
    score = lambda x: F.when(F.array_contains("w", x["symbol"]) & named(F.col("h"), x["parts"]), 200).when(F.array_contains("w", x["symbol"]), 100).when(named(F.col("t"), x["parts"]), 1)
    scored = F.transform("found", lambda x: F.struct((-score(x)).alias("less"), x["place"].alias("place"), x["symbol"].alias("symbol")))
    best = near.select("doc_id", F.array_min(F.filter(scored, lambda x: x["less"].isNotNull())).alias("b")).filter("b IS NOT NULL")
    return best.select("doc_id", "b.symbol", (-F.col("b.less")).cast("long").alias("score"))


@register(
    "company_matches",
    rf"""
    WITH c AS (SELECT upper(regexp_extract(text, '({_WORD})', 1)) AS symbol, min(item_id) AS place, arg_min(text[1:40], item_id) AS name FROM benchmark GROUP BY 1),
    p AS (SELECT symbol, place, list_filter(list_transform(list_filter(regexp_split_to_array(lower(name), '\s+'), lambda w: length(w) > 2), lambda w: regexp_replace(w, '[.,;:]+$', '')), lambda w: w <> '') AS parts FROM c),
    d AS (SELECT doc_id, lower(text) AS t, lower(text[1:{FIRST_PART}]) AS h, list_distinct(regexp_extract_all(upper(text), '{_WORD}')) AS w, regexp_extract_all(upper(text[1:{FIRST_PART}]), '{_WORD}') AS hw FROM documents),
    j AS (SELECT doc_id, t, h, hw, unnest(w) AS symbol FROM d),
    s AS (SELECT doc_id, symbol, place, CASE WHEN list_contains(hw, symbol) AND len(list_filter(parts, lambda x: contains(h, x))) > 0 THEN 200 WHEN list_contains(hw, symbol) THEN 100
                 WHEN len(list_filter(parts, lambda x: contains(t, x))) > 0 THEN 1 END AS score FROM j JOIN p USING (symbol))
    SELECT doc_id, symbol, score::BIGINT AS score FROM s WHERE score IS NOT NULL QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, place) = 1
    """,
)
def company_matches(spark, sf_dir):
    """Texts matched to companies; first words of the benchmark's items stand in for symbols."""
    items = table(spark, sf_dir, "benchmark").select(T.upper(F.regexp_extract("text", f"({_WORD})", 1)).alias("symbol"), F.struct("item_id", F.substring("text", 1, 40).alias("name")).alias("x"))
    companies = items.groupBy("symbol").agg(F.min("x").alias("x")).select("symbol", "x.name", F.col("x.item_id").alias("place"))
    return companies_in_text(table(spark, sf_dir, "documents"), companies)


def report_kind(text, pages):
    """(kind, hundredths of confidence) of a report by the text of its first pages and its number of pages."""
    t = F.lower(text)
    has = lambda patterns: t.rlike("|".join(patterns))
    kind = lambda name, sure: F.struct(F.lit(name).alias("kind"), F.lit(sure).cast("long").alias("confidence"))
    by_title = F.when(has(REPORT_TITLES) & ~has(ANNUAL_TITLES), kind("standalone", 90)).when(has(ANNUAL_TITLES), kind("embedded", 85))
    return by_title.when(has(CONTENTS_WORDS) & has(FINANCIAL_WORDS), kind("embedded", 80)).when(pages.between(1, 50), kind("standalone", 60)).when(pages >= 100, kind("embedded", 60)).otherwise(kind("unknown", 40))


def _sql_has(patterns: list[str]) -> str:
    return "regexp_matches(t, '" + "|".join(patterns).replace("'", "''") + "')"


_TITLES = {0: "Business Responsibility Report ", 1: "Annual Report 2024 ", 2: "Index. Balance sheet ", 3: "Integrated Annual Report, BRSR report "}


@register(
    "report_kinds",
    f"""
    WITH p AS (SELECT conv_id, turn, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS k FROM conversations),
    r AS (SELECT conv_id, count(*) * (conv_id % 40) AS n, CASE conv_id % 7 {' '.join(f"WHEN {k} THEN '{v}'" for k, v in _TITLES.items())} ELSE '' END || string_agg(text, chr(10) || chr(10) ORDER BY turn) FILTER (k <= 5) AS x FROM p GROUP BY conv_id),
    l AS (SELECT conv_id, n, lower(x) AS t FROM r)
    SELECT conv_id AS doc_id, CASE WHEN {_sql_has(ANNUAL_TITLES)} THEN 'embedded' WHEN {_sql_has(REPORT_TITLES)} THEN 'standalone' WHEN {_sql_has(CONTENTS_WORDS)} AND {_sql_has(FINANCIAL_WORDS)} THEN 'embedded'
                WHEN n BETWEEN 1 AND 50 THEN 'standalone' WHEN n >= 100 THEN 'embedded' ELSE 'unknown' END AS kind,
           (CASE WHEN {_sql_has(ANNUAL_TITLES)} THEN 85 WHEN {_sql_has(REPORT_TITLES)} THEN 90 WHEN {_sql_has(CONTENTS_WORDS)} AND {_sql_has(FINANCIAL_WORDS)} THEN 80 WHEN n BETWEEN 1 AND 50 OR n >= 100 THEN 60 ELSE 40 END)::BIGINT AS confidence FROM l
    """,
)
def report_kinds(spark, sf_dir):
    """Standalone or embedded, by titles on the first five pages, else by pages; titles are put before the texts."""
    first = Window.partitionBy("conv_id").orderBy("turn")
    pages = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.row_number().over(first).alias("k"), "text")
    some = F.array_sort(F.collect_list(F.when(F.col("k") <= 5, F.struct("turn", "text"))))
    reports = pages.groupBy("conv_id").agg(F.count("*").alias("n"), some.alias("x"))
    k = F.col("conv_id") % 7
    title = reduce(lambda c, kv: c.when(k == kv[0], F.lit(kv[1])), _TITLES.items(), F.when(F.lit(False), F.lit(""))).otherwise("")
    found = reports.select("conv_id", report_kind(F.concat(title, F.array_join(F.transform("x", lambda p: p["text"]), "\n\n")), F.col("n") * (F.col("conv_id") % 40)).alias("r"))
    return found.select(F.col("conv_id").alias("doc_id"), "r.kind", "r.confidence")
