"""Queries on filings, search results and the reports that they lead to: which to take, whether it is the right one, and whose it is."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from html.parser import HTMLParser

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loamwork.functions import text as T
from loamwork.plans import sql as S
from loamwork.plans.documents import table
from loamwork.plans.matching import AMBIGUOUS_SYMBOLS, FIRST_PART
from loamwork.plans.registry import register

# Words that tell a disclosure filing, and the prefix of annual reports.
FILING_WORDS = ["BRSR", "BUSINESS RESPONSIBILITY", "SUSTAINABILITY"]
ANNUAL_PREFIX = "AR_"

# What a search leaves out, and what it looks for.
NEGATIVES = "-presentation -transcript -earnings"
SITE_TERMS = '(BRSR OR "Business Responsibility")'
NAME_TERMS = '(BRSR OR "Business Responsibility" OR "Sustainability Report")'

# Phrases that only annual reports have.
POISON = ["independent auditor's report", "standalone financial statements", "consolidated financial statements", "profit and loss account"]
MOST_PAGES, SURE_TITLE = 200, 100

# Words that say nothing of a company, in verification and, with more, elsewhere.
COMMON_WORDS = ["limited", "ltd", "ltd.", "india", "private", "public", "corporation", "corp", "corp.", "inc", "inc.", "incorporated", "company", "co", "co."]
MORE_COMMON_WORDS = [*COMMON_WORDS, "industries", "group", "enterprises", "solutions", "services", "systems"]
# Names that do not count where they stand alone, and companies that regulators' texts name.
GENERIC_NAMES = [
    "bank", "power", "infra", "finance", "capital", "global", "infrastructure", "financial", "insurance", "cement", "pharma", "pharmaceuticals", "energy", "realty", "housing",
    "holdings", "investment", "clean", "electrical", "electrics",
]
BLACKLISTED = ["bse limited", "bse ltd", "nse limited", "nse ltd", "bombay stock exchange limited", "national stock exchange of india limited"]
#: Characters that stand for the first page.
FIRST_PAGE = 2000


def unwrapped(response: Column) -> Column:
    """The records of a JSON response as JSON text: itself if it is a list, else what data, result or records hold."""
    return F.when(F.ltrim(response).startswith("["), response).otherwise(F.coalesce(*(F.get_json_object(response, f"$.{k}") for k in ("data", "result", "records"))))


def filing_choices(filings: DataFrame, years: list[str]) -> DataFrame:
    """(symbol, year, place, exact): of each company's disclosure filings (symbol, place, submission_type, file_name, from_year, to_year), the one for each year.

    A filing is of a year if its years are the year's, or both the first (as some
    sources give it), or its file name holds both. Exact ones come first, then the least
    place. Years that are no whole numbers match by the file name alone.
    """
    start = F.substring("year", 1, 4)
    end_text = F.when(F.col("year").contains("-"), F.regexp_extract("year", "-(.*)$", 1)).otherwise((start.cast("int") + 1).cast("string"))
    end = F.when(F.length(end_text) == 2, F.concat(F.lit("20"), end_text)).otherwise(end_text)
    name, kind = F.coalesce("file_name", F.lit("")), F.upper(F.coalesce("submission_type", F.lit("")))
    of_kind = T.contains_any(kind, FILING_WORDS) | (~F.upper(name).startswith(ANNUAL_PREFIX) & T.contains_any(F.upper(name), FILING_WORDS))
    whole = lambda c: F.when(F.trim(F.col(c).cast("string")).rlike("^[+-]?[0-9]+$"), F.trim(F.col(c).cast("string")).cast("int"))
    first, last = whole("from_year"), whole("to_year")
    exact = F.coalesce((first == start.cast("int")) & ((last == end.cast("int")) | (last == first)), F.lit(False))
    by_name = F.contains(name, start) & (F.contains(name, end) | F.contains(name, end_text) | F.contains(name, F.col("year")))
    found = filings.filter(of_kind).withColumn("year", F.explode(F.array(*map(F.lit, years)))).withColumn("exact", exact).filter(F.col("exact") | by_name)
    return found.groupBy("symbol", "year").agg(F.min(F.struct((~F.col("exact")).alias("loose"), "place")).alias("b")).select("symbol", "year", "b.place", (~F.col("b.loose")).alias("exact"))


_YEARS = ["2022-23", "2023-24"]
_KINDS = ["BRSR filing", "Annual", "business responsibility report", "", None]


@register(
    "filings_chosen",
    f"""
    WITH f AS (SELECT 'S' || (o_custkey % 40) AS symbol, o_orderkey AS place, [{', '.join('NULL' if x is None else S.quoted(x) for x in _KINDS)}][o_orderkey % {len(_KINDS)} + 1] AS kind,
                      CASE o_orderkey % 6 WHEN 0 THEN 'AR_2022_2023_brsr.pdf' WHEN 1 THEN 'brsr_2022-23.pdf' WHEN 2 THEN 'Sustainability 2023 2024.pdf' ELSE 'x.pdf' END AS name,
                      CASE o_orderkey % 7 WHEN 0 THEN '2022' WHEN 1 THEN ' 2023 ' WHEN 2 THEN 'n/a' WHEN 3 THEN '2021' END AS a, CASE o_orderkey % 4 WHEN 0 THEN '2023' WHEN 1 THEN '2024' WHEN 2 THEN '2022' END AS b FROM orders),
    y AS (SELECT unnest([{', '.join(map(S.quoted, _YEARS))}]) AS year),
    m AS (SELECT symbol, year, place, name, try_cast(trim(a) AS INT) AS a, try_cast(trim(b) AS INT) AS b, year[1:4] AS s, '20' || year[6:7] AS e FROM f CROSS JOIN y
          WHERE {S.contains_any("upper(coalesce(kind, ''))", FILING_WORDS)} OR (NOT starts_with(upper(name), 'AR_') AND {S.contains_any('upper(name)', FILING_WORDS)})),
    x AS (SELECT *, coalesce(a = s::INT AND (b = e::INT OR b = a), false) AS exact FROM m)
    SELECT symbol, year, place, exact FROM x WHERE exact OR (contains(name, s) AND (contains(name, e) OR contains(name, year[6:7]) OR contains(name, year)))
    QUALIFY row_number() OVER (PARTITION BY symbol, year ORDER BY exact DESC, place) = 1
    """,
)
def filings_chosen(spark, sf_dir):
    """The filing of each company for each year."""
    k = F.col("o_orderkey")
    case = lambda n, values: reduce(lambda c, kv: c.when(k % n == kv[0], F.lit(kv[1])), enumerate(values), F.when(F.lit(False), F.lit("")))
    filings = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("S"), (F.col("o_custkey") % 40).cast("string")).alias("symbol"), k.alias("place"), case(len(_KINDS), _KINDS).alias("submission_type"),
        case(6, ["AR_2022_2023_brsr.pdf", "brsr_2022-23.pdf", "Sustainability 2023 2024.pdf"]).otherwise("x.pdf").alias("file_name"),
        case(7, ["2022", " 2023 ", "n/a", "2021"]).alias("from_year"), case(4, ["2023", "2024", "2022"]).alias("to_year"),
    )
    return filing_choices(filings, _YEARS)


def site_domain(website: Column) -> Column:
    """The host of a website, without protocol and www, also where there is no protocol."""
    return F.split(F.regexp_replace(F.trim(F.regexp_replace(F.coalesce(website, F.lit("")), "https?://", "")), r"^www\.", ""), "/", -1)[0]


def search_query(company: Column, website: Column, year: Column) -> Column:
    """What to search for: the company's site if it has one, else its name, and the year's first part."""
    start = F.when(year.contains("-"), F.substring_index(year, "-", 1)).otherwise(year)
    site = site_domain(website)
    tail = F.concat(start, F.lit(f" {NEGATIVES}"))
    return F.when(site != "", F.concat(F.lit("site:"), site, F.lit(f" filetype:pdf {SITE_TERMS} "), tail)).otherwise(F.concat(company, F.lit(f" filetype:pdf {NAME_TERMS} "), tail))


@register(
    "search_queries",
    rf"""
    WITH s AS (SELECT s_suppkey, s_name, CASE s_suppkey % 4 WHEN 0 THEN '' WHEN 1 THEN 'https://www.a' || s_suppkey || '.com/' WHEN 2 THEN 'b' || s_suppkey || '.in/x/y' END AS site FROM supplier),
    d AS (SELECT *, string_split(regexp_replace(trim(regexp_replace(coalesce(site, ''), 'https?://', '', 'g')), '^www\.', ''), '/')[1] AS host FROM s)
    SELECT s_suppkey AS company, CASE WHEN host <> '' THEN 'site:' || host || ' filetype:pdf {SITE_TERMS} ' ELSE s_name || ' filetype:pdf {NAME_TERMS} ' END || '2023 {NEGATIVES}' AS query FROM d
    """,
)
def search_queries(spark, sf_dir):
    k = F.col("s_suppkey")
    site = F.when(k % 4 == 0, "").when(k % 4 == 1, F.concat(F.lit("https://www.a"), k.cast("string"), F.lit(".com/"))).when(k % 4 == 2, F.concat(F.lit("b"), k.cast("string"), F.lit(".in/x/y")))
    return table(spark, sf_dir, "supplier").select(k.alias("company"), search_query(F.col("s_name"), site, F.lit("2023-24")).alias("query"))


class _Results(HTMLParser):
    """Links and titles of blocks <div class="g">: the first link to a site, and the first <h3>."""

    def __init__(self):
        super().__init__()
        self.found: list[list[str | None]] = []
        self.depth, self.titled = 0, False

    def handle_starttag(self, tag, attrs):
        given = dict(attrs)
        if self.depth:
            self.depth += tag == "div"
            block = self.found[-1]
            if tag == "a" and block[0] is None and (given.get("href") or "").startswith("http"):
                block[0] = given["href"]
            if tag == "h3" and block[1] is None:
                block[1], self.titled = "", True
        elif tag == "div" and "g" in (given.get("class") or "").split():
            self.depth = 1
            self.found.append([None, None])

    def handle_endtag(self, tag):
        if self.depth and tag == "div":
            self.depth -= 1
        if tag == "h3":
            self.titled = False

    def handle_data(self, data):
        if self.titled:
            self.found[-1][1] += data.strip()


def search_results(pages: DataFrame, most: int = 10) -> DataFrame:
    """(page_id, place, link, title) of the first ``most`` result blocks of stored search pages (page_id, html); blocks without both are left out."""

    def parse(html: str | None) -> list[tuple[int, str, str]]:
        parser = _Results()
        parser.feed(html or "")
        return [(k, link, title) for k, (link, title) in enumerate(parser.found[:most]) if link and title is not None]

    @F.pandas_udf("array<struct<place:int,link:string,title:string>>")
    def parsed(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for html in parts:
            yield html.map(lambda x: [dict(zip(("place", "link", "title"), r, strict=True)) for r in parse(x)])

    return pages.select("page_id", F.explode(parsed("html")).alias("r")).select("page_id", "r.*")


@register(
    "search_results",
    """
    SELECT page_id, k - 1 AS place, url || '/' || k AS link, 'Report ' || k || ' of' || page_id AS title FROM pages, range(1, 4) t(k) WHERE k <> page_id % 5
    """,
)
def search_results_query(spark, sf_dir):
    """Result blocks of search pages, made of the pages' addresses; one block of some pages has no title."""
    block = lambda k: F.concat(F.lit('<div class="x g"><div><a href="/no">n</a><a href="'), "url", F.lit(f'/{k}">'), F.when(F.col("page_id") % 5 == k, "").otherwise(F.concat(F.lit(f"<h3>Report {k} of<b>"), F.col("page_id").cast("string"), F.lit("</b></h3>"))), F.lit("</a></div></div>"))
    pages = table(spark, sf_dir, "pages").select("page_id", F.concat(F.lit("<html><body>"), *(block(k) for k in (1, 2, 3)), F.lit("</body>")).alias("html"))
    return search_results(pages).select("page_id", F.col("place").cast("long").alias("place"), "link", "title")


def significant_words(name: Column, common: list[str]) -> Column:
    """Words of a name in lower case without marks at their ends, of over two letters, that say something of the company."""
    bare = F.transform(T.words(name), lambda w: F.regexp_replace(w, "[.,;:]+$", ""))
    return F.filter(F.transform(F.filter(bare, lambda w: F.length(w) > 2), F.lower), lambda w: ~w.isin(common))


def _count_in(words: Column, text: Column) -> Column:
    return F.size(F.filter(words, lambda w: F.contains(text, w)))


def report_verdict(n_pages: Column, texts: Column, company: Column, year: Column, title_score: Column) -> Column:
    """(ok, reason) for a downloaded report: ``texts`` are those of its first 15 pages, in order.

    Long reports and those with phrases of annual reports are refused. A title that is
    sure enough passes without text, or with the year anywhere and the company; else the
    year and the company must stand on the first two pages, and the parts that every
    disclosure has somewhere.
    """

    def judge(v: Column) -> Column:
        whole, cover, words, name = v["whole"], v["cover"], v["words"], F.lower(company)
        start = F.substring_index(year, "-", 1)
        listed = F.concat(F.lit("['"), F.array_join(words, "', '"), F.lit("']"))
        on_cover, anywhere, n = _count_in(words, cover), _count_in(words, whole), F.size(words)
        first = F.element_at(words, 1)
        verdict = lambda ok, *reason: F.struct(F.lit(ok).alias("ok"), F.concat(*(x if isinstance(x, Column) else F.lit(x) for x in reason)).alias("reason"))
        no = lambda *reason: verdict(False, *reason)
        out = F.when(n_pages > MOST_PAGES, no("Page count ", n_pages.cast("string"), " too high for standalone BRSR (>200)"))
        for pill in POISON:
            out = out.when(whole.contains(pill), no(f"Found Poison Pill: '{pill}' (Looks like Annual Report)"))
        lost = ~F.contains(cover, name)
        sure = (
            F.when(F.length(T.strip(whole)) < 50, verdict(True, "Success: High confidence title + Scanned PDF (Bypass text check)"))
            .when(~F.contains(whole, start), no("High Confidence Failed: Year ", start, " not found anywhere in 15 pages"))
            .when(lost & (n >= 2) & (on_cover < 2) & (anywhere < n), no("High Confidence Failed: Company name mismatch (required: ", listed, ", found on cover: ", on_cover.cast("string"), ", found anywhere: ", anywhere.cast("string"), ")"))
            .when(lost & (n == 1) & ~F.contains(cover, first), no("High Confidence Failed: Company word '", first, "' not found on cover page"))
            .when(lost & (n == 0) & ~F.contains(whole, name), no("High Confidence Failed: Full company name '", company, "' not found"))
            .otherwise(verdict(True, "Success: High confidence title + Company verified"))
        )
        strict = (
            F.when(~F.contains(cover, start), no("Strict Check Failed: Year not found on Cover (Pages 1-2)"))
            .when(lost & (n >= 2) & (on_cover < 2), no("Strict Check Failed: Company name not found on cover (required: ", listed, ", found: ", on_cover.cast("string"), ")"))
            .when(lost & (n == 1) & ~F.contains(cover, first), no("Strict Check Failed: Company word '", first, "' not found on cover"))
            .when(lost & (n == 0), no("Strict Check Failed: Full company name '", company, "' not found on cover"))
            .when(~whole.contains("section a") | ~whole.contains("principle"), no("Strict Check Failed: Missing BRSR DNA (Section A / Principle)"))
            .otherwise(verdict(True, "Success: Passed Strict Forensic Check"))
        )
        return out.when(title_score >= SURE_TITLE, sure).otherwise(strict)

    read = F.struct(
        F.lower(F.array_join(F.slice(texts, 1, 15), "")).alias("whole"), F.lower(F.array_join(F.slice(texts, 1, 2), "")).alias("cover"), significant_words(company, MORE_COMMON_WORDS).alias("words"),
    )
    return T.let(read, judge)


_STARTS = ["Annual of Alpha Beta Limited 2023 Section A principle ", "2023 alpha ", "profit and loss account 2023 ", "Gamma Ltd. in 2023 ", "", "2022 Alpha Beta section a ", "Limited 2023 "]
_COMPANIES = ["Alpha Beta Limited", "Gamma Ltd.", "India Limited", "Beta Solutions Delta"]


def _sql_words(name: str, common: list[str]) -> str:
    listed = ", ".join(map(S.quoted, common))
    return f"list_filter(list_transform(list_filter(list_transform({S.words(name)}, lambda w: regexp_replace(w, '[.,;:]+$', '')), lambda w: length(w) > 2), lambda w: lower(w)), lambda w: w NOT IN ({listed}))"


@register(
    "reports_validated",
    f"""
    WITH r AS (SELECT conv_id AS doc_id, CASE WHEN conv_id % 17 = 0 THEN 250 ELSE count(*) END AS n_pages, [{', '.join(map(S.quoted, _COMPANIES))}][conv_id % {len(_COMPANIES)} + 1] AS company, CASE WHEN conv_id % 2 = 0 THEN 100 ELSE 20 END AS score,
                      [{', '.join(map(S.quoted, _STARTS))}][conv_id % {len(_STARTS)} + 1] AS s, list(CASE WHEN conv_id % 11 = 4 THEN '' ELSE text END ORDER BY turn) AS ts FROM conversations GROUP BY conv_id),
    v AS (SELECT *, lower(s || array_to_string(ts[1:15], '')) AS whole, lower(s || array_to_string(ts[1:2], '')) AS cover, {_sql_words('company', MORE_COMMON_WORDS)} AS words, lower(company) AS name FROM r),
    c AS (SELECT *, len(words) AS n, len(list_filter(words, lambda w: contains(cover, w))) AS oc, len(list_filter(words, lambda w: contains(whole, w))) AS aw, '[''' || array_to_string(words, ''', ''') || ''']' AS listed, NOT contains(cover, name) AS lost FROM v),
    j AS (SELECT doc_id, CASE WHEN n_pages > 200 THEN 'Page count ' || n_pages || ' too high for standalone BRSR (>200)' {' '.join(f"WHEN contains(whole, {S.quoted(p)}) THEN {S.quoted(f'Found Poison Pill: {chr(39)}{p}{chr(39)} (Looks like Annual Report)')}" for p in POISON)}
      WHEN score >= 100 THEN CASE WHEN length({S.strip('whole')}) < 50 THEN 'Success: High confidence title + Scanned PDF (Bypass text check)' WHEN NOT contains(whole, '2023') THEN 'High Confidence Failed: Year 2023 not found anywhere in 15 pages'
        WHEN lost AND n >= 2 AND oc < 2 AND aw < n THEN 'High Confidence Failed: Company name mismatch (required: ' || listed || ', found on cover: ' || oc || ', found anywhere: ' || aw || ')'
        WHEN lost AND n = 1 AND NOT contains(cover, words[1]) THEN 'High Confidence Failed: Company word ''' || words[1] || ''' not found on cover page'
        WHEN lost AND n = 0 AND NOT contains(whole, name) THEN 'High Confidence Failed: Full company name ''' || company || ''' not found' ELSE 'Success: High confidence title + Company verified' END
      WHEN NOT contains(cover, '2023') THEN 'Strict Check Failed: Year not found on Cover (Pages 1-2)'
      WHEN lost AND n >= 2 AND oc < 2 THEN 'Strict Check Failed: Company name not found on cover (required: ' || listed || ', found: ' || oc || ')'
      WHEN lost AND n = 1 AND NOT contains(cover, words[1]) THEN 'Strict Check Failed: Company word ''' || words[1] || ''' not found on cover'
      WHEN lost AND n = 0 THEN 'Strict Check Failed: Full company name ''' || company || ''' not found on cover'
      WHEN NOT contains(whole, 'section a') OR NOT contains(whole, 'principle') THEN 'Strict Check Failed: Missing BRSR DNA (Section A / Principle)' ELSE 'Success: Passed Strict Forensic Check' END AS reason FROM c)
    SELECT doc_id, starts_with(reason, 'Success') AS ok, reason FROM j
    """,
)
def reports_validated(spark, sf_dir):
    """Whether each downloaded report is the disclosure that was looked for, and why not."""
    k = F.col("conv_id")
    text = F.when(k % 11 == 4, "").otherwise(F.col("text"))
    reports = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.count("*").alias("n"), F.transform(F.array_sort(F.collect_list(F.struct("turn", text.alias("t")))), lambda x: x["t"]).alias("ts"))
    pick = lambda xs: F.element_at(F.array(*map(F.lit, xs)), (k % len(xs) + 1).cast("int"))
    texts = F.concat(F.array(F.concat(pick(_STARTS), F.element_at("ts", 1))), F.slice("ts", 2, 20))
    verdict = report_verdict(F.when(k % 17 == 0, 250).otherwise(F.col("n")), texts, pick(_COMPANIES), F.lit("2023-24"), F.when(k % 2 == 0, 100).otherwise(20))
    return reports.select(k.alias("doc_id"), verdict.alias("v")).select("doc_id", "v.ok", "v.reason")


def is_company_of(text: Column, company: Column, symbol: Column) -> Column:
    """Whether a text is about the company that it was matched with: its name stands in the first part, or enough of its words, or its name anywhere."""
    low, name = F.lower(text), F.lower(company)
    first, words = F.substring(low, 1, FIRST_PART), significant_words(company, COMMON_WORDS)
    n = F.size(words)
    return F.coalesce(
        F.when(F.length(T.strip(text)) < 50, False).when(F.upper(F.coalesce(symbol, F.lit(""))).isin(AMBIGUOUS_SYMBOLS), F.contains(first, name)).when(F.contains(first, name), True)
        .when((n >= 2) & (_count_in(words, first) >= 2), True).when(n == 1, F.contains(first, F.element_at(words, 1))).otherwise(F.contains(low, name)),
        F.lit(False),
    )


#: Companies whose names are sent to the tasks at once; more go in several rounds.
SLICE = 50_000


def companies_by_name(docs: DataFrame, found: DataFrame, slice_rows: int = SLICE) -> DataFrame:
    """(doc_id, place, score): the company (place, company_name) that each text (doc_id, text) names best; of equal ones the least place.

    A full name on the first page counts 1000 and its length, two neighbouring
    significant words there 500 and their length, all of them there 400 and 10 for each,
    two there and all anywhere 200 and 5 for each, a single one there 300. Names without
    significant words, and those of a single generic one, must stand in full somewhere.
    All names and words are looked for at once by an Aho-Corasick automaton, so a text is
    read once for each slice of the registry, and what is sent to the tasks is bounded.
    Null texts name nobody.
    """
    import ahocorasick

    wanted = found.select("place", F.lower(T.strip(F.col("company_name"))).alias("name"), significant_words(F.col("company_name"), MORE_COMMON_WORDS).alias("words")).filter(~F.col("name").isin(BLACKLISTED) & (F.col("name") != ""))
    total = wanted.count()
    numbered = wanted.withColumn("__slice", F.pmod(F.xxhash64("name"), F.lit(max(1, -(-total // slice_rows)))))
    kind = docs.schema["doc_id"].dataType.simpleString()
    parts = []
    for k in range(max(1, -(-total // slice_rows))):
        rows = numbered.filter(F.col("__slice") == k).select("place", "name", "words").toArrow().to_pylist()
        sent = docs.sparkSession.sparkContext.broadcast(rows)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            automaton, touched = ahocorasick.Automaton(), {}
            for row in sent.value:  # noqa: B023
                for phrase in {row["name"], *row["words"], *map(" ".join, zip(row["words"], row["words"][1:], strict=False))}:
                    touched.setdefault(phrase, []).append(row)
            for phrase in touched:
                automaton.add_word(phrase, phrase)
            if touched:
                automaton.make_automaton()
            seen = lambda t: {p for _, p in automaton.iter(t)} if touched else set()  # noqa: E731, B023
            for batch in batches:
                out = []
                for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                    low = (text or "").lower()
                    first, anywhere = seen(low[:FIRST_PAGE]), seen(low)
                    best = None
                    for row in {id(r): r for p in anywhere for r in touched[p]}.values():
                        score = _name_score(row["name"], row["words"], first, anywhere)
                        if score and (best is None or (-score, row["place"]) < best):
                            best = -score, row["place"]
                    if best:
                        out.append((doc, best[1], -best[0]))
                columns = list(zip(*out, strict=True)) or [()] * 3
                types = [batch.schema.field("doc_id").type, pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["doc_id", "place", "score"])

        parts.append(docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, place long, score long"))
    hits = reduce(DataFrame.unionByName, parts)
    return hits.groupBy("doc_id").agg(F.min(F.struct((-F.col("score")).alias("less"), "place")).alias("b")).select("doc_id", "b.place", (-F.col("b.less")).alias("score"))


def _name_score(name: str, words: list[str], first: set[str], anywhere: set[str]) -> int:
    if name in first:
        return 1000 + len(name)
    if not words or words[1:] == [] and words[0] in GENERIC_NAMES:
        return len(name) if name in anywhere else 0
    if len(words) == 1:
        return 300 if words[0] in first else 0
    pair = next((p for p in map(" ".join, zip(words, words[1:], strict=False)) if p in first), None)
    here = sum(w in first for w in words)
    if pair:
        return 500 + len(pair)
    if here == len(words):
        return 400 + 10 * here
    return 200 + 5 * len(words) if here >= 2 and all(w in anywhere for w in words) else 0


_SQL_NAMED = f"""
    i AS (SELECT item_id AS place, [regexp_extract(text, '^[^ ]+ [^ ]+'), 'Bank Limited', regexp_extract(text, '^[^ ]+') || ' India Ltd.', 'BSE Limited', regexp_extract(text, '^[^ ]+ [^ ]+ [^ ]+') || ' Corp.'][item_id % 5 + 1] AS company_name FROM benchmark),
    w AS (SELECT place, company_name, lower({S.strip('company_name')}) AS name, {_sql_words('company_name', MORE_COMMON_WORDS)} AS words FROM i WHERE lower({S.strip('company_name')}) NOT IN ({', '.join(map(S.quoted, BLACKLISTED))})),
    d AS (SELECT doc_id, text, lower(text) AS t, lower(text[1:{FIRST_PAGE}]) AS f FROM documents),
    m AS (SELECT doc_id, place, company_name, text, CASE WHEN contains(f, name) THEN 1000 + length(name)
            WHEN len(words) = 0 OR (len(words) = 1 AND words[1] IN ({', '.join(map(S.quoted, GENERIC_NAMES))})) THEN CASE WHEN contains(t, name) THEN length(name) END
            WHEN len(words) = 1 THEN CASE WHEN contains(f, words[1]) THEN 300 END
            ELSE coalesce(500 + length(list_filter(list_transform(range(1, len(words)), lambda k: words[k] || ' ' || words[k + 1]), lambda p: contains(f, p))[1]),
                 CASE WHEN len(list_filter(words, lambda x: contains(f, x))) = len(words) THEN 400 + 10 * len(words)
                      WHEN len(list_filter(words, lambda x: contains(f, x))) >= 2 AND len(list_filter(words, lambda x: contains(t, x))) = len(words) THEN 200 + 5 * len(words) END) END AS score FROM d CROSS JOIN w),
    b AS (SELECT * FROM m WHERE score > 0 QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, place) = 1)
"""


def _named_companies(spark, sf_dir) -> DataFrame:
    words = lambda n: F.regexp_extract("text", "^" + " ".join(["[^ ]+"] * n), 0)
    name = F.element_at(F.array(words(2), F.lit("Bank Limited"), F.concat(words(1), F.lit(" India Ltd.")), F.lit("BSE Limited"), F.concat(words(3), F.lit(" Corp."))), (F.col("item_id") % 5 + 1).cast("int"))
    return table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("place"), name.alias("company_name"))


@register("companies_named", f"WITH {_SQL_NAMED} SELECT doc_id, place, score::BIGINT AS score FROM b")
def companies_named(spark, sf_dir):
    """The company that each text names best; beginnings of the benchmark's items stand in for names."""
    return companies_by_name(table(spark, sf_dir, "documents"), _named_companies(spark, sf_dir))


@register(
    "companies_verified",
    f"""
    WITH {_SQL_NAMED}, v AS (SELECT doc_id, place, lower(text) AS t, lower(text[1:{FIRST_PART}]) AS f, length({S.strip('text')}) AS n, lower(company_name) AS name, {_sql_words('company_name', COMMON_WORDS)} AS words FROM b)
    SELECT doc_id, place, CASE WHEN n < 50 THEN false WHEN place % 9 = 0 THEN contains(f, name) WHEN contains(f, name) THEN true WHEN len(words) >= 2 AND len(list_filter(words, lambda x: contains(f, x))) >= 2 THEN true
           WHEN len(words) = 1 THEN contains(f, words[1]) ELSE contains(t, name) END AS verified FROM v
    """,
)
def companies_verified(spark, sf_dir):
    """Whether texts are about the companies that they were matched with."""
    docs, named = table(spark, sf_dir, "documents"), _named_companies(spark, sf_dir)
    matched = companies_by_name(docs, named).join(F.broadcast(named) if named.count() <= SLICE else named, "place")
    symbol = F.when(F.col("place") % 9 == 0, "NSE").otherwise("X")
    return matched.join(docs.select("doc_id", "text"), "doc_id").select("doc_id", "place", is_company_of(F.col("text"), F.col("company_name"), symbol).alias("verified"))
