"""Queries on the structure of reports: headings, nested sections, and where sections begin and end.

Conversations stand in for reports, their turns for pages. Since their texts have no
headings, some lines are put before the pages, alike in both engines.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loamwork.functions import text as T
from loamwork.operators.dealing import dealt
from loamwork.plans import sql as S
from loamwork.plans.documents import table
from loamwork.plans.registry import register

# Phrases that begin a section, by its kind, and phrases that end any.
SECTION_WORDS = {
    "mdna": [
        "management discussion and analysis", "management's discussion and analysis", "managements discussion and analysis", "md&a", "md a", "mda", "financial review",
    ],
    "letter_to_stakeholders": [
        "letter to stakeholders", "letter to shareholders", "chairman's letter", "chairmans letter", "chairman's message", "chairmans message", "ceo message", "ceo's message",
        "message from the chairman", "message from the ceo", "president's message", "letter from the chairman", "letter from the ceo", "dear stakeholders", "dear shareholders",
    ],
}
END_WORDS = [
    "financial statements", "consolidated financial statements", "notes to financial statements", "auditor's report", "auditors report", "independent auditor", "balance sheet",
    "income statement", "cash flow statement", "statement of financial position",
]

# Patterns of pages on which the disclosure report begins, of tables of contents, and of pages on which it has ended.
START_TITLES = [
    r"business\s+responsibility\s+and\s+sustainability\s+report", r"brsr\s+report", r"business\s+responsibility\s+report", r"standalone\s+brsr",
    r"business\s+responsibility\s+and\s+sustainability",
]
CONTENTS = [r"table\s+of\s+contents", "contents", "index"]
END_TITLES = [
    r"independent\s+auditor['s]?\s+report", r"auditor['s]?\s+report", r"standalone\s+financial\s+statements", r"consolidated\s+financial\s+statements", r"financial\s+statements",
    r"balance\s+sheet", r"statement\s+of\s+profit\s+and\s+loss", r"profit\s+and\s+loss\s+account", r"cash\s+flow\s+statement", r"notes\s+to\s+financial\s+statements", r"notes\s+to\s+accounts",
]

#: Paragraphs of a section have more characters than this.
LEAST_PARAGRAPH = 20

_BLOCK = "array<struct<block:int,heading:string,level:int,confidence:int,line_index:int,content:array<string>>>"


def _any(patterns: Iterable[str]) -> str:
    return "|".join(patterns)


def heading_blocks(text: Column, lines: Column, phrases: Iterable[str] = T.HEADING_WORDS) -> Column:
    """A report's headings with the paragraphs up to the next one, as an array; without headings all paragraphs lie under 'Content'.

    ``lines``: a column that holds the split text. Paragraphs are parted by blank lines,
    their lines joined by spaces; short ones are left out, but not where there is no
    heading. Text before the first heading belongs to none.
    """
    marked = F.transform(lines, lambda x, i: F.struct(i.alias("i"), T.heading(x, F.get(lines, i - 1), F.get(lines, i + 1), phrases).alias("h")))
    found = F.filter(marked, lambda x: x["h"]["confidence"] >= 50)

    def content(first: Column, last: Column) -> Column:
        part = F.array_join(F.transform(F.slice(lines, first + 1, F.greatest(last - first, F.lit(0))), T.strip), "\n")
        paragraphs = F.transform(F.split(F.regexp_replace(part, r"^\n+|\n+$", ""), "\n\n+", -1), lambda p: F.replace(p, F.lit("\n"), F.lit(" ")))
        return F.filter(paragraphs, lambda p: F.length(p) > LEAST_PARAGRAPH)

    def blocks(hs: Column) -> Column:
        return F.transform(
            hs,
            lambda x, k: F.struct(
                k.alias("block"), T.strip(F.get(lines, x["i"])).alias("heading"), x["h"]["level"].alias("level"), x["h"]["confidence"].alias("confidence"), x["i"].alias("line_index"),
                content(x["i"] + 1, F.coalesce(F.get(hs, k + 1)["i"], F.size(lines))).alias("content"),
            ),
        )

    whole = F.filter(F.transform(F.split(text, "\n\n", -1), T.strip), lambda p: p != "")
    none = F.array(F.struct(F.lit(0).alias("block"), F.lit("Content").alias("heading"), F.lit(1).alias("level"), F.lit(None).cast("int").alias("confidence"), F.lit(None).cast("int").alias("line_index"), whole.alias("content")))
    return T.let(T.let(found, blocks), lambda made: F.when(F.size(made) > 0, made.cast(_BLOCK)).otherwise(none.cast(_BLOCK)))


def report_blocks(reports: DataFrame, phrases: Iterable[str] = T.HEADING_WORDS) -> DataFrame:
    """doc_id and blocks of every report (doc_id, text), row by row; a null text has no blocks."""
    split = reports.select("doc_id", "text", F.split("text", "\n", -1).alias("lines"))
    return split.select("doc_id", heading_blocks(F.col("text"), F.col("lines"), phrases).alias("blocks"))


def with_parents(blocks: DataFrame) -> DataFrame:
    """Rows of blocks (doc_id, block, level, ...) with parent: the nearest earlier block of a smaller level, of levels 1 to 3.

    Only narrow rows of a report's headings are gathered, never its text.
    """
    before = Window.partitionBy("doc_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    nearest = lambda k: F.last(F.when(F.col("level") < k, F.col("block")), ignorenulls=True).over(before)
    marked = blocks.withColumns({"__p2": nearest(2), "__p3": nearest(3)})
    return marked.withColumn("parent", F.when(F.col("level") == 2, F.col("__p2")).when(F.col("level") == 3, F.col("__p3"))).drop("__p2", "__p3")


def nested_json(blocks: Column) -> Column:
    """JSON text of blocks nested by their levels: heading, level, content and, where there are any, subsections."""
    parent = F.transform(
        blocks,
        lambda b: F.coalesce(F.array_max(F.transform(F.filter(blocks, lambda o: (o["block"] < b["block"]) & (o["level"] < b["level"])), lambda o: o["block"])), F.lit(-1)),
    )

    def level(inner):
        def made(b: Column) -> Column:
            own = F.regexp_replace(F.to_json(F.struct(b["heading"].alias("heading"), b["level"].alias("level"), b["content"].alias("content"))), r"\}$", "")
            if inner is None:
                return F.concat(own, F.lit("}"))
            below = F.filter(blocks, lambda o: F.get(parent, o["block"]) == b["block"])
            return F.concat(own, F.when(F.size(below) > 0, F.concat(F.lit(',"subsections":['), F.array_join(F.transform(below, inner), ","), F.lit("]"))).otherwise(""), F.lit("}"))

        return made

    deepest = level(level(level(None)))
    return F.concat(F.lit("["), F.array_join(F.transform(F.filter(blocks, lambda b: F.get(parent, b["block"]) == -1), deepest), ","), F.lit("]"))


def report_json(reports: DataFrame, section: str = "Full Report", confidence: float = 1.0) -> DataFrame:
    """doc_id and json of every report (doc_id, company, year, text, start_page, end_page): the nested structure with its metadata."""
    rows = reports.select("doc_id", "company", "year", "start_page", "end_page", "text", F.split("text", "\n", -1).alias("lines"))
    rows = rows.withColumn("blocks", heading_blocks(F.col("text"), F.col("lines")))
    found = F.filter("blocks", lambda b: b["line_index"].isNotNull())
    metadata = F.struct(
        F.size(found).alias("total_headings"), F.array_sort(F.array_distinct(F.transform(found, lambda b: b["level"]))).alias("heading_levels"), F.length("text").alias("character_count"),
        F.aggregate("blocks", F.lit(0), lambda n, b: n + F.size(b["content"])).alias("paragraph_count"),
    )
    top = F.struct("company", "year", F.lit(section).alias("section"), "start_page", "end_page", F.lit(confidence).alias("confidence"))
    return rows.select("doc_id", F.concat(F.regexp_replace(F.to_json(top), r"\}$", ""), F.lit(',"structure":'), nested_json(F.col("blocks")), F.lit(',"metadata":'), F.to_json(metadata), F.lit("}")).alias("json"))


#: Lines before the pages that stand in for reports, by (report + page) modulo their number.
_BEFORE = [
    "BUSINESS OVERVIEW\n", " \nRisk Management And Outlook\nfirst paragraph of the section goes\non here for long enough\n\nshort\n", "",
    "2. Growth Strategy:\nas said before, this one is about what the company wants to do in all of its markets and why\n", "Page 12\nKey Results Of The Year For All Business Segments In The Whole Group:\n",
]


def _before() -> Column:
    return F.element_at(F.array(*map(F.lit, _BEFORE)), ((F.col("conv_id") + F.col("turn")) % len(_BEFORE) + 1).cast("int"))


_SQL_PAGES = f"SELECT conv_id, turn, CASE WHEN conv_id % 7 = 6 THEN text ELSE [{', '.join(map(S.quoted, _BEFORE))}][(conv_id + turn) % {len(_BEFORE)} + 1] || text END AS text FROM conversations"
_SQL_REPORTS = f"SELECT conv_id AS doc_id, string_agg(text, chr(10) || chr(10) ORDER BY turn) AS t FROM ({_SQL_PAGES}) GROUP BY conv_id"


def _stand_in_pages(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", F.when(F.col("conv_id") % 7 == 6, F.col("text")).otherwise(F.concat(_before(), "text")).alias("text"))


def joined_pages(pages: DataFrame) -> DataFrame:
    """doc_id and text of every report: its pages (conv_id, turn, text) in order, blank lines between. A report is one row; reports are dealt by the number of their pages."""
    ordered = F.array_sort(F.collect_list(F.struct("turn", "text")))
    return dealt(pages, "conv_id").groupBy(F.col("conv_id").alias("doc_id")).agg(F.array_join(F.transform(ordered, lambda p: p["text"]), "\n\n").alias("text"))


@register(
    "report_headings",
    f"SELECT doc_id, line_index::BIGINT AS line_index, md5(line) AS line_md5, confidence::BIGINT AS confidence, level::BIGINT AS level FROM {S.headings(f'({_SQL_REPORTS})')} WHERE confidence >= 50",
)
def report_headings(spark, sf_dir):
    """Headings of each report with their confidence and level; arrays in each row, no window over lines."""
    reports = joined_pages(_stand_in_pages(spark, sf_dir)).select("doc_id", F.split("text", "\n", -1).alias("lines"))
    marked = F.transform("lines", lambda x, i: F.struct(i.alias("i"), T.strip(x).alias("line"), T.heading(x, F.get("lines", i - 1), F.get("lines", i + 1)).alias("h")))
    found = reports.select("doc_id", F.explode(F.filter(marked, lambda x: x["h"]["confidence"] >= 50)).alias("x"))
    return found.select("doc_id", F.col("x.i").cast("long").alias("line_index"), F.md5("x.line").alias("line_md5"), F.col("x.h.confidence").cast("long").alias("confidence"), F.col("x.h.level").cast("long").alias("level"))


_SQL_BLOCKS = f"""
    r AS ({_SQL_REPORTS}), h AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY line_index) - 1 AS block, lead(line_index) OVER (PARTITION BY doc_id ORDER BY line_index) AS next FROM {S.headings("r")} WHERE confidence >= 50),
    c AS (SELECT h.*, string_split(t, chr(10))[line_index + 2 : coalesce(next, len(string_split(t, chr(10))))] AS part FROM h JOIN r USING (doc_id)),
    j AS (SELECT *, {S.replaced(f"array_to_string(list_transform(part, lambda x: {S.strip('x')}), chr(10))", "^\n+|\n+$", "")} AS body FROM c),
    b AS (SELECT doc_id, block, line AS heading, level, list_filter(list_transform(regexp_split_to_array(body, '\n\n+'), lambda p: replace(p, chr(10), ' ')), lambda p: length(p) > {LEAST_PARAGRAPH}) AS content FROM j
          UNION ALL SELECT doc_id, 0, 'Content', 1, list_filter(list_transform(string_split(t, chr(10) || chr(10)), lambda p: {S.strip('p')}), lambda p: p <> '') FROM r WHERE doc_id NOT IN (SELECT doc_id FROM h))
"""


@register(
    "report_hierarchy",
    f"""
    WITH {_SQL_BLOCKS},
    p AS (SELECT *, last_value(CASE WHEN level < 2 THEN block END IGNORE NULLS) OVER w AS p2, last_value(CASE WHEN level < 3 THEN block END IGNORE NULLS) OVER w AS p3 FROM b
          WINDOW w AS (PARTITION BY doc_id ORDER BY block ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
    SELECT doc_id, block::BIGINT AS block, md5(heading) AS heading_md5, level::BIGINT AS level, (CASE level WHEN 2 THEN p2 WHEN 3 THEN p3 END)::BIGINT AS parent,
           len(content)::BIGINT AS paragraphs, md5(array_to_string(content, chr(10))) AS content_md5 FROM p
    """,
)
def report_hierarchy(spark, sf_dir):
    """Sections of each report: the paragraphs of each heading, and the section it lies in."""
    blocks = report_blocks(joined_pages(_stand_in_pages(spark, sf_dir))).select("doc_id", F.explode("blocks").alias("b"))
    rows = blocks.select(
        "doc_id", F.col("b.block").cast("long").alias("block"), F.md5("b.heading").alias("heading_md5"), F.col("b.level").cast("long").alias("level"),
        F.size("b.content").cast("long").alias("paragraphs"), F.md5(F.array_join("b.content", "\n")).alias("content_md5"),
    )
    return with_parents(rows)


@register(
    "report_metadata",
    f"""
    WITH {_SQL_BLOCKS}, n AS (SELECT doc_id, sum(len(content))::BIGINT AS paragraph_count FROM b GROUP BY doc_id),
    m AS (SELECT doc_id, count(*) AS total_headings, array_to_string(list_sort(list_distinct(list(level))), ',') AS heading_levels FROM h GROUP BY doc_id)
    SELECT doc_id, coalesce(total_headings, 0) AS total_headings, coalesce(heading_levels, '') AS heading_levels, length(t) AS character_count, paragraph_count FROM r JOIN n USING (doc_id) LEFT JOIN m USING (doc_id)
    """,
)
def report_metadata(spark, sf_dir):
    """What the JSON of each report says about it, read back from that JSON."""
    pages = _stand_in_pages(spark, sf_dir)
    reports = joined_pages(pages).select("doc_id", "text", F.lit("c").alias("company"), F.lit("2023-24").alias("year"), F.lit(1).alias("start_page"), F.lit(9).alias("end_page"))
    read = F.from_json("json", "metadata struct<total_headings:bigint,heading_levels:array<int>,character_count:bigint,paragraph_count:bigint>")["metadata"]
    return report_json(reports).select("doc_id", read.alias("m")).select("doc_id", "m.total_headings", F.array_join("m.heading_levels", ",").alias("heading_levels"), "m.character_count", "m.paragraph_count")


# Blocks of a layout: one for each line of a page, with a place and a size


def upper_median(x: Column) -> Column:
    """The element in the middle of the sorted values, of two the greater one."""
    return F.element_at(F.sort_array(x), F.floor(F.size(x) / 2).cast("int") + 1)


def normal_text(t: Column) -> Column:
    """Lower case, marks as spaces, single spaces."""
    return T.strip(F.regexp_replace(F.regexp_replace(F.lower(t), rf"[^\p{{L}}\p{{N}}_]", " "), f"{T.SPACE}+", " "))


def boundary_candidates(blocks: DataFrame) -> DataFrame:
    """Blocks (doc_id, page, place, text, font, y) that may be headings, with their normal text and the ratio of their font to the page's upper median.

    A heading has up to 120 characters, lies in the upper part of the page and is a tenth
    larger than the median. Only sizes are gathered for each page.
    """
    medians = blocks.groupBy("doc_id", "page").agg(upper_median(F.collect_list("font")).alias("median"))
    near = blocks.join(medians, ["doc_id", "page"])
    able = (F.length(F.col("text")) <= 120) & (F.col("y") <= 300) & (F.col("font") >= F.col("median") * 1.1)
    ratio = F.when(F.col("median") > 0, F.col("font") / F.col("median")).otherwise(F.lit(1.0))
    return near.filter(able).select("doc_id", "page", "place", "text", "y", normal_text(F.col("text")).alias("normal"), ratio.alias("ratio"))


def section_confidence(normal: Column, phrase: Column, ratio: Column, y: Column, size: Column) -> Column:
    """Hundredths for how surely a heading with the phrase begins a section."""
    total = (
        F.lit(50) + F.when(normal == phrase, 30).when(normal.startswith(phrase) | normal.endswith(phrase), 20).otherwise(10) + F.when(ratio > 1.5, 15).when(ratio > 1.2, 10).otherwise(0)
        + F.when(y < 150, 10).when(y < 250, 5).otherwise(0) + F.when(size < 50, 5).otherwise(0)
    )
    return F.least(total, F.lit(100))


def section_boundaries(blocks: DataFrame) -> DataFrame:
    """doc_id, section, start_page, end_page, confidence, start_heading: of each kind of section that a report has.

    The surest heading begins it, of equal ones the first. It ends on the page before
    the first later page with a heading that ends any section or begins one of another
    kind, else with the last page.
    """
    able = boundary_candidates(blocks)
    last = blocks.groupBy("doc_id").agg(F.max("page").alias("last_page"))
    kinds = []
    for kind, phrases in SECTION_WORDS.items():
        first = F.element_at(F.filter(F.array(*map(F.lit, phrases)), lambda p: F.contains(F.col("normal"), p)), 1)
        with_phrase = able.withColumn("phrase", F.when(T.contains_any(F.col("normal"), phrases), first)).filter("phrase IS NOT NULL")
        sure = section_confidence(F.col("normal"), F.col("phrase"), F.col("ratio"), F.col("y"), F.length("text"))
        best = with_phrase.groupBy("doc_id").agg(F.min(F.struct((-sure).alias("less"), "page", "place", "text")).alias("b"))
        others = [p for k, ps in SECTION_WORDS.items() if k != kind for p in ps]
        ends = able.filter(T.contains_any(F.col("normal"), [*END_WORDS, *others])).select("doc_id", F.col("page").alias("at"))
        begun = best.select("doc_id", F.col("b.page").alias("start_page"), (-F.col("b.less")).alias("confidence"), F.col("b.text").alias("start_heading"))
        later = begun.join(ends, "doc_id").filter("at > start_page").groupBy("doc_id").agg((F.min("at") - 1).alias("before_end"))
        made = begun.join(later, "doc_id", "left").join(last, "doc_id")
        kinds.append(made.select("doc_id", F.lit(kind).alias("section"), "start_page", F.coalesce("before_end", F.greatest("last_page", "start_page")).alias("end_page"), F.col("confidence").cast("long").alias("confidence"), "start_heading"))
    return reduce(DataFrame.unionByName, kinds)


#: Headings on the pages that stand in for reports, by (3 * report + page) modulo their number.
_HEADS = [
    "Management Discussion and Analysis", "", "Our Letter to Shareholders, 2024", "", "Independent Auditor's Report", "Notes", "MD&A of the year: financial review of all that was done in it, as told by those who did it", "",
]


def _stand_in_blocks(spark, sf_dir) -> DataFrame:
    head = F.element_at(F.array(*map(F.lit, _HEADS)), ((F.col("conv_id") * 3 + F.col("turn")) % len(_HEADS) + 1).cast("int"))
    pages = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("doc_id"), F.col("turn").alias("page"), F.posexplode(F.concat(F.array(head), F.split("text", "\n", -1))).alias("place", "text"))
    font = F.when(F.col("place") == 0, 11.0 + F.col("doc_id") % 6).otherwise(10.0)
    y = F.when(F.col("place") == 0, 100.0 + F.col("page") * 30).otherwise(F.col("place") * 20.0 + 200)
    return pages.filter(T.strip(F.col("text")) != "").select("doc_id", "page", "place", "text", font.alias("font"), y.alias("y"))


_SQL_LAYOUT = f"""
    q AS (SELECT conv_id AS doc_id, turn AS page, list_concat([[{', '.join(map(S.quoted, _HEADS))}][(conv_id * 3 + turn) % {len(_HEADS)} + 1]], string_split(text, chr(10))) AS ls FROM conversations),
    e AS (SELECT doc_id, page, generate_subscripts(ls, 1) - 1 AS place, unnest(ls) AS text FROM q),
    k AS (SELECT *, CASE WHEN place = 0 THEN 11.0::DOUBLE + doc_id % 6 ELSE 10.0::DOUBLE END AS font, CASE WHEN place = 0 THEN 100.0::DOUBLE + page * 30 ELSE place * 20.0::DOUBLE + 200 END AS y FROM e WHERE {S.strip('text')} <> ''),
    md AS (SELECT doc_id, page, list_sort(list(font))[count(*) // 2 + 1] AS median FROM k GROUP BY doc_id, page),
    able AS (SELECT k.*, font / median AS ratio, {S.strip(S.replaced(S.replaced('lower(text)', '[^\\p{L}\\p{N}_]', ' '), S.SPACE + '+', ' '))} AS normal FROM k JOIN md USING (doc_id, page) WHERE length(text) <= 120 AND y <= 300 AND font >= median * 1.1::DOUBLE)
"""


def _sql_section(kind: str) -> str:
    phrases, others = SECTION_WORDS[kind], [p for k, ps in SECTION_WORDS.items() if k != kind for p in ps]
    phrase = "CASE " + " ".join(f"WHEN contains(normal, {S.quoted(p)}) THEN {S.quoted(p)}" for p in phrases) + " END"
    return f"""
      SELECT s.doc_id, '{kind}' AS section, s.page AS start_page, coalesce((SELECT min(o.page) - 1 FROM able o WHERE o.doc_id = s.doc_id AND o.page > s.page AND {S.contains_any('o.normal', [*END_WORDS, *others])}),
             (SELECT max(z.page) FROM k z WHERE z.doc_id = s.doc_id)) AS end_page, s.confidence::BIGINT AS confidence, s.text AS start_heading
      FROM (SELECT *, least(100, 50 + CASE WHEN normal = phrase THEN 30 WHEN starts_with(normal, phrase) OR suffix(normal, phrase) THEN 20 ELSE 10 END + CASE WHEN ratio > 1.5 THEN 15 WHEN ratio > 1.2 THEN 10 ELSE 0 END
                   + CASE WHEN y < 150 THEN 10 WHEN y < 250 THEN 5 ELSE 0 END + CASE WHEN length(text) < 50 THEN 5 ELSE 0 END) AS confidence
            FROM (SELECT *, {phrase} AS phrase FROM able) WHERE phrase IS NOT NULL
            QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY confidence DESC, page, place) = 1) s
    """


@register("section_bounds", f"WITH {_SQL_LAYOUT} {' UNION ALL '.join(_sql_section(k) for k in SECTION_WORDS)}")
def section_bounds(spark, sf_dir):
    """Where the discussion and the letter of each report begin and end, by headings of the layout."""
    return section_boundaries(_stand_in_blocks(spark, sf_dir))


def sections_of(pages: DataFrame, bounds: DataFrame) -> DataFrame:
    """doc_id, section, start_page, end_page, page_count and text of sections: pages (doc_id, page, text) from the first to the last, joined."""
    inside = pages.join(bounds.select("doc_id", "section", "start_page", "end_page"), "doc_id").filter("page BETWEEN start_page AND end_page")
    ordered = F.array_sort(F.collect_list(F.struct("page", "text")))
    return inside.groupBy("doc_id", "section", "start_page", "end_page").agg(F.count("*").alias("page_count"), F.array_join(F.transform(ordered, lambda p: p["text"]), "\n\n").alias("text"))


@register(
    "section_contents",
    f"""
    WITH {_SQL_LAYOUT}, s AS ({' UNION ALL '.join(_sql_section(k) for k in SECTION_WORDS)}),
    kinds AS (SELECT unnest([{', '.join(map(S.quoted, SECTION_WORDS))}]) AS section), ids AS (SELECT DISTINCT conv_id AS doc_id FROM conversations),
    t AS (SELECT s.doc_id, s.section, count(*) AS page_count, string_agg(c.text, chr(10) || chr(10) ORDER BY c.turn) AS text FROM s JOIN conversations c ON c.conv_id = s.doc_id AND c.turn BETWEEN start_page AND end_page GROUP BY ALL)
    SELECT doc_id, section, array_to_string(list_transform(string_split(section, '_'), lambda w: upper(w[1]) || w[2:]), ' ') AS title, start_page, end_page, page_count, length(text) AS character_count, md5(text) AS text_md5, CASE WHEN start_page IS NULL THEN 'Section not found in document' END AS note
    FROM ids CROSS JOIN kinds LEFT JOIN s USING (doc_id, section) LEFT JOIN t USING (doc_id, section)
    """,
)
def section_contents(spark, sf_dir):
    """Every kind of section of every report: its pages and text, or a note that it was not found."""
    pages = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("doc_id"), F.col("turn").alias("page"), "text")
    found = sections_of(pages, section_boundaries(_stand_in_blocks(spark, sf_dir)))
    wanted = pages.select("doc_id").distinct().select("doc_id", F.explode(F.array(*map(F.lit, SECTION_WORDS))).alias("section"))
    return wanted.join(found, ["doc_id", "section"], "left").select(
        "doc_id", "section", F.initcap(F.replace("section", F.lit("_"), F.lit(" "))).alias("title"), "start_page", "end_page", "page_count", F.length("text").cast("long").alias("character_count"), F.md5("text").alias("text_md5"),
        F.when(F.col("start_page").isNull(), "Section not found in document").alias("note"),
    )


def is_start_page(t: Column) -> Column:
    """Whether the disclosure report begins on a page: its title stands there, and not only in a table of contents."""
    n, low = F.length(T.strip(t)), F.lower(t)
    listed = low.rlike(_any(CONTENTS)) & (n < 500)
    return F.coalesce((n >= 50) & low.rlike(_any(START_TITLES)) & ~listed & ((n > 300) | F.lower(F.substring(t, 1, 500)).rlike(_any(START_TITLES))), F.lit(False))


def is_end_page(t: Column) -> Column:
    """Whether a page begins the financial statements: one of their titles stands in its first part."""
    return F.coalesce((F.length(T.strip(t)) >= 50) & F.lower(F.substring(t, 1, 1000)).rlike(_any(END_TITLES)), F.lit(False))


def disclosure_ranges(pages: DataFrame) -> DataFrame:
    """doc_id, start_page, end_page of the disclosure report inside each annual report (doc_id, page, text): from its first page up to the page before the financial statements, else to the end."""
    flags = pages.select("doc_id", "page", is_start_page(F.col("text")).alias("starts"), is_end_page(F.col("text")).alias("ends"))
    start = flags.groupBy("doc_id").agg(F.min(F.when(F.col("starts"), F.col("page"))).alias("start_page"), F.max("page").alias("last_page")).filter("start_page IS NOT NULL")
    ends = start.join(flags.filter("ends").select("doc_id", "page"), "doc_id").filter("page > start_page").groupBy("doc_id").agg((F.min("page") - 1).alias("before_end"))
    return start.join(ends, "doc_id", "left").select("doc_id", "start_page", F.coalesce("before_end", "last_page").alias("end_page"))


_TITLES = ["Contents: Business Responsibility Report 4\n", "Business Responsibility and Sustainability Report\n", "", "", "Notes to Accounts and Balance Sheet\n"]


@register(
    "disclosure_pages",
    f"""
    WITH p AS (SELECT conv_id AS doc_id, turn AS page, [{', '.join(map(S.quoted, _TITLES))}][(conv_id + turn) % {len(_TITLES)} + 1] || text AS t FROM conversations),
    f AS (SELECT *, length({S.strip('t')}) AS n FROM p),
    g AS (SELECT *, n >= 50 AND {S.matches('lower(t)', _any(START_TITLES))} AND NOT ({S.matches('lower(t)', _any(CONTENTS))} AND n < 500) AND (n > 300 OR {S.matches('lower(t[1:500])', _any(START_TITLES))}) AS starts,
                 n >= 50 AND {S.matches('lower(t[1:1000])', _any(END_TITLES))} AS ends FROM f),
    s AS (SELECT doc_id, min(page) FILTER (starts) AS start_page, max(page) AS last_page FROM g GROUP BY doc_id HAVING min(page) FILTER (starts) IS NOT NULL),
    e AS (SELECT s.doc_id, min(page) - 1 AS before_end FROM s JOIN g ON g.doc_id = s.doc_id AND g.ends AND page > start_page GROUP BY s.doc_id),
    r AS (SELECT doc_id, start_page, coalesce(before_end, last_page) AS end_page FROM s LEFT JOIN e USING (doc_id))
    SELECT r.doc_id, start_page, end_page, count(*) AS page_count, md5(string_agg(t, chr(10) || chr(10) ORDER BY page)) AS text_md5 FROM r JOIN p ON p.doc_id = r.doc_id AND page BETWEEN start_page AND end_page GROUP BY ALL
    """,
)
def disclosure_pages(spark, sf_dir):
    """The disclosure report inside each annual report: its pages and their text; titles are put before the pages."""
    title = F.element_at(F.array(*map(F.lit, _TITLES)), ((F.col("conv_id") + F.col("turn")) % len(_TITLES) + 1).cast("int"))
    pages = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("doc_id"), F.col("turn").alias("page"), F.concat(title, "text").alias("text"))
    bounds = disclosure_ranges(pages).withColumn("section", F.lit("disclosure"))
    return sections_of(pages, bounds).select("doc_id", "start_page", "end_page", "page_count", F.md5("text").alias("text_md5"))
