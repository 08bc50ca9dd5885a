"""Queries on lines, pages and paragraphs of documents."""

from __future__ import annotations

import difflib
import re
import unicodedata
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from loamwork.functions import text as T
from loamwork.operators.dealing import dealt
from loamwork.plans import sql as S
from loamwork.plans.documents import table
from loamwork.plans.registry import register

def _text_query(name, sql, change):
    """A query that changes each whole text and returns its md5."""

    @register(name, f"SELECT doc_id, md5({sql}) AS text_md5 FROM documents")
    def run(spark, sf_dir):
        return table(spark, sf_dir, "documents").select("doc_id", F.md5(change(F.col("text"))).alias("text_md5"))

    run.__name__ = name


_text_query("printable_lines", S.keep_printable("text"), T.keep_printable)
_text_query("noise_removed", S.remove_noise("text"), T.remove_noise)
_text_query("space_collapsed", S.collapse_space("text"), T.collapse_space)
_text_query("plain_typography", S.replace_typography("text"), T.replace_typography)
_text_query("table_placeholders", S.fill_empty_cells("text"), T.fill_empty_cells)
_text_query(
    "long_or_blank_lines",
    S.kept_lines("text", lambda x: f"{S.is_blank(x)} OR length({S.strip(x)}) >= 3"),
    lambda t: F.array_join(F.filter(F.split(t, "\n", -1), lambda x: T.is_blank(x) | (F.length(T.strip(x)) >= 3)), "\n"),
)
_text_query(
    "english_lines",
    S.kept_lines("text", lambda x: f"length({S.strip(x)}) < 3 OR {S.printable_ratio(x)} >= 0.7::DOUBLE"),
    lambda t: F.array_join(F.filter(F.split(t, "\n", -1), lambda x: (F.length(T.strip(x)) < 3) | T.is_mostly_english(x)), "\n"),
)
_text_query(
    "nlp_clean",
    r"trim(regexp_replace(regexp_replace(regexp_replace(lower(text), '[^\s]+@[^\s]+', ' ', 'g'), 'https?://[^\s]+|www\.[^\s]+', ' ', 'g'), '\s+', ' ', 'g'))",
    lambda t: F.trim(F.regexp_replace(F.regexp_replace(F.regexp_replace(F.lower(t), r"[^\s]+@[^\s]+", " "), r"https?://[^\s]+|www\.[^\s]+", " "), r"\s+", " ")),
)
#: Characters of a text that topic models on single words read; more would only slow them down.
TOPIC_CHARS = 50_000
_MARKS = [(r"\b(19|20)[0-9]{2}\b", ""), (r"(?i)\bfy[0-9]{2,4}\b", ""), (r"(?i)\bpage [0-9]+\b", ""), (r"\b[0-9]+\b", "")]
_text_query(
    "years_and_page_marks_dropped",
    reduce(lambda t, m: S.replaced(t, *m), _MARKS, f"text[1:{TOPIC_CHARS}]"),
    lambda t: reduce(lambda c, m: F.regexp_replace(c, *m), _MARKS, F.substring(t, 1, TOPIC_CHARS)),
)


@register("broken_lines_merged", f"SELECT doc_id, len(string_split(t, chr(10)))::BIGINT AS n_lines, md5(t) AS text_md5 FROM (SELECT doc_id, {S.merge_broken_lines('text')} AS t FROM documents)")
def broken_lines_merged(spark, sf_dir):
    """Short lines without an end mark take a next line that begins in lower case, pair by pair; row by row, nothing is shuffled."""
    merged = table(spark, sf_dir, "documents").select("doc_id", T.merge_broken_lines(F.col("text")).alias("t"))
    return merged.select("doc_id", F.size(F.split("t", "\n", -1)).cast("long").alias("n_lines"), F.md5("t").alias("text_md5"))


#: What the test texts lack is put before them: split words, reversed and mashed lines, tables, rules, broken sentences.
_DIRTY = ["KeyHighlights FY24\n", "the total was raised by\nnine percent in the yeaR\n", "a |  | tropeR launnA\n-------\n***\n", "environ-\nment \u2014 caf\u00e9\x0cpage\n", ""]


@register(
    "clean_texts",
    "WITH " + ", ".join(
        f"c{k + 1} AS (SELECT doc_id, {step('t')} AS t FROM c{k})" for k, step in enumerate(S.CLEANING)
    ).replace("c1 AS", f"c0 AS (SELECT doc_id, [{', '.join(S.quoted(x) for x in _DIRTY)}][doc_id % {len(_DIRTY)} + 1] || text AS t FROM documents), c1 AS", 1)
    + f" SELECT doc_id, length(t) AS chars, md5(t) AS text_md5 FROM c{len(S.CLEANING)}",
)
def clean_texts(spark, sf_dir):
    """Whole texts after all repairs in their fixed order; row by row, nothing is shuffled."""
    before = F.element_at(F.array(*map(F.lit, _DIRTY)), (F.col("doc_id") % len(_DIRTY) + 1).cast("int"))
    cleaned = table(spark, sf_dir, "documents").select("doc_id", T.clean_text(F.concat(before, "text")).alias("t"))
    return cleaned.select("doc_id", F.length("t").cast("long").alias("chars"), F.md5("t").alias("text_md5"))


@register(
    "page_edges",
    r"""
    WITH l AS (SELECT conv_id, turn, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i FROM conversations),
    f AS (SELECT conv_id, turn, i, trim(line) AS line FROM l WHERE length(trim(line)) > 3),
    r AS (SELECT *, row_number() OVER (PARTITION BY conv_id, turn ORDER BY i) AS a, row_number() OVER (PARTITION BY conv_id, turn ORDER BY i DESC) AS b FROM f)
    SELECT conv_id AS doc_id, turn AS page, line, a <= 3 AS is_first, b <= 3 AS is_last FROM r WHERE a <= 3 OR b <= 3
    """,
)
def page_edges(spark, sf_dir):
    """The first and last three lines of each page that are longer than three characters; arrays, no window."""
    lines = F.filter(F.transform(F.split("text", "\n", -1), lambda x: F.trim(x)), lambda x: F.length(x) > 3)
    pages = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("doc_id"), F.col("turn").alias("page"), lines.alias("x"), F.size(lines).alias("n"))
    return pages.select("doc_id", "page", "n", F.posexplode("x").alias("i", "line")).select(
        "doc_id", "page", "line", (F.col("i") < 3).alias("is_first"), (F.col("i") >= F.col("n") - 3).alias("is_last")
    ).filter("is_first OR is_last")


@register(
    "page_text_types",
    f"""
    WITH p AS (SELECT conv_id, CASE WHEN conv_id % 11 = 0 THEN NULL WHEN conv_id % 5 = 0 THEN text[1:60] ELSE text END AS text, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS k FROM conversations),
    n AS (SELECT conv_id, k, length({S.strip('text')}) AS n FROM p)
    SELECT conv_id AS doc_id, count(*) FILTER (n > 100) AS with_text, CASE WHEN count(n) = 0 THEN 'unknown' WHEN 2 * count(*) FILTER (n > 100) >= count(*) THEN 'text' ELSE 'scanned' END AS kind
    FROM n WHERE k <= 10 GROUP BY conv_id
    """,
)
def page_text_types(spark, sf_dir):
    """Text or scanned, by the share of the first ten pages with over 100 characters; unknown where no page could be read."""
    first = Window.partitionBy("conv_id").orderBy("turn")
    text = F.when(F.col("conv_id") % 11 == 0, F.lit(None)).when(F.col("conv_id") % 5 == 0, F.substring("text", 1, 60)).otherwise(F.col("text"))
    pages = table(spark, sf_dir, "conversations").select("conv_id", F.length(T.strip(text)).alias("n"), F.row_number().over(first).alias("k")).filter("k <= 10")
    full = F.count_if(F.col("n") > 100)
    return pages.groupBy(F.col("conv_id").alias("doc_id")).agg(
        full.alias("with_text"), F.when(F.count("n") == 0, "unknown").when(2 * full >= F.count("*"), "text").otherwise("scanned").alias("kind")
    )


# Characters that should not stand in a text, and unusual ones.
CONTROL = r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]"
UNUSUAL = r"[\x{2000}-\x{20CF}]"


def kinds_of(t, pattern):
    """How many different characters of the pattern a text has."""
    return F.size(F.array_distinct(F.regexp_extract_all(t, F.lit(f"({pattern})"), 1))).cast("long")


@register(
    "encoding_issues",
    rf"""
    WITH d AS (SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN chr(1) || chr(12) || chr(1) WHEN 1 THEN chr(65533) WHEN 2 THEN chr(8212) || chr(8364) ELSE '' END || text AS t FROM documents)
    SELECT doc_id, contains(t, chr(0)) AS has_nul, len(list_distinct(regexp_extract_all(t, '{CONTROL}')))::BIGINT AS control_kinds, length(t) - length(replace(t, chr(65533), '')) AS replacements,
           len(list_distinct(regexp_extract_all(t, '{UNUSUAL}')))::BIGINT AS unusual_kinds FROM d
    """,
)
def encoding_issues(spark, sf_dir):
    """What is wrong with the characters of each text; some are put before them."""
    k = F.col("doc_id") % 4
    before = F.when(k == 0, "\x01\x0c\x01").when(k == 1, "\ufffd").when(k == 2, "\u2014\u20ac").otherwise("")
    t = F.col("t")
    return table(spark, sf_dir, "documents").select("doc_id", F.concat(before, "text").alias("t")).select(
        "doc_id", t.contains("\x00").alias("has_nul"), kinds_of(t, CONTROL).alias("control_kinds"),
        (F.length(t) - F.length(F.replace(t, F.lit("\ufffd"), F.lit("")))).cast("long").alias("replacements"), kinds_of(t, UNUSUAL).alias("unusual_kinds"),
    )


#: Character classes by the pattern of what is not in them.
CLASSES = {"letters": r"[^\p{L}]", "digits": r"[^\p{Nd}]", "spaces": T.SPACE.replace("[", "[^", 1), "punctuation": r"[\p{L}\p{N}]|" + T.SPACE}


@register(
    "extraction_differences",
    f"""
    WITH b AS (SELECT doc_id, text AS a, {S.replaced('text', '[0-9,]+| +$', '')} AS b FROM documents),
    c AS (SELECT doc_id, length(a) AS chars, length(b) AS other_chars, {', '.join(f"length({S.replaced('a', p, '')}) AS {k}, length({S.replaced('b', p, '')}) AS other_{k}" for k, p in CLASSES.items())} FROM b)
    SELECT *, CASE WHEN chars > 0 THEN round((chars - other_chars) * 100.0::DOUBLE / chars, 6) ELSE 0.0 END AS difference,
           CASE WHEN chars = 0 OR abs(chars - other_chars) * 100.0::DOUBLE / chars < 5 THEN 'excellent' WHEN abs(chars - other_chars) * 100.0::DOUBLE / chars < 10 THEN 'good' ELSE 'issues' END AS verdict FROM c
    """,
)
def extraction_differences(spark, sf_dir):
    """Characters by class of two extractions of each text (the other one lacks digits and commas), their difference in percent and what that says."""
    b = F.regexp_replace("text", "[0-9,]+| +$", "")
    both = table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("a"), b.alias("b"))
    n = lambda c, p: F.length(F.regexp_replace(c, p, "")).cast("long")
    counted = both.select(
        "doc_id", F.length("a").cast("long").alias("chars"), F.length("b").cast("long").alias("other_chars"),
        *(x for k, p in CLASSES.items() for x in (n("a", p).alias(k), n("b", p).alias(f"other_{k}"))),
    )
    # a division by zero would raise, also where an empty text's share is not used
    share = F.try_divide((F.col("chars") - F.col("other_chars")) * 100.0, F.col("chars"))
    some = F.col("chars") > 0
    verdict = F.when(~some | (F.abs(share) < 5), "excellent").when(F.abs(share) < 10, "good").otherwise("issues")
    return counted.select("*", F.when(some, F.round(share, 6)).otherwise(0.0).alias("difference"), verdict.alias("verdict"))


@register(
    "text_samples",
    """
    WITH p AS (SELECT conv_id, list(text ORDER BY turn) AS x, count(*) AS n FROM conversations GROUP BY conv_id)
    SELECT conv_id AS doc_id, unnest([0, 1, 2, 3, 4])::BIGINT AS place, md5(unnest([x[1], x[n // 4 + 1], x[n // 2 + 1], x[3 * n // 4 + 1], x[n]])) AS text_md5 FROM p
    """,
)
def text_samples(spark, sf_dir):
    """Five pages of each report, at the quarters; small reports repeat some."""
    pages = table(spark, sf_dir, "conversations").groupBy(F.col("conv_id").alias("doc_id")).agg(F.array_sort(F.collect_list(F.struct("turn", "text"))).alias("x"))
    at = F.expr("transform(array(0, size(x) div 4, size(x) div 2, 3 * size(x) div 4, size(x) - 1), i -> get(x, cast(i AS int)).text)")
    return pages.select("doc_id", F.posexplode(at).alias("place", "text")).select("doc_id", F.col("place").cast("long").alias("place"), F.md5("text").alias("text_md5"))


@register(
    "paragraph_chunks",
    """
    WITH t AS (SELECT conv_id, string_agg(text, chr(10) || chr(10) ORDER BY turn) AS text FROM conversations GROUP BY conv_id),
    p AS (SELECT conv_id, unnest(string_split(text, chr(10) || chr(10))) AS x, generate_subscripts(string_split(text, chr(10) || chr(10)), 1) AS k FROM t)
    SELECT conv_id AS doc_id, k AS paragraph, length(trim(x)) AS chars, md5(trim(x)) AS text_md5 FROM p WHERE length(trim(x)) >= 100
    """,
)
def paragraph_chunks(spark, sf_dir):
    """Paragraphs of at least 100 characters; numbers count the shorter ones too."""
    pages = table(spark, sf_dir, "conversations").groupBy(F.col("conv_id").alias("doc_id")).agg(F.array_sort(F.collect_list(F.struct("turn", "text"))).alias("x"))
    whole = F.array_join(F.transform("x", lambda p: p["text"]), "\n\n")
    parts = pages.select("doc_id", F.posexplode(F.split(whole, "\n\n", -1)).alias("k", "p")).withColumn("p", F.trim("p")).filter(F.length("p") >= 100)
    return parts.select("doc_id", (F.col("k") + 1).cast("long").alias("paragraph"), F.length("p").cast("long").alias("chars"), F.md5("p").alias("text_md5"))


_PAGE_MARK = re.compile(r"\d+|page \d+", re.IGNORECASE)
SHARE, SIMILAR = 0.7, 0.85


#: Values of the hash by which pairs of neighbouring characters are counted.
PAIRS = 512


def common_subsequence(a: str, b: str) -> int:
    """Length of the longest common subsequence, with a bit for each character of ``b``."""
    places: dict[str, int] = {}
    for k, c in enumerate(b):
        places[c] = places.get(c, 0) | 1 << k
    whole = left = (1 << len(b)) - 1
    for c in a:
        u = left & places.get(c, 0)
        left = ((left + u) | (left - u)) & whole
    return len(b) - left.bit_count()


def _alike(a: str, b: str) -> bool:
    """Whether the ratio of difflib is enough; what it matches is a common subsequence, so it is only asked if that is long enough."""
    return a == b or (2 * common_subsequence(a, b) >= SIMILAR * (len(a) + len(b)) - 1e-9 and difflib.SequenceMatcher(None, a, b).ratio() >= SIMILAR)


def _pairs(line: str) -> np.ndarray:
    """How many pairs of neighbouring characters a line has of each hash."""
    c = np.frombuffer(line.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    return np.bincount((c[:-1] * 31 + c[1:]) % PAIRS, minlength=PAIRS).astype(np.int32)


class Lines:
    """Lines with what it takes to tell, without a comparison, which of them cannot be alike.

    Two lines with m matched characters of n in both have at most n - 2m + 1 blocks of
    them, so at least 3m - n - 1 pairs of neighbours in common; lines that are alike have
    2m >= SIMILAR * n. Only pairs of lines that these bounds allow need to be compared.
    """

    def __init__(self, lines: Iterable[str] = ()) -> None:
        self.lines: list[str] = []
        self._sizes, self._pairs = np.zeros(16, np.int64), np.zeros((16, PAIRS), np.int32)
        for line in lines:
            self.add(line)

    def add(self, line: str) -> None:
        n = len(self.lines)
        if n == len(self._sizes):
            self._sizes, self._pairs = np.concatenate([self._sizes, np.zeros_like(self._sizes)]), np.concatenate([self._pairs, np.zeros_like(self._pairs)])
        self._sizes[n], self._pairs[n] = len(line), _pairs(line)
        self.lines.append(line)

    def near(self, line: str) -> list[int]:
        """Places of the lines that may be like the line."""
        n = len(self.lines)
        both = self._sizes[:n] + len(line)
        able = np.flatnonzero(2 * np.minimum(self._sizes[:n], len(line)) >= SIMILAR * both - 1e-9)
        shared = np.minimum(self._pairs[able], _pairs(line)).sum(1)
        return able[shared + 1 >= (1.5 * SIMILAR - 1) * both[able] - 1e-9].tolist()


def repeated_edges(pages: list[str], share: float = SHARE) -> set[str]:
    """Lines like those that edge most pages: headers from the first three lines of over three characters, footers from the last three.

    A line joins the first group whose leader it resembles. A group with as many lines
    that resemble one of its own as ``share`` of the pages is repeated, so a single page
    loses its edges. Distinct lines are compared, each with its number of places, and only
    where Lines does not rule it out.
    """
    found = set()
    for edge in (slice(0, 3), slice(-3, None)):
        count: dict[str, int] = {}
        for page in pages:
            for line in [x.strip() for x in page.split("\n") if len(x.strip()) > 3][edge]:
                count[line] = count.get(line, 0) + 1
        leaders, groups = Lines(), []
        for line in count:
            at = next((k for k in leaders.near(line) if _alike(leaders.lines[k], line)), len(groups))
            if at == len(groups):
                leaders.add(line)
                groups.append([])
            groups[at].append(line)
        every, places = Lines(count), [*count.values()]
        for group in groups:
            left = {g: every.near(g) for g in group}
            if sum(places[k] for k in {k for near in left.values() for k in near}) < share * len(pages):
                continue
            like: set[int] = set()
            for g, near in left.items():
                like.update(k for k in near if k not in like and _alike(every.lines[k], g))
            if sum(places[k] for k in like) >= share * len(pages):
                found.update(group)
    return found


def without_edges(page: str, repeated: set[str] | Lines) -> str:
    """The page without lines that resemble repeated ones, and without page numbers."""
    known = repeated if isinstance(repeated, Lines) else Lines(repeated)
    return "\n".join(x for x in page.split("\n") if not (_PAGE_MARK.fullmatch(x.strip()) or any(_alike(x.strip(), known.lines[k]) for k in known.near(x.strip()))))


@register("headers_removed")
def headers_removed(spark, sf_dir):
    """Each report's pages, cleaned, without headers and footers that repeat on its raw pages.

    Texts are cleaned by Column functions; one report at a time is compared in pandas.
    """

    def run(report: pd.DataFrame) -> pd.DataFrame:
        report = report.sort_values("page")
        repeated = Lines(repeated_edges(report["raw"].fillna("").tolist()))
        return report.assign(text=[without_edges(x, repeated) for x in report["text"].fillna("")])[["doc_id", "page", "text"]]

    pages = dealt(table(spark, sf_dir, "conversations"), "conv_id").select(F.col("conv_id").alias("doc_id"), F.col("turn").alias("page"), F.col("text").alias("raw"), T.clean_text(F.col("text")).alias("text"))
    return pages.groupBy("doc_id").applyInPandas(run, "doc_id long, page long, text string")


@register("compatible_text")
def compatible_text(spark, sf_dir):
    """Whole texts in Unicode form NFKC with plain typography (Spark has no such function)."""

    @F.pandas_udf("string")
    def nfkc(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for t in parts:
            yield t.map(lambda x: x if x is None else unicodedata.normalize("NFKC", x))

    return table(spark, sf_dir, "documents").select("doc_id", F.md5(T.replace_typography(nfkc("text"))).alias("text_md5"))
