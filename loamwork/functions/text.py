"""Column functions on text: cleaning, repair, predicates and labels."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Replacements of typographic characters, made in this order after the compatible form.
REPLACEMENTS = {
    "\u2019": "'",
    "\u2018": "'",
    "\u201c": '"',
    "\u201d": '"',
    "\u2032": "'",
    "\u2033": '"',
    "\u2013": "-",
    "\u2014": "--",
    "\u2015": "--",
    "\u2212": "-",
    "\u00a0": " ",
    "\u2000": " ",
    "\u2001": " ",
    "\u2002": " ",
    "\u2003": " ",
    "\u2009": " ",
    "\u2022": "•",
    "\u25cf": "•",
    "\u25cb": "o",
    "\u2023": ">",
    "\u25aa": "▪",
    "\u25ab": "▫",
    "\u00ae": "(R)",
    "\u00a9": "(C)",
    "\u2122": "(TM)",
    "\u00b0": "deg",
    "\u00b1": "+/-",
    "\u00d7": "x",
    "\u00f7": "/",
}

# Legal suffixes, removed in this order.
COMPANY_SUFFIXES = [" Ltd.", " Limited", " Pvt Ltd", " Private Limited"]

# Keywords of the disclosure categories, by hits.
CATEGORY_WORDS = {
    "Environmental (E)": ["energy", "emission", "water", "waste", "climate", "environmental", "renewable", "solar", "biodiversity", "pollution", "carbon"],
    "Social (S)": ["safety", "health", "employee", "worker", "community", "education", "student", "wage", "human right", "diversity", "talent", "training"],
    "Governance (G)": ["governance", "risk", "compliance", "assurance", "board", "audit", "regulation", "policy", "stakeholder", "privacy", "cyber"],
}

# Keywords of the disclosure categories, where the first with a hit counts.
FIRST_CATEGORY_WORDS = {
    "Environmental (E)": ["energy", "emission", "water", "waste", "climate", "environmental"],
    "Social (S)": ["safety", "health", "employee", "worker", "community", "education"],
}

# Words that common words become when read backwards.
REVERSED_WORDS = [
    "eht", "rof", "dna", "si", "fo", "ot", "ni", "no", "ta", "eh", "ti", "latot", "etad", "eman", "srs", "sl", "rni", "sy", "tuo", "sa", "as",
    "tel", "hcum", "ylluf", "ecnegilletni", "gnissecorp", "tseb", "evah", "siht", "taht", "flesym", "yllanif", "gnidliub", "yllacificeps",
]

# Phrases that headings of a management discussion hold.
HEADING_WORDS = [
    "overview", "business overview", "industry overview", "financial performance", "financial review", "results of operations", "operating results",
    "segment analysis", "business segments", "revenue", "expenses", "profitability", "cash flow", "liquidity", "capital resources", "working capital",
    "risk", "risk factors", "risk management", "outlook", "future outlook", "forward looking", "strategy", "business strategy", "growth strategy",
    "opportunities", "challenges", "critical accounting",
]

# Phrases that headings of a letter to stakeholders hold.
LETTER_HEADING_WORDS = [
    "dear stakeholders", "dear shareholders", "dear investors", "year in review", "highlights", "achievements", "performance", "strategic initiatives",
    "vision", "mission", "values", "sustainability", "governance", "looking ahead", "future", "thank you", "acknowledgment",
]

#: White space of any kind, as a class of regular expressions.
SPACE = r"[\x09-\x0D\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
#: The same classes for Java, which asks every part of a class in turn: ranges that most characters are not in, or are in, come first.
_SPACE, _NOT_SPACE = rf"[\x09-\x20\x{{85}}-\x{{3000}}&&{SPACE}]", rf"[\x21-\x7E{SPACE.replace('[', '[^', 1)}]"
_SPACES = "".join(map(chr, (*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
#: A word of letters, digits and underscores, and what may follow one.
WORD = r"[\p{L}\p{N}_]+"
_AFTER = r"([^\p{L}\p{N}_]|$)"


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


#: Letters that have capitals of several letters, where one letter is to stay one; characters that take their place meanwhile; and what becomes of them.
_LONG = "".join(chr(k) for k in range(0x80, 0x10000) if len(chr(k).upper()) > 1)
_MEANWHILE = "".join(chr(0x10F000 + k) for k in range(len(_LONG)))
_CAPITALS = "".join("\u1e9e" if c == "\u00df" else c.title() if len(c.title()) == 1 else c for c in _LONG)


def upper(t: Column) -> Column:
    """In capitals, letter by letter, as DuckDB has it: a sharp s becomes one capital sharp s, not SS."""
    # most texts have no character of these ranges, and all of _LONG are in them
    return F.when(t.rlike(f"[{_LONG[0]}{_LONG[1]}-{_LONG[-1]}]"), F.translate(F.upper(F.translate(t, _LONG, _MEANWHILE)), _MEANWHILE, _CAPITALS)).otherwise(F.upper(t))


def lower(t: Column) -> Column:
    """In small letters, letter by letter, as DuckDB has it: a sigma is the same at the end of a word, a dotted I becomes i."""
    return F.lower(F.when(t.rlike("[\u0130\u03a3]"), F.translate(t, "\u0130\u03a3", "i\u03c3")).otherwise(t))


def strip(t: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.btrim(t, F.lit(_SPACES))


def words(t: Column) -> Column:
    """Runs without white space, as an array; none for blank text."""
    return F.array_remove(F.split(t, f"{_SPACE}+", -1), "")


def is_blank(t: Column) -> Column:
    return ~t.rlike(_NOT_SPACE)


def printable_ratio(t: Column) -> Column:
    """Share of printable ASCII characters; 1 for blank text."""
    return F.when(is_blank(t), F.lit(1.0)).otherwise(F.length(F.regexp_replace(t, r"[^\x20-\x7E]", "")) / F.length(t))


def is_mostly_english(t: Column, threshold: float = 0.7) -> Column:
    return printable_ratio(t) >= threshold


def fix_mashed_words(t: Column) -> Column:
    """Put spaces between lower and upper case, letters and digits, digits and letters."""
    # the rarer one of two characters is looked for, and then the other one beside it
    for pattern, to in (("[A-Z](?<=[a-z].)", " $0"), ("[0-9](?<=[A-Za-z].)", " $0"), ("[0-9](?=[A-Za-z])", "$0 ")):
        t = F.regexp_replace(t, pattern, to)
    return t


def fix_split_words(t: Column) -> Column:
    """Join words that a hyphen splits over two lines."""
    return let(t, lambda x: F.when(x.rlike(r"-\s*\n"), F.regexp_replace(x, r"([A-Za-z]{2,})-\s*\n\s*([A-Za-z]{2,})", "$1$2")).otherwise(x))


def per_line(t: Column, change) -> Column:
    return F.array_join(F.transform(F.split(t, "\n", -1), change), "\n")


def keep_printable(t: Column) -> Column:
    """Other characters become spaces, spaces collapse, lines stay."""
    return per_line(t, lambda x: F.trim(F.regexp_replace(F.regexp_replace(x, r"[^\x20-\x7E]", " "), " {2,}", " ")))


def merge_broken_lines(t: Column) -> Column:
    """Lines without white space at their ends; short ones without an end mark take a next line that begins in lower case.

    A line that was taken takes none itself, so lines merge pair by pair: matches of the
    pattern do not overlap and begin at line starts.
    """
    return F.regexp_replace(per_line(t, strip), r"(?md)^([^\n]{0,78}[^\n.!?:;])\n(\p{Ll}[^\n]*)", "$1 $2")


def orientation_score(cell: Column) -> Column:
    """0 to 1 for how much a stripped cell looks reversed: five signals, summed and capped."""
    found = lambda c: F.regexp_extract_all(c, F.lit(f"({WORD})"), 1)
    points = lambda c, n: F.when(c, F.lit(n)).otherwise(F.lit(0.0))
    share = lambda w: F.size(F.filter(w, lambda x: x.isin(REVERSED_WORDS))) / F.greatest(F.size(w), F.lit(1))

    def of(c: Column) -> Column:
        opens = c.rlike("^[.,;:]") & ~c.rlike("[.,!?;:]$") & (F.length(c) > 3)
        first = lambda b: 0.5 * b + points(b >= 0.3, 0.3) + points(opens, 0.4)
        capital_last = F.size(F.filter(found(c), lambda w: w.rlike("^[a-z]+[A-Z]$")))
        every = lambda b: F.lit(0.8) + 0.5 * b + points(b >= 0.3, 0.3) + points(opens, 0.4) + points(c.rlike(f"[a-z]{{3}}[A-Z]{_AFTER}"), 0.4) + 0.3 * F.least(capital_last, F.lit(3))
        # without a capital at the end of a word three of the signals are nothing
        total = let(share(found(F.lower(c))), lambda b: F.when(c.rlike(f"[a-z][A-Z]{_AFTER}"), every(b)).otherwise(first(b)))
        return F.when(F.length(c) < 2, F.lit(0.0)).otherwise(F.least(F.lit(1.0), total))

    return let(cell, of)


def righted(cell: Column, threshold: float = 0.35) -> Column:
    """(hit, text) of a cell: whether it looks reversed, and its stripped text the right way round."""
    return let(strip(cell), lambda c: let(orientation_score(c) >= threshold, lambda hit: F.struct(hit.alias("hit"), F.when(hit, F.reverse(c)).otherwise(c).alias("text"))))


def righted_lines(t: Column, threshold: float = 0.35) -> Column:
    """(hit, text) of every line: whether it, or one of its cells between pipes, looks reversed, and its text put right; blank lines stay."""

    def cells(x: Column) -> Column:
        joined = lambda r: F.struct(F.exists(r, lambda c: c["hit"]).alias("hit"), F.array_join(F.transform(r, lambda c: c["text"]), " | ").alias("text"))
        return let(F.transform(F.split(x, r"\|", -1), lambda c: righted(c, threshold)), joined)

    blank = lambda x: F.struct(F.lit(False).alias("hit"), x.alias("text"))
    return F.transform(F.split(t, "\n", -1), lambda x: F.when(is_blank(x), blank(x)).when(x.contains("|"), cells(x)).otherwise(righted(x, threshold)))


def fix_reversed(t: Column, threshold: float = 0.35) -> Column:
    """Lines, and cells of lines with pipes, are reversed back where they look reversed; blank lines stay."""
    return F.array_join(F.transform(righted_lines(t, threshold), lambda x: x["text"]), "\n")


def remove_noise(t: Column) -> Column:
    """Form feeds become line ends; invisible characters, rules of dashes and lines without a letter, digit or underscore go, blank lines stay."""
    for pattern, to in (("\f", "\n"), (r"[\x{200B}-\x{200F}\x{FEFF}]", ""), ("-{5,}", ""), ("_{5,}", "")):
        t = F.regexp_replace(t, pattern, to)
    return F.array_join(F.filter(F.split(t, "\n", -1), lambda x: is_blank(x) | x.rlike(r"[\p{L}\p{N}_]")), "\n")


def collapse_space(t: Column) -> Column:
    """Tabs become four spaces, lines with pipes lose white space at their ends, others all but single spaces; four or more line ends become two."""
    lines = per_line(F.replace(t, F.lit("\t"), F.lit("    ")), lambda x: F.when(x.contains("|"), strip(x)).otherwise(strip(F.regexp_replace(x, rf"{_SPACE}{{2,}}|[\x09-\x1F\x{{85}}-\x{{3000}}&&{SPACE}]", " "))))
    return F.regexp_replace(lines, "\n{4,}", "\n\n")


def replace_typography(t: Column) -> Column:
    replaced = lambda x: reduce(lambda c, kv: F.replace(c, F.lit(kv[0]), F.lit(kv[1])), REPLACEMENTS.items(), x)
    return let(t, lambda x: F.when(x.rlike(r"[^\x00-\x7F]"), replaced(x)).otherwise(x))


def fill_empty_cells(t: Column, placeholder: str = "N/A") -> Column:
    """Empty cells between pipes become the placeholder; lines without pipes stay."""
    cells = lambda x: F.array_join(F.transform(F.split(x, r"\|", -1), lambda c: F.when(is_blank(c), F.lit(placeholder)).otherwise(strip(c))), " | ")
    return per_line(t, lambda x: F.when(x.contains("|"), cells(x)).otherwise(x))


def clean_text(t: Column) -> Column:
    """All repairs in their fixed order.

    The first leaves printable ASCII and line ends alone, which the compatible form does
    not change, so that step needs no function of its own here.
    """
    steps = (keep_printable, fix_mashed_words, merge_broken_lines, fix_reversed, remove_noise, collapse_space, replace_typography, fix_split_words, fill_empty_cells)
    return reduce(lambda c, step: step(c), steps, t)


def clean_company_name(t: Column) -> Column:
    """Without legal suffixes, each taken off once in their order; null is empty."""
    return reduce(lambda c, suffix: strip(F.regexp_replace(c, suffix.replace(".", r"\.") + "$", "")), COMPANY_SUFFIXES, strip(F.coalesce(t, F.lit(""))))


def safe_file_name(t: Column) -> Column:
    """Separators become underscores, other marks that file systems refuse go, spaces become one underscore; 'Unknown' for none."""
    c = F.regexp_replace(F.regexp_replace(t, r"[/\\:]", "_"), r'[*?"<>|]', "")
    c = F.replace(F.regexp_replace(F.regexp_replace(strip(c), r"^\.+|\.+$", ""), f"{SPACE}+", " "), F.lit(" "), F.lit("_"))
    return F.when(F.coalesce(t, F.lit("")) == "", F.lit("Unknown")).otherwise(c)


def category_by_hits(keywords: Column) -> Column:
    """The category with most keyword hits; ties and no hits go to the first."""
    t = F.lower(keywords)
    hits = {c: reduce(lambda a, b: a + b, (t.contains(w).cast("int") for w in ws)) for c, ws in CATEGORY_WORDS.items()}
    e, s, g = hits.values()
    first, second, third = hits
    return F.when((e >= s) & (e >= g), F.lit(first)).when(s >= g, F.lit(second)).otherwise(F.lit(third))


def category_by_order(keywords: Column) -> Column:
    """The first category with a hit, else the last."""
    t = F.lower(keywords)
    (first, e), (second, s) = FIRST_CATEGORY_WORDS.items()
    return F.when(t.rlike("|".join(e)), F.lit(first)).when(t.rlike("|".join(s)), F.lit(second)).otherwise(F.lit([*CATEGORY_WORDS][-1]))


def contains_any(t: Column, phrases: Iterable[str]) -> Column:
    return reduce(lambda a, b: a | b, (t.contains(p) for p in phrases))


def heading(line: Column, before: Column, after: Column, phrases: Iterable[str] = HEADING_WORDS) -> Column:
    """(confidence in hundredths, level) of a line from its form and its neighbours; 0 for short lines and page numbers.

    A line is a heading from 50 on; only then its level says something. A line before it
    that has nothing but white space counts as a gap, one that has nothing does not.
    """
    def of(v: Column) -> Column:
        x, low, w = v["x"], v["low"], v["w"]
        n, upper = F.size(w), x.rlike(r"\p{Lu}") & ~x.rlike(r"\p{Ll}")
        titled = F.size(F.filter(w, lambda y: y.rlike(r"^\p{Lu}")))
        gap = (before != "") & is_blank(before) & (after != "") & (n <= 10)
        points = [
            (upper & (n >= 2), 40), ((n >= 2) & (titled >= n * F.lit(0.7)), 30), (contains_any(low, phrases), 25), ((n <= 8) & (F.size(words(after)) > 15), 20),
            (x.rlike(":$"), 15), (x.rlike(r"^[A-Z0-9]+[.)]" + SPACE + "+[A-Z]"), 25), (gap, 15),
        ]
        total = reduce(lambda a, b: a + b, (F.when(c, F.lit(k)).otherwise(F.lit(0)) for c, k in points))
        none = (F.length(x) < 3) | x.rlike(r"^(\p{Nd}+$|(?i:page) \p{Nd}+)")
        level = F.when(upper & (n <= 4), 1).when(n <= 6, 2).otherwise(3)
        return F.struct(F.when(none, 0).otherwise(total).alias("confidence"), level.alias("level"))

    return let(strip(line), lambda x: let(F.struct(x.alias("x"), F.lower(x).alias("low"), words(x).alias("w")), of))


def file_size(n: Column) -> Column:
    """Whole bytes in steps of 1024 with two decimals, half to even; whole numbers all the way, so nothing is lost."""
    n = n.cast("long")

    def written(k: int, unit: str) -> Column:
        step = F.lit(1024**k).cast("long")
        low, rest = F.floor(n * 100 / step), (n * 100) % step * 2
        cents = low + F.when((rest > step) | ((rest == step) & (low % 2 == 1)), 1).otherwise(0)
        return F.concat(F.floor(cents / 100).cast("string"), F.lit("."), F.lpad((cents % 100).cast("string"), 2, "0"), F.lit(f" {unit}"))

    out = written(4, "TB")
    for k, unit in reversed(list(enumerate(["B", "KB", "MB", "GB"]))):
        out = F.when(n < F.lit(1024 ** (k + 1)), written(k, unit)).otherwise(out)
    return out


def estimated_time(megabytes: Column, kind: Column) -> Column:
    """How long reading a file may take: half a minute a megabyte for scanned ones, a tenth for others."""
    minutes = F.when(kind == "scanned", megabytes * 0.5).otherwise(megabytes * 0.1)
    hours = F.concat(F.lit("~"), F.format_string("%.1f", minutes / 60), F.lit(" hours"))
    return F.when(minutes < 1, "< 1 minute").when(minutes < 60, F.concat(F.lit("~"), minutes.cast("int").cast("string"), F.lit(" minutes"))).otherwise(hours)


def century(t: Column) -> Column:
    """The first two digits of the first year in a text, else null."""
    found = F.regexp_extract(t, r"\b(19|20)[0-9]{2}\b", 1)
    return F.when(found != "", found)


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    """``part`` of ``whole`` in percent, half to even; 0 of nothing."""
    return F.coalesce(F.bround(F.try_divide(part * F.lit(100.0), whole), digits), F.lit(0.0))


def fiscal_years(t: Column) -> tuple[Column, Column]:
    """Start and end of 'YYYY-YY' or 'YYYY-YYYY'; nulls if it is neither."""
    start, end = F.regexp_extract(t, r"^(\d{4})-(\d{2}|\d{4})$", 1), F.regexp_extract(t, r"^(\d{4})-(\d{2}|\d{4})$", 2)
    return F.when(start != "", start.cast("int")), F.when(F.length(end) == 2, end.cast("int") + 2000).when(F.length(end) == 4, end.cast("int"))


def domain(url: Column) -> Column:
    return F.regexp_replace(F.regexp_extract(F.lower(url), r"^[a-z]+://([^/:?#]+)", 1), r"^www\.", "")
