"""Column functions on names of files and paths."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from loamwork.functions import text as T

# Words in the names of files.
STANDALONE, EMBEDDED, FROM_ANNUAL = "BRSR", "AnnualReport", "from_AnnualReport"
_ILLEGAL = r'[/\\:*?"<>|]'


def _literal(c: Column) -> Column:
    """As a replacement that stands for itself."""
    return F.regexp_replace(c, r"([\\$])", r"\\$1")


def report_file_name(company: Column, year: Column, standalone: Column, extension: str = "pdf") -> Column:
    """Name_BRSR_year or Name_AnnualReport_year."""
    return F.concat(T.safe_file_name(company), F.lit("_"), F.when(standalone, STANDALONE).otherwise(EMBEDDED), F.lit("_"), year, F.lit(f".{extension}"))


def with_placeholders(convention: Column, year: Column, symbol: Column, serial: Column) -> Column:
    """A naming convention with its placeholders filled in; an empty symbol and a null serial leave theirs."""
    has_symbol = F.coalesce(symbol, F.lit("")) != ""
    dated = F.regexp_replace(T.strip(convention), r"(?i)\{year\}", _literal(year))
    named = T.let(dated, lambda c: F.when(has_symbol, F.regexp_replace(c, r"(?i)\{symbol\}", _literal(F.coalesce(symbol, F.lit(""))))).otherwise(c))
    return T.let(named, lambda c: F.when(serial.isNotNull(), F.regexp_replace(c, r"(?i)\{serial(_number)?\}", F.coalesce(serial.cast("string"), F.lit("")))).otherwise(c))


def output_file_name(company: Column, year: Column, from_annual: Column, convention: Column, symbol: Column, serial: Column, kind: str = "docx") -> Column:
    """The name of what is made of a report: by the convention where there is one, without refused characters, else Name_BRSR_year."""
    end = "_metadata.json" if kind == "metadata" else f".{kind}"
    by_convention = F.regexp_replace(T.strip(F.regexp_replace(with_placeholders(convention, year, F.upper(symbol), serial), _ILLEGAL, "")), r"(?i)\.pdf$", "")
    plain = F.concat(T.safe_file_name(company), F.lit(f"_{STANDALONE}_"), year, F.when(from_annual, f"_{FROM_ANNUAL}").otherwise(""))
    return F.concat(F.when(~T.is_blank(F.coalesce(convention, F.lit(""))), by_convention).otherwise(plain), F.lit(end))


#: Patterns of years in a convention, longest first, with what takes their place.
def _year_patterns(year: Column) -> list[tuple[str, Column, Column]]:
    parts = F.split(year, "-", -1)
    start, short = F.get(parts, F.lit(0)), F.coalesce(F.get(parts, F.lit(1)), F.lit(""))
    whole = F.when(start.rlike("^[0-9]+$"), (start.cast("long") + 1).cast("string"))
    return [
        ("[0-9]{4}_[0-9]{4}", whole.isNotNull(), F.concat(start, F.lit("_"), whole)),
        ("[0-9]{4}-[0-9]{4}", whole.isNotNull(), F.concat(start, F.lit("-"), whole)),
        ("[0-9]{4}_[0-9]{2}(?![0-9])", short != "", F.replace(year, F.lit("-"), F.lit("_"))),
        ("[0-9]{4}-[0-9]{2}(?![0-9])", short != "", year),
    ]


def with_year(convention: Column, year: Column) -> Column:
    """The first year of the first form that a convention has, in the order of the forms, becomes ``year`` in that form."""

    def replaced(c: Column) -> Column:
        out = F.when(F.lit(False), c)
        for pattern, able, new in _year_patterns(year):
            out = out.when(able & c.rlike(pattern), F.regexp_replace(c, f"(?s)^(.*?){pattern}", F.concat(F.lit("$1"), _literal(new))))
        return out.otherwise(c)

    return T.let(convention, replaced)


def convention_name(convention: Column, year: Column, symbol: Column, serial: Column) -> Column:
    """The name of a downloaded file, without extension, by a company's convention: its year replaced, refused characters as underscores."""
    dated = with_year(F.regexp_replace(T.strip(convention), r"(?i)\{year\}", _literal(year)), year)
    return F.regexp_replace(T.strip(F.regexp_replace(with_placeholders(dated, year, symbol, serial), _ILLEGAL, "_")), r"(?i)\.pdf$", "")


def download_file_name(company: Column, year: Column, convention: Column, symbol: Column, serial: Column) -> Column:
    """The name of a downloaded file: by the convention, else serial, symbol (or name), kind and year."""
    prefix = F.when(serial.isNotNull(), F.concat(serial.cast("string"), F.lit("_"))).otherwise("")
    who = F.when(T.is_blank(F.coalesce(symbol, F.lit(""))), T.safe_file_name(company)).otherwise(F.upper(T.strip(symbol)))
    plain = F.concat(prefix, who, F.lit(f"_{STANDALONE}_"), year)
    return F.concat(F.when(~T.is_blank(F.coalesce(convention, F.lit(""))), convention_name(convention, year, symbol, serial)).otherwise(plain), F.lit(".pdf"))


def renamed_file_name(company: Column, year: Column, convention: Column, symbol: Column, serial: Column) -> Column:
    """The name that a file found by hand gets: by the convention, else serial, name and year."""
    plain = F.concat(serial.cast("string"), F.lit("_"), F.replace(F.regexp_replace(company, _ILLEGAL, "_"), F.lit(" "), F.lit("_")), F.lit("_"), year)
    return F.concat(F.when(F.coalesce(convention, F.lit("")) != "", convention_name(convention, year, symbol, serial)).otherwise(plain), F.lit(".pdf"))


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/", -1), -1)


def stem(path: Column) -> Column:
    """The last part of a path without its last extension."""
    return F.regexp_replace(base_name(path), r"(.)\.[^.]*$", "$1")


def parsed_name(path: Column) -> Column:
    """(company_name, year, is_standalone, is_from_annual, is_metadata, file_type) of a name that follows the rules, else null."""
    name = stem(path)
    made, annual = rf"^(.+?)_{STANDALONE}_(\d{{4}}-\d{{2}})(_{FROM_ANNUAL})?(_metadata)?$", rf"^(.+?)_{EMBEDDED}_(\d{{4}}-\d{{2}})$"

    def fields(pattern: str, standalone: Column, from_annual: Column, metadata: Column, kind: Column) -> Column:
        company = F.replace(F.regexp_extract(name, pattern, 1), F.lit("_"), F.lit(" "))
        values = (company, F.regexp_extract(name, pattern, 2), standalone, from_annual, metadata, kind)
        return F.struct(*(v.alias(k) for k, v in zip(("company_name", "year", "is_standalone", "is_from_annual", "is_metadata", "file_type"), values, strict=True)))

    from_annual, metadata = name.contains(f"_{FROM_ANNUAL}"), name.contains("_metadata")
    first = fields(made, ~from_annual, from_annual, metadata, F.when(metadata, "metadata").otherwise("unknown"))
    return F.when(name.rlike(made), first).when(name.rlike(annual), fields(annual, F.lit(False), F.lit(False), F.lit(False), F.lit("annual_report")))


def company_and_year(path: Column) -> Column:
    """(company, year) of a path: the last folder or name that is a year, else the first year in the file's name, else 'unknown'; the company is the folder above."""
    parts = F.split(path, "/", -1)
    named = F.filter(F.reverse(parts), lambda p: p.rlike("^(19|20)[0-9]{2}$"))
    found = F.regexp_extract(stem(path), "(19|20)[0-9]{2}", 0)
    year = F.coalesce(F.get(named, F.lit(0)), F.when(found != "", found), F.lit("unknown"))
    above, higher = F.get(parts, F.size(parts) - 2), F.get(parts, F.size(parts) - 3)
    company = F.coalesce(F.when(above.rlike("^[0-9]+$"), higher).otherwise(above), F.lit(""))
    return F.struct(T.strip(F.translate(company, "-_", "  ")).alias("company"), year.alias("year"))


def sanitized(name: Column) -> Column:
    """Without refused characters, spaces as underscores, runs of underscores as one."""
    return F.regexp_replace(F.replace(F.regexp_replace(name, r'[<>:"/\\|?*]', ""), F.lit(" "), F.lit("_")), "_+", "_")


def truncated(t: Column, length: int = 100, suffix: str = "...") -> Column:
    """At most ``length`` characters, the last ones the suffix where some are missing."""
    return F.when(F.length(t) <= length, t).otherwise(F.concat(F.substring(t, 1, length - len(suffix)), F.lit(suffix)))


def symbol_in_name(name: Column, symbols: Column) -> Column:
    """The first of the symbols (an array, in order) that begins a file's name, else the first that stands in it as a word."""
    upper, plain = F.upper(name), F.upper(stem(name))
    begins = F.filter(symbols, lambda s: (plain == s) | reduce(lambda a, b: a | b, (F.startswith(upper, F.concat(s, F.lit(x))) for x in "_-. ")))
    parts = F.split(plain, r"[^\p{L}\p{N}_]+", -1)
    return F.coalesce(F.get(begins, F.lit(0)), F.get(F.filter(symbols, lambda s: F.array_contains(parts, s)), F.lit(0)))
