"""Queries on the registry of companies, the names of their files, the status of downloads and missing reports.

Customers stand in for companies; what their table lacks is made from their keys, alike
in both engines. Registries are small, but nothing here needs them to be: only
with_status and expected_files take a list of years, which is fixed.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loamwork.functions import names as N
from loamwork.functions import text as T
from loamwork.operators.dealing import dealt, filtered
from loamwork.plans import sql as S
from loamwork.plans.acquisition import YEARS
from loamwork.plans.documents import table
from loamwork.plans.registry import register

# Names that columns of a registry may have.
SERIAL_NAMES = ["Serial Number", "Serial No", "S.No", "S No", "Sr No", "Sr. No", "Serial", "SN", "S.N"]
NAMING_NAMES = ["NAMING CONVENTION", "Naming Convention", "Naming", "Filename", "File Name", "Naming_Convention"]


def companies(raw: DataFrame, row: str) -> DataFrame:
    """Companies of a registry: company_name, symbol, industry, isin, series, row_index, serial_number, naming_convention.

    ``row`` names the column with the row's number from 1. Names of columns lose white
    space at their ends. The serial number is the first of its columns that holds a whole
    number, else the row's; the naming convention the first that is not null, null if
    blank. Rows without a name or a symbol are left out; missing columns are empty.
    """
    named = {c.strip(): F.col(f"`{c}`") for c in raw.columns}
    upper = {c.upper(): F.col(f"`{o}`") for o in reversed(raw.columns) for c in [o.strip()]}
    stripped = lambda c: T.strip(F.coalesce(named[c].cast("string"), F.lit(""))) if c in named else F.lit("")
    whole = lambda c: F.when(c.cast("string").rlike(r"^\s*[+-]?[0-9]+(\.0+)?\s*$"), F.regexp_replace(F.trim(c.cast("string")), r"\.0+$", "").cast("int"))
    serials = [whole(named[c]) for c in SERIAL_NAMES if c in named]
    naming = F.coalesce(*(upper[c.upper()].cast("string") for c in NAMING_NAMES if c.upper() in upper), F.lit(None).cast("string"))
    out = raw.select(
        T.clean_company_name(named["Company Name"].cast("string") if "Company Name" in named else F.lit("")).alias("company_name"),
        stripped("Symbol").alias("symbol"), stripped("Industry").alias("industry"), stripped("ISIN Code").alias("isin"), stripped("Series").alias("series"),
        F.col(row).cast("int").alias("row_index"), F.coalesce(*serials, F.col(row).cast("int")).alias("serial_number"),
        F.when(~T.is_blank(naming), naming).alias("naming_convention"),
    )
    return filtered(out, (F.col("company_name") != "") & (F.col("symbol") != ""))


def symbol_lookup(found: DataFrame) -> DataFrame:
    """(name, symbol) for each company name in lower case; the last row of a name wins."""
    return found.groupBy(F.lower("company_name").alias("name")).agg(F.max_by("symbol", "row_index").alias("symbol"))


def registry_json(found: DataFrame) -> DataFrame:
    """One row with the JSON of a registry: how many companies, all of them in order, and the lookup of symbols. A registry is small."""
    every = F.transform(F.array_sort(F.collect_list(F.struct("row_index", F.struct(*found.columns).alias("c")))), lambda x: x["c"])
    listed = found.agg(F.count("*").alias("total_companies"), every.alias("companies"))
    looked = symbol_lookup(found).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("name", "symbol")))).alias("symbol_lookup"))
    return listed.crossJoin(F.broadcast(looked)).select(F.to_json(F.struct("total_companies", "companies", "symbol_lookup"), {"pretty": "true", "ignoreNullFields": "false"}).alias("json"))


_CONVENTIONS = ["{Serial}_{SYMBOL}_2020_2021", "Report 2019-2020 {symbol}.PDF", "  x:y_2021_22_{serial_number}  ", "{symbol}-2018-19-{YEAR}", "", "   ", "plain {year}"]
_NAMES = [" Ltd.", " Limited ", " Pvt Ltd", " Private Limited", " Ltd. Limited", "/A:B?", ""]


def _stand_in_registry(spark, sf_dir) -> DataFrame:
    k = F.col("c_custkey")
    pick = lambda xs: F.element_at(F.array(*map(F.lit, xs)), (k % len(xs) + 1).cast("int"))
    # companies are dealt by their number: their names are slow to make, and a file of many is small
    return dealt(table(spark, sf_dir, "customer"), "c_custkey", each=5000).select(
        k.alias("row"), F.when(k % 13 == 0, "").otherwise(F.concat(F.lit(" "), F.replace("c_name", F.lit("#"), F.lit(" ")), pick(_NAMES))).alias("Company Name "),
        F.when(k % 11 == 0, F.lit(None)).otherwise(F.concat(F.lit("SYM"), (k % 500).cast("string"), F.lit(" "))).alias(" Symbol"), F.col("c_mktsegment").alias("Industry"),
        F.when(k % 3 == 0, F.lit("no")).when(k % 3 == 1, (k + 1000).cast("string")).alias("S.No"), F.when(k % 3 == 2, k.cast("double") * 2).alias("SN"), pick(_CONVENTIONS).alias("naming convention"),
    )


_SQL_REGISTRY = f"""
    w AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 13 = 0 THEN '' ELSE ' ' || replace(c_name, '#', ' ') || [{', '.join(map(S.quoted, _NAMES))}][c_custkey % {len(_NAMES)} + 1] END AS raw_name,
                 CASE WHEN c_custkey % 11 = 0 THEN '' ELSE 'SYM' || (c_custkey % 500) END AS symbol, c_mktsegment AS industry,
                 CASE c_custkey % 3 WHEN 0 THEN c_custkey WHEN 1 THEN c_custkey + 1000 ELSE c_custkey * 2 END AS serial_number, [{', '.join(map(S.quoted, _CONVENTIONS))}][c_custkey % {len(_CONVENTIONS)} + 1] AS raw_naming FROM customer),
    co AS (SELECT {S.clean_company_name('raw_name')} AS company_name, symbol, industry, k::INT AS row_index, serial_number::INT AS serial_number, CASE WHEN trim(raw_naming) <> '' THEN raw_naming END AS naming_convention
           FROM w WHERE {S.clean_company_name('raw_name')} <> '' AND symbol <> '')
"""


@register("registry_companies", f"WITH {_SQL_REGISTRY} SELECT company_name, symbol, industry, '' AS isin, '' AS series, row_index, serial_number, naming_convention FROM co")
def registry_companies(spark, sf_dir):
    """Companies of a registry with headers of several spellings."""
    return companies(_stand_in_registry(spark, sf_dir), "row")


@register("symbols_by_name", f"WITH {_SQL_REGISTRY} SELECT lower(company_name) AS name, arg_max(symbol, row_index) AS symbol FROM co GROUP BY 1")
def symbols_by_name(spark, sf_dir):
    return symbol_lookup(registry_companies(spark, sf_dir))


def _sql_placeholders(c: str, symbol: str) -> str:
    c = f"regexp_replace({c}, '(?i)\\{{year\\}}', year, 'g')"
    return f"regexp_replace(regexp_replace({c}, '(?i)\\{{symbol\\}}', {symbol}, 'g'), '(?i)\\{{serial(_number)?\\}}', serial_number::VARCHAR, 'g')"


def _sql_dated(c: str) -> str:
    c = f"regexp_replace({S.strip(c)}, '(?i)\\{{year\\}}', year, 'g')"
    whole = "split_part(year, '-', 1)::INT + 1"
    first = lambda p, new: f"WHEN regexp_matches({c}, '{p}') THEN regexp_replace({c}, '{p}', {new})"
    # RE2 has no look-ahead: what follows is kept as a group
    short = lambda sep, new: f"WHEN regexp_matches({c}, '[0-9]{{4}}{sep}[0-9]{{2}}([^0-9]|$)') THEN regexp_replace({c}, '[0-9]{{4}}{sep}[0-9]{{2}}([^0-9]|$)', {new} || '\\1')"
    return (
        "CASE " + first("[0-9]{4}_[0-9]{4}", f"split_part(year, '-', 1) || '_' || ({whole})") + " " + first("[0-9]{4}-[0-9]{4}", f"split_part(year, '-', 1) || '-' || ({whole})") + " "
        + short("_", "replace(year, '-', '_')") + " " + short("-", "year") + f" ELSE {c} END"
    )


_ILLEGAL = "[/\\\\:*?\"<>|]"
_SQL_CONVENTION = f"regexp_replace({S.strip(S.replaced(_sql_placeholders(_sql_dated('naming_convention'), 'symbol'), _ILLEGAL, '_'))}, '(?i)\\.pdf$', '')"
_SQL_YEARS = f"y AS (SELECT unnest([{', '.join(map(S.quoted, YEARS))}]) AS year)"


def _tasks(spark, sf_dir) -> DataFrame:
    return registry_companies(spark, sf_dir).withColumn("year", F.explode(F.array(*map(F.lit, YEARS))))


@register(
    "file_names",
    rf"""
    WITH {_SQL_REGISTRY}, {_SQL_YEARS}
    SELECT row_index, year, {S.safe_file_name('company_name')} || '_BRSR_' || year || '.pdf' AS standalone_name, {S.safe_file_name('company_name')} || '_AnnualReport_' || year || '.pdf' AS annual_name,
           CASE WHEN naming_convention IS NOT NULL THEN {_SQL_CONVENTION} ELSE serial_number || '_' || symbol || '_BRSR_' || year END || '.pdf' AS download_name,
           CASE WHEN naming_convention IS NOT NULL THEN {_SQL_CONVENTION} ELSE serial_number || '_' || replace({S.replaced('company_name', _ILLEGAL, '_')}, ' ', '_') || '_' || year END || '.pdf' AS renamed,
           CASE WHEN naming_convention IS NOT NULL THEN regexp_replace({S.strip(S.replaced(_sql_placeholders(S.strip('naming_convention'), 'upper(symbol)'), _ILLEGAL, ''))}, '(?i)\.pdf$', '')
                ELSE {S.safe_file_name('company_name')} || '_BRSR_' || year || CASE WHEN row_index % 2 = 0 THEN '_from_AnnualReport' ELSE '' END END || '_metadata.json' AS metadata_name,
           year || '/' || {S.safe_file_name('company_name')} AS folder FROM co CROSS JOIN y
    """,
)
def file_names(spark, sf_dir):
    """The names of each company's files in each year: downloads, renamed ones, outputs and folders."""
    c = F.col
    args = (c("naming_convention"), c("symbol"), c("serial_number"))
    return _tasks(spark, sf_dir).select(
        "row_index", "year", N.report_file_name(c("company_name"), c("year"), F.lit(True)).alias("standalone_name"), N.report_file_name(c("company_name"), c("year"), F.lit(False)).alias("annual_name"),
        N.download_file_name(c("company_name"), c("year"), *args).alias("download_name"), N.renamed_file_name(c("company_name"), c("year"), *args).alias("renamed"),
        N.output_file_name(c("company_name"), c("year"), c("row_index") % 2 == 0, *args, kind="metadata").alias("metadata_name"),
        F.concat("year", F.lit("/"), T.safe_file_name(c("company_name"))).alias("folder"),
    )


_PATHS = ["data/Tata-Steel/2022/report_1999.pdf", "data/A_B/report_2021_2019.pdf", "x.pdf", "data/9/2023/r.pdf", "a/b c/Reliance_BRSR_2022-23.pdf", "y/T_S_BRSR_2023-24_from_AnnualReport_metadata.json", "TCS_AnnualReport_2024-25.pdf", "q/TCS_BRSR_2022.pdf"]


@register(
    "parsed_paths",
    rf"""
    WITH p AS (SELECT page_id, [{', '.join(map(S.quoted, _PATHS))}][page_id % {len(_PATHS)} + 1] AS path FROM pages),
    s AS (SELECT *, string_split(path, '/') AS parts, regexp_replace(string_split(path, '/')[-1], '(.)\.[^.]*$', '\1') AS stem FROM p),
    m AS (SELECT *, regexp_matches(stem, '^(.+?)_BRSR_([0-9]{{4}}-[0-9]{{2}})(_from_AnnualReport)?(_metadata)?$') AS a, regexp_matches(stem, '^(.+?)_AnnualReport_([0-9]{{4}}-[0-9]{{2}})$') AS b FROM s)
    SELECT page_id, path, replace(CASE WHEN a THEN regexp_extract(stem, '^(.+?)_BRSR_', 1) WHEN b THEN regexp_extract(stem, '^(.+?)_AnnualReport_', 1) END, '_', ' ') AS company_name,
           CASE WHEN a OR b THEN regexp_extract(stem, '[0-9]{{4}}-[0-9]{{2}}') END AS year, CASE WHEN a THEN NOT contains(stem, '_from_AnnualReport') WHEN b THEN false END AS is_standalone,
           CASE WHEN a THEN CASE WHEN contains(stem, '_metadata') THEN 'metadata' ELSE 'unknown' END WHEN b THEN 'annual_report' END AS file_type,
           trim(translate(coalesce(CASE WHEN regexp_matches(parts[-2], '^[0-9]+$') THEN parts[-3] ELSE parts[-2] END, ''), '-_', '  ')) AS folder_company,
           coalesce(list_filter(list_reverse(parts), lambda x: regexp_matches(x, '^(19|20)[0-9]{{2}}$'))[1], nullif(regexp_extract(stem, '(19|20)[0-9]{{2}}'), ''), 'unknown') AS folder_year,
           regexp_replace(replace(regexp_replace(path, '[<>:"/\\|?*]', '', 'g'), ' ', '_'), '_+', '_', 'g') AS sanitized, CASE WHEN length(path) <= 20 THEN path ELSE path[1:17] || '...' END AS short FROM m
    """,
)
def parsed_paths(spark, sf_dir):
    """What names and folders of files say about them."""
    path = F.element_at(F.array(*map(F.lit, _PATHS)), (F.col("page_id") % len(_PATHS) + 1).cast("int"))
    rows = table(spark, sf_dir, "pages").select("page_id", path.alias("path")).withColumns({"p": N.parsed_name(F.col("path")), "c": N.company_and_year(F.col("path"))})
    return rows.select(
        "page_id", "path", "p.company_name", "p.year", "p.is_standalone", "p.file_type", F.col("c.company").alias("folder_company"), F.col("c.year").alias("folder_year"),
        N.sanitized(F.col("path")).alias("sanitized"), N.truncated(F.col("path"), 20).alias("short"),
    )


def first_status(status: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The first row of each key, by ``order``: later ones of the same key do not count."""
    rest = [c for c in status.columns if c not in keys]
    return status.groupBy(*keys).agg(F.min(F.struct(order, *(c for c in rest if c != order))).alias("x")).select(*keys, "x.*")


def open_tasks(tasks: DataFrame, status: DataFrame, order: str) -> DataFrame:
    """Tasks (symbol, year, serial_number, ...) without those whose first status row says 'Downloaded'."""
    keys = ["symbol", "year", "serial_number"]
    done = first_status(status, keys, order).filter("status = 'Downloaded'").select(*keys)
    return tasks.join(done, keys, "left_anti")


def next_company(status: DataFrame, found: DataFrame) -> DataFrame:
    """One row: where to go on, after the company with the greatest serial number that has a download; else after as many as have one."""
    done = status.filter("status = 'Downloaded'")
    last = done.agg(F.max("serial_number").alias("serial_number"), F.countDistinct("symbol", "serial_number").alias("n_done"))
    at = found.groupBy("serial_number").agg(F.min("row_index").alias("at"))
    total = found.agg(F.count("*").alias("n_all"))
    # one row on either side
    return last.join(at, "serial_number", "left").crossJoin(F.broadcast(total)).select("n_done", F.coalesce("at", F.least("n_done", "n_all")).cast("long").alias("next_company"))


def _stand_in_status(spark, sf_dir) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    status = F.when(F.col("o_orderkey") % 3 == 0, "Downloaded").otherwise("Failed")
    serial = F.when(F.col("o_custkey") % 3 == 0, F.col("o_custkey")).when(F.col("o_custkey") % 3 == 1, F.col("o_custkey") + 1000).otherwise(F.col("o_custkey") * 2)
    year = F.element_at(F.array(*map(F.lit, YEARS)), (F.col("o_orderkey") % 5 % 3 + 1).cast("int"))
    return o.select(F.col("o_orderkey").alias("seq"), F.concat(F.lit("SYM"), (F.col("o_custkey") % 500).cast("string")).alias("symbol"), year.alias("year"), serial.cast("int").alias("serial_number"), status.alias("status"))


_SQL_STATUS = f"""
    st AS (SELECT o_orderkey AS seq, 'SYM' || (o_custkey % 500) AS symbol, [{', '.join(map(S.quoted, YEARS))}][o_orderkey % 5 % 3 + 1] AS year,
                  (CASE o_custkey % 3 WHEN 0 THEN o_custkey WHEN 1 THEN o_custkey + 1000 ELSE o_custkey * 2 END)::INT AS serial_number, CASE WHEN o_orderkey % 3 = 0 THEN 'Downloaded' ELSE 'Failed' END AS status FROM orders)
"""


@register(
    "open_downloads",
    f"""
    WITH {_SQL_REGISTRY}, {_SQL_YEARS}, {_SQL_STATUS}, f AS (SELECT symbol, year, serial_number, arg_min(status, seq) AS status FROM st GROUP BY ALL)
    SELECT row_index, symbol, year, serial_number FROM co CROSS JOIN y WHERE NOT EXISTS (SELECT 1 FROM f WHERE f.status = 'Downloaded' AND f.symbol = co.symbol AND f.year = y.year AND f.serial_number = co.serial_number)
    """,
)
def open_downloads(spark, sf_dir):
    """Companies times years without what is downloaded; of the status rows of a task only the first counts."""
    return open_tasks(_tasks(spark, sf_dir), _stand_in_status(spark, sf_dir), "seq").select("row_index", "symbol", "year", "serial_number")


@register(
    "resume_point",
    f"""
    WITH {_SQL_REGISTRY}, {_SQL_STATUS}, d AS (SELECT max(serial_number) AS m, count(DISTINCT (symbol, serial_number)) AS n_done FROM st WHERE status = 'Downloaded')
    SELECT n_done, coalesce((SELECT min(row_index) FROM co WHERE serial_number = m), least(n_done, (SELECT count(*) FROM co)))::BIGINT AS next_company FROM d
    """,
)
def resume_point(spark, sf_dir):
    return next_company(_stand_in_status(spark, sf_dir), registry_companies(spark, sf_dir))


@register(
    "usable_downloads",
    f"""WITH {_SQL_STATUS} SELECT seq, symbol, year, 'd/' || seq || '.pdf' AS file_path FROM st WHERE status = 'Downloaded' AND seq % 5 > 1""",
)
def usable_downloads(spark, sf_dir):
    """Downloads whose file has a path: not null, not blank, not 'nan'."""
    k = F.col("seq")
    status = _stand_in_status(spark, sf_dir).withColumn("file_path", F.when(k % 5 == 0, F.when(k % 2 == 0, " ").otherwise("nan")).when(k % 5 > 1, F.concat(F.lit("d/"), k.cast("string"), F.lit(".pdf"))))
    return with_files(status).select("seq", "symbol", "year", "file_path")


def with_files(status: DataFrame) -> DataFrame:
    """Status rows that are 'Downloaded' and have a path; null, blank and 'nan' are none."""
    path = F.coalesce("file_path", F.lit(""))
    return status.filter((F.col("status") == "Downloaded") & ~T.is_blank(path) & (F.lower(T.strip(path)) != "nan"))


def expected_files(found: DataFrame, files: DataFrame) -> DataFrame:
    """One row for each company with status and file name in each year: the name that its report should have is among the files (name), or not."""
    tasks = found.withColumn("year", F.explode(F.array(*map(F.lit, YEARS))))
    name = N.renamed_file_name(F.col("company_name"), F.col("year"), F.col("naming_convention"), F.col("symbol"), F.col("serial_number"))
    there = files.select(F.col("name").alias("expected")).distinct().withColumn("there", F.lit(True))
    marked = tasks.withColumn("expected", name).join(there, "expected", "left")
    values = marked.select("row_index", "company_name", "symbol", "serial_number", "year", F.struct(F.when(F.col("there"), "Renamed").otherwise("Not Found").alias("status"), F.when(F.col("there"), F.col("expected")).otherwise("").alias("file")).alias("v"))
    wide = values.groupBy("row_index", "company_name", "symbol", "serial_number").pivot("year", YEARS).agg(F.first("v"))
    return wide.select("row_index", "company_name", "symbol", "serial_number", *(c for y in YEARS for c in (F.col(f"`{y}`.status").alias(f"{y} Status"), F.col(f"`{y}`.file").alias(f"{y} Filename"))))


_SQL_RENAMED = f"CASE WHEN naming_convention IS NOT NULL THEN {_SQL_CONVENTION} ELSE serial_number || '_' || replace({S.replaced('company_name', _ILLEGAL, '_')}, ' ', '_') || '_' || year END || '.pdf'"


@register(
    "expected_files",
    f"""
    WITH {_SQL_REGISTRY}, {_SQL_YEARS}, n AS (SELECT co.*, year, {_SQL_RENAMED} AS name FROM co CROSS JOIN y), f AS (SELECT DISTINCT name FROM n WHERE (row_index + year[1:4]::INT) % 4 = 0),
    m AS (SELECT n.*, f.name IS NOT NULL AS there FROM n LEFT JOIN f USING (name))
    SELECT row_index, company_name, symbol, serial_number, {', '.join(f"max(CASE WHEN there THEN 'Renamed' ELSE 'Not Found' END) FILTER (year = '{y}') AS \"{y} Status\", max(CASE WHEN there THEN name ELSE '' END) FILTER (year = '{y}') AS \"{y} Filename\"" for y in YEARS)}
    FROM m GROUP BY ALL
    """,
)
def expected_files_query(spark, sf_dir):
    """Which reports of each company are there, by the names that they should have."""
    c = F.col
    name = N.renamed_file_name(c("company_name"), c("year"), c("naming_convention"), c("symbol"), c("serial_number"))
    files = _tasks(spark, sf_dir).filter((c("row_index") + F.substring("year", 1, 4).cast("int")) % 4 == 0).select(name.alias("name"))
    return expected_files(registry_companies(spark, sf_dir), files)


def files_by_symbol(files: DataFrame, found: DataFrame) -> DataFrame:
    """(name, symbol): the company whose symbol begins a file's name, else stands in it as a word; of several the first in the registry.

    Words of names are joined with symbols by equality, also those up to a separator at
    the beginning, so that work follows the names and not names times companies.
    """
    symbols = found.groupBy(F.upper("symbol").alias("symbol")).agg(F.min("row_index").alias("place"))
    upper, plain = F.upper("name"), F.upper(N.stem(F.col("name")))
    marks = F.filter(F.transform(F.sequence(F.lit(1), F.length(upper)), lambda i: F.when(F.substring(upper, i, F.lit(1)).rlike("[_. -]"), F.substring(upper, F.lit(1), i - 1))), lambda x: x.isNotNull())
    begins = F.transform(F.array_distinct(F.concat(marks, F.array(plain))), lambda x: F.struct(F.lit(0).alias("far"), x.alias("symbol")))
    inside = F.transform(F.array_distinct(F.split(plain, r"[^\p{L}\p{N}_]+", -1)), lambda x: F.struct(F.lit(1).alias("far"), x.alias("symbol")))
    hits = files.select("name", F.explode(F.concat(begins, inside)).alias("x")).select("name", "x.*").join(symbols, "symbol")
    return hits.groupBy("name").agg(F.min(F.struct("far", "place", "symbol")).alias("b")).select("name", "b.symbol")


@register(
    "files_matched",
    rf"""
    WITH {_SQL_REGISTRY}, s AS (SELECT upper(symbol) AS symbol, min(row_index) AS place FROM co GROUP BY 1),
    f AS (SELECT DISTINCT CASE o_orderkey % 5 WHEN 0 THEN 'sym' || (o_custkey % 600) || '_report.pdf' WHEN 1 THEN 'Report of SYM' || (o_custkey % 600) || ' final.pdf' WHEN 2 THEN 'ASYM1_' || (o_custkey % 600) || '.pdf'
                 WHEN 3 THEN 'SYM' || (o_custkey % 600) || '.x SYM2.pdf' ELSE 'SYM' || (o_custkey % 600) || '.pdf' END AS name FROM orders),
    p AS (SELECT name, upper(name) AS u, upper(regexp_replace(name, '(.)\.[^.]*$', '\1')) AS stem FROM f),
    j AS (SELECT p.name, s.symbol, s.place, CASE WHEN starts_with(u, symbol || '_') OR starts_with(u, symbol || '-') OR starts_with(u, symbol || '.') OR starts_with(u, symbol || ' ') OR stem = symbol THEN 0
                 WHEN list_contains(regexp_split_to_array(stem, '[^\p{{L}}\p{{N}}_]+'), symbol) THEN 1 END AS far FROM p JOIN s ON contains(u, symbol))
    SELECT name, symbol FROM j WHERE far IS NOT NULL QUALIFY row_number() OVER (PARTITION BY name ORDER BY far, place) = 1
    """,
)
def files_matched(spark, sf_dir):
    """File names matched to companies by their symbols."""
    n = (F.col("o_custkey") % 600).cast("string")
    k = F.col("o_orderkey") % 5
    name = (
        F.when(k == 0, F.concat(F.lit("sym"), n, F.lit("_report.pdf"))).when(k == 1, F.concat(F.lit("Report of SYM"), n, F.lit(" final.pdf"))).when(k == 2, F.concat(F.lit("ASYM1_"), n, F.lit(".pdf")))
        .when(k == 3, F.concat(F.lit("SYM"), n, F.lit(".x SYM2.pdf"))).otherwise(F.concat(F.lit("SYM"), n, F.lit(".pdf")))
    )
    return files_by_symbol(table(spark, sf_dir, "orders").select(name.alias("name")).distinct(), registry_companies(spark, sf_dir))


def missing_summary(entries: DataFrame) -> DataFrame:
    """Missing reports (company_name, year, tier_1_error, tier_2_error) in total, by company and by year; null names count as 'Unknown'."""
    known = entries.withColumns({c: F.coalesce(c, F.lit("Unknown")) for c in ("company_name", "year")})
    failed = lambda c: F.count_if(F.coalesce(c, F.lit("")) != "")
    sums = [F.count("*").alias("reports"), F.countDistinct("company_name").alias("companies"), failed("tier_1_error").alias("tier_1_failures"), failed("tier_2_error").alias("tier_2_failures")]
    parts = [known.groupBy("company_name").agg(*sums), known.groupBy("year").agg(*sums), known.agg(*sums)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts).select("company_name", "year", "reports", "companies", "tier_1_failures", "tier_2_failures")


_SQL_MISSING = """
    e AS (SELECT event_id, 'c' || (user_id % 50) AS company_name, 'S' || (user_id % 50) AS symbol, CASE WHEN event_id % 9 = 0 THEN NULL ELSE (2020 + event_id % 4)::VARCHAR END AS year,
                 CASE WHEN event_id % 2 = 0 THEN 'timeout' END AS tier_1_error, CASE WHEN event_id % 5 = 0 THEN 'none' WHEN event_id % 5 = 1 THEN '' END AS tier_2_error FROM events)
"""


def _stand_in_missing(spark, sf_dir) -> DataFrame:
    e, u = F.col("event_id"), (F.col("user_id") % 50).cast("string")
    return table(spark, sf_dir, "events").select(
        "event_id", F.concat(F.lit("c"), u).alias("company_name"), F.concat(F.lit("S"), u).alias("symbol"), F.when(e % 9 != 0, (e % 4 + 2020).cast("string")).alias("year"),
        F.when(e % 2 == 0, "timeout").alias("tier_1_error"), F.when(e % 5 == 0, "none").when(e % 5 == 1, "").alias("tier_2_error"),
    )


@register(
    "missing_reports",
    f"""
    WITH {_SQL_MISSING}, k AS (SELECT company_name, coalesce(year, 'Unknown') AS year, tier_1_error, tier_2_error FROM e)
    SELECT CASE WHEN grouping(company_name) = 0 THEN company_name END AS company_name, CASE WHEN grouping(year) = 0 THEN year END AS year, count(*) AS reports, count(DISTINCT company_name) AS companies,
           count(*) FILTER (coalesce(tier_1_error, '') <> '') AS tier_1_failures, count(*) FILTER (coalesce(tier_2_error, '') <> '') AS tier_2_failures FROM k GROUP BY GROUPING SETS ((company_name), (year), ())
    """,
)
def missing_reports(spark, sf_dir):
    return missing_summary(_stand_in_missing(spark, sf_dir))


@register("missing_entries", f"WITH {_SQL_MISSING} SELECT company_name, symbol, year, min(event_id) AS event_id, arg_min(coalesce(tier_1_error, ''), event_id) AS tier_1_error FROM e GROUP BY ALL")
def missing_entries(spark, sf_dir):
    """The entry that a lookup by company, symbol and year finds: the first of each."""
    return first_status(_stand_in_missing(spark, sf_dir), ["company_name", "symbol", "year"], "event_id").select("company_name", "symbol", "year", "event_id", F.coalesce("tier_1_error", F.lit("")).alias("tier_1_error"))


def first_files(files: DataFrame, limit: int = 10) -> DataFrame:
    """The first file (by seq) of each of YEARS, then others in order, ``limit`` in all, of those that are downloaded: a small sample to try a run on.

    Each group keeps its first rows before they are gathered, so that no task gets more than ``limit`` rows of each.
    """
    done = files.filter("status = 'Downloaded'")
    first = done.filter(F.col("year").isin(YEARS)).groupBy("year").agg(F.min("seq").alias("seq"))
    marked = done.join(F.broadcast(first.select(F.col("seq").alias("__first"))), F.col("seq") == F.col("__first"), "left")
    return marked.orderBy(F.col("__first").isNull(), "seq").limit(limit).drop("__first")


@register(
    "trial_files",
    f"""
    WITH {_SQL_STATUS}, d AS (SELECT * FROM st WHERE status = 'Downloaded'), f AS (SELECT min(seq) AS seq FROM d WHERE year IN ({', '.join(map(S.quoted, YEARS))}) GROUP BY year)
    SELECT seq, symbol, year FROM d ORDER BY seq NOT IN (SELECT seq FROM f), seq LIMIT 10
    """,
)
def trial_files(spark, sf_dir):
    """Ten downloads to try a run on, with at least one of each year."""
    return first_files(_stand_in_status(spark, sf_dir)).select("seq", "symbol", "year")


def flattening_plan(files: DataFrame, root: str) -> DataFrame:
    """(path, target, action) for every file below folders of ``root``: 'move' for the first path of a name, 'skip' where the root has the name or an earlier path takes it."""
    below = files.withColumn("name", N.base_name(F.col("path")))
    flat = F.col("path") == F.concat(F.lit(f"{root}/"), "name")
    there = below.filter(flat).select("name").distinct().withColumn("__there", F.lit(True))
    nested = below.filter(~flat).join(there, "name", "left")
    first = Window.partitionBy("name").orderBy("path")
    return nested.select("path", F.concat(F.lit(f"{root}/"), "name").alias("target"), F.when(F.col("__there") | (F.row_number().over(first) > 1), "skip").otherwise("move").alias("action"))


@register(
    "files_to_flatten",
    """
    WITH f AS (SELECT DISTINCT CASE o_custkey % 3 WHEN 0 THEN 'd/' WHEN 1 THEN 'd/a/' || o_orderpriority || '/' ELSE 'd/b/' END || (o_orderkey % 97) || '.pdf' AS path FROM orders),
    n AS (SELECT path, string_split(path, '/')[-1] AS name FROM f)
    SELECT path, 'd/' || name AS target, CASE WHEN name IN (SELECT name FROM n WHERE path = 'd/' || name) OR row_number() OVER (PARTITION BY name ORDER BY path) > 1 THEN 'skip' ELSE 'move' END AS action
    FROM n WHERE path <> 'd/' || name
    """,
)
def files_to_flatten(spark, sf_dir):
    """What to do with files in nested folders to have them all in one."""
    c = F.col("o_custkey") % 3
    folder = F.when(c == 0, "d/").when(c == 1, F.concat(F.lit("d/a/"), "o_orderpriority", F.lit("/"))).otherwise("d/b/")
    files = table(spark, sf_dir, "orders").select(F.concat(folder, (F.col("o_orderkey") % 97).cast("string"), F.lit(".pdf")).alias("path")).distinct()
    return flattening_plan(files, "d")


def outputs_left(files: DataFrame, outputs: DataFrame) -> DataFrame:
    """Files (name) without both a DOCX and a JSON among the outputs (name)."""
    made = outputs.select(N.stem(F.col("name")).alias("stem"), F.regexp_extract("name", r"\.([^.]*)$", 1).alias("kind")).filter("kind IN ('docx', 'json')")
    both = made.groupBy("stem").agg(F.countDistinct("kind").alias("n")).filter("n = 2")
    return files.withColumn("stem", N.stem(F.col("name"))).join(both, "stem", "left_anti").drop("stem")


@register(
    "files_to_process",
    """
    WITH f AS (SELECT DISTINCT 'r' || p_partkey || '.pdf' AS name, p_partkey AS k FROM part)
    SELECT name FROM f WHERE NOT (k % 2 = 0 AND k % 3 = 0)
    """,
)
def files_to_process(spark, sf_dir):
    """Reports whose outputs are not both there."""
    k = F.col("p_partkey").cast("string")
    files = table(spark, sf_dir, "part").select(F.concat(F.lit("r"), k, F.lit(".pdf")).alias("name"), "p_partkey")
    outputs = files.filter("p_partkey % 2 = 0").select(F.concat(F.lit("r"), k, F.lit(".docx")).alias("name")).union(files.filter("p_partkey % 3 = 0").select(F.concat(F.lit("r"), k, F.lit(".json")).alias("name")))
    return outputs_left(files.select("name"), outputs)
