"""Queries that plan what to do with files, and that read saved responses of search services.

Plans are tables (path, target, action); whoever runs them moves or deletes files, no
query does.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loamwork.functions import names as N
from loamwork.functions import text as T
from loamwork.operators.ordering import with_global_index
from loamwork.plans import sql as S
from loamwork.plans.companies import _SQL_MISSING, _SQL_REGISTRY, _SQL_STATUS, _SQL_CONVENTION, _stand_in_missing, _stand_in_status, files_by_symbol, registry_companies
from loamwork.plans.documents import table
from loamwork.plans.filings import unwrapped
from loamwork.plans.registry import register
from loamwork.session import materialise

#: Bytes that a report's file has at least.
LEAST_BYTES = 1000


def renaming_plan(files: DataFrame, found: DataFrame, taken: DataFrame) -> DataFrame:
    """(name, target, action) for files (name, year): 'rename' to the name that the company's convention gives, 'skip' where a file of that name is there (taken: name) or another comes first, 'unknown' without a company or a year."""
    matched = files_by_symbol(files.select("name"), found)
    rows = files.join(matched, "name", "left").join(found.withColumn("symbol", F.upper("symbol")).dropDuplicates(["symbol"]), "symbol", "left")
    target = N.renamed_file_name(F.col("company_name"), F.col("year"), F.col("naming_convention"), F.col("symbol"), F.col("serial_number"))
    named = rows.withColumn("target", F.when(F.col("company_name").isNotNull() & F.col("year").isNotNull(), target))
    there = taken.select(F.col("name").alias("target")).distinct().withColumn("__there", F.lit(True))
    first = Window.partitionBy("target").orderBy("name")
    marked = named.join(there, "target", "left").withColumn("__place", F.row_number().over(first))
    action = F.when(F.col("target").isNull(), "unknown").when(F.col("__there") | (F.col("__place") > 1), "skip").otherwise("rename")
    return marked.select("name", "target", action.alias("action"))


@register(
    "files_to_rename",
    rf"""
    WITH {_SQL_REGISTRY}, f AS (SELECT DISTINCT 'SYM' || (o_custkey % 600) || '_' || (o_orderkey % 7) || '.pdf' AS name, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE '2022-23' END AS year FROM orders),
    c AS (SELECT upper(symbol) AS symbol, company_name, naming_convention, serial_number FROM co QUALIFY row_number() OVER (PARTITION BY upper(symbol) ORDER BY row_index) = 1),
    n AS (SELECT f.name, CASE WHEN company_name IS NOT NULL AND year IS NOT NULL THEN CASE WHEN naming_convention IS NOT NULL THEN {_SQL_CONVENTION}
                 ELSE serial_number || '_' || replace({S.replaced('company_name', '[/\\:*?"<>|]', '_')}, ' ', '_') || '_' || year END || '.pdf' END AS target, symbol FROM f LEFT JOIN c ON c.symbol = split_part(f.name, '_', 1))
    SELECT name, target, CASE WHEN target IS NULL THEN 'unknown' WHEN target LIKE '%3%' OR row_number() OVER (PARTITION BY target ORDER BY name) > 1 THEN 'skip' ELSE 'rename' END AS action FROM n
    """,
)
def files_to_rename(spark, sf_dir):
    """What to call files that were found by hand; symbols in the stand-in registry are unique, and names with a 3 are taken."""
    k, o = F.col("o_custkey") % 600, F.col("o_orderkey") % 7
    files = table(spark, sf_dir, "orders").select(F.concat(F.lit("SYM"), k.cast("string"), F.lit("_"), o.cast("string"), F.lit(".pdf")).alias("name"), F.when(o != 0, "2022-23").alias("year")).distinct()
    found = registry_companies(spark, sf_dir)
    name = N.renamed_file_name(F.col("company_name"), F.lit("2022-23"), F.col("naming_convention"), F.upper("symbol"), F.col("serial_number"))
    return renaming_plan(files, found, found.select(name.alias("name")).filter("name LIKE '%3%'"))


def file_problem(length, mark):
    """Why a file is no report, else null, by its length and first bytes."""
    return F.when(length.isNull(), "File does not exist").when(length < LEAST_BYTES, F.concat(F.lit("File too small ("), length.cast("string"), F.lit(" bytes)"))).when(mark != "%PDF", F.concat(F.lit("Invalid PDF header: "), mark))


def removal_plan(status: DataFrame, files: DataFrame) -> DataFrame:
    """Status rows (file_path, status, ...) with the status that they should have and what to do with their file (path, length, mark): downloads whose file is missing or broken are reset, broken files deleted."""
    near = status.join(files.withColumnRenamed("path", "file_path"), "file_path", "left")
    usable = (F.col("status") == "Downloaded") & ~T.is_blank(F.coalesce("file_path", F.lit("")))
    problem = F.when(usable, file_problem(F.col("length"), F.col("mark")))
    return near.select(*status.columns, problem.alias("error"), F.when(problem.isNotNull(), "Failed").otherwise(F.col("status")).alias("new_status"), F.when(problem.isNotNull() & F.col("length").isNotNull(), "delete").otherwise("keep").alias("action"))


@register(
    "files_to_remove",
    f"""
    WITH {_SQL_STATUS}, s AS (SELECT seq, status, CASE seq % 5 WHEN 0 THEN '  ' WHEN 1 THEN NULL ELSE 'd/' || seq || '.pdf' END AS file_path FROM st),
    f AS (SELECT s.*, CASE WHEN seq % 4 <> 0 AND seq % 5 > 1 THEN seq * 10 END AS length, CASE WHEN seq % 7 = 0 THEN 'HTML' ELSE '%PDF' END AS mark FROM s),
    p AS (SELECT *, CASE WHEN status = 'Downloaded' AND trim(coalesce(file_path, '')) <> '' THEN CASE WHEN length IS NULL THEN 'File does not exist' WHEN length < {LEAST_BYTES} THEN 'File too small (' || length || ' bytes)'
                 WHEN mark <> '%PDF' THEN 'Invalid PDF header: ' || mark END END AS error FROM f)
    SELECT seq, file_path, status, error, CASE WHEN error IS NOT NULL THEN 'Failed' ELSE status END AS new_status, CASE WHEN error IS NOT NULL AND length IS NOT NULL THEN 'delete' ELSE 'keep' END AS action FROM p
    """,
)
def files_to_remove(spark, sf_dir):
    """Downloads whose files are missing or broken, and what to do."""
    k = F.col("seq")
    path = F.concat(F.lit("d/"), k.cast("string"), F.lit(".pdf"))
    status = _stand_in_status(spark, sf_dir).select("seq", "status", F.when(k % 5 == 0, "  ").when(k % 5 > 1, path).alias("file_path"))
    files = status.filter("seq % 4 <> 0 AND seq % 5 > 1").select(path.alias("path"), (k * 10).alias("length"), F.when(k % 7 == 0, "HTML").otherwise("%PDF").alias("mark"))
    return removal_plan(status, files).select("seq", "file_path", "status", "error", "new_status", "action")


def api_results(responses: DataFrame) -> DataFrame:
    """(page_id, place, link, title) of saved responses (page_id, json) of a search service; items without a link are left out."""
    items = F.from_json(F.get_json_object("json", "$.items"), "array<struct<link:string,title:string>>")
    return responses.select("page_id", F.posexplode(items).alias("place", "i")).select("page_id", F.col("place").cast("long").alias("place"), "i.link", F.coalesce("i.title", F.lit("")).alias("title")).filter("link IS NOT NULL")


@register("api_results", "SELECT page_id, k::BIGINT AS place, url || '?' || k AS link, CASE WHEN k = 1 THEN '' ELSE 'T \"' || page_id || '\"' END AS title FROM pages, range(0, 3) t(k) WHERE page_id % 4 <> 3 AND NOT (k = 2 AND page_id % 3 = 0)")
def api_results_query(spark, sf_dir):
    """Links and titles of saved responses, made of the pages' addresses."""
    item = lambda k, title: F.struct(F.when((F.lit(k) != 2) | (F.col("page_id") % 3 != 0), F.concat("url", F.lit(f"?{k}"))).alias("link"), title.alias("title"))
    titled = F.concat(F.lit('T "'), F.col("page_id").cast("string"), F.lit('"'))
    items = F.array(item(0, titled), item(1, F.lit(None).cast("string")), item(2, titled))
    json = F.when(F.col("page_id") % 4 != 3, F.to_json(F.struct(items.alias("items")))).otherwise('{"searchInformation": {}}')
    return api_results(table(spark, sf_dir, "pages").select("page_id", json.alias("json")))


@register("filing_records", "SELECT page_id, k::BIGINT AS place, 'f' || page_id || '_' || k AS file_name FROM pages, range(0, 2) t(k) WHERE page_id % 5 <> 4")
def filing_records(spark, sf_dir):
    """Records of saved responses of an exchange, wrapped in four ways, or not known."""
    record = lambda k: F.struct(F.concat(F.lit("f"), F.col("page_id").cast("string"), F.lit(f"_{k}")).alias("fileName"))
    rows, kind = F.array(record(0), record(1)), F.col("page_id") % 5
    json = F.when(kind == 0, F.to_json(rows)).when(kind == 1, F.to_json(F.struct(rows.alias("data")))).when(kind == 2, F.to_json(F.struct(rows.alias("result")))).when(kind == 3, F.to_json(F.struct(rows.alias("records")))).otherwise('{"message": "none"}')
    read = table(spark, sf_dir, "pages").select("page_id", F.posexplode(F.from_json(unwrapped(json), "array<struct<fileName:string>>")).alias("place", "r"))
    return read.select("page_id", F.col("place").cast("long").alias("place"), F.col("r.fileName").alias("file_name"))


def missing_json(entries: DataFrame) -> DataFrame:
    """(place, part, json): the JSON of missing reports in pieces: how many, the entries in the order of their columns, and counts by company and by year.

    The pieces joined in their order are the JSON; part is 'head' for the first, 'entry'
    for each entry and 'tail' for the last. Entries are numbered by ranges and stay apart,
    so no row holds more than one of them or the counts.
    """
    known = entries.withColumns({c: F.coalesce(c, F.lit("Unknown")) for c in ("company_name", "year")})
    counted = lambda c: known.groupBy(c).count().agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(c, "count")))).alias(f"{c}s"))
    numbered = with_global_index(entries, entries.columns, "__at")
    each = F.concat(F.when(F.col("__at") > 0, ",").otherwise(""), F.to_json(F.struct(*entries.columns), {"ignoreNullFields": "false"}))
    total = numbered.agg(F.count("*").alias("n"))
    head = total.select(F.lit(0).cast("long").alias("place"), F.lit("head").alias("part"), F.concat(F.lit('{"total_missing_reports":'), F.col("n").cast("string"), F.lit(',"entries":[')).alias("json"))
    counts = total.crossJoin(counted("company_name")).crossJoin(counted("year"))
    tail = counts.select((F.col("n") + 1).alias("place"), F.lit("tail").alias("part"), F.concat(F.lit("],"), F.substring(F.to_json(F.struct("company_names", "years")), 2, 1 << 30)).alias("json"))
    return head.unionByName(numbered.select((F.col("__at") + 1).alias("place"), F.lit("entry").alias("part"), each.alias("json"))).unionByName(tail)


def missing_counts(pieces: DataFrame) -> DataFrame:
    """One row: total_missing_reports and years of a log of missing reports in pieces; without its entries it is a JSON of its own."""
    ends = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "json"))), lambda x: x["json"]), "")
    return pieces.filter("part <> 'entry'").agg(F.from_json(ends, "total_missing_reports bigint, years map<string,bigint>").alias("j")).select("j.*")


@register(
    "missing_log",
    f"""WITH {_SQL_MISSING}, y AS (SELECT coalesce(year, 'Unknown') AS year, count(*) AS n FROM e GROUP BY 1) SELECT (SELECT count(*) FROM e) AS total, year, n AS reports FROM y""",
)
def missing_log(spark, sf_dir):
    """Missing reports by year, read back from the JSON of the log."""
    log = materialise(missing_json(_stand_in_missing(spark, sf_dir)), "missing-log")
    return missing_counts(log).select(F.col("total_missing_reports").alias("total"), F.explode("years").alias("year", "reports"))
