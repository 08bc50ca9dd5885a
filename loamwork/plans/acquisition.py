"""Queries on the registry and the download log: tasks, resume, roll-ups and names."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from loamwork.functions import text as T
from loamwork.plans.documents import table
from loamwork.plans.registry import register

YEARS = ["2022-23", "2023-24", "2024-25"]


@register(
    "pending_tasks",
    """
    WITH y AS (SELECT unnest(['2022-23', '2023-24', '2024-25']) AS year),
    done AS (SELECT DISTINCT o_custkey AS k, '2022-23' AS year FROM orders)
    SELECT c_custkey AS company, y.year FROM customer CROSS JOIN y WHERE NOT EXISTS (SELECT 1 FROM done WHERE k = c_custkey AND done.year = y.year)
    """,
)
def pending_tasks(spark, sf_dir):
    """Companies times fiscal years (a fixed list), without what is done."""
    tasks = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("company"), F.explode(F.array(*map(F.lit, YEARS))).alias("year"))
    done = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("company"), F.lit(YEARS[0]).alias("year")).distinct()
    return tasks.join(done, ["company", "year"], "left_anti")


@register(
    "attempt_summary",
    "SELECT user_id, event_type, count(*) AS n FROM events GROUP BY GROUPING SETS ((user_id), (event_type), ())",
)
def attempt_summary(spark, sf_dir):
    table(spark, sf_dir, "events").createOrReplaceTempView("__attempts")
    return spark.sql("SELECT user_id, event_type, count(*) AS n FROM __attempts GROUP BY GROUPING SETS ((user_id), (event_type), ())")


@register(
    "latest_status",
    "SELECT user_id, event_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1",
)
def latest_status(spark, sf_dir):
    """The last row of each key wins, as in an upsert; partial aggregation, no window."""
    last = table(spark, sf_dir, "events").groupBy("user_id").agg(F.max(F.struct("ts", "event_id", "event_type")).alias("x"))
    return last.select("user_id", "x.event_id", "x.event_type")


@register(
    "status_by_year",
    """
    SELECT o_custkey AS company, count(*) FILTER (year(o_orderdate) = 1995) AS y1995, count(*) FILTER (year(o_orderdate) = 1996) AS y1996, count(*) FILTER (year(o_orderdate) = 1997) AS y1997
    FROM orders GROUP BY o_custkey
    """,
)
def status_by_year(spark, sf_dir):
    pivoted = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("company"), F.year("o_orderdate").alias("year")).groupBy("company").pivot("year", [1995, 1996, 1997]).count()
    return pivoted.select("company", *(F.coalesce(F.col(f"`{y}`"), F.lit(0)).alias(f"y{y}") for y in (1995, 1996, 1997)))


@register(
    "file_estimates",
    r"""
    WITH f AS (SELECT o_orderkey AS file, floor(o_totalprice)::BIGINT AS n, floor(o_totalprice)::DOUBLE / 97.13::DOUBLE AS mb, CASE WHEN o_orderkey % 3 = 0 THEN 'scanned' ELSE 'text' END AS kind FROM orders),
    m AS (SELECT *, CASE WHEN kind = 'scanned' THEN mb * 0.5::DOUBLE ELSE mb * 0.1::DOUBLE END AS minutes FROM f)
    SELECT file, kind, CASE WHEN minutes < 1 THEN '< 1 minute' WHEN minutes < 60 THEN '~' || floor(minutes)::INT || ' minutes' ELSE '~' || format('{:.1f}', minutes / 60) || ' hours' END AS estimate,
           CASE WHEN n < 1024 THEN format('{:.2f} B', n::DOUBLE) WHEN n < 1048576 THEN format('{:.2f} KB', n / 1024) ELSE format('{:.2f} MB', n / 1048576) END AS size,
           CASE WHEN file % 4 = 0 THEN '19' WHEN file % 4 = 1 THEN '20' END AS century FROM m
    """,
)
def file_estimates(spark, sf_dir):
    """Sizes of files, how long they may take, and the century in their names; prices stand in for sizes."""
    k = F.col("o_orderkey")
    n, kind = F.floor("o_totalprice").cast("long"), F.when(k % 3 == 0, "scanned").otherwise("text")
    name = F.when(k % 4 == 0, "a 1999 2001").when(k % 4 == 1, "2024-25").otherwise("x12024")
    return table(spark, sf_dir, "orders").select(k.alias("file"), kind.alias("kind"), T.estimated_time(n.cast("double") / 97.13, kind).alias("estimate"), T.file_size(n).alias("size"), T.century(name).alias("century"))


@register(
    "attempt_rates",
    """
    SELECT user_id, count(*) AS attempts, count(*) FILTER (event_type = 'purchase') AS done, count(DISTINCT event_type) AS kinds, round_even(count(*) FILTER (event_type = 'purchase') * 100.0::DOUBLE / count(*), 2) AS percent,
           ceil(count(*) / 10)::BIGINT AS batches, greatest(0, least(100, count(*) - 50))::BIGINT AS over_fifty, strftime(max(ts), '%Y-%m-%dT%H:%M:%S') AS last_at FROM events GROUP BY user_id
    """,
)
def attempt_rates(spark, sf_dir):
    """Attempts of each key: successes, their share, batches of ten and when the last one was."""
    n, done = F.count("*"), F.count_if(F.col("event_type") == "purchase")
    return table(spark, sf_dir, "events").groupBy("user_id").agg(
        n.alias("attempts"), done.alias("done"), F.countDistinct("event_type").alias("kinds"), T.percent(done, n).alias("percent"), F.ceil(n / 10).alias("batches"),
        F.greatest(F.lit(0), F.least(F.lit(100), n - 50)).cast("long").alias("over_fifty"), F.date_format(F.max("ts"), "yyyy-MM-dd'T'HH:mm:ss").alias("last_at"),
    )


@register(
    "upper_median",
    "SELECT o_custkey AS company, list_sort(list(o_totalprice))[count(*) // 2 + 1] AS middle FROM orders GROUP BY o_custkey",
)
def upper_median(spark, sf_dir):
    prices = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("company")).agg(F.sort_array(F.collect_list("o_totalprice")).alias("x"))
    return prices.select("company", F.element_at("x", F.floor(F.size("x") / 2).cast("int") + 1).alias("middle"))


@register(
    "nation_categories",
    """
    SELECT n_name AS nation, count(c_custkey) AS companies, sum(c_acctbal) AS balance FROM nation LEFT JOIN customer ON n_nationkey = c_nationkey GROUP BY n_name
    """,
)
def nation_categories(spark, sf_dir):
    """Counts joined to the whole dimension, so empty groups stay."""
    sums = table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.count("*").alias("companies"), F.sum("c_acctbal").alias("balance"))
    return table(spark, sf_dir, "nation").join(sums, F.col("n_nationkey") == F.col("c_nationkey"), "left").select(F.col("n_name").alias("nation"), F.coalesce("companies", F.lit(0)).alias("companies"), "balance")
