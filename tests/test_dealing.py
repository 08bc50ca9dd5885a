"""Slow rows are dealt by their number, and nothing is computed twice for a filter."""

from pyspark.sql import functions as F

from loamwork.operators.dealing import dealt, filtered
from loamwork.plans import registry

DATA = "/root/testdata/sf0.001"


def test_rows_are_dealt(spark):
    rows = spark.range(0, 1000, 1, 1)
    assert dealt(rows, "id", each=100).rdd.getNumPartitions() == 10 and dealt(rows, each=100).count() == 1000
    assert dealt(rows.limit(0), "id").count() == 0


def test_small_files_have_several_tasks(spark, monkeypatch):
    """Companies and reports are few bytes: adaptive execution and files would leave them to one task."""
    found = []
    monkeypatch.setattr(type(spark.range(1)), "repartition", lambda self, n, *k, real=type(spark.range(1)).repartition: found.append(n) or real(self, n, *k))
    registry.queries()["file_names"](spark, DATA)
    registry.queries()["report_hierarchy"](spark, DATA)
    assert len(found) == 2


def test_filters_compute_once(spark):
    tried = spark.sparkContext.accumulator(0)

    @F.udf("int")
    def slow(x):
        tried.add(1)
        return x % 3

    rows = spark.range(0, 99, 1, 2).select(slow("id").alias("x"))
    got = filtered(rows.select("x", (F.col("x") + 1).alias("y")), F.col("y") > 1).collect()
    assert len(got) == 66 and got[0].asDict().keys() == {"x", "y"} and tried.value == 99
    plan = registry.queries()["reversed_lines"](spark, DATA)._jdf.queryExecution().optimizedPlan().toString()
    assert not any("Filter" in line and "split(" in line for line in plan.split("\n"))


def test_pairs_have_tasks_by_documents(spark, monkeypatch):
    """Pairs of words are dealt on both sides of their shuffle, and the setting is put back."""
    from loamwork.plans import topics

    want = sorted(registry.queries()["bigram_frequency"](spark, DATA).collect())
    before, seen = spark.conf.get("spark.sql.shuffle.partitions"), []
    monkeypatch.setattr(topics, "PAIR_DOCS", 10)
    monkeypatch.setattr(topics, "dealt", lambda rows, *keys, each: seen.append(each) or dealt(rows, *keys, each=each))
    monkeypatch.setattr(topics, "materialise", lambda df, tag, real=topics.materialise: seen.append(int(spark.conf.get("spark.sql.shuffle.partitions"))) or real(df, tag))
    assert sorted(registry.queries()["bigram_frequency"](spark, DATA).collect()) == want
    assert seen == [10, 21] and spark.conf.get("spark.sql.shuffle.partitions") == before
