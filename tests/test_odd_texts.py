"""Queries on odd texts give the rows that DuckDB gives."""

import duckdb
import pytest
from pyspark.sql import functions as F
from test_queries import rows

from loamwork.functions import text as T
from loamwork.plans import registry


def same_rows(spark, name, folder, tables):
    """Whether a query gives its SQL's rows on ``tables``, written to ``folder``."""
    con = duckdb.connect()
    for table, (values, schema) in tables.items():
        spark.createDataFrame(values, schema).coalesce(1).write.parquet(f"{folder}/{table}.parquet")
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet/*.parquet'")
    want = con.execute(registry.oracle_sql()[name])
    names = [d[0] for d in want.description]
    got = registry.queries()[name](spark, str(folder))
    assert rows(got.columns, [tuple(r) for r in got.collect()]) == rows(names, want.fetchall())


def documents(*texts):
    return {"documents": ([(k, t) for k, t in enumerate(texts, 1)], "doc_id long, text string")}


@pytest.mark.parametrize("name", ["extraction_differences"])
def test_empty_texts(spark, tmp_path, name):
    same_rows(spark, name, tmp_path, documents("", None, "ab 1,2", "   ", "1234567890"))


def test_capitals_of_single_letters(spark, tmp_path):
    """A sharp s is no SS: as symbols of companies, as words of texts, and in their results."""
    tables = documents("Die Gasse ist lang", "Die Gaße ist lang", "GASSE GASẞE", "ΟΔΟΣ ΟΔΟΣ und", "İ ist İzmir", "x " * 2000 + "Gaße ist", "ﬁne FINE ᾳ")
    items = [(1, "Gasse ist hier"), (2, "Gaße ist dort"), (3, "οδος und"), (4, "İzmir ist"), (5, "ﬁne ist"), (6, "ᾳ ist")]
    same_rows(spark, "company_matches", tmp_path, tables | {"benchmark": (items, "item_id long, text string")})


def test_case_letter_by_letter(spark):
    every = [chr(k) for k in range(0x20, 0x20000) if not 0xD800 <= k < 0xE000]
    cased = [c for c in every if c.upper() != c or c.lower() != c or c.title() != c]
    want = duckdb.connect().execute("SELECT c, upper('a' || c || ' '), lower('a' || c || ' ') FROM (SELECT unnest($1::VARCHAR[]) AS c)", [cased]).fetchall()
    t = F.concat(F.lit("a"), "c", F.lit(" "))
    got = spark.createDataFrame([(c,) for c in cased], "c string").select("c", T.upper(t), T.lower(t)).collect()
    assert sorted(want) == sorted(map(tuple, got))
