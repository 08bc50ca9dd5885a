"""Every registered query with SQL gives the rows that DuckDB gives."""

import glob
import math
import os

import duckdb
import pytest

from loamwork.plans import registry

DATA = "/root/testdata/sf0.001"


def _plain(v):
    return round(v, 4) if isinstance(v, float) and not math.isnan(v) else float(v) if type(v).__name__ == "Decimal" else v


def rows(names, found):
    return sorted((tuple(str(_plain(r[names.index(c)])) for c in sorted(names)) for r in found))


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query(spark, name):
    con = duckdb.connect()
    for f in glob.glob(f"{DATA}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    want = con.execute(registry.oracle_sql()[name])
    names = [d[0] for d in want.description]
    got = registry.queries()[name](spark, DATA)
    assert sorted(got.columns) == sorted(names)
    assert rows(got.columns, [tuple(r) for r in got.collect()]) == rows(names, want.fetchall())
