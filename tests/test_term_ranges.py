"""Runs of words are the same, whether or not those with rare words are left out beforehand."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from loamwork.plans import registry, topic_tables
from loamwork.plans.topic_tables import term_range_counts


@pytest.mark.parametrize("least", [3, 0.2])
def test_runs_by_hand(spark, monkeypatch, least):
    rng = np.random.default_rng(6)
    texts = [[*map(str, rng.choice(["the", "a", "b", "c", "d", *map(str, range(9))], rng.integers(0, 12)))] for _ in range(30)]
    df = {}
    for t in texts:
        w = [x for x in t if x != "the"]
        for term in {" ".join(w[k : k + n]) for n in (1, 2, 3) for k in range(len(w) - n + 1)}:
            df[term] = df.get(term, 0) + 1
    low = least * 30 if least < 1 else least
    want = {k: n for k, n in df.items() if low <= n <= 0.5 * 30}
    docs = spark.createDataFrame([(t,) for t in texts], "words array<string>")
    made = []
    for most_words in (20_000, 0):
        monkeypatch.setattr(topic_tables, "PRUNING_WORDS", most_words)
        real = F.array_join
        monkeypatch.setattr(topic_tables.F, "forall", lambda *a, real=F.forall: made.append(most_words) or real(*a))
        got = term_range_counts(docs, 1, 3, least, 0.5, ["the"]).collect()
        assert {r.term: r.df for r in got} == want and len(got) == len(want) and real
    assert set(made) == {20_000}


def test_word_totals_stay_sparse(spark):
    """How many words a text has is summed over its own words, not over all words."""
    rows = registry.queries()["lda_documents"](spark, "/root/testdata/sf0.001")
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert "aggregate(" not in plan.replace("Aggregate", "")
    docs = {r.doc_id: r.w for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", F.expr("regexp_extract_all(lower(text), '[a-z]{3,}', 0)").alias("w")).collect()}
    df = {}
    for w in docs.values():
        for x in set(w):
            df[x] = df.get(x, 0) + 1
    known = {x for x, n in df.items() if 2 <= n <= 0.95 * len(docs)}
    assert {r.doc_id: r.n_words for r in rows.collect()} == {d: sum(x in known for x in w) for d, w in docs.items()}
