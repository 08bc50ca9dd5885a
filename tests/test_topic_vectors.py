"""Neighbours and density clusters against brute force; the models on small sets."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from loamwork.plans import topic_vectors as V
from loamwork.plans.topics import nearest_means


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(4)
    x = np.concatenate([rng.normal(c, 0.1, (60, 3)) for c in ((0, 0, 0), (3, 0, 0), (0, 3, 0))] + [rng.uniform(-4, 8, (12, 3))])
    return x, spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "id long, v array<double>").repartition(3)


def test_neighbours(points):
    x, rows = points
    far = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2)) + np.diag([np.inf] * len(x))
    for size, probes, recall in ((10_000, 4, 1.0), (50, 99, 1.0), (16, 4, 0.9)):  # one cell; all cells; some cells
        got = V.near_neighbours(rows, 5, cell_rows=size, probes=probes).collect()
        found = {}
        for r in got:
            assert abs(r.distance - far[r.id, r.other]) < 1e-6
            found.setdefault(r.id, set()).add(r.other)
        hits = sum(len(found[k] & {*np.argsort(far[k], kind="stable")[:5].tolist()}) for k in range(len(x)))
        assert hits >= recall * 5 * len(x) and all(len(v) == 5 for v in found.values() if recall == 1)
    assert V.near_neighbours(rows.limit(0), 5).count() == 0


def test_clusters(points):
    x, rows = points
    got = {r.id: r.topic for r in V.density_clusters(rows, samples=5, cluster=20, neighbours=10, dense=0.9).collect()}
    assert {len({got[k] for k in range(a, a + 60)} - {-1}) for a in (0, 60, 120)} == {1} and len({*got.values()}) == 4
    assert sum(got[k] == -1 for k in range(180, 192)) >= 9 and sum(got[k] == -1 for k in range(180)) <= 18
    assert V.density_clusters(rows.limit(0), 5, 20, 10).count() == 0


def test_nearest_means(spark):
    rows = spark.createDataFrame([(1, [1.0, 0.1]), (2, [0.0, 2.0]), (3, None)], "id long, v array<double>")
    assert [(r.id, r.topic) for r in nearest_means(rows, [(4, [1.0, 0.0]), (7, [0.0, 1.0])]).orderBy("id").collect()] == [(1, 4), (2, 7)]
    assert nearest_means(rows, []).filter("topic IS NOT NULL").count() == 0


def test_models(spark):
    kinds = ["water energy carbon emission waste solar", "board audit risk policy committee director", "safety health worker wage training school"]
    rng = np.random.default_rng(0)
    docs = spark.createDataFrame([(k, " ".join(rng.choice(kinds[k % 3].split(), 40))) for k in range(90)], "doc_id long, text string")
    topics, _ = V.topic_model(docs, V.replace(V.adapted(90), samples=3, neighbours=8, cluster=10))
    got = {r.doc_id: r.topic for r in topics.collect()}
    named = {k: {got[d] for d in range(k, 90, 3)} - {-1} for k in range(3)}
    assert all(named.values()) and not named[0] & named[1] and not named[1] & named[2] and not named[0] & named[2]
    words = V.representations(docs, docs.select("doc_id", (F.col("doc_id") % 3).alias("topic"))).collect()
    assert len(words) == 3 * 3 * 6 and all(r.word in kinds[r.topic].split() for r in words)
    with pytest.raises(ValueError):
        V.topic_model(docs.limit(9), V.BASE)
    assert V.adapted(20) == V.Variant(neighbours=5, dimensions=5, cluster=2, samples=1)
