"""Word vectors are learned by as many tasks as the texts need."""

import numpy as np
from pyspark.sql import functions as F

from loamwork.plans import topic_vectors as V
from loamwork.plans.topics import nearest_means

KINDS = ["water energy carbon emission waste solar", "board audit risk policy committee director"]


def test_vectors_of_several_tasks(spark, monkeypatch):
    rng = np.random.default_rng(1)
    docs = spark.createDataFrame([(k, " ".join(rng.choice(KINDS[k % 2].split(), 60))) for k in range(200)], "doc_id long, text string")
    chars = docs.agg(F.sum(F.length("text"))).first()[0]
    tasks, learner = [], V.Word2Vec
    monkeypatch.setattr(V, "TASK_CHARS", chars // 3)
    monkeypatch.setattr(V, "Word2Vec", lambda **k: tasks.append(k["numPartitions"]) or learner(**k))
    words = V.representations(docs, docs.select("doc_id", (F.col("doc_id") % 2).alias("topic"))).collect()
    assert tasks == [4]
    assert len(words) == 2 * 3 * 6 and all(r.word in KINDS[r.topic].split() for r in words)
    assert V.word_model(docs.withColumn("text", F.lit("one word here")), least=1).getVectors().count() == 3
    assert tasks == [4, 1]


def test_means_in_blocks(spark, monkeypatch):
    rng = np.random.default_rng(2)
    x, means = rng.normal(size=(50, 4)), rng.normal(size=(23, 4))
    means[20] = means[3]
    rows = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "id long, v array<double>")
    near = (x @ means.T) / np.linalg.norm(means, axis=1) / np.linalg.norm(x, axis=1)[:, None]
    best = near.shape[1] - 1 - near.round(9)[:, ::-1].argmax(1)
    monkeypatch.setattr("loamwork.plans.topics.MEANS_AT_ONCE", 5)
    monkeypatch.setattr("loamwork.plans.topics.VECTORS_AT_ONCE", 7)
    got = {r.id: (r.topic, r.similarity) for r in nearest_means(rows, [(k, v.tolist()) for k, v in enumerate(means)]).collect()}
    assert all(got[k][0] == best[k] and abs(got[k][1] - near[k, best[k]]) < 1e-9 for k in range(50))
