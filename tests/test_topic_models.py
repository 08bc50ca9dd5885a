import math
from itertools import combinations

import numpy as np

from loamwork.plans import registry
from loamwork.plans.topic_models import coherence, diverse, merge_topics, topic_coherences, window_counts
from loamwork.streaming.attempts import run_upserts, window_counts as hours

DATA = "/root/testdata/sf0.001"


def test_merge_and_diversity():
    v = np.array([[1, 0], [0.99, 0.1], [0, 1], [0.1, 1.0]])
    assert merge_topics(np.array([3, 2, 1, 1]), v, 2).tolist() == [0, 0, 2, 2]
    assert merge_topics(np.array([3, 2, 1, 1]), v, 9).tolist() == [0, 1, 2, 3]
    assert diverse(np.array([1.0, 0.99, 0.8]), np.array([[1.0, 0], [1, 0], [0, 1]]), 2) == [0, 2] and diverse(np.zeros(0), np.zeros((0, 2)), 2) == []


def test_coherence_against_windows(spark):
    rng = np.random.default_rng(2)
    texts = [" ".join(rng.choice(["aaa", "bbb", "ccc", "ddd", "eee"], n, p=[0.1, 0.1, 0.05, 0.05, 0.7])) for n in (0, 1, 9, 10, 11, 60)]
    topic = ["aaa", "bbb", "ccc"]
    windows, counts = 0, np.zeros((3, 3), int)
    for t in texts:
        w = t.split()
        if not w:
            continue
        for k in range(max(1, len(w) - 10 + 1)):
            have = {*w[k : k + 10]}
            windows += 1
            for i in range(3):
                counts[i, i] += topic[i] in have
            for i, j in combinations(range(3), 2):
                both = topic[i] in have and topic[j] in have
                counts[i, j] += both
                counts[j, i] += both
    found = [window_counts(t.split(), [topic], 10) for t in texts if t]
    n = sum(x for x, _ in found)
    assert n == windows and (sum(m[0] for _, m in found) == counts).all()
    docs = spark.createDataFrame([(t,) for t in texts] + [(None,)], "text string")
    (name, got), = topic_coherences(docs, {"t": topic}, 10)
    npmi = [[math.log((counts[i, j] / n + 1e-12) / (counts[i, i] * counts[j, j] / n / n)) / -math.log(counts[i, j] / n + 1e-12) for j in range(3)] for i in range(3)]
    whole = np.sum(npmi, 0)
    want = np.mean([np.dot(v, whole) / np.linalg.norm(v) / np.linalg.norm(whole) for v in npmi])
    assert name == "t" and abs(got - want) < 1e-9 and coherence(0, np.zeros((0, 0))) == 0.0


def test_queries(spark):
    q = registry.queries()
    merged = q["merged_topics"](spark, DATA).collect()
    assert len(merged) == 500 and len({r.topic for r in merged}) <= 6
    assert all(-1 <= r.coherence <= 1 for r in q["topic_coherence"](spark, DATA).collect())
    assert q["layout_lines"](spark, DATA).count() > 0


def test_stream_resumes(spark, tmp_path):
    rows = lambda ks: spark.createDataFrame([(k, "a" if k % 2 else "b", float(k)) for k in ks], "k long, event_type string, value double").selectExpr("timestamp_seconds(k * 900) AS ts", "event_type", "value")
    schema = rows([0]).schema
    for part, n in ((range(10), (10, 6)), (range(10, 20), (20, 10))):
        rows(part).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        got = run_upserts(hours(stream), ["start", "event_type"], str(tmp_path / "out"))
        assert (sum(r.n for r in got.collect()), got.count()) == n
