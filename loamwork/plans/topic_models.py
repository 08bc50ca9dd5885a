"""Queries on topic models: outliers reassigned, topics merged, diverse keywords, coherence, comparison."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loamwork.plans.documents import table, topic_keywords
from loamwork.plans.registry import register
from loamwork.plans.topics import centroids
from loamwork.session import materialise

#: Cosine from which an outlier joins a topic, and the number of topics to reduce to.
REASSIGN, TOPICS = 0.1, 6
#: Words of a window in which words count as standing together.
WINDOW = 110
#: Weight of variety against relevance, and candidates a topic.
DIVERSITY, CANDIDATES = 0.3, 30

_WORDS = "regexp_extract_all(lower(text), '[a-z]{3,}')"


def reassigned_by(docs: DataFrame, least: float = REASSIGN) -> DataFrame:
    """(doc_id, topic, similarity) for documents (doc_id, topic, text) of no topic: the topic of the most similar words, -1 under ``least``.

    Words weigh as in class-based TF-IDF, in documents as in topics; the similarity is
    the cosine, and of equals the first topic wins. Each text is read once: the words of
    topics and those of outliers are counted and written apart.
    """
    words = F.explode(F.expr("regexp_extract_all(lower(text), '[a-z]{3,}', 0)")).alias("word")
    alone = F.when(F.col("topic").isNull(), F.col("doc_id"))
    counted = docs.select("topic", alone.alias("doc"), words).groupBy("topic", "doc", "word").agg(F.count("*").alias("n"))
    counted = materialise(counted, "topic-words")
    counts = counted.filter("topic IS NOT NULL")
    total = counts.groupBy("word").agg(F.sum("n").alias("total"))
    # one row
    mean = counts.agg((F.sum("n") / F.countDistinct("topic")).alias("mean"))
    idf = materialise(total.crossJoin(F.broadcast(mean)).select("word", F.log(1 + F.col("mean") / F.col("total")).alias("idf")), "word-weights")
    topics = materialise(counts.join(idf, "word").select("topic", "word", (F.col("n") * F.col("idf")).alias("t")), "topic-weights")
    length = topics.groupBy("topic").agg(F.sqrt(F.sum(F.col("t") * F.col("t"))).alias("long"))
    mine = materialise(counted.filter("topic IS NULL").join(idf, "word").select(F.col("doc").alias("doc_id"), "word", (F.col("n") * F.col("idf")).alias("d")), "outlier-weights")
    size = mine.groupBy("doc_id").agg(F.sqrt(F.sum(F.col("d") * F.col("d"))).alias("own"))
    dots = mine.join(topics, "word").groupBy("doc_id", "topic").agg(F.sum(F.col("d") * F.col("t")).alias("dot"))
    scored = dots.join(length, "topic").join(size, "doc_id").select("doc_id", "topic", F.round(F.col("dot") / F.col("long") / F.col("own"), 6).alias("s"))
    best = scored.groupBy("doc_id").agg(F.min(F.struct((-F.col("s")).alias("less"), "topic")).alias("b"))
    sure = F.coalesce(-F.col("b.less"), F.lit(0.0))
    return docs.filter("topic IS NULL").select("doc_id").join(best, "doc_id", "left").select("doc_id", F.when(sure >= least, F.col("b.topic")).otherwise("-1").alias("topic"), sure.alias("similarity"))


@register(
    "outliers_reassigned",
    f"""
    WITH d AS (SELECT doc_id, CASE WHEN length(text) >= 600 THEN source END AS topic, text FROM documents),
    w AS (SELECT doc_id, topic, unnest({_WORDS}) AS word FROM d),
    c AS (SELECT topic, word, count(*) AS n FROM w WHERE topic IS NOT NULL GROUP BY ALL),
    a AS (SELECT sum(n) / count(DISTINCT topic) AS mean FROM c),
    f AS (SELECT word, ln(1 + any_value(mean) / sum(n)) AS idf FROM c, a GROUP BY word),
    t AS (SELECT topic, word, n * idf AS t FROM c JOIN f USING (word)), l AS (SELECT topic, sqrt(sum(t * t)) AS long FROM t GROUP BY topic),
    m AS (SELECT doc_id, word, count(*) * any_value(idf) AS d FROM w JOIN f USING (word) WHERE topic IS NULL GROUP BY ALL), o AS (SELECT doc_id, sqrt(sum(d * d)) AS own FROM m GROUP BY doc_id),
    s AS (SELECT doc_id, topic, round(sum(d * t) / any_value(long) / any_value(own), 6) AS s FROM m JOIN t USING (word) JOIN l USING (topic) JOIN o USING (doc_id) GROUP BY doc_id, topic),
    b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY s DESC, topic) = 1)
    SELECT doc_id, CASE WHEN coalesce(s, 0) >= {REASSIGN} THEN b.topic ELSE '-1' END AS topic, coalesce(s, 0) AS similarity FROM d LEFT JOIN b USING (doc_id) WHERE d.topic IS NULL
    """,
)
def outliers_reassigned(spark, sf_dir):
    """Short documents, which say too little to found a topic, join the topic whose words are like their own."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.when(F.length("text") >= 600, F.col("source")).alias("topic"), "text")
    return reassigned_by(docs)


def merge_topics(sizes: np.ndarray, vectors: np.ndarray, n: int) -> np.ndarray:
    """For each topic the number of the one it ends in: the least of the two most similar topics are merged, by size-weighted means, until ``n`` are left."""
    group, size, vector = np.arange(len(sizes)), sizes.astype(float), vectors.astype(float).copy()
    alive = [*range(len(sizes))]
    while len(alive) > max(1, n):
        unit = vector[alive] / np.maximum(np.sqrt((vector[alive] ** 2).sum(1, keepdims=True)), 1e-12)
        near = (unit[:, None, :] * unit[None, :, :]).sum(2)
        near[np.tril_indices(len(alive))] = -np.inf
        i, j = divmod(int(near.argmax()), len(alive))
        a, b = alive[i], alive[j]
        vector[a] = (size[a] * vector[a] + size[b] * vector[b]) / max(1.0, size[a] + size[b])
        size[a] += size[b]
        group[group == b] = a
        alive.remove(b)
    return group


@register("merged_topics")
def merged_topics(spark, sf_dir):
    """Each vector's topic after topics are merged to TOPICS; only centroids, whose number is bounded, reach the driver."""
    vectors = table(spark, sf_dir, "embeddings")
    known = centroids(vectors)
    count = {r["label"]: r["count"] for r in vectors.groupBy("label").count().collect()}
    names = [label for label, _ in known]
    group = merge_topics(np.array([count[x] for x in names]), np.array([c for _, c in known]), TOPICS) if known else []
    renamed = spark.createDataFrame([(x, names[g]) for x, g in zip(names, map(int, group), strict=True)], "label int, topic int")
    return vectors.join(F.broadcast(renamed), "label").select("vec_id", "label", "topic")


def diverse(relevance: np.ndarray, vectors: np.ndarray, k: int, diversity: float = DIVERSITY) -> list[int]:
    """Maximal marginal relevance: the most relevant first, then each time the best of relevance less likeness to those taken."""
    if not len(relevance):
        return []
    unit = vectors / np.maximum(np.sqrt((vectors**2).sum(1, keepdims=True)), 1e-12)
    near = unit @ unit.T
    taken = [int(relevance.argmax())]
    while len(taken) < min(k, len(relevance)):
        score = (1 - diversity) * relevance - diversity * near[:, taken].max(1)
        score[taken] = -np.inf
        taken.append(int(score.argmax()))
    return taken


def window_counts(tokens: list[str], topics: list[list[str]], window: int = WINDOW) -> tuple[int, list[np.ndarray]]:
    """Windows of a text, and for each topic in how many of them two of its words stand (on the diagonal: one)."""
    n = max(1, len(tokens) - window + 1)
    at: dict[str, list[int]] = {}
    wanted = {w for t in topics for w in t}
    for k, w in enumerate(tokens):
        if w in wanted:
            at.setdefault(w, []).append(k)
    in_window = {}
    for w, places in at.items():
        edge = np.zeros(n + 1, np.int64)
        p = np.array(places)
        np.add.at(edge, np.clip(p - window + 1, 0, n), 1)
        np.add.at(edge, np.minimum(p + 1, n), -1)
        in_window[w] = np.cumsum(edge[:n]) > 0
    out = []
    for t in topics:
        m = np.array([in_window.get(w, np.zeros(n, bool)) for w in t]).reshape(len(t), n).astype(np.float32)
        out.append((m @ m.T).round().astype(np.int64))
    return n, out


def coherence(windows: int, counts: np.ndarray) -> float:
    """c_v of a topic: mean cosine of its words' NPMI vectors and their sum (Roeder, Both and Hinneburg, 2015)."""
    p = counts / max(1, windows)
    own = np.diag(p)
    joint = p + 1e-12
    with np.errstate(divide="ignore", invalid="ignore"):
        npmi = np.where(own[:, None] * own[None, :] > 0, np.log(joint / (own[:, None] * own[None, :])) / -np.log(joint), 0.0)
    npmi = np.nan_to_num(npmi, nan=0.0, posinf=0.0, neginf=0.0)
    whole = npmi.sum(0)
    size = np.sqrt((npmi**2).sum(1) * (whole**2).sum())
    return float(np.mean(np.where(size > 0, npmi @ whole / np.where(size > 0, size, 1), 0.0))) if len(counts) else 0.0


def topic_coherences(docs: DataFrame, topics: dict[str, list[str]], window: int = WINDOW) -> list[tuple[str, float]]:
    """(topic, c_v) of topics' words over all whole texts; tasks add up counts, so topics times words squared numbers come back from each."""
    names = sorted(topics)
    lists = [topics[t] for t in names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows, sums = 0, [np.zeros((len(x), len(x)), np.int64) for x in lists]
        for batch in batches:
            for t in batch.column("w").to_pylist():
                if t:
                    n, found = window_counts(t, lists, window)
                    windows += n
                    sums = [a + b for a, b in zip(sums, found, strict=True)]
        flat = np.concatenate([[windows], *(s.ravel() for s in sums)])
        yield pa.RecordBatch.from_pydict({"k": pa.array(np.arange(len(flat))), "n": pa.array(flat)})

    words = docs.select(F.expr("regexp_extract_all(lower(text), '[a-z]{3,}', 0)").alias("w"))
    total = {r["k"]: r["n"] for r in words.mapInArrow(run, "k long, n long").groupBy("k").agg(F.sum("n").alias("n")).collect()}
    out, at = [], 1
    for name, x in zip(names, lists, strict=True):
        n = len(x)
        out.append((name, coherence(total.get(0, 0), np.array([total.get(at + k, 0) for k in range(n * n)]).reshape(n, n))))
        at += n * n
    return out


@register("topic_coherence")
def topic_coherence(spark, sf_dir):
    """c_v of each topic's ten keywords over all documents."""
    words: dict[str, list[str]] = {}
    for r in topic_keywords(spark, sf_dir).orderBy("topic", "place").collect():  # ten rows a topic
        words.setdefault(r["topic"], []).append(r["word"])
    return spark.createDataFrame(topic_coherences(table(spark, sf_dir, "documents"), words), "topic string, coherence double")


@register(
    "model_comparison",
    """
    WITH t AS (SELECT 'first' AS model, CASE WHEN vec_id % 7 = 0 THEN -1 ELSE label END AS topic FROM embeddings UNION ALL SELECT 'second', label FROM embeddings),
    s AS (SELECT model, topic, count(*) AS n FROM t GROUP BY ALL),
    m AS (SELECT model, sum(n)::BIGINT AS documents, count(*) FILTER (topic <> -1) AS topics, coalesce(sum(n) FILTER (topic = -1), 0)::BIGINT AS outliers,
                 round(avg(n) FILTER (topic <> -1), 4) AS mean, (median(n) FILTER (topic <> -1))::DOUBLE AS middle, max(n) FILTER (topic <> -1) AS most, min(n) FILTER (topic <> -1) AS least FROM s GROUP BY model)
    SELECT *, round(100.0 * outliers / documents, 4)::DOUBLE AS outlier_percent,
           model = CASE WHEN max(CASE WHEN model = 'first' THEN abs(topics - 120) END) OVER () < max(CASE WHEN model = 'second' THEN abs(topics - 120) END) OVER () THEN 'first' ELSE 'second' END AS wins_topics,
           model = CASE WHEN max(CASE WHEN model = 'first' THEN 1.0 * outliers / documents END) OVER () < max(CASE WHEN model = 'second' THEN 1.0 * outliers / documents END) OVER () THEN 'first' ELSE 'second' END AS wins_outliers FROM m
    """,
)
def model_comparison(spark, sf_dir):
    """Figures of two models' topics side by side; the number nearest 120 and the fewest outliers win, ties go to the second."""
    vectors = table(spark, sf_dir, "embeddings")
    first = vectors.select(F.lit("first").alias("model"), F.when(F.col("vec_id") % 7 == 0, -1).otherwise(F.col("label")).alias("topic"))
    sizes = first.unionByName(vectors.select(F.lit("second").alias("model"), F.col("label").alias("topic"))).groupBy("model", "topic").agg(F.count("*").alias("n"))
    real, lost = F.when(F.col("topic") != -1, F.col("n")), F.when(F.col("topic") == -1, F.col("n"))
    m = sizes.groupBy("model").agg(
        F.sum("n").alias("documents"), F.count(real).alias("topics"), F.coalesce(F.sum(lost), F.lit(0)).alias("outliers"),
        F.round(F.avg(real), 4).alias("mean"), F.median(real).alias("middle"), F.max(real).alias("most"), F.min(real).alias("least"),
    )
    share = F.col("outliers") / F.col("documents")
    # two rows: one for each model
    both = m.agg(*(F.max(F.when(F.col("model") == k, c)).alias(f"{n}_{k}") for k in ("first", "second") for n, c in (("t", F.abs(F.col("topics") - 120)), ("o", share))))
    wins = lambda n: F.col("model") == F.when(F.col(f"{n}_first") < F.col(f"{n}_second"), "first").otherwise("second")
    return m.crossJoin(F.broadcast(both)).select(*m.columns, F.round(share * 100, 4).alias("outlier_percent"), wins("t").alias("wins_topics"), wins("o").alias("wins_outliers"))
