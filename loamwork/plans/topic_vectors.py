"""Topics from vectors: word vectors learned from the texts, density clusters, and the models built on them.

What stands in for components that need libraries which are not there:

* sentence embeddings: means of word vectors that are trained on the same texts;
* a nearest-neighbour embedding in few dimensions: principal components;
* hierarchical density clusters: one cut of the graph of mutual reachability among near
  neighbours. Vectors that are not dense enough, or in clusters that are too small, are
  outliers (-1).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import PCA, Word2Vec
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loamwork.operators.components import components
from loamwork.operators.salted import lookup
from loamwork.plans.documents import class_scores, table, word_counts
from loamwork.plans.preprocessing import LEAST_DOCUMENTS, require_documents
from loamwork.plans.registry import register
from loamwork.plans.topic_models import diverse, merge_topics, reassigned_by
from loamwork.plans.topics import nearest_means
from loamwork.session import materialise

#: Vectors that are compared with each other at once, cells that are looked in, and cells that are sent to the tasks at most.
CELL_ROWS, PROBES, MOST_CELLS = 1024, 4, 4096
WORD_DIMENSIONS, LEAST_COUNT, SEED = 32, 5, 42
#: Characters of texts that one task learns word vectors from.
TASK_CHARS = 32_000_000
CANDIDATES, KEYWORDS = 30, 10


@dataclass(frozen=True)
class Variant:
    """Settings of a topic model."""

    neighbours: int = 15
    dimensions: int = 5
    cluster: int = 30
    samples: int = 15
    #: Share of the vectors whose density is enough.
    dense: float = 0.85
    topics: int | None = None
    #: Outliers with a topic at least as similar as this join it; null: none do.
    reassign: float | None = None


# Settings of the models.
BASE = Variant()
OPTIMISED = Variant(neighbours=20, dimensions=10, cluster=60, samples=15, topics=120)
ENHANCED = Variant(neighbours=15, dimensions=10, cluster=50, samples=10, topics=80, reassign=0.1)


def adapted(n_documents: int, topics: int | None = None) -> Variant:
    """Settings for a small set of documents."""
    return Variant(neighbours=min(5, max(2, n_documents - 1)), dimensions=min(5, max(2, topics or 5)), cluster=max(2, min(5, n_documents // 10)), samples=1, topics=topics)


def near_neighbours(vectors: DataFrame, k: int, cell_rows: int = CELL_ROWS, probes: int = PROBES, seed: int = SEED) -> DataFrame:
    """(id, other, distance): the ``k`` nearest other vectors (id, v: array) of each, by Euclidean distance.

    Vectors lie in cells around means; each is compared with those of its nearest
    ``probes`` cells, with all vectors if there are no more cells than that. A cell with
    many vectors is parted by a hash of the id, so that no task compares more than about
    ``cell_rows`` with those that ask. Equal vectors count as neighbours.
    """
    n = vectors.count()
    cells = max(1, min(MOST_CELLS, n // cell_rows))
    rows = vectors.select("id", F.col("v").cast("array<double>").alias("v"))
    if cells > 1:
        sample = rows.sample(min(1.0, 256 * cells / n), seed=seed).select(array_to_vector("v").alias("features"))
        centres = np.array([c for c in KMeans(k=cells, seed=seed, maxIter=10).fit(sample).clusterCenters()])
    else:
        centres = np.zeros((1, len((rows.first() or {"v": [0.0]})["v"])))
    kind = vectors.schema["id"].dataType.simpleString()

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.array(batch.column("v").to_pylist(), float)
            far = (x**2).sum(1)[:, None] - 2 * x @ centres.T + (centres**2).sum(1)
            order = np.argsort(far, 1, kind="stable")[:, :probes]
            at = np.repeat(np.arange(len(x)), order.shape[1])
            yield pa.RecordBatch.from_pydict({"id": batch.column("id").take(pa.array(at)), "v": batch.column("v").take(pa.array(at)), "cell": pa.array(order.ravel().astype(np.int32)), "home": pa.array(np.tile(np.arange(order.shape[1]) == 0, len(x)))})

    asked = materialise(rows.mapInArrow(ask, f"id {kind}, v array<double>, cell int, home boolean"), "cells")
    # one row a cell
    parts = asked.filter("home").groupBy("cell").agg(F.ceil(F.count("*") / cell_rows).cast("int").alias("parts"))
    spread = asked.join(F.broadcast(parts), "cell").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).withColumn("inside", F.col("home") & (F.pmod(F.xxhash64("id"), F.col("parts")) == F.col("part")))

    def search(group: pa.Table) -> pa.Table:
        inside = group["inside"].to_numpy()
        x = np.array(group["v"].to_pylist(), float).reshape(len(inside), -1)
        own = np.flatnonzero(inside)
        out_q, out_o, out_d = [], [], []
        for at in range(0, len(x), 512):
            q = np.arange(at, min(at + 512, len(x)))
            d = np.maximum(0, (x[q] ** 2).sum(1)[:, None] - 2 * x[q] @ x[own].T + (x[own] ** 2).sum(1))
            d[q[:, None] == own[None, :]] = np.inf
            best = np.argsort(d, 1, kind="stable")[:, :k]
            ok = np.isfinite(np.take_along_axis(d, best, 1))
            out_q.append(np.repeat(q, best.shape[1])[ok.ravel()])
            out_o.append(own[best].ravel()[ok.ravel()])
            out_d.append(np.sqrt(np.take_along_axis(d, best, 1)).ravel()[ok.ravel()])
        q, o = (np.concatenate(p) if p else np.zeros(0, np.int64) for p in (out_q, out_o))
        return pa.table({"id": group["id"].take(pa.array(q)), "other": group["id"].take(pa.array(o)), "distance": pa.array(np.concatenate(out_d) if out_d else np.zeros(0))})

    found = spread.select("cell", "part", "id", "v", "inside").groupBy("cell", "part").applyInArrow(lambda t: search(t.drop(["cell", "part"])), f"id {kind}, other {kind}, distance double")
    nearest = F.slice(F.array_sort(F.collect_list(F.struct("distance", "other"))), 1, k)
    return found.filter("id <> other").groupBy("id").agg(nearest.alias("x")).select("id", F.explode("x").alias("y")).select("id", "y.other", "y.distance")


def density_clusters(vectors: DataFrame, samples: int, cluster: int, neighbours: int, dense: float = 0.85, **search) -> DataFrame:
    """(id, topic): clusters of vectors (id, v) that are linked by mutual reachability, the largest first; -1 for outliers.

    A vector's core distance is that to its ``samples``-th neighbour. Neighbours link when
    their distance and both core distances are at most the one that the share ``dense``
    of the vectors has. Clusters have at least ``cluster`` vectors.
    """
    edges = materialise(near_neighbours(vectors, max(samples, neighbours), **search), "neighbours")
    place = Window.partitionBy("id").orderBy("distance", "other")
    core = materialise(edges.withColumn("p", F.row_number().over(place)).filter(F.col("p") <= samples).groupBy("id").agg(F.max("distance").alias("core")), "cores")
    limit = core.agg(F.percentile_approx("core", dense, 10_000)).first()[0]
    if limit is None:
        return vectors.select("id", F.lit(-1).cast("long").alias("topic"))
    able = core.filter(F.col("core") <= limit).select("id")
    links = edges.filter(F.col("distance") <= limit).join(able, "id").join(able.withColumnRenamed("id", "other"), "other").select(F.col("id").alias("a"), F.col("other").alias("b"))
    groups = materialise(components(links), "groups")
    sizes = groups.groupBy("component").agg(F.count("*").alias("n")).filter(F.col("n") >= cluster)
    # clusters have at least ``cluster`` vectors, so there are few; they are numbered by size
    numbered = sizes.withColumn("topic", (F.row_number().over(Window.orderBy(F.desc("n"), "component")) - 1).cast("long")).select("component", "topic")
    member = lookup(groups, ["component"], ["node"], numbered).select(F.col("node").alias("id"), "topic")
    return vectors.select("id").join(member, "id", "left").select("id", F.coalesce("topic", F.lit(-1).cast("long")).alias("topic"))


def reduced(vectors: DataFrame, dimensions: int) -> DataFrame:
    """Vectors (id, v) of unit length in their first principal components."""
    size = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    unit = vectors.select("id", F.col("v").cast("array<double>").alias("v")).select("id", array_to_vector(F.transform("v", lambda x: x / F.greatest(size, F.lit(1e-12)))).alias("features"))
    model = PCA(k=dimensions, inputCol="features", outputCol="out").fit(unit)
    return model.transform(unit).select("id", vector_to_array("out").alias("v"))


def _words(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.expr("regexp_extract_all(lower(coalesce(text, '')), '[a-z]{3,}', 0)").alias("words"))


def word_model(docs: DataFrame, dimensions: int = WORD_DIMENSIONS, least: int = LEAST_COUNT):
    """Word vectors learned from all texts (doc_id, text); words with fewer places than ``least`` have none.

    Every TASK_CHARS characters of texts are another task's; the tasks' vectors are averaged.
    """
    chars = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    return Word2Vec(vectorSize=dimensions, minCount=least, seed=SEED, maxIter=1, windowSize=5, numPartitions=1 + chars // TASK_CHARS, inputCol="words", outputCol="v").fit(_words(docs))


def document_vectors(docs: DataFrame, model) -> DataFrame:
    """(id, v): the mean of each text's word vectors; texts without known words have zeros."""
    return model.transform(_words(docs)).select(F.col("doc_id").alias("id"), vector_to_array("v").alias("v"))


def topic_model(docs: DataFrame, variant: Variant) -> tuple[DataFrame, DataFrame]:
    """(doc_id, topic) and the vectors (id, v) of documents (doc_id, text): embedded, reduced, clustered by density, merged and outliers put right, as the variant says.

    Raises ValueError for fewer than LEAST_DOCUMENTS documents.
    """
    require_documents(docs, LEAST_DOCUMENTS)
    vectors = materialise(document_vectors(docs, word_model(docs)), "document-vectors")
    found = density_clusters(materialise(reduced(vectors, variant.dimensions), "reduced"), variant.samples, variant.cluster, variant.neighbours, variant.dense)
    topics = materialise(found.select(F.col("id").alias("doc_id"), "topic"), "clusters")
    if variant.reassign is not None:
        marked = docs.join(topics, "doc_id").select("doc_id", F.when(F.col("topic") >= 0, F.col("topic").cast("string")).alias("topic"), "text")
        moved = reassigned_by(marked, variant.reassign).select("doc_id", F.col("topic").cast("long").alias("to"))
        topics = materialise(topics.join(moved, "doc_id", "left").select("doc_id", F.coalesce("to", "topic").alias("topic")), "reassigned")
    if variant.topics is not None:
        topics = merged(topics, vectors, variant.topics)
    return topics, vectors


def topic_means(topics: DataFrame, vectors: DataFrame) -> list[tuple[int, int, np.ndarray]]:
    """(topic, size, mean vector) by topic, without outliers. Topics have at least as many documents as a cluster must have, so they are few."""
    rows = topics.filter("topic >= 0").join(vectors, topics["doc_id"] == vectors["id"]).select("topic", F.posexplode("v").alias("i", "x"))
    means = rows.groupBy("topic", "i").agg(F.avg("x").alias("x"), F.count("*").alias("n")).groupBy("topic").agg(F.max("n").alias("n"), F.array_sort(F.collect_list(F.struct("i", "x"))).alias("v"))
    return sorted((r["topic"], r["n"], np.array([y["x"] for y in r["v"]])) for r in means.collect())


def merged(topics: DataFrame, vectors: DataFrame, most: int) -> DataFrame:
    """Topics merged, the most similar first, until ``most`` are left."""
    known = topic_means(topics, vectors)
    if len(known) <= most:
        return topics
    group = merge_topics(np.array([n for _, n, _ in known]), np.array([v for _, _, v in known]), most)
    names = [t for t, _, _ in known]
    renamed = topics.sparkSession.createDataFrame([(t, names[g]) for t, g in zip(names, map(int, group), strict=True)], "topic long, into long")
    return topics.join(F.broadcast(renamed), "topic", "left").select("doc_id", F.coalesce("into", "topic").alias("topic"))


def representations(docs: DataFrame, topics: DataFrame, diversity: float = 0.3) -> DataFrame:
    """(topic, kind, place, word): KEYWORDS keywords of each topic by three rules.

    default: class-based TF-IDF. mmr: of the CANDIDATES best, relevant ones that differ
    from each other. embedding: of those, the ones whose vectors are most like the mean of
    the topic's documents. Words' vectors are learned from all texts.
    """
    model = word_model(docs)
    scored = class_scores(word_counts(docs.join(topics.filter("topic >= 0"), "doc_id").select("topic", "text")))
    best = Window.partitionBy("topic").orderBy(F.desc("score"), "word")
    top = scored.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= CANDIDATES)
    known = model.getVectors().select("word", vector_to_array("vector").alias("v"))
    means = docs.sparkSession.createDataFrame([(t, v.tolist()) for t, _, v in topic_means(topics, document_vectors(docs, model))], "topic long, mean array<double>")
    rows = top.join(known, "word", "left").join(F.broadcast(means), "topic")

    def pick(group: pa.Table) -> pa.Table:
        rows = sorted(group.to_pylist(), key=lambda r: r["place"])
        zero = [0.0] * len(rows[0]["mean"])
        vectors, mean = np.array([r["v"] or zero for r in rows]), np.array(rows[0]["mean"])
        relevance = np.array([r["score"] for r in rows]) / max(1e-12, max(r["score"] for r in rows))
        likeness = vectors @ mean / np.maximum(1e-12, np.linalg.norm(vectors, axis=1) * np.linalg.norm(mean))
        chosen = {"default": list(range(len(rows)))[:KEYWORDS], "mmr": diverse(relevance, vectors, KEYWORDS, diversity), "embedding": np.argsort(-likeness, kind="stable")[:KEYWORDS].tolist()}
        out = [(rows[0]["topic"], kind, place, rows[k]["word"]) for kind, ks in chosen.items() for place, k in enumerate(ks, 1)]
        return pa.Table.from_pylist([dict(zip(("topic", "kind", "place", "word"), x, strict=True)) for x in out], pa.schema([("topic", pa.int64()), ("kind", pa.string()), ("place", pa.int64()), ("word", pa.string())]))

    return rows.groupBy("topic").applyInArrow(pick, "topic long, kind string, place long, word string")


def _docs(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))


@register("density_clusters")
def density_clusters_query(spark, sf_dir):
    """Density clusters of the embeddings in ten dimensions, with settings for their number."""
    vectors = table(spark, sf_dir, "embeddings").filter("embedding IS NOT NULL").select(F.col("vec_id").alias("id"), F.col("embedding").alias("v"))
    variant = replace(adapted(vectors.count()), samples=5, dimensions=10, neighbours=15)
    low = materialise(reduced(vectors, variant.dimensions), "reduced")
    return density_clusters(low, variant.samples, variant.cluster, variant.neighbours, variant.dense).select(F.col("id").alias("vec_id"), "topic")


@register("enhanced_topics")
def enhanced_topics(spark, sf_dir):
    """The topic of each document by the enhanced model: word vectors, density clusters, outliers put right, topics merged."""
    docs = _docs(spark, sf_dir)
    n = docs.count()
    # the settings are for tens of thousands of paragraphs; fewer documents have smaller clusters
    return topic_model(docs, ENHANCED if n >= 1000 * ENHANCED.cluster else replace(ENHANCED, cluster=adapted(n).cluster, samples=3))[0]


@register("keyword_kinds")
def keyword_kinds(spark, sf_dir):
    """Keywords of topics by three rules; documents' sources stand in for topics."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.regexp_extract("source", "([0-9]+)$", 1).cast("long").alias("topic"))
    return representations(docs.select("doc_id", "text"), docs.select("doc_id", "topic"))


@register("vector_topics")
def vector_topics(spark, sf_dir):
    """Every document with the topic whose mean it is most like and how far it is from it: no outliers."""
    docs = _docs(spark, sf_dir)
    topics, vectors = topic_model(docs, adapted(docs.count()))
    means = [(t, v.tolist()) for t, _, v in topic_means(topics, vectors)]
    return nearest_means(vectors, means).select(F.col("id").alias("doc_id"), "topic", F.round(1 - F.col("similarity"), 6).alias("distance"))
