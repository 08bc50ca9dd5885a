"""Near duplicates around the bar, against brute force on the exact shingle sets."""

import numpy as np

from loamwork.llm.near_dedup import near_components


def shingles(text):
    w = text.split()
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)}


def test_links_are_those_of_exact_sets(spark):
    rng = np.random.default_rng(7)
    texts = []
    for k in range(160):  # pairs from 0.6 to 0.95 by words changed at random places, and by a changed end
        words = [f"w{x}" for x in rng.integers(0, 10_000, 60 + 2 * k)]
        texts.append(" ".join(words))
        for m in range(2):
            other, n = words.copy(), rng.uniform(0.03, 0.25) * len(words)
            places = rng.choice(len(words), max(1, int(n / 5)), replace=False) if m else range(len(words) - int(n), len(words))
            for p in places:
                other[p] = f"n{rng.integers(0, 10_000)}"
            texts.append(" ".join(other))
    texts += [None, "", "one two", "One  two"]
    docs = spark.createDataFrame([*enumerate(texts)], "doc_id long, text string").repartition(3)
    parent, at_bar = [*range(len(texts))], []

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    sets = [shingles(t or "") for t in texts]
    for a in range(480):
        for b in range(a + 1, min(480, a - a % 3 + 3)):
            j = len(sets[a] & sets[b]) / len(sets[a] | sets[b])
            at_bar.append(0.7 < j < 0.86)
            if j >= 0.8:
                parent[root(max(a, b))] = min(root(a), root(b))
    for a, b in ((480, 481), (482, 483)):
        parent[b] = a
    assert sum(at_bar) > 100
    for rows in (16_384, 40):
        got = {r.doc_id: r.component_id for r in near_components(docs, 5, 0.8, shard_rows=rows).collect()}
        assert got == {k: root(k) for k in range(len(texts))}
    assert near_components(docs.limit(0), 5, 0.8).count() == 0
