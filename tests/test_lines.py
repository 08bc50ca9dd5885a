import difflib

import numpy as np

from loamwork.plans import lines, registry
from loamwork.plans.lines import repeated_edges, without_edges

DATA = "/root/testdata/sf0.001"


def test_repeated_edges_go():
    pages = [f"Annual Report 2024 p{k}\n{'xyz'[k] * 12}\nmore text {'abc'[k] * 9}\n{k}\nPage {k}" for k in range(3)]
    repeated = repeated_edges(pages)
    got = [without_edges(p, repeated) for p in pages]
    assert all("Annual Report" not in p and "Page" not in p for p in got)
    assert [p.split("\n")[-1] for p in got] == ["more text " + c * 9 for c in "abc"]
    assert repeated_edges([]) == set()
    assert without_edges("one line", repeated_edges(["one line"])) == ""
    assert without_edges("keep\n12\npage 7\n page 12 ", set()) == "keep"


def test_queries_without_sql(spark):
    queries = registry.queries()
    assert queries["headers_removed"](spark, DATA).count() == spark.read.parquet(f"{DATA}/conversations.parquet").count()
    assert queries["compatible_text"](spark, DATA).count() == 200
    topics = queries["lda_topics"](spark, DATA).collect()
    assert len(topics) == 150 and all(r["word"] for r in topics)
    found = queries["vector_clusters"](spark, DATA).collect()
    assert len(found) == 500 and {r["topic"] for r in found} <= set(range(-1, 10))


def test_long_reports_are_compared_by_bounds(monkeypatch):
    """Lines that cannot be alike are told apart without a comparison; what is found is what comparing all of them finds."""
    rng = np.random.default_rng(5)
    heads = ["".join(rng.choice([*"abcd "], n)) for n in (9, 60, 230)]

    def changed(x):
        return "".join(rng.choice(["", "z", c + "q"]) if rng.random() < 0.06 else c for c in x)

    def alike(a, b):
        return a == b or difflib.SequenceMatcher(None, a, b).ratio() >= lines.SIMILAR

    for _ in range(30):
        pages = ["\n".join(changed(heads[rng.integers(3)]) for _ in range(rng.integers(1, 5))) for _ in range(6)]
        quick = repeated_edges(pages), [without_edges(p, repeated_edges(pages)) for p in pages]
        with monkeypatch.context() as m:
            m.setattr(lines, "_alike", alike)
            m.setattr(lines.Lines, "near", lambda self, line: range(len(self.lines)))
            assert quick == (repeated_edges(pages), [without_edges(p, repeated_edges(pages)) for p in pages])
    assert all(lines.common_subsequence(a, b) == n for a, b, n in (("", "", 0), ("abc", "", 0), ("abcbdab", "bdcaba", 4), ("xx", "axbxc", 2)))
    calls, real = [], difflib.SequenceMatcher
    with monkeypatch.context() as m:
        m.setattr(lines.difflib, "SequenceMatcher", lambda *a: calls.append(a) or real(*a))
        repeated_edges(["".join(rng.choice([*"abcdefghijklmnopqrstuvwxyz "], 100)) for _ in range(100)])
    assert len(calls) < 10
