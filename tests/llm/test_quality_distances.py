"""Both distances and the verdict against brute force; texts without common words must go."""

import math
import random
import re
from collections import Counter

from loamwork.llm import quality as Q


def distance(p, q):
    p, q = ([v / sum(x) for v in x] for x in (p, q))
    terms = [(v * math.log2(2 * v / (v + w)) if v else 0) + (w * math.log2(2 * w / (v + w)) if w else 0) for v, w in zip(p, q, strict=True)]
    return math.sqrt(max(0, sum(terms) / 2))


def test_distances_and_verdict(spark):
    rng = random.Random(3)
    rows, kinds = [], {}
    for k in range(240):
        lang = ["en", "de", "fr", "es"][k % 4]
        kind = {5: "no common word", 9: "symbols", 13: "short"}.get(k % 17, "good")
        share = 0 if kind in ("no common word", "short") else 0.17
        n = 120 if kind == "short" else rng.randint(200, 400)
        words = [rng.choice(Q.COMMON_WORDS[lang]) if rng.random() < share else f"{rng.choice('bdfgk')}{''.join(rng.choices('aeiourstn', k=6))}" for _ in range(n)]
        text = (" ".join if kind != "symbols" else "### %%% ".join)(words)
        rows.append((k, text, lang))
        kinds[k] = kind
    measured = {}
    for k, text, lang in rows:
        words = Counter(text.split())
        common = [words[w] for w in Q.COMMON_WORDS[lang]]
        rest = re.sub(r"[^\W\d_]+", "", text)
        classes = [len(text) - len(rest), len(re.findall(r"\d", rest)), len(re.findall(r"\s", rest)), len(re.findall(r"""[.,;:!?'"()\-]""", rest))]
        measured[k] = lang, [*classes, len(text) - sum(classes)], [*common, words.total() - sum(common)]
    total = {lang: [[sum(c) for c in zip(*(m[i] for m in measured.values() if m[0] == lang), strict=True)] for i in (1, 2)] for lang in Q.COMMON_WORDS}
    got = {r.doc_id: r for r in Q.quality_rules(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    for k, (lang, classes, common) in measured.items():
        by_class, by_word = distance(classes, total[lang][0]), distance(common, total[lang][1])
        long = sum(common) >= Q.MIN_WORDS_FOR_COMMON
        g = got[k]
        assert abs(g.class_distance - by_class) < 1e-9
        assert abs(g.word_distance - by_word) < 1e-9 if long else g.word_distance is None
        assert g.kept == (not g.base_failed and by_class <= Q.MAX_CLASS_DISTANCE and not (long and by_word > Q.MAX_WORD_DISTANCE))
        assert g.kept == (kinds[k] in ("good", "short"))
    assert all(g.class_distance <= Q.MAX_CLASS_DISTANCE for k, g in got.items() if kinds[k] == "no common word")
