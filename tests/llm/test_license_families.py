"""Licence notices beside others of their family, and all starts of windows that match, against brute force."""

import math
import random
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from loamwork.llm import licenses as L
from loamwork.llm.texts import ALNUM, LOWER, utf8, words_of

NOTICE = {label: text for label, text in L.TEMPLATES}


def longest_common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = row[:]
        for k, y in enumerate(b):
            row[k + 1] = last[k] + 1 if x == y else max(last[k + 1], row[k])
    return row[-1]


def brute(text):
    """Starts of windows that match, by label, with their containment and length."""
    w, out = re.findall("[a-z0-9]+", text.lower()), {}
    for label, template in L.TEMPLATES:
        sequence, other = template.split(), L.EXCLUDED.get(label, set())
        words = {*sequence}
        for s in range(len(w)):
            window = w[s : s + 2 * len(sequence)]
            stop = next((k for k, x in enumerate(window) if x in other), len(window))
            kept = {*window[:stop]}
            if len(words & kept) < math.ceil(0.8 * len(words) - 1e-9) or not words & L.REQUIRED <= kept:
                continue
            if stop == len(window) or longest_common(window[:stop], sequence) >= math.ceil(0.8 * len(sequence) - 1e-9):
                out.setdefault((label, template), {})[s] = len(words & kept) / len(words), stop
    return out


def scan(texts):
    order, templates = L.ordered_templates({w: k % 7 for k, w in enumerate(L._vocabulary())}, L.THRESHOLD)
    words, ends = words_of(LOWER[utf8(pa.array(texts))[0]], utf8(pa.array(texts))[1], ALNUM)
    word = pc.fill_null(pc.index_in(words, value_set=pa.array(order, pa.binary())), -1).to_numpy(zero_copy_only=False)
    doc_of = np.repeat(np.arange(len(texts)), np.diff(ends))
    return {(t.label, text): L.window_matches(t, word, ends, doc_of) for t, (_, text) in zip(templates, L.TEMPLATES, strict=True)}


def test_a_notice_beside_one_of_its_family_matches(spark):
    by, nc, gpl = NOTICE["cc-by"], NOTICE["cc-by-nc"], NOTICE["gpl"]
    texts = [f"{by} {nc}", f"{by}; noderivatives", f"The lesser one? {gpl}, not the lesser one", f"noncommercial {by} sharealike", f"{nc} {nc} {nc}", " ".join([NOTICE["lgpl"]] * 3)]
    got = {r.doc_id: r for r in L.license_scan(spark.createDataFrame([*enumerate(texts)], "doc_id long, text string")).collect()}
    named = [{m.label for m in got[k].matches} for k in range(len(texts))]
    assert "cc-by" in named[0] and "cc-by-nc" in named[0] and "cc-by" in named[1] and "gpl" in named[2] and "cc-by" in named[3]
    # the end of a notice and the beginning of the next are no notice
    assert named[4:] == [{"cc-by-nc"}, {"lgpl"}]
    assert [(m.first_word, m.n_words) for m in got[3].matches if m.label == "cc-by"] == [(1, 13)]


def test_every_window_that_matches_is_in_a_run(spark):
    rng = random.Random(8)
    other = sorted({x for v in L.EXCLUDED.values() for x in v})
    texts = [" ".join([NOTICE["cc-by"]] * 5), ""]
    for _ in range(250):
        words = []
        for _ in range(rng.randrange(1, 5)):
            notice = [x for x in rng.choice(L.TEMPLATES[3:10])[1].split() if rng.random() > 0.05]
            words += [*["pad"] * rng.choice([0, 0, 2, 9, 30]), *rng.sample(other, rng.choice([0, 0, 1])), *notice]
        if rng.random() < 0.2:
            rng.shuffle(words)
        texts.append(" ".join(words))
    got, expected = scan(texts), [brute(t) for t in texts]
    for key, rows in got.items():
        for d in range(len(texts)):
            known = expected[d].get(key, {})
            assert sorted(s for r in rows if r[0] == d for s in range(r[4], r[5] + 1)) == sorted(known), texts[d]
            for _, first, length, share, begin, last in (r for r in rows if r[0] == d):
                assert known[first] == (share, length) and share == max(known[s][0] for s in range(begin, last + 1))
    assert max(r[5] for r in got["cc-by", NOTICE["cc-by"]] if r[0] == 0) >= 52
