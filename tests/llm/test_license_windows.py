"""Matches of licence templates against brute force over windows at every start."""

import math
import random
import re

from loamwork.llm import licenses as L


def matching(text):
    w = re.findall("[a-z0-9]+", text.lower())
    out = {}
    for label, template in L.TEMPLATES:
        words, size = {*template.split()}, 2 * len(template.split())
        needed, other = words & L.REQUIRED, L.EXCLUDED.get(label, set())
        assert needed
        for s in range(len(w)):
            window = {*w[s : s + size]}
            if len(words & window) >= math.ceil(0.8 * len(words) - 1e-9) and needed <= window and not other & window:
                out[label] = max(out.get(label, 0), len(words & window) / len(words))
    return out


def test_matches_are_those_of_all_windows(spark):
    rng = random.Random(5)
    work = "This work is licensed under a Creative Commons Attribution{} 4.0 International License."
    texts = ["Released under the GPL License", "Licensed under CC BY 4.0", work.format(""), work.format("-NonCommercial"), work.format("-ShareAlike"), "Released under the license terms",
             "You can redistribute this library and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; it is free software"]
    for k in range(300):  # notices stretched by insertions, some words lost, at every offset
        words = rng.choice(L.TEMPLATES)[1].split()
        words = [x for x in words if rng.random() > 0.1]
        for _ in range(int(len(words) * rng.uniform(0, 1.2))):
            words.insert(rng.randrange(len(words) + 1), f"x{rng.randrange(99)}")
        texts.append(" ".join([*["pad"] * (k % 40), *words, *["pad"] * rng.randrange(40)]))
    got = {r.doc_id: r for r in L.license_scan(spark.createDataFrame([*enumerate([*texts, None, ""])], "doc_id long, text string")).collect()}
    for k, text in enumerate(texts):
        best = {}
        for m in got[k].matches:
            best[m.label] = max(best.get(m.label, 0), m.containment)
        assert best == matching(text), text
    assert [got[k].labels for k in range(7)] == ["", "cc-by", "cc-by", "cc-by-nc", "cc-by-sa", "", "gpl,lgpl"]
