"""Licence notices: places of phrases, and an exact set-similarity join with templates.

A window of twice a template's length, at every start in a text, matches when it holds
at least THRESHOLD of the template's distinct words, all words of REQUIRED that the
template has, and no word that names a licence of the same family with other terms. A
window with such a word ends before it, and what is left matches when it also has
THRESHOLD of the template's words in their order: a notice matches beside one of its
family, and the end of a notice with the beginning of the next does not.
Templates' words are ordered by how often they occur in all documents, rarest first.
Only windows around the rarest required word are looked at; of its places, those
without a word of the template's prefix in reach are dropped (prefix filter), then those
with too few words of the template in reach (length filter); the rest is counted at every
start. No match is missed by the filters. Starts in a row that match are one match,
given at the first of those with the largest share, with the first and last start of the row.

Documents are not shuffled: templates are a fixed list, sent to every task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loamwork.llm.texts import ALNUM, LOWER, chunks, words_of

THRESHOLD = 0.8

# Phrases whose places are counted, and their labels.
PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}

# Published licence notices, and the labels they give.
TEMPLATES = [
    ("apache-2.0", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("apache-2.0", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-nc", "this work is licensed under a creative commons attribution noncommercial 4 0 international license"),
    ("cc-by-nd", "this work is licensed under a creative commons attribution noderivatives 4 0 international license"),
    ("cc-by-sa", "this work is licensed under a creative commons attribution sharealike 4 0 international license"),
    ("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("lgpl", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("reserved", "all rights reserved no part of this publication may be reproduced distributed or transmitted in any form or by any means"),
]

# Words that name a licence; a template that has some matches only with all of them.
REQUIRED = {
    "apache", "applicable", "warranties", "redistribution", "attribution", "creative", "noncommercial", "noderivatives", "sharealike", "waived",
    "gnu", "lesser", "permission", "mozilla", "reserved",
}

# Words that name another licence of the same family; a template without them does not match a window with one.
EXCLUDED = {
    "cc-by": {"noncommercial", "noderivatives", "sharealike"},
    "cc-by-nc": {"noderivatives", "sharealike"},
    "cc-by-nd": {"noncommercial", "sharealike"},
    "cc-by-sa": {"noncommercial", "noderivatives"},
    "gpl": {"lesser"},
}


@dataclass
class Template:
    label: str
    n_words: int
    #: Distinct words as numbers in the global order, rarest first.
    words: np.ndarray
    least: int
    #: Distinct words that a match must hold, rarest first.
    required: np.ndarray
    #: Words that a match must not hold.
    excluded: np.ndarray
    #: All words in their order, and how many of them a window that was cut must have so.
    sequence: np.ndarray
    least_in_order: int

    @property
    def prefix(self) -> np.ndarray:
        return self.words[: len(self.words) - self.least + 1]


def _vocabulary() -> list[bytes]:
    texts = [*PHRASES, *(t for _, t in TEMPLATES)]
    return sorted({w.encode() for t in texts for w in t.split()})


def word_frequencies(docs: DataFrame) -> dict[bytes, int]:
    """How often each word of the phrases and templates occurs in all documents: one row per word."""
    vocabulary = _vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(vocabulary), np.int64)
        known = pa.array(vocabulary, pa.binary())
        for _, data, at in chunks(batches):
            words, _ = words_of(LOWER[data], at, ALNUM)
            found = pc.index_in(words, value_set=known).drop_null().to_numpy(zero_copy_only=False)
            total += np.bincount(found, minlength=len(vocabulary))
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"word": pa.array(seen.astype(np.int32)), "n": pa.array(total[seen])})

    rows = docs.select("text").mapInArrow(run, "word int, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    counted = {vocabulary[r["word"]]: r["n"] for r in rows}
    return {w: counted.get(w, 0) for w in vocabulary}


def ordered_templates(frequency: dict[bytes, int], threshold: float) -> tuple[list[bytes], list[Template]]:
    order = sorted(frequency, key=lambda w: (frequency[w], w))
    number = {w: k for k, w in enumerate(order)}
    out = []
    for label, text in TEMPLATES:
        words = np.array(sorted({number[w.encode()] for w in text.split()}))
        required = np.array(sorted({number[w.encode()] for w in text.split() if w in REQUIRED}))
        excluded = np.array(sorted(number[w.encode()] for w in EXCLUDED.get(label, ())), np.int64)
        sequence = np.array([number[w.encode()] for w in text.split()])
        least, in_order = (math.ceil(threshold * len(x) - 1e-9) for x in (words, sequence))
        out.append(Template(label, len(sequence), words, least, required, excluded, sequence, in_order))
    return order, out


def in_order(sequence: np.ndarray, rows: np.ndarray, block: int = 8192) -> np.ndarray:
    """How many words of ``sequence`` stand in each row in their order: the longest common subsequence."""
    out = np.zeros(len(rows), np.int64)
    for at in range(0, len(rows), block):
        part = rows[at : at + block]
        longest = np.zeros((len(part), len(sequence) + 1), np.int32)
        for column in part.T:
            longer = longest[:, :-1] + (column[:, None] == sequence)
            longest[:, 1:] = np.maximum.accumulate(np.maximum(longest[:, 1:], longer), axis=1)
        out[at : at + block] = longest[:, -1]
    return out


def window_matches(template: Template, word: np.ndarray, ends: np.ndarray, doc_of: np.ndarray) -> list[tuple[int, int, int, float, int, int]]:
    """(text, first word of the window, its words, containment, first and last start) of every run of windows that meet the threshold.

    ``word``: numbers in the global order of all words of the texts, -1 for others.
    """
    n, size = len(template.words), 2 * template.n_words
    hits = np.flatnonzero(word == template.required[0])
    starts, full = np.arange(size), np.arange(size, 2 * size)
    found: list[np.ndarray] = []
    for at in range(0, len(hits), 4096):
        hit = hits[at : at + 4096]
        # all words that a window with this place can hold; -1 outside of the text
        place = hit[:, None] + np.arange(1 - size, size)
        doc = doc_of[hit]
        inside = (place >= ends[doc][:, None]) & (place < ends[doc + 1][:, None])
        near = np.where(inside, word[np.clip(place, 0, len(word) - 1)], -1)
        keep = np.isin(near, template.prefix).any(1)
        hit, near, inside = hit[keep], near[keep], inside[keep]
        keep = np.isin(near, template.words).sum(1) >= template.least
        hit, near, inside = hit[keep], near[keep], inside[keep]
        shared, whole = np.zeros((len(hit), size), np.int64), inside[:, :size].copy()
        # a window ends before the first excluded word behind this place; one before this place parts them
        other = np.isin(near, template.excluded)
        whole &= ~np.logical_or.accumulate(other[:, size - 1 :: -1], axis=1)[:, ::-1]
        cut = np.where(other[:, size:].any(1), size + other[:, size:].argmax(1), 2 * size)
        stop = np.minimum(full, cut[:, None])
        for w in template.words.tolist():
            seen = np.zeros((len(hit), near.shape[1] + 1), np.int64)
            np.cumsum(near == w, axis=1, out=seen[:, 1:])
            holds = np.take_along_axis(seen, stop, 1) > seen[:, :size]
            shared += holds
            if w in template.required:
                whole &= holds
        row, start = np.nonzero(whole & (shared >= template.least))
        first, count, end = hit[row] + 1 - size + start, shared[row, start], stop[row, start]
        # a start is found from every place of the required word in its window, always with the same end
        first, one = np.unique(first, return_index=True)
        row, start, count, end = row[one], start[one], count[one], end[one]
        short = np.flatnonzero(end < start + size)
        column = start[short, None] + starts
        words = np.where(column < end[short, None], near[row[short, None], np.minimum(column, 2 * size - 2)], -1)
        keep = np.ones(len(first), bool)
        keep[short] = in_order(template.sequence, words) >= template.least_in_order
        length = np.minimum(end - start, ends[doc_of[first] + 1] - first)
        found.append(np.stack([first, count, length], 1)[keep])
    if not found:
        return []
    start, first = np.unique(np.concatenate(found)[:, 0], return_index=True)
    _, shared, length = np.concatenate(found)[first].T
    if not len(start):
        return []
    begins = np.flatnonzero(np.append(True, (np.diff(start) > 1) | (doc_of[start[1:]] != doc_of[start[:-1]])))
    out = []
    for a, b in zip(begins.tolist(), [*begins[1:].tolist(), len(start)], strict=True):
        best = a + int(np.argmax(shared[a:b]))
        d = int(doc_of[start[best]])
        zero = int(ends[d])
        out.append((d, int(start[best]) - zero, int(length[best]), int(shared[best]) / n, int(start[a]) - zero, int(start[b - 1]) - zero))
    return out


def license_scan(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, phrases, matches, base_labels, labels, score.

    phrases: array of (label, word) for every place of a phrase, word being where it
    starts; matches: array of (label, first_word, n_words, containment, first_start,
    last_start), one per run of windows that meet the threshold: those at every word from
    first_start to last_start do. score: the largest containment, 1 where a phrase stands,
    0 where nothing was found. Nulls: a null text is empty; a null doc_id is kept.
    Repeated rows are each scanned. An empty table gives an empty result. Extra
    columns are not read.
    """
    order, templates = ordered_templates(word_frequencies(docs), threshold)
    number = {w: k for k, w in enumerate(order)}
    phrases = [(label, [number[w.encode()] for w in text.split()]) for text, label in PHRASES.items()]
    kind = docs.schema["doc_id"].dataType.simpleString()
    phrase_type = pa.list_(pa.struct([("label", pa.string()), ("word", pa.int64())]))
    match_type = pa.list_(pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("n_words", pa.int64()), ("containment", pa.float64()), ("first_start", pa.int64()), ("last_start", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(order, pa.binary())
        for rows, data, at in chunks(batches):
            words, ends = words_of(LOWER[data], at, ALNUM)
            word = pc.fill_null(pc.index_in(words, value_set=known), -1).to_numpy(zero_copy_only=False)
            doc_of = np.repeat(np.arange(len(rows)), np.diff(ends))
            spoken: list[list] = [[] for _ in range(len(rows))]
            for label, wanted in phrases:
                k = len(wanted)
                if len(word) < k:
                    continue
                same = doc_of[: len(word) - k + 1] == doc_of[k - 1 :]
                for j, w in enumerate(wanted):
                    same &= word[j : len(word) - k + 1 + j] == w
                for p in np.flatnonzero(same).tolist():
                    spoken[doc_of[p]].append((p - int(ends[doc_of[p]]), label))
            matched: list[list] = [[] for _ in range(len(rows))]
            for t in templates:
                for d, first, size, share, begin, last in window_matches(t, word, ends, doc_of):
                    matched[d].append({"label": t.label, "first_word": first, "n_words": size, "containment": share, "first_start": begin, "last_start": last})
            base = [sorted({x for _, x in s}) for s in spoken]
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": rows.column("doc_id"),
                    "n_words": pa.array(np.diff(ends), pa.int64()),
                    "phrases": pa.array([[{"label": x, "word": p} for p, x in sorted(s)] for s in spoken], phrase_type),
                    "matches": pa.array(matched, match_type),
                    "base_labels": pa.array([",".join(b) for b in base], pa.string()),
                    "labels": pa.array([",".join(sorted({*b, *(m["label"] for m in ms)})) for b, ms in zip(base, matched, strict=True)], pa.string()),
                    "score": pa.array([1.0 if s else max((m["containment"] for m in ms), default=0.0) for s, ms in zip(spoken, matched, strict=True)], pa.float64()),
                }
            )

    schema = (
        f"doc_id {kind}, n_words long, phrases array<struct<label:string,word:long>>, "
        "matches array<struct<label:string,first_word:long,n_words:long,containment:double,first_start:long,last_start:long>>, "
        "base_labels string, labels string, score double"
    )
    return docs.select("doc_id", "text").mapInArrow(run, schema)
