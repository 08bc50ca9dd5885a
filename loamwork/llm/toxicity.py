"""Toxicity of restored text: noisy-channel deobfuscation, then a classifier on its words.

A token is read as a lattice: digits and symbols may stand for letters (leetspeak),
repeated letters for one or two, and spaces or marks between single letters for
nothing. A word that is parted into pieces of two or more letters is not joined. Viterbi decoding finds the path of least cost under the channel and a
four-character language model. A token with nothing to restore has a lattice of one
path. Decoded tokens are remembered, so each distinct token costs one decoding.

The character model counts all documents. Its table has 28 ** 4 cells whatever the
input. The classifier's words are those whose presence tells labelled toxic documents
from others, found by counting the restored words of all labelled training documents;
a document's score is a logistic function of the summed log odds of its words.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loamwork.llm.keeping import Carried
from loamwork.llm.texts import LOWER, NOT_SPACE, chunks, hold, settle, words_of
from loamwork.session import materialise

# Letters that digits and symbols may stand for.
LEET = {
    "0": "o",
    "1": "il",
    "2": "z",
    "3": "e",
    "4": "a",
    "5": "s",
    "6": "g",
    "7": "t",
    "8": "b",
    "9": "g",
    "@": "a",
    "$": "s",
    "!": "i",
    "+": "t",
    "(": "c",
    "€": "e",
}
#: Costs of the channel, in nats.
SUBSTITUTED, LITERAL, DROPPED, REPEATED, UNSPACED = 1.0, 2.5, 2.0, 0.5, 0.3
#: Symbols of the character model: 0 is everything but letters, 27 any non-ASCII byte.
SYMBOLS = 28
_KIND = np.zeros(256, np.int64)
_KIND[97:123] = np.arange(1, 27)
_KIND[128:] = 27
_EDGES = ".,;:?\"'`)]}>([{<*_-~#%&|=/\\^¿¡«»"
#: Tokens that may hide something: a digit or symbol next to letters, marks inside
#: letters, a letter twice. Other tokens are letters with marks around them, whose
#: lattice has one path.
_HIDDEN = r"[a-z][0-9@$!+(]|[0-9@$!+(][a-z]|[a-z][.\-_*~'|/,]+[a-z]|€|" + "|".join(chr(c) * 2 for c in range(97, 123))
_LETTERS = re.compile(r"[^\W\d_]+")
_SINGLE = re.compile(r"[a-z0-9@$!+]")

#: A word may join a lexicon if it stands in at least MIN_DOCS labelled toxic documents
#: and in one of SHARES of them, and MIN_PRECISION of the labelled documents with it are
#: toxic. Which share is used is decided on training rows, each held against a lexicon
#: learned from the other half of them. A lexicon has 1 / SHARES[0] times as many words
#: as a labelled toxic document on average, at most, whatever the input.
MIN_DOCS, MIN_PRECISION = 4, 0.8
SHARES = (1 / 256, 1 / 128, 1 / 64, 1 / 32, 1 / 16)
HALVES = 2


def character_counts(docs: DataFrame) -> np.ndarray:
    """Counts of four adjacent symbols over all texts: SYMBOLS ** 4 cells."""
    size = SYMBOLS**4

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for _, data, at in chunks(batches):
            if len(data) < 4:
                continue
            kind = _KIND[LOWER[data]]
            pair = kind[:-1] * SYMBOLS + kind[1:]
            code = pair[:-2] * SYMBOLS**2 + pair[2:]
            inside = np.ones(len(data), bool)  # windows stay in one text
            for back in (1, 2, 3):
                inside[np.maximum(at[1:] - back, 0)] = False
            total += np.bincount(code[inside[: len(code)]], minlength=size)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"code": pa.array(seen), "n": pa.array(total[seen])})

    rows = docs.select("text").mapInArrow(run, "code long, n long").groupBy("code").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(size)
    out[rows.column("code").to_numpy()] = rows.column("n").to_numpy()
    return out.reshape((SYMBOLS,) * 4)


def character_model(counts: np.ndarray) -> np.ndarray:
    """-log P(symbol | three before), interpolated with shorter contexts (Witten-Bell)."""
    order = [counts.sum((0, 1, 2)), counts.sum((0, 1)), counts.sum(0), counts]
    p = np.full(SYMBOLS, 1 / SYMBOLS)
    for c in order:
        total, kinds = c.sum(-1, keepdims=True), (c > 0).sum(-1, keepdims=True)
        p = (c + kinds * p + 1e-9 * p) / (total + kinds + 1e-9)
    return -np.log(p).astype(np.float32).ravel()


class Decoder:
    """Viterbi decoding of tokens under a character model (costs by symbol after three others)."""

    def __init__(self, costs: np.ndarray):
        self.costs = costs.tolist()
        self.known: dict[bytes, tuple[str, ...]] = {}

    def _spell(self, text: str, context: int) -> tuple[float, int]:
        cost = 0.0
        for symbol in _KIND[np.frombuffer(text.encode(), np.uint8)].tolist() if len(text) > 1 or text > "\x7f" else (int(_KIND[ord(text)]),) if text else ():
            cost += self.costs[context * SYMBOLS + symbol]
            context = context % SYMBOLS**2 * SYMBOLS + symbol
        return cost, context

    def _options(self, c: str, n: int, inner: bool, spaced: bool) -> list[tuple[str, float]]:
        if c.isalpha():
            if n == 1:
                return [(c, 0.0)]
            if n == 2:
                return [(c * 2, 0.0), (c, 8 * REPEATED)]
            return [(c, REPEATED), (c * 2, REPEATED)]
        if c in LEET:
            out = [(x * k, SUBSTITUTED * k + REPEATED * (n - k)) for x in LEET[c] for k in range(1, min(n, 2) + 1)]
            return [*out, (c * n, LITERAL), ("", DROPPED * min(n, 3))]
        if c == " ":
            return [("", UNSPACED), (" ", 0.0 if not spaced else LITERAL)]
        return [(c, 0.0), *([("", DROPPED)] if inner else [])]

    def restore(self, token: str, spaced: bool = False) -> str:
        runs = [(m[1], len(m[0])) for m in re.finditer(r"(?s)(.)\1*", token)]
        best: dict[int, tuple[float, tuple]] = {0: (0.0, ())}
        for k, (c, n) in enumerate(runs):
            options = self._options(c, n, 0 < k < len(runs) - 1, spaced)
            after: dict[int, tuple[float, tuple]] = {}
            for context, (cost, path) in best.items():
                for text, channel in options:
                    more, to = self._spell(text, context)
                    total = cost + channel + more
                    if to not in after or total < after[to][0]:
                        after[to] = total, (path, text)
            best = after
        _, path = min((cost + self.costs[context * SYMBOLS], path) for context, (cost, path) in best.items())
        out = []
        while path:
            path, text = path
            out.append(text)
        return "".join(reversed(out))

    def words(self, token: bytes, hidden: bool) -> tuple[str, ...]:
        """The words of a token, restored if something in it may be hidden."""
        found = self.known.get(token)
        if found is None:
            text = token.decode("utf-8", "replace")
            if hidden:
                text = self.restore(text.strip(_EDGES))
            found = tuple(_LETTERS.findall(text))
            if hidden:
                if len(self.known) > 100_000:  # bounds memory, changes no result
                    self.known.clear()
                self.known[token] = found
        return found


def _spaced_runs(tokens: pa.BinaryArray, ends: np.ndarray) -> list[tuple[int, str]]:
    """(text, letters with spaces) for every run of three or more single characters."""
    _, cut, data = tokens.buffers()
    cut = np.frombuffer(cut, np.int32)[tokens.offset : tokens.offset + len(tokens) + 1]
    single = np.diff(cut) == 1
    edge = np.diff(np.concatenate([[0], single.astype(np.int8), [0]]))
    begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    long = end - begin >= 3
    out = []
    for a, b in zip(begin[long].tolist(), end[long].tolist(), strict=True):
        while a < b:
            text = int(np.searchsorted(ends, a, "right")) - 1
            to = min(b, int(ends[text + 1]))
            letters = [x.decode() for x in tokens.slice(a, to - a).to_pylist()]
            run: list[str] = []
            for x in [*letters, None]:
                if x is not None and _SINGLE.fullmatch(x):
                    run.append(x)
                    continue
                if len(run) >= 3:
                    out.append((text, " ".join(run)))
                run = []
            a = to
    return out


def _restored(decoder: Decoder, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[tuple[str, ...]], list[tuple[int, tuple[str, ...]]]]:
    """Distinct-token number and text of each token, words of each distinct token, and words of spaced runs."""
    tokens, ends = words_of(LOWER[data], at, NOT_SPACE)
    coded = tokens.dictionary_encode()
    distinct = coded.dictionary
    # RE2 reads text; what is not UTF-8 at a cut cannot occur, tokens are cut at ASCII
    hidden = pc.match_substring_regex(distinct.cast(pa.string()), _HIDDEN).to_numpy(zero_copy_only=False)
    words = [decoder.words(t, h) for t, h in zip(distinct.to_pylist(), hidden.tolist(), strict=True)]
    spaced = [(doc, tuple(_LETTERS.findall(decoder.restore(run, spaced=True)))) for doc, run in _spaced_runs(tokens, ends)]
    return coded.indices.to_numpy(zero_copy_only=False), np.repeat(np.arange(len(ends) - 1), np.diff(ends)), words, spaced


#: Bytes of text whose distinct tokens are held at once.
_CHUNK = 1 << 20
_decoders: dict[int, Decoder] = {}


def _decoder(costs: np.ndarray) -> Decoder:
    hold("toxicity", _decoders.clear)
    key = hash(costs.tobytes())
    if key not in _decoders:
        _decoders.clear()
        _decoders[key] = Decoder(costs)
    return _decoders[key]


def _done() -> None:
    _decoders.clear()
    settle()


def word_table(labelled: DataFrame, costs) -> DataFrame:
    """How many labelled documents (text, toxic, half) have each restored word: word, c<half> of clean and t<half> of toxic ones."""
    names = [f"{kind}{half}" for kind in "ct" for half in range(HALVES)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = _decoder(costs.value)
        for rows, data, at in chunks(batches, limit=_CHUNK):
            code, doc, words, spaced = _restored(decoder, data, at)
            number: dict[str, int] = {}
            of_token = [[number.setdefault(w, len(number)) for w in {*ws}] for ws in words]
            size = np.fromiter(map(len, of_token), np.int64, len(of_token))
            flat = np.fromiter((x for ws in of_token for x in ws), np.int64, int(size.sum()))
            begin = np.cumsum(size) - size
            count = size[code]
            total = np.cumsum(count)
            word = flat[np.repeat(begin[code] - (total - count), count) + np.arange(int(total[-1]) if len(total) else 0)]
            extra = [(d, number.setdefault(w, len(number))) for d, ws in spaced for w in ws]
            docs_ = np.concatenate([np.repeat(doc, count), np.array([d for d, _ in extra], np.int64)])
            word = np.concatenate([word, np.array([w for _, w in extra], np.int64)])
            n = max(1, len(number))
            pairs = np.unique(docs_ * n + word)
            kind = rows.column("toxic").to_numpy(zero_copy_only=False) * HALVES + rows.column("half").to_numpy(zero_copy_only=False)
            seen = np.bincount((pairs % n) * len(names) + kind[pairs // n], minlength=n * len(names)).reshape(n, -1)[: len(number)]
            yield pa.RecordBatch.from_pydict({"word": pa.array([*number], pa.string())} | {c: pa.array(seen[:, k].astype(np.int64)) for k, c in enumerate(names)})
        _done()

    counted = labelled.select("text", "toxic", "half").mapInArrow(run, "word string, " + ", ".join(f"{c} long" for c in names))
    return counted.groupBy("word").agg(*(F.sum(c).alias(c) for c in names))


def learn_lexicons(labelled: DataFrame, costs) -> list[dict[str, tuple[float, int]]]:
    """Words with their log odds and how many of SHARES they reach: by all labelled rows, and by the rows outside each half."""
    totals = {(r["toxic"], r["half"]): r["count"] for r in labelled.groupBy("toxic", "half").count().collect()}
    if not any(toxic for toxic, _ in totals):
        return [{}] * (1 + HALVES)
    used = [[*range(HALVES)], *([h for h in range(HALVES) if h != out] for out in range(HALVES))]
    size = [[sum(totals.get((toxic, h), 0) for h in halves) for toxic in (0, 1)] for halves in used]
    least = [[max(MIN_DOCS * len(halves) / HALVES, share * n[1]) for share in SHARES] for halves, n in zip(used, size, strict=True)]
    clean, toxic = ([sum((F.col(f"{kind}{h}") for h in halves), F.lit(0)) for halves in used] for kind in "ct")
    passes = [(t >= m[0]) & (t >= MIN_PRECISION * (t + c)) for c, t, m in zip(clean, toxic, least, strict=True)]
    table = materialise(word_table(labelled, costs).filter(passes[0] | passes[1] | passes[2]), "toxic-words")
    out = []
    for c, t, ok, m, (n_clean, n_toxic) in zip(clean, toxic, passes, least, size, strict=True):
        # bounded by the shares
        kept = table.filter(ok).select("word", c.alias("c"), t.alias("t")).orderBy(F.desc("t"), "word").collect()
        odds = lambda r: math.log((r["t"] + 0.5) / (n_toxic + 1)) - math.log((r["c"] + 0.5) / (n_clean + 1))  # noqa: E731, B023
        out.append({r["word"]: (odds(r), sum(r["t"] >= x for x in m)) for r in kept})
    return out


def lexicon_sums(docs: DataFrame, costs, lexicons: list[dict[str, tuple[float, int]]], columns: list[str]) -> DataFrame:
    """``columns`` and what the restored text's distinct lexicon words say.

    evidence: the sum of their log odds for each of SHARES; apart: the same by the
    lexicon that knows nothing of the row's half; found: the words with their levels.
    """
    number = {w: k for k, w in enumerate(dict.fromkeys(w for x in lexicons for w in x))}
    names, levels = [*number], [lexicons[0].get(w, (0.0, 0))[1] for w in number]
    weights = np.zeros((len(number), len(lexicons), len(SHARES)))
    for k, lexicon in enumerate(lexicons):
        for w, (odds, level) in lexicon.items():
            weights[number[w], k, :level] = odds

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = _decoder(costs.value)
        for rows, data, at in chunks(batches, limit=_CHUNK):
            code, doc, words, spaced = _restored(decoder, data, at)
            hit = [[number[w] for w in ws if w in number] for ws in words]
            has = np.fromiter(map(bool, hit), bool, len(hit))
            found: list[set[int]] = [set() for _ in range(len(rows))]
            for k in np.flatnonzero(has[code]).tolist():
                found[doc[k]].update(hit[code[k]])
            for d, ws in spaced:
                found[d].update(number[w] for w in ws if w in number)
            half = rows.column("__half").to_pylist()
            sums = [weights[sorted(f)].sum(0) for f in found]
            yield pa.RecordBatch.from_pydict(
                {c: rows.column(c) for c in columns}
                | {
                    "evidence": pa.array([s[0].tolist() for s in sums], pa.list_(pa.float64())),
                    "apart": pa.array([s[1 + h].tolist() for s, h in zip(sums, half, strict=True)], pa.list_(pa.float64())),
                    "found": pa.array(
                        [[{"word": names[k], "level": levels[k]} for k in sorted(f, key=names.__getitem__) if levels[k]] for f in found],
                        pa.list_(pa.struct([("word", pa.string()), ("level", pa.int32())])),
                    ),
                }
            )
        _done()

    sums = T._parse_datatype_string("evidence array<double>, apart array<double>, found array<struct<word:string,level:int>>")
    return docs.select(*dict.fromkeys([*columns, "text", "__half"])).mapInArrow(run, T.StructType([*(docs.schema[c] for c in columns), *sums.fields]))


def _logistic(evidence: np.ndarray, toxic: np.ndarray, n: np.ndarray) -> tuple[float, float, float]:
    """Loss, intercept and slope of a logistic regression on weighted rows, by Newton's method, slightly shrunk.

    A step that raises the loss is halved, so the method also ends where words tell
    all toxic rows from the others.
    """

    def loss(a: float, b: float) -> float:
        z = a + b * evidence
        return float((n * (np.logaddexp(0, z) - toxic * z)).sum() + 5e-4 * (a * a + b * b))

    a, b = 0.0, 0.0
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a + b * evidence, -30, 30)))
        w = n * p * (1 - p)
        g = np.array([(n * (toxic - p)).sum() - 1e-3 * a, (n * (toxic - p) * evidence).sum() - 1e-3 * b])
        h = np.array([[w.sum() + 1e-3, (w * evidence).sum()], [(w * evidence).sum(), (w * evidence * evidence).sum() + 1e-3]])
        step = np.array([h[1, 1] * g[0] - h[0, 1] * g[1], h[0, 0] * g[1] - h[1, 0] * g[0]]) / (h[0, 0] * h[1, 1] - h[0, 1] * h[1, 0])
        least = loss(a, b)
        while abs(step).max() >= 1e-9 and not loss(a + step[0], b + step[1]) <= least:
            step = step / 2
        a, b = a + step[0], b + step[1]
        if abs(step).max() < 1e-9:
            break
    return loss(a, b), float(a), float(b)


def toxicity(docs: DataFrame, labels: DataFrame, held_out: Column, keep: Sequence[str] = ()) -> DataFrame:
    """Score every whole text: doc_id, row (a struct of the columns ``keep``, if any), held_out, score (0 to 1), predicted, found.

    ``labels`` (doc_id, toxic) are learned from where ``held_out``, an expression on
    ``docs``, is false; the scores depend on the texts alone. Nulls: a null text is
    empty and gets the score of a text without evidence; a null doc_id is scored but
    never labelled; null labels are left out. Without toxic labels all scores are 0.
    Repeated rows are each scored, and each learned from; of repeated labels of a
    doc_id the largest counts. An empty table gives an empty result. Extra columns are
    not read, but for ``keep``; whatever their names, they do not clash.

    The lexicon's share and the logistic function are fitted on training rows whose
    evidence comes from the other half of them; halves are by the text's hash, so copies
    fall into one.
    """
    spark = docs.sparkSession
    half = F.pmod(F.xxhash64(F.coalesce("text", F.lit(""))), F.lit(HALVES)).cast("int")
    carried = Carried(keep)
    rows = docs.select("doc_id", "text", *carried.folded, F.coalesce(held_out, F.lit(True)).alias("__held"), half.alias("__half"))
    known = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).filter("doc_id IS NOT NULL AND toxic IN (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    costs = spark.sparkContext.broadcast(character_model(character_counts(docs)))
    training = rows.filter(~F.col("__held")).select("doc_id", "text", F.col("__half").alias("half")).join(known.hint("merge"), "doc_id")
    lexicons = learn_lexicons(training, costs)
    columns = ["doc_id", "__held", *carried.columns]
    sums = materialise(lexicon_sums(rows, costs, lexicons, columns), "toxic-evidence")
    # evidence in steps of 1/16: as many rows as the lexicons' sums have values
    bins = (
        sums.filter(~F.col("__held"))
        .select("doc_id", F.posexplode("apart").alias("share", "apart"))
        .join(known, "doc_id")
        .groupBy("share", F.round(F.col("apart") * 16).alias("bin"), "toxic")
        .count()
        .collect()
    )
    best = 0
    if any(r["toxic"] == 1 for r in bins):
        fits = [_logistic(*np.array([(r["bin"] / 16, r["toxic"], r["count"]) for r in bins if r["share"] == k], float).T) for k in range(len(SHARES))]
        best = min(reversed(range(len(SHARES))), key=lambda k: fits[k][0])  # of equal ones the largest share
        _, a, b = fits[best]
        score = F.lit(1.0) / (F.lit(1.0) + F.exp(-(F.lit(a) + F.lit(b) * F.col("evidence")[best])))
    else:
        score = F.lit(0.0)
    found = F.transform(F.filter("found", lambda x: x["level"] > best), lambda x: x["word"])
    return sums.select("doc_id", *carried.row(), F.col("__held").alias("held_out"), score.alias("score"), (score >= 0.5).cast("int").alias("predicted"), found.alias("found"))
