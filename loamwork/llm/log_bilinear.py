"""Language-model scores by a log-bilinear model, trained with noise-contrastive estimation.

The model predicts a token from the POSITIONS tokens before it: each position has a
matrix of its own, the sum of the contexts' vectors times these matrices is the
predicted vector, and a token's score is its product with the token's own vector plus a
bias. The most frequent words have vectors of their own; other words share vectors by
their last two bytes and cost their add-one share among the words of that class. How
many of both there are grows with the cube root of the number of distinct training
words (class_sizes), so the vectors, the only thing besides word counts that is gathered
from the corpus, grow with it without a bound, but slowly.

Training runs where the texts are: in each of ROUNDS rounds every task starts from the
same vectors, makes steps on all its texts in numpy (NOISE words drawn from the unigram
distribution for each batch) and returns its vectors; they are averaged by numbers of
tokens in a shuffle on the cells, and the driver gets one row for each cell. All
training documents are used, however many there are; one round has as many steps as the
texts have batches.

Scores are normalised exactly: batches of distinct contexts are multiplied with all
tokens' vectors, and the sums of the exponentials are taken. Counts of all words come
from all training documents, by a shuffle on words. Scoring sends the COMMON most
frequent words' counts to every task (a fixed number); the other words of all documents
are joined with the counts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loamwork.llm.texts import LOWER, NOT_SPACE, chunks, per_text, settle, words_of
from loamwork.session import materialise

COMMON = 50_000
POSITIONS, DIMENSIONS, NOISE, BATCH, RATE, ROUNDS, SEED = 3, 32, 32, 1024, 0.1, 1, 7
#: Contexts whose scores of all tokens are held at once.
_BLOCK = 256
_CHUNK = 4 << 20


def class_sizes(n_distinct: int) -> tuple[int, int]:
    """(words with vectors of their own, classes of the other words) for a number of distinct words."""
    root = max(0, n_distinct) ** (1 / 3)
    return 128 + int(1.5 * root), 32 + int(root / 3)


def tail_class(data: np.ndarray, cut: np.ndarray, tail: int) -> np.ndarray:
    """The tail class of words that lie end to end in ``data``, by their last two bytes."""
    end, begin = cut[1:], cut[:-1]
    last = data[end - 1].astype(np.int64)
    before = np.where(end - begin > 1, data[np.maximum(end - 2, 0)], 0).astype(np.int64)
    return (last * 31 + before * 17) % tail


def _buffers(words: pa.BinaryArray) -> tuple[np.ndarray, np.ndarray]:
    _, cut, data = words.buffers()
    cut = np.frombuffer(cut, np.int32)[words.offset : words.offset + len(words) + 1]
    return (np.zeros(1, np.uint8) if data is None or not data.size else np.frombuffer(data, np.uint8)), cut


def word_counts(train: DataFrame) -> DataFrame:
    """(word, c) over all texts; the end of a text is not in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, data, at in chunks(batches, limit=_CHUNK):
            words, _ = words_of(LOWER[data], at, NOT_SPACE)
            counted = pc.value_counts(words)
            yield pa.RecordBatch.from_pydict({"word": counted.field("values"), "c": counted.field("counts")})

    return train.select("text").mapInArrow(run, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


def _classes(words: pa.BinaryArray, known: pa.Array, head: int, tail: int) -> tuple[np.ndarray, np.ndarray]:
    """Rank among the known words (-1: none) and class of each word."""
    rank = pc.fill_null(pc.index_in(words, value_set=known), -1).to_numpy(zero_copy_only=False)
    if not len(words):
        return rank.astype(np.int64), np.zeros(0, np.int64)
    data, cut = _buffers(words)
    return rank, np.where((rank >= 0) & (rank < head), rank, head + tail_class(data, cut, tail))


def _with_ends(kinds: np.ndarray, ends: np.ndarray, end_class: int) -> tuple[np.ndarray, np.ndarray]:
    """Classes at the POSITIONS before each token, nearest first, and class of each token, ends of texts included.

    What lies before a text is the class of ends.
    """
    target = np.insert(kinds, ends[1:], end_class)
    begin = np.repeat(ends[:-1] + np.arange(len(ends) - 1), np.diff(ends) + 1)
    at = np.arange(len(target))
    back = [np.where(at - k >= begin, target[np.maximum(at - k, 0)], end_class) for k in range(1, POSITIONS + 1)]
    return np.stack(back, 1) if len(target) else np.zeros((0, POSITIONS), np.int64), target


@dataclass
class Model:
    """Vectors of classes as contexts and as targets, a matrix for each position, and biases."""

    context: np.ndarray
    target: np.ndarray
    matrix: np.ndarray
    bias: np.ndarray

    def parts(self) -> list[np.ndarray]:
        return [self.context, self.target, self.matrix, self.bias]

    def flat(self) -> np.ndarray:
        return np.concatenate([x.ravel() for x in self.parts()])

    def filled(self, flat: np.ndarray) -> Model:
        cuts = np.cumsum([x.size for x in self.parts()])[:-1]
        return Model(*(v.reshape(x.shape).astype(x.dtype) for v, x in zip(np.split(flat, cuts), self.parts(), strict=True)))

    def tables(self) -> np.ndarray:
        """What each class adds to the predicted vector at each position."""
        return np.einsum("nd,pde->pne", self.context, self.matrix)

    def log10_normalisers(self, predicted: np.ndarray) -> np.ndarray:
        """log10 of the sums of the exponentials of all classes' scores, for rows of predicted vectors."""
        weights = np.ascontiguousarray(np.vstack([self.target.T, self.bias[None]]))
        longest = float(np.sqrt((self.target**2).sum(1)).max())
        out, scores, ones = np.empty(len(predicted)), np.empty((_BLOCK, len(self.bias)), np.float32), np.ones(len(self.bias), np.float32)
        for at in range(0, len(predicted), _BLOCK):
            rows = predicted[at : at + _BLOCK]
            part = np.dot(np.hstack([rows, np.ones((len(rows), 1), np.float32)]), weights, out=scores[: len(rows)])
            top = np.zeros(len(rows), np.float32)
            # no score can be so large that its exponential has no place, but for such rows
            if float(np.sqrt((rows**2).sum(1)).max()) * longest + float(abs(self.bias).max()) > 80:
                top = part.max(1)
                part -= top[:, None]
            np.exp(part, out=part)
            out[at : at + _BLOCK] = np.log(part @ ones) + top
        return out / np.log(10)

    def log10_probabilities(self, before: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Normalised log10 P(class | classes before) of each row."""
        n = len(self.bias)
        code = np.zeros(len(before), np.int64)
        for k in range(POSITIONS):
            code = code * n + before[:, k]
        _, first, again = np.unique(code, return_index=True, return_inverse=True)
        tables = self.tables()
        predicted = sum((tables[k][before[first, k]] for k in range(POSITIONS)), np.zeros((len(first), self.context.shape[1]), np.float32))
        score = np.empty(len(before))
        for at in range(0, len(before), 1 << 16):
            rows = slice(at, at + (1 << 16))
            score[rows] = np.einsum("nd,nd->n", predicted[again[rows]], self.target[target[rows]]) + self.bias[target[rows]]
        return score / np.log(10) - self.log10_normalisers(predicted)[again]


def initial_model(unigram: np.ndarray, dimensions: int = DIMENSIONS, seed: int = SEED) -> Model:
    """Small random vectors; biases are the logarithms of the unigram distribution, so training starts from that model."""
    rng = np.random.default_rng(seed)
    n = len(unigram)
    context, target = (rng.normal(0, 0.1, (n, dimensions)).astype(np.float32) for _ in range(2))
    matrix = np.repeat(np.eye(dimensions, dtype=np.float32)[None] / POSITIONS, POSITIONS, 0)
    return Model(context, target, matrix, np.log(unigram).astype(np.float32))


class Trainer:
    """Steps of noise-contrastive estimation on a model, with AdaGrad."""

    def __init__(self, model: Model, unigram: np.ndarray, noise: int = NOISE, rate: float = RATE, seed: int = SEED):
        self.model = Model(*(x.copy() for x in model.parts()))
        self.log_noise = np.log(noise * unigram).astype(np.float32)
        self.cumulated, self.noise, self.rate = np.cumsum(unigram), noise, rate
        self.rng = np.random.default_rng(seed)
        self.squares = [np.full_like(x, 1e-4) for x in self.model.parts()]

    @staticmethod
    def _summed(rows: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
        """Rows summed by the number in ``at``."""
        order = np.argsort(at, kind="stable")
        first = np.flatnonzero(np.append(True, np.diff(at[order]) > 0))
        out = np.zeros((n, rows.shape[1]), np.float32)
        out[at[order[first]]] = np.add.reduceat(rows[order], first, axis=0)
        return out

    def step(self, before: np.ndarray, target: np.ndarray) -> None:
        m, n = self.model, len(self.model.bias)
        drawn = np.minimum(np.searchsorted(self.cumulated, self.rng.random(self.noise) * self.cumulated[-1]), n - 1)
        inputs = [m.context[before[:, k]] for k in range(POSITIONS)]
        predicted = sum(x @ m.matrix[k] for k, x in enumerate(inputs))
        true = np.einsum("nd,nd->n", predicted, m.target[target]) + m.bias[target] - self.log_noise[target]
        false = predicted @ m.target[drawn].T + m.bias[drawn] - self.log_noise[drawn]
        up = (1 / (1 + np.exp(np.clip(true, -30, 30)))).astype(np.float32)
        down = (1 / (1 + np.exp(np.clip(-false, -30, 30)))).astype(np.float32)
        back = up[:, None] * m.target[target] - down @ m.target[drawn]
        at = np.concatenate([target, drawn])
        gradient = [
            sum(self._summed(back @ m.matrix[k].T, before[:, k], n) for k in range(POSITIONS)),
            self._summed(np.concatenate([up[:, None] * predicted, -(down.T @ predicted)]), at, n),
            np.stack([x.T @ back for x in inputs]),
            np.bincount(at, np.concatenate([up, -down.sum(0)]), minlength=n).astype(np.float32),
        ]
        for x, g, s in zip(m.parts(), gradient, self.squares, strict=True):
            g /= len(target)
            s += g * g
            x += self.rate * g / np.sqrt(s)

    def train(self, before: np.ndarray, target: np.ndarray) -> None:
        """Steps on all rows once, in random order."""
        order = self.rng.permutation(len(target))
        for at in range(0, len(order), BATCH):
            rows = order[at : at + BATCH]
            self.step(before[rows], target[rows])


def train_model(train: DataFrame, common: list[bytes], head: int, tail: int, unigram: np.ndarray, rounds: int = ROUNDS) -> Model:
    """The model after ``rounds`` rounds over all texts of ``train``, averaged over tasks after each.

    Without texts it is the unigram model. A task's steps depend on its texts alone, so
    one that is run again returns the same.
    """
    spark, n = train.sparkSession, head + tail + 1
    model = initial_model(unigram)
    for _ in range(rounds):
        sent = spark.sparkContext.broadcast((common[:head], model, unigram))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            words, start, unigram = sent.value  # noqa: B023
            known, trainer, seen = pa.array(words, pa.binary()), Trainer(start, unigram), 0
            for _, data, at in chunks(batches, limit=_CHUNK):
                found, ends = words_of(LOWER[data], at, NOT_SPACE)
                before, target = _with_ends(_classes(found, known, head, tail)[1], ends, n - 1)
                trainer.train(before, target)
                seen += len(target)
            cells = np.append(trainer.model.flat().astype(np.float64) * seen, seen)
            yield pa.RecordBatch.from_pydict({"cell": pa.array(np.arange(len(cells), dtype=np.int32)), "value": pa.array(cells)})
            settle()

        # one row for each cell of the model, whatever the input
        rows = train.select("text").mapInArrow(run, "cell int, value double").groupBy("cell").agg(F.sum("value").alias("value")).toArrow()
        sent.destroy()
        total = np.zeros(len(model.flat()) + 1)
        total[rows.column("cell").to_numpy()] = rows.column("value").to_numpy()
        if not total[-1]:
            break
        model = model.filled(total[:-1] / total[-1])
    return model


def score_documents(docs: DataFrame, held_out: Column, n_common: int = COMMON) -> DataFrame:
    """Train on rows of ``docs`` where ``held_out`` is false and score all of them.

    Returns doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score: log10
    probabilities of the whole texts by the add-one unigram model over all words, and
    by the log-bilinear model. Nulls: a null text is empty, its only token is the end;
    a null doc_id is kept, and a null held_out counts as held out. Repeated rows count
    and are scored each. With no training rows the counts are 0 and all classes alike.
    An empty table gives an empty result. Extra columns are not read.
    """
    spark = docs.sparkSession
    rows = docs.select("doc_id", "text", F.coalesce(held_out, F.lit(True)).alias("held_out"))
    train = rows.filter(~F.col("held_out"))
    counts = materialise(word_counts(train), "word-counts")
    ends = train.count()
    sums = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    n_tokens, n_distinct = sums[0] + ends, sums[1] + (ends > 0)
    head, tail = class_sizes(n_distinct)
    # a fixed number of rows
    top = counts.orderBy(F.desc("c"), "word").limit(max(head, n_common)).toArrow()
    common, common_counts = top.column("word").to_pylist(), top.column("c").to_numpy()

    n = head + tail + 1
    known_head = pa.array(common[:head], pa.binary())

    def tails(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, distinct = np.zeros(n, np.int64), np.zeros(n, np.int64)
        for batch in batches:
            kinds = _classes(batch.column("word").cast(pa.binary()), known_head, head, tail)[1]
            total += np.bincount(kinds, batch.column("c").to_numpy(), minlength=n).astype(np.int64)
            distinct += np.bincount(kinds, minlength=n)
        seen = np.flatnonzero(distinct)
        yield pa.RecordBatch.from_pydict({"kind": pa.array(seen), "n": pa.array(total[seen]), "v": pa.array(distinct[seen])})

    seen, tail_size = np.append(np.zeros(n - 1), ends), np.ones(n)
    for r in counts.mapInArrow(tails, "kind long, n long, v long").groupBy("kind").agg(F.sum("n").alias("n"), F.sum("v").alias("v")).collect():
        seen[r["kind"]] += r["n"]
        tail_size[r["kind"]] += r["n"] + r["v"]
    model = train_model(train, common, head, tail, (seen + 0.5) / (seen.sum() + 0.5 * n))
    # P(word | class) of a word without a vector of its own is (c + 1) / tail_size
    share = np.where((np.arange(n) >= head) & (np.arange(n) < head + tail), -np.log10(tail_size), 0.0)
    sent = spark.sparkContext.broadcast((common, np.log10(common_counts + 1.0), head, model, share))
    base_size, end_cost = np.log10(n_tokens + n_distinct + 1), np.log10(ends + 1.0)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common, log_count, head, model, share = sent.value
        known = pa.array(common, pa.binary())
        log_count = np.append(log_count, 0.0)
        for rows, data, at in chunks(batches, limit=_CHUNK):
            words, cut = words_of(LOWER[data], at, NOT_SPACE)
            rank, kinds = _classes(words, known, head, tail)
            before, target = _with_ends(kinds, cut, n - 1)
            bounds = cut + np.arange(len(cut))
            by_model = per_text(model.log10_probabilities(before, target) + share[target], bounds)
            counted = per_text(log_count[rank], cut)
            in_tail = per_text(np.where(kinds >= head, log_count[rank], 0.0), cut)
            size = np.diff(bounds)
            rest = np.flatnonzero(rank < 0)
            yield pa.RecordBatch.from_pydict(
                {
                    "row": rows.column("row"),
                    "doc_id": rows.column("doc_id"),
                    "held_out": rows.column("held_out"),
                    "n_tokens": pa.array(size),
                    "n_known": pa.array(per_text(rank >= 0, cut) + (ends > 0)),
                    "base_score": pa.array(counted + end_cost - size * base_size),
                    "score": pa.array(by_model + in_tail),
                    "rest": pa.ListArray.from_arrays(pa.array(np.searchsorted(rest, cut).astype(np.int32)), words.take(pa.array(rest))),
                }
            )
        settle()

    schema = f"row long, doc_id {kind}, held_out boolean, n_tokens long, n_known long, base_score double, score double, rest array<binary>"
    scored = materialise(rows.withColumn("row", F.monotonically_increasing_id()).mapInArrow(score, schema), "scored")
    rare = counts.select("word", F.log10(F.col("c") + 1.0).alias("gain"))
    gains = (
        scored.select("row", F.explode("rest").alias("word"))
        .join(rare, "word")
        .groupBy("row")
        .agg(F.sum("gain").alias("gain"), F.count("*").alias("found"))
    )
    gain = F.coalesce("gain", F.lit(0.0))
    return scored.drop("rest").join(gains, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("found", F.lit(0))).alias("n_known"),
        F.lit(n_tokens).cast("long").alias("train_tokens"),
        (F.col("base_score") + gain).alias("base_score"),
        (F.col("score") + gain).alias("score"),
    )
