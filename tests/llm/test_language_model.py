"""The log-bilinear model: probabilities that sum to 1, gradients against differences, and a gain by training."""

import numpy as np

from loamwork.llm import log_bilinear as L


def small(n=12, d=5, seed=1):
    rng = np.random.default_rng(seed)
    unigram = rng.dirichlet(np.ones(n))
    model = L.initial_model(unigram, d, seed)
    model.context += rng.normal(0, 1, model.context.shape).astype(np.float32)
    model.target += rng.normal(0, 1, model.target.shape).astype(np.float32)
    return rng, unigram, model


def test_probabilities_sum_to_one_and_use_every_position():
    rng, _, model = small()
    n = len(model.bias)
    for before in rng.integers(0, n, (6, L.POSITIONS)):
        p = 10 ** model.log10_probabilities(np.repeat(before[None], n, 0), np.arange(n))
        assert abs(p.sum() - 1) < 1e-5
        scores = sum(model.context[before[k]] @ model.matrix[k] for k in range(L.POSITIONS)) @ model.target.T + model.bias
        assert np.allclose(np.log(p), scores - np.log(np.exp(scores).sum()), atol=1e-4)
        for k in range(L.POSITIONS):
            other = before.copy()
            other[k] = (other[k] + 1) % n
            assert not np.allclose(model.log10_probabilities(other[None], before[:1]), model.log10_probabilities(before[None], before[:1]))


def test_a_step_follows_the_gradient():
    """The change of every parameter has the sign of the objective's slope, found by differences."""
    rng, unigram, model = small()
    n = len(unigram)
    before, target = rng.integers(0, n, (40, L.POSITIONS)), rng.integers(0, n, 40)
    trainer = L.Trainer(model, unigram, noise=9, rate=0.1)
    drawn = np.minimum(np.searchsorted(trainer.cumulated, np.random.default_rng(L.SEED).random(9) * trainer.cumulated[-1]), n - 1)

    def objective(m):
        predicted = sum(m.context[before[:, k]].astype(float) @ m.matrix[k] for k in range(L.POSITIONS))
        true = (predicted * m.target[target]).sum(1) + m.bias[target] - trainer.log_noise[target]
        false = predicted @ m.target[drawn].T + m.bias[drawn] - trainer.log_noise[drawn]
        return -np.logaddexp(0, -true).sum() - np.logaddexp(0, false).sum()

    flat = model.flat().astype(np.float64)
    slope = np.zeros(len(flat))
    double = L.Model(*(x.astype(np.float64) for x in model.parts()))
    for k in range(len(flat)):
        step = np.zeros(len(flat))
        step[k] = 1e-5
        slope[k] = (objective(double.filled(flat + step)) - objective(double.filled(flat - step))) / 2e-5
    trainer.step(before, target)
    change = trainer.model.flat() - model.flat()
    large = abs(slope) > 1e-2
    assert large.sum() > 50 and (np.sign(change[large]) == np.sign(slope[large])).all()


def test_training_on_all_tasks_beats_the_unigram_model(spark):
    rng = np.random.default_rng(0)
    texts = []
    for k in range(400):  # each word asks for one of the next two
        w = [int(rng.integers(0, 30))]
        for _ in range(80):
            w.append((w[-1] * 7 + int(rng.integers(0, 2))) % 30)
        texts.append((k, " ".join(f"w{x}" for x in w)))
    docs = spark.createDataFrame([*texts, (400, None), (None, "w1 w2")], "doc_id long, text string").repartition(4)
    got = L.score_documents(docs, L.F.pmod("doc_id", L.F.lit(4)) == 0).collect()
    held = [r for r in got if r.held_out and r.n_tokens > 2]
    assert sum(r.score for r in held) > 0.8 * sum(r.base_score for r in held)
    assert {r.n_tokens for r in got} == {1, 3, 82}


def test_what_is_gathered_grows_with_the_words():
    sizes = [sum(L.class_sizes(10**k)) for k in range(3, 13)]
    assert sizes == sorted({*sizes}) and L.class_sizes(0) == (128, 32)
