"""The network against a scalar forward pass and finite differences, and the scores against the base."""

from __future__ import annotations

import math
import tracemalloc
import warnings
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tripmill.llm import recurrent_lm as lm
from tripmill.llm.queries import QUERIES


@pytest.fixture(scope="module")
def network():
    counts = np.random.default_rng(1).integers(1, 50, 2 * lm.CLASS_SIZE).astype(float)
    made = lm.Network.start(counts)
    random = np.random.default_rng(2)
    return lm.Network({k: v.astype(np.float64) + random.normal(0, 0.2, v.shape) for k, v in made.values.items()})


def scalar_log_likelihood(network, document):
    """Token by token, unit by unit, by the definition of a gated recurrent unit."""
    v, h = network.values, lm.HIDDEN
    sigmoid = lambda x: 1 / (1 + math.exp(-x))
    state, before, total = [0.0] * h, network.start_row, 0.0
    for token in document:
        gates = [sum(v["embedding"][before, e] * v["input"][e, k] for e in range(lm.EMBEDDING)) + v["input_bias"][k] for k in range(3 * h)]
        back = [sum(state[i] * v["recurrent"][i, k] for i in range(h)) for k in range(3 * h)]
        update = [sigmoid(gates[k] + back[k]) for k in range(h)]
        reset = [sigmoid(gates[h + k] + back[h + k]) for k in range(h)]
        new = [math.tanh(gates[2 * h + k] + reset[k] * back[2 * h + k]) for k in range(h)]
        state = [new[k] + update[k] * (state[k] - new[k]) for k in range(h)]
        classes = [sum(state[i] * v["class_weight"][i, c] for i in range(h)) + v["class_bias"][c] for c in range(len(v["class_bias"]))]
        own = token // lm.CLASS_SIZE
        words = [
            sum(state[i] * v["word_weight"][w, i] for i in range(h)) + v["word_bias"][w]
            for w in range(own * lm.CLASS_SIZE, (own + 1) * lm.CLASS_SIZE)
        ]
        total += classes[own] - math.log(sum(map(math.exp, classes)))
        total += words[token % lm.CLASS_SIZE] - math.log(sum(map(math.exp, words)))
        before = token
    return total


def documents(*sizes):
    random = np.random.default_rng(3)
    return [random.integers(0, 2 * lm.CLASS_SIZE, n).astype(np.int32) for n in sizes]


def test_scores_equal_a_scalar_pass(network):
    docs = documents(1, 5, 30, 61, 2)
    want = [scalar_log_likelihood(network, d.tolist()) for d in docs]
    for width in (1, 2, 256):
        assert lm.score_documents(network, docs, width) == pytest.approx(want, rel=1e-4)


def test_probabilities_of_all_words_add_up_to_one(network):
    state = np.random.default_rng(4).normal(size=(1, lm.HIDDEN))
    each = [network.log_likelihood(state, np.array([w]))[0] for w in range(2 * lm.CLASS_SIZE)]
    assert np.exp(each).sum() == pytest.approx(1)


def test_gradients_equal_finite_differences(network):
    tokens, owner, _ = lm._laid_out(documents(7, 4, 3, 9), 2)
    before, goes_on = lm._inputs(tokens, owner, network.start_row)
    state = np.random.default_rng(5).normal(size=(2, lm.HIDDEN))

    def loss(values):
        made = lm.Network(values)
        gates = values["embedding"][before] @ values["input"] + values["input_bias"]
        own, states = state, []
        for t in range(len(tokens)):
            own = made.step(gates[t], own * goes_on[t, :, None])[0]
            states.append(own)
        real = (owner >= 0).ravel()
        return -made.log_likelihood(np.stack(states).reshape(-1, lm.HIDDEN)[real], tokens.ravel()[real]).sum()

    goes_on[0] = True  # the state comes from a window before
    slopes, _ = lm.window_slopes(network, before, tokens, owner >= 0, goes_on, state)
    random = np.random.default_rng(6)
    assert slopes.keys() == network.values.keys()
    for name, slope in slopes.items():
        busy = np.argsort(-np.abs(slope).ravel())[:20]
        for at in {*random.choice(busy, 4).tolist(), *random.integers(0, slope.size, 3).tolist()}:
            moved = []
            for by in (1e-5, -1e-5):
                values = {k: v.copy() for k, v in network.values.items()}
                values[name].ravel()[at] += by
                moved.append(loss(values))
            assert slope.ravel()[at] == pytest.approx((moved[0] - moved[1]) / 2e-5, rel=1e-3, abs=1e-5), name


def test_mixture_takes_the_likeliest_share():
    gains, times = np.array([-3.0, 0.5, 2.0]), np.array([10, 40, 5])
    found = lm.Mixture.fit(np.ones(4), gains, times).share
    best = max(np.linspace(0.001, 0.999, 999), key=lambda s: (times * np.log(s * np.exp(gains) + 1 - s)).sum())
    assert found == pytest.approx(best, abs=2e-3)
    assert lm.Mixture.fit(np.ones(4), np.zeros(0), np.zeros(0)).share == 0.5


@pytest.mark.parametrize("scale", ["0.001", "0.01", "0.1"])
def test_held_out_texts_are_likelier_than_by_the_base(spark, scale):
    found = QUERIES["op9_recurrent_lm"](spark, f"/root/testdata/sf{scale}")
    for row in found.groupBy("held_out").agg(F.sum("score").alias("score"), F.sum("base_score").alias("base")).collect():
        assert row.score > row.base


def test_odd_tables(spark):
    rows = [(k, t) for k, t in enumerate([None, "", " \n", "a", "A b a", "A b a", "word " * 250_000, "x" * 1_000_000, "é ü"])] + [(None, "no key"), (4, "A b a")]
    docs = spark.createDataFrame([(k, t, "kept", 1) for k, t in rows], "doc_id long, text string, score string, n_tokens int")
    got = lm.score(docs, F.col("doc_id") % 5 != 1).collect()
    sizes = {k: len((t or "").split()) + 1 for k, t in rows if k is not None}
    assert len(got) == len(rows) and all(r.n_tokens == sizes[r.doc_id] for r in got if r.doc_id is not None)
    assert all(np.isfinite(r.score) and r.score < 0 for r in got)
    assert len({(r.score, r.base_score) for r in got if r.doc_id in (4, 5)}) <= 2
    assert lm.score(docs.limit(0), F.lit(True)).count() == 0
    unlearned = lm.score(docs, F.lit(False)).collect()
    assert len(unlearned) == len(rows) and {r.train_tokens for r in unlearned} == {0} and {r.n_known for r in unlearned} == {0}


def test_every_training_token_is_learned_from(spark, monkeypatch):
    noted, fit = [], lm.Mixture.fit
    monkeypatch.setattr(lm.Mixture, "fit", lambda counts, gains, times: noted.append(int(np.sum(times))) or fit(counts, gains, times))
    docs = spark.createDataFrame([(k, f"w{k % 7} " * (k % 50)) for k in range(300)], "doc_id long, text string")
    got = lm.score(docs, F.col("doc_id") % 5 != 1).collect()
    learned = [r for r in got if r.doc_id % 5 != 1]
    assert noted == [sum(r.n_tokens for r in learned)] == [got[0].train_tokens]


def test_windows_fill_the_same_arrays_again():
    random = np.random.default_rng(7)
    start = lm.Network.start(random.integers(1, 50, lm.WORDS).astype(float))
    docs = [random.integers(0, lm.WORDS, 12 * lm.WINDOW).astype(np.int32) for _ in range(128)]
    grown, before = [], []

    def note(found, targets):
        now, most = tracemalloc.get_traced_memory()
        grown.append(most - before[-1] if before else 0)
        before.append(now)
        tracemalloc.reset_peak()

    tracemalloc.start()
    try:
        lm.train_on(start, docs, note=note)
    finally:
        tracemalloc.stop()
    assert len(grown) == 12 and max(grown[2:]) < 2_000_000


def test_steps_of_extreme_gates(network):
    gates = np.array([-1e4, -100.0, -1.0, 0.0, 2.0, 100.0, 1e4])
    gates = np.stack(np.meshgrid(gates, gates, gates), axis=-1).reshape(-1, 3).repeat(lm.HIDDEN, axis=1)
    state = np.random.default_rng(8).uniform(-1, 1, (len(gates), lm.HIDDEN))
    h, back = lm.HIDDEN, state @ network.values["recurrent"]
    update, reset = (0.5 + 0.5 * np.tanh((gates + back)[:, k * h : (k + 1) * h] / 2) for k in (0, 1))
    new = np.tanh(gates[:, 2 * h :] + reset * back[:, 2 * h :])
    with warnings.catch_warnings():
        warnings.simplefilter("error")
        got = network.step(gates, state)[0]
    np.testing.assert_allclose(got, new + update * (state - new), atol=1e-12)


def test_words_of_one_hash_keep_their_own_numbers():
    words = [b"a", b"buckeroo", b"plumless", b"zebra"]
    assert zlib.crc32(b"buckeroo") == zlib.crc32(b"plumless")
    words.sort(key=zlib.crc32)
    packed = lm._Words(np.array([zlib.crc32(w) for w in words], np.uint32), np.ones(4, np.int64), b" ".join(words))
    for vocabulary in ({}, {b"plumless": 2}, {b"buckeroo": 5, b"other": 3}, {b"plumless": 2, b"buckeroo": 4, b"zebra": 3}):
        assert packed.numbers(vocabulary).tolist() == [vocabulary.get(w, lm._RARE) for w in words]
    assert lm._Words(np.zeros(0, np.uint32), np.zeros(0, np.int64), b"").numbers({b"a": 2}).tolist() == []
