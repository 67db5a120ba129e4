"""The recurrent model's work in arrays: no call a word, the same words, inputs and gradients as the plain definitions."""

import cProfile
import pstats

import numpy as np
import pyarrow as pa

from fieldlens.llm import gru
from fieldlens.llm.shared import words_of

ODD = ["The cat  sat", None, "", " \t\x0b lead and trail \r\n", "a\x1cb\x85c\xa0d", "ÀÉ Straße ß éa 語", "A", "é x"]


def _vocabulary():
    words = ["the", "cat", "", "a", "éa"]
    head = dict(zip(words, (50, 30, 20, 10, 8), strict=True)) | {"sat": 5, "ß": 3}
    rare_n, rare_v = np.zeros(gru.RARE), np.zeros(gru.RARE)
    for w in ("sat", "ß"):
        rare_n[gru.rare_class(w)] += head[w]
        rare_v[gru.rare_class(w)] += 1
    return gru.Vocabulary(words, head, 126, 7, rare_n, rare_v)


def test_words_and_inputs_are_those_of_the_definitions():
    v = _vocabulary()
    words, owner = gru.tokens_of(pa.array(ODD, pa.string()))
    plain = [[w.decode() for w in words_of(t)] for t in ODD]
    assert words.to_pylist() == [w for ws in plain for w in ws]
    assert owner.tolist() == [i for i, ws in enumerate(plain) for _ in ws]
    ids, at = v.ids_of(words)
    assert ids.tolist() == [v.id_of(w) for ws in plain for w in ws]
    assert [a >= 0 for a in at] == [w in v.head for ws in plain for w in ws]
    flat, ends, lengths = gru._stream(v, pa.array(ODD, pa.string()))
    start, end = len(v.words) + gru.RARE, v.ids[gru.END]
    assert [flat[a:b].tolist() for a, b in zip(ends, ends[1:], strict=False)] == [[start, *map(v.id_of, ws), end] for ws in plain]
    assert lengths.tolist() == [len(ws) + 1 for ws in plain]


def test_learning_and_scoring_make_no_call_a_word():
    """Before, each distinct word of a text cost several calls; and the query was over its budget of CPU time."""
    v = _vocabulary()
    net = gru.Network(v, np.random.default_rng(1)).as_float32()
    texts = pa.array([" ".join(f"w{i * 500 + j}" for j in range(500)) for i in range(200)], pa.string())
    profile = cProfile.Profile()
    profile.enable()
    rows = gru.score_texts(v, net, texts)
    flat, *_ = gru._stream(v, texts)
    profile.disable()
    assert sum(rows[0].to_pylist()) == 200 * 501 and len(flat) == 200 * 502
    assert pstats.Stats(profile).total_calls < 0.5 * 200 * 500


def test_outputs_out_of_the_range_of_numbers():
    h = np.random.default_rng(0).normal(size=(5, gru.HIDDEN))
    weights = np.random.default_rng(1).normal(size=(gru.HIDDEN, 7))
    target = np.array([0, 3, 6, 1, 2])
    for shift in (0, 2000, -2000):
        z = h @ weights
        want = z[np.arange(5), target] - np.log(np.exp(z).sum(axis=1))
        assert np.allclose(gru._log_share(h, weights, np.full(7, float(shift)), target), want)


def test_gradients_of_a_pass_are_differences():
    v = _vocabulary()
    rng = np.random.default_rng(2)
    net = gru.Network(v, rng)
    for p in (net.to_class, net.to_word):
        p += rng.normal(0, 0.3, p.shape)
    start = len(v.words) + gru.RARE
    data = rng.integers(0, start, (3, 9))
    data[:, 0], data[1, 4] = start, start

    def loss():
        h, total = np.zeros((3, gru.HIDDEN)), 0.0
        for t in range(8):
            h = np.where((data[:, t] != start)[:, None], h, 0)
            h = net.step(data[:, t], h)[0]
            y = data[:, t + 1]
            logs = net.log_probabilities(h, v.classes_of(np.where(y == start, 0, y)), np.where(y < len(v.words), y % v.size, np.where(y == start, 0, -1)))
            total -= logs[y != start].sum()
        return total

    picks = [np.flatnonzero(p.ravel() > -1e8) for p in net.params()]
    picks = [rng.choice(at, min(60, len(at)), replace=False) for at in picks]
    want = []
    for p, at in zip(net.params(), picks, strict=True):
        flat = p.reshape(-1)
        for i in at:
            flat[i] += 1e-5
            up = loss()
            flat[i] -= 2e-5
            want.append((up - loss()) / 2e-5)
            flat[i] += 1e-5
    state = gru._State(net)
    gru._pass(v, net, data, state, 0.001)
    got, want = np.concatenate([m.reshape(-1)[at] for m, at in zip(state.mean, picks, strict=True)]), np.array(want)
    # the mean holds a tenth of the gradient, whose length is limited
    ratio = (got @ want) / (want @ want)
    assert ratio > 0 and np.allclose(got, ratio * want, atol=1e-7 + 1e-4 * np.abs(got).max())
