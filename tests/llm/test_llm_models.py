"""The two trained models against plain versions: direct convolution, a scalar training loop, dense dot products."""

from __future__ import annotations

import math

import numpy as np
import pytest

from mercato.llm import language, quality


def random_net(seed=1, langs=("a", "b", "c")):
    rng = np.random.default_rng(seed)
    filters = [rng.normal(size=(w, language.EMBED, language.FILTERS)).astype(np.float32) for w in language.WIDTHS]
    biases = [rng.normal(size=language.FILTERS).astype(np.float32) for _ in language.WIDTHS]
    last = rng.normal(size=(language.FILTERS * len(language.WIDTHS), len(langs))).astype(np.float32)
    embedding = rng.normal(size=(256, language.EMBED)).astype(np.float32)
    return language.ByteCNN(list(langs), embedding, filters, biases, last, np.zeros(len(langs), np.float32))


def direct(net, window):
    """Every filter at every place, one sum after the other."""
    out = []
    for w, filters, bias in zip(language.WIDTHS, net.W, net.b):
        e = net.E[window].astype(float)
        for f in range(language.FILTERS):
            places = [sum(float(e[i + j] @ filters[j, :, f]) for j in range(w)) + bias[f] for i in range(len(window) - w + 1)]
            out.append(max(0.0, max(places)))
    return out


def test_table_convolution_equals_the_direct_one():
    net = random_net()
    x = np.random.default_rng(2).integers(0, 256, (3, language.WINDOW)).astype(np.uint8)
    got = language.pooled(net.tables(), x)
    for row, window in zip(got, x):
        assert np.allclose(row, direct(net, window), atol=1e-3)


def test_training_separates_bytes():
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.integers(97, 105, (120, language.WINDOW)), rng.integers(101, 110, (120, language.WINDOW))]).astype(np.uint8)
    y = np.repeat([0, 1], 120)
    net = language.train(x, y, ["a", "b"])
    p = language.softmax(language.pooled(net.tables(), x) @ net.U + net.c)
    assert (p.argmax(axis=1) == y).mean() > 0.97 and np.allclose(p.sum(axis=1), 1)


def scalar_ftrl(rows, epochs=3, alpha=0.3, beta=1.0, l1=0.02, l2=1.0):
    z, n, zb, nb = {}, {}, 0.0, 0.0

    def weight(i):
        a = z.get(i, 0.0)
        return 0.0 if abs(a) <= l1 else -(a - math.copysign(l1, a)) / ((beta + math.sqrt(n.get(i, 0.0))) / alpha + l2)

    for _ in range(epochs):
        for slots, counts, y in rows:
            total = sum(counts)
            w = [weight(i) for i in slots]
            wb = -zb / ((beta + math.sqrt(nb)) / alpha)
            p = 1 / (1 + math.exp(-(sum(a * c / math.sqrt(total) for a, c in zip(w, counts)) + wb)))
            for i, a, c in zip(slots, w, counts):
                g = (p - y) * c / math.sqrt(total)
                old = n.get(i, 0.0)
                z[i] = z.get(i, 0.0) + g - (math.sqrt(old + g * g) - math.sqrt(old)) / alpha * a
                n[i] = old + g * g
            g = p - y
            zb += g - (math.sqrt(nb + g * g) - math.sqrt(nb)) / alpha * wb
            nb += g * g
    return {i: weight(i) for i in z}, -zb / ((beta + math.sqrt(nb)) / alpha)


def test_ftrl_equals_a_scalar_loop():
    rng = np.random.default_rng(4)
    rows = []
    for k in range(60):
        slots = np.sort(rng.choice(40, int(rng.integers(1, 12)), replace=False)).astype(np.int32)
        rows.append((slots, rng.integers(1, 4, len(slots)).astype(np.int32), int(slots.min() < 8)))
    model = quality.ftrl(rows)
    weights, bias = scalar_ftrl([(s.tolist(), c.tolist(), y) for s, c, y in rows])
    assert model.bias == pytest.approx(bias)
    assert np.allclose([model.weights[i] for i in weights], list(weights.values()), atol=1e-6)
    assert np.count_nonzero(model.weights) <= len(weights)


def test_sparse_scores_equal_dense_ones():
    rng = np.random.default_rng(5)
    weights = rng.normal(size=1 << quality.BITS).astype(np.float32)
    model = quality.QualityModel(weights, -0.2)
    for text in ("one two three two one", "a", "", "x y " * 500, "été — naïve!"):
        slots = quality.ngram_slots(text, quality.TokenHashes())
        dense = np.bincount(slots, minlength=1 << quality.BITS).astype(float)
        dot = dense @ weights.astype(float) / math.sqrt(max(1, len(slots)))
        assert model.score(slots) == pytest.approx(1 / (1 + math.exp(-(dot - 0.2))), abs=1e-9)
        assert len(slots) == max(0, 2 * len(quality.TOKEN.findall(text)) - 1)
