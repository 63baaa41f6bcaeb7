"""Bottom-k samples, the sampled Euclidean silhouette and the thinned ROC curve against plain Python."""

from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest

from mercato.functions.ranking import running_totals
from mercato.functions.sampling import bottom_k
from mercato.operators import evaluation as ev


def test_bottom_k_is_the_smallest_hashes(spark):
    df = spark.range(5000).selectExpr("id", "id % 7 as v").repartition(9)
    want = sorted(range(5000), key=lambda i: hashlib.md5(str(i).encode()).hexdigest())
    for k in (1, 40, 999, 6000):
        assert {r["id"] for r in bottom_k(df, "id", k).collect()} == set(want[:k])
    # The sample of a union is the sample of its parts' samples.
    halves = [bottom_k(df.where(f"id % 2 = {i}"), "id", 40) for i in (0, 1)]
    assert {r["id"] for r in bottom_k(halves[0].union(halves[1]), "id", 40).collect()} == set(want[:40])


def test_bottom_k_edges(spark):
    df = spark.createDataFrame([(None, "a"), (1, "b"), (1, "c")], "id long, v string")
    assert {r["v"] for r in bottom_k(df, "id", 2).collect()} == {"b", "c"}
    assert bottom_k(df.limit(0), "id", 2).collect() == []
    with pytest.raises(ValueError):
        bottom_k(df, "id", 0)


def brute_silhouette(points):
    out = []
    for i, (c, x) in enumerate(points):
        by = {}
        for j, (d, y) in enumerate(points):
            if i != j:
                by.setdefault(d, []).append(math.dist(x, y))
        if c not in by or len(by) < 2:
            out.append(0.0)
            continue
        a, b = np.mean(by[c]), min(np.mean(v) for d, v in by.items() if d != c)
        out.append((b - a) / max(a, b) if max(a, b) else 0.0)
    return float(np.mean(out))


def test_silhouette_of_a_sample_equals_all_pairs(spark):
    rng = random.Random(4)
    rows = [(i, rng.choice((0, 0, 0, 1, 2)), rng.gauss(0, 1), rng.gauss(0, 2)) for i in range(700)] + [(700, 9, 5.0, 5.0)]
    df = spark.createDataFrame([*rows, (701, None, 0.0, 0.0), (702, 1, None, 0.0)], "id long, c int, x double, y double")
    got = ev.silhouette_sample(df, ["x", "y"], "c", "id").first()
    assert got["points"] == 701 and got["silhouette"] == pytest.approx(brute_silhouette([(c, (x, y)) for _, c, x, y in rows]), abs=1e-9)
    sample = sorted(rows, key=lambda r: hashlib.md5(str(r[0]).encode()).hexdigest())[:100]
    small = ev.silhouette_sample(df.where("c is not null and x is not null"), ["x", "y"], "c", "id", sample_size=100).first()
    assert small["points"] == 100 and small["silhouette"] == pytest.approx(brute_silhouette([(c, (x, y)) for _, c, x, y in sample]), abs=1e-9)
    one = ev.silhouette_sample(df.where("c = 0"), ["x", "y"], "c", "id").first()
    assert one["silhouette"] == 0.0
    assert ev.silhouette_sample(df.limit(0), ["x", "y"], "c", "id").first()["points"] == 0


def thinned(rows):
    """scikit-learn's rule on the cumulated counts: points where a second difference is not zero, and both ends."""
    scores = sorted({s for _, s in rows}, reverse=True)
    tps = np.array([sum(y for y, s in rows if s >= t) for t in scores])
    fps = np.array([sum(1 - y for y, s in rows if s >= t) for t in scores])
    keep = np.ones(len(scores), bool)
    if len(scores) > 2:
        keep[1:-1] = (np.diff(fps, 2) != 0) | (np.diff(tps, 2) != 0)
    return {(t, f / fps[-1], p / tps[-1]) for t, f, p, k in zip(scores, fps, tps, keep) if k} | {(None, 0.0, 0.0)}


@pytest.mark.parametrize("scores", [1, 2, 3, 40, 400])
def test_thinned_curve(spark, scores):
    rng = random.Random(scores)
    rows = [(rng.randrange(2), rng.randrange(scores) / 1000) for _ in range(900)]
    # Equal steps in a row, so that points on a straight line occur, also at slice borders.
    rows += [(y, 2 + i / 1000) for i in range(60) for y in (0, 1)] if scores > 2 else []
    df = spark.createDataFrame(rows, "label int, score double").repartition(5)
    got = {tuple(r) for r in ev.roc_curve(df, drop_intermediate=True).collect()}
    assert got == thinned(rows)
    assert len(got) < len({s for _, s in rows}) - 50 or scores < 3


def test_next_values_across_slices(spark):
    df = spark.createDataFrame([(i, i % 5) for i in range(200)], "k long, v long").repartition(7)
    out = running_totals(df, ["k"], ["v"], num_partitions=9, following=["v"]).collect()
    by = {r["k"]: r for r in out}
    assert all(by[i]["next_v"] == (i + 1) % 5 for i in range(199)) and by[199]["next_v"] is None
    assert by[199]["cum_v"] == sum(i % 5 for i in range(200))
