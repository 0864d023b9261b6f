"""NN-descent links and components against brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfwise.llm import nn_descent

SCHEMA = "vec_id long, embedding array<float>, label int, id string, node int, key string"


def frame(spark, rows):
    """Vectors with columns that clash with the operator's own."""
    return spark.createDataFrame([(i, v, 1, "x", 2, "y") for i, v in rows], SCHEMA).repartition(5)


def brute(rows, threshold=0.9):
    def usable(v):
        return v and all(x is not None and math.isfinite(x) for x in v) and any(v)
    good = [(k, i, np.array(v, dtype=np.float32).astype(float)) for k, (i, v) in enumerate(rows) if i is not None and usable(v)]
    links, parent = {k: 0 for k in range(len(rows))}, {k: k for k in range(len(rows))}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for x, (k, _, v) in enumerate(good):
        for l, _, w in good[x + 1:]:
            if len(v) == len(w) and math.fsum(v * w) / math.sqrt(math.fsum(v * v) * math.fsum(w * w)) >= threshold:
                links[k] += 1
                links[l] += 1
                parent[find(l)] = find(k)
    out = []
    for k, (i, _) in enumerate(rows):
        ids = [rows[l][0] for l in parent if find(l) == find(k) and rows[l][0] is not None]
        first = min(ids) if ids else None
        out.append((i, links[k], first, i == first))
    return sorted(out, key=str)


def found(spark, rows):
    got = nn_descent.near_components(frame(spark, rows))
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    return sorted((tuple(r) for r in got.collect()), key=str)


def cloud(rng, n, d=24):
    return [[rng.gauss(0, 1) for _ in range(d)] for _ in range(n)]


def near(rng, v, noise):
    return [x + rng.gauss(0, noise) for x in v]


def test_links_components_and_edge_cases(spark):
    rng = random.Random(1)
    base = cloud(rng, 150)
    rows = [(i * 3, v) for i, v in enumerate(base)]
    rows += [(i * 3 + 1, near(rng, v, 0.1)) for i, v in enumerate(base) if i % 2]
    rows += [(i * 3 + 2, near(rng, v, 0.35)) for i, v in enumerate(base) if i % 5 == 0]
    rows += [(2000 + i, near(rng, base[0], 0.05)) for i in range(60)]                    # near copies
    rows += [(3000 + i, base[1]) for i in range(80)]                                     # copies
    rows += [(4000, [2 * x for x in base[2]]), (4001, [-x for x in base[2]]), (4002, [1e38 * x / 9 for x in base[2]]),
             (4003, None), (4004, []), (4005, [0.0] * 24), (4006, [None] + base[2][1:]), (4007, [math.nan] + base[2][1:]),
             (4008, [math.inf] + base[2][1:]), (4009, [1.0]), (4010, [2.0]), (4011, [-1.0]), (None, base[2]),
             (6, base[70]), (5000, [0.0, 1.0]), (5001, [-0.0, 1.0])]
    assert found(spark, rows) == brute(rows)


def test_empty_and_alone(spark):
    assert found(spark, []) == []
    assert found(spark, [(4, [1.0, 2.0])]) == [(4, 0, 4, True)]
    assert found(spark, [(4, None), (None, None)]) == [(4, 0, 4, True), (None, 0, None, True)]


def test_rounds_join_what_seeds_left_apart(spark, monkeypatch):
    """After a few sorted orders of short runs the rounds find the rest; groups larger than a block are split."""
    monkeypatch.setattr(nn_descent, "LEAF", 32)
    monkeypatch.setattr(nn_descent, "TREES", 4)
    monkeypatch.setattr(nn_descent, "SPLIT", 20)
    monkeypatch.setattr(nn_descent, "RECALL", 0.95)
    rng = random.Random(4)
    base = cloud(rng, 120)
    rows = list(enumerate(base)) + [(1000 + i, near(rng, base[0], 0.1)) for i in range(150)]
    rows += [(2000 + i, near(rng, base[i], 0.1)) for i in range(1, 60)]
    want, got = brute(rows), found(spark, rows)
    links = sum(r[1] for r in got)
    assert links >= 0.95 * sum(r[1] for r in want) and all(g[1] <= w[1] for g, w in zip(got, want))
    group = [r for r in got if r[0] == 0 or 1000 <= r[0] < 2000]
    assert {r[2] for r in group} == {0} and min(r[1] for r in group) >= 140    # saturated lists were enlarged


def test_the_audit_counts_what_is_missing(spark):
    rng = random.Random(8)
    v = cloud(rng, 1)[0]
    rows = [(i, near(rng, v, 0.05)) for i in range(40)]
    prepared = nn_descent._prepared(frame(spark, rows), "vec_id", "embedding")
    nodes = prepared.select(F.col("id").alias("node"), "key", "d", "vec")
    pairs = [(a, b, 1.0) for a in range(40) for b in range(a + 1, 40)]
    links = spark.createDataFrame(pairs, "v long, w long, sim double")
    assert nn_descent.audited_recall(nodes, links, 0.9) == 1.0
    assert nn_descent.audited_recall(nodes, links.where("v < 20"), 0.9) == pytest.approx(1 - 190 / 780)
    assert nn_descent.audited_recall(nodes, links.limit(0), 0.9) == 0.0
    assert nn_descent.audited_recall(nodes.limit(1), links.limit(0), 0.9) == 1.0


def test_cosine_at_the_threshold():
    a, b = np.array([1.0, 0.0]).tobytes(), np.array([0.75, 1.0]).tobytes()
    assert nn_descent.cosine(a, b) == 0.6 and nn_descent.cosine(a, a) == 1.0
    group = {"node": np.array([5, 3]), "vec": [a, b], "new": np.array([True, False]), "a": 0, "b": 0,
             "side": np.array([0, 0]), "tail": np.array([-2.0, -2.0])}
    v, w, sim, link = nn_descent._compare(group, 0.6, 4)
    assert (v.tolist(), w.tolist(), link.tolist()) == ([3], [5], [True])
    group["new"] = np.array([False, False])                            # both have met before
    assert len(nn_descent._compare(group, 0.6, 4)[0]) == 0
