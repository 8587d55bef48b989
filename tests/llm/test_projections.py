import math
import random

import numpy as np
from helpers_llm import clashing, components

from streetflow.llm import projections

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, threshold=0.9):
    good = [(n, i, np.array(v, np.float32).astype(np.float64)) for n, (i, v) in enumerate(rows)
            if v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    links = [(a[0], b[0]) for k, a in enumerate(good) for b in good[:k] if len(a[2]) == len(b[2])
             and a[2] @ b[2] / np.sqrt((a[2] @ a[2]) * (b[2] @ b[2])) >= threshold]
    comp = components(range(len(rows)), links)
    least = {}
    for n, (i, _) in enumerate(rows):
        if i is not None:
            least[comp[n]] = min(least.get(comp[n], i), i)
    return sorted(((i, sum(n in p for p in links), least.get(comp[n]), i is not None and least.get(comp[n]) == i)
                   for n, (i, _) in enumerate(rows)), key=repr)


def run(spark, rows, threshold=0.9):
    df = clashing(spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA))
    return sorted((tuple(r) for r in projections.near_vectors(df, threshold=threshold).collect()), key=repr)


def vectors(rng, groups, copies, noise, dims=32):
    out = []
    for _ in range(groups):
        base = rng.standard_normal(dims)
        base /= np.linalg.norm(base)
        for _ in range(copies):
            out.append((base + noise * rng.standard_normal(dims) / math.sqrt(dims)).tolist())
    return out


def test_matches_brute_force_near_the_threshold(spark):
    rng = np.random.default_rng(1)
    for noise in (0.1, 0.33, 0.5):  # cosines about 0.99, 0.9 and 0.8
        rows = list(enumerate(vectors(rng, 40, 8, noise) + vectors(rng, 200, 1, 0)))
        random.Random(2).shuffle(rows)
        assert run(spark, rows) == brute(rows)


def test_hot_vector_and_hot_cell(spark):
    rng = np.random.default_rng(3)
    same = rng.standard_normal(32).tolist()
    rows = list(enumerate([same] * 700 + vectors(rng, 1, 1300, 0.2) + vectors(rng, 100, 1, 0)))
    assert run(spark, rows) == brute(rows)


def test_edge_cases(spark):
    rows = [(5, [1.0, 2.0, 3.0]), (3, [2.0, 4.0, 6.0]), (None, [1.0, 2.0, 3.0]), (None, None), (9, None), (8, []),
            (7, [0.0, 0.0, 0.0]), (6, [1.0, None, 3.0]), (4, [1.0, float("nan"), 3.0]), (2, [float("inf"), 1.0, 1.0]),
            (1, [1.0, 2.0]), (10, [-1.0, -2.0, -3.0]), (10, [-1.0, -2.0, -3.0]), (11, [1e30, 2e30, 3e30]),
            (12, [1e-30, 0.0, 0.0]), (13, [1.0, -0.0, 0.0])]
    assert run(spark, rows) == brute(rows)
    assert run(spark, []) == []


def test_parameters():
    depth, tables = projections.shape_of(10**6, 0.9)
    close = projections.meeting(projections.WIDTH, math.sqrt(0.2))
    assert (1 - close**depth) ** tables <= 5e-4
    assert projections.meeting(projections.WIDTH, math.sqrt(2)) ** depth * 10**6 <= 64
    rng = np.random.default_rng(0)  # the formula against a simulation
    d, u = rng.standard_normal(200_000) * 0.7, rng.uniform(0, 2.4, 200_000)
    assert abs(np.mean(np.floor((u + d) / 2.4) == 0) - projections.meeting(2.4, 0.7)) < 0.005


def test_tables_in_passes_of_one_give_the_same_rows(spark, monkeypatch):
    """The disk that cells take does not follow the number of tables."""
    rng = np.random.default_rng(9)
    rows = list(enumerate(vectors(rng, 20, 6, 0.25) + vectors(rng, 100, 1, 0) + vectors(rng, 5, 3, 0.2, dims=7)))
    passes = []
    monkeypatch.setattr(projections, "_PASS_BYTES", 1)
    monkeypatch.setattr(projections, "_pass", lambda *a, f=projections._pass: passes.append(a[3]) or f(*a))
    assert run(spark, rows) == brute(rows)
    assert [len(p) for p in passes] == [1] * projections.shape_of(len(rows), 0.9)[1]
