"""Certified blend weights against brute force and the cases that a fit must get right."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from demandloom.operators import combine, convex

SCHEMA = "category string, segment string, s double, c double, rf double, actual double"


def loss(w, x, a, tolerance=0.02):
    total = max(a.sum(), 1e-9)
    floor = min((x[:, 2] - a).sum() / total, 0.0) - tolerance
    short = max(0.0, floor - (x @ w - a).sum() / total)
    return np.abs(x @ w - a).sum() / total + 200 * short**2


def made(seed, n=60):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        a = rng.uniform(0, 50)
        rows.append(("AB"[i % 2], f"s{i % 3}", a * rng.uniform(0.3, 0.9), a * rng.uniform(0.8, 1.6), a + rng.gauss(0, 10), a))
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_within_the_gap_of_the_least_loss(spark, seed):
    """No point of a fine search is better than the certified bound, and the loss is that of the weights."""
    rows = made(seed)
    for r in convex.fit_convex(spark.createDataFrame(rows, SCHEMA), ["category"]).collect():
        own = [x for x in rows if x[0] == r.category]
        x, a = np.array([v[2:5] for v in own]), np.array([v[5] for v in own])
        assert r.loss == pytest.approx(loss(np.array(r.weights), x, a)) and r.gap <= 1e-4
        best, step = np.array(r.weights), 0.25
        while step > 1e-5:
            near = [np.clip(best + step * np.array(d), 0, 3) for d in itertools.product((-2, -1, 0, 1, 2), repeat=3)]
            best = min(near, key=lambda w: loss(w, x, a))
            step /= 2
        assert loss(best, x, a) >= r.loss - 1e-4 - 1e-12


def test_clear_cases(spark):
    """Both parts right: weight on them; the benchmark right: weight on it; the true weights beyond 1 are found, those beyond the box end at its side; nothing sold, one row, nulls."""
    rows = [("good", "x", 200.0 + 20 * i, 200.0 + 20 * i, 1.5 * (200 + 20 * i), 200.0 + 20 * i) for i in range(24)]
    rows += [("legobest", "x", 0.5 * (150 + 20 * i), 0.5 * (150 + 20 * i) + (-1) ** i, 150.0 + 20 * i, 150.0 + 20 * i) for i in range(24)]
    rows += [("large", "x", 10.0 + i, float((7 * i) % 11), 0.0, 2.5 * (10.0 + i)) for i in range(24)]
    rows += [("beyond", "x", 10.0 + i, 0.0, 0.0, 5.0 * (10.0 + i)) for i in range(24)]
    rows += [("none", "x", 0.0, 0.0, 0.0, 0.0), ("one", "x", 3.0, 4.0, 5.0, 6.0), (None, "x", None, 2.0, 2.0, 2.0)]
    got = {r.category: r for r in convex.fit_convex(spark.createDataFrame(rows, SCHEMA), ["category"]).collect()}
    assert len(got) == 7 and all(r.gap <= 1e-4 for r in got.values())
    assert got["good"].weights[0] + got["good"].weights[1] > 0.5 and got["good"].loss < 1e-4
    assert got["legobest"].loss < 1e-4
    assert got["large"].weights == pytest.approx([2.5, 0, got["large"].weights[2]], abs=0.01)
    assert got["beyond"].weights[0] == pytest.approx(3.0)
    assert got["one"].loss < 1e-4 and got[None].loss < 1e-4 and got["none"].loss == 0


def test_levels_are_drawn_to_their_parents(spark):
    """Without a pull a level is fitted alone, with a strong one it takes its parent's weights; between them the sum of loss and distance is least."""
    df = spark.createDataFrame(made(7, 90), SCHEMA)
    alone = {r.category: r.weights for r in convex.fit_convex(df, ["category"]).collect()}
    free = {r.category: r.loss for r in convex.fit_levels(df, [[], ["category"]], 0.0).collect()}
    assert free == pytest.approx({k: loss(np.array(w), *split(df, k)) for k, w in alone.items()}, abs=1e-4)
    top = convex.fit_convex(df.withColumn("_all", F.lit(1)), ["_all"]).first()
    for squared in (False, True):
        tight = convex.fit_levels(df, [[], ["category"]], 50.0, squared=squared).collect()
        assert all(r.weights == pytest.approx(top.weights, abs=0.02) for r in tight)
        some = {r.category: r for r in convex.fit_levels(df, [[], ["category"]], 0.1, squared=squared).collect()}
        for k, r in some.items():
            away = np.array(r.weights) - np.array(top.weights)
            assert r.loss == pytest.approx(loss(np.array(r.weights), *split(df, k)) + 0.1 * ((away**2).sum() if squared else np.abs(away).sum()), abs=1e-6)


def split(df, category):
    own = df.where(F.col("category") == category).collect()
    return np.array([r[2:5] for r in own]), np.array([r[5] for r in own])


def test_envelope_by_a_grid():
    rng = np.random.default_rng(4)
    for _ in range(20):
        slopes, offsets = rng.normal(size=(12, 2)), rng.normal(size=12)
        w, bound = convex.envelope(slopes, offsets, 3.0)
        grid = np.stack(np.meshgrid(*[np.linspace(0, 3, 301)] * 2), axis=-1).reshape(-1, 2)
        least = (grid @ slopes.T + offsets).max(axis=1).min()
        assert bound <= least + 1e-9 and (slopes @ w + offsets).max() == pytest.approx(bound, abs=1e-9) and least - bound < 0.05


def test_no_rows_and_deployed(spark):
    df = spark.createDataFrame(made(1), SCHEMA)
    assert convex.fit_convex(df.limit(0), ["category"]).count() == 0
    kept = combine.guardrail(df, convex.fit_convex(df, ["category"]), ["category"], margin=0.99).collect()
    assert all(r.weights == [0.0, 0.0, 1.0] for r in kept)
