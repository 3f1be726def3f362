"""Boosted trees with Tweedie loss against a plain version that holds all rows of a model."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from demandloom.operators import boosting


def plain(x, y, w, cuts, trees, depth, rate=0.3, p=1.3, penalty=1.0, least=20):
    """Trees as maps from nodes to (feature, bin, low, high), grown level by level."""
    bins = np.stack([np.where(np.isnan(x[:, j]), 0, 1 + np.searchsorted(c, x[:, j], side="left")) for j, c in enumerate(cuts)], axis=1)
    base = math.log((w * y).sum() / w.sum())
    margin, made = np.full(len(y), base), []
    for _ in range(trees):
        g = w * (np.exp((2 - p) * margin) - y * np.exp((1 - p) * margin))
        h = w * ((2 - p) * np.exp((2 - p) * margin) - (1 - p) * y * np.exp((1 - p) * margin))
        tree, at, value = {}, np.ones(len(y), int), np.zeros(len(y))
        for level in range(depth):
            for node in sorted(set(at[at >= 2**level])):
                inside = at == node
                best = None
                for j in range(bins.shape[1]):
                    for b in sorted(set(bins[inside, j])):
                        low = inside & (bins[:, j] <= b)
                        high = inside & ~low
                        if min(low.sum(), high.sum()) < least:
                            continue
                        score = lambda i: g[i].sum() ** 2 / (h[i].sum() + penalty)
                        gain = round(score(low) + score(high) - score(inside), 9)
                        if gain > 1e-9 and (best is None or gain > best[0]):
                            best = gain, j, b, -g[low].sum() / (h[low].sum() + penalty), -g[high].sum() / (h[high].sum() + penalty)
                if best:
                    tree[node] = best[1:]
                    right = inside & (bins[:, best[1]] > best[2])
                    value[inside] = np.where(right[inside], best[4], best[3])
                    at[inside] = 2 * node + right[inside]
        margin = margin + rate * value
        made.append({k: (int(v[0]), int(v[1]), rate * v[2], rate * v[3]) for k, v in tree.items()})
    return base, made, np.exp(margin)


def sparse_rows(n=900, seed=5):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        a, b, c = rng.randrange(6), rng.random(), rng.choice([1.0, 2.0, None])
        mean = 0.2 + 2 * (a > 3) + 3 * (b > 0.5) * (c == 2.0)
        out.append(("big" if i % 3 else "small", max(0.0, float(round(rng.gauss(mean, 1.5)))), 0.5 + rng.random(), float(a), b, c))
    return out


def test_equal_splits_to_a_plain_version(spark):
    """Two models of different sizes at once, weights, nulls, nodes that can't be split further."""
    rows = sparse_rows()
    df = spark.createDataFrame(rows, "m string, y double, w double, a double, b double, c double").repartition(5)
    names = ["a", "b", "c"]
    models, cuts = boosting.fit(df, names, trees=3, depth=3, bins=8)
    got = {r.m: r for r in models.collect()}
    predicted = {}
    for r in boosting.predict(df.withColumn("n", F.monotonically_increasing_id()), models, names, cuts).collect():
        predicted.setdefault((r.m, r.y, r.w), r.prediction)
    for m in ("big", "small"):
        own = [r for r in rows if r[0] == m]
        x = np.array([[np.nan if v is None else v for v in r[3:]] for r in own])
        base, trees, fitted = plain(x, np.array([r[1] for r in own]), np.array([r[2] for r in own]), cuts, 3, 3)
        assert got[m].base == pytest.approx(base)
        for want, tree in zip(trees, got[m].trees, strict=True):
            assert {k: (s.feature, s.bin) for k, s in tree.items()} == {k: v[:2] for k, v in want.items()}
            assert all((tree[k].low, tree[k].high) == pytest.approx(v[2:]) for k, v in want.items())
        assert all(predicted[m, r[1], r[2]] == pytest.approx(f) for r, f in zip(own, fitted, strict=True))


def test_lower_deviance_than_squared_loss_of_logarithms(spark):
    """On sparse demand, held out, against MLlib's boosted trees on log1p of the target, which this replaced."""
    from pyspark.ml.regression import GBTRegressor

    from demandloom.operators.models import assembled

    kind = "m string, y double, w double, a double, b double, c double"
    names = ["a", "b", "c"]
    train, test = (spark.createDataFrame([("all", *r[1:]) for r in sparse_rows(n, s)], kind).fillna(0.0, names) for n, s in ((1500, 1), (600, 2)))
    models, cuts = boosting.fit(train, names)
    ours = boosting.predict(test, models, names, cuts)
    before = GBTRegressor(featuresCol="_x", labelCol="_y", weightCol="w", maxIter=8, maxDepth=4, seed=1).fit(assembled(train, names).withColumn("_y", F.log1p("y"))).transform(assembled(test, names))
    lost = lambda df, p: df.agg(F.avg(boosting.deviance(F.col("y"), p))).first()[0]
    assert lost(ours, F.col("prediction")) < lost(before, F.greatest(F.expm1("prediction"), F.lit(0.0)))


def test_models_without_demand_and_no_rows(spark):
    kind = "m string, y double, w double, a double"
    df = spark.createDataFrame([("none", 0.0, 1.0, 1.0), ("some", 2.0, 1.0, 1.0), ("some", -5.0, 1.0, 2.0), ("some", None, 1.0, None)], kind)
    models, cuts = boosting.fit(df, ["a"], trees=1)
    assert [(r.m, round(math.exp(r.base), 6)) for r in models.collect()] == [("some", round(2 / 3, 6))]
    got = {r.m: r.prediction for r in boosting.predict(df, models, ["a"], cuts).collect()}
    assert got["none"] is None and got["some"] == pytest.approx(2 / 3)
    models, cuts = boosting.fit(df.limit(0), ["a"], trees=1)
    assert models.count() == 0 and boosting.predict(df, models, ["a"], cuts).where("prediction is null").count() == 4


@pytest.mark.parametrize("few", [0, 10_000])
def test_both_ways_to_hold_trees(spark, monkeypatch, few):
    monkeypatch.setattr(boosting, "FEW", few)
    df = spark.createDataFrame([(f"m{i % 7}", float(i % 5), 1.0, float(i % 11)) for i in range(700)], "m string, y double, w double, a double")
    models, cuts = boosting.fit(df, ["a"], trees=2, depth=2)
    got = boosting.predict(df, models, ["a"], cuts).agg(F.sum("prediction"), F.count("prediction")).first()
    assert got[1] == 700 and got[0] == pytest.approx(1400, rel=0.05)
