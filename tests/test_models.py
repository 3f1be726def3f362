"""Fitted models and choices without SQL: hand-made cases, an independent fit, invariants."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from demandloom.operators import combine, models, profile, ranks, segment


def panel(spark, series, start=100):
    rows = [(k, start + i, float(y), 1.0) for k, ys in series.items() for i, y in enumerate(ys)]
    return spark.createDataFrame(rows, "key string, week_idx int, y double, price double")


def test_recursive_forecast_as_by_least_squares(spark):
    """Lags 1 and 2 and the mean of 3: the same steps from numpy's solution."""
    rng = np.random.default_rng(1)
    series = {}
    for k in "abc":
        ys = [20.0, 22.0, 25.0]
        while len(ys) < 60:
            ys.append(0.5 * ys[-1] + 0.2 * ys[-2] + 8 + rng.normal())
        series[k] = ys
    x, y = [], []
    for ys in series.values():
        for i in range(3, 60):
            x.append([ys[i - 1], ys[i - 2], np.mean(ys[i - 3 : i]), 1.0])
            y.append(ys[i])
    w = np.linalg.lstsq(np.array(x), np.array(y), rcond=None)[0]
    want = {}
    for k, ys in series.items():
        ys = list(ys)
        for h in range(1, 6):
            ys.append(max(0.0, float(np.dot(w, [ys[-1], ys[-2], np.mean(ys[-3:]), 1.0]))))
            want[k, 159 + h] = ys[-1]
    out = models.recursive_forecast(panel(spark, series), 159, 5, [1, 2], [3], penalty=0.0).collect()
    assert {(r.key, r.week_idx): r.predicted for r in out} == pytest.approx(want, rel=1e-4)


def test_pooled_forecast_of_steady_keys_and_scopes(spark):
    """Keys of constant demand are forecast at it; a category of its own behaviour gets its own model if it has rows enough."""
    series = {f"k{i}": [10.0 * (1 + i % 3)] * 80 for i in range(6)}
    p = panel(spark, series).withColumn("category", F.when(F.col("key") < "k3", "A").otherwise("B"))
    out = models.pooled_forecast(p, 170, 2, lags=[1, 2], trees=20).collect()
    assert {(r.key, r.h) for r in out} == {(k, h) for k in series for h in (1, 2)}
    assert all(r.predicted == pytest.approx(series[r.key][0], rel=0.1) and r.actual == series[r.key][0] and r.target_idx == 170 + r.h for r in out)
    few = p.where("category = 'A' or (key = 'k3' and week_idx >= 160)")
    got = {r.key: r.scope for r in models.scoped_forecast(few, 170, [(["category"], 50)], 1, lags=[1, 2], trees=3).collect()}
    assert got == {"k0": "category", "k1": "category", "k2": "category", "k3": "global"}


def test_stacked_takes_the_share_of_the_category(spark):
    rng = random.Random(2)
    series = {f"k{i}": [(10 + 2 * i) * (1.5 if t % 2 else 0.5) if i < 3 else 30 + rng.random() for t in range(90)] for i in range(6)}
    p = panel(spark, series).withColumn("category", F.when(F.col("key") < "k3", "swing").otherwise("flat"))
    out = models.stacked(p, 170, 2).collect()
    assert len(out) == 12 and {r.category for r in out} == {"swing", "flat"}
    # The mean of 13 periods can't follow the swings, the lags can.
    assert all(abs(r.predicted - r.actual) < 0.5 * r.actual for r in out if r.category == "flat")


def test_two_stage(spark):
    rows = [(float(i % 2), 0.0 if i % 2 == 0 else 10.0 + (i % 4)) for i in range(200)]
    df = spark.createDataFrame(rows, "x double, y double")
    out = models.two_stage(df, df.limit(50), ["x"]).collect()
    for r in out:
        if r.x:
            assert r.p_sale > 0.9 and r.predicted == pytest.approx(12, abs=1.2)
        else:
            assert r.p_sale < 0.1 and r.predicted == 0


def test_importance_sums_to_one_and_finds_the_cause(spark):
    rng = random.Random(4)
    df = spark.createDataFrame([(rng.random(), rng.random(), rng.random()) for _ in range(400)], "a double, b double, c double").withColumn("t", 5 * F.col("b") + 0.1 * F.col("a"))
    got = {r.column: r.importance for r in models.tree_importance(df, ["a", "b", "c"], "t").collect()}
    assert sum(got.values()) == pytest.approx(1) and got["b"] > 0.7


def pooled_violators(points):
    """Isotonic regression by hand: neighbours out of order are pooled until none is."""
    blocks = []
    for x, y in sorted(points):
        blocks.append([y, 1, [x]])
        while len(blocks) > 1 and blocks[-2][0] > blocks[-1][0]:
            b, a = blocks.pop(), blocks.pop()
            blocks.append([(a[0] * a[1] + b[0] * b[1]) / (a[1] + b[1]), a[1] + b[1], a[2] + b[2]])
    return {x: v for v, _, xs in blocks for x in xs}


def test_isotonic_as_by_pooled_violators(spark):
    rng = random.Random(6)
    points = [(float(i), i + 8 * rng.random()) for i in range(60)]
    train = spark.createDataFrame(points, "predicted double, actual double")
    got = {r.predicted: r.corrected for r in models.isotonic(train, train.select("predicted")).collect()}
    assert got == pytest.approx(pooled_violators(points))


@pytest.mark.parametrize("method", ["kmeans", "gaussian", "bisecting"])
def test_clusters_that_lie_apart_are_found(spark, method):
    keys = spark.createDataFrame([(f"k{i}", float(i % 2 * 100 + i % 5), float(i % 2 * 50 + i % 3)) for i in range(60)], "key string, a double, b double")
    out = segment.clustered(segment.scaled(keys, ["a", "b"]), method, [2]).select("key", "cluster").collect()
    side = {i: {r.cluster for r in out if int(r.key[1:]) % 2 == i} for i in (0, 1)}
    assert len(side[0]) == len(side[1]) == 1 and side[0] != side[1]


def test_new_keys_leave_the_scaler_alone(spark, tmp_path):
    manifest = spark.createDataFrame([(f"m{i}", "high" if i % 2 else "low", float(i % 2 * 10 + i % 3), 1.0) for i in range(40)], "key string, segment string, a double, b double")
    new = spark.createDataFrame([("n1", 0.5, 1.0), ("n2", 11.0, 1.0)], "key string, a double, b double")
    far = new.union(spark.createDataFrame([("n3", 1e9, 1.0)], new.schema))
    got = lambda df: {r.key: r.segment for r in segment.assign_new(manifest, df, ["a", "b"], 2).collect()}
    assert got(new) == {"n1": "low", "n2": "high"} and {k: v for k, v in got(far).items() if k != "n3"} == got(new)
    model, votes = segment.fit_assigner(manifest, ["a", "b"], 2)
    model.write().overwrite().save(str(tmp_path / "model"))
    back = type(model).load(str(tmp_path / "model"))
    assert {r.key: r.segment for r in segment.assign(back, votes, new, ["a", "b"], ["low"]).collect()} == {"n1": "low", "n2": "low"}


def test_exact_quantiles_by_brackets(spark, monkeypatch):
    monkeypatch.setattr(ranks, "FEW", 50)
    monkeypatch.setattr(ranks, "ACCURACY", 200)
    rng = random.Random(1)
    values = [rng.choice([7.0, rng.gauss(0, 100), float(rng.randrange(20))]) for _ in range(3000)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double").repartition(7)
    at = [0.0, 0.1, 0.333, 0.5, 0.9, 1.0]
    assert ranks.quantiles(df, "v", at) == pytest.approx([float(np.quantile(values, q)) for q in at])
    assert ranks.quantiles(df.where("v is null"), "v", [0.5]) == [None]


def test_first_by_score_takes_just_as_many_with_ties(spark, monkeypatch):
    monkeypatch.setattr(ranks, "FEW", 10)
    df = spark.createDataFrame([(f"k{i}", float(i % 4)) for i in range(200)], "key string, s double")
    for room in (0, 1, 50, 70, 199, 300):
        got = [r.s for r in ranks.first_by_score(df, "s", room).collect()]
        assert sorted(got) == sorted((float(i % 4) for i in range(200)), reverse=True)[:room][::-1]


def test_ranks_within_groups(spark, monkeypatch):
    monkeypatch.setattr(ranks, "RANGES", 4)
    rng = random.Random(3)
    rows = [(g, float(rng.randrange(12))) for g in "ab" for _ in range(100)] + [("a", None), ("c", None)]
    found = ranks.ranks(spark.createDataFrame(rows, "g string, v double"), "g", "v")
    for g in "ab":
        own = [v for h, v in rows if h == g and v is not None]
        for r in found.where(F.col("g") == g).collect():
            assert (r.n, r.below, r.dense, r.total, r.n_values) == (own.count(r.v), sum(v < r.v for v in own), sorted(set(own)).index(r.v) + 1, 100, len(set(own)))
    medians = {r.g: r["median"] for r in ranks.group_medians(found, "g", "v").collect()}
    assert medians == {g: float(np.median([v for h, v in rows if h == g and v is not None])) for g in "ab"}


def test_weights_follow_the_volume_and_the_guardrail(spark):
    """Where the parts are right they get the weight, where the benchmark is, it does; below the least volume it does everywhere."""
    rows = []
    for i in range(6):
        for week in range(4):
            rows.append((f"p{i}", week, "A", "good", 200.0 + 20 * i, 200.0 + 20 * i, 1.5 * (200 + 20 * i), 200.0 + 20 * i))
            rows.append((f"p{i}", week, "A", "best", (150.0 + 20 * i) / 2, (150.0 + 20 * i) / 2, 150.0 + 20 * i, 150.0 + 20 * i))
    df = spark.createDataFrame(rows, "key string, week int, category string, segment string, s double, c double, rf double, actual double")
    by = ["category", "segment"]
    fit = combine.fit_asymmetric(df, by, fine=0.0625)
    w = {r.segment: r.weights for r in combine.guardrail(df, fit, by).collect()}
    assert w["good"][0] + w["good"][1] > 0.5 and w["best"][2] > 0.5
    volumes = df.groupBy(*by).agg(F.sum("actual").alias("volume"))
    category = combine.fit_asymmetric(df, ["category"], fine=0.25)
    assert all(r.weights == [0, 0, 1] for r in combine.shrink(fit, category, volumes, least=1e9).collect())
    # A margin that the fit can't reach leaves the benchmark.
    assert all(r.weights == [0, 0, 1] for r in combine.guardrail(df, fit, by, margin=2.0).collect())


def test_alpha_is_chosen_by_snapshots_left_out(spark):
    rows = [(f"s{t % 3}", g, float(x), float(2 * x), float(x), float(x) * (1.0 if g == "A" else 1.0)) for t in range(9) for g in "AB" for x in (3, 5, 9)]
    df = spark.createDataFrame(rows, "snapshot string, category string, s double, c double, rf double, actual double")
    got = {r.alpha: r.wape for r in combine.choose_alpha(df, [[], ["category"]], combine.cube(1.0, 0.5, 3), [0.0, 1.0], "snapshot").collect()}
    assert got == {0.0: 0.0, 1.0: 0.0}


def test_blends_of_two_with_bias_modes(spark):
    """Against a fine grid of weights."""
    rng = random.Random(7)
    rows = [(g, t, rng.uniform(5, 30), rng.uniform(5, 30), rng.uniform(5, 30)) for g in "abc" for t in range(12)] + [("few", 1, 1.0, 2.0, 3.0), ("same", 1, 2.0, 2.0, 3.0), ("same", 2, 2.0, 2.0, 3.0), ("same", 3, 2.0, 2.0, 3.0)]
    df = spark.createDataFrame(rows, "g string, week_idx int, f1 double, f2 double, actual double")

    def measured(g, w, first):
        own = [r for r in rows if r[0] == g and r[1] < first]
        total, e = sum(r[4] for r in own), [w * r[2] + (1 - w) * r[3] - r[4] for r in own]
        return sum(map(abs, e)) / total, abs(sum(e)) / total

    for mode, worth in (("none", lambda p, b: p), ("soft", lambda p, b: p + b), ("dominant", lambda p, b: 1000 * round(b, 3) + p), ("hard", lambda p, b: p if b <= 0.05 + 1e-6 else 10 + b)):
        for periods in (None, 5):
            first = 99 if periods is None else periods
            out = {r.g: r for r in combine.two_forecasts_with_bias(df, ["g"], mode, tolerance=0.05 if mode == "hard" else 0.0, first_periods=periods).collect()}
            assert out["few"].status == "fallback:n_obs<3" and out["same"].status == "fallback:equal" and out["same"].w1 == 0.5
            for g in "abc":
                grid = min(worth(*measured(g, i / 2000, first)) for i in range(2001))
                assert worth(*measured(g, out[g].w1, first)) <= grid + 2e-3


def test_lags_beyond_the_cap_go_by_strength(spark):
    strength = [(i, F.lit(float(i))) for i in range(2, 20)]
    got = spark.range(1).select(profile.chosen_lags(strength, (1, 4, 52), 6).alias("lags")).first().lags
    assert got == [1, 4, 17, 18, 19, 52]
