"""Hand-computed cases and invariants of single operators."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from demandloom.functions import periods
from demandloom.operators import combine, correct, evaluate, forecast, impute, joins, panel, profile, windows


def frame(spark, values, key="a", start=0):
    return spark.createDataFrame([(key, start + i, float(v)) for i, v in enumerate(values)], "key string, week_idx int, y double")


def column(df, name, order="week_idx"):
    return [r[name] for r in df.orderBy(order).collect()]


def test_weeks_agree_with_the_calendar(spark):
    days = [dt.date(2015, 1, 1) + dt.timedelta(days=7 * i) for i in range(700)]
    rows = spark.createDataFrame([(d, d.isocalendar()[0] * 100 + d.isocalendar()[1], d - dt.timedelta(days=d.weekday())) for d in days], "d date, w int, m date")
    out = rows.select("w", "m", periods.year_week("d").alias("w2"), periods.monday("w").alias("m2"), periods.add_weeks("w", 9).alias("a"), periods.from_index(periods.week_index("m")).alias("w3"))
    for r in out.collect():
        after = (r.m + dt.timedelta(days=63)).isocalendar()
        assert (r.w2, r.m2, r.a, r.w3) == (r.w, r.m, after[0] * 100 + after[1], r.w)


def test_period_texts_and_years(spark):
    rows = spark.createDataFrame([("2025-9",), ("202509",), ("2025/10",), ("x",), (None,)], "t string")
    assert [r.n for r in rows.select(periods.normalise("t").alias("n")).collect()] == ["2025-09", "202509", "2025-10", None, None]
    w = spark.createDataFrame([(202053,), (202101,)], "w int")
    got = w.select(periods.last_year("w").alias("a"), periods.last_year("w", True).alias("b"), periods.add_periods("w", -1).alias("c"), periods.forecast_step(F.lit(202101), "w").alias("d")).collect()
    assert [tuple(r) for r in got] == [(201953, 201952, 202052, 2), (202001, 202001, 202052, 1)]
    known = {1997: (3, 30), 2000: (4, 23), 2008: (3, 23), 2024: (3, 31), 2026: (4, 5), 2038: (4, 25)}
    got = spark.createDataFrame([(y,) for y in known], "y int").select("y", periods.easter("y").alias("e")).collect()
    assert {r.y: (r.e.month, r.e.day) for r in got} == known


@pytest.mark.parametrize("build", [
    lambda d: windows.lag_features(d, [1, 2]), lambda d: windows.rolling(d, [3], ["mean", "std", "median"]), lambda d: windows.ewm(d, [3]), lambda d: windows.expanding(d, ["mean", "sum"]),
    lambda d: windows.intermittency(d), lambda d: windows.sparsity(d), lambda d: windows.regime(d), lambda d: windows.momentum(d, [2]), lambda d: windows.rolling_volatility(d, [4]),
])
def test_features_do_not_look_ahead_and_keep_rows(spark, build):
    base = [3, 0, 5, 8, 0, 0, 2, 9, 4, 7, 0, 1]
    a, b = build(frame(spark, base)), build(frame(spark, base[:8] + [99, 98, 97, 96]))
    features = [c for c in a.columns if c not in ("key", "week_idx", "y")]
    left, right = (x.orderBy("week_idx").select(*features).collect() for x in (a, b))
    assert len(left) == len(base) and left[:9] == right[:9]


def test_croston_by_hand(spark):
    r = forecast.croston(frame(spark, [0, 4, 0, 0, 6]), alpha=0.5).first()
    assert r.croston == pytest.approx(5 / 2.5) and r.sba == pytest.approx(5 / 2.5 * 0.75)
    assert forecast.croston(frame(spark, [0, 0])).first().croston == 0
    assert forecast.tsb(frame(spark, [0, 4]), 0.5, 0.5).first().tsb == pytest.approx(4 * 0.625)


def test_promo_lift_is_neutral_then_two(spark):
    rows = spark.createDataFrame([("k", i, 200.0 if i % 3 == 0 else 100.0, int(i % 3 == 0)) for i in range(40)], "key string, week_idx int, y double, promo int")
    out = windows.promo_lift(rows, ["promo"])
    assert column(out, "promo_lift")[0] == 1.0 and column(out, "promo_history")[0] == 0
    assert column(out, "promo_lift")[-1] == pytest.approx(2.0)


def test_blend_cases(spark):
    rows = []
    for i in range(6):
        for w in range(202605, 202609):
            t = 200.0 + 20 * i
            rows.append((f"g{i}_acc", w, t, t, 1.5 * t, t, "A", "good"))
            t = 150.0 + 20 * i
            rows.append((f"b{i}_acc", w, t / 2, t / 2, t, t, "A", "best"))
    df = spark.createDataFrame(rows, "key string, week_idx int, s double, c double, rf double, actual double, category string, segment string")
    fit = {r.segment: r for r in combine.fit_asymmetric(df, ["segment"]).collect()}
    assert fit["good"].weights[0] + fit["good"].weights[1] > 0.5 and fit["good"].loss == 0 and fit["best"].loss < 1e-6
    w = spark.createDataFrame([("A", "good", 1.0, 0.0, 0.0)], "category string, segment string, w_s double, w_c double, w_rf double")
    small = spark.createDataFrame([("A", "good", 10.0, 1.0, 2.0), ("A", "x", 1.0, 2.0, 20.0), ("B", "good", 1.0, 1.0, 8.0)], "category string, segment string, s double, c double, rf double")
    assert sorted(r.blend for r in combine.blend_apply(small, w).collect()) == [8, 10, 20]


def test_two_forecast_blend(spark):
    rows = [("a", 10.0, 10.0, 5.0), ("a", 20.0, 20.0, 9.0), ("a", 30.0, 30.0, 1.0)] + [("b", 10.0 * i, 10.0 * i + 2, 10.0 * i - 2) for i in range(1, 5)] + [("c", 1.0, 1.0, 2.0)]
    out = {r.g: (r.w1, r.status) for r in combine.two_forecasts(spark.createDataFrame(rows, "g string, actual double, f1 double, f2 double"), ["g"]).collect()}
    assert out == {"a": (1.0, "ok"), "b": (0.5, "ok"), "c": (0.5, "fallback:n_obs<3")}


def test_order_multiples(spark):
    rng = [0, 60, 120, 60, 60, 180, 60, 0, 60, 120]
    rows = frame(spark, rng * 6, "moq").unionByName(frame(spark, [50 + 37 * i % 451 for i in range(100)], "smooth")).unionByName(frame(spark, [60] * 20, "few"))
    assert [(r.key, r.multiple) for r in correct.order_multiple(rows).collect()] == [("moq", 60.0)]
    one = spark.createDataFrame([(130.0,), (160.0,), (180.0,)], "v double").select(correct.round_to_multiple(F.col("v"), F.lit(60.0), F.lit(0.5)).alias("r"))
    assert [r.r for r in one.collect()] == [120, 180, 180]


def test_self_score_and_coherence(spark):
    rows = spark.createDataFrame([("a", 1, 5.0), ("a", 2, 0.0), ("b", 1, 7.0)], "key string, week_idx int, actual double").withColumn("predicted", F.col("actual"))
    r = evaluate.metrics_by(rows, []).first()
    assert r.wape == r.mae == r.rmse == r.bias == 0 and r.tier == "excellent"
    keys = rows.withColumn("category", F.lit("c"))
    groups = keys.groupBy("week_idx", "category").agg((F.sum("predicted") * 1.3).alias("predicted"))
    totals = keys.groupBy("week_idx").agg((F.sum("predicted") * 0.9).alias("predicted"))
    fixed = correct.reconcile(keys, groups, totals)
    up = correct.bottom_up(fixed.withColumnRenamed("reconciled", "predicted"))
    per = {(r.level, r.week_idx): r.s for r in up.groupBy("level", "week_idx").agg(F.sum("predicted").alias("s")).collect()}
    assert per["key", 1] == pytest.approx(per["total", 1]) and per["group", 2] == pytest.approx(per["total", 2])


def test_cleaning_cases(spark):
    rows = spark.createDataFrame([("b_x_1", 1, None, 0.0), ("b_x_1", 3, 5.0, 2.0)], "key string, week_idx int, y double, z double")
    assert [(r["product"], r.account) for r in panel.split_key(rows).collect()] == [("b_x", "1")] * 2
    grid = panel.dense_grid(rows, 1)
    assert [(r.week_idx, r.y) for r in grid.orderBy("week_idx").collect()] == [(1, 0.0), (2, 0.0), (3, 5.0), (4, None)]
    assert panel.dead_columns(rows.withColumn("c", F.lit(1)), ["y", "z", "c"], ("y",)) == ["c"]
    assert panel.forecast_table(rows).columns[:3] == ["key", "year_week", "predicted"]
    pairs = joins.horizon_pairs(rows.select("key", "week_idx"), rows.select("key", "week_idx", "y"), 2)
    assert [(r.week_idx, r.h, r.y) for r in pairs.collect()] == [(1, 2, 5.0)]


def test_profiles_and_imputation(spark):
    rows = frame(spark, [0, 4, 0, 4, 0, 0, 0], "k").unionByName(frame(spark, [1] * 7, "s"))
    got = {r.key: r for r in profile.series_statistics(rows).collect()}
    assert got["k"].adi == 2 and got["s"].adi == 1 and got["s"].zero_fraction == 0
    assert [r.key for r in profile.dead_keys(rows, 6, 3).collect()] == ["k"]
    flags = impute.missing_periods(frame(spark, [0, 0, 3]), ["y"])
    assert sorted(r.week_idx for r in flags.collect()) == [0, 1]
