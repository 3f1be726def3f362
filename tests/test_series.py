"""Scans and order statistics along a series, and what rests on them, against plain versions."""

import math
import random
import time

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from demandloom.operators import correct, evaluate, forecast, models, orders, profile, windows

SCHEMA = "key string, week_idx int, y double"


def panel(spark, series):
    return spark.createDataFrame([(k, 10 + i, y) for k, ys in series.items() for i, y in enumerate(ys)], SCHEMA).repartition(3)


def values(df, *names):
    """Columns by key, in order of time."""
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.key, r.week_idx)):
        out.setdefault(r.key, []).append(tuple(r[n] for n in names))
    return out


@pytest.mark.parametrize("adjust", [True, False])
@pytest.mark.parametrize("span", [1, 4, 30])
def test_weighted_mean_and_deviation_as_by_recurrence(spark, adjust, span):
    """Also for a series of a high level, one value and, with adjust, nulls."""
    rng = random.Random(3)
    series = {"a": [rng.gauss(5, 2) for _ in range(300)], "high": [1e7 + rng.random() for _ in range(200)], "one": [3.0], "same": [4.0] * 30}
    if adjust:
        series["gaps"] = [None if i % 3 == 1 or i < 2 else float(i % 7) for i in range(90)]
    got = values(windows.ewm(panel(spark, series), [span], adjust=adjust), f"ewm_{span}", f"ewm_std_{span}")
    for k, ys in series.items():
        moving = pd.Series(ys, dtype=float).shift(1).ewm(span=span, adjust=adjust)
        for (m, s), wm, ws in zip(got[k], moving.mean(), moving.std(), strict=True):
            assert (m is None and math.isnan(wm)) or m == pytest.approx(wm, rel=1e-9)
            assert (s is None and math.isnan(ws)) or s == pytest.approx(ws, rel=1e-5, abs=1e-6)


def test_scan_of_a_long_series_cuts_nothing(spark):
    """A million rows of one key, and a decay so slow that the first row still counts at the end."""
    n, q = 1_000_000, 1 - 1e-6
    df = spark.range(n).select(F.lit("k").alias("key"), F.col("id").cast("int").alias("week_idx"), (F.when(F.col("id") == 0, 1e6).otherwise(0.0)).alias("y"), (F.col("id") % 10).cast("double").alias("x"))
    last = orders.decayed_sums(df, {"a": (F.col("y"), q), "b": (F.col("x"), 0.5)}).where(f"week_idx = {n - 1}").first()
    assert last.a == pytest.approx(1e6 * q ** (n - 1), rel=1e-9)
    assert last.b == pytest.approx(sum((9 - i) % 10 * 0.5**i for i in range(60)))


def test_moving_quantiles_as_by_sorting(spark):
    rng = random.Random(1)
    series = {"a": [rng.choice([None, 1.0, 2.0, 2.0, -3.5, 7.25]) for _ in range(200)], "b": [float(i) for i in range(40)], "none": [None] * 5}
    frames = {"q1": ("y", -13, -1, 0.25), "med": ("y", None, -1, 0.5), "q9": ("y", -3, 2, 0.9), "max": ("y", None, 0, 1.0)}
    got = values(orders.moving_quantiles(panel(spark, series), frames), *frames)
    for k, ys in series.items():
        for i, row in enumerate(got[k]):
            for x, (_, first, last, share) in zip(row, frames.values(), strict=True):
                seen = [v for v in ys[0 if first is None else max(0, i + first) : max(0, i + last + 1)] if v is not None]
                assert x == (pytest.approx(np.quantile(seen, share)) if seen else None)


def test_time_of_growing_medians():
    """Ten times the rows take no more than a bit over ten times as long: no frame is sorted anew."""
    took = []
    for n in (20_000, 200_000):
        y = np.random.default_rng(2).normal(size=n)
        began = time.process_time()
        q, some = orders.moving_quantile(y, np.ones(n, bool), None, -1, 0.5)
        took.append(time.process_time() - began)
        assert q[-1] == pytest.approx(np.median(y[:-1])) and not some[0]
    assert took[1] < 40 * took[0] + 0.5


def test_seasonality_of_known_waves(spark):
    weeks = range(208)
    series = {"year": [10 + 5 * math.sin(2 * math.pi * w / 52) for w in weeks], "flat": [3.0] * 208, "short": [1.0, 2.0] * 8, "noise": [random.Random(w).random() for w in weeks]}
    out = {}
    for r in profile.seasonality(panel(spark, series)).collect():
        out.setdefault(r.key, []).append(r)
    assert sorted((r.rank, r.period) for r in out["year"])[0] == (1, 52.0) and out["year"][0].dominant == 52 and out["year"][0].seasonal and out["year"][0].strength > 0.9
    assert [(r.rank, r.seasonal, r.strength) for r in out["short"]] == [(None, False, 0.0)]
    assert not out["noise"][0].seasonal and not out["flat"][0].seasonal
    # A frequency's share is of the power of all of them.
    y = np.array(series["noise"])
    power = np.abs(np.fft.rfft(y - y.mean())[:104]) ** 2
    assert max(r.share for r in out["noise"]) == pytest.approx(power.max() / power.sum(), abs=1e-4)


def test_states_as_fitted_anew_at_each_row(spark):
    """Croston, its variant and TSB of every prefix, for keys with and without demand."""
    rng = random.Random(6)
    series = {"a": [float(rng.choice([0, 0, 0, 2, 5])) for _ in range(60)], "zero": [0.0] * 10, "full": [float(i % 4 + 1) for i in range(30)], "one": [2.0]}
    df = panel(spark, series)
    got = values(evaluate.demand_states(df).withColumnRenamed("time", "week_idx"), "croston", "sba", "tsb", "last", "total", "n")
    for at in (0, 3, 9, 29, 59):
        upto = df.where(f"week_idx <= {10 + at}")
        c = {r.key: r for r in forecast.croston(upto).collect()}
        t = {r.key: r.tsb for r in forecast.tsb(upto).collect()}
        for k, ys in series.items():
            if at < len(ys):
                assert got[k][at] == pytest.approx((c[k].croston, c[k].sba, t[k], ys[at], sum(ys[: at + 1]), at + 1))


def test_backtest_as_refitted(spark):
    """Keys whose periods have gaps, that begin late or end early."""
    rows = [("a", w, float(w % 5)) for w in range(100, 160)] + [("gap", w, 3.0) for w in (101, 120, 139, 151)] + [("late", w, 4.0) for w in range(146, 160)] + [("gone", w, 1.0) for w in range(100, 120)]
    df = spark.createDataFrame(rows, SCHEMA)
    cutoffs = evaluate.origins(df, 140, 150, 5)
    known = {(r.key, r.cutoff): r for r in evaluate.as_of(df, cutoffs).collect()}
    for c in range(140, 151):
        near = {k: [y for kk, w, y in rows if kk == k and c - 13 < w <= c] for k in ("a", "gap", "late", "gone")}
        flat = {r.key: r.croston for r in forecast.croston(df.where(f"week_idx <= {c}")).collect()} if c in (140, 147) else {}
        for k, ys in near.items():
            assert ((k, c) in known) == bool(ys)
            if ys:
                assert known[k, c].mean == pytest.approx(np.mean(ys)) and known[k, c].last == ys[-1]
                assert k not in flat or known[k, c].croston == pytest.approx(flat[k])
    scored = evaluate.rolling_backtest(df, cutoffs, 5).where("cutoff = 150 and h = 1").first()
    assert scored.n == 3 and scored.wape_last == pytest.approx((abs(0 - 1) + 0 + 0) / (1 + 3 + 4))


def test_forecasts_of_several_origins_as_of_each(spark):
    rng = random.Random(8)
    rows = [(f"k{k}", w, float(5 + 3 * (w % 4) + k + rng.randrange(3)), 1.0) for k in range(4) for w in range(100, 190)]
    df = spark.createDataFrame(rows, "key string, week_idx int, y double, price double")
    got = {(r.cutoff, r.key, r.h): r.predicted for r in models.origin_forecasts(df, [170, 180], 2, [1, 2], 2).collect()}
    assert len(got) == 16
    # What comes after an origin changes nothing for it.
    spoiled = df.withColumn("y", F.when(F.col("week_idx") > 170, 0.0).otherwise(F.col("y")))
    again = {(r.cutoff, r.key, r.h): r.predicted for r in models.origin_forecasts(spoiled, [170], 2, [1, 2], 2).collect()}
    alone = {(170, r.key, r.h): r.predicted for r in models.pooled_forecast(df, 170, 2, [1, 2], 2).collect()}
    assert set(again) == {k for k in got if k[0] == 170} == set(alone)
    assert again == pytest.approx(alone)
    assert all(abs(got[k] - alone[k]) < 3 for k in alone)  # bins' edges come of the later rows, too


def test_order_multiples_by_the_relative_rule(spark):
    """3.05 is three within 2 %, 1.03 is not one; a key without history, and one of history nought, are rounded at half."""
    near = lambda m, r: [m] * 18 + [m * r] * 22
    series = {"three": near(60.0, 3.05), "one": near(60.0, 1.03), "low": near(40.0, 2.0), "few": [60.0] * 30}
    got = {r.key: r.multiple for r in correct.order_multiple(panel(spark, series)).collect()}
    assert got == {"three": 60.0, "one": pytest.approx(61.8), "low": 80.0}  # the second and third by their medians
    fc = spark.createDataFrame([("new", 1, 130.0), ("new", 2, 160.0), ("nought", 1, 90.5), ("nought", 2, -5.0), ("plain", 1, 77.0)], "key string, week_idx int, predicted double")
    multiples = spark.createDataFrame([("new", 60.0), ("nought", 60.0)], "key string, multiple double")
    targets = spark.createDataFrame([("nought", 0.0), ("plain", 5.0)], "key string, target double")
    out = {(r.key, r.week_idx): r.rounded for r in correct.moq_round(fc, multiples, targets).collect()}
    assert out == {("new", 1): 120.0, ("new", 2): 180.0, ("nought", 1): 120.0, ("nought", 2): 0.0, ("plain", 1): 77.0}


def test_only_the_first_53_forecasts_choose_the_threshold(spark):
    fc = spark.createDataFrame([("k", i, 80.0 if i < 53 else 115.0) for i in range(106)], "key string, week_idx int, predicted double")
    multiples, targets = spark.createDataFrame([("k", 60.0)], "key string, multiple double"), spark.createDataFrame([("k", 120.0)], "key string, target double")
    got = {r.week_idx: r.rounded for r in correct.moq_round(fc, multiples, targets).collect()}
    assert got[0] == 120.0 and got[100] == 120.0  # 80 lies a third over 60: thresholds of .30 and less take it up
    assert {r.rounded for r in correct.moq_round(fc, multiples, targets, first=None).collect()} == {120.0}


def test_constant_series_have_no_correlation(spark):
    """Neither keys of one value nor constant columns end a query."""
    series = {"flat": [3.0] * 60, "rising": [float(i) for i in range(60)], "waves": [float(i % 4) for i in range(60)]}
    got = {r.key: r.acf_4 for r in profile.autocorrelations(panel(spark, series), [1, 4]).collect()}
    assert got["flat"] is None and got["rising"] == pytest.approx(1) and got["waves"] == pytest.approx(1)
    df = spark.createDataFrame([("a", 1.0, 7.0), ("a", 2.0, 7.0), ("b", 2.0, 7.0)], "key string, actual double, predicted double")
    r = evaluate.prediction_leakage(df).first()
    assert r["corr"] is None and not r.suspected and r.constant_keys == 1 and r.n_keys == 2


def test_copied_predictions_are_suspected(spark):
    df = spark.createDataFrame([(f"k{i % 3}", float(i), 1.001 * i) for i in range(1, 40)], "key string, actual double, predicted double")
    r = evaluate.prediction_leakage(df).first()
    assert r.too_good and r.too_alike and r.suspected and not r.constant
    # Ten rows are too few to judge by their errors.
    assert evaluate.prediction_leakage(df.limit(10)).first().wape is None


def test_strengths_of_known_components(spark):
    """A line with a season has both, as factors too; noise has no trend (of factors the rule compares a ratio's variance with a level's)."""
    rng = random.Random(4)
    series = {"both": [100 + i + 20 * math.sin(2 * math.pi * i / 12) + rng.random() for i in range(120)], "noise": [50 + rng.gauss(0, 10) for _ in range(120)]}
    for ratio in (False, True):
        parts = (profile.decompose_by_ratio if ratio else profile.decompose)(panel(spark, series), 12)
        got = {r.key: r for r in profile.component_strengths(parts).collect()}
        assert got["both"].seasonal_strength > 0.9 and got["both"].trend_strength > 0.9 and (ratio or got["noise"].trend_strength < 0.5)


def test_direction_and_acceleration(spark):
    series = {"late": [10.0] * 40 + [10.0 + 2 * i for i in range(13)], "short": [1.0, 2.0, 3.0], "flat": [5.0] * 30}
    got = {r.key: r for r in profile.trend_direction(panel(spark, series), 1000).collect()}
    assert got["late"].acceleration > 0 and got["late"].recent_long == pytest.approx(22 / 10) and got["late"].direction == "up"
    assert got["flat"].acceleration == 0 and got["flat"].direction == "flat" and got["flat"].recent_long == 1
    assert got["short"].acceleration == 0 and got["short"].recent_long == 1


def test_undefined_correlations_count_as_asked(spark):
    """A constant column has no strength, or, as in SQL, that of NaN, which is over every limit."""
    rows = panel(spark, {"k": [float(i * i % 7) for i in range(20)]}).withColumn("price", F.col("y") + F.col("week_idx") % 3).withColumn("promo", F.lit(1))
    r = profile.response_profile(rows, ["price", "promo"]).first()
    assert r.corr_promo is None and r.mean_strength == pytest.approx(r.corr_price / 2) and r.max_strength == pytest.approx(r.corr_price) and r.n_strong == 1
    r = profile.response_profile(rows, ["price", "promo"], constant=math.nan).first()
    assert math.isnan(r.corr_promo) and math.isnan(r.mean_strength) and math.isnan(r.max_strength) and r.n_strong == 2 and 0.2 < r.corr_price <= 1
    assert [profile.characteristics(rows, ["price", "promo"], c).first().n_related for c in (None, math.nan)] == [1, 2]
    # Too few rows are no constant.
    r = profile.response_profile(rows, ["price", "promo"], least=21, constant=math.nan).first()
    assert r.corr_promo is None and r.mean_strength == 0 and r.n_strong == 0


def test_halves_of_periods_go_to_the_even_digit(spark):
    """Periods of 357 / 20 and 357 / 140 rows are 17.8 and 2.6, as for SQL's round_even, and flat series have the first frequencies."""
    for k, period in ((20, 17.8), (140, 2.6)):
        out = profile.spectral(np.cos(2 * np.pi * k * np.arange(357) / 357), 104, 3, 0.1, 0.05)
        assert out["periods"][0] == {"period": period, "share": 1.0} and out["dominant"] == round(period)
    assert [p["period"] for p in profile.spectral(np.full(357, 5.0), 104, 3, 0.1, 0.05)["periods"]] == [89.2, 71.4]


def test_parts_at_the_threshold_stay_below_it(spark):
    """10,314 is 54 over a multiple of 60, exactly nine tenths: in units it isn't over the threshold of .90, as a share it is by a last digit."""
    df = spark.createDataFrame([(10314.0,), (10314.000001,), (-3.0,)], "v double")
    got = [[r.r for r in df.select(correct.round_to_multiple(F.col("v"), F.lit(60.0), F.lit(0.9), u).alias("r")).collect()] for u in (True, False)]
    assert got == [[10260.0, 10320.0, 0.0], [10320.0, 10320.0, 0.0]]
    fc = spark.createDataFrame([("k", 1, 10314.0)], "key string, week_idx int, predicted double")
    tables = spark.createDataFrame([("k", 60.0)], "key string, multiple double"), spark.createDataFrame([("k", 10262.0)], "key string, target double")
    assert [correct.moq_round(fc, *tables, in_units=u).first().rounded for u in (True, False)] == [10260.0, 10320.0]


@pytest.mark.parametrize("grid", [False, True])
def test_imapa_over_demands_alone(spark, grid):
    """As Croston on each level's blocks of the whole series, zeros included; with grid the zeros, and the periods before and after a key's rows, need no rows."""
    rng = random.Random(7)
    series = {"a": [float(y) for y in (0, 0, 3, 0, 0, 5, 1, 0, 0, 0, 4, 0, 0)], "never": [0.0] * 13, "first": [2.0] + [0.0] * 12, "rest": [0.0] * 12 + [9.0], **{f"r{i}": [float(rng.choice([0, 0, 0, 1, 7])) for _ in range(13)] for i in range(5)}}
    levels, alpha = [1, 2, 4], 0.1

    def plain(y):
        above = below = 0.0
        for n in levels:
            blocks, size, interval, gap = [sum(y[i * n : i * n + n]) for i in range(len(y) // n)], None, None, 0
            for x in blocks:
                gap += 1
                if x > 0:
                    size, interval, gap = (x, gap, 0) if size is None else (size + alpha * (x - size), interval + alpha * (gap - interval), 0)
            w = sum(x > 0 for x in blocks) / len(blocks)
            above, below = above + (size / interval if size else 0) / n * w, below + w
        return above / below if below else 0.0

    df = panel(spark, series)
    df = df.where("y <> 0 or key = 'never' and week_idx in (10, 22)") if grid else df
    assert {r.key: r.imapa for r in forecast.imapa(df, levels, alpha, grid=grid).collect()} == pytest.approx({k: plain(y) for k, y in series.items()})
    assert {r.key: r.imapa for r in forecast.imapa(df, levels, alpha, sba=True, grid=grid).collect()} == pytest.approx({k: plain(y) * 0.95 for k, y in series.items()})


def test_moving_quantiles_over_batches_of_keys(spark):
    """Keys that share a batch, or go over several, are kept apart; one Python worker's call serves many keys."""
    rng = random.Random(3)
    series = {f"k{i:03}": [rng.choice([None, 1.0, 2.0, rng.random()]) for _ in range(rng.choice([1, 2, 9, 40]))] for i in range(60)}
    plain = {k: [None if not (f := [v for v in ys[max(0, i - 4) : i] if v is not None]) else float(np.quantile(f, 0.5)) for i in range(len(ys))] for k, ys in series.items()}
    try:
        for rows in (1, 7, 10000):
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)
            got = values(orders.moving_quantiles(panel(spark, series), {"q": ("y", -4, -1, 0.5)}), "q")
            assert {k: [v for (v,) in vs] for k, vs in got.items()} == {k: pytest.approx(vs) if None not in vs else [v if v is None else pytest.approx(v) for v in vs] for k, vs in plain.items()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_levels_of_demand_without_a_window(spark):
    out = profile.discrete_demand(panel(spark, {"packs": [6.0, 0.0, 12.0, 6.0, 18.0, 7.5], "none": [0.0, 0.0]}))
    assert [tuple(r) for r in out.collect()] == [("packs", 4, 6.0, 0.8, False)] and "Window" not in out._jdf.queryExecution().optimizedPlan().toString()
