"""Order statistics of groups against sorting, with one group that holds most values, ties, wide ranges and odd values."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from demandloom.operators import correct, profile, ranks, selection


def made():
    rng = random.Random(5)
    rows = [("hot", rng.choice([rng.gauss(0, 1), 7.0, -1e300, 1e300, 10.0 ** rng.randrange(-20, 20)])) for _ in range(3000)]
    rows += [("ties", 2.5)] * 400 + [("few", float(i)) for i in range(3)] + [(None, float(i % 10)) for i in range(50)]
    return rows + [("hot", None), ("hot", float("nan")), ("few", float("inf")), ("empty", None)]


@pytest.mark.parametrize("most", [10, 100_000])
@pytest.mark.parametrize("groups", [0, 10_000])
def test_quantiles_as_by_sorting(spark, monkeypatch, most, groups):
    """By sorting groups and by narrowing brackets, with the brackets held and as a table."""
    monkeypatch.setattr(ranks, "FEW", most)
    monkeypatch.setattr(selection, "GROUPS", groups)
    rows, at = made(), {"a": 0.0, "b": 0.1, "c": 0.5, "d": 0.999, "e": 1.0}
    got = {r.g: r for r in selection.group_quantiles(spark.createDataFrame(rows, "g string, v double").repartition(4), ["g"], "v", at).collect()}
    assert set(got) == {"hot", "ties", "few", None}
    for g, r in got.items():
        own = sorted(v for k, v in rows if k == g and v is not None and np.isfinite(v))
        assert r.n == len(own)
        for name, q in at.items():
            i = q * (len(own) - 1)
            lo, hi = own[int(np.floor(i))], own[int(np.ceil(i))]
            assert r[name] == pytest.approx(lo if lo == hi else lo * (np.ceil(i) - i) + hi * (i - np.floor(i)), rel=1e-9)


def test_one_group_of_many_values(spark):
    """More values than a task may order: a few rounds over one table."""
    df = spark.range(400_000).select(F.lit("g").alias("g"), ((F.col("id") * 7919) % 400_000).cast("double").alias("v"))
    r = selection.group_quantiles(df, ["g"], "v", {"q": 0.25, "m": 0.5}).first()
    assert (r.n, r.q, r.m) == (400_000, 99999.75, 199999.5)


def test_no_rows(spark):
    assert selection.group_quantiles(spark.createDataFrame([], "g string, v double"), ["g"], "v", {"m": 0.5}).count() == 0


def test_what_rests_on_it(spark, monkeypatch):
    """Distribution, outliers and intervals are the same by either way."""
    rng = random.Random(1)
    df = spark.createDataFrame([(f"g{i % 2}", float(rng.randrange(40)), float(i % 9), float(i % 7)) for i in range(500)], "g string, y double, actual double, predicted double")

    def all_of():
        d = sorted(tuple(r) for r in profile.distribution(df, ["g"], "y").collect())
        o = sorted((r.g, r.y, r.lo, r.hi, r.outlier) for m in ("mad", "iqr") for r in profile.group_outliers(df, "g", m, 1.5).collect())
        c = sorted((r.g, r.predicted, r.lower, r.upper) for m in ("absolute", "signed", "normalised") for r in correct.conformal(df, df, "g", 0.9, m).collect())
        return d, o, c

    sorted_way = all_of()
    monkeypatch.setattr(ranks, "FEW", 10)
    for a, b in zip(sorted_way, all_of(), strict=True):
        assert len(a) == len(b) and all(x == pytest.approx(y) for x, y in zip([v for r in a for v in r], [v for r in b for v in r], strict=True) if not isinstance(x, str))
