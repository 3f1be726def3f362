"""Operators at sizes and weights that an earlier bound left out."""

import pytest
from pyspark.sql import functions as F

from demandloom.operators import combine, correct
from demandloom.plans import panels


def test_snap_to_any_number_of_levels(spark):
    hist = spark.range(1500).select(F.lit("many").alias("key"), (F.col("id") * 2.0).alias("y")).union(spark.createDataFrame([("few", 1.0), ("few", 4.0), ("few", None)], "key string, y double"))
    rows = [("many", 1, 1000.6), ("many", 2, 2001.0), ("many", 3, 9999.0), ("many", 4, -5.0), ("few", 1, 2.5), ("few", 2, 4.0), ("none", 1, 7.5)]
    out = correct.snap_to_levels(spark.createDataFrame(rows, "key string, week_idx int, predicted double"), hist)
    assert out.columns == ["key", "week_idx", "predicted", "snapped"]
    assert {(r.key, r.week_idx): r.snapped for r in out.collect()} == {("many", 1): 1000.0, ("many", 2): 2000.0, ("many", 3): 2998.0, ("many", 4): 0.0, ("few", 1): 1.0, ("few", 2): 4.0, ("none", 1): 7.5}


def test_weights_up_to_three_and_between_the_steps(spark):
    rows = [(g, s, c, r, w[0] * s + w[1] * c + w[2] * r) for g, w in (("low", (2.5, 0.0, 0.0)), ("between", (0.0, 0.3125, 0.0))) for s, c, r in ((10.0, 3.0, 1.0), (2.0, 20.0, 5.0), (7.0, 1.0, 30.0), (4.0, 9.0, 2.0))]
    df = spark.createDataFrame(rows, "segment string, s double, c double, rf double, actual double")
    fit = {r.segment: r for r in combine.fit_asymmetric(df, ["segment"], fine=0.0625).collect()}
    assert fit["low"].weights == pytest.approx([2.5, 0, 0]) and fit["between"].weights == pytest.approx([0, 0.3125, 0])
    assert fit["low"].loss == fit["between"].loss == 0


def test_part_week_sums_few_lines_a_task(spark, monkeypatch):
    """The tasks that sum a part's weeks are as many as the lines ask for, and give the same rows."""
    sf = "/root/testdata/sf0.001"
    want = sorted(map(tuple, panels.part_week(spark, sf).collect()))
    lines = panels.table(spark, sf, "lineitem").count()
    monkeypatch.setattr(panels, "PER_TASK", 500)
    out = panels.part_week(spark, sf)
    assert out.select(F.spark_partition_id().alias("p")).distinct().count() >= 0.9 * lines / 500
    assert sorted(map(tuple, out.collect())) == want
