"""All queries over the driver's tables, one for each operator, with SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandloom.operators import evaluate, forecast, panel
from demandloom.plans import cleaning, combining, correcting, crosswise, features, joining, profiling, scoring, segmenting, variants  # noqa: F401
from demandloom.plans.panels import brand_week
from demandloom.plans.registry import ORACLES, QUERIES  # noqa: F401


def flagship(spark: SparkSession, sf_dir: str, origin: int = 1608, horizon: int = 13) -> DataFrame:
    """Accuracy and bias by brand of two naive forecasts at one origin: the mean of 13 weeks and last year's week."""
    dense = panel.dense_grid(brand_week(spark, sf_dir))
    fc = forecast.naive(dense, origin, horizon).join(dense.select("key", "week_idx", F.col("y").alias("actual")), ["key", "week_idx"])
    mean, season = evaluate.accuracy_bias(fc, ["key"], "mean_13"), evaluate.accuracy_bias(fc, ["key"], "sply")
    return mean.join(season.withColumnsRenamed({"accuracy": "season_accuracy", "bias": "season_bias"}), "key")
