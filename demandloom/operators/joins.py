"""Joins, set operations and top-k on panels and forecasts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from demandloom.operators import ranks


def horizon_pairs(left: DataFrame, right: DataFrame, horizons: int, key: str = "key", time: str = "week_idx") -> DataFrame:
    """Each origin row of left with the right's row h periods on, for every h from 1: an equi-join on key and period, so gaps don't shift it."""
    ahead = left.withColumn("h", F.explode(F.sequence(F.lit(1), F.lit(horizons)))).withColumn("target_idx", F.col(time) + F.col("h"))
    return ahead.join(right.withColumnRenamed(time, "target_idx"), [key, "target_idx"])


def forward_covariates(df: DataFrame, columns: list[str], h: int, key: str = "key", time: str = "week_idx") -> DataFrame:
    """Adds the columns of the row h periods on, as fwd{h}_name; null where there is none."""
    later = df.select(key, (F.col(time) - h).alias(time), *[F.col(c).alias(f"fwd{h}_{c}") for c in columns])
    return df.join(later, [key, time], "left")


def attach_forecasts(ours: DataFrame, benchmark: DataFrame, actuals: DataFrame, keys: list[str]) -> DataFrame:
    """ours with benchmark and actual, where both are known."""
    return ours.join(benchmark, keys, "left").join(actuals, keys, "left").where("benchmark is not null and actual is not null")


def components(overall: DataFrame, local: DataFrame, benchmark: DataFrame, keys: list[str], values: tuple[str, str, str] = ("s", "c", "rf")) -> DataFrame:
    """Full join of two component forecasts, zero where one lacks a row, with the benchmark where it has one."""
    both = overall.join(local, keys, "full").join(benchmark, keys, "left")
    return both.select(*keys, *[F.coalesce(v, F.lit(0.0)).alias(v) for v in values[:2]], values[2])


def segment_fallback(category: DataFrame, segment: DataFrame, keys: list[str]) -> DataFrame:
    """c from the category's forecast, s from the segment's or else the category's."""
    return category.join(segment, keys, "left").withColumn("s", F.coalesce("s", "c"))


def late_keys_removed(df: DataFrame, first_evaluated: int, key: str = "key", time: str = "year_week") -> DataFrame:
    """df without the keys that start after the first evaluated period."""
    late = df.groupBy(key).agg(F.min(time).alias("first")).where(F.col("first") > first_evaluated).select(key)
    return df.join(late, key, "left_anti")


def key_status(source: DataFrame, manifest: DataFrame, test_start: int, lookback: int, key: str = "key", time: str = "week_idx", target: str = "y") -> DataFrame:
    """key, status of keys in the test periods: dead (no demand in the lookback), existing (in the manifest) or new."""
    test = source.where(F.col(time) >= test_start).select(key).distinct()
    recent = source.where((F.col(time) < test_start) & (F.col(time) >= test_start - lookback)).groupBy(key).agg(F.sum(target).alias("recent"))
    known = manifest.select(key).distinct().withColumn("known", F.lit(True))
    dead = F.coalesce(F.col("recent"), F.lit(0.0)) <= 0
    return test.join(recent, key, "left").join(known, key, "left").select(key, F.when(dead, "dead").when(F.col("known"), "existing").otherwise("new").alias("status"))


def year_over_year(df: DataFrame, columns: list[str], label: str, key: str = "key", year: str = "year") -> DataFrame:
    """Adds prev_ and delta_ of the columns, and whether the label changed, against the year before."""
    before = df.select(key, (F.col(year) + 1).alias(year), *[F.col(c).alias(f"prev_{c}") for c in [*columns, label]])
    out = df.join(before, [key, year], "left").withColumns({f"delta_{c}": F.col(c) - F.col(f"prev_{c}") for c in columns})
    return out.withColumn(f"{label}_changed", F.col(label) != F.col(f"prev_{label}"))


def mapped(df: DataFrame, mapping: dict[str, str], source: str, out: str, unmapped: str = "UNMAPPED") -> DataFrame:
    """Adds the mapping's value; the mapping is a given dict, so its table is small."""
    pairs = df.sparkSession.createDataFrame(list(mapping.items()) or [("", "")], f"{source} string, {out} string")
    return df.join(F.broadcast(pairs), source, "left").withColumn(out, F.coalesce(out, F.lit(unmapped)))


def in_folds(df: DataFrame, folds: DataFrame, time: str = "week_idx") -> DataFrame:
    """Each row with every fold and part (columns fold, part, lo, hi) whose range holds its period; folds are a few rows."""
    return df.join(F.broadcast(folds), (F.col(time) >= F.col("lo")) & (F.col(time) <= F.col("hi"))).drop("lo", "hi")


def with_weights(df: DataFrame, weights: DataFrame, default: tuple[float, float, float]) -> DataFrame:
    """Adds w_s, w_c, w_rf: of the category and segment, of the category's `_default` segment, or the default."""
    names = ("w_s", "w_c", "w_rf")
    own = weights.select("category", "segment", *names)
    fall = weights.where("segment = '_default'").select("category", *[F.col(n).alias(f"d_{n}") for n in names])
    out = df.join(own, ["category", "segment"], "left").join(fall, "category", "left")
    return out.select(*df.columns, *[F.coalesce(n, f"d_{n}", F.lit(v)).alias(n) for n, v in zip(names, default, strict=True)])


def with_dead_keys(forecasts: DataFrame, dead: DataFrame, horizon: DataFrame, key: str = "key") -> DataFrame:
    """forecasts and zeros for each dead key at each period of the (few) periods of the horizon, flagged."""
    zeros = dead.select(key).distinct().join(F.broadcast(horizon), F.lit(True)).withColumn("predicted", F.lit(0.0))
    return forecasts.withColumn("is_dead_key", F.lit(False)).unionByName(zeros.withColumn("is_dead_key", F.lit(True)), allowMissingColumns=True)


def keys_without(a: DataFrame, b: DataFrame, key: str = "key") -> DataFrame:
    return a.select(key).subtract(b.select(key))


def keys_in_both(a: DataFrame, b: DataFrame, key: str = "key") -> DataFrame:
    return a.select(key).intersect(b.select(key))


def top_recent(df: DataFrame, periods: int, n: int, key: str = "key", time: str = "week_idx", target: str = "y") -> DataFrame:
    """rank, key, recent: the n keys with the most demand over the last periods in which there was any; ties to the lesser key."""
    last = df.groupBy(time).agg(F.sum(target).alias("t")).where("t > 0").orderBy(F.desc(time)).limit(periods).select(time)
    best = df.join(last, time, "left_semi").groupBy(key).agg(F.sum(target).alias("recent")).orderBy(F.desc("recent"), key).limit(n)
    return best.select(F.row_number().over(W.orderBy(F.desc("recent"), key)).alias("rank"), key, "recent")  # n rows


def best_and_worst(df: DataFrame, n: int, least_volume: float, key: str = "key", actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    """side, rank, key, volume, wape: the n keys of least and of greatest WAPE among those with enough volume."""
    seen = df.groupBy(key).agg(F.sum(actual).alias("volume"), F.sum(F.abs(F.col(predicted) - F.col(actual))).alias("e")).where(F.col("volume") >= least_volume)
    seen = seen.select(key, "volume", F.round(F.expr("e / nullif(volume, 0)"), 6).alias("wape")).where("wape is not null")
    side = lambda name, order: seen.orderBy(*order).limit(n).select(F.lit(name).alias("side"), F.row_number().over(W.orderBy(*order)).alias("rank"), key, "volume", "wape")
    return side("best", [F.asc("wape"), F.asc(key)]).unionByName(side("worst", [F.desc("wape"), F.asc(key)]))


def volume_head(df: DataFrame, share: float, group: str, item: str, target: str = "y") -> DataFrame:
    """group, item, volume, rank of the first share of each group's items by volume (rounded up)."""
    sums = df.groupBy(group, item).agg(F.sum(target).alias("volume"))
    w = W.partitionBy(group)
    ranked = sums.withColumn("rank", F.row_number().over(w.orderBy(F.desc("volume"), item))).withColumn("n", F.count("*").over(w))
    return ranked.where(F.col("rank") <= F.ceil(share * F.col("n"))).drop("n")


def high_volume_keys(df: DataFrame, quantile: float, most_zero: float, least_nonzero: int, key: str = "key", target: str = "y") -> DataFrame:
    """key, volume of keys at or over the volume quantile with few zeros and enough sales."""
    sums = df.groupBy(key).agg(F.sum(target).alias("volume"), F.avg((F.col(target) == 0).cast("int")).alias("zero"), F.count_if(F.col(target) > 0).alias("n"))
    return ranks.with_quantiles(sums, "volume", [quantile], ["edge"]).where(F.col("volume") >= F.col("edge")).where((F.col("zero") <= most_zero) & (F.col("n") >= least_nonzero)).select(key, "volume")


def largest_errors(df: DataFrame, n: int, order: list[str], actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    """The n rows of the largest absolute error; ties by order."""
    return df.withColumn("abs_error", F.abs(F.col(predicted) - F.col(actual))).orderBy(F.desc("abs_error"), *order).limit(n)
