"""Forecasts by simple rules and by folds over each key's series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def naive(df: DataFrame, origin: int, horizon: int, key: str = "key", time: str = "week_idx", target: str = "y") -> DataFrame:
    """key, h, time, last_value, mean_13, sply: last value, mean of 13 periods, and the same period last year, as known at the origin."""
    at = df.where(F.col(time) <= origin)
    known = at.groupBy(key).agg(F.max(F.when(F.col(time) == origin, F.col(target))).alias("last_value"), F.avg(F.when(F.col(time) > origin - 13, F.col(target))).alias("mean_13"))
    ahead = known.withColumn("h", F.explode(F.sequence(F.lit(1), F.lit(horizon)))).withColumn(time, F.col("h") + origin)
    year = at.select(key, (F.col(time) + 52).alias(time), F.col(target).alias("sply"))
    return ahead.join(year, [key, time], "left")


def series(df: DataFrame, key: str = "key", time: str = "week_idx", target: str = "y") -> DataFrame:
    """key, ys: each key's values in order of time; as long as a key has periods."""
    return df.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct(time, target))), lambda s: s[target]).alias("ys"))


def croston_fold(ys: Column, alpha: float) -> Column:
    """size and interval: exponentially smoothed demand sizes and gaps between demands; the first gap counts from the start."""
    zero = F.lit(0.0)
    start = F.struct(F.lit(None).cast("double").alias("size"), F.lit(None).cast("double").alias("interval"), zero.alias("gap"))

    def step(s: Column, y: Column) -> Column:
        gap = s["gap"] + 1
        size = F.when(y > 0, F.coalesce(s["size"] + alpha * (y - s["size"]), y)).otherwise(s["size"])
        interval = F.when(y > 0, F.coalesce(s["interval"] + alpha * (gap - s["interval"]), gap)).otherwise(s["interval"])
        return F.struct(size.alias("size"), interval.alias("interval"), F.when(y > 0, zero).otherwise(gap).alias("gap"))

    return F.aggregate(ys, start, step)


def croston(df: DataFrame, alpha: float = 0.1) -> DataFrame:
    """key, croston, sba: flat forecasts; zero for keys that never sold."""
    folded = series(df).withColumn("s", croston_fold(F.col("ys"), alpha))
    flat = F.coalesce(F.col("s.size") / F.col("s.interval"), F.lit(0.0))
    return folded.select("key", flat.alias("croston"), (flat * (1 - alpha / 2)).alias("sba"))


def tsb(df: DataFrame, alpha: float = 0.1, beta: float = 0.1) -> DataFrame:
    """key, tsb: size smoothed on demands times probability that decays between them, from the mean size and the share of demands."""
    known = series(df).withColumn("pos", F.filter("ys", lambda y: y > 0))
    n = F.size("pos")
    mean = F.when(n > 0, F.aggregate("pos", F.lit(0.0), lambda a, y: a + y) / n)
    start = F.struct(F.coalesce(F.col("mean"), F.lit(0.0)).alias("size"), (n / F.size("ys")).alias("p"))
    step = lambda s, y: F.struct(F.when(y > 0, s["size"] + alpha * (y - s["size"])).otherwise(s["size"]).alias("size"), (s["p"] + beta * (F.when(y > 0, 1.0).otherwise(0.0) - s["p"])).alias("p"))
    return known.withColumn("mean", mean).select("key", F.aggregate("ys", start, step, lambda s: s["size"] * s["p"]).alias("tsb"))


def imapa(df: DataFrame, levels: list[int], alpha: float = 0.1, sba: bool = False, grid: bool = False) -> DataFrame:
    """key, imapa: Croston (or, with sba, its variant with less bias) on sums of blocks of several lengths, per period, weighted by each level's share of blocks with demand.

    A row is a period; with grid, periods of the panel without a row are periods without demand. Only rows with demand are gathered and folded.
    """
    time, there = F.col("week_idx"), F.col("y") != 0
    demand = lambda place: F.array_sort(F.collect_list(F.when(there, F.struct(place.cast("int").alias("i"), F.col("y").cast("double").alias("y"))))).alias("ys")
    if grid:
        span = df.agg(F.min(time).alias("_a"), F.max(time).alias("_b"))
        rows = df.groupBy("key").agg(demand(time)).join(F.broadcast(span), F.lit(True)).select("key", F.transform("ys", lambda s: F.struct((s["i"] - F.col("_a")).alias("i"), s["y"].alias("y"))).alias("ys"), (F.col("_b") - F.col("_a") + 1).alias("n"))
    else:
        rows = df.withColumn("_i", F.row_number().over(W.partitionBy("key").orderBy("week_idx")) - 1).groupBy("key").agg(demand(F.col("_i")), F.count("*").alias("n"))
    # Blocks begin with the first period; a rest at the end is left out.
    whole = lambda x: F.filter("ys", lambda s: s["i"] < F.col("n") - F.col("n") % x)
    scored = rows.where(F.col("n") >= min(levels)).withColumns({f"_s{x}": demand_blocks(whole(x), x, alpha) for x in levels})
    weight = [F.when(F.col("n") >= x, F.col(f"_s{x}.hits") / F.floor(F.col("n") / x)).otherwise(0.0) for x in levels]
    level = [F.coalesce(F.col(f"_s{x}.size") / F.col(f"_s{x}.interval"), F.lit(0.0)) * (1 - alpha / 2 if sba else 1.0) / x for x in levels]
    parts = [a * w for a, w in zip(level, weight, strict=True)]
    return scored.select("key", F.coalesce(F.try_divide(sum(parts[1:], parts[0]), sum(weight[1:], weight[0])), F.lit(0.0)).alias("imapa"))


def demand_blocks(ys: Column, length: int, alpha: float) -> Column:
    """size and interval as croston_fold has them of sums of blocks of `length` periods, and hits, the blocks with demand: from places i and values y of the demands alone, in order."""
    none = F.lit(None).cast("double")
    start = F.struct(F.lit(-1).alias("block"), F.lit(0.0).alias("sum"), F.lit(-1).alias("last"), none.alias("size"), none.alias("interval"), F.lit(0).alias("hits"))

    def closed(s: Column) -> dict[str, Column]:
        hit, gap = s["sum"] > 0, s["block"] - s["last"]
        out = {
            "last": (s["block"], s["last"]), "size": (F.coalesce(s["size"] + alpha * (s["sum"] - s["size"]), s["sum"]), s["size"]),
            "interval": (F.coalesce(s["interval"] + alpha * (gap - s["interval"]), gap.cast("double")), s["interval"]), "hits": (s["hits"] + 1, s["hits"]),
        }
        return {name: F.when(hit, a).otherwise(b) for name, (a, b) in out.items()}

    def step(s: Column, x: Column) -> Column:
        block = F.floor(x["i"] / length).cast("int")
        done = F.struct(block.alias("block"), x["y"].alias("sum"), *[c.alias(name) for name, c in closed(s).items()])
        return F.when(block == s["block"], s.withField("sum", s["sum"] + x["y"])).otherwise(done)

    return F.aggregate(ys, start, step, lambda s: F.struct(*[c.alias(name) for name, c in closed(s).items()]))


def hybrid_weight(lag: Column) -> Column:
    """Weight of the direct forecast: none to lag 2, 0.6 at 3, 0.15 more with each, at most 1."""
    return F.when(lag <= 2, 0.0).otherwise(F.least(F.lit(1.0), 0.6 + 0.15 * (lag - 3)))


def hybrid(recursive: DataFrame, direct: DataFrame, keys: list[str], lag: str = "h") -> DataFrame:
    """keys, predicted from columns recursive and direct."""
    w = hybrid_weight(F.col(lag))
    return recursive.join(direct, keys).select(*keys, ((1 - w) * F.col("recursive") + w * F.col("direct")).alias("predicted"))


def error_correction(forecasts: DataFrame, residuals: DataFrame, alpha: float = 0.3) -> DataFrame:
    """Adds the smoothed residual of each key (columns key, week_idx, residual), which fades with the step h; no less than 0."""
    smooth = series(residuals, target="residual").select("key", F.aggregate("ys", F.lit(None).cast("double"), lambda s, x: F.coalesce((1 - alpha) * s + alpha * x, x)).alias("start"))
    fade = F.coalesce(F.col("start"), F.lit(0.0)) * F.pow(F.lit(1 - alpha), F.col("h"))
    return forecasts.join(smooth, "key", "left").withColumn("corrected", F.greatest(F.col("predicted") + fade, F.lit(0.0))).drop("start")


def local_correction(forecasts: DataFrame, train: DataFrame, least: int = 1) -> DataFrame:
    """Adds to predicted the key's mean residual in train (columns actual, predicted) where it has `least` rows; no less than 0."""
    mean = train.groupBy("key").agg(F.avg(F.col("actual") - F.col("predicted")).alias("r"), F.count("*").alias("n")).where(F.col("n") >= least).select("key", "r")
    return forecasts.join(mean, "key", "left").withColumn("corrected", F.greatest(F.col("predicted") + F.coalesce("r", F.lit(0.0)), F.lit(0.0))).drop("r")


def smear(forecasts: DataFrame, train: DataFrame, group: str = "category", lo: float = 0.7, hi: float = 1.8) -> DataFrame:
    """Multiplies by each group's actual over predicted total in train, within bounds."""
    f = train.groupBy(group).agg(F.coalesce(F.least(F.greatest(F.try_divide(F.sum("actual"), F.sum("predicted")), F.lit(lo)), F.lit(hi)), F.lit(1.0)).alias("factor"))
    return forecasts.join(f, group, "left").withColumn("corrected", F.col("predicted") * F.coalesce("factor", F.lit(1.0))).drop("factor")


def horizon_weights(spark, horizon: int, lags: tuple[int, ...], share: float = 0.6) -> DataFrame:  # noqa: ANN001
    """h with three sets of weights that sum to one: balanced, focused on some lags, falling with h."""
    rest, total = (1 - share) / (horizon - len(lags)), horizon * (horizon + 1) / 2
    rows = [(h, 1 / horizon, share / len(lags) if h in lags else rest, (horizon + 1 - h) / total) for h in range(1, horizon + 1)]
    return spark.createDataFrame(rows, "h int, balanced double, focused double, linear double")


def weighted_wape(df: DataFrame, weights: DataFrame, scheme: str) -> DataFrame:
    """One row: wape, the WAPE of each horizon h (columns h, actual, predicted) weighted by the scheme; horizons without demand or weight don't count."""
    per = df.groupBy("h").agg(F.try_divide(F.sum(F.abs(F.col("predicted") - F.col("actual"))), F.sum("actual")).alias("_w")).where("_w is not null")
    return per.join(F.broadcast(weights.select("h", F.col(scheme).alias("_g"))), "h").agg(F.try_divide(F.sum(F.col("_w") * F.col("_g")), F.sum("_g")).alias("wape"))


def expanded(df: DataFrame, weights: DataFrame, scheme: str, time: str = "week_idx") -> DataFrame:
    """Each row once for each horizon h, with its target period and the scheme's weight; few horizons."""
    return df.join(F.broadcast(weights.select("h", F.col(scheme).alias("weight"))), F.lit(True)).withColumn("target_idx", F.col(time) + F.col("h"))
