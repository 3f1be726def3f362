"""Accuracy, comparison with a benchmark, error analysis and backtests: columns actual, predicted, benchmark."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from demandloom.operators import ranks
from demandloom.operators.orders import decayed_sums
from demandloom.operators.windows import correlated

A, P = F.col, F.col


def ratio(a: Column, b: Column) -> Column:
    return a / F.when(b != 0, b)


def metrics(actual: str = "actual", predicted: str = "predicted") -> list[Column]:
    """n, actual_sum, wape, mae, rmse, bias, bias_pct, smape, mape (without zero actuals)."""
    a, p = F.col(actual), F.col(predicted)
    e, total = p - a, F.sum(F.abs(a))
    return [
        F.count(e).alias("n"), F.sum(a).alias("actual_sum"), ratio(F.sum(F.abs(e)), total).alias("wape"), F.avg(F.abs(e)).alias("mae"), F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(e).alias("bias"),
        ratio(F.sum(e), total).alias("bias_pct"), F.avg(F.when(F.abs(a) + F.abs(p) > 0, 2 * F.abs(e) / F.when(F.abs(a) + F.abs(p) > 0, F.abs(a) + F.abs(p))).otherwise(0.0)).alias("smape"),
        F.avg(F.abs(e) / F.when(a != 0, F.abs(a))).alias("mape"),
    ]


def tier(wape: Column) -> Column:
    return F.when(wape <= 0.1, "excellent").when(wape <= 0.2, "good").when(wape <= 0.3, "fair").when(wape <= 0.5, "poor").otherwise("bad")


def accuracy_bias(df: DataFrame, by: list[str], predicted: str = "predicted") -> DataFrame:
    """accuracy (1 - WAPE) and bias, pooled; null without positive actuals."""
    a, p = F.col("actual"), F.col(predicted)
    total = F.when(F.sum(a) > 0, F.sum(a))
    return df.groupBy(*by).agg((1 - F.sum(F.abs(p - a)) / total).alias("accuracy"), (F.sum(p - a) / total).alias("bias"))


def metrics_by(df: DataFrame, by: list[str]) -> DataFrame:
    return df.groupBy(*by).agg(*metrics()).withColumn("tier", tier(F.col("wape")))


def mase(df: DataFrame, by: str, season: int, time: str = "week_idx") -> DataFrame:
    """by, mase: mean absolute error over that of the value `season` rows before."""
    naive = F.abs(F.col("actual") - F.lag("actual", season).over(W.partitionBy(by).orderBy(time)))
    return df.withColumn("_n", naive).groupBy(by).agg(ratio(F.avg(F.abs(F.col("predicted") - F.col("actual"))), F.avg("_n")).alias("mase"))


def metrics_at_levels(df: DataFrame, levels: list[list[str]]) -> DataFrame:
    """level, group and the metrics at several grains in one pass; an empty list is overall."""
    names = sorted({c for level in levels for c in level})
    keyed = df.groupingSets([[F.col(c) for c in level] for level in levels], *[F.col(c) for c in names]).agg(*metrics(), F.grouping_id().alias("_g"))
    ids = {sum(1 << (len(names) - 1 - i) for i, c in enumerate(names) if c not in level): "+".join(level) or "overall" for level in levels}
    label = F.coalesce(*[F.when(F.col("_g") == g, F.lit(n)) for g, n in ids.items()])
    return keyed.withColumn("level", label).withColumn("group", F.concat_ws("|", *[F.col(c).cast("string") for c in names])).drop("_g", *names)


def scoreboard(df: DataFrame, by: list[str], group: str = "category", whole: str = "__ALL__") -> DataFrame:
    """Accuracy and bias of predicted and benchmark per group and over all, and WIN where both are better."""
    rows = df.unionByName(df.withColumn(group, F.lit(whole)))
    ours, theirs = accuracy_bias(rows, by), accuracy_bias(rows, by, "benchmark").withColumnsRenamed({"accuracy": "bench_accuracy", "bias": "bench_bias"})
    win = (F.col("accuracy") > F.col("bench_accuracy")) & (F.abs("bias") < F.abs("bench_bias"))
    return ours.join(theirs, by).withColumn("verdict", F.when(win, "WIN").otherwise("LOSS"))


def win_matrix(board: DataFrame, row: str, column: str, values: list) -> DataFrame:
    return board.groupBy(row).pivot(column, values).agg(F.first("verdict"))


def winners(df: DataFrame, by: list[str]) -> DataFrame:
    """Absolute errors of both forecasts, on all rows and on those with sales, and the winner."""
    e = lambda c: F.abs(F.col(c) - F.col("actual"))
    sold = F.col("actual") > 0
    out = df.groupBy(*by).agg(F.sum(e("predicted")).alias("error"), F.sum(e("benchmark")).alias("bench_error"), ratio(F.sum(F.when(sold, e("predicted"))), F.sum(F.when(sold, F.col("actual")))).alias("sold_wape"))
    return out.withColumn("winner", F.when(F.col("error") < F.col("bench_error"), "ours").when(F.col("error") > F.col("bench_error"), "benchmark").otherwise("tie"))


def errors_over_time(df: DataFrame, window: int = 4, time: str = "week_idx") -> DataFrame:
    """Per period: wape, and that of the last periods together."""
    sums = df.groupBy(time).agg(F.sum(F.abs(F.col("predicted") - F.col("actual"))).alias("e"), F.sum(F.abs("actual")).alias("a"))
    w = W.orderBy(time).rowsBetween(1 - window, 0)  # one row per period
    return sums.select(time, ratio(F.col("e"), F.col("a")).alias("wape"), ratio(F.sum("e").over(w), F.sum("a").over(w)).alias("rolling_wape"))


def error_seasonality(df: DataFrame, lags: list[int], time: str = "week_idx") -> DataFrame:
    """lag, corr of the mean error with that of so many periods ago, and whether it is over 0.3."""
    mean = df.groupBy(time).agg(F.avg(F.col("predicted") - F.col("actual")).alias("e"))
    w = W.orderBy(time)  # one row per period
    lagged = mean.select("e", *[F.lag("e", n).over(w).alias(f"l{n}") for n in lags]).agg(*[correlated("e", f"l{n}").alias(f"c{n}") for n in lags])
    return lagged.select(F.explode(F.array(*[F.struct(F.lit(n).alias("lag"), F.col(f"c{n}").alias("corr"), (F.abs(f"c{n}") > 0.3).alias("seasonal")) for n in lags])).alias("r")).select("r.*")


def error_decomposition(df: DataFrame, by: list[str]) -> DataFrame:
    """mse, bias_sq, variance and the systematic share."""
    e = F.col("predicted") - F.col("actual")
    out = df.groupBy(*by).agg(F.avg(e * e).alias("mse"), F.pow(F.avg(e), F.lit(2.0)).alias("bias_sq"), F.var_pop(e).alias("variance"))
    return out.withColumn("systematic", ratio(F.col("bias_sq"), F.col("mse")))


def error_outliers(df: DataFrame, factor: float = 1.5, method: str = "iqr") -> DataFrame:
    """Rows whose absolute error is over the third quartile plus factor ranges, with how far over in ranges; or (zscore) over the mean by more than factor deviations, with by how many."""
    rows = df.withColumn("abs_error", F.abs(F.col("predicted") - F.col("actual")))
    if method == "zscore":
        m = rows.agg(F.avg("abs_error").alias("_a"), F.stddev_samp("abs_error").alias("_b"))  # one row
        return rows.join(F.broadcast(m), F.lit(True)).withColumn("score", ratio(F.col("abs_error") - F.col("_a"), F.col("_b"))).where(F.col("score") > factor).drop("_a", "_b")
    q = ranks.with_quantiles(rows, "abs_error", [0.25, 0.75], ["_a", "_b"])
    return q.where(F.col("abs_error") > F.col("_b") + factor * (F.col("_b") - F.col("_a"))).withColumn("score", ratio(F.col("abs_error") - F.col("_b"), F.col("_b") - F.col("_a"))).drop("_a", "_b")


def failures(df: DataFrame, threshold: float, characteristics: DataFrame, columns: list[str]) -> DataFrame:
    """failed, n_keys and mean characteristics of keys whose WAPE is over the threshold and of the rest."""
    keys = metrics_by(df, ["key"]).withColumn("failed", F.col("wape") > threshold)
    return keys.join(characteristics, "key").groupBy("failed").agg(F.count("*").alias("n_keys"), *[F.avg(c).alias(c) for c in columns])


def error_by(df: DataFrame, characteristics: DataFrame, by: list[str], threshold: float) -> DataFrame:
    """by (characteristics of keys, such as the demand pattern), n_keys, n_failed (keys whose WAPE is over the threshold), and n, wape and bias_pct of all their rows together."""
    keys = df.groupBy("key").agg(F.count(F.col("predicted") - F.col("actual")).alias("n"), F.sum(F.abs(F.col("predicted") - F.col("actual"))).alias("_e"), F.sum(F.col("predicted") - F.col("actual")).alias("_d"), F.sum(F.abs("actual")).alias("_a"))
    both = keys.join(characteristics.select("key", *by), "key")
    return both.groupBy(*by).agg(
        F.count("*").alias("n_keys"), F.count_if(ratio(F.col("_e"), F.col("_a")) > threshold).alias("n_failed"), F.sum("n").alias("n"), ratio(F.sum("_e"), F.sum("_a")).alias("wape"), ratio(F.sum("_d"), F.sum("_a")).alias("bias_pct")
    )


def prediction_leakage(df: DataFrame, most_wape: float = 0.01, least_corr: float = 0.99, least_rows: int = 10, constant_share: float = 0.8) -> DataFrame:
    """One row: n, wape (with more than least_rows actuals), corr, constant_keys (keys of several rows and one prediction), n_keys; too_good and too_alike (signs of leakage), constant (more than the share of all
    keys), suspected (either sign). All keys are looked at."""
    e, a = F.abs(F.col("predicted") - F.col("actual")), F.when(F.col("predicted").isNotNull(), F.abs("actual"))
    whole = df.agg(F.count(e).alias("n"), F.when(F.count(e) > least_rows, ratio(F.sum(e), F.sum(a))).alias("wape"), correlated("actual", "predicted").alias("corr"))
    spread = df.groupBy("key").agg((F.count("predicted") > 1).alias("many"), F.stddev_pop("predicted").alias("sd"))
    keys = spread.agg(F.count_if(F.col("many") & (F.col("sd") < 1e-8)).alias("constant_keys"), F.count("*").alias("n_keys"))
    out = whole.join(F.broadcast(keys), F.lit(True))  # one row on either side
    out = out.withColumns({"too_good": F.coalesce(F.col("wape") < most_wape, F.lit(False)), "too_alike": F.coalesce(F.col("corr") > least_corr, F.lit(False)), "constant": F.col("constant_keys") > constant_share * F.col("n_keys")})
    return out.withColumn("suspected", F.col("too_good") | F.col("too_alike"))


def ranked_models(df: DataFrame, model: str, baseline: str, by: list[str] | None = None) -> DataFrame:
    """wape, rank and lift over the baseline of each model, per group."""
    scores = df.groupBy(*(by or []), model).agg(*metrics()).select(*(by or []), model, "wape")
    w = W.partitionBy(*(by or []))
    base = F.max(F.when(F.col(model) == baseline, F.col("wape"))).over(w)
    return scores.withColumn("rank", F.rank().over(w.orderBy("wape"))).withColumn("lift", ratio(base - F.col("wape"), base))


def verdict(df: DataFrame, target: float = 0.3) -> DataFrame:
    """One row: wape, bias_pct, ready, confidence in per cent."""
    m = df.agg(*metrics())
    score = F.greatest(F.lit(0.0), F.least(F.lit(100.0), (1 - F.col("wape")) * 100 - F.abs("bias_pct") * 50))
    return m.select("wape", "bias_pct", ((F.col("wape") <= target) & (F.abs("bias_pct") <= 0.1)).alias("ready"), score.alias("confidence"))


def segment_tiers(df: DataFrame, by: str = "segment") -> DataFrame:
    """by, n, wape, bias_pct, tier of each segment."""
    return metrics_by(df, [by]).select(by, "n", "wape", "bias_pct", "tier")


def checks(df: DataFrame, target: float = 0.3, most_bias: float = 0.1, worst: float = 0.5, by: str = "segment") -> DataFrame:
    """check, value, limit, passed: overall wape and absolute bias_pct, and the worst segment's wape."""
    overall, segments = df.agg(*metrics()), segment_tiers(df, by).agg(F.max("wape").alias("worst"))
    named = [("wape", F.col("wape"), target), ("bias", F.abs("bias_pct"), most_bias), ("segment", F.col("worst"), worst)]
    rows = F.array(*[F.struct(F.lit(n).alias("check"), v.alias("value"), F.lit(limit).alias("limit"), (v <= limit).alias("passed")) for n, v, limit in named])
    return overall.join(F.broadcast(segments), F.lit(True)).select(F.explode(rows).alias("r")).select("r.*")  # one row on either side


def origins(df: DataFrame, first: int, last: int, horizon: int, time: str = "week_idx") -> DataFrame:
    """origin, cutoff, test_start, test_end: the periods from first to last that df has, as cutoffs; ends no later than the last's next."""
    cutoffs = df.where(F.col(time).between(first, last)).select(F.col(time).cast("int").alias("cutoff")).distinct()
    return cutoffs.select((F.col("cutoff") - first).alias("origin"), "cutoff", (F.col("cutoff") + 1).alias("test_start"), F.least(F.col("cutoff") + horizon, F.lit(last + 1)).alias("test_end"))


def demand_states(df: DataFrame, alpha: float = 0.1, beta: float = 0.1, key: str = "key", time: str = "week_idx", target: str = "y") -> DataFrame:
    """key, time, next (the key's next period), croston, sba, tsb: what forecast.croston and forecast.tsb say of the rows up to each row; and last, total, n (of the values so far).

    Smoothing is an affine map at each demand, or at each row, so that all states come of decayed sums over running orders: one scan, no fit anew for each row.
    """
    rows = df.select(F.col(key).alias("key"), F.col(time).alias("time"), F.col(target).cast("double").alias("y")).withColumn("sold", F.coalesce(F.col("y") > 0, F.lit(False)))
    by_time, by_demand = W.partitionBy("key").orderBy("time"), W.partitionBy("key", "sold").orderBy("time")
    rows = rows.withColumn("pos", F.row_number().over(by_time))
    rows = rows.withColumn("gap", F.col("pos") - F.lag("pos", 1, 0).over(by_demand)).withColumn("nth", F.row_number().over(by_demand))
    first = lambda x: F.when(F.col("sold"), F.when(F.col("nth") == 1, x).otherwise(alpha * x))
    rows = decayed_sums(rows, {"size": (first(F.col("y")), 1 - alpha), "interval": (first(F.col("gap")), 1 - alpha), "late": (F.when(F.col("sold"), alpha * F.col("y")), 1 - alpha)}, ["key", "sold"], "time")
    rows = decayed_sums(rows, {"chance": (beta * F.col("sold").cast("double"), 1 - beta)}, "key", "time")
    upto = by_time.rowsBetween(W.unboundedPreceding, 0)
    at_demand = lambda c: F.last(F.when(F.col("sold"), F.col(c)), ignorenulls=True).over(upto)
    demands, positive = F.coalesce(at_demand("nth"), F.lit(0)), F.sum(F.when(F.col("sold"), F.col("y"))).over(upto)
    flat = F.coalesce(at_demand("size") / at_demand("interval"), F.lit(0.0))
    # The first state of the other family is made of all rows so far: it decays with each demand, or row.
    size = F.coalesce(F.pow(F.lit(1 - alpha), demands) * positive / F.when(demands > 0, demands) + at_demand("late"), F.lit(0.0))
    chance = F.pow(F.lit(1 - beta), F.col("pos")) * demands / F.col("pos") + F.col("chance")
    return rows.select(
        "key", "time", F.lead("time").over(by_time).alias("next"), flat.alias("croston"), (flat * (1 - alpha / 2)).alias("sba"), (size * chance).alias("tsb"),
        F.last("y").over(upto).alias("last"), F.coalesce(F.sum("y").over(upto), F.lit(0.0)).alias("total"), F.count("y").over(upto).alias("n"),
    )


NAIVE = ("mean", "last", "croston", "sba", "tsb")


def as_of(df: DataFrame, cutoffs: DataFrame, window: int = 13, key: str = "key", time: str = "week_idx", target: str = "y") -> DataFrame:
    """key, cutoff, mean (of the last `window` periods), last, croston, sba, tsb, as known at each of a few cutoffs; keys without a value in the window are left out.

    Every row stands for the cutoffs from its own period to before the key's next one, so a key has one row a cutoff, whatever its history; means are differences of running sums.
    """
    points = cutoffs.agg(F.collect_set(F.struct("cutoff", F.lit(True).alias("here"), F.col("cutoff").alias("at"))).alias("a"), F.collect_set(F.struct("cutoff", F.lit(False).alias("here"), (F.col("cutoff") - window).alias("at"))).alias("b"))
    states = demand_states(df, key=key, time=time, target=target).join(F.broadcast(points.select(F.concat("a", "b").alias("points"))), F.lit(True))  # one row, two points a cutoff
    met = states.withColumn("p", F.explode(F.filter("points", lambda p: (p["at"] >= F.col("time")) & (F.col("next").isNull() | (p["at"] < F.col("next"))))))
    here = F.max(F.when(F.col("p.here"), F.struct("total", "n", "last", "croston", "sba", "tsb"))).alias("s")
    both = met.groupBy("key", F.col("p.cutoff").alias("cutoff")).agg(here, *[F.coalesce(F.max(F.when(~F.col("p.here"), F.col(c))), F.lit(0)).alias(f"old_{c}") for c in ("total", "n")])
    known = both.where(F.col("s.n") > F.col("old_n"))
    return known.select(F.col("key").alias(key), "cutoff", ((F.col("s.total") - F.col("old_total")) / (F.col("s.n") - F.col("old_n"))).alias("mean"), *[f"s.{c}" for c in NAIVE[1:]])


def backtest_scores(known: DataFrame, df: DataFrame, cutoffs: DataFrame, horizon: int, names: tuple[str, ...] = NAIVE, key: str = "key", time: str = "week_idx", target: str = "y") -> DataFrame:
    """cutoff, h, n and wape_{name} of flat forecasts (key, cutoff, names) against what came in the periods after each cutoff."""
    c = F.broadcast(cutoffs.select("cutoff"))  # a few
    future = df.withColumn("cutoff", F.explode(F.sequence(F.col(time) - horizon, F.col(time) - 1))).join(c, "cutoff").select("cutoff", key, (F.col(time) - F.col("cutoff")).alias("h"), F.col(target).alias("actual"))
    e = lambda p: ratio(F.sum(F.abs(F.col(p) - F.col("actual"))), F.sum("actual"))
    return future.join(known, ["cutoff", key]).groupBy("cutoff", "h").agg(F.count("*").alias("n"), *[e(p).alias(f"wape_{p}") for p in names])


def rolling_backtest(df: DataFrame, cutoffs: DataFrame, horizon: int, key: str = "key", time: str = "week_idx", target: str = "y") -> DataFrame:
    """cutoff, h, n, wape_{mean, last, croston, sba, tsb}: the families as known at each of a few cutoffs, as if fitted anew there, against what came."""
    return backtest_scores(as_of(df, cutoffs, 13, key, time, target), df, cutoffs, horizon, NAIVE, key, time, target)


def folds(df: DataFrame, n: int, horizon: int, gap: int = 0, window: int | None = None, time: str = "week_idx") -> DataFrame:
    """fold, train_start, train_end, val_start, val_end at the end of the data; an expanding train part, or of `window` periods."""
    span = df.agg(F.min(time).alias("a"), F.max(time).alias("b"))
    f = span.select("a", "b", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("fold"))
    end = F.col("b") - (n - 1 - F.col("fold")) * horizon
    train_end = end - horizon - gap
    start = F.greatest(F.col("a"), train_end - window + 1) if window else F.col("a")
    return f.select("fold", start.alias("train_start"), train_end.alias("train_end"), (end - horizon + 1).alias("val_start"), end.alias("val_end")).where("train_end >= train_start")


def drift(df: DataFrame, threshold: float = 0.01, x: str = "fold", y: str = "wape") -> DataFrame:
    """slope and r2 of wape over folds, and whether both say it drifts."""
    return df.agg(F.regr_slope(F.col(y), F.col(x)).alias("slope"), F.regr_r2(F.col(y), F.col(x)).alias("r2")).withColumn("drifts", (F.col("slope") > threshold) & (F.col("r2") > 0.5))


def completeness(df: DataFrame, horizon: int, key: str = "key") -> DataFrame:
    """Keys whose forecasts are short, negative or all the same."""
    n = F.count("predicted")
    seen = df.groupBy(key).agg(n.alias("n"), F.count_if(F.col("predicted") < 0).alias("n_negative"), (F.count_distinct("predicted") == 1).alias("constant"))
    return seen.withColumn("short", F.col("n") < horizon).where("short or n_negative > 0 or constant")
