"""Features per key and time. Whatever describes the target looks only at rows before the current one, unless said otherwise.

Lags count rows: make the panel dense first where gaps matter. All windows of a function share one partitioning and order, so
that one sort serves them. Missing lags and too few observations give null.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from demandloom.operators.orders import decayed_sums, moving_quantiles

KEY, TIME, TARGET = "key", "week_idx", "y"


def by_key(key: str = KEY, time: str = TIME):  # noqa: ANN201
    return W.partitionBy(key).orderBy(time)


def lagged(n: int, column: str = TARGET, key: str = KEY, time: str = TIME) -> Column:
    return F.lag(column, n).over(by_key(key, time))


def divided(a: Column, b: Column) -> Column:
    """a / b, null where b is zero."""
    return a / F.when(b != 0, b)


def correlated(a: Column | str, b: Column | str, constant: float | None = None) -> Column:
    """Correlation of two columns over the rows that have both, null without any; `constant` (else null) where either is constant (for which Spark's own ends the query)."""
    a, b = (F.col(c) if isinstance(c, str) else c for c in (a, b))
    x, y = F.when(b.isNotNull(), a), F.when(a.isNotNull(), b)
    sd = F.stddev_pop(x) * F.stddev_pop(y)
    found = F.covar_pop(x, y) / F.when(sd > 0, sd)
    return found if constant is None else F.when(sd > 0, found).when(sd.isNotNull(), F.lit(constant))


def clip(c: Column, lo: float, hi: float) -> Column:
    """c within bounds, null where c is."""
    return F.when(c.isNotNull(), F.least(F.greatest(c, F.lit(lo)), F.lit(hi)))


def framed(f: Column, first: int, last: int, least: int = 1, counted: str | Column = TARGET, key: str = KEY, time: str = TIME) -> Column:
    """f over rows first to last relative to this one, null below `least` non-null values of `counted`."""
    w = by_key(key, time).rowsBetween(first, last)
    return F.when(F.count(counted).over(w) >= least, f.over(w))


AGGREGATES = {"mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max, "sum": F.sum}


def lag_features(df: DataFrame, lags: list[int], least: int = 1) -> DataFrame:
    """lag_n for each lag, none below `least`."""
    return df.withColumns({f"lag_{n}": lagged(n) for n in lags if n >= least})


def lag_combinations(df: DataFrame, pairs: list[tuple[int, int]]) -> DataFrame:
    """diff, ratio and pct change of two lags."""
    out = {}
    for a, b in pairs:
        x, y = lagged(a), lagged(b)
        out |= {f"diff_{a}_{b}": x - y, f"ratio_{a}_{b}": x / (y + 1e-10), f"pct_{a}_{b}": divided(x - y, y)}
    return df.withColumns(out)


def momentum(df: DataFrame, spans: list[int]) -> DataFrame:
    """roc_p, momentum_p and acceleration_p of the previous row against p rows before it."""
    out = {}
    for p in spans:
        out |= {f"roc_{p}": divided(lagged(1) - lagged(1 + p), lagged(1 + p)), f"momentum_{p}": lagged(1) - lagged(1 + p), f"acceleration_{p}": lagged(1) - lagged(1 + p) - lagged(2) + lagged(2 + p)}
    return df.withColumns(out)


def seasonal_lags(df: DataFrame, season: int = 52, quarter: int = 13) -> DataFrame:
    return df.withColumns({"lag_season": lagged(season), "yoy": lagged(1) - lagged(season + 1), "yoy_ratio": divided(lagged(1), lagged(season + 1)), "qoq": lagged(1) - lagged(quarter + 1)})


def rolling(df: DataFrame, windows: list[int], aggregates: list[str], shift: int = 1, least: int = 1) -> DataFrame:
    """roll_{aggregate}_{W} over the W rows that end shift rows before."""
    medians = {f"roll_median_{w}": (TARGET, -(w + shift - 1), -shift, 0.5) for w in windows if "median" in aggregates}
    df = moving_quantiles(df, medians) if medians else df
    out = {f"roll_{a}_{w}": framed(AGGREGATES[a](TARGET), -(w + shift - 1), -shift, least) for w in windows for a in aggregates if a != "median"}
    there = {n: F.when(F.count(TARGET).over(by_key().rowsBetween(first, last)) >= least, F.col(n)) for n, (_, first, last, _) in medians.items()}
    return df.withColumns(out | there)


def ewm(df: DataFrame, spans: list[int], shift: int = 1, adjust: bool = True) -> DataFrame:
    """ewm_{span}, ewm_std_{span}: exponentially weighted mean and deviation up to shift rows before, the deviation without bias and null for one value.

    Rows of a null value count in the distance of those before. Without adjust the first value has the weight of all that would come before it.
    """
    terms, y = {}, F.col(TARGET)
    # Squares are taken of the distance from the key's first value: a common level would cost digits.
    df = df.withColumn("_base", F.first(TARGET, ignorenulls=True).over(by_key().rowsBetween(W.unboundedPreceding, W.unboundedFollowing))).withColumn("_y", y - F.col("_base"))
    df = df.withColumn("_first", F.count(TARGET).over(by_key().rowsBetween(W.unboundedPreceding, -1)) == 0)
    for span in [s for s in spans if s > 1]:
        a = 2 / (span + 1)
        w = F.when(y.isNotNull(), 1.0 if adjust else F.when(F.col("_first"), 1.0).otherwise(a))
        terms |= {f"_{k}_{span}": (t, (1 - a) ** p) for k, t, p in (("w", w, 1), ("wx", w * F.col("_y"), 1), ("wxx", w * F.col("_y") * F.col("_y"), 1), ("ww", w * w, 2))}
    df = decayed_sums(df, terms)
    out = {}
    for span in spans:
        if span <= 1:  # nothing but the last value counts
            out |= {f"ewm_{span}": F.last(TARGET, ignorenulls=True).over(by_key().rowsBetween(W.unboundedPreceding, -shift)), f"ewm_std_{span}": F.lit(None).cast("double")}
            continue
        w, wx, wxx, ww = (F.lag(f"_{k}_{span}", shift).over(by_key()) for k in ("w", "wx", "wxx", "ww"))
        mean = divided(wx, w)
        rest = w * w - ww
        variance = F.greatest(divided(wxx, w) - mean * mean, F.lit(0.0)) * w * w / F.when(rest > 1e-12 * w * w, rest)
        out |= {f"ewm_{span}": F.col("_base") + mean, f"ewm_std_{span}": F.sqrt(variance)}
    return df.withColumns(out).drop("_base", "_y", "_first", *terms)


def expanding(df: DataFrame, aggregates: list[str], shift: int = 1) -> DataFrame:
    """exp_{aggregate} and exp_count over all rows up to shift before."""
    w = by_key().rowsBetween(W.unboundedPreceding, -shift)
    df = moving_quantiles(df, {"exp_median": (TARGET, None, -shift, 0.5)}) if "median" in aggregates else df
    return df.withColumns({f"exp_{a}": AGGREGATES[a](TARGET).over(w) for a in aggregates if a != "median"} | {"exp_count": F.count(TARGET).over(w)})


def rolling_volatility(df: DataFrame, windows: list[int], shift: int = 1) -> DataFrame:
    """cv_n, range_n and iqr_n (of the interpolated quartiles) over the n rows that end shift rows before."""
    df = moving_quantiles(df, {f"_q{q}_{n}": (TARGET, -(n + shift - 1), -shift, q / 4) for n in windows for q in (1, 3)})
    out = {}
    for n in windows:
        w = by_key().rowsBetween(-(n + shift - 1), -shift)
        out |= {f"cv_{n}": divided(F.stddev_samp(TARGET).over(w), F.avg(TARGET).over(w)), f"range_{n}": F.max(TARGET).over(w) - F.min(TARGET).over(w), f"iqr_{n}": F.col(f"_q3_{n}") - F.col(f"_q1_{n}")}
    return df.withColumns(out).drop(*[f"_q{q}_{n}" for n in windows for q in (1, 3)])


def trend(df: DataFrame, steps: list[int]) -> DataFrame:
    out = {}
    for n in steps:
        d = lagged(1) - lagged(1 + n)
        out |= {f"change_{n}": d, f"pct_change_{n}": divided(d, lagged(1 + n)), f"direction_{n}": F.signum(d).cast("int")}
    return df.withColumns(out)


def detrend(df: DataFrame, window: int = 13) -> DataFrame:
    """Residuals of the key's regression line and of a centred moving average; they use the whole series."""
    whole = W.partitionBy(KEY)
    slope, level = F.regr_slope(TARGET, TIME).over(whole), F.regr_intercept(F.col(TARGET), F.col(TIME)).over(whole)
    half = window // 2
    return df.withColumns({"linear_residual": F.col(TARGET) - (level + slope * F.col(TIME)), "ma_residual": F.col(TARGET) - F.avg(TARGET).over(by_key().rowsBetween(-half, half))})


def trajectory(df: DataFrame) -> DataFrame:
    """Ratios of means of the last 4, 13 and 52 rows, this one included."""
    m = {n: framed(F.avg(TARGET), 1 - n, 0, least) for n, least in ((4, 2), (13, 3), (52, 10))}
    sd = framed(F.stddev_samp(TARGET), -12, 0, 3)
    return df.withColumns({"trend_4_13": m[4] - m[13], "trend_13_52": m[13] - m[52], "accel": m[4] - 2 * m[13] + m[52], "cv13": clip(divided(sd, m[13]), 0, 10), "recent_long": clip(divided(m[4], m[52]), 0, 10)})


def backward_panel(df: DataFrame, lags: list[int], signals: list[str], windows: list[int]) -> DataFrame:
    """What the pooled forecasts use: lags, lags of further signals, means and deviations, share of zeros, ratio to last year."""
    out = {f"lag_{n}": lagged(n) for n in lags} | {f"{s}_lag_{n}": lagged(n, s) for s in signals for n in (1, 4, 13)}
    out |= {f"rmean_{n}": framed(F.avg(TARGET), -n, -1) for n in windows} | {f"rstd_{n}": framed(F.stddev_samp(TARGET), -n, -1, 2) for n in windows}
    zero = F.avg((F.col(TARGET) == 0).cast("int"))
    return df.withColumns(out | {"zerofrac_26": framed(zero, -26, -1), "sply_ratio": (lagged(1) + 1) / (lagged(52) + 1)})


def regime(df: DataFrame, lag: int = 1, short: int = 4, long: int = 13) -> DataFrame:
    """Short against long windows behind the lag: growth, volatility, momentum, level shift and zero rates, clipped."""
    m = {n: framed(F.avg(TARGET), -(n + lag - 1), -lag) for n in (short, long)}
    sd = {n: framed(F.stddev_samp(TARGET), -(n + lag - 1), -lag, 2) for n in (short, long)}
    ratio, change = divided(m[short], m[long]), divided(m[short] - m[long], m[long])
    zero = {n: framed(F.avg((F.col(TARGET) == 0).cast("int")), -(n + lag - 1), -lag) for n in (short, long)}
    return df.withColumns({
        "growth_ratio": clip(ratio, 0, 5), "growing": (m[short] > m[long]).cast("int"), "volatility_ratio": clip(divided(sd[short], sd[long]), 0, 10), "volatile": (sd[short] > sd[long]).cast("int"),
        "momentum": clip(change, -2, 2), "direction": F.signum(m[short] - m[long]).cast("int"), "level_shift": clip(divided(m[short] - m[long], sd[long]), -3, 3), "zero_short": zero[short], "zero_long": zero[long],
    })


def promo_lift(df: DataFrame, flags: list[str], lag: int = 1, least: int = 8, recent: int = 13, lo: float = 0.2, hi: float = 5.0) -> DataFrame:
    """Mean demand with a promotion over without, in all history behind the lag and in its last weeks; 1 while history is short or one side is empty."""
    on = F.greatest(*[F.coalesce(F.col(f), F.lit(0)) for f in flags], F.lit(0)) > 0
    df = df.withColumn("promo_any", on.cast("int"))

    def lift(w) -> tuple[Column, Column]:  # noqa: ANN001
        with_, without = F.avg(F.when(F.col("promo_any") == 1, F.col(TARGET))).over(w), F.avg(F.when(F.col("promo_any") == 0, F.col(TARGET))).over(w)
        n = F.count(TARGET).over(w)
        raw = F.when(n >= least, divided(with_, without))
        return F.coalesce(clip(raw, lo, hi), F.lit(1.0)), n

    (whole, n), (late, _) = lift(by_key().rowsBetween(W.unboundedPreceding, -lag)), lift(by_key().rowsBetween(-lag - recent + 1, -lag))
    return df.withColumns({"promo_lift": whole, "promo_lift_recent": late, "promo_history": (n >= least).cast("int")})


def adstock(df: DataFrame, column: str, decays: list[float], reach: int = 8) -> DataFrame:
    """Decaying sums of a signal up to this row, and its share of active weeks in the last 13."""
    out = {f"adstock_{int(d * 100)}": sum((F.coalesce(F.lag(column, i).over(by_key()), F.lit(0)) * d**i for i in range(1, reach)), F.col(column) * 1.0) for d in decays}
    return df.withColumns(out | {"promo_frequency": F.avg((F.col(column) > 0).cast("int")).over(by_key().rowsBetween(-12, 0))})


def intermittency(df: DataFrame, window: int = 13) -> DataFrame:
    """Whether the previous row had demand, rows since the last, frequency, and size of demands behind this row."""
    sold = F.col(TARGET) > 0
    past, near = by_key().rowsBetween(W.unboundedPreceding, -1), by_key().rowsBetween(-window, -1)
    df = df.withColumn("_pos", F.row_number().over(by_key())).withColumn("_hit", F.when(sold, F.col("_pos"))).withColumn("_size", F.when(sold, F.col(TARGET)))
    n = F.count("_size").over(past)
    out = {
        "occurred": (lagged(1) > 0).cast("int"), "since_last": F.col("_pos") - F.max("_hit").over(past), f"frequency_{window}": divided(F.count("_size").over(near), F.count(TARGET).over(near)),
        "size_mean": F.avg("_size").over(past), "size_std": F.stddev_samp("_size").over(past), "size_last": F.last("_size", ignorenulls=True).over(past),
        "adi": (F.max("_hit").over(past) - F.min("_hit").over(past)) / F.when(n > 1, n - 1),
    }
    return df.withColumns(out).drop("_pos", "_hit", "_size")


def sparsity(df: DataFrame, cap: int = 52) -> DataFrame:
    """Order sizes behind this row, the signed run of the previous rows with or without demand, and regularity of intervals."""
    past = by_key().rowsBetween(W.unboundedPreceding, -1)
    sold = F.col(TARGET) > 0
    df = df.withColumn("_pos", F.row_number().over(by_key())).withColumn("_turn", F.when(sold != F.lag(sold).over(by_key()), 1).otherwise(0))
    df = df.withColumn("_run", F.sum("_turn").over(by_key())).withColumn("_gap", F.when(sold, F.col("_pos") - F.max(F.when(sold, F.col("_pos"))).over(past)))
    streak = F.row_number().over(W.partitionBy(KEY, "_run").orderBy(TIME))
    df = df.withColumn("_streak", F.when(sold, streak).otherwise(-streak)).withColumn("_size", F.when(sold, F.col(TARGET)))
    gap_cv = F.stddev_samp("_gap").over(past) / F.when(F.avg("_gap").over(past) > 0, F.avg("_gap").over(past))
    out = {
        "weeks_since": F.least(F.col("_pos") - F.max(F.when(sold, F.col("_pos"))).over(past), F.lit(cap)), "probability": F.count("_size").over(past) / F.when(F.count(TARGET).over(past) > 0, F.count(TARGET).over(past)),
        "order_cv": F.stddev_samp("_size").over(past) / F.avg("_size").over(past), "streak": F.lag("_streak").over(by_key()), "consistency": 1 / (1 + gap_cv),
    }
    # Last, since what follows it would be shuffled anew.
    return moving_quantiles(df.withColumns(out).drop("_pos", "_turn", "_run", "_gap", "_streak"), {"order_median": ("_size", None, -1, 0.5)}).drop("_size")


def rolling_slope(df: DataFrame, window: int) -> DataFrame:
    """Regression slope over the last rows, this one included, from half a window on."""
    df = df.withColumn("_pos", F.row_number().over(by_key()))
    return df.withColumn(f"slope_{window}", framed(F.regr_slope(F.col(TARGET), F.col("_pos")), 1 - window, 0, max(2, window // 2))).drop("_pos")


def rolling_cv(df: DataFrame, windows: list[int]) -> DataFrame:
    """Coefficient of variation of the last rows, this one included, with 60 % of them there."""
    return df.withColumns({f"cv_{n}": divided(framed(F.stddev_samp(TARGET), 1 - n, 0, math.ceil(0.6 * n)), F.avg(TARGET).over(by_key().rowsBetween(1 - n, 0))) for n in windows})


def level_shifts(df: DataFrame, window: int = 13, threshold: float = 2.0) -> DataFrame:
    """shift_z: mean of the last rows against that a window before, in their deviations; flagged beyond the threshold, from three windows on."""
    w = by_key().rowsBetween(1 - window, 0)
    df = df.withColumn("_m", F.avg(TARGET).over(w)).withColumn("_s", F.stddev_samp(TARGET).over(w)).withColumn("_n", F.row_number().over(by_key()))
    z = F.when(F.col("_n") >= 3 * window, divided(F.col("_m") - F.lag("_m", window).over(by_key()), F.col("_s")))
    return df.withColumn("shift_z", z).withColumn("shifted", F.coalesce(F.abs("shift_z") > threshold, F.lit(False))).drop("_m", "_s", "_n")


def event_distance(df: DataFrame, dates: list[int], time: str = TIME) -> DataFrame:
    """Whether this is one of the given periods, and how far the nearest one is."""
    near = F.array_min(F.transform(F.array(*[F.lit(d) for d in dates]), lambda d: F.abs(d - F.col(time))))
    return df.withColumn("event_distance", near).withColumn("is_event", (F.col("event_distance") == 0).cast("int"))


def recency_weights(df: DataFrame, halflife: float, time: str = TIME) -> DataFrame:
    """Halves with each half-life before the last period."""
    last = df.agg(F.max(time).alias("_last"))
    return df.join(F.broadcast(last), F.lit(True)).withColumn("weight", clip(F.pow(F.lit(0.5), (F.col("_last") - F.col(time)) / halflife), 1e-6, 1.0)).drop("_last")


def transform_target(df: DataFrame, kind: str) -> DataFrame:
    """transformed: log, difference, seasonal (52 rows), standard, or box-cox of y + 1 with the exponent of the best likelihood in steps of a tenth."""
    y, whole = F.col(TARGET), W.partitionBy(KEY)
    if kind == "log":
        return df.withColumn("transformed", F.log1p(y))
    if kind == "difference":
        return df.withColumn("transformed", y - lagged(1))
    if kind == "seasonal":
        return df.withColumn("transformed", y - lagged(52))
    if kind == "standard":
        return df.withColumn("transformed", divided(y - F.avg(y).over(whole), F.stddev_samp(y).over(whole)))
    grid = [i / 10 for i in range(-20, 21)]
    power = lambda e: F.log1p(y) if e == 0 else (F.pow(y + 1, F.lit(e)) - 1) / e
    scores = df.groupBy(KEY).agg(*[((e - 1) * F.sum(F.log1p(y)) - F.count(y) / 2 * F.log(F.when(F.var_pop(power(e)) > 0, F.var_pop(power(e))))).alias(f"s{i}") for i, e in enumerate(grid)])
    best = scores.select(KEY, F.array_max(F.array(*[F.struct(F.coalesce(f"s{i}", F.lit(float("-inf"))).alias("s"), F.lit(e).alias("e")) for i, e in enumerate(grid)]))["e"].alias("exponent"))
    e = F.col("exponent")
    return df.join(best, KEY).withColumn("transformed", F.when(e == 0, F.log1p(y)).otherwise((F.pow(y + 1, e) - 1) / F.when(e != 0, e)))


def restored(df: DataFrame, kind: str) -> DataFrame:
    """restored: y again out of transformed, for log and difference (whose first value is kept in y)."""
    if kind == "log":
        return df.withColumn("restored", F.expm1("transformed"))
    first = F.first(TARGET).over(by_key().rowsBetween(W.unboundedPreceding, 0))
    return df.withColumn("restored", first + F.coalesce(F.sum("transformed").over(by_key().rowsBetween(W.unboundedPreceding, 0)), F.lit(0.0)))
