"""Demand profiles: statistics per key or group, classes, seasonality, outliers, life cycle."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from demandloom.operators import ranks
from demandloom.operators.selection import group_quantiles, null_safe
from demandloom.operators.windows import by_key, clip, correlated, divided

KEY, TIME, TARGET = "key", "week_idx", "y"
#: A series has no season below so many values; of so many strongest frequencies periods are taken.
LEAST_ROWS, STRONGEST = 20, 5


def sold(target: str = TARGET) -> Column:
    """The value where there was demand."""
    return F.when(F.col(target) > 0, F.col(target))


def series_statistics(df: DataFrame) -> DataFrame:
    """statistics() with tier by terciles of the total."""
    out = ranks.with_quantiles(statistics(df), "total", [0.33, 0.67], ["_lo", "_hi"])
    return out.withColumn("tier", F.when(F.col("total") <= F.col("_lo"), "low").when(F.col("total") <= F.col("_hi"), "medium").otherwise("high")).drop("_lo", "_hi")


def statistics(df: DataFrame) -> DataFrame:
    """One row per key: n, mean, sd, least, most, zero_fraction, total, cv, cv2 (with zeros), adi (mean gap between demands, n without two).

    The gaps between first and last demand add up to the distance of their positions, so that one aggregation gives all.
    """
    pos, hit = F.col("_pos"), F.col(TARGET) > 0
    gaps = F.try_divide(F.max(F.when(hit, pos)) - F.min(F.when(hit, pos)), F.count_if(hit) - 1)
    out = df.withColumn("_pos", F.row_number().over(by_key())).groupBy(KEY).agg(gaps.alias("_adi"), F.count("*").alias("n"), F.avg(TARGET).alias("mean"), F.stddev_samp(TARGET).alias("sd"), F.min(TARGET).alias("least"), F.max(TARGET).alias("most"), F.avg((F.col(TARGET) == 0).cast("int")).alias("zero_fraction"), F.sum(TARGET).alias("total"))
    out = out.withColumn("adi", F.coalesce("_adi", F.col("n").cast("double"))).withColumn("cv", divided(F.col("sd"), F.col("mean"))).withColumn("cv2", F.col("cv") * F.col("cv"))
    return out.drop("_adi")


def demand_class(adi: Column, cv2: Column, adi_edge: float = 1.32, cv2_edge: float = 0.49, strict: bool = False) -> Column:
    """smooth, erratic, intermittent or lumpy; edges belong to the lower side unless strict."""
    low = lambda c, edge: c < edge if strict else c <= edge
    return F.when(low(adi, adi_edge), F.when(low(cv2, cv2_edge), "smooth").otherwise("erratic")).otherwise(F.when(low(cv2, cv2_edge), "intermittent").otherwise("lumpy"))


def volatility(df: DataFrame, by: list[str], least: int = 1, time: str = TIME) -> DataFrame:
    """Per group: weeks, total, mean, sd, nz_mean, nz_sd, zeros, most, cv, cv2_nz, adi (weeks per sale), class; measures null below `least` weeks."""
    out = df.groupBy(*by).agg(F.count("*").alias("weeks"), F.sum(TARGET).alias("total"), F.avg(TARGET).alias("mean"), F.stddev_samp(TARGET).alias("sd"), F.avg(sold()).alias("nz_mean"), F.stddev_samp(sold()).alias("nz_sd"), F.count_if(F.col(TARGET) == 0).alias("zeros"), F.max(TARGET).alias("most"), F.count(sold()).alias("_nz"))
    enough = F.col("weeks") >= least
    out = out.withColumns({"cv": F.when(enough, divided(F.col("sd"), F.col("mean"))), "cv2_nz": F.when(enough, F.pow(divided(F.col("nz_sd"), F.col("nz_mean")), F.lit(2.0))), "adi": F.when(enough, divided(F.col("weeks").cast("double"), F.col("_nz")))})
    return out.withColumn("class", F.when(F.col("adi").isNull() | F.col("cv2_nz").isNull(), "noclass").otherwise(demand_class(F.col("adi"), F.col("cv2_nz"), strict=True))).drop("_nz")


def trailing_by_month(df: DataFrame, window: int = 13, date: str = "week_start") -> DataFrame:
    """key, month (its first day), cv, adi of the last rows as of the month's last row."""
    w = by_key().rowsBetween(1 - window, 0)
    rows = df.withColumn("month", F.trunc(date, "month")).withColumn("cv", divided(F.stddev_samp(TARGET).over(w), F.avg(TARGET).over(w))).withColumn("adi", divided(F.count(TARGET).over(w).cast("double"), F.count(sold()).over(w)))
    return rows.withColumn("_r", F.row_number().over(W.partitionBy(KEY, "month").orderBy(F.desc(TIME)))).where("_r = 1").select(KEY, "month", "cv", "adi")


CLASSES = ["smooth", "erratic", "intermittent", "lumpy", "noclass"]


def class_counts(df: DataFrame, by: str) -> DataFrame:
    """by, one column per class with its number of keys, total."""
    return df.groupBy(by).pivot("class", CLASSES).agg(F.count_distinct(KEY)).fillna(0, CLASSES).withColumn("total", sum((F.col(c) for c in CLASSES[1:]), F.col(CLASSES[0])))


def high_volatility(df: DataFrame, by: str, threshold: float = 1.0) -> DataFrame:
    """by, n_keys, n_high, n_lumpy, n_erratic, high_share."""
    return df.groupBy(by).agg(F.count("*").alias("n_keys"), F.count_if(F.col("cv") > threshold).alias("n_high"), F.count_if(F.col("class") == "lumpy").alias("n_lumpy"), F.count_if(F.col("class") == "erratic").alias("n_erratic")).withColumn("high_share", divided(F.col("n_high").cast("double"), F.col("n_keys")))


def distribution(df: DataFrame, by: list[str], column: str, at: tuple[float, ...] = (0.5, 0.75, 0.9, 0.95)) -> DataFrame:
    """n, mean, sd, skew, kurt and exact percentiles p50 .. per group."""
    moments = df.groupBy(*by).agg(F.count(column).alias("n"), F.avg(column).alias("mean"), F.stddev_samp(column).alias("sd"), F.skewness(column).alias("skew"), F.kurtosis(column).alias("kurt"))
    return null_safe(moments, group_quantiles(df, by, column, {f"p{round(q * 100)}": q for q in at}).drop("n"), by)


def group_outliers(df: DataFrame, by: str, method: str, threshold: float, column: str = TARGET) -> DataFrame:
    """df with lo, hi, outlier per group: iqr, zscore or mad (0.6745 (x - median) / mad)."""
    if method == "mad":
        middle = group_quantiles(df, [by], column, {"_m": 0.5}).drop("n")
        spread = null_safe(group_quantiles(null_safe(df, middle, [by]), [by], F.abs(F.col(column) - F.col("_m")), {"_d": 0.5}).drop("n"), middle, [by])
        bounds = spread.select(by, (F.col("_m") - threshold * F.col("_d") / 0.6745).alias("lo"), (F.col("_m") + threshold * F.col("_d") / 0.6745).alias("hi"))
    elif method == "zscore":
        bounds = df.groupBy(by).agg((F.avg(column) - threshold * F.stddev_samp(column)).alias("lo"), (F.avg(column) + threshold * F.stddev_samp(column)).alias("hi"))
    else:
        q = group_quantiles(df, [by], column, {"_q1": 0.25, "_q3": 0.75})
        bounds = q.select(by, (F.col("_q1") - threshold * (F.col("_q3") - F.col("_q1"))).alias("lo"), (F.col("_q3") + threshold * (F.col("_q3") - F.col("_q1"))).alias("hi"))
    return df.join(bounds, by).withColumn("outlier", (F.col(column) < F.col("lo")) | (F.col(column) > F.col("hi")))


def autocorrelations(df: DataFrame, lags: list[int]) -> DataFrame:
    """key, acf_n: correlation with the value n rows before; null for keys with fewer rows than the longest lag and five."""
    rows = df.withColumns({f"_l{n}": F.lag(TARGET, n).over(by_key()) for n in lags})
    return rows.groupBy(KEY).agg(*[F.when(F.count("*") >= max(lags) + 5, correlated(TARGET, f"_l{n}")).alias(f"acf_{n}") for n in lags])


def trend_strength(df: DataFrame, window: int = 13) -> DataFrame:
    """key, strength: 1 - variance without the centred mean over variance, at least 0; null below two windows."""
    half = window // 2
    w = by_key().rowsBetween(-half, half)
    rest = F.when(F.count(TARGET).over(w) == window, F.col(TARGET) - F.avg(TARGET).over(w))
    rows = df.withColumn("_d", rest)
    enough = (F.count("*") >= 2 * window) & (F.count("_d") >= 10)
    return rows.groupBy(KEY).agg(F.when(enough, F.greatest(F.lit(0.0), 1 - divided(F.var_samp("_d"), F.var_samp(F.when(F.col("_d").isNotNull(), F.col(TARGET)))))).alias("strength"))


def seasonal_indices(df: DataFrame, week: Column) -> DataFrame:
    """week, index (mean over overall mean), variation."""
    overall = df.agg(F.avg(TARGET).alias("_g"))  # one row
    return df.groupBy(week.alias("week")).agg(F.avg(TARGET).alias("_m"), F.stddev_samp(TARGET).alias("_s")).join(F.broadcast(overall), F.lit(True)).select("week", divided(F.col("_m"), F.col("_g")).alias("index"), divided(F.col("_s"), F.col("_m")).alias("variation"))


def decompose(df: DataFrame, period: int = 52) -> DataFrame:
    """Additive: trend (centred mean of a whole season), seasonal (mean rest by place in the season), residual."""
    half = period // 2
    w = by_key().rowsBetween(-half, half)
    rows = df.withColumn("trend", F.when(F.count(TARGET).over(w) == 2 * half + 1, F.avg(TARGET).over(w))).withColumn("_p", F.col(TIME) % period)
    rows = rows.withColumn("seasonal", F.avg(F.col(TARGET) - F.col("trend")).over(W.partitionBy(KEY, "_p")))
    return rows.withColumn("residual", F.col(TARGET) - F.col("trend") - F.col("seasonal")).drop("_p")


def decompose_by_ratio(df: DataFrame, period: int = 52) -> DataFrame:
    """Multiplicative: trend (centred mean of a whole season), seasonal (mean ratio to it by place in the season, with a mean of 1 over the places), residual (what is left as a factor)."""
    half = period // 2
    w = by_key().rowsBetween(-half, half)
    rows = df.withColumn("trend", F.when(F.count(TARGET).over(w) == 2 * half + 1, F.avg(TARGET).over(w))).withColumn("_p", F.col(TIME) % period)
    places = rows.groupBy(KEY, "_p").agg(F.avg(divided(F.col(TARGET), F.col("trend"))).alias("seasonal"))  # `period` rows a key
    places = places.withColumn("seasonal", divided(F.col("seasonal"), F.avg("seasonal").over(W.partitionBy(KEY))))
    return rows.join(places, [KEY, "_p"], "left").withColumn("residual", divided(F.col(TARGET), F.col("trend") * F.col("seasonal"))).drop("_p")


def component_strengths(parts: DataFrame) -> DataFrame:
    """key, trend_strength, seasonal_strength: 1 less the variance of the residual over that of the residual with the component, no less than 0, over rows that have all three."""
    there = F.col("trend").isNotNull() & F.col("seasonal").isNotNull() & F.col("residual").isNotNull()
    strength = lambda c: F.greatest(F.lit(0.0), 1 - F.var_pop("residual") / (F.var_pop(F.col(c) + F.col("residual")) + 1e-10))
    return parts.where(there).groupBy(KEY).agg(strength("trend").alias("trend_strength"), strength("seasonal").alias("seasonal_strength"))


def spectral(y: np.ndarray, most: int, top: int, least_strength: float, least_share: float) -> dict:
    """Of one series: its strongest periods with their shares of all power, and what follows for it as a whole."""
    n = len(y)
    out = {"periods": [], "dominant": None, "strength": 0.0, "seasonal": False}
    if n < LEAST_ROWS:
        return out
    power = np.abs(np.fft.rfft(y - y.mean())[: n // 2]) ** 2
    power[0] = 0.0
    first = np.lexsort((np.arange(1, len(power)), -power[1:]))[:STRONGEST] + 1
    bound = n // 2 if n < most else most
    found = [(n / k, power[k] / (power.sum() + 1e-10)) for k in first.tolist() if 2 <= n / k <= bound]
    # Halves go to the even digit after scaling, as in SQL: 357 / 20 is 17.8, for Python's own round, which sees 17.850000000000001, 17.9.
    out["periods"] = [{"period": float(np.round(p, 1)), "share": float(np.round(s, 4))} for p, s in found[:top]]
    if found:
        out["dominant"] = lag = round(out["periods"][0]["period"])
        a, b = y[lag:], y[:-lag]
        alike = np.corrcoef(a, b)[0, 1] if len(a) > 1 and a.std() > 0 and b.std() > 0 else 0.0
        strength = (max(0.0, float(alike)) + out["periods"][0]["share"]) / 2
        out["strength"], out["seasonal"] = strength, bool(strength >= least_strength and out["periods"][0]["share"] >= least_share)
    return out


def seasonality(df: DataFrame, most: int = 104, top: int = 3, least_strength: float = 0.1, least_share: float = 0.05) -> DataFrame:
    """key, rank, period, share, dominant, strength, seasonal: the strongest periods of each key's series, one row without rank, period and share if there are none.

    Of the five strongest frequencies below the highest one those with a period of 2 to `most` rows (half the series if that is shorter) are taken; share: of the power of all. strength: the mean
    of the dominant period's autocorrelation, no less than 0, and its share; seasonal: both thresholds are met. Series of fewer than 20 values have none. A series is one array.
    """
    series = df.where(F.col(TARGET).isNotNull()).groupBy(KEY).agg(F.transform(F.array_sort(F.collect_list(F.struct(TIME, F.col(TARGET).cast("double").alias("y")))), lambda s: s["y"]).alias("ys"))
    kind = pa.struct([("periods", pa.list_(pa.struct([("period", pa.float64()), ("share", pa.float64())]))), ("dominant", pa.int32()), ("strength", pa.float64()), ("seasonal", pa.bool_())])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column("ys")
            flat, ends = lists.flatten().to_numpy(), np.cumsum(np.asarray(lists.value_lengths()))
            found = [spectral(y, most, top, least_strength, least_share) for y in np.split(flat, ends[:-1])] if len(ends) else []
            yield pa.RecordBatch.from_arrays([b.column(KEY), pa.array(found, kind)], [KEY, "s"])

    key_type = dict(df.dtypes)[KEY]
    out = series.mapInArrow(each, f"{KEY} {key_type}, s struct<periods: array<struct<period: double, share: double>>, dominant: int, strength: double, seasonal: boolean>")
    rows = out.select(KEY, "s", F.posexplode_outer("s.periods").alias("_k", "_p"))
    return rows.select(KEY, (F.col("_k") + 1).alias("rank"), "_p.period", "_p.share", "s.dominant", "s.strength", "s.seasonal")


def seasonality_shape(df: DataFrame, season: int = 52, harmonics: int = 3) -> DataFrame:
    """key, amp_k, phase_k of the first harmonics of a season, and the strongest one."""
    out = []
    for k in range(1, harmonics + 1):
        angle = 2 * math.pi * k * F.col(TIME) / season
        out += [F.avg((F.col(TARGET) - F.col("_m")) * F.cos(angle)).alias(f"_a{k}"), F.avg((F.col(TARGET) - F.col("_m")) * F.sin(angle)).alias(f"_b{k}")]
    rows = df.withColumn("_m", F.avg(TARGET).over(W.partitionBy(KEY))).groupBy(KEY).agg(*out)
    amp = lambda k: 2 * F.sqrt(F.col(f"_a{k}") ** 2 + F.col(f"_b{k}") ** 2)
    rows = rows.withColumns({f"amp_{k}": amp(k) for k in range(1, harmonics + 1)} | {f"phase_{k}": F.atan2(f"_b{k}", f"_a{k}") for k in range(1, harmonics + 1)})
    best = F.array_position(F.array(*[F.col(f"amp_{k}") for k in range(1, harmonics + 1)]), F.greatest(*[F.col(f"amp_{k}") for k in range(1, harmonics + 1)]))
    return rows.withColumn("dominant", best.cast("int")).drop(*[f"_{x}{k}" for k in range(1, harmonics + 1) for x in "ab"])


def trend_direction(df: DataFrame, last: int, recent: int = 13, least: int = 5) -> DataFrame:
    """key, slope and recent_slope (of the last rows; the whole one's below `least`) over the mean, acceleration (their difference), direction beyond half a per cent, recent_long: mean of the last rows over that of
    those before (over all without any), within 0.1 and 10. Rows up to `last`, numbered without gaps."""
    rows = df.where(F.col(TIME) <= last).withColumn("_i", F.row_number().over(by_key())).withColumn("_near", F.row_number().over(W.partitionBy(KEY).orderBy(F.desc(TIME))) <= recent)
    y, x, near = F.col(TARGET), F.col("_i"), F.col("_near")
    out = rows.groupBy(KEY).agg(
        F.regr_slope(y, x).alias("_s"), F.regr_slope(F.when(near, y), F.when(near, x)).alias("_r"), F.count(F.when(near, y)).alias("_k"), F.avg(y).alias("_m"), F.avg(F.when(near, y)).alias("_n"), F.avg(F.when(~near, y)).alias("_o")
    )
    slope = divided(F.col("_s"), F.col("_m"))
    late = F.when(F.col("_k") >= least, divided(F.col("_r"), F.col("_m"))).otherwise(slope)
    return out.select(
        KEY, slope.alias("slope"), late.alias("recent_slope"), (late - slope).alias("acceleration"), F.when(slope > 0.005, "up").when(slope < -0.005, "down").otherwise("flat").alias("direction"),
        clip(divided(F.col("_n"), F.coalesce("_o", "_m")), 0.1, 10).alias("recent_long"),
    )


def predictability(df: DataFrame, lag: int = 1) -> DataFrame:
    """key, score: 0.4 of the autocorrelation, 0.4 of 1 / (1 + cv), 0.2 of the share of demands."""
    acf = autocorrelations(df, [lag])
    s = df.groupBy(KEY).agg(divided(F.stddev_samp(TARGET), F.avg(TARGET)).alias("_cv"), F.avg((F.col(TARGET) == 0).cast("int")).alias("_z"))
    return s.join(acf, KEY).select(KEY, (0.4 * F.greatest(F.coalesce(f"acf_{lag}", F.lit(0.0)), F.lit(0.0)) + 0.4 / (1 + F.coalesce("_cv", F.lit(0.0))) + 0.2 * (1 - F.col("_z"))).alias("score"))


def cross_correlation(df: DataFrame, keys: int, limit: float) -> DataFrame:
    """a, b, corr of pairs among the `keys` largest series beyond the limit, on the periods both have."""
    top = df.groupBy(KEY).agg(F.sum(TARGET).alias("t")).orderBy(F.desc("t"), KEY).limit(keys).select(KEY)
    rows = df.join(top, KEY, "left_semi").select(KEY, TIME, TARGET)
    other = rows.select(F.col(KEY).alias("b"), TIME, F.col(TARGET).alias("_o"))
    return rows.join(other, TIME).where(F.col(KEY) < F.col("b")).groupBy(F.col(KEY).alias("a"), "b").agg(correlated(TARGET, "_o").alias("corr")).where(F.abs("corr") > limit)


def response_profile(df: DataFrame, columns: list[str], least: int = 10, constant: float | None = None) -> DataFrame:
    """key, corr_<column>, the mean and greatest strength, and n_strong: how many are over 0.2.

    constant: correlation of constant columns. They have no strength if it is null, as in the reference; NaN counts as SQL takes it, greater than any number.
    """
    out = df.groupBy(KEY).agg(*[F.when(F.count(F.when(F.col(c).isNotNull() & F.col(TARGET).isNotNull(), 1)) >= least, correlated(c, TARGET, constant)).alias(f"corr_{c}") for c in columns])
    strength = [F.coalesce(F.abs(f"corr_{c}"), F.lit(0.0)) for c in columns]
    return out.withColumn("mean_strength", sum(strength[1:], strength[0]) / len(columns)).withColumn("max_strength", F.greatest(*strength, F.lit(0.0))).withColumn("n_strong", sum(((s > 0.2).cast("int") for s in strength[1:]), (strength[0] > 0.2).cast("int")))


def granularity(df: DataFrame, date: str) -> DataFrame:
    """One row: median gap of the distinct dates in days, its name and season."""
    d = df.select(F.col(date).cast("date").alias("d")).distinct()
    gaps = d.select(F.datediff("d", F.lag("d").over(W.orderBy("d"))).alias("g"))  # one row per date
    m = F.col("gap")
    name = F.when(m <= 1, "daily").when(m <= 8, "weekly").when(m <= 35, "monthly").when(m <= 100, "quarterly").otherwise("yearly")
    return gaps.agg(F.percentile("g", 0.5).alias("gap")).select("gap", name.alias("granularity"), F.when(m <= 1, 7).when(m <= 8, 52).when(m <= 35, 12).when(m <= 100, 4).otherwise(1).alias("season"))


def dead_keys(df: DataFrame, end: int, zeros: int = 26) -> DataFrame:
    """key, zero_run: keys whose last rows up to `end` are at least so many zeros (nulls count as zero)."""
    rows = df.where(F.col(TIME) <= end).withColumn("_p", F.row_number().over(by_key()))
    run = rows.groupBy(KEY).agg((F.max("_p") - F.coalesce(F.max(F.when(F.coalesce(TARGET, F.lit(0.0)) != 0, F.col("_p"))), F.lit(0))).alias("zero_run"))
    return run.where(F.col("zero_run") >= zeros)


def recent_zero_keys(df: DataFrame, last: int, lookback: int = 52, threshold: float = 0.0) -> DataFrame:
    """Keys whose demand of the last periods doesn't exceed the threshold, those without rows there included."""
    return df.groupBy(KEY).agg(F.coalesce(F.sum(F.when(F.col(TIME) > last - lookback, F.col(TARGET))), F.lit(0.0)).alias("recent")).where(F.col("recent") <= threshold)


def new_products(df: DataFrame, least: int = 13) -> DataFrame:
    return df.groupBy(KEY).agg(F.count_distinct(TIME).alias("n_periods")).where(F.col("n_periods") < least)


def discrete_demand(df: DataFrame) -> DataFrame:
    """key, n_levels, base (the smallest demand), multiple_share (demands near a multiple of it), discrete. Equal demands of a key are counted first."""
    levels = df.where(F.col(TARGET) > 0).groupBy(KEY, TARGET).agg(F.count("*").alias("_c"))
    out = levels.groupBy(KEY).agg(F.count("*").alias("n_levels"), F.sum("_c").alias("_n"), F.min(TARGET).alias("base"), F.collect_list(F.struct(F.col(TARGET).alias("y"), F.col("_c").alias("c"))).alias("_l"))
    off = lambda s: F.abs(s["y"] / F.col("base") - F.round(s["y"] / F.col("base")))
    near = F.aggregate("_l", F.lit(0).cast("long"), lambda a, s: a + F.when(off(s) < 0.1, s["c"]).otherwise(F.lit(0).cast("long")))
    out = out.withColumn("multiple_share", near / F.col("_n"))
    return out.select(KEY, "n_levels", "base", "multiple_share", ((F.col("n_levels") / F.col("_n") < 0.1) | ((F.col("n_levels") <= 20) & (F.col("multiple_share") > 0.8))).alias("discrete"))


def base_unit(df: DataFrame, near: float = 0.05, wider: float = 0.1, share: float = 0.8) -> DataFrame:
    """key, unit: the smallest demand if all demands lie that near a multiple of it, else the smallest gap between levels if the share lies within the wider one, else null."""
    sold_rows = df.where(F.col(TARGET) > 0).select(KEY, F.col(TARGET).cast("double").alias("_y"))
    gaps = sold_rows.distinct().withColumn("_g", F.col("_y") - F.lag("_y").over(W.partitionBy(KEY).orderBy("_y")))
    base = gaps.groupBy(KEY).agg(F.min("_y").alias("_b"), F.min("_g").alias("_g"))
    off = lambda u: F.abs(F.col("_y") / F.col(u) - F.round(F.col("_y") / F.col(u)))
    found = sold_rows.join(base, KEY).groupBy(KEY, "_b", "_g").agg(F.max(off("_b")).alias("_far"), F.avg((off("_g") < wider).cast("int")).alias("_share"))
    return found.select(KEY, F.when(F.col("_far") <= near, F.col("_b")).when(F.col("_share") > share, F.col("_g")).alias("unit"))


def level_shares(df: DataFrame) -> DataFrame:
    """key, level, share of the key's rows, imbalance: the commonest level's rows over the rarest's."""
    n = df.groupBy(KEY, F.col(TARGET).alias("level")).agg(F.count("*").alias("_n"))
    whole = n.groupBy(KEY).agg(F.sum("_n").alias("_t"), F.max("_n").alias("_a"), F.min("_n").alias("_i"))
    return n.join(whole, KEY).select(KEY, "level", (F.col("_n") / F.col("_t")).alias("share"), (F.col("_a") / F.col("_i")).alias("imbalance"))


def quality_score(c: DataFrame, enough: int = 104) -> DataFrame:
    """Adds quality, 0 to 1, to characteristics(): 0.4 for history up to `enough` rows, 0.3 for the share of rows with demand, 0.3 / (1 + cv)."""
    return c.withColumn("quality", 0.4 * F.least(F.col("n") / enough, F.lit(1.0)) + 0.3 * divided(F.col("n_sold").cast("double"), F.col("n")) + 0.3 / (1 + F.coalesce("cv", F.lit(0.0))))


def characteristics(df: DataFrame, features: list[str], constant: float | None = None) -> DataFrame:
    """key, n, n_sold, mean, cv, adi, trend, acf_1, n_related (features with a correlation over 0.3; that of constant ones is `constant`, see response_profile)."""
    rows = df.withColumn("_l", F.lag(TARGET).over(by_key()))
    out = rows.groupBy(KEY).agg(F.count("*").alias("n"), F.count(sold()).alias("n_sold"), F.avg(TARGET).alias("mean"), divided(F.stddev_samp(TARGET), F.avg(TARGET)).alias("cv"), divided(F.count("*").cast("double"), F.count(sold())).alias("adi"), F.regr_slope(F.col(TARGET), F.col(TIME)).alias("trend"), correlated(TARGET, "_l").alias("acf_1"), *[correlated(f, TARGET, constant).alias(f"_c{i}") for i, f in enumerate(features)])
    related = [(F.coalesce(F.abs(f"_c{i}"), F.lit(0.0)) > 0.3).cast("int") for i in range(len(features))]
    return out.withColumn("n_related", sum(related[1:], related[0])).drop(*[f"_c{i}" for i in range(len(features))])


def group_position(df: DataFrame, by: str, value: str = "mean") -> DataFrame:
    """Per key of a key table: size of its group, share of the group's mean, percent rank, spread against the group's."""
    w = W.partitionBy(by)
    return df.withColumns({"group_size": F.count("*").over(w), "group_share": clip(divided(F.col(value), F.sum(value).over(w)), 0, 1), "group_rank": F.percent_rank().over(w.orderBy(value, KEY)), "relative_cv": clip(divided(F.col("cv"), F.avg("cv").over(w)), 0, 10)})


def adaptive_lags(df: DataFrame, candidates: list[int], essential: tuple[int, ...] = (1, 4, 52), most: int = 12) -> DataFrame:
    """key, lags: essential ones and those whose autocorrelation is significant, at most so many: beyond that the essential ones and the most significant."""
    acf, n = autocorrelations(df, candidates), df.groupBy(KEY).agg(F.count("*").alias("_n"))
    hit = [F.when(F.abs(f"acf_{c}") > 1.96 / F.sqrt("_n"), F.lit(c)) for c in candidates]
    return acf.join(n, KEY).select(KEY, chosen_lags([(c, F.when(hit[i].isNotNull(), F.abs(f"acf_{c}"))) for i, c in enumerate(candidates)], essential, most).alias("lags"))


def chosen_lags(found: list[tuple[int, Column]], essential: tuple[int, ...], most: int) -> Column:
    """The essential lags and, up to `most` in all, the others whose strength isn't null, the strongest first; ascending."""
    others = F.array_compact(F.array(*[F.when(s.isNotNull(), F.struct((-s).alias("s"), F.lit(c).alias("lag"))) for c, s in found if c not in essential]))
    strongest = F.transform(F.slice(F.array_sort(others), 1, max(0, most - len(essential))), lambda x: x["lag"])
    return F.array_sort(F.array_distinct(F.concat(F.array(*[F.lit(e) for e in essential]), strongest)))


#: Lags for segments whose series show none, by pattern.
DEFAULT_LAGS = {"smooth": (1, 2, 4, 13, 52), "erratic": (1, 4, 13, 52), "intermittent": (1, 4, 26, 52), "lumpy": (1, 13, 52)}


def segment_lags(df: DataFrame, segments: DataFrame, candidates: list[int], essential: tuple[int, ...] = (1, 4, 52), most: int = 12) -> DataFrame:
    """segment, lags: the essential ones and those where at least half of the segment's keys (those with a value) are significant, by mean strength; if there are none, defaults by pattern.

    segments: key, segment, pattern. A segment's pattern is its commonest.
    """
    n = df.groupBy(KEY).agg(F.count("*").alias("_n"))
    rows = autocorrelations(df, candidates).join(n, KEY).join(segments.select(KEY, "segment", "pattern"), KEY)
    sums = [f for c in candidates for f in (F.avg((F.abs(f"acf_{c}") > 1.96 / F.sqrt("_n")).cast("int")).alias(f"_h{c}"), F.avg(F.abs(f"acf_{c}")).alias(f"_a{c}"))]
    s = rows.groupBy("segment").agg(F.mode("pattern", deterministic=True).alias("_p"), *sums)
    strength = [(c, F.when(F.col(f"_h{c}") >= 0.5, F.col(f"_a{c}"))) for c in candidates]
    default = F.array(*[F.lit(e) for e in essential])
    for name, lags in DEFAULT_LAGS.items():
        default = F.when(F.col("_p") == name, F.array(*[F.lit(x) for x in lags])).otherwise(default)
    none = F.coalesce(*[x for _, x in strength]).isNull()
    return s.select("segment", F.when(none, default).otherwise(chosen_lags(strength, essential, most)).alias("lags"))
