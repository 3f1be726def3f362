"""Cross-sectional, hierarchy, key-level and calendar features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from demandloom.functions import periods
from demandloom.operators import ranks
from demandloom.operators.windows import by_key, clip, correlated, divided


def cross_section(df: DataFrame, time: str = "week_idx", target: str = "y") -> DataFrame:
    """The previous row's value against all keys of the period: mean, relative, difference, z-score, dense percent rank.

    Sums of a period are aggregated and joined back; ranks go by ranges of values: no task orders a whole period.
    """
    rows = df.withColumn("_l", F.lag(target).over(by_key(time=time)))
    sums = rows.groupBy(time).agg(F.avg("_l").alias("period_mean"), F.stddev_samp("_l").alias("_sd"))
    r = ranks.ranks(rows, time, "_l").select(F.col(time).alias("_t"), F.col("_l").alias("_v"), (F.col("dense") / F.col("n_values")).alias("dense_pct"))
    out = rows.join(sums, time, "left").join(r, (F.col(time) == F.col("_t")) & (F.col("_l") == F.col("_v")), "left")
    mean = F.col("period_mean")
    return out.withColumns({"relative": divided(F.col("_l"), mean), "difference": F.col("_l") - mean, "z": divided(F.col("_l") - mean, F.col("_sd"))}).drop("_l", "_sd", "_t", "_v")


def relative(df: DataFrame, group: str, lag: int = 1, time: str = "week_idx", target: str = "y") -> DataFrame:
    """The lagged value against the period's and the group's mean, median, rank and total, joined back as in cross_section()."""
    rows = df.withColumn("_l", F.lag(target, lag).over(by_key(time=time)))
    sums = rows.groupBy(time).agg(F.avg("_l").alias("_m"), F.sum("_l").alias("_s"))
    own = rows.groupBy(time, group).agg(F.avg("_l").alias("_o"))
    found = ranks.ranks(rows, time, "_l")
    medians = ranks.group_medians(found, time, "_l")
    r = found.withColumn("percentile", ranks.average_share(found)).select(F.col(time).alias("_t"), F.col("_l").alias("_v"), "percentile")
    out = rows.join(sums, time, "left").join(own, [time, group], "left").join(medians, time, "left").join(r, (F.col(time) == F.col("_t")) & (F.col("_l") == F.col("_v")), "left")
    added = {"to_overall": clip(divided(F.col("_l"), F.col("_m")), 0, 20), "to_group": clip(divided(F.col("_l"), F.col("_o")), 0, 20), "from_median": F.col("_l") - F.col("median"), "share": clip(divided(F.col("_l"), F.col("_s")), 0, 1)}
    return out.withColumns(added).drop("_l", "_m", "_s", "_o", "median", "_t", "_v")


def group_history(df: DataFrame, group: str, lag: int = 1, windows: tuple[int, ...] = (4, 13), time: str = "week_idx", target: str = "y") -> DataFrame:
    """group_total before the lag and its rolling means, and the key's share of it."""
    totals = df.groupBy(group, time).agg(F.sum(target).alias("_t"))
    w = W.partitionBy(group).orderBy(time)
    totals = totals.select(group, time, F.lag("_t", lag).over(w).alias("group_total"), *[F.avg("_t").over(w.rowsBetween(-(n + lag - 1), -lag)).alias(f"group_mean_{n}") for n in windows])
    own = F.lag(target, lag).over(by_key(time=time))
    return df.withColumn("_own", own).join(totals, [group, time], "left").withColumn("group_share", F.coalesce(clip(divided(F.col("_own"), F.col("group_total")), 0, 1), F.lit(0.0))).drop("_own")


def group_previous_period(df: DataFrame, group: str, time: str = "week_idx", target: str = "y") -> DataFrame:
    """group_before: the group's total a period ago; null where it had no row then."""
    before = df.groupBy(group, (F.col(time) + 1).alias(time)).agg(F.sum(target).alias("group_before"))
    return df.join(before, [group, time], "left")


def cross_account(df: DataFrame, time: str = "week_idx", target: str = "y") -> DataFrame:
    """Of each product and period: total over accounts, accounts that sold, own share."""
    totals = df.groupBy("product", time).agg(F.sum(target).alias("product_total"), F.count_distinct(F.when(F.col(target) > 0, F.col("account"))).alias("breadth"))
    return df.join(totals, ["product", time]).withColumn("account_share", divided(F.col(target), F.col("product_total")))


def key_stats(df: DataFrame, key: str = "key", target: str = "y") -> DataFrame:
    """One row per key: mean, sd, least, most, median, n, cv, zero_fraction."""
    out = df.groupBy(key).agg(F.avg(target).alias("mean"), F.stddev_samp(target).alias("sd"), F.min(target).alias("least"), F.max(target).alias("most"), F.median(target).alias("median"), F.count(target).alias("n"), F.avg((F.col(target) == 0).cast("int")).alias("zero_fraction"))
    return out.withColumn("cv", divided(F.col("sd"), F.col("mean")))


def history_embedding(df: DataFrame, columns: list[str], until: int, key: str = "key", time: str = "week_idx", target: str = "y") -> DataFrame:
    """One row per key: mean, sd, correlation with the target (from five rows on) and slope of each column up to a period."""
    out = []
    for c in columns:
        out += [F.avg(c).alias(f"{c}_mean"), F.stddev_samp(c).alias(f"{c}_sd"), F.when(F.count(c) >= 5, correlated(c, target)).alias(f"{c}_corr"), F.regr_slope(F.col(c), F.col(time)).alias(f"{c}_slope")]
    return df.where(F.col(time) <= until).groupBy(key).agg(*out)


def forecastability(df: DataFrame, last: int, key: str = "key", time: str = "week_idx", target: str = "y") -> DataFrame:
    """One row per key: volume, nz_mean, nz_fraction, adi (rows per sale), cv2 of sales, spike, recent8."""
    size = F.when(F.col(target) > 0, F.col(target))
    out = df.groupBy(key).agg(F.sum(target).alias("volume"), F.avg(size).alias("nz_mean"), (F.count(size) / F.count("*")).alias("nz_fraction"), F.try_divide(F.count("*"), F.count(size)).alias("adi"), F.greatest(F.try_divide(F.count(size) * F.sum(size * size), F.sum(size) * F.sum(size)) - 1, F.lit(0.0)).alias("cv2"), F.try_divide(F.max(target), F.avg(target)).alias("spike"), F.coalesce(F.sum(F.when(F.col(time) > last - 8, F.col(target))), F.lit(0.0)).alias("recent8"))
    return out


def calendar(df: DataFrame, date: str = "week_start") -> DataFrame:
    """Parts of a date: year, quarter, month, week, week_of_month, day_of_year, month_start, month_end."""
    d = F.col(date)
    return df.withColumns({"year": F.year(d), "quarter": F.quarter(d), "month": F.month(d), "week": F.weekofyear(d), "week_of_month": F.floor((F.day(d) - 1) / 7).cast("int") + 1, "day_of_year": F.dayofyear(d), "month_start": (F.day(d) == 1).cast("int"), "month_end": (d == F.last_day(d)).cast("int")})


def fourier(df: DataFrame, column: str, period: float, harmonics: int = 3) -> DataFrame:
    """sin_k and cos_k of so many harmonics."""
    import math

    return df.withColumns({f"{n}_{k}": f(F.col(column) * (2 * math.pi * k / period)) for k in range(1, harmonics + 1) for n, f in (("sin", F.sin), ("cos", F.cos))})


def event_calendar(df_years: DataFrame, year: str = "year") -> DataFrame:
    """year, event, day: Easter and what hangs on it, and fixed days; from a table of years."""
    e = periods.easter(year)
    black_friday = F.date_add(F.next_day(F.make_date(F.col(year), F.lit(10), F.lit(31)), "Thu"), 22)
    days = {"easter": e, "shrove_tuesday": F.date_sub(e, 47), "good_friday": F.date_sub(e, 2), "pentecost": F.date_add(e, 49), "black_friday": black_friday, "christmas": F.make_date(F.col(year), F.lit(12), F.lit(25))}
    return df_years.select(year, F.explode(F.array(*[F.struct(F.lit(n).alias("event"), d.alias("day")) for n, d in days.items()])).alias("x")).select(year, "x.event", "x.day")


def weeks_to_event(weeks: DataFrame, events: DataFrame, unknown: int = 99) -> DataFrame:
    """weeks (column week_idx) with event and distance: signed weeks to the nearest day of each event, the earlier of two equally near; few events."""
    days = events.select("event", periods.week_index("day").alias("at"))
    near = weeks.select("week_idx").distinct().join(F.broadcast(days), F.abs(F.col("at") - F.col("week_idx")) <= 60, "left")
    return near.groupBy("week_idx", "event").agg(F.coalesce(F.min(F.struct(F.abs(F.col("at") - F.col("week_idx")), (F.col("at") - F.col("week_idx")).alias("d")))["d"], F.lit(unknown)).alias("distance"))


def holidays(df: DataFrame, events: DataFrame, before: int = 1, after: int = 1) -> DataFrame:
    """Adds n_holidays of the week, and whether one lies in the weeks before or after."""
    counts = events.groupBy(periods.week_index("day").alias("week_idx")).agg(F.count("*").alias("n_holidays"))
    spread = lambda name, shifts: counts.select(F.explode(F.array(*[(F.col("week_idx") + s) for s in shifts])).alias("week_idx")).distinct().withColumn(name, F.lit(1))
    out = df.join(counts, "week_idx", "left").join(spread("pre_holiday", range(-before, 0)), "week_idx", "left").join(spread("post_holiday", range(1, after + 1)), "week_idx", "left")
    return out.fillna(0, ["n_holidays", "pre_holiday", "post_holiday"])


def promo_week_number(df: DataFrame, flag: str = "promo", time: str = "week_idx") -> DataFrame:
    """promo_week: place within an unbroken run of promotion rows, 0 outside; promo_start and promo_second mark the first two."""
    df = df.withColumn("_off", F.sum((F.col(flag) == 0).cast("int")).over(by_key(time=time)))
    n = F.sum((F.col(flag) == 1).cast("int")).over(W.partitionBy("key", "_off").orderBy(time))
    return df.withColumn("promo_week", F.when(F.col(flag) == 1, n).otherwise(0)).withColumns({"promo_start": (F.col("promo_week") == 1).cast("int"), "promo_second": (F.col("promo_week") == 2).cast("int")}).drop("_off")


def target_encode(df: DataFrame, fit: DataFrame, column: str, target: str, alpha: float = 10.0) -> DataFrame:
    """{column}_te: mean of fit's target by value, drawn to the overall mean by alpha rows; unseen values get that."""
    overall = fit.agg(F.avg(target).alias("_g"))  # one row
    seen = fit.groupBy(column).agg(F.sum(target).alias("_s"), F.count(target).alias("_n"))
    return df.join(seen, column, "left").join(F.broadcast(overall), F.lit(True)).withColumn(f"{column}_te", F.coalesce((F.col("_s") + alpha * F.col("_g")) / (F.col("_n") + alpha), F.col("_g"))).drop("_s", "_n", "_g")


def frequency_encode(df: DataFrame, fit: DataFrame, column: str) -> DataFrame:
    """{column}_freq: share of fit's rows with this value, 0 if unseen."""
    total = fit.agg(F.count("*").alias("_t"))
    seen = fit.groupBy(column).agg(F.count("*").alias("_n"))
    return df.join(seen, column, "left").join(F.broadcast(total), F.lit(True)).withColumn(f"{column}_freq", F.coalesce(F.try_divide(F.col("_n"), F.col("_t")), F.lit(0.0))).drop("_n", "_t")


def ordinal_encode(df: DataFrame, fit: DataFrame, column: str, most: int = 100_000) -> DataFrame:
    """{column}_code: place of the value in fit's values in order, -1 if unseen; more than `most` values, which are counted before one task numbers them, are refused."""
    values = fit.select(column).where(F.col(column).isNotNull()).distinct()
    if values.limit(most + 1).count() > most:
        raise ValueError(f"{column} has more than {most} values")
    codes = values.withColumn(f"{column}_code", (F.row_number().over(W.orderBy(column)) - 1).cast("int"))
    return df.join(codes, column, "left").fillna(-1, [f"{column}_code"])


def onehot_encode(df: DataFrame, fit: DataFrame, column: str, most: int = 10) -> DataFrame:
    """One 0/1 column per value of fit but the first; more than `most` values are refused."""
    values = [r[0] for r in fit.select(column).where(F.col(column).isNotNull()).distinct().orderBy(column).limit(most + 1).collect()]
    if len(values) > most:
        raise ValueError(f"{column} has more than {most} values")
    return df.withColumns({f"{column}_{v}": (F.col(column).eqNullSafe(v)).cast("int") for v in values[1:]})


def hash_encode(df: DataFrame, column: str, buckets: int = 8) -> DataFrame:
    """{column}_h0 ..: which bucket of a hash that is the same in every process."""
    at = F.pmod(F.conv(F.substring(F.md5(F.col(column).cast("string")), 1, 8), 16, 10).cast("long"), F.lit(buckets))
    return df.withColumns({f"{column}_h{i}": (at == i).cast("int") for i in range(buckets)})


def correlations(df: DataFrame, columns: list[str], target: str) -> DataFrame:
    """column, corr, variance of each column, in one pass."""
    seen = df.agg(*[f for i, c in enumerate(columns) for f in (correlated(c, target).alias(f"c{i}"), F.var_samp(c).alias(f"v{i}"))])
    return seen.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"c{i}").alias("corr"), F.col(f"v{i}").alias("variance")) for i, c in enumerate(columns)])).alias("r")).select("r.*")


def pair_correlations(df: DataFrame, columns: list[str]) -> DataFrame:
    """a, b, corr of every pair of columns, in one pass."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1 :]]
    seen = df.agg(*[correlated(a, b).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    return seen.select(F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"c{i}").alias("corr")) for i, (a, b) in enumerate(pairs)])).alias("r")).select("r.*")


def select_by_correlation(df: DataFrame, columns: list[str], target: str, most: int, limit: float) -> list[str]:
    """Columns by falling correlation with the target, without those that go along with a better one; decided on a table of column pairs."""
    strength = {r["column"]: abs(r.corr) for r in correlations(df, columns, target).collect() if r.corr is not None}
    ranked = sorted(strength, key=lambda c: (-strength[c], c))[: 2 * most]
    tied = {frozenset((r.a, r.b)) for r in pair_correlations(df, ranked).collect() if r.corr is not None and abs(r.corr) > limit} if len(ranked) > 1 else set()
    chosen: list[str] = []
    for c in ranked:
        if not any(frozenset((c, d)) in tied for d in chosen):
            chosen.append(c)
    return chosen[:most]


def drop_correlated(df: DataFrame, columns: list[str], limit: float = 0.95) -> list[str]:
    """Of each pair that correlates so much one goes: ewm before expanding before rolling features, else the later."""
    order = {p: i for i, p in enumerate(("ewm", "exp", "roll"))}
    rank = {c: (order.get(c.split("_")[0], 9), -i) for i, c in enumerate(columns)}
    gone: set[str] = set()
    for r in pair_correlations(df, columns).orderBy("a", "b").collect():
        if r.corr is not None and abs(r.corr) >= limit and not gone & {r.a, r.b}:
            gone.add(min(r.a, r.b, key=rank.__getitem__))
    return [c for c in columns if c not in gone]


def leakage(df: DataFrame, columns: list[str], target: str, limit: float = 0.95) -> DataFrame:
    """column, corr, verdict: leak beyond the limit unless the name says it is lagged."""
    safe = F.col("column").rlike("^(lag|roll|exp|ewm|rmean|rstd)_")
    return correlations(df, columns, target).select("column", "corr", F.when(safe, "safe").when(F.abs("corr") > limit, "leak").otherwise("ok").alias("verdict"))
