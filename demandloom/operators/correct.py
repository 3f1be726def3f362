"""Corrections of forecasts: season, bias, order multiples, life cycle, hierarchy, intervals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from demandloom.operators import ranks
from demandloom.operators.selection import at_group_ranks


def clip(c: Column, lo: float, hi: float) -> Column:
    return F.when(c.isNotNull(), F.least(F.greatest(c, F.lit(lo)), F.lit(hi)))


def ratio(a: Column, b: Column) -> Column:
    return a / F.when(b != 0, b)


def last_year_totals(fc: DataFrame, hist: DataFrame, season: int = 52, by: str = "key") -> DataFrame:
    """by, forecast, sply: totals of the forecast periods and of the same periods a season ago."""
    before = hist.select("key", (F.col("week_idx") + season).alias("week_idx"), F.col("y").alias("sply"))
    return fc.join(before, ["key", "week_idx"], "left").groupBy(by).agg(F.sum("predicted").alias("forecast"), F.sum("sply").alias("sply"))


def seasonal_correct(fc: DataFrame, hist: DataFrame, reliability: float = 0.5, by: str = "key", lo: float = 0.5, hi: float = 2.5) -> DataFrame:
    """Scales each key's (or category's) forecast toward last year's total by its reliability, within bounds."""
    f = last_year_totals(fc, hist, by=by).select(by, F.coalesce(clip(1 + reliability * (ratio(F.col("sply"), F.col("forecast")) - 1), lo, hi), F.lit(1.0)).alias("factor"))
    return fc.join(f, by).withColumn("corrected", F.col("predicted") * F.col("factor"))


def growth_factor(hist: DataFrame, end: int, lookback: int = 13, season: int = 52, lo: float = 0.2, hi: float = 5.0, least: int = 4) -> DataFrame:
    """key, growth: the last periods over the same ones a season ago; 1 with fewer than `least` values in the last ones or without demand then, 0.5 where demand ended, within bounds."""
    t = F.col("week_idx")
    now, then = (t > end - lookback) & (t <= end), (t > end - lookback - season) & (t <= end - season)
    s = hist.groupBy("key").agg(F.coalesce(F.sum(F.when(now, F.col("y"))), F.lit(0.0)).alias("now"), F.coalesce(F.sum(F.when(then, F.col("y"))), F.lit(0.0)).alias("then"), F.count(F.when(now, F.col("y"))).alias("n"))
    return s.select("key", F.when((F.col("n") < least) | (F.col("then") <= 0), 1.0).when(F.col("now") <= 0, 0.5).otherwise(clip(ratio(F.col("now"), F.col("then")), lo, hi)).alias("growth"))


def sply_blend(fc: DataFrame, hist: DataFrame, end: int, alpha: float = 0.6, season: int = 52) -> DataFrame:
    """alpha of the forecast and the rest of last year's value times growth, where last year had demand."""
    before = hist.select("key", (F.col("week_idx") + season).alias("week_idx"), F.col("y").alias("sply"))
    out = fc.join(before, ["key", "week_idx"], "left").join(growth_factor(hist, end), "key", "left")
    return out.withColumn("corrected", F.when(F.col("sply") > 0, alpha * F.col("predicted") + (1 - alpha) * F.col("sply") * F.coalesce("growth", F.lit(1.0))).otherwise(F.col("predicted"))).drop("sply", "growth")


def trust_lift(fc: DataFrame, hist: DataFrame, end: int, reliability: DataFrame, least: float = 0.6, most: float = 3.0) -> DataFrame:
    """Lifts a reliable key's total to last year's where that is over both the forecast and the recent run rate."""
    recent = hist.where((F.col("week_idx") > end - 13) & (F.col("week_idx") <= end)).groupBy("key").agg(F.avg("y").alias("rate"))
    t = last_year_totals(fc, hist).join(fc.groupBy("key").agg(F.count("*").alias("n")), "key").join(recent, "key", "left").join(reliability, "key", "left")
    trusted = (F.col("reliability") >= least) & (F.col("sply") > F.col("forecast")) & (F.col("sply") > F.coalesce(F.col("rate"), F.lit(0.0)) * F.col("n"))
    f = t.select("key", F.when(trusted, clip(ratio(F.col("sply"), F.col("forecast")), 1.0, most)).alias("factor"))
    return fc.join(f, "key").withColumn("corrected", F.col("predicted") * F.coalesce("factor", F.lit(1.0))).drop("factor")


def undamp(fc: DataFrame, hist: DataFrame, end: int, floor: float = 0.9, most: float = 3.0) -> DataFrame:
    """Lifts to floor times the recent mean keys that were steady and not falling but are forecast below it."""
    t, y = F.col("week_idx"), F.col("y")
    r = hist.where((t > end - 13) & (t <= end)).groupBy("key").agg(F.avg("y").alias("recent"), ratio(F.stddev_samp("y"), F.avg("y")).alias("cv"), F.sum(F.when(t > end - 6, y)).alias("late"), F.sum(F.when(t <= end - 7, y)).alias("early"))
    s = fc.groupBy("key").agg(F.avg("predicted").alias("level")).join(r, "key", "left")
    hit = (F.col("cv") < 0.8) & (F.col("late") >= 0.75 * F.col("early")) & (F.col("level") < floor * F.col("recent"))
    f = s.select("key", F.when(hit, clip(ratio(floor * F.col("recent"), F.col("level")), 1.0, most)).alias("factor"))
    return fc.join(f, "key").withColumn("corrected", F.col("predicted") * F.coalesce("factor", F.lit(1.0))).drop("factor")


def bias_factor(train: DataFrame, by: list[str], damp: float = 1.0, lo: float = 0.5, hi: float = 1.8, least: int = 1) -> DataFrame:
    """by, factor: actual over predicted total, damped toward 1, within bounds; groups of fewer rows are left out."""
    f = train.groupBy(*by).agg(ratio(F.sum("actual"), F.sum("predicted")).alias("raw"), F.count("*").alias("n")).where(F.col("n") >= least)
    return f.select(*by, clip(1 + damp * (F.col("raw") - 1), lo, hi).alias("factor"))


def apply_factor(fc: DataFrame, *factors: tuple[DataFrame, list[str]]) -> DataFrame:
    """corrected: predicted times the first factor that a group has, 1 if none has; an empty list of columns is one row for all."""
    out, names = fc, []
    for i, (f, by) in enumerate(factors):
        one = f.withColumnRenamed("factor", f"_f{i}")
        out = out.join(one, by, "left") if by else out.join(F.broadcast(one), F.lit(True), "left")
        names.append(f"_f{i}")
    return out.withColumn("corrected", F.col("predicted") * F.coalesce(*names, F.lit(1.0))).drop(*names)


def bias_by_lag(fc: DataFrame, train: DataFrame, group: str = "category", lag: str = "h", lo: float = 0.3, hi: float = 3.0) -> DataFrame:
    """Factor of the group and lag, else of the lag over all groups."""
    return apply_factor(fc, (bias_factor(train, [group, lag], lo=lo, hi=hi), [group, lag]), (bias_factor(train, [lag], lo=lo, hi=hi), [lag]))


def quantile_bucket(df: DataFrame, column: str, n: int, out: str = "bucket") -> DataFrame:
    """Bucket 0 .. n - 1 of a column by its exact quantiles."""
    edges = F.array(*[F.lit(q).cast("double") for q in ranks.quantiles(df, column, [i / n for i in range(1, n)])])
    return df.withColumn(out, F.size(F.filter(edges, lambda e: e < F.col(column))))


def bias_by_bucket(fc: DataFrame, train: DataFrame, least: int, group: str = "category", lo: float = 0.2, hi: float = 2.0) -> DataFrame:
    """Factor of the group and bucket with enough rows, else of the group, else of all; both tables have bucket."""
    factor = lambda by, n=1: bias_factor(train, by, lo=lo, hi=hi, least=n)
    return apply_factor(fc, (factor([group, "bucket"], least), [group, "bucket"]), (factor([group], least), [group]), (factor([]), []))


def systematic_bias(df: DataFrame, by: list[str], critical: float = 1.96) -> DataFrame:
    """bias, t, slope of actual on predicted, and whether the mean error is beyond the critical t."""
    e = F.col("predicted") - F.col("actual")
    out = df.groupBy(*by).agg(F.avg(e).alias("bias"), (F.avg(e) / F.when(F.stddev_samp(e) > 0, F.stddev_samp(e) / F.sqrt(F.count(e)))).alias("t"), F.regr_slope(F.col("actual"), F.col("predicted")).alias("slope"))
    return out.withColumn("biased", F.abs("t") > critical)


def rolling_bias(df: DataFrame, window: int = 52, least: int = 12) -> DataFrame:
    """corrected: predicted less the mean error of the rows before, from `least` on; no less than 0."""
    w = W.partitionBy("key").orderBy("week_idx").rowsBetween(-window, -1)
    e = F.col("predicted") - F.col("actual")
    return df.withColumn("corrected", F.greatest(F.col("predicted") - F.when(F.count(e).over(w) >= least, F.avg(e).over(w)).otherwise(0.0), F.lit(0.0)))


def linear_calibration(fc: DataFrame, train: DataFrame, by: str) -> DataFrame:
    """corrected: the group's regression of actual on predicted in train; no less than 0."""
    line = train.groupBy(by).agg(F.regr_slope(F.col("actual"), F.col("predicted")).alias("_a"), F.regr_intercept(F.col("actual"), F.col("predicted")).alias("_b"))
    return fc.join(line, by, "left").withColumn("corrected", F.greatest(F.coalesce(F.col("_b") + F.col("_a") * F.col("predicted"), F.col("predicted")), F.lit(0.0))).drop("_a", "_b")


def order_multiple(df: DataFrame) -> DataFrame:
    """key, multiple: of keys with more than 30 demands over 60 in all, the percentile 40 (of 48 or more) that divides 70 or 60 within 2 % of the whole number, else the 50 that divides 70 or 80."""
    at = [0.4, 0.5, 0.6, 0.7, 0.8]
    q = df.groupBy("key").agg(F.percentile(F.when(F.col("y") > 0, F.col("y")), at).alias("q"), F.count_if(F.col("y") > 0).alias("n"), F.sum("y").alias("s"))
    p = {a: F.col("q")[i] for i, a in enumerate(at)}
    whole = lambda a, b: F.bround(ratio(p[b], p[a]))
    divides = lambda a, b: (whole(a, b) >= 1) & (F.abs(ratio(p[b], p[a]) - whole(a, b)) / whole(a, b) <= 0.02)
    first = F.when((p[0.4] >= 48) & (divides(0.4, 0.7) | divides(0.4, 0.6)), p[0.4])
    second = F.when((p[0.5] >= 48) & (divides(0.5, 0.7) | divides(0.5, 0.8)), p[0.5])
    return q.where("n > 30 and s > 60").select("key", F.coalesce(first, second).alias("multiple")).where("multiple is not null")


def round_to_multiple(value: Column, multiple: Column, threshold: Column, in_units: bool = False) -> Column:
    """Up where the part over a multiple is more than the threshold's share of it, else down; values that aren't positive become 0.

    The share of that part is compared, or in_units the part itself: at the threshold itself a share may be over it by a last digit (10,314 over 60: 0.9000000000000057), whole parts are not.
    """
    down = F.floor(value / multiple)
    over = value - down * multiple > threshold * multiple if in_units else value / multiple - down > threshold
    return F.when(value > 0, (down + F.when(over, 1).otherwise(0)) * multiple).otherwise(0.0)


def moq_round(fc: DataFrame, multiples: DataFrame, targets: DataFrame, after: int | None = None, segments: list[str] | None = None, first: int | None = 53, in_units: bool = False) -> DataFrame:
    """Rounds forecasts of keys with a multiple, at the threshold (.90 to .15 in steps of .05) whose mean is nearest the key's target mean; the higher of two.

    Only rows after the period `after` and of the listed values of `segment` are rounded and count for the threshold, of these the
    first so many of a key (all if None). Keys without a target, or with a target of 0, are rounded at half. in_units: see round_to_multiple;
    means are compared with the target likewise, to 1e-6, instead of by their ratio, to 1e-9.
    """
    may = F.lit(True) if after is None else F.col("week_idx") > after
    may = may if segments is None else may & F.col("segment").isin(segments)
    steps = F.explode(F.expr("transform(sequence(3, 18), i -> i / 20D)"))
    keyed = fc.where(may).join(multiples, "key")
    if first is not None:
        keyed = keyed.withColumn("_k", F.row_number().over(W.partitionBy("key").orderBy("week_idx"))).where(F.col("_k") <= first)
    swept = keyed.withColumn("t", steps).groupBy("key", "t").agg(F.avg(round_to_multiple(F.col("predicted"), F.col("multiple"), F.col("t"), in_units)).alias("m"))
    far = F.round(F.abs(F.col("m") - F.col("target")), 6) if in_units else F.round(F.abs(1 - F.col("m") / F.col("target")), 9)
    best = swept.join(targets.where("target <> 0 and not isnan(target)"), "key").groupBy("key").agg(F.min_by("t", F.struct(far, -F.col("t"))).alias("threshold"))
    out = fc.join(multiples, "key", "left").join(best, "key", "left").withColumn("threshold", F.when(F.col("multiple").isNotNull(), F.coalesce("threshold", F.lit(0.5))))
    return out.withColumn("rounded", F.when(F.col("threshold").isNotNull() & may, round_to_multiple(F.col("predicted"), F.col("multiple"), F.col("threshold"), in_units)).otherwise(F.col("predicted")))


def zero_clip(fc: DataFrame, adi: DataFrame, least: float = 2.0, least_zero: float = 0.3, after_zeros: float = 1.5) -> DataFrame:
    """Forecasts of intermittent keys below one over their interval become 0.

    Intermittent: an interval adi of `least` or more, or a zero_fraction (if adi has that column) of least_zero or more. The edge is so many
    times as high for keys whose column recent_zero, if adi has it, is true.
    """
    more = [c for c in ("zero_fraction", "recent_zero") if c in adi.columns]
    out = fc.join(adi.select("key", "adi", *[F.col(c).alias(f"_{c}") for c in more]), "key", "left")
    hit = F.col("adi") >= least
    if "zero_fraction" in more:
        hit = hit | (F.col("_zero_fraction") >= least_zero)
    edge = F.when(F.col("_recent_zero"), after_zeros).otherwise(1.0) / F.col("adi") if "recent_zero" in more else 1 / F.col("adi")
    return out.withColumn("corrected", F.when(hit & (F.col("predicted") < edge), 0.0).otherwise(F.col("predicted"))).drop("adi", *[f"_{c}" for c in more])


def lifecycle(fc: DataFrame, dead: DataFrame, new: DataFrame, new_factor: float = 0.8, ramp: int = 13) -> DataFrame:
    """Dead keys 0; new ones times a factor and a ramp from 1.5 to 1 over the first steps h."""
    out = fc.join(dead.select("key").distinct().withColumn("_d", F.lit(True)), "key", "left").join(new.select("key").distinct().withColumn("_n", F.lit(True)), "key", "left")
    up = F.greatest(F.lit(1.0), 1.5 - 0.5 * (F.col("h") - 1) / (ramp - 1))
    return out.withColumn("corrected", F.when(F.col("_d"), 0.0).when(F.col("_n"), F.col("predicted") * new_factor * up).otherwise(F.col("predicted"))).drop("_d", "_n")


def snap_to_levels(fc: DataFrame, hist: DataFrame, how: str = "nearest") -> DataFrame:
    """The nearest of the key's observed values, the smaller of two, or the one at or below (how: floor) or at or above (ceil), if any, else the nearest; rows without a forecast or of keys without values stay as they are."""
    levels = hist.select("key", F.col("y").cast("double").alias("_v")).where("key is not null and _v is not null").distinct()
    # Levels and forecasts in one order a key: the level below or at a forecast comes last before it, the one above first after it.
    both = fc.withColumn("_v", F.col("predicted").cast("double")).withColumn("_f", F.lit(1)).unionByName(levels.withColumn("_f", F.lit(0)), allowMissingColumns=True)
    level, w = F.when(F.col("_f") == 0, F.col("_v")), W.partitionBy("key").orderBy("_v", "_f")
    both = both.withColumn("_lo", F.last(level, True).over(w)).withColumn("_hi", F.first(level, True).over(w.rowsBetween(W.currentRow, W.unboundedFollowing))).where("_f = 1")
    above = F.when(F.col("_lo") == F.col("_v"), F.col("_lo")).otherwise(F.coalesce("_hi", "_lo"))
    near = F.coalesce("_lo", "_hi") if how == "floor" else above if how == "ceil" else F.when(F.col("_hi") - F.col("_v") < F.col("_v") - F.col("_lo"), F.col("_hi")).otherwise(F.coalesce("_lo", "_hi"))
    return both.withColumn("snapped", F.when(F.col("_v").isNotNull(), F.coalesce(near, F.col("predicted")))).drop("_v", "_f", "_lo", "_hi")


def topdown(fc: DataFrame, totals: DataFrame, band: float = 0.05, lo: float = 0.5, hi: float = 2.0, by: tuple[str, ...] = ("week_idx",)) -> DataFrame:
    """Scales the positive forecasts of each period, or each period and category (by), to its total where they differ by more than the band, within bounds."""
    s = fc.groupBy(*by).agg(F.sum(F.when(F.col("predicted") > 0, F.col("predicted"))).alias("_s")).join(totals, list(by), "left")
    r = ratio(F.col("total"), F.col("_s"))
    f = s.select(*by, F.when(F.abs(r - 1) > band, clip(r, lo, hi)).alias("_f"))
    return fc.join(f, list(by), "left").withColumn("corrected", F.when(F.col("predicted") > 0, F.col("predicted") * F.coalesce("_f", F.lit(1.0))).otherwise(F.col("predicted"))).drop("_f")


def yoy_sanity(fc: DataFrame, hist: DataFrame, most: float = 0.15, season: int = 52) -> DataFrame:
    """Scales periods whose total leaves last year's by more than the limit to the limit."""
    s = fc.groupBy("week_idx").agg(F.sum("predicted").alias("_s"))
    before = hist.groupBy((F.col("week_idx") + season).alias("week_idx")).agg(F.sum("y").alias("_b"))
    r = ratio(F.col("_s"), F.col("_b"))
    f = s.join(before, "week_idx", "left").select("week_idx", ratio(clip(r, 1 - most, 1 + most), r).alias("_f"))
    return fc.join(f, "week_idx", "left").withColumn("corrected", F.col("predicted") * F.coalesce("_f", F.lit(1.0))).drop("_f")


def yoy_trend(fc: DataFrame, hist: DataFrame, end: int, lo: float = 0.5, hi: float = 2.0) -> DataFrame:
    """Scales each key's total to last year's times its recent growth, within bounds; keys without last year stay."""
    t = last_year_totals(fc, hist).join(growth_factor(hist, end), "key", "left")
    f = t.select("key", F.when(F.col("sply") > 0, clip(ratio(F.col("sply") * F.coalesce("growth", F.lit(1.0)), F.col("forecast")), lo, hi)).alias("_f"))
    return fc.join(f, "key", "left").withColumn("corrected", F.col("predicted") * F.coalesce("_f", F.lit(1.0))).drop("_f")


def bottom_up(fc: DataFrame, group: str = "category") -> DataFrame:
    """level, node, week_idx, predicted: keys, groups and total."""
    rolled = fc.groupingSets([[F.col("week_idx"), F.col(group), F.col("key")], [F.col("week_idx"), F.col(group)], [F.col("week_idx")]], F.col("week_idx"), F.col(group), F.col("key")).agg(F.sum("predicted").alias("predicted"), F.grouping_id().alias("_g"))
    return rolled.select(F.when(F.col("_g") == 0, "key").when(F.col("_g") == 1, "group").otherwise("total").alias("level"), F.coalesce("key", group, F.lit("all")).alias("node"), "week_idx", "predicted")


def reconcile(keys: DataFrame, groups: DataFrame, totals: DataFrame, group: str = "category", v_key: float = 1.0, v_group: float = 1.0, v_total: float = 1.0) -> DataFrame:
    """Least squares on a tree of keys, groups and a total with independent errors of the given variances: key, group, week_idx, reconciled.

    Upward each node combines its own forecast with its children's sum by precision; downward what it gains is shared out
    among the children in proportion to their variance. groups and totals have predicted for week_idx (and group).
    """
    g = keys.groupBy("week_idx", group).agg(F.sum("predicted").alias("sum"), F.count("*").alias("n")).join(groups.withColumnRenamed("predicted", "own"), ["week_idx", group])
    vs = F.col("n") * v_key
    g = g.withColumn("up", (F.col("sum") * v_group + F.col("own") * vs) / (vs + v_group)).withColumn("v", vs * v_group / (vs + v_group)).withColumn("vs", vs)
    t = g.groupBy("week_idx").agg(F.sum("up").alias("sum_t"), F.sum("v").alias("v_t")).join(totals.withColumnRenamed("predicted", "own_t"), "week_idx")
    t = t.select("week_idx", ((F.col("own_t") - F.col("sum_t")) / (F.col("v_t") + v_total)).alias("gain"))
    g = g.join(t, "week_idx").select("week_idx", group, ((F.col("up") + F.col("v") * F.col("gain") - F.col("sum")) / F.col("vs")).alias("shift"))
    return keys.join(g, ["week_idx", group]).select("key", group, "week_idx", (F.col("predicted") + v_key * F.col("shift")).alias("reconciled"))


def coherence(keys: DataFrame, groups: DataFrame, totals: DataFrame, value: str = "predicted", group: str = "category") -> DataFrame:
    """week_idx, group_gap (the largest difference of a group and its keys), total_gap."""
    g = keys.groupBy("week_idx", group).agg(F.sum(value).alias("s")).join(groups, ["week_idx", group])
    out = g.groupBy("week_idx").agg(F.max(F.abs(F.col("s") - F.col("predicted"))).alias("group_gap"), F.sum("predicted").alias("s"))
    return out.join(totals.withColumnRenamed("predicted", "t"), "week_idx").select("week_idx", "group_gap", F.abs(F.col("s") - F.col("t")).alias("total_gap"))


def conformal(fc: DataFrame, train: DataFrame, by: str, confidence: float = 0.9, method: str = "absolute") -> DataFrame:
    """lower (no less than 0) and upper, from the group's scores in train at the rank ceil((n + 1) confidence).

    absolute: the forecast less and plus the absolute error of that rank; normalised: errors over the forecast's size (1 at least), times
    this forecast's; signed: errors of the ranks that leave half of the rest below and half above.
    """
    e, size = F.col("actual") - F.col("predicted"), F.greatest(F.abs("predicted"), F.lit(1.0))
    score = {"absolute": F.abs(e), "normalised": F.abs(e) / size, "signed": e}[method]
    at = lambda c: F.ceil((F.col("n") + 1) * c) - 1
    wanted = {"_lo": at((1 - confidence) / 2), "_hi": at((1 + confidence) / 2)} if method == "signed" else {"_hi": at(confidence)}
    q = at_group_ranks(train, [by], score, wanted).drop("n")
    if method == "signed":
        lower, upper = F.col("predicted") + F.col("_lo"), F.col("predicted") + F.col("_hi")
    else:
        q = q.withColumn("_lo", F.col("_hi"))
        half = F.col("_hi") * (size if method == "normalised" else F.lit(1.0))
        lower, upper = F.col("predicted") - half, F.col("predicted") + half
    return fc.join(q, by, "left").withColumn("lower", F.greatest(lower, F.lit(0.0))).withColumn("upper", upper).drop("_lo", "_hi")
