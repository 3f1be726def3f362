"""Combining forecasts: fitted weights, blends and choices per group. Columns s, c, rf are component forecasts, actual the truth."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from demandloom.operators.joins import with_weights

PARTS = ("s", "c", "rf")


def blended(weights: Sequence[Column], parts: Sequence[str] = PARTS) -> Column:
    """The weighted sum, no less than 0."""
    terms = [w * F.col(p) for w, p in zip(weights, parts, strict=True)]
    return F.greatest(F.lit(0.0), sum(terms[1:], terms[0]))


def blend_apply(df: DataFrame, weights: DataFrame, default: tuple[float, float, float] = (0.0, 0.0, 1.0)) -> DataFrame:
    """blend: by the weights of category and segment, of the category's `_default`, or the default."""
    return with_weights(df, weights, default).withColumn("blend", blended([F.col(f"w_{p}") for p in PARTS])).drop(*[f"w_{p}" for p in PARTS])


def score_grid(df: DataFrame, by: list[str], grid: Sequence[tuple[float, ...]], tolerance: float, parts: Sequence[str] = PARTS, penalty: float = 200.0) -> DataFrame:
    """by, weights, loss for every point of a grid of weights, in one aggregation.

    Loss: WAPE plus penalty times the square of what the bias falls short of the last part's own bias (if negative) less the tolerance.
    """
    # A slice is folded to one constant; an array in the generator would become code for each of its elements, more than the compiler takes.
    points = F.expr(f"slice(array({', '.join('array(' + ', '.join(f'double({float(x)!r})' for x in g) + ')' for g in grid)}), 1, {len(grid)})")
    # Grouped by the number of the point: hashing an array for each row and point would cost more than the sums.
    rows = df.select(*by, "actual", *parts, F.posexplode(points).alias("_i", "weights"))
    return score_points(rows, by, tolerance, parts, penalty, "_i").withColumn("weights", F.get(points, F.col("_i"))).select(*by, "weights", "loss")


def score_points(df: DataFrame, by: list[str], tolerance: float, parts: Sequence[str] = PARTS, penalty: float = 200.0, point: str = "weights") -> DataFrame:
    """As score_grid for rows that have an array `weights` already, by the column that names it."""
    blend = blended([F.col("weights")[i] for i in range(len(parts))], parts)
    a = F.sum("actual")
    s = df.groupBy(*by, point).agg(a.alias("_a"), F.sum(F.abs(blend - F.col("actual"))).alias("_e"), F.sum(blend - F.col("actual")).alias("_d"), F.sum(F.col(parts[-1]) - F.col("actual")).alias("_b"))
    total = F.greatest(F.col("_a"), F.lit(1e-9))
    floor = F.least(F.col("_b") / total, F.lit(0.0)) - tolerance
    short = F.least(F.col("_d") / total - floor, F.lit(0.0))
    return s.select(*by, point, F.round(F.col("_e") / total + penalty * short * short, 9).alias("loss"))


def least_loss(scores: DataFrame, by: list[str]) -> DataFrame:
    """by, weights, loss of each group's best point; ties to the lesser weights."""
    return scores.groupBy(*by).agg(F.min(F.struct("loss", "weights")).alias("_m")).select(*by, F.col("_m.weights").alias("weights"), F.col("_m.loss").alias("loss"))


def cube(top: float, step: float, n: int) -> list[tuple[float, ...]]:
    axis = [round(i * step, 6) for i in range(round(top / step) + 1)]
    return list(product(axis, repeat=n))


def fit_asymmetric(df: DataFrame, by: list[str], tolerance: float = 0.02, top: float = 3.0, coarse: float = 0.5, fine: float = 1 / 1024, most: float = 3.0, reach: int = 2) -> DataFrame:
    """by, weights, loss: best point of a coarse grid up to `top`, then of grids around the best so far, each of half the step and so many steps (reach) each way, while the step is `fine` or more; weights in [0, most].

    One aggregation a round. df is at the grain that is scored.
    """
    best = least_loss(score_grid(df, by, cube(top, coarse, len(PARTS)), tolerance), by)
    step = coarse / 2
    while step >= fine:
        moves = product([i * step for i in range(-reach, reach + 1)], repeat=len(PARTS))
        near = F.explode(F.array(*[F.array(*[F.least(F.greatest(F.lit(0.0), F.col("_w")[i] + d), F.lit(most)) for i, d in enumerate(ds)]) for ds in moves]))
        around = best.select(*by, F.col("weights").alias("_w")).select(*by, near.alias("weights")).distinct()
        best = least_loss(score_points(df.join(around, by), by, tolerance), by)
        step /= 2
    return best


def guardrail(df: DataFrame, fit: DataFrame, by: list[str], tolerance: float = 0.02, margin: float = 0.0) -> DataFrame:
    """by, weights: the fit where its accuracy is at least the benchmark's less 0.001 plus a margin and its bias within the tolerance, else the benchmark alone."""
    joined = df.join(fit.select(*by, "weights"), by)
    blend = blended([F.col("weights")[i] for i in range(3)])
    s = joined.groupBy(*by, "weights").agg(F.greatest(F.sum("actual"), F.lit(1e-9)).alias("_a"), F.sum(F.abs(blend - F.col("actual"))).alias("_e"), F.sum(F.abs(F.col("rf") - F.col("actual"))).alias("_f"), F.sum(blend - F.col("actual")).alias("_d"), F.sum(F.col("rf") - F.col("actual")).alias("_b"))
    keep = (1 - F.col("_e") / F.col("_a") >= 1 - F.col("_f") / F.col("_a") - 1e-3 + margin) & (F.col("_d") / F.col("_a") >= F.least(F.col("_b") / F.col("_a"), F.lit(0.0)) - tolerance)
    return s.select(*by, F.when(keep, F.col("weights")).otherwise(F.array(F.lit(0.0), F.lit(0.0), F.lit(1.0))).alias("weights"))


def shrink(segment: DataFrame, category: DataFrame, volumes: DataFrame, half: float = 5000.0, least: float = 1000.0) -> DataFrame:
    """category, segment, weights: of the segment by its volume over volume plus half, the rest of the category; the benchmark alone below the least volume."""
    both = segment.join(category.select("category", F.col("weights").alias("_c")), "category").join(volumes, ["category", "segment"])
    lam = F.col("volume") / (F.col("volume") + half)
    mixed = F.zip_with("weights", "_c", lambda a, b: lam * a + (1 - lam) * b)
    return both.select("category", "segment", F.when(F.col("volume") < least, F.array(F.lit(0.0), F.lit(0.0), F.lit(1.0))).otherwise(mixed).alias("weights"))


def calibrated(df: DataFrame, fit: DataFrame, by: list[str], lo: float = 0.5, hi: float = 2.0) -> DataFrame:
    """by, weights: all of a group's weights times its actual over blended total, within bounds."""
    blend = blended([F.col("weights")[i] for i in range(3)])
    f = df.join(fit.select(*by, "weights"), by).groupBy(*by, "weights").agg(F.least(F.greatest(F.coalesce(F.try_divide(F.sum("actual"), F.sum(blend)), F.lit(1.0)), F.lit(lo)), F.lit(hi)).alias("_f"))
    return f.select(*by, F.transform("weights", lambda w: w * F.col("_f")).alias("weights"))


def fit_hierarchical(df: DataFrame, levels: list[list[str]], grid: Sequence[tuple[float, ...]], alpha: float, tolerance: float = 0.02, squared: bool = False) -> DataFrame:
    """Weights of the last level, each level drawn to its parent's by alpha times the absolute distance (or, if squared, the sum of squares); levels from coarse to fine, each with the columns of the one before."""
    parent, above = None, []
    for by in levels:
        scores = score_grid(df, by, grid, tolerance) if by else score_grid(df.withColumn("_all", F.lit(1)), ["_all"], grid, tolerance).drop("_all")
        if parent is not None:
            near = parent.select(*above, F.col("weights").alias("_p"))
            scores = scores.join(near, above) if above else scores.join(F.broadcast(near), F.lit(True))  # one row
            distance = F.aggregate(F.zip_with("weights", "_p", lambda a, b: (a - b) * (a - b) if squared else F.abs(a - b)), F.lit(0.0), lambda a, x: a + x)
            scores = scores.withColumn("loss", F.round(F.col("loss") + alpha * distance, 9)).drop("_p")
        parent, above = least_loss(scores, by), by
    return parent


def choose_alpha(df: DataFrame, levels: list[list[str]], grid: Sequence[tuple[float, ...]], alphas: Sequence[float], snapshot: str, tolerance: float = 0.02, squared: bool = False) -> DataFrame:
    """alpha, wape: for each alpha the WAPE over all snapshots, each blended by weights fitted on the others. Few snapshots and alphas.

    Every snapshot's rows serve all the folds but its own: the folds are one more grouping column, so that each alpha is one fit.
    """
    names = df.select(snapshot).distinct().withColumnRenamed(snapshot, "_out")
    training = df.join(F.broadcast(names), F.col(snapshot) != F.col("_out"))
    out = None
    for alpha in alphas:
        fit = fit_hierarchical(training, [["_out", *by] for by in levels], grid, alpha, tolerance, squared).withColumnRenamed("_out", snapshot)
        held = df.join(fit, [snapshot, *levels[-1]])
        blend = blended([F.col("weights")[i] for i in range(len(PARTS))])
        one = held.agg(F.lit(float(alpha)).alias("alpha"), F.round(F.try_divide(F.sum(F.abs(blend - F.col("actual"))), F.sum("actual")), 9).alias("wape"))
        out = one if out is None else out.unionByName(one)
    return out


def two_forecasts(df: DataFrame, by: list[str], least: int = 3, first: str = "f1", second: str = "f2") -> DataFrame:
    """by, w1, status: the weight of the first forecast in [0, 1] of least absolute error.

    The error is convex and piecewise linear in the weight, so the best one is a bound or one of the points where a row's error is
    nought; it is found as the weighted median of those points.
    """
    d = F.col(first) - F.col(second)
    rows = df.withColumn("_k", F.when(d != 0, (F.col("actual") - F.col(second)) / F.when(d != 0, d))).withColumn("_w", F.abs(d))
    w = W.partitionBy(*by)
    points = rows.where("_k is not null").withColumn("_up", F.sum("_w").over(w.orderBy("_k"))).withColumn("_all", F.sum("_w").over(w))
    median = points.where("2 * _up >= _all").groupBy(*by).agg(F.min("_k").alias("_m"))
    n = df.groupBy(*by).agg(F.count("*").alias("_n"))
    few = F.col("_n") < least
    out = n.join(median, by, "left")
    return out.select(*by, F.when(few, 0.5).otherwise(F.coalesce(F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("_m"))), F.lit(0.5))).alias("w1"), F.when(few, f"fallback:n_obs<{least}").when(F.col("_m").isNull(), "fallback:equal").otherwise("ok").alias("status"))


def two_forecasts_with_bias(df: DataFrame, by: list[str], mode: str = "soft", penalty: float = 1.0, tolerance: float = 0.0, first_periods: int | None = None, both_sold: bool = False, least: int = 3, first: str = "f1", second: str = "f2", time: str = "week_idx") -> DataFrame:
    """by, w1, status: as two_forecasts(), with the bias taken into account.

    mode: none; soft (WAPE plus penalty times the absolute bias); hard (least WAPE among weights whose absolute bias is within the tolerance, or the least
    absolute bias if none is); dominant (least absolute bias, then WAPE). first_periods: only so many first periods of a group count; both_sold:
    only rows where both forecasts are over zero.

    Within a group WAPE and bias are piecewise linear in w1, so the best is a bound, a point where a row's error is nought or a point where the bias is nought or at
    the tolerance. WAPE at every such point comes from running sums over the points in order, not from rows times points.
    """
    rows = df.where((F.col(first) > 0) & (F.col(second) > 0)) if both_sold else df
    if first_periods is not None:
        rows = rows.withColumn("_p", F.dense_rank().over(W.partitionBy(*by).orderBy(time))).where(F.col("_p") <= first_periods)
    d, e = F.col(first) - F.col(second), F.col(second) - F.col("actual")
    # Error of a row: |e + w d|. Its zero is the break; rows of equal forecasts have none and count as broken before everything.
    rows = rows.select(*by, "actual", d.alias("_d"), e.alias("_e"), F.when(d != 0, -e / F.when(d != 0, d)).alias("_k"))
    sums = rows.groupBy(*by).agg(F.count("*").alias("_n"), F.sum("actual").alias("_a"), F.sum("_e").alias("_se"), F.sum("_d").alias("_sd"), F.sum(F.when(F.col("_k").isNull(), F.abs("_e")).otherwise(0.0)).alias("_const"), F.sum(F.when(F.col("_k").isNotNull(), F.col("_e") * F.signum("_d")).otherwise(0.0)).alias("_ae"), F.sum(F.abs("_d")).alias("_ad"))
    level = tolerance * F.col("_a")
    zeros = [F.try_divide(x - F.col("_se"), F.col("_sd")) for x in (F.lit(0.0), level, -level)]
    own = sums.select(*by, F.explode(F.array(F.lit(0.0), F.lit(1.0), *zeros)).alias("_w")).where("_w between 0 and 1").distinct()
    marks = own.select(*by, "_w", F.lit(0.0).alias("_x"), F.lit(0.0).alias("_y"), F.lit(1).alias("_c"))
    breaks = rows.where("_k is not null").select(*by, F.col("_k").alias("_w"), F.abs("_d").alias("_x"), (F.col("_e") * F.signum("_d")).alias("_y"), F.when(F.col("_k").between(0, 1), 1).otherwise(0).alias("_c"))
    points = breaks.unionByName(marks).groupBy(*by, "_w").agg(F.sum("_x").alias("_x"), F.sum("_y").alias("_y"), F.max("_c").alias("_c"))
    w = W.partitionBy(*by).orderBy("_w")
    run = points.withColumn("_ux", F.sum("_x").over(w)).withColumn("_uy", F.sum("_y").over(w)).where("_c = 1").join(sums, by)
    # Rows whose break lies at or below w have |e + w d| = sign(d) (e + w d), the others its opposite.
    total = F.col("_const") + 2 * (F.col("_uy") + F.col("_w") * F.col("_ux")) - (F.col("_ae") + F.col("_w") * F.col("_ad"))
    a = F.greatest(F.col("_a"), F.lit(1e-9))
    scored = run.withColumn("_wape", F.round(total / a, 9)).withColumn("_bias", F.round(F.abs(F.col("_se") + F.col("_w") * F.col("_sd")) / a, 9))
    inside = F.col("_bias") <= tolerance + 1e-9
    order = {"none": F.struct("_wape", "_bias", "_w"), "soft": F.struct(F.round(F.col("_wape") + penalty * F.col("_bias"), 9), F.col("_w")), "hard": F.struct(F.when(inside, 0).otherwise(1), F.when(inside, F.col("_wape")).otherwise(F.col("_bias")), F.col("_wape"), F.col("_w")), "dominant": F.struct("_bias", "_wape", "_w")}[mode]
    best = scored.groupBy(*by).agg(F.min_by("_w", order).alias("_m"))
    few = F.coalesce("_n", F.lit(0)) < least
    out = df.select(*by).distinct().join(sums.select(*by, "_n", "_ad"), by, "left").join(best, by, "left")
    return out.select(*by, F.when(few | (F.col("_ad") == 0), 0.5).otherwise(F.col("_m")).alias("w1"), F.when(few, f"fallback:n_obs<{least}").when(F.col("_ad") == 0, "fallback:equal").otherwise("ok").alias("status"))


def simplex(n: int, step: float) -> list[tuple[float, ...]]:
    k = round(1 / step)
    return [tuple(i / k for i in p) for p in product(range(k + 1), repeat=n) if sum(p) == k]


def fit_simplex(df: DataFrame, by: list[str], heads: Sequence[str], step: float = 0.1, bias_weight: float = 0.5, shrinkage: float = 0.5) -> DataFrame:
    """by, weights: best weights that sum to one by WAPE plus weighted absolute bias, drawn halfway to equal ones."""
    points = F.explode(F.array(*[F.array(*[F.lit(x) for x in g]) for g in simplex(len(heads), step)]))
    terms = [F.col("weights")[i] * F.col(h) for i, h in enumerate(heads)]
    e = sum(terms[1:], terms[0]) - F.col("actual")
    s = df.withColumn("weights", points).groupBy(*by, "weights").agg(F.round(F.try_divide(F.sum(F.abs(e)) + bias_weight * F.abs(F.sum(e)), F.sum("actual")), 9).alias("loss"))
    return least_loss(s, by).select(*by, F.transform("weights", lambda w: (1 - shrinkage) * w + shrinkage / len(heads)).alias("weights"))


def share_grid(df: DataFrame, by: list[str], first: str, second: str, steps: int = 20) -> DataFrame:
    """by, share, wape: the best share of the first forecast among so many steps; ties to the smaller share."""
    e = F.abs(F.col("share") * F.col(first) + (1 - F.col("share")) * F.col(second) - F.col("actual"))
    s = df.withColumn("share", F.explode(F.expr(f"transform(sequence(0, {steps}), i -> i / {steps}D)"))).groupBy(*by, "share").agg(F.round(F.try_divide(F.sum(e), F.sum("actual")), 9).alias("wape"))
    return s.groupBy(*by).agg(F.min(F.struct("wape", "share")).alias("_m")).select(*by, "_m.share", "_m.wape")


def inverse_error(df: DataFrame, by: list[str], model: str = "model") -> DataFrame:
    """by, model, weight: one over the mean squared error, summing to one."""
    e = F.col("predicted") - F.col("actual")
    m = df.groupBy(*by, model).agg((1 / F.greatest(F.avg(e * e), F.lit(1e-12))).alias("_i"))
    return m.select(*by, model, (F.col("_i") / F.sum("_i").over(W.partitionBy(*by))).alias("weight"))


def data_adaptive(counts: DataFrame, most: float = 0.6) -> DataFrame:
    """key, w_key (rows over 100, at most so much), w_segment and w_category (60 and 40 % of the rest)."""
    w = F.least(F.col("n") / 100, F.lit(most))
    return counts.select("key", w.alias("w_key"), ((1 - w) * 0.6).alias("w_segment"), ((1 - w) * 0.4).alias("w_category"))


def cross_validated(df: DataFrame, fold: str, heads: Sequence[str], step: float = 0.1) -> DataFrame:
    """weights, effective: mean of the best simplex weights of each fold, and how many models they amount to."""
    per = fit_simplex(df, [fold], heads, step, bias_weight=0.0, shrinkage=0.0)
    means = per.agg(F.array(*[F.avg(F.col("weights")[i]) for i in range(len(heads))]).alias("weights"))
    return means.select("weights", (1 / F.aggregate("weights", F.lit(0.0), lambda a, w: a + w * w)).alias("effective"))


def trimmed_mean(df: DataFrame, heads: Sequence[str], trim: float = 0.2) -> Column:
    """Mean of the forecasts without the lowest and highest share, one of each at least; of all if too few are left."""
    k = max(1, int(len(heads) * trim))
    kept = F.array_sort(F.array(*[F.col(h) for h in heads]))
    if len(heads) > 2 * k:
        kept = F.slice(kept, k + 1, len(heads) - 2 * k)
    return F.aggregate(kept, F.lit(0.0), lambda a, x: a + x, lambda a: a / F.size(kept))


def contest(held: DataFrame, fc: DataFrame, margin: float = 0.05, blend: float = 0.7) -> DataFrame:
    """fc (own, pooled) with predicted: blended where the key's own forecast beat the pooled one on held-out rows by the margin, else pooled."""
    wape = lambda c: F.try_divide(F.sum(F.abs(F.col(c) - F.col("actual"))), F.sum("actual"))
    won = held.groupBy("key").agg((wape("own") < wape("pooled") * (1 - margin)).alias("_own"))
    return fc.join(won, "key", "left").withColumn("predicted", F.when(F.col("_own"), blend * F.col("own") + (1 - blend) * F.col("pooled")).otherwise(F.col("pooled"))).drop("_own")


def category_contest(held: DataFrame, fc: DataFrame, high_volume: DataFrame, least: float = 0.42, blend: float = 0.7, group: str = "category") -> DataFrame:
    """fc (own, pooled) with predicted: pooled for categories whose pooled accuracy on held-out rows of high-volume keys is over the limit, the blend for all keys of the others."""
    seen = held.join(high_volume.select("key").distinct(), "key", "left_semi").groupBy(group)
    good = seen.agg((1 - F.try_divide(F.sum(F.abs(F.col("pooled") - F.col("actual"))), F.sum("actual")) > least).alias("_good"))
    rescue = blend * F.col("own") + (1 - blend) * F.col("pooled")
    return fc.join(good, group, "left").withColumn("predicted", F.when(F.coalesce("_good", F.lit(False)), F.col("pooled")).otherwise(rescue)).drop("_good")


def recipe_select(df: DataFrame, by: str, models: Sequence[str], benchmark: str = "benchmark") -> DataFrame:
    """by, recipe: of the models and their halves by pairs the one that beats the benchmark on accuracy and bias, else on accuracy, else of the best score."""
    names = {m: F.col(m) for m in models} | {f"{a}+{b}": (F.col(a) + F.col(b)) / 2 for i, a in enumerate(models) for b in models[i + 1 :]}
    rows = df.select(by, "actual", F.col(benchmark).alias("_b"), F.explode(F.array(*[F.struct(F.lit(n).alias("recipe"), c.cast("double").alias("p")) for n, c in names.items()])).alias("x")).select(by, "actual", "_b", "x.*")
    acc = lambda c: 1 - F.try_divide(F.sum(F.abs(F.col(c) - F.col("actual"))), F.sum("actual"))
    bias = lambda c: F.abs(F.try_divide(F.sum(F.col(c) - F.col("actual")), F.sum("actual")))
    s = rows.groupBy(by, "recipe").agg(acc("p").alias("a"), bias("p").alias("b"), acc("_b").alias("ab"), bias("_b").alias("bb"))
    rank = F.when((F.col("a") > F.col("ab")) & (F.col("b") < F.col("bb")), 2).when(F.col("a") > F.col("ab"), 1).otherwise(0)
    return s.withColumn("_r", F.struct(rank.alias("r"), F.round(F.col("a") * 1000 - F.col("b") * 200, 6).alias("s"), F.col("recipe"))).groupBy(by).agg(F.max("_r").alias("_m")).select(by, "_m.recipe")
