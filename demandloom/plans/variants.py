"""Queries: further variants of operators that have more than one."""

from __future__ import annotations

from pyspark.sql import functions as F

from demandloom.operators import combine, convex, correct, evaluate, forecast, models, profile, ranks, segment
from demandloom.plans.combining import PARTS, parts
from demandloom.plans.correcting import END, FC, fc, shown, train
from demandloom.plans.features import SPARSE, rounded, sparse
from demandloom.plans.joining import SCORED, scored
from demandloom.plans.panels import BRAND, PART, brand_week, part_week, table
from demandloom.plans.registry import query
from demandloom.plans.segmenting import KEYS, keys

E = "abs(predicted - actual)"


def points(tolerance: str) -> str:
    """SQL of every weight that may be best for a key, with WAPE and bias by all rows of it."""
    return f"""{PARTS}, t AS (SELECT key, s AS f1, rf AS f2, actual FROM parts), g AS (SELECT key, sum(f2 - actual) AS se, sum(f1 - f2) AS sd, sum(actual) AS a FROM t GROUP BY 1),
        w AS (SELECT key, (actual - f2) / nullif(f1 - f2, 0) AS w FROM t UNION SELECT key, unnest([0.0::DOUBLE, 1, -se / nullif(sd, 0), ({tolerance} * a - se) / nullif(sd, 0), (-{tolerance} * a - se) / nullif(sd, 0)]) FROM g),
        p AS (SELECT w.key, w, round(sum(abs(w * f1 + (1 - w) * f2 - actual)) / sum(actual), 9) AS wape, round(abs(sum(w * f1 + (1 - w) * f2 - actual)) / sum(actual), 9) AS bias FROM w JOIN t USING (key) WHERE w BETWEEN 0 AND 1 GROUP BY 1, 2)"""


@query(f"{points('0.0::DOUBLE')} SELECT key, round(min(round(wape + 0.5::DOUBLE * bias, 9)), 6) AS loss FROM p GROUP BY 1")
def blend_two_forecasts_soft(spark, sf_dir):
    rows = parts(spark, sf_dir)
    fit = combine.two_forecasts_with_bias(rows, ["key"], "soft", 0.5, first="s", second="rf")
    blend = F.col("w1") * F.col("s") + (1 - F.col("w1")) * F.col("rf") - F.col("actual")
    return rows.join(fit, "key").groupBy("key").agg(F.round((F.sum(F.abs(blend)) + 0.5 * F.abs(F.sum(blend))) / F.sum("actual"), 6).alias("loss"))


@query(f"{points('0.02::DOUBLE')}, r AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY bias > 0.02 + 1e-9, CASE WHEN bias <= 0.02 + 1e-9 THEN wape ELSE bias END, wape, w) AS r FROM p) SELECT key, round(wape, 6) AS wape, round(bias, 6) AS bias FROM r WHERE r = 1")
def blend_two_forecasts_hard(spark, sf_dir):
    rows = parts(spark, sf_dir)
    fit = combine.two_forecasts_with_bias(rows, ["key"], "hard", tolerance=0.02, first="s", second="rf")
    blend = F.col("w1") * F.col("s") + (1 - F.col("w1")) * F.col("rf") - F.col("actual")
    return rows.join(fit, "key").groupBy("key").agg(F.round(F.sum(F.abs(blend)) / F.sum("actual"), 6).alias("wape"), F.round(F.abs(F.sum(blend)) / F.sum("actual"), 6).alias("bias"))


@query(f"{PARTS}, h AS (SELECT key FROM parts GROUP BY 1 HAVING sum(actual) >= (SELECT quantile_cont(v, 0.5) FROM (SELECT sum(actual) AS v FROM parts GROUP BY key))), c AS (SELECT category, 1 - sum(abs(rf - actual)) / sum(actual) > 0.62 AS good FROM parts SEMI JOIN h USING (key) WHERE week_idx <= 1600 GROUP BY 1) SELECT key, week_idx, round(CASE WHEN coalesce(good, false) THEN rf ELSE 0.7::DOUBLE * s + 0.3::DOUBLE * rf END, 6) AS predicted FROM parts LEFT JOIN c USING (category) WHERE week_idx > 1600")
def category_contest(spark, sf_dir):
    rows = parts(spark, sf_dir).select("key", "category", "week_idx", "actual", F.col("s").alias("own"), F.col("rf").alias("pooled"))
    volumes = rows.groupBy("key").agg(F.sum("actual").alias("v"))
    high = ranks.with_quantiles(volumes, "v", [0.5], ["edge"]).where("v >= edge")
    return rounded(combine.category_contest(rows.where("week_idx <= 1600"), rows.where("week_idx > 1600"), high, 0.62), "key", "week_idx", "predicted")


@query(f"{FC}, l AS (SELECT DISTINCT key, y FROM panel WHERE week_idx <= {END}) SELECT key, week_idx, arg_min(y, struct_pack(d := abs(y - predicted), v := y)) AS snapped, coalesce(max(y) FILTER (y <= predicted), min(y)) AS below, coalesce(min(y) FILTER (y >= predicted), max(y)) AS above FROM fc JOIN l USING (key) GROUP BY 1, 2")
def snap_to_all_levels(spark, sf_dir):
    rows, levels = fc(spark, sf_dir), brand_week(spark, sf_dir).where(f"week_idx <= {END}")
    out = correct.snap_to_levels(rows, levels)
    for how, name in (("floor", "below"), ("ceil", "above")):
        out = out.join(correct.snap_to_levels(rows, levels, how).select("key", "week_idx", F.col("snapped").alias(name)), ["key", "week_idx"])
    return out.select("key", "week_idx", "snapped", "below", "above")


@query(f"{FC}, s AS (SELECT week_idx, category, sum(predicted) AS s, sum(actual) AS t FROM fc GROUP BY 1, 2), f AS (SELECT week_idx, category, CASE WHEN abs(t / s - 1) > 0.05 THEN least(greatest(t / s, 0.5), 2) ELSE 1 END AS f FROM s) SELECT key, week_idx, round(predicted * f, 6) AS corrected FROM fc JOIN f USING (week_idx, category)")
def topdown_scale_by_category(spark, sf_dir):
    rows = fc(spark, sf_dir)
    totals = rows.groupBy("week_idx", "category").agg(F.sum("actual").alias("total"))
    return shown(correct.topdown(rows, totals, by=("week_idx", "category")))


@query(f"{SPARSE}, a AS (SELECT key, count(*) / nullif(count(*) FILTER (y > 0), 0) AS adi, avg((y = 0)::INT) AS zero, coalesce(sum(y) FILTER (week_idx > {END - 13}), 0) = 0 AS recent FROM sparse WHERE week_idx <= {END} GROUP BY 1), f AS (SELECT key, week_idx, y / 100 AS predicted FROM sparse WHERE week_idx > {END}) SELECT key, week_idx, CASE WHEN (adi >= 2 OR zero >= 0.3) AND predicted < CASE WHEN recent THEN 1.5::DOUBLE ELSE 1 END / adi THEN 0 ELSE predicted END AS corrected FROM f LEFT JOIN a USING (key)")
def zero_clip_by_history(spark, sf_dir):
    rows = sparse(spark, sf_dir)
    y = F.col("y")
    recent = F.coalesce(F.sum(F.when(F.col("week_idx") > END - 13, y)), F.lit(0.0)) == 0
    adi = rows.where(f"week_idx <= {END}").groupBy("key").agg(F.try_divide(F.count("*"), F.count_if(y > 0)).alias("adi"), F.avg((y == 0).cast("int")).alias("zero_fraction"), recent.alias("recent_zero"))
    return correct.zero_clip(rows.where(f"week_idx > {END}").withColumn("predicted", y / 100), adi).select("key", "week_idx", "corrected")


@query(f"{FC}, m AS (SELECT key, week_idx, predicted, week_idx > {END + 4} AND category <> 'C3' AS may FROM fc), tg AS (SELECT key, avg(actual) AS target FROM train GROUP BY 1), fr AS (SELECT * FROM m WHERE may QUALIFY row_number() OVER (PARTITION BY key ORDER BY week_idx) <= 10), sw AS (SELECT key, t, avg(floor(predicted / 60) * 60 + CASE WHEN predicted - floor(predicted / 60) * 60 > t * 60 THEN 60 ELSE 0 END) AS m FROM fr, (SELECT unnest(range(3, 19)) / 20.0::DOUBLE AS t) GROUP BY 1, 2), best AS (SELECT key, t FROM sw JOIN tg USING (key) QUALIFY row_number() OVER (PARTITION BY key ORDER BY round(abs(sw.m - target), 6), t DESC) = 1) SELECT key, week_idx, CASE WHEN t IS NULL OR NOT may THEN predicted ELSE floor(predicted / 60) * 60 + CASE WHEN predicted - floor(predicted / 60) * 60 > t * 60 THEN 60 ELSE 0 END END AS rounded FROM m LEFT JOIN best USING (key)")
def moq_round_future(spark, sf_dir):
    rows = fc(spark, sf_dir).withColumn("segment", F.col("category"))
    multiples = rows.select("key", F.lit(60.0).alias("multiple")).distinct()
    targets = train(spark, sf_dir).groupBy("key").agg(F.avg("actual").alias("target"))
    return correct.moq_round(rows, multiples, targets, END + 4, [f"C{i}" for i in range(1, 10) if i != 3], 10, in_units=True).select("key", "week_idx", "rounded")


def ranked(score: str) -> str:
    return f"e AS (SELECT category, {score} AS e FROM train), k AS (SELECT category, e, row_number() OVER (PARTITION BY category ORDER BY e) AS r, count(*) OVER (PARTITION BY category) AS n FROM e)"


@query(f"{FC}, {ranked('actual - predicted')}, q AS (SELECT category, max(e) FILTER (r = least(n, greatest(1, ceil((n + 1) * ((1 - 0.9::DOUBLE) / 2))))) AS lo, max(e) FILTER (r = least(n, greatest(1, ceil((n + 1) * ((1 + 0.9::DOUBLE) / 2))))) AS hi FROM k GROUP BY 1) SELECT key, week_idx, round(greatest(predicted + lo, 0), 6) AS lower, round(predicted + hi, 6) AS upper FROM fc JOIN q USING (category)")
def interval_conformal_signed(spark, sf_dir):
    return shown(correct.conformal(fc(spark, sf_dir), train(spark, sf_dir), "category", method="signed"), "lower", "upper")


@query(f"{FC}, {ranked('abs(actual - predicted) / greatest(abs(predicted), 1)')}, q AS (SELECT category, e AS q FROM k WHERE r = least(n, greatest(1, ceil((n + 1) * 0.9::DOUBLE)))) SELECT key, week_idx, round(greatest(predicted - q * greatest(abs(predicted), 1), 0), 6) AS lower, round(predicted + q * greatest(abs(predicted), 1), 6) AS upper FROM fc JOIN q USING (category)")
def interval_conformal_normalised(spark, sf_dir):
    return shown(correct.conformal(fc(spark, sf_dir), train(spark, sf_dir), "category", method="normalised"), "lower", "upper")


@query(f"{SCORED}, m AS (SELECT avg({E}) AS m, stddev_samp({E}) AS s FROM scored) SELECT key, week_idx, round({E}, 6) AS abs_error, round(({E} - m) / s, 6) AS score FROM scored, m WHERE ({E} - m) / s > 3")
def error_outliers_zscore(spark, sf_dir):
    return rounded(evaluate.error_outliers(scored(spark, sf_dir), 3.0, "zscore"), "key", "week_idx", "abs_error", "score")


@query(f"{SCORED}, s AS (SELECT category, count(*) AS n, sum({E}) / sum(actual) AS wape, sum(predicted - actual) / sum(actual) AS bias FROM scored GROUP BY 1), o AS (SELECT sum({E}) / sum(actual) AS wape, abs(sum(predicted - actual) / sum(actual)) AS bias FROM scored) SELECT 'wape' AS \"check\", round(wape, 6) AS value, wape <= 0.3 AS passed FROM o UNION ALL SELECT 'bias', round(bias, 6), bias <= 0.1 FROM o UNION ALL SELECT 'segment', round(max(wape), 6), max(wape) <= 0.5 FROM s")
def verdict_checks(spark, sf_dir):
    return rounded(evaluate.checks(scored(spark, sf_dir), by="category"), "check", "value", "passed")


@query(f"{SCORED}, p AS (SELECT week_idx % 13 + 1 AS h, sum({E}) / sum(actual) AS w FROM scored GROUP BY 1), g AS (SELECT h, w, (14 - h) / 91.0::DOUBLE AS linear FROM p) SELECT round(sum(w * linear) / sum(linear), 6) AS wape FROM g")
def horizon_weighted_wape(spark, sf_dir):
    rows = scored(spark, sf_dir).withColumn("h", F.col("week_idx") % 13 + 1)
    return rounded(forecast.weighted_wape(rows, forecast.horizon_weights(spark, 13, (4, 5)), "linear"), "wape")


@query(f"{BRAND} SELECT key, week_idx, h::INT AS h, (week_idx + h)::INT AS target_idx, round((14 - h) / 91.0::DOUBLE, 6) AS weight FROM panel, (SELECT unnest(range(1, 14)) AS h)")
def horizon_expanded(spark, sf_dir):
    weights = forecast.horizon_weights(spark, 13, (4, 5))
    return rounded(forecast.expanded(brand_week(spark, sf_dir).select("key", "week_idx"), weights, "linear"), "key", "week_idx", "h", "target_idx", "weight")


@query(f"{PART}, u AS (SELECT DISTINCT key, y FROM panel WHERE y > 0), b AS (SELECT key, min(y) AS b, min(y - before) AS g FROM (SELECT key, y, lag(y) OVER (PARTITION BY key ORDER BY y) AS before FROM u) GROUP BY 1), f AS (SELECT key, b, g, max(abs(y / b - round(y / b))) AS far, avg((abs(y / g - round(y / g)) < 0.1)::INT) AS share FROM panel JOIN b USING (key) WHERE y > 0 GROUP BY ALL) SELECT key, CASE WHEN far <= 0.05 THEN b WHEN share > 0.8 THEN g END AS unit FROM f")
def discrete_base_unit(spark, sf_dir):
    return profile.base_unit(part_week(spark, sf_dir))


@query(f"{PART}, n AS (SELECT key, y AS level, count(*) AS n FROM panel GROUP BY 1, 2) SELECT key, level, round(n / sum(n) OVER w, 6) AS share, round(max(n) OVER w / min(n) OVER w, 6) AS imbalance FROM n WINDOW w AS (PARTITION BY key)")
def discrete_level_shares(spark, sf_dir):
    return rounded(profile.level_shares(part_week(spark, sf_dir)), "key", "level", "share", "imbalance")


@query(f"WITH p AS (SELECT p_brand, p_type, p_size, 'M' || substr(p_brand, 7, 1) AS maker, 'Z' || substr(p_brand, 7, 1) AS again FROM part), c AS (SELECT 'p_brand' AS col, count(DISTINCT p_brand) AS v FROM p UNION ALL SELECT 'p_size', count(DISTINCT p_size) FROM p UNION ALL SELECT 'maker', count(DISTINCT maker) FROM p UNION ALL SELECT 'again', count(DISTINCT again) FROM p UNION ALL SELECT 'p_type', count(DISTINCT p_type) FROM p) SELECT col AS \"column\", v AS n_values, 1.0::DOUBLE AS covered, col <> 'p_size' AND v >= 2 AND col <> 'p_type' AS accepted, CASE WHEN col = 'again' THEN 'maker' END AS alike FROM c")
def hierarchy_grouping_columns(spark, sf_dir):
    rows = table(spark, sf_dir, "part").select(F.col("p_brand").alias("key"), "p_brand", F.concat(F.lit("M"), F.substring("p_brand", 7, 1)).alias("maker"), F.concat(F.lit("Z"), F.substring("p_brand", 7, 1)).alias("again"), "p_type", "p_size")
    return segment.grouping_columns(rows, ["p_brand", "maker", "again", "p_type", "p_size"], most=45)


@query(f"{KEYS}, g AS (SELECT key, lag(y, 1) OVER w AS l1, lag(y, 2) OVER w AS l2, y FROM sparse WINDOW w AS (PARTITION BY key ORDER BY week_idx)), a AS (SELECT key, count(*) AS n, CASE WHEN count(*) >= 7 THEN corr(y, l1) END AS a1, CASE WHEN count(*) >= 7 THEN corr(y, l2) END AS a2 FROM g GROUP BY 1), r AS (SELECT tier AS segment, mode(pattern) AS p0, avg((abs(a1) > 1.96 / sqrt(a.n))::INT) AS h1, avg((abs(a2) > 1.96 / sqrt(a.n))::INT) AS h2 FROM a JOIN keys USING (key) GROUP BY 1), pc AS (SELECT tier AS segment, pattern FROM keys GROUP BY 1, pattern QUALIFY row_number() OVER (PARTITION BY tier ORDER BY count(*) DESC, pattern) = 1) SELECT segment, CASE WHEN h1 >= 0.5 OR h2 >= 0.5 THEN array_to_string(list_sort(list_distinct([1, 4, 52] || CASE WHEN h2 >= 0.5 THEN [2] ELSE [] END)), ',') ELSE CASE pattern WHEN 'smooth' THEN '1,2,4,13,52' WHEN 'erratic' THEN '1,4,13,52' WHEN 'intermittent' THEN '1,4,26,52' ELSE '1,13,52' END END AS lags FROM r JOIN pc USING (segment)")
def adaptive_segment_lags(spark, sf_dir):
    segments = keys(spark, sf_dir).select("key", F.col("tier").alias("segment"), "pattern")
    out = profile.segment_lags(sparse(spark, sf_dir), segments, [1, 2])
    return out.select("segment", F.concat_ws(",", F.transform("lags", lambda x: x.cast("string"))).alias("lags"))


@query()
def isotonic_calibration(spark, sf_dir):
    return shown(models.isotonic(train(spark, sf_dir), fc(spark, sf_dir)))


@query()
def blend_penalty_choice(spark, sf_dir):
    rows = parts(spark, sf_dir).where("week_idx > 1500").withColumn("snapshot", F.expr("int(week_idx div 60)"))
    return rounded(combine.choose_alpha(rows, [[], ["category"]], combine.cube(1.5, 0.5, 3), [0.0, 0.05, 1.0], "snapshot"), "alpha", "wape")


def weighted(fit, *names):  # noqa: ANN001, ANN002
    return fit.select(*names, *[F.round(F.col("weights")[i], 4).alias(f"w_{p}") for i, p in enumerate(combine.PARTS)])


@query()
def blend_fit_certified(spark, sf_dir):
    fit = convex.fit_convex(parts(spark, sf_dir), ["category"])
    return weighted(fit.withColumn("loss", F.round("loss", 4)).withColumn("certified", F.col("gap") <= 1e-4), "category", "loss", "certified")


@query()
def blend_deployed_certified(spark, sf_dir):
    rows = parts(spark, sf_dir)
    volumes = rows.groupBy("category", "segment").agg((F.sum("actual") / 10).alias("volume"))
    segments = combine.guardrail(rows, convex.fit_convex(rows, ["category", "segment"]), ["category", "segment"])
    shrunk = combine.shrink(segments, combine.guardrail(rows, convex.fit_convex(rows, ["category"]), ["category"]), volumes)
    return weighted(combine.calibrated(rows, shrunk, ["category", "segment"]), "category", "segment")


@query()
def blend_levels_certified(spark, sf_dir):
    fit = convex.fit_levels(parts(spark, sf_dir), [[], ["category"], ["category", "segment"]], 0.05)
    return weighted(fit.withColumn("certified", F.col("gap") <= 1e-4), "category", "segment", "certified")
