"""Queries: corrections. Forecasts are the scored rows after week 1600, training rows those up to it."""

from __future__ import annotations

from pyspark.sql import functions as F

from demandloom.operators import correct as op
from demandloom.plans.features import rounded, sparse
from demandloom.plans.joining import SCORED, scored
from demandloom.plans.panels import brand_week, part_week
from demandloom.plans.registry import query

END = 1608
FC = f"{SCORED}, fc AS (SELECT * FROM scored WHERE week_idx > {END}), train AS (SELECT * FROM scored WHERE week_idx <= {END}), ly AS (SELECT key, week_idx + 52 AS week_idx, y AS sply FROM panel)"
TOTALS = f"{FC}, tot AS (SELECT key, sum(predicted) AS forecast, sum(sply) AS sply, count(*) AS n FROM fc LEFT JOIN ly USING (key, week_idx) GROUP BY 1)"
GROWTH = f"gs AS (SELECT key, coalesce(sum(y) FILTER (week_idx > {END - 13} AND week_idx <= {END}), 0) AS a, coalesce(sum(y) FILTER (week_idx > {END - 65} AND week_idx <= {END - 52}), 0) AS b, count(y) FILTER (week_idx > {END - 13} AND week_idx <= {END}) AS n FROM panel GROUP BY 1), growth AS (SELECT key, CASE WHEN n < 4 OR b <= 0 THEN 1.0::DOUBLE WHEN a <= 0 THEN 0.5 ELSE least(greatest(a / b, 0.2), 5) END AS growth FROM gs)"


def fc(spark, sf_dir):
    return scored(spark, sf_dir).where(f"week_idx > {END}")


def train(spark, sf_dir):
    return scored(spark, sf_dir).where(f"week_idx <= {END}")


def shown(df, *more):
    return rounded(df, "key", "week_idx", *(more or ("corrected",)))


@query(f"{TOTALS} SELECT key, week_idx, round(predicted * least(greatest(1 + 0.5::DOUBLE * (sply / forecast - 1), 0.5), 2.5), 6) AS corrected FROM fc JOIN tot USING (key)")
def seasonal_correct(spark, sf_dir):
    return shown(op.seasonal_correct(fc(spark, sf_dir), brand_week(spark, sf_dir)))


@query(f"{FC}, {GROWTH} SELECT key, round(growth, 6) AS growth FROM growth")
def yoy_growth_factor(spark, sf_dir):
    return rounded(op.growth_factor(brand_week(spark, sf_dir), END), "key", "growth")


@query(f"{FC}, {GROWTH} SELECT key, week_idx, round(CASE WHEN sply > 0 THEN 0.6::DOUBLE * predicted + 0.4::DOUBLE * sply * growth ELSE predicted END, 6) AS corrected FROM fc LEFT JOIN ly USING (key, week_idx) JOIN growth USING (key)")
def sply_blend(spark, sf_dir):
    return shown(op.sply_blend(fc(spark, sf_dir), brand_week(spark, sf_dir), END))


@query(f"{TOTALS}, rec AS (SELECT key, avg(y) AS rate FROM panel WHERE week_idx > {END - 13} AND week_idx <= {END} GROUP BY 1), rel AS (SELECT key, 1 - sum(abs(benchmark - actual)) / sum(actual) AS reliability FROM train GROUP BY 1), f AS (SELECT key, CASE WHEN reliability >= 0.55 AND sply > forecast AND sply > coalesce(rate, 0) * n THEN least(greatest(sply / forecast, 1), 3) ELSE 1 END AS f FROM tot LEFT JOIN rec USING (key) LEFT JOIN rel USING (key)) SELECT key, week_idx, round(predicted * f, 6) AS corrected FROM fc JOIN f USING (key)")
def seasonal_trust_lift(spark, sf_dir):
    rel = train(spark, sf_dir).groupBy("key").agg((1 - F.sum(F.abs(F.col("benchmark") - F.col("actual"))) / F.sum("actual")).alias("reliability"))
    return shown(op.trust_lift(fc(spark, sf_dir), brand_week(spark, sf_dir), END, rel, least=0.55))


@query(f"{FC}, r AS (SELECT key, avg(y) AS recent, stddev_samp(y) / avg(y) AS cv, sum(y) FILTER (week_idx > {END - 6}) AS late, sum(y) FILTER (week_idx <= {END - 7}) AS early FROM panel WHERE week_idx > {END - 13} AND week_idx <= {END} GROUP BY 1), f AS (SELECT key, CASE WHEN cv < 0.8 AND late >= 0.75 * early AND level < 1.05::DOUBLE * recent THEN least(greatest(1.05::DOUBLE * recent / level, 1), 3) ELSE 1 END AS f FROM (SELECT key, avg(predicted) AS level FROM fc GROUP BY 1) LEFT JOIN r USING (key)) SELECT key, week_idx, round(predicted * f, 6) AS corrected FROM fc JOIN f USING (key)")
def undamp_lift(spark, sf_dir):
    return shown(op.undamp(fc(spark, sf_dir), brand_week(spark, sf_dir), END, floor=1.05))


@query(f"{FC}, f AS (SELECT category, least(greatest(1 + 0.7::DOUBLE * (sum(actual) / sum(predicted) - 1), 0.5), 1.8) AS f FROM train GROUP BY 1) SELECT key, week_idx, round(predicted * f, 6) AS corrected FROM fc JOIN f USING (category)")
def bias_factor_category(spark, sf_dir):
    f = op.bias_factor(train(spark, sf_dir), ["category"], damp=0.7)
    return shown(op.apply_factor(fc(spark, sf_dir), (f, ["category"])))


def factor(by: str, lo: float, hi: float, having: str = "") -> str:
    return f"SELECT {by + ',' if by else ''} least(greatest(sum(actual) / sum(predicted), {lo}), {hi}) AS f FROM tb {'GROUP BY ' + by if by else ''} {having}"


@query(f"{FC}, e AS (SELECT quantile_cont(benchmark, [0.25, 0.5, 0.75]) AS e FROM train), tb AS (SELECT train.*, len(list_filter(e, lambda x: x < benchmark)) AS bucket FROM train, e), fb AS (SELECT fc.*, len(list_filter(e, lambda x: x < benchmark)) AS bucket FROM fc, (SELECT quantile_cont(benchmark, [0.25, 0.5, 0.75]) AS e FROM fc)), a AS ({factor('category, bucket', 0.2, 2.0, 'HAVING count(*) >= 100')}), b AS ({factor('category', 0.2, 2.0, 'HAVING count(*) >= 100')}), c AS ({factor('', 0.2, 2.0)}) SELECT key, week_idx, round(predicted * coalesce(a.f, b.f, c.f), 6) AS corrected FROM fb LEFT JOIN a USING (category, bucket) LEFT JOIN b USING (category), c")
def bias_calibration_buckets(spark, sf_dir):
    a, b = (op.quantile_bucket(x(spark, sf_dir), "benchmark", 4) for x in (fc, train))
    return shown(op.bias_by_bucket(a, b, 100))


@query(f"{FC}, tb AS (SELECT *, week_idx % 4 AS h FROM train), a AS ({factor('category, h', 0.3, 3.0)}) SELECT key, week_idx, round(predicted * f, 6) AS corrected FROM fc JOIN a ON a.category = fc.category AND a.h = fc.week_idx % 4")
def bias_calibration_lag(spark, sf_dir):
    a, b = (x(spark, sf_dir).withColumn("h", F.col("week_idx") % 4) for x in (fc, train))
    return shown(op.bias_by_lag(a, b))


@query(f"{FC}, tb AS (SELECT * FROM train), a AS ({factor('key', 0.5, 1.8, 'HAVING count(*) >= 30')}) SELECT key, week_idx, round(predicted * coalesce(f, 1), 6) AS corrected FROM fc LEFT JOIN a USING (key)")
def segment_calibration(spark, sf_dir):
    return shown(op.apply_factor(fc(spark, sf_dir), (op.bias_factor(train(spark, sf_dir), ["key"], least=30), ["key"])))


@query(f"{SCORED} SELECT category, round(avg(predicted - actual), 6) AS bias, round(avg(predicted - actual) / (stddev_samp(predicted - actual) / sqrt(count(*))), 5) AS t, round(regr_slope(actual, predicted), 6) AS slope, abs(avg(predicted - actual) / (stddev_samp(predicted - actual) / sqrt(count(*)))) > 1.96 AS biased FROM scored GROUP BY 1")
def systematic_bias_test(spark, sf_dir):
    return rounded(op.systematic_bias(scored(spark, sf_dir), ["category"]).withColumn("t", F.round("t", 5)), "category", "bias", "t", "slope", "biased")


@query(f"{SCORED}, e AS (SELECT *, avg(predicted - actual) OVER w AS b, count(*) OVER w AS n FROM scored WINDOW w AS (PARTITION BY key ORDER BY week_idx ROWS BETWEEN 52 PRECEDING AND 1 PRECEDING)) SELECT key, week_idx, round(greatest(predicted - CASE WHEN n >= 12 THEN b ELSE 0 END, 0), 6) AS corrected FROM e")
def rolling_bias_correction(spark, sf_dir):
    return shown(op.rolling_bias(scored(spark, sf_dir)))


@query(f"{FC}, l AS (SELECT category, regr_slope(actual, predicted) AS a, regr_intercept(actual, predicted) AS b FROM train GROUP BY 1) SELECT key, week_idx, round(greatest(b + a * predicted, 0), 5) AS corrected FROM fc JOIN l USING (category)")
def linear_isotonic_calibration(spark, sf_dir):
    return shown(op.linear_calibration(fc(spark, sf_dir), train(spark, sf_dir), "category").withColumn("corrected", F.round("corrected", 5)))


MOQ = "q AS (SELECT key, quantile_cont(y, [0.4, 0.5, 0.6, 0.7, 0.8]) AS q, count(*) AS n, sum(y) AS s FROM mp WHERE y > 0 GROUP BY 1), d AS (SELECT key, q[1] AS a, q[2] AS b, q[3] / q[1] AS r1, q[4] / q[1] AS r2, q[4] / q[2] AS r3, q[5] / q[2] AS r4 FROM q WHERE n > 30 AND s > 60), moq AS (SELECT key, CASE WHEN a >= 48 AND (abs(r1 - round_even(r1, 0)) / round_even(r1, 0) <= 0.02 OR abs(r2 - round_even(r2, 0)) / round_even(r2, 0) <= 0.02) THEN a WHEN b >= 48 AND (abs(r3 - round_even(r3, 0)) / round_even(r3, 0) <= 0.02 OR abs(r4 - round_even(r4, 0)) / round_even(r4, 0) <= 0.02) THEN b END AS multiple FROM d)"
MP = f"{FC}, mp AS (SELECT key, week_idx, ceil(y / 60) * 60 AS y FROM panel)"


def multiples(spark, sf_dir):
    return brand_week(spark, sf_dir).select("key", "week_idx", F.expr("ceil(y / 60) * 60D").alias("y"))


@query(f"{MP}, {MOQ} SELECT key, multiple FROM moq WHERE multiple IS NOT NULL")
def moq_detect(spark, sf_dir):
    return op.order_multiple(multiples(spark, sf_dir))


def rounded_sql(t: str) -> str:
    """SQL of a forecast rounded to multiples of 60 at a threshold."""
    return f"CASE WHEN predicted > 0 THEN (floor(predicted / 60) + CASE WHEN predicted / 60 - floor(predicted / 60) > {t} THEN 1 ELSE 0 END) * 60 ELSE 0 END"


# Keys of brand 1 have no history, brand 2's is nought: both are rounded at half.
@query(
    f"{FC}, m AS (SELECT DISTINCT key FROM fc WHERE key < 'Brand#4'), tg AS (SELECT key, avg(CASE WHEN key >= 'Brand#2' AND key < 'Brand#3' THEN 0 ELSE actual END) AS target FROM train WHERE key >= 'Brand#2' GROUP BY 1), "
    f"h AS (SELECT * FROM fc SEMI JOIN m USING (key) QUALIFY row_number() OVER (PARTITION BY key ORDER BY week_idx) <= 53), sw AS (SELECT key, t, avg({rounded_sql('t')}) AS m FROM h, (SELECT unnest(range(3, 19)) / 20.0::DOUBLE AS t) GROUP BY 1, 2), "
    "best AS (SELECT key, t FROM sw JOIN tg USING (key) WHERE target <> 0 QUALIFY row_number() OVER (PARTITION BY key ORDER BY round(abs(1 - sw.m / target), 9), t DESC) = 1) "
    f"SELECT key, week_idx, CASE WHEN m.key IS NULL THEN predicted ELSE {rounded_sql('coalesce(t, 0.5)')} END AS rounded FROM fc LEFT JOIN m USING (key) LEFT JOIN best USING (key)"
)
def moq_round(spark, sf_dir):
    rows = fc(spark, sf_dir)
    m = rows.where("key < 'Brand#4'").select("key", F.lit(60.0).alias("multiple")).distinct()
    target = F.when(F.col("key").between("Brand#2", "Brand#29"), 0.0).otherwise(F.col("actual"))
    targets = train(spark, sf_dir).where("key >= 'Brand#2'").groupBy("key").agg(F.avg(target).alias("target"))
    return op.moq_round(rows, m, targets).select("key", "week_idx", "rounded")


@query(f"{FC}, a AS (SELECT key, 2 + row_number() OVER (ORDER BY key) AS adi FROM (SELECT DISTINCT key FROM fc)) SELECT key, week_idx, CASE WHEN adi >= 4 AND predicted / 1000 < 1.0::DOUBLE / adi THEN 0 ELSE predicted / 1000 END AS corrected FROM fc JOIN a USING (key)")
def zero_clip_intermittent(spark, sf_dir):
    rows = fc(spark, sf_dir).withColumn("predicted", F.col("predicted") / 1000)
    adi = rows.select("key").distinct().withColumn("adi", F.expr("2D + row_number() over (order by key)"))
    return op.zero_clip(rows, adi, 4.0).select("key", "week_idx", "corrected")


@query(f"{FC} SELECT key, week_idx, round(CASE WHEN key < 'Brand#2' THEN 0 WHEN key >= 'Brand#5' THEN predicted * 0.8::DOUBLE * greatest(1, 1.5::DOUBLE - 0.5::DOUBLE * (week_idx - {END} - 1) / 12) ELSE predicted END, 6) AS corrected FROM fc")
def lifecycle_rules(spark, sf_dir):
    rows = fc(spark, sf_dir).withColumn("h", F.col("week_idx") - END)
    return shown(op.lifecycle(rows, rows.where("key < 'Brand#2'"), rows.where("key >= 'Brand#5'")))


@query(f"{FC}, l AS (SELECT DISTINCT key, y FROM panel WHERE week_idx <= {END} AND week_idx > {END - 20}) SELECT key, week_idx, arg_min(y, struct_pack(d := abs(y - predicted), v := y)) AS snapped FROM fc JOIN l USING (key) GROUP BY 1, 2")
def snap_to_levels(spark, sf_dir):
    levels = brand_week(spark, sf_dir).where(f"week_idx <= {END} and week_idx > {END - 20}")
    return op.snap_to_levels(fc(spark, sf_dir), levels).select("key", "week_idx", "snapped")


@query(f"{FC}, s AS (SELECT week_idx, sum(predicted) AS s, sum(actual) AS t FROM fc GROUP BY 1), f AS (SELECT week_idx, CASE WHEN abs(t / s - 1) > 0.05 THEN least(greatest(t / s, 0.5), 2) ELSE 1 END AS f FROM s) SELECT key, week_idx, round(predicted * f, 6) AS corrected FROM fc JOIN f USING (week_idx)")
def topdown_scale(spark, sf_dir):
    rows = fc(spark, sf_dir)
    return shown(op.topdown(rows, rows.groupBy("week_idx").agg(F.sum("actual").alias("total"))))


@query(f"{FC}, s AS (SELECT week_idx, sum(predicted) AS s FROM fc GROUP BY 1), b AS (SELECT week_idx, sum(sply) AS b FROM ly GROUP BY 1), f AS (SELECT week_idx, least(greatest(s / b, 0.85), 1.15) / (s / b) AS f FROM s JOIN b USING (week_idx)) SELECT key, week_idx, round(predicted * f, 6) AS corrected FROM fc JOIN f USING (week_idx)")
def yoy_sanity_check(spark, sf_dir):
    return shown(op.yoy_sanity(fc(spark, sf_dir), brand_week(spark, sf_dir)))


@query(f"{TOTALS}, {GROWTH}, f AS (SELECT key, CASE WHEN sply > 0 THEN least(greatest(sply * growth / forecast, 0.5), 2) ELSE 1 END AS f FROM tot JOIN growth USING (key)) SELECT key, week_idx, round(predicted * f, 6) AS corrected FROM fc JOIN f USING (key)")
def yoy_trend_adjust(spark, sf_dir):
    return shown(op.yoy_trend(fc(spark, sf_dir), brand_week(spark, sf_dir), END))


@query(f"{FC} SELECT 'key' AS level, key AS node, week_idx, round(sum(predicted), 5) AS predicted FROM fc GROUP BY ALL UNION ALL SELECT 'group', category, week_idx, round(sum(predicted), 5) FROM fc GROUP BY ALL UNION ALL SELECT 'total', 'all', week_idx, round(sum(predicted), 5) FROM fc GROUP BY ALL")
def reconcile_bottom_up(spark, sf_dir):
    return op.bottom_up(fc(spark, sf_dir)).withColumn("predicted", F.round("predicted", 5))


def tree(spark, sf_dir):
    rows = fc(spark, sf_dir)
    groups = rows.groupBy("week_idx", "category").agg(F.sum("benchmark").alias("predicted"))
    return rows, groups, rows.groupBy("week_idx").agg(F.sum("actual").alias("predicted"))


RECONCILED = f"{FC}, g AS (SELECT week_idx, category, sum(predicted) AS s, sum(benchmark) AS own, count(*) AS n FROM fc GROUP BY 1, 2), u AS (SELECT *, (s * 1 + own * n) / (n + 1) AS up, n / (n + 1) AS v FROM g), t AS (SELECT week_idx, sum(up) AS su, sum(v) AS sv FROM u GROUP BY 1), o AS (SELECT week_idx, sum(actual) AS own FROM fc GROUP BY 1), sh AS (SELECT u.week_idx, category, (up + v * (o.own - su) / (sv + 1) - s) / n AS shift FROM u JOIN t USING (week_idx) JOIN o USING (week_idx)), rec AS (SELECT key, category, week_idx, predicted + shift AS reconciled FROM fc JOIN sh USING (week_idx, category))"


@query(f"{RECONCILED} SELECT key, week_idx, round(reconciled, 5) AS reconciled FROM rec")
def reconcile_wls(spark, sf_dir):
    return op.reconcile(*tree(spark, sf_dir)).select("key", "week_idx", F.round("reconciled", 5).alias("reconciled"))


@query(f"{FC}, g AS (SELECT week_idx, category, abs(sum(predicted) - sum(benchmark)) AS d FROM fc GROUP BY 1, 2) SELECT week_idx, round(max(d), 5) AS group_gap, any_value(t) AS total_gap FROM g JOIN (SELECT week_idx, abs(sum(benchmark) - sum(actual)) AS t FROM fc GROUP BY 1) USING (week_idx) GROUP BY 1")
def coherence_check(spark, sf_dir):
    return op.coherence(*tree(spark, sf_dir)).withColumn("group_gap", F.round("group_gap", 5))


@query(f"{FC}, e AS (SELECT category, abs(actual - predicted) AS e, row_number() OVER (PARTITION BY category ORDER BY abs(actual - predicted)) AS r, count(*) OVER (PARTITION BY category) AS n FROM train), q AS (SELECT category, e AS q FROM e WHERE r = least(n, ceil((n + 1) * 0.9::DOUBLE))) SELECT key, week_idx, round(greatest(predicted - q, 0), 6) AS lower, round(predicted + q, 6) AS upper FROM fc JOIN q USING (category)")
def interval_conformal(spark, sf_dir):
    return shown(op.conformal(fc(spark, sf_dir), train(spark, sf_dir), "category"), "lower", "upper")
