"""Queries: joins, set operations and top-k. The benchmark is last year's week, the candidate the mean of thirteen weeks."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from demandloom.operators import joins as op
from demandloom.operators import panel as cleaning
from demandloom.plans.panels import BRAND, PART, REGION, brand_region_week, brand_week, part_week
from demandloom.plans.registry import query


def scored(spark, sf_dir):
    """key, category, week_idx, actual, predicted (mean of the 13 rows before), benchmark (the row 52 before); rows that have all."""
    w = W.partitionBy("key").orderBy("week_idx")
    rows = brand_week(spark, sf_dir).withColumn("predicted", F.round(F.avg("y").over(w.rowsBetween(-13, -1)), 6)).withColumn("benchmark", F.lag("y", 52).over(w))
    return rows.where("benchmark is not null").select("key", F.expr("concat('C', substring(key, 7, 1))").alias("category"), "week_idx", "year_week", F.col("y").alias("actual"), "predicted", "benchmark")


SCORED = f"{BRAND}, lagged AS (SELECT *, round(avg(y) OVER (PARTITION BY key ORDER BY week_idx ROWS BETWEEN 13 PRECEDING AND 1 PRECEDING), 6) AS predicted, lag(y, 52) OVER (PARTITION BY key ORDER BY week_idx) AS benchmark FROM panel), scored AS (SELECT key, 'C' || substr(key, 7, 1) AS category, week_idx, year_week, y AS actual, predicted, benchmark FROM lagged WHERE benchmark IS NOT NULL)"


@query(f"{BRAND} SELECT a.key, a.week_idx, h::INT AS h, b.week_idx AS target_idx, a.price, b.y FROM panel a, (SELECT unnest(range(1, 5)) AS h) JOIN panel b ON b.key = a.key AND b.week_idx = a.week_idx + h")
def horizon_pair_join(spark, sf_dir):
    p = brand_week(spark, sf_dir)
    return op.horizon_pairs(p.select("key", "week_idx", "price"), p.select("key", "week_idx", "y"), 4).select("key", "week_idx", "h", "target_idx", "price", "y")


@query(f"{PART} SELECT a.key, a.week_idx, b.promo AS fwd2_promo, b.price AS fwd2_price FROM panel a LEFT JOIN panel b ON b.key = a.key AND b.week_idx = a.week_idx + 2")
def forward_covariate_join(spark, sf_dir):
    return op.forward_covariates(part_week(spark, sf_dir).select("key", "week_idx", "promo", "price"), ["promo", "price"], 2).select("key", "week_idx", "fwd2_promo", "fwd2_price")


@query(f"{PART} SELECT a.key, a.week_idx, a.y AS ours, b.y AS benchmark, c.y AS actual FROM panel a JOIN panel b ON b.key = a.key AND b.week_idx = a.week_idx - 1 JOIN panel c ON c.key = a.key AND c.week_idx = a.week_idx + 1")
def three_way_forecast_join(spark, sf_dir):
    p = part_week(spark, sf_dir).select("key", "week_idx", "y")
    shift = lambda n, name: p.select("key", (F.col("week_idx") + n).alias("week_idx"), F.col("y").alias(name))
    return op.attach_forecasts(shift(0, "ours"), shift(1, "benchmark"), shift(-1, "actual"), ["key", "week_idx"])


@query(f"{PART}, s AS (SELECT key, week_idx, y AS s FROM panel WHERE promo = 1), c AS (SELECT key, week_idx, y AS c FROM panel WHERE y > 20) SELECT coalesce(s.key, c.key) AS key, coalesce(s.week_idx, c.week_idx) AS week_idx, coalesce(s, 0) AS s, coalesce(c, 0) AS c, b.y AS rf FROM s FULL JOIN c ON s.key = c.key AND s.week_idx = c.week_idx LEFT JOIN panel b ON b.key = coalesce(s.key, c.key) AND b.week_idx = coalesce(s.week_idx, c.week_idx) AND b.price < 1500")
def component_outer_join(spark, sf_dir):
    p = part_week(spark, sf_dir)
    take = lambda where, name: p.where(where).select("key", "week_idx", F.col("y").alias(name))
    return op.components(take("promo = 1", "s"), take("y > 20", "c"), take("price < 1500", "rf"), ["key", "week_idx"])


@query(f"{PART} SELECT a.key, a.week_idx, a.y AS c, coalesce(b.price, a.y) AS s FROM panel a LEFT JOIN panel b ON b.key = a.key AND b.week_idx = a.week_idx AND b.promo = 1")
def segment_component_join(spark, sf_dir):
    p = part_week(spark, sf_dir)
    return op.segment_fallback(p.select("key", "week_idx", F.col("y").alias("c")), p.where("promo = 1").select("key", "week_idx", F.col("price").alias("s")), ["key", "week_idx"])


@query(f"{PART} SELECT key, year_week, y FROM panel WHERE key NOT IN (SELECT key FROM panel GROUP BY key HAVING min(year_week) > 199510)")
def late_key_anti_join(spark, sf_dir):
    return op.late_keys_removed(part_week(spark, sf_dir).select("key", "year_week", "y"), 199510)


@query(f"{PART}, t AS (SELECT DISTINCT key FROM panel WHERE week_idx >= 1640), r AS (SELECT key, sum(y) AS r FROM panel WHERE week_idx < 1640 AND week_idx >= 1614 GROUP BY 1), m AS (SELECT DISTINCT key FROM panel WHERE week_idx < 1330) SELECT t.key, CASE WHEN coalesce(r, 0) <= 0 THEN 'dead' WHEN m.key IS NOT NULL THEN 'existing' ELSE 'new' END AS status FROM t LEFT JOIN r USING (key) LEFT JOIN m USING (key)")
def key_status_semi_anti(spark, sf_dir):
    p = part_week(spark, sf_dir)
    return op.key_status(p, p.where("week_idx < 1330"), 1640, 26)


@query(f"{BRAND}, g AS (SELECT key, (year_week // 100)::INT AS year, sum(y) AS total, CASE WHEN sum(y) > 9000 THEN 'high' ELSE 'low' END AS class FROM panel GROUP BY 1, 2) SELECT a.key, a.year, a.total, a.class, b.total AS prev_total, a.total - b.total AS delta_total, a.class <> b.class AS class_changed FROM g a LEFT JOIN g b ON a.key = b.key AND a.year = b.year + 1")
def year_over_year_self_join(spark, sf_dir):
    g = brand_week(spark, sf_dir).groupBy("key", F.expr("int(year_week div 100)").alias("year")).agg(F.sum("y").alias("total")).withColumn("class", F.expr("if(total > 9000, 'high', 'low')"))
    return op.year_over_year(g, ["total"], "class").select("key", "year", "total", "class", "prev_total", "delta_total", "class_changed")


@query(f"{PART} SELECT key, week_idx, CASE category WHEN 'PROMO' THEN 'cheap' WHEN 'ECONOMY' THEN 'cheap' WHEN 'LARGE' THEN 'bulk' ELSE 'UNMAPPED' END AS cluster FROM panel")
def mapping_broadcast_join(spark, sf_dir):
    return op.mapped(part_week(spark, sf_dir), {"PROMO": "cheap", "ECONOMY": "cheap", "LARGE": "bulk"}, "category", "cluster").select("key", "week_idx", "cluster")


FOLDS = [(0, "train", 1300, 1500), (0, "val", 1501, 1513), (1, "train", 1300, 1513), (1, "val", 1514, 1526)]


@query(f"{BRAND}, f(fold, part, lo, hi) AS (VALUES {', '.join(map(str, FOLDS))}) SELECT key, week_idx, fold, part FROM panel JOIN f ON week_idx BETWEEN lo AND hi")
def interval_fold_join(spark, sf_dir):
    folds = spark.createDataFrame(FOLDS, "fold int, part string, lo int, hi int")
    return op.in_folds(brand_week(spark, sf_dir).select("key", "week_idx"), folds)


@query(f"{PART} SELECT key, week_idx, CASE WHEN category = 'PROMO' AND promo = 1 THEN 0.5::DOUBLE WHEN category IN ('PROMO', 'SMALL') THEN 0.2::DOUBLE ELSE 0.0::DOUBLE END AS w_s, CASE WHEN category = 'PROMO' AND promo = 1 THEN 0.25::DOUBLE WHEN category IN ('PROMO', 'SMALL') THEN 0.3::DOUBLE ELSE 0.0::DOUBLE END AS w_c, CASE WHEN category = 'PROMO' AND promo = 1 THEN 0.25::DOUBLE WHEN category IN ('PROMO', 'SMALL') THEN 0.5::DOUBLE ELSE 1.0::DOUBLE END AS w_rf FROM panel")
def default_lookup_join(spark, sf_dir):
    weights = spark.createDataFrame([("PROMO", "on", 0.5, 0.25, 0.25), ("PROMO", "_default", 0.2, 0.3, 0.5), ("SMALL", "_default", 0.2, 0.3, 0.5)], "category string, segment string, w_s double, w_c double, w_rf double")
    rows = part_week(spark, sf_dir).select("key", "week_idx", "category", F.expr("if(promo = 1, 'on', 'off')").alias("segment"))
    return op.with_weights(rows, weights, (0.0, 0.0, 1.0)).select("key", "week_idx", "w_s", "w_c", "w_rf")


@query(f"{BRAND} SELECT key, year_week, y, 'y' || (year_week // 100) AS snapshot FROM panel")
def union_snapshots(spark, sf_dir):
    p = brand_week(spark, sf_dir).select("key", "year_week", "y")
    years = [r[0] for r in p.selectExpr("year_week div 100").distinct().collect()]
    return cleaning.union_tagged({f"y{y}": p.where(f"year_week div 100 = {y}") for y in years}, "snapshot")


@query(f"{PART}, d AS (SELECT key FROM panel GROUP BY key HAVING max(week_idx) < 1600), h AS (SELECT unnest(range(1660, 1673))::INT AS week_idx) SELECT key, week_idx, y AS predicted, false AS is_dead_key FROM panel WHERE week_idx >= 1660 UNION ALL SELECT key, week_idx, 0.0::DOUBLE, true FROM d, h")
def dead_key_union(spark, sf_dir):
    p = part_week(spark, sf_dir)
    dead = p.groupBy("key").agg(F.max("week_idx").alias("m")).where("m < 1600")
    horizon = spark.range(1660, 1673).select(F.col("id").cast("int").alias("week_idx"))
    return op.with_dead_keys(p.where("week_idx >= 1660").select("key", "week_idx", F.col("y").alias("predicted")), dead, horizon)


@query(f"{PART} (SELECT key, 'gone' AS side FROM (SELECT key FROM panel WHERE week_idx < 1330 EXCEPT SELECT key FROM panel WHERE week_idx >= 1640)) UNION ALL (SELECT key, 'both' FROM (SELECT key FROM panel WHERE week_idx < 1330 INTERSECT SELECT key FROM panel WHERE week_idx >= 1640))")
def key_set_difference(spark, sf_dir):
    p = part_week(spark, sf_dir)
    a, b = p.where("week_idx < 1330"), p.where("week_idx >= 1640")
    return op.keys_without(a, b).withColumn("side", F.lit("gone")).union(op.keys_in_both(a, b).withColumn("side", F.lit("both")))


@query(f"{PART}, l AS (SELECT week_idx FROM panel GROUP BY 1 HAVING sum(y) > 0 ORDER BY 1 DESC LIMIT 13), t AS (SELECT key, sum(y) AS recent FROM panel SEMI JOIN l USING (week_idx) GROUP BY 1) SELECT row_number() OVER (ORDER BY recent DESC, key)::INT AS rank, key, recent FROM t ORDER BY recent DESC, key LIMIT 20")
def top_keys_recent(spark, sf_dir):
    return op.top_recent(part_week(spark, sf_dir), 13, 20)


@query(f"{SCORED}, k AS (SELECT key, sum(actual) AS volume, round(sum(abs(predicted - actual)) / sum(actual), 6) AS wape FROM scored GROUP BY 1) (SELECT 'best' AS side, row_number() OVER (ORDER BY wape, key)::INT AS rank, key, volume, wape FROM k ORDER BY wape, key LIMIT 5) UNION ALL (SELECT 'worst', row_number() OVER (ORDER BY wape DESC, key)::INT, key, volume, wape FROM k ORDER BY wape DESC, key LIMIT 5)")
def top_bottom_performers(spark, sf_dir):
    return op.best_and_worst(scored(spark, sf_dir), 5, 100)


@query(f"{PART}, s AS (SELECT category, key, sum(y) AS volume FROM panel GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY category ORDER BY volume DESC, key)::INT AS rank, count(*) OVER (PARTITION BY category) AS n FROM s) SELECT category, key, volume, rank FROM r WHERE rank <= ceil(0.2 * n)")
def top_volume_head_set(spark, sf_dir):
    return op.volume_head(part_week(spark, sf_dir), 0.2, "category", "key")


@query(f"{PART}, s AS (SELECT key, sum(y) AS volume, avg((promo = 0)::INT) AS zero, count(*) FILTER (promo > 0) AS n FROM panel GROUP BY 1) SELECT key, volume FROM s WHERE volume >= (SELECT quantile_cont(volume, 0.8) FROM s) AND zero <= 0.9 AND n >= 3")
def select_high_volume_keys(spark, sf_dir):
    rows = part_week(spark, sf_dir)
    sums = op.high_volume_keys(rows.select("key", F.col("promo").alias("sold"), "y").withColumn("y", F.col("y")), 0.8, 1.0, 0)
    few = rows.groupBy("key").agg(F.avg((F.col("promo") == 0).cast("int")).alias("zero"), F.count_if(F.col("promo") > 0).alias("n")).where("zero <= 0.9 and n >= 3").select("key")
    return sums.join(few, "key", "left_semi")


@query(f"{SCORED} SELECT key, week_idx, actual, predicted, round(abs(predicted - actual), 6) AS abs_error FROM scored ORDER BY abs(predicted - actual) DESC, key, week_idx LIMIT 25")
def largest_abs_errors(spark, sf_dir):
    return op.largest_errors(scored(spark, sf_dir), 25, ["key", "week_idx"]).select("key", "week_idx", "actual", "predicted", F.round("abs_error", 6).alias("abs_error"))
