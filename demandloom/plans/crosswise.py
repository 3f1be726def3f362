"""Queries: cross-sectional, hierarchy, calendar and encoding features."""

from __future__ import annotations

from pyspark.sql import functions as F

from demandloom.operators import cross as op
from demandloom.operators import panel as cleaning
from demandloom.plans.features import rounded
from demandloom.plans.panels import BRAND, PART, REGION, brand_region_week, brand_week, part_week, table
from demandloom.plans.registry import query

LAGGED = f"{BRAND}, l AS (SELECT *, 'C' || substr(key, 7, 1) AS grp, lag(y) OVER (PARTITION BY key ORDER BY week_idx) AS l FROM panel)"


def grouped(spark, sf_dir):
    return brand_week(spark, sf_dir).withColumn("grp", F.expr("concat('C', substring(key, 7, 1))"))


@query(f"{LAGGED}, r AS (SELECT *, CASE WHEN l IS NOT NULL THEN dense_rank() OVER (PARTITION BY week_idx ORDER BY l NULLS LAST) END AS r FROM l) SELECT key, week_idx, round(avg(l) OVER t, 6) AS period_mean, round(l / nullif(avg(l) OVER t, 0), 6) AS relative, round(l - avg(l) OVER t, 6) AS difference, round((l - avg(l) OVER t) / nullif(stddev_samp(l) OVER t, 0), 6) AS z, round(r / max(r) OVER t, 6) AS dense_pct FROM r WINDOW t AS (PARTITION BY week_idx)")
def period_cross_section(spark, sf_dir):
    return rounded(op.cross_section(brand_week(spark, sf_dir)), "key", "week_idx", "period_mean", "relative", "difference", "z", "dense_pct")


@query(f"{LAGGED} SELECT key, week_idx, CASE WHEN l IS NOT NULL THEN round(least(l / nullif(avg(l) OVER t, 0), 20), 6) END AS to_overall, CASE WHEN l IS NOT NULL THEN round(least(l / nullif(avg(l) OVER g, 0), 20), 6) END AS to_group, round(l - quantile_cont(l, 0.5) OVER t, 6) AS from_median, CASE WHEN l IS NOT NULL THEN round((rank() OVER (PARTITION BY week_idx ORDER BY l NULLS LAST) + (count(l) OVER (PARTITION BY week_idx, l) - 1) / 2.0::DOUBLE) / count(l) OVER t, 6) END AS percentile, round(l / nullif(sum(l) OVER t, 0), 6) AS share FROM l WINDOW t AS (PARTITION BY week_idx), g AS (PARTITION BY week_idx, grp)")
def relative_features(spark, sf_dir):
    return rounded(op.relative(grouped(spark, sf_dir), "grp"), "key", "week_idx", "to_overall", "to_group", "from_median", "percentile", "share")


GROUPS = f"{LAGGED}, g AS (SELECT grp, week_idx, sum(y) AS t FROM l GROUP BY 1, 2), h AS (SELECT grp, week_idx, lag(t) OVER w AS group_total, avg(t) OVER (PARTITION BY grp ORDER BY week_idx ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING) AS group_mean_4, avg(t) OVER (PARTITION BY grp ORDER BY week_idx ROWS BETWEEN 13 PRECEDING AND 1 PRECEDING) AS group_mean_13 FROM g WINDOW w AS (PARTITION BY grp ORDER BY week_idx))"


@query(f"{GROUPS} SELECT key, week_idx, group_total, CASE WHEN l / nullif(group_total, 0) IS NOT NULL THEN round(least(l / group_total, 1), 6) ELSE 0 END AS group_share FROM l JOIN h USING (grp, week_idx)")
def hierarchy_temporal_features(spark, sf_dir):
    return rounded(op.group_history(grouped(spark, sf_dir), "grp"), "key", "week_idx", "group_total", "group_share")


@query(f"{GROUPS} SELECT key, week_idx, round(group_mean_4, 6) AS group_mean_4, round(group_mean_13, 6) AS group_mean_13 FROM l JOIN h USING (grp, week_idx)")
def group_rolling_features(spark, sf_dir):
    return rounded(op.group_history(grouped(spark, sf_dir), "grp"), "key", "week_idx", "group_mean_4", "group_mean_13")


@query(f"{PART}, g AS (SELECT category, week_idx + 1 AS week_idx, sum(y) AS group_before FROM panel GROUP BY 1, 2) SELECT key, p.week_idx, group_before FROM panel p LEFT JOIN g ON g.category = p.category AND g.week_idx = p.week_idx")
def group_prev_week_sum(spark, sf_dir):
    return op.group_previous_period(part_week(spark, sf_dir), "category").select("key", "week_idx", "group_before")


@query(f"{REGION}, s AS (SELECT *, split_part(key, '_', 1) AS product, split_part(key, '_', 2) AS account FROM panel) SELECT key, week_idx, sum(y) OVER w AS product_total, count(CASE WHEN y > 0 THEN 1 END) OVER w AS breadth, round(y / nullif(sum(y) OVER w, 0), 6) AS account_share FROM s WINDOW w AS (PARTITION BY product, week_idx)")
def cross_account_features(spark, sf_dir):
    return rounded(op.cross_account(cleaning.split_key(brand_region_week(spark, sf_dir))), "key", "week_idx", "product_total", "breadth", "account_share")


@query(f"{PART} SELECT key, round(avg(y), 6) AS mean, round(stddev_samp(y), 6) AS sd, min(y) AS least, max(y) AS most, median(y) AS median, count(y) AS n, round(stddev_samp(y) / nullif(avg(y), 0), 6) AS cv, round(avg((y = 0)::INT), 6) AS zero_fraction FROM panel WHERE week_idx < 1600 GROUP BY 1")
def key_level_stats(spark, sf_dir):
    return rounded(op.key_stats(part_week(spark, sf_dir).where("week_idx < 1600")), "key", "mean", "sd", "least", "most", "median", "n", "cv", "zero_fraction")


@query(f"{BRAND} SELECT key, round(avg(price), 4) AS price_mean, round(stddev_samp(price), 4) AS price_sd, round(corr(price, y), 6) AS price_corr, round(regr_slope(price, week_idx), 5) AS price_slope FROM panel WHERE week_idx <= 1600 GROUP BY 1")
def history_embeddings(spark, sf_dir):
    rows = op.history_embedding(brand_week(spark, sf_dir), ["price"], 1600)
    return rows.select("key", F.round("price_mean", 4).alias("price_mean"), F.round("price_sd", 4).alias("price_sd"), F.round("price_corr", 6).alias("price_corr"), F.round("price_slope", 5).alias("price_slope"))


@query(f"{PART} SELECT key, sum(y) AS volume, round(avg(y) FILTER (y > 0), 6) AS nz_mean, round(count(*) FILTER (y > 0) / count(*), 6) AS nz_fraction, round(count(*) / count(*) FILTER (y > 0), 6) AS adi, round(greatest(count(*) FILTER (y > 0) * sum(y * y) FILTER (y > 0) / (sum(y) FILTER (y > 0) * sum(y) FILTER (y > 0)) - 1, 0), 6) AS cv2, round(max(y) / avg(y), 6) AS spike, coalesce(sum(y) FILTER (week_idx > 1652), 0) AS recent8 FROM panel GROUP BY 1")
def forecastability_statics(spark, sf_dir):
    return rounded(op.forecastability(part_week(spark, sf_dir), 1660), "key", "volume", "nz_mean", "nz_fraction", "adi", "cv2", "spike", "recent8")


@query(f"{BRAND} SELECT DISTINCT week_idx, year(week_start)::INT AS year, quarter(week_start)::INT AS quarter, month(week_start)::INT AS month, week(week_start)::INT AS week, ((day(week_start) - 1) // 7 + 1)::INT AS week_of_month, dayofyear(week_start)::INT AS day_of_year, (day(week_start) = 1)::INT AS month_start, (week_start = last_day(week_start))::INT AS month_end FROM panel")
def calendar_features(spark, sf_dir):
    return op.calendar(brand_week(spark, sf_dir).select("week_idx", "week_start").distinct()).drop("week_start")


@query(f"{BRAND} SELECT DISTINCT week_idx, " + ", ".join(f"round({f}(week_idx * {k} * 2 * pi() / 52), 6) AS {f}_{k}" for k in (1, 2, 3) for f in ("sin", "cos")) + " FROM panel")
def cyclical_fourier(spark, sf_dir):
    rows = op.fourier(brand_week(spark, sf_dir).select("week_idx").distinct(), "week_idx", 52)
    return rounded(rows, "week_idx", *[f"{f}_{k}" for k in (1, 2, 3) for f in ("sin", "cos")])


# Easter by the full-moon tables of another published form of the rule.
EVENTS = """years AS (SELECT DISTINCT year(o_orderdate)::INT AS year FROM orders),
    e1 AS (SELECT year, year % 19 AS a, year // 100 AS b, year % 100 AS c FROM years),
    e2 AS (SELECT *, (19 * a + b - b // 4 - (b - (b + 8) // 25 + 1) // 3 + 15) % 30 AS h FROM e1),
    e3 AS (SELECT *, (32 + 2 * (b % 4) + 2 * (c // 4) - h - c % 4) % 7 AS l FROM e2),
    e4 AS (SELECT *, (a + 11 * h + 22 * l) // 451 AS m FROM e3),
    e5 AS (SELECT year, make_date(year, (h + l - 7 * m + 114) // 31, (h + l - 7 * m + 114) % 31 + 1) AS easter FROM e4),
    ev AS (SELECT year, 'easter' AS event, easter AS day FROM e5 UNION ALL SELECT year, 'shrove_tuesday', easter - 47 FROM e5 UNION ALL SELECT year, 'good_friday', easter - 2 FROM e5
        UNION ALL SELECT year, 'pentecost', easter + 49 FROM e5 UNION ALL SELECT year, 'christmas', make_date(year, 12, 25) FROM e5
        UNION ALL SELECT year, 'black_friday', make_date(year, 11, (11 - dayofweek(make_date(year, 11, 1))) % 7 + 1) + 22 FROM e5)"""


def years(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("year")).distinct()


@query(f"WITH {EVENTS} SELECT year, event, day FROM ev")
def easter_date(spark, sf_dir):
    return op.event_calendar(years(spark, sf_dir))


WEEKLY_EVENTS = f"{BRAND}, {EVENTS}, k AS (SELECT DISTINCT week_idx FROM panel), d AS (SELECT event, (date_diff('day', DATE '1970-01-05', day) - ((date_diff('day', DATE '1970-01-05', day) % 7 + 7) % 7)) // 7 AS wk FROM ev)"


@query(f"{WEEKLY_EVENTS} SELECT k.week_idx, event, (arg_min(wk - k.week_idx, abs(wk - k.week_idx) * 1000 + (wk - k.week_idx)))::INT AS distance FROM k JOIN d ON abs(wk - k.week_idx) <= 60 GROUP BY 1, 2")
def weeks_to_event(spark, sf_dir):
    return op.weeks_to_event(brand_week(spark, sf_dir), op.event_calendar(years(spark, sf_dir)))


@query(f"{WEEKLY_EVENTS} SELECT k.week_idx, (SELECT count(*) FROM d WHERE wk = k.week_idx) AS n_holidays, (k.week_idx + 1 IN (SELECT wk FROM d))::INT AS pre_holiday, (k.week_idx - 1 IN (SELECT wk FROM d))::INT AS post_holiday FROM k")
def holiday_calendar_join(spark, sf_dir):
    return op.holidays(brand_week(spark, sf_dir).select("week_idx").distinct(), op.event_calendar(years(spark, sf_dir)))


@query(f"{PART}, o AS (SELECT *, sum((promo = 0)::INT) OVER (PARTITION BY key ORDER BY week_idx) AS off FROM panel), n AS (SELECT key, week_idx, CASE WHEN promo = 1 THEN sum((promo = 1)::INT) OVER (PARTITION BY key, off ORDER BY week_idx) ELSE 0 END::BIGINT AS promo_week FROM o) SELECT *, (promo_week = 1)::INT AS promo_start, (promo_week = 2)::INT AS promo_second FROM n")
def promo_week_number(spark, sf_dir):
    return op.promo_week_number(part_week(spark, sf_dir)).select("key", "week_idx", "promo_week", "promo_start", "promo_second")


@query("WITH f AS (SELECT p_brand, sum(p_size) AS s, count(*) AS n FROM part WHERE p_partkey % 3 > 0 AND p_brand < 'Brand#44' GROUP BY 1), g AS (SELECT avg(p_size) AS g FROM part WHERE p_partkey % 3 > 0 AND p_brand < 'Brand#44') SELECT p_partkey, round(coalesce((s + 10 * g) / (n + 10), g), 6) AS p_brand_te FROM part LEFT JOIN f USING (p_brand), g")
def target_encode(spark, sf_dir):
    parts = table(spark, sf_dir, "part")
    return rounded(op.target_encode(parts, parts.where("p_partkey % 3 > 0 and p_brand < 'Brand#44'"), "p_brand", "p_size"), "p_partkey", "p_brand_te")


@query("WITH f AS (SELECT p_brand, count(*) AS n FROM part WHERE p_brand < 'Brand#44' GROUP BY 1) SELECT p_partkey, round(coalesce(n / (SELECT sum(n) FROM f), 0), 6) AS p_brand_freq FROM part LEFT JOIN f USING (p_brand)")
def frequency_encode(spark, sf_dir):
    parts = table(spark, sf_dir, "part")
    return rounded(op.frequency_encode(parts, parts.where("p_brand < 'Brand#44'"), "p_brand"), "p_partkey", "p_brand_freq")


@query("WITH f AS (SELECT p_type, (row_number() OVER (ORDER BY p_type) - 1)::INT AS c FROM (SELECT DISTINCT p_type FROM part WHERE p_type <> 'PROMO')) SELECT p_partkey, coalesce(c, -1)::INT AS p_type_code FROM part LEFT JOIN f USING (p_type)")
def ordinal_encode(spark, sf_dir):
    parts = table(spark, sf_dir, "part")
    return op.ordinal_encode(parts, parts.where("p_type <> 'PROMO'"), "p_type").select("p_partkey", "p_type_code")


@query("SELECT l_orderkey, l_linenumber, (l_returnflag = 'N')::INT AS flag_n, (l_returnflag = 'R')::INT AS flag_r FROM lineitem")
def onehot_encode(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    return op.onehot_encode(rows, rows, "l_returnflag").select("l_orderkey", "l_linenumber", F.col("l_returnflag_N").alias("flag_n"), F.col("l_returnflag_R").alias("flag_r"))


@query("WITH h AS (SELECT p_partkey, ('0x' || substr(md5(p_brand), 1, 8))::BIGINT % 8 AS b FROM part) SELECT p_partkey, " + ", ".join(f"(b = {i})::INT AS p_brand_h{i}" for i in range(8)) + " FROM h")
def hash_encode(spark, sf_dir):
    return op.hash_encode(table(spark, sf_dir, "part").select("p_partkey", "p_brand"), "p_brand").drop("p_brand")


MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("WITH c AS (" + " UNION ALL ".join(f"SELECT '{m}' AS \"column\", abs(corr({m}, l_extendedprice * (1 - l_discount))) AS c FROM lineitem" for m in MEASURES) + ") SELECT \"column\" FROM c ORDER BY c DESC LIMIT 2")
def select_by_correlation(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").withColumn("revenue", F.expr("l_extendedprice * (1 - l_discount)"))
    return spark.createDataFrame([(c,) for c in op.select_by_correlation(rows, MEASURES, "revenue", 2, 0.999)], "column string")


@query("SELECT \"column\", round(variance, 5) AS variance FROM (SELECT 'l_quantity' AS \"column\", var_samp(l_quantity) AS variance FROM lineitem UNION ALL SELECT 'l_discount', var_samp(l_discount) FROM lineitem UNION ALL SELECT 'l_tax', var_samp(l_tax) FROM lineitem) WHERE variance >= 0.0008")
def select_by_variance(spark, sf_dir):
    rows = op.correlations(table(spark, sf_dir, "lineitem"), ["l_quantity", "l_discount", "l_tax"], "l_quantity")
    return rows.where("variance >= 0.0008").select("column", F.round("variance", 5).alias("variance"))


@query("SELECT unnest(['l_quantity', 'l_tax', 'roll_price']) AS \"column\"")
def drop_highly_correlated(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").selectExpr("l_quantity", "l_tax", "l_extendedprice roll_price", "l_extendedprice * 2 ewm_price")
    return spark.createDataFrame([(c,) for c in op.drop_correlated(rows, rows.columns)], "column string")


@query("SELECT \"column\", round(corr, 6) AS corr, CASE WHEN \"column\" LIKE 'lag_%' THEN 'safe' WHEN abs(corr) > 0.95 THEN 'leak' ELSE 'ok' END AS verdict FROM (SELECT 'net' AS \"column\", corr(l_extendedprice * (1 - l_discount), l_extendedprice) AS corr FROM lineitem UNION ALL SELECT 'lag_net', corr(l_extendedprice * (1 - l_discount), l_extendedprice) FROM lineitem UNION ALL SELECT 'l_tax', corr(l_tax, l_extendedprice) FROM lineitem)")
def leakage_check(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").withColumn("net", F.expr("l_extendedprice * (1 - l_discount)")).withColumn("lag_net", F.col("net"))
    return rounded(op.leakage(rows, ["net", "lag_net", "l_tax"], "l_extendedprice"), "column", "corr", "verdict")
