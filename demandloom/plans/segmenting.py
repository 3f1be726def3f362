"""Queries: segments, imputation and model forecasts. Fitted models have no SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from demandloom.operators import hierarchy, impute, models, panel, profile, windows
from demandloom.operators import segment as op
from demandloom.operators.tables import cut
from demandloom.plans.features import rounded, sparse
from demandloom.plans.panels import BRAND, PART, brand_week, part_week, table
from demandloom.plans.profiling import STATS
from demandloom.plans.registry import query


def keys(spark, sf_dir):
    rows = sparse(spark, sf_dir)
    sold = rows.groupBy("key").agg(F.count_if(F.col("y") > 0).alias("n_sold"))
    # Operators read keys several times: they are written once.
    return op.segmentation_features(cut(profile.statistics(rows).join(sold, "key"))).withColumn("segment", F.concat_ws("|", "tier", "pattern"))


KEYS = f"{STATS}, e AS (SELECT quantile_cont(total, 0.3) AS lo, quantile_cont(total, 0.7) AS hi FROM stats), k0 AS (SELECT *, CASE WHEN total <= lo THEN 'low' WHEN total <= hi THEN 'medium' ELSE 'high' END AS tier, cv * cv AS cv2, 0.5::DOUBLE * zero_fraction + 0.3::DOUBLE * least(adi / 10, 1) + 0.2::DOUBLE * least(coalesce(cv * cv, 0) / 2, 1) AS intermittency FROM stats, e), keys AS (SELECT *, 1 - intermittency AS forecastability, CASE WHEN adi <= 1.32 THEN CASE WHEN coalesce(cv2, 0) <= 0.49 THEN 'smooth' ELSE 'erratic' END WHEN coalesce(cv2, 0) <= 0.49 THEN 'intermittent' ELSE 'lumpy' END AS pattern, CASE WHEN n < 13 THEN 'new' WHEN n < 52 THEN 'growing' ELSE 'mature' END AS stage FROM k0)"


@query(f"{KEYS} SELECT key, tier, pattern, stage, round(intermittency, 6) AS intermittency, round(forecastability, 6) AS forecastability, round(1 / (1 + sqrt(coalesce(cv2, 0))), 6) AS stability, round((intermittency + 1 - 1 / (1 + sqrt(coalesce(cv2, 0)))) / 2, 6) AS complexity FROM keys")
def segmentation_features(spark, sf_dir):
    return rounded(keys(spark, sf_dir), "key", "tier", "pattern", "stage", "intermittency", "forecastability", "stability", "complexity")


MEASURES = ["total", "adi", "zero_fraction"]


@query(f"{KEYS}, sc AS (SELECT " + ", ".join(f"avg({c}) AS m_{c}, stddev_samp({c}) AS s_{c}" for c in MEASURES) + " FROM keys) SELECT key, " + ", ".join(f"round(({c} - m_{c}) / s_{c}, 5) AS z_{c}" for c in MEASURES) + " FROM keys, sc")
def scale_features(spark, sf_dir):
    out = op.with_scaled_columns(op.scaled(keys(spark, sf_dir), MEASURES), MEASURES)
    return out.select("key", *[F.round(f"z_{c}", 5).alias(f"z_{c}") for c in MEASURES])


@query()
def cluster_keys(spark, sf_dir):
    return op.clustered(op.scaled(keys(spark, sf_dir), MEASURES)).select("key", "cluster")


MERGED = f"{KEYS}, b AS (SELECT *, CASE pattern WHEN 'lumpy' THEN 3 WHEN 'erratic' THEN 2 WHEN 'intermittent' THEN 1 ELSE 0 END * 3 + CASE tier WHEN 'high' THEN 2 WHEN 'medium' THEN 1 ELSE 0 END AS cluster FROM keys), c AS (SELECT cluster, count(*) AS n, avg(zero_fraction) AS z, avg(forecastability) AS f FROM b GROUP BY 1), g AS (SELECT *, n < least(80, 0.1::DOUBLE * (SELECT sum(n) FROM c)) AND row_number() OVER (ORDER BY n DESC, cluster) > 2 AS small FROM c), t AS (SELECT a.cluster, arg_min(l.cluster, struct_pack(d := pow(a.z - l.z, 2) + pow(a.f - l.f, 2), c := l.cluster)) AS goal FROM g a JOIN g l ON NOT l.small AND (a.small OR a.cluster = l.cluster) GROUP BY 1), m AS (SELECT key, goal FROM b JOIN t USING (cluster)), o AS (SELECT goal, row_number() OVER (ORDER BY count(*) DESC, goal) - 1 AS segment_id FROM m GROUP BY 1)"


def merged(spark, sf_dir):
    number = F.expr("CASE pattern WHEN 'lumpy' THEN 3 WHEN 'erratic' THEN 2 WHEN 'intermittent' THEN 1 ELSE 0 END * 3 + CASE tier WHEN 'high' THEN 2 WHEN 'medium' THEN 1 ELSE 0 END")
    return op.merge_small(keys(spark, sf_dir).withColumn("cluster", number), ["zero_fraction", "forecastability"])


@query(f"{MERGED} SELECT key, segment_id::INT AS segment_id FROM m JOIN o USING (goal)")
def merge_small_segments(spark, sf_dir):
    return merged(spark, sf_dir).select("key", "segment_id")


#: The clusters are the merged segments.
HYBRID = f"{MERGED}, hs AS (SELECT keys.*, segment_id || '|' || tier || '|' || pattern AS s, CASE WHEN pattern IN ('smooth', 'erratic') THEN 'regular' ELSE 'sparse' END AS f FROM keys JOIN m USING (key) JOIN o USING (goal)), hc AS (SELECT s, f, count(*) AS n FROM hs GROUP BY 1, 2), hb AS (SELECT f, s AS bs, n AS bn FROM hc QUALIFY row_number() OVER (PARTITION BY f ORDER BY n DESC, s DESC) = 1), ho AS (SELECT s AS os FROM hc ORDER BY n DESC, s DESC LIMIT 1), hybrid AS (SELECT keys.*, CASE WHEN hc.n >= 60 THEN hc.s WHEN bn >= 60 THEN bs ELSE os END AS segment FROM hs keys JOIN hc USING (s, f) JOIN hb USING (f), ho)"


def hybrid(spark, sf_dir):
    return op.hybrid_segments(merged(spark, sf_dir).drop("segment"), 60, "segment_id")


@query(f"{HYBRID} SELECT key, segment FROM hybrid")
def hybrid_segments(spark, sf_dir):
    return hybrid(spark, sf_dir).select("key", "segment")


@query(f"{HYBRID}, a AS (SELECT count(*) AS t, avg(total) AS mt, avg(adi) AS ma FROM keys) SELECT segment, count(*) AS n, round(count(*) / max(t), 6) AS share, round(greatest(-10, least(10, avg(total) / max(mt))), 6) AS index_total, round(greatest(-10, least(10, avg(adi) / max(ma))), 6) AS index_adi FROM hybrid, a GROUP BY 1")
def segment_profiles(spark, sf_dir):
    return rounded(op.profiles(hybrid(spark, sf_dir), ["total", "adi"]), "segment", "n", "share", "index_total", "index_adi")


@query()
def assign_new_keys(spark, sf_dir):
    rows = keys(spark, sf_dir)
    new = F.pmod(F.xxhash64("key"), F.lit(10)) == 0
    return op.assign_new(rows.where(~new), rows.where(new), MEASURES)


@query("SELECT DISTINCT l_partkey::VARCHAR AS key, CASE WHEN l_partkey % 3 = 0 THEN 'new' ELSE 'old' END AS segment FROM lineitem")
def update_manifest(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select("l_partkey").distinct()
    old = rows.where("l_partkey % 3 > 0").select(F.col("l_partkey").cast("string").alias("key"), F.lit("old").alias("segment"))
    return op.updated_manifest(old, rows.where("l_partkey % 2 = 0 or l_partkey % 3 = 0").select(F.col("l_partkey").cast("string").alias("key"), F.lit("new").alias("segment")))


#: Individual keys in one order: kept ones first, then the best scores, ties by the hash of the key.
LEVELS = f"{KEYS}, ns AS (SELECT key, count(*) FILTER (y > 0) AS n_sold FROM sparse GROUP BY 1), r AS (SELECT k.*, n_sold, tier || '|' || pattern AS segment, total >= (SELECT quantile_cont(total, 0.9) FROM keys) AS top, n >= 20 AND n_sold >= 5 AND zero_fraction <= 0.7 AS gates FROM keys k JOIN ns USING (key)), q AS (SELECT *, top AND n >= 20 OR {{over}} AS kept FROM r WHERE CASE WHEN top THEN n >= 20 ELSE false END OR (forecastability >= 0.6 OR {{over}}) AND gates), pl AS (SELECT *, row_number() OVER (ORDER BY CASE WHEN kept THEN 1e9 ELSE forecastability END DESC, ('0x' || substr(md5(key), 1, 13))::BIGINT) AS place FROM q), chosen AS (SELECT key, segment, kept FROM pl WHERE kept OR place <= floor({{share}} * (SELECT count(*) FROM keys)))"


@query(f"{LEVELS.format(over='false', share='0.3::DOUBLE')} SELECT r.key, CASE WHEN c.key IS NOT NULL THEN 'individual' ELSE 'segment' END AS level FROM r LEFT JOIN chosen c USING (key)")
def model_level_allocation(spark, sf_dir):
    return op.model_levels(keys(spark, sf_dir), least_obs=20, least_sold=5).select("key", "level")


@query(f"{LEVELS.format(over='forecastability >= 0.9 AND gates', share='0.25::DOUBLE')}, sl AS (SELECT r.segment, count(*) - count(c.key) AS rest FROM r LEFT JOIN chosen c USING (key) GROUP BY 1) SELECT r.key, CASE WHEN c.key IS NOT NULL AND (rest >= 10 OR c.kept) THEN 'individual' ELSE 'segment' END AS level FROM r LEFT JOIN chosen c USING (key) JOIN sl ON sl.segment = r.segment")
def model_level_allocation_overrides(spark, sf_dir):
    return op.model_levels(keys(spark, sf_dir), most_share=0.25, least_obs=20, least_sold=5, override=0.9, least_segment=10).select("key", "level")


@query(f"{KEYS} SELECT key, round((total - avg(total) OVER w) / nullif(stddev_samp(total) OVER w, 0), 6) AS z, round(total / nullif(avg(total) OVER w, 0), 6) AS ratio FROM keys WINDOW w AS (PARTITION BY tier, pattern)")
def segment_relative_metrics(spark, sf_dir):
    return rounded(op.relative_to_segment(keys(spark, sf_dir), "total"), "key", "z", "ratio")


@query(f"{KEYS} SELECT key, CASE WHEN pattern = 'smooth' AND tier = 'high' THEN 'gbt' WHEN pattern = 'smooth' THEN 'ets' WHEN pattern = 'erratic' THEN 'gbt' ELSE 'croston' END AS models, CASE WHEN pattern IN ('smooth', 'erratic') THEN 'squared' ELSE 'tweedie' END AS loss FROM keys")
def model_recommendation_lookup(spark, sf_dir):
    rules = [("smooth", "any", "ets", "squared"), ("smooth", "high", "gbt", "squared"), ("erratic", "any", "gbt", "squared"), ("intermittent", "any", "croston", "tweedie"), ("lumpy", "any", "croston", "tweedie")]
    return op.recommended(keys(spark, sf_dir), spark.createDataFrame(rules, "pattern string, tier string, models string, loss string")).select("key", "models", "loss")


@query("WITH p AS (SELECT p_brand, p_size, 'M' || substr(p_brand, 7, 1) AS maker, 'G' || (substr(p_brand, 7, 1)::INT // 3) AS grp FROM part) SELECT 'p_brand' AS child, 'maker' AS parent WHERE EXISTS (SELECT 1 FROM p) UNION ALL SELECT 'p_brand', 'grp' WHERE EXISTS (SELECT 1 FROM p) UNION ALL SELECT 'maker', 'grp' WHERE EXISTS (SELECT 1 FROM p)")
def hierarchy_detect(spark, sf_dir):
    rows = table(spark, sf_dir, "part").select("p_brand", "p_size", F.expr("concat('M', substring(p_brand, 7, 1))").alias("maker"), F.expr("concat('G', int(substring(p_brand, 7, 1)) div 3)").alias("grp"))
    return op.hierarchy_pairs(rows, ["p_brand", "p_size", "maker", "grp"])


CHAINED = "p AS (SELECT p_partkey AS key, p_brand AS brand, 'M' || substr(p_brand, 7, 1) AS market_segment, 'M' || substr(p_brand, 7, 1) AS form, 'G' || (substr(p_brand, 7, 1)::INT // 3) AS product_group, p_size AS store_size, CASE WHEN p_partkey % 3 > 0 THEN p_type END AS channel, p_partkey % 2 AS flag FROM part)"
EACH = " UNION ALL ".join(f"SELECT '{c}' AS c, {c}::VARCHAR AS v, key FROM p" for c in ("brand", "market_segment", "form", "product_group", "store_size", "channel", "flag"))


@query(
    f"WITH {CHAINED}, e AS ({EACH}), v AS (SELECT c, v, count(*) AS k FROM e WHERE v IS NOT NULL GROUP BY 1, 2), t AS (SELECT count(*) AS n FROM p), m AS (SELECT c, count(*) AS n_values, any_value(n) / count(*) AS keys_per_group, min(k)::BIGINT AS least_keys, round(sum(k) / any_value(n), 4) AS coverage FROM v, t GROUP BY 1), "
    "w AS (SELECT * FROM (VALUES ('brand', 'product', 'product', 3, 'market_segment', NULL, NULL), ('market_segment', 'product', 'product', 2, 'product_group', NULL, NULL), ('form', 'product', NULL, NULL, NULL, 'market_segment', NULL), "
    "('product_group', 'product', 'product', 1, NULL, NULL, NULL), ('store_size', 'customer', 'customer', 1, NULL, NULL, NULL), ('channel', 'customer', NULL, NULL, NULL, NULL, 'seldom filled'), ('flag', 'other', NULL, NULL, NULL, NULL, 'few values')) x(c, label, chain, level, parent, same_as, rejected)) "
    "SELECT w.c AS \"column\", label, chain, level, parent, n_values, round(keys_per_group, 6) AS keys_per_group, least_keys, coverage, "
    "CASE WHEN level IS NOT NULL THEN round(CASE label WHEN 'product' THEN 1 ELSE 0.9 END * (0.4 * greatest(0, 1 - abs(log10(n_values) - 1.5)) + 0.4 * greatest(0, 1 - abs(log10(keys_per_group) - 1.5)) + 0.2 * (1 - 0.2 * (level - 1))), 4) END AS score, same_as, rejected FROM w JOIN m ON m.c = w.c"
)
def hierarchy_chains(spark, sf_dir):
    maker = F.substring("p_brand", 7, 1)
    rows = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("key"), F.col("p_brand").alias("brand"), F.concat(F.lit("M"), maker).alias("market_segment"), F.concat(F.lit("M"), maker).alias("form"), F.concat(F.lit("G"), F.expr("int(substring(p_brand, 7, 1)) div 3")).alias("product_group"),
        F.col("p_size").alias("store_size"), F.expr("if(p_partkey % 3 > 0, p_type, null)").alias("channel"), (F.col("p_partkey") % 2).alias("flag"),
    )
    made = hierarchy.hierarchy_chains(rows, [c for c in rows.columns if c != "key"], least=2)
    return made.withColumn("keys_per_group", F.round("keys_per_group", 6))


@query(f"{BRAND}, a AS (SELECT *, CASE WHEN week_idx <= 1600 THEN price END AS past_price, CASE WHEN week_idx <= 1605 OR key < 'Brand#2' THEN price END AS part_price, 0 AS nothing FROM panel), f AS (SELECT * FROM a WHERE week_idx > 1600) SELECT 'price' AS \"column\", 'known' AS class, (SELECT max(week_idx) FROM f) AS known_until UNION ALL SELECT 'past_price', 'history_only', NULL UNION ALL SELECT 'nothing', 'excluded', NULL UNION ALL SELECT 'is_promo', 'known', (SELECT max(week_idx) FROM f WHERE promo = 1)")
def feature_availability(spark, sf_dir):
    rows = brand_week(spark, sf_dir).select("key", "week_idx", "price", F.expr("if(week_idx <= 1600, price, null)").alias("past_price"), F.lit(0).alias("nothing"), F.col("promo").alias("is_promo"))
    return impute.availability(rows, ["price", "past_price", "nothing", "is_promo"], 1600)


@query(f"{PART} SELECT week_idx, 'promo' AS \"column\", round(avg((promo = 0)::INT), 6) AS missing FROM panel GROUP BY 1 HAVING avg((promo = 0)::INT) >= 0.7")
def impute_flag_periods(spark, sf_dir):
    return rounded(impute.missing_periods(part_week(spark, sf_dir), ["promo", "price"], 0.7), "week_idx", "column", "missing")


@query(f"{PART}, g AS (SELECT *, CASE WHEN week_idx >= 1600 AND promo = 0 THEN 0 ELSE price END AS p FROM panel), m AS (SELECT category, week_idx + 52 AS week_idx, median(p) AS m FROM g WHERE p <> 0 GROUP BY 1, 2) SELECT g.key, g.week_idx, CASE WHEN g.week_idx >= 1600 AND g.p = 0 THEN coalesce(nullif(o.p, 0), m, g.p) ELSE g.p END AS imputed FROM g LEFT JOIN g o ON o.key = g.key AND o.week_idx = g.week_idx - 52 LEFT JOIN m ON m.category = g.category AND m.week_idx = g.week_idx")
def impute_numeric_tiers(spark, sf_dir):
    rows = part_week(spark, sf_dir).withColumn("p", F.expr("if(week_idx >= 1600 and promo = 0, 0D, price)"))
    return impute.impute_numeric(rows, "p", 1600, "category").select("key", "week_idx", "imputed")


@query(f"{BRAND}, g AS (SELECT *, substr(key, 7, 1) AS grp, CASE WHEN week_idx >= 1640 THEN NULL WHEN key < 'Brand#3' THEN 'x' ELSE 'w' || (week_idx % 3) END AS v FROM panel), o AS (SELECT key, CASE WHEN count(DISTINCT v) = 1 THEN min(v) END AS sole FROM g GROUP BY 1), c AS (SELECT grp, v FROM g WHERE v IS NOT NULL GROUP BY 1, 2 QUALIFY row_number() OVER (PARTITION BY grp ORDER BY count(*) DESC, v) = 1) SELECT g.key, g.week_idx, CASE WHEN g.week_idx >= 1640 AND g.v IS NULL THEN coalesce(sole, p.v, c.v) ELSE g.v END AS imputed FROM g JOIN o ON o.key = g.key LEFT JOIN g p ON p.key = g.key AND p.week_idx = g.week_idx - 52 LEFT JOIN c ON c.grp = g.grp")
def impute_categorical_tiers(spark, sf_dir):
    rows = brand_week(spark, sf_dir).withColumn("grp", F.substring("key", 7, 1)).withColumn("v", F.expr("CASE WHEN week_idx >= 1640 THEN NULL WHEN key < 'Brand#3' THEN 'x' ELSE concat('w', week_idx % 3) END"))
    return impute.impute_category(rows, "v", 1640, "grp").select("key", "week_idx", "imputed")


@query(f"{BRAND} SELECT key, week_idx, CASE WHEN week_idx > 1600 THEN week_idx % 4 ELSE promo END::INT AS promo, (week_idx % 7)::INT AS moon FROM panel")
def inject_calendar(spark, sf_dir):
    rows = brand_week(spark, sf_dir).select("key", "week_idx", "promo")
    calendar = rows.select("week_idx").distinct().withColumn("promo", F.col("week_idx") % 4).withColumn("moon", F.col("week_idx") % 7)
    return impute.inject_calendar(rows, calendar, ["promo", "moon"], "future_only", 1600)


@query()
def tree_importance(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").withColumn("revenue", F.expr("l_extendedprice * (1 - l_discount)"))
    return rounded(models.tree_importance(rows, ["l_quantity", "l_extendedprice", "l_discount", "l_tax"], "revenue"), "column", "importance")


@query()
def pooled_direct_forecast(spark, sf_dir):
    return rounded(models.pooled_forecast(brand_week(spark, sf_dir), 1608), "key", "h", "target_idx", "actual", "predicted")


@query()
def pooled_scoped_forecast(spark, sf_dir):
    rows = brand_week(spark, sf_dir).withColumn("category", F.expr("if(key < 'Brand#3', 'A', 'B')")).withColumn("segment", F.expr("if(key < 'Brand#13', 'few', 'many')"))
    return rounded(models.scoped_forecast(rows, 1608, [(["category"], 50), (["category", "segment"], 400)], horizons=1), "key", "h", "scope", "actual", "predicted")


@query()
def model_origin_backtest(spark, sf_dir):
    made = models.origin_forecasts(brand_week(spark, sf_dir), [1600, 1606])
    return made.groupBy("cutoff", "h").agg(F.count("*").alias("n"), F.round(F.sum(F.abs(F.col("predicted") - F.col("actual"))) / F.sum("actual"), 6).alias("wape"))


@query()
def stacked_origin_forecast(spark, sf_dir):
    return rounded(models.stacked(brand_week(spark, sf_dir).withColumn("category", F.substring("key", 7, 1)), 1608), "key", "h", "actual", "predicted")


@query()
def recursive_forecast(spark, sf_dir):
    return rounded(models.recursive_forecast(panel.dense_grid(brand_week(spark, sf_dir)), 1608, 13), "key", "week_idx", "predicted")


@query()
def two_stage_zero_model(spark, sf_dir):
    names = ["lag_1", "lag_2", "lag_4", "rmean_13", "zerofrac_26"]
    # No feature of these weeks looks back over more than 26 rows. Both tables are read from one written panel.
    dense = panel.dense_grid(sparse(spark, sf_dir), since=1556 - 26).where("week_idx <= 1612").withColumn("price", F.lit(0.0))
    rows = cut(windows.backward_panel(dense, [1, 2, 4], [], [13]).where("lag_4 is not null and week_idx >= 1556").select("key", "week_idx", "y", *names))
    return rounded(models.two_stage(rows.where("week_idx between 1556 and 1608"), rows.where("week_idx between 1609 and 1612"), names), "key", "week_idx", "p_sale", "predicted")


