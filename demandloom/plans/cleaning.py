"""Queries: sources, cleaning and periods."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandloom.functions import periods
from demandloom.operators import panel as op
from demandloom.plans.panels import BRAND, PART, REGION, brand_region_week, brand_week, part_week, table
from demandloom.plans.registry import query


def scratch(spark: SparkSession) -> str:
    """A new folder below the one that driver and executors share, spark.checkpoint.dir; only a local session, which has no other machine, may go without."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="demandloom-")
    return f"{base.rstrip('/')}/query-{uuid.uuid4().hex}"


def weeks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return brand_week(spark, sf_dir).select("week_start", "year_week", "week_idx").distinct()


WEEKS = f"{BRAND}, weeks AS (SELECT DISTINCT week_start, year_week, week_idx FROM panel)"


@query("SELECT p_partkey, p_brand, p_size FROM part WHERE p_size > 25")
def read_any_format(spark, sf_dir):
    return op.read_any(spark, f"{sf_dir}/part.parquet").where("p_size > 25").select("p_partkey", "p_brand", "p_size")


@query(f"{PART} SELECT key, year_week, y, p_size::DOUBLE AS p_size, p_brand FROM panel JOIN part ON key = p_partkey::VARCHAR WHERE category IN ('ECONOMY', 'PROMO')")
def load_and_join_inputs(spark, sf_dir):
    features = table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("key"), F.col("p_size").cast("decimal(10,2)").alias("p_size"), "p_brand", F.lit(1).alias("old_dep"), F.lit("x").alias("category"))
    return op.join_features(part_week(spark, sf_dir), features, ["key"], ["ECONOMY", "PROMO"]).select("key", "year_week", "y", "p_size", "p_brand")


@query(f"{BRAND} SELECT key, year_week::VARCHAR AS year_week, y FROM panel WHERE year_week // 100 = 1999")
def read_snapshot_partition(spark, sf_dir):
    folder = scratch(spark)
    brand_week(spark, sf_dir).withColumn("snapshot", F.expr("year_week div 100")).write.partitionBy("snapshot").parquet(folder)
    return spark.read.parquet(folder).where("snapshot = 1999").select("key", F.col("year_week").cast("string").alias("year_week"), "y")


@query(f"{REGION}, raw AS (SELECT split_part(key, '_', 1) AS key, replace(substr(year_week::VARCHAR, 1, 4) || '-' || substr(year_week::VARCHAR, 5), '-', '') AS year_week, CASE WHEN promo = 1 THEN 0.0 ELSE y END AS prediction, 'A' AS category FROM panel) SELECT key, year_week, max(prediction) AS prediction, category FROM raw GROUP BY ALL")
def read_benchmark_forecast(spark, sf_dir):
    raw = brand_region_week(spark, sf_dir).select(F.split_part("key", F.lit("_"), F.lit(1)).alias("k"), F.expr("concat(year_week div 100, '-', lpad(year_week % 100, 2, '0'))").alias("w"), F.expr("if(promo = 1, 'n/a', cast(y AS string))").alias("p"), F.lit("A").alias("cat"))
    return op.benchmark_forecast(raw, "k", "w", "p", "cat")


@query(f"{BRAND}, p AS (SELECT key, year_week, y FROM panel WHERE year_week <= 199952) SELECT key, year_week, y AS sales, 'C' || substr(key, 7, 1) AS category FROM p")
def csv_to_typed_category_parquet(spark, sf_dir):
    folder = scratch(spark)
    rows = brand_week(spark, sf_dir).select("key", F.expr("concat(year_week div 100, '-', lpad(year_week % 100, 2, '0'))").alias("wk"), F.col("y").cast("string").alias("qty"), F.expr("concat('C', substring(key, 7, 1))").alias("category"))
    rows.write.csv(f"{folder}/csv", header=True)
    out = op.csv_to_category_parquet(spark, f"{folder}/csv", f"{folder}/out", "key string, wk string, qty string, category string", {"wk": "year_week", "qty": "sales"}, "year_week", 199952, ["sales"])
    return out.select("key", "year_week", "sales", "category")


@query("SELECT p_partkey::VARCHAR || '_' || p_size AS key FROM part WHERE ('0x' || substr(md5(p_partkey::VARCHAR || '_' || p_size), 1, 8))::BIGINT % 1000 < 250 OR p_size = 7")
def hash_sample_keys(spark, sf_dir):
    return op.hash_sample(table(spark, sf_dir, "part").select(F.concat_ws("_", "p_partkey", "p_size").alias("key")), 0.25, "7")


@query(f"{PART} SELECT key, category, sum(y) AS predicted FROM panel WHERE year_week >= 200000 GROUP BY ALL")
def write_forecast_by_category(spark, sf_dir):
    folder = scratch(spark)
    part_week(spark, sf_dir).where("year_week >= 200000").groupBy("key", "category").agg(F.sum("y").alias("predicted")).write.partitionBy("category").parquet(folder)
    return spark.read.parquet(folder).select("key", "category", "predicted")


@query(f"{BRAND} SELECT key, year_week::VARCHAR AS year_week, y AS predicted, NULL::DOUBLE AS actual, '199952' AS origin_period, (week_idx - 1564)::INT AS forecast_step, 1::INT AS lag, 'key' AS model_level, 'naive' AS model_name, NULL::VARCHAR AS model_params, false AS is_new_key, false AS is_dead_key FROM panel")
def forecast_output_schema(spark, sf_dir):
    rows = brand_week(spark, sf_dir).select("key", "year_week", F.col("y").alias("predicted"), F.lit(199952).alias("origin_period"), (F.col("week_idx") - 1564).alias("forecast_step"), F.lit(1).alias("lag"), F.lit("key").alias("model_level"), F.lit("naive").alias("model_name"), F.lit(False).alias("is_new_key"), F.lit(False).alias("is_dead_key"))
    return op.forecast_table(rows)


@query("SELECT p_partkey, TRY_CAST(p_name AS DOUBLE) AS p_name, p_size::DOUBLE AS p_size FROM part")
def convert_column_types(spark, sf_dir):
    return op.convert_types(table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size"), ["p_name", "p_size"])[0]


@query("SELECT o_orderkey, o_totalprice::DECIMAL(14,2)::DOUBLE AS price FROM orders")
def cast_decimals(spark, sf_dir):
    return op.cast_decimals(table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_totalprice").cast("decimal(14,2)").alias("price")))


@query("SELECT p_partkey, trim(regexp_replace(replace(upper(p_name || ' & co-' || p_brand), '&', ' '), '[^A-Z0-9]+', '_', 'g'), '_') AS token FROM part WHERE trim(regexp_replace(replace(upper(p_brand), '&', ' '), '[^A-Z0-9]+', '_', 'g'), '_') IN ('BRAND_11', 'BRAND_23') OR p_brand = 'Brand#34'")
def normalise_category_filter(spark, sf_dir):
    rows = op.filter_categories(table(spark, sf_dir, "part"), ["BRAND_11", "BRAND_23", "Brand#34"], "p_brand")
    return rows.select("p_partkey", op.category_token(F.concat("p_name", F.lit(" & co-"), "p_brand")).alias("token"))


@query(f"{WEEKS} SELECT year_week, substr(year_week::VARCHAR, 1, 4) || '-' || lpad((year_week % 100)::VARCHAR, 2, '0') AS dashed, year_week::VARCHAR AS plain FROM weeks")
def period_normalise(spark, sf_dir):
    short = F.expr("concat(year_week div 100, '-', year_week % 100)")
    return weeks(spark, sf_dir).select("year_week", periods.normalise(short).alias("dashed"), periods.normalise(F.col("year_week")).alias("plain"))


@query(f"{WEEKS}, s AS (SELECT year_week, week_start + INTERVAL 35 DAY AS a, week_start - INTERVAL 364 DAY AS b FROM weeks) SELECT year_week, (isoyear(a) * 100 + week(a))::INT AS plus5, (isoyear(b) * 100 + week(b))::INT AS minus52 FROM s")
def period_add_iso(spark, sf_dir):
    return weeks(spark, sf_dir).select("year_week", periods.add_weeks("year_week", 5).alias("plus5"), periods.add_weeks("year_week", -52).alias("minus52"))


@query(f"{WEEKS}, s AS (SELECT year_week, year_week // 100 * 52 + year_week % 100 - 1 + 5 AS a, year_week // 100 * 52 + year_week % 100 - 1 - 60 AS b FROM weeks) SELECT year_week, (a // 52 * 100 + a % 52 + 1)::INT AS plus5, (b // 52 * 100 + b % 52 + 1)::INT AS minus60 FROM s")
def period_add_52(spark, sf_dir):
    return weeks(spark, sf_dir).select("year_week", periods.add_periods("year_week", 5).alias("plus5"), periods.add_periods("year_week", -60).alias("minus60"))


@query(f"{WEEKS} SELECT year_week, week_idx, dense_rank() OVER (ORDER BY year_week)::INT AS ordinal FROM weeks")
def period_index(spark, sf_dir):
    ordinal = weeks(spark, sf_dir).select("year_week", "week_start", F.expr("cast(dense_rank() over (order by year_week) AS int)").alias("ordinal"))
    return ordinal.select("year_week", periods.week_index("week_start").alias("week_idx"), "ordinal")


@query(f"{WEEKS}, b AS (SELECT min(week_idx) AS a, max(week_idx) AS b FROM weeks), s AS (SELECT unnest(range(a, b + 1)) AS i FROM b) SELECT i::INT AS week_idx, (isoyear(DATE '1970-01-05' + (7 * i)::INT) * 100 + week(DATE '1970-01-05' + (7 * i)::INT))::INT AS year_week FROM s")
def period_range(spark, sf_dir):
    ends = weeks(spark, sf_dir).agg(F.min("week_idx").alias("a"), F.max("week_idx").alias("b"))
    return ends.select(F.explode(F.sequence("a", "b")).alias("week_idx")).select("week_idx", periods.from_index("week_idx").alias("year_week"))


@query(f"{WEEKS} SELECT year_week, (year_week - 100)::INT AS kept, (CASE WHEN year_week % 100 = 53 THEN year_week - 101 ELSE year_week - 100 END)::INT AS clamped FROM weeks")
def sply_period(spark, sf_dir):
    return weeks(spark, sf_dir).select("year_week", periods.last_year("year_week").alias("kept"), periods.last_year("year_week", clamp=True).alias("clamped"))


@query(f"{WEEKS} SELECT year_week, (date_diff('day', DATE '1998-12-28', week_start) // 7 + 1)::INT AS step FROM weeks WHERE week_start >= DATE '1998-12-28'")
def forecast_lag_from_snapshot(spark, sf_dir):
    return weeks(spark, sf_dir).where("year_week >= 199853").select("year_week", periods.forecast_step("year_week", F.lit(199853)).alias("step"))


@query(f"{REGION} SELECT DISTINCT key, split_part(key, '_', 1) AS product, split_part(key, '_', 2) AS account FROM panel")
def split_key(spark, sf_dir):
    return op.split_key(brand_region_week(spark, sf_dir).select("key").distinct())


@query(f"{PART} SELECT count(*) AS n_rows, count(DISTINCT key) AS n_keys, count(DISTINCT week_idx) AS n_periods, count(*) FILTER (y < 0) AS n_negative, round(count(*) / (count(DISTINCT key) * count(DISTINCT week_idx)), 6) AS completeness, false AS failed, count(*) / (count(DISTINCT key) * count(DISTINCT week_idx)) < 0.5 AS incomplete, count(DISTINCT key) > 10000 AS many_keys FROM panel")
def data_quality_gate(spark, sf_dir):
    return op.quality_gate(part_week(spark, sf_dir))


@query(f"{BRAND} SELECT 'key' AS \"column\", count(*) FILTER (key IS NULL) AS n_null, count(DISTINCT key) AS n_distinct FROM panel UNION ALL SELECT 'y', count(*) FILTER (y IS NULL), count(DISTINCT y) FROM panel UNION ALL SELECT 'promo', count(*) FILTER (promo IS NULL), count(DISTINCT promo) FROM panel")
def data_quality_report(spark, sf_dir):
    return op.column_report(brand_week(spark, sf_dir), ["key", "y", "promo"])


@query(f"{BRAND}, g AS (SELECT CASE WHEN y > 150 THEN NULL ELSE price END AS price, y, promo FROM panel) SELECT 'price' AS missing, 'y' AS other, round(corr((price IS NULL)::INT, y), 6) AS corr FROM g UNION ALL SELECT 'price', 'promo', round(corr((price IS NULL)::INT, promo), 6) FROM g")
def missing_pattern_report(spark, sf_dir):
    return op.missing_correlations(brand_week(spark, sf_dir).withColumn("price", F.expr("if(y > 150, null, price)")), ["price"], ["y", "promo"])


@query(f"{BRAND}, t AS (SELECT week_idx AS period, sum(y) AS total FROM panel GROUP BY 1), r AS (SELECT *, row_number() OVER (ORDER BY period DESC) AS r FROM t) SELECT period, total, CASE WHEN r <= 18 THEN 'test' WHEN r <= 31 THEN 'val' ELSE 'train' END AS split FROM r")
def auto_time_splits(spark, sf_dir):
    return op.time_splits(brand_week(spark, sf_dir))


@query("SELECT o_orderkey, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM') THEN substr(o_orderpriority, 3) ELSE 'NONE' END AS priority FROM orders")
def collapse_onehot_argmax(spark, sf_dir):
    names = {"is_URGENT": "1-URGENT", "is_HIGH": "2-HIGH", "is_MEDIUM": "3-MEDIUM"}
    rows = table(spark, sf_dir, "orders").select("o_orderkey", *[(F.col("o_orderpriority") == v).cast("int").alias(c) for c, v in names.items()])
    return op.onehot_argmax(rows, list(names), "is_", "priority").select("o_orderkey", "priority")


@query("SELECT l_orderkey, l_linenumber, coalesce(nullif(concat_ws('|', CASE WHEN l_discount >= 0.05 THEN 'discount' END, CASE WHEN l_tax >= 0.05 THEN 'tax' END, CASE WHEN l_returnflag = 'R' THEN 'returned' END), ''), 'none') AS flags FROM lineitem")
def collapse_indicators_concat(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").selectExpr("l_orderkey", "l_linenumber", "int(l_discount >= 0.05) is_discount", "int(l_tax >= 0.05) is_tax", "int(l_returnflag = 'R') is_returned")
    return op.indicators_concat(rows, ["is_discount", "is_tax", "is_returned"], "flags", "is_").select("l_orderkey", "l_linenumber", "flags")


@query(f"{BRAND} SELECT key, week_idx, y FROM panel")
def drop_dead_columns(spark, sf_dir):
    rows = brand_week(spark, sf_dir).select("key", "week_idx", "y", F.lit(0).alias("zero"), F.lit(None).cast("int").alias("void"), F.lit(3).alias("same"))
    return rows.drop(*op.dead_columns(rows.where("week_idx < 1500"), rows.columns))


@query(f"{BRAND}, g AS (SELECT key, week_idx, CASE WHEN week_idx % 5 = 0 THEN NULL ELSE y END AS y FROM panel), m AS (SELECT key, median(y) AS m FROM g GROUP BY 1) SELECT g.key, week_idx, last_value(y IGNORE NULLS) OVER (PARTITION BY g.key ORDER BY week_idx) AS carried, coalesce(y, m, (SELECT median(y) FROM g)) AS middle, coalesce(y, 0) AS zeroed FROM g JOIN m USING (key)")
def fill_missing(spark, sf_dir):
    rows = brand_week(spark, sf_dir).select("key", "week_idx", F.expr("if(week_idx % 5 = 0, null, y)").alias("y"))
    rows = rows.select("key", "week_idx", F.col("y").alias("carried"), F.col("y").alias("middle"), F.col("y").alias("zeroed"))
    return op.fill_missing(op.fill_missing(op.fill_missing(rows, ["carried"], "ffill"), ["middle"], "group_median"), ["zeroed"], "zero")


@query(f"{BRAND}, b AS (SELECT quantile_cont(y, 0.25) AS q1, quantile_cont(y, 0.75) AS q3 FROM panel) SELECT key, week_idx, least(greatest(y, q1 - 1.5 * (q3 - q1)), q3 + 1.5 * (q3 - q1)) AS y FROM panel, b")
def clip_outliers(spark, sf_dir):
    return op.clip_outliers(brand_week(spark, sf_dir).select("key", "week_idx", "y"), "y")


@query(f"{BRAND}, s AS (SELECT min(week_idx) AS a, max(week_idx) AS b FROM panel), g AS (SELECT key, unnest(range(a, b + 5))::INT AS week_idx, b FROM (SELECT DISTINCT key FROM panel), s) SELECT g.key, g.week_idx, CASE WHEN g.week_idx <= b THEN coalesce(y, 0) END AS y FROM g LEFT JOIN panel p ON p.key = g.key AND p.week_idx = g.week_idx")
def dense_period_grid(spark, sf_dir):
    return op.dense_grid(brand_week(spark, sf_dir), 4)


@query(f"{PART}, z AS (SELECT key, week_idx, CASE WHEN y < 40 THEN 0 ELSE y END AS y FROM panel), l AS (SELECT key, max(week_idx) AS l FROM z WHERE y > 0 GROUP BY 1) SELECT key, week_idx, y FROM z JOIN l USING (key) WHERE week_idx <= l + 13")
def truncate_after_last_sale(spark, sf_dir):
    return op.truncate_after_last_sale(part_week(spark, sf_dir).select("key", "week_idx", F.expr("if(y < 40, 0, y)").alias("y")), 13)


@query("WITH f AS (SELECT l_partkey AS key, l_linenumber AS period, CASE WHEN l_quantity < 5 THEN 0 ELSE l_quantity END AS predicted FROM lineitem) SELECT * FROM f QUALIFY NOT bool_or(predicted = 0) OVER (PARTITION BY key, period) OR predicted = 0")
def conflict_zero_dedupe(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("key"), F.col("l_linenumber").alias("period"), F.expr("if(l_quantity < 5, 0, l_quantity)").alias("predicted"))
    return op.zero_conflicts(rows, ["key", "period"])


@query(f"{REGION} SELECT split_part(key, '_', 1) AS product, week_idx, sum(y) AS y, round(avg(price), 6) AS price, max(promo) AS promo, min(key) AS key FROM panel GROUP BY 1, 2")
def aggregate_to_parent_grain(spark, sf_dir):
    rows = op.split_key(brand_region_week(spark, sf_dir))
    return op.to_parent(rows, "product", "week_idx", {"y": "sum", "price": "mean", "promo": "max", "key": "first"}).withColumn("price", F.round("price", 6))
