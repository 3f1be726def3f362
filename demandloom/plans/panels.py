"""Demand panels derived from the driver's tables, as DataFrames and as SQL for the oracles.

brand_week: smooth demand, one row per brand and week. part_week: sparse demand, per part and week. brand_region_week: brand
and region of the supplier, for keys of a product and an account.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandloom.functions import periods

#: Discounts from this on count as a promotion.
PROMOTION = 0.08
#: Lines that a task sums where nearly every line has a part and week of its own.
PER_TASK = 500_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _weekly(rows: DataFrame, *keys: str, parts: int = 0) -> DataFrame:
    # Whole cents add up to the same sum in any order, and whole ten-thousandths are rounded alike everywhere.
    cents, pieces = F.rint(F.col("l_extendedprice") * 100).cast("long"), F.sum(F.col("l_quantity").cast("long"))
    scaled = 200 * F.sum(cents) + pieces
    price = (scaled - F.pmod(scaled, 2 * pieces)) / (2 * pieces) / 10000
    rows = rows.withColumn("week_start", F.trunc(F.col("l_shipdate").cast("date"), "week"))
    if parts:
        rows = rows.repartition(parts, *keys, "week_start")
    sums = rows.groupBy(*keys, "week_start").agg(
        F.sum("l_quantity").alias("y"), price.alias("price"), F.max((F.col("l_discount") >= PROMOTION).cast("int")).alias("promo")
    )
    return sums.withColumn("year_week", periods.year_week("week_start")).withColumn("week_idx", periods.week_index("week_start"))


def brand_week(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "part"), F.expr("l_partkey = p_partkey"))
    return _weekly(lines.withColumn("key", F.col("p_brand")), "key")


def part_week(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem")
    lines = items.join(table(spark, sf_dir, "part"), F.expr("l_partkey = p_partkey"))
    lines = lines.withColumn("key", F.col("l_partkey").cast("string")).withColumn("category", F.col("p_type"))
    # Sums before the shuffle would hold a split's lines and save none; after it a task's share would grow with the table.
    parts = max(spark.sparkContext.defaultParallelism, -(-items.count() // PER_TASK))
    return _weekly(lines, "key", "category", parts=parts)


def brand_region_week(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "part"), F.expr("l_partkey = p_partkey"))
    lines = lines.join(table(spark, sf_dir, "supplier"), F.expr("l_suppkey = s_suppkey")).join(table(spark, sf_dir, "nation"), F.expr("s_nationkey = n_nationkey"))
    return _weekly(lines.withColumn("key", F.concat_ws("_", "p_brand", "n_regionkey")), "key")


_WEEKLY = """SELECT {keys}, CAST(date_trunc('week', l_shipdate) AS DATE) AS week_start, sum(l_quantity) AS y,
    ((200 * sum(round(l_extendedprice * 100)::BIGINT) + sum(l_quantity::BIGINT)) // (2 * sum(l_quantity::BIGINT)))::DOUBLE / 10000 AS price, max(CASE WHEN l_discount >= 0.08 THEN 1 ELSE 0 END) AS promo,
    CAST(isoyear(date_trunc('week', l_shipdate)) * 100 + week(date_trunc('week', l_shipdate)) AS INT) AS year_week,
    CAST(date_diff('day', DATE '1970-01-05', CAST(date_trunc('week', l_shipdate) AS DATE)) // 7 AS INT) AS week_idx
    FROM lineitem JOIN part ON l_partkey = p_partkey {more} GROUP BY ALL"""
#: `panel` as a common table expression.
BRAND = f"WITH panel AS ({_WEEKLY.format(keys='p_brand AS key', more='')})"
PART = f"WITH panel AS ({_WEEKLY.format(keys='l_partkey::VARCHAR AS key, p_type AS category', more='')})"
REGION = f"WITH panel AS ({_WEEKLY.format(keys="p_brand || '_' || n_regionkey AS key", more='JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey')})"
#: All weeks of the data.
ORIGIN = 200052
