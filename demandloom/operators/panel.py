"""Reading, cleaning and shaping demand panels: columns key, week_idx (or another time), y unless told otherwise."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandloom.functions import periods
from demandloom.operators import ranks
from demandloom.operators.windows import correlated


def cast_decimals(df: DataFrame) -> DataFrame:
    """Every decimal column as double."""
    return df.select(*[F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else F.col(f.name) for f in df.schema.fields])


def join_features(frame: DataFrame, features: DataFrame, keys: list[str], categories: list[str] | None = None, category: str = "category") -> DataFrame:
    """Inner join that takes from features only what frame hasn't and whose name doesn't end in `_dep`; decimals as double."""
    chosen = frame.where(F.col(category).isin(categories)) if categories else frame
    extra = [c for c in features.columns if c not in frame.columns and not c.endswith("_dep")]
    return cast_decimals(chosen.join(features.select(*keys, *extra), keys))


def benchmark_forecast(source: DataFrame, key: str, week: str, prediction: str, category: str) -> DataFrame:
    """key, year_week, prediction, category: dashes leave the week, predictions that are no number count 0, one row per key and week (the largest prediction)."""
    named = source.select(F.col(key).alias("key"), F.regexp_replace(F.col(week).cast("string"), "-", "").alias("year_week"), F.coalesce(F.expr(f"try_cast({prediction} AS double)"), F.lit(0.0)).alias("prediction"), F.col(category).alias("category"))
    return named.groupBy("key", "year_week").agg(F.max(F.struct("prediction", "category")).alias("m")).select("key", "year_week", "m.prediction", "m.category")


def hash_sample(df: DataFrame, fraction: float, account: str | None = None, key: str = "key") -> DataFrame:
    """Keys whose MD5 falls into the first thousandths; keys of the account always."""
    drawn = F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("long") % 1000 < fraction * 1000
    return df.where(drawn | F.col(key).endswith(f"_{account}") if account else drawn)


def convert_types(df: DataFrame, numeric: list[str]) -> tuple[DataFrame, DataFrame]:
    """Numeric columns as double, what isn't a number as null; and a report of column, n_rows, n_lost."""
    out = df.select(*[F.expr(f"try_cast({c} AS double)").alias(c) if c in numeric else F.col(c) for c in df.columns])
    lost = df.agg(F.count("*").alias("n"), *[F.count_if(F.col(c).isNotNull() & F.expr(f"try_cast({c} AS double)").isNull()).alias(c) for c in numeric])
    report = lost.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col("n").alias("n_rows"), F.col(c).alias("n_lost")) for c in numeric])).alias("r")).select("r.*")
    return out, report


def category_token(category: Column | str) -> Column:
    """Upper case, runs of other signs than letters and digits as one underscore, none at the ends."""
    c = F.col(category) if isinstance(category, str) else category
    return F.btrim(F.regexp_replace(F.replace(F.upper(c), F.lit("&"), F.lit(" ")), "[^A-Z0-9]+", "_"), F.lit("_"))


def filter_categories(df: DataFrame, wanted: list[str], category: str = "category") -> DataFrame:
    """Rows whose category, or its token, is listed."""
    return df.where(F.col(category).isin(wanted) | category_token(category).isin(wanted))


def split_key(df: DataFrame, key: str = "key") -> DataFrame:
    """Adds product and account: what lies before and after the last underscore."""
    return df.withColumn("product", F.regexp_replace(key, "_[^_]+$", "")).withColumn("account", F.substring_index(key, "_", -1))


def quality_gate(df: DataFrame, least_periods: int = 10, key: str = "key", time: str = "week_idx", target: str = "y") -> DataFrame:
    """One row: n_rows, n_keys, n_periods, n_negative, completeness, failed, incomplete, many_keys."""
    seen = df.agg(F.count("*").alias("n_rows"), F.count_distinct(key).alias("n_keys"), F.count_distinct(time).alias("n_periods"), F.count_if(F.col(target) < 0).alias("n_negative"), F.count(target).alias("given"))
    share = F.round(F.col("n_rows") / F.expr("nullif(n_keys * n_periods, 0)"), 6)
    failed = (F.col("given") == 0) | (F.col("n_periods") < least_periods)
    return seen.select("n_rows", "n_keys", "n_periods", "n_negative", share.alias("completeness"), failed.alias("failed"), (share < 0.5).alias("incomplete"), (F.col("n_keys") > 10_000).alias("many_keys"))


def clip_negative(df: DataFrame, target: str = "y") -> DataFrame:
    return df.withColumn(target, F.greatest(F.col(target), F.lit(0)))


def column_report(df: DataFrame, columns: list[str]) -> DataFrame:
    """column, n_null, n_distinct for each column."""
    seen = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"n_{c}") for c in columns], *[F.count_distinct(c).alias(f"d_{c}") for c in columns])
    return seen.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"n_{c}").alias("n_null"), F.col(f"d_{c}").alias("n_distinct")) for c in columns])).alias("r")).select("r.*")


def missing_correlations(df: DataFrame, columns: list[str], numeric: list[str]) -> DataFrame:
    """missing, other, corr: how a column's absence goes with each other numeric column."""
    pairs = [(a, b) for a in columns for b in numeric if a != b]
    seen = df.agg(*[correlated(F.col(a).isNull().cast("int"), F.col(b)).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    return seen.select(F.explode(F.array(*[F.struct(F.lit(a).alias("missing"), F.lit(b).alias("other"), F.round(f"c{i}", 6).alias("corr")) for i, (a, b) in enumerate(pairs)])).alias("r")).select("r.*")


def time_splits(df: DataFrame, horizon: int = 13, extra: int = 5, time: str = "week_idx", target: str = "y") -> DataFrame:
    """period, total, split: periods up to the last with demand; the last horizon + extra are test, the horizon before val, the rest train."""
    totals = df.groupBy(F.col(time).alias("period")).agg(F.sum(target).alias("total"))
    last = totals.where("total > 0").agg(F.max("period").alias("last"))
    # As many rows as there are periods.
    ranked = totals.join(F.broadcast(last), F.col("period") <= F.col("last")).withColumn("r", F.row_number().over(W.orderBy(F.desc("period"))))
    return ranked.select("period", "total", F.when(F.col("r") <= horizon + extra, "test").when(F.col("r") <= 2 * horizon + extra, "val").otherwise("train").alias("split"))


def onehot_argmax(df: DataFrame, columns: list[str], prefix: str, out: str) -> DataFrame:
    """Name (without prefix) of the first of the largest columns; NONE if none is over zero."""
    values = F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in columns])
    names = F.array(*[F.lit(c.removeprefix(prefix)) for c in columns])
    return df.withColumn(out, F.when(F.array_max(values) > 0, F.element_at(names, F.array_position(values, F.array_max(values)).cast("int"))).otherwise(F.lit("NONE")))


def indicators_concat(df: DataFrame, columns: list[str], out: str, prefix: str = "", sep: str = "|", none: str = "none") -> DataFrame:
    """Names of all columns that are 1."""
    named = F.concat_ws(sep, *[F.when(F.col(c) == 1, F.lit(c.removeprefix(prefix))) for c in columns])
    return df.withColumn(out, F.when(named == "", F.lit(none)).otherwise(named))


def dead_columns(train: DataFrame, columns: list[str], protected: tuple[str, ...] = ()) -> list[str]:
    """Columns that are all null, all zero or constant in train, but for protected ones."""
    seen = train.agg(*[F.count_distinct(c).alias(c) for c in columns]).first()
    return [c for c in columns if seen[c] <= 1 and c not in protected]


def fill_missing(df: DataFrame, columns: list[str], strategy: str, group: str = "key", order: str = "week_idx") -> DataFrame:
    """strategy: zero, mean, median, ffill (within group) or group_median (the overall one where a group has none)."""
    if strategy == "zero":
        return df.fillna(0, columns)
    if strategy == "ffill":
        w = W.partitionBy(group).orderBy(order)
        return df.withColumns({c: F.last(c, ignorenulls=True).over(w) for c in columns})
    if strategy == "mean":
        out = df.join(F.broadcast(df.agg(*[F.avg(c).alias(f"_all_{c}") for c in columns])), F.lit(True))  # one row
    else:
        out = df.withColumns({f"_all_{c}": F.lit(ranks.quantiles(df, c, [0.5])[0]).cast("double") for c in columns})
    if strategy == "group_median":
        out = out.join(df.groupBy(group).agg(*[F.median(c).alias(f"_own_{c}") for c in columns]), group, "left")
        return out.select(*[F.coalesce(c, f"_own_{c}", f"_all_{c}").alias(c) if c in columns else F.col(c) for c in df.columns])
    return out.select(*[F.coalesce(c, f"_all_{c}").alias(c) if c in columns else F.col(c) for c in df.columns])


def outlier_bounds(df: DataFrame, column: str, method: str = "iqr", factor: float = 1.5, by: list[str] | None = None) -> DataFrame:
    """lo, hi: quartiles less and plus factor ranges, mean and factor standard deviations, or the factor and 100 - factor percentiles."""
    if method != "std" and not by:
        at = [factor / 100, 1 - factor / 100] if method == "percentile" else [0.25, 0.75]
        a, b = (F.lit(q).cast("double") for q in ranks.quantiles(df, column, at))
        out = factor * (b - a) if method != "percentile" else F.lit(0.0)
        return df.sparkSession.range(1).select((a - out).alias("lo"), (b + out).alias("hi"))
    if method == "std":
        edges = [F.avg(column) - factor * F.stddev(column), F.avg(column) + factor * F.stddev(column)]
    elif method == "percentile":
        edges = [F.percentile(column, factor / 100), F.percentile(column, 1 - factor / 100)]
    else:
        q1, q3 = F.percentile(column, 0.25), F.percentile(column, 0.75)
        edges = [q1 - factor * (q3 - q1), q3 + factor * (q3 - q1)]
    return df.groupBy(*(by or [])).agg(edges[0].alias("lo"), edges[1].alias("hi"))


def clip_outliers(df: DataFrame, column: str, method: str = "iqr", factor: float = 1.5) -> DataFrame:
    bounds = outlier_bounds(df, column, method, factor)  # one row
    return df.join(F.broadcast(bounds), F.lit(True)).select(*[F.when(F.col(c).isNotNull(), F.least(F.greatest(c, "lo"), "hi")).alias(c) if c == column else F.col(c) for c in df.columns])


def dense_grid(df: DataFrame, horizon: int = 0, key: str = "key", time: str = "week_idx", target: str = "y", since: int | None = None) -> DataFrame:
    """key, time, target: every key at every period from the first to the last (plus horizon); missing demand is 0, in the horizon null. since: periods before are left out, keys are not.

    Only the panel's own rows are shuffled, one list a key; the missing periods are added to it.
    """
    span = df.agg(F.min(time).alias("a"), F.max(time).alias("b"))
    there = F.col(key).isNotNull() & F.col(time).isNotNull()
    there = there if since is None else there & (F.col(time) >= since)
    kinds = dict(df.dtypes)
    pair = F.struct(F.col(time).alias("t"), F.coalesce(target, F.lit(0.0)).alias("y"))
    lists = df.groupBy(key).agg(F.collect_list(F.when(there, pair)).alias("_own")).join(F.broadcast(span), F.lit(True))
    first = F.col("a") if since is None else F.greatest("a", F.lit(since))
    periods_ = F.when(first <= F.col("b") + horizon, F.sequence(first, F.col("b") + horizon)).otherwise(F.array().cast(f"array<{kinds[time]}>"))
    missing = F.transform(F.array_except(periods_, F.transform("_own", lambda p: p["t"])), lambda t: F.struct(t.alias("t"), F.when(t <= F.col("b"), F.lit(0.0)).alias("y")))
    rows = lists.select(key, F.explode(F.concat("_own", missing)).alias("p"))
    return rows.select(key, F.col("p.t").alias(time), F.col("p.y").alias(target))


def truncate_after_last_sale(df: DataFrame, periods_after: int, key: str = "key", time: str = "week_idx", target: str = "y") -> DataFrame:
    """Rows no more than so many periods after the key's last sale; keys without any keep nothing."""
    last = F.max(F.when(F.col(target) > 0, F.col(time))).over(W.partitionBy(key))
    return df.withColumn("_last", last).where(F.col(time) <= F.col("_last") + periods_after).drop("_last")


def zero_conflicts(df: DataFrame, keys: list[str], value: str = "predicted", tolerance: float = 1e-9) -> DataFrame:
    """Where keys have a row that forecasts zero, only such rows."""
    zero = F.abs(F.col(value)) <= tolerance
    return df.withColumn("_z", F.max(zero).over(W.partitionBy(*keys))).where(~F.col("_z") | zero).drop("_z")


def to_parent(df: DataFrame, parent: str, time: str, rules: dict[str, str]) -> DataFrame:
    """Rolls up by sum, mean, max or first (the least) column by column."""
    how = {"sum": F.sum, "mean": F.avg, "max": F.max, "first": F.min}
    return df.groupBy(parent, time).agg(*[how[r](c).alias(c) for c, r in rules.items()])


def add_period_columns(df: DataFrame, date: str) -> DataFrame:
    return df.withColumn("year_week", periods.year_week(date)).withColumn("week_idx", periods.week_index(date))


FORECAST_SCHEMA = T.StructType([
    T.StructField("key", T.StringType()), T.StructField("year_week", T.StringType()), T.StructField("predicted", T.DoubleType()), T.StructField("actual", T.DoubleType()),
    T.StructField("origin_period", T.StringType()), T.StructField("forecast_step", T.IntegerType()), T.StructField("lag", T.IntegerType()), T.StructField("model_level", T.StringType()),
    T.StructField("model_name", T.StringType()), T.StructField("model_params", T.StringType()), T.StructField("is_new_key", T.BooleanType()), T.StructField("is_dead_key", T.BooleanType()),
])


def forecast_table(df: DataFrame) -> DataFrame:
    """The twelve columns of a forecast, cast; those that df lacks are null."""
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in FORECAST_SCHEMA.fields])


def union_tagged(frames: dict[str, DataFrame], tag: str) -> DataFrame:
    """All frames, each row with its frame's name."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [f.withColumn(tag, F.lit(n)) for n, f in frames.items()])


def read_any(spark: SparkSession, path: str, delta: bool = False) -> DataFrame:
    """Parquet, or the named format `delta` where its reader is installed."""
    return spark.read.format("delta" if delta else "parquet").load(path)


def csv_to_category_parquet(spark: SparkSession, source: str, target: str, schema: str, rename: dict[str, str], period: str, last: int, numeric: list[str]) -> DataFrame:
    """CSV of texts to typed Parquet with one folder per category: columns renamed, periods without dashes up to the last, numbers coerced."""
    rows = spark.read.csv(source, schema=schema, header=True).withColumnsRenamed(rename)
    rows = rows.withColumn(period, F.expr(f"try_cast(replace({period}, '-', '') AS int)")).where(F.col(period) <= last)
    out, _ = convert_types(rows, numeric)
    out.write.mode("overwrite").partitionBy("category").parquet(target)
    return spark.read.parquet(target)


def columns_with_prefix(df: DataFrame, prefix: str) -> list[str]:
    return [c for c in df.columns if re.match(re.escape(prefix), c)]
