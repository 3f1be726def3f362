"""Which features are known ahead, and filling those that aren't."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandloom.operators.selection import group_quantiles


def availability(df: DataFrame, columns: list[str], cutoff: int, known: float = 0.5, partial: float = 0.1, useful: float = 0.01, key: str = "key", time: str = "week_idx") -> DataFrame:
    """column, class by what share of the keys of the future has a value there: known, partial, history_only, or excluded without signal in history."""
    past, future = F.col(time) <= cutoff, F.col(time) > cutoff
    on = lambda c: F.col(c).isNotNull() & (F.col(c) != 0)
    seen = df.agg(F.count_distinct(F.when(future, F.col(key))).alias("_k"), F.count_if(past).alias("_p"), *[f for i, c in enumerate(columns) for f in (F.count_distinct(F.when(future & on(c), F.col(key))).alias(f"f{i}"), F.count_if(past & on(c)).alias(f"p{i}"), F.max(F.when(future & on(c), F.col(time))).alias(f"u{i}"))])

    def kind(c: str, i: int) -> Column:
        ahead, before = F.try_divide(F.col(f"f{i}"), F.col("_k")), F.try_divide(F.col(f"p{i}"), F.col("_p"))
        named = F.lit(c).rlike("^(holiday|event|week|month|year|is_)")
        return F.when(named, "known").when((F.coalesce(before, F.lit(0.0)) == 0) & (F.coalesce(ahead, F.lit(0.0)) == 0), "excluded").when(ahead >= known, "known").when(ahead >= partial, "partial").when(before >= useful, "history_only").otherwise("excluded")

    return seen.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), kind(c, i).alias("class"), F.col(f"u{i}").alias("known_until")) for i, c in enumerate(columns)])).alias("r")).select("r.*")


def missing_periods(df: DataFrame, columns: list[str], threshold: float = 0.9, time: str = "week_idx") -> DataFrame:
    """time, column, missing: periods in which so large a share of the keys has zero or null."""
    seen = df.groupBy(time).agg(*[F.avg((F.coalesce(F.col(c), F.lit(0)) == 0).cast("int")).alias(c) for c in columns])
    return seen.select(time, F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("missing")) for c in columns])).alias("r")).select(time, "r.*").where(F.col("missing") >= threshold)


def impute_numeric(df: DataFrame, column: str, start: int, group: str, season: int = 52, key: str = "key", time: str = "week_idx") -> DataFrame:
    """imputed: from `start` on, where the value is zero or null, the key's value a season ago, else its group's median of non-zero values then."""
    own = df.select(key, (F.col(time) + season).alias(time), F.when(F.col(column) != 0, F.col(column)).alias("_own"))
    near = group_quantiles(df.where(F.col(column) != 0).withColumn(time, F.col(time) + season), [group, time], column, {"_group": 0.5}).drop("n")
    lacks = (F.col(time) >= start) & (F.coalesce(F.col(column), F.lit(0.0)) == 0)
    return df.join(own, [key, time], "left").join(near, [group, time], "left").withColumn("imputed", F.when(lacks, F.coalesce("_own", "_group", column)).otherwise(F.col(column))).drop("_own", "_group")


def impute_category(df: DataFrame, column: str, start: int, group: str, season: int = 52, key: str = "key", time: str = "week_idx") -> DataFrame:
    """imputed: from `start` on, where null, the key's only value, else its value a season ago, else its group's most frequent one (the least of ties)."""
    only = df.groupBy(key).agg(F.when(F.count_distinct(column) == 1, F.min(column)).alias("_only"))
    own = df.select(key, (F.col(time) + season).alias(time), F.col(column).alias("_own"))
    mode = df.groupBy(group).agg(F.mode(column, deterministic=True).alias("_mode"))
    out = df.join(only, key, "left").join(own, [key, time], "left").join(mode, group, "left")
    return out.withColumn("imputed", F.when((F.col(time) >= start) & F.col(column).isNull(), F.coalesce("_only", "_own", "_mode")).otherwise(F.col(column))).drop("_only", "_own", "_mode")


def inject_calendar(df: DataFrame, calendar: DataFrame, columns: list[str], mode: str = "never", cutoff: int = 0, time: str = "week_idx") -> DataFrame:
    """Joins a calendar's columns; where df has them already they are kept (never), replaced after the cutoff (future_only) or replaced (always)."""
    named = calendar.select(time, *[F.col(c).alias(f"_{c}") for c in columns])
    out = df.join(F.broadcast(named), time, "left")  # one row per period

    def merged(c: str) -> Column:
        if c not in df.columns:
            return F.col(f"_{c}")
        rule = {"never": F.coalesce(c, f"_{c}"), "always": F.coalesce(f"_{c}", c)}
        return rule[mode] if mode in rule else F.when(F.col(time) > cutoff, F.coalesce(f"_{c}", c)).otherwise(F.col(c))

    return out.withColumns({c: merged(c) for c in columns}).drop(*[f"_{c}" for c in columns])
