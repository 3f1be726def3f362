"""Exact order statistics of many groups at once, some of which may hold most rows.

Where the largest group is small enough for a task, groups are sorted. Else the ranks asked for are bracketed: each round counts the values of all open brackets by BINS equal parts, in one
aggregation, and goes on with the part that holds the rank, narrowed to the least and largest value in it, until that is one value. No task holds a group.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from demandloom.operators import ranks
from demandloom.operators.boosting import held
from demandloom.operators.tables import cut

BINS = 256
#: Groups whose brackets may be held by the driver and broadcast; they are counted before.
GROUPS = 10_000


def at_group_ranks(df: DataFrame, by: Sequence[str], value: Column | str, wanted: Mapping[str, Column]) -> DataFrame:
    """by, n (finite values of the group), and for each name the value of that rank (from 0, a Column over n; kept within the group). Null, NaN and infinite values don't count; groups of only such are left out."""
    value = (F.col(value) if isinstance(value, str) else value).cast("double")
    rows = df.select(*by, value.alias("_v")).where("_v is not null and not isnan(_v) and abs(_v) < double('Infinity')")
    sizes = rows.groupBy(*by).agg(F.count("*").alias("n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    within = {name: F.greatest(F.lit(0), F.least(F.col("n") - 1, r)).cast("long") for name, r in wanted.items()}
    if (sizes.agg(F.max("n")).first()[0] or 0) <= ranks.FEW:
        ordered = rows.groupBy(*by).agg(F.count("*").alias("n"), F.array_sort(F.collect_list("_v")).alias("_a"))
        return ordered.select(*by, "n", *[F.get("_a", r.cast("int")).alias(name) for name, r in within.items()])
    rows = cut(rows)
    few = sizes.limit(GROUPS + 1).count() <= GROUPS
    names = [f"_g{i}" for i in range(len(by))]
    asked = F.explode(F.array(*[F.struct(F.lit(name).alias("name"), r.alias("rank")) for name, r in within.items()])).alias("_w")
    state = held(sizes.select(*[F.col(c).alias(g) for c, g in zip(by, names, strict=True)], "n", "_lo", "_hi", asked).select(*names, "n", "_w.name", "_w.rank", F.col("_lo").alias("lo"), F.col("_hi").alias("hi"), F.lit(0).cast("long").alias("below")), few)
    while not (now := state.where("lo < hi")).isEmpty():
        on = [F.col(c).eqNullSafe(F.col(g)) for c, g in zip(by, names, strict=True)]
        met = rows.join(F.broadcast(now) if few else now, [*on, F.col("_v").between(F.col("lo"), F.col("hi"))])
        # Halves keep the width from overflowing. The least value is in the first part, the largest in the last, so every round narrows a bracket.
        part = F.least(F.lit(BINS - 1), F.floor((F.col("_v") / 2 - F.col("lo") / 2) / (F.col("hi") / 2 - F.col("lo") / 2) * BINS))
        counted = met.groupBy(*names, "n", "name", "rank", "below", part.alias("part")).agg(F.count("*").alias("c"), F.min("_v").alias("lo"), F.max("_v").alias("hi"))
        up = F.sum("c").over(W.partitionBy(*names, "name").orderBy("part"))  # BINS rows at most
        inside = counted.withColumn("up", F.col("below") + up).where("up - c <= rank and rank < up").select(*names, "n", "name", "rank", "lo", "hi", (F.col("up") - F.col("c")).alias("below"))
        state = held(state.where("lo = hi").unionByName(inside), few)
    found = state.groupBy(*names, "n").agg(*[F.max(F.when(F.col("name") == name, F.col("lo"))).alias(name) for name in wanted])
    return found.select(*[F.col(g).alias(c) for c, g in zip(by, names, strict=True)], "n", *wanted)


def group_quantiles(df: DataFrame, by: Sequence[str], value: Column | str, at: Mapping[str, float]) -> DataFrame:
    """by, n, and the interpolated quantile of each name."""
    place = {name: q * (F.col("n") - 1) for name, q in at.items()}
    ends = {f"_{side}_{name}": f(p) for name, p in place.items() for side, f in (("a", F.floor), ("b", F.ceil))}
    found = at_group_ranks(df, by, value, ends)
    mixed = {name: F.when(F.col(f"_a_{name}") == F.col(f"_b_{name}"), F.col(f"_a_{name}")).otherwise((F.ceil(p) - p) * F.col(f"_a_{name}") + (p - F.floor(p)) * F.col(f"_b_{name}")) for name, p in place.items()}
    return found.select(*by, "n", *[c.alias(name) for name, c in mixed.items()])


def null_safe(left: DataFrame, right: DataFrame, by: Sequence[str]) -> DataFrame:
    """left with the columns of right, one row a group, null groups included; left's rows without a group in right stay."""
    own = right.select(*[F.col(c).alias(f"_by{i}") for i, c in enumerate(by)], *[c for c in right.columns if c not in by])
    return left.join(own, [F.col(c).eqNullSafe(F.col(f"_by{i}")) for i, c in enumerate(by)], "left").drop(*[f"_by{i}" for i in range(len(by))])
