"""Exact quantiles and ranks over any number of rows, without a task that holds or orders all of them."""

from __future__ import annotations

import math

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from demandloom.operators.tables import cut

#: Values that one task may hold and order.
FEW = 100_000
#: Ranks of a sketch are right to one part in so many. Brackets around a rank are four such parts wide each way.
ACCURACY = 20_000
#: Ranges that the values of a group are dealt into for ranks.
RANGES = 256


def kept(df: DataFrame, column: Column | str) -> DataFrame:
    """The column's values that aren't null as doubles, column _v, held for several passes until unpersist()."""
    value = (F.col(column) if isinstance(column, str) else column).cast("double")
    return df.select(value.alias("_v")).where("_v is not null").persist(StorageLevel.MEMORY_AND_DISK)


def at_ranks(rows: DataFrame, n: int, wanted: list[int]) -> list[float]:
    """The values of the wanted ranks (from 0) among the n values of kept(), exactly.

    Beyond FEW values a sketch, whose error is bounded, brackets each rank; what lies below the bracket is counted, and of the values within,
    a small share of all, the rank is taken. A rank outside its bracket would be an error, not a wrong result.
    """
    if n <= FEW:
        ordered = rows.agg(F.array_sort(F.collect_list("_v")).alias("a"))
        return list(ordered.select(*[F.get("a", F.lit(r)).alias(f"v{i}") for i, r in enumerate(wanted)]).first())
    shares = [x for r in wanted for x in (max(0.0, r / (n - 1) - 4 / ACCURACY), min(1.0, r / (n - 1) + 4 / ACCURACY))]
    ends = rows.agg(F.percentile_approx("_v", shares, ACCURACY)).first()[0]
    brackets = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(r).alias("r"), F.lit(ends[2 * i]).alias("lo"), F.lit(ends[2 * i + 1]).alias("hi")) for i, r in enumerate(wanted)])
    each = rows.select("_v", F.explode(F.filter(brackets, lambda b: F.col("_v") <= b["hi"])).alias("b"))
    # All values below a bracket count as one, null, which comes first.
    counted = each.groupBy("b.i", "b.r", F.when(F.col("_v") >= F.col("b.lo"), F.col("_v")).alias("v")).agg(F.count("*").alias("c"))
    ranked = counted.withColumn("up", F.sum("c").over(W.partitionBy("i").orderBy(F.asc_nulls_first("v"))))
    found = {x.i: x.v for x in ranked.where("v is not null and up - c <= r and r < up").select("i", "v").collect()}
    if len(found) < len(wanted):
        raise ArithmeticError("a rank lies outside its bracket")
    return [found[i] for i in range(len(wanted))]


def quantiles(df: DataFrame, column: str, at: list[float]) -> list[float | None]:
    """The exact interpolated quantiles of a column, a few numbers; None where it has no values."""
    rows = kept(df, column)
    try:
        n = rows.count()
        if not n:
            return [None] * len(at)
        places = [q * (n - 1) for q in at]
        ends = [x for p in places for x in (math.floor(p), math.ceil(p))]
        distinct = sorted(set(ends))
        value = dict(zip(distinct, at_ranks(rows, n, distinct), strict=True))
        return [a if a == b else (math.ceil(p) - p) * a + (p - math.floor(p)) * b for p in places for a, b in [(value[math.floor(p)], value[math.ceil(p)])]]
    finally:
        rows.unpersist()


def with_quantiles(df: DataFrame, column: str, at: list[float], names: list[str]) -> DataFrame:
    """df with the exact quantiles of a column, the same in each row."""
    return df.withColumns({n: F.lit(q).cast("double") for n, q in zip(names, quantiles(df, column, at), strict=True)})


def first_by_score(df: DataFrame, score: str, room: int, key: str = "key") -> DataFrame:
    """The `room` rows of the highest scores; of equal scores those of the least hash of the key."""
    rows = kept(df, score)
    try:
        n = rows.count()
        if n <= room or room <= 0:
            return df if room > 0 else df.limit(0)
        edge = at_ranks(rows, n, [n - room])[0]
        left = room - rows.where(F.col("_v") > edge).count()
    finally:
        rows.unpersist()
    tied = kept(df.where(F.col(score) == edge), key_hash(key))
    try:
        last = at_ranks(tied, tied.count(), [left - 1])[0]
    finally:
        tied.unpersist()
    return df.where((F.col(score) > edge) | ((F.col(score) == edge) & (key_hash(key) <= last)))


def ranks(df: DataFrame, group: str, value: str) -> DataFrame:
    """For each group and value: n rows that have it, below (rows of less), dense (its place among the values, from 1), total (rows), n_values.

    A group's values are dealt into ranges by a sketch and ordered range by range; null values have no rank.
    """
    values = cut(df.where(F.col(value).isNotNull()).groupBy(group, value).agg(F.count("*").alias("n")))  # read four times
    edges = values.groupBy(F.col(group).alias("_g")).agg(F.percentile_approx(value, [i / RANGES for i in range(1, RANGES)], 4 * RANGES).alias("_e"))
    # A range is a number of edges under the value: the edges' exactness matters to balance only.
    dealt = values.join(edges, F.col(group).eqNullSafe(F.col("_g"))).withColumn("_r", F.size(F.filter("_e", lambda e: e < F.col(value)))).drop("_e", "_g")
    sums = dealt.groupBy(F.col(group).alias("_g"), F.col("_r").alias("_s")).agg(F.sum("n").alias("_n"), F.count("*").alias("_d"))
    before, whole = W.partitionBy("_g").orderBy("_s").rowsBetween(W.unboundedPreceding, -1), W.partitionBy("_g")  # RANGES rows at most
    sums = sums.select("_g", "_s", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"_before{c}") for c in ("_n", "_d")], F.sum("_n").over(whole).alias("total"), F.sum("_d").over(whole).alias("n_values"))
    w = W.partitionBy(group, "_r").orderBy(value)
    own = dealt.withColumn("_up", F.sum("n").over(w)).withColumn("_k", F.row_number().over(w))
    both = own.join(sums, F.col(group).eqNullSafe(F.col("_g")) & (F.col("_r") == F.col("_s")))
    return both.select(group, value, "n", (F.col("_before_n") + F.col("_up") - F.col("n")).alias("below"), (F.col("_before_d") + F.col("_k")).alias("dense"), "total", "n_values")


def average_share(r: DataFrame) -> Column:
    """Share of the group's rows at or under a value, ties at their mean rank; from columns of ranks()."""
    return (r["below"] + 1 + (r["n"] - 1) / 2) / r["total"]


def group_medians(r: DataFrame, group: str, value: str) -> DataFrame:
    """group, median: out of ranks()."""
    at = lambda k: F.max(F.when((F.col("below") <= k) & (k < F.col("below") + F.col("n")), F.col(value)))
    return r.groupBy(group).agg(((at(F.expr("(total - 1) div 2")) + at(F.expr("total div 2"))) / 2).alias("median"))


def key_hash(key: str) -> Column:
    """A number of 52 bits out of a key's MD5, the same everywhere."""
    return F.conv(F.substring(F.md5(F.col(key).cast("string")), 1, 13), 16, 10).cast("long")
