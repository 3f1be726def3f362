"""Chains of transforms of a target and their way back, on the history and on forecasts beyond it.

Each step leaves a table of one row a key (nothing, an exponent, mean and deviation, a line, or the values that differences start from) out of which its inverse is made. Differences of n rows
are undone by running sums within each of the n phases: from the first values on the history, from the last values on a horizon.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from demandloom.operators.tables import cut

KEY, TIME = "key", "week_idx"
#: A step: kind (log, power, standard, line, difference) and, of a difference, its rows.
Step = tuple[str, int] | tuple[str]
#: Exponents that are tried.
EXPONENTS = [i / 10 for i in range(-20, 21)]


def power(x: Column, e: Column | float) -> Column:
    return F.when(F.lit(e) == 0, F.log1p(x)).otherwise((F.pow(x + 1, e) - 1) / F.when(F.lit(e) != 0, F.lit(e)))


def state_of(rows: DataFrame, kind: str, n: int = 1) -> DataFrame | None:
    """One row a key: what a step's inverse needs. rows: key, week_idx, x without nulls."""
    if kind == "log":
        return None
    if kind == "power":  # of the greatest likelihood
        tried = [(F.lit(e), power(F.col("x"), e)) for e in EXPONENTS]
        scores = rows.groupBy(KEY).agg(*[((e - 1) * F.sum(F.log1p("x")) - F.count("x") / 2 * F.log(F.when(F.var_pop(p) > 0, F.var_pop(p)))).alias(f"s{i}") for i, (e, p) in enumerate(tried)])
        best = F.array_max(F.array(*[F.struct(F.coalesce(f"s{i}", F.lit(float("-inf"))).alias("s"), F.lit(-abs(e - 1)).alias("near"), F.lit(e).alias("e")) for i, e in enumerate(EXPONENTS)]))
        return scores.select(KEY, best["e"].alias("a"), F.lit(0.0).alias("b"))
    if kind == "standard":
        sd = F.coalesce(F.stddev_samp("x"), F.lit(0.0))
        return rows.groupBy(KEY).agg(F.avg("x").alias("a"), F.when(sd > 0, sd).otherwise(1.0).alias("b"))
    if kind == "line":
        return rows.groupBy(KEY).agg(F.coalesce(F.regr_intercept("x", TIME), F.avg("x")).alias("a"), F.coalesce(F.regr_slope("x", TIME), F.lit(0.0)).alias("b"))
    up, down = W.partitionBy(KEY).orderBy(TIME), W.partitionBy(KEY).orderBy(F.desc(TIME))
    ends = rows.withColumn("_i", F.row_number().over(up)).withColumn("_j", F.row_number().over(down)).where((F.col("_i") <= n) | (F.col("_j") <= n))
    pair = F.struct(TIME, "x")
    gather = lambda c: F.array_sort(F.collect_list(F.when(F.col(c) <= n, pair)))
    return ends.groupBy(KEY).agg(gather("_i").alias("a"), gather("_j").alias("b"))  # n values each


def stepped(rows: DataFrame, kind: str, n: int, state: DataFrame | None) -> DataFrame:
    """rows after a step; those that a difference has no value for go."""
    if kind == "log":
        return rows.withColumn("x", F.log1p("x"))
    if kind == "difference":
        return rows.withColumn("x", F.col("x") - F.lag("x", n).over(W.partitionBy(KEY).orderBy(TIME))).where("x is not null")
    x = {"power": power(F.col("x"), F.col("a")), "standard": (F.col("x") - F.col("a")) / F.col("b"), "line": F.col("x") - F.col("a") - F.col("b") * F.col(TIME)}[kind]
    return rows.join(state, KEY).select(KEY, TIME, x.alias("x"))


def fitted(df: DataFrame, steps: Sequence[Step], target: str = "y") -> tuple[DataFrame, list[tuple[str, int, DataFrame | None]]]:
    """key, week_idx, x after all steps, and the steps with their states. Null targets are left out; power takes values of 0 and more. A key with fewer rows than a difference asks for has no rows after it."""
    rows, states = df.select(KEY, TIME, F.col(target).cast("double").alias("x")).where("x is not null"), []
    for kind, *rest in steps:
        n = rest[0] if rest else 1
        rows = cut(rows)
        state = state_of(rows, kind, n)
        states.append((kind, n, None if state is None else cut(state)))
        rows = stepped(rows, kind, n, states[-1][2])
    return rows, states


def applied(df: DataFrame, states: Sequence[tuple[str, int, DataFrame | None]], target: str = "y") -> DataFrame:
    """key, week_idx, x after the steps by states that were fitted on an earlier part."""
    rows = df.select(KEY, TIME, F.col(target).cast("double").alias("x")).where("x is not null")
    for kind, n, state in states:
        rows = stepped(rows, kind, n, state)
    return rows


def restored(df: DataFrame, states: Sequence[tuple[str, int, DataFrame | None]], ahead: bool = False) -> DataFrame:
    """key, week_idx, x as before the steps, out of x after them. ahead: df has the periods after the history, without gaps, else the history, whose first values that differences took come back."""
    rows = df.select(KEY, TIME, "x")
    for kind, n, state in reversed(states):
        if kind == "log":
            rows = rows.withColumn("x", F.expm1("x"))
        elif kind == "difference":
            if not ahead:
                rows = rows.unionByName(state.select(KEY, F.explode("a").alias("v")).select(KEY, f"v.{TIME}", "v.x"))
            phased = rows.withColumn("_p", (F.row_number().over(W.partitionBy(KEY).orderBy(TIME)) - 1) % n)
            rows = phased.withColumn("x", F.sum("x").over(W.partitionBy(KEY, "_p").orderBy(TIME).rowsBetween(W.unboundedPreceding, 0)))
            if ahead:
                rows = rows.join(state.select(KEY, "b"), KEY).withColumn("x", F.col("x") + F.get("b", F.col("_p"))["x"])
            rows = rows.select(KEY, TIME, "x")
        else:
            a, b, x = F.col("a"), F.col("b"), F.col("x")
            back = {"power": F.when(a == 0, F.expm1(x)).otherwise(F.pow(F.greatest(a * x + 1, F.lit(0.0)), 1 / F.when(a != 0, a)) - 1), "standard": x * b + a, "line": x + a + b * F.col(TIME)}[kind]
            rows = rows.join(state, KEY).select(KEY, TIME, back.alias("x"))
    return rows
