"""Events around each row: as-of joins in both directions, and what follows of them for a calendar of periods."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def around(rows: DataFrame, events: DataFrame, by: Sequence[str] = (), time: str = "week_idx") -> DataFrame:
    """rows with last_event and next_event: the times of the nearest events at or before and at or after each row's time, of the same values of `by`; null where there is none.

    Rows and events are sorted as one, forwards and backwards, so that no row meets an event in a join. Without `by` all rows are sorted in one task: one row a period, say.
    """
    events = events.select(*by, F.col(time).alias("_event")).where("_event is not null").distinct()
    both = rows.withColumn("_event", F.lit(None).cast(dict(events.dtypes)["_event"])).withColumn("_row", F.lit(True))
    both = both.unionByName(events.select(*by, F.col("_event").alias(time), "_event", F.lit(False).alias("_row")), allowMissingColumns=True)
    nearest = lambda order: F.last("_event", ignorenulls=True).over(W.partitionBy(*by).orderBy(order).rangeBetween(W.unboundedPreceding, W.currentRow))
    return both.withColumn("last_event", nearest(F.asc(time))).withColumn("next_event", nearest(F.desc(time))).where("_row").drop("_event", "_row")


def event_calendar(periods: DataFrame, events: DataFrame, windows: Sequence[int] = (1, 2, 4), most: int = 52, time: str = "week_idx", name: str = "event") -> DataFrame:
    """time, is_event, n_events (different names), from_last and to_next (periods, `most` at most and without any), pre_N and post_N for each period of periods, one row a period."""
    each = periods.select(time).where(F.col(time).isNotNull()).distinct()
    counted = events.where(F.col(time).isNotNull()).groupBy(time).agg(F.count_distinct(name).alias("n_events")).where("n_events > 0")
    out = around(each, counted.select(time), (), time).join(counted, time, "left").withColumn("n_events", F.coalesce("n_events", F.lit(0)).cast("int"))
    out = out.withColumns({"is_event": (F.col("n_events") > 0).cast("int"), "from_last": F.least(F.lit(most), F.coalesce(F.col(time) - F.col("last_event"), F.lit(most))).cast("int"), "to_next": F.least(F.lit(most), F.coalesce(F.col("next_event") - F.col(time), F.lit(most))).cast("int")})
    flags = {f"{side}_{n}": (F.col(c) <= n).cast("int") for n in windows for side, c in (("pre", "to_next"), ("post", "from_last"))}
    return out.withColumns(flags).drop("last_event", "next_event")


def inject_events(df: DataFrame, events: DataFrame, mode: str = "always", cutoff: int | None = None, windows: Sequence[int] = (1, 2, 4), most: int = 52, time: str = "week_idx") -> DataFrame:
    """df with the columns of event_calendar() for its periods.

    mode: never (columns that df has stay as they are), always (all are replaced) or future_only (rows after the cutoff are replaced; in the others a new column is 0; without a cutoff as always). Rows of a null
    period get nulls.
    """
    if mode not in ("never", "always", "future_only"):
        raise ValueError(f"mode must be never, always or future_only, not {mode}")
    made = event_calendar(df, events, windows, most, time)
    columns = [c for c in made.columns if c != time]
    out = df.join(F.broadcast(made.toDF(*[c if c == time else f"_{c}" for c in made.columns])), time, "left")  # one row a period
    ahead = F.col(time) > cutoff if mode == "future_only" and cutoff is not None else F.lit(True)
    kept = lambda c: F.col(c) if c in df.columns else F.lit(0)
    return out.withColumns({c: F.when(ahead, F.col(f"_{c}")).otherwise(kept(c)) for c in columns if not (mode == "never" and c in df.columns)}).drop(*[f"_{c}" for c in columns])
