"""Transforms restore what they were given; events around rows against plain loops."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from demandloom.operators import calendar, panel, transforms

SCHEMA = "key string, week_idx int, y double"
KINDS = [("log",), ("power",), ("standard",), ("line",), ("difference", 1), ("difference", 4)]


def frame(spark):
    """Keys of rising, constant and short series; a null."""
    rng = random.Random(3)
    rows = [("a", w, 20 + w + rng.random() * 9) for w in range(40)] + [("b", w, 5.0) for w in range(5, 30)] + [("c", w, float(w % 3)) for w in range(12)] + [("c", 12, None)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def values(df, column):
    return {(r.key, r.week_idx): r[column] for r in df.collect() if r[column] is not None}


CHAINS = [[k] for k in KINDS] + [[("log",), ("difference", 4), ("standard",)], [("power",), ("line",), ("difference", 1)], [("difference", 4), ("difference", 1), ("standard",)]]


@pytest.mark.parametrize("steps", CHAINS, ids=lambda s: "-".join(f"{k}{n[0] if n else ''}" for k, *n in s))
def test_back_on_the_history_and_ahead(spark, steps):
    """Steps are fitted up to a period; all values come back, those after it from the states alone."""
    df = frame(spark)
    end = {"a": 30, "b": 22, "c": 9}
    past = F.lit(False)
    for k, e in end.items():
        past = past | ((F.col("key") == k) & (F.col("week_idx") <= e))
    history, states = transforms.fitted(df.where(past), steps)
    want = values(df, "y")
    assert values(transforms.restored(history, states), "x") == pytest.approx({k: y for k, y in want.items() if k[1] <= end[k[0]]}, abs=1e-6)
    ahead = transforms.applied(df, states).where(~past)
    assert values(transforms.restored(ahead, states, ahead=True), "x") == pytest.approx({k: y for k, y in want.items() if k[1] > end[k[0]]}, abs=1e-6)


def test_nearest_events_by_key(spark):
    rng = random.Random(1)
    rows = [(k, rng.randrange(60)) for k in "abc" for _ in range(20)] + [("d", 5)]
    events = [(k, rng.randrange(60)) for k in "ab" for _ in range(6)] + [("a", 10), ("a", 10), ("a", None)]
    out = calendar.around(spark.createDataFrame(rows, "key string, week_idx int"), spark.createDataFrame(events, "key string, week_idx int"), ["key"]).collect()
    assert len(out) == len(rows)
    for r in out:
        own = [w for k, w in events if k == r.key and w is not None]
        assert (r.last_event, r.next_event) == (max((w for w in own if w <= r.week_idx), default=None), min((w for w in own if w >= r.week_idx), default=None))


def test_calendar_and_all_modes(spark):
    df = spark.createDataFrame([("k", w, 9) for w in range(100, 180)] + [("k", None, 9)], "key string, week_idx int, is_event int")
    events = spark.createDataFrame([(110, "fair"), (110, "moon"), (110, "moon"), (170, "fair"), (90, "gone")], "week_idx int, event string")
    made = {r.week_idx: r for r in calendar.inject_events(df, events, "always").collect()}
    assert (made[110].n_events, made[110].is_event, made[110].from_last, made[110].to_next) == (2, 1, 0, 0)
    assert (made[112].from_last, made[112].to_next, made[112].post_2, made[112].post_1, made[112].pre_4) == (2, 52, 1, 0, 0)
    assert (made[100].from_last, made[168].to_next, made[168].pre_2, made[179].to_next) == (10, 2, 1, 52)
    assert made[None].from_last is None
    never = {r.week_idx: r for r in calendar.inject_events(df, events, "never").collect()}
    assert never[110].is_event == 9 and never[110].n_events == 2
    late = {r.week_idx: r for r in calendar.inject_events(df, events, "future_only", 150).collect()}
    assert late[110].is_event == 9 and late[110].n_events == 0 and late[170].is_event == 1
    with pytest.raises(ValueError):
        calendar.inject_events(df, events, "sometimes")


def test_steps_keep_no_row_out(spark):
    """A key with fewer rows than a difference asks for has none after it, and comes back whole from its state."""
    df = frame(spark)
    history, states = transforms.fitted(df, [("difference", 30)])
    assert {k for k, _ in itertools.chain(values(history, "x"))} == {"a"}
    assert values(transforms.restored(history, states), "x") == pytest.approx(values(df, "y"))


def test_dense_grid_from_a_period_on(spark):
    """Windows that look back no further than the first period kept see the same; a key without rows there stays, doubled rows too, and only the panel's own rows are shuffled."""
    rows = spark.createDataFrame([("a", 1, 2.0), ("a", 4, 5.0), ("a", 4, 6.0), ("b", 2, None), ("c", 7, 1.0)], "key string, week_idx int, y double").repartition(3)
    whole = [tuple(r) for r in panel.dense_grid(rows, 1).orderBy("key", "week_idx", "y").collect()]
    assert whole[:6] == [("a", 1, 2.0), ("a", 2, 0.0), ("a", 3, 0.0), ("a", 4, 5.0), ("a", 4, 6.0), ("a", 5, 0.0)] and len(whole) == 25 and ("b", 2, 0.0) in whole and ("c", 8, None) in whole
    late = [tuple(r) for r in panel.dense_grid(rows, 1, since=4).orderBy("key", "week_idx", "y").collect()]
    assert late == [r for r in whole if r[1] >= 4]
    assert panel.dense_grid(rows, since=9).count() == 0
    counted = panel.dense_grid(spark.createDataFrame([(f"k{i}", 1 + 499 * (i % 2), 1.0) for i in range(40)], "key string, week_idx int, y double")).groupBy("key").count()
    assert {r["count"] for r in counted.collect()} == {500} and counted._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0].count("Exchange hashpartitioning") == 1
