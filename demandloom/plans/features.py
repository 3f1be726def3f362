"""Queries: features per key and time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandloom.operators import calendar, transforms
from demandloom.operators import panel as cleaning
from demandloom.operators import windows as op
from demandloom.plans.panels import BRAND, PART, brand_week, part_week
from demandloom.plans.registry import query


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    """The columns asked for, doubles to six places."""
    kinds = dict(df.dtypes)
    return df.select(*[F.round(c, 6).alias(c) if kinds[c] == "double" else F.col(c) for c in columns])


W = "WINDOW w AS (PARTITION BY key ORDER BY week_idx)"
SPARSE = f"{PART}, sparse AS (SELECT key, week_idx, CASE WHEN y < 25 THEN 0 ELSE y END AS y FROM panel)"


def over(first: str, last: str) -> str:
    return f"OVER (PARTITION BY key ORDER BY week_idx ROWS BETWEEN {first} AND {last})"


def sparse(spark, sf_dir):
    return part_week(spark, sf_dir).select("key", "week_idx", F.expr("if(y < 25, 0, y)").alias("y"))


@query(f"{BRAND} SELECT key, week_idx, lag(y, 1) OVER w AS lag_1, lag(y, 13) OVER w AS lag_13, lag(y, 52) OVER w AS lag_52 FROM panel {W}")
def lag_features(spark, sf_dir):
    return rounded(op.lag_features(brand_week(spark, sf_dir), [1, 13, 52]), "key", "week_idx", "lag_1", "lag_13", "lag_52")


@query(f"{BRAND} SELECT key, week_idx, lag(y, 1) OVER w - lag(y, 4) OVER w AS diff_1_4, round(lag(y, 1) OVER w / (lag(y, 4) OVER w + 1e-10), 6) AS ratio_1_4, round((lag(y, 1) OVER w - lag(y, 4) OVER w) / nullif(lag(y, 4) OVER w, 0), 6) AS pct_1_4 FROM panel {W}")
def lag_combinations(spark, sf_dir):
    return rounded(op.lag_combinations(brand_week(spark, sf_dir), [(1, 4)]), "key", "week_idx", "diff_1_4", "ratio_1_4", "pct_1_4")


@query(f"{BRAND} SELECT key, week_idx, round((lag(y) OVER w - lag(y, 5) OVER w) / nullif(lag(y, 5) OVER w, 0), 6) AS roc_4, lag(y) OVER w - lag(y, 5) OVER w AS momentum_4, lag(y) OVER w - lag(y, 5) OVER w - lag(y, 2) OVER w + lag(y, 6) OVER w AS acceleration_4 FROM panel {W}")
def momentum_features(spark, sf_dir):
    return rounded(op.momentum(brand_week(spark, sf_dir), [4]), "key", "week_idx", "roc_4", "momentum_4", "acceleration_4")


@query(f"{BRAND} SELECT key, week_idx, lag(y, 52) OVER w AS lag_season, lag(y) OVER w - lag(y, 53) OVER w AS yoy, round(lag(y) OVER w / nullif(lag(y, 53) OVER w, 0), 6) AS yoy_ratio, lag(y) OVER w - lag(y, 14) OVER w AS qoq FROM panel {W}")
def seasonal_lag_features(spark, sf_dir):
    return rounded(op.seasonal_lags(brand_week(spark, sf_dir)), "key", "week_idx", "lag_season", "yoy", "yoy_ratio", "qoq")


F13 = over("13 PRECEDING", "1 PRECEDING")


@query(f"{BRAND}, a AS (SELECT key, week_idx, count(y) {F13} AS n, avg(y) {F13} AS a, stddev_samp(y) {F13} AS b, min(y) {F13} AS c, max(y) {F13} AS d, sum(y) {F13} AS e, quantile_cont(y, 0.5) {F13} AS f FROM panel) SELECT key, week_idx, CASE WHEN n >= 4 THEN round(a, 6) END AS roll_mean_13, CASE WHEN n >= 4 THEN round(b, 6) END AS roll_std_13, CASE WHEN n >= 4 THEN c END AS roll_min_13, CASE WHEN n >= 4 THEN d END AS roll_max_13, CASE WHEN n >= 4 THEN e END AS roll_sum_13, CASE WHEN n >= 4 THEN f END AS roll_median_13 FROM a")
def rolling_features(spark, sf_dir):
    names = ["mean", "std", "min", "max", "sum", "median"]
    return rounded(op.rolling(brand_week(spark, sf_dir), [13], names, least=4), "key", "week_idx", *[f"roll_{n}_13" for n in names])


@query(
    f"{BRAND}, n AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY week_idx) AS r FROM panel), p AS (SELECT a.key, a.week_idx, b.y, pow(0.6::DOUBLE, a.r - b.r - 1) AS w, pow(25 / 27.0::DOUBLE, a.r - b.r - 1) AS v FROM n a LEFT JOIN n b ON b.key = a.key AND b.r < a.r), "
    "m AS (SELECT *, sum(w * y) OVER g / sum(w) OVER g AS m4, sum(v * y) OVER g / sum(v) OVER g AS m26 FROM p WINDOW g AS (PARTITION BY key, week_idx)) "
    "SELECT key, week_idx, round(any_value(m4), 6) AS ewm_4, round(any_value(m26), 6) AS ewm_26, "
    "CASE WHEN count(y) > 1 THEN round(sqrt(sum(w * (y - m4) * (y - m4)) * sum(w) / (sum(w) * sum(w) - sum(w * w))), 6) END AS ewm_std_4, "
    "CASE WHEN count(y) > 1 THEN round(sqrt(sum(v * (y - m26) * (y - m26)) * sum(v) / (sum(v) * sum(v) - sum(v * v))), 6) END AS ewm_std_26 FROM m GROUP BY 1, 2"
)
def ewm_features(spark, sf_dir):
    return rounded(op.ewm(brand_week(spark, sf_dir), [4, 26]), "key", "week_idx", "ewm_4", "ewm_26", "ewm_std_4", "ewm_std_26")


UP1 = over("UNBOUNDED PRECEDING", "1 PRECEDING")


@query(f"{BRAND} SELECT key, week_idx, round(avg(y) {UP1}, 6) AS exp_mean, round(stddev_samp(y) {UP1}, 6) AS exp_std, min(y) {UP1} AS exp_min, max(y) {UP1} AS exp_max, sum(y) {UP1} AS exp_sum, quantile_cont(y, 0.5) {UP1} AS exp_median, count(y) {UP1} AS exp_count FROM panel")
def expanding_features(spark, sf_dir):
    return rounded(op.expanding(brand_week(spark, sf_dir), ["mean", "std", "min", "max", "sum", "median"]), "key", "week_idx", "exp_mean", "exp_std", "exp_min", "exp_max", "exp_sum", "exp_median", "exp_count")


@query(f"{BRAND} SELECT key, week_idx, round(stddev_samp(y) {F13} / nullif(avg(y) {F13}, 0), 6) AS cv_13, max(y) {F13} - min(y) {F13} AS range_13, round(quantile_cont(y, 0.75) {F13} - quantile_cont(y, 0.25) {F13}, 6) AS iqr_13 FROM panel")
def rolling_volatility(spark, sf_dir):
    return rounded(op.rolling_volatility(brand_week(spark, sf_dir), [13]), "key", "week_idx", "cv_13", "range_13", "iqr_13")


@query(f"{BRAND} SELECT key, week_idx, lag(y) OVER w - lag(y, 5) OVER w AS change_4, round((lag(y) OVER w - lag(y, 5) OVER w) / nullif(lag(y, 5) OVER w, 0), 6) AS pct_change_4, sign(lag(y) OVER w - lag(y, 5) OVER w)::INT AS direction_4 FROM panel {W}")
def trend_features(spark, sf_dir):
    return rounded(op.trend(brand_week(spark, sf_dir), [4]), "key", "week_idx", "change_4", "pct_change_4", "direction_4")


@query(f"{BRAND}, f AS (SELECT key, regr_slope(y, week_idx) AS s, regr_intercept(y, week_idx) AS i FROM panel GROUP BY 1) SELECT key, week_idx, round(y - (i + s * week_idx), 5) AS linear_residual, round(y - avg(y) {over('6 PRECEDING', '6 FOLLOWING')}, 6) AS ma_residual FROM panel JOIN f USING (key)")
def detrend_features(spark, sf_dir):
    return rounded(op.detrend(brand_week(spark, sf_dir)).withColumn("linear_residual", F.round("linear_residual", 5)), "key", "week_idx", "linear_residual", "ma_residual")


F4, C13, F52 = over("3 PRECEDING", "CURRENT ROW"), over("12 PRECEDING", "CURRENT ROW"), over("51 PRECEDING", "CURRENT ROW")


@query(f"{BRAND}, m AS (SELECT key, week_idx, CASE WHEN count(y) {F4} >= 2 THEN avg(y) {F4} END AS a, CASE WHEN count(y) {C13} >= 3 THEN avg(y) {C13} END AS b, CASE WHEN count(y) {F52} >= 10 THEN avg(y) {F52} END AS c, CASE WHEN count(y) {C13} >= 3 THEN stddev_samp(y) {C13} END AS s FROM panel) SELECT key, week_idx, round(a - b, 6) AS trend_4_13, round(b - c, 6) AS trend_13_52, round(a - 2 * b + c, 6) AS accel, CASE WHEN s / nullif(b, 0) IS NOT NULL THEN round(least(greatest(s / b, 0), 10), 6) END AS cv13, CASE WHEN a / nullif(c, 0) IS NOT NULL THEN round(least(greatest(a / c, 0), 10), 6) END AS recent_long FROM m")
def trajectory_features(spark, sf_dir):
    return rounded(op.trajectory(brand_week(spark, sf_dir)), "key", "week_idx", "trend_4_13", "trend_13_52", "accel", "cv13", "recent_long")


F26 = over("26 PRECEDING", "1 PRECEDING")


@query(f"{BRAND} SELECT key, week_idx, lag(y, 1) OVER w AS lag_1, lag(price, 4) OVER w AS price_lag_4, round(avg(y) {F13}, 6) AS rmean_13, CASE WHEN count(y) {F13} >= 2 THEN round(stddev_samp(y) {F13}, 6) END AS rstd_13, round(avg((y = 0)::INT) {F26}, 6) AS zerofrac_26, round((lag(y) OVER w + 1) / (lag(y, 52) OVER w + 1), 6) AS sply_ratio FROM panel {W}")
def backward_panel_features(spark, sf_dir):
    return rounded(op.backward_panel(brand_week(spark, sf_dir), [1], ["price"], [13]), "key", "week_idx", "lag_1", "price_lag_4", "rmean_13", "rstd_13", "zerofrac_26", "sply_ratio")


P4 = over("4 PRECEDING", "1 PRECEDING")


@query(f"{BRAND}, m AS (SELECT key, week_idx, avg(y) {P4} AS a, avg(y) {F13} AS b, CASE WHEN count(y) {P4} >= 2 THEN stddev_samp(y) {P4} END AS s, CASE WHEN count(y) {F13} >= 2 THEN stddev_samp(y) {F13} END AS t FROM panel) SELECT key, week_idx, CASE WHEN a / nullif(b, 0) IS NOT NULL THEN round(least(greatest(a / b, 0), 5), 6) END AS growth_ratio, CASE WHEN s / nullif(t, 0) IS NOT NULL THEN round(least(greatest(s / t, 0), 10), 6) END AS volatility_ratio, CASE WHEN a / nullif(b, 0) IS NOT NULL THEN round(least(greatest((a - b) / b, -2), 2), 6) END AS momentum, CASE WHEN (a - b) / nullif(t, 0) IS NOT NULL THEN round(least(greatest((a - b) / t, -3), 3), 6) END AS level_shift FROM m")
def regime_features(spark, sf_dir):
    return rounded(op.regime(brand_week(spark, sf_dir)), "key", "week_idx", "growth_ratio", "volatility_ratio", "momentum", "level_shift")


@query(f"{PART}, m AS (SELECT key, week_idx, avg(y) FILTER (promo = 1) {UP1} AS a, avg(y) FILTER (promo = 0) {UP1} AS b, count(y) {UP1} AS n, avg(y) FILTER (promo = 1) {F13} AS c, avg(y) FILTER (promo = 0) {F13} AS d, count(y) {F13} AS k FROM panel) SELECT key, week_idx, CASE WHEN n >= 8 AND a / nullif(b, 0) IS NOT NULL THEN round(least(greatest(a / b, 0.2), 5), 6) ELSE 1 END::DOUBLE AS promo_lift, CASE WHEN k >= 8 AND c / nullif(d, 0) IS NOT NULL THEN round(least(greatest(c / d, 0.2), 5), 6) ELSE 1 END::DOUBLE AS promo_lift_recent, (n >= 8)::INT AS promo_history FROM m")
def promo_lift(spark, sf_dir):
    return rounded(op.promo_lift(part_week(spark, sf_dir), ["promo"]), "key", "week_idx", "promo_lift", "promo_lift_recent", "promo_history")


@query(f"{PART} SELECT key, week_idx, round(promo + {' + '.join(f'coalesce(lag(promo, {i}) OVER w, 0) * pow(0.5::DOUBLE, {i})' for i in range(1, 8))}, 6) AS adstock_50, round(avg((promo > 0)::INT) {C13}, 6) AS promo_frequency FROM panel {W}")
def adstock_features(spark, sf_dir):
    return rounded(op.adstock(part_week(spark, sf_dir), "promo", [0.5]), "key", "week_idx", "adstock_50", "promo_frequency")


@query(f"{SPARSE}, p AS (SELECT *, row_number() OVER w AS pos FROM sparse {W}) SELECT key, week_idx, (lag(y) OVER w > 0)::INT AS occurred, pos - max(CASE WHEN y > 0 THEN pos END) {UP1} AS since_last, round(count(CASE WHEN y > 0 THEN 1 END) {F13} / nullif(count(y) {F13}, 0), 6) AS frequency_13, round(avg(CASE WHEN y > 0 THEN y END) {UP1}, 6) AS size_mean, round(stddev_samp(CASE WHEN y > 0 THEN y END) {UP1}, 6) AS size_std, last_value(CASE WHEN y > 0 THEN y END IGNORE NULLS) {UP1} AS size_last, round((max(CASE WHEN y > 0 THEN pos END) {UP1} - min(CASE WHEN y > 0 THEN pos END) {UP1}) / nullif(greatest(count(CASE WHEN y > 0 THEN 1 END) {UP1} - 1, 0), 0), 6) AS adi FROM p {W}")
def intermittency_features(spark, sf_dir):
    rows = op.intermittency(sparse(spark, sf_dir))
    return rounded(rows, "key", "week_idx", "occurred", "since_last", "frequency_13", "size_mean", "size_std", "size_last", "adi")


@query(f"{SPARSE}, p AS (SELECT *, row_number() OVER w AS pos, y > 0 AS sold, CASE WHEN (y > 0) <> lag(y > 0) OVER w THEN 1 ELSE 0 END AS turn FROM sparse {W}), r AS (SELECT *, sum(turn) OVER w AS run, CASE WHEN sold THEN pos - max(CASE WHEN sold THEN pos END) {UP1} END AS gap FROM p {W}), s AS (SELECT *, CASE WHEN sold THEN 1 ELSE -1 END * row_number() OVER (PARTITION BY key, run ORDER BY week_idx) AS streak FROM r) SELECT key, week_idx, CASE WHEN max(CASE WHEN sold THEN pos END) {UP1} IS NOT NULL THEN least(pos - max(CASE WHEN sold THEN pos END) {UP1}, 52) ELSE 52 END::INT AS weeks_since, round(count(CASE WHEN sold THEN 1 END) {UP1} / nullif(count(y) {UP1}, 0), 6) AS probability, quantile_cont(CASE WHEN sold THEN y END, 0.5) {UP1} AS order_median, (lag(streak) OVER w)::INT AS streak, round(1 / (1 + stddev_samp(gap) {UP1} / avg(gap) {UP1}), 6) AS consistency FROM s {W}")
def sparsity_features(spark, sf_dir):
    rows = op.sparsity(sparse(spark, sf_dir)).withColumn("weeks_since", F.col("weeks_since").cast("int"))
    return rounded(rows, "key", "week_idx", "weeks_since", "probability", "order_median", "streak", "consistency")


@query(f"{BRAND}, p AS (SELECT *, row_number() OVER w AS pos FROM panel {W}) SELECT key, week_idx, CASE WHEN count(y) {C13} >= 6 THEN round(regr_slope(y, pos) {C13}, 6) END AS slope_13 FROM p")
def rolling_slope(spark, sf_dir):
    return rounded(op.rolling_slope(brand_week(spark, sf_dir), 13), "key", "week_idx", "slope_13")


C8 = over("7 PRECEDING", "CURRENT ROW")


@query(f"{BRAND} SELECT key, week_idx, CASE WHEN count(y) {C8} >= 5 THEN round(stddev_samp(y) {C8} / nullif(avg(y) {C8}, 0), 6) END AS cv_8, CASE WHEN count(y) {C13} >= 8 THEN round(stddev_samp(y) {C13} / nullif(avg(y) {C13}, 0), 6) END AS cv_13 FROM panel")
def rolling_cv(spark, sf_dir):
    return rounded(op.rolling_cv(brand_week(spark, sf_dir), [8, 13]), "key", "week_idx", "cv_8", "cv_13")


@query(f"{BRAND}, m AS (SELECT key, week_idx, avg(y) {C13} AS m, stddev_samp(y) {C13} AS s, row_number() OVER w AS n FROM panel {W}), z AS (SELECT key, week_idx, CASE WHEN n >= 39 THEN (m - lag(m, 13) OVER w) / nullif(s, 0) END AS z FROM m {W}) SELECT key, week_idx, round(z, 6) AS shift_z, coalesce(abs(z) > 2, false) AS shifted FROM z")
def level_shift_flags(spark, sf_dir):
    return rounded(op.level_shifts(brand_week(spark, sf_dir)), "key", "week_idx", "shift_z", "shifted")


@query(f"{BRAND} SELECT key, week_idx, least(abs(week_idx - 1400), abs(week_idx - 1500), abs(week_idx - 1600))::INT AS event_distance, (week_idx IN (1400, 1500, 1600))::INT AS is_event FROM panel")
def event_distance_features(spark, sf_dir):
    return rounded(op.event_distance(brand_week(spark, sf_dir), [1400, 1500, 1600]), "key", "week_idx", "event_distance", "is_event")


@query(f"{BRAND} SELECT key, week_idx, round(greatest(pow(0.5::DOUBLE, ((SELECT max(week_idx) FROM panel) - week_idx) / 26), 1e-6::DOUBLE), 6) AS weight FROM panel")
def recency_weight(spark, sf_dir):
    return rounded(op.recency_weights(brand_week(spark, sf_dir), 26), "key", "week_idx", "weight")


@query(f"{BRAND}, s AS (SELECT key, avg(y) AS m, stddev_samp(y) AS s FROM panel GROUP BY 1) SELECT key, week_idx, round(ln(1 + y), 6) AS logged, y - lag(y) OVER w AS difference, y - lag(y, 52) OVER w AS seasonal, round((y - m) / nullif(s, 0), 6) AS standard, y AS again FROM panel JOIN s USING (key) {W}")
def target_transforms(spark, sf_dir):
    rows = brand_week(spark, sf_dir).select("key", "week_idx", "y")
    for kind, name in (("log", "logged"), ("seasonal", "seasonal"), ("standard", "standard"), ("difference", "difference")):
        rows = op.transform_target(rows, kind).withColumn(name, F.col("transformed"))
    return rounded(op.restored(rows, "difference").withColumn("again", F.col("restored")), "key", "week_idx", "logged", "difference", "seasonal", "standard", "again")


@query(
    f"{BRAND}, l AS (SELECT key, week_idx, y, ln(1 + y) - lag(ln(1 + y), 52) OVER w AS d FROM panel {W}), m AS (SELECT key, avg(d) AS m, stddev_samp(d) AS s FROM l WHERE week_idx <= 1600 GROUP BY 1) "
    "SELECT l.key, week_idx, round((d - m) / s, 6) AS x, y AS again FROM l JOIN m ON m.key = l.key"
)
def target_transform_chain(spark, sf_dir):
    rows = brand_week(spark, sf_dir).select("key", "week_idx", "y")
    history, states = transforms.fitted(rows.where("week_idx <= 1600"), [("log",), ("difference", 52), ("standard",)])
    ahead = transforms.applied(rows, states).where("week_idx > 1600")
    again = transforms.restored(history, states).unionByName(transforms.restored(ahead, states, ahead=True)).withColumnRenamed("x", "again")
    return rounded(again.join(history.unionByName(ahead), ["key", "week_idx"], "left"), "key", "week_idx", "x", "again")


@query(
    f"{BRAND}, p AS (SELECT DISTINCT week_idx FROM panel), e AS (SELECT week_idx, 'moon' AS event FROM p WHERE week_idx % 17 = 3 UNION ALL SELECT week_idx, 'fair' FROM p WHERE week_idx % 52 = 7), "
    "n AS (SELECT p.week_idx, count(event)::INT AS n_events FROM p LEFT JOIN e USING (week_idx) GROUP BY 1), "
    "d AS (SELECT week_idx, n_events, least(52, coalesce(week_idx - max(CASE WHEN n_events > 0 THEN week_idx END) OVER (ORDER BY week_idx), 52))::INT AS from_last, "
    "least(52, coalesce(min(CASE WHEN n_events > 0 THEN week_idx END) OVER (ORDER BY week_idx ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) - week_idx, 52))::INT AS to_next FROM n) "
    "SELECT key, week_idx, CASE WHEN week_idx > 1600 THEN n_events ELSE 0 END AS n_events, CASE WHEN week_idx > 1600 THEN (n_events > 0)::INT ELSE promo END AS is_event, CASE WHEN week_idx > 1600 THEN from_last ELSE 0 END AS from_last, "
    "CASE WHEN week_idx > 1600 THEN to_next ELSE 0 END AS to_next, " + ", ".join(f"CASE WHEN week_idx > 1600 THEN ({c} <= {n})::INT ELSE 0 END AS {side}_{n}" for n in (1, 2, 4) for side, c in (("pre", "to_next"), ("post", "from_last"))) + " FROM panel JOIN d USING (week_idx)"
)
def calendar_events(spark, sf_dir):
    rows = brand_week(spark, sf_dir).select("key", "week_idx", F.col("promo").alias("is_event"))
    weeks = rows.select("week_idx").distinct()
    events = weeks.where("week_idx % 17 = 3").withColumn("event", F.lit("moon")).union(weeks.where("week_idx % 52 = 7").withColumn("event", F.lit("fair")))
    return calendar.inject_events(rows, events, "future_only", 1600)


@query(f"{BRAND}, s AS (SELECT min(week_idx) AS a, max(week_idx) AS b FROM panel), g AS (SELECT key, unnest(range(a, b + 1)) AS week_idx FROM (SELECT DISTINCT key FROM panel), s), d AS (SELECT g.key, g.week_idx, coalesce(y, 0) AS y FROM g LEFT JOIN panel p ON p.key = g.key AND p.week_idx = g.week_idx), o AS (SELECT key, max(CASE WHEN week_idx = 1564 THEN y END) AS last_value, avg(y) FILTER (week_idx BETWEEN 1552 AND 1564) AS mean_13 FROM d GROUP BY 1) SELECT o.key, h::INT AS h, (1564 + h)::INT AS week_idx, o.last_value, round(mean_13, 6) AS mean_13, d.y AS sply FROM o, (SELECT unnest(range(1, 14)) AS h) LEFT JOIN d ON d.key = o.key AND d.week_idx = 1564 + h - 52")
def naive_baselines(spark, sf_dir):
    from demandloom.operators import forecast

    return rounded(forecast.naive(cleaning.dense_grid(brand_week(spark, sf_dir)), 1564, 13), "key", "h", "week_idx", "last_value", "mean_13", "sply")
