"""Queries: accuracy, error analysis and backtests."""

from __future__ import annotations

from pyspark.sql import functions as F

from demandloom.operators import cross, evaluate as op
from demandloom.plans.features import rounded
from demandloom.plans.joining import SCORED, scored
from demandloom.plans.panels import BRAND, PART, brand_week, part_week
from demandloom.plans.registry import query

E = "abs(predicted - actual)"
METRICS = f"count(*) AS n, sum(actual) AS actual_sum, round(sum({E}) / nullif(sum(abs(actual)), 0), 6) AS wape, round(avg({E}), 6) AS mae, round(sqrt(avg(pow(predicted - actual, 2))), 6) AS rmse, round(avg(predicted - actual), 6) AS bias, round(sum(predicted - actual) / nullif(sum(abs(actual)), 0), 6) AS bias_pct"
NAMES = ("n", "actual_sum", "wape", "mae", "rmse", "bias", "bias_pct")
TIER = "CASE WHEN wape <= 0.1 THEN 'excellent' WHEN wape <= 0.2 THEN 'good' WHEN wape <= 0.3 THEN 'fair' WHEN wape <= 0.5 THEN 'poor' ELSE 'bad' END"


@query(f"{SCORED} SELECT category, round(1 - sum({E}) / sum(actual), 6) AS accuracy, round(sum(predicted - actual) / sum(actual), 6) AS bias FROM scored GROUP BY 1")
def accuracy_bias(spark, sf_dir):
    return rounded(op.accuracy_bias(scored(spark, sf_dir), ["category"]), "category", "accuracy", "bias")


@query(f"{SCORED}, m AS (SELECT key, avg({E}) AS e, avg(abs(actual - l)) AS n FROM (SELECT *, lag(actual, 52) OVER (PARTITION BY key ORDER BY week_idx) AS l FROM scored) GROUP BY 1), k AS (SELECT key, {METRICS}, round(avg(CASE WHEN abs(actual) + abs(predicted) > 0 THEN 2 * {E} / (abs(actual) + abs(predicted)) ELSE 0 END), 6) AS smape, round(avg({E} / nullif(abs(actual), 0)), 6) AS mape FROM scored GROUP BY 1) SELECT k.*, round(e / nullif(m.n, 0), 6) AS mase FROM k JOIN m USING (key)")
def metrics_all(spark, sf_dir):
    rows = scored(spark, sf_dir)
    return rounded(op.metrics_by(rows, ["key"]).join(op.mase(rows, "key", 52), "key"), "key", *NAMES, "smape", "mape", "mase")


@query(f"{SCORED}, m AS (SELECT category, {METRICS} FROM scored GROUP BY 1) SELECT *, {TIER} AS tier FROM m")
def metrics_by_group(spark, sf_dir):
    return rounded(op.metrics_by(scored(spark, sf_dir), ["category"]), "category", *NAMES, "tier")


@query(f"{SCORED} SELECT 'overall' AS level, '' AS \"group\", {METRICS} FROM scored UNION ALL SELECT 'category', category, {METRICS} FROM scored GROUP BY category UNION ALL SELECT 'category+key', category || '|' || key, {METRICS} FROM scored GROUP BY category, key")
def metrics_multi_level(spark, sf_dir):
    return rounded(op.metrics_at_levels(scored(spark, sf_dir), [[], ["category"], ["category", "key"]]), "level", "group", *NAMES)


BOARD = f"{SCORED}, rows_ AS (SELECT * FROM scored UNION ALL SELECT key, '__ALL__', week_idx, year_week, actual, predicted, benchmark FROM scored), board AS (SELECT category, (week_idx % 4)::INT AS lag, 1 - sum({E}) / sum(actual) AS accuracy, sum(predicted - actual) / sum(actual) AS bias, 1 - sum(abs(benchmark - actual)) / sum(actual) AS bench_accuracy, sum(benchmark - actual) / sum(actual) AS bench_bias FROM rows_ GROUP BY 1, 2)"


def board(spark, sf_dir):
    return op.scoreboard(scored(spark, sf_dir).withColumn("lag", F.col("week_idx") % 4), ["category", "lag"])


@query(f"{BOARD} SELECT category, lag, round(accuracy, 6) AS accuracy, round(bias, 6) AS bias, round(bench_accuracy, 6) AS bench_accuracy, round(bench_bias, 6) AS bench_bias, CASE WHEN accuracy > bench_accuracy AND abs(bias) < abs(bench_bias) THEN 'WIN' ELSE 'LOSS' END AS verdict FROM board")
def scoreboard_vs_benchmark(spark, sf_dir):
    return rounded(board(spark, sf_dir), "category", "lag", "accuracy", "bias", "bench_accuracy", "bench_bias", "verdict")


@query(f"{BOARD}, v AS (SELECT category, lag, CASE WHEN accuracy > bench_accuracy AND abs(bias) < abs(bench_bias) THEN 'WIN' ELSE 'LOSS' END AS v FROM board) SELECT category, max(v) FILTER (lag = 0) AS l0, max(v) FILTER (lag = 1) AS l1, max(v) FILTER (lag = 2) AS l2, max(v) FILTER (lag = 3) AS l3 FROM v GROUP BY 1")
def win_matrix(spark, sf_dir):
    return op.win_matrix(board(spark, sf_dir), "category", "lag", [0, 1, 2, 3]).toDF("category", "l0", "l1", "l2", "l3")


@query(f"{SCORED} SELECT (year_week // 100)::INT AS snapshot, category, round(1 - sum({E}) / sum(actual), 6) AS accuracy, round(sum(predicted - actual) / sum(actual), 6) AS bias FROM scored GROUP BY 1, 2 UNION ALL SELECT (year_week // 100)::INT, '__ALL__', round(1 - sum({E}) / sum(actual), 6), round(sum(predicted - actual) / sum(actual), 6) FROM scored GROUP BY 1")
def accuracy_pipeline(spark, sf_dir):
    rows = scored(spark, sf_dir).withColumn("snapshot", F.expr("int(year_week div 100)"))
    both = rows.unionByName(rows.withColumn("category", F.lit("__ALL__")))
    return rounded(op.accuracy_bias(both, ["snapshot", "category"]), "snapshot", "category", "accuracy", "bias")


@query(f"{SCORED}, e AS (SELECT week_idx, sum({E}) AS error, sum(abs(benchmark - actual)) AS bench_error, sum({E}) FILTER (actual > 0) / sum(actual) FILTER (actual > 0) AS w FROM scored GROUP BY 1) SELECT week_idx, round(error, 6) AS error, bench_error, round(w, 6) AS sold_wape, CASE WHEN error < bench_error THEN 'ours' WHEN error > bench_error THEN 'benchmark' ELSE 'tie' END AS winner FROM e")
def benchmark_comparison(spark, sf_dir):
    return rounded(op.winners(scored(spark, sf_dir), ["week_idx"]), "week_idx", "error", "bench_error", "sold_wape", "winner")


@query(f"{SCORED}, m AS (SELECT (week_idx % 13 + 1)::INT AS h, {METRICS} FROM scored GROUP BY 1) SELECT * FROM m")
def horizon_decay(spark, sf_dir):
    return rounded(op.metrics_by(scored(spark, sf_dir).withColumn("h", F.col("week_idx") % 13 + 1), ["h"]), "h", *NAMES)


@query(f"{SCORED}, s AS (SELECT week_idx, sum({E}) AS e, sum(actual) AS a FROM scored GROUP BY 1) SELECT week_idx, round(e / a, 6) AS wape, round(sum(e) OVER w / sum(a) OVER w, 6) AS rolling_wape FROM s WINDOW w AS (ORDER BY week_idx ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)")
def error_over_time(spark, sf_dir):
    return rounded(op.errors_over_time(scored(spark, sf_dir)), "week_idx", "wape", "rolling_wape")


@query(f"{SCORED}, m AS (SELECT week_idx, avg(predicted - actual) AS e FROM scored GROUP BY 1), l AS (SELECT e, lag(e, 4) OVER (ORDER BY week_idx) AS l4, lag(e, 13) OVER (ORDER BY week_idx) AS l13 FROM m) SELECT 4::INT AS lag, round(corr(e, l4), 6) AS corr, abs(corr(e, l4)) > 0.3 AS seasonal FROM l UNION ALL SELECT 13, round(corr(e, l13), 6), abs(corr(e, l13)) > 0.3 FROM l")
def error_seasonality(spark, sf_dir):
    return rounded(op.error_seasonality(scored(spark, sf_dir), [4, 13]), "lag", "corr", "seasonal")


@query(f"{SCORED} SELECT category, round(avg(pow(predicted - actual, 2)), 4) AS mse, round(pow(avg(predicted - actual), 2), 4) AS bias_sq, round(var_pop(predicted - actual), 4) AS variance, round(pow(avg(predicted - actual), 2) / avg(pow(predicted - actual, 2)), 6) AS systematic FROM scored GROUP BY 1")
def error_decomposition(spark, sf_dir):
    rows = op.error_decomposition(scored(spark, sf_dir), ["category"])
    return rows.select("category", *[F.round(c, 4).alias(c) for c in ("mse", "bias_sq", "variance")], F.round("systematic", 6).alias("systematic"))


@query(f"{SCORED}, q AS (SELECT quantile_cont({E}, 0.25) AS a, quantile_cont({E}, 0.75) AS b FROM scored) SELECT key, week_idx, round({E}, 6) AS abs_error, round(({E} - b) / (b - a), 6) AS score FROM scored, q WHERE {E} > b + 1.5 * (b - a)")
def error_outliers(spark, sf_dir):
    return rounded(op.error_outliers(scored(spark, sf_dir)), "key", "week_idx", "abs_error", "score")


@query(f"{SCORED}, k AS (SELECT key, sum({E}) / sum(actual) > 0.36 AS failed FROM scored GROUP BY 1), c AS (SELECT key, avg(y) AS mean, stddev_samp(y) AS sd FROM panel GROUP BY 1) SELECT failed, count(*) AS n_keys, round(avg(mean), 6) AS mean, round(avg(sd), 6) AS sd FROM k JOIN c USING (key) GROUP BY 1")
def failure_diagnosis(spark, sf_dir):
    return rounded(op.failures(scored(spark, sf_dir), 0.36, cross.key_stats(brand_week(spark, sf_dir)), ["mean", "sd"]), "failed", "n_keys", "mean", "sd")


@query(f"{SCORED}, b AS (SELECT category, 'mean' AS model, actual, predicted AS p FROM scored UNION ALL SELECT category, 'season', actual, benchmark FROM scored), s AS (SELECT category, model, sum(abs(p - actual)) / sum(actual) AS wape FROM b GROUP BY 1, 2) SELECT category, model, round(wape, 6) AS wape, rank() OVER w::INT AS rank, round((max(wape) FILTER (model = 'season') OVER (PARTITION BY category) - wape) / max(wape) FILTER (model = 'season') OVER (PARTITION BY category), 6) AS lift FROM s WINDOW w AS (PARTITION BY category ORDER BY wape)")
def compare_models_segments_periods(spark, sf_dir):
    rows = scored(spark, sf_dir).select("category", "actual", F.explode(F.expr("array(named_struct('model', 'mean', 'predicted', predicted), named_struct('model', 'season', 'predicted', benchmark))")).alias("m")).select("category", "actual", "m.*")
    return rounded(op.ranked_models(rows, "model", "season", ["category"]), "category", "model", "wape", "rank", "lift")


@query(f"{SCORED}, m AS (SELECT sum({E}) / sum(actual) AS wape, sum(predicted - actual) / sum(actual) AS bias_pct FROM scored) SELECT round(wape, 6) AS wape, round(bias_pct, 6) AS bias_pct, wape <= 0.3 AND abs(bias_pct) <= 0.1 AS ready, round(greatest(0, least(100, (1 - wape) * 100 - abs(bias_pct) * 50)), 6) AS confidence FROM m")
def verdict(spark, sf_dir):
    return rounded(op.verdict(scored(spark, sf_dir)), "wape", "bias_pct", "ready", "confidence")


@query("SELECT (c - 1600)::INT AS origin, c::INT AS cutoff, (c + 1)::INT AS test_start, least(c + 13, 1613)::INT AS test_end FROM (SELECT unnest(range(1600, 1613)) AS c)")
def backtest_origins(spark, sf_dir):
    return op.origins(brand_week(spark, sf_dir), 1600, 1612, 13)


@query(
    f"{PART}, c AS (SELECT unnest(range(1600, 1613)) AS cutoff), "
    "g AS (SELECT key, week_idx, CASE WHEN (week_idx + ascii(key)) % 3 = 0 THEN 0 ELSE y END AS y, row_number() OVER (PARTITION BY key ORDER BY week_idx) AS pos FROM panel), "
    "h AS (SELECT cutoff, g.*, row_number() OVER (PARTITION BY cutoff, key, y > 0 ORDER BY week_idx) AS nth, pos - lag(pos, 1, 0) OVER (PARTITION BY cutoff, key, y > 0 ORDER BY week_idx) AS gap, count(*) OVER (PARTITION BY cutoff, key) AS n, count(CASE WHEN y > 0 THEN 1 END) OVER (PARTITION BY cutoff, key) AS d FROM g JOIN c ON week_idx <= cutoff), "
    "s AS (SELECT cutoff, key, coalesce(sum(CASE WHEN y > 0 THEN pow(0.9::DOUBLE, d - nth) * CASE WHEN nth = 1 THEN 1 ELSE 0.1 END * y END) / sum(CASE WHEN y > 0 THEN pow(0.9::DOUBLE, d - nth) * CASE WHEN nth = 1 THEN 1 ELSE 0.1 END * gap END), 0) AS croston, "
    "coalesce(pow(0.9::DOUBLE, any_value(d)) * avg(CASE WHEN y > 0 THEN y END) + sum(CASE WHEN y > 0 THEN 0.1 * pow(0.9::DOUBLE, d - nth) * y END), 0) * (pow(0.9::DOUBLE, any_value(n)) * any_value(d) / any_value(n) + sum(CASE WHEN y > 0 THEN 0.1 * pow(0.9::DOUBLE, n - pos) ELSE 0 END)) AS tsb FROM h GROUP BY 1, 2), "
    "m AS (SELECT cutoff, key, avg(y) AS mean, arg_max(y, week_idx) AS last FROM g JOIN c ON week_idx <= cutoff AND week_idx > cutoff - 13 GROUP BY 1, 2) "
    "SELECT m.cutoff::INT AS cutoff, (week_idx - m.cutoff)::INT AS h, count(*) AS n, " + ", ".join(f"round(sum(abs({x} - y)) / sum(y), 6) AS wape_{n}" for n, x in (("mean", "mean"), ("last", "last"), ("croston", "croston"), ("sba", "0.95 * croston"), ("tsb", "tsb"))) + " "
    "FROM m JOIN s USING (cutoff, key) JOIN g p ON p.key = m.key AND week_idx > cutoff AND week_idx <= cutoff + 13 GROUP BY 1, 2"
)
def rolling_origin_backtest(spark, sf_dir):
    rows = part_week(spark, sf_dir)
    p = rows.withColumn("y", F.when((F.col("week_idx") + F.ascii("key")) % 3 == 0, 0.0).otherwise(F.col("y")))
    return rounded(op.rolling_backtest(p, op.origins(p, 1600, 1612, 13), 13), "cutoff", "h", "n", *[f"wape_{n}" for n in op.NAIVE])


@query(f"{BRAND}, s AS (SELECT min(week_idx) AS a, max(week_idx) AS b FROM panel) SELECT f::INT AS fold, a AS train_start, (b - (3 - f) * 13 - 13 - 2)::INT AS train_end, (b - (3 - f) * 13 - 12)::INT AS val_start, (b - (3 - f) * 13)::INT AS val_end FROM s, (SELECT unnest(range(0, 4)) AS f)")
def walk_forward_folds(spark, sf_dir):
    return op.folds(brand_week(spark, sf_dir), 4, 13, gap=2)


@query(f"{SCORED}, w AS (SELECT (week_idx // 26)::INT AS fold, sum({E}) / sum(actual) AS wape FROM scored GROUP BY 1) SELECT round(regr_slope(wape, fold), 6) AS slope, round(regr_r2(wape, fold), 6) AS r2, regr_slope(wape, fold) > 0.01 AND regr_r2(wape, fold) > 0.5 AS drifts FROM w")
def drift_check(spark, sf_dir):
    rows = op.metrics_by(scored(spark, sf_dir).withColumn("fold", F.expr("int(week_idx div 26)")), ["fold"])
    return rounded(op.drift(rows), "slope", "r2", "drifts")


@query(f"{BRAND}, k AS (SELECT key, count(y) AS n, count(*) FILTER (y - 10 < 0) AS n_negative, count(DISTINCT y - 10) = 1 AS constant FROM panel GROUP BY 1) SELECT *, n < 357 AS short FROM k WHERE n < 357 OR n_negative > 0 OR constant")
def prediction_completeness(spark, sf_dir):
    return op.completeness(brand_week(spark, sf_dir).withColumn("predicted", F.col("y") - 10), 357)


@query(
    f"{SCORED}, k AS (SELECT key, count(*) AS n, sum({E}) AS e, sum(predicted - actual) AS d, sum(abs(actual)) AS a FROM scored GROUP BY 1), c AS (SELECT key, avg(actual) AS m, stddev_samp(actual) AS s FROM scored GROUP BY 1) "
    "SELECT CASE WHEN s > 0.5::DOUBLE * m THEN 'rough' ELSE 'even' END AS pattern, count(*) AS n_keys, count(CASE WHEN e / nullif(a, 0) > 0.3 THEN 1 END) AS n_failed, sum(n)::BIGINT AS n, round(sum(e) / sum(a), 6) AS wape, round(sum(d) / sum(a), 6) AS bias_pct FROM k JOIN c USING (key) GROUP BY 1"
)
def failures_by_pattern(spark, sf_dir):
    rows = scored(spark, sf_dir)
    patterns = rows.groupBy("key").agg(F.when(F.stddev_samp("actual") > 0.5 * F.avg("actual"), "rough").otherwise("even").alias("pattern"))
    return rounded(op.error_by(rows, patterns, ["pattern"], 0.3), "pattern", "n_keys", "n_failed", "n", "wape", "bias_pct")


@query(
    f"{SCORED}, w AS (SELECT 'forecast' AS name, key, actual, predicted FROM scored UNION ALL SELECT 'copied', key, actual, actual * 1.001 FROM scored UNION ALL SELECT 'flat', key, actual, 7.0 FROM scored), "
    "a AS (SELECT name, count(*) AS n, sum(abs(predicted - actual)) / sum(abs(actual)) AS wape, covar_pop(actual, predicted) / nullif(stddev_pop(actual) * stddev_pop(predicted), 0) AS corr FROM w GROUP BY 1), k AS (SELECT name, key, count(*) > 1 AND stddev_pop(predicted) < 1e-8 AS flat FROM w GROUP BY 1, 2), "
    "c AS (SELECT name, count(CASE WHEN flat THEN 1 END) AS constant_keys, count(*) AS n_keys FROM k GROUP BY 1) "
    "SELECT name, n, round(wape, 6) AS wape, constant_keys, n_keys, wape < 0.01 AS too_good, coalesce(corr > 0.99, false) AS too_alike, constant_keys > 0.8 * n_keys AS constant, wape < 0.01 OR coalesce(corr > 0.99, false) AS suspected FROM a JOIN c USING (name)"
)
def prediction_leakage_check(spark, sf_dir):
    rows = scored(spark, sf_dir).select("key", "actual", "predicted")
    tried = {"forecast": F.col("predicted"), "copied": F.col("actual") * 1.001, "flat": F.lit(7.0)}
    names = ("n", "wape", "constant_keys", "n_keys", "too_good", "too_alike", "constant", "suspected")
    found = [rounded(op.prediction_leakage(rows.withColumn("predicted", p)).withColumn("name", F.lit(n)), "name", *names) for n, p in tried.items()]
    return found[0].unionByName(found[1]).unionByName(found[2])
