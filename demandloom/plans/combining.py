"""Queries: combined forecasts and simple forecast jobs."""

from __future__ import annotations

import uuid

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from demandloom.operators import combine as op
from demandloom.operators import forecast
from demandloom.plans.cleaning import scratch
from demandloom.plans.features import SPARSE, rounded, sparse
from demandloom.plans.joining import SCORED, scored
from demandloom.plans.panels import BRAND, brand_week
from demandloom.plans.registry import query

#: s: mean of 13 weeks, c: mean of 4, rf: last year's week.
PARTS = f"{SCORED}, parts AS (SELECT key, category, CASE WHEN key > 'Brand#3' THEN 'a' ELSE 'b' END AS segment, week_idx, actual, predicted AS s, round(avg(actual) OVER (PARTITION BY key ORDER BY week_idx ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING), 6) AS c, benchmark AS rf FROM scored QUALIFY c IS NOT NULL)"


def parts(spark, sf_dir):
    w = W.partitionBy("key").orderBy("week_idx").rowsBetween(-4, -1)
    rows = scored(spark, sf_dir).withColumn("c", F.round(F.avg("actual").over(w), 6)).where("c is not null")
    return rows.select("key", "category", F.expr("if(key > 'Brand#3', 'a', 'b')").alias("segment"), "week_idx", "actual", F.col("predicted").alias("s"), "c", F.col("benchmark").alias("rf"))


def spread(df, *by):
    return df.select(*by, *[F.round(F.col("weights")[i], 6).alias(f"w{i + 1}") for i in range(3)])


@query(f"{PARTS} SELECT key, week_idx, round(CASE WHEN segment = 'a' AND category = 'C1' THEN 0.5::DOUBLE * s + 0.5::DOUBLE * c WHEN category = 'C1' THEN s WHEN segment = 'a' AND category = 'C4' THEN 0.3::DOUBLE * s + 0.7::DOUBLE * rf ELSE rf END, 6) AS blend FROM parts")
def blend_apply(spark, sf_dir):
    w = spark.createDataFrame([("C1", "a", 0.5, 0.5, 0.0), ("C1", "_default", 1.0, 0.0, 0.0), ("C4", "a", 0.3, 0.0, 0.7)], "category string, segment string, w_s double, w_c double, w_rf double")
    return rounded(op.blend_apply(parts(spark, sf_dir), w), "key", "week_idx", "blend")


GRID = "(SELECT a.x AS w1, b.x AS w2, c.x AS w3 FROM (SELECT unnest(range(0, 7)) / 2.0::DOUBLE AS x) a, (SELECT unnest(range(0, 7)) / 2.0::DOUBLE AS x) b, (SELECT unnest(range(0, 7)) / 2.0::DOUBLE AS x) c)"


def losses(by: str) -> str:
    return f"SELECT {by}, w1, w2, w3, round(e / a + 200 * pow(least(d / a - (least(b / a, 0) - 0.02), 0), 2), 9) AS loss FROM (SELECT {by}, w1, w2, w3, sum(actual) AS a, sum(abs(greatest(0, w1 * s + w2 * c + w3 * rf) - actual)) AS e, sum(greatest(0, w1 * s + w2 * c + w3 * rf) - actual) AS d, sum(rf - actual) AS b FROM parts, grid GROUP BY ALL)"


def fitted(by: str) -> str:
    return f"SELECT {by}, w1, w2, w3, loss FROM ({losses(by)}) QUALIFY row_number() OVER (PARTITION BY {by} ORDER BY loss, w1, w2, w3) = 1"


COARSE = f"{PARTS}, grid AS {GRID}, fit AS ({fitted('category')})"


def coarse(rows, by):
    return op.least_loss(op.score_grid(rows, by, op.cube(3.0, 0.5, 3), 0.02), by)


def refined(step: float, before: str, after: str) -> str:
    """SQL of one round: the best of the 27 points a step around each category's best so far, with weights in [0, 3]."""
    near = ", ".join(f"least(3, greatest(0, w{i} + d{i}.d)) AS w{i}" for i in (1, 2, 3))
    grid = f"SELECT DISTINCT category, {near} FROM {before}, {', '.join(f'(SELECT unnest([-{step}::DOUBLE, 0, {step}]) AS d) d{i}' for i in (1, 2, 3))}"
    sums = "sum(actual) AS a, sum(abs(greatest(0, w1 * s + w2 * c + w3 * rf) - actual)) AS e, sum(greatest(0, w1 * s + w2 * c + w3 * rf) - actual) AS d, sum(rf - actual) AS b"
    loss = "round(e / a + 200 * pow(least(d / a - (least(b / a, 0) - 0.02), 0), 2), 9)"
    scored = f"SELECT category, w1, w2, w3, {loss} AS loss FROM (SELECT p.category, w1, w2, w3, {sums} FROM parts p JOIN ({grid}) n ON n.category = p.category GROUP BY ALL)"
    return f"{after} AS (SELECT * FROM ({scored}) QUALIFY row_number() OVER (PARTITION BY category ORDER BY loss, w1, w2, w3) = 1)"


STEPS = [0.25, 0.125, 0.0625]
FINE = ", ".join(refined(step, f"f{i}" if i else "fit", f"f{i + 1}") for i, step in enumerate(STEPS))


@query(f"{COARSE}, {FINE} SELECT category, round(loss, 6) AS loss, round(w1, 6) AS w1, round(w2, 6) AS w2, round(w3, 6) AS w3 FROM f{len(STEPS)}")
def blend_fit_asymmetric(spark, sf_dir):
    # The operator's own last step is 1/1024; the rounds beyond these are alike.
    fit = op.fit_asymmetric(parts(spark, sf_dir), ["category"], fine=STEPS[-1], reach=1)
    return spread(fit.withColumn("loss", F.round("loss", 6)), "category", "loss")


@query(f"{COARSE} SELECT category, '_default' AS segment, w1 AS w_s, w2 AS w_c, w3 AS w_rf FROM fit")
def blend_weight_table_io(spark, sf_dir):
    folder = f"{scratch(spark)}-{uuid.uuid4().hex[:6]}"
    fit = coarse(parts(spark, sf_dir), ["category"])
    fit.select("category", F.lit("_default").alias("segment"), *[F.col("weights")[i].alias(f"w_{p}") for i, p in enumerate(op.PARTS)]).write.parquet(folder)
    return spark.read.parquet(folder)


GUARD = f"{COARSE}, g AS (SELECT p.category, w1, w2, w3, sum(actual) AS a, sum(abs(greatest(0, w1 * s + w2 * c + w3 * rf) - actual)) AS e, sum(abs(rf - actual)) AS f, sum(greatest(0, w1 * s + w2 * c + w3 * rf) - actual) AS d, sum(rf - actual) AS b FROM parts p JOIN fit USING (category) GROUP BY ALL)"


@query(f"{GUARD}, k AS (SELECT *, 1 - e / a >= 1 - f / a - 1e-3 + 0.2 AND d / a >= least(b / a, 0) - 0.02 AS keep FROM g) SELECT category, CASE WHEN keep THEN w1 ELSE 0 END::DOUBLE AS w1, CASE WHEN keep THEN w2 ELSE 0 END::DOUBLE AS w2, CASE WHEN keep THEN w3 ELSE 1 END::DOUBLE AS w3 FROM k")
def blend_guardrail(spark, sf_dir):
    rows = parts(spark, sf_dir)
    return spread(op.guardrail(rows, coarse(rows, ["category"]), ["category"], margin=0.2), "category")


@query(f"{COARSE}, seg AS ({fitted('category, segment')}), v AS (SELECT category, segment, sum(actual) / 10 AS v FROM parts GROUP BY 1, 2) SELECT seg.category, segment, " + ", ".join(f"round(CASE WHEN v < 1000 THEN {int(i == 3)} ELSE v / (v + 5000) * seg.w{i} + (1 - v / (v + 5000)) * fit.w{i} END, 6)::DOUBLE AS w{i}" for i in (1, 2, 3)) + " FROM seg JOIN fit USING (category) JOIN v USING (category, segment)")
def blend_shrink_to_category(spark, sf_dir):
    rows = parts(spark, sf_dir)
    volumes = rows.groupBy("category", "segment").agg((F.sum("actual") / 10).alias("volume"))
    return spread(op.shrink(coarse(rows, ["category", "segment"]), coarse(rows, ["category"]), volumes), "category", "segment")


@query(f"{COARSE}, f AS (SELECT p.category, w1, w2, w3, least(greatest(sum(actual) / sum(greatest(0, w1 * s + w2 * c + w3 * rf)), 0.5), 2) AS f FROM parts p JOIN fit USING (category) GROUP BY ALL) SELECT category, round(w1 * f, 6) AS w1, round(w2 * f, 6) AS w2, round(w3 * f, 6) AS w3 FROM f")
def blend_calibrated(spark, sf_dir):
    rows = parts(spark, sf_dir)
    return spread(op.calibrated(rows, coarse(rows, ["category"]), ["category"]), "category")


@query(f"{PARTS}, grid AS {GRID}, top AS (SELECT w1, w2, w3 FROM ({losses('1 AS one')}) ORDER BY loss, w1, w2, w3 LIMIT 1), pen AS (SELECT l.category, l.w1, l.w2, l.w3, round(loss + 0.05::DOUBLE * (abs(l.w1 - top.w1) + abs(l.w2 - top.w2) + abs(l.w3 - top.w3)), 9) AS loss FROM ({losses('category')}) l, top) SELECT category, w1, w2, w3 FROM pen QUALIFY row_number() OVER (PARTITION BY category ORDER BY loss, w1, w2, w3) = 1")
def blend_hierarchical_penalty(spark, sf_dir):
    return spread(op.fit_hierarchical(parts(spark, sf_dir), [[], ["category"]], op.cube(3.0, 0.5, 3), 0.05, 0.02), "category")


@query(f"{PARTS}, k AS (SELECT key, (actual - rf) / (s - rf) AS k, abs(s - rf) AS w FROM parts WHERE s <> rf), u AS (SELECT *, sum(w) OVER (PARTITION BY key ORDER BY k) AS up, sum(w) OVER (PARTITION BY key) AS total FROM k) SELECT key, round(greatest(0, least(1, min(k))), 6) AS w1, 'ok' AS status FROM u WHERE 2 * up >= total GROUP BY 1")
def blend_two_forecasts(spark, sf_dir):
    return rounded(op.two_forecasts(parts(spark, sf_dir), ["key"], first="s", second="rf"), "key", "w1", "status")


SIMPLEX = "(SELECT a.x / 10.0::DOUBLE AS w1, b.x / 10.0::DOUBLE AS w2, (10 - a.x - b.x) / 10.0::DOUBLE AS w3 FROM (SELECT unnest(range(0, 11)) AS x) a, (SELECT unnest(range(0, 11)) AS x) b WHERE a.x + b.x <= 10)"


@query(f"{PARTS}, grid AS {SIMPLEX}, l AS (SELECT category, w1, w2, w3, round((sum(abs(w1 * s + w2 * c + w3 * rf - actual)) + 0.5::DOUBLE * abs(sum(w1 * s + w2 * c + w3 * rf - actual))) / sum(actual), 9) AS loss FROM parts, grid GROUP BY ALL) SELECT category, round(0.5 * w1 + 0.5 / 3, 6)::DOUBLE AS w1, round(0.5 * w2 + 0.5 / 3, 6)::DOUBLE AS w2, round(0.5 * w3 + 0.5 / 3, 6)::DOUBLE AS w3 FROM l QUALIFY row_number() OVER (PARTITION BY category ORDER BY loss, w1, w2, w3) = 1")
def blend_simplex_grid(spark, sf_dir):
    return spread(op.fit_simplex(parts(spark, sf_dir), ["category"], op.PARTS), "category")


@query(f"{PARTS}, l AS (SELECT category, i / 20.0::DOUBLE AS share, round(sum(abs(i / 20.0::DOUBLE * s + (1 - i / 20.0::DOUBLE) * rf - actual)) / sum(actual), 9) AS wape FROM parts, (SELECT unnest(range(0, 21)) AS i) GROUP BY 1, 2) SELECT category, share, round(wape, 6) AS wape FROM l QUALIFY row_number() OVER (PARTITION BY category ORDER BY wape, share) = 1")
def blend_share_grid(spark, sf_dir):
    return rounded(op.share_grid(parts(spark, sf_dir), ["category"], "s", "rf"), "category", "share", "wape")


@query(f"{PARTS}, m AS (SELECT category, 1 / avg(pow(s - actual, 2)) AS a, 1 / avg(pow(rf - actual, 2)) AS b FROM parts GROUP BY 1) SELECT category, 's' AS model, round(a / (a + b), 6) AS weight FROM m UNION ALL SELECT category, 'rf', round(b / (a + b), 6) FROM m")
def weights_inverse_error(spark, sf_dir):
    rows = parts(spark, sf_dir).select("category", "actual", F.explode(F.expr("array(named_struct('model', 's', 'predicted', s), named_struct('model', 'rf', 'predicted', rf))")).alias("x")).select("category", "actual", "x.*")
    return rounded(op.inverse_error(rows, ["category"]), "category", "model", "weight")


@query(f"{SPARSE}, n AS (SELECT key, least(count(*) / 100, 0.6) AS w FROM sparse GROUP BY 1) SELECT key, round(w, 6) AS w_key, round((1 - w) * 0.6, 6) AS w_segment, round((1 - w) * 0.4, 6) AS w_category FROM n")
def weights_data_adaptive(spark, sf_dir):
    return rounded(op.data_adaptive(sparse(spark, sf_dir).groupBy("key").agg(F.count("*").alias("n"))), "key", "w_key", "w_segment", "w_category")


@query(f"{PARTS}, grid AS {SIMPLEX}, l AS (SELECT (week_idx // 104)::INT AS fold, w1, w2, w3, round(sum(abs(w1 * s + w2 * c + w3 * rf - actual)) / sum(actual), 9) AS loss FROM parts, grid GROUP BY ALL), b AS (SELECT * FROM l QUALIFY row_number() OVER (PARTITION BY fold ORDER BY loss, w1, w2, w3) = 1), m AS (SELECT avg(w1) AS w1, avg(w2) AS w2, avg(w3) AS w3 FROM b) SELECT round(w1, 6) AS w1, round(w2, 6) AS w2, round(w3, 6) AS w3, round(1 / (w1 * w1 + w2 * w2 + w3 * w3), 6) AS effective FROM m")
def weights_cross_validated(spark, sf_dir):
    rows = parts(spark, sf_dir).withColumn("fold", F.expr("int(week_idx div 104)"))
    return spread(op.cross_validated(rows, "fold", op.PARTS).withColumn("effective", F.round("effective", 6)), "effective")


@query(f"{PARTS} SELECT key, week_idx, round(s + c + rf - greatest(s, c, rf) - least(s, c, rf), 6) AS trimmed FROM parts")
def combine_trimmed_mean(spark, sf_dir):
    rows = parts(spark, sf_dir)
    return rounded(rows.withColumn("trimmed", op.trimmed_mean(rows, op.PARTS)), "key", "week_idx", "trimmed")


@query(f"{PARTS}, h AS (SELECT key, sum(abs(s - actual)) / sum(actual) < sum(abs(rf - actual)) / sum(actual) * 0.75 AS own FROM parts WHERE week_idx <= 1600 GROUP BY 1) SELECT key, week_idx, round(CASE WHEN own THEN 0.7::DOUBLE * s + 0.3::DOUBLE * rf ELSE rf END, 6) AS predicted FROM parts JOIN h USING (key) WHERE week_idx > 1600")
def key_recipe_contest(spark, sf_dir):
    rows = parts(spark, sf_dir).select("key", "week_idx", "actual", F.col("s").alias("own"), F.col("rf").alias("pooled"))
    return rounded(op.contest(rows.where("week_idx <= 1600"), rows.where("week_idx > 1600"), margin=0.25), "key", "week_idx", "predicted")


@query(f"{PARTS}, r AS (SELECT category, actual, rf, 's' AS recipe, s AS p FROM parts UNION ALL SELECT category, actual, rf, 'c', c FROM parts UNION ALL SELECT category, actual, rf, 's+c', (s + c) / 2 FROM parts), m AS (SELECT category, recipe, 1 - sum(abs(p - actual)) / sum(actual) AS a, abs(sum(p - actual) / sum(actual)) AS b, 1 - sum(abs(rf - actual)) / sum(actual) AS ab, abs(sum(rf - actual) / sum(actual)) AS bb FROM r GROUP BY 1, 2) SELECT category, recipe FROM m QUALIFY row_number() OVER (PARTITION BY category ORDER BY CASE WHEN a > ab AND b < bb THEN 2 WHEN a > ab THEN 1 ELSE 0 END DESC, round(a * 1000 - b * 200, 6) DESC, recipe DESC) = 1")
def category_recipe_select(spark, sf_dir):
    return op.recipe_select(parts(spark, sf_dir), "category", ["s", "c"], "rf")


FOLD = f"{SPARSE}, l AS (SELECT key, list({{'y': y, 'size': NULL::DOUBLE, 'gap': 0.0::DOUBLE, 'interval': NULL::DOUBLE}} ORDER BY week_idx) AS ys FROM sparse GROUP BY 1), f AS (SELECT key, list_reduce(ys, lambda s, x: {{'y': x.y, 'size': CASE WHEN x.y > 0 THEN coalesce(s.size + 0.1::DOUBLE * (x.y - s.size), x.y) ELSE s.size END, 'gap': CASE WHEN x.y > 0 THEN 0 ELSE s.gap + 1 END::DOUBLE, 'interval': CASE WHEN x.y > 0 THEN coalesce(s.interval + 0.1::DOUBLE * (s.gap + 1 - s.interval), s.gap + 1) ELSE s.interval END}}, {{'y': 0.0::DOUBLE, 'size': NULL::DOUBLE, 'gap': 0.0::DOUBLE, 'interval': NULL::DOUBLE}}) AS s FROM l)"


@query(f"{FOLD} SELECT key, round(coalesce(s.size / s.interval, 0), 6) AS croston FROM f")
def croston(spark, sf_dir):
    return rounded(forecast.croston(sparse(spark, sf_dir)), "key", "croston")


@query(f"{FOLD} SELECT key, round(coalesce(s.size / s.interval, 0) * 0.95::DOUBLE, 6) AS sba FROM f")
def sba(spark, sf_dir):
    return rounded(forecast.croston(sparse(spark, sf_dir)), "key", "sba")


@query(f"{SPARSE}, l AS (SELECT key, coalesce(avg(y) FILTER (y > 0), 0) AS m, count(*) FILTER (y > 0) / count(*) AS p, list({{'y': y, 'size': 0.0::DOUBLE, 'p': 0.0::DOUBLE}} ORDER BY week_idx) AS ys FROM sparse GROUP BY 1), f AS (SELECT key, list_reduce(ys, lambda s, x: {{'y': x.y, 'size': CASE WHEN x.y > 0 THEN s.size + 0.1::DOUBLE * (x.y - s.size) ELSE s.size END, 'p': s.p + 0.1::DOUBLE * (CASE WHEN x.y > 0 THEN 1 ELSE 0 END - s.p)}}, {{'y': 0.0::DOUBLE, 'size': m::DOUBLE, 'p': p::DOUBLE}}) AS s FROM l) SELECT key, round(s.size * s.p, 6) AS tsb FROM f")
def tsb(spark, sf_dir):
    return rounded(forecast.tsb(sparse(spark, sf_dir)), "key", "tsb")


#: Croston on each level's blocks, which end at the last period.
IMAPA = f"{SPARSE}, sp AS (SELECT min(week_idx) AS a, max(week_idx) AS b FROM sparse), g AS (SELECT key, unnest(range(a, b + 1)) AS week_idx FROM (SELECT DISTINCT key FROM sparse), sp), l AS (SELECT g.key, list(coalesce(y, 0) ORDER BY g.week_idx) AS ys FROM g LEFT JOIN sparse s ON s.key = g.key AND s.week_idx = g.week_idx GROUP BY 1), v AS (SELECT *, len(ys) // level AS k FROM l, (SELECT unnest([1, 2, 4]) AS level)), b AS (SELECT key, level, k, list_transform(range(1, k + 1), lambda i: list_sum(ys[(i - 1) * level + 1 : i * level])) AS blocks FROM v WHERE k > 0), f AS (SELECT key, level, len(list_filter(blocks, lambda x: x > 0)) / k AS w, list_reduce(list_transform(blocks, lambda y: {{'y': y::DOUBLE, 'size': NULL::DOUBLE, 'gap': 0.0::DOUBLE, 'interval': NULL::DOUBLE}}), lambda s, x: {{'y': x.y, 'size': CASE WHEN x.y > 0 THEN coalesce(s.size + 0.1::DOUBLE * (x.y - s.size), x.y) ELSE s.size END, 'gap': CASE WHEN x.y > 0 THEN 0 ELSE s.gap + 1 END::DOUBLE, 'interval': CASE WHEN x.y > 0 THEN coalesce(s.interval + 0.1::DOUBLE * (s.gap + 1 - s.interval), s.gap + 1) ELSE s.interval END}}, {{'y': 0.0::DOUBLE, 'size': NULL::DOUBLE, 'gap': 0.0::DOUBLE, 'interval': NULL::DOUBLE}}) AS s FROM b)"


@query(f"{IMAPA} SELECT key, round(coalesce(sum(coalesce(s.size / s.interval, 0) / level * w) / nullif(sum(w), 0), 0), 6) AS imapa FROM f GROUP BY 1")
def imapa(spark, sf_dir):
    return rounded(forecast.imapa(sparse(spark, sf_dir), [1, 2, 4], grid=True), "key", "imapa")


@query(f"{PARTS}, w AS (SELECT *, week_idx % 8 + 1 AS h FROM parts), v AS (SELECT *, CASE WHEN h <= 2 THEN 0 ELSE least(1, 0.6::DOUBLE + 0.15::DOUBLE * (h - 3)) END AS w FROM w) SELECT key, week_idx, round((1 - w) * c + w * s, 6) AS predicted FROM v")
def hybrid_recursive_direct(spark, sf_dir):
    rows = parts(spark, sf_dir).withColumn("h", F.col("week_idx") % 8 + 1)
    keys = ["key", "week_idx", "h"]
    return rounded(forecast.hybrid(rows.select(*keys, F.col("c").alias("recursive")), rows.select(*keys, F.col("s").alias("direct")), keys), "key", "week_idx", "predicted")


@query(f"{PARTS}, r AS (SELECT key, list(actual - s ORDER BY week_idx) AS rs FROM parts WHERE week_idx <= 1608 GROUP BY 1), e AS (SELECT key, list_reduce(rs, lambda a, x: 0.7::DOUBLE * a + 0.3::DOUBLE * x) AS e FROM r) SELECT key, week_idx, round(greatest(s + coalesce(e, 0) * pow(0.7::DOUBLE, week_idx - 1608), 0), 6) AS corrected FROM parts LEFT JOIN e USING (key) WHERE week_idx > 1608")
def error_correction_ewm(spark, sf_dir):
    rows = parts(spark, sf_dir).withColumn("predicted", F.col("s"))
    residuals = rows.where("week_idx <= 1608").select("key", "week_idx", (F.col("actual") - F.col("s")).alias("residual"))
    return rounded(forecast.error_correction(rows.where("week_idx > 1608").withColumn("h", F.col("week_idx") - 1608), residuals), "key", "week_idx", "corrected")


@query(f"{PARTS}, r AS (SELECT key, avg(actual - s) AS r FROM parts WHERE week_idx <= 1608 GROUP BY 1 HAVING count(*) >= 5) SELECT key, week_idx, round(greatest(s + coalesce(r, 0), 0), 6) AS corrected FROM parts LEFT JOIN r USING (key) WHERE week_idx > 1608")
def global_local_correction(spark, sf_dir):
    rows = parts(spark, sf_dir).withColumn("predicted", F.col("s"))
    return rounded(forecast.local_correction(rows.where("week_idx > 1608"), rows.where("week_idx <= 1608"), 5), "key", "week_idx", "corrected")


@query(f"{PARTS} SELECT key, week_idx, round(avg(s) OVER (PARTITION BY key ORDER BY week_idx ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING), 6) AS smoothed FROM parts WHERE week_idx > 1608")
def horizon_smoothing(spark, sf_dir):
    w = W.partitionBy("key").orderBy("week_idx").rowsBetween(-1, 1)
    return rounded(parts(spark, sf_dir).where("week_idx > 1608").withColumn("smoothed", F.avg("s").over(w)), "key", "week_idx", "smoothed")


@query(f"{PARTS}, f AS (SELECT category, least(greatest(sum(actual) / sum(s), 0.7), 1.8) AS f FROM parts WHERE week_idx <= 1608 GROUP BY 1) SELECT key, week_idx, round(s * f, 6) AS corrected FROM parts JOIN f USING (category) WHERE week_idx > 1608")
def smear_factor(spark, sf_dir):
    rows = parts(spark, sf_dir).withColumn("predicted", F.col("s"))
    return rounded(forecast.smear(rows.where("week_idx > 1608"), rows.where("week_idx <= 1608")), "key", "week_idx", "corrected")


@query(f"{BRAND}, h AS (SELECT unnest(range(1, 14)) AS h) SELECT h::INT AS h, 1 / 13.0::DOUBLE AS balanced, CASE WHEN h IN (4, 5) THEN 0.3 ELSE 0.4 / 11 END::DOUBLE AS focused, (14 - h) / 91.0::DOUBLE AS linear, (SELECT count(*) FROM panel WHERE week_idx % 13 + 1 = h) AS n FROM h")
def horizon_weights(spark, sf_dir):
    rows = brand_week(spark, sf_dir).groupBy((F.col("week_idx") % 13 + 1).alias("h")).agg(F.count("*").alias("n"))
    return forecast.horizon_weights(spark, 13, (4, 5)).join(rows, "h", "left").fillna(0, ["n"])
