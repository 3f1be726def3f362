"""Forecasts by fitted models, on boosted trees of this library and MLlib's distributed estimators."""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandloom.operators import boosting
from demandloom.operators.joins import horizon_pairs
from demandloom.operators.tables import cut
from demandloom.operators.windows import backward_panel


def assembled(df: DataFrame, features: list[str]) -> DataFrame:
    return VectorAssembler(inputCols=features, outputCol="_x").transform(df.fillna(0.0, features))


def tree_importance(df: DataFrame, features: list[str], target: str, trees: int = 10, depth: int = 4, seed: int = 1) -> DataFrame:
    """column, importance: shares of the gain of a random forest."""
    model = RandomForestRegressor(featuresCol="_x", labelCol=target, numTrees=trees, maxDepth=depth, seed=seed).fit(assembled(df, features).where(F.col(target).isNotNull()))
    return df.sparkSession.createDataFrame([(f, float(v)) for f, v in zip(features, model.featureImportances.toArray(), strict=True)], "column string, importance double")


def origin_pairs(panel: DataFrame, horizons: int, lags: list[int], half_life: float, cutoff: int, carry: list[str] | None = None) -> tuple[DataFrame, list[str]]:
    """Pairs of features at an origin and the target h periods on, with recency weights; pairs whose target is after the cutoff have split `predict`. carry: columns of the panel to keep."""
    features = backward_panel(panel, lags, ["price"], [4, 13]).fillna(0.0)
    names = [c for c in features.columns if c not in panel.columns]
    pairs = horizon_pairs(features.select("key", "week_idx", *(carry or []), *names), panel.select("key", "week_idx", F.col("y").alias("actual")), horizons)
    weight = F.pow(F.lit(0.5), (cutoff - F.col("target_idx")) / half_life)
    return pairs.withColumn("weight", F.greatest(F.lit(1e-6), weight)).withColumn("split", F.when(F.col("target_idx") <= cutoff, "train").when(F.col("week_idx") == cutoff, "predict")), names


def pooled_forecast(panel: DataFrame, cutoff: int, horizons: int = 4, lags: list[int] | None = None, trees: int = 8, half_life: float = 52.0, carry: list[str] | None = None) -> DataFrame:
    """key, h, target_idx, actual, predicted, and carry: for each horizon one boosted model with Tweedie loss over all keys, weighted to the recent; no less than 0."""
    return scoped_forecast(panel, cutoff, [], horizons, lags, trees, half_life, carry).drop("scope")


def scoped_forecast(
    panel: DataFrame, cutoff: int, scopes: list[tuple[list[str], int]], horizons: int = 4, lags: list[int] | None = None, trees: int = 8, half_life: float = 52.0, carry: list[str] | None = None
) -> DataFrame:
    """As pooled_forecast, with scope: forecasts of the finest scope whose group has enough training rows, else of the pool (scope `global`).

    scopes: from coarse to fine, columns (category; category and segment) and the training rows that a group needs for a model of its own. A group without any demand has none. All models of
    all scopes and horizons are grown together (boosting.fit), however many there are. Without demand anywhere forecasts are 0.
    """
    extra = list(dict.fromkeys([*(carry or []), *(c for by, _ in scopes for c in by)]))
    pairs, names = origin_pairs(panel, horizons, lags or [1, 2, 13, 52], half_life, cutoff, extra)
    pairs = cut(pairs.where("split is not null"))
    levels = [([], 1), *scopes]
    name = lambda i: F.concat_ws("|", F.lit(i), "h", F.to_json(F.struct(*[F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-")).alias(c) for c in levels[i][0]])) if levels[i][0] else F.lit(""))
    train = pairs.where("split = 'train'")
    # A row serves the model of each scope whose group has rows enough.
    served = train.select(*names, F.col("actual").alias("y"), F.col("weight").alias("w"), F.explode(F.array(*[F.struct(F.lit(i).alias("level"), name(i).alias("m")) for i in range(len(levels))])).alias("s")).select(*names, "y", "w", "s.*")
    sizes = train.select(F.explode(F.array(*[F.struct(F.lit(i).alias("level"), name(i).alias("m")) for i in range(len(levels))])).alias("s")).groupBy("s.level", "s.m").agg(F.count("*").alias("n"))
    enough = sizes.where(F.col("n") >= F.element_at(F.array(*[F.lit(n) for _, n in levels]), F.col("level") + 1)).select("m")
    models, cuts = boosting.fit(served.join(enough, "m"), names, trees)
    ask = pairs.where("split = 'predict'").select("key", "h", "target_idx", "actual", *extra, *names, F.explode(F.array(*[F.struct(F.lit(i).alias("level"), name(i).alias("m")) for i in range(len(levels))])).alias("s")).select("*", "s.*").drop("s")
    shown = ["key", "h", "target_idx"]
    finest = F.max_by(F.struct("actual", *extra, "level", "prediction"), F.when(F.col("prediction").isNotNull(), F.col("level")).otherwise(F.col("level") - len(levels)))
    found = boosting.predict(ask, models, names, cuts).groupBy(*shown).agg(finest.alias("b")).select(*shown, "b.*")
    scope = F.element_at(F.array(*[F.lit("+".join(by) or "global") for by, _ in levels]), F.col("level") + 1)
    return found.select(*shown, "actual", *extra, F.when(F.col("prediction").isNull(), "global").otherwise(scope).alias("scope"), F.coalesce("prediction", F.lit(0.0)).alias("predicted"))


def origin_forecasts(panel: DataFrame, cutoffs: list[int], horizons: int = 4, lags: list[int] | None = None, trees: int = 8, half_life: float = 52.0) -> DataFrame:
    """cutoff, key, h, target_idx, actual, predicted: pooled_forecast at each of a few origins, each from models of its own that know nothing after it; all are grown together."""
    pairs, names = origin_pairs(panel, horizons, lags or [1, 2, 13, 52], half_life, max(cutoffs))
    pairs = cut(pairs.drop("weight", "split").where(F.col("target_idx") <= max(cutoffs) + horizons))
    model = F.concat_ws("|", F.col("cutoff").cast("string"), F.col("h").cast("string"))
    known = pairs.withColumn("cutoff", F.explode(F.filter(F.array(*[F.lit(c) for c in cutoffs]), lambda c: F.col("target_idx") <= c)))
    weight = F.greatest(F.lit(1e-6), F.pow(F.lit(0.5), (F.col("cutoff") - F.col("target_idx")) / half_life))
    models, cuts = boosting.fit(known.select(model.alias("m"), F.col("actual").alias("y"), weight.alias("w"), *names), names, trees)
    ask = pairs.where(F.col("week_idx").isin(cutoffs)).withColumn("cutoff", F.col("week_idx")).withColumn("m", model)
    return boosting.predict(ask, models, names, cuts).select("cutoff", "key", "h", "target_idx", "actual", F.coalesce("prediction", F.lit(0.0)).alias("predicted"))


def recursive_forecast(panel: DataFrame, cutoff: int, horizon: int, lags: list[int] | None = None, windows: list[int] | None = None, penalty: float = 0.1) -> DataFrame:
    """key, week_idx, predicted: a linear model of lags and of means of the last values (windows), both of which each step's forecast enters as demand for the next; no less than 0.

    Each step keeps only as many last values of a key as the longest lag or window is; steps are few and bound by the horizon.
    """
    lags, windows = lags or [1, 2, 13], [4, 13] if windows is None else windows
    most = max([*lags, *windows])
    from demandloom.operators.windows import framed, lagged

    names = [*(f"lag_{n}" for n in lags), *(f"mean_{n}" for n in windows)]
    rows = panel.where(F.col("week_idx") <= cutoff).withColumns({f"lag_{n}": lagged(n) for n in lags} | {f"mean_{n}": framed(F.avg("y"), -n, -1) for n in windows} | {"_whole": lagged(most)})
    model = LinearRegression(featuresCol="_x", labelCol="y", regParam=penalty, elasticNetParam=0.0).fit(assembled(rows.where("_whole is not null"), names))
    last = panel.where((F.col("week_idx") <= cutoff) & (F.col("week_idx") > cutoff - 2 * most)).groupBy("key").agg(F.slice(F.reverse(F.transform(F.array_sort(F.collect_list(F.struct("week_idx", "y"))), lambda s: s["y"])), 1, most).alias("ys"))
    value = lambda n: F.coalesce(F.get("ys", F.lit(n - 1)), F.lit(0.0))
    mean = lambda n: F.aggregate(F.slice("ys", 1, n), F.lit(0.0), lambda a, y: a + F.coalesce(y, F.lit(0.0))) / F.greatest(F.lit(1), F.least(F.size("ys"), F.lit(n)))
    for _ in range(horizon):
        terms = [float(c) * x for c, x in zip(model.coefficients, [*map(value, lags), *map(mean, windows)], strict=True)]
        following = F.greatest(sum(terms[1:], terms[0]) + float(model.intercept), F.lit(0.0))
        last = last.withColumn("ys", F.concat(F.array(following), "ys"))
    steps = F.explode(F.transform(F.slice("ys", 1, horizon), lambda y, i: F.struct((F.lit(cutoff + horizon) - i).alias("week_idx"), y.alias("predicted"))))
    return last.select("key", steps.alias("s")).select("key", "s.*")


def two_stage(train: DataFrame, test: DataFrame, features: list[str]) -> DataFrame:
    """test with p_sale and predicted: the chance of demand times its size where there is any; 0 below a chance set by the share of zeros. train is read four times: write it first (tables.cut) where it is costly."""
    rows = assembled(train, features).withColumn("_s", (F.col("y") > 0).cast("double"))
    zero = rows.agg(F.avg(1 - F.col("_s"))).first()[0] or 0.0
    limit = 0.6 if zero >= 0.7 else 0.5 if zero >= 0.5 else 0.4 if zero >= 0.3 else 0.3
    sale = LogisticRegression(featuresCol="_x", labelCol="_s", probabilityCol="_p", rawPredictionCol="_r", predictionCol="_c", maxIter=20).fit(rows)
    size = LinearRegression(featuresCol="_x", labelCol="y", regParam=0.1, predictionCol="_y", maxIter=20).fit(rows.where("y > 0"))
    scored = size.transform(sale.transform(assembled(test, features))).withColumn("p_sale", vector_to_array("_p")[1])
    return scored.withColumn("predicted", F.when(F.col("p_sale") >= limit, F.col("p_sale") * F.greatest(F.col("_y"), F.lit(0.0))).otherwise(0.0)).drop("_x", "_p", "_r", "_c", "_y")


def isotonic(train: DataFrame, fc: DataFrame) -> DataFrame:
    """corrected: a rising step function of predicted fitted to the actuals of train."""
    rows = train.select(F.col("actual").alias("label"), F.col("predicted").alias("features"))
    model = IsotonicRegression(predictionCol="corrected").fit(rows)
    return model.transform(fc.withColumn("features", F.col("predicted"))).drop("features")


def stacked(panel: DataFrame, cutoff: int, horizons: int = 2, by: str = "category") -> DataFrame:
    """key, h, category, actual, predicted: each category's shares of the pooled forecast and of the 13-period mean that were best at an earlier origin, applied at this one."""
    from demandloom.operators.combine import share_grid

    def both(at: int) -> DataFrame:
        mean = panel.where((F.col("week_idx") <= at) & (F.col("week_idx") > at - 13)).groupBy("key").agg(F.avg("y").alias("local"))
        return pooled_forecast(panel, at, horizons, carry=[by]).join(mean, "key")

    share = share_grid(both(cutoff - horizons), [by], "predicted", "local")
    blend = F.coalesce("share", F.lit(0.5))
    return both(cutoff).join(share, by, "left").select("key", "h", by, "actual", (blend * F.col("predicted") + (1 - blend) * F.col("local")).alias("predicted"))
