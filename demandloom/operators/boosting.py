"""Boosted trees with Tweedie loss, grown for any number of models at once.

Features are binned once. A level of a tree takes one aggregation for all models: gradients and hessians summed by model, node, feature and bin, from which each node's
best split follows by running sums over its bins. So the number of jobs depends on the trees and their depth, not on how many models there are or how rows are
dealt to them, and a model that holds most rows is summed on the map side like any other.

A tree is a map from nodes to splits. Node 1 is the root, node n has the children 2n and 2n + 1; where a split is missing, a leaf's value is that of its last split.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandloom.operators.tables import cut

#: Models whose trees may be held by the driver and broadcast; they are counted before. Beyond, trees are tables that are joined.
FEW = 10_000
SPLIT = "struct<feature: int, bin: int, low: double, high: double>"
#: Errors of the sketch that places the bins' edges are at most one in so many of the rows.
ACCURACY = 10_000


def edges(rows: DataFrame, features: list[str], bins: int) -> list[list[float]]:
    """At most bins - 1 ascending edges of each feature, a few numbers, by one sketch over all rows."""
    at = [i / bins for i in range(1, bins)]
    found = rows.agg(*[F.percentile_approx(f, at, ACCURACY).alias(f"e{i}") for i, f in enumerate(features)]).first()
    return [sorted({float(x) for x in e or []}) for e in found]


def binned(features: list[str], cuts: list[list[float]]) -> str:
    """SQL of the bins of a row's features: 0 for null and NaN, else 1 and the number of edges below the value."""
    each = [f"case when `{f}` is null or isnan(`{f}`) then 0 else {' + '.join(['1', *(f'int(`{f}` > double({e!r}))' for e in c)])} end" for f, c in zip(features, cuts, strict=True)]
    return f"array({', '.join(each)})"


def walked(splits: str, depth: int, bins: str = "bins") -> str:
    """SQL of where `depth` splits take a row: node (a leaf's if splits end before), value of its last split, open (whether all splits were there)."""
    steps = f"sequence(1, {depth})" if depth else "cast(array() as array<int>)"
    right = f"{bins}[{splits}[s.node].feature] > {splits}[s.node].bin"
    went = f"named_struct('node', 2 * s.node + int({right}), 'value', if({right}, {splits}[s.node].high, {splits}[s.node].low), 'open', true)"
    return f"aggregate({steps}, named_struct('node', 1, 'value', 0D, 'open', true), (s, i) -> if({splits}[s.node] is null, named_struct('node', s.node, 'value', s.value, 'open', false), {went}))"


def gradients(power: float) -> tuple[str, str]:
    """SQL of the first and second derivative of the weighted loss at the margin, a logarithm."""
    mean, size = f"exp({1 - power!r}D * margin)", f"exp({2 - power!r}D * margin)"
    return f"w * ({size} - y * {mean})", f"w * ({2 - power!r}D * {size} - {1 - power!r}D * y * {mean})"


def best_splits(rows: DataFrame, penalty: float, least: int) -> DataFrame:
    """m, new (map from the nodes that have one to their splits). rows: m, node, g, h, bins."""
    sums = rows.selectExpr("m", "node", "g", "h", "posexplode(bins) as (feature, bin)").groupBy("m", "node", "feature", "bin").agg(F.expr("sum(g) g"), F.expr("sum(h) h"), F.expr("count(*) n"))
    # A model's sums are as many as a level's nodes, features and bins allow, so all further steps may use this one partitioning.
    own = "over (partition by m, node, feature"
    both = sums.repartition("m").selectExpr("m", "node", "feature", "bin", *[f"sum({c}) {own} order by bin) {c}" for c in "ghn"], *[f"sum({c}) {own}) all_{c}" for c in "ghn"])
    score = lambda g, h: f"pow({g}, 2) / ({h} + {penalty!r}D)"
    gain = f"{score('g', 'h')} + {score('all_g - g', 'all_h - h')} - {score('all_g', 'all_h')}"
    # Of equal gains the first feature and bin; sums differ in their last digits from run to run.
    tried = both.selectExpr("*", f"bround({gain}, 9) gain").where(f"n >= {least} and all_n - n >= {least} and gain > 1e-9")
    split = f"named_struct('feature', feature, 'bin', bin, 'low', -g / (h + {penalty!r}D), 'high', -(all_g - g) / (all_h - h + {penalty!r}D))"
    best = tried.groupBy("m", "node").agg(F.expr(f"cast(max_by({split}, struct(gain, -feature, -bin)) as {SPLIT}) split"))
    return best.groupBy("m").agg(F.expr("map_from_entries(collect_list(struct(node, split))) new"))  # as many as a level has nodes


def joined(rows: DataFrame, models: DataFrame, few: bool, how: str = "inner") -> DataFrame:
    return rows.join(F.broadcast(models) if few and how != "right" else models, "m", how)


def held(models: DataFrame, few: bool) -> DataFrame:
    """A table of one row a model, computed once."""
    return models.sparkSession.createDataFrame(models.toArrow(), models.schema) if few else cut(models)


def fit(rows: DataFrame, features: list[str], trees: int = 8, depth: int = 3, rate: float = 0.3, power: float = 1.3, penalty: float = 1.0, least: int = 20, bins: int = 32) -> tuple[DataFrame, list[list[float]]]:
    """m, base, trees of each model, and the edges of the features' bins.

    rows: m (a model's name), y (negative and null targets count as 0), w (weight), and the features, whose null values have a bin of their own. The loss is Tweedie's with a logarithmic
    link; leaves hold `least` rows at least. Models whose weighted targets sum up to 0 are left out. rows are read once; what the trees need is written to the shared folder.
    """
    rows = rows.select("m", F.greatest(F.coalesce(F.col("y").cast("double"), F.lit(0.0)), F.lit(0.0)).alias("y"), F.col("w").cast("double").alias("w"), *features)
    rows = cut(rows)
    cuts = edges(rows, features, bins)
    bases = rows.groupBy("m").agg(F.sum(F.col("w") * F.col("y")).alias("s"), F.sum("w").alias("n")).where("s > 0 and n > 0").select("m", F.log(F.col("s") / F.col("n")).alias("base"))
    bases = cut(bases)
    few = bases.count() <= FEW
    now = cut(joined(rows.selectExpr("m", "y", "w", f"{binned(features, cuts)} bins"), bases, few).withColumnRenamed("base", "margin"))
    g, h = gradients(power)
    none, grown_trees = held(bases.selectExpr("m", f"cast(map() as map<int, {SPLIT}>) splits"), few), []
    for _ in range(trees):
        grown = none
        for level in range(depth):
            at = joined(now, grown, few).selectExpr("m", f"{walked('splits', level)} s", f"{g} g", f"{h} h", "bins").where("s.open").selectExpr("m", "s.node", "g", "h", "bins")
            grown = held(joined(best_splits(at, penalty, least), grown, few, "right").selectExpr("m", "if(new is null, splits, map_concat(splits, new)) splits"), few)
        now = cut(joined(now, grown, few).selectExpr("m", "y", "w", "bins", f"margin + {rate!r}D * {walked('splits', depth)}.value margin"))
        grown_trees.append(grown)
    numbered = [t.selectExpr("m", f"{i} i", "splits") for i, t in enumerate(grown_trees)]
    forest = reduce(DataFrame.union, numbered[1:], numbered[0]).groupBy("m").agg(F.expr("transform(sort_array(collect_list(struct(i, map_entries(splits) splits))), t -> map_from_entries(t.splits)) trees"))  # as many as there are trees
    scaled = f"transform(trees, t -> transform_values(t, (k, s) -> named_struct('feature', s.feature, 'bin', s.bin, 'low', {rate!r}D * s.low, 'high', {rate!r}D * s.high)))"
    return held(bases.join(forest, "m").selectExpr("m", "base", f"cast({scaled} as array<map<int, {SPLIT}>>) trees"), few), cuts


def predict(rows: DataFrame, models: DataFrame, features: list[str], cuts: list[list[float]], depth: int = 3) -> DataFrame:
    """rows with prediction, null where their m has no model."""
    few = models.count() <= FEW
    trees = models.toDF("_m", "_base", "_trees")
    both = rows.selectExpr("*", f"{binned(features, cuts)} _bins").join(F.broadcast(trees) if few else trees, F.col("m") == F.col("_m"), "left")
    margin = f"aggregate(_trees, _base, (sum, tree) -> sum + {walked('tree', depth, '_bins')}.value)"
    return both.withColumn("prediction", F.expr(f"exp({margin})")).drop("_m", "_base", "_trees", "_bins")


def deviance(actual: Column, predicted: Column, power: float = 1.3) -> Column:
    """Tweedie's deviance of a forecast above 0, of a power between 1 and 2."""
    y, f = F.greatest(actual, F.lit(0.0)), F.greatest(predicted, F.lit(1e-9))
    return 2 * (F.pow(y, 2 - power) / ((1 - power) * (2 - power)) - y * F.pow(f, 1 - power) / (1 - power) + F.pow(f, 2 - power) / (2 - power))
