"""Segments of keys: features, scaling, clusters, merging, profiles, allocation of model levels. Key tables have one row per key."""

from __future__ import annotations

import math

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import BisectingKMeans, GaussianMixture, KMeans, KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import MinMaxScaler, RobustScaler, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from demandloom.operators import ranks
from demandloom.operators.profile import demand_class


def segmentation_features(keys: DataFrame) -> DataFrame:
    """Adds to keys (total, adi, cv2, zero_fraction, n): tier by the 30 and 70 percentiles, intermittency, forecastability, stability (1 / (1 + cv)), complexity (the mean of intermittency and of the spread's share 1 - stability), pattern, stage."""
    score = 0.5 * F.col("zero_fraction") + 0.3 * F.least(F.col("adi") / 10, F.lit(1.0)) + 0.2 * F.least(F.coalesce("cv2", F.lit(0.0)) / 2, F.lit(1.0))
    out = ranks.with_quantiles(keys, "total", [0.3, 0.7], ["_lo", "_hi"]).withColumn("tier", F.when(F.col("total") <= F.col("_lo"), "low").when(F.col("total") <= F.col("_hi"), "medium").otherwise("high")).drop("_lo", "_hi")
    out = out.withColumn("intermittency", score).withColumn("forecastability", 1 - F.col("intermittency"))
    out = out.withColumn("stability", 1 / (1 + F.sqrt(F.coalesce("cv2", F.lit(0.0))))).withColumn("complexity", (F.col("intermittency") + 1 - F.col("stability")) / 2)
    return out.withColumn("pattern", demand_class(F.col("adi"), F.coalesce("cv2", F.lit(0.0)))).withColumn("stage", F.when(F.col("n") < 13, "new").when(F.col("n") < 52, "growing").otherwise("mature"))


def scaled(keys: DataFrame, columns: list[str], kind: str = "standard") -> DataFrame:
    """Adds `scaled`, a vector; missing values count as 0 before scaling."""
    scaler = {"standard": lambda: StandardScaler(withMean=True, withStd=True), "robust": lambda: RobustScaler(withCentering=True), "minmax": MinMaxScaler}[kind]().setInputCol("_v").setOutputCol("scaled")
    rows = VectorAssembler(inputCols=columns, outputCol="_v").transform(keys.fillna(0.0, columns))
    return scaler.fit(rows).transform(rows).drop("_v")


def with_scaled_columns(rows: DataFrame, columns: list[str]) -> DataFrame:
    """The vector's parts as z_<column>."""
    parts = vector_to_array("scaled")
    return rows.withColumns({f"z_{c}": parts[i] for i, c in enumerate(columns)}).drop("scaled")


def best_kmeans(rows: DataFrame, ks: list[int], seed: int = 1) -> KMeansModel:
    """The k of the best silhouette."""
    judge = ClusteringEvaluator(featuresCol="scaled", predictionCol="cluster")
    fits = [KMeans(k=k, seed=seed, featuresCol="scaled", predictionCol="cluster", maxIter=20).fit(rows) for k in ks]
    return max(fits, key=lambda m: judge.evaluate(m.transform(rows)))


def clustered(rows: DataFrame, method: str = "kmeans", ks: list[int] | None = None, seed: int = 1) -> DataFrame:
    """Adds cluster by k-means (k by silhouette), gaussian mixture (k by BIC) or bisecting k-means."""
    ks = ks or [2, 3, 4]
    if method == "kmeans":
        return best_kmeans(rows, ks, seed).transform(rows)
    if method == "bisecting":
        # Splits start from the centre times a little more or less, so a centre of nought, which scaling gives, would never split.
        moved = VectorAssembler(inputCols=["scaled", "_one"], outputCol="_moved").transform(rows.withColumn("_one", F.lit(1.0)))
        return BisectingKMeans(k=ks[-1], seed=seed, featuresCol="_moved", predictionCol="cluster").fit(moved).transform(moved).drop("_moved", "_one")
    n, d = rows.count(), len(rows.select("scaled").first()["scaled"])
    fits = [GaussianMixture(k=k, seed=seed, featuresCol="scaled", predictionCol="cluster", probabilityCol="_p").fit(rows) for k in ks]
    bic = lambda m, k: (k * (1 + d + d * (d + 1) / 2) - 1) * math.log(n) - 2 * m.summary.logLikelihood
    return min(zip(fits, ks, strict=True), key=lambda x: bic(*x))[0].transform(rows).drop("_p")


def merge_small(rows: DataFrame, columns: list[str], share: float = 0.1, cap: int = 80, segment: str = "cluster", least: int = 2) -> DataFrame:
    """segment_id: segments smaller than the lesser of share and cap go to the large one with the nearest centre; numbered from 0 by size. Few segments, of which the `least` largest stay in any case."""
    centres = rows.groupBy(segment).agg(F.count("*").alias("n"), *[F.avg(c).alias(c) for c in columns])
    total = centres.agg(F.sum("n").alias("_t"))
    sized = centres.join(F.broadcast(total), F.lit(True)).withColumn("_small", (F.col("n") < F.least(F.lit(float(cap)), share * F.col("_t"))) & (F.row_number().over(W.orderBy(F.desc("n"), segment)) > least))
    large = sized.where("not _small").select(F.col(segment).alias("_to"), F.col("n").alias("_n"), *[F.col(c).alias(f"_{c}") for c in columns])
    far = sum(((F.col(c) - F.col(f"_{c}")) ** 2 for c in columns[1:]), (F.col(columns[0]) - F.col(f"_{columns[0]}")) ** 2)
    goal = sized.join(F.broadcast(large), F.col("_small") | (F.col(segment) == F.col("_to")), "left").groupBy(segment).agg(F.coalesce(F.min_by("_to", F.struct(far, F.col("_to"))), F.first(segment)).alias("_goal"))
    merged = rows.join(F.broadcast(goal), segment)
    order = merged.groupBy("_goal").agg(F.count("*").alias("_m")).withColumn("segment_id", F.row_number().over(W.orderBy(F.desc("_m"), "_goal")) - 1)
    return merged.join(F.broadcast(order), "_goal").drop("_goal", "_m")


def hybrid_segments(keys: DataFrame, least: int, cluster: str = "cluster") -> DataFrame:
    """segment: cluster, tier and pattern; small ones join the largest segment of the same family of patterns, or the largest of all."""
    family = F.when(F.col("pattern").isin("smooth", "erratic"), "regular").otherwise("sparse")
    rows = keys.withColumn("_s", F.concat_ws("|", F.col(cluster).cast("string"), "tier", "pattern")).withColumn("_f", family)
    counts = rows.groupBy("_s", "_f").agg(F.count("*").alias("_n"))
    best = counts.groupBy("_f").agg(F.max(F.struct("_n", "_s")).alias("_b"))
    overall = counts.agg(F.max(F.struct("_n", "_s")).alias("_o"))
    goal = counts.join(best, "_f").join(F.broadcast(overall), F.lit(True)).select("_s", F.when(F.col("_n") >= least, F.col("_s")).when(F.col("_b._n") >= least, F.col("_b._s")).otherwise(F.col("_o._s")).alias("segment"))
    return rows.join(F.broadcast(goal), "_s").drop("_s", "_f")


def profiles(keys: DataFrame, columns: list[str], segment: str = "segment") -> DataFrame:
    """Per segment: n, share, relative index of each column (clipped at 10), most frequent pattern and tier."""
    overall = keys.agg(F.count("*").alias("_t"), *[F.avg(c).alias(f"_{c}") for c in columns])  # one row
    own = keys.groupBy(segment).agg(F.count("*").alias("n"), F.mode("pattern", deterministic=True).alias("pattern"), F.mode("tier", deterministic=True).alias("tier"), *[F.avg(c).alias(c) for c in columns])
    index = {f"index_{c}": F.greatest(F.lit(-10.0), F.least(F.lit(10.0), F.col(c) / F.when(F.col(f"_{c}") != 0, F.col(f"_{c}")))) for c in columns}
    return own.join(F.broadcast(overall), F.lit(True)).withColumn("share", F.col("n") / F.col("_t")).withColumns(index).select(segment, "n", "share", "pattern", "tier", *index)


def fit_assigner(manifest: DataFrame, columns: list[str], k: int = 3, seed: int = 1) -> tuple[PipelineModel, DataFrame]:
    """Scaler and clusters of the manifest (which has segment) as one model, which MLlib can store, and cluster, assigned: the segment that most keys of a cluster have."""
    stages = [VectorAssembler(inputCols=columns, outputCol="_v"), StandardScaler(withMean=True, withStd=True, inputCol="_v", outputCol="_z"), KMeans(k=k, seed=seed, featuresCol="_z", predictionCol="cluster")]
    rows = manifest.fillna(0.0, columns)
    model = Pipeline(stages=stages).fit(rows)
    return model, model.transform(rows).groupBy("cluster").agg(F.mode("segment", deterministic=True).alias("assigned"))


def assign(model: PipelineModel, votes: DataFrame, new: DataFrame, columns: list[str], valid: list[str] | None = None) -> DataFrame:
    """key, segment of new keys by the stored model; a segment that isn't valid gives way to the commonest valid one of the votes. Few clusters."""
    named = votes
    if valid is not None:
        most = votes.where(F.col("assigned").isin(valid)).agg(F.mode("assigned", deterministic=True).alias("_most"))
        named = votes.join(F.broadcast(most), F.lit(True)).withColumn("assigned", F.when(F.col("assigned").isin(valid), F.col("assigned")).otherwise(F.coalesce("_most", F.lit(min(valid))))).drop("_most")
    return model.transform(new.fillna(0.0, columns)).join(F.broadcast(named), "cluster", "left").select("key", F.col("assigned").alias("segment"))


def assign_new(manifest: DataFrame, new: DataFrame, columns: list[str], k: int = 3, seed: int = 1) -> DataFrame:
    """new with the segment that most keys of its nearest cluster have; scaler and clusters are fitted on the manifest alone."""
    model, votes = fit_assigner(manifest, columns, k, seed)
    return assign(model, votes, new, columns)


def updated_manifest(manifest: DataFrame, assigned: DataFrame) -> DataFrame:
    """The manifest and those assigned keys that it hasn't."""
    return manifest.unionByName(assigned.join(manifest.select("key"), "key", "left_anti"), allowMissingColumns=True)


def model_levels(
    keys: DataFrame, least_score: float = 0.6, most_share: float = 0.3, volume_quantile: float = 0.9, least_obs: int = 52, least_sold: int = 20, most_zero: float = 0.7, override: float | None = None, least_segment: int = 0
) -> DataFrame:
    """level: individual for keys of a good score or top volume that pass the gates, at most a share of all, else segment.

    Under the cap top volume comes first, then keys whose forecastability reaches `override` (if given; they pass without a good score),
    then the best scores; of equal scores those of the least key hash. Top volume and overrides stay even beyond the cap. Keys of a segment (column) that
    would keep fewer than least_segment others stay with it; those of top volume and overrides go in any case.
    """
    rows = ranks.with_quantiles(keys, "total", [volume_quantile], ["_e"])
    room = math.floor(most_share * keys.count())
    top = F.col("total") >= F.col("_e")
    gates = (F.col("n") >= least_obs) & (F.col("n_sold") >= least_sold) & (F.col("zero_fraction") <= most_zero)
    over = F.lit(False) if override is None else F.col("forecastability") >= override
    rows = rows.withColumn("_kept", (top & (F.col("n") >= least_obs)) | (over & gates)).withColumn("_ok", F.col("_kept") | ((F.col("forecastability") >= least_score) & gates))
    # One score that puts overrides before all others: the cap is then a cut in one order.
    ranked = rows.where("_ok").withColumn("_score", F.when(F.col("_kept"), F.lit(1e9)).otherwise(F.col("forecastability")))
    chosen = ranked.where("_kept").select("key").union(ranks.first_by_score(ranked, "_score", room).select("key")).distinct()
    if least_segment:
        given = keys.select("key", "segment").join(chosen.withColumn("_c", F.lit(True)), "key", "left")
        left = given.groupBy("segment").agg(F.count_if(F.col("_c").isNull()).alias("_left")).where(F.col("_left") < least_segment).select("segment")
        small = given.where("_c").join(left, "segment", "left_semi").select("key")
        chosen = chosen.join(small.join(rows.where("_kept").select("key"), "key", "left_anti"), "key", "left_anti")
    return keys.join(chosen.withColumn("level", F.lit("individual")), "key", "left").fillna("segment", ["level"])


def relative_to_segment(keys: DataFrame, column: str, segment: str = "segment") -> DataFrame:
    """z and ratio of a key's measure against its segment."""
    w = W.partitionBy(segment)
    mean, sd = F.avg(column).over(w), F.stddev_samp(column).over(w)
    return keys.withColumn("z", (F.col(column) - mean) / F.when(sd > 0, sd)).withColumn("ratio", F.col(column) / F.when(mean != 0, mean))


def recommended(profile: DataFrame, rules: DataFrame) -> DataFrame:
    """profile with models and loss of the rule for its pattern and tier (the tier `any` stands for all); few rules."""
    own = rules.where("tier <> 'any'").select("pattern", "tier", F.col("models").alias("_m"), F.col("loss").alias("_l"))
    rest = rules.where("tier = 'any'").select("pattern", "models", "loss")
    out = profile.join(F.broadcast(rest), "pattern", "left").join(F.broadcast(own), ["pattern", "tier"], "left")
    return out.withColumn("models", F.coalesce("_m", "models")).withColumn("loss", F.coalesce("_l", "loss")).drop("_m", "_l")


def hierarchy_pairs(df: DataFrame, columns: list[str], key: str = "key") -> DataFrame:
    """child, parent: pairs of columns where each value of child has one value of parent and there are fewer parents; in one aggregation."""
    seen = df.agg(*[F.count_distinct(c).alias(f"n_{c}") for c in columns], *[F.count_distinct(F.struct(a, b)).alias(f"n_{a}__{b}") for a in columns for b in columns if a != b])
    rows = [F.struct(F.lit(a).alias("child"), F.lit(b).alias("parent"), ((F.col(f"n_{a}__{b}") == F.col(f"n_{a}")) & (F.col(f"n_{b}") < F.col(f"n_{a}")) & (F.col(f"n_{b}") > 1)).alias("nested")) for a in columns for b in columns if a != b]
    return seen.select(F.explode(F.array(*rows)).alias("r")).select("r.*").where("nested").drop("nested")


def grouping_columns(df: DataFrame, columns: list[str], key: str = "key", least: int = 2, most: int = 1000, coverage: float = 0.9) -> DataFrame:
    """column, n_values, covered, accepted, alike: which columns can group keys, in two aggregations.

    accepted: a number of values within bounds, given for enough rows, one value a key. alike: the first accepted column before it that cuts the keys
    the same way (both determine each other), else null.
    """
    pairs = [(a, b) for i, b in enumerate(columns) for a in columns[:i]]
    seen = df.agg(F.count("*").alias("_n"), *[f for c in columns for f in (F.count_distinct(c).alias(f"v_{c}"), F.count(c).alias(f"c_{c}"))], *[F.count_distinct(a, b).alias(f"p_{a}__{b}") for a, b in pairs])
    own = df.groupBy(key).agg(*[F.count_distinct(c).alias(c) for c in columns]).agg(*[F.max(c).alias(f"k_{c}") for c in columns])
    both = seen.join(F.broadcast(own), F.lit(True))  # one row on either side
    fits = {c: F.col(f"v_{c}").between(least, most) & (F.col(f"c_{c}") >= coverage * F.col("_n")) & (F.col(f"k_{c}") <= 1) for c in columns}
    same = {b: [F.when(fits[a] & fits[b] & (F.col(f"p_{a}__{b}") == F.col(f"v_{a}")) & (F.col(f"v_{a}") == F.col(f"v_{b}")), F.lit(a)) for a in columns[:i]] for i, b in enumerate(columns)}
    out = [F.struct(F.lit(c).alias("column"), F.col(f"v_{c}").alias("n_values"), F.try_divide(F.col(f"c_{c}"), F.col("_n")).alias("covered"), fits[c].alias("accepted"), (F.coalesce(*same[c]) if same[c] else F.lit(None).cast("string")).alias("alike")) for c in columns]
    return both.select(F.explode(F.array(*out)).alias("r")).select("r.*")
