"""Mixing sources to target weights by Poisson replication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import FEW, cut, pick, plain

#: Rates above this are split into equal parts, whose counts add up: a sum of Poisson numbers is one.
PART = 16
#: Counts of one part at most; beyond it lies less than 2**-60 of a Poisson of rate PART.
MOST = 80
SEED = "mix"


def uniform(*parts: Column | str) -> Column:
    """A number from [0, 1) out of the first 52 bits of the MD5 of the parts, joined by colons."""
    return number(*parts, digits=13) / F.lit(float(1 << 52))


def number(*parts: Column | str, digits: int = 15) -> Column:
    joined = F.concat_ws(":", *[F.coalesce((F.col(p) if isinstance(p, str) else p).cast("string"), F.lit("null")) for p in parts])
    return F.conv(F.substring(F.md5(joined), 1, digits), 16, 10).cast("long")


def cumulative(rate: Column) -> Column:
    """The cumulative probabilities of 0, 1, ... MOST - 1 under a Poisson distribution of a rate up to PART, as an array."""
    start = F.struct(F.exp(-rate).alias("p"), F.array(F.exp(-rate)).alias("c"))

    def step(s: Column, i: Column) -> Column:
        p = s["p"] * rate / i
        return F.struct(p.alias("p"), F.concat(s["c"], F.array(F.element_at(s["c"], -1) + p)).alias("c"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(MOST - 1)), start, step, lambda s: s["c"])


def poisson(cdf: Column, u: Column) -> Column:
    """The smallest k whose cumulative probability exceeds u: the number of those that don't."""
    return F.size(F.filter(cdf, lambda c: c <= u))


def temperature_weights(docs: DataFrame, exponent: float = 0.5, source: str = "source") -> DataFrame:
    """Target weights in proportion to a power of each source's number of rows: source, weight. Null is a source."""
    return pick(docs, source).toDF("source").groupBy("source").agg(F.pow(F.count("*"), F.lit(exponent)).alias("weight"))


def rates(docs: DataFrame, weights: DataFrame, total: int | None = None, source: str = "source") -> DataFrame:
    """source, rate: how often each row of a source is repeated in the mean, so that sources make up their weights of `total` rows (those of docs if None).

    Weights need not sum to one; null or negative ones count as zero. A source that has no weight gets rate zero.
    """
    n = pick(docs, source).toDF("source").groupBy("source").agg(F.count("*").alias("n"))
    given = weights.select("source", F.greatest(F.coalesce(F.col("weight").cast("double"), F.lit(0.0)), F.lit(0.0)).alias("weight")).groupBy("source").agg(F.sum("weight").alias("weight"))
    both = n.join(given.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")), "left").select("source", "n", F.coalesce("weight", F.lit(0.0)).alias("weight"))
    sums = both.agg(F.sum("weight").alias("weights"), F.sum("n").alias("rows"))  # one row
    rows = F.col("rows") if total is None else F.lit(total)
    return both.join(F.broadcast(sums), F.lit(True)).select("source", F.coalesce(F.try_divide(rows * F.col("weight"), F.col("weights") * F.col("n")), F.lit(0.0)).alias("rate"))


def tables(known: DataFrame) -> DataFrame:
    """source, parts, cdf from source and rate: the parts that a rate is split into, and what inverts the distribution of one."""
    parts = F.greatest(F.ceil(F.col("rate") / PART), F.lit(1)).cast("int")
    rated = known.withColumn("parts", parts).withColumn("cdf", cumulative(F.col("rate") / F.col("parts")))
    # No u lies between the last numbers below one: the rest of the table would never count.
    return rated.select("source", "parts", F.filter("cdf", lambda c: c <= F.lit(1 - 2.0**-52)).alias("cdf"))


#: Parts of a source's rows where there are too many sources to broadcast.
SALTS = 32


def mix(docs: DataFrame, weights: DataFrame, total: int | None = None, seed: str = SEED, source: str = "source", doc_id: str = "doc_id") -> DataFrame:
    """docs with each row repeated by a Poisson number of its source's rate, in a global random order.

    The number inverts the Poisson distribution at a hash of seed and doc_id, so that it is the same in every run and for
    equal ids. Adds copy (int, from 0), n_copies (int) and order_key (long): partitions hold ranges of order_key, in order. Null ids
    hash like the word null; null sources are a source. Columns of the added names are replaced. Sources are counted before their
    table is broadcast; beyond FEW of them it is joined by source and a salt.
    """
    names = [c for c in docs.columns if c not in ("copy", "n_copies", "order_key")]
    own = [f"c{i}" for i in range(len(names))]
    flat = pick(docs, *names).toDF(*own)
    ident, from_ = own[names.index(doc_id)], own[names.index(source)]
    known = cut(tables(rates(docs, weights, total, source))).withColumnRenamed("source", "s")
    if known.count() <= FEW:
        rated = flat.join(F.broadcast(known), F.col(from_).eqNullSafe(F.col("s")))
    else:
        salted = known.withColumn("z", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        rated = flat.withColumn("salt", F.pmod(F.xxhash64(*plain(flat)), F.lit(SALTS)).cast("int")).join(salted, F.col(from_).eqNullSafe(F.col("s")) & (F.col("salt") == F.col("z")))
    each = lambda i: poisson(F.col("cdf"), uniform(F.lit(seed), F.col(ident), i))
    n = F.aggregate(F.transform(F.sequence(F.lit(1), F.col("parts")), each), F.lit(0), lambda a, b: a + b)
    counted = rated.select(*own, n.alias("n_copies"))
    copies = counted.where("n_copies > 0").select(*own, F.explode(F.sequence(F.lit(0), F.col("n_copies") - 1)).alias("copy"), "n_copies")
    keyed = copies.withColumn("order_key", number(F.lit(seed), F.col(ident), F.lit("copy"), F.col("copy")))
    # The hash of the row spreads rows that share an id.
    order = ["order_key", ident, "copy", F.xxhash64(*plain(flat))]
    return keyed.repartitionByRange(*order).sortWithinPartitions(*order).toDF(*names, "copy", "n_copies", "order_key")
