"""Quality rules: plain text statistics and a hashed n-gram log-likelihood ratio, in DataFrame functions only.

Words and pairs of words are hashed into buckets. Their counts over the trusted documents and over the whole corpus
give two smoothed multinomials. A document's score is the mean log ratio of the two over its n-grams; every document
whose score falls short of one threshold is dropped.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLANKS, cut, pick, semi, words

BUCKETS = 10_000
#: The threshold lies this many standard deviations below the trusted documents' mean score.
DEVIATIONS = 3.0
LEAST_WORDS = 20
#: Per cent of words in repeated windows that a document may have.
MOST_REPEATED = 30
SYMBOLS = "#*$%&|<>"


def hashes(docs: DataFrame, text: str) -> DataFrame:
    """Adds w1 and w2: hashes of the words and of the pairs that start at each word (the last has none after it)."""
    one = docs.withColumn("w1", F.transform(words(F.col(text)), lambda x: F.xxhash64(x)))
    return one.withColumn("w2", F.expr("transform(w1, (h, i) -> xxhash64(h, get(w1, i + 1)))"))


def grams() -> Column:
    """The hashes of a row's words and pairs."""
    return F.concat("w1", F.expr("slice(w2, 1, greatest(size(w2) - 1, 0))"))


def log_ratios(docs: DataFrame, trusted: DataFrame, buckets: int = BUCKETS, text: str = "text", doc_id: str = "doc_id") -> list[float]:
    """For each bucket the log of its smoothed share in the trusted documents over that in all.

    trusted: ids in a column doc_id; nulls and repetitions don't matter. Collects one number per bucket.
    """
    rows = pick(docs, doc_id, text).toDF("doc_id", "text")
    n = counts(rows, buckets)
    t = counts(semi(rows, "doc_id", trusted.select(doc_id).where(F.col(doc_id).isNotNull()).distinct()), buckets)
    return [math.log(a / sum_t) - math.log(b / sum_n) for sum_t, sum_n in [(sum(t), sum(n))] for a, b in zip(t, n, strict=True)]


def counts(rows: DataFrame, buckets: int) -> list[int]:
    """One more than the n-grams of the rows' texts in each bucket, straight off the scan."""
    each = hashes(rows.select("text"), "text").select(F.explode(grams()).alias("g"))
    out = [1] * buckets
    for r in each.groupBy(F.pmod("g", F.lit(buckets)).cast("int").alias("bucket")).agg(F.count("*").alias("n")).collect():
        out[r.bucket] += r.n
    return out


def statistics(docs: DataFrame, ratios: list[float], text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (long), score (double; 0 without words) of every whole text."""
    rows = hashes(pick(docs, doc_id, text).toDF("doc_id", "text"), "text")
    body = F.coalesce(F.col("text"), F.lit(""))
    rows = rows.withColumn("lines", F.filter(F.split(body, "\n", -1), lambda x: F.btrim(x, F.lit(BLANKS)) != ""))
    bare = F.length(F.translate(body, BLANKS, ""))
    rows = rows.select(
        "doc_id", "w1", "w2", F.size("w1").cast("long").alias("n_words"), bare.cast("long").alias("word_chars"),
        (F.length(body) - F.length(F.translate(body, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
    )
    table = F.split(F.lit(",".join(map(repr, ratios))), ",").cast("array<double>")
    total = F.aggregate(grams(), F.lit(0.0), lambda a, g: a + F.get(table, F.pmod(g, F.lit(len(ratios))).cast("int")))
    rows = rows.withColumn("score", F.coalesce(F.try_divide(total, F.size(grams())), F.lit(0.0)))
    # Hashes of 8 words in a row, by doubling; equal ones are sorted next to each other only where there are any.
    rows = rows.drop("w1").withColumn("w4", F.expr("transform(w2, (h, i) -> xxhash64(h, get(w2, i + 2)))")).drop("w2")
    rows = rows.withColumn("w8", F.expr("transform(slice(w4, 1, greatest(size(w4) - 7, 0)), (h, i) -> xxhash64(h, get(w4, i + 4)))")).drop("w4")
    rows = rows.withColumn("ranked", F.expr("if(size(array_distinct(w8)) < size(w8), array_sort(transform(w8, (h, i) -> struct(h, i))), array())")).drop("w8")
    rows = rows.withColumn("twice", F.expr("array_sort(transform(filter(transform(ranked, (x, k) -> struct(x.i as i, coalesce(get(ranked, k - 1).h = x.h, false) or coalesce(get(ranked, k + 1).h = x.h, false) as hit)), x -> x.hit), x -> x.i))")).drop("ranked")
    covered = F.expr("aggregate(transform(twice, (p, k) -> least(8, p - coalesce(get(twice, k - 1), p - 8))), 0L, (a, x) -> a + x)")
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", covered.alias("n_repeat_words"), "score")


def assess(docs: DataFrame, trusted: DataFrame, threshold: float | None = None, buckets: int = BUCKETS, deviations: float = DEVIATIONS, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """statistics() with threshold, base_failed and kept, one row per row of docs.

    threshold: None puts it `deviations` standard deviations below the mean score of trusted documents that pass the base
    rules; without such documents everything passes it. Null and blank texts have no words and fail the base
    rules, as texts of fewer than LEAST_WORDS do. Repeated rows each get their row; further columns are ignored; an
    empty table gives an empty result.
    """
    found = cut(statistics(docs, log_ratios(docs, trusted, buckets, text, doc_id), text, doc_id))
    found = found.withColumn("base_failed", (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")))
    if threshold is None:
        ids = trusted.select(F.col(doc_id).alias("doc_id")).where("doc_id is not null").distinct()
        mean, sd = found.where("not base_failed").join(ids, "doc_id", "left_semi").agg(F.avg("score"), F.stddev_pop("score")).first()
        threshold = -math.inf if mean is None else round(mean - deviations * sd, 6)
    return found.withColumn("threshold", F.lit(float(threshold))).withColumn("kept", ~F.col("base_failed") & (F.col("score") >= F.lit(float(threshold))))
