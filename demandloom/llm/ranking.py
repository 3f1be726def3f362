"""A quality score by pairwise ranking (Bradley-Terry).

Of two labelled documents the better one wins with a probability that is the logistic function of the difference of their scores.
Scores are linear in a text's hashed terms and in bins of a few of its proportions, so the weights follow from a logistic loss on the differences of
features over many pairs. How strongly weights are held down is chosen by pairs of rows that a model hasn't seen.

Documents are then told apart at a quantile of the scores of all labelled documents: as many of them lie below it as are labelled bad.

The weights are fitted on a bounded sample of labelled documents, one task for each fit; scoring reads every whole text, in parallel.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut, pick, sliced, tidied
from .toxicity import FEATURES, LEAST_DOCS, Terms, probability, run_starts

#: Labelled documents that a fit takes at most: those whose ids hash lowest.
MOST_LABELLED = 6_000
FOLDS = 3
#: Of these penalties of the weights that of the least loss of unseen pairs is taken.
PENALTIES = (1e-4, 1e-3, 1e-2)
#: Pairs that a document of the larger class takes part in.
MEETS = 16
STEPS, RATE = 150, 0.05
#: Documents with this score or more are good; the quantile is put there.
GOOD = 0.7
#: Bins of a proportion.
BINS = 20
#: Texts that are scored together.
TOGETHER = 1000
SEED = 42


def proportions(text: str) -> list[float]:
    """Numbers from 0 to 1: different words, words in repeated lines, words of letters only, capitals, signs, length of words, of text and of lines."""
    words = text.split()
    if not words:
        return []
    lines = [x for x in text.split("\n") if x.strip()]
    letters = sum(map(str.isalpha, text))
    solid = sum(map(len, words))
    return [
        len(set(words)) / len(words),
        1 - len(set(lines)) / len(lines),
        sum(map(str.isalpha, words)) / len(words),
        sum(map(str.isupper, text)) / max(1, letters),
        1 - letters / solid,
        min(1.0, solid / len(words) / 20),
        min(1.0, math.log2(1 + len(words)) / 20),
        min(1.0, math.log2(1 + len(words) / len(lines)) / 20),
    ]


def features(text: str | None, terms: Terms) -> np.ndarray:
    """Buckets of a text's terms and of its proportions' bins, ascending; null, empty and blank texts have the one that says so."""
    shown = proportions(text) if text else []
    names = [f"#{i}:{int(x * BINS)}" for i, x in enumerate(shown)] or ["#none"]
    return np.unique(np.r_[terms.of(text), [xxhash.xxh32_intdigest(n) % FEATURES for n in names]].astype(np.int64))


def paired(y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Winners and losers: each row of the larger class meets MEETS of the other, which take turns in a fixed random order."""
    good, bad = np.flatnonzero(y > 0), np.flatnonzero(y == 0)
    if not len(good) or not len(bad):
        return np.empty(0, np.intp), np.empty(0, np.intp)
    more, less = (good, bad) if len(good) >= len(bad) else (bad, good)
    mixed = np.random.default_rng(SEED).permutation(less)
    a, b = np.repeat(more, MEETS), mixed[np.arange(len(more) * MEETS) % len(less)]
    return (a, b) if len(good) >= len(bad) else (b, a)


def fit(flat: np.ndarray, ends: np.ndarray, y: np.ndarray, penalty: float) -> np.ndarray:
    """Weights of the features by the pairs' logistic loss, full-batch Adam; nought with one class only. flat: buckets of all rows; ends: how many each row has."""
    out = np.zeros(FEATURES)
    win, lose = paired(y)
    if not len(win):
        return out
    keep = (np.bincount(flat, minlength=FEATURES) >= LEAST_DOCS)[flat]
    row = np.repeat(np.arange(len(y)), ends)[keep]
    columns, at = np.unique(flat[keep], return_inverse=True)
    if not len(columns):
        return out
    by_column = np.argsort(at, kind="stable")
    row_of, column_starts, row_starts = row[by_column], run_starts(at[by_column]), run_starts(row)
    rows = row[row_starts]
    w = np.zeros(len(columns))
    m, v = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, STEPS + 1):
        s = np.zeros(len(y))
        s[rows] = np.add.reduceat(w[at], row_starts)
        miss = probability(s[lose] - s[win]) / len(win)
        error = np.bincount(lose, miss, len(y)) - np.bincount(win, miss, len(y))
        grad = np.add.reduceat(error[row_of], column_starts) + penalty * w
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        w -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    out[columns] = w
    return out


def scores(weights: np.ndarray, flat: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return np.bincount(np.repeat(np.arange(len(ends)), ends), weights=weights[flat], minlength=len(ends))


def loss(s: np.ndarray, y: np.ndarray) -> float:
    win, lose = paired(y)
    return float(np.logaddexp(0.0, s[lose] - s[win]).mean()) if len(win) else 0.0


def known_labels(labels: DataFrame, label: str = "quality", doc_id: str = "doc_id") -> DataFrame:
    """id, y: null labels and ids don't count, of several labels of an id the largest does."""
    return pick(labels, doc_id, label).toDF("id", "y").groupBy("id").agg(F.max("y").cast("double").alias("y")).where("id is not null and y is not null")


def fit_ranking(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELLED, folds: int = FOLDS) -> tuple[np.ndarray, DataFrame]:
    """Weights, and id and raw (a score by weights that haven't seen the row) of the fitted documents (doc_id, text), which `most` rows of known_labels() at most name.

    Of several texts of an id the least counts. Each fold under each penalty is fitted in a task of its own. Without rows of both classes all weights are nought.
    """
    id_type = dict(labels.dtypes)["id"]
    drawn = cut(labels.orderBy(F.xxhash64("id"), "id").limit(most))  # broadcast: `most` rows of two numbers at most
    rows = docs.join(F.broadcast(drawn), F.col("doc_id") == F.col("id")).groupBy("id", "y").agg(F.min("text").alias("text"))

    def buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = Terms()
        for b in batches:
            found = [features(t, terms).astype(np.int32) for t in b.column("text").to_pylist()]
            fold = [xxhash.xxh32_intdigest(str(i)) % folds for i in b.column("id").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("y"), pa.array(fold, pa.int32()), pa.array(found, pa.list_(pa.int32()))], ["id", "y", "fold", "buckets"])

    sample = cut(rows.mapInArrow(tidied(buckets), f"id {id_type}, y double, fold int, buckets array<int>"))

    def arrays(t: pa.Table) -> tuple:
        t = t.sort_by("id")
        lists = t.column("buckets").combine_chunks()
        return t, lists.flatten().to_numpy(), np.asarray(lists.value_lengths()), t.column("y").to_numpy()

    def held_out(t: pa.Table) -> pa.Table:
        job = t.column("job")[0].as_py()
        penalty, fold = PENALTIES[job // folds], job % folds
        t, flat, ends, y = arrays(t)
        out = t.column("fold").to_numpy() == fold
        owner = np.repeat(out, ends)
        s = scores(fit(flat[~owner], ends[~out], y[~out], penalty), flat[owner], ends[out])
        return pa.table([pa.array([job // folds] * len(s), pa.int32()), t.column("id").filter(pa.array(out)), pa.array(y[out]), pa.array(s)], ["penalty", "id", "y", "raw"])

    jobs = sample.withColumn("job", F.explode(F.sequence(F.lit(0), F.lit(len(PENALTIES) * folds - 1))))
    unseen = cut(jobs.groupBy("job").applyInArrow(held_out, f"penalty int, id {id_type}, y double, raw double"))

    def judged(t: pa.Table) -> pa.Table:
        t = t.sort_by("id")
        return pa.table([pa.array([t.column("penalty")[0].as_py()], pa.int32()), pa.array([loss(t.column("raw").to_numpy(), t.column("y").to_numpy())])], ["penalty", "loss"])

    losses = unseen.groupBy("penalty").applyInArrow(judged, "penalty int, loss double").collect()  # a number a penalty
    best = min(losses, key=lambda r: (r.loss, r.penalty)).penalty if losses else 0

    def whole(t: pa.Table) -> pa.Table:
        _, flat, ends, y = arrays(t)
        return pa.table([pa.array([fit(flat, ends, y, PENALTIES[best]).tobytes()], pa.binary())], ["weights"])

    made = sample.withColumn("job", F.lit(0)).groupBy("job").applyInArrow(whole, "weights binary").collect()  # `most` rows, one row of FEATURES numbers
    return np.frombuffer(made[0].weights) if made else np.zeros(FEATURES), unseen.where(F.col("penalty") == best).select("id", "raw")


def raw_scores(docs: DataFrame, weights: np.ndarray, text: str = "text") -> DataFrame:
    """docs (columns of names of their own) with raw (double) in place of the text."""
    sent = docs.sparkSession.sparkContext.broadcast(weights)
    others = [c for c in docs.columns if c != text]
    schema = T.StructType([*[docs.schema[c] for c in others], T.StructField("raw", T.DoubleType())])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = Terms()
        for b in sliced(batches, TOGETHER):
            found = [features(t, terms) for t in b.column(text).to_pylist()]
            s = scores(sent.value, np.concatenate(found), np.array([len(x) for x in found])) if found else np.empty(0)
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in others], pa.array(s)], schema.names)

    return docs.select(*others, text).mapInArrow(tidied(each), schema)


def edge(known: DataFrame) -> float:
    """The score between bad and good documents, of known (y, raw): their quantile at the share of bad ones, half way between its two neighbours.

    The quantile's rank is found by halving a range of scores until it holds few values: each round is one sum. With one class only, everything is good or everything bad.
    """
    n, bad, lo, hi = known.agg(F.count("*"), F.count_if(F.col("y") == 0), F.min("raw"), F.max("raw")).first()
    if not bad or bad == n:
        return -math.inf if not bad else math.inf
    ends = []
    for rank in (bad - 1, bad):
        a, b, below = lo, hi, 0  # the value of this rank is from a to b; `below` values are less than a
        while a < b:
            cuts = sorted({a + (b - a) * k / 64 for k in range(64)} | {b})
            inside = known.where(F.col("raw").between(a, b))
            each = inside.groupBy(sum((F.when(F.col("raw") > c, 1).otherwise(0) for c in cuts), F.lit(0)).alias("k")).agg(F.count("*").alias("m"), F.min("raw").alias("least"), F.max("raw").alias("most"))
            for part in sorted(each.collect()):  # 65 rows at most
                if rank < below + part.m:
                    a, b = part.least, part.most
                    break
                below += part.m
        ends.append(a)
    return sum(ends) / 2


def assess(docs: DataFrame, labels: DataFrame, held_out: Column, most: int = MOST_LABELLED) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of docs. held_out: a condition on doc_id (never null), of rows whose labels are not learned from.

    score: logistic function of the Bradley-Terry score less the edge, shifted so that the edge is at GOOD; predicted: 1 from GOOD on. Null and empty texts are scored like any
    other; rows of a null id are scored and never learned from. Without labels of both classes all documents are good, or bad if only bad ones are known. Repeated rows
    stay; empty tables give an empty result; further columns, of any name, are passed over.
    """
    own = pick(docs, "doc_id", "text")
    truth = cut(known_labels(pick(labels, "doc_id", "quality").where(~held_out)))
    weights, unseen = fit_ranking(own, truth, most)
    raw = cut(raw_scores(own, weights))
    # All labelled rows count for the edge, those of the fit by the score of weights that haven't seen them.
    by_all = raw.groupBy("doc_id").agg(F.max("raw").alias("own"))
    known = cut(truth.join(by_all, F.col("id") == F.col("doc_id")).join(unseen.withColumnRenamed("id", "seen"), F.col("id") == F.col("seen"), "left").select("y", F.coalesce("raw", "own").alias("raw")))
    at = edge(known)
    shift = math.log(GOOD / (1 - GOOD))
    score = F.lit(0.0) if at == math.inf else F.lit(1.0) if at == -math.inf else 1 / (1 + F.exp(F.lit(at - shift) - F.col("raw")))
    return raw.select("doc_id", held_out.alias("held_out"), score.alias("score")).withColumn("predicted", (F.col("score") >= GOOD).cast("int"))
