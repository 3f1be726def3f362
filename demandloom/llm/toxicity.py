"""Toxicity by a chain of linear classifiers.

The categories are predicted one after another. Each one's logistic regression sees the hashed terms of a text and the
probabilities of the categories before it. In training these probabilities are out-of-fold, from models that haven't seen
the row, so that later models meet them as they will be in use.

The models are fitted on a bounded sample of labelled documents, in one task; scoring reads every whole text, in parallel.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import pick, sliced, tidied

#: Labelled documents that the models are fitted on at most: those whose ids hash lowest.
MOST_LABELLED = 6_000
FEATURES = 1 << 17
FOLDS = 3
THRESHOLD = 0.35
#: The categories of `labels` in the order of the chain, and what stands for each.
CATEGORIES = (("junk", "1 - quality"), ("toxic", "toxic"))
TARGET = "toxic"
STEPS, RATE = 150, 0.03
#: Of these penalties of the terms' weights a category takes the one of the least out-of-fold loss: it holds rare terms down.
PENALTIES = (1e-3, 3e-3, 1e-2)
#: A term counts if it occurs in so many labelled documents, however many there are.
LEAST_DOCS = 3
#: Terms: lower-case runs of letters and digits, and runs of other signs; and the beginnings, of these lengths, of longer ones.
PREFIXES = (4, 5, 6)
TERM = re.compile(r"[^\W_]+|[^\w\s]+|_+")
REMEMBERED = 300_000
#: Of a long list of numbers, those that are looked up at once.
TAKEN = 1 << 18
#: Texts that are scored together.
TOGETHER = 1000


class Terms(dict):
    """Buckets of terms and of their beginnings, remembered up to a bound."""

    def __missing__(self, term: str) -> bytes:
        if len(self) >= REMEMBERED:
            self.clear()
        names = [term, *(f"^{k}{term[:k]}" for k in PREFIXES if len(term) > k)]
        self[term] = h = np.array([xxhash.xxh32_intdigest(x) % FEATURES for x in names], np.int64).tobytes()
        return h

    def of(self, text: str | None) -> np.ndarray:
        """The different buckets of a text, ascending."""
        found = set(TERM.findall(text.lower())) if text else ()
        return np.unique(np.frombuffer(b"".join(map(self.__getitem__, found)), np.int64))


def probability(margin: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(margin, -30, 30)))


def logit(p: np.ndarray) -> np.ndarray:
    q = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(q / (1 - q))


def loss(p: np.ndarray, y: np.ndarray) -> float:
    """Log loss in which both classes weigh the same."""
    q = np.clip(p, 1e-9, 1 - 1e-9)
    return sum(-np.log(x).mean() / 2 for x in (q[y > 0], 1 - q[y == 0]) if len(x))


def run_starts(values: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin."""
    return np.flatnonzero(np.r_[True, values[1:] != values[:-1]]) if len(values) else np.empty(0, np.intp)


def run_sums(values: np.ndarray, at: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums of values[at] over runs; whole runs are taken until there are TAKEN, so that a long list isn't copied as a whole."""
    out, first, ends = np.empty(len(starts)), 0, np.r_[starts[1:], len(at)]
    while first < len(starts):
        last = max(first + 1, int(np.searchsorted(ends, starts[first] + TAKEN, "right")))
        out[first:last] = np.add.reduceat(values[at[starts[first] : ends[last - 1]]], starts[first:last] - starts[first])
        first = last
    return out


def fit(flat: np.ndarray, ends: np.ndarray, before: np.ndarray, y: np.ndarray, penalty: float = PENALTIES[0]) -> np.ndarray:
    """Weights of the terms, of the logits of the probabilities before, and the intercept, by full-batch Adam.

    flat: buckets of all rows; ends: how many each row has. With one class only the intercept says so.
    """
    out = np.zeros(FEATURES + before.shape[1] + 1)
    if not len(y) or y.min() == y.max():
        out[-1] = 30.0 if len(y) and y.max() else -30.0
        return out
    used = np.bincount(flat, minlength=FEATURES) >= LEAST_DOCS
    keep = used[flat]
    row = np.repeat(np.arange(len(y), dtype=np.int32), ends)[keep]
    columns = np.flatnonzero(used)
    place = np.zeros(FEATURES, np.int32)
    place[columns] = np.arange(len(columns), dtype=np.int32)
    at = place[flat[keep]]
    # Sums over runs, by row and by column: both orders are kept, as scattered additions take several times as long.
    by_column = np.argsort(at, kind="stable")
    row_of = row[by_column]
    column_starts = run_starts(at[by_column])
    row_starts = run_starts(row)
    rows = row[row_starts]
    del keep, by_column, row
    dense = np.c_[logit(before), np.ones(len(y))]
    rate = y.mean()
    weight = np.where(y > 0, 0.5 / rate, 0.5 / (1 - rate))
    w = np.zeros(len(columns) + dense.shape[1])
    m, v = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, STEPS + 1):
        margin = dense @ w[len(columns) :]
        if len(columns):
            margin[rows] += run_sums(w, at, row_starts)
        error = weight * (probability(margin) - y) / len(y)
        terms = run_sums(error, row_of, column_starts) if len(columns) else np.empty(0)
        grad = np.r_[terms, dense.T @ error]
        grad[: len(columns)] += penalty * w[: len(columns)]
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        w -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    out[columns] = w[: len(columns)]
    out[FEATURES:] = w[len(columns) :]
    return out


def common_terms(ends: np.ndarray, flat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The lists without terms that too few rows have: no fit on some of the rows counts them."""
    keep = (np.bincount(flat, minlength=FEATURES) >= LEAST_DOCS)[flat]
    return np.bincount(np.repeat(np.arange(len(ends), dtype=np.int32), ends)[keep], minlength=len(ends)), flat[keep]


def held_out(flat: np.ndarray, ends: np.ndarray, before: np.ndarray, y: np.ndarray, fold: np.ndarray, folds: int, penalty: float) -> np.ndarray:
    """Probabilities of rows by models fitted on the other folds."""
    owner, p = np.repeat(fold, ends), np.empty(len(y))
    for f in range(folds):
        w = fit(flat[owner != f], ends[fold != f], before[fold != f], y[fold != f], penalty)
        p[fold == f] = applied(w, flat[owner == f], ends[fold == f], before[fold == f])
    return p


def applied(weights: np.ndarray, flat: np.ndarray, ends: np.ndarray, before: np.ndarray) -> np.ndarray:
    """Probabilities of rows."""
    margin, after = np.zeros(len(ends)), np.cumsum(ends)
    for at in range(0, len(ends), TOGETHER):
        own = ends[at : at + TOGETHER]
        terms = flat[after[at] - ends[at] : after[at + len(own) - 1]]
        margin[at : at + len(own)] = np.bincount(np.repeat(np.arange(len(own)), own), weights=weights[terms], minlength=len(own))
    return probability(margin + logit(before) @ weights[FEATURES:-1] + weights[-1])


def fit_chain(docs: DataFrame, labels: DataFrame, categories: tuple = CATEGORIES, most: int = MOST_LABELLED, folds: int = FOLDS, text: str = "text", doc_id: str = "doc_id") -> dict[str, np.ndarray]:
    """Fits the chain on at most `most` labelled documents: weights by category, in order.

    Labels that are null don't count, nor do ids that are null or not in docs; of several labels of an id the largest counts, of
    several texts the least. Without labels of both classes a category is constant. The result has one number per feature and category.
    """
    names = [c for c, _ in categories]
    named = labels.groupBy(F.col(doc_id).alias("id")).agg(*[F.max(F.expr(e)).cast("double").alias(c) for c, e in categories]).where("id is not null").dropna(subset=names)
    drawn = named.orderBy(F.xxhash64("id"), "id").limit(most)
    rows = pick(docs, doc_id, text).toDF("d", "text").join(drawn, F.col("d") == F.col("id")).groupBy("id", *names).agg(F.min("text").alias("text"))

    def buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = Terms()
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array([terms.of(t).astype(np.int32) for t in b.column("text").to_pylist()], pa.list_(pa.int32()))], [*b.schema.names[:-1], "buckets"])

    def trained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        weights = []
        if held:
            t = pa.Table.from_batches(held).combine_chunks().sort_by("id")
            held.clear()
            lists = t.column("buckets").combine_chunks()
            ends, flat = common_terms(np.asarray(lists.value_lengths()), lists.flatten().to_numpy())
            t = t.drop_columns(["buckets"])
            del lists
            fold = np.array([xxhash.xxh32_intdigest(str(i)) % folds for i in t.column("id").to_pylist()])
            before = np.empty((t.num_rows, 0))
            for name in names:
                y = t.column(name).to_numpy()
                tried = [held_out(flat, ends, before, y, fold, folds, x) for x in PENALTIES]
                best = min(range(len(PENALTIES)), key=lambda k: loss(tried[k], y))
                weights.append(fit(flat, ends, before, y, PENALTIES[best]))
                before = np.c_[before, tried[best]]
        else:
            weights = [fit(np.empty(0, np.int64), np.empty(0, np.int64), np.empty((0, i)), np.empty(0)) for i in range(len(names))]
        yield pa.RecordBatch.from_arrays([pa.array(names), pa.array([w.tobytes() for w in weights], pa.binary())], ["category", "weights"])

    kind = ", ".join(f"{c} double" for c in names)
    # The one task has `most` rows at most.
    one = rows.mapInArrow(tidied(buckets), f"id {dict(named.dtypes)['id']}, {kind}, buckets array<int>").repartition(1).mapInArrow(tidied(trained), "category string, weights binary")
    found = {r.category: np.frombuffer(r.weights) for r in one.collect()}
    return {c: found[c] for c in names}


def score(docs: DataFrame, chain: dict[str, np.ndarray], threshold: float = THRESHOLD, target: str = TARGET, text: str = "text") -> DataFrame:
    """Adds p_<category> (double) for each category and rejected (boolean: p of the target reaches the threshold) to every row of docs.

    Whole texts are read; null and empty texts have no terms. Columns of these names are replaced; an empty table gives an empty result.
    """
    added = [f"p_{c}" for c in chain]
    names = [c for c in docs.columns if c not in (*added, "rejected")]
    flat = pick(docs, *names).toDF(*[f"c{i}" for i in range(len(names))])
    body = f"c{names.index(text)}"
    sent = docs.sparkSession.sparkContext.broadcast(list(chain.values()))
    schema = T.StructType([*flat.schema.fields, *[T.StructField(c, T.DoubleType()) for c in added]])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = Terms()
        for b in sliced(batches, TOGETHER):
            found = [terms.of(t) for t in b.column(body).to_pylist()]
            ends, buckets = np.array([len(x) for x in found], np.int64), np.concatenate(found) if found else np.empty(0, np.int64)
            before = np.empty((len(found), 0))
            for w in sent.value:
                before = np.c_[before, applied(w, buckets, ends, before)]
            yield pa.RecordBatch.from_arrays([*b.columns, *[pa.array(before[:, i]) for i in range(len(added))]], schema.names)

    return flat.mapInArrow(tidied(each), schema).withColumn("rejected", F.col(f"p_{target}") >= threshold).toDF(*names, *added, "rejected")
