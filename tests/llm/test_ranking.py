"""Bradley-Terry scores: held-out accuracy, a plain gradient, the edge against sorting, odd tables."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from demandloom.llm import ranking, toxicity

from .test_operators import clashing

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def made(n=400):
    rng = random.Random(4)
    good, bad = [f"word{i}" for i in range(60)], [f"junk{i}" for i in range(60)]
    out = []
    for i in range(n):
        q = int(i % 4 != 0)
        words = [rng.choice(good if rng.random() < (0.8 if q else 0.3) else bad) for _ in range(rng.randrange(10, 60))]
        out.append((i, " ".join(words), "en", "s", 1, q))
    return out


def test_held_out_accuracy_and_odd_rows(spark):
    """Null, empty and very long texts, repeated and null ids get a score; labels of held-out rows have no influence."""
    rows = made()
    docs = [r[:5] for r in rows] + [(1000, None, None, None, None), (1001, "", "en", "s", 0), (1002, " \n", "en", "s", 0), (1003, "word1 word2 " * 200_000, "en", "s", 0), (None, "word1 word2 word3", "en", "s", 0), rows[5][:5]]
    df = clashing(spark.createDataFrame(docs, SCHEMA).repartition(3), "score", "raw", "y", "id", "predicted", "held_out")
    apart = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    labels = spark.createDataFrame([(r[0], r[5], 0) for r in rows] + [(None, 1, 0), (3, None, 0), (9999, 1, 0)], "doc_id long, quality int, toxic int")
    out = ranking.assess(df, labels, apart).collect()
    assert len(out) == len(docs) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) and r.held_out is not None for r in out)
    truth = {r[0]: r[5] for r in rows}
    held = [r for r in out if r.held_out and r.doc_id in truth]
    assert len(held) > 50 and np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.9
    again = [r.score for r in out if r.doc_id == 5]
    assert len(again) == 2 and again[0] == again[1]
    turned = labels.withColumn("quality", F.when(apart, 1 - F.col("quality")).otherwise(F.col("quality")))
    key = lambda rows: sorted((r.doc_id or -1, r.score) for r in rows)
    assert key(ranking.assess(df, turned, apart).collect()) == key(out)


def test_fit_as_a_plain_descent():
    """Gradient of the penalised pair loss is nearly nought at the fitted weights, by a dense matrix of the features."""
    rng = np.random.default_rng(2)
    x = (rng.random((80, 12)) < 0.4).astype(float)
    y = (x[:, 0] - x[:, 1] + 0.3 * rng.normal(size=80) > 0).astype(float)
    flat, ends = np.nonzero(x)[1], x.sum(axis=1).astype(int)
    keep = ends > 0
    w = ranking.fit(flat, ends[keep], y[keep], 1e-2)[:12]
    win, lose = ranking.paired(y[keep])
    d = x[keep][win] - x[keep][lose]
    pull = lambda w: -(d / (1 + np.exp(d @ w))[:, None]).mean(axis=0) + 1e-2 * w
    assert np.abs(pull(w)).max() < 0.02 < np.abs(pull(np.zeros(12))).max()
    assert w[0] > 0.5 and w[1] < -0.5


@pytest.mark.parametrize("seed", range(3))
def test_edge_as_by_sorting(spark, seed):
    rng = random.Random(seed)
    known = [(float(rng.random() < 0.7), rng.choice([rng.gauss(0, 1), 0.5, -2.0, 1e6])) for _ in range(300)]
    s, bad = sorted(v for _, v in known), sum(y == 0 for y, _ in known)
    assert ranking.edge(spark.createDataFrame(known, "y double, raw double").repartition(3)) == pytest.approx((s[bad - 1] + s[bad]) / 2)


def test_one_class_and_no_rows(spark):
    docs = spark.createDataFrame([r[:5] for r in made(20)], SCHEMA)
    kind = "doc_id long, quality int, toxic int"
    for labels, want in (([], {1}), ([(i, 1, 0) for i in range(20)], {1}), ([(i, 0, 0) for i in range(20)], {0})):
        out = ranking.assess(docs, spark.createDataFrame(labels, kind), F.lit(False)).collect()
        assert len(out) == 20 and {r.predicted for r in out} == want
    empty = spark.createDataFrame([], SCHEMA)
    assert ranking.assess(empty, spark.createDataFrame([(1, 1, 0)], kind), F.lit(False)).count() == 0


def test_features_name_no_text():
    terms = toxicity.Terms()
    assert len(ranking.features(None, terms)) == len(ranking.features("", terms)) == len(ranking.features(" \n", terms)) == 1
    assert (ranking.features(None, terms) == ranking.features("", terms)).all()
