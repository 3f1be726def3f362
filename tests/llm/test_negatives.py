"""Hard negatives against all scores by brute force."""

import math
import random

import numpy as np
import pytest

from demandloom.llm import negatives

from .test_operators import clashing

SCHEMA = "vec_id long, label int, embedding array<double>"


def expected(rows, anchors, positives=5, k=5):
    good = [(i, lab, [math.floor(256 * x) for x in v]) for i, lab, v in rows if None not in (i, lab, v) and all(x is not None and math.isfinite(x) for x in v)]
    width = max((len(v) for *_, v in good), default=0)
    good = [(i, lab, v + [0] * (width - len(v))) for i, lab, v in good]
    out, done = [], set()
    for a, lab, v in sorted(x for x in good if anchors(x[0])):
        if a in done:
            continue
        done.add(a)
        scored = sorted((-sum(x * y for x, y in zip(v, w, strict=True)), i, own == lab) for i, own, w in good if i != a)
        for s, p, _ in [x for x in scored if x[2]][:positives]:
            within = [(n, -t) for t, n, same in scored if not same and 80 * -s <= 100 * -t <= 100 * -s][:k]
            out += [(a, p, r, n, -s, t) for r, (n, t) in enumerate(within, 1)]
    return sorted(out)


def mined(df, anchors):
    rows = negatives.labelled(df)
    return sorted(tuple(r) for r in negatives.mine(rows.where(anchors), rows).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


def test_as_brute_force(spark):
    """Nulls, non-finite components, ties, repeated rows and ids, short vectors, labels of one row, vectors of nought, clashing columns."""
    rng = random.Random(9)
    rows = [(i, i % 4, [rng.choice([-1.0, -0.5, 0.0, 0.25, 1.0]) for _ in range(6)]) for i in range(300)]
    rows += [rows[10], rows[10], rows[20], (20, 3, [1.0] * 6), (400, 99, [1.0] * 6), (500, 1, [0.0] * 6), (600, 2, [0.5, 0.5]), (None, 1, [1.0] * 6), (700, None, [1.0] * 6)]
    rows += [(800, 1, None), (900, 1, [None] * 6), (1000, 1, [float("nan")] * 6), (1100, 1, [float("inf")] * 6), (1200, 1, []), (1300, 2, [-1.0] * 6)]
    df = clashing(spark.createDataFrame(rows, SCHEMA).repartition(4), "row", "column", "number", "windows", "alike")
    assert mined(df, "vec_id % 10 = 0") == expected(rows, lambda i: i % 10 == 0)


def test_many_blocks_one_hot_label_and_copies(spark):
    """More than a block of rows, most of them of one label, and a crowd of equal vectors."""
    rng = np.random.default_rng(3)
    near = rng.normal(size=12)
    rows = [(i, 0 if i % 3 else 1 + i % 5, (near + 0.8 * rng.normal(size=12)).tolist()) for i in range(8000)]
    rows += [(i, i % 2, near.tolist()) for i in range(8000, 9000)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(7)
    assert mined(df, "vec_id % 400 = 0") == expected(rows, lambda i: i % 400 == 0)


def test_scores_beyond_doubles(spark):
    rng = random.Random(2)
    rows = [(i, i % 2, [float(rng.randrange(-(2**22), 2**22)) for _ in range(3)]) for i in range(60)]
    assert mined(spark.createDataFrame(rows, SCHEMA), "vec_id % 10 = 0") == expected(rows, lambda i: i % 10 == 0)


@pytest.mark.parametrize("rows", [[], [(100, 1, [1.0])], [(100, 1, [1.0]), (1, 2, [1.0])]])
def test_nothing_to_mine(spark, rows):
    assert mined(spark.createDataFrame(rows, SCHEMA), "vec_id % 100 = 0") == []


def test_bounds_hold_and_prune():
    """What a scan leaves has exact scores, and no row that a window needs is lost."""
    rng = np.random.default_rng(1)
    block = (rng.normal(size=(32, 500)) * np.linspace(20, 1, 32)[:, None]).astype(np.int16)
    a = (rng.normal(size=32) * np.linspace(50, 1, 32)).round()
    order = np.argsort(-np.abs(a))
    ends = a[order] * block.min(axis=1)[order], a[order] * block.max(axis=1)[order]
    least, most = (np.r_[np.cumsum(f(*ends)[::-1])[::-1], 0] for f in (np.minimum, np.maximum))
    true = a @ block.astype(float)
    windows = [negatives.Window(float("-inf"), float("inf"), 5)]
    alive, got = negatives.scan(a, order, least, most, block, np.arange(500), windows)
    assert set(np.argsort(-true)[:5]) <= set(alive.tolist()) and (true[alive] == got).all() and len(alive) < 50
