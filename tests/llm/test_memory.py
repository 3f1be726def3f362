"""What fits and stages hold at once."""

import tracemalloc

import numpy as np

import corpus_pipeline as pipeline
from demandloom.llm import common, toxicity

from .test_operators import SCHEMA, rows


def test_a_fit_holds_few_numbers_for_each_term():
    draw, n, each = np.random.default_rng(3), 2000, 1000
    flat = np.concatenate([np.sort(draw.choice(toxicity.FEATURES, each, replace=False)) for _ in range(n)]).astype(np.int32)
    tracemalloc.start()
    toxicity.fit(flat, np.full(n, each), np.empty((n, 0)), (draw.random(n) < 0.3).astype(float))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 32 * len(flat)


def test_run_sums(monkeypatch):
    monkeypatch.setattr(toxicity, "TAKEN", 4)
    draw = np.random.default_rng(4)
    values, at, starts = draw.random(9), draw.integers(0, 9, 40), np.array([0, 1, 2, 9, 11, 12, 13, 14, 15, 39])
    assert np.array_equal(toxicity.run_sums(values, at, starts), np.add.reduceat(values[at], starts))
    assert len(toxicity.run_sums(values, at[:0], starts[:0])) == 0


def test_terms_of_too_few_documents_change_nothing():
    ends, flat = np.array([3, 0, 3, 2, 1]), np.array([1, 2, 7, 1, 2, 5, 1, 2, 9])
    few, common_flat = toxicity.common_terms(ends, flat)
    assert few.tolist() == [2, 0, 2, 2, 0] and common_flat.tolist() == [1, 2, 1, 2, 1, 2]
    y, none = np.array([1.0, 0, 0, 1, 0]), np.empty((5, 0))
    assert np.array_equal(toxicity.fit(flat, ends, none, y), toxicity.fit(common_flat, few, none, y))


def test_stages_give_python_a_few_mb_at_a_time(spark, tmp_path):
    spark.createDataFrame(rows()[:30], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(r[0], 1, 0) for r in rows()[:20]], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    before = spark.conf.get(common.BATCHES)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    with common.restored(spark, common.BATCHES):
        for _, stage in pipeline.STAGES:
            if stage is not pipeline.mix_sources:
                spark.conf.set(common.BATCHES, before)
                stage(spark, docs, str(tmp_path))
                assert int(spark.conf.get(common.BATCHES)) == common.BATCH_BYTES
    pipeline.run(spark, str(tmp_path))
    assert spark.conf.get(common.BATCHES) == before
