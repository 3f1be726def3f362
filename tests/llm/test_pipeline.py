"""The pipeline's stages on a small table."""

from pathlib import Path

from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from demandloom.llm import common

from .test_operators import SCHEMA, check_packing, rows


def test_stages(spark, tmp_path):
    docs = spark.createDataFrame(rows(), SCHEMA)
    folder = str(tmp_path)
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(r[0], 1, 0) for r in rows()[:20]], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    assert [n for n, _ in pipeline.STAGES] == ["toxicity", "near_dedup", "substring_dedup", "mixing", "packing"]
    now = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in pipeline.STAGES:
        out = stage(spark, now, folder)
        if name != "packing":
            assert out.columns == docs.columns and 0 < out.count() and (name == "mixing" or out.count() <= now.count())
            out.write.parquet(f"{folder}/{name}")
            now = spark.read.parquet(f"{folder}/{name}")
    last = pipeline.run(spark, folder).collect()
    check_packing(last, 2048)
    assert {r.doc_id for r in last} == {r.doc_id for r in now.collect()}


def test_nothing_and_clashing_columns(spark, tmp_path):
    """Stages pass over columns that documents don't have; without documents every stage gives none."""
    labels = spark.createDataFrame([(r[0], 1, 0) for r in rows()[:20]], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    none = spark.createDataFrame([], SCHEMA)
    none.write.parquet(f"{tmp_path}/documents.parquet")
    assert pipeline.run(spark, str(tmp_path)).count() == 0
    docs = spark.createDataFrame(rows()[:30], SCHEMA)
    for c in ("node", "simhash", "root", "id", "kept", "spans", "copy", "rate", "rejected", "p_toxic", "piece", "sequence_id"):
        docs = docs.withColumn(c, F.lit(1))
    for name, stage in pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        assert out.count() > 0 and (name == "packing" or out.columns == list(pipeline.COLUMNS))


def test_what_is_written_is_deleted(spark, tmp_path):
    spark.createDataFrame(rows()[:30], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(r[0], 1, 0) for r in rows()[:20]], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    there = lambda: set(Path(common.shared_folder(spark)).iterdir())
    before = there()
    out = pipeline.run(spark, str(tmp_path))
    assert [p.name.rpartition("-")[0] for p in there() - before] == ["pipeline-packing"]
    assert out.count() > 0
