"""A corpus from raw documents to packed sequences, stage by stage. Stages that give whole texts to Python set a session's Arrow batches to a few MB."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandloom.llm import mixing, near, packing, substrings, toxicity
from demandloom.llm.common import BATCHES, by_bytes, clearing, delete, new_folder, pick, restored

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain, fitted on the labelled ones, doesn't call toxic."""
    by_bytes(spark)
    chain = toxicity.fit_chain(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score(pick(docs, *COLUMNS), chain).where("not rejected").select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group that five-word similarities of 0.8 and more join, the document with the smallest id."""
    by_bytes(spark)
    return near.deduplicate(pick(docs, *COLUMNS))


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the words of repeated windows; texts that have none stay as they are, and those with nothing left go."""
    by_bytes(spark)
    done = substrings.remove_repeats(pick(docs, *COLUMNS))
    cut_out = F.col("n_removed") > 0
    done = done.withColumn("text", F.when(cut_out, F.col("kept")).otherwise(F.col("text"))).withColumn("n_chars", F.when(cut_out, F.length("kept").cast("long")).otherwise(F.col("n_chars")))
    return done.where(~cut_out | (F.col("n_removed") < F.col("n_words"))).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated at random so that sources weigh as the square root of their size, shuffled."""
    return mixing.mix(pick(docs, *COLUMNS), mixing.temperature_weights(docs)).select(*COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their places in training sequences."""
    by_bytes(spark)
    return packing.digests(pick(docs, *COLUMNS)).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("toxicity", reject_toxic),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each one's rows written to the shared folder and read again; of what is written there only the last stage's rows stay."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    with restored(spark, BATCHES):
        for name, stage in STAGES:
            folder = new_folder(spark, f"pipeline-{name}")
            with clearing(spark):
                stage(spark, docs, sf_dir).write.parquet(folder)
            if before:
                delete(spark, before)
            docs, before = spark.read.parquet(folder), folder
    return docs


#: Tokens and classifiers are beyond SQL.
ORACLE_SQL = None
