"""The corpus pipeline: STAGES, each over all that its predecessor kept, and run()."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.llm import decontaminate, minhash, pack, suffix_dedup, toxicity
from corpusmill.llm.common import drop, shared_dir

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is under the threshold. The model learns from the labels of documents that aren't held out."""
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score(docs, model).where("predicted = 0").select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (five-word shingles, 0.8) the document with the smallest doc_id."""
    gone = minhash.near_duplicates(docs).where("not kept").select("doc_id")
    return docs.join(gone, "doc_id", "left_anti").select(*COLUMNS)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document without the bytes that repeat 50 bytes or more of one with a smaller doc_id; n_chars follows the text."""
    return suffix_dedup.cut_repeats(docs).withColumn("n_chars", F.length("text").cast("bigint")).select(*COLUMNS)


def leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no copy of a benchmark item."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select(*COLUMNS)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of at most 1024 tokens, with their token ids."""
    return pack.pack(docs, *pack.public_paths())


STAGES = [("toxicity", toxic), ("near_duplicates", near_duplicates), ("repeats", repeats), ("decontamination", leaks), ("packing", sequences)]

#: No stage but decontamination's bookkeeping has an SQL form (compression, minima, suffix order, packing): the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage's result is written to the shared folder and read again, and goes once the next one stands."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    at = shared_dir(spark)
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{at}/{name}")
        drop(docs)  # what the stage before wrote; documents themselves are never touched
        docs = spark.read.parquet(f"{at}/{name}")
        docs.scratch_path = f"{at}/{name}"
    return docs
