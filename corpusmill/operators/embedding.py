"""Embeddings and points of a vector store."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from .filters import existing_embeddings, not_in

Embedder = Callable[[list[str]], list[list[float] | None]]


def hashing_embedder(size: int = 64) -> Embedder:
    """A stand-in for a model, deterministic: words add a sign at a place by their hash; unit length."""

    def embed(texts: list[str]) -> list[list[float] | None]:
        out = []
        for text in texts:
            v = [0.0] * size
            for w in text.lower().split():
                h = int.from_bytes(hashlib.blake2b(w.encode(), digest_size=8).digest(), "big")
                v[h % size] += 1.0 if h >> 63 else -1.0
            norm = math.sqrt(sum(x * x for x in v))
            out.append([x / norm for x in v] if norm else v)
        return out

    return embed


def embed(df: DataFrame, embedder: Embedder, batch_size: int = 64, content: str = "content") -> DataFrame:
    """Add ``embedding``; the embedder gets batches of texts (null as empty), and a null for a text that failed stays null."""

    @F.pandas_udf("array<float>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            texts = batch.fillna("").tolist()
            yield pd.Series([v for at in range(0, len(texts), batch_size) for v in embedder(texts[at : at + batch_size])], index=batch.index)

    return df.withColumn("embedding", run(F.col(content)))


def year_number(year: Column) -> Column:
    """A year as a whole number: '2020.0' counts, other texts give null."""
    return year.cast("string").try_cast("double").try_cast("int")


def points(df: DataFrame, content: str = "content", filename: str = "filename", metadata=(), pipeline_metadata: str | None = None) -> DataFrame:
    """(id, vector, payload) of each row with its embedding: payload is JSON of the content and the metadata columns, with year as a number and title as text."""
    fields = {"content": F.col(content)}
    for c in metadata:
        fields[c] = year_number(F.col(c)) if c == "year" else F.col(c).cast("string") if c == "title" else F.col(c)
    if pipeline_metadata:
        fields["pipeline_metadata"] = F.col(pipeline_metadata)
    payload = F.to_json(F.struct(*(v.alias(k) for k, v in fields.items())))
    vector = F.col("embedding") if "embedding" in df.columns else F.lit(None).cast("array<float>")
    return df.select(X.uint_id(X.short_id(F.col(filename), F.col(content))).alias("id"), vector.alias("vector"), payload.alias("payload"))


def upload(df: DataFrame, path: str, embedder: Embedder | None = None, use_existing_embeddings: bool = False, **options) -> int:
    """Append to a table of points those that it lacks, and return how many: rows without an embedding are skipped, repeated ids go once. Done again, it adds nothing."""
    spark = df.sparkSession
    rows = existing_embeddings(df) if use_existing_embeddings else embed(df, embedder) if embedder else df
    new = points(rows, **options).where(F.col("vector").isNotNull()).dropDuplicates(["id"])
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop):
        new = not_in(new, spark.read.schema(new.schema).parquet(path), "id")
    seen = F.count("*").alias("n")
    from pyspark.sql import Observation

    counted = Observation("uploaded")
    new.observe(counted, seen).write.mode("append").parquet(path)
    return counted.get["n"]
