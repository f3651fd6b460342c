"""Export of documents, and the side table that lets a run resume."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..operators.filters import not_in
from .files import present

FIELDS = ("content", "file_path", "file_format", "metadata", "pipeline_metadata", "embedding")


def document_json(df: DataFrame) -> Column:
    """A document as JSON, its fields in the order of FIELDS; null ones are left out."""
    return F.to_json(F.struct(*[F.col(c) for c in FIELDS if c in df.columns]))


def export(df: DataFrame, output_dir: str, format: str = "md", mode: str = "overwrite", json_quoted: bool = False) -> None:
    """Write documents into a folder for each source file's stem.

    jsonl: one JSON object a row. dummy: computes everything and writes nothing. Any other format:
    the contents, each followed by a newline; json_quoted writes them as JSON strings.
    """
    if format == "dummy":
        df.write.format("noop").mode("overwrite").save()
        return
    stem = F.regexp_replace(F.element_at(F.split("file_path", "/"), -1), r"(?<=.)\.[^.]*$", "")
    quoted = F.regexp_extract(F.to_json(F.struct(F.col("content").alias("c"))), r'(?s)^\{"c":(.*)\}$', 1)
    value = document_json(df) if format == "jsonl" else quoted if json_quoted else F.col("content")
    df.select(stem.alias("stem"), value.alias("value")).write.partitionBy("stem").mode(mode).text(output_dir)


def checkpoint_rows(df: DataFrame) -> DataFrame:
    """(source_key, filename, content_length) of processed documents; source_key comes from the content as it was read."""
    return df.select("source_key", F.element_at(F.split("file_path", "/"), -1).alias("filename"), F.length("content").cast("bigint").alias("content_length"))


def with_source_key(df: DataFrame) -> DataFrame:
    return df.withColumn("source_key", X.short_id(F.element_at(F.split("file_path", "/"), -1), F.col("content")))


def mark_processed(df: DataFrame, path: str) -> None:
    checkpoint_rows(df).write.mode("append").json(path)


def unprocessed(df: DataFrame, path: str) -> DataFrame:
    """Documents (with a source_key) that the side table at ``path`` doesn't hold; all, if there is none."""
    spark = df.sparkSession
    if not present(spark, path):
        return df
    return not_in(df, spark.read.schema("source_key string, filename string, content_length bigint").json(path), "source_key")
