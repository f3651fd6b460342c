"""Pipelines over folders that keep growing: the same stages on each micro-batch, with Spark's own checkpoints."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import text as X
from ..plans import pipeline
from ..sources import sinks
from ..sources.files import parsed_lines


def jsonl_stream(spark: SparkSession, path: str) -> DataFrame:
    """New JSON Lines files as documents; lines that are none are dropped."""
    lines = spark.readStream.schema("value string").option("pathGlobFilter", "*.jsonl").text(path)
    lines = lines.select(F.col("_metadata.file_path").alias("file_path"), "value").where(~X.is_blank(F.col("value")))
    rows = parsed_lines(lines).where("bad is null")
    return rows.select(X.short_id(F.col("file_path"), F.col("value")).alias("doc_id"), "file_path", F.lit("md").alias("file_format"), "content", "metadata", F.current_timestamp().alias("seen_at"))


def without_repeats(docs: DataFrame, delay: str | None = None) -> DataFrame:
    """Each content once over the whole stream; with ``delay``, over that time only, so that the state stays bounded."""
    hashed = docs.withColumn("content_sha", F.sha2("content", 256))
    if delay:
        return hashed.withWatermark("seen_at", delay).dropDuplicatesWithinWatermark(["content_sha"])
    return hashed.dropDuplicates(["content_sha"])


def start(docs: DataFrame, stages: list, output_dir: str, checkpoint: str) -> StreamingQuery:
    """Run the stages on all that is there, batch by batch, and write JSON Lines: a folder for each batch, which a repeated batch overwrites."""
    pipeline.checked(stages)

    def batch(df: DataFrame, number: int) -> None:
        sinks.export(pipeline.build(df, stages), f"{output_dir.rstrip('/')}/batch={number}", "jsonl")

    return docs.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
