"""Documents from files and tables, in one schema: doc_id, file_path, file_format, content and metadata (JSON)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X
from ..operators.extraction import decoded

RECORD = "content string, metadata string, embedding array<float>, pipeline_metadata string, _corrupt_record string"


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = fs.globStatus(p)
    return found is not None and len(found) > 0


def present(spark: SparkSession, paths: str | list[str]) -> list[str]:
    """The paths that exist; missing ones are left out without an error."""
    return [p for p in ([paths] if isinstance(paths, str) else paths) if _exists(spark, p)]


def read_files(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """A row for each file below the paths but JSON Lines: doc_id (of its path), file_path, file_format, bytes, and an empty content for extract to fill."""
    found = present(spark, paths)
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(found) if found else spark.createDataFrame([], "path string, modificationTime timestamp, length bigint, content binary")
    rows = rows.where(X.file_format(F.col("path")) != "jsonl")
    return rows.select(X.short_id(F.col("path"), F.col("path")).alias("doc_id"), F.col("path").alias("file_path"), X.file_format(F.col("path")).alias("file_format"), F.lit("").alias("content"), F.col("content").alias("bytes"))


def read_text(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Whole Markdown and text files, UTF-8 or else Latin-1; empty ones go."""
    rows = read_files(spark, paths).where(F.col("file_format").isin("md", "txt"))
    return rows.withColumn("content", decoded(F.col("bytes"))).drop("bytes").where(F.length("content") > 0)


def parsed_lines(lines: DataFrame, line: str = "value") -> DataFrame:
    """Columns content, metadata, embedding, pipeline_metadata and bad from a column of JSON: bad is why a line is no document, else null."""
    parsed = lines.withColumn("_r", F.from_json(F.col(line), RECORD, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}))
    bad = F.when(F.col("_r._corrupt_record").isNotNull() | F.col("_r").isNull() | ~F.trim(line).startswith("{"), "no JSON object").when(F.col("_r.content").isNull(), "no content")
    return parsed.select(*[c for c in lines.columns], F.col("_r.content").alias("content"), F.col("_r.metadata").alias("metadata"), F.col("_r.embedding").alias("embedding"), F.col("_r.pipeline_metadata").alias("pipeline_metadata"), bad.alias("bad"))


def read_jsonl(spark: SparkSession, paths: str | list[str], strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """(documents, bad lines) of JSON Lines files; blank lines are skipped.

    Documents are tagged md, and doc_id is the short id of path and line. Bad lines, with the reason in ``bad``,
    are those that aren't a JSON object or lack content. strict: a file with a bad line gives no documents.
    """
    found = present(spark, paths)
    options = {"recursiveFileLookup": "true", "pathGlobFilter": "*.jsonl"}
    lines = spark.read.options(**options).text(found) if found else spark.createDataFrame([], "value string")
    path = F.col("_metadata.file_path") if found else F.lit("")
    lines = lines.select(path.alias("file_path"), "value").where(~X.is_blank(F.col("value")))
    rows = parsed_lines(lines)
    bad = rows.where("bad is not null").select("file_path", "value", "bad")
    good = rows.where("bad is null")
    if strict:
        good = good.join(bad.select("file_path").distinct(), "file_path", "left_anti")
    return good.select(X.short_id(F.col("file_path"), F.col("value")).alias("doc_id"), "file_path", F.lit("md").alias("file_format"), "content", "metadata", "embedding", "pipeline_metadata"), bad


def spread(df: DataFrame) -> DataFrame:
    """df over all cores where its files give fewer parts than that, as one large row group does; for work in Python that outweighs the shuffle."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def from_table(df: DataFrame, content: str = "text", key: str = "doc_id") -> DataFrame:
    """A table of texts as documents of format md; its other columns stay."""
    return df.withColumnsRenamed({content: "content", key: "doc_id"}).withColumns({"file_path": F.concat(F.col("doc_id").cast("string"), F.lit(".md")), "file_format": F.lit("md")})
