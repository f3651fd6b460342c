"""The chunker: a row for each chunk of a document."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..batches import text_udf
from ..functions import markdown

CHUNK = T.ArrayType(T.StructType([T.StructField("content", T.StringType()), T.StructField("headers", T.ArrayType(T.StringType()))]))


def splitter(**options):
    """A UDF: the chunks of a text."""
    return text_udf(lambda t: [{"content": c.text, "headers": ["#" * k + v for k, v in c.headers.items()]} for c in markdown.chunk(t, **options)], CHUNK)


def chunk_documents(df: DataFrame, content: str = "content", headers: str = "headers", **options) -> DataFrame:
    """One row for each chunk: the other columns of df, ``content``, ``headers`` and ``chunk_index`` (from 0).

    options: those of markdown.chunk. headers are the titles that a chunk is below, each after its
    ``#`` marks, and give way to a document's own ``headers`` if it has some. embedding and
    pipeline_metadata don't pass on to chunks. A null or blank content gives no chunk.
    """
    markdown.chunk("", **options)  # unknown options fail here

    others = [F.col(f"`{c}`") for c in df.columns if c not in (content, headers, "chunk_index", "embedding", "pipeline_metadata")]
    own = [F.col(f"`{headers}`").alias("_own")] if headers in df.columns else [F.lit(None).cast("array<string>").alias("_own")]
    rows = df.select(*others, *own, F.posexplode(splitter(**options)(F.col(content))).alias("chunk_index", "_chunk"))
    keep = [F.col(f"`{c}`") for c in df.columns if c not in (content, headers, "chunk_index", "embedding", "pipeline_metadata")]
    return rows.select(*keep, F.col("_chunk.content").alias(content), F.coalesce("_own", "_chunk.headers").alias(headers), "chunk_index")
