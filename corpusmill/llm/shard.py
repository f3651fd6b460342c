"""Sharding by a two-pass external shuffle: seeded scatter into buckets, Fisher-Yates in each."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import parts_for, saved


def shard_of(key: Column, shards: int, seed: int) -> Column:
    """The shard with the largest seeded hash of (key, shard): one more shard takes rows only into itself."""
    draw = F.transform(F.sequence(F.lit(0), F.lit(shards - 1)), lambda i: F.struct(F.xxhash64(F.lit(seed), key, i).alias("draw"), i.alias("shard")))
    return F.array_max(draw)["shard"]


def fisher_yates(n: int, seed: list[int]) -> np.ndarray:
    """A uniform permutation of n places: for i from the last down, swap i with a place up to i."""
    rng = np.random.default_rng(seed)
    order = list(range(n))
    if n > 1:
        for i, j in zip(range(n - 1, 0, -1), rng.integers(0, np.arange(n, 1, -1)).tolist()):
            order[i], order[j] = order[j], order[i]
    return np.array(order, np.int64)


def _shuffle(seed: int):
    def run(key: tuple, t: pa.Table) -> pa.Table:
        t = t.combine_chunks().sort_by([("tie", "ascending"), ("crc", "ascending"), ("at", "ascending")])
        order = fisher_yates(t.num_rows, [seed, key[0].as_py(), key[1].as_py()])
        t = t.take(pa.array(order)).drop_columns(["tie", "crc", "at"])
        return t.append_column("place", pa.array(np.arange(t.num_rows)))

    return run


def write_shards(docs: DataFrame, shards: int = 8, seed: int = 5, bucket_bytes: int = 16 << 20) -> DataFrame:
    """Deal rows to shards in random order and write them; returns what was written.

    docs: doc_id and text, and any others, which are kept in ``row`` (a struct of all
    columns but text). The law is ``key``: doc_id (a null one too) and the number of shards
    decide, and one more shard takes rows only into itself.

    Pass 1 scatters records by seeded hashes into (shard, bucket), buckets of about
    ``bucket_bytes`` each; which bucket of its shard a row takes depends on its doc_id, its
    text's length and its place in the input, so that a repeated row spreads as well. Pass 2
    shuffles each bucket in memory by Fisher-Yates, seeded by its number, and writes it:
    Parquet in the shared folder, a folder for each shard, rows in the order of (bucket,
    place). A row's slot in its shard is its place plus the rows of earlier buckets.
    """
    from .common import text_bytes

    others = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    n_buckets = parts_for(text_bytes(docs), bucket_bytes * shards)
    text = F.col("text").cast("string")
    base = docs.select(text.alias("text"), F.struct(*others).alias("row"), F.monotonically_increasing_id().alias("at"))
    size = F.coalesce(F.octet_length("text"), F.lit(0))
    scattered = base.select(
        "text", "row", "at", F.xxhash64(F.lit(seed), "row.doc_id", size).alias("tie"), F.crc32(F.coalesce(F.col("text").cast("binary"), F.lit(b""))).alias("crc"),
        shard_of(F.col("row.doc_id"), shards, seed).alias("shard"), shard_of(F.col("row.doc_id"), shards + 1, seed).alias("grown_shard"),
        F.pmod(F.xxhash64(F.lit(seed + 1), "row.doc_id", size, "at"), F.lit(n_buckets)).cast("int").alias("bucket"),
    )
    schema = f"text string, row {base.schema['row'].dataType.simpleString()}, shard int, grown_shard int, bucket int, place bigint"
    return saved(scattered.groupBy("shard", "bucket").applyInArrow(_shuffle(seed), schema), "shards", "shard")


def with_slots(written: DataFrame) -> DataFrame:
    """slot: a row's place in its shard, gapless from 0."""
    sizes = written.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    begins = sizes.select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("begin"))
    return written.join(begins, ["shard", "bucket"]).withColumn("slot", F.col("place") + F.col("begin"))


def op5_shard(spark, sf_dir: str) -> DataFrame:
    """Contract query: eight shards of all documents, law ``key``; digests of the rows as read back."""
    written = write_shards(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    text = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    digests = written.select(F.col("row.doc_id").alias("doc_id"), (F.octet_length(text) + 1).cast("bigint").alias("size"), F.crc32(text).alias("text_crc32"), F.lit("key").alias("law"), "shard", "grown_shard", "bucket", "place")
    return with_slots(digests).select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
