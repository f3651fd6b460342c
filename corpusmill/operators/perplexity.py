"""Perplexity: window arithmetic for any model, and an n-gram model as the offline default."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..scratch import saved

#: Words whose counts are broadcast, and characters that one of them has at most: some 10 MB.
COMMON, LONGEST = 1 << 16, 64

#: For token ids of a window and how many of the last count: the mean loss over those that are predicted, all but the first of what counts.
WindowLoss = Callable[[list[int], int], float]


def windowed(ids: list[int], loss: WindowLoss, stride: int = 128, max_length: int = 1024) -> float | None:
    """exp of the mean loss over windows that begin every ``stride`` tokens and end where the text does; each counts only tokens that no earlier one had, less one. Null if none counts."""
    total, n, done = 0.0, 0, 0
    for begin in range(0, len(ids), stride):
        end = min(begin + max_length, len(ids))
        new = end - done
        if new > 1:
            total += loss(ids[begin:end], new) * (new - 1)
            n += new - 1
        done = end
        if end == len(ids):
            break
    return math.exp(total / n) if n else None


def model_perplexity(df: DataFrame, make_scorer: Callable[[], Callable[[str], float | None]], content: str = "content") -> DataFrame:
    """Add ``perplexity`` by a scorer that each worker makes once; null for null and blank texts and where the scorer fails on a text."""

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = make_scorer()

        def one(text):
            try:
                return scorer(text) if text and text.strip() else None
            except ValueError:
                return None

        for batch in batches:
            yield batch.map(one).astype("float64")

    return df.withColumn("perplexity", run(F.col(content)))


def unigram_perplexity(df: DataFrame, content: str = "content", key: str = "doc_id") -> DataFrame:
    """Add ``perplexity`` of each row under the words of all rows with one added to each count; null without words.

    A stand-in for a neural model. Words are counted once for all rows, with partial sums. The counts of the COMMON
    most frequent words are broadcast, and a row's losses under them are summed where it is read; only other words,
    a row for each in a document, are shuffled to meet their counts. Keys are unique.
    """
    text = df.select(F.col(key).alias("key"), F.explode(X.words(F.lower(F.col(content)))).alias("word"))
    corpus = saved(text.groupBy("word").agg(F.count("*").alias("c")), "words")
    size = corpus.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    common = corpus.where(F.length("word") <= LONGEST).orderBy(F.desc("c"), "word").limit(COMMON).select("word", "c")
    # a word without a count here stays by its name, all others of a row become one
    each = text.join(F.broadcast(common), "word", "left").withColumn("rare", F.when(F.col("c").isNull(), F.col("word")))
    lost = -F.log((F.col("c") + 1) / F.lit(size[0] + size[1]))
    each = each.groupBy("key", "rare").agg(F.count("*").alias("n"), F.sum(lost).alias("lost"))
    known = each.where("rare is null").select("key", "n", "lost")
    rare = each.where("rare is not null").select("key", "n", F.col("rare").alias("word")).join(corpus, "word").select("key", "n", (lost * F.col("n")).alias("lost"))
    found = known.unionByName(rare).groupBy("key").agg(F.exp(F.sum("lost") / F.sum("n")).alias("perplexity"))
    return df.drop("perplexity").join(found, F.col(key) == F.col("key"), "left").drop(found["key"])


def perplexity_filter(df: DataFrame, threshold: float = 0.0, enable_threshold: bool = False) -> DataFrame:
    """Rows whose perplexity is at most the threshold, if that is enabled; a null one is above any."""
    return df.where(F.col("perplexity") <= threshold) if enable_threshold else df
