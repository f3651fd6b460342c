"""Keep or discard filters. Each adds its metric as a column before it filters; metrics of these names are replaced.

A null content counts as empty. ``comparison`` is strict: at equality neither holds, so
``keep`` drops the row and ``discard`` retains it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X


def _kept(df: DataFrame, condition: Column, action: str) -> DataFrame:
    if action not in ("keep", "discard"):
        raise ValueError(f"action must be keep or discard, not {action!r}")
    return df.where(condition if action == "keep" else ~condition)


def _compared(metric: Column, limit: int, comparison: str) -> Column:
    if limit is None:
        raise ValueError("a limit is required")
    if comparison not in ("greater", "less"):
        raise ValueError(f"comparison must be greater or less, not {comparison!r}")
    return metric > limit if comparison == "greater" else metric < limit


def length_filter(df: DataFrame, length: int, comparison: str = "greater", action: str = "keep", content: str = "content") -> DataFrame:
    """By ``word_count``, the number of words."""
    condition = _compared(F.col("word_count"), length, comparison)
    return _kept(df.withColumn("word_count", X.word_count(F.col(content))), condition, action)


def newline_filter(df: DataFrame, chunks: int, comparison: str = "greater", action: str = "keep", content: str = "content") -> DataFrame:
    """By ``newline_count``, the number of newlines."""
    condition = _compared(F.col("newline_count"), chunks, comparison)
    return _kept(df.withColumn("newline_count", X.newline_count(F.col(content))), condition, action)


def _headers(df: DataFrame, headers: str) -> Column:
    """The headers, lower-cased and stripped; none where the table has no such column."""
    if headers not in df.columns:
        return F.array().cast("array<string>")
    return F.transform(F.coalesce(F.col(headers), F.array().cast("array<string>")), lambda h: F.lower(X.strip(h)))


def reference_filter(df: DataFrame, action: str = "discard", content: str = "content", headers: str = "headers") -> DataFrame:
    """By whether a Markdown header of the text opens references or acknowledgements, or an element of ``headers`` is such a word."""
    text = F.coalesce(F.col(content), F.lit(""))
    named = F.arrays_overlap(_headers(df, headers), F.array(*map(F.lit, ("reference", "references", "acknowledgement", "acknowledgements"))))
    return _kept(df, text.rlike(X.REFERENCE_HEADER) | text.rlike(X.ACKNOWLEDGEMENT_HEADER) | F.coalesce(named, F.lit(False)), action)


def pii_share(content: Column) -> Column:
    """Masked persons and e-mail addresses for each word; 0 without words."""
    n = X.word_count(content)
    marks = X.occurrences(content, X.PERSON_MARK) + X.occurrences(content, X.EMAIL_MARK)
    return F.when(n > 0, marks / n).otherwise(F.lit(0.0))


def pii_filter(df: DataFrame, threshold: float, action: str = "discard", apply_filter: bool = True, content: str = "content", headers: str = "headers") -> DataFrame:
    """By ``pii_tokens_percentage`` of at least ``threshold``; texts with an abstract or introduction are always kept. apply_filter=False only adds the metric."""
    if threshold is None:
        raise ValueError("a threshold is required")
    if action not in ("keep", "discard"):
        raise ValueError(f"action must be keep or discard, not {action!r}")
    out = df.withColumn("pii_tokens_percentage", pii_share(F.col(content)))
    if not apply_filter:
        return out
    high = F.col("pii_tokens_percentage") >= threshold
    opening = F.exists(_headers(df, headers), lambda h: h.contains("abstract") | h.contains("introduction"))
    exempt = F.coalesce(F.col(content), F.lit("")).rlike(X.OPENING_HEADER) | F.coalesce(opening, F.lit(False))
    return out.where(exempt | (high if action == "keep" else ~high))


def non_trivial(df: DataFrame, content: str = "content") -> DataFrame:
    """Contents of more than one character."""
    return df.where(F.length(content) > 1)


def existing_embeddings(df: DataFrame, embedding: str = "embedding") -> DataFrame:
    return df.where(F.col(embedding).isNotNull())


def not_in(df: DataFrame, seen: DataFrame, key: str) -> DataFrame:
    """Rows whose key isn't in ``seen``: resuming, and points that a store already has."""
    return df.join(seen.select(key).where(F.col(key).isNotNull()).distinct(), key, "left_anti")
