"""Masking of personal data: e-mail addresses by pattern, persons by a recognizer that the caller brings."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X

Recognizer = Callable[[list[str]], list[list[tuple[int, int]]]]


def _covered(text: str, spans: list[tuple[int, int]]) -> str:
    """The text with the spans, merged where they overlap, replaced by the mark of a person."""
    out, at = [], 0
    for a, b in sorted(spans):
        if b <= at:
            continue
        if a >= at:
            out += [text[at:a], X.PERSON_MARK]
        at = b
    return "".join(out) + text[at:]


def mask_persons(text: Column, recognizer: Recognizer) -> Column:
    """recognizer: for a batch of texts the (start, end) of each person in each, e.g. a model that is loaded once per worker."""

    @F.pandas_udf("string")
    def mask(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            texts = batch.fillna("").tolist()
            yield pd.Series([_covered(t, s) for t, s in zip(texts, recognizer(texts))], index=batch.index).where(batch.notna(), None)

    return mask(text)


def mask_pii(df: DataFrame, entities=("PERSON", "EMAIL_ADDRESS"), recognizer: Recognizer | None = None, content: str = "content") -> DataFrame:
    """Mask the entities in ``content`` and keep what is longer than a character. Persons need a recognizer; without one only e-mail addresses are masked."""
    c = F.col(content)
    if "PERSON" in entities and recognizer:
        c = mask_persons(c, recognizer)
    if "EMAIL_ADDRESS" in entities:
        c = X.mask_emails(c)
    return df.withColumn(content, c).where(F.length(content) > 1)
