"""Text of files by format."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..batches import text_udf
from ..functions import html as H


_html = text_udf(H.main_text, T.StringType())
_xml = text_udf(H.xml_text, T.StringType())


def html_text(html: Column) -> Column:
    return _html(html)


def xml_text(xml: Column) -> Column:
    return _xml(xml)


def decoded(content: Column) -> Column:
    """Bytes as UTF-8 where they are that, else as Latin-1."""
    return F.when(F.is_valid_utf8(content), F.decode(content, "UTF-8")).otherwise(F.decode(content, "ISO-8859-1"))


def extract(df: DataFrame, format: str | None = None, pdf_service: Callable[[bytes], str | None] | None = None) -> DataFrame:
    """Fill ``content`` from ``bytes`` by file_format (or ``format`` for all) and keep what is longer than a character.

    Rows that have a content pass. html and xml are parsed, md and txt decoded, pdf goes to a
    service if there is one; other formats, and what can't be parsed, go. raw_html keeps the page.
    """
    kind = F.lit(format) if format else F.col("file_format")
    text = decoded(F.col("bytes"))
    found = F.when(kind == "html", html_text(F.when(kind == "html", text))).when(kind == "xml", xml_text(F.when(kind == "xml", text))).when(kind.isin("md", "txt"), text)
    if pdf_service:

        @F.pandas_udf("string")
        def pdf(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for batch in batches:
                yield batch.map(pdf_service, na_action="ignore")

        found = found.when(kind == "pdf", pdf(F.when(kind == "pdf", F.col("bytes"))))
    has = F.coalesce(F.length("content") > 0, F.lit(False))
    out = df.withColumns({"raw_html": F.when(kind == "html", text), "content": F.when(has, F.col("content")).otherwise(found)})
    return out.drop("bytes").where(F.length("content") > 1)
