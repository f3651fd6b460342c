"""Python text functions work on small pieces of a batch."""

import pyarrow as pa

from corpusmill import batches
from corpusmill.functions import html, markdown, ocr
from corpusmill.operators import chunking, cleaning, extraction


def made(udf, texts):
    """What a worker sends back for one batch of Spark's."""
    return list(udf.func(iter([pa.array(texts, pa.string())])))


def in_pieces(udf, f, text):
    """A batch of 4 MB comes back in pieces of about 1 MB, the same as text by text."""
    texts = [text * (20_000 // len(text))] * 200 + [None, ""]
    out = made(udf, texts)
    assert len(out) > 3 and sum(map(len, out)) == len(texts)
    assert [v for part in out for v in part.to_pylist()] == [f(texts[0])] * 200 + [None, f("")]


def test_pieces():
    texts = pa.array(["x" * 10, None, "", "y" * 100, "z"])
    assert [p.to_pylist() for p in batches.pieces(texts.slice(1), 40)] == [[None, ""], ["y" * 100], ["z"]]
    assert list(batches.pieces(texts.slice(0, 0))) == []


def test_nougat_in_pieces():
    in_pieces(cleaning._post_processed, ocr.post_process, "A sentence of some length that is repeated. ")


def test_html_in_pieces():
    for udf, f in ((extraction._html, html.main_text), (extraction._xml, html.xml_text)):
        in_pieces(udf, f, "<p>some <b>bold</b> text</p>")


def test_chunks_in_pieces():
    texts = ["# Head\n\nA sentence of some length. " * 600] * 200
    out = made(chunking.splitter(max_chunk_size=512), texts)
    assert len(out) > 3 and sum(map(len, out)) == len(texts)
    want = [{"content": c.text, "headers": ["#Head"]} for c in markdown.chunk(texts[0])]
    assert all(v == want for part in out for v in part.to_pylist())
