import itertools
import json

import pytest
from pyspark.sql import functions as F

from corpusmill.functions import html, latex, markdown, ocr
from corpusmill.operators import chunking, cleaning, dedup, embedding, extraction, filters, metadata, perplexity, pii


def docs(spark, *texts, **more):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, content string")


def ids(df):
    return sorted(r["doc_id"] for r in df.select("doc_id").collect())


def test_length_filter_bounds(spark):
    d = docs(spark, "a b", "a b c", "a b c d", "", None)
    assert ids(filters.length_filter(d, 3)) == [2]
    assert ids(filters.length_filter(d, 3, action="discard")) == [0, 1, 3, 4]
    assert ids(filters.length_filter(d, 3, "less")) == [0, 3, 4]
    kept, gone = (filters.length_filter(d, 3, "less", a).count() for a in ("keep", "discard"))
    assert kept + gone == 5
    for wrong in ({"length": None}, {"length": 1, "comparison": "equal"}, {"length": 1, "action": "drop"}):
        with pytest.raises(ValueError):
            filters.length_filter(d, **wrong)


def test_newline_filter(spark):
    assert ids(filters.newline_filter(docs(spark, "a", "a\nb", "a\r\nb\n", None), 1)) == [2]


def test_reference_filter(spark):
    d = spark.createDataFrame([(0, "# References\nx", None), (1, "x", ["Acknowledgement "]), (2, "x", ["#References"]), (3, None, [])], "doc_id bigint, content string, headers array<string>")
    assert ids(filters.reference_filter(d)) == [2, 3]
    assert ids(filters.reference_filter(d, "keep")) == [0, 1]
    assert ids(filters.reference_filter(d.drop("headers"))) == [1, 2, 3]


def test_pii_filter(spark):
    d = spark.createDataFrame([(0, "[PERSON] a", None), (1, "[PERSON] a", ["An abstract view"]), (2, "a b", None), (3, "", None), (4, "# Introduction\n[PERSON]", None), (5, "x[EMAIL_ADDRESS]y a", None)], "doc_id bigint, content string, headers array<string>")
    assert ids(filters.pii_filter(d, 0.5)) == [1, 2, 3, 4]
    assert ids(filters.pii_filter(d, 0.5, apply_filter=False)) == [0, 1, 2, 3, 4, 5]
    assert ids(filters.pii_filter(d, 0.5, "keep")) == [0, 1, 4, 5]


def test_anti_join_ignores_nulls(spark):
    d = docs(spark, "a", "b")
    seen = spark.createDataFrame([(1,), (1,), (None,)], "doc_id bigint")
    assert ids(filters.not_in(d, seen, "doc_id")) == [0]


def test_exact_dedup(spark):
    d = docs(spark, "a", "b", "a", "a", None, "")
    assert ids(dedup.exact_dedup(d)) == [0, 1, 4]
    assert dedup.exact_dedup(dedup.exact_dedup(d)).count() == 3
    assert dedup.exact_dedup(d.limit(0)).count() == 0
    with pytest.raises(ValueError):
        dedup.deduplicate(d, "other")


def greedy(keys, bands):
    """The pass in key order, document by document."""
    near = {k: {o for o in keys if o != k and bands[k] and bands[o] and set(bands[k]) & set(bands[o])} for k in keys}
    done, gone = set(), set()
    for k in sorted(keys):
        if k not in done and near[k]:
            group = sorted({k} | near[k])
            gone |= set(group[1:])
            done |= set(group)
    return sorted(gone)


def test_near_dedup_is_the_greedy_pass(spark):
    import random

    rng = random.Random(5)
    base = [[f"w{rng.randint(0, 60)}" for _ in range(40)] for _ in range(6)]
    texts = []
    for _ in range(60):
        words = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 2, 4, 8])):
            words[rng.randrange(len(words))] = f"n{rng.randint(0, 999)}"
        texts.append(" ".join(words))
    texts += ["short", "", None, "two words"]
    d = docs(spark, *texts).repartition(3)
    b, r = dedup.bands_for(0.6, 64)
    rows = d.select(F.col("doc_id").alias("key"), F.col("content").alias("text")).mapInArrow(dedup._band_keys(3, 64, b, r), "key bigint, bands array<binary>, signature binary").collect()
    bands = {row["key"]: [bytes(x) for x in row["bands"]] if row["bands"] else [] for row in rows}
    gone = greedy(list(bands), bands)
    assert gone
    assert ids(dedup.near_dedup(d, 3, 64, 0.6)) == [k for k in sorted(bands) if k not in gone]
    assert ids(dedup.near_dedup(d.limit(0))) == []


def test_short_documents(spark):
    d = docs(spark, "one", "two words", "a b c d e f", "", None)
    assert dedup.near_dedup(d).count() == 5
    assert ids(dedup.near_dedup(d, short_docs="collide")) == [0, 2]


def test_band_parameters():
    assert [dedup.bands_for(t, 128) for t in (0.5, 0.7, 0.8, 0.9)] == [(25, 5), (14, 9), (9, 13), (5, 25)]


def test_mask_persons_and_mails(spark):
    d = docs(spark, "Ann writes to bob@example.org.", "x", None)

    def find(texts):
        return [[(0, 3), (1, 3)] if t.startswith("Ann") else [] for t in texts]

    got = pii.mask_pii(d, recognizer=find).collect()
    assert [r["content"] for r in got] == ["[PERSON] writes to [EMAIL_ADDRESS]."]


def test_clean_keeps_blank_and_null(spark):
    d = docs(spark, "same line here\nsame line here\n\n10km\n*\n", "  ", None)
    rows = {r["doc_id"]: r for r in cleaning.clean(d, [*cleaning.PROCESSORS, "latex"]).collect()}
    assert rows[0]["content"] == "same line here\n\n10 km"
    assert rows[0]["cleaning"]["duplicates_removed"] == 1 and len(rows[0]["content_changes"]) == 4
    assert rows[1]["content"] == "  " and rows[2]["content"] is None
    assert rows[1]["content_changes"] == [] and not rows[2]["cleaning"]["ocr_processed"]
    with pytest.raises(ValueError):
        cleaning.clean(d, ["spelling"])


def subsequence(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        old = 0
        for j, y in enumerate(b, 1):
            old, row[j] = row[j], old + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def test_common_subsequence():
    import random

    rng = random.Random(2)
    for _ in range(200):
        a, b = ("".join(rng.choices("abcd", k=rng.randint(0, 30))) for _ in range(2))
        assert ocr.common_length(ocr.places(a), len(a), b) == subsequence(a, b)


def test_ocr_post_processing():
    long = "a long sentence that is about the weather in spring"
    assert ocr.drop_repetitions(f"{long}. Other. {long}. End") == f"{long}. Other. End"
    assert ocr.drop_reference_sections("a\n## References\nx\ny\n## Next\nz") == "a\n\n\n[MISSING_PAGE_POST]\n\n\n## Next\nz"
    assert ocr.split_bullets("x\n- one two - three four") == "x\n- one two\n- three four\n"
    assert ocr.markdown_fixes("a$x$b") == "a $x$ b"
    assert ocr.post_process("Text\n## Hallucinated") == "Text"
    assert ocr.post_process("(1) \\[x\\]\nend") == "\\[x \\tag{1}\\]\nend"


def test_latex_problems():
    assert [latex.problem(f) for f in ("a_{b}", r"\{", None)] == [None, None, None]
    assert all(latex.problem(f) for f in ("a_{b", "}", r"\begin{a}\end{b}", r"\begin{a}", r"\left( x", "$"))


def test_latex_correction_is_literal(spark):
    d = docs(spark, r"see $\frac{a$ and $b$", "none")
    got = {r["doc_id"]: r for r in latex.correct(d, lambda f, p, t: r"\frac{a}").collect()}
    assert got[0]["content"] == r"see $\frac{a}$ and $b$" and got[0]["latex_corrections_made"] == 1
    assert got[1]["content"] == "none"


MARKDOWN = "intro text\n# A\nunder a\n## B\nunder b\n```\n# no header\n```\n# C\n## D\nunder d"


def test_sections():
    got = markdown.sections(MARKDOWN, {1, 2, 3, 4, 5, 6})
    assert [c.headers for c in got] == [{}, {1: "A"}, {1: "A", 2: "B"}, {1: "C", 2: "D"}]
    assert got[3].text == "# C\n## D\nunder d" and "# no header" in got[2].text
    assert len(markdown.sections(MARKDOWN, {1})) == 3


def test_whole_spans():
    text = r"a \begin{a}x\begin{a}y\end{a}z\end{a} b \begin{q} | " + "\n|a|b|\n|c|d|\nend"
    spans = [text[a:b] for a, b in markdown.whole_spans(text)]
    assert spans == [r"\begin{a}x\begin{a}y\end{a}z\end{a}", "|a|b|\n|c|d|\n"]


def test_sentences():
    assert markdown.sentences("It is so. See Fig. 2: here. $a. B$ ok! Dr. Who said e.g. This? Yes.") == ["It is so.", "See Fig. 2: here.", "$a. B$ ok!", "Dr. Who said e.g. This?", "Yes."]


def test_packing_and_overlap():
    text = " ".join(f"Word{i} is here." for i in range(30))
    pieces = markdown.packed(text, 10)
    assert all(len(p.split()) <= 10 for p in pieces) and " ".join(pieces) == text
    over = markdown.packed(text, 10, overlap=5)
    assert over[1] == pieces[0][-5:] + pieces[1]
    assert markdown.packed("one " * 20, 5) == [("one " * 20).strip()]


def test_merging():
    c = markdown.Chunk
    got = markdown.merged([c("a", {1: "x"}), c("b", {2: "y"}), c("d", {1: "z"}), c("e " * 10, {1: "w"})], 5)
    assert [x.text for x in got] == ["a\n\nb\n\nd", "e " * 10]
    assert [x.text for x in markdown.merged([c("a", {2: "x"}), c("b", {1: "y"})], 5)] == ["a", "b"]


def test_chunk_rows(spark):
    d = spark.createDataFrame([(0, MARKDOWN, None), (1, None, None), (2, " ", None), (3, "text", ["own"])], "doc_id bigint, content string, headers array<string>")
    rows = chunking.chunk_documents(d, merge_small_chunks=False, add_headers=True).orderBy("doc_id", "chunk_index").collect()
    assert [(r["doc_id"], r["chunk_index"]) for r in rows] == [(0, 0), (0, 1), (0, 2), (0, 3), (3, 0)]
    assert rows[2]["headers"] == ["#A", "##B"] and rows[2]["content"].startswith("# A\n## B\n")
    assert rows[4]["headers"] == ["own"]
    with pytest.raises(TypeError):
        chunking.chunk_documents(d, size=3)


def test_extraction(spark):
    page = b"<html><head><title>T</title></head><body><nav>menu</nav><p>One &amp; two</p><script>x</script><table><tr><td>a</td><td>b</td></tr></table><!-- c --></body></html>"
    rows = [("h", "html", "", page), ("x", "xml", "", b"<a>one<b>two</b>\n\n\n\nthree</a>"), ("bad", "xml", "", b"<a>"), ("m", "md", "", "größe".encode("latin-1")), ("p", "pdf", "", b"%PDF"), ("j", "md", "has content", None), ("e", "md", "", b"")]
    d = spark.createDataFrame(rows, "doc_id string, file_format string, content string, bytes binary")
    got = {r["doc_id"]: r["content"] for r in extraction.extract(d).collect()}
    assert got == {"h": "One & two\na | b", "x": "onetwo\n\nthree", "m": "größe", "j": "has content"}
    got = {r["doc_id"]: r["content"] for r in extraction.extract(d, pdf_service=lambda b: "text of a pdf").collect()}
    assert got["p"] == "text of a pdf"
    assert html.main_text("") is None and html.xml_text(None) is None


def test_metadata(spark):
    d = spark.createDataFrame([("/x/my_file-1.md", "md", "text", None), ("/x/a.html", "html", "c", "<title>The title</title>"), ("/x/b.csv", "csv", "c", None)], "file_path string, file_format string, content string, raw_html string")
    rows = {r["file_format"]: r for r in metadata.extract_metadata(d).collect()}
    assert (rows["md"]["title"], rows["html"]["title"], rows["csv"]["title"]) == ("my file 1", "The title", None)
    flat = {r["filename"]: r["has_extracted_metadata"] for r in metadata.metadata_rows(metadata.extract_metadata(d)).collect()}
    assert flat == {"my_file-1.md": False, "a.html": True, "b.csv": False}


def test_sidecars_and_bibliography(spark):
    d = spark.createDataFrame([("/x/p.pdf", "pdf"), ("/x/q.pdf", "pdf"), ("/x/r.pdf", "pdf")], "file_path string, file_format string")
    layout = json.dumps([{"text": "Short", "text_level": 1}, {"text": "The longest title", "text_level": 1}, {"text": "A much longer body text", "text_level": 2}])
    side = spark.createDataFrame([("p", "doi: 10.1234/ab.5 ", layout), ("q", "arXiv:2401.10001v2 ", "[]")], "stem string, text string, layout string")
    joined = metadata.with_sidecars(d, side)

    def fetch(path):
        work = {"title": ["T"], "author": [{"given": "A", "family": "B"}, {"family": "C"}], "issued": {"date-parts": [[2020, 1]]}, "DOI": "10.1/x", "is-referenced-by-count": 3}
        return {"message": {"items": [work]}} if "query=" in path else {"message": work} if path.startswith("works/10.") else None

    got = {r["file_path"]: r for r in metadata.with_bibliography(joined, fetch).collect()}
    assert got["/x/p.pdf"]["layout_title"] == "The longest title" and got["/x/q.pdf"]["layout_title"] == "NA"
    assert got["/x/p.pdf"]["bibliography"]["authors"] == "A B, C" and got["/x/p.pdf"]["bibliography"]["year"] == "2020"
    assert got["/x/q.pdf"]["bibliography"]["title"] == "T" and got["/x/r.pdf"]["bibliography"] is None


def test_embedding_and_upload(spark, tmp_path):
    d = docs(spark, "a b", "a b", "", None).withColumn("filename", F.concat(F.lit("f"), "doc_id"))
    out = embedding.embed(d, embedding.hashing_embedder(8), batch_size=1)
    assert all(len(r["embedding"]) == 8 for r in out.collect())
    path = str(tmp_path / "points")
    assert embedding.upload(out, path, use_existing_embeddings=True) == 4
    assert embedding.upload(out, path, use_existing_embeddings=True) == 0
    assert spark.read.parquet(path).count() == 4


def test_years(spark):
    d = spark.createDataFrame([("2020",), ("2020.0",), ("n/a",), (None,)], "y string")
    assert [r[0] for r in d.select(embedding.year_number(F.col("y"))).collect()] == [2020, 2020, None, None]


def test_windowed_perplexity():
    counted = []

    def loss(ids, new):
        counted.append((len(ids), new))
        return 1.0

    assert perplexity.windowed(list(range(10)), loss, stride=4, max_length=6) == pytest.approx(2.718281828)
    assert counted == [(6, 6), (6, 4)]
    assert perplexity.windowed([1], loss) is None and perplexity.windowed([], loss) is None


def test_model_perplexity(spark):
    d = docs(spark, "abc", "", None)
    scored = perplexity.model_perplexity(d, lambda: lambda t: float(len(t)))
    assert [r["perplexity"] for r in scored.orderBy("doc_id").collect()] == [3.0, None, None]
    assert ids(perplexity.perplexity_filter(scored, 5, True)) == [0]
    assert perplexity.unigram_perplexity(d).count() == 3


def test_every_pair_of_keep_and_discard_adds_up(spark):
    d = docs(spark, *("w " * i + "\n" * (i % 3) for i in range(12)))
    for f, (comparison, limit) in itertools.product((filters.length_filter, filters.newline_filter), (("greater", 1), ("less", 2))):
        assert sum(f(d, limit, comparison, a).count() for a in ("keep", "discard")) == 12


def test_ocr_ends_and_sections():
    for text, padded in ((".", ".\n\n"), ("A", "A "), ("# x", "\n\n# x"), ("**b**", "\n\n**b**"), ("a\nFigure 1", "a\nFigure 1\n\n"), ("plain", "plain"), ("a}", "a}\n\n"), ("\\begin{x}", "\n\n\\begin{x}\n\n"), ("\\begin x", "\n\n\\begin x"), ("", "")):
        assert ocr.pad_ends(text) == padded
    assert ocr.drop_reference_sections("a\n  ## REFERENCES and more\nx\n## References\ny") == "a\n\n\n[MISSING_PAGE_POST]\n\n\n\n\n[MISSING_PAGE_POST]\n\n"
    assert ocr.drop_reference_sections("see ## References\n\n[MISSING_PAGE_POST:3]") == "see \n\n[MISSING_PAGE_POST:3]"
    assert ocr.drop_monster_tables("a\n" + "x & " * 401 + "\nb") == "a\n\nb"


def test_ocr_bullets():
    for text, split in (
        ("- a b - c d", "- a b\n- c d\n"),
        ("no bullet - here", "no bullet - here"),
        ("x\n* a b - c d\ny", "x\n* c d\ny"),
        ("x\n- 1.2 one - 1 two - three\ny", "x\n\t- 1.2 one\n- 1 two\ny"),
        ("x\n- a b -  - c d\ny", "x\n- a b\n- c d\ny"),
    ):
        assert ocr.split_bullets(text) == split


def test_repeated_sentences_against_all_pairs():
    import random

    rng = random.Random(4)
    for _ in range(30):
        parts = [" ".join(rng.choices(["alpha", "beta", "gamma", "zzzzzz", "qqq", "x"], k=rng.randint(2, 14))) for _ in range(25)]
        parts += rng.choices(parts, k=5)
        kept, held = [], []
        for p in parts:
            repeat = len(p) >= 30 and any(2 * subsequence(p, h) > 0.5 * (len(p) + len(h)) for h in held)
            held += [p] if len(p) >= 30 else []
            kept += [] if repeat else [p]
        assert ocr.drop_repetitions(".".join(parts)) == ".".join(kept)


def test_header_lines_above_a_chunk():
    made = markdown.with_headers(markdown.Chunk("text\n## B", {1: "A", 2: "B", 3: "C", 4: "A"}))
    assert made.text == "### C\n#### A\ntext\n## B"  # "# A" is within "#### A"


def test_html_that_leaves_end_tags_out():
    for page, text in (
        ("<html><head><title>t</title><body><p>Body text</p>", "Body text"),
        ("<head><meta charset=x><style>p{}</style><p>one<p>two", "one\ntwo"),
        ("<div><nav><a>x</a></div><p>kept</p>", "kept"),
        ("<body><form><p>hidden</body>", None),
        ("<nav><ul><li>a<li>b</ul></nav><main>m</main>", "m"),
        ("<nav><ul><li>a<article>kept", "kept"),
        ("<script>var a='<p>'</script><p>x</p><footer>f</footer>", "x"),
    ):
        assert html.main_text(page) == text


def test_bibliographic_record():
    from corpusmill.operators import metadata

    item = {"title": ["T", "U"], "author": [{"given": "A", "family": "B"}, {"family": "C"}, "D"], "issued": {"date-parts": [[2020, 1]]}, "publisher": "P", "container-title": [], "DOI": "10.1/x", "is-referenced-by-count": 0}
    assert metadata.crossref_record(item) == {"title": "T", "authors": "A B, C", "year": "2020", "publisher": "P", "journal": None, "pub_url": None, "doi": "10.1/x", "citation_count": 0}
    assert set(metadata.crossref_record({}).values()) == {None}


def test_no_local_scratch_on_a_cluster():
    from corpusmill.scratch import shared_dir

    class Session:
        class conf:
            get = staticmethod(lambda key, default=None: default)

        class sparkContext:
            master, applicationId, getCheckpointDir = "yarn", "a", staticmethod(lambda: None)

    for master in ("yarn", "local-cluster[3,2,1000]", "spark://h:7077"):
        Session.sparkContext.master = master
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            shared_dir(Session)
    Session.sparkContext.master = "local[4]"
    assert shared_dir(Session).startswith("file://")
    Session.sparkContext.master, Session.sparkContext.getCheckpointDir = "yarn", staticmethod(lambda: "hdfs://h/c")
    assert shared_dir(Session).startswith("hdfs://h/c/")


@pytest.mark.parametrize("common", [1, 3, 1000])
def test_unigram_perplexity_by_broadcast_and_by_shuffle(spark, monkeypatch, common):
    """Whatever the number of broadcast words, long words among them or not, losses are those over all words."""
    import math
    from collections import Counter

    monkeypatch.setattr(perplexity, "COMMON", common)
    texts = ["a a b", "A c " + "x" * 70, "d", "", None, "b c a " + "x" * 70 + " a"]
    counts = Counter(w for t in texts for w in (t or "").lower().split())
    total = sum(counts.values()) + len(counts)
    want = [math.exp(sum(-math.log((counts[w] + 1) / total) for w in t.lower().split()) / len(t.split())) if t else None for t in texts]
    got = {r["doc_id"]: r["perplexity"] for r in perplexity.unigram_perplexity(spark.createDataFrame(list(enumerate(texts)), "doc_id long, content string")).collect()}
    assert [got[i] for i in range(len(texts))] == [w if w is None else pytest.approx(w, rel=1e-12) for w in want]


def test_signatures_by_blocks():
    """Signatures from blocks that stay in a core's cache are those from all shingles at once."""
    import hashlib

    import numpy as np
    import pyarrow as pa

    assert dedup.BLOCK * 128 * 8 <= 1 << 20
    texts = [" ".join(f"w{(i * k) % 1009}" for i in range(1 + 700 * k)) for k in range(4)] + [None]
    out = list(dedup._band_keys(3, 128, 9, 13)([pa.record_batch({"k": pa.array(range(5)), "t": pa.array(texts)})]))[0]
    for text, got in zip(texts, out.column(2).to_pylist()):
        w = (text or "").split()
        grams = {" ".join(w[i : i + 3]) for i in range(len(w) - 2)}
        h = np.array([int(hashlib.md5(g.encode()).hexdigest()[:8], 16) for g in grams], np.uint64)
        a, b = (x.astype(np.uint64)[:, None] for x in dedup.permutations(128))
        want = hashlib.blake2b(((a * h + b) % np.uint64(dedup.PRIME)).min(1).tobytes(), digest_size=16).digest() if grams else None
        assert got == want
