"""Column functions against Python's own."""

import hashlib
import random
import re

from pyspark.sql import functions as F

from corpusmill.functions import text as X

PIECES = ["a", "Word", "ü", "é", "٣ab", "10km", "5x", "3GHz", "x_1", "-", "·", "²", " ", "  ", "\t", "\n", "\n\n\n", "\r\n", "\xa0", "　", "\x1c", "\x85", "\x0b", "\\", "\\\\\\", "$", "[PERSON]", "*"]


def samples(n=300, seed=1):
    rng = random.Random(seed)
    return ["", " ", "\n", "  lead trail \n", "a\xa0b c"] + ["".join(rng.choices(PIECES, k=rng.randint(1, 25))) for _ in range(n)]


def apply(spark, column, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    return [r[1] for r in df.select("i", column(F.col("t"))).orderBy("i").collect()]


def test_words_lines_and_strip(spark):
    texts = samples()
    assert apply(spark, X.word_count, texts) == [len(t.split()) for t in texts]
    assert apply(spark, X.words, texts) == [t.split() for t in texts]
    assert apply(spark, X.newline_count, texts) == [t.count("\n") for t in texts]
    assert apply(spark, X.strip, texts) == [t.strip() for t in texts]
    assert apply(spark, X.is_blank, texts) == [not t.strip() for t in texts]
    assert apply(spark, lambda c: X.occurrences(c, "[PERSON]"), texts) == [t.count("[PERSON]") for t in texts]


def test_null_counts_as_empty(spark):
    assert apply(spark, X.word_count, [None]) == [0]
    assert apply(spark, X.newline_count, [None]) == [0]
    assert apply(spark, X.rule_clean, [None]) == [None]


def test_cleaning_rules(spark):
    texts = samples()
    assert apply(spark, X.space_digits, texts) == [re.sub(r"(\d+)([A-Za-z]{2,})", r"\1 \2", t) for t in texts]
    assert apply(spark, X.halve_backslashes, texts) == [re.sub(r"\\{2,}", lambda m: m[0][: len(m[0]) // 2], t) for t in texts]
    assert apply(spark, X.squeeze_newlines, texts) == [re.sub(r"\n{3,}", "\n\n", t) for t in texts]

    def no_symbols(t):
        return "\n".join(x for x in t.split("\n") if len(x.strip()) != 1 or re.search(r"\w", x))

    assert apply(spark, X.drop_symbol_lines, texts) == [no_symbols(t) for t in texts]


def sequential(text, threshold=0.99, least=2):
    """Line by line: the next line with words decides, and a dropped line takes the blank ones after it along."""
    lines, out, i = text.split("\n"), [], 0
    while i < len(lines):
        a = lines[i].lower().split()
        j = next((j for j in range(i + 1, len(lines)) if lines[j].strip()), None)
        b = lines[j].lower().split() if j is not None else []
        both = len(set(a) & set(b))
        if len(a) >= least and b and (both / len(set(a)) >= threshold or both / len(set(b)) >= threshold):
            i = j
        else:
            out.append(lines[i])
            i += 1
    return "\n".join(out)


def test_repeated_lines(spark):
    rng = random.Random(3)
    lines = ["the same line", "The same line", "same the line here", "other", "two words", "", " ", "x"]
    texts = ["\n".join(rng.choices(lines, k=rng.randint(1, 9))) for _ in range(400)] + samples(100)
    assert apply(spark, X.drop_repeated_lines, texts) == [sequential(t) for t in texts]


def test_headers(spark):
    yes = ["#references", "\n\n  ##  Reference list", "text\r\n# REFERENCES\r\nmore"]
    no = ["# referencesX", "####### references", "references", "# Réf"]
    assert apply(spark, lambda c: c.rlike(X.REFERENCE_HEADER), yes + no) == [True] * 3 + [False] * 4


def test_latex(spark):
    text = r"a $x$ $$y$$ \(z\) \[ w \] \begin{eq} b \end{eq}"
    [found] = apply(spark, X.latex_formulas, [text])
    assert [(f["kind"], f["formula"]) for f in found] == [("inline", "x"), ("display", "y"), ("bracket", "z"), ("square_bracket", "w"), ("environment", r"\begin{eq}b\end{eq}")]


def test_titles(spark):
    pages = ["<title>A &amp; <b>B</b>\n C</title>", "<TITLE x='1'> 1234 </TITLE>", "<title>ab</title>", "none", None, "<title>first</title><title>second</title>"]
    assert apply(spark, X.html_title, pages) == ["A B C", None, None, None, None, "first"]


def test_identifiers(spark):
    got = apply(spark, X.identifier, ["see doi: 10.1234/ab.5 x", "arXiv:2401.10001v2 y", "ISBN 9781234567897", "none"])
    assert [(r["id_type"], r["identifier"]) for r in got] == [("doi", "10.1234/ab.5"), ("arxiv", "2401.10001"), ("isbn", "ISBN 9781234567897"), ("NA", None)]


def test_ids(spark):
    assert [int(x) for x in apply(spark, X.uint_id, ["abc", "ü"])] == [int.from_bytes(hashlib.sha256(s.encode()).digest()[:8], "big") for s in ("abc", "ü")]
    assert apply(spark, lambda c: X.short_id(F.lit("f.md"), c), ["abc"]) == ["f.md_" + hashlib.md5(b"abc").hexdigest()[:8]]
    assert apply(spark, X.stem_title, ["/a/b_c-d.tar.gz", "x/.hidden"]) == ["b c d.tar", ".hidden"]
    assert apply(spark, X.file_format, ["/a/B.HTML", "noext", "/a.b/c"]) == ["html", "", ""]


def test_shingles(spark):
    got = apply(spark, lambda c: X.shingles(c, 3), ["A b c d a b c", "a b", ""])
    assert [sorted(g) for g in got] == [sorted({"a b c", "b c d", "c d a", "d a b"}), [], []]


def test_l2(spark):
    df = spark.createDataFrame([([3.0, 4.0],), ([0.0, 0.0],)], "v array<float>")
    assert [r[0] for r in df.select(X.l2_normalized(F.col("v"))).collect()] == [[0.6, 0.8], [0.0, 0.0]]


def test_sentences_look_back_a_little():
    """Many full stops that end no sentence: each looks at the word before it, not at all of the text since the last end."""
    import time

    from corpusmill.functions import markdown

    assert markdown.sentences("See Fig. 3 and al\n. Then (e.g. this) ends. " + "w" * 40 + ". Next A. Smith et al. say so! End") == ["See Fig. 3 and al\n. Then (e.g. this) ends. " + "w" * 40 + ".", "Next A. Smith et al. say so!", "End"]
    began = time.process_time()
    assert len(markdown.sentences("word al. " * 20_000)) == 1
    assert time.process_time() - began < 2
