"""Column functions on text. Whitespace, words and letters are those of Python's str methods; built-in functions only.

A null text counts as empty wherever a count is asked for, and stays null where a text is returned.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The patterns below decide results and are shared with the SQL twins where RE2 can express them.
SPACE = r"\s\x0b\x1c-\x1f\x85\p{Z}"  # str.split() and str.strip() white space, inside a character class
WORD = r"\p{L}\p{N}_"  # \w
WS = f"[{SPACE}]+"
REFERENCE_HEADER = rf"(?im)^[{SPACE}]*#{{1,6}}[{SPACE}]*references?\b.*$"
ACKNOWLEDGEMENT_HEADER = rf"(?im)^[{SPACE}]*#{{1,6}}[{SPACE}]*acknowledgements?\b.*$"
OPENING_HEADER = rf"(?im)^[{SPACE}]*#{{1,6}}[{SPACE}]*(abstract|introduction)\b.*$"
EMAIL = rf"([-a-zA-Z0-9.`?{{}}]+@[{WORD}]+(?:\.[{WORD}]+)+)"
DIGIT_LETTER = r"(\p{Nd}+)([A-Za-z]{2,})"
TRUNCATED = rf"(?s)\+\+\+[{SPACE}]*==WARNING: Truncated because of repetitions==.*?\+\+\+"
NO_OUTPUT = rf"(?s)\+\+\+[{SPACE}]*==ERROR: No output for this page==.*?\+\+\+"
MISSING_PAGE = "[MISSING_PAGE_POST]"
SYMBOL_LINE = rf"^[{SPACE}]*[^{SPACE}{WORD}][{SPACE}]*$"
PERSON_MARK, EMAIL_MARK = "[PERSON]", "[EMAIL_ADDRESS]"
LATEX = {
    "inline": r"(?d)(?<!\$)\$(?!\$)(.+?)(?<!\$)\$(?!\$)",
    "display": r"(?s)\$\$(.*?)\$\$",
    "bracket": r"(?s)\\[(](.*?)\\[)]",
    "square_bracket": r"(?s)\\\[(.*?)\\\]",
    "environment": r"(?s)\\begin\{([^}]+)\}(.*?)\\end\{\1\}",
}
TITLE = r"(?is)<title[^>]*>(.*?)</title>"
META = {
    "description": r"""(?i)<meta[^>]*name=["']description["'][^>]*content=["']([^"']*)["']""",
    "keywords": r"""(?i)<meta[^>]*name=["']keywords["'][^>]*content=["']([^"']*)["']""",
    "author": r"""(?i)<meta[^>]*name=["']author["'][^>]*content=["']([^"']*)["']""",
    "og_title": r"""(?i)<meta[^>]*property=["']og:title["'][^>]*content=["']([^"']*)["']""",
    "og_description": r"""(?i)<meta[^>]*property=["']og:description["'][^>]*content=["']([^"']*)["']""",
    "twitter_title": r"""(?i)<meta[^>]*name=["']twitter:title["'][^>]*content=["']([^"']*)["']""",
}
JSON_LD = r"""(?is)<script[^>]*type=["']application/ld\+json["'][^>]*>(.*?)</script>"""
DOI = (
    r"""(?i)doi[\s\.\:]{0,2}(10\.\d{4}[\d\:\.\-\/a-z]+)(?:[\s\n\"<]|$)""",
    r"""(?i)(10\.\d{4}[\d\:\.\-\/a-z]+)(?:[\s\n\"<]|$)""",
    r"""(?i)(10\.\d{4}[\:\.\-\/a-z]+[\:\.\-\d]+)(?:[\s\na-z\"<]|$)""",
    r"""(?i)https?://[ -~]*doi[ -~]*/(10\.\d{4,9}/[-._;()/:a-z0-9]+)(?:[\s\n\"<]|$)""",
    r"""(?i)^(10\.\d{4,9}/[-._;()/:a-z0-9]+)$""",
)
ARXIV = (
    r"""(?i)arxiv[\s]*\:[\s]*(\d{4}\.\d+)(?:v\d+)?(?:[\s\n\"<]|$)""",
    r"""(?i)(\d{4}\.\d+)(?:v\d+)?(?:\.pdf)""",
    r"""(?i)^(\d{4}\.\d+)(?:v\d+)?$""",
)
ISBN = (
    r"""(?i)(?:ISBN(?:-1[03])?:? )?(?=[0-9X]{10}$|(?=(?:[0-9]+[- ]){3})[- 0-9X]{13}$|97[89][0-9]{10}$)(?:97[89][- ]?)?[0-9]{1,5}[- ]?[0-9]+[- ]?[0-9]+[- ]?[0-9X]""",
    r"""(?i)\bISBN(?:-1[03])?:? (?=[0-9X]{10}$|(?=(?:[0-9]+[- ]){3})[- 0-9X]{13}$|97[89][0-9]{10}$)(?:97[89][- ]?)?[0-9]{1,5}[- ]?[0-9]+[- ]?[0-9]+[- ]?[0-9X]\b""",
)


# ---------------------------------------------------------------- words and lines


def word_count(text: Column) -> Column:
    """len(text.split()): the parts between white space, less an empty one at either end."""
    ends = [F.substring(text, i, 1).rlike(f"^[{SPACE}]$").cast("int") for i in (1, -1)]
    return F.when(F.coalesce(F.length(text), F.lit(0)) == 0, F.lit(0)).otherwise(F.size(F.split(text, WS)) - ends[0] - ends[1]).cast("bigint")


def words(text: Column) -> Column:
    """text.split()"""
    return F.filter(F.split(text, WS), lambda w: w != "")


def newline_count(text: Column) -> Column:
    return F.coalesce(F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))), F.lit(0)).cast("bigint")


def occurrences(text: Column, mark: str) -> Column:
    """How often a literal mark occurs, without overlaps."""
    return F.coalesce((F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit("")))) / F.lit(len(mark)), F.lit(0)).cast("bigint")


def strip(text: Column) -> Column:
    return F.regexp_replace(text, f"^{WS}|{WS}$", "")


def is_blank(text: Column) -> Column:
    return ~F.coalesce(text, F.lit("")).rlike(f"[^{SPACE}]")


def shingles(text: Column, size: int) -> Column:
    """The distinct runs of ``size`` lower-cased words; fewer words give none."""
    w = words(F.lower(text))
    shifted = F.arrays_zip(*(F.slice(w, F.lit(i + 1), F.greatest(F.size(w) - i, F.lit(0))).alias(f"w{i}") for i in range(size)))
    runs = F.transform(F.slice(shifted, F.lit(1), F.size(w) - size + 1), lambda row: F.concat_ws(" ", *(row[f"w{i}"] for i in range(size))))
    return F.when(F.size(w) >= size, F.array_distinct(runs)).otherwise(F.array().cast("array<string>"))


# ---------------------------------------------------------------- cleaning


def space_digits(text: Column) -> Column:
    """A space between digits and two letters or more that follow."""
    return F.regexp_replace(text, DIGIT_LETTER, "$1 $2")


def halve_backslashes(text: Column) -> Column:
    """Runs of two backslashes or more lose half of them, rounded down to what is left."""
    return F.regexp_replace(text, r"(\\+)\1\\?", "$1")


def remove_artifacts(text: Column) -> Column:
    """Without the OCR engine's warnings, errors and marks of missing pages."""
    return F.replace(F.regexp_replace(F.regexp_replace(text, TRUNCATED, ""), NO_OUTPUT, ""), F.lit(MISSING_PAGE), F.lit(""))


def drop_symbol_lines(text: Column) -> Column:
    """Without lines that hold a single character which is no letter, digit or underscore."""
    return F.array_join(F.filter(F.split(text, "\n", -1), lambda line: ~line.rlike(SYMBOL_LINE)), "\n")


def squeeze_newlines(text: Column) -> Column:
    return F.regexp_replace(text, "\n{3,}", "\n\n")


def drop_repeated_lines(text: Column, threshold: float = 0.99, min_words: int = 2) -> Column:
    """Lines that are nearly repeated by the next line with words, and the blank lines after them, go; the last of a run stays.

    A line goes if it has ``min_words`` words and shares ``threshold`` of the distinct words
    of either. A segment below is a line with words and the blank lines that follow it.
    """
    segments = F.split(text, rf"\n(?=[^\n]*?[^{SPACE}])", -1)
    sets = F.transform(segments, lambda s: F.struct(F.size(words(s)).alias("n"), F.array_distinct(words(F.lower(s))).alias("w")))
    rows = F.arrays_zip(segments.alias("s"), sets.alias("a"), F.slice(sets, F.lit(2), F.size(segments)).alias("b"))

    def stays(row: Column) -> Column:
        a, b = row["a"]["w"], row["b"]["w"]
        both = F.size(F.array_intersect(a, b))
        near = (both / F.size(a) >= threshold) | (both / F.size(b) >= threshold)
        return ~((row["a"]["n"] >= max(1, min_words)) & F.coalesce(F.size(b) > 0, F.lit(False)) & F.coalesce(near, F.lit(False)))

    return F.array_join(F.transform(F.filter(rows, stays), lambda row: row["s"]), "\n")


def rule_clean(text: Column) -> Column:
    return strip(squeeze_newlines(drop_symbol_lines(text)))


def mask_emails(text: Column) -> Column:
    """Texts without an @ hold no address and are left alone, which spares most of them the pattern."""
    return F.when(F.contains(text, F.lit("@")), F.regexp_replace(text, EMAIL, EMAIL_MARK)).otherwise(text)


def latex_formulas(text: Column) -> Column:
    """Formulas by kind, in the order of LATEX: array of (kind, formula); an environment comes with its name around its stripped body."""
    parts = []
    for kind, pattern in LATEX.items():
        if kind == "environment":
            pairs = F.arrays_zip(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)).alias("e"), F.regexp_extract_all(text, F.lit(pattern), F.lit(2)).alias("b"))
            found = F.transform(pairs, lambda p: F.concat(F.lit(r"\begin{"), p["e"], F.lit("}"), strip(p["b"]), F.lit(r"\end{"), p["e"], F.lit("}")))
        else:
            found = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)), strip)
        parts.append(F.transform(found, _of_kind(kind)))
    return F.concat(*parts)


def _of_kind(kind: str):
    return lambda formula: F.struct(F.lit(kind).alias("kind"), formula.alias("formula"))


# ---------------------------------------------------------------- HTML and identifiers


def html_title(html: Column) -> Column:
    """The cleaned text of the first title element; null without one, under three characters, or of digits only."""
    t = F.regexp_extract(html, TITLE, 1)
    for pattern, by in (("<[^>]+>", ""), ("&[a-zA-Z]+;", " "), (r"&#\d+;", " ")):
        t = F.regexp_replace(t, pattern, by)
    t = F.regexp_replace(F.translate(strip(t), "\n\r", "  "), " {2,}", " ")
    return F.when((F.length(t) >= 3) & ~t.rlike(r"^\p{Nd}+$"), t)


def html_meta(html: Column) -> Column:
    """struct of META's fields, null where there is none or only white space."""

    def value(pattern):
        v = strip(F.regexp_extract(html, pattern, 1))
        return F.when(v != "", v)

    return F.struct(*(value(p).alias(k) for k, p in META.items()))


def json_ld_count(html: Column) -> Column:
    return F.coalesce(F.regexp_count(html, F.lit(JSON_LD)), F.lit(0)).cast("bigint")


IDENTIFIERS = {"doi": DOI, "arxiv": ARXIV, "isbn": ISBN}


def _as_re2(pattern: str) -> str:
    """A pattern of DOI or ARXIV that matches here what it does in RE2: $ is the very end, white space has no \\x0b, and letters fold beyond ASCII."""
    for old, new in (("a-z", "a-z\u017f\u212a"), ("[ -~]", "[ -~\u017f\u212a]"), ("https?", "http[s\u017f]?"), (r"\s", r"\t\n\f\r "), ("$", r"\z")):
        pattern = pattern.replace(old, new)
    return pattern


def identifier(text: Column, kinds=("doi", "arxiv", "isbn"), re2: bool = False) -> Column:
    """struct (id_type, identifier) of the first pattern that occurs, by kind in the order of ``kinds``; ("NA", null) else.

    re2: patterns match as in RE2, and so as in SQL engines that use it; it has no form of those of ISBN.
    """
    if re2 and "isbn" in kinds:
        raise ValueError("RE2 can't express the patterns of ISBN")
    kind, found = F.lit("NA"), F.lit(None).cast("string")
    for name in reversed(kinds):
        for pattern in map(_as_re2 if re2 else str, reversed(IDENTIFIERS[name])):
            hit = F.regexp_extract(text, pattern, 0 if name == "isbn" else 1)
            ok = F.coalesce(text.rlike(pattern), F.lit(False))
            kind, found = F.when(ok, F.lit(name)).otherwise(kind), F.when(ok, hit).otherwise(found)
    return F.struct(kind.alias("id_type"), found.alias("identifier"))


def stem_title(path: Column) -> Column:
    """The file's name without its extension, underscores and dashes as spaces."""
    name = F.element_at(F.split(path, "/"), -1)
    return F.translate(F.regexp_replace(name, r"(?<=.)\.[^.]*$", ""), "_-", "  ")


def file_format(path: Column) -> Column:
    return F.lower(F.regexp_extract(path, r"[^/]\.([^./]+)$", 1))


# ---------------------------------------------------------------- ids


def short_id(filename: Column, content: Column) -> Column:
    return F.concat_ws("_", filename, F.substring(F.md5(F.coalesce(content, F.lit(""))), 1, 8))


def uint_id(key: Column) -> Column:
    """The first eight bytes of a key's SHA-256 as an unsigned number."""
    return F.conv(F.substring(F.sha2(key, 256), 1, 16), 16, 10).cast("decimal(20,0)")


def l2_normalized(vector: Column) -> Column:
    """vector divided by its length; a zero vector stays."""
    norm = F.sqrt(F.aggregate(vector, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    return F.transform(vector, lambda x: F.when(norm == 0, x.cast("double")).otherwise(x.cast("double") / norm))
