import hashlib
import random

import pytest

from corpusmill.llm import suffix_dedup as s


def brute(rows, length):
    """From the definition: bytes covered by a window that also starts in a document of a smaller id."""
    first = {}
    for d, t in rows:
        b = (t or "").encode()
        for i in range(len(b) - length + 1):
            if d is not None:
                w = b[i : i + length]
                first[w] = min(first.get(w, d), d)
    out = []
    for d, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if d is not None and first[b[i : i + length]] < d:
                gone[i : i + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(1 for i in range(len(b)) if gone[i] and (i == 0 or not gone[i - 1]))
        out.append((d, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def rows_of(df):
    return sorted((tuple(r[c] for c in ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")) for r in df.collect()), key=repr)


def cases(seed):
    rng = random.Random(seed)
    shared = ["".join(rng.choices("abé ", k=rng.randint(30, 90))) for _ in range(4)] + ["ab" * 60, "a" * 130]
    rows = []
    for i in range(40):
        parts = [rng.choice(shared) if rng.random() < 0.6 else "".join(rng.choices("abcdé", k=rng.randint(0, 80))) for _ in range(rng.randint(0, 5))]
        rows.append((i if i != 9 else 8, "".join(parts)))
    return rows + [(50, None), (51, ""), (None, shared[0]), (52, shared[0]), (53, shared[0])]


@pytest.mark.parametrize("seed,length,gram,block", [(1, 50, 24, 1 << 30), (2, 50, 24, 700), (3, 20, 8, 300), (4, 50, 50, 500)])
def test_brute_force(spark, seed, length, gram, block):
    rows = cases(seed)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    assert rows_of(s.cut_repeats(docs, length, gram, digest=True, block_bytes=block)) == brute(rows, length)


def test_pieces_of_long_texts(spark, monkeypatch):
    monkeypatch.setattr(s, "PIECE", 211)
    rng = random.Random(8)
    base = "".join(rng.choices("abcdefgh", k=1500))
    rows = [(1, base), (2, "x" + base[100:1300] + "y"), (3, "".join(rng.choices("abcdefgh", k=700)) + base[:300])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert rows_of(s.cut_repeats(docs, digest=True)) == brute(rows, 50)


def test_texts_and_columns(spark):
    text = "é" * 40
    docs = spark.createDataFrame([(1, text, "a", 1.0), (2, "ab" + text, "b", 2.0), (3, None, None, None)], "doc_id int, text string, row string, kept double")
    got = s.cut_repeats(docs)
    assert got.columns == ["doc_id", "text", "row", "kept", "n_removed", "n_spans"]
    rows = {r["doc_id"]: r for r in got.collect()}
    assert (rows[1]["text"], rows[2]["text"], rows[3]["text"]) == (text, "ab", None)
    assert rows[2]["row"] == "b" and rows[2]["kept"] == 2.0


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert s.cut_repeats(docs, digest=True).count() == 0 and s.cut_repeats(docs).count() == 0


def test_merge_compares_no_known_prefix():
    rng = random.Random(4)
    for k in range(1, 9):
        runs = [sorted(bytes(rng.choices(b"ab", k=6)) for _ in range(rng.randint(0, 15))) for _ in range(k)]

        def lcp(a, b):
            return next((i for i in range(6) if a[i] != b[i]), 6)

        inputs = [(r, [0] + [lcp(a, b) for a, b in zip(r, r[1:])]) for r in runs]
        came, lcps = s.merge_runs(inputs, 6)
        cursor, out = [0] * k, []
        for run in came:
            out.append(runs[run][cursor[run]])
            cursor[run] += 1
        assert out == sorted(x for r in runs for x in r)
        assert lcps[1:] == [lcp(a, b) for a, b in zip(out, out[1:])]


def test_query(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()
    assert rows_of(s.op3_suffix_dedup(spark, small)) == brute([(r[0], r[1]) for r in docs], 50)
