import itertools
import zlib

import numpy as np
import pytest

from corpusmill.llm import pack


def test_fullest_bin():
    rng = np.random.default_rng(1)
    for _ in range(60):
        counts = np.zeros(21, np.int64)
        for n in rng.integers(1, 21, rng.integers(1, 9)):
            counts[n] += 1
        first = int(np.flatnonzero(counts)[-1])
        chosen = pack.fullest(counts, first, 20)
        assert all(k <= counts[n] for n, k in chosen) and dict(chosen)[first] >= 1
        rest = [n for n in range(21) for _ in range(counts[n] - (n == first))]
        best = max(s for r in range(len(rest) + 1) for c in itertools.combinations(rest, r) if (s := first + sum(c)) <= 20)
        assert sum(n * k for n, k in chosen) == best


def test_patterns_use_every_piece():
    counts = np.random.default_rng(2).integers(0, 50, 101)
    counts[0] = 0
    used = np.zeros(101, np.int64)
    for pieces, times in pack.patterns(counts, 100):
        assert sum(n * k for n, k in pieces) <= 100
        for n, k in pieces:
            used[n] += k * times
    assert (used == counts).all()


def checked(rows, docs, limit, encode):
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    for doc_id, text in docs:
        ids = [*encode(text or ""), 2]
        pieces = sorted(by_doc[doc_id], key=lambda r: r["piece"])
        assert [p["piece"] for p in pieces] == list(range(-(-len(ids) // limit)))
        at = 0
        for p in pieces:
            part = ids[at : at + p["length"]]
            assert p["start"] == at and p["ids_crc32"] == zlib.crc32(np.array(part, "<u4").tobytes())
            assert p["length"] == limit or p["piece"] == 0
            at += p["length"]
        assert at == len(ids)
    for s in by_sequence.values():
        at = 0
        for p in sorted(s, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= limit
    return len(by_sequence)


def encoder():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(pack.public_paths()[0])
    return lambda text: t.encode(text, add_special_tokens=False).ids


def test_edge_cases(spark):
    texts = [None, "", "a", "word " * 3000, "<|endoftext|> in <|endoftext|> text", "ü" * 50, "\n\n  \t x", "x" * 5000, "日本語 ☃ 🙂"]
    docs = list(enumerate(texts))
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    rows = pack.pack(frame, *pack.public_paths(), limit=64).collect()
    checked(rows, docs, 64, encoder())
    assert all(len(r["ids"]) == r["length"] for r in rows)


def test_repeated_and_null_ids(spark):
    frame = spark.createDataFrame([(None, "a b"), (None, "a b"), (1, "c"), (1, "c")], "doc_id bigint, text string")
    rows = pack.pack(frame, *pack.public_paths()).collect()
    assert len(rows) == 4 and len({r["sequence_id"] for r in rows}) == 1 and sorted(r["offset"] for r in rows)[0] == 0


def test_empty(spark):
    assert pack.pack(spark.createDataFrame([], "doc_id bigint, text string"), *pack.public_paths()).count() == 0


def test_query_is_near_the_bound(spark, small):
    docs = [(r[0], r[1]) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    rows = pack.op6_pack(spark, small).collect()
    bins = checked(rows, docs, 1024, encoder())
    assert bins <= -(-sum(r["length"] for r in rows) // 1024) + 3


def test_a_limit_of_one_token(spark):
    frame = spark.createDataFrame([(1, "a b c")], "doc_id bigint, text string")
    assert pack.pack(frame, *pack.public_paths(), limit=1).count() == len(encoder()("a b c")) + 1


def test_missing_tokenizer(spark):
    frame = spark.createDataFrame([(1, "a")], "doc_id bigint, text string")
    with pytest.raises(Exception):
        pack.pack(frame, "/nowhere.json").count()
