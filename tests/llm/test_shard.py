import zlib

import numpy as np

from corpusmill.llm import shard


def test_fisher_yates_is_a_permutation_and_uniform():
    assert shard.fisher_yates(0, [1]).tolist() == [] and shard.fisher_yates(1, [1]).tolist() == [0]
    seen = np.zeros((4, 4))
    for seed in range(4000):
        p = shard.fisher_yates(4, [seed, 0, 0])
        assert sorted(p) == [0, 1, 2, 3]
        seen[np.arange(4), p] += 1
    assert (abs(seen - 1000) < 150).all()


def test_round_trip(spark):
    rows = [(i, f"text {i}" * (i % 7), "x") for i in range(500)] + [(500, None, "x"), (None, "n", "x"), (None, None, "y"), (7, "text 7", "x"), (7, "text 7", "x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, shard string").repartition(4)
    got = shard.with_slots(shard.write_shards(docs, 8, bucket_bytes=100)).collect()
    assert sorted(((r["row"]["doc_id"], r["text"], r["row"]["shard"]) for r in got), key=repr) == sorted(rows, key=repr)
    for s in range(8):
        slots = sorted(r["slot"] for r in got if r["shard"] == s)
        assert slots == list(range(len(slots))) and slots
    of = {}
    for r in got:
        of.setdefault(r["row"]["doc_id"], set()).add((r["shard"], r["grown_shard"]))
        assert r["grown_shard"] in (r["shard"], 8)
    assert all(len(v) == 1 for v in of.values())
    again = shard.with_slots(shard.write_shards(docs.where("doc_id < 500"), 9, bucket_bytes=100)).collect()
    assert all({r["shard"]} == {g for _, g in of[r["row"]["doc_id"]]} for r in again)


def test_copies_are_not_neighbours(spark):
    docs = spark.createDataFrame([(i, "copy" if i < 400 else f"t{i}") for i in range(1200)], "doc_id bigint, text string")
    got = sorted((r["shard"], r["slot"], r["text"] == "copy") for r in shard.with_slots(shard.write_shards(docs)).collect())
    runs = sum(1 for a, b in zip(got, got[1:]) if a[2] and b[2])
    assert 80 < runs < 190  # 400 * 1/3 expected


def test_empty(spark):
    assert shard.with_slots(shard.write_shards(spark.createDataFrame([], "doc_id bigint, text string"))).count() == 0


def test_query(spark, small):
    docs = {r[0]: r[1] for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()}
    got = shard.op5_shard(spark, small).collect()
    assert {(r["doc_id"], r["size"], r["text_crc32"], r["law"]) for r in got} == {(d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode()), "key") for d, t in docs.items()}
