import base64
import hashlib
import random

from corpusmill.llm import warc


def table(spark, rows):
    return spark.createDataFrame(rows, "page_id bigint, url string, html string, payload_bytes int")


def test_round_trip(spark):
    rows = [(3, "http://b.org/x y", "same", 1), (1, "https://www.a.org:443/P?q=1#f", "same", 1), (2, None, None, 1), (5, "x", "", 1), (4, "http://a.org/", "größe\r\n\r\nWARC/1.1", 1), (9, "http://a.org/", "same", 1), (None, "http://n.org", "same", 1), (None, "u", "alone", 1), (7, "u", "x" * 300_000, 1), (1, "again", "same", 1)]
    got = warc.capture_index(table(spark, rows)).collect()
    def nulls_first(row):
        return tuple((x is not None, x if x is not None else 0) for x in row)

    by = sorted(((r["page_id"], r["record_type"], r["refers_to"], r["payload_bytes"]) for r in got), key=nulls_first)
    assert by == sorted([(3, "revisit", 1, 4), (1, "response", None, 4), (1, "response", None, 4), (2, "response", None, 0), (5, "revisit", 2, 0), (4, "response", None, 19), (9, "revisit", 1, 4), (None, "revisit", 1, 4), (None, "response", None, 5), (7, "response", None, 300_000)], key=nulls_first)
    want = {p: base64.b32encode(hashlib.sha1((h or "").encode()).digest()).decode() for p, _, h, _ in rows if p is not None}
    assert all(r["payload_digest"] == want[r["page_id"]] for r in got if r["page_id"] is not None)
    assert {r["page_id"]: r["refers_to"] for r in got if r["record_type"] == "revisit" and r["page_id"] is not None} == {3: 1, 5: 2, 9: 1}


def test_small_payloads_are_all_responses(spark):
    got = warc.capture_index(table(spark, [(1, "u", "ab", 0), (2, "u", "ab", 0), (3, "u", "abcd", 0), (4, "u", "abcd", 0)]), least_bytes=3).collect()
    assert {r["page_id"]: r["record_type"] for r in got} == {1: "response", 2: "response", 3: "response", 4: "revisit"}


def test_empty(spark):
    assert warc.capture_index(table(spark, [])).count() == 0


def test_loser_tree():
    rng = random.Random(1)
    for k in range(9):
        runs = [sorted(rng.choices(range(20), k=rng.randint(0, 12))) for _ in range(k)]
        merged = list(warc.LoserTree(runs))
        assert [v for _, v in merged] == sorted(x for r in runs for x in r)
        assert merged == sorted(merged, key=lambda x: (x[1], x[0]))


def test_index_is_globally_ordered(spark, monkeypatch):
    monkeypatch.setattr(warc, "RUN_ROWS", 40)
    rng = random.Random(2)
    rows = [(i, f"http://{rng.choice(['hot.org'] * 4 + ['a.net', 'z.com'])}/{rng.randint(0, 3)}", f"page {i}", 0) for i in range(300)]
    got = warc.capture_index(table(spark, rows).repartition(5)).collect()
    key = [(r["urlkey"], r["captured_at"], r["page_id"]) for r in sorted(got, key=lambda r: (r["part"], r["place"]))]
    assert key == sorted(key) and len(key) == 300 and len({r["part"] for r in got}) > 3


def test_query(spark, small):
    pages = spark.read.parquet(f"{small}/pages.parquet").toPandas()
    got = warc.op1_warc(spark, small).toPandas().set_index("page_id").sort_index()
    first = {}
    for p, h in sorted(zip(pages.page_id, pages.html)):
        first.setdefault(h or "", p)
    for p, h in zip(pages.page_id, pages.html):
        r, body = got.loc[p], (h or "").encode()
        assert (r.payload_bytes, r.payload_digest) == (len(body), base64.b32encode(hashlib.sha1(body).digest()).decode())
        assert (r.record_type, None if r.refers_to != r.refers_to else r.refers_to) == (("response", None) if first[h or ""] == p else ("revisit", first[h or ""]))
    assert len(got) == len(pages)


def test_members_are_read_one_by_one():
    import gzip
    import zlib

    import pytest

    records = [warc._record(i, f"http://a/{i}", "D", "response", None, 0, bytes([65 + i]) * n) for i, n in enumerate([0, 10, 200_000, 3])]
    apart = b"".join(map(warc._members, records))
    got = list(warc.parse_archive(apart))
    assert [b for _, _, b in got] == [bytes([65 + i]) * n for i, n in enumerate([0, 10, 200_000, 3])]
    for (at, _, _), record in zip(got, records):  # each offset leads to its record
        assert zlib.decompressobj(31).decompress(apart[at:]) == record
    together = gzip.compress(b"".join(records))
    assert [(f["WARC-Record-ID"], b) for _, f, b in warc.parse_archive(together)] == [(f["WARC-Record-ID"], b) for _, f, b in got]
    for cut in (apart[:-1], apart[:-30], warc._members(records[2][:-8])):
        with pytest.raises(ValueError, match="cut off"):
            list(warc.parse_archive(cut))


def test_archives_are_bounded_by_bytes(spark, monkeypatch, tmp_path):
    """300 MB of pages that don't compress much, a record of several members among them."""
    from pyspark.sql import functions as F

    monkeypatch.setattr(warc, "MEMBER_BYTES", 1 << 20)
    noise = F.concat(*[F.sha2(F.concat("id", F.lit(f"-{i}")), 512) for i in range(64)])
    pages = spark.range(75).select(F.col("id").alias("page_id"), F.lit("http://a.org/").alias("url"), F.repeat(noise, 512).alias("html"))
    huge = spark.range(1).select(F.lit(1000).alias("page_id"), F.lit("http://b.org/").alias("url"), F.repeat(F.lit("größe"), 1_000_000).alias("html"))
    path = warc.write_archives(pages.unionByName(huge), archive_bytes=200_000)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("length", "content").collect()
    assert len(files) > 5
    for f in files:
        parts = [at for at, _ in warc.gzip_members(bytes(f["content"]))]
        records = {at for at, _, _ in warc.parse_archive(bytes(f["content"]))}
        assert f["length"] <= 200_000 or len(records) == 1
        assert len(parts) >= len(records)
    got = warc.read_archives(spark, path)
    assert got.agg(F.count("*"), F.sum("payload_bytes")).first() == (76, 75 * 64 * 128 * 512 + 7_000_000)
