"""The stages one after another: each acts on what its predecessor kept."""

import pytest

import corpus_pipeline as c


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = [("documents", docs)]
    at = tmp_path_factory.mktemp("stages")
    for name, stage in c.STAGES:
        stage(spark, out[-1][1], sf).write.parquet(str(at / name))
        out.append((name, spark.read.parquet(str(at / name))))
    return dict(out)


def test_columns_and_order(stages):
    assert [n for n, _ in c.STAGES] == ["toxicity", "near_duplicates", "repeats", "decontamination", "packing"]
    for name in ("documents", "toxicity", "near_duplicates", "repeats", "decontamination"):
        assert stages[name].dtypes == stages["documents"].dtypes


def test_decisions(spark, stages):
    from test_minhash import brute

    from corpusmill.llm import decontaminate

    kept = [(r["doc_id"], r["text"]) for r in stages["toxicity"].collect()]
    want = [d for d, _, _, keep in brute(kept, 5) if keep]
    assert sorted(r["doc_id"] for r in stages["near_duplicates"].collect()) == want
    assert sorted(r["doc_id"] for r in stages["repeats"].collect()) == want
    assert stages["repeats"].where("n_chars <> length(text)").count() == 0
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    leaked = {r["doc_id"] for r in decontaminate.find_leaks(stages["repeats"], bench).where("size(leaks) > 0").collect()}
    assert sorted(r["doc_id"] for r in stages["decontamination"].collect()) == [d for d in want if d not in leaked]


def test_most_documents_stay(stages):
    n = [stages[s].count() for s in ("documents", "toxicity", "near_duplicates", "repeats", "decontamination")]
    assert n == sorted(n, reverse=True) and n[-1] > 0.6 * n[0]
    assert stages["packing"].select("doc_id").distinct().count() == n[-1]


def test_run(spark, stages):
    got = c.run(spark, "/root/testdata/sf0.001")
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, got.select(key).collect())) == sorted(map(tuple, stages["packing"].select(key).collect()))


def test_empty_tables(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(0)
    for _, stage in c.STAGES:
        assert stage(spark, docs, "/root/testdata/sf0.001").count() == 0
