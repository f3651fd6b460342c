import numpy as np
import pytest
from conftest import canonical
from pyspark.sql import functions as F

from corpusmill.llm import ann


def test_codes_bound_the_error():
    rng = np.random.default_rng(1)
    v, q = rng.standard_normal((400, 64)), rng.standard_normal((30, 64))
    turn = ann.rotation(64, 7)
    assert np.allclose(turn @ turn.T, np.eye(64))
    packed, norm, own = ann.encode(v, turn)
    assert packed.shape == (400, 8) and packed.dtype == np.uint64 and np.allclose(norm, np.sqrt((v * v).sum(1)))
    codes = ann.Codes(packed, norm, own)
    unit = q / np.sqrt((q * q).sum(1, keepdims=True))
    pairs = [codes.estimate(x, turn) for x in unit]
    error = np.array([g for g, _ in pairs]) - unit @ v.T
    assert (abs(error) <= np.array([w for _, w in pairs])).mean() > 0.9999 and abs(error.mean()) < 0.02
    # the bound isn't slack either: errors fill a quarter of it
    assert error.std() > np.array([w for _, w in pairs]).mean() / ann.EPSILON / 2


@pytest.mark.parametrize("dim", [64, 768])
def test_share_reranked_and_recall(dim):
    """On vectors with clusters under a fifth is reranked, and at least 0.9 (here: nearly all) of the true neighbours are found."""
    rng = np.random.default_rng(dim)
    centres = rng.standard_normal((60, dim))
    v = centres[rng.integers(0, 60, 6000)] + 0.7 * rng.standard_normal((6000, dim))
    turn = ann.rotation(dim, 7)
    codes = ann.Codes(*ann.encode(v, turn))
    found = reranked = 0
    for i in range(0, 6000, 60):
        rows, score = ann.best_of(codes, v, v[i], turn, np.array([i]), 20)
        true = v @ v[i]
        true[i] = -np.inf
        assert i not in rows and np.allclose(score, true[rows])
        found += len(set(rows[np.argsort(-score)[:20]]) & set(np.argsort(-true)[:20]))
        reranked += len(rows)
    assert found / 2000 > 0.995 and reranked / 600_000 < 0.2


@pytest.mark.parametrize("size", [1e200, 1e-170, 1e150, 1.0, 1e-320])
def test_extreme_components(spark, size):
    rng = np.random.default_rng(3)
    v = (np.round(rng.standard_normal((300, 8)), 2) + 0.01) * size
    if size == 1.0:
        v *= 10.0 ** rng.integers(-150, 150, (300, 1))
    v = v[(v != 0).any(1)]
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id bigint, embedding array<double>")
    got = sorted((r["query_id"], r["rank"], r["vec_id"]) for r in ann.nearest(df, F.col("vec_id") % 20 == 0, k=20).collect())
    expected = []
    for i in range(0, len(v), 20):
        with np.errstate(over="ignore", invalid="ignore"):
            s = [sum((a * b for a, b in zip(v[i], x)), 0.0) for x in v]
        order = sorted((j for j in range(len(v)) if j != i), key=lambda j: (not np.isnan(s[j]), -s[j] if not np.isnan(s[j]) else 0, j))
        expected += [(i, n + 1, j) for n, j in enumerate(order[:20])]
    assert got == sorted(expected)


def brute(rows, step, k):
    ok = [(i, np.array(v, np.float64)) for i, v in rows if i is not None and v is not None and len(v) == 8 and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = []
    for n, (i, q) in enumerate(ok):
        if i % step == 0:
            best = sorted((-sum(a * b for a, b in zip(q, v)), j) for m, (j, v) in enumerate(ok) if m != n)[:k]
            out += [(i, r + 1, j, round(-s, 9)) for r, (s, j) in enumerate(best)]
    return sorted(out)


def test_brute_force(spark, monkeypatch):
    monkeypatch.setattr(ann, "CELL_VECTORS", 60)
    monkeypatch.setattr(ann, "CELL_QUERIES", 9)
    rng = np.random.default_rng(2)
    vectors = np.round(rng.standard_normal((200, 8)), 1).astype(np.float32)
    vectors[50:60] = vectors[40]
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    rows += [(1000, None), (1001, [0.0] * 8), (1002, [float("nan")] + [1.0] * 7), (1005, [float("inf")] + [1.0] * 7), (1010, [None] + [1.0] * 7), (1015, []), (None, [1.0] * 8), (1020, [1.0] * 7), (10, [9.0] * 8)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").withColumn("rank", F.lit(1)).repartition(4)
    got = sorted((r["query_id"], r["rank"], r["vec_id"], round(r["score"], 9)) for r in ann.nearest(df, F.col("vec_id") % 5 == 0, k=7).collect())
    assert got == brute(rows, 5, 7)


def test_few_vectors(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0])], "vec_id bigint, embedding array<float>")
    assert [(r["query_id"], r["vec_id"]) for r in ann.nearest(df, F.col("vec_id") == 0).collect()] == [(0, 1)]
    assert ann.nearest(df.limit(1), F.lit(True)).count() == 0 and ann.nearest(df.limit(0), F.lit(True)).count() == 0


def test_sql(spark, duck, small):
    assert canonical(ann.op10_ann(spark, small).toPandas()) == canonical(duck.execute(ann.OP10_SQL).df())
