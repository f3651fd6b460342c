import zlib

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from corpusmill.llm import toxicity as t


def test_windows_cover_the_text():
    for text in (b"", b"short", b"A b " * 100, b"x" * 1000, "ü ".encode() * 200):
        parts = t.windows(text)
        assert b"".join(parts) == text.lower() and all(len(p) <= t.WINDOW for p in parts)


def test_windows_end_where_a_plain_loop_ends_them():
    rng = np.random.default_rng(5)
    for n in [*range(140), 5000]:
        for alphabet in (b"a B\n\xc3", b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ ", b"x"):
            text = bytes(rng.choice(np.frombuffer(alphabet, np.uint8), n))
            parts, at = [], 0
            while at < n:
                to = at + t.WINDOW
                if to < n:
                    to = text.rfind(b" ", at + t.WINDOW // 2, to) + 1 or to
                parts.append(text[at:to].lower())
                at = to
            assert t.windows(text) == parts


class Counted:
    """A compressor and the windows that it was given."""

    def __init__(self, content):
        self.real, self.seen = t._compressor(content), []

    def compress(self, part):
        self.seen.append(part)
        return self.real.compress(part)

    def multi_compress_to_buffer(self, parts):
        self.seen += parts
        return self.real.multi_compress_to_buffer(parts)


def test_equal_windows_are_compressed_once_and_count_each_time():
    texts = [b"vile words and kind ones, " * 200, b"", b"kind words " * 300, b"vile words and kind ones, " * 200, b"Z" * 6400]
    pairs = [(Counted(b"vile words and kind ones, " * 3), Counted(b"kind words " * 5)), (Counted(b"z" * 64), Counted(b"some other text"))]
    got = t.histograms(texts, pairs)
    for c in (c for p in pairs for c in p):
        assert sorted(c.seen) == sorted({w for x in texts for w in t.windows(x)})
    for text, row in zip(texts, got):
        want = np.zeros(2 * t.GAINS + 1, np.int64)
        for w in t.windows(text):
            gain = sum(len(o.real.compress(w)) - len(own.real.compress(w)) for own, o in pairs)
            want[min(max(gain, -t.GAINS), t.GAINS) + t.GAINS] += 1
        assert (row == want).all()
    assert not t.histograms([b""], pairs).any()


@pytest.fixture(scope="module")
def sample(spark):
    return spark.read.parquet("/root/testdata/sf0.1/documents.parquet"), spark.read.parquet("/root/testdata/sf0.1/labels.parquet")


def auc(scores, truth):
    order = np.argsort(scores, kind="stable")
    ranks = np.empty(len(scores))
    ranks[order] = np.arange(1, len(scores) + 1)
    n = truth.sum()
    return (ranks[truth].sum() - n * (n + 1) / 2) / (n * (len(truth) - n))


def test_held_out_accuracy(spark, sample):
    got = t.op7_toxicity(spark, "/root/testdata/sf0.1").toPandas()
    docs, labels = sample
    assert len(got) == docs.count() and got.score.between(0, 1).all()
    assert (got.predicted == (got.score >= 0.3)).all()
    assert (got.held_out == [zlib.crc32(str(d).encode()) % 4 == 2 for d in got.doc_id]).all()
    known = got[got.held_out].merge(labels.toPandas(), on="doc_id")
    truth = known.toxic.to_numpy() == 1
    hit = known.predicted.to_numpy() == 1
    assert auc(known.score.to_numpy(), truth) > 0.88  # of 330 toxic texts to learn from
    assert (hit & truth).sum() / truth.sum() > 0.7 and (hit & truth).sum() / hit.sum() > 0.7


def test_held_out_labels_do_not_matter(spark, sample):
    docs, labels = (x.limit(1500) for x in sample)
    flipped = labels.withColumn("toxic", F.when(t.held_out("doc_id"), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = t.fit(docs, labels), t.fit(docs, flipped)
    assert a.pairs and a.pairs == b.pairs and a.prior == b.prior and (a.weights == b.weights).all()


def test_edge_cases(spark):
    docs = spark.createDataFrame([(1, None, "a", 7), (2, "", "b", 7), (None, "x", "c", 7), (3, "z" * 200_000, "d", 7), (3, "x", "e", 7)], "doc_id bigint, text string, score string, predicted int")
    docs = docs.withColumn("row", F.lit(1)).withColumn("odd name: a.b", F.lit(2))
    for rows, prior in (([], 0.5), ([(1, 1), (2, 0), (None, 1), (4, 7), (3, None)], None), ([(1, 0)], None)):
        model = t.fit(docs, spark.createDataFrame(rows, "doc_id bigint, toxic int"))
        got = t.score(docs, model).collect()
        assert len(got) == 5 and all(0 <= r["score"] <= 1 and r["predicted"] in (0, 1) and r["row"] == 1 for r in got)
        assert set(got[0].asDict()) == {*docs.columns}
        assert prior is None or {r["score"] for r in got} == {prior}
    assert t.score(docs.limit(0), model).count() == 0


def test_a_long_text_does_not_end_the_sample(spark):
    ids = spark.range(1, 61).where(~t.held_out("id")).orderBy(F.xxhash64("id")).toPandas().id.tolist()
    long = {next(i for i in ids if i % 2 == k) for k in (0, 1)}
    docs = spark.createDataFrame([(i, ("vile words " if i % 2 else "kind words ") * (2000 if i in long else 5)) for i in ids], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in ids], "doc_id bigint, toxic int")
    assert t.fit(docs, labels, sample_bytes=5000).weights is not None
    with pytest.raises(ValueError, match="sample_bytes"):
        t.fit(docs, labels, sample_bytes=20)


def corpus(n, seed=1):
    rng = np.random.default_rng(seed)
    syllables = [a + b for a in "bdfgklmnprst" for b in "aeiou"]
    word = lambda: "".join(rng.choice(syllables, rng.integers(1, 5)))
    out = []
    for i in range(n):
        words = [word() for _ in range(rng.integers(60, 200))]
        if i % 3 == 0:
            for _ in range(8):
                words[rng.integers(len(words))] = str(rng.choice(["verminous", "blockhead", "wretched"]))
        out.append((i, " ".join(words)))
    return out


def test_both_dictionaries_are_trained(monkeypatch):
    """Every byte of a dictionary comes from zstandard's training, the toxic one's end on windows of toxic texts only."""
    rows = [(i, t.encode()) for i, t in corpus(240)]
    toxic, ordinary = [x for i, x in rows if i % 3 == 0], [x for i, x in rows if i % 3]
    made, real = {}, zstandard.train_dictionary

    class Spy:
        def __getattr__(self, name):
            return getattr(zstandard, name)

        def train_dictionary(self, size, samples, **more):
            out = real(size, samples, **more)
            made[out.as_bytes()] = samples
            return out

    monkeypatch.setattr(t, "zs", Spy())
    own, plain = t.train_pair(toxic, ordinary, 0)
    base = next(x for x in made if own.startswith(x) and plain.startswith(x))
    ends = own[len(base) :], plain[len(base) :]
    toxic_windows, plain_windows = ({w for x in c for w in t.windows(x)} for c in (toxic, ordinary))
    assert set(made[base]) <= plain_windows and set(made[ends[1]]) <= plain_windows and set(made[ends[0]]) <= toxic_windows
    assert abs(len(ends[0]) - len(ends[1])) < 100


def test_new_words_are_learned_and_a_text_of_30_mb_is_scored_whole(spark):
    rows = [(i, t, i % 3 == 0) for i, t in corpus(600)]
    ids = spark.range(20_000).where(~t.held_out("id")).limit(len(rows)).toPandas().id.tolist()
    docs = spark.createDataFrame([(d, x) for d, (_, x, _) in zip(ids, rows)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(d, int(y)) for d, (_, _, y) in zip(ids, rows)], "doc_id bigint, toxic int")
    model = t.fit(docs, labels)
    fresh = corpus(90, 2)
    plain = " ".join(x for i, x in corpus(900, 3) if i % 3)
    long = [(1000, (plain * (30_000_000 // len(plain) + 1))), (1001, None)]
    got = {r["doc_id"]: r["score"] for r in t.score(spark.createDataFrame(fresh + long, "doc_id bigint, text string"), model).collect()}
    assert len(got) == 92 and np.mean([(got[i] > 0.5) == (i % 3 == 0) for i, _ in fresh]) > 0.9
