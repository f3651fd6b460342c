"""Toxicity by compression distance: zstandard dictionaries trained on toxic and on ordinary text, and the window lengths under each."""

from __future__ import annotations

import math
import pickle
import re
import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard as zs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import slices

WINDOW = 64
BASE_BYTES, OWN_BYTES = 1 << 15, 1 << 12
SEGMENT, RUN = 16, 8  # of the training: bytes of a segment that a dictionary takes, and of the strings whose frequency chooses it
PAIRS = 5  # pairs of dictionaries whose gains are added
ROUNDS, SHARE, LEAST_GAIN = 6, 0.05, 2  # toxic windows are chosen in so many rounds: this share of each text's, if they gain so many bytes
GAINS = 30  # sums of gains from -GAINS to GAINS bytes are told apart
TOXIC_ROWS, ORDINARY_ROWS, SAMPLE_BYTES = 2000, 4000, 24 << 20
FOLDS = 3

_BREAK = re.compile(rb"[^a-z0-9\x80-\xff]+")


@dataclass
class ToxicityModel:
    """Pairs of dictionaries (toxic, ordinary), the log likelihood ratio of each gain, and a calibrated logistic; weights None: the score is ``prior``."""

    prior: float
    pairs: list[tuple[bytes, bytes]] = field(default_factory=list)
    evidence: np.ndarray | None = None
    centre: np.ndarray | None = None
    scale: np.ndarray | None = None
    weights: np.ndarray | None = None


def windows(text: bytes, size: int = WINDOW) -> list[bytes]:
    """The text, A-Z lower-cased, in windows of at most ``size`` bytes that end after a space where one is in their second half."""
    return re.findall(rb"(?s:(?=.{%d})(?:.{%d,%d} |.{%d})|.+)" % (size + 1, size // 2, size - 1, size), text.lower())


def _compressor(content: bytes) -> zs.ZstdCompressor:
    params = zs.ZstdCompressionParameters(strategy=zs.STRATEGY_DFAST, min_match=4, window_log=17, hash_log=17, chain_log=17, write_content_size=False, write_checksum=False, write_dict_id=False)
    held = zs.ZstdCompressionDict(content, dict_type=zs.DICT_TYPE_RAWCONTENT)
    held.precompute_compress(compression_params=params)
    return zs.ZstdCompressor(compression_params=params, dict_data=held)


def _lengths(compressor: zs.ZstdCompressor, parts: list[bytes]) -> np.ndarray:
    """Bytes of each part compressed by itself. One call for all, so that a dictionary's tables stay in the cache."""
    return np.fromiter(map(len, compressor.multi_compress_to_buffer(parts) if parts else ()), np.int64, len(parts))


class _Windows:
    """The windows of texts, laid end to end, and the text of each; the distinct ones, and which of them each window is."""

    def __init__(self, texts: list[bytes]):
        each = [windows(t) for t in texts]
        self.parts = [w for x in each for w in x]
        self.of = np.repeat(np.arange(len(texts)), [len(x) for x in each])
        self.texts = len(texts)
        place = dict.fromkeys(self.parts)
        self.distinct = list(place)
        place.update(zip(self.distinct, range(len(place))))
        self.which = np.fromiter(map(place.__getitem__, self.parts), np.int64, len(self.parts))

    def take(self, rows) -> list[bytes]:
        return [self.parts[i] for i in rows.tolist()]


def train_dictionary(size: int, samples: list[bytes]) -> bytes:
    """zstandard's dictionary for the samples; their text itself where they are too few to train on."""
    try:
        return zs.train_dictionary(size, samples, k=SEGMENT, d=RUN).as_bytes()
    except zs.ZstdError:
        return b" ".join(samples)[:size]


def _chosen(gain: np.ndarray, of: np.ndarray) -> np.ndarray:
    """The windows of each text that gain most: SHARE of them, one at least, and LEAST_GAIN bytes at least."""
    order = np.lexsort((-gain, of))
    n = np.bincount(of)
    rank = np.arange(len(of)) - (np.cumsum(n) - n)[of[order]]
    take = order[rank < np.maximum(1, np.ceil(SHARE * n[of[order]]))]
    return take[gain[take] >= LEAST_GAIN]


def train_pair(toxic: list[bytes], ordinary: list[bytes], seed: int) -> tuple[bytes, bytes]:
    """(toxic dictionary, ordinary dictionary): behind one base of BASE_BYTES for both, OWN_BYTES trained on windows of the own class only.

    The base is trained on ordinary windows, so that prose which any text holds compresses alike
    with both. Most windows of a toxic text are ordinary too; which ones aren't is found in
    rounds: a dictionary trained on one half of the toxic texts measures the windows of the other half,
    those that gain most train the next one.
    """
    return _pair(_Windows(toxic), _Windows(ordinary), seed)


def _pair(t: _Windows, o: _Windows, seed: int) -> tuple[bytes, bytes]:
    rng = np.random.default_rng(seed)
    plain = o.take(rng.permutation(len(o.parts)))
    cut = len(plain) // 2
    base = train_dictionary(BASE_BYTES, plain[:cut])
    ordinary_end = train_dictionary(OWN_BYTES, plain[cut:])
    half = rng.permutation(np.arange(t.texts) % 2)[t.of]
    rows = [np.flatnonzero(half == h) for h in (0, 1)]
    parts = [t.take(r) for r in rows]
    length = _lengths(_compressor(base + ordinary_end), t.parts)
    chosen = np.arange(len(t.parts))
    for _ in range(ROUNDS):
        gain = np.zeros(len(t.parts), np.int64)
        for h in (0, 1):
            end = train_dictionary(OWN_BYTES, t.take(chosen[half[chosen] == h]))
            other = rows[1 - h]
            gain[other] = length[other] - _lengths(_compressor(base + end), parts[1 - h])
        best = _chosen(gain, t.of)
        if min(np.bincount(half[best], minlength=2)) == 0:
            break
        chosen = best
    return base + train_dictionary(OWN_BYTES, t.take(chosen)), base + ordinary_end


def histograms(texts: list[bytes], pairs: list[tuple]) -> np.ndarray:
    """For each text how many of its windows have each gain: bytes by which toxic dictionaries compress them better than ordinary ones, summed over pairs."""
    w = _Windows(texts)
    gain = np.zeros(len(w.distinct), np.int64)
    for toxic, ordinary in pairs:
        gain += _lengths(ordinary, w.distinct) - _lengths(toxic, w.distinct)
    place = w.of * (2 * GAINS + 1) + (np.clip(gain, -GAINS, GAINS) + GAINS)[w.which]
    return np.bincount(place, minlength=w.texts * (2 * GAINS + 1)).reshape(w.texts, -1)


def _evidence(toxic: np.ndarray, ordinary: np.ndarray) -> np.ndarray:
    """Log of how much more frequent each gain is among the windows that make texts toxic than among ordinary ones.

    Windows of toxic texts are a mixture: what is left of them once the ordinary share is
    taken away (estimated where gains are at most 0) are the ones that matter.
    """
    t, o = toxic.sum(0) + 0.5, ordinary.sum(0) + 0.5
    t, o = t / t.sum(), o / o.sum()
    share = min(0.99, t[: GAINS + 1].sum() / o[: GAINS + 1].sum())
    own = np.maximum(t - share * o, 1e-3 * t) / (1 - share)
    out = np.clip(np.log(own / o), -3, 8)
    out[GAINS:] = np.maximum.accumulate(out[GAINS:])  # a larger gain never says less
    return out


def _features(counts: np.ndarray, evidence: np.ndarray) -> np.ndarray:
    """Of each row of counts: sums of evidence as of a mixture, the three largest gains' evidence, the means of gains and of positive ones, large gains, windows."""
    gains = np.arange(-GAINS, GAINS + 1)
    n = np.maximum(counts.sum(1), 1)
    more = np.exp(evidence) - 1
    above = np.minimum(np.cumsum(counts[:, ::-1], axis=1), 3)
    best = np.diff(above, axis=1, prepend=0) @ evidence[::-1]
    top = np.where(counts.any(1), evidence[2 * GAINS - np.argmax(counts[:, ::-1] > 0, axis=1)], evidence[GAINS])
    over = counts @ np.maximum(gains - 2 * PAIRS, 0)
    return np.stack(
        [
            counts @ np.log1p(0.02 * more), counts @ np.log1p(0.2 * more), top, best, counts @ gains / n, counts @ np.maximum(gains, 0) / n,
            over / n, np.log1p(over), np.log1p(counts[:, GAINS + 3 * PAIRS :].sum(1)), np.log1p(counts[:, GAINS + 5 * PAIRS :].sum(1)), np.log(n),
        ], axis=1,
    )


def _words(text: bytes) -> list[bytes]:
    return [w for w in _BREAK.split(text.lower()) if w]


def sketch(text: bytes) -> int:
    """The least hash of the text's runs of four words, which most copies share."""
    w = _words(text)
    return min(zlib.crc32(b" ".join(w[i : i + 4])) for i in range(max(1, len(w) - 3)))


def distinct(texts: list[bytes]) -> list[bytes]:
    """The first text of each sketch, so that copies don't count as documents of their own."""
    found: dict[int, bytes] = {}
    for text in texts:
        found.setdefault(sketch(text), text)
    return list(found.values())


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    x = np.c_[np.ones(len(x)), x]
    w = np.zeros(x.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), x.T @ (y - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _fold(toxic: list[bytes], ordinary: list[bytes], fold: int, folds: int, pairs: int) -> dict:
    """Pairs of dictionaries trained without every ``folds``-th text, and the histograms of the texts left out; of all texts for a negative fold."""
    classes = ordinary, toxic
    o, t = (_Windows([x for i, x in enumerate(c) if fold < 0 or i % folds != fold]) for c in classes)
    made = [_pair(t, o, seed) for seed in range(pairs)]
    if fold < 0:
        return {"pairs": made, "counts": []}
    held = [tuple(map(_compressor, p)) for p in made]
    return {"pairs": [], "counts": [histograms(c[fold::folds], held) for c in classes]}


def _on_executors(spark):
    """Runs the folds as tasks; the texts, a bounded sample, are broadcast."""

    def folded(toxic, ordinary, folds: int, pairs: int) -> list[dict]:
        sample = spark.sparkContext.broadcast((toxic, ordinary))

        def run(batches):
            for batch in batches:
                for fold in batch.column(0).to_pylist():
                    made = pickle.dumps(_fold(*sample.value, fold, folds, pairs))
                    yield pa.record_batch({"fold": pa.array([fold], pa.int32()), "made": pa.array([made], pa.binary())})

        try:
            tasks = spark.range(-1, folds, 1, folds + 1).select(F.col("id").cast("int").alias("fold"))
            return [pickle.loads(r["made"]) for r in sorted(tasks.mapInArrow(run, "fold int, made binary").collect(), key=lambda r: r["fold"])]
        finally:
            sample.unpersist()

    return folded


def _here(toxic, ordinary, folds: int, pairs: int) -> list[dict]:
    return [_fold(toxic, ordinary, fold, folds, pairs) for fold in range(-1, folds)]


def train(toxic: list[bytes], ordinary: list[bytes], prior: float, folds: int = FOLDS, pairs: int = PAIRS, folded=_here) -> ToxicityModel:
    """Calibrated on each fold by dictionaries of the others, so on texts that these haven't seen; the dictionaries that stay have seen all.

    ``prior``: the share of toxic rows among all labelled ones. With fewer texts than folds in a class the score is the prior.
    Copies count once, so that none is both learned from and calibrated on; only where that leaves too few texts do they count.
    """
    if min(len(toxic), len(ordinary)) < folds:
        return ToxicityModel(prior)
    toxic, ordinary = (few if len(few := distinct(c)) >= folds else c for c in (toxic, ordinary))
    whole, *parts = folded(toxic, ordinary, folds, pairs)
    plain, own = (np.concatenate([p["counts"][k] for p in parts]) for k in (0, 1))
    model = ToxicityModel(prior, whole["pairs"], _evidence(own, plain))
    x = _features(np.concatenate([own, plain]), model.evidence)
    y = np.repeat([1.0, 0.0], [len(own), len(plain)])
    model.centre, model.scale = x.mean(0), x.std(0) + 1e-9
    model.weights = _logistic((x - model.centre) / model.scale, y)
    share, prior = y.mean(), min(max(prior, 1e-4), 1 - 1e-4)
    model.weights[0] += math.log(prior / (1 - prior)) - math.log(share / (1 - share))  # the sample has another share of toxic rows
    return model


def scores(texts: list[bytes], model: ToxicityModel, pairs: list[tuple]) -> np.ndarray:
    if model.weights is None:
        return np.full(len(texts), model.prior)
    x = (_features(histograms(texts, pairs), model.evidence) - model.centre) / model.scale
    return 1 / (1 + np.exp(-np.clip(model.weights[0] + x @ model.weights[1:], -30, 30)))


def held_out(doc_id: str):
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, toxic_rows: int = TOXIC_ROWS, ordinary_rows: int = ORDINARY_ROWS, sample_bytes: int = SAMPLE_BYTES) -> ToxicityModel:
    """Train on a bounded sample of labelled rows: those with the least hashes of doc_id that aren't held out.

    At most toxic_rows and ordinary_rows rows, and of each class whole texts up to
    sample_bytes in all, those that don't fit passed over; an error if that leaves too few. Labels other than 0 and 1, null ids and labels
    without a document count for nothing. Without both classes the score is the share of
    toxic labels (0.5 without labels).
    """
    spark = docs.sparkSession
    known = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).where(~held_out("doc_id"))
    counts = {r[0]: r[1] for r in known.groupBy("toxic").count().collect()}
    if not counts:
        return ToxicityModel(0.5)
    prior = counts.get(1, 0) / sum(counts.values())
    texts: dict[int, list[bytes]] = {}
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text")).where("text is not null")
    for kind, most in ((1, toxic_rows), (0, ordinary_rows)):
        picked = known.where(F.col("toxic") == kind).select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
        sizes = rows.join(F.broadcast(picked), "doc_id").select("doc_id", F.octet_length("text").alias("n"), F.xxhash64("doc_id").alias("h")).orderBy("h", "doc_id").limit(2 * most).collect()
        size: dict[int, int] = {}
        for r in sizes:
            size[r["doc_id"]] = size.get(r["doc_id"], 0) + r["n"]
        ids, total = [], 0
        for doc_id, n in size.items():
            if total + n <= sample_bytes:
                total += n
                ids.append((doc_id,))
        if len(ids) < FOLDS <= len(size):
            raise ValueError(f"of {len(size)} labelled texts of class {kind} only {len(ids)} fit in sample_bytes = {sample_bytes}")
        fitting = F.broadcast(spark.createDataFrame(ids, "doc_id bigint"))
        got = rows.join(fitting, "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id", "text").limit(2 * most).collect() if ids else []
        texts[kind] = [bytes(r["text"]) for r in got]
    return train(texts[1], texts[0], prior, folded=_on_executors(spark))


def score(docs: DataFrame, model: ToxicityModel, threshold: float = 0.3) -> DataFrame:
    """docs plus ``score`` (0 to 1) and ``predicted`` (1 from ``threshold`` on), which replace columns of these names.

    Every window of every text is compressed with each dictionary; nothing but the text counts.
    A null or empty text has no windows and gets the score of a text without any gain.
    """

    def run(batches):
        pairs = [tuple(map(_compressor, p)) for p in model.pairs]
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                texts = [t or b"" for t in part.column(0).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(1), pa.array(scores(texts, model, pairs), pa.float64())], names=["row", "score"])

    keep = [c for c in docs.columns if c not in ("score", "predicted")]
    base = docs.select(F.col("text").cast("string").cast("binary").alias("text"), F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in keep]).alias("row"))
    schema = T.StructType([base.schema["row"], T.StructField("score", T.DoubleType())])
    scored = base.mapInArrow(run, schema)
    return scored.select(*[F.col(f"row.`{c}`").alias(c) for c in keep], "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def op7_toxicity(spark, sf_dir: str) -> DataFrame:
    """Contract query: all of documents, labels where crc32(doc_id) mod 4 is not 2."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    out = score(docs, model)
    return out.select("doc_id", held_out("doc_id").alias("held_out"), "score", "predicted")
