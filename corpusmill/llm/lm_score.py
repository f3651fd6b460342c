"""Cross-entropy difference: matched target and background n-gram models over one vocabulary.

1. count:  per block of documents, its distinct n-grams with how often each occurs in all and in
           target documents, packed, by bucket of their hashes
2. sum:    per bucket, corpus counts of each n-gram, back to each block that has it
3. score:  per block, each token's loss under both models, each document's own counts left out
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import U64, buffer_of, ids_of, mix, pack_sorted, parts_for, saved, text_bytes, unpack_sorted, word_hashes

START, END = U64(0x51AB7), U64(0xE0D)
UNIGRAM_PRIOR, CONTEXT_PRIOR = 0.5, 4.0
SALTS = 8  # blocks that rows with one doc_id spread over


def _grams(raw: np.ndarray, offsets: np.ndarray, order: int) -> tuple[list[np.ndarray], np.ndarray]:
    """For each order the hash of the n-gram that ends at each token, and the documents' token offsets; a document's last token is its end.

    Hashes have 56 bits; the lowest two tell the order.
    """
    words, starts, _, _ = word_hashes(raw, offsets)
    docs = np.arange(len(starts) - 1)
    ends = starts + np.arange(len(starts))  # with an end for each document before
    tokens = np.full(len(words) + len(docs), END, U64)
    tokens[np.arange(len(words)) + np.repeat(docs, np.diff(starts))] = words
    place = np.arange(len(tokens)) - np.repeat(ends[:-1], np.diff(ends))
    out, h = [], tokens
    for n in range(order):
        if n:
            before = np.full(len(tokens), START, U64)
            before[n:] = tokens[:-n]
            before[place < n] = START
            h = mix(h * U64(0x100000001B3) + before)
        out.append((mix(h + U64(n)) >> U64(10)) << U64(2) | U64(n))
    return out, ends


def _packed_counts(counts: np.ndarray) -> bytes:
    """Counts as a byte each, 255 standing for a number of eight bytes at the end."""
    low = np.minimum(counts, 255).astype(np.uint8)
    return low.tobytes() + counts[low == 255].astype("<i8").tobytes()


def _unpacked_counts(data: bytes, n: int) -> np.ndarray:
    low = np.frombuffer(data, np.uint8, n).astype(np.int64)
    low[low == 255] = np.frombuffer(data, "<i8", offset=n)
    return low


def _marked(docs: pa.Table, targets: pa.Table) -> np.ndarray:
    return np.isin(ids_of(docs["doc_id"].fill_null(0)), ids_of(targets["doc_id"])) & docs["doc_id"].is_valid().to_numpy()


def _count(order: int, n_buckets: int):
    def run(key: tuple, docs: pa.Table, targets: pa.Table) -> pa.Table:
        grams, ends = _grams(*buffer_of(docs["bytes"]), order)
        target = np.repeat(_marked(docs, targets), np.diff(ends))
        parts = []
        for g in grams:
            h, inverse = np.unique(g, return_inverse=True)
            parts.append((h, np.bincount(inverse, minlength=len(h)), np.bincount(inverse[target], minlength=len(h))))
        h, every, marked = (np.concatenate(x) for x in zip(*parts))
        sort = np.argsort(h)
        h, every, marked = h[sort], every[sort], marked[sort]
        cuts = np.searchsorted(_buckets(h, n_buckets), np.arange(n_buckets + 1))
        full = [b for b in range(n_buckets) if cuts[b] < cuts[b + 1]]

        def packed(f, x):
            return pa.array([f(x[cuts[b] : cuts[b + 1]]) for b in full], pa.binary())

        return pa.table({"bucket": pa.array(full, pa.int64()), "block": pa.array([key[0].as_py()] * len(full), pa.int64()), "hashes": packed(pack_sorted, h), "every": packed(_packed_counts, every), "marked": packed(_packed_counts, marked)})

    return run


def _buckets(h: np.ndarray, n: int) -> np.ndarray:
    """Bucket of 56-bit hashes, in their order."""
    return ((h >> U64(24)) * U64(n) >> U64(32)).astype(np.int64)


def _sum(key: tuple, t: pa.Table) -> pa.Table:
    """Corpus counts for each block of the bucket, and in a row of their own (block -1) distinct words, tokens and target tokens."""
    runs = [unpack_sorted(x) for x in t["hashes"].to_pylist()]
    h, inverse = np.unique(np.concatenate(runs), return_inverse=True)
    totals = []
    for c in ("every", "marked"):
        each = np.concatenate([_unpacked_counts(x, len(r)) for x, r in zip(t[c].to_pylist(), runs)])
        totals.append(np.bincount(inverse, weights=each, minlength=len(h)).astype(np.int64))
    at = np.split(inverse, np.cumsum([len(r) for r in runs])[:-1])
    words = (h & U64(3)) == U64(0)
    sizes = [int(words.sum()), int(totals[0][words].sum()), int(totals[1][words].sum())]
    return pa.table(
        {
            "block": pa.array([*t["block"].to_pylist(), -1], pa.int64()),
            "bucket": pa.array([key[0].as_py()] * (len(runs) + 1), pa.int64()),
            "every": pa.array([*(_packed_counts(totals[0][a]) for a in at), b""], pa.binary()),
            "marked": pa.array([*(_packed_counts(totals[1][a]) for a in at), b""], pa.binary()),
            **{c: pa.array([0] * len(runs) + [n], pa.int64()) for c, n in zip(("words", "tokens", "target_tokens"), sizes)},
        }
    )


def _losses(counts: list[np.ndarray], contexts: list[np.ndarray], scale: float, vocabulary: int) -> np.ndarray:
    """Each token's loss: the lower order's probability is the prior of the higher one's."""
    p = np.full(len(counts[0]), 1.0 / max(1, vocabulary))
    for n, (c, of) in enumerate(zip(counts, contexts)):
        prior = UNIGRAM_PRIOR * vocabulary if n == 0 else CONTEXT_PRIOR
        p = (scale * c + prior * p) / (scale * of + prior)
    return -np.log(p)


def _score(order: int, n_buckets: int, sizes: tuple[int, int, int]):
    vocabulary, n_every, n_target = sizes
    n_other = n_every - n_target
    scales = min(1.0, n_other / n_target) if n_target else 1.0, min(1.0, n_target / n_other) if n_other else 1.0

    def run(key: tuple, docs: pa.Table, side: pa.Table) -> pa.Table:
        grams, ends = _grams(*buffer_of(docs["bytes"]), order)
        length = np.diff(ends)
        doc = np.repeat(np.arange(len(length)), length)
        back = side.filter(side["every"].is_valid()).sort_by("bucket")
        target = _marked(docs, side.filter(side["doc_id"].is_valid()))
        local = [np.unique(g, return_inverse=True) for g in grams]
        h = np.concatenate([x for x, _ in local])
        sort = np.argsort(h)
        sizes = np.diff(np.searchsorted(_buckets(h[sort], n_buckets), np.arange(n_buckets + 1)))
        sizes = sizes[sizes > 0].tolist()
        corpus = []
        for c in ("every", "marked"):
            x = np.empty(len(h), np.int64)
            x[sort] = np.concatenate([_unpacked_counts(b, n) for b, n in zip(back[c].to_pylist(), sizes)]) if sizes else 0
            corpus.append(x)
        at, classes = 0, ([], [])  # counts of each order's n-gram, for target and background, without the document's own
        for x, inverse in local:
            own = _own(doc, inverse, len(x))
            every, marked = corpus[0][at : at + len(x)][inverse], corpus[1][at : at + len(x)][inverse]
            at += len(x)
            mine = target[doc]
            classes[0].append(marked - np.where(mine, own, 0))
            classes[1].append(every - marked - np.where(mine, 0, own))
        first = np.concatenate(([True], doc[1:] != doc[:-1])) if len(doc) else np.zeros(0, bool)
        out = []
        for counts, total, own_class, scale in zip(classes, (n_target, n_other), (target, ~target), scales):
            contexts = [(total - np.where(own_class, length, 0))[doc]]
            for n in range(1, order):
                # a context is the n-gram before, which occurs as often; at a document's start it is what all documents start with
                c = np.empty(len(doc), np.int64)
                c[1:] = counts[n - 1][:-1]
                c[first] = counts[0][ends[1:] - 1]
                contexts.append(c)
            loss = _losses(counts, contexts, scale, vocabulary)
            out.append(np.add.reduceat(loss, ends[:-1]) / length if len(length) else np.zeros(0))
        return pa.table({"doc_id": docs["doc_id"], "n_tokens": pa.array(length, pa.int64()), "target_loss": pa.array(out[0]), "background_loss": pa.array(out[1]), "score": pa.array(out[0] - out[1])})

    return run


def _own(doc: np.ndarray, inverse: np.ndarray, n: int) -> np.ndarray:
    """How often each token's n-gram occurs in its own document."""
    _, at, count = np.unique(doc * n + inverse, return_inverse=True, return_counts=True)
    return count[at]


def cross_entropy_difference(docs: DataFrame, target_ids: DataFrame, order: int = 2, block_bytes: int = 6 << 20) -> DataFrame:
    """Each document's mean loss per token under a target and a background model, and their difference ``score`` (lower: more like the target).

    docs: doc_id (integer) and text; target_ids: doc_id of the target documents, repeated or not; all
    other documents are background. Tokens are runs of bytes other than space and \\t..\\r, A-Z
    lower-cased, and an end for each document, so that a null or empty text has one token. Both
    models share the vocabulary of all distinct tokens, order (1 to 3), priors and size: the
    larger class's counts are scaled to the tokens of the smaller. p_n(w | context) =
    (scale * c(context, w) + prior * p_(n-1)(w)) / (scale * c(context) + prior), above 1 /
    vocabulary. A document's own counts are left out of the model it is in, row by row; repeated
    rows count each other. A null doc_id is background. Without target or background
    documents that model is uniform. An empty table gives no rows.

    All n-grams of all documents count. A block sends each of its distinct n-grams once, so a
    frequent one is a row of each block at most; no bucket gets more than its share of hashes.
    """
    if not 1 <= order <= 3:
        raise ValueError("order must be from 1 to 3")
    total = text_bytes(docs)
    n_blocks = n_buckets = parts_for(total, block_bytes)
    base = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string").cast("binary"), F.lit(b"")).alias("bytes"))
    salt = F.pmod(F.crc32("bytes"), F.lit(SALTS))  # of the row alone, as both passes must make the same blocks
    rows = base.withColumn("salt", salt).select(F.pmod(F.xxhash64(F.coalesce("doc_id", F.crc32("bytes")), "salt"), F.lit(n_blocks)).alias("block"), "doc_id", "bytes")
    wanted = target_ids.select(F.col("doc_id").cast("bigint").alias("doc_id")).where("doc_id is not null").distinct()
    flags = wanted.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint")))).select(F.pmod(F.xxhash64("doc_id", "salt"), F.lit(n_blocks)).alias("block"), "doc_id").distinct()
    counted = rows.groupBy("block").cogroup(flags.groupBy("block")).applyInArrow(_count(order, n_buckets), "bucket bigint, block bigint, hashes binary, every binary, marked binary")
    sums = saved(counted.groupBy("bucket").applyInArrow(_sum, "block bigint, bucket bigint, every binary, marked binary, words bigint, tokens bigint, target_tokens bigint"), "sums")
    found = sums.where("block = -1").agg(F.sum("words"), F.sum("tokens"), F.sum("target_tokens")).first()
    side = sums.where("block >= 0").select("block", "bucket", "every", "marked", F.lit(None).cast("bigint").alias("doc_id"))
    side = side.unionByName(flags.select("block", F.lit(None).cast("bigint").alias("bucket"), F.lit(None).cast("binary").alias("every"), F.lit(None).cast("binary").alias("marked"), "doc_id"))
    return rows.groupBy("block").cogroup(side.groupBy("block")).applyInArrow(
        _score(order, n_buckets, tuple(x or 0 for x in found)), "doc_id bigint, n_tokens bigint, target_loss double, background_loss double, score double"
    )


def op2_lm_score(spark, sf_dir: str) -> DataFrame:
    """All of documents; the target is those labelled quality 1, bigrams. Losses are rounded to 6 places."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    good = spark.read.parquet(f"{sf_dir}/labels.parquet").where("quality = 1").select("doc_id")
    scored = cross_entropy_difference(docs, good)
    return scored.select("doc_id", "n_tokens", *(F.round(c, 6).alias(c) for c in ("target_loss", "background_loss", "score")))


OP2_SQL = f"""
with d as (
  select doc_id, coalesce(doc_id in (select doc_id from labels where quality = 1), false) as target,
         list_concat(['<'], regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+'), [' >']) as w from documents),
t as (select doc_id, target, case when i = 1 then ' <' else w[i] end as v, w[i + 1] as w from (select *, unnest(range(1, len(w))) as i from d)),
o2 as (select doc_id, target, v, w, count(*) as n from t group by all),
c2 as (select v, w, sum(n) filter (target) as t, sum(n) filter (not target) as b from o2 group by all),
ov as (select doc_id, target, v, sum(n) as n from o2 group by all),
cv as (select v, sum(n) filter (target) as t, sum(n) filter (not target) as b from ov group by all),
ow as (select doc_id, target, w, sum(n) as n from o2 group by all),
cw as (select w, sum(n) filter (target) as t, sum(n) filter (not target) as b from ow group by all),
od as (select doc_id, target, sum(n) as n from o2 group by all),
a as (select sum(n) filter (target) as t, sum(n) filter (not target) as b, (select count(*) from cw) as vocabulary from od),
s as (select *, least(1.0::double, b::double / t) as st, least(1.0::double, t::double / b) as sb from a),
x as (
  select o2.doc_id, o2.n, od.n as tokens, s.st, s.sb, s.vocabulary * {UNIGRAM_PRIOR}::double as k, s.vocabulary,
    coalesce(c2.t, 0) - if(o2.target, o2.n, 0) as t2, coalesce(c2.b, 0) - if(o2.target, 0, o2.n) as b2,
    coalesce(cv.t, 0) - if(o2.target, ov.n, 0) as tv, coalesce(cv.b, 0) - if(o2.target, 0, ov.n) as bv,
    coalesce(cw.t, 0) - if(o2.target, ow.n, 0) as tw, coalesce(cw.b, 0) - if(o2.target, 0, ow.n) as bw,
    s.t - if(o2.target, od.n, 0) as ta, s.b - if(o2.target, 0, od.n) as ba
  from o2 join c2 using (v, w) join cv using (v) join cw using (w) join ov using (doc_id, v) join ow using (doc_id, w) join od using (doc_id) cross join s),
p as (
  select doc_id, n, tokens,
    (st * t2 + {CONTEXT_PRIOR}::double * ((st * tw + k / vocabulary) / (st * ta + k))) / (st * tv + {CONTEXT_PRIOR}::double) as pt,
    (sb * b2 + {CONTEXT_PRIOR}::double * ((sb * bw + k / vocabulary) / (sb * ba + k))) / (sb * bv + {CONTEXT_PRIOR}::double) as pb from x),
r as (select doc_id, cast(any_value(tokens) as bigint) as n_tokens, sum(-ln(pt) * n) / any_value(tokens) as lt, sum(-ln(pb) * n) / any_value(tokens) as lb from p group by doc_id)
select doc_id, n_tokens, round(lt, 6) as target_loss, round(lb, 6) as background_loss, round(lt - lb, 6) as score from r
"""
