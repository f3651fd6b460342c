"""Exact and near-duplicate removal."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scratch import saved

PRIME = 4294967311  # the first above 2**32
BLOCK = 256  # shingles that are permuted at once: 128 permutations of them stay in a core's cache


def exact_groups(df: DataFrame, content: str = "content", key: str = "doc_id") -> DataFrame:
    """(sha256, first, copies) of each content that occurs more than once, null counting as empty; first is the smallest key."""
    digest = F.sha2(F.coalesce(F.col(content), F.lit("")), 256)
    return df.select(digest.alias("sha256"), F.col(key)).groupBy("sha256").agg(F.min(key).alias("first"), F.count("*").alias("copies")).where("copies > 1")


def exact_dedup(df: DataFrame, content: str = "content", key: str = "doc_id") -> DataFrame:
    """Of rows with equal contents the one with the smallest key; keys are unique.

    Only digests and keys are grouped, with partial sums, so a hot content is a row from each task. Its
    rows come back by a join whose large partitions Spark can split, or a broadcast where
    repeated contents are few.
    """
    groups = exact_groups(df, content, key).select("sha256", F.col("first").alias("_first"))
    rows = df.withColumn("_sha256", F.sha2(F.coalesce(F.col(content), F.lit("")), 256))
    joined = rows.join(groups, F.col("_sha256") == F.col("sha256"), "left")
    return joined.where(F.col("_first").isNull() | (F.col(key) == F.col("_first"))).select(*[F.col(f"`{c}`") for c in df.columns])


# ---------------------------------------------------------------- MinHash and LSH


def _area(f, a: float, b: float, steps: int = 200) -> float:
    x = np.linspace(a, b, steps + 1)
    return float(np.sum((f(x[1:]) + f(x[:-1])) / 2) * (b - a) / steps) if b > a else 0.0


def bands_for(threshold: float, num_perm: int) -> tuple[int, int]:
    """(bands, rows) within num_perm hashes for which misses above the threshold and hits below it have the least area."""
    best = None
    for b in range(1, num_perm + 1):
        for r in range(1, num_perm // b + 1):
            def hit(s, b=b, r=r):
                return 1 - (1 - s**r) ** b

            cost = 0.5 * _area(hit, 0, threshold) + 0.5 * _area(lambda s: 1 - hit(s), threshold, 1)
            if best is None or cost < best[0] - 1e-12:
                best = (cost, b, r)
    return best[1], best[2]


def permutations(num_perm: int, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    return rng.integers(1, 1 << 31, num_perm), rng.integers(0, 1 << 31, num_perm)


def shingle_hashes(text: str, size: int) -> np.ndarray:
    """32-bit hashes of the distinct runs of ``size`` lower-cased words."""
    w = text.lower().split()
    grams = {" ".join(w[i : i + size]) for i in range(len(w) - size + 1)}
    digests = b"".join([hashlib.md5(g.encode()).digest() for g in grams])
    return np.frombuffer(digests, ">u4")[::4].astype(np.uint64)


def _band_keys(size: int, num_perm: int, bands: int, rows: int):
    a, b = (x.astype(np.uint64)[:, None] for x in permutations(num_perm))
    prime = np.uint64(PRIME)

    def run(batches):
        for batch in batches:
            out = []
            for text in batch.column(1):
                h = shingle_hashes(text.as_py() or "", size)
                if not len(h):
                    out.append(None)
                    continue
                least = np.full(num_perm, np.iinfo(np.uint64).max, np.uint64)
                for at in range(0, len(h), BLOCK):
                    x = a * h[None, at : at + BLOCK]
                    x += b
                    x %= prime
                    np.minimum(least, x.min(1), out=least)
                out.append([hashlib.blake2b(j.to_bytes(2, "big") + least[j * rows : (j + 1) * rows].tobytes(), digest_size=16).digest() for j in range(bands)] + [hashlib.blake2b(least.tobytes(), digest_size=16).digest()])
            yield pa.record_batch({"key": batch.column(0), "bands": pa.array([x and x[:-1] for x in out], pa.list_(pa.binary())), "signature": pa.array([x and x[-1] for x in out], pa.binary())})

    return run


def near_groups(df: DataFrame, shingle_size: int = 3, num_perm: int = 128, threshold: float = 0.8, short_docs: str = "unique", content: str = "content", key: str = "doc_id") -> DataFrame:
    """(key, survivor) of each document that shares a band of its signature with another, in the groups of a pass in key order.

    In key order, a document that no group has taken yet forms one with all that share a band with it,
    taken or not; the smallest key of the group survives and the others go (``survivor`` is
    smaller than ``key``). Bands are not verified. A document of fewer words than
    ``shingle_size`` has no signature: ``unique`` leaves it alone, ``collide`` makes all of these one group.

    No pairs are made: documents meet at their bands. Documents of one signature have the same
    neighbours and count once. A round makes each undecided document a leader that is the
    smallest undecided one at all of its bands, and takes what shares a band with a leader;
    two leaders never share one, so a band has one leader at most.
    """
    if short_docs not in ("unique", "collide"):
        raise ValueError("short_docs must be unique or collide")
    bands, rows = bands_for(threshold, num_perm)
    kind = df.schema[key].dataType.simpleString()
    marked = df.select(F.col(key).alias("key"), F.col(content).cast("string").alias("text")).mapInArrow(_band_keys(shingle_size, num_perm, bands, rows), f"key {kind}, bands array<binary>, signature binary")
    if short_docs == "collide":
        marked = marked.withColumns({"bands": F.coalesce("bands", F.array(F.lit(b"short"))), "signature": F.coalesce("signature", F.lit(b"short"))})
    marked = saved(marked.where("signature is not null"), "signatures")
    classes = saved(marked.groupBy("signature").agg(F.min(F.struct("key", "bands")).alias("x"), F.count("*").alias("n")).select(F.col("x.key").alias("node"), "signature", F.col("x.bands").alias("bands"), "n"), "classes")
    at_bands = classes.select("node", F.explode("bands").alias("band"))
    busy = at_bands.groupBy("band").agg(F.count("*").alias("nodes"), F.min("node").alias("least")).where("nodes > 1").select("band", "least")
    meet = saved(at_bands.join(busy, "band"), "meetings")  # bands of two documents or more
    alone = classes.select("node", "n").join(meet.select("node").distinct(), "node", "left_anti").where("n > 1").select("node", F.col("node").alias("survivor"))
    open_ = meet
    led = None
    while not open_.isEmpty():
        first = open_.groupBy("band").agg(F.min("node").alias("first"))
        heads = open_.join(first, "band").groupBy("node").agg(F.min("first").alias("first")).where("first = node").select("node")
        # a leader's group is all that shares a band with it, in whatever round it was taken
        leading = meet.join(heads, "node").select("band", "node", "least")
        survivors = leading.groupBy("node").agg(F.min("least").alias("survivor"))
        new = leading.join(survivors, "node").select("band", "survivor")
        led = saved(new if led is None else led.unionByName(new), "leaders")
        taken = meet.join(led.select("band").distinct(), "band", "left_semi").select("node").distinct()
        open_ = saved(meet.join(taken, "node", "left_anti"), "open")
    found = alone
    if led is not None:
        found = found.unionByName(meet.join(led, "band").groupBy("node").agg(F.min("survivor").alias("survivor")))  # a survivor is never larger than its group
    members = marked.select("key", "signature").join(classes.select("signature", "node"), "signature").join(found, "node")
    return members.select("key", "survivor")


def near_dedup(df: DataFrame, shingle_size: int = 3, num_perm: int = 128, threshold: float = 0.8, short_docs: str = "unique", content: str = "content", key: str = "doc_id") -> DataFrame:
    """df without what near_groups has no survivor for but another document."""
    gone = near_groups(df, shingle_size, num_perm, threshold, short_docs, content, key).where("survivor <> key").select(F.col("key").alias(key))
    return df.join(gone, key, "left_anti")


def deduplicate(df: DataFrame, method: str = "exact", **options) -> DataFrame:
    if method == "exact":
        return exact_dedup(df, **{k: v for k, v in options.items() if k in ("content", "key")})
    if method == "lsh":
        return near_dedup(df, **options)
    raise ValueError(f"method must be exact or lsh, not {method!r}")
