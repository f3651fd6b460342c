"""What the operators share: scratch tables, Arrow helpers, word hashing, block layout."""

from __future__ import annotations

import contextlib
import gc
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..scratch import CLEANUP, shared_dir

# ---------------------------------------------------------------- scratch tables


def saved(df: DataFrame, name: str, *folders: str) -> DataFrame:
    """Write df as Parquet into the shared folder and read it back: a cut of the lineage."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}"
    with shuffles_removed(spark):
        df.write.partitionBy(*folders).parquet(path)
    release(spark)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    return out


@contextlib.contextmanager
def shuffles_removed(spark: SparkSession):
    """The shuffle files of jobs in this block go as soon as each ends; what they wrote stands for them."""
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def drop(df: DataFrame) -> None:
    """Delete what ``saved`` wrote for df; only once nothing reads it any more."""
    path = getattr(df, "scratch_path", None)
    if path:
        spark = df.sparkSession
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


def release(spark: SparkSession) -> None:
    """Let the context cleaner drop the shuffle files and broadcasts of jobs that have ended; what the first pass frees may hold more."""
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def parts_for(total_bytes: int, target: int, least: int = 1) -> int:
    return max(least, math.ceil((total_bytes or 0) / target))


def text_bytes(df: DataFrame, col: str = "text") -> int:
    """UTF-8 bytes in a column, over all rows."""
    return df.agg(F.sum(F.octet_length(F.col(col)))).first()[0] or 0


# ---------------------------------------------------------------- Arrow


def slices(batch: pa.RecordBatch, col: str, limit: int = 4 << 20):
    """Cut a batch into runs of rows whose column holds about ``limit`` bytes, one row at least."""
    data, offsets = buffer_of(batch.column(batch.schema.get_field_index(col)))
    at, n = 0, batch.num_rows
    while at < n:
        to = int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1
        to = min(max(to, at + 1), n)
        yield batch.slice(at, to - at)
        at = to


def buffer_of(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary array without a copy; nulls count as empty."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    wide = pa.types.is_large_string(array.type) or pa.types.is_large_binary(array.type)
    if array.null_count:
        array = array.fill_null("" if pa.types.is_string(array.type) or pa.types.is_large_string(array.type) else b"")
    n = len(array)
    _, offs, data = array.buffers()
    kind = np.int64 if wide else np.int32
    if offs is None or n == 0:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    offsets = np.frombuffer(offs, kind, count=n + 1, offset=array.offset * np.dtype(kind).itemsize).astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def ids_of(array) -> np.ndarray:
    """int64 ids of an Arrow column that holds no nulls."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    return array.to_numpy(zero_copy_only=False).astype(np.int64)


def trim() -> None:
    """Give memory that is free in this worker back to the machine, which the C library doesn't do by itself."""
    import ctypes

    pa.default_memory_pool().release_unused()
    trimmer = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trimmer:
        trimmer(0)


# ---------------------------------------------------------------- hashing

U64 = np.uint64
BASE = U64(0x9E3779B97F4A7C15 | 1)
_POW: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and its inverse modulo 2**64 for i < n."""
    if "up" not in _POW or len(_POW["up"]) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        inverse = pow(int(BASE), -1, 1 << 64)
        for key, base in (("up", int(BASE)), ("down", inverse)):
            step = np.full(size, U64(base))
            step[0] = U64(1)
            _POW[key] = np.multiply.accumulate(step)
    return _POW["up"][:n], _POW["down"][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser on 64 bits."""
    h = h ^ (h >> U64(32))
    h = h * U64(0xD6E8FEB86659FD93)
    h ^= h >> U64(32)
    h *= U64(0xD6E8FEB86659FD93)
    h ^= h >> U64(32)
    return h


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True


#: Bytes between words where punctuation doesn't count: ASCII other than letters and digits.
BARE = np.ones(256, bool)
BARE[128:] = BARE[48:58] = BARE[65:91] = BARE[97:123] = False


def _latin_lower(piece: np.ndarray) -> np.ndarray:
    """The bytes with U+00C0..U+00DE lower-cased."""
    low = _LOWER[piece]
    low[1:][(piece[:-1] == 0xC3) & (piece[1:] >= 0x80) & (piece[1:] <= 0x9E) & (piece[1:] != 0x97)] += 32
    return low


def word_hashes(raw: np.ndarray, offsets: np.ndarray, chunk: int = 1 << 18, bare: bool = False):
    """Words ``[^\\x20\\x09-\\x0D]+`` of texts laid end to end, A-Z lower-cased.

    bare: words are runs of letters, digits and bytes beyond ASCII instead, Latin-1
    capitals are lower-cased too.

    Returns (64-bit hash of each word, offsets of each text's words, byte start and
    end of each word). Works through pieces of ``chunk`` bytes cut at white space, so
    that a very long text needs no more than a few arrays of its words.
    """
    space, n = BARE if bare else _SPACE, len(raw)
    n_texts = len(offsets) - 1
    if n == 0:
        return np.zeros(0, U64), np.zeros(n_texts + 1, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    bounds = offsets[(offsets > 0) & (offsets < n)]
    hashes, begins, ends = [], [], []
    at = 0
    while at < n:
        to = min(n, at + chunk)
        while to < n and not space[raw[to - 1]]:
            near = raw[to : to + 4096]
            hit = np.flatnonzero(space[near])
            to = to + int(hit[0]) + 1 if len(hit) else to + len(near)
        piece = raw[at:to]
        word = ~space[piece]
        edge = np.zeros(len(piece) + 1, bool)
        edge[0] = edge[-1] = True
        lo, hi = np.searchsorted(bounds, [at, to])
        edge[bounds[lo:hi] - at] = True
        before = np.empty(len(piece), bool)
        before[0] = False
        before[1:] = word[:-1]
        start = np.flatnonzero(word & (~before | edge[:-1]))
        after = np.empty(len(piece), bool)
        after[-1] = False
        after[:-1] = word[1:]
        end = np.flatnonzero(word & (~after | edge[1:])) + 1
        if len(start):
            up, down = powers(len(piece) + 1)
            total = np.zeros(len(piece) + 1, U64)
            low = _latin_lower(piece) if bare else _LOWER[piece]
            np.cumsum((low.astype(U64) + U64(1)) * up[:-1], out=total[1:])
            hashes.append(mix((total[end] - total[start]) * down[start]))
            begins.append(start + at)
            ends.append(end + at)
        at = to
    if not hashes:
        return np.zeros(0, U64), np.zeros(n_texts + 1, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    h, b, e = np.concatenate(hashes), np.concatenate(begins), np.concatenate(ends)
    return h, np.searchsorted(b, offsets), b, e


def ngram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words from each position on; the last n - 1 positions are left out."""
    if len(words) < n:
        return np.zeros(0, U64)
    out = np.full(len(words) - n + 1, U64(n), U64)
    for i in range(n):
        out = mix(out * U64(0x100000001B3) + words[i : len(words) - n + 1 + i])
    return out


# ---------------------------------------------------------------- packed sorted hashes


def pack_sorted(values: np.ndarray) -> bytes:
    """Sorted distinct uint64 values as differences: a width byte for each, then the bytes."""
    if not len(values):
        return b""
    gaps = np.empty(len(values), U64)
    gaps[0] = values[0]
    np.subtract(values[1:], values[:-1], out=gaps[1:])
    raw = gaps.astype("<u8").view(np.uint8).reshape(-1, 8)
    width = np.ones(len(values), np.uint8)
    for k in range(1, 8):
        width[gaps >= U64(1 << (8 * k))] = k + 1
    keep = np.arange(8)[None, :] < width[:, None]
    return np.uint32(len(values)).tobytes() + width.tobytes() + raw[keep].tobytes()


def unpack_sorted(data: bytes) -> np.ndarray:
    if not data:
        return np.zeros(0, U64)
    n = int(np.frombuffer(data, np.uint32, 1)[0])
    width = np.frombuffer(data, np.uint8, n, 4)
    keep = np.arange(8)[None, :] < width[:, None]
    raw = np.zeros((n, 8), np.uint8)
    raw[keep] = np.frombuffer(data, np.uint8, offset=4 + n)
    return np.cumsum(raw.view("<u8").ravel(), dtype=U64)


# ---------------------------------------------------------------- connected components


def components(edges: DataFrame, a: str = "a", b: str = "b", rounds: int = 40) -> DataFrame:
    """Connected components by alternating large-star and small-star.

    edges: two bigint columns, in any order, repeated or not; nulls and loops are
    dropped. Returns (node, root) for each node of a link, root the smallest node it
    reaches. A node's neighbours are never collected: their minimum is an aggregate and
    goes back by a join whose large partitions Spark can split. Each round is a written
    table; the rounds end when neither star changes a link.
    """
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u is not null and v is not null and u <> v")
    e = saved(e.distinct(), "edges")
    for _ in range(rounds):
        # large star: every larger neighbour of u goes to the smallest of u and its neighbours
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("v")).select("u", F.least("u", "v").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        large = large.distinct()
        # small star: every smaller neighbour of u, and u, go to the smallest neighbour
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v"))).where("u <> v")
        new = saved(small.distinct(), "edges")
        mark = [F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))]
        same = e.agg(*mark).first() == new.agg(*mark).first()
        drop(e)
        e = new
        if same:
            break
    else:
        raise RuntimeError(f"connected components did not settle in {rounds} rounds")
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
