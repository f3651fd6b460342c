"""Nearest neighbours by randomly rotated one-bit codes with error bounds and exact reranking."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import drop, saved

CELL_VECTORS, CELL_QUERIES = 16_384, 8_192
LEAST_VECTORS = 4_096  # of a cell, where there are fewer cells than cores
LEAST_BITS = 512  # of a code; shorter vectors are padded with zeros before the rotation
FIRST = 6  # times k estimates are computed first
PLANES = 4  # bits for each component of a rotated query
EPSILON = 4.0  # widths of the error bound
LARGE, SMALL = 1e300, 1e-280  # inner products beyond these are never left to estimates


def code_bits(dim: int) -> int:
    return 64 * math.ceil(max(dim, LEAST_BITS) / 64)


def rotation(dim: int, seed: int, bits: int | None = None) -> np.ndarray:
    """The first ``dim`` rows of a random rotation in ``bits`` dimensions."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((bits or code_bits(dim), dim)))
    return (q * np.sign(np.diag(r))).T


def _unit(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors and norms, whatever the size of the components."""
    top = np.abs(vectors).max(1, keepdims=True)
    part = vectors / top
    length = np.sqrt((part * part).sum(1, keepdims=True))
    with np.errstate(over="ignore"):
        return part / length, (top * length)[:, 0]


def _packed(bits: np.ndarray) -> np.ndarray:
    """Rows of bits as rows of 64-bit words."""
    return np.packbits(bits, axis=1, bitorder="little").view("<u8")


def encode(vectors: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed signs of rotated unit vectors, the vectors' norms, and each code's inner product with its own vector."""
    unit, norm = _unit(vectors)
    turned = unit @ turn
    return _packed(turned > 0), norm, np.abs(turned).sum(1) / math.sqrt(turn.shape[1])


class Codes:
    """Coded vectors under search, word by word: all first words, all second ones, and so on."""

    def __init__(self, codes: np.ndarray, norm: np.ndarray, own: np.ndarray):
        self.words = np.ascontiguousarray(codes.T)
        self.bits = 64 * codes.shape[1]
        self.norm, self.own = norm, own
        self.ones = np.bitwise_count(self.words).sum(0, dtype=np.int64)

    def estimate(self, query: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Estimates of the vectors' inner products with a unit query, and the width of the error bound of each.

        The rotated query is rounded to PLANES bits a component; and-ing a plane of them with
        the codes and counting bits gives the inner product of code and rounded query. Divided by
        <code, vector> it is an unbiased estimate of <vector, query>: a code's part across its vector
        is random, so that the error is within EPSILON * sqrt((1 - own**2 + rounded**2) / (bits - 1)) / own
        with a probability that falls as exp(-EPSILON**2 / 2).
        """
        turned = query @ turn
        low = turned.min()
        step = (turned.max() - low) / ((1 << PLANES) - 1) or 1.0
        level = np.rint((turned - low) / step).astype(np.uint8)
        rounded = turned - (low + step * level)
        dot = np.zeros(len(self.norm), np.int32)
        for j in range(PLANES):
            plane = _packed((level[None, :] >> j) & 1)[0]
            part = np.zeros(len(self.norm), np.uint16)
            for word, mask in zip(self.words, plane):
                part += np.bitwise_count(word & mask)
            dot += part.astype(np.int32) << j
        both = (2 * (step * dot + low * self.ones) - (step * level.sum(dtype=np.int64) + low * self.bits)) / math.sqrt(self.bits)
        width = EPSILON * np.sqrt((np.maximum(0.0, 1 - self.own**2) + (rounded**2).sum()) / (self.bits - 1)) / self.own + 1e-9
        return both / self.own * self.norm, width * self.norm


def inner(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products in double precision, summed from the first component on, so that equal vectors get equal sums."""
    out = np.zeros(len(vectors))
    with np.errstate(over="ignore", invalid="ignore"):
        for k in range(len(query)):
            out += vectors[:, k] * query[k]
    return out


def best_of(codes: Codes, vectors: np.ndarray, query: np.ndarray, turn: np.ndarray, skip: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows, inner products) of all vectors that can be among the k nearest of a query; those in ``skip`` are none.

    The FIRST * k largest estimates are computed exactly; the k-th of these is a floor that any
    other vector's upper bound must reach. Where products may leave the range of doubles every vector is computed.
    """
    unit, norm = _unit(query[None, :])
    with np.errstate(over="ignore"):
        reach = codes.norm * norm[0]
    if not (reach.max() < LARGE and reach.min() > SMALL):
        rows = np.setdiff1d(np.arange(len(vectors)), skip)
        return rows, inner(vectors[rows], query)
    guess, width = codes.estimate(unit[0], turn)
    guess[skip] = -np.inf
    n = min(FIRST * k, len(guess) - len(skip))
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0)
    first = np.argpartition(guess, len(guess) - n)[len(guess) - n :]
    exact = inner(vectors[first], query)
    floor = np.sort(exact)[-min(k, n)] / norm[0]
    able = guess + width >= floor - 1e-12 * abs(floor)
    able[first] = False
    more = np.flatnonzero(able)
    return np.concatenate([first, more]), np.concatenate([exact, inner(vectors[more], query)])


def _matrix(column, dim: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.asarray(column.flatten(), np.float64).reshape(-1, dim)


def _encode(dim: int, seed: int):
    def run(batches):
        turn = rotation(dim, seed)
        for batch in batches:
            codes, norm, own = encode(_matrix(batch.column("vector"), dim), turn)
            made = {"code": pa.array([c.tobytes() for c in codes], pa.binary()), "norm": pa.array(norm), "own": pa.array(own)}
            yield pa.RecordBatch.from_arrays([*batch.columns, *made.values()], names=[*batch.schema.names, *made])

    return run


def _search(dim: int, seed: int, k: int):
    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        out = {"query_row": [], "query_id": [], "vec_id": [], "row": [], "score": []}
        if left.num_rows and right.num_rows:
            turn = rotation(dim, seed)
            left = left.sort_by("row")
            vectors, rows, ids = _matrix(left["vector"], dim), left["row"].to_numpy(), left["vec_id"].to_numpy()
            codes = Codes(np.frombuffer(b"".join(left["code"].to_pylist()), "<u8").reshape(len(rows), -1), left["norm"].to_numpy(), left["own"].to_numpy())
            asked = _matrix(right["asked"], dim)
            for query, row, query_id in zip(asked, right["asked_row"].to_pylist(), right["asked_id"].to_pylist()):
                same = np.arange(*np.searchsorted(rows, [row, row + 1]))
                pick, score = best_of(codes, vectors, query, turn, same, k)
                best = np.lexsort((rows[pick], ids[pick], -score, ~np.isnan(score)))[:k]  # NaN counts as the largest number, as in SQL
                out["query_row"].append(np.full(len(best), row))
                out["query_id"].append(np.full(len(best), query_id))
                out["vec_id"].append(ids[pick][best])
                out["row"].append(rows[pick][best])
                out["score"].append(score[best])
        kinds = {"score": np.float64}
        return pa.table({c: pa.array(np.concatenate(x) if x else np.zeros(0, kinds.get(c, np.int64))) for c, x in out.items()})

    return run


def usable(df: DataFrame, vector: str) -> F.Column:
    v = F.col(vector)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return v.isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.coalesce(F.exists(v, lambda x: x != 0), F.lit(False))


def nearest(vectors: DataFrame, is_query: F.Column, k: int = 20, seed: int = 7, dim: int | None = None) -> DataFrame:
    """Each query's k nearest of all vectors but itself by inner product: query_id, rank, vec_id, score.

    vectors: vec_id and embedding (an array of numbers); others are not read. is_query: a
    condition on vec_id. Vectors that are null, zero, empty, of another length than ``dim``
    (default: the most frequent length, the longer of equally frequent ones) or hold null or
    non-finite numbers, and rows with a null vec_id, take no part. A query is left out of its
    own candidates by row, so other rows with its vec_id are candidates. Ties go to the
    smaller vec_id. Without queries or vectors there are no rows. Components may have any
    size; a product that overflows is infinite or NaN as in SQL, NaN the largest.

    Every vector is coded once, in the written table: padded with zeros to code_bits and
    rotated at random, a bit for each component, its norm and a correction. The stated queries meet all vectors
    in blocks of bounded size, and each pair of blocks is a task's group. There bit counts
    on the packed codes give estimates with error bounds, these choose which vectors are reranked
    on the original components. A block gives at most k rows a query; the best k of these are the result.
    """
    spark = vectors.sparkSession
    given = vectors.schema["embedding"].dataType
    exact = given if isinstance(given, T.ArrayType) and isinstance(given.elementType, T.FloatType) else T.ArrayType(T.DoubleType())
    v = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast(exact).alias("vector")).withColumn("row", F.monotonically_increasing_id())
    v = v.where(F.col("vec_id").isNotNull() & usable(v, "vector"))
    if dim is None:
        top = v.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
        dim = top[0] if top else 1
    coded = T.StructType([*v.schema.fields, T.StructField("code", T.BinaryType()), T.StructField("norm", T.DoubleType()), T.StructField("own", T.DoubleType())])
    v = saved(v.where(F.size("vector") == dim).mapInArrow(_encode(dim, seed), coded), "vectors")
    queries = v.where(is_query)
    n_vectors, n_queries = v.count(), queries.count()
    spread = min(spark.sparkContext.defaultParallelism, n_vectors // LEAST_VECTORS)
    tall, wide = max(1, spread, math.ceil(n_vectors / CELL_VECTORS)), max(1, math.ceil(n_queries / CELL_QUERIES))
    left = v.withColumn("c", F.pmod(F.xxhash64("row"), F.lit(tall))).withColumn("q", F.explode(F.sequence(F.lit(0), F.lit(wide - 1))))
    right = queries.select(F.col("vec_id").alias("asked_id"), F.col("vector").alias("asked"), F.col("row").alias("asked_row"))
    right = right.withColumn("q", F.pmod(F.xxhash64("asked_row", F.lit(1)), F.lit(wide)).cast("int")).withColumn("c", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(tall - 1).cast("bigint"))))
    found = left.groupBy("c", "q").cogroup(right.groupBy("c", "q")).applyInArrow(_search(dim, seed, k), "query_row bigint, query_id bigint, vec_id bigint, row bigint, score double")
    found = saved(found, "found")
    drop(v)
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id", "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op10_ann(spark, sf_dir: str) -> DataFrame:
    """Contract query: the 20 nearest of all embeddings for each vec_id divisible by 20."""
    return nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 20 == 0)


OP10_SQL = """
with v as (
  select vec_id, embedding::double[] as e from embeddings
  where vec_id is not null and embedding is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(embedding, lambda x: x <> 0)) > 0),
p as (
  select a.vec_id as query_id, b.vec_id as vec_id, list_inner_product(a.e, b.e) as score
  from v a join v b on a.vec_id % 20 = 0 and a.vec_id <> b.vec_id),
r as (select *, row_number() over (partition by query_id order by score desc, vec_id) as k from p)
select query_id, cast(k as integer) as "rank", vec_id, score from r where k <= 20
"""
