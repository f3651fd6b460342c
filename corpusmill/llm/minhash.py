"""MinHash near-duplicates: universal hash minima, banding, verification, large-star and small-star."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import U64, buffer_of, components, drop, ids_of, ngram_hashes, saved, slices, word_hashes

BANDS, ROWS = 56, 7
MEMBERS, SHINGLES = 128, 400_000  # what a comparing task holds of a group, twice at most
SLACK = 1e-5  # for distances kept in single precision
HUBS, HUB_SHINGLES = 8, 1_600_000  # members of a large group that all others are compared with, and what they hold together


def shingle_sets(raw: np.ndarray, offsets: np.ndarray, n_words: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text; a text of fewer words is one shingle."""
    words, starts, _, _ = word_hashes(raw, offsets)
    grams = ngram_hashes(words, n_words)
    out = []
    for lo, hi in zip(starts[:-1].tolist(), starts[1:].tolist()):
        if hi - lo >= n_words:
            s = np.sort(grams[lo : hi - n_words + 1])
            out.append(s[np.concatenate(([True], s[1:] != s[:-1]))])
        elif hi > lo:
            out.append(ngram_hashes(words[lo:hi], hi - lo))
        else:
            out.append(np.zeros(0, U64))
    return out


def _family(count: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    a = rng.integers(0, 1 << 32, count, dtype=np.uint32) | np.uint32(1)
    return a, rng.integers(0, 1 << 32, count, dtype=np.uint32)


def minima(sets: list[np.ndarray], count: int, seed: int, chunk: int = 1 << 15) -> np.ndarray:
    """Minima of ``count`` hash functions a*x+b modulo 2**32 over each set, none of them empty."""
    a, b = _family(count, seed)
    out = np.full((len(sets), count), np.uint32(0xFFFFFFFF))
    sizes = np.array([len(s) for s in sets])
    keys = (np.concatenate(sets) >> U64(32)).astype(np.uint32) if len(sets) else np.zeros(0, np.uint32)
    begin = np.concatenate(([0], np.cumsum(sizes)))
    at = 0
    buffer = np.empty(chunk, np.uint32)
    while at < len(keys):
        to = min(len(keys), at + chunk)
        first = int(np.searchsorted(begin, at, side="right")) - 1
        last = int(np.searchsorted(begin, to, side="left"))
        cuts = np.maximum(begin[first:last] - at, 0)
        x, t = keys[at:to], buffer[: to - at]
        for k in range(count):
            np.multiply(x, a[k], out=t)
            np.add(t, b[k], out=t)
            low = np.minimum.reduceat(t, cuts)
            out[first:last, k] = np.minimum(out[first:last, k], low)
        at = to
    return out


def _bands(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    out = np.zeros((len(signature), bands), U64)
    for j in range(rows):
        out = out * U64(0x9E3779B97F4A7C15) + signature[:, j::rows][:, :bands].astype(U64) + U64(1)
        out ^= out >> U64(29)
    return out + np.arange(bands, dtype=U64)[None, :] * U64(0xC2B2AE3D27D4EB4F)


def _describe(n_words: int, bands: int, rows: int, seed: int):
    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                sets = shingle_sets(*buffer_of(part.column(1)), n_words)
                full = [s for s in sets if len(s)]
                keys = _bands(minima(full, bands * rows, seed), bands, rows).astype("<u8")
                made = iter(keys)
                yield pa.record_batch(
                    {
                        "doc_id": part.column(0),
                        "n_shingles": pa.array([len(s) for s in sets], pa.int64()),
                        "class": pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets], pa.binary()),
                        "bands": pa.array([next(made).tobytes() if len(s) else None for s in sets], pa.binary()),
                    }
                )

    return run


def _local_links(bands: int):
    """Within a task's rows: a link from each document to the smallest of its bucket, and the smallest for each bucket."""

    def run(batches):
        for batch in batches:
            ids = ids_of(batch.column(0))
            keys = np.frombuffer(b"".join(batch.column(1).to_pylist()), "<u8")
            yield from _star(keys, np.repeat(ids, bands), True)

    return run


def _star(keys: np.ndarray, ids: np.ndarray, pass_on: bool):
    if not len(keys):
        return
    order = np.lexsort((ids, keys))
    keys, ids = keys[order], ids[order]
    head = np.concatenate(([True], keys[1:] != keys[:-1]))
    least = ids[np.flatnonzero(head)][np.cumsum(head) - 1]
    link = ids != least
    pairs = np.unique(np.stack([ids[link], least[link]], 1), axis=0)
    heads = np.flatnonzero(head) if pass_on else np.zeros(0, np.int64)
    n, m = len(pairs), len(heads)
    yield pa.record_batch(
        {
            "key": pa.array(np.concatenate([np.zeros(n, np.int64), keys[heads].view(np.int64)]), mask=np.arange(n + m) < n),
            "a": pa.array(np.concatenate([pairs[:, 0], ids[heads]])),
            "b": pa.array(np.concatenate([pairs[:, 1], ids[heads]])),
        }
    )


def _global_links(batches):
    keys, ids = [], []
    for batch in batches:
        keys.append(batch.column(0).to_numpy(zero_copy_only=False).view(U64))
        ids.append(ids_of(batch.column(1)))
    if keys:
        for out in _star(np.concatenate(keys), np.concatenate(ids), False):
            yield out.select(["a", "b"])


def _member_sets(n_words: int, bands: int, rows: int, seed: int):
    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                sets = shingle_sets(*buffer_of(part.column(2)), n_words)
                full = pa.array([i for i, s in enumerate(sets) if len(s)], pa.int64())  # a repeated doc_id may have an empty text too
                part, sets = part.take(full), [s for s in sets if len(s)]
                marks = minima(sets, bands * rows, seed)
                yield pa.record_batch(
                    {
                        "node": part.column(0),
                        "root": part.column(1),
                        "n": pa.array([len(s) for s in sets], pa.int64()),
                        "set": pa.array([s.astype("<u8").tobytes() for s in sets], pa.binary()),
                        "signature": pa.array([m.astype("<u4").tobytes() for m in marks], pa.binary()),
                    }
                )

    return run


class _Group:
    """Rows of one group under comparison: distances from hubs and signatures choose pairs, full sets confirm them."""

    def __init__(self, table: pa.Table, percent: int, count: int):
        share = percent / 100
        self.percent, self.floor = percent, max(0.0, share - 6 * (share * (1 - share) / count) ** 0.5)
        self.ids = ids_of(table["node"])
        self.sets = [np.frombuffer(x, "<u8") for x in table["set"].to_pylist()]
        self.sizes = np.array([len(s) for s in self.sets])
        self.marks = np.frombuffer(b"".join(table["signature"].to_pylist()), "<u4").reshape(len(self.ids), count)
        self.far = np.array(table["far"].to_pylist(), np.float32) if "far" in table.column_names else None

    def likely(self, i: int, others: np.ndarray) -> np.ndarray:
        """Those of the others that row i may link with, likeliest first. Jaccard distance is a metric: what links is alike in its distance from any hub."""
        n = self.sizes[i]
        others = others[100 * np.minimum(self.sizes[others], n) >= self.percent * np.maximum(self.sizes[others], n)]
        if self.far is not None:
            others = others[(np.abs(self.far[others] - self.far[i]) <= 1 - self.percent / 100 + SLACK).all(1)]
        alike = (self.marks[others] == self.marks[i]).mean(1) if len(others) else np.zeros(0)
        good = np.flatnonzero(alike >= self.floor)
        return others[good[np.argsort(-alike[good], kind="stable")]]

    def common(self, i: int, j: int) -> int:
        return len(np.intersect1d(self.sets[i], self.sets[j], assume_unique=True))

    def linked(self, i: int, j: int) -> bool:
        both = self.common(i, j)
        return 100 * both >= self.percent * (self.sizes[i] + self.sizes[j] - both)

    def forest(self, pairs, joined: np.ndarray):
        """A spanning forest of the links among (row, others) pairs; the rows of ``joined`` are one tree already."""
        parent = list(range(len(self.ids)))
        for i in joined.tolist():
            parent[i] = int(joined[0])

        def top(x):
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        for i, others in pairs:
            for j in self.likely(i, others).tolist():
                x, y = top(i), top(j)
                if x != y and self.linked(i, j):
                    parent[max(x, y)] = min(x, y)
                    yield int(self.ids[i]), int(self.ids[j])


def _links(pairs) -> pa.Table:
    pairs = list(pairs)
    return pa.table({"a": pa.array([x for x, _ in pairs], pa.int64()), "b": pa.array([y for _, y in pairs], pa.int64())})


def _whole_groups(percent: int, count: int):
    """Groups that fit one task, several to a call: every member with every other."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        group, found = _Group(table, percent, count), []
        roots = ids_of(table["root"])
        order = np.lexsort((group.ids, roots))
        none = np.zeros(0, np.int64)
        for rows in np.split(order, np.flatnonzero(np.diff(roots[order])) + 1):
            found += group.forest(((i, rows[k + 1 :]) for k, i in enumerate(rows.tolist())), none)
        return _links(found)

    return run


def _to_hubs(percent: int, count: int):
    """A part of a large group and the group's hubs (role: their number from 1 on, 0 for the part's rows).

    Each row with its distance from each hub (HUBS numbers, 0 where there are fewer hubs), the hubs that
    it links with as ids, and as bits of a mask.
    """

    def run(key: tuple, table: pa.Table) -> pa.Table:
        group, role = _Group(table, percent, count), table["role"].to_numpy()
        rows, hubs = np.flatnonzero(role == 0), np.flatnonzero(role > 0)
        far, masks, ids = [], [], []
        for i in rows.tolist():
            away, mask = [0.0] * HUBS, 0
            for h in hubs.tolist():
                both = group.common(i, h)
                union = int(group.sizes[i] + group.sizes[h]) - both
                away[role[h] - 1] = 1 - both / union
                mask |= (100 * both >= percent * union) << int(role[h] - 1)
            far.append(away)
            masks.append(mask)
            ids.append([int(group.ids[h]) for h in hubs.tolist() if mask >> int(role[h] - 1) & 1])
        out = table.take(pa.array(rows)).select(["node", "root", "n", "set", "signature", "part"])
        for name, column in (("far", pa.array(far, pa.list_(pa.float32()))), ("mask", pa.array(masks, pa.int32())), ("hubs", pa.array(ids, pa.list_(pa.int64())))):
            out = out.append_column(name, column)
        return out

    return run


def _main_hubs(key: tuple, table: pa.Table) -> pa.Table:
    """Of a group the hubs, as bits, that are joined through members into the largest tree. table: root, mask, members (a row a mask at most)."""
    trees: list[list] = []
    for mask, members in zip(table["mask"].to_pylist(), table["members"].to_pylist()):
        apart = [t for t in trees if not t[0] & mask]
        for t in trees:
            if t[0] & mask:
                mask, members = mask | t[0], members + t[1]
        trees = [*apart, [mask, members]] if mask else trees
    best = max(trees, key=lambda t: (t[1], t[0]), default=[0, 0])
    return pa.table({"root": pa.array([key[0].as_py()], pa.int64()), "main": pa.array([best[0]], pa.int32())})


def _rest_with_all(percent: int, count: int):
    """Some rows out of the main tree (role 2), and a part of all rows (role 1: in the tree; 0: not)."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        group = _Group(table, percent, count)
        role = table["role"].to_numpy()
        every = np.flatnonzero(role < 2)
        return _links(group.forest(((i, every) for i in np.flatnonzero(role == 2).tolist()), np.flatnonzero(role == 1)))

    return run


def _parts(df: DataFrame, *keys: str, name: str) -> DataFrame:
    """Into how many parts the rows of each key go, so that none holds over MEMBERS rows or much over SHINGLES shingles."""
    size = F.greatest(F.ceil(F.count("*") / MEMBERS), F.ceil(F.sum("n") / SHINGLES)).cast("int")
    return df.groupBy(*keys).agg(size.alias(name))


def _dealt(seed: int, parts: str) -> F.Column:
    return F.pmod(F.xxhash64("node", "n", F.lit(seed)), F.col(parts)).cast("int")


def _every(parts: str) -> F.Column:
    return F.explode(F.sequence(F.lit(0), F.col(parts) - 1))


def _hubs(sets: DataFrame, parts: DataFrame) -> DataFrame:
    """Of each group of several parts HUBS members at most, which hold HUB_SHINGLES or are one: root, node, n, mark, role from 1 on."""
    share = F.pmod(F.xxhash64(F.lit("hub"), "node", "n", "mark"), F.lit(HUBS))
    one = F.min(F.struct(F.xxhash64("node", "n", "mark").alias("h"), "node", "n", "mark")).alias("x")
    few = sets.groupBy("root", share.alias("share")).agg(one).join(parts.where("parts > 1"), "root")
    order = Window.partitionBy("root").orderBy("x")
    few = few.select("root", "x.node", "x.n", "x.mark", F.row_number().over(order).alias("role"), F.sum("x.n").over(order).alias("held"))
    return few.where((F.col("role") == 1) | (F.col("held") <= HUB_SHINGLES)).drop("held")


def _large_groups(large: DataFrame, hubs: DataFrame, percent: int, count: int) -> DataFrame:
    """Links (a, b) of groups too large for a task, as many as join their components. large: rows of sets, with ``parts``; hubs: see _hubs.

    HUBS members of each group meet all of it, in parts of bounded size. Of the trees this makes the largest is
    taken for joined; only rows outside of it meet others, and of these only such as have a like size and a like
    distance from the first hub (rings and size classes as wide as a link can reach, so that neighbours are enough).
    """
    columns = ["node", "root", "n", "set", "signature"]
    hubs = large.join(hubs, ["root", "node", "n", "mark"])
    members = large.select(*columns, F.lit(0).alias("role"), _dealt(0, "parts").alias("part"))
    members = members.unionByName(hubs.select(*columns, "role", _every("parts").alias("part")))
    # dealt by all keys here and below: Spark would leave the parts of a group together where a join has dealt them by root
    shape = "node bigint, root bigint, n bigint, set binary, signature binary, part int, far array<float>, mask int, hubs array<bigint>"
    met = saved(members.repartition("root", "part").groupBy("root", "part").applyInArrow(_to_hubs(percent, count), shape), "met")
    links = met.select(F.col("node").alias("a"), F.explode("hubs").alias("b"))
    main = met.groupBy("root", "mask").agg(F.count("*").alias("members")).groupBy("root").applyInArrow(_main_hubs, "root bigint, main int")

    width, step = max(0.01, 1 - percent / 100 + SLACK), max(0.01, math.log(100 / percent) + SLACK)
    ring, size = F.floor(F.col("far")[0] / width).cast("int"), F.floor(F.log(F.col("n")) / step).cast("int")
    whole = met.groupBy("root").agg(F.max("part").alias("last"))
    main = main.join(whole, "root").select("root", "main", F.explode(F.sequence(F.lit(0), "last")).alias("part"))  # a row for each part, as a group's rows may be many
    met = met.join(main, ["root", "part"]).select(*columns, "far", F.col("mask").bitwiseAND(F.col("main")).alias("joined"), ring.alias("ring"), size.alias("size"))
    rest = met.where("joined = 0")
    near = F.explode(F.array(*[F.lit(x) for x in (-1, 0, 1)]))
    asked = rest.withColumn("x", near).withColumn("ring", F.col("ring") + F.col("x")).withColumn("x", near).withColumn("size", F.col("size") + F.col("x"))
    cell = ["root", "ring", "size"]
    parts, rest_parts = _parts(met, *cell, name="parts"), _parts(asked, *cell, name="rest_parts")
    alls = met.join(parts, cell).join(rest_parts, cell)  # cells without rest drop out
    asked = asked.join(rest_parts, cell).join(parts, cell)
    alls = alls.select(*cell, "node", "n", "set", "signature", "far", (F.col("joined") != 0).cast("int").alias("role"), _dealt(0, "parts").alias("part"), _every("rest_parts").alias("rest_part"))
    asked = asked.select(*cell, "node", "n", "set", "signature", "far", F.lit(2).alias("role"), _dealt(1, "rest_parts").alias("rest_part"), _every("parts").alias("part"))
    keys = [*cell, "part", "rest_part"]
    return links.unionByName(alls.unionByName(asked).repartition(*keys).groupBy(*keys).applyInArrow(_rest_with_all(percent, count), "a bigint, b bigint"))


def near_duplicates(docs: DataFrame, n_words: int = 5, percent: int = 80, bands: int = BANDS, rows: int = ROWS, seed: int = 11) -> DataFrame:
    """Near-duplicate components of documents by MinHash.

    docs: columns doc_id (integer) and text; others, whatever their names, are not read.
    Words are runs of bytes other than space and \\t..\\r, A-Z lower-cased; a document's set
    holds its distinct shingles of n_words words (a shorter text: all of its words as one).
    Two documents are linked if 100 * common >= percent * united, confirmed on the full sets.

    Returns doc_id, n_shingles, class_id (smallest doc_id with the same set),
    component_id, kept. Null or blank texts have no shingles and link with nothing; rows
    with a null doc_id keep nulls in class_id and component_id, are kept and link with
    nothing. Repeated doc_ids: one row each, joined through whichever of their texts link.

    bands * rows minima: a pair at 0.8 misses every band of 56 x 7 with probability 2e-6.
    Copies fold into one class first. Buckets link their members to their smallest in a star,
    at first within each task, so that a hot bucket moves one row per task. The groups
    reached that way are compared by signature first and full sets then; only a spanning
    forest goes out. A group too large for a task meets a few hubs among its members, in parts of
    bounded size; only members that these don't join into one tree meet others, again in parts
    (see _large_groups).
    """
    count = bands * rows
    base = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    described = saved(
        base.mapInArrow(_describe(n_words, bands, rows, seed), "doc_id bigint, n_shingles bigint, class binary, bands binary"),
        "described",
    )
    classes = (
        described.where("class is not null and doc_id is not null").groupBy("class").agg(F.min(F.struct("doc_id", "bands")).alias("x")).select("class", F.col("x.doc_id").alias("rep"), F.col("x.bands").alias("bands"))
    )
    reps = saved(classes, "classes")
    local = saved(reps.select("rep", "bands").mapInArrow(_local_links(bands), "key bigint, a bigint, b bigint"), "local")
    parts = max(docs.sparkSession.sparkContext.defaultParallelism, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    across = local.where("key is not null").select("key", "a").repartition(parts, "key").mapInArrow(_global_links, "a bigint, b bigint")
    coarse = components(local.where("key is null").select("a", "b").unionByName(across))
    coarse = saved(coarse, "coarse")
    drop(local)

    sets = base.join(coarse.select(F.col("node").alias("doc_id"), "root").hint("merge"), "doc_id").select(F.col("doc_id").alias("node"), "root", "text")
    kept_sets = saved(sets.mapInArrow(_member_sets(n_words, bands, rows, seed), "node bigint, root bigint, n bigint, set binary, signature binary"), "sets")
    sets = kept_sets.withColumn("mark", F.xxhash64("set"))
    group_parts = _parts(sets, "root", name="parts")
    sized = sets.join(group_parts, "root")
    small = sized.where("parts = 1").select("node", "root", "n", "set", "signature", F.pmod(F.xxhash64("root"), F.lit(4 * parts)).alias("cell"))
    links = small.groupBy("cell").applyInArrow(_whole_groups(percent, count), "a bigint, b bigint")
    links = links.unionByName(_large_groups(sized.where("parts > 1"), _hubs(sets, group_parts), percent, count))
    found = components(links)
    drop(kept_sets)
    ids = reps.select("class", "rep").join(found.select(F.col("node").alias("rep"), "root"), "rep", "left").select("class", "rep", F.coalesce("root", "rep").alias("root"))
    out = described.select("doc_id", "n_shingles", "class").join(ids, "class", "left")
    return out.select(
        "doc_id",
        "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("rep", "doc_id")).alias("class_id"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("root", "doc_id")).alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("component_id") == F.col("doc_id"), F.lit(True)))


def op8_minhash(spark, sf_dir: str) -> DataFrame:
    """Contract query: four-word shingles, 0.8, all of documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return near_duplicates(docs, n_words=4).drop("class_id")
