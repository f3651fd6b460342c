"""Repeated-passage removal by a distributed merge sort of front-coded suffix runs.

The suffixes that are sorted start at anchors: the position with the least k-gram hash
(the leftmost of several) among those in a window of ``length`` bytes. Equal windows have
equal anchors, so each window is judged at exactly one suffix, and none is lost. Anchors
whose k-gram occurs in one document only can't be repeated and leave before any suffix moves.

1. sketch:  per block of documents, sorted anchor hashes, packed as differences, by bucket
2. shared:  per bucket, the hashes found in two documents or more, back to each block
3. runs:    per block, the suffixes at shared anchors, sorted, made distinct, front-coded
4. merge:   per bucket, a loser tree over the blocks' runs that compares from the known
            common prefix on; its order and common-prefix lengths show equal windows
5. settle:  per block, each document's repeated windows and what is left of it
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import U64, buffer_of, ids_of, mix, pack_sorted, parts_for, powers, saved, text_bytes, trim, unpack_sorted

LENGTH, GRAM = 50, 24
PIECE = 1 << 17
ROWS = 1 << 14  # suffixes that are made and sorted at once, or one bucket's
TOP = U64(16)  # anchor hashes have 48 bits


class _Shape:
    """Lengths that follow from the window and the k-gram."""

    def __init__(self, length: int, gram: int):
        self.length, self.gram = length, gram
        self.slots = length - gram + 1
        if not 1 <= self.slots <= 62:
            raise ValueError("length - gram must be from 0 to 61")
        self.left = self.slots - 1
        self.width = length + self.left + 2


def _sliding_least(key: np.ndarray, width: int) -> np.ndarray:
    have = 1
    while have * 2 <= width:
        key = np.minimum(key[:-have], key[have:])
        have *= 2
    more = width - have
    return np.minimum(key[:-more], key[more:]) if more else key


def _spans(offsets: np.ndarray):
    """Byte ranges of whole texts, about PIECE each; a longer text is cut at multiples of PIECE from its own start."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + PIECE, side="right")) - 1
        if j > i:
            yield int(offsets[i]), int(offsets[j])
            i = j
        else:
            for a in range(int(offsets[i]), int(offsets[i + 1]), PIECE):
                yield a, min(a + PIECE, int(offsets[i + 1]))
            i += 1


def anchors(raw: np.ndarray, offsets: np.ndarray, shape: _Shape):
    """For each run of windows with one anchor: its position, k-gram hash, document, and least and largest distance to a window's start.

    A text's anchors depend on the text alone, not on its neighbours in the block.
    """
    found = []
    size, gram = shape.length, shape.gram
    for at, to in _spans(offsets):
        piece = raw[at : to + size - 1]
        if len(piece) < size:
            continue
        up, down = powers(len(piece) + 1)
        total = np.zeros(len(piece) + 1, U64)
        np.cumsum((piece.astype(U64) + U64(1)) * up[:-1], out=total[1:])
        h = mix((total[gram:] - total[:-gram]) * down[: len(piece) - gram + 1])
        key = ((h >> U64(20)) << U64(20)) | np.arange(len(h), dtype=U64)
        least = (_sliding_least(key, shape.slots) & U64(0xFFFFF)).astype(np.int64)
        starts = np.arange(len(least))
        doc = np.searchsorted(offsets, starts + at, side="right") - 1
        ok = (starts + at + size <= offsets[doc + 1]) & (starts + at < to)
        starts, spot, doc = starts[ok], least[ok], doc[ok]
        if not len(starts):
            continue
        head = np.flatnonzero(np.concatenate(([True], (spot[1:] != spot[:-1]) | (doc[1:] != doc[:-1]))))
        tail = np.concatenate((head[1:], [len(starts)])) - 1
        even = mix(h[spot[head]] + U64(1)) >> TOP  # least hashes would crowd the low buckets
        found.append((spot[head] + at, even, doc[head], spot[head] - starts[tail], spot[head] - starts[head]))
    if not found:
        none = np.zeros(0, np.int64)
        return none, np.zeros(0, U64), none, none, none
    return tuple(np.concatenate(x) for x in zip(*found))


def _buckets(h: np.ndarray, n: int) -> np.ndarray:
    """Bucket of 48-bit hashes, in their order."""
    return ((h >> U64(16)) * U64(n) >> U64(32)).astype(np.int64)


def _sketch(shape: _Shape, n_buckets: int):
    def run(key: tuple, t: pa.Table) -> pa.Table:
        _, h, doc, _, _ = anchors(*buffer_of(t["bytes"]), shape)
        ids = ids_of(t["doc_id"])[doc]
        order = np.lexsort((ids, h))
        h, ids = h[order], ids[order]
        head = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1]))) if len(h) else np.zeros(0, np.int64)
        many = np.minimum.reduceat(ids, head) != np.maximum.reduceat(ids, head) if len(h) else np.zeros(0, bool)
        h = h[head]
        bucket = _buckets(h, n_buckets)
        cuts = np.searchsorted(bucket, np.arange(n_buckets + 1))
        full = [b for b in range(n_buckets) if cuts[b] < cuts[b + 1]]
        trim()
        return pa.table(
            {
                "bucket": pa.array(full, pa.int64()),
                "block": pa.array([key[0].as_py()] * len(full), pa.int64()),
                "all": pa.array([pack_sorted(h[cuts[b] : cuts[b + 1]]) for b in full], pa.binary()),
                "many": pa.array([pack_sorted(h[cuts[b] : cuts[b + 1]][many[cuts[b] : cuts[b + 1]]]) for b in full], pa.binary()),
            }
        )

    return run


def _shared(key: tuple, t: pa.Table) -> pa.Table:
    runs = [unpack_sorted(x) for x in t["all"].to_pylist()]
    h = np.sort(np.concatenate(runs))
    twice = h[1:][h[1:] == h[:-1]]
    shared = np.unique(np.concatenate([twice, *(unpack_sorted(x) for x in t["many"].to_pylist())]))
    out, blocks = [], []
    for block, run in zip(t["block"].to_pylist(), runs):
        own = run[_within(run, shared)]
        if len(own):
            out.append(pack_sorted(own))
            blocks.append(block)
    return pa.table({"block": pa.array(blocks, pa.int64()), "bucket": pa.array([key[0].as_py()] * len(out), pa.int64()), "hashes": pa.array(out, pa.binary())})


def _within(x: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    if not len(ordered):
        return np.zeros(len(x), bool)
    at = np.minimum(np.searchsorted(ordered, x), len(ordered) - 1)
    return ordered[at] == x


def _matrix(raw: np.ndarray, pos: np.ndarray, low: np.ndarray, high: np.ndarray, shape: _Shape) -> np.ndarray:
    """A row for each anchor: the bytes from it on, those before it from right to left, and which windows it stands for."""
    m = np.zeros((len(pos), (shape.width + 7) // 8 * 8), np.uint8)
    right, left = np.arange(shape.length), np.arange(shape.left)
    own = right[None, :] < (shape.length - low)[:, None]
    m[:, : shape.length][own] = raw[(pos[:, None] + right[None, :])[own]]
    own = left[None, :] < high[:, None]
    m[:, shape.length : shape.length + shape.left][own] = raw[(pos[:, None] - 1 - left[None, :])[own]]
    m[:, shape.width - 2], m[:, shape.width - 1] = low, high
    return m


def _suffixes(t: pa.Table, hashes: list[bytes], shape: _Shape, n_buckets: int, take=None):
    """The block's shared anchors with their row among its distinct suffixes, which are in the order of (bucket, suffix).

    The suffixes are made and sorted a few buckets at a time; take(rows, bucket, least doc_id) gets each part.
    """
    raw, offsets = buffer_of(t["bytes"])
    pos, h, doc, low, high = anchors(raw, offsets, shape)
    shared = np.sort(np.concatenate([unpack_sorted(x) for x in hashes])) if hashes else np.zeros(0, U64)
    keep = _within(h, shared)
    pos, doc, low, high, bucket = pos[keep], doc[keep], low[keep], high[keep], _buckets(h[keep], n_buckets)
    del h, shared, keep
    ids = ids_of(t["doc_id"])[doc]
    n, made = len(pos), 0
    row = np.empty(n, np.int64)
    by_bucket = np.argsort(bucket, kind="stable")
    ends = np.flatnonzero(np.r_[np.diff(bucket[by_bucket]) != 0, np.ones(min(n, 1), bool)]) + 1
    at = 0
    while at < n:
        to = int(ends[min(np.searchsorted(ends, at + ROWS), len(ends) - 1)])
        part = by_bucket[at:to]
        m = _matrix(raw, pos[part], low[part], high[part], shape)
        words = m.view(">u8").astype(U64)
        order = np.lexsort((ids[part], *(words[:, k] for k in range(words.shape[1] - 1, -1, -1)), bucket[part]))
        m, part = m[order], part[order]
        new = np.concatenate(([True], (m[1:] != m[:-1]).any(1) | (bucket[part][1:] != bucket[part][:-1])))
        row[part] = np.cumsum(new) - 1 + made
        made += int(new.sum())
        if take:
            head = part[new]
            take(m[new][:, : shape.width], bucket[head], ids[head])
        at = to
    return pos, doc, low, high, row


def front_code(m: np.ndarray) -> bytes:
    """Sorted rows as common-prefix lengths (a byte each) and what follows them."""
    n, width = m.shape
    lcp = np.zeros(n, np.uint8)
    if n > 1:
        differ = m[1:] != m[:-1]
        lcp[1:] = np.where(differ.any(1), differ.argmax(1), width)
    keep = np.arange(width)[None, :] >= lcp[:, None]
    return np.uint32(n).tobytes() + lcp.tobytes() + m[keep].tobytes()


def front_decode(data: bytes, width: int) -> tuple[np.ndarray, np.ndarray]:
    n = int(np.frombuffer(data, np.uint32, 1)[0])
    lcp = np.frombuffer(data, np.uint8, n, 4)
    keep = np.arange(width)[None, :] >= lcp[:, None]
    m = np.zeros((n, width), np.uint8)
    m[keep] = np.frombuffer(data, np.uint8, offset=4 + n)
    rows = np.arange(n)
    for j in range(width):
        m[:, j] = m[np.maximum.accumulate(np.where(keep[:, j], rows, 0)), j]
    return lcp, m


def merge_runs(runs: list[tuple[list[bytes], list[int]]], width: int) -> tuple[list[int], list[int]]:
    """Merge sorted runs of equally long strings by a loser tree.

    runs: (strings, common prefix of each with the one before it). Returns the run that
    each place of the order comes from, and its common prefix with the place before. Each
    waiting string keeps its common prefix with the last string put out along its path:
    the longer of two prefixes wins without a look at the strings, and equal prefixes
    are compared from their end on.
    """
    k = 1
    while k < len(runs):
        k *= 2
    done = (None, -1)
    strings = [r[0] for r in runs] + [[]] * (k - len(runs))
    known = [r[1] for r in runs] + [[]] * (k - len(runs))
    cursor = [0] * k
    current = [s[0] if s else None for s in strings]
    prefix = [0] * k  # with the last output
    tree = [0] * k  # losers

    def beats(x: int, y: int) -> bool:
        """Whether x comes before y; the loser's prefix becomes that with the winner."""
        a, b = current[x], current[y]
        if b is None:
            return True
        if a is None:
            return False
        h, g = prefix[x], prefix[y]
        if h != g:
            return h > g
        while h < width:
            p, q = a[h : h + 8], b[h : h + 8]
            if p != q:
                h += (8 * len(p) - (int.from_bytes(p, "big") ^ int.from_bytes(q, "big")).bit_length()) // 8
                if p < q:
                    prefix[y] = h
                    return True
                prefix[x] = h
                return False
            h += 8
        if x < y:
            prefix[y] = width
            return True
        prefix[x] = width
        return False

    def play(node: int) -> int:
        if node >= k:
            return node - k
        a, b = play(2 * node), play(2 * node + 1)
        if beats(a, b):
            tree[node] = b
            return a
        tree[node] = a
        return b

    winner = play(1) if k > 1 else 0
    out, lcps = [], []
    while current[winner] is not None:
        out.append(winner)
        lcps.append(prefix[winner])
        c = cursor[winner] = cursor[winner] + 1
        if c < len(strings[winner]):
            current[winner] = strings[winner][c]
            prefix[winner] = known[winner][c]
        else:
            current[winner], prefix[winner] = done
        node = (winner + k) >> 1
        while node:
            other = tree[node]
            if not beats(winner, other):
                tree[node] = winner
                winner = other
            node >>= 1
    return out, lcps


def _runs(shape: _Shape, n_buckets: int):
    def run(key: tuple, docs: pa.Table, side: pa.Table) -> pa.Table:
        out: dict[str, list] = {"bucket": [], "run": [], "ids": []}

        def take(m, bucket, ids):
            for b in np.unique(bucket).tolist():
                lo, hi = np.searchsorted(bucket, [b, b + 1])
                out["bucket"].append(b)
                out["run"].append(front_code(m[lo:hi]))
                out["ids"].append(ids[lo:hi].tobytes())

        if docs.num_rows:
            _suffixes(docs, side["hashes"].to_pylist(), shape, n_buckets, take)
        trim()
        return pa.table({"bucket": pa.array(out["bucket"], pa.int64()), "block": pa.array([key[0].as_py()] * len(out["bucket"]), pa.int64()), "run": pa.array(out["run"], pa.binary()), "ids": pa.array(out["ids"], pa.binary())})

    return run


def _merge(shape: _Shape):
    def run(key: tuple, t: pa.Table) -> pa.Table:
        t = t.sort_by("block")
        coded = [front_decode(x, shape.width) for x in t["run"].to_pylist()]
        size = [len(m) for _, m in coded]
        begin = np.concatenate(([0], np.cumsum(size)))
        tree_in = []
        for lcp, m in coded:
            flat = m.tobytes()
            tree_in.append(([flat[i : i + shape.width] for i in range(0, len(flat), shape.width)], lcp.tolist()))
        came, lcps = merge_runs(tree_in, shape.width)
        del tree_in
        came, lcp = np.array(came, np.int64), np.array(lcps, np.int64)
        order = np.argsort(came, kind="stable")
        place = np.empty(len(came), np.int64)  # of each row, run by run, in the order of the merge
        place[:] = order
        m = np.concatenate([m for _, m in coded]) if coded else np.zeros((0, shape.width), np.uint8)
        del coded
        ids = np.concatenate([np.frombuffer(x, np.int64) for x in t["ids"].to_pylist()])
        merged = np.empty(len(place), np.int64)
        merged[place] = np.arange(len(place))
        head = np.flatnonzero(lcp < shape.width)  # the first of equal suffixes
        mask, first = _windows(m[merged][head], lcp[head], np.minimum.reduceat(ids[merged], head), shape)
        of = np.empty(len(place), np.int64)
        of[merged] = np.cumsum(lcp < shape.width) - 1
        mask, first = mask[of], first[of]
        blocks = t["block"].to_pylist()
        del m, ids, merged
        trim()
        return pa.table(
            {
                "block": pa.array(blocks, pa.int64()),
                "bucket": pa.array([key[0].as_py()] * len(blocks), pa.int64()),
                "mask": pa.array([mask[begin[i] : begin[i + 1]].tobytes() for i in range(len(blocks))], pa.binary()),
                "first": pa.array([first[begin[i] : begin[i + 1]].tobytes() for i in range(len(blocks))], pa.binary()),
            }
        )

    return run


def _windows(m: np.ndarray, lcp: np.ndarray, ids: np.ndarray, shape: _Shape) -> tuple[np.ndarray, np.ndarray]:
    """For sorted distinct suffixes: the windows (a bit each) that start in a document before their first one."""
    low, high = m[:, shape.width - 2], m[:, shape.width - 1]
    mask = np.zeros(len(m), np.int64)
    left = np.zeros(len(m), U64)
    for o in range(shape.slots):
        if o:
            left = left * U64(0x100000001B3) + m[:, shape.length + o - 1].astype(U64) + U64(1)
        at = np.flatnonzero((low <= o) & (o <= high))
        if not len(at):
            continue
        group = np.cumsum(lcp < shape.length - o)[at].astype(U64)
        k = mix(group * U64(0x9E3779B97F4A7C15) + mix(left[at] + U64(o)))
        order = np.argsort(k, kind="stable")
        k = k[order]
        head = np.concatenate(([True], k[1:] != k[:-1]))
        least = np.minimum.reduceat(ids[at][order], np.flatnonzero(head))[np.cumsum(head) - 1]
        hit = at[order][least < ids[at][order]]
        mask[hit] |= 1 << o
    return mask, ids


def repeated(raw_len: int, marks: np.ndarray, length: int) -> np.ndarray:
    """Bytes covered by the windows that start at ``marks``."""
    edge = np.zeros(raw_len + 1, np.int32)
    np.add.at(edge, marks, 1)
    np.add.at(edge, np.minimum(marks + length, raw_len), -1)
    return np.cumsum(edge[:-1]) > 0


def _settle(shape: _Shape, n_buckets: int, digest: bool):
    def run(key: tuple, docs: pa.Table, side: pa.Table) -> pa.Table:
        hashes = [x for x in side["hashes"].to_pylist() if x is not None]
        pos, doc, low, high, row = _suffixes(docs, hashes, shape, n_buckets)
        back = side.filter(pc.is_valid(side["mask"])).sort_by("bucket") if side.num_rows else side
        mask = np.concatenate([np.frombuffer(x, np.int64) for x in back["mask"].to_pylist()] or [np.zeros(0, np.int64)])
        first = np.concatenate([np.frombuffer(x, np.int64) for x in back["first"].to_pylist()] or [np.zeros(0, np.int64)])
        raw, offsets = buffer_of(docs["bytes"])
        ids = ids_of(docs["doc_id"])
        later = ids[doc] > first[row] if len(row) else np.zeros(0, bool)
        marks = []
        for o in range(shape.slots):
            hit = (low <= o) & (o <= high) & (later | ((mask[row] >> o) & 1).astype(bool)) if len(row) else np.zeros(0, bool)
            marks.append(pos[hit] - o)
        gone = repeated(len(raw), np.concatenate(marks), shape.length)
        n_removed, n_spans, texts, digests = [], [], [], []
        for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
            g = gone[a:b]
            n_removed.append(int(g.sum()))
            n_spans.append(int(g[:1].sum() + (g[1:] & ~g[:-1]).sum()))
            kept = raw[a:b][~g].tobytes() if n_removed[-1] else raw[a:b].tobytes()
            if digest:
                digests.append(hashlib.sha256(kept).hexdigest())
            else:
                texts.append(kept.decode("utf-8", "ignore"))
        out = {"doc_id": docs["doc_id"], "n_bytes": pa.array(np.diff(offsets)), "n_removed": pa.array(n_removed, pa.int64()), "n_spans": pa.array(n_spans, pa.int64())}
        if digest:
            out["kept_sha256"] = pa.array(digests, pa.string())
        else:
            out["kept"] = pa.array(texts, pa.string())
            out["row"] = docs["row"]
        del raw, gone, marks, pos, doc, row
        trim()
        return pa.table(out)

    return run


def cut_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, digest: bool = False, block_bytes: int = 6 << 20) -> DataFrame:
    """Remove each byte of a text that a string of ``length`` bytes covers which also starts in a document with a smaller doc_id.

    docs: columns doc_id (integer) and text. Texts are UTF-8 bytes, null counts as empty;
    matches never cross documents, overlaps count, and strings are judged on the input. Rows
    with a null doc_id come before nothing and after nothing: they stay whole and remove
    nothing. Rows that repeat a doc_id don't remove from one another.

    digest=False returns the columns of docs with the text replaced (a null text stays null;
    the rest of a character that a cut goes through goes too) plus n_removed and n_spans;
    digest=True returns doc_id, n_bytes, n_removed, n_spans and kept_sha256.
    """
    shape = _Shape(length, gram)
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    base = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("bytes"), F.struct(F.col("text").isNull().alias("no_text"), *([] if digest else [F.col(f"`{c}`") for c in others])).alias("row"))
    total = text_bytes(docs)
    n_blocks = parts_for(total, block_bytes)
    n_buckets = n_blocks
    rows = base.where("doc_id is not null").withColumn("block", F.pmod(F.xxhash64("doc_id", F.octet_length("bytes")), F.lit(n_blocks)))
    lean = rows.select("block", "doc_id", "bytes")
    sketch = lean.groupBy("block").applyInArrow(_sketch(shape, n_buckets), "bucket bigint, block bigint, all binary, many binary")
    shared = saved(sketch.groupBy("bucket").applyInArrow(_shared, "block bigint, bucket bigint, hashes binary"), "shared")
    runs = lean.groupBy("block").cogroup(shared.groupBy("block")).applyInArrow(_runs(shape, n_buckets), "bucket bigint, block bigint, run binary, ids binary")
    masks = saved(runs.groupBy("bucket").applyInArrow(_merge(shape), "block bigint, bucket bigint, mask binary, first binary"), "masks")
    side = shared.select("block", "bucket", "hashes", F.lit(None).cast("binary").alias("mask"), F.lit(None).cast("binary").alias("first")).unionByName(masks.select("block", "bucket", F.lit(None).cast("binary").alias("hashes"), "mask", "first"))
    row_type = base.schema["row"].dataType
    fields = [T.StructField("doc_id", T.LongType()), T.StructField("n_bytes", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("n_spans", T.LongType())]
    fields += [T.StructField("kept_sha256", T.StringType())] if digest else [T.StructField("kept", T.StringType()), T.StructField("row", row_type)]
    full = rows.select("block", "doc_id", "bytes", *([] if digest else ["row"]))
    out = full.groupBy("block").cogroup(side.groupBy("block")).applyInArrow(_settle(shape, n_buckets, digest), T.StructType(fields))
    loose = base.where("doc_id is null")
    rest = [F.octet_length("bytes").cast("bigint"), F.lit(0).cast("bigint"), F.lit(0).cast("bigint")]
    size = F.coalesce(rest[0], F.lit(0).cast("bigint")).alias("n_bytes")
    if digest:
        loose = loose.select("doc_id", size, rest[1].alias("n_removed"), rest[2].alias("n_spans"), F.sha2(F.coalesce("bytes", F.lit(b"")), 256).alias("kept_sha256"))
        return out.unionByName(loose)
    out = out.unionByName(loose.select("doc_id", size, rest[1].alias("n_removed"), rest[2].alias("n_spans"), F.col("bytes").cast("string").alias("kept"), "row"))
    text = F.when(~F.col("row.no_text"), F.col("kept"))
    return out.select(*[{"doc_id": F.col("doc_id").cast(docs.schema["doc_id"].dataType).alias("doc_id"), "text": text.alias("text")}.get(c, F.col(f"row.`{c}`").alias(c)) for c in docs.columns], *[x for x in ("n_removed", "n_spans") if x not in docs.columns])


def op3_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    """Contract query: 50-byte strings, all of documents."""
    return cut_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"), digest=True)
