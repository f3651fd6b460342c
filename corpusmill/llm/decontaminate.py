"""Benchmark decontamination: the rarer words of test items lead to passages, Smith-Waterman scores them."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import U64, buffer_of, drop, parts_for, saved, slices, word_hashes

SEED_SHARE = 5  # a copy is looked at once it holds one in so many of the words that it must hold
MATCH, MISMATCH, GAP = 2, 1, 1
SCORE = 0.5
BENCHMARK_BYTES = 16 << 20  # of test items that are broadcast at once
CELLS = 1 << 18
ENTRIES = 1 << 22  # (seed, item) pairs of documents that are sorted at once


@dataclass
class Seeds:
    """Test items as word hashes, and their seeds: sorted hashes, and the items of the k-th from first[k] to first[k + 1].

    For each item: how many of its words a copy matches at least, how many of its seeds, and over how many words at most.
    """

    ids: list
    words: np.ndarray
    starts: np.ndarray
    matches: np.ndarray
    need: np.ndarray
    span: np.ndarray
    hashes: np.ndarray
    first: np.ndarray
    item: np.ndarray


def _finder(hashes: np.ndarray):
    """A look-up of many hashes in a sorted array: which are there, and where."""
    bits = np.zeros(1 << 20, bool)
    bits[(hashes >> U64(44)).astype(np.int64)] = True

    def find(g: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.flatnonzero(bits[(g >> U64(44)).astype(np.int64)])
        place = np.minimum(np.searchsorted(hashes, g[at]), len(hashes) - 1)
        good = hashes[place] == g[at]
        return at[good], place[good]

    return find


def _count(hashes: np.ndarray):
    """How often each hash is a word of the texts, summed over a task: rows (place, times)."""

    def run(batches):
        find, total = _finder(hashes), np.zeros(len(hashes), np.int64)
        for batch in batches:
            for part in slices(batch, "text"):
                words, _, _, _ = word_hashes(*buffer_of(part.column(0)), bare=True)
                total += np.bincount(find(words)[1], minlength=len(hashes))
        at = np.flatnonzero(total)
        yield pa.record_batch({"place": pa.array(at), "times": pa.array(total[at])})

    return run


def make_seeds(docs: DataFrame, items: list, score: float = SCORE) -> Seeds:
    """Seeds of the items: so many of an item's words that a copy which reaches the score holds ``need`` of them.

    A copy matches at least score * length words of its item, so all but ``matches - need`` words
    of an item are enough. Which ones only decides the work: those that are rarest in docs.
    """
    texts = [t for _, t in items]
    words, starts, _, _ = word_hashes(np.frombuffer(b"".join(texts), np.uint8), np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64), bare=True)
    hashes = np.unique(words)
    times = np.zeros(len(hashes), np.int64)
    if len(hashes):
        counted = docs.select(F.col("text").cast("string").cast("binary").alias("text")).mapInArrow(_count(hashes), "place bigint, times bigint")
        for place, k in counted.groupBy("place").agg(F.sum("times")).collect():  # a row for each word of the items at most
            times[place] = k
    length = np.diff(starts)
    matches = np.maximum(1, np.ceil(score * length - 1e-9).astype(np.int64))
    need = 1 + (matches - 1) // SEED_SHARE
    span = length + (MATCH * length * (1 - score) / min(MISMATCH, GAP)).astype(np.int64) + 1  # more gaps than this can't reach the score
    place = np.searchsorted(hashes, words)
    owner = np.repeat(np.arange(len(length)), length)
    order = np.lexsort((times[place], owner))  # each item's words, the rarest first
    rank = np.arange(len(words)) - np.repeat(starts[:-1], length)
    used = order[rank < (length - matches + need)[owner]]
    pair = np.unique(place[used] * max(1, len(items)) + owner[used])
    seed, item = np.divmod(pair, max(1, len(items)))
    own, first = np.unique(seed, return_index=True)
    return Seeds([i for i, _ in items], words, starts, matches, need, span, hashes[own], np.r_[first, len(pair)], item)


def smith_waterman(items: list[np.ndarray], passages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best local alignment of each item with its passage: score, and the passage's word after its end, the item's too.

    All pairs of a call go through the rows of the item together. A row's insertions are a
    running maximum, so that no row needs a loop over words.
    """
    b, rows, width = len(items), max(map(len, items)), max(map(len, passages))
    item, passage = np.zeros((b, rows), U64), np.ones((b, width), U64)
    for k, (x, y) in enumerate(zip(items, passages)):
        item[k, : len(x)], passage[k, : len(y)] = x, y
    slope = np.arange(width + 1, dtype=np.int32) * GAP
    h = np.zeros((b, width + 1), np.int32)
    best, end, row = np.zeros(b, np.int32), np.zeros(b, np.int64), np.zeros(b, np.int64)
    for i in range(rows):
        new = np.zeros_like(h)
        np.maximum(h[:, :-1] + np.where(item[:, i : i + 1] == passage, np.int32(MATCH), np.int32(-MISMATCH)), h[:, 1:] - GAP, out=new[:, 1:])
        np.maximum(new, 0, out=new)
        new += slope
        np.maximum.accumulate(new, axis=1, out=new)
        new -= slope
        h = new
        top = h.argmax(1)
        value = h[np.arange(b), top]
        up = value > best
        best[up], end[up], row[up] = value[up], top[up], i + 1
    return best, end, row


def _in(words: np.ndarray, held: np.ndarray) -> np.ndarray:
    """Which words are in ``held``, which is sorted."""
    return held[np.minimum(held.searchsorted(words), len(held) - 1)] == words


def _heads(group: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of intervals in order, those that begin a run of overlapping ones of a group, and those that end one."""
    new = (group[1:] != group[:-1]) | (a[1:] >= b[:-1])
    return np.flatnonzero(np.r_[True, new]), np.flatnonzero(np.r_[new, True])


def _candidates(words, starts, find, seeds: Seeds):
    """(document, item, first word, end word) of all passages that can reach the score."""
    at, place = find(words)
    many = np.diff(seeds.first)[place]
    doc = np.searchsorted(starts, at, side="right") - 1
    done = np.r_[0, np.cumsum(many)]
    ends = np.searchsorted(at, starts[1:])  # of each document
    begin = 0
    while begin < len(at):
        # whole documents of at most ENTRIES pairs, or one document
        to = int(ends[max(np.searchsorted(done[ends], done[begin] + ENTRIES, side="right") - 1, doc[begin])])
        yield from _passages(words, starts, at[begin:to], doc[begin:to], place[begin:to], many[begin:to], seeds)
        begin = to


def _passages(words, starts, at, doc, place, many, seeds: Seeds):
    k = np.repeat(np.arange(len(at)), many)
    item = seeds.item[seeds.first[place][k] + np.arange(len(k)) - np.repeat(np.cumsum(many) - many, many)]
    group = doc[k] * len(seeds.ids) + item
    order = np.argsort(group, kind="stable")
    group, at = group[order], at[k[order]]
    doc, item = np.divmod(group, len(seeds.ids))
    last = np.arange(len(at)) + seeds.need[item] - 1
    inside = np.minimum(last, len(at) - 1)
    good = (last < len(at)) & (group[inside] == group) & (at[inside] - at < seeds.span[item])
    if not good.any():
        return
    group, doc, item, at = group[good], doc[good], item[good], at[good]
    a, b = np.maximum(at - seeds.span[item], starts[doc]), np.minimum(at + seeds.span[item], starts[doc + 1])
    head, tail = _heads(group, a, b)
    ordered: dict[int, np.ndarray] = {}
    for d, i, x, y in zip(doc[head].tolist(), item[head].tolist(), a[head].tolist(), b[tail].tolist()):
        own, least, span = seeds.words[seeds.starts[i] : seeds.starts[i + 1]], int(seeds.matches[i]), int(seeds.span[i])
        if i not in ordered:
            ordered[i] = np.sort(own)
        hit = x + np.flatnonzero(_in(words[x:y], ordered[i]))
        if len(hit) < least:
            continue
        hit = hit[: len(hit) - least + 1][hit[least - 1 :] - hit[: len(hit) - least + 1] < span]  # enough of the item's words follow
        if not len(hit):
            continue
        end = np.minimum(hit + span, y)
        first, final = _heads(np.zeros(len(hit)), hit, end)
        for v, w in zip(hit[first].tolist(), end[final].tolist()):
            if _in(own, np.sort(words[v:w])).sum() >= least:
                yield d, i, v, w


def _copy_at(item: np.ndarray, passage: np.ndarray) -> int:
    """Where the passage first holds the item word for word, or -1."""
    at = np.flatnonzero(passage[: max(0, len(passage) - len(item) + 1)] == item[0])
    for k in (len(item) - 1, len(item) // 2, len(item) // 3):
        at = at[passage[at + k] == item[k]]
    return next((i for i in at.tolist() if np.array_equal(passage[i : i + len(item)], item)), -1)


def _aligned(words, candidates: list, seeds: Seeds, score: float):
    """(document, item, score, first word, end word) of each candidate that reaches the score. Whole copies need no alignment: nothing scores more, and the first one counts."""
    own = [seeds.words[seeds.starts[i] : seeds.starts[i + 1]] for _, i, _, _ in candidates]
    order = []
    for k in sorted(range(len(candidates)), key=lambda k: candidates[k][3] - candidates[k][2]):
        d, i, x, y = candidates[k]
        at = _copy_at(own[k], words[x:y])
        if at < 0:
            order.append(k)
        else:
            yield d, i, 1.0, x + at, x + at + len(own[k])
    while order:
        size, width = 0, 0
        while size < len(order) and size * (width := candidates[order[size]][3] - candidates[order[size]][2]) <= CELLS:
            size += 1
        now, order = order[: max(1, size)], order[max(1, size) :]
        passages = [words[candidates[k][2] : candidates[k][3]] for k in now]
        best, end, row = smith_waterman([own[k] for k in now], passages)
        good = [j for j, k in enumerate(now) if best[j] >= score * MATCH * len(own[k])]
        if not good:
            continue
        # the same alignment from its end backwards finds where it begins
        _, back, _ = smith_waterman([own[now[j]][: row[j]][::-1] for j in good], [passages[j][: end[j]][::-1] for j in good])
        for j, n in zip(good, back.tolist()):
            d, i, x, _ = candidates[now[j]]
            yield d, i, float(best[j]) / (MATCH * len(own[now[j]])), x + int(end[j]) - n, x + int(end[j])


LEAK = pa.struct([("item_id", pa.int64()), ("score", pa.float64()), ("begin", pa.int32()), ("end", pa.int32())])
LEAKS = "array<struct<item_id:bigint,score:double,begin:int,end:int>>"


def _search(broadcast, score: float, names: list[str]):
    def run(batches):
        seeds: Seeds = broadcast.value
        find = _finder(seeds.hashes)
        for batch in batches:
            for part in slices(batch, "text"):
                raw, offsets = buffer_of(part.column(0))
                words, starts, first, last = word_hashes(raw, offsets, bare=True)
                leaks: list[dict] = [{} for _ in range(part.num_rows)]
                for d, i, value, x, y in _aligned(words, list(_candidates(words, starts, find, seeds)) if len(seeds.hashes) else [], seeds, score):
                    if i not in leaks[d] or (value, -x) > (leaks[d][i][0], -leaks[d][i][1]):
                        leaks[d][i] = (value, x, y)
                rows = part.column(1).to_pylist()
                for d, found in enumerate(leaks):
                    rows[d] += [{"item_id": seeds.ids[i], "score": v, "begin": int(first[x] - offsets[d]), "end": int(last[y - 1] - offsets[d])} for i, (v, x, y) in sorted(found.items())]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(rows, pa.list_(LEAK)), part.column(2)], names=names)

    return run


def find_leaks(docs: DataFrame, benchmark: DataFrame, score: float = SCORE, benchmark_bytes: int = BENCHMARK_BYTES) -> DataFrame:
    """docs plus ``leaks``: the test items that a document holds a copy of, edited or not.

    docs: text and any others; benchmark: item_id (integer) and text. Words are runs of letters and
    digits, lower-cased; punctuation doesn't count. A leak is a local alignment (match 2, others
    -1) of at least ``score`` of the item's own, and every one is found, however frequent the
    item's words are: it matches ``score`` of them within a bounded passage, so those passages that hold
    enough of its words are aligned in full. Each leak has item_id, score (of 1), and
    the first and end byte of the text that align; of several in a document the best (then
    the first) stands for an item. Null, empty and wordless texts and items leak nothing; equal
    items each count, repeated rows of the benchmark once; a null item_id is kept as such. A
    column of docs named ``leaks`` is replaced.

    Items are broadcast in chunks of ``benchmark_bytes`` of text at most (or one longer item).
    Documents are never shuffled; each chunk reads them to count its words and passes them on. All chunks but
    the last are jobs of their own, which write what they found with the documents: a
    chunk's broadcast is gone before the next one's is made.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), F.col("text").cast("string").cast("binary").alias("text")).where("octet_length(text) > 0").distinct()
    chunks = parts_for(items.agg(F.sum(F.octet_length("text"))).first()[0], benchmark_bytes)
    others = [c for c in docs.columns if c not in ("text", "leaks")]
    out = docs.select(F.col("text").cast("string").cast("binary").alias("text"), F.array().cast(LEAKS).alias("leaks"), F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in others]).alias("row"))
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in out.schema])
    for chunk in range(chunks):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(chunks)) == chunk)
        rows = sorted(((r[0], bytes(r[1])) for r in part.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        held = spark.sparkContext.broadcast(make_seeds(docs, rows, score))
        found = out.mapInArrow(_search(held, score, schema.names), schema)
        if chunk < chunks - 1:
            found = saved(found, "leaks")
            drop(out)
            held.destroy()
        out = found
    return out.select(*[F.col("text").cast("string").alias("text") if c == "text" else F.col(f"row.`{c}`").alias(c) for c in docs.columns if c != "leaks"], "leaks")


def decontaminate(docs: DataFrame, benchmark: DataFrame, score: float = SCORE) -> DataFrame:
    """docs without those that hold a copy of a test item; see find_leaks. A column named ``leaks`` goes."""
    kept = find_leaks(docs, benchmark, score).where(F.size("leaks") == 0)
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns if c != "leaks"])


def op4_decontaminate(spark, sf_dir: str) -> DataFrame:
    """A row for each test item of benchmark in each document that holds a copy of it."""
    docs, benchmark = (spark.read.parquet(f"{sf_dir}/{t}.parquet").select(k, "text") for t, k in (("documents", "doc_id"), ("benchmark", "item_id")))
    return find_leaks(docs, benchmark).select("doc_id", F.explode("leaks").alias("leak")).select("doc_id", "leak.*")
