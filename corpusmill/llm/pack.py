"""Packing token sequences: minimum bin slack over the histogram of piece lengths."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import ids_of, saved

class ByteBpe:
    """Token ids of whole texts as little-endian unsigned 32-bit bytes, equal to the tokenizers library's.

    ranks: a rank file of the same vocabulary, whose merges run several times as fast; a
    text with a special token's string goes to the tokenizers library, and so do all texts
    without ranks.
    """

    def __init__(self, path: str, ranks: str | None, pattern: str | None):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.special = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        self.merge = None
        if ranks:
            import base64

            import tiktoken

            merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(ranks, "rb"))}
            self.merge = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=merges, special_tokens={})._core_bpe.encode_ordinary

    def __call__(self, text: str) -> bytes:
        if self.merge and not any(s in text for s in self.special):
            return np.array(self.merge(text), "<u4").tobytes()
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def _pieces(tokenizer: str, ranks: str | None, pattern: str | None, end: int, limit: int, with_ids: bool):
    last = np.uint32(end).tobytes()

    def run(batches):
        from pyspark import TaskContext

        encode = ByteBpe(tokenizer, ranks, pattern)
        part, seen = TaskContext.get().partitionId(), np.zeros(limit + 1, np.int64)
        for batch in batches:
            rows = {k: [] for k in ("at", "piece", "start", "length", "crc", "rank", "ids")}
            for i, text in enumerate(batch.column(1)):
                ids = encode(text.as_py() or "") + last
                n = len(ids) // 4
                first = n % limit or limit
                start = 0
                for piece in range((n + limit - 1) // limit):
                    stop = first if piece == 0 else start + limit
                    part_ids = ids[4 * start : 4 * stop]
                    rows["at"].append(i)
                    rows["piece"].append(piece)
                    rows["start"].append(start)
                    rows["length"].append(stop - start)
                    rows["crc"].append(zlib.crc32(part_ids))
                    rows["rank"].append(seen[stop - start])
                    if with_ids:
                        rows["ids"].append(np.frombuffer(part_ids, "<u4").astype(np.int32))
                    seen[stop - start] += 1
                    start = stop
            out = {
                "doc_id": batch.column(0).take(pa.array(rows["at"], pa.int64())),
                "piece": pa.array(rows["piece"], pa.int32()),
                "start": pa.array(rows["start"], pa.int64()),
                "length": pa.array(rows["length"], pa.int64()),
                "ids_crc32": pa.array(rows["crc"], pa.int64()),
                "part": pa.array([part] * len(rows["at"]), pa.int32()),
                "rank": pa.array(rows["rank"], pa.int64()),
            }
            if with_ids:
                out["ids"] = pa.array(rows["ids"], pa.list_(pa.int32()))
            yield pa.record_batch(out)

    return run


def fullest(counts: np.ndarray, first: int, limit: int) -> list[tuple[int, int]]:
    """The fullest bin that holds a piece of length ``first``, as (length, how many).

    Subset sums over the lengths that are left are the bits of an integer: a length that
    occurs k times shifts them by 1, 2, 4, .. pieces, k in all. Longer ones come first; of
    equally full bins, that with the longer pieces is taken. The walk back over the bits
    kept after each shift finds the pieces.
    """
    room = limit - first
    all_bits = (1 << (room + 1)) - 1
    bits, steps = 1, []
    have = counts.copy()
    have[first] -= 1
    for length in np.flatnonzero(have[: room + 1])[::-1].tolist():
        if not length:
            continue
        left, size = min(int(have[length]), room // length), 1
        while left:
            size = min(size, left)
            steps.append((length, size, bits))
            bits |= (bits << (length * size)) & all_bits
            left -= size
            size *= 2
        if bits >> room & 1:
            break
    at = bits.bit_length() - 1
    chosen = {first: 1}
    for length, size, before in reversed(steps):
        if not before >> at & 1:  # this sum needs the step
            chosen[length] = chosen.get(length, 0) + size
            at -= length * size
    return sorted(chosen.items(), reverse=True)


def patterns(counts: np.ndarray, limit: int) -> list[tuple[list[tuple[int, int]], int]]:
    """(pieces of a bin, how many such bins) until no piece is left.

    Each bin takes the longest piece left and the fullest combination with it. A bin is
    repeated as often as its lengths last, so the work depends on the number of distinct
    lengths, not on that of pieces.
    """
    counts = counts.astype(np.int64).copy()
    out = []
    while counts.any():
        first = int(np.flatnonzero(counts)[-1])
        pieces = fullest(counts, first, limit)
        times = min(int(counts[n]) // k for n, k in pieces)
        for n, k in pieces:
            counts[n] -= k * times
        out.append((pieces, times))
    return out


def _slots(found: list, limit: int) -> dict[int, tuple[np.ndarray, ...]]:
    """For each length: first rank, copies in a bin, first bin and first offset of each pattern that has it."""
    by: dict[int, list] = {}
    used = np.zeros(limit + 1, np.int64)
    base = 0
    for pieces, times in found:
        offset = 0
        for length, k in pieces:
            by.setdefault(length, []).append((used[length], k, base, offset))
            used[length] += k * times
            offset += k * length
        base += times
    return {n: tuple(np.array(c, np.int64) for c in zip(*rows)) for n, rows in by.items()}


def _place(slots: dict):
    def run(batches):
        for batch in batches:
            length, rank = ids_of(batch.column(batch.schema.get_field_index("length"))), ids_of(batch.column(batch.schema.get_field_index("rank")))
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            for n in np.unique(length).tolist():
                at = np.flatnonzero(length == n)
                first, copies, base, begin = slots[n]
                k = np.searchsorted(first, rank[at], side="right") - 1
                r = rank[at] - first[k]
                sequence[at] = base[k] + r // copies[k]
                offset[at] = begin[k] + r % copies[k] * n
            keep = [c for c in batch.schema.names if c != "rank"]
            yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(c)) for c in keep), pa.array(sequence), pa.array(offset)], names=[*keep, "sequence_id", "offset"])

    return run


def pack(docs: DataFrame, tokenizer: str, ranks: str | None = None, pattern: str | None = None, end: int = 2, limit: int = 1024, with_ids: bool = True) -> DataFrame:
    """Pack documents into sequences of at most ``limit`` tokens by minimum bin slack.

    docs: columns doc_id and text; others are not read. Each row's token ids and the id
    ``end`` are cut, if longer than ``limit``, into pieces of ``limit`` of which the first may
    be shorter. tokenizer and ranks are paths, read on each executor; ranks and the pattern that
    splits text before their merges go together. Null and empty texts
    are the one id ``end``; null or repeated doc_ids are packed row by row like any other; an
    empty table gives no rows. with_ids adds the pieces' ids.

    Only how many pieces have each length, ``limit`` numbers, decides the bins: these counts
    come to the driver, which makes bin patterns with how often each is used. A piece's place
    follows from its rank among those of its length: its rank within its task plus the
    pieces of earlier tasks. Texts are read once and never shuffled.
    """
    ids = ", ids array<int>" if with_ids else ""
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, part int, rank bigint{ids}"
    cut = docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(_pieces(tokenizer, ranks, pattern, end, limit, with_ids), schema)
    pieces = saved(cut, "pieces")
    sizes = saved(pieces.groupBy("part", "length").agg(F.count("*").alias("n")), "sizes")
    counts = np.zeros(limit + 1, np.int64)
    for length, n in sizes.groupBy("length").agg(F.sum("n")).collect():  # at most ``limit`` rows
        counts[length] = n
    slots = _slots(patterns(counts, limit), limit)
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    begins = sizes.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("begin"))
    ranked = pieces.join(begins, ["part", "length"]).withColumn("rank", F.col("rank") + F.col("begin"))
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])]
    return ranked.select(*columns, "rank").mapInArrow(_place(slots), f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint{ids}, sequence_id bigint, offset bigint")


def public_paths() -> tuple[str, str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def op6_pack(spark, sf_dir: str) -> DataFrame:
    """Contract query: byte_bpe_50k ids and id 2, at most 1024 tokens, all of documents."""
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"), *public_paths(), with_ids=False)
