"""WARC archives of pages, and their capture index: locally sorted runs under a k-way loser-tree merge."""

from __future__ import annotations

import base64
import datetime
import gzip
import hashlib
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import parts_for, release, saved, shared_dir, slices

RUN_ROWS = 200_000  # captures that one merging task gets, about


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def url_key(url: str) -> str:
    """A sort key for a URL: host labels from the last to the first, then path and query; no scheme, ``www.``, port 80 or 443, or fragment; A-Z lower-cased."""
    rest = url.split("://", 1)[-1].split("#", 1)[0]
    cut = re.search(r"[/?]", rest)
    host, path = (rest, "/") if not cut else (rest[: cut.start()], rest[cut.start() :])
    host = re.sub(r":(80|443)$", "", host.rsplit("@", 1)[-1].lower())
    host = host[4:] if host.startswith("www.") else host
    return ",".join(reversed(host.split("."))) + ")" + (path if path.startswith("/") else "/" + path).lower()


# ---------------------------------------------------------------- archives

ARCHIVE_BYTES = 16 << 20  # of an archive, unless one record is longer
MEMBER_BYTES = 8 << 20  # of a record that one gzip member holds
CLOSING = "\0"  # the highest byte of a member's length, which is its last four bytes


def _record(page_id, url, digest, kind, refers_to, seconds, payload: bytes) -> bytes:
    when = datetime.datetime.fromtimestamp(seconds, datetime.UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    body = payload if kind == "response" else b""
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{page_id}>", f"WARC-Date: {when}"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    head += [f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Length: {len(payload)}"]
    if kind == "revisit":
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    head += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {len(body)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def _members(record: bytes) -> bytes:
    """A record as gzip members, one unless it is very long."""
    return b"".join(gzip.compress(record[i : i + MEMBER_BYTES], 6, mtime=0) for i in range(0, len(record), MEMBER_BYTES))


def _archives(archive_bytes: int):
    """Rows of about ``archive_bytes`` bytes of whole records each, without their last byte, which is CLOSING."""

    def run(batches):
        held, size = [], 0
        for batch in batches:
            for part in slices(batch, "html"):
                for page_id, url, html, digest, first, least, at in zip(*(part.column(i).to_pylist() for i in range(7))):
                    kind, sha = "response" if first else "revisit", base64.b32encode(bytes.fromhex(digest)).decode()
                    record = _members(_record("null" if page_id is None else page_id, url, sha, kind, least, at, html or b""))
                    if held and size + len(record) > archive_bytes:
                        yield pa.record_batch({"value": pa.array([b"".join(held)[:-1]], pa.binary())})
                        held, size = [], 0
                    held.append(record)
                    size += len(record)
        if held:
            yield pa.record_batch({"value": pa.array([b"".join(held)[:-1]], pa.binary())})

    return run


def write_archives(pages: DataFrame, least_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES) -> str:
    """Write a WARC record per page and return the archives' folder.

    pages: page_id, url, html; others are not read. Of records with equal payloads of at
    least ``least_bytes`` bytes that with the smallest page_id is a response and others
    revisit it; smaller ones are all responses. Rows that repeat that smallest page_id are
    responses too. A null page_id revisits any other record with its payload, and is a
    response among its like only; a null url has no target line; a null html is empty.
    A capture's time is page_id seconds into 2024.

    Each record is a gzip member of its own (a record over MEMBER_BYTES several), so that it can be read
    from its offset. An archive closes before it passes ``archive_bytes``. Spark's text writer makes the
    files, through the file system that the folder is on: one row is one archive, and the writer's
    line separator is the archive's last byte. That byte is the highest of a length under 16 MB, so always zero.
    """
    payload = F.coalesce(F.col("html").cast("string").cast("binary"), F.lit(b""))
    base = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("html"), F.sha1(payload).alias("digest"))
    least = base.where("page_id is not null").groupBy("digest").agg(F.min("page_id").alias("least"))
    rows = base.join(least, "digest", "left")
    first = F.col("least").isNull() | F.coalesce(F.col("page_id") == F.col("least"), F.lit(False)) | (F.octet_length("html") < least_bytes)
    records = rows.select("page_id", "url", "html", "digest", first.alias("first"), "least", (F.lit(1704067200) + F.pmod(F.coalesce("page_id", F.lit(0)), F.lit(10**9))).alias("at"))
    path = f"{shared_dir(pages.sparkSession)}/warc"
    archives = records.mapInArrow(_archives(archive_bytes), "value binary").select(F.col("value").cast("string").alias("value"))
    archives.write.option("lineSep", CLOSING).option("compression", "none").option("maxRecordsPerFile", 1).text(path)
    release(pages.sparkSession)
    return path


def gzip_members(data: bytes, step: int = 1 << 16):
    """(offset, content) of each gzip member, decompressed one at a time."""
    view, at = memoryview(data), 0
    while at < len(view):
        reader, out, to = zlib.decompressobj(31), [], at
        while not reader.eof:
            if to >= len(view):
                raise ValueError(f"the gzip member at byte {at} is cut off")
            out.append(reader.decompress(view[to : to + step]))
            to = min(to + step, len(view))
        yield at, b"".join(out)
        at = to - len(reader.unused_data)


def parse_archive(data: bytes):
    """(offset of the member it begins in, header fields, body) of each record of a compressed archive."""
    held, first = bytearray(), 0
    for at, content in gzip_members(data):
        first = first if held else at
        held += content
        while held:
            end = held.find(b"\r\n\r\n")
            if end < 0:
                break
            lines = held[:end].decode().split("\r\n")
            if not lines[0].startswith("WARC/"):
                raise ValueError(f"no WARC record in the member at byte {first}")
            fields = dict(x.split(": ", 1) for x in lines[1:])
            to = end + 4 + int(fields["Content-Length"])
            if len(held) < to + 4:
                break
            yield first, fields, bytes(held[end + 4 : to])
            del held[: to + 4]
            first = at
    if held:
        raise ValueError(f"the record at byte {first} is cut off")


CAPTURE = "page_id bigint, urlkey string, captured_at bigint, record_type string, payload_bytes bigint, payload_digest string, refers_to bigint, archive string, record_offset bigint"


def _captures(batches):
    for batch in batches:
        for path, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            rows = []
            for at, fields, body in parse_archive(content):
                page = fields["WARC-Record-ID"][10:-1]
                kind = fields["WARC-Type"]
                digest = fields["WARC-Payload-Digest"][5:]
                if kind == "response" and base32_sha1(body) != digest:
                    raise ValueError(f"payload of record {page} differs from its digest")
                when = int(datetime.datetime.fromisoformat(fields["WARC-Date"]).timestamp())
                rows.append((None if page == "null" else int(page), url_key(fields.get("WARC-Target-URI", "")), when, kind, len(body) if kind == "response" else int(fields["X-Payload-Length"]), digest, int(fields["WARC-Refers-To"][10:-1]) if kind == "revisit" else None, path, at))
            names = [x.split()[0] for x in CAPTURE.split(", ")]
            kinds = [pa.string() if x.endswith("string") else pa.int64() for x in CAPTURE.split(", ")]
            yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [()] * len(names), kinds)], names=names)


def read_archives(spark, path: str) -> DataFrame:
    """One row per record, in CAPTURE's columns; record_offset: of the gzip member that it begins in. An archive is one value of bounded size, and its records are decompressed one by one."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content").mapInArrow(_captures, CAPTURE)


# ---------------------------------------------------------------- index merge


class LoserTree:
    """k-way merge of sorted sequences: each inner node keeps the loser of its match, so that a step replays one path."""

    def __init__(self, runs: list):
        self.runs = [iter(r) for r in runs]
        self.k = max(1, len(runs))
        self.head = [next(r, None) for r in self.runs] or [None]
        self.tree = [-1] * self.k
        for i in range(self.k):
            self._enter(i)

    def _before(self, a: int, b: int) -> bool:
        x, y = self.head[a], self.head[b]
        return x is not None and (y is None or (x, a) < (y, b))

    def _enter(self, winner: int) -> None:
        """At the start a run waits at the first empty node on its path; later, the path is replayed."""
        node = (winner + self.k) >> 1
        while node:
            other = self.tree[node]
            if other < 0:
                self.tree[node] = winner
                return
            if self._before(other, winner):
                self.tree[node], winner = winner, other
            node >>= 1
        self.tree[0] = winner

    def __iter__(self):
        while True:
            winner = self.tree[0]
            if winner < 0 or self.head[winner] is None:
                return
            yield winner, self.head[winner]
            self.head[winner] = next(self.runs[winner], None)
            self._enter(winner)


def _sorted_runs(splitters: list):
    """A task's captures as sorted runs, one for each merging task: key columns as Arrow arrays in one row."""
    import bisect

    def run(batches):
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        for number, batch in enumerate(batches):
            names = batch.schema.names
            keys = list(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), [-1 if p is None else p for p in batch.column(0).to_pylist()]))
            order = sorted(range(len(keys)), key=keys.__getitem__)
            cuts = [0, *(bisect.bisect_right(order, s, key=keys.__getitem__) for s in splitters), len(order)]
            parts = [i for i in range(len(cuts) - 1) if cuts[i] < cuts[i + 1]]
            taken = [batch.take(pa.array(order[cuts[i] : cuts[i + 1]], pa.int64())) for i in parts]
            out = {"part": pa.array(parts, pa.int32()), "run": pa.array([(task << 32) + number] * len(parts), pa.int64())}
            for c in names:
                kind = batch.schema.field(c).type
                out[c] = pa.array([t.column(names.index(c)).to_pylist() for t in taken], pa.list_(kind))
            yield pa.record_batch(out)

    return run


def _merged(key: tuple, t: pa.Table) -> pa.Table:
    t = t.sort_by("run").combine_chunks()
    names = [x.split()[0] for x in CAPTURE.split(", ")]
    columns = {c: t[c].to_pylist() for c in names}
    runs = [list(zip(columns["urlkey"][i], columns["captured_at"][i], [-1 if p is None else p for p in columns["page_id"][i]], range(len(columns["urlkey"][i])))) for i in range(t.num_rows)]
    begin = np.concatenate(([0], np.cumsum([len(r) for r in runs])))
    flat = pa.table({c: pa.array([x for run in columns[c] for x in run], pa.string() if f.endswith("string") else pa.int64()) for c, f in zip(names, CAPTURE.split(", "))})
    order = [int(begin[w]) + row[3] for w, row in LoserTree(runs)]
    out = flat.take(pa.array(order, pa.int64()))
    return out.append_column("part", pa.array([key[0].as_py()] * len(order), pa.int32())).append_column("place", pa.array(range(len(order)), pa.int64()))


def merge_index(captures: DataFrame, n_captures: int, sample_rows: int = 20_000) -> DataFrame:
    """Captures in the global order of (urlkey, captured_at, page_id): ``part``, and ``place`` in it.

    Splitters come from a bounded sample (``sample_rows`` at most); they balance the merging
    tasks and don't change the order. They are whole keys, so a URL with many captures
    spreads over several tasks. Each task's captures leave as one sorted run for each
    merging task, and a loser tree merges these. A null page_id comes first among its like.
    """
    parts = parts_for(n_captures, RUN_ROWS)
    splitters: list = []
    if parts > 1:
        share = min(1.0, sample_rows / 2 / n_captures)
        sample = sorted((r[0], r[1], r[2]) for r in captures.where(F.pmod(F.xxhash64("page_id", "archive", "record_offset"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1).select("urlkey", "captured_at", F.coalesce("page_id", F.lit(-1))).limit(sample_rows).collect())
        splitters = [sample[len(sample) * i // parts] for i in range(1, parts)] if sample else []
    lists = ", ".join(f"{x.split()[0]} array<{x.split()[1]}>" for x in CAPTURE.split(", "))
    runs = captures.mapInArrow(_sorted_runs(splitters), f"part int, run bigint, {lists}")
    return runs.groupBy("part").applyInArrow(_merged, f"{CAPTURE}, part int, place bigint")


def capture_index(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Write pages to archives, read them back, and merge their index; see write_archives and merge_index."""
    path = write_archives(pages, least_bytes)
    captures = saved(read_archives(pages.sparkSession, path), "captures")
    return merge_index(captures, captures.count())


def op1_warc(spark, sf_dir: str) -> DataFrame:
    """Contract query: all of pages, payloads of any size; captures carry their place in the global order."""
    index = capture_index(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return index.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "urlkey", "captured_at", F.col("part").alias("index_part"), F.col("place").alias("index_place"))
