"""WARC archives of pages, with a two-level capture index.

Writing: pages with equal payloads meet the least page id of their payload; that page is written as a response, the others as
revisits that refer to it (payloads under ``least_bytes`` are always responses; rows that share the least id are all responses). Every task
appends gzip members, one per record, to archive files of its own in the shared folder and lists what it wrote.

Index: the captures are sorted by url key (host labels from last to first, then the path) over ranges, and each range becomes one
shard: a file of compressed blocks of sorted lines and a file with the block directory, one entry per block. Only the first key of each
shard is known to the driver, at most ``SHARDS`` of them. A lookup finds its shard, then its block in the directory, then its line in the
block, each by binary search, and reads the record by its byte range. Lookups come sorted, so a block is read once.

Files are named by task attempt and are referred to only by rows of attempts that were committed, so a lost executor leaves unused files at
most. Archives are reached through the file system of the shared folder's address.

Null payload counts as empty, a null url has the empty key. Null page ids are kept, order after all others and cannot be referred to
while another page has the payload. Repeated rows are captured and read back as often as they occur.
"""

from __future__ import annotations

import base64
import bisect
import gzip
import hashlib
import json
import re
import zlib

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm.common import arrow_schema, batch_of, stored
from tickloom.session import scratch

#: Archive files are closed at this size.
ARCHIVE_BYTES = 256 << 20
#: Lines of an index block, and most index shards.
BLOCK_LINES, SHARDS = 1_000, 1_024
LEVEL = 4
CAPTURED = "url_key string, page_id bigint, archive string, offset bigint, length bigint"
SHARD = "first_key string, first_id bigint, blocks string, directory string, n_lines bigint"
RECORD = "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, payload binary"
NO_ID = 2**63 - 1
URN = "urn:x-page:"


def _file_system(address: str):
    if re.match(r"s3[an]:", address):
        address = "s3" + address[3:]
    return fs.FileSystem.from_uri(address)


def url_key(url: str | None) -> str:
    """``http://www.example.com/a?b`` as ``com,example,www)/a?b``."""
    head, mark, rest = (url or "").partition("://")
    if not mark:
        rest = head
    host = re.match(r"[^/?#]*", rest)[0]
    return ",".join(reversed(host.lower().split("."))) + ")" + rest[len(host) :]


def _name(page_id: int | None) -> str:
    return f"<{URN}{'none' if page_id is None else page_id}>"


def _number(name: str) -> int | None:
    text = name.strip("<>").removeprefix(URN)
    return None if text == "none" else int(text)


def make_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One record as a gzip member. A revisit keeps the payload's HTTP header and drops the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {_name(page_id)}",
        f"WARC-Target-URI: {json.dumps(url)}",
        "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"Content-Length: {len(block)}",
    ]
    if revisit:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {_name(refers_to)}"]
    return gzip.compress("\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n", LEVEL, mtime=0)


def read_record(member: bytes) -> tuple:
    """Fields of ``RECORD``; a response's payload is checked against its digest."""
    raw = gzip.decompress(member)
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"\r\nContent-Length: (\d+)", http)[1])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    revisit = fields["WARC-Type"] == "revisit"
    if not revisit and (len(payload) != size or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest):
        raise ValueError(f"{fields['WARC-Record-ID']}: the payload does not match its record")
    return (
        _number(fields["WARC-Record-ID"]),
        json.loads(fields["WARC-Target-URI"]),
        size,
        digest,
        fields["WARC-Type"],
        _number(fields["WARC-Refers-To"]) if revisit else None,
        None if revisit else payload,
    )


def with_first_capture(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """(page_id, url, payload, first_id): the least page id among equal payloads."""
    known = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("payload")).withColumn("_key", F.sha2("payload", 256))
    first = known.groupBy("_key").agg(F.min("page_id").alias("first_id"))
    met = known.join(first, "_key")
    large = F.octet_length("payload") >= least_bytes
    return met.select("page_id", "url", "payload", F.when(large, F.col("first_id")).otherwise(F.col("page_id")).alias("first_id"))


def write_archives(pages: DataFrame, folder: str, least_bytes: int = 0) -> DataFrame:
    """Write ``pages`` (page_id, url, html) as archives in ``folder``; the rows of ``CAPTURED``, as a stored table."""
    kind = arrow_schema(CAPTURED)

    def run(batches):
        context, n, out, at, name = TaskContext.get(), 0, None, 0, ""
        system, root = _file_system(folder)
        try:
            for b in batches:
                rows = []
                for page_id, url, payload, first in zip(*(c.to_pylist() for c in b.columns), strict=True):
                    revisit = first is not None and page_id != first
                    member = make_record(page_id, url, payload.encode(), first if revisit else None, revisit)
                    if out is None or at + len(member) > ARCHIVE_BYTES:
                        if out is not None:
                            out.close()
                        name = f"pages-{context.partitionId():06d}-{context.taskAttemptId()}-{n:04d}.warc.gz"
                        system.create_dir(root, recursive=True)
                        out, at, n = system.open_output_stream(f"{root}/{name}", compression=None), 0, n + 1
                    out.write(member)
                    rows.append((url_key(url), page_id, name, at, len(member)))
                    at += len(member)
                if rows:
                    yield batch_of(rows, kind)
        finally:
            if out is not None:
                out.close()

    return stored(with_first_capture(pages, least_bytes).mapInArrow(run, CAPTURED), "captures")[0]


class Index:
    """The shards of a capture index; small enough to go with every task."""

    def __init__(self, folder: str, shards: list[tuple]):
        self.folder = folder
        self.shards = sorted(shards)
        self.firsts = [(k, i) for k, i, *_ in self.shards]

    @staticmethod
    def build(captures: DataFrame, folder: str, shards: int | None = None, block_lines: int = BLOCK_LINES) -> Index:
        spark = captures.sparkSession
        shards = min(SHARDS, shards or int(spark.conf.get("spark.sql.shuffle.partitions")))
        kind = arrow_schema(SHARD)

        def run(batches):
            context = TaskContext.get()
            system, root = _file_system(folder)
            stem = f"index-{context.partitionId():06d}-{context.taskAttemptId()}"
            first, lines, directory, at, total, out = None, [], [], 0, 0, None

            def close_block():
                nonlocal at, lines
                data = zlib.compress("\n".join(json.dumps(x) for x in lines).encode(), LEVEL)
                out.write(data)
                directory.append([*lines[0][:2], at, len(data)])
                at, lines = at + len(data), []

            for b in batches:
                for line in zip(*(c.to_pylist() for c in b.columns), strict=True):
                    if first is None:
                        first = line[:2]
                        system.create_dir(root, recursive=True)
                        out = system.open_output_stream(f"{root}/{stem}.blocks", compression=None)
                    # lines of one key and id stay in one block, so that one block answers a lookup
                    if len(lines) >= block_lines and line[:2] != lines[-1][:2]:
                        close_block()
                    lines.append(line)
                    total += 1
            if first is not None:
                close_block()
                out.close()
                with system.open_output_stream(f"{root}/{stem}.directory", compression=None) as f:
                    f.write(zlib.compress(json.dumps(directory).encode(), LEVEL))
                yield batch_of([(*first, f"{stem}.blocks", f"{stem}.directory", total)], kind)

        ordered = captures.withColumn("page_id", F.coalesce("page_id", F.lit(NO_ID)))
        sorted_ = ordered.repartitionByRange(shards, "url_key", "page_id").sortWithinPartitions("url_key", "page_id", "archive", "offset")
        made, _ = stored(sorted_.mapInArrow(run, SHARD), "index")
        return Index(folder, [tuple(r) for r in made.collect()])


class _Reader:
    """Lookups of one task: the last shard's directory and the last block are kept, archives stay open."""

    def __init__(self, index: Index):
        self.index = index
        self.system, self.root = _file_system(index.folder)
        self.shard = self.block = None
        self.open: dict[str, object] = {}

    def _range(self, name: str, at: int, size: int) -> bytes:
        if name not in self.open:
            if len(self.open) >= 64:
                self.open.pop(next(iter(self.open))).close()
            self.open[name] = self.system.open_input_file(f"{self.root}/{name}")
        return self.open[name].read_at(size, at)

    def captures(self, key: str, page_id: int):
        """(archive, offset, length) of every capture of a page."""
        want = (key, page_id)
        s = bisect.bisect_right(self.index.firsts, want) - 1
        if s < 0:
            return
        _, _, blocks, directory, _ = self.index.shards[s]
        if self.shard != s:
            with self.system.open_input_stream(f"{self.root}/{directory}", compression=None) as f:
                self.entries = json.loads(zlib.decompress(f.read()))
            self.starts = [(e[0], e[1]) for e in self.entries]
            self.shard, self.block = s, None
        i = bisect.bisect_right(self.starts, want) - 1
        if self.block != i:
            _, _, at, size = self.entries[i]
            text = zlib.decompress(self._range(blocks, at, size)).decode()
            self.lines = [json.loads(x) for x in text.split("\n")]
            self.keys = [(x[0], x[1]) for x in self.lines]
            self.block = i
        for j in range(bisect.bisect_left(self.keys, want), len(self.keys)):
            if self.keys[j] != want:
                break
            yield self.lines[j][2:]

    def record(self, archive: str, at: int, size: int) -> bytes:
        return self._range(archive, at, size)


def look_up(wanted: DataFrame, index: Index, payloads: bool = True) -> DataFrame:
    """The records of ``wanted`` (page_id, url), each pair once, read by range; columns of ``RECORD``."""
    kind = arrow_schema(RECORD)

    def keys(batches):
        for b in batches:
            ids = [NO_ID if i is None else i for i in b["page_id"].to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([url_key(u) for u in b["url"].to_pylist()], pa.string()), pa.array(ids, pa.int64())], names=["url_key", "page_id"])

    def run(batches):
        reader = _Reader(index)
        for b in batches:
            rows, held = [], 0
            for key, page_id in zip(*(c.to_pylist() for c in b.columns), strict=True):
                for archive, at, size in reader.captures(key, page_id):
                    row = read_record(reader.record(archive, at, size))
                    rows.append(row if payloads else (*row[:-1], None))
                    held += len(row[-1] or b"") if payloads else 100
                    if held > 16 << 20:
                        yield batch_of(rows, kind)
                        rows, held = [], 0
            if rows:
                yield batch_of(rows, kind)

    keyed = wanted.select("page_id", "url").mapInArrow(keys, "url_key string, page_id bigint").distinct()
    # a number of its own: lookups are short rows that stand for long records, so their size says nothing about the work
    parts = int(wanted.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return keyed.repartitionByRange(parts, "url_key", "page_id").sortWithinPartitions("url_key", "page_id").mapInArrow(run, RECORD)


def round_trip(spark: SparkSession, pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Write ``pages`` to archives in the shared folder, index them, and read every page back through the index."""
    folder = scratch(spark, "warc")
    if not re.match(r"[a-zA-Z][a-zA-Z0-9+.-]*:|/", folder):
        raise ValueError("the shared folder needs an absolute address")
    captures = write_archives(pages, folder, least_bytes)
    index = Index.build(captures, folder)
    return look_up(pages, index, payloads=False).drop("payload", "url")
