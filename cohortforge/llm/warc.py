"""WARC archives of pages with a two-level capture index.

Pages go to gzip-per-record WARC files. Captures are sorted by reversed-host URL key and written in
compressed blocks; each index file ends with a sparse directory of its blocks, and a manifest has
the key range of each index file. A lookup binary-searches manifest, directory and block, and reads
ranges of bytes only.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator
from functools import partial
from urllib.parse import urlsplit

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortforge.llm.shared import new_path, staged

LEAST = 1000  # bytes from which equal payloads are stored once
DATE = "2024-01-01T00:00:00Z"
FILE_BYTES = 256 << 20  # size from which a partition goes on in a new archive
BLOCK = 1000  # captures a block
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def surt(url: str | None) -> str:
    """Reversed host, then the rest: http://www.Example.com/a?b#c gives com,example,www)/a?b."""
    try:
        parts = urlsplit((url or "").strip())
        host, port = parts.hostname or "", parts.port
    except ValueError:  # not a URL: it is its own key
        return url or ""
    if not host:
        return url or ""
    host = ",".join(reversed(host.rstrip(".").split(".")))
    port = "" if port in (None, 80, 443) else f":{port}"
    return f"{host}{port}){parts.path or '/'}" + (f"?{parts.query}" if parts.query else "")


def compressed(data: bytes, level: int = 1) -> bytes:
    """One gzip member."""
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def one_line(value: str) -> str:
    """A header value: line breaks and percent signs as percent escapes."""
    return value.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A") if "\n" in value or "\r" in value else value


def record(page: int | None, url: str | None, payload: bytes, sha1: bytes, refers_to: int | None) -> bytes:
    """A response record with the payload, or a revisit record that refers to another page's."""
    block = HTTP + payload if refers_to is None else HTTP
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{'' if page is None else page}>",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {one_line(url or '')}",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(sha1).decode()}",
        f"WARC-Payload-Length: {len(payload)}",
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if refers_to is not None:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    return "\r\n".join(lines).encode("utf-8", "replace") + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and payload of a compressed record; a payload that fails its digest is an error."""
    raw = zlib.decompress(data, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = dict(line.split(": ", 1) for line in lines)
    block = rest[: int(headers["Content-Length"])]
    payload = block.partition(b"\r\n\r\n")[2]
    if headers["WARC-Type"] == "response":
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        if headers["WARC-Payload-Digest"] != f"sha1:{digest}":
            raise ValueError(f"damaged record {headers['WARC-Record-ID']}")
    return headers, payload


def page_of(urn: str) -> int | None:
    """The page of a record id."""
    number = urn[len("<urn:page:") : -1]
    return int(number) if number else None


CAPTURES = "key string, page_id long, path string, at long, size long"


def _write(batches: Iterable[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    """Archives of a partition's pages; an attempt's files are its own, and a lost one's unnamed."""
    system, root = fs.FileSystem.from_uri(folder)
    system.create_dir(root, recursive=True)
    part, out, at, name = TaskContext.get().partitionId(), None, 0, ""
    for batch in batches:
        rows = []
        for page, url, html, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
            if out is None:
                name = f"{part:06d}-{uuid.uuid4().hex}.warc.gz"
                out, at = system.open_output_stream(f"{root}/{name}", compression=None), 0
            payload = (html or "").encode()
            data = compressed(record(page, url, payload, hashlib.sha1(payload).digest(), refers_to))
            out.write(data)
            rows.append((surt(url), page, f"{folder}/{name}", at, len(data)))
            at += len(data)
            if at >= FILE_BYTES:
                out.close()
                out = None
        columns = list(zip(*rows)) or [()] * 5
        kinds = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], ["key", "page_id", "path", "at", "size"]
        )
    if out is not None:
        out.close()


def write(pages: DataFrame, folder: str | None = None, least: int = LEAST) -> DataFrame:
    """Archive all pages in `folder`; returns the captures: key, page_id, path, at, size.

    Of pages with equal payloads of at least `least` bytes the one of the largest page_id is a
    response and the others refer to it; all other pages are responses. A null html is an empty
    payload and a null url an empty one. Rows without page_id are archived, and rows that repeat
    as often as they come; an empty table gives no captures.
    """
    folder = folder or new_path(pages.sparkSession, "warc")
    html = F.coalesce("html", F.lit(""))
    rows = pages.select("page_id", "url", "html", F.sha1(html.cast("binary")).alias("digest"), F.octet_length(html).alias("n"))
    same = rows.where(F.col("n") >= least).groupBy("digest", "n").agg(
        F.max("page_id").alias("last"), F.count("*").alias("rows")
    )
    # a page alone with its payload needs no look at the others
    shared = same.where("rows > 1").drop("rows")
    refers_to = F.when(F.coalesce(F.col("page_id") != F.col("last"), F.col("last").isNotNull()), F.col("last"))
    typed = rows.join(shared, ["digest", "n"], "left").select("page_id", "url", "html", refers_to.alias("refers_to"))
    return staged(typed.mapInArrow(partial(_write, folder=folder), CAPTURES), "captures")


INDEX = "path string, first string, last string, captures long"


def _index(batches: Iterable[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    """The index file of a partition's sorted captures, and its manifest row."""
    system, root = fs.FileSystem.from_uri(folder)
    system.create_dir(root, recursive=True)
    name = f"{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.index"
    directory: list[list] = []
    pending: list[list] = []
    total, at, last, out = 0, 0, "", None

    def close_block() -> None:
        nonlocal at
        data = compressed("\n".join(json.dumps(line) for line in pending).encode(), 6)
        directory.append([pending[0][0], at, len(data)])
        out.write(data)
        at += len(data)
        pending.clear()

    for batch in batches:
        for line in zip(*(c.to_pylist() for c in batch.columns)):
            out = out or system.open_output_stream(f"{root}/{name}", compression=None)
            pending.append(list(line))
            last, total = line[0], total + 1
            if len(pending) >= BLOCK:
                close_block()
    if out is None:
        return
    if pending:
        close_block()
    footer = compressed(json.dumps(directory).encode(), 6)
    out.write(footer + len(footer).to_bytes(8, "little"))
    out.close()
    row = [[f"{folder}/{name}"], [directory[0][0]], [last], [total]]
    kinds = [pa.string(), pa.string(), pa.string(), pa.int64()]
    yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row, kinds)], ["path", "first", "last", "captures"])


def index(captures: DataFrame, folder: str | None = None) -> DataFrame:
    """Index files over all captures in key order; returns the manifest: path, first, last, captures."""
    folder = folder or new_path(captures.sparkSession, "index")
    ordered = captures.repartitionByRange("key", "page_id").sortWithinPartitions("key", "page_id")
    return staged(ordered.mapInArrow(partial(_index, folder=folder), INDEX), "manifest")


class Files:
    """Range reads from files that stay open."""

    def __init__(self, most: int = 64):
        self.open: dict[str, pa.NativeFile] = {}
        self.most = most

    def file(self, path: str) -> pa.NativeFile:
        if path not in self.open:
            if len(self.open) >= self.most:
                self.open.pop(next(iter(self.open))).close()
            system, name = fs.FileSystem.from_uri(path)
            self.open[path] = system.open_input_file(name)
        return self.open[path]

    def read(self, path: str, at: int, size: int) -> bytes:
        return self.file(path).read_at(size, at)

    def directory(self, path: str) -> list[list]:
        """[first key, offset, size] of each block of an index file."""
        end = self.file(path).size()
        size = int.from_bytes(self.read(path, end - 8, 8), "little")
        return json.loads(zlib.decompress(self.read(path, end - 8 - size, size), 31))

    def block(self, path: str, at: int, size: int) -> list[list]:
        """The captures of a block."""
        return [json.loads(line) for line in zlib.decompress(self.read(path, at, size), 31).split(b"\n")]


def lookup(manifest: DataFrame, url: str) -> list[tuple[dict[str, str], bytes]]:
    """All records of a URL, by three binary searches and range reads.

    The manifest has a row for each index file, so as many as the index was written with tasks.
    """
    key, files, out = surt(url), Files(), []
    ranges = sorted((r["first"], r["last"], r["path"]) for r in manifest.collect())
    for first, last, path in ranges[: bisect_right(ranges, key, key=lambda r: r[0])]:
        if last < key:
            continue
        directory = files.directory(path)
        firsts = [entry[0] for entry in directory]
        # the key may begin in the block before the first one that starts with it
        for _, at, size in directory[max(0, bisect_left(firsts, key) - 1) : bisect_right(firsts, key)]:
            lines = files.block(path, at, size)
            keys = [line[0] for line in lines]
            for line in lines[bisect_left(keys, key) : bisect_right(keys, key)]:
                out.append(parse(files.read(*line[2:])))
    return out


RECORDS = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"


def _read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    files = Files()
    for batch in batches:
        for path in batch.column(0).to_pylist():
            for _, at, size in files.directory(path):
                rows = []
                for _, _, warc, start, length in files.block(path, at, size):
                    headers, payload = parse(files.read(warc, start, length))
                    kind, refers_to = headers["WARC-Type"], headers.get("WARC-Refers-To")
                    digest = base64.b32decode(headers["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
                    full = len(payload) if kind == "response" else int(headers["WARC-Payload-Length"])
                    target = page_of(refers_to) if refers_to else None
                    url = headers["WARC-Target-URI"]
                    rows.append((page_of(headers["WARC-Record-ID"]), url, full, digest, kind, target))
                kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()]
                names = [field.split()[0] for field in RECORDS.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


def read(manifest: DataFrame) -> DataFrame:
    """Every record that the index names: page_id, url, payload size and digest, type, refers_to."""
    tasks = 4 * manifest.sparkSession.sparkContext.defaultParallelism
    return manifest.select("path").repartition(tasks, "path").mapInArrow(_read, RECORDS)


def write_and_read(pages: DataFrame) -> DataFrame:
    """Archive, index and read back all pages."""
    records = read(index(write(pages.select("page_id", "url", "html"))))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
