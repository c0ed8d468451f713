"""WARC in ZIP packages: writing archives, and reading them back by range without extraction.

A package stores (uncompressed) ``archive/data.warc.gz``, one gzip member per record, and
``indexes/index.cdxj``, one line per record with its offset and length. The reader parses
the end record, the ZIP64 end record where there is one, and the central directory; finds
the stored index; and reads each record's range of the stored archive.

Every task writes packages of its own under unique names; only the list of packages that
successful tasks return (kept as a table in the shared folder) is read, so a lost executor
leaves at worst files that nothing refers to. Files are opened through the file system that
their URI names.

Records with equal payloads of at least ``least`` bytes: the one of the smallest page_id is
the response, others revisit it. First pages of repeated payloads are counted; up to
``BROADCAST_ROWS`` of them are broadcast (some 100 bytes each), beyond that the pages are
joined by digest under Spark's skew handling.

Defined cases: a null html is an empty payload; null urls are empty; rows of the same
page_id and payload have the same type; a page without an id is a response unless an equal
payload has one, which it then revisits.
"""

from __future__ import annotations

import gzip
import hashlib
import json
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import saved
from shelfline.session import new_dir

LEAST = 100
BROADCAST_ROWS = 200_000
#: Bytes of compressed records in one package before the next begins.
PACKAGE_BYTES = 256 << 20

DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
PACKAGES = "path string, records bigint"
RECORDS = "page_id bigint, url string, record_type string, payload binary, payload_bytes bigint, payload_digest string, refers_to bigint"
LOCATIONS = "path string, at bigint, length bigint"


def with_types(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """``page_id``, ``url``, ``payload``, ``digest`` and ``refers_to`` of every page."""
    payload = F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8")
    marked = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"),
        F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"),
        payload.alias("payload"),
        F.sha2(payload, 256).alias("digest"),
    )
    long = F.octet_length("payload") >= least
    first = saved(
        marked.where(long)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
        .where("n > 1")
        .drop("n"),
        "warc_first",
    )
    if first.count() <= BROADCAST_ROWS:
        first = F.broadcast(first)
    joined = marked.join(first, "digest", "left")
    # Digests of shorter payloads are not in ``first``.
    revisits = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return joined.withColumn("refers_to", F.when(revisits, F.col("first"))).drop("first")


def _record(page_id, url: str, payload: bytes, digest: str, refers_to) -> bytes:
    """One WARC record: a response with its payload, or a revisit with the headers alone."""
    kind = "response" if refers_to is None else "revisit"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (payload if refers_to is None else b"")
    lines = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Target-URI: {quote(url, safe=':/?#[]@!$&()*+,;=%~')}",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha256:{digest}",
    ]
    if refers_to is not None:
        lines += [
            f"WARC-Refers-To: <urn:page:{refers_to}>",
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
        ]
    lines += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return gzip.compress("\r\n".join(lines).encode() + block + b"\r\n\r\n", compresslevel=4, mtime=0)


class Package:
    """Writes one package to an output stream that need not be seekable."""

    def __init__(self, stream):
        self.stream = stream
        self.zip = zipfile.ZipFile(stream, "w", zipfile.ZIP_STORED, allowZip64=True)
        self.data = self.zip.open(DATA, "w", force_zip64=True)
        self.lines: list[str] = []
        self.at = 0

    def add(self, url: str, record: bytes) -> None:
        self.lines.append(json.dumps({"url": url, "offset": self.at, "length": len(record)}) + "\n")
        self.data.write(record)
        self.at += len(record)

    def close(self) -> None:
        self.data.close()
        self.zip.writestr(INDEX, "".join(self.lines))
        self.zip.close()
        self.stream.close()


def write(typed: DataFrame, folder: str, limit: int = PACKAGE_BYTES) -> DataFrame:
    """Write packages below ``folder``; returns the table of those that count."""
    rows = typed.select("page_id", "url", "payload", "digest", "refers_to")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        package, name, done = None, "", []

        def close() -> None:
            package.close()
            done.append((name, len(package.lines)))

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if package is None or package.at >= limit:
                    if package is not None:
                        close()
                    name = f"{root}/{uuid.uuid4().hex}.wacz"
                    package = Package(store.open_output_stream(name))
                package.add(row[1], _record(*row))
        if package is not None:
            close()
        prefix = folder.removesuffix(root) if folder.endswith(root) else ""
        yield pa.RecordBatch.from_arrays(
            [pa.array([prefix + n for n, _ in done], pa.string()), pa.array([k for _, k in done], pa.int64())],
            names=["path", "records"],
        )

    return saved(rows.mapInArrow(run, PACKAGES), "warc_packages")


def _extra64(extra: bytes, wanted: list[int]) -> list[int]:
    """Replace fields that are all ones by those of the ZIP64 extra field, in order."""
    sizes = {0: 0xFFFFFFFF, 1: 0xFFFFFFFF, 2: 0xFFFFFFFF}
    at = 0
    while at + 4 <= len(extra):
        tag, size = struct.unpack_from("<HH", extra, at)
        if tag == 1:
            values = list(struct.unpack_from(f"<{size // 8}Q", extra, at + 4))
            return [values.pop(0) if v == sizes[k] and values else v for k, v in enumerate(wanted)]
        at += 4 + size
    return wanted


def members(file) -> dict[str, tuple[int, int, int]]:
    """Name -> (offset of the data, size, method) of every member, from the directories."""
    size = file.size()
    tail_at = max(0, size - 65_557 - 20)
    file.seek(tail_at)
    tail = file.read(size - tail_at)
    end = tail.rfind(b"PK\x05\x06")
    if end < 0:
        raise ValueError("no end of central directory")
    count, length, start = struct.unpack_from("<HII", tail, end + 10)
    locator = end - 20
    if locator >= 0 and tail[locator : locator + 4] == b"PK\x06\x07":
        (at64,) = struct.unpack_from("<Q", tail, locator + 8)
        file.seek(at64)
        record = file.read(56)
        if record[:4] != b"PK\x06\x06":
            raise ValueError("no ZIP64 end of central directory")
        count, length, start = struct.unpack_from("<QQQ", record, 32)
    file.seek(start)
    directory, at, found = file.read(length), 0, {}
    for _ in range(count):
        if directory[at : at + 4] != b"PK\x01\x02":
            raise ValueError("broken central directory")
        method = struct.unpack_from("<H", directory, at + 10)[0]
        packed, plain, n, m, k = struct.unpack_from("<IIHHH", directory, at + 20)
        (offset,) = struct.unpack_from("<I", directory, at + 42)
        name = directory[at + 46 : at + 46 + n].decode()
        plain, packed, offset = _extra64(directory[at + 46 + n : at + 46 + n + m], [plain, packed, offset])
        file.seek(offset)
        local = file.read(30)
        n2, m2 = struct.unpack_from("<HH", local, 26)
        found[name] = (offset + 30 + n2 + m2, packed, method)
        at += 46 + n + m + k
    return found


def locations(packages: DataFrame) -> DataFrame:
    """Absolute range of every indexed record."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                store, name = fs.FileSystem.from_uri(path)
                with store.open_input_file(name) as file:
                    inside = members(file)
                    (data, _, packed), (index, size, method) = inside[DATA], inside[INDEX]
                    if packed or method:
                        raise ValueError(f"{path}: members are not stored")
                    file.seek(index)
                    lines = [json.loads(x) for x in file.read(size).decode().splitlines()]
                for k in range(0, len(lines), 10_000):
                    part = lines[k : k + 10_000]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([path] * len(part), pa.string()),
                            pa.array([data + x["offset"] for x in part], pa.int64()),
                            pa.array([x["length"] for x in part], pa.int64()),
                        ],
                        names=["path", "at", "length"],
                    )

    return packages.select("path").mapInArrow(run, LOCATIONS)


def _parsed(raw: bytes) -> tuple:
    text = zlib.decompress(raw, wbits=31)
    head, block = text.split(b"\r\n\r\n", 1)
    fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    block = block[: int(fields["Content-Length"])]
    http, payload = block.split(b"\r\n\r\n", 1)
    told = dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:])
    number = lambda urn: int(x) if (x := urn[1:-1].removeprefix("urn:page:")) else None
    page, kind = number(fields["WARC-Record-ID"]), fields["WARC-Type"]
    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    refers = number(fields["WARC-Refers-To"]) if kind == "revisit" else None
    if kind == "response" and hashlib.sha256(payload).hexdigest() != digest:
        raise ValueError(f"page {page}: the payload has another digest")
    body = payload if kind == "response" else None
    return page, fields["WARC-Target-URI"], kind, body, int(told["Content-Length"]), digest, refers


def read(packages: DataFrame, payloads: bool = True) -> DataFrame:
    """Every record of the packages, each by a read of its own range."""
    kinds = [pa.int64(), pa.string(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.int64()]
    names = ["page_id", "url", "record_type", "payload", "payload_bytes", "payload_digest", "refers_to"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, opened = None, None
        for batch in batches:
            rows, held = [], 0
            for path, at, length in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if path != opened:
                    if file is not None:
                        file.close()
                    store, name = fs.FileSystem.from_uri(path)
                    file, opened = store.open_input_file(name), path
                file.seek(at)
                row = _parsed(file.read(length))
                rows.append(row if payloads else (*row[:3], None, *row[4:]))
                held += len(row[3] or b"") if payloads else 0
                if held > 16 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)
                    rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)
        if file is not None:
            file.close()

    return locations(packages).mapInArrow(run, RECORDS)


def report(pages: DataFrame) -> DataFrame:
    """Write every page, read every record back."""
    packages = write(with_types(pages), new_dir(pages.sparkSession, "warc"))
    return read(packages, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )
