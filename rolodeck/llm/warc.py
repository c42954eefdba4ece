"""WARC records in ZIP packages: a writer, and a reader that never extracts.

A package is a ZIP file of *stored* members: ``archive/data.warc.gz`` (records, each a gzip member of its own), ``indexes/index.cdxj``
(one line for each record: offset and length inside the archive) and ``datapackage.json``. The reader finds the end-of-directory record,
follows its ZIP64 form where there is one, walks the central directory, locates the stored members and reads the index; records are then read
as byte ranges. Ranges, not packages, are the unit of work, so a package of any size is read by many tasks.

Writing survives lost executors: each attempt of a task writes packages under new names and returns their paths; only paths that the
successful attempt returned are in the manifest, which is kept by a reliable checkpoint.
"""

from __future__ import annotations

import gzip
import hashlib
import json
import re
import struct
import uuid
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .util import binary, checkpointed, filesystem, join_hot, new_folder, spread, text_slices

ARCHIVE, INDEX, PACKAGE = "archive/data.warc.gz", "indexes/index.cdxj", "datapackage.json"
#: Revisits of so few repeated payloads are looked up by a broadcast (32 bytes of digest and an id each, under 16 MB); others by a join.
BROADCAST_ROWS = 100_000
#: Payloads of fewer bytes are never revisits.
LEAST_BYTES = 100


# --- one record


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, length: int, refers_to: int | None, revisit: bool, date: str) -> bytes:
    """A WARC record; a revisit has the HTTP header only, with the full payload's length and digest."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode()
    block = http if revisit else http + payload
    address = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "")
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Date: {date}", f"WARC-Target-URI: {address}", f"WARC-Payload-Digest: sha256:{digest}"]
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> dict:
    """Headers and payload of one record. Raises ValueError if lengths or a response's digest don't fit."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError(f"not a WARC record: {version[:40]!r}")
    fields = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines)}
    block = rest[: int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    length = int(re.search(rb"(?i)\r\ncontent-length: (\d+)", http)[1])
    number = lambda k: int(m[1]) if (m := re.search(r"urn:page:(-?\d+)>", fields.get(k, ""))) else None
    digest = fields["warc-payload-digest"].removeprefix("sha256:")
    if fields["warc-type"] == "response" and (len(payload) != length or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"payload of {fields['warc-record-id']} does not match its digest")
    return {"page_id": number("warc-record-id"), "url": fields.get("warc-target-uri"), "record_type": fields["warc-type"], "payload_digest": digest, "payload_bytes": length, "refers_to": number("warc-refers-to"), "payload": payload}


# --- one package


class PackageWriter:
    """Writes one package, record by record; only the index is held until the end."""

    def __init__(self, uri: str):
        files, path = filesystem(uri)
        self.uri, self.out = uri, files.open_output_stream(path)
        self.zip = zipfile.ZipFile(self.out, "w", zipfile.ZIP_STORED, allowZip64=True)
        self.member = self.zip.open(ARCHIVE, "w", force_zip64=True)
        self.offset, self.index = 0, []

    def add(self, name: str, raw: bytes) -> None:
        packed = gzip.compress(raw, 6, mtime=0)
        self.member.write(packed)
        self.index.append(json.dumps({"id": name, "offset": self.offset, "length": len(packed)}))
        self.offset += len(packed)

    def close(self) -> tuple[str, int]:
        self.member.close()
        self.zip.writestr(INDEX, "".join(x + "\n" for x in self.index))
        self.zip.writestr(PACKAGE, json.dumps({"profile": "data-package", "resources": [{"path": ARCHIVE, "bytes": self.offset}, {"path": INDEX}]}))
        self.zip.close()
        self.out.close()
        return self.uri, len(self.index)


def central_directory(file) -> dict[str, tuple[int, int, int]]:
    """Of each member of an open ZIP file: offset of its local header, stored size, compression method (0: stored)."""
    size = file.size()
    tail_at = max(0, size - 65_557 - 20)  # the longest comment, and a ZIP64 locator before the record
    file.seek(tail_at)
    tail = file.read(size - tail_at)
    at = tail.rfind(b"PK\5\6")
    if at < 0:
        raise ValueError("no end of central directory: not a ZIP file")
    count, length, start = struct.unpack("<HII", tail[at + 10 : at + 20])
    if at >= 20 and tail[at - 20 : at - 16] == b"PK\6\7" and (count == 0xFFFF or 0xFFFFFFFF in (length, start)):
        (where,) = struct.unpack("<Q", tail[at - 12 : at - 4])
        file.seek(where)
        end = file.read(56)
        if end[:4] != b"PK\6\6":
            raise ValueError("no ZIP64 end of central directory where its locator points")
        count, length, start = struct.unpack("<QQQ", end[32:56])
    file.seek(start)
    data, members, at = file.read(length), {}, 0
    for _ in range(count):
        if data[at : at + 4] != b"PK\1\2":
            raise ValueError("broken central directory")
        method, packed, full = struct.unpack("<H", data[at + 10 : at + 12])[0], *struct.unpack("<II", data[at + 20 : at + 28])
        n_name, n_extra, n_comment = struct.unpack("<HHH", data[at + 28 : at + 34])
        (local,) = struct.unpack("<I", data[at + 42 : at + 46])
        name, extra = data[at + 46 : at + 46 + n_name].decode(), data[at + 46 + n_name : at + 46 + n_name + n_extra]
        while len(extra) >= 4:
            kind, n = struct.unpack("<HH", extra[:4])
            if kind == 1:  # ZIP64: the 64-bit form of each field that is full of ones, in this order
                wide = list(struct.unpack(f"<{n // 8}Q", extra[4 : 4 + n // 8 * 8]))
                full = wide.pop(0) if full == 0xFFFFFFFF else full
                packed = wide.pop(0) if packed == 0xFFFFFFFF else packed
                local = wide.pop(0) if local == 0xFFFFFFFF else local
            extra = extra[4 + n :]
        members[name] = (local, packed, method)
        at += 46 + n_name + n_extra + n_comment
    return members


def stored_range(file, entry: tuple[int, int, int]) -> tuple[int, int]:
    """(offset, length) of a stored member's data in the ZIP file."""
    local, size, method = entry
    if method:
        raise ValueError("the member is compressed; only stored ones can be read by range")
    file.seek(local)
    head = file.read(30)
    if head[:4] != b"PK\3\4":
        raise ValueError("no local header where the central directory points")
    return local + 30 + sum(struct.unpack("<HH", head[26:30])), size


def record_ranges(uri: str) -> list[tuple[int, int]]:
    """(offset, length) in the package of each record, by its index."""
    files, path = filesystem(uri)
    with files.open_input_file(path) as file:
        members = central_directory(file)
        base, _ = stored_range(file, members[ARCHIVE])
        at, size = stored_range(file, members[INDEX])
        file.seek(at)
        return [(base + x["offset"], x["length"]) for x in map(json.loads, file.read(size).splitlines())]


# --- over tables


def write_packages(pages: DataFrame, folder: str | None = None, id: str = "page_id", url: str = "url", html: str = "html", package_mb: int = 256, date: str = "2026-01-01T00:00:00Z") -> DataFrame:
    """Writes a record for each row; returns the manifest: ``path`` and ``records`` of each package.

    Among rows with equal payloads of at least LEAST_BYTES bytes, those with the smallest id are responses, others revisit it. A null payload is
    empty. Rows with a null id are revisits only of an id that is not null; where all ids are null all are responses, and so are repeated rows of
    the smallest id. ids must be whole numbers. Extra columns are ignored. An empty table writes no package. Packages stay in ``folder`` (by default one inside the shared folder).
    """
    spark = pages.sparkSession
    folder = folder or new_folder(spark, "warc")
    rows = pages.select(F.col(id).cast("long").alias("id"), F.col(url).cast("string").alias("url"), F.coalesce(F.col(html).cast("string"), F.lit("")).alias("html"))
    rows = rows.withColumns({"digest": F.sha2(F.col("html").cast("binary"), 256), "length": F.octet_length("html").cast("long")})
    repeated = checkpointed(rows.filter(F.col("length") >= LEAST_BYTES).groupBy(F.col("digest").alias("digest_")).agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1 and first is not null"))
    if repeated.count() <= BROADCAST_ROWS:
        rows = rows.join(F.broadcast(repeated.drop("n")), (F.col("digest") == F.col("digest_")) & (F.col("length") >= LEAST_BYTES), "left")
    else:  # ids and digests meet first, a common payload without a shuffle; payloads move once, by id and digest, which spreads them evenly
        total = repeated.agg(F.sum("n").alias("n")).first().n
        copies = join_hot(checkpointed(rows.filter(F.col("length") >= LEAST_BYTES).select("id", "digest")), repeated, ("digest", "digest_"), "n", total)
        again = copies.filter(~F.col("id").eqNullSafe(F.col("first"))).select(F.col("id").alias("id_"), "digest_", "first").distinct()
        rows = rows.join(again, F.col("id").eqNullSafe(F.col("id_")) & (F.col("digest") == F.col("digest_")), "left")
    rows = rows.withColumn("revisit", F.coalesce(~F.col("id").eqNullSafe(F.col("first")) & F.col("first").isNotNull(), F.lit(False)))
    most = package_mb << 20

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, path = filesystem(folder)
        files.create_dir(path, recursive=True)
        writer, done = None, []
        for batch in text_slices(batches, "html"):
            columns = [batch.column(c).to_pylist() for c in ("id", "url", "digest", "length", "first", "revisit")]
            for (page, address, digest, length, first, revisit), payload in zip(zip(*columns, strict=True), binary(batch.column("html")), strict=True):
                writer = writer or PackageWriter(f"{folder}/{uuid.uuid4().hex}.wacz")
                writer.add(str(page), record(page, address, payload, digest, length, first, revisit, date))
                if writer.offset >= most:
                    done.append(writer.close())
                    writer = None
        if writer:
            done.append(writer.close())
        yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.string()), pa.array([d[1] for d in done], pa.int64())], names=["path", "records"])

    return checkpointed(rows.select("id", "url", "html", "digest", "length", "first", "revisit").mapInArrow(run, "path string, records long"))


def read_packages(manifest: DataFrame, range_mb: int = 8, payloads: bool = True) -> DataFrame:
    """The records of the packages (column ``path``): page_id, url, record_type, payload_digest, payload_bytes, refers_to and, if wanted, payload."""
    most = range_mb << 20

    def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                starts, sizes, held = [[]], [[]], 0
                for at, n in record_ranges(path):
                    if held and held + n > most:
                        starts.append([])
                        sizes.append([])
                        held = 0
                    starts[-1].append(at)
                    sizes[-1].append(n)
                    held += n
                yield pa.RecordBatch.from_arrays([pa.array([path] * len(starts)), pa.array(starts, pa.list_(pa.int64())), pa.array(sizes, pa.list_(pa.int64()))], names=["path", "starts", "sizes"])

    kinds = {"page_id": pa.int64(), "url": pa.string(), "record_type": pa.string(), "payload_digest": pa.string(), "payload_bytes": pa.int64(), "refers_to": pa.int64()} | ({"payload": pa.binary()} if payloads else {})

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, starts, sizes in zip(*(batch.column(c).to_pylist() for c in ("path", "starts", "sizes")), strict=True):
                if not starts:
                    continue
                files, inner = filesystem(path)
                with files.open_input_file(inner) as file:
                    file.seek(starts[0])
                    data = file.read(starts[-1] + sizes[-1] - starts[0])
                found = [parse_record(gzip.decompress(data[a - starts[0] : a - starts[0] + n])) for a, n in zip(starts, sizes, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], t) for k, t in kinds.items()], names=list(kinds))

    work = checkpointed(spread(manifest.select("path")).mapInArrow(ranges, "path string, starts array<long>, sizes array<long>"))
    return spread(work).mapInArrow(records, "page_id long, url string, record_type string, payload_digest string, payload_bytes long, refers_to long" + ", payload binary" * payloads)
