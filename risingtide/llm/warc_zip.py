"""WARC records in ZIP packages: writing, and range reads without extraction.

A package is a ZIP file with two stored (uncompressed) members: the archive,
one gzip member per WARC record, and an index with a line for each record
(offset and length within the archive).  Because the members are stored, a
record lies at a computable place of the package file.  The reader looks at
the end of the file, follows the end-of-central-directory record (and its
ZIP64 form) to the central directory, finds the members, skips their local
headers and range-reads the index and then the records; nothing is unpacked
to disk and no member is read whole but the index.

Packages go to the shared scratch folder through ``pyarrow.fs`` (local or
network file systems).  A package's name holds a random part; the rows that
a finished task returns name the packages that count, so what a lost or
repeated task left behind is never read.

Defined results: a null payload is an empty one.  Among records of equal
payload that with the largest page_id is the response and the others revisit
it; null ids rank below all others.  Rows that repeat page_id and payload of
the largest id are each written as a response.  An empty table writes no
package and reads back as no rows.  Other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import io
import json
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from risingtide.llm.common import scratch_path, stored
from risingtide.session import broadcast_hint, data_size

#: A package is closed after so many bytes or records; bounds a writer's index.
PACKAGE_BYTES, PACKAGE_RECORDS = 32 << 20, 50_000
ARCHIVE, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
# Fixed values of the ZIP format: signatures and the sizes of fixed parts.
EOCD, EOCD64, LOCATOR64, CENTRAL, LOCAL = (
    b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07", b"PK\x01\x02", b"PK\x03\x04")
EOCD_SIZE, LOCATOR64_SIZE, EOCD64_SIZE, CENTRAL_SIZE, LOCAL_SIZE = 22, 20, 56, 46, 30
ZIP64_EXTRA, FULL16, FULL32 = 1, 0xFFFF, 0xFFFFFFFF


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id) -> str:
    return f"<urn:x-page:{'' if page_id is None else page_id}>"


def page_of(urn: str):
    number = urn.removeprefix("<urn:x-page:").removesuffix(">")
    return int(number) if number else None


def warc_record(page_id, url: str | None, payload: bytes, digest: str, refers_to) -> bytes:
    """One WARC/1.1 response or revisit record.  A revisit keeps the HTTP
    header, whose Content-Length is that of the full payload, and no body."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    revisit = refers_to is not None
    block = http if revisit else http + payload
    target = (url or "").replace("\r", "%0D").replace("\n", "%0A")
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
            f"WARC-Record-ID: {record_id(page_id)}", f"WARC-Target-URI: {target}",
            "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Payload-Digest: sha1:{digest}",
            "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    if revisit:
        head += [f"WARC-Refers-To: {record_id(refers_to)}",
                 "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    return ("\r\n".join(head) + "\r\n\r\n").encode() + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> tuple[dict, bytes, bytes]:
    """(WARC fields, HTTP header, body) of one record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "")
                  for x in head.decode().split("\r\n")[1:])
    block = rest[:int(fields["Content-Length"])]
    http, _, body = block.partition(b"\r\n\r\n")
    return fields, http, body


class PackageWriter:
    """Streams records into a package; the archive is written as it comes and
    the index, held in memory until then, after it."""

    def __init__(self, folder: str):
        self.files, base = pafs.FileSystem.from_uri(folder)
        self.files.create_dir(base, recursive=True)
        name = f"{uuid.uuid4().hex}.zip"
        self.place = f"{folder}/{name}"
        self.stream = self.files.open_output_stream(f"{base}/{name}", compression=None)
        self.zip = zipfile.ZipFile(self.stream, "w", zipfile.ZIP_STORED, allowZip64=True)
        self.member = self.zip.open(zipfile.ZipInfo(ARCHIVE), "w", force_zip64=True)
        self.size, self.index = 0, []

    def add(self, record: bytes) -> None:
        packer = zlib.compressobj(6, zlib.DEFLATED, 31)
        packed = packer.compress(record) + packer.flush()
        self.member.write(packed)
        self.index.append((self.size, len(packed)))
        self.size += len(packed)

    def full(self) -> bool:
        return self.size >= PACKAGE_BYTES or len(self.index) >= PACKAGE_RECORDS

    def close(self) -> tuple[str, int, int]:
        self.member.close()
        with self.zip.open(zipfile.ZipInfo(INDEX), "w", force_zip64=True) as out:
            for offset, length in self.index:
                out.write(json.dumps({"offset": offset, "length": length}).encode() + b"\n")
        self.zip.close()
        self.stream.close()
        return self.place, self.size, len(self.index)


def end_of_directory(read, size: int) -> tuple[int, int]:
    """(offset, length) of the central directory, ZIP64 or not."""
    tail_at = max(0, size - EOCD_SIZE - FULL16)
    tail = read(tail_at, size - tail_at)
    at = tail.rfind(EOCD, 0, max(0, len(tail) - EOCD_SIZE + len(EOCD)))  # a whole record must fit
    while at >= 0 and at + EOCD_SIZE + struct.unpack_from("<H", tail, at + 20)[0] != len(tail):
        at = tail.rfind(EOCD, 0, at)  # a signature inside the comment
    if at < 0:
        raise ValueError("not a ZIP file: it has no end of central directory")
    entries, length, offset = struct.unpack_from("<HII", tail, at + 10)
    if FULL16 == entries or FULL32 in (length, offset):
        where = tail_at + at - LOCATOR64_SIZE
        locator = read(where, LOCATOR64_SIZE) if where >= 0 else b""
        if locator[:4] == LOCATOR64:
            (where,) = struct.unpack_from("<Q", locator, 8)
            record = read(where, EOCD64_SIZE)
            if record[:4] != EOCD64:
                raise ValueError("its ZIP64 locator points at no ZIP64 record")
            length, offset = struct.unpack_from("<QQ", record, 40)
    return offset, length


def members(read, size: int) -> dict[str, tuple[int, int, int]]:
    """name -> (local header's offset, size, compression method)."""
    offset, length = end_of_directory(read, size)
    directory, found, at = read(offset, length), {}, 0
    while at + CENTRAL_SIZE <= len(directory) and directory[at:at + 4] == CENTRAL:
        (method,) = struct.unpack_from("<H", directory, at + 10)
        packed, plain, n_name, n_extra, n_comment = struct.unpack_from("<IIHHH", directory, at + 20)
        (header,) = struct.unpack_from("<I", directory, at + 42)
        name = directory[at + CENTRAL_SIZE:at + CENTRAL_SIZE + n_name].decode()
        extra = directory[at + CENTRAL_SIZE + n_name:at + CENTRAL_SIZE + n_name + n_extra]
        while len(extra) >= 4:
            kind, n = struct.unpack_from("<HH", extra)
            if kind == ZIP64_EXTRA:  # holds just those of the three that are full, in this order
                wide = iter(struct.unpack_from(f"<{n // 8}Q", extra, 4))
                plain = next(wide) if plain == FULL32 else plain
                packed = next(wide) if packed == FULL32 else packed
                header = next(wide) if header == FULL32 else header
            extra = extra[4 + n:]
        found[name] = (header, packed, method)
        at += CENTRAL_SIZE + n_name + n_extra + n_comment
    return found


def stored_member(read, entry: tuple[int, int, int]) -> tuple[int, int]:
    """(offset, length) in the file of a stored member's bytes."""
    header, size, method = entry
    if method != zipfile.ZIP_STORED:
        raise ValueError("only stored members can be read by range")
    local = read(header, LOCAL_SIZE)
    if local[:4] != LOCAL:
        raise ValueError("no local header where the central directory says")
    n_name, n_extra = struct.unpack_from("<HH", local, 26)
    return header + LOCAL_SIZE + n_name + n_extra, size


def index_ranges(read, size: int) -> Iterator[tuple[int, int]]:
    """(offset, length) in the package file of each record."""
    found = members(read, size)
    base, _ = stored_member(read, found[ARCHIVE])
    for line in io.BytesIO(read(*stored_member(read, found[INDEX]))):
        x = json.loads(line)
        yield base + x["offset"], x["length"]


def read_package(place: str) -> Iterator[tuple[dict, bytes, bytes]]:
    files, path = pafs.FileSystem.from_uri(place)
    with files.open_input_file(path) as f:
        read = lambda offset, length: f.read_at(length, offset)
        for offset, length in index_ranges(read, f.size()):
            yield parse_record(zlib.decompress(read(offset, length), 31))


def with_references(pages: DataFrame) -> DataFrame:
    """page_id, url, html and, for a page whose payload another response
    holds, that response's id as refers_to.  Only digests and ids are
    grouped; digests that occur once have nothing to refer to."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"),
                        F.col("url").cast("string").alias("url"),
                        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    digest = F.unhex(F.sha1(F.encode("html", "UTF-8")))
    keys = stored(rows.groupBy(digest.alias("_digest"))
                  .agg(F.max("page_id").alias("_response"), F.count(F.lit(1)).alias("_n"))
                  .filter("_n > 1 and _response is not null").drop("_n"), "responses")
    n, size = data_size(keys)
    # Beyond the bounds a shuffle join, whose hot digests AQE splits.
    joined = rows.withColumn("_digest", digest).join(broadcast_hint(keys, n, size), "_digest", "left")
    refers = F.when(F.col("page_id").isNull() | (F.col("page_id") < F.col("_response")), F.col("_response"))
    return joined.select("page_id", "url", "html", refers.alias("refers_to"))


def write_packages(pages: DataFrame, folder: str) -> DataFrame:
    """Writes every page into packages below ``folder``; one row per package:
    place, bytes, records."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, done = None, []
        for batch in batches:
            for page_id, url, html, refers_to in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                writer = writer or PackageWriter(folder)
                payload = html.encode()
                writer.add(warc_record(page_id, url, payload, payload_digest(payload), refers_to))
                if writer.full():
                    done.append(writer.close())
                    writer = None
        if writer:
            done.append(writer.close())
        yield pa.RecordBatch.from_pylist([dict(zip(("place", "bytes", "records"), x, strict=True)) for x in done],
                                         pa.schema([("place", pa.string()), ("bytes", pa.int64()), ("records", pa.int64())]))

    return stored(with_references(pages).mapInArrow(write, "place string, bytes long, records long"), "packages")


SCHEMA = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def read_packages(packages: DataFrame, tasks: int) -> DataFrame:
    """One row per record of the packages, from range reads.  A response's
    length and digest are taken from the body that was read, and the digest
    must be the one its header states."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pandas as pd

        for batch in batches:
            for place in batch.column(0).to_pylist():
                rows = []
                for fields, http, body in read_package(place):
                    kind, digest = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha1:")
                    n = int(http.rpartition(b"Content-Length: ")[2])
                    if kind == "response" and (payload_digest(body) != digest or len(body) != n):
                        raise ValueError(f"damaged record {fields['WARC-Record-ID']} in {place}")
                    refers = fields.get("WARC-Refers-To")
                    rows.append((page_of(fields["WARC-Record-ID"]), n, digest, kind, refers and page_of(refers)))
                t = pd.DataFrame(rows, columns=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])
                for c in ("page_id", "refers_to"):
                    t[c] = pd.array([x[c == "refers_to" and 4] for x in rows], dtype="Int64")
                yield pa.RecordBatch.from_pandas(t, preserve_index=False, schema=pa.schema([
                    ("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                    ("record_type", pa.string()), ("refers_to", pa.int64())]))

    return packages.select("place").repartition(tasks, "place").mapInArrow(read, SCHEMA)


def round_trip(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Pages written to packages in the shared folder and read back."""
    packages = write_packages(pages, scratch_path(spark, "warc"))
    total = packages.count()
    return read_packages(packages, max(1, min(total, 4 * spark.sparkContext.defaultParallelism)))
