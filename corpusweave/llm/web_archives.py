"""WARC records in ZIP packages, read by byte ranges without extraction.

A package stores ``archive/data.warc.gz``, one gzip member per record, and ``indexes/index.cdxj``, one
line per record with its place. Both are stored as they are, so a record is found by adding the
member's place in the package to the record's place in the member. The reader takes the end of the
package, its central directory and, where counts or sizes need it, the ZIP64 forms of both.
"""

from __future__ import annotations

import gzip
import hashlib
import json
import re
import struct
import uuid
import zipfile
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusweave.llm.batches import broadcast_if_bytes, slices, write_and_read

DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
DATE = "2024-01-01T00:00:00Z"
# Payloads below this many bytes are always written whole.
REVISIT_BYTES = 1000
# Bytes of payload after which a task begins a new package.
PACKAGE_BYTES = 256 << 20
# Records of a package, whose index lines a task holds: empty pages have no bytes to count.
PACKAGE_RECORDS = 100_000
SALTS = 16
HOT_COPIES = 10_000

END_MARK, END64_MARK, LOCATOR_MARK = b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07"
ENTRY_MARK, LOCAL_MARK = b"PK\x01\x02", b"PK\x03\x04"
END_SIZE, LOCATOR_SIZE, END64_SIZE, ENTRY_SIZE, LOCAL_SIZE = 22, 20, 56, 46, 30
MAX_COMMENT = 0xFFFF
FULL16, FULL32 = 0xFFFF, 0xFFFFFFFF
ZIP64_EXTRA = 1

Reader = Callable[[int, int], bytes]


@dataclass(frozen=True)
class Member:
    name: str
    method: int
    size: int
    stored_size: int
    header_at: int


def directory(read: Reader, size: int) -> list[Member]:
    """Members of a ZIP package by its central directory, in ZIP64 form or not."""
    tail_at = max(size - END_SIZE - MAX_COMMENT, 0)
    tail = read(tail_at, size - tail_at)
    place = tail.rfind(END_MARK)
    while place >= 0 and place + END_SIZE + int.from_bytes(tail[place + 20 : place + 22], "little") != len(tail):
        place = tail.rfind(END_MARK, 0, place)
    if place < 0:
        raise ValueError("no end of central directory: not a ZIP package")
    count, length, start = struct.unpack("<HII", tail[place + 10 : place + 20])
    locator_at = tail_at + place - LOCATOR_SIZE
    if (count == FULL16 or length == FULL32 or start == FULL32) and locator_at >= 0:
        locator = read(locator_at, LOCATOR_SIZE)
        if locator[:4] == LOCATOR_MARK:
            (end64_at,) = struct.unpack("<Q", locator[8:16])
            end64 = read(end64_at, END64_SIZE)
            if end64[:4] != END64_MARK:
                raise ValueError("the ZIP64 locator points at no ZIP64 end")
            count, length, start = struct.unpack("<QQQ", end64[32:56])
    data, at, members = read(start, length), 0, []
    for _ in range(count):
        if data[at : at + 4] != ENTRY_MARK:
            raise ValueError("broken central directory")
        flags, method = struct.unpack("<HH", data[at + 8 : at + 12])
        stored, plain, n_name, n_extra, n_comment = struct.unpack("<IIHHH", data[at + 20 : at + 34])
        (header_at,) = struct.unpack("<I", data[at + 42 : at + 46])
        name_at = at + ENTRY_SIZE
        name = data[name_at : name_at + n_name].decode("utf-8" if flags & 0x800 else "cp437")
        wide = _zip64_values(data[name_at + n_name : name_at + n_name + n_extra])
        # The wide values come in this order, each only if its narrow field is full.
        plain = next(wide) if plain == FULL32 else plain
        stored = next(wide) if stored == FULL32 else stored
        header_at = next(wide) if header_at == FULL32 else header_at
        members.append(Member(name, method, plain, stored, header_at))
        at = name_at + n_name + n_extra + n_comment
    return members


def _zip64_values(extra: bytes) -> Iterator[int]:
    at = 0
    while at + 4 <= len(extra):
        kind, length = struct.unpack("<HH", extra[at : at + 4])
        if kind == ZIP64_EXTRA:
            for k in range(at + 4, at + 4 + length - 7, 8):
                yield int.from_bytes(extra[k : k + 8], "little")
        at += 4 + length


def data_start(read: Reader, member: Member) -> int:
    """Where the bytes of a stored member begin; its local header has lengths of its own."""
    if member.method != 0:
        raise ValueError(f"{member.name} is compressed in the package and has no byte ranges")
    header = read(member.header_at, LOCAL_SIZE)
    if header[:4] != LOCAL_MARK:
        raise ValueError("broken local header")
    n_name, n_extra = struct.unpack("<HH", header[26:30])
    return member.header_at + LOCAL_SIZE + n_name + n_extra


def record_id(page_id) -> str:
    return f"<urn:page:{'null' if page_id is None else page_id}>"


def record_bytes(page_id, url: str | None, payload: bytes, digest: str, kind: str, refers_to, full_size: int) -> bytes:
    """One WARC record with its HTTP headers. A revisit has the headers of the full answer and no body."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {full_size}\r\n\r\n"
    body = http.encode() + (payload if kind == "response" else b"")
    fields = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", record_id(page_id)),
        ("WARC-Date", DATE),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("Content-Type", "application/http;msgtype=response"),
    ]
    if url is not None:
        fields.append(("WARC-Target-URI", quote(url, safe=":/?#[]@!$&'()*+,;=%~-._")))
    if kind == "revisit":
        fields.append(("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))
        fields.append(("WARC-Refers-To", record_id(refers_to)))
    fields.append(("Content-Length", str(len(body))))
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return head.encode() + body + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """WARC fields, HTTP fields and payload of one record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    body = rest[: int(fields["Content-Length"])]
    if rest[len(body) :] != b"\r\n\r\n":
        raise ValueError("the record does not end where its length says")
    http, _, payload = body.partition(b"\r\n\r\n")
    return fields, dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:]), payload


class Package:
    """Writes one package. Records go straight to the store; the index is kept until the end."""

    def __init__(self, sink):
        self.zip = zipfile.ZipFile(sink, "w", zipfile.ZIP_STORED, allowZip64=True)
        self.member = self.zip.open(zipfile.ZipInfo(DATA), "w", force_zip64=True)
        self.at, self.payload, self.lines = 0, 0, []

    def add(self, page_id, url: str | None, record: bytes, digest: str, kind: str, payload_size: int) -> None:
        packed = gzip.compress(record, 1, mtime=0)
        self.member.write(packed)
        entry = {"url": url, "page_id": page_id, "digest": f"sha1:{digest}", "type": kind, "offset": self.at, "length": len(packed)}
        host = quote(re.sub(r"^\w+://", "", url or "").lower(), safe="/?#=&:%") or "-"
        self.lines.append(f"{host} {re.sub(r'[^0-9]', '', DATE)} {json.dumps(entry)}")
        self.at += len(packed)
        self.payload += payload_size

    def close(self) -> None:
        self.member.close()
        with self.zip.open(zipfile.ZipInfo(INDEX), "w", force_zip64=True) as index:
            for line in sorted(self.lines):
                index.write(line.encode() + b"\n")
        self.zip.close()


def planned(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(page_id, url, html, bytes, digest, kind, refers_to) of every page.

    Of payloads that are equal and of ``REVISIT_BYTES`` at least, the page with the largest id is the
    response and the others revisit it; if the largest id repeats, each of its rows is a response. A
    null page id is smaller than any. A null payload is empty, and small ones are always responses.
    Only digests are grouped, and those with very many pages are dealt by a salt on both sides.
    """
    body = F.coalesce(F.col(f"`{html}`").cast("string"), F.lit(""))
    pages = pages.select(F.col(f"`{key}`").alias("page_id"), F.col(f"`{url}`").cast("string").alias("url"), body.alias("html"))
    marked = pages.withColumn("bytes", F.octet_length("html").cast("long")).withColumn(
        "digest", F.sha1(F.col("html").cast("binary"))
    )
    large = F.col("bytes") >= REVISIT_BYTES
    copies = (
        marked.filter(large)
        .groupBy("digest")
        .agg(F.count(F.lit(1)).alias("n"), F.max("page_id").alias("target"))
        .filter("n > 1 and target is not null")
    )
    hot = F.when(F.col("n") > HOT_COPIES, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(-1)))
    dealt = write_and_read(copies.select("digest", "target", "n", F.explode(hot).alias("salt")), "warc-copies")
    # Small payloads need no target and join nothing. Of the others, copies of a hot payload are salted before
    # the one join that moves pages.
    hot_digests = broadcast_if_bytes(dealt.filter("salt = 0").select("digest", F.lit(True).alias("hot")))
    salt = F.when(F.col("hot"), F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS))).otherwise(-1).cast("int")
    salted = marked.filter(large).join(hot_digests, "digest", "left").withColumn("salt", salt).drop("hot")
    joined = salted.join(dealt.select("digest", "salt", "target"), ["digest", "salt"], "left").drop("salt")
    small = marked.filter(~large).withColumn("target", F.lit(None).cast(joined.schema["target"].dataType))
    found = joined.unionByName(small)
    target = F.col("target")
    revisit = target.isNotNull() & ~F.col("page_id").eqNullSafe(target)
    return found.select(
        "page_id", "url", "html", "bytes", "digest",
        F.when(revisit, "revisit").otherwise("response").alias("kind"),
        F.when(revisit, target).alias("refers_to"),
    )


def write(plan: DataFrame, folder: str, package_bytes: int = PACKAGE_BYTES) -> DataFrame:
    """Write packages below ``folder``, a few per task, and return (file, n_records, n_bytes).

    A try of a task writes names of its own, and only files of finished tasks are listed.
    """
    store, base = pafs.FileSystem.from_uri(folder)
    store.create_dir(base, recursive=True)

    def run(batches):
        store, base = pafs.FileSystem.from_uri(folder)
        package = sink = name = None

        def done():
            package.close()
            size = sink.tell()
            sink.close()
            return pa.RecordBatch.from_arrays(
                [pa.array([f"{folder}/{name}"]), pa.array([len(package.lines)]), pa.array([size])],
                names=["file", "n_records", "n_bytes"],
            )

        for batch in batches:
            for part in slices(batch, "html"):
                for page_id, url, html, size, digest, kind, target in zip(
                    *[part.column(c).to_pylist() for c in ("page_id", "url", "html", "bytes", "digest", "kind", "refers_to")],
                    strict=True,
                ):
                    if package is None:
                        name = f"pages-{uuid.uuid4().hex}.wacz"
                        sink = store.open_output_stream(f"{base}/{name}")
                        package = Package(sink)
                    payload = html.encode("utf-8", "surrogatepass")
                    record = record_bytes(page_id, url, payload, digest, kind, target, size)
                    package.add(page_id, url, record, digest, kind, len(payload))
                    if package.payload >= package_bytes or len(package.lines) >= PACKAGE_RECORDS:
                        yield done()
                        package = None
        if package is not None:
            yield done()

    return write_and_read(plan.mapInArrow(run, "file string, n_records long, n_bytes long"), "warc-files")


def ranges(files: DataFrame, bytes_of_index: int = 4 << 20) -> DataFrame:
    """(file, offset, length, page_id) of every record, by directories and indexes alone."""

    def run(batches):
        for batch in batches:
            for file in batch.column("file").to_pylist():
                store, path = pafs.FileSystem.from_uri(file)
                with store.open_input_file(path) as opened:
                    read = lambda at, n: opened.read_at(n, at)
                    members = {m.name: m for m in directory(read, opened.size())}
                    start = data_start(read, members[DATA])
                    index = members[INDEX]
                    at, end, rest = (first := data_start(read, index)), 0, b""
                    end = first + index.size
                    while at < end:
                        block = rest + read(at, min(bytes_of_index, end - at))
                        at += bytes_of_index
                        *lines, rest = block.split(b"\n")
                        entries = [json.loads(line.split(b" ", 2)[2]) for line in lines]
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array([file] * len(entries), pa.string()),
                                pa.array([start + e["offset"] for e in entries], pa.int64()),
                                pa.array([e["length"] for e in entries], pa.int64()),
                            ],
                            names=["file", "offset", "length"],
                        )

    # A row stands for a package, so each is read by a task of its own.
    n = max(files.count(), 1)
    return files.select("file").repartition(n, "file").mapInArrow(run, "file string, offset long, length long")


def read_records(found: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of each record by its range.

    Ids come back from the record ids as text. The digest of a response is computed from its payload
    and has to agree with the record's field; a revisit has only the field.
    """

    def run(batches):
        file = opened = None
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part, rows = batch.slice(start, 512), []
                for name, at, size in zip(*[part.column(c).to_pylist() for c in ("file", "offset", "length")], strict=True):
                    if name != file:
                        if opened is not None:
                            opened.close()
                        store, path = pafs.FileSystem.from_uri(name)
                        file, opened = name, store.open_input_file(path)
                    fields, http, payload = parse_record(zlib.decompress(opened.read_at(size, at), 31))
                    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                    if fields["WARC-Type"] == "response" and hashlib.sha1(payload).hexdigest() != digest:
                        raise ValueError(f"payload of {fields['WARC-Record-ID']} does not match its digest")
                    target = fields.get("WARC-Refers-To")
                    rows.append(
                        (
                            fields["WARC-Record-ID"][10:-1], int(http["Content-Length"]), digest,
                            fields["WARC-Type"], target and target[10:-1], len(payload),
                        )
                    )
                names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "stored_bytes"]
                kinds = (pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64())
                columns = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)
        if opened is not None:
            opened.close()

    schema = (
        "page_id string, payload_bytes long, payload_digest string, record_type string, refers_to string, "
        "stored_bytes long"
    )
    return found.mapInArrow(run, schema)
