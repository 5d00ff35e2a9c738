"""WARC records inside ZIP packages, read by byte ranges.

Writing. Each task streams its rows into one package: a stored member
``archive/data.warc.gz`` (one gzip member per record) and a stored member
``indexes/index.cdxj`` (url, record id, offset and length of each record).
A package gets a fresh name and counts only when it stands in the manifest,
which is written under the shared folder when all tasks are done; an attempt
that was lost leaves a file that nothing reads.

Reading. From the end of a package the end-of-central-directory record is
found, its ZIP64 form where the fields overflow, then the central directory
and the local headers of stored members: the place of archive and index is
known without extraction. Index rows become Spark rows, are spread over tasks,
and each record is fetched by one range read.

Duplicates. Payloads of ``min_revisit`` bytes and more that are equal (SHA-1
and size) are stored once, with the largest page id; the others are revisit
records that name it. Only narrow rows meet in that join, digests are
pre-aggregated, and a digest that holds a third of the rows is a skewed join
key which adaptive execution splits.

Defined results: null html or url is empty; a null page id writes and reads
back as null; repeated rows of one page give a record each; an empty table
gives an empty result.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import json
import struct
import uuid
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qtrail.llm.common import materialize
from qtrail.session import scratch_path

ARCHIVE, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
MIN_REVISIT = 1000
SPLIT_BYTES = 16 << 20  # of a package, read by one task
DATE = "2024-01-01T00:00:00Z"


def open_store(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """File system and path of a shared folder's URI or absolute path."""
    return pyarrow.fs.FileSystem.from_uri(uri)


# -- records -----------------------------------------------------------------
def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'null' if page_id is None else page_id}>"


def page_of(urn: str) -> int | None:
    value = urn.removeprefix("<urn:page:").removesuffix(">")
    return None if value == "null" else int(value)


def warc_record(page_id: int | None, url: str, payload: bytes | None, digest: str, size: int,
                refers_to: int | None) -> bytes:
    """A response record, or without a payload a revisit record: it keeps the
    HTTP header, whose Content-Length is that of the full payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http + (payload or b"")
    head = ["WARC/1.1", f"WARC-Type: {'response' if payload is not None else 'revisit'}",
            f"WARC-Record-ID: {record_id(page_id)}", f"WARC-Date: {DATE}",
            "WARC-Target-URI: " + json.dumps(url)[1:-1], f"WARC-Payload-Digest: sha1:{digest}"]
    if payload is None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: {record_id(refers_to)}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


@dataclass(frozen=True)
class Record:
    headers: dict[str, str]
    http: dict[str, str]
    payload: bytes


def _headers(raw: bytes) -> dict[str, str]:
    lines = raw.decode().split("\r\n")[1:]
    return {k.lower(): v for k, _, v in (line.partition(": ") for line in lines)}


def parse_record(raw: bytes) -> Record:
    head, _, rest = raw.partition(b"\r\n\r\n")
    if not head.startswith(b"WARC/"):
        raise ValueError("no WARC record here")
    headers = _headers(head)
    size = int(headers["content-length"])
    if len(rest) < size:
        raise ValueError("record cut short")
    http, _, payload = rest[:size].partition(b"\r\n\r\n")
    return Record(headers, _headers(http), payload)


# -- ZIP directories ---------------------------------------------------------
@dataclass(frozen=True)
class Member:
    name: str
    method: int
    size: int
    offset: int  # of the member's data


def _read(f, offset: int, size: int) -> bytes:
    f.seek(offset)
    data = f.read(size)
    if len(data) != size:
        raise ValueError("file cut short")
    return data


def zip_members(f, size: int) -> list[Member]:
    """Members of a package from its central directory, ZIP64 included."""
    tail_at = max(0, size - 65_557)  # the record and the longest comment
    tail = _read(f, tail_at, size - tail_at)
    at = tail.rfind(b"PK\x05\x06")
    while at >= 0 and at + 22 + int.from_bytes(tail[at + 20:at + 22], "little") != len(tail):
        at = tail.rfind(b"PK\x05\x06", 0, at)
    if at < 0:
        raise ValueError("no end of central directory")
    _, _, _, count, length, start = struct.unpack_from("<HHHHII", tail, at + 4)
    if count == 0xFFFF or length == 0xFFFFFFFF or start == 0xFFFFFFFF:
        locator = _read(f, tail_at + at - 20, 20)
        if locator[:4] != b"PK\x06\x07":
            raise ValueError("no ZIP64 locator")
        end64 = _read(f, int.from_bytes(locator[8:16], "little"), 56)
        if end64[:4] != b"PK\x06\x06":
            raise ValueError("no ZIP64 end of central directory")
        count, length, start = struct.unpack_from("<QQQ", end64, 32)
    directory, out, at = _read(f, start, length), [], 0
    for _ in range(count):
        if directory[at:at + 4] != b"PK\x01\x02":
            raise ValueError("broken central directory")
        method, = struct.unpack_from("<H", directory, at + 10)
        packed, plain, name_n, extra_n, note_n = struct.unpack_from("<IIHHH", directory, at + 20)
        local, = struct.unpack_from("<I", directory, at + 42)
        name = directory[at + 46:at + 46 + name_n].decode()
        extra = directory[at + 46 + name_n:at + 46 + name_n + extra_n]
        at += 46 + name_n + extra_n + note_n
        while len(extra) >= 4:
            tag, n = struct.unpack_from("<HH", extra)
            if tag == 1:  # holds, in this order, the fields that overflow
                wide = iter(struct.unpack(f"<{n // 8}Q", extra[4:4 + n // 8 * 8]))
                plain = next(wide) if plain == 0xFFFFFFFF else plain
                packed = next(wide) if packed == 0xFFFFFFFF else packed
                local = next(wide) if local == 0xFFFFFFFF else local
            extra = extra[4 + n:]
        header = _read(f, local, 30)
        if header[:4] != b"PK\x03\x04":
            raise ValueError("broken local header")
        out.append(Member(name, method, packed, local + 30 + sum(struct.unpack_from("<HH", header, 26))))
    return out


def package_index(f, size: int) -> list[tuple[int, int, dict]]:
    """Absolute offset, length and index entry of each record of a package."""
    members = {m.name: m for m in zip_members(f, size)}
    archive, index = members[ARCHIVE], members[INDEX]
    if archive.method or index.method:
        raise ValueError("archive and index must be stored, not compressed")
    entries = (json.loads(line.partition(b" ")[2])
               for line in _read(f, index.offset, index.size).splitlines() if line)
    return [(archive.offset + e["offset"], e["length"], e) for e in entries]


# -- Spark -------------------------------------------------------------------
def with_revisits(pages: DataFrame, min_revisit: int = MIN_REVISIT, key: str = "page_id", url: str = "url",
                  html: str = "html") -> DataFrame:
    """Page id, url, payload, digest, size and, for revisits, ``refers_to``."""
    rows = pages.select(F.col(key).cast("long").alias("page_id"), F.coalesce(F.col(url), F.lit("")).alias("url"),
                        F.encode(F.coalesce(F.col(html), F.lit("")), "UTF-8").alias("payload"))
    rows = rows.withColumns({"digest": F.sha1("payload"), "size": F.length("payload").cast("long")})
    shared = (rows.where(F.col("size") >= min_revisit).groupBy("digest", "size")
              .agg(F.max("page_id").alias("kept"), F.count(F.lit(1)).alias("n"))
              .where("n > 1").select(F.col("digest").alias("_d"), F.col("size").alias("_s"), "kept"))
    joined = rows.join(shared, (F.col("digest") == F.col("_d")) & (F.col("size") == F.col("_s")), "left")
    refers = F.when(F.col("kept") != F.col("page_id"), F.col("kept"))
    # A page id that is null, beside others, refers to the kept one as well.
    refers = F.when(F.col("page_id").isNull(), F.col("kept")).otherwise(refers)
    return joined.select("page_id", "url", F.when(refers.isNull(), F.col("payload")).alias("payload"),
                         "digest", "size", refers.alias("refers_to"))


def write_packages(records: DataFrame, root: str) -> DataFrame:
    """Write one package per task under ``root`` (a folder all machines
    share); returns the manifest ``path, bytes, records``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = open_store(root)
        first = next(batches, None)
        if first is None:
            return
        fs.create_dir(base, recursive=True)
        path = f"{base}/{uuid.uuid4().hex}.wacz"
        index, at = io.BytesIO(), 0
        with fs.open_output_stream(path) as sink, zipfile.ZipFile(sink, "w", zipfile.ZIP_STORED) as package:
            with package.open(ARCHIVE, "w", force_zip64=True) as member:
                while first is not None:
                    for page, url, payload, digest, size, refers in zip(*(c.to_pylist() for c in first.columns)):
                        raw = gzip.compress(warc_record(page, url, payload, digest, size, refers), 4, mtime=0)
                        member.write(raw)
                        entry = {"url": url, "id": record_id(page), "offset": at, "length": len(raw)}
                        index.write(f"{DATE} {json.dumps(entry)}\n".encode())
                        at += len(raw)
                    first = next(batches, None)
            with package.open(INDEX, "w", force_zip64=True) as member:
                member.write(index.getbuffer())
        info = fs.get_file_info(path)
        yield pa.RecordBatch.from_arrays(
            [pa.array([path]), pa.array([info.size], pa.int64()),
             pa.array([index.getvalue().count(b"\n")], pa.int64())], names=["path", "bytes", "records"])

    manifest = records.mapInArrow(run, "path string, bytes long, records long")
    return materialize(manifest, "warc-manifest")


def read_index(manifest: DataFrame, root: str) -> DataFrame:
    """One row per record: ``path, offset, length, url, id``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = open_store(root)
        for b in batches:
            for path, size in zip(b.column("path").to_pylist(), b.column("bytes").to_pylist()):
                with fs.open_input_file(path) as f:
                    rows = package_index(f, size)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([path] * len(rows)), pa.array([r[0] for r in rows], pa.int64()),
                     pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2]["url"] for r in rows]),
                     pa.array([r[2]["id"] for r in rows])], names=["path", "offset", "length", "url", "id"])

    return manifest.mapInArrow(run, "path string, offset long, length long, url string, id string")


def read_records(index: DataFrame, root: str, with_payload: bool = True) -> DataFrame:
    """Records fetched by range reads and checked against their digests."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = open_store(root)
        name, f = None, None
        try:
            for b in batches:
                out = []
                for path, offset, length in zip(*(b.column(c).to_pylist() for c in ("path", "offset", "length"))):
                    if path != name:
                        if f is not None:
                            f.close()
                        name, f = path, fs.open_input_file(path)
                    r = parse_record(gzip.decompress(_read(f, offset, length)))
                    digest = r.headers["warc-payload-digest"].removeprefix("sha1:")
                    kind = r.headers["warc-type"]
                    if kind == "response" and hashlib.sha1(r.payload).hexdigest() != digest:
                        raise ValueError(f"payload does not match its digest: {path} {offset}")
                    refers = r.headers.get("warc-refers-to")
                    out.append((page_of(r.headers["warc-record-id"]), json.loads(f'"{r.headers["warc-target-uri"]}"'),
                                kind, digest, int(r.http["content-length"]), refers and page_of(refers),
                                r.payload if with_payload and kind == "response" else None))
                cols = list(zip(*out)) if out else [[]] * 7
                kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(cols, kinds)], names=[
                    "page_id", "url", "record_type", "payload_digest", "payload_bytes", "refers_to", "payload"])
        finally:
            if f is not None:
                f.close()

    return index.select("path", "offset", "length").mapInArrow(
        run, "page_id long, url string, record_type string, payload_digest string, payload_bytes long,"
             " refers_to long, payload binary")


def archive_round_trip(pages: DataFrame, min_revisit: int = MIN_REVISIT, with_payload: bool = True) -> DataFrame:
    """Write every page, then read the records back out of the packages."""
    spark = pages.sparkSession
    root = scratch_path(spark, "warc")
    if "://" not in root and root.startswith("file:"):
        root = root.removeprefix("file:")
    manifest = write_packages(with_revisits(pages, min_revisit), root)
    index = materialize(read_index(manifest, root), "warc-index")
    # Neighbouring records of a package are read by one task, in order.
    spread = (index.withColumn("_part", F.floor(F.col("offset") / SPLIT_BYTES)).repartition("path", "_part")
              .sortWithinPartitions("path", "offset").drop("_part"))
    return read_records(spread, root, with_payload)
