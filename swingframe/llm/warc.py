"""WARC records in ZIP packages, written and read in ranges.

Writing: each partition of pages becomes one ZIP file with two stored (uncompressed) members,
``archive/data.warc.gz`` (one gzip member per record) and ``indexes/index.cdxj`` (one JSON line per
record: offset and length in the archive). Every record carries its payload's SHA-1; of
records with equal payloads the one with the largest page_id holds the payload, the others are
revisits of it. A task writes under a name of its own attempt, and the table of packages lists
what successful attempts wrote, so a repeated task leaves at worst a file nobody reads.

Reading: the end of the file gives the central directory (through the ZIP64 records where they
are needed), which gives the members; a member's local header gives the place of its bytes. The index
is read from there, and then each record by its range; nothing is unpacked to disk. Index
entries are dealt out in runs of neighbouring records, so a large package is read by many tasks.

Files are opened by URI through pyarrow's file systems, so packages lie in the folder that
spark.checkpoint.dir names, on whatever store that is.

Defined results: a null html is an empty payload; a null url is an empty target. Rows that repeat
page_id and payload are pages of their own, of which every one with the largest page_id is a
response. A null page_id ranks lowest; if a group has no other, its rows are all responses.
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
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from swingframe.llm.store import fresh_path, written

ARCHIVE, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
READ_BYTES = 4 << 20
RUN = 256  # neighbouring records that are read together
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
DATE = "1970-01-01T00:00:00Z"


def opened(uri: str) -> tuple[pafs.FileSystem, str]:
    if uri.startswith("s3a://"):
        uri = "s3" + uri[3:]
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[5:]
    return pafs.FileSystem.from_uri(uri) if "://" in uri else (pafs.LocalFileSystem(), uri)


# ---- records


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def urn(page: object) -> str:
    return f"<urn:page:{'none' if page is None else page}>"


def page_of(name: str) -> int | None:
    """The page number in a record's name."""
    last = name.strip("<>").rpartition(":")[2]
    return None if last == "none" else int(last)


def record(page: int | None, url: str, payload: bytes, sha: str, refers_to: int | None, revisit: bool) -> bytes:
    block = HTTP if revisit else HTTP + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {urn(page)}", f"WARC-Date: {DATE}",
             f"WARC-Target-URI: {quote(url, safe=':/?#[]@!$&()*+,;=%~' + chr(39))}", f"WARC-Payload-Digest: sha1:{sha}",
             f"WARC-Payload-Length: {len(payload)}"]
    if revisit:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {urn(refers_to)}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parsed(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (names in lower case) and payload of a record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError(f"not a WARC record: {version[:40]!r}")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
    block = rest[: int(fields["content-length"])]
    if len(block) < int(fields["content-length"]):
        raise ValueError("a WARC record ends early")
    return fields, block.partition(b"\r\n\r\n")[2]


# ---- packages


def write_package(sink, records: Iterator[tuple[str, bytes]]) -> int:
    """Write (name, record) pairs as a package to a binary sink; returns how many."""
    index = io.StringIO()
    count = at = 0
    with zipfile.ZipFile(sink, "w", zipfile.ZIP_STORED, allowZip64=True) as package:
        with package.open(zipfile.ZipInfo(ARCHIVE), "w", force_zip64=True) as member:
            for name, raw in records:
                press = zlib.compressobj(3, zlib.DEFLATED, 31)  # a gzip member
                packed = press.compress(raw) + press.flush()
                member.write(packed)
                index.write(json.dumps({"name": name, "offset": at, "length": len(packed)}) + "\n")
                at, count = at + len(packed), count + 1
        with package.open(zipfile.ZipInfo(INDEX), "w", force_zip64=True) as member:
            member.write(index.getvalue().encode())
    return count


class Package:
    """Members of a ZIP file, found from its end and read in ranges."""

    def __init__(self, file, size: int):
        self.file = file
        tail_at = max(0, size - 22 - 65535)
        tail = self.range(tail_at, size - tail_at)
        end = tail.rfind(b"PK\x05\x06")
        if end < 0:
            raise ValueError("no end of central directory")
        entries, length, start = struct.unpack("<HII", tail[end + 10: end + 20])
        if entries == 0xFFFF or length == 0xFFFFFFFF or start == 0xFFFFFFFF:
            place = tail.rfind(b"PK\x06\x07", 0, end)
            if place < 0:
                raise ValueError("no ZIP64 locator")
            at = struct.unpack("<Q", tail[place + 8: place + 16])[0]
            large = self.range(at, 56)
            if large[:4] != b"PK\x06\x06":
                raise ValueError("no ZIP64 end of central directory")
            entries, length, start = struct.unpack("<QQQ", large[32:56])
        self.members: dict[str, tuple[int, int]] = {}  # name: place of the local header, size
        directory, at = self.range(start, length), 0
        for _ in range(entries):
            if directory[at: at + 4] != b"PK\x01\x02":
                raise ValueError("broken central directory")
            method, = struct.unpack("<H", directory[at + 10: at + 12])
            packed, size_of, name_len, extra_len, note_len = struct.unpack("<IIHHH", directory[at + 20: at + 34])
            header, = struct.unpack("<I", directory[at + 42: at + 46])
            name = directory[at + 46: at + 46 + name_len].decode()
            extra = directory[at + 46 + name_len: at + 46 + name_len + extra_len]
            wide = [k for k, v in (("size", size_of), ("packed", packed), ("header", header)) if v == 0xFFFFFFFF]
            while len(extra) >= 4:
                kind, long = struct.unpack("<HH", extra[:4])
                if kind == 1:  # ZIP64 fields stand in this order, each only where the short one is full
                    values = dict(zip(wide, struct.unpack(f"<{long // 8}Q", extra[4: 4 + long // 8 * 8])))
                    packed, header = values.get("packed", packed), values.get("header", header)
                extra = extra[4 + long:]
            if method == 0:
                self.members[name] = (header, packed)
            at += 46 + name_len + extra_len + note_len

    def range(self, at: int, length: int) -> bytes:
        self.file.seek(at)
        got = self.file.read(length)
        if len(got) < length:
            raise ValueError("a package ends early")
        return bytes(got)

    def place(self, name: str) -> tuple[int, int]:
        """Where a stored member's bytes begin, and how many they are."""
        header, size = self.members[name]
        local = self.range(header, 30)
        if local[:4] != b"PK\x03\x04":
            raise ValueError("broken local header")
        name_len, extra_len = struct.unpack("<HH", local[26:30])
        return header + 30 + name_len + extra_len, size


# ---- Spark


def write_pages(pages: DataFrame, least: int = 0) -> DataFrame:
    """Write every page as a record; returns the packages (path, size, records). Payloads under
    ``least`` bytes are never revisits."""
    spark = pages.sparkSession
    folder = fresh_path(spark, "warc")
    system, base = opened(folder)
    system.create_dir(base, recursive=True)
    html = F.coalesce("html", F.lit(""))
    keyed = pages.select("page_id", F.coalesce("url", F.lit("")).alias("url"), html.alias("html"), F.sha1(html.cast("binary")).alias("sha"))
    best = keyed.select("sha", "page_id").groupBy("sha").agg(F.max("page_id").alias("best"))
    rows = keyed.join(best, "sha").select("page_id", "url", "html", "best")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def records() -> Iterator[tuple[str, bytes]]:
            for batch in batches:
                for page, url, text, best_page in zip(*(batch.column(k).to_pylist() for k in range(4))):
                    payload = text.encode()
                    revisit = len(payload) >= least and best_page is not None and page != best_page
                    yield urn(page), record(page, url, payload, digest(payload), best_page, revisit)

        found = records()
        head = next(found, None)
        if head is None:
            return
        system, base = opened(folder)
        path = f"{folder}/{uuid.uuid4().hex}.wacz"
        target = path[len(folder):]

        def every() -> Iterator[tuple[str, bytes]]:
            yield head
            yield from found

        with system.open_output_stream(base + target) as sink:
            count = write_package(sink, every())
        size = system.get_file_info(base + target).size
        yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([size]), pa.array([count])], names=["path", "size", "records"])

    return written(rows.mapInArrow(run, "path string, size long, records long"), "packages")


def tasks(packages: DataFrame) -> int:
    """A number for repartition(): without one the adaptive planner sizes by the few bytes of a path, not by what it names."""
    return int(packages.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def index_entries(packages: DataFrame) -> DataFrame:
    """path, at, length of every record, from the packages' own directories and indexes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, size in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                system, name = opened(path)
                with system.open_input_file(name) as file:
                    package = Package(file, size)
                    start, _ = package.place(ARCHIVE)
                    at, left = package.place(INDEX)
                    rest = b""
                    while left:
                        some = min(left, READ_BYTES)
                        *lines, rest = (rest + package.range(at, some)).split(b"\n")
                        at, left = at + some, left - some
                        if entries := [json.loads(x) for x in lines if x]:
                            yield pa.RecordBatch.from_arrays(
                                [pa.array([path] * len(entries)), pa.array([start + e["offset"] for e in entries], pa.int64()),
                                 pa.array([e["length"] for e in entries], pa.int64())], names=["path", "at", "length"])

    return packages.select("path", "size").repartition(tasks(packages), "path").mapInArrow(run, "path string, at long, length long")


def read_records(packages: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to and payload (null for revisits) of every record."""
    entries = index_entries(packages)
    placed = entries.withColumn("part", F.floor(F.col("at") / READ_BYTES)).repartition(tasks(packages), "path", "part")
    runs = placed.groupBy("path", "part").agg(
        F.sort_array(F.collect_list(F.struct("at", "length"))).alias("ranges"))  # of READ_BYTES of package at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, ranges in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                system, name = opened(path)
                with system.open_input_file(name) as file:
                    for first in range(0, len(ranges), RUN):
                        near = ranges[first: first + RUN]
                        begin = near[0]["at"]
                        file.seek(begin)
                        raw = file.read(near[-1]["at"] + near[-1]["length"] - begin)
                        out = []
                        for x in near:
                            fields, payload = parsed(zlib.decompress(raw[x["at"] - begin: x["at"] - begin + x["length"]], 31))
                            kind, sha = fields["warc-type"], fields["warc-payload-digest"].removeprefix("sha1:")
                            if kind == "response" and (digest(payload) != sha or len(payload) != int(fields["warc-payload-length"])):
                                raise ValueError(f"payload of {fields['warc-record-id']} differs from its digest")
                            out.append((page_of(fields["warc-record-id"]), int(fields["warc-payload-length"]), sha, kind,
                                        page_of(fields["warc-refers-to"]) if "warc-refers-to" in fields else None,
                                        payload if kind == "response" else None))
                        columns = list(zip(*out))
                        kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary())
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=[
                            "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"])

    return runs.select("path", "ranges").mapInArrow(
        run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary")
