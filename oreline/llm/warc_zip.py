"""Web archives packaged in ZIP files: written with revisit records, and read by ranges, without extraction.

A package holds stored (not deflated) members ``archive/data.warc.gz``, one gzip member per record, and
``indexes/index.cdxj``, one line per record with its offset and length. The reader finds the members from
the ZIP's central directory, ZIP64 included, reads the index by its range, and then reads each record by
its own range. All access is by seek and read on ``pyarrow.fs``, so a package may lie in any file system
that it knows (local and shared folders, HDFS, object stores).
"""

from __future__ import annotations

import hashlib
import json
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oreline.llm.common import staged

DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
#: Shorter payloads are always stored in full.
REVISIT_BYTES = 1000
#: A package is closed beyond this size; further records go to the next one.
PACKAGE_BYTES = 256 << 20
#: Records that one row of the read plan covers, and bytes of records that one task reads.
RANGE_RECORDS = 100
TASK_BYTES = 32 << 20

MANIFEST = "path string, records long, bytes long"
RECORD = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"


# --- ZIP -----------------------------------------------------------------------------------------


class Member(NamedTuple):
    name: str
    method: int
    offset: int  # of the data, not of the local header
    stored: int
    size: int


def _read(f, offset: int, size: int) -> bytes:
    f.seek(offset)
    data = f.read(size)
    if len(data) != size:
        raise ValueError(f"the archive ends at {offset + len(data)}, {offset + size} was expected")
    return data


def _end(f, size: int) -> tuple[int, int, int]:
    """(entries, size, offset) of the central directory."""
    tail = _read(f, max(0, size - 65_557), min(size, 65_557))
    at = tail.rfind(b"PK\x05\x06")
    while at >= 0 and (len(tail) - at < 22 or at + 22 + struct.unpack_from("<H", tail, at + 20)[0] != len(tail)):
        at = tail.rfind(b"PK\x05\x06", 0, at)  # the signature may also stand in the comment
    if at < 0:
        raise ValueError("no end of central directory: not a ZIP file")
    entries, length, offset = struct.unpack_from("<HII", tail, at + 10)
    if entries == 0xFFFF or length == 0xFFFFFFFF or offset == 0xFFFFFFFF:
        place = size - len(tail) + at - 20
        mark, _, where, _ = struct.unpack("<4sIQI", _read(f, place, 20))
        if mark != b"PK\x06\x07":
            raise ValueError("no ZIP64 locator")
        end = _read(f, where, 56)
        if end[:4] != b"PK\x06\x06":
            raise ValueError("no ZIP64 end of central directory")
        entries, length, offset = struct.unpack_from("<QQQ", end, 32)
    return entries, length, offset


def members(f, size: int) -> list[Member]:
    """The members of a ZIP file, from its central directory; sizes and offsets may be ZIP64."""
    entries, length, offset = _end(f, size)
    directory, at, found = _read(f, offset, length), 0, []
    for _ in range(entries):
        if directory[at : at + 4] != b"PK\x01\x02":
            raise ValueError("damaged central directory")
        flags, method = struct.unpack_from("<HH", directory, at + 8)
        stored, plain, name, extra, comment = struct.unpack_from("<IIHHH", directory, at + 20)
        (local,) = struct.unpack_from("<I", directory, at + 42)
        title = directory[at + 46 : at + 46 + name].decode("utf-8" if flags & 0x800 else "cp437")
        x = at + 46 + name
        stop = x + extra
        while x + 4 <= stop:
            kind, n = struct.unpack_from("<HH", directory, x)
            if kind == 1:  # ZIP64: only the fields that overflow, in this order
                y = x + 4
                if plain == 0xFFFFFFFF:
                    (plain,), y = struct.unpack_from("<Q", directory, y), y + 8
                if stored == 0xFFFFFFFF:
                    (stored,), y = struct.unpack_from("<Q", directory, y), y + 8
                if local == 0xFFFFFFFF:
                    (local,) = struct.unpack_from("<Q", directory, y)
            x += 4 + n
        head = _read(f, local, 30)
        if head[:4] != b"PK\x03\x04":
            raise ValueError(f"no local header for {title}")
        n, e = struct.unpack_from("<HH", head, 26)
        found.append(Member(title, method, local + 30 + n + e, stored, plain))
        at = stop + comment
    return found


def _member(f, size: int, name: str) -> Member:
    for m in members(f, size):
        if m.name == name:
            if m.method:
                raise ValueError(f"{name} is compressed in the ZIP; only stored members can be read by ranges")
            return m
    raise ValueError(f"the package has no {name}")


# --- WARC ----------------------------------------------------------------------------------------


def _record(page_id: int | None, url: str | None, kind: str, refers_to: int | None, size: int, digest: str, payload: bytes) -> bytes:
    """One record, gzipped. The payload follows the headers as it is; a revisit has none."""
    # Line ends cannot stand in a header, so the address is escaped as JSON.
    fields = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}')}>"),
        ("WARC-Target-URI", json.dumps(url)),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("X-Page-ID", json.dumps(page_id)),
        ("X-Payload-Length", str(size)),
        ("Content-Type", "text/html; charset=utf-8"),
        ("Content-Length", str(len(payload))),
    ]
    if kind == "revisit":
        fields += [
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            ("WARC-Refers-To", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{refers_to}')}>"),
            ("X-Refers-To-Page", str(refers_to)),
        ]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    pack = zlib.compressobj(3, zlib.DEFLATED, 31)
    return pack.compress(head.encode() + payload + b"\r\n\r\n") + pack.flush()


def parse_record(data: bytes) -> dict:
    """The fields of RECORD from one gzipped record."""
    plain = zlib.decompress(data, 31)
    head, _, body = plain.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    payload = body[: int(fields["Content-Length"])]
    kind, digest = fields["WARC-Type"], fields["WARC-Payload-Digest"].partition(":")[2]
    size = int(fields["X-Payload-Length"])
    if kind == "response":
        # What was read counts, not what the header claims.
        if hashlib.sha1(payload).hexdigest() != digest or len(payload) != size:
            raise ValueError("a payload does not match its digest")
    return {
        "page_id": json.loads(fields["X-Page-ID"]),
        "url": json.loads(fields["WARC-Target-URI"]),
        "record_type": kind,
        "refers_to": int(fields["X-Refers-To-Page"]) if kind == "revisit" else None,
        "payload_bytes": size,
        "payload_digest": digest,
        "payload": payload if kind == "response" else None,
    }


class _Package:
    """A package being written: records stream into the data member, the index follows at the end."""

    def __init__(self, folder: str):
        self.uri = f"{folder.rstrip('/')}/{uuid.uuid4().hex}.wacz"
        self.fs, path = _locate(self.uri)
        self.fs.create_dir(path.rpartition("/")[0], recursive=True)
        self.out = self.fs.open_output_stream(path)
        self.zip = zipfile.ZipFile(self.out, "w", zipfile.ZIP_STORED, allowZip64=True)
        self.data = self.zip.open(DATA, "w", force_zip64=True)
        self.at, self.lines = 0, []

    def add(self, page_id: int | None, record: bytes) -> None:
        self.lines.append(json.dumps({"page": page_id, "offset": self.at, "length": len(record)}))
        self.data.write(record)
        self.at += len(record)

    def close(self) -> tuple[str, int, int]:
        self.data.close()
        self.zip.writestr(INDEX, "\n".join(self.lines))
        self.zip.close()
        self.out.close()
        return self.uri, len(self.lines), self.at


def _locate(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri) if ":" in uri else (pafs.LocalFileSystem(), uri)


# --- jobs ----------------------------------------------------------------------------------------


def write_packages(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """Write a record per row of ``pages`` into packages under ``folder``; returns their manifest (path, records, bytes).

    Of rows with equal payloads of at least 1000 bytes, the one with the largest id (null is smallest)
    is a response and the others are revisits that refer to it; rows that repeat that id are responses
    too. A null payload counts as empty. An empty table gives an empty manifest. Only the named columns
    are read. Every task attempt writes files of its own, and only those of finished tasks are in the
    manifest, so lost executors leave at most files that nothing names.

    Roles are decided on digests; each page's payload is shuffled once, by its id, so a payload that a
    third of the pages share is spread over all tasks.
    """
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.encode(F.coalesce(F.col(payload_col), F.lit("")), "utf-8").alias("payload")
    )
    thin = staged(rows.select("page_id", F.sha1("payload").alias("digest"), F.octet_length("payload").alias("size")).distinct(), "digests")
    last = thin.where(f"size >= {REVISIT_BYTES}").groupBy("digest", "size").agg(F.max("page_id").alias("last"), F.count("*").alias("n")).where("n > 1")
    revisits = (
        thin.join(last, ["digest", "size"])
        .where("page_id is null or page_id < last")
        .select(F.col("page_id").alias("r_page"), F.col("digest").alias("r_digest"), "last")
    )
    digested = rows.withColumn("digest", F.sha1("payload"))
    planned = digested.join(
        revisits.hint("shuffle_hash"), F.col("page_id").eqNullSafe(F.col("r_page")) & (F.col("digest") == F.col("r_digest")), "left"
    ).select("page_id", "url", "payload", "digest", "last")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done, package = [], None
        for batch in batches:
            for page, url, payload, digest, last in zip(*batch.columns):
                body, refers_to = payload.as_py(), last.as_py()
                kind = "response" if refers_to is None else "revisit"
                package = package or _Package(folder)
                record = _record(page.as_py(), url.as_py(), kind, refers_to, len(body), digest.as_py(), body if kind == "response" else b"")
                package.add(page.as_py(), record)
                if package.at >= PACKAGE_BYTES:
                    done.append(package.close())
                    package = None
        if package:
            done.append(package.close())
        if done:
            paths, counts, sizes = zip(*done)
            yield pa.RecordBatch.from_arrays([pa.array(paths), pa.array(counts, pa.int64()), pa.array(sizes, pa.int64())], ["path", "records", "bytes"])

    return staged(planned.mapInArrow(write, MANIFEST), "manifest")


def read_packages(spark: SparkSession, manifest: DataFrame, payloads: bool = True) -> DataFrame:
    """One row per record (see RECORD) of the packages named in ``manifest.path``.

    A first step reads directories and indexes, and deals ranges of consecutive records to tasks; a
    second reads those ranges. ``payloads=False`` leaves the payload out of the result, though every
    response is still read and held against its digest. A damaged package raises ValueError.
    """

    def plan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                fs, place = _locate(path)
                size = fs.get_file_info(place).size
                with fs.open_input_file(place) as f:
                    index, data = _member(f, size, INDEX), _member(f, size, DATA)
                    text = _read(f, index.offset, index.stored).decode()
                entries = [json.loads(line) for line in text.split("\n") if line]
                out = []
                for i in range(0, len(entries), RANGE_RECORDS):
                    part = entries[i : i + RANGE_RECORDS]
                    out.append((path, [data.offset + e["offset"] for e in part], [e["length"] for e in part]))
                if out:
                    paths, offsets, lengths = zip(*out)
                    lists = pa.list_(pa.int64())
                    yield pa.RecordBatch.from_arrays([pa.array(paths), pa.array(offsets, lists), pa.array(lengths, lists)], ["path", "offsets", "lengths"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary())]
        )
        for batch in batches:
            for path, offsets, lengths in zip(*(c.to_pylist() for c in batch.columns)):
                fs, place = _locate(path)
                with fs.open_input_file(place) as f:
                    records = [parse_record(_read(f, o, n)) for o, n in zip(offsets, lengths)]
                if not payloads:
                    for r in records:
                        r["payload"] = None
                yield pa.RecordBatch.from_pylist(records, schema)

    # The rows of the plan are small, what they stand for is not: tasks are counted by bytes of records.
    packages, size = manifest.agg(F.count("*"), F.sum("bytes")).first()
    least = spark.sparkContext.defaultParallelism
    files, tasks = max(1, min(packages, 10 * least)), max(least, (size or 0) // TASK_BYTES + 1)
    ranges = manifest.select("path").repartition(files, F.xxhash64("path")).mapInArrow(plan, "path string, offsets array<long>, lengths array<long>")
    spread = ranges.repartition(tasks, F.xxhash64("path", F.element_at("offsets", 1)))
    return spread.mapInArrow(read, RECORD)
