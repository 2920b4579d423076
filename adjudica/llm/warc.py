"""Web archives: WARC records in ZIP packages, written and read without extraction.

A package is a ZIP file whose members are stored, not compressed: ``archive/data.warc.gz``
with one gzip member per record, and ``indexes/index.cdxj`` with the place of each record.
The reader parses the end record and the central directory (ZIP64 forms included) from the
tail of the file, finds the stored members, reads the index, and then reads only ranges.
Files are opened through Arrow's file systems, so a package may lie on any of them.
"""

from __future__ import annotations

import hashlib
import json
import struct
import uuid
import zlib
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import settled, shared_folder, spread, text_slices

DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
RANGE_BYTES, RANGES_PER_TASK = 4 << 20, 4
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD = "page_id long, url string, record_type string, payload binary, payload_digest string, payload_bytes long, refers_to long"

# ZIP structures: signatures and layouts of the published format (fixed values).
END, END_SIGN = struct.Struct("<4s4H2LH"), b"PK\x05\x06"
LOCATOR, LOCATOR_SIGN = struct.Struct("<4sLQL"), b"PK\x06\x07"
END64, END64_SIGN = struct.Struct("<4sQ2H2L4Q"), b"PK\x06\x06"
ENTRY, ENTRY_SIGN = struct.Struct("<4s6H3L5H2L"), b"PK\x01\x02"
LOCAL, LOCAL_SIGN = struct.Struct("<4s5H3L2H"), b"PK\x03\x04"
FULL_32, FULL_16, ZIP64_EXTRA, STORED = 0xFFFFFFFF, 0xFFFF, 1, 0


@dataclass(frozen=True)
class Member:
    name: str
    start: int
    size: int


def _read(source, start: int, size: int) -> bytes:
    source.seek(start)
    data = source.read(size)
    if len(data) != size:
        raise ValueError(f"archive ends within {size} bytes at {start}")
    return data


def _directory_place(source, total: int) -> tuple[int, int]:
    """Start and size of the central directory."""
    tail = _read(source, max(0, total - END.size - FULL_16), min(total, END.size + FULL_16))
    at = tail.rfind(END_SIGN)
    if at < 0 or at + END.size > len(tail):
        raise ValueError("no end-of-directory record")
    *_, size, start, _ = END.unpack_from(tail, at)
    end = total - len(tail) + at
    if end >= LOCATOR.size and (mark := _read(source, end - LOCATOR.size, LOCATOR.size)).startswith(LOCATOR_SIGN):
        _, _, end64, _ = LOCATOR.unpack(mark)
        sign, *rest = END64.unpack(_read(source, end64, END64.size))
        if sign != END64_SIGN:
            raise ValueError("broken ZIP64 end record")
        size, start = rest[-2:]
    return start, size


def members(source, total: int) -> dict[str, Member]:
    """The stored members of a ZIP file by name, from its central directory."""
    start, size = _directory_place(source, total)
    directory, at, found = _read(source, start, size), 0, {}
    while at < size:
        sign, _, _, flags, method, _, _, _, packed, plain, n_name, n_extra, n_note, _, _, _, header = ENTRY.unpack_from(
            directory, at
        )
        if sign != ENTRY_SIGN:
            raise ValueError("broken directory entry")
        at += ENTRY.size
        name = directory[at : at + n_name].decode("utf-8" if flags & 0x800 else "cp437")
        extra = directory[at + n_name : at + n_name + n_extra]
        at += n_name + n_extra + n_note
        while len(extra) >= 4:
            kind, length = struct.unpack_from("<2H", extra)
            if kind == ZIP64_EXTRA:
                values = iter(struct.unpack_from(f"<{length // 8}Q", extra, 4))
                plain = next(values) if plain == FULL_32 else plain
                packed = next(values) if packed == FULL_32 else packed
                header = next(values) if header == FULL_32 else header
            extra = extra[4 + length :]
        if method != STORED:
            continue  # only stored members can be read by range
        sign, *_, local_name, local_extra = LOCAL.unpack(_read(source, header, LOCAL.size))
        if sign != LOCAL_SIGN:
            raise ValueError(f"broken local header of {name}")
        found[name] = Member(name, header + LOCAL.size + local_name + local_extra, packed)
    return found


def _record_id(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def _page_id(record_id: str) -> int | None:
    number = record_id.removeprefix("<urn:page:").removesuffix(">")
    return None if number == "none" else int(number)


def record_bytes(page_id: int | None, url: str, payload: bytes, digest: str, refers_to: int | None, date: str) -> bytes:
    """One gzip member with a response record, or a revisit record if ``refers_to`` is given."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {_record_id(page_id)}",
        f"WARC-Target-URI: {' '.join(url.split())}",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha1:{digest}",
    ]
    if refers_to is not None:
        lines += [f"WARC-Refers-To: {_record_id(refers_to)}", f"WARC-Profile: {REVISIT}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    pack = zlib.compressobj(1, zlib.DEFLATED, 31)
    return pack.compress("\r\n".join(lines).encode() + block + b"\r\n\r\n") + pack.flush()


def _headers(data: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")[1:]
    return {k.lower(): v for k, _, v in (line.partition(": ") for line in lines)}, rest


def parse_record(packed: bytes) -> tuple:
    """The fields of :data:`RECORD`; digest and size of a response are taken from its payload."""
    warc, rest = _headers(zlib.decompress(packed, 31))
    http, body = _headers(rest[: int(warc["content-length"])])
    stated = warc["warc-payload-digest"].removeprefix("sha1:")
    refers = _page_id(warc["warc-refers-to"]) if "warc-refers-to" in warc else None
    page, url, kind = _page_id(warc["warc-record-id"]), warc["warc-target-uri"], warc["warc-type"]
    if kind == "revisit":
        return page, url, kind, None, stated, int(http["content-length"]), refers
    found = hashlib.sha1(body).hexdigest()
    if found != stated:
        raise ValueError(f"payload of {warc['warc-record-id']} does not match its digest")
    return page, url, kind, body, found, len(body), None


class PackageWriter:
    """One package; records are appended, the index and the directory follow on closing."""

    def __init__(self, path: str):
        system, inner = fs.FileSystem.from_uri(path)
        self.path, self.count, self.at, self.index = path, 0, 0, []
        self.stream = system.open_output_stream(inner)
        self.zip = zipfile.ZipFile(self.stream, "w", zipfile.ZIP_STORED)
        self.data = self.zip.open(zipfile.ZipInfo(DATA), "w", force_zip64=True)

    def add(self, page_id: int | None, url: str, record: bytes) -> None:
        self.data.write(record)
        self.index.append(json.dumps({"page": page_id, "url": url, "offset": self.at, "length": len(record)}))
        self.at += len(record)
        self.count += 1

    def close(self) -> tuple[str, int, int]:
        self.data.close()
        self.zip.writestr(zipfile.ZipInfo(INDEX), "\n".join(self.index).encode())
        self.zip.close()
        self.stream.close()
        return self.path, self.count, self.at


def link_copies(pages: DataFrame, least: int = 1000) -> DataFrame:
    """``page_id, url, payload, digest, refers_to`` per row of ``pages`` (``page_id, url, html``).

    Of equal payloads of at least ``least`` bytes that with the largest id is the response,
    the others refer to it; with rows that repeat that id, all of these are responses. A
    null id is smaller than any other. Smaller payloads refer to nothing. Only payloads that
    occur more than once are joined, the largest groups by broadcast.
    """
    payload = F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    large = F.octet_length("payload") >= least
    facts = rows.groupBy(F.when(large, F.col("digest")).alias("digest")).agg(
        F.count(F.lit(1)).alias("copies"), F.max("page_id").alias("first")
    )
    groups = settled(facts.filter(F.col("digest").isNotNull() & F.col("first").isNotNull()))
    repeated = groups.filter("copies > 1")
    total = groups.agg(F.coalesce(F.sum("copies"), F.lit(0))).first()[0]
    keyed = rows.withColumn("key", F.when(large, F.col("digest")))
    joined = spread(keyed, repeated.withColumnRenamed("digest", "key"), "key", "copies", total, by="page_id", how="left")
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    return joined.select("page_id", "url", "payload", "digest", refers.alias("refers_to"))


def write_packages(
    pages: DataFrame, folder: str, least: int = 1000, package_bytes: int = 1 << 30, date: str = "1970-01-01T00:00:00Z"
) -> DataFrame:
    """``path, records, data_bytes`` of the packages that hold a record per row of ``pages``.

    Null html is an empty payload, a null url an empty one; an empty table writes nothing.
    Further columns of ``pages`` are not read. Each task attempt writes files under names of
    its own; only those of attempts that succeeded are named in the result, which is settled.
    """
    folder = folder.rstrip("/")
    folder = folder if "://" in folder or folder.startswith("file:") else f"file://{folder}"
    system, inner = fs.FileSystem.from_uri(folder)
    system.create_dir(inner, recursive=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        package, done = None, []
        for batch in text_slices(batches, "payload"):
            for page_id, url, payload, digest, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                if package is None:
                    package = PackageWriter(f"{folder}/{uuid.uuid4().hex}.wacz")
                package.add(page_id, url, record_bytes(page_id, url, payload, digest, refers_to, date))
                if package.at >= package_bytes:
                    done.append(package.close())
                    package = None
        if package is not None:
            done.append(package.close())
        if done:
            yield pa.RecordBatch.from_arrays(list(map(pa.array, zip(*done))), ["path", "records", "data_bytes"])

    return settled(link_copies(pages, least).mapInArrow(run, "path string, records long, data_bytes long"))


def read_packages(paths: DataFrame) -> DataFrame:
    """The records of the packages in column ``path``, as :data:`RECORD`.

    Indexes are read first and give ranges of about 4 MB, which are dealt out evenly and
    read by seeking; a package is never read whole. A revisit has no payload; its digest
    and size come from its headers. A package without records gives no rows.
    """

    def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                system, inner = fs.FileSystem.from_uri(path)
                with system.open_input_file(inner) as source:
                    held = members(source, source.size())
                    index, data = held[INDEX], held[DATA]
                    lines = _read(source, index.start, index.size).splitlines()
                starts: list[int] = []
                parts: list[list[int]] = []
                for line in map(json.loads, lines):
                    if not parts or sum(parts[-1]) >= RANGE_BYTES:
                        starts.append(data.start + line["offset"])
                        parts.append([])
                    parts[-1].append(line["length"])
                if parts:
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([path] * len(parts)), pa.array(starts, pa.int64()),
                            pa.array(parts, pa.list_(pa.int64())),
                        ],
                        ["path", "start", "lengths"],
                    )

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start, lengths in zip(*(c.to_pylist() for c in batch.columns)):
                system, inner = fs.FileSystem.from_uri(path)
                with system.open_input_file(inner) as source:
                    data = _read(source, start, sum(lengths))
                rows, at = [], 0
                for length in lengths:
                    rows.append(parse_record(data[at : at + length]))
                    at += length
                kinds = [pa.int64(), pa.string(), pa.string(), pa.binary(), pa.string(), pa.int64(), pa.int64()]
                names = [part.split()[0] for part in RECORD.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    places = settled(paths.select("path").mapInArrow(ranges, "path string, start long, lengths array<long>"))
    tasks = max(1, places.count() // RANGES_PER_TASK)
    return places.repartition(tasks, "path", "start").mapInArrow(records, RECORD)


def archive_round_trip(pages: DataFrame, least: int = 1000) -> DataFrame:
    """``pages`` written as packages in a new folder below the shared one, and read back."""
    folder = f"{shared_folder(pages.sparkSession)}/packages-{uuid.uuid4().hex[:12]}"
    return read_packages(write_packages(pages, folder, least))
