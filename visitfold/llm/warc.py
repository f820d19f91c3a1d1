"""WARC records in ZIP packages, read by ranges.

The writer packs gzipped records, stored, into ZIP files with an index member. The reader
parses a package's end record (ZIP64 too) and central directory, finds the stored record
members and their indexes, and tasks fetch runs of records with one range read each. No
package is extracted or read whole.

Files are reached by ``pyarrow.fs``, so the folder may be a path that all executors share or
a store's URI. Names are new for each attempt and only the written manifest counts, so an
attempt that was lost leaves a file nobody reads.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitfold.llm.common import settle, utf8
from visitfold.sources.scratch import scratch_dir

#: Smaller payloads are never revisits.
LEAST_REVISIT_BYTES = 1000
ARCHIVE_BYTES = 64 << 20
#: Records fetched by one range read.
RUN_BYTES = 4 << 20
#: Bytes that a task reads before there are more tasks than the cluster runs at once.
TASK_BYTES = 1 << 30
DATE = "2026-01-01T00:00:00Z"
RECORDS, INDEX = "archive/data.warc.gz", "indexes/index.cdx"

# Fixed values of the ZIP format: signatures, and the numbers that point to ZIP64 fields.
END, END64, END64_AT, ENTRY, LOCAL = b"PK\5\6", b"PK\6\6", b"PK\6\7", b"PK\1\2", b"PK\3\4"
FULL16, FULL32 = 0xFFFF, 0xFFFFFFFF


def tagged(pages: DataFrame, page_id: str, url: str, html: str, least: int) -> DataFrame:
    """page_id, url, payload, digest, size, refers_to: what each record is written from.

    Of equal payloads (same length and SHA-1) of at least ``least`` bytes the largest page_id
    is the response. Groups are counted without the payloads.
    """
    coded = pages.select(
        pages[f"`{page_id}`"].cast("long").alias("page_id"),
        pages[f"`{url}`"].cast("string").alias("url"),
        utf8(pages[f"`{html}`"]).alias("payload"),
    ).select("*", F.sha1("payload").alias("digest"), F.octet_length("payload").cast("long").alias("size"))
    keepers = (
        coded.where(F.col("size") >= least)
        .groupBy("digest", "size")
        .agg(F.max("page_id").alias("keeper"), F.count("*").alias("copies"))
        .where("copies > 1")
        .select("digest", "size", "keeper")
    )
    keepers = settle(keepers, "keepers")  # a table of its own, so that the join splits a hot payload
    revisits = F.col("keeper").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("keeper"))
    return coded.join(keepers, ["digest", "size"], "left").select(
        *("page_id", "url", "payload", "digest", "size"),
        F.when(revisits, F.col("keeper")).alias("refers_to"),
    )


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, size: int, refers_to: int | None) -> bytes:
    """One gzipped WARC record; a revisit keeps the HTTP headers and not the payload."""
    coded = base64.b32encode(bytes.fromhex(digest)).decode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    body = http + payload if refers_to is None else http
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{coded}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(body)}",
    ]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if refers_to is not None:
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        head.append(f"WARC-Refers-To: <urn:page:{refers_to}>")
    raw = "\r\n".join([*head, "", ""]).encode() + body + b"\r\n\r\n"
    return zlib.compress(raw, 1, 31)


def _fields(block: bytes) -> dict[str, str]:
    lines = block.decode().split("\r\n")[1:]
    return {name.lower(): value.strip() for name, _, value in (line.partition(":") for line in lines)}


def _page(urn: str) -> int | None:
    number = urn.removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def parse(raw: bytes) -> dict:
    """A gzipped record as page_id, url, record_type, payload, payload_bytes, payload_digest, refers_to."""
    head, _, rest = zlib.decompress(raw, 31).partition(b"\r\n\r\n")
    fields = _fields(head)
    block = rest[: int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    digest = base64.b32decode(fields["warc-payload-digest"].removeprefix("sha1:")).hex()
    size = int(_fields(http)["content-length"])
    kind = fields["warc-type"]
    if kind == "response" and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"record {fields['warc-record-id']} does not match its digest")
    return {
        "page_id": _page(fields["warc-record-id"]),
        "url": fields.get("warc-target-uri"),
        "record_type": kind,
        "payload": payload if kind == "response" else None,
        "payload_bytes": size,
        "payload_digest": digest,
        "refers_to": _page(fields["warc-refers-to"]) if kind == "revisit" else None,
    }


class _Package:
    """A ZIP file under way: records go out at once, the index when it is closed."""

    def __init__(self, files: fs.FileSystem, path: str) -> None:
        self.path, self.lines, self.size = path, [], 0
        self.out = files.open_output_stream(path)
        self.zip = zipfile.ZipFile(self.out, "w", zipfile.ZIP_STORED)
        self.member = self.zip.open(RECORDS, "w", force_zip64=True)

    def add(self, raw: bytes) -> None:
        self.member.write(raw)
        self.lines.append(f"{self.size} {len(raw)}\n")
        self.size += len(raw)

    def close(self) -> None:
        self.member.close()
        self.zip.writestr(INDEX, "".join(self.lines))
        self.zip.close()
        self.out.close()


def write_archives(
    pages: DataFrame,
    folder: str | None = None,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
    least_revisit_bytes: int = LEAST_REVISIT_BYTES,
    archive_bytes: int = ARCHIVE_BYTES,
) -> DataFrame:
    """Write a record for every row; the manifest: archive (URI or path), records, bytes.

    Null html is an empty payload; a null id or url is left out of the record. Equal payloads
    with the largest id, also of rows that repeat it, are responses; if all ids are null,
    all are. Other columns are not written. An empty table writes no archive.
    """
    folder = folder or scratch_dir(pages.sparkSession, "warc")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = fs.FileSystem.from_uri(folder)
        open_ = None
        for batch in batches:
            if batch.num_rows and open_ is None:
                files.create_dir(root, recursive=True)
            columns = [batch.column(name) for name in names]
            for i in range(batch.num_rows):
                if open_ is None:
                    name = f"{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.wacz"
                    open_ = _Package(files, f"{root}/{name}")
                open_.add(record(*(column[i].as_py() for column in columns)))
                if open_.size >= archive_bytes:
                    yield from closed(open_)
                    open_ = None
        if open_ is not None:
            yield from closed(open_)

    def closed(package: _Package) -> Iterator[pa.RecordBatch]:
        package.close()
        name = f"{folder.rstrip('/')}/{package.path.rpartition('/')[2]}"
        yield pa.RecordBatch.from_pydict(
            {"archive": [name], "records": [len(package.lines)], "bytes": [package.size]}
        )

    names = ["page_id", "url", "payload", "digest", "size", "refers_to"]
    rows = tagged(pages, page_id, url, html, least_revisit_bytes).select(*names)
    return settle(rows.mapInArrow(work, "archive string, records long, bytes long"), "warc-manifest")


@dataclass(frozen=True)
class Member:
    name: str
    method: int
    start: int
    size: int


def _read(file: pa.NativeFile, start: int, size: int) -> bytes:
    file.seek(start)
    raw = file.read(size)
    if len(raw) != size:
        raise ValueError("the archive ends early")
    return raw


def directory(file: pa.NativeFile) -> list[Member]:
    """Members of a ZIP package, from its end record and central directory."""
    length = file.size()
    tail = _read(file, max(0, length - 22 - FULL16), min(length, 22 + FULL16))
    at = tail.rfind(END)
    if at < 0:
        raise ValueError("no end record: not a ZIP package")
    entries, size, start = struct.unpack("<HII", tail[at + 10 : at + 20])
    if FULL16 == entries or FULL32 in (size, start):
        place = length - len(tail) + at - 20
        if place >= 0 and (found := _read(file, place, 20))[:4] == END64_AT:
            end = _read(file, struct.unpack("<Q", found[8:16])[0], 56)
            if end[:4] != END64:
                raise ValueError("no ZIP64 end record where it should be")
            entries, size, start = struct.unpack("<QQQ", end[32:56])
    raw, at, members = _read(file, start, size), 0, []
    for _ in range(entries):
        if raw[at : at + 4] != ENTRY:
            raise ValueError("the central directory is damaged")
        method, packed, plain = struct.unpack("<10xH8xII", raw[at : at + 28])
        names, extras, notes = struct.unpack("<HHH", raw[at + 28 : at + 34])
        (local,) = struct.unpack("<I", raw[at + 42 : at + 46])
        name = raw[at + 46 : at + 46 + names].decode("utf-8", "replace")
        more = _wide(raw[at + 46 + names : at + 46 + names + extras])
        plain, packed, local = (
            more.pop(0) if value == FULL32 and more else value for value in (plain, packed, local)
        )
        members.append((name, method, local, packed))
        at += 46 + names + extras + notes
    return [Member(name, method, _data(file, local), packed) for name, method, local, packed in members]


def _wide(extra: bytes) -> list[int]:
    """64-bit numbers of the ZIP64 field, in the order size, packed size, place."""
    at = 0
    while at + 4 <= len(extra):
        kind, size = struct.unpack("<HH", extra[at : at + 4])
        if kind == 1:
            return list(struct.unpack(f"<{size // 8}Q", extra[at + 4 : at + 4 + size // 8 * 8]))
        at += 4 + size
    return []


def _data(file: pa.NativeFile, local: int) -> int:
    head = _read(file, local, 30)
    if head[:4] != LOCAL:
        raise ValueError("a member is not where the directory says")
    names, extras = struct.unpack("<HH", head[26:30])
    return local + 30 + names + extras


def record_places(file: pa.NativeFile) -> list[tuple[int, int]]:
    """Place and length of every record, from indexes or, without one, from the records."""
    members = directory(file)
    places = []
    for member in members:
        if not member.name.endswith(".warc.gz"):
            continue
        if member.method:
            raise ValueError(f"{member.name} is not stored, so it can't be read by ranges")
        stem = member.name.rpartition("/")[2].removesuffix(".warc.gz")
        near = member.name.removesuffix(f"archive/{stem}.warc.gz") + "indexes/"
        index = next((m for m in members if m.name in (near + "index.cdx", near + stem + ".cdx")), None)
        if index is None or sum(m.name.endswith(".warc.gz") for m in members) > 1 and index.name.endswith("index.cdx"):
            places += _walk(file, member)
            continue
        raw = _read(file, index.start, index.size)
        lines = (raw if not index.method else zlib.decompress(raw, -15)).decode().splitlines()
        places += [(member.start + int(a), int(n)) for a, n in (line.split()[:2] for line in lines)]
    return places


def _walk(file: pa.NativeFile, member: Member) -> Iterator[tuple[int, int]]:
    """Records of a member without an index, by following its gzip members."""
    at, end = member.start, member.start + member.size
    while at < end:
        unzip, seen = zlib.decompressobj(31), 0
        while not unzip.eof:
            raw = _read(file, at + seen, min(1 << 20, end - at - seen))
            if not raw:
                raise ValueError("a record is cut off")
            unzip.decompress(raw)
            seen += len(raw) - len(unzip.unused_data)
        yield at, seen
        at += seen


def read_archives(spark: SparkSession, archives: DataFrame, payload: bool = True) -> DataFrame:
    """Records of the packages named in column ``archive``, with their full payload's figures.

    page_id, url, record_type (response or revisit), payload (null for revisits; left out
    without ``payload``), payload_bytes, payload_digest (hex SHA-1), refers_to. First the
    packages' directories are read, a row for each run of records; then runs are dealt out
    and fetched. A response whose payload does not match its digest is an error.
    """

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column("archive").to_pylist():
                files, path = fs.FileSystem.from_uri(name)
                starts, lengths = [], []
                with files.open_input_file(path) as file:
                    for start, length in sorted(record_places(file)):
                        last = starts and starts[-1] + sum(lengths[-1])
                        if starts and last == start and last - starts[-1] < RUN_BYTES:
                            lengths[-1].append(length)
                        else:
                            starts.append(start)
                            lengths.append([length])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([name] * len(starts), pa.string()),
                        pa.array(starts, pa.int64()),
                        pa.array(lengths, pa.list_(pa.int64())),
                    ],
                    names=["archive", "start", "lengths"],
                )

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                files, path = fs.FileSystem.from_uri(row["archive"])
                with files.open_input_file(path) as file:
                    raw = _read(file, row["start"], sum(row["lengths"]))
                at, found = 0, []
                for length in row["lengths"]:
                    found.append(parse(raw[at : at + length]))
                    at += length
                yield pa.RecordBatch.from_arrays(
                    [pa.array([one[f.name] for one in found], f.type) for f in kinds], schema=kinds
                )

    columns = [
        ("page_id", pa.int64()),
        ("url", pa.string()),
        ("record_type", pa.string()),
        ("payload", pa.binary()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("refers_to", pa.int64()),
    ]
    kinds = pa.schema([column for column in columns if payload or column[0] != "payload"])
    sql = {pa.int64(): "long", pa.string(): "string", pa.binary(): "binary"}
    schema = ", ".join(f"{f.name} {sql[f.type]}" for f in kinds)
    names = archives.select("archive").where("archive IS NOT NULL")
    dealt = names.repartition(tasks(spark, names.count(), 0), "archive")
    found = settle(dealt.mapInArrow(runs, "archive string, start long, lengths array<long>"), "warc-runs")
    total = F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda sum_, one: sum_ + one))
    held = found.agg(F.count("*").alias("n"), total.alias("bytes")).first()
    dealt = found.repartition(tasks(spark, held["n"], held["bytes"] or 0), "archive", "start")
    return dealt.mapInArrow(fetch, schema)


def tasks(spark: SparkSession, count: int, size: int, task_bytes: int = TASK_BYTES) -> int:
    """Tasks for so many pieces of work that read so many bytes.

    As many as the cluster runs at once; more only where each would read over ``task_bytes``:
    100,000 for 100 TB, and not one for each run of records.
    """
    wanted = max(spark.sparkContext.defaultParallelism, -(-size // task_bytes))
    return max(1, min(count, wanted))
