"""WARC records in ZIP packages (stored members, as web archive collections use them).

Writing: every page is a gzip member of its own in ``archive/data.warc.gz``, followed by the index
``indexes/index.cdxj`` and ``datapackage.json``. Of pages with equal payloads one is a response, the
others are revisits that name it and carry no payload. A task starts a new package beyond
``archive_bytes``, so neither a task nor its index grows with the input.

Reading never unpacks a package: the end record (and its ZIP64 form) leads to the central
directory, that to the members, the index to the records. Spans of records of about ``span_bytes``
are dealt out over the cluster and each is one ranged read. A package without an index is scanned.

Defined results: a NULL html is an empty payload, NULL urls are left out of the record; a NULL
page_id is written ``null`` and sorts below all numbers; rows that share page_id and payload with the
response are responses as well; an empty table gives no package and no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import json
import struct
import zipfile
import zlib
from collections.abc import Iterator
from fnmatch import fnmatch
from urllib.parse import quote, urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm import files
from basketry.operators.scale import attach_by_key
from basketry.session import cut, stage

ARCHIVE_BYTES = 64 << 20
SPAN_BYTES = 4 << 20
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2000-01-01T00:00:00Z"
ALL_ONES = 0xFFFFFFFF


def base32_sha1(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


# Writing


def _id(page_id: int | None) -> str:
    return f"<urn:page:{'null' if page_id is None else page_id}>"


def _page(uri: str | None) -> int | None:
    text = (uri or "").strip().removeprefix("<urn:page:").removesuffix(">")
    return int(text) if text.lstrip("-").isdigit() else None


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC/1.1 record; a revisit keeps the HTTP header with the length of the full payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    fields = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", _id(page_id)), ("WARC-Date", DATE)]
    if url is not None:
        fields.append(("WARC-Target-URI", quote(url, safe="!#$%&'()*+,/:;=?@[]~")))
    fields.append(("WARC-Payload-Digest", f"sha1:{digest}"))
    if revisit:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", _id(refers_to))]
    fields += [("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{name}: {value}\r\n" for name, value in fields) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def sort_key(url: str | None) -> str:
    """Host labels in reverse, then the path, as web archive indexes are sorted."""
    try:
        parts = urlsplit(url or "")
        host = ",".join(reversed((parts.hostname or "").split(".")))
    except ValueError:
        return quote(url or "", safe="")
    return quote(f"{host}){parts.path}" + (f"?{parts.query}" if parts.query else ""), safe="!$&'()*+,/:;=?@~")


class Package:
    """A ZIP package that is written front to back, without seeking."""

    def __init__(self, path: str):
        self.path, self.stream = path, files.create(path)
        self.zip = zipfile.ZipFile(self.stream, "w", zipfile.ZIP_STORED, allowZip64=True)
        self.data = self.zip.open("archive/data.warc.gz", "w", force_zip64=True)
        self.size, self.lines = 0, []

    def add(self, url: str | None, digest: str, raw: bytes) -> None:
        packed = zlib.compress(raw, 6, 31)
        self.data.write(packed)
        entry = {"url": url, "digest": f"sha1:{digest}", "filename": "data.warc.gz", "offset": self.size, "length": len(packed)}
        self.lines.append(f"{sort_key(url)} {DATE[:19].translate({45: None, 58: None, 84: None})} {json.dumps(entry)}\n")
        self.size += len(packed)

    def close(self) -> int:
        self.data.close()
        self.zip.writestr("indexes/index.cdxj", "".join(sorted(self.lines)))
        self.zip.writestr("datapackage.json", json.dumps({"profile": "data-package", "records": len(self.lines)}))
        self.zip.close()
        self.stream.close()
        return len(self.lines)


def deduplicated(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """(page_id, url, payload, digest, refers_to, revisit): which pages revisit which.

    Only (id, digest) meet in groups; payloads are dealt by (id, digest), which no group can make hot.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        "url",
        F.coalesce(F.col("html").cast("binary"), F.lit(b"")).alias("payload"),
    ).withColumn("digest", F.sha1("payload"))
    keys = cut(rows.filter(F.octet_length("payload") >= least_bytes).select("page_id", "digest").distinct())
    groups = keys.groupBy("digest").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n")).filter("n > 1")
    revisits = attach_by_key(keys, groups, "digest", "n").filter("not (page_id <=> refers_to)")
    known = revisits.select(F.col("page_id").alias("p"), F.col("digest").alias("d"), "refers_to")
    joined = rows.join(known, F.col("page_id").eqNullSafe(F.col("p")) & (F.col("digest") == F.col("d")), "left")
    return joined.select("page_id", "url", "payload", "digest", "refers_to", F.col("d").isNotNull().alias("revisit"))


def write_packages(records: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write records as from ``deduplicated``; one row (path, n_records) per package."""
    folder = files.qualified(records.sparkSession, folder)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        package = None

        def done(package: Package) -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"path": [package.path], "n_records": pa.array([package.close()], pa.int64())})

        for batch in batches:
            for k in range(len(batch)):
                page_id, url, payload, digest, refers_to, revisit = (column[k].as_py() for column in batch.columns)
                package = package or Package(files.new_file(folder, "pages", ".wacz"))
                name = base32_sha1(bytes.fromhex(digest))
                package.add(url, name, record(page_id, url, payload, name, refers_to, revisit))
                if package.size >= archive_bytes:
                    yield done(package)
                    package = None
        if package:
            yield done(package)

    return stage(records.mapInArrow(write, "path string, n_records long"), "packages")


# Reading


def members(file) -> dict[str, tuple[int, int]]:
    """{name: (offset of its data, length)} of the stored members, from the central directory."""
    size = file.size()
    tail_at = max(0, size - 65_557)
    tail = file.read_at(size - tail_at, tail_at)
    end = tail.rfind(b"PK\x05\x06")
    if end < 0:
        raise ValueError("no end of central directory: not a ZIP package")
    count, length, start = struct.unpack_from("<HLL", tail, end + 10)
    if ALL_ONES in (length, start) or count == 0xFFFF:
        locator = file.read_at(20, tail_at + end - 20)
        if locator[:4] != b"PK\x06\x07":
            raise ValueError("the ZIP64 locator is missing")
        wide = file.read_at(56, struct.unpack_from("<Q", locator, 8)[0])
        if wide[:4] != b"PK\x06\x06":
            raise ValueError("the ZIP64 end record is missing")
        count, length, start = struct.unpack_from("<QQQ", wide, 32)
    directory, at, found = file.read_at(length, start), 0, {}
    for _ in range(count):
        if directory[at : at + 4] != b"PK\x01\x02":
            raise ValueError("damaged central directory")
        method = struct.unpack_from("<H", directory, at + 10)[0]
        packed, whole, n_name, n_extra, n_comment = struct.unpack_from("<LLHHH", directory, at + 20)
        header = struct.unpack_from("<L", directory, at + 42)[0]
        name = directory[at + 46 : at + 46 + n_name].decode()
        extra, here = directory[at + 46 + n_name : at + 46 + n_name + n_extra], 0
        while here + 4 <= len(extra):
            kind, n = struct.unpack_from("<HH", extra, here)
            if kind == 1:  # ZIP64: the fields that are all ones, in this order
                wide = iter(struct.unpack_from(f"<{n // 8}Q", extra, here + 4))
                whole = next(wide) if whole == ALL_ONES else whole
                packed = next(wide) if packed == ALL_ONES else packed
                header = next(wide) if header == ALL_ONES else header
            here += 4 + n
        if method == 0:
            local = file.read_at(30, header)
            found[name] = (header + 30 + sum(struct.unpack_from("<HH", local, 26)), packed)
        elif fnmatch(name, "archive/*"):
            raise ValueError(f"{name} is compressed; archives must be stored")
        at += 46 + n_name + n_extra + n_comment
    return found


def _lines(file, at: int, length: int, chunk: int = 1 << 20) -> Iterator[bytes]:
    rest = b""
    for start in range(at, at + length, chunk):
        *lines, rest = (rest + file.read_at(min(chunk, at + length - start), start)).split(b"\n")
        yield from lines
    if rest:
        yield rest


def _scan(file, at: int, length: int, chunk: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """(offset, length) of the gzip members, found by reading through them."""
    begun, unzip = at, zlib.decompressobj(31)
    for start in range(at, at + length, chunk):
        raw = file.read_at(min(chunk, at + length - start), start)
        end = start + len(raw)
        while raw:
            unzip.decompress(raw)
            raw = b""
            if unzip.eof:
                raw = unzip.unused_data
                yield begun, end - len(raw) - begun
                begun, unzip = end - len(raw), zlib.decompressobj(31)


def locate_records(file) -> list[tuple[int, int]]:
    """(offset, length) in the package of every record, in file order."""
    found = members(file)
    archives = {name.removeprefix("archive/"): place for name, place in found.items() if fnmatch(name, "archive/*.warc*")}
    records, indexed = [], set()
    for name, (at, length) in found.items():
        if fnmatch(name, "indexes/*.cdx*") and not name.endswith(".gz"):
            for line in _lines(file, at, length):
                entry = json.loads(line[line.index(b"{") :])
                records.append((archives[entry["filename"]][0] + int(entry["offset"]), int(entry["length"])))
                indexed.add(entry["filename"])
    for name, (at, length) in archives.items():
        if name not in indexed:
            records += _scan(file, at, length)
    return sorted(records)


def _fields(lines: list[bytes]) -> dict[str, str]:
    pairs = (line.decode("utf-8", "replace").partition(":") for line in lines)
    return {name.strip().lower(): value.strip() for name, _, value in pairs}


def parse(raw: bytes) -> dict:
    """The record in the bytes of one member."""
    if raw[:2] == b"\x1f\x8b":
        raw = zlib.decompress(raw, 31)
    head, _, body = raw.partition(b"\r\n\r\n")
    fields = _fields(head.split(b"\r\n")[1:])
    block = body[: int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    digest = fields.get("warc-payload-digest", "").removeprefix("sha1:")
    kind = fields.get("warc-type")
    size = len(payload)
    if kind == "revisit":
        size = int(_fields(http.split(b"\r\n")[1:]).get("content-length", 0))
    elif digest != base32_sha1(hashlib.sha1(payload).digest()):
        raise ValueError(f"payload of {fields.get('warc-record-id')} does not have the digest of its header")
    return {
        "page_id": _page(fields.get("warc-record-id")),
        "url": fields.get("warc-target-uri"),
        "payload_bytes": size,
        "payload_digest": digest,
        "record_type": kind,
        "refers_to": _page(fields.get("warc-refers-to")),
        "payload": payload if kind == "response" else None,
    }


READ = {
    "page_id": pa.int64(), "url": pa.string(), "payload_bytes": pa.int64(), "payload_digest": pa.string(),
    "record_type": pa.string(), "refers_to": pa.int64(), "payload": pa.binary(),
}
NAMES = {pa.int64(): "long", pa.string(): "string", pa.binary(): "binary"}


def read_packages(packages: DataFrame, columns: list[str] | None = None, span_bytes: int = SPAN_BYTES) -> DataFrame:
    """One row per record of the packages at ``path``; ``columns`` of READ, all by default."""
    columns = columns or list(READ)

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch["path"].to_pylist():
                with files.open_ranges(path) as file:
                    spans: list[list[tuple[int, int]]] = []
                    for at, length in locate_records(file):
                        last = spans[-1] if spans else None
                        if last and last[-1][0] + last[-1][1] == at and at + length - last[0][0] <= span_bytes:
                            last.append((at, length))
                        else:
                            spans.append([(at, length)])
                yield pa.RecordBatch.from_pydict(
                    {
                        "path": pa.array([path] * len(spans), pa.string()),
                        "start": pa.array([s[0][0] for s in spans], pa.int64()),
                        "lengths": pa.array([[n for _, n in s] for s in spans], pa.list_(pa.int64())),
                    }
                )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start, lengths in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                with files.open_ranges(path) as file:
                    raw = file.read_at(sum(lengths), start)
                rows, at = [], 0
                for length in lengths:
                    rows.append(parse(raw[at : at + length]))
                    at += length
                yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], READ[c]) for c in columns], columns)

    tasks = int(packages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = packages.select("path").repartition(tasks, "path")
    spans = spread.mapInArrow(locate, "path string, start long, lengths array<long>").repartition(tasks, "path", "start")
    return spans.mapInArrow(read, ", ".join(f"{c} {NAMES[READ[c]]}" for c in columns))
