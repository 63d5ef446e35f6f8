"""WARC packages: round trips, revisits by plain grouping, and the directory forms of ZIP."""

import base64
import hashlib
import zipfile

import pytest

from basketry.llm import files, warc
from basketry.llm.queries import QUERIES


def plain(rows):
    """Expected (page_id, bytes, digest, type, refers_to)."""
    best = {}
    for page, html in rows:
        best[html or ""] = max(best.get(html or "", -(2**63)), -(2**63) if page is None else page)
    out = []
    for page, html in rows:
        raw = (html or "").encode()
        top = best[html or ""]
        revisit = (-(2**63) if page is None else page) != top
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        out.append((page, len(raw), digest, "revisit" if revisit else "response", top if revisit else None))
    return sorted(out, key=str)


ROWS = [(1, "a"), (2, "b"), (3, "a"), (4, None), (5, ""), (-6, "a"), (None, "a"), (None, "c"), (7, "é\r\n\r\n" * 40_000), (8, "d"), (8, "d"), (8, "e")]


@pytest.fixture(scope="module")
def pages(spark):
    urls = [None, "", "http://[bad", "http://a.b/ü?q=1#x\r\nWARC-Type: x", *[f"https://h{i}.example.com/p" for i in range(20)]]
    rows = [(p, urls[i], h, "z", 1) for i, (p, h) in enumerate(ROWS)]
    return spark.createDataFrame(rows, "page_id long, url string, html string, digest string, revisit int").repartition(3)


def result(df):
    return sorted((tuple(r) for r in df.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=str)


@pytest.mark.parametrize("archive_bytes", [1, warc.ARCHIVE_BYTES])
def test_round_trip(pages, tmp_path, archive_bytes):
    packages = warc.write_packages(warc.deduplicated(pages), str(tmp_path), archive_bytes)
    assert packages.agg({"n_records": "sum"}).first()[0] == len(ROWS)
    read = warc.read_packages(packages, span_bytes=300)
    assert result(read) == plain(ROWS)
    kept = {r["payload_digest"]: bytes(r["payload"]).decode() for r in read.collect() if r["record_type"] == "response"}
    assert set(kept.values()) == {h or "" for _, h in ROWS}
    assert "ü" not in "".join(r["url"] or "" for r in read.collect())


def test_small_payloads_stay_responses(pages, tmp_path):
    read = warc.read_packages(warc.write_packages(warc.deduplicated(pages, least_bytes=2), str(tmp_path)))
    assert {r["record_type"] for r in read.collect()} == {"response"}


def test_empty_table(pages, tmp_path):
    packages = warc.write_packages(warc.deduplicated(pages.filter("false")), str(tmp_path))
    assert packages.count() == 0 and warc.read_packages(packages).count() == 0


def raw_record(k):
    payload = f"page {k}".encode()
    return warc.record(k, f"http://x/{k}", payload, warc.base32_sha1(hashlib.sha1(payload).digest()), None, False)


@pytest.mark.parametrize("extra", [0, 66_000])
def test_zip64_directory_and_missing_index(spark, tmp_path, extra):
    """More than 65,535 members need the ZIP64 end record; without an index members are scanned."""
    import gzip

    path = tmp_path / "other.wacz"
    packed = [gzip.compress(raw_record(k)) for k in range(50)]
    with zipfile.ZipFile(path, "w", zipfile.ZIP_STORED) as z:
        for k in range(extra):
            z.writestr(f"x/{k}", b"")
        with z.open("archive/data.warc.gz", "w", force_zip64=True) as member:
            member.write(b"".join(packed))
        z.comment = b"a comment"
    file = files.open_ranges(str(path))
    at, length = warc.members(file)["archive/data.warc.gz"]
    assert file.read_at(length, at) == b"".join(packed)
    assert [n for _, n in warc.locate_records(file)] == list(map(len, packed))
    read = warc.read_packages(spark.createDataFrame([(str(path),)], "path string"))
    assert sorted(r["page_id"] for r in read.collect()) == list(range(50))


def test_zip64_sizes_in_the_directory(tmp_path):
    """Fields of all ones are taken from the ZIP64 extra field."""
    path = tmp_path / "a.zip"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_STORED) as z:
        z.writestr("archive/a.warc", b"hello")
    raw = bytearray(path.read_bytes())
    at = raw.index(b"PK\x01\x02")
    wide = b"\x01\x00\x18\x00" + (5).to_bytes(8, "little") * 2 + (0).to_bytes(8, "little")
    raw[at + 20 : at + 28] = b"\xff" * 8
    raw[at + 42 : at + 46] = b"\xff" * 4
    raw[at + 30 : at + 32] = len(wide).to_bytes(2, "little")
    name_end = at + 46 + len("archive/a.warc")
    raw[name_end:name_end] = wide
    end = raw.index(b"PK\x05\x06")
    raw[end + 12 : end + 16] = (end - at).to_bytes(4, "little")
    path.write_bytes(raw)
    file = files.open_ranges(str(path))
    at, length = warc.members(file)["archive/a.warc"]
    assert file.read_at(length, at) == b"hello"


def test_damage_is_reported(tmp_path):
    path = tmp_path / "bad.zip"
    path.write_bytes(b"no zip")
    with pytest.raises(ValueError, match="end of central directory"):
        warc.members(files.open_ranges(str(path)))
    with pytest.raises(ValueError, match="digest"):
        warc.parse(raw_record(1).replace(b"page 1\r\n", b"page 2\r\n"))


def test_query_equals_plain_grouping(spark, sf):
    rows = [(r["page_id"], r["html"]) for r in spark.read.parquet(f"{sf}/pages.parquet").collect()]
    assert result(QUERIES["op1_warc_zip"](spark, sf)) == plain(rows)
