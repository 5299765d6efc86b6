"""Archives: exact round trips, bounded reading, and damage that is found."""

import gzip
import hashlib
import io

import pytest

from reclink.llm import warc
from reclink.llm.warc import WarcError, archive_round_trip, read_archive, read_archives, write_archives, write_record
from reclink.session import scratch

SCHEMA = "page_id long, url string, html string, digest string, first long, path string, n long"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "d", 1, "p", 2) for r in rows], SCHEMA).repartition(3)


def plain(rows):
    first = {}
    for page_id, _, html in rows:
        data = (html or "").encode()
        if len(data) >= 100 and page_id is not None:
            first[data] = min(page_id, first.get(data, page_id))
    out = []
    for page_id, _, html in rows:
        data = (html or "").encode()
        least = first.get(data)
        again = least is not None and least != page_id
        out.append((page_id, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", least if again else None))
    return sorted(out, key=str)


def test_round_trip_of_the_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    rows = [(r["page_id"], r["url"], r["html"]) for r in table.collect()]
    assert sorted(map(tuple, archive_round_trip(table).collect()), key=str) == plain(rows)


def test_edge_cases(spark, monkeypatch):
    same, wide = "x" * 99, "é" * 50
    rows = [(5, "http://a/ b\r\nX: y", wide), (3, None, wide), (4, "u", wide), (3, None, wide), (None, "n", wide)]
    rows += [(6, "u", same), (7, "u", same), (8, "u", None), (9, "u", ""), (10, "u", "\r\n\r\n" * 100), (11, "u", "a\x00b" * 300_000)]
    rows += [(None, "u", "only null ids " * 20), (None, "v", "only null ids " * 20)]
    frame = pages(spark, rows)
    assert sorted(map(tuple, archive_round_trip(frame).collect()), key=str) == plain(rows)
    folder = scratch(spark, "warc")
    archives = write_archives(frame, folder, archive_bytes=300)
    assert archives.count() > 3 and sum(r["records"] for r in archives.collect()) == len(rows)
    kept = read_archives(archives, folder, keep=True).collect()
    assert sorted(map(str, (r["payload"].decode() for r in kept if r["record_type"] == "response"))) == sorted(
        html or "" for (page_id, _, html), r in zip(rows, rows) if (page_id, len((html or "").encode())) in {(p, n) for p, n, _, k, _ in plain(rows) if k == "response"}
    )
    assert archive_round_trip(frame.limit(0)).count() == 0


def archive(*payloads):
    return b"".join(write_record("response", i, f"http://x/{i}", p) for i, p in enumerate(payloads))


class Trickle(io.RawIOBase):
    """A file that gives a few bytes at a time."""

    def __init__(self, data, step):
        self.data, self.step = io.BytesIO(data), step

    def read(self, size=-1):
        return self.data.read(min(size, self.step))


@pytest.mark.parametrize("step", [1, 7, 1 << 16])
def test_members_may_be_cut_anywhere(step):
    payloads = [b"", b"a" * 5000, b"\r\n\r\n", bytes(range(256)) * 9]
    found = list(read_archive(Trickle(archive(*payloads), step)))
    assert [r.payload for r in found] == payloads
    assert [r.payload_digest for r in found] == [hashlib.sha256(p).hexdigest() for p in payloads]


def test_each_record_is_one_gzip_member():
    data = write_record("response", 1, "u", b"hello")
    assert gzip.decompress(data).startswith(b"WARC/1.1\r\n") and gzip.decompress(data).endswith(b"hello\r\n\r\n")


def test_long_payload_is_not_held():
    """A payload of 64 MB that packs to a few kB passes in chunks."""
    data = archive(b"z" * (64 << 20))
    largest = 0
    real = warc._Members.more

    def measured(self):
        nonlocal largest
        out = real(self)
        largest = max(largest, len(out))
        return out

    warc._Members.more = measured
    try:
        (record,) = read_archive(io.BytesIO(data), keep=False)
    finally:
        warc._Members.more = real
    assert record.payload is None and record.payload_bytes == 64 << 20 and largest <= warc.CHUNK


def test_damage_is_found():
    data = archive(b"first " * 50, b"second " * 50)
    with pytest.raises(WarcError):
        list(read_archive(io.BytesIO(data[:-9])))
    with pytest.raises(WarcError):
        list(read_archive(io.BytesIO(data + b"junk")))
    whole = gzip.decompress(write_record("response", 1, "u", b"hello world"))
    with pytest.raises(WarcError, match="digest"):
        list(read_archive(io.BytesIO(gzip.compress(whole.replace(b"hello", b"jello")))))
    with pytest.raises(WarcError):
        list(read_archive(io.BytesIO(gzip.compress(whole[:-6]))))
    with pytest.raises(WarcError):
        list(read_archive(io.BytesIO(gzip.compress(whole + b"more"))))
    with pytest.raises(WarcError):
        list(read_archive(io.BytesIO(gzip.compress(b"no archive\r\n\r\n"))))
