"""WARC archives: a writer, and a sequential reader of one gzip member per record.

The reader inflates a file chunk by chunk, frames each record by its Content-Length, and verifies the digests of block and
payload while the bytes pass.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from typing import BinaryIO
from urllib.parse import quote

from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reclink.llm.common import map_rows
from reclink.session import cut, scratch

# Payloads from this size on are stored once.
REVISIT_BYTES = 100

# Bytes read and inflated at a time, the most that headers may have, the level of compression, and the size at which a task starts the next archive.
CHUNK = 1 << 16
LONGEST_HEAD = 1 << 20
LEVEL = 4
ARCHIVE_BYTES = 1 << 28

DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
GZIP = 16 + zlib.MAX_WBITS


class WarcError(ValueError):
    """An archive that cannot be read, or a digest that does not hold."""


@dataclass
class Record:
    """Headers by lower-case name, the HTTP headers of the block, and the payload if it was kept."""

    headers: dict[str, str]
    http: dict[str, str]
    payload: bytes | None
    payload_digest: str
    payload_bytes: int


def _head(first: str, fields: dict[str, str]) -> bytes:
    return "".join([first, "\r\n", *(f"{k}: {v}\r\n" for k, v in fields.items()), "\r\n"]).encode()


def _name(page_id: int | None) -> str:
    return f"<urn:page:{'null' if page_id is None else page_id}>"


def _page(name: str | None) -> int | None:
    number = (name or "").removeprefix("<urn:page:").removesuffix(">")
    return None if number in ("", "null") else int(number)


def write_record(kind: str, page_id: int | None, url: str | None, payload: bytes, refers_to: int | None = None) -> bytes:
    """One gzip member: a response with its payload, or a revisit without it. Both name the digest of the payload."""
    digest = hashlib.sha256(payload).hexdigest()
    block = _head("HTTP/1.1 200 OK", {"Content-Type": "text/html; charset=utf-8", "Content-Length": str(len(payload))})
    fields = {
        "WARC-Type": kind,
        "WARC-Record-ID": _name(page_id),
        "WARC-Date": DATE,
        # Control characters and spaces of an address would break the header.
        "WARC-Target-URI": quote(url or "", safe="!#$%&'()*+,/:;=?@[]~"),
        "WARC-Payload-Digest": f"sha256:{digest}",
        "Content-Type": "application/http; msgtype=response",
    }
    if kind == "revisit":
        fields |= {"WARC-Refers-To": _name(refers_to), "WARC-Profile": PROFILE}
    else:
        block += payload
    fields |= {"WARC-Block-Digest": f"sha256:{hashlib.sha256(block).hexdigest()}", "Content-Length": str(len(block))}
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, GZIP)
    return packer.compress(_head("WARC/1.1", fields) + block + b"\r\n\r\n") + packer.flush()


def _fields(head: bytes) -> tuple[str, dict[str, str]]:
    first, *lines = head.decode("utf-8", "replace").split("\r\n")
    return first, {k.strip().lower(): v.strip() for k, v in (x.split(":", 1) for x in lines if ":" in x)}


class _Members:
    """The inflated bytes of a file, gzip member by gzip member, never more than a chunk ahead."""

    def __init__(self, file: BinaryIO):
        self.file, self.raw, self.offset = file, b"", 0

    def open(self) -> bool:
        """Begin the next member; False at the end of the file."""
        self.raw = self.raw or self.file.read(CHUNK)
        self.unpacker, self.held = zlib.decompressobj(GZIP), b""
        return bool(self.raw)

    def more(self) -> bytes:
        """Some bytes of this member; none at its end."""
        while not self.unpacker.eof:
            data = self.raw or self.file.read(CHUNK)
            if not data:
                raise WarcError("the file ends inside a record")
            try:
                out = self.unpacker.decompress(data, CHUNK)
            except zlib.error as error:
                raise WarcError(f"not a gzip member: {error}") from error
            self.raw = self.unpacker.unused_data if self.unpacker.eof else self.unpacker.unconsumed_tail
            if out:
                return out
        return b""

    def until(self, mark: bytes) -> bytes:
        """Bytes up to a mark, which is passed."""
        while (at := self.held.find(mark)) < 0:
            more = self.more()
            if not more:
                raise WarcError("a record without an end of its headers")
            self.held += more
            if len(self.held) > LONGEST_HEAD + CHUNK:
                raise WarcError("the headers of a record are too long")
        out, self.held = self.held[:at], self.held[at + len(mark) :]
        return out

    def take(self, count: int) -> Iterator[bytes]:
        """The next bytes, in pieces."""
        while count:
            piece = self.held or self.more()
            if not piece:
                raise WarcError("a record shorter than its Content-Length")
            yield piece[:count]
            self.held = piece[count:]
            count -= min(count, len(piece))

    def ends(self, mark: bytes) -> bool:
        """Whether the member ends with just this mark."""
        while len(self.held) <= len(mark) and (piece := self.more()):
            self.held += piece
        return self.held == mark


def read_archive(file: BinaryIO, keep: bool = True) -> Iterator[Record]:
    """Records of a file in their order. Raises WarcError for a damaged one.

    At most a chunk of the file and, if payloads are kept, one payload are in memory.
    """
    members = _Members(file)
    while members.open():
        first, headers = _fields(members.until(b"\r\n\r\n"))
        if not first.startswith("WARC/"):
            raise WarcError(f"no WARC record: {first[:40]!r}")
        whole, payload = hashlib.sha256(), hashlib.sha256()
        http: dict[str, str] | None = None if headers.get("content-type", "").startswith("application/http") else {}
        kept, size, head = [], 0, b""
        for piece in members.take(int(headers["content-length"])):
            whole.update(piece)
            if http is None:
                head += piece
                at = head.find(b"\r\n\r\n")
                if at < 0:
                    continue
                http, piece = _fields(head[:at])[1], head[at + 4 :]
            payload.update(piece)
            size += len(piece)
            if keep:
                kept.append(piece)
        if not members.ends(b"\r\n\r\n"):
            raise WarcError("a record that does not end with two line ends")
        stated = headers.get("warc-block-digest", "").removeprefix("sha256:")
        if stated and stated != whole.hexdigest():
            raise WarcError(f"wrong block digest in {headers.get('warc-record-id')}")
        digest = headers.get("warc-payload-digest", "").removeprefix("sha256:")
        if headers.get("warc-type") == "revisit":
            size = int((http or {}).get("content-length", 0))
        elif digest and digest != payload.hexdigest():
            raise WarcError(f"wrong payload digest in {headers.get('warc-record-id')}")
        yield Record(headers, http or {}, b"".join(kept) if keep else None, digest or payload.hexdigest(), size)


def write_archives(pages: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write a record for each page to .warc.gz files in a shared folder, and return their list: (path, records, bytes).

    Of the pages with one payload of at least REVISIT_BYTES, the smallest page_id is a response and the others revisit it.
    Payloads are grouped by digest: the smallest ids are found in each task first, then each page meets the one row of its
    digest; a payload that fills a third of the table is split by the adaptive skew join.

    Each attempt of a task writes files of its own, and only the files of attempts that ended are in the list, so a lost
    executor leaves at most files that nobody reads. A task has one record in memory and starts a new file at
    archive_bytes.
    """
    payload = F.coalesce(F.col("html").cast("string"), F.lit(""))
    read = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("html"))
    marked = read.withColumn("digest", F.unhex(F.sha2(F.col("html").cast("binary"), 256)))
    large = marked.where(F.octet_length("html") >= REVISIT_BYTES).select("page_id", "digest")
    firsts = large.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1")
    placed = marked.join(firsts.drop("n"), "digest", "left").select("page_id", "url", "html", "first")

    def run(rows: Iterator[dict]) -> Iterator[dict]:
        store, root = fs.FileSystem.from_uri(folder)
        attempt = f"{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}"
        file, path, records, size, number = None, "", 0, 0, 0

        def closed() -> dict:
            file.close()
            return {"path": path, "records": records, "bytes": size}

        for row in rows:
            if file is None or size >= archive_bytes:
                if file is not None:
                    yield closed()
                path, records, size, number = f"{attempt}-{number:04d}.warc.gz", 0, 0, number + 1
                file = store.open_output_stream(f"{root}/{path}", compression=None)
            again = row["first"] is not None and row["first"] != row["page_id"]
            kind = "revisit" if again else "response"
            data = write_record(kind, row["page_id"], row["url"], row["html"].encode(), row["first"])
            file.write(data)
            records, size = records + 1, size + len(data)
        if file is not None:
            yield closed()

    store, root = fs.FileSystem.from_uri(folder)
    store.create_dir(root, recursive=True)
    return cut(map_rows(placed, run, "path string, records long, bytes long"), "archives")


def read_archives(archives: DataFrame, folder: str, keep: bool = False) -> DataFrame:
    """Records of listed archives, one task for each file: page_id, url, payload_bytes, payload_digest, record_type,
    refers_to, and the payload if it is kept. A damaged archive raises an error, it is never skipped."""

    def run(rows: Iterator[dict]) -> Iterator[dict]:
        store, root = fs.FileSystem.from_uri(folder)
        for row in rows:
            with store.open_input_stream(f"{root}/{row['path']}", compression=None) as file:
                for record in read_archive(file, keep):
                    revisit = record.headers["warc-type"] == "revisit"
                    yield {
                        "page_id": _page(record.headers["warc-record-id"]),
                        "url": record.headers.get("warc-target-uri"),
                        "payload_bytes": record.payload_bytes,
                        "payload_digest": record.payload_digest,
                        "record_type": record.headers["warc-type"],
                        "refers_to": _page(record.headers.get("warc-refers-to")) if revisit else None,
                        "payload": record.payload if keep else None,
                    }

    files = archives.count()
    spread = archives.repartition(max(1, files), "path")
    schema = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"
    found = map_rows(spread, run, schema)
    return found if keep else found.drop("payload")


def archive_round_trip(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write pages to archives and read them back: page_id, payload_bytes, payload_digest, record_type, refers_to.

    Edge cases: a null html is an empty payload, a null url an empty one; control characters of an address are written in
    percent code. A null page_id is written as such; it is never the smallest, unless a payload has null ids only, which
    are all responses then. Repeated rows of the smallest id are all responses. Other columns are not read; an empty table
    writes no archive and gives an empty result.
    """
    folder = folder or scratch(pages.sparkSession, "warc")
    read = read_archives(write_archives(pages, folder), folder)
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
