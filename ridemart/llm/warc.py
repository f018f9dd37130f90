"""WARC archives: one gzip member per record, written by tasks and read sequentially.

Pages with equal payloads are found by their SHA-256; the one with the smallest page_id is
written as a response, the others as revisits that carry no payload but refer to it. Each task
writes archives of bounded size to the shared folder and lists them in its output; the stored
list is the table of contents. The reader takes an archive as a stream: it inflates one gzip
member after another in small pieces, frames each record by its Content-Length and checks block
and payload digests as the bytes go by.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from typing import BinaryIO
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridemart.llm.common import filesystem, new_file, stored
from ridemart.session import shared_folder

#: Payloads of fewer bytes are never revisits.
REVISIT_BYTES = 100
#: An archive is closed once it has this many compressed bytes.
ARCHIVE_BYTES = 64 << 20
PIECE = 1 << 16
#: Fixed values of the format.
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"
_SPACE = uuid.uuid5(uuid.NAMESPACE_URL, "page-records")


class CorruptArchive(ValueError):
    """An archive breaks off, is not framed as it says, or has a wrong digest."""


# ---- records ---------------------------------------------------------------------------


def record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, str(page_id))}>"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One record as a gzip member. A revisit (``refers_to`` set) has HTTP headers only."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    headers = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", record_id(page_id)),
        ("WARC-Date", DATE),
        ("WARC-Block-Digest", "sha256:" + hashlib.sha256(block).hexdigest()),
        ("WARC-Payload-Digest", "sha256:" + digest),
    ]
    if page_id is not None:
        headers.append(("WARC-Page-Id", str(page_id)))
    if url is not None:
        # Control characters and spaces would break the framing of the header.
        headers.append(("WARC-Target-URI", quote(url, safe="!#$%&'()*+,/:;=?@[]~")))
    if refers_to is not None:
        headers += [
            ("WARC-Profile", PROFILE),
            ("WARC-Refers-To", record_id(refers_to)),
            ("WARC-Refers-To-Page-Id", str(refers_to)),
        ]
    headers += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    head = VERSION + b"\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers).encode() + b"\r\n"
    member = zlib.compressobj(6, zlib.DEFLATED, 31)
    return member.compress(head) + member.compress(block) + member.compress(b"\r\n\r\n") + member.flush()


@dataclass
class Record:
    headers: dict[str, str]
    #: HTTP headers, with names in lower case.
    http: dict[str, str] = field(default_factory=dict)
    payload: bytes | None = None
    #: Bytes and SHA-256 of the payload that is in the record itself.
    payload_bytes: int = 0
    payload_sha256: str = ""

    @property
    def kind(self) -> str:
        return self.headers["warc-type"]


class _Member:
    """The inflated bytes of one gzip member, taken from the archive piece by piece."""

    def __init__(self, source: BinaryIO, rest: bytes):
        self.source, self.rest, self.ready = source, rest, b""
        self.inflate = zlib.decompressobj(31)

    def more(self) -> bool:
        """Inflates another piece; False at the member's end."""
        while not self.inflate.eof:
            data = self.inflate.unconsumed_tail or self.rest or self.source.read(PIECE)
            if not self.inflate.unconsumed_tail:
                self.rest = b""
            if not data:
                raise CorruptArchive("the archive ends within a member")
            try:
                got = self.inflate.decompress(data, PIECE)
            except zlib.error as e:
                raise CorruptArchive(f"a member cannot be inflated: {e}") from e
            if self.inflate.eof:
                self.rest = self.inflate.unused_data
            if got:
                self.ready += got
                return True
        return False

    def until(self, mark: bytes, most: int = 1 << 20) -> bytes:
        while (at := self.ready.find(mark)) < 0:
            if len(self.ready) > most or not self.more():
                raise CorruptArchive(f"no {mark!r} where a header should end")
        got, self.ready = self.ready[:at], self.ready[at + len(mark) :]
        return got

    def take(self, size: int) -> Iterator[bytes]:
        while size:
            if not self.ready and not self.more():
                raise CorruptArchive("a block is shorter than its Content-Length")
            piece, self.ready = self.ready[:size], self.ready[size:]
            size -= len(piece)
            yield piece


def _fields(lines: bytes) -> dict[str, str]:
    pairs = (line.split(":", 1) for line in lines.decode("utf-8", "replace").split("\r\n") if ":" in line)
    return {name.strip().lower(): value.strip() for name, value in pairs}


def read_records(source: BinaryIO, keep_payload: bool = False) -> Iterator[Record]:
    """The records of an archive in order, each checked; raises ``CorruptArchive`` on any fault.

    Without ``keep_payload`` memory holds one piece at a time, whatever the record's size.
    """
    rest = source.read(PIECE)
    while rest:
        member = _Member(source, rest)
        version, _, lines = member.until(b"\r\n\r\n").partition(b"\r\n")
        if not re.fullmatch(rb"WARC/1\.[01]", version):
            raise CorruptArchive(f"a record starts with {version[:40]!r}")
        found = Record(_fields(lines))
        block, payload, kept, head, size = hashlib.sha256(), hashlib.sha256(), [], b"", 0
        in_head = found.headers.get("content-type", "").startswith("application/http")
        for piece in member.take(int(found.headers["content-length"])):
            block.update(piece)
            if in_head:
                head += piece
                if (at := head.find(b"\r\n\r\n")) < 0:
                    continue
                in_head, piece = False, head[at + 4 :]
                found.http = _fields(head[:at].partition(b"\r\n")[2])
            payload.update(piece)
            size += len(piece)
            if keep_payload:
                kept.append(piece)
        if b"".join(member.take(4)) != b"\r\n\r\n" or member.ready or member.more():
            raise CorruptArchive("a record does not end after its block")
        found.payload_bytes, found.payload_sha256 = size, payload.hexdigest()
        found.payload = b"".join(kept) if keep_payload else None
        wrong = [
            name
            for name, have in (("warc-block-digest", block), ("warc-payload-digest", payload))
            if name in found.headers
            and not (name == "warc-payload-digest" and found.kind == "revisit")
            and found.headers[name] != "sha256:" + have.hexdigest()
        ]
        if wrong:
            raise CorruptArchive(f"{wrong[0]} of {found.headers.get('warc-record-id')} does not match")
        yield found
        rest = member.rest or source.read(PIECE)


# ---- whole tables ----------------------------------------------------------------------


def planned(pages: DataFrame, least_bytes: int = REVISIT_BYTES) -> DataFrame:
    """page_id, url, payload, digest and ``refers_to`` (null for responses) of every page.

    Only (page_id, digest) pairs are grouped, combined before they are shuffled; payloads meet the
    groups of two and more in one join, which splits a payload that many pages have.
    """
    html = F.coalesce("html", F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", html.alias("payload")).withColumn("digest", F.sha2("payload", 256))
    repeated = (
        rows.filter(F.octet_length("payload") >= least_bytes)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first_page"), F.count(F.lit(1)).alias("pages"))
        .filter("pages > 1 AND first_page IS NOT NULL")
        .select("digest", "first_page")
    )
    later = ~F.col("page_id").eqNullSafe(F.col("first_page"))
    return rows.join(repeated, "digest", "left").select(
        "page_id", "url", "payload", "digest", F.when(F.col("first_page").isNotNull() & later, F.col("first_page")).alias("refers_to")
    )


def write(pages: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes every page as a record; returns the stored list of archives (path, records, bytes).

    Rows that share the smallest page_id of their payload are all responses. A null url gives a
    record without a target, null html an empty payload, an empty table no archive. Columns
    other than page_id, url and html are not read.
    """
    import pyarrow as pa

    def archives(batches):
        store, root = filesystem(folder)
        store.create_dir(root, recursive=True)
        out, path, count, size = None, "", 0, 0
        closed = []
        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    path, count, size = new_file(root, ".warc.gz"), 0, 0
                    out = store.open_output_stream(path, compression=None)
                data = record(row["page_id"], row["url"], row["payload"], row["digest"], row["refers_to"])
                out.write(data)
                count, size = count + 1, size + len(data)
                if size >= archive_bytes:
                    out.close()
                    closed.append((path, count, size))
                    out = None
        if out is not None:
            out.close()
            closed.append((path, count, size))
        names = ("path", "records", "bytes")
        yield pa.RecordBatch.from_pylist([dict(zip(names, c, strict=True)) for c in closed], schema=contents)

    contents = pa.schema([("path", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())])
    listed = planned(pages).mapInArrow(archives, "path string, records long, bytes long")
    return stored(listed, "warc_contents")


ROW = (
    "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"
)


def read(contents: DataFrame, folder: str, payloads: bool = False) -> DataFrame:
    """The records of the listed archives, one archive to a task at a time.

    Of a revisit, length and digest are those of the full payload, as its headers state them;
    a response's are computed from what is read and compared with its headers.
    """
    import pyarrow as pa

    def records(batches):
        store, _ = filesystem(folder)
        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows, held = [], 0
                with store.open_input_stream(path, compression=None) as source:
                    for found in read_records(source, payloads):
                        revisit = found.kind == "revisit"
                        page = found.headers.get("warc-page-id")
                        first = found.headers.get("warc-refers-to-page-id")
                        full = int(found.http.get("content-length", found.payload_bytes))
                        if not revisit and full != found.payload_bytes:
                            raise CorruptArchive("a payload is not as long as its HTTP header says")
                        rows.append(
                            {
                                "page_id": int(page) if page else None,
                                "url": found.headers.get("warc-target-uri"),
                                "record_type": found.kind,
                                "refers_to": int(first) if first else None,
                                "payload_bytes": full,
                                "payload_digest": found.headers["warc-payload-digest"].removeprefix("sha256:"),
                                "payload": found.payload,
                            }
                        )
                        held += found.payload_bytes if payloads else 0
                        if len(rows) >= 5_000 or held > 16 << 20:
                            yield pa.RecordBatch.from_pylist(rows, schema=shape)
                            rows, held = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema=shape)

    shape = pa.schema(
        [("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
         ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary())]
    )
    listed = contents.select("path").repartition(max(1, contents.count()), "path")
    return listed.mapInArrow(records, ROW)


def query(spark: SparkSession, folder: str) -> DataFrame:
    """op9: all pages written as archives and read back."""
    target = shared_folder(spark, "op9_warc")
    contents = write(spark.read.parquet(f"{folder}/pages.parquet"), target)
    return read(contents, target).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE = f"""
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
  FROM pages
),
firsts AS (
  SELECT payload_digest, min(page_id) AS first_page FROM p WHERE payload_bytes >= {REVISIT_BYTES} GROUP BY 1
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first_page IS NULL OR page_id IS NOT DISTINCT FROM first_page THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM first_page THEN first_page END AS refers_to
FROM p LEFT JOIN firsts USING (payload_digest)
"""
