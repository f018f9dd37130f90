import collections
import gzip
import hashlib
import io
import zlib

import pytest

from ridemart.llm import warc


def made(page_id=1, url="http://x.org/", payload=b"hello", refers_to=None):
    return warc.record(page_id, url, payload, hashlib.sha256(payload).hexdigest(), refers_to)


def test_records_round_trip_one_member_each():
    payloads = [b"", b"x", b"\r\n\r\nWARC/1.1\r\n", bytes(range(256)) * 3000, "é😀".encode()]
    archive = b"".join(made(i, f"http://x/{i}", p) for i, p in enumerate(payloads)) + made(9, None, b"seen", 3)
    found = list(warc.read_records(io.BytesIO(archive), keep_payload=True))
    assert [r.payload for r in found] == [*payloads, b""]
    assert [r.headers["warc-type"] for r in found] == ["response"] * 5 + ["revisit"]
    assert found[5].headers["warc-refers-to"] == found[3].headers["warc-record-id"]
    assert found[5].http["content-length"] == "4" and "warc-target-uri" not in found[5].headers
    assert gzip.decompress(archive).count(b"WARC/1.1\r\nWARC-Type") == 6
    first = zlib.decompressobj(31)
    first.decompress(archive)
    assert first.eof and first.unused_data[:2] == b"\x1f\x8b"


def test_pieces_of_any_size_give_the_same(monkeypatch):
    archive = b"".join(made(i, payload=bytes([i]) * (i * 97)) for i in range(30))
    for piece in (1, 3, 100, 1 << 16):
        monkeypatch.setattr(warc, "PIECE", piece)
        found = list(warc.read_records(io.BytesIO(archive)))
        assert [r.payload_bytes for r in found] == [i * 97 for i in range(30)] and found[3].payload is None


def test_urls_cannot_break_the_framing():
    for url in ("http://x/\r\nContent-Length: 0\r\n\r\n", "http://é/ \t", ""):
        (found,) = warc.read_records(io.BytesIO(made(url=url)), True)
        assert found.payload == b"hello" and "\n" not in found.headers["warc-target-uri"]


def packed(text):
    return gzip.compress(text)


def test_damage_is_noticed():
    good = made(1) + made(2)
    plain = gzip.decompress(made(1))
    broken = [good[:-3], good[:20], good + b"junk", packed(plain.replace(b"hello", b"hellO")), packed(plain[:-1]), packed(plain + b"x"),
              packed(plain.replace(b"WARC/1.1", b"HTTP/1.1", 1)), packed(b"no header at all"), b"not gzip"]
    for data in broken:
        with pytest.raises(warc.CorruptArchive):
            list(warc.read_records(io.BytesIO(data)))
    assert list(warc.read_records(io.BytesIO(b""))) == []


LONG, SHORT = "<p>" + "long page " * 20, "short"
ROWS = [(i, f"http://x/{i}", LONG if i % 3 else f"{LONG}{i}") for i in range(5, 60)]
ROWS += [(100, None, SHORT), (101, "u", SHORT), (102, "u", None), (103, "u", ""), (104, "u", "é" * 50), (105, "u", "é" * 50), (106, "u", "e" * 99)]
ROWS += [(107, "u", "e" * 99), (None, "n", LONG), (None, "n", "only nulls have this " * 9), (None, None, "only nulls have this " * 9)]
ROWS += [(4, "a", LONG), (4, "a", LONG), (108, "huge", "z" * 3_000_000)]


def expected(rows):
    """page_id, bytes, digest, type and reference by comparing all pages."""
    first = {}
    for page, _, html in rows:
        data = (html or "").encode()
        if len(data) >= 100 and page is not None:
            first[data] = min(page, first.get(data, page))
    out = collections.Counter()
    for page, _, html in rows:
        data = (html or "").encode()
        other = first.get(data)
        revisit = other is not None and page != other
        out[(page, len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response", other if revisit else None)] += 1
    return out


@pytest.mark.parametrize("size", [200, 64 << 20])
def test_whole_table(spark, tmp_path, size):
    pages = spark.createDataFrame([(*r, "x", 1) for r in ROWS], "page_id long, url string, html string, digest string, payload int")
    contents = warc.write(pages.repartition(4), str(tmp_path), size)
    assert contents.agg({"records": "sum"}).first()[0] == len(ROWS)
    got = warc.read(contents, str(tmp_path), payloads=True).collect()
    names = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert collections.Counter(tuple(r[n] for n in names) for r in got) == expected(ROWS)
    whole = {(r.page_id, r.payload) for r in got if r.record_type == "response"}
    assert (108, b"z" * 3_000_000) in whole and (102, b"") in whole
    assert all(r.payload == b"" for r in got if r.record_type == "revisit")
    assert warc.read(warc.write(pages.limit(0), str(tmp_path)), str(tmp_path)).count() == 0


def test_files_of_lost_attempts_are_not_read(spark, tmp_path):
    pages = spark.createDataFrame(ROWS[:5], "page_id long, url string, html string")
    contents = warc.write(pages, str(tmp_path))
    (tmp_path / "left-over.warc.gz").write_bytes(b"broken")
    assert warc.read(contents, str(tmp_path)).count() == 5
