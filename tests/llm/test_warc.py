import gzip
import hashlib
import io

import pytest

from corvane.llm.warc import Stream, mark_revisits, read_archive, records_of, write_archive

LONG = "Zeile mit Umlauten äöü\r\n\r\nWARC/1.1\r\n" * 40
ROWS = [
    (1, "http://a/1", LONG), (2, "http://a/2", None), (3, "http://a/3", ""), (4, None, LONG), (5, "http://a/5", "short"),
    (6, "http://a/6", "short"), (7, "http://a/7\r\nX: y", "x" * 100), (0, "http://a/0", LONG), (8, "u", "x" * 100), (8, "u", "x" * 100),
    (9, "u", "tail\r\n"), (None, "u", "n" * 200), (None, "u", LONG),
]


def expected(rows, least=100):
    out = []
    for i, _, text in rows:
        raw = (text or "").encode()
        ids = [j for j, _, t in rows if (t or "").encode() == raw and j is not None]
        first = min(ids) if len(raw) >= least and ids and min(ids) != i else None
        out.append((i, len(raw), hashlib.sha256(raw).hexdigest(), "response" if first is None else "revisit", first))
    return sorted(out, key=str)


@pytest.mark.parametrize("chunk", [7, 100, 1 << 20])
def test_round_trip(spark, tmp_path, chunk):
    pages = spark.createDataFrame([(*r, "z") for r in ROWS], "page_id long, url string, html string, sha256 string")
    path = str(tmp_path / "archive")
    write_archive(mark_revisits(pages, "page_id", "url", "html"), path, chunk_bytes=chunk)
    chunks = read_archive(spark, path, chunk_bytes=chunk).collect()
    assert max(len(c.data) for c in chunks) <= chunk
    number = lambda v: None if v is None else int(v)
    ends = [(number(c.record_id), c.bytes_so_far, c.sha256_so_far, c.record_type, number(c.refers_to)) for c in chunks if c.last]
    assert sorted(ends, key=str) == expected(ROWS)
    parts = sorted((c.chunk_no, bytes(c.data), c.sha256_so_far) for c in chunks if c.record_id == "0")
    whole = hashlib.sha256()
    for _, data, so_far in parts:
        whole.update(data)
        assert so_far == whole.hexdigest()
    assert b"".join(p[1] for p in parts) == LONG.encode()


def test_empty_table(spark, tmp_path):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    write_archive(mark_revisits(pages, "page_id", "url", "html"), str(tmp_path / "none"))
    assert read_archive(spark, str(tmp_path / "none")).collect() == []


def record(block, digest=None):
    head = f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:record:1>\r\nWARC-Payload-Digest: sha256:{digest or hashlib.sha256(block).hexdigest()}\r\n"
    return head.encode() + b"Content-Length: %d\r\n\r\n" % len(block) + block + b"\r\n\r\n"


def test_members_and_plain_files():
    several = b"".join(gzip.compress(record(b"block %d" % i)) for i in range(5))
    plain = b"".join(record(b"block %d" % i) for i in range(5))
    for raw in (several, plain):
        rows = list(records_of(Stream(io.BytesIO(raw), block=13), 4))
        assert [r["sha256_so_far"] for r in rows if r["last"]] == [hashlib.sha256(b"block %d" % i).hexdigest() for i in range(5)]


def test_damage_is_found():
    with pytest.raises(ValueError, match="digest"):
        list(records_of(Stream(io.BytesIO(record(b"abc", "0" * 64))), 10))
    with pytest.raises(ValueError, match="ends within"):
        list(records_of(Stream(io.BytesIO(record(b"abcdefgh")[:-8])), 10))
