"""WARC archives: round trips, chunks, revisits and defined cases."""

import base64
import gzip
import hashlib
import io
import os

import pytest

from cohortspark.llm.warc import archive_pages, read_archives, read_records, record_table


def sha1(data):
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def make(spark, rows):
    return spark.createDataFrame([(i, f"http://h/{i}", t, "x") for i, t in rows], "page_id bigint, url string, html string, payload string")


def plain(rows, least=0):
    top = {}
    for i, t in rows:
        b = (t or "").encode()
        if len(b) >= least and i is not None:
            top[b] = max(top.get(b, i), i)
    out = []
    for i, t in rows:
        b = (t or "").encode()
        to = top.get(b) if len(b) >= least else None
        again = to is not None and to != i
        out.append((i, len(b), sha1(b), "revisit" if again else "response", to if again else None))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.select("id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=str)


ROWS = [(1, "one"), (2, "two"), (3, "one"), (9, "one"), (4, None), (5, ""), (6, "é" * 5000), (7, "WARC/1.1\r\n\r\nContent-Length: 3\r\n\r\n"), (8, "x\n" * 200_000),
        (9, "one"), (None, "one"), (None, "alone"), (2, "other two"), (-3, "minus"), (11, "\r\n\r\n")]


@pytest.mark.parametrize("chunk_bytes,archive_bytes,least", [(64, 900, 0), (65536, 1 << 28, 0), (7, 1 << 28, 4)])
def test_round_trip(spark, chunk_bytes, archive_bytes, least):
    archives, folder = archive_pages(make(spark, ROWS), least_bytes=least, chunk_bytes=chunk_bytes, archive_bytes=archive_bytes)
    assert got(record_table(archives, folder, chunk_bytes=chunk_bytes)) == plain(ROWS, least)
    assert sum(r.records for r in archives.collect()) == len(ROWS)


def test_chunks_carry_running_digests(spark):
    text = "aé" * 1000
    archives, folder = archive_pages(make(spark, [(1, text)]), chunk_bytes=128)
    rows = sorted(read_archives(archives, folder, chunk_bytes=128).collect(), key=lambda r: r.chunk)
    data = text.encode()
    assert b"".join(bytes(r.data) for r in rows) == data and max(len(r.data) for r in rows) == 128
    for k, r in enumerate(rows):
        assert (r.chunk, r.start, r.sha1, r.last) == (k, 128 * k, sha1(data[: r.start + len(r.data)]), k == len(rows) - 1)


def test_archives_are_plain_warc(spark):
    archives, folder = archive_pages(make(spark, [(1, "body"), (2, "body")]).coalesce(1))
    name = archives.first().archive
    raw = gzip.decompress(open(os.path.join(folder, name), "rb").read())
    assert raw.count(b"WARC/1.1\r\n") == 2 and b"WARC-Type: revisit" in raw and b"WARC-Refers-To: <urn:page:2>" in raw and raw.count(b"body") == 1
    assert [r["record"] for r in read_records(io.BytesIO(raw))] == ["<urn:page:1>", "<urn:page:2>"]


def test_damage_is_seen(spark):
    archives, folder = archive_pages(make(spark, [(1, "body")]))
    raw = gzip.decompress(open(os.path.join(folder, archives.first().archive), "rb").read())
    with pytest.raises(ValueError):
        list(read_records(io.BytesIO(raw.replace(b"body", b"Body"))))
    with pytest.raises(ValueError):
        list(read_records(io.BytesIO(raw[:-8])))


def test_empty_table(spark):
    archives, folder = archive_pages(make(spark, []))
    assert archives.count() == 0 and got(record_table(archives, folder)) == []


def test_long_payloads_and_clashing_names(spark):
    rows = [(1, "long " * 400_000), (2, "long " * 400_000), (3, "short")]
    df = spark.createDataFrame([(*r, "u", "x", 1, "y") for r in rows], "page_id bigint, html string, url string, refers_to string, id int, digest string")
    archives, folder = archive_pages(df)
    assert got(record_table(archives, folder)) == plain(rows)
    assert read_archives(archives, folder).where("record = '<urn:page:2>'").count() == 31


def test_a_full_bitmap_changes_nothing(spark, monkeypatch):
    """Maps so small that they take everything for a copy."""
    from cohortspark.llm import bitmap

    monkeypatch.setattr(bitmap, "MAP_BITS", 7)
    rows = [(i, f"page {i % 150}") for i in range(400)]
    archives, folder = archive_pages(make(spark, rows))
    assert got(record_table(archives, folder)) == plain(rows)
