"""WARC archives by way of chunk tables.

A record's payload goes to its archive in chunks: a task holds one chunk and a running SHA-1,
never a whole record beside its input. Reading gives the chunk table: record identifier, chunk
number, offset, the chunk's bytes, and the digest of the payload up to and including it, so every
prefix can be verified and the last chunk carries the digest of the whole.

Archives are WARC 1.1 files, each record a gzip member, below the shared folder, written and read as streams through
``pyarrow.fs``, which knows ``file:``, ``s3:``, ``gs:`` and ``hdfs:``. A task writes files under
names of its own and returns their names; only what a finished write lists counts, so a task
that is lost or repeated leaves at worst a file that nobody reads.

Payloads that are equal and have at least ``least_bytes`` are stored once: the record with the
largest id is the response, the others revisit it and keep its digest and, as the HTTP header
they keep has it, its length.

Defined cases: a null payload is empty. Rows whose id is null take part by their payload, sort
below all ids and cannot be referred to. Rows that repeat an id and payload are all written;
one of them is enough to be the response, and all rows with that id are. An empty table
makes no archive. Very long payloads are handed to the archive in chunks, one row at a time. Columns beside the named ones are
ignored, whatever their names.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint, new_folder
from .arrow import map_batches, pieces
from .bitmap import marked, maybe_in

CHUNK_BYTES = 64 * 1024
#: Archives end with the first record that fills them beyond this.
ARCHIVE_BYTES = 256 * 1024 * 1024
#: Bytes of payloads that are taken from a batch at a time, one row at least.
HELD_BYTES = 1 << 22
#: The profile of revisits in the WARC 1.1 standard.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
EPOCH = "1970-01-01T00:00:00Z"


def base32_sha1(h) -> str:
    return base64.b32encode(h.digest()).decode()


def open_folder(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder's URI, and the path there."""
    return fs.FileSystem.from_uri(uri) if ":/" in uri else (fs.LocalFileSystem(), uri)


def record_id(row_id: int | None) -> str:
    return f"<urn:page:{'' if row_id is None else row_id}>"


def chunks(text: str | None, size: int) -> Iterator[bytes]:
    """The text's UTF-8 bytes in chunks of at most ``size``; characters of the text are encoded a part at a time."""
    step = max(1, size // 4)
    for i in range(0, len(text or ""), step):
        yield text[i : i + step].encode("utf-8", "surrogatepass")


def measure(text: str | None, size: int) -> tuple[int, str]:
    h, n = hashlib.sha1(usedforsecurity=False), 0
    for c in chunks(text, size):
        h.update(c)
        n += len(c)
    return n, base32_sha1(h)


class Member:
    """What is written between ``begin`` and ``end`` is one gzip member of ``out``."""

    def __init__(self, out):
        self.out, self.size, self.packer = out, 0, None

    def begin(self) -> None:
        self.packer = zlib.compressobj(6, zlib.DEFLATED, 31)

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.size += len(data)

    def write(self, data: bytes) -> None:
        self._put(self.packer.compress(data))

    def end(self) -> None:
        self._put(self.packer.flush())


class Members:
    """The bytes of all gzip members of a stream, one after another; a stream that is not packed as it is."""

    def __init__(self, stream):
        self.stream, self.packed, self.held, self.unpacker = stream, None, b"", None

    def read(self, n: int) -> bytes:
        while True:
            if not self.held:
                self.held = self.stream.read(n)
                if not self.held:
                    if self.unpacker:
                        raise ValueError("the archive ends within a member")
                    return b""
            if self.packed is None:
                self.packed = self.held[:1] == b"\x1f"
            if not self.packed:
                out, self.held = self.held, b""
                return out
            self.unpacker = self.unpacker or zlib.decompressobj(31)
            out = self.unpacker.decompress(self.held, n)
            self.held = self.unpacker.unconsumed_tail
            if self.unpacker.eof:
                self.held, self.unpacker = self.unpacker.unused_data, None
            if out:
                return out


def _clean(value: str | None) -> str:
    """A header's value stays on its line."""
    return (value or "").replace("\r", " ").replace("\n", " ")


def write_record(out: Member, row_id: int | None, url: str | None, text: str | None, refers_to: int | None, size: int, length: int | None = None, sha1: str | None = None) -> None:
    """One response or revisit record; the payload is streamed twice, once for its length and digest and once to the file. A revisit has both given."""
    n, digest = measure(text, size) if sha1 is None else (length, base64.b32encode(bytes.fromhex(sha1)).decode())
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n}\r\n\r\n".encode()
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {record_id(row_id)}", f"WARC-Date: {EPOCH}",
            f"WARC-Target-URI: {_clean(url)}", f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response"]
    if refers_to is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to)}"]
    body = n if refers_to is None else 0
    top = "\r\n".join([*head, f"Content-Length: {len(http) + body}"]).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + http
    out.begin()
    out.write(top)
    if refers_to is None:
        for c in chunks(text, size):
            out.write(c)
    out.write(b"\r\n\r\n")
    out.end()


def assign(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least_bytes: int = 0) -> DataFrame:
    """``id, url, payload, refers_to, length, digest``: which row every row with an equal payload revisits, if it revisits one.

    Rows that revisit need no payload, so they come from digests alone. Of the others those whose payload stands once pass as
    they are; of repeated payloads one copy each (and what a bitmap takes for one) is moved to be looked at.
    """
    payload = F.coalesce(F.col(payload_col), F.lit(""))
    rows = pages.select(F.col(id_col).cast("bigint").alias("id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"), F.sha2(payload, 256).alias("_sha"), F.octet_length(payload).cast("bigint").alias("_bytes"))
    ids = checkpoint(rows.select("id", "url", "_sha", "_bytes", F.sha1("payload").alias("_sha1")).where(F.col("_bytes") >= least_bytes))
    # Copies are counted before they meet; a payload of rows without an id has no response to refer to.
    top = checkpoint(ids.groupBy("_sha").agg(F.max("id").alias("top"), F.count(F.lit(1)).alias("n")).where("n > 1 AND top IS NOT NULL").drop("n"))
    again = ids.join(top, "_sha").where("id IS NULL OR id <> top").select("id", "url", F.lit(None).cast("string").alias("payload"), F.col("top").alias("refers_to"), F.col("_bytes").alias("length"), F.col("_sha1").alias("digest"))
    pair = F.concat_ws("/", "_sha", "id")
    d = marked(marked(rows.where(F.col("_bytes") >= least_bytes), F.col("_sha"), top.select("_sha"), "_twice"), pair, top.select(F.concat_ws("/", "_sha", "top")), "_first")
    shape = lambda x: x.select("id", "url", "payload", F.lit(None).cast("bigint").alias("refers_to"), F.lit(None).cast("bigint").alias("length"), F.lit(None).cast("string").alias("digest"))
    # What the map of repeated payloads lets through is held against them; a miss in either map is sure.
    looked = d.where("_twice AND _first").join(top.withColumnRenamed("top", "_top"), "_sha", "left").where("_top IS NULL OR id = _top")
    wrong = marked(ids, F.col("_sha"), top.select("_sha"), "_twice").where("_twice").join(top, "_sha", "left_anti").select("_sha").distinct()
    strays = maybe_in(d.where("_twice AND NOT _first"), F.col("_sha"), wrong).join(wrong, "_sha", "left_semi")
    out = again.unionByName(shape(d.where("NOT _twice"))).unionByName(shape(looked)).unionByName(shape(strays))
    if least_bytes:
        out = out.unionByName(shape(rows.where(F.col("_bytes") < least_bytes)))
    # As many streams of archives as the pages have partitions, or small tables would give an archive a branch.
    return out.coalesce(max(1, pages.rdd.getNumPartitions()))


def write_archives(records: DataFrame, folder: str, *, chunk_bytes: int = CHUNK_BYTES, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Archives of ``id, url, payload, refers_to, length, digest`` in ``folder``; returns their list, ``archive, records, bytes``, which is a checkpoint."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        where, base = open_folder(folder)
        out, member, name, n = None, None, "", 0
        try:
            for b in (p for b in batches for p in pieces(b, "payload", HELD_BYTES)):
                for i, url, text, refers, length, digest in zip(*(c.to_pylist() for c in b.columns), strict=True):
                    if out is None:
                        where.create_dir(base, recursive=True)
                        name, n = f"{uuid.uuid4().hex}.warc.gz", 0
                        out = where.open_output_stream(f"{base}/{name}", compression=None)
                        member = Member(out)
                    write_record(member, i, url, text, refers, chunk_bytes, length, digest)
                    n += 1
                    if member.size > archive_bytes:
                        out.close()
                        out = None
                        yield {"archive": [name], "records": [n], "bytes": [member.size]}
            if out is not None:
                out.close()
                out = None
                yield {"archive": [name], "records": [n], "bytes": [member.size]}
        finally:
            if out is not None:
                out.close()

    shaped = records.select(F.col("id").cast("bigint"), "url", "payload", F.col("refers_to").cast("bigint"), "length", "digest")
    return checkpoint(map_batches(shaped, run, "archive string, records bigint, bytes bigint"))


class Reader:
    """A stream of blocks as lines and exact stretches."""

    def __init__(self, stream, block: int):
        self.stream, self.block, self.held = stream, block, b""

    def line(self) -> bytes | None:
        """Up to the next line end, without it; None at the end."""
        while (at := self.held.find(b"\r\n")) < 0:
            more = self.stream.read(self.block)
            if not more:
                if self.held:
                    raise ValueError("the archive ends within a header")
                return None
            self.held += more
        out, self.held = self.held[:at], self.held[at + 2 :]
        return out

    def take(self, n: int) -> Iterator[bytes]:
        while n:
            part, self.held = self.held[:n] or self.stream.read(min(n, self.block)), self.held[n:]
            if not part:
                raise ValueError("the archive ends within a record")
            n -= len(part)
            yield part

    def headers(self) -> dict[str, str]:
        out = {}
        while line := self.line():
            name, _, value = line.decode("utf-8", "surrogatepass").partition(":")
            out[name.strip().lower()] = value.strip()
        return out


def read_records(stream, chunk_bytes: int = CHUNK_BYTES) -> Iterator[dict]:
    """The chunk rows of an archive, one after another; a record without payload bytes has one empty chunk."""
    r = Reader(Members(stream), chunk_bytes)
    while (version := r.line()) is not None:
        if not version.startswith(b"WARC/"):
            raise ValueError(f"no record starts with {version[:20]!r}")
        head = r.headers()
        rest, length = int(head["content-length"]), None
        if head.get("content-type", "").startswith("application/http"):
            before, http = len(r.line() or b"") + 2, {}
            while line := r.line():
                before += len(line) + 2
                name, _, value = line.decode().partition(":")
                http[name.strip().lower()] = value.strip()
            rest -= before + 2
            length = int(http["content-length"]) if "content-length" in http else None
        h, number, at, kept = hashlib.sha1(usedforsecurity=False), 0, 0, b""

        def row(data: bytes, last: bool):
            h.update(data)
            return {"record": head["warc-record-id"], "kind": head["warc-type"], "refers_to": head.get("warc-refers-to"), "chunk": number, "start": at,
                    "data": data, "sha1": base32_sha1(h), "last": last, "length": length, "digest": head.get("warc-payload-digest", "").removeprefix("sha1:") or None}

        for part in r.take(rest):
            kept += part
            while len(kept) > chunk_bytes:
                yield row(kept[:chunk_bytes], False)
                number, at, kept = number + 1, at + chunk_bytes, kept[chunk_bytes:]
        final = row(kept, True)
        if head["warc-type"] != "revisit" and final["digest"] not in (None, final["sha1"]):
            raise ValueError(f"{final['record']}: the payload does not have its digest")
        yield final
        for _ in r.take(4):
            pass


CHUNK_SCHEMA = "record string, kind string, refers_to string, chunk bigint, start bigint, data binary, sha1 string, last boolean, length bigint, digest string, archive string, at bigint"


def read_archives(archives: DataFrame, folder: str, *, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The chunk table of the listed archives: a row a chunk of each record, the ``at``-th of its archive.

    ``length`` and ``digest`` are what the record's headers say of the full payload.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        where, base = open_folder(folder)
        for b in batches:
            for name in b.column(0).to_pylist():
                held, size, at = [], 0, 0
                with where.open_input_stream(f"{base}/{name}", compression=None) as stream:
                    for row in read_records(stream, chunk_bytes):
                        held.append(row | {"archive": name, "at": at})
                        at += row["last"]
                        size += len(row["data"]) + 200
                        if size > 16 * chunk_bytes:
                            yield {k: [x[k] for x in held] for k in held[0]}
                            held, size = [], 0
                if held:
                    yield {k: [x[k] for x in held] for k in held[0]}

    n = max(1, archives.count())
    return map_batches(archives.select("archive").repartition(n), run, CHUNK_SCHEMA)


def archive_pages(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least_bytes: int = 0,
                  chunk_bytes: int = CHUNK_BYTES, archive_bytes: int = ARCHIVE_BYTES) -> tuple[DataFrame, str]:
    """The list of archives written of all pages, and their folder."""
    folder = new_folder(pages.sparkSession, "warc")
    records = assign(pages, id_col=id_col, url_col=url_col, payload_col=payload_col, least_bytes=least_bytes)
    return write_archives(records, folder, chunk_bytes=chunk_bytes, archive_bytes=archive_bytes), folder


def record_table(archives: DataFrame, folder: str, **named) -> DataFrame:
    """One row a record: ``id, payload_bytes, payload_digest, record_type, refers_to``, as read back."""
    chunks = read_archives(archives, folder, **named)
    size = F.octet_length("data").cast("bigint").alias("size")
    # A record's chunks come from one task, so they meet before anything moves.
    last = chunks.select("archive", "at", F.struct("chunk", "start", size, "sha1", "record", "kind", "refers_to", "length", "digest").alias("c")).groupBy("archive", "at").agg(F.max_by("c", "c.chunk").alias("c")).select("c.*")
    revisit = F.col("kind") == "revisit"
    number = lambda c: F.nullif(F.regexp_extract(c, "^<urn:page:(-?[0-9]*)>$", 1), F.lit("")).cast("bigint")
    return last.select(number(F.col("record")).alias("id"),
                       F.when(revisit, F.col("length")).otherwise(F.col("start") + F.col("size")).alias("payload_bytes"),
                       F.when(revisit, F.col("digest")).otherwise(F.col("sha1")).alias("payload_digest"),
                       F.col("kind").alias("record_type"), F.when(revisit, number(F.col("refers_to"))).alias("refers_to"))
