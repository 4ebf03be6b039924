"""Media columns: payloads stored without loss as progressive JPEGs, decoded to RGB tensors.

A payload of whole 64-byte blocks becomes quantised coefficients, one byte less 128 each; six
blocks make a unit of four luma and two chroma blocks. The image notes how many blocks belong to
the payload, the rest of the last units is zero. Decoding gives back the coefficients, hence the
payload, and the image itself: a tensor of height x width x 3 bytes.

Each row is stored and read alone, in small lots of rows; nothing is shuffled. A row's memory is
a small multiple of its payload.

Defined cases: a null or empty text is one block of zeros. Equal texts give equal media, tensors
and features, however rows are dealt. Empty tables give empty results. Columns beside the named ones
pass untouched; those named as results give way to them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrow import map_batches, pieces
from .jpeg import SUBSAMPLED, decode, encode, pixels, unit_rows

BLOCK = 64
#: Bytes of text or of media that are worked on together.
LOT = 1_500_000
#: Units a line of an image, more where its height would exceed the format's 65,535 pixels.
UNITS_WIDE, MOST_HIGH = 64, 4095


def padded(text: str | None) -> bytes:
    raw = (text or "").encode("utf-8", "surrogatepass")
    return raw + bytes(-len(raw) % BLOCK or (0 if raw else BLOCK))


def shape_of(blocks: int) -> tuple[int, int]:
    """Units wide and high of an image that holds so many blocks."""
    units = -(-blocks // SUBSAMPLED)
    wide = min(units, max(UNITS_WIDE, -(-units // MOST_HIGH)))
    return wide, -(-units // wide)


def store(payloads: list[bytes]) -> list[bytes]:
    """A JPEG for each payload of whole blocks."""
    shapes = [shape_of(len(p) // BLOCK) for p in payloads]
    base, out = 0, np.zeros((SUBSAMPLED * sum(w * h for w, h in shapes), BLOCK), np.int16)
    for p, (w, h) in zip(payloads, shapes, strict=True):
        n = len(p) // BLOCK
        out[unit_rows(w, h).ravel()[:n] + base] = np.frombuffer(p, np.uint8).reshape(n, BLOCK).astype(np.int16) - 128
        base += SUBSAMPLED * w * h
    return encode(shapes, out, [b"blocks " + str(len(p) // BLOCK).encode() for p in payloads])


def load(media: list[bytes]) -> tuple[list[bytes], list[np.ndarray]]:
    """The payloads and the RGB tensors of stored images."""
    heads, blocks = decode(media)
    payloads = []
    for h, b in zip(heads, blocks, strict=True):
        n = next(int(x[7:]) for x in h.notes if x.startswith(b"blocks "))
        payloads.append((b[unit_rows(h.wide, h.high).ravel()[:n]] + 128).astype(np.uint8).tobytes())
    return payloads, pixels(heads, blocks)


def describe(tensor: np.ndarray) -> str:
    """Size, sums of the three channels, and the sums of absolute steps along lines and columns."""
    t = tensor.astype(np.int16)
    sums = t.sum((0, 1), dtype=np.int64)
    return f"{t.shape[1]}x{t.shape[0]};{';'.join(map(str, sums))};{int(np.abs(np.diff(t, axis=1)).sum(dtype=np.int64))};{int(np.abs(np.diff(t, axis=0)).sum(dtype=np.int64))}"


def store_texts(docs: DataFrame, *, text_col: str = "text") -> DataFrame:
    """``docs`` with ``n_bytes`` (without padding) and the image ``media`` of each text."""
    docs = docs.drop("n_bytes", "media")
    given = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for b in pieces(batch, text_col, LOT):
                texts = b.column(given.index(text_col)).to_pylist()
                whole = [padded(t) for t in texts]
                yield {c: b.column(i) for i, c in enumerate(given)} | {"n_bytes": [len((t or "").encode("utf-8", "surrogatepass")) for t in texts], "media": store(whole)}

    return map_batches(docs, run, docs.select("*", F.lit(None).cast("bigint").alias("n_bytes"), F.lit(None).cast("binary").alias("media")).schema)


def load_media(df: DataFrame, *, media_col: str = "media", tensors: bool = True) -> DataFrame:
    """``df`` with the stored ``payload``, the ``feature`` of its image and, unless ``tensors`` is off, the ``tensor``: ``height, width, rgb``."""
    names = ("payload", "feature", *(["tensor"] if tensors else []))
    df = df.drop(*names)
    given = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for b in pieces(batch, media_col, LOT):
                payloads, images = load(b.column(given.index(media_col)).to_pylist())
                out = {c: b.column(i) for i, c in enumerate(given)} | {"payload": payloads, "feature": [describe(t) for t in images]}
                if tensors:
                    out["tensor"] = [{"height": t.shape[0], "width": t.shape[1], "rgb": t.tobytes()} for t in images]
                yield out

    more = {"payload": "binary", "feature": "string", "tensor": "struct<height: int, width: int, rgb: binary>"}
    return map_batches(df, run, df.select("*", *(F.lit(None).cast(more[n]).alias(n) for n in names)).schema)
