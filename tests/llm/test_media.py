"""Progressive JPEGs: exact round trips, and images of and for another codec."""

import hashlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortspark.llm.jpeg import Image, decode, encode, pixels, unit_rows
from cohortspark.llm.load import QUERIES
from cohortspark.llm.media import load, load_media, padded, shape_of, store, store_texts

FOLDER = "/root/testdata/sf0.001"


def payloads():
    rng = np.random.default_rng(1)
    rare = rng.choice([0, 126, 127, 128, 129, 130, 255], 64 * 90).astype(np.uint8)
    sparse = np.where(rng.random(64 * 60) < 0.05, rng.integers(0, 256, 64 * 60), 128).astype(np.uint8)
    return [padded(None), padded("a"), padded("é" * 500), rng.integers(0, 256, 64 * 400, np.uint8).tobytes(), bytes([128] * 64 * 13), padded("x" * 64 * 6 * 70),
            rare.tobytes(), sparse.tobytes(), padded("".join(map(chr, range(1, 3000))))]


def test_payloads_come_back():
    p = payloads()
    assert load(store(p))[0] == p
    for x in p:  # alone or in company, the bytes are the same
        media = store([x])
        assert media == [store(p)[p.index(x)]] and load(media)[0] == [x]


def test_shapes():
    assert shape_of(1) == (1, 1) and shape_of(6 * 64 + 1) == (64, 2)
    wide, high = shape_of(6 * 64 * 5000)
    assert high <= 4095 and wide * high >= 64 * 5000


def test_extreme_coefficients():
    rng = np.random.default_rng(3)
    c = rng.choice([-500, -255, -1, 0, 0, 0, 1, 2, 3, 255, 511], (6 * 6, 64)).astype(np.int16)
    heads, blocks = decode(encode([(3, 2)], c, [b""]))
    assert (blocks[0] == c).all() and (heads[0].width, heads[0].height) == (48, 32)


def java_read(spark, data):
    jvm = spark._jvm
    jvm.java.lang.System.setProperty("java.awt.headless", "true")
    image = jvm.javax.imageio.ImageIO.read(jvm.java.io.ByteArrayInputStream(data))
    w, h = image.getWidth(), image.getHeight()
    packed = np.array(list(image.getRGB(0, 0, w, h, None, 0, w)), np.int64).reshape(h, w)
    return np.stack((packed >> 16 & 255, packed >> 8 & 255, packed & 255), -1)


def java_write(spark, tensor, quality):
    jvm = spark._jvm
    h, w, _ = tensor.shape
    image = jvm.java.awt.image.BufferedImage(w, h, 1)
    rgb = tensor.astype(np.int64)
    for y in range(h):
        for x in range(w):
            image.setRGB(x, y, int(rgb[y, x, 0] << 16 | rgb[y, x, 1] << 8 | rgb[y, x, 2]))
    writer = jvm.javax.imageio.ImageIO.getImageWritersByFormatName("jpeg").next()
    param = writer.getDefaultWriteParam()
    param.setCompressionMode(2)
    param.setCompressionQuality(quality)
    param.setProgressiveMode(1)
    out = jvm.java.io.ByteArrayOutputStream()
    writer.setOutput(jvm.javax.imageio.ImageIO.createImageOutputStream(out))
    writer.write(None, jvm.javax.imageio.IIOImage(image, None, None), param)
    writer.getOutput().flush()
    return bytes(out.toByteArray())


@pytest.mark.parametrize("quality", [0.3, 0.9])
def test_images_of_another_writer(spark, quality):
    y, x = np.mgrid[0:45, 0:61]
    tensor = np.stack((x * 4, y * 5, (x + y) * 2), -1).astype(np.uint8)
    tensor[10:20, 10:30] = (200, 30, 60)
    data = java_write(spark, tensor, quality)
    head = Image(data)
    assert len(head.scans) > 3 and head.scans[0]["interval"] == 0
    mine = pixels(*decode([data, data]))[1].astype(int)
    other = java_read(spark, data)
    assert mine.shape == other.shape == tensor.shape
    assert np.abs(mine - other).mean() < 3  # chroma may be smoothed there


def test_another_reader_sees_the_same_image(spark):
    """Without chroma both conversions agree to a step."""
    rng = np.random.default_rng(5)
    c = np.zeros((6 * 4, 64), np.int16)
    c[unit_rows(2, 2)[:, :4].ravel()] = rng.integers(-9, 10, (16, 64))
    data = encode([(2, 2)], c, [b""])[0]
    assert np.abs(pixels(*decode([data]))[0].astype(int) - java_read(spark, data)).max() <= 1


def test_broken_media():
    data = store([padded("some text " * 50)])[0]
    for bad in (b"", b"\xff\xd8", data[:-40], data.replace(b"\xff\xc2", b"\xff\xc0")):
        with pytest.raises((ValueError, IndexError, AttributeError)):
            decode([bad])


def test_columns(make_docs):
    texts = [None, "", "one", "one", "x" * 200_000, "ü" * 33]
    df = load_media(store_texts(make_docs(texts).withColumnRenamed("lang", "width")))
    rows = {r.doc_id: r for r in df.collect()}
    for i, t in enumerate(texts):
        assert bytes(rows[i].payload) == padded(t) and rows[i].n_bytes == len((t or "").encode())
        assert len(rows[i].tensor.rgb) == rows[i].tensor.height * rows[i].tensor.width * 3
    assert bytes(rows[2].media) == bytes(rows[3].media) and rows[2].feature == rows[3].feature and rows[0].feature == rows[1].feature
    assert load_media(store_texts(make_docs([]))).count() == 0
    assert {bytes(r.media) for r in store_texts(make_docs(texts).withColumn("media", F.lit(1))).collect()} == {bytes(r.media) for r in rows.values()}


def test_query(spark):
    text = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    rows = QUERIES["op4_media"](spark, FOLDER).collect()
    assert len(rows) == len(text)
    for r in rows:
        p = padded(text[r.doc_id])
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len((text[r.doc_id] or "").encode()), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-64:]))
        assert r.media_sha256 == hashlib.sha256(store([p])[0]).hexdigest() and r.media_bytes == len(store([p])[0])
