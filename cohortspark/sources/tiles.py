"""Binary tile index: 64-byte header, 40-byte image block, fixed-size chunk records.

Of a container only the header, the image block and the chunk table are read, by their offsets; payloads, which are
nearly all of it, are not touched by ``read_tile_index``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

# Fixed values.
PIXEL_TYPES = {1: "int8", 2: "uint8", 3: "int16", 4: "uint16", 5: "int32", 6: "uint32", 9: "float32", 10: "float64"}

_INTS = ("pixel_type", "samples_per_tile", "compression", "tile_x", "tile_y", "col", "row", "channel", "level", "nbytes")
TILE_SCHEMA = "path string, problem string, file_bytes bigint, offset bigint, " + ", ".join(f"{n} int" for n in _INTS)
_SHAPE = pa.schema([("path", pa.string()), ("problem", pa.string()), ("file_bytes", pa.int64()), ("offset", pa.int64()), *((n, pa.int32()) for n in _INTS)])
#: Chunk records read and sent at a time, and files whose tables one task reads.
BATCH_ROWS, FILES_A_TASK = 50_000, 32

Read = Callable[[int, int], bytes]


def parse_index(read: Read, size: int, batch_rows: int = BATCH_ROWS) -> Iterator[tuple[str | None, np.ndarray | None, np.ndarray | None]]:
    """``(problem, chunk records, fields of the image block)``, some records at a time; ``read(offset, n)`` gives bytes."""
    head = read(0, min(size, 64))
    if size < 64 or head[:4] != b"SIS\x00":
        yield "bad magic", None, None
        return
    n_dim = int(np.frombuffer(head, "<u4", 1, 12)[0])
    block, at = (int(v) for v in np.frombuffer(head, "<u8", 3, 16)[::2])
    n = int(np.frombuffer(head, "<u4", 1, 40)[0])
    if not 2 <= n_dim <= 8:
        yield "implausible dimension count", None, None
        return
    image = read(block, 40) if block + 40 <= size else b""
    if image[:4] != b"ETS\x00":
        yield "image block missing", None, None
        return
    rec = np.dtype([("pad", "<i4"), ("at", "<i4", (n_dim,)), ("offset", "<u8"), ("nbytes", "<i4"), ("end", "<i4")])
    if at + n * rec.itemsize > size:
        yield "chunk table runs past the end of the file", None, None
        return
    kind = np.frombuffer(image, "<i4", 8, 8)
    for i in range(0, n, batch_rows):
        k = min(batch_rows, n - i)
        yield None, np.frombuffer(read(at + i * rec.itemsize, k * rec.itemsize), rec, k), kind


Cells = tuple[int, dict[str, object]]


def _cells(path: str, size: int, read: Read, batch_rows: int) -> Iterator[Cells]:
    """How many rows, and their columns: an array, or a value that all rows have."""
    for problem, c, kind in parse_index(read, size, batch_rows):
        own: dict[str, object] = {"path": path, "problem": problem, "file_bytes": size}
        if c is not None:
            own |= {"offset": c["offset"].astype("int64"), "nbytes": c["nbytes"], "col": c["at"][:, 0], "row": c["at"][:, 1],
                    "channel": c["at"][:, 2] if c["at"].shape[1] >= 4 else 0, "level": c["at"][:, -1],
                    **{n: int(kind[i]) for n, i in (("pixel_type", 0), ("samples_per_tile", 1), ("compression", 3), ("tile_x", 5), ("tile_y", 6))}}
        yield 1 if c is None else len(c), own


def gathered(cells: Iterator[Cells], batch_rows: int = BATCH_ROWS) -> Iterator[pa.RecordBatch]:
    """Batches of about ``batch_rows``; a bad file is one row with NULL chunk cells."""

    def batch(held: list[Cells]) -> pa.RecordBatch:
        counts = np.array([k for k, _ in held])
        bad = np.repeat([c["problem"] is not None for _, c in held], counts)
        texts = [pa.array(np.repeat(np.array([c[n] for _, c in held], object), counts), pa.string()) for n in ("path", "problem")]
        numbers = [np.concatenate([np.broadcast_to(np.asarray(c.get(f.name, 0)), k) for k, c in held]) for f in list(_SHAPE)[2:]]
        return pa.RecordBatch.from_arrays([*texts, *(pa.array(v, f.type, mask=None if f.name == "file_bytes" else bad) for f, v in zip(list(_SHAPE)[2:], numbers, strict=True))], schema=_SHAPE)

    held: list[Cells] = []
    n = 0
    for k, c in cells:
        held.append((k, c))
        n += k
        if n >= batch_rows:
            yield batch(held)
            held, n = [], 0
    if held:
        yield batch(held)


def index_rows(path: str, size: int, read: Read, batch_rows: int = BATCH_ROWS) -> Iterator[pa.RecordBatch]:
    """One row per chunk of a container; ``read(offset, n)`` gives bytes of it."""
    return gathered(_cells(path, size, read, batch_rows), batch_rows)


def _small_cells(buf: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, dict[str, np.ndarray]]:
    """Problems, numbers of chunks, and the chunks' columns of many containers in one buffer, read column by column.

    The checks are those of ``parse_index``, in its order. Chunks come container by container; a bad container has one row.
    """

    def take(at: np.ndarray, kind: str, count: int = 1) -> np.ndarray:
        width = np.dtype(kind).itemsize * count
        return buf[at[:, None] + np.arange(width)].view(kind)

    k = len(starts)
    problem = np.full(k, None, object)
    left = np.ones(k, bool)

    def refuse(where: np.ndarray, bad: np.ndarray, text: str) -> np.ndarray:
        problem[where[bad]] = text
        left[where[bad]] = False
        return where[~bad]

    live = refuse(np.arange(k), sizes < 64, "bad magic")
    live = refuse(live, take(starts[live], "<u4")[:, 0] != int.from_bytes(b"SIS\0", "little"), "bad magic")
    dims = np.zeros(k, "int64")
    dims[live] = take(starts[live] + 12, "<u4")[:, 0]
    live = refuse(live, (dims[live] < 2) | (dims[live] > 8), "implausible dimension count")
    block, at, n = np.zeros(k, "uint64"), np.zeros(k, "uint64"), np.zeros(k, "int64")
    block[live], at[live], n[live] = take(starts[live] + 16, "<u8")[:, 0], take(starts[live] + 32, "<u8")[:, 0], take(starts[live] + 40, "<u4")[:, 0]
    live = refuse(live, (sizes[live] < 40) | (block[live] > np.maximum(sizes[live] - 40, 0).astype("uint64")), "image block missing")
    live = refuse(live, take(starts[live] + block[live].astype("int64"), "<u4")[:, 0] != int.from_bytes(b"ETS\0", "little"), "image block missing")
    width = 20 + 4 * dims
    room = sizes[live] - n[live] * width[live]
    live = refuse(live, (room < 0) | (at[live] > np.maximum(room, 0).astype("uint64")), "chunk table runs past the end of the file")

    counts = np.where(left, n, 1)
    total = int(counts.sum())
    first = np.cumsum(counts) - counts
    out = {f: np.zeros(total, "int64" if f == "offset" else "int32") for f in ("offset", *_INTS)}
    image = np.zeros((k, 8), "int32")
    image[live] = take(starts[live] + block[live].astype("int64") + 8, "<i4", 8)
    for d in np.unique(dims[live]):
        some = live[(dims[live] == d) & (n[live] > 0)]
        if not len(some):
            continue
        own = np.repeat(some, n[some])
        step = np.arange(len(own)) - np.repeat(np.cumsum(n[some]) - n[some], n[some])
        rec = starts[own] + at[own].astype("int64") + step * width[own]
        to = first[own] + step
        places = take(rec + 4, "<i4", int(d))
        out["col"][to], out["row"][to], out["level"][to] = places[:, 0], places[:, 1], places[:, -1]
        if d >= 4:
            out["channel"][to] = places[:, 2]
        out["offset"][to] = take(rec + 4 + 4 * int(d), "<u8")[:, 0].astype("int64")
        out["nbytes"][to] = take(rec + 12 + 4 * int(d), "<i4")[:, 0]
        for f, i in (("pixel_type", 0), ("samples_per_tile", 1), ("compression", 3), ("tile_x", 5), ("tile_y", 6)):
            out[f][to] = image[own, i]
    return problem, counts, out


#: Bytes of containers of a table that are decoded together, and the largest that is; larger ones are decoded alone.
BYTES_AT_ONCE, LARGEST_TOGETHER = 4 << 20, 1 << 20


def decode_tile_index(files: DataFrame, batch_rows: int = BATCH_ROWS) -> DataFrame:
    """The chunks of ``(path, content)`` rows, for containers that are in a table already.

    Small containers are decoded many at a time, column by column. Memory is one container plus one batch; files are better read by ``read_tile_index``.
    """

    def together(paths: pa.Array, buf: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> pa.RecordBatch:
        problem, counts, columns = _small_cells(buf, starts, sizes)
        own = np.repeat(np.arange(len(counts)), counts)
        bad = np.array([p is not None for p in problem], bool)[own]
        texts = [paths.take(pa.array(own)).cast(pa.string()), pa.array(problem, pa.string()).take(pa.array(own)), pa.array(sizes[own], pa.int64())]
        return pa.RecordBatch.from_arrays([*texts, *(pa.array(columns[f.name], f.type, mask=bad) for f in list(_SHAPE)[3:])], schema=_SHAPE)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            content = batch.column("content").cast(pa.large_binary())
            ends = np.frombuffer(content.buffers()[1], "<i8")[content.offset : content.offset + len(content) + 1]
            data = content.buffers()[2]
            buf = np.frombuffer(data, "u1") if data is not None else np.zeros(0, "u1")
            starts, sizes = ends[:-1], np.where(np.asarray(content.is_null().to_numpy(zero_copy_only=False)), 0, np.diff(ends))
            i = 0
            while i < len(content):
                if sizes[i] > LARGEST_TOGETHER:
                    read = lambda at, n, i=i: buf[starts[i] + at : starts[i] + at + n].tobytes()
                    yield from index_rows(batch.column("path")[i].as_py(), int(sizes[i]), read, batch_rows)
                    i += 1
                    continue
                fits = (np.cumsum(sizes[i:]) <= BYTES_AT_ONCE) & (sizes[i:] <= LARGEST_TOGETHER)
                j = i + max(1, int(np.argmin(fits)) if not fits.all() else len(fits))
                yield together(batch.column("path").slice(i, j - i), buf, starts[i:j], sizes[i:j])
                i = j

    return files.select("path", "content").mapInArrow(rows, TILE_SCHEMA)


class _Files(InputPartition):
    def __init__(self, files: list[tuple[str, int]]):
        super().__init__(None)
        self.files = files


class _Reader(DataSourceReader):
    """Plans a partition for some files (names and sizes are all the driver sees) and reads their tables by ranges."""

    def __init__(self, options: dict[str, str]):
        self.path, self.ending, self.files = options["path"], options.get("ending", ""), int(options.get("files", FILES_A_TASK))

    def partitions(self) -> list[InputPartition]:
        import pyarrow.fs as pafs

        store, folder = pafs.FileSystem.from_uri(_uri(self.path))
        found = sorted((f.path, f.size) for f in store.get_file_info(pafs.FileSelector(folder, recursive=True)) if f.is_file and f.path.endswith(self.ending) and not f.base_name.startswith(("_", ".")))
        return [_Files(found[i : i + self.files]) for i in range(0, len(found), self.files)] or [_Files([])]

    def read(self, partition: _Files) -> Iterator[pa.RecordBatch]:
        import pyarrow.fs as pafs

        store, _ = pafs.FileSystem.from_uri(_uri(self.path))

        def rows() -> Iterator[Cells]:
            for path, size in partition.files:
                with store.open_input_file(path) as f:
                    yield from _cells(path, size, lambda at, n, f=f: f.read_at(n, at), BATCH_ROWS)

        yield from gathered(rows())


def _uri(path: str) -> str:
    return f"file://{path}" if path.startswith("/") else path.replace("file:/", "file:///", 1) if path.startswith("file:/") and not path.startswith("file://") else path


class TileIndexSource(DataSource):
    """``spark.read.format("tile_index").load(folder)``; options ``ending`` of file names and ``files`` a task."""

    @classmethod
    def name(cls) -> str:
        return "tile_index"

    def schema(self) -> str:
        return TILE_SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(dict(self.options))


def read_tile_index(spark: SparkSession, folder: str, ending: str = "", files: int = FILES_A_TASK) -> DataFrame:
    """The chunks of all containers below a folder (as ``pyarrow.fs`` names it), from their headers and chunk tables alone."""
    spark.dataSource.register(TileIndexSource)
    return spark.read.format("tile_index").option("ending", ending).option("files", files).load(folder)
