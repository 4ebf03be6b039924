"""Progressive JPEG in numpy, many images at a time.

Decoding accumulates all scans of all images into one array of coefficients. Restart intervals
start afresh at a byte, so every interval of every image is a lane of its own, and lanes advance
together: one step decodes one symbol in each. DC and AC scans, first passes and refinements,
any sampling factors, restart intervals and runs of ended blocks are handled; without restarts
an image's scan is a single lane. Then one matrix product turns coefficients to samples, chroma is
repeated to full resolution, and images become RGB tensors.

The writer stores chosen coefficients without loss. Its script has a DC scan and its refinement,
and for each component low AC coefficients in three passes of one more bit each and the high ones
in one. Huffman tables follow from a rule.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np

SUBSAMPLED = 6  # blocks of a unit: four of luma, one of each chroma
LOW, HIGH = (1, 5), (6, 63)
#: Blocks between restarts in AC scans.
RESTART = 4


@lru_cache(1)
def zigzag() -> np.ndarray:
    """Natural position of each coefficient in scan order."""
    return np.array(sorted(range(64), key=lambda p: (s := p // 8 + p % 8, p // 8 if s % 2 else p % 8)))


@lru_cache(1)
def basis() -> np.ndarray:
    """Samples of each coefficient in scan order: 64 x 64."""
    x = np.arange(8)
    one = np.cos((2 * x[None] + 1) * x[:, None] * np.pi / 16) * np.where(x[:, None] == 0, np.sqrt(1 / 8), 0.5)
    return np.einsum("uy,vx->uvyx", one, one).reshape(64, 64)[zigzag()]


def canonical(counts: list[int], symbols: list[int]) -> list[tuple[int, int, int]]:
    """(symbol, code, bits) of a Huffman table as it is stored."""
    out, code, at = [], 0, 0
    for bits, n in enumerate(counts, 1):
        for s in symbols[at : at + n]:
            out.append((s, code, bits))
            code += 1
        at += n
        code <<= 1
    return out


@lru_cache(1)
def own_tables() -> tuple[tuple[list[int], list[int]], tuple[list[int], list[int]]]:
    """DC and AC tables of the writer: 4 bits for likely symbols, 7 for the next, 11 for all others."""
    often = [0, *range(1, 9)]
    seldom = list(range(17, 25))
    rest = [s for s in range(256) if s not in often and s not in seldom]
    counts = lambda **k: [k.get(f"b{i}", 0) for i in range(1, 17)]
    return (counts(b4=12), list(range(12))), (counts(b4=len(often), b7=len(seldom), b11=len(rest)), often + seldom + rest)


@lru_cache(4096)
def unit_rows(wide: int, high: int) -> np.ndarray:
    """Rows of a unit's six blocks in an image's blocks: luma in raster order, then each chroma."""
    y, x = np.divmod(np.arange(wide * high), wide)
    luma = (2 * y[:, None] + [0, 0, 1, 1]) * (2 * wide) + 2 * x[:, None] + [0, 1, 0, 1]
    chroma = 4 * wide * high + np.arange(wide * high)[:, None] + [0, wide * high]
    return np.hstack((luma, chroma))


def pack(values: np.ndarray, bits: np.ndarray, lane: np.ndarray, lanes: int) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of at most 57 bits as bytes, each lane padded with ones to whole bytes; and the lanes' sizes."""
    total = np.bincount(lane, bits, lanes).astype(np.int64)
    size = (total + 7) >> 3
    end = np.cumsum(bits)
    lane_end = np.cumsum(total)
    at = end - bits + ((np.cumsum(size) - size) * 8 - (lane_end - total))[lane]
    words = np.zeros(int(size.sum()) // 8 + 2, np.uint64)
    word, shift = at >> 6, at & 63
    over = shift + bits - 64
    first = np.where(over > 0, values >> np.maximum(over, 0).astype(np.uint64), values << np.maximum(-over, 0).astype(np.uint64))
    if len(word):
        new = np.flatnonzero(np.diff(word, prepend=-1))
        words[word[new]] = np.add.reduceat(first, new)
        rest = np.flatnonzero(over > 0)
        words[word[rest] + 1] |= values[rest] << (64 - over[rest]).astype(np.uint64)  # at most one token crosses into a word
    data = np.frombuffer(words.byteswap().tobytes(), np.uint8)[: int(size.sum())].copy()
    last = np.cumsum(size) - 1
    data[last] |= ((1 << (size * 8 - total)) - 1).astype(np.uint8)
    return data, size


def stuff(data: np.ndarray, size: np.ndarray, image: np.ndarray) -> list[bytes]:
    """Entropy-coded data of each image: a zero behind each 255, restart markers between its lanes."""
    new = np.diff(image, append=-1) != 0  # the image's last lane
    number = np.arange(len(size)) - np.maximum.accumulate(np.where(np.append(True, new[:-1]), np.arange(len(size)), 0))
    markers = np.cumsum(~new) - ~new
    full = data == 255
    stuffed = np.cumsum(full)
    at = np.arange(len(data)) + stuffed - full + np.repeat(2 * markers, size)
    last = np.cumsum(size) - 1
    end = at[last] + 1 + full[last]
    out = np.zeros(int(end[-1]) + 2, np.uint8)
    out[at] = data
    between = np.flatnonzero(~new)
    out[end[between]] = 255
    out[end[between] + 1] = 0xD0 + number[between] % 8
    stops = end[new]
    whole = out.tobytes()
    return [whole[a:b] for a, b in zip(np.append(0, stops[:-1]).tolist(), stops.tolist(), strict=True)]


def _size_of(x: np.ndarray) -> np.ndarray:
    """Bits of a magnitude."""
    return np.frexp(x.astype(np.float64))[1].astype(np.int64)


@lru_cache(2)
def _codes(which: int) -> tuple[np.ndarray, np.ndarray]:
    code, bits = np.zeros(256, np.uint64), np.zeros(256, np.int64)
    for s, c, n in canonical(*own_tables()[which]):
        code[s], bits[s] = c, n
    return code, bits


def _signed(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Size and extra bits of values."""
    size = _size_of(np.abs(v))
    return size, np.where(v < 0, v + (1 << size) - 1, v).astype(np.uint64)


def dc_tokens(dc: np.ndarray, low: int) -> tuple[np.ndarray, np.ndarray]:
    """Tokens (units x 6) of the first DC scan; predictions start afresh in every unit."""
    v = dc.astype(np.int64) >> low
    v[:, 1:4] -= v[:, :3].copy()
    size, extra = _signed(v)
    code, bits = _codes(0)
    return code[size] << size.astype(np.uint64) | extra, bits[size] + size


@lru_cache(1)
def _ac_table() -> tuple[np.ndarray, np.ndarray]:
    """Token and bits of a value after a run, at ``run * 1024 + value + 512``."""
    v = np.arange(-512, 512)
    size, extra = _signed(v)
    code, bits = _codes(1)
    symbol = np.arange(16)[:, None] << 4 | size
    return (code[symbol] << size.astype(np.uint64) | extra).astype(np.uint32).ravel(), (bits[symbol] + size).astype(np.uint8).ravel()


def ac_first_tokens(c: np.ndarray, low: int) -> tuple[np.ndarray, np.ndarray]:
    """Tokens (blocks x coefficients + 1) of a first AC pass; the last column ends the block."""
    v = np.sign(c) * (np.abs(c) >> low) if low else c
    if np.abs(v).max(initial=0) > 511:
        raise ValueError("coefficients of at most 511")
    n, m = v.shape
    full = v != 0
    at = np.arange(m, dtype=np.int8)
    before = np.maximum.accumulate(np.where(full, at, np.int8(-1)), axis=1)
    run = np.empty((n, m), np.int16)
    run[:, 0], run[:, 1:] = 0, at[1:] - before[:, :-1] - 1
    code, bits = _codes(1)
    values, lengths = _ac_table()
    index = (run & 15) * np.int32(1024) + v + np.int32(512)
    value, length = np.zeros((n, m + 1), np.uint64), np.zeros((n, m + 1), np.int64)
    value[:, :m], length[:, :m] = values.take(index), lengths.take(index)
    while (long := np.flatnonzero(full & (run > 15))).size:  # runs of sixteen zeros go before
        y, x = np.divmod(long, m)
        value[y, x] |= code[0xF0] << length[y, x].astype(np.uint64)
        length[y, x] += bits[0xF0]
        run[y, x] -= 16
    value[:, :m][~full] = 0
    length[:, :m][~full] = 0
    ended = ~full[:, -1]
    value[ended, m], length[ended, m] = code[0], bits[0]
    return value, length


def fold(value: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Neighbouring tokens of a block as one, while all fit 57 bits."""
    while value.shape[1] > 1 and 2 * length.max(initial=0) <= 57:
        if value.shape[1] % 2:
            value, length = (np.hstack((x, np.zeros((len(x), 1), x.dtype))) for x in (value, length))
        value = value[:, ::2] << length[:, 1::2].astype(np.uint64) | value[:, 1::2]
        length = length[:, ::2] + length[:, 1::2]
    return value, length


def ac_refine_tokens(c: np.ndarray, low: int) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of a refinement over at most 16 coefficients, so no run is too long for a symbol."""
    c = c.astype(np.int64)
    n, m = c.shape
    if m > 16:
        raise ValueError("a band of at most 16 coefficients")
    code, bits = _codes(1)
    value, length = np.zeros((n, m + 1), np.uint64), np.zeros((n, m + 1), np.int64)
    held, count, run = np.zeros(n, np.uint64), np.zeros(n, np.int64), np.zeros(n, np.int64)
    for k in range(m):
        a = np.abs(c[:, k]) >> low
        fresh, old = a == 1, a > 1
        symbol = run << 4 | 1
        token = (code[symbol] << np.uint64(1) | (c[:, k] > 0)) << count.astype(np.uint64) | held
        value[:, k], length[:, k] = np.where(fresh, token, np.uint64(0)), np.where(fresh, bits[symbol] + 1 + count, 0)
        held = np.where(old, held << np.uint64(1) | (a & 1).astype(np.uint64), np.where(fresh, np.uint64(0), held))
        count, run = np.where(old, count + 1, np.where(fresh, 0, count)), np.where(a == 0, run + 1, np.where(fresh, 0, run))
    ended = (run > 0) | (count > 0)
    value[:, m] = np.where(ended, code[0] << count.astype(np.uint64) | held, np.uint64(0))
    length[:, m] = np.where(ended, bits[0] + count, 0)
    return value, length


def _segment(marker: int, body: bytes) -> bytes:
    return bytes((255, marker)) + (len(body) + 2).to_bytes(2, "big") + body


@lru_cache(1)
def _tables() -> bytes:
    huffman = b"".join(bytes((kind << 4, *counts, *symbols)) for kind, (counts, symbols) in enumerate(own_tables()))
    return _segment(0xDB, bytes((0, *[1] * 64))) + _segment(0xC4, huffman)


def _scan(components: list[int], first: int, last: int, high: int, low: int) -> bytes:
    interval = 1 if len(components) > 1 else RESTART
    return _segment(0xDD, interval.to_bytes(2, "big")) + _segment(0xDA, bytes((len(components), *[x for c in components for x in (c, 0)], first, last, high << 4 | low)))


def encode(shapes: list[tuple[int, int]], coefficients: np.ndarray, notes: list[bytes]) -> list[bytes]:
    """JPEG bytes of images of (wide, high) units each; ``coefficients`` has the rows of all, as in ``unit_rows``."""
    units = np.array([w * h for w, h in shapes])
    base = SUBSAMPLED * (np.cumsum(units) - units)
    rows = np.vstack([unit_rows(w, h) + b for (w, h), b in zip(shapes, base.tolist(), strict=True)])
    image = np.repeat(np.arange(len(shapes)), units)
    parts = [[b"\xff\xd8", _segment(0xFE, note), _tables(),
              _segment(0xC2, bytes((8,)) + (16 * h).to_bytes(2, "big") + (16 * w).to_bytes(2, "big") + bytes((3, 1, 0x22, 0, 2, 0x11, 0, 3, 0x11, 0)))]
             for (w, h), note in zip(shapes, notes, strict=True)]

    def add(head: bytes, value: np.ndarray, length: np.ndarray, lane: np.ndarray, of: np.ndarray) -> None:
        value, length = fold(value, length)
        used = length > 0
        data, size = pack(value[used], length[used], np.broadcast_to(lane[:, None], length.shape)[used], len(of))
        for p, d in zip(parts, stuff(data, size, of), strict=True):
            p += head, d

    dc = coefficients[rows, 0]
    add(_scan([1, 2, 3], 0, 0, 0, 1), *dc_tokens(dc, 1), np.arange(len(rows)), image)
    blocks = []
    for c, (first, each) in enumerate(((0, 4), (4, 1), (5, 1)), 1):  # a component's blocks stand together, in raster order
        start = base + first * units
        n = each * units
        of = np.repeat(np.arange(len(units)), n)
        inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        lanes = -(-n // RESTART)
        lane = inner // RESTART + (np.cumsum(lanes) - lanes)[of]
        blocks.append((c, coefficients[start[of] + inner], lane, np.repeat(np.arange(len(units)), lanes)))
    for (a, b), high, low in ((LOW, 0, 2), (HIGH, 0, 0), (LOW, 2, 1)):
        for c, rest, lane, of in blocks:
            add(_scan([c], a, b, high, low), *(ac_refine_tokens if high else ac_first_tokens)(rest[:, a : b + 1], low), lane, of)
    add(_scan([1, 2, 3], 0, 0, 1, 0), (dc & 1).astype(np.uint64), np.ones(dc.shape, np.int64), np.arange(len(rows)), image)
    for c, rest, lane, of in blocks:
        add(_scan([c], *LOW, 1, 0), *ac_refine_tokens(rest[:, LOW[0] : LOW[1] + 1], 0), lane, of)
    return [b"".join([*p, b"\xff\xd9"]) for p in parts]


@lru_cache(64)
def _lookup(counts: bytes, symbols: bytes) -> np.ndarray:
    """For 16 bits ahead: bits of the code << 8 | symbol; 0 where no code stands."""
    out = np.zeros(1 << 16, np.int32)
    for s, code, bits in canonical(list(counts), list(symbols)):
        out[code << (16 - bits) : (code + 1) << (16 - bits)] = bits << 8 | s
    return out


#: What ends a scan: neither a stuffed zero nor a restart.
MARKER = re.compile(rb"\xff[^\x00\xd0-\xd7]")


class Image:
    """What an image's headers say: size, components, quantisation, and its scans with their tables."""

    def __init__(self, data: bytes):
        self.notes, self.scans, self.components = [], [], []
        quantisers: dict[int, list[int]] = {}
        tables: dict[int, tuple[bytes, bytes]] = {}
        interval, at = 0, 2
        if data[:2] != b"\xff\xd8":
            raise ValueError("not a JPEG")
        while True:
            while data[at] == 255 and data[at + 1] == 255:
                at += 1
            marker = data[at + 1]
            if data[at] != 255:
                raise ValueError("no marker where one should stand")
            if marker == 0xD9:
                break
            size = int.from_bytes(data[at + 2 : at + 4], "big")
            body, at = data[at + 4 : at + 2 + size], at + 2 + size
            if marker == 0xFE:
                self.notes.append(body)
            elif marker == 0xDD:
                interval = int.from_bytes(body, "big")
            elif marker == 0xDB:
                while body:
                    wide = 2 if body[0] >> 4 else 1
                    quantisers[body[0] & 15] = [int.from_bytes(body[1 + i * wide : 1 + (i + 1) * wide], "big") for i in range(64)]
                    body = body[1 + 64 * wide :]
            elif marker == 0xC4:
                while body:
                    n = sum(body[1:17])
                    tables[body[0]] = (body[1:17], body[17 : 17 + n])
                    body = body[17 + n :]
            elif marker == 0xC2:
                self.height, self.width = int.from_bytes(body[1:3], "big"), int.from_bytes(body[3:5], "big")
                self.components = [{"id": body[6 + 3 * i], "h": body[7 + 3 * i] >> 4, "v": body[7 + 3 * i] & 15, "q": body[8 + 3 * i]} for i in range(body[5])]
                self._lay_out()
            elif marker == 0xDA:
                ids = {c["id"]: i for i, c in enumerate(self.components)}
                chosen = [(ids[body[1 + 2 * i]], body[2 + 2 * i]) for i in range(body[0])]
                first, last, bits = body[-3:]
                used = [tables.get(t & 15 | 16) if first else tables.get(t >> 4) for _, t in chosen]
                end = MARKER.search(data, at).start()
                self.scans.append({"components": [c for c, _ in chosen], "tables": used, "band": (first, last, bits >> 4, bits & 15), "interval": interval, "data": (at, end)})
                at = end
            elif 0xC0 <= marker <= 0xCF:
                raise ValueError("not a progressive JPEG")
        for c in self.components:
            c["quantiser"] = quantisers[c["q"]]

    def _lay_out(self) -> None:
        """Rows of each component's blocks among the image's: padded to whole units."""
        h, v = max(c["h"] for c in self.components), max(c["v"] for c in self.components)
        self.wide, self.high, self.rows = -(-self.width // (8 * h)), -(-self.height // (8 * v)), 0
        for c in self.components:
            c["stride"], c["lines"], c["base"] = self.wide * c["h"], self.high * c["v"], self.rows
            c["own"] = (-(-self.width * c["h"] // (8 * h)), -(-self.height * c["v"] // (8 * v)))
            c["repeat"] = (h // c["h"], v // c["v"])
            self.rows += c["stride"] * c["lines"]

    def order(self, chosen: list[int]) -> np.ndarray:
        """Rows of a scan's units, one line a unit."""
        if len(chosen) == 1:
            c = self.components[chosen[0]]
            return _raster(*c["own"], c["stride"]) + c["base"]
        return _units(self.wide, self.high, tuple((c["h"], c["v"], c["stride"], c["base"]) for c in (self.components[i] for i in chosen)))


@lru_cache(4096)
def _raster(wide: int, high: int, stride: int) -> np.ndarray:
    return (np.arange(high)[:, None] * stride + np.arange(wide)).reshape(-1, 1)


@lru_cache(4096)
def _units(wide: int, high: int, components: tuple[tuple[int, int, int, int], ...]) -> np.ndarray:
    y, x = np.divmod(np.arange(wide * high)[:, None], wide)
    out = []
    for h, v, stride, base in components:
        dy, dx = np.divmod(np.arange(h * v), h)
        out.append(base + (y * v + dy) * stride + x * h + dx)
    return np.hstack(out)


class Bits:
    """Lanes of bits, without the stuffed zeros; each lane has its own position."""

    def __init__(self, data: np.ndarray, pieces: list[tuple[int, int]]):
        """``pieces``: the scans' stretches of ``data``; lanes are cut at restart markers. ``lanes``: how many each has."""
        sizes = np.array([b - a for a, b in pieces])
        starts = np.cumsum(sizes) - sizes
        raw = np.concatenate([data[a:b] for a, b in pieces])
        full = np.flatnonzero(raw[:-1] == 255)
        after = raw[full + 1]
        marks = full[after != 0]
        gone = np.zeros(len(raw), bool)
        gone[full + 1] = True
        gone[marks] = True
        shift = np.cumsum(gone) - gone
        cut = np.sort(np.concatenate((starts, marks + 2)))
        self.position = (cut - np.append(shift, shift[-1] + gone[-1])[cut]) * 8
        self.lanes = np.diff(np.searchsorted(cut, np.append(starts, len(raw))))
        kept = np.concatenate((raw[~gone], np.zeros(4, np.uint8))).astype(np.uint32)
        self.ahead = kept[:-3] << 24 | kept[1:-2] << 16 | kept[2:-1] << 8 | kept[3:]
        self.end = len(self.ahead)

    def peek(self, at: np.ndarray) -> np.ndarray:
        """The 16 bits from each position."""
        return (self.ahead.take(at >> 3, mode="clip") << (at & 7).astype(np.uint32) >> np.uint32(16)).astype(np.int32)

    def check(self) -> None:
        """No lane has read beyond the data."""
        if self.position.max(initial=0) > 8 * self.end:
            raise ValueError("a scan ends too early")


@lru_cache(64)
def _values(counts: bytes, symbols: bytes) -> np.ndarray:
    """For 16 bits ahead, where a code and its value fit: value << 16 | run << 8 | bits; else 0."""
    entry = _lookup(counts, symbols)
    bits, size, run = entry >> 8, entry & 15, entry >> 4 & 15
    extra = (np.arange(1 << 16) << np.minimum(bits, 16) & 0xFFFF) >> (16 - size)
    value = np.where(extra < HALF[size], extra + BELOW[size], extra)
    return np.where((bits > 0) & (size > 0) & (bits + size <= 16), value << 16 | run << 8 | bits + size, 0).astype(np.int32)


HALF = np.array([0, *(1 << i for i in range(15))], np.int32)
BELOW = np.array([0, *(1 - (1 << i) for i in range(1, 16))], np.int32)


def _symbol(bits: Bits, at: np.ndarray, table: np.ndarray, tables: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    entry = tables[(table << 16) + bits.peek(at)]
    if len(entry) and not entry.min():
        raise ValueError("no such code")
    return entry & 255, at + (entry >> 8)


def _dc(bits: Bits, scan: dict, flat: np.ndarray) -> None:
    _, _, high, low = scan["band"]
    lanes, first, count = scan["lane_table"], scan["first"], scan["count"]
    at, rows = bits.position, scan["rows"]
    component, names = scan["columns"], scan["tables_at"]
    last = np.zeros((len(lanes), max(component) + 1), np.int32)
    for u in range(int(count.max())):
        on = np.flatnonzero(count > u)
        p = at[on]
        for j, c in enumerate(component):
            row = rows[first[on] + u, j]
            if high:
                flat[row * 64] |= ((bits.peek(p) >> 15) << low).astype(flat.dtype)
                p = p + 1
                continue
            size, p = _symbol(bits, p, names[c][lanes[on]], scan["lookup"])
            v = bits.peek(p) >> (16 - size)
            v += np.where(v < HALF[size], BELOW[size], 0)
            p = p + size
            last[on, c] += v
            flat[row * 64] = last[on, c] << low
        at[on] = p


def _ac_first(bits: Bits, scan: dict, flat: np.ndarray) -> None:
    begin, end, _, low = scan["band"]
    first, count, names = scan["first"], scan["count"], scan["tables_at"][0][scan["lane_table"]] << 16
    at, rows, ended = bits.position, scan["rows"][:, 0], np.zeros(len(first), np.int64)
    values, one = scan["values"], scan["lookup"].size == 1 << 16
    for u in range(int(count.max())):
        on = np.flatnonzero(count > u)
        idle = ended[on] > 0
        ended[on[idle]] -= 1
        on = on[~idle]
        p, table = at[on], names[on]
        place = rows[first[on] + u] * 64 + begin
        stop = place + (end - begin)
        while len(on):
            ahead = bits.peek(p)
            entry = values.take(ahead if one else table + ahead)
            p += entry & 255
            place += entry >> 8 & 15
            rare = np.flatnonzero(entry == 0)
            if len(rare):  # an ended block, a run of zeros, or a long code
                symbol, q = _symbol(bits, p[rare], table[rare] >> 16, scan["lookup"])
                run, size = symbol >> 4, symbol & 15
                v = bits.peek(q) >> (16 - size)
                entry[rare] = (v + np.where(v < HALF[size], BELOW[size], 0)) << 16
                q += size
                place[rare] += run
                over = (size == 0) & (run < 15)
                ended[on[rare[over]]] = (1 << run[over]) - 1 + (bits.peek(q[over]) >> (16 - run[over]))
                q[over] += run[over]
                p[rare] = q
                place[rare[over]] = stop[rare[over]] + 1
                whole = np.ones(len(on), bool)
                whole[rare[size == 0]] = False
                if (place[whole] > stop[whole]).any():
                    raise ValueError("a run beyond the band")
                flat[place[whole]] = (entry[whole] >> 16) << low
            else:
                if (place > stop).any():
                    raise ValueError("a run beyond the band")
                flat[place] = (entry >> 16) << low
            place += 1
            done = place > stop
            if done.any():
                at[on[done]] = p[done]
                stay = ~done
                on, p, table, place, stop = on[stay], p[stay], table[stay], place[stay], stop[stay]


def _ac_refine(bits: Bits, scan: dict, flat: np.ndarray) -> None:
    begin, end, _, low = scan["band"]
    first, count, names = scan["first"], scan["count"], scan["tables_at"][0][scan["lane_table"]]
    at, rows, ended = bits.position, scan["rows"][:, 0], np.zeros(len(first), np.int64)
    step = 1 << low
    for u in range(int(count.max())):
        on = np.flatnonzero(count > u)
        p, row, table = at[on], rows[first[on] + u] * 64, names[on]
        over = ended[on] > 0
        ask, run, new = ~over, np.zeros(len(on), np.int64), np.zeros(len(on), np.int64)
        for k in range(begin, end + 1):
            some = np.flatnonzero(ask)
            if len(some):
                symbol, q = _symbol(bits, p[some], table[some], scan["lookup"])
                r, size = symbol >> 4, symbol & 15
                fresh = size > 0
                new[some] = np.where(fresh, np.where(bits.peek(q) >> 15 > 0, step, -step), 0)
                q += fresh
                stop = ~fresh & (r < 15)
                if stop.any():
                    n = r[stop]
                    ended[on[some[stop]]] = (1 << n) + (bits.peek(q[stop]) >> (16 - n))
                    q[stop] += n
                    over[some[stop]] = True
                p[some], run[some], ask[some] = q, r, False
            now = flat[row + k].astype(np.int64)
            old = np.flatnonzero(now)
            if len(old):
                more = bits.peek(p[old]) >> 15
                p[old] += 1
                value = now[old]
                flat[row[old] + k] = value + np.sign(value) * step * (more & ((np.abs(value) & step) == 0))
            empty = (now == 0) & ~over
            take = empty & (run == 0)
            flat[row[take] + k] = new[take]
            ask |= take
            run -= empty & ~take
        ended[on[over]] -= 1
        at[on] = p


def decode(images: list[bytes]) -> tuple[list[Image], list[np.ndarray]]:
    """Headers, and coefficients (blocks x 64, in scan order) of each image."""
    heads = [Image(x) for x in images]
    base = np.cumsum([0, *(h.rows for h in heads)])
    flat = np.zeros(int(base[-1]) * 64, np.int16)
    sizes = np.cumsum([0, *(len(x) for x in images)])
    data = np.frombuffer(b"".join(images), np.uint8)
    # Scans of one component build on each other; those of different components or images go together.
    turns: dict[tuple, list[tuple[int, dict]]] = {}
    for i, h in enumerate(heads):
        seen: dict[tuple, int] = {}
        for s in h.scans:
            key = (s["components"][0] if s["band"][0] else tuple(s["components"]), s["band"][0] > 0)
            turn = seen[key] = seen.get(key, -1) + 1
            shape = 0 if s["band"][0] else tuple((c, h.components[c]["h"] * h.components[c]["v"]) for c in s["components"])
            turns.setdefault((turn, s["band"], shape), []).append((i, s))
    for (_, band, shape), group in sorted(turns.items(), key=lambda x: str(x[0][0]).zfill(6)):
        bits = Bits(data, [(int(sizes[i]) + s["data"][0], int(sizes[i]) + s["data"][1]) for i, s in group])
        rows, first, count, n = [], [], [], 0
        for (i, s), lanes in zip(group, bits.lanes.tolist(), strict=True):
            own = heads[i].order(s["components"]) + int(base[i])
            each = s["interval"] or len(own)
            if lanes != -(-len(own) // each):
                raise ValueError("restart markers are missing")
            begin = np.arange(0, len(own), each)
            rows.append(own)
            first.append(begin + n)
            count.append(np.minimum(each, len(own) - begin))
            n += len(own)
        known: dict = {}
        chosen = [[known.setdefault(t, len(known)) for t in s["tables"]] for _, s in group]
        lane_table = np.repeat(np.arange(len(group)), bits.lanes)
        scan = {"band": band, "rows": np.vstack(rows), "first": np.concatenate(first), "count": np.concatenate(count), "lane_table": lane_table,
                "tables_at": np.array(chosen, np.int64).T, "lookup": np.concatenate([_lookup(*t) if t else np.zeros(1 << 16, np.int32) for t in known]),
                "values": np.concatenate([_values(*t) if t else np.zeros(1 << 16, np.int32) for t in known])}
        if not band[0]:
            scan["columns"] = [j for j, (_, n) in enumerate(shape) for _ in range(n if len(shape) > 1 else 1)]
            _dc(bits, scan, flat)
        else:
            (_ac_refine if band[2] else _ac_first)(bits, scan, flat)
        bits.check()
    blocks = flat.reshape(-1, 64)
    return heads, [blocks[a:b] for a, b in zip(base[:-1], base[1:], strict=True)]


def samples(blocks: np.ndarray) -> np.ndarray:
    """Samples 0 to 255 of dequantised blocks (n x 64). What lies on a half goes up, however the product was split."""
    return np.clip(np.floor(blocks.astype(np.float64) @ basis() + (128.5 + 1e-6)), 0, 255).astype(np.uint8)


def pixels(heads: list[Image], coefficients: list[np.ndarray]) -> list[np.ndarray]:
    """Tensors height x width x 3 (RGB) of images of three components, chroma repeated to full resolution."""
    scaled = [b if all(q == 1 for c in h.components for q in c["quantiser"]) else
              np.concatenate([b[c["base"] : c["base"] + c["stride"] * c["lines"]] * np.array(c["quantiser"]) for c in h.components]) for h, b in zip(heads, coefficients, strict=True)]
    every = samples(np.concatenate(scaled))
    out, at = [], 0
    for h in heads:
        planes = []
        for c in h.components:
            n = c["stride"] * c["lines"]
            planes.append(every[at : at + n].reshape(c["lines"], c["stride"], 8, 8).swapaxes(1, 2).reshape(8 * c["lines"], 8 * c["stride"]))
            at += n
        y, b, r = planes
        up = [lambda x, c=c: x.repeat(c["repeat"][1], 0).repeat(c["repeat"][0], 1)[: h.height, : h.width] for c in h.components]
        y = up[0](y).astype(np.int16)
        tensor = np.empty((*y.shape, 3), np.uint8)
        tensor[..., 0] = np.clip(y + up[2](RED[r]), 0, 255)
        tensor[..., 1] = np.clip(y + (up[2](GREEN[1][r]) + up[1](GREEN[0][b]) + 32768 >> 16), 0, 255)
        tensor[..., 2] = np.clip(y + up[1](BLUE[b]), 0, 255)
        out.append(tensor)
    return out


#: The usual conversion in whole 65536ths, by the chroma sample.
_CHROMA = np.arange(256, dtype=np.int32) - 128
RED, BLUE = ((k * _CHROMA + 32768 >> 16).astype(np.int16) for k in (91881, 116130))
GREEN = tuple(k * _CHROMA for k in (-22554, -46802))
