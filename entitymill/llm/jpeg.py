"""Progressive JPEG in numpy: a writer of payloads, a general reader, and RGB tensors.

The reader accumulates the scans of any progressive file (spectral selection, successive
approximation, end-of-band runs, refinement, restart intervals, interleaved DC scans, sampling
factors) into coefficient arrays, transforms them back, upsamples chroma and gives RGB of full
size. Entropy-coded data are sequential inside a restart interval only, so the reader decodes all
intervals of all files of a batch side by side: in each step, every interval yields a symbol.

The format's unit is the coefficient. `write_payloads` stores byte b as coefficient b + 2 with
quantisers of 1, in 4:2:0 images: DC and AC 1-5 in two approximations, AC 6-63 in one band. That is
lossless; a comment segment holds the payload's length. A payload above TILE bytes is a sequence of
images. Files and tensors are made, read back and digested for TOGETHER bytes at a time, so beside the
rows that Arrow hands over memory is bounded, whatever a text's length.

Defined results: a null or empty text has 0 bytes and a payload of 64 bytes 0. Equal texts have
equal values. Rows that repeat, also with a null doc_id, each give a row. Other columns are not
read. An empty table gives an empty result.
"""

from __future__ import annotations

import functools
import hashlib
import math
import struct
import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Blocks (or MCUs) of a restart interval, payload bytes of one image, payload bytes of a batch.
RESTART, TILE, TOGETHER = 4, 1 << 20, 1 << 20
OFFSET = 2
BANDS = ((1, 5), (6, 63))


def _zigzag() -> np.ndarray:
    """Place in the 8 x 8 block (row-major) of each coefficient in scan order."""
    cells = sorted(((u + v, u if (u + v) % 2 else v, u, v) for u in range(8) for v in range(8)))
    return np.array([u * 8 + v for _, _, u, v in cells])


ZIGZAG = _zigzag()

#: Code lengths of the writer's tables, by symbol: DC sizes, AC of whole and halved bytes, EOB runs.
TABLES = {
    (0, 0): {0: 3, 1: 3, 2: 3, 3: 3, 4: 3, 5: 3, 6: 4, 7: 4, 8: 4, 9: 5},
    (1, 0): {7: 1, 6: 2, 8: 3, 4: 4, 9: 5, 5: 6, 3: 7, 2: 8},
    (1, 1): {6: 1, 5: 2, 7: 3, 3: 4, 8: 5, 4: 6, 2: 7, 1: 8},
    (1, 2): {0x20: 1, 0x10: 2, 0x00: 3},
}


def _codes(lengths: dict[int, int]) -> dict[int, tuple[int, int]]:
    """Canonical codes: symbol to (code, length)."""
    out, code, last = {}, 0, 0
    for symbol, n in sorted(lengths.items(), key=lambda x: x[1]):
        code <<= n - last
        out[symbol], last = (code, n), n
        code += 1
    return out


def _table_segment() -> bytes:
    body = b""
    for (kind, number), lengths in TABLES.items():
        symbols = sorted(lengths, key=lambda s: lengths[s])
        counts = [sum(n == i for n in lengths.values()) for i in range(1, 17)]
        body += bytes([kind << 4 | number, *counts, *symbols])
    return _segment(0xC4, body)


def _segment(marker: int, body: bytes) -> bytes:
    return struct.pack(">BBH", 0xFF, marker, len(body) + 2) + body


# ---------------------------------------------------------------- writer


@functools.lru_cache(maxsize=256)
def _mcu_order(w: int, h: int) -> np.ndarray:
    """The Y blocks (row-major numbers) of each of w x h MCUs."""
    y, x = np.divmod(np.arange(w * h), w)
    corner = 2 * y * 2 * w + 2 * x
    return np.stack([corner, corner + 1, corner + 2 * w, corner + 2 * w + 1], axis=1)


def _pack(codes: np.ndarray, bits: np.ndarray, interval: np.ndarray, n_intervals: int, last: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bit strings of intervals, padded, stuffed and with restart markers: bytes, ends by interval."""
    total = np.bincount(interval, bits, n_intervals).astype(np.int64)
    n_bytes = (total + 7) >> 3
    pad = n_bytes * 8 - total
    base = np.concatenate(([0], np.cumsum(n_bytes)[:-1]))
    before = np.cumsum(bits) - bits
    starts = np.concatenate(([0], np.cumsum(total)[:-1]))
    at = np.concatenate((before - starts[interval] + base[interval] * 8, base * 8 + total))
    codes, bits = np.concatenate((codes, (1 << pad) - 1)), np.concatenate((bits, pad))
    word = codes << (32 - bits - (at & 7))
    size, where = int(n_bytes.sum()), at >> 3
    raw = np.zeros(size + 4)
    for i in range(4):
        raw += np.bincount(where + i, (word >> (24 - 8 * i)) & 255, size + 4)
    raw = raw[:size].astype(np.uint8)
    stuffed = np.cumsum(raw == 255) - (raw == 255)
    owner = np.repeat(np.arange(n_intervals), n_bytes)
    marked = np.where(last, 0, 2)
    markers = np.cumsum(marked) - marked
    extra = np.bincount(owner, raw == 255, n_intervals).astype(np.int64)
    ends = np.cumsum(n_bytes + extra + marked)
    out = np.zeros(int(ends[-1]) if n_intervals else 0, np.uint8)
    out[np.arange(size) + stuffed + markers[owner]] = raw
    at = ends[~last]
    out[at - 2], out[at - 1] = 0xFF, 0xD0 + number[~last] % 8
    return out, ends


def _intervals(counts: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[int]]:
    """For scans of so many units: units of each interval, whether it is the scan's last, its number
    in the scan, and the intervals of each scan."""
    sizes, number, each = [], [], []
    for n in counts:
        k = -(-n // RESTART)
        s = np.full(k, RESTART)
        s[-1] = n - RESTART * (k - 1)
        sizes.append(s)
        number.append(np.arange(k))
        each.append(k)
    number_all = np.concatenate(number)
    last = np.zeros(len(number_all), bool)
    last[np.cumsum(each) - 1] = True
    return np.concatenate(sizes), last, number_all, each


def _scans_of(data: np.ndarray, ends: np.ndarray, each: list[int]) -> list[bytes]:
    stops = ends[np.cumsum(each) - 1]
    return [data[a:b].tobytes() for a, b in zip([0, *stops[:-1]], stops)]


def _sized(values: np.ndarray) -> np.ndarray:
    return np.frexp(np.abs(values).astype(np.float64))[1].astype(np.int64)


def _lookup(table: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    code, bits = np.zeros(256, np.int64), np.zeros(256, np.int64)
    for s, (c, n) in _codes(TABLES[table]).items():
        code[s], bits[s] = c, n
    return code, bits


def _coded(values: np.ndarray, table: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Code words of values with run 0: the symbol of the size, then the value's bits."""
    code, bits = _lookup(table)
    size = _sized(values)
    low = np.where(values < 0, values + (1 << size) - 1, values)
    return code[size] << size | low, bits[size] + size


def write_payloads(payloads: list[bytes]) -> list[bytes]:
    """A progressive JPEG for each payload (a positive multiple of 64 bytes)."""
    shapes, blocks = [], []
    for p in payloads:
        m = -(-len(p) // (64 * 6))
        w = max(1, math.isqrt(m))
        h = -(-m // w)
        shapes.append((w, h))
        full = np.zeros(w * h * 6 * 64, np.int64)
        full[: len(p)] = np.frombuffer(p, np.uint8)
        blocks.append(full.reshape(-1, 64) + OFFSET)
    coef = np.concatenate(blocks)
    areas = [w * h for w, h in shapes]
    starts = np.concatenate(([0], np.cumsum([6 * a for a in areas])[:-1]))

    # DC: interleaved, MCU by MCU
    order = np.concatenate([s + np.column_stack((_mcu_order(w, h), 4 * w * h + np.arange(w * h), 5 * w * h + np.arange(w * h))) for s, (w, h) in zip(starts, shapes)])
    sizes, last, number, each = _intervals(areas)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    dc = coef[order, 0]
    high = dc >> 1
    opens = np.concatenate(([True], owner[1:] != owner[:-1]))
    before = np.column_stack((np.concatenate(([0], high[:-1, 3])), high[:, 0], high[:, 1], high[:, 2], np.concatenate(([0], high[:-1, 4])), np.concatenate(([0], high[:-1, 5]))))
    before[opens, 0] = before[opens, 4] = before[opens, 5] = 0
    codes, bits = _coded((high - before).ravel(), (0, 0))
    six = np.repeat(owner, 6)
    dc_first = _scans_of(*_pack(codes, bits, six, len(sizes), last, number), each)
    dc_fine = _scans_of(*_pack((dc & 1).ravel(), np.ones(dc.size, np.int64), six, len(sizes), last, number), each)

    # AC: one scan for each component
    sizes, last, number, each = _intervals([n for a in areas for n in (4 * a, a, a)])
    owner = np.repeat(np.arange(len(sizes)), sizes)
    (a, b), (c, d) = BANDS
    low = coef[:, a : b + 1]
    codes, bits = _coded((low >> 1).ravel(), (1, 1))
    ac_first = _scans_of(*_pack(codes, bits, np.repeat(owner, b - a + 1), len(sizes), last, number), each)
    code, length = _lookup((1, 2))
    run = np.frexp(sizes.astype(float))[1].astype(np.int64) - 1
    opens = np.concatenate(([True], owner[1:] != owner[:-1]))
    width = b - a + 1
    codes = np.zeros((len(coef), width + 1), np.int64)
    bits = np.ones((len(coef), width + 1), np.int64)
    codes[:, 1:], bits[:, 0] = low & 1, 0
    codes[opens, 0] = code[run << 4] << run | (sizes - (1 << run))
    bits[opens, 0] = length[run << 4] + run
    ac_fine = _scans_of(*_pack(codes.ravel(), bits.ravel(), np.repeat(owner, width + 1), len(sizes), last, number), each)
    codes, bits = _coded(coef[:, c : d + 1].ravel(), (1, 0))
    ac_rest = _scans_of(*_pack(codes, bits, np.repeat(owner, d - c + 1), len(sizes), last, number), each)

    head = b"\xff\xd8" + _segment(0xDB, b"\x00" + b"\x01" * 64)
    tables = _table_segment() + _segment(0xDD, struct.pack(">H", RESTART))
    sos = lambda parts, ss, se, ah, al: _segment(0xDA, bytes([len(parts), *(x for p in parts for x in p), ss, se, ah << 4 | al]))
    every = [(1, 0), (2, 0), (3, 0)]
    dc_head = sos(every, 0, 0, 0, 1), sos(every, 0, 0, 1, 0)
    ac_head = [[sos([(i + 1, t)], *s) for i in range(3)] for t, s in ((1, (a, b, 0, 1)), (2, (a, b, 1, 0)), (0, (c, d, 0, 0)))]
    out = []
    for i, (p, (w, h)) in enumerate(zip(payloads, shapes)):
        frame = _segment(0xC2, struct.pack(">BHHB", 8, 16 * h, 16 * w, 3) + bytes([1, 0x22, 0, 2, 0x11, 0, 3, 0x11, 0]))
        parts = [head, _segment(0xFE, struct.pack(">I", len(p))), frame, tables, dc_head[0], dc_first[i], dc_head[1], dc_fine[i]]
        for heads, scans in zip(ac_head, (ac_first, ac_fine, ac_rest)):
            for j in range(3):
                parts += [heads[j], scans[3 * i + j]]
        out.append(b"".join([*parts, b"\xff\xd9"]))
    return out


# ---------------------------------------------------------------- reader


@dataclass
class Component:
    number: int
    h: int
    v: int
    quant: int
    wide: int = 0  # blocks that its own scans have in a row, and rows of them
    high: int = 0
    stride: int = 0  # blocks in a row of its coefficient array
    rows: int = 0
    base: int = 0  # its first block in the batch's array


@dataclass
class Scan:
    parts: list[tuple[Component, int, int]]  # component, DC table, AC table
    ss: int
    se: int
    ah: int
    al: int
    restart: int
    tables: dict
    data: np.ndarray  # first byte of each interval, still stuffed
    wave: int = 0


@dataclass
class Image:
    width: int = 0
    height: int = 0
    comment: bytes = b""
    components: list[Component] = field(default_factory=list)
    quants: dict[int, np.ndarray] = field(default_factory=dict)
    scans: list[Scan] = field(default_factory=list)
    mcus: tuple[int, int] = (0, 0)


def _parse(data: bytes, at: int, real: np.ndarray, restarts: np.ndarray) -> Image:
    """Reads one file that starts at `at` of data; real: places of markers that end a scan,
    restarts: places of those inside scans."""
    image, tables, restart = Image(), {}, 0
    pos = at + 2
    while True:
        if data[pos] != 0xFF:
            raise ValueError("no marker where one is due")
        kind = data[pos + 1]
        if kind == 0xFF:
            pos += 1
            continue
        if kind == 0xD9:
            return image
        size = data[pos + 2] << 8 | data[pos + 3]
        body, pos = data[pos + 4 : pos + 2 + size], pos + 2 + size
        if kind == 0xFE:
            image.comment = body
        elif kind == 0xDD:
            restart = body[0] << 8 | body[1]
        elif kind == 0xDB:
            while body:
                wide = 2 if body[0] >> 4 else 1
                image.quants[body[0] & 15] = np.frombuffer(body[1 : 1 + 64 * wide], ">u2" if wide == 2 else np.uint8).astype(np.int64)
                body = body[1 + 64 * wide :]
        elif kind == 0xC4:
            while body:
                n = sum(body[1:17])
                tables = tables | {body[0]: bytes(body[1 : 17 + n])}
                body = body[17 + n :]
        elif kind == 0xC2:
            image.height, image.width = body[1] << 8 | body[2], body[3] << 8 | body[4]
            image.components = [Component(body[i], body[i + 1] >> 4, body[i + 1] & 15, body[i + 2]) for i in range(6, len(body), 3)]
            hm, vm = max(c.h for c in image.components), max(c.v for c in image.components)
            image.mcus = -(-image.width // (8 * hm)), -(-image.height // (8 * vm))
            for c in image.components:
                c.wide, c.high = -(-(-(-image.width * c.h // hm)) // 8), -(-(-(-image.height * c.v // vm)) // 8)
                c.stride, c.rows = image.mcus[0] * c.h, image.mcus[1] * c.v
        elif kind == 0xDA:
            n, by = body[0], {c.number: c for c in image.components}
            parts = [(by[body[1 + 2 * i]], body[2 + 2 * i] >> 4, body[2 + 2 * i] & 15) for i in range(n)]
            ss, se, a = body[1 + 2 * n : 4 + 2 * n]
            stop = int(real[np.searchsorted(real, pos)])
            i, j = np.searchsorted(restarts, (pos, stop))
            scan = Scan(parts, ss, se, a >> 4, a & 15, restart, tables, np.concatenate(([pos], restarts[i:j] + 2)))
            for old in image.scans:
                if old.ss <= se and ss <= old.se and any(p[0] is q[0] for p in parts for q in old.parts):
                    scan.wave = max(scan.wave, old.wave + 1)
            image.scans.append(scan)
            pos = stop
        elif kind in (0xC0, 0xC1, 0xC3, *range(0xC5, 0xC8), *range(0xC9, 0xCC), *range(0xCD, 0xD0)):
            raise ValueError("not a progressive Huffman file")


@functools.lru_cache(maxsize=64)
def _decoder(table: bytes) -> np.ndarray:
    """symbol << 8 | length of the code that opens each 16-bit string."""
    out, code, at, place = np.zeros(1 << 16, np.int64), 0, 16, 0
    for n in range(1, 17):
        for _ in range(table[n - 1]):
            span = 1 << (16 - n)
            out[place : place + span] = table[at] << 8 | n
            place, at, code = place + span, at + 1, code + 1
    return out


def _extend(bits: np.ndarray, size: np.ndarray) -> np.ndarray:
    return np.where(bits < (1 << np.maximum(size, 1)) >> 1, bits - (1 << size) + 1, bits) * (size > 0)


class _Bits:
    """Windows of 64 bits at every byte of unstuffed data; all else is arithmetic on positions."""

    def __init__(self, raw: np.ndarray):
        padded = np.concatenate((raw, np.full(8, 255, np.uint8))).astype(np.uint64)
        self.words = np.zeros(len(raw) + 1, np.uint64)
        for i in range(8):
            self.words |= padded[i : i + len(raw) + 1] << np.uint64(56 - 8 * i)

    def at(self, pos: np.ndarray) -> np.ndarray:
        return self.words[pos >> 3] << (pos & 7).astype(np.uint64)


def _top(word: np.ndarray, n) -> np.ndarray:
    """The first n (0 to 32) bits of each word."""
    return ((word >> np.uint64(32)) >> (32 - np.asarray(n)).astype(np.uint64)).astype(np.int64)


@functools.lru_cache(maxsize=1024)
def _own_blocks(wide: int, high: int, stride: int) -> np.ndarray:
    y, x = np.divmod(np.arange(wide * high), wide)
    return y * stride + x


@functools.lru_cache(maxsize=1024)
def _mixed_blocks(mcus: tuple[int, int], parts: tuple[tuple[int, int, int, int], ...]) -> tuple[np.ndarray, np.ndarray, int]:
    """parts: (h, v, stride, first block) of each; in MCU order."""
    my, mx = np.divmod(np.arange(mcus[0] * mcus[1]), mcus[0])
    columns, part = [], []
    for i, (h, v, stride, base) in enumerate(parts):
        for row in range(v):
            for column in range(h):
                columns.append(base + (my * v + row) * stride + mx * h + column)
                part.append(i)
    return np.column_stack(columns).ravel(), np.tile(part, len(my)), len(part)


def _block_list(scan: Scan, image: Image) -> tuple[np.ndarray, np.ndarray, int]:
    """Blocks of a scan in order (numbers in the batch's array), their part, and blocks in an MCU."""
    if len(scan.parts) == 1:
        c = scan.parts[0][0]
        own = _own_blocks(c.wide, c.high, c.stride)
        return own + c.base, np.zeros(len(own), np.int64), 1
    base = image.components[0].base
    block, part, n = _mixed_blocks(image.mcus, tuple((c.h, c.v, c.stride, c.base - base) for c, _, _ in scan.parts))
    return block + base, part, n


def _run_dc(bits: _Bits, coef: np.ndarray, pos, block, part, first, count, scan: Scan) -> None:
    """All intervals side by side: in step t, block number t of each."""
    order = np.argsort(-count, kind="stable")
    pos, first, count = pos[order], first[order], count[order]
    seen = np.zeros((len(pos), 4), np.int64)
    if not scan.ah:
        luts = np.stack([_decoder(scan.tables[p[1]]) for p in scan.parts])
    for t in range(int(count[0]) if len(count) else 0):
        n = int(np.searchsorted(-count, -t, side="left"))  # those with more than t blocks come first
        at = first[:n] + t
        b, word = block[at], bits.at(pos[:n])
        if scan.ah:
            coef[b, 0] |= _top(word, 1) << scan.al
            pos[:n] += 1
            continue
        p = part[at]
        found = luts[p, _top(word, 16)]
        length, size = found & 255, found >> 8
        diff = _extend(_top(word << length.astype(np.uint64), size), size)
        pos[:n] += length + size
        row = np.arange(n)
        seen[row, p] += diff
        coef[b, 0] = seen[row, p] << scan.al


def _run_ac(bits: _Bits, flat: np.ndarray, pos, block, first, count, scan: Scan) -> None:
    lut, at, stop = _decoder(scan.tables[0x10 | scan.parts[0][2]]), first.copy(), first + count
    k = np.full(len(pos), scan.ss)
    while len(pos):
        word = bits.at(pos)
        found = lut[_top(word, 16)]
        length, symbol = found & 255, found >> 8
        size, run = symbol & 15, symbol >> 4
        word = word << length.astype(np.uint64)
        value = _extend(_top(word, size), size)
        none = size == 0
        k += run
        if none.any():
            ends = none & (run < 15)
            extra = _top(word, np.where(ends, run, 0))
            at = np.where(ends, at + (1 << run) + extra, at)
            pos = pos + length + np.where(ends, run, size)
            some = ~none
            flat[block[at[some]] * 64 + k[some]] = value[some] << scan.al
            k = np.where(ends, scan.ss, k + 1)
        else:
            pos = pos + length + size
            flat[block[at] * 64 + k] = value << scan.al
            k += 1
        over = k > scan.se
        if over.any():
            at, k = at + over, np.where(over, scan.ss, k)
        elif not none.any():
            continue
        left = at < stop
        if not left.all():
            pos, at, stop, k = pos[left], at[left], stop[left], k[left]


def _run_refine(bits: _Bits, flat: np.ndarray, pos, block, first, count, scan: Scan) -> None:
    """state 0: a symbol is due; 1: passing zeros up to a new coefficient; 2: end-of-band run."""
    lut, at, stop, one = _decoder(scan.tables[0x10 | scan.parts[0][2]]), first.copy(), first + count, 1 << scan.al
    n = len(pos)
    k, state, zeros, fresh, run = np.full(n, scan.ss), np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
    while len(pos):
        due = state == 0
        if due.any():
            word = bits.at(pos)
            found = lut[_top(word, 16)]
            length, symbol = found & 255, found >> 8
            size, r = symbol & 15, symbol >> 4
            word = word << length.astype(np.uint64)
            ends = due & (size == 0) & (r < 15)
            sign = np.where(_top(word, 1) == 1, one, -one)
            fresh = np.where(due, np.where(size > 0, sign, 0), fresh)
            zeros = np.where(due, r, zeros)
            run = np.where(ends, (1 << r) + _top(word, np.where(ends, r, 0)), run)
            pos = pos + np.where(due, length + np.where(ends, r, (size > 0).astype(np.int64)), 0)
            state = np.where(ends, 2, np.where(due, 1, state))
        place = block[at] * 64 + k
        now = flat[place]
        old = now != 0
        bit = _top(bits.at(pos), 1) * old
        pos = pos + old
        here = ~old & (state == 1) & (zeros == 0)
        flat[place] = np.where(old, now + np.sign(now) * bit * one, np.where(here, fresh, now))
        zeros = zeros - (~old & (state == 1) & ~here)
        state = np.where(here, 0, state)
        k = k + 1
        over = k > scan.se
        if over.any():
            run = run - (over & (state == 2))
            state = np.where(over & ((state == 1) | (run <= 0)), 0, state)
            at, k = at + over, np.where(over, scan.ss, k)
            left = at < stop
            if not left.all():
                pos, at, stop, k, state, zeros, fresh, run = (x[left] for x in (pos, at, stop, k, state, zeros, fresh, run))


def read_files(files: list[bytes]) -> tuple[list[Image], np.ndarray]:
    """Images and the coefficients of all their blocks, in scan order, not dequantised."""
    data = b"".join(files)
    raw = np.frombuffer(data, np.uint8)
    marks = np.flatnonzero(raw[:-1] == 0xFF)
    kinds = raw[marks + 1]
    inner = (kinds >= 0xD0) & (kinds <= 0xD7)
    real, restarts = marks[(kinds != 0) & (kinds != 0xFF) & ~inner], marks[inner]
    images, at, blocks = [], 0, 0
    for f in files:
        images.append(image := _parse(data, at, real, restarts))
        at += len(f)
        for c in image.components:
            c.base = blocks
            blocks += c.stride * c.rows
    coef = np.zeros((blocks, 64), np.int64)
    keep = np.ones(len(raw), bool)
    keep[marks[kinds == 0] + 1] = False
    moved = np.concatenate(([0], np.cumsum(keep)))
    bits = _Bits(raw[keep])

    groups: dict[tuple, list[tuple[Scan, Image]]] = defaultdict(list)
    for image in images:
        for s in image.scans:
            used = tuple((s.tables.get(p[1]) if s.ss == 0 else s.tables.get(0x10 | p[2])) for p in s.parts)
            groups[s.wave, s.ss, s.se, s.ah, s.al, used].append((s, image))
    for (_, ss, _, ah, *_), members in sorted(groups.items(), key=lambda g: g[0][0]):
        block, part, pos, first, count, n = [], [], [], [], [], 0
        for s, image in members:
            b, p, in_mcu = _block_list(s, image)
            step = s.restart * in_mcu if s.restart else len(b)
            begins = np.arange(0, len(b), step)
            block.append(b)
            part.append(p)
            first.append(n + begins)
            count.append(np.minimum(step, len(b) - begins))
            pos.append(moved[s.data[: len(begins)]] * 8)
            n += len(b)
        args = [np.concatenate(x) for x in (pos, block, part, first, count)]
        if ss == 0:
            _run_dc(bits, coef, *args, members[0][0])
        else:
            (_run_refine if ah else _run_ac)(bits, coef.reshape(-1), args[0], args[1], args[3], args[4], members[0][0])
    return images, coef


def _cosines() -> np.ndarray:
    """The 8-point transform as integers of 12 bits: sums stay exact in double precision."""
    u, x = np.mgrid[0:8, 0:8]
    c = np.cos((2 * x + 1) * u * np.pi / 16) * np.where(u == 0, math.sqrt(1 / 8), 0.5)
    return np.round(c * 4096)


_DCT = _cosines()


def _samples(coef: np.ndarray, quant: np.ndarray) -> np.ndarray:
    """Blocks of 8 x 8 samples 0 to 255, by integer arithmetic."""
    square = np.zeros((len(coef), 64))
    square[:, ZIGZAG] = coef * quant
    rows = np.floor((square.reshape(-1, 8) @ _DCT + 256) / 512).reshape(-1, 8, 8)
    cols = np.floor((np.ascontiguousarray(rows.transpose(0, 2, 1)).reshape(-1, 8) @ _DCT + 16384) / 32768).reshape(-1, 8, 8)
    return np.clip(cols.transpose(0, 2, 1) + 128, 0, 255).astype(np.uint8)


def rgb(image: Image, samples: np.ndarray) -> np.ndarray:
    """height x width x 3; samples: the blocks of the batch. Chroma is repeated to full size."""
    hm, vm = max(c.h for c in image.components), max(c.v for c in image.components)
    planes = []
    for c in image.components:
        own = samples[c.base : c.base + c.stride * c.rows].reshape(c.rows, c.stride, 8, 8).transpose(0, 2, 1, 3).reshape(c.rows * 8, c.stride * 8)
        planes.append(own.repeat(vm // c.v, axis=0).repeat(hm // c.h, axis=1)[: image.height, : image.width].astype(np.int32))
    if len(planes) == 1:
        return np.repeat(planes[0][:, :, None], 3, axis=2).astype(np.uint8)
    y, cb, cr = planes[0], planes[1] - 128, planes[2] - 128
    # fixed values: the conversion's factors in 16 bits
    out = np.stack((y + ((91881 * cr + 32768) >> 16), y - ((22554 * cb + 46802 * cr + 32768) >> 16), y + ((116130 * cb + 32768) >> 16)), axis=2)
    return np.clip(out, 0, 255).astype(np.uint8)


def decode(files: list[bytes]) -> list[np.ndarray]:
    """RGB tensors of progressive JPEG files."""
    images, coef = read_files(files)
    return tensors(images, coef)


def tensors(images: list[Image], coef: np.ndarray) -> list[np.ndarray]:
    quant = np.ones((len(coef), 64), np.int64)
    for image in images:
        for c in image.components:
            if (q := image.quants[c.quant]).max() > 1:
                quant[c.base : c.base + c.stride * c.rows] = q
    samples = _samples(coef, quant)
    return [rgb(i, samples) for i in images]


def read_payload(image: Image, coef: np.ndarray) -> bytes:
    """The payload that write_payloads stored."""
    first = image.components[0].base
    n = struct.unpack(">I", image.comment)[0]
    return (coef[first : first - (-n // 64)].reshape(-1)[:n] - OFFSET).astype(np.uint8).tobytes()


def feature(tensor: np.ndarray) -> str:
    """Size, mean of each colour in hundredths, and a 64-bit hash of which cells of an 8 x 8 grid
    are brighter than the whole; all in integers."""
    h, w, _ = tensor.shape
    total = tensor.sum(axis=(0, 1), dtype=np.int64)
    light = tensor.sum(axis=2, dtype=np.int64)
    ys, xs = np.arange(8) * h // 8, np.arange(8) * w // 8
    cells = np.add.reduceat(np.add.reduceat(light, ys, axis=0), xs, axis=1)
    area = np.outer(np.diff([*ys, h]), np.diff([*xs, w]))
    bright = (cells * (h * w) > area * light.sum()).ravel()
    return f"{w}x{h}:" + ".".join(str(int(t) * 100 // (h * w)) for t in total) + ":" + np.packbits(bright).tobytes().hex()


# ---------------------------------------------------------------- tables


def payload(text: str | None) -> tuple[int, bytes]:
    data = (text or "").encode()
    return len(data), data + bytes(64 - len(data) % 64 if len(data) % 64 or not data else 0)


def _tiles(data: bytes) -> list[bytes]:
    return [data[i : i + TILE] for i in range(0, len(data), TILE)]


def _together(tiles: Iterator[tuple[int, bytes]]) -> Iterator[list[tuple[int, bytes]]]:
    """Tiles in lists of at most TOGETHER bytes, or one tile."""
    some, size = [], 0
    for tile in tiles:
        if some and size + len(tile[1]) > TOGETHER:
            yield some
            some, size = [], 0
        some.append(tile)
        size += len(tile[1])
    if some:
        yield some


class _Sum:
    """Digests of one text's stored tiles, as they come."""

    def __init__(self, n: int):
        self.n, self.size, self.stored, self.tail, self.marks = n, 0, 0, b"", []
        self.back, self.media = hashlib.sha256(), hashlib.sha256()

    def add(self, back: bytes, file: bytes, mark: str) -> None:
        self.back.update(back)
        self.media.update(file)
        self.size, self.stored, self.tail = self.size + len(back), self.stored + len(file), back[-64:]
        self.marks.append(mark)

    def row(self) -> tuple:
        return self.n, self.size, self.back.hexdigest(), zlib.crc32(self.tail), self.stored, self.media.hexdigest(), "+".join(self.marks)


def _digest(batch: pa.RecordBatch) -> pa.RecordBatch:
    sums: list[_Sum] = []

    def tiles() -> Iterator[tuple[int, bytes]]:
        for i, t in enumerate(batch.column("text")):
            n, data = payload(t.as_py())
            sums.append(_Sum(n))
            for at in range(0, len(data), TILE):
                yield i, data[at : at + TILE]

    for some in _together(tiles()):
        stored = write_payloads([t for _, t in some])
        images, coef = read_files(stored)
        for (i, _), file, image, tensor in zip(some, stored, images, tensors(images, coef)):
            sums[i].add(read_payload(image, coef), file, feature(tensor))
    rows = list(zip(*(x.row() for x in sums))) or [()] * 7
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
    return pa.RecordBatch.from_arrays([batch.column("doc_id"), *map(pa.array, rows, kinds)], names=["doc_id", *(c.split()[0] for c in _DIGEST.split(", "))])


_DIGEST = "n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


def digest_media(docs: DataFrame, rows: int = 512) -> DataFrame:
    """Stores the text of each row as progressive JPEG, reads it back and digests what it finds."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                yield _digest(batch.slice(at, rows))

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, {_DIGEST}")


def decode_media(files: DataFrame, key: str = "doc_id", media: str = "media", rows: int = 64) -> DataFrame:
    """key, height, width and rgb (row-major bytes) of the progressive JPEG in `media`; null stays null."""
    kind = files.schema[key].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                data = part.column(media).to_pylist()
                found = iter(decode([d for d in data if d is not None]) if any(d is not None for d in data) else [])
                out = [next(found) if d is not None else None for d in data]
                yield pa.RecordBatch.from_arrays(
                    [part.column(key), *(pa.array([None if t is None else t.shape[i] for t in out], pa.int32()) for i in (0, 1)), pa.array([None if t is None else t.tobytes() for t in out], pa.binary())],
                    names=[key, "height", "width", "rgb"],
                )

    return files.select(key, media).mapInArrow(run, f"`{key}` {kind}, height int, width int, rgb binary")
