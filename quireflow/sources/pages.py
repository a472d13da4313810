"""Pixels of image files as bands of rows, for what Spark's image source can't hold or can't read.

``bands`` gives a PNG file's rows as they inflate, so that of a page of any height only some rows are in memory, and a lossless WebP
file's rows (a back reference may reach anywhere, so those come as one band).  Interlaced PNG and lossy WebP files have none.

Rows are 8-bit gray (r, w, 1) or RGB (r, w, 3); transparency is left out, deeper samples keep their upper 8 bits.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np

#: Bytes of unfiltered rows in a band, about.
BAND_BYTES = 4 << 20
#: Rows that are unfiltered side by side, at most.
BAND_ROWS = 1024
#: Pixels above which a PNG page comes as bands; a smaller one fits in a row of Spark's image source.
LARGE_PIXELS = 1 << 24
Bands = tuple[int, int, Iterator[np.ndarray]]


class Undecodable(ValueError):
    """A file whose pixels this module doesn't give."""


def bands(content: bytes) -> Bands:
    """(width, height, bands of rows from the top) of a PNG or lossless WebP file."""
    if content[:8] == b"\x89PNG\r\n\x1a\n":
        return _png(content)
    if content[:4] == b"RIFF" and content[8:12] == b"WEBP":
        for kind, at, size in _riff(content):
            if kind == b"VP8L":
                pixels = _Lossless(content[at : at + size]).image()
                return pixels.shape[1], pixels.shape[0], iter([pixels])
    raise Undecodable("neither a PNG nor a lossless WebP file")


def banded(head: bytes, width: int, height: int) -> bool:
    """Whether ``bands`` is the way to an image's pixels, by the beginning of its file."""
    if head[:8] == b"\x89PNG\r\n\x1a\n":
        return width * height > LARGE_PIXELS and head[28:29] == b"\0"
    return head[:4] == b"RIFF" and head[8:12] == b"WEBP"


# PNG


def _chunks(content: bytes) -> Iterator[tuple[bytes, memoryview]]:
    at, view = 8, memoryview(content)
    while at + 8 <= len(content):
        size, kind = struct.unpack(">I4s", view[at : at + 8])
        yield kind, view[at + 8 : at + 8 + size]
        at += 12 + size


def _png(content: bytes) -> Bands:
    parts = _chunks(content)
    kind, head = next(parts, (b"", memoryview(b"")))
    if kind != b"IHDR" or len(head) != 13:
        raise Undecodable("no PNG header")
    width, height, depth, colour, _, _, interlaced = struct.unpack(">IIBBBBB", head)
    samples = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}.get(colour)
    if interlaced or samples is None or not width or not height:
        raise Undecodable("an interlaced or unknown PNG file")
    palette = next((np.frombuffer(data, np.uint8).reshape(-1, 3) for kind, data in _chunks(content) if kind == b"PLTE"), None)
    if colour == 3 and palette is None:
        raise Undecodable("a PNG file without its palette")
    return width, height, (_plain(rows, width, depth, samples, palette if colour == 3 else None) for rows in _unfiltered(parts, height, -(-width * depth * samples // 8), max(1, depth * samples // 8)))


def _inflated(parts: Iterator[tuple[bytes, memoryview]], height: int, line: int) -> Iterator[np.ndarray]:
    """Filtered rows (r, 1 + stride), some at a time."""
    at_once = max(1, min(BAND_ROWS, BAND_BYTES // line))
    unzip, held, left = zlib.decompressobj(), bytearray(), height
    for kind, data in parts:
        if kind != b"IDAT":
            continue
        data = bytes(data)
        while data and left:
            n = min(at_once, left) * line
            held += unzip.decompress(data, n - len(held))
            data = unzip.unconsumed_tail
            if len(held) == n:
                yield np.frombuffer(bytes(held), np.uint8).reshape(-1, line)
                left -= n // line
                held.clear()
    if left:
        raise Undecodable("a PNG file that ends early")


def _unfiltered(parts: Iterator[tuple[bytes, memoryview]], height: int, stride: int, step: int) -> Iterator[np.ndarray]:
    above = np.zeros(stride, np.uint8)
    for rows in _inflated(parts, height, 1 + stride):
        kinds, out = rows[:, 0], rows[:, 1:].copy()
        if kinds.max() > 4:
            raise Undecodable("an unknown row filter")
        if kinds.max() < 3:
            for y, kind in enumerate(kinds.tolist()):
                if kind == 1:
                    own = out[y] if stride % step == 0 else np.append(out[y], np.zeros(-stride % step, np.uint8))
                    out[y] = np.cumsum(own.reshape(-1, step), axis=0, dtype=np.uint8).ravel()[:stride]
                elif kind == 2:
                    out[y] += above
                above = out[y]
        else:
            out = _slanted(out, kinds, above, step)
        above = out[-1].copy()
        yield out


def _slanted(rows: np.ndarray, kinds: np.ndarray, above: np.ndarray, step: int) -> np.ndarray:
    """Rows with filters that look left and up at once: all rows go on together, each one pixel behind the row above it."""
    n, stride = rows.shape
    width = -(-stride // step)
    wide = np.zeros((n, (width + n) * step), np.uint8)
    wide[:, :stride] = rows
    # row r moved r pixels to the right: the same bytes with rows one pixel shorter
    moved = wide.ravel()[: n * (width + n - 1) * step].reshape(n, width + n - 1, step).transpose(1, 0, 2)
    moved = np.ascontiguousarray(moved).astype(np.int16)
    first = np.zeros((width + n, step), np.int16)
    first.ravel()[:stride] = above
    kind = kinds.astype(np.int16)[:, None]
    is_left, is_up, is_mean, is_near = ((kind == k) for k in (1, 2, 3, 4))
    left = np.zeros((n, step), np.int16)
    up, corner = left.copy(), left.copy()
    for t in range(width + n - 1):
        # up[r] is what row r - 1 made one step ago, corner[r] two steps ago
        up[0] = first[t]
        a, b, c = np.abs(up - corner), np.abs(left - corner), np.abs(left + up - 2 * corner)
        near = np.where((a <= b) & (a <= c), left, np.where(b <= c, up, corner))
        guess = is_left * left + is_up * up + is_mean * (left + up >> 1) + is_near * near
        now = (moved[t] + guess) & 255
        late = t + 1 - width
        moved[t] = now
        if late > 0:  # rows that are past their end stay so
            now[:late] = 0
        corner, up = up, np.empty_like(up)
        corner[0] = first[t]
        up[1:] = now[:-1]
        left = now
    back = np.zeros((n, (width + n - 1) * step), np.uint8)
    back.reshape(n, width + n - 1, step)[:] = moved.transpose(1, 0, 2)
    flat = np.append(back.ravel(), np.zeros(n * step, np.uint8))
    return np.ascontiguousarray(flat[: n * (width + n) * step].reshape(n, -1)[:, :stride])


def _plain(rows: np.ndarray, width: int, depth: int, samples: int, palette: np.ndarray | None) -> np.ndarray:
    """Unfiltered rows as 8-bit gray or RGB."""
    n = len(rows)
    if depth == 16:
        rows = rows[:, ::2]
    elif depth < 8:
        bits = np.unpackbits(rows, axis=1)[:, : width * depth].reshape(n, width, depth)
        rows = (bits << np.arange(depth - 1, -1, -1, dtype=np.uint8)).sum(2, dtype=np.uint8)
        if palette is None:
            rows = rows * np.uint8(255 // ((1 << depth) - 1))
    if palette is not None:
        table = np.zeros((256, 3), np.uint8)
        table[: len(palette)] = palette
        return table[rows]
    rows = rows.reshape(n, width, samples)
    return rows[:, :, : samples - 1] if samples in (2, 4) else rows


# WebP


def _riff(content: bytes) -> Iterator[tuple[bytes, int, int]]:
    at = 12
    while at + 8 <= len(content):
        kind, size = struct.unpack("<4sI", content[at : at + 8])
        yield kind, at + 8, size
        at += 8 + size + size % 2


class _Bits:
    """Bits of a file, the lowest of each byte first."""

    def __init__(self, data: bytes):
        self.data, self.at, self.held, self.n = data, 0, 0, 0

    def fill(self) -> None:
        part = self.data[self.at : self.at + 8]
        if not part:
            if self.at > len(self.data) + 16:
                raise Undecodable("a WebP file that ends early")
            part = bytes(8)  # the last code may be looked up beyond the end
        self.at += 8
        self.held |= int.from_bytes(part, "little") << self.n
        self.n += 8 * len(part)

    def read(self, k: int) -> int:
        while self.n < k:
            self.fill()
        out = self.held & ((1 << k) - 1)
        self.held >>= k
        self.n -= k
        return out


class _Code:
    """A canonical prefix code: symbols by the next bits, ``width`` of them at once, longer codes by their rest."""

    _FIRST = 9

    def __init__(self, lengths: list[int]):
        used = [s for s, n in enumerate(lengths) if n]
        self.only = used[0] if len(used) == 1 else None
        if not used:
            self.only = 0
        if self.only is not None:
            return
        longest = max(lengths)
        self.width = min(longest, self._FIRST)
        self.mask = (1 << self.width) - 1
        self.table: list = [None] * (1 << self.width)
        code = 0
        for size in range(1, longest + 1):
            for s in used:
                if lengths[s] != size:
                    continue
                back = int(f"{code:0{size}b}"[::-1], 2)  # codes begin with their highest bit
                if size <= self.width:
                    for i in range(back, 1 << self.width, 1 << size):
                        self.table[i] = (size, s)
                else:
                    rest = self.table[back & self.mask] or {}
                    self.table[back & self.mask] = rest
                    rest[size, back >> self.width] = s
                code += 1
            code <<= 1
        if code != 1 << (longest + 1):
            raise Undecodable("an incomplete prefix code")

    def read(self, bits: _Bits) -> int:
        if self.only is not None:
            return self.only
        if bits.n < 15:
            bits.fill()
        found = self.table[bits.held & self.mask]
        if type(found) is dict:
            tail = bits.held >> self.width
            found = next((size, s) for (size, back), s in found.items() if tail & ((1 << (size - self.width)) - 1) == back)
        bits.held >>= found[0]
        bits.n -= found[0]
        return found[1]


#: Order in which the lengths of the code for code lengths stand: a fixed value of the format.
_LENGTH_ORDER = (17, 18, 0, 1, 2, 3, 4, 5, 16, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15)
#: Near places by distance code: in the rows above and to the left, nearest first.
_NEAR = sorted(((x, y) for y in range(8) for x in range(-7, 9) if y or x > 0), key=lambda p: (p[0] ** 2 + p[1] ** 2, abs(p[0]), p[0] < 0))
_HASH = 0x1E35A7BD


class _Lossless:
    """One lossless image: transforms, prefix codes, and pixels as literals, back references and cached colours."""

    def __init__(self, data: bytes):
        self.bits = _Bits(data[5:])
        head = int.from_bytes(data[1:5], "little")
        if data[:1] != b"\x2f" or head >> 29:
            raise Undecodable("no lossless WebP header")
        self.width, self.height = (head & 0x3FFF) + 1, (head >> 14 & 0x3FFF) + 1

    def image(self) -> np.ndarray:
        """(height, width, 3) RGB."""
        argb = self.stream(self.width, self.height)
        return np.stack([argb >> 16 & 255, argb >> 8 & 255, argb & 255], 2).astype(np.uint8)

    def stream(self, width: int, height: int) -> np.ndarray:
        """A whole image with its transforms undone, (height, width) of 0xAARRGGBB."""
        bits, undo, wide = self.bits, [], width
        while bits.read(1):
            kind = bits.read(2)
            if kind < 2:
                size = bits.read(3) + 2
                blocks = self.coded(-(-wide // (1 << size)), -(-height // (1 << size)))
                undo.append((kind, wide, size, blocks))
            elif kind == 2:
                undo.append((kind, wide, 0, None))
            else:
                n = bits.read(8) + 1
                table = np.cumsum(self.coded(n, 1).view(np.uint8).reshape(n, 4), axis=0, dtype=np.uint8).view(np.uint32).ravel()
                size = 3 if n <= 2 else 2 if n <= 4 else 1 if n <= 16 else 0
                undo.append((kind, wide, size, table))
                wide = -(-wide // (1 << size))
        argb = self.coded(wide, height, True)
        for kind, wide, size, part in reversed(undo):
            argb = (_predicted, _coloured, _greened, _indexed)[kind](argb, wide, size, part)
        return argb

    def code(self, symbols: int) -> _Code:
        bits = self.bits
        lengths = [0] * symbols
        if bits.read(1):
            many, wide = bits.read(1), bits.read(1)
            lengths[bits.read(8 if wide else 1)] = 1
            if many:
                lengths[bits.read(8)] = 1
            return _Code(lengths)
        sizes = [0] * 19
        for i in range(4 + bits.read(4)):
            sizes[_LENGTH_ORDER[i]] = bits.read(3)
        left = 2 + bits.read(2 + 2 * bits.read(3)) if bits.read(1) else symbols
        by, at, before = _Code(sizes), 0, 8
        while at < symbols and left:
            left -= 1
            s = by.read(bits)
            if s < 16:
                lengths[at] = s
                before = s or before
                at += 1
            else:
                n = 3 + bits.read(2) if s == 16 else 3 + bits.read(3) if s == 17 else 11 + bits.read(7)
                if at + n > symbols:
                    raise Undecodable("too many code lengths")
                if s == 16:
                    lengths[at : at + n] = [before] * n
                at += n
        return _Code(lengths)

    def _count(self, symbol: int) -> int:
        """A length or distance from its prefix symbol."""
        if symbol < 4:
            return symbol + 1
        extra = symbol - 2 >> 1
        return (2 + (symbol & 1) << extra) + self.bits.read(extra) + 1

    def coded(self, width: int, height: int, main: bool = False) -> np.ndarray:
        """An image's pixels as they are coded, (height, width) of 0xAARRGGBB."""
        bits = self.bits
        cache_bits = bits.read(4) if bits.read(1) else 0
        if cache_bits > 11:
            raise Undecodable("too large a colour cache")
        group_of, block = None, 0
        if main and bits.read(1):
            block = bits.read(3) + 2
            group_of = (self.coded(-(-width // (1 << block)), -(-height // (1 << block))) >> 8 & 0xFFFF).tolist()
        groups = [[self.code(n) for n in (280 + (1 << cache_bits if cache_bits else 0), 256, 256, 256, 40)] for _ in range(1 + max(map(max, group_of)) if group_of else 1)]
        cache, shift = [0] * (1 << cache_bits), 32 - cache_bits
        total = width * height
        out = np.zeros(total, np.uint32)
        at, known = 0, 0  # pixels so far, and how many of them the cache has seen
        green, red, blue, alpha, far = groups[0]
        while at < total:
            if group_of:
                y, x = divmod(at, width)
                green, red, blue, alpha, far = groups[group_of[y >> block][x >> block]]
            s = green.read(bits)
            if s < 256:
                out[at] = red.read(bits) << 16 | s << 8 | blue.read(bits) | alpha.read(bits) << 24
                at += 1
            elif s < 280:
                n = min(self._count(s - 256), total - at)
                d = self._count(far.read(bits))
                if d > 120:
                    d -= 120
                else:
                    x, y = _NEAR[d - 1]
                    d = max(1, x + y * width)
                if d > at:
                    raise Undecodable("a reference before the first pixel")
                while n:  # a run may repeat what it has just copied
                    part = min(n, d)
                    out[at : at + part] = out[at - d : at - d + part]
                    at, n, d = at + part, n - part, d + part
            else:
                for p in out[known:at].tolist():
                    cache[(p * _HASH & 0xFFFFFFFF) >> shift] = p
                known = at
                out[at] = cache[s - 280]
                at += 1
        return out.reshape(height, width)


def _bytes(argb: np.ndarray) -> np.ndarray:
    """(h, w, 4) with blue, green, red, alpha."""
    return np.ascontiguousarray(argb).view(np.uint8).reshape(*argb.shape, 4)


def _greened(argb: np.ndarray, width: int, size: int, part: None) -> np.ndarray:
    p = _bytes(argb)
    p[:, :, 0] += p[:, :, 1]
    p[:, :, 2] += p[:, :, 1]
    return argb


def _coloured(argb: np.ndarray, width: int, size: int, part: np.ndarray) -> np.ndarray:
    p = _bytes(argb)
    height = len(p)
    scale = np.repeat(np.repeat(_bytes(part), 1 << size, 0)[:height], 1 << size, 1)[:, :width].view(np.int8).astype(np.int16)
    add = lambda k, by: (scale[:, :, k] * by.view(np.int8) >> 5).astype(np.uint8)
    green = np.ascontiguousarray(p[:, :, 1])
    p[:, :, 2] += add(0, green)
    p[:, :, 0] += add(1, green)
    p[:, :, 0] += add(2, np.ascontiguousarray(p[:, :, 2]))
    return argb


def _indexed(argb: np.ndarray, width: int, size: int, table: np.ndarray) -> np.ndarray:
    index = _bytes(argb)[:, :, 1]
    if size:
        each = 8 >> size
        index = (index[:, :, None] >> (np.arange(1 << size, dtype=np.uint8) * each) & ((1 << each) - 1)).reshape(len(index), -1)[:, :width]
    full = np.zeros(256, np.uint32)
    full[: len(table)] = table
    return full[index]


def _predicted(argb: np.ndarray, width: int, size: int, part: np.ndarray) -> np.ndarray:
    """Adds to each pixel what its neighbours foretell; rows go on together, each two pixels behind the row above it, so that its upper right is known."""
    p = _bytes(argb).astype(np.int16)
    height = len(p)
    p[0, 0, 3] += 255
    p[0] = np.cumsum(p[0], axis=0) & 255
    modes = _bytes(part)[:, :, 1] & 15
    for y0 in range(1, height, BAND_ROWS):
        n = min(BAND_ROWS, height - y0)
        y = np.arange(y0, y0 + n)
        mode_row = modes[y >> size]
        for t in range(width + 2 * n - 2):
            lo, hi = max(0, -(-(t - width + 1) // 2)), min(n, t // 2 + 1)  # rows that have a pixel at this step
            r = np.arange(lo, hi)
            x, row = t - 2 * r, y0 + r
            up = p[row - 1, x]
            left = p[row, x - 1]  # not looked at where x is 0
            corner = p[row - 1, x - 1]
            last = x == width - 1  # its upper right is its own row's first
            right = p[np.where(last, row, row - 1), np.where(last, 0, x + 1)]
            guess = _guess(np.where(x == 0, 2, mode_row[r, x >> size]), left, up, corner, right)
            p[row, x] = p[row, x] + guess & 255
    return np.ascontiguousarray(p.astype(np.uint8)).view(np.uint32).reshape(height, width)


def _guess(mode: np.ndarray, left: np.ndarray, up: np.ndarray, corner: np.ndarray, right: np.ndarray) -> np.ndarray:
    """What each of the format's predictors makes of the neighbours (rows of four samples)."""
    out = np.zeros_like(up)
    mean = lambda a, b: a + b >> 1

    def nearer(i):
        # summed over the samples, is left or up closer to left + up - corner
        a, b = np.abs(up[i] - corner[i]).sum(1), np.abs(left[i] - corner[i]).sum(1)
        return np.where((a < b)[:, None], left[i], up[i])

    half = lambda i: mean(left[i], up[i])
    rules = {
        0: lambda i: np.array([0, 0, 0, 255], np.int16), 1: lambda i: left[i], 2: lambda i: up[i], 3: lambda i: right[i], 4: lambda i: corner[i],
        5: lambda i: mean(mean(left[i], right[i]), up[i]), 6: lambda i: mean(left[i], corner[i]), 7: half, 8: lambda i: mean(corner[i], up[i]), 9: lambda i: mean(up[i], right[i]),
        10: lambda i: mean(mean(left[i], corner[i]), mean(up[i], right[i])), 11: nearer, 12: lambda i: np.clip(left[i] + up[i] - corner[i], 0, 255),
        13: lambda i: np.clip(half(i) + ((half(i) - corner[i]) / 2).astype(np.int16), 0, 255),
    }
    for k in np.unique(mode).tolist():
        i = np.flatnonzero(mode == k)
        out[i] = rules.get(k, rules[0])(i)
    return out
