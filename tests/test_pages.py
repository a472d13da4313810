"""Pixels as bands: PNG filters and depths, lossless WebP by a small encoder of its own, layout and crops from bands."""

import random
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from quireflow.operators import layout
from quireflow.sources import pages, readers

SAMPLES = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}


def predicted(row, above, kind, step):
    out = []
    for x in range(len(row)):
        a, b, c = row[x - step] if x >= step else 0, above[x], above[x - step] if x >= step else 0
        p = a + b - c
        near = min((abs(p - a), 0, a), (abs(p - b), 1, b), (abs(p - c), 2, c))[2]
        out.append((0, a, b, (a + b) // 2, near)[kind])
    return out


def png(rows, depth, colour, kinds, palette=b"", interlaced=0, pieces=3):
    """A PNG file of raw rows (lists of bytes), with row filters in turn."""
    step, out = max(1, SAMPLES[colour] * depth // 8), bytearray()
    for y, row in enumerate(rows):
        kind = kinds[y % len(kinds)]
        guess = predicted(row, rows[y - 1] if y else [0] * len(row), kind, step)
        out += bytes([kind, *((v - g) & 255 for v, g in zip(row, guess, strict=True))])
    part = lambda k, d: struct.pack(">I", len(d)) + k + d + struct.pack(">I", zlib.crc32(k + d))
    width = len(rows[0]) * 8 // (depth * SAMPLES[colour])
    body = zlib.compress(bytes(out))
    n = -(-len(body) // pieces)
    head = struct.pack(">IIBBBBB", width, len(rows), depth, colour, 0, 0, interlaced)
    return b"\x89PNG\r\n\x1a\n" + part(b"IHDR", head) + (part(b"PLTE", palette) if palette else b"") + b"".join(part(b"IDAT", body[i : i + n]) for i in range(0, len(body), n)) + part(b"IEND", b"")


def pixels_of(content):
    width, height, parts = pages.bands(content)
    got = np.concatenate(list(parts))
    assert got.shape[:2] == (height, width)
    return got


@pytest.mark.parametrize("kinds", [[0], [1], [2], [3], [4], [4, 3, 2, 1, 0], [1, 2]])
@pytest.mark.parametrize("colour", [0, 2, 4, 6])
def test_png_filters(monkeypatch, colour, kinds):
    rng = np.random.default_rng(colour)
    for rows_at_once in (pages.BAND_ROWS, 3):
        monkeypatch.setattr(pages, "BAND_ROWS", rows_at_once)
        width, height = rng.integers(1, 30, 2)
        raw = rng.integers(0, 256, (height, width, SAMPLES[colour]), dtype=np.uint8)
        got = pixels_of(png(raw.reshape(height, -1).tolist(), 8, colour, kinds))
        assert (got == raw[:, :, : 3 if colour in (2, 6) else 1]).all()


@pytest.mark.parametrize(("depth", "colour"), [(1, 0), (2, 0), (4, 0), (16, 0), (16, 2), (1, 3), (2, 3), (4, 3), (8, 3)])
def test_png_depths(depth, colour):
    rng = np.random.default_rng(depth)
    values = rng.integers(0, 1 << depth, (9, 11, SAMPLES[colour]))
    bits = (values[:, :, :, None] >> np.arange(depth - 1, -1, -1) & 1).reshape(9, -1)
    raw = np.packbits(bits.astype(np.uint8), axis=1)
    table = rng.integers(0, 256, (1 << min(depth, 8), 3), dtype=np.uint8)
    got = pixels_of(png(raw.tolist(), depth, colour, [0, 4], table.tobytes() if colour == 3 else b""))[:, :11]
    want = table[values[:, :, 0]] if colour == 3 else values >> 8 if depth == 16 else values * 255 // ((1 << depth) - 1)
    assert (got == want).all()


@pytest.mark.parametrize("content", [b"", b"\xff\xd8x", b"RIFF\0\0\0\0WEBPVP8 \4\0\0\0abcd", b"\x89PNG\r\n\x1a\n", png([[1, 2]], 8, 0, [0], interlaced=1), png([[1, 2]], 8, 3, [0]), png([[1, 2], [3, 4]], 8, 0, [0])[:50]])
def test_what_has_no_bands(content):
    with pytest.raises((pages.Undecodable, zlib.error)):
        pixels_of(content)


def test_a_high_page_is_never_whole(monkeypatch):
    seen = []
    monkeypatch.setattr(pages, "BAND_BYTES", 1 << 16)
    for rows in pages.bands(png(np.full((5000, 40), 9, np.uint8).tolist(), 8, 0, [2]))[2]:
        seen.append(rows.nbytes)
    assert sum(seen) == 200_000 and max(seen) <= 1 << 16


# lossless WebP


class Writer:
    def __init__(self):
        self.value, self.n = 0, 0

    def put(self, value, n):
        self.value |= value << self.n
        self.n += n

    def code(self, lengths, s):
        if sum(n > 0 for n in lengths) < 2:
            return
        code = 0
        for size in range(1, 16):
            for t, n in enumerate(lengths):
                if n == size:
                    if t == s:
                        return self.put(int(f"{code:0{size}b}"[::-1], 2), size)
                    code += 1
            code <<= 1
        raise AssertionError


def even(n):
    """Code lengths of a complete code over n symbols."""
    k = (n - 1).bit_length()
    short = (1 << k) - n
    return [k - 1] * short + [k] * (n - short)


def put_code(w, lengths):
    used = [s for s, n in enumerate(lengths) if n]
    if len(used) <= 2 and all(s < 256 for s in used):
        w.put(1, 1), w.put(len(used) - 1, 1), w.put(1, 1)
        for s in used:
            w.put(s, 8)
        return
    w.put(0, 1)
    used = sorted(set(lengths))
    kinds = [0] * 19
    for n, size in zip(used, even(len(used)) if len(used) > 1 else [1], strict=True):
        kinds[n] = size
    order = (17, 18, 0, 1, 2, 3, 4, 5, 16, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15)
    w.put(15, 4)
    for s in order:
        w.put(kinds[s], 3)
    w.put(0, 1)
    for n in lengths:
        w.code(kinds, n)


def prefix(n):
    """(symbol, extra bits, how many) of a length or distance."""
    if n <= 4:
        return n - 1, 0, 0
    for s in range(4, 40):
        extra = s - 2 >> 1
        low = (2 + (s & 1) << extra) + 1
        if low <= n < low + (1 << extra):
            return s, n - low, extra
    raise AssertionError


def put_pixels(w, argb, width, rng, cache_bits=0, main=False, groups=0):
    """Pixels as literals, runs and cached colours, chosen at random among what is possible."""
    w.put(cache_bits > 0, 1)
    if cache_bits:
        w.put(cache_bits, 4)
    height = len(argb) // width
    if main:
        w.put(groups > 0, 1)
        if groups:
            w.put(0, 3)  # blocks of 4 x 4
            blocks = [rng.randrange(groups) for _ in range(-(-width // 4) * -(-height // 4))]
            blocks[0] = groups - 1
            put_pixels(w, [b << 8 | 0xFF000000 for b in blocks], -(-width // 4), rng)
    sizes = (280 + (1 << cache_bits if cache_bits else 0), 256, 256, 256, 40)
    codes = []
    for _ in range(max(1, groups)):
        own = [even(n)[:: rng.choice([1, -1])] for n in sizes]
        codes.append(own)
        for c in own:
            put_code(w, c)
    cache, at, near = {}, 0, {}
    for i, (x, y) in enumerate(sorted(((x, y) for y in range(8) for x in range(-7, 9) if y or x > 0), key=lambda p: (p[0] ** 2 + p[1] ** 2, abs(p[0]), p[0] < 0))):
        near.setdefault(max(1, x + y * width), i + 1)
    while at < len(argb):
        green, red, blue, alpha, far = codes[blocks[at // width // 4 * -(-width // 4) + at % width // 4] if groups else 0]
        p = argb[at]
        slot = (p * 0x1E35A7BD & 0xFFFFFFFF) >> (32 - cache_bits) if cache_bits else None
        back = [d for d in (1, 2, width - 1, width, width + 1, 9 * width + 30) if 0 < d <= at and argb[at - d] == p]
        taken = 1
        if back and rng.random() < 0.7:
            d = rng.choice(back)
            while at + taken < len(argb) and argb[at + taken - d] == argb[at + taken]:
                taken += 1
            s, extra, n = prefix(taken)
            w.code(green, 256 + s), w.put(extra, n)
            s, extra, n = prefix(near[d] if d in near and rng.random() < 0.7 else d + 120)
            w.code(far, s), w.put(extra, n)
        elif cache_bits and cache.get(slot) == p:
            w.code(green, 280 + slot)
        else:
            for c, v in ((green, p >> 8 & 255), (red, p >> 16 & 255), (blue, p & 255), (alpha, p >> 24)):
                w.code(c, v)
        if cache_bits:
            for q in argb[at : at + taken]:
                cache[(q * 0x1E35A7BD & 0xFFFFFFFF) >> (32 - cache_bits)] = q
        at += taken


def parts(p):
    return [p & 255, p >> 8 & 255, p >> 16 & 255, p >> 24]


def whole(values):
    return sum((v & 255) << 8 * i for i, v in enumerate(values))


def guess(mode, le, up, co, ri):
    mean = lambda a, b: [(x + y) // 2 for x, y in zip(a, b, strict=True)]
    clip = lambda values: [max(0, min(255, v)) for v in values]
    if mode == 11:
        a = sum(abs(u - c) for u, c in zip(up, co, strict=True))
        b = sum(abs(x - c) for x, c in zip(le, co, strict=True))
        return le if a < b else up
    if mode == 12:
        return clip(a + b - c for a, b, c in zip(le, up, co, strict=True))
    if mode == 13:
        return clip(a + int((a - c) / 2) for a, c in zip(mean(le, up), co, strict=True))
    return {0: [0, 0, 0, 255], 1: le, 2: up, 3: ri, 4: co, 5: mean(mean(le, ri), up), 6: mean(le, co), 7: mean(le, up), 8: mean(co, up), 9: mean(up, ri), 10: mean(mean(le, co), mean(up, ri))}[mode]


def webp(argb, width, rng, transforms=(), cache_bits=0, groups=0, extended=False):
    """A lossless WebP file of pixels (0xAARRGGBB, in a row)."""
    height, wide = len(argb) // width, width
    w = Writer()
    for kind in transforms:
        w.put(1, 1), w.put(kind, 2)
        per_side = (-(-wide // 4), -(-height // 4))
        if kind == 0:
            w.put(0, 3)
            modes = [rng.randrange(14) for _ in range(per_side[0] * per_side[1])]
            put_pixels(w, [m << 8 for m in modes], per_side[0], rng)
            out = []
            for i, p in enumerate(argb):
                y, x = divmod(i, wide)
                le, up, co, ri = (parts(argb[j]) if j >= 0 else [0] * 4 for j in (i - 1, i - wide, i - wide - 1, i - wide + 1))
                g = [0, 0, 0, 255] if i == 0 else le if y == 0 else up if x == 0 else guess(modes[y // 4 * per_side[0] + x // 4], le, up, co, ri)
                out.append(whole(a - b for a, b in zip(parts(p), g, strict=True)))
            argb = out
        elif kind == 1:
            w.put(0, 3)
            scales = [whole(rng.randrange(256) for _ in range(4)) for _ in range(per_side[0] * per_side[1])]
            put_pixels(w, scales, per_side[0], rng)
            signed = lambda v: v - 256 if v > 127 else v
            out = []
            for i, p in enumerate(argb):
                y, x = divmod(i, wide)
                g2r, g2b, r2b, _ = map(signed, parts(scales[y // 4 * per_side[0] + x // 4]))
                b, g, r, a = parts(p)
                out.append(whole([b - (g2b * signed(g) >> 5) - (r2b * signed(r) >> 5), g, r - (g2r * signed(g) >> 5), a]))
            argb = out
        elif kind == 2:
            argb = [whole([b - g, g, r - g, a]) for b, g, r, a in map(parts, argb)]
        else:
            table = sorted(set(argb))
            w.put(len(table) - 1, 8)
            put_pixels(w, [whole(a - b for a, b in zip(parts(p), parts(table[i - 1]) if i else [0] * 4, strict=True)) for i, p in enumerate(table)], len(table), rng)
            each = next(n for n in (1, 2, 4, 8) if len(table) <= 1 << n)
            index = [table.index(p) for p in argb]
            out = []
            for y in range(height):
                row = index[y * wide : (y + 1) * wide]
                out += [sum(v << each * k for k, v in enumerate(row[i : i + 8 // each])) << 8 for i in range(0, wide, 8 // each)]
            argb, wide = out, -(-wide // (8 // each))
    w.put(0, 1)
    put_pixels(w, argb, wide, rng, cache_bits, True, groups)
    stream = b"\x2f" + struct.pack("<I", width - 1 | height - 1 << 14 | 1 << 28) + w.value.to_bytes(w.n // 8 + 1, "little")
    part = lambda k, d: k + struct.pack("<I", len(d)) + d + b"\0" * (len(d) % 2)
    body = (part(b"VP8X", struct.pack("<I", 0) + (width - 1).to_bytes(3, "little") + (height - 1).to_bytes(3, "little")) + part(b"ICCP", b"abc") if extended else b"") + part(b"VP8L", stream)
    return b"RIFF" + struct.pack("<I", 4 + len(body)) + b"WEBP" + body


def rgb(argb, width):
    return np.array([parts(p)[2::-1] for p in argb], np.uint8).reshape(-1, width, 3)


@pytest.mark.parametrize("transforms", [(), (2,), (0,), (1,), (3,), (0, 2), (1, 0), (2, 0, 1), (3, 0)])
@pytest.mark.parametrize(("cache", "groups"), [(0, 0), (5, 0), (0, 3), (11, 2)])
def test_lossless_webp(transforms, cache, groups):
    rng = random.Random(str((transforms, cache, groups)))
    for colours in ((2, 3, 9, 200) if 3 in transforms else (3, 1000)):
        width, height = rng.randint(1, 23), rng.randint(1, 19)
        palette = [rng.randrange(1 << 32) for _ in range(colours)]
        argb = [rng.choice(palette)]
        while len(argb) < width * height:
            argb.append(argb[-1] if rng.random() < 0.5 else argb[max(0, len(argb) - width)] if rng.random() < 0.5 else rng.choice(palette))
        content = webp(argb, width, rng, transforms, cache, groups, extended=groups == 2)
        assert readers.image_size(content) == (width, height) and pages.banded(content, width, height)
        assert (pixels_of(content) == rgb(argb, width)).all()


def test_long_prefix_codes():
    lengths = [*range(1, 15), 15, 15]
    w = Writer()
    for s in (0, 15, 7, 14, 13, 9, 15, 0):
        w.code(lengths, s)
    bits = pages._Bits(w.value.to_bytes(w.n // 8 + 1, "little"))
    code = pages._Code(lengths)
    assert [code.read(bits) for _ in range(8)] == [0, 15, 7, 14, 13, 9, 15, 0]
    with pytest.raises(pages.Undecodable):
        pages._Code([2, 2, 2])


def printed(seed, width, height):
    """A gray page with lines of print, margins and a ruled part."""
    rng = np.random.default_rng(seed)
    page = np.full((height, width), 252, np.uint8)
    y = 25
    while y < height - 40:
        page[y : y + 9, 30 : int(rng.integers(width // 2, width - 20))] = rng.integers(0, 120)
        y += int(rng.integers(12, 70))
    page[height // 2 : height // 2 + 3, 10:-10] = 0
    return page


def tiff(page):
    """An uncompressed TIFF file of gray pixels."""
    height, width = page.shape
    tags = [(256, 4, width), (257, 4, height), (258, 3, 8), (259, 3, 1), (262, 3, 1), (273, 4, 8), (277, 3, 1), (278, 4, height), (279, 4, page.size)]
    return b"II*\0" + struct.pack("<I", 8 + page.size) + page.tobytes() + struct.pack("<H", len(tags)) + b"".join(struct.pack("<HHII", t, k, 1, v) for t, k, v in tags) + struct.pack("<I", 0)


def bmp(page):
    height, width = page.shape
    rows = b"".join(np.repeat(r, 3).tobytes() + b"\0" * (-3 * width % 4) for r in page[::-1])
    return b"BM" + struct.pack("<IHHIIiiHHIIiiII", 54 + len(rows), 0, 0, 54, 40, width, height, 1, 24, 0, len(rows), 0, 0, 0, 0) + rows


def test_every_suffix_has_bands_and_crops(spark, tmp_path, monkeypatch):
    page = printed(4, 260, 700)
    (tmp_path / "a.png").write_bytes(png(page.tolist(), 8, 0, [0, 1, 2, 3, 4]))
    (tmp_path / "b.TIF").write_bytes(tiff(page))
    (tmp_path / "b2.tiff").write_bytes(tiff(page))
    (tmp_path / "c.bmp").write_bytes(bmp(page))
    (tmp_path / "d.webp").write_bytes(webp([0xFF000000 | int(v) * 0x10101 for v in page.ravel()], 260, random.Random(1), (2, 0)))
    (tmp_path / "lossy.webp").write_bytes(b"RIFF\x1a\0\0\0WEBPVP8 \x0e\0\0\0" + bytes(6) + struct.pack("<HH", 260, 700) + bytes(4))
    (tmp_path / "cut.webp").write_bytes((tmp_path / "d.webp").read_bytes()[:400])
    dirs = [str(tmp_path)]
    heads = readers.image_headers(spark, dirs).cache()
    assert {r.file_name: (r.width, r.height) for r in heads.collect()} == {n: (260, 700) for n in ("a.png", "b.TIF", "b2.tiff", "c.bmp", "d.webp", "lossy.webp", "cut.webp")}
    wanted = layout.page_hints(page, 260, 700, 1.0)
    assert len(wanted["horizontal_blank_bands"]) > 5 and wanted["crop_box"] == {"x0": 10, "x1": 250, "y0": 25, "y1": wanted["crop_box"]["y1"]}
    boxes = heads.select("path", F.col("file_name").alias("chunk_id"), F.lit(-3).alias("x0"), F.lit(40).alias("y0"), F.lit(120).alias("x1"), F.lit(900).alias("y1"))
    for large in (pages.LARGE_PIXELS, 100):  # the PNG page by Spark's image source, then by bands
        with monkeypatch.context() as patch:
            patch.setattr(pages, "LARGE_PIXELS", large)
            split = [r.path for r in heads.collect() if pages.banded((tmp_path / r.file_name).read_bytes()[:64], r.width, r.height)]
        both = readers.image_pixels(spark, dirs, heads.where(~F.col("path").isin(split))), readers.image_contents(spark, dirs, heads.where(F.col("path").isin(split)))
        hints = {r.path.rsplit("/", 1)[-1]: r.asDict(True) for r in layout.analyze(*both).collect()}
        assert set(hints) == {"a.png", "b.TIF", "b2.tiff", "c.bmp", "d.webp"}
        assert all({k: v for k, v in h.items() if k in wanted} == wanted for h in hints.values())
        cut = {r.chunk_id: r.crop for r in layout.crops(both[0], boxes, both[1]).collect()}
        assert set(cut) == set(hints) and all((pixels_of(c)[:, :, :1] == page[40:, :120, None]).all() for c in cut.values())


def test_hints_of_bands_are_those_of_the_whole_page(monkeypatch):
    page = printed(9, 700, 5300)
    small = layout.Thumbnail(700, 5300)
    monkeypatch.setattr(pages, "BAND_ROWS", 37)
    for rows in pages.bands(png(page.tolist(), 8, 0, [2]))[2]:
        small.add(layout._luma(rows))
    want, scale = layout.thumbnail(page)
    assert (small.pixels() == want).all() and small.scale == scale
    assert layout.page_hints(small.pixels(), 700, 5300, scale)["horizontal_blank_bands"]
