"""Profiles, chunkers, bands and reading order."""

import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from quireflow.operators import chunking, layout, ordering, profile
from quireflow.sources import readers


def images(spark, *sizes):
    return profile.profile(spark.createDataFrame([(f"{i}.png", w, h, "s" * 40) for i, (w, h) in enumerate(sizes)], "file_name string, width int, height int, image_sha1 string"))


def test_profile(spark):
    rows = images(spark, (100, 1200), (4000, 5600), (8000, 8000), (0, 0)).orderBy("file_name").collect()
    assert [r.doc_type for r in rows] == ["long_strip", "table_page", "normal_page", "normal_page"]
    assert rows[1].pixels == 22_400_000 and [r.risk_level for r in rows] == ["low", "high", "extreme", "low"]


def test_strip_without_bands(spark):
    rows = chunking.long_strip(images(spark, (900, 10000))).orderBy("row").collect()
    assert [(r.y0, r.y1) for r in rows] == [(0, 4000), (3680, 7680), (7360, 10000)]
    assert [(r.overlap["top"], r.overlap["bottom"]) for r in rows] == [(0, 320), (320, 320), (320, 0)]


def plain_windows(height, bands, window=4000, overlap=320):
    out, y0 = [], 0
    while y0 < height:
        y1 = min(height, y0 + window)
        if y1 < height:
            centres = [(s + e) // 2 for s, e in bands]
            near = [c for c in centres if abs(c - y1) <= overlap]
            y1 = max(1, min(near, key=lambda c: abs(c - y1))) if near else y1
        out.append((y0, y1))
        if y1 >= height:
            break
        y0 = max(y1 - overlap, y0 + 1)
    return out


@pytest.mark.parametrize("seed", range(4))
def test_strip_with_bands(spark, seed):
    rng = np.random.default_rng(seed)
    height = int(rng.integers(100, 45000))
    starts = np.sort(rng.integers(0, max(1, height - 60), 30))
    bands = [(int(s), int(s + rng.integers(4, 50))) for s in starts]
    one = images(spark, (900, height)).withColumn("bands", F.array(*(F.struct(F.lit(s).alias("s"), F.lit(e).alias("e")) for s, e in bands)))
    got = [(r.y0, r.y1) for r in chunking.long_strip(one, bands="bands").orderBy("row").collect()]
    assert got == plain_windows(height, bands)


@pytest.mark.parametrize(("width", "height", "chunk", "page"), [(7300, 3900, 9_000_000, 11_000_000), (2500, 9800, 4_000_000, 8_000_000), (9001, 7003, 4_000_000, 8_000_000)])
def test_grid_covers_the_page(spark, width, height, chunk, page):
    cut = chunking.with_ids(chunking.grid(images(spark, (width, height), (120, 90)), chunk, page)).cache()
    big = cut.where("file_name = '0.png'").collect()
    cols, rows = 1 + max(r.col for r in big), 1 + max(r.row for r in big)
    assert len(big) == cols * rows > 1 and len({r.chunk_id for r in big}) == len(big)
    held = np.zeros((height, width), bool)
    for r in big:
        held[r.y0 : r.y1, r.x0 : r.x1] = True
        # an even cell and what its inner edges are widened by
        assert (r.x1 - r.x0) <= -(-width // cols) + 2 * chunking.GRID_X and (r.y1 - r.y0) <= -(-height // rows) + 2 * chunking.GRID_Y
        assert 0 <= r.x0 < r.x1 <= width and 0 <= r.y0 < r.y1 <= height
    assert held.all()
    [small] = cut.where("file_name = '1.png'").collect()
    assert (small.x0, small.y0, small.x1, small.y1) == (0, 0, 120, 90)
    assert all(chunking.coverage(cut).select("in_bounds").toPandas().in_bounds) and chunking.manifest(cut).count() == 2


def test_blank_bands(spark):
    density = [0.0] * 5 + [0.5] * 10 + [0.01] * 2 + [0.9] * 3 + [0.0] * 4
    rows = spark.createDataFrame([("a", i, v) for i, v in enumerate(density)], "k string, i int, density double")
    assert sorted((r.s, r.e) for r in layout.blank_bands(rows, "k").collect()) == [(0, 5), (20, 24)]


def test_blank_bands_are_dealt_by_rows(spark, monkeypatch):
    """Partitions hold a number of rows, however small these are as shuffle files, and are sorted once."""
    monkeypatch.setattr(layout, "BAND_ROWS", 600, raising=False)
    dark = {(k, i) for k in range(60) for i in range(120) if (k * 31 + i * i) % 11 >= 8}
    rows = spark.createDataFrame([(k, i, 0.5 if (k, i) in dark else 0.0) for k in range(60) for i in range(120)], "k long, i int, density double")
    want = []
    for k in range(60):
        edges = [-1, *(i for i in range(120) if (k, i) in dark), 120]
        want += [(k, a + 1, b) for a, b in zip(edges, edges[1:]) if b - a > 3]
    found = layout.blank_bands(rows, "k")
    assert sorted(map(tuple, found.collect())) == want
    assert found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1].count("Sort [") == 1
    assert found.rdd.getNumPartitions() == 60 * 120 // 600 + 1


def test_band_mapping(spark):
    cases = [(3, 7, 2.0, 50), (11, 30, 5.0, 120), (1, 3, 2.5, 100), (-4, 2, 3.0, 9), (5, 5, 1.5, 6), (0, 900, 0.5, 100)]
    rows = spark.createDataFrame(cases, "s int, e int, scale double, n int")
    got = rows.select(layout.to_original(F.struct("s", "e"), F.col("scale"), F.col("n")).alias("b"), "*").collect()
    for r in got:
        want = [max(0, min(r.n, round(x * r.scale))) for x in (r.s, r.e)]
        assert tuple(r.b) == (want[0], max(want))


def png(path, gray):
    h, w = gray.shape
    part = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    raw = b"".join(b"\0" + gray[y].tobytes() for y in range(h))
    path.write_bytes(b"\x89PNG\r\n\x1a\n" + part(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 0, 0, 0, 0)) + part(b"IDAT", zlib.compress(raw)) + part(b"IEND", b""))


def test_image_scan_and_layout(spark, tmp_path):
    page = np.full((640, 410), 253, np.uint8)
    blocks = [(31, 47, 385, 150), (31, 233, 240, 301), (77, 402, 385, 590)]
    for x0, y0, x1, y1 in blocks:
        page[y0:y1, x0:x1] = 17
    png(tmp_path / "k.png", page)
    png(tmp_path / "l.PNG", np.full((90, 700), 241, np.uint8))
    (tmp_path / "list.md").write_text("no image")
    (tmp_path / "m.jpeg").write_bytes(b"\xff\xd8\xff\xe0cut off")
    dirs = [str(tmp_path)]
    assert sorted(r.file_name for r in readers.list_images(spark, dirs).collect()) == ["k.png", "l.PNG", "m.jpeg"]
    heads = {r.file_name: (r.width, r.height, r.banded) for r in readers.image_headers(spark, dirs).collect()}
    assert heads == {"k.png": (410, 640, False), "l.PNG": (700, 90, False), "m.jpeg": (None, None, False)}
    hints = {r.path.rsplit("/", 1)[-1]: r.asDict(True) for r in layout.analyze(readers.image_pixels(spark, dirs)).collect()}
    assert hints["k.png"]["crop_box"] == {"x0": 31, "y0": 47, "x1": 385, "y1": 590}
    assert [(b["s"], b["e"]) for b in hints["k.png"]["horizontal_blank_bands"]] == [(0, 47), (150, 233), (301, 402), (590, 640)]
    assert [(b["s"], b["e"]) for b in hints["k.png"]["vertical_blank_bands"]] == [(0, 31), (385, 410)]
    assert hints["l.PNG"] | {"path": ""} == {"path": "", "width": 700, "height": 90, "crop_box": {"x0": 0, "y0": 0, "x1": 700, "y1": 90}, "horizontal_blank_bands": [], "vertical_blank_bands": [], "table_line_density": 0.0, "column_count": 1}


def test_images_without_pixels_and_crops(spark, tmp_path):
    page = np.arange(60 * 40, dtype=np.uint8).reshape(60, 40)
    png(tmp_path / "a.png", page)
    whole = (tmp_path / "a.png").read_bytes()
    (tmp_path / "b.png").write_bytes(whole[:33])  # a sound header and nothing else
    sizes = {r.file_name: (r.width, r.height) for r in readers.image_headers(spark, [str(tmp_path)]).collect()}
    assert sizes == {"a.png": (40, 60), "b.png": (40, 60)}
    listed = readers.list_images(spark, [str(tmp_path)])
    chosen = listed.where("file_name = 'a.png'")
    assert [r.file_name for r in readers.image_headers(spark, [str(tmp_path)], chosen).collect()] == ["a.png"]
    pixels = readers.image_pixels(spark, [str(tmp_path)], listed)
    assert layout.analyze(pixels).count() == 1 and layout.analyze(readers.image_pixels(spark, [str(tmp_path)], listed.limit(0))).count() == 0
    boxes = listed.select("path", F.col("file_name").alias("chunk_id"), F.lit(5).alias("x0"), F.lit(10).alias("y0"), F.lit(25).alias("x1"), F.lit(30).alias("y1"))
    got = layout.crops(pixels, boxes).collect()
    assert [r.chunk_id for r in got] == ["a.png"]
    (tmp_path / "cut").mkdir()
    (tmp_path / "cut" / "c.png").write_bytes(got[0].crop)
    row = readers.image_pixels(spark, [str(tmp_path / "cut")]).first()
    assert (row.height, row.width) == (20, 20) and (np.frombuffer(row.data, np.uint8).reshape(20, 20, -1)[:, :, 0] == page[10:30, 5:25]).all()
    colours = np.stack([page, page[::-1], page.T.copy().reshape(60, 40)], axis=2)
    (tmp_path / "cut" / "c.png").write_bytes(layout.png(colours))
    row = readers.image_pixels(spark, [str(tmp_path / "cut")]).first()
    assert (np.frombuffer(row.data, np.uint8).reshape(60, 40, 3)[:, :, ::-1] == colours).all()


def test_thumbnail():
    big = np.tile(np.array([[0, 255], [255, 0]], np.uint8), (1500, 200))
    small, scale = layout.thumbnail(big)
    assert small.shape[0] == 1200 and scale == pytest.approx(0.4)


def test_sampling(spark):
    rows = spark.createDataFrame([(d, f"{n}{i}.png") for d, n in ((0, "a"), (1, "b")) for i in range(3)], "dir_ord int, file_name string")
    names = lambda df: [r.file_name for r in df.orderBy("dir_ord", "file_name").collect()]
    assert names(readers.sample(rows, 2)) == ["a0.png", "a1.png", "b0.png", "b1.png"]
    assert names(readers.sample(rows, 2, 3)) == ["a0.png", "a1.png", "b0.png"]


def test_reading_order(spark):
    strip = spark.createDataFrame([("f", "long_strip", 0, 0, 100, 300, 0, "third"), ("f", "long_strip", 0, 0, 0, 0, 1, "first"), ("f", "long_strip", 0, 0, 10, 300, 2, "second")], "file_name string, doc_type string, row int, col int, x0 int, y0 int, ordinal int, t string")
    assert [r.t for r in ordering.reading_order(strip).orderBy("rank").collect()] == ["first", "second", "third"]
    cells = spark.createDataFrame([("f", "table_page", 1, 1, 0, 0, 0, "r1c1"), ("f", "table_page", -1, -1, 0, 0, 1, "ref"), ("f", "table_page", 0, 1, 0, 0, 2, "r0c1"), ("f", "table_page", 0, 0, 0, 0, 3, "r0c0")], strip.schema)
    assert [r.t for r in ordering.reading_order(cells).orderBy("rank").collect()] == ["r0c0", "r0c1", "r1c1"]
