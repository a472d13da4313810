"""Blank bands and ink statistics of page images."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..sources import pages

#: Ink is darker than INK; a blank line has at most BLANK ink; thumbnails are at most THUMB wide or high.
INK, BLANK, THUMB, FLAT = 245, 0.01, 1200, 2.0
#: Rows of a series that one task sorts, keys kept whole.
BAND_ROWS = 1 << 19
HINTS = (
    "path string, width int, height int, crop_box struct<x0:int,y0:int,x1:int,y1:int>, horizontal_blank_bands array<struct<s:int,e:int>>, "
    "vertical_blank_bands array<struct<s:int,e:int>>, table_line_density double, column_count int"
)


def least_band(n: Column) -> Column:
    return F.greatest(F.lit(3), F.floor(n / 100)).cast("int")


def blank_bands(series: DataFrame, key: str, position: str = "i", value: str = "density", threshold: float = BLANK) -> DataFrame:
    """(key, s, e): maximal half-open runs of values at or below the threshold, no shorter than least_band.

    Gaps and islands: within a run, position minus rank is constant.  Rows shrink so much as shuffle files that partitions
    merged by bytes would hold many millions of them, so they are dealt by number; one sort by key and position serves both windows.
    """
    dealt = series.repartition(series.count() // BAND_ROWS + 1, key)
    whole = Window.partitionBy(key).orderBy(position)
    blank = dealt.withColumn("n", F.count(F.lit(1)).over(whole.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).where(F.col(value) <= threshold)
    island = F.col(position) - F.row_number().over(whole)
    runs = blank.withColumn("island", island).groupBy(key, "n", "island").agg(F.min(position).alias("s"), (F.max(position) + 1).alias("e"))
    return runs.where(F.col("e") - F.col("s") >= least_band(F.col("n"))).select(key, F.col("s").cast("int").alias("s"), F.col("e").cast("int").alias("e"))


def to_original(band: Column, scale: Column, limit: Column) -> Column:
    """A thumbnail band in original pixels: scaled with ties to even, clamped, never reversed."""
    end_of = lambda x: F.bround(x * scale, 0).cast("int")
    start = F.greatest(F.lit(0), F.least(limit, end_of(band["s"])))
    return F.struct(start.alias("s"), F.greatest(start, F.least(limit, end_of(band["e"]))).alias("e"))


class Thumbnail:
    """A page shrunk by box averages to at most ``longest`` pixels a side, from its rows as they come."""

    def __init__(self, width: int, height: int, longest: int = THUMB):
        self.scale = min(1.0, longest / max(width, height))
        self.size = height, width
        self.y, self.x = ((np.arange(max(1, int(n * self.scale))) * n // max(1, int(n * self.scale))) for n in (height, width))
        self.sums = np.zeros((len(self.y), len(self.x)), np.uint32)
        self.seen = 0

    def add(self, gray: np.ndarray) -> None:
        """The next rows of the page."""
        place = np.searchsorted(self.y, np.arange(self.seen, self.seen + len(gray)), "right") - 1
        first = np.flatnonzero(np.diff(place, prepend=-1))
        self.sums[place[first]] += np.add.reduceat(np.add.reduceat(gray, self.x, axis=1, dtype=np.uint32), first, axis=0)
        self.seen += len(gray)

    def pixels(self) -> np.ndarray:
        height, width = (np.diff(np.append(at, n)) for at, n in zip((self.y, self.x), self.size, strict=True))
        area = (height[:, None] * width[None, :]).astype(np.uint32)
        return ((self.sums + area // 2) // area).astype(np.uint8)


def thumbnail(gray: np.ndarray, longest: int = THUMB) -> tuple[np.ndarray, float]:
    """The thumbnail of a page that is at hand as a whole, and its scale."""
    small = Thumbnail(gray.shape[1], gray.shape[0], longest)
    small.add(gray)
    return small.pixels(), small.scale


def _luma(rows: np.ndarray) -> np.ndarray:
    """8-bit luma of rows of gray or RGB pixels (ITU-R 601 weights)."""
    if rows.shape[2] == 1:
        return rows[:, :, 0]
    sums = rows[:, :, 0] * np.uint32(19595)
    sums += rows[:, :, 1] * np.uint32(38470)
    sums += rows[:, :, 2] * np.uint32(7471)
    return (sums + np.uint32(0x8000) >> np.uint32(16)).astype(np.uint8)


class _Side:
    """Ink along one side of a thumbnail: its share per line, blank runs, extent, dense lines."""

    def __init__(self, ink: np.ndarray, axis: int, page: int, scale: float):
        self.share, held = ink.mean(axis=axis), np.flatnonzero(ink.any(axis=axis))
        self.page, self.back = page, 1.0 / scale
        self.extent = (int(held[0] * self.back), int(min(page, (held[-1] + 1) * self.back))) if len(held) else (0, page)

    def blank(self) -> list[dict[str, int]]:
        """Blank runs in pixels of the page."""
        low = np.concatenate(([0], (self.share <= BLANK).astype(np.int8), [0]))
        runs = np.flatnonzero(np.diff(low)).reshape(-1, 2)
        runs = runs[np.diff(runs, axis=1)[:, 0] >= max(3, len(self.share) // 100)]
        runs = np.maximum.accumulate(np.clip(np.rint(runs * self.back).astype(int), 0, self.page), axis=1)
        return [{"s": s, "e": e} for s, e in runs.tolist()]

    def above(self, share: float) -> float:
        """Share of lines with more ink."""
        return float((self.share > share).mean())


def page_hints(gray: np.ndarray, width: int, height: int, scale: float) -> dict:
    """Crop box, blank bands, line density and column count of one gray thumbnail; ``scale`` is thumbnail / original."""
    down, across = (_Side(gray < INK, axis, page, scale) for axis, page in ((1, height), (0, width)))
    bands, gaps = down.blank(), across.blank()
    hints = {"crop_box": dict(zip(("x0", "x1", "y0", "y1"), across.extent + down.extent, strict=True)), "horizontal_blank_bands": bands, "vertical_blank_bands": gaps}
    columns = 2 if gaps and across.above(max(0.03, across.share.mean() * 1.5)) > 0.05 else 1
    hints |= {"table_line_density": (down.above(0.35) + across.above(0.35)) / 2, "column_count": columns}
    if gray.std() < FLAT:  # a page of one shade has nothing on it
        hints = {"crop_box": {"x0": 0, "x1": width, "y0": 0, "y1": height}, "horizontal_blank_bands": [], "vertical_blank_bands": [], "table_line_density": 0.0, "column_count": 1}
    return hints


def _source_rows(row: dict) -> np.ndarray:
    """A row of Spark's image source as gray or RGB pixels."""
    page = np.frombuffer(row["data"], np.uint8).reshape(row["height"], row["width"], row["nChannels"])
    return page if row["nChannels"] == 1 else page[:, :, 2::-1]  # channels are in BGR order


_SOURCE = ("height", "width", "nChannels", "data")


def _opened(row: dict) -> pages.Bands | None:
    """Width, height and bands of pixels of a row with ``content`` (a file) or of Spark's image source; nothing of what can't be decoded."""
    if "content" not in row:
        return row["width"], row["height"], iter([_source_rows(row)])
    try:
        return pages.bands(row["content"])
    except (pages.Undecodable, zlib.error, struct.error, IndexError):
        return None


def _decoded(images: DataFrame | None, files: DataFrame | None, fields: list[str], run: Callable[[dict, pages.Bands], Iterator[dict]], schema: str) -> DataFrame:
    """What ``run`` makes of each decodable image, of both sources, one at a time."""
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {k: batch.column(k)[i].as_py() for k in batch.schema.names}
                opened = _opened(row)
                try:
                    for made in run(row, opened) if opened else ():
                        yield pa.RecordBatch.from_pylist([made], schema=arrow)
                except (pages.Undecodable, zlib.error):
                    continue  # a file that breaks off

    parts = []
    if images is not None:
        parts.append(images.where("height > 0 and width > 0").select(*fields, *_SOURCE))
    if files is not None:
        parts.append(files.select(*fields, "content"))
    return reduce(DataFrame.unionByName, [p.mapInArrow(each, schema) for p in parts])


def analyze(images: DataFrame | None, files: DataFrame | None = None) -> DataFrame:
    """Layout hints of images: of Spark's image source (path, height, width, nChannels, data) and of files (path, content), whose
    pixels are never together in memory; images that can't be decoded have none."""

    def run(row: dict, opened: pages.Bands) -> Iterator[dict]:
        width, height, bands = opened
        small = Thumbnail(width, height)
        for rows in bands:
            small.add(_luma(rows))
        yield {"path": row["path"], "width": width, "height": height} | page_hints(small.pixels(), width, height, small.scale)

    return _decoded(images, files, ["path"], run, HINTS)


def png(pixels: np.ndarray) -> bytes:
    """A PNG file of 8-bit gray (h, w) or RGB (h, w, 3) pixels."""
    height, width = pixels.shape[:2]
    rows = np.zeros((height, 1 + pixels[0].size), np.uint8)  # each line begins with its filter, none
    rows[:, 1:] = pixels.reshape(height, -1)

    def part(kind: bytes, data: bytes) -> bytes:
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

    head = struct.pack(">IIBBBBB", width, height, 8, 2 if pixels.ndim == 3 else 0, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + part(b"IHDR", head) + part(b"IDAT", zlib.compress(rows.tobytes(), 6)) + part(b"IEND", b"")


def crops(images: DataFrame | None, boxes: DataFrame, files: DataFrame | None = None) -> DataFrame:
    """(chunk_id, crop): a PNG of each box (path, chunk_id, x0, y0, x1, y1) of the images and files; each image is read once.

    Of a file's rows only those of boxes that aren't complete yet are held. Of an image that breaks off, the boxes before that are cut."""
    held = boxes.groupBy("path").agg(F.array_sort(F.collect_list(F.struct("y0", "y1", "x0", "x1", "chunk_id"))).alias("boxes"))

    def run(row: dict, opened: pages.Bands) -> Iterator[dict]:
        width, height, bands = opened
        inside = lambda b: max(0, b["y0"]) < min(b["y1"], height) and max(0, b["x0"]) < min(b["x1"], width)
        todo = [(b, []) for b in row["boxes"] if inside(b)]
        top = 0
        for rows in bands:
            bottom = top + len(rows)
            for b, parts in todo:
                lo, hi = max(top, b["y0"]), min(bottom, b["y1"])
                if lo < hi:
                    parts.append(rows[lo - top : hi - top, max(0, b["x0"]) : b["x1"]].copy())
            top = bottom
            done = [(b, parts) for b, parts in todo if min(b["y1"], height) <= bottom]
            todo = [(b, parts) for b, parts in todo if min(b["y1"], height) > bottom]
            for b, parts in done:
                cut = np.concatenate(parts)
                yield {"chunk_id": b["chunk_id"], "crop": png(cut[:, :, 0] if cut.shape[2] == 1 else cut)}

    met = lambda df: None if df is None else df.join(held, "path")
    return _decoded(met(images), met(files), ["boxes"], run, "chunk_id string, crop binary")
