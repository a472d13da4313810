"""Chunk generators: vertical windows snapped to blank bands, grids, chunk ids, coverage, text windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Defaults of the shipped configuration.
WINDOW, OVERLAP = 4000, 320
CHUNK_PIXELS, PAGE_PIXELS = 4_000_000, 8_000_000
GRID_X, GRID_Y = 160, 220
_BOX = "struct<y0:int,y1:int>"


def _snapped(y: Column, bands: Column, overlap: int) -> Column:
    """The centre of the blank band nearest to y within the overlap (first of equals), else y."""
    near = F.transform(bands, lambda b, i: F.struct(F.abs(F.floor((b["s"] + b["e"]) / 2) - y).alias("d"), i.alias("i"), F.floor((b["s"] + b["e"]) / 2).cast("int").alias("c")))
    best = F.array_min(F.filter(near, lambda c: c["d"] <= overlap))
    return F.when(best.isNotNull(), F.greatest(F.lit(1), best["c"])).otherwise(y).cast("int")


def strip_windows(height: Column, bands: Column | None = None, window: int = WINDOW, overlap: int = OVERLAP) -> Column:
    """Array of (y0, y1) windows down a strip, in one expression over the row.

    Without bands the windows have a closed form; with bands each start depends on the window before,
    so the array is folded over as many steps as could be needed.
    """
    if bands is None:
        if window > overlap:
            stride = window - overlap
            n = F.when(height <= window, F.lit(1)).otherwise(F.ceil((height - overlap) / stride)).cast("int")
            at = lambda k: F.struct((k * stride).cast("int").alias("y0"), F.least(height, k * stride + window).cast("int").alias("y1"))
            return F.when(height > 0, F.transform(F.sequence(F.lit(0), F.greatest(n, F.lit(1)) - 1), at)).otherwise(F.array().cast(f"array<{_BOX}>"))
        bands = F.array().cast("array<struct<s:int,e:int>>")
    stride = max(1, window - 2 * overlap)
    steps = F.sequence(F.lit(1), F.greatest(F.lit(1), F.ceil(height / stride).cast("int") + 1))

    def add(done: Column, _: Column) -> Column:
        y0 = F.when(F.size(done) == 0, F.lit(0)).otherwise(F.greatest(F.try_element_at(done, F.lit(-1))["y1"] - overlap, F.try_element_at(done, F.lit(-1))["y0"] + 1))
        ended = F.coalesce(F.try_element_at(done, F.lit(-1))["y1"] >= height, F.lit(False))
        y1 = F.least(height, y0 + window)
        y1 = F.when(y1 < height, _snapped(y1, bands, overlap)).otherwise(y1)
        return F.when(ended | (y0 >= height), done).otherwise(F.concat(done, F.array(F.struct(y0.cast("int").alias("y0"), y1.cast("int").alias("y1")))))

    return F.aggregate(steps, F.array().cast(f"array<{_BOX}>"), add)


def _overlaps(**sides: Column) -> Column:
    return F.create_map(*(x for k, v in sides.items() for x in (F.lit(k), v.cast("int"))))


def long_strip(images: DataFrame, window: int = WINDOW, overlap: int = OVERLAP, bands: str | None = None) -> DataFrame:
    """One row per window of each strip: x0, y0, x1, y1, row, col, overlap."""
    boxes = strip_windows(F.col("height"), F.col(bands) if bands else None, window, overlap)
    rows = images.select("*", F.posexplode(boxes).alias("row", "box"))
    side = lambda there: F.when(there, F.lit(overlap)).otherwise(F.lit(0))
    return rows.select(
        *images.columns, F.lit(0).alias("x0"), F.col("box.y0").alias("y0"), F.col("width").cast("int").alias("x1"), F.col("box.y1").alias("y1"), F.col("row").cast("int").alias("row"), F.lit(0).alias("col"),
        _overlaps(top=side(F.col("box.y0") > 0), bottom=side(F.col("box.y1") < F.col("height"))).alias("overlap"),
    )


def grid(images: DataFrame, chunk_pixels: int = CHUNK_PIXELS, page_pixels: int = PAGE_PIXELS, overlap_x: int = GRID_X, overlap_y: int = GRID_Y) -> DataFrame:
    """One row per cell: whole pages up to ``page_pixels``, else an even grid whose inner edges are widened."""
    small = F.col("pixels") <= page_pixels
    cols = F.greatest(F.lit(1), F.ceil(F.sqrt(F.col("pixels") / chunk_pixels))).cast("int")
    rows = F.greatest(F.lit(1), F.ceil(F.col("pixels") / (F.col("n_cols") * chunk_pixels))).cast("int")
    sized = images.withColumn("n_cols", F.when(small, F.lit(1)).otherwise(cols)).withColumn("n_rows", F.when(small, F.lit(1)).otherwise(rows))
    cells = sized.withColumn("row", F.explode(F.sequence(F.lit(0), F.col("n_rows") - 1))).withColumn("col", F.explode(F.sequence(F.lit(0), F.col("n_cols") - 1)))

    def edges(k: str, n: str, size: str, widen: int) -> tuple[Column, Column]:
        cut = lambda i: F.floor(i.cast("long") * F.col(size) / F.col(n))
        start = F.greatest(F.lit(0), cut(F.col(k)) - F.when(F.col(k) > 0, widen).otherwise(0))
        return start.cast("int"), F.least(F.col(size), cut(F.col(k) + 1) + F.when(F.col(k) < F.col(n) - 1, widen).otherwise(0)).cast("int")

    (x0, x1), (y0, y1) = edges("col", "n_cols", "width", overlap_x), edges("row", "n_rows", "height", overlap_y)
    side = lambda k, most: F.when(F.col(k) > 0, F.lit(most)).otherwise(F.lit(0))
    return cells.select(
        *images.columns, x0.alias("x0"), y0.alias("y0"), x1.alias("x1"), y1.alias("y1"), "row", "col",
        _overlaps(left=side("col", overlap_x), right=F.lit(overlap_x), top=side("row", overlap_y), bottom=F.lit(overlap_y)).alias("overlap"),
    )


def chunk_id(file_name: Column, x0: Column, y0: Column, x1: Column, y1: Column, image_sha1: Column) -> Column:
    """The first 16 hex digits of the SHA-1 of name, box and image digest in their fixed notation."""
    box = F.concat(F.lit("("), F.concat_ws(", ", *(c.cast("string") for c in (x0, y0, x1, y1))), F.lit(")"))
    return F.left(F.sha1(F.concat_ws(":", file_name, box, image_sha1).cast("binary")), F.lit(16))


def with_ids(chunks: DataFrame) -> DataFrame:
    return chunks.withColumn("chunk_id", chunk_id(*(F.col(c) for c in ("file_name", "x0", "y0", "x1", "y1", "image_sha1"))))


def chunk(images: DataFrame, bands: str | None = None, window: int = WINDOW, overlap: int = OVERLAP, **grid_options) -> DataFrame:
    """Chunks of profiled images (file_name, image_sha1, doc_type, ...), by document type."""
    strips = long_strip(images.where("doc_type = 'long_strip'"), window, overlap, bands)
    pages = grid(images.where("doc_type <> 'long_strip'"), **grid_options)
    return with_ids(strips.unionByName(pages))


def manifest(chunks: DataFrame) -> DataFrame:
    """(file_name, manifest): one JSON document per file, its chunks in row and column order."""
    one = F.struct("row", "col", "chunk_id", F.struct("x0", "y0", "x1", "y1").alias("bbox"), F.map_entries("overlap").alias("overlap"), "image_sha1")
    rows = chunks.groupBy("file_name", "width", "height", "doc_type").agg(F.array_sort(F.collect_list(one)).alias("chunks"))
    rebuilt = F.transform("chunks", lambda c: F.struct(c["chunk_id"].alias("chunk_id"), c["row"].alias("row"), c["col"].alias("col"), c["bbox"].alias("bbox"), F.map_from_entries(c["overlap"]).alias("overlap"), c["image_sha1"].alias("image_sha1")))
    return rows.select("file_name", F.to_json(F.struct("file_name", "width", "height", "doc_type", rebuilt.alias("chunks"))).alias("manifest"))


def coverage(chunks: DataFrame) -> DataFrame:
    """(file_name, covered, in_bounds): windows leave no row of the page out and stay on it."""
    before = F.max("y1").over(Window.partitionBy("file_name").orderBy("y0", "y1").rowsBetween(Window.unboundedPreceding, -1))
    flagged = chunks.withColumn("gap", F.coalesce(F.col("y0") > before, F.col("y0") > 0))
    inside = (F.col("x0") >= 0) & (F.col("y0") >= 0) & (F.col("x1") <= F.col("width")) & (F.col("y1") <= F.col("height")) & (F.col("x0") < F.col("x1")) & (F.col("y0") < F.col("y1"))
    return flagged.groupBy("file_name").agg((~F.bool_or("gap") & (F.max(F.col("y1") - F.col("height")) == 0)).alias("covered"), F.bool_and(inside).alias("in_bounds"))


def text_windows(docs: DataFrame, window: int = 400, overlap: int = 80, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The one-dimensional chunker over characters: (key, row, y0, y1, markdown)."""
    rows = docs.select(key, F.col(text).alias("t"), F.posexplode(strip_windows(F.length(text), None, window, overlap)).alias("row", "box"))
    return rows.select(key, F.col("row").cast("int").alias("row"), F.col("box.y0").alias("y0"), F.col("box.y1").alias("y1"), F.substring(F.col("t"), F.col("box.y0") + 1, F.col("box.y1") - F.col("box.y0")).alias("markdown"))
