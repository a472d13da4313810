"""Page profiles: size classes, risk levels, slicing estimates, dataset statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Class limits.
STRIP_ASPECT, STRIP_HEIGHT = 10, 30_000
TABLE_PIXELS, TABLE_ASPECT = 15_000_000, (1.25, 1.55)
RISK_PIXELS = (("extreme", 50_000_000), ("high", 20_000_000), ("medium", 8_000_000))
MODEL_PIXELS, CHUNK_PIXELS = 16_777_216, 4_000_000


def pixels() -> Column:
    return F.col("width").cast("long") * F.col("height").cast("long")


def aspect() -> Column:
    return F.greatest("width", "height") / F.greatest(F.lit(1), F.least("width", "height"))


def profile(images: DataFrame) -> DataFrame:
    """Adds pixels, aspect, doc_type and risk_level to (file_name, width, height)."""
    sized = images.withColumn("pixels", pixels()).withColumn("aspect", aspect().cast("double"))
    strip = (F.col("aspect") >= STRIP_ASPECT) | (F.col("height") >= STRIP_HEIGHT)
    table = (F.col("pixels") >= TABLE_PIXELS) & F.col("aspect").between(*TABLE_ASPECT)
    kind = F.when(strip, "long_strip").when(table, "table_page").otherwise("normal_page")
    risk = F.lit("low")
    for name, least in reversed(RISK_PIXELS):
        risk = F.when(F.col("pixels") >= least, name).otherwise(risk)
    return sized.withColumn("doc_type", kind).withColumn("risk_level", risk)


def budgets(images: DataFrame) -> DataFrame:
    """Adds over-budget flags and the least number of slices for two pixel budgets."""
    p = F.col("pixels")
    out = images
    for name, least in (("over_16m", MODEL_PIXELS), ("over_50m", 50_000_000), ("over_100m", 100_000_000), ("over_200m", 200_000_000)):
        out = out.withColumn(name, p > least)
    ceil = lambda n: F.floor((p + n - 1) / n).cast("long")
    return out.withColumn("chunks_4m", ceil(CHUNK_PIXELS)).withColumn("chunks_16m", ceil(MODEL_PIXELS))


def statistics(images: DataFrame, *groups: str) -> DataFrame:
    """Counts, medians, linear 90th percentiles, maxima and slice totals of profiled, budgeted images."""
    mega = F.col("pixels") / 1_000_000
    return images.groupBy(*groups).agg(
        F.count(F.lit(1)).alias("n"), F.percentile(mega, F.lit(0.5)).alias("median_megapixels"), F.percentile(mega, F.lit(0.9)).alias("p90_megapixels"),
        F.max(mega).alias("max_megapixels"), F.percentile("aspect", F.lit(0.5)).alias("median_aspect"), F.max("aspect").alias("max_aspect"),
        F.sum(F.col("over_16m").cast("long")).alias("n_over_16m"), F.sum(F.col("over_100m").cast("long")).alias("n_over_100m"),
        F.sum("chunks_4m").alias("chunks_4m"), F.sum("chunks_16m").alias("chunks_16m"),
    )


def extremes(images: DataFrame, metric: str, n: int = 5) -> DataFrame:
    """The n images with the largest ``metric`` (a top-k report; ties by name)."""
    return images.orderBy(F.col(metric).desc(), "file_name").limit(n)


def pipe_table(table: DataFrame, columns: list[str], digits: int = 2) -> DataFrame:
    """(ordinal, line): a Markdown pipe table of a small report, numbers with thousands separators."""
    kinds = dict(table.dtypes)
    cell = lambda c: F.coalesce(F.format_number(c, digits) if kinds[c] in ("double", "float") else F.col(c).cast("string"), F.lit(""))
    row = F.concat(F.lit("| "), F.concat_ws(" | ", *map(cell, columns)), F.lit(" |"))
    spark = table.sparkSession
    head = spark.createDataFrame([(-2, "| " + " | ".join(columns) + " |"), (-1, "| " + " | ".join(["---"] * len(columns)) + " |")], "ordinal long, line string")
    return head.unionByName(table.select(F.monotonically_increasing_id().alias("ordinal"), row.alias("line")))
