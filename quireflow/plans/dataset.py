"""Dataset statistics: the images below folders, profiled by header, as tables and a Markdown report."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import profile
from ..sources import readers, sinks


def scan(spark: SparkSession, dirs: list[str]) -> DataFrame:
    """Profiled and budgeted images directly in each folder, with the folder's name; unreadable ones have null sizes."""
    listed = readers.list_images(spark, dirs)
    sized = listed.join(readers.image_headers(spark, dirs), ["file_name", "path"])
    folder = F.element_at(F.split("path", "/"), -2).alias("folder")
    return profile.budgets(profile.profile(sized.select("*", folder)))


def report(spark: SparkSession, dirs: list[str], path: str) -> None:
    """Write ``path``/images (JSON), ``path``/statistics (JSON) and ``path``/report (Markdown pipe tables by folder and type, and the largest pages)."""
    images = scan(spark, dirs).where("width is not null").cache()
    sinks.write_json(images, f"{path}/images")
    by = profile.statistics(images, "folder", "doc_type")
    sinks.write_json(by, f"{path}/statistics")
    parts = [(by.orderBy("folder", "doc_type"), "Pages by folder and type"), (profile.extremes(images, "pixels").select("folder", "file_name", "width", "height", "pixels", "doc_type", "risk_level"), "Largest pages")]
    lines = None
    for i, (part, title) in enumerate(parts):
        table = profile.pipe_table(part, part.columns).select((F.lit(i * (1 << 40)) + F.col("ordinal")).alias("ordinal"), "line")
        head = spark.createDataFrame([(i * (1 << 40) - 9, f"## {title}"), (i * (1 << 40) - 8, "")], "ordinal long, line string")
        lines = head.unionByName(table) if lines is None else lines.unionByName(head).unionByName(table)
    sinks.write_text(lines, f"{path}/report", "ordinal")
    images.unpersist()
