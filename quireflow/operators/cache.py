"""Content-addressed cache of recognised chunks, and resuming from merged files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VALIDATOR_VERSION = 1
SCHEMA = "chunk_id string, image_sha1 string, api_url string, content_validated boolean, validator_version int, response_sha1 string, markdown string"


def text_sha1(column: str = "markdown"):
    return F.sha1(F.coalesce(F.col(column), F.lit("")).cast("binary"))


def hits(chunks: DataFrame, cache: DataFrame, api_url: str) -> DataFrame:
    """Chunks with a valid cached text: same chunk, image and service, validated by this version, digest intact."""
    valid = cache.where((F.col("api_url") == api_url) & F.col("content_validated") & (F.col("validator_version") == VALIDATOR_VERSION) & (F.col("response_sha1") == text_sha1()))
    # one row per chunk: appends may repeat it
    best = valid.groupBy("chunk_id", "image_sha1").agg(F.max("markdown").alias("markdown"))
    return chunks.join(best, ["chunk_id", "image_sha1"]).withColumn("source", F.lit("cache"))


def misses(chunks: DataFrame, found: DataFrame) -> DataFrame:
    return chunks.join(found.select("chunk_id", "image_sha1"), ["chunk_id", "image_sha1"], "left_anti")


def entries(recognised: DataFrame, api_url: str) -> DataFrame:
    """Cache rows of successfully recognised chunks."""
    return recognised.where("ok").select(
        "chunk_id", "image_sha1", F.lit(api_url).alias("api_url"), F.lit(True).alias("content_validated"), F.lit(VALIDATOR_VERSION).alias("validator_version"),
        text_sha1().alias("response_sha1"), "markdown",
    )


def work_list(files: DataFrame, merged: DataFrame | None, resume: bool = True, force: bool = False, key: str = "file_name") -> tuple[DataFrame, DataFrame | None]:
    """(files to process, finished files with their text). Nothing is taken over without ``resume`` or with ``force``."""
    if merged is None or not resume or force:
        return files, None
    return files.join(merged.select(key), key, "left_anti"), files.join(merged.select(key, "markdown"), key)
