"""Reading order: reference cells leave, chunks get their rank, tables of contents their type."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import is_toc


def is_reference_chunk() -> Column:
    """Whole-page helper cells of a table page stand at negative rows or columns."""
    return (F.col("doc_type") == "table_page") & ((F.col("row") < 0) | (F.col("col") < 0))


def reading_order(chunks: DataFrame, ordinal: str = "ordinal", file: str = "file_name") -> DataFrame:
    """Adds ``rank`` (from 1) per file: rows and columns on table pages, else top to bottom; ties keep ``ordinal`` order."""
    table = F.col("doc_type") == "table_page"
    keys = [F.when(table, F.col("row")), F.when(table, F.col("col")), F.col("y0"), F.col("x0"), F.col(ordinal)]
    return chunks.where(~F.coalesce(is_reference_chunk(), F.lit(False))).withColumn("rank", F.row_number().over(Window.partitionBy(file).orderBy(*keys)))


def mark_toc(chunks: DataFrame, markdown: str = "markdown") -> DataFrame:
    """block_type becomes toc where the text reads like one."""
    return chunks.withColumn("block_type", F.when(is_toc(F.col(markdown)), "toc").otherwise(F.col("block_type")))
