"""Quality gates: files, inputs, submissions, run summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.html import faults
from ..functions.text import duplication_ratio

#: Least characters by document type; limits are strict.
MIN_CHARS = {"long_strip": 2000, "table_page": 5000}
MAX_DUPLICATION, MAX_FAILURE = 0.18, 0.20


def _tested(risk: str, when: Column) -> Column:
    return F.when(F.coalesce(when, F.lit(False)), F.lit(risk))


def check_files(files: DataFrame, max_duplication: float = MAX_DUPLICATION, max_failure: float = MAX_FAILURE, min_chars: dict[str, int] | None = None) -> DataFrame:
    """Adds chars, duplication_ratio, api_failure_ratio, risks and passed to (markdown, doc_type, chunk_count, failed_chunks).

    One projection: no shuffle, no Python.
    """
    text = F.coalesce(F.col("markdown"), F.lit(""))
    least = F.lit(0)
    for kind, n in (MIN_CHARS if min_chars is None else min_chars).items():
        least = F.when(F.col("doc_type") == kind, F.lit(n)).otherwise(least)
    ratio = F.when(F.col("chunk_count") > 0, F.col("failed_chunks") / F.col("chunk_count")).otherwise(F.lit(0.0))
    taken = [c for c in files.columns if c not in ("chars", "duplication_ratio", "api_failure_ratio", "risks", "passed")]
    # each text is looked at once: a struct of what is wrong with it
    seen = files.select(*(F.col(f"`{c}`") for c in taken), faults(text).alias("__html"), duplication_ratio(text).alias("duplication_ratio"), ratio.alias("api_failure_ratio"))
    measured = seen.select(*(F.col(f"`{c}`") for c in taken), F.col("__html.chars").alias("chars"), "duplication_ratio", "api_failure_ratio", "__html")
    risks = F.array_compact(
        F.array(
            F.when(F.col("chars") == 0, F.lit("empty_output")).when(F.col("chars") < least, F.lit("too_short")),
            _tested("high_duplication", F.col("duplication_ratio") > max_duplication), _tested("service_busy_html", F.col("__html.busy")), _tested("full_html_page", F.col("__html.full")),
            _tested("html_broken", F.col("__html.broken")), _tested("api_failure_ratio_high", F.col("api_failure_ratio") > max_failure),
        )
    )
    return measured.withColumn("risks", F.array_distinct(risks)).drop("__html").withColumn("passed", F.size("risks") == 0)


def check_inputs(images: DataFrame, name: str = "file_name") -> DataFrame:
    """One row: image_count, duplicate_count (names that occur more than once), risks, passed."""
    names = images.groupBy(name).agg(F.count(F.lit(1)).alias("n"))
    totals = names.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("image_count"), F.count_if(F.col("n") > 1).alias("duplicate_count"))
    return totals.withColumn("risks", F.array_compact(F.array(_tested("duplicate_input_file_name", F.col("duplicate_count") > 0)))).withColumn("passed", F.size("risks") == 0)


def duplicate_names(images: DataFrame, name: str = "file_name") -> DataFrame:
    return images.groupBy(name).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def name_difference(expected: DataFrame, actual: DataFrame, name: str = "file_name") -> DataFrame:
    """(name, side): names that only one side has."""
    a, b = expected.select(name).distinct(), actual.select(name).distinct()
    return a.join(b, name, "left_anti").withColumn("side", F.lit("expected")).unionByName(b.join(a, name, "left_anti").withColumn("side", F.lit("actual")))


def check_submission(submitted: DataFrame, expected: DataFrame, columns: tuple[str, str] = ("file_name", "ground_truth")) -> DataFrame:
    """One row: row_count, expected_row_count, risks, passed of a submission against the expected names."""
    wrong = list(submitted.columns) != list(columns)
    counts = expected.agg(F.count(F.lit(1)).alias("expected_row_count"))
    if "file_name" in submitted.columns:
        names = submitted.groupBy("file_name").agg(F.count(F.lit(1)).alias("n"))
        own = names.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"), F.count_if(F.col("n") > 1).alias("doubles"))
        odd = name_difference(expected, submitted).agg(F.count(F.lit(1)).alias("odd"))
    else:
        own = submitted.agg(F.count(F.lit(1)).alias("row_count"), F.lit(0).alias("doubles"))
        odd = submitted.sparkSession.range(1).select(F.lit(0).alias("odd"))
    row = own.crossJoin(counts).crossJoin(odd)  # three rows of one
    risks = F.array_compact(
        F.array(
            _tested("csv_columns", F.lit(wrong)), _tested("csv_row_count", F.col("row_count") != F.col("expected_row_count")),
            _tested("csv_duplicate_file_name", F.col("doubles") > 0), _tested("csv_file_name_mismatch", F.col("odd") > 0),
        )
    )
    return row.select("row_count", "expected_row_count", risks.alias("risks")).withColumn("passed", F.size("risks") == 0)


def risk_counts(checked: DataFrame) -> DataFrame:
    return checked.select(F.explode("risks").alias("risk")).groupBy("risk").agg(F.count(F.lit(1)).alias("n"))


def run_summary(checked: DataFrame) -> DataFrame:
    """One row: passed, file_count, failed_count. Names and counts by risk are tables of their own, as long as they are."""
    return checked.agg(F.coalesce(F.bool_and("passed"), F.lit(True)).alias("passed"), F.count(F.lit(1)).alias("file_count"), F.count_if(~F.col("passed")).alias("failed_count"))


def failed_files(checked: DataFrame, order: str = "file_name") -> DataFrame:
    return checked.where(~F.col("passed")).select("file_name", "risks").orderBy(order)
