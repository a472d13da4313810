"""Sinks: the published CSV, JSON tables, append-only logs and caches."""

from __future__ import annotations

import json
import re
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.gate import check_submission
from .readers import read_submission


class PublishError(RuntimeError):
    pass


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (``spark.checkpoint.dir``).

    Only where it is unset and all of Spark is one process, as in tests, a temporary folder of this machine stands in.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        held = spark.sparkContext._jsc.sc().getCheckpointDir()
        if held.isDefined():
            path = held.get()
        elif re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            path = f"file://{tempfile.mkdtemp(prefix='quireflow-')}"
            spark.sparkContext.setCheckpointDir(path)
        else:
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return path.rstrip("/")


def delete(spark: SparkSession, path: str) -> None:
    """Remove a file or folder of any store Spark reaches, if it is there."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def _in_place(spark: SparkSession, made: str, path: str) -> None:
    """Put a finished file or folder where readers look for it. What was there stays until then, and comes back if the move fails."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    source, target, aside = hadoop.Path(made), hadoop.Path(path), hadoop.Path(f"{path.rstrip('/')}.old-{uuid.uuid4().hex}")
    store = target.getFileSystem(spark._jsc.hadoopConfiguration())
    store.mkdirs(target.getParent())
    held = store.exists(target) and store.rename(target, aside)
    if not store.rename(source, target):
        if held:
            store.rename(aside, target)
        raise PublishError(f"can't move the output to {path}")
    if held:
        store.delete(aside, True)


def _one_file(spark: SparkSession, parts: str) -> str:
    """The only part of a folder that one task wrote."""
    where = spark._jvm.org.apache.hadoop.fs.Path(parts)
    listed = where.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(where)
    return next(s.getPath().toString() for s in listed if s.getPath().getName().startswith("part-"))


def _staged(path: str) -> str:
    return f"{path.rstrip('/')}.staged-{uuid.uuid4().hex}"


def _write_csv(files: DataFrame, path: str, single: bool) -> str:
    """Write the rows below ``path``; where they are: one file, or the folder."""
    rows = files.select("file_name", F.coalesce("ground_truth", F.lit("")).alias("ground_truth"))
    options = {"header": True, "escape": '"', "quoteAll": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, "emptyValue": "", "encoding": "UTF-8", "lineSep": "\n"}
    (rows.coalesce(1) if single else rows).write.options(**options).csv(path)
    return _one_file(files.sparkSession, path) if single else path


def write_csv(files: DataFrame, path: str, single: bool = True, check: Callable[[str], None] | None = None) -> None:
    """file_name and ground_truth in UTF-8 with a header; white space and line ends inside texts survive, empty texts stay empty.

    ``single`` makes ``path`` one CSV file, as a submission is: one task writes it; leave it off for a folder that is written in
    parallel. Either is written beside ``path`` first, where ``check`` may read it and raise, and takes its place in one move.
    """
    spark, staged = files.sparkSession, _staged(path)
    try:
        made = _write_csv(files, staged, single)
        if check is not None:
            check(made)
        _in_place(spark, made, path)
    finally:
        delete(spark, staged)


def publish(files: DataFrame, path: str, expected: DataFrame, single: bool = True) -> DataFrame:
    """Write the CSV, read it back and check it, then put it in place: what is at ``path`` has passed. What doesn't hold raises and leaves
    ``path`` as it was. Returns the check's row."""
    found = []

    def check(made: str) -> None:
        row = check_submission(read_submission(files.sparkSession, made), expected).first()
        if not row.passed:
            raise PublishError(",".join(row.risks))
        found.append(row)

    write_csv(files, path, single, check)
    return files.sparkSession.createDataFrame(found, "row_count long, expected_row_count long, risks array<string>, passed boolean")


def write_document(head: dict, lists: dict[str, tuple[DataFrame, str, Column]], path: str) -> None:
    """One JSON file: the fields of ``head``, then lists of any length: of the rows of a frame, by a column without repeats, what a column says of each (JSON).

    One task sorts and writes the lines; nothing of the lists is held in memory.
    """
    spark = next(iter(lists.values()))[0].sparkSession
    body = json.dumps(head, ensure_ascii=False, default=str)[:-1] + ("," if head else "")
    lines = spark.createDataFrame([(0, "", body)], "part int, place string, line string")
    for i, (name, (rows, order, value)) in enumerate(lists.items(), 1):
        opening = f'{"," if i > 1 else ""}{json.dumps(name)}: ['
        first = rows.agg(F.min(order).alias("first"))
        comma = F.when(F.col(order).eqNullSafe(F.col("first")), "").otherwise(",")
        told = rows.withColumn("told", value).join(F.broadcast(first)).select(F.lit(3 * i + 1).alias("part"), F.coalesce(F.col(order).cast("string"), F.lit("")).alias("place"), F.concat(comma, "told").alias("line"))
        lines = lines.unionByName(spark.createDataFrame([(3 * i, "", opening), (3 * i + 2, "", "]" + "}" * (i == len(lists)))], lines.schema)).unionByName(told)
    staged = _staged(path)
    try:
        lines.repartition(1).sortWithinPartitions("part", "place").select("line").write.text(staged)
        _in_place(spark, _one_file(spark, staged), path)
    finally:
        delete(spark, staged)


def write_lines(rows: DataFrame, column: str, path: str) -> None:
    """One line of text, such as a JSON document, per row."""
    rows.select(column).write.mode("overwrite").text(path)


def write_text(lines: DataFrame, path: str, order: str) -> None:
    """A small report as text, its lines in order."""
    lines.repartition(1).sortWithinPartitions(order).select("line").write.mode("overwrite").text(path)


def write_json(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def append_json(rows: DataFrame, path: str) -> None:
    """Append-only JSON lines. Rows must not hold credentials: a column named like a key is refused."""
    if bad := [c for c in rows.columns if c.lower() in ("api_key", "apikey", "secret")]:
        raise ValueError(f"credentials don't belong in logs: {bad}")
    rows.write.mode("append").json(path)


def append_table(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").parquet(path)
