"""Shared pieces: the shared folder, written tables, text defaults, Arrow batch slicing."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.sinks import shared_dir

#: Fixed by the data contract: a word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
#: Text bytes that one numpy pass looks at; a single longer document is one pass of its own.
PASS_BYTES = 1 << 21


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet to the shared folder and read back: cuts lineage, survives lost executors.

    The folder goes when the driver ends, if ``drop_written`` hasn't deleted it before.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/quireflow/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _store(spark, path)[0].deleteOnExit(_store(spark, path)[1])
    return spark.read.schema(df.schema).parquet(path)


def appended(frames: Iterator[DataFrame], name: str) -> DataFrame:
    """Frames of one schema, one at least, written one by one as they come into one table as ``written`` makes it."""
    path = schema = None
    for df in frames:
        if path is None:
            spark, schema = df.sparkSession, df.schema
            path = f"{shared_dir(spark)}/quireflow/{name}-{uuid.uuid4().hex}"
            _store(spark, path)[0].deleteOnExit(_store(spark, path)[1])
        df.write.mode("append").parquet(path)
    return spark.read.schema(schema).parquet(path)


def bucketed(df: DataFrame, name: str, key: str) -> DataFrame:
    """As ``written``, in buckets of ``key``: whatever meets it there by key leaves its rows where they are."""
    spark = df.sparkSession
    name = f"quireflow_{name}_{uuid.uuid4().hex}"
    buckets = min(2 * partitions(spark), 50_000)
    path = f"{shared_dir(spark)}/quireflow/{name}"
    df.write.format("parquet").bucketBy(buckets, key).option("path", path).saveAsTable(name)
    _store(spark, path)[0].deleteOnExit(_store(spark, path)[1])
    return spark.table(name)


def _store(spark: SparkSession, path: str) -> tuple:
    """The file system that holds a path, and the path, as the JVM has them."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def _delete(df: DataFrame) -> str | None:
    files = df.inputFiles()
    if not files:
        return None
    parent = files[0].rsplit("/", 1)[0]
    store, path = _store(df.sparkSession, parent)
    store.delete(path, True)
    return parent.rsplit("/", 1)[1]


def drop_written(*frames: DataFrame) -> None:
    """Delete the tables behind frames that ``written`` returned, once nothing reads them any more."""
    for df in frames:
        _delete(df)


def drop_bucketed(df: DataFrame) -> None:
    """The same for ``bucketed``."""
    name = _delete(df)
    if name:
        df.sparkSession.sql(f"DROP TABLE IF EXISTS {name}")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str | Column) -> Column:
    """A text column with null as the empty text."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def fold_case(column: Column) -> Column:
    """Lower-case A-Z alone, whatever the locale and the rest of Unicode."""
    return F.translate(column, UPPER, LOWER)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (n+1, from 0) and bytes of an Arrow string column, null as empty."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or len(off) == 0 or off[-1] == off[0]:
        return np.zeros(len(column) + 1, np.int64), np.zeros(0, np.uint8)
    return off - off[0], np.frombuffer(data, np.uint8)[off[0] : off[-1]]


def passes(off: np.ndarray, most: int = PASS_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of documents of at most ``most`` bytes together, one document at least."""
    lo, n = 0, len(off) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + most, "right")) - 1)
        yield lo, min(hi, n)
        lo = min(hi, n)
