"""Questions that blocks of text put to the whole corpus.

A block names each of its distinct hashes once, with how often it holds them; counts are summed by
hash over all blocks, combined before the shuffle; the answers go back to their block.  A hash held by a
third of all rows is one row per block and task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

#: Hashes per Arrow batch on the way out of Python.
_STEP = 1 << 16


def ask(blocks: DataFrame, columns: list[str], distinct: Callable[..., tuple[np.ndarray, np.ndarray]]) -> DataFrame:
    """(block, code, c, first): corpus counts of each block's distinct 64-bit hashes, of those that stand twice or more.

    ``distinct`` makes (hashes, counts) of the values of ``columns``; ``code`` is the place among those hashes. ``first`` is set in one block of each hash.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                block, *values = (c[row].as_py() for c in batch.columns)
                word, own = distinct(*values)
                word, own = word.view(np.int64), own.astype(np.int64, copy=False)
                for lo in range(0, len(word), _STEP):
                    w = word[lo : lo + _STEP]
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(w), block)), pa.array(np.arange(lo, lo + len(w), dtype=np.int32)), pa.array(w), pa.array(own[lo : lo + len(w)])], ["block", "code", "word", "own"])

    rows = written(blocks.select("block", *columns).mapInArrow(run, "block bigint, code int, word bigint, own bigint"), "asked")
    # sums combine before the shuffle, and AQE may split the join that sends one back to all blocks
    counts = rows.groupBy("word").agg(F.sum("own").alias("c"), F.min("block").alias("holder")).where("c > 1")
    return rows.join(counts, "word").select("block", "code", "c", (F.col("block") == F.col("holder")).alias("first"))
