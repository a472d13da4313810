"""An extension: bounded reruns of files that arrive, as a structured stream with state and timers.

Per file the state holds how often it ran again and the check that is waiting. A check that asks for a rerun sets a timer; when it
fires, the file comes out as a request, is attempted again, and its new check comes back in through the source. All of it survives a
restart: state and timers are in the stream's checkpoint, and a check counts only if it belongs to the attempt that is due, so that a batch
that runs again changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

from ..operators.retry import MAX_RERUNS, plan

#: What a check must have; ``rerun_count`` is the attempt that it is of.
CHECKED = "file_name string, doc_type string, risks array<string>, passed boolean, rerun_count int"
#: State stores with timers need this provider.
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
DONE = -1


class Reruns(StatefulProcessor):
    """Turns checks of a file into requests (``asks``) and, once it passed or may not run again, its last check."""

    def __init__(self, max_reruns: int, backoff_ms: int):
        self.max_reruns, self.backoff_ms = max_reruns, backoff_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.due = handle.getValueState("due", "n int")
        self.waiting = handle.getValueState("waiting", "doc_type string, risks array<string>")

    def _row(self, key: tuple, doc_type: str, risks: list, passed: bool, n: int, asks: bool) -> pd.DataFrame:
        return pd.DataFrame({"file_name": [key[0]], "doc_type": [doc_type], "risks": [list(risks)], "passed": [passed], "rerun_count": pd.array([n], "int32"), "asks": [asks]})

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        for batch in rows:
            for r in batch.itertuples():
                due = self.due.get()[0] if self.due.exists() else 0
                if due == DONE or r.rerun_count != due or self.waiting.exists():
                    continue  # a check that was seen before
                if r.passed or due >= self.max_reruns:
                    self.due.update((DONE,))
                    yield self._row(key, r.doc_type, r.risks, bool(r.passed), due, False)
                else:
                    self.waiting.update((r.doc_type, list(r.risks)))
                    self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.backoff_ms * 2**due)

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        due = self.due.get()[0] if self.due.exists() else 0
        doc_type, risks = self.waiting.get()
        self.waiting.clear()
        self.due.update((due + 1,))
        yield self._row(key, doc_type, risks, False, due, True)

    def close(self) -> None:
        pass


def rerun_stream(spark: SparkSession, source: str, out: str, checkpoint: str, attempt: Callable[[DataFrame], DataFrame], max_reruns: int = MAX_RERUNS, backoff_ms: int = 1000, every: str = "1 second"):
    """Checks (``CHECKED``) that arrive as Parquet files below ``source``; files that are done go to ``out``, a folder per batch.

    ``attempt`` takes planned requests and returns their new checks, as the batch loop's does. The session's state stores must be ``PROVIDER``'s."""
    checks = spark.readStream.schema(CHECKED).option("recursiveFileLookup", "true").parquet(source)
    result = StructType.fromDDL(CHECKED + ", asks boolean")
    moved = checks.groupBy("file_name").transformWithStateInPandas(Reruns(max_reruns, backoff_ms), result, "append", "ProcessingTime")

    def store(batch: DataFrame, number: int) -> None:
        batch.persist()
        batch.where("not asks").drop("asks").write.mode("overwrite").parquet(f"{out}/batch={number}")
        asked = plan(batch.where("asks").drop("asks"), max_reruns)
        if not asked.isEmpty():
            of = asked.select("file_name", (F.col("rerun_count") + 1).alias("rerun_count"))
            new = attempt(asked).drop("rerun_count").join(of, "file_name")
            columns = [c.split()[0] for c in CHECKED.split(", ")]
            new.select(columns).write.mode("overwrite").parquet(f"{source}/rerun-{number}")
        batch.unpersist()

    return moved.writeStream.outputMode("append").foreachBatch(store).option("checkpointLocation", checkpoint).trigger(processingTime=every).start()
