"""An extension: the quality gate over files that arrive, as a structured stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.gate import check_files


def gate_stream(spark: SparkSession, source: str, schema: str, out: str, checkpoint: str):
    """Check every new Parquet file of ``source`` and append the results to ``out``, exactly once per batch id."""
    files = spark.readStream.schema(schema).parquet(source)

    def store(batch: DataFrame, number: int) -> None:
        # a batch that runs again overwrites what it wrote before
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    return check_files(files).writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
