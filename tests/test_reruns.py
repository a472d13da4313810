"""Reruns of arriving files against the batch loop, with a restart in mid-retry."""

import time

from pyspark.sql import functions as F

from quireflow.operators import retry
from quireflow.streaming import reruns

#: Of each file how many attempts fail, and why.
FAILS = {f"f{i}": i % 5 for i in range(20)}


def attempt(planned):
    """A file passes once it has failed often enough; what was asked for decides the risk that is left."""
    fails = F.create_map(*(x for k, v in FAILS.items() for x in (F.lit(k), F.lit(v))))[F.col("file_name")]
    passed = F.col("rerun_count") + 1 >= fails
    risks = F.when(passed, F.array().cast("array<string>")).when(F.col("force_api"), F.array(F.lit("too_short"))).otherwise(F.array(F.lit("full_html_page")))
    return planned.select("file_name", "doc_type", risks.alias("risks"), passed.alias("passed"))


def first(spark):
    rows = [(k, "normal_page", [] if v == 0 else ["full_html_page"], v == 0, 0) for k, v in FAILS.items()]
    return spark.createDataFrame(rows, reruns.CHECKED)


def told(df):
    return sorted((r.file_name, r.rerun_count, r.passed, r.risks) for r in df.select("file_name", "rerun_count", "passed", "risks").collect())


def test_stream_ends_in_the_batch_loops_table(spark, tmp_path):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", reruns.PROVIDER)
    want = told(retry.rerun_until(first(spark), lambda df: attempt(df), 2))
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "ck"))
    rows = first(spark)
    rows.where("file_name < 'f15'").write.parquet(f"{source}/a")
    start = lambda: reruns.rerun_stream(spark, source, out, checkpoint, attempt, 2, 200, "100 milliseconds")
    done = lambda: told(spark.read.parquet(out)) if list((tmp_path / "out").glob("batch=*/*.parquet")) else []

    def until(ready):
        limit = time.time() + 90
        while not ready() and time.time() < limit:
            assert query.isActive, query.exception()
            time.sleep(0.2)

    query = start()
    until(lambda: list((tmp_path / "in").glob("rerun-*")))
    query.stop()
    assert 0 < len(done()) < len(want)
    # while it is down more files arrive, and one check arrives twice
    rows.where("file_name >= 'f15'").write.parquet(f"{source}/b")
    rows.limit(5).write.parquet(f"{source}/c")
    query = start()
    until(lambda: len(done()) >= len(want))
    query.stop()
    spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    assert done() == want and len(want) == 20 and {n for _, n, *_ in want} == {0, 1, 2}
