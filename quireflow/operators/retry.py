"""Retry plans and the bounded rerun loop."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_RERUNS = 2


def plan(checked: DataFrame, max_reruns: int = MAX_RERUNS) -> DataFrame:
    """Adds rerun, force_api, window_scale, overlap_scale, table_grid_scale and concurrency to (risks, passed, rerun_count)."""
    rerun = ~F.col("passed") & (F.col("rerun_count") < max_reruns)
    risky = lambda *names: F.arrays_overlap(F.col("risks"), F.array(*map(F.lit, names)))
    forced = rerun & risky("service_busy_html", "full_html_page")
    return (
        checked.withColumn("rerun", rerun).withColumn("force_api", forced).withColumn("window_scale", F.lit(1.0))
        .withColumn("overlap_scale", F.when(rerun & risky("too_short"), 1.5).otherwise(1.0)).withColumn("table_grid_scale", F.lit(1.0))
        .withColumn("concurrency", F.when(forced | rerun & risky("api_failure_ratio_high"), 1).otherwise(0))
    )


def rerun_until(first: DataFrame, attempt: Callable[[DataFrame], DataFrame], max_reruns: int = MAX_RERUNS, keep: Callable[[DataFrame, str], DataFrame] | None = None) -> DataFrame:
    """Files of ``first`` (checked, rerun_count 0) that ask for a rerun go through ``attempt`` again, at most ``max_reruns`` times.

    ``attempt`` takes planned files and returns them checked; ``keep`` materialises a round (by default a
    checkpoint in the shared folder), so no round runs twice and lineage stays short.
    """
    hold = keep or (lambda df, name: df.checkpoint())
    planned = hold(plan(first, max_reruns), "round0")
    done = planned.where(~F.col("rerun"))
    for i in range(1, max_reruns + 1):
        again = planned.where("rerun")
        if again.isEmpty():
            break
        tried = attempt(again).withColumn("rerun_count", F.lit(i))
        planned = hold(plan(tried, max_reruns), f"round{i}")
        done = done.unionByName(planned.where(~F.col("rerun")), allowMissingColumns=True)
    return done
