"""Small awkward tables that every operator must handle."""

from __future__ import annotations

import random

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def words(n: int, seed: int = 0) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice(["th", "er", "on", "an", "é", "re", "中", "ing"]) for _ in range(rng.randint(1, 4))) for _ in range(n))


LONG = words(60_000, 1)
EDGE = [
    (1, None, None, None, None), (2, "", "en", "", 0), (3, " \n\t", "en", "a", 3), (4, "word", "en", "a", 4), (4, "word", "en", "a", 4), (5, LONG, "en", "b", len(LONG)),
    (None, words(50, 2), "de", "b", None), (6, LONG, None, None, len(LONG)), (7, words(50, 2), "de", "b", 1), (8, "WORD", "en", "a", 4), (-9, words(300, 3), "fr", "c", 9), (10, "\x00 \x1f\x85 　x", "fr", "c", 9),
]
#: Names that operators use for columns of their own.
CLASH = {"kept": "boolean", "fp": "string", "size": "string", "skey": "int", "bucket": "string", "row": "string", "key": "string", "copies": "string", "nth": "int", "quality_score": "string", "block": "string", "taken": "string", "component_id": "string"}


def edge(spark, clash: bool = False, rows=None):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(EDGE if rows is None else rows, SCHEMA)
    return df.withColumns({c: F.lit(None).cast(t) for c, t in CLASH.items()}) if clash else df


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
