"""Evaluation of restored texts against ground truth."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.html import table_stats
from ..functions.text import stem, strip

#: Longest product of lengths that the JVM's quadratic distance gets; beyond it the bit-parallel one is faster.
SHORT = 1 << 16


#: The least bound that is tried for long texts, what a bound grows by, and the part of the texts that a first guess is made from.
FIRST_BOUND, GROWTH, GUESS = 64, 2, 16


def edit_distance(a: str, b: str) -> int:
    """Levenshtein distance over code points, many cells of a column at a time (bit vectors in big integers).

    Near texts need the cells around the diagonal alone: a path of cost u stays within u / 2 of it. So a bound is tried, and a
    larger one until the distance keeps within it: time grows with length x distance and not with the product of the lengths."""
    if a == b:
        return 0
    if len(a) > len(b):
        a, b = b, a
    if not a:
        return len(b)
    bound = FIRST_BOUND + len(b) - len(a)
    if len(a) > GUESS * GUESS * FIRST_BOUND:  # edits are often spread evenly
        bound += edit_distance(a[: len(a) // GUESS], b[: len(a) // GUESS]) * (GUESS + 1)
    while bound < len(a) // 2:
        found = _within(a, b, bound)
        if found <= bound:
            return found
        bound *= GROWTH
    return _whole(a, b)


def _within(a: str, b: str, bound: int) -> int:
    """The distance if it is at most ``bound`` (else something larger), by a band of cells that moves down a row with each column.

    Bit p of a vector is row j - low + p of column j. What enters the band from below is taken to be dear, what leaves above isn't asked."""
    high = min((bound - len(b) + len(a)) // 2, len(a))
    low = (bound + len(b) - len(a)) // 2
    width = low + high + 1
    full, last = (1 << width) - 1, len(a)
    places: dict[str, list[int]] = {}
    for i, c in enumerate(a):
        places.setdefault(c, []).append(i)
    # of each character: its places in the band, the row of their bit 0, and how many places have entered so far
    seen = {c: [0, -low, 0] for c in places}
    # rows above the first cost what their column costs: no vertical step, a horizontal one each
    up, down, score = full & ~((1 << low) - 1), 0, high
    for j, c in enumerate(b, 1):
        at, own = j - low - 1, places.get(c)
        if own is None:
            eq = 0
        else:
            state = seen[c]
            eq, begin, n = state
            eq >>= at - begin
            reach = at + width
            while n < len(own) and own[n] < reach:
                if own[n] >= at:
                    eq |= 1 << own[n] - at
                n += 1
            state[:] = eq, at, n
        diagonal = (((eq & up) + up) ^ up | eq | down) & full
        plus, minus = down | full & ~(diagonal | up), diagonal & up
        if j + high <= last:
            score += 1 - (diagonal >> width - 1)
        else:
            bit = last - j + low
            score += (plus >> bit & 1) - (minus >> bit & 1)
        moved = diagonal >> 1
        up, down = minus | full & ~(moved | plus), moved & plus
    return score


def _whole(a: str, b: str) -> int:
    """The distance by whole columns."""
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i
    full, top = (1 << len(a)) - 1, 1 << (len(a) - 1)
    up, down, score = full, 0, len(a)
    for c in b:
        eq = places.get(c, 0)
        diagonal = (((eq & up) + up) ^ up) | eq | down
        plus, minus = down | (full & ~(diagonal | up)), up & diagonal
        score += bool(plus & top) - bool(minus & top)
        plus, minus = (plus << 1 | 1) & full, (minus << 1) & full
        up, down = minus | (full & ~(diagonal | plus)), plus & diagonal
    return score


def mapping_keys(mapping: DataFrame) -> DataFrame:
    """(key, gt_file): every name under which a mapping row (row_no, uuid, afts_id) is looked up; later rows win."""
    uuid, other = strip(F.coalesce("uuid", F.lit(""))), strip(F.coalesce("afts_id", F.lit("")))
    own = F.array(uuid, F.concat(uuid, F.lit(".md")))
    more = F.when(other != "", F.array(other, *(F.concat(other, F.lit(s)) for s in (".md", ".jpg", ".png")))).otherwise(F.array().cast("array<string>"))
    rows = mapping.where(uuid != "").select("row_no", F.concat(uuid, F.lit(".md")).alias("gt_file"), F.posexplode(F.concat(own, more)).alias("n", "key"))
    return rows.groupBy("key").agg(F.max_by("gt_file", F.struct("row_no", "n")).alias("gt_file"))


def pair(predictions: DataFrame, truth: DataFrame, mapping: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(matched, missing): predictions (file_name, markdown) with their truth, found by name, else by stem, else under their own name."""
    named = predictions.withColumn("stem", stem(F.col("file_name")))
    if mapping is not None:
        keys = mapping_keys(mapping)
        named = named.join(keys.withColumnsRenamed({"key": "file_name", "gt_file": "by_name"}), "file_name", "left").join(keys.withColumnsRenamed({"key": "stem", "gt_file": "by_stem"}), "stem", "left")
        named = named.withColumn("gt_file", F.coalesce("by_name", "by_stem", "file_name")).drop("by_name", "by_stem")
    else:
        named = named.withColumn("gt_file", F.col("file_name"))
    gold = truth.select(F.col("file_name").alias("gt_file"), F.col("markdown").alias("gt"))
    return named.join(gold, "gt_file").drop("stem"), named.join(gold, "gt_file", "left_anti").select("file_name")


def with_distance(pairs: DataFrame, a: str = "markdown", b: str = "gt") -> DataFrame:
    """Adds edit_distance. Equal texts cost nothing, short ones stay in the JVM, long ones use bit vectors in Python."""
    same, short = F.col(a) == F.col(b), F.length(a).cast("long") * F.length(b) <= SHORT
    quick = pairs.where(same | short).withColumn("edit_distance", F.when(same, F.lit(0)).otherwise(F.levenshtein(F.when(~same, F.col(a)), F.col(b))))
    long = pairs.where(~(same | short)).withColumn("edit_distance", F.lit(0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [edit_distance(x.as_py(), y.as_py()) for x, y in zip(batch.column(a), batch.column(b), strict=True)]
            yield batch.set_column(batch.schema.get_field_index("edit_distance"), "edit_distance", pa.array(found, pa.int32()))

    return quick.unionByName(long.mapInArrow(run, long.schema))


def evaluate(predictions: DataFrame, truth: DataFrame, mapping: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(records, missing): distances, length ratios and table counts per matched file, and the names without truth."""
    matched, missing = pair(predictions, truth, mapping)
    out = with_distance(matched)
    size = F.greatest(F.lit(1), F.length("gt"))
    out = out.withColumn("normalized_edit_distance", F.col("edit_distance") / size).withColumn("length_ratio", F.length("markdown") / size)
    for side, column in (("pred", "markdown"), ("gt", "gt")):
        for k, v in table_stats(F.col(column)).items():
            out = out.withColumn(f"{k}_{side}", v)
    for k in ("tr", "td", "empty_td"):
        out = out.withColumn(f"{k}_diff", F.col(f"{k}_pred") - F.col(f"{k}_gt"))
    return out.drop("markdown", "gt"), missing


def summary(records: DataFrame) -> DataFrame:
    """One row: file_count and the macro mean of the normalised distances (0 without files)."""
    return records.agg(F.count(F.lit(1)).alias("file_count"), F.coalesce(F.avg("normalized_edit_distance"), F.lit(0.0)).alias("mean_normalized_edit_distance"))
