"""Mixing sources to target weights with Efraimidis-Spirakis sampling, in DataFrame operations only.

Targets: sources in code-point order (null last) get weights 5, 2, 1, repeating, and share a budget
of 150 % of all words; a source's target stops at twice its size and the excess is shared again by
weight until none is above.  That fixed point is a water level: with sources sorted by
cap / weight, those that stop form a prefix, so one ordered pass over the *source* table finds it.

Rows: every document gets the key -ln(u) / quality weight, u a hash of its id and size in (0, 1).  A source
takes floor(target / size) complete epochs of all its documents, then documents in key order
while at least half of the document still fits, so the words taken end within half a document of
the target.

A hot source is no single task: keys fall into ``buckets`` ranges per source; sums of whole ranges
are enough for all but the one range that holds the boundary, and only within a range are rows
sorted.  Every row is weighed; nothing is dropped or capped.

Defined results: null text has size 0; a text of any length counts whole; documents of size 0 take 0
words; a source of size 0 has target 0; a null size counts as 0 and a null weight as ``UNKNOWN``; rows
repeating a doc_id are rows of their own, ordered by (key, id, size); ties are settled by id; further
columns pass through untouched whatever their names, but for those of the four results, which
replace them; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, table, text_of, written

#: Repeating weights of the sources, budget over all sizes, most epochs: fixed by the contract.
WEIGHTS = (5.0, 2.0, 1.0)
BUDGET = 1.5
MOST_EPOCHS = 2.0
#: Ranges of sampling keys per source.
BUCKETS = 4096
#: Quality weights by label (1, 0, none).
GOOD, BAD, UNKNOWN = 1.0, 0.25, 0.5


def size_of(text: str = "text") -> Column:
    return F.regexp_count(text_of(text), F.lit(WORD)).cast("long")


def quality_weights(docs: DataFrame, labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """``docs`` with ``quality_weight`` from the labels; several labels of one id: the highest."""
    best = labels.where(F.col(key).isNotNull()).groupBy(key).agg(F.max("quality").alias("__q"))
    weight = F.when(F.col("__q") > 0, F.lit(GOOD)).when(F.col("__q").isNotNull(), F.lit(BAD)).otherwise(F.lit(UNKNOWN))
    return docs.join(best, key, "left").withColumn("quality_weight", weight).drop("__q")


def sample_key(key: Column, size: Column, weight: Column, seed: str) -> Column:
    """-ln(u) / weight, u from 52 bits of a hash of id and size; the same on every run and machine.

    The size is there so that rows that share an id, or have none, fall into different ranges of keys.
    """
    named = F.concat(F.lit(seed), F.coalesce(key.cast("string"), F.lit("")), F.lit(":"), size.cast("string"))
    bits = F.conv(F.substring(F.md5(named), 1, 13), 16, 10).cast("long")
    u = (bits + F.lit(0.5)) / F.lit(float(1 << 52))
    return -F.log(u) / weight


def targets(sources: DataFrame) -> DataFrame:
    """Adds ``target`` to a source table (skey, source_size): one row per source, so one small ordered pass."""
    everything = Window.partitionBy()
    ranked = sources.withColumn("n", F.row_number().over(Window.orderBy("skey")))
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), ((F.col("n") - 1) % len(WEIGHTS) + 1).cast("int"))
    ranked = (
        ranked.withColumn("w", weight).withColumn("cap", MOST_EPOCHS * F.col("source_size"))
        .withColumn("budget", BUDGET * F.sum("source_size").over(everything))
    )
    order = Window.orderBy(F.col("cap") / F.col("w"), "skey")
    before = F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    weight_left = F.sum("w").over(order.rowsBetween(0, Window.unboundedFollowing))
    full = ranked.withColumn("full", F.col("cap") * weight_left <= F.col("w") * (F.col("budget") - before))
    stopped = F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))).over(everything), F.lit(0.0))
    sharing = F.sum(F.when(~F.col("full"), F.col("w"))).over(everything)
    level = F.when(F.col("full"), F.col("cap")).otherwise(F.col("w") * (F.col("budget") - stopped) / sharing)
    return full.withColumn("target", level).select("skey", "source_size", "target")


#: Columns that ``mix`` adds.
RESULTS = ("source_size", "target", "copies", "taken")


def mix(docs: DataFrame, key: str = "doc_id", source: str = "source", size: str = "size", weight: str = "quality_weight", seed: str = "mix:", buckets: int = BUCKETS) -> DataFrame:
    """``docs`` (with size and weight) plus ``source_size``, ``target``, ``copies`` and ``taken``."""
    kept = [c for c in docs.columns if c not in RESULTS]
    base = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in kept)).alias("row"), F.col(key).alias("id"), F.coalesce(F.concat(F.lit("="), F.col(source)), F.lit("~")).alias("skey"),
        F.coalesce(F.col(size).cast("long"), F.lit(0)).alias("size"), F.coalesce(F.col(weight).cast("double"), F.lit(UNKNOWN)).alias("weight"),
    )
    base = base.withColumn("order", sample_key(F.col("id"), F.col("size"), F.col("weight"), seed)).drop("weight")
    # 1 - exp(-key) rises with the key and lies in [0, 1): a range number that keeps the key order
    base = base.withColumn("bucket", F.least(F.lit(buckets - 1), F.floor(buckets * (1 - F.exp(-F.col("order")))).cast("int")))
    sums = written(base.groupBy("skey", "bucket").agg(F.sum("size").cast("long").alias("bucket_size")), "mixsums")
    plan = targets(sums.groupBy("skey").agg(F.sum("bucket_size").cast("long").alias("source_size")))
    plan = plan.withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long"))
    plan = plan.withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size"))
    start = F.coalesce(F.sum("bucket_size").over(Window.partitionBy("skey").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranges = sums.withColumn("before", start).join(plan, "skey").drop("bucket_size")
    inside = Window.partitionBy("skey", "bucket").orderBy("order", "id", "size")
    ahead = F.coalesce(F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rows = base.join(ranges, ["skey", "bucket"]).withColumn("ahead", F.col("before") + ahead)
    chosen = (F.col("ahead") + F.col("size") / 2 <= F.col("rest")).cast("long")
    copies = (F.col("epochs") + chosen).alias("copies")
    rows = rows.select("row", "size", "source_size", "target", copies).withColumn("taken", F.col("copies") * F.col("size"))
    return rows.select(*(F.col("row")[c].alias(c) for c in kept), *RESULTS)


def op10(spark, sf_dir: str) -> DataFrame:
    narrow = table(spark, sf_dir, "documents").select("doc_id", "source", size_of().alias("size"))
    weighed = written(quality_weights(narrow, table(spark, sf_dir, "labels")), "mixrows")
    return mix(weighed).select("doc_id", "size", "source_size", "target", "taken")


ORACLE = r"""
WITH d AS (
  SELECT doc_id, CASE WHEN source IS NULL THEN '~' ELSE '=' || source END AS skey,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents),
q AS (SELECT doc_id, max(quality) AS q FROM labels WHERE doc_id IS NOT NULL GROUP BY 1),
k AS (
  SELECT d.*, -ln((CAST('0x' || substr(md5('mix:' || coalesce(CAST(d.doc_id AS VARCHAR), '') || ':' || CAST(d.size AS VARCHAR)), 1, 13) AS BIGINT) + 0.5) / 4503599627370496.0)
         / CASE WHEN q.q > 0 THEN 1.0::DOUBLE WHEN q.q IS NOT NULL THEN 0.25::DOUBLE ELSE 0.5::DOUBLE END AS key
  FROM d LEFT JOIN q USING (doc_id)),
s AS (SELECT skey, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY 1),
w AS (
  SELECT skey, source_size, CAST([5, 2, 1][1 + (row_number() OVER (ORDER BY skey) - 1) % 3] AS DOUBLE) AS w,
         CAST(2 * source_size AS DOUBLE) AS cap, 1.5::DOUBLE * CAST(sum(source_size) OVER () AS DOUBLE) AS budget
  FROM s),
f AS (
  SELECT *, cap * sum(w) OVER (ORDER BY cap / w, skey ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
         <= w * (budget - coalesce(sum(cap) OVER (ORDER BY cap / w, skey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS full_
  FROM w),
t AS (
  SELECT skey, source_size, CASE WHEN full_ THEN cap ELSE w * (budget - coalesce(sum(CASE WHEN full_ THEN cap END) OVER (), 0))
         / sum(CASE WHEN NOT full_ THEN w END) OVER () END AS target
  FROM f),
r AS (
  SELECT k.doc_id, k.size, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size) ELSE 0 END AS epochs,
         coalesce(sum(k.size) OVER (PARTITION BY k.skey ORDER BY k.key, k.doc_id, k.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead
  FROM k JOIN t USING (skey))
SELECT doc_id, size, source_size, target,
       CAST(size * (epochs + CASE WHEN ahead + size / 2.0 <= target - epochs * source_size THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM r
"""
