"""Filter interaction audit: what each filter removes, in every order in which the filters can be applied.

The orders form a trie; a prefix of an order leaves the same survivors in whatever order its filters ran,
so the trie folds into one state per set of filters (32 for five).  States are visited depth first: a state's
survivors are a persisted DataFrame, the parent's without those that the next filter fails; a state that the
memo has, as another prefix has reached it already, is not visited again.  At each state one aggregate counts, for every edge that
leaves it, what the edge's filter removes of the survivors, and is written at once: the driver plans one state at
a time, and no more frames are persisted than filters are applied.

Documents enter the trie as classes: those of one part that fail the same filters and are of the same kind
in what is counted are one row with their number.  Neither a filter nor a count can tell them apart, so
survivors are exact and small (at most 2^filters x 2^kinds rows a part), whatever the corpus.

Defined results: null text is empty; null and empty languages are one part, the empty string; a null id is
never smaller than another nor has a label; rows that repeat an id are documents of their own, not copies of
each other by filter E unless a smaller id has the text; of repeated labels any one counts; further columns
are not read; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from .common import appended, drop_written, table, text_of, written

_SPACES = r"[\x20\x09-\x0D]+"


def classes(docs: DataFrame, part: str, filters: list[str], kinds: list[str]) -> DataFrame:
    """A written table of (part, failing columns, kinds, n): documents that nothing here tells apart."""
    return written(docs.groupBy(part, *filters, *kinds).agg(F.count(F.lit(1)).alias("n")), "auditclasses")


def edges(base: DataFrame, part: str, filters: list[str], kinds: list[str]) -> DataFrame:
    """A written table (part, state, filter, survivors, removed, one column per kind) of every edge of the folded trie.

    ``state`` is the sum of 2^i over the filters applied before; ``removed`` are the state's survivors that fail ``filter``."""
    whole = range(len(filters))
    of = lambda cond, name: F.coalesce(F.sum(F.when(cond, F.col("n"))), F.lit(0)).alias(name)
    # the state is data and every state sums all filters, so one compiled aggregate serves all states
    sums = [F.sum("n").alias("survivors")]
    for i in whole:
        fails = F.col(filters[i])
        sums += [of(fails, f"x{i}"), *(of(fails & F.col(k), f"{k}{i}") for k in kinds)]
    one = lambda i: F.struct(F.lit(i).alias("i"), F.lit(filters[i]).alias("filter"), F.col(f"x{i}").alias("removed"), *(F.col(f"{k}{i}").alias(k) for k in kinds))
    memo: set[int] = set()

    def visit(state: int, survivors: DataFrame) -> Iterator[DataFrame]:
        memo.add(state)
        ahead = [i for i in whole if not state >> i & 1]
        if not ahead:
            return
        survivors = survivors.persist()
        try:
            counted = survivors.groupBy(part, "state").agg(*sums).withColumn("edge", F.explode(F.array(*map(one, whole))))
            yield counted.where(F.expr("shiftright(state, edge.i) & 1 = 0")).select(part, "state", "survivors", "edge.filter", "edge.removed", *(f"edge.{k}" for k in kinds))
            for i in ahead:
                if state | 1 << i not in memo:
                    yield from visit(state | 1 << i, survivors.where(~F.col(filters[i])).withColumn("state", F.col("state") + F.lit(1 << i)))
        finally:
            survivors.unpersist()

    return appended(visit(0, base.withColumn("state", F.lit(0))), "auditedges")


def orders(spark, filters: list[str]) -> DataFrame:
    """(filter_order, step, filter, state): all orders of the filters, a row per step."""
    rows = []
    for order in permutations(range(len(filters))):
        state = 0
        for step, i in enumerate(order, 1):
            rows.append(("".join(filters[j] for j in order), step, filters[i], state))
            state |= 1 << i
    return spark.createDataFrame(rows, "filter_order string, step int, filter string, state int")


def audit(docs: DataFrame, part: str, filters: list[str], kinds: list[str]) -> DataFrame:
    """Per part, order and step: kept, removed, redundant, unique_fails, ``<kind>_lost`` and shapley.

    ``filters`` are boolean columns (true: fails) with names of one letter; ``kinds`` are boolean columns whose losses are counted.
    A part has a row for each step of each order, zeros included."""
    base = classes(docs, part, filters, kinds)
    found = edges(base, part, filters, kinds)
    drop_written(base)
    whole = (1 << len(filters)) - 1
    alone = reduce(Column.__or__, [(F.col("filter") == f) & (F.col("state") == whole ^ 1 << i) for i, f in enumerate(filters)])
    sizes = found.groupBy(part, "filter").agg(F.max(F.when(F.col("state") == 0, F.col("removed"))).alias("fails"), F.max(F.when(alone, F.col("removed"))).alias("unique_fails"))
    # a part that a prefix leaves without survivors has no edge there: zeros
    steps = orders(docs.sparkSession, filters).join(sizes, "filter").join(found, [part, "filter", "state"], "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long")
    return steps.select(
        part, "filter_order", "step", (zero("survivors") - zero("removed")).alias("kept"), zero("removed").alias("removed"), (zero("fails") - zero("removed")).alias("redundant"), zero("unique_fails").alias("unique_fails"),
        *(zero(k).alias(f"{k}_lost") for k in kinds), F.sum(zero("removed")).over(Window.partitionBy(part, "filter")).alias("shapley"),
    )


def verdicts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, A, B, C, D, E, good, toxic) per document, by the five filters of the contract."""
    text = text_of("text")
    words = F.array_remove(F.split("t", _SPACES, -1), "")
    rows = docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("part"), text.alias("t"))
    rows = rows.withColumn("w", words).select(
        "doc_id", "part", (F.size("w") < 100).alias("A"), (100 * F.size(F.array_distinct("w")) < 80 * F.size("w")).alias("B"),
        (100 * F.regexp_count("t", F.lit("[A-Z]")) > 10 * F.length("t")).alias("C"), F.col("t").rlike("[#$%&*|]").alias("D"), F.unhex(F.sha2("t", 256)).alias("same"),
    )
    rows = written(rows, "auditverdicts")
    copied = rows.groupBy("same").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("copies")).where("copies > 1").drop("copies")
    known = labels.where("doc_id is not null").groupBy("doc_id").agg(F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    met = rows.join(copied, "same", "left").join(known, "doc_id", "left")
    no = F.lit(False)
    return met.select("part", "A", "B", "C", "D", F.coalesce(F.col("doc_id") > F.col("first"), no).alias("E"), F.coalesce("good", no).alias("good"), F.coalesce("toxic", no).alias("toxic"))


def op13(spark, sf_dir: str) -> DataFrame:
    docs = verdicts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return audit(docs, "part", list("ABCDE"), ["good", "toxic"])


ORACLE = r"""
WITH t AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM t),
l AS (
  SELECT doc_id, bool_or(coalesce(quality = 1, false)) AS good, bool_or(coalesce(toxic = 1, false)) AS toxic
  FROM labels WHERE doc_id IS NOT NULL GROUP BY 1),
d AS (
  SELECT part, len(w) < 100 AS a, 100 * len(list_distinct(w)) < 80 * len(w) AS b,
         100 * len(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * len(t) AS c, regexp_matches(t, '[#$%&*|]') AS d,
         coalesce(w.doc_id > min(w.doc_id) OVER (PARTITION BY t), false) AS e,
         coalesce(good, false) AS good, coalesce(toxic, false) AS toxic
  FROM w LEFT JOIN l ON w.doc_id = l.doc_id),
m AS (
  SELECT part, CAST(a AS INTEGER) + 2 * CAST(b AS INTEGER) + 4 * CAST(c AS INTEGER) + 8 * CAST(d AS INTEGER) + 16 * CAST(e AS INTEGER) AS fails, good, toxic
  FROM d),
f AS (SELECT substr('ABCDE', CAST(i AS BIGINT) + 1, 1) AS f, CAST(1 << i AS INTEGER) AS bit FROM (SELECT unnest(range(5))::INTEGER AS i)),
o AS (
  SELECT p.f || q.f || r.f || s.f || u.f AS filter_order, [p.bit, q.bit, r.bit, s.bit, u.bit] AS bits
  FROM f p, f q, f r, f s, f u WHERE p.bit + q.bit + r.bit + s.bit + u.bit = 31 AND (p.bit | q.bit | r.bit | s.bit | u.bit) = 31),
s AS (
  SELECT filter_order, step, bits[step] AS bit, CAST(coalesce(list_sum(bits[1 : step - 1]), 0) AS INTEGER) AS before
  FROM o, (SELECT unnest(range(1, 6))::INTEGER AS step)),
e AS (SELECT DISTINCT bit, before FROM s),
c AS (
  SELECT part, bit, before, count(*) FILTER ((fails & (before | bit)) = 0) AS kept, count(*) FILTER ((fails & before) = 0 AND (fails & bit) > 0) AS removed,
         count(*) FILTER ((fails & before) > 0 AND (fails & bit) > 0) AS redundant, count(*) FILTER (fails = bit) AS unique_fails,
         count(*) FILTER ((fails & before) = 0 AND (fails & bit) > 0 AND good) AS good_lost, count(*) FILTER ((fails & before) = 0 AND (fails & bit) > 0 AND toxic) AS toxic_lost
  FROM m, e GROUP BY 1, 2, 3)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, c.bit) AS BIGINT) AS shapley
FROM s JOIN c ON s.bit = c.bit AND s.before = c.before
"""
