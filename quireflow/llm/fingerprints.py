"""Document fingerprints: SimHash in DataFrame operations only, and block tables to search them.

Terms are a text's words and its pairs of neighbouring words (pairs weigh ``PAIR_WEIGHT``; every
occurrence votes, so repeats add weight).  A term's 64-bit hash votes +weight on its set bits and
-weight on the others; a fingerprint bit is 1 where the votes are positive.

Votes are counted in packed counters, several to a long, in runs short enough that no counter overflows.
``simhash`` is one expression over the row.  Spark interprets such lambdas, so op2 takes ``simhashes``, which
counts the same votes in compiled aggregates: terms are exploded and summed within the task that holds the
text, and neither a term nor a counter is shuffled.

Search: the 64 bits are cut into ``blocks`` blocks; fingerprints within ``radius`` bits agree on at
least ``blocks - radius`` of them, so one table per choice of that many blocks, keyed by their bits
permuted to the front, finds every fingerprint within the radius by equality, and the rest is a
bit count, taken in the join itself.  Both sides are distinct fingerprints, so copies cost one row; AQE may
split a crowded key, and no pair beyond the radius is ever a row.

Defined results: null text is the empty text, which has the fingerprint 0 like every text without
words; equal texts have equal fingerprints; a text of any length is one row's work; with a single row its
next document is itself; rows that repeat a doc_id are ordered by text; a null id comes first; further
columns are not read, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import LOWER, UPPER, table, text_of, written

PAIR_WEIGHT = 2
_ONES = 0x0101010101010101
#: ASCII white space other than the space itself.
_BLANK = "\t\n\x0b\x0c\r"


def words_of(text: Column) -> Column:
    """Case-folded words (ASCII white space between them) of a text column."""
    flat = F.translate(text, UPPER + _BLANK, LOWER + " " * len(_BLANK))
    return F.array_remove(F.split(flat, " "), "")


def _bind(value: Column, f) -> Column:
    """``f(value)`` with ``value`` evaluated once: a lambda variable stands for it."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def _packed(hashes: Column, weight: int) -> Column:
    """Array of eight longs per run of terms: byte b of long k counts the votes for bit 8b + k."""
    run = 127 // weight
    zero = F.struct(*(F.lit(0).cast("long").alias(f"k{k}") for k in range(8)))

    def add(acc: Column, h: Column) -> Column:
        return F.struct(*((acc[f"k{k}"] + F.shiftrightunsigned(h, k).bitwiseAND(F.lit(_ONES)) * F.lit(weight).cast("long") if weight > 1 else acc[f"k{k}"] + F.shiftrightunsigned(h, k).bitwiseAND(F.lit(_ONES))).alias(f"k{k}") for k in range(8)))

    def count(c: Column) -> Column:
        return F.aggregate(F.slice(hashes, c * run + 1, F.lit(run)), zero, add, lambda acc: F.array(*(acc[f"k{k}"] for k in range(8))))

    last = F.ceil(F.size(hashes) / run).cast("int") - 1
    return F.when(F.size(hashes) > 0, F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), count)).otherwise(F.array().cast("array<array<bigint>>"))


def simhash(text: Column, pair_weight: int = PAIR_WEIGHT) -> Column:
    """The fingerprint of a text column, as a signed long."""

    def from_words(words: Column) -> Column:
        n = F.size(words)
        single = F.transform(words, lambda w: F.xxhash64(w))
        double = F.zip_with(F.slice(words, 1, F.greatest(n - 1, F.lit(0))), F.slice(words, 2, F.greatest(n - 1, F.lit(0))), lambda a, b: F.xxhash64(a, b))
        total = n + pair_weight * F.greatest(n - 1, F.lit(0))

        def bits(runs: Column) -> Column:
            def vote(b: Column) -> Column:
                # a bit is set where twice its votes exceed all of them
                k, byte = b % 8, (b / 8).cast("int")
                got = F.aggregate(runs, F.lit(0).cast("long"), lambda a, r: a + F.call_function("shiftrightunsigned", F.get(r, k), byte * 8).bitwiseAND(F.lit(255)))
                return F.when(2 * got > total, F.call_function("shiftleft", F.lit(1).cast("long"), b)).otherwise(F.lit(0).cast("long"))

            places = F.sequence(F.lit(0), F.lit(63))
            return F.aggregate(F.transform(places, vote), F.lit(0).cast("long"), lambda a, x: a.bitwiseOR(x))

        runs = F.concat(_bind(single, lambda h: _packed(h, 1)), _bind(double, lambda h: _packed(h, pair_weight)))
        return _bind(runs, bits)

    return F.coalesce(_bind(words_of(text), from_words), F.lit(0).cast("long"))


def simhashes(rows: DataFrame, by: list[str], texts: list[str], pair_weight: int = PAIR_WEIGHT) -> DataFrame:
    """(by, and for each text column ``<name>_fp``): what ``simhash`` gives, a row per row; ``by`` tells the rows apart.

    Lane k of the first sums counts bits k, k+16, k+32 and k+48 in 16 bits each, for runs of terms that can't fill
    them; the second sums add up the runs in 32 bits.  Where ``rows`` are dealt by some of ``by``, nothing is shuffled.
    """
    zero = F.lit(0).cast("long")
    quarters, halves = F.lit(0x0001000100010001), F.lit(0x0000FFFF0000FFFF)
    run = 0x7FFF // (1 + pair_weight)
    each = F.explode(F.array(*(F.struct(F.lit(i).alias("of"), words_of(F.col(f"`{c}`")).alias("words")) for i, c in enumerate(texts))))
    split = rows.select(*by, each.alias("__t")).select(*by, F.col("__t.of").alias("__of"), F.coalesce("__t.words", F.array().cast("array<string>")).alias("__words"))
    # a text without words keeps one row, which votes for nothing
    after = F.slice("__words", 2, F.greatest(F.size("__words"), F.lit(1)))
    terms = split.select(*by, "__of", F.posexplode_outer(F.arrays_zip(F.col("__words").alias("word"), after.alias("next"))).alias("__at", "__term"))
    terms = terms.select(*by, "__of", F.coalesce(F.expr(f"__at div {run}"), zero).alias("__run"), F.col("__term.word").alias("__word"), F.col("__term.next").alias("__next"))
    single = F.when(F.col("__word").isNotNull(), F.xxhash64("__word")).otherwise(zero)
    double = F.when(F.col("__next").isNotNull(), F.xxhash64("__word", "__next")).otherwise(zero)
    votes = F.when(F.col("__word").isNotNull(), F.lit(1)).otherwise(F.lit(0)) + F.when(F.col("__next").isNotNull(), F.lit(pair_weight)).otherwise(F.lit(0))
    terms = terms.select(*by, "__of", "__run", single.alias("__a"), double.alias("__b"), votes.cast("long").alias("__votes"))

    def lane(k: int) -> Column:
        a, b = (F.shiftrightunsigned(c, k).bitwiseAND(quarters) for c in ("__a", "__b"))
        return a + b * F.lit(pair_weight).cast("long")

    sums = terms.groupBy(*by, "__of", "__run").agg(F.sum("__votes").alias("__votes"), *(F.sum(lane(k)).alias(f"__l{k}") for k in range(16)))

    def of(i: int, value: Column) -> Column:
        return F.sum(F.when(F.col("__of") == i, value).otherwise(zero))

    pairs = [F.shiftrightunsigned(f"__l{k % 16}", k // 16 * 16).bitwiseAND(halves) for k in range(32)]
    totals = sums.groupBy(*by).agg(*(x for i in range(len(texts)) for x in (of(i, F.col("__votes")).alias(f"__n{i}"), *(of(i, c).alias(f"__p{i}_{k}") for k, c in enumerate(pairs)))))

    def print_of(i: int) -> Column:
        out = zero
        for b in range(64):
            got = F.shiftrightunsigned(f"__p{i}_{b % 32}", b // 32 * 32).bitwiseAND(F.lit(0xFFFFFFFF))
            # a bit is set where twice its votes exceed all of them
            out = out.bitwiseOR(F.when(2 * got > F.col(f"__n{i}"), F.lit((1 << b) - (1 << 64 if b == 63 else 0)).cast("long")).otherwise(zero))
        return out

    return totals.select(*by, *(print_of(i).alias(f"{c}_fp") for i, c in enumerate(texts)))


def likeness(a: Column, b: Column) -> Column:
    """1 for equal fingerprints, 0 where every bit differs."""
    return 1 - F.bit_count(a.bitwiseXOR(b)) / F.lit(64.0)


def hexed(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def block_tables(radius: int, blocks: int) -> list[int]:
    """One 64-bit mask per choice of ``blocks - radius`` blocks."""
    edge = [64 * i // blocks for i in range(blocks + 1)]
    part = [((1 << edge[i + 1]) - 1) ^ ((1 << edge[i]) - 1) for i in range(blocks)]
    masks = [sum(part[i] for i in chosen) for chosen in combinations(range(blocks), blocks - radius)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def near(queries: DataFrame, stored: DataFrame, radius: int = 3, blocks: int = 6) -> DataFrame:
    """(query_fp, fp, distance) for all distinct stored fingerprints within ``radius`` of each query's.

    Both sides are reduced to distinct fingerprints (column ``fp``) first, so copies cost one row.
    """
    if not 0 <= radius < blocks <= 64:
        raise ValueError("0 <= radius < blocks <= 64")
    masks = block_tables(radius, blocks)

    def keyed(df: DataFrame, name: str) -> DataFrame:
        slots = F.array(*(F.struct(F.lit(i).cast("byte").alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for i, m in enumerate(masks)))
        return df.select("fp").where("fp is not null").distinct().select(F.col("fp").alias(name), F.explode(slots).alias("b")).select(name, "b.t", "b.key")

    left, right = keyed(queries, "query_fp").alias("a"), keyed(stored, "fp").alias("b")
    distance = F.bit_count(F.col("query_fp").bitwiseXOR(F.col("fp")))
    # neither side has a bound, so neither may be broadcast whatever its estimate
    met = left.join(right.hint("merge"), (F.col("a.t") == F.col("b.t")) & (F.col("a.key") == F.col("b.key")) & (distance <= radius))
    return met.select("query_fp", "fp", distance.alias("distance")).distinct()


def n_near(prints: DataFrame, queries: DataFrame, radius: int = 3, blocks: int = 6) -> DataFrame:
    """(fp, n_near): rows of ``prints`` within the radius of each query fingerprint, the query's own row left out."""
    held = prints.groupBy("fp").agg(F.count(F.lit(1)).alias("rows"))
    found = near(queries, held, radius, blocks).join(held, "fp")
    return found.groupBy("query_fp").agg((F.sum("rows") - 1).alias("n_near")).withColumnRenamed("query_fp", "fp")


def _number(key: str, kind: str) -> Column:
    """A double that never falls as the key rises: numbers as they are, of other values the first six bytes of their text."""
    if kind in ("tinyint", "smallint", "int", "bigint", "float", "double") or kind.startswith("decimal"):
        return F.col(key).cast("double")
    return F.conv(F.rpad(F.hex(F.substring(F.col(key).cast("string").cast("binary"), 1, 6)), 12, "0"), 16, 10).cast("double")


def _cuts_not_above(value: Column, cuts: list[float]) -> Column:
    """How many of the sorted cuts are <= value, in two steps of about sqrt(cuts) comparisons."""
    if not cuts:
        return F.lit(0)
    m = max(1, int(len(cuts) ** 0.5))
    groups = [cuts[i : i + m] for i in range(0, len(cuts), m)]
    count = lambda array: F.size(F.filter(array, lambda c: c <= value))
    group = F.greatest(count(F.array(*(F.lit(g[0]) for g in groups))) - 1, F.lit(0))
    return group * m + count(F.get(F.array(*(F.array(*map(F.lit, g)) for g in groups)), group))


#: Bounds of ranges that stand in the plan, at most; more ranges than these are cut evenly between two bounds.
MOST_CUTS = 2048


def _places(docs: DataFrame, number: Column, of: Column, ranges: int) -> Column:
    """A range number that never falls as ``number`` rises, for the rows of ``of``: 0 to about ``ranges``.

    Approximate quantiles (a few numbers on the driver) part the rows evenly, and each of their intervals is parted evenly by value."""
    coarse = min(ranges, MOST_CUTS)
    fine = -(-ranges // coarse)
    at = sorted(set(docs.where(of).select(number.alias("k")).approxQuantile("k", [i / coarse for i in range(coarse + 1)], 0.2 / coarse)))
    if len(at) < 2:
        return F.lit(0)
    lows, spans = (F.array(*map(F.lit, x)) for x in (at[:-1], [b - a for a, b in zip(at, at[1:])]))
    place = F.least(F.greatest(_cuts_not_above(number, at) - 1, F.lit(0)), F.lit(len(at) - 2))
    share = (number - F.get(lows, place)) / F.get(spans, place)
    return place * fine + F.least(F.greatest(F.floor(F.nanvl(share, F.lit(1.0)) * fine), F.lit(0)), F.lit(fine - 1)).cast("int")


def neighbours(docs: DataFrame, key: str = "doc_id", text: str = "text", ranges: int | None = None) -> DataFrame:
    """(range, nth, key, text, next_text): texts (null: empty) and those of the next row in ascending key order, the first's after the last.

    Ranges, as many as the session's shuffles ask for, are one window group each, and only each range's first row crosses ranges.
    Rows without a key come first, in ranges by the beginning of their texts. Rows stay dealt by ``range``, in which ``nth`` counts them.
    """
    spark: SparkSession = docs.sparkSession
    n = ranges or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    docs = docs.select(F.col(key).alias("k"), text_of(text).alias("text"))
    keyed, begins = _number("k", docs.schema["k"].dataType.simpleString()), _number("text", "string")
    no_key = F.col("k").isNull()
    place = F.when(no_key, _places(docs, begins, no_key, n) - (1 << 30)).otherwise(_places(docs, keyed, ~no_key, n))
    ranged = docs.select("k", "text", place.cast("int").alias("range"))
    # one narrow row per range, of which there are about four times the shuffle partitions
    firsts = ranged.groupBy("range").agg(F.min(F.struct(F.col("k").isNotNull().alias("live"), F.col("k").alias("k"))).alias("m")).select("range", F.col("m.k").alias("first"))
    met = ranged.join(F.broadcast(firsts), "range").where(F.col("k").eqNullSafe(F.col("first")))
    least = written(met.groupBy("range").agg(F.min("text").alias("head")), "heads")
    # only range numbers are ordered in one task, not texts
    after = least.select("range", _head_after("range").alias("after_range"))
    heads = after.join(least.select(F.col("range").alias("after_range"), "head"), "after_range").select("range", "head")
    within = Window.partitionBy("range").orderBy(F.col("k").asc_nulls_first(), "text")
    led = ranged.select("*", F.row_number().over(within).alias("nth"), F.lead("text").over(within).alias("after")).join(heads, "range")
    return led.select("range", "nth", F.col("k").alias(key), "text", F.coalesce("after", "head").alias("next_text"))


def _head_after(column: str) -> Column:
    """Of one row per range: the column's value in the next range, in the last that of the first."""
    by = Window.orderBy("range")
    return F.coalesce(F.lead(column).over(by), F.first(column).over(by.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))


def with_next_print(prints: DataFrame, fp: str = "fp") -> DataFrame:
    """A written table that has the ``range`` and ``nth`` of ``neighbours``, with the next row's fingerprint as ``next_fp``."""
    # two numbers per range, of which there are about four times the shuffle partitions
    heads = prints.where("nth = 1").select("range", _head_after(fp).alias("head_fp"))
    lead = F.lead(fp).over(Window.partitionBy("range").orderBy("nth"))
    return prints.withColumn("after_fp", lead).join(F.broadcast(heads), "range").withColumn("next_fp", F.coalesce("after_fp", "head_fp")).drop("after_fp", "head_fp")


def with_next(docs: DataFrame, key: str = "doc_id", text: str = "text", ranges: int | None = None) -> DataFrame:
    """(key, text, fp, next_text, next_fp): texts (null: empty) with their fingerprints and those of the next row, as ``neighbours`` has it."""
    rows = neighbours(docs, key, text, ranges).withColumn("fp", simhash(F.col("text")))
    after = F.lead("fp").over(Window.partitionBy("range").orderBy("nth"))
    # a range's last row alone has no row after it, and only there the next text is fingerprinted again
    return rows.withColumn("after_fp", after).select(key, "text", "fp", "next_text", F.coalesce("after_fp", simhash(F.col("next_text"))).alias("next_fp"))


#: Ids divisible by this are the queries of op2's search.
QUERY_STEP = 20


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's columns, and ``n_near`` for ids divisible by ``QUERY_STEP``: other documents within three bits (null for other ids)."""
    rows = neighbours(table(spark, sf_dir, "documents").select("doc_id", "text"))
    n = F.length("text")
    quarter = F.floor(n / 4).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - quarter), F.substring(F.col("next_text"), F.lit(1), quarter))
    rows = rows.select("range", "nth", "doc_id", n.cast("long").alias("n_chars"), "text", edited.alias("edited"))
    rows = rows.withColumn("edited_sha256", F.sha2(F.col("edited").cast("binary"), 256))
    prints = written(simhashes(rows, ["range", "nth", "doc_id", "n_chars", "edited_sha256"], ["text", "edited"]), "prints")
    prints = with_next_print(prints, "text_fp").select("doc_id", "n_chars", "edited_sha256", F.col("text_fp").alias("fp"), F.col("next_fp").alias("nfp"), F.col("edited_fp").alias("efp"))
    chosen = F.col("doc_id") % QUERY_STEP == 0
    found = n_near(prints, prints.where(chosen)).withColumn("chosen", F.lit(True))
    met = prints.withColumn("chosen", chosen).join(found, ["fp", "chosen"], "left")
    return met.select(
        "doc_id", "n_chars", "edited_sha256", hexed(F.col("fp")).alias("fingerprint"), hexed(F.col("efp")).alias("edited_fingerprint"),
        likeness(F.col("fp"), F.col("efp")).alias("near_edited"), likeness(F.col("fp"), F.col("nfp")).alias("near_next"), "n_near",
    )
