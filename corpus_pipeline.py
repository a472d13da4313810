"""The corpus pipeline: quality rules, near-dedup, secret scans, source mixing, packing.

Every stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept; all but the
last return the columns of ``documents``.  Columns that clash with an operator's own names are
carried inside one struct and come out untouched.

Rows that repeat a ``doc_id``, or have none, are documents of their own, told apart by their texts.
Null texts are empty documents, which the quality rules reject; empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quireflow.llm import mixing, near_dedup, packing, quality_rules, secrets
from quireflow.llm.common import table, written
from quireflow.llm.tokens import vocabulary


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go: the base rule and trees fitted on the labelled documents that are here."""
    trees = quality_rules.fit(docs.select("doc_id", "text"), table(spark, sf_dir, "labels"))
    rows = docs.select(F.struct("*").alias("row"), "text")
    return quality_rules.judge(rows, trees, carry=["row"]).where("kept").select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, similarity 0.8) stays, the one of least doc_id."""
    return near_dedup.keep_one(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked; the documents stay."""
    masked = secrets.redact(docs, secrets.fit())
    return masked.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: complete epochs, then weighted draws up to the source's target."""
    # decisions need ids, sources, sizes and a hash of the whole row alone; rows move once, to meet them
    narrow = docs.select("doc_id", "source", mixing.size_of().alias("size"), _row_hash(docs).alias("same"))
    weighed = written(mixing.quality_weights(narrow, table(spark, sf_dir, "labels")), "mixrows")
    # rows that agree in all columns are told apart by number alone
    chosen = mixing.mix(weighed).groupBy("same").agg(F.sum("copies").alias("copies"), F.count(F.lit(1)).alias("rows")).where("copies > 0")
    met = docs.select(F.struct("*").alias("row"), _row_hash(docs).alias("same")).join(chosen, "same")
    nth = F.row_number().over(Window.partitionBy("same").orderBy(F.lit(1)))
    share = F.floor(F.col("copies") / F.col("rows")) + (F.col("nth") <= F.col("copies") % F.col("rows")).cast("long")
    alone = met.where("rows = 1").select("row", "copies")
    several = met.where("rows > 1").withColumn("nth", nth).select("row", share.alias("copies"))
    taken = alone.unionByName(several).where("copies > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select("row.*")


def _row_hash(docs: DataFrame) -> Column:
    """128 bits of a row's content, nulls told from empty texts."""
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema}
    # maps can't be hashed as they are
    values = [F.to_json(F.col(f"`{c}`")) if "map<" in k else F.col(f"`{c}`") for c, k in kinds.items()]
    nulls = [F.col(f"`{c}`").isNull() for c in kinds]
    return F.struct(F.xxhash64(F.lit(1), *values, *nulls).alias("a"), F.xxhash64(F.lit(2), *nulls, *values).alias("b"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces placed in sequences of at most 4096 tokens."""
    return packing.pack(docs, vocabulary("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", quality),
    ("simhash_near_dedup", near_duplicates),
    ("secret_scans", secret_scan),
    ("source_mixing", mixed),
    ("best_fit_packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


#: The trees, the forest, the fingerprints and the tokenizer are beyond SQL; tests hold run() against brute force.
ORACLE_SQL = None
