"""From raw documents to packed training sequences, as five stages of Spark jobs.

Each stage takes what its predecessor kept, written as Parquet and read again:
quality rules, exact copies, near copies, repeated spans, packing.  Stages keep
all columns of ``documents``; the last returns the pieces and their places.
Rows with a null or repeated ``doc_id`` are documents of their own for the two
stages that remove copies; the removal of spans, which compares ids, leaves rows
without one as they are.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fragcube.llm import exact, jaccard, packing, quality, substring
from fragcube.llm.queries import table, vocabulary
from fragcube.session import materialise, scratch_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep what passes the rules and is mostly content; the field is fitted to labelled documents among these."""
    return quality.keep(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal but for white space one row stays."""
    return exact.keep(docs)


def with_row_ids(docs: DataFrame) -> DataFrame:
    """``docs`` with a column ``row_`` that names each row: its ``doc_id`` where no other row has it, else a number of its own."""
    shared = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1 or doc_id is null").select(F.col("doc_id").alias("shared_"))
    if shared.isEmpty():
        return docs.withColumn("row_", F.col("doc_id").cast("long"))
    shared = shared.withColumn("is_shared_", F.lit(True))
    rows = docs.join(shared, docs["doc_id"].eqNullSafe(shared["shared_"]), "left")
    # beyond all ids, so that the smallest id of a component still names it; stored, so that numbers stay
    own = F.when(F.col("is_shared_"), F.lit(2**62) + F.monotonically_increasing_id()).otherwise(F.col("doc_id").cast("long"))
    return materialise(rows.withColumn("row_", own).drop("shared_", "is_shared_"), "rows")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of similar documents the one with the smallest id stays."""
    rows = with_row_ids(docs)
    found = jaccard.join(rows.select(F.col("row_").alias("doc_id"), "text"))
    first = found.filter("doc_id = component_id").select(F.col("doc_id").alias("keep_"))
    return rows.join(first, rows["row_"] == first["keep_"], "left_semi").drop("row_")


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans of 50 words and more that stand in an earlier document are cut out."""
    return substring.strip(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, vocabulary("word_bpe_49k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("best_fit_packing", best_fit_packing),
]

#: A trained field and a tokenizer decide; the stages are tested against plain Python instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            path = scratch_path(spark, name)
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
