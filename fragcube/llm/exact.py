"""Exact deduplication by skew-safe combining, with DataFrame functions only.

Texts are equal when identical without the six ASCII white-space characters.
Three aggregations, each on the digest *and* the whole normalised text, so
content is compared in full at every stage and a digest shared by different
texts cannot merge them:

1. inside each task, before anything is shuffled (Spark's partial aggregate);
2. per salt, the salt being the task that made the partial result modulo
   ``salts``, so the copies of one text meet in many tasks;
3. the winners of all salts.

The winner travels as one decimal (length first, then the smaller id), which
keeps the aggregate a hash aggregate of fixed-size values.  Documents find
their class by digest; only where a digest has several contents is the text
compared again.

Null text counts as empty.  A null ``doc_id`` loses to any other of the same
length.  Rows that repeat a ``doc_id`` in one class count in ``group_size`` and
all have the winner's id, hence are all ``kept``.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fragcube.session import materialise

SALTS = 16
#: Distance between two lengths in the rank of a row; ids fill the space between.
STEP = 2**65


def number(value: int) -> Column:
    return F.lit(str(value)).cast("decimal(20,0)")


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+", "")


def classes(docs: DataFrame, digest: Callable[[Column], Column], salts: int = SALTS) -> DataFrame:
    """One row per different text: ``digest``, ``norm``, ``best`` and ``size``."""
    length = F.char_length(F.coalesce("text", F.lit(""))).cast("decimal(10,0)")
    smaller = F.coalesce(number(2**63) - F.col("doc_id").cast("decimal(20,0)"), F.lit(0)).cast("decimal(20,0)")
    rows = docs.select(
        normalised(F.col("text")).alias("norm"),
        (length * number(STEP) + smaller).cast("decimal(38,0)").alias("best"),
        (F.spark_partition_id() % salts).alias("salt"),
    )
    rows = rows.withColumn("digest", digest(F.col("norm")))
    salted = rows.groupBy("digest", "norm", "salt").agg(F.max("best").alias("best"), F.count(F.lit(1)).alias("size"))
    return salted.groupBy("digest", "norm").agg(F.max("best").alias("best"), F.sum("size").alias("size"))


def decide(docs: DataFrame, digest: Callable[[Column], Column] | None = None, salts: int = SALTS) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``keep_id``, ``group_size``, ``kept`` and ``text_sha256``."""
    digest = digest or (lambda norm: F.unhex(F.sha2(norm, 256)))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    under = (F.col("best") % number(STEP)).cast("decimal(20,0)")
    keep = F.when(under > 0, (number(2**63) - under).cast("long"))
    found = classes(docs, digest, salts)
    merged = found.groupBy("digest").agg(
        F.count(F.lit(1)).alias("contents"), F.max("best").alias("best"), F.sum("size").alias("size"),
    )
    stored = materialise(merged.select("digest", "contents", keep.alias("keep_id"), F.col("size").alias("group_size")), "classes")
    rows = docs.select("doc_id", normalised(F.col("text")).alias("norm"))
    rows = rows.select("doc_id", digest(F.col("norm")).alias("digest"), F.sha2("norm", 256).alias("text_sha256"), "norm")
    single = rows.drop("norm").join(stored.filter("contents = 1"), "digest").drop("digest", "contents")
    shared = stored.filter("contents > 1").select("digest")
    if shared.isEmpty():
        out = single
    else:
        several = found.join(shared, "digest", "left_semi").select("digest", "norm", keep.alias("keep_id"), F.col("size").alias("group_size"))
        out = single.unionByName(rows.join(several, ["digest", "norm"]).drop("digest", "norm"))
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    return out.select("doc_id", "keep_id", "group_size", kept.alias("kept"), "text_sha256")


def keep(docs: DataFrame, salts: int = SALTS) -> DataFrame:
    """One row of each group of equal texts, with all columns: the winner; of rows that repeat its id and text any one."""
    won = decide(docs, salts=salts).filter("kept").groupBy("doc_id", "text_sha256").agg(F.count(F.lit(1)).alias("rows"))
    won = materialise(won.select(F.col("doc_id").alias("won_id"), F.col("text_sha256").alias("won_text"), "rows"), "winners")
    sha = F.sha2(normalised(docs["text"]), 256)
    same = docs["doc_id"].cast("long").eqNullSafe(won["won_id"]) & (sha == won["won_text"])
    single = docs.join(won.filter("rows = 1"), same, "left_semi")
    several = docs.join(won.filter("rows > 1"), same, "left_semi")
    # partial results inside each task first, so a row that a third of the table repeats is few rows by then
    name = "_sha"
    while name in docs.columns:
        name += "_"
    return single.unionByName(several.withColumn(name, sha).dropDuplicates(["doc_id", name]).drop(name))
