"""Ordering the pieces of an axis: rank and running offset per dimension."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise

#: Pieces of axes that one task ranks.
BLOCK_ROWS = 200_000


def key_sql(column: str, dtype: str) -> str:
    """Coordinate as a double, zone independent, in SQL; NULL for strings."""
    if dtype == "string":
        return "cast(null as double)"
    if dtype == "date":
        return f"cast(datediff({column}, date'1970-01-01') as double)"
    if dtype.startswith("timestamp"):
        return f"cast(timestampdiff(MICROSECOND, cast('1970-01-01 00:00:00' as {dtype}), {column}) as double)"
    return f"(cast({column} as double) + 0D)"  # -0.0 becomes 0.0


def start_key(column: str, dtype: str) -> Column:
    """Coordinate as a double, zone independent; NULL for strings."""
    return F.expr(key_sql(column, dtype))


def idiv(value: Column, by: int | Column) -> Column:
    """Whole-number division of a non-negative integer; exact, and codegen friendly."""
    by = by if isinstance(by, Column) else F.lit(by)
    return ((value - F.pmod(value, by)) / by).cast("long")


def bound_key(value: object, dtype: str = "") -> float | None:
    """A literal on the scale of :func:`start_key` for an axis of type ``dtype``; None for text."""
    if isinstance(value, datetime.date) and not isinstance(value, datetime.datetime) and dtype.startswith("timestamp"):
        value = datetime.datetime(value.year, value.month, value.day)
    if isinstance(value, datetime.datetime):
        return float(value.replace(tzinfo=datetime.timezone.utc).timestamp() * 1_000_000)
    if isinstance(value, datetime.date):
        return float((value - datetime.date(1970, 1, 1)).days)
    return float(value) if isinstance(value, (int, float)) else None


AXIS = ("dim", "start", "start_s", "descending", "size")


def _orient(pieces: DataFrame, total: str, count: str) -> DataFrame:
    """Turn ascending rank and sum into position and offset of the real axis."""
    extra = [c for c in pieces.columns if c not in AXIS and not c.startswith("_")]
    return pieces.selectExpr(
        *AXIS, *extra,
        f"cast(if(descending, {count} - 1 - _rank, _rank) as bigint) as frag_pos",
        f"cast(if(descending, {total} - _sum, _sum - size) as bigint) as offset",
    )


def arrange(pieces: DataFrame, n_rows: int, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Position and offset of every piece ``(dim, start, start_s, descending, size, ...)``.

    Pieces are dealt out in ranges of (dimension, start), each range is ranked
    on its own, and the totals of the ranges before it in the same dimension
    are added.  A short axis is one range.  An axis in one piece, whose start
    is NULL, sorts like any other.
    """
    n_blocks = max(1, -(-n_rows // block_rows))
    blocked = pieces.withColumn("_block", F.lit(0))
    if n_blocks > 1:  # borders of ranges are sampled, so they are written down before use
        ranges = pieces.repartitionByRange(n_blocks, "dim", "start", "start_s")
        blocked = materialise(ranges.withColumn("_block", F.spark_partition_id()), "axis")
    totals = blocked.groupBy("dim", "_block").agg(F.sum("size").alias("_bsize"), F.count("*").alias("_bcount"))
    ahead = Window.partitionBy("dim").orderBy("_block")
    before = ahead.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("dim")
    totals = totals.select(
        "dim", "_block",
        F.coalesce(F.sum("_bsize").over(before), F.lit(0)).alias("_size_before"),
        F.coalesce(F.sum("_bcount").over(before), F.lit(0)).alias("_count_before"),
        F.sum("_bsize").over(whole).alias("_total"),
        F.sum("_bcount").over(whole).alias("_count"),
    )
    inner = Window.partitionBy("dim", "_block").orderBy("start", "start_s")
    ranked = (
        # one row per range and dimension: n_rows / block_rows of them
        blocked.join(totals, ["dim", "_block"])
        .withColumn("_rank", F.col("_count_before") + F.row_number().over(inner) - 1)
        .withColumn(
            "_sum",
            F.col("_size_before") + F.sum("size").over(inner.rowsBetween(Window.unboundedPreceding, 0)),
        )
    )
    return _orient(ranked, "_total", "_count")
