"""Canonical form on assembly: per fragment one affine map, joined once.

Fragments of one variable may be packed differently, in other units, or counted from
another epoch.  Unpacking, conversion and rebasing are each ``x * factor + offset``, so
together they are too: a row per fragment says how its stored numbers become the
variable's.  Fragments for which there is no such map are rows of
:func:`canonical_violations`, and cells of theirs raise when they are read.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.cf import unit_maps
from ..model import Block
from ..session import lookup_join, materialise

NUMBERS = ("scale_factor", "add_offset", "_FillValue")


def affine_maps(attrs: DataFrame, units: str | None = None) -> DataFrame:
    """``frag_id``, ``fill``, ``factor``, ``offset`` and ``problem`` from a variable's attributes ``(frag_id, attr, value)``.

    ``units`` are those of the variable (an expression, or ``"<unit> since <epoch>"``);
    a fragment that names none has these.
    """
    pick = lambda name: F.max(F.when(F.col("attr") == name, F.col("value")))
    held = attrs.groupBy("frag_id").agg(pick("units").alias("units"), *[pick(n).alias(n) for n in NUMBERS])
    if units is None:
        held = held.withColumns({"factor": F.lit(1.0), "offset": F.lit(0.0), "wrong": F.lit(None).cast("string")})
    else:
        held = unit_maps(materialise(held, "headers"), units)
        none = F.col("units").isNull()
        wrong = F.when(~none & F.col("factor").isNull(), F.concat(F.lit("no conversion from "), F.col("units"), F.lit(f" to {units}")))
        held = held.withColumn("wrong", wrong).withColumns({
            "factor": F.when(none, 1.0).otherwise(F.col("factor")), "offset": F.when(none, 0.0).otherwise(F.col("offset")),
        })
    number = {n: F.col(n).try_cast("double") for n in NUMBERS}
    for n in NUMBERS:
        held = held.withColumn("wrong", F.coalesce("wrong", F.when(F.col(n).isNotNull() & number[n].isNull(), F.concat(F.lit(f"{n} is no number: "), F.col(n)))))
    scale, add = F.coalesce(number["scale_factor"], F.lit(1.0)), F.coalesce(number["add_offset"], F.lit(0.0))
    return held.select(
        "frag_id", number["_FillValue"].alias("fill"), (scale * F.col("factor")).alias("factor"),
        (add * F.col("factor") + F.col("offset")).alias("offset"), F.col("wrong").alias("problem"),
    )


def canonical_violations(attrs: DataFrame, units: str | None = None) -> DataFrame:
    """Fragments that cannot be brought to the variable's form, and why."""
    return affine_maps(attrs, units).filter("problem is not null").select("frag_id", "problem")


def conformed(block: Block, var: str, attrs: DataFrame, units: str | None, n_frags: int) -> Block:
    """The block with ``var`` in canonical form, as doubles; stored cells and scanned ones alike.

    Fill values and NaN become NULL.  Constant fragments hold canonical values already.
    """
    maps = materialise(affine_maps(attrs, units), "maps")
    spread: list[Column | str] = [f"l_{d}" for d in block.dims] or [F.lit(0)]

    def apply(cells: DataFrame) -> DataFrame:
        joined = lookup_join(cells, maps, ["frag_id"], n_frags, spread, how="left")
        stored = F.col(f"`{var}`").cast("double")
        wrong = F.raise_error(F.concat(F.lit("fragment "), F.col("frag_id"), F.lit(": "), F.col("problem")))
        value = F.when(F.col("problem").isNotNull(), wrong).when(F.isnan(stored) | stored.eqNullSafe(F.col("fill")), None)
        value = value.otherwise(stored * F.coalesce("factor", F.lit(1.0)) + F.coalesce("offset", F.lit(0.0)))
        return joined.withColumn(var, value).select(*[f"`{c}`" for c in cells.columns])

    scan = block.scan and (lambda frags, wanted, bounds: apply(block.scan(frags, wanted, bounds)))
    reader = block.reader and (lambda names: apply(block.reader(names)))
    return replace(block, cells=apply(block.cells), scan=scan, reader=reader)
