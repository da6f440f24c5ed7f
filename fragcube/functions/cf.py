"""Column functions that bring cells to their canonical form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .units import measure, unit_table
from ..session import lookup_join

# Microseconds per unit of time.
MICROSECONDS = {
    "microseconds": 1,
    "milliseconds": 1_000,
    "seconds": 1_000_000,
    "minutes": 60_000_000,
    "hours": 3_600_000_000,
    "days": 86_400_000_000,
    "weeks": 604_800_000_000,
    # short spellings, brought to the form with a final s
    "s": 1_000_000,
    "secs": 1_000_000,
    "mins": 60_000_000,
    "hs": 3_600_000_000,
    "hrs": 3_600_000_000,
    "ds": 86_400_000_000,
}


def mask_and_scale(value: Column, fill: Column | None = None, scale: Column | None = None, offset: Column | None = None) -> Column:
    """Fill value and NaN become NULL, then ``value * scale + offset``."""
    out = value.cast("double")
    out = F.when(F.isnan(out), None).otherwise(out)
    if fill is not None:
        out = F.when(out.eqNullSafe(fill.cast("double")), None).otherwise(out)
    if scale is not None:
        out = out * F.coalesce(scale, F.lit(1.0))
    if offset is not None:
        out = out + F.coalesce(offset, F.lit(0.0))
    return out


def packed_attrs(attrs: DataFrame) -> DataFrame:
    """Packing of each fragment as columns ``fill``, ``scale``, ``offset``."""
    pick = lambda name: F.max(F.when(F.col("attr") == name, F.col("value").cast("double")))
    return attrs.groupBy("frag_id").agg(
        pick("_FillValue").alias("fill"), pick("scale_factor").alias("scale"), pick("add_offset").alias("offset")
    )


def unpack(cells: DataFrame, value: str, attrs: DataFrame, n_frags: int, spread: list[Column]) -> DataFrame:
    """Apply the packing of each fragment to its cells."""
    packing = packed_attrs(attrs)
    joined = lookup_join(cells, packing, ["frag_id"], n_frags, spread, how="left")
    return joined.withColumn(
        value, mask_and_scale(F.col(value), F.col("fill"), F.col("scale"), F.col("offset"))
    ).drop("fill", "scale", "offset")


def _lookup(unit: Column, table: dict[str, object]) -> Column:
    return F.create_map(*[F.lit(x) for pair in table.items() for x in pair])[unit]


def unit_maps(frag_units: DataFrame, target: str) -> DataFrame:
    """``frag_units`` with ``factor`` and ``offset`` to the target unit, null where there is no conversion.

    Each distinct expression is read once.  A unit that is spelt like the target is
    the target, whether it is known or not.
    """
    goal = measure(target)
    table = unit_table(frag_units)
    n = table.count()
    joined = lookup_join(frag_units, table.withColumnsRenamed({"factor": "_f", "offset": "_o"}), ["units"], n, ["frag_id"], "left")
    kind, factor, offset = (" ".join(map(str, goal.powers)), goal.factor, goal.offset) if goal else (None, 1.0, 0.0)
    same, fits = F.col("units") == target, F.col("kind") == F.lit(kind)
    return joined.withColumns({
        "factor": F.when(same, 1.0).when(fits, F.col("_f") / factor),
        "offset": F.when(same, 0.0).when(fits, (F.col("_o") - offset) / factor),
    }).drop("_f", "_o", "kind")


def conform_units(
    cells: DataFrame, value: str, frag_units: DataFrame, target: str, n_frags: int, spread: list[Column], strict: bool = True
) -> DataFrame:
    """``value`` of each fragment in the target unit; a cell of a fragment whose unit cannot be converted is an error.

    Unless ``strict`` such a cell stays, with NULL for its value.  A fragment without
    a unit has the target's.
    """
    joined = lookup_join(cells, unit_maps(frag_units, target), ["frag_id"], n_frags, spread, how="left")
    wrong = F.raise_error(F.concat(F.lit("fragment "), F.col("frag_id"), F.lit(": no conversion from "), F.col("units"), F.lit(f" to {target}")))
    unfit = wrong if strict else F.lit(None).cast("double")
    converted = F.when(F.col("units").isNull(), F.col(value)).when(F.col("factor").isNull(), unfit).otherwise(F.col(value) * F.col("factor") + F.col("offset"))
    return joined.withColumn(value, converted).drop("units", "factor", "offset")


def unit_violations(frag_units: DataFrame, target: str) -> DataFrame:
    """Fragments whose units are unknown or of another kind than the target."""
    found = unit_maps(frag_units, target)
    return found.filter("units is not null and factor is null").drop("factor", "offset")


def cast_canonical(cells: DataFrame, value: str, dtype: str, dims: list[str]) -> DataFrame:
    """Cast to the variable's type and add local indices of missing size-1 dimensions."""
    out = cells.withColumn(value, F.col(value).cast(dtype))
    for dim in dims:
        if f"l_{dim}" not in out.columns:
            out = out.withColumn(f"l_{dim}", F.lit(0).cast("long"))
    return out


def concat_chunk_characters(characters: Column) -> Column:
    """Text of a row that holds its whole character dimension as an array; no shuffle."""
    return F.rtrim(F.array_join(F.transform(characters, lambda c: F.coalesce(c, F.lit(""))), ""), F.lit("\u0000"))


def concat_characters(cells: DataFrame, keys: list[str], position: str, char: str) -> DataFrame:
    """Join a character dimension into text; a group is one string, as long as that string."""
    ordered = F.sort_array(F.collect_list(F.struct(F.col(position), F.col(char))))
    text = F.array_join(F.transform(ordered, lambda s: s[char]), "")
    return cells.groupBy(*keys).agg(F.rtrim(text, F.lit("\u0000")).alias("text"))


def _unit_us(unit: Column) -> Column:
    lower = F.lower(unit)
    plural = F.when(lower.endswith("s"), lower).otherwise(F.concat(lower, F.lit("s")))
    return F.when(F.trim(unit) != "", _lookup(plural, MICROSECONDS)).cast("long")


def known_unit_us(unit: Column) -> Column:
    """Microseconds of a unit; a unit that is no fixed length of time is an error, a missing one NULL."""
    us = _unit_us(unit)
    return F.when(us.isNull() & unit.isNotNull(), F.raise_error(F.concat(F.lit("not a unit of time: "), unit))).otherwise(us)


def decode_times(value: Column, units: Column) -> Column:
    """``"<unit> since <epoch>"`` to a zone-free timestamp; whole microseconds."""
    unit = F.regexp_extract(units, r"^\s*(\w+)\s+since\s+", 1)
    epoch = F.regexp_replace(F.regexp_extract(units, r"since\s+(.+?)\s*(?:UTC|Z)?\s*$", 1), "T", " ").cast("timestamp_ntz")
    return F.timestamp_add("MICROSECOND", F.round(value * known_unit_us(unit)).cast("long"), epoch)


def decode_timedelta(value: Column, unit: Column) -> Column:
    """Number and unit to a day-time interval."""
    us = F.round(value * known_unit_us(unit)).cast("long")
    seconds = (us / F.lit(1_000_000)).cast("decimal(18,6)")
    zero = F.lit(0)
    return F.make_dt_interval(zero, zero, zero, seconds)


def is_time_unit(unit: str) -> bool:
    """A plain length of time, singular or plural."""
    return bool(unit.strip()) and unit.lower().rstrip("s") + "s" in MICROSECONDS


def coordinate_names(attrs: DataFrame) -> DataFrame:
    """Names listed in any ``coordinates`` attribute."""
    listed = attrs.filter(F.col("attr") == "coordinates")
    return listed.select(F.explode(F.split(F.trim("value"), r"\s+")).alias("var")).filter("var <> ''").distinct()


def set_coords(variables: DataFrame, attrs: DataFrame) -> DataFrame:
    """Mark the variables that serve as coordinates."""
    named = coordinate_names(attrs).withColumn("_c", F.lit(1))
    return variables.join(named, "var", "left").withColumn("is_coord", F.coalesce("_c", F.lit(0))).drop("_c")
