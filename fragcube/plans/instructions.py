"""Aggregation instructions: the feature variables that say where fragments go.

Instructions are tables in long form, so that an axis of a million fragments
is a million rows and never one array:

* ``variables(var, aggregated_dimensions, aggregated_data)``
* ``maps(name, dim, col, size)``         NULL where padded
* ``locations(name, pos, version, uri)`` ``pos`` counts row-major
* ``scalars(name, value)``               one value for all fragments
* ``values(name, pos, value)``           one value per fragment
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import DEFAULT_SUBSTITUTIONS, FEATURES, detect_convention, parse_features, substitute_all
from ..model import FragmentError, Manifest
from ..operators import decode, infer
from ..operators.array import fill_unique
from ..session import compact, literal


@dataclass(frozen=True)
class Instructions:
    variables: DataFrame
    maps: DataFrame
    locations: DataFrame | None = None
    scalars: DataFrame | None = None
    values: DataFrame | None = None


@dataclass(frozen=True)
class Decoded:
    """Fragments of one variable: position, extent, and location or value."""

    convention: str
    dims: tuple[str, ...]
    space: dict[str, int]
    frags: DataFrame


def to_instructions(manifest: Manifest, var: str, opt_id: int = 0) -> Instructions:
    """Write out where the fragments of an aggregated variable go."""
    spark = manifest.frags.sparkSession
    row = manifest.vars.filter(F.col("var") == var).first()
    if row is None or row["class"] != "aggregated":
        raise FragmentError(f"{var!r} is not an aggregated variable")
    dims = row["dims"].split(" ")
    space = {d: manifest.dim(d).f_size for d in dims}
    names = {"map": f"fragment_map_{opt_id}", "uris": f"fragment_uris_{opt_id}", "identifiers": f"fragment_identifiers_{var}"}
    data = " ".join(f"{feature}: {name}" for feature, name in names.items())
    variables = literal(spark, [(var, " ".join(dims), data)], "var string, aggregated_dimensions string, aggregated_data string")
    maps = infer.fragment_map(manifest.dim_frags, dims, space).select(F.lit(names["map"]).alias("name"), "dim", "col", "size")
    frags = infer.project_grid(manifest.frags, dims) if len(dims) < len(manifest.dims) else manifest.frags
    uris = F.col("uris") if "uris" in frags.columns else F.array("frag_id")
    locations = frags.select(
        F.lit(names["uris"]).alias("name"), infer.linear_position(dims, space).alias("pos"), F.posexplode(uris).alias("version", "uri")
    )
    scalars = literal(spark, [(names["identifiers"], row["identifier"])], "name string, value string")
    return Instructions(variables, maps, locations, scalars)


def decode_instructions(
    given: Instructions, var: str, substitutions: dict[str, str] | None = None
) -> Decoded:
    """Positions and extents of all fragments, each with its locations or its value.

    Works for every known layout of features; only the features and the number
    of fragments per dimension come to the driver.
    """
    row = given.variables.filter(F.col("var") == var).select(
        "aggregated_dimensions", parse_features(F.col("aggregated_data")).alias("f"),
    ).withColumn("convention", detect_convention(F.col("f"))).first()
    if row is None:
        raise FragmentError(f"no aggregated variable {var!r}")
    if row["convention"] is None:
        raise FragmentError(f"{var!r} has features {sorted(row['f'])}, which fit no known layout")
    convention, features = row["convention"], row["f"]
    dims = tuple(row["aggregated_dimensions"].split())
    shape = features[FEATURES[convention][0]]
    cells = given.maps.filter(F.col("name") == shape)
    counts = {r["dim"]: r["n"] for r in cells.groupBy("dim").agg(F.count("size").alias("n")).collect()}
    space = {d: counts[d] for d in dims}
    axis = decode.sizes_to_axis(cells, sum(space.values()))
    total = 1
    for n in space.values():
        total *= n
    frags = compact(decode.fragment_extents(axis, space), total).withColumn("pos", infer.linear_position(list(dims), space))
    if convention == "secondary":
        return Decoded(convention, dims, space, _with_values(frags, given, features["unique_values"]))
    names = FEATURES[convention]
    listed = given.locations.filter(F.col("name") == features[names[1]])
    versions = listed.groupBy("pos").agg(F.sort_array(F.collect_list(F.struct("version", "uri"))).alias("_v"))
    subs = {**DEFAULT_SUBSTITUTIONS, **(substitutions or {})}
    frags = frags.join(versions, "pos", "left").withColumn(
        "uris", substitute_all(F.transform("_v", lambda v: v["uri"]), subs)
    ).drop("_v")
    label = "format" if convention == "beta" else "identifier"
    held = features[names[2]]
    if given.values is not None:
        own = given.values.filter(F.col("name") == held).select("pos", F.col("value").cast("string").alias(label))
        frags = frags.join(own, "pos", "left")
    if given.scalars is not None:
        single = given.scalars.filter(F.col("name") == held).select(F.col("value").alias(label))
        frags = decode.broadcast_scalar(frags, single, label)
    if "value" in features and given.values is not None:
        frags = _with_values(frags, given, features["value"])
    return Decoded(convention, dims, space, frags)


def _with_values(frags: DataFrame, given: Instructions, name: str) -> DataFrame:
    values = given.values.filter(F.col("name") == name).select("pos", F.col("value").cast("double").alias("unique_value"))
    return frags.join(values, "pos", "left")


def constant_cells(decoded: Decoded, missing: float | None = None) -> DataFrame:
    """Cells of fragments that hold one value each; the missing value becomes NULL."""
    value = F.col("unique_value")
    if missing is not None:
        value = F.when(value != F.lit(missing), value)
    return fill_unique(decoded.frags.withColumn("unique_value", value), list(decoded.dims), "unique_value")
