"""Build, write and read a manifest."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import raise_conventions
from ..model import DIFFERS, DimClass, DimInfo, FragmentError, FragmentSet, Manifest
from ..operators import infer, inventory as inv
from ..session import SINGLE_TASK_ROWS, compact, literal, lookup_join, materialise, materialise_observed

TABLES = ("inventory", "dim_frags", "frags", "vars", "attrs", "coords")


@dataclass(frozen=True)
class Inventory:
    """A stored inventory: one row per fragment, counted and measured while it was written."""

    wide: DataFrame
    dims: tuple[str, ...]
    coords: frozenset[str]
    n_frags: int
    measured: dict

    @property
    def classes(self) -> list[DimClass]:
        return infer.classes_of(self.measured, list(self.dims), set(self.coords))

    @property
    def long(self) -> DataFrame:
        return inv.long_inventory(self.wide, list(self.dims), set(self.coords))


@dataclass(frozen=True)
class Placement:
    """Where every fragment of an inventory belongs; ``full`` when they fill the grid."""

    dims: tuple[DimInfo, ...]
    dim_frags: DataFrame
    frags: DataFrame
    full: bool


def store_inventory(wide: DataFrame, dims: list[str], coords: set[str]) -> Inventory:
    """Write an inventory to the shared folder; later steps read no cell again.

    An inventory that was not counted from cells is taken to be of whole fragments.
    """
    if "whole" not in wide.columns:
        wide = wide.withColumn("whole", F.lit(True))
    stored, measured = materialise_observed(wide, "inventory", *infer.class_measures(dims))
    n_frags = measured["n_frags"]
    return Inventory(compact(stored, n_frags), tuple(dims), frozenset(coords), n_frags, measured)


def scan_inventory(fragments: FragmentSet) -> Inventory:
    """Scan the cells once."""
    wide = inv.wide_inventory(fragments)
    if fragments.uris is not None:
        wide = wide.join(fragments.uris, "frag_id", "left")
    return store_inventory(wide, fragments.dims, fragments.coords)


def place(inventory: Inventory) -> Placement:
    """``dims``, ``dim_frags`` and ``frags``; a row per dimension comes to the driver."""
    classes = inventory.classes
    dim_frags = infer.arrange_dimension(inventory.wide, classes, inventory.n_frags)
    large = inventory.n_frags > SINGLE_TASK_ROWS
    if large:
        dim_frags = materialise(dim_frags, "dim_frags")
    frags = infer.place_fragments(inventory.wide, dim_frags, classes, inventory.n_frags)
    if large:
        frags = materialise(frags, "frags")
    space, sizes, full = infer.measure_grid(frags, list(inventory.dims))
    dims = tuple(DimInfo(c.dim, c.dim_ord, c.kind, sizes[c.dim], space[c.dim], c.descending) for c in classes)
    return Placement(dims, dim_frags, frags, full)


def require_full(inventory: Inventory, placed: Placement) -> None:
    """Raise with the faults when fragments are not whole, overlap, leave holes or differ in size."""
    if inventory.measured["broken"]:
        inv.require_none(inventory.wide.filter("not whole").select("frag_id"), "fragments lack cells or hold some twice")
    moving = [d.dim for d in placed.dims if d.f_size > 1]
    if moving:
        meeting = infer.axis_overlaps(placed.frags, moving, {d.dim for d in placed.dims if d.descending})
        inv.require_none(meeting, "fragments overlap")
    if not placed.full:
        space = {d.dim: d.f_size for d in placed.dims}
        faults = infer.size_violations(inventory.long).unionByName(
            infer.grid_faults(placed.frags, list(space), space, inventory.n_frags)
        )
        inv.require_none(faults, "invalid aggregation")


def require_cells(fragments: FragmentSet, inventory: Inventory) -> None:
    """Raise when a fragment lacks cells or holds some twice; reads the index columns."""
    faults = inv.coverage_violations(fragments, inventory.wide, inventory.n_frags)
    if faults is not None:
        inv.require_none(faults, "fragments lack cells or hold some twice")


_VARS = "var string, dtype string, dims string, identifier string, block_ord int, fill string, adims string, class string"


def variable_rows(spark: SparkSession, fragments: FragmentSet, agg_dims: list[str]) -> DataFrame:
    """``vars`` from the schemas of the blocks, which all their fragments share."""
    rows = []
    for order, block in enumerate(fragments.blocks):
        moving = [d for d in block.dims if d in agg_dims]
        kind = "aggregated" if moving else "identical" if block.dims else "scalar"
        for var in block.vars:
            fill = block.cells.schema[var].metadata.get("_FillValue")
            rows.append((
                var, block.dtype(var), " ".join(block.dims), fragments.identifiers.get(var, var), order,
                None if fill is None else str(fill), " ".join(moving), kind,
            ))
    return literal(spark, rows, _VARS)


def build_manifest(
    fragments: FragmentSet,
    agg_dims: list[str] | None = None,
    updates: dict[str, str] | None = None,
    removals: list[str] | None = None,
    differs: str = DIFFERS,
    with_coords: bool = True,
    check: bool = True,
    check_values: bool = True,
    check_cells: bool = True,
) -> Manifest:
    """Infer the aggregation of a set of fragments.

    The cells are scanned once, into an inventory with a row per fragment.  It
    is stored, and all else is derived from it.  ``check`` tests the grid on
    the inventory; ``check_cells`` proves that each fragment holds every index once,
    which reads the indices again; ``check_values`` also compares the variables that
    must be the same in every file, which reads those variables.  Naming ``agg_dims``
    lets coordinates come from one fragment per piece of an axis.
    """
    spark = fragments.blocks[0].cells.sparkSession
    inventory = scan_inventory(fragments)
    n_frags = inventory.n_frags
    if n_frags < 2:
        raise FragmentError(f"unable to aggregate fewer than two fragments; found {n_frags}")
    placed = place(inventory)
    dims, frags = placed.dims, placed.frags
    if agg_dims is not None:
        derived = sorted(d.dim for d in dims if d.f_size > 1)
        if derived != sorted(agg_dims):
            raise FragmentError(f"aggregated dimensions are {derived}, not {sorted(agg_dims)}")
    if check:
        require_full(inventory, placed)
        if check_cells:
            require_cells(fragments, inventory)
    attrs = None
    if fragments.attrs is not None:
        # every file's header is behind this; the edits must not read them again
        attrs = materialise(inv.merge_attrs(fragments.attrs, differs).drop("warning"), "attrs")
        if updates:
            attrs, _ = infer.apply_updates(attrs, updates)
        if removals:
            attrs, _ = infer.apply_removals(attrs, removals)
        attrs = attrs.withColumn(
            "value",
            F.when(
                (F.col("scope") == "global") & (F.col("attr") == "Conventions"), raise_conventions(F.col("value"))
            ).otherwise(F.col("value")),
        )
    moving = [d.dim for d in dims if d.f_size > 1]
    if check_values:
        differing = infer.identical_violations(fragments, moving)
        if differing is not None:
            inv.require_none(differing, "variables that are not aggregated differ between fragments")
    variables = variable_rows(spark, fragments, moving)
    coords = None
    if with_coords and fragments.coords:
        coords = infer.concat_axis(fragments, frags, n_frags, moving, one_each=agg_dims is not None)
    return Manifest(typed(dims, fragments), inventory.wide, placed.dim_frags, frags, variables, attrs, coords, n_frags)


_DIMS = "dim string, dim_ord int, kind string, size long, f_size long, descending boolean, dtype string"


def typed(dims: tuple[DimInfo, ...], fragments: FragmentSet) -> tuple[DimInfo, ...]:
    """Dimensions with the types of their coordinates."""
    types = {d: b.dtype(f"c_{d}") for b in fragments.blocks for d in b.coords}
    return tuple(replace(d, dtype=types.get(d.dim, "")) for d in dims)


def with_locations(manifest: Manifest, uris: DataFrame | None = None, values: DataFrame | None = None) -> Manifest:
    """The manifest with ``uris(frag_id, uris)`` and ``values(frag_id, var, value)``, constants of a fragment.

    A fragment of which every variable is constant needs no location.
    """
    frags, n = manifest.frags, manifest.n_frags
    if uris is not None:
        frags = lookup_join(frags.drop("uris"), uris.select("frag_id", "uris"), ["frag_id"], n, ["frag_id"], "left")
    if values is not None:
        names = [r["var"] for r in manifest.vars.select("var").collect()]  # a header's worth of rows
        one = values.groupBy("frag_id").agg(*[F.max(F.when(F.col("var") == v, F.col("value"))).cast("double").alias(f"unique_{v}") for v in names])
        frags = lookup_join(frags.drop(*[f"unique_{v}" for v in names]), one, ["frag_id"], n, ["frag_id"], "left")
    return replace(manifest, frags=frags)


def group_path(path: str, group: str | None) -> str:
    """Folder of a nested group of the manifest at ``path``."""
    parts = [p for p in (group or "").strip("/").split("/") if p]
    return "/".join([path.rstrip("/"), *[f"groups/{p}" for p in parts]])


def write_manifest(manifest: Manifest, path: str, group: str | None = None) -> None:
    """One Parquet folder per table under ``path``, or under a group of it."""
    path = group_path(path, group)
    spark = manifest.frags.sparkSession
    rows = [(d.dim, d.dim_ord, d.kind, d.size, d.f_size, d.descending, d.dtype) for d in manifest.dims]
    literal(spark, rows, _DIMS).write.parquet(f"{path}/dims")
    for name in TABLES:
        table = getattr(manifest, name)
        if table is not None:
            table.write.parquet(f"{path}/{name}")


def _exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def read_manifest(spark: SparkSession, path: str, group: str | None = None) -> Manifest:
    """Read the tables back; sizes come from the file footers."""
    path = group_path(path, group)
    if not _exists(spark, f"{path}/dims"):
        raise FragmentError(f"no aggregation at {path!r}" + (f": group {group!r} not found" if group else ""))
    rows = spark.read.parquet(f"{path}/dims").orderBy("dim_ord").collect()
    dims = tuple(DimInfo(r.dim, r.dim_ord, r.kind, r.size, r.f_size, r.descending, r.asDict().get("dtype") or "") for r in rows)
    tables = {n: spark.read.parquet(f"{path}/{n}") if _exists(spark, f"{path}/{n}") else None for n in TABLES}
    n_frags = tables["frags"].count()
    for name in ("inventory", "dim_frags", "frags"):
        tables[name] = compact(tables[name], n_frags)
    return Manifest(dims, n_frags=n_frags, **tables)


def store_manifest(manifest: Manifest, path: str) -> Manifest:
    """Write and reopen, so that later plans start from files."""
    write_manifest(manifest, path)
    return read_manifest(manifest.frags.sparkSession, path)


def without_variables(manifest: Manifest, names: list[str]) -> Manifest:
    """The manifest with some variables dropped before anything is decoded."""
    return replace(manifest, vars=manifest.vars.filter(~F.col("var").isin(names)))
