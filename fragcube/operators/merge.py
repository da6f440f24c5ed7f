"""Merge partial aggregations, and add fragments to one as they arrive."""

from __future__ import annotations

from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..model import DIFFERS, FragmentError, FragmentSet, Manifest
from ..plans.manifest import Inventory, place, require_cells, require_full, scan_inventory, store_inventory, variable_rows
from ..session import lookup_join, materialise
from . import infer
from . import inventory as inv


def _union(tables: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def merge_inventories(parts: list[DataFrame], dims: list[str], coords: set[str]) -> Inventory:
    """One stored inventory in which each fragment appears once.

    Rows with one ``frag_id`` must describe the same extent: else they are
    different fragments of one name, or parts of a fragment, and an error.
    """
    merged = materialise(_union(parts), "parts")
    rest = [c for c in merged.columns if c != "frag_id"]
    extent = F.struct(*[f"{mark}_{d}" for d in dims for mark in inv.MARKS])
    clash = merged.groupBy("frag_id").agg(F.min(extent).alias("one"), F.max(extent).alias("other"))
    inv.require_none(clash.filter("not (one <=> other)").select("frag_id"), "fragments of one name differ in their extent")
    once = merged.groupBy("frag_id").agg(F.min_by(F.struct(*rest), F.col("file_ord")).alias("_r"))
    return store_inventory(once.select("frag_id", "_r.*"), dims, coords)


def merge_vars(parts: list[DataFrame], agg_dims: list[str]) -> DataFrame:
    """Variables of all manifests, classified for the merged axes."""
    rows = _union([p.select("var", "dtype", "dims", "identifier", "block_ord", "fill") for p in parts])
    clash = rows.groupBy("var").agg(
        inv.all_equal("dtype").alias("a"), inv.all_equal("dims").alias("b"), F.count("*").alias("n")
    )
    inv.require_none(
        clash.filter(~(F.col("a") & F.col("b")) | (F.col("n") != len(parts))).select("var"),
        "variables differ between the aggregations",
    )
    return infer.classify_vars(rows, agg_dims).withColumn("adims", F.concat_ws(" ", "adims")).drop("n_files")


def extend_manifests(manifests: list[Manifest], differs: str = DIFFERS) -> Manifest:
    """Merge aggregations; only their tables are read, never a cell.

    Positions and offsets are inferred anew from the starts, so the order of
    the parts, and batches of a single fragment, make no difference.
    """
    first = manifests[0]
    names = [d.dim for d in first.dims]
    for other in manifests[1:]:
        if {d.dim for d in other.dims} != set(names):
            raise FragmentError("the aggregations have different dimensions")
    inventory = merge_inventories([m.inventory for m in manifests], names, set(first.coord_dims))
    placed = place(inventory)
    require_full(inventory, placed)
    types = {d.dim: d.dtype for m in manifests for d in m.dims if d.dtype}
    dims = tuple(replace(d, dtype=types.get(d.dim, "")) for d in placed.dims)
    attrs = None
    if first.attrs is not None:
        each = [m.attrs.withColumn("file_ord", F.lit(i)) for i, m in enumerate(manifests)]
        attrs = inv.merge_attrs(_union(each), differs).drop("warning")
    coords = None
    if first.coords is not None:
        along = {d.dim: d.f_size for d in dims if d.kind != "pure"}
        coords = infer.move_axis(_union([m.coords.drop("idx") for m in manifests]), placed.dim_frags, along)
    agg_dims = [d.dim for d in dims if d.f_size > 1]
    variables = merge_vars([m.vars for m in manifests], agg_dims)
    return Manifest(
        dims, inventory.wide, placed.dim_frags, placed.frags, variables, attrs, coords, inventory.n_frags
    )


def partial_manifests(fragments: FragmentSet, batch: Column, n_batches: int) -> list[Manifest]:
    """One partial aggregation per batch, from a single scan of the cells.

    ``batch`` is a number from 0 to ``n_batches - 1`` computed from
    ``frag_id``.  A batch need not fill a grid by itself.
    """
    whole = scan_inventory(fragments)
    names, coords = fragments.dims, fragments.coords
    spark = whole.wide.sparkSession
    measured = whole.wide.groupBy(batch.alias("b")).agg(*infer.class_measures(names))
    out = []
    for row in measured.filter(F.col("b").between(0, n_batches - 1)).orderBy("b").collect():
        part = whole.wide.filter(batch == F.lit(row["b"]))
        placed = place(Inventory(part, whole.dims, whole.coords, row["n_frags"], row.asDict()))
        agg = [d.dim for d in placed.dims if d.f_size > 1]
        own = variable_rows(spark, fragments, agg)
        out.append(Manifest(placed.dims, part, placed.dim_frags, placed.frags, own, None, None, row["n_frags"]))
    return out


def batched_create(fragments: FragmentSet, batch: Column, n_batches: int) -> Manifest:
    """Create in batches, then extend; equals creation in one go."""
    return extend_manifests(partial_manifests(fragments, batch, n_batches))


def unknown_fragments(manifest: Manifest, arrived: FragmentSet) -> FragmentSet:
    """The fragments of ``arrived`` that the manifest does not hold; the cells of others are not read.

    Names come from the folders alone; the join by them prunes folders at run time.
    """
    known = manifest.inventory.select("frag_id")
    blocks = []
    for block in arrived.blocks:
        names = block.cells.select("frag_id").distinct()
        fresh = materialise(lookup_join(names, known, ["frag_id"], manifest.n_frags, ["frag_id"], how="left_anti"), "fresh")
        blocks.append(replace(block, cells=infer.cells_of(block, fresh, fresh.count())))
    return replace(arrived, blocks=tuple(blocks))


def incremental_append(manifest: Manifest, arrived: FragmentSet, differs: str = DIFFERS) -> Manifest:
    """Add fragments that the manifest does not hold yet; a repeat changes nothing.

    What comes has to fit: fragments that lack cells, overlap or leave holes are
    errors, as on creation.  Coordinates move with the axes, and attributes
    merge, those of the manifest first.
    """
    added = unknown_fragments(manifest, arrived)
    inventory = scan_inventory(added)
    if inventory.n_frags == 0:
        return manifest
    require_cells(added, inventory)
    names = [d.dim for d in manifest.dims]
    merged = merge_inventories([manifest.inventory, inventory.wide], names, set(manifest.coord_dims))
    placed = place(merged)
    require_full(merged, placed)
    dims = tuple(replace(d, dtype=manifest.dim(d.dim).dtype) for d in placed.dims)
    coords = None
    if manifest.coords is not None:
        moving = [d.dim for d in dims if d.f_size > 1]
        mine = infer.place_fragments(inventory.wide, placed.dim_frags, merged.classes, inventory.n_frags)
        fresh = infer.concat_axis(added, mine, inventory.n_frags, moving)
        along = {d.dim: d.f_size for d in dims if d.kind != "pure"}
        coords = infer.move_axis(_union([manifest.coords.drop("idx"), fresh.drop("idx")]), placed.dim_frags, along)
    attrs = manifest.attrs
    if attrs is not None and added.attrs is not None:
        later = lookup_join(added.attrs, inventory.wide.select("frag_id"), ["frag_id"], inventory.n_frags, ["attr"], how="left_semi")
        each = [attrs.select("scope", "owner", "attr", "value", F.lit(0).cast("long").alias("file_ord")), inv.merge_attrs(later, differs).select("scope", "owner", "attr", "value", F.lit(1).cast("long").alias("file_ord"))]
        attrs = inv.merge_attrs(_union(each), differs).drop("warning")
    kept = [c for c in manifest.frags.columns if c.startswith("unique_")]
    frags = placed.frags
    if kept:
        frags = lookup_join(frags, manifest.frags.select("frag_id", *kept), ["frag_id"], manifest.n_frags, ["frag_id"], "left")
    return replace(
        manifest, dims=dims, inventory=merged.wide, dim_frags=placed.dim_frags, frags=frags, coords=coords, attrs=attrs, n_frags=merged.n_frags,
    )
