"""Scan a set of fragments: what each holds, and whether they agree."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.axis import key_sql
from ..model import DIFFERS, Block, FragmentError, FragmentSet
from ..session import lookup_join


def pad_versions(files: DataFrame, column: str = "uris") -> DataFrame:
    """Pad every list of locations with NULL to the longest list."""
    longest = files.agg(F.max(F.size(column))).scalar()
    padding = F.array_repeat(F.lit(None).cast("string"), (longest - F.size(column)).cast("int"))
    return files.withColumn(column, F.concat(F.col(column), padding))


def _covering_blocks(fragments: FragmentSet, wanted: list[str]) -> list[tuple[Block, list[str]]]:
    """Fewest blocks that together hold the wanted dimensions."""
    missing, picked = list(wanted), []
    for block in sorted(fragments.blocks, key=lambda b: -len(b.dims)):
        covers = [d for d in block.dims if d in missing]
        if covers:
            picked.append((block, covers))
            missing = [d for d in missing if d not in covers]
    return picked


#: Columns of an inventory for each dimension.
MARKS = {"size": "long", "start": "double", "stop": "double", "start_s": "string", "stop_s": "string"}


def _extent_aggs(block: Block, dims: list[str]) -> list[Column]:
    aggs = []
    for dim in dims:
        aggs.append(f"cast(max(l_{dim}) + 1 as bigint) as size_{dim}")
        if dim not in block.coords:
            continue
        dtype = block.dtype(f"c_{dim}")
        key, mark = (f"c_{dim}", "_s") if dtype == "string" else (key_sql(f"c_{dim}", dtype), "")
        aggs += [f"{fn}_by({key}, l_{dim}) as {m}{mark}_{dim}" for fn, m in (("min", "start"), ("max", "stop"))]
    return [F.expr(a) for a in aggs]


def _whole(block: Block) -> Column:
    """Whether a fragment has as many cells as its box, with the right sum of indices along each dimension."""
    tests = [f"count(1) = {' * '.join(f'cast(max(l_{d}) + 1 as bigint)' for d in block.dims) or '1'}"]
    tests += [f"2 * sum(l_{d}) = count(1) * cast(max(l_{d}) as bigint) and min(l_{d}) = 0" for d in block.dims]
    return F.expr(" and ".join(tests)).alias("whole")


def coverage_violations(fragments: FragmentSet, wide: DataFrame, n_frags: int) -> DataFrame | None:
    """Fragments that do not hold each index of their box once: what is missing (hole) and what repeats (double).

    ``wide`` tells the boxes.  A cell's place in its box is one bit; bitmaps of 32,768
    places combine map-side and their set bits are counted, so an index that stands
    in for another is found, and the cells of a huge fragment are shared by many tasks.
    Only the index columns are read.
    """
    out = None
    for block in fragments.blocks:
        if not block.dims:
            continue
        sizes = wide.selectExpr("frag_id", *[f"size_{d}" for d in block.dims])
        cells = lookup_join(block.cells.select("frag_id", *[f"l_{d}" for d in block.dims]), sizes, ["frag_id"], n_frags, [f"l_{d}" for d in block.dims])
        place = "0L"
        for d in block.dims:
            place = f"({place}) * size_{d} + l_{d}"
        box = " * ".join(f"size_{d}" for d in block.dims)
        # what lies outside the box of the fragment is counted as a cell and sets no bit
        inside = " and ".join(f"l_{d} >= 0 and l_{d} < size_{d}" for d in block.dims)
        placed = cells.selectExpr("frag_id", f"{box} as box", f"if({inside}, {place} + 1, null) as at")
        maps = placed.groupBy("frag_id", F.expr("coalesce(bitmap_bucket_number(at), -1L)").alias("bucket")).agg(
            F.max("box").alias("box"), F.count(F.lit(1)).alias("n"), F.expr("bitmap_construct_agg(bitmap_bit_position(at))").alias("bits"),
        )
        held = maps.groupBy("frag_id").agg(
            F.max("box").alias("box"), F.sum("n").alias("n"), F.sum(F.when(F.col("bucket") >= 0, F.expr("bitmap_count(bits)")).otherwise(0)).alias("places"),
        )
        faults = F.expr(
            "filter(array(if(places < box, struct('hole' as check, box as expected, places as actual), null),"
            " if(n > places, struct('double' as check, places as expected, n as actual), null)), f -> f is not null)"
        )
        part = held.filter("places < box or n > places").select("frag_id", F.lit(" ".join(block.dims)).alias("dims"), F.explode(faults).alias("f")).select("frag_id", "dims", "f.*")
        out = part if out is None else out.unionByName(part)
    return out


def wide_inventory(fragments: FragmentSet, dims: list[str] | None = None) -> DataFrame:
    """One row per fragment: size, first and last coordinate of each dimension.

    The cells are scanned once and reduced map-side, so a fragment with a
    third of all cells costs no more shuffle than any other.  Dimensions left
    out of ``dims`` are not read.
    """
    wanted = dims or fragments.dims
    parts = [
        block.cells.groupBy("frag_id").agg(F.min("file_ord").alias("file_ord"), _whole(block), *_extent_aggs(block, covers))
        for block, covers in _covering_blocks(fragments, wanted)
    ]
    merged = parts[0]
    if len(parts) > 1:
        for part in parts[1:]:
            merged = merged.unionByName(part, allowMissingColumns=True)
        rest = [c for c in merged.columns if c != "frag_id"]
        merged = merged.groupBy("frag_id").agg(*[(F.min(c) if c in ("file_ord", "whole") else F.max(c)).alias(c) for c in rest])
    have = set(merged.columns)
    names = [(f"{mark}_{dim}", kind) for dim in wanted for mark, kind in MARKS.items()]
    return merged.selectExpr(
        "frag_id", "file_ord", "whole", *[n if n in have else f"cast(null as {kind}) as {n}" for n, kind in names]
    )


def long_inventory(wide: DataFrame, dims: list[str], coords: set[str]) -> DataFrame:
    """Fragment x dimension rows of a wide inventory."""
    rows = [
        f"named_struct('dim', '{dim}', 'dim_ord', {order}, 'kind', '{'coord' if dim in coords else 'pure'}', "
        + ", ".join(f"'{m}', {m}_{dim}" for m in MARKS) + ")"
        for order, dim in enumerate(dims)
    ]
    return wide.selectExpr("frag_id", "file_ord", f"inline(array({', '.join(rows)}))")


def dim_inventory(fragments: FragmentSet, dims: list[str] | None = None) -> DataFrame:
    """Fragment x dimension rows: kind, size, first and last value."""
    names = dims or fragments.dims
    return long_inventory(wide_inventory(fragments, names), names, fragments.coords)


def var_inventory(fragments: FragmentSet) -> DataFrame:
    """Fragment x variable rows: dtype, dims, coordinate dims, fill, identifier."""
    rows = None
    for order, block in enumerate(fragments.blocks):
        described = []
        for var in block.vars:
            meta = block.cells.schema[var].metadata
            fill = meta.get("_FillValue")
            described.append(
                F.struct(
                    F.lit(var).alias("var"),
                    F.lit(order).alias("block_ord"),
                    F.lit(block.dtype(var)).alias("dtype"),
                    F.lit(" ".join(block.dims)).alias("dims"),
                    F.lit(" ".join(d for d in block.dims if d in fragments.coords)).alias("cdims"),
                    F.lit(None if fill is None else str(fill)).cast("string").alias("fill"),
                    F.lit(fragments.identifiers.get(var, var)).alias("identifier"),
                )
            )
        part = (
            block.cells.groupBy("frag_id")
            .agg(F.min("file_ord").alias("file_ord"))
            .select("frag_id", "file_ord", F.explode(F.array(*described)).alias("v"))
            .select("frag_id", "file_ord", "v.*")
        )
        rows = part if rows is None else rows.unionByName(part)
    return rows


def name_set_violations(names: DataFrame, column: str) -> DataFrame:
    """Names a file lacks or has too many of, compared with the first file.

    ``names`` holds ``(frag_id, file_ord, <column>)``.  A file's name set is
    as long as its header, never as long as its data.
    """
    sets = names.groupBy("frag_id").agg(
        F.min("file_ord").alias("file_ord"), F.collect_set(column).alias("have")
    )
    first = sets.agg(F.min_by("have", "file_ord")).scalar()
    return (
        sets.withColumn("want", first)
        .select(
            "frag_id",
            F.explode(
                F.concat(
                    F.transform(
                        F.array_except("want", "have"),
                        lambda n: F.struct(n.alias("name"), F.lit("missing").alias("problem")),
                    ),
                    F.transform(
                        F.array_except("have", "want"),
                        lambda n: F.struct(n.alias("name"), F.lit("extra").alias("problem")),
                    ),
                )
            ).alias("v"),
        )
        .select("frag_id", F.col("v.name").alias(column), "v.problem")
    )


def check_var_set(variables: DataFrame) -> DataFrame:
    """Every file must hold the same variables."""
    return name_set_violations(variables, "var")


def check_dim_set(dims: DataFrame) -> DataFrame:
    """Every file must hold the same dimensions."""
    return name_set_violations(dims, "dim")


def info_rows(variables: DataFrame) -> DataFrame:
    """Variable properties as ``(frag_id, item, prop, value)``."""
    props = [
        F.struct(F.lit(p).alias("prop"), F.col(p).cast("string").alias("value")) for p in ("dtype", "dims", "fill")
    ]
    return variables.select(
        "frag_id", F.col("var").alias("item"), F.explode(F.array(*props)).alias("p")
    ).select("frag_id", "item", "p.prop", "p.value")


def all_equal(column: str) -> Column:
    """Aggregate that is true when a column holds one value; NULL equals NULL."""
    lowest, highest = F.min(column), F.max(column)
    nulls = F.count(F.when(F.col(column).isNull(), 1))
    return F.coalesce(((nulls == 0) & (lowest == highest)) | (nulls == F.count("*")), F.lit(False))


def check_info_match(info: DataFrame) -> DataFrame:
    """Properties that differ between files; NaN equals NaN, NULL equals NULL.

    Minimum and maximum combine map-side, unlike a distinct count.
    """
    return (
        info.groupBy("item", "prop")
        .agg(
            F.count("*").alias("n_files"),
            F.min("value").alias("lowest"),
            F.max("value").alias("highest"),
            all_equal("value").alias("agree"),
        )
        .filter(~F.col("agree"))
        .drop("agree")
    )


def check_mixed_inputs(files: DataFrame) -> DataFrame:
    """Inputs are all plain fragments or all aggregations."""
    return files.agg(
        F.count(F.when(F.col("is_aggregated"), 1)).alias("n_aggregated"),
        F.count(F.when(~F.col("is_aggregated"), 1)).alias("n_plain"),
    ).withColumn(
        "mixed", ((F.col("n_aggregated") > 0) & (F.col("n_plain") > 0)).cast("int")
    )


def merge_attrs(attrs: DataFrame, differs: str = DIFFERS) -> DataFrame:
    """One value per attribute over all files.

    ``attrs`` holds ``(frag_id, file_ord, scope, owner, attr, value)``.  Equal
    values stay; values that differ, and attributes first seen after the first
    file, become the message.  Fill values are compared elsewhere.
    """
    first_file = attrs.agg(F.min("file_ord")).scalar()
    grouped = (
        attrs.filter(F.col("attr") != "_FillValue")
        .groupBy("scope", "owner", "attr")
        .agg(
            F.min("file_ord").alias("_seen"),
            all_equal("value").alias("_same"),
            F.min("value").alias("_value"),
        )
    )
    late = F.col("_seen") > first_file
    return grouped.select(
        "scope", "owner", "attr",
        F.when(F.col("_same") & ~late, F.col("_value")).otherwise(F.lit(differs)).alias("value"),
        F.when(late, "not in the first file").alias("warning"),
    )


def require_none(violations: DataFrame, what: str) -> None:
    """Raise when a check returned rows; shows a few of them."""
    shown = violations.take(5)
    if shown:
        raise FragmentError(f"{what}: " + "; ".join(str(row.asDict()) for row in shown))
