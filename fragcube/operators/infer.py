"""Infer the aggregation from the inventory of the fragments."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.axis import BLOCK_ROWS, arrange, idiv, key_sql
from ..model import Block, DimClass, FragmentError, FragmentSet
from ..session import BROADCAST_ROWS, compact, literal, lookup_join, materialise
from .inventory import all_equal

def classify_dims(inventory: DataFrame) -> DataFrame:
    """Aggregated when files start at different values, else coordinate or pure."""
    moved = (F.min("start") != F.max("start")) | (F.min("start_s") != F.max("start_s"))
    falling = (F.col("stop") < F.col("start")) | (F.col("stop_s") < F.col("start_s"))
    return (
        inventory.groupBy("dim")
        .agg(
            F.min("dim_ord").alias("dim_ord"),
            F.max("kind").alias("kind"),
            F.coalesce(moved, F.lit(False)).alias("aggregated"),
            F.coalesce(F.bool_or(falling), F.lit(False)).alias("descending"),
            F.min("size").alias("smallest"),
            F.max("size").alias("largest"),
        )
        .withColumn("class", F.when(F.col("aggregated"), "aggregated").otherwise(
            F.when(F.col("kind") == "pure", "pure").otherwise("coordinate")))
    )


BOUNDS = ("start", "start_s", "stop", "stop_s")


def class_measures(dims: list[str]) -> list[Column]:
    """What decides about each dimension, as aggregates over a wide inventory."""
    out = ["count(1) as n_frags", "count_if(not whole) as broken"]
    for dim in dims:
        out += [f"max(size_{dim}) as largest_{dim}", f"min(size_{dim}) as smallest_{dim}"]
        out.append(f"count_if(stop_{dim} < start_{dim} or stop_s_{dim} < start_s_{dim}) as falls_{dim}")
        out.append(f"count_if(stop_{dim} > start_{dim} or stop_s_{dim} > start_s_{dim}) as rises_{dim}")
        out += [f"{fn}({m}_{dim}) as {fn}_{m}_{dim}" for fn in ("min", "max") for m in BOUNDS]
    return [F.expr(o) for o in out]


def classes_of(measured: dict, dims: list[str], coords: set[str]) -> list[DimClass]:
    """:func:`classify_dims` from the measures of :func:`class_measures`."""
    out = []
    for order, dim in enumerate(dims):
        if measured[f"falls_{dim}"] and measured[f"rises_{dim}"]:
            raise FragmentError(f"the values of {dim} rise in some fragments and fall in others")
        moves = {m: measured[f"min_{m}_{dim}"] != measured[f"max_{m}_{dim}"] for m in BOUNDS}
        largest = measured[f"largest_{dim}"]
        out.append(DimClass(
            dim, order, "coord" if dim in coords else "pure", moves["start"] or moves["start_s"],
            measured[f"falls_{dim}"] > 0, largest,
            measured[f"smallest_{dim}"] == largest and not moves["stop"] and not moves["stop_s"],
        ))
    return out


def check_agg_dims(classes: DataFrame, declared: list[str]) -> DataFrame:
    """Names declared but not derived, and the other way round."""
    spark = classes.sparkSession
    derived = classes.filter(F.col("aggregated")).select("dim", F.lit(True).alias("_derived"))
    said = literal(spark, [(d, True) for d in declared], "dim string, _declared boolean")
    return (
        derived.join(said, "dim", "full_outer")
        .filter(F.col("_derived").isNull() | F.col("_declared").isNull())
        .select("dim", F.when(F.col("_derived").isNull(), "not aggregated").otherwise("not declared").alias("problem"))
    )


def axis_pieces(wide: DataFrame, classes: list[DimClass]) -> DataFrame:
    """Distinct pieces of each axis; an unfragmented axis is one piece."""
    out = None
    for c in classes:
        if not c.aggregated:
            continue
        part = (
            wide.groupBy(f"start_{c.dim}", f"start_s_{c.dim}")
            .agg(
                F.expr(f"max(size_{c.dim}) as size"),
                F.expr(
                    f"min(size_{c.dim}) = max(size_{c.dim}) and min(stop_{c.dim}) <=> max(stop_{c.dim}) "
                    f"and min(stop_s_{c.dim}) <=> max(stop_s_{c.dim}) as even"
                ),
            )
            .selectExpr(
                f"'{c.dim}' as dim", f"start_{c.dim} as start", f"start_s_{c.dim} as start_s",
                f"{str(c.descending).lower()} as descending", "size", "even",
            )
        )
        out = part if out is None else out.unionByName(part)
    whole = [(c.dim, None, None, False, c.largest, c.even) for c in classes if not c.aggregated]
    if whole:
        one = literal(
            wide.sparkSession, whole, "dim string, start double, start_s string, descending boolean, size long, even boolean"
        )
        out = one if out is None else out.unionByName(one)
    return out


def arrange_dimension(wide: DataFrame, classes: list[DimClass], n_rows: int) -> DataFrame:
    """``dim_frags``: position, offset and size of every piece of every axis."""
    return arrange(axis_pieces(wide, classes), n_rows)


def cells_of(block: Block, frags: DataFrame, n_frags: int) -> DataFrame:
    """Cells of some fragments, read from their files alone.

    Folders named by ``frag_id`` are pruned by the join at run time.  Separate
    files were listed one by one when the set was opened, and are again.
    """
    if block.scan:
        return block.scan(frags, [c for c in block.cells.columns if c != "frag_id"], [])
    if block.reader:
        names = [r["frag_id"] for r in frags.select("frag_id").distinct().collect()]
        return block.reader(names) if names else block.cells.filter(F.lit(False))
    spread = [f"l_{d}" for d in block.dims] or [F.lit(0)]
    # the comparison makes this side a filter in Spark's eyes, so that it prunes folders by it
    wanted = frags.select("frag_id").filter("frag_id >= ''").distinct()
    return lookup_join(block.cells, wanted, ["frag_id"], n_frags, spread, how="left_semi")


def concat_axis(
    fragments: FragmentSet, frags: DataFrame, n_frags: int, agg_dims: list[str],
    dims: list[str] | None = None, one_each: bool = False,
) -> DataFrame:
    """``coords``: the whole coordinate array of each dimension, as rows.

    The offset is added to each cell and one value is kept per index, map-side
    first; fragments side by side supply the same index and merge.  Along the
    only axis of a variable, when no other is aggregated, an index occurs once
    and nothing is shuffled.  With ``one_each`` a single fragment is read per
    piece of an axis, and one for an axis in one piece, instead of all that
    span it.  ``start`` and ``local`` say which piece a value belongs to, so that merged
    manifests can move it.
    """
    out = None
    for dim in dims or [d for d in fragments.dims if d in fragments.coords]:
        block = next(b for b in sorted(fragments.blocks, key=lambda b: len(b.dims)) if dim in b.coords)
        once = block.dims == (dim,) and (one_each or set(agg_dims) <= {dim})
        held = project_grid(frags, [dim]) if one_each else frags
        cells = cells_of(block, held, n_frags) if one_each else block.cells
        values = cells.selectExpr("frag_id", f"l_{dim} as local", f"c_{dim} as low", f"c_{dim} as high")
        pieces = held.selectExpr("frag_id", f"o_{dim} as _o", f"start_{dim} as start", f"start_s_{dim} as start_s")
        if n_frags > BROADCAST_ROWS and not once:
            # the offsets need a shuffle, so send them one row per index and fragment
            values = values.groupBy("frag_id", "local").agg(F.min("low").alias("low"), F.max("high").alias("high"))
        placed = lookup_join(values, pieces, ["frag_id"], n_frags, ["local"])
        if not once:
            placed = placed.groupBy("start", "start_s", "local").agg(
                F.min("_o").alias("_o"), F.min("low").alias("low"), F.max("high").alias("high")
            )
        dtype = block.dtype(f"c_{dim}")
        part = placed.selectExpr(
            f"'{dim}' as dim", "start", "start_s", "local", "_o + local as idx", f"{key_sql('low', dtype)} as value",
            f"{'low' if dtype == 'string' else 'cast(null as string)'} as value_s", "low = high as consistent",
        )
        out = part if out is None else out.unionByName(part)
    return out


def move_axis(coords: DataFrame, dim_frags: DataFrame, space: dict[str, int]) -> DataFrame:
    """Give coordinate rows of several manifests the offsets of the merged axes."""
    out = None
    for dim, count in space.items():
        rows = coords.filter(F.col("dim") == dim)
        if count > 1:
            pieces = dim_frags.filter(F.col("dim") == dim).select(
                F.coalesce(F.col("start").cast("string"), "start_s").alias("_key"), F.col("offset").alias("_o")
            )
            rows = rows.withColumn("_key", F.coalesce(F.col("start").cast("string"), "start_s"))
            rows = lookup_join(rows, pieces, ["_key"], count, [F.col("local")]).drop("_key")
        else:
            rows = rows.withColumn("_o", F.lit(0).cast("long"))
        rows = rows.groupBy("dim", "start", "start_s", "local").agg(
            (F.min("_o") + F.col("local")).alias("idx"), F.min("value").alias("value"), F.min("value_s").alias("value_s"),
            (F.bool_and("consistent") & F.coalesce(F.min("value") == F.max("value"), F.min("value_s") == F.max("value_s"))).alias("consistent"),
        )
        out = rows if out is None else out.unionByName(rows)
    return out


def classify_vars(variables: DataFrame, agg_dims: list[str]) -> DataFrame:
    """Aggregated, identical or scalar, with the aggregated dims of each."""
    agg = F.array(*[F.lit(d) for d in agg_dims]) if agg_dims else F.array().cast("array<string>")
    dims = F.filter(F.split("dims", " "), lambda d: d != "")
    return (
        variables.groupBy("var", "dtype", "dims", "identifier")
        .agg(F.min("block_ord").alias("block_ord"), F.max("fill").alias("fill"), F.count("*").alias("n_files"))
        .withColumn("adims", F.array_intersect(dims, agg))
        .withColumn(
            "class",
            F.when(F.size(dims) == 0, "scalar").when(F.arrays_overlap(dims, agg), "aggregated").otherwise("identical"),
        )
    )


def check_identical(values: DataFrame, keys: list[str], value: str = "value") -> DataFrame:
    """One row per cell of a non-aggregated variable: its value and whether all files agree.

    Every file counts, and a NaN or NULL equals its like.
    """
    return values.groupBy(*keys).agg(
        F.count("*").alias("n_files"), F.min(value).alias("value"), all_equal(value).alias("same")
    )


def dim_combinations(classified: DataFrame) -> DataFrame:
    """Distinct dims of aggregated variables, numbered by first appearance.

    A header lists few variables, so one window over them is enough.
    """
    combos = (
        classified.filter(F.col("class") == "aggregated")
        .groupBy("dims")
        .agg(F.min("block_ord").alias("first_seen"))
    )
    order = Window.partitionBy(F.lit(0)).orderBy("first_seen", "dims")
    return combos.select("dims", (F.row_number().over(order) - 1).cast("int").alias("opt_id"))


def fragment_space(dim_frags: DataFrame) -> DataFrame:
    """Number of fragments and total size per dimension, 1 where not fragmented."""
    return dim_frags.groupBy("dim").agg(F.count("*").alias("f_size"), F.sum("size").alias("size"))


def place_fragments(wide: DataFrame, dim_frags: DataFrame, classes: list[DimClass], n_frags: int) -> DataFrame:
    """``frags``: grid position, offset, size and coordinate range per fragment and dimension.

    An unfragmented dimension needs no join.  The others look their start up in
    ``dim_frags``; null-safe text and number keys are folded into one column.
    ``fits`` is false where fragments that share a piece of an axis differ in its
    size or last value.
    """
    out = wide
    for c in classes:
        if c.aggregated:
            d = c.dim
            pieces = dim_frags.filter(f"dim = '{d}'").selectExpr(
                f"coalesce(cast(start as string), start_s) as _k_{d}",
                f"frag_pos as f_{d}", f"offset as o_{d}", f"even as _even_{d}",
            )
            keyed = out.selectExpr("*", f"coalesce(cast(start_{d} as string), start_s_{d}) as _k_{d}")
            out = lookup_join(keyed, pieces, [f"_k_{d}"], n_frags, ["frag_id"])
    cols, fits = ["frag_id", "file_ord"], ["true"]
    for c in classes:
        d = c.dim
        cols += [f"f_{d}", f"o_{d}"] if c.aggregated else [f"0L as f_{d}", f"0L as o_{d}"]
        cols += [
            f"size_{d} as s_{d}", f"least(start_{d}, stop_{d}) as lo_{d}", f"greatest(start_{d}, stop_{d}) as hi_{d}",
            f"least(start_s_{d}, stop_s_{d}) as lo_s_{d}", f"greatest(start_s_{d}, stop_s_{d}) as hi_s_{d}", f"start_{d}", f"start_s_{d}",
        ]
        fits.append(f"_even_{d}" if c.aggregated else str(c.even).lower())
    if "uris" in wide.columns:
        cols.append("uris")
    return out.selectExpr(*cols, " and ".join(fits) + " as fits")


def measure_grid(frags: DataFrame, dims: list[str]) -> tuple[dict[str, int], dict[str, int], bool]:
    """Fragments and cells per dimension, and whether each position holds one fragment that fits."""
    places = ", ".join(f"f_{d}" for d in dims) or "frag_id"
    row = frags.selectExpr(
        "count(*) as n", f"count(distinct {places}) as positions", "count_if(not fits) as misfits",
        *[f"max(f_{d}) + 1 as f_{d}" for d in dims], *[f"max(o_{d} + s_{d}) as s_{d}" for d in dims],
    ).first()
    space = {d: int(row[f"f_{d}"]) for d in dims}
    sizes = {d: int(row[f"s_{d}"]) for d in dims}
    full = row["n"] == row["positions"] == math.prod(space.values()) and row["misfits"] == 0
    return space, sizes, full


def linear_position(dims: list[str], space: dict[str, int]) -> Column:
    """Row-major number of a grid position."""
    total = F.lit(0).cast("long")
    for dim in dims:
        total = total * F.lit(space[dim]) + F.col(f"f_{dim}")
    return total


def grid(spark: SparkSession, space: dict[str, int], n_tasks: int | None = None) -> DataFrame:
    """Every position of the fragment grid, generated in parallel."""
    total = math.prod(space.values())
    rows = spark.range(0, total, 1, n_tasks) if n_tasks else spark.range(total)
    cols, stride = [], total
    for dim, count in space.items():
        stride //= count
        cols.append(F.pmod(idiv(F.col("id"), stride), F.lit(count)).cast("long").alias(f"f_{dim}"))
    return rows.select(F.col("id").alias("_lin"), *cols)


def project_grid(frags: DataFrame, dims: list[str]) -> DataFrame:
    """The fragment that serves each position of a subset of the dimensions.

    A variable that lacks an aggregated dimension is held alike by several
    fragments; the one listed first is read.
    """
    pos = [f"f_{d}" for d in dims]
    rest = [c for d in dims for c in (f"o_{d}", f"s_{d}", f"lo_{d}", f"hi_{d}", f"lo_s_{d}", f"hi_s_{d}", f"start_{d}", f"start_s_{d}") if c in frags.columns]
    rest += [c for c in frags.columns if c == "uris" or c.startswith("unique_")]
    held = ", ".join(["frag_id", "file_ord", *rest])
    first = frags.groupBy(*pos).agg(F.expr(f"min_by(struct({held}), file_ord) as _f"))
    return first.selectExpr(*pos, "_f.*")


def assemble_locations(frags: DataFrame, dims: list[str], space: dict[str, int]) -> DataFrame:
    """Grid position -> file, with NULL where no file belongs.

    Also counts the files at a position, so that doubles show.
    """
    sub = {d: space[d] for d in dims}
    held = frags.groupBy(linear_position(dims, sub).alias("_lin")).agg(
        F.min_by("frag_id", "file_ord").alias("frag_id"), F.count("*").alias("n_files")
    )
    total = math.prod(sub.values())
    return (
        compact(grid(frags.sparkSession, sub), total)
        .join(held, "_lin", "left")
        .withColumn("n_files", F.coalesce("n_files", F.lit(0)))
    )


def fragment_map(dim_frags: DataFrame, dim_order: list[str], space: dict[str, int]) -> DataFrame:
    """The map as matrix cells ``(dim_ord, col, size)``, NULL where padded.

    Rows stay in long form: an axis may have more fragments than one array
    should carry.
    """
    spark = dim_frags.sparkSession
    widest = max(space[d] for d in dim_order)
    order = F.array(*[F.lit(d) for d in dim_order])
    cells = spark.range(len(dim_order) * widest).select(
        idiv(F.col("id"), widest).cast("int").alias("dim_ord"), F.pmod("id", F.lit(widest)).alias("col")
    ).withColumn("dim", F.get(order, F.col("dim_ord")))
    sizes = dim_frags.select("dim", F.col("frag_pos").alias("col"), "size")
    return cells.join(sizes, ["dim", "col"], "left").select("dim_ord", "dim", "col", "size")


def _edit_rows(spark: SparkSession, edits: dict[str, str | None]) -> DataFrame:
    rows = []
    for key, value in edits.items():
        owner, dot, attr = key.rpartition(".")
        rows.append((owner if dot else "", attr, value))
    return literal(spark, rows, "owner string, attr string, new string")


def split_edits(attrs: DataFrame, edits: dict[str, str | None]) -> tuple[DataFrame, DataFrame]:
    """Edits that name a known item, with its scope, and those that do not.

    Edits are a dictionary on the driver, so they are broadcast and the
    attributes are never shuffled.
    """
    rows = _edit_rows(attrs.sparkSession, edits)
    owners = attrs.join(F.broadcast(rows.select("owner").distinct()), "owner", "left_semi").select("scope", "owner")
    known = rows.join(owners.distinct(), "owner", "left")
    known = known.withColumn("scope", F.when(F.col("owner") == "", F.lit("global")).otherwise(F.col("scope")))
    return known.filter(F.col("scope").isNotNull()).distinct(), known.filter(F.col("scope").isNull())


def apply_updates(attrs: DataFrame, updates: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """Set attributes; ``attr`` is global, ``item.attr`` a variable or dimension.

    Returns the new attributes and the updates whose item is unknown.
    """
    known, unknown = split_edits(attrs, updates)
    keys = ["scope", "owner", "attr"]
    kept = attrs.select(*keys, "value").join(F.broadcast(known.select(*keys)), keys, "left_anti")
    return kept.unionByName(known.select(*keys, F.col("new").alias("value"))), unknown.select("owner", "attr")


def apply_removals(attrs: DataFrame, removals: list[str]) -> tuple[DataFrame, DataFrame]:
    """Drop attributes; returns the rest and the removals that met nothing."""
    gone = _edit_rows(attrs.sparkSession, dict.fromkeys(removals)).select("owner", "attr")
    keys = ["owner", "attr"]
    met = attrs.select(*keys).join(F.broadcast(gone), keys, "left_semi").distinct()
    return attrs.join(F.broadcast(gone), keys, "left_anti"), gone.join(met, keys, "left_anti")


def validate_manifest(dim_frags: DataFrame, frags: DataFrame, space: dict[str, int], sizes: dict[str, int] | None = None) -> DataFrame:
    """Violations: gaps or overlaps on an axis, row sums, holes and doubles in the grid."""
    before = dim_frags.select(
        "dim", (F.col("frag_pos") + 1).alias("frag_pos"), (F.col("offset") + F.col("size")).alias("expected")
    )
    steps = dim_frags.join(before, ["dim", "frag_pos"], "left").withColumn("expected", F.coalesce("expected", F.lit(0)))
    jumps = steps.filter(F.col("expected") != F.col("offset")).select(
        F.when(F.col("offset") > F.col("expected"), "gap").otherwise("overlap").alias("check"),
        F.concat_ws(":", "dim", F.col("frag_pos").cast("string")).alias("item"),
        F.col("expected").cast("long").alias("expected"), F.col("offset").cast("long").alias("actual"),
    )
    out = jumps
    if sizes:
        want = F.create_map(*[x for d, s in sizes.items() for x in (F.lit(d), F.lit(s).cast("long"))])
        sums = fragment_space(dim_frags).withColumn("expected", want[F.col("dim")])
        out = out.unionByName(
            sums.filter(F.col("expected") != F.col("size")).select(
                F.lit("row_sum").alias("check"), F.col("dim").alias("item"), "expected", F.col("size").alias("actual")
            )
        )
    dims = list(space)
    held = assemble_locations(frags, dims, space)
    faulty = held.filter(F.col("n_files") != 1).select(
        F.when(F.col("n_files") == 0, "hole").otherwise("double").alias("check"),
        F.concat_ws(",", *[F.col(f"f_{d}").cast("string") for d in dims]).alias("item"),
        F.lit(1).cast("long").alias("expected"), F.col("n_files").cast("long").alias("actual"),
    )
    return out.unionByName(faulty)


def axis_overlaps(frags: DataFrame, dims: list[str], falling: set[str]) -> DataFrame | None:
    """Neighbours on an axis whose ranges of values meet, be they numbers or text."""
    out = None
    for d in dims:
        pieces = frags.groupBy(F.col(f"f_{d}").alias("at")).agg(*[
            F.expr(f"{fn}({m}_{d}) as {m}") for m, fn in (("lo", "min"), ("hi", "max"), ("lo_s", "min"), ("hi_s", "max"))
        ])
        ahead = pieces.selectExpr("at + 1 as at", *[f"{m} as {m}_before" for m in ("lo", "hi", "lo_s", "hi_s")])
        meet = "hi{0} >= lo{0}_before" if d in falling else "lo{0} <= hi{0}_before"
        part = pieces.join(ahead, "at").filter(f"{meet.format('')} or {meet.format('_s')}").selectExpr(
            "'overlap' as check", f"concat('{d}:', at) as item", "0L as expected", "1L as actual"
        )
        out = part if out is None else out.unionByName(part)
    return out


def grid_faults(frags: DataFrame, dims: list[str], space: dict[str, int], n_frags: int, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Positions held by several fragments, and the stretches of positions that none holds, from the fragments alone.

    Linear positions are sorted in ranges; a stretch is what lies between neighbours,
    the last of one range and the first of the next included, so a million fragments
    on a diagonal cost a million rows and not the grid.  ``item`` is the position, or
    the first of a stretch; ``actual`` how many fragments are there, ``expected`` how many should be.
    """
    held = frags.groupBy(linear_position(dims, space).alias("at")).agg(F.count(F.lit(1)).alias("n"))
    n_blocks = max(1, -(-n_frags // block_rows))
    ranged = held.withColumn("block", F.lit(0))
    if n_blocks > 1:  # borders of ranges are sampled, so they are written down before use
        ranged = materialise(held.repartitionByRange(n_blocks, "at").withColumn("block", F.spark_partition_id()), "positions")
    total = math.prod(space.values())
    inner = Window.partitionBy("block").orderBy("at")
    steps = ranged.select(F.lag("at").over(inner).alias("low"), F.col("at").alias("high")).filter("low is not null")
    ends = ranged.groupBy("block").agg(F.min("at").alias("first"), F.max("at").alias("last"))
    across = Window.partitionBy(F.lit(0)).orderBy("first")  # a row per range
    borders = ends.select(F.coalesce(F.lag("last").over(across), F.lit(-1)).cast("long").alias("low"), F.col("first").alias("high"))
    after = ends.agg(F.coalesce(F.max("last"), F.lit(-1)).cast("long").alias("low")).select("low", F.lit(total).cast("long").alias("high"))
    gaps = steps.unionByName(borders).unionByName(after).filter("high > low + 1")
    holes = gaps.selectExpr("'hole' as check", "low + 1 as at", "high - low - 1 as expected", "0L as actual")
    doubles = held.filter("n > 1").selectExpr("'double' as check", "at", "1L as expected", "n as actual")
    parts, stride = [], total
    for d in dims:
        stride //= space[d]
        parts.append(F.pmod(idiv(F.col("at"), stride), F.lit(space[d])).cast("long").cast("string"))
    return holes.unionByName(doubles).select("check", F.concat_ws(",", *parts).alias("item"), "expected", "actual")


def size_violations(inventory: DataFrame) -> DataFrame:
    """Pieces with one start but several sizes or last values, on any axis."""
    classes = F.broadcast(classify_dims(inventory).select("dim", "aggregated"))  # a row per dimension
    pieces = inventory.join(classes, "dim").groupBy(
        "dim", F.expr("if(aggregated, start, null) as start"), F.expr("if(aggregated, start_s, null) as start_s")
    ).agg(
        F.min("size").alias("smallest"), F.max("size").alias("largest"), F.count("*").alias("n"),
        F.expr("min(stop) <=> max(stop) and min(stop_s) <=> max(stop_s) as even"),
    )
    item = "concat_ws(':', dim, coalesce(start_s, cast(start as string))) as item"
    sizes = pieces.filter("smallest <> largest").selectExpr("'size' as check", item, "smallest as expected", "largest as actual")
    values = pieces.filter("smallest = largest and not even").selectExpr(
        "'values' as check", item, "cast(1 as bigint) as expected", "n as actual"
    )
    return sizes.unionByName(values)


def identical_violations(fragments: FragmentSet, agg_dims: list[str]) -> DataFrame | None:
    """Cells of non-aggregated variables that differ between files; every file counts."""
    out = None
    for block in fragments.blocks:
        if set(block.dims) & set(agg_dims):
            continue
        at = F.concat_ws(",", *[F.col(f"l_{d}").cast("string") for d in block.dims])
        values = block.cells.select(
            at.alias("idx"), F.explode(F.create_map(*[x for v in block.vars for x in (F.lit(v), F.col(v).cast("string"))])).alias("var", "value")
        )
        part = check_identical(values, ["var", "idx"]).filter("not same").select("var", "idx", "n_files")
        out = part if out is None else out.unionByName(part)
    return out
