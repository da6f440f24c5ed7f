"""Queries over aggregations opened from what is stored: their manifest, and the locations that it names."""

from __future__ import annotations

import datetime
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.axis import arrange, start_key
from ..model import FragmentSet
from ..operators import infer
from ..operators.array import Variable, open_variable
from ..operators.canonical import canonical_violations, conformed
from ..operators.inventory import coverage_violations
from ..session import literal, materialise, scratch_path
from ..sources.datasource import register
from ..sources.parquet import write_fragments
from . import cubes, snapshots
from .cubes import table, with_sql
from .dataset import Dataset, open_dataset
from .manifest import build_manifest, place, scan_inventory, with_locations, write_manifest
from .queries_create import SPARSE_SQL, _sparse
from .registry import query

# -- B7, B8, B9, B15: open by the manifest alone ------------------------------

#: Fragments of the last block of components are constants: half of their block of vectors.
BY_MANIFEST_SQL = with_sql("em") + """
, given as (select vec, comp, case when b_comp = 2 then b_vec * 0.5 else v end as v from em_f)"""


def by_manifest(spark: SparkSession, sf_dir: str) -> Dataset:
    """Embeddings stored under another column name, each fragment with an absent first version, a third of them constants.

    All that is opened is the manifest: locations are relative to it and need a substitution that it names itself.
    """
    root = scratch_path(spark, "stored")
    fragments = cubes.em(spark, sf_dir)
    block = fragments.blocks[0]
    at: Column = F.split("frag_id", "_")
    constant = at[1] == "2"
    # the same cells under the name that the files use, without the fragments that need no file
    block.cells.filter(~constant).withColumnRenamed("v", "raw").hint("rebalance", "frag_id").write.partitionBy("frag_id").parquet(f"{root}/data")
    attrs = literal(spark, [("all", 0, "global", "", "substitutions", "${up}: ..")], "frag_id string, file_ord long, scope string, owner string, attr string, value string")
    manifest = build_manifest(replace(fragments, identifiers={"v": "raw"}, attrs=attrs))
    names = manifest.frags.select("frag_id")
    here = F.concat(F.lit("${up}/data/frag_id="), "frag_id")
    uris = names.select("frag_id", F.when(~constant, F.array(F.concat(here, F.lit(".old")), here)).alias("uris"))
    values = names.filter(constant).select("frag_id", F.lit("v").alias("var"), (at[2].cast("double") * 0.5).alias("value"))
    write_manifest(with_locations(manifest, uris, values), f"{root}/manifest")
    return open_dataset(spark, f"{root}/manifest")


@query("open_by_manifest", BY_MANIFEST_SQL + "\nselect vec, comp, v from given")
def open_by_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return by_manifest(spark, sf_dir)["v"].to_df()


@query("select_by_manifest", BY_MANIFEST_SQL + "\nselect vec, round(avg(v), 6) as v_mean from given where comp between 20 and 51 and vec % 3 = 0 group by vec")
def select_by_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    picked = by_manifest(spark, sf_dir)["v"].isel(comp=slice(20, 52), vec=slice(0, None, 3))
    return picked.reduce("mean", "comp").withColumn("v_mean", F.round("v_mean", 6))


# -- A1, A4: fragments as a source that Spark plans ---------------------------


def _source(spark: SparkSession, sf_dir: str, **options: str) -> DataFrame:
    """Events by identifier, stored as fragments and read through ``format("fragments")``."""
    register(spark)
    path = scratch_path(spark, "e1 with space")
    write_fragments(cubes.e1(spark, sf_dir).blocks[0], path)
    return spark.read.format("fragments").options(**options).load(path)


@query(
    "fragment_source",
    with_sql("e1") + """
select frag_id, count(*) as n_cells, round(sum(value), 4) as total, min(event) as first_event, max(event) as last_event
from e1 where event >= 700 group by frag_id""",
)
def fragment_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = _source(spark, sf_dir, columns="c_event, value").filter("c_event >= 700")
    return cells.groupBy("frag_id").agg(
        F.count("*").alias("n_cells"), F.round(F.sum("value"), 4).alias("total"),
        F.min("c_event").alias("first_event"), F.max("c_event").alias("last_event"),
    )


@query(
    "fragment_footers",
    with_sql("e1") + """
select frag_id, c.name as "column", c.kind as dtype, count(*) as n_rows from e1,
       (values ('file_ord', 'int64'), ('l_event', 'int64'), ('c_event', 'int64'), ('value', 'double'), ('user_id', 'int64'), ('ts', 'timestamp[us]')) c(name, kind)
group by all""",
)
def fragment_footers(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _source(spark, sf_dir, report="footers")
    frag = F.regexp_extract("path", "frag_id=([^/]+)", 1)
    return rows.groupBy(frag.alias("frag_id"), "column", "dtype").agg(F.sum("n_rows").alias("n_rows"))


# -- A3, A24: every kind of fault is found ------------------------------------

FAULTS_SQL = """
, b as (select b, frag_id, count(*) as n, min(event) as lo from e1 group by all)
select 'cells' as part, frag_id as item, 'hole' as "check", n as expected, n - 1 as actual from b where b % 5 in (1, 2)
union all select 'cells', frag_id, 'double', n - 1, n from b where b % 5 = 2
union all select 'numbers', 'event:' || b, 'overlap', 0, 1 from b where b % 5 = 3
union all select 'text', 'event:' || b, 'overlap', 0, 1 from b where b % 5 = 3"""


@query("validate_faults", with_sql("e1") + FAULTS_SQL)
def validate_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in fragments, some of which lack a cell, hold one twice in place of another, or reach into their neighbour."""
    whole = cubes.e1(spark, sf_dir)
    block = whole.blocks[0]
    kind = F.pmod(F.substring_index("frag_id", "_", -1).cast("int"), F.lit(5))
    broken = block.cells.filter(~((kind == 1) & (F.col("l_event") == 3)))
    broken = broken.withColumn("l_event", F.when((kind == 2) & (F.col("l_event") == 3), F.lit(4)).otherwise(F.col("l_event")))
    found = FragmentSet((replace(block, cells=broken),))
    inventory = scan_inventory(found)
    cells = coverage_violations(found, inventory.wide, inventory.n_frags)
    out = cells.select(F.lit("cells").alias("part"), F.col("frag_id").alias("item"), "check", "expected", "actual")
    shifted = F.when(kind == 3, F.col("c_event") - 1).otherwise(F.col("c_event"))
    for part, value in (("numbers", shifted), ("text", F.lpad(shifted.cast("string"), 12, "0"))):
        moved = FragmentSet((replace(block, cells=block.cells.withColumn("c_event", value)),))
        placed = place(scan_inventory(moved))
        meeting = infer.axis_overlaps(placed.frags, ["event"], set())
        out = out.unionByName(meeting.select(F.lit(part).alias("part"), "item", "check", "expected", "actual"))
    return out


GRID_FAULTS_SQL = SPARSE_SQL + """
, lin as (select distinct (f_sup * (select max(f_prt) + 1 from f) + f_prt) * (select max(f_line) + 1 from f) + f_line as pos from f),
n as (select (select max(f_sup) + 1 from f) as n_sup, (select max(f_prt) + 1 from f) as n_prt, (select max(f_line) + 1 from f) as n_line),
edge as (select pos from lin union all select -1 union all select n_sup * n_prt * n_line from n),
gap as (select pos as low, lead(pos) over (order by pos) as high from edge)
select 'hole' as "check", ((low + 1) // (n_prt * n_line)) || ',' || ((low + 1) // n_line % n_prt) || ',' || ((low + 1) % n_line) as item,
       high - low - 1 as expected, 0::bigint as actual from gap, n where high > low + 1"""


@query("grid_faults", GRID_FAULTS_SQL)
def grid_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stretches of the grid that no file holds, without making the grid."""
    placed, space = _sparse(spark, sf_dir)
    n = placed.frags.count()
    return infer.grid_faults(placed.frags, list(space), space, n, block_rows=max(1, n // 3))


# -- S1, S4: snapshots ---------------------------------------------------------


def _some(whole: FragmentSet, keep: Column) -> FragmentSet:
    return replace(whole, blocks=tuple(replace(b, cells=b.cells.filter(keep)) for b in whole.blocks))


@query(
    "manifest_snapshots",
    with_sql("e1") + """
, f as (select b, frag_id, min(event) as lo, count(*) as n from e1 group by all), m as (select max(b) as last from f)
select 1 as number, frag_id, b as f_event, lo as o_event, n as s_event from f, m where b * 2 <= last
union all select 2, frag_id, b, lo, n from f, m where b < last or b * 2 <= last
union all select 3, frag_id, b, lo, n from f""",
)
def manifest_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events whose later fragments arrive in two appends; every snapshot as it was."""
    whole = cubes.e1(spark, sf_dir)
    path = scratch_path(spark, "snapshots")
    place_of = F.substring_index("frag_id", "_", -1).cast("long")
    last = whole.blocks[0].cells.agg(F.max(place_of)).first()[0]
    create = lambda f: build_manifest(f)
    for keep in (place_of * 2 <= last, (place_of < last) | (place_of * 2 <= last), F.lit(True)):
        snapshots.append(spark, path, _some(whole, keep), create)
    out = None
    for number in snapshots.versions(spark, path):
        frags = snapshots.read_snapshot(spark, path, number).manifest.frags
        part = frags.select(F.lit(number).alias("number"), "frag_id", "f_event", "o_event", "s_event")
        out = part if out is None else out.unionByName(part)
    return out


# -- B16, B17: selections in order, and by label --------------------------------


@query(
    "isel_reversed",
    with_sql("em") + """
, n as (select max(vec) + 1 as n from em), picked as (select unnest([2, 0, 2]) as at, unnest([0, 1, 2]) as comp)
select (n - 1 - em.vec) // 2 as vec, p.comp, em.v from em join picked p on p.at = em.comp, n where (n - 1 - em.vec) % 2 = 0""",
)
def isel_reversed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every second vector from the last on, and a list that names a component twice; columns tell the order."""
    fragments = cubes.em(spark, sf_dir)
    manifest = build_manifest(fragments, with_coords=False, check_values=False, check_cells=False)
    v = open_variable(fragments, manifest, "v")
    return v.isel(vec=slice(None, None, -2), comp=[2, 0, 2]).to_df(numbered=True)


def _revenue(spark: SparkSession, sf_dir: str, axis: str) -> Variable:
    """Revenue of the orders along an axis of dates (``day``) or of text (``name``), in fragments of about a hundred."""
    orders = table(spark, sf_dir, "orders")
    label = F.col("o_orderdate").cast("date") if axis == "day" else F.concat(F.lit("o"), F.lpad(F.col("o_orderkey").cast("string"), 10, "0"))
    sums = materialise(orders.groupBy(label.alias("label")).agg(F.round(F.sum("o_totalprice"), 2).alias("revenue")), "revenue")
    text = F.col("label") if axis == "name" else F.lit(None).cast("string")
    pieces = sums.select(
        F.lit(axis).alias("dim"), start_key("label", "string" if axis == "name" else "date").alias("start"), text.alias("start_s"),
        F.lit(False).alias("descending"), F.lit(1).cast("long").alias("size"), "label", "revenue",
    )
    n = sums.count()
    cube = arrange(pieces, n).select(F.col("frag_pos").alias(f"i_{axis}"), F.col("label").alias(f"c_{axis}"), "revenue")
    fragments = FragmentSet((cubes.cut(cube, "or", (axis,), {axis: cubes.step_of(sums, 100)}, ("revenue",)),))
    return open_variable(fragments, build_manifest(fragments, check_values=False, check_cells=False), "revenue")


REVENUE_SQL = """with r as (select {} as label, round(sum(o_totalprice), 2) as revenue from orders group by 1),
i as (select label, revenue, row_number() over (order by label) - 1 as pos from r)"""
BY_DAY = REVENUE_SQL.format("o_orderdate::date")
BY_NAME = REVENUE_SQL.format("'o' || lpad(o_orderkey::varchar, 10, '0')")


@query("sel_dates", BY_DAY + " select pos as day, revenue from i where label between date '1996-02-10' and date '1997-03-01'")
def sel_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _revenue(spark, sf_dir, "day").sel(day=slice(datetime.date(1996, 2, 10), datetime.date(1997, 3, 1))).to_df()


@query("sel_text", BY_NAME + " select pos as name, revenue from i where label >= 'o0000001' and label <= 'o0000004z'")
def sel_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _revenue(spark, sf_dir, "name").sel(name=slice("o0000001", "o0000004z")).to_df()


@query(
    "sel_then_isel",
    BY_DAY + """
, w as (select revenue, row_number() over (order by pos desc) - 1 as back from i where label between date '1996-01-01' and date '1996-12-31')
select back // 3 as day, revenue from w where back % 3 = 0 and back < 90""",
)
def sel_then_isel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A year by its dates, of it every third day from the last one back, of these thirty."""
    year = _revenue(spark, sf_dir, "day").sel(day=slice(datetime.date(1996, 1, 1), datetime.date(1996, 12, 31)))
    return year.isel(day=slice(None, None, -3)).isel(day=slice(0, 30)).to_df(numbered=True)


# -- C1, C2, C3, C5: canonical form while assembling -----------------------------


def _mixed(spark: SparkSession, sf_dir: str) -> tuple[FragmentSet, DataFrame]:
    """Events whose fragments are packed in kelvin, plain in Celsius, or in Fahrenheit with a fill value, and count time in two ways."""
    whole = cubes.e1(spark, sf_dir)
    block = whole.blocks[0]
    b = F.substring_index("frag_id", "_", -1).cast("long")
    value = (
        F.when(b % 3 == 0, F.round(F.col("value") * 100)).when(b % 3 == 1, F.col("value") - 273.15)
        .when(F.col("c_event") % 11 == 0, F.lit(-999.0)).otherwise((F.col("value") - 273.15) * 1.8 + 32)
    )
    second = F.timestamp_diff("MICROSECOND", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"), "ts") / 1e6
    at = F.when(b % 2 == 0, second / 3600).otherwise((second - 14 * 86400) / 86400)
    cells = block.cells.withColumns({"value": value, "at": at})
    files = materialise(block.cells.select("frag_id").distinct(), "files")
    pairs = F.array(*[F.struct(F.lit(o).alias("owner"), F.lit(a).alias("attr"), v.alias("value")) for o, a, v in (
        ("value", "units", F.when(b % 3 == 0, "K").when(b % 3 == 1, "celsius").otherwise("degF")),
        ("value", "scale_factor", F.when(b % 3 == 0, "0.01")), ("value", "_FillValue", F.when(b % 3 == 2, "-999")),
        ("at", "units", F.when(b % 2 == 0, "hours since 2024-01-01").otherwise("days since 2024-01-15 00:00:00")),
    )])
    attrs = files.select("frag_id", F.explode(pairs).alias("p")).select("frag_id", "p.*").filter("value is not null")
    return FragmentSet((replace(block, vars=("value", "at"), cells=cells),)), attrs


def _conformed(spark: SparkSession, sf_dir: str, name: str, units: str) -> DataFrame:
    fragments, attrs = _mixed(spark, sf_dir)
    manifest = build_manifest(fragments, with_coords=False, check_values=False, check_cells=False)
    block = conformed(fragments.blocks[0], name, attrs.filter(F.col("owner") == name), units, manifest.n_frags)
    return open_variable(FragmentSet((block,)), manifest, name).to_df()


@query(
    "open_conformed",
    with_sql("e1") + """
select event, round(case b % 3 when 0 then round(value * 100) * 0.01 when 1 then value when 2 then case when event % 11 <> 0 then value end end, 6) as value from e1""",
)
def open_conformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packing and units of every fragment composed to one map; the variable is in kelvin."""
    return _conformed(spark, sf_dir, "value", "K").select("event", F.round("value", 6).alias("value"))


@query("open_conformed_times", with_sql("e1") + " select event, round(epoch_us(ts) / 1e6)::bigint as second from e1")
def open_conformed_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hours since one epoch and days since another, as seconds since 1970."""
    cells = _conformed(spark, sf_dir, "at", "seconds since 1970-01-01")
    return cells.select("event", F.round("at").cast("long").alias("second"))


@query("canonical_violations", with_sql("e1") + " select distinct frag_id, 'no conversion from days since 2024-01-15 00:00:00 to hours' as problem from e1 where b % 2 = 1 union all select distinct frag_id, 'no conversion from hours since 2024-01-01 to hours' from e1 where b % 2 = 0")
def unfit_fragments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points in time are no lengths of time."""
    _, attrs = _mixed(spark, sf_dir)
    return canonical_violations(attrs.filter("owner = 'at'"), "hours")
