"""Queries of the create path: scan, check, infer, write and merge."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import raise_conventions
from ..model import Manifest
from ..operators import infer, inventory as inv, merge
from ..session import literal, scratch_path
from ..sources.parquet import header_inventory, open_fragments, scan_headers, write_fragments
from . import cubes
from .cubes import table, with_sql
from .dataset import describe
from .manifest import Placement, build_manifest, place, read_manifest, scan_inventory, store_inventory, variable_rows, write_manifest
from .registry import query


def _stored(spark: SparkSession, sf_dir: str, name: str, number: int = 0) -> str:
    """Write one block of a cube as fragment files in the shared folder."""
    path = scratch_path(spark, name)
    write_fragments(getattr(cubes, name)(spark, sf_dir).blocks[number], path)
    return path


def _quick(spark: SparkSession, sf_dir: str, name: str) -> Manifest:
    return build_manifest(getattr(cubes, name)(spark, sf_dir), with_coords=False, check_values=False, check_cells=False)


# -- A1 to A9: scans and checks ----------------------------------------------


@query(
    "fragment_scan",
    with_sql("e1") + """
select frag_id, count(*) as n_cells, round(sum(value), 4) as total, min(event) as first_event, max(event) as last_event
from e1 group by frag_id""",
)
def fragment_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    block = open_fragments(spark, _stored(spark, sf_dir, "e1") + "/frag_id=*", ["value"])
    return block.cells.groupBy("frag_id").agg(
        F.count("*").alias("n_cells"), F.round(F.sum("value"), 4).alias("total"),
        F.min("c_event").alias("first_event"), F.max("c_event").alias("last_event"),
    )


@query(
    "version_padding",
    """
select page_id, url as v0, case when page_id % 3 >= 1 then 'cache/' || page_id || '.html' end as v1,
       case when page_id % 3 >= 2 then 'mirror/' || page_id || '.html' end as v2,
       (select max(page_id % 3) + 1 from pages) as n_slots
from pages""",
)
def version_padding(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.concat(F.col("page_id").cast("string"), F.lit(".html"))
    versions = F.array(F.col("url"), F.concat(F.lit("cache/"), name), F.concat(F.lit("mirror/"), name))
    files = table(spark, sf_dir, "pages").select(
        "page_id", F.slice(versions, F.lit(1), (F.pmod("page_id", F.lit(3)) + 1).cast("int")).alias("uris")
    )
    return inv.pad_versions(files).select(
        "page_id", *[F.get("uris", F.lit(i)).alias(f"v{i}") for i in range(3)],
        F.size("uris").cast("long").alias("n_slots"),
    )


@query(
    "dim_inventory",
    with_sql("ev", "em") + """
select frag_id, 'day' as dim, 'coord' as kind, max(day) - min(day) + 1 as size, min(day_c)::double as start,
       max(day_c)::double as stop, null::varchar as start_s, null::varchar as stop_s from ev_f group by frag_id
union all select frag_id, 'bucket', 'coord', max(bucket) - min(bucket) + 1, min(bucket)::double, max(bucket)::double, null, null
from ev_f group by frag_id
union all select frag_id, 'kind', 'coord', max(kind) + 1, null, null, min(kind_c), max(kind_c) from ev_f group by frag_id
union all select 'ep_' || b_vec, 'vec', 'coord', max(vec) - min(vec) + 1, min(vec)::double, max(vec)::double, null, null
from em_f group by 1
union all select 'ep_' || b_vec, 'comp', 'pure', max(comp) + 1, null, null, null, null from em_f group by 1""",
)
def dim_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inv.dim_inventory(cubes.ev(spark, sf_dir)).unionByName(inv.dim_inventory(cubes.em_pure(spark, sf_dir)))
    return rows.select("frag_id", "dim", "kind", "size", "start", "stop", "start_s", "stop_s")


@query(
    "var_inventory",
    with_sql("ev") + """
select f.frag_id, v.* from (select distinct frag_id from ev_f) f cross join (values
  ('p', 'double', 'day bucket kind', 'day bucket kind', '-999.0', 'p'),
  ('n', 'bigint', 'day bucket kind', 'day bucket kind', null, 'count'),
  ('w', 'double', 'kind', 'kind', null, 'w'),
  ('base', 'string', '', '', null, 'base')) v(var, dtype, dims, cdims, fill, identifier)""",
)
def var_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inv.var_inventory(cubes.ev(spark, sf_dir)).drop("file_ord", "block_ord")


@query(
    "header_inventory",
    with_sql("em") + """
select distinct frag_id, 'v' as var, 'double' as dtype, 'vec comp' as dims, 'vec comp' as cdims, null::varchar as fill,
       'v' as identifier from em_f""",
)
def headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return header_inventory(scan_headers(spark, _stored(spark, sf_dir, "em")))


def _event_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file per user and day; its variables are the event types in it."""
    day = F.datediff(F.col("ts").cast("date"), F.lit("2024-01-01").cast("date"))
    return table(spark, sf_dir, "events").select(
        F.concat_ws("_", "user_id", day).alias("frag_id"), (F.col("user_id") * 1000 + day).alias("file_ord"),
        F.col("event_type").alias("var"),
    )


@query(
    "check_var_set",
    """
with h as (select distinct user_id || '_' || datediff('day', date '2024-01-01', ts::date) as frag_id,
                  user_id * 1000 + datediff('day', date '2024-01-01', ts::date) as ord, event_type as var from events),
w as (select var from h where ord = (select min(ord) from h)),
f as (select distinct frag_id from h)
select f.frag_id, w.var, 'missing' as problem from f cross join w
where not exists (select 1 from h where h.frag_id = f.frag_id and h.var = w.var)
union all select frag_id, var, 'extra' from h where var not in (select var from w)""",
)
def check_var_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inv.check_var_set(_event_files(spark, sf_dir))


@query(
    "check_dim_set",
    """
with h as (select distinct l_orderkey as frag_id, 'line' || l_linenumber as dim from lineitem),
w as (select dim from h where frag_id = (select min(frag_id) from h)),
f as (select distinct frag_id from h)
select f.frag_id, w.dim, 'missing' as problem from f cross join w
where not exists (select 1 from h where h.frag_id = f.frag_id and h.dim = w.dim)
union all select frag_id, dim, 'extra' from h where dim not in (select dim from w)""",
)
def check_dim_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("frag_id"), F.col("l_orderkey").alias("file_ord"),
        F.concat(F.lit("line"), F.col("l_linenumber").cast("string")).alias("dim"),
    )
    return inv.check_dim_set(files)


@query(
    "check_info_match",
    """
with i as (select o_custkey as item, unnest(['dtype', 'dims', 'fill']) as prop,
                  unnest(['double', o_orderstatus, case when o_custkey % 3 = 0 then 'NaN'
                          when o_custkey % 3 = 1 then null when o_orderpriority = '5-LOW' then '0' end]) as value
           from orders)
select item, prop, count(*) as n_files, min(value) as lowest, max(value) as highest from i
group by item, prop
having count(distinct value) > 1 or (count(value) > 0 and count(value) < count(*))""",
)
def check_info_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file per order describing the item of its customer; fill may be NaN or absent."""
    orders = table(spark, sf_dir, "orders")
    fill = (
        F.when(F.col("o_custkey") % 3 == 0, "NaN")
        .when(F.col("o_custkey") % 3 == 1, None)
        .when(F.col("o_orderpriority") == "5-LOW", "0")
    )
    described = orders.select(
        F.col("o_orderkey").alias("frag_id"), F.col("o_custkey").alias("var"), F.lit("double").alias("dtype"),
        F.col("o_orderstatus").alias("dims"), fill.alias("fill"),
    )
    return inv.check_info_match(inv.info_rows(described))


@query(
    "check_mixed_inputs",
    """
select count(*) filter (url like '%.html') as n_aggregated, count(*) filter (url not like '%.html') as n_plain,
       (count(*) filter (url like '%.html') > 0 and count(*) filter (url not like '%.html') > 0)::int as mixed
from pages""",
)
def check_mixed_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inv.check_mixed_inputs(
        table(spark, sf_dir, "pages").select(F.col("url").endswith(".html").alias("is_aggregated"))
    )


ATTR_SQL = """
a as (select datediff('day', date '2024-01-01', ts::date) as ord, event_type as owner,
             unnest(['source', 'k', 'u' || user_id, '_FillValue']) as attr,
             unnest(['sensor', props, 'user', '-1']) as value from events),
g as (select owner, attr, min(ord) as seen, count(distinct value) as n, min(value) as v from a
      where attr <> '_FillValue' group by owner, attr),
merged as (select 'var' as scope, owner, attr,
                  case when n = 1 and seen = (select min(ord) from a) then v
                       else 'See individual datasets for more information.' end as value,
                  case when seen > (select min(ord) from a) then 'not in the first file' end as warning from g)"""


def _event_attrs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file per day with attributes of each event type."""
    day = F.datediff(F.col("ts").cast("date"), F.lit("2024-01-01").cast("date"))
    pairs = F.map_from_arrays(
        F.array(F.lit("source"), F.lit("k"), F.concat(F.lit("u"), F.col("user_id").cast("string")), F.lit("_FillValue")),
        F.array(F.lit("sensor"), F.col("props"), F.lit("user"), F.lit("-1")),
    )
    return table(spark, sf_dir, "events").select(
        day.cast("string").alias("frag_id"), day.alias("file_ord"), F.lit("var").alias("scope"),
        F.col("event_type").alias("owner"), F.explode(pairs).alias("attr", "value"),
    )


@query("merge_attrs", "with " + ATTR_SQL + " select * from merged")
def merge_attrs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inv.merge_attrs(_event_attrs(spark, sf_dir))


# -- A10 to A19: inference ---------------------------------------------------


@query(
    "classify_dims",
    with_sql("ev", "em") + """
select 'day' as dim, 'coord' as kind, case when count(distinct b_day) > 1 then 'aggregated' else 'coordinate' end as class,
       0 as descending from ev_f
union all select 'bucket', 'coord', case when count(distinct b_bucket) > 1 then 'aggregated' else 'coordinate' end, 0 from ev_f
union all select 'kind', 'coord', 'coordinate', 0 from ev_f having count(*) > 0
union all select 'vec', 'coord', case when count(distinct b_vec) > 1 then 'aggregated' else 'coordinate' end, 0 from em_f
union all select 'comp', 'pure', 'pure', 0 from em having count(*) > 0""",
)
def classify_dims(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inv.dim_inventory(cubes.ev(spark, sf_dir)).unionByName(inv.dim_inventory(cubes.em_pure(spark, sf_dir)))
    return infer.classify_dims(rows).select("dim", "kind", "class", F.col("descending").cast("int").alias("descending"))


@query(
    "check_agg_dims",
    with_sql("ev") + """
, derived as (select 'day' as dim from ev_f having count(distinct b_day) > 1
              union all select 'bucket' from ev_f having count(distinct b_bucket) > 1),
declared(dim) as (values ('day'), ('kind'), ('lat'))
select dim, 'not declared' as problem from derived where dim not in (select dim from declared)
union all select dim, 'not aggregated' from declared where dim not in (select dim from derived)""",
)
def check_agg_dims(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes = infer.classify_dims(inv.dim_inventory(cubes.ev(spark, sf_dir)))
    return infer.check_agg_dims(classes, ["day", "kind", "lat"])


AXIS_SQL = """
select 'day' as dim, b_day as frag_pos, min(day) as "offset", max(day) - min(day) + 1 as size from ev_f group by b_day
union all select 'bucket', b_bucket, min(bucket), max(bucket) - min(bucket) + 1 from ev_f group by b_bucket
union all select 'kind', 0, 0, max(kind) + 1 from ev_f
union all select 'event', b, min(event), count(*) from e1 group by 2"""


@query("arrange_dimension", with_sql("ev", "e1") + AXIS_SQL)
def arrange_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    axes = _quick(spark, sf_dir, "ev").dim_frags.unionByName(_quick(spark, sf_dir, "e1").dim_frags)
    return axes.select("dim", "frag_pos", "offset", "size")


@query(
    "concat_axis",
    with_sql("ev", "e1") + """
select distinct 'day' as dim, day as idx, day_c::double as value, null::varchar as value_s from ev
union all select distinct 'bucket', bucket, bucket::double, null from ev
union all select distinct 'kind', kind, null, kind_c from ev
union all select 'event', event, event::double, null from e1""",
)
def concat_axis(spark: SparkSession, sf_dir: str) -> DataFrame:
    coords = [build_manifest(cube(spark, sf_dir)).coords for cube in (cubes.ev, cubes.e1)]
    return coords[0].unionByName(coords[1]).select("dim", "idx", "value", "value_s")


@query(
    "classify_vars",
    with_sql("ev", "li") + """
select v.*, (select count(distinct frag_id) from ev_f) as n_files from (values
  ('p', 'day bucket kind', 'aggregated', 'day bucket'), ('n', 'day bucket kind', 'aggregated', 'day bucket'),
  ('w', 'kind', 'identical', ''), ('base', '', 'scalar', '')) v(var, dims, class, adims)
union all select v.*, (select count(distinct frag_id) from li_f) from (values
  ('q', 'month sup line', 'aggregated', 'month sup'), ('r', 'month', 'aggregated', 'month'),
  ('u', 'sup', 'aggregated', 'sup'), ('lw', 'line', 'identical', '')) v(var, dims, class, adims)""",
)
def classify_vars(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = None
    for cube in (cubes.ev, cubes.li):
        fragments = cube(spark, sf_dir)
        classes = infer.classify_dims(inv.dim_inventory(fragments)).filter("aggregated").orderBy("dim_ord")
        moving = [r["dim"] for r in classes.collect()]
        part = infer.classify_vars(inv.var_inventory(fragments), moving).select(
            "var", "dims", "class", F.concat_ws(" ", "adims").alias("adims"), "n_files"
        )
        out = part if out is None else out.unionByName(part)
    return out


@query(
    "check_identical_vars",
    """
with v as (select unnest(['discount', 'parity']) as var, l_partkey as idx,
                  unnest([l_discount, (l_partkey % 2)::double]) as value from lineitem)
select var, idx, count(*) as n_files, min(value) as value, (count(distinct value) = 1)::int as same
from v group by var, idx""",
)
def check_identical_vars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order line states two values of its part; one of them never varies."""
    values = table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("idx"),
        F.explode(
            F.create_map(F.lit("discount"), "l_discount", F.lit("parity"), F.pmod("l_partkey", F.lit(2)).cast("double"))
        ).alias("var", "value"),
    )
    return infer.check_identical(values, ["var", "idx"]).withColumn("same", F.col("same").cast("int"))


@query(
    "dim_combinations",
    with_sql("li") + """
select v.dims, v.opt_id from (values ('month sup line', 0), ('month', 1), ('sup', 2)) v(dims, opt_id)
where (select count(distinct frag_id) from li_f) > 1""",
)
def dim_combinations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return infer.dim_combinations(_quick(spark, sf_dir, "li").vars)


@query(
    "fragment_space",
    with_sql("ev", "e1", "li") + """
select 'day' as dim, count(distinct b_day) as f_size, max(day) + 1 as size from ev_f
union all select 'bucket', count(distinct b_bucket), max(bucket) + 1 from ev_f
union all select 'kind', 1, max(kind) + 1 from ev_f
union all select 'event', count(distinct b), max(event) + 1 from e1
union all select 'month', count(distinct b_month), max(month) + 1 from li_f
union all select 'sup', count(distinct b_sup), max(sup) + 1 from li_f
union all select 'line', 1, max(line) + 1 from li_f""",
)
def fragment_space(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [_quick(spark, sf_dir, n).dim_frags for n in ("ev", "e1", "li")]
    return infer.fragment_space(parts[0].unionByName(parts[1]).unionByName(parts[2]))


SPARSE_SQL = """
with s as (select l_suppkey % 1000 as sup, l_partkey % 50 as prt, l_linenumber::bigint as line, min(l_orderkey) as ord from lineitem group by 1, 2, 3),
f as (select sup || '_' || prt || '_' || line as frag_id, dense_rank() over (order by sup) - 1 as f_sup,
             dense_rank() over (order by prt) - 1 as f_prt, dense_rank() over (order by line) - 1 as f_line from s),
g as (select * from (select unnest(range(0, (select max(f_sup) + 1 from f))) as f_sup)
      cross join (select unnest(range(0, (select max(f_prt) + 1 from f))) as f_prt)
      cross join (select unnest(range(0, (select max(f_line) + 1 from f))) as f_line)),
held as (select g.*, f.frag_id from g left join f using (f_sup, f_prt, f_line))"""

SPARSE_DIMS = ["sup", "prt", "line"]


def _sparse(spark: SparkSession, sf_dir: str) -> tuple[Placement, dict[str, int]]:
    """A file per supplier group, part group and line; combinations without a line item are holes."""
    items = table(spark, sf_dir, "lineitem")
    keys = {"sup": F.pmod("l_suppkey", F.lit(1000)), "prt": F.pmod("l_partkey", F.lit(50)), "line": F.col("l_linenumber").cast("long")}
    files = items.groupBy(*[k.alias(d) for d, k in keys.items()]).agg(F.min("l_orderkey").alias("file_ord"))
    cols = []
    for dim in SPARSE_DIMS:
        start = F.col(dim).cast("double")
        text = F.lit(None).cast("string")
        cols += [F.lit(1).cast("long").alias(f"size_{dim}"), start.alias(f"start_{dim}"), start.alias(f"stop_{dim}")]
        cols += [text.alias(f"start_s_{dim}"), text.alias(f"stop_s_{dim}")]
    wide = files.select(F.concat_ws("_", *SPARSE_DIMS).alias("frag_id"), "file_ord", *cols)
    placed = place(store_inventory(wide, SPARSE_DIMS, set(SPARSE_DIMS)))
    return placed, {d.dim: d.f_size for d in placed.dims}


@query(
    "assemble_locations",
    SPARSE_SQL + " select f_sup, f_prt, f_line, frag_id, count(frag_id) as n_files from held group by all",
)
def assemble_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed, space = _sparse(spark, sf_dir)
    return infer.assemble_locations(placed.frags, SPARSE_DIMS, space).drop("_lin")


@query(
    "assemble_projected",
    with_sql("li") + """
, f as (select distinct frag_id, b_month, b_sup, ('0x' || substr(md5(frag_id), 1, 15))::bigint as ord from li_f)
select 'month' as dims, b_month as pos, arg_min(frag_id, ord) as frag_id from f group by b_month
union all select 'sup', b_sup, arg_min(frag_id, ord) from f group by b_sup""",
)
def assemble_projected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Location grids of variables that lack one of the aggregated dimensions."""
    frags = _quick(spark, sf_dir, "li").frags
    out = [
        infer.project_grid(frags, [d]).select(F.lit(d).alias("dims"), F.col(f"f_{d}").alias("pos"), "frag_id")
        for d in ("month", "sup")
    ]
    return out[0].unionByName(out[1])


@query(
    "fragment_map",
    with_sql("ev") + """
, m as (select 0 as dim_ord, b_day as col, max(day) - min(day) + 1 as size from ev_f group by b_day
        union all select 1, b_bucket, max(bucket) - min(bucket) + 1 from ev_f group by b_bucket
        union all select 2, 0, max(kind) + 1 from ev_f),
w as (select unnest(range(0, (select max(col) + 1 from m))) as col),
d(dim_ord, dim) as (values (0, 'day'), (1, 'bucket'), (2, 'kind'))
select d.dim_ord, d.dim, w.col, m.size from d cross join w left join m on m.dim_ord = d.dim_ord and m.col = w.col""",
)
def fragment_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = _quick(spark, sf_dir, "ev")
    return infer.fragment_map(manifest.dim_frags, ["day", "bucket", "kind"], {d.dim: d.f_size for d in manifest.dims})


# -- A20 to A24: attributes, description, validation -------------------------

UPDATES = {"title": "alpha", "scratch": "not removed", "click.k": "edited", "view.units": "1", "nothing.units": "K"}
REMOVALS = ["scratch", "click.source", "absent"]

UPDATE_SQL = ATTR_SQL + """,
base as (select scope, owner, attr, value from merged union all select 'global', '', 'source', max(lang) from documents),
upd(scope, owner, attr, value) as (values ('global', '', 'title', 'alpha'), ('global', '', 'scratch', 'not removed'),
  ('var', 'click', 'k', 'edited'), ('var', 'view', 'units', '1')),
edited as (select b.* from base b where not exists
             (select 1 from upd u where u.scope = b.scope and u.owner = b.owner and u.attr = b.attr)
           union all select * from upd)"""


def _all_attrs(spark: SparkSession, sf_dir: str) -> DataFrame:
    merged = inv.merge_attrs(_event_attrs(spark, sf_dir)).drop("warning")
    own = table(spark, sf_dir, "documents").agg(F.max("lang").alias("value")).select(
        F.lit("global").alias("scope"), F.lit("").alias("owner"), F.lit("source").alias("attr"), "value"
    )
    return merged.unionByName(own)


@query("apply_updates", "with " + UPDATE_SQL + " select * from edited")
def apply_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return infer.apply_updates(_all_attrs(spark, sf_dir), UPDATES)[0]


@query(
    "apply_removals",
    "with " + UPDATE_SQL + """
select * from edited where not (owner = '' and attr in ('scratch', 'absent')) and not (owner = 'click' and attr = 'source')""",
)
def apply_removals(spark: SparkSession, sf_dir: str) -> DataFrame:
    edited, _ = infer.apply_updates(_all_attrs(spark, sf_dir), UPDATES)
    return infer.apply_removals(edited, REMOVALS)[0].select("scope", "owner", "attr", "value")


@query(
    "merge_conventions",
    """
select p_partkey, case p_partkey % 5
    when 0 then 'CF-1.' || greatest(12, p_size)
    when 1 then 'ACDD-1.3,CF-1.' || greatest(12, p_size)
    when 2 then 'CF-1.' || greatest(12, p_size) || ' ACDD-1.3'
    when 3 then p_brand
    else 'CF-1.12, ACDD-1.' || p_size end as conventions
from part""",
)
def merge_conventions(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind, size = F.col("p_partkey") % 5, F.col("p_size").cast("string")
    text = (
        F.when(kind == 0, F.concat(F.lit("CF-1."), size))
        .when(kind == 1, F.concat(F.lit("ACDD-1.3,CF-1."), size))
        .when(kind == 2, F.concat(F.lit("CF-1."), size, F.lit(" ACDD-1.3")))
        .when(kind == 3, F.col("p_brand"))
        .otherwise(F.concat(F.lit("CF-1.6, ACDD-1."), size))
    )
    return table(spark, sf_dir, "part").select("p_partkey", raise_conventions(text).alias("conventions"))


@query(
    "describe",
    with_sql("ev") + """
select 'dim' as section, d.item, d.property, d.value from (
  select 'day' as item, unnest(['kind', 'size', 'f_size', 'dtype']) as property,
         unnest(['coord', (max(day) + 1)::varchar, count(distinct b_day)::varchar, 'bigint']) as value from ev_f
  union all select 'bucket', unnest(['kind', 'size', 'f_size', 'dtype']),
         unnest(['coord', (max(bucket) + 1)::varchar, count(distinct b_bucket)::varchar, 'bigint']) from ev_f
  union all select 'kind', unnest(['kind', 'size', 'f_size', 'dtype']), unnest(['coord', (max(kind) + 1)::varchar, '1', 'string']) from ev_f) d
union all select 'var', v.* from (values
  ('p', 'dtype', 'double'), ('p', 'dims', 'day bucket kind'), ('p', 'class', 'aggregated'), ('p', 'adims', 'day bucket'), ('p', 'fill', '-999.0'),
  ('n', 'dtype', 'bigint'), ('n', 'dims', 'day bucket kind'), ('n', 'class', 'aggregated'), ('n', 'adims', 'day bucket'),
  ('w', 'dtype', 'double'), ('w', 'dims', 'kind'), ('w', 'class', 'identical'), ('w', 'adims', ''),
  ('base', 'dtype', 'string'), ('base', 'dims', ''), ('base', 'class', 'scalar'), ('base', 'adims', '')) v""",
)
def describe_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return describe(_quick(spark, sf_dir, "ev"))


@query(
    "validate_manifest",
    SPARSE_SQL + """
select 'hole' as "check", f_sup || ',' || f_prt || ',' || f_line as item, 1::bigint as expected, 0::bigint as actual
from held where frag_id is null""",
)
def validate_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed, space = _sparse(spark, sf_dir)
    return infer.validate_manifest(placed.dim_frags, placed.frags, space, {d.dim: d.size for d in placed.dims})


# -- S1 to S4: writing and merging -------------------------------------------


@query(
    "write_manifest",
    with_sql("e1") + """
select 'dims' as tbl, 'event' as item, count(*) as number from e1
union all select 'frags', frag_id, min(event) from e1 group by frag_id
union all select 'coords', event::varchar, event from e1
union all select 'vars', unnest(['value', 'user_id', 'ts']), count(distinct frag_id) from e1""",
)
def write_and_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "manifest")
    write_manifest(build_manifest(cubes.e1(spark, sf_dir)), path)
    back = read_manifest(spark, path)
    dims = literal(spark, [("dims", d.dim, d.size) for d in back.dims], "tbl string, item string, number long")
    return (
        dims.unionByName(back.frags.select(F.lit("frags").alias("tbl"), F.col("frag_id").alias("item"), F.col("o_event").alias("number")))
        .unionByName(back.coords.select(
            F.lit("coords").alias("tbl"), F.col("idx").cast("string").alias("item"), F.col("value").cast("long").alias("number")))
        .unionByName(back.vars.select(F.lit("vars").alias("tbl"), F.col("var").alias("item"), F.lit(back.n_frags).cast("long").alias("number")))
    )


FRAGS_SQL = {
    "ev": """
select frag_id, b_day as f_day, min(day) as o_day, max(day) - min(day) + 1 as s_day,
       b_bucket as f_bucket, min(bucket) as o_bucket, max(bucket) - min(bucket) + 1 as s_bucket
from ev_f group by frag_id, b_day, b_bucket""",
    "li": """
select frag_id, b_month as f_month, min(month) as o_month, max(month) - min(month) + 1 as s_month,
       b_sup as f_sup, min(sup) as o_sup, max(sup) - min(sup) + 1 as s_sup
from li_f group by frag_id, b_month, b_sup""",
}


def _placement(manifest: Manifest, dims: list[str]) -> DataFrame:
    return manifest.frags.select("frag_id", *[f"{m}_{d}" for d in dims for m in ("f", "o", "s")])


@query("extend_manifests", with_sql("ev") + FRAGS_SQL["ev"])
def extend_manifests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partial aggregations of every fourth week-block, merged."""
    block = F.pmod(F.substring_index("frag_id", "_", -1).cast("int"), F.lit(4))
    parts = merge.partial_manifests(cubes.ev(spark, sf_dir), block, 4)
    return _placement(merge.extend_manifests(parts), ["day", "bucket"])


@query("batched_create", with_sql("li") + FRAGS_SQL["li"])
def batched_create(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches drawn at random, about the square root of the number of fragments."""
    batch = F.pmod(F.xxhash64("frag_id"), F.lit(3))
    return _placement(merge.batched_create(cubes.li(spark, sf_dir), batch, 3), ["month", "sup"])


@query(
    "incremental_append",
    with_sql("e1") + """
select frag_id, b as f_event, min(event) as o_event, count(*) as s_event from e1 group by 1, 2""",
)
def incremental_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Start from the odd fragments, then let all arrive; those already known are skipped."""
    from dataclasses import replace

    everything = cubes.e1(spark, sf_dir)
    odd = F.pmod(F.substring_index("frag_id", "_", -1).cast("int"), F.lit(2)) == 1
    some = replace(everything, blocks=tuple(replace(b, cells=b.cells.filter(odd)) for b in everything.blocks))
    known = scan_inventory(some)
    at = place(known)
    start = Manifest(at.dims, known.wide, at.dim_frags, at.frags, variable_rows(spark, some, ["event"]), None, None, known.n_frags)
    return _placement(merge.incremental_append(start, everything), ["event"])
