"""Queries of the read path: decode a manifest, assemble, select and reduce."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import DEFAULT_SUBSTITUTIONS, detect_convention, parse_features, parse_substitutions, substitute_all
from ..model import FragmentSet
from ..operators import array, decode
from ..operators.infer import linear_position
from ..session import scratch_path
from ..sources.parquet import open_fragments, write_fragments
from . import cubes, instructions
from .cubes import table, with_sql
from .manifest import build_manifest
from .queries_create import SPARSE_SQL, _quick, _sparse
from .registry import query

# -- B1, B2: feature lists ---------------------------------------------------

FEATURE_SQL = """
part_vars as (select 'v' || p_partkey as var, p_partkey % 6 as form, (p_partkey % 97)::varchar as k, p_size from part),
texts as (select var, form, k, case form
    when 0 then 'map: m_' || k || ' uris: u_' || k || ' identifiers: i_' || k
    when 1 then 'identifiers: i_' || k || ' map: m_' || k || ' uris: u_' || k
    when 2 then 'unique_values: q_' || k || ' map: m_' || k
    when 3 then 'location: l_' || k || ' file: f_' || k || ' format: g_' || k
    when 4 then 'shape: s_' || k || ' location: l_' || k || ' address: a_' || k
    else 'map: m_' || k end as data from part_vars)"""


def _part_vars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A variable per part, with its feature list in one of several layouts and orders."""
    k = (F.col("p_partkey") % 97).cast("string")
    form = F.col("p_partkey") % 6

    def listed(*pairs: str, gap: str = " ") -> Column:
        parts = []
        for i, pair in enumerate(pairs):
            feature, mark = pair.split()
            parts += [F.lit(f"{gap if i else ''}{feature}: {mark}_"), k]
        return F.concat(*parts)

    data = (
        F.when(form == 0, listed("map m", "uris u", "identifiers i"))
        .when(form == 1, listed("identifiers i", "map m", "uris u", gap="   "))
        .when(form == 2, listed("unique_values q", "map m"))
        .when(form == 3, listed("location l", "file f", "format g"))
        .when(form == 4, listed("shape s", "location l", "address a", gap="\n  "))
        .otherwise(listed("map m"))
    )
    return table(spark, sf_dir, "part").select(
        F.concat(F.lit("v"), F.col("p_partkey").cast("string")).alias("var"), form.alias("form"),
        data.alias("aggregated_data"), "p_partkey", "p_size", "p_type", "p_brand",
    )


@query(
    "parse_features",
    "with " + FEATURE_SQL + """
, parts as (select var, unnest(string_split(data, ' ')) as word, unnest(range(0, len(string_split(data, ' ')))) as i from texts)
select a.var, rtrim(a.word, ':') as feature, b.word as variable
from parts a join parts b on a.var = b.var and b.i = a.i + 1 where a.i % 2 = 0""",
)
def parse_feature_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode.feature_rows(_part_vars(spark, sf_dir))


@query(
    "detect_convention",
    "with " + FEATURE_SQL + """
select var, case when form in (0, 1) then 'primary' when form = 2 then 'secondary' when form = 3 then 'beta'
                 when form = 4 then 'interim' else 'none' end as convention from texts""",
)
def detect_conventions(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = detect_convention(parse_features(F.col("aggregated_data")))
    return _part_vars(spark, sf_dir).select("var", F.coalesce(found, F.lit("none")).alias("convention"))


# -- B3 to B8: fragments and their locations ---------------------------------


@query("fragment_positions", SPARSE_SQL + " select f_sup, f_prt, f_line from g")
def fragment_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, space = _sparse(spark, sf_dir)
    return decode.fragment_positions(spark, space)


@query(
    "fragment_extents",
    with_sql("ev") + """
select b_day as f_day, min(day) as o_day, max(day) - min(day) + 1 as s_day, max(day) + 1 as e_day,
       b_bucket as f_bucket, min(bucket) as o_bucket, max(bucket) - min(bucket) + 1 as s_bucket, max(bucket) + 1 as e_bucket,
       0::bigint as f_kind, 0::bigint as o_kind, max(kind) + 1 as s_kind, max(kind) + 1 as e_kind
from ev_f group by b_day, b_bucket""",
)
def fragment_extents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From the padded map back to the extent of every fragment."""
    from ..operators.infer import fragment_map

    manifest = _quick(spark, sf_dir, "ev")
    space = {d.dim: d.f_size for d in manifest.dims}
    cells = fragment_map(manifest.dim_frags, list(space), space)
    axis = decode.sizes_to_axis(cells, sum(space.values()))
    return decode.fragment_extents(axis, space)


@query(
    "scalar_broadcast",
    """
select page_id, coalesce(case when url like '%.html' then 'own_' || page_id end, 'common_' || (select max(page_id) from pages)) as identifier
from pages""",
)
def scalar_broadcast(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    frags = pages.select(
        "page_id",
        F.when(F.col("url").endswith(".html"), F.concat(F.lit("own_"), F.col("page_id").cast("string"))).alias("identifier"),
    )
    common = pages.agg(F.concat(F.lit("common_"), F.max("page_id").cast("string")).alias("identifier"))
    return decode.broadcast_scalar(frags, common, "identifier")


@query(
    "unique_value_fill",
    with_sql("em") + """
, u as (select b_vec, b_comp, case when (b_vec + b_comp) % 3 = 0 then null else min(vec) + min(comp) end as fv
        from em_f group by b_vec, b_comp)
select vec, comp, fv from em_f join u using (b_vec, b_comp)""",
)
def unique_value_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each fragment is one value, or missing throughout; cells come from the extents alone."""
    frags = _quick(spark, sf_dir, "em").frags
    value = F.when((F.col("f_vec") + F.col("f_comp")) % 3 != 0, F.col("o_vec") + F.col("o_comp"))
    return array.fill_unique(frags.withColumn("fv", value), ["vec", "comp"], "fv")


@query(
    "substitute_locations",
    """
select page_id, replace(url, 'http://', 'https://') as u0, '/data/' || page_id || '.nc' as u1,
       's3://store/' || page_id || '.nc' as u2 from pages""",
)
def substitute_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.concat(F.col("page_id").cast("string"), F.lit(".nc"))
    uris = F.array("url", F.concat(F.lit("file:///data/"), name), F.concat(F.lit("${base}"), name))
    subs = {**DEFAULT_SUBSTITUTIONS, **parse_substitutions("${base}: s3://store/"), "http://": "https://"}
    return table(spark, sf_dir, "pages").select("page_id", substitute_all(uris, subs).alias("u")).select(
        "page_id", *[F.get("u", F.lit(i)).alias(f"u{i}") for i in range(3)]
    )


@query(
    "resolve_location",
    """
select page_id as frag_id, case when page_id % 4 = 0 then 0 when page_id % 4 = 1 then 1 when page_id % 4 = 2 then 2 end as version,
       case page_id % 4 when 0 then url when 1 then '/data/set/cache/' || page_id || '.html'
                        when 2 then '/data/mirror/' || page_id || '.html' end as path
from pages""",
)
def resolve_location(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three versions of each page, of which a different one is the first to exist; pages may share a url, so each has its own listing."""
    pages = table(spark, sf_dir, "pages")
    name = F.concat(F.col("page_id").cast("string"), F.lit(".html"))
    cache, mirror = F.concat(F.lit("cache/"), name), F.concat(F.lit("../mirror/"), name)
    versions = pages.select(F.col("page_id").alias("frag_id"), F.array("url", cache, mirror).alias("uris"))
    absolute = {0: F.col("url"), 1: F.concat(F.lit("/data/set/cache/"), name), 2: F.concat(F.lit("/data/mirror/"), name)}
    first = F.col("page_id") % 4
    present = F.array(*[F.when(first.between(0, v), p) for v, p in absolute.items()])
    listing = pages.select(F.col("page_id").alias("frag_id"), F.explode(present).alias("path")).filter("path is not null")
    return decode.resolve_locations(versions, listing, "/data/set")


@query(
    "decode_instructions",
    with_sql("em") + """
select '/data/' || frag_id as uri, 'v' as identifier, b_vec as f_vec, min(vec) as o_vec, max(vec) - min(vec) + 1 as s_vec,
       b_comp as f_comp, min(comp) as o_comp, max(comp) - min(comp) + 1 as s_comp
from em_f group by frag_id, b_vec, b_comp""",
)
def decode_written_instructions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the placement as map, locations and identifier, and decode it again."""
    fragments = cubes.em(spark, sf_dir)
    ids = fragments.blocks[0].cells.select("frag_id").distinct()
    uris = ids.withColumn("uris", F.array(F.concat(F.lit("file:///data/"), "frag_id")))
    manifest = build_manifest(replace(fragments, uris=uris), with_coords=False)
    decoded = instructions.decode_instructions(instructions.to_instructions(manifest, "v"), "v")
    return decoded.frags.select(F.col("uris")[0].alias("uri"), "identifier", *[f"{m}_{d}" for d in ("vec", "comp") for m in ("f", "o", "s")])


@query(
    "open_unique_values",
    with_sql("em") + """
, u as (select b_vec, b_comp, case when b_vec = b_comp then null else (b_vec * 100 + b_comp)::double end as unique_value
        from em_f group by b_vec, b_comp)
select vec, comp, unique_value from em_f join u using (b_vec, b_comp)""",
)
def open_unique_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fragments given by a map and one value each; the missing value marks empty ones."""
    manifest = _quick(spark, sf_dir, "em")
    space = {d: manifest.dim(d).f_size for d in ("vec", "comp")}
    written = instructions.to_instructions(manifest, "v")
    number = F.when(F.col("f_vec") == F.col("f_comp"), -1.0).otherwise(F.col("f_vec") * 100.0 + F.col("f_comp"))
    values = manifest.frags.select(
        F.lit("fragment_values").alias("name"), linear_position(list(space), space).alias("pos"), number.alias("value")
    )
    variables = written.variables.withColumn("aggregated_data", F.lit("unique_values: fragment_values map: fragment_map_0"))
    decoded = instructions.decode_instructions(replace(written, variables=variables, values=values), "v")
    return instructions.constant_cells(decoded, missing=-1.0)


# -- B9 to B14: variables, attributes, groups --------------------------------


def _declared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Variables of a dataset: a third aggregated, some plain, and the ones holding features."""
    parts = _part_vars(spark, sf_dir)
    agg = F.col("p_size") % 3 == 0
    own = parts.select(
        "var", F.when(agg, "day bucket kind").alias("aggregated_dimensions"), F.when(agg, F.col("aggregated_data")).alias("aggregated_data")
    )
    marks = F.explode(F.array(*[F.lit(m) for m in ("m", "u", "i", "q")]))
    held = parts.select((F.col("p_partkey") % 97).cast("string").alias("k"), marks.alias("mark")).distinct().select(
        F.concat_ws("_", "mark", "k").alias("var"), F.lit(None).cast("string").alias("aggregated_dimensions"),
        F.lit(None).cast("string").alias("aggregated_data"),
    )
    return own.unionByName(held)


LIST_SQL = "with " + FEATURE_SQL + """
, agg as (select t.var, t.data from texts t join part_vars p using (var) where p.p_size % 3 = 0),
hidden as (select distinct unnest(string_split(data, ' ')) as var from agg),
allv as (select var from part_vars union all
         select distinct m || '_' || k from part_vars cross join (values ('m'), ('u'), ('i'), ('q')) x(m))
"""


@query(
    "list_variables",
    LIST_SQL + """
select var, case when var in (select var from hidden) then 'hidden' when var in (select var from agg) then 'aggregated'
                 else 'plain' end as role from allv""",
)
def list_variables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode.list_variables(_declared(spark, sf_dir))


@query("list_variables_raw", LIST_SQL + " select var, 'plain' as role from allv")
def list_variables_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode.list_variables(_declared(spark, sf_dir), decode=False)


@query(
    "open_variable_meta",
    """
with s as (select (max(datediff('day', date '2024-01-01', ts::date)) + 1)::varchar as d, (max(user_id % 10) + 1)::varchar as b from events)
select 'v' || p_partkey as var, 'double' as dtype, case when p_partkey % 2 = 0 then 'day bucket' else 'bucket' end as dims,
       case when p_partkey % 2 = 0 then d || 'x' || b else b end as shape,
       case when p_size % 3 = 0 then p_brand when p_size % 3 = 1 then p_type else '' end as units,
       (case when p_size % 3 = 2 then 0 else 1 end)::bigint as n_attrs
from part cross join s""",
)
def open_variable_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = _part_vars(spark, sf_dir)
    third = F.col("p_size") % 3
    variables = parts.select(
        "var", F.lit("double").alias("dtype"),
        F.when(F.col("p_partkey") % 2 == 0, "day bucket").otherwise("bucket").alias("dims"),
    )
    attrs = parts.select(
        F.col("var").alias("owner"),
        F.explode(
            F.array(
                F.struct(F.lit("units").alias("attr"), F.when(third < 2, F.col("p_type")).alias("value")),
                F.struct(F.lit("aggregated_units").alias("attr"), F.when(third == 0, F.col("p_brand")).alias("value")),
                F.struct(F.lit("aggregated_data").alias("attr"), F.col("aggregated_data").alias("value")),
            )
        ).alias("a"),
    ).select("owner", "a.attr", "a.value").filter("value is not null")
    day = F.datediff(F.col("ts").cast("date"), F.lit("2024-01-01").cast("date"))
    ends = table(spark, sf_dir, "events").agg(F.max(day).alias("day"), F.max(F.col("user_id") % 10).alias("bucket")).first()
    return decode.variable_meta(variables, attrs, {"day": ends["day"] + 1, "bucket": ends["bucket"] + 1})


@query(
    "encoding_meta",
    """
with p as (select 'v' || p_partkey as owner, p_partkey, p_size, p_type from part),
e as (select owner, unnest(['dtype', 'contiguous', 'chunksizes', 'enum', 'source', 'original_shape']) as attr,
             unnest([case when p_size % 5 = 0 then 'int' else 'double' end, (p_size % 2 = 0)::varchar,
                     case when p_size % 2 = 1 then p_size || 'x' || (p_partkey % 8 + 1) end,
                     case when p_size % 5 = 0 then p_type end, 'parts', (p_size * 10) || 'x' || (p_partkey % 8 + 1)]) as value from p)
select 'encoding' as scope, owner, attr, value from e where value is not null""",
)
def encoding_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    size, inner = F.col("p_size"), (F.col("p_partkey") % 8 + 1).cast("string")
    variables = _part_vars(spark, sf_dir).select(
        "var", F.when(size % 5 == 0, "int").otherwise("double").alias("dtype"),
        F.concat_ws("x", (size * 10).cast("string"), inner).alias("shape"),
        F.when(size % 2 == 1, F.concat_ws("x", size.cast("string"), inner)).alias("chunks"),
        F.when(size % 5 == 0, F.col("p_type")).alias("labels"),
    )
    return decode.encoding_rows(variables, "parts")


@query("global_attrs", "select 'doc_' || doc_id as attr, source as value from documents where lang = 'en'")
def global_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    attrs = table(spark, sf_dir, "documents").select(
        F.when(F.col("lang") == "en", "global").otherwise("var").alias("scope"),
        F.concat(F.lit("doc_"), F.col("doc_id").cast("string")).alias("attr"), F.col("source").alias("value"),
    )
    return decode.global_attrs(attrs)


GROUP_SQL = """
with c as (select *, '/r' || n_regionkey as rp, '/r' || n_regionkey || '/n' || n_nationkey as np
           from customer join nation on c_nationkey = n_nationkey),
m as (select '/' as group_path, 0 as depth, 'var' as kind, c_mktsegment as name, count(*)::varchar as value from c group by c_mktsegment
      union all select rp, 1, 'var', c_mktsegment, count(*)::varchar from c where c_custkey % 3 > 0 group by rp, c_mktsegment
      union all select np, 2, 'var', c_mktsegment, count(*)::varchar from c where c_acctbal > 5000 group by np, c_mktsegment
      union all select '/', 0, 'attr', 'seen_' || c_custkey % 20, max(c_custkey)::varchar from c group by 4
      union all select np, 2, 'attr', 'seen_' || c_custkey % 50, max(c_custkey)::varchar from c group by np, 4
      union all select rp, 1, 'dim', 'd_' || c_custkey % 7, count(*)::varchar from c group by rp, 4),
p as (select '/r' || n_regionkey as rp, '/r' || n_regionkey || '/n0' as np from nation where n_nationkey = 0),
v as (select m.*, row_number() over (partition by kind, name order by case when kind = 'attr' then depth else -depth end) as rn
      from m, p where group_path in ('/', p.rp, p.np))
select kind, name, group_path, value from v where rn = 1"""


@query("group_overlay", GROUP_SQL)
def group_overlay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups are regions and the nations in them; what does the first nation see?"""
    nation = table(spark, sf_dir, "nation")
    customers = table(spark, sf_dir, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey", "c_acctbal", "c_mktsegment", F.concat(F.lit("/r"), F.col("n_regionkey").cast("string")).alias("rp"),
        F.concat(F.lit("/r"), F.col("n_regionkey").cast("string"), F.lit("/n"), F.col("n_nationkey").cast("string")).alias("np"),
    )

    def members(path: Column, depth: int, kind: str, name: Column, value: Column, where: Column = F.lit(True)) -> DataFrame:
        return customers.filter(where).groupBy(path.alias("group_path"), name.alias("name")).agg(
            value.cast("string").alias("value")
        ).select("group_path", F.lit(depth).alias("depth"), F.lit(kind).alias("kind"), "name", "value")

    segment, number = F.col("c_mktsegment"), F.col("c_custkey")
    tagged = lambda mark, n: F.concat(F.lit(mark), F.pmod(number, F.lit(n)).cast("string"))
    rows = (
        members(F.lit("/"), 0, "var", segment, F.count("*"))
        .unionByName(members(F.col("rp"), 1, "var", segment, F.count("*"), number % 3 > 0))
        .unionByName(members(F.col("np"), 2, "var", segment, F.count("*"), F.col("c_acctbal") > 5000))
        .unionByName(members(F.lit("/"), 0, "attr", tagged("seen_", 20), F.max(number)))
        .unionByName(members(F.col("np"), 2, "attr", tagged("seen_", 50), F.max(number)))
        .unionByName(members(F.col("rp"), 1, "dim", tagged("d_", 7), F.count("*")))
    )
    region = nation.filter("n_nationkey = 0").first()["n_regionkey"]
    return decode.group_overlay(rows, f"/r{region}/n0")


@query("drop_variables", "select 'v' || p_partkey as var, p_brand from part where p_partkey not in (3, 7, 11)")
def drop_variables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode.drop_variables(_part_vars(spark, sf_dir), ["v3", "v7", "v11", "absent"]).select("var", "p_brand")


# -- B15 to B23: arrays ------------------------------------------------------


def _open(spark: SparkSession, sf_dir: str, cube: str, name: str, coords: bool = False) -> array.Variable:
    fragments = getattr(cubes, cube)(spark, sf_dir)
    return array.open_variable(fragments, build_manifest(fragments, with_coords=coords, check_values=False, check_cells=False), name)


@query("assemble_array", with_sql("em") + " select vec, comp, v from em")
def assemble_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _open(spark, sf_dir, "em", "v").to_df()


@query("assemble_events", with_sql("e1") + " select event, value from e1")
def assemble_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _open(spark, sf_dir, "e1", "value").to_df()


@query("assemble_subset_dims", with_sql("li") + " select month, max(month_c) * 0.5::double as r from li group by month")
def assemble_subset_dims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A variable without the supplier axis: each cell once, though two files hold it."""
    return _open(spark, sf_dir, "li", "r").to_df()


@query(
    "isel",
    with_sql("em") + """
select vec, v from em where comp = (select max(comp) from em) and vec >= 10 and vec < (select max(vec) + 1 from em) - 10 and (vec - 10) % 3 = 0""",
)
def isel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stepped slice with a negative end, and an integer that drops its dimension."""
    return _open(spark, sf_dir, "em", "v").isel(vec=slice(10, -10, 3), comp=-1).to_df()


@query(
    "isel_stored",
    with_sql("e1") + """
select event, value from e1 where event >= (select max(event) + 1 from e1) - 1500""",
)
def isel_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last 1,500 events from stored fragments; files outside the selection are not opened."""
    return _stored_events(spark, sf_dir).isel(event=slice(-1500, None)).to_df()


def _stored_events(spark: SparkSession, sf_dir: str) -> array.Variable:
    path = scratch_path(spark, "e1")
    write_fragments(cubes.e1(spark, sf_dir).blocks[0], path)
    fragments = FragmentSet((open_fragments(spark, path),))
    return array.open_variable(fragments, build_manifest(fragments, with_coords=False, check_cells=False), "value")


@query("sel", with_sql("e1") + " select event, value from e1 where event between 250 and 1749")
def sel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An inclusive coordinate range on stored fragments; the predicate reaches the files."""
    return _stored_events(spark, sf_dir).sel(event=slice(250, 1749)).to_df()


@query(
    "sel_nearest",
    with_sql("ev") + """
select bucket, p from ev where kind_c = 'error' and day_c = (select arg_min(day_c, abs(day_c - 12.4)) from (select distinct day_c from ev))""",
)
def sel_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The day closest to 12.4, and exactly one type."""
    picked = _open(spark, sf_dir, "ev", "p", coords=True).sel(method="nearest", day=12.4).sel(kind="error")
    return picked.to_df().select("bucket", "p")


CHUNKS = {"vec": 50, "comp": 10}


@query(
    "rechunk",
    with_sql("em") + """
select frag_id, l_vec // 50 as k_vec, l_comp // 10 as k_comp, count(*) as n_cells, round(sum(v), 6) as total
from em_f group by 1, 2, 3""",
)
def rechunk(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunks = array.rechunk(cubes.em(spark, sf_dir).blocks[0], CHUNKS)
    return chunks.groupBy("frag_id", "k_vec", "k_comp").agg(
        F.count("*").alias("n_cells"), F.round(F.sum("v"), 6).alias("total")
    )


@query(
    "chunk_rows",
    with_sql("em") + """
select frag_id, l_vec // 50 as k_vec, l_comp // 10 as k_comp,
       count(distinct l_vec) || 'x' || count(distinct l_comp) as shape, count(*) as n_cells,
       arg_min(v, l_vec * 1000 + l_comp) as first_v, arg_max(v, l_vec * 1000 + l_comp) as last_v
from em_f group by 1, 2, 3""",
)
def chunk_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks as rows that hold their values as one array."""
    rows = array.pack_chunks(cubes.em(spark, sf_dir).blocks[0], "v", CHUNKS)
    return rows.select(
        "frag_id", "k_vec", "k_comp", F.array_join(F.col("shape").cast("array<string>"), "x").alias("shape"),
        F.size("data").cast("long").alias("n_cells"), F.get("data", F.lit(0)).alias("first_v"), F.element_at("data", -1).alias("last_v"),
    )


@query("chunk_rows_unpacked", with_sql("em") + " select frag_id, l_vec, l_comp, v from em_f")
def chunk_rows_unpacked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunk rows turned back into cells."""
    rows = array.pack_chunks(cubes.em(spark, sf_dir).blocks[0], "v", CHUNKS)
    return array.unpack_chunks(rows, ["vec", "comp"], "v", CHUNKS)


@query(
    "chunk_extents",
    with_sql("em") + """
select frag_id, l_vec // 50 as k_vec, min(vec) as start_vec, max(vec) + 1 as stop_vec,
       l_comp // 10 as k_comp, min(comp) as start_comp, max(comp) + 1 as stop_comp
from em_f group by 1, 2, 5""",
)
def chunk_extents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return array.chunk_extents(_quick(spark, sf_dir, "em").frags, ["vec", "comp"], CHUNKS)


@query(
    "optimal_chunk_size",
    """
with s as (select p_partkey, (p_partkey + 1) * (p_size + 1) as n from part),
c as (select *, ceil(n * 8 / 512.0) as cnt from s)
select p_partkey, n, cnt::bigint as n_chunks, greatest(round_even(n / pow(2.0, round_even(log2(cnt), 0)), 0)::bigint, 1) as chunk from c""",
)
def optimal_chunk_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One axis per part, of the length its key and size give, in chunks of about 512 bytes."""
    sized = table(spark, sf_dir, "part").select("p_partkey", ((F.col("p_partkey") + 1) * (F.col("p_size") + 1)).alias("n"))
    counted = sized.withColumn("n_chunks", array.chunk_count(F.col("n"), 8, 512).cast("long"))
    return counted.withColumn("chunk", array.optimal_chunk_size(F.col("n"), F.col("n_chunks")))


STATS = ["mean", "sum", "min", "max", "count", "std", "var"]
STAT_SQL = """round(avg({0}), 6) as mean, round(sum({0}), 4) as sum, round(min({0}), 6) as min, round(max({0}), 6) as max,
       count({0}) as count, round(stddev_pop({0}), 6) as std, round(var_pop({0}), 6) as var"""


def _rounded(df: DataFrame, value: str) -> DataFrame:
    keep = [c for c in df.columns if not c.startswith(f"{value}_")]
    cols = []
    for how in STATS:
        col = F.col(f"{value}_{how}")
        cols.append((col if how == "count" else F.round(col, 4 if how == "sum" else 6)).alias(how))
    return df.select(*keep, *cols)


@query("reduce", with_sql("em") + f" select vec, {STAT_SQL.format('v')} from em group by vec")
def reduce_over(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_open(spark, sf_dir, "em", "v").reduce(STATS, "comp"), "v")


@query("reduce_months", with_sql("li") + f" select sup, line, {STAT_SQL.format('q')} from li group by sup, line")
def reduce_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Missing cells are skipped."""
    return _rounded(_open(spark, sf_dir, "li", "q").reduce(STATS, "month"), "q")


@query("reduce_all", with_sql("e1") + f" select {STAT_SQL.format('value')} from e1")
def reduce_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_open(spark, sf_dir, "e1", "value").reduce(STATS), "value")


@query(
    "isel_mean",
    with_sql("ev") + """
select bucket, kind, round(avg(p), 6) as mean_p from ev
where day between 0 and 2 and bucket between 4 and 8 and kind between 1 and 3 group by bucket, kind""",
)
def isel_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: select on three dimensions, then average over time."""
    picked = _open(spark, sf_dir, "ev", "p").isel(day=slice(0, 3), bucket=slice(4, 9), kind=slice(1, 4))
    return picked.reduce("mean", "day").select("bucket", "kind", F.round("p_mean", 6).alias("mean_p"))


@query(
    "reshape",
    with_sql("em") + """
select vec, comp // 8 as hi, comp % 8 as lo, v from em""",
)
def reshape(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Split the component axis in two, row-major."""
    variable = _open(spark, sf_dir, "em", "v")
    n_vec, n_comp = variable.shape
    return array.reshape(variable.to_df(), ["vec", "comp"], [n_vec, n_comp], {"vec": n_vec, "hi": n_comp // 8, "lo": 8})


@query("flatten", with_sql("li") + """
, s as (select max(sup) + 1 as ns, max(line) + 1 as nl from li)
select (month * ns + sup) * nl + line as flat, q from li cross join s""")
def flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One axis for the whole variable, in row-major order."""
    variable = _open(spark, sf_dir, "li", "q")
    shape = list(variable.shape)
    total = shape[0] * shape[1] * shape[2]
    return array.reshape(variable.to_df(), ["month", "sup", "line"], shape, {"flat": total})
