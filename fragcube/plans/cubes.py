"""Cubes over the tables, and the cutter that turns a cube into fragments.

A cube has whole-array indices ``i_<dim>`` and coordinates ``c_<dim>``.  The
cutter drops the indices, keeps local ones, and gives the files an arbitrary
order, so the engine has to find every placement again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.axis import idiv
from ..model import Block, FragmentSet


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def step_of(whole: DataFrame, least: int) -> int:
    """Rows per fragment: ``least``, fewer where that gives one file.

    The count comes from the file footers.
    """
    n = whole.count()
    return max(1, min(least, -(-n // 2)))


def file_order(frag_id: Column) -> Column:
    """Arbitrary but fixed place of a file in the list of inputs."""
    return F.conv(F.substring(F.md5(frag_id), 1, 15), 16, 10).cast("long")


def cut(
    cube: DataFrame,
    prefix: str,
    dims: tuple[str, ...],
    sizes: dict[str, int],
    variables: tuple[str, ...],
    coords: tuple[str, ...] | None = None,
    held_by: tuple[str, ...] = (),
) -> Block:
    """Cut a cube into fragments of at most ``sizes`` cells per dimension.

    ``held_by`` names grid columns ``b_<dim>`` already present for dimensions
    the block lacks: each such fragment holds a copy.
    """
    coords = dims if coords is None else coords
    blocks = {d: idiv(F.col(f"i_{d}"), sizes[d]) if d in sizes else F.lit(0).cast("long") for d in dims}
    out = cube.withColumns({f"b_{d}": b for d, b in blocks.items()})
    order = [d for d in (*dims, *held_by) if d in sizes]
    frag_id = F.concat_ws("_", F.lit(prefix), *[F.col(f"b_{d}").cast("string") for d in sorted(order)])
    local = [
        (F.pmod(F.col(f"i_{d}"), F.lit(sizes[d])) if d in sizes else F.col(f"i_{d}")).cast("long").alias(f"l_{d}")
        for d in dims
    ]
    cells = out.select(frag_id.alias("frag_id"), *local, *[f"c_{d}" for d in coords], *variables)
    cells = cells.select("frag_id", file_order(F.col("frag_id")).alias("file_ord"), *cells.columns[1:])
    return Block(dims, tuple(d for d in dims if d in coords), variables, cells)


# -- EV: mean value and count of events by day, user bucket and type ---------

EV_DIMS = ("day", "bucket", "kind")
EV_CUT = {"day": 7, "bucket": 4}


def ev_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dense grid: a cell without events is NULL."""
    events = table(spark, sf_dir, "events")
    day0 = F.lit("2024-01-01").cast("date")
    cells = events.groupBy(
        F.datediff(F.col("ts").cast("date"), day0).cast("long").alias("c_day"),
        F.pmod("user_id", F.lit(10)).alias("c_bucket"),
        F.col("event_type").alias("c_kind"),
    ).agg(F.avg("value").alias("p"), F.count("*").alias("n"))
    # one row with the axes: as long as the axes, never as long as the data
    axes = cells.agg(
        F.min("c_day").alias("day0"), F.max("c_day").alias("day1"), F.sort_array(F.collect_set("c_kind")).alias("kinds")
    )
    grid = (
        axes.select("day0", "kinds", F.explode(F.sequence("day0", "day1")).alias("c_day"))
        .select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(9).cast("long"))).alias("c_bucket"))
        .select("*", F.posexplode("kinds").alias("i_kind", "c_kind"))
        .select("c_day", "c_bucket", "c_kind", F.col("i_kind").cast("long").alias("i_kind"),
                (F.col("c_day") - F.col("day0")).alias("i_day"), F.col("c_bucket").alias("i_bucket"))
    )
    return grid.join(cells, ["c_day", "c_bucket", "c_kind"], "left")


def ev(spark: SparkSession, sf_dir: str) -> FragmentSet:
    """EV cut by 7 days and 4 buckets, plus a per-type weight and a scalar in every file."""
    cube = ev_cube(spark, sf_dir)
    block = cut(cube, "ev", EV_DIMS, EV_CUT, ("p", "n"))
    held = block.cells.select("frag_id", "file_ord", "l_kind", "c_kind").distinct()
    weight = Block(
        ("kind",), ("kind",), ("w",), held.withColumn("w", F.length("c_kind").cast("double"))
    )
    scalar = Block(
        (), (), ("base",), held.select("frag_id", "file_ord").distinct().withColumn("base", F.lit("2024-01-01"))
    )
    meta = {"p": {"units": "1", "_FillValue": -999.0}}
    cells = block.cells.withMetadata("p", meta["p"])
    return FragmentSet((Block(block.dims, block.coords, block.vars, cells), weight, scalar), identifiers={"n": "count"})


# -- E1: the events themselves along one axis --------------------------------

def e1(spark: SparkSession, sf_dir: str) -> FragmentSet:
    """Events by identifier, about 1,000 or more to a fragment; grows with the data."""
    events = table(spark, sf_dir, "events")
    size = {"event": step_of(events, 1000)}
    cube = events.select(
        F.col("event_id").alias("i_event"), F.col("event_id").alias("c_event"), "value", "user_id", "ts"
    )
    return FragmentSet((cut(cube, "e1", ("event",), size, ("value", "user_id", "ts")),))


# -- EM: embeddings as a dense matrix ----------------------------------------

EM_DIMS = ("vec", "comp")


def em_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return vectors.select(F.col("vec_id").alias("i_vec"), F.posexplode("embedding").alias("i_comp", "v")).select(
        "i_vec", F.col("i_comp").cast("long").alias("i_comp"),
        F.col("i_vec").alias("c_vec"), F.col("i_comp").cast("long").alias("c_comp"), F.col("v").cast("double").alias("v"),
    )


def em_step(spark: SparkSession, sf_dir: str) -> int:
    return step_of(table(spark, sf_dir, "embeddings"), 128)


def em(spark: SparkSession, sf_dir: str) -> FragmentSet:
    """Embeddings cut along both axes."""
    sizes = {"vec": em_step(spark, sf_dir), "comp": 24}
    return FragmentSet((cut(em_cube(spark, sf_dir), "em", EM_DIMS, sizes, ("v",)),))


def em_pure(spark: SparkSession, sf_dir: str) -> FragmentSet:
    """Embeddings cut by vector only; the component axis has a size and no values."""
    sizes = {"vec": em_step(spark, sf_dir)}
    return FragmentSet((cut(em_cube(spark, sf_dir), "ep", EM_DIMS, sizes, ("v",), coords=("vec",)),))


# -- LI: quantities by month, supplier group and line ------------------------

LI_DIMS = ("month", "sup", "line")
LI_CUT = {"month": 24, "sup": 5}


def month_number(ts: Column) -> Column:
    """Months since January 1995."""
    return ((F.year(ts) - 1995) * 12 + F.month(ts) - 1).cast("long")


def li_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem")
    return items.groupBy(
        month_number(F.col("l_shipdate")).alias("c_month"),
        F.pmod("l_suppkey", F.lit(10)).alias("c_sup"),
        (F.col("l_linenumber") - 1).cast("long").alias("c_line"),
    ).agg(F.sum("l_quantity").alias("q"))


def li_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = li_cells(spark, sf_dir)
    axes = cells.agg(F.min("c_month").alias("m0"), F.max("c_month").alias("m1"), F.max("c_line").alias("n1"))
    zero = F.lit(0).cast("long")
    grid = (
        axes.select("*", F.explode(F.sequence("m0", "m1")).alias("c_month"))
        .select("*", F.explode(F.sequence(zero, F.lit(9).cast("long"))).alias("c_sup"))
        .select("*", F.explode(F.sequence(zero, F.col("n1"))).alias("c_line"))
        .select("c_month", "c_sup", "c_line", (F.col("c_month") - F.col("m0")).alias("i_month"),
                F.col("c_sup").alias("i_sup"), F.col("c_line").alias("i_line"))
    )
    return grid.join(cells, ["c_month", "c_sup", "c_line"], "left")


def li(spark: SparkSession, sf_dir: str) -> FragmentSet:
    """LI cut by 24 months and 5 supplier groups.

    ``r`` (month), ``u`` (supplier group) and ``lw`` (line) use fewer
    dimensions, so files side by side hold copies of them.
    """
    cube = li_cube(spark, sf_dir)
    whole = cut(cube, "li", LI_DIMS, LI_CUT, ("q",))
    by_month = cube.groupBy("i_month", "c_month", idiv(F.col("i_sup"), LI_CUT["sup"]).alias("b_sup")).agg(
        (F.max("c_month") * 0.5).alias("r")
    )
    by_sup = cube.groupBy("i_sup", "c_sup", idiv(F.col("i_month"), LI_CUT["month"]).alias("b_month")).agg(
        (F.max("c_sup") * 2.0).alias("u")
    )
    by_line = cube.groupBy(
        "i_line", "c_line", idiv(F.col("i_month"), LI_CUT["month"]).alias("b_month"),
        idiv(F.col("i_sup"), LI_CUT["sup"]).alias("b_sup"),
    ).agg((F.max("c_line") + 1.0).alias("lw"))
    return FragmentSet((
        whole,
        cut(by_month, "li", ("month",), LI_CUT, ("r",), held_by=("sup",)),
        cut(by_sup, "li", ("sup",), LI_CUT, ("u",), held_by=("month",)),
        cut(by_line, "li", ("line",), LI_CUT, ("lw",), held_by=("month", "sup")),
    ))


# -- the same cubes in SQL, for checking -------------------------------------

#: Whole arrays computed directly, with no fragments in between.
SQL = {
    "ev": """
ev_c as (select datediff('day', date '2024-01-01', ts::date) as day_c, user_id % 10 as bucket, event_type as kind_c,
                avg(value) as p, count(*) as n from events group by 1, 2, 3),
ev_k as (select kind_c, row_number() over (order by kind_c) - 1 as kind from (select distinct kind_c from ev_c)),
ev_d as (select unnest(range((select min(day_c) from ev_c), (select max(day_c) + 1 from ev_c))) as day_c),
ev_b as (select unnest(range(0, 10)) as bucket),
ev as (select d.day_c, d.day_c - (select min(day_c) from ev_c) as day, b.bucket, k.kind, k.kind_c, c.p, c.n
       from ev_d d cross join ev_b b cross join ev_k k
       left join ev_c c on c.day_c = d.day_c and c.bucket = b.bucket and c.kind_c = k.kind_c),
ev_f as (select *, day // 7 as b_day, bucket // 4 as b_bucket,
                'ev_' || (bucket // 4) || '_' || (day // 7) as frag_id from ev)""",
    "e1": """
e1_n as (select least(1000, (count(*) + 1) // 2) as step from events),
e1 as (select event_id as event, value, user_id, ts, event_id // step as b, 'e1_' || (event_id // step) as frag_id
       from events, e1_n)""",
    "em": """
em as (select vec_id as vec, unnest(range(0, len(embedding))) as comp, unnest(embedding)::double as v from embeddings),
em_n as (select least(128, (count(*) + 1) // 2) as step from embeddings),
em_f as (select *, vec // step as b_vec, comp // 24 as b_comp, vec % step as l_vec, comp % 24 as l_comp,
                'em_' || (comp // 24) || '_' || (vec // step) as frag_id from em, em_n)""",
    "li": """
li_c as (select (year(l_shipdate) - 1995) * 12 + month(l_shipdate) - 1 as month_c, l_suppkey % 10 as sup,
                l_linenumber - 1 as line, sum(l_quantity) as q from lineitem group by 1, 2, 3),
li_m as (select unnest(range((select min(month_c) from li_c), (select max(month_c) + 1 from li_c))) as month_c),
li_s as (select unnest(range(0, 10)) as sup),
li_l as (select unnest(range(0, (select max(line) + 1 from li_c))) as line),
li as (select m.month_c, m.month_c - (select min(month_c) from li_c) as month, s.sup, l.line, c.q
       from li_m m cross join li_s s cross join li_l l
       left join li_c c on c.month_c = m.month_c and c.sup = s.sup and c.line = l.line),
li_f as (select *, month // 24 as b_month, sup // 5 as b_sup, 'li_' || (month // 24) || '_' || (sup // 5) as frag_id from li)""",
}


def with_sql(*names: str) -> str:
    """``WITH`` clause that defines some cubes."""
    return "with " + ",".join(SQL[n] for n in names)
