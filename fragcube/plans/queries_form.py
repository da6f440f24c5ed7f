"""Queries that bring fragments to canonical form: packing, units, types, text, times."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import calendars, cf
from ..functions.axis import idiv
from ..functions.units import unit_table
from ..session import compact, lookup_join, materialise
from . import cubes
from .cubes import table, with_sql
from .registry import query


def _cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cubes.e1(spark, sf_dir).blocks[0].cells


def _files(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, int]:
    """One row per fragment with its number, written once and counted."""
    number = F.substring_index("frag_id", "_", -1).cast("long")
    files = materialise(_cells(spark, sf_dir).select("frag_id").distinct().withColumn("b", number), "files")
    count = files.count()
    return compact(files, count), count


def _micros(ts: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), ts)


@query(
    "mask_and_scale",
    with_sql("e1") + """
select event, case when event % 11 = 0 then case when b % 4 = 3 then -999.0 end
       else floor(value * 2) * case when b % 4 = 3 then 1.0 else 0.5 end
            + case when b % 4 = 3 then 0.0 else b end end::double as value
from e1""",
)
def mask_and_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packed integers; the offset differs by fragment, and some fragments carry no packing."""
    files, count = _files(spark, sf_dir)
    packing = F.map_from_arrays(
        F.array(F.lit("_FillValue"), F.lit("scale_factor"), F.lit("add_offset")),
        F.array(F.lit("-999"), F.lit("0.5"), F.col("b").cast("string")),
    )
    attrs = files.filter("b % 4 <> 3").select("frag_id", F.explode(packing).alias("attr", "value"))
    packed = F.when(F.col("c_event") % 11 == 0, F.lit(-999)).otherwise(F.floor(F.col("value") * 2))
    cells = _cells(spark, sf_dir).select("frag_id", F.col("c_event").alias("event"), packed.alias("value"))
    return cf.unpack(cells, "value", attrs, count, [F.col("event")]).select("event", "value")


UNIT_NAMES = ["K", "degC", "degF", "m s-1"]


def _frag_units(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, int]:
    files, count = _files(spark, sf_dir)
    names = F.array(*[F.lit(u) for u in UNIT_NAMES])
    return files.select("frag_id", F.get(names, F.pmod("b", F.lit(4)).cast("int")).alias("units")), count


@query(
    "conform_units",
    with_sql("e1") + """
select event, round(case b % 4 when 0 then value when 1 then value + 273.15
       when 2 then (value - 32) * 5 / 9 + 273.15 end, 6) as value from e1""",
)
def conform_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fragments in kelvin, Celsius, Fahrenheit and, wrongly, a speed, whose cells have no value in kelvin."""
    units, count = _frag_units(spark, sf_dir)
    cells = _cells(spark, sf_dir).select("frag_id", F.col("c_event").alias("event"), "value")
    out = cf.conform_units(cells, "value", units, "K", count, [F.col("event")], strict=False)
    return out.select("event", F.round("value", 6).alias("value"))


#: Spellings of units as the tables have them, with the factor and offset to base units that each must have (fixed values).
SPELLINGS = [
    ("m", 1, 0), ("metre", 1, 0), ("meters", 1, 0), ("km", 1000, 0), ("kilometers", 1000, 0), ("cm", 0.01, 0), ("mm", 0.001, 0), ("um", 1e-6, 0), ("feet", 0.3048, 0), ("inch", 0.0254, 0),
    ("kg", 1, 0), ("g", 0.001, 0), ("grams", 0.001, 0), ("mg", 1e-6, 0), ("t", 1000, 0), ("tonnes", 1000, 0), ("s", 1, 0), ("sec", 1, 0), ("seconds", 1, 0), ("ms", 0.001, 0),
    ("min", 60, 0), ("minutes", 60, 0), ("h", 3600, 0), ("hours", 3600, 0), ("days", 86400, 0), ("K", 1, 0), ("kelvin", 1, 0), ("degC", 1, 273.15), ("celsius", 1, 273.15), ("deg_C", 1, 273.15),
    ("m s-1", 1, 0), ("m/s", 1, 0), ("m s^-1", 1, 0), ("m s**-1", 1, 0), ("m.s-1", 1, 0), ("meters per second", 1, 0), ("knot", 0.5144444444444445, 0), ("Pa", 1, 0), ("hPa", 100, 0), ("mbar", 100, 0),
    ("bar", 100000, 0), ("N m-2", 1, 0), ("kg m-1 s-2", 1, 0), ("kg m-2", 1, 0), ("g cm-2", 10, 0), ("W m-2", 1, 0), ("W/m2", 1, 0), ("J s-1 m-2", 1, 0), ("%", 0.01, 0), ("1", 1, 0),
    ("percent", 0.01, 0), ("ppm", 1e-6, 0), ("mol L-1", 1000, 0), ("degrees_north", 0.017453292519943295, 0), ("furlong", None, None), ("degC m-1", None, None), ("m since", None, None), ("", None, None),
]


@query(
    "unit_spellings",
    "select p_partkey, s.text as units, s.factor, s.zero from part join (values "
    + ", ".join(f"({i}, '{t}', {'null' if f is None else f}::double, {'null' if o is None else o}::double)" for i, (t, f, o) in enumerate(SPELLINGS))
    + f") s(i, text, factor, zero) on p_partkey % {len(SPELLINGS)} = s.i",
)
def unit_spellings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each part has a unit, in one of many spellings, or in none that is known."""
    texts = F.array(*[F.lit(t) for t, _, _ in SPELLINGS])
    parts = table(spark, sf_dir, "part").select("p_partkey", F.get(texts, F.pmod("p_partkey", F.lit(len(SPELLINGS))).cast("int")).alias("units"))
    known = unit_table(parts).select("units", F.round("factor", 18).alias("factor"), F.col("offset").alias("zero"))
    return parts.join(F.broadcast(known), "units").select("p_partkey", "units", "factor", "zero")  # a row per distinct spelling


@query(
    "unit_violations",
    with_sql("e1") + " select distinct frag_id, 'm s-1' as units from e1 where b % 4 = 3",
)
def unit_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cf.unit_violations(_frag_units(spark, sf_dir)[0], "K")


@query(
    "cast_canonical",
    "select event_id as event, 0::bigint as l_member, trunc(value)::bigint as value from events",
)
def cast_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """To a whole number, with a size-1 dimension the files lack."""
    cells = _cells(spark, sf_dir).select("frag_id", "l_event", F.col("c_event").alias("event"), "value")
    return cf.cast_canonical(cells, "value", "long", ["event", "member"]).select("event", "l_member", "value")


@query("concat_characters", "select c_custkey, c_name as text from customer")
def concat_characters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names stored one character to a cell, padded with NUL."""
    padded = F.rpad("c_name", 24, "\u0000")
    cells = table(spark, sf_dir, "customer").select("c_custkey", F.posexplode(F.split(padded, "")).alias("pos", "c"))
    return cf.concat_characters(cells, ["c_custkey"], "pos", "c")


@query("concat_characters_rows", "select doc_id, md5(rtrim(text, chr(0))) as digest, length(text) as n from documents")
def concat_characters_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts whose characters lie in one array per row."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.split("text", "").alias("chars"))
    text = cf.concat_chunk_characters(F.col("chars"))
    return docs.select("doc_id", F.md5(text).alias("digest"), F.length(text).cast("long").alias("n"))


def _time_units(b: Column) -> Column:
    return (
        F.when(b % 3 == 0, "days since 2024-01-01")
        .when(b % 3 == 1, "hours since 2024-01-10 06:00:00")
        .otherwise("seconds since 1999-12-31T23:59:30")
    )


@query(
    "decode_times",
    with_sql("e1") + """
select event, case b % 3
  when 0 then epoch_us(timestamp '2024-01-01') + event * 43200000000
  when 1 then epoch_us(timestamp '2024-01-10 06:00:00') + event * 1800000000
  else epoch_us(timestamp '1999-12-31 23:59:30') + event * 500000 end as us from e1""",
)
def decode_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fragments count from different epochs in different units."""
    files, count = _files(spark, sf_dir)
    units = files.select("frag_id", _time_units(F.col("b")).alias("units"))
    cells = _cells(spark, sf_dir).select("frag_id", F.col("c_event").alias("event"), (F.col("c_event") * 0.5).alias("t"))
    joined = lookup_join(cells, units, ["frag_id"], count, [F.col("event")])
    return joined.select("event", _micros(cf.decode_times(F.col("t"), F.col("units"))).alias("us"))


@query(
    "decode_timedelta",
    """
select event_id as event, (event_id % 1000) * case event_id % 4 when 0 then 1000000 when 1 then 60000000
       when 2 then 3600000000 else 1000 end as us from events""",
)
def decode_timedelta(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = F.array(*[F.lit(u) for u in ("seconds", "minutes", "hour", "milliseconds")])
    unit = F.get(names, F.pmod("event_id", F.lit(4)).cast("int"))
    span = cf.decode_timedelta((F.col("event_id") % 1000).cast("double"), unit)
    zero = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return table(spark, sf_dir, "events").select(F.col("event_id").alias("event"), _micros(zero + span).alias("us"))


@query(
    "decode_calendar",
    """
with d as (select event_id as event, event_id % 365 as doy, event_id // 365 as yr from events)
select event, 'noleap' as calendar, (2000 + yr)::int as y, month(date '2001-01-01' + doy::int)::int as m, day(date '2001-01-01' + doy::int)::int as d from d
union all select event_id, '360_day', (2000 + event_id // 360)::int, (event_id % 360 // 30 + 1)::int, (event_id % 30 + 1)::int from events""",
)
def decode_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    out = [
        calendars.decode(events, "at", F.col("event_id"), F.lit("days since 2000-01-01"), name)
        .select(F.col("event_id").alias("event"), F.lit(name).alias("calendar"), "at.y", "at.m", "at.d")
        for name in ("noleap", "360_day")
    ]
    return out[0].unionByName(out[1])


#: Calendars and epochs that the events count from, and how far they reach in days.
MODEL_CALENDARS = ("360_day", "noleap", "all_leap", "julian", "proleptic_gregorian", "standard")
EPOCHS = ("0001-01-01", "2000-02-28 06:00:00", "1582-10-04T18:00:00Z", "1970-12-30 12:00:00 -06:00")
REACH = 900_000
_LEAP = {
    "noleap": "false", "all_leap": "true", "julian": "y % 4 = 0", "proleptic_gregorian": "y % 4 = 0 and (y % 100 <> 0 or y % 400 = 0)",
    "standard": "y % 4 = 0 and (y <= 1582 or y % 100 <> 0 or y % 400 = 0)",
}


def _day_table() -> str:
    """SQL of all days of some 6,000 years, numbered in their order; nothing but the lengths of months goes in."""
    lengths = "case when m in (4, 6, 9, 11) then 30 when m = 2 then if({leap}, 29, 28) else 31 end"
    parts = [
        f"select '{c}' as calendar, y, m, unnest(range(1, 1 + {'30' if c == '360_day' else lengths.format(leap=_LEAP[c])})) as d "
        "from range(-3000, 4600) a(y), range(1, 13) b(m)"
        for c in MODEL_CALENDARS
    ]
    real = "where not (calendar = 'standard' and y = 1582 and m = 10 and d between 5 and 14)"
    return f"select calendar, y, m, d, row_number() over (partition by calendar order by y, m, d) as n from ({' union all '.join(parts)}) {real}"


@query(
    "decode_calendar_epochs",
    f"""
with days as ({_day_table()}),
epochs(e, y, m, d, us) as (values (0, 1, 1, 1, 0), (1, 2000, 2, 28, 21600000000), (2, 1582, 10, 4, 64800000000), (3, 1970, 12, 30, 64800000000)),
names(c, calendar) as (values {", ".join(f"({i}, '{c}')" for i, c in enumerate(MODEL_CALENDARS))}),
counted as (select event_id as event, event_id % 6 as c, event_id // 6 % 4 as e, (event_id * 7919 % {2 * REACH} - {REACH}) * 4 + event_id % 4 as quarters from events),
placed as (
  select event, calendar, quarters, z.n + (quarters * 21600000000 + us) // 86400000000 as n, (quarters * 21600000000 + us) % 86400000000 as us
  from counted join names using (c) join epochs using (e) join days z using (calendar, y, m, d))
select event, calendar, y::int as y, m::int as m, d::int as d, (((us + 86400000000) % 86400000000))::bigint as us, quarters * 6.0::double as hours
from (select * replace (n - (us < 0)::int as n) from placed) join days using (calendar, n)""",
)
def decode_calendar_epochs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hours since epochs that differ by row, in each calendar, thousands of years to both sides, and back again."""
    pick = lambda values, at: F.get(F.array(*[F.lit(v) for v in values]), at.cast("int"))
    event = F.col("event_id")
    quarters = (F.pmod(event * 7919, F.lit(2 * REACH)) - REACH) * 4 + F.pmod(event, F.lit(4))
    events = table(spark, sf_dir, "events").select(
        event.alias("event"), F.concat(F.lit("hours since "), pick(EPOCHS, F.pmod(idiv(event, 6), F.lit(4)))).alias("units"),
        pick(MODEL_CALENDARS, F.pmod(event, F.lit(6))).alias("calendar"), (quarters * 6.0).alias("hours"),
    )
    out = []
    for name in MODEL_CALENDARS:
        dated = calendars.decode(events.filter(F.col("calendar") == name), "at", F.col("hours"), F.col("units"), name)
        back = calendars.encode(dated, "hours", F.col("at"), F.col("units"), name)
        out.append(back.select("event", "calendar", "at.y", "at.m", "at.d", "at.us", "hours"))
    return reduce(DataFrame.unionByName, out)


@query(
    "set_coords",
    """
with named as (select distinct 'v' || unnest([p_partkey // 2, p_partkey // 3]) as var from part where p_size % 7 = 0)
select 'v' || p_partkey as var, (('v' || p_partkey) in (select var from named))::int as is_coord from part""",
)
def set_coords(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some variables name two others as their coordinates."""
    parts = table(spark, sf_dir, "part")
    label = lambda key: F.concat(F.lit("v"), key.cast("string"))
    variables = parts.select(label(F.col("p_partkey")).alias("var"))
    attrs = parts.filter("p_size % 7 = 0").select(
        F.lit("coordinates").alias("attr"),
        F.concat_ws("  ", label(idiv(F.col("p_partkey"), 2)), label(idiv(F.col("p_partkey"), 3))).alias("value"),
    )
    return cf.set_coords(variables, attrs)
