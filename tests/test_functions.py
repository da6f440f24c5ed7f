"""Text, axis and canonical-form functions."""

import datetime

import pytest
from pyspark.sql import functions as F

from fragcube.functions import calendars, cf, text
from fragcube.functions.axis import bound_key, idiv, start_key
from fragcube.operators import array, decode
from fragcube.plans.registry import QUERIES
from fragcube.session import scratch_root

import __spark_entry__  # noqa: F401  (registers the queries)


def one(spark, col, **values):
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()] or [F.lit(0).alias("_")])
    return df.select(col.alias("r")).first()["r"]


@pytest.mark.parametrize(
    "given, want",
    [("CF-1.6", "CF-1.12"), ("CF-1.10", "CF-1.12"), ("CF-1.13", "CF-1.13"), ("ACDD-1.3,CF-1.8", "ACDD-1.3,CF-1.12"),
     ("CF-1.8 ACDD-1.3", "CF-1.12 ACDD-1.3"), ("ACDD-1.3", "ACDD-1.3")],
)
def test_conventions(spark, given, want):
    assert one(spark, text.raise_conventions(F.lit(given))) == want


def test_features_and_layouts(spark):
    assert one(spark, text.parse_features(F.lit("uris: u  map: m\n identifiers: i"))) == {"uris": "u", "map": "m", "identifiers": "i"}
    cases = {
        "map: a uris: b identifiers: c": "primary", "unique_values: a map: b": "secondary",
        "shape: a location: b address: c": "interim", "location: a file: b format: c": "beta", "map: a uris: b": None,
    }
    for given, want in cases.items():
        assert one(spark, text.detect_convention(text.parse_features(F.lit(given)))) == want


def test_locations(spark):
    assert text.parse_substitutions("${path}: https://host/data/ ${x}: y") == {"${path}": "https://host/data/", "${x}": "y"}
    got = one(spark, text.substitute_all(F.array(F.lit("${path}a.nc"), F.lit("file:///d/b.nc"), F.lit(None).cast("string")), {"${path}": "https://h/", "file:///": "/"}))
    assert got == ["https://h/a.nc", "/d/b.nc", None]
    for given, want in (("a.nc", "/data/set/a.nc"), ("../m/a.nc", "/data/m/a.nc"), ("./a.nc", "/data/set/a.nc"), ("s3://h/a.nc", "s3://h/a.nc"), ("/x/a.nc", "/x/a.nc")):
        assert one(spark, text.resolve_relative(F.lit(given), "/data/set")) == want
    assert one(spark, decode.location_kind(F.lit("../a.nc"))) == "relative"


def test_optimal_chunk_size_rounds_half_to_even(spark):
    import math

    for n in (1, 7, 100, 360, 1000, 4097):
        for count in (1, 2, 3, 5, 6, 11, 23, 100):
            want = max(round(n / 2 ** round(math.log2(count))), 1)
            assert one(spark, array.optimal_chunk_size(F.lit(n), F.lit(count))) == want, (n, count)


def test_mask_and_scale(spark):
    assert one(spark, cf.mask_and_scale(F.lit(-999), F.lit(-999))) is None
    assert one(spark, cf.mask_and_scale(F.lit(float("nan")))) is None
    assert one(spark, cf.mask_and_scale(F.lit(10), F.lit(-999), F.lit(0.5), F.lit(1.0))) == 6.0


def test_units(spark):
    def convert(value, unit, target):
        cells = spark.createDataFrame([("a", value)], "frag_id string, v double")
        units = spark.createDataFrame([("a", unit)], "frag_id string, units string")
        return cf.conform_units(cells, "v", units, target, 1, [F.lit(0)]).first()["v"]

    assert convert(0.0, "degC", "K") == pytest.approx(273.15)
    assert convert(212.0, "degF", "celsius") == pytest.approx(100.0)
    assert convert(1.0, "g cm-2", "kg/m2") == pytest.approx(10.0)
    assert convert(36.0, "km per hour", "m s-1") == pytest.approx(10.0) and convert(5.0, None, "m") == 5.0
    assert convert(48.0, "hours since 2024-01-02", "days since 2024-01-01") == pytest.approx(3.0)
    for unit, target in (("m s-1", "kg m-2"), ("furlong", "m"), ("m", "furlong"), ("days since 2024-01-01", "days")):
        with pytest.raises(Exception, match="no conversion"):
            convert(1.0, unit, target)
    assert convert(3.0, "furlong", "furlong") == 3.0
    bad = spark.createDataFrame([("a", "K"), ("b", "degC"), ("c", "m s-1"), ("d", "furlong")], "frag_id string, units string")
    assert {r["frag_id"] for r in cf.unit_violations(bad, "K").collect()} == {"c", "d"}


def test_cells_without_a_conversion_stay(spark):
    cells = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("b", 3.0), ("c", 4.0)], "frag_id string, v double")
    units = spark.createDataFrame([("a", "degC"), ("b", "m s-1"), ("c", None)], "frag_id string, units string")
    got = cf.conform_units(cells, "v", units, "K", 3, [F.lit(0)], strict=False).collect()
    assert sorted((r["frag_id"], r["v"]) for r in got if r["v"] is not None) == [("a", 274.15), ("c", 4.0)]
    assert [r["frag_id"] for r in got if r["v"] is None] == ["b", "b"]


def test_conform_units_has_a_row_per_event(spark, sf_dir):
    got = QUERIES["conform_units"](spark, sf_dir)
    assert got.count() == spark.read.parquet(f"{sf_dir}/events.parquet").count() and got.filter("value is null").count() > 0


@pytest.mark.parametrize("text,powers,factor", [
    ("W m-2 K-1", (0, 1, -3, -1, 0, 0, 0, 0), 1.0), ("W/(m2)", None, None), ("kg*m/s**2", (1, 1, -2, 0, 0, 0, 0, 0), 1.0), ("1e-3 kg", (0, 1, 0, 0, 0, 0, 0, 0), 1e-3),
    ("ug m-3", (-3, 1, 0, 0, 0, 0, 0, 0), 1e-9), ("cd sr", (0, 0, 0, 0, 0, 0, 1, 2), 1.0), ("100 m2", (2, 0, 0, 0, 0, 0, 0, 0), 100.0), ("degC2", None, None), ("m^", None, None),
    ("mm/day", (1, 0, -1, 0, 0, 0, 0, 0), 0.001 / 86400), ("/s", (0, 0, -1, 0, 0, 0, 0, 0), 1.0), ("kilohertz", (0, 0, -1, 0, 0, 0, 0, 0), 1000.0), ("degC m", None, None),
])
def test_unit_expressions(text, powers, factor):
    from fragcube.functions.units import parse

    found = parse(text)
    assert (found is None) == (powers is None)
    if found:
        assert found.powers == powers and found.factor == pytest.approx(factor)


def test_times(spark):
    at = lambda v, u: one(spark, cf.decode_times(F.lit(v), F.lit(u)))
    assert at(1.5, "days since 2024-01-01") == datetime.datetime(2024, 1, 2, 12)
    assert at(2, "hour since 2024-01-10T06:00:00") == datetime.datetime(2024, 1, 10, 8)
    assert one(spark, cf.decode_timedelta(F.lit(90.0), F.lit("minutes"))) == datetime.timedelta(minutes=90)
    assert one(spark, cf.decode_timedelta(F.lit(-1.5), F.lit("seconds"))) == datetime.timedelta(seconds=-1.5)


@pytest.mark.parametrize("calendar, days, want", [
    ("noleap", 59, (2000, 3, 1)), ("noleap", 365, (2001, 1, 1)), ("noleap", -1, (1999, 12, 31)), ("noleap", 364, (2000, 12, 31)),
    ("360_day", 59, (2000, 2, 30)), ("360_day", 360, (2001, 1, 1)), ("360_day", -1, (1999, 12, 30)),
])
def test_calendars(spark, calendar, days, want):
    got = calendars.decode(spark.range(1), "v", F.lit(days), F.lit("days since 2000-01-01"), calendar).first()["v"]
    assert (got["y"], got["m"], got["d"]) == want
    with pytest.raises(ValueError):
        calendars.decode(spark.range(1), "v", F.lit(0), F.lit("days since 2000-01-01"), "lunar")


def test_axis_keys(spark):
    assert one(spark, idiv(F.lit(17), 5)) == 3
    stamp = datetime.datetime(2024, 1, 1, 0, 0, 1)
    df = spark.range(1).select(F.lit("2024-01-01 00:00:01").cast("timestamp_ntz").alias("n"), F.lit("2024-01-01").cast("date").alias("d"))
    row = df.select(start_key("n", "timestamp_ntz").alias("n"), start_key("d", "date").alias("d")).first()
    assert row["n"] == bound_key(stamp) and row["d"] == bound_key(stamp.date())
    assert bound_key("text") is None


def test_concat_characters(spark):
    cells = spark.createDataFrame([(1, 1, "b"), (1, 0, "a"), (1, 2, "\0"), (2, 0, "x")], "row int, pos int, c string")
    assert {r["row"]: r["text"] for r in cf.concat_characters(cells, ["row"], "pos", "c").collect()} == {1: "ab", 2: "x"}


def test_cast_adds_missing_dimensions(spark):
    got = cf.cast_canonical(spark.range(1).select(F.lit(2.7).alias("v")), "v", "int", ["t"]).first()
    assert (got["v"], got["l_t"]) == (2, 0)


def test_set_coords(spark):
    variables = spark.createDataFrame([("a",), ("b",), ("c",)], "var string")
    attrs = spark.createDataFrame([("coordinates", " a  c"), ("units", "b")], "attr string, value string")
    assert {r["var"]: r["is_coord"] for r in cf.set_coords(variables, attrs).collect()} == {"a": 1, "b": 0, "c": 1}


def test_shared_folder_comes_from_the_session(spark):
    assert scratch_root(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")

    class Bare:
        class conf:
            get = staticmethod(lambda key, default=None: "local[2]" if key == "spark.master" else default)

        class sparkContext:
            applicationId = "app"

    assert scratch_root(Bare).startswith("/tmp/run-") and scratch_root(Bare) == scratch_root(Bare)
