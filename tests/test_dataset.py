"""Instructions, groups, chunk options and decoded variables."""

import datetime
from dataclasses import replace

import duckdb
import numpy as np
import pytest
from grids import fragments_of, to_array
from oracle import compare
from pyspark.sql import functions as F

from fragcube import FragmentSet, build_manifest, open_dataset, write_manifest
from fragcube.model import Block, FragmentError
from fragcube.operators import decode
from fragcube.plans.instructions import Instructions, constant_cells, decode_instructions, to_instructions
from fragcube.plans.registry import ORACLES, QUERIES
from fragcube.session import scratch_path
from fragcube.sources.decoder import read_with

import __spark_entry__  # noqa: F401  (registers the queries)

WORKED = {  # the worked example of the conventions: sizes per dimension, padded
    "level": [17, None, None], "latitude": [90, 45, 45], "longitude": [180, 180, None],
}


def worked_maps(spark, name="m"):
    rows = [(name, d, i, s) for d, sizes in WORKED.items() for i, s in enumerate(sizes)]
    return spark.createDataFrame(rows, "name string, dim string, col long, size long")


def variables(spark, data):
    return spark.createDataFrame([("t", "level latitude longitude", data)], "var string, aggregated_dimensions string, aggregated_data string")


def locations(spark, name="u"):
    return spark.createDataFrame([(name, i, 0, f"file_{c}.nc") for i, c in enumerate("ABCDEF")], "name string, pos long, version int, uri string")


def test_worked_example(spark):
    scalars = spark.createDataFrame([("i", "tmp")], "name string, value string")
    given = Instructions(variables(spark, "identifiers: i map: m uris: u"), worked_maps(spark), locations(spark), scalars)
    decoded = decode_instructions(given, "t")
    assert decoded.convention == "primary" and decoded.space == {"level": 1, "latitude": 3, "longitude": 2}
    row = decoded.frags.filter("f_latitude = 1 and f_longitude = 1").first()
    assert (row["s_level"], row["s_latitude"], row["s_longitude"]) == (17, 45, 180)
    assert (row["o_level"], row["e_level"], row["o_latitude"], row["e_latitude"], row["o_longitude"], row["e_longitude"]) == (0, 17, 90, 135, 180, 360)
    assert row["uris"] == ["file_D.nc"] and row["identifier"] == "tmp"


@pytest.mark.parametrize("data, convention, label", [
    ("shape: m location: u address: i", "interim", "identifier"), ("location: m file: u format: i", "beta", "format"),
])
def test_older_layouts(spark, data, convention, label):
    own = spark.createDataFrame([("i", 3, "own")], "name string, pos long, value string")
    scalars = spark.createDataFrame([("i", "nc")], "name string, value string")
    decoded = decode_instructions(Instructions(variables(spark, data), worked_maps(spark), locations(spark), scalars, own), "t", {"file_": "/d/"})
    assert decoded.convention == convention
    got = {r["pos"]: (r["uris"][0], r[label]) for r in decoded.frags.collect()}
    assert got[3] == ("/d/D.nc", "own") and got[0] == ("/d/A.nc", "nc") and len(got) == 6


def test_unknown_layout_and_unique_values(spark):
    with pytest.raises(FragmentError):
        decode_instructions(Instructions(variables(spark, "map: m uris: u"), worked_maps(spark)), "t")
    maps = spark.createDataFrame([("m", "a", 0, 2), ("m", "a", 1, 3), ("m", "b", 0, 4), ("m", "b", 1, None)], "name string, dim string, col long, size long")
    var = spark.createDataFrame([("t", "a b", "map: m unique_values: q")], "var string, aggregated_dimensions string, aggregated_data string")
    values = spark.createDataFrame([("q", 0, 1.5), ("q", 1, -9.0)], "name string, pos long, value double")
    cells = constant_cells(decode_instructions(Instructions(var, maps, values=values), "t"), missing=-9.0)
    out = to_array(cells, ("a", "b"), (5, 4), "unique_value")
    assert (out[:2] == 1.5).all() and np.isnan(out[2:]).all()


def test_instructions_of_a_manifest(spark):
    fragments = fragments_of(spark, np.zeros((6, 4)), ("t", "x"), {"t": [0, 2, 6], "x": [0, 1, 4]})
    manifest = build_manifest(fragments)
    decoded = decode_instructions(to_instructions(manifest, "v"), "v")
    key = ["f_t", "o_t", "s_t", "f_x", "o_x", "s_x"]
    got = sorted((r["uris"][0], *[r[k] for k in key]) for r in decoded.frags.collect())
    assert got == sorted((r["frag_id"], *[r[k] for k in key]) for r in manifest.frags.collect())


def test_versions_pick_the_first_that_exists(spark):
    versions = spark.createDataFrame([("a", ["x/1", "x/2", None]), ("b", ["", "x/3"]), ("c", ["x/9"])], "frag_id string, uris array<string>")
    listing = spark.createDataFrame([("/r/x/2",), ("/r/x/3",)], "path string")
    got = {r["frag_id"]: (r["version"], r["path"]) for r in decode.resolve_locations(versions, listing, "/r").collect()}
    assert got == {"a": (1, "/r/x/2"), "b": (1, "/r/x/3"), "c": (None, None)}


def test_pages_that_share_a_url_keep_their_own_version(spark, tmp_path):
    pages = [(0, "http://a/x"), (1, "http://a/x"), (2, "http://a/x"), (3, "http://a/x"), (4, "http://a/y"), (-3, "http://a/y"), (None, "http://a/x")]
    spark.createDataFrame(pages, "page_id long, url string").coalesce(1).write.parquet(str(tmp_path / "pages.parquet"))
    con = duckdb.connect()
    con.execute(f"create view pages as select * from read_parquet('{tmp_path}/pages.parquet/*.parquet')")
    cursor = con.execute(ORACLES["resolve_location"])
    df = QUERIES["resolve_location"](spark, str(tmp_path))
    got = [tuple(r) for r in df.collect()]
    assert compare(df.columns, got, [d[0] for d in cursor.description], cursor.fetchall()) is None and (1, 1, "/data/set/cache/1.html") in got


def test_groups(spark):
    members = spark.createDataFrame(
        [("/", 0, "var", "p", "root"), ("/a", 1, "var", "p", "a"), ("/a/b", 2, "var", "q", "b"), ("/", 0, "attr", "title", "root"),
         ("/a/b", 2, "attr", "title", "b"), ("/a/b", 2, "attr", "own", "b"), ("/z", 1, "var", "p", "z")],
        "group_path string, depth int, kind string, name string, value string",
    )
    see = lambda path: {(r["kind"], r["name"]): r["value"] for r in decode.group_overlay(members, path).collect()}
    assert see("/a/b") == {("var", "p"): "a", ("var", "q"): "b", ("attr", "title"): "root", ("attr", "own"): "b"}
    assert see(None) == see("/") == {("var", "p"): "root", ("attr", "title"): "root"}
    with pytest.raises(FragmentError):
        see("/a/none")


@pytest.fixture(scope="module")
def stored(spark):
    data = np.arange(24, dtype=float).reshape(6, 4)
    fragments = fragments_of(spark, data, ("t", "x"), {"t": [0, 2, 6], "x": [0, 4]})
    block = fragments.blocks[0]
    cells = block.cells.withColumns({
        "packed": F.when(F.col("v") == 5, -999).otherwise(F.col("v") * 2).cast("int"), "when": F.col("v"), "span": F.col("v"), "model": F.col("v"),
    }).withMetadata("packed", {"_FillValue": -999})
    names = ("v", "packed", "when", "span", "model")
    texts = {("packed", "scale_factor"): "0.5", ("packed", "add_offset"): "10", ("when", "units"): "hours since 2024-01-01",
             ("span", "units"): "minutes", ("model", "units"): "days since 2000-01-01", ("model", "calendar"): "360_day", ("", "title"): "root"}
    rows = [(f, i, "var" if o else "global", o, a, v) for i, f in enumerate(("f0", "f1")) for (o, a), v in texts.items()]
    attrs = spark.createDataFrame(rows, "frag_id string, file_ord int, scope string, owner string, attr string, value string")
    whole = FragmentSet((Block(block.dims, block.coords, names, cells),), attrs=attrs)
    path = scratch_path(spark, "dataset")
    write_manifest(build_manifest(whole), path)
    return data, whole, path


def test_decoded_variables(spark, stored):
    data, whole, path = stored
    dataset = open_dataset(spark, path, whole)
    packed = to_array(dataset.decoded("packed"), ("t", "x"), data.shape, "packed")
    want = data + 10
    want[data == 5] = np.nan
    np.testing.assert_array_equal(packed, want)
    raw = to_array(dataset.decoded("packed", mask_and_scale=False), ("t", "x"), data.shape, "packed")
    assert raw[1, 1] == -999
    first = lambda name, **kw: dataset.decoded(name, **kw).filter("t = 1 and x = 1").first()[name]
    assert first("when") == datetime.datetime(2024, 1, 1, 5)
    assert first("span") == datetime.timedelta(minutes=5) and first("span", decode_timedelta=False) == 5.0
    assert tuple(first("model")) == (2000, 1, 6, 0)
    assert first("when", decode_times=False) == 5.0


def test_nested_group_inherits(spark, stored):
    data, whole, path = stored
    inner = fragments_of(spark, np.ones((4, 2)), ("t", "y"), {"t": [0, 1, 4], "y": [0, 2]}, var="w")
    titled = spark.createDataFrame(
        [(f, i, "global", "", a, "inner") for i, f in enumerate(("f0", "f1")) for a in ("title", "own")],
        "frag_id string, file_ord int, scope string, owner string, attr string, value string",
    )
    write_manifest(build_manifest(replace(inner, attrs=titled)), path, group="/a")
    both = FragmentSet(whole.blocks + inner.blocks)
    dataset = open_dataset(spark, path, both, group="a")
    assert dataset.sizes == {"t": 4, "x": 4, "y": 2}
    assert {r["var"] for r in dataset.variables.collect()} == {"v", "packed", "when", "span", "model", "w"}
    attrs = {r["attr"]: r["value"] for r in dataset.attrs.filter("scope = 'global'").collect()}
    assert attrs == {"title": "root", "own": "inner"}
    assert dataset["w"].shape == (4, 2) and dataset["v"].shape == (6, 4)
    with pytest.raises(FragmentError):
        open_dataset(spark, path, both, group="/a/none")


def test_chunk_options(spark, stored):
    _, whole, path = stored
    dataset = open_dataset(spark, path, whole, chunks={"t": 2, "x": "optimised", "zz": 9})
    assert dataset.chunk_sizes(whole.blocks[0]) == {"t": 2, "x": 4}
    assert dataset.chunked("v").select("frag_id", "k_t", "k_x").distinct().count() == 3


def test_files_with_a_decoder(spark, tmp_path):
    import pyarrow as pa

    for i in range(3):
        (tmp_path / f"f{i}.txt").write_text("\n".join(str(i * 2 + j) for j in range(2)))

    def parse(path, content):
        values = [float(x) for x in content.decode().split()]
        name = path.rsplit("/", 1)[-1]
        yield pa.RecordBatch.from_pydict({
            "frag_id": [name] * 2, "file_ord": pa.array([0, 0], pa.int64()), "l_t": pa.array([0, 1], pa.int64()), "c_t": values, "v": values,
        })

    cells = read_with(spark, str(tmp_path), parse, "frag_id string, file_ord long, l_t long, c_t double, v double", "*.txt")
    fragments = FragmentSet((Block(("t",), ("t",), ("v",), cells),))
    manifest = build_manifest(fragments)
    from fragcube import open_variable

    out = to_array(open_variable(fragments, manifest, "v").to_df(), ("t",), (6,))
    np.testing.assert_array_equal(out, np.arange(6.0))
