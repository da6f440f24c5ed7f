"""Opening an aggregation from its manifest alone."""

import datetime
from dataclasses import replace

import numpy as np
import pandas as pd
import pytest
from grids import fragments_of, to_array
from pyspark.sql import functions as F

from fragcube import FragmentError, FragmentSet, build_manifest, open_dataset, open_fragments, write_manifest
from fragcube.plans.manifest import read_manifest, with_locations
from fragcube.sources import located
from fragcube.sources.parquet import write_fragments


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """A 40 x 6 array in 20 fragments under ``data``, its manifest beside them."""
    root = str(tmp_path_factory.mktemp("located"))
    data = np.random.default_rng(2).normal(size=(40, 6))
    whole = fragments_of(spark, data, ("t", "x"), {"t": list(range(0, 41, 4)), "x": [0, 2, 6]})
    write_fragments(whole.blocks[0], f"{root}/data")
    fragments = FragmentSet((open_fragments(spark, f"{root}/data"),))
    manifest = build_manifest(fragments)
    uris = manifest.frags.select("frag_id", F.array(F.lit(None).cast("string"), F.concat(F.lit("../data/gone="), "frag_id"), F.concat(F.lit("../data/frag_id="), "frag_id")).alias("uris"))
    write_manifest(with_locations(manifest, uris), f"{root}/manifest")
    return root, data, manifest


def test_reads_without_fragments(spark, stored):
    root, data, _ = stored
    v = open_dataset(spark, f"{root}/manifest")["v"]
    np.testing.assert_array_equal(to_array(v.to_df(), ("t", "x"), data.shape), data)
    few = v.isel(t=slice(3, 9, 2), x=3)
    assert few.shape == (3,)
    np.testing.assert_array_equal(few.to_df().orderBy("t").toPandas()["v"], data[3:9:2, 3])


def test_only_selected_fragments_are_opened(spark, stored):
    root, _, _ = stored
    v = open_dataset(spark, f"{root}/manifest")["v"]
    columns = [located.Column("l_t", "l_t", "bigint"), located.Column("v", "v", "double")]
    units = located.row_groups(v.isel(t=slice(5, 7)).fragments(), columns)
    assert {r["path"].split("frag_id=")[1].split("/")[0] for r in units.collect()} == {r["frag_id"] for r in v.isel(t=5).fragments().collect()}
    assert units.select("frag_id").distinct().count() == 2 and located.row_groups(v.fragments(), columns).select("frag_id").distinct().count() == 20


def test_ranges_of_coordinates_skip_row_groups(spark, tmp_path):
    for name, start in (("a", 0), ("b", 100)):
        at = np.arange(100)
        (tmp_path / f"frag_id={name}").mkdir()
        frame = pd.DataFrame({"l_t": at, "c_t": (at + start).astype(float), "v": at + start * 1.0, "file_ord": start})
        frame.to_parquet(tmp_path / f"frag_id={name}" / "x.parquet", row_group_size=10, index=False)
    manifest = build_manifest(FragmentSet((open_fragments(spark, str(tmp_path)),)))
    uris = manifest.frags.select("frag_id", F.array(F.concat(F.lit(f"{tmp_path}/frag_id="), "frag_id")).alias("uris"))
    path = f"{tmp_path}-manifest"
    write_manifest(with_locations(manifest, uris), path)
    v = open_dataset(spark, path)["v"]
    assert v.sel(t=slice(95.0, 104.0)).to_df().orderBy("t").toPandas()["v"].tolist() == [float(x) for x in range(95, 105)]
    units = located.row_groups(v.fragments(), [located.Column("v", "v", "double")], [("c_t", 95.0, 104.0)])
    assert sorted((r["frag_id"], r["part"]) for r in units.collect()) == [("a", 9), ("b", 0)]


def test_names_types_and_absence_are_errors(spark, stored):
    root, _, manifest = stored
    v = open_dataset(spark, f"{root}/manifest")["v"]
    column = lambda stored_as, dtype: [located.Column("v", stored_as, dtype)]
    for columns, says in ((column("w", "double"), "lacks 'w'"), (column("v", "float"), "is double in .*not float")):
        with pytest.raises(Exception, match=says):
            located.scan_located(v.fragments(), columns).count()
    gone = v.fragments().withColumn("uris", F.array(F.lit("/no/where"), F.lit(None)))
    with pytest.raises(Exception, match="none of its locations exists"):
        located.scan_located(gone, column("v", "double")).count()
    assert {r["version"] for r in located.existing(v.fragments()).collect()} == {2} and {r["version"] for r in located.existing(gone).collect()} == {None}
    write_manifest(manifest, f"{root}/without")
    with pytest.raises(FragmentError, match="names no locations"):
        open_dataset(spark, f"{root}/without")["v"]


def test_identifiers_constants_and_own_substitutions(spark, tmp_path):
    data = np.arange(24.0).reshape(8, 3)
    whole = fragments_of(spark, data, ("t", "x"), {"t": [0, 2, 4, 6, 8], "x": [0, 3]})
    block = whole.blocks[0]
    block.cells.filter("frag_id <> 'f1'").withColumnRenamed("v", "held as").write.partitionBy("frag_id").parquet(f"{tmp_path}/d")
    attrs = spark.createDataFrame([("f0", 0, "global", "", "substitutions", "${here}: nowhere")], "frag_id string, file_ord int, scope string, owner string, attr string, value string")
    manifest = build_manifest(replace(whole, identifiers={"v": "held as"}, attrs=attrs))
    uris = manifest.frags.filter("frag_id <> 'f1'").select("frag_id", F.array(F.concat(F.lit("${here}/frag_id="), "frag_id")).alias("uris"))
    write_manifest(with_locations(manifest, uris, spark.createDataFrame([("f1", "v", -7.0)], "frag_id string, var string, value double")), f"{tmp_path}/m")
    data[2:4] = -7.0
    assert open_dataset(spark, f"{tmp_path}/m").manifest.frags.filter("uris[0] like '%nowhere%'").count() == 3
    given = open_dataset(spark, f"{tmp_path}/m", substitutions={"nowhere": "../d", "${here}": "../d"})
    np.testing.assert_array_equal(to_array(given["v"].to_df(), ("t", "x"), data.shape), data)
    np.testing.assert_array_equal(to_array(given["v"].isel(t=slice(3, 5)).to_df().withColumn("t", F.col("t") - 3), ("t", "x"), (2, 3)), data[3:5])
    assert given["v"].reduce("sum").first()["v_sum"] == data.sum()
    assert given.chunked("v").count() == 18  # cells that are stored


def test_types_travel_with_the_manifest(spark, tmp_path):
    days = [datetime.date(2024, 1, 1) + datetime.timedelta(days=i) for i in range(4)]
    for name, at in (("a", (0, 1)), ("b", (2, 3))):
        (tmp_path / f"d/frag_id={name}").mkdir(parents=True)
        frame = pd.DataFrame({"l_day": np.array([0, 1]), "c_day": [days[i] for i in at], "v": np.array(at, np.int32), "s": [f"s{i}" for i in at], "file_ord": at[0]})
        frame["at"] = pd.to_datetime(frame["c_day"]).astype("datetime64[us]")
        frame.to_parquet(tmp_path / f"d/frag_id={name}" / "x.parquet", index=False)
    block = open_fragments(spark, f"{tmp_path}/d")
    manifest = build_manifest(FragmentSet((block,)))
    assert manifest.dim("day").dtype == "date"
    uris = manifest.frags.select("frag_id", F.array(F.concat(F.lit(f"file:{tmp_path}/d/frag_id="), "frag_id")).alias("uris"))
    write_manifest(with_locations(manifest, uris), f"{tmp_path}/m")
    assert read_manifest(spark, f"{tmp_path}/m").dim("day").dtype == "date"
    dataset = open_dataset(spark, f"{tmp_path}/m")
    assert [r["v"] for r in dataset["v"].sel(day=slice(days[1], days[2])).to_df().orderBy("day").collect()] == [1, 2]
    assert [r["s"] for r in dataset["s"].to_df().orderBy("day").collect()] == ["s0", "s1", "s2", "s3"]
    assert [r["at"].date() for r in dataset["at"].isel(day=-1).to_df().collect()] == [days[3]]


def test_canonical_form_of_stored_fragments(spark, tmp_path):
    """Packing, units and a constant fragment, opened by the manifest and conformed on the way."""
    from fragcube.operators.canonical import canonical_violations, conformed
    from fragcube.operators.array import Variable

    data = np.arange(12.0)
    whole = fragments_of(spark, data, ("t",), {"t": [0, 4, 8, 12]})
    block = whole.blocks[0]
    stored = F.when(F.col("frag_id") == "f0", F.when(F.col("l_t") == 1, -9.0).otherwise(F.col("v") * 2 - 2)).otherwise(F.col("v") - 273.15)
    block.cells.filter("frag_id <> 'f2'").withColumn("v", stored).write.partitionBy("frag_id").parquet(f"{tmp_path}/d")
    manifest = build_manifest(whole)
    uris = manifest.frags.filter("frag_id <> 'f2'").select("frag_id", F.array(F.concat(F.lit("../d/frag_id="), "frag_id")).alias("uris"))
    write_manifest(with_locations(manifest, uris, spark.createDataFrame([("f2", "v", 5.0)], "frag_id string, var string, value double")), f"{tmp_path}/m")
    attrs = spark.createDataFrame([("f0", "scale_factor", "0.5"), ("f0", "add_offset", "1"), ("f0", "_FillValue", "-9"), ("f1", "units", "degC")], "frag_id string, attr string, value string")
    dataset = open_dataset(spark, f"{tmp_path}/m")
    opened = conformed(dataset["v"].block, "v", attrs, "K", 3)
    got = [r["v"] for r in Variable(opened, dataset.manifest, "v").to_df().orderBy("t").collect()]
    assert got[1] is None and [round(x, 9) for i, x in enumerate(got) if i != 1] == [0.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0, 5.0, 5.0, 5.0, 5.0]
    bad = attrs.union(spark.createDataFrame([("f0", "units", "m"), ("f1", "scale_factor", "half")], attrs.schema))
    assert {r["frag_id"]: r["problem"] for r in canonical_violations(bad, "K").collect()} == {"f0": "no conversion from m to K", "f1": "scale_factor is no number: half"}
    with pytest.raises(Exception, match="fragment f0: no conversion from m to K"):
        Variable(conformed(dataset["v"].block, "v", bad, "K", 3), dataset.manifest, "v").isel(t=0).to_df().collect()
