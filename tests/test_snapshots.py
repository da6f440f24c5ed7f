"""Snapshots of a manifest, appends that have to fit, faults in cells and on axes, and the fragment source."""

import threading
from dataclasses import replace

import numpy as np
import pandas as pd
import pytest
from grids import fragments_of, to_array
from pyspark.sql import functions as F

from fragcube import FragmentError, FragmentSet, build_manifest, incremental_append, open_fragments, write_manifest
from fragcube.operators import infer
from fragcube.operators.inventory import coverage_violations, wide_inventory
from fragcube.plans import snapshots
from fragcube.plans.instructions import decode_instructions
from fragcube.plans.manifest import place, scan_inventory, with_locations
from fragcube.sources.datasource import register
from fragcube.sources.parquet import write_fragments


def line(spark, cuts, n=None):
    """Values 0, 1, ... along one axis, cut at the given places."""
    return fragments_of(spark, np.arange(float(cuts[-1])), ("t",), {"t": cuts})


def only(fragments, names):
    return replace(fragments, blocks=tuple(replace(b, cells=b.cells.filter(F.col("frag_id").isin(names))) for b in fragments.blocks))


def placed(manifest):
    return sorted((r["frag_id"], r["o_t"], r["s_t"]) for r in manifest.frags.collect())


@pytest.mark.parametrize("indices,faults", [
    ([0, 0, 3, 3], {("hole", 4, 2), ("double", 2, 4)}), ([0, 1, 3], {("hole", 4, 3)}), ([0, 1, 1, 2], {("double", 3, 4)}),
    ([0, 1, 2, -1], {("double", 3, 4)}), ([0, 1, 2, 3], set()),
])
def test_every_index_once(spark, indices, faults):
    frame = pd.DataFrame({"frag_id": ["a"] * len(indices) + ["b"] * 2, "file_ord": 0, "l_t": [*indices, 0, 1], "v": 0.0})
    fragments = FragmentSet((replace(line(spark, [0, 1, 2]).blocks[0], coords=(), cells=spark.createDataFrame(frame)),))
    wide = wide_inventory(fragments)
    got = coverage_violations(fragments, wide, 2)
    assert {(r["check"], r["expected"], r["actual"]) for r in got.collect()} == faults


def test_a_stand_in_is_an_error(spark):
    whole = fragments_of(spark, np.arange(8.0), ("t",), {"t": [0, 4, 8]})
    cells = whole.blocks[0].cells
    moved = cells.withColumn("l_t", F.when(F.col("frag_id") == "f1", F.when(F.col("l_t") == 1, 0).when(F.col("l_t") == 2, 3).otherwise(F.col("l_t"))).otherwise(F.col("l_t")))
    with pytest.raises(FragmentError, match="lack cells"):
        build_manifest(FragmentSet((replace(whole.blocks[0], cells=moved),)))


def test_large_boxes_fill_many_bitmaps(spark):
    whole = fragments_of(spark, np.zeros((300, 400)), ("t", "x"), {"t": [0, 290, 300], "x": [0, 400]})
    wide = wide_inventory(whole)
    assert coverage_violations(whole, wide, 2).count() == 0
    swapped = whole.blocks[0].cells.withColumn("l_x", F.when((F.col("l_t") == 200) & (F.col("l_x") == 7), 8).otherwise(F.col("l_x")))
    got = coverage_violations(FragmentSet((replace(whole.blocks[0], cells=swapped),)), wide, 2)
    assert {(r["check"], r["expected"], r["actual"]) for r in got.collect()} == {("hole", 116000, 115999), ("double", 115999, 116000)}


def test_text_axes_that_interleave_are_errors(spark):
    letters = [list("acegi"), list("bdfhj")]
    frame = pd.DataFrame([{"frag_id": f"f{i}", "file_ord": i, "l_k": j, "c_k": c, "v": 1.0} for i, part in enumerate(letters) for j, c in enumerate(part)])
    base = line(spark, [0, 1, 2]).blocks[0]
    with pytest.raises(FragmentError, match="overlap"):
        build_manifest(FragmentSet((replace(base, dims=("k",), coords=("k",), cells=spark.createDataFrame(frame)),)))
    apart = frame.assign(c_k=[*"abcde", *"fghij"])
    assert build_manifest(FragmentSet((replace(base, dims=("k",), coords=("k",), cells=spark.createDataFrame(apart)),))).dim("k").size == 10


@pytest.mark.parametrize("block_rows", [1000, 7])
def test_a_diagonal_is_validated_without_its_grid(spark, block_rows):
    n = 40
    rows = [(f"f{i}", i, 1, float(i), float(i), None, None, 1, float(i), float(i), None, None) for i in range(n) if i != 5] + [("twin", 99, 1, 3.0, 3.0, None, None, 1, 3.0, 3.0, None, None)]
    ddl = "frag_id string, file_ord int, " + ", ".join(f"size_{d} long, start_{d} double, stop_{d} double, start_s_{d} string, stop_s_{d} string" for d in "ab")
    from fragcube.plans.manifest import store_inventory

    at = place(store_inventory(spark.createDataFrame(rows, ddl), ["a", "b"], {"a", "b"}))
    space = {d.dim: d.f_size for d in at.dims}
    assert space == {"a": 39, "b": 39}
    got = infer.grid_faults(at.frags, ["a", "b"], space, n, block_rows=block_rows).collect()
    assert sum(r["expected"] for r in got if r["check"] == "hole") == 39 * 39 - 39
    assert [(r["item"], r["actual"]) for r in got if r["check"] == "double"] == [("3,3", 2)]


def test_append_has_to_fit(spark):
    whole = line(spark, [0, 5, 10, 15, 20])
    start = build_manifest(only(whole, ["f0", "f1"]))
    over = fragments_of(spark, np.arange(3.0), ("t",), {"t": [0, 3]}, coords={"t": np.array([8.0, 9.0, 10.0])})
    named = replace(over, blocks=tuple(replace(b, cells=b.cells.withColumn("frag_id", F.lit("over"))) for b in over.blocks))
    with pytest.raises(FragmentError, match="overlap"):
        incremental_append(start, named)
    broken = only(whole, ["f2"])
    broken = replace(broken, blocks=tuple(replace(b, cells=b.cells.withColumn("l_t", F.when(F.col("l_t") == 1, 2).otherwise(F.col("l_t")))) for b in broken.blocks))
    with pytest.raises(FragmentError, match="lack cells"):
        incremental_append(start, broken)


def test_append_moves_coordinates(spark):
    whole = line(spark, [0, 5, 10, 15, 20])
    attrs = spark.createDataFrame([(f"f{i}", i, "global", "", "title", "x" if i < 3 else "y") for i in range(4)], "frag_id string, file_ord long, scope string, owner string, attr string, value string")
    whole = replace(whole, attrs=attrs)
    start = build_manifest(replace(only(whole, ["f1", "f2"]), attrs=attrs.filter("frag_id in ('f1', 'f2')")))
    grown = incremental_append(start, whole)
    assert placed(grown) == placed(build_manifest(whole))
    coords = grown.coords.select("idx", "value", "consistent").orderBy("idx").collect()
    assert [(r["idx"], r["value"]) for r in coords] == [(i, float(i)) for i in range(20)] and all(r["consistent"] for r in coords)
    assert grown.attrs.filter("attr = 'title'").first()["value"] != "x"  # a later file says otherwise
    assert grown.dim("t").dtype == "double"


def test_known_folders_are_not_read_again(spark, tmp_path):
    from test_scale_paths import scan_metrics

    whole = line(spark, list(range(0, 41, 2)))
    write_fragments(whole.blocks[0], str(tmp_path / "d"))
    stored = FragmentSet((open_fragments(spark, str(tmp_path / "d")),))
    start = build_manifest(only(whole, [f"f{i}" for i in range(18)]))
    from fragcube.operators.merge import unknown_fragments

    fresh = unknown_fragments(start, stored).blocks[0].cells.groupBy("frag_id").agg(F.sum("v"))
    scans = [s for s in scan_metrics(spark, fresh) if "v#" in s[0]]
    assert scans[0][1] == 2


def test_snapshots_are_whole_and_numbered(spark, tmp_path):
    path = str(tmp_path / "m")
    whole = line(spark, [0, 5, 10, 15, 20])
    assert snapshots.read_snapshot(spark, path).number == 0
    with pytest.raises(FragmentError, match="no snapshot"):
        snapshots.append(spark, path, whole)
    first = snapshots.append(spark, path, only(whole, ["f0", "f1"]), build_manifest)
    assert first.number == 1
    second = snapshots.append(spark, path, whole)
    assert (second.number, second.manifest.n_frags) == (2, 4)
    assert snapshots.append(spark, path, whole).number == 2  # nothing new
    assert placed(snapshots.read_snapshot(spark, path, 1).manifest) == placed(first.manifest)
    with pytest.raises(snapshots.ConflictError):
        snapshots.commit(spark, path, first.manifest, 1)
    assert snapshots.versions(spark, path) == [1, 2]
    with pytest.raises(FragmentError, match="no snapshot 7"):
        snapshots.read_snapshot(spark, path, 7)


def test_two_writers_lose_nothing(spark, tmp_path):
    path = str(tmp_path / "m")
    whole = line(spark, [0, 5, 10, 15, 20])
    snapshots.append(spark, path, only(whole, ["f1", "f2"]), build_manifest)
    meet, tried, failed = threading.Barrier(2, timeout=120), [], []
    real = snapshots.commit

    def together(*args, **kwargs):
        tried.append(args[3])
        if tried.count(1) <= 2 and args[3] == 1:
            meet.wait()  # both have read snapshot 1
        return real(*args, **kwargs)

    def write(name):
        try:
            snapshots.append(spark, path, only(whole, [name]))
        except Exception as error:  # shown below
            failed.append(error)

    snapshots.commit = together
    try:
        threads = [threading.Thread(target=write, args=(n,)) for n in ("f0", "f3")]
        for t in threads:
            t.start()
        for t in threads:
            t.join()
    finally:
        snapshots.commit = real
    assert not failed and tried.count(1) == 2 and tried.count(2) == 1
    last = snapshots.read_snapshot(spark, path)
    assert last.number == 3 and placed(last.manifest) == placed(build_manifest(whole))


def test_instructions_and_inline_values_are_stored(spark, tmp_path):
    whole = line(spark, [0, 5, 10])
    block = whole.blocks[0]
    held = block.cells.select("frag_id", "file_ord").distinct()
    scalar = replace(block, dims=(), coords=(), vars=("base",), cells=held.withColumn("base", F.lit("2024-01-01")))
    fragments = replace(whole, blocks=(block, scalar))
    path = str(tmp_path / "m")
    at = snapshots.append(spark, path, fragments, build_manifest)
    inline = spark.read.parquet(f"{path}/{at.folder}/inline")
    assert [tuple(r) for r in inline.select("var", "idx", "value").collect()] == [("base", "", "2024-01-01")]
    decoded = decode_instructions(snapshots.read_instructions(spark, path, at), "v")
    assert (decoded.convention, decoded.dims, decoded.space) == ("primary", ("t",), {"t": 2})
    assert sorted((r["o_t"], r["e_t"], r["uris"][0]) for r in decoded.frags.collect()) == sorted((r["o_t"], r["o_t"] + r["s_t"], r["frag_id"]) for r in at.manifest.frags.collect())


def test_fragments_as_a_source(spark, tmp_path):
    register(spark)
    whole = fragments_of(spark, np.arange(40.0).reshape(10, 4), ("t", "x"), {"t": [0, 3, 10], "x": [0, 2, 4]})
    root = f"{tmp_path}/with space"
    write_fragments(whole.blocks[0], root)
    cells = spark.read.format("fragments").load(root)
    assert cells.rdd.getNumPartitions() == 4 and set(cells.columns) == {"frag_id", "file_ord", "l_t", "l_x", "c_t", "c_x", "v"}
    assert sorted(map(tuple, cells.select("frag_id", "l_t", "l_x", "v").collect())) == sorted(map(tuple, whole.blocks[0].cells.select("frag_id", "l_t", "l_x", "v").collect()))
    one = cells.filter("frag_id = 'f2' and l_t >= 1")
    assert one.count() == whole.blocks[0].cells.filter("frag_id = 'f2' and l_t >= 1").count() and one.rdd.getNumPartitions() == 1
    assert spark.read.format("fragments").load(f"{root}/frag_id=f[01]").select("frag_id").distinct().count() == 2
    heads = spark.read.format("fragments").option("report", "footers").load(root)
    assert {r["column"] for r in heads.collect()} == {"file_ord", "l_t", "l_x", "c_t", "c_x", "v"}
    with pytest.raises(Exception, match="fewer than two"):
        spark.read.format("fragments").load(f"{root}/frag_id=f0")
    with pytest.raises(Exception, match="no columns"):
        spark.read.format("fragments").option("columns", "v, w").load(root)


def test_source_of_a_manifest_names_no_fragment(spark, tmp_path):
    register(spark)
    data = np.arange(40.0).reshape(10, 4)
    whole = fragments_of(spark, data, ("t", "x"), {"t": [0, 3, 10], "x": [0, 2, 4]})
    write_fragments(whole.blocks[0], f"{tmp_path}/d")
    manifest = build_manifest(whole)
    uris = manifest.frags.select("frag_id", F.array(F.concat(F.lit("../gone/"), "frag_id"), F.concat(F.lit("../d/frag_id="), "frag_id")).alias("uris"))
    write_manifest(with_locations(manifest, uris), f"{tmp_path}/m")
    cells = spark.read.format("fragments").options(manifest=f"{tmp_path}/m", variable="v").load()
    assert cells.columns == ["frag_id", "l_t", "l_x", "c_t", "c_x", "v"] and cells.rdd.getNumPartitions() == 1
    joined = cells.join(manifest.frags, "frag_id").selectExpr("o_t + l_t as t", "o_x + l_x as x", "v")
    np.testing.assert_array_equal(to_array(joined, ("t", "x"), data.shape), data)
    assert cells.filter("frag_id in ('f0', 'f9')").select("frag_id").distinct().count() == 1
    with pytest.raises(Exception, match="no variable"):
        spark.read.format("fragments").options(manifest=f"{tmp_path}/m", variable="w").load()


def test_inventory_of_arrivals_is_scanned_once(spark):
    whole = line(spark, [0, 5, 10, 15])
    start = build_manifest(only(whole, ["f0", "f1"]))
    assert incremental_append(start, only(whole, ["f0"])) is start
    assert scan_inventory(only(whole, ["f2"])).n_frags == 1
