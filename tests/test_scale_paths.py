"""Plans: pruning, pushdown, and the ways taken when metadata is large."""

import numpy as np
import pytest
from grids import fragments_of, to_array

import fragcube.operators.array as array_ops
import fragcube.operators.infer as infer_ops
import fragcube.session as session
from fragcube import FragmentError, FragmentSet, build_manifest, open_files, open_fragments, open_variable, write_fragments
from fragcube.functions.axis import arrange
from fragcube.session import scratch_path
from fragcube.sources.parquet import header_inventory, scan_headers


@pytest.fixture(scope="module")
def stored(spark):
    data = np.arange(40 * 50, dtype=float).reshape(40, 50)
    made = fragments_of(spark, data, ("t", "x"), {"t": list(range(0, 41, 2)), "x": [0, 25, 50]})
    path = scratch_path(spark, "stored")
    write_fragments(made.blocks[0], path)
    fragments = FragmentSet((open_fragments(spark, path),))
    return data, fragments, build_manifest(fragments, with_coords=False), path


def run_plan(df):
    """Executed plan as text, after running."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def scan_metrics(spark, df):
    """Rows and files of the cell scan of an executed plan."""
    df.collect()
    rows, todo, out = 0, [df._jdf.queryExecution().executedPlan()], []
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
            continue
        if name.endswith("QueryStageExec"):
            todo.append(node.plan())
            continue
        if name == "FileSourceScanExec":
            metrics = node.metrics()
            out.append((node.toString(), metrics.apply("numFiles").value(), metrics.apply("numOutputRows").value()))
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return out


def test_selection_reads_only_its_fragments(spark, stored):
    data, fragments, manifest, _ = stored
    picked = open_variable(fragments, manifest, "v").isel(t=slice(10, 12), x=slice(30, 33))
    df = picked.to_df()
    scans = [s for s in scan_metrics(spark, df) if "v#" in s[0]]
    assert len(scans) == 1
    text, files, rows = scans[0]
    assert "dynamicpruning" in text.lower()
    assert files == 1 and rows == 2 * 25  # one of 40 fragments
    assert df.count() == 6


def test_coordinate_range_reaches_the_files(spark, stored):
    data, fragments, manifest, _ = stored
    df = open_variable(fragments, manifest, "v").sel(t=slice(4.0, 5.0)).to_df()
    scans = [s for s in scan_metrics(spark, df) if "v#" in s[0]]
    assert "GreaterThanOrEqual(c_t" in scans[0][0] and scans[0][1] == 2
    assert df.count() == 2 * 50
    assert "c_x" not in scans[0][0].split("ReadSchema")[-1]


def test_headers_describe_every_fragment(spark, stored):
    _, _, manifest, path = stored
    rows = header_inventory(scan_headers(spark, path)).collect()
    assert len(rows) == manifest.n_frags
    assert {(r["var"], r["dtype"], r["dims"], r["cdims"]) for r in rows} == {("v", "double", "t x", "t x")}


def test_opening_needs_two_fragments(spark, stored):
    *_, path = stored
    with pytest.raises(FragmentError):
        open_fragments(spark, [f"{path}/frag_id=f0"])
    with pytest.raises(FragmentError):
        open_fragments(spark, f"{path}/frag_id=f0")
    two = open_fragments(spark, [f"{path}/frag_id=f0", f"{path}/frag_id=f1"])
    assert two.cells.select("frag_id").distinct().count() == 2


def test_large_manifest_joins_with_a_salt(spark, stored, monkeypatch):
    data, fragments, _, _ = stored
    for module in (session, array_ops, infer_ops):
        monkeypatch.setattr(module, "BROADCAST_ROWS", 5, raising=False)
    monkeypatch.setattr(session, "SINGLE_TASK_ROWS", 5)
    manifest = build_manifest(fragments)
    assert manifest.n_frags == 40
    df = open_variable(fragments, manifest, "v").to_df()
    assert "xxhash64(l_t" in run_plan(df)
    np.testing.assert_array_equal(to_array(df, ("t", "x"), data.shape), data)
    assert manifest.coords.filter("dim = 't'").count() == 40
    # a narrow selection is probed and broadcast again
    few = open_variable(fragments, manifest, "v").isel(t=3, x=slice(0, 4)).to_df()
    assert "xxhash64(l_t" not in run_plan(few) and few.count() == 4


@pytest.mark.parametrize("text", [False, True])
def test_blocked_axis_equals_one_window(spark, text):
    rng = np.random.default_rng(3)
    starts = rng.choice(10_000, size=700, replace=False)
    rows = [
        ("a", None if text else float(s), f"s3://bucket/{s:05d}" if text else None, False, int(rng.integers(1, 9))) for s in starts
    ] + [("b", float(s), None, True, int(rng.integers(1, 9))) for s in starts[:300]] + [("whole", None, None, False, 12)]
    pieces = spark.createDataFrame(rows, "dim string, start double, start_s string, descending boolean, size long")
    plain = sorted(map(tuple, arrange(pieces, 1000).collect()), key=repr)
    blocked = sorted(map(tuple, arrange(pieces, 1000, block_rows=50).collect()), key=repr)
    assert plain == blocked


def test_no_cell_level_cross_join_or_python(spark, sf_dir):
    import __spark_entry__ as entries

    for name in ("assemble_array", "isel_mean", "reduce", "mask_and_scale", "concat_axis"):
        plan = entries.queries()[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "Python" not in plan, name


def test_separate_files(spark, tmp_path):
    """Files that know nothing of each other, with alternative locations for one of them."""
    import pandas as pd

    paths = []
    for i, (a, b) in enumerate(((6, 9), (0, 4), (4, 6))):
        at = np.arange(a, b)
        pd.DataFrame({"l_t": at - a, "c_t": at.astype(float), "v": at * 1.5}).to_parquet(tmp_path / f"part{i}.parquet", index=False)
        paths.append(str(tmp_path / f"part{i}.parquet"))
    fragments = open_files(spark, [paths[0], (paths[1], "s3://other/part1.parquet"), paths[2]])
    manifest = build_manifest(fragments)
    assert [r["uris"] for r in manifest.frags.orderBy("file_ord").collect()] == [
        [paths[0], None], [paths[1], "s3://other/part1.parquet"], [paths[2], None]
    ]
    variable = open_variable(fragments, manifest, "v")
    np.testing.assert_array_equal(to_array(variable.to_df(), ("t",), (9,)), np.arange(9) * 1.5)
    few = variable.isel(t=slice(4, 6)).to_df()
    scans = [s for s in scan_metrics(spark, few) if "v#" in s[0]]
    assert scans[0][1] == 1 and few.count() == 2
    assert variable.isel(t=slice(0, 0)).to_df().count() == 0
    by_glob = open_files(spark, f"{tmp_path}/*.parquet")
    assert build_manifest(by_glob).dim("t").size == 9
    with pytest.raises(FragmentError):
        open_files(spark, paths[:1])


def test_one_fragment_with_most_of_the_cells(spark, monkeypatch):
    for module in (session, array_ops, infer_ops):
        monkeypatch.setattr(module, "BROADCAST_ROWS", 2, raising=False)
    data = np.random.default_rng(0).normal(size=(600, 3))
    fragments = fragments_of(spark, data, ("t", "x"), {"t": [0, 5, 590, 600], "x": [0, 3]})
    manifest = build_manifest(fragments)
    out = to_array(open_variable(fragments, manifest, "v").to_df(), ("t", "x"), data.shape)
    np.testing.assert_array_equal(out, data)


def test_index_lists(spark, stored):
    data, fragments, manifest, _ = stored
    picked = open_variable(fragments, manifest, "v").isel(t=[7, -1, 7], x=slice(0, 10)).isel(x=[1, 2])
    assert picked.shape == (3, 2)
    df = picked.to_df(numbered=True)
    got = df.orderBy("t", "x").toPandas()["v"].to_numpy().reshape(3, 2)
    np.testing.assert_array_equal(got, data[[7, -1, 7]][:, [1, 2]])
    assert [s for s in scan_metrics(spark, df) if "v#" in s[0]][0][1] == 2


def test_footers_are_verified(spark, tmp_path):
    import pandas as pd

    def store(name, **columns):
        folder = tmp_path / name.split("/")[0] / f"frag_id={name.split('/')[1]}"
        folder.mkdir(parents=True)
        pd.DataFrame({"file_ord": [0, 0], "l_t": [0, 1], "c_t": [0.0, 1.0], **columns}).to_parquet(folder / "a.parquet", index=False)

    store("good/a", v=[1.0, 2.0])
    store("good/b", v=[3.0, 4.0])
    assert open_fragments(spark, str(tmp_path / "good"), verify=True).vars == ("v",)
    for case, columns in {"lacks": {"w": [1.0, 2.0]}, "type": {"v": [1, 2]}, "dims": {"v": [1.0, 2.0], "l_x": [0, 0]}}.items():
        store(f"{case}/a", v=[1.0, 2.0])
        store(f"{case}/b", **columns)
        with pytest.raises(FragmentError, match="differ"):
            open_fragments(spark, str(tmp_path / case), verify=True)


def test_declared_dimensions_read_fewer_coordinates(spark, stored):
    _, fragments, manifest, _ = stored
    declared = build_manifest(fragments, agg_dims=["x", "t"])
    assert sorted(tuple(r) for r in declared.coords.select("dim", "idx", "value").collect()) == sorted(
        tuple(r) for r in build_manifest(fragments).coords.select("dim", "idx", "value").collect()
    )
    scans = [s for s in scan_metrics(spark, declared.coords.filter("dim = 'x'")) if "c_x" in s[0]]
    assert scans[0][1] == 2  # of 40 fragments


def test_folders_with_text_names_are_listed_once(spark, tmp_path):
    from fragcube.sources import parquet

    def jobs(names):
        base = str(tmp_path / names[0])
        rows = [(n, 0, float(i)) for i, n in enumerate(names)]
        spark.createDataFrame(rows, "frag_id string, l_x long, v double").coalesce(1).write.partitionBy("frag_id").parquet(base)
        spark.sparkContext.setJobGroup(base, "listing")
        cells = parquet._read_folders(spark, base, [f"{base}/frag_id=*"])
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        assert sorted(r["frag_id"] for r in cells.select("frag_id").collect()) == sorted(names)
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(base))

    assert jobs([f"a{i}" for i in range(40)]) < jobs([f"{i:03d}" for i in range(40)])
