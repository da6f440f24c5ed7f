"""One test per check, and one per rule that is easy to get wrong."""

from dataclasses import replace

import numpy as np
import pytest
from grids import fragments_of, to_array
from pyspark.sql import functions as F

from fragcube import FragmentSet, build_manifest, open_variable
from fragcube.model import Block, FragmentError
from fragcube.operators import infer, inventory as inv


def line(spark, n=12, cuts=(0, 4, 8, 12), **kw):
    return fragments_of(spark, np.arange(n, dtype=float), ("t",), {"t": list(cuts)}, **kw)


def files(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_fewer_than_two_fragments(spark):
    with pytest.raises(FragmentError, match="fewer than two"):
        build_manifest(line(spark, cuts=(0, 12)))


def test_variable_sets_differ(spark):
    names = files(spark, [("a", 0, "p"), ("a", 0, "q"), ("b", 1, "p"), ("c", 2, "p"), ("c", 2, "q"), ("c", 2, "r")], "frag_id string, file_ord int, var string")
    got = {tuple(r) for r in inv.check_var_set(names).collect()}
    assert got == {("b", "q", "missing"), ("c", "r", "extra")}
    with pytest.raises(FragmentError):
        inv.require_none(inv.check_var_set(names), "variables")


def test_dimension_sets_differ(spark):
    names = files(spark, [("a", 0, "t"), ("b", 1, "t"), ("b", 1, "x")], "frag_id string, file_ord int, dim string")
    assert [tuple(r) for r in inv.check_dim_set(names).collect()] == [("b", "x", "extra")]


def test_info_mismatch_and_nan(spark):
    info = files(
        spark,
        [("a", "p", "dtype", "double"), ("b", "p", "dtype", "float"), ("a", "p", "fill", "NaN"), ("b", "p", "fill", "NaN"),
         ("a", "p", "dims", None), ("b", "p", "dims", None), ("a", "q", "fill", None), ("b", "q", "fill", "0")],
        "frag_id string, item string, prop string, value string",
    )
    assert {(r["item"], r["prop"]) for r in inv.check_info_match(info).collect()} == {("p", "dtype"), ("q", "fill")}


def test_mixed_inputs(spark):
    assert inv.check_mixed_inputs(files(spark, [(True,), (False,)], "is_aggregated boolean")).first()["mixed"] == 1
    assert inv.check_mixed_inputs(files(spark, [(True,), (True,)], "is_aggregated boolean")).first()["mixed"] == 0


def test_attribute_merge_cases(spark):
    rows = [
        ("a", 0, "global", "", "same", "1"), ("b", 1, "global", "", "same", "1"),
        ("a", 0, "global", "", "differs", "1"), ("b", 1, "global", "", "differs", "2"),
        ("a", 0, "global", "", "first_only", "x"), ("b", 1, "global", "", "late", "y"),
        ("a", 0, "var", "p", "_FillValue", "1"),
    ]
    merged = inv.merge_attrs(files(spark, rows, "frag_id string, file_ord int, scope string, owner string, attr string, value string"), "MSG")
    got = {r["attr"]: (r["value"], r["warning"] is not None) for r in merged.collect()}
    assert got == {"same": ("1", False), "differs": ("MSG", False), "first_only": ("x", False), "late": ("MSG", True)}


def test_declared_dimensions_compare_by_name(spark):
    fragments = line(spark)
    assert build_manifest(fragments, agg_dims=["t"]).agg_dims == ["t"]
    with pytest.raises(FragmentError):
        build_manifest(fragments, agg_dims=["x"])
    classes = infer.classify_dims(inv.dim_inventory(fragments))
    assert {tuple(r) for r in infer.check_agg_dims(classes, ["x"]).collect()} == {("t", "not declared"), ("x", "not aggregated")}


def test_identical_check_reads_every_file(spark):
    values = files(spark, [("w", 0, 1.0), ("w", 0, 1.0), ("w", 0, 2.0), ("w", 1, float("nan")), ("w", 1, float("nan")), ("w", 2, None), ("w", 2, None)], "var string, idx int, value double")
    got = {r["idx"]: r["same"] for r in infer.check_identical(values, ["var", "idx"]).collect()}
    assert got == {0: False, 1: True, 2: True}


def test_hole_in_the_grid(spark):
    data = np.arange(16, dtype=float).reshape(4, 4)
    fragments = fragments_of(spark, data, ("t", "x"), {"t": [0, 2, 4], "x": [0, 2, 4]}, drop=(1,))
    with pytest.raises(FragmentError, match="hole"):
        build_manifest(fragments)


def test_two_files_at_one_position(spark):
    fragments = line(spark)
    block = fragments.blocks[0]
    twin = block.cells.filter("frag_id = 'f1'").withColumn("frag_id", F.lit("g1"))
    doubled = FragmentSet((replace(block, cells=block.cells.unionByName(twin)),))
    with pytest.raises(FragmentError, match="double"):
        build_manifest(doubled)


def test_same_start_other_length(spark):
    data = np.arange(16, dtype=float).reshape(4, 4)
    block = fragments_of(spark, data, ("t", "x"), {"t": [0, 2, 4], "x": [0, 2, 4]}).blocks[0]
    short = block.cells.filter("not (frag_id = 'f1' and l_t = 1)")
    with pytest.raises(FragmentError, match="size"):
        build_manifest(FragmentSet((replace(block, cells=short),)))


def test_validation_finds_gaps_overlaps_and_row_sums(spark):
    axes = files(spark, [("t", 0, 0, 4), ("t", 1, 5, 4), ("x", 0, 0, 3), ("x", 1, 2, 3)], "dim string, frag_pos long, offset long, size long")
    frags = files(spark, [(f"f{i}{j}", 0, i, j) for i in (0, 1) for j in (0, 1)], "frag_id string, file_ord int, f_t long, f_x long")
    got = {(r["check"], r["item"]) for r in infer.validate_manifest(axes, frags, {"t": 2, "x": 2}, {"t": 9, "x": 6}).collect()}
    assert got == {("gap", "t:1"), ("overlap", "x:1"), ("row_sum", "t")}


def test_updates_then_removals(spark):
    rows = [("a", 0, "global", "", "title", "x"), ("b", 1, "global", "", "title", "x"), ("a", 0, "var", "v", "units", "K"), ("b", 1, "var", "v", "units", "K"),
            ("a", 0, "global", "", "Conventions", "CF-1.6"), ("b", 1, "global", "", "Conventions", "CF-1.6")]
    attrs = files(spark, rows, "frag_id string, file_ord int, scope string, owner string, attr string, value string")
    fragments = replace(line(spark), attrs=attrs)
    manifest = build_manifest(fragments, updates={"test_name": "alpha", "test_remove": "not removed", "v.units": "m", "zz.units": "m"}, removals=["test_remove", "absent"])
    got = {(r["owner"], r["attr"]): r["value"] for r in manifest.attrs.collect()}
    assert got == {("", "title"): "x", ("", "test_name"): "alpha", ("v", "units"): "m", ("", "Conventions"): "CF-1.12"}
    _, unknown = infer.apply_updates(inv.merge_attrs(attrs).drop("warning"), {"zz.units": "m"})
    assert [tuple(r) for r in unknown.collect()] == [("zz", "units")]
    _, absent = infer.apply_removals(inv.merge_attrs(attrs).drop("warning"), ["absent", "v.units"])
    assert [tuple(r) for r in absent.collect()] == [("", "absent")]
    kept, _ = infer.apply_removals(inv.merge_attrs(attrs).drop("warning"), ["v.units"])
    assert {r["attr"] for r in kept.collect()} == {"title", "Conventions"}


def test_variable_without_an_aggregated_dimension(spark):
    data = np.arange(24, dtype=float).reshape(6, 4)
    block = fragments_of(spark, data, ("t", "x"), {"t": [0, 2, 6], "x": [0, 1, 4]}).blocks[0]
    by_t = block.cells.groupBy("frag_id", "file_ord", "l_t", "c_t").agg(F.max(F.col("c_t") * 2).alias("w"))
    fragments = FragmentSet((block, Block(("t",), ("t",), ("w",), by_t)))
    manifest = build_manifest(fragments)
    got = to_array(open_variable(fragments, manifest, "w").to_df(), ("t",), (6,), "w")
    np.testing.assert_array_equal(got, np.arange(6) * 2.0)
    kinds = {r["var"]: r["class"] for r in manifest.vars.collect()}
    assert kinds == {"v": "aggregated", "w": "aggregated"}


def test_names_with_underscores(spark):
    data = np.arange(12, dtype=float).reshape(6, 2)
    fragments = fragments_of(spark, data, ("time_bnds", "n_v"), {"time_bnds": [0, 3, 6], "n_v": [0, 2]})
    manifest = build_manifest(fragments)
    assert manifest.agg_dims == ["time_bnds"]
    np.testing.assert_array_equal(to_array(open_variable(fragments, manifest, "v").to_df(), ("time_bnds", "n_v"), (6, 2)), data)


def test_unaligned_file_order(spark):
    """Three and more files in any order end up by their start."""
    for seed in range(4):
        manifest = build_manifest(line(spark, cuts=(0, 1, 3, 6, 10, 12), seed=seed), with_coords=False)
        got = [(r["frag_pos"], r["offset"], r["size"]) for r in manifest.dim_frags.orderBy("frag_pos").collect()]
        assert got == [(0, 0, 1), (1, 1, 2), (2, 3, 3), (3, 6, 4), (4, 10, 2)]


def test_same_start_other_values(spark):
    data = np.arange(16, dtype=float).reshape(4, 4)
    block = fragments_of(spark, data, ("t", "x"), {"t": [0, 2, 4], "x": [0, 4]}).blocks[0]
    moved = block.cells.withColumn("c_x", F.when((F.col("frag_id") == "f1") & (F.col("l_x") == 3), 9.5).otherwise(F.col("c_x")))
    with pytest.raises(FragmentError, match="values"):
        build_manifest(FragmentSet((replace(block, cells=moved),)))


def test_identical_variables_must_agree(spark):
    data = np.arange(12, dtype=float).reshape(6, 2)
    block = fragments_of(spark, data, ("t", "x"), {"t": [0, 2, 4, 6], "x": [0, 2]}).blocks[0]
    held = block.cells.select("frag_id", "file_ord", "l_x", "c_x").distinct()
    same = Block(("x",), ("x",), ("w",), held.withColumn("w", F.col("c_x") * 3))
    assert {r["var"]: r["class"] for r in build_manifest(FragmentSet((block, same))).vars.collect()} == {"v": "aggregated", "w": "identical"}
    third = Block(("x",), ("x",), ("w",), held.withColumn("w", F.when(F.col("frag_id") == "f2", 1.0).otherwise(0.0)))
    with pytest.raises(FragmentError, match="not aggregated differ"):
        build_manifest(FragmentSet((block, third)))
    assert build_manifest(FragmentSet((block, third)), check_values=False).n_frags == 3


def test_negative_zero_start(spark):
    fragments = fragments_of(spark, np.arange(4.0), ("t",), {"t": [0, 2, 4]}, coords={"t": np.array([-0.0, 1.0, 2.0, 3.0])})
    assert build_manifest(fragments).dim("t").size == 4
