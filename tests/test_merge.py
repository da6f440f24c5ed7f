"""Merging, appending, storing and streaming."""

import numpy as np
import pytest
from grids import fragments_of, to_array
from pyspark.sql import functions as F

from fragcube import (
    batched_create, build_manifest, describe, extend_manifests, incremental_append, open_dataset,
    open_fragments, open_variable, read_manifest, write_fragments, write_manifest,
)
from fragcube.model import FragmentError
from fragcube.operators import merge
from fragcube.session import scratch_path
from fragcube.streaming.append import append_stream, current_placement

DIMS = ("t", "x")


@pytest.fixture(scope="module")
def fragments(spark):
    data = np.arange(10 * 6, dtype=float).reshape(10, 6)
    return data, fragments_of(spark, data, DIMS, {"t": [0, 3, 4, 8, 10], "x": [0, 2, 6]})


def placement(manifest):
    return sorted(tuple(r) for r in manifest.frags.select("frag_id", "f_t", "o_t", "s_t", "f_x", "o_x", "s_x").collect())


def only(fragments, ids):
    block = fragments.blocks[0]
    from dataclasses import replace

    return replace(fragments, blocks=(replace(block, cells=block.cells.filter(F.col("frag_id").isin(ids))),))


def test_extend_moves_offsets_and_coordinates(spark, fragments):
    data, whole = fragments
    late, early = only(whole, ["f4", "f5", "f6", "f7"]), only(whole, ["f0", "f1", "f2", "f3"])
    merged = extend_manifests([build_manifest(late), build_manifest(early)])
    once = build_manifest(whole)
    assert placement(merged) == placement(once)
    key = ["dim", "idx", "value"]
    assert sorted(tuple(r) for r in merged.coords.select(*key).collect()) == sorted(tuple(r) for r in once.coords.select(*key).collect())
    np.testing.assert_array_equal(to_array(open_variable(whole, merged, "v").to_df(), DIMS, data.shape), data)


def test_single_fragment_batches_extend(spark):
    whole = fragments_of(spark, np.arange(6.0), ("t",), {"t": [0, 2, 6]})
    parts = merge.partial_manifests(whole, F.substring("frag_id", 2, 9).cast("int"), 2)
    assert [p.n_frags for p in parts] == [1, 1]
    merged = extend_manifests(parts)
    assert merged.agg_dims == ["t"] and merged.dim("t").size == 6


@pytest.mark.parametrize("n", [1, 2, 3])
def test_batched_equals_one_shot(spark, fragments, n):
    _, whole = fragments
    batched = batched_create(whole, F.pmod(F.xxhash64("frag_id"), F.lit(n)), n)
    assert placement(batched) == placement(build_manifest(whole))


def test_extension_must_fit(spark, fragments):
    _, whole = fragments
    with pytest.raises(FragmentError):
        extend_manifests([build_manifest(only(whole, ["f0", "f1", "f2", "f3"])), build_manifest(only(whole, ["f4", "f6"]))])


def test_append_is_idempotent(spark, fragments):
    _, whole = fragments
    start = build_manifest(only(whole, ["f0", "f1", "f2", "f3"]))
    grown = incremental_append(start, whole)
    assert placement(grown) == placement(build_manifest(whole))
    assert incremental_append(grown, whole) is grown


def test_manifest_round_trip(spark, fragments):
    data, whole = fragments
    uris = whole.blocks[0].cells.select("frag_id").distinct().withColumn("uris", F.array(F.concat(F.lit("file:///d/"), "frag_id"), F.lit(None).cast("string")))
    from dataclasses import replace

    built = build_manifest(replace(whole, uris=uris))
    path = scratch_path(spark, "manifest")
    write_manifest(built, path)
    back = read_manifest(spark, path)
    assert back.dims == built.dims and placement(back) == placement(built)
    assert describe(back).count() == describe(built).count()
    dataset = open_dataset(spark, path, whole, substitutions={"/d/": "/e/"})
    assert dataset.sizes == {"t": 10, "x": 6}
    assert {r["uris"][0] for r in dataset.manifest.frags.filter("frag_id = 'f0'").collect()} == {"/e/f0"}
    assert dataset["v"].isel(t=slice(0, 2)).shape == (2, 6)
    with pytest.raises(FragmentError):
        open_dataset(spark, path, whole, drop=["v"])["v"]


def test_streaming_append(spark, fragments):
    data, whole = fragments
    source, stored, check = (scratch_path(spark, n) for n in ("arriving", "inventory", "progress"))
    block = whole.blocks[0]
    write_fragments(only(whole, ["f4", "f5", "f6", "f7"]).blocks[0], source)
    like = open_fragments(spark, source)
    append_stream(spark, source, like, stored, check).awaitTermination()
    first = current_placement(spark, stored, like)
    assert {d.dim: d.size for d in first.dims} == {"t": 6, "x": 6}
    only(whole, ["f0", "f1", "f2", "f3"]).blocks[0].cells.write.mode("append").partitionBy("frag_id").parquet(source)
    append_stream(spark, source, like, stored, check).awaitTermination()
    append_stream(spark, source, like, stored, check).awaitTermination()
    second = current_placement(spark, stored, like)
    assert second.full and {d.dim: d.size for d in second.dims} == {"t": 10, "x": 6}
    assert second.frags.count() == 8
