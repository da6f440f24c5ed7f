"""Assembly, selection and reduction against numpy."""

import numpy as np
import pytest
from grids import cut_points, fragments_of, to_array
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from fragcube import build_manifest, open_variable
from fragcube.model import FragmentError
from fragcube.operators import array as ops

DIMS = ("t", "y", "x")


@pytest.fixture(scope="module")
def cube(spark):
    rng = np.random.default_rng(1)
    data = rng.normal(size=(11, 7, 5))
    data[3, 2, 1] = np.nan
    cuts = {"t": [0, 4, 5, 11], "y": [0, 7], "x": [0, 2, 5]}
    fragments = fragments_of(spark, data, DIMS, cuts)
    return data, fragments, build_manifest(fragments)


@pytest.mark.parametrize("seed", range(3))
def test_random_cuts_reassemble(spark, seed):
    rng = np.random.default_rng(seed)
    shape = tuple(rng.integers(2, 9, size=3))
    data = rng.normal(size=shape)
    cuts = {d: cut_points(rng, int(n), int(rng.integers(1, 4))) for d, n in zip(DIMS, shape)}
    if all(len(c) == 2 for c in cuts.values()):
        cuts["t"] = [0, 1, int(shape[0])]
    fragments = fragments_of(spark, data, DIMS, cuts, seed=seed)
    manifest = build_manifest(fragments)
    assert [d.size for d in manifest.dims] == list(shape)
    assert [d.f_size for d in manifest.dims] == [len(cuts[d]) - 1 for d in DIMS]
    out = to_array(open_variable(fragments, manifest, "v").to_df(), DIMS, shape)
    np.testing.assert_array_equal(out, data)


def test_descending_and_text_axes(spark):
    data = np.arange(6 * 4, dtype=float).reshape(6, 4)
    coords = {"lat": np.linspace(90, -90, 6), "name": np.array(["ant", "bee", "cat", "dog"])}
    fragments = fragments_of(spark, data, ("lat", "name"), {"lat": [0, 2, 5, 6], "name": [0, 1, 4]}, coords=coords)
    manifest = build_manifest(fragments)
    assert manifest.dim("lat").descending and not manifest.dim("name").descending
    out = to_array(open_variable(fragments, manifest, "v").to_df(), ("lat", "name"), (6, 4))
    np.testing.assert_array_equal(out, data)
    axis = {r["idx"]: r["value"] for r in manifest.coords.filter("dim = 'lat'").collect()}
    np.testing.assert_allclose([axis[i] for i in range(6)], coords["lat"])
    names = {r["idx"]: r["value_s"] for r in manifest.coords.filter("dim = 'name'").collect()}
    assert [names[i] for i in range(4)] == list(coords["name"])


def test_pure_dimension(spark):
    data = np.arange(6 * 3, dtype=float).reshape(6, 3)
    fragments = fragments_of(spark, data, ("t", "p"), {"t": [0, 2, 6], "p": [0, 3]}, coords={"t": np.arange(6.0)})
    manifest = build_manifest(fragments)
    assert manifest.agg_dims == ["t"] and manifest.coord_dims == ["t"] and manifest.pure_dims == ["p"]
    np.testing.assert_array_equal(to_array(open_variable(fragments, manifest, "v").to_df(), ("t", "p"), (6, 3)), data)


index = st.one_of(
    st.integers(-5, 4),
    st.builds(
        slice, st.one_of(st.none(), st.integers(-13, 13)), st.one_of(st.none(), st.integers(-13, 13)),
        st.one_of(st.none(), st.sampled_from([1, 2, 3, 7])),
    ),
)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(t=index, y=index, x=index)
def test_isel_follows_numpy(cube, t, y, x):
    data, fragments, manifest = cube
    picks = {"t": t, "y": y, "x": x}
    picked = open_variable(fragments, manifest, "v").isel(**picks)
    want = data[t, y, x]
    assert picked.shape == want.shape
    got = picked.to_df().toPandas()
    assert len(got) == want.size
    kept = [d for d in DIMS if isinstance(picks[d], slice)]
    if kept and len(got):
        got = got.sort_values(kept)
    np.testing.assert_array_equal(got["v"].to_numpy(dtype=float).reshape(want.shape), want)


def test_isel_twice_and_bad_index(cube):
    data, fragments, manifest = cube
    variable = open_variable(fragments, manifest, "v")
    twice = variable.isel(t=slice(2, 10, 2)).isel(t=slice(1, 3), y=0)
    want = data[2:10:2][1:3, 0]
    assert twice.shape == want.shape
    got = twice.to_df().orderBy("t", "x").toPandas()["v"].to_numpy(dtype=float).reshape(want.shape)
    np.testing.assert_array_equal(got, want)
    with pytest.raises(IndexError):
        variable.isel(t=11)
    with pytest.raises(FragmentError):
        variable.isel(z=1)


def test_zero_stop_means_empty(cube):
    _, fragments, manifest = cube
    picked = open_variable(fragments, manifest, "v").isel(t=slice(0, 0))
    assert picked.shape == (0, 7, 5) and picked.to_df().count() == 0


def test_size_one_slice_keeps_its_dimension(cube):
    _, fragments, manifest = cube
    picked = open_variable(fragments, manifest, "v").isel(t=slice(3, 4))
    assert picked.shape == (1, 7, 5) and "t" in picked.to_df().columns


def test_reductions_skip_missing(cube):
    data, fragments, manifest = cube
    variable = open_variable(fragments, manifest, "v")
    row = variable.reduce(["mean", "sum", "min", "max", "count", "std", "var"]).first()
    for how, fn in (("mean", np.nanmean), ("sum", np.nansum), ("min", np.nanmin), ("max", np.nanmax), ("std", np.nanstd), ("var", np.nanvar)):
        assert row[f"v_{how}"] == pytest.approx(fn(data))
    assert row["v_count"] == np.isfinite(data).sum()
    by_x = variable.reduce("mean", "t", "y").orderBy("x").toPandas()["v_mean"]
    np.testing.assert_allclose(by_x, np.nanmean(data, axis=(0, 1)))
    with pytest.raises(FragmentError):
        variable.reduce("median")
    with pytest.raises(FragmentError):
        variable.reduce("mean", "z")


def test_sel(cube):
    data, fragments, manifest = cube
    variable = open_variable(fragments, manifest, "v")
    assert variable.sel(t=slice(3, 6)).to_df().count() == data[3:7].size
    assert variable.sel(t=4.0, x=slice(None, 1)).to_df().count() == data[4, :, :2].size
    near = variable.sel(method="nearest", t=6.4).to_df()
    assert "t" not in near.columns and near.count() == data[6].size


def test_reshape_matches_numpy(cube):
    data, fragments, manifest = cube
    cells = open_variable(fragments, manifest, "v").to_df()
    out = to_array(ops.reshape(cells, list(DIMS), list(data.shape), {"a": 35, "b": 11}), ("a", "b"), (35, 11))
    np.testing.assert_array_equal(out, data.reshape(35, 11))
    with pytest.raises(FragmentError):
        ops.reshape(cells, list(DIMS), list(data.shape), {"a": 3})


def test_chunks_stay_in_fragments(cube):
    data, fragments, manifest = cube
    chunks = ops.chunk_extents(manifest.frags, list(DIMS), {"t": 2, "x": 2}).toPandas()
    covered = np.zeros(data.shape, dtype=int)
    for row in chunks.itertuples():
        covered[row.start_t:row.stop_t, row.start_y:row.stop_y, row.start_x:row.stop_x] += 1
    assert (covered == 1).all()
    assert ((chunks["stop_t"] - chunks["start_t"]) <= 2).all()
    counted = ops.rechunk(fragments.blocks[0], {"t": 2, "x": 2}).groupBy("frag_id", "k_t", "k_y", "k_x").count()
    assert counted.count() == len(chunks)


def test_fill_unique_in_three_dimensions(cube):
    from pyspark.sql import functions as F

    data, _, manifest = cube
    frags = manifest.frags.withColumn("u", (F.col("o_t") * 10 + F.col("o_x")).cast("double"))
    out = to_array(ops.fill_unique(frags, list(DIMS), "u", piece=8), DIMS, data.shape, "u")
    want = np.zeros(data.shape)
    for a, b in ((0, 4), (4, 5), (5, 11)):
        for c, d in ((0, 2), (2, 5)):
            want[a:b, :, c:d] = a * 10 + c
    np.testing.assert_array_equal(out, want)


def test_chunk_rows_round_trip(cube):
    data, fragments, _ = cube
    block, chunks = fragments.blocks[0], {"t": 3, "y": 4, "x": 2}
    rows = ops.pack_chunks(block, "v", chunks)
    assert rows.filter("size(data) > 24 or size(data) <> aggregate(shape, 1L, (a, n) -> a * n)").count() == 0
    back = ops.unpack_chunks(rows, list(DIMS), "v", chunks)
    key = ["frag_id", "l_t", "l_y", "l_x"]
    got = back.orderBy(*key).toPandas()
    want = block.cells.select(*key, "v").orderBy(*key).toPandas()
    np.testing.assert_array_equal(got[key].to_numpy(), want[key].to_numpy())
    np.testing.assert_array_equal(got["v"].to_numpy(), want["v"].to_numpy())
    with pytest.raises(FragmentError):
        ops.pack_chunks(block, "v", {"t": 3})
