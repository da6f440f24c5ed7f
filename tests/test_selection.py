"""Selections by index and by coordinate against numpy."""

import datetime
from dataclasses import replace

import numpy as np
import pytest
from grids import fragments_of
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fragcube import FragmentError, build_manifest, open_variable
from fragcube.operators.array import Points, Range, picked

DATA = np.random.default_rng(4).normal(size=(23, 7))


@pytest.fixture(scope="module")
def variable(spark):
    fragments = fragments_of(spark, DATA, ("t", "x"), {"t": [0, 3, 10, 11, 23], "x": [0, 4, 7]})
    cells = fragments.blocks[0].cells.cache()
    fragments = replace(fragments, blocks=(replace(fragments.blocks[0], cells=cells),))
    return open_variable(fragments, build_manifest(fragments), "v")


def numbered(variable):
    df = variable.to_df(numbered=True)
    rows = df.toPandas()
    assert len(rows) == int(np.prod(variable.shape))
    out = np.full(variable.shape, np.nan)
    out[tuple(rows[d].to_numpy() for d in df.columns[:-1])] = rows["v"].to_numpy()
    return out


index = st.one_of(
    st.integers(-30, 30), st.lists(st.integers(-30, 30), min_size=1, max_size=5),
    st.builds(slice, st.one_of(st.none(), st.integers(-30, 30)), st.one_of(st.none(), st.integers(-30, 30)), st.sampled_from([None, 1, 2, 3, -1, -2, -5])),
)


@settings(max_examples=300, deadline=None)
@given(size=st.integers(0, 25), chain=st.lists(index, min_size=1, max_size=4))
def test_chains_of_indices_follow_numpy(size, chain):
    kept, want = range(size), np.arange(size)
    for i in chain:
        try:
            expected = want[i]
        except IndexError:
            with pytest.raises(IndexError):
                picked(kept, i)
            return
        pick = picked(kept, i)
        if np.ndim(expected) == 0:
            assert pick.scalar and list(pick.indices) == [expected]
            return
        assert list(pick.indices) == expected.tolist()
        kept, want = pick.indices, expected
    inside = [v for v in range(-1, size + 1) if eval_sql(pick.cells("i"), v)]
    assert inside == sorted(set(want.tolist()))
    if isinstance(pick, Range):
        assert [eval(pick.place(str(v)).replace("div", "//")) for v in want.tolist()] == list(range(len(want)))
    for offset in range(0, size, 3):
        meets = any(offset <= v < offset + 3 for v in want.tolist())
        assert isinstance(pick, Points) or eval_sql(pick.fragments(str(offset), "3"), 0) == meets


def eval_sql(text, i):
    """A predicate of a selection, as Python."""
    text = text.replace(" = ", " == ")
    if " in (" in text:
        text = text.replace("(", "[").replace(")", "]")
    return bool(eval(text, {"i": i, "false": False, "pmod": lambda a, b: a % b, "greatest": max}))


@pytest.mark.parametrize("key", [
    (slice(None, None, -1), slice(None)), (slice(20, 2, -3), slice(5, 1, -2)), ([3, 1, 1], slice(None)), ([3, -1, 3], [6, 0]), (slice(None, None, -1), 3), (5, [2, 2]),
])
def test_order_and_repeats(variable, key):
    got = numbered(variable.isel(t=key[0], x=key[1]))
    want = DATA[key[0]][..., key[1]] if not isinstance(key[0], int) else DATA[key[0], key[1]]
    np.testing.assert_array_equal(got, want)


def test_chains_on_cells(variable):
    chain = variable.isel(t=slice(None, None, -1)).isel(t=slice(1, 12, 2), x=[4, 4, 0]).isel(t=[0, 0, 3])
    np.testing.assert_array_equal(numbered(chain), DATA[::-1][1:12:2][[0, 0, 3]][:, [4, 4, 0]])
    assert numbered(variable.isel(t=slice(None, None, -1)).isel(t=0)).tolist() == DATA[-1].tolist()
    assert chain.reduce("sum").first()["v_sum"] == pytest.approx(DATA[::-1][1:12:2][[0, 0, 3]][:, [4, 4, 0]].sum())
    assert variable.isel(t=[1, 1]).to_df().count() == 14
    with pytest.raises(IndexError):
        variable.isel(t=23)


def test_labels_and_ranges(variable):
    assert variable.sel(t=slice(3, 6)).shape == (4, 7) and variable.sel(t=4.0).shape == (7,)
    np.testing.assert_array_equal(numbered(variable.sel(t=slice(10, 12)).isel(t=0)), DATA[10])
    np.testing.assert_array_equal(numbered(variable.isel(t=slice(None, None, -2)).sel(t=slice(5.5, 15))), DATA[14:5:-2])
    np.testing.assert_array_equal(numbered(variable.isel(t=[9, 2, 9, 20]).sel(t=slice(3, 10))), DATA[[9, 9]])
    np.testing.assert_array_equal(numbered(variable.sel(method="nearest", t=6.4, x=100)), DATA[6, 6])
    assert variable.sel(t=slice(2.2, 2.8)).shape == (0, 7) and variable.sel(t=slice(2.2, 2.8)).to_df().count() == 0
    for wrong in ({"t": 2.5}, {"t": 99}, {"t": "a"}):
        with pytest.raises(KeyError):
            variable.sel(**wrong)
    with pytest.raises(KeyError):
        variable.isel(t=slice(0, 5)).sel(t=7.0)
    with pytest.raises(FragmentError):
        variable.sel(t=4.0).sel(t=4.0)


def axis(spark, values, cuts):
    data = np.arange(float(len(values)))
    fragments = fragments_of(spark, data, ("k",), {"k": cuts}, coords={"k": np.array(values, dtype=object)})
    return open_variable(fragments, build_manifest(fragments), "v")


def test_dates(spark):
    days = [datetime.date(2024, 1, 1) + datetime.timedelta(days=3 * i) for i in range(8)]
    v = axis(spark, days, [0, 3, 5, 8])
    assert [r["v"] for r in v.sel(k=slice(datetime.date(2024, 1, 5), datetime.date(2024, 1, 13))).to_df().orderBy("k").collect()] == [2.0, 3.0, 4.0]
    assert v.sel(k=days[6]).to_df().first()["v"] == 6.0 and v.sel(method="nearest", k=datetime.date(2024, 1, 8)).to_df().first()["v"] == 2.0
    with pytest.raises(KeyError):
        v.sel(k=datetime.date(2024, 1, 2))


def test_text(spark):
    v = axis(spark, ["ant", "bee", "cat", "dog", "elk", "fox"], [0, 2, 4, 6])
    assert v.sel(k="dog").to_df().first()["v"] == 3.0 and v.sel(k=slice("b", "dz")).shape == (3,)
    # pieces outside the range of text are left out before any cell is read
    assert v.sel(k=slice("b", "dz")).fragments().count() == 2 and v.sel(k="elk").fragments().count() == 1
    with pytest.raises(KeyError):
        v.sel(k="cow")
    with pytest.raises(KeyError):
        v.sel(k=3)


def test_falling_axis(spark):
    data = np.arange(6.0)
    fragments = fragments_of(spark, data, ("lat",), {"lat": [0, 2, 6]}, coords={"lat": np.array([90.0, 60, 30, 0, -30, -60])})
    v = open_variable(fragments, build_manifest(fragments), "v")
    for span in (slice(60, -30), slice(-30, 60)):
        np.testing.assert_array_equal(numbered(v.sel(lat=span)), [1, 2, 3, 4])
    assert v.sel(lat=30).to_df().first()["v"] == 2.0 and v.sel(method="nearest", lat=-44).to_df().first()["v"] == 4.0


def test_without_coordinates(spark):
    fragments = fragments_of(spark, np.arange(6.0), ("t",), {"t": [0, 2, 6]})
    v = open_variable(fragments, build_manifest(fragments, with_coords=False), "v")
    assert v.sel(t=slice(1, 3)).to_df().agg(F.sum("v")).first()[0] == 6.0
    with pytest.raises(FragmentError, match="not known"):
        v.sel(t=slice(1, 3)).isel(t=0)
