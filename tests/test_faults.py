"""What must be an error instead of a silently wrong aggregation."""

import datetime

import numpy as np
import pytest
from grids import fragments_of, to_array

from fragcube import FragmentSet, build_manifest, open_fragments
from fragcube.functions.axis import bound_key
from fragcube.model import Block, FragmentError
from fragcube.operators.array import open_variable
from fragcube.operators.merge import extend_manifests
from fragcube.session import scratch_root
from fragcube.sources.parquet import open_files


def line(spark, pieces):
    """Fragments of one dimension: name -> [(local index, coordinate, value)]."""
    rows = [(f, i, *cell) for i, (f, cells) in enumerate(pieces.items()) for cell in cells]
    cells = spark.createDataFrame(rows, "frag_id string, file_ord long, l_t long, c_t double, v double")
    return FragmentSet((Block(("t",), ("t",), ("v",), cells),))


def run_of(start, n, step=1):
    return [(i, float(start + i * step), float(start + i * step)) for i in range(n)]


def test_whole_pieces_are_accepted(spark):
    assert build_manifest(line(spark, {"a": run_of(0, 4), "b": run_of(4, 3)})).dim("t").size == 7


@pytest.mark.parametrize("pieces", [
    {"a": run_of(0, 10), "b": run_of(5, 10)},  # ranges meet
    {"a": run_of(0, 3), "b": run_of(5, 3, -1)},  # rising and falling
    {"a": run_of(0, 3), "b": [(0, 3.0, 3.0), (2, 5.0, 5.0), (2, 5.0, 5.0)]},  # a cell missing, one twice
    {"a": run_of(0, 3), "b": [(0, 3.0, 3.0), (2, 5.0, 5.0)]},  # a cell missing
], ids=["overlap", "direction", "doubled", "missing"])
def test_faulty_pieces_are_errors(spark, pieces):
    with pytest.raises(FragmentError):
        build_manifest(line(spark, pieces))


def test_equal_names_of_different_fragments(spark):
    one = build_manifest(line(spark, {"f0": run_of(0, 5), "f1": run_of(5, 5)}))
    two = build_manifest(line(spark, {"f0": run_of(10, 5), "f1": run_of(15, 5)}))
    with pytest.raises(FragmentError):
        extend_manifests([one, two])
    other = build_manifest(line(spark, {"g0": run_of(10, 5), "g1": run_of(15, 5)}))
    assert extend_manifests([one, other]).dim("t").size == 20


def write_file(folder, name, start):
    import pandas as pd

    frame = pd.DataFrame({"l_t": range(4), "c_t": np.arange(start, start + 4.0), "v": np.arange(start, start + 4.0)})
    frame.to_parquet(folder / name)
    return str(folder / name)


def test_files_with_odd_names(spark, tmp_path):
    odd = tmp_path / "with space+plus"
    odd.mkdir()
    paths = [write_file(odd, n, 4 * i) for i, n in enumerate(("a b.parquet", "c+d.parquet", "plain.parquet"))]
    fragments = open_files(spark, paths)
    manifest = build_manifest(fragments)
    assert (manifest.n_frags, manifest.dim("t").size) == (3, 12)
    np.testing.assert_array_equal(to_array(open_variable(fragments, manifest, "v").to_df(), ("t",), (12,)), np.arange(12.0))


def test_fragment_names_stay_text(spark, tmp_path):
    for name, start in (("007", 0), ("7", 4)):
        (tmp_path / f"frag_id={name}").mkdir()
        write_file(tmp_path / f"frag_id={name}", "x.parquet", start)
    block = open_fragments(spark, str(tmp_path))
    assert {r["frag_id"] for r in block.cells.select("frag_id").distinct().collect()} == {"007", "7"}


def test_dates_on_a_timestamp_axis():
    day = datetime.date(2024, 5, 1)
    assert bound_key(day, "timestamp_ntz") == bound_key(datetime.datetime(2024, 5, 1))
    assert bound_key(day, "date") == bound_key(day)


def test_scratch_needs_a_shared_folder(spark):
    class Conf:
        def __init__(self, values):
            self.values = values

        def get(self, key, default=None):
            return self.values.get(key, default)

    class Session:
        def __init__(self, **values):
            self.conf = Conf({k.replace("_", "."): v for k, v in values.items()})
            self.sparkContext = spark.sparkContext

    assert scratch_root(Session(spark_checkpoint_dir="hdfs://x/y/", **{"spark_master": "yarn"})) == "hdfs://x/y"
    with pytest.raises(ValueError):
        scratch_root(Session(spark_master="yarn"))
    with pytest.raises(ValueError):
        scratch_root(Session(spark_master="local-cluster[3,2,1024]"))
    assert scratch_root(Session(spark_master="local[4]"))


def test_conventions_of_other_kinds(spark):
    from pyspark.sql import functions as F

    from fragcube.functions.text import raise_conventions

    rows = [("CF-1.6",), ("CFA-0.6.2",), ("CF-2.0",), ("CF-1.6, CFA-0.6.2",), ("ACDD-1.3 CF-1.12",)]
    got = [r[0] for r in spark.createDataFrame(rows, "c string").select(raise_conventions(F.col("c"))).collect()]
    assert got[1:3] == ["CFA-0.6.2", "CF-2.0"] and "CFA-0.6.2" in got[3] and got[4] == "ACDD-1.3 CF-1.12"
    assert got[0].startswith("CF-1.") and got[0] != "CF-1.6"


def test_units_of_time(spark):
    from pyspark.sql import functions as F

    from fragcube.functions.cf import decode_times

    rows = [(1.0, u) for u in ("h since 2024-01-01", "hours since 2024-01-01 UTC", "min since 2024-01-01", "s since 2024-01-01T00:00:00Z")]
    got = [r[0] for r in spark.createDataFrame(rows, "v double, u string").select(decode_times(F.col("v"), F.col("u"))).collect()]
    at = datetime.datetime(2024, 1, 1)
    assert got == [at + datetime.timedelta(seconds=s) for s in (3600, 3600, 60, 1)]
    with pytest.raises(Exception, match="not a unit of time"):
        spark.createDataFrame([(1.0, "months since 2024-01-01")], "v double, u string").select(decode_times(F.col("v"), F.col("u"))).collect()
