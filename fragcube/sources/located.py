"""Scan fragments from a table of their locations.

Where fragments are known from a manifest alone, their names are rows of a
table, possibly millions.  No list of them is gathered: the table itself is
dealt over the tasks, twice.

1. A task takes locations and opens the first that exists of each fragment's
   versions.  From the footers it makes a row per row group, leaves out row groups
   whose statistics exclude the selection, and compares names and types of the
   columns with what the manifest says.
2. Row groups are dealt anew, so a fragment of many is read by many tasks, and
   each is read for the wanted columns only.

A location is a Parquet file or a folder of such files.  A fragment none of whose
locations exists, or whose file lacks a column or has it in another type, is an error
that names it.  Both steps use as many tasks as ``spark.sql.shuffle.partitions``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import from_arrow_type, to_arrow_schema
from pyspark.sql.types import StructType

from ..model import FragmentError

UNITS = pa.schema([("frag_id", pa.string()), ("path", pa.string()), ("part", pa.int32())])
#: Rows of a row group that one Arrow batch carries.
BATCH_ROWS = 65_536


@dataclass(frozen=True)
class Column:
    """A wanted column: its name in the result, the name that fragments know it by, and its Spark type."""

    name: str
    stored: str
    dtype: str


def store_of(location: str):
    """File system of a location and the path inside it."""
    import pyarrow.fs as pafs

    uri = "file://" + location[len("file:"):] if location.startswith("file:/") and not location.startswith("file://") else location
    uri = re.sub("^s3[an]://", "s3://", uri)  # names of the same store
    if "://" not in uri:
        return pafs.LocalFileSystem(), uri
    scheme, rest = uri.split("://", 1)
    if scheme == "file":
        return pafs.LocalFileSystem(), "/" + rest.lstrip("/")
    return pafs.FileSystem.from_uri(uri)


def files_at(location: str) -> list[str] | None:
    """The Parquet files of a location, in order of their names; None where nothing is."""
    import pyarrow.fs as pafs

    store, inner = store_of(location)
    info = store.get_file_info(inner)
    if info.type == pafs.FileType.NotFound:
        return None
    if info.type == pafs.FileType.File:
        return [location]
    inside = store.get_file_info(pafs.FileSelector(inner, recursive=True))
    names = sorted(f.path for f in inside if f.type == pafs.FileType.File and not f.base_name.startswith(("_", ".")))
    return [location.rstrip("/") + n[len(inner.rstrip("/")):] for n in names] or None


def _excluded(group, place: int, low, high) -> bool:
    """Whether the statistics of a row group leave no value from ``low`` to ``high``; either may be None."""
    stats = group.column(place).statistics
    if stats is None or not stats.has_min_max:
        return False
    try:
        return (low is not None and stats.max < low) or (high is not None and stats.min > high)
    except TypeError:  # kinds that do not compare, such as a date and a time
        return False


def _units(frag_id: str, uris: list[str | None], columns: list[Column], bounds: list[tuple]) -> Iterator[tuple]:
    import pyarrow.parquet as pq

    tried = [u for u in uris or [] if u]
    found = next((files for files in map(files_at, tried) if files), None)
    if found is None:
        raise FragmentError(f"fragment {frag_id!r}: none of its locations exists: {tried[:5]}")
    for path in found:
        store, inner = store_of(path)
        with store.open_input_file(inner) as handle:
            header = pq.ParquetFile(handle)
            held = {f.name: f.type for f in header.schema_arrow}
            for c in columns:
                if c.stored not in held:
                    raise FragmentError(f"fragment {frag_id!r}: {path} lacks {c.stored!r}")
                kind = from_arrow_type(held[c.stored], prefer_timestamp_ntz=True).simpleString()
                if kind != c.dtype:
                    raise FragmentError(f"fragment {frag_id!r}: {c.stored!r} is {kind} in {path}, not {c.dtype}")
            places = {header.metadata.schema.column(i).path: i for i in range(len(header.metadata.schema))}
            for part in range(header.metadata.num_row_groups):
                group = header.metadata.row_group(part)
                if not any(_excluded(group, places[name], low, high) for name, low, high in bounds if name in places):
                    yield frag_id, path, part


def row_groups(located: DataFrame, columns: list[Column], bounds: list[tuple] = ()) -> DataFrame:
    """A row per row group to read of fragments ``(frag_id, uris)``; ``bounds`` are (stored name, low, high)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [u for f, v in zip(b.column("frag_id").to_pylist(), b.column("uris").to_pylist()) for u in _units(f, v, columns, list(bounds))]
            yield pa.RecordBatch.from_pylist([dict(zip(UNITS.names, r)) for r in rows], UNITS)

    n = int(located.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return located.select("frag_id", "uris").repartition(n).mapInArrow(run, "frag_id string, path string, part int")


def scan_located(located: DataFrame, columns: list[Column], bounds: list[tuple] = ()) -> DataFrame:
    """Cells of fragments ``(frag_id, uris)``: ``frag_id`` and the wanted columns under their own names."""
    ddl = ", ".join(["frag_id string", *(f"`{c.name}` {c.dtype}" for c in columns)])
    schema = to_arrow_schema(StructType.fromDDL(ddl), timestamp_utc=False)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.parquet as pq

        for b in batches:
            for unit in b.to_pylist():
                store, inner = store_of(unit["path"])
                with store.open_input_file(inner) as handle:
                    for cells in pq.ParquetFile(handle).iter_batches(BATCH_ROWS, [unit["part"]], list(dict.fromkeys(c.stored for c in columns))):
                        read = [pa.repeat(pa.scalar(unit["frag_id"]), cells.num_rows)]
                        read += [cells.column(cells.schema.get_field_index(c.stored)) for c in columns]
                        yield pa.record_batch([x.cast(f.type) for x, f in zip(read, schema)], schema=schema)

    n = int(located.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return row_groups(located, columns, bounds).repartition(n).mapInArrow(run, ddl)


def existing(located: DataFrame) -> DataFrame:
    """``frag_id``, number of the first version that exists (null where none) and its ``path``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for frag_id, uris in zip(b.column("frag_id").to_pylist(), b.column("uris").to_pylist()):
                hit = next(((i, u) for i, u in enumerate(uris or []) if u and files_at(u)), (None, None))
                out.append({"frag_id": frag_id, "version": hit[0], "path": hit[1]})
            yield pa.RecordBatch.from_pylist(out, pa.schema([("frag_id", pa.string()), ("version", pa.int32()), ("path", pa.string())]))

    n = int(located.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return located.select("frag_id", "uris").repartition(n).mapInArrow(run, "frag_id string, version int, path string")

