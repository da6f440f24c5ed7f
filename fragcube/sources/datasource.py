"""``spark.read.format("fragments")``: fragments as a source that Spark plans.

Options:

* ``path``      a folder or a glob of Parquet files; one input partition per fragment
                (the files below one ``frag_id=`` folder, else a file of its own);
* ``manifest`` and ``variable``  a stored manifest and one of its variables; an input
                partition is a range of rows of the manifest, so no name of a fragment
                comes to the driver, and each task looks its locations up itself;
* ``columns``   names to read, separated by commas (all by default);
* ``report``    ``footers`` gives file x column rows of names, types, attributes and row
                counts instead of cells.

Comparisons with constants skip row groups by their statistics, and those of
``frag_id`` skip fragments; Spark evaluates them again on what is left.  Call
:func:`register` once per session; it also switches on
``spark.sql.python.filterPushdown.enabled``, without which Spark refuses a Python source
that takes filters.
"""

from __future__ import annotations

import fnmatch
import json
import posixpath
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual,
)
from pyspark.sql.pandas.types import from_arrow_type, to_arrow_schema
from pyspark.sql.types import StructType

from ..functions.text import DEFAULT_SUBSTITUTIONS, parse_substitutions
from ..model import FragmentError
from .located import BATCH_ROWS, Column, _units, files_at, store_of
from .parquet import HEADER, _read_header

#: Fragments of a manifest that one input partition covers.
FRAGMENTS_PER_TASK = 16


@dataclass
class Files(InputPartition):
    """One fragment: its name and files."""

    frag_id: str
    files: list[str]


@dataclass
class Range(InputPartition):
    """Rows ``start`` to ``start + n`` of a row group of a manifest's table."""

    table: str
    group: int
    start: int
    n: int


def _table(path: str, columns: list[str] | None = None) -> list[dict]:
    """A small table of a manifest: its dimensions, variables or attributes."""
    import pyarrow.parquet as pq

    out = []
    for f in files_at(path) or []:
        store, inner = store_of(f)
        with store.open_input_file(inner) as handle:
            out += pq.ParquetFile(handle).read(columns).to_pylist()
    return out


def _below(root: str, location: str) -> str:
    """A relative location counted from the manifest's folder, with its steps up taken."""
    scheme, mark, rest = root.rpartition("://")
    return f"{scheme}{mark}{posixpath.normpath(f'{rest}/{location}')}"


def listed(path: str) -> dict[str, list[str]]:
    """Files of each fragment below a folder, or that a glob names."""
    parts = path.split("/")
    wild = next((i for i, p in enumerate(parts) if set(p) & set("*?[")), None)
    base = path if wild is None else "/".join(parts[:wild])
    found: dict[str, list[str]] = {}
    for f in files_at(base) or []:
        if wild is not None and not fnmatch.fnmatchcase(f, path) and not fnmatch.fnmatchcase(f, path.rstrip("/") + "/*"):
            continue
        if not f.endswith(".parquet"):
            continue
        folder = next((p for p in reversed(f.split("/")) if p.startswith("frag_id=")), None)
        found.setdefault(unquote(folder[len("frag_id="):]) if folder else f, []).append(f)
    return found


def _columns_of(path: str) -> dict[str, str]:
    import pyarrow.parquet as pq

    store, inner = store_of(path)
    with store.open_input_file(inner) as handle:
        return {f.name: from_arrow_type(f.type, prefer_timestamp_ntz=True).simpleString() for f in pq.ParquetFile(handle).schema_arrow}


class FragmentSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "fragments"

    def _files(self) -> dict[str, list[str]]:
        found = listed(self.options["path"])
        if len(found) < 2:
            raise FragmentError(f"unable to aggregate fewer than two fragments from {self.options['path']!r}; found {len(found)}")
        return found

    def schema(self) -> str:
        if self.options.get("report") == "footers":
            return HEADER
        if "manifest" in self.options:
            fields = {c.name: c.dtype for c in self.columns()}
        else:
            fields = _columns_of(next(iter(self._files().values()))[0])
        if wanted := self.options.get("columns"):
            names = [n.strip() for n in wanted.split(",") if n.strip() != "frag_id"]
            absent = set(names) - set(fields)
            if absent:
                raise FragmentError(f"fragments have no columns {sorted(absent)}")
            fields = {n: kind for n, kind in fields.items() if n in names}
        return ", ".join(["frag_id string", *(f"`{n}` {kind}" for n, kind in fields.items() if n != "frag_id")])

    def columns(self) -> list[Column]:
        """Columns of the manifest's variable, under the names that its fragments know them by."""
        root, name = self.options["manifest"].rstrip("/"), self.options.get("variable")
        row = next((r for r in _table(f"{root}/vars") if r["var"] == name), None)
        if row is None:
            raise FragmentError(f"no variable named {name!r}")
        types = {d["dim"]: d.get("dtype") for d in _table(f"{root}/dims")}
        dims = [d for d in row["dims"].split(" ") if d]
        out = [Column(f"l_{d}", f"l_{d}", "bigint") for d in dims] + [Column(f"c_{d}", f"c_{d}", types[d]) for d in dims if types[d]]
        return [*out, Column(name, row["identifier"], row["dtype"])]

    def reader(self, schema: StructType) -> DataSourceReader:
        wanted = [f.name for f in schema.fields if f.name != "frag_id"]
        if "manifest" in self.options:
            own = {c.name: c for c in self.columns()}
            return FragmentReader(schema, self.options, [own[n] for n in wanted] if "report" not in self.options else [])
        return FragmentReader(schema, self.options, [Column(f.name, f.name, f.dataType.simpleString()) for f in schema.fields if f.name != "frag_id"])


class FragmentReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict, columns: list[Column]) -> None:
        self.options, self.columns = dict(options), columns
        self.schema = to_arrow_schema(schema, timestamp_utc=False)
        self.names: set[str] | None = None
        self.bounds: list[tuple] = []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        stored = {c.name: c.stored for c in self.columns}
        for f in filters:
            if len(getattr(f, "attribute", ())) == 1:
                name = f.attribute[0]
                if name == "frag_id" and isinstance(f, (EqualTo, In)):
                    these = {f.value} if isinstance(f, EqualTo) else set(f.value)
                    self.names = these if self.names is None else self.names & these
                elif name in stored and isinstance(f, EqualTo):
                    self.bounds.append((stored[name], f.value, f.value))
                elif name in stored and isinstance(f, (GreaterThan, GreaterThanOrEqual)):
                    self.bounds.append((stored[name], f.value, None))
                elif name in stored and isinstance(f, (LessThan, LessThanOrEqual)):
                    self.bounds.append((stored[name], None, f.value))
            yield f  # statistics leave more than the filter does

    def partitions(self) -> list[InputPartition]:
        if "manifest" not in self.options:
            return [Files(k, v) for k, v in sorted(listed(self.options["path"]).items()) if self.names is None or k in self.names]
        import pyarrow.parquet as pq

        out: list[InputPartition] = []
        for f in files_at(f"{self.options['manifest'].rstrip('/')}/frags") or []:
            store, inner = store_of(f)
            with store.open_input_file(inner) as handle:
                meta = pq.ParquetFile(handle).metadata
            for g in range(meta.num_row_groups):
                out += [Range(f, g, at, FRAGMENTS_PER_TASK) for at in range(0, meta.row_group(g).num_rows, FRAGMENTS_PER_TASK)]
        return out

    def _fragments(self, part: InputPartition) -> Iterator[tuple[str, list[str]]]:
        """Name and files (of the first version that exists) of the partition's fragments."""
        if isinstance(part, Files):
            yield part.frag_id, part.files
            return
        import pyarrow.parquet as pq

        root = self.options["manifest"].rstrip("/")
        own = next((r["value"] for r in _table(f"{root}/attrs") if r["scope"] == "global" and r["attr"] == "substitutions"), None)
        subs = {**DEFAULT_SUBSTITUTIONS, **(parse_substitutions(own) if own else {}), **json.loads(self.options.get("substitutions", "{}"))}
        store, inner = store_of(part.table)
        with store.open_input_file(inner) as handle:
            table = pq.ParquetFile(handle)
            constant = f"unique_{self.options.get('variable')}"
            names = [c for c in ("frag_id", "uris", constant) if c in table.schema_arrow.names]
            rows = table.read_row_group(part.group, names).slice(part.start, part.n).to_pylist()
        for row in rows:
            if row.get(constant) is not None or (self.names is not None and row["frag_id"] not in self.names):
                continue
            uris = []
            for u in row.get("uris") or []:
                for key, value in subs.items():
                    u = u.replace(key, value) if u else u
                uris.append(u if not u or "://" in u or u.startswith(("/", "file:")) else _below(root, u))
            yield row["frag_id"], [u for u in uris if u]

    def read(self, part: InputPartition) -> Iterator[pa.RecordBatch]:
        import pyarrow.parquet as pq

        for frag_id, locations in self._fragments(part):
            if self.options.get("report") == "footers":
                files = next((f for f in map(files_at, locations) if f), []) if isinstance(part, Range) else locations
                rows = [dict(zip(self.schema.names, r)) for f in files for r in _read_header(f)]
                yield pa.RecordBatch.from_pylist([r | {"attrs": list(r["attrs"].items())} for r in rows], self.schema)
                continue
            versions = [locations] if isinstance(part, Range) else [[f] for f in locations]
            for uris in versions:
                for _, path, group in _units(frag_id, uris, self.columns, self.bounds):
                    store, inner = store_of(path)
                    with store.open_input_file(inner) as handle:
                        for cells in pq.ParquetFile(handle).iter_batches(BATCH_ROWS, [group], list(dict.fromkeys(c.stored for c in self.columns))):
                            read = [pa.repeat(pa.scalar(frag_id), cells.num_rows)]
                            read += [cells.column(cells.schema.get_field_index(c.stored)) for c in self.columns]
                            yield pa.record_batch([x.cast(t.type) for x, t in zip(read, self.schema)], schema=self.schema)


def register(spark: SparkSession) -> None:
    """Make ``spark.read.format("fragments")`` known to a session."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(FragmentSource)
