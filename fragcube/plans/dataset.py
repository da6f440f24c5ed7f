"""Open a stored manifest as a dataset of lazy variables."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from ..functions import calendars, cf
from ..functions.text import DEFAULT_SUBSTITUTIONS, parse_substitutions, resolve_relative, substitute_all
from ..model import DIFFERS, Block, FragmentError, FragmentSet, Manifest
from ..operators import array
from ..operators.decode import drop_variables
from ..session import literal
from ..sources import located
from .manifest import read_manifest


@dataclass(frozen=True)
class Dataset:
    """Manifests from the root to the opened group, with the fragments behind them."""

    layers: tuple[Manifest, ...]
    fragments: FragmentSet | None = None
    chunks: dict[str, int | str] | None = None

    @property
    def manifest(self) -> Manifest:
        """The opened group itself."""
        return self.layers[-1]

    @property
    def variables(self) -> DataFrame:
        """Variables of all layers; of one name the deepest."""
        rows = None
        for depth, layer in enumerate(self.layers):
            part = layer.vars.withColumn("_depth", F.lit(depth))
            rows = part if rows is None else rows.unionByName(part, allowMissingColumns=True)
        rest = [c for c in self.manifest.vars.columns if c != "var"]
        best = rows.groupBy("var").agg(F.max_by(F.struct(*rest), "_depth").alias("_v"))
        return best.select("var", "_v.*")

    @property
    def sizes(self) -> dict[str, int]:
        """Size of each dimension; of one name the deepest."""
        return {d.dim: d.size for layer in self.layers for d in layer.dims}

    @property
    def attrs(self) -> DataFrame | None:
        """Attributes of all layers; of one name the one nearest the root."""
        rows = None
        for depth, layer in enumerate(self.layers):
            if layer.attrs is not None:
                part = layer.attrs.withColumn("_depth", F.lit(depth))
                rows = part if rows is None else rows.unionByName(part)
        if rows is None:
            return None
        return rows.groupBy("scope", "owner", "attr").agg(F.min_by("value", "_depth").alias("value"))

    def __getitem__(self, name: str) -> array.Variable:
        for layer in reversed(self.layers):
            row = layer.vars.filter(F.col("var") == name).first()
            if row is not None:
                if self.fragments is not None:
                    return array.open_variable(self.fragments, layer, name)
                return array.Variable(located_block(layer, row), layer, name)
        raise FragmentError(f"no variable named {name!r}")

    def attrs_of(self, name: str) -> dict[str, str]:
        """Attributes of one variable; a header's worth of rows."""
        if self.attrs is None:
            return {}
        return {r["attr"]: r["value"] for r in self.attrs.filter(F.col("owner") == name).collect()}

    def chunk_sizes(self, block: Block) -> dict[str, int]:
        """Chunk sizes asked for, with ``optimised`` replaced by the best size."""
        wanted = dict(self.chunks or {})
        spark = block.cells.sparkSession
        for dim in [d for d, size in wanted.items() if size == "optimised"]:
            size = self.sizes[dim]
            count = array.chunk_count(F.lit(size), 8, array.TARGET_BYTES)
            wanted[dim] = spark.range(1).select(array.optimal_chunk_size(F.lit(size), count).alias("n")).first()["n"]
        return {d: int(n) for d, n in wanted.items() if d in block.dims}

    def chunked(self, name: str) -> DataFrame:
        """Stored cells of a variable partitioned by chunk."""
        variable = self[name]
        block = variable.block
        if block.scan:
            _, held = variable.constants(variable.fragments())
            block = replace(block, cells=block.scan(held, [*(f"l_{d}" for d in block.dims), name], []))
        return array.rechunk(block, self.chunk_sizes(block))

    def decoded(self, name: str, mask_and_scale: bool = True, decode_times: bool = True, decode_timedelta: bool = True) -> DataFrame:
        """Cells of a variable with its packing undone and its times decoded."""
        attrs, value = self.attrs_of(name), F.col(name)
        unclear = [k for k in ("units", "calendar", "scale_factor", "add_offset") if attrs.get(k) == DIFFERS]
        if unclear:
            raise FragmentError(f"{unclear} of {name!r} differ between fragments, so it cannot be decoded as a whole")
        row = self.variables.filter(F.col("var") == name).first()
        cells = self[name].to_df()
        if cells.schema[name].dataType.simpleString() in ("string", "timestamp_ntz", "timestamp", "date"):
            return cells
        if mask_and_scale:
            number = lambda key: F.lit(float(attrs[key])) if key in attrs else None
            fill = F.lit(float(row["fill"])) if row["fill"] is not None else None
            if fill is not None or "scale_factor" in attrs or "add_offset" in attrs:
                value = cf.mask_and_scale(value, fill, number("scale_factor"), number("add_offset"))
        units = attrs.get("units", "")
        if decode_times and " since " in units:
            calendar = attrs.get("calendar", "standard")
            real = calendars.known(calendar) in ("standard", "proleptic_gregorian")
            return (calendars.timestamps if real else calendars.decode)(cells, name, value, F.lit(units), calendar)
        if decode_timedelta and cf.is_time_unit(units):
            value = cf.decode_timedelta(value, F.lit(units))
        return cells.withColumn(name, value)


def own_substitutions(manifest: Manifest) -> dict[str, str]:
    """Substitutions that the manifest itself asks for, in its global attribute of that name."""
    if manifest.attrs is None:
        return {}
    row = manifest.attrs.filter((F.col("scope") == "global") & (F.col("attr") == "substitutions")).first()
    return parse_substitutions(row["value"]) if row is not None and row["value"] else {}


def located_block(manifest: Manifest, row: Row) -> Block:
    """What a row of ``vars`` says of its variable, to be read from the locations that the manifest names."""
    name, dims = row["var"], tuple(d for d in row["dims"].split(" ") if d)
    if "uris" not in manifest.frags.columns:
        raise FragmentError(f"the manifest names no locations, so {name!r} needs its fragments given")
    coords = tuple(d for d in dims if manifest.dim(d).dtype)
    columns = {f"l_{d}": located.Column(f"l_{d}", f"l_{d}", "bigint") for d in dims}
    columns |= {f"c_{d}": located.Column(f"c_{d}", f"c_{d}", manifest.dim(d).dtype) for d in coords}
    columns[name] = located.Column(name, row["identifier"], row["dtype"])
    schema = ", ".join(["frag_id string", *(f"`{c.name}` {c.dtype}" for c in columns.values())])

    def scan(frags: DataFrame, wanted: list[str], bounds: list[tuple]) -> DataFrame:
        stored = [(columns[c].stored, low, high) for c, low, high in bounds]
        return located.scan_located(frags.select("frag_id", "uris"), [columns[c] for c in wanted], stored)

    return Block(dims, coords, (name,), literal(manifest.frags.sparkSession, [], schema), scan=scan)


def open_dataset(
    spark: SparkSession,
    path: str,
    fragments: FragmentSet | None = None,
    drop: list[str] | None = None,
    substitutions: dict[str, str] | None = None,
    group: str | None = None,
    chunks: dict[str, int | str] | None = None,
) -> Dataset:
    """Open the manifest at ``path``, or a group of it with all it inherits.

    Nothing but the tables of the manifest is read.  Without ``fragments`` the
    variables are read from the locations that the manifest names: of each fragment
    the first that exists, after substitutions (those of the manifest's own
    ``substitutions`` attribute before the given ones), relative ones counted from
    the manifest's folder.
    """
    parts = [p for p in (group or "").strip("/").split("/") if p]
    layers = []
    for depth in range(len(parts) + 1):
        manifest = read_manifest(spark, path, "/".join(parts[:depth]))
        if drop:
            manifest = replace(manifest, vars=drop_variables(manifest.vars, drop))
        if "uris" in manifest.frags.columns:
            subs = {**DEFAULT_SUBSTITUTIONS, **own_substitutions(manifest), **(substitutions or {})}
            uris = substitute_all(F.col("uris"), subs)
            if fragments is None:
                uris = F.transform(uris, lambda u: resolve_relative(u, path.rstrip("/")))
            manifest = replace(manifest, frags=manifest.frags.withColumn("uris", uris))
        layers.append(manifest)
    return Dataset(tuple(layers), fragments, chunks)


def describe(manifest: Manifest) -> DataFrame:
    """Dimensions, variables and attributes of a dataset as one table."""
    spark = manifest.frags.sparkSession
    dims = literal(
        spark,
        [("dim", d.dim, k, str(v)) for d in manifest.dims
         for k, v in (("kind", d.kind), ("size", d.size), ("f_size", d.f_size), ("dtype", d.dtype)) if v != ""],
        "section string, item string, property string, value string",
    )
    entries = F.array(*[
        F.struct(F.lit(p).alias("property"), F.col(p).cast("string").alias("value"))
        for p in ("dtype", "dims", "class", "adims", "fill")
    ])
    variables = manifest.vars.select(F.lit("var").alias("section"), F.col("var").alias("item"), F.explode(entries).alias("e"))
    out = dims.unionByName(variables.select("section", "item", "e.property", "e.value"))
    if manifest.attrs is not None:
        out = out.unionByName(
            manifest.attrs.select(
                F.concat(F.lit("attr:"), "scope").alias("section"), F.col("owner").alias("item"),
                F.col("attr").alias("property"), "value",
            )
        )
    return out.filter("value is not null")


def describe_item(manifest: Manifest, item: str) -> DataFrame:
    """Everything known about one variable or dimension."""
    return describe(manifest).filter(F.col("item") == item)
