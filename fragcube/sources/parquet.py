"""Fragments stored as Parquet: write, list, open, and read their headers."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..model import Block, FragmentError, FragmentSet
from ..operators.inventory import check_dim_set, check_info_match, check_var_set, info_rows, pad_versions, require_none
from ..session import literal, lookup_join

#: Parquet key under which Spark keeps the schema with its column metadata.
ROW_SCHEMA = b"org.apache.spark.sql.parquet.row.metadata"
HEADER = "path string, pos int, column string, dtype string, attrs map<string,string>, n_rows long"


def write_fragments(block: Block, path: str) -> None:
    """Store a block with one ``frag_id=`` folder per fragment.

    Rows gather by fragment through a rebalance, which adaptive execution
    splits where one fragment is huge and merges where many are tiny.  Tasks move
    their own files into place, as the driver would take folder after folder; a
    write that fails raises and leaves no ``_SUCCESS``.
    """
    rows = block.cells.hint("rebalance", "frag_id").write.option("mapreduce.fileoutputcommitter.algorithm.version", "2")
    rows.partitionBy("frag_id").parquet(path)


def has_two(cells: DataFrame) -> bool:
    """At least two fragments; ``frag_id`` is a partition column, so two files are opened at most."""
    one = cells.select("frag_id").first()
    return one is not None and bool(cells.filter(F.col("frag_id") != one["frag_id"]).select("frag_id").take(1))


def open_fragments(
    spark: SparkSession, paths: str | list[str], variables: list[str] | None = None, verify: bool = False
) -> Block:
    """Open stored fragments as one block; ``paths`` is a folder, a glob or a list.

    Dimensions and coordinates follow from the column names.  At least two
    fragments are needed.  ``verify`` first compares the footers of all files.
    """
    if verify:
        verify_headers(spark, paths)
    if isinstance(paths, (list, tuple)):
        if len(paths) < 2:
            raise FragmentError(f"unable to aggregate fewer than two fragments; {len(paths)} given")
        base = paths[0].rsplit("/frag_id=", 1)[0]
        cells = _read_folders(spark, base, list(paths))
    else:
        root = paths.split("/frag_id=", 1)[0]
        cells = _read_folders(spark, root, [paths])
        if not has_two(cells):
            raise FragmentError(f"unable to aggregate fewer than two fragments from {paths!r}")
    return block_of(cells, variables)


def _read_folders(spark: SparkSession, base: str, paths: list[str]) -> DataFrame:
    """Cells with ``frag_id`` as the text of its folder; types guessed from names would make ``007`` a 7.

    The folders are listed again only where the guess was not text.
    """
    guessed = spark.read.option("basePath", base).parquet(*paths)
    if "frag_id" not in guessed.columns or guessed.schema["frag_id"].dataType == StringType():
        return guessed
    fields = [StructField(f.name, StringType() if f.name == "frag_id" else f.dataType, f.nullable, f.metadata) for f in guessed.schema]
    return spark.read.option("basePath", base).schema(StructType(fields)).parquet(*paths)


def block_of(cells: DataFrame, variables: list[str] | None = None, reader=None) -> Block:
    """A block from cells whose columns follow the naming rule."""
    names = cells.columns
    dims = tuple(c[2:] for c in names if c.startswith("l_"))
    coords = tuple(d for d in dims if f"c_{d}" in names)
    taken = {"frag_id", "file_ord", *(f"l_{d}" for d in dims), *(f"c_{d}" for d in dims)}
    found = tuple(c for c in names if c not in taken and (variables is None or c in variables))
    return Block(dims, coords, found, cells, reader)


def plain_path(path: Column) -> Column:
    """Path of a local file without its scheme; any other location unchanged."""
    return F.regexp_replace(path, "^file:/+", "/")


def _qualified(spark: SparkSession, path: str) -> str:
    """A location spelled as Spark reports it, but not percent-encoded."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(where).toString()


def _local(path: str) -> str:
    """:func:`plain_path` of a name on the driver."""
    return re.sub("^file:/+", "/", path)


def _decoded(uri: Column) -> Column:
    """A reported location without percent-encoding; a plus sign stays one."""
    return F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B")))


def open_files(
    spark: SparkSession, paths: str | list[str | tuple[str, ...]], variables: list[str] | None = None
) -> FragmentSet:
    """Open files that are one fragment each; ``paths`` is a glob or a list.

    A fragment is known by its path.  An entry of the list may be a tuple of
    alternative locations, of which the first is opened; the others are kept,
    padded with NULL.  Files of a list keep its order, those of a glob are
    ordered by path.
    """
    if isinstance(paths, str):
        entries = [(unquote(f),) for f in sorted(spark.read.parquet(paths).inputFiles())]
    else:
        entries = [(p,) if isinstance(p, str) else tuple(p) for p in paths]
    if len(entries) < 2:
        raise FragmentError(f"unable to aggregate fewer than two fragments; found {len(entries)}")
    listed = literal(spark, [(i, list(e)) for i, e in enumerate(entries)], "file_ord long, uris array<string>")
    known = literal(spark, [(i, _qualified(spark, e[0])) for i, e in enumerate(entries)], "file_ord long, found string")
    listed = pad_versions(listed).join(known, "file_ord").withColumn("frag_id", plain_path(F.col("found"))).drop("found")
    orders = listed.select("frag_id", "file_ord")

    def read(names: list[str]) -> DataFrame:
        cells = spark.read.parquet(*names)
        wanted, got = ({_local(f) for f in some} for some in ([_qualified(spark, n) for n in names], map(unquote, cells.inputFiles())))
        if wanted != got:
            raise FragmentError(f"files are not read as they are listed, such as {sorted(wanted ^ got)[:3]}")
        found = cells.withColumn("frag_id", plain_path(_decoded(file_name())))
        dims = [c for c in found.columns if c.startswith("l_")]
        return lookup_join(found, orders, ["frag_id"], len(entries), dims or [F.lit(0)])

    return FragmentSet(
        (block_of(read([e[0] for e in entries]), variables, read),), uris=listed.select("frag_id", "uris")
    )


def file_name() -> Column:
    """File a cell was read from."""
    return F.col("_metadata.file_path")


def list_files(spark: SparkSession, path: str | list[str], pattern: str = "*.parquet") -> DataFrame:
    """Paths and sizes under a folder; the content is never read."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .load(path)
    )
    return files.select("path", "length")


def _read_header(path: str) -> Iterator[tuple]:
    import pyarrow.fs as pafs
    import pyarrow.parquet as pq

    uri = "file://" + path[len("file:"):] if path.startswith("file:/") and not path.startswith("file://") else path
    uri = re.sub("^s3[an]://", "s3://", uri)  # names of the same store
    filesystem, inner = pafs.FileSystem.from_uri(uri)
    with filesystem.open_input_file(inner) as handle:
        header = pq.ParquetFile(handle)
        schema, n_rows = header.schema_arrow, header.metadata.num_rows
        packed = (header.metadata.metadata or {}).get(ROW_SCHEMA)
    noted = {f["name"]: f.get("metadata", {}) for f in json.loads(packed)["fields"]} if packed else {}
    for pos, column in enumerate(schema):
        own = {k.decode(): v.decode() for k, v in (column.metadata or {}).items() if not k.startswith(b"PARQUET")}
        own.update({k: str(v) for k, v in noted.get(column.name, {}).items()})
        yield path, pos, column.name, str(column.type), own, n_rows


def scan_headers(spark: SparkSession, path: str | list[str], pattern: str = "*.parquet") -> DataFrame:
    """File x column rows from the file footers: type, attributes, row count.

    Footers differ from file to file, so each is opened, by whichever task
    lists it; no row group is read.
    """
    import pandas as pd

    def headers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [row for path in batch["path"] for row in _read_header(path)]
            yield pd.DataFrame(rows, columns=["path", "pos", "column", "dtype", "attrs", "n_rows"])

    return list_files(spark, path, pattern).select("path").mapInPandas(headers, HEADER)


def header_inventory(headers: DataFrame) -> DataFrame:
    """Fragment x variable rows from footers: dtype, dims, coordinate dims, fill, identifier.

    A fragment in several files counts once per variable.
    """
    frag = F.regexp_extract("path", r"frag_id=([^/]+)", 1)
    by_file = headers.groupBy(frag.alias("frag_id")).agg(
        F.sort_array(F.collect_set(F.struct("pos", "column"))).alias("_names"),
        F.collect_set(F.struct("column", "dtype", F.col("attrs")["_FillValue"].alias("fill"))).alias("_cols"),
    )
    pick = lambda mark: F.array_join(
        F.transform(
            F.filter("_names", lambda n: n["column"].startswith(mark)),
            lambda n: F.substring(n["column"], F.lit(3), F.length(n["column"])),
        ),
        " ",
    )
    return (
        by_file.select("frag_id", pick("l_").alias("dims"), pick("c_").alias("cdims"), F.explode("_cols").alias("c"))
        .filter(~F.col("c.column").rlike("^(l_|c_)|^file_ord$"))
        .select(
            "frag_id", F.col("c.column").alias("var"), F.col("c.dtype").alias("dtype"), "dims", "cdims",
            F.col("c.fill").alias("fill"), F.col("c.column").alias("identifier"),
        )
    )


def verify_headers(spark: SparkSession, path: str | list[str]) -> None:
    """Raise when fragments differ in their variables, dimensions or properties.

    Reading would fill a column that a file lacks with NULL without a word, so
    this looks into the footers.
    """
    found = header_inventory(scan_headers(spark, path)).withColumn("file_ord", F.col("frag_id"))
    require_none(check_var_set(found), "variables differ between fragments")
    dims = found.select("frag_id", "file_ord", F.explode(F.split("dims", " ")).alias("dim"))
    require_none(check_dim_set(dims), "dimensions differ between fragments")
    require_none(check_info_match(info_rows(found)), "variables differ in type, dimensions or fill value")
