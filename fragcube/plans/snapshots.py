"""A manifest that changes: numbered snapshots, committed whole or not at all.

Below ``path`` a snapshot is a folder of the manifest's tables under a name of its
own, and ``log/<number>`` a small file that names it.  A commit first writes the
tables, then claims the next number by renaming its log entry to it, which fails
where that number is taken; nothing before that is visible to readers.  A reader
takes the highest number, so it sees all tables of one snapshot.  Whoever loses
a number reads the winner's snapshot and applies its change to that.

The rename is atomic on HDFS and on local disks; on a store without atomic
renames one writer at a time has to be arranged from outside.

Besides the manifest's tables a snapshot holds ``instructions`` (the features of each
aggregated variable, as :mod:`.instructions` writes them) and ``inline``, the values of
variables that are not aggregated.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..model import FragmentError, FragmentSet, Manifest
from ..operators.merge import incremental_append
from .instructions import Instructions, to_instructions
from .manifest import read_manifest, write_manifest

INSTRUCTIONS = ("variables", "maps", "locations", "scalars")


class ConflictError(FragmentError):
    """Another writer committed the number first."""


@dataclass(frozen=True)
class Snapshot:
    """One state of a manifest; number 0 has none yet."""

    number: int
    folder: str | None
    manifest: Manifest | None


def _hadoop(spark: SparkSession, path: str):
    jvm = spark._jvm.org.apache.hadoop.fs
    where = jvm.Path(path)
    return jvm, where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of all committed snapshots; a name per commit."""
    _, where, fs = _hadoop(spark, f"{path}/log")
    if not fs.exists(where):
        return []
    return sorted(int(s.getPath().getName()) for s in fs.listStatus(where) if s.getPath().getName().isdigit())


def read_snapshot(spark: SparkSession, path: str, number: int | None = None) -> Snapshot:
    """The newest snapshot, or a given one."""
    known = versions(spark, path)
    if number is None:
        if not known:
            return Snapshot(0, None, None)
        number = known[-1]
    elif number not in known:
        raise FragmentError(f"no snapshot {number} at {path!r}; there are {known[-5:]}")
    entry = json.loads(spark.read.text(f"{path}/log/{number}", wholetext=True).first()[0])
    return Snapshot(number, entry["folder"], read_manifest(spark, f"{path}/{entry['folder']}"))


def inline_values(manifest: Manifest, fragments: FragmentSet) -> DataFrame | None:
    """``(var, idx, value)`` of variables that are not aggregated, from the fragment listed first; ``idx`` is row-major by dimension."""
    first = F.broadcast(manifest.frags.orderBy("file_ord", "frag_id").limit(1).select("frag_id"))  # one row
    plain = {r["var"] for r in manifest.vars.filter("class <> 'aggregated'").select("var").collect()}  # a header's worth of rows
    parts = []
    for block in fragments.blocks:
        own = [v for v in block.vars if v in plain]
        if own:
            cells = block.cells.join(first, "frag_id", "left_semi")
            idx = F.concat_ws(",", *[F.col(f"l_{d}").cast("string") for d in block.dims])
            pairs = F.explode(F.array(*[F.struct(F.lit(v).alias("var"), F.col(v).cast("string").alias("value")) for v in own]))
            parts.append(cells.select(idx.alias("idx"), pairs.alias("p")).select("p.var", "idx", "p.value"))
    return reduce(DataFrame.unionByName, parts) if parts else None


def write_instructions(manifest: Manifest, path: str) -> None:
    """The features of all aggregated variables below ``path``."""
    rows = manifest.vars.filter("class = 'aggregated'").orderBy("block_ord", "var").select("var", "dims").collect()  # a header's worth of rows
    numbers = {dims: i for i, dims in enumerate(dict.fromkeys(r["dims"] for r in rows))}
    each = [to_instructions(manifest, r["var"], numbers[r["dims"]]) for r in rows]
    for name in INSTRUCTIONS:
        tables = [getattr(x, name) for x in each if getattr(x, name) is not None]
        if tables:
            # variables of the same dimensions share their map and locations
            reduce(DataFrame.unionByName, tables).distinct().write.parquet(f"{path}/{name}")


def read_instructions(spark: SparkSession, path: str, snapshot: Snapshot) -> Instructions:
    return Instructions(*(spark.read.parquet(f"{path}/{snapshot.folder}/instructions/{n}") for n in INSTRUCTIONS))


def commit(spark: SparkSession, path: str, manifest: Manifest, after: int, fragments: FragmentSet | None = None) -> int:
    """Make ``manifest`` the snapshot after number ``after``; :class:`ConflictError` where another is.

    With ``fragments`` the values of variables that are not aggregated are stored too.
    """
    path = path.rstrip("/")
    folder = f"tables/{after + 1}-{uuid.uuid4().hex}"
    write_manifest(manifest, f"{path}/{folder}")
    if manifest.vars.filter("class = 'aggregated'").take(1):
        write_instructions(manifest, f"{path}/{folder}/instructions")
    inline = inline_values(manifest, fragments) if fragments is not None else None
    if inline is not None:
        inline.write.parquet(f"{path}/{folder}/inline")
    jvm, target, fs = _hadoop(spark, f"{path}/log/{after + 1}")
    entry = jvm.Path(f"{path}/log/.{uuid.uuid4().hex}")
    fs.mkdirs(target.getParent())
    stream = fs.create(entry, False)
    stream.write(bytearray(json.dumps({"folder": folder}).encode()))
    stream.close()
    context = jvm.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    none = spark.sparkContext._gateway.new_array(getattr(jvm, "Options$Rename"), 0)
    try:
        context.rename(fs.makeQualified(entry), fs.makeQualified(target), none)
    except Exception as error:  # the class of the JVM's exception is a name in its text
        fs.delete(entry, False)
        if "FileAlreadyExists" in str(error):
            raise ConflictError(f"snapshot {after + 1} of {path!r} was committed by another writer") from None
        raise
    return after + 1


def change(spark: SparkSession, path: str, apply: Callable[[Manifest | None], Manifest], tries: int = 10, fragments: FragmentSet | None = None) -> Snapshot:
    """Apply a change to the newest snapshot, again on the winner's where another writer was faster.

    A change that returns what it was given commits nothing.
    """
    for _ in range(tries):
        base = read_snapshot(spark, path)
        new = apply(base.manifest)
        if new is base.manifest:
            return base
        try:
            return read_snapshot(spark, path, commit(spark, path, new, base.number, fragments))
        except ConflictError:
            continue
    raise ConflictError(f"{tries} attempts to commit to {path!r} met other writers")


def append(spark: SparkSession, path: str, arrived: FragmentSet, create: Callable[[FragmentSet], Manifest] | None = None, tries: int = 10) -> Snapshot:
    """Add what the newest snapshot does not hold; ``create`` makes the first one."""

    def apply(manifest: Manifest | None) -> Manifest:
        if manifest is not None:
            return incremental_append(manifest, arrived)
        if create is None:
            raise FragmentError(f"no snapshot at {path!r} to append to")
        return create(arrived)

    return change(spark, path, apply, tries, arrived)
