"""Session helpers: shared scratch space, size probes and guarded joins.

Every table the engine derives from fragments is *metadata*: one row per
fragment and dimension.  It is small next to the cells, yet it does grow with
the number of fragments, so nothing here is broadcast on faith.  A join
broadcasts its metadata side only below a measured row count and otherwise runs
as a salted shuffle join, which keeps one huge fragment from landing in a
single task.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

#: Metadata rows (about 100 bytes each) that may be broadcast.
BROADCAST_ROWS = 1_000_000
#: Metadata rows one task handles faster than a shuffle would.
SINGLE_TASK_ROWS = 50_000
#: Sub-keys given to each join key when the metadata side is too big to broadcast.
SALTS = 32


def literal(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A few rows known on the driver, as a local relation of the plan.

    Going through Arrow keeps them out of an RDD, so Spark knows their size and
    needs no Python worker to read them.
    """
    fields = StructType.fromDDL(schema)
    columns = list(zip(*rows)) if rows else [[] for _ in fields]
    arrow = pa.table([pa.array(list(c), type=to_arrow_type(f.dataType)) for c, f in zip(columns, fields)], names=fields.names)
    return spark.createDataFrame(arrow, fields)


_OWN_ROOTS: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """Shared folder of the cluster (``spark.checkpoint.dir``).

    Only where a local session names none, as in tests, one new temporary
    folder is made for the application.  On a cluster every executor would
    write to its own disk, so there the setting is required.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.conf.get("spark.master", "")
        if not (master == "local" or master.startswith("local[")):
            raise ValueError(f"set spark.checkpoint.dir to a folder that all executors of {master!r} share")
        app = spark.sparkContext.applicationId
        if app not in _OWN_ROOTS:
            _OWN_ROOTS[app] = tempfile.mkdtemp(prefix="run-", dir="/tmp")
        root = _OWN_ROOTS[app]
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for one table in the shared folder."""
    return f"{_own_folder(spark)}/{uuid.uuid4().hex}/{name}"


def _own_folder(spark: SparkSession) -> str:
    return f"{scratch_root(spark)}/fragcube-{spark.sparkContext.applicationId}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete what this application stored; tables derived so far become unreadable."""
    discard(spark, _own_folder(spark))


def discard(spark: SparkSession, path: str) -> None:
    """Delete a stored table that nothing reads any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def spent_shuffles(spark: SparkSession) -> Iterator[None]:
    """Tables written within leave no shuffle files behind, as nothing reads these again."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def materialise(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` once to the shared folder and continue from the files.

    Lineage is cut by a written table, so a lost executor re-reads files
    rather than re-scanning the cells, and row counts come from the footers.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def materialise_observed(df: DataFrame, name: str, *measures: Column) -> tuple[DataFrame, dict]:
    """:func:`materialise`, with aggregates of ``df`` taken while it is written."""
    seen = Observation(f"{name}-{uuid.uuid4().hex}")
    stored = materialise(df.observe(seen, *measures), name)
    return stored, seen.get


def compact(metadata: DataFrame, n_rows: int) -> DataFrame:
    """Put a table of few, counted rows in one partition.

    Joins, windows and aggregates over it then need no shuffle at all.  Larger
    metadata keeps its partitions.
    """
    return metadata.coalesce(1) if n_rows <= SINGLE_TASK_ROWS else metadata


def within(df: DataFrame, limit: int) -> bool:
    """True when ``df`` has at most ``limit`` rows; reads no more than needed."""
    return df.limit(limit + 1).count() <= limit


def lookup_join(
    facts: DataFrame,
    lookup: DataFrame,
    on: list[str],
    lookup_rows: int,
    spread: list[Column | str],
    how: str = "inner",
    broadcast_rows: int | None = None,
) -> DataFrame:
    """Join ``facts`` to a ``lookup`` that is unique on ``on``.

    ``lookup_rows`` is a known upper bound.  Below the limit the lookup is
    broadcast.  Above it both sides shuffle on ``on`` plus a salt taken from
    the ``spread`` columns, so a hot key is shared by ``SALTS`` tasks; the
    lookup is repeated per salt and no row is lost.
    """
    limit = BROADCAST_ROWS if broadcast_rows is None else broadcast_rows
    if lookup_rows <= limit:
        return facts.join(F.broadcast(lookup), on, how)
    salt = F.pmod(F.xxhash64(*spread), F.lit(SALTS)).cast("int")
    salted = lookup.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return facts.withColumn("_salt", salt).join(salted, [*on, "_salt"], how).drop("_salt")
