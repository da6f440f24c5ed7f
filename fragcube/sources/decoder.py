"""Fragments in any file format, given a function that decodes one file."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def read_with(
    spark: SparkSession, path: str, decode: Callable[[str, bytes], Iterator[pa.RecordBatch]], schema: str, pattern: str = "*"
) -> DataFrame:
    """Read every file below ``path`` and let ``decode`` turn it into cells.

    Files are spread over the tasks by Spark's own binary reader; ``decode``
    gets the path and the content of one file and yields record batches of the
    block layout.
    """
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .load(path)
        .select("path", "content")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column("path"), batch.column("content")):
                yield from decode(name.as_py(), content.as_py())

    return files.mapInArrow(run, schema)
