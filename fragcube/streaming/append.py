"""Keep an inventory up to date while fragments arrive as files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..model import Block, FragmentSet
from ..operators.inventory import wide_inventory
from ..operators.merge import merge_inventories
from ..plans.manifest import Placement, place


def append_stream(
    spark: SparkSession, source: str, like: Block, inventory_path: str, checkpoint: str, files_per_trigger: int | None = None
) -> StreamingQuery:
    """Follow a folder of stored fragments and add each batch to the inventory.

    A batch owns the folder ``batch=<number>`` and replaces it when it is run
    again, so a restart neither loses nor doubles a fragment.  All files of a
    fragment must arrive within one trigger.
    """
    reader = spark.readStream.schema(like.cells.schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    cells = reader.parquet(source)

    def add(batch: DataFrame, number: int) -> None:
        found = wide_inventory(FragmentSet((Block(like.dims, like.coords, like.vars, batch),)))
        found.write.mode("overwrite").parquet(f"{inventory_path}/batch={number}")

    return (
        cells.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def current_placement(spark: SparkSession, inventory_path: str, like: Block) -> Placement:
    """Where every fragment that has arrived so far belongs."""
    stored = spark.read.parquet(inventory_path).drop("batch")
    return place(merge_inventories([stored], list(like.dims), set(like.coords)))
