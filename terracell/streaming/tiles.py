"""New tiles as they arrive: a file-source stream that runs an operator over what is new and stops."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terracell.sources.cells import TILE
from terracell.sources.store import exists


def process_new_tiles(spark: SparkSession, source: str, schema, target: str, checkpoint: str, operate: Callable[[DataFrame], DataFrame], tile: int = TILE) -> None:
    """Applies ``operate`` to cells that came since the last call and puts them into their tiles in ``target``.

    A tile's earlier cells stay, unless the batch has the same cell. The
    checkpoint remembers which files were read; a batch that is run again
    gives the same tiles. Only tiles that the batch touches are read and
    rewritten, by way of a table beside the checkpoint, since a table cannot
    be overwritten while it is read.
    """

    def write(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        fresh = operate(batch)
        names = fresh.columns
        place = {"tile_r": F.floor(F.col("row") / tile).cast("int"), "tile_c": F.floor(F.col("col") / tile).cast("int")}
        draft = f"{checkpoint.rstrip('/')}/merged"
        fresh = fresh.withColumns(place)
        if exists(session, target):
            fresh.write.mode("overwrite").parquet(f"{draft}-new")
            fresh = session.read.schema(fresh.schema).parquet(f"{draft}-new")
            touched = F.broadcast(fresh.select("tile_r", "tile_c").distinct())  # one small row a tile of the batch
            stored = session.read.parquet(target).join(touched, ["tile_r", "tile_c"], "left_semi")
            fresh = fresh.unionByName(stored.join(fresh.select("row", "col"), ["row", "col"], "left_anti").select(*names, "tile_r", "tile_c"))
        fresh.write.mode("overwrite").parquet(draft)
        merged = session.read.schema(fresh.schema).parquet(draft)
        merged.repartition("tile_r", "tile_c").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("tile_r", "tile_c").parquet(target)

    stream = spark.readStream.schema(schema).parquet(source)
    stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def open_tiles(tiles: DataFrame, done: DataFrame) -> DataFrame:
    """Tiles of which the manifest has none yet."""
    return tiles.join(done.select("ti", "tj"), ["ti", "tj"], "left_anti")
