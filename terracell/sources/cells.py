"""Cell tables on disk: Parquet partitioned by tile, so a window reads its own tiles only."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TILE = 512


def write_cells(df: DataFrame, path: str, tile: int = TILE, mode: str = "overwrite") -> None:
    """Writes (row, col, ...) partitioned by tile. With an existing table only the tiles in df are replaced."""
    tiled = df.withColumns({"tile_r": F.floor(F.col("row") / tile).cast("int"), "tile_c": F.floor(F.col("col") / tile).cast("int")})
    tiled.repartition("tile_r", "tile_c").write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy("tile_r", "tile_c").parquet(path)


def read_cells(spark: SparkSession, path: str, window: tuple[int, int, int, int] | None = None, tile: int = TILE) -> DataFrame:
    """The cells of window (row0, row1, col0, col1; ends exclusive), pruned to its tiles, or all."""
    df = spark.read.parquet(path)
    if window is not None:
        r0, r1, c0, c1 = window
        df = df.filter(F.col("tile_r").between(r0 // tile, (r1 - 1) // tile) & F.col("tile_c").between(c0 // tile, (c1 - 1) // tile))
        df = df.filter((F.col("row") >= r0) & (F.col("row") < r1) & (F.col("col") >= c0) & (F.col("col") < c1))
    return df.drop("tile_r", "tile_c")


def read_many(spark: SparkSession, pattern: str) -> list[DataFrame]:
    """One table per path that the glob matches, in order of path; none is an error."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path)
    if not found:
        raise FileNotFoundError(f"nothing matches {pattern}")
    return [read_cells(spark, p) for p in sorted(str(f.getPath()) for f in found)]


def with_sentinels(df: DataFrame, nodata: float, *bands: str) -> DataFrame:
    """Nulls of the bands as the sentinel, for a sink that has no null."""
    return reduce(lambda d, b: d.withColumn(b, F.coalesce(F.col(b).cast("double"), F.lit(float(nodata)))), bands, df)
