"""Heights above terrain: from road nodes and a triangulation, or as the difference of two elevation models."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terracell.functions.geometry import centroid
from terracell.operators import features, raster, tin
from terracell.schema import Grid


def near_roads(tiles: list[DataFrame], lines: DataFrame, grid: Grid, buffer: float = 100.0) -> DataFrame:
    """(row, col, v): the tiles' mosaic (the first that knows a cell), cut to the box of all lines, wider by the buffer.

    lines have x1, y1, x2, y2. The box is one row and is broadcast.
    """
    box = lines.agg(*[f(g("x1", "x2") if k == "x" else g("y1", "y2")).alias(f"{k}{n}") for n, f, g in ((0, F.min, F.least), (1, F.max, F.greatest)) for k in "xy"])
    x, y = grid.west + (F.col("col") + 0.5) * grid.res, grid.north - (F.col("row") + 0.5) * grid.res
    inside = x.between(F.col("x0") - buffer, F.col("x1") + buffer) & y.between(F.col("y0") - buffer, F.col("y1") + buffer)
    return raster.mosaic(tiles).crossJoin(F.broadcast(box)).filter(inside).select("row", "col", "v")


def elevation_raster(kind: str, tiles: list[DataFrame], grid: Grid, lines: DataFrame | None = None, surface: DataFrame | None = None, use_difference: bool = True, buffer: float = 100.0) -> DataFrame:
    """(row, col, v) by kind of elevation data; other kinds raise ValueError.

    arcticdem: tiles of a surface model near ``lines``, less the terrain that
    the roads span. fabdem: ``surface`` less the mosaic of bare-earth tiles.
    Without difference the surface itself.
    """
    if kind == "arcticdem":
        if lines is None:
            raise ValueError("arcticdem needs road lines")
        merged = near_roads(tiles, lines, grid, buffer)
        return road_terrain(merged, lines, grid.res, grid.north, grid.nrow, grid.ncol, grid.west) if use_difference else merged
    if kind == "fabdem":
        if surface is None or not tiles:
            raise ValueError("fabdem needs a surface model and bare-earth tiles")
        return raster.subtracted(surface, raster.mosaic(tiles)) if use_difference else surface
    raise ValueError(f"unknown kind of elevation data: {kind!r}")


def building_elevations(buildings: DataFrame, elevation: DataFrame, grid: Grid, radius: float = 200.0, least: int = 2) -> DataFrame:
    """(id, max_value): the highest cell in each building's ring; where that is unknown or negative, by its neighbours (see ``tiered_heights``)."""
    cells = raster.covered(buildings.select("id", "ring"), grid.west, grid.north, grid.res, grid.ncol, grid.nrow)
    top = raster.on_cells(cells, elevation, grid.ncol * grid.nrow).groupBy("id").agg(F.max("v").alias("v"))
    at = buildings.select("id", centroid(F.col("ring")).alias("c")).select("id", "c.x", "c.y").join(top, "id", "left")
    return features.tiered_heights(at, radius, least).select("id", F.col("value").alias("max_value"))


def road_terrain(surface: DataFrame, lines: DataFrame, res: float, north: float, nrow: int, ncol: int, west: float = 0.0) -> DataFrame:
    """(row, col, v): surface minus the terrain that road ends and crossings span.

    surface is (row, col, v); lines are (id, x1, y1, x2, y2). All nodes take
    part, in blocks with halos. With fewer than three nodes on known cells the
    result is empty.
    """
    ends = lines.select(F.explode(F.array(*[F.struct(F.col(f"x{k}").alias("x"), F.col(f"y{k}").alias("y")) for k in (1, 2)])).alias("p")).select("p.x", "p.y")
    nodes = ends.unionByName(features.crossing_points(lines, 160.0)).select(F.round("x", 3).alias("x"), F.round("y", 3).alias("y")).distinct()
    seen = raster.sampled(nodes, surface, west, north, res).filter(F.col("v").isNotNull()).select("x", "y", "v")
    terrain = tin.triangulated(seen, west, north, res, ncol, nrow)
    return raster.subtracted(surface, terrain).select("row", "col", F.round("v", 4).alias("v"))
