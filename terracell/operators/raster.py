"""Rasters as cell tables (row, col, value): a missing row or a null value is nodata."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terracell.functions import geometry as G
from terracell.operators.kernels import box_sums, cells_of_rings, inverse_distance, majority
from terracell.schema import Grid

#: Cells along a tile of kernels with a small reach.
TILE = 256
#: A raster of so many cells at most is broadcast to features.
BROADCAST_CELLS = 100_000


def grid_of(extent: DataFrame, res: float) -> DataFrame:
    """(west, north, ncol, nrow) snapped to the resolution, one cell wider to the west and north, from (x0, y0, x1, y1)."""
    b = F.lit(float(res))
    west, east = F.floor(F.col("x0") / b) * b - b, F.ceil(F.col("x1") / b) * b
    south, north = F.floor(F.col("y0") / b) * b, F.ceil(F.col("y1") / b) * b + b
    return extent.select(west.alias("west"), north.alias("north"), F.floor(1 + (east - west) / b).cast("int").alias("ncol"), F.floor(1 + (north - south) / b).cast("int").alias("nrow"))


def extent(df: DataFrame, ring: str = "ring") -> DataFrame:
    """(x0, y0, x1, y1) of all rings; nulls for an empty layer."""
    xs, ys = F.transform(ring, lambda p: p["x"]), F.transform(ring, lambda p: p["y"])
    return df.agg(F.min(F.array_min(xs)).alias("x0"), F.min(F.array_min(ys)).alias("y0"), F.max(F.array_max(xs)).alias("x1"), F.max(F.array_max(ys)).alias("y1"))


def covered(df: DataFrame, west: float, north: float, res: float, ncol: int, nrow: int, ring: str = "ring", reach: float = 0.0) -> DataFrame:
    """df without its ring by each cell whose centre lies in the ring, or at most ``reach`` from it: adds row, col.

    One pass in Arrow batches, nothing shuffled: each feature spans the cells
    of its box only, and the ring decides those. ``ring`` may hold arrays of
    rings: polygons with holes and several parts, by the even-odd rule. Null
    and empty rings cover nothing.
    """
    kept = [c for c in df.columns if c not in (ring, "row", "col")]

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            others = batch.select(kept)
            for feature, row, col in cells_of_rings(batch.column(batch.schema.get_field_index(ring)), west, north, res, ncol, nrow, reach):
                found = others.take(pa.array(feature))
                yield pa.RecordBatch.from_arrays([*found.columns, pa.array(row, pa.int32()), pa.array(col, pa.int32())], names=[*kept, "row", "col"])

    schema = T.StructType([*[df.schema[c] for c in kept], T.StructField("row", T.IntegerType()), T.StructField("col", T.IntegerType())])
    return df.select(*kept, ring).mapInArrow(cells, schema)


def on_cells(features: DataFrame, cells: DataFrame, most: int) -> DataFrame:
    """Features by cell (row, col) with the columns of that cell; ``most`` is how many cells the raster can have.

    Spark takes covered features to be about as many as the rings they come
    from and would broadcast them; only a small raster is broadcast here.
    """
    return features.join(F.broadcast(cells) if most <= BROADCAST_CELLS else cells.hint("merge"), ["row", "col"])


def touched(lines: DataFrame, west: float, north: float, res: float, ncol: int, nrow: int) -> DataFrame:
    """(row, col) of cells whose rectangle is at most ``radius`` from a line (x1, y1, x2, y2, radius): all that its buffer touches."""

    def index(v: Column, most: int) -> Column:
        return F.greatest(F.lit(0), F.least(F.lit(most - 1), F.floor(v).cast("int")))

    r, x1, y1, x2, y2 = (F.col(k) for k in ("radius", "x1", "y1", "x2", "y2"))
    # A cell more each way: a buffer may end on a cell's border.
    rows = F.sequence(index((north - F.greatest(y1, y2) - r) / res - 1, nrow), index((north - F.least(y1, y2) + r) / res + 1, nrow))
    at = lines.withColumn("row", F.explode(rows))
    # Of each row the columns under the part of the line that is at most the radius above or below it.
    high, low = north - F.col("row") * res + r, north - (F.col("row") + 1) * res - r

    def across(y: Column) -> Column:
        return x1 + F.try_divide((x2 - x1) * (y - y1), y2 - y1)

    ends = [across(F.greatest(F.least(y1, y2), F.least(F.greatest(y1, y2), y))) for y in (low, high)]
    level = y1 == y2
    start, stop = F.when(level, F.least(x1, x2)).otherwise(F.least(*ends)), F.when(level, F.greatest(x1, x2)).otherwise(F.greatest(*ends))
    at = at.withColumn("col", F.explode(F.sequence(index((start - r - west) / res - 1, ncol), index((stop + r - west) / res + 1, ncol))))
    left, top = west + F.col("col") * res, north - F.col("row") * res
    d2 = G.segment_box_distance2(F.col("x1"), F.col("y1"), F.col("x2"), F.col("y2"), (left, top - res, left + res, top))
    return at.filter(d2 <= r * r).select("row", "col").distinct()


def burned(cells: DataFrame, value: Column, order: Column) -> DataFrame:
    """(row, col, v): of the features on a cell the last by order wins."""
    return cells.groupBy("row", "col").agg(F.max_by(value, order).alias("v"))


def sampled(points: DataFrame, cells: DataFrame, west: float, north: float, res: float) -> DataFrame:
    """points (x, y) with the value v of their cell; index arithmetic truncates toward zero, then bounds are checked by the join."""
    at = points.withColumns({"row": ((north - F.col("y")) / res).cast("int"), "col": ((F.col("x") - west) / res).cast("int")})
    return at.join(cells.select("row", "col", "v"), ["row", "col"], "left")


def block_percent(cells: DataFrame, size: int, value: str = "v") -> DataFrame:
    """(row, col, percent) of size x size blocks: whole per cent covered, at most 100."""
    by = [F.floor(F.col(k) / size).cast("int").alias(k) for k in ("row", "col")]
    return cells.groupBy(*by).agg(F.least(F.lit(100), F.floor(F.sum(value) * 100 / (size * size))).cast("int").alias("percent"))


def by_tiles(cells: DataFrame, size: int, halo: int, kernel: Callable[[dict[str, np.ndarray], np.ndarray, np.ndarray, np.ndarray], dict[str, np.ndarray]], schema: str) -> DataFrame:
    """Runs a kernel over tiles of about ``size`` cells that read a halo.

    kernel takes (columns, row, col, core) of a tile's cells, rows and columns
    counted from its first; core marks those that it answers for. It returns
    the columns of schema but for row and col, for the core cells in their
    order. Results do not depend on the tiling if no cell's value depends on
    others farther than the halo.
    """
    names = [c for c in cells.columns if c not in ("row", "col")]

    def run(table: pa.Table) -> pa.Table:
        row, col = (table.column(k).to_numpy().astype(np.int64) for k in ("row", "col"))
        core = table.column("core").to_numpy()
        columns = {k: pc.cast(table.column(k), pa.float64()).to_numpy() for k in names}  # null: nan
        found = kernel(columns, row - row.min(), col - col.min(), core)
        arrays = [pa.array(row[core], pa.int32()), pa.array(col[core], pa.int32())]
        return pa.Table.from_arrays([*arrays, *[pa.array(v, from_pandas=True) for v in found.values()]], names=["row", "col", *found])

    return with_halo(cells, size, halo).groupBy("ti", "tj").applyInArrow(run, f"row int, col int, {schema}")


def laid_out(values: np.ndarray, row: np.ndarray, col: np.ndarray, fill: float = np.nan) -> np.ndarray:
    """The array of a tile's cells; ``fill`` where there is no cell."""
    out = np.full((int(row.max()) + 1, int(col.max()) + 1), fill)
    out[row, col] = values
    return out


def _filled(cells: DataFrame, k: int, rule: Callable[[np.ndarray, tuple[np.ndarray, np.ndarray], int], np.ndarray]) -> DataFrame:
    def fill(columns, row, col, core):
        v = columns["v"]
        hole = core & np.isnan(v)
        v = v.copy()
        if hole.any():
            v[hole] = rule(laid_out(columns["v"], row, col), (row[hole], col[hole]), k)
        return {"v": v[core]}

    return by_tiles(cells.select("row", "col", "v"), max(TILE, k), k, fill, "v double")


def gap_filled(cells: DataFrame, k: int) -> DataFrame:
    """(row, col, v): unknown cells take the inverse-square-distance mean of known cells within k, else stay null.

    Tiles grow with k, so a cell is read by at most nine of them.
    """
    return _filled(cells, k, inverse_distance)


def focal_mean(cells: DataFrame, k: int) -> DataFrame:
    """(row, col, v): mean of the known cells in the window of 2k + 1 around each given cell; null where there is none."""

    def mean(columns, row, col, core):
        v = laid_out(columns["v"], row, col)
        known = ~np.isnan(v)
        sums, counts = (box_sums(layer, k)[row[core], col[core]] for layer in (np.where(known, v, 0.0), known.astype(float)))
        return {"v": np.where(counts > 0.5, sums / np.maximum(counts, 1.0), np.nan)}

    return by_tiles(cells.select("row", "col", "v"), max(TILE, k), k, mean, "v double")


def masked(cells: DataFrame, mask: DataFrame, invert: bool = True) -> DataFrame:
    """Cells outside the mask; with invert=False those inside."""
    return cells.join(mask.select("row", "col"), ["row", "col"], "left_anti" if invert else "left_semi")


def mosaic(layers: list[DataFrame]) -> DataFrame:
    """(row, col, v): the first layer that knows a cell gives its value."""
    every = None
    for n, layer in enumerate(layers):
        part = layer.filter(F.col("v").isNotNull()).select("row", "col", "v", F.lit(n).alias("n"))
        every = part if every is None else every.unionByName(part)
    return every.groupBy("row", "col").agg(F.min_by("v", "n").alias("v"))


def subtracted(a: DataFrame, b: DataFrame, row_shift: int = 0, col_shift: int = 0) -> DataFrame:
    """(row, col, v) of a - b where both are known; b's cell (row, col) lies at (row + row_shift, col + col_shift) of a."""
    moved = b.select((F.col("row") + row_shift).alias("row"), (F.col("col") + col_shift).alias("col"), F.col("v").alias("w"))
    return a.join(moved, ["row", "col"]).filter(F.col("v").isNotNull() & F.col("w").isNotNull()).select("row", "col", (F.col("v") - F.col("w")).alias("v"))


def _nearest(p: Column) -> list[tuple[Column, Column]]:
    return [(F.floor(p + 0.5).cast("int"), F.lit(1.0))]


def _bilinear(p: Column) -> list[tuple[Column, Column]]:
    return [((F.floor(p) + k).cast("int"), 1 - F.abs(p - (F.floor(p) + k))) for k in (0, 1)]


def _cubic(p: Column) -> list[tuple[Column, Column]]:
    """Cubic convolution with a = -1/2 over four cells."""

    def weight(d: Column) -> Column:
        return F.when(d < 1, (1.5 * d - 2.5) * d * d + 1).otherwise(((-0.5 * d + 2.5) * d - 4) * d + 2)

    return [((F.floor(p) + k).cast("int"), weight(F.abs(p - (F.floor(p) + k)))) for k in (-1, 0, 1, 2)]


METHODS = {"nearest": _nearest, "bilinear": _bilinear, "cubic": _cubic}


def sampled_at(places: DataFrame, cells: DataFrame, method: str = "nearest") -> DataFrame:
    """(row, col, v) of places (row, col, y, x), where y and x are positions in cells, whole at cell centres.

    Each place meets the cells that its method weighs in one equi-join; the
    weights of unknown cells are shared out among the known. Cubic results
    stay between the least and the greatest cell weighed. Other methods than
    nearest, bilinear and cubic raise ValueError.
    """
    if method not in METHODS:
        raise ValueError(f"unknown method {method!r}; known are {', '.join(METHODS)}")
    source = cells.filter(F.col("v").isNotNull()).select(F.col("row").alias("sr"), F.col("col").alias("sc"), F.col("v").alias("v"))
    rows, cols = METHODS[method](F.col("y")), METHODS[method](F.col("x"))
    if method == "nearest":
        return places.select("row", "col", rows[0][0].alias("sr"), cols[0][0].alias("sc")).join(source, ["sr", "sc"], "left").select("row", "col", "v")
    near = F.array(*[F.struct(i.alias("sr"), j.alias("sc"), (a * b).alias("w")) for i, a in rows for j, b in cols])
    near = F.filter(near, lambda c: c["w"] != 0)
    joined = places.select("row", "col", F.explode(near).alias("c")).select("row", "col", "c.*").join(source, ["sr", "sc"], "left")
    w = F.when(F.col("v").isNotNull(), F.col("w"))
    found = joined.groupBy("row", "col").agg(F.sum(w).alias("weights"), F.sum(w * F.col("v")).alias("sum"), F.min("v").alias("least"), F.max("v").alias("most"))
    value = F.try_divide("sum", "weights")
    if method == "cubic":
        # Weights that are left may cancel out.
        value = F.when(F.abs("weights") > 1e-9, F.greatest("least", F.least("most", value)))
    return found.select("row", "col", value.alias("v"))


def resampled(cells: DataFrame, targets: DataFrame, scale: float, method: str = "nearest") -> DataFrame:
    """(row, col, v) on the target cells, ``scale`` source cells each, by the methods of ``sampled_at``."""
    y, x = (F.col("row") + 0.5) * scale - 0.5, (F.col("col") + 0.5) * scale - 0.5
    return sampled_at(targets.select("row", "col", y.alias("y"), x.alias("x")), cells, method)


def reprojected(cells: DataFrame, source: Grid, target: Grid, inverse: Callable[[Column, Column], Column], method: str = "nearest") -> DataFrame:
    """(row, col, v) on the target grid. ``inverse`` maps (x, y) of the target's reference system to struct(x, y) of the source's.

    Only target cells whose centre falls on the source grid are joined; the
    others are null.
    """
    spark = cells.sparkSession
    grid = spark.range(target.nrow * target.ncol).select(F.floor(F.col("id") / target.ncol).cast("int").alias("row"), (F.col("id") % target.ncol).cast("int").alias("col"))
    x, y = target.west + (F.col("col") + 0.5) * target.res, target.north - (F.col("row") + 0.5) * target.res
    at = grid.select("row", "col", inverse(x, y).alias("p")).select("row", "col", ((F.lit(source.north) - F.col("p.y")) / source.res - 0.5).alias("y"), ((F.col("p.x") - F.lit(source.west)) / source.res - 0.5).alias("x"))
    on = F.col("y").between(-0.5, source.nrow - 0.5) & F.col("x").between(-0.5, source.ncol - 0.5)
    return sampled_at(at.filter(on), cells, method).unionByName(at.filter(~on | on.isNull()).select("row", "col", F.lit(None).cast("double").alias("v")))


def multiband(template: DataFrame, bands: dict[str, DataFrame], nodata: float = -1.0) -> DataFrame:
    """(row, col, one column per band): bands on the template's cells, nodata written as its sentinel."""
    found = template.select("row", "col")
    for name, band in bands.items():
        found = found.join(band.select("row", "col", F.col("v").alias(name)), ["row", "col"], "left")
    return found.select("row", "col", *[F.coalesce(F.col(n).cast("double"), F.lit(nodata)).alias(n) for n in bands])


def tiles(spark, nrow: int, ncol: int, size: tuple[int, int], halo: int) -> DataFrame:
    """(ti, tj, write and read windows): tiles of the grid, the read window wider by the halo."""
    th, tw = size
    grid = spark.range(-(-nrow // th)).select(F.col("id").cast("int").alias("ti")).withColumn("tj", F.explode(F.sequence(F.lit(0), F.lit(-(-ncol // tw) - 1))))
    r0, c0 = F.col("ti") * th, F.col("tj") * tw
    r1, c1 = F.least(r0 + th, F.lit(nrow)), F.least(c0 + tw, F.lit(ncol))
    return grid.select("ti", "tj", r0.alias("wr0"), r1.alias("wr1"), c0.alias("wc0"), c1.alias("wc1"), F.greatest(r0 - halo, F.lit(0)).alias("rr0"), F.least(r1 + halo, F.lit(nrow)).alias("rr1"), F.greatest(c0 - halo, F.lit(0)).alias("rc0"), F.least(c1 + halo, F.lit(ncol)).alias("rc1"))


def with_halo(cells: DataFrame, size: int, halo: int) -> DataFrame:
    """cells by each tile (ti, tj) that reads them; ``core`` marks the tile that owns the cell."""
    def span(k: str) -> Column:
        return F.sequence(F.floor((F.col(k) - halo) / size).cast("int"), F.floor((F.col(k) + halo) / size).cast("int"))

    spread = cells.withColumn("ti", F.explode(span("row"))).withColumn("tj", F.explode(span("col")))
    return spread.withColumn("core", (F.floor(F.col("row") / size) == F.col("ti")) & (F.floor(F.col("col") / size) == F.col("tj")))


def majority_filled(cells: DataFrame, k: int) -> DataFrame:
    """(row, col, v): unknown cells of a categorical raster take the commonest class within k, the smallest on ties, else stay null."""
    return _filled(cells, k, majority)
