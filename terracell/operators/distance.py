"""Distance fields: Euclidean distance and allocation, street-canyon width, rays."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terracell.operators import raster
from terracell.operators.kernels import nearest_in_row, widest_discs


def _nearest_in_row(table: pa.Table) -> pa.Table:
    """Nearest source of each cell of one raster row; s is the nearest source row in the cell's column (-1: none)."""
    col, s, row = table.column("col").to_numpy(), table.column("s").to_numpy(), table.column("row").to_numpy()
    low = int(col.min())
    own = np.full(int(col.max()) - low + 1, -1, dtype=np.int64)
    own[col - low] = s
    d2, from_row, from_col = (x[col - low] for x in nearest_in_row(own, int(row[0])))
    none = from_row < 0
    return pa.table({"row": pa.array(row, pa.int32()), "col": pa.array(col, pa.int32()), **{k: pa.array(v, pa.int64(), mask=none) for k, v in (("d2", d2), ("src_row", from_row), ("src_col", from_col + low))}})


def nearest_source(cells: DataFrame) -> DataFrame:
    """(row, col, d2, src_row, src_col) of a dense grid with ``src`` 1 on sources; exact; nulls if there is no source.

    Two separable passes: windows along columns find the nearest source row,
    then each raster row, one group, finds its nearest column. No cell meets
    all others.
    """
    up = Window.partitionBy("col").orderBy("row").rowsBetween(Window.unboundedPreceding, 0)
    # Backwards as well: a frame to the end of the column would be summed anew for each row.
    down = Window.partitionBy("col").orderBy(F.desc("row")).rowsBetween(Window.unboundedPreceding, 0)
    here = F.when(F.col("src") == 1, F.col("row"))
    above, below = F.last(here, ignorenulls=True).over(up), F.last(here, ignorenulls=True).over(down)
    passed = cells.select("row", "col", above.alias("a"), below.alias("b"))
    nearer = F.when(F.col("a").isNull(), F.col("b")).when(F.col("b").isNull() | (F.col("row") - F.col("a") <= F.col("b") - F.col("row")), F.col("a")).otherwise(F.col("b"))
    passed = passed.select("row", "col", F.coalesce(nearer, F.lit(-1)).cast("long").alias("s"))
    return passed.groupBy("row").applyInArrow(_nearest_in_row, "row int, col int, d2 long, src_row long, src_col long")


def distance(cells: DataFrame, res: float = 1.0) -> DataFrame:
    return nearest_source(cells).select("row", "col", (F.sqrt(F.col("d2").cast("double")) * res).alias("v"))


def allocation(cells: DataFrame, values: DataFrame) -> DataFrame:
    """(row, col, v): the value of the nearest source cell."""
    at = values.select(F.col("row").cast("long").alias("src_row"), F.col("col").cast("long").alias("src_col"), "v")
    return nearest_source(cells).join(at, ["src_row", "src_col"], "left").select("row", "col", "v")


def canyon_width(field: DataFrame, res: float, max_radius: float, tile: int | None = None) -> DataFrame:
    """(row, col, width, height) of street canyons from (row, col, d2, alloc).

    width is twice the largest clearance D(q) of a disc with |p - q| < D(q)
    that covers p (D in metres, at most max_radius); height is the mean
    allocated height over that disc. Of equal discs the first by row and
    column counts. Cells that no disc covers are left out. A tile reads a halo
    of two radii: that of the centres that may cover its cells, and that of
    their discs; tiles grow with the radius, so nine at most read a cell.
    """
    cap = float((max_radius / res) ** 2)
    reach = int(np.ceil(max_radius / res))

    def widest(columns, row, col, core):
        r2 = raster.laid_out(np.nan_to_num(np.minimum(columns["d2"], cap), nan=0.0), row, col, 0.0)
        present = raster.laid_out(np.ones(len(row)), row, col, 0.0) > 0
        size, height = widest_discs(r2, raster.laid_out(columns["alloc"], row, col), present, cap)
        at = row[core], col[core]
        return {"width": 2 * np.sqrt(size[at]) * res, "height": height[at]}

    cells = field.select("row", "col", "d2", "alloc")
    return raster.by_tiles(cells, tile or max(raster.TILE, 2 * reach), 2 * reach, widest, "width double, height double").filter(F.col("width").isNotNull())


def rays(cells: DataFrame, res: float, step: float, max_radius: float, tile: int | None = None) -> DataFrame:
    """(row, col, length, direction, svf) of open cells by casting rays, from (row, col, height) with height null in the open.

    length: the longest sum of two opposite rays to a building or max_radius;
    direction: its azimuth below 180 degrees, the smallest on ties; svf: one
    minus the mean squared sine of the highest elevation seen. Tiles read a
    halo of max_radius, so results do not depend on the tiling, and grow with
    it, so nine at most read a cell.
    """
    reach = int(np.ceil(max_radius / res))
    angles = np.arange(0.0, 360.0, step)
    half = len(angles) // 2

    def cast(columns, row, col, core):
        height = np.pad(raster.laid_out(columns["height"], row, col), reach, constant_values=np.nan)
        open_cells = core & np.isnan(columns["height"])
        r, c = row[open_cells] + reach, col[open_cells] + reach

        def ray(angle: float) -> tuple[np.ndarray, np.ndarray]:
            """(length, squared sine of the highest elevation) by cell."""
            turn = np.radians(angle)
            length, slope, open_yet = np.full(len(r), float(max_radius)), np.zeros(len(r)), np.ones(len(r), dtype=bool)
            for k in range(1, reach + 1):
                # Rounded first, so that halves are halves whatever the cosine's last digit.
                seen = height[r + int(np.rint(np.round(-k * np.cos(turn), 9))), c + int(np.rint(np.round(k * np.sin(turn), 9)))]
                hit = ~np.isnan(seen)
                slope[hit] = np.maximum(slope[hit], seen[hit] / (k * res))
                length[hit & open_yet] = min(k * res, max_radius)
                open_yet &= ~hit
            return length, slope * slope / (1 + slope * slope)

        best, direction, seen = np.full(len(r), -1.0), np.zeros(len(r)), np.zeros(len(r))
        for a in range(half):
            (ahead, one), (behind, other) = ray(angles[a]), ray(angles[half + a])
            wins = ahead + behind > best
            best[wins], direction[wins] = (ahead + behind)[wins], angles[a]
            seen += one + other
        for angle in angles[2 * half :]:
            seen += ray(angle)[1]
        out = {k: np.full(len(row), np.nan) for k in ("length", "direction", "svf")}
        for k, v in (("length", best), ("direction", direction), ("svf", 1 - seen / len(angles))):
            out[k][open_cells] = v
        return {k: v[core] for k, v in out.items()}

    found = raster.by_tiles(cells.select("row", "col", "height"), tile or max(raster.TILE, reach), reach, cast, "length double, direction double, svf double")
    return found.filter(F.col("length").isNotNull())
