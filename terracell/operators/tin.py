"""Triangulated surfaces: Delaunay triangulation and linear interpolation on cells."""

from __future__ import annotations

import tempfile
import uuid
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terracell.functions.hull import hull


#: Nodes of a block, on average.
BLOCK_NODES = 250


def _written(df: DataFrame, name: str) -> DataFrame:
    """df written once to spark.checkpoint.dir and read back; only local sessions may name no folder."""
    spark = df.sparkSession
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = Path(tempfile.mkdtemp(prefix="terracell-")).as_uri()
    path = f"{folder.rstrip('/')}/terracell/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def delaunay(points: np.ndarray) -> np.ndarray:
    """Triangles (indices, counter-clockwise) of distinct points by Bowyer and Watson; none for fewer than three.

    Whether a point is in a circle is decided in floats where they suffice and
    in exact integers elsewhere, so rows of nearly collinear points are safe.
    """
    n = len(points)
    if n < 3:
        return np.zeros((0, 3), dtype=int)
    mid, span = points.mean(0), max(float(np.ptp(points, axis=0).max()), 1.0) * 1e6
    p = np.vstack([points, mid + [[-3 * span, -span], [3 * span, -span], [0, 3 * span]]])
    ratios = [[v.as_integer_ratio() for v in q] for q in p.tolist()]
    scale = max(d for q in ratios for _, d in q)
    whole = [(x * (scale // dx), y * (scale // dy)) for (x, dx), (y, dy) in ratios]

    def exact(t, i):
        px, py = whole[i]
        (ax, ay), (bx, by), (cx, cy) = ((whole[k][0] - px, whole[k][1] - py) for k in t)
        return (ax * ax + ay * ay) * (bx * cy - cx * by) + (bx * bx + by * by) * (cx * ay - ax * cy) + (cx * cx + cy * cy) * (ax * by - bx * ay) > 0

    triangles = np.zeros((2 * n + 8, 3), dtype=int)
    corners = np.zeros((2, 3, 2 * n + 8))
    triangles[0] = n, n + 1, n + 2
    corners[:, :, 0] = p[triangles[0]].T
    held = 1
    for i in np.random.default_rng(5).permutation(n).tolist():
        (ax, bx, cx), (ay, by, cy) = corners[0, :, :held] - p[i, 0], corners[1, :, :held] - p[i, 1]
        a2, b2, c2 = ax * ax + ay * ay, bx * bx + by * by, cx * cx + cy * cy
        bc, cb, ca, ac, ab, ba = bx * cy, cx * by, cx * ay, ax * cy, ax * by, bx * ay
        det = a2 * (bc - cb) + b2 * (ca - ac) + c2 * (ab - ba)
        rounding = 1.5e-15 * (a2 * (abs(bc) + abs(cb)) + b2 * (abs(ca) + abs(ac)) + c2 * (abs(ab) + abs(ba)))
        bad = det > rounding
        for k in np.flatnonzero(abs(det) <= rounding).tolist():
            bad[k] = exact(triangles[k].tolist(), i)
        gone = np.flatnonzero(bad).tolist()
        edges = {e for t in triangles[gone].tolist() for e in ((t[0], t[1]), (t[1], t[2]), (t[2], t[0]))}
        rim = [(a, b) for a, b in edges if (b, a) not in edges]
        at = gone + list(range(held, held + len(rim) - len(gone)))
        triangles[at] = [(a, b, i) for a, b in rim]
        corners[:, :, at] = p[triangles[at]].transpose(2, 1, 0)
        held += len(rim) - len(gone)
    return triangles[:held][(triangles[:held] < n).all(1)]


def _in_box(centre: np.ndarray, r: float, box: tuple) -> tuple:
    """(x0, y0, x1, y1) around the part of a disk that lies in a box; x0 > x1 or y0 > y1 if there is none."""
    low, high = np.array(box[:2]), np.array(box[2:])
    away = np.maximum(0, np.maximum(low - centre, centre - high))
    half = np.sqrt(np.maximum(r * r - away[::-1] ** 2, 0))  # along x by how far the band of y is, and the reverse
    return (*np.maximum(centre - half, low), *np.minimum(centre + half, high))


def _block(nodes: np.ndarray, rows: range, cols: range, grid: tuple, seen: tuple, box: tuple, rim: np.ndarray) -> list | None:
    """(row, col, v) of a block's corners inside the hull from the nodes in seen; None where a triangle may change with more nodes.

    A triangle is one of all nodes' if its circle holds none of them, which is
    known if the circle's part in the box of all nodes lies in seen.
    """
    west, north, res = grid
    xs, ys = west + np.arange(cols.start, cols.stop) * res, north - np.arange(rows.start, rows.stop) * res
    whole = seen[0] <= box[0] and seen[1] <= box[1] and seen[2] >= box[2] and seen[3] >= box[3]
    value = np.full((len(ys), len(xs)), np.inf)
    for t in delaunay(nodes[:, :2]):
        (x1, y1, z1), (x2, y2, z2), (x3, y3, z3) = nodes[t]
        c0, c1 = np.searchsorted(xs, min(x1, x2, x3) - 1e-6), np.searchsorted(xs, max(x1, x2, x3) + 1e-6)
        r0, r1 = np.searchsorted(-ys, -max(y1, y2, y3) - 1e-6), np.searchsorted(-ys, -min(y1, y2, y3) + 1e-6)
        if c0 == c1 or r0 == r1:
            continue
        px, py = xs[c0:c1], ys[r0:r1, None]
        d = (y2 - y3) * (x1 - x3) + (x3 - x2) * (y1 - y3)
        a = ((y2 - y3) * (px - x3) + (x3 - x2) * (py - y3)) / d
        b = ((y3 - y1) * (px - x3) + (x1 - x3) * (py - y3)) / d
        inside = (a >= -1e-9) & (b >= -1e-9) & (a + b <= 1 + 1e-9)
        if not inside.any():
            continue
        if not whole:
            u, w = np.array([x2 - x1, y2 - y1]), np.array([x3 - x1, y3 - y1])
            u2, w2 = u @ u, w @ w
            off = np.array([w[1] * u2 - u[1] * w2, u[0] * w2 - w[0] * u2]) / (2 * d)
            r = float(np.sqrt(off @ off))
            r += r * min(1.0, 1e-9 + 1e-12 * max(u2, w2) ** 0.5 / abs(d)) + 1e-9
            part = _in_box(np.array([x1, y1]) + off, r, box)
            if part[0] < seen[0] or part[1] < seen[1] or part[2] > seen[2] or part[3] > seen[3]:
                return None
        z = a * z1 + b * z2 + (1 - a - b) * z3
        value[r0:r1, c0:c1] = np.where(inside, np.minimum(value[r0:r1, c0:c1], z), value[r0:r1, c0:c1])
    if not whole:
        ends = np.roll(rim, -1, 0) - rim
        within = np.ones(value.shape, dtype=bool)
        for (x, y), (dx, dy) in zip(rim, ends, strict=True):
            within &= dx * (ys[:, None] - y) - dy * (xs - x) >= -1e-9 * np.hypot(dx, dy)
        if (within & np.isinf(value)).any():
            return None
    return [(rows.start + int(r), cols.start + int(c), float(value[r, c])) for r, c in zip(*np.nonzero(np.isfinite(value)), strict=True)]


def triangulated(nodes: DataFrame, west: float, north: float, res: float, ncol: int, nrow: int, block_nodes: int = BLOCK_NODES) -> DataFrame:
    """(row, col, v) at the top-left corners of cells, linear inside the Delaunay triangles of all nodes (x, y, v); corners outside all are absent.

    Blocks of cells triangulate their own nodes and those of a halo. Where a
    triangle over one of its corners could change with nodes farther away, a
    block is tried again with twice the halo. No task needs all nodes unless a
    triangle's circle reaches over all of them. Where four nodes or more are on
    one circle, blocks may choose different, equally valid triangles.
    """
    spark = nodes.sparkSession
    nodes = _written(nodes.select(*(F.col(k).cast("double").alias(k) for k in ("x", "y", "v"))), "tin-nodes")
    n, *box = nodes.agg(F.count("*"), F.min("x"), F.min("y"), F.max("x"), F.max("y")).first()
    none = spark.createDataFrame([], "row int, col int, v double")
    if n < 3:
        return none

    def own_hull(batches):
        for batch in batches:
            yield pd.DataFrame(hull(list(zip(batch["x"], batch["y"], strict=True))), columns=["x", "y"])

    rim = np.array(hull([tuple(r) for r in nodes.select("x", "y").mapInPandas(own_hull, "x double, y double").collect()]))
    if len(rim) < 3:
        return none
    size = max((box[2] - box[0]) * (box[3] - box[1]) * block_nodes / n, 1e-12) ** 0.5
    side, halo = max(1, int(size / res)), size / 2
    first = [max(0, int(v) // side) for v in ((north - box[3]) / res, (box[0] - west) / res)]
    last = [min(most - 1, int(v)) // side for v, most in (((north - box[1]) / res, nrow), ((box[2] - west) / res, ncol))]
    high, wide = (max(0, b - a + 1) for a, b in zip(first, last, strict=True))
    todo = spark.range(high * wide).select((F.lit(first[0]) + F.floor(F.col("id") / max(1, wide))).cast("int").alias("i"), (F.lit(first[1]) + F.col("id") % max(1, wide)).cast("int").alias("j"))

    def block_with(halo, reach):
        def run(key, own):
            i, j = (int(k) for k in key)
            own = own[["x", "y", "v"]].dropna().sort_values(["x", "y"]).to_numpy(dtype=float)
            left, top = west + j * side * res - halo, north - i * side * res + halo
            rows, cols = range(i * side, min(nrow, i * side + side)), range(j * side, min(ncol, j * side + side))
            known = _block(own, rows, cols, (west, north, res), (left, top - reach, left + reach, top), tuple(box), rim)
            listed = [(i, j, None, None, None)] if known is None else [(i, j, *k) for k in known]
            kinds = {"i": "Int32", "j": "Int32", "row": "Int32", "col": "Int32", "v": "Float64"}
            return pd.DataFrame({k: pd.array([r[c] for r in listed], dtype=t) for c, (k, t) in enumerate(kinds.items())})

        return run

    found = none
    while True:
        reach = (side - 1) * res + 2 * halo
        left, top = west + F.col("j") * side * res - halo, north - F.col("i") * side * res + halo
        zone = lambda v: F.floor(v / reach)
        spread = todo.withColumns({"x0": left, "y0": top - reach, "x1": left + reach, "y1": top})
        spread = spread.withColumn("zx", F.explode(F.sequence(zone(F.col("x0")), zone(F.col("x1"))))).withColumn("zy", F.explode(F.sequence(zone(F.col("y0")), zone(F.col("y1")))))
        placed = nodes.withColumns({"zx": zone(F.col("x")), "zy": zone(F.col("y"))})
        near = spread.join(placed, ["zx", "zy"]).filter(F.col("x").between(F.col("x0"), F.col("x1")) & F.col("y").between(F.col("y0"), F.col("y1"))).select("i", "j", "x", "y", "v")
        # A row without a node keeps blocks that see none.
        near = near.unionByName(todo.select("i", "j", *(F.lit(None).cast("double").alias(k) for k in ("x", "y", "v"))))

        done = _written(near.groupBy("i", "j").applyInPandas(block_with(halo, reach), "i int, j int, row int, col int, v double"), "tin-blocks")
        found = found.unionByName(done.filter("row IS NOT NULL").select("row", "col", "v"))
        todo = done.filter("row IS NULL").select("i", "j")
        if todo.isEmpty():
            return found
        halo *= 2


def interpolated(triangles: DataFrame, west: float, north: float, res: float, ncol: int, nrow: int) -> DataFrame:
    """(row, col, v) at the top-left corners of cells, linear inside each triangle (x1, y1, z1, ..., z3); cells outside all are absent.

    Each triangle spans the cells of its box; a corner on a shared edge takes
    the smallest value, which differs by rounding only.
    """
    x = [F.col(f"x{k}") for k in (1, 2, 3)]
    y = [F.col(f"y{k}") for k in (1, 2, 3)]

    def index(v, most):
        return F.greatest(F.lit(0), F.least(F.lit(most - 1), v.cast("int")))

    rows = F.sequence(index(F.floor((north - F.greatest(*y)) / res), nrow), index(F.ceil((north - F.least(*y)) / res), nrow))
    cols = F.sequence(index(F.floor((F.least(*x) - west) / res), ncol), index(F.ceil((F.greatest(*x) - west) / res), ncol))
    at = triangles.withColumn("row", F.explode(rows)).withColumn("col", F.explode(cols))
    px, py = west + F.col("col") * res, north - F.col("row") * res
    d = (y[1] - y[2]) * (x[0] - x[2]) + (x[2] - x[1]) * (y[0] - y[2])
    a = F.try_divide((y[1] - y[2]) * (px - x[2]) + (x[2] - x[1]) * (py - y[2]), d)
    b = F.try_divide((y[2] - y[0]) * (px - x[2]) + (x[0] - x[2]) * (py - y[2]), d)
    at = at.withColumns({"a": a, "b": b}).filter((F.col("a") >= -1e-9) & (F.col("b") >= -1e-9) & (F.col("a") + F.col("b") <= 1 + 1e-9))
    z = F.col("a") * F.col("z1") + F.col("b") * F.col("z2") + (1 - F.col("a") - F.col("b")) * F.col("z3")
    return at.groupBy("row", "col").agg(F.min(z).alias("v"))
