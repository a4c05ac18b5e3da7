"""Array kernels against plain loops, and at the sizes that real rasters have."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from terracell.operators import distance, kernels, raster
from terracell.schema import Grid


def plain_discs(r2, alloc, present):
    rows, cols = np.mgrid[0 : r2.shape[0], 0 : r2.shape[1]]
    size, height = np.full(r2.shape, np.nan), np.full(r2.shape, np.nan)
    order = sorted(((-r2[r, c], r, c) for r, c in np.argwhere(r2 > 0)), reverse=True)
    for negative, r, c in order:
        inside = (rows - r) ** 2 + (cols - c) ** 2 < -negative
        own = inside & present & ~np.isnan(alloc)
        size[inside], height[inside] = -negative, alloc[own].mean() if own.any() else np.nan
    return size, height


@pytest.mark.parametrize("share,cap", [(0.1, 9.0), (0.02, 30.5), (0.002, 36.0), (0.002, 1e6)])
def test_widest_discs(share, cap):
    draw = np.random.default_rng(int(cap))
    source = draw.random((40, 37)) < share
    source[3, 5] = True
    at = np.argwhere(source)
    rows, cols = np.mgrid[0:40, 0:37]
    d2 = np.min((rows[..., None] - at[:, 0]) ** 2 + (cols[..., None] - at[:, 1]) ** 2, axis=2).astype(float)
    alloc = draw.integers(0, 50, d2.shape).astype(float)
    alloc[draw.random(d2.shape) < 0.1] = np.nan
    r2 = np.minimum(d2, cap)
    found, wanted = kernels.widest_discs(r2, alloc, np.ones(d2.shape, bool), cap), plain_discs(r2, alloc, np.ones(d2.shape, bool))
    for a, b in zip(found, wanted):
        assert np.allclose(a, b, equal_nan=True)


def test_nearest_in_row():
    draw = np.random.default_rng(3)
    for width in (1, 2, 3, 17, 64, 301):
        for share in (0.0, 0.05, 0.6, 1.0):
            own = np.where(draw.random(width) < share, draw.integers(0, 12, width), -1)
            best = [min((((s - 6) ** 2 + (x - j) ** 2, s, j) for j, s in enumerate(own.tolist()) if s >= 0), default=None) for x in range(width)]
            d2, row, col = kernels.nearest_in_row(own, 6)
            assert [None if r < 0 else (d, r, c) for d, r, c in zip(d2.tolist(), row.tolist(), col.tolist())] == best


@pytest.mark.parametrize("k", [3, 20])
def test_disc_rules(k):
    draw = np.random.default_rng(k)
    values = np.where(draw.random((45, 50)) < 0.03, draw.integers(0, 4, (45, 50)).astype(float), np.nan)
    at = np.nonzero(np.isnan(values))
    known = np.argwhere(~np.isnan(values))
    d2 = (at[0][:, None] - known[:, 0]) ** 2 + (at[1][:, None] - known[:, 1]) ** 2
    near, v = d2 <= k * k, values[tuple(known.T)]
    with np.errstate(invalid="ignore"):
        wanted = (near * v / d2).sum(1) / (near / d2).sum(1)
    assert np.allclose(kernels.inverse_distance(values, at, k), wanted, equal_nan=True)
    votes = np.array([[(n & (v == c)).sum() for c in range(4)] for n in near])
    assert np.allclose(kernels.majority(values, at, k), np.where(votes.sum(1) > 0, votes.argmax(1), np.nan), equal_nan=True)


def test_cells_of_rings_in_small_steps(monkeypatch):
    rings = [[(0, 0), (9, 1), (4, 4), (8, 9), (1, 8)], [], [(2.5, 2.5)], [(5, 5), (5, 5), (7, 7)]]
    column = pa.array([[{"x": float(x), "y": float(y)} for x, y in r] for r in rings] + [None])
    wanted = []
    for f, ring in enumerate(rings):
        for r in range(10):
            for c in range(10):
                x, y = c + 0.5, 10 - (r + 0.5)
                edges = list(zip(ring, ring[1:] + ring[:1]))
                if sum((a[1] > y) != (b[1] > y) and x < (b[0] - a[0]) * (y - a[1]) / (b[1] - a[1]) + a[0] for a, b in edges) % 2:
                    wanted.append((f, r, c))
    for pairs in (1 << 20, 7):
        monkeypatch.setattr(kernels, "PAIRS", pairs)
        for some in (column, pa.concat_arrays([column[:1], column]).slice(1)):
            got = [tuple(x) for part in kernels.cells_of_rings(some, 0.0, 10.0, 1.0, 10, 10) for x in zip(*(v.tolist() for v in part))]
            assert sorted(got) == wanted
    near = {(f, r, c) for part in kernels.cells_of_rings(column, 0.0, 10.0, 1.0, 10, 10, reach=1.0) for f, r, c in zip(*(v.tolist() for v in part))}
    assert {(2, 7, 2), (2, 6, 2), (2, 7, 1)} <= near and set(wanted) <= near


def test_smallest_boxes():
    square = [{"x": 0.0, "y": 0.0}, {"x": 2.0, "y": 0.0}, {"x": 2.0, "y": 1.0}, {"x": 0.0, "y": 1.0}]
    got = kernels.smallest_boxes(pa.array([None, square, [], [{"x": 1.0, "y": 1.0}]])).to_pylist()
    assert got == [None, {"key": 2.0, "angle": 0, "length": 2.0, "width": 1.0}, None, {"key": 0.0, "angle": 0, "length": 0.0, "width": 0.0}]


@pytest.fixture(scope="module")
def town(spark):
    n = 512
    cells = spark.range(n * n).select(F.floor(F.col("id") / n).cast("int").alias("row"), (F.col("id") % n).cast("int").alias("col"))
    street = (F.pmod(F.col("row"), F.lit(61)) < 23) | (F.pmod(F.col("col"), F.lit(97)) < 31) | ((F.col("row") > 300) & (F.col("col") > 250))
    return cells.withColumn("src", F.when(street, 0).otherwise(1)).persist()


def test_canyons_at_the_size_of_real_rasters(spark, town):
    near = distance.nearest_source(town).select("row", "col", "d2", (F.col("src_row") % 9 + 1).cast("double").alias("alloc")).persist()
    assert near.count() == 512 * 512
    found = distance.canyon_width(near, 5.0, 1000.0)
    assert found.agg(F.max("width")).first()[0] > 400 and found.count() > 100_000
    few = near.filter("row < 90 and col < 120")
    one, many = (sorted(map(tuple, distance.canyon_width(few, 5.0, 60.0, tile=t).collect())) for t in (512, 33))
    assert np.allclose(one, many)


def test_gaps_at_the_size_of_real_rasters(spark, town):
    known = F.when((F.col("src") == 1) & (F.col("row") < 200), (F.col("row") + F.col("col")).cast("double"))
    cells = town.select("row", "col", known.alias("v"))
    for k in (50, 1000):
        filled = raster.gap_filled(cells, k).persist()
        assert filled.count() == 512 * 512
        missing = filled.filter("v is null").count()
        assert missing == 0 if k == 1000 else missing > 1000
    hole = cells.filter("v is null and row between 100 and 260").orderBy("row", "col").first()
    near = cells.filter(F.col("v").isNotNull()).withColumn("d2", (F.col("row") - hole.row) ** 2 + (F.col("col") - hole.col) ** 2)
    wanted = near.agg((F.sum(F.col("v") / F.col("d2")) / F.sum(1 / F.col("d2")))).first()[0]
    assert abs(filled.filter((F.col("row") == hole.row) & (F.col("col") == hole.col)).first().v - wanted) < 1e-6


def test_resampling_methods(spark):
    cells = spark.range(400).select(F.floor(F.col("id") / 20).cast("int").alias("row"), (F.col("id") % 20).cast("int").alias("col")).withColumn("v", 2.0 * F.col("row") + 3.0 * F.col("col"))
    targets = spark.range(36).select(F.floor(F.col("id") / 6).cast("int").alias("row"), (F.col("id") % 6).cast("int").alias("col"))
    for method in ("bilinear", "cubic"):
        got = {(r.row, r.col): r.v for r in raster.resampled(cells, targets, 2.5, method).collect()}
        assert all(abs(got[r, c] - (2 * ((r + 0.5) * 2.5 - 0.5) + 3 * ((c + 0.5) * 2.5 - 0.5))) < 1e-9 for r in range(1, 5) for c in range(1, 5))
    with pytest.raises(ValueError, match="unknown method"):
        raster.resampled(cells, targets, 2.5, "lanczos")
    moved = raster.reprojected(cells, Grid(0.0, 20.0, 1.0, 20, 20), Grid(0.0, 44.0, 2.0, 22, 20), lambda x, y: F.struct((x / 2).alias("x"), (y / 2).alias("y")))
    got = {(r.row, r.col): r.v for r in moved.collect()}
    assert len(got) == 440 and all(got[r, c] is None for r in (0, 1) for c in range(20)) and all(got[r, c] == 2.0 * (r - 2) + 3.0 * c for r in range(2, 22) for c in range(20))


def test_clip_rings():
    def ring(*points):
        return [{"x": float(x), "y": float(y)} for x, y in points]

    square, far, across = ring((0, 0), (4, 0), (4, 4), (0, 4)), ring((9, 9), (10, 9), (9, 10)), ring((-1, 1), (5, 1), (5, 3), (-1, 3))
    column = pa.concat_arrays([pa.array([square]), pa.array([None, square, [], far, across])]).slice(1)
    got = kernels.clip_rings(column, (1.0, 0.0, 3.0, 2.0)).to_pylist()
    assert got[0] is None and got[2] == [] and got[3] == []
    for ring_, wanted in ((got[1], 4.0), (got[4], 2.0)):
        x, y = [p["x"] for p in ring_], [p["y"] for p in ring_]
        area = sum(x[k] * y[(k + 1) % len(x)] - x[(k + 1) % len(x)] * y[k] for k in range(len(x))) / 2
        assert abs(area - wanted) < 1e-12 and min(x) >= 1 and max(x) <= 3 and min(y) >= 0 and max(y) <= 2
