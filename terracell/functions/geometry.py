"""Geometry as Column expressions over rings, arrays of struct<x, y> (open: the last point is not repeated)."""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from terracell.operators.kernels import clip_rings, smallest_boxes


def rectangle(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """Counter-clockwise ring of a rectangle."""
    return F.array(*[F.struct(x.alias("x"), y.alias("y")) for x, y in ((x0, y0), (x1, y0), (x1, y1), (x0, y1))])


def _edges(ring: Column) -> Column:
    """struct(a, b) of each edge, the closing one included."""
    turned = F.concat(F.slice(ring, 2, F.greatest(F.size(ring) - 1, F.lit(0))), F.slice(ring, 1, 1))
    return F.zip_with(ring, turned, lambda a, b: F.struct(a.alias("a"), b.alias("b")))


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda s, v: s + v)


def signed_area(ring: Column) -> Column:
    return _sum(F.transform(_edges(ring), lambda e: e["a"]["x"] * e["b"]["y"] - e["b"]["x"] * e["a"]["y"])) / 2


def area(ring: Column) -> Column:
    return F.abs(signed_area(ring))


def perimeter(ring: Column) -> Column:
    return _sum(F.transform(_edges(ring), lambda e: F.hypot(e["b"]["x"] - e["a"]["x"], e["b"]["y"] - e["a"]["y"])))


def centroid(ring: Column) -> Column:
    """struct(x, y), null for a ring without area."""
    a6 = signed_area(ring) * 6

    def axis(k: str) -> Column:
        return _sum(F.transform(_edges(ring), lambda e: (e["a"][k] + e["b"][k]) * (e["a"]["x"] * e["b"]["y"] - e["b"]["x"] * e["a"]["y"]))) / a6

    return F.when(a6 != 0, F.struct(axis("x").alias("x"), axis("y").alias("y")))


def isoquotient(ring: Column) -> Column:
    """4 * 3.14159 * area / perimeter ** 2, with pi truncated as published."""
    return F.try_divide(F.lit(4 * 3.14159) * area(ring), perimeter(ring) * perimeter(ring))


def contains(ring: Column, x: Column, y: Column) -> Column:
    """Even-odd rule: whether the point is inside; each edge owns its lower end."""
    crossings = F.filter(
        _edges(ring),
        lambda e: ((e["a"]["y"] > y) != (e["b"]["y"] > y)) & (x < F.try_divide((e["b"]["x"] - e["a"]["x"]) * (y - e["a"]["y"]), e["b"]["y"] - e["a"]["y"]) + e["a"]["x"]),
    )
    return F.size(crossings) % 2 == 1


def segment_distance2(px: Column, py: Column, x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """Squared distance of a point to a segment."""
    dx, dy = x2 - x1, y2 - y1
    t = F.coalesce(F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.try_divide((px - x1) * dx + (py - y1) * dy, dx * dx + dy * dy))), F.lit(0.0))
    ex, ey = px - (x1 + t * dx), py - (y1 + t * dy)
    return ex * ex + ey * ey


def segment_box_distance2(x1: Column, y1: Column, x2: Column, y2: Column, box: tuple) -> Column:
    """Squared distance of a segment to a closed box (west, south, east, north), of columns: 0 where they meet."""
    west, south, east, north = box
    corners = [(west, south), (west, north), (east, south), (east, north)]
    sides = [(x2 - x1) * (y - y1) - (y2 - y1) * (x - x1) for x, y in corners]
    overlap = (F.least(x1, x2) <= east) & (F.greatest(x1, x2) >= west) & (F.least(y1, y2) <= north) & (F.greatest(y1, y2) >= south)
    meet = overlap & (F.least(*sides) <= 0) & (F.greatest(*sides) >= 0)

    def to_box(x, y):
        dx, dy = F.greatest(F.lit(0.0), west - x, x - east), F.greatest(F.lit(0.0), south - y, y - north)
        return dx * dx + dy * dy

    near = [segment_distance2(x, y, x1, y1, x2, y2) for x, y in corners]
    return F.when(meet, F.lit(0.0)).otherwise(F.least(*near, to_box(x1, y1), to_box(x2, y2)))


def ring_distance2(ring: Column, x: Column, y: Column) -> Column:
    """Squared distance of a point to a polygon: 0 inside."""
    near = F.array_min(F.transform(_edges(ring), lambda e: segment_distance2(x, y, e["a"]["x"], e["a"]["y"], e["b"]["x"], e["b"]["y"])))
    return F.when(contains(ring, x, y), F.lit(0.0)).otherwise(near)


def crossing(p: tuple, q: tuple) -> Column:
    """struct(x, y) where two segments (x1, y1, x2, y2) cross properly, else null."""
    (ax, ay, bx, by), (cx, cy, dx, dy) = p, q
    den = (bx - ax) * (dy - cy) - (by - ay) * (dx - cx)
    t = F.try_divide((cx - ax) * (dy - cy) - (cy - ay) * (dx - cx), den)
    u = F.try_divide((cx - ax) * (by - ay) - (cy - ay) * (bx - ax), den)
    return F.when((t > 0) & (t < 1) & (u > 0) & (u < 1), F.struct((ax + t * (bx - ax)).alias("x"), (ay + t * (by - ay)).alias("y")))


def clip_segment(x1: Column, y1: Column, x2: Column, y2: Column, box: tuple) -> Column:
    """struct(x1, y1, x2, y2) of the part of a segment inside a closed box (Liang and Barsky), else null."""
    west, south, east, north = (F.lit(float(v)) for v in box)
    dx, dy = x2 - x1, y2 - y1
    low, high, inside = F.lit(0.0), F.lit(1.0), F.lit(True)
    for p, q in ((-dx, x1 - west), (dx, east - x1), (-dy, y1 - south), (dy, north - y1)):
        r = F.try_divide(q, p)
        low = F.when(p < 0, F.greatest(low, r)).otherwise(low)
        high = F.when(p > 0, F.least(high, r)).otherwise(high)
        inside = inside & ((p != 0) | (q >= 0))
    return F.when(inside & (low <= high), F.struct((x1 + low * dx).alias("x1"), (y1 + low * dy).alias("y1"), (x1 + high * dx).alias("x2"), (y1 + high * dy).alias("y2")))


def smallest_box(ring: Column, step: int = 5) -> Column:
    """struct(key, angle, length, width): the first bounding box of least area over angles from 0 below 180 degrees, areas (key) to 6 places."""

    @F.arrow_udf("struct<key:double,angle:int,length:double,width:double>")
    def boxes(rings: pa.Array) -> pa.Array:
        return smallest_boxes(rings, step)

    return boxes(ring)


#: WGS 84 (fixed values) and the third-order coefficients of the Krueger series.
_A, _F = 6378137.0, 1 / 298.257223563
_N = _F / (2 - _F)
_RADIUS = _A / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64)
_ALPHA = (_N / 2 - 2 * _N**2 / 3 + 5 * _N**3 / 16, 13 * _N**2 / 48 - 3 * _N**3 / 5, 61 * _N**3 / 240)


def utm(lon: Column, lat: Column, zone: int, south: bool = False) -> Column:
    """struct(x, y): transverse Mercator of a UTM zone."""
    phi, lam = F.radians(lat), F.radians(lon - F.lit(float(zone * 6 - 183)))
    k = 2 * math.sqrt(_N) / (1 + _N)
    t = F.sinh(F.atanh(F.sin(phi)) - F.lit(k) * F.atanh(F.lit(k) * F.sin(phi)))
    xi = F.atan2(t, F.cos(lam))
    eta = F.atanh(F.sin(lam) / F.sqrt(1 + t * t))
    x, y = eta, xi
    for j, a in enumerate(_ALPHA, 1):
        x = x + F.lit(a) * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
        y = y + F.lit(a) * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
    scale = 0.9996 * _RADIUS
    return F.struct((F.lit(500000.0) + F.lit(scale) * x).alias("x"), (F.lit(10000000.0 if south else 0.0) + F.lit(scale) * y).alias("y"))


#: Coefficients of the inverse series.
_BETA = (_N / 2 - 2 * _N**2 / 3 + 37 * _N**3 / 96, _N**2 / 48 + _N**3 / 15, 17 * _N**3 / 480)
_DELTA = (2 * _N - 2 * _N**2 / 3 - 2 * _N**3, 7 * _N**2 / 3 - 8 * _N**3 / 5, 56 * _N**3 / 15)


def utm_inverse(x: Column, y: Column, zone: int, south: bool = False) -> Column:
    """struct(lon, lat) in degrees of a position in a UTM zone."""
    scale = F.lit(0.9996 * _RADIUS)
    xi, eta = (y - F.lit(10000000.0 if south else 0.0)) / scale, (x - F.lit(500000.0)) / scale
    u, v = xi, eta
    for j, b in enumerate(_BETA, 1):
        u = u - F.lit(b) * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
        v = v - F.lit(b) * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
    chi = F.asin(F.sin(u) / F.cosh(v))
    lat = chi
    for j, d in enumerate(_DELTA, 1):
        lat = lat + F.lit(d) * F.sin(2 * j * chi)
    return F.struct((F.degrees(F.atan2(F.sinh(v), F.cos(u))) + F.lit(float(zone * 6 - 183))).alias("lon"), F.degrees(lat).alias("lat"))


def polar_stereographic(lon: Column, lat: Column, lon0: float = -45.0, true_scale: float = 70.0) -> Column:
    """struct(x, y) of the north polar stereographic projection with its latitude of true scale."""
    e = math.sqrt(2 * _F - _F * _F)
    ts = math.radians(true_scale)
    t_ts = math.tan(math.pi / 4 - ts / 2) / ((1 - e * math.sin(ts)) / (1 + e * math.sin(ts))) ** (e / 2)
    m_ts = math.cos(ts) / math.sqrt(1 - e * e * math.sin(ts) ** 2)
    phi, lam = F.radians(lat), F.radians(lon - F.lit(lon0))
    t = F.tan(F.lit(math.pi / 4) - phi / 2) / F.pow((1 - e * F.sin(phi)) / (1 + e * F.sin(phi)), F.lit(e / 2))
    rho = F.lit(_A * m_ts / t_ts) * t
    return F.struct((rho * F.sin(lam)).alias("x"), (-rho * F.cos(lam)).alias("y"))


def clip_ring(ring: Column, box: tuple) -> Column:
    """The part of a ring inside a closed box (west, south, east, north); empty outside, null for a null ring."""

    @F.arrow_udf("array<struct<x:double,y:double>>")
    def clipped(rings: pa.Array) -> pa.Array:
        return clip_rings(rings, box)

    return clipped(ring)
