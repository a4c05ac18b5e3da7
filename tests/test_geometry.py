import math

from pyspark.sql import functions as F

from terracell.functions import geometry as G
from terracell.operators import raster


def test_utm_round_trip_and_known_point(spark):
    df = spark.createDataFrame([(84.0, 0.5), (87.0, 56.5), (89.9, 71.0), (86.2, -33.0)], "lon double, lat double")
    for south in (False, True):
        p = df.select("lon", "lat", G.utm(F.col("lon"), F.col("lat"), 45, south).alias("p"))
        for r in p.select("lon", "lat", G.utm_inverse(F.col("p.x"), F.col("p.y"), 45, south).alias("q")).collect():
            assert abs(r.q.lon - r.lon) < 1e-8 and abs(r.q.lat - r.lat) < 1e-8
    centre = df.select(G.utm(F.lit(87.0), F.lit(0.0), 45).alias("p")).first().p
    assert (round(centre.x, 6), round(centre.y, 6)) == (500000.0, 0.0)


def test_polar_stereographic(spark):
    p = spark.range(1).select(G.polar_stereographic(F.lit(-45.0), F.lit(90.0)).alias("pole"), G.polar_stereographic(F.lit(-45.0), F.lit(70.0)).alias("a"), G.polar_stereographic(F.lit(-45.0), F.lit(70.001)).alias("b"), G.polar_stereographic(F.lit(45.0), F.lit(80.0)).alias("c")).first()
    assert math.hypot(p.pole.x, p.pole.y) < 1e-6 and abs(p.a.x) < 1e-6 and p.a.y < 0
    assert abs((p.b.y - p.a.y) / 111.56 - 1) < 1e-3  # true scale: about 111.56 m for a thousandth of a degree of latitude
    assert p.c.x > 0 and abs(p.c.y) < 1e-6


def test_clip_ring(spark):
    ring = G.rectangle(*[F.lit(float(v)) for v in (0, 0, 10, 10)])
    tri = F.array(*[F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y")) for x, y in ((0, 0), (8, 0), (0, 8))])
    r = spark.range(1).select(G.area(G.clip_ring(ring, (5, 5, 20, 20))).alias("a"), G.area(G.clip_ring(ring, (2, 2, 4, 4))).alias("b"), F.size(G.clip_ring(ring, (50, 50, 60, 60))).alias("n"), G.area(G.clip_ring(tri, (0, 0, 4, 4))).alias("t")).first()
    assert (r.a, r.b, r.n, r.t) == (25.0, 4.0, 0, 16.0)


def test_majority_fill(spark):
    df = spark.createDataFrame([(0, 0, 3.0), (0, 1, None), (0, 2, 3.0), (1, 1, 2.0), (9, 9, None), (5, 5, None), (5, 4, 7.0), (5, 6, 6.0)], "row int, col int, v double")
    got = {(r.row, r.col): r.v for r in raster.majority_filled(df, 1).collect()}
    assert got[0, 1] == 3.0 and got[9, 9] is None and got[5, 5] == 6.0
