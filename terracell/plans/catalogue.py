"""The catalogue of named queries, each with DuckDB SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terracell.functions import geometry as G
from terracell.operators import distance, features, raster, tin
from terracell.plans import fixtures as X
from terracell.schema import Grid

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    def register(f: Query) -> Query:
        key = name or f.__name__
        _QUERIES[key] = f
        if sql is not None:
            _SQL[key] = X.WITH + sql
        return f

    return register


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def _bld(s, d):
    return X.relation(s, d, X.BLD)


def _ring(df: DataFrame, grow: float = 1.0) -> DataFrame:
    return df.withColumn("ring", G.rectangle(F.col("x0"), F.col("y0"), F.col("x0") + F.col("w") * grow, F.col("y0") + F.col("h") * grow))


def _cells(s, d):
    return X.relation(s, d, X.CELLS)


def _roads(s, d):
    return X.relation(s, d, X.ROADS)


def _prepared(s, d):
    found = features.left_params(_bld(s, d), X.relation(s, d, X.DEM).withColumnRenamed("max_value", "min_dem"), X.relation(s, d, X.WIDTH), X.relation(s, d, X.LCZ))
    return found.withColumn("calc_height", features.derived_height(F.col("height"), F.col("num_floors")))


PREPARED = """, prepared AS (SELECT b.*, d.max_value AS min_dem, w.width_med, l.majority_100m,
 CASE WHEN b.height IS NOT NULL AND b.height<>0 THEN b.height ELSE CAST(b.num_floors*3 AS DOUBLE) END AS calc_height
 FROM bld b LEFT JOIN dem d ON b.id=d.id LEFT JOIN width w ON b.id=w.id LEFT JOIN lczs l ON b.id=l.id) """


@query("SELECT id, height, num_floors, class, subtype FROM bld")
def proj_feature_columns(s, d):
    return _bld(s, d).select("id", "height", "num_floors", "class", "subtype")


@query("SELECT b.seq, d.max_value FROM bld b JOIN dem d ON CAST(b.seq AS VARCHAR)=d.id")
def cast_join_keys(s, d):
    return _bld(s, d).select(F.col("seq").cast("string").alias("id"), "seq").join(X.relation(s, d, X.DEM), "id").select("seq", "max_value")


@query(PREPARED + "SELECT id, min_dem, width_med, majority_100m FROM prepared")
def join_left_params(s, d):
    return _prepared(s, d).select("id", "min_dem", "width_med", "majority_100m")


@query("""SELECT b.id, v.l_extendedprice AS value FROM bld b LEFT JOIN (SELECT l_partkey, l_extendedprice, row_number() OVER (PARTITION BY l_partkey
 ORDER BY l_orderkey DESC, l_linenumber DESC, l_suppkey DESC, l_extendedprice DESC) AS n FROM lineitem) v ON b.seq=v.l_partkey AND v.n=1""")
def join_lookup_last_wins(s, d):
    last = features.last_wins(X.table(s, d, "lineitem"), "l_partkey", "l_extendedprice", ["l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice"])
    return _bld(s, d).join(last, F.col("seq") == F.col("l_partkey"), "left").select("id", F.col("l_extendedprice").alias("value"))


@query("SELECT id, TRY_CAST(coalesce(width_value, CAST(id AS VARCHAR)) AS DOUBLE) AS value FROM roads")
def safe_numeric_cast(s, d):
    return _roads(s, d).select("id", F.coalesce("width_value", F.col("id").cast("string")).try_cast("double").alias("value"))


@query("SELECT id, coalesce(height, 0) AS height, coalesce(CAST(num_floors AS DOUBLE), 0) AS num_floors, coalesce(class, 'unknown') AS class, coalesce(subtype, 'unknown') AS subtype FROM bld")
def impute_defaults(s, d):
    return features.imputed_defaults(_bld(s, d), ["height", "num_floors"], ["class", "subtype"]).select("id", "height", "num_floors", "class", "subtype")


@query(PREPARED + "SELECT id, calc_height FROM prepared")
def derive_height(s, d):
    return _bld(s, d).select("id", features.derived_height(F.col("height"), F.col("num_floors")).alias("calc_height"))


@query(PREPARED + "SELECT id, class, min_dem, calc_height FROM prepared WHERE class IS NOT NULL AND min_dem IS NOT NULL AND calc_height>=1")
def training_filter(s, d):
    return features.training_rows(_prepared(s, d), ["class", "min_dem"], "calc_height").select("id", "class", "min_dem", "calc_height")


@query(PREPARED + "SELECT id, min_dem, min_dem IS NULL OR min_dem<0 AS problem FROM prepared")
def anomaly_split(s, d):
    return _prepared(s, d).select("id", "min_dem", features.is_problem(F.col("min_dem")).alias("problem"))


@query("""SELECT id, CASE WHEN height IS NULL OR height=0 THEN greatest(0.0, round_even(seq%50/4.0-1.2, 0))::DOUBLE ELSE height END AS calc_height,
 CASE WHEN height IS NULL OR height=0 THEN 1 ELSE 0 END::INT AS predicted FROM bld""")
def fill_missing_heights(s, d):
    stand_in = F.col("seq") % 50 / F.lit(4.0) - F.lit(1.2)
    missing = F.col("height").isNull() | (F.col("height") == 0)
    return _bld(s, d).select("id", features.filled_height(F.col("height"), stand_in).alias("calc_height"), missing.cast("int").alias("predicted"))


ROAD_SQL = """, parsed AS (SELECT *, coalesce(TRY_CAST(regexp_extract(width_value, '^\\[\\{"value": ([0-9.]+)\\}', 1) AS DOUBLE), TRY_CAST(width_value AS DOUBLE)) AS width FROM roads),
 buffered AS (SELECT *, CASE WHEN width IS NOT NULL THEN width/2 WHEN class='path' THEN 0 WHEN subtype<>'road' THEN 0
 WHEN class IN ('cycleway','road','bridleway','unclassified') THEN 2.25 WHEN class IN ('living_street','residential','service') THEN 3
 WHEN class IN ('primary','secondary','tertiary','unknown','trunk','motorway','raceway') THEN 8 WHEN class IN ('footway','pedestrian') THEN 0.5 ELSE 0 END::DOUBLE AS radius FROM parsed) """


def _buffered(s, d):
    return _roads(s, d).withColumn("width", features.parsed_width(F.col("width_value"))).withColumn("radius", features.road_radius(F.col("width"), F.col("class"), F.col("subtype")))


@query(ROAD_SQL + "SELECT id, radius FROM buffered WHERE radius>0")
def road_buffer_case(s, d):
    return _buffered(s, d).filter(F.col("radius") > 0).select("id", "radius")


@query(ROAD_SQL + "SELECT id, width FROM parsed")
def parse_width_rules(s, d):
    return _buffered(s, d).select("id", "width")


@query("SELECT id, CASE WHEN class='PROMO' OR class LIKE 'PROMO%' THEN 1 ELSE 0 END::INT AS flag FROM bld")
def industrial_flag(s, d):
    return _bld(s, d).select("id", F.when(F.col("class").startswith("PROMO"), 1).otherwise(0).alias("flag"))


@query("SELECT id FROM bld WHERE x0 BETWEEN 1000 AND 5000 AND y0 BETWEEN 2000 AND 8000")
def bounds_filter(s, d):
    return _bld(s, d).filter(F.col("x0").between(1000, 5000) & F.col("y0").between(2000, 8000)).select("id")


@query("SELECT count(height)::BIGINT AS heights, count(num_floors)::BIGINT AS floors, count(class)::BIGINT AS classes, count(*)::BIGINT AS n FROM bld")
def agg_count_nonnull(s, d):
    return _bld(s, d).agg(F.count("height").alias("heights"), F.count("num_floors").alias("floors"), F.count("class").alias("classes"), F.count(F.lit(1)).alias("n"))


@query("SELECT min(x0) AS x0, min(y0) AS y0, max(x0+w) AS x1, max(y0+h) AS y1 FROM bld")
def layer_extent(s, d):
    return raster.extent(_ring(_bld(s, d)))


@query("""SELECT floor(x0/7)*7-7 AS west, ceil(y1/7)*7+7 AS north, floor(1+(ceil(x1/7)*7-floor(x0/7)*7+7)/7)::INT AS ncol, floor(1+(ceil(y1/7)*7+7-floor(y0/7)*7)/7)::INT AS nrow
 FROM (SELECT min(x0) AS x0, min(y0) AS y0, max(x0+w) AS x1, max(y0+h) AS y1 FROM bld)""")
def grid_snap(s, d):
    g = raster.grid_of(raster.extent(_ring(_bld(s, d))), 7)
    return g.select(F.col("west").cast("double"), F.col("north").cast("double"), "ncol", "nrow")


@query("SELECT id, w*h AS area, 2*(w+h) AS perimeter, round(4*3.14159*w*h/(4*(w+h)*(w+h)), 6) AS isoquotient, round(x0+w/2, 4) AS cx, round(y0+h/2, 4) AS cy FROM bld")
def polygon_metrics(s, d):
    r = F.col("ring")
    return _ring(_bld(s, d)).withColumn("c", G.centroid(r)).select("id", F.round(G.area(r), 6).alias("area"), F.round(G.perimeter(r), 6).alias("perimeter"), F.round(G.isoquotient(r), 6).alias("isoquotient"), F.round("c.x", 4).alias("cx"), F.round("c.y", 4).alias("cy"))


BOX = """, turned AS (SELECT id, a, w*abs(cos(radians(a)))+h*abs(sin(radians(a))) AS len, w*abs(sin(radians(a)))+h*abs(cos(radians(a))) AS wid, w*h AS area FROM bld, (SELECT i*5 AS a FROM range(36) t(i))),
 box AS (SELECT id, a, len, wid, area, row_number() OVER (PARTITION BY id ORDER BY round(len*wid, 6), a) AS n FROM turned) """


@query(BOX + "SELECT id, a::INT AS angle, round(area/(len*wid), 6) AS obox_ratio, round(least(len/wid, wid/len), 6) AS obox_hw FROM box WHERE n=1")
def min_rotated_box(s, d):
    b = _ring(_bld(s, d)).withColumn("b", G.smallest_box(F.col("ring")))
    return b.select("id", F.col("b.angle").cast("int").alias("angle"), F.round(G.area(F.col("ring")) / (F.col("b.length") * F.col("b.width")), 6).alias("obox_ratio"), F.round(F.least(F.col("b.length") / F.col("b.width"), F.col("b.width") / F.col("b.length")), 6).alias("obox_hw"))


@query("""SELECT vec_id, round(area, 6) AS area, corners::INT AS corners, round(box, 6) AS box_area FROM (
 WITH pts AS (SELECT vec_id, i::INT AS i, embedding[2*i+1]::DOUBLE AS x, embedding[2*i+2]::DOUBLE AS y FROM embeddings, range(16) t(i)),
 edge AS (SELECT a.vec_id, a.x*b.y-b.x*a.y AS twice FROM pts a JOIN pts b ON a.vec_id=b.vec_id AND a.i<>b.i JOIN pts c ON c.vec_id=a.vec_id AND c.i<>a.i AND c.i<>b.i
 GROUP BY a.vec_id, a.i, b.i, a.x, a.y, b.x, b.y HAVING min((b.x-a.x)*(c.y-a.y)-(b.y-a.y)*(c.x-a.x))>0),
 hull AS (SELECT vec_id, sum(twice)/2 AS area, count(*) AS corners FROM edge GROUP BY 1),
 spread AS (SELECT vec_id, d, (max(x*cos(radians(d))-y*sin(radians(d)))-min(x*cos(radians(d))-y*sin(radians(d))))*(max(x*sin(radians(d))+y*cos(radians(d)))-min(x*sin(radians(d))+y*cos(radians(d)))) AS size
 FROM pts, (SELECT (k*5)::DOUBLE AS d FROM range(36) t(k)) GROUP BY 1, 2), tight AS (SELECT vec_id, min(size) AS box FROM spread GROUP BY 1)
 SELECT h.vec_id, h.area, h.corners, t.box FROM hull h JOIN tight t ON t.vec_id=h.vec_id)""")
def obox_features(s, d):
    from terracell.functions.hull import convex_hull

    v = X.table(s, d, "embeddings").select("vec_id", F.transform(F.sequence(F.lit(0), F.lit(15)), lambda i: F.struct(F.element_at("embedding", 2 * i + 1).cast("double").alias("x"), F.element_at("embedding", 2 * i + 2).cast("double").alias("y"))).alias("points"))
    hulls = convex_hull(v, "points", "ring")
    return hulls.select("vec_id", F.round(G.area(F.col("ring")), 6).alias("area"), F.size("ring").alias("corners"), F.round(G.smallest_box(F.col("ring"))["key"], 6).alias("box_area"))


@query(PREPARED + BOX + """SELECT p.id, p.w*p.h AS area, round(4*3.14159*p.w*p.h/(4*(p.w+p.h)*(p.w+p.h)), 6) AS isoquotient, round(b.area/(b.len*b.wid), 6) AS obox_ratio,
 round(least(b.len/b.wid, b.wid/b.len), 6) AS obox_hw, p.calc_height, p.min_dem, p.width_med, p.majority_100m FROM prepared p JOIN box b ON p.id=b.id AND b.n=1""")
def building_features(s, d):
    f = features.building_features(_ring(_prepared(s, d)))
    return f.select("id", F.round("area", 6).alias("area"), *[F.round(c, 6).alias(c) for c in ("isoquotient", "obox_ratio", "obox_hw")], "calc_height", "min_dem", "width_med", "majority_100m")


@query(f"""SELECT id, round(500000+{0.9996 * G._RADIUS:.17e}*(eta+{"+".join(f"{a:.17e}*cos({2 * j}*xi)*sinh({2 * j}*eta)" for j, a in enumerate(G._ALPHA, 1))}), 3) AS x,
 round({0.9996 * G._RADIUS:.17e}*(xi+{"+".join(f"{a:.17e}*sin({2 * j}*xi)*cosh({2 * j}*eta)" for j, a in enumerate(G._ALPHA, 1))}), 3) AS y FROM (
 SELECT id, atan2(t, cos(lam)) AS xi, atanh(sin(lam)/sqrt(1+t*t)) AS eta FROM (SELECT id, lam, sinh(atanh(sin(phi))-{2 * G._N**0.5 / (1 + G._N):.17e}*atanh({2 * G._N**0.5 / (1 + G._N):.17e}*sin(phi))) AS t FROM (
 SELECT id, radians(84+seq%60/10.0-87) AS lam, radians(seq%700/10.0) AS phi FROM bld)))""")
def utm_forward(s, d):
    p = _bld(s, d).select("id", G.utm(F.lit(84.0) + F.col("seq") % 60 / F.lit(10.0), F.col("seq") % 700 / F.lit(10.0), 45).alias("p"))
    return p.select("id", F.round("p.x", 3).alias("x"), F.round("p.y", 3).alias("y"))


@query("""SELECT id, round(greatest(0, least(x0+w, 6000)-greatest(x0, 2000))*greatest(0, least(y0+h, 7000)-greatest(y0, 1000)), 6) AS area FROM bld
 WHERE x0<6000 AND x0+w>2000 AND y0<7000 AND y0+h>1000""")
def clip_polygon(s, d):
    c = _ring(_bld(s, d)).select("id", G.clip_ring(F.col("ring"), (2000, 1000, 6000, 7000)).alias("ring"))
    return c.select("id", F.round(G.area(F.col("ring")), 6).alias("area")).filter("area > 0")


_E = (2 * G._F - G._F**2) ** 0.5


@query(f"""SELECT id, round(rho*sin(lam), 3) AS x, round(-rho*cos(lam), 3) AS y FROM (SELECT id, radians(lon+45) AS lam, {G._A!r}*m/t0*tan(pi()/4-phi/2)/power((1-{_E!r}*sin(phi))/(1+{_E!r}*sin(phi)), {_E!r}/2) AS rho FROM (
 SELECT id, seq%360-180 AS lon, radians(60+seq%300/10.0) AS phi, cos(ts)/sqrt(1-{_E!r}*{_E!r}*sin(ts)*sin(ts)) AS m, tan(pi()/4-ts/2)/power((1-{_E!r}*sin(ts))/(1+{_E!r}*sin(ts)), {_E!r}/2) AS t0
 FROM bld, (SELECT radians(70.0) AS ts)))""")
def polar_stereographic(s, d):
    p = _bld(s, d).select("id", G.polar_stereographic((F.col("seq") % 360 - 180).cast("double"), F.lit(60.0) + F.col("seq") % 300 / F.lit(10.0)).alias("p"))
    return p.select("id", F.round("p.x", 3).alias("x"), F.round("p.y", 3).alias("y"))


@query("""SELECT id, place::INT AS place, x1, y1, x2, y2 FROM (SELECT id, 0 AS place, x1, y1, (x1+x2)/2 AS x2, (y1+y2)/2 AS y2 FROM roads UNION ALL SELECT id, 1, (x1+x2)/2, (y1+y2)/2, x2, y2 FROM roads) WHERE x1<>x2 OR y1<>y2""")
def line_segments(s, d):
    from terracell.sources.vector import segments

    def point(x, y):
        return F.struct(x.alias("x"), y.alias("y"))

    x1, y1, x2, y2 = (F.col(k) for k in ("x1", "y1", "x2", "y2"))
    lines = _roads(s, d).select("id", F.array(F.array(point(x1, y1), point((x1 + x2) / 2, (y1 + y2) / 2), point(x2, y2))).alias("rings"))
    return segments(lines).drop("line")


def _lines(s, d):
    ends = [F.struct(F.col(f"x{k}").alias("x"), F.col(f"y{k}").alias("y")) for k in (1, 2)]
    return _roads(s, d).withColumn("line", F.array(*ends))


@query("SELECT id, x1 AS first_x, y1 AS first_y, x2 AS last_x, y2 AS last_y FROM roads")
def line_endpoints(s, d):
    a, b = F.element_at("line", 1), F.element_at("line", -1)
    return _lines(s, d).select("id", a["x"].alias("first_x"), a["y"].alias("first_y"), b["x"].alias("last_x"), b["y"].alias("last_y"))


@query("SELECT class, x1, y1, x2, y2 FROM roads")
def explode_multiline(s, d):
    many = _lines(s, d).groupBy("class").agg(F.collect_list("line").alias("lines"))
    one = many.select("class", F.explode("lines").alias("l"))
    return one.select("class", F.col("l")[0]["x"].alias("x1"), F.col("l")[0]["y"].alias("y1"), F.col("l")[1]["x"].alias("x2"), F.col("l")[1]["y"].alias("y2"))


@query("SELECT x1 AS x, y1 AS y FROM roads UNION SELECT x2, y2 FROM roads")
def distinct_points(s, d):
    return _lines(s, d).select(F.explode("line").alias("p")).select("p.x", "p.y").distinct()


@query("""SELECT id, round(x1+t0*dx, 4) AS x1, round(y1+t0*dy, 4) AS y1, round(x1+t1*dx, 4) AS x2, round(y1+t1*dy, 4) AS y2 FROM (
 SELECT *, greatest(0, CASE WHEN dx=0 THEN 0 ELSE least((100-x1)/dx, (500-x1)/dx) END, CASE WHEN dy=0 THEN 0 ELSE least((50-y1)/dy, (450-y1)/dy) END) AS t0,
 least(1, CASE WHEN dx=0 THEN 1 ELSE greatest((100-x1)/dx, (500-x1)/dx) END, CASE WHEN dy=0 THEN 1 ELSE greatest((50-y1)/dy, (450-y1)/dy) END) AS t1
 FROM (SELECT *, x2-x1 AS dx, y2-y1 AS dy FROM roads)) WHERE t0<=t1 AND (dx<>0 OR x1 BETWEEN 100 AND 500) AND (dy<>0 OR y1 BETWEEN 50 AND 450)""")
def clip_bbox(s, d):
    c = _roads(s, d).select("id", G.clip_segment(*[F.col(k) for k in ("x1", "y1", "x2", "y2")], (100, 50, 500, 450)).alias("c")).filter(F.col("c").isNotNull())
    return c.select("id", *[F.round(F.col("c")[k], 4).alias(k) for k in ("x1", "y1", "x2", "y2")])


@query("""SELECT id1, id2, round(ax+t*(bx-ax), 4) AS x, round(ay+t*(bby-ay), 4) AS y FROM (SELECT *, ((cx-ax)*(dy-cy)-(cy-ay)*(dx-cx))/den AS t, ((cx-ax)*(bby-ay)-(cy-ay)*(bx-ax))/den AS u FROM (
 SELECT a.id AS id1, b.id AS id2, a.x1 AS ax, a.y1 AS ay, a.x2 AS bx, a.y2 AS bby, b.x1 AS cx, b.y1 AS cy, b.x2 AS dx, b.y2 AS dy, (a.x2-a.x1)*(b.y2-b.y1)-(a.y2-a.y1)*(b.x2-b.x1) AS den
 FROM roads a JOIN roads b ON a.id<b.id) WHERE den<>0) WHERE t>0 AND t<1 AND u>0 AND u<1""")
def segment_self_intersection(s, d):
    return features.segment_crossings(_roads(s, d).select("id", "x1", "y1", "x2", "y2"), 160.0, digits=4)


def _points(s, d):
    return _prepared(s, d).select("id", (F.col("x0") + F.col("w") / 2).alias("x"), (F.col("y0") + F.col("h") / 2).alias("y"), F.col("min_dem").alias("v"))


POINTS = PREPARED + """, pts AS (SELECT id, x0+w/2 AS x, y0+h/2 AS y, min_dem AS v FROM prepared), good AS (SELECT * FROM pts WHERE v>=0), bad AS (SELECT * FROM pts WHERE v IS NULL OR v<0),
 near AS (SELECT b.id, g.id AS gid, g.v, (b.x-g.x)*(b.x-g.x)+(b.y-g.y)*(b.y-g.y) AS d2 FROM bad b JOIN good g ON (b.x-g.x)*(b.x-g.x)+(b.y-g.y)*(b.y-g.y)<=40000),
 agg AS (SELECT id, count(*) AS n, avg(v) AS mean, arg_min(v, (d2, gid)) AS nearest FROM near GROUP BY id) """


def _near(s, d):
    p = _points(s, d)
    return features.radius_pairs(p.filter(features.is_problem(F.col("v"))).drop("v"), p.filter(~features.is_problem(F.col("v"))), 200.0)


@query(POINTS + "SELECT id, n::BIGINT AS n, round(mean, 6) AS mean FROM agg")
def radius_join_mean(s, d):
    return _near(s, d).groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("r_v"), 6).alias("mean"))


@query(POINTS + "SELECT id, nearest FROM agg")
def knn_fallback(s, d):
    return _near(s, d).groupBy("id").agg(F.min_by("r_v", F.struct("d2", "r_id")).alias("nearest"))


@query(POINTS + """SELECT id, v AS value, 0::INT AS tier FROM good UNION ALL SELECT b.id, round(CASE WHEN n>=2 THEN mean WHEN n=1 THEN nearest ELSE (SELECT avg(v) FROM good) END, 6),
 CASE WHEN n>=2 THEN 1 WHEN n=1 THEN 2 ELSE 3 END::INT FROM bad b LEFT JOIN agg a ON a.id=b.id""")
def tiered_imputation(s, d):
    return features.tiered_heights(_points(s, d), 200.0).select("id", F.round("value", 6).alias("value"), "tier")


# Rasters of buildings: 500 x 500 cells of 20 m, north-up from (0, 10000).
COVER = """, cov AS (SELECT b.*, r.i::INT AS row, c.i::INT AS col FROM bld b, range(500) r(i), range(500) c(i)
 WHERE r.i BETWEEN floor((10000-y0-h)/20) AND floor((10000-y0)/20) AND c.i BETWEEN floor(x0/20) AND floor((x0+w)/20)
 AND (c.i+.5)*20>=x0 AND (c.i+.5)*20<x0+w AND 10000-(r.i+.5)*20>=y0 AND 10000-(r.i+.5)*20<y0+h) """


def _covered(s, d):
    return raster.covered(_ring(_bld(s, d)), 0.0, 10000.0, 20.0, 500, 500)


@query(COVER + "SELECT DISTINCT row, col, 1::INT AS v FROM cov")
def rasterize_mask(s, d):
    return _covered(s, d).select("row", "col").distinct().withColumn("v", F.lit(1))


@query(COVER + "SELECT row, col, arg_max(height, seq) AS v FROM cov WHERE height IS NOT NULL GROUP BY 1, 2")
def rasterize_last_wins(s, d):
    return raster.burned(_covered(s, d).filter(F.col("height").isNotNull()), F.col("height"), F.col("seq"))


@query(COVER + "SELECT row, col, arg_max(CASE WHEN class LIKE 'PROMO%' THEN 1 ELSE 0 END::INT, seq) AS v FROM cov GROUP BY 1, 2")
def industrial_mask(s, d):
    flag = F.when(F.col("class").startswith("PROMO"), 1).otherwise(0)
    return raster.burned(_covered(s, d), flag, F.col("seq"))


# Roads on 3 x 3 sub-cells of a 64 x 64 grid of 10 m, by the distance of sub-cell centres.
@query(ROAD_SQL + """, sub AS (SELECT r.i AS sr, c.i AS sc, (c.i+.5)*10/3 AS x, 640-(r.i+.5)*10/3 AS y FROM range(192) r(i), range(192) c(i)),
 hit AS (SELECT DISTINCT sr, sc FROM (SELECT sr, sc, radius, x-(x1+t*dx) AS ex, y-(y1+t*dy) AS ey FROM (SELECT *, CASE WHEN dx*dx+dy*dy=0 THEN 0 ELSE greatest(0, least(1, ((x-x1)*dx+(y-y1)*dy)/(dx*dx+dy*dy))) END AS t
 FROM (SELECT sub.*, b.x1, b.y1, b.x2-b.x1 AS dx, b.y2-b.y1 AS dy, b.radius FROM sub, buffered b WHERE b.radius>0))) WHERE ex*ex+ey*ey<=radius*radius)
 SELECT (sr//3)::INT AS row, (sc//3)::INT AS col, least(100, floor(count(*)*100/9))::INT AS percent FROM hit GROUP BY 1, 2""")
def road_coverage(s, d):
    res = 10 / 3
    lines = _buffered(s, d).filter(F.col("radius") > 0)

    def index(v):
        return F.greatest(F.lit(0), F.least(F.lit(191), F.floor(v / res).cast("int")))

    y1, y2 = 640 - F.col("y1"), 640 - F.col("y2")
    rows = F.sequence(index(F.least(y1, y2) - F.col("radius")), index(F.greatest(y1, y2) + F.col("radius")))
    # Of each sub-row only the columns that the road's own slab can reach.
    at = lines.withColumn("row", F.explode(rows))
    cols = F.sequence(index(F.least("x1", "x2") - F.col("radius")), index(F.greatest("x1", "x2") + F.col("radius")))
    at = at.withColumn("col", F.explode(cols))
    x, y = (F.col("col") + 0.5) * res, 640 - (F.col("row") + 0.5) * res
    d2 = G.segment_distance2(x, y, F.col("x1"), F.col("y1"), F.col("x2"), F.col("y2"))
    hit = at.filter(d2 <= F.col("radius") * F.col("radius")).select("row", "col").distinct().withColumn("v", F.lit(1))
    return raster.block_percent(hit, 3)


# The same sub-cells by what a buffer touches: a road's capsule and a sub-cell's rectangle meet if they cross or are near enough.
@query(ROAD_SQL + """, sub AS (SELECT r.i AS sr, c.i AS sc, c.i*10/3.0 AS west, (c.i+1)*10/3.0 AS east, 640-(r.i+1)*10/3.0 AS south, 640-r.i*10/3.0 AS north FROM range(192) r(i), range(192) c(i)),
 pair AS (SELECT sub.*, b.x1, b.y1, b.x2, b.y2, b.radius FROM sub JOIN buffered b ON b.radius>0 AND least(b.x1, b.x2)-b.radius<=east+1 AND greatest(b.x1, b.x2)+b.radius>=west-1 AND least(b.y1, b.y2)-b.radius<=north+1 AND greatest(b.y1, b.y2)+b.radius>=south-1),
 ends AS (SELECT *, greatest(0, west-x1, x1-east)**2+greatest(0, south-y1, y1-north)**2 AS e1, greatest(0, west-x2, x2-east)**2+greatest(0, south-y2, y2-north)**2 AS e2,
 [(x2-x1)*(south-y1)-(y2-y1)*(west-x1), (x2-x1)*(north-y1)-(y2-y1)*(west-x1), (x2-x1)*(south-y1)-(y2-y1)*(east-x1), (x2-x1)*(north-y1)-(y2-y1)*(east-x1)] AS sides FROM pair),
 corner AS (SELECT *, unnest([{'x': west, 'y': south}, {'x': west, 'y': north}, {'x': east, 'y': south}, {'x': east, 'y': north}]) AS p FROM ends),
 near AS (SELECT *, CASE WHEN x1=x2 AND y1=y2 THEN 0 ELSE greatest(0, least(1, ((p.x-x1)*(x2-x1)+(p.y-y1)*(y2-y1))/((x2-x1)**2+(y2-y1)**2))) END AS t FROM corner),
 hit AS (SELECT DISTINCT sr, sc FROM near WHERE least(e1, e2, (p.x-x1-t*(x2-x1))**2+(p.y-y1-t*(y2-y1))**2)<=radius*radius
 OR (least(x1, x2)<=east AND greatest(x1, x2)>=west AND least(y1, y2)<=north AND greatest(y1, y2)>=south AND list_min(sides)<=0 AND list_max(sides)>=0))
 SELECT (sr//3)::INT AS row, (sc//3)::INT AS col, least(100, floor(count(*)*100/9))::INT AS percent FROM hit GROUP BY 1, 2""")
def road_coverage_touched(s, d):
    lines = _buffered(s, d).filter(F.col("radius") > 0)
    hit = raster.touched(lines, 0.0, 640.0, 10 / 3, 192, 192).withColumn("v", F.lit(1))
    return raster.block_percent(hit, 3)


@query("SELECT (row//3)::INT AS row, (col//3)::INT AS col, least(100, floor(sum(bmask)*100/9))::INT AS percent FROM cells GROUP BY 1, 2")
def block_percent(s, d):
    return raster.block_percent(_cells(s, d), 3, "bmask")


# Zones: rectangles 20 times as large on cells of 160 m, rows counted from y = 0 upward.
ZONES = """, zone AS (SELECT b.id, b.x0, b.y0, b.w, b.h, c.* FROM bld b JOIN cells c ON (c.col+.5)*160>=b.x0 AND (c.col+.5)*160<b.x0+b.w*20 AND (c.row+.5)*160>=b.y0 AND (c.row+.5)*160<b.y0+b.h*20) """


def _up(df: DataFrame) -> DataFrame:
    return df.withColumn("row", F.lit(63) - F.col("row"))


def _zones(s, d, grow=20.0, reach=0.0):
    at = _up(raster.covered(_ring(_bld(s, d), grow), 0.0, 10240.0, 160.0, 64, 64, reach=reach))
    return raster.on_cells(at, _cells(s, d), 64 * 64)


@query(""", z AS (SELECT b.id, avg(nullif(c.v, 0)) AS m FROM bld b JOIN cells c ON (c.col+.5)*160>=b.x0 AND (c.col+.5)*160<b.x0+b.w AND (c.row+.5)*160>=b.y0 AND (c.row+.5)*160<b.y0+b.h GROUP BY 1)
 SELECT b.id, round(coalesce(z.m, nullif(c.v, 0)), 6) AS width_med FROM bld b LEFT JOIN z ON z.id=b.id LEFT JOIN cells c ON c.row=trunc((b.y0+b.h/2)/160)::INT AND c.col=trunc((b.x0+b.w/2)/160)::INT""")
def zonal_mean_with_fallback(s, d):
    means = _zones(s, d, 1.0).groupBy("id").agg(F.avg(F.nullif("v", F.lit(0.0))).alias("m"))
    at = _bld(s, d).select("id", ((F.col("y0") + F.col("h") / 2) / 160).cast("int").alias("row"), ((F.col("x0") + F.col("w") / 2) / 160).cast("int").alias("col"))
    found = at.join(_cells(s, d), ["row", "col"], "left").join(means, "id", "left")
    return found.select("id", F.round(F.coalesce("m", F.nullif("v", F.lit(0.0))), 6).alias("width_med"))


@query(ZONES + "SELECT id, max(v) AS max_value FROM zone GROUP BY id")
def zonal_max(s, d):
    return _zones(s, d).groupBy("id").agg(F.max("v").alias("max_value"))


@query(ZONES + "SELECT id, min(v) AS min, max(v) AS max, sum(v) AS sum, round(avg(v), 6) AS mean, round(stddev_pop(v), 4) AS std FROM zone GROUP BY id")
def zonal_multi_stats(s, d):
    return _zones(s, d).groupBy("id").agg(F.min("v").alias("min"), F.max("v").alias("max"), F.sum("v").alias("sum"), F.round(F.avg("v"), 6).alias("mean"), F.round(F.stddev_pop("v"), 4).alias("std"))


@query(""", z AS (SELECT b.id, c.lcz, count(*) AS n FROM bld b JOIN cells c ON greatest(b.x0-(c.col+.5)*160, 0, (c.col+.5)*160-b.x0-b.w)**2+greatest(b.y0-(c.row+.5)*160, 0, (c.row+.5)*160-b.y0-b.h)**2<=300.0*300.0 WHERE c.lcz<=10 GROUP BY 1, 2),
 k AS (SELECT id, lcz, row_number() OVER (PARTITION BY id ORDER BY n DESC, lcz) AS r FROM z) SELECT b.id, CAST(k.lcz AS VARCHAR) AS majority_300m FROM bld b LEFT JOIN k ON k.id=b.id AND k.r=1""")
def zonal_majority(s, d):
    counts = _zones(s, d, 1.0, 300.0).filter(F.col("lcz") <= 10).groupBy("id", "lcz").agg(F.count(F.lit(1)).alias("n"))
    best = counts.groupBy("id").agg(F.min(F.struct((-F.col("n")).alias("n"), "lcz"))["lcz"].cast("string").alias("majority_300m"))
    return _bld(s, d).select("id").join(best, "id", "left")


@query("SELECT b.id, c.v FROM bld b LEFT JOIN cells c ON c.row=trunc((10240-(b.y0+b.h/2))/160)::INT AND c.col=trunc((b.x0+b.w/2)/160)::INT")
def point_sample(s, d):
    return raster.sampled(_points(s, d).drop("v"), _cells(s, d), 0.0, 10240.0, 160.0).select("id", "v")


@query("SELECT row, col, v FROM cells WHERE bmask=0")
def mask_anti(s, d):
    c = _cells(s, d)
    return raster.masked(c, c.filter("bmask = 1")).select("row", "col", "v")


@query("SELECT row, col, v FROM cells WHERE bmask=1")
def mask_semi(s, d):
    c = _cells(s, d)
    return raster.masked(c, c.filter("bmask = 1"), invert=False).select("row", "col", "v")


@query("SELECT row, col, CASE WHEN lcz BETWEEN 11 AND 17 THEN NULL ELSE lcz END AS v FROM cells")
def lcz_remove_classes(s, d):
    return _cells(s, d).select("row", "col", F.when(~F.col("lcz").isin(list(range(11, 18))), F.col("lcz")).alias("v"))


def _idw_sql(source: str, k: int) -> str:
    return f""", src AS ({source}), pair AS (SELECT a.row, a.col, b.v AS near, (a.row-b.row)*(a.row-b.row)+(a.col-b.col)*(a.col-b.col) AS d2 FROM src a JOIN src b
 ON b.row BETWEEN a.row-{k} AND a.row+{k} AND b.col BETWEEN a.col-{k} AND a.col+{k} WHERE a.v IS NULL AND b.v IS NOT NULL),
 idw AS (SELECT row, col, sum(near/d2)/sum(1.0/d2) AS v FROM pair WHERE d2<={k * k} GROUP BY 1, 2),
 filled AS (SELECT s.row, s.col, coalesce(s.v, i.v) AS v FROM src s LEFT JOIN idw i ON s.row=i.row AND s.col=i.col) """


@query(_idw_sql("SELECT row, col, v FROM cells", 3) + "SELECT row, col, round(v, 6) AS v FROM filled")
def gap_fill_idw(s, d):
    return raster.gap_filled(_cells(s, d), 3).select("row", "col", F.round("v", 6).alias("v"))


@query(_idw_sql("SELECT row, col, CASE WHEN lcz<=10 THEN lcz::DOUBLE END AS v FROM cells WHERE row BETWEEN 5 AND 50 AND col BETWEEN 8 AND 60", 4) + "SELECT row, col, round(v, 4) AS v FROM filled")
def lcz_clean(s, d):
    clipped = _cells(s, d).filter(F.col("row").between(5, 50) & F.col("col").between(8, 60))
    kept = clipped.select("row", "col", F.when(F.col("lcz") <= 10, F.col("lcz").cast("double")).alias("v"))
    return raster.gap_filled(kept, 4).select("row", "col", F.round("v", 4).alias("v"))


@query("SELECT a.row, a.col, round(avg(b.v), 6) AS v FROM cells a JOIN cells b ON b.row BETWEEN a.row-4 AND a.row+4 AND b.col BETWEEN a.col-4 AND a.col+4 GROUP BY 1, 2")
def focal_mean(s, d):
    return raster.focal_mean(_cells(s, d), 4).select("row", "col", F.round("v", 6).alias("v"))


@query(_idw_sql("SELECT row, col, CASE WHEN bmask=0 THEN v END AS v FROM cells", 3) + """, smooth AS (SELECT a.row, a.col, avg(b.v) AS v FROM filled a JOIN filled b ON b.row BETWEEN a.row-2 AND a.row+2 AND b.col BETWEEN a.col-2 AND a.col+2 GROUP BY 1, 2)
 SELECT b.id, round(avg(nullif(c.v, 0)), 6) AS width_med FROM bld b JOIN smooth c ON (c.col+.5)*160>=b.x0 AND (c.col+.5)*160<b.x0+b.w*20 AND (c.row+.5)*160>=b.y0 AND (c.row+.5)*160<b.y0+b.h*20 GROUP BY 1""")
def width_pipeline(s, d):
    c = _cells(s, d)
    open_cells = c.join(c.filter("bmask = 1").select("row", "col", F.lit(1).alias("m")), ["row", "col"], "left").select("row", "col", F.when(F.col("m").isNull(), F.col("v")).alias("v"))
    smooth = raster.focal_mean(raster.gap_filled(open_cells, 3), 2)
    at = raster.on_cells(_up(raster.covered(_ring(_bld(s, d), 20.0), 0.0, 10240.0, 160.0, 64, 64)), smooth, 64 * 64)
    return at.groupBy("id").agg(F.round(F.avg(F.nullif("v", F.lit(0.0))), 6).alias("width_med"))


@query("SELECT coalesce(a.row, b.row) AS row, coalesce(a.col, b.col) AS col, coalesce(a.v, b.v) AS v FROM (SELECT * FROM cells WHERE col<40 AND v IS NOT NULL) a FULL JOIN (SELECT row, col, v+1000 AS v FROM cells WHERE col>=20 AND v IS NOT NULL) b ON a.row=b.row AND a.col=b.col")
def mosaic_first_valid(s, d):
    c = _cells(s, d)
    return raster.mosaic([c.filter("col < 40").select("row", "col", "v"), c.filter("col >= 20").select("row", "col", (F.col("v") + 1000).alias("v"))])


@query("SELECT a.row, a.col, a.v-b.v AS v FROM cells a JOIN cells b ON a.row=b.row+3 AND a.col=b.col-2 WHERE a.v IS NOT NULL AND b.v IS NOT NULL")
def raster_subtract(s, d):
    c = _cells(s, d)
    return raster.subtracted(c, c, 3, -2)


def _targets(s):
    return s.range(40 * 40).select(F.floor(F.col("id") / 40).cast("int").alias("row"), (F.col("id") % 40).cast("int").alias("col"))


TARGETS = ", tgt AS (SELECT r.i::INT AS row, c.i::INT AS col, (r.i+.5)*1.6 AS y, (c.i+.5)*1.6 AS x FROM range(40) r(i), range(40) c(i)) "


@query(TARGETS + "SELECT t.row, t.col, c.v FROM tgt t LEFT JOIN cells c ON c.row=floor(t.y) AND c.col=floor(t.x)")
def resample_nearest(s, d):
    return raster.resampled(_cells(s, d), _targets(s), 1.6)


@query(TARGETS + "SELECT t.row, t.col, round(sum(w*v)/sum(w), 6) AS v FROM (SELECT t.row, t.col, c.v, (1-abs(t.y-.5-c.row))*(1-abs(t.x-.5-c.col)) AS w FROM tgt t LEFT JOIN cells c ON c.v IS NOT NULL AND abs(t.y-.5-c.row)<1 AND abs(t.x-.5-c.col)<1) t GROUP BY 1, 2")
def resample_bilinear(s, d):
    return raster.resampled(_cells(s, d), _targets(s), 1.6, "bilinear").select("row", "col", F.round("v", 6).alias("v"))


@query(TARGETS + """, wgt AS (SELECT t.row, t.col, c.v, abs(t.y-.5-c.row) AS dy, abs(t.x-.5-c.col) AS dx FROM tgt t LEFT JOIN cells c ON c.v IS NOT NULL AND c.row BETWEEN floor(t.y-.5)-1 AND floor(t.y-.5)+2 AND c.col BETWEEN floor(t.x-.5)-1 AND floor(t.x-.5)+2),
 k AS (SELECT row, col, v, (CASE WHEN dy<1 THEN (1.5*dy-2.5)*dy*dy+1 ELSE ((-.5*dy+2.5)*dy-4)*dy+2 END)*(CASE WHEN dx<1 THEN (1.5*dx-2.5)*dx*dx+1 ELSE ((-.5*dx+2.5)*dx-4)*dx+2 END) AS w FROM wgt)
 SELECT row, col, round(CASE WHEN abs(sum(w))>1e-9 THEN greatest(min(v) FILTER (w<>0), least(max(v) FILTER (w<>0), sum(w*v)/sum(w))) END, 6) AS v FROM k GROUP BY 1, 2""")
def resample_cubic(s, d):
    return raster.resampled(_cells(s, d), _targets(s), 1.6, "cubic").select("row", "col", F.round("v", 6).alias("v"))


# Cells of a quarter degree, north-up from (85.5 E, 31 N), seen from a grid of 20 km in UTM zone 45, by the inverse series as published.
@query(f"""SELECT t.row, t.col, c.v FROM (SELECT row, col, degrees(atan2(sinh(v), cos(u)))+87 AS lon, degrees(chi+{"+".join(f"{x:.17e}*sin({2 * j}*chi)" for j, x in enumerate(G._DELTA, 1))}) AS lat FROM (SELECT *, asin(sin(u)/cosh(v)) AS chi FROM (
 SELECT row, col, xi-({"+".join(f"{x:.17e}*sin({2 * j}*xi)*cosh({2 * j}*eta)" for j, x in enumerate(G._BETA, 1))}) AS u, eta-({"+".join(f"{x:.17e}*cos({2 * j}*xi)*sinh({2 * j}*eta)" for j, x in enumerate(G._BETA, 1))}) AS v FROM (
 SELECT r.i::INT AS row, c.i::INT AS col, (3400000-(r.i+.5)*20000)/{0.9996 * G._RADIUS:.17e} AS xi, (400000+(c.i+.5)*20000-500000)/{0.9996 * G._RADIUS:.17e} AS eta FROM range(60) r(i), range(40) c(i))))) t
 LEFT JOIN cells c ON c.row=floor((31-lat)/0.25) AND c.col=floor((lon-85.5)/0.25)""")
def reproject_nearest(s, d):
    def inverse(x, y):
        p = G.utm_inverse(x, y, 45)
        return F.struct(p["lon"].alias("x"), p["lat"].alias("y"))

    return raster.reprojected(_cells(s, d), Grid(85.5, 31.0, 0.25, 64, 64, 4326), Grid(400000.0, 3400000.0, 20000.0, 60, 40), inverse)


@query("SELECT row, col, coalesce(v, -1) AS height, lcz::DOUBLE AS lcz, bmask::DOUBLE AS mask, CASE WHEN row%2=0 THEN row::DOUBLE ELSE -1 END AS even FROM cells")
def multiband_assemble(s, d):
    c = _cells(s, d)
    return raster.multiband(c, {"height": c, "lcz": c.select("row", "col", F.col("lcz").alias("v")), "mask": c.select("row", "col", F.col("bmask").alias("v")), "even": c.filter("row % 2 = 0").select("row", "col", F.col("row").alias("v"))})


FIELD = """, field AS (SELECT a.row, a.col, min((a.row-b.row)*(a.row-b.row)+(a.col-b.col)*(a.col-b.col))::BIGINT AS d2,
 arg_min(b.row*7%23+b.col%11, ((a.row-b.row)*(a.row-b.row)+(a.col-b.col)*(a.col-b.col), b.row, b.col))::DOUBLE AS alloc FROM dense a JOIN dense b ON b.src=1 GROUP BY 1, 2) """


def _field(s, d):
    dense = X.dense(s, d)
    near = distance.nearest_source(dense)
    return near.select("row", "col", "d2", (F.col("src_row") * 7 % 23 + F.col("src_col") % 11).cast("double").alias("alloc"))


@query(FIELD + "SELECT row, col, round(sqrt(d2)*5, 6) AS v FROM field")
def euclid_distance(s, d):
    return distance.distance(X.dense(s, d), 5.0).select("row", "col", F.round("v", 6).alias("v"))


@query(FIELD + "SELECT row, col, alloc AS v FROM field")
def euclid_allocation(s, d):
    dense = X.dense(s, d)
    return distance.allocation(dense, dense.filter("src = 1").select("row", "col", (F.col("row") * 7 % 23 + F.col("col") % 11).cast("double").alias("v")))


@query("""SELECT a.i::INT AS ti, b.i::INT AS tj, (a.i*20)::INT AS wr0, least(a.i*20+20, 64)::INT AS wr1, (b.i*30)::INT AS wc0, least(b.i*30+30, 64)::INT AS wc1,
 greatest(a.i*20-5, 0)::INT AS rr0, least(least(a.i*20+20, 64)+5, 64)::INT AS rr1, greatest(b.i*30-5, 0)::INT AS rc0, least(least(b.i*30+30, 64)+5, 64)::INT AS rc1 FROM range(4) a(i), range(3) b(i)""")
def tile_grid(s, d):
    return raster.tiles(s, 64, 64, (20, 30), 5)


@query("SELECT (row//16)::INT AS ti, (col//16)::INT AS tj, bool_or(v>50) AS busy FROM cells GROUP BY 1, 2")
def tile_any_nonzero(s, d):
    return _cells(s, d).groupBy(F.floor(F.col("row") / 16).cast("int").alias("ti"), F.floor(F.col("col") / 16).cast("int").alias("tj")).agg(F.bool_or(F.col("v") > 50).alias("busy"))


# Bare earth: the surface less 3 where the row is even, else less 4, in two tiles that overlap.
@query("""SELECT c.row, c.col, CASE WHEN c.col<40 THEN 3+c.row%2 ELSE 5 END::DOUBLE AS v FROM cells c WHERE c.v IS NOT NULL""")
def dem_fabdem(s, d):
    from terracell.plans.dem import elevation_raster

    c = _cells(s, d).select("row", "col", "v")
    tiles = [c.filter("col < 40").withColumn("v", F.col("v") - 3 - F.col("row") % 2), c.filter("col >= 20").withColumn("v", F.col("v") - 5)]
    return elevation_raster("fabdem", tiles, Grid(0.0, 640.0, 10.0, 64, 64), surface=c)


@query("SELECT count_if(ok)::BIGINT AS processed, count_if(NOT ok)::BIGINT AS skipped FROM (SELECT row//16 AS ti, col//16 AS tj, count(v)>205 AS ok FROM cells GROUP BY 1, 2)")
def tile_counters(s, d):
    tiles = _cells(s, d).groupBy(F.floor(F.col("row") / 16), F.floor(F.col("col") / 16)).agg((F.count("v") > 205).alias("ok"))
    return tiles.agg(F.count_if("ok").alias("processed"), F.count_if(~F.col("ok")).alias("skipped"))


@query(FIELD + """, q AS (SELECT row, col, least(d2, 36.0) AS r2 FROM field WHERE d2>0),
 ins AS (SELECT q.row AS qr, q.col AS qc, q.r2, p.row, p.col, p.alloc FROM q JOIN field p ON (p.row-q.row)*(p.row-q.row)+(p.col-q.col)*(p.col-q.col)<q.r2),
 m AS (SELECT qr, qc, avg(alloc) AS height FROM ins GROUP BY 1, 2), w AS (SELECT row, col, qr, qc, r2, row_number() OVER (PARTITION BY row, col ORDER BY r2 DESC, qr, qc) AS n FROM ins)
 SELECT w.row, w.col, round(2*sqrt(w.r2)*5, 6) AS width, round(m.height, 6) AS height FROM w JOIN m ON m.qr=w.qr AND m.qc=w.qc WHERE n=1""")
def canyon_width(s, d):
    return distance.canyon_width(_field(s, d), 5.0, 30.0).select("row", "col", F.round("width", 6).alias("width"), F.round("height", 6).alias("height"))


@query(""", hgt AS (SELECT row, col, CASE WHEN src=1 THEN (row%9+3)::DOUBLE END AS height FROM dense), ang AS (SELECT (i*10)::DOUBLE AS a FROM range(36) t(i)),
 step AS (SELECT a, k.i::INT AS k, round_even(round(-k.i*cos(radians(a)), 9), 0)::INT AS dr, round_even(round(k.i*sin(radians(a)), 9), 0)::INT AS dc FROM ang, range(1, 13) k(i)),
 seen AS (SELECT h.row, h.col, s.a, min(CASE WHEN b.height IS NOT NULL THEN least(s.k*5.0, 60.0) END) AS hit, max(b.height/(s.k*5.0)) AS slope
 FROM hgt h CROSS JOIN step s LEFT JOIN hgt b ON b.row=h.row+s.dr AND b.col=h.col+s.dc WHERE h.height IS NULL GROUP BY 1, 2, 3),
 ray AS (SELECT row, col, a, coalesce(hit, 60.0) AS len, coalesce(slope*slope/(1+slope*slope), 0) AS sin2 FROM seen),
 sky AS (SELECT row, col, 1-avg(sin2) AS svf FROM ray GROUP BY 1, 2),
 both_ways AS (SELECT x.row, x.col, x.a, x.len+y.len AS length, row_number() OVER (PARTITION BY x.row, x.col ORDER BY x.len+y.len DESC, x.a) AS n FROM ray x JOIN ray y ON x.row=y.row AND x.col=y.col AND y.a=x.a+180)
 SELECT b.row, b.col, b.length, b.a AS direction, round(s.svf, 9) AS svf FROM both_ways b JOIN sky s ON s.row=b.row AND s.col=b.col WHERE n=1""")
def canyon_rays(s, d):
    cells = X.dense(s, d).select("row", "col", F.when(F.col("src") == 1, (F.col("row") % 9 + 3).cast("double")).alias("height"))
    return distance.rays(cells, 5.0, 10.0, 60.0, tile=32).withColumn("svf", F.round("svf", 9))


@query(""", t AS (SELECT i, i//8*8 AS r, i%8*8 AS c FROM range(64) t(i)), g AS (SELECT a.i::INT AS row, b.i::INT AS col FROM range(64) a(i), range(64) b(i))
 SELECT row, col, round(CASE WHEN (row-r)+(col-c)<=8 THEN z00+(row-r)/8.0*(z10-z00)+(col-c)/8.0*(z01-z00) ELSE z11+(8-(row-r))/8.0*(z01-z11)+(8-(col-c))/8.0*(z10-z11) END, 6) AS v FROM (
 SELECT row, col, row//8*8 AS r, col//8*8 AS c, (row//8*8*7+col//8*8*3)%31 AS z00, ((row//8*8+8)*7+col//8*8*3)%31 AS z10, (row//8*8*7+(col//8*8+8)*3)%31 AS z01, ((row//8*8+8)*7+(col//8*8+8)*3)%31 AS z11 FROM g)""")
def tin_interpolate(s, d):
    square = s.range(64).select((F.floor(F.col("id") / 8) * 8).alias("r"), (F.col("id") % 8 * 8).alias("c"))

    def corner(k, r, c):
        return [c.cast("double").alias(f"x{k}"), (-r).cast("double").alias(f"y{k}"), ((r * 7 + c * 3) % 31).cast("double").alias(f"z{k}")]

    r, c = F.col("r"), F.col("c")
    low = square.select(*corner(1, r, c), *corner(2, r + 8, c), *corner(3, r, c + 8))
    high = square.select(*corner(1, r + 8, c + 8), *corner(2, r, c + 8), *corner(3, r + 8, c))
    return tin.interpolated(low.unionByName(high), 0.0, 0.0, 1.0, 64, 64).select("row", "col", F.round("v", 6).alias("v"))


@query()
def dem_pipeline(s, d):
    from terracell.plans.dem import road_terrain

    return road_terrain(_cells(s, d), _roads(s, d).select("id", "x1", "y1", "x2", "y2"), res=10.0, north=640.0, nrow=64, ncol=64)


@query("SELECT round(1-sse/sst, 6) AS r2, round(sqrt(sse/n), 4) AS rmse, round(ape*100, 6) AS mape FROM (SELECT count(*) AS n, sum((y-p)*(y-p)) AS sse, var_pop(y)*count(*) AS sst, avg(CASE WHEN y<>0 THEN abs((y-p)/y) END) AS ape FROM (SELECT o_totalprice AS y, o_totalprice*0.9+o_orderkey%100 AS p FROM orders))")
def regression_metrics(s, d):
    o = X.table(s, d, "orders").select(F.col("o_totalprice").alias("y"), (F.col("o_totalprice") * 0.9 + F.col("o_orderkey") % 100).alias("p"))
    m = features.regression_metrics(o, "y", "p")
    return m.select(F.round("r2", 6).alias("r2"), F.round("rmse", 4).alias("rmse"), F.round("mape", 6).alias("mape"))


def _land(s, d):
    return X.relation(s, d, X.LAND)


@query(""", hole AS (SELECT * FROM land WHERE v IS NULL), pair AS (SELECT a.row, a.col, b.v AS near, (a.row-b.row)*(a.row-b.row)+(a.col-b.col)*(a.col-b.col) AS d2 FROM hole a JOIN land b
 ON b.row BETWEEN a.row-6 AND a.row+6 AND b.col BETWEEN a.col-6 AND a.col+6 WHERE b.v IS NOT NULL)
 SELECT h.row, h.col, round(i.v, 5) AS v FROM hole h LEFT JOIN (SELECT row, col, sum(near/d2)/sum(1.0/d2) AS v FROM pair WHERE d2<=36 GROUP BY 1, 2) i ON h.row=i.row AND h.col=i.col
 UNION ALL SELECT row, col, v FROM land WHERE v IS NOT NULL""")
def land_gap_fill(s, d):
    return raster.gap_filled(_land(s, d).select("row", "col", "v"), 6).select("row", "col", F.round("v", 5).alias("v"))


LAND_FIELD = """, near AS (SELECT a.row, a.col, min((a.row-b.row)*(a.row-b.row)+(a.col-b.col)*(a.col-b.col))::BIGINT AS d2 FROM land a JOIN land b ON b.src=1 AND b.row BETWEEN a.row-15 AND a.row+15 AND b.col BETWEEN a.col-15 AND a.col+15 GROUP BY 1, 2) """


@query(LAND_FIELD + "SELECT row, col, round(sqrt(d2)*5, 6) AS v FROM near")
def land_distance(s, d):
    return distance.distance(_land(s, d).select("row", "col", "src"), 5.0).select("row", "col", F.round("v", 6).alias("v"))


@query(LAND_FIELD + """, q AS (SELECT row, col, least(d2, 25.0) AS r2 FROM near WHERE d2>0), ins AS (SELECT q.row AS qr, q.col AS qc, q.r2, p.row, p.col FROM q JOIN near p
 ON p.row BETWEEN q.row-5 AND q.row+5 AND p.col BETWEEN q.col-5 AND q.col+5 AND (p.row-q.row)*(p.row-q.row)+(p.col-q.col)*(p.col-q.col)<q.r2),
 m AS (SELECT qr, qc, avg(row%7+col%5) AS height FROM ins GROUP BY 1, 2), w AS (SELECT row, col, arg_min((qr, qc), (-r2, qr, qc)) AS c, max(r2) AS r2 FROM ins GROUP BY 1, 2)
 SELECT w.row, w.col, round(2*sqrt(w.r2)*5, 6) AS width, round(m.height, 6) AS height FROM w JOIN m ON m.qr=w.c[1] AND m.qc=w.c[2]""")
def land_canyons(s, d):
    near = distance.nearest_source(_land(s, d).select("row", "col", "src")).select("row", "col", "d2", (F.col("row") % 7 + F.col("col") % 5).cast("double").alias("alloc"))
    return distance.canyon_width(near, 5.0, 25.0).select("row", "col", F.round("width", 6).alias("width"), F.round("height", 6).alias("height"))


NUMERIC, CATEGORICAL = ["area", "isoquotient", "obox_ratio", "width_med", "obox_hw", "min_dem"], ["majority_100m", "class", "subtype"]


@query()
def ml_train_predict(s, d):
    from terracell.operators import ml

    rows = features.building_features(_ring(_prepared(s, d)))
    model = ml.train(rows, NUMERIC, CATEGORICAL, iterations=5, depth=3, bins=256)
    return ml.predict(rows, model, NUMERIC, CATEGORICAL).select("id", F.col("calc_height").cast("double"), "predicted")


@query()
def ml_tune(s, d):
    from terracell.operators import ml

    return ml.tune(features.building_features(_ring(_prepared(s, d))), NUMERIC, CATEGORICAL, draws=30, folds=3)


@query()
def ml_assess(s, d):
    from terracell.operators import ml

    rows = features.building_features(_ring(_prepared(s, d)))
    return ml.assessment(ml.assess(rows, NUMERIC, CATEGORICAL, iterations=5, depth=3, bins=256))


@query()
def ml_importance(s, d):
    from terracell.operators import ml

    model = ml.train(features.building_features(_ring(_prepared(s, d))), NUMERIC, CATEGORICAL, iterations=5, depth=3, bins=256)
    return ml.importances(model, NUMERIC, CATEGORICAL)


@query("SELECT name, importance::DOUBLE AS importance, row_number() OVER (ORDER BY importance DESC, name)::INT AS rank FROM (VALUES ('area', 0.31), ('min_dem', 0.22), ('obox_hw', 0.22), ('class', 0.25)) t(name, importance)")
def sort_importance(s, d):
    table = s.createDataFrame([("area", 0.31), ("min_dem", 0.22), ("obox_hw", 0.22), ("class", 0.25)], "name string, importance double")
    from pyspark.sql import Window

    return table.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("importance"), "name")))


@query("""SELECT step, max(strftime(ts, '%H:%M:%S')) AS last_time, count(*)::BIGINT AS runs FROM (SELECT user_id%19+1 AS step, ts FROM events WHERE event_type<>'error') GROUP BY 1""")
def pipeline_status(s, d):
    e = X.table(s, d, "events").filter(F.col("event_type") != "error").select((F.col("user_id") % 19 + 1).alias("step"), F.date_format("ts", "HH:mm:ss").alias("at"))
    return e.groupBy("step").agg(F.max("at").alias("last_time"), F.count(F.lit(1)).alias("runs")).orderBy("step")
