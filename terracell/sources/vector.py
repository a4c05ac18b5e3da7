"""Vector layers: GeoJSON scans with explicit schemas, WKT, attribute tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Levels of nesting around a position, by geometry type.
_DEPTH = {"Point": 0, "MultiPoint": 1, "LineString": 1, "MultiLineString": 2, "Polygon": 2, "MultiPolygon": 3}


def read_geojson(spark: SparkSession, path: str, properties: T.StructType, lines: bool = False) -> DataFrame:
    """One row per feature: its properties, ``geometry_type`` and ``rings`` array<array<struct<x, y>>>.

    Lines and points are rings of their own. Coordinates are kept as text by
    the JSON scan and parsed by the geometry's own depth, so one file may mix
    types. Missing properties are null. A feature collection is one document,
    read by one task; with lines=True each line is a feature, so that large
    layers are split over tasks.
    """
    geometry = T.StructType([T.StructField("type", T.StringType()), T.StructField("coordinates", T.StringType())])
    feature = T.StructType([T.StructField("properties", properties), T.StructField("geometry", geometry)])
    if lines:
        rows = spark.read.schema(feature).json(path).select(F.struct("properties", "geometry").alias("f"))
    else:
        schema = T.StructType([T.StructField("features", T.ArrayType(feature))])
        rows = spark.read.option("multiLine", True).schema(schema).json(path).select(F.explode("features").alias("f"))
    text, kind = F.col("f.geometry.coordinates"), F.col("f.geometry.type")
    rings = F.lit(None).cast("array<array<array<double>>>")
    for name, depth in _DEPTH.items():
        parsed = F.from_json(text, "array<" * (depth + 1) + "double" + ">" * (depth + 1))
        parsed = {0: lambda p: F.array(F.array(p)), 1: lambda p: F.array(p), 2: lambda p: p, 3: F.flatten}[depth](parsed)
        rings = F.when(kind == name, parsed).otherwise(rings)
    points = F.transform(rings, lambda ring: F.transform(ring, lambda p: F.struct(p[0].alias("x"), p[1].alias("y"))))
    return rows.select("f.properties.*", kind.alias("geometry_type"), points.alias("rings"))


def segments(df: DataFrame, key: str = "id", rings: str = "rings", closed: bool = False) -> DataFrame:
    """df by each segment of its lines: adds line, place (both from 0), x1, y1, x2, y2; ``rings`` goes.

    Lines have any number of points; those with fewer than two have no
    segment, and neither has a step from a point to itself. With closed=True
    the last point leads back to the first.
    """
    line = F.posexplode(rings).alias("line", "points")
    each = df.select(*[c for c in df.columns if c != rings], line)
    ends = F.concat("points", F.slice("points", 1, 1)) if closed else F.col("points")
    steps = F.transform(F.slice(ends, 1, F.greatest(F.size(ends) - 1, F.lit(0))), lambda a, k: F.struct(a.alias("a"), F.get(ends, k + 1).alias("b")))
    found = each.select(*[c for c in each.columns if c != "points"], F.posexplode(steps).alias("place", "s"))
    found = found.withColumns({"x1": F.col("s.a.x"), "y1": F.col("s.a.y"), "x2": F.col("s.b.x"), "y2": F.col("s.b.y")}).drop("s")
    return found.filter((F.col("x1") != F.col("x2")) | (F.col("y1") != F.col("y2")))


def open_ring(ring: Column) -> Column:
    """A ring without its repeated last point."""
    closed = (F.size(ring) > 1) & (F.element_at(ring, 1) == F.element_at(ring, -1))
    return F.when(closed, F.slice(ring, 1, F.size(ring) - 1)).otherwise(ring)


def _wkt_ring(ring: Column) -> Column:
    closed = F.concat(ring, F.slice(ring, 1, 1))
    return F.concat(F.lit("("), F.array_join(F.transform(closed, lambda p: F.concat_ws(" ", p["x"].cast("string"), p["y"].cast("string"))), ", "), F.lit(")"))


def to_wkt(ring: Column) -> Column:
    """POLYGON text of an open ring."""
    return F.concat(F.lit("POLYGON ("), _wkt_ring(ring), F.lit(")"))


def to_wkt_multi(polygons: Column) -> Column:
    """MULTIPOLYGON text of array<array<ring>>: of each polygon its outer ring, then its holes."""
    texts = F.transform(polygons, lambda rings: F.concat(F.lit("("), F.array_join(F.transform(rings, _wkt_ring), ", "), F.lit(")")))
    return F.concat(F.lit("MULTIPOLYGON ("), F.array_join(texts, ", "), F.lit(")"))


def _points(body: Column) -> Column:
    points = F.transform(F.split(body, r"\s*,\s*"), lambda p: F.split(F.trim(p), r"\s+"))
    return F.transform(points, lambda p: F.struct(F.try_element_at(p, F.lit(1)).try_cast("double").alias("x"), F.try_element_at(p, F.lit(2)).try_cast("double").alias("y")))


def from_wkt(text: Column) -> Column:
    """The outer, open ring of POLYGON text; null for other text."""
    body = F.regexp_extract(text, r"^\s*POLYGON\s*\(\(([^()]*)\)", 1)
    return F.when(body != "", open_ring(_points(body)))


def wkt_polygons(text: Column) -> Column:
    """array<array<open ring>> of POLYGON or MULTIPOLYGON text (any case, Z values dropped): of each polygon its outer ring, then its holes; null for other text."""
    kind = F.upper(F.regexp_extract(text, r"^\s*(\w+)", 1))
    polygons = F.regexp_extract_all(text, F.lit(r"(\((?:\s*\([^()]*\)\s*,?)+\s*\))"), 1)
    rings = F.transform(polygons, lambda p: F.transform(F.regexp_extract_all(p, F.lit(r"\(([^()]*)\)"), 1), lambda r: open_ring(_points(r))))
    return F.when(kind.isin("POLYGON", "MULTIPOLYGON") & (F.size(polygons) > 0), rings)


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A CSV attribute table with a header; types are given, never guessed."""
    return spark.read.schema(schema).option("header", True).csv(path)


def write_table(df: DataFrame, path: str) -> None:
    """CSV in UTF-8 without geometry columns."""
    flat = [f.name for f in df.schema if not isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType))]
    df.select(*flat).write.mode("overwrite").option("header", True).option("encoding", "UTF-8").csv(path)
