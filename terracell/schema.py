"""Schemas of the named tables, and the grid that cell tables lie on."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

POINT = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])
RING = T.ArrayType(POINT)
BUILDINGS = T.StructType([T.StructField("id", T.StringType()), T.StructField("height", T.DoubleType()), T.StructField("num_floors", T.DoubleType()), T.StructField("class", T.StringType()), T.StructField("subtype", T.StringType()), T.StructField("rings", T.ArrayType(RING))])
ROADS = T.StructType([T.StructField("width_value", T.StringType()), T.StructField("subtype", T.StringType()), T.StructField("class", T.StringType()), T.StructField("rings", T.ArrayType(RING))])
LAND_USE = T.StructType([T.StructField("class", T.StringType()), T.StructField("rings", T.ArrayType(RING))])
CELLS = T.StructType([T.StructField("row", T.IntegerType()), T.StructField("col", T.IntegerType()), T.StructField("v", T.DoubleType())])


@dataclass(frozen=True)
class Grid:
    """A north-up grid: cell (row, col) has its top-left corner at (west + col * res, north - row * res)."""

    west: float
    north: float
    res: float
    nrow: int
    ncol: int
    epsg: int = 32645
