"""Derived relations over the star-schema tables, in SQL that Spark and DuckDB both run unchanged."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

BLD = """SELECT CAST(p_partkey AS STRING) AS id, p_partkey AS seq,
 CAST(p_partkey*37%997 AS DOUBLE)*10 AS x0, CAST(p_partkey*61%991 AS DOUBLE)*10 AS y0,
 CAST(p_size%7*5+10 AS DOUBLE) AS w, CAST(p_size%5*5+10 AS DOUBLE) AS h,
 CASE WHEN p_partkey%3=0 THEN NULL WHEN p_partkey%11=0 THEN CAST(0 AS DOUBLE) ELSE CAST(p_size AS DOUBLE) END AS height,
 CASE WHEN p_partkey%5=0 THEN NULL ELSE p_size%9+1 END AS num_floors,
 CASE WHEN p_partkey%7=0 THEN NULL ELSE p_type END AS class, p_brand AS subtype FROM part"""
DEM = "SELECT CAST(l_partkey AS STRING) AS id, MAX(l_quantity)-45 AS max_value FROM lineitem WHERE l_partkey%4<>0 GROUP BY l_partkey"
WIDTH = "SELECT CAST(l_partkey AS STRING) AS id, CAST(MIN(l_linenumber)*7 AS DOUBLE) AS width_med FROM lineitem WHERE l_partkey%5<>0 GROUP BY l_partkey"
LCZ = "SELECT CAST(l_partkey AS STRING) AS id, CAST(MAX(l_orderkey)%10+1 AS STRING) AS majority_100m FROM lineitem WHERE l_partkey%6<>0 GROUP BY l_partkey"
CELLS = """SELECT r AS row, c AS col, CASE WHEN (r*7+c*13)%10=0 THEN NULL ELSE v END AS v,
 CASE WHEN (r*31+c*17)%23=0 THEN 1 ELSE 0 END AS bmask, CAST((r*5+c*3)%17+1 AS INT) AS lcz FROM (
 SELECT CAST(l_orderkey%64 AS INT) AS r, CAST(l_partkey%64 AS INT) AS c, CAST(SUM(l_quantity) AS DOUBLE) AS v FROM lineitem GROUP BY 1,2) t"""
ROADS = """SELECT s_suppkey AS id, CAST(s_suppkey*53%640 AS DOUBLE) AS x1, CAST(s_suppkey*29%640 AS DOUBLE) AS y1,
 CAST(s_suppkey*71%640 AS DOUBLE) AS x2, CAST(s_suppkey*97%640 AS DOUBLE) AS y2,
 CASE WHEN s_suppkey%10=0 THEN 'water' ELSE 'road' END AS subtype,
 CASE s_suppkey%8 WHEN 0 THEN 'path' WHEN 1 THEN 'residential' WHEN 2 THEN 'primary' WHEN 3 THEN 'motorway' WHEN 4 THEN 'footway' WHEN 5 THEN 'cycleway' WHEN 6 THEN 'service' ELSE 'other' END AS class,
 CASE WHEN s_suppkey%6=0 THEN CONCAT('[{"value": ', CAST(s_suppkey%9+2 AS STRING), '.5}]') WHEN s_suppkey%6=1 THEN '[]' WHEN s_suppkey%6=2 THEN 'bad' ELSE NULL END AS width_value FROM supplier"""
# A dense grid: at the smallest scale some cells have no row.
DENSE = f"SELECT g.row, g.col, c.v, CASE WHEN (g.row*31+g.col*17)%23=0 THEN 1 ELSE 0 END AS src FROM (SELECT CAST(a.i AS INT) AS row, CAST(b.i AS INT) AS col FROM n64 a CROSS JOIN n64 b) g LEFT JOIN ({CELLS}) c ON g.row=c.row AND g.col=c.col"

# A raster that grows with the tables: as many rows of cells as the square root of the order lines.
LAND = """SELECT CAST(floor(k/n) AS INT) AS row, CAST(k%n AS INT) AS col, CASE WHEN floor(k/n)%29<11 OR k%n%37<14 THEN NULL ELSE q END AS v,
 CASE WHEN floor(k/n)%29<11 OR k%n%37<14 THEN 0 ELSE 1 END AS src FROM (
 SELECT row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice)-1 AS k, CAST(l_quantity AS DOUBLE) AS q FROM lineitem) t,
 (SELECT CAST(floor(sqrt(count(*))) AS BIGINT) AS n FROM lineitem) s WHERE k<n*n"""

_TABLES = ("part", "lineitem", "supplier", "orders", "events", "embeddings")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def relation(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """The SQL with table names bound to DataFrames, without registering views."""
    used = {t: table(spark, sf_dir, t) for t in _TABLES if f"FROM {t}" in sql or f"JOIN {t}" in sql}
    sql = sql.replace("{", "{{").replace("}", "}}")  # braces of literals are not names
    for t in used:
        sql = sql.replace(f"FROM {t}", f"FROM {{{t}}}").replace(f"JOIN {t}", f"JOIN {{{t}}}")
    return spark.sql(sql, **used)


def dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    """row, col, v and src on all 64 x 64 cells."""
    from pyspark.sql import functions as F

    cells = relation(spark, sf_dir, CELLS).select("row", "col", "v")
    grid = spark.range(64 * 64).select(F.floor(F.col("id") / 64).cast("int").alias("row"), (F.col("id") % 64).cast("int").alias("col"))
    source = F.when((F.col("row") * 31 + F.col("col") * 17) % 23 == 0, 1).otherwise(0)
    return grid.join(cells, ["row", "col"], "left").withColumn("src", source)


#: For DuckDB, in front of a query.
WITH = f"WITH bld AS ({BLD}), dem AS ({DEM}), width AS ({WIDTH}), lczs AS ({LCZ}), cells AS ({CELLS}), roads AS ({ROADS}), n64 AS (SELECT i FROM range(64) t(i)), dense AS ({DENSE}), land AS ({LAND}) "
