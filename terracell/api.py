"""The public functions: each reads layers by path, runs operators, writes its result by path and returns it as a DataFrame.

Vector layers are GeoJSON (in degrees, projected to ``crs_code`` as they are
read), CSV or Parquet. Rasters are cell tables with their grid beside them,
or GeoTIFF, which is read as such and written as cell tables.
"""

from __future__ import annotations

import json
from dataclasses import asdict

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terracell import API
from terracell.functions import geometry as G
from terracell.operators import distance, features, ml, raster
from terracell.plans import dem
from terracell.plans.catalogue import CATEGORICAL, NUMERIC
from terracell.schema import Grid
from terracell.sources import cells as tables
from terracell.sources import store, vector
from terracell.sources.geotiff import on_grid, read_mosaic

#: Properties that are read from GeoJSON layers.
PROPERTIES = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("id", "class", "subtype", "width_rules", "width_value")] + [T.StructField(n, T.DoubleType()) for n in ("height", "num_floors")]
)


def utm_of(crs_code: int) -> tuple[int, bool]:
    """(zone, south) of a UTM code, 32601 to 32660 and 32701 to 32760; others raise ValueError."""
    zone = crs_code % 100
    if crs_code // 100 not in (326, 327) or not 1 <= zone <= 60:
        raise ValueError(f"not a UTM zone: {crs_code}")
    return zone, crs_code // 100 == 327


def read_layer(spark: SparkSession, path: str, crs_code: int | None = None) -> DataFrame:
    """A vector layer with ``rings`` (open) and ``ring``, the first of them; GeoJSON is projected where a code is given."""
    if not path.endswith(("json", "geojson", "ndjson")):
        return spark.read.parquet(path) if not path.endswith("csv") else spark.read.option("header", True).csv(path)
    df = vector.read_geojson(spark, path, PROPERTIES, lines=path.endswith("ndjson"))

    def placed(p: Column) -> Column:
        return G.utm(p["x"], p["y"], *utm_of(crs_code)) if crs_code else p

    polygon = F.col("geometry_type").contains("Polygon")
    rings = F.transform("rings", lambda r: F.transform(F.when(polygon, vector.open_ring(r)).otherwise(r), placed))
    return df.withColumn("rings", rings).withColumn("ring", F.try_element_at("rings", F.lit(1)))


def read_raster(spark: SparkSession, path: str, band: int | str = 1) -> tuple[DataFrame, Grid]:
    """((row, col, v), grid) of a cell table or of GeoTIFF files, which become one mosaic on the first one's cells."""
    if path.endswith((".tif", ".tiff")):
        return read_mosaic(spark, path, int(band))
    text = store.read_text(spark, f"{path}/_grid.json")
    if text is None:
        raise FileNotFoundError(f"{path} has no grid")
    df = tables.read_cells(spark, path)
    values = [c for c in df.columns if c not in ("row", "col")]
    return df.select("row", "col", F.col(band if isinstance(band, str) else values[band - 1]).alias("v")), Grid(**json.loads(text))


def write_raster(df: DataFrame, path: str, grid: Grid) -> DataFrame:
    """Writes cells and their grid; returns them as they are read back."""
    tables.write_cells(df, path)
    store.write_text(df.sparkSession, f"{path}/_grid.json", json.dumps(asdict(grid)))
    return tables.read_cells(df.sparkSession, path)


def write_rows(df: DataFrame, path: str) -> DataFrame:
    """Writes CSV without geometry (text stays); returns it as it is read back, with its types."""
    vector.write_table(df, path)
    flat = T.StructType([f for f in df.schema if not isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType))])
    return vector.read_table(df.sparkSession, path, flat)


def every_cell(spark: SparkSession, grid: Grid) -> DataFrame:
    return spark.range(grid.nrow * grid.ncol).select(F.floor(F.col("id") / grid.ncol).cast("int").alias("row"), (F.col("id") % grid.ncol).cast("int").alias("col"))


def _covered(df: DataFrame, grid: Grid, reach: float = 0.0) -> DataFrame:
    ring = "rings" if "rings" in df.columns else "ring"
    return raster.covered(df, grid.west, grid.north, grid.res, grid.ncol, grid.nrow, ring=ring, reach=reach)


def rasterize_buildings(spark: SparkSession, buildings_path: str, output_raster: str, resolution: float = 2.0, crs_code: int = 32645, fill_value: int = 1) -> DataFrame:
    """fill_value on cells whose centre a building covers, else 0, on a grid that the layer's extent gives."""
    buildings = read_layer(spark, buildings_path, crs_code)
    g = raster.grid_of(raster.extent(buildings), resolution).first()
    if g.ncol is None:
        raise ValueError("the layer has no geometry")
    grid = Grid(g.west, g.north, float(resolution), g.nrow, g.ncol, crs_code)
    hit = _covered(buildings, grid).select("row", "col").distinct().withColumn("hit", F.lit(fill_value))
    return write_raster(every_cell(spark, grid).join(hit, ["row", "col"], "left").select("row", "col", F.coalesce("hit", F.lit(0)).alias("v")), output_raster, grid)


def _sources(cells: DataFrame) -> DataFrame:
    return cells.select("row", "col", F.when(F.col("v") > 0, 1).otherwise(0).alias("src"))


def calculate_distance_only(spark: SparkSession, input_raster: str, output_path: str) -> DataFrame:
    """Distance of every cell to the nearest cell above 0, in the grid's units."""
    cells, grid = read_raster(spark, input_raster)
    return write_raster(distance.distance(_sources(cells), grid.res), output_path, grid)


def calculate_allocation_only(spark: SparkSession, input_raster: str, output_path: str) -> DataFrame:
    """The value of the nearest cell above 0."""
    cells, grid = read_raster(spark, input_raster)
    return write_raster(distance.allocation(_sources(cells), cells.filter("v > 0")), output_path, grid)


def calculate_width_tiles_only(spark: SparkSession, distance_raster: str, output_path: str, tile: int = raster.TILE, halo: int = 0) -> DataFrame:
    """The tiles of a grid with their read windows, and whether a cell of them is above 0."""
    cells, grid = read_raster(spark, distance_raster)
    busy = cells.groupBy(F.floor(F.col("row") / tile).cast("int").alias("ti"), F.floor(F.col("col") / tile).cast("int").alias("tj")).agg(F.bool_or(F.col("v") > 0).alias("busy"))
    found = raster.tiles(spark, grid.nrow, grid.ncol, (tile, tile), halo).join(busy, ["ti", "tj"], "left").withColumn("busy", F.coalesce("busy", F.lit(False)))
    found.write.mode("overwrite").parquet(output_path)
    return spark.read.parquet(output_path)


def create_empty_multiband_raster(spark: SparkSession, output_path: str, template_raster: str, n_bands: int = 3) -> DataFrame:
    """A table on the template's grid that has bands but no cells: absent cells are unknown."""
    _, grid = read_raster(spark, template_raster)
    schema = T.StructType([T.StructField(n, T.IntegerType()) for n in ("row", "col")] + [T.StructField(f"b{k}", T.DoubleType()) for k in range(1, n_bands + 1)])
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(output_path)
    store.write_text(spark, f"{output_path}/_grid.json", json.dumps(asdict(grid)))
    return spark.read.schema(schema).parquet(output_path)


def process_building_rasters(spark: SparkSession, input_raster: str, output_dir: str, tile: int = raster.TILE, n_output_bands: int = 3) -> dict[str, str]:
    """Distance, allocation, tiles and an empty result beside each other; returns their paths."""
    paths = {k: f"{output_dir.rstrip('/')}/{k}" for k in ("distance", "allocation", "tiles", "canyon_params")}
    calculate_distance_only(spark, input_raster, paths["distance"])
    calculate_allocation_only(spark, input_raster, paths["allocation"])
    calculate_width_tiles_only(spark, paths["distance"], paths["tiles"], tile)
    create_empty_multiband_raster(spark, paths["canyon_params"], input_raster, n_output_bands)
    return paths


def canyon_width_tiles(spark: SparkSession, distance_file: str, allocation_file: str, output_file: str, max_radius: float = 500.0) -> DataFrame:
    """(row, col, width, height) of street canyons from distances and allocated heights."""
    far, grid = read_raster(spark, distance_file)
    alloc, _ = read_raster(spark, allocation_file)
    squared = F.round((F.col("v") / grid.res) ** 2).alias("d2")
    field = far.select("row", "col", squared).join(alloc.select("row", "col", F.col("v").alias("alloc")), ["row", "col"], "left")
    return write_raster(distance.canyon_width(field, grid.res, max_radius), output_file, grid)


def process_width_raster_pipeline(spark: SparkSession, width_raster: str, polygons: str, output_dir: str, band: int | str = 1, invert_mask: bool = True, fill_filter_size: int = 50, mean_filter_size: int = 100, crs_code: int | None = None) -> DataFrame:
    """Widths outside (or inside) the polygons, filled and smoothed, and (id, width_med): their mean by polygon, else at its centroid."""
    cells, grid = read_raster(spark, width_raster, band)
    layer = read_layer(spark, polygons, crs_code)
    clipped = raster.masked(cells, _covered(layer.select("id", *[c for c in ("rings", "ring") if c in layer.columns]), grid).select("row", "col").distinct(), invert_mask)
    open_cells = every_cell(spark, grid).join(clipped, ["row", "col"], "left")
    filled = raster.gap_filled(open_cells, fill_filter_size)
    smooth = write_raster(raster.focal_mean(filled, mean_filter_size), f"{output_dir}/width", grid)
    means = _covered(layer, grid).join(smooth, ["row", "col"]).groupBy("id").agg(F.avg(F.nullif("v", F.lit(0.0))).alias("m"))
    at = layer.select("id", G.centroid(F.col("ring")).alias("c")).select("id", "c.x", "c.y")
    seen = raster.sampled(at, smooth, grid.west, grid.north, grid.res).join(means, "id", "left")
    return write_rows(seen.select("id", F.coalesce("m", F.nullif("v", F.lit(0.0))).alias("width_med")), f"{output_dir}/buildings_width.csv")


def dem_full_pipeline(
    spark: SparkSession, roads_path: str, buildings_path: str, output_csv: str, dem_tiles_pattern: str | None = None, fabdem_tiles_pattern: str | None = None,
    copernicus_dem: str | None = None, dem_type: str = "arcticdem", use_difference: bool = True, target_csv: str | None = None, buffer: float = 100.0, max_distance: float = 200.0, crs_code: int | None = None,
) -> DataFrame:
    """(id, max_value): heights of buildings above terrain, with ``target_csv`` joined to its rows."""
    lines = surface = None
    if dem_type == "arcticdem":
        tiles, grid = read_raster(spark, dem_tiles_pattern)
        lines = read_layer(spark, roads_path, crs_code)
        if "rings" in lines.columns:
            lines = vector.segments(lines.drop("ring")).withColumn("id", F.concat_ws("/", F.col("id"), "line", "place"))
    elif dem_type == "fabdem":
        if copernicus_dem is None or fabdem_tiles_pattern is None:
            raise ValueError("fabdem needs a surface model and bare-earth tiles")
        surface, grid = read_raster(spark, copernicus_dem)
        tiles, bare = read_raster(spark, fabdem_tiles_pattern)
        tiles = on_grid(tiles, bare, grid)
    else:
        raise ValueError(f"unknown kind of elevation data: {dem_type!r}")
    rise = dem.elevation_raster(dem_type, [tiles], grid, lines, surface, use_difference, buffer)
    found = dem.building_elevations(read_layer(spark, buildings_path, crs_code), rise, grid, max_distance)
    if target_csv is not None:
        target = read_layer(spark, target_csv)
        found = target.drop("max_value").join(found.withColumn("id", F.col("id").cast("string")), "id", "left")
    return write_rows(found, output_csv)


def lcz_prepair(spark: SparkSession, lcz_raster: str, buildings_path: str, output_dir: str, remove_values: list[int] | None = None, fill_filter_size: int = 3, buffer_meters: float = 100.0, crs_code: int | None = None) -> DataFrame:
    """(id, majority_100m): the commonest built-up climate zone within a buffer of each building, other zones removed and filled."""
    cells, grid = read_raster(spark, lcz_raster)
    gone = list(range(11, 18)) if remove_values is None else remove_values
    kept = cells.select("row", "col", F.when(~F.col("v").isin(gone), F.col("v")).alias("v")) if gone else cells
    clean = write_raster(raster.gap_filled(kept, fill_filter_size).select("row", "col", F.round("v").alias("v")), f"{output_dir}/lcz_processed", grid)
    layer = read_layer(spark, buildings_path, crs_code)
    counts = _covered(layer, grid, buffer_meters).join(clean.filter("v IS NOT NULL"), ["row", "col"]).groupBy("id", "v").agg(F.count(F.lit(1)).alias("n"))
    best = counts.groupBy("id").agg(F.min(F.struct((-F.col("n")).alias("n"), "v"))["v"].cast("int").cast("string").alias("majority_100m"))
    return write_rows(layer.select("id").join(best, "id", "left"), f"{output_dir}/buildings_lcz.csv")


def calculate_building_parameters(spark: SparkSession, buildings_geojson: str, width_csv: str, lcz_csv: str, dem_csv: str, output_csv: str, crs_code: int = 32645) -> DataFrame:
    """Features of every building with its attributes and its geometry as WKT."""
    layer = read_layer(spark, buildings_geojson, crs_code)
    attributes = {n: vector.read_table(spark, p, T.StructType([T.StructField("id", T.StringType()), T.StructField(n, kind)])) for n, p, kind in (("max_value", dem_csv, T.DoubleType()), ("width_med", width_csv, T.DoubleType()), ("majority_100m", lcz_csv, T.StringType()))}
    joined = features.left_params(layer, attributes["max_value"].withColumnRenamed("max_value", "min_dem"), attributes["width_med"], attributes["majority_100m"])
    return write_rows(features.building_features(joined).withColumn("geometry", vector.to_wkt(F.col("ring"))), output_csv)


def _prepared(spark: SparkSession, path: str, numeric: list[str], categorical: list[str], *others: str) -> DataFrame:
    df = spark.read.option("header", True).csv(path)
    missing = [c for c in [*numeric, *categorical] if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df.withColumns({c: F.col(c).try_cast("double") for c in {*numeric, *others} if c in df.columns})


def find_best_catboost_params(spark: SparkSession, input_csv: str, num_cols_model: list[str] | None = None, cat_cols: list[str] | None = None, target_col: str = "calc_height", random_seed: int = ml.SEED, cv: int = 3, n_iter: int = 30, grid: dict[str, list] | None = None) -> dict:
    """The best of randomly drawn parameters of the boosted trees."""
    numeric, categorical = num_cols_model or NUMERIC, cat_cols or CATEGORICAL
    return ml.best(ml.tune(_prepared(spark, input_csv, numeric, categorical, target_col), numeric, categorical, target_col, n_iter, cv, random_seed, grid))


def restore_building_height_model(spark: SparkSession, input_csv: str, output_model: str, num_cols_model: list[str] | None = None, cat_cols: list[str] | None = None, target_col: str = "calc_height", random_seed: int = ml.SEED, best_params: dict | None = None, **params):
    """Fits the boosted trees, found parameters before given ones, and saves them."""
    numeric, categorical = num_cols_model or NUMERIC, cat_cols or CATEGORICAL
    model = ml.train(_prepared(spark, input_csv, numeric, categorical, target_col), numeric, categorical, target_col, **{"seed": random_seed} | params | (best_params or {}))
    model.write().overwrite().save(output_model)
    return model


def predict_with_trained_model(spark: SparkSession, input_csv: str, model_path: str, output_csv: str, num_cols: list[str] | None = None, cat_cols: list[str] | None = None) -> DataFrame:
    """The rows with missing heights predicted; ``predicted`` says which."""
    numeric, categorical = num_cols or NUMERIC, cat_cols or CATEGORICAL
    rows = _prepared(spark, input_csv, numeric, categorical, "calc_height")
    return write_rows(ml.predict(rows, ml.PipelineModel.load(model_path), numeric, categorical), output_csv)


def rasterize_both_heights(spark: SparkSession, input_csv: str, output_dir: str, template_raster: str, geometry_column: str = "geometry", calc_column: str = "calc_height", pred_column: str = "predicted") -> dict[str, DataFrame]:
    """Heights and the mark of predicted ones on the template's grid; of buildings on one cell the last by id counts."""
    _, grid = read_raster(spark, template_raster)
    rows = spark.read.option("header", True).csv(input_csv)
    rows = rows.select("id", F.flatten(vector.wkt_polygons(F.col(geometry_column))).alias("rings"), *[F.col(c).try_cast("double").alias(c) for c in (calc_column, pred_column)])
    cells = _covered(rows.filter(F.col(calc_column).isNotNull()), grid)
    return {c: write_raster(raster.burned(cells, F.col(c), F.col("id")), f"{output_dir}/height_{c}", grid) for c in (calc_column, pred_column)}


def process_canyon_length(spark: SparkSession, height_raster: str, output_path: str, max_radius: float = 1000.0, direction: float = 5.0) -> DataFrame:
    """(row, col, length, direction, svf) of open cells, by rays every ``direction`` degrees."""
    cells, grid = read_raster(spark, height_raster)
    tall = every_cell(spark, grid).join(cells.select("row", "col", F.col("v").cast("double").alias("height")), ["row", "col"], "left")
    return write_raster(distance.rays(tall, grid.res, direction, max_radius), output_path, grid)


def rasterize_roads(spark: SparkSession, roads_path: str, building_raster_path: str, output_path: str, crs_code: int | None = None, super_sampling: int = 3) -> DataFrame:
    """Per cent of each cell that buffered roads touch, by super_sampling x super_sampling sub-cells."""
    _, grid = read_raster(spark, building_raster_path)
    roads = read_layer(spark, roads_path, crs_code)
    rule = F.coalesce(*[F.col(c) for c in ("width_value", "width_rules") if c in roads.columns])
    wide = roads.withColumn("radius", features.road_radius(features.parsed_width(rule), F.col("class"), F.col("subtype"))).filter("radius > 0")
    lines = vector.segments(wide.drop("ring")) if "rings" in wide.columns else wide
    hit = raster.touched(lines, grid.west, grid.north, grid.res / super_sampling, grid.ncol * super_sampling, grid.nrow * super_sampling).withColumn("v", F.lit(1))
    return write_raster(raster.block_percent(hit, super_sampling).withColumnRenamed("percent", "v"), output_path, grid)


def reproject_resample_clip(spark: SparkSession, input_rasters: str, reference_raster: str, output_path: str, resampling: str = "nearest", band_number: int | str = 1) -> DataFrame:
    """The input's mosaic on the reference's grid; the input lies in the same reference system or, with code 4326, in degrees."""
    cells, source = read_raster(spark, input_rasters, band_number)
    _, target = read_raster(spark, reference_raster)

    def same(x: Column, y: Column) -> Column:
        return F.struct(x.alias("x"), y.alias("y"))

    def degrees(x: Column, y: Column) -> Column:
        p = G.utm_inverse(x, y, *utm_of(target.epsg))
        return F.struct(p["lon"].alias("x"), p["lat"].alias("y"))

    if source.epsg not in (4326, target.epsg):
        raise ValueError(f"cannot reproject from {source.epsg} to {target.epsg}")
    return write_raster(raster.reprojected(cells, source, target, same if source.epsg == target.epsg else degrees, resampling), output_path, target)


def rasterize_industrial(spark: SparkSession, industrial_path: str, building_raster_path: str, output_path: str, target_value: str = "industrial", resolution: float = 5.0, crs_code: int | None = None) -> DataFrame:
    """1 where land use is of the target class, 0 where it is another, on a grid of its own: the layer's extent within the building raster's.

    Of areas on one cell the last by id counts.
    """
    _, frame = read_raster(spark, building_raster_path)
    use = read_layer(spark, industrial_path, crs_code)
    box = raster.extent(use).first()
    if box.x0 is None:
        raise ValueError("the layer has no geometry")
    west, north = max(box.x0, frame.west), min(box.y1, frame.north)
    east, south = min(box.x1, frame.west + frame.ncol * frame.res), max(box.y0, frame.north - frame.nrow * frame.res)
    grid = Grid(west, north, float(resolution), max(0, int((north - south) / resolution)), max(0, int((east - west) / resolution)), frame.epsg)
    if not grid.nrow or not grid.ncol:
        raise ValueError("the layer lies outside the building raster")
    flag = F.when(F.col("class") == target_value, 1).otherwise(0)
    return write_raster(raster.burned(_covered(use, grid), flag, F.col("id")).withColumn("v", F.col("v").cast("int")), output_path, grid)


def create_multiband_raster(spark: SparkSession, output_path: str, template_raster: str, band_files: dict[str, str | tuple[str, int | str]], nodata_value: float = -1.0, discrete_bands: list[str] | None = None) -> DataFrame:
    """One column a band on the template's grid: discrete bands by the nearest cell, the others bilinear; bands on that very grid as they are.

    band_files maps a band's name to a path, or to a path and the band in it.
    The columns' metadata describes the bands by number.
    """
    _, target = read_raster(spark, template_raster)
    bands = {}
    for name, place in band_files.items():
        cells, source = read_raster(spark, *((place, 1) if isinstance(place, str) else place))
        if source == target:
            bands[name] = cells
            continue
        if source.epsg != target.epsg:
            raise ValueError(f"band {name} is in {source.epsg}, the template in {target.epsg}: reproject it first")
        method = "nearest" if name in (discrete_bands or []) else "bilinear"
        bands[name] = raster.reprojected(cells, source, target, lambda x, y: F.struct(x.alias("x"), y.alias("y")), method)
    found = raster.multiband(every_cell(spark, target), bands, nodata_value)
    found = found.select("row", "col", *[F.col(n).alias(n, metadata={"band": k, "description": n, "nodata": nodata_value}) for k, n in enumerate(bands, 1)])
    return write_raster(found, output_path, target)


__all__ = list(API)
