"""The public functions over a small town, from GeoJSON to the final table."""

import json

import pytest
from pyspark.sql import functions as F

import terracell
from terracell import api
from terracell.functions import geometry as G
from terracell.schema import Grid
from terracell.sources.geotiff import to_geotiff

CODE, EAST, NORTH, N, RES = 32645, 500_000.0, 3_000_000.0, 60, 5.0


def town(spark, folder):
    """Buildings, roads and land use in degrees, on 300 m x 300 m."""

    def degrees(points):
        df = spark.createDataFrame([(k, x + EAST, y + NORTH - N * RES) for k, (x, y) in enumerate(points)], "k int, x double, y double")
        rows = df.select("k", G.utm_inverse(F.col("x"), F.col("y"), 45).alias("p")).orderBy("k").collect()
        return [[r.p.lon, r.p.lat] for r in rows]

    def square(x, y, size):
        return [(x, y), (x + size, y), (x + size, y + size), (x, y + size), (x, y)]

    boxes = [(20.0 + 55 * (k % 5), 22.0 + 55 * (k // 5), 20.0 + k % 3 * 5) for k in range(25)]
    corners = degrees([p for b in boxes for p in square(*b)])
    buildings = [{"type": "Feature", "properties": {"id": f"b{k}", "class": ["house", "shop"][k % 2], "subtype": "x", "height": None if k % 4 == 0 else 3.0 + k % 6, "num_floors": None if k % 8 else 2}, "geometry": {"type": "Polygon", "coordinates": [corners[5 * k : 5 * k + 5]]}} for k in range(25)]
    line = degrees([(62, 65), (228, 66), (229, 230), (61, 229), (117, 62), (118, 232)])
    roads = [{"type": "Feature", "properties": {"id": n, "class": kind, "subtype": "road", "width_rules": rule}, "geometry": {"type": "LineString", "coordinates": way}} for n, kind, rule, way in (("r1", "primary", None, line[:4]), ("r2", "service", "[{'value': 6}]", line[4:]))]
    ring = degrees(square(30, 30, 120) + square(200, 200, 60))
    use = [{"type": "Feature", "properties": {"id": n, "class": kind}, "geometry": {"type": "Polygon", "coordinates": [r]}} for n, kind, r in (("u1", "industrial", ring[:5]), ("u2", "park", ring[5:]))]
    for name, some in (("buildings", buildings), ("roads", roads), ("use", use)):
        (folder / f"{name}.geojson").write_text(json.dumps({"type": "FeatureCollection", "features": some}))


def test_the_public_functions(spark, tmp_path):
    town(spark, tmp_path)
    at = lambda name: str(tmp_path / name)
    mask = terracell.rasterize_buildings(spark, at("buildings.geojson"), at("mask"), RES, CODE)
    grid = api.read_raster(spark, at("mask"))[1]
    covered = mask.filter("v = 1").count()
    assert mask.count() == grid.nrow * grid.ncol and abs(covered * RES * RES - sum((20 + k % 3 * 5) ** 2 for k in range(25))) < 2500
    paths = terracell.process_building_rasters(spark, at("mask"), at("canyon"), tile=32)
    assert spark.read.parquet(paths["tiles"]).filter("busy").count() > 0 and spark.read.parquet(paths["canyon_params"]).columns[:2] == ["row", "col"]
    canyons = terracell.canyon_width_tiles(spark, paths["distance"], paths["allocation"], at("widths"), 60.0)
    assert canyons.agg(F.max("width")).first()[0] <= 120 and canyons.columns == ["row", "col", "width", "height"]
    width = terracell.process_width_raster_pipeline(spark, at("widths"), at("buildings.geojson"), at("w"), "width", fill_filter_size=6, mean_filter_size=2, crs_code=CODE)
    assert width.count() == 25 and width.filter("width_med > 0").count() == 25

    surface = api.every_cell(spark, grid).withColumn("v", 100.0 + F.col("row") * 0.1)
    tall = surface.join(mask.withColumnRenamed("v", "b"), ["row", "col"]).select("row", "col", (F.col("v") + F.col("b") * 7).alias("v"))
    api.write_raster(tall, at("surface"), grid)
    for n, part in enumerate((tall.filter("col < 40"), tall.filter("col >= 30").withColumn("col", F.col("col") - 30))):
        to_geotiff(part, at(f"dsm_{n}.tif"), Grid(grid.west + n * 30 * RES, grid.north, RES, grid.nrow, grid.ncol - 30 if n else 40, CODE), ["v"], nodata=-9999)
    to_geotiff(surface, at("bare.tif"), grid, ["v"], nodata=-9999)
    roads_way = terracell.dem_full_pipeline(spark, at("roads.geojson"), at("buildings.geojson"), at("dem.csv"), dem_tiles_pattern=at("dsm_*.tif"), crs_code=CODE)
    bare_way = terracell.dem_full_pipeline(spark, at("roads.geojson"), at("buildings.geojson"), at("bare.csv"), fabdem_tiles_pattern=at("bare.tif"), copernicus_dem=at("surface"), dem_type="fabdem", target_csv=at("w/buildings_width.csv"), crs_code=CODE)
    assert roads_way.count() == 25 and all(abs(r.max_value - 7) < 1e-3 for r in bare_way.collect()) and "width_med" in bare_way.columns
    assert all(5 < r.max_value < 10 for r in roads_way.collect())
    with pytest.raises(ValueError, match="unknown kind"):
        terracell.dem_full_pipeline(spark, at("roads.geojson"), at("buildings.geojson"), at("x.csv"), dem_type="other")

    zones = api.write_raster(api.every_cell(spark, grid).withColumn("v", F.when(F.col("col") % 7 == 0, 14.0).otherwise(F.floor(F.col("row") / 30) + 2.0)), at("zones"), grid)
    lcz = terracell.lcz_prepair(spark, at("zones"), at("buildings.geojson"), at("l"), buffer_meters=20.0, crs_code=CODE)
    assert zones.count() and {r.majority_100m for r in lcz.collect()} <= {"2", "3", "4"}
    table = terracell.calculate_building_parameters(spark, at("buildings.geojson"), at("w/buildings_width.csv"), at("l/buildings_lcz.csv"), at("dem.csv"), at("prepared.csv"), CODE)
    assert table.count() == 25 and table.filter("geometry like 'POLYGON%' and area between 399 and 901").count() == 25
    best = terracell.find_best_catboost_params(spark, at("prepared.csv"), n_iter=2, cv=2, grid={"depth": [2], "iterations": [2, 3], "rate": [0.1]})
    assert best["depth"] == 2 and best["rate"] == 0.1
    terracell.restore_building_height_model(spark, at("prepared.csv"), at("model"), best_params=best)
    filled = terracell.predict_with_trained_model(spark, at("prepared.csv"), at("model"), at("predicted.csv"))
    assert filled.filter("calc_height > 0").count() == 25 and filled.agg(F.sum("predicted")).first()[0] > 0
    both = terracell.rasterize_both_heights(spark, at("predicted.csv"), at("h"), at("mask"))
    assert both["calc_height"].count() == covered
    rays = terracell.process_canyon_length(spark, at("h/height_calc_height"), at("length"), 60.0, 45.0)
    assert rays.count() == mask.count() - covered

    roads = terracell.rasterize_roads(spark, at("roads.geojson"), at("mask"), at("roads"), CODE)
    assert roads.filter("v between 1 and 100").count() == roads.count() > 100
    industry = terracell.rasterize_industrial(spark, at("use.geojson"), at("mask"), at("industry"), resolution=10.0, crs_code=CODE)
    assert {r.v for r in industry.select("v").distinct().collect()} == {0, 1} and api.read_raster(spark, at("industry"))[1].res == 10.0
    degrees = Grid(86.9, 27.2, 0.01, 40, 40, 4326)
    to_geotiff(api.every_cell(spark, degrees).withColumn("v", F.col("row") * 40.0 + F.col("col")), at("world.tif"), degrees, ["v"])
    cover = terracell.reproject_resample_clip(spark, at("world.tif"), at("mask"), at("cover"))
    assert cover.filter("v is not null").count() == mask.count() and cover.select("v").distinct().count() < 20
    final = terracell.create_multiband_raster(spark, at("final"), at("mask"), {"height": at("h/height_calc_height"), "width": (at("widths"), "width"), "direction": (at("length"), "direction"), "roads": at("roads"), "industry": at("industry"), "cover": at("cover")}, discrete_bands=["industry", "direction"])
    assert final.count() == mask.count() and set(final.columns) == {"row", "col", "height", "width", "direction", "roads", "industry", "cover"} and final.filter("height is null").count() == 0
    assert spark.read.parquet(at("final")).schema["width"].metadata["band"] == 2


def test_all_names_are_there():
    assert len(terracell.API) == len(set(terracell.API)) == 20 and all(callable(getattr(terracell, n)) for n in terracell.API)
    with pytest.raises(AttributeError):
        terracell.nothing_of_the_kind  # noqa: B018
    with pytest.raises(ValueError):
        api.utm_of(4326)
