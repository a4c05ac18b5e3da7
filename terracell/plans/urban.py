"""The nineteen steps over cell tables, bound to the step pipeline: each reads tables, writes tables, returns paths.

config: ``inputs`` (tables of buildings, roads, land_use, surface, lcz_cells,
land_cover, dem_cells), ``output`` (a folder) and ``grid`` (west, north, res,
nrow, ncol). Vector tables have open rings in ``ring``; roads are segments.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terracell.operators import distance, features, ml, raster
from terracell.plans.catalogue import CATEGORICAL, NUMERIC
from terracell.plans.dem import building_elevations, elevation_raster
from terracell.schema import Grid
from terracell.sources import store
from terracell.sources.vector import segments


class Urban:
    """The steps, as methods of one configured run."""

    def __init__(self, spark: SparkSession, config: dict):
        self.spark, self.inputs, self.out = spark, config["inputs"], config["output"].rstrip("/")
        self.grid = Grid(**config["grid"])
        self.options = config.get("processing", {})

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.inputs[name])

    def kept(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.out}/{name}")

    def keep(self, df: DataFrame, name: str) -> dict:
        df.write.mode("overwrite").parquet(f"{self.out}/{name}")
        return {name: f"{self.out}/{name}"}

    def covered(self, df: DataFrame, reach: float = 0.0) -> DataFrame:
        g = self.grid
        return raster.covered(df, g.west, g.north, g.res, g.ncol, g.nrow, reach=reach)

    def on_cells(self, features: DataFrame, cells: DataFrame) -> DataFrame:
        return raster.on_cells(features, cells, self.grid.nrow * self.grid.ncol)

    def cells(self) -> DataFrame:
        g = self.grid
        return self.spark.range(g.nrow * g.ncol).select(F.floor(F.col("id") / g.ncol).cast("int").alias("row"), (F.col("id") % g.ncol).cast("int").alias("col"))

    def rasterize_buildings(self) -> dict:
        hit = self.covered(self.read("buildings")).select("row", "col").distinct().withColumn("hit", F.lit(1))
        return self.keep(self.cells().join(hit, ["row", "col"], "left").select("row", "col", F.coalesce("hit", F.lit(0)).alias("src")), "mask")

    def distance_allocation(self) -> dict:
        return self.keep(distance.nearest_source(self.kept("mask")), "nearest")

    def _canyons(self, heights: DataFrame, radius: float, name: str) -> dict:
        at = heights.select(F.col("row").cast("long").alias("src_row"), F.col("col").cast("long").alias("src_col"), F.col("v").alias("alloc"))
        field = self.kept("nearest").join(at, ["src_row", "src_col"], "left").select("row", "col", "d2", "alloc")
        return self.keep(distance.canyon_width(field, self.grid.res, radius), name)

    def canyon_width(self) -> dict:
        ones = self.kept("mask").filter("src = 1").select("row", "col", F.lit(1.0).alias("v"))
        return self._canyons(ones, self.options.get("width_radius", 500.0), "canyons_first")

    def width_features(self) -> dict:
        width = self.cells().join(self.kept("canyons_first").select("row", "col", F.col("width").alias("v")), ["row", "col"], "left")
        smooth = raster.focal_mean(raster.gap_filled(width, self.options.get("fill", 50)), self.options.get("smooth", 100))
        means = self.on_cells(self.covered(self.read("buildings")), smooth).groupBy("id").agg(F.avg(F.nullif("v", F.lit(0.0))).alias("width_med"))
        return self.keep(smooth, "width") | self.keep(means, "buildings_width")

    def _lines(self) -> DataFrame:
        """Roads as segments, each with an id of its own: as given, or those of lines of any length in ``rings``."""
        lines = self.read("roads")
        if "rings" not in lines.columns:
            return lines
        found = segments(lines)
        return found.withColumn("id", F.concat_ws("/", F.col("id").cast("string"), "line", "place"))

    def dem_features(self) -> dict:
        kind = self.options.get("dem_type", "arcticdem")
        tiles = [self.spark.read.parquet(p) for p in self.inputs.get("dem_tiles", [])] or [self.read("surface")]
        surface = self.read("surface") if kind == "fabdem" else None
        rise = elevation_raster(kind, tiles, self.grid, self._lines(), surface, self.options.get("use_difference", True), self.options.get("dem_buffer", 100.0))
        return self.keep(building_elevations(self.read("buildings"), rise, self.grid, self.options.get("dem_radius", 200.0)), "buildings_dem")

    def lcz_features(self) -> dict:
        kept = self.read("lcz_cells").select("row", "col", F.when(~F.col("v").isin(list(range(11, 18))), F.col("v").cast("double")).alias("v"))
        clean = raster.gap_filled(kept, self.options.get("lcz_fill", 1000)).select("row", "col", F.round("v").alias("v"))
        counts = self.on_cells(self.covered(self.read("buildings"), self.options.get("lcz_reach", 100.0)), clean.filter("v IS NOT NULL")).groupBy("id", "v").agg(F.count(F.lit(1)).alias("n"))
        best = counts.groupBy("id").agg(F.min(F.struct((-F.col("n")).alias("n"), "v"))["v"].cast("int").cast("string").alias("majority_100m"))
        return self.keep(clean, "lcz_clean") | self.keep(best, "buildings_lcz")

    def building_features(self) -> dict:
        joined = features.left_params(self.read("buildings"), self.kept("buildings_dem").withColumnRenamed("max_value", "min_dem"), self.kept("buildings_width"), self.kept("buildings_lcz"))
        return self.keep(features.building_features(joined), "buildings_prepared")

    def train_model(self) -> dict:
        rows, options = self.kept("buildings_prepared"), dict(self.options.get("model", {}))
        if self.options.get("tuning"):
            found = ml.tune(rows, NUMERIC, CATEGORICAL, **self.options["tuning"])
            options |= ml.best(found)
            ml.save_params(self.spark, options, f"{self.out}/model_params.json")
        elif (saved := store.first_known(self.spark, self.options.get("model_params"), f"{self.out}/model_params.json")) is not None:
            options |= ml.load_params(self.spark, saved)
        model = ml.train(rows, NUMERIC, CATEGORICAL, **options)
        model.write().overwrite().save(f"{self.out}/model")
        return {"model": f"{self.out}/model"}

    def predict_heights(self) -> dict:
        model = ml.PipelineModel.load(f"{self.out}/model")
        return self.keep(ml.predict(self.kept("buildings_prepared"), model, NUMERIC, CATEGORICAL), "buildings_predicted")

    def rasterize_heights(self) -> dict:
        known = self.kept("buildings_predicted").filter("calc_height IS NOT NULL")
        cells = self.covered(known)
        order = F.struct("seq") if "seq" in cells.columns else F.struct("id")
        return self.keep(raster.burned(cells, F.col("calc_height"), order), "height_calc") | self.keep(raster.burned(cells, F.col("predicted"), order), "height_pred")

    def height_allocation(self) -> dict:
        return self.keep(distance.allocation(self.kept("mask"), self.kept("height_calc")), "allocation")

    def canyon_width_final(self) -> dict:
        return self._canyons(self.kept("height_calc"), self.options.get("final_radius", 1000.0), "canyons")

    def canyon_length(self) -> dict:
        tall = self.cells().join(self.kept("height_calc").select("row", "col", F.col("v").cast("double").alias("height")), ["row", "col"], "left")
        return self.keep(distance.rays(tall, self.grid.res, self.options.get("angle", 1.0), self.options.get("final_radius", 1000.0)), "canyon_length")

    def roads(self) -> dict:
        g, lines = self.grid, self._lines()
        width = features.parsed_width(F.col("width_value"))
        wide = lines.withColumn("radius", features.road_radius(width, F.col("class"), F.col("subtype"))).filter("radius > 0")
        hit = raster.touched(wide, g.west, g.north, g.res / 3, g.ncol * 3, g.nrow * 3).withColumn("v", F.lit(1))
        return self.keep(raster.block_percent(hit, 3).withColumnRenamed("percent", "v"), "roads")

    def industrial(self) -> dict:
        use = self.read("land_use")
        flag = F.when(F.col("class") == self.options.get("industrial", "industrial"), 1).otherwise(0)
        found = raster.burned(self.covered(use), flag, F.struct("seq"))
        # The mask has an extent of its own, that of its layer: outside it nothing is said.
        return self.keep(found, "industrial")

    def _resampled(self, source: str, name: str, method: str) -> dict:
        return self.keep(raster.resampled(self.read(source), self.cells(), self.options.get(f"{source}_scale", 1.0), method), name)

    def land_cover(self) -> dict:
        return self._resampled("land_cover", "worldcover", "nearest")

    def lcz(self) -> dict:
        return self._resampled("lcz_cells", "lcz", "nearest")

    def terrain(self) -> dict:
        return self._resampled("dem_cells", "terrain", "bilinear")

    def multiband(self) -> dict:
        def band(table: str, column: str = "v") -> DataFrame:
            return self.kept(table).select("row", "col", F.col(column).alias("v"))

        bands = {"height": band("height_calc"), "predicted": band("height_pred"), "canyon_width": band("canyons", "width"), "canyon_height": band("canyons", "height")}
        bands |= {"canyon_length": band("canyon_length", "length"), "canyon_direction": band("canyon_length", "direction"), "sky_view": band("canyon_length", "svf")}
        bands |= {"roads": band("roads"), "industrial": band("industrial"), "land_cover": band("worldcover"), "lcz": band("lcz"), "terrain": band("terrain")}
        return self.keep(raster.multiband(self.cells(), bands), "urban_parameters")


def steps() -> dict:
    """The registry for the step pipeline."""
    from terracell.plans.steps import STEPS

    return {name: lambda spark, config, _, name=name: getattr(Urban(spark, config), name)() for name in STEPS}
