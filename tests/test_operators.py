"""Hand-computed cases and properties."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from terracell.functions import geometry as G
from terracell.functions.hull import hull
from terracell.operators import distance, features, ml, raster, tin
from terracell.plans import dem, urban
from terracell.plans.dem import road_terrain
from terracell.schema import Grid


def values(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


def test_heights(spark):
    df = spark.createDataFrame([(1, 0.0, 4), (2, None, 4), (3, None, None), (4, 7.0, 1)], "id int, h double, f int")
    assert values(df.select("id", features.derived_height(F.col("h"), F.col("f")).alias("v")), "id", "v") == [(1, 12.0), (2, 12.0), (3, None), (4, 7.0)]
    p = spark.createDataFrame([(-1.2,), (0.5,), (1.5,), (2.5,)], "p double")
    assert [r[0] for r in p.select(features.filled_height(F.lit(None).cast("double"), F.col("p"))).collect()] == [0.0, 0.0, 2.0, 2.0]


def test_road_radius(spark):
    rows = [("path", "road", "[{'value': 5, 'x': None}]"), ("primary", "water", None), ("primary", "road", "[]"), ("footway", "road", "bad"), ("path", "road", None), ("other", "road", "12")]
    df = spark.createDataFrame(rows, "class string, subtype string, w string")
    got = df.select(features.road_radius(features.parsed_width(F.col("w")), F.col("class"), F.col("subtype")).alias("r")).collect()
    assert [r.r for r in got] == [2.5, 0.0, 8.0, 0.5, 0.0, 6.0]


def test_last_wins_and_fan_out(spark):
    t = spark.createDataFrame([(1, 1, 5.0), (1, 2, 6.0)], "id int, at int, v double")
    b = spark.createDataFrame([(1,)], "id int")
    assert features.left_params(b, t.select("id", "v")).count() == 2
    assert values(features.last_wins(t, "id", "v", ["at"]), "v") == [(6.0,)]


def test_imputation_tiers(spark):
    rows = [("a", 0.0, 0.0, 2.0), ("b", 1.0, 0.0, 4.0), ("c", 0.5, 0.0, None), ("d", 50.0, 0.0, 9.0), ("e", 50.0, 1.0, -3.0), ("f", 900.0, 0.0, None)]
    df = spark.createDataFrame(rows, "id string, x double, y double, v double")
    assert dict(values(features.tiered_heights(df, 3.0), "id", "value")) == {"a": 2.0, "b": 4.0, "c": 3.0, "d": 9.0, "e": 9.0, "f": 5.0}
    bad = df.filter("v is null")
    assert [r.value for r in features.tiered_heights(bad, 3.0).collect()] == [None, None]


def test_square(spark):
    ring = G.rectangle(*[F.lit(float(v)) for v in (0, 0, 10, 10)])
    r = features.building_features(spark.range(1).select(F.lit(3.0).alias("height"), F.lit(1).alias("num_floors"), ring.alias("ring"))).first()
    assert (r.area, round(r.obox_ratio, 9), round(r.obox_hw, 9), round(r.isoquotient, 7)) == (100.0, 1.0, 1.0, 0.7853975)


def test_industrial_overwrite_and_blocks(spark):
    cells = spark.createDataFrame([(0, 0, 1, 1), (0, 0, 0, 2)], "row int, col int, flag int, seq int")
    assert values(raster.burned(cells, F.col("flag"), F.col("seq")), "v") == [(0,)]
    full = spark.range(9).select(F.floor(F.col("id") / 3).cast("int").alias("row"), (F.col("id") % 3).cast("int").alias("col"), F.lit(1).alias("v"))
    assert values(raster.block_percent(full, 3), "percent") == [(100,)]
    assert values(raster.block_percent(full.limit(1), 3), "percent") == [(11,)]


def test_grid_snap(spark):
    box = spark.createDataFrame([(3.0, 3.0, 17.0, 17.0)], "x0 double, y0 double, x1 double, y1 double")
    r = raster.grid_of(box, 5).first()
    assert (r.west, r.north, r.ncol, r.nrow) == (-5, 25, 6, 6)


def dense(spark, n, sources):
    return spark.range(n * n).select(F.floor(F.col("id") / n).cast("int").alias("row"), (F.col("id") % n).cast("int").alias("col"), F.col("id").isin(list(sources)).cast("int").alias("src"))


@settings(max_examples=4, deadline=None)
@given(st.sets(st.integers(0, 143), min_size=1, max_size=9))
def test_nearest_source_matches_brute_force(spark, sources):
    got = {(r.row, r.col): (r.d2, r.src_row, r.src_col) for r in distance.nearest_source(dense(spark, 12, sources)).collect()}
    for (r, c), found in got.items():
        assert found == min(((r - s // 12) ** 2 + (c - s % 12) ** 2, s // 12, s % 12) for s in sources)


def test_no_source_is_null(spark):
    assert {r.d2 for r in distance.nearest_source(dense(spark, 4, [99])).collect()} == {None}


def test_focal_mean_of_a_constant_and_tiling_of_rays(spark):
    grid = dense(spark, 20, [45, 210, 333])
    flat = grid.select("row", "col", F.when(F.col("src") == 0, 3.0).alias("v"))
    assert {r.v for r in raster.focal_mean(flat, 2).collect()} == {3.0}
    tall = grid.select("row", "col", F.when(F.col("src") == 1, 8.0).alias("height"))
    one, many = (values(distance.rays(tall, 5.0, 30.0, 30.0, tile=t), "row", "col", "length", "direction", "svf") for t in (64, 7))
    assert one == many


def test_delaunay_circles_are_empty_and_hull():
    points = np.random.default_rng(3).random((60, 2)) * 100
    for t in tin.delaunay(points):
        a, b, c = points[t]
        m = np.array([b - a, c - a]) * 2
        centre = a + np.linalg.solve(m, ((np.array([b - a, c - a])) ** 2).sum(1))
        inside = ((points - centre) ** 2).sum(1) < ((a - centre) ** 2).sum() - 1e-6
        assert not inside.any()
    assert len(tin.delaunay(points[:2])) == 0
    assert hull([(0, 0), (1, 0), (1, 1), (0, 1), (0.5, 0.5), (0.5, 0)]) == [(0, 0), (1, 0), (1, 1), (0, 1)]


def test_blocks_give_the_triangulation_of_all_nodes(spark):
    draw = np.random.default_rng(8)
    along = draw.random(120) * 90
    points = np.vstack([draw.random((250, 2)) * 100, np.column_stack([along, along * 0.37 + 20]), draw.random((60, 2)) * [6, 6] + [120, 130]]).round(3)
    points = np.unique(points, axis=0)
    made = tin.delaunay(points)
    u, w = points[made[:, 1]] - points[made[:, 0]], points[made[:, 2]] - points[made[:, 0]]
    area = (u[:, 0] * w[:, 1] - u[:, 1] * w[:, 0]) / 2
    x, y = np.array(hull([tuple(p) for p in points.tolist()])).T
    assert (area > 0).all() and abs(area.sum() - (x * np.roll(y, -1) - np.roll(x, -1) * y).sum() / 2) < 0.01
    high = np.sin(points[:, 0] / 9) * 20 + points[:, 1] % 17
    nodes = spark.createDataFrame([(*map(float, p), float(h)) for p, h in zip(points, high)], "x double, y double, v double")
    rows = [tuple(float(v) for k in t for v in (*points[k], high[k])) for t in made]
    flat = spark.createDataFrame(rows, ", ".join(f"{a}{k} double" for k in (1, 2, 3) for a in "xyz"))
    want = {(r.row, r.col): r.v for r in tin.interpolated(flat, 0.0, 140.0, 2.5, 56, 56).collect()}
    got = tin.triangulated(nodes, 0.0, 140.0, 2.5, 56, 56, block_nodes=25).collect()
    assert len(got) == len(want) and all(abs(want[r.row, r.col] - r.v) < 1e-6 for r in got)
    assert tin.triangulated(nodes.limit(2), 0.0, 140.0, 2.5, 56, 56).count() == 0


def test_roads_step_burns_every_sub_cell_that_a_road_touches(spark, tmp_path):
    roads = [(1, 2.0, 10.05, 55.0, 10.05, "footway"), (2, 3.0, 58.0, 58.0, 21.0, "footway"), (3, 31.0, 33.0, 31.0, 33.0, "residential"), (4, -20.0, 40.0, 9.0, 66.0, "footway"), (5, 200.0, 200.0, 210.0, 200.0, "motorway")]
    lines = spark.createDataFrame(roads, "id int, x1 double, y1 double, x2 double, y2 double, class string").selectExpr("*", "'road' AS subtype", "CAST(NULL AS STRING) AS width_value")
    lines.write.parquet(str(tmp_path / "roads"))
    config = {"inputs": {"roads": str(tmp_path / "roads")}, "output": str(tmp_path / "out"), "grid": {"west": 0.0, "north": 60.0, "res": 10.0, "nrow": 6, "ncol": 6}}
    urban.Urban(spark, config).roads()
    res, t = 10 / 3, np.linspace(0, 1, 20_001)
    hit = np.zeros((18, 18))
    for _, x1, y1, x2, y2, kind in roads:
        x, y, radius = x1 + t * (x2 - x1), y1 + t * (y2 - y1), {"footway": 0.5, "residential": 3, "motorway": 8}[kind]
        for r in range(18):
            for c in range(18):
                dx = np.maximum(0, np.maximum(c * res - x, x - (c + 1) * res))
                dy = np.maximum(0, np.maximum(60 - (r + 1) * res - y, y - (60 - r * res)))
                hit[r, c] = hit[r, c] or (dx * dx + dy * dy).min() <= radius * radius
    want = {(r, c): int(hit[3 * r : 3 * r + 3, 3 * c : 3 * c + 3].sum()) * 100 // 9 for r in range(6) for c in range(6)}
    got = {(r.row, r.col): r.v for r in spark.read.parquet(f"{tmp_path}/out/roads").collect()}
    assert got == {k: v for k, v in want.items() if v}


def test_more_road_nodes_than_one_triangulation_took(spark):
    lines = spark.range(150).selectExpr("id", "id * 2.0 + 0.5 AS x1", "0.25 AS y1", "id * 2.0 + 0.75 AS x2", "309.5 AS y2")
    lines = lines.unionByName(spark.range(150).selectExpr("id + 1000 AS id", "0.25 AS x1", "id * 2.0 + 0.4 AS y1", "309.5 AS x2", "id * 2.0 + 0.9 AS y2"))
    surface = spark.range(31 * 31).selectExpr("CAST(id DIV 31 AS INT) AS row", "CAST(id % 31 AS INT) AS col", "7.0D AS v")
    got = road_terrain(surface, lines, 10.0, 310.0, 31, 31).collect()
    assert len(got) > 800 and all(r.v is None or abs(r.v) < 1e-6 for r in got)


def test_model_errors_and_prediction(spark):
    rows = [(float(k), "ab"[k % 2], float(k % 7 + 1) if k % 5 else None) for k in range(60)]
    df = spark.createDataFrame(rows, "area double, class string, calc_height double")
    with pytest.raises(ValueError):
        ml.train(df, ["nope"], ["class"])
    with pytest.raises(ValueError):
        ml.train(df.limit(0), ["area"], ["class"])
    found = ml.predict(df, ml.train(df, ["area"], ["class"], iterations=2, depth=2), ["area"], ["class"])
    assert found.filter("predicted = 1").count() == 12 and found.filter("calc_height is null").count() == 0


def test_search_assessment_and_importances(spark, tmp_path):
    rows = [(float(k % 11), float(k % 3), "ab"[k % 2], float(k % 11 * 2 + 1)) for k in range(150)]
    df = spark.createDataFrame(rows, "area double, noise double, class string, calc_height double")
    found = ml.tune(df, ["area", "noise"], ["class"], draws=3, folds=2, grid={"depth": [1, 3], "iterations": [2, 4], "rate": [0.3]})
    params = ml.best(found)
    assert found.count() == 3 and params["rate"] == 0.3 and found.filter(F.col("rmse") < found.agg(F.min("rmse")).first()[0]).count() == 0
    path = (tmp_path / "params.json").as_uri()
    ml.save_params(spark, params, path)
    assert ml.load_params(spark, path) == params
    with pytest.raises(FileNotFoundError):
        ml.load_params(spark, path + "x")
    splits = ml.assess(df, ["area", "noise"], ["class"], splits=3, iterations=8, depth=3, rate=0.3)
    means = {r.part: r for r in ml.assessment(splits).collect()}
    assert splits.count() == 6 and set(means) == {"train", "test"} and means["test"].r2 > 0.9 and 0 <= means["test"].mape < 60
    each = [r.rmse for r in splits.filter("part = 'test'").collect()]
    assert abs(sum(each) / 3 - means["test"].rmse) < 1e-12
    ranked = ml.importances(ml.train(df, ["area", "noise"], ["class"], iterations=4, depth=2), ["area", "noise"], ["class"]).collect()
    assert [r["rank"] for r in ranked] == [1, 2, 3] and ranked[0].name == "area" and abs(sum(r.importance for r in ranked) - 1) < 1e-9


def test_kinds_of_elevation_data(spark):
    grid = Grid(100.0, 200.0, 10.0, 20, 20)
    flat = spark.range(400).selectExpr("CAST(id DIV 20 AS INT) AS row", "CAST(id % 20 AS INT) AS col", "5.0D AS v")
    lines = spark.createDataFrame([(1, 150.0, 150.0, 200.0, 100.0)], "id int, x1 double, y1 double, x2 double, y2 double")
    near = dem.near_roads([flat.filter("col < 12"), flat.withColumn("v", F.lit(9.0))], lines, grid, 10.0)
    got = {(r.row, r.col): r.v for r in near.collect()}
    assert set(got) == {(r, c) for r in range(4, 11) for c in range(4, 11)} and set(got.values()) == {5.0}
    bare = flat.withColumn("v", F.when(F.col("row") > 3, 2.0))
    assert {r.v for r in dem.elevation_raster("fabdem", [bare], grid, surface=flat).collect()} == {3.0}
    assert dem.elevation_raster("fabdem", [bare], grid, surface=flat, use_difference=False).count() == 400
    for kind, given in (("fabdem", {"tiles": []}), ("arcticdem", {"tiles": [flat]}), ("lidar", {"tiles": [flat]})):
        with pytest.raises(ValueError):
            dem.elevation_raster(kind, grid=grid, **given)


def test_long_segments_enter_the_bins_that_they_pass(spark):
    draw = np.random.default_rng(6)
    rows = [(k, *map(float, draw.integers(0, 1000, 4) + (0.5 if k % 4 else 0.0))) for k in range(120)] + [(500, 0.0, 0.0, 1000.0, 1000.0), (501, 0.0, 1000.0, 1000.0, 0.0), (502, 100.0, 0.0, 100.0, 1000.0), (503, 0.0, 300.0, 1000.0, 300.0)]
    lines = spark.createDataFrame(rows, "id int, x1 double, y1 double, x2 double, y2 double")
    assert features.walked(lines.filter("id = 500"), 10.0).count() <= 4 * 101  # of 101 x 101 bins of its box
    pairs = lambda size: sorted((r.id1, r.id2, round(r.x, 6), round(r.y, 6)) for r in features.segment_crossings(lines, size).collect())
    assert pairs(50.0) == pairs(7.0) == pairs(5000.0) and len(pairs(50.0)) > 100 and (500, 501, 500.0, 500.0) in pairs(50.0)


def test_copies_of_segments_cross_once_and_count_for_every_id(spark):
    draw = np.random.default_rng(9)
    shapes = [tuple(map(float, draw.integers(0, 300, 4) + 0.3)) for _ in range(12)]
    rows = [(k, *shapes[int(draw.integers(12))]) for k in range(200)]
    lines = spark.createDataFrame(rows, "id int, x1 double, y1 double, x2 double, y2 double")

    def crossing(a, b):
        den = (a[3] - a[1]) * (b[4] - b[2]) - (a[4] - a[2]) * (b[3] - b[1])
        t, u = (((b[1] - a[1]) * (c[4] - c[2]) - (b[2] - a[2]) * (c[3] - c[1])) / den for c in (b, a)) if den else (0.0, 0.0)
        return (a[1] + t * (a[3] - a[1]), a[2] + t * (a[4] - a[2])) if 0 < t < 1 and 0 < u < 1 else None

    wanted = sorted((a[0], b[0], *p) for a in rows for b in rows if a[0] < b[0] and (p := crossing(a, b)))
    assert values(features.segment_crossings(lines, 40.0), "id1", "id2", "x", "y") == sorted(wanted, key=repr) and len(wanted) > 2000
    points = values(features.crossing_points(lines, 40.0), "x", "y")
    assert len(points) <= 12 * 11 and set(points) == {p[2:] for p in wanted}


def test_search_fits_each_depth_and_rate_once_a_fold(spark, monkeypatch):
    from pyspark.ml.evaluation import RegressionEvaluator
    from pyspark.ml.regression import GBTRegressor
    from pyspark.ml.tuning import CrossValidator

    rows = [(float(k % 11), "ab"[k % 2], float(k % 11 * 2 + 1)) for k in range(80)]
    df = spark.createDataFrame(rows, "area double, class string, calc_height double").coalesce(1)
    fits, fit = [], GBTRegressor._fit
    monkeypatch.setattr(GBTRegressor, "_fit", lambda self, rows: fits.append(self.getMaxIter()) or fit(self, rows))
    found = ml.tune(df, ["area"], ["class"], draws=6, folds=2, grid={"depth": [2], "iterations": [1, 2], "rate": [0.3]}).collect()
    assert fits == [2, 2] and len(found) == 6 and {r.iterations for r in found} == {1, 2}
    # As one by one, by cross-validation.
    given = features.imputed_defaults(df, ["area", "calc_height"], ["class"]).persist()
    for n in (1, 2):
        pipe = ml.model_pipeline(["area"], ["class"], "calc_height", iterations=n, depth=2, rate=0.3)
        wanted = CrossValidator(estimator=pipe, estimatorParamMaps=[{}], evaluator=RegressionEvaluator(labelCol="calc_height", metricName="rmse"), numFolds=2, seed=ml.SEED).fit(given).avgMetrics[0]
        assert {round(r.rmse, 9) for r in found if r.iterations == n} == {round(wanted, 9)}
