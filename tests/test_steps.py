import json

from pyspark.sql import functions as F

from terracell.functions import geometry as G
from terracell.plans import steps, urban
from terracell.sources import store


def test_resume_and_cli(tmp_path, capsys):
    ran = []
    registry = {name: (lambda s, c, o, name=name: ran.append(name) or {"path": name}) for name in steps.STEPS}
    m = steps.Manifest.load(str(tmp_path / "m.json"))
    for k in (1, 2, 4):
        m.save(k, {"path": "x"})
    assert steps.Manifest.load(str(tmp_path / "m.json")).first_open() == 3
    (tmp_path / "c.yaml").write_text("a: 1\n")
    args = ["--config", str(tmp_path / "c.yaml"), "--manifest", str(tmp_path / "m.json")]
    steps.main([*args, "--only-step", "3"], None, registry)
    assert ran == ["canyon_width"]
    capsys.readouterr()
    assert steps.main([*args, "--status"], None, registry)["next"] == 5
    assert json.loads(capsys.readouterr().out)["completed"][0]["step"] == 1
    assert steps.main(args, None, registry)["is_complete"]
    ran.clear()
    steps.main([*args, "--range", "3-5"], None, registry)
    steps.main([*args, "--steps", "1,2"], None, registry)
    assert ran == [*steps.STEPS[2:5], *steps.STEPS[:2]]
    steps.main([*args, "--reset", "--start-from", "18", "--log", str(tmp_path / "run.log")], None, registry)
    assert ran[-2:] == steps.STEPS[17:]
    assert "step 19: multiband" in (tmp_path / "run.log").read_text() and "step 19: multiband" in capsys.readouterr().out
    (tmp_path / "a" / "b").mkdir(parents=True)
    assert steps.find_config("c.yaml", str(tmp_path / "a" / "b")) == str(tmp_path / "c.yaml") and steps.find_config("none.yaml", str(tmp_path)) is None
    steps.log.handlers.clear()


def test_a_step_whose_output_is_not_whole_runs_again(spark, tmp_path):
    path, ran = (tmp_path / "m.json").as_uri(), []

    def step(name):
        def run(session, config, outputs):
            ran.append(name)
            session.range(3).write.mode("overwrite").parquet(str(tmp_path / name))
            return {name: str(tmp_path / name)}

        return run

    registry = {name: step(name) for name in steps.STEPS}
    steps.run_pipeline(spark, {}, registry, steps.Manifest.load(path, spark), end=3)
    assert ran == steps.STEPS[:3]
    (tmp_path / steps.STEPS[1] / "_SUCCESS").unlink()
    again = steps.Manifest.load(path, spark)
    assert again.first_open() == 4
    steps.run_pipeline(spark, {}, registry, again, end=3)
    assert ran == [*steps.STEPS[:3], *steps.STEPS[1:3]] and steps.Manifest.load(path, spark).first_open() == 4
    assert store.first_known(spark, None, str(tmp_path / "none"), str(tmp_path / steps.STEPS[0])) == str(tmp_path / steps.STEPS[0])
    again.reset()
    assert steps.Manifest.load(path, spark).outputs == {} and store.first_known(spark, path) is None


def test_all_nineteen_steps(spark, tmp_path):
    n, res = 24, 5.0
    rect = [F.col(k) for k in ("x0", "y0", "x1", "y1")]
    rows = [(str(i), i, 10.0 + i % 4 * 28, 10.0 + i // 4 * 28, 20.0 + i % 4 * 28, 22.0 + i // 4 * 28, float(i % 5 + 3) if i % 3 else None, 2 if i % 4 else None, "house", "x") for i in range(16)]
    buildings = spark.createDataFrame(rows, "id string, seq int, x0 double, y0 double, x1 double, y1 double, height double, num_floors int, class string, subtype string").withColumn("ring", G.rectangle(*rect)).drop("x0", "y0", "x1", "y1")
    grid = spark.range(n * n).select(F.floor(F.col("id") / n).cast("int").alias("row"), (F.col("id") % n).cast("int").alias("col"))
    lines = spark.createDataFrame([(1, 2.0, 2.0, 118.0, 4.0, "primary", "road", None), (2, 2.0, 4.0, 4.0, 118.0, "service", "road", None), (3, 118.0, 1.0, 117.0, 118.0, "service", "road", "[{'value': 4}]"), (4, 1.0, 116.0, 119.0, 117.0, "path", "road", None)], "id int, x1 double, y1 double, x2 double, y2 double, class string, subtype string, width_value string")
    tables = {
        "buildings": buildings,
        "roads": lines,
        "land_use": spark.createDataFrame([(1, "industrial", 0.0, 0.0, 60.0, 60.0)], "seq int, class string, x0 double, y0 double, x1 double, y1 double").withColumn("ring", G.rectangle(*rect)),
        "surface": grid.withColumn("v", (F.col("row") * 3 + F.col("col")).cast("double")),
        "lcz_cells": grid.withColumn("v", (F.col("col") % 13 + 1).cast("double")),
        "land_cover": grid.withColumn("v", F.lit(50.0)),
        "dem_cells": grid.withColumn("v", F.col("row").cast("double")),
    }
    inputs = {}
    for name, df in tables.items():
        inputs[name] = str(tmp_path / "in" / name)
        df.write.parquet(inputs[name])
    config = {"inputs": inputs, "output": str(tmp_path / "out"), "grid": {"west": 0.0, "north": 120.0, "res": res, "nrow": n, "ncol": n}, "processing": {"width_radius": 30.0, "final_radius": 30.0, "angle": 45.0, "model": {"iterations": 2, "depth": 2}}}
    status = steps.run_pipeline(spark, config, urban.steps(), steps.Manifest.load(str(tmp_path / "m.json"), spark))
    assert status["is_complete"]
    final = spark.read.parquet(f"{tmp_path}/out/urban_parameters")
    assert final.count() == n * n and len(final.columns) == 14
    assert final.filter("height > 0").count() > 0 and final.filter("roads > 0").count() > 0 and final.filter("industrial = 1").count() > 0
