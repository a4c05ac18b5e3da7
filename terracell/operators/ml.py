"""Gradient-boosted height models: tuning, training, prediction, assessment."""

from __future__ import annotations

import json
import random
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terracell.operators.features import filled_height, imputed_defaults, regression_metrics, training_rows
from terracell.sources import store

SEED = 22


def model_pipeline(numeric: list[str], categorical: list[str], target: str, iterations: int = 20, depth: int = 4, rate: float = 0.1, seed: int = SEED, bins: int = 64) -> Pipeline:
    index = StringIndexer(inputCols=categorical, outputCols=[f"{c}_ix" for c in categorical], handleInvalid="keep")
    vector = VectorAssembler(inputCols=[*numeric, *[f"{c}_ix" for c in categorical]], outputCol="features")
    trees = GBTRegressor(featuresCol="features", labelCol=target, maxIter=iterations, maxDepth=depth, stepSize=rate, seed=seed, maxBins=bins)
    return Pipeline(stages=[index, vector, trees])


def train(df: DataFrame, numeric: list[str], categorical: list[str], target: str = "calc_height", **params) -> PipelineModel:
    """Fits on rows without nulls whose target is at least 1; missing columns or no rows raise ValueError."""
    missing = [c for c in [*numeric, *categorical, target] if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    rows = training_rows(df, [*numeric, *categorical], target)
    rows = imputed_defaults(rows, [*numeric, target], categorical).select(*numeric, *categorical, target).persist()
    try:
        if rows.isEmpty():
            raise ValueError("no training rows")
        return model_pipeline(numeric, categorical, target, **params).fit(rows)
    finally:
        rows.unpersist()


def predict(df: DataFrame, model: PipelineModel, numeric: list[str], categorical: list[str], target: str = "calc_height") -> DataFrame:
    """df with missing or zero targets filled by the rounded prediction; predicted is 1 there."""
    missing = F.col(target).isNull() | (F.col(target) == 0)
    scored = model.transform(imputed_defaults(df, numeric, categorical))
    kept = [c for c in df.columns if c != target]
    return scored.select(*kept, filled_height(F.col(target), F.col("prediction")).alias(target), missing.cast("int").alias("predicted"))


#: What a search draws from, unless it is told otherwise.
GRID = {"depth": [2, 3, 4], "iterations": [3, 5, 8], "rate": [0.05, 0.1, 0.2]}

#: Rows of a task that fits trees in a search.
PART_ROWS = 10_000


def tune(df: DataFrame, numeric: list[str], categorical: list[str], target: str = "calc_height", draws: int = 4, folds: int = 3, seed: int = SEED, grid: dict[str, list] | None = None, parallel: int = 4) -> DataFrame:
    """(depth, iterations, rate, rmse) of randomly drawn parameters, by cross-validation; ``grid`` lists the values of each.

    Features of a fold are made once. Boosting adds trees one by one, so the
    first trees of a longer run are those of a shorter one: each depth and rate
    is fitted once a fold, with the most trees drawn for it.
    """
    draw = random.Random(seed)
    grid = GRID | (grid or {})
    drawn = [(draw.choice(grid["depth"]), draw.choice(grid["iterations"]), draw.choice(grid["rate"])) for _ in range(draws)]
    most: dict[tuple[int, float], int] = {}
    for depth, iterations, rate in drawn:
        most[depth, rate] = max(iterations, most.get((depth, rate), 0))
    *features, trees = model_pipeline(numeric, categorical, target, seed=seed).getStages()
    rows = imputed_defaults(training_rows(df, [*numeric, *categorical], target), [*numeric, target], categorical).select(*numeric, *categorical, target).persist()
    dealt = rows.withColumn("__at", F.rand(seed))
    parts = -(-rows.count() // PART_ROWS) or 1  # every level of every tree is a job of so many tasks
    sides = []
    for k in range(folds):
        held = (F.col("__at") >= k / folds) & (F.col("__at") < (k + 1) / folds)
        made = Pipeline(stages=features).fit(dealt.filter(~held))
        sides.append([made.transform(dealt.filter(side)).select("features", target).coalesce(parts).persist() for side in (~held, held)])

    def errors(job: tuple[tuple[int, float], int]) -> list[float]:
        """The rmse on the held-out side after each tree."""
        (depth, rate), k = job
        fit, held = sides[k]
        model = trees.copy({trees.maxDepth: depth, trees.maxIter: most[depth, rate], trees.stepSize: rate}).fit(fit)
        return [mse**0.5 for mse in model.evaluateEachIteration(held, "squared")]

    jobs = [(key, k) for key in most for k in range(folds)]
    try:
        with ThreadPool(min(parallel, len(jobs))) as pool:
            found = dict(zip(jobs, pool.map(inheritable_thread_target(df.sparkSession)(errors), jobs, chunksize=1), strict=True))
    finally:
        for side in [rows, *[x for pair in sides for x in pair]]:
            side.unpersist()
    means = [sum(found[(depth, rate), k][iterations - 1] for k in range(folds)) / folds for depth, iterations, rate in drawn]
    listed = [(depth, iterations, rate, float(m)) for (depth, iterations, rate), m in zip(drawn, means, strict=True)]
    return df.sparkSession.createDataFrame(listed, "depth int, iterations int, rate double, rmse double")


def best(found: DataFrame) -> dict:
    """The drawn parameters of least error; ties go to the smaller parameters."""
    row = found.orderBy("rmse", "depth", "iterations", "rate").first()
    return {"depth": row.depth, "iterations": row.iterations, "rate": row.rate}


def save_params(spark: SparkSession, params: dict, path: str) -> None:
    """Parameters as JSON, in any store that Spark reads."""
    store.write_text(spark, path, json.dumps(params))


def load_params(spark: SparkSession, path: str) -> dict:
    """Saved parameters; a missing file raises FileNotFoundError."""
    text = store.read_text(spark, path)
    if text is None:
        raise FileNotFoundError(path)
    return json.loads(text)


def importances(model: PipelineModel, numeric: list[str], categorical: list[str]) -> DataFrame:
    """(name, importance, rank) of the model's features, the most important first; equal ones by name."""
    values = model.stages[-1].featureImportances.toArray()
    ranked = sorted(zip([*numeric, *categorical], map(float, values), strict=True), key=lambda x: (-x[1], x[0]))
    rows = [(name, value, k) for k, (name, value) in enumerate(ranked, 1)]
    return SparkSession.getActiveSession().createDataFrame(rows, "name string, importance double, rank int")


def assess(df: DataFrame, numeric: list[str], categorical: list[str], target: str = "calc_height", splits: int = 10, share: float = 0.2, seed: int = SEED, **params) -> DataFrame:
    """(split, part, r2, rmse, mape) over repeated random splits, for the rows that were fitted (train) and held out (test).

    A split needs rows on both sides; one without is left out.
    """
    rows = training_rows(df, [*numeric, *categorical], target).persist()
    found = None
    for k in range(splits):
        fit, held = rows.randomSplit([1 - share, share], seed + k)
        if fit.isEmpty() or held.isEmpty():
            continue
        model = train(fit, numeric, categorical, target, **params)
        for part, side in (("train", fit), ("test", held)):
            scored = model.transform(imputed_defaults(side, [*numeric, target], categorical))
            one = regression_metrics(scored, target, "prediction").select(F.lit(k).alias("split"), F.lit(part).alias("part"), "r2", "rmse", "mape")
            found = one if found is None else found.unionByName(one)
    if found is None:
        raise ValueError("no split has rows on both sides")
    return found


def assessment(splits: DataFrame) -> DataFrame:
    """(part, r2, rmse, mape): means over the splits."""
    return splits.groupBy("part").agg(*[F.avg(c).alias(c) for c in ("r2", "rmse", "mape")])
