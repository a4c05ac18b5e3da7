"""Feature tables: joins, derived columns, filters and imputation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terracell.functions import geometry as G

#: Road classes by buffer radius in metres (fixed values).
ROAD_RADII = [
    (2.25, ["cycleway", "road", "bridleway", "unclassified"]),
    (3.0, ["living_street", "residential", "service"]),
    (8.0, ["primary", "primary_link", "secondary", "secondary_link", "tertiary", "tertiary_link", "unknown", "trunk", "trunk_link", "motorway", "motorway_link", "raceway"]),
    (0.5, ["footway", "pedestrian"]),
]

#: What makes a segment's shape.
SHAPE = ("x1", "y1", "x2", "y2")


def left_params(buildings: DataFrame, *tables: DataFrame, key: str = "id") -> DataFrame:
    """Left joins on the id as a string; repeated ids on the right fan out."""
    found = buildings.withColumn(key, F.col(key).cast("string"))
    for t in tables:
        found = found.join(t.withColumn(key, F.col(key).cast("string")), key, "left")
    return found


def last_wins(table: DataFrame, key: str, value: str, order: list[str]) -> DataFrame:
    """(key, value): of repeated keys the last by order, so a lookup never fans out."""
    return table.groupBy(key).agg(F.max_by(value, F.struct(*order)).alias(value))


def derived_height(height: Column, floors: Column) -> Column:
    """The height if it is known and not 0, else three metres a floor."""
    return F.when(height.isNotNull() & (height != 0), height).otherwise(floors * 3)


def training_rows(df: DataFrame, features: list[str], target: str) -> DataFrame:
    """Rows without nulls in features and target, whose target is at least 1."""
    return df.na.drop(subset=[*features, target]).filter(F.col(target) >= 1)


def imputed_defaults(df: DataFrame, numeric: list[str], categorical: list[str]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.expr(f"try_cast(`{c}` AS DOUBLE)"), F.lit(0.0)) for c in numeric} | {c: F.coalesce(F.col(c).cast("string"), F.lit("unknown")) for c in categorical})


def is_problem(v: Column) -> Column:
    """Null or negative elevation difference."""
    return v.isNull() | (v < 0)


def filled_height(height: Column, predicted: Column) -> Column:
    """The known height, else the prediction, rounded half to even and not below 0."""
    return F.when(height.isNull() | (height == 0), F.greatest(F.lit(0.0), F.bround(predicted))).otherwise(height)


def parsed_width(text: Column) -> Column:
    """The first ``value`` of a list literal of rules, or a plain number; null for an empty list or other text."""
    json = F.regexp_replace(F.regexp_replace(F.regexp_replace(text, "'", '"'), r"\bNone\b", "null"), r"\b(?:True|False)\b", "null")
    return F.coalesce(F.try_element_at(F.from_json(json, "array<struct<value:double>>"), F.lit(1))["value"], text.try_cast("double"))


def road_radius(width: Column, kind: Column, subtype: Column) -> Column:
    """Half of a known width; else by class: paths 0, roads by ROAD_RADII, others 0."""
    by_class = F.when(kind == "path", 0.0).when(subtype != "road", 0.0)
    for radius, names in ROAD_RADII:
        by_class = by_class.when(kind.isin(names), radius)
    return F.when(width.isNotNull(), width / 2).otherwise(by_class.otherwise(0.0))


def building_features(df: DataFrame, ring: str = "ring") -> DataFrame:
    """Adds area, perimeter, isoquotient, obox_ratio, obox_hw and calc_height."""
    r, box = F.col(ring), F.col("__box")
    found = df.withColumn("area", G.area(r)).withColumn("__box", G.smallest_box(r))
    ok = F.col("area") > 0
    return found.withColumns(
        {
            "isoquotient": F.when(ok, G.isoquotient(r)),
            "obox_ratio": F.when(ok, F.try_divide(F.col("area"), box["length"] * box["width"])),
            "obox_hw": F.when(ok, F.least(F.try_divide(box["length"], box["width"]), F.try_divide(box["width"], box["length"]))),
            "calc_height": derived_height(F.col("height"), F.col("num_floors")),
        }
    ).drop("__box")


def radius_pairs(left: DataFrame, right: DataFrame, radius: float) -> DataFrame:
    """Pairs (left columns, right columns with prefix r_, d2) within radius, inclusive.

    Both sides have x and y. Points are binned by the radius; the left side
    looks into its 3 x 3 bins, so the join is on equal bins.
    """
    r = F.lit(float(radius))
    bx, by = F.floor(F.col("x") / r), F.floor(F.col("y") / r)
    near = F.explode(F.array(*[F.struct((bx + i).alias("bx"), (by + j).alias("by")) for i in (-1, 0, 1) for j in (-1, 0, 1)]))
    a = left.withColumn("__bin", near)
    b = right.select(*[F.col(c).alias(f"r_{c}") for c in right.columns]).withColumn("__at", F.struct(F.floor(F.col("r_x") / r).alias("bx"), F.floor(F.col("r_y") / r).alias("by")))
    d2 = (F.col("x") - F.col("r_x")) ** 2 + (F.col("y") - F.col("r_y")) ** 2
    return a.join(b, F.col("__bin") == F.col("__at")).withColumn("d2", d2).filter(F.col("d2") <= radius * radius).drop("__bin", "__at")


def tiered_heights(points: DataFrame, radius: float, least: int = 2) -> DataFrame:
    """(id, value, tier): known values; for problem rows the mean of at least ``least`` good neighbours, the nearest's value, or the global mean.

    points has id, x, y, v. Without any good row the result of problem rows is null.
    """
    good = points.filter(~is_problem(F.col("v")))
    bad = points.filter(is_problem(F.col("v"))).drop("v")
    near = radius_pairs(bad, good, radius).groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.avg("r_v").alias("mean"), F.min_by("r_v", F.struct("d2", "r_id")).alias("nearest"))
    overall = good.agg(F.avg("v").alias("overall"))
    filled = bad.join(near, "id", "left").crossJoin(F.broadcast(overall))  # one row
    value = F.when(F.col("n") >= least, F.col("mean")).when(F.col("n") >= 1, F.col("nearest")).otherwise(F.col("overall"))
    tier = F.when(F.col("n") >= least, 1).when(F.col("n") >= 1, 2).otherwise(3)
    return good.select("id", F.col("v").alias("value"), F.lit(0).alias("tier")).unionByName(filled.select("id", value.alias("value"), tier.alias("tier")))


def walked(lines: DataFrame, size: float) -> DataFrame:
    """lines by each bin (bx, by) of ``size`` that the segment passes: of each row of bins only those under its part of the row."""
    slack = 1e-9  # a crossing's own bin is walked by both segments, whatever the last digit
    low, high = F.least("y1", "y2"), F.greatest("y1", "y2")
    rows = lines.withColumn("by", F.explode(F.sequence(F.floor(low / size - slack), F.floor(high / size + slack))))
    rise = F.col("y2") - F.col("y1")

    def across(y: Column) -> Column:
        return F.col("x1") + F.try_divide((F.col("x2") - F.col("x1")) * (y - F.col("y1")), rise)

    ends = [across(F.greatest(low, F.col("by") * F.lit(size))), across(F.least(high, (F.col("by") + 1) * F.lit(size)))]
    level = rise == 0
    left = F.when(level, F.least("x1", "x2")).otherwise(F.least(*ends))
    right = F.when(level, F.greatest("x1", "x2")).otherwise(F.greatest(*ends))
    return rows.withColumn("bx", F.explode(F.sequence(F.floor(left / size - slack), F.floor(right / size + slack))))


def _crossing_shapes(lines: DataFrame, size: float) -> DataFrame:
    """Pairs of different shapes (x1, y1, x2, y2) of segments that cross properly, each once: a_ and b_ columns of either shape
    with the least and the most of its ids, and the crossing reckoned along a (``ab``) and along b (``ba``).

    Shapes meet in the bins that they pass, as many as they are long; a pair
    counts in the bin that its crossing lies in, so nothing is found twice.
    """
    at = walked(lines.groupBy(*SHAPE).agg(F.min("id").alias("least"), F.max("id").alias("most")), size)
    a, b = (at.select("bx", "by", *[F.col(c).alias(f"{s}_{c}") for c in (*SHAPE, "least", "most")]) for s in "ab")
    one, two = (tuple(F.col(f"{s}_{k}") for k in SHAPE) for s in "ab")
    met = a.join(b, ["bx", "by"]).filter(F.struct(*one) < F.struct(*two)).withColumn("ab", F.explode(F.array(G.crossing(one, two))))  # exploded, so that it is reckoned once
    here = (F.floor(F.col("ab.x") / size) == F.col("bx")) & (F.floor(F.col("ab.y") / size) == F.col("by"))
    return met.filter(F.col("ab").isNotNull() & here).withColumn("ba", F.explode(F.array(G.crossing(two, one)))).drop("bx", "by")


def segment_crossings(lines: DataFrame, size: float, digits: int | None = None) -> DataFrame:
    """(id1, id2, x, y) of proper crossings of segments (id, x1, y1, x2, y2), id1 < id2; the point along id1, rounded if ``digits`` is given.

    Segments of one shape cross others at the same points, which are reckoned
    and rounded once and then given to every pair of ids.
    """
    def point(p: str) -> list[Column]:
        return [F.col(f"{p}.{k}") if digits is None else F.round(f"{p}.{k}", digits) for k in "xy"]

    def ids(s: str) -> DataFrame:
        return lines.select(F.col("id").alias(f"{s}_id"), *[F.col(k).alias(f"{s}_{k}") for k in SHAPE])

    keys = [[f"{s}_{k}" for k in SHAPE] for s in "ab"]
    names = ("ab_x", "ab_y", "ba_x", "ba_y")
    met = _crossing_shapes(lines, size).select(*keys[0], *keys[1], *[c.alias(n) for c, n in zip([*point("ab"), *point("ba")], names, strict=True)])
    met = met.repartition(int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys[0], *keys[1])  # few rows that become many
    pairs = met.join(ids("a"), keys[0]).select("a_id", *keys[1], *names).join(ids("b"), keys[1]).filter(F.col("a_id") != F.col("b_id"))
    first = F.col("a_id") < F.col("b_id")
    return pairs.select(F.least("a_id", "b_id").alias("id1"), F.greatest("a_id", "b_id").alias("id2"), *[F.when(first, F.col(f"ab_{k}")).otherwise(F.col(f"ba_{k}")).alias(k) for k in "xy"])


def crossing_points(lines: DataFrame, size: float) -> DataFrame:
    """(x, y) of the crossings of ``segment_crossings``, for each pair of shapes once for either order of ids that its segments have."""
    points = F.array(F.when(F.col("a_least") < F.col("b_most"), F.col("ab")), F.when(F.col("b_least") < F.col("a_most"), F.col("ba")))
    return _crossing_shapes(lines, size).select(F.explode(points).alias("p")).filter("p IS NOT NULL").select("p.x", "p.y")


def regression_metrics(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """r2, rmse and mape (per cent, over rows whose actual value is not 0) in one pass and one join of a single row."""
    y, p = F.col(actual), F.col(predicted)
    sums = df.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum((y - p) ** 2).alias("sse"),
        (F.var_pop(y) * F.count(y)).alias("sst"),
        F.avg(F.when(y != 0, F.abs((y - p) / y))).alias("ape"),
    )
    return sums.select((1 - F.try_divide(F.col("sse"), F.col("sst"))).alias("r2"), F.sqrt(F.try_divide(F.col("sse"), F.col("n").cast("double"))).alias("rmse"), (F.col("ape") * 100).alias("mape"))
