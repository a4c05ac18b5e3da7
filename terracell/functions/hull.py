"""Convex hulls of point arrays, as an Arrow-batched function."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def hull(points: list[tuple[float, float]]) -> list[tuple[float, float]]:
    """Counter-clockwise hull by the monotone chain; collinear points are left out."""
    points = sorted(set(points))
    if len(points) < 3:
        return points

    def chain(ordered):
        found: list[tuple[float, float]] = []
        for p in ordered:
            while len(found) > 1 and (found[-1][0] - found[-2][0]) * (p[1] - found[-2][1]) <= (found[-1][1] - found[-2][1]) * (p[0] - found[-2][0]):
                found.pop()
            found.append(p)
        return found[:-1]

    return chain(points) + chain(reversed(points))


def convex_hull(df: DataFrame, points: str, into: str) -> DataFrame:
    """Adds the hull ring of an array<struct<x, y>>; null stays null."""

    @F.pandas_udf("array<struct<x:double,y:double>>")
    def hulls(column: pd.Series) -> pd.Series:
        return column.map(lambda ps: None if ps is None else [{"x": x, "y": y} for x, y in hull([(p["x"], p["y"]) for p in ps])])

    return df.withColumn(into, hulls(points))
