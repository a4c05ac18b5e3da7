"""Every query against its SQL in DuckDB, at the smallest scale."""

import math
import os

import duckdb
import pytest

from terracell.plans import catalogue

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
SLOW = {"ml_tune"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("part", "lineitem", "supplier", "orders", "events", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 4)
    return v


@pytest.mark.parametrize("name", sorted(catalogue.oracle_sql()))
def test_matches_sql(spark, duck, name):
    df = catalogue.queries()[name](spark, SF)
    columns = sorted(df.columns)
    found = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    rel = duck.execute(catalogue.oracle_sql()[name])
    names = [x[0] for x in rel.description]
    assert sorted(names) == columns
    wanted = sorted((tuple(plain(r[names.index(c)]) for c in columns) for r in rel.fetchall()), key=repr)
    assert found == wanted


@pytest.mark.parametrize("name", sorted(set(catalogue.queries()) - set(catalogue.oracle_sql()) - SLOW))
def test_runs(spark, name):
    assert catalogue.queries()[name](spark, SF).count() > 0


def test_tuning_has_the_features_draws_and_folds_of_the_reference(spark, monkeypatch):
    from terracell.operators import ml

    seen = {}
    monkeypatch.setattr(ml, "tune", lambda df, numeric, categorical, **options: seen.update(options, features=[*numeric, *categorical]))
    catalogue.queries()["ml_tune"](spark, SF)
    assert seen == {"features": [*catalogue.NUMERIC, *catalogue.CATEGORICAL], "draws": 30, "folds": 3} and len(seen["features"]) == 9


def test_spatial_joins_are_not_nested_loops(spark):
    for name in ("segment_self_intersection", "radius_join_mean", "zonal_multi_stats", "gap_fill_idw", "canyon_width"):
        plan = catalogue.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan, name


@pytest.mark.parametrize("name", ["zonal_max", "width_pipeline", "zonal_majority", "zonal_multi_stats"])
def test_zones_are_never_broadcast_to_cells(spark, name):
    # A ring has many cells, which Spark's estimate leaves out.
    plan = catalogue.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    joins = [line for line in plan.splitlines() if "BroadcastHashJoin [row#" in line and "Inner" in line]
    assert joins and not [j for j in joins if "BuildLeft" in j]
