"""Every registered query against its SQL twin, and the shape of the plans."""

import re

import pytest

from __spark_entry__ import entry
from driver_queries import all_queries as queries
from driver_queries import all_sql as oracle_sql
from tools.compare import connect, difference

SF = "/root/testdata/sf0.001"
SHAPES = (
    "nearest_cast", "match_casts", "match_grid_window_mean", "bilinear_match", "region_join", "genus_long", "raw_long", "mixed_layer",
    "bray_curtis", "env_fit_test", "factor_fit", "describe_measures", "weekly_slice", "match_irregular_axis", "sample_indices",
)


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(queries()))
def test_matches_sql(spark, duck, name):
    sql = oracle_sql()[name]
    assert difference(queries()[name](spark, SF).toPandas(), duck.execute(sql).df()) == ""


def test_every_query_has_sql():
    assert set(queries()) == set(oracle_sql())


def test_entry(spark):
    assert entry(spark).columns == ["trip", "sp_richness", "sp_shannon", "sp_evenness"]


@pytest.mark.parametrize("name", SHAPES)
def test_no_cartesian_or_nested_loop(spark, name):
    plan = queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin", plan)


def test_filters_and_columns_reach_the_scan(spark):
    plan = queries()["mooring_series"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(user_id)" in plan and "props" not in plan
