"""Registered queries against their SQL, and what their plans must not hold."""

from __future__ import annotations

from pathlib import Path

import pytest
from parity import compare, connect

import __spark_entry__ as driver

SF = "/root/testdata/sf0.001"
SLOW = {"hotel_score_regressors", "star_classifiers", "star_importances", "segment_elbow"}
CHECKED = sorted(driver.oracle_sql())


@pytest.fixture(scope="module")
def con():
    """DuckDB on the smallest tables."""
    if not Path(SF).exists():
        pytest.skip("no test tables here")
    return connect(SF)


@pytest.mark.parametrize("name", CHECKED)
def test_query_matches_sql(spark, con, name):
    ok, note = compare(spark, con, name, SF)
    assert ok, note


@pytest.mark.parametrize("name", sorted(set(driver.queries()) - set(CHECKED) - SLOW))
def test_query_without_sql_gives_rows(spark, con, name):
    assert driver.queries()[name](spark, SF).limit(1).count() == 1


@pytest.mark.parametrize("name", ["hotel_stars", "document_lemmas", "reviews_per_country", "typed_reviews", "price_boxes"])
def test_plans_stay_in_the_jvm_without_cross_joins(spark, con, name):
    plan = driver.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    for node in ("EvalPython", "CartesianProduct", "BroadcastNestedLoopJoin", "MapInPandas"):
        assert node not in plan


def test_entry(spark, con):
    assert driver.entry(spark).count() > 0
    assert set(driver.oracle_sql()) <= set(driver.queries())
