"""Every registered query against its SQL, and the shape of the plans."""

from __future__ import annotations

import re
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as registered
from checks import standins
from conftest import rows_of
from tallyfield.plans import cross, coverage, incidents

SF_DIR = "/root/testdata/sf0.001"
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

# Queries of the subpackage, if it is there, have tests of their own.
APART = set(registered._llm_queries())
QUERIES = [name for name in registered.queries() if name not in APART]

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="test tables not present")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(registered.oracle_sql()) - APART


def test_entry(spark):
    assert registered.entry(spark).count() > 0


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_its_sql(spark, duck, name):
    result = registered.queries()[name](spark, SF_DIR)
    wanted = duck.sql(registered.oracle_sql()[name])
    columns = sorted(result.columns)
    assert columns == sorted(wanted.columns)
    assert rows_of(result.select(*columns)) == sorted(wanted.select(*columns).fetchall(), key=repr)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_summaries_use_no_window(spark):
    for name in ("a2_weekend_share_by_state", "a4_low_visibility_share_by_state", "n9_gender_pay_gap"):
        text = plan(registered.queries()[name](spark, SF_DIR))
        windows = len(re.findall(r"- Window \[", text))
        assert windows == (1 if name.startswith("n9") else 0)


def test_top_n_is_limited_before_the_shuffle(spark):
    for name in ("x5_top_weather_by_state", "a1_peak_hours_by_state", "n7_top_providers_by_state"):
        assert "Partial" in plan(registered.queries()[name](spark, SF_DIR)).split("WindowGroupLimit")[-1]


@pytest.mark.parametrize("name", QUERIES)
def test_no_cross_join(spark, name):
    text = plan(registered.queries()[name](spark, SF_DIR))
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_only_used_columns_are_read(spark):
    text = registered.queries()["n1_average_salary_by_speed"](spark, SF_DIR)
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan(text))
    assert "l_orderkey:bigint,l_extendedprice:double" in schemas


@pytest.mark.parametrize("parts", [1, 3, 17])
def test_result_does_not_depend_on_partitions(spark, parts):
    crashes = standins.incidents(
        spark, SF_DIR, "ID", "State", "Zipcode", "Street", "Start_Time", "Weather_Condition"
    )
    net = standins.coverage(spark, SF_DIR, "StateAbbr", "ProviderName", "MaxAdDown", "Consumer")
    people = standins.persons(spark, SF_DIR, "ST", "AGEP", "PINCP", "ADJINC")
    states = standins.states(spark, SF_DIR)
    for ask, table in (
        (cross.top_weather_by_state, crashes),
        (incidents.nearby_incident_pairs, crashes),
        (lambda d: coverage.top_providers_by_state(d, min_consumer=10), net),
        (lambda d: cross.young_income_rank(d, states), people),
    ):
        assert rows_of(ask(table.repartition(parts))) == rows_of(ask(table))
