from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tallyfield.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = get_session(
        "tests",
        "local[8]",
        **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """Build a frame from tuples and a DDL schema."""

    def build(rows, schema):
        return spark.createDataFrame(rows, schema)

    return build


@pytest.fixture
def persons(spark):
    """Build persons from keyword dicts; what is not given is NULL."""
    schema = (
        "SERIALNO string, ST string, AGEP int, SEX int, MAR int, NOP int, RAC1P int, ESR float, "
        "NATIVITY int, INDP float, OCCP string, SCHL float, PINCP double, POVPIP double, "
        "WAGP float, WKHP float, JWMNP float, WRK float, ADJINC int"
    )
    names = [part.split()[0] for part in schema.split(", ")]

    def build(*rows):
        return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema)

    return build


@pytest.fixture
def incidents(spark):
    """Build cleaned incidents; times are given as text."""
    from tallyfield.functions.columns import parse_time

    schema = (
        "ID string, Severity int, Start_Time string, Street string, City string, State string, "
        "Zipcode string, `Visibility(mi)` float, Weather_Condition string, Stop boolean, "
        "Traffic_Signal boolean"
    )
    names = [part.split()[0].strip("`") for part in schema.split(", ")]

    def build(*rows):
        raw = spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema)
        return parse_time(raw, ["Start_Time"])

    return build


@pytest.fixture
def internet(spark):
    """Build coverage rows of state, provider, consumer, speed, business."""
    schema = (
        "StateAbbr string, ProviderName string, Consumer int, MaxAdDown float, Business int"
    )

    def build(*rows):
        return spark.createDataFrame(list(rows), schema)

    return build


@pytest.fixture
def states(spark):
    from tallyfield.sources.states import state_table

    return state_table(spark)


def rows_of(df):
    """Rows as tuples, in a stable order."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
