from __future__ import annotations

from conftest import rows_of
from pyspark.sql import functions as F
from tallyfield.plans import cross, people as D
from tallyfield.sources.states import state_table


def test_poverty_by_marital_status(persons):
    df = persons(
        {"MAR": 1, "NOP": None, "POVPIP": 100.0},
        {"MAR": 1, "NOP": 0, "POVPIP": 301.0},
        {"MAR": 1, "NOP": 1, "POVPIP": 200.0},
        {"MAR": 7, "NOP": 1, "POVPIP": 50.004},
        {"MAR": 9, "NOP": 1, "POVPIP": 50.001},
        {"MAR": 2, "NOP": 1, "POVPIP": None},
    )
    assert [tuple(r) for r in D.poverty_by_marital_status(df).collect()] == [
        ("Married", 0, 200.5, 1),
        ("Married", 1, 200.0, 2),
        ("Unknown", 1, 50.0, 1),
        ("Unknown", 1, 50.0, 2),
    ]


def test_poverty_by_group(persons):
    df = persons(
        {"SEX": 1, "RAC1P": 4, "ESR": 1.0, "POVPIP": 30.0},
        {"SEX": None, "RAC1P": 8, "ESR": None, "POVPIP": 10.0},
        {"SEX": 5, "RAC1P": 9, "ESR": 7.0, "POVPIP": 11.0},
    )
    assert [tuple(r) for r in D.poverty_by_group(df).collect()] == [
        ("Unknown", "Unknown", "Unknown", 10.5),
        ("Male", "Asian", "Employed - at work", 30.0),
    ]


def test_rounding_makes_ties_in_income_rank(persons):
    df = persons(
        {"INDP": 10.0, "NATIVITY": 1, "PINCP": 10.001},
        {"INDP": 10.0, "NATIVITY": 2, "PINCP": 10.004},
        {"INDP": None, "NATIVITY": 1, "PINCP": 5.0},
    )
    assert rows_of(D.income_by_industry_and_nativity(df)) == [
        (0, 1, 5.0, 1), (10, 1, 10.0, 1), (10, 2, 10.0, 1),
    ]


def test_income_per_hour(persons):
    df = persons(
        {"INDP": 1.0, "WAGP": 100.0, "WKHP": 10.0},
        {"INDP": 1.0, "WAGP": 0.0, "WKHP": 30.0},
        {"INDP": 1.0, "WAGP": 900.0, "WKHP": 0.0},
        {"INDP": 1.0, "WAGP": 900.0, "WKHP": None},
    )
    assert rows_of(D.income_per_hour_by_industry(df)) == [(1, 50.0, 20.0, 2.5)]


def test_bad_weather_rate(spark, persons, incidents):
    people = persons(
        *({"ST": "48", "AGEP": a} for a in (10, 24, 25, 40, 60, None)), {"ST": "72", "AGEP": 30}
    )
    crashes = incidents(
        {"State": "TX", "Weather_Condition": "light SNOW"},
        {"State": "TX", "Weather_Condition": "Fair"},
        {"State": "PR", "Weather_Condition": "Rain"},
    )
    got = D.bad_weather_rate_by_age(people, crashes, state_table(spark, territories=False))
    assert rows_of(got) == [
        ("TX", "18-24", "light SNOW", 500.0),
        ("TX", "25-39", "light SNOW", 1000.0),
        ("TX", "40-59", "light SNOW", 1000.0),
        ("TX", "60+", "light SNOW", 1000.0),
    ]


def test_incident_rate_by_sex(spark, persons, incidents):
    people = persons(
        {"ST": "48", "SEX": 1}, {"ST": "48", "SEX": 1}, {"ST": "48", "SEX": 3}, {"ST": "01", "SEX": 1}
    )
    crashes = incidents({"State": "TX"}, {"State": None}, {"State": "AL"}, {"State": "AL"})
    got = D.incident_rate_by_sex(people, crashes, state_table(spark, territories=False))
    assert [tuple(r) for r in got.collect()] == [
        ("AL", "Male", 2000.0, 1), ("TX", "Male", 500.0, 2), ("TX", "Unknown", 1000.0, 1),
    ]
    one = D.incident_rate_by_sex(people, crashes, state_table(spark), top_n=1)
    assert rows_of(one.select("State", "Sex_Label")) == [("AL", "Male"), ("TX", "Unknown")]


def test_education_and_severity(states, persons, incidents):
    people = persons({"ST": "48", "SCHL": 20.0}, {"ST": "48", "SCHL": 21.0}, {"ST": "99", "SCHL": 1.0})
    crashes = incidents({"State": "TX", "Severity": 2}, {"State": "TX", "Severity": 3}, {"State": "ZZ"})
    assert rows_of(cross.education_and_severity(people, crashes, states)) == [("TX", 20.5, 2.5)]


def test_long_hours_is_strict(states, persons, incidents):
    people = persons(
        {"ST": "48", "WKHP": 30.0}, {"ST": "48", "WKHP": 40.0}, {"ST": "01", "WKHP": 36.0}
    )
    crashes = incidents({"State": "TX"}, {"State": "AL"}, {"State": "AL"})
    assert rows_of(cross.long_hours_and_incidents(people, crashes, states)) == [("AL", 2, 36.0)]


def test_young_income_rank(states, persons):
    def person(age, income, state="48"):
        return {"ST": state, "AGEP": age, "PINCP": income, "ADJINC": 1_100_000}

    df = persons(
        person(39, 1000.0), person(40, 9000.0), person(20, None), person(21, 2000.0),
        person(22, 1000.0), person(None, 5.0), person(30, 7.0, "01"),
    )
    assert rows_of(cross.young_income_rank(df, states)) == sorted(
        [("TX", 21, 2200.0, 1), ("TX", 39, 1100.0, 2), ("TX", 22, 1100.0, 2), ("TX", 20, None, 4),
         ("AL", 30, 7.7, 1)],
        key=repr,
    )


def test_any_word_takes_words_as_written(frame):
    rows = frame([("Snow (heavy)",), ("snow heavy",), ("a.b",), ("axb",), (None,)], "c string")
    found = rows.select("c", D.any_word(F.col("c"), ["SNOW (HEAVY)", "A.B"]).alias("hit"), D.any_word(F.col("c"), []).alias("none"))
    assert [r["hit"] for r in found.collect()] == [True, False, True, False, None]
    assert not any(r["none"] for r in found.collect())
