from __future__ import annotations

import math

import pytest

from conftest import rows_of
from tallyfield.plans import coverage as N


def test_salary_by_speed_is_strict_and_null_is_slow(states, persons, internet):
    net = internet(
        ("TX", "P", 1, 100.0, 0), ("AL", "P", 1, None, 0), ("CA", "P", 1, 100.5, 0), ("ZZ", "P", 1, 9.0, 0)
    )
    people = persons(
        {"ST": "48", "WAGP": 10.0}, {"ST": "48", "WAGP": 20.0}, {"ST": "01", "WAGP": 60.0},
        {"ST": "06", "WAGP": 7.0}, {"ST": "06", "WAGP": 0.0}, {"ST": "06", "WAGP": None},
        {"ST": "02", "WAGP": 99.0},
    )
    assert rows_of(N.average_salary_by_speed(people, net, states)) == [
        ("fast_internet", 7.0), ("slow_internet", 30.0),
    ]


def test_top_professions(persons):
    rows = [(1.0, "a", 10.0), (1.0, "b", 30.0), (1.0, "c", 20.0), (1.0, "d", 10.0), (1.0, None, 99.0),
            (1.0, "e", 0.0), (None, "a", 5.0)]
    df = persons(*({"SCHL": s, "OCCP": o, "PINCP": p} for s, o, p in rows))
    assert rows_of(N.top_professions_by_education(df)) == sorted(
        [(1.0, "b", 30.0, 1), (1.0, "c", 20.0, 2), (1.0, "a", 10.0, 3), (1.0, "d", 10.0, 3),
         (None, "a", 5.0, 1)],
        key=repr,
    )
    assert N.top_professions_by_education(df, top_n=1).count() == 2


def test_commute_time(states, persons, internet):
    net = internet(("TX", "P", 1, 1.0, 1), ("TX", "P", 1, 1.0, 0), ("AL", "P", 1, 1.0, 1))
    people = persons(
        {"ST": "48", "WRK": 1.0, "JWMNP": 20.0}, {"ST": "48", "WRK": 2.0, "JWMNP": 90.0},
        {"ST": "48", "WRK": 1.0, "JWMNP": 0.0}, {"ST": "01", "WRK": 1.0, "JWMNP": 40.0},
    )
    assert rows_of(N.commute_time_by_business_coverage(people, net, states)) == [
        ("high_biz_internet", 40.0), ("low_biz_internet", 20.0),
    ]


def test_income_against_peers(persons):
    rows = [(17, 5.0), (18, 10.0), (25, 20.0), (26, 7.0), (56, 3.0), (None, 9.0), (30, 0.0)]
    df = persons(*({"SERIALNO": str(a), "ST": "48", "AGEP": a, "PINCP": p} for a, p in rows),
                 {"SERIALNO": "x", "ST": None, "AGEP": 20, "PINCP": 4.0})
    got = N.income_against_peers(df)
    assert got.columns == [
        "SERIALNO", "ST", "age_group", "PINCP", "avg_group_income", "income_deviation",
    ]
    assert rows_of(got) == [
        ("18", "48", "18-25", 10.0, 15.0, -5.0), ("25", "48", "18-25", 20.0, 15.0, 5.0),
        ("26", "48", "26-35", 7.0, 7.0, 0.0), ("56", "48", "56+", 3.0, 3.0, 0.0),
        ("x", None, "18-25", 4.0, 4.0, 0.0),
    ]
    ordered = [r["income_deviation"] for r in N.income_against_peers(df, ordered=True).collect()]
    assert ordered == sorted(ordered, reverse=True)


def test_providers_and_income(states, persons, internet):
    net = internet(*(("TX", p, 1, 1.0, 0) for p in ("P", "P", "Q", None)))
    people = persons({"ST": "48", "PINCP": 10.0}, {"ST": "48", "PINCP": -4.0}, {"ST": "01", "PINCP": 4.0})
    assert rows_of(N.providers_and_income(people, net, states)) == [("48", "TX", 10.0, 2)]


def test_income_and_speed_gaps(states, persons, internet):
    net = internet(*(("TX", "P", 1, float(v), 0) for v in range(0, 21, 2)))
    people = persons(*({"ST": "48", "PINCP": float(v)} for v in range(1, 11)))
    assert rows_of(N.income_and_speed_gaps(people, net, states)) == [("TX", "48", 8.0, 16.0)]


def test_top_providers(internet):
    net = internet(
        ("TX", "slow", 300, 10.0, 0), ("TX", "fast", 300, 90.0, 0), ("TX", "mid", 350, 5.0, 0),
        ("TX", "tiny", 50, 5.0, 0), ("AL", "a", 100, 1.0, 0), ("AL", "b", 100, 1.0, 0),
        (None, "x", 900, 1.0, 0),
    )
    got = [tuple(r) for r in N.top_providers_by_state(net).collect()]
    assert [r[:2] + r[5:6] for r in got] == [
        ("AL", "a", 1), ("AL", "b", 2), ("TX", "mid", 1), ("TX", "fast", 2), ("TX", "slow", 3),
    ]
    assert [r[4] for r in got] == [0.5, 0.5, 0.35, 0.3, 0.3]
    assert [round(r[6], 9) for r in got] == [0.5, 1.0, 0.35, 0.65, 0.95]
    assert N.top_providers_by_state(net, min_share=0.32).count() == 3


def test_resilience_index(states, persons, internet):
    net = internet(("TX", "P", 1, 100.0, 0), ("AL", "P", 1, 50.0, 0), ("CA", "P", 1, 70.0, 0))

    def adult(state, wage, school, age=30):
        return {"ST": state, "AGEP": age, "WAGP": wage, "SCHL": school}

    people = persons(
        adult("48", 10.0, 22.0), adult("48", 0.0, None), adult("01", 10.0, 20.0),
        adult("01", 10.0, 21.0), adult("01", 99.0, 1.0, age=65), adult("06", 0.0, 1.0),
    )
    assert rows_of(N.digital_resilience_index(people, net, states)) == [
        ("AL", 50.0, 10.0, 0.5, 0.15, 2), ("TX", 100.0, 10.0, 0.0, 0.8500000000000001, 1),
    ]


def test_gender_pay_gap(states, persons, internet):
    net = internet(("TX", "P", 1, 200.0, 0), ("AL", "P", 1, 200.0, 0), ("CA", "P", 1, 100.0, 0))

    def earner(state, sex, wage, age=30):
        return {"ST": state, "SEX": sex, "WAGP": wage, "AGEP": age}

    people = persons(
        earner("48", 1, 30.0), earner("48", 2, 20.0), earner("48", 3, 500.0),
        earner("48", 1, 900.0, age=70), earner("01", 1, 5.0), earner("01", 1, 7.0),
        earner("06", 1, 9.0),
    )
    got = N.gender_pay_gap(people, net, states, min_group_size=2)
    assert [tuple(r) for r in got.collect()] == [
        ("TX", "fast_internet", 30.0, 20.0, 10.0, 2, 1),
        ("AL", "fast_internet", 6.0, None, None, 2, 2),
    ]
    everyone = N.gender_pay_gap(people, net, states, min_group_size=3, restrict_age_25_64=False)
    assert rows_of(everyone.select("StateAbbr", "male_avg", "total_n")) == [("TX", 465.0, 3)]
    assert N.gender_pay_gap(people, net, states).collect() == []


def test_champions(internet):
    net = internet(
        ("TX", "P", 5, 1.0, 0), ("TX", "Q", 5, 1.0, 0), ("AL", "P", 9, 1.0, 0), ("AL", "R", 1, 1.0, 0),
        ("CA", "S", 29, 1.0, 0), *(("CA", f"c{i}", 1, 1.0, 0) for i in range(71)),
        ("NY", "S", 30, 1.0, 0), *(("NY", f"c{i}", 1, 1.0, 0) for i in range(70)),
    )
    got = N.provider_national_champions(net).collect()
    assert [(r[0], r[1], round(r[2], 9), r[3]) for r in got] == [
        ("P", 2, 0.7, ["AL", "TX"]), ("Q", 1, 0.5, ["TX"]), ("S", 1, 0.3, ["NY"]),
    ]


def test_subthreshold_pool(internet):
    net = internet(
        ("TX", "P", 10, 50.0, 0), ("TX", "P", 10, 150.0, 0), ("TX", "Q", 10, 99.0, 0),
        ("TX", "Q", 10, None, 0), ("TX", "zero", 0, 1.0, 0), ("TX", "small", 1, 1.0, 0),
    )
    got = N.subthreshold_pool_by_provider(net)
    assert rows_of(got) == [
        ("TX", "P", 10, 20, 0.5, 20 / 41, 1), ("TX", "Q", 10, 20, 0.5, 20 / 41, 1),
    ]


def test_affordability_gap(states, persons, internet):
    speeds = {"AL": 50.0, "CA": 100.0, "TX": 150.0}
    net = internet(*((s, "P", 1, v, 0) for s, v in speeds.items()))
    people = persons(
        {"ST": "48", "AGEP": 30, "WAGP": 10.0}, {"ST": "48", "AGEP": 70, "WAGP": 99.0},
        {"ST": "06", "AGEP": 30, "WAGP": 20.0}, {"ST": "01", "AGEP": 30, "WAGP": 30.0},
    )
    got = N.affordability_gap_states(net, people, states)
    assert rows_of(got) == [("TX", 150.0, 10.0, 1, pytest.approx(0.5 * math.log(2)), 1)]
    assert N.affordability_gap_states(net, people.filter("AGEP > 90"), states).collect() == []
    every = N.affordability_gap_states(net, people, states, restrict_age_25_64=False)
    assert [r["adult_pop"] for r in every.collect()] == [2]
