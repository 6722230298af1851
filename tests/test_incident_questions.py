from __future__ import annotations

from conftest import rows_of
from tallyfield.plans import cross, incidents as A


def at(hour, state="TX", day="2024-01-01", **given):
    return {"State": state, "Start_Time": f"{day} {hour:02d}:00:00", **given}


def test_peak_hours_keep_ties_and_null_hours(incidents):
    rows = [at(h) for h, n in ((1, 5), (2, 3), (3, 2), (4, 2)) for _ in range(n)]
    rows += [{"State": "AL", "Start_Time": "bad"}]
    got = A.peak_hours_by_state(incidents(*rows)).collect()
    assert [tuple(r) for r in got[:1]] == [("AL", None, 1, 1)]
    assert sorted(tuple(r)[1:] for r in got[1:]) == [(1, 5, 1), (2, 3, 2), (3, 2, 3), (4, 2, 3)]


def test_weekend_share(incidents):
    days = ("2024-01-06", "2024-01-07", "2024-01-08", "2024-01-08")
    rows = [at(1, day=d) for d in days] + [{"State": None, "Start_Time": None}]
    got = A.weekend_share_by_state(incidents(*rows))
    assert rows_of(got) == [("TX", 50.0), (None, 0.0)]
    assert [r[1] for r in got.collect()] == [50.0, 0.0]


def test_nearby_pairs(incidents):
    df = incidents(
        at(0, ID="A-2", Zipcode="1", Street="S1"),
        at(23, ID="A-10", Zipcode="1", Street="S2"),
        at(1, ID="A-3", Zipcode="1", Street="S2", day="2024-01-03"),
        at(0, ID="A-4", Zipcode=None, Street="S3"),
    )
    got = A.nearby_incident_pairs(df)
    assert got.columns == [
        "Zipcode", "Accident_A_ID", "Accident_A_Street", "Accident_B_ID", "Accident_B_Street",
    ]
    assert rows_of(got) == [("1", "A-10", "S2", "A-2", "S1")]


def test_low_visibility_share(incidents):
    seen = [0.99, 1.0, 4.99, 5.0, None]
    df = incidents(*({"State": "TX", "Visibility(mi)": v, "Severity": 2} for v in seen))
    assert rows_of(A.low_visibility_share_by_state(df)) == [("TX", 25.0)]
    bands = cross.severity_by_visibility(df).select("Visibility_Category", "Accident_Count")
    assert rows_of(bands) == [
        ("High (>5 mi)", 1), ("Low (<1 mi)", 1), ("Moderate (1-5 mi)", 2),
    ]


def test_rain_and_snow(incidents):
    def seen(city, weather, day="2024-01-01"):
        return at(1, day=day, City=city, Weather_Condition=weather)

    df = incidents(
        seen("both", "Light Rain"), seen("both", "Snow"),
        seen("case", "rain"), seen("case", "Snow"),
        seen("days", "Rain"), seen("days", "Snow", "2024-01-02"),
        seen(None, "Rain and Snow"),
        {"City": "no day", "State": None, "Weather_Condition": "Rain and Snow"},
    )
    assert rows_of(A.cities_with_rain_and_snow(df)) == [("both", "TX"), ("no day", None)]


def test_stop_and_signal(incidents):
    df = incidents(*({"Stop": f, "Traffic_Signal": True} for f in (True, False, None)))
    assert rows_of(A.stop_and_signal_counts(df)) == [(1, 3)]


def test_risk_index(incidents):
    df = incidents(*({"State": "TX", "Severity": s} for s in (2, 4)), {"State": None, "Severity": None})
    got = cross.risk_index_by_state(df).collect()
    assert [tuple(r) for r in got] == [("TX", 3.0, 2, 3.0002), (None, None, 1, None)]


def test_top_weather_ranks_null_and_ties(incidents):
    counts = {"Fair": 4, "Fog": 3, None: 3, "Rain": 2, "Snow": 1, "Ice": 1, "Haze": 1}
    df = incidents(
        *({"State": "TX", "Weather_Condition": w} for w, n in counts.items() for _ in range(n))
    )
    got = cross.top_weather_by_state(df).select("Weather_Condition", "Weather_Count", "Weather_Rank")
    assert rows_of(got) == sorted(
        [("Fair", 4, 1), ("Fog", 3, 2), (None, 3, 2), ("Rain", 2, 4), ("Snow", 1, 5), ("Ice", 1, 5),
         ("Haze", 1, 5)],
        key=repr,
    )
