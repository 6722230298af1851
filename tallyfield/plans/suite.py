"""The thirty questions by id, and running them together."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from tallyfield.operators.stats import numeric_columns, preview, profile, sizes
from tallyfield.plans import coverage, cross, incidents, people
from tallyfield.sources.states import state_table


class Question(NamedTuple):
    """A question function and the inputs it takes, in order."""

    answer: Callable[..., DataFrame]
    inputs: tuple[str, ...]


PERSONS, INCIDENTS, COVERAGE = "demographics", "accidents", "internet"
# 51 states, 52 with the territory, and the table used against incidents.
STATES, ALL_STATES, FILE_STATES = "states", "all_states", "file_states"
DATASETS = (PERSONS, INCIDENTS, COVERAGE)

QUESTIONS: dict[str, Question] = {
    "A1": Question(incidents.peak_hours_by_state, (INCIDENTS,)),
    "A2": Question(incidents.weekend_share_by_state, (INCIDENTS,)),
    "A3": Question(incidents.nearby_incident_pairs, (INCIDENTS,)),
    "A4": Question(incidents.low_visibility_share_by_state, (INCIDENTS,)),
    "A5": Question(incidents.cities_with_rain_and_snow, (INCIDENTS,)),
    "A6": Question(incidents.stop_and_signal_counts, (INCIDENTS,)),
    "D1": Question(people.poverty_by_marital_status, (PERSONS,)),
    "D2": Question(people.poverty_by_group, (PERSONS,)),
    "D3": Question(people.income_by_industry_and_nativity, (PERSONS,)),
    "D4": Question(people.income_per_hour_by_industry, (PERSONS,)),
    "D5": Question(people.bad_weather_rate_by_age, (PERSONS, INCIDENTS, STATES)),
    "D6": Question(people.incident_rate_by_sex, (PERSONS, INCIDENTS, STATES)),
    "X1": Question(cross.severity_by_visibility, (INCIDENTS,)),
    "X2": Question(cross.risk_index_by_state, (INCIDENTS,)),
    "X3": Question(cross.education_and_severity, (PERSONS, INCIDENTS, FILE_STATES)),
    "X4": Question(cross.long_hours_and_incidents, (PERSONS, INCIDENTS, FILE_STATES)),
    "X5": Question(cross.top_weather_by_state, (INCIDENTS,)),
    "X6": Question(cross.young_income_rank, (PERSONS, FILE_STATES)),
    "N1": Question(coverage.average_salary_by_speed, (PERSONS, COVERAGE, ALL_STATES)),
    "N2": Question(coverage.top_professions_by_education, (PERSONS,)),
    "N3": Question(coverage.commute_time_by_business_coverage, (PERSONS, COVERAGE, ALL_STATES)),
    "N4": Question(coverage.income_against_peers, (PERSONS,)),
    "N5": Question(coverage.providers_and_income, (PERSONS, COVERAGE, ALL_STATES)),
    "N6": Question(coverage.income_and_speed_gaps, (PERSONS, COVERAGE, ALL_STATES)),
    "N7": Question(coverage.top_providers_by_state, (COVERAGE,)),
    "N8": Question(coverage.digital_resilience_index, (PERSONS, COVERAGE, ALL_STATES)),
    "N9": Question(coverage.gender_pay_gap, (PERSONS, COVERAGE, ALL_STATES)),
    "N10": Question(coverage.provider_national_champions, (COVERAGE,)),
    "N11": Question(coverage.subthreshold_pool_by_provider, (COVERAGE,)),
    "N12": Question(coverage.affordability_gap_states, (COVERAGE, PERSONS, ALL_STATES)),
}


def run_all(
    spark: SparkSession,
    tables: Mapping[str, DataFrame],
    file_states: DataFrame | None = None,
    questions: Iterable[str] = QUESTIONS,
) -> dict[str, DataFrame]:
    """Plan the questions on cleaned tables; nothing runs until a result is used.

    ``file_states`` replaces the built-in state table for the X family. Raises
    if a data set that a question needs is missing.
    """
    inputs = {
        **tables,
        STATES: state_table(spark, territories=False),
        ALL_STATES: state_table(spark),
        FILE_STATES: state_table(spark) if file_states is None else file_states,
    }
    chosen = {name: QUESTIONS[name] for name in questions}
    missing = sorted({i for q in chosen.values() for i in q.inputs if inputs.get(i) is None})
    if missing:
        raise ValueError(f"missing data sets: {', '.join(missing)}")
    return {name: q.answer(*(inputs[i] for i in q.inputs)) for name, q in chosen.items()}


def preview_all(tables: Mapping[str, DataFrame], columns: int = 10, rows: int = 5) -> dict[str, DataFrame]:
    """The first columns of a few rows of the three main data sets."""
    return {name: preview(tables[name], columns, rows) for name in DATASETS if name in tables}


def preview_profiles(tables: Mapping[str, DataFrame], columns: int = 5) -> dict[str, DataFrame]:
    """Profiles of the first numeric columns only, in schema order; no others are read."""
    first = {name: numeric_columns(tables[name])[:columns] for name in DATASETS if name in tables}
    return {name: profile(tables[name], names) for name, names in first.items()}


def describe_all(tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Plan the sizes of all data sets and the numeric profile of the three main ones."""
    profiles = {f"{name}_stats": profile(tables[name]) for name in DATASETS if name in tables}
    return {"sizes": sizes(tables), **profiles}
