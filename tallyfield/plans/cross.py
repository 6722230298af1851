"""Family X: six questions on incidents against persons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfield.functions import fixed_values as fixed
from tallyfield.functions.columns import bucketize, mean_of, ratio
from tallyfield.operators.dims import attach_dimension
from tallyfield.operators.ranks import rank_rows, top_n_per_group


def severity_by_visibility(accidents: DataFrame) -> DataFrame:
    """X1. Mean severity and count by visibility band, for incidents that report one."""
    visibility = F.col("Visibility(mi)")
    band = bucketize(visibility, fixed.VISIBILITY_BANDS, fixed.VISIBILITY_LAST)
    return (
        accidents.filter(visibility.isNotNull())
        .groupBy(band.alias("Visibility_Category"))
        .agg(*_severity_and_count())
        .orderBy(F.desc("Avg_Severity"))
    )


def risk_index_by_state(accidents: DataFrame, divisor: float = 10_000) -> DataFrame:
    """X2. Mean severity plus the count over ``divisor``, per state."""
    frequency = ratio(F.col("Accident_Count"), F.lit(divisor))
    return (
        accidents.groupBy("State")
        .agg(*_severity_and_count())
        .withColumn("Risk_Index", F.col("Avg_Severity") + frequency)
        .orderBy(F.desc("Risk_Index"))
    )


def education_and_severity(
    persons: DataFrame, accidents: DataFrame, states: DataFrame
) -> DataFrame:
    """X3. Mean education code of the persons and mean severity of the incidents, per state."""
    education = _mean_by_state(persons, states, "SCHL", "Avg_Education")
    severity = accidents.groupBy("State").agg(mean_of(F.col("Severity")).alias("Avg_Severity"))
    return severity.join(education, "State").select("State", "Avg_Education", "Avg_Severity")


def long_hours_and_incidents(
    persons: DataFrame, accidents: DataFrame, states: DataFrame, min_hours: float = 35
) -> DataFrame:
    """X4. Incidents and mean weekly hours of the states where the mean exceeds ``min_hours``."""
    hours = _mean_by_state(persons, states, "WKHP", "Avg_Work_Hours")
    busy = hours.filter(F.col("Avg_Work_Hours") > min_hours)
    incidents = accidents.groupBy("State").agg(F.count("*").alias("Total_Accidents"))
    return incidents.join(busy, "State").select("State", "Total_Accidents", "Avg_Work_Hours")


def top_weather_by_state(accidents: DataFrame, top_n: int = 5) -> DataFrame:
    """X5. Most frequent weather conditions of each state; ties share a rank."""
    counts = accidents.groupBy("State", "Weather_Condition").agg(
        F.count("*").alias("Weather_Count")
    )
    return top_n_per_group(
        counts, ["State"], [F.desc("Weather_Count")], top_n, name="Weather_Rank"
    )


def young_income_rank(persons: DataFrame, states: DataFrame, below_age: int = 40) -> DataFrame:
    """X6. Persons below an age ranked by inflation-adjusted income within their state.

    One row per person; without income the rank is last.
    """
    adjusted = F.col("PINCP").cast("double") * F.col("ADJINC").cast("double") / 1_000_000
    young = persons.filter(F.col("AGEP") < below_age).select(
        "ST", "AGEP", adjusted.alias("Adjusted_Income")
    )
    named = attach_dimension(young, states, "ST", ["StateAbbr"]).drop("ST")
    return rank_rows(named, ["StateAbbr"], "Adjusted_Income", name="Income_Rank_in_State").select(
        "StateAbbr", "AGEP", "Adjusted_Income", "Income_Rank_in_State"
    )


def _severity_and_count() -> tuple[Column, Column]:
    return (
        mean_of(F.col("Severity")).alias("Avg_Severity"),
        F.count("*").alias("Accident_Count"),
    )


def _mean_by_state(
    persons: DataFrame, states: DataFrame, column: str, name: str
) -> DataFrame:
    """Mean per abbreviation; persons are summed per code before the state join."""
    sums = persons.groupBy("ST").agg(
        F.sum(column).alias("total"), F.count(column).alias("known")
    )
    return (
        attach_dimension(sums, states, "ST", ["StateAbbr"])
        .groupBy(F.col("StateAbbr").alias("State"))
        .agg(ratio(F.sum("total"), F.sum("known")).alias(name))
    )
