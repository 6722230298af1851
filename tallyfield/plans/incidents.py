"""Family A: six questions on incidents. Times are timestamps (see ``clean_incidents``)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfield.operators.pairs import co_occurrence, near_pairs
from tallyfield.operators.ranks import top_n_per_group
from tallyfield.operators.shares import conditional_ratio, count_conditions

DAY_SECONDS = 24 * 60 * 60
VISIBILITY = "Visibility(mi)"


def peak_hours_by_state(accidents: DataFrame, top_n: int = 3) -> DataFrame:
    """A1. Hours of the day with the most incidents in each state; ties share a rank."""
    hourly = accidents.groupBy("State", F.hour("Start_Time").alias("Hour")).agg(
        F.count("*").alias("incident_count")
    )
    top = top_n_per_group(hourly, ["State"], [F.desc("incident_count")], top_n)
    return top.orderBy("State", "rank")


def weekend_share_by_state(accidents: DataFrame, days: Sequence[int] = (1, 7)) -> DataFrame:
    """A2. Percentage of incidents on weekend days (Sunday is 1); no time counts as weekday."""
    weekend = F.dayofweek("Start_Time").isin(*days)
    return conditional_ratio(
        accidents, ["State"], weekend, "weekend_percentage", scale=100
    ).orderBy(F.desc("weekend_percentage"))


def nearby_incident_pairs(accidents: DataFrame, max_gap: int = DAY_SECONDS) -> DataFrame:
    """A3. Pairs in one zip code on different streets, less than ``max_gap`` seconds apart."""
    pairs = near_pairs(
        accidents, "Zipcode", "Street", "ID", F.unix_timestamp("Start_Time"), max_gap
    )
    return pairs.select(
        F.col("key").alias("Zipcode"),
        F.col("id_a").alias("Accident_A_ID"),
        F.col("differ_a").alias("Accident_A_Street"),
        F.col("id_b").alias("Accident_B_ID"),
        F.col("differ_b").alias("Accident_B_Street"),
    )


def low_visibility_share_by_state(accidents: DataFrame, below: float = 1.0) -> DataFrame:
    """A4. Percentage of incidents below a visibility, among those that report one."""
    seen = accidents.filter(F.col(VISIBILITY).isNotNull())
    return conditional_ratio(
        seen, ["State"], F.col(VISIBILITY) < below, "low_visibility_percentage", scale=100
    ).orderBy(F.desc("low_visibility_percentage"))


def cities_with_rain_and_snow(
    accidents: DataFrame, first: str = "Rain", second: str = "Snow"
) -> DataFrame:
    """A5. Cities with a calendar day on which both words occur in weather conditions."""
    weather = F.col("Weather_Condition")
    return co_occurrence(
        accidents.filter(F.col("City").isNotNull()),
        ["City", "State"],
        {"day": F.to_date("Start_Time")},
        [weather.contains(first), weather.contains(second)],
    )


def stop_and_signal_counts(accidents: DataFrame) -> DataFrame:
    """A6. Incidents at a stop sign and incidents at a traffic signal."""
    return count_conditions(
        accidents,
        {
            "stop_sign_accidents": F.col("Stop"),
            "traffic_signal_accidents": F.col("Traffic_Signal"),
        },
    )
