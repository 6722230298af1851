"""Family D: six questions on persons, two of them against incidents.

Persons are cleaned (see ``clean_persons``). Every question summarises the
persons before it joins or labels anything, so person rows never meet a join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfield.functions import fixed_values as fixed
from tallyfield.functions.columns import bucketize, label, mean_of, or_zero, ratio
from tallyfield.operators.dims import attach_dimension
from tallyfield.operators.ranks import group_rank, top_n_per_group
from tallyfield.operators.shares import rate_per


def poverty_by_marital_status(persons: DataFrame) -> DataFrame:
    """D1. Mean poverty ratio by marital status and own children, ranked within the status.

    Codes without a name are one status, "Unknown". The rank is by the exact
    mean, the output is rounded.
    """
    means = (
        persons.filter(F.col("POVPIP").isNotNull())
        .groupBy("MAR", or_zero(F.col("NOP")).alias("NOP"))
        .agg(mean_of(F.col("POVPIP")).alias("mean"))
        .withColumn("Marital_Status", label(F.col("MAR"), fixed.MARITAL_STATUS))
    )
    ranked = group_rank(means, ["Marital_Status"], [F.desc("mean")])
    return ranked.select(
        "Marital_Status", "NOP", F.round("mean", 2).alias("avg_poverty_ratio"), "rank"
    ).orderBy("Marital_Status", "rank")


def poverty_by_group(persons: DataFrame) -> DataFrame:
    """D2. Mean poverty ratio by sex, race and employment, lowest first."""
    return (
        persons.filter(F.col("POVPIP").isNotNull())
        .groupBy(
            label(F.col("SEX"), fixed.SEX).alias("SEX_Label"),
            label(F.col("RAC1P"), fixed.RACE).alias("RAC1P_Label"),
            label(F.col("ESR"), fixed.EMPLOYMENT).alias("ESR_Label"),
        )
        .agg(F.round(mean_of(F.col("POVPIP")), 2).alias("avg_poverty_ratio"))
        .orderBy("avg_poverty_ratio")
    )


def income_by_industry_and_nativity(persons: DataFrame) -> DataFrame:
    """D3. Mean income by industry and nativity, ranked within the industry by rounded mean."""
    means = (
        persons.filter(F.col("PINCP").isNotNull())
        .groupBy(or_zero(F.col("INDP")).alias("INDP"), "NATIVITY")
        .agg(F.round(mean_of(F.col("PINCP")), 2).alias("avg_income"))
    )
    return group_rank(means, ["INDP"], [F.desc("avg_income")]).orderBy("INDP", "rank")


def income_per_hour_by_industry(persons: DataFrame) -> DataFrame:
    """D4. Mean wage over mean weekly hours by industry, for persons with hours."""
    working = F.col("WAGP").isNotNull() & (F.col("WKHP") > 0)
    return (
        persons.filter(working)
        .groupBy(or_zero(F.col("INDP")).alias("INDP"))
        .agg(mean_of(F.col("WAGP")).alias("avg_income"), mean_of(F.col("WKHP")).alias("avg_hours"))
        .withColumn(
            "income_per_hour", F.round(ratio(F.col("avg_income"), F.col("avg_hours")), 2)
        )
        .orderBy(F.desc("income_per_hour"))
    )


def any_word(column: Column, words: Sequence[str]) -> Column:
    """Whether any of the words occurs as it is written, in any case; no word never occurs."""
    text = F.lower(column)
    found = F.lit(False)
    for word in words:
        found = found | text.contains(word.lower())
    return found


def bad_weather_rate_by_age(
    persons: DataFrame,
    accidents: DataFrame,
    states: DataFrame,
    words: Sequence[str] = fixed.BAD_WEATHER_WORDS,
    per: float = 1000,
) -> DataFrame:
    """D5. Bad-weather incidents per 1000 persons by state, age band and condition.

    The incidents of a state are set against every age band of it.
    """
    band = bucketize(F.col("AGEP"), fixed.ACCIDENT_AGE_BANDS, fixed.ACCIDENT_AGE_LAST)
    by_code = (
        persons.filter(F.col("AGEP").isNotNull())
        .groupBy("ST", band.alias("Age_Group"))
        .agg(F.count("*").alias("n"))
    )
    population = (
        attach_dimension(by_code, states, "ST", ["StateAbbr"])
        .groupBy(F.col("StateAbbr").alias("State"), "Age_Group")
        .agg(F.sum("n").alias("population"))
    )
    bad = (
        accidents.filter(any_word(F.col("Weather_Condition"), words))
        .groupBy("State", "Weather_Condition")
        .agg(F.count("*").alias("incidents"))
    )
    return (
        bad.join(population, "State")
        .select(
            "State",
            "Age_Group",
            "Weather_Condition",
            rate_per(F.col("incidents"), F.col("population"), per).alias(
                "Accidents_per_1000_people"
            ),
        )
        .orderBy(F.desc("Accidents_per_1000_people"))
    )


def incident_rate_by_sex(
    persons: DataFrame,
    accidents: DataFrame,
    states: DataFrame,
    top_n: int = 10,
    per: float = 1000,
) -> DataFrame:
    """D6. States with the most incidents per 1000 persons of each sex.

    Incidents carry no sex, so all incidents of a state count for both.
    """
    by_code = (
        persons.filter(F.col("SEX").isNotNull())
        .groupBy("ST", "SEX")
        .agg(F.count("*").alias("population"))
    )
    population = attach_dimension(by_code, states, "ST", ["StateAbbr"]).withColumnRenamed(
        "StateAbbr", "State"
    )
    incidents = (
        accidents.filter(F.col("State").isNotNull())
        .groupBy("State")
        .agg(F.count("*").alias("incidents"))
    )
    rates = incidents.join(population, "State").select(
        "State",
        label(F.col("SEX"), fixed.SEX).alias("Sex_Label"),
        rate_per(F.col("incidents"), F.col("population"), per).alias("Accidents_per_1000"),
    )
    return top_n_per_group(
        rates, ["Sex_Label"], [F.desc("Accidents_per_1000")], top_n, name="Rank"
    ).orderBy("Sex_Label", "Rank")
