"""Family N: twelve questions on broadband coverage, most of them against persons.

``states`` maps ``ST`` to ``StateAbbr`` one to one. Persons and coverage rows are
summarised per state before they are joined, so every join in here has at most
one row per state and side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfield.functions import fixed_values as fixed
from tallyfield.functions.columns import bucketize, mean_of, ratio, tier
from tallyfield.operators.dims import attach_dimension
from tallyfield.operators.quantiles import exact_quantiles
from tallyfield.operators.ranks import group_rank, top_n_per_group
from tallyfield.operators.shares import leaders_summary, running_share, share_of_parent
from tallyfield.operators.stats import (
    category_gap,
    deviation_from_peers,
    low_share,
    median_screen,
    min_max_normalise,
    percentile_gap,
    weighted_sum,
)

FAST, SLOW = "fast_internet", "slow_internet"
HIGH_BUSINESS, LOW_BUSINESS = "high_biz_internet", "low_biz_internet"
WORKING_AGE = (25, 64)
BACHELOR = 21
# State codes times age bands; far more than the code lists have, so that unknown codes fit too.
MAX_PEER_GROUPS = 10_000


def average_salary_by_speed(
    demographics: DataFrame, internet: DataFrame, states: DataFrame, speed_threshold: float = 100
) -> DataFrame:
    """N1. Mean wage of earners in states with fast and with slow mean download speed."""
    tiers = _state_tiers(internet, states, "MaxAdDown", speed_threshold, (FAST, SLOW))
    earners = demographics.filter(F.col("WAGP") > 0)
    return _mean_by_tier(earners, tiers, "WAGP", "speed_tier", "average_salary")


def top_professions_by_education(demographics: DataFrame, top_n: int = 3) -> DataFrame:
    """N2. Occupations with the highest mean income within each education code."""
    means = (
        demographics.filter((F.col("PINCP") > 0) & F.col("OCCP").isNotNull())
        .groupBy("SCHL", "OCCP")
        .agg(mean_of(F.col("PINCP")).alias("avg_income"))
    )
    return top_n_per_group(means, ["SCHL"], [F.desc("avg_income")], top_n)


def commute_time_by_business_coverage(
    demographics: DataFrame, internet: DataFrame, states: DataFrame, biz_threshold: float = 0.5
) -> DataFrame:
    """N3. Mean commute of workers in states with high and with low business coverage."""
    tiers = _state_tiers(
        internet, states, "Business", biz_threshold, (HIGH_BUSINESS, LOW_BUSINESS)
    )
    commuters = demographics.filter((F.col("WRK") == 1) & (F.col("JWMNP") > 0))
    return _mean_by_tier(commuters, tiers, "JWMNP", "internet_tier", "average_commute_time")


def income_against_peers(demographics: DataFrame, ordered: bool = False) -> DataFrame:
    """N4. Income of every adult earner minus the mean of state and age group.

    One row per person, so the global sort by deviation is done only if asked for.
    """
    group = bucketize(F.col("AGEP"), fixed.PEER_AGE_BANDS, fixed.PEER_AGE_LAST)
    adults = demographics.filter(
        (F.col("PINCP") > 0) & (F.col("AGEP") >= fixed.PEER_AGE_BANDS[0][0])
    ).select("SERIALNO", "ST", group.alias("age_group"), "PINCP")
    result = deviation_from_peers(
        adults, ["ST", "age_group"], "PINCP", "avg_group_income", "income_deviation", MAX_PEER_GROUPS
    )
    return result.orderBy(F.desc("income_deviation")) if ordered else result


def providers_and_income(
    demographics: DataFrame, internet: DataFrame, states: DataFrame
) -> DataFrame:
    """N5. Mean income and number of distinct providers per state."""
    income = (
        demographics.filter(F.col("PINCP") > 0)
        .groupBy("ST")
        .agg(mean_of(F.col("PINCP")).alias("avg_income"))
    )
    providers = internet.groupBy("StateAbbr").agg(
        F.countDistinct("ProviderName").alias("provider_count")
    )
    return (
        _with_code(providers, states)
        .join(income, "ST")
        .select("ST", "StateAbbr", "avg_income", "provider_count")
        .orderBy(F.desc("avg_income"))
    )


def income_and_speed_gaps(
    demographics: DataFrame, internet: DataFrame, states: DataFrame
) -> DataFrame:
    """N6. Distance of the 90th from the 10th percentile of income and of speed per state."""
    income = percentile_gap(demographics, ["ST"], "PINCP", "income_gap")
    speed = percentile_gap(internet, ["StateAbbr"], "MaxAdDown", "speed_gap")
    return (
        _with_code(speed, states)
        .join(income, "ST")
        .select("StateAbbr", "ST", "income_gap", "speed_gap")
        .orderBy(F.desc("income_gap"))
    )


def top_providers_by_state(
    internet: DataFrame, min_consumer: int = 100, min_share: float = 0.0, top_n: int = 3
) -> DataFrame:
    """N7. Providers with the largest consumer share per state, with the running share.

    Shares are of all consumers of the state, also those of providers too small
    to be listed. Equal shares go by mean speed, then by name.
    """
    providers = internet.groupBy("StateAbbr", "ProviderName").agg(
        mean_of(F.col("MaxAdDown")).alias("avg_down_mbps"), F.sum("Consumer").alias("consumers")
    )
    shares = share_of_parent(providers, "StateAbbr", "consumers").filter(
        F.col("consumers") >= min_consumer
    )
    if min_share > 0:
        shares = shares.filter(F.col("share") >= min_share)
    order = [F.desc("share"), F.desc("avg_down_mbps"), F.asc("ProviderName")]
    top = top_n_per_group(shares, ["StateAbbr"], order, top_n, "row_number", "rank_in_state")
    return running_share(top, ["StateAbbr"], "rank_in_state", "share").select(
        "StateAbbr",
        "ProviderName",
        "avg_down_mbps",
        "consumers",
        "share",
        "rank_in_state",
        "cumulative_share",
    ).orderBy("StateAbbr", "rank_in_state")


def digital_resilience_index(
    demographics: DataFrame,
    internet: DataFrame,
    states: DataFrame,
    weights: tuple[float, float, float] = (0.4, 0.3, 0.3),
) -> DataFrame:
    """N8. Index of speed, median wage and education at working age, ranked over the states."""
    speed = internet.groupBy("StateAbbr").agg(mean_of(F.col("MaxAdDown")).alias("avg_speed"))
    wage = F.when(F.col("WAGP") > 0, F.col("WAGP"))
    working = demographics.filter(_working_age()).select("ST", "SCHL", wage.alias("wage"))
    # Education comes with the first pass over the wages; a state without any wage drops out.
    education = low_share(F.col("SCHL"), BACHELOR).alias("low_edu_share")
    people = exact_quantiles(working, ["ST"], "wage", {"median_income": 0.5}, [education]).filter(
        F.col("median_income").isNotNull()
    )
    measures = ["avg_speed", "median_income", "low_edu_share"]
    base = _with_code(speed, states).join(people, "ST").select("StateAbbr", *measures)
    by_speed, by_income, by_education = weights
    index = weighted_sum(
        [
            (by_speed, F.col("avg_speed_norm")),
            (by_income, F.col("median_income_norm")),
            (by_education, 1 - F.col("low_edu_share_norm")),
        ]
    )
    scored = min_max_normalise(base, measures).withColumn("digital_resilience_index", index)
    return group_rank(scored, [], [F.desc("digital_resilience_index")], "dense_rank").select(
        "StateAbbr", *measures, "digital_resilience_index", "rank"
    )


def gender_pay_gap(
    demographics: DataFrame,
    internet: DataFrame,
    states: DataFrame,
    speed_threshold: float = 100,
    min_group_size: int = 500,
    restrict_age_25_64: bool = True,
) -> DataFrame:
    """N9. Male minus female mean wage per state, ranked within the speed tier."""
    tiers = _state_tiers(internet, states, "MaxAdDown", speed_threshold, (FAST, SLOW))
    earners = demographics.filter(F.col("WAGP") > 0)
    if restrict_age_25_64:
        earners = earners.filter(_working_age())
    gaps = category_gap(
        earners, ["ST"], "SEX", 1, 2, "WAGP", ("male_avg", "female_avg", "gender_gap", "total_n")
    ).filter(F.col("total_n") >= min_group_size)
    tiered = gaps.join(tiers.withColumnRenamed("tier", "speed_tier"), "ST")
    return (
        group_rank(
            tiered, ["speed_tier"], [F.desc_nulls_last("gender_gap")], "dense_rank", "rank_in_tier"
        )
        .select(
            "StateAbbr",
            "speed_tier",
            "male_avg",
            "female_avg",
            "gender_gap",
            "total_n",
            "rank_in_tier",
        )
        .orderBy("speed_tier", "rank_in_tier")
    )


def provider_national_champions(internet: DataFrame, min_share: float = 0.3) -> DataFrame:
    """N10. Providers that lead the most states with at least ``min_share`` there."""
    consumers = internet.groupBy("StateAbbr", "ProviderName").agg(
        F.sum("Consumer").alias("consumers")
    )
    shares = share_of_parent(consumers, "StateAbbr", "consumers")
    leaders = top_n_per_group(shares, ["StateAbbr"], [F.desc("share")], 1, "dense_rank").filter(
        F.col("share") >= min_share
    )
    return (
        leaders_summary(leaders, "ProviderName", "StateAbbr", "share")
        .select(
            "ProviderName",
            F.col("places_led").alias("states_as_no1"),
            F.col("mean_share").alias("avg_top_share"),
            F.col("places").alias("states_list"),
        )
        .orderBy(F.desc("states_as_no1"), F.desc("avg_top_share"))
    )


def subthreshold_pool_by_provider(
    internet: DataFrame, speed_threshold: float = 100, min_share: float = 0.05
) -> DataFrame:
    """N11. Consumers below a speed per state and provider, ranked within the state.

    At most 1/min_share providers of a state pass the share filter, so the
    ranked groups are small.
    """
    slow = F.when(F.col("MaxAdDown") < speed_threshold, F.col("Consumer")).otherwise(0)
    providers = (
        internet.groupBy("StateAbbr", "ProviderName")
        .agg(F.sum("Consumer").alias("provider_cons"), F.sum(slow).alias("subx_consumers"))
        .filter(F.col("provider_cons") > 0)
    )
    shares = share_of_parent(providers, "StateAbbr", "provider_cons", "state_share")
    kept = shares.filter(F.col("state_share") >= min_share).withColumn(
        "subx_share", ratio(F.col("subx_consumers"), F.col("provider_cons"))
    )
    return (
        group_rank(
            kept, ["StateAbbr"], [F.desc("subx_consumers")], "dense_rank", "rank_in_state"
        )
        .select(
            "StateAbbr",
            "ProviderName",
            "subx_consumers",
            "provider_cons",
            "subx_share",
            "state_share",
            "rank_in_state",
        )
        .orderBy("StateAbbr", "rank_in_state")
    )


def affordability_gap_states(
    internet: DataFrame,
    demographics: DataFrame,
    states: DataFrame,
    restrict_age_25_64: bool = True,
) -> DataFrame:
    """N12. States faster than the median state whose median wage is below the median state."""
    speed = internet.groupBy("StateAbbr").agg(
        mean_of(F.col("MaxAdDown")).alias("state_avg_mbps")
    )
    earners = demographics.filter(F.col("WAGP") > 0)
    if restrict_age_25_64:
        earners = earners.filter(_working_age())
    income = exact_quantiles(
        earners, ["ST"], "WAGP", {"median_wagp": 0.5}, [F.count("*").alias("adult_pop")]
    )
    base = (
        _with_code(speed, states)
        .join(income, "ST")
        .select("StateAbbr", "state_avg_mbps", "median_wagp", "adult_pop")
    )
    screened = median_screen(
        base, "state_avg_mbps", "median_wagp", "affordability_gap_score", "adult_pop"
    )
    return group_rank(screened, [], [F.desc("affordability_gap_score")], "dense_rank").orderBy(
        "rank"
    )


def _working_age() -> Column:
    return F.col("AGEP").between(*WORKING_AGE)


def _with_code(by_state: DataFrame, states: DataFrame) -> DataFrame:
    """Add ``ST`` to a frame of one row per ``StateAbbr``."""
    return attach_dimension(by_state, states, "StateAbbr", ["ST"])


def _state_tiers(
    internet: DataFrame,
    states: DataFrame,
    column: str,
    threshold: float,
    names: tuple[str, str],
) -> DataFrame:
    """``ST, StateAbbr, tier`` by the mean of a coverage column."""
    means = internet.groupBy("StateAbbr").agg(mean_of(F.col(column)).alias("mean"))
    return _with_code(means, states).select(
        "ST", "StateAbbr", tier(F.col("mean"), threshold, *names).alias("tier")
    )


def _mean_by_tier(
    persons: DataFrame, tiers: DataFrame, measure: str, tier_name: str, mean_name: str
) -> DataFrame:
    """Mean over the persons of a tier, from one sum and count per state."""
    sums = persons.groupBy("ST").agg(
        F.sum(measure).alias("total"), F.count(measure).alias("known")
    )
    return (
        sums.join(tiers, "ST")
        .groupBy(F.col("tier").alias(tier_name))
        .agg(ratio(F.sum("total"), F.sum("known")).alias(mean_name))
    )
