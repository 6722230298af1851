"""Ratios, shares and rates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyfield.functions.columns import flag, mean_of, ratio
from tallyfield.operators.groups import HEAVY_GROUPS, bounded


def conditional_ratio(
    rows: DataFrame, keys: Sequence[str], condition: Column, name: str, scale: float = 1.0
) -> DataFrame:
    """Share of the rows of each group that meet the condition, times ``scale``.

    A row with a NULL condition counts as not meeting it. One aggregate with map
    side combine, so only one row per group and task is shuffled.
    """
    hits = F.sum(flag(condition))
    return rows.groupBy(*keys).agg((ratio(hits, F.count("*")) * scale).alias(name))


def count_conditions(rows: DataFrame, conditions: Mapping[str, Column]) -> DataFrame:
    """One row: for each name the number of rows that meet its condition."""
    return rows.agg(*(F.count_if(c).alias(name) for name, c in conditions.items()))


def share_of_parent(
    summary: DataFrame, parent: str, measure: str, name: str = "share", max_parents: int = HEAVY_GROUPS
) -> DataFrame:
    """Add the share of ``measure`` in its total over ``parent``.

    ``summary`` holds one row per child. A second, combined aggregate sums them, and the totals, a
    row for each code of a list, are broadcast after a check that there are no more than
    ``max_parents``. So the children of a parent are not gathered in one task. Rows without a
    parent drop out.
    """
    total = "parent_total"
    totals = summary.filter(F.col(parent).isNotNull()).groupBy(parent).agg(F.sum(measure).alias(total))
    shared = summary.join(bounded(totals, max_parents), parent).select(*summary.columns, total)
    return shared.withColumn(name, ratio(F.col(measure), F.col(total))).drop(total)


def running_share(
    ranked: DataFrame, keys: Sequence[str], order: str, share: str, name: str = "cumulative_share"
) -> DataFrame:
    """Sum of ``share`` from the first row of the group to the current one.

    Meant for the few rows that ``top_n_per_group`` leaves.
    """
    window = W.partitionBy(*keys).orderBy(order)
    upto = window.rowsBetween(W.unboundedPreceding, W.currentRow)
    return ranked.withColumn(name, F.sum(share).over(upto))


def rate_per(top: Column, bottom: Column, per: float, digits: int = 2) -> Column:
    """``top`` per ``per`` units of ``bottom``, rounded half up."""
    return F.round(ratio(top, bottom) * per, digits)


def leaders_summary(
    leaders: DataFrame, entity: str, place: str, share: str
) -> DataFrame:
    """For each entity: in how many places it leads, its mean share there, and where.

    The list holds one entry per place led, in order, so it is stable and bounded
    by the number of places.
    """
    return leaders.groupBy(entity).agg(
        F.count(place).alias("places_led"),
        mean_of(F.col(share)).alias("mean_share"),
        F.sort_array(F.collect_list(place)).alias("places"),
    )
