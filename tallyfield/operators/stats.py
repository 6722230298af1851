"""Profiles, percentile gaps, composite indexes, category gaps and peer deviations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyfield.functions.columns import flag, mean_of, ratio
from tallyfield.operators.groups import attach_to_groups, bounded, null_safe_join
from tallyfield.operators.moments import moments
from tallyfield.operators.quantiles import ACCURACY, exact_quantiles



PROFILE_SCHEMA = "column_name string, n long, mean double, stddev double, min double, max double"


def numeric_columns(df: DataFrame) -> list[str]:
    """Names of the columns of numbers of any type, in schema order."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def preview(df: DataFrame, columns: int = 10, rows: int = 5) -> DataFrame:
    """The first columns of a few rows."""
    return df.select(*(f"`{c}`" for c in df.columns[:columns])).limit(rows)


def profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per numeric column: count, mean, stddev, min, max.

    The columns are summarised together in one scan (``moments``). Integers and decimals are
    added exactly, floating-point columns as doubles. Without numeric columns the result is empty.
    """
    names = list(columns if columns is not None else numeric_columns(df))
    return moments(df, names) if names else df.sparkSession.createDataFrame([], PROFILE_SCHEMA)


def sizes(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per data set: name, rows, columns."""
    counted = [
        df.agg(F.count("*").alias("n_rows")).select(
            F.lit(name).alias("dataset"), "n_rows", F.lit(len(df.columns)).alias("n_columns")
        )
        for name, df in tables.items()
    ]
    result = counted[0]
    for other in counted[1:]:
        result = result.unionByName(other)
    return result


def percentile_gap(
    rows: DataFrame,
    keys: Sequence[str],
    column: str,
    name: str,
    low: float = 0.1,
    high: float = 0.9,
) -> DataFrame:
    """Distance between two exact percentiles of the positive values of each group."""
    positive = rows.filter(F.col(column) > 0)
    ends = exact_quantiles(positive, keys, column, {"_low": low, "_high": high})
    return ends.select(*keys, (F.col("_high") - F.col("_low")).cast("double").alias(name))


def median_of(column: str | Column, accuracy: int = ACCURACY) -> Column:
    """Median, a value that occurs; exact for up to ``accuracy`` rows, so for summaries."""
    return F.percentile_approx(column, 0.5, accuracy)


def min_max_normalise(df: DataFrame, columns: Sequence[str], suffix: str = "_norm") -> DataFrame:
    """Scale each column to 0..1 over all rows; 0.5 where all values are equal."""
    ends = df.agg(
        F.struct(
            *(F.min(c).cast("double").alias(f"{c}_low") for c in columns),
            *(F.max(c).cast("double").alias(f"{c}_high") for c in columns),
        ).alias("ends")
    ).scalar()

    def scaled(c: str) -> Column:
        low, high = ends[f"{c}_low"], ends[f"{c}_high"]
        return F.when(high == low, F.lit(0.5)).otherwise(
            ratio(F.col(c).cast("double") - low, high - low)
        )

    return df.withColumns({f"{c}{suffix}": scaled(c) for c in columns})


def weighted_sum(weights: Sequence[tuple[float, Column]]) -> Column:
    """Weighted sum, added in the order given."""
    (weight, column), *rest = weights
    total = F.lit(weight) * column
    for weight, column in rest:
        total = total + F.lit(weight) * column
    return total


def category_gap(
    rows: DataFrame,
    keys: Sequence[str],
    category: str,
    first: object,
    second: object,
    measure: str,
    names: tuple[str, str, str, str],
) -> DataFrame:
    """Per group: mean of both categories, their difference, and the rows of both.

    ``names`` are the four output columns in that order. The difference is NULL
    if a category is missing. One aggregate, no pivot and no window.
    """
    first_mean, second_mean, gap, total = names
    is_first, is_second = F.col(category) == first, F.col(category) == second
    return (
        rows.filter(is_first | is_second)
        .groupBy(*keys)
        .agg(
            mean_of(F.when(is_first, F.col(measure))).alias(first_mean),
            mean_of(F.when(is_second, F.col(measure))).alias(second_mean),
            F.count("*").alias(total),
        )
        .withColumn(gap, F.col(first_mean) - F.col(second_mean))
    )


def deviation_from_peers(
    rows: DataFrame,
    keys: Sequence[str],
    measure: str,
    mean_name: str,
    deviation_name: str,
    max_groups: int | None = None,
) -> DataFrame:
    """Add to every row the mean of its group and the distance from it. NULL keys are a group.

    With ``max_groups`` the means are a lookup table, broadcast after a check that there are no
    more: the rows are read twice and never shuffled. Without it there may be any number.
    """
    peers = "peer_rows"
    means = rows.groupBy(*keys).agg(
        mean_of(F.col(measure)).alias(mean_name), F.count("*").alias(peers)
    )
    if max_groups is None:
        attached = attach_to_groups(rows, means, keys, peers).drop(peers)
    else:
        attached = null_safe_join(rows, bounded(means.drop(peers), max_groups), keys, "inner")
    return attached.withColumn(deviation_name, F.col(measure) - F.col(mean_name))


def median_screen(
    df: DataFrame, high: str, low: str, score: str, size: str, accuracy: int = ACCURACY
) -> DataFrame:
    """Rows with ``high`` above and ``low`` below the median over all rows, scored.

    The score is the excess of ``high`` over its median, relative to it, times
    ``log1p(size)``. Without rows the result is empty.
    """
    # A size of zero cannot occur in a counted group. The filter makes both uses
    # of ``df`` read the same columns, so Spark computes it once.
    counted = df.filter(F.col(size) > 0)
    medians = counted.agg(
        F.struct(
            median_of(high, accuracy).cast("double").alias("high"),
            median_of(low, accuracy).cast("double").alias("low"),
        ).alias("medians")
    ).scalar()
    excess = ratio(F.col(high) - medians["high"], medians["high"])
    return counted.filter(
        (F.col(high) > medians["high"]) & (F.col(low) < medians["low"])
    ).withColumn(score, excess * F.log1p(F.col(size)))


def low_share(column: Column, bound: float) -> Column:
    """Share of rows below the bound; NULL counts as not below."""
    return ratio(F.sum(flag(column < bound)), F.count("*"))
