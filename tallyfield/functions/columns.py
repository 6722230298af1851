"""Column expressions shared by the operators. All are narrow and JVM-side."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
TIME_WIDTH = 19


def clean_numeric(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast text columns to numbers; a cell that is no number becomes NULL."""
    return df.withColumns({c: F.col(f"`{c}`").try_cast(t) for c, t in types.items()})


def parse_time(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Read ``yyyy-MM-dd HH:mm:ss`` from the first 19 characters of each column.

    Anything after the seconds (nanoseconds, zone) is ignored; text that is no
    time becomes NULL.
    """
    return df.withColumns(
        {
            c: F.try_to_timestamp(F.substring(F.col(c), 1, TIME_WIDTH), F.lit(TIME_FORMAT))
            for c in columns
        }
    )


def label(column: Column, names: Mapping[int, str], default: str = "Unknown") -> Column:
    """Name a code; NULL and unlisted codes get ``default``."""
    named = F.lit(None).cast("string")
    for code, name in names.items():
        named = F.when(column == code, F.lit(name)).otherwise(named)
    return F.coalesce(named, F.lit(default))


def bucketize(column: Column, bands: Iterable[tuple[float, str]], last: str) -> Column:
    """Name the first band whose upper bound lies above the value.

    ``bands`` ascends by bound. Values at or above every bound get ``last``;
    NULL stays NULL.
    """
    named = F.when(column.isNotNull(), F.lit(last))
    for bound, name in sorted(bands, reverse=True):
        named = F.when(column < bound, F.lit(name)).otherwise(named)
    return named


def tier(column: Column, threshold: float, high: str, low: str) -> Column:
    """``high`` strictly above the threshold, else ``low`` (also for NULL)."""
    return F.when(column > threshold, F.lit(high)).otherwise(F.lit(low))


def or_zero(column: Column) -> Column:
    """NULL and unreadable codes count as integer code 0."""
    return F.coalesce(column.try_cast("int"), F.lit(0))


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it is false or NULL."""
    return F.when(condition, 1).otherwise(0)


def ratio(top: Column, bottom: Column) -> Column:
    """``top / bottom`` as double, NULL for a zero or NULL bottom."""
    return F.try_divide(top.cast("double"), bottom.cast("double"))


def mean_of(column: Column) -> Column:
    """Mean of the non-null values as double.

    Sum and count are kept apart, so a decimal column is summed exactly and the
    result does not depend on the order in which tasks finish.
    """
    return ratio(F.sum(column), F.count(column))
