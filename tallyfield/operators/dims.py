"""Joins with dimension tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def attach_dimension(
    rows: DataFrame,
    dimension: DataFrame,
    on: str,
    columns: Sequence[str],
    how: str = "inner",
) -> DataFrame:
    """Add ``columns`` of a dimension with one row per ``on``.

    Without a hint Spark broadcasts the dimension if its size, known from the
    files or from a local list of values, is below the configured threshold, and
    shuffles otherwise. NULL keys match nothing.
    """
    return rows.join(dimension.select(on, *columns), on, how)


def checked_dimension(dimension: DataFrame, on: str, columns: Sequence[str]) -> DataFrame:
    """``on`` and ``columns`` of a dimension; a key that occurs twice raises an error.

    The check is part of the plan: one aggregate by key, which fails where a join would have
    multiplied rows. Rows that repeat the whole of another count as twice too. NULL keys match
    nothing in a join, so they are dropped, however many there are.
    """
    told = [F.any_value(c).alias(c) for c in columns]
    keyed = dimension.filter(F.col(on).isNotNull()).groupBy(on).agg(F.count("*").alias("_n"), *told)
    twice = F.raise_error(F.concat(F.lit(f"{on} occurs more than once in a dimension: "), F.col(on).cast("string")))
    return keyed.select(F.when(F.col("_n") == 1, F.col(on)).otherwise(twice).alias(on), *columns)
