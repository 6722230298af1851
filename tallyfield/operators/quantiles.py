"""Exact quantiles per group in two passes over the rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyfield.operators.groups import bounded, null_safe_join

# The sketch's ranks are off by at most rows/ACCURACY; brackets are twice as wide.
ACCURACY = 10_000


def exact_quantiles(
    rows: DataFrame,
    keys: Sequence[str],
    column: str,
    points: Mapping[str, float],
    also: Sequence[Column] = (),
    accuracy: int = ACCURACY,
) -> DataFrame:
    """One row per group: ``keys``, a column for each of ``points``, and the aggregates ``also``.

    A quantile at p is the smallest value that at least p of the group's values do not exceed, so
    it is always a value that occurs. NULL and NaN take no part; without values it is NULL.

    The first pass brackets every quantile between two values of a mergeable sketch. The second
    counts, per group, the rows below each bracket and the rows of every distinct value inside,
    some ten-thousandths of all, among which the place of the quantile is known exactly. Hot
    values are counted in every task before they are shuffled. The brackets are broadcast; there
    may be as many groups as ``bounded`` admits.
    """
    number = F.col(f"`{column}`").cast("double")
    number = F.when(~F.isnan(number), number)
    margin = 2 / accuracy
    ends = [min(max(end, 0.0), 1.0) for p in points.values() for end in (p - margin, p + margin)]
    others = {c: f"_also{k}" for k, c in enumerate(_names(rows, keys, also))}
    brackets = rows.groupBy(*keys).agg(
        F.count(number).alias("_n"),
        F.percentile_approx(number, ends, accuracy).alias("_ends"),
        *(c.alias(name) for c, name in zip(also, others.values(), strict=True)),
    )
    told = ["_n", "_ends", *others.values()]
    joined = null_safe_join(rows.select(*keys, F.col(f"`{column}`").alias("_value")), bounded(brackets), keys, "inner")
    number = F.col("_value").cast("double")

    def inside(k: int) -> Column:
        low = number >= F.get("_ends", F.lit(2 * k)) if ends[2 * k] > 0 else F.lit(True)
        high = number <= F.get("_ends", F.lit(2 * k + 1)) if ends[2 * k + 1] < 1 else F.lit(True)
        return low & high & ~F.isnan(number)

    def below(k: int) -> Column:
        return number < F.get("_ends", F.lit(2 * k)) if ends[2 * k] > 0 else F.lit(False)

    places = range(len(points))
    any_inside = reduce(lambda a, b: a | b, map(inside, places))
    counted = joined.groupBy(*keys, F.when(any_inside, F.col("_value")).alias("_value")).agg(
        F.count("*").alias("_rows"), *(F.count_if(below(k)).alias(f"_below{k}") for k in places), *(F.any_value(c).alias(c) for c in told)
    )
    whole = W.partitionBy(*keys)
    upto = whole.orderBy("_value").rowsBetween(W.unboundedPreceding, W.currentRow)
    summed = counted.select(
        "*", *((F.sum(f"_below{k}").over(whole) + F.coalesce(F.sum(F.when(inside(k), F.col("_rows"))).over(upto), F.lit(0))).alias(f"_upto{k}") for k in places)
    )
    missed = F.raise_error(F.lit("a quantile lies outside its bracket; raise the accuracy"))
    answers = []
    for k, (name, p) in enumerate(points.items()):
        place = F.greatest(F.ceil(F.lit(Decimal(str(p))) * F.col("_n")), F.lit(1))
        found = F.min(F.when(inside(k) & (F.col(f"_upto{k}") >= place), F.col("_value")))
        answers.append(F.coalesce(found, F.when(F.any_value("_n") > 0, missed)).alias(name))
    return summed.groupBy(*keys).agg(*answers, *(F.any_value(new).alias(old) for old, new in others.items()))


def _names(rows: DataFrame, keys: Sequence[str], also: Sequence[Column]) -> list[str]:
    """Names of the further aggregates."""
    return rows.groupBy(*keys).agg(F.count("*").alias("_n"), *also).columns[len(keys) + 1 :]
