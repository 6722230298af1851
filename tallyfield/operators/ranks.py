"""Ranks within groups: of summarised rows, and of rows without bound."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyfield.operators.groups import null_safe_join

# Groups of up to this many rows are sorted by one task each.
HEAVY_GROUP_ROWS = 1_000_000
# Of the others, this many at most are cut, each into this many parts.
HEAVY_GROUPS, PARTS = 256, 128
METHODS = {"rank": F.rank, "dense_rank": F.dense_rank, "row_number": F.row_number}


def group_rank(
    summary: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    method: str = "rank",
    name: str = "rank",
) -> DataFrame:
    """Rank the rows of an already summarised frame within ``keys``.

    One task ranks one group, so this is for frames whose groups are bounded by
    a code list. Use ``rank_rows`` for rows that grow with the data, and
    ``top_n_per_group`` when only the first places are wanted.
    """
    return summary.withColumn(name, METHODS[method]().over(_ordered(keys, order)))


def top_n_per_group(
    summary: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    n: int,
    method: str = "rank",
    name: str = "rank",
) -> DataFrame:
    """Keep the rows ranked 1 to ``n`` within ``keys``.

    Spark sees the bound on the rank and drops later places in every task before
    the shuffle (WindowGroupLimit), so a large group is never moved whole.
    """
    return group_rank(summary, keys, order, method, name).filter(F.col(name) <= n)


def rank_rows(
    rows: DataFrame,
    keys: Sequence[str],
    value: str,
    name: str = "rank",
    heavy_rows: int = HEAVY_GROUP_ROWS,
    heavy_groups: int = HEAVY_GROUPS,
    parts: int = PARTS,
) -> DataFrame:
    """Rank rows by a numeric ``value``, highest first and NULL last, within ``keys``.

    Exact, like ``rank`` over a window, but no task has to hold a large group. One pass cuts each
    group of more than ``heavy_rows`` rows, the ``heavy_groups`` largest at most, at the
    quantiles of its values. Rows between two cuts are one part; rows equal to a cut, to NaN or
    to NULL are another, in which all have one rank. The rows are shuffled once, by part; those of
    a part of equal values stay as dealt, since they need no order. A rank is the place within the
    part plus the rows of the parts above, a table of at most ``heavy_groups * (2 * parts + 2)``
    rows. Where the cuts lie has no influence on the ranks.

    A value that many rows share is a cut of its own, unless it is an integer or decimal that a
    double cannot hold.
    """
    number = F.col(f"`{value}`").cast("double")
    cuts = _cuts(rows, keys, number, heavy_rows, heavy_groups, parts)
    above, equal = F.filter("_cuts", lambda c: c < number), F.array_contains("_cuts", number)
    between = 2 * F.size(above) + F.when(equal, 1).otherwise(0)
    part = F.when(number.isNull(), -1).when(F.isnan(number), 2 * parts + 1).otherwise(between)
    parted = null_safe_join(rows, F.broadcast(cuts), keys, "left")
    parted = parted.withColumn("_part", F.when(F.col("_cuts").isNotNull(), part)).drop("_cuts")
    alike = F.pmod("_part", F.lit(2)) == 1
    dealt = parted.withColumn("_deal", F.when(alike, F.spark_partition_id()).otherwise(-1))
    dealt = dealt.repartition(*keys, "_part", "_deal")

    # Every column is read here, and the filter is on aggregates, so that Spark uses the one
    # shuffle of the rows twice.
    sizes = dealt.groupBy(*keys, "_part").agg(
        F.count("*").alias("_rows"), F.max("_part").alias("_cut"), F.max(F.hash(*dealt.columns)).alias("_read")
    )
    sizes = sizes.filter(F.col("_cut").isNotNull() & F.col("_read").isNotNull())
    higher = _sum_before("_rows", W.partitionBy(*keys).orderBy(F.desc("_part")))
    offsets = sizes.select(*keys, "_part", higher.alias("_higher"))
    within = F.rank().over(W.partitionBy(*keys, "_part", "_deal").orderBy(F.desc_nulls_last(value)))
    ranked = null_safe_join(dealt.withColumn("_within", within), F.broadcast(offsets), [*keys, "_part"], "left")
    place = F.coalesce("_higher", F.lit(0)) + F.col("_within")
    return ranked.withColumn(name, place).select(*rows.columns, name)


def _cuts(
    rows: DataFrame, keys: Sequence[str], number: Column, heavy_rows: int, heavy_groups: int, parts: int
) -> DataFrame:
    """Values that cut the large groups into ``parts`` of about equal size, ascending."""
    known = F.when(~F.isnan(number), number)
    at = F.percentile_approx(known, [i / parts for i in range(1, parts)], 8 * parts)
    groups = rows.groupBy(*keys).agg(F.count("*").alias("_n"), at.alias("_cuts"))
    largest = groups.filter(F.col("_n") > heavy_rows).orderBy(F.desc("_n"), *keys).limit(heavy_groups)
    return largest.select(*keys, F.array_distinct(F.coalesce("_cuts", F.array().cast("array<double>"))).alias("_cuts"))


def _ordered(keys: Sequence[str], order: Sequence[Column]) -> WindowSpec:
    return W.partitionBy(*keys).orderBy(*order)


def _sum_before(column: str, window: WindowSpec) -> Column:
    before = window.rowsBetween(W.unboundedPreceding, -1)
    return F.coalesce(F.sum(column).over(before), F.lit(0))
