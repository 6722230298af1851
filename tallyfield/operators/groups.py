"""Bring a value computed per group back to the rows, whatever the group sizes."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# At most this many groups are broadcast, by an explicit limit.
HEAVY_GROUPS = 10_000
# A group below this size is harmless in a shuffle and is never broadcast.
HEAVY_ROWS = 1_000


def null_safe_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str) -> DataFrame:
    """Equi-join in which NULL keys match each other; the keys of ``left`` are kept."""
    taken = {k: f"right_{k}" for k in on}
    match = reduce(
        lambda a, b: a & b, (F.col(f"`{k}`").eqNullSafe(F.col(f"`{r}`")) for k, r in taken.items())
    )
    return left.join(right.withColumnsRenamed(taken), match, how).drop(*taken.values())


def bounded(groups: DataFrame, most: int = HEAVY_GROUPS) -> DataFrame:
    """``groups`` for a broadcast, after a check of its size: more than ``most`` rows raise an error.

    For groups whose keys come from code lists. ``attach_to_groups`` has no such bound.
    """
    packed = groups.limit(most + 1).agg(F.collect_list(F.struct("*")).alias("rows"))
    message = F.raise_error(F.lit(f"more than {most} groups are too many to broadcast"))
    checked = F.when(F.size("rows") > most, message).otherwise(F.col("rows"))
    return F.broadcast(packed.select(F.inline(checked)))


def attach_to_groups(
    rows: DataFrame,
    groups: DataFrame,
    on: Sequence[str],
    weight: str,
    counts: DataFrame | None = None,
    heavy_groups: int = HEAVY_GROUPS,
    heavy_rows: int = HEAVY_ROWS,
) -> DataFrame:
    """Inner join ``rows`` with ``groups``, a frame of one row per key of ``on``.

    ``weight`` names the column of ``groups`` that counts the rows of a group.
    The largest groups, at most ``heavy_groups`` and each above ``heavy_rows``,
    are broadcast; the limit proves them to be small. All other rows are joined
    through a shuffle, in which no key is hot: each holds at most ``heavy_rows``
    rows or less than 1/heavy_groups of all. Every row takes exactly one of the
    two ways, and NULL keys match NULL keys.

    The counts are exact and ties are broken by key, so the heavy groups are the
    same however often Spark has to compute them. ``counts`` may give keys and
    weight from a frame that is cheaper than ``groups`` to choose them from.
    """
    # The filter never drops a row, and the later sort columns never decide. They
    # make every use of ``groups`` read the same columns, so that Spark does not
    # prune it to different aggregates and computes it once.
    counted = groups.filter(F.col(weight) > 0)
    source = counted if counts is None else counts
    others = [c for c in source.columns if c != weight and c not in on]
    heavy = (
        source.filter(F.col(weight) > heavy_rows)
        .orderBy(F.desc(weight), *on, *others)
        .limit(heavy_groups)
    )
    keys = F.broadcast(heavy.select(*on))
    if counts is not None:
        heavy = null_safe_join(counted, keys, on, "left_semi")
    in_heavy = null_safe_join(rows, F.broadcast(heavy), on, "inner")
    light_rows = null_safe_join(rows, keys, on, "left_anti")
    in_light = null_safe_join(light_rows, counted, on, "inner")
    return in_heavy.unionByName(in_light)
