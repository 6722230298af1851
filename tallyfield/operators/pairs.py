"""Pairs of rows near in time, and conditions that meet on one day."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfield.functions.columns import flag

# Rows of one key and slot are set against each other in blocks of about this many.
CHUNK_ROWS = 2_000
UNIT = ["key", "meeting", "one_block", "two_block"]


def near_pairs(
    rows: DataFrame,
    key: str,
    differ: str,
    row_id: str,
    seconds: Column,
    max_gap: int,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Pairs with equal ``key``, different ``differ`` and times less than ``max_gap`` apart.

    Each pair comes once, with ``id_a < id_b``: ``key, id_a, differ_a, id_b,
    differ_b``. Rows with a NULL key, differ value, id or time pair with nothing.

    Time is cut into slots of ``max_gap`` seconds, so partners lie in the same or
    in neighbouring slots: a meeting is a slot together with the next one. A slot
    of one key with more than ``chunk_rows`` rows is cut into blocks: those of a
    frequent ``differ`` value hold nothing else, the other rows are dealt by a
    hash of the id. Rows are joined by pair of blocks, so a hot key spreads over
    many tasks, and blocks of one and the same ``differ`` value never meet.
    """
    slotted = (
        rows.select(
            F.col(key).alias("key"),
            F.col(differ).alias("differ"),
            F.col(row_id).alias("id"),
            seconds.alias("time"),
        )
        .dropna()
        .withColumn("slot", F.floor(F.col("time") / max_gap))
    )
    units = _with_units(slotted, _crowded_slots(slotted, chunk_rows))
    paired = (
        _side(units, "one")
        .join(_side(units, "two"), UNIT)
        .filter(
            (F.col("one_differ") != F.col("two_differ"))
            & (F.abs(F.col("one_time") - F.col("two_time")) < max_gap)
            & (F.col("one_id") != F.col("two_id"))
            & ((F.col("one_slot") < F.col("two_slot")) | (F.col("one_id") < F.col("two_id")))
        )
    )
    in_order = F.col("one_id") < F.col("two_id")

    def pick(first: str, second: str) -> Column:
        return F.when(in_order, F.col(first)).otherwise(F.col(second))

    return paired.select(
        "key",
        pick("one_id", "two_id").alias("id_a"),
        pick("one_differ", "two_differ").alias("differ_a"),
        pick("two_id", "one_id").alias("id_b"),
        pick("two_differ", "one_differ").alias("differ_b"),
    )


def _side(units: DataFrame, side: str) -> DataFrame:
    names = ("differ", "id", "time", "slot")
    return units.filter(F.col("side") == side).select(
        *UNIT, *(F.col(c).alias(f"{side}_{c}") for c in names)
    )


def _block(slot: Column, differ: Column, chunk: Column) -> Column:
    """Number of a block; the first one of mixed rows is 0 in every slot."""
    first = differ.isNull() & (chunk == 0)
    number = F.xxhash64(slot, differ, chunk.cast("int"))
    return F.when(first, F.lit(0).cast("long")).otherwise(number)


def _crowded_slots(slotted: DataFrame, chunk_rows: int) -> DataFrame:
    """``key, slot, own, next, previous``: the cuts of slots with crowded ones beside them.

    Each of the three holds the ``frequent`` differ values with their chunks, the
    number of ``mixed`` chunks, and all ``blocks``; NULL where a slot is not cut.
    """
    cells = slotted.groupBy("key", "slot", "differ").agg(F.count("*").alias("n"))
    large, chunks = F.col("n") > chunk_rows, F.ceil(F.col("n") / chunk_rows).cast("int")
    rest = F.coalesce(F.sum(F.when(~large, F.col("n"))), F.lit(0))
    cut = (
        cells.groupBy("key", "slot")
        .agg(
            F.collect_list(
                F.when(large, F.struct("differ", chunks.alias("chunks")))
            ).alias("frequent"),
            F.greatest(F.ceil(rest / chunk_rows).cast("int"), F.lit(1)).alias("mixed"),
        )
        .filter((F.size("frequent") > 0) | (F.col("mixed") > 1))
    )
    kind = slotted.schema["differ"].dataType

    def blocks_of(differ: Column, chunks: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), chunks - 1),
            lambda k: F.named_struct(
                F.lit("differ"), differ, F.lit("block"), _block(F.col("slot"), differ, k)
            ),
        )

    frequent = F.flatten(F.transform("frequent", lambda f: blocks_of(f["differ"], f["chunks"])))
    blocks = F.concat(blocks_of(F.lit(None).cast(kind), F.col("mixed")), frequent)
    cuts = cut.select(
        "key",
        F.named_struct(
            F.lit("frequent"), F.col("frequent"), F.lit("mixed"), F.col("mixed"),
            F.lit("blocks"), blocks,
        ).alias("cut"),
        F.explode(F.array(*(F.struct((F.col("slot") + d).alias("slot"), F.lit(-d).alias("ahead"))
                            for d in (-1, 0, 1)))).alias("at"),
    )
    names = {0: "own", 1: "next", -1: "previous"}
    return cuts.groupBy("key", F.col("at.slot").alias("slot")).agg(
        *(
            F.first(F.when(F.col("at.ahead") == ahead, F.col("cut")), ignorenulls=True).alias(name)
            for ahead, name in names.items()
        )
    )


def _with_units(slotted: DataFrame, crowded: DataFrame) -> DataFrame:
    """The rows once for each pair of blocks in which they may find a partner.

    A row is the first one in the meeting of its slot and the second one there
    and in the meeting before. Where nothing is crowded there is one pair of blocks.
    """
    placed = slotted.join(crowded, ["key", "slot"], "left")
    differ, slot = F.col("differ"), F.col("slot")
    frequent = F.filter(F.col("own.frequent"), lambda f: f["differ"] == differ)
    is_frequent = F.coalesce(F.size(frequent) > 0, F.lit(False))
    chunks = F.when(is_frequent, F.get(frequent, F.lit(0))["chunks"]).otherwise(
        F.coalesce(F.col("own.mixed"), F.lit(1))
    )
    placed = placed.withColumn(
        "block", _block(slot, F.when(is_frequent, differ), F.pmod(F.xxhash64("id"), chunks))
    )

    def others(cut: str) -> Column:
        met = F.filter(
            F.col(f"{cut}.blocks"), lambda b: b["differ"].isNull() | (b["differ"] != differ)
        )
        single = F.array(F.lit(0).cast("long"))
        return F.coalesce(F.transform(met, lambda b: b["block"]), single)

    def units(side: str, meeting: Column, blocks: Column) -> Column:
        def unit(other: Column) -> Column:
            one, two = (F.col("block"), other) if side == "one" else (other, F.col("block"))
            return F.named_struct(
                F.lit("side"), F.lit(side), F.lit("meeting"), meeting,
                F.lit("one_block"), one, F.lit("two_block"), two,
            )

        return F.transform(F.array_distinct(blocks), unit)

    every = F.concat(
        units("one", slot, F.concat(others("own"), others("next"))),
        units("two", slot, others("own")),
        units("two", slot - 1, others("previous")),
    )
    return placed.select("key", "differ", "id", "time", "slot", F.inline(every))


def co_occurrence(
    rows: DataFrame, keys: Sequence[str], period: Mapping[str, Column], conditions: Sequence[Column]
) -> DataFrame:
    """Distinct ``keys`` with a period in which every condition was met by some row.

    Rows that meet no condition cannot matter and are dropped before the shuffle.
    """
    named = {f"met_{i}": c for i, c in enumerate(conditions)}
    any_met = reduce(lambda a, b: a | b, conditions)
    met = (
        rows.filter(any_met)
        .withColumns(dict(period))
        .groupBy(*keys, *period)
        .agg(*(F.max(flag(c)).alias(name) for name, c in named.items()))
    )
    all_met = reduce(lambda a, b: a & b, (F.col(name) == 1 for name in named))
    return met.filter(all_met).select(*keys).distinct()
