"""Mixing sources to target weights by Pareto order sampling.

Every source gets a target in words. All its documents are taken in as many whole copies as are
certain. For the rest of the target every document has an inclusion probability that grows with a
power of its size, one at most, such that the expected words are the rest; documents are taken in
the order of their random odds divided by their inclusion odds, until the words taken come nearest
to the target. What a long document at the cut leaves open, later documents fill that fit into it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyfield.llm.common import checkpoint, n_words, table

WEIGHTS = (3, 1, 2)
SHARE, MOST = 1.5, 2
SEED = 3
# Inclusion grows with this power of the size; sizes within a fourth of a power of two have the same.
POWER = 0.5
# The first cut, and how often what is left open is filled.
FILLS = 3
# Places of a histogram in which the last document of a source is looked for.
PLACES = 65_536
# Tables of sources up to this size are broadcast, larger ones are joined by shuffle.
SMALL_ROWS = 10_000


def _uniform(key: Column, seed: int) -> Column:
    """A number in (0, 1) that depends on the key alone."""
    return (F.pmod(F.xxhash64(F.lit(seed), key), F.lit(1 << 52)) + 0.5) / float(1 << 52)


def _drawn(docs: DataFrame) -> DataFrame:
    """The rows as one struct, with source, size, a random number and a hash that breaks ties."""
    doc_id, text = F.col("doc_id").cast("long"), F.col("text").cast("string")
    return docs.select(
        F.struct("*").alias("doc"), F.col("source").cast("string").alias("source"), n_words(text).alias("size"),
        _uniform(F.struct(doc_id, text), SEED).alias("u"), F.xxhash64(F.lit(SEED + 1), doc_id, text).alias("tie"),
    )


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(source, source_size, target) from rows of (source, size).

    Sources in the order of their code points, null last, get the weights in turn. They share
    ``share`` times all sizes by weight; a target stops at ``most`` times its source's size and
    the excess is shared anew until none is above. All steps work on one row per source.
    """
    by_name, by_room = W.orderBy(F.col("source").asc_nulls_last()), W.orderBy("room", F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    weighted = sources.withColumn("weight", F.get(cycle, (F.row_number().over(by_name) - 1) % len(weights)))
    weighted = weighted.withColumns({"most": most * F.col("source_size"), "room": most * F.col("source_size") / F.col("weight")})
    everything = W.partitionBy()
    before = F.coalesce(F.sum("most").over(by_room.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0))
    left = F.sum("weight").over(by_room.rowsBetween(0, W.unboundedFollowing))
    # Words per weight if all sources with less room were full: the largest is the final level.
    level = (share * F.sum("source_size").over(everything) - before) / left
    levelled = weighted.select("*", level.alias("level_here")).select("*", F.max("level_here").over(everything).alias("level"))
    return levelled.select("source", "source_size", F.least(F.col("most").cast("double"), F.col("level") * F.col("weight")).alias("target"))


def _class(size: Column) -> Column:
    """Sizes in quarters of a power of two."""
    return F.floor(F.log2(F.greatest(size, F.lit(1)).cast("double")) * 4)


def _weight(size_class: Column) -> Column:
    return F.pow(F.lit(2.0), size_class * (POWER / 4))


def _odds(u: Column, size: Column, level: Column) -> Column:
    """Random odds divided by inclusion odds, squeezed into [0, 1] without changing the order."""
    inclusion = F.least(F.greatest(level * _weight(_class(size)), F.lit(1e-12)), F.lit(1 - 1e-12))
    ratio = (u / (1 - u)) / (inclusion / (1 - inclusion))
    return ratio / (1 + ratio)


def levels(drawn: DataFrame, plan: DataFrame) -> DataFrame:
    """``plan`` with level: the inclusion probability per weight at which the rest of a source is expected.

    Classes of size, some hundreds a source at most, are certain from the largest downwards.
    """
    classes = drawn.groupBy("source", _class(F.col("size")).alias("class")).agg(F.sum("size").alias("size"))
    down = W.partitionBy("source").orderBy(F.desc("class"))
    certain = F.coalesce(F.sum("size").over(down.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    left = F.sum(F.col("size") * _weight(F.col("class"))).over(down.rowsBetween(0, W.unboundedFollowing))
    steps = _with_plan(classes.select("source", certain.alias("certain"), left.alias("left")), plan.select("source", "rest"))
    # Taking fewer classes for certain, or more, than are so gives a lower level.
    level = F.max(F.when(F.col("left") > 0, (F.col("rest") - F.col("certain")) / F.col("left")))
    found = steps.groupBy(F.col("source").alias("s")).agg(F.coalesce(level, F.lit(0.0)).alias("level"))
    return plan.join(found, F.col("source").eqNullSafe(F.col("s"))).drop("s")


def _taken() -> Column:
    """Whether a row (size, odds, tie) is before one of the cuts."""
    here = F.struct(F.col("odds"), F.col("tie"))
    before = lambda c: (F.col("odds") < c["edge"]) | F.coalesce(here <= c["last"], F.lit(False))
    return F.exists("cuts", lambda c: (F.col("size") <= c["most"]) & before(c))


def _near(plan: DataFrame) -> DataFrame:
    return F.broadcast(plan) if plan.count() <= SMALL_ROWS else plan


def _with_plan(rows: DataFrame, plan: DataFrame) -> DataFrame:
    named = plan.withColumnRenamed("source", "plan_source")
    return rows.join(_near(named), F.col("source").eqNullSafe(F.col("plan_source"))).drop("plan_source")


CUTS = "array<struct<most: double, edge: double, last: struct<odds: double, tie: bigint>>>"


def _filled(placed: DataFrame, plan: DataFrame) -> DataFrame:
    """``plan`` with a further cut, and what it leaves open.

    The documents that may be taken alone without leaving more open are taken in order, as long as the
    words come nearer to what is open; all of them if they are fewer.
    """
    free = _with_plan(placed, plan.select("source", "open", "cuts")).where((F.col("size") <= 2 * F.col("open")) & (F.col("size") > 0) & ~_taken())
    free = free.select("source", "size", "odds", "tie", "open", F.floor(F.col("odds") * PLACES).alias("place"))
    sums = free.groupBy("source", "place", "open").agg(F.sum("size").alias("size"))
    upto = F.sum("size").over(W.partitionBy("source").orderBy("place"))
    ranges = sums.select("source", "place", "open", (upto - F.col("size")).alias("before"), upto.alias("upto"))
    over = F.col("upto") >= F.col("open")
    last = checkpoint(ranges.groupBy("source").agg(
        F.min(F.when(over, F.col("place"))).alias("last_place"), F.min(F.when(over, F.col("before"))).alias("before"), F.max("upto").alias("all"),
    ))
    close = _with_plan(free, last).where("place = last_place")
    order = W.partitionBy("source").orderBy("odds", "tie")
    inside = F.sum("size").over(order.rangeBetween(W.unboundedPreceding, W.currentRow))
    cut = close.select("source", "odds", "tie", "open", (F.col("before") + inside).alias("upto"), "size").where("upto - size / 2 <= open")
    # Before the first document of the last place, everything of earlier places is taken.
    cut = cut.groupBy(F.col("source").alias("s")).agg(F.max(F.struct("odds", "tie")).alias("last"), F.max("upto").alias("upto"))
    found = last.join(cut, F.col("source").eqNullSafe(F.col("s")), "left").select(
        F.col("source").alias("s"), F.coalesce(F.col("last_place") / PLACES, F.lit(2.0)).alias("edge"), "last",
        F.when(F.col("last_place").isNull(), F.col("all")).otherwise(F.coalesce("upto", "before")).alias("words"),
    )
    both = plan.join(found, F.col("source").eqNullSafe(F.col("s")), "left")
    cut = F.array(F.struct((2 * F.col("open")).alias("most"), "edge", "last")).cast(CUTS)
    return both.withColumns({
        "cuts": F.when(F.col("edge").isNull(), F.col("cuts")).otherwise(F.concat("cuts", cut)), "open": F.col("open") - F.coalesce("words", F.lit(0)),
    }).drop("s", "edge", "last", "words")


def allocation(drawn: DataFrame, **options) -> DataFrame:
    """One row per source: target, whole copies, the level of the inclusion probabilities and the cuts."""
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    plan = targets(drawn, **options).withColumn("whole", F.floor(ratio))
    plan = checkpoint(plan.withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size")))
    plan = checkpoint(levels(drawn, plan).withColumns({"open": F.col("rest"), "cuts": F.array().cast(CUTS)}))
    placed = _with_plan(drawn.select("source", "size", "u", "tie"), plan.select("source", "level"))
    placed = placed.select("source", "size", "tie", _odds(F.col("u"), F.col("size"), F.col("level")).alias("odds"))
    for _ in range(FILLS):
        plan = checkpoint(_filled(placed, plan))
    return plan


def with_copies(drawn: DataFrame, plan: DataFrame) -> DataFrame:
    """The drawn rows with source_size, target and copies."""
    rows = _with_plan(drawn, plan).withColumn("odds", _odds(F.col("u"), F.col("size"), F.col("level")))
    return rows.withColumn("copies", F.col("whole") + _taken().cast("long")).drop("odds", "cuts")


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The documents of the mix with all their columns, each as often as it is taken.

    Needs the columns doc_id, text and source. A null source is a source of its own; rows without a
    doc_id are told apart by their texts. Null and blank texts have no words and change no count.
    Documents equal in id and text share one decision. An empty table, or one without any word,
    gives no sampled rows.
    """
    drawn = _drawn(docs)
    plan = allocation(checkpoint(drawn.select("source", "size", "u", "tie")), **options)
    rows = with_copies(drawn, plan).where("copies > 0")
    return rows.select("doc", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("doc.*")


def measured(docs: DataFrame, **options) -> DataFrame:
    """doc_id, size, source_size, target and taken (words, repeats counted) of every row.

    Nulls, blank texts and repeated rows are as in ``mixed``; their taken words are 0 if they have none. An
    empty table gives an empty table; further columns are ignored.
    """
    drawn = checkpoint(_drawn(docs).select(F.col("doc.doc_id").cast("long").alias("doc_id"), "source", "size", "u", "tie"))
    rows = with_copies(drawn, allocation(drawn, **options))
    return rows.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measured(table(spark, sf_dir, "documents"))
