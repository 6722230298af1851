"""Exact duplicates by a heavy-hitter split, in DataFrame functions only.

Texts are equal when they are identical after their white space is deleted; a SHA-256 of the
rest stands for them. Misra-Gries counters find every digest that a given share of the rows has.
Those are counted again exactly, and the few verified ones, with the row of each that stays, are
broadcast: their rows are marked, or removed, where they are read. Only the other digests, none
of which is frequent, are shuffled.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfield.llm.common import SPACE_CHARS, checkpoint, stored, table

# A digest is frequent if more than this share of the rows have it, so at most 1 / SHARE digests are.
SHARE = 0.001


def normalised(text: Column) -> Column:
    """The text without its white space; empty for null."""
    return reduce(lambda t, c: F.replace(t, F.lit(c), F.lit("")), SPACE_CHARS, F.coalesce(text.cast("string"), F.lit("")))


def fingerprinted(docs: DataFrame) -> DataFrame:
    """(row, doc_id, digest, n_chars) of every row, stored once; ``row`` numbers the rows."""
    return stored(docs.select(
        F.monotonically_increasing_id().alias("row"), "doc_id",
        F.unhex(F.sha2(normalised(F.col("text")).cast("binary"), 256)).alias("digest"),
        F.length(F.coalesce(F.col("text").cast("string"), F.lit(""))).cast("long").alias("n_chars"),
    ))


def _winner() -> list[Column]:
    """Aggregates of a group: the row that stays, by length, then id, then number, and the size."""
    first = F.struct((-F.col("n_chars")).alias("n"), F.col("doc_id").isNull().alias("nameless"), "doc_id", "row")
    return [F.min(first).alias("first"), F.count("*").alias("group_size")]


def _unpacked(groups: DataFrame) -> DataFrame:
    return groups.select("digest", F.col("first.doc_id").alias("keep_id"), F.col("first.row").alias("keep_row"), "group_size")


def frequent_digests(prints: DataFrame, share: float = SHARE) -> DataFrame:
    """(digest, keep_id, keep_row, group_size) of every digest that more than ``share`` of the rows have.

    ``freqItems`` keeps 1 / share Misra-Gries counters per task and merges them: it misses no
    frequent digest but may name others, so the named ones are counted over all rows. There are
    fewer than 1 / share rows.
    """
    named = prints.freqItems(["digest"], share).select(F.explode("digest_freqItems").alias("digest"))
    named = checkpoint(named.distinct())
    least = share * prints.count()
    counted = prints.join(F.broadcast(named), "digest").groupBy("digest").agg(*_winner())
    return checkpoint(_unpacked(counted.where(F.col("group_size") > least)))


def marked(docs: DataFrame, share: float = SHARE) -> DataFrame:
    """Per row: doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts the row with the most code points stays, then that with the smallest doc_id
    (null last); of rows that agree in both, any one, so that every group keeps just one row.
    Null texts count as empty, and empty or blank texts are equal like any others. Rows that repeat
    a doc_id are rows of their own. An empty table gives an empty table; other columns are ignored.
    """
    return _marked(fingerprinted(docs), share).select(
        "doc_id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256")
    )


def _marked(prints: DataFrame, share: float) -> DataFrame:
    heavy = F.broadcast(frequent_digests(prints, share))
    light = prints.join(heavy.select("digest"), "digest", "left_anti")
    groups = _unpacked(light.groupBy("digest").agg(*_winner()))
    columns = ("row", "doc_id", "digest", "keep_id", "keep_row", "group_size")
    return prints.join(heavy, "digest").select(*columns).union(light.join(groups, "digest").select(*columns))


def deduplicated(docs: DataFrame, share: float = SHARE) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; see ``marked`` for which.

    Copies of frequent texts go where they are read; of the rest, rows that are not kept go by a
    join on the row's number.
    """
    numbered = stored(docs.select(F.monotonically_increasing_id().alias("row"), F.struct("*").alias("doc")))
    prints = stored(numbered.select(
        "row", F.col("doc.doc_id").alias("doc_id"),
        F.unhex(F.sha2(normalised(F.col("doc.text")).cast("binary"), 256)).alias("digest"),
        F.length(F.coalesce(F.col("doc.text").cast("string"), F.lit(""))).cast("long").alias("n_chars"),
    ))
    gone = _marked(prints, share).where("row <> keep_row").select("row")
    return numbered.join(gone, "row", "left_anti").select("doc.*")


def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marked(table(spark, sf_dir, "documents"))
