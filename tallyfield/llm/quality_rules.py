"""Quality rules as a short-circuit cascade, in SQL functions only.

Every rule is a Boolean column over a text. Their cost and the share of rows each rejects are
measured on a bounded sample; the cascade tries the rules in falling order of rejections per
second and stops at the first that rejects. The order changes the work, never the verdict.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfield.llm.common import SPACE_CHARS, bind, bounded_sample, checkpoint, table, words

SYMBOLS = "#*$%&|<>"
WINDOW = 5
SAMPLE_ROWS = 1000


def word_chars(text: Column) -> Column:
    """Code points outside white space."""
    return F.length(F.translate(text, SPACE_CHARS, "")).cast("long")


def n_symbols(text: Column) -> Column:
    return (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long")


def lines(text: Column) -> Column:
    """Lines that hold a word."""
    return F.filter(F.split(text, "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))


def n_dup_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    return bind(lines(text), lambda found: (F.size(found) - F.size(F.array_distinct(found))).cast("long"))


def n_repeat_words(found: Column) -> Column:
    """Words inside five-word windows that occur twice or more; ``found`` is the array of words.

    Hashes of all windows tell the texts without any repetition; the others sort their windows
    as strings, so the count is exact.
    """

    def hashed(w: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.size(w) - WINDOW),
            lambda i: F.xxhash64(*(F.get(w, i + k) for k in range(WINDOW))),
        )

    def covered(w: Column) -> Column:
        windows = F.sort_array(
            F.transform(
                F.sequence(F.lit(1), F.size(w) - WINDOW + 1),
                lambda i: F.struct(F.array_join(F.slice(w, i, WINDOW), " ").alias("s"), i.alias("p")),
            )
        )

        def repeated(z: Column) -> Column:
            def same(j: Column, k: Column) -> Column:
                return F.coalesce(F.get(z, j)["s"] == F.get(z, k)["s"], F.lit(False))

            places = F.filter(
                F.sequence(F.lit(0), F.size(z) - 1), lambda j: same(j, j - 1) | same(j, j + 1)
            )
            return F.sort_array(F.transform(places, lambda j: F.get(z, j)["p"]))

        def total(p: Column) -> Column:
            steps = F.transform(
                F.sequence(F.lit(0), F.size(p) - 2),
                lambda k: F.least(F.get(p, k + 1) - F.get(p, k), F.lit(WINDOW)),
            )
            counted = F.aggregate(steps, F.lit(0), lambda a, x: a + x) + WINDOW
            return F.when(F.size(p) < 2, F.lit(0)).otherwise(counted)

        return bind(bind(windows, repeated), total)

    def count(w: Column) -> Column:
        def check(h: Column) -> Column:
            return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(w))

        return F.when(F.size(w) <= WINDOW, F.lit(0)).otherwise(bind(hashed(w), check))

    return bind(found, count).cast("long")


@dataclass(frozen=True)
class Rule:
    """``rejects`` makes a Boolean column, never null, of the text and the array of its words."""

    name: str
    rejects: Callable[[Column, Column], Column]


def default_rules() -> list[Rule]:
    """The first two are the base: too few words, too many repeated ones."""
    return [
        Rule("few_words", lambda t, w: F.size(w) < 10),
        Rule("repeated_words", lambda t, w: 100 * n_repeat_words(w) > 20 * F.size(w)),
        Rule("symbols", lambda t, w: 100 * n_symbols(t) > 25 * F.size(w)),
        Rule("repeated_lines", lambda t, w: bind(lines(t), lambda x: 2 * F.size(F.array_distinct(x)) < F.size(x))),
        Rule("word_length", lambda t, w: (word_chars(t) < 2 * F.size(w)) | (word_chars(t) > 20 * F.size(w))),
    ]


def _prepared(docs: DataFrame) -> DataFrame:
    """Rows packed away from any clashing names, with their text and words."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.struct("*").alias("doc"), text.alias("text"), words(F.col("text").cast("string")).alias("words"))


def ordered_rules(docs: DataFrame, rules: Sequence[Rule], sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """The rules by falling rejections per second, as measured on a sample of up to ``sample_rows`` rows."""
    sample = checkpoint(bounded_sample(docs.select("text"), "text", sample_rows))
    prepared = _prepared(sample)

    def timed(rejects: Column) -> tuple[float, int]:
        start = time.perf_counter()
        rejected = prepared.agg(F.count_if(rejects), F.max(F.size("words"))).first()[0]
        return time.perf_counter() - start, rejected

    timed(F.lit(False))
    idle = timed(F.lit(False))[0]
    gain = {}
    for rule in rules:
        seconds, rejected = timed(rule.rejects(F.col("text"), F.col("words")))
        gain[rule.name] = rejected / max(seconds - idle, 1e-3)
    return sorted(rules, key=lambda rule: (-gain[rule.name], rule.name))


def cascade(rules: Sequence[Rule], text: Column, found: Column) -> Column:
    """Name of the first rule that rejects, else null; later rules are then not evaluated."""
    verdict = F.when(rules[0].rejects(text, found), F.lit(rules[0].name))
    for rule in rules[1:]:
        verdict = verdict.when(rule.rejects(text, found), F.lit(rule.name))
    return verdict


def accepted(docs: DataFrame, rules: Sequence[Rule] | None = None) -> DataFrame:
    """The rows of ``docs`` that no rule rejects, with all their columns.

    A null text counts as empty and so has too few words. Repeated rows get one verdict each;
    other columns, null or clashing, are carried along. An empty table gives an empty table.
    """
    ordered = ordered_rules(docs, rules or default_rules())
    verdict = cascade(ordered, F.col("text"), F.col("words"))
    return _prepared(docs).where(verdict.isNull()).select("doc.*")


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, the measures of every row, base_failed and kept."""
    ordered = ordered_rules(docs, default_rules())
    text, found = F.col("text"), F.col("words")
    rows = _prepared(docs).select(
        F.col("doc.doc_id").alias("doc_id"), "text", "words",
        F.size(found).cast("long").alias("n_words"), word_chars(text).alias("word_chars"),
        n_symbols(text).alias("n_symbols"), n_dup_lines(text).alias("n_dup_lines"),
        n_repeat_words(found).alias("n_repeat_words"),
    )
    base = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    known = {"few_words": F.col("n_words") < 10, "repeated_words": base, "symbols": 100 * F.col("n_symbols") > 25 * F.col("n_words")}
    reuse = [Rule(r.name, (lambda t, w, c=known[r.name]: c) if r.name in known else r.rejects) for r in ordered]
    rows = rows.select("*", base.alias("base_failed"), (~base & cascade(reuse, text, found).isNull()).alias("kept"))
    return rows.drop("text", "words")


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measured(table(spark, sf_dir, "documents"))
