"""Scoring texts with a class-based bigram model (Brown classes by exchange clustering).

Classes are found in two steps, both by exchange: units move between classes while the likelihood
of the class bigrams grows. First the most frequent words, and groups of the others by their last
letters, are exchanged on the driver. Then every further word of ``MIN_COUNT`` occurrences moves by
itself, in rounds over a table of all words with the classes that come before them; the table and
the rounds are Spark's, so the clustered words grow with the corpus. Only rarer words keep the class
of their group. As the word before, a word beyond the most frequent ones stands for its group.

A word's probability mixes two ways to it: the class of the word before gives the class and the
class emits the word, or the word comes by its own frequency. Both share the word's smoothed
count, so that the score is the sum of its logarithm and a term of classes alone.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfield.llm.common import crc_bucket, slices, stored, table

END = ""
# Units of the first step: the end, the most frequent words, and groups of the others.
FREQUENT, GROUPS = 500, 900
UNITS = 1 + FREQUENT + GROUPS
CLASSES, ROUNDS = 48, 12
# The second step: words that occur less often stay with their group; rounds over all the others.
MIN_COUNT, WORD_ROUNDS = 3, 3
# At most so many words are known to every task; the others are joined.
KNOWN = 200_000
SMOOTH, MIX = 0.5, 0.95
FLUSH, TOKENS = 300_000, 1 << 21


def tokens(text: str | None) -> list[bytes]:
    """Words in lower case (A-Z), then the end."""
    return [*(text or "").encode("utf-8", "surrogatepass").lower().split(), b""]


def group_of(word: bytes) -> int:
    """The group of a word by its last letters."""
    return zlib.crc32(word[-3:]) % GROUPS


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()

    def flushed() -> pa.RecordBatch:
        columns = [pa.array([w.decode("utf-8") for w in counts], pa.string()), pa.array(list(counts.values()), pa.int64())]
        counts.clear()
        return pa.RecordBatch.from_arrays(columns, names=["word", "n"])

    for batch in slices(batches):
        for text in batch.column("text").to_pylist():
            counts.update(tokens(text))
        if len(counts) >= FLUSH:
            yield flushed()
    if counts:
        yield flushed()


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, n) over all texts; the end is the empty word."""
    return texts.select("text").mapInArrow(_counted, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def known_words(counts: DataFrame) -> tuple[list[str], np.ndarray]:
    """The end and the most frequent words in order, with their counts: ``KNOWN`` words at most.

    Counts are put into classes of their logarithm, and whole classes are taken from above.
    """
    level = F.floor(F.log2("n") * 16)
    sizes = counts.groupBy(level.alias("level")).count().collect()
    taken, least = 0, None
    for row in sorted(sizes, key=lambda r: -r["level"]):
        taken += row["count"]
        if taken > KNOWN:
            break
        least = row["level"]
    rows = counts.where((F.col("word") == END) | (level >= least if least is not None else F.lit(False))).toArrow()
    pairs = zip(rows.column("word").to_pylist(), rows.column("n").to_pylist(), strict=True)
    found = sorted(pairs, key=lambda p: (p[0] != END, -p[1], p[0]))
    if not found or found[0][0] != END:
        found.insert(0, (END, 0))
    return [w for w, _ in found], np.array([n for _, n in found], np.int64)


class Lexicon:
    """The words that a task knows, by number, and the units of all words."""

    def __init__(self, words: list[str]) -> None:
        self.ids = {w.encode("utf-8"): i for i, w in enumerate(words)}
        self.units = np.array([i if i <= FREQUENT else 1 + FREQUENT + group_of(w) for w, i in self.ids.items()], np.int64)

    def read(self, found: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[int]]:
        """Numbers (-1: unknown here) and units of words, and the places of the unknown ones."""
        get = self.ids.get
        ids = np.array([get(w, -1) for w in found], np.int64)
        units = self.units[ids]
        rest = np.flatnonzero(ids < 0).tolist()
        for i in rest:
            units[i] = 1 + FREQUENT + group_of(found[i])
        return ids, units, rest


def _previous(units: np.ndarray) -> np.ndarray:
    """The unit before each token; texts end with an end and begin after one."""
    return np.concatenate([[0], units[:-1]])


def contexts(texts: DataFrame, words: list[str]) -> DataFrame:
    """(id, word, unit, previous, n): how often a word follows a unit, not yet added over tasks.

    Words of ``words`` go by their number, all others (id -1) by themselves.
    """
    given = texts.sparkSession.sparkContext.broadcast(words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(given.value)
        codes: list[np.ndarray] = []
        rest: Counter = Counter()
        size = 0

        def flushed() -> Iterator[pa.RecordBatch]:
            both, n = np.unique(np.concatenate(codes), return_counts=True)
            ids = both // UNITS
            others = [w for w, _ in rest]
            columns = [
                np.concatenate([ids, np.full(len(rest), -1)]).astype(np.int32),
                pa.concat_arrays([pa.nulls(len(ids), pa.string()), pa.array([w.decode("utf-8") for w in others], pa.string())]),
                np.concatenate([lexicon.units[ids], np.array([1 + FREQUENT + group_of(w) for w in others], np.int64)]).astype(np.int32),
                np.concatenate([both % UNITS, np.array([u for _, u in rest], np.int64)]).astype(np.int32),
                np.concatenate([n, np.array(list(rest.values()), np.int64)]),
            ]
            out = pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names=["id", "word", "unit", "previous", "n"])
            codes.clear()
            rest.clear()
            yield from slices(iter([out]), 1 << 16)

        for batch in slices(batches, 64):
            found = [w for text in batch.column("text").to_pylist() for w in tokens(text)]
            ids, units, odd = lexicon.read(found)
            before = _previous(units)
            here = ids >= 0
            codes.append(ids[here] * UNITS + before[here])
            rest.update(zip([found[i] for i in odd], before[odd].tolist(), strict=True))
            size += len(found)
            if size >= TOKENS or len(rest) >= FLUSH:
                yield from flushed()
                size = 0
        if size:
            yield from flushed()

    return texts.select("text").mapInArrow(run, "id int, word string, unit int, previous int, n long")


def unit_bigrams(found: DataFrame) -> np.ndarray:
    """How often one unit follows another. Bounded by the square of the units."""
    rows = found.groupBy("previous", "unit").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros((UNITS, UNITS), np.int64)
    out[rows.column("previous").to_numpy(), rows.column("unit").to_numpy()] = rows.column("n").to_numpy()
    return out


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def exchange(bigrams: np.ndarray, classes: int = CLASSES, rounds: int = ROUNDS) -> np.ndarray:
    """Class of every unit. The end (unit 0) is class 0 alone; the others move where the likelihood grows most."""
    n = len(bigrams)
    weight = bigrams.sum(axis=0) + bigrams.sum(axis=1)
    order = [int(u) for u in np.argsort(-weight, kind="stable") if u != 0 and weight[u] > 0]
    label = np.zeros(n, np.int64)
    label[1:] = 1
    for i, u in enumerate(order):
        label[u] = 1 + i % (classes - 1)
    member = np.zeros((n, classes))
    member[np.arange(n), label] = 1
    b = member.T @ bigrams @ member
    for _ in range(rounds):
        moved = 0
        for u in order:
            old, own = label[u], float(bigrams[u, u])
            member[u, old] = 0
            after, before = bigrams[u] @ member, bigrams[:, u] @ member
            b[old] -= after
            b[:, old] -= before
            b[old, old] -= own
            # Words of the classes as they come first and second, without this unit.
            rows, columns = b.sum(axis=1) + before, b.sum(axis=0) + after
            gain_row, gain_column = _xlogx(b + after[None, :]) - _xlogx(b), _xlogx(b + before[:, None]) - _xlogx(b)
            d = np.diag(b)
            gain = gain_row.sum(axis=1) - np.diag(gain_row) + gain_column.sum(axis=0) - np.diag(gain_column)
            gain += _xlogx(d + after + before + own) - _xlogx(d)
            gain -= _xlogx(rows + after.sum() + own) - _xlogx(rows)
            gain -= _xlogx(columns + before.sum() + own) - _xlogx(columns)
            gain[0] = -np.inf
            new = int(gain.argmax())
            if gain[new] <= gain[old] + 1e-9:
                new = int(old)
            moved += new != old
            label[u] = new
            member[u, new] = 1
            b[new] += after
            b[:, new] += before
            b[new, new] += own
        if not moved:
            break
    return label


def _constant(values, kind: str) -> Column:
    """An array of numbers as one literal."""
    return F.split(F.lit(",".join(map(repr, np.asarray(values).tolist()))), ",").cast(f"array<{kind}>")


def word_contexts(found: DataFrame, label: np.ndarray) -> DataFrame:
    """(id, word, unit, n, e, context): every word with the classes before it and the class of its unit.

    Known words can be hot, so they are added up in every task before they move; each of the others is
    rarer than all known ones, so that their rows may move as they are.
    """
    classes = _constant(label, "int")
    rows = found.select("id", "word", "unit", F.get(classes, F.col("previous")).alias("h"), "n")

    def gathered(part: DataFrame, key: str) -> DataFrame:
        once = part.groupBy(key, "unit", "h").agg(F.sum("n").alias("x"))
        return once.groupBy(key, "unit").agg(F.sum("x").alias("n"), F.sort_array(F.collect_list(F.struct("h", "x"))).alias("context"))

    known = gathered(rows.where("id >= 0"), "id").withColumn("word", F.lit(None).cast("string"))
    others = gathered(rows.where("id < 0").repartition("word"), "word").withColumn("id", F.lit(-1))
    return known.unionByName(others).select("id", "word", "unit", "n", F.get(classes, F.col("unit")).alias("e"), "context")


def class_table(rows: DataFrame) -> np.ndarray:
    """How often a class (column) comes after another (row)."""
    counted = rows.select("e", F.explode("context").alias("c")).groupBy("c.h", "e").agg(F.sum("c.x").alias("n")).collect()
    out = np.zeros((CLASSES, CLASSES))
    for h, e, n in counted:
        out[h, e] = n
    return out


def likelihood(table: np.ndarray) -> float:
    """The part of the log likelihood of all words that depends on their classes."""
    return float(_xlogx(table).sum() - _xlogx(table.sum(axis=0)).sum())


def better_classes(h: np.ndarray, x: np.ndarray, lengths: np.ndarray, old: np.ndarray, n: np.ndarray, table: np.ndarray) -> np.ndarray:
    """The class of every word in which the likelihood is largest, all others staying where they are.

    Words have ``lengths`` entries each: ``x`` times after class ``h``. Nothing joins the end's class 0, or an
    empty one, where all words would meet.
    """
    own, row = np.repeat(old, lengths), np.arange(len(old))
    gain = _xlogx(table[h] + x[:, None]) - _xlogx(table)[h]
    here = table[h, own]
    gain[np.arange(len(h)), own] = _xlogx(here) - _xlogx(here - x)
    sums = table.sum(axis=0)
    cost = _xlogx(sums[None, :] + n[:, None]) - _xlogx(sums)[None, :]
    cost[row, old] = _xlogx(sums[old]) - _xlogx(sums[old] - n)
    score = np.add.reduceat(gain, np.cumsum(lengths) - lengths, axis=0) - cost
    score[:, (sums == 0) | (np.arange(len(sums)) == 0)] = -np.inf
    best = score.argmax(axis=1)
    return np.where(score[row, best] > score[row, old] + 1e-9, best, old)


def _moved(rows: DataFrame, table: np.ndarray) -> DataFrame:
    given = rows.sparkSession.sparkContext.broadcast(table)
    at = rows.columns.index("e")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2048):
            context = batch.column("context")
            h, x = (c.to_numpy() for c in context.flatten().flatten())
            lengths = pc.list_value_length(context).to_numpy()
            old, n = batch.column("e").to_numpy(), batch.column("n").to_numpy()
            new = better_classes(h, x.astype(float), lengths, old, n.astype(float), given.value)
            arrays = list(batch.columns)
            arrays[at] = pa.array(new.astype(np.int32))
            yield pa.RecordBatch.from_arrays(arrays, schema=batch.schema)

    return rows.mapInArrow(run, rows.schema)


def exchanged(rows: DataFrame, fixed: np.ndarray) -> tuple[DataFrame, np.ndarray]:
    """The words in better classes, and the table of classes; ``fixed`` has the words that stay.

    In a round all words move at once; a round that makes the likelihood no larger is the last and is left out.
    """
    table = fixed + class_table(rows)
    for _ in range(WORD_ROUNDS):
        moved = stored(_moved(rows, table))
        new = fixed + class_table(moved)
        if likelihood(new) <= likelihood(table):
            break
        rows, table = moved, new
    return rows, table


@dataclass
class Model:
    """Known words with log counts and classes, classes of units, terms of class pairs, and all further words."""

    words: list[str]
    counts: np.ndarray
    emitted: np.ndarray
    label: np.ndarray
    term: np.ndarray
    total: int
    distinct: int
    others: DataFrame

    @property
    def base_mass(self) -> float:
        return self.total + 0.5 * (self.distinct + 1)


def fit(texts: DataFrame, counts: DataFrame) -> Model:
    """The model of the texts, given their word counts.

    The driver gets at most ``KNOWN`` words and their classes, unit bigrams and tables of classes, all of
    bounded size; every count comes from all texts. ``others`` has word, n and class e of all further words.
    """
    total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    words, n = known_words(counts)
    found = stored(contexts(texts, words))
    label = exchange(unit_bigrams(found))
    every = stored(word_contexts(found, label))
    moving = (F.col("n") >= MIN_COUNT) & (F.col("unit") > FREQUENT)
    moved, table = exchanged(every.where(moving), class_table(every.where(~moving)))
    every = every.where(~moving).union(moved).select("id", "word", "n", "e")
    mass, types = np.zeros(CLASSES), np.zeros(CLASSES)
    for row in every.groupBy("e").agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect():
        mass[row["e"]], types[row["e"]] = row["n"], row["v"]
    emitted = np.zeros(len(words), np.int64)
    classes = every.where("id >= 0").select("id", "e").toArrow()
    emitted[classes.column("id").to_numpy()] = classes.column("e").to_numpy()
    follows = (table + SMOOTH) / (table.sum(axis=1, keepdims=True) + SMOOTH * CLASSES)
    emits = mass + 0.5 * (types + 1)
    # Every class has one unknown word, so the words' own frequencies have one per class too.
    own = total + 0.5 * (distinct + CLASSES)
    term = np.log10(MIX * follows / emits[None, :] + (1 - MIX) / own)
    return Model(words, n, emitted, label, term, total, distinct, every.where("id < 0").select("word", F.col("n").alias("count"), "e"))


_PARTS = "doc_id long, text_key long, n_tokens long, n_known long, known_log double, class_log double, rest array<struct<word: string, h: int, e: int>>"


def scored(docs: DataFrame, training: DataFrame) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score and score of every row of ``docs``.

    ``training`` holds the texts to learn from (a text column). A null or blank text has the end
    as its only token. Rows equal in doc_id and text are scored once and returned as often as
    they occur; a null doc_id is a key like any other. Without training texts every token is
    unknown. An empty table gives an empty table; further columns are ignored.

    Counts and classes of frequent words go to every task; the other words of a text are joined with
    those of all words, so that every count takes part.
    """
    texts = training.select(F.col("text").cast("string").alias("text"))
    counts = stored(word_counts(texts))
    model = fit(texts, counts)
    given = docs.sparkSession.sparkContext.broadcast((model.words, model.counts, model.emitted, model.label, model.term))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, n, emitted, label, term = given.value
        lexicon, logs = Lexicon(words), np.log10(n + 0.5)
        for batch in slices(batches, 64):
            texts = [tokens(text) for text in batch.column("text").to_pylist()]
            found = [w for text in texts for w in text]
            ids, units, odd = lexicon.read(found)
            before, here = label[_previous(units)], ids >= 0
            sizes = np.array([len(text) for text in texts])
            starts = np.cumsum(sizes) - sizes
            known_log = np.where(here, logs[ids], 0)
            class_log = np.where(here, term[before, emitted[ids]], 0)
            # The unknown words of all texts in a row, and where those of each text begin.
            firsts = np.searchsorted(odd, np.append(starts, len(found)))
            rest = pa.StructArray.from_arrays(
                [pa.array([found[i].decode("utf-8") for i in odd], pa.string()), pa.array(before[odd].astype(np.int32)), pa.array(label[units[odd]].astype(np.int32))],
                names=["word", "h", "e"],
            )
            columns = [
                pa.array(sizes), pa.array(np.add.reduceat(here & (n[ids] > 0), starts, dtype=np.int64)),
                pa.array(np.add.reduceat(known_log, starts)), pa.array(np.add.reduceat(class_log, starts)),
                pa.ListArray.from_arrays(pa.array(firsts.astype(np.int32)), rest),
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"), *columns],
                names=["doc_id", "text_key", "n_tokens", "n_known", "known_log", "class_log", "rest"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.select("doc_id", F.xxhash64("text").alias("text_key"), "text").mapInArrow(run, _PARTS)
    # A name of its own, which no word has, carries what is known of the row already.
    nothing = [F.lit(0).alias(c) for c in ("h", "e")]
    own = F.struct(F.concat(F.lit(" "), F.col("text_key").cast("string")).alias("word"), *nothing)
    parts = rows.select("*", F.posexplode(F.concat(F.array(own), F.col("rest"))).alias("pos", "item"))
    head = F.col("pos") == 0
    parts = parts.select(
        "doc_id", "text_key", F.col("item.word").alias("word"), F.col("item.h").alias("h"), F.col("item.e").alias("unit_e"), F.when(head, 0).otherwise(1).alias("times"),
        *(F.when(head, F.col(c)).alias(c) for c in ("n_tokens", "n_known", "known_log", "class_log")),
    )
    joined = parts.join(model.others, "word", "left")
    term = F.get(_constant(model.term.ravel(), "double"), F.col("h") * CLASSES + F.coalesce("e", "unit_e"))
    smoothed = F.log10(F.coalesce("count", F.lit(0)) + 0.5)
    sums = joined.groupBy("doc_id", "text_key").agg(
        F.count("n_tokens").alias("copies"), F.sum("n_tokens").alias("n_tokens"),
        (F.sum("n_known") + F.sum(F.when(F.col("count").isNotNull(), F.col("times")).otherwise(0))).alias("n_known"),
        (F.sum("known_log") + F.sum(F.col("times") * smoothed)).alias("logs"), (F.sum("class_log") + F.sum(F.col("times") * term)).alias("class_log"),
    )
    once = sums.select(
        "doc_id", "copies", *(F.expr(f"{c} div copies").alias(c) for c in ("n_tokens", "n_known")),
        *((F.col(c) / F.col("copies")).alias(c) for c in ("logs", "class_log")),
    )
    return once.select(
        "doc_id", "n_tokens", "n_known", F.lit(int(model.total)).cast("long").alias("train_tokens"),
        (F.col("logs") - F.col("n_tokens") * float(np.log10(model.base_mass))).alias("base_score"),
        (F.col("logs") + F.col("class_log")).alias("score"), F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("_copy"),
    ).drop("_copy")


def op7_brown_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = crc_bucket(F.col("doc_id")) == 1
    result = scored(docs, docs.where(~held_out))
    return result.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
