"""How the sources of a language differ in their words, over a minimal acyclic transducer vocabulary.

A first pass over the texts counts in how many documents of its language each term is. The kept
terms, sorted, get ordinals, and a second pass streams every text through a transducer of them to
count (language, source, term). The transducer that all tasks receive holds the terms of the most
documents, up to a fixed number and length; what it does not accept is counted per task and
dealt by hash to transducers of the remaining kept terms, each of bounded size. A task sums its
counts over many texts, and they move as packed rows: one for a group and a block of places, or a
group and a hash of terms. Sums, ratios and ranks are exact whole numbers, and equal values are
ordered by ordinal.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyfield.llm import transducer
from tallyfield.llm.common import slices, stored, table

MIN_DOCS, TOP_TERMS, SCALE = 3, 200, 1_000_000_000
# Terms, and bytes of a term, that the transducer sent to all tasks may hold; terms of one of the others.
HEAD_TERMS, HEAD_BYTES, SHARD_TERMS = 1 << 17, 64, 1 << 14
# Parts that the other terms are dealt to at least, so that a few of them do not meet in one task.
SHARDS = 64
# Different terms, counts, groups, or bytes of text, from which on a task puts out what it has counted.
TERMS_AT_ONCE, COUNTS_AT_ONCE, GROUPS_AT_ONCE, BYTES_AT_ONCE = 1 << 18, 1 << 20, 1 << 12, 1 << 25
# Places, or words, that a packed row may hold; sums that are put out together.
BLOCK, ROW_WORDS, SUMS_AT_ONCE = 1 << 11, 1 << 10, 1 << 16
# Parts that the rows of one language are dealt to.
SALTS = 64
# Products of term counts by which a task compares sources at once.
PAIRS_AT_ONCE = 1 << 20

# Letters A to Z become small, other ASCII characters than letters become zero.
LETTERS = np.array([b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 0 for b in range(256)], np.uint8)


def _read(docs: DataFrame) -> DataFrame:
    return docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))


def _letters(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, one after the other, with zeros for what is no letter; where each text begins and ends."""
    texts = texts.cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    return LETTERS[data], offsets - offsets[0]


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    for batch in slices(batches, 1024):
        if batch.num_rows:
            yield batch, *_letters(batch.column("text"))


def _documents_of_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, term, n): in how many of some texts of the language the term is."""
    seen: dict[str, Counter] = {}
    held = 0

    def found() -> Iterator[pa.RecordBatch]:
        for lang, counts in seen.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(counts), pa.string()), pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())],
                names=["lang", "term", "n"],
            )
        seen.clear()

    for batch, data, offsets in _batches(batches):
        text = data.tobytes().replace(b"\0", b" ")  # only blanks part words
        for lang, a, b in zip(batch.column("lang").to_pylist(), offsets[:-1], offsets[1:], strict=True):
            seen.setdefault(lang, Counter()).update(set(text[a:b].split()))
        held += len(data)
        if held >= BYTES_AT_ONCE or sum(map(len, seen.values())) >= TERMS_AT_ONCE:
            yield from found()
            held = 0
    yield from found()


def vocabulary(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(lang, term, n_docs, ordinal) of the terms in at least ``min_docs`` rows of their language.

    ``term`` is in UTF-8 bytes; the ordinals of a language ascend with them.
    """
    found = _read(docs).select("lang", "text").mapInArrow(_documents_of_terms, "lang string, term binary, n long")
    kept = found.groupBy("lang", "term").agg(F.sum("n").alias("n_docs")).where(F.col("n_docs") >= min_docs)
    placed = stored(kept.orderBy("lang", "term").withColumn("at", F.monotonically_increasing_id()))
    # The number of a row holds its partition above 33 bits, so the ordinal needs the rows of earlier ones.
    part = F.shiftright("at", 33)
    sizes = placed.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = F.broadcast(sizes.select("part", before.alias("before")))  # a row per partition
    numbered = placed.withColumn("part", part).join(offsets, "part")
    ordinal = F.col("before") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    return stored(numbered.select("lang", "term", "n_docs", ordinal.alias("ordinal")))


def _head(kept: DataFrame) -> Column:
    """Whether a kept term goes to the transducer of all tasks: as many of the most frequent ones as it may hold."""
    size = F.floor(F.log2("n_docs") * 8).cast("int")
    short = F.length("term") + F.octet_length("lang") <= HEAD_BYTES
    found = kept.where(short).groupBy(size.alias("size")).agg(F.count("*").alias("n")).collect()  # some hundred rows
    cut, total = None, 0
    for row in sorted(found, key=lambda r: -r["size"]):
        total += row["n"]
        if total > HEAD_TERMS:
            break
        cut = row["size"]
    return short & (size >= cut) if cut is not None else F.lit(False)


def _built(terms: list[tuple[str, bytes, int]]) -> tuple[transducer.Transducer, np.ndarray]:
    """Transducer of language, zero byte and term, and the ordinals by its places."""
    keyed = sorted((lang.encode() + b"\0" + term, ordinal) for lang, term, ordinal in terms)
    return transducer.build(k for k, _ in keyed), np.array([o for _, o in keyed], np.int64)


def _starts(machine: transducer.Transducer, langs: list[str]) -> tuple[np.ndarray, np.ndarray]:
    known = {lang: machine.start(lang.encode() + b"\0") for lang in set(langs)}
    both = np.array([known[lang] for lang in langs], np.int64).reshape(-1, 2)
    return both[:, 0], both[:, 1]


def _seed(lang: str) -> int:
    return zlib.crc32(lang.encode() + b"\0")


def _packed(groups: list[tuple[str, str]], counted: list[tuple[np.ndarray, np.ndarray]], n_terms: int, missed: list[Counter], n_shards: int) -> pa.RecordBatch:
    """What a task has counted: by group and block the places in it, by group and shard the words, ended by zeros; ``n`` are their counts."""
    rows: list[tuple] = []
    if counted:
        keys, where = np.unique(np.concatenate([k for k, _ in counted]), return_inverse=True)
        n = np.zeros(len(keys), np.int64)
        np.add.at(n, where, np.concatenate([n for _, n in counted]))
        n = n.astype(np.uint32)  # fewer than the bytes held
        group, place = np.divmod(keys, n_terms)
        block, at = np.divmod(place, BLOCK)
        at = at.astype(np.uint16)
        bounds = np.flatnonzero((np.diff(group) != 0) | (np.diff(block) != 0)) + 1
        for a, b in pairwise([0, *bounds.tolist(), len(keys)] if len(keys) else []):
            rows.append((*groups[group[a]], -1 - int(block[a]), at[a:b].tobytes(), n[a:b].tobytes()))
    for (lang, source), counts in zip(groups, missed, strict=True):
        seed, shards = _seed(lang), {}
        for word, n in counts.items():
            words, ns = shards.setdefault(zlib.crc32(word, seed) % n_shards, ([], []))
            words.append(word)
            ns.append(n)
        for shard, (words, ns) in shards.items():
            for k in range(0, len(words), ROW_WORDS):
                some = words[k : k + ROW_WORDS]
                rows.append((lang, source, shard, b"\0".join(some) + b"\0", np.array(ns[k : k + ROW_WORDS], np.uint32).tobytes()))
    kinds = {"lang": pa.string(), "source": pa.string(), "part": pa.int32(), "words": pa.binary(), "n": pa.binary()}
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds.values())], names=list(kinds))


def _streamed(batches: Iterator[pa.RecordBatch], machine: transducer.Transducer, n_shards: int) -> Iterator[pa.RecordBatch]:
    """Packed counts of the texts' terms by place; of terms that the transducer does not accept by the terms themselves, if there are shards for them."""
    groups: dict[tuple, int] = {}
    counted: list[tuple[np.ndarray, np.ndarray]] = []
    missed: list[Counter] = []
    n_terms, held = max(1, machine.n), 0
    for batch, data, offsets in _batches(batches):
        letter = data > 0
        edge = np.concatenate([[False], letter, [False]])
        starts, ends = letter & ~edge[:-2], letter & ~edge[2:]
        inner = offsets[offsets < len(data)]
        starts[inner] = letter[inner]
        inner = offsets[offsets > 0] - 1
        ends[inner] = letter[inner]
        begin, end = np.flatnonzero(starts), np.flatnonzero(ends) + 1
        pairs = zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), strict=True)
        group_of_doc = np.array([groups.setdefault(pair, len(groups)) for pair in pairs], np.int64)
        missed += [Counter() for _ in range(len(groups) - len(missed))]
        group = np.repeat(group_of_doc, np.diff(np.searchsorted(begin, offsets)))
        state, total = _starts(machine, [lang for lang, _ in groups])
        place = machine.places(data, begin, end, state[group], total[group])
        hit = place >= 0
        counted.append(np.unique(group[hit] * n_terms + place[hit], return_counts=True))
        if n_shards:
            inside = np.zeros(len(data) + 1, np.int8)  # 1 in accepted words
            inside[begin[hit]] += 1
            inside[end[hit]] -= 1
            text = np.where(letter & (np.cumsum(inside[:-1], dtype=np.int8) == 0), data, 32).astype(np.uint8).tobytes()
            for x, a, b in zip(group_of_doc.tolist(), offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                missed[x].update(text[a:b].split())
        held += len(data)
        full = held >= BYTES_AT_ONCE or len(groups) >= GROUPS_AT_ONCE
        if full or sum(len(k) for k, _ in counted) >= COUNTS_AT_ONCE or sum(map(len, missed)) >= TERMS_AT_ONCE:
            yield _packed(list(groups), counted, n_terms, missed, n_shards)
            groups, counted, missed, held = {}, [], [], 0
    yield _packed(list(groups), counted, n_terms, missed, n_shards)


def _summed(batches: Iterator[pa.RecordBatch], head: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(lang, source, ordinal, n) of packed counts sorted by part and group.

    ``head`` has the ordinals by place of the transducer that all tasks have. In each shard its kept
    terms come first: they make the transducer that the others go through.
    """
    part, terms, machine, ordinals = None, [], None, None
    group, sums = None, None
    out: list[tuple[str, str, np.ndarray, np.ndarray]] = []
    held = 0

    def close() -> int:
        """Puts the sums of the group by; how many there are."""
        at = np.flatnonzero(sums) if group is not None else []
        if len(at):
            out.append((*group, ordinals[at], sums[at]))
        return len(at)

    def put() -> pa.RecordBatch:
        sizes = [len(n) for *_, n in out]
        columns = [pa.array(np.repeat(np.array([x[k] for x in out], object), sizes), pa.string()) for k in (0, 1)]
        columns += [pa.array(np.concatenate([x[k] for x in out]), pa.int64()) for k in (2, 3)]
        out.clear()
        return pa.RecordBatch.from_arrays(columns, names=["lang", "source", "ordinal", "n"])

    for batch in batches:
        bounds = np.flatnonzero(np.diff(batch.column("part").to_numpy())) + 1
        for a, b in pairwise([0, *bounds.tolist(), batch.num_rows] if batch.num_rows else []):
            rows = batch.slice(a, b - a)
            if rows.column("part")[0].as_py() != part:
                held += close()
                part, terms, machine, group = rows.column("part")[0].as_py(), [], None, None
                ordinals = head[(-1 - part) * BLOCK : -part * BLOCK] if part < 0 else None
            known = int(rows.column("known").to_numpy().sum())
            terms += zip(*(rows.slice(0, known).column(c).to_pylist() for c in ("lang", "words", "ordinal")), strict=True)
            rows = rows.slice(known)
            if not rows.num_rows or part >= 0 and not terms:
                continue
            langs, sources, counts = (rows.column(c).to_pylist() for c in ("lang", "source", "n"))
            if part < 0:
                places = [np.frombuffer(x, np.uint16) for x in rows.column("words").to_pylist()]
            else:
                if machine is None:
                    machine, ordinals = _built(terms)
                data = np.frombuffer(b"".join(rows.column("words").to_pylist()), np.uint8)
                end = np.flatnonzero(data == 0)
                sizes = np.array([len(x) // 4 for x in counts])
                state, total = _starts(machine, langs)
                place = machine.places(data, np.concatenate([[0], end[:-1] + 1]), end, np.repeat(state, sizes), np.repeat(total, sizes))
                places = np.split(place, np.cumsum(sizes)[:-1])
            for *now, place, n in zip(langs, sources, places, counts, strict=True):
                if group != now:
                    held += close()
                    group, sums = now, np.zeros(len(ordinals), np.int64)
                    if held >= SUMS_AT_ONCE:
                        yield put()
                        held = 0
                hit = place >= 0
                sums[place[hit]] += np.frombuffer(n, np.uint32)[hit]  # a row has no place twice
    close()
    if out:
        yield put()


def recounted(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """(lang, source, ordinal, n) of every kept term of ``vocabulary`` that a group has."""
    spark = docs.sparkSession
    in_head = _head(kept)
    head = kept.where(in_head).select("lang", "term", "ordinal").collect()  # at most HEAD_TERMS short terms
    n_tail = kept.count() - len(head)
    n_shards = max(-(-n_tail // SHARD_TERMS), min(SHARDS, n_tail))
    shared: Broadcast = spark.sparkContext.broadcast(_built([tuple(row) for row in head]))

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _streamed(batches, shared.value[0], n_shards)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _summed(batches, shared.value[1])

    none = F.lit(None)
    packed = _read(docs).mapInArrow(stream, "lang string, source string, part int, words binary, n binary")
    packed = packed.select("part", F.lit(0).alias("known"), "lang", "source", none.cast("long").alias("ordinal"), "words", "n")
    if n_shards:
        shard = F.pmod(F.crc32(F.concat(F.encode("lang", "UTF-8"), F.lit(bytearray(1)), "term")), F.lit(n_shards)).cast("int")
        tail = kept.where(~in_head).select(shard.alias("part"), F.lit(1).alias("known"), "lang", none.cast("string").alias("source"), "ordinal", F.col("term").alias("words"), none.cast("binary").alias("n"))
        packed = packed.union(tail)
    own = F.col("part") < 0  # a block of a group is apart from those of others
    dealt = packed.repartition("part", F.when(own, F.col("lang")), F.when(own, F.col("source")))
    dealt = dealt.sortWithinPartitions("part", F.desc("known"), "lang", "source")
    return stored(dealt.mapInArrow(add, "lang string, source string, ordinal long, n long"))


def _ratio(n: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (n + 1) / (total + terms)), exactly; null without terms."""
    upper = F.lit(SCALE).cast("decimal(10,0)") * (n + 1).cast("decimal(19,0)")
    lower = F.when(terms > 0, (total + terms).cast("decimal(19,0)"))
    return 1 + F.call_function("div", upper, lower)


def _excess(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / q); shares are at most SCALE + 1, so the square is a long."""
    return F.call_function("div", (p - q) * (p - q), q)


def _salted(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """Every row with every group of its language, the language's rows dealt to SALTS parts."""
    salt = F.pmod(F.xxhash64("source", "p"), F.lit(SALTS)).cast("int")
    other = groups.select("lang", F.col("source").alias("other"), F.col("zero").alias("other_zero"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    return rows.withColumn("salt", salt).join(other, ["lang", "salt"]).where("source <> other").drop("salt")


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, other, value): what terms that both sources have add to their value beyond what each adds alone."""

    def f(p: np.ndarray, q: np.ndarray) -> np.ndarray:
        return (p - q) * (p - q) // q

    for batch in batches:
        if not batch.num_rows:
            continue
        lists = batch.column("at")
        offsets = np.asarray(lists.offsets, np.int64)
        inner = lists.values
        langs, sources = batch.column("lang").to_pylist(), inner.field("source").to_pylist()
        p, zero = (np.asarray(inner.field(c), np.int64) for c in ("p", "zero"))
        sizes = np.diff(offsets)
        groups: dict[tuple, int] = {}
        code = np.zeros(len(sources), np.int64)
        for lang, a, b in zip(langs, offsets[:-1], offsets[1:], strict=True):
            for k in range(a, b):
                code[k] = groups.setdefault((lang, sources[k]), len(groups))
        sums: Counter = Counter()
        for size in np.unique(sizes[sizes > 1]):
            rows = np.flatnonzero(sizes == size)
            step = max(1, PAIRS_AT_ONCE // int(size) ** 2)
            for a in range(0, len(rows), step):
                at = offsets[rows[a : a + step]][:, None] + np.arange(size)
                x, y, zx, zy = p[at][:, :, None], p[at][:, None, :], zero[at][:, :, None], zero[at][:, None, :]
                value = f(x, y) - f(x, zy) - f(zx, y) + f(zx, zy)
                pair = code[at][:, :, None] * len(groups) + code[at][:, None, :]
                keys, where = np.unique(pair, return_inverse=True)
                total = np.zeros(len(keys), np.int64)
                np.add.at(total, where.ravel(), value.ravel())
                for k, v in zip(keys.tolist(), total.tolist(), strict=True):
                    sums[k] += v
        names = list(groups)
        pairs = [(names[k // len(names)], names[k % len(names)], v) for k, v in sums.items() if k // len(names) != k % len(names)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([x[0] for x, _, _ in pairs], pa.string()), pa.array([x[1] for x, _, _ in pairs], pa.string()),
             pa.array([y[1] for _, y, _ in pairs], pa.string()), pa.array([v for _, _, v in pairs], pa.decimal128(38, 0))],
            names=["lang", "source", "other", "value"],
        )


def audited(docs: DataFrame, min_docs: int = MIN_DOCS, top_terms: int = TOP_TERMS) -> DataFrame:
    """(lang, source, part, item, value, rank): how the sources of each language differ.

    Null texts, languages and sources count as empty. Every row is a document of its own, also if
    it repeats an id. A group without terms takes part in ``pair`` with zero counts; a language
    with one source, or without kept terms, gives no row, or rows of value 0. An empty table gives
    an empty table; further columns are ignored.

    A row of ``pair`` exists for any two sources of a language, so lists of a term's sources are
    no longer than the square root of the result. A value is the sum over all kept terms: what
    absent terms add, what the counts of either side add on their own, by their distinct shares,
    and a correction for terms that both have.
    """
    kept = vocabulary(docs, min_docs)
    counts = recounted(docs, kept)
    terms = kept.groupBy("lang").agg(F.count("*").alias("n_terms"))
    sums = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    langs = sums.groupBy("lang").agg(F.sum("total").alias("lang_total"))
    groups = _read(docs).select("lang", "source").distinct().join(sums, ["lang", "source"], "left").join(terms, "lang", "left").join(langs, "lang", "left")
    groups = groups.select("lang", "source", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("total", "n_terms", "lang_total")))
    groups = stored(groups.withColumn("zero", _ratio(F.lit(0), F.col("total"), F.col("n_terms"))))

    shares = counts.join(groups, ["lang", "source"]).withColumn("p", _ratio(F.col("n"), F.col("total"), F.col("n_terms")))
    by_term = stored(shares.groupBy("lang", "ordinal").agg(
        _ratio(F.sum("n"), F.max("lang_total"), F.max("n_terms")).alias("q"), F.collect_list(F.struct("source", "n", "p", "zero")).alias("at")
    ))
    each = by_term.select("lang", "ordinal", "q", F.inline("at"))

    top = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "ordinal")
    ranked = each.where("p > q").select("lang", "source", "ordinal", _excess(F.col("p"), F.col("q")).alias("value"))
    ranked = ranked.withColumn("rank", F.row_number().over(top)).where(F.col("rank") <= top_terms)
    names = kept.select("lang", "ordinal", F.col("term").cast("string").alias("item"))
    term_part = ranked.join(names, ["lang", "ordinal"]).select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank")

    p, other, zero = F.col("p"), F.col("other_zero"), F.col("zero")
    alone = _salted(each.groupBy("lang", "source", "p", "zero").agg(F.count("*").alias("n")), groups)
    absent = F.col("n_terms") * _excess(zero, other)
    pairs = _salted(groups.withColumn("p", zero), groups)
    wide = "decimal(38,0)"
    parts = [
        pairs.select("lang", "source", "other", F.coalesce(absent, F.lit(0)).cast(wide).alias("value")),
        alone.select("lang", "source", "other", ((_excess(p, other) - _excess(zero, other)).cast(wide) * F.col("n")).cast(wide).alias("value")),
        alone.select("lang", F.col("other").alias("source"), F.col("source").alias("other"), ((_excess(other, p) - _excess(other, zero)).cast(wide) * F.col("n")).cast(wide).alias("value")),
        by_term.select("lang", "at").mapInArrow(_met, f"lang string, source string, other string, value {wide}"),
    ]
    total = parts[0]
    for more in parts[1:]:
        total = total.union(more)
    total = total.groupBy("lang", "source", "other").agg(F.sum("value").cast("long").alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "other")
    pair_part = total.select("lang", "source", F.lit("pair").alias("part"), F.col("other").alias("item"), "value", F.row_number().over(order).alias("rank"))
    return pair_part.union(term_part)


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audited(table(spark, sf_dir, "documents"))
