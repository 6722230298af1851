"""Exact duplicates, divergence of sources and the trie of conversations, against plain Python."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from conftest import rows_of
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyfield.llm import exact_dedup, prefix_trie, source_divergence, transducer

DOCS = "doc_id long, text string, lang string, source string"


def bare(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


def marks(docs):
    groups = defaultdict(list)
    for k, (doc_id, text, *_) in enumerate(docs):
        groups[bare(text)].append((-len(text or ""), doc_id is None, doc_id or 0, k))
    out = []
    for text, rows in groups.items():
        first = min(rows)
        sha = hashlib.sha256(text.encode()).hexdigest()
        name = lambda r: None if r[1] else r[2]
        out += [(name(r), name(first), len(rows), r == first, sha) for r in rows]
    return sorted(out, key=repr)


@pytest.mark.parametrize("share", [0.001, 0.2])
def test_equal_texts(frame, share):
    docs = [(i, f"text {i % 7}" + " " * (i % 3), "en", "a") for i in range(40)]
    docs += [(100 + i, "été \t\n" * 3, None, None) for i in range(30)]  # frequent
    docs += [(None, "text 1", "en", "a"), (None, None, None, None), (5, "", "", ""), (6, " \x0b\x0c\r", "", ""), (7, " ", "", ""), (7, " ", "", "")]
    docs += [(8, "same  length", "", ""), (8, "same length ", "", ""), (9, "x" * 300_000, "", ""), (10, "x" * 300_000 + " ", "", "")]
    df = frame(docs, DOCS)
    got = exact_dedup.marked(df.withColumns({"digest": F.lit(1), "row": F.lit(2), "kept": F.lit("x"), "first": F.lit(0)}), share)
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert rows_of(got) == marks(docs)
    left = exact_dedup.deduplicated(df.withColumn("row", F.lit("mine")), share)
    assert left.columns == [*df.columns, "row"]
    kept = [row for row in marks(docs) if row[3]]
    assert sorted(bare(r["text"]) for r in left.collect()) == sorted({bare(t) for _, t, *_ in docs})
    assert sorted((r["doc_id"] for r in left.collect()), key=str) == sorted((r[0] for r in kept), key=str)


def test_frequent_digests_are_verified(frame):
    """Counters name digests that are not frequent; all that are get found."""
    docs = [(i, "often" if i % 3 == 0 else f"rare {i}", "en", "a") for i in range(3000)]
    prints = exact_dedup.fingerprinted(frame(docs, DOCS).repartition(5))
    heavy = exact_dedup.frequent_digests(prints, 0.01).collect()
    assert [(r["keep_id"], r["group_size"]) for r in heavy] == [(0, 1000)]


def test_no_python_in_exact_dedup(frame):
    plan = exact_dedup.marked(frame([(1, "a", "en", "s")], DOCS))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
    assert exact_dedup.marked(frame([], DOCS)).count() == 0 == exact_dedup.deduplicated(frame([], DOCS)).count()


@settings(max_examples=60, deadline=None)
@given(st.sets(st.binary(max_size=6), max_size=40), st.lists(st.binary(max_size=6), max_size=30))
def test_transducer_places(words, others):
    words = sorted(words)
    machine = transducer.build(words)
    asked = words + others
    data = np.frombuffer(b"".join(asked), np.uint8)
    end = np.cumsum([len(w) for w in asked], dtype=np.int64)
    begin = end - [len(w) for w in asked]
    state = np.full(len(asked), machine.root)
    got = machine.places(data, begin.astype(np.int64), end, state, np.zeros(len(asked), np.int64))
    assert got.tolist() == [words.index(w) if w in words else -1 for w in asked]


def test_transducer_is_minimal():
    """Words with the same ends share their states."""
    words = sorted(a + b for a in (b"x", b"y", b"zz") for b in (b"ing", b"ings", b"ed"))
    prefixes = {w[:k] for w in words for k in range(len(w) + 1)}
    futures = {frozenset(w[len(p):] for w in words if w.startswith(p)) for p in prefixes}
    assert len(transducer.build(words).final) == len(futures)
    with pytest.raises(ValueError):
        transducer.build([b"b", b"a"])


def divergences(docs, min_docs, top):
    langs = defaultdict(list)
    for _, text, lang, source in docs:
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        langs[lang or ""].append((source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lowered)))
    out = []
    for lang, rows in langs.items():
        seen = Counter(t for _, words in rows for t in set(words))
        kept = sorted((t for t, n in seen.items() if n >= min_docs), key=str.encode)
        counts = defaultdict(Counter)
        for source, words in rows:
            counts[source].update(t for t in words if seen[t] >= min_docs)
        total = sum(counts.values(), Counter())

        def share(c, t, kept=kept):
            return 1 + 10**9 * (c[t] + 1) // (sum(c.values()) + len(kept))

        for a in counts:
            pairs = [(b, sum((share(counts[a], t) - share(counts[b], t)) ** 2 // share(counts[b], t) for t in kept)) for b in counts if b != a]
            pairs.sort(key=lambda x: (-x[1], x[0].encode()))
            out += [(lang, a, "pair", b, v, k + 1) for k, (b, v) in enumerate(pairs)]
            more = [(t, share(counts[a], t), share(total, t)) for t in kept if counts[a][t]]
            terms = sorted(((t, (p - q) ** 2 // q) for t, p, q in more if p > q), key=lambda x: (-x[1], x[0].encode()))
            out += [(lang, a, "term", t, v, k + 1) for k, (t, v) in enumerate(terms[:top])]
    return sorted(out, key=repr)


@pytest.mark.parametrize("head", [1 << 17, 5, 0])
def test_divergence_of_sources(frame, monkeypatch, head):
    """With the transducer of all tasks whole, partly and not filled."""
    monkeypatch.setattr(source_divergence, "HEAD_TERMS", head)
    monkeypatch.setattr(source_divergence, "SHARD_TERMS", 7)
    draw = random.Random(4)
    words = ["an", "And", "ants", "be", "bee", "Été", "été", "中文", "z", "long" * 40, "\U0001f600x", "o'er", "a1b"]
    docs = [
        (i, "  ".join(draw.choices(words, k=draw.randrange(30))), draw.choice(["en", "de", None, ""]), draw.choice(["a", "b", "é", None]))
        for i in range(60)
    ]
    docs += [(60, "and", "xx", "lonely"), (61, None, "xx", "other"), (62, "bee " * 50_000, "en", "a"), (None, "an", "en", "b"), (1, "be", "de", "c"), (1, "be", "de", "c")]
    df = frame(docs, DOCS).withColumns({"n": F.lit(1), "ordinal": F.lit("x"), "term": F.lit(0), "p": F.lit(None)})
    assert rows_of(source_divergence.audited(df, top_terms=4)) == divergences(docs, 3, 4)


def text_batches(docs, size):
    columns = {c: [d[k] for d in docs] for k, c in ((2, "lang"), (3, "source"), (1, "text"))}
    return iter(pa.table(columns).to_batches(max_chunksize=size))


def test_divergence_counts_move_summed():
    """A task puts out a term of a language, and a block of a group, once for all its batches."""
    docs = [(i, "and bee zoo", "en", f"s{i % 2}") for i in range(50)]
    found = [row for b in source_divergence._documents_of_terms(text_batches(docs, 7)) for row in zip(*b.to_pydict().values(), strict=True)]
    assert sorted(found) == [("en", b"and", 50), ("en", b"bee", 50), ("en", b"zoo", 50)]
    machine, _ = source_divergence._built([("en", b"and", 0), ("en", b"bee", 1)])
    rows = [row for b in source_divergence._streamed(text_batches(docs, 7), machine, 1) for row in b.to_pylist()]
    assert sorted((r["source"], r["part"]) for r in rows) == [("s0", -1), ("s0", 0), ("s1", -1), ("s1", 0)]
    assert all(set(np.frombuffer(r["n"], np.uint32)) == {25} for r in rows)


@pytest.mark.parametrize("limit", ["TERMS_AT_ONCE", "COUNTS_AT_ONCE", "GROUPS_AT_ONCE", "BYTES_AT_ONCE", "BLOCK", "ROW_WORDS", "SUMS_AT_ONCE", None])
def test_divergence_counts_in_pieces(monkeypatch, limit):
    """Sums are the same however little a task holds at once and a row may hold."""
    if limit:
        monkeypatch.setattr(source_divergence, limit, 2)
    draw = random.Random(9)
    words = [f"{a}{b}" for a in "abcdé" for b in "xyz"] + ["out", "rare"]
    docs = [(i, ", ".join(draw.choices(words, k=draw.randrange(9))), draw.choice(["en", "de", ""]), draw.choice("rst")) for i in range(40)]
    n_shards, ordinal = 2, {(lang, w.encode()): 100 * k + j for k, lang in enumerate(["", "de", "en"]) for j, w in enumerate(sorted(words, key=str.encode)[:15])}
    head = [(lang, w, o) for (lang, w), o in ordinal.items() if o % 3]
    machine, ordinals = source_divergence._built(head)
    rows = [
        {"part": zlib.crc32(w, source_divergence._seed(lang)) % n_shards, "known": 1, "lang": lang, "source": None, "ordinal": o, "words": w, "n": None}
        for (lang, w), o in ordinal.items() if o % 3 == 0
    ]
    for batch in source_divergence._streamed(text_batches(docs, 3), machine, n_shards):
        rows += [{"known": 0, "ordinal": None} | row for row in batch.to_pylist()]
    rows.sort(key=lambda r: (r["part"], -r["known"], r["lang"], r["source"] or ""))
    kinds = {"part": pa.int32(), "known": pa.int32(), "lang": pa.string(), "source": pa.string(), "ordinal": pa.int64(), "words": pa.binary(), "n": pa.binary()}
    dealt = iter(pa.Table.from_pylist(rows, schema=pa.schema(kinds)).to_batches(max_chunksize=5))
    got = [row for b in source_divergence._summed(dealt, ordinals) for row in zip(*b.to_pydict().values(), strict=True)]
    wanted = Counter((lang, source, ordinal[lang, w.encode()]) for _, text, lang, source in docs for w in text.split(", ") if (lang, w.encode()) in ordinal)
    assert sorted(got) == sorted((*k, n) for k, n in wanted.items())


def test_divergence_without_terms(frame):
    assert source_divergence.audited(frame([], DOCS)).count() == 0
    docs = [(1, "a", "en", "s"), (2, "123", "en", "t"), (3, None, None, None)]
    assert rows_of(source_divergence.audited(frame(docs, DOCS))) == divergences(docs, 3, 200)


def tries(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            tie = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own[conv].append((turn is not None, turn or 0, tie, role, text))
    turns = {c: [t[3:] for t in sorted(v)] for c, v in own.items()}
    nodes = defaultdict(list)
    for c in sorted(turns):
        h = zlib.crc32(str(c).encode()) % 9
        base = c - int(np.fmod(c, 5))
        whole = turns.get(base, [])[:h] + turns[c][h:]
        for d in range(len(whole) + 1):
            nodes[tuple(whole[:d])].append((c, len(whole) == d))
    out = []
    for key, members in nodes.items():
        below = {k: m for k, m in nodes.items() if k[: len(key)] == key}
        leaves = [k for k in below if not any(len(n) == len(k) + 1 and n[: len(k)] == k for n in below)]
        saved = sum((len(m) - 1) * len(k[-1][1].encode()) for k, m in below.items() if k)
        ends = ",".join(str(c) for c, end in members if end)
        parent = nodes[key[:-1]][0][0] if key else None
        out.append((
            members[0][0], len(key), parent, len(members), sum(len(k) == len(key) + 1 for k in below), len(leaves), saved,
            hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=repr)


@pytest.fixture
def many_parts(spark):
    """Sorted rows stay in as many parts as dealt, so that conversations go on from task to task."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_trie(frame, many_parts, monkeypatch):
    monkeypatch.setattr(prefix_trie, "IDS_IN_PIECE", 3)
    draw = random.Random(7)
    rows = []
    for c in [*range(-12, 0), *range(0, 60), 1000, 1003, 7777]:
        if c % 5 == 0 and draw.random() < 0.3:
            continue  # no first conversation
        n = draw.choice([1, 2, 5, 9, 12])
        rows += [(c, draw.choice([k, k, None]), draw.choice(["u", "a", None]), draw.choice(["x", "é", "", None, "long " * 9])) for k in range(n)]
    rows += [(10, k // 3, "u", "same") for k in range(300)]  # spans tasks, repeats rows
    rows += [(c, k, "u", f"turn {k}") for c in range(200, 260) for k in range(3)]  # copies
    rows += [(None, 0, "u", "nobody"), (5000, None, None, None), (3, 4, "u", "y" * 200_000)]
    draw.shuffle(rows)
    df = frame(rows, "conv_id long, turn long, role string, text string").withColumns({"depth": F.lit("x"), "f0": F.lit(1), "ref": F.lit(None), "size": F.lit(0)})
    got = prefix_trie.trie(df.repartition(6))
    assert rows_of(got) == tries(rows)


def test_trie_takes_another_seed(frame, monkeypatch):
    """Texts with one fingerprint are told apart by the texts themselves."""
    real = prefix_trie._scanned

    def colliding(batches, scan=real(1)):
        for part in scan(batches):
            equal = pa.array([7] * part.num_rows, pa.int64())
            names = part.schema.names
            yield pa.RecordBatch.from_arrays([equal if n in ("f0", "f1") else part.column(n) for n in names], names=names)

    rows = [(5, 0, "u", "a"), (10, 0, "u", "b"), (15, 0, "v", "a")]
    df = frame(rows, "conv_id long, turn long, role string, text string")
    seeds = []
    monkeypatch.setattr(prefix_trie, "_alike", lambda t, c, f=prefix_trie._alike: seeds.append(f(t, c)) or seeds[-1])
    monkeypatch.setattr(prefix_trie, "_scanned", lambda seed: real(seed) if seed else colliding)
    assert rows_of(prefix_trie.trie(df)) == tries(rows)
    assert seeds == [False, True]


def test_trie_of_nothing(frame):
    schema = "conv_id long, turn long, role string, text string"
    assert prefix_trie.trie(frame([], schema)).count() == 0
    assert prefix_trie.trie(frame([(None, 1, "u", "x")], schema)).count() == 0
    one = [(8, 1, "u", "x")]
    assert rows_of(prefix_trie.trie(frame(one, schema))) == tries(one)
