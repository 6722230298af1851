"""Toxicity by a weighted lexicon.

Texts are folded (case, accents, letters that look alike, digits in place of letters) and read
by an Aho-Corasick automaton of words and beginnings of words. Each entry's matches, normalised
by the text's length, count with its weight; matches inside an exception phrase do not count.
Entries, weights and exceptions are learned from labelled texts.
"""

from __future__ import annotations

import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfield.llm.common import bounded_sample, crc_bucket, slices, table

# Letters of other scripts that look like Latin ones, and digits and signs in place of letters.
LOOKALIKES = {
    "а": "a", "в": "b", "е": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t", "у": "y", "х": "x",
    "і": "i", "ї": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "ԛ": "q", "ԝ": "w", "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i",
    "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ı": "i", "ɑ": "a", "ɡ": "g", "ł": "l", "ø": "o",
}
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"}
UNSEEN = "­​‌‍⁠﻿"

# Training reads at most this many labelled texts and keeps at most this many entries.
SAMPLE_ROWS, ENTRIES = 6000, 1500
SHORTEST, LONGEST = 4, 10
LEAST_TEXTS, LEAST_ODDS = 4, 1.2
SEED = 6


class _Folding(dict):
    """Code point to what it is folded to, found when first asked for."""

    def __missing__(self, code: int) -> str:
        char = chr(code)
        if char in UNSEEN:
            out = ""
        elif char in DIGITS:
            out = DIGITS[char]
        else:
            plain = [c for c in unicodedata.normalize("NFKD", char).lower() if not unicodedata.combining(c)]
            out = "".join(LOOKALIKES.get(c, c if c.isalpha() else " ") for c in plain)
        self[code] = out
        return out


FOLDING = _Folding()


def folded(text: str) -> str:
    """Folded words, one space around each; a single space if there are none."""
    return " " + "".join([w + " " for w in text.translate(FOLDING).split()])


@dataclass
class Lexicon:
    weights: dict[str, float]
    exceptions: list[str]
    bias: float = 0.0
    automaton: object = field(default=None, repr=False)

    def build(self) -> None:
        self.automaton = ahocorasick.Automaton()
        for k, entry in enumerate(self.weights):
            self.automaton.add_word(entry, (k, len(entry)))
        for phrase in self.exceptions:
            self.automaton.add_word(phrase, (-1, len(phrase)))
        if len(self.automaton):
            self.automaton.make_automaton()

    def __getstate__(self) -> dict:
        return {"weights": self.weights, "exceptions": self.exceptions, "bias": self.bias, "automaton": None}

    def matches(self, text: str) -> Counter:
        """How often each entry occurs in a folded text outside exception phrases."""
        if self.automaton is None:
            self.build()
        if not len(self.automaton):
            return Counter()
        found = list(self.automaton.iter(text))
        spared = [(end - n, end) for end, (k, n) in found if k < 0]
        if spared:
            return Counter(k for end, (k, n) in found if k >= 0 and not any(a <= end - n and end <= b for a, b in spared))
        return Counter([k for _, (k, _) in found])

    def score(self, text: str | None) -> float:
        plain = folded(text or "")
        values = list(self.weights.values())
        z = sum(values[k] * n for k, n in self.matches(plain).items()) / length_norm(plain) + self.bias
        return float(1 / (1 + np.exp(-np.clip(z, -500, 500))))


def length_norm(plain: str) -> float:
    return float(np.sqrt(plain.count(" ") + 10))


def _parts(word: str) -> list[str]:
    """The word and its beginnings, as entries: a space stands for a border."""
    return [f" {word} ", *(f" {word[:n]}" for n in range(SHORTEST, min(LONGEST, len(word)) + 1))]


def _entries(texts: list[str], labels: np.ndarray) -> list[str]:
    """Words and beginnings that far more toxic texts hold than others, the most telling first."""
    toxic, other = Counter(), Counter()
    for text, label in zip(texts, labels, strict=True):
        (toxic if label else other).update({p for w in set(text.split()) for p in _parts(w)})
    n_toxic, n_other = max(1, int(labels.sum())), max(1, int((1 - labels).sum()))
    odds = {
        p: np.log((n + 0.5) / (n_toxic + 1)) - np.log((other[p] + 0.5) / (n_other + 1)) for p, n in toxic.items() if n >= LEAST_TEXTS
    }
    telling = sorted((p for p, x in odds.items() if x >= LEAST_ODDS), key=lambda p: (-toxic[p] * odds[p], len(p), p))
    taken, seen = [], set()
    for p in telling:
        # A longer beginning in the same texts says nothing new.
        body = p.strip()
        if any((body[:n], toxic[p], other[p]) in seen for n in range(SHORTEST, len(body) + 1)):
            continue
        seen.add((body, toxic[p], other[p]))
        taken.append(p)
        if len(taken) == ENTRIES:
            break
    return taken


def _exceptions(texts: list[str], labels: np.ndarray, entries: list[str]) -> list[str]:
    """Two-word phrases with an entry that only harmless texts hold, three at least."""
    toxic, harmless = set(), Counter()
    known = set(entries)
    for text, label in zip(texts, labels, strict=True):
        words = text.split()
        hit = {w for w in set(words) if not known.isdisjoint(_parts(w))}
        pairs = {f" {a} {b} " for a, b in zip(words, words[1:], strict=False) if a in hit or b in hit}
        toxic.update(pairs) if label else harmless.update(pairs)
    return sorted(p for p, n in harmless.items() if n >= 3 and p not in toxic)


def train(texts: list[str], labels: list[int], steps: int = 400) -> Lexicon:
    """A lexicon whose weights are those of a logistic regression on normalised matches."""
    y = np.array(labels, float)
    plain = [folded(t) for t in texts]
    lexicon = Lexicon({e: 0.0 for e in _entries(plain, y)}, [])
    lexicon.exceptions = _exceptions(plain, y, list(lexicon.weights))
    lexicon.build()
    x = np.zeros((len(y), len(lexicon.weights)), np.float32)
    for i, text in enumerate(plain):
        norm = length_norm(text)
        for k, n in lexicon.matches(text).items():
            x[i, k] = n / norm
    scale = np.maximum(x.std(axis=0), 1e-3)
    x /= scale
    w, b = np.zeros(x.shape[1], np.float32), float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
    m, v, mb, vb = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    for t in range(1, steps + 1):
        p = 1 / (1 + np.exp(-np.clip(x @ w + b, -50, 50)))
        g = x.T @ (p - y).astype(np.float32) / max(1, len(y)) + 1e-3 * w
        gb = float((p - y).mean()) if len(y) else 0.0
        m, v, mb, vb = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g, 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
        rate = 0.05 * np.sqrt(1 - 0.999**t) / (1 - 0.9**t)
        w -= rate * m / (np.sqrt(v) + 1e-8)
        b -= float(rate * mb / (np.sqrt(vb) + 1e-8))
    lexicon.weights = {e: float(a) for e, a in zip(lexicon.weights, w / scale, strict=True)}
    lexicon.bias = b
    return lexicon


def trained_on(docs: DataFrame, labels: DataFrame) -> Lexicon:
    """A lexicon from a bounded sample (``SAMPLE_ROWS``) of labelled documents.

    Labels other than 0 and 1 and null ids are left out, null texts count as empty. Of rows that
    repeat an id, the smallest text counts, so that no more texts than labels reach the driver.
    Without labels the lexicon is empty.
    """
    marked = labels.where("toxic in (0, 1) and doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    sample = bounded_sample(marked, "doc_id", SAMPLE_ROWS)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = texts.join(F.broadcast(sample.distinct()), "doc_id").groupBy("doc_id", "toxic")
    rows = found.agg(F.min(F.coalesce("text", F.lit(""))).alias("text")).orderBy("doc_id", "text", "toxic").collect()
    return train([r["text"] or "" for r in rows], [r["toxic"] for r in rows])


def scored(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """doc_id and score (0 to 1) of every row of ``docs``.

    Null and empty texts match nothing and get the score of the bias alone. Repeated rows give
    repeated rows, a null doc_id is carried along, further columns are ignored. An empty table
    gives an empty table.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon.build()
        values = np.array(list(lexicon.weights.values()) or [0.0])
        for batch in slices(batches):
            z = []
            for text in batch.column("text").to_pylist():
                plain = folded(text or "")
                found = lexicon.matches(plain)
                z.append(sum(values[k] * n for k, n in found.items()) / length_norm(plain) + lexicon.bias)
            scores = 1 / (1 + np.exp(-np.clip(np.array(z, float), -500, 500)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores)], names=["doc_id", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, score double")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = crc_bucket(F.col("doc_id")) == 0
    lexicon = trained_on(docs, labels.where(~held_out))
    return scored(docs, lexicon).select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
