"""BPE encoding by forced-boundary splitting, and decoding.

Two neighbouring bytes that no token of the vocabulary holds side by side can never end up in
one token, so the text may be cut between them. Fragments between such cuts are merged on
their own and remembered; the ids of a text are those of its fragments in order.

Letters and cases are those of the Unicode data at hand; code points that Unicode 16 or later
assigned may be split unlike the library's. Marks that the library's normaliser does not know
neither move nor combine, as there.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata
from array import array
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfield.llm.common import slices, table

VOCABULARY = "word_bpe_49k.json"
# Entries a task remembers before it starts anew.
REMEMBERED = 400_000
SHORT = 48
# Combining characters that the library's normaliser takes for ordinary letters.
UNKNOWN_MARKS = (
    "07FD 0898-089F 08CA-08D3 09FE 0C3C 0D3B-0D3C 0EBA 1715 1ABF-1ACE 1DF6-1DFA A82C 10D24-10D27 10EAB-10EAC 10EFD-10EFF "
    "10F46-10F50 10F82-10F85 11070 1133B 1145E 11839-1183A 11930 1193D-1193E 11943 119E0 11A34 11A47 11A99 11D42 11D44-11D45 "
    "11D97 11F41-11F42 16FF0-16FF1 1E08F 1E130-1E136 1E2AE 1E2EC-1E2EF 1E4EC-1E4EF"
)


def _characters(ranges: str) -> str:
    """A class of a pattern from ranges of code points."""
    return "[" + "".join("-".join(chr(int(x, 16)) for x in part.split("-")) for part in ranges.split()) + "]"


UNKNOWN_MARK = re.compile(f"({_characters(UNKNOWN_MARKS)})")


def normalised(text: str) -> str:
    """NFC as the library has it: an unknown mark stays in its place, and nothing passes it."""
    if text.isascii() or not UNKNOWN_MARK.search(text):
        return unicodedata.normalize("NFC", text)
    return "".join([unicodedata.normalize("NFC", part) for part in UNKNOWN_MARK.split(text)])


def byte_letters() -> list[str]:
    """The letter that stands for each byte in vocabulary files of byte-level BPE.

    Printable bytes stand for themselves, the others for code points from 256 upwards.
    """
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(others)) for b in range(256)]


class Codec:
    """Encoder and decoder for a vocabulary given as the JSON text of its file."""

    def __init__(self, description: str) -> None:
        spec = json.loads(description)
        model = spec["model"]
        self.suffix = model["end_of_word_suffix"] or ""
        self.ids: dict[str, int] = model["vocab"]
        self.ranks = {tuple(m.split(" ") if isinstance(m, str) else m): r for r, m in enumerate(model["merges"])}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.at_special = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        pieces = [p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split"]
        self.pieces = regex.compile(pieces[0])
        self.letters = byte_letters()
        self.names: dict[int, bytes] = {i: t.encode("utf-8") for t, i in [*self.ids.items(), *self.special.items()]}
        self.inside = set()
        for token in self.ids:
            body = token.removesuffix(self.suffix) if self.suffix else token
            self.inside.update(zip(body, body[1:], strict=False))
        self.chunks: dict[bytes, bytes] = {}
        self.starts: dict[str, bytes] = {}
        self.endings: dict[str, bytes] = {}

    def fragment(self, text: str, ends: bool) -> bytes:
        """Packed ids of a fragment; ``ends`` if it ends its word."""
        fragments = self.endings if ends else self.starts
        known = fragments.get(text)
        if known is None:
            symbols = list(text)
            if ends:
                symbols[-1] += self.suffix
            merged = self._merge_short(symbols) if len(symbols) <= SHORT else self._merge_long(symbols)
            known = array("I", [self.ids[s] for s in merged if s in self.ids]).tobytes()
            if len(fragments) >= REMEMBERED:
                fragments.clear()
            fragments[text] = known
        return known

    def _merge_short(self, s: list[str]) -> list[str]:
        rank, never = self.ranks.get, len(self.ranks)
        r = [rank(pair, never) for pair in zip(s, s[1:], strict=False)]
        while r:
            best = min(r)
            if best == never:
                break
            i = r.index(best)
            s[i] += s.pop(i + 1)
            r.pop(i)
            if i:
                r[i - 1] = rank((s[i - 1], s[i]), never)
            if i < len(r):
                r[i] = rank((s[i], s[i + 1]), never)
        return s

    def _merge_long(self, s: list[str]) -> list[str]:
        """The same merges by a heap of neighbours, for fragments of any length."""
        n = len(s)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, s[i], s[i + 1]) for i in range(n - 1) if (r := self.ranks.get((s[i], s[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, left, right = heapq.heappop(heap)
            j = after[i]
            if s[i] != left or j >= n or s[j] != right:
                continue
            s[i], s[j] = left + right, ""
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < n and (r := self.ranks.get((s[a], s[b]))) is not None:
                    heapq.heappush(heap, (r, a, s[a], s[b]))
        return [x for x in s if x]

    def word(self, word: str) -> bytes:
        """Packed ids of one word: cut wherever no token spans two neighbouring bytes."""
        if not (word.isascii() and word.isprintable()):
            word = "".join([self.letters[b] for b in word.encode("utf-8")])
        cuts = [i for i, pair in enumerate(zip(word, word[1:], strict=False), 1) if pair not in self.inside]
        if not cuts:
            return self.fragment(word, True)
        starts = [0, *cuts]
        parts = [self.fragment(word[a:b], False) for a, b in zip(starts, cuts, strict=False)]
        return b"".join(parts) + self.fragment(word[cuts[-1] :], True)

    def chunk(self, raw: bytes) -> bytes:
        """Packed ids of a run without white space."""
        packed = b"".join([self.word(w) for w in self.pieces.findall(raw.decode("utf-8"))])
        if len(self.chunks) >= REMEMBERED:
            self.chunks.clear()
        self.chunks[raw] = packed
        return packed

    def _plain(self, text: str) -> bytes:
        known, make = self.chunks.get, self.chunk
        normal = normalised(text).replace("Σ", "σ").lower()
        return b"".join([known(c) or make(c) for c in normal.encode("utf-8").split()])

    def encode(self, text: str) -> bytes:
        """Ids of a text, as little-endian unsigned 32-bit integers."""
        if self.at_special is None or not self.at_special.search(text):
            return self._plain(text)
        parts = self.at_special.split(text)
        return b"".join(
            array("I", [self.special[p]]).tobytes() if i % 2 else self._plain(p) for i, p in enumerate(parts)
        )

    def decode(self, packed: bytes) -> bytes:
        """The decoded text in UTF-8: the names of the tokens, one space between two."""
        return b" ".join(map(self.names.__getitem__, array("I", packed)))


def vocabulary_file(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def coded(docs: DataFrame, vocabulary: str | None = None, with_ids: bool = False, with_text: bool = False) -> DataFrame:
    """doc_id, n_tokens and the digests of ids and of the decoded text for every row of ``docs``.

    ``vocabulary`` is the path of the vocabulary file on the driver. The ids (array<int>) and the
    decoded text follow if wanted. A null text counts as empty: no ids and an
    empty decoded text. Repeated rows give repeated rows; further columns are ignored. An
    empty table gives an empty table.
    """
    spark = docs.sparkSession
    given = spark.sparkContext.broadcast(Path(vocabulary or vocabulary_file()).read_text(encoding="utf-8"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(given.value)
        for batch in slices(batches):
            counts, ids_digests, text_digests, all_ids, decoded = [], [], [], [], []
            for text in batch.column("text").to_pylist():
                packed = codec.encode(text or "")
                plain = codec.decode(packed)
                counts.append(len(packed) // 4)
                ids_digests.append(hashlib.sha256(packed).hexdigest())
                text_digests.append(hashlib.sha256(plain).hexdigest())
                if with_ids:
                    all_ids.append(array("I", packed).tolist())
                if with_text:
                    decoded.append(plain.decode("utf-8"))
            columns = [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(ids_digests, pa.string()), pa.array(text_digests, pa.string())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                columns.append(pa.array(all_ids, pa.list_(pa.int32())))
                names.append("ids")
            if with_text:
                columns.append(pa.array(decoded, pa.string()))
                names.append("decoded")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    schema += ", ids array<int>" * with_ids + ", decoded string" * with_text
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, schema)


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coded(table(spark, sf_dir, "documents"))
