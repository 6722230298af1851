"""Secrets in texts: fixed patterns, and a convolutional network over characters.

The patterns give the base findings. The network reads every other candidate with its
surroundings: runs of token characters with letters and digits, longer runs of whatever token
characters, values of any characters that a credential word introduces, and what a base finding
leaves of its run. It is trained in numpy on generated findings and plainly harmless real
candidates, its logits are calibrated on a held-out part, and the thresholds are the highest ones
that keep the wanted recall there for every kind of secret that the patterns miss.
"""

from __future__ import annotations

import random
import re
import string
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfield.llm.common import bounded_sample, slices, table

KINDS = ("assign", "access", "hex", "model")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.ASCII | re.IGNORECASE,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=.~-]{12,}")
HAS_BOTH = re.compile(r"(?=.*[A-Za-z])(?=.*[0-9])")
# Runs of so many token characters are candidates without a letter or a digit too.
LONG = 20
# What a credential word introduces is a candidate from SHORT characters on, of whatever characters:
# up to the closing quote, or to white space, a bracket or a mark that ends the value.
SHORT = 6
CREDENTIAL = re.compile(
    r"""(?<![A-Za-z])(?:pass(?:word|wd|phrase|code)?|pwd|pin|secret|token|credentials?|auth|login|bearer|(?:(?:api|access|private|secret)[ _-]?)?key)["']?"""
    r"""(?:[\x20\t]{0,4}[:=]>?[\x20\t]{0,4}|\x20is\x20)(?:"([^"\s]{6,})(?=")|'([^'\s]{6,})(?=')|["'`]?([^\s"'`<>,;()\[\]{}]{6,}))""",
    re.ASCII | re.IGNORECASE,
)
VALUE = re.compile(r"""[^\s"'`<>,;()\[\]{}]*""")
ENDS = ".!?:"
# How a candidate comes to be one; each way has its own threshold.
RUN, NEAR, PLAIN_RUN = range(3)
# A word that stands by itself, and the words and numbers of a run.
PLAIN = re.compile(r"(?<!\S)[A-Za-z][a-z]{1,19}(?=[\s.,;:!?]|\Z)")
PIECE = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
TOKEN_CHARS = frozenset(string.ascii_letters + string.digits + "+/_=.~-")

LEFT, BODY, RIGHT = 24, 40, 8
# Longer candidates are read in pieces of BODY characters that begin so far apart; one with less of a
# secret than KNOWN_PART teaches nothing.
STRIDE, KNOWN_PART = 20, 14
WIDTH, EMBEDDED, FILTERS, KERNEL = LEFT + BODY + RIGHT, 8, 16, 5
# Training reads at most this many documents and generates this many findings of each label and kind,
# twice as many beside credential words.
SAMPLE_DOCS, GENERATED = 4000, 1500
RECALL = 0.99
SEED = 20


def base_findings(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns, in that order; kind counts in ``KINDS``."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def introduced(text: str) -> list[tuple[int, int]]:
    """(start, end) of the values that credential words introduce, without the marks that end a sentence."""
    out = []
    for m in CREDENTIAL.finditer(text):
        start, end = m.span(m.lastindex)
        if m.lastindex == 3:
            end = start + len(m.group(3).rstrip(ENDS))
        if end - start >= SHORT:
            out.append((start, end))
    return out


def candidates(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """(start, end, way) of what is to be judged, apart from the base findings.

    Runs of 12 token characters with a letter and a digit, and of ``LONG`` without, are candidates
    anywhere; others of ``SHORT`` characters where they are ``NEAR``: introduced by a credential
    word, or what a base finding leaves of its run or value.
    """
    covered: list[list[int]] = []
    for start, end in sorted((s, e) for s, _, e in base):
        if covered and start <= covered[-1][1]:
            covered[-1][1] = max(covered[-1][1], end)
        else:
            covered.append([start, end])
    # What the base findings leave of their runs, to the left and the right.
    found, done = set(), 0
    assigned = {end for _, kind, end in base if kind == 0}
    for i, (start, end) in enumerate(covered):
        a, b, stop = start, end, covered[i + 1][0] if i + 1 < len(covered) else len(text)
        while a > done and text[a - 1] in TOKEN_CHARS:
            a -= 1
        if end in assigned:
            b = VALUE.match(text, end, stop).end()
            if b < stop:
                b = end + len(text[end:b].rstrip(ENDS))
        else:
            while b < stop and text[b] in TOKEN_CHARS:
                b += 1
        found |= {(a, start), (end, b)}
        done = end
    touched = [(s, e) for s, e in found if e - s >= SHORT]
    values, at = [], 0
    for start, end in introduced(text):
        while at < len(covered) and covered[at][1] <= start:
            at += 1
        if at == len(covered) or end <= covered[at][0]:
            values.append((start, end))
    # A run that a credential word divides is judged in two parts; one within a value, with the value.
    near, at, v = set(touched) | set(values), 0, 0
    wanted = set(near)
    for m in CANDIDATE.finditer(text):
        start, end = m.span()
        while at < len(covered) and covered[at][1] <= start:
            at += 1
        if (at == len(covered) or end <= covered[at][0]) and (end - start >= LONG or HAS_BOTH.match(m.group())):
            while v < len(values) and values[v][1] <= start:
                v += 1
            if v < len(values) and values[v][0] < end:
                end = values[v][0]
            if start < end:
                wanted.add((start, end))
    out = []
    for start, end in sorted(wanted):
        way = way_of(text, start, end, (start, end) in near)
        if way is not None:
            out.append((start, end, way))
    return out


def window(text: str, start: int, end: int) -> np.ndarray:
    """Codes of the characters before, in and after a candidate; 0 is padding, 96 anything not ASCII."""
    out = np.zeros(WIDTH, np.int64)
    parts = (text[max(0, start - LEFT) : start].rjust(LEFT, "\0"), text[start : min(end, start + BODY)].ljust(BODY, "\0"), text[end : end + RIGHT].ljust(RIGHT, "\0"))
    for i, c in enumerate("".join(parts)):
        code = ord(c)
        out[i] = code - 31 if 32 <= code < 127 else 0 if code == 0 else 96
    return out


def pieces(start: int, end: int) -> list[tuple[int, int]]:
    """Overlapping spans of at most ``BODY`` characters that cover a candidate."""
    last = max(start, end - BODY)
    return [(at, min(end, at + BODY)) for at in [*range(start, last, STRIDE), last]]


@dataclass
class Network:
    """Embedding, one convolution, the largest activation per region, a linear layer, calibration."""

    embedding: np.ndarray
    kernel: np.ndarray
    bias: np.ndarray
    weights: np.ndarray
    offset: float
    scale: float = 1.0
    shift: float = 0.0
    threshold: float = 0.5
    near_threshold: float = 0.5
    plain_threshold: float = 0.5

    REGIONS = ((0, LEFT), (LEFT, LEFT + BODY - KERNEL + 1), (LEFT + BODY - KERNEL + 1, WIDTH - KERNEL + 1))

    @classmethod
    def new(cls, rng: np.random.Generator) -> Network:
        return cls(
            rng.normal(0, 0.5, (97, EMBEDDED)), rng.normal(0, (KERNEL * EMBEDDED) ** -0.5, (KERNEL * EMBEDDED, FILTERS)),
            np.zeros(FILTERS), rng.normal(0, 0.1, 3 * FILTERS), 0.0,
        )

    def _forward(self, x: np.ndarray):
        e = self.embedding[x]
        n = WIDTH - KERNEL + 1
        patches = np.concatenate([e[:, k : k + n] for k in range(KERNEL)], axis=2)
        active = np.maximum(patches @ self.kernel + self.bias, 0)
        places = [active[:, a:b].argmax(axis=1) + a for a, b in self.REGIONS]
        pooled = np.concatenate([np.take_along_axis(active, p[:, None, :], 1)[:, 0] for p in places], axis=1)
        return patches, places, pooled, pooled @ self.weights + self.offset

    def logits(self, x: np.ndarray) -> np.ndarray:
        parts = [self._forward(x[i : i + 1024])[3] for i in range(0, len(x), 1024)]
        return np.concatenate(parts) if parts else np.empty(0)

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Calibrated probabilities."""
        return self.probabilities(self.logits(x))

    def probabilities(self, logits: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale * logits + self.shift, -50, 50)))

    def largest(self, text_spans: list[tuple[str, int, int]]) -> np.ndarray:
        """The largest logit over the pieces of each candidate (text, start, end)."""
        out = np.full(len(text_spans), -np.inf)
        for first in range(0, len(text_spans), 1024):
            cut = [(i, t, a, b) for i, (t, s, e) in enumerate(text_spans[first : first + 1024], first) for a, b in pieces(s, e)]
            np.maximum.at(out, [i for i, *_ in cut], self.logits(np.stack([window(t, a, b) for _, t, a, b in cut])))
        return out

    def _gradients(self, x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
        patches, places, pooled, logit = self._forward(x)
        d = (1 / (1 + np.exp(-np.clip(logit, -50, 50))) - y) / len(y)
        d_pooled = d[:, None] * self.weights[None, :] * (pooled > 0)
        d_kernel, d_bias = np.zeros_like(self.kernel), d_pooled.reshape(len(y), 3, FILTERS).sum(axis=(0, 1))
        codes, backs, rows = [], [], np.arange(len(y))
        for r, place in enumerate(places):
            for f in range(FILTERS):
                g, p = d_pooled[:, r * FILTERS + f], place[:, f]
                d_kernel[:, f] += patches[rows, p].T @ g
                back = g[:, None] * self.kernel[:, f][None, :]
                codes.append(x[rows[:, None], p[:, None] + np.arange(KERNEL)].ravel())
                backs.append(back.reshape(-1, EMBEDDED))
        codes, backs = np.concatenate(codes), np.concatenate(backs)
        d_embedding = np.stack([np.bincount(codes, backs[:, d], len(self.embedding)) for d in range(EMBEDDED)], axis=1)
        return [d_embedding, d_kernel, d_bias, pooled.T @ d, d.sum()]

    def fit(self, x: np.ndarray, y: np.ndarray, rng: np.random.Generator, epochs: int = 12, rate: float = 0.01) -> None:
        """Adam on the log loss, in mini-batches."""
        names = ("embedding", "kernel", "bias", "weights", "offset")
        first = {n: np.zeros_like(getattr(self, n)) for n in names}
        second = {n: np.zeros_like(getattr(self, n)) for n in names}
        step = 0
        for _ in range(epochs):
            order = rng.permutation(len(y))
            for start in range(0, len(y), 128):
                part = order[start : start + 128]
                step += 1
                for n, g in zip(names, self._gradients(x[part], y[part]), strict=True):
                    first[n] = 0.9 * first[n] + 0.1 * g
                    second[n] = 0.999 * second[n] + 0.001 * g * g
                    move = first[n] / (1 - 0.9**step) / (np.sqrt(second[n] / (1 - 0.999**step)) + 1e-8)
                    setattr(self, n, getattr(self, n) - rate * move)

    def least(self, way: int) -> float:
        return (self.threshold, self.near_threshold, self.plain_threshold)[way]

    def calibrate(self, z: np.ndarray, y: np.ndarray, way: np.ndarray, kind: np.ndarray, recall: float) -> None:
        """Fit scale and shift of the logits, then take the highest thresholds with the wanted recall in every kind."""
        for _ in range(500):
            p = 1 / (1 + np.exp(-np.clip(self.scale * z + self.shift, -50, 50)))
            self.scale -= 0.05 * float(((p - y) * z).mean())
            self.shift -= 0.5 * float((p - y).mean())
        self.threshold, self.near_threshold, self.plain_threshold = (
            min([self._keeping(z[(y == 1) & (way == w) & (kind == k)], recall) for k in np.unique(kind[(y == 1) & (way == w)])], default=0.5)
            for w in (RUN, NEAR, PLAIN_RUN)
        )

    def _keeping(self, z: np.ndarray, recall: float) -> float:
        positives = np.sort(self.probabilities(z))
        return float(positives[int(np.floor((1 - recall) * len(positives)))]) if len(positives) else 0.5


def generated_findings(words: list[str], n: int, seed: int = SEED) -> list[tuple[str, int, int, int]]:
    """(text, start, end, label) of made-up candidates among given words, half of them secrets."""
    rng = random.Random(seed)
    alnum, base64 = string.ascii_letters + string.digits, string.ascii_letters + string.digits + "+/"

    def run(letters: str, low: int, high: int) -> str:
        while True:
            made = "".join(rng.choices(letters, k=rng.randint(low, high)))
            if HAS_BOTH.match(made):
                return made

    def word() -> str:
        return re.sub(r"[^A-Za-z]", "", rng.choice(words)).lower() or "item"

    names = ("key", "api key", "secret key", "auth", "access", "credential", "pwd", "private", "client secret", "bearer", "Authorization: Bearer", "signature")
    secrets = (
        lambda: run("0123456789abcdef", 16, 64), lambda: run("0123456789ABCDEF", 24, 64),
        lambda: run(base64, 20, 64) + rng.choice(("", "=", "==")), lambda: run(alnum, 16, 48),
        lambda: "ghp_" + run(alnum, 36, 36), lambda: "sk-" + run(alnum, 24, 48), lambda: "xoxb-" + run(alnum, 30, 40),
        lambda: "AKIA" + run(string.ascii_uppercase + string.digits, 16, 16),
        lambda: f"eyJ{run(alnum, 17, 30)}.eyJ{run(alnum, 20, 40)}.{run(alnum + '_-', 30, 43)}",
    )
    harmless = (
        lambda: f"{word()}{rng.randint(1, 99)}.example.com", lambda: f"{word()}_{word()}_{rng.randint(1, 2030)}",
        lambda: f"{rng.randint(1990, 2030)}-{rng.randint(1, 12):02}-{rng.randint(1, 28):02}T{rng.randint(0, 23):02}",
        lambda: f"{word()}/{word()}/{word()}{rng.randint(1, 9)}.html", lambda: f"{word()}-{word()}-{word()}-{rng.randint(1, 999)}",
        lambda: f"{word().title()}{word().title()}{rng.randint(1, 99)}Impl", lambda: f"v{rng.randint(0, 20)}.{rng.randint(0, 20)}.{rng.randint(0, 20)}-{word()}.{rng.randint(1, 9)}",
        lambda: f"page={rng.randint(1, 99)}=ref={word()}", lambda: f"{word()}{word()}{word()}{rng.randint(1, 9999)}", lambda: f"{rng.randint(1, 99)}{word()}{word()}",
    )
    out = []
    while len(out) < 2 * n:
        label = len(out) % 2
        value = rng.choice(secrets if label else harmless)()
        if len(value) < 12 or not HAS_BOTH.match(value):
            continue
        left = " ".join(rng.choices(words, k=4))
        if rng.random() < (0.5 if label else 0.15):
            left += " " + rng.choice(names) + rng.choice((" ", "=", " = ", ": ", ' = "'))
        else:
            left += rng.choice((" ", " ", "\n", ' "', " ("))
        out.append((left + value + " " + " ".join(rng.choices(words, k=3)), len(left), len(left) + len(value), label))
    return out


def late_findings(words: list[str], n: int, seed: int = SEED + 1) -> list[tuple[str, int, int, int, int]]:
    """(text, start, end, label, start of the secret) of long made-up runs, half of them with a secret late in them."""
    rng = random.Random(seed)
    made = generated_findings(words, n, seed)
    out = []
    for text, start, end, label in made:
        lead = ""
        while len(lead) < rng.randint(24, 90):
            lead += (re.sub(r"[^A-Za-z]", "", rng.choice(words)).lower() or "item") + rng.choice(("", "", str(rng.randint(1, 99)))) + rng.choice("////-_.=")
        out.append((text[:start] + lead + text[start:], start, end + len(lead), label, start + len(lead)))
    return out


def near_findings(words: list[str], n: int, seed: int = SEED + 2) -> list[tuple[str, int, int, int]]:
    """(text, start, end, label) of made-up candidates beside credential words and base findings."""
    rng = random.Random(seed)
    alnum, hexa = string.ascii_letters + string.digits, "0123456789abcdef"
    plain = sorted({w.lower() for w in words if w.isascii() and w.isalpha() and len(w) > 1}) or ["item"]
    names = ("pwd", "passphrase", "passcode", "pin", "key", "access key", "private key", "credential", "auth", "login", "bearer", "pass", "DB_PASS", "Secret", "password", "token")
    special = "@#$%^&*!?|\\~+="
    said = ("required", "optional", "string", "undefined", "unknown", "missing", "invalid", "changed", "important", "disabled", "expired", "example", "placeholder")

    def run(letters: str, low: int, high: int) -> str:
        return "".join(rng.choices(letters, k=rng.randint(low, high)))

    secrets = (
        lambda: run(alnum, 6, 11), lambda: run(string.ascii_letters, 8, 24), lambda: run(string.digits, 6, 16),
        lambda: "".join(rng.choices(plain, k=rng.randint(2, 4))), lambda: "-".join(rng.choices(plain, k=4)),
        lambda: rng.choice(plain).replace("o", "0").replace("e", "3").replace("i", "1") + run(string.digits, 2, 5),
        lambda: run(alnum, 1, 5) + rng.choice(special) + run(alnum + special, 3, 14) + run(alnum, 1, 2),
        lambda: rng.choice(plain).title().replace("a", "@").replace("s", "$") + rng.choice("!#*_") + run(string.digits, 2, 4),
    )
    harmless = (
        lambda: rng.choice(said), lambda: rng.choice(plain), lambda: f"{rng.choice(plain)}.{rng.choice(said)}",
        lambda: f"your_{rng.choice(plain)}_here", lambda: f"config.{rng.choice(plain)}", lambda: f"get_{rng.choice(plain)}",
        lambda: f"{rng.choice(plain)}&{rng.choice(said)}", lambda: f"${rng.choice(plain)}_{rng.choice(said)}", lambda: f"{rng.choice(said)}|{rng.choice(said)}",
    )
    out = []
    while len(out) < 2 * n:
        label, left = len(out) % 2, " ".join(rng.choices(words, k=4)) + " "
        if rng.random() < 0.3:
            rest = run(alnum, 8, 24) if label else rng.choice("/.-") + f"{rng.choice(plain)}/{rng.choice(plain)}"
            if rng.random() < 0.5:
                left += rng.choice(("token=", "secret: ", "api_key=")) + run(alnum, 6, 12) + "~"
            elif rng.random() < 0.5:
                left += run(alnum if label else "-", 0, 12) + run(hexa, 24, 32)
                rest = rest if label else "." + rest[1:]
            else:
                out_left = left + (run(string.ascii_uppercase, 1, 3) + run(alnum, 6, 20) + rng.choice("GHKXYZ") if label else f"{rng.choice(plain)}/{rng.choice(plain)}/")
                if len(out_left) - len(left) >= SHORT:
                    out.append((out_left + run(hexa, 24, 32) + " end", len(left), len(out_left), label))
                continue
        else:
            left += rng.choice(names) + rng.choice((": ", "=", " = ", ":", ' = "', " is ", ":\t", " => '"))
            rest = rng.choice(secrets if label else harmless)()
        if len(rest) >= SHORT:
            out.append((left + rest + " " + " ".join(rng.choices(words, k=3)), len(left), len(left) + len(rest), label))
    return out


def plain_findings(words: list[str], n: int, seed: int = SEED + 3) -> list[tuple[str, int, int, int]]:
    """(text, start, end, label) of long made-up runs without digits or without letters."""
    rng = random.Random(seed)
    known = sorted({w.lower() for w in words if w.isascii() and w.isalpha() and len(w) > 1}) or ["item"]

    def run(letters: str) -> str:
        return "".join(rng.choices(letters, k=rng.randint(LONG, 64)))

    def joined(by: str, title: bool = False) -> str:
        out = ""
        while len(out) < LONG + rng.randint(0, 20):
            word = rng.choice(known)
            out += by * bool(out) + (word.title() if title else word)
        return out

    secrets = (
        lambda: run(string.ascii_letters), lambda: run(string.ascii_letters + "+/") + rng.choice(("", "=", "==")), lambda: run(string.ascii_lowercase),
        lambda: run(string.ascii_uppercase), lambda: run(string.digits), lambda: rng.choice(("ghp_", "sk-", "xoxb-")) + run(string.ascii_letters),
    )
    harmless = (
        lambda: joined("-"), lambda: joined("_"), lambda: joined("."), lambda: joined("/"), lambda: "/" + joined("/"), lambda: joined("", True),
        lambda: joined("_").upper(), lambda: rng.choice("-=_~.+") * rng.randint(LONG, 90), lambda: "-=" * rng.randint(LONG, 40), lambda: joined(""),
    )
    out = []
    while len(out) < 2 * n:
        label = len(out) % 2
        value, left = rng.choice(secrets if label else harmless)(), " ".join(rng.choices(words, k=4)) + rng.choice((" ", " ", "\n", " key ", ' "', " ("))
        out.append((left + value + rng.choice((" ", "\n", ". ")) + " ".join(rng.choices(words, k=3)), len(left), len(left) + len(value), label))
    return out


def labelled_findings(texts: list[str]) -> list[tuple[str, int, int, int]]:
    """(text, start, end, 0) of the candidates in real texts that are plainly harmless.

    These are made of words of the texts and numbers of at most four digits, and no credential word
    introduces them. All others are unlabelled and left out, since a secret may be among them; so
    are base findings, which the network is never asked about.
    """
    known = {w.lower() for t in texts for w in PLAIN.findall(t)}
    out = []
    for text in texts:
        base = base_findings(text)
        said = {start for start, _ in introduced(text)}
        for start, end, way in candidates(text, base):
            beside = way == NEAR or start in said or any(start == e or end == b for b, _, e in base)
            if not beside and all(p.lower() in known or (p.isdigit() and len(p) < 5) for p in PIECE.findall(text[start:end])):
                out.append((text, start, end, 0))
    return out


def way_of(text: str, start: int, end: int, near: bool) -> int | None:
    """How a span comes to be a candidate, if it is one; ``near`` if its surroundings make it one."""
    if end - start >= 12 and HAS_BOTH.match(text[start:end]):
        return RUN
    return NEAR if near else PLAIN_RUN if end - start >= LONG else None


def train(texts: list[str], recall: float = RECALL) -> Network:
    """A calibrated network from labelled findings in the texts and generated ones among their words."""
    words = [w for t in texts[:400] for w in t.split()[:200]] or ["text"]
    parts = [
        [(t, s, e, label, s) for t, s, e, label in labelled_findings(texts)], [(t, s, e, label, s) for t, s, e, label in generated_findings(words, GENERATED)],
        late_findings(words, GENERATED), *([(t, s, e, label, s) for t, s, e, label in made(words, n)] for made, n in ((near_findings, 2 * GENERATED), (plain_findings, GENERATED))),
    ]
    found, kind = [f for part in parts for f in part], np.repeat(np.arange(len(parts)), [len(part) for part in parts])
    y = np.array([label for _, _, _, label, _ in found], float)
    rng = np.random.default_rng(SEED)
    held = rng.random(len(y)) < 0.25
    x, taught = [], []
    for (t, s, e, label, secret), out in zip(found, held, strict=True):
        for a, b in [] if out else pieces(s, e):
            part = min(b - secret, e - secret) if label else 0
            if not label or part >= min(KNOWN_PART, e - secret) or part <= 0:
                x.append(window(t, a, b))
                taught.append(float(part > 0))
    network = Network.new(rng)
    network.fit(np.stack(x), np.array(taught), rng)
    # Base findings reach no threshold: the network is asked about other candidates only.
    out = np.array([i for i in np.flatnonzero(held) if not covered(*found[i][:3])])
    # The last part is of plain runs; all others that are no runs with both are beside something.
    way = np.array([way_of(*found[i][:3], kind[i] < len(parts) - 1) for i in out])
    network.calibrate(network.largest([found[i][:3] for i in out]), y[out], way, kind[out], recall)
    return network


def covered(text: str, start: int, end: int) -> bool:
    """Whether a base finding has part of a candidate."""
    return any(b < end and start < e for b, _, e in base_findings(text))


def findings(text: str, network: Network) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base findings and of the candidates apart from them that the network takes."""
    return _findings([text], network)[0]


def _findings(texts: list[str], network: Network) -> list[list[tuple[int, int, int]]]:
    found, asked, where = [base_findings(t) for t in texts], [], []
    for i, text in enumerate(texts):
        for start, end, way in candidates(text, found[i]):
            asked.append((text, start, end))
            where.append((i, network.least(way)))
    for (i, least), (_, start, end), score in zip(where, asked, network.probabilities(network.largest(asked)), strict=True):
        if score >= least:
            found[i].append((start, 3, end))
    return [sorted(f) for f in found]


def trained_on(docs: DataFrame) -> Network:
    """A network trained on a bounded sample (``SAMPLE_DOCS``) of the documents."""
    sample = bounded_sample(docs.select("doc_id", "text"), "doc_id", SAMPLE_DOCS)
    return train([r["text"] or "" for r in sample.select(F.col("text").cast("string").alias("text")).collect()])


def scanned(docs: DataFrame, network: Network | None = None) -> DataFrame:
    """doc_id, spans (start, end, kind) and text of every row of ``docs``.

    A null text counts as empty and has no spans. Repeated rows give repeated rows; rows with a
    null doc_id are scanned too. An empty table gives an empty table; the network then knows
    generated findings only. Further columns are ignored.
    """
    given = network or trained_on(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())])
        for batch in slices(batches):
            spans = [
                [{"start": s, "end": e, "kind": KINDS[k]} for s, k, e in found]
                for found in _findings([t or "" for t in batch.column("text").to_pylist()], given)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text"), pa.array(spans, pa.list_(kind))], names=["doc_id", "text", "spans"]
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, text string, spans array<struct<start: long, end: long, kind: string>>")


def redacted(docs: DataFrame, mask: str = "[secret]") -> DataFrame:
    """``docs`` with every finding in ``text`` replaced by ``mask`` and ``n_chars``, if there, counted anew.

    All rows and columns stay. Overlapping findings share one mask. Null texts stay null.
    """
    given = trained_on(docs)
    columns = docs.columns
    at, counted = columns.index("text"), columns.index("n_chars") if "n_chars" in columns else None

    def masked(text: str, found: list[tuple[int, int, int]]) -> str:
        out, done = [], 0
        for start, _, end in found:
            if start >= done:
                out += [text[done:start], mask]
            done = max(done, end)
        return "".join([*out, text[done:]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = batch.column(at).to_pylist()
            found = _findings([t or "" for t in texts], given)
            new = [None if t is None else masked(t, f) if f else t for t, f in zip(texts, found, strict=True)]
            arrays = list(batch.columns)
            if counted is not None:
                was = batch.column(counted).to_pylist()
                sizes = [len(n) if f else w for n, f, w in zip(new, found, was, strict=True)]
                arrays[counted] = pa.array(sizes, batch.column(counted).type)
            arrays[at] = pa.array(new, batch.column(at).type)
            yield pa.RecordBatch.from_arrays(arrays, schema=batch.schema)

    return docs.mapInArrow(run, docs.schema)


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scanned(table(spark, sf_dir, "documents"))

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def base(s):
        return s["kind"] != "model"

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    counts = {f"n_{k}": count(k) for k in KINDS[:3]}
    return rows.select(
        "doc_id", *(c.alias(n) for n, c in counts.items()),
        F.sha2(joined(F.filter("spans", base)).cast("binary"), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"),
    )
