"""Minimal acyclic transducers: sets of byte strings that map each of their strings to its place in byte order.

``build`` takes the strings in order and merges equal suffixes as soon as they are complete
(incremental construction). An edge puts out how many strings come before those behind it, so
the outputs along a path add up to the place of its string. ``places`` walks many strings at
once, one byte of each in every step.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np

_FREE = np.int64(-1)
_MIX = np.uint64(0x9E3779B97F4A7C15)


@dataclass
class Transducer:
    """Edges in an open hash table by state and byte; ``n`` strings."""

    n: int
    root: int
    final: np.ndarray
    slots: np.ndarray
    target: np.ndarray
    output: np.ndarray

    def _step(self, state: np.ndarray, byte: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Next states (-1 where there is no edge) and outputs."""
        edge = (state << 8) | byte
        at = _place(edge, len(self.slots))
        found = self.slots[at]
        searching = np.flatnonzero((found != edge) & (found != _FREE))
        while len(searching):
            at[searching] = (at[searching] + 1) & (len(self.slots) - 1)
            found[searching] = now = self.slots[at[searching]]
            searching = searching[(now != edge[searching]) & (now != _FREE)]
        return np.where(found == edge, self.target[at], -1), self.output[at]

    def start(self, prefix: bytes) -> tuple[int, int]:
        """State and output after a prefix; state -1 if no string has it."""
        state, total = self.root, 0
        for byte in prefix:
            if state < 0:
                break
            to, out = self._step(np.array([state], np.int64), np.array([byte], np.int64))
            state, total = int(to[0]), total + int(out[0])
        return state, total

    def places(self, data: np.ndarray, begin: np.ndarray, end: np.ndarray, state: np.ndarray, total: np.ndarray) -> np.ndarray:
        """Place of each string data[begin:end] behind its start (state, total); -1 if it is not in the set."""
        out = np.full(len(begin), -1, np.int64)
        live = np.flatnonzero(state >= 0)
        at, end, state, total = begin[live], end[live], state[live], total[live]
        while len(live):
            done = at == end
            if done.any():
                ended = np.flatnonzero(done)
                ended = ended[self.final[state[ended]]]
                out[live[ended]] = total[ended]
                live, at, end, state, total = (x[~done] for x in (live, at, end, state, total))
            state, put = self._step(state, data[at].astype(np.int64))
            on = state >= 0
            live, at, end, state, total = live[on], at[on] + 1, end[on], state[on], (total + put)[on]
        return out


def _place(edge: np.ndarray, size: int) -> np.ndarray:
    return ((edge.astype(np.uint64) * _MIX) >> np.uint64(64 - size.bit_length() + 1)).astype(np.int64)


def build(strings: Iterable[bytes]) -> Transducer:
    """The transducer of distinct strings in ascending byte order."""
    known: dict[tuple, int] = {}
    counts: list[int] = []
    open_nodes: list[list] = [[False]]
    last = b""

    def closed(depth: int) -> None:
        """Nodes deeper than ``depth`` on the last path are complete: each becomes a state, or one like it does."""
        for k in range(len(last), depth, -1):
            node = tuple(open_nodes.pop())
            state = known.get(node)
            if state is None:
                state = known[node] = len(counts)
                counts.append(node[0] + sum(counts[s] for s in node[2::2]))
            open_nodes[-1] += (last[k - 1], state)

    n = 0
    for string in strings:
        if n and string <= last:
            raise ValueError("strings must ascend")
        shared = 0
        for x, y in zip(string, last, strict=False):
            if x != y:
                break
            shared += 1
        closed(shared)
        open_nodes.extend([False] for _ in range(len(string) - shared))
        open_nodes[-1][0] = True
        last = string
        n += 1
    closed(0)
    root = tuple(open_nodes[0])
    if root not in known:
        known[root] = len(known)

    final = np.zeros(len(known), bool)
    edges, targets, outputs = [], [], []
    for node, state in known.items():
        final[state] = before = node[0]
        for byte, to in zip(node[1::2], node[2::2], strict=True):
            edges.append(state << 8 | byte)
            targets.append(to)
            outputs.append(int(before))
            before += counts[to]
    return Transducer(n, known[root], final, *_table(np.array(edges, np.int64), np.array(targets, np.int32), np.array(outputs, np.int64)))


def _table(edges: np.ndarray, targets: np.ndarray, outputs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    size = 1 << max(4, int(2 * len(edges)).bit_length())
    slots = np.full(size, _FREE)
    target, output = np.zeros(size, np.int32), np.zeros(size, np.int64)
    left, at = np.arange(len(edges)), _place(edges, size)
    while len(left):
        free = slots[at] == _FREE
        first = np.zeros(len(left), bool)
        first[np.unique(at, return_index=True)[1]] = True
        put = free & first
        slots[at[put]], target[at[put]], output[at[put]] = edges[left[put]], targets[left[put]], outputs[left[put]]
        left, at = left[~put], (at[~put] + 1) & (size - 1)
    return slots, target, output
