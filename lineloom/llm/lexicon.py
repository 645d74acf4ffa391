"""A minimal acyclic transducer from words to token ids, in one file that is memory-mapped.

States with equal continuations are one state, so common suffixes are stored once. Each arc
carries the number of words that precede those behind it; the sum along a word is its number,
and the number leads to its ids. Many words are looked up at a time, one byte per step.
"""

from __future__ import annotations

import numpy as np


def compiled(words: dict[bytes, list[int]]) -> bytes:
    """The file of the automaton for non-empty ``words`` and their ids."""
    register: dict[tuple, int] = {}
    size: list[int] = []  # words behind each finished state
    arcs_of: list[tuple] = []
    path: list[list] = [[False, []]]  # open states of the last word: [final, [(byte, state)]]

    def close(down_to: int, last: bytes) -> None:
        while len(path) > down_to + 1:
            final, arcs = path.pop()
            key = (final, tuple(arcs))
            if key not in register:
                register[key] = len(arcs_of)
                arcs_of.append(key)
                size.append(final + sum(size[target] for _, target in arcs))
            path[-1][1].append((last[len(path) - 1], register[key]))

    before, order = b"", sorted(words)
    for word in order:
        common = next((i for i, (a, b) in enumerate(zip(before, word)) if a != b), min(len(before), len(word)))
        close(common, before)
        path.extend([False, []] for _ in word[common:])
        path[-1][0] = True
        before = word
    close(0, before)
    final, arcs = path[0]
    register[final, tuple(arcs)] = len(arcs_of)
    arcs_of.append((final, tuple(arcs)))

    rows = []
    for state, (final, arcs) in enumerate(arcs_of):
        count = int(final)
        for byte, target in arcs:
            rows.append(((state << 8) | byte, target, count))
            count += size[target]
    table = np.array(sorted(rows), np.int64).reshape(-1, 3)
    lengths = np.array([len(words[w]) for w in order], np.int64)
    parts = (
        table[:, 0], table[:, 1], table[:, 2],
        np.array([final for final, _ in arcs_of], np.int64),
        np.concatenate([[0], np.cumsum(lengths)]),
        np.array([i for w in order for i in words[w]], np.int64),
    )
    head = np.array([max(map(len, order), default=0), *map(len, parts)], np.int64)
    return b"".join(np.ascontiguousarray(p, np.int64).tobytes() for p in (head, *parts))


class Lexicon:
    """A compiled file, mapped; workers on one machine share its pages."""

    def __init__(self, path: str):
        data = np.memmap(path, np.int64, "r")
        self.longest = int(data[0])
        borders = np.concatenate([[0], np.cumsum(data[1:7])]) + 7
        self.keys, self.targets, self.counts, self.final, self.offsets, self.ids = (data[a:b] for a, b in zip(borders[:-1], borders[1:]))

    def numbers(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """The number of each word of a byte array, -1 where it is not in the lexicon."""
        n, lengths = len(offsets) - 1, np.diff(offsets)
        out = np.full(n, -1, np.int64)
        live = np.flatnonzero((lengths > 0) & (lengths <= self.longest))
        state = np.full(len(live), len(self.final) - 1, np.int64)
        number = np.zeros(len(live), np.int64)
        for step in range(self.longest):
            ended = lengths[live] == step
            hit = ended & (self.final[state] == 1)
            out[live[hit]] = number[hit]
            live, state, number = live[~ended], state[~ended], number[~ended]
            if not len(live):
                return out
            key = (state << 8) | data[offsets[live] + step]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            good = self.keys[at] == key
            live, at = live[good], at[good]
            state, number = np.asarray(self.targets[at]), number[good] + self.counts[at]
        hit = (lengths[live] == self.longest) & (self.final[state] == 1)
        out[live[hit]] = number[hit]
        return out
