"""K-d trees over letter counts of words, searched for many words at once.

A word becomes the numbers of its letters, in ``DIMENSIONS`` counts: ``a`` to ``z`` each by
itself, the letters beyond ASCII folded into the rest. One inserted letter raises one count by
one, one deleted letter lowers one, one replaced letter does both at most. So words one
edit apart lie in a box around each other of one step up, one down, or one of each, and a
subtree is left out as soon as the steps to its box exceed these.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

DIMENSIONS = 32
_FOLD = np.arange(256) % (DIMENSIONS - 26) + 26
_FOLD[97:123] = np.arange(26)
#: Bytes of words and counts that are held at once.
AT_ONCE = 1 << 24


def letters(words: list[bytes]) -> np.ndarray:
    """Words of one length as rows of bytes."""
    return np.frombuffer(b"".join(words), np.uint8).reshape(len(words), -1)


def counts(rows: np.ndarray) -> np.ndarray:
    """Letter counts of words as rows of bytes, up to 255 of each letter."""
    out = np.zeros((len(rows), DIMENSIONS), np.uint8)
    step = max(1, AT_ONCE // (8 * max(rows.shape[1], DIMENSIONS)))
    for at in range(0, len(rows), step):
        part = rows[at : at + step]
        keys = _FOLD[part] + np.arange(len(part))[:, None] * DIMENSIONS
        out[at : at + step] = np.minimum(np.bincount(keys.reshape(-1), minlength=len(part) * DIMENSIONS), 255).reshape(-1, DIMENSIONS)
    return out


def packed(vectors: np.ndarray) -> np.ndarray:
    """Two bits of each count in one number."""
    fields = np.minimum(vectors, 3).astype(np.uint64) << (2 * np.arange(DIMENSIONS, dtype=np.uint64))
    return np.bitwise_or.reduce(fields, 1)


def at_most_two_differ(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Whether at most two counts differ, as far as ``packed`` numbers tell."""
    apart = x ^ y
    apart = (apart | (apart >> np.uint64(1))) & np.uint64(0x5555555555555555)
    return np.bitwise_count(apart) <= 2


@dataclass
class LetterTree:
    """Inner node: counts up to ``split`` of ``dimension`` go ``left``, others ``right``. Leaf:
    ``dimension`` is -1 and its points are ``order[left:right]``."""

    dimension: np.ndarray
    split: np.ndarray
    left: np.ndarray
    right: np.ndarray
    order: np.ndarray

    @classmethod
    def built(cls, vectors: np.ndarray, leaf: int) -> LetterTree:
        """A tree with at most ``leaf`` points in a leaf, more only where all have equal counts."""
        order = np.arange(len(vectors))
        nodes: list[list[int]] = [[-1, 0, 0, len(vectors)]]
        waiting = [0]
        while waiting:
            node = waiting.pop()
            _, _, first, last = nodes[node]
            if last - first <= leaf:
                continue
            own = vectors[order[first:last]]
            dimension = int(own.astype(np.float32).var(0).argmax())
            column = own[:, dimension]
            low, high = column.min(), column.max()
            if low == high:
                continue
            split = int(min(max(np.partition(column, (len(column) - 1) // 2)[(len(column) - 1) // 2], low), high - 1))
            goes_left = column <= split
            middle = first + int(goes_left.sum())
            order[first:last] = np.concatenate([order[first:last][goes_left], order[first:last][~goes_left]])
            nodes[node] = [dimension, split, len(nodes), len(nodes) + 1]
            waiting += [len(nodes), len(nodes) + 1]
            nodes += [[-1, 0, first, middle], [-1, 0, middle, last]]
        return cls(*np.array(nodes, np.int64).T.copy(), order)

    def leaves(self, vectors: np.ndarray, up: int, down: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of a row of ``vectors`` and a leaf whose box is at most ``up`` steps up and
        ``down`` steps down from it."""
        row, node = np.arange(len(vectors)), np.zeros(len(vectors), np.int64)
        ups, downs = (np.full(len(vectors), n, np.int64) for n in (up, down))
        found = []
        while len(row):
            dimension = self.dimension[node]
            at_leaf = dimension < 0
            found.append((row[at_leaf], node[at_leaf]))
            row, node, ups, downs, dimension = (x[~at_leaf] for x in (row, node, ups, downs, dimension))
            above = vectors[row, dimension].astype(np.int64) - self.split[node]
            spent_down, spent_up = np.maximum(above, 0), np.maximum(1 - above, 0)
            to_left, to_right = spent_down <= downs, spent_up <= ups
            row, node, ups, downs = (
                np.concatenate(pair)
                for pair in (
                    (row[to_left], row[to_right]),
                    (self.left[node[to_left]], self.right[node[to_right]]),
                    (ups[to_left], (ups - spent_up)[to_right]),
                    ((downs - spent_down)[to_left], downs[to_right]),
                )
            )
        return tuple(np.concatenate(x) for x in zip(*found)) if found else (row, node)


def one_edit_apart(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Whether words in the same row of ``x`` and ``y`` differ by one edit; both have words of one length."""
    if x.shape[1] > y.shape[1]:
        x, y = y, x
    if x.shape[1] == y.shape[1]:
        return (x != y).sum(1) == 1
    # equal letters from the front, and from the back
    front = np.logical_and.accumulate(x == y[:, :-1], 1).sum(1)
    back = np.logical_and.accumulate((x == y[:, 1:])[:, ::-1], 1).sum(1)
    return front + back >= x.shape[1]


class Cell:
    """Words of one length and their numbers, in a tree."""

    LEAF = 16

    def __init__(self, words: list[bytes], n: np.ndarray):
        # in code-point order: of equal numbers the first counts
        order = np.array(sorted(range(len(words)), key=words.__getitem__))
        self.words, self.n = [words[i] for i in order], n[order]
        self.letters = letters(self.words)
        self.length = self.letters.shape[1]
        vectors = counts(self.letters)
        self.packed = packed(vectors)
        self.tree = LetterTree.built(vectors, self.LEAF)

    def near(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """For words of one length: how many words of the cell are one edit apart, and the
        place of the first of those with the largest number."""
        rows = letters(words)
        vectors = counts(rows)
        longer = self.length - rows.shape[1]
        row, leaf = self.tree.leaves(vectors, int(longer >= 0), int(longer <= 0))
        order = np.argsort(row, kind="stable")
        row, leaf = row[order], leaf[order]
        first, last = self.tree.left[leaf], self.tree.right[leaf]
        found, best = np.zeros(len(words), np.int64), np.full(len(words), -1, np.int64)
        sizes, mine = np.cumsum(last - first), packed(vectors)
        done = 0
        while done < len(row):
            # so many pairs at once that their letters fit
            taken = max(done + 1, int(np.searchsorted(sizes, (sizes[done - 1] if done else 0) + AT_ONCE // 16)))
            length = (last - first)[done:taken]
            a = np.repeat(row[done:taken], length)
            inside = np.arange(len(a)) - np.repeat(np.cumsum(length) - length, length)
            b = self.tree.order[np.repeat(first[done:taken], length) + inside]
            may = at_most_two_differ(mine[a], self.packed[b])
            a, b = a[may], b[may]
            step = max(1, AT_ONCE // (2 * self.length))
            hits = [np.flatnonzero(one_edit_apart(rows[a[k : k + step]], self.letters[b[k : k + step]])) + k for k in range(0, len(a), step)]
            hit = np.concatenate([np.zeros(0, np.int64), *hits])
            a, b = a[hit], b[hit]
            found += np.bincount(a, minlength=len(words))
            # the last written of a row is the best
            order = np.lexsort((-b, self.n[b], a))
            a, b = a[order], b[order]
            ends = np.flatnonzero(np.append(a[1:] != a[:-1], True)) if len(a) else a
            a, b = a[ends], b[ends]
            old = best[a]
            better = (old < 0) | (self.n[b] > self.n[old]) | ((self.n[b] == self.n[old]) & (b < old))
            best[a[better]] = b[better]
            done = taken
        return found, best
