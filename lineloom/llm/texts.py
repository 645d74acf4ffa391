"""Whole texts of an Arrow column as byte arrays: words and hashes by NumPy.

UTF-8 keeps every ASCII byte to itself, so words whose borders are ASCII characters are
found on the bytes. Everything works on slices of about ``SLICE`` bytes of whole texts; a
longer text is a slice of its own, so memory follows the longest text and not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE = 1 << 20

#: ``A-Z`` to ``a-z``, every other byte to itself.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Bytes of words between white space: all but space and tab to carriage return.
SPACED = np.ones(256, bool)
SPACED[[32, 9, 10, 11, 12, 13]] = False
#: Bytes of alphanumeric words once lower-cased: digits, ``a-z``, all beyond ASCII.
ALNUM = np.zeros(256, bool)
ALNUM[48:58] = ALNUM[97:123] = ALNUM[128:] = True
#: Bytes to lower-cased alphanumeric bytes or a space, for ``bytes.translate``.
NORMAL = bytes(int(LOWER[b]) if ALNUM[LOWER[b]] else 32 for b in range(256))

_ODD = np.uint64(0x9E3779B97F4A7C15)
_MUL = np.uint64(0xBF58476D1CE4E5B9)
_VALUES = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0xD6E8FEB86659FD93
_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values; a bijection."""
    x = np.asarray(x, np.uint64)
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(32))) * _MUL
        x = (x ^ (x >> np.uint64(29))) * _ODD
    return x ^ (x >> np.uint64(32))


def as_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the offset of each row; null is empty."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), offsets


def slices(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """First row, row behind the last, bytes and offsets of each slice of whole texts."""
    data, offsets = as_bytes(column)
    row = 0
    while row < len(column):
        last = int(np.searchsorted(offsets, offsets[row] + SLICE, "right")) - 1
        last = min(max(last, row + 1), len(column))
        yield row, last, data[offsets[row] : offsets[last]], offsets[row : last + 1] - offsets[row]
        row = last


def parts(batch: pa.RecordBatch, at: int) -> Iterator[pa.RecordBatch]:
    """``batch`` in slices of the texts in column ``at``, so that what is made of it stays small."""
    for first, last, _, _ in slices(batch.column(at)):
        yield batch.slice(first, last - first)


def words(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of each word, and for each row the number of its first word (one more entry at the end)."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    within = inside[data]
    before = np.empty_like(within)
    before[0] = False
    before[1:] = within[:-1]
    borders = offsets[:-1][offsets[:-1] < len(data)]
    before[borders] = False
    starts = np.flatnonzero(within & ~before)
    after = np.empty_like(within)
    after[-1] = False
    after[:-1] = within[1:]
    after[borders[borders > 0] - 1] = False
    ends = np.flatnonzero(within & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def _power_table(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers.get("up", ())) < n:
        n = max(n, SLICE + 4096)
        with np.errstate(over="ignore"):
            for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
                steps = np.full(n, np.uint64(base))
                steps[0] = 1
                _powers[name] = np.multiply.accumulate(steps)
    return _powers["up"], _powers["down"]


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each word, the same wherever the word stands."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    up, down = _power_table(len(data) + 1)
    with np.errstate(over="ignore"):
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_VALUES[data] * up[: len(data)], out=sums[1:])
        return mix((sums[ends] - sums[starts]) * down[starts])


def chained(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` consecutive values; runs over row borders are the caller's to leave out."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        out = hashes[: len(hashes) - n + 1].copy()
        for k in range(1, n):
            out = mix(out * _ODD + hashes[k : len(hashes) - n + 1 + k])
    return out


def normal(text: bytes) -> bytes:
    """Lower-cased alphanumeric words of a text, each between single spaces; empty without words."""
    found = text.translate(NORMAL).split()
    return b" " + b" ".join(found) + b" " if found else b""


def char_ends(data: bytes) -> np.ndarray:
    """For each byte offset of UTF-8 ``data``, the number of code points before it."""
    first = (np.frombuffer(data, np.uint8) & 0xC0) != 0x80
    return np.concatenate([[0], np.cumsum(first)])
