"""Fill-in-middle texts by displacement scatter.

A text is cut at two token borders into prefix, middle and suffix, which come out in another
order between marks. All texts of a slice are moved together, as one array of bytes: a scan
finds the cuts, a difference array has at each cut by how much the displacement changes there,
its cumulative sum is the displacement of every byte, and one scatter writes all outputs.
``restored`` finds the marks and goes the other way with one gather.

Tokens are runs of ASCII letters and every other code point by itself. The cuts and the form
come from a hash of the id alone, so reruns agree. A text that holds a mark is left plain, which
makes the marks of all others findable.

Defined results: null and empty texts have no tokens, are plain and give an empty output; a
row without id hashes as an empty id; repeated rows are returned as often as they stand, an
empty table gives no rows. Other columns than ``doc_id`` and ``text`` are not read. Texts are
moved in slices of whole texts, so memory follows the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lineloom.llm import texts

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
MARK = 3
#: Percent of texts that are left plain, and of the others that begin with the suffix.
PLAIN, SUFFIX_FIRST = 10, 20
FORMS = ("plain", "psm", "spm")
SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_KIND = np.zeros(256, bool)
_KIND[[PREFIX[1], SUFFIX[1], MIDDLE[1]]] = True


def _tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte of each token, and for each text the number of its first token (one more at the end)."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    letter = _LETTER[data]
    after = np.empty_like(letter)
    after[0] = False
    after[1:] = letter[:-1]
    after[offsets[:-1][offsets[:-1] < len(data)]] = False
    starts = np.flatnonzero(np.where(letter, ~after, (data & 0xC0) != 0x80))
    return starts, np.searchsorted(starts, offsets)


def _marks(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where marks begin, and the text that each is in."""
    if len(data) < MARK:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.flatnonzero((data[:-2] == PREFIX[0]) & _KIND[data[1:-1]] & (data[2:] == PREFIX[2]))
    row = np.searchsorted(offsets, at, "right") - 1
    inside = at + MARK <= offsets[row + 1]
    return at[inside], row[inside]


def _displacements(n: int, places: list[np.ndarray], shifts: list[np.ndarray]) -> np.ndarray:
    """For each of ``n`` bytes the shift of its segment. Text by text, segments begin at
    ``places`` in the order of the lists; empty ones begin where the next does."""
    begins, moves = np.stack(places, 1).reshape(-1), np.stack(shifts, 1).reshape(-1)
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, begins, np.diff(moves, prepend=0))
    return np.cumsum(change[:-1])


def _strings(data: np.ndarray, offsets: np.ndarray, missing: np.ndarray | None = None) -> pa.Array:
    """Texts that lie one behind the other in ``data``."""
    valid = None if missing is None or not missing.any() else pa.py_buffer(np.packbits(~missing, bitorder="little").tobytes())
    return pa.StringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets.astype(np.int32).tobytes()), pa.py_buffer(data.tobytes()), valid)


def scattered(data: np.ndarray, offsets: np.ndarray, chosen: list[np.ndarray]) -> tuple[np.ndarray, ...]:
    """Numbers of tokens, forms (places in ``FORMS``), code points of prefix and middle, and
    the outputs with their offsets; ``chosen`` has four numbers for each text."""
    starts, first = _tokens(data, offsets)
    begin, end, n = offsets[:-1], offsets[1:], np.diff(first)
    h1, h2, h3, h4 = chosen
    cuts = np.sort(np.stack([h1 % (n + 1), h2 % (n + 1)]), 0)
    starts = np.append(starts, len(data))
    p, m = (np.where(cut < n, starts[first[:-1] + np.minimum(cut, n)], end) for cut in cuts)
    form = np.where(h4 % 100 < SUFFIX_FIRST, 2, 1)
    form[(h3 % 100 >= 100 - PLAIN) | (end == begin)] = 0
    form[_marks(data, offsets)[1]] = 0

    to = np.zeros(len(offsets), np.int64)
    np.cumsum(end - begin + np.where(form > 0, 3 * MARK, 0), out=to[1:])
    at, before, behind = to[:-1], p - begin, end - m
    # where prefix, suffix and middle go
    prefix = np.select([form == 1, form == 2], [at + MARK, at + 2 * MARK + behind], at)
    suffix = np.select([form == 1, form == 2], [at + 2 * MARK + before, at + MARK], at + m - begin)
    middle = np.where(form > 0, at + 3 * MARK + before + behind, at + before)
    out = np.zeros(int(to[-1]), np.uint8)
    shift = _displacements(len(data), [begin, p, m], [prefix - begin, middle - p, suffix - m])
    out[np.arange(len(data)) + shift] = data
    moved = form > 0
    for mark, place in ((PREFIX, prefix), (SUFFIX, suffix), (MIDDLE, middle)):
        out[place[moved, None] - MARK + np.arange(MARK)] = np.frombuffer(mark, np.uint8)
    ends = texts.char_ends(data.tobytes())
    return n, form, ends[p] - ends[begin], ends[m] - ends[p], out, to


def gathered(data: np.ndarray, offsets: np.ndarray, form: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The texts that outputs were made of with their offsets, and which outputs lack the marks of their form."""
    begin, end = offsets[:-1], offsets[1:]
    at, row = _marks(data, offsets)
    at, row = at[form[row] > 0], row[form[row] > 0]
    wrong = (form > 0) & (np.bincount(row, minlength=len(form)) != 3)
    at, row = at[~wrong[row]], row[~wrong[row]]
    marks = np.zeros((len(form), 3), np.int64)
    marks[row[::3]] = at.reshape(-1, 3)
    good = (form > 0) & ~wrong
    kinds = data[marks[good] + 1]
    order = np.array([[0, 0, 0], [PREFIX[1], SUFFIX[1], MIDDLE[1]], [SUFFIX[1], PREFIX[1], MIDDLE[1]]])
    wrong[good] = (kinds != order[form[good]]).any(1)
    good &= ~wrong

    first, second, third = (np.where(good, marks[:, k] + MARK, begin) for k in range(3))
    first_n, second_n = (np.where(good, marks[:, k + 1] - marks[:, k] - MARK, 0) for k in range(2))
    third_n = np.where(wrong, 0, np.where(good, end - third, end - begin))
    psm = form == 1
    prefix, suffix = np.where(psm, first, second), np.where(psm, second, first)
    prefix_n, suffix_n = np.where(psm, first_n, second_n), np.where(psm, second_n, first_n)
    to = np.zeros(len(offsets), np.int64)
    np.cumsum(first_n + second_n + third_n, out=to[1:])
    places = [to[:-1], to[:-1] + prefix_n, to[1:] - suffix_n]
    back = _displacements(int(to[-1]), places, [source - place for source, place in zip((prefix, third, suffix), places)])
    return data[np.arange(len(back)) + back], to, wrong


def _transform(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = pa.array(FORMS)
    for batch in batches:
        chosen = [np.asarray(batch.column(c), np.int64) for c in range(2, 6)]
        for first, last, data, offsets in texts.slices(batch.column(1)):
            n, form, before, middle, out, to = scattered(data, offsets, [h[first:last] for h in chosen])
            plain = form == 0
            columns = [
                batch.column(0)[first:last],
                pa.array(n),
                names.take(pa.array(form)),
                pa.array(before, pa.int64(), mask=plain),
                pa.array(middle, pa.int64(), mask=plain),
                _strings(out, to),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])


def transformed(docs: DataFrame) -> DataFrame:
    """For each text its tokens, form, the code points of prefix and middle, and the output."""
    told = F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    chosen = [F.conv(F.substring(told, 8 * k + 1, 8), 16, 10).cast("long").alias(f"h{k + 1}") for k in range(4)]
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *chosen).mapInArrow(_transform, SCHEMA)


def _restore(output: int, form: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            forms = np.array([FORMS.index(f) if f in FORMS else 0 for f in batch.column(form).to_pylist()], np.int64)
            for first, last, data, offsets in texts.slices(batch.column(output)):
                found = _strings(*gathered(data, offsets, forms[first:last]))
                part = batch.slice(first, last - first)
                yield pa.RecordBatch.from_arrays([*part.columns, found], [*part.schema.names, "restored"])

    return run


def restored(outputs: DataFrame) -> DataFrame:
    """``outputs`` (with ``form`` and ``output``) and the text each was made of, ``restored``;
    null where an output lacks the marks of its form. Other forms than the known count as plain."""
    schema = T.StructType([*outputs.schema.fields, T.StructField("restored", T.StringType())])
    return outputs.mapInArrow(_restore(outputs.columns.index("output"), outputs.columns.index("form")), schema)
