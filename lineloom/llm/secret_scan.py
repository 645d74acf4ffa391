"""Secret scans through a trigram inverted index.

From each rule's regular expression a Boolean query over mandatory trigrams is derived.
The texts of a slice are indexed by the trigrams that occur in any query: a posting list of
rows for each. The queries intersect and unite postings, and the regular expression then
runs over the candidates only. A rule without mandatory trigrams is run over every text.
Index and queries disregard the case of ``A-Z``, so they can only let too much through.

An index over a slice of texts needs no shuffle, and holds a few thousand texts at a time.

Defined results: a null text is an empty one; repeated rows give a row each; spans are in
code points with exclusive ends. Other columns are not read by ``secret_spans`` and are
handed through by ``redacted``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache
from itertools import product
from re import _constants as op
from re import _parser as regex_tree
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lineloom.llm import texts


class Rule(NamedTuple):
    kind: str
    pattern: str
    #: Group whose length is checked, and the least length; matches that fail are dropped.
    group: int
    least: int


# The base kinds of the contract, in its order.
BASE = (
    Rule(
        "assign",
        r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        6,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]{24,}", 0, 24),
)
# A private key runs from its header to its end line. Where another header or the end of the
# text comes first, it runs over what follows in base64: long runs behind line breaks (also
# spelt ones), quotes or comment marks, and a last short one that has its line to itself.
_APART = r"""(?:\\[nrt]|[\s"'`+,;:.>#*|/\\-])"""
_FIELDS = rf"(?:{_APART}*+(?:Proc-Type|DEK-Info|Comment|Version):[^\r\n\\]*+)*+"
_RUNS = rf"(?:{_APART}*+[A-Za-z0-9+/]{{16,}}+={{0,2}})*+"
_LAST = r"""(?:["'+\x20\t]*(?:\\[nr]|[\r\n])+["'>#*|\x20\t]*[A-Za-z0-9+/]{1,15}={0,2}(?=["'+\x20\t]*(?:\\[nr]|[\r\n]|\Z)))?"""
_KEY = r"(?:[A-Z]+ )*PRIVATE KEY-----"
_PRIVATE_KEY = rf"-----BEGIN {_KEY}(?:(?:(?!-----BEGIN )[\s\S])*?-----END {_KEY}|{_FIELDS}{_RUNS}{_LAST})"
# Further kinds, with well-known forms of credentials.
MORE = (
    Rule("private_key", _PRIVATE_KEY, 0, 0),
    Rule("hub_token", r"gh[pousr]_[A-Za-z0-9]{36,}", 0, 0),
    Rule("chat_token", r"xox[abprs]-[0-9A-Za-z-]{10,}", 0, 0),
    Rule("maps_key", r"AIza[0-9A-Za-z_-]{35}", 0, 0),
    Rule("pay_key", r"[rs]k_live_[0-9A-Za-z]{16,}", 0, 0),
    Rule("package_token", r"npm_[A-Za-z0-9]{36}", 0, 0),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+", 0, 0),
    Rule("url_login", r"[a-z]{2,12}://[^\s:/@]{1,64}:[^\s:/@]{3,64}@", 0, 0),
    Rule("bearer", r"[Bb]earer [A-Za-z0-9._~+/-]{20,}=*", 0, 0),
)
RULES = BASE + MORE

#: A run of sets of characters is spelt out up to this many strings.
SPELT = 64


def trigram_query(pattern: str):
    """``True`` (no mandatory trigram), a trigram as bytes, or ``("all" | "any", parts)``."""

    def both(kind: str, parts: list):
        parts = [p for p in dict.fromkeys(parts) if not (kind == "all" and p is True)]
        if kind == "any" and True in parts or not parts:
            return True
        return parts[0] if len(parts) == 1 else (kind, tuple(parts))

    def of_strings(strings: set[str]):
        return both("any", [both("all", [s[i : i + 3].encode() for i in range(len(s) - 2)]) for s in sorted(strings)])

    def characters(items) -> set[str] | None:
        out: set[str] = set()
        for kind, value in items:
            if kind is op.LITERAL:
                out.add(chr(value).lower())
            elif kind is op.RANGE and value[1] - value[0] < 8:
                out |= {chr(c).lower() for c in range(value[0], value[1] + 1)}
            else:
                return None
        return out if len(out) <= 8 else None

    def walk(tree) -> tuple[set[str] | None, object]:
        """Every string the tree can match if these are few, and the query otherwise."""
        run, done, whole = {""}, [], True

        def flush():
            nonlocal run, whole
            done.append(of_strings(run))
            run, whole = {""}, False

        for kind, value in tree:
            strings, query = None, True
            if kind is op.LITERAL:
                strings = {chr(value).lower()}
            elif kind is op.IN:
                strings = characters(value)
            elif kind is op.SUBPATTERN:
                strings, query = walk(value[3])
            elif kind is op.BRANCH:
                sides = [walk(side) for side in value[1]]
                if all(s is not None for s, _ in sides):
                    strings = set().union(*(s for s, _ in sides))
                else:
                    query = both("any", [of_strings(s) if s is not None else q for s, q in sides])
            elif kind in (op.MAX_REPEAT, op.MIN_REPEAT):
                least, most, inner = value
                strings, query = walk(inner)
                if (least, most) == (0, 1) and strings is not None:
                    strings = strings | {""}
                elif (least, most) != (1, 1):
                    if least == 0:
                        query = True
                    elif strings is not None:
                        query = of_strings({"".join(p) for p in product(strings, repeat=min(least, 3))}) if len(strings) ** min(least, 3) <= SPELT else True
                    strings = None
            if strings is not None and len(run) * len(strings) <= SPELT:
                run = {a + b for a in run for b in strings}
            elif strings is not None:
                flush()
                run = strings
            else:
                flush()
                done.append(query)
        if whole:
            return run, of_strings(run)
        return None, both("all", [*done, of_strings(run)])

    strings, query = walk(regex_tree.parse(pattern))
    return of_strings(strings) if strings is not None else query


def _trigrams(query) -> set[bytes]:
    if query is True:
        return set()
    return {query} if isinstance(query, bytes) else set().union(*map(_trigrams, query[1]))


class Index:
    """Posting lists of rows for the trigrams that ``rules`` ask for."""

    def __init__(self, rules: tuple[Rule, ...]):
        self.queries = [trigram_query(rule.pattern) for rule in rules]
        self.wanted = sorted(set().union(*map(_trigrams, self.queries)))
        #: Bytes of wanted trigrams get small numbers, so three of them fit a short table.
        self.small = np.zeros(256, np.uint32)
        letters = sorted({b for t in self.wanted for b in t})
        self.width = len(letters) + 1
        self.small[letters] = np.arange(1, self.width)
        self.numbers = np.zeros(self.width**3, np.uint16)
        for number, t in enumerate(self.wanted, 1):
            a, b, c = (int(self.small[x]) for x in t)
            self.numbers[(a * self.width + b) * self.width + c] = number

    def postings(self, data: np.ndarray, offsets: np.ndarray) -> dict[bytes, np.ndarray]:
        code = self.small[texts.LOWER[data]]
        spelt = self.numbers[(code[:-2] * self.width + code[1:-1]) * self.width + code[2:]]
        at = np.flatnonzero(spelt)
        row = np.searchsorted(offsets, at, "right") - 1
        inside = at + 2 < offsets[row + 1]
        pairs = np.unique(spelt[at[inside]].astype(np.int64) * len(offsets) + row[inside])
        number, row = np.divmod(pairs, len(offsets))
        borders = np.searchsorted(number, np.arange(1, len(self.wanted) + 2))
        return {t: row[borders[i] : borders[i + 1]] for i, t in enumerate(self.wanted)}

    def candidates(self, query, postings: dict[bytes, np.ndarray], n: int) -> np.ndarray:
        if query is True:
            return np.arange(n)
        if isinstance(query, bytes):
            return postings[query]
        kind, parts = query
        out = self.candidates(parts[0], postings, n)
        for part in parts[1:]:
            other = self.candidates(part, postings, n)
            out = np.intersect1d(out, other, assume_unique=True) if kind == "all" else np.union1d(out, other)
        return out


@cache
def _ready(rules: tuple[Rule, ...]) -> tuple[Index, list[re.Pattern]]:
    return Index(rules), [re.compile(rule.pattern) for rule in rules]


def spans_of(column: pa.Array, rules: tuple[Rule, ...] = RULES) -> list[list[tuple[int, int, int]]]:
    """For each text its (start, end, number of the rule), by start and then rule."""
    index, patterns = _ready(rules)
    out: list[list[tuple[int, int, int]]] = []
    for first, last, data, offsets in texts.slices(column):
        postings = index.postings(data, offsets) if len(data) > 2 else dict.fromkeys(index.wanted, np.zeros(0, np.int64))
        found: list[list[tuple[int, int, int]]] = [[] for _ in range(last - first)]
        chosen = [index.candidates(query, postings, last - first) for query in index.queries]
        read = {int(row): bytes(data[offsets[row] : offsets[row + 1]]).decode() for row in np.unique(np.concatenate(chosen)).astype(int)}
        for number, (rule, pattern, rows) in enumerate(zip(rules, patterns, chosen)):
            for row in rows.tolist():
                found[row] += [(m.start(), m.end(), number) for m in pattern.finditer(read[row]) if m.end(rule.group) - m.start(rule.group) >= rule.least]
        out += [sorted(f, key=lambda s: (s[0], s[2])) for f in found]
    return out


def secret_spans(docs: DataFrame) -> DataFrame:
    """For each document its spans: kind, start and end, ordered by start and kind."""
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [[{"kind": RULES[k].kind, "start": a, "end": b} for a, b, k in row] for row in spans_of(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, pa.list_(span))], ["doc_id", "spans"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, spans array<struct<kind:string,start:long,end:long>>"
    )


def redacted(docs: DataFrame, mark: str = "[secret]") -> DataFrame:
    """The documents with every span replaced by ``mark`` (overlapping spans by one) and
    ``n_chars`` counted anew where a text changed; a null text stays null."""
    names = docs.columns
    at = names.index("text")
    length = names.index("n_chars") if "n_chars" in names else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in texts.parts(whole, at)):
            columns = list(batch.columns)
            spans = spans_of(columns[at])
            changed = columns[at].to_pylist()
            for row, found in enumerate(spans):
                if not found:
                    continue
                out, done = [], 0
                for a, b, _ in found:
                    if a >= done:
                        out += [changed[row][done:a], mark]
                    done = max(done, b)
                changed[row] = "".join([*out, changed[row][done:]])
            columns[at] = pa.array(changed, columns[at].type)
            if length is not None:
                counts = columns[length].to_pylist()
                columns[length] = pa.array([len(t) if found else n for t, found, n in zip(changed, spans, counts)], columns[length].type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(run, docs.schema)
