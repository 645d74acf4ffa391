"""License scans by ordered signature rules.

A rule is a regular expression over the lower-cased alphanumeric words of a text, set
between single spaces, with a keyword, a label and a priority. A text is held against a
rule only if it contains the rule's keyword. Detections are taken in the order of priority,
then length, then place; one that lies inside a taken detection is suppressed. The base
phrases are counted for themselves and always keep their labels.

Defined results: a null or wordless text has no words, no labels (empty strings) and the
score 0; repeated rows give a row each. Other columns are not read.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lineloom.llm import texts

# The phrases of the contract and their labels.
BASE = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))

# Label, name as a pattern over normalised words, keyword every match holds.
LICENSES = (
    ("mit", r"(?:the )?mit(?: license| licence)?", " mit "),
    ("mit-0", r"(?:the )?mit (?:no attribution|0)(?: license)?", " mit "),
    ("x11", r"(?:the )?(?:mit )?x11(?: license)?", " x11 "),
    ("expat", r"(?:the )?expat(?: license)?", " expat "),
    ("apache-2", r"(?:the )?apache(?: software)?(?: license)?(?: version| v)? ?2(?: 0)?", " apache "),
    ("apache-1.1", r"(?:the )?apache(?: software)?(?: license)?(?: version| v)? ?1 1", " apache "),
    ("apache-1.0", r"(?:the )?apache(?: software)?(?: license)?(?: version| v)? ?1 0", " apache "),
    ("gpl-2.0", r"(?:the )?(?:gnu )?(?:general public license|gpl)(?: version| v)? ?2(?: 0)?", " "),
    ("gpl-3.0", r"(?:the )?(?:gnu )?(?:general public license|gpl)(?: version| v)? ?3(?: 0)?", " "),
    ("gpl", r"(?:the )?(?:gnu general public license|gnu gpl)", " gnu "),
    ("lgpl-2.0", r"(?:the )?(?:gnu )?(?:library general public license|lgpl)(?: version| v)? ?2 0", " "),
    ("lgpl-2.1", r"(?:the )?(?:gnu )?(?:lesser general public license|lgpl)(?: version| v)? ?2 1", " "),
    ("lgpl-3.0", r"(?:the )?(?:gnu )?(?:lesser general public license|lgpl)(?: version| v)? ?3(?: 0)?", " "),
    ("lgpl", r"(?:the )?gnu (?:lesser general public license|lgpl)", " gnu "),
    ("agpl-3.0", r"(?:the )?(?:gnu )?(?:affero general public license|agpl)(?: version| v)? ?3(?: 0)?", " "),
    ("agpl", r"(?:the )?gnu (?:affero general public license|agpl)", " gnu "),
    ("gfdl-1.1", r"(?:the )?(?:gnu )?(?:free documentation license|gfdl|fdl)(?: version| v)? ?1 1", " "),
    ("gfdl-1.2", r"(?:the )?(?:gnu )?(?:free documentation license|gfdl|fdl)(?: version| v)? ?1 2", " "),
    ("gfdl-1.3", r"(?:the )?(?:gnu )?(?:free documentation license|gfdl|fdl)(?: version| v)? ?1 3", " "),
    ("bsd-1-clause", r"(?:the )?(?:bsd 1 clause|1 clause bsd|one clause bsd)(?: license)?", " bsd "),
    ("bsd-2-clause", r"(?:the )?(?:bsd 2 clause|2 clause bsd|two clause bsd|simplified bsd|freebsd)(?: license)?", "bsd "),
    ("bsd-3-clause", r"(?:the )?(?:bsd 3 clause|3 clause bsd|three clause bsd|new bsd|modified bsd|revised bsd)(?: license)?", " bsd "),
    ("bsd-4-clause", r"(?:the )?(?:bsd 4 clause|4 clause bsd|four clause bsd|original bsd|old bsd)(?: license)?", " bsd "),
    ("0bsd", r"(?:the )?(?:0bsd|zero clause bsd|bsd zero clause)(?: license)?", "bsd"),
    ("bsd", r"(?:the |a )?bsd(?: style)? licen[sc]e", " bsd "),
    ("isc", r"(?:the )?isc(?: license)?", " isc "),
    ("zlib", r"(?:the )?zlib(?: libpng)?(?: license)?", " zlib "),
    ("libpng", r"(?:the )?libpng(?: license)?", " libpng "),
    ("bzip2", r"(?:the )?bzip2(?: license)?", " bzip2 "),
    ("openssl", r"(?:the )?openssl(?: license)?", " openssl "),
    ("curl", r"(?:the )?curl license", " curl "),
    ("python-2.0", r"(?:the )?(?:python software foundation license|psf license|python license)(?: version)?(?: 2(?: 0)?)?", " license "),
    ("php-3.0", r"(?:the )?php license(?: version| v)? ?3 0", " php "),
    ("php-3.01", r"(?:the )?php license(?: version| v)? ?3 01", " php "),
    ("ruby", r"(?:the )?ruby license", " ruby "),
    ("artistic-1.0", r"(?:the )?(?:perl )?artistic license(?: version)? ?1 0", " artistic "),
    ("artistic-2.0", r"(?:the )?(?:perl )?artistic license(?: version)? ?2 0", " artistic "),
    ("mpl-1.0", r"(?:the )?(?:mozilla public license|mpl)(?: version| v)? ?1 0", " "),
    ("mpl-1.1", r"(?:the )?(?:mozilla public license|mpl)(?: version| v)? ?1 1", " "),
    ("mpl-2.0", r"(?:the )?(?:mozilla public license|mpl)(?: version| v)? ?2(?: 0)?", " "),
    ("epl-1.0", r"(?:the )?(?:eclipse public license|epl)(?: version| v)? ?1(?: 0)?", " "),
    ("epl-2.0", r"(?:the )?(?:eclipse public license|epl)(?: version| v)? ?2(?: 0)?", " "),
    ("cddl-1.0", r"(?:the )?(?:common development and distribution license|cddl)(?: version| v)?(?: ?1 0)?", " "),
    ("cpl-1.0", r"(?:the )?common public license(?: version| v)?(?: ?1 0)?", " common public license "),
    ("ipl-1.0", r"(?:the )?ibm public license(?: version| v)?(?: ?1 0)?", " ibm "),
    ("eupl-1.1", r"(?:the )?(?:european union public licen[sc]e|eupl)(?: version| v)? ?1 1", " "),
    ("eupl-1.2", r"(?:the )?(?:european union public licen[sc]e|eupl)(?: version| v)? ?1 2", " "),
    ("ms-pl", r"(?:the )?(?:microsoft public license|ms pl)", " "),
    ("ms-rl", r"(?:the )?(?:microsoft reciprocal license|ms rl)", " "),
    ("bsl-1.0", r"(?:the )?boost software license(?: version)?(?: 1(?: 0)?)?", " boost "),
    ("busl-1.1", r"(?:the )?business source license(?: version)?(?: 1(?: 1)?)?", " business source "),
    ("sspl-1.0", r"(?:the )?(?:server side public license|sspl)(?: version| v)?(?: 1)?", " "),
    ("elastic-2.0", r"(?:the )?elastic license(?: version| v)?(?: ?2(?: 0)?)?", " elastic "),
    ("unlicense", r"(?:the )?unlicense", " unlicense "),
    ("wtfpl", r"(?:the )?wtfpl", " wtfpl "),
    ("cc0-1.0", r"(?:the )?(?:creative commons zero|creative commons cc0|cc0)(?: license)?(?: 1 0)?", " "),
    ("cc-by", r"(?:the )?(?:creative commons attribution|cc by)(?: license)?(?: \d 0)?", " "),
    ("cc-by-sa", r"(?:the )?(?:creative commons attribution share ?alike|cc by sa)(?: license)?(?: \d 0)?", " "),
    ("cc-by-nd", r"(?:the )?(?:creative commons attribution no ?deriv(?:ative)?s|cc by nd)(?: license)?(?: \d 0)?", " "),
    ("cc-by-nc", r"(?:the )?(?:creative commons attribution non ?commercial|cc by nc)(?: license)?(?: \d 0)?", " "),
    ("cc-by-nc-sa", r"(?:the )?(?:creative commons attribution non ?commercial share ?alike|cc by nc sa)(?: license)?(?: \d 0)?", " "),
    ("cc-by-nc-nd", r"(?:the )?(?:creative commons attribution non ?commercial no ?deriv(?:ative)?s|cc by nc nd)(?: license)?(?: \d 0)?", " "),
    ("odbl-1.0", r"(?:the )?(?:open data commons )?(?:open database license|odbl)(?: 1 0)?", " "),
    ("odc-by-1.0", r"(?:the )?open data commons attribution license(?: 1 0)?", " open data commons "),
    ("pddl-1.0", r"(?:the )?(?:open data commons )?public domain dedication and license", " public domain "),
    ("ofl-1.1", r"(?:the )?(?:sil )?open font license(?: version)?(?: 1 1)?", " open font "),
    ("afl-3.0", r"(?:the )?academic free license(?: version| v)?(?: 3 0)?", " academic free "),
    ("osl-3.0", r"(?:the )?open software license(?: version| v)?(?: 3 0)?", " open software license "),
    ("ncsa", r"(?:the )?(?:university of illinois )?ncsa(?: open source)? license", " ncsa "),
    ("postgresql", r"(?:the )?postgresql license", " postgresql "),
    ("upl-1.0", r"(?:the )?universal permissive license(?: version| v)?(?: 1 0)?", " universal permissive "),
    ("vim", r"(?:the )?vim license", " vim "),
    ("w3c", r"(?:the )?w3c software(?: notice and)? license", " w3c "),
    ("zpl-2.1", r"(?:the )?zope public license(?: version)?(?: 2 1)?", " zope "),
    ("lppl-1.3c", r"(?:the )?latex project public license(?: version)?(?: 1 3c?)?", " latex "),
    ("mulan-psl-2.0", r"(?:the )?mulan (?:permissive software license|psl)(?: version| v)?(?: ?2(?: 0)?)?", " mulan "),
)

# Clauses of license texts, without the name of the license.
CLAUSES = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy", "hereby granted"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose", "permission to use"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "redistribution"),
    ("bsd-3-clause", "neither the name of .{1,80}? nor the names of its contributors", "contributors"),
    ("gpl", "this program is free software you can redistribute it and or modify it", "free software"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", "mozilla"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "unencumbered"),
    ("zlib", "this software is provided as is without any express or implied warranty in no event", "as is"),
    ("public-domain", "(?:released|placed|dedicated) (?:in|into|to) the public domain", "public domain"),
    ("proprietary", "proprietary and confidential", "proprietary"),
)

#: Kinds of signature, strongest first: wording around a license's name, its weight, and
#: the keyword that the wording brings.
NOTICE = r"(?:licensed|released|distributed|available|published|provided|covered|offered|issued)(?: as open source)? under (?:the )?(?:terms? (?:and conditions )?of )?"


class Rule(NamedTuple):
    label: str
    kind: str
    priority: int
    keywords: tuple[bytes, ...]
    pattern: re.Pattern


@cache
def rules() -> tuple[Rule, ...]:
    """All signatures in their order: for each license a tag, a notice, an address and its
    name in the words of a license, then the clauses."""
    out = []
    for label, name, keyword in LICENSES:
        tag = re.escape(label.replace("-", " ").replace(".", " ")).replace(r"\ ", " ")
        for kind, priority, words, more in (
            ("tag", 4, rf"spdx license identifier {tag}(?: only| or later)?", "spdx"),
            ("notice", 3, NOTICE + name, " under "),
            ("address", 2, rf"(?:opensource org licenses?|creativecommons org licenses|spdx org licenses|gnu org licenses|apache org licenses) (?:license )?{tag}", " org "),
            ("name", 1, rf"{name} licen[sc]e|licen[sc]e {name}", " licen"),
        ):
            gates = [more, *([keyword] if kind in ("notice", "name") and keyword.strip() else [])]
            out.append(Rule(label, kind, priority, tuple(g.encode() for g in gates), re.compile(f" (?:{words})(?= )".encode())))
    out += [Rule(label, "clause", 2, (keyword.encode(),), re.compile(f" (?:{words})(?= )".encode())) for label, words, keyword in CLAUSES]
    return tuple(sorted(out, key=lambda r: -r.priority))


@cache
def _gated() -> tuple[tuple[bytes, tuple[Rule, ...]], ...]:
    """Rules under their first keyword, so each of these is looked for once in a text."""
    by: dict[bytes, list[Rule]] = {}
    for rule in rules():
        by.setdefault(rule.keywords[0], []).append(rule)
    return tuple((k, tuple(v)) for k, v in by.items())


def detections(plain: bytes) -> list[tuple[str, str, int, int, int]]:
    """Label, kind, priority, first word and word behind the last of each kept detection."""
    found = []
    for keyword, group in _gated():
        if keyword not in plain:
            continue
        for rule in group:
            if all(k in plain for k in rule.keywords[1:]):
                found += [(rule.priority, m.start(), m.end(), rule.label, rule.kind) for m in rule.pattern.finditer(plain)]
    kept, starts, ends = [], [], []  # taken intervals that no other holds, by start and so by end
    for one in sorted(found, key=lambda d: (-d[0], d[1] - d[2], d[1], d[3])):
        first, last = one[1:3]
        at = bisect_right(starts, first)
        if at and last <= ends[at - 1]:
            continue
        kept.append(one)
        # those the new interval holds
        low, high = bisect_left(starts, first), bisect_right(ends, last)
        starts[low : max(low, high)], ends[low : max(low, high)] = [first], [last]
    numbers = _words_before(plain, [place for one in kept for place in one[1:3]])
    spans = [(label, kind, priority, numbers[2 * i], numbers[2 * i + 1], a, b) for i, (priority, a, b, label, kind) in enumerate(kept)]
    return [one[:5] for one in sorted(spans, key=lambda d: (d[5], d[6], d[0], d[1]))]


def _words_before(plain: bytes, places: list[int]) -> list[int]:
    """How many blanks stand before each place."""
    if not places:
        return []
    blanks = np.flatnonzero(np.frombuffer(plain, np.uint8) == 32)
    return np.searchsorted(blanks, places).tolist()


def _base(plain: bytes) -> list[tuple[int, str]]:
    places, labels = [], []
    for phrase, label in BASE:
        wanted, at = f" {phrase} ".encode(), -1
        while (at := plain.find(wanted, at + 1)) >= 0:
            places.append(at)
            labels.append(label)
    return list(zip(_words_before(plain, places), labels))


_DETECTION = pa.struct([("label", pa.string()), ("kind", pa.string()), ("priority", pa.int32()), ("first", pa.int64()), ("end", pa.int64())])


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n_words, base, found = [], [], []
        for text in batch.column(1):
            plain = texts.normal(text.as_buffer().to_pybytes()) if text.is_valid else b""
            n_words.append(plain.count(b" ") - 1 if plain else 0)
            base.append([{"word": w, "label": label} for w, label in _base(plain)])
            found.append([dict(zip(("label", "kind", "priority", "first", "end"), d)) for d in detections(plain)])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(n_words, pa.int64()), pa.array(base, pa.list_(pa.struct([("word", pa.int64()), ("label", pa.string())]))), pa.array(found, pa.list_(_DETECTION))],
            ["doc_id", "n_words", "base", "detections"],
        )


def license_labels(docs: DataFrame) -> DataFrame:
    """For each document its words, the places of the base phrases, the kept detections,
    and a score: how sure the strongest of them is (tag 1, notice or base phrase 0.9,
    address or clause 0.7, bare name 0.4, nothing 0)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _scan,
        "doc_id long, n_words long, base array<struct<word:long,label:string>>, "
        "detections array<struct<label:string,kind:string,priority:int,first:long,end:long>>",
    )
    sure = F.create_map(*(F.lit(x) for pair in ((4, 1.0), (3, 0.9), (2, 0.7), (1, 0.4)) for x in pair))
    best = F.coalesce(sure[F.array_max("detections.priority")], F.lit(0.0))
    return rows.withColumn("score", F.when(F.size("base") > 0, F.greatest(best, F.lit(0.9))).otherwise(best))
