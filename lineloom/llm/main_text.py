"""Main text of HTML pages by a linear-chain conditional random field over leaf blocks.

Every block of a page is article or not. Emission features are its ancestors' names, words
of their classes, ids and roles, and the shape of its text; transitions tie neighbours. The
field is trained on labelled pages and decoded by Viterbi.

Labels: in pages that mark their article by an element of that name (or a main element), the
blocks inside it, outside of any navigation, aside, footer or form, are the article. A
bounded sample of ``PAGES`` such pages is the training set. So that the field does not lean
on one site's markup, every training page is also taken in ``VARIANTS`` rewritten forms: the
same labelled blocks in containers with other usual names, and usual surroundings (notices,
side bars, forms, comments of readers) made of boilerplate and article blocks of the sample.

Defined results: a null or empty page, or one without article blocks, has the empty text;
repeated rows give a row each. Without labelled pages the field is trained on variants made
of placeholder blocks alone. Other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lineloom.llm.page_blocks import Block, Place, blocks

PAGES, VARIANTS = 400, 3
#: Features, those of all ancestors counted for each block, beyond which a page of the
#: sample is no training page: it nests without end. Scoring has no such bound.
TRAINED_FEATURES = 1 << 20
BITS = 14
ROUNDS, RATE = 12, 0.3

# Usual names around articles and around everything else.
ARTICLE_NAMES = "article post content entry story main body text single blog page news prose markdown hentry".split()
OTHER_NAMES = {
    "nav": "nav menu navigation navbar breadcrumb breadcrumbs topnav links pagination pager tabs".split(),
    "header": "header masthead top banner branding logo hero".split(),
    "footer": "footer bottom copyright colophon legal credits".split(),
    "aside": "sidebar aside widget related recommended popular trending rail promo".split(),
    "ad": "ad ads advert advertisement sponsor sponsored banner promo adsense".split(),
    "notice": "cookie notice consent alert banner gdpr popup modal warning message".split(),
    "form": "form search newsletter subscribe signup login contact field".split(),
    "comments": "comment comments reply discussion respond thread disqus commentlist feedback".split(),
    "share": "share social follow tags meta byline".split(),
}
NOT_ARTICLE = frozenset("nav aside footer form button select textarea dialog menu".split())
ARTICLE = frozenset(["article", "main"])


class Field(NamedTuple):
    weights: np.ndarray  # of either label, by hashed feature
    moves: np.ndarray  # from label to label


@lru_cache(1 << 16)
def _feature(name: str) -> int:
    return zlib.crc32(name.encode()) & ((1 << BITS) - 1)


def _named(place: Place) -> set[str]:
    """What an element tells about all blocks in it."""
    return {f"in {place.tag}", *(f"word {w}" for w in place.words), *(f"word {w[:-1]}" for w in place.words if w.endswith("s"))}


def _walk(page: list[Block], enter: Callable[[list[str]], None], leave: Callable[[list[str]], None]) -> Iterator[Block]:
    """The blocks in order; before each, elements are entered and left until its own are
    open. An element tells of itself only what none around it has told."""
    told: set[str] = set()
    path: list[tuple[Place, list[str]]] = []
    for block in page:
        depth = block.place.depth if block.place else 0
        ahead: list[Place] = []
        here = block.place
        while here and (here.depth > len(path) or path[here.depth - 1][0] is not here):
            ahead.append(here)
            here = here.parent
        while len(path) > depth - len(ahead):
            own = path.pop()[1]
            told.difference_update(own)
            leave(own)
        for place in reversed(ahead):
            own = sorted(_named(place) - told)
            told.update(own)
            path.append((place, own))
            enter(own)
        yield block


def _shape(block: Block, i: int, n: int) -> set[str]:
    """What a block tells of itself: its innermost elements, its text, its place on the page."""
    own, box = (block.place.tag, block.place.box) if block.place else ("", None)
    tag, words = (box.tag, box.words) if box else ("", ())
    text = block.text
    size = len(text)
    names = {
        "bias", f"box {tag}", f"box {tag} own {own}", f"box {tag} {' '.join(words)}",
        f"size {min(int(np.log2(size + 1)), 10)}", f"words {min(int(np.log2(text.count(' ') + 1)), 8)}",
        f"linked {int(4 * block.linked / size)}", f"ends {text[-1] if text[-1] in '.!?:;,' else 'else'}", f"place {int(5 * i / n)}",
        f"own {own}" if block.place else "no ancestors",
    }
    if "©" in text or "copyright" in text.lower():
        names.add("copyright")
    if i == 0:
        names.add("first")
    if i == n - 1:
        names.add("last")
    return names


def features(page: list[Block], most: int | None = None) -> list[list[int]] | None:
    """Hashed features of every block of a page, none where they are more than ``most``."""
    out: list[list[int]] = []
    opened: dict[str, None] = {}
    size = 0

    def leave(names: list[str]) -> None:
        for name in names:
            del opened[name]

    for i, block in enumerate(_walk(page, lambda names: opened.update(dict.fromkeys(names)), leave)):
        size += len(opened)
        if most is not None and size > most:
            return None
        out.append([_feature(name) for name in sorted({*opened, *_shape(block, i, len(page))})])
    return out


def scored(field: Field, page: list[Block]) -> np.ndarray:
    """The emission scores of every block: those of its elements, summed once an element,
    and of its own features."""
    flat: list[int] = []
    ends = [0]  # of each element's or block's features
    around = [0]  # the element that an element, or a block, stands in; 0: none
    path = [0]

    def add(names: Iterable[str]) -> None:
        flat.extend(map(_feature, names))
        ends.append(len(flat))
        around.append(path[-1])

    def enter(names: list[str]) -> None:
        add(names)
        path.append(len(ends) - 1)

    rows = []
    for i, block in enumerate(_walk(page, enter, lambda _: path.pop())):
        add(_shape(block, i, len(page)))
        rows.append(len(ends) - 1)
    own = np.diff(np.concatenate([np.zeros((1, 2)), np.cumsum(field.weights[flat], 0)])[ends], axis=0, prepend=0).tolist()
    for number, (outer, (s, t)) in enumerate(zip(around, own)):
        if outer:
            own[number] = [s + own[outer][0], t + own[outer][1]]
    return np.array(own)[rows]


def marked(page: list[Block]) -> list[int] | None:
    """Labels that a page's own markup gives, if it marks its article."""
    aside = set().union(*OTHER_NAMES.values()) - {"banner", "top", "links", "text", "meta", "message", "header", "title"}

    def inside(wanted: str) -> list[int | None]:
        """For each block: none outside of the wanted element, 1 in its article, 0 in what stands beside it."""
        known: dict[Place | None, int | None] = {None: None}
        for block in page:
            ahead, here = [], block.place
            while here not in known:
                ahead.append(here)
                here = here.parent
            for place in reversed(ahead):
                state = known[place.parent]
                if state is None:
                    state = 1 if place.tag == wanted else None
                elif place.tag in NOT_ARTICLE or aside.intersection(place.words):
                    state = 0
                known[place] = state
        return [known[b.place] for b in page]

    for wanted in ("article", "main"):
        states = inside(wanted)
        if any(s is not None for s in states):
            return [int(s == 1) for s in states]
    return None


def _variant(draw: np.random.Generator, page: list[Block], labels: list[int], others: list[Block]) -> tuple[list[Block], list[int]]:
    """The blocks of a page in another site's markup."""

    def pick(values):
        return values[int(draw.integers(len(values)))]

    def container(kind: str) -> tuple[tuple[str, tuple[str, ...]], ...]:
        names = OTHER_NAMES[kind]
        semantic = {"nav": "nav", "header": "header", "footer": "footer", "aside": "aside", "form": "form"}.get(kind, "section")
        tag = semantic if draw.random() < 0.4 else pick(["div", "section", "ul"])
        words = (pick(names),) if tag != semantic or kind in ("ad", "notice", "comments", "share") or draw.random() < 0.4 else ()
        return ((tag, words),)

    def surrounding(kind: str, count: int, inner: tuple = ()) -> list[tuple[Block, int]]:
        around = (("html", ()), ("body", ()), *inner, *container(kind))
        out = []
        for _ in range(count):
            source = pick(others)
            tag = pick({"nav": ["li", "a"], "form": ["label", "button", "p"], "comments": ["p", "li", "div", "p"]}.get(kind, ["p", "div", "li", "span"]))
            short = source.text[: int(draw.integers(8, 60))] if kind in ("nav", "form", "share") or draw.random() < 0.4 else source.text
            linked = len(short) if kind == "nav" or draw.random() < 0.2 else 0
            out.append((Block(short.strip() or "x", Place.of((*around, (tag, ()))), linked), 0))
        return out

    tag = pick(["article", "main", "div", "div", "div", "section"])
    words = (pick(ARTICLE_NAMES),) if tag in ("div", "section") or draw.random() < 0.3 else ()
    article = (("html", ()), ("body", ()), *(((pick(["div", "main"]), ()),) if draw.random() < 0.5 else ()), (tag, words))
    out: list[tuple[Block, int]] = []
    for kind in ("notice", "header", "nav", "ad", "form"):
        if draw.random() < 0.5:
            out += surrounding(kind, int(draw.integers(1, 6 if kind == "nav" else 3)))
    body = [b for b, y in zip(page, labels) if y]
    for number, block in enumerate(body):
        own = (block.place.tag, block.place.words) if block.place else ("p", ())
        own = own if own[0] in ("p", "h1", "h2", "h3", "li", "blockquote", "pre") else ("p", ())
        inner: tuple = (own,)
        if number and draw.random() < 0.3:
            inner = pick([(("ul", ()), ("li", ())), (("ol", ()), ("li", ())), (("blockquote", ()),), (("h2", ()),), (("pre", ()),), (("table", ()), ("td", ())), (("div", ()),)])
        text = block.text.split(" ")[0] if number and draw.random() < 0.08 else block.text  # articles hold very short blocks too
        out.append((Block(text, Place.of((*article, *inner)), min(block.linked, len(text))), 1))
        if draw.random() < 0.05:
            out += surrounding(pick(["ad", "share", "aside"]), 1, article[2:])
    for kind in ("share", "comments", "aside", "form", "footer"):
        if draw.random() < 0.6:
            out += surrounding(kind, int(draw.integers(1, 5)), article[2:] if kind == "comments" and draw.random() < 0.4 else ())
    return [b for b, _ in out], [y for _, y in out]


def training_pages(pages: list[str]) -> list[tuple[list[Block], list[int]]]:
    """Labelled pages of the sample with their variants."""
    draw = np.random.default_rng(7)
    out = []
    for page in pages:
        found = blocks(page)
        labels = marked(found)
        if labels is not None:
            out.append((found, labels))
    others = [b for found, labels in out for b, y in zip(found, labels) if not y or draw.random() < 0.3]
    filler = [Block("some words of a sentence that stands here.", None, 0), Block("home", None, 4)]
    own = out or [([Block("a paragraph of some length that tells a story, and goes on for a while.", Place.of([("p", ())]), 0)] * 4, [1] * 4)]
    return out + [_variant(draw, found, labels, others or filler) for found, labels in own for _ in range(VARIANTS)]


def _chain(scores: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marginals of every block, and expected moves, by forward and backward sums."""
    n = len(scores)
    forward, backward = np.empty_like(scores), np.zeros_like(scores)
    forward[0] = scores[0]
    for i in range(1, n):
        forward[i] = scores[i] + np.logaddexp(forward[i - 1, 0] + moves[0], forward[i - 1, 1] + moves[1])
    for i in range(n - 2, -1, -1):
        ahead = scores[i + 1] + backward[i + 1]
        backward[i] = np.logaddexp(moves[:, 0] + ahead[0], moves[:, 1] + ahead[1])
    total = np.logaddexp(*forward[-1])
    pairs = np.exp(forward[:-1, :, None] + moves + (scores[1:] + backward[1:])[:, None, :] - total).sum(0)
    return np.exp(forward + backward - total), pairs


def trained(pages: list[tuple[list[Block], list[int]]]) -> Field:
    """Log likelihood by AdaGrad, page by page, with weights averaged over the rounds."""
    weights, moves = np.zeros((1 << BITS, 2)), np.zeros((2, 2))
    seen, moved = np.full(weights.shape, 1e-2), np.full(moves.shape, 1e-2)
    average, average_moves, steps = np.zeros_like(weights), np.zeros_like(moves), 0
    given = []
    for page, labels in pages:
        f = features(page, TRAINED_FEATURES)
        if f:
            given.append((np.concatenate(f), np.repeat(np.arange(len(f)), [len(x) for x in f]), np.array(labels)))
    draw = np.random.default_rng(77)
    for turn in range(ROUNDS):
        for number in draw.permutation(len(given)):
            f, rows, y = given[number]
            scores = np.stack([np.bincount(rows, weights[f, k], len(y)) for k in (0, 1)], 1)
            p, pairs = _chain(scores, moves)
            p[np.arange(len(y)), y] -= 1
            np.subtract.at(pairs, (y[:-1], y[1:]), 1)
            slope = np.zeros_like(weights)
            np.add.at(slope, f, p[rows])
            used = np.unique(f)
            g = slope[used] + 1e-4 * weights[used]
            seen[used] += g**2
            weights[used] -= RATE * g / np.sqrt(seen[used])
            moved += pairs**2
            moves -= RATE * pairs / np.sqrt(moved)
        if turn >= ROUNDS // 2:
            average, average_moves, steps = average + weights, average_moves + moves, steps + 1
    return Field(average / steps, average_moves / steps)


def decoded(field: Field, page: list[Block]) -> np.ndarray:
    """The likeliest labels of a page's blocks (Viterbi)."""
    if not page:
        return np.zeros(0, int)
    scores = scored(field, page)
    (m00, m01), (m10, m11) = field.moves.tolist()
    a, b = scores[0].tolist()
    back = []
    for s, t in scores[1:].tolist():
        from0, from1 = a + m00 < b + m10, a + m01 < b + m11
        back.append((from0, from1))
        a, b = s + (b + m10 if from0 else a + m00), t + (b + m11 if from1 else a + m01)
    label = int(b > a)
    out = [label]
    for step in reversed(back):
        label = int(step[label])
        out.append(label)
    return np.array(out[::-1])


def main_text(field: Field, page: str | None) -> str:
    found = blocks(page or "")
    return "\n".join(b.text for b, y in zip(found, decoded(field, found)) if y)


def learnt(pages: DataFrame) -> Field:
    """The field of a bounded sample of the pages that mark their article, chosen by a hash."""
    marks = pages.filter(F.col("html").rlike("(?i)<(article|main)[\\s>]")).select("html", F.xxhash64("html").alias("turn"))
    # the hashes are chosen first, so only the chosen pages move
    turns = [row["turn"] for row in marks.select("turn").distinct().orderBy("turn").limit(PAGES).collect()]
    chosen = marks.filter(F.col("turn").isin(turns)).groupBy("turn").agg(F.first("html").alias("html")).orderBy("turn")
    return trained(training_pages([row["html"] for row in chosen.collect()]))


def extracted(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, the main ``text`` and its number of code points."""
    known = pages.sparkSession.sparkContext.broadcast(learnt(pages))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [main_text(known.value, page.as_py()) for page in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.string()), pa.array(map(len, found), pa.int64())], ["page_id", "url", "text", "n_chars"])

    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html").mapInArrow(
        run, "page_id long, url string, text string, n_chars long"
    )
