"""Fill-in-middle, spelling variants and source mixes against brute force, on odd tables too."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lineloom.llm import fill_in_middle, letter_tree, source_mix, spelling

#: Columns whose names the operators use inside; none of them may matter.
DOCS = "doc_id long, text string, source string, n long, size long, key double, word string, h1 long, output string, last long"


def documents(spark, *texts, ids=None, sources=None):
    ids, sources = ids or range(len(texts)), sources or ["s"] * len(texts)
    return spark.createDataFrame([(i, t, s, 7, 8, 9.0, "w", 1, "o", 3) for i, t, s in zip(ids, texts, sources)], DOCS)


def fill(doc_id, text):
    """The transformation of one text, straight from its definition."""
    text = text or ""
    tokens = re.findall("[A-Za-z]+|[^A-Za-z]", text, re.S)
    told = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(told[k : k + 8], 16) for k in (0, 8, 16, 24))
    a, b = sorted((h1 % (len(tokens) + 1), h2 % (len(tokens) + 1)))
    p, m, s = ("".join(x) for x in (tokens[:a], tokens[a:b], tokens[b:]))
    if not text or any(mark in text for mark in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return len(tokens), "plain", None, None, text
    if h4 % 100 < 20:
        return len(tokens), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(tokens), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_fill_in_middle_of_odd_texts(spark):
    draw = random.Random(11)
    some = ["".join(draw.choices("abZ é€𝄞\n<>PSM1\0", k=draw.randrange(40))) for _ in range(400)]
    odd = [None, "", "a", "é", "𝄞𝄞", "<P", "<P>", "x<M>y", "<S", "S><", "word " * 300_000, " ", "<<P", "\r\n"]
    texts = odd * 6 + some
    ids = [*range(len(texts) - 2), None, None]
    docs = documents(spark, *texts, *texts[:3], ids=[*ids, *ids[:3]])
    got = fill_in_middle.restored(fill_in_middle.transformed(docs)).collect()
    want = [(i, *fill(i, t), t or "") for i, t in [*zip(ids, texts), *zip(ids[:3], texts[:3])]]
    assert Counter((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.restored) for r in got) == Counter(want)
    assert {r.form for r in got} == {"plain", "psm", "spm"}
    assert fill_in_middle.transformed(documents(spark, "x").limit(0)).count() == 0


def test_outputs_without_their_marks_restore_to_null(spark):
    rows = [("psm", "<P>a<S>c<M>b"), ("spm", "<P>a<S>c<M>b"), ("psm", "a<S>c<M>b"), ("psm", None), ("plain", "<P>x"), ("other", "y"), ("spm", "<S><P><M>"), ("psm", "<P>a<S>c<M>b<M>")]
    frame = spark.createDataFrame(rows, "form string, output string")
    assert [r.restored for r in fill_in_middle.restored(frame).collect()] == ["abc", None, None, None, "<P>x", "y", "", None]


def changed(run, doc_id):
    h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
    return run[: h % len(run)] + run[h % len(run) + 1 :] if h % 31 == 0 else run


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_variants(rows):
    n = Counter()
    for doc_id, text in rows:
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        n.update(w for r in re.findall("[a-zÀ-ÿ]+", lower) if len(w := changed(r, doc_id)) >= 7)
    n = {w: k for w, k in n.items() if k >= 2}
    others = {w: [v for v in n if near(w, v)] for w in n}
    form = {}
    for w, k in n.items():
        best = min(others[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 10 * k else None
    out = set()
    for w, k in n.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, k, len(others[w]), n.get(form[w])))
    return out


def spelled(draw):
    """Texts around some words and their misspellings of misspellings, with numbers that make chains."""
    base = ["magnificent", "Ökonomie", "straßenbahn", "aaaaaaaa", "aaaaaaab", "listening", "silentingx", "a" * 300]
    texts = []
    for i in range(200):
        words = []
        for _ in range(30):
            w = list(draw.choice(base))
            for _ in range(draw.choice([0] * 12 + [1, 1, 2, 3])):
                k = draw.randrange(len(w))
                kind = draw.randrange(3)
                w[k : k + 1] = [] if kind == 0 else [draw.choice("abcé")] if kind == 1 else [w[k], draw.choice("abÿ")]
            words.append("".join(w))
        texts.append(draw.choice([" ", "9", "Ā", "-"]).join(words).upper() if i % 5 == 0 else " ".join(words))
    return texts


@pytest.mark.parametrize("small", [False, True])
def test_variants_equal_brute_force(spark, monkeypatch, small):
    if small:  # many cells of several blocks
        monkeypatch.setattr(spelling, "CELL", 2)
        monkeypatch.setattr(spelling, "SAMPLE", 64)
        monkeypatch.setattr(spelling, "LEAST_SAMPLED", 1)
    texts = [*spelled(random.Random(5)), None, "", "straßenbahn " * 30, "straßenbahn " * 30]
    ids = [*range(len(texts) - 2), None, None]
    got = spelling.variants(documents(spark, *texts, ids=ids)).collect()
    want = brute_variants(zip(ids, texts))
    assert {tuple(r[c] for c in ("word", "form", "root", "n", "n_near", "form_n")) for r in got} == want
    assert len(got) == len(want) > 150
    assert any(r.form != r.root and r.form is not None for r in got)
    assert spelling.variants(documents(spark, None, "short words")).collect() == []
    assert spelling.variants(documents(spark, "x").limit(0)).collect() == []


def test_letter_tree_leaves_no_near_word_out():
    draw = random.Random(8)
    words = sorted({"".join(draw.choices("abcdeé", k=9)) for _ in range(3000)})
    n = np.array([draw.randrange(1, 5) for _ in words])
    cell = letter_tree.Cell([w.encode("latin-1") for w in words], n)
    assert len(cell.tree.dimension) > 100
    of = dict(zip(words, n.tolist()))
    for length in (8, 9, 10):
        asked = ["".join(draw.choices("abcdeé", k=length)) for _ in range(60)] + (words[:40] if length == 9 else [])
        found, best = cell.near([w.encode("latin-1") for w in asked])
        for w, k, b in zip(asked, found, best):
            others = [v for v in words if near(w, v)]
            assert k == len(others)
            assert (cell.words[b].decode("latin-1") if b >= 0 else None) == min(others, key=lambda v: (-of[v], v), default=None)


def brute_mix(rows):
    """``rows`` of (doc_id, text, source): goals filled up step by step, then one sort a source."""
    size = [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t, _ in rows]
    total = defaultdict(int)
    for n, (_, _, s) in zip(size, rows):
        total[s] += n
    names = sorted(total, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    left, open_, goal = 1.5 * sum(size), set(names), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if weight[s] * level >= 2 * total[s]}
        if not full:
            goal |= {s: weight[s] * level for s in open_}
            break
        goal |= {s: 2 * total[s] for s in full}
        left -= sum(2 * total[s] for s in full)
        open_ -= full
    return size, total, goal


def test_mix_meets_its_targets(spark, monkeypatch):
    monkeypatch.setattr(source_mix, "BUCKET", 16)
    draw = random.Random(4)
    rows = [(None, None, None), (1, "", "b"), (1, "", "b"), (2, None, "empty"), (7, "same words here", "c"), (7, "same words here", "c")]
    for i in range(900):
        source = "hot" if i % 3 == 0 else draw.choice(["a", "b", "c", None, "ä", "Z", "one"] if i > 5 else ["one"])
        rows.append((10 + i, " ".join(["w"] * draw.randrange(1, 60)) + " 12 3", source))
    rows.append((5, "word " * 100_000, "b"))
    docs = documents(spark, *[t for _, t, _ in rows], ids=[i for i, _, _ in rows], sources=[s for _, _, s in rows])
    got = source_mix.mixed(docs).collect()
    size, total, goal = brute_mix(rows)
    assert Counter((r.doc_id, r["size"], r.source_size) for r in got) == Counter((i, n, total[s]) for n, (i, _, s) in zip(size, rows))
    taken = defaultdict(int)
    for r in got:
        assert r.target == pytest.approx(goal[r.source])
        assert 0 <= r.taken <= 2 * r["size"] and r.taken >= r["copies"] * r["size"]
        taken[r.source] += r.taken
    assert all(abs(taken[s] - goal[s]) <= 1 for s in total)
    # one document a source at most is cut
    cut = Counter(r.source for r in got if r["size"] and r.taken % r["size"])
    assert max(cut.values()) == 1
    assert Counter(map(tuple, source_mix.mixed(docs.repartition(7)).collect())) == Counter(map(tuple, got))
    assert source_mix.mixed(docs.limit(0)).collect() == []
    assert [(r.target, r.taken) for r in source_mix.mixed(docs.filter("text IS NULL")).collect()] == [(0.0, 0)] * 2


def test_mix_takes_in_order_of_weighted_keys(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("two words").alias("text"), F.when(F.col("id") < 1000, "a").otherwise("b").alias("source"))
    light = F.when(F.col("doc_id") % 2 == 0, 4.0).otherwise(1.0)
    got = source_mix.mixed(docs, light).collect()

    def key(i):
        u = (int(hashlib.sha256(f"mix:{i}".encode()).hexdigest()[:13], 16) + 0.5) / (1 << 52)
        return -math.log(u) / (4.0 if i % 2 == 0 else 1.0)

    for source in "ab":
        own = sorted((r for r in got if r.source == source), key=lambda r: key(r.doc_id))
        taken = [r.taken for r in own]
        assert taken == sorted(taken, reverse=True)
        more = [r.doc_id % 2 == 0 for r in own if r.taken > own[-1].taken]
        if more and source == "b":
            assert sum(more) > 0.6 * len(more)


def test_mix_runs_in_the_jvm_alone(spark):
    plan = source_mix.mixed(documents(spark, "a b", "c"))._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas|RDD", plan)


def test_displacements_restore_any_cut():
    draw = np.random.default_rng(2)
    texts = ["", "é<", "ab cd", "P>", "x" * 50, "𝄞a"] * 20
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(t.encode()) for t in texts])])
    chosen = list(draw.integers(0, 1 << 32, (4, len(texts))))
    _, form, _, _, out, to = fill_in_middle.scattered(data, offsets, chosen)
    back, borders, wrong = fill_in_middle.gathered(out, to, form)
    assert not wrong.any() and (borders == offsets).all() and back.tobytes() == data.tobytes()
    assert pa.array([bytes(out[a:b]).decode() for a, b in zip(to, to[1:])]).null_count == 0
