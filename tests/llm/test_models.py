"""Encoding, suffix tree, classifiers, page texts and the pipeline."""

import math
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from lineloom.llm import bpe, main_text, near_duplicates, quality_mil, secret_scan, suffix_tree, toxicity
from lineloom.llm.lexicon import Lexicon, compiled
from lineloom.llm.page_blocks import blocks
from lineloom.llm.queries import QUERIES
from tests.llm.test_search import by_id, documents, lower

SF = "/root/testdata/sf0.001"
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def table(spark, name, sf=SF):
    return spark.read.parquet(f"{sf}/{name}.parquet")


def odd_texts():
    draw = random.Random(4)
    letters = ["a", "the", " ", "\n", "'s", "'", "\t", "<|endoftext|>", "ß", "日本", "​", "½", "12", "🙂", "!?", "\x85", "\xa0", "re", "ing"]
    return ["", None, "hello  world ", "x" * 5000, "ab" * 3000 + " it's", *("".join(draw.choice(letters) for _ in range(draw.randrange(40))) for _ in range(300))]


def test_bpe_equals_the_tokenizer_and_round_trips(spark):
    tokenizer, reference = bpe.Tokenizer(spark, VOCABULARY), Tokenizer.from_file(VOCABULARY)
    texts = odd_texts()
    got = by_id(tokenizer.decode(tokenizer.encode(documents(spark, *texts))))
    for i, text in enumerate(texts):
        assert list(got[i].ids) == reference.encode(text or "", add_special_tokens=False).ids
        assert got[i].text == (text or "")
    bytes_alone = spark.createDataFrame([(1, [126, 200, 50256]), (2, None)], "doc_id long, ids array<int>")
    got = by_id(tokenizer.decode(bytes_alone))
    assert got[1].text == reference.decode([126, 200, 50256], skip_special_tokens=False) and got[2].text == ""


def test_page_scores_are_sums_over_features_and_deep_pages_are_linear():
    field = main_text.Field(np.random.default_rng(3).normal(size=(1 << main_text.BITS, 2)), np.zeros((2, 2)))
    draw = random.Random(5)
    tags = ["<p>", "</p>", '<div class="nav a">', "</div>", "<b>", "</b>", "<a>", "</a>", "x ", "<li>", "<svg>", "<article>", "<ul id=bs>", "</ul>"]
    for _ in range(50):
        page = blocks("".join(draw.choice(tags) for _ in range(60)))
        expected = [field.weights[f].sum(0) for f in main_text.features(page)]
        assert not page or main_text.scored(field, page) == pytest.approx(np.array(expected))
    deep = [f"<div class={''.join(chr(97 + int(c)) for c in str(i))}>x </p>" for i in range(100_000)]
    start = time.perf_counter()
    assert len(blocks("".join(deep[:10_000]))) == 10_000 and main_text.main_text(field, "".join(deep[:10_000])) is not None
    middle = time.perf_counter()
    assert main_text.main_text(field, "".join(deep)) is not None
    # in proportion it is ten times as long, by the square a hundred times
    assert time.perf_counter() - middle < 40 * (middle - start)
    assert main_text.features(blocks("".join(deep)), main_text.TRAINED_FEATURES) is None


def test_page_texts_of_no_pages_and_of_clashing_columns(spark):
    pages = table(spark, "pages").withColumns({c: F.lit("other") for c in ("text", "n_chars", "turn")})
    assert main_text.extracted(pages.limit(0)).collect() == []
    got = {r.page_id: r.text for r in main_text.extracted(pages).collect()}
    assert got == {r.page_id: r.text for r in main_text.extracted(table(spark, "pages")).collect()}


def test_lexicon_is_exact_and_shares_suffixes(tmp_path):
    words = {w.encode(): [i, i + 1] for i, w in enumerate("walking talking stalking walk é éé a aa".split())}
    path = tmp_path / "words.fsa"
    path.write_bytes(compiled(words))
    lexicon = Lexicon(str(path))
    asked = [*words, b"walkin", b"", b"walkings", b"zzz", b"king"]
    offsets = np.concatenate([[0], np.cumsum([len(w) for w in asked])])
    numbers = lexicon.numbers(np.frombuffer(b"".join(asked), np.uint8), offsets)
    assert [lexicon.ids[lexicon.offsets[n] : lexicon.offsets[n + 1]].tolist() if n >= 0 else None for n in numbers] == [words.get(w) for w in asked]
    assert len(lexicon.keys) < sum(map(len, words)) - 10


def test_forgetful_workers_encode_the_same(tmp_path, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 10)
    vocabulary = bpe.Vocabulary(VOCABULARY)
    (tmp_path / "x.fsa").write_bytes(compiled({b"the": vocabulary.merge([b"the"])[0].tolist()}))
    words, reference = bpe.Words(vocabulary, Lexicon(str(tmp_path / "x.fsa"))), Tokenizer.from_file(VOCABULARY)
    for text in odd_texts():
        assert words.encode([text or ""])[0].tolist() == reference.encode(text or "", add_special_tokens=False).ids


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", lower(text)) + [None]


def test_suffix_tree_scores(spark):
    docs = table(spark, "documents")
    rows = docs.collect()
    got = by_id(suffix_tree.scores(docs.withColumnRenamed("lang", "row")))
    held = {r.doc_id: zlib.crc32(str(r.doc_id).encode()) % 7 == 2 for r in rows}
    counts = Counter(w for r in rows if not held[r.doc_id] for w in words_of(r.text))
    n, v = sum(counts.values()), len(counts)
    for r in rows:
        words = words_of(r.text)
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words)
        one = got[r.doc_id]
        assert (one.held_out, one.n_tokens, one.n_known, one.train_tokens) == (held[r.doc_id], len(words), sum(counts[w] > 0 for w in words), n)
        assert one.base_score == pytest.approx(base)
    told = [g for g in got.values() if g.held_out]
    assert sum(g.score for g in told) > sum(g.base_score for g in told)


class PlainTree:
    """The same model over tuples of words, one symbol at a time."""

    def __init__(self, texts):
        self.lines = [words_of(t) for t in texts]
        self.words = Counter(w for line in self.lines for w in line)
        self.n, self.v = sum(self.words.values()), len(self.words)
        self.states, asked, size = {}, set(), 0
        while True:
            size += 1
            after: dict = {}
            for line in self.lines:
                for i in range(size, len(line)):
                    after.setdefault(tuple(line[i - size : i]), Counter())[line[i]] += 1
            new = {}
            asked = {c for c, told in after.items() if sum(told.values()) >= suffix_tree.LEAST_STATE and (size == 1 or c[1:] in self.states and c[:-1] in asked)}
            for context in asked:
                told = after[context]
                n, listed = sum(told.values()), {w: c for w, c in told.items() if c >= suffix_tree.LEAST_LISTED}
                if not listed:
                    continue
                share = sum(listed.values())
                freed = n - share + suffix_tree.DISCOUNT * len(listed)
                gain = (n - share) * math.log(freed / n) if n > share else 0.0
                for w, c in listed.items():
                    below = self.p(context[1:], w)
                    gain += c * math.log((max(c - 1 - suffix_tree.DISCOUNT, 0) + freed * below) / ((n - 1) * below))
                if gain > suffix_tree.GAIN:
                    new[context] = listed, n, freed / n
            self.states.update(new)
            if not new:
                break

    def p(self, context, word):
        """After the longest suffix of ``context`` that is a state."""
        if not context:
            return (self.words[word] + 1) / (self.n + self.v + 1)
        below = self.p(context[1:], word)
        if context not in self.states:
            return below
        listed, n, left = self.states[context]
        return (max(listed[word] - suffix_tree.DISCOUNT, 0) / n if word in listed else 0) + left * below

    def score(self, text):
        line = words_of(text)
        deepest = max(map(len, self.states), default=0)
        return sum(math.log10(self.p(tuple(line[max(0, i - deepest) : i]), w)) for i, w in enumerate(line))


def phrases():
    turn = random.Random(5)
    out = ["a b c d e"] * 30 + ["x b c y e"] * 30 + ["a b c d f g"] * 20 + ["q b c d z"] * 20
    for _ in range(60):
        out.append(" ".join(turn.choice("a b c d e x y q z".split()) for _ in range(turn.randrange(12))))
    return out


def test_suffix_tree_equals_a_plain_one(spark, monkeypatch):
    lines = [*phrases(), None, "", "unseen Words here", "a B\tc d e"]
    docs = documents(spark, *lines)
    held = [zlib.crc32(str(i).encode()) % 7 == 2 for i in range(len(lines))]
    plain = PlainTree([t for t, out in zip(lines, held) if not out])
    assert max(map(len, plain.states)) >= 3
    got = by_id(suffix_tree.scores(docs))
    for i, line in enumerate(lines):
        assert got[i].score == pytest.approx(plain.score(line)), line
    for context in ((), ("b",), ("b", "c"), ("a", "b", "c"), ("never",)):
        assert sum(plain.p(context, w) for w in plain.words) + 1 / (plain.n + plain.v + 1) == pytest.approx(1, abs=1e-2)
    # nothing is frequent enough to be broadcast, and the filter says yes to nearly everything
    monkeypatch.setattr(suffix_tree, "HOT", 0)
    monkeypatch.setattr(suffix_tree, "FILTER_BITS", 6)
    cold = by_id(suffix_tree.scores(docs))
    for i in got:
        assert (cold[i].n_known, cold[i].held_out) == (got[i].n_known, got[i].held_out)
        assert cold[i].score == pytest.approx(got[i].score) and cold[i].base_score == pytest.approx(got[i].base_score)


def test_suffix_tree_keeps_contexts_in_a_larger_corpus(spark):
    def states(name, lines):
        stage = suffix_tree.Stage(spark, name)
        tree = suffix_tree.grown(documents(spark, *lines).select("text"), stage)
        return [{r.key for r in spark.read.parquet(f"{stage.folder}/states-{k}").collect()} for k in range(1, tree.depth + 1)]

    turn = random.Random(6)
    others = [" ".join(f"w{turn.randrange(300)}" for _ in range(60)) for _ in range(400)]
    alone, among = states("alone", phrases()), states("among", phrases() + others)
    assert len(alone) > 3 and all(small <= large for small, large in zip(alone, among))


def test_suffix_tree_broadcasts_by_counts_and_frees_shuffles(spark, monkeypatch):
    rows = [(k, n, None, 0.5) for k, n in enumerate((5, 6, 6, 7, 1 << 20))]
    values = spark.createDataFrame(rows, "key long, n long, root double, value double")
    monkeypatch.setattr(suffix_tree, "HOT", 4)
    hot, others = suffix_tree._hot(suffix_tree.Tree(values, 10, 5, 1))
    assert len(hot.value) == 4 and [r.key for r in others.collect()] == [0]

    def shuffled():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return sum(files.apply(i).getName().startswith("shuffle_") for i in range(files.size()))

    stage, before = suffix_tree.Stage(spark, "freed", free_shuffles=True), shuffled()
    kept = stage.keep(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "counts")
    assert shuffled() <= before and {r["count"] for r in kept.collect()} == {142, 143}


def test_suffix_tree_counts_several_levels_in_one_pass(spark, monkeypatch):
    kept = []
    keep = suffix_tree.Stage.keep
    monkeypatch.setattr(suffix_tree.Stage, "keep", lambda self, df, name: (kept.append(name), keep(self, df, name))[1])
    tree = suffix_tree.grown(documents(spark, *phrases()).select("text"), suffix_tree.Stage(spark, "passes"))
    assert tree.depth > 3 and {x for x in kept if x.startswith("counted-")} == {"counted-1", "counted-2", "counted-3"}


def test_suffix_tree_moves_sequences_in_packed_rows(spark, monkeypatch):
    lines = [*phrases(), None, "", "unseen Words here"]
    plain = PlainTree(lines)
    tree = suffix_tree.grown(documents(spark, *lines).select("text"), suffix_tree.Stage(spark, "packed"))
    monkeypatch.setattr(suffix_tree, "HOT", 0)
    hot, others = suffix_tree._hot(tree)
    pa = suffix_tree.pa
    # blocks of a few texts, as in tasks that hold more than they may
    monkeypatch.setattr(suffix_tree, "BLOCK", 50)
    monkeypatch.setattr(suffix_tree.TaskContext, "get", lambda: type("Task", (), {"partitionId": lambda self: 3})())
    docs = pa.record_batch([pa.array(range(len(lines))), pa.array([False] * len(lines)), pa.array(lines)], ["doc_id", "held_out", "text"])
    known = type("Sent", (), {"value": hot})
    asked = pa.Table.from_batches(suffix_tree._scored(known, 4)([docs]))
    blocks = -(-len(lines) // 50)
    assert len(asked) <= len(lines) + 16 * blocks and len(set(asked.column("block").to_pylist())) == blocks
    table = pa.Table.from_batches(suffix_tree._table(4)(others.select("key", "root", "value").toArrow().to_batches()))
    added = pa.concat_tables(suffix_tree._looked_up(*(t.filter(pa.compute.equal(t.column("dealt"), k)) for t in (asked, table))) for k in range(16))
    got = {}
    for k in set(added.column("block").to_pylist()):
        got |= {r["doc_id"]: r for r in suffix_tree._added(added.filter(pa.compute.equal(added.column("block"), k))).to_pylist()}
    assert sorted(got) == list(range(len(lines)))
    for i, line in enumerate(lines):
        unseen = (got[i]["n_tokens"] - got[i]["n_known"]) * tree.unseen
        assert got[i]["score"] + unseen == pytest.approx(plain.score(line)), line


def test_suffix_tree_scores_in_rounds(spark, monkeypatch):
    kept = []
    keep = suffix_tree.Stage.keep
    monkeypatch.setattr(suffix_tree.Stage, "keep", lambda self, df, name: (kept.append((name, df.schema)), keep(self, df, name))[1])
    lines = phrases()
    got = suffix_tree.scores(documents(spark, *lines)).collect()
    assert sorted(r.doc_id for r in got) == list(range(len(lines)))
    assert sum(name.startswith("scored") for name, _ in kept) == suffix_tree.ROUNDS > 1
    # no list of sequences lies beside the scores
    assert not any("array" in schema.simpleString() for _, schema in kept)


def test_packed_arrays_come_back():
    np = suffix_tree.np
    keys = np.sort(np.random.default_rng(2).integers(0, 1 << 64, 5000, dtype=np.uint64))
    _, borders = suffix_tree._by_bits(keys, 5)
    for values, kind, rising in ((keys, np.uint64, True), (keys, np.uint64, False), (keys.view(np.float64), np.float64, False), (keys.astype(np.uint16), np.uint16, False)):
        packed = suffix_tree.pa.chunked_array([(suffix_tree._rising if rising else suffix_tree._planes)(values, borders)])
        back, sizes = suffix_tree._values(packed, kind, rising)
        assert back.tobytes() == values.tobytes() and sizes.tolist() == np.diff(borders).tolist()


def test_pairs_by_bits_of_their_keys():
    turn = random.Random(8)
    keys = [turn.getrandbits(64) for _ in range(3000)]
    times = {k: turn.randrange(1, 7) for k in keys}
    told = []
    for _ in range(3):  # as from three tasks, of which none need see a pair often
        told.append(Counter(turn.sample([k for k in keys for _ in range(times[k])], 4000)))
    rows = {}
    for counts in told:
        key = suffix_tree.np.array(sorted(counts), dtype="uint64")
        batch = suffix_tree._dealt((key, None, None, suffix_tree.np.array([counts[k] for k in sorted(counts)])))
        for row in batch.to_pylist():
            rows.setdefault(row["dealt"], []).append(row)
    found = {k % 2**64 for group in rows.values() for k in suffix_tree._often(suffix_tree.pa.Table.from_pylist(group)).column("key").to_pylist()}
    assert found == {k >> 20 << 20 for k, n in sum(told, Counter()).items() if n >= suffix_tree.LEAST_LISTED}


def test_suffix_tree_of_odd_rows(spark):
    docs = documents(spark, *phrases())
    assert suffix_tree.scores(docs.limit(0)).collect() == []
    odd = docs.limit(1).withColumn("doc_id", F.lit(None).cast("long"))
    rows = suffix_tree.scores(docs.unionByName(docs).unionByName(odd).withColumn("key", F.lit(1))).collect()
    assert len(rows) == 2 * docs.count() + 1
    assert [(r.held_out, r.n_tokens) for r in rows if r.doc_id is None] == [(False, len(words_of(docs.first().text)))]
    assert len({(r.doc_id, round(r.score, 9)) for r in rows}) == docs.count() + 1


def test_toxicity_of_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    got = toxicity.toxicity(table(spark, "documents", sf), table(spark, "labels", sf)).join(table(spark, "labels", sf), "doc_id").filter("held_out").collect()
    hit = sum(r.predicted == r.toxic == 1 for r in got)
    assert hit > 0.8 * sum(r.toxic for r in got) and hit > 0.8 * sum(r.predicted for r in got)


def test_quality_of_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    got = quality_mil.quality(table(spark, "documents", sf), table(spark, "labels", sf)).join(table(spark, "labels", sf), "doc_id").filter("held_out").collect()
    assert sum(r.predicted == r.quality for r in got) > 0.95 * len(got)


@pytest.mark.parametrize("operator", [toxicity.toxicity, quality_mil.quality])
def test_scores_of_odd_rows(spark, operator):
    docs = documents(spark, "fine words " * 30, None, "", "  ", "bad " * 50000, "fine words " * 30, ids=[1, 2, 3, 4, 5, None])
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (2, None, None), (5, 0, 1), (None, 1, 1)], "doc_id long, quality int, toxic int")
    for labelled in (labels, labels.limit(0)):
        got = operator(docs, labelled).collect()
        assert len(got) == 6 and all(0 <= r.score <= 1 and r.predicted in (0, 1) for r in got)
        assert {r.score for r in got if r.doc_id in (2, 3, 4)} == {next(r.score for r in got if r.doc_id == 2)}
    assert operator(docs.limit(0), labels).collect() == []


def test_attention_gradient():
    draw = np.random.default_rng(1)
    w = {"encode": draw.normal(size=(quality_mil.FEATURES, 4)), "encode0": draw.normal(size=4), "gate": draw.normal(size=(4, 4)), "tone": draw.normal(size=(4, 4)), "attend": draw.normal(size=4), "out": draw.normal(size=4), "out0": draw.normal(size=1)}
    x, bags, y, weight = draw.normal(size=(9, quality_mil.FEATURES)), np.repeat([0, 2], [4, 5]), np.array([1.0, 0, 0]), np.array([1.0, 2, 1])

    def loss(w):
        p = quality_mil._forward(w, x, bags, 3)["p"]
        return -(weight * (y * np.log(p) + (1 - y) * np.log(1 - p))).sum() / weight.sum()

    g = quality_mil._gradient(w, x, bags, y, weight)
    for k in w:
        at = tuple(0 for _ in w[k].shape)
        up, down = ({**w, k: w[k].copy()} for _ in range(2))
        up[k][at] += 1e-5
        down[k][at] -= 1e-5
        assert g[k][at] == pytest.approx((loss(up) - loss(down)) / 2e-5, abs=1e-6)


def test_quality_learns_from_all_passages(spark, monkeypatch):
    models, fitted = [], quality_mil.fitted
    monkeypatch.setattr(quality_mil, "fitted", lambda *a: models.append(fitted(*a)) or models[-1])
    long = "word " * 50 + "12345 " * 50 + "word " * 50 * 298
    ids = [i for i in range(40) if zlib.crc32(str(i).encode()) % quality_mil.FOLDS != quality_mil.HELD][:2]
    docs = documents(spark, long, "word " * 100, ids=ids)
    labels = spark.createDataFrame([(ids[0], 1), (ids[1], 0)], "doc_id long, quality int")
    quality_mil.quality(docs, labels).collect()
    assert models[0].mean[2] == pytest.approx(250 / 299 / 302, rel=1e-4)
    whole = models[0].weights
    monkeypatch.setattr(quality_mil, "CHUNK", 7)
    quality_mil.quality(docs, labels).collect()
    assert all(np.allclose(whole[k], models[1].weights[k], atol=1e-4) for k in whole)


PARAGRAPH = "This is one paragraph of the story, with a few sentences. They go on for a while."


def test_page_blocks():
    page = '<p>a<b>b</b>&amp;c<p>d<br>e<script>var x="<p>no</p>"</script><div class="Ad-box x">f</div><!-- <p>g --> tail<ul><li><a href=q>h</a></ul>'
    assert [b.text for b in blocks(page)] == ["ab&c", "d e", "f", "tail", "h"]
    place = blocks(page)[2].place
    assert (place.tag, place.words) == ("div", ("ad", "box", "x")) and blocks(page)[4].linked == 1
    assert blocks("") == [] and [b.text for b in blocks("just <text & more")] == ["just"]


def test_viterbi_and_marginals_equal_enumeration():
    draw = np.random.default_rng(3)
    scores, moves = draw.normal(size=(5, 2)), draw.normal(size=(2, 2))
    paths = [[(k >> i) & 1 for i in range(5)] for k in range(32)]
    values = np.array([sum(scores[i, y] for i, y in enumerate(p)) + sum(moves[a, b] for a, b in zip(p, p[1:])) for p in paths])
    weights = np.exp(values) / np.exp(values).sum()
    p, pairs = main_text._chain(scores, moves)
    assert p[:, 1] == pytest.approx(np.array([sum(w for w, q in zip(weights, paths) if q[i]) for i in range(5)]))
    assert pairs[0, 1] == pytest.approx(sum(w * sum((a, b) == (0, 1) for a, b in zip(q, q[1:])) for w, q in zip(weights, paths)))


def test_main_text_of_known_and_new_sites(spark):
    pages = table(spark, "pages", "/root/testdata/sf0.01")
    got = {r.page_id: r for r in main_text.extracted(pages).collect()}
    field = main_text.learnt(pages)
    same = 0
    for r in pages.collect():
        body = re.search("<article>(.*)</article>", r.html, re.S)[1]
        parts = [" ".join(main_text.blocks(x)[0].text.split()) for x in re.split("</?(?:p|h1)>", body) if main_text.blocks(x)]
        same += got[r.page_id].text == "\n".join(parts)
        assert got[r.page_id].n_chars == len(got[r.page_id].text) and got[r.page_id].url == r.url
    assert same >= 0.98 * len(got)
    other = (
        f"<html><body><div class='menu'><a href=a>Home</a></div><div class='post'><h1>A title</h1><p>{PARAGRAPH}</p><p>{PARAGRAPH} More.</p></div>"
        f"<div id='comments'><p>{PARAGRAPH}</p></div><div class='footer'>&copy; 2024</div></body></html>"
    )
    assert main_text.main_text(field, other) == f"A title\n{PARAGRAPH}\n{PARAGRAPH} More."
    odd = spark.createDataFrame([(1, None, None), (2, "u", ""), (2, "u", "<p"), (None, "u", "<nav>x</nav>")], "page_id long, url string, html string")
    assert [(r.text, r.n_chars) for r in main_text.extracted(odd).collect()] == [("", 0)] * 4


def test_pipeline_equals_its_parts(spark):
    sf = "/root/testdata/sf0.01"
    docs = table(spark, "documents", sf)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "secrets", "bpe"]
    frame = docs
    for name, stage in corpus_pipeline.STAGES[:4]:
        after = stage(spark, frame, sf)
        assert after.columns == docs.columns and after.schema == docs.schema
        frame = corpus_pipeline.Stage(spark, "t").keep(after, name)
    clean = {r.doc_id for r in toxicity.toxicity(docs, table(spark, "labels", sf)).filter("predicted = 0").collect()}
    left = docs.filter(docs.doc_id.isin(list(clean)))
    kept = {r.doc_id for r in near_duplicates.near_duplicates(left, corpus_pipeline.NEAR_PERCENT).filter("kept").collect()}
    hit = {r.doc_id for r in QUERIES["op3_decontamination"](spark, sf).filter("contaminated").collect()}
    texts = {r.doc_id: r.text for r in frame.collect()}
    assert set(texts) == kept - hit
    assert not any(secret_scan.spans_of(pa.array([t for t in texts.values() if "[secret]" not in t])) != [] and s for s in secret_scan.spans_of(pa.array(list(texts.values()))))
    got = corpus_pipeline.run(spark, sf)
    reference = Tokenizer.from_file(VOCABULARY)
    rows = got.collect()
    assert {r.doc_id: r.text for r in rows} == texts
    assert all(list(r.ids) == reference.encode(r.text, add_special_tokens=False).ids and r.n_tokens == len(r.ids) for r in rows)
