"""Both language models against plain versions."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from opsframe.llm import kneser_ney as k
from opsframe.llm import quality_lm as q
from opsframe.llm import texts
from opsframe.storage import arrow_rows, scratch_path

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def discounts(counts):
    n = [max(counts[i], 1) for i in (1, 2, 3, 4)]
    y = n[0] / (n[0] + 2 * n[1])
    return [0.0, *(min(max(i - (i + 1) * y * n[i] / n[i - 1], 0.05), i - 0.05) for i in (1, 2, 3))]


class Plain:
    """Interpolated modified Kneser-Ney of any order over lists of symbols."""

    def __init__(self, grams, order, symbols):
        self.order, self.symbols = order, symbols
        self.counts = {order: grams}
        for n in range(order - 1, 0, -1):
            self.counts[n] = Counter(g[1:] for g in self.counts[n + 1])
        self.d = {n: discounts(Counter(c.values())) for n, c in self.counts.items()}
        self.contexts = {n: defaultdict(list) for n in self.counts}
        for n, counts in self.counts.items():
            for gram, c in counts.items():
                self.contexts[n][gram[:-1]].append(c)

    def p(self, gram):
        if not gram:
            return 1 / self.symbols
        n, seen = len(gram), self.contexts[len(gram)].get(gram[:-1])
        below = self.p(gram[1:])
        if not seen:
            return below
        c, d = self.counts[n].get(gram, 0), self.d[n]
        return (c - d[min(c, 3)] + sum(d[min(x, 3)] for x in seen) * below) / sum(seen)


def words_of(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER)), None]


def corpus(n=120):
    rng = random.Random(11)
    vocabulary = [f"w{int(rng.expovariate(0.1))}" for _ in range(300)]
    rows = [(i, " ".join(rng.choice(vocabulary).title() for _ in range(rng.randrange(30)))) for i in range(n)]
    return [*rows, (n, None), (n + 1, ""), rows[3], rows[3], (None, "w1 unknown")]


def test_word_scores(spark):
    rows = corpus()
    docs = spark.createDataFrame([(i, t, 0.5, 1) for i, t in rows], "doc_id long, text string, score double, number int")
    got = sorted(map(tuple, k.language_scores(docs).collect()), key=str)
    held = lambda i: zlib.crc32(str("" if i is None else i).encode()) % 10 == 0
    train = [words_of(t) for i, t in rows if not held(i)]
    count = Counter(w for t in train for w in t)
    total, distinct = sum(count.values()), len(count)
    pairs = Counter(p for t in train for p in zip(["<s>", *t], t))
    model = Plain(pairs, 2, distinct + 1)
    want = []
    for i, t in rows:
        w = words_of(t)
        base = sum(math.log10((count[x] + 0.1) / (total + 0.1 * (distinct + 1))) for x in w)
        score = sum(math.log10(model.p(p)) for p in zip(["<s>", *w], w))
        want.append((i, held(i), len(w), sum(x in count for x in w), total, base, score))
    for a, b in zip(got, sorted(want, key=str)):
        assert a[:5] == b[:5]
        assert a[5:] == pytest.approx(b[5:], rel=1e-9)
    assert len(got) == len(want)


def test_word_scores_without_training(spark):
    held = [i for i in range(60) if zlib.crc32(str(i).encode()) % 10 == 0][:2]
    docs = spark.createDataFrame([(i, "a b") for i in held], "doc_id long, text string")
    assert [(r.n_known, r.train_tokens, r.score) for r in k.language_scores(docs).collect()] == [(0, 0, 0.0)] * 2
    assert k.language_scores(docs.filter("doc_id < 0")).count() == 0


def test_bijection():
    x = np.random.default_rng(1).integers(0, 1 << 63, 10_000).astype(np.uint64) * np.uint64(2) + np.uint64(1)
    assert (k.unmix(texts.mix(x)) == x).all()


def test_byte_model(spark):
    train = ["the cat sat on the mat", "the dog", "", "ééé the", "a cat and a dog"] * 2 + ["mat"]
    docs = spark.createDataFrame([(t,) for t in train] + [(None,)], "text string")
    uri = scratch_path(spark, "byte-test")
    q.store_model(q.kneser_ney(q.count_grams(docs)), uri)
    stream = lambda t: [q.BEGIN] * 3 + list((t or "").encode()) + [q.END]
    grams = Counter(tuple(s[i - 3 : i + 1]) for t in [*train, None] for s in [stream(t)] for i in range(3, len(s)))
    model = Plain(grams, 4, q.SYMBOLS - 1)
    said = ["the cat", "", None, "xyz", "é", "the mat the mat dog"]
    n, logp = q.Scorer(uri).score(texts.from_arrow(pa.array(said)))
    for t, size, found in zip(said, n, logp):
        s = stream(t)
        assert size == len(s) - 3
        assert found == pytest.approx(sum(math.log10(model.p(tuple(s[i - 3 : i + 1]))) for i in range(3, len(s))), rel=1e-9)
    context = tuple(b"the")
    assert sum(model.p((*context, x)) for x in range(q.SYMBOLS) if x != q.BEGIN) == pytest.approx(1)


def test_long_texts_are_scored_in_blocks(spark, monkeypatch):
    docs = spark.createDataFrame([("the cat sat on the mat " * 3,), ("a dog and a cat",)], "text string")
    uri = scratch_path(spark, "byte-test")
    q.store_model(q.kneser_ney(q.count_grams(docs)), uri)
    scorer = q.Scorer(uri)
    for size in (0, 1, 255, 256, 257, 511, 512, 513, 2000):
        part = texts.from_arrow(pa.array([("the cat and a dog sat " * 100)[:size]]))
        monkeypatch.setattr(q, "SCORED_BYTES", 1 << 19)
        whole = scorer.score_new(part)
        monkeypatch.setattr(q, "SCORED_BYTES", 256)
        for x, y in zip(scorer.score_new(part), whole):
            assert x.tolist() == pytest.approx(y.tolist(), rel=1e-12)


def test_junk_is_told_from_text(spark):
    rng = random.Random(4)
    syllables = {"en": ["the", "an", "er", "ing"], "de": ["ung", "sch", "ein", "keit"]}
    prose = lambda lang, n: " ".join("".join(rng.choice(syllables[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(n))
    rows = [(i, prose("en" if i % 2 else "de", rng.randrange(5, 80)), "en" if i % 2 else "de") for i in range(300)]
    junk = [(1000 + i, "".join(rng.choice("#$%&QXZ12") for _ in range(80)), "en") for i in range(20)]
    odd = [(2000, None, None), (2001, "", "en"), (2002, prose("en", 30), "unknown"), (None, prose("de", 30), "de"), rows[0], rows[0]]
    docs = spark.createDataFrame([(*r, 1, True) for r in [*rows, *junk, *odd]], "doc_id long, text string, lang string, limit int, kept boolean")
    trusted = spark.createDataFrame([(i,) for i in range(200)] + [(5,), (None,), (99_999,)], "doc_id long")
    got = q.perplexity_quality(docs, trusted).collect()
    assert len(got) == 326
    kept = {r.doc_id: r.kept for r in got}
    assert not any(kept[1000 + i] for i in range(20))
    assert sum(kept[i] for i in range(300)) >= 294 and kept[2002] and kept[None]
    assert len({r.threshold for r in got if r.lang in ("en", "de")}) == 2
    none = q.perplexity_quality(docs, trusted.filter("doc_id < 0")).collect()
    assert all(r.kept and r.threshold is None for r in none)
    assert q.perplexity_quality(docs.filter("doc_id < 0"), trusted).count() == 0


def test_repeated_ordinary_words_are_junk(spark):
    rng = random.Random(6)
    syllables = ["the", "an", "er", "ing", "ha", "to", "or", "is"]
    prose = lambda n: " ".join("".join(rng.choice(syllables) for _ in range(rng.randrange(1, 4))) for _ in range(n))
    rows = [(i, prose(rng.randrange(20, 80)), "en") for i in range(300)]
    repeats = [(1000 + i, " ".join([prose(1)] * rng.randrange(60, 90)), "en") for i in range(60)]
    docs = spark.createDataFrame(rows + repeats, "doc_id long, text string, lang string")
    trusted = spark.createDataFrame([(i,) for i in range(200)], "doc_id long")
    low = spark.createDataFrame([(1000 + i,) for i in range(30)] + [(5,), (None,), (99_999,)], "doc_id long")
    for known in (None, low, low.filter("doc_id < 0")):
        kept = {r.doc_id for r in q.perplexity_quality(docs, trusted, low=known).collect() if r.kept}
        assert not [i for i in kept if i >= 1000]
        assert len([i for i in kept if i < 300]) >= 290


def test_all_trusted_text_is_counted(spark, monkeypatch):
    # More trusted documents than any bound on the training text once allowed, and far more n-grams than a task holds.
    monkeypatch.setattr(q, "BUFFERED_GRAMS", 64)
    counted = []
    count_grams = q.count_grams
    monkeypatch.setattr(q, "count_grams", lambda docs: counted.append(count_grams(docs)) or counted[-1])
    docs = spark.range(14_000).selectExpr("id AS doc_id", "concat('a text ', id) AS text", "'en' AS lang")
    trusted = docs.select("doc_id").filter("doc_id >= 1000")
    assert q.perplexity_quality(docs, trusted).count() == 14_000
    half = trusted.filter("pmod(xxhash64(18, doc_id), 2) = 0")
    grams = Counter()
    for r in half.collect():
        s = [q.BEGIN] * 3 + list(f"a text {r.doc_id}".encode()) + [q.END]
        for i in range(3, len(s)):
            a, b, c, d = s[i - 3 : i + 1]
            grams[((a * q.SYMBOLS + b) * q.SYMBOLS + c) * q.SYMBOLS + d] += 1
    assert half.count() > 6000
    assert {r.gram: r.c for r in counted[0].collect()} == grams


def test_model_in_parts(spark):
    # Parts are mapped, and those of all contexts together say what one table does.
    docs = spark.createDataFrame([("the cat sat on the mat " * 3,), ("a dog and a cat",)], "text string")
    model = q.kneser_ney(q.count_grams(docs)).localCheckpoint()
    said = texts.from_arrow(pa.array(["the cat and a dog", "", "xyz the mat the mat", "\x00the"]))
    setting, found, parts = "spark.sql.shuffle.partitions", [], []
    before = spark.conf.get(setting)
    try:
        for n in (1, 40):
            spark.conf.set(setting, n)
            uri = scratch_path(spark, "byte-test")
            q.store_model(model, uri)
            scorer = q.Scorer(uri)
            found.append([x.tolist() for x in scorer.score_new(said)])
            parts.append(len(scorer.firsts))
            assert all(not x.flags.owndata for part in scorer.opened.values() for x in part)
    finally:
        spark.conf.set(setting, before)
    assert found[0] == found[1]
    assert parts[0] == 1 and parts[1] > 20


def test_batches_of_few_rows(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.record_batch([pa.array([batch.num_rows])], names=["n"])

    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(setting)
    most = lambda: max(r.n for r in spark.range(3000).coalesce(1).mapInArrow(sizes, "n long").collect())
    try:
        for own, rows, expected in ((10_000, 100, 100), (50, 100, 50), (0, 100, 100)):
            spark.conf.set(setting, own)
            with arrow_rows(spark, rows):
                assert most() == expected
            assert spark.conf.get(setting) == str(own)
    finally:
        spark.conf.set(setting, before)
