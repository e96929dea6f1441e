"""Quality rules: counts against a plain version, and what the votes are made of."""

import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from opsframe.llm import quality_rules as q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    text = text or ""
    words = WORD.findall(text)
    runs = list(zip(*(words[i:] for i in range(5))))
    often = Counter(runs)
    covered = {i + k for i, run in enumerate(runs) if often[run] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


def texts_of(rng):
    words = ["a", "b", "Cc", "dé", "##", "x|y", "😀", " ", "\x1c", "w" * 300_000]
    out = [None, "", " ", "\n\n", "a a a a a a", "one\nTwo\none\n \none"]
    for _ in range(60):
        out.append("".join(rng.choice(words[:-1]) + rng.choice([" ", "\n", "\t", "  ", "\x0b"]) for _ in range(rng.randrange(40))))
    return [*out, f"{words[-1]} b {words[-1]}\n{words[-1]}"]


def test_counts(spark):
    rows = [(i, t, 3, True) for i, t in enumerate(texts_of(random.Random(5)))]
    rows += [rows[5], rows[5], (None, "a b", 1, False)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_words int, kept boolean")
    got = q.rule_quality(docs).collect()
    columns = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    found = sorted([(r.doc_id, *(r[c] for c in columns)) for r in got], key=str)
    assert found == sorted([(i, *plain(t)) for i, t, *_ in rows], key=str)
    for r in got:
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert not (r.base_failed and r.kept)


def test_no_rows(spark):
    assert q.rule_quality(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_votes_tell_classes_apart():
    rng = np.random.default_rng(1)
    truth = rng.random(20_000) < 0.85
    kind = rng.integers(0, 2, len(truth))  # bad documents have one fault or another
    patterns = []
    for good, k in zip(truth, kind):
        against = [not good and k == 0, not good and k == 0, not good and k == 1, not good and k == 1]
        wrong = rng.random(4) < 0.01
        votes = ["-" if a != w else "0" for a, w in zip(against, wrong)]
        patterns.append("".join(votes) + ("+" if (good and rng.random() < 0.9) or (not good and rng.random() < 0.3) else "0"))
    counts = Counter(patterns)
    names = sorted(counts)
    model = q.fit(names, [counts[n] for n in names])
    judged = dict(zip(names, model.posterior(names) >= 0.5))
    right = np.mean([judged[p] == t for p, t in zip(patterns, truth)])
    assert right > 0.96
    assert judged["00000"] and judged["0000+"]
    # Rules of a fault that half of the bad documents have, and that hardly any good one seems to have.
    assert (model.votes[0, :4, 0] > 0.25).all() and (model.votes[1, :4, 0] < 0.02).all()
    assert q.fit([], []).posterior([]).size == 0


def test_own_rules(spark):
    docs = spark.createDataFrame([(i, "word " * (20 + i) if i % 2 else "bad ! " * 10) for i in range(40)], "doc_id long, text string")
    rules = [q.Rule("marked", lambda: F.col("n_letters") < F.col("word_chars"), lambda: F.col("n_words") > 20)]
    assert {r.votes for r in q.rule_quality(docs, rules=rules).collect()} == {"-", "+"}


def test_junk_of_half_the_documents_goes(spark):
    rng = random.Random(9)
    prose = lambda n: " ".join("".join(rng.choice("abcdefghijklmno") for _ in range(5)) + "." * (i % 7 == 0) for i in range(n))
    marked = lambda: " ".join(w + rng.choice(["", "", "$#&"]) for w in prose(60).split(" "))
    numbers = lambda: " ".join(rng.choice(["##", "|", "%%"]) * 3 for _ in range(40))
    few = lambda: " ".join(rng.choice(["aba", "cbd"]) for _ in range(60))
    good = [prose(60) for _ in range(300)]
    bad = [marked() for _ in range(90)] + [numbers() for _ in range(110)] + [few() for _ in range(100)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(good + bad)], "doc_id long, text string")
    got = q.rule_quality(docs).collect()
    kept = {r.doc_id for r in got if r.kept}
    assert len([i for i in kept if i < 300]) >= 295
    assert not [i for i in kept if i >= 300]
    counts = Counter(r.votes for r in got)
    assert 0.45 < q.fit(sorted(counts), [counts[v] for v in sorted(counts)]).prior < 0.55
