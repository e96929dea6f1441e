"""Decontamination: the search against all scores, and leaks planted in documents."""

import random

import numpy as np
from pyspark.sql import functions as F

from opsframe.llm import decontaminate as d


def made(rng, n):
    rare = lambda: f"{rng.choice('bcdfg')}{rng.choice('aeiou')}{int(rng.expovariate(0.02))}"
    return [rng.choice(["of", "and", "in", "to"]) if rng.random() < 0.3 else rare() for _ in range(n)]


def items_of(rng, n=90):
    rows = []
    for i in range(n):
        words = made(rng, rng.randrange(8, 50))
        rows.append((i, " ".join(words[:-3]).capitalize() + ".", " ".join(words[-3:]) if i % 7 else words[-1]))
    return [*rows, (None, "no id", "x"), (n, None, None), (n + 1, "", "?!"), rows[0], (n + 2, "the", "the")]


SCHEMA = "item_id long, question string, answer string"


def test_search_is_complete(spark):
    rng = random.Random(1)
    items = spark.createDataFrame(items_of(rng, 300), SCHEMA)
    index = d.build_index(d.numbered_items(items, "item_id", "question", "answer"))
    block = d.Block(index.uri, 0)
    scores = np.zeros((len(block.terms), len(block.ids)))
    for t, (items, impacts) in enumerate(block.lists):
        scores[t, items] = impacts
    assert np.allclose(scores.sum(axis=0), 1)
    assert len(block.terms) > 300 and max(len(x[0]) for x in block.lists) > d.POSTINGS_PER_BLOCK
    for threshold in (0.05, 0.2, 0.6):
        for _ in range(40):
            query = np.unique(np.random.default_rng(rng.randrange(10**6)).integers(0, len(block.terms), rng.randrange(1, 120)))
            total = scores[query].sum(axis=0)
            want = {(i, round(total[i], 9)) for i in np.flatnonzero(total >= threshold)}
            assert {(i, round(s, 9)) for i, s in block.search(query, threshold)} == want


def test_planted_leaks(spark):
    rng = random.Random(2)
    items = items_of(rng)
    rows, planted = [], set()
    for i in range(150):
        text = " ".join(made(rng, rng.randrange(0, 400)))
        if i % 3 == 0:
            item = items[i % 90]
            text = f"{text[: len(text) // 2]} \n{item[1].upper()} ### {item[2]}!{text[len(text) // 2 :]}"
            planted.add((i, item[0]))
        rows.append((i, text))
    rows += [(200, None), (201, ""), (None, f"{items[5][1]} {items[5][2]}"), rows[0], (202, "the the the")]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, item_id int, score string")
    got = d.leaked_items(docs, spark.createDataFrame(items, SCHEMA)).filter("verified").collect()
    found = [(r.doc_id, r.item_id) for r in got]
    assert planted <= set(found)
    assert set(found) - planted == {(None, 5), (202, 92)}
    assert found.count((0, 0)) == 2


def test_only_question_or_nothing(spark):
    items = spark.createDataFrame([(1, "alpha beta gamma delta epsilon zeta eta theta", "iota kappa lambda")], SCHEMA)
    docs = spark.createDataFrame([(1, "so alpha beta gamma delta epsilon zeta eta theta then")], "doc_id long, text string")
    assert [(r.question_overlap, r.answer_overlap, r.verified) for r in d.leaked_items(docs, items).collect()] == [(1.0, 0.0, False)]
    assert d.leaked_items(docs.filter("doc_id > 5"), items).count() == 0
    assert d.leaked_items(docs, items.filter("item_id > 5")).count() == 0


def test_question_and_answer_of_a_text(spark):
    rows = [("One. Two three.", "One.", "Two three."), ("a b c d e f", "a b c d", "e f"), ("", "", ""), (None, "", "")]
    frame = spark.createDataFrame([(r[0],) for r in rows], "text string")
    assert [tuple(r) for r in frame.select("text", *d.split_answer(F.col("text"))).collect()] == rows


def test_ids_of_any_type_and_items_of_one_id(spark):
    said = ["alpha beta gamma delta epsilon zeta eta theta", "one two three four five six seven eight"]
    rows = [("q/1", said[0], "iota kappa lambda"), ("q/1", said[1], "nine ten eleven"), ("q/1", said[1], "nine ten eleven"), (None, "x y z", "w")]
    items = spark.createDataFrame(rows, "`the.id` string, q string, a string")
    docs = spark.createDataFrame([("d1", f"so {said[0]} iota kappa lambda"), ("d2", f"{said[1]} nine ten eleven"), ("d3", "x y z w")], "`doc.id` string, text string")
    got = d.leaked_items(docs, items, doc_id="doc.id", item_id="the.id", question="q", answer="a")
    assert dict(got.dtypes)["item_id"] == dict(got.dtypes)["doc_id"] == "string"
    assert sorted((r.doc_id, r.item_id, r.verified) for r in got.collect()) == [("d1", "q/1", True), ("d2", "q/1", True)]


def test_long_text_is_searched_whole(spark):
    rng = random.Random(3)
    items = items_of(rng)
    text = " ".join(made(rng, 300_000))
    docs = spark.createDataFrame([(1, f"{text} {items[4][1]} {items[4][2]}. {text[:1000]}")], "doc_id long, text string")
    got = d.leaked_items(docs, spark.createDataFrame(items, SCHEMA)).filter("verified").collect()
    assert (1, 4) in [(r.doc_id, r.item_id) for r in got]
