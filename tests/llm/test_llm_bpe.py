"""Byte-level BPE against the tiktoken library."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from opsframe.llm import byte_bpe as b
from opsframe.llm import texts


@pytest.fixture(scope="module")
def ranks():
    return b.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))


def library(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def corpus():
    rng = random.Random(7)
    parts = [" ", "  ", "\n", "\t", " ", "　", " ", "\x85", "\x1c", "word", "Wörd", "é", "É", "don't", "'s", "'", "x'll", "12", "3.4",
             "###", "😀", "日本語", "<|endoftext|>", "a" * 90, "Zusammenhang", "_", "-", "̈", "×", "ß", "\x00", "…", "Ω≈"]
    made = ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 40))) for _ in range(250)]
    return [None, "", " ", "\n", " \n ", *made, " ".join(["same"] * 3000), "ab" * 4000, "".join(rng.choice("etaoin") for _ in range(900))]


def test_like_the_library(spark, ranks):
    rows = [(i, t, 1, "x") for i, t in enumerate(corpus())]
    rows += [rows[9], rows[9], (None, "nameless", 1, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int, piece string")
    encoded = b.encode(docs, public_tokenizers.PATTERN, ranks)
    got = encoded.withColumn("back", b.decode(F.col("ids"), ranks)).collect()
    own = library(ranks)
    want = []
    for i, text, *_ in rows:
        ids = own.encode_ordinary(text or "")
        want.append((i, len(ids), ids, hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), (text or "").encode()))
    assert sorted([(r.doc_id, r.n_tokens, r.ids, r.ids_sha256, bytes(r.back)) for r in got], key=str) == sorted(want, key=str)


def test_no_rows(spark, ranks):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert b.encode(docs, public_tokenizers.PATTERN, ranks).count() == 0


def test_heap_is_the_fold(ranks):
    own, rng = library(ranks), random.Random(2)
    for _ in range(300):
        word = "".join(rng.choice("abcdeéthing") for _ in range(rng.randrange(1, 60)))
        assert b.heap_merges(word.encode(), ranks) == own.encode_ordinary(word)


def test_pieces_cover_the_text(ranks):
    import pyarrow as pa

    own = library(ranks)
    for text in corpus():
        part = texts.from_arrow(pa.array([text, None, text]))
        starts, ends, bounds = b.pieces(part)
        cut = [part.data[s:e].tobytes() for s, e in zip(starts, ends)]
        assert b"".join(cut[bounds[0] : bounds[1]]) == (text or "").encode() == b"".join(cut[bounds[2] : bounds[3]])
        ids = [i for piece in cut[bounds[0] : bounds[1]] for i in own.encode_ordinary(piece.decode())]
        assert ids == own.encode_ordinary(text or "")


def test_plans_do_not_hold_the_ranks(spark, ranks):
    docs = spark.createDataFrame([(1, "some words")], "doc_id long, text string")
    found = b.encode_pieces(b.distinct_pieces(docs.select("text"), 2), public_tokenizers.PATTERN, ranks)
    decoded = b.round_trip(b.encode(docs, public_tokenizers.PATTERN, ranks), ranks)
    for rows, name in ((found, "maps"), (decoded, "hexed")):
        plan = rows._jdf.queryExecution()
        assert len(plan.toString()) < 100_000
        assert plan.executedPlan().toString().count(f" AS {name}#") == 1  # in the subquery alone: no row carries them
    assert bytes(decoded.head().decoded) == b"some words"


def test_ids_that_do_not_decode_to_the_text(spark, ranks):
    docs = spark.createDataFrame([(7, "some words")], "doc_id long, text string")
    encoded = b.encode(docs, public_tokenizers.PATTERN, ranks).withColumn("text", F.lit("other words"))
    with pytest.raises(Exception, match="ids do not decode to the text of 7"):
        b.round_trip(encoded, ranks).collect()
