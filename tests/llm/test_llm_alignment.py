"""Tokenizer alignment against plain loops over the bytes of every token, and its matrices against dense ones."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import public_tokenizers
import sentencepiece
from conftest import SMALL
from tokenizers import Tokenizer

from opsframe.llm import alignment
from opsframe.llm.alignment import Csr, byte_level, link_statistics, product, sentence_pieces, token_links

FIRST, SECOND = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def tokenize():
    one = Tokenizer.from_file(FIRST)
    one.encode_special_tokens = True
    two = sentencepiece.SentencePieceProcessor(model_file=SECOND)
    visible = [b for b in range(256) if chr(b).isprintable() and b not in (0x20, 0xAD)]
    hidden = [b for b in range(256) if b not in visible]
    byte = {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}

    def run(text):
        a, b = [], []
        if text:
            a = [(i, bytes(byte[c] for c in one.id_to_token(i))) for i in one.encode(" " + text, add_special_tokens=False).ids]
            for i in two.encode(text):
                piece = two.id_to_piece(i)
                b.append((i, bytes([int(piece[3:5], 16)]) if two.is_byte(i) else piece.replace("▁", " ").encode()))
            whole = (" " + text).encode()
            if b"".join(x for _, x in a) != whole or b"".join(x for _, x in b) != whole:
                a, b = [], []
        return a, b

    return run


def spans(tokens):
    at, out = 0, []
    for i, data in tokens:
        out.append((i, at, at + len(data)))
        at += len(data)
    return out


def plain(rows, tokenize):
    docs, counts = [], Counter()
    for i, text in rows:
        a, b = map(spans, tokenize(text))
        owner = {at: n for n, (_, x, y) in enumerate(b) for at in range(x, y)}
        links = [(a[m][0], b[n][0]) for m in range(len(a)) for n in sorted({owner[at] for at in range(a[m][1], a[m][2])})]
        cuts = sorted({y for *_, y in a} & {y for *_, y in b})
        groups, shared, begin = [], 0, 0
        for cut in cuts:
            mine = [[str(t) for t, x, y in some if begin <= x and y <= cut] for some in (a, b)]
            groups.append("|".join(map(",".join, mine)))
            shared += len(mine[0]) * len(mine[1])
            begin = cut
        counts.update(links)
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""
        docs.append((i, len(a), len(b), len(cuts), len(links), shared, links, digest))
    best = Counter()
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    out = [(*d[:6], sum(counts[x] == best[x[1]] for x in d[6]), sum(counts[x] for x in d[6]), d[7]) for d in docs]
    return sorted(out, key=str)


ODD = ["", None, " ", "  ", "a", " a", "a ", "a  b   ", "\n", "\n\n x\t y", "<|endoftext|> </s> <s> <unk> <0x41>", "▁", "a▁b", "日本語のテキスト ünïcödé", "😀😀 ﬁ ①", "\x00 \x01",
       "don't we'll  it's x　y", "x" * 5000, "12345678901234567890 1.5e10", "a\r\nb", "!!!??? ... --- ===", "é", "   "]


def test_against_plain_version(spark, tokenize):
    made = random.Random(3)
    rows = [(n, t) for n, t in enumerate(ODD)] + [(None, "without id"), (4, "repeated id"), (4, "repeated id")]
    rows += [(100 + n, "".join(made.choice([x for x in ODD if x]) for _ in range(6))) for n in range(40)]
    docs = spark.createDataFrame([(i, 1, "x", t) for i, t in rows], "doc_id long, n_a int, pairs string, text string").repartition(3)
    got = link_statistics(docs, FIRST, SECOND)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_group_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain(rows, tokenize)
    assert link_statistics(docs.limit(0), FIRST, SECOND).count() == 0
    none = link_statistics(docs.filter("text is null"), FIRST, SECOND).collect()
    assert [tuple(r) for r in none] == [(1, 0, 0, 0, 0, 0, 0, 0, "")]


def test_whole_documents(spark, tokenize, monkeypatch):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = sorted((tuple(r) for r in link_statistics(docs, FIRST, SECOND).collect()), key=str)
    assert got == plain(rows, tokenize)


def test_links_are_the_rows_of_the_product(spark, tokenize):
    docs = spark.createDataFrame(list(enumerate(ODD)), "doc_id long, text string")
    for row in token_links(docs, FIRST, SECOND).collect():
        a, b = map(spans, tokenize(ODD[row.doc_id]))
        assert (row.a_ids, row.b_ids) == ([i for i, *_ in a], [i for i, *_ in b])
        for m, (_, x, y) in enumerate(a):
            part = slice(row.starts[m], row.starts[m + 1])
            want = [(n, min(y, v) - max(x, u)) for n, (_, u, v) in enumerate(b) if min(y, v) > max(x, u)]
            assert list(zip(row.links[part], row.bytes[part])) == want


def test_products_against_dense_ones(monkeypatch):
    made = np.random.default_rng(4)

    def sparse(dense):
        row, column = np.nonzero(dense)
        return Csr(np.searchsorted(row, np.arange(len(dense) + 1)), column, dense[row, column], dense.shape[1])

    def full(m):
        out = np.zeros((len(m), m.width), np.int64)
        np.add.at(out, (np.repeat(np.arange(len(m)), m.sizes()), m.columns), m.values)
        return out

    for most in (1, 7, 1 << 20):
        for shape in ((5, 6, 7), (1, 1, 1), (4, 0, 3), (0, 3, 2), (30, 20, 10)):
            a, b = made.integers(0, 3, shape[:2]) * made.integers(0, 2, shape[:2]), made.integers(0, 3, shape[1:])
            blocks = list(alignment.products(sparse(a), sparse(b), most))
            got = np.concatenate([full(m) for _, m in blocks]) if blocks else np.zeros((0, shape[2]), np.int64)
            assert (got == a @ b).all() and (full(product(sparse(a), sparse(b))) == a @ b).all()
            assert (full(sparse(a).transposed()) == a.T).all()


def test_cuts_and_parts_change_nothing(tokenize, monkeypatch):
    made = random.Random(6)
    words = [x for x in ODD if x] + ["ordinary words", " and", "\tmore ", "▁"]
    long = ["".join(made.choice(words) for _ in range(400)) for _ in range(3)]
    monkeypatch.setattr(alignment, "PRODUCTS", 64)
    from opsframe.llm import texts

    import pyarrow as pa

    part = texts.from_arrow(pa.array([" " + t for t in long]))
    found = alignment.aligned(part, byte_level(FIRST), sentence_pieces(SECOND))
    want = [tokenize(t) for t in long]
    assert found.a.tolist() == [i for a, _ in want for i, _ in a] and found.b.tolist() == [i for _, b in want for i, _ in b]
    n = sum(len(x) for x, *_ in found.links())
    assert n == sum(row[4] for row in plain(list(enumerate(long)), tokenize))
    digits = alignment._Digits(60_000)
    assert alignment._group_digests(found, digits) == [row[8] for row in sorted(plain(list(enumerate(long)), tokenize))]
