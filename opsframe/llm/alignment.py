"""Alignment of two tokenizers by the bytes that their tokens cover.

Each tokenization of a text is an incidence matrix of tokens and bytes in compressed sparse rows.  The product A·Bᵀ,
worked out row by row as Gustavson does, holds for each token of A the tokens of B it shares bytes with and how
many: the overlap links.  Where both tokenizations end a token they cut the text into groups; the product of the
matrices of tokens and groups holds the links of tokens that share a group, of which a group has as many as the product
of its sizes, so these are given row by row on demand and counted from the row sizes alone otherwise.

A text is cut where neither tokenizer lets a token cross, and each distinct piece is encoded once per task.  The bytes
of all tokens are compared with the text, and texts that differ are encoded anew as a whole before they are given up.
"""

from __future__ import annotations

import functools
import hashlib
import os
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opsframe.llm import sorted_counts, texts
from opsframe.llm.byte_bpe import gather, pieces
from opsframe.storage import cut_lineage, scratch_path

#: Nonzero products worked out at once.
PRODUCTS = 1 << 20
#: Distinct pieces that a task keeps the codes of before it starts anew.
KEPT_PIECES = 1 << 20
#: Bytes of text, or of pairs, handled at once; one longer text is a part of its own.
SLICE_BYTES = 1 << 20
#: Pieces given to a tokenizer at once.
ENCODED = 1 << 14


@dataclass(frozen=True)
class Csr:
    """A sparse matrix: row ``i`` has ``values[at]`` in column ``columns[at]`` for ``at`` from ``starts[i]`` on."""

    starts: np.ndarray
    columns: np.ndarray
    values: np.ndarray
    width: int

    def __len__(self) -> int:
        return len(self.starts) - 1

    def sizes(self) -> np.ndarray:
        return np.diff(self.starts)

    def rows(self, begin: int, end: int) -> Csr:
        part = slice(self.starts[begin], self.starts[end])
        return Csr(self.starts[begin : end + 1] - self.starts[begin], self.columns[part], self.values[part], self.width)

    def transposed(self) -> Csr:
        order = np.argsort(self.columns, kind="stable")
        row = np.repeat(np.arange(len(self)), self.sizes())[order]
        starts = np.concatenate([[0], np.cumsum(np.bincount(self.columns, minlength=self.width))])
        return Csr(starts, row, self.values[order], len(self))


def product_sizes(a: Csr, b: Csr) -> np.ndarray:
    """For each row of ``a`` the number of products its row of a·b sums up."""
    return texts.sums(b.sizes()[a.columns], a.starts)


def products(a: Csr, b: Csr, most: int = PRODUCTS) -> Iterator[tuple[int, Csr]]:
    """The rows of a·b in blocks of about ``most`` products, each with the number of its first row.

    Row by row: each entry of a row of ``a`` brings the row of ``b`` it points at, times its value; what falls into
    one column is summed.
    """
    sizes = product_sizes(a, b)
    upto = np.concatenate([[0], np.cumsum(sizes)])
    begin = 0
    while begin < len(a):
        end = max(begin + 1, int(np.searchsorted(upto, upto[begin] + most, "right")) - 1)
        part = a.rows(begin, end)
        counts = b.sizes()[part.columns]
        columns = gather(b.columns, b.starts[part.columns], counts)
        values = np.repeat(part.values, counts) * gather(b.values, b.starts[part.columns], counts)
        row = np.repeat(np.arange(len(part)), sizes[begin:end])
        key = row * b.width + columns
        if (np.diff(key) < 0).any():
            order = np.argsort(key, kind="stable")
            key, values = key[order], values[order]
        first = np.flatnonzero(np.diff(key, prepend=-1))
        summed = np.add.reduceat(values, first) if len(first) else values
        starts = np.searchsorted(key[first], np.arange(len(part) + 1) * b.width)
        yield begin, Csr(starts, key[first] % b.width, summed, b.width)
        begin = end


def product(a: Csr, b: Csr) -> Csr:
    """a·b as a whole."""
    blocks = [block for _, block in products(a, b)]
    if not blocks:
        return Csr(np.zeros(1, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), b.width)
    starts = np.concatenate([[0], np.cumsum(np.concatenate([x.sizes() for x in blocks]))])
    return Csr(starts, *(np.concatenate([getattr(x, k) for x in blocks]) for k in ("columns", "values")), b.width)


def token_bytes(ends: np.ndarray) -> Csr:
    """Tokens by the bytes they cover, from where they end; bytes of no token may not be."""
    starts = np.concatenate([[0], ends])
    size = int(starts[-1])
    return Csr(starts, np.arange(size), np.ones(size, np.int64), size)


def token_groups(ends: np.ndarray, cuts: np.ndarray) -> Csr:
    """Tokens by the group they lie in; ``cuts`` is where groups end."""
    return Csr(np.arange(len(ends) + 1), np.searchsorted(cuts, ends), np.ones(len(ends), np.int64), len(cuts))


class Vocabulary:
    """A tokenizer for many pieces: their ids, and the bytes of each id.

    ``encode`` gives the ids of each of a list of strings that are pieces of texts without their first space.
    """

    def __init__(self, encode: Callable[[list[str]], list[list[int]]], tokens: list[bytes], cut: Callable[[texts.Texts], tuple]):
        self.encode, self.cut = encode, cut
        self.sizes = np.array([len(t) for t in tokens], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.data = np.frombuffer(b"".join(tokens), np.uint8)
        self._forget()

    def _forget(self) -> None:
        self.keys, self.counts, self.firsts, self.ids = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)

    def _codes(self, part: list[str]) -> tuple[np.ndarray, np.ndarray]:
        counts, ids = [], []
        for at in range(0, len(part), ENCODED):
            found = self.encode(part[at : at + ENCODED])
            counts += map(len, found)
            ids.append(np.fromiter((i for one in found for i in one), np.int32))
        return np.array(counts, np.int64), np.concatenate(ids) if ids else np.zeros(0, np.int32)

    def _learn(self, keys: np.ndarray, part: list[str]) -> None:
        counts, ids = self._codes(part)
        firsts = np.cumsum(counts) - counts + len(self.ids)
        at = np.searchsorted(self.keys, keys)
        self.keys, self.counts, self.firsts = (np.insert(x, at, y) for x, y in ((self.keys, keys), (self.counts, counts), (self.firsts, firsts)))
        self.ids = np.concatenate([self.ids, ids])

    def tokens(self, part: texts.Texts) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, and where each text's begin in these.  Each text starts with the space it was given."""
        starts, ends, bounds = self.cut(part)
        back, keys = pd.factorize(texts.hashes(part.data, starts, ends))
        order = np.argsort(keys)
        if len(self.keys) > KEPT_PIECES:
            self._forget()
        at = np.searchsorted(self.keys, keys[order])
        known = np.zeros(len(order), bool)
        if len(self.keys):
            known = (at < len(self.keys)) & (self.keys[np.minimum(at, len(self.keys) - 1)] == keys[order])
        new = order[~known]
        if len(new):
            first = np.empty(len(keys), np.int64)
            first[back[::-1]] = np.arange(len(back) - 1, -1, -1)
            data, begins, stops = part.data, starts[first[new]], ends[first[new]]
            self._learn(keys[new], [data[a:b].tobytes().decode() for a, b in zip(begins, stops)])
        at = np.searchsorted(self.keys, keys)[back]
        counts = self.counts[at]
        return gather(self.ids, self.firsts[at], counts), np.concatenate([[0], np.cumsum(texts.sums(counts, bounds))])

    def whole(self, text: bytes) -> np.ndarray:
        """Ids of one text that is not cut."""
        return self._codes([text.decode()])[1]

    def covers(self, ids: np.ndarray, bounds: np.ndarray, part: texts.Texts) -> np.ndarray:
        """Whether the bytes of each text's ids are those of the text."""
        wanted = np.diff(part.offsets)
        same = texts.sums(self.sizes[ids], bounds) == wanted
        owner = np.repeat(np.arange(len(part)), np.diff(bounds))
        held = same[owner]
        ids, owner = ids[held], owner[held]
        sizes = self.sizes[ids]
        at = np.concatenate([[0], np.cumsum(sizes)])
        kept = np.where(same, wanted, 0)
        # Texts of another length are left out, so each token stands so much further on in the texts.
        shift = part.offsets[:-1] - (np.cumsum(kept) - kept)
        begin = 0
        while begin < len(ids):
            end = max(begin + 1, int(np.searchsorted(at, at[begin] + PRODUCTS, "right")) - 1)
            some = slice(begin, end)
            mine = gather(self.data, self.starts[ids[some]], sizes[some])
            theirs = gather(part.data, at[:-1][some] + shift[owner[some]], sizes[some])
            wrong = np.flatnonzero(mine != theirs)
            if len(wrong):
                same[np.repeat(owner[some], sizes[some])[wrong]] = False
            begin = end
        return same


def _byte_of() -> dict[str, int]:
    """The byte that each character of a byte-level token stands for: itself if it prints, else the next from U+0100 on."""
    prints = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(prints)]
    return {chr(b): b for b in prints} | {chr(0x100 + n): b for n, b in enumerate(others)}


@functools.cache
def byte_level(path: str) -> Vocabulary:
    """A byte-level BPE of the tokenizers library; its special tokens are plain text."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task for each core
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    byte_of = _byte_of()
    names = (tokenizer.id_to_token(i) or "" for i in range(tokenizer.get_vocab_size()))
    tokens = [bytes(byte_of[c] for c in name) if set(name) <= byte_of.keys() else name.encode() for name in names]

    def encode(parts: list[str]) -> list[list[int]]:
        return [found.ids for found in tokenizer.encode_batch_fast(parts, add_special_tokens=False)]

    return Vocabulary(encode, tokens, pieces)


@functools.cache
def sentence_pieces(path: str) -> Vocabulary:
    """A sentencepiece model that puts a space before each text; texts come with that space."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    names = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    tokens = [bytes([int(name[3:5], 16)]) if model.is_byte(i) else name.replace("\u2581", " ").encode() for i, name in enumerate(names)]
    space = model.piece_to_id("\u2581")
    # Where no piece holds a space behind something else, none crosses from a word to the space behind it.
    crossing = any(re.search("[^\u2581]\u2581", name) for name in names)

    def encode(parts: list[str]) -> list[list[int]]:
        # Nothing would be put before an empty text.
        return [ids if len(part) > 1 else [space] for part, ids in zip(parts, model.encode([p[1:] for p in parts], num_threads=1))]

    def cut(part: texts.Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        begun = np.zeros(len(part.data), bool)
        if not crossing and len(begun):
            space_at = part.data == 0x20
            begun[1:] = space_at[1:] & ~space_at[:-1]
        begun[part.offsets[:-1][np.diff(part.offsets) > 0]] = True
        starts = np.flatnonzero(begun)
        return starts, np.append(starts[1:], len(part.data))[: len(starts)], np.searchsorted(starts, part.offsets)

    return Vocabulary(encode, tokens, cut)


@dataclass(frozen=True)
class Aligned:
    """The tokens of some texts, one behind the other, and the bytes at which both tokenizations end a token."""

    a: np.ndarray
    b: np.ndarray
    a_bounds: np.ndarray
    b_bounds: np.ndarray
    a_ends: np.ndarray
    b_ends: np.ndarray
    cuts: np.ndarray

    def groups(self) -> tuple[Csr, Csr]:
        return token_groups(self.a_ends, self.cuts), token_groups(self.b_ends, self.cuts)

    def links(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Places of tokens of A and B that overlap, and in how many bytes; in parts that end where a group does."""
        begin = a_from = b_from = 0
        while begin < (self.cuts[-1] if len(self.cuts) else 0):
            last = max(np.searchsorted(self.cuts, begin + PRODUCTS, "right") - 1, np.searchsorted(self.cuts, begin, "right"))
            end = self.cuts[last]
            a_to, b_to = (int(np.searchsorted(e, end, "right")) for e in (self.a_ends, self.b_ends))
            a, b = token_bytes(self.a_ends[a_from:a_to] - begin), token_bytes(self.b_ends[b_from:b_to] - begin)
            for first, block in products(a, b.transposed()):
                row = np.repeat(np.arange(len(block)), block.sizes())
                yield row + (a_from + first), block.columns + b_from, block.values
            begin, a_from, b_from = end, a_to, b_to


def aligned(part: texts.Texts, first: Vocabulary, second: Vocabulary) -> Aligned:
    """The tokens of texts that begin with a space; a text that its tokens do not spell has none."""
    (a, a_bounds), (b, b_bounds) = first.tokens(part), second.tokens(part)
    good_a, good_b = first.covers(a, a_bounds, part), second.covers(b, b_bounds, part)

    def chosen(vocabulary: Vocabulary, ids: np.ndarray, bounds: np.ndarray, good: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        again = {}
        for i in np.flatnonzero(~good):  # two pieces of one hash, or a tokenizer that changes the text
            one = texts.Texts(part.data[part.offsets[i] : part.offsets[i + 1]], part.offsets[i : i + 2] - part.offsets[i])
            whole = vocabulary.whole(one.text(0))
            good[i] = vocabulary.covers(whole, np.array([0, len(whole)]), one)[0]
            again[i] = whole
        if again:
            split = [again.get(i, ids[bounds[i] : bounds[i + 1]]) for i in range(len(part))]
            ids, bounds = np.concatenate(split), np.concatenate([[0], np.cumsum([len(x) for x in split])])
        return ids, bounds, good

    a, a_bounds, good_a = chosen(first, a, a_bounds, good_a)
    b, b_bounds, good_b = chosen(second, b, b_bounds, good_b)
    good = good_a & good_b

    def kept(ids: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sizes = np.diff(bounds)
        return ids[np.repeat(good, sizes)], np.concatenate([[0], np.cumsum(np.where(good, sizes, 0))])

    (a, a_bounds), (b, b_bounds) = kept(a, a_bounds), kept(b, b_bounds)
    a_ends, b_ends = np.cumsum(first.sizes[a]), np.cumsum(second.sizes[b])
    cuts = a_ends[b_ends[np.minimum(np.searchsorted(b_ends, a_ends), max(len(b_ends) - 1, 0))] == a_ends] if len(a) else a_ends
    return Aligned(a, b, a_bounds, b_bounds, a_ends, b_ends, cuts)


def _spaced(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, texts.Texts]]:
    """Parts of a batch and their texts with a space before each; null and empty ones stay empty."""
    text = pc.fill_null(batch.column("text").cast(pa.large_string()), "")
    text = pc.if_else(pc.equal(text, ""), "", pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), text, pa.scalar("", pa.large_string())))
    yield from texts.slices(pa.record_batch([batch.column("doc_id"), text], names=["doc_id", "text"]), "text", SLICE_BYTES)


class _Digits:
    """Ids as decimal text, many at once."""

    def __init__(self, most: int):
        self.width = len(str(most)) + 1
        named = np.array([str(i).encode() for i in range(most + 1)], f"S{self.width}")
        self.table = named.view(np.uint8).reshape(-1, self.width)
        self.sizes = (self.table != 0).sum(axis=1)

    def digests(self, ids: np.ndarray, ends: np.ndarray, bounds: np.ndarray) -> list[str]:
        """SHA-256 of each text's ids, each followed by its character of ``ends`` if that is not 0; '' without ids."""
        out, held = [""] * (len(bounds) - 1), None
        for begin in range(0, len(ids), PRODUCTS):
            some = slice(begin, begin + PRODUCTS)
            rows = self.table[ids[some]]
            rows[:, -1] = ends[some]
            flat = rows.reshape(-1)
            flat = flat[flat != 0].tobytes()
            upto = np.concatenate([[0], np.cumsum(self.sizes[ids[some]] + (ends[some] != 0))])
            end = begin + len(rows)
            first = int(np.searchsorted(bounds, begin, "right")) - 1
            for i in range(first, int(np.searchsorted(bounds, end, "left"))):
                low, high = max(int(bounds[i]), begin), min(int(bounds[i + 1]), end)
                if low >= high:
                    continue
                held = hashlib.sha256() if low == bounds[i] else held
                held.update(flat[upto[low - begin] : upto[high - begin]])
                if high == bounds[i + 1]:
                    out[i] = held.hexdigest()
        return out


def _group_digests(found: Aligned, digits: _Digits) -> list[str]:
    """SHA-256 of each text's groups as ``a1,a2|b1;a3|b2,b3``."""
    group_a, group_b = (g.columns for g in found.groups())
    many_a, many_b = (np.concatenate([[0], np.cumsum(np.bincount(g, minlength=len(found.cuts)))]) for g in (group_a, group_b))
    at_a = np.arange(len(found.a)) + many_b[group_a]
    at_b = np.arange(len(found.b)) + many_a[group_b + 1]
    ids = np.empty(len(at_a) + len(at_b), np.int64)
    ids[at_a], ids[at_b] = found.a, found.b
    ends = np.full(len(ids), ord(","), np.uint8)
    ends[at_a[many_a[1:] - 1]], ends[at_b[many_b[1:] - 1]] = ord("|"), ord(";")
    some = np.flatnonzero(np.diff(found.b_bounds))
    ends[at_b[found.b_bounds[1:][some] - 1]] = 0
    return digits.digests(ids, ends, found.a_bounds + found.b_bounds)


def token_links(docs: DataFrame, first: str, second: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The links themselves: ``doc_id, a_ids, b_ids, starts, links, bytes, a_groups, b_groups`` of every row.

    The links of A's token ``i`` are the tokens ``links[starts[i]:starts[i + 1]]`` of B, each with the ``bytes`` shared;
    the groups are each token's.  Tokens share a group where its number is the same, which says all shared-group links
    without writing them out.  Rows are treated as by ``link_statistics``.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    names = ["a_ids", "b_ids", "starts", "links", "bytes", "a_groups", "b_groups"]
    schema = T.StructType([rows.schema["doc_id"], *(T.StructField(n, T.ArrayType(T.LongType())) for n in names)])

    def run(batches) -> Iterator[pa.RecordBatch]:
        one, two = byte_level(first), sentence_pieces(second)
        for batch in batches:
            for some, part in _spaced(batch):
                for i in range(len(part)):
                    text = texts.Texts(part.data[part.offsets[i] : part.offsets[i + 1]], part.offsets[i : i + 2] - part.offsets[i])
                    found = aligned(text, one, two)
                    parts = list(found.links())
                    empty = np.zeros(0, np.int64)
                    row, column, shared = (np.concatenate(x) for x in zip(*parts)) if parts else (empty, empty, empty)
                    starts = np.searchsorted(row, np.arange(len(found.a) + 1))
                    groups = [g.columns for g in found.groups()]
                    arrays = [found.a, found.b, starts, column, shared, *groups]
                    yield pa.record_batch([some.column("doc_id").slice(i, 1), *(pa.array([x], pa.list_(pa.int64())) for x in arrays)], names=["doc_id", *names])

    return rows.mapInArrow(run, schema)


def _pair_bits(a_size: int, b_size: int) -> tuple[int, int]:
    return max(1, (a_size - 1).bit_length()), max(1, (b_size - 1).bit_length())


def _document_pairs(docs: DataFrame, first: str, second: str) -> DataFrame:
    """The figures of every row that its text alone decides, and its distinct pairs of ids with how many links hold each."""
    schema = "n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_group_links bigint, groups_sha256 string, pairs binary"
    schema = T.StructType([docs.schema["doc_id"], *T._parse_datatype_string(schema).fields])

    def run(batches) -> Iterator[pa.RecordBatch]:
        one, two = byte_level(first), sentence_pieces(second)
        a_bits, b_bits = _pair_bits(len(one.sizes), len(two.sizes))
        digits = _Digits(max(len(one.sizes), len(two.sizes)))
        for batch in batches:
            for some, part in _spaced(batch):
                found = aligned(part, one, two)
                text_of = np.repeat(np.arange(len(part)), np.diff(found.a_bounds))
                pairs, counts, n_links = [], [], np.zeros(len(part), np.int64)
                for row, column, _ in found.links():
                    pair = found.b[column].astype(np.uint64) << np.uint64(a_bits) | found.a[row].astype(np.uint64)
                    mine = text_of[row]
                    n_links += np.bincount(mine, minlength=len(part))
                    key, count = sorted_counts.summed(mine.astype(np.uint64) << np.uint64(a_bits + b_bits) | pair)
                    pairs.append(key)
                    counts.append(count)
                key, count = sorted_counts.summed(np.concatenate(pairs), np.concatenate(counts)) if pairs else (np.zeros(0, np.uint64),) * 2
                bounds = np.searchsorted(key, np.arange(len(part) + 1, dtype=np.uint64) << np.uint64(a_bits + b_bits))
                key &= np.uint64((1 << (a_bits + b_bits)) - 1)
                packed = [sorted_counts.pack([key[x:y], count[x:y]]) if x < y else b"" for x, y in zip(bounds[:-1], bounds[1:])]
                group_a, group_b = found.groups()
                ends = np.concatenate([[0], found.a_ends])[found.a_bounds]
                n_groups = np.diff(np.searchsorted(found.cuts, ends, "right"))
                n_shared = texts.sums(product_sizes(group_a, group_b.transposed()), found.a_bounds)
                figures = [np.diff(found.a_bounds), np.diff(found.b_bounds), n_groups, n_links, n_shared]
                arrays = [*(pa.array(x, pa.int64()) for x in figures), pa.array(_group_digests(found, digits), pa.string()), pa.array(packed, pa.binary())]
                yield pa.record_batch([some.column("doc_id"), *arrays], names=schema.names)

    return docs.mapInArrow(run, schema)


def _spread(pairs: np.ndarray, a_bits: int, b_bits: int) -> np.ndarray:
    """Pairs whose ids of B are dealt out evenly, by a product modulo their number; pairs of one id stay together."""
    b = (pairs >> np.uint64(a_bits)) * np.uint64(0x9E3779B1) & np.uint64((1 << b_bits) - 1)
    return b << np.uint64(a_bits) | pairs & np.uint64((1 << a_bits) - 1)


def _store_counts(paired: DataFrame, uri: str, a_bits: int, b_bits: int) -> list[int]:
    """Sums the pairs of all rows and writes, for each shard of ids of B, the pairs, their counts and which are highest."""
    bounds = sorted_counts.shard_bounds(sorted_counts.shards_of(paired.sparkSession), b_bits) << np.uint64(a_bits)

    def count(batches) -> Iterator[pa.RecordBatch]:
        def flush() -> Iterator[pa.RecordBatch]:
            keys, counts = sorted_counts.summed(np.concatenate(held[0]), np.concatenate(held[1]))
            cuts = np.append(np.searchsorted(keys, bounds), len(keys))
            for shard in np.flatnonzero(np.diff(cuts)):
                part = slice(cuts[shard], cuts[shard + 1])
                block = sorted_counts.pack([keys[part], counts[part]])
                yield pa.record_batch([pa.array([shard], pa.int32()), pa.array([block])], names=["shard", "block"])

        held, size = ([], []), 0
        for batch in batches:
            for block in batch.column("pairs"):
                if not len(block.as_buffer()):
                    continue
                keys, counts = sorted_counts.unpack(block.as_buffer())
                held[0].append(_spread(keys, a_bits, b_bits))
                held[1].append(counts)
                size += len(keys)
                if size >= sorted_counts.BUFFERED_KEYS:
                    keys, counts = sorted_counts.summed(np.concatenate(held[0]), np.concatenate(held[1]))
                    held, size = ([keys], [counts]), len(keys)
                    if 2 * size >= sorted_counts.BUFFERED_KEYS:
                        yield from flush()
                        held, size = ([], []), 0
        if size:
            yield from flush()

    def keep(keys: np.ndarray, counts: np.ndarray) -> tuple[list, dict]:
        first = np.flatnonzero(np.diff(keys >> np.uint64(a_bits), prepend=np.uint64(1 << 63)))
        most = np.repeat(np.maximum.reduceat(counts, first), np.diff(first, append=len(keys)))
        return [("keys", keys), ("n", counts.astype("<u8")), ("best", (counts == most).astype("<u1"))], {}

    stored = sorted_counts.merge_shards(paired.select("pairs").mapInArrow(count, sorted_counts.BLOCKS), uri, "shard int", keep)
    return [r["shard"] for r in stored.collect()]


def link_statistics(docs: DataFrame, first: str, second: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_group_links, n_best, count_sum, groups_sha256`` of every row.

    ``first`` is the file of a byte-level BPE, which reads a space and the text, ``second`` that of a sentencepiece
    model, which puts the space there itself.  A link is an occurrence of a token of the one and one of the other that
    share a byte, a group what lies between two bytes at which both end a token; ``n_group_links`` counts the pairs of
    tokens that share a group.  The count of a pair of ids is the number of links of all rows that hold it:
    ``count_sum`` adds it up over the links, ``n_best`` counts the links whose count is the highest that their id of
    ``second`` has anywhere.  ``groups_sha256`` hashes the groups as ``a1,a2|b1;a3|b2,b3``.

    Null and empty texts, and those that either tokenizer does not give back byte by byte, have no tokens: zeros and an
    empty text.  Repeated rows are all counted; an empty table gives no row.  Tokens of the longest text, about ten bytes
    for each of its own, have to fit a task; bytes and links are worked out in parts that end with a group.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    paired = cut_lineage(_document_pairs(rows, first, second), "pairs")
    a_bits, b_bits = _pair_bits(len(byte_level(first).sizes), len(sentence_pieces(second).sizes))
    uri, shards = scratch_path(spark, "pair-counts"), sorted_counts.shards_of(spark)
    present = _store_counts(paired, uri, a_bits, b_bits)
    schema = T.StructType([*(f for f in paired.schema if f.name not in ("groups_sha256", "pairs")), *T._parse_datatype_string("n_best bigint, count_sum bigint, groups_sha256 string").fields])

    def run(batches) -> Iterator[pa.RecordBatch]:
        counts = sorted_counts.MappedCounts(uri, shards, b_bits, present, {"keys": "<u8", "n": "<u8", "best": "<u1"})
        counts.bounds = counts.bounds << np.uint64(a_bits)
        for batch in batches:
            for some, part in texts.slices(batch, "pairs", SLICE_BYTES):
                held = [sorted_counts.unpack(part.text(i)) if part.offsets[i] < part.offsets[i + 1] else (np.zeros(0, np.uint64),) * 2 for i in range(len(part))]
                bounds = np.concatenate([[0], np.cumsum([len(k) for k, _ in held])])
                keys, times = (np.concatenate(x) for x in zip(*held))
                n, best = counts.values(_spread(keys, a_bits, b_bits), "n", "best")
                times = times.astype(np.int64)
                n_best, total = texts.sums(times * best.astype(np.int64), bounds), texts.sums(times * n.astype(np.int64), bounds)
                kept = [some.column(f) for f in schema.names[:-3]]
                yield pa.record_batch([*kept, pa.array(n_best), pa.array(total), some.column("groups_sha256")], names=schema.names)

    return paired.mapInArrow(run, schema)
