"""Byte-level BPE: distinct words are encoded by folding ranked merges over their bytes; decoding joins binary pieces.

Texts are cut where the split pattern always ends a match, so that a cut piece gives the same matches anywhere.
Each distinct piece is encoded once, in Spark, with higher-order functions and the ranks as a scalar subquery, whose
value is no part of the plan: the text of a plan, which the driver makes anew for each stage, would hold all of them.
The codes go to sorted arrays in the shared folder, which the tasks that encode the documents map into memory: a vocabulary grows
with the corpus, so it is neither broadcast nor joined to every word of every text.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import json
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opsframe.llm import sorted_counts, texts
from opsframe.storage import scratch_path

#: Maps that the ranks are dealt to, by hash; a lookup reads one of them.
RANK_MAPS = 1 << 16
#: Longer words are merged with a heap instead of a fold, whose time is cubic in their length.
FOLD_BYTES = 64
#: Hashes of pieces that a task remembers having passed on.
REMEMBERED = 4 << 20

_ASCII_SPACE = texts.SPACE
_LETTER = np.isin(np.arange(256) | 0x20, np.arange(97, 123)) & (np.arange(256) < 128)
_MARK = np.isin(np.arange(256), list(b'!"#$%&()*+,-./:;<=>?@[\\]^_`{|}~'))
#: First bytes of characters of two or three bytes among which there is white space.
_MAYBE_SPACE = np.isin(np.arange(256), [0xC2, 0xE1, 0xE2, 0xE3])


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a file with a base64 token and a rank in each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def pieces(part: texts.Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every piece, and for each text where its pieces begin in these.

    A cut is made at a single ASCII white space between two characters that are surely none: before a space, which
    belongs to the word behind it, and around any other, which is a match of its own.  Another is made between a
    letter of A-Z, a-z or U+00C0 to U+00FF and an ASCII mark other than the apostrophe, in either order.
    """
    data, size = part.data, len(part.data)
    if not size:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(part.offsets), np.int64)
    space = _ASCII_SPACE[data]
    maybe = _MAYBE_SPACE[data]
    before = np.ones(size, bool)
    before[1:] = ~space[:-1] & ((data[:-1] < 0x80) | ~_shifted(maybe, 2)[1:] & ~_shifted(maybe, 3)[1:])
    after = np.ones(size, bool)
    after[:-1] = ~space[1:] & ~maybe[1:]
    before[part.offsets[:-1][part.offsets[:-1] < size]] = False
    after[part.offsets[1:][part.offsets[1:] > 0] - 1] = False
    alone = space & before & after
    cut = alone.copy()
    cut[1:] |= (alone & (data != 0x20))[:-1]  # behind any other white space
    cut[part.offsets[:-1][np.diff(part.offsets) > 0]] = True
    mark, letter = _MARK[data], _LETTER[data]
    accented = np.zeros(size, bool)  # where such a letter ends
    accented[1:] = (data[:-1] == 0xC3) & (data[1:] != 0x97) & (data[1:] != 0xB7)
    cut[1:] |= mark[1:] & (letter | accented)[:-1] | letter[1:] & mark[:-1]
    starts = np.flatnonzero(cut)
    ends = np.append(starts[1:], size)
    return starts, ends, np.searchsorted(starts, part.offsets)


def _shifted(flags: np.ndarray, by: int) -> np.ndarray:
    out = np.zeros(len(flags), bool)
    out[by:] = flags[:-by]
    return out


def gather(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The ranges of ``data`` one behind the other."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return data[np.repeat(starts - (ends - sizes), sizes) + np.arange(total)]


def _binary(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    sizes = ends - starts
    bounds = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.Array.from_buffers(pa.string(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(gather(data, starts, sizes))])


def _shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    return np.searchsorted(sorted_counts.shard_bounds(shards, 64), keys, "right") - 1


def distinct_pieces(docs: DataFrame, shards: int) -> DataFrame:
    """``shard, piece``: every piece that occurs, once, dealt out by the shards of its hash."""

    def find(batches):
        seen = np.zeros(0, np.uint64)
        for batch in batches:
            for _, part in texts.slices(batch, "text"):
                starts, ends, _ = pieces(part)
                codes, keys = pd.factorize(texts.hashes(part.data, starts, ends))
                first = np.empty(len(keys), np.int64)
                first[codes[::-1]] = np.arange(len(codes) - 1, -1, -1)
                order = np.argsort(keys)
                keys, first = keys[order], first[order]
                at = np.searchsorted(seen, keys)
                known = (at < len(seen)) & (seen[np.minimum(at, max(len(seen) - 1, 0))] == keys) if len(seen) else np.zeros(len(keys), bool)
                new = np.flatnonzero(~known)
                seen = keys if len(seen) > REMEMBERED else texts.distinct(np.concatenate([seen, keys]))
                if len(new):
                    found = _binary(part.data, starts[first[new]], ends[first[new]])
                    shard = pa.array(_shard_of(keys[new], shards).astype(np.int32))
                    yield pa.record_batch([shard, found], names=["shard", "piece"])

    return docs.mapInArrow(find, "shard int, piece string").repartitionById(shards, F.col("shard")).dropDuplicates(["shard", "piece"])


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once: an aggregate over nothing, which starts and finishes with it."""
    return F.aggregate(F.array().cast("array<int>"), value, lambda kept, _: kept, use)


def _joined(*arrays: Column) -> Column:
    """The arrays one behind the other."""
    return F.flatten(F.array(*arrays))


def rank_maps(spark: SparkSession, ranks: dict[bytes, int]) -> DataFrame:
    """A row with the ranks of hexadecimal bytes: maps in an array, chosen by a hash of the bytes."""
    named = spark.createDataFrame([(token.hex().upper(), rank) for token, rank in ranks.items()], "token string, rank int")
    dealt: list[dict[str, int]] = [{} for _ in range(RANK_MAPS)]
    for row in named.select("token", "rank", _rank_map(F.col("token")).alias("at")).collect():
        dealt[row["at"]][row["token"]] = row["rank"]
    listed = spark.createDataFrame([(json.dumps(dealt, separators=(",", ":")),)], "maps string")
    return listed.select(F.from_json("maps", "array<map<string,int>>").alias("maps"))


def _rank_map(token: Column) -> Column:
    return F.pmod(F.hash(token), F.lit(RANK_MAPS))


def fold_merges(word: Column, rank: Callable[[Column], Column]) -> Column:
    """Ids of the tokens of a word given as hexadecimal bytes: again and again the first pair of lowest rank merges.

    The fold carries the parts ``p`` and the ranks ``r`` of neighbours, where ``r[i]`` belongs to the parts before and
    behind place ``i``; a null at either end stands for the neighbour that is not there.  A merge looks up two ranks.
    """
    rest = F.lit(1 << 30)

    def merge(parts: Column, ranks: Column, at: Column) -> Column:
        joined = F.concat(F.get(parts, at - 2), F.get(parts, at - 1))
        left, right = rank(F.concat(F.get(parts, at - 3), joined)), rank(F.concat(joined, F.get(parts, at)))
        return F.struct(
            _joined(F.slice(parts, F.lit(1), at - 2), F.array(joined), F.slice(parts, at + 1, rest)).alias("p"),
            _joined(F.slice(ranks, F.lit(1), at - 2), F.array(left, right), F.slice(ranks, at + 2, rest)).alias("r"),
        )

    def step(state: Column, _: Column) -> Column:
        placed = F.array_min(F.transform(state["r"], lambda rank, i: F.shiftleft(rank.cast("long"), 32) + i))
        place = lambda found: found.bitwiseAND(F.lit((1 << 32) - 1)).cast("int") + 1
        return _let(placed, lambda found: F.when(found.isNull(), state).otherwise(
            _let(place(found), lambda at: merge(state["p"], state["r"], at))))

    def fold(single: Column) -> Column:
        none = F.array(F.lit(None).cast("int"))
        behind = F.slice(single, F.lit(2), rest)
        pairs = F.zip_with(F.slice(single, F.lit(1), F.size(single) - 1), behind, lambda a, b: rank(F.concat(a, b)))
        start = F.struct(single.alias("p"), _joined(none, pairs, none).alias("r"))
        return F.aggregate(F.slice(single, F.lit(2), rest), start, step, lambda state: F.transform(state["p"], rank))

    single = F.regexp_extract_all(word, F.lit(".."), F.lit(0))
    return _let(rank(word), lambda whole: F.when(whole.isNotNull(), F.array(whole)).otherwise(_let(single, fold)))


def heap_merges(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same for one long word, in time that grows little more than its length."""
    if word in ranks:
        return [ranks[word]]
    ends = list(range(1, len(word) + 1))
    prior = list(range(-1, len(word) - 1))
    heap: list[tuple[int, int, int]] = []

    def offer(at: int) -> None:
        if ends[at] < len(word):
            end = ends[ends[at]]
            rank = ranks.get(word[at:end])
            if rank is not None:
                heapq.heappush(heap, (rank, at, end))

    for at in range(len(word)):
        offer(at)
    while heap:
        _, at, end = heapq.heappop(heap)
        middle = ends[at]
        if middle < 0 or middle >= len(word) or ends[middle] != end:
            continue  # one of the two has merged since
        ends[at], ends[middle] = end, -1
        if end < len(word):
            prior[end] = at
            offer(at)
        if prior[at] >= 0:
            offer(prior[at])
    out, at = [], 0
    while at < len(word):
        out.append(ranks[word[at : ends[at]]])
        at = ends[at]
    return out


def encode_pieces(found: DataFrame, pattern: str, ranks: dict[bytes, int]) -> DataFrame:
    """``shard, piece, words, codes``: ids of the short words of each piece; those of long words are null."""
    words = F.regexp_extract_all("piece", F.lit(f"(?U){pattern}"), F.lit(0))
    short = lambda w: F.octet_length(w) <= FOLD_BYTES

    def encoded(words: Column, maps: Column) -> Column:
        rank = lambda token: F.try_element_at(F.get(maps, _rank_map(token)), token)
        codes = F.transform(words, lambda w: F.when(short(w), _let(F.hex(w), lambda h: fold_merges(h, rank))))
        return F.struct(F.filter(words, lambda w: ~short(w)).alias("long"), codes.alias("codes"))

    # The column of the maps is named once, so that Spark puts the subquery in its place and no row carries them.
    both = _let(words, lambda words: _let(F.col("maps"), lambda maps: encoded(words, maps)))
    known = found.withColumn("maps", rank_maps(found.sparkSession, ranks).scalar())
    return known.select("shard", "piece", both.alias("both")).select("shard", "piece", "both.*")


def write_codes(encoded: DataFrame, uri: str, ranks: dict[bytes, int]) -> list[int]:
    """Writes the codes of each shard as sorted arrays; returns the shards that there are."""
    sent = encoded.sparkSession.sparkContext.broadcast(ranks)

    def store(batches):
        shard, keys, sizes, ids = None, [], [], []

        def end():
            if shard is None:
                return
            key, size, code = np.concatenate(keys), np.concatenate(sizes), np.concatenate(ids)
            order = np.argsort(key)
            starts, size = (np.cumsum(size) - size)[order], size[order]
            files = (("keys", key[order]), ("ends", np.cumsum(size).astype("<u8")), ("ids", gather(code, starts, size)))
            for kind, values in files:
                sorted_counts.write_file(uri, f"{shard:06d}.{kind}", [np.ascontiguousarray(values)])
            yield pa.record_batch([pa.array([shard], pa.int32())], names=["shard"])

        for batch in batches:
            at_shard = batch.column("shard").to_numpy()
            cuts = np.flatnonzero(np.diff(at_shard)) + 1
            for begin, stop in zip([0, *cuts], [*cuts, len(at_shard)]):
                some = batch.slice(begin, stop - begin)
                if shard != at_shard[begin]:
                    yield from end()
                    shard, keys, sizes, ids = int(at_shard[begin]), [], [], []
                part = texts.from_arrow(some.column("piece"))
                keys.append(texts.hashes(part.data, part.offsets[:-1], part.offsets[1:]))
                size, code = _flat_codes(some, sent.value)
                sizes.append(size)
                ids.append(code)
        yield from end()

    rows = encoded.sortWithinPartitions("shard").select("shard", "piece", "long", "codes").mapInArrow(store, "shard int")
    return sorted(r.shard for r in rows.collect())


def _flat_codes(rows: pa.RecordBatch, ranks: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """Number of ids of each piece, and all ids."""
    words = rows.column("codes")
    if words.flatten().null_count:
        filled = []
        for codes, left in zip(words.to_pylist(), rows.column("long").to_pylist()):
            long = iter(left)
            filled.append([c if c is not None else heap_merges(next(long).encode(), ranks) for c in codes])
        words = pa.array(filled, words.type)
    inner = words.flatten()
    per_word = np.diff(np.asarray(inner.offsets))
    sizes = texts.sums(per_word, np.asarray(words.offsets) - words.offsets[0].as_py())
    return sizes, np.asarray(inner.flatten()).astype("<u4")


class Codes:
    """The stored codes of pieces by hash."""

    def __init__(self, uri: str, shards: int):
        self.uri, self.shards, self.bounds = uri, shards, sorted_counts.shard_bounds(shards, 64)
        self.opened: dict[int, tuple[np.ndarray, ...]] = {}

    def _open(self, shard: int) -> tuple[np.ndarray, ...]:
        if shard not in self.opened:
            kinds = (("keys", "<u8"), ("ends", "<u8"), ("ids", "<u4"))
            self.opened[shard] = tuple(sorted_counts.map_file(self.uri, f"{shard:06d}.{k}", t) for k, t in kinds)
        return self.opened[shard]

    def of(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of ids of each key, which are in order, and all ids."""
        sizes, out = [], []
        cuts = np.append(np.searchsorted(wanted, self.bounds), len(wanted))
        for shard in np.flatnonzero(np.diff(cuts)):
            keys, ends, ids = self._open(int(shard))
            part = wanted[cuts[shard] : cuts[shard + 1]]
            at = np.searchsorted(keys, part)
            if (at >= len(keys)).any() or (keys[np.minimum(at, len(keys) - 1)] != part).any():
                raise ValueError("a piece of a text was not encoded")
            begins = np.where(at, ends[at - 1], 0).astype(np.int64)
            sizes.append(ends[at].astype(np.int64) - begins)
            out.append(gather(ids, begins, sizes[-1]))
        empty = np.zeros(0, np.int64)
        return np.concatenate(sizes) if sizes else empty, np.concatenate(out) if out else empty.astype("<u4")


def encode(docs: DataFrame, pattern: str, ranks: dict[bytes, int], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids, ids_sha256, text`` for every row: the ids of its whole text, without special tokens.

    Each match of ``pattern`` is encoded on its own.  ``ids_sha256`` hashes the ids as little-endian unsigned 32-bit
    numbers.  Null and empty texts have no ids.  Repeated rows are each encoded; an empty table gives no row.  Pieces
    are found by 64-bit hashes, of which two may meet in a very large corpus: ``round_trip`` compares what the ids
    decode to with the text, byte by byte, and raises an error where they differ.
    """
    spark = docs.sparkSession
    shards = sorted_counts.shards_of(spark)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    uri = scratch_path(spark, "bpe-codes")
    write_codes(encode_pieces(distinct_pieces(rows.select("text"), shards), pattern, ranks), uri, ranks)
    fields = T._parse_datatype_string("n_tokens bigint, ids array<int>, ids_sha256 string, text string").fields
    schema = T.StructType([rows.schema["doc_id"], *fields])

    def run(batches) -> Iterator[pa.RecordBatch]:
        codes = Codes(uri, shards)
        for batch in batches:
            for some, part in texts.slices(batch, "text"):
                starts, ends, bounds = pieces(part)
                back, keys = pd.factorize(texts.hashes(part.data, starts, ends))
                order = np.argsort(keys)
                found, ids = codes.of(keys[order])
                sizes, firsts = np.empty_like(found), np.empty_like(found)
                sizes[order], firsts[order] = found, np.cumsum(found) - found
                flat = gather(ids, firsts[back], sizes[back])
                counts = texts.sums(sizes[back], bounds)
                cuts = np.concatenate([[0], np.cumsum(counts)])
                digests = [hashlib.sha256(flat[a:b].tobytes()).hexdigest() for a, b in zip(cuts[:-1], cuts[1:])]
                listed = pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.array(flat.astype(np.int32)))
                yield pa.record_batch(
                    [some.column("doc_id"), pa.array(counts, pa.int64()), listed, pa.array(digests, pa.string()), some.column("text")],
                    names=schema.names,
                )

    return rows.mapInArrow(run, schema)


def _hexed(ranks: dict[bytes, int]) -> str:
    """The hexadecimal bytes of all tokens by rank, as JSON."""
    hexed = [""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        hexed[rank] = token.hex()
    return json.dumps(hexed)


def _bytes_of(ids: Column, hexed: Column) -> Column:
    return F.unhex(F.array_join(F.transform(ids, lambda i: F.get(hexed, i)), ""))


def decode(ids: Column, ranks: dict[bytes, int]) -> Column:
    """The bytes that ids stand for: their binary pieces, looked up in a literal array, one behind the other."""
    return _bytes_of(ids, F.from_json(F.lit(_hexed(ranks)), "array<string>"))


def round_trip(encoded: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """The encoded rows with ``decoded`` in place of ``text``: the bytes of the ids, which have to be those of the text."""
    listed = encoded.sparkSession.createDataFrame([(_hexed(ranks),)], "hexed string")
    # As with the maps: named once, in a projection that leaves the column out.
    known = encoded.withColumn("hexed", listed.select(F.from_json("hexed", "array<string>").alias("hexed")).scalar())
    decoded = known.select(*encoded.columns, _bytes_of(F.col("ids"), F.col("hexed")).alias("decoded"))
    same = F.col("decoded") == F.coalesce(F.col("text"), F.lit("")).cast("binary")
    differs = F.raise_error(F.concat(F.lit("ids do not decode to the text of "), F.coalesce(F.col("doc_id").cast("string"), F.lit("a row without id"))))
    return decoded.withColumn("decoded", F.when(same, F.col("decoded")).otherwise(differs.cast("binary"))).drop("text")
