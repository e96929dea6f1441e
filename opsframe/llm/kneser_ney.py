"""An interpolated modified Kneser-Ney model of word pairs, counted in Spark and mapped into memory by those who score.

Words are numbered by their place among the sorted hashes of all training words.  A pair of numbers is one 64-bit
number, which a bijection spreads evenly over shards, so a frequent word's pairs do not meet in one task.  Everything
that is counted is kept as sorted arrays in the shared folder: words with counts, pairs with counts, and for each word
how many pairs it begins that were seen once, twice or more often, and how many different words it follows.

The model is of order two: the pairs of a corpus already take about as much room as its text, and the hashes, counts
and contexts of longer n-grams would take a multiple of it.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opsframe.llm import sorted_counts, texts
from opsframe.storage import scratch_path

#: Stand for the begin and the end of a text among the hashes of words.
BEGIN, END = np.uint64(0x5BE0CD19137E2179), np.uint64(0x1F83D9ABFB41BD6B)
ADDED = 0.1
_U64 = np.uint64
_LOW = _U64(0xFFFFFFFF)


def unmix(x: np.ndarray) -> np.ndarray:
    """What ``texts.mix`` has made ``x`` of."""
    x = x ^ (x >> _U64(31)) ^ (x >> _U64(62))
    x = x * _U64(pow(0x94D049BB133111EB, -1, 1 << 64))
    x = x ^ (x >> _U64(27)) ^ (x >> _U64(54))
    x = x * _U64(pow(0xBF58476D1CE4E5B9, -1, 1 << 64))
    return x ^ (x >> _U64(30)) ^ (x >> _U64(60))


def tokens(part: texts.Texts) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of begin, words and end of every text, and where each text begins in these."""
    starts, ends, bounds = texts.words(part)
    keys = texts.hashes(part.data, starts, ends, fold=True)
    where = bounds + 2 * np.arange(len(bounds))
    out = np.full(int(where[-1]), BEGIN)
    of_text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    out[np.arange(len(keys)) + 2 * of_text + 1] = keys
    out[where[1:] - 1] = END
    return out, where


def _merged(blocks: list[list[np.ndarray]]) -> list[np.ndarray]:
    """Distinct keys of blocks in order, and the sums of their further columns."""
    keys = np.concatenate([b[0] for b in blocks])
    order = np.argsort(keys)
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    sums = [np.add.reduceat(np.concatenate([b[i] for b in blocks])[order], first) for i in range(1, len(blocks[0]))]
    return [keys[first], *sums]


def _gathered(batches, kinds: int = 1) -> tuple[int | None, list]:
    """The shard that a task has and, by kind, its blocks merged."""
    shard, held = None, [[] for _ in range(kinds)]
    for batch in batches:
        names = batch.schema.names
        kind_of = batch.column("kind").to_pylist() if "kind" in names else [0] * batch.num_rows
        for at, kind, block in zip(batch.column("shard").to_pylist(), kind_of, batch.column("block")):
            if shard not in (None, at):
                raise ValueError("two shards in one task")
            shard = at
            held[kind].append(sorted_counts.unpack(block.as_buffer()))
            if sum(len(b[0]) for b in held[kind][1:]) > sorted_counts.BUFFERED_KEYS:
                held[kind] = [_merged(held[kind])]
    return shard, [_merged(h) if h else None for h in held]


@dataclass(frozen=True)
class Model:
    """Where the arrays lie, the place of each shard's first word, and the totals and discounts of both orders."""

    uri: str
    firsts: tuple[int, ...]
    tokens: int
    distinct: int
    pair_discounts: tuple[float, ...]
    word_discounts: tuple[float, ...]
    pair_types: int
    word_left: float


class Words:
    """Numbers and figures of training words by hash."""

    KINDS = {"count": "<u8", "once": "<u8", "twice": "<u8", "more": "<u8", "follows": "<u8"}

    def __init__(self, uri: str, firsts: tuple[int, ...]):
        self.uri, self.firsts = uri, firsts
        self.bounds = sorted_counts.shard_bounds(len(firsts) - 1, 64)
        self.opened: dict[tuple[int, str], np.ndarray] = {}

    def array(self, shard: int, kind: str) -> np.ndarray:
        if (shard, kind) not in self.opened:
            dtype = "<u8" if kind == "keys" else self.KINDS[kind]
            self.opened[shard, kind] = sorted_counts.map_file(self.uri, f"{shard:06d}.{kind}", dtype)
        return self.opened[shard, kind]

    def find(self, keys: np.ndarray, *kinds: str) -> tuple[np.ndarray, ...]:
        """For keys in order: their numbers, or -1, and figures, or 0."""
        number = np.full(len(keys), -1)
        found = tuple(np.zeros(len(keys)) for _ in kinds)
        cuts = np.append(np.searchsorted(keys, self.bounds), len(keys))
        for shard in np.flatnonzero(np.diff(cuts)):
            known = self.firsts[shard + 1] - self.firsts[shard]
            if not known:
                continue
            there, part = self.array(int(shard), "keys"), slice(cuts[shard], cuts[shard + 1])
            at = np.searchsorted(there, keys[part])
            at[at == known] = 0
            hit = np.flatnonzero(there[at] == keys[part])
            number[part][hit] = self.firsts[shard] + at[hit]
            for values, kind in zip(found, kinds):
                values[part][hit] = self.array(int(shard), kind)[at[hit]]
        return number, *found

    def of(self, keys: np.ndarray, *kinds: str) -> tuple[np.ndarray, ...]:
        """The same for keys in any order, many of them repeated."""
        back, distinct = pd.factorize(keys)
        order = np.argsort(distinct)
        out = []
        for values in self.find(distinct[order], *kinds):
            placed = np.empty_like(values)
            placed[order] = values
            out.append(placed[back])
        return tuple(out)


def _pairs(number: np.ndarray, where: np.ndarray) -> np.ndarray:
    """The place of the second word of every pair within a text."""
    second = np.ones(len(number), bool)
    second[where[:-1]] = False
    return np.flatnonzero(second)


def _discounts(n: list[int]) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts from how many were seen once to four times."""
    n = [max(x, 1) for x in n]
    y = n[0] / (n[0] + 2 * n[1])
    return tuple(min(max(k - (k + 1) * y * n[k] / n[k - 1], 0.05), k - 0.05) for k in (1, 2, 3))


def train(docs: DataFrame) -> Model:
    """Counts the texts of ``docs(text)``; the number of shards is that of the session's shuffle partitions."""
    spark = docs.sparkSession
    shards = sorted_counts.shards_of(spark)
    uri = scratch_path(spark, "words")

    def count_words(batches):
        found = (tokens(part)[0] for batch in batches for _, part in texts.slices(batch, "text"))
        yield from sorted_counts.blocks(found, shards, 64)

    def keep_words(keys, counts):
        marks = int(counts[keys == BEGIN].sum())
        files = [("keys", keys), ("count", counts.astype("<u8"))]
        return files, {"n_keys": len(keys), "total": int(counts.sum()) - marks, "marks": int(marks > 0)}

    words = sorted_counts.merge_shards(
        docs.mapInArrow(count_words, sorted_counts.BLOCKS), uri, "shard int, n_keys bigint, total bigint, marks bigint", keep_words
    ).collect()
    sizes = {r.shard: r.n_keys for r in words}
    firsts = tuple(int(x) for x in np.concatenate([[0], np.cumsum([sizes.get(i, 0) for i in range(shards)])]))

    if firsts[-1] >> 32:
        raise ValueError(f"{firsts[-1]} distinct words do not fit the 32 bits that a pair has for each")

    def count_pairs(batches):
        vocabulary = Words(uri, firsts)

        def found():
            for batch in batches:
                for _, part in texts.slices(batch, "text"):
                    keys, where = tokens(part)
                    (number,) = vocabulary.of(keys)
                    number = number.astype(_U64)
                    second = _pairs(number, where)
                    yield texts.mix(number[second - 1] << _U64(32) | number[second])

        yield from sorted_counts.blocks(found(), shards, 64)

    def merge_pairs(batches):
        shard, (merged,) = _gathered(batches)
        if shard is None:
            return
        keys, counts = merged
        sorted_counts.write_file(uri, f"{shard:06d}.pairs", [keys])
        sorted_counts.write_file(uri, f"{shard:06d}.pair_counts", [counts.astype("<u8")])
        both = unmix(keys)
        first, second = both >> _U64(32), both & _LOW
        seen = [(counts == k).astype(_U64) for k in (1, 2, 3, 4)]
        begun = _merged([[first, *seen, (counts > 4).astype(_U64)]])
        followed = _merged([[second, np.ones(len(second), _U64)]])
        for kind, columns in enumerate((begun, followed)):
            cuts = np.searchsorted(columns[0], np.array(firsts, _U64))
            for at in np.flatnonzero(np.diff(cuts)):
                block = sorted_counts.pack([c[cuts[at] : cuts[at + 1]] for c in columns])
                yield pa.record_batch([pa.array([at], pa.int32()), pa.array([kind], pa.int32()), pa.array([block])], names=["shard", "kind", "block"])

    def merge_figures(batches):
        shard, (begun, followed) = _gathered(batches, 2)
        if shard is None:
            return
        size = firsts[shard + 1] - firsts[shard]
        place = lambda keys: (keys - _U64(firsts[shard])).astype(np.int64)
        arrays = {k: np.zeros(size, "<u8") for k in ("once", "twice", "more", "follows")}
        seen = [0] * 5
        if begun is not None:
            at = place(begun[0])
            arrays["once"][at], arrays["twice"][at], arrays["more"][at] = begun[1], begun[2], begun[3] + begun[4] + begun[5]
            seen = [int(c.sum()) for c in begun[1:]]
        if followed is not None:
            arrays["follows"][place(followed[0])] = followed[1]
        for kind, values in arrays.items():
            sorted_counts.write_file(uri, f"{shard:06d}.{kind}", [values])
        follows = arrays["follows"]
        row = [shard, *seen[:4], sum(seen), *(int((follows == k).sum()) for k in (1, 2, 3, 4)), int((follows > 0).sum())]
        yield pa.record_batch([pa.array([row[0]], pa.int32()), *(pa.array([x], pa.int64()) for x in row[1:])], names=names)

    names = ["shard", "n1", "n2", "n3", "n4", "pairs", "m1", "m2", "m3", "m4", "words"]
    pairs = docs.mapInArrow(count_pairs, sorted_counts.BLOCKS).repartitionById(shards, F.col("shard"))
    parts = pairs.mapInArrow(merge_pairs, "shard int, kind int, block binary").repartitionById(shards, F.col("shard"))
    figures = parts.mapInArrow(merge_figures, "shard int, " + ", ".join(f"{n} bigint" for n in names[1:])).collect()
    total = {n: sum(r[n] for r in figures) for n in names[1:]}
    pair_d = _discounts([total[f"n{k}"] for k in (1, 2, 3, 4)])
    word_d = _discounts([total[f"m{k}"] for k in (1, 2, 3, 4)])
    more = total["words"] - total["m1"] - total["m2"]
    left = word_d[0] * total["m1"] + word_d[1] * total["m2"] + word_d[2] * more
    return Model(
        uri,
        firsts,
        sum(r.total for r in words),
        firsts[-1] - sum(r.marks for r in words),
        pair_d,
        word_d,
        total["pairs"],
        left / total["pairs"] if total["pairs"] else 1.0,
    )


class Scorer:
    """Log10 probabilities of texts by the stored arrays."""

    def __init__(self, model: Model):
        self.model, self.words = model, Words(model.uri, model.firsts)
        self.bounds = sorted_counts.shard_bounds(len(model.firsts) - 1, 64)
        self.opened: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def _pair_counts(self, keys: np.ndarray) -> np.ndarray:
        """Counts of pairs given in order."""
        out = np.zeros(len(keys))
        cuts = np.append(np.searchsorted(keys, self.bounds), len(keys))
        for shard in np.flatnonzero(np.diff(cuts)):
            if shard not in self.opened:
                self.opened[shard] = tuple(
                    sorted_counts.map_file(self.model.uri, f"{shard:06d}.{k}", t) for k, t in (("pairs", "<u8"), ("pair_counts", "<u8"))
                )
            there, counts = self.opened[shard]
            part = slice(cuts[shard], cuts[shard + 1])
            at = np.searchsorted(there, keys[part])
            at[at == len(there)] = 0
            hit = np.flatnonzero(there[at] == keys[part])
            out[part][hit] = counts[at[hit]]
        return out

    def score(self, part: texts.Texts) -> dict[str, np.ndarray]:
        m = self.model
        keys, where = tokens(part)
        number, count, once, twice, more, follows = self.words.of(keys, *Words.KINDS)
        second = _pairs(number, where)
        bounds = where - np.arange(len(where))
        v, w = second - 1, second
        base = np.log10((count[w] + ADDED) / (m.tokens + ADDED * (m.distinct + 1)))

        off = np.array([0.0, *m.word_discounts])
        below = m.word_left / (m.distinct + 1)
        if m.pair_types:
            below = below + (follows[w] - off[np.minimum(follows[w], 3).astype(int)]) / m.pair_types
        below = np.broadcast_to(below, len(w))
        seen = np.zeros(len(w))
        both = np.flatnonzero((number[v] >= 0) & (number[w] >= 0))
        pairs = texts.mix(number[v[both]].astype(_U64) << _U64(32) | number[w[both]].astype(_U64))
        order = np.argsort(pairs)
        seen[both[order]] = self._pair_counts(pairs[order])
        off = np.array([0.0, *m.pair_discounts])
        total = np.where(count[v] > 0, count[v], 1.0)
        left = np.where(count[v] > 0, (off[1] * once[v] + off[2] * twice[v] + off[3] * more[v]) / total, 1.0)
        p = (seen - off[np.minimum(seen, 3).astype(int)]) / total + left * below

        def added(values: np.ndarray) -> np.ndarray:
            upto = np.concatenate([[0.0], np.cumsum(values)])
            return upto[bounds[1:]] - upto[bounds[:-1]]

        return {
            "n_tokens": np.diff(bounds),
            "n_known": added(count[w] > 0).astype(np.int64),
            "base_score": added(base),
            "score": added(np.log10(p)),
        }


def _remainder(doc_id: Column) -> Column:
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(10))


def language_scores(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` for every row.

    The model learns from the rows whose ``crc32`` of the id as text is not divisible by ten, and scores all.  Tokens
    are words, A-Z in lower case, and one end for each text; null and empty texts have the end alone.  ``score`` is the
    log10 probability of the text; an unknown word gets the share of one word that the model has never seen.

    A null id counts as the empty text.  Rows that repeat are learnt and scored as often as they occur.  Without any
    text to learn from all tokens are equally likely.  An empty table gives no row.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    model = train(rows.filter(_remainder(F.col("doc_id")) != 0).select("text"))
    fields = T._parse_datatype_string("n_tokens bigint, n_known bigint, base_score double, score double").fields
    schema = T.StructType([rows.schema["doc_id"], T.StructField("held_out", T.BooleanType()), *fields])

    def score(batches):
        scorer = Scorer(model)
        for batch in batches:
            for some, part in texts.slices(batch, "text"):
                found = scorer.score(part)
                columns = [some.column("doc_id"), some.column("held_out"), *(pa.array(found[f.name]) for f in fields)]
                yield pa.record_batch(columns, names=schema.names)

    marked = rows.select("doc_id", (_remainder(F.col("doc_id")) == 0).alias("held_out"), "text")
    scored = marked.mapInArrow(score, schema)
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score")
