"""Test items in training text: a BM25 index of the items, searched for every passage by block-max WAND.

Scores are shares: the impact of a term in an item is divided by the item's score for its own text, so that a passage
that holds the item whole scores 1 whatever its length.  What a passage's rare terms add up to in an item, and all that
the frequent ones could add, bounds its score; only passages in which the bound of some item reaches the threshold go
through the index.  What it retrieves is verified by the runs of words of question and answer that the passage has.

The index is cut into blocks of items, which workers read from the shared folder one at a time.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opsframe.llm import sorted_counts, texts
from opsframe.storage import cut_lineage, scratch_path

K1, B = 1.2, 0.75
#: Postings under one block maximum.
POSTINGS_PER_BLOCK = 64
#: Items whose part of the index is in memory at once.
ITEMS_AT_ONCE = 4096
#: Terms in more items of a block than this count as frequent.
RARE_ITEMS = 8
#: Low bits of hashes by which words that are no term are told at once.
_SIEVE = 1 << 20


def split_answer(text: str | Column) -> tuple[Column, Column]:
    """Question and answer of items that are one text: the last sentence, or the last third of the words, answers."""
    whole = F.btrim(F.coalesce(text, F.lit("")))
    question = F.regexp_extract(whole, r"(?s)^(.*[.!?])\s+\S.*$", 1)
    words = F.split(whole, r"\s+")
    kept = F.size(words) - F.floor(F.size(words) / 3).cast("int")
    head = F.array_join(F.slice(words, F.lit(1), kept), " ")
    tail = F.array_join(F.slice(words, kept + 1, F.greatest(F.size(words) - kept, F.lit(0))), " ")
    found = question != ""
    last = F.substring(whole, F.length(question) + 1, F.length(whole))
    return F.when(found, question).otherwise(head), F.when(found, F.btrim(last, F.lit(" \n\t\r"))).otherwise(tail)


def _keys(part: texts.Texts) -> tuple[np.ndarray, np.ndarray]:
    starts, ends, bounds = texts.words(part, texts.MARKS)
    return texts.hashes(part.data, starts, ends, fold=True), bounds


def _runs(keys: np.ndarray, n: int) -> np.ndarray:
    """Distinct runs of ``n`` words, or the only run of fewer."""
    n = min(n, len(keys))
    return texts.distinct(texts.windows(keys, np.array([0, len(keys)]), n)[0]) if n else keys


def item_terms(items: DataFrame) -> DataFrame:
    """``item, n_words, term, tf`` for every distinct term of every item."""
    both = F.concat_ws("\n", F.coalesce("question", F.lit("")), F.coalesce("answer", F.lit("")))
    rows = items.select("item", both.alias("text"))

    def terms(batches):
        for batch in batches:
            for some, part in texts.slices(batch, "text"):
                keys, bounds = _keys(part)
                ids = some.column("item").to_numpy(zero_copy_only=False)
                for i in range(len(part)):
                    term, tf = np.unique(keys[bounds[i] : bounds[i + 1]], return_counts=True)
                    size = bounds[i + 1] - bounds[i]
                    columns = [np.full(len(term), ids[i]), np.full(len(term), size), term.view(np.int64), tf]
                    yield pa.record_batch([pa.array(c, pa.int64()) for c in columns], names=["item", "n_words", "term", "tf"])

    return rows.mapInArrow(terms, "item bigint, n_words bigint, term bigint, tf bigint")


@dataclass(frozen=True)
class Index:
    """Where the index lies, how many blocks of items it has and how many words its longest item."""

    uri: str
    blocks: int
    longest: int
    run: int


def numbered_items(items: DataFrame, item_id: str, question: str, answer: str) -> DataFrame:
    """``item, item_id, question, answer``: the distinct items that have an id, numbered once and for all.

    The id keeps its type.  Items of one id with different texts are items of their own.
    """
    named = items.filter(F.col(f"`{item_id}`").isNotNull()).select(
        F.col(f"`{item_id}`").alias("item_id"),
        *(F.lower(F.col(f"`{c}`")).alias(name) for c, name in ((question, "question"), (answer, "answer"))),
    )
    numbered = named.distinct().select(F.monotonically_increasing_id().alias("item"), "*")
    return cut_lineage(numbered, "items")  # written, so that the numbers stay


def build_index(once: DataFrame, run: int = 3) -> Index:
    """Writes the inverted index of numbered items, with impacts, block maxima and the runs that verify.

    Items without words are left out.
    """
    spark = once.sparkSession
    terms = cut_lineage(item_terms(once), "item-terms")
    whole = terms.select("item", "n_words").distinct().agg(F.count(F.lit(1)), F.avg("n_words"), F.max("n_words")).first()
    uri = scratch_path(spark, "bm25")
    if not whole[0]:
        return Index(uri, 0, 0, run)
    frequency = terms.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    idf = F.log(1 + (whole[0] - F.col("df") + 0.5) / (F.col("df") + 0.5))
    part = F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("n_words") / whole[1]))
    scored = terms.join(frequency, "term").select("item", "term", (idf * part).alias("score"))
    own = cut_lineage(scored.groupBy("item").agg(F.sum("score").alias("own")), "own-scores")
    # Items are numbered within blocks of their hash, so no order over all of them is needed.
    blocks = -(-whole[0] // ITEMS_AT_ONCE)
    block = F.pmod(F.xxhash64("item"), F.lit(blocks)).cast("int").alias("block")
    postings = scored.join(own, "item").select(block, "item", "term", (F.col("score") / F.col("own")).alias("impact"))
    texts_of = once.join(own, "item").select(block, "item", F.lit(None).cast("long").alias("term"), F.lit(None).cast("double").alias("impact"), "question", "answer")
    rows = postings.withColumns({"question": F.lit(None).cast("string"), "answer": F.lit(None).cast("string")}).unionByName(texts_of)
    dealt = rows.repartitionById(blocks, F.col("block")).sortWithinPartitions(F.asc_nulls_first("term"), "item")

    def write(batches):
        held = [pa.Table.from_batches([b]) for b in batches if b.num_rows]
        if not held:
            return
        table = pa.concat_tables(held)  # one block of items
        at = table.column("block")[0].as_py()
        said = table.filter(table.column("term").is_null())
        ids = said.column("item").to_numpy()
        sets = {}
        for name in ("question", "answer"):
            keys, bounds = _keys(texts.from_arrow(said.column(name)))
            found = [_runs(keys[bounds[i] : bounds[i + 1]], run) for i in range(len(ids))]
            sets[f"{name}_runs"] = np.concatenate(found)
            sets[f"{name}_sizes"] = np.minimum(np.diff(bounds), run).astype("<i8")
            sets[f"{name}_ends"] = np.cumsum([len(f) for f in found]).astype("<i8")
        listed = table.filter(table.column("term").is_valid())
        term, item = listed.column("term").to_numpy().view(np.uint64), listed.column("item").to_numpy()
        impact = listed.column("impact").to_numpy()
        place = np.argsort(ids, kind="stable")
        number = place[np.searchsorted(ids[place], item)]
        order = np.lexsort((number, term))
        term, number, impact = term[order], number[order], impact[order]
        terms_, first = np.unique(term, return_index=True)
        arrays = {"ids": ids, "terms": terms_, "firsts": np.append(first, len(term)).astype("<i8"), "items": number.astype("<i8"), "impacts": impact}
        for kind, values in (arrays | sets).items():
            sorted_counts.write_file(uri, f"{at:06d}.{kind}", [np.ascontiguousarray(values)])
        yield pa.record_batch([pa.array([at], pa.int32())], names=["block"])

    dealt.mapInArrow(write, "block int").collect()
    return Index(uri, blocks, whole[2], run)


class Passages:
    """The passages of texts: twice the longest item, each begun one such length after the last.

    So every run of words as long as an item lies in one passage whole.
    """

    def __init__(self, bounds: np.ndarray, longest: int):
        sizes = np.diff(bounds)
        self.bounds, self.longest = bounds, longest
        self.counts = np.where(sizes > 0, np.maximum(-(-sizes // longest) - 1, 1), 0)
        self.starts = np.cumsum(self.counts) - self.counts
        self.text = np.repeat(np.arange(len(sizes)), self.counts)
        self.first = bounds[self.text] + (np.arange(len(self.text)) - self.starts[self.text]) * longest
        self.end = np.minimum(self.first + 2 * longest, bounds[self.text + 1])

    def around(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The passages, one or two, that each word lies in, next to the word."""
        text = np.searchsorted(self.bounds, places, "right") - 1
        nth = (places - self.bounds[text]) // self.longest
        last = self.counts[text] - 1
        in_last = nth <= last
        before = nth > 0
        passage = np.concatenate([(self.starts[text] + nth)[in_last], (self.starts[text] + nth - 1)[before]])
        return passage, np.concatenate([places[in_last], places[before]])


class Block:
    """The index of one block of items."""

    _KINDS = {"ids": "<i8", "terms": "<u8", "firsts": "<i8", "items": "<i8", "impacts": "<f8",
              "question_runs": "<u8", "question_ends": "<i8", "question_sizes": "<i8",
              "answer_runs": "<u8", "answer_ends": "<i8", "answer_sizes": "<i8"}

    def __init__(self, uri: str, at: int):
        self.__dict__ |= {k: sorted_counts.map_file(uri, f"{at:06d}.{k}", t) for k, t in self._KINDS.items()}
        self.best = np.maximum.reduceat(self.impacts, self.firsts[:-1])
        self.sieve = np.zeros(_SIEVE, bool)
        self.sieve[self.terms & np.uint64(_SIEVE - 1)] = True
        sizes = np.diff(self.firsts)
        self.rare = sizes <= RARE_ITEMS
        frequent = np.repeat(~self.rare, sizes)
        #: What the frequent terms of an item add up to.
        self.frequent = np.bincount(self.items[frequent], self.impacts[frequent], len(self.ids))
        self.lists = [(self.items[a:b], self.impacts[a:b]) for a, b in zip(self.firsts[:-1], self.firsts[1:])]
        self.maxima = [
            np.maximum.reduceat(impacts, np.arange(0, len(impacts), POSTINGS_PER_BLOCK)) for _, impacts in self.lists
        ]

    def term_of(self, keys: np.ndarray) -> np.ndarray:
        """Number of the term of each word, or -1."""
        out = np.full(len(keys), -1)
        some = np.flatnonzero(self.sieve[keys & np.uint64(_SIEVE - 1)])
        at = np.searchsorted(self.terms, keys[some])
        at[at == len(self.terms)] = 0
        hit = self.terms[at] == keys[some]
        out[some[hit]] = at[hit]
        return out

    def runs(self, name: str, item: int) -> tuple[np.ndarray, int]:
        """The distinct runs of an item's question or answer, and of how many words they are."""
        ends = getattr(self, f"{name}_ends")
        return getattr(self, f"{name}_runs")[ends[item - 1] if item else 0 : ends[item]], int(getattr(self, f"{name}_sizes")[item])

    def possible(self, term: np.ndarray, spans: Passages, threshold: float) -> np.ndarray:
        """The passages in which some item may reach the threshold."""
        threshold *= 1 - 1e-9
        places = np.flatnonzero((term >= 0) & self.rare[term])
        passage, place = spans.around(places)
        met = np.unique(np.stack([passage, term[place]]), axis=1) if len(passage) else np.zeros((2, 0), np.int64)
        sizes = self.firsts[met[1] + 1] - self.firsts[met[1]]
        at = np.repeat(self.firsts[met[1]] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
        pair, back = np.unique(np.repeat(met[0], sizes) * len(self.ids) + self.items[at], return_inverse=True)
        bound = np.bincount(back, self.impacts[at], len(pair)) + self.frequent[pair % len(self.ids)]
        chosen = [pair[bound >= threshold] // len(self.ids)]
        for item in np.flatnonzero(self.frequent >= threshold):  # frequent terms alone may do
            own = np.zeros(len(self.terms) + 1)
            mine = np.flatnonzero(self.items == item)
            own[np.searchsorted(self.firsts, mine, "right") - 1] = self.impacts[mine]
            total = np.concatenate([[0.0], np.cumsum(own[term])])
            chosen.append(np.flatnonzero(total[spans.end] - total[spans.first] >= threshold))
        return texts.distinct(np.concatenate(chosen))

    def search(self, query: np.ndarray, threshold: float) -> list[tuple[int, float]]:
        """All items whose impacts for the distinct terms add up to the threshold, by block-max WAND.

        Lists are kept in the order of the item they stand at.  The pivot is the first item that the maxima of
        the lists up to it could lift to the threshold; if the maxima of their blocks cannot, all items up to
        the next end of a block are passed over.
        """
        lists = [[*self.lists[t], self.best[t], self.maxima[t], 0] for t in query]
        found = []
        while True:
            lists = [x for x in lists if x[4] < len(x[0])]
            lists.sort(key=lambda x: x[0][x[4]])
            bound, pivot = 0.0, -1
            for n, x in enumerate(lists):
                bound += x[2]
                if bound >= threshold:
                    pivot = n
                    break
            if pivot < 0:
                return found
            item = lists[pivot][0][lists[pivot][4]]
            while pivot + 1 < len(lists) and lists[pivot + 1][0][lists[pivot + 1][4]] == item:
                pivot += 1
            upto = lists[: pivot + 1]
            for x in upto:  # blocks are compared where the pivot would be
                x[4] += int(np.searchsorted(x[0][x[4] :], item)) if x[0][x[4]] < item else 0
            inside = [x for x in upto if x[4] < len(x[0])]
            if sum(x[3][x[4] // POSTINGS_PER_BLOCK] for x in inside) >= threshold:
                score = sum(x[1][x[4]] for x in inside if x[0][x[4]] == item)
                if score >= threshold:
                    found.append((int(item), float(score)))
                following = item + 1
            else:
                ends = [x[0][min((x[4] // POSTINGS_PER_BLOCK + 1) * POSTINGS_PER_BLOCK, len(x[0])) - 1] + 1 for x in inside]
                beyond = [x[0][x[4]] for x in lists[pivot + 1 :]]
                following = max(min([*ends, *beyond]), item + 1)
            for x in inside:
                if x[0][x[4]] < following:
                    x[4] += int(np.searchsorted(x[0][x[4] :], following))


def overlap_of(keys: np.ndarray, wanted: np.ndarray, run: int) -> float:
    """Share of the wanted runs of ``run`` words that the words have; 1 if none is wanted."""
    if not len(wanted):
        return 1.0
    return len(np.intersect1d(wanted, _runs(keys, run), assume_unique=True)) / len(wanted)


def leaked_items(
    docs: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    question: str = "question",
    answer: str = "answer",
    threshold: float = 0.6,
    overlap: float = 0.5,
    run: int = 3,
) -> DataFrame:
    """``doc_id, item_id, score, question_overlap, answer_overlap, verified`` for all that a document's passages retrieve.

    Words are runs of letters, digits and non-ASCII characters, in lower case.  An item is retrieved when a
    passage reaches ``threshold`` of the item's own BM25 score; of a document's passages the one that has most of
    question and answer counts.  It is verified when the passage has ``overlap`` of the runs of ``run`` words of the
    question, and as much of those of the answer; a part without words needs none.

    Ids of documents and items keep their types.  Items without id or without words are left out, repeated ones count
    once, and items of one id with different texts each give their rows.  Null and empty texts retrieve nothing.
    Repeated rows of ``docs`` each give their rows, rows without ``doc_id`` as well.  Without documents or items there
    is no row.  Long texts are searched whole, passage by passage; other columns are not looked at.
    """
    once = numbered_items(items, item_id, question, answer)
    index = build_index(once, run)
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.lower(F.col(f"`{text}`").cast("string")).alias("text"))
    found = T._parse_datatype_string("item bigint, score double, question_overlap double, answer_overlap double, verified boolean").fields
    schema = T.StructType([rows.schema["doc_id"], *found])

    def search(batches):
        opened: dict[int, Block] = {}

        def block_of(at: int) -> Block:
            if index.blocks > 4:  # one at a time
                return Block(index.uri, at)
            if at not in opened:
                opened[at] = Block(index.uri, at)
            return opened[at]

        for batch in batches:
            for some, part in texts.slices(batch, "text"):
                keys, bounds = _keys(part)
                spans = Passages(bounds, index.longest)
                best: dict[tuple[int, int], tuple] = {}
                for at in range(index.blocks):
                    block = block_of(at)
                    term = block.term_of(keys)
                    for n in block.possible(term, spans, threshold):
                        passage = slice(spans.first[n], spans.end[n])
                        query = texts.distinct(term[passage])
                        for item, score in block.search(query[query >= 0], threshold):
                            asked, answered = (overlap_of(keys[passage], *block.runs(p, item)) for p in ("question", "answer"))
                            key = (int(spans.text[n]), int(block.ids[item]))
                            best[key] = max(best.get(key, (-1.0,)), (min(asked, answered), score, asked, answered))
                if best:
                    order = sorted(best)
                    values = [best[k] for k in order]
                    yield pa.record_batch(
                        [
                            some.column("doc_id").take(pa.array([k[0] for k in order])),
                            pa.array([k[1] for k in order], pa.int64()),
                            *(pa.array([v[i] for v in values], pa.float64()) for i in (1, 2, 3)),
                            pa.array([v[0] >= overlap for v in values], pa.bool_()),
                        ],
                        names=schema.names,
                    )

    # What is found joins to the ids of the items alone; AQE decides how by their size.
    ids = once.select("item", "item_id")
    return rows.mapInArrow(search, schema).join(ids, "item").select("doc_id", "item_id", *schema.names[2:])
