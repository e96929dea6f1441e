"""Documents whose sets of word n-grams have a Jaccard similarity of a threshold or more: a grouped prefix join.

The n-grams of a set are ordered by rarity.  Two similar sets share one of their first ``n - ceil(t n) + 1``
n-grams, their prefix; n-grams that one document alone has are shared with nothing and are left out of it.  So
most documents have an empty prefix and meet no other.

Sets that are equal form a class.  Classes of equal prefix, size and number of n-grams of their own form a group.
Groups that share an n-gram of the prefix are paired, at first each with a few of its n-grams' pivots, and pairs
whose sizes rule out the threshold are dropped.  What is left is expanded to classes and verified on whole sets.
Links join components; later steps pair only what lies in different components, so that a large group of
near copies is never written out as pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opsframe.llm import sorted_counts, texts
from opsframe.llm.components import connected_components
from opsframe.storage import cut_lineage, scratch_path

#: Bits of the hashes that n-grams are counted by; the sets themselves hold 64-bit hashes.
COUNT_BITS = 48
#: Rounds in which each n-gram offers its groups one pivot, by how many of those offered each group takes.
PIVOTS_TAKEN = [1, 8, 8]
#: Classes whose sets a task holds at once while verifying.
VERIFY_ROWS = 200


def shingle_sets(batch: texts.Texts, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of the ``n``-word windows of each text, in order, and where each text's begin.

    A text of fewer words has one, of all its words; one without words has none.
    """
    starts, ends, bounds = texts.words(batch)
    keys = texts.hashes(batch.data, starts, ends, fold=True)
    rolled, where = texts.windows(keys, bounds, n)
    sets = []
    for i in range(len(batch)):
        found = rolled[where[i] : where[i + 1]]
        size = bounds[i + 1] - bounds[i]
        if not len(found) and size:
            found, _ = texts.windows(keys[bounds[i] : bounds[i + 1]], np.array([0, size]), int(size))
        sets.append(texts.distinct(found))
    return np.concatenate(sets) if sets else rolled, np.cumsum([0, *map(len, sets)])


def _counted(docs: DataFrame, n: int) -> tuple[str, list[int]]:
    """Folder with the n-grams that two or more documents have, and the shards that are not empty."""
    spark = docs.sparkSession
    shards = sorted_counts.shards_of(spark)
    uri = scratch_path(spark, "ngram-counts")

    def count(batches):
        found = (
            shingle_sets(part, n)[0] >> np.uint64(64 - COUNT_BITS)
            for batch in batches
            for _, part in texts.slices(batch, "text")
        )
        yield from sorted_counts.blocks(found, shards, COUNT_BITS)

    def repeated(keys, counts):
        some = counts > 1
        files = [("keys", keys[some]), ("df", counts[some].astype(np.uint32))]
        return files, {"n_keys": int(some.sum())}

    rows = sorted_counts.merge_shards(
        docs.mapInArrow(count, sorted_counts.BLOCKS), uri, "shard int, n_keys bigint", repeated
    )
    return uri, [r.shard for r in rows.collect() if r.n_keys]


def _needed(size: np.ndarray | int, percent: int):
    return (percent * size + 99) // 100


def _prefix(values: np.ndarray, df: np.ndarray, percent: int) -> np.ndarray | None:
    """The n-grams of a set's prefix that other documents have as well, or None if there are none."""
    own = int((df == 0).sum())
    length = len(values) - _needed(len(values), percent) + 1
    if own >= length:
        return None
    shared = np.flatnonzero(df)
    order = np.lexsort((values[shared], df[shared]))[: length - own]
    return values[shared[order]]


def document_sets(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """``doc_id, n_shingles, own, sig, prefix, members``: sizes for all documents, the rest where the prefix is not empty.

    ``own`` counts the n-grams that no other document has, ``sig`` hashes the whole set, ``members`` holds it.
    """
    spark = docs.sparkSession
    shards = sorted_counts.shards_of(spark)
    uri, present = _counted(docs, n)
    schema = T.StructType([docs.schema["doc_id"], *T._parse_datatype_string(
        "n_shingles bigint, own bigint, sig binary, prefix array<bigint>, members binary").fields])

    def sets(batches):
        counts = sorted_counts.MappedCounts(uri, shards, COUNT_BITS, present, {"keys": "<u8", "df": "<u4"})
        for batch in batches:
            for rows, part in texts.slices(batch, "text"):
                values, bounds = shingle_sets(part, n)
                (df,) = counts.values(values >> np.uint64(64 - COUNT_BITS), "df")
                own, sig, prefix, members = [], [], [], []
                named = np.asarray(rows.column("doc_id").is_valid())
                for i in range(len(part)):
                    mine, seen = values[bounds[i] : bounds[i + 1]], df[bounds[i] : bounds[i + 1]]
                    first = _prefix(mine, seen, percent) if len(mine) and named[i] else None
                    own.append(int((seen == 0).sum()))
                    sig.append(None if first is None else xxhash.xxh3_128_digest(mine.tobytes()))
                    prefix.append(None if first is None else first.view(np.int64))
                    members.append(None if first is None else mine.tobytes())
                yield pa.record_batch(
                    [
                        rows.column("doc_id"),
                        pa.array(np.diff(bounds), pa.int64()),
                        pa.array(own, pa.int64()),
                        pa.array(sig, pa.binary()),
                        pa.array(prefix, pa.list_(pa.int64())),
                        pa.array(members, pa.binary()),
                    ],
                    names=["doc_id", "n_shingles", "own", "sig", "prefix", "members"],
                )

    return cut_lineage(docs.mapInArrow(sets, schema), "ngram-sets")


def _possible(a: str, b: str, percent: int) -> Column:
    """Whether two sets that share an n-gram can reach the threshold, if it is the first that they share.

    They need ``percent / (100 + percent)`` of their sizes in common, so not too many n-grams may come before the
    first one, in either set, and their sizes without the n-grams of their own must suffice.
    """
    n, m = F.col(f"{a}.n"), F.col(f"{b}.n")
    common = F.least(n - F.col(f"{a}.own"), m - F.col(f"{b}.own"))
    behind = F.least(n - F.col(f"{a}.pos"), m - F.col(f"{b}.pos"))
    return (percent * (n + m) <= (100 + percent) * behind) & (percent * (n + m) <= (100 + percent) * common)


def _tokens(groups: DataFrame) -> DataFrame:
    """A row for each n-gram of each group's prefix; ``pos`` counts the n-grams of the set before it."""
    each = groups.select(F.posexplode("prefix").alias("at", "token"), "node", "n", "own")
    return each.select("token", "node", "n", "own", (F.col("own") + F.col("at")).alias("pos"))


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a, b`` of classes that reach the threshold, as ``a, b, linked``."""
    left = sets.select(F.col("node").alias("a"), F.col("members").alias("of_a"))
    right = sets.select(F.col("node").alias("b"), F.col("members").alias("of_b"))
    both = pairs.join(right, "b").join(left, "a")
    schema = T.StructType([pairs.schema["a"], pairs.schema["b"], T.StructField("linked", T.BooleanType())])

    def verify(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, VERIFY_ROWS):
                batch = whole.slice(at, VERIFY_ROWS)
                linked = []
                for x, y in zip(batch.column("of_a"), batch.column("of_b")):
                    x, y = (np.frombuffer(v.as_buffer(), "<u8") for v in (x, y))
                    common = len(np.intersect1d(x, y, assume_unique=True))
                    linked.append(100 * common >= percent * (len(x) + len(y) - common))
                yield pa.record_batch(
                    [batch.column("a"), batch.column("b"), pa.array(linked, pa.bool_())], names=["a", "b", "linked"]
                )

    return cut_lineage(both.select("a", "b", "of_a", "of_b").mapInArrow(verify, schema), "verified")


def _component(rows: DataFrame, labels: DataFrame | None, node: str) -> DataFrame:
    """``rows`` with the component of ``node`` as ``comp``."""
    if labels is None:
        return rows.withColumn("comp", F.col(node))
    named = labels.select(F.col("node").alias(node), "label")
    return rows.join(named, node, "left").withColumn("comp", F.coalesce("label", node)).drop("label")


def _open_tokens(tokens: DataFrame, labels: DataFrame | None, first: Column) -> tuple[DataFrame, DataFrame]:
    """The tokens whose groups lie in several components, and these tokens with their pivots, smallest by ``first``."""
    rows = cut_lineage(_component(tokens, labels, "node"), "tokens")
    pivot = F.min(F.struct(first.alias("first"), "own", "n", "node", "comp", "pos")).alias("pivot")
    per_token = rows.groupBy("token").agg(F.min("comp").alias("low"), F.max("comp").alias("high"), pivot)
    return rows, cut_lineage(per_token.filter("low <> high").select("token", "pivot"), "pivots")


def similar_links(classes: DataFrame, percent: int) -> DataFrame | None:
    """Labels ``node, label`` of the classes that are linked with another, from ``node, n, own, prefix, members``."""
    sized = classes.select("node", "n", "own", "prefix")
    grouped = cut_lineage(
        sized.groupBy("n", "own", "prefix").agg(F.min("node").alias("node")), "groups"
    )
    group_of = sized.select("n", "own", "prefix", F.col("node").alias("member")).join(grouped, ["n", "own", "prefix"])
    others = group_of.filter("node <> member").select("node", "member", "n", "own", "prefix")
    others = cut_lineage(others, "members")

    # Members of a group with its first one; those that are not linked with it go on by themselves.
    inside = others.select(F.col("node").alias("a"), F.col("member").alias("b"))
    tested = _verified(inside, classes, percent)
    found = others.join(tested.select(F.col("b").alias("member"), "linked"), "member")
    members = cut_lineage(found.filter("linked").select("node", "member"), "members")
    alone = found.filter("not linked").select("n", "own", "prefix", F.col("member").alias("node"))
    tokens = cut_lineage(_tokens(grouped.select("n", "own", "prefix", "node").unionByName(alone)), "tokens")
    labels = None
    for nth, most in enumerate(PIVOTS_TAKEN):
        if not tested.filter("linked").isEmpty():
            labels = connected_components(tested.filter("linked"))
        # At first the set with the fewest n-grams of its own, which is the likeliest origin of copies; then any.
        rows, pivots = _open_tokens(tokens, labels, F.xxhash64("node", "token", F.lit(nth)) if nth else F.col("own"))
        if pivots.isEmpty():
            break
        offered = pivots.select("token", "pivot.*").alias("p")
        met = rows.alias("x").join(offered, F.col("x.token") == F.col("p.token"))
        met = met.filter((F.col("x.comp") != F.col("p.comp")) & _possible("x", "p", percent))
        choice = F.struct((F.xxhash64("x.node", "p.node") if nth else F.col("p.first")).alias("first"), "p.n", "p.node")
        # No more than the n-grams of a prefix; the sets not taken are met again in the last step.
        best = F.slice(F.sort_array(F.collect_set(choice)), 1, most)
        taken = met.groupBy(F.col("x.node").alias("x")).agg(best.alias("best")).select("x", F.explode("best").alias("p"))
        pairs = taken.select(F.least("x", "p.node").alias("a"), F.greatest("x", "p.node").alias("b")).distinct()
        tested = cut_lineage(tested.unionByName(_verified(pairs.join(tested, ["a", "b"], "left_anti"), classes, percent)), "tested")
    if not tested.filter("linked").isEmpty():
        labels = connected_components(tested.filter("linked"))

    # Whatever still lies in several components, expanded to all members.
    rows, pivots = _open_tokens(_expanded(tokens, members, _open_only(tokens, members, labels)), labels, F.col("own"))
    if not pivots.isEmpty():
        marked = cut_lineage(rows.join(pivots.select("token", F.col("pivot.comp").alias("main")), "token"), "open")
        x, y = marked.filter("comp <> main").alias("x"), marked.alias("y")
        met = x.join(y, F.col("x.token") == F.col("y.token")).filter(
            (F.col("x.comp") != F.col("y.comp")) & _possible("x", "y", percent)
        )
        pairs = met.select(
            F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")
        ).distinct()
        last = _verified(pairs.join(tested, ["a", "b"], "left_anti"), classes, percent)
        if not last.filter("linked").isEmpty():
            labels = connected_components(tested.unionByName(last).filter("linked"))
    return labels


def _open_only(tokens: DataFrame, members: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Tokens that occur in several components when all members of their groups are counted."""
    every = _expanded(tokens, members, None)
    rows = _component(every, labels, "node")
    spread = rows.groupBy("token").agg(F.min("comp").alias("low"), F.max("comp").alias("high"))
    return cut_lineage(spread.filter("low <> high").select("token"), "open-tokens")


def _expanded(tokens: DataFrame, members: DataFrame, only: DataFrame | None) -> DataFrame:
    """Token rows of all members of the groups, of the given tokens only."""
    kept = tokens if only is None else tokens.join(only, "token")
    others = kept.join(members, "node")
    columns = ["token", "node", "n", "own", "pos"]
    return kept.select(columns).unionByName(others.drop("node").withColumnRenamed("member", "node").select(columns))


def similar_documents(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n: int = 5, percent: int = 80
) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``docs``.

    A document's set holds its distinct runs of ``n`` words, A-Z in lower case; a shorter text has one run of all
    its words.  Documents are linked when ``100 * common >= percent * united``.  ``component_id`` is the smallest
    ``doc_id`` that links lead to, the document's own included.

    Texts without words, null ones included, have an empty set and are linked with nothing.  A row without
    ``doc_id`` gets a null component.  Rows that repeat a ``doc_id`` are documents of the same name: what one is
    linked with, the other is as well, if their sets are equal.  An empty table gives no row.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    sets = document_sets(rows, n, percent)
    some = sets.filter(F.col("sig").isNotNull())
    firsts = cut_lineage(some.groupBy("sig").agg(F.min("doc_id").alias("node")), "classes")
    # Rows that repeat the first document of a class say nothing new.
    whole = some.join(firsts.withColumnRenamed("node", "doc_id"), ["sig", "doc_id"]).dropDuplicates(["sig", "doc_id"])
    classes = whole.withColumnRenamed("doc_id", "node").select("node", F.col("n_shingles").alias("n"), "own", "prefix", "members")
    classes = cut_lineage(classes, "class-sets")
    labels = similar_links(classes, percent)
    named = cut_lineage(_component(firsts, labels, "node").select("sig", "comp"), "class-labels")
    out = sets.select("doc_id", "n_shingles", "sig").join(named, "sig", "left")
    return out.select("doc_id", "n_shingles", F.coalesce("comp", "doc_id").alias("component_id"))
