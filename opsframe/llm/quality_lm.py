"""Quality by perplexity: an interpolated modified Kneser-Ney model of the bytes of trusted text.

N-grams of the trusted texts are counted in Spark.  Continuation counts, context totals and probabilities come from
joins of the count tables, whose keys are dealt to shards like those of any join; the finished table is stored in order
of its contexts, and each task looks the different n-grams of some text up in it, mapped into memory and shared.  All trusted text has a part: one half of
the documents is counted whole, the other sets the thresholds.  Every document is scored whole, and each language sets
its own thresholds: one on perplexity, and one on what is left of it when n-grams that repeat nearby are counted once,
for a text that repeats ordinary words is as likely as any other to a model that looks at four bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opsframe.llm import sorted_counts, texts
from opsframe.llm.line_dedup import text_hash
from opsframe.storage import arrow_rows, cut_lineage, scratch_path

ORDER = 4
BEGIN, END = 256, 257
SYMBOLS = 258
#: N-grams that a task holds before it sums them, and passes them on where that leaves more than half.
BUFFERED_GRAMS = 1 << 19
#: Bytes of average text that a document's score is smoothed by, as the shortest texts say little.
PRIOR_BYTES = 50
#: Symbols of a text within which an n-gram that occurs again is not new.
WINDOW = 256
#: Held-out trusted documents that a language needs for a threshold of its own, and low-quality ones that are needed to
#: part them, in a language or in all.
MIN_TRUSTED = 20
#: Share of the trusted documents that a limit may cost where it parts them from low-quality ones.
MAX_LOSS = 0.02
#: Bytes of text scored at once; a longer text is scored in blocks of so many, each after the symbols before it.
SCORED_BYTES = 1 << 17
#: Documents that reach a task at once where texts are counted and scored.
BATCH_ROWS = 500


def _symbols(part: texts.Texts, begin: int, end: int, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of all texts, each after ``ORDER - 1`` begin marks and before an end mark, and where texts begin."""
    sizes = np.diff(part.offsets)
    bounds = part.offsets + np.arange(len(sizes) + 1) * ORDER
    out = np.full(int(bounds[-1]), begin, np.int64)
    text = np.repeat(np.arange(len(sizes)), sizes)
    out[np.arange(len(part.data)) + text * ORDER + ORDER - 1] = code[part.data]
    out[bounds[1:] - 1] = end
    return out, bounds


def _grams(symbols: np.ndarray, bounds: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray]:
    """The n-gram that ends at each symbol but the begin marks, and for each text where its n-grams begin."""
    found = np.zeros(len(symbols) - ORDER + 1, np.int64) if len(symbols) >= ORDER else np.zeros(0, np.int64)
    for k in range(ORDER):
        found = found * base + symbols[k : len(found) + k]
    ends = np.ones(len(symbols), bool)
    for k in range(ORDER - 1):
        ends[bounds[:-1] + k] = False
    return found[np.flatnonzero(ends) - ORDER + 1], bounds - np.arange(len(bounds)) * (ORDER - 1)


def count_grams(docs: DataFrame, text: str = "text") -> DataFrame:
    """``gram, c``: how often each n-gram of the texts occurs."""

    def counted(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        return sorted_counts.summed(*(np.concatenate(x) for x in zip(*held)))

    def sent(gram: np.ndarray, c: np.ndarray) -> pa.RecordBatch:
        return pa.record_batch([pa.array(gram, pa.int64()), pa.array(c.astype(np.int64))], names=["gram", "c"])

    def count(batches):
        held, size = [], 0
        for batch in batches:
            for _, part in texts.slices(batch, "text", SCORED_BYTES):
                symbols, bounds = _symbols(part, BEGIN, END, np.arange(256))
                held.append(sorted_counts.summed(_grams(symbols, bounds, SYMBOLS)[0]))
                size += len(held[-1][0])
                if size >= BUFFERED_GRAMS:
                    held = [counted(held)]
                    size = len(held[0][0])
                    if 2 * size > BUFFERED_GRAMS:
                        yield sent(*held[0])
                        held, size = [], 0
        if held:
            yield sent(*counted(held))

    rows = docs.select(F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(count, "gram bigint, c bigint").groupBy("gram").agg(F.sum("c").alias("c"))


def _discounts(counts: DataFrame) -> list[float]:
    """The modified discounts of n-grams seen once, twice and more often."""
    seen = {r.c: r.n for r in counts.filter("c <= 4").groupBy("c").agg(F.count(F.lit(1)).alias("n")).collect()}
    n = [max(seen.get(k, 0), 1) for k in range(1, 5)]
    y = n[0] / (n[0] + 2 * n[1])
    return [min(max(k - (k + 1) * y * n[k] / n[k - 1], 0.05), k - 0.05) for k in (1, 2, 3)]


def kneser_ney(counts: DataFrame) -> DataFrame:
    """``n, gram, logp, gamma``: probability of each n-gram of each order, and what its context leaves to lower orders.

    The highest order has counts; a lower one counts the different symbols that its n-grams follow.  The lowest
    order is interpolated with equal shares of all symbols.  ``gamma`` stands with every n-gram of a context.
    """
    by_order = {ORDER: counts}
    for n in range(ORDER - 1, 0, -1):
        shorter = by_order[n + 1].select((F.col("gram") % F.lit(SYMBOLS**n)).alias("gram"))
        by_order[n] = cut_lineage(shorter.groupBy("gram").agg(F.count(F.lit(1)).alias("c")), "continuations")
    lower, tables = None, []
    for n in range(1, ORDER + 1):
        d = _discounts(by_order[n])
        taken = F.when(F.col("c") == 1, d[0]).when(F.col("c") == 2, d[1]).otherwise(d[2])
        rows = by_order[n].select(
            "gram",
            "c",
            F.floor(F.col("gram") / SYMBOLS).alias("context"),
            (F.col("gram") % F.lit(SYMBOLS ** (n - 1))).alias("suffix"),
            taken.alias("d"),
        )
        of_context = rows.groupBy("context").agg(F.sum("c").alias("total"), F.sum("d").alias("left"))
        joined = rows.join(of_context, "context").withColumn("gamma", F.col("left") / F.col("total"))
        if lower is None:
            joined = joined.withColumn("below", F.lit(1.0 / (SYMBOLS - 1)))
        else:
            joined = joined.join(lower.select(F.col("gram").alias("suffix"), F.col("p").alias("below")), "suffix")
        p = (F.col("c") - F.col("d")) / F.col("total") + F.col("gamma") * F.col("below")
        lower = cut_lineage(joined.select("gram", p.alias("p"), "gamma"), "probabilities")
        tables.append(lower.select(F.lit(n).alias("n"), "gram", F.log10("p").alias("logp"), F.log10("gamma").alias("gamma")))
    out = tables[0]
    for table in tables[1:]:
        out = out.unionByName(table)
    return out


def store_model(model: DataFrame, uri: str) -> None:
    """Writes the table in order of its keys, in parts that no context is divided between.

    The key of an n-gram has a leading one, so that n-grams of all orders are told apart; those of one context lie
    side by side.
    """
    one = F.element_at(F.array(*(F.lit(SYMBOLS**n) for n in range(1, ORDER + 1))), F.col("n"))
    keyed = model.select((F.col("gram") + one).alias("key"), "logp", "gamma").withColumn("context", F.floor(F.col("key") / SYMBOLS))
    dealt = keyed.repartitionByRange(sorted_counts.shards_of(model.sparkSession), "context").sortWithinPartitions("key")

    def write(batches):
        held = [pa.Table.from_batches([b]) for b in batches if b.num_rows]
        if held:
            table = pa.concat_tables(held)
            first = table.column("context")[0].as_py()
            for kind, dtype in _KINDS.items():
                sorted_counts.write_file(uri, f"{first:013d}.{kind}", [table.column(kind).to_numpy().astype(dtype)])
            yield pa.record_batch([pa.array([first], pa.int64())], names=["context"])

    found = dealt.mapInArrow(write, "context bigint").collect()
    sorted_counts.write_file(uri, "contexts", [np.array(sorted(r.context for r in found), "<i8")])


_KINDS = {"key": "<i8", "logp": "<f8", "gamma": "<f8"}


class Scorer:
    """The stored table, whose parts are mapped when first needed."""

    def __init__(self, uri: str):
        self.uri, self.opened = uri, {}
        self.firsts = np.asarray(sorted_counts.map_file(uri, "contexts", "<i8"))
        symbols = np.arange(SYMBOLS)
        seen = self._looked_up(symbols + SYMBOLS, np.zeros(SYMBOLS))[1]
        seen[[BEGIN, END]] = True
        code = np.where(seen, symbols, symbols[~seen][0] if not seen.all() else 0)  # one stands for all symbols never seen
        self.code, self.begin, self.end = code[:256], BEGIN, END

    def _part(self, first: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if first not in self.opened:
            self.opened[first] = tuple(np.asarray(sorted_counts.map_file(self.uri, f"{first:013d}.{k}", t)) for k, t in _KINDS.items())
        return self.opened[first]

    def _looked_up(self, keys: np.ndarray, below: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For keys in order and what the order below says: the log10 probability, and whether the n-gram is in the table."""
        contexts = keys // SYMBOLS
        out, found = below.copy(), np.zeros(len(keys), bool)
        cuts = np.append(np.searchsorted(contexts, self.firsts), len(keys))
        for i in np.flatnonzero(np.diff(cuts)):
            some = slice(cuts[i], cuts[i + 1])
            key, logp, gamma = self._part(int(self.firsts[i]))
            at = np.searchsorted(key, keys[some])
            # Of a context that is not quite new, an n-gram lies at the place looked up or before it.
            here, before = np.minimum(at, len(key) - 1), np.maximum(at - 1, 0)
            context = key[here] // SYMBOLS == contexts[some]
            known = context | (key[before] // SYMBOLS == contexts[some])
            found[some] = hit = key[here] == keys[some]
            out[some] = np.where(hit, logp[here], np.where(known, gamma[np.where(context, here, before)], 0.0) + below[some])
        return out, found

    def _logp(self, grams: np.ndarray, order: int) -> np.ndarray:
        """The log10 probability of n-grams in order, each of them there once."""
        if order == 1:
            below = np.full(len(grams), np.log10(1.0 / (SYMBOLS - 1)))
        else:
            suffixes, which = np.unique(grams % SYMBOLS ** (order - 1), return_inverse=True)
            below = self._logp(suffixes, order - 1)[which]
        return self._looked_up(grams + SYMBOLS**order, below)[0]

    def score(self, part: texts.Texts) -> tuple[np.ndarray, np.ndarray]:
        """Number of symbols and log10 probability of each text, its end included."""
        return self.score_new(part)[:2]

    def score_new(self, part: texts.Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The same, and the log10 probability without the n-grams that stand earlier in the same window of their text."""
        if len(part) == 1 and len(part.data) > SCORED_BYTES:
            found = [self._scored(*some) for some in self._blocks(part.data)]
            return tuple(np.sum(x, axis=0) for x in zip(*found))
        symbols, bounds = _symbols(part, self.begin, self.end, self.code)
        return self._scored(symbols, bounds)

    def _blocks(self, data: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The symbols of one text in blocks, each behind the last ones of the block before; windows end where blocks do."""
        for at in range(0, len(data) + 1, SCORED_BYTES):
            before = np.full(ORDER - 1, self.begin) if not at else self.code[data[at - ORDER + 1 : at]]
            own = self.code[data[at : at + SCORED_BYTES]]
            last = [self.end] if len(own) < SCORED_BYTES else []
            symbols = np.concatenate([before, own, last]).astype(np.int64)
            yield symbols, np.array([0, len(symbols)])

    def _scored(self, symbols: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        grams, where = _grams(symbols, bounds, SYMBOLS)
        n = np.diff(where)
        in_text = np.arange(len(grams)) - np.repeat(where[:-1], n)
        windows = np.cumsum(in_text % WINDOW == 0)
        # Numbers of n-gram and place: a sort of them brings equal n-grams together, the first of each window ahead.
        bits = len(grams).bit_length()
        ordered = np.sort(grams << bits | np.arange(len(grams)))
        at, ordered = ordered & ((1 << bits) - 1), ordered >> bits
        other = np.append(True, ordered[1:] != ordered[:-1])[: len(ordered)]
        found = self._logp(ordered[other], ORDER)[np.cumsum(other) - 1]
        first = other | np.append(True, np.diff(windows[at]) != 0)[: len(ordered)]
        logp, new = np.zeros((2, len(grams)))
        logp[at], new[at] = found, np.where(first, found, 0.0)
        total, total_new = (np.concatenate([[0.0], np.cumsum(x)]) for x in (logp, new))
        return n, total[where[1:]] - total[where[:-1]], total_new[where[1:]] - total_new[where[:-1]]


def byte_scores(docs: DataFrame, uri: str, columns: list[str], text: str = "text") -> DataFrame:
    """The given columns, ``n_symbols``, ``logp`` and ``logp_new`` of every row's whole text."""
    rows = docs.select(*columns, F.col(text).cast("string").alias("_text"))
    fields = [T.StructField("n_symbols", T.LongType()), T.StructField("logp", T.DoubleType()), T.StructField("logp_new", T.DoubleType())]
    schema = T.StructType([*(rows.schema[c] for c in columns), *fields])

    def score(batches):
        scorer = None
        for batch in batches:
            for some, part in texts.slices(batch, "_text", SCORED_BYTES):
                scorer = scorer or Scorer(uri)
                n, *logs = scorer.score_new(part)
                yield pa.record_batch([*(some.column(c) for c in columns), pa.array(n, pa.int64()), *map(pa.array, logs)], names=schema.names)

    return rows.mapInArrow(score, schema)


def _limits(rows: DataFrame, share: float | None, by: list[str]) -> DataFrame:
    """For each group the ``milli`` that its documents may not pass, the ``limit``; ``rows`` say which are ``low``.

    Of the values that occur the one that parts low-quality documents from trusted ones best: where the share of the
    former above it exceeds the share of the latter most, of equal ones the largest, among those that no more than
    ``MAX_LOSS`` of the trusted ones exceed.  With a ``share``, the smallest value that covers so much of the trusted
    ones, whatever the others.  Groups of few documents have none.
    """
    low = F.sum(F.col("low").cast("long"))
    counted = rows.groupBy(*by, "milli").agg(low.alias("n_low"), (F.count(F.lit(1)) - low).alias("n"))
    upto, every = Window.partitionBy(*by).orderBy("milli"), Window.partitionBy(*by)
    sums = [F.sum(c).over(w).alias(f"{c}_{k}") for c in ("n", "n_low") for k, w in (("upto", upto), ("all", every))]
    marked = counted.select(*by, "milli", *sums).filter(F.col("n_all") >= F.lit(MIN_TRUSTED if by else 1))
    if share is not None:
        return marked.filter(F.col("n_upto") >= F.ceil(share * F.col("n_all"))).groupBy(*by).agg(F.min("milli").alias("limit"))
    enough = marked.filter((F.col("n_low_all") >= MIN_TRUSTED) & (F.col("n_upto") >= (1 - MAX_LOSS) * F.col("n_all")))
    parted = F.col("n_upto") / F.col("n_all") - F.col("n_low_upto") / F.col("n_low_all")
    return enough.groupBy(*by).agg(F.max(F.struct(parted, "milli"))["milli"].alias("limit"))


def perplexity_quality(
    docs: DataFrame,
    trusted: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    quantile: float = 0.997,
    prior_bytes: int = PRIOR_BYTES,
    low: DataFrame | None = None,
) -> DataFrame:
    """``doc_id, lang, text_hash, n_symbols, perplexity, threshold, kept`` for every row of ``docs``.

    ``trusted`` has the ids of trusted documents; half of them, by a hash of the id, train the model.  The others
    and ``low``, the ids of low-quality documents, set for each language the perplexity that a document may not pass,
    and, by those that do not, how small a share of it may be left without n-grams that repeat nearby.  Where fewer than ``MIN_TRUSTED``
    low-quality documents are known, ``quantile`` of the trusted ones stay below the one and above the other.  Perplexity is per
    byte, smoothed by ``prior_bytes`` bytes of the average of trusted text.  Languages with few held-out documents,
    and null ones, use the thresholds of all.  Without any held-out trusted document every document is kept.

    Null and empty texts have the perplexity of an end alone and are judged like others.  Repeated rows are judged
    each on their own; rows without ``doc_id`` can be no trusted ones.  An empty table gives no row.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"), F.col(lang).alias("lang"))
    rows = rows.withColumn("text_hash", text_hash(F.col("text")))
    ids = trusted.select(F.col(trusted.columns[0]).alias("doc_id")).filter("doc_id is not null").distinct()
    half = F.pmod(F.xxhash64(F.lit(18), "doc_id"), F.lit(2)) == 0
    # The ids grow with the documents: they are dealt like these, never sent to every task.
    training = rows.select("doc_id", "text").filter(half).join(ids.filter(half).hint("shuffle_hash"), "doc_id", "left_semi")
    uri = scratch_path(spark, "byte-model")
    with arrow_rows(spark, BATCH_ROWS):
        grams = cut_lineage(count_grams(training), "byte-grams")
    store_model(kneser_ney(grams), uri)
    with arrow_rows(spark, BATCH_ROWS):
        scores = cut_lineage(byte_scores(rows, uri, ["doc_id", "lang", "text_hash"]), "byte-scores")

    known = ids.filter(~half).select("doc_id", F.lit(False).alias("low"))
    if low is not None:
        poor = low.select(F.col(low.columns[0]).alias("doc_id")).filter("doc_id is not null").distinct()
        known = known.unionByName(poor.join(ids, "doc_id", "left_anti").select("doc_id", F.lit(True).alias("low")))
    known = cut_lineage(scores.join(known, "doc_id"), "held-out")
    sums = known.filter("not low").agg(*(F.sum(c) / F.sum("n_symbols") for c in ("logp", "logp_new"))).first()
    share = None if known.filter("low").count() >= MIN_TRUSTED else quantile

    def per_byte(logp: str, mean: float | None) -> Column:
        return (prior_bytes * -(mean if mean is not None else 0.0) - F.col(logp)) / (prior_bytes + F.col("n_symbols"))

    smoothed = per_byte("logp", sums[0])
    # The second is a share, so that it does not depend on how well the model knows a text; it is turned about, so that
    # what exceeds its limit goes, like with the first.
    left = F.coalesce(per_byte("logp_new", sums[1]) / F.nullif(smoothed, F.lit(0.0)), F.lit(1.0))
    milli = F.ceil(1000 * smoothed).cast("long"), -F.floor(1000 * left).cast("long")
    limits, general = known.select("lang").distinct(), []
    for k, value in enumerate(milli):
        rows = known.select("lang", "low", value.alias("milli"))
        own = cut_lineage(_limits(rows, share, ["lang"]).select("lang", F.col("limit").alias(f"own_{k}")), "thresholds")
        limits = limits.join(own, "lang", "left")
        found = _limits(rows, share, []).first()
        general.append(F.lit(found["limit"] if found else None).cast("long"))
        # Whom the first limit rejects has no say in the second.
        below = value <= F.coalesce(f"own_{k}", general[k])
        known = known.join(own, "lang", "left").filter(F.coalesce(below, F.lit(True))).drop(f"own_{k}")
    limits = cut_lineage(limits, "thresholds")
    limit, limit_new = (F.coalesce(f"own_{k}", general[k]) for k in (0, 1))
    judged = scores.join(limits, "lang", "left").select(
        "doc_id",
        "lang",
        "text_hash",
        "n_symbols",
        F.pow(F.lit(10.0), smoothed).alias("perplexity"),
        F.pow(F.lit(10.0), limit / 1000).alias("threshold"),
        F.coalesce((milli[0] <= limit) & (milli[1] <= F.coalesce(limit_new, milli[1])), F.lit(True)).alias("kept"),
    )
    return judged
