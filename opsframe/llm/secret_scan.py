"""Secrets in text: three fixed patterns, and long runs of characters that two Markov models tell from identifiers.

One model is trained on random strings, the other on ordinary identifiers; each knows how often a character follows
another.  A candidate is a secret where the logarithm of its likelihood ratio, the sum over its characters, passes a
threshold.  The labelled samples may be any; those of a corpus itself are what the patterns find, against all other
runs of the same documents.  The trained table has one number for each pair of characters, so it travels as a literal.

DataFrame functions only; texts never pass through Python.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opsframe.llm.columns import let
from opsframe.storage import cut_lineage

# The patterns by kind, in the order in which kinds of one start are listed.
PATTERNS = {
    "assign": r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|"""
    r"""[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    # Runs are matched whole, so the least length may stand in the pattern.
    "access": r"AKIA[A-Z0-9]{12,}+",
    "hex": r"[0-9a-f]{32,}+",
}
#: Characters that a value needs behind its name.
LEAST_VALUE = 8
#: The kind of what only the models find, and the characters it consists of.
MODEL = "model"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
KINDS = [*PATTERNS, MODEL]

#: Documents whose words and secrets train the models; those with the smallest hashes of their ids are taken.
MAX_TRAIN_DOCS = 5000
#: How much likelier a run must be as a random string than as an identifier, as a logarithm.
THRESHOLD = math.log(1e3)
LEAST_RUN = 20

_RUN = r"[A-Za-z0-9+/_=-]"
_STATES = len(ALPHABET) + 1  # the first stands for the start and any other character
_SPAN = "array<struct<start:int,kind:int,stop:int>>"
#: What every secret has; a cheap look that spares most texts the rest.
_SIGN = rf"(?i:passw|secret|token|api_?key)|AKIA[A-Z0-9]{{12}}|{_RUN}{{{LEAST_RUN}}}"


def running(values: Column, step: Callable[[Column, Column], Column], zero: Column) -> Column:
    """For each value the fold of all up to it.

    An array that grows is copied at each step, so values are folded in blocks of about the square root of their
    number, then the blocks' last values, and each block starts from what the blocks before it gave.
    """

    def folded(some: Column) -> Column:
        grown = lambda acc, x: F.concat(acc, F.array(step(F.coalesce(F.get(acc, F.size(acc) - 1), zero), x)))
        return F.aggregate(some, F.slice(F.array(zero), F.lit(1), F.lit(0)), grown)

    def joined(blocks: Column) -> Column:
        lasts = folded(F.transform(blocks, lambda b: F.element_at(b, -1)))
        add = lambda before: F.transform(blocks, lambda b, i: let(
            F.coalesce(F.get(before, i - 1), zero), lambda start: F.transform(b, lambda x: step(start, x))))
        return F.flatten(let(lasts, add))

    def cut(all_values: Column) -> Column:
        width = F.ceil(F.sqrt(F.size(all_values))).cast("int")
        starts = F.sequence(F.lit(1), F.size(all_values), width)
        blocks = F.transform(starts, lambda at: folded(F.slice(all_values, at, width)))
        return F.when(F.size(all_values) > 0, let(blocks, joined)).otherwise(F.slice(F.array(zero), F.lit(1), F.lit(0)))

    return let(values, cut)


def placed(text: Column, pattern: str) -> Column:
    """``start, stop, match`` of all matches from left to right, in code points, the end not included."""

    def of(whole: Column) -> Column:
        gaps = F.transform(F.split(text, pattern, -1), F.length)
        reach = F.zip_with(F.slice(gaps, F.lit(1), F.size(whole)), whole, lambda gap, m: gap + F.length(m))
        stops = running(reach, lambda a, b: a + b, F.lit(0))
        return F.zip_with(stops, whole, lambda stop, m: F.struct((stop - F.length(m)).alias("start"), stop.alias("stop"), m.alias("match")))

    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), of)


def _span(found: Column, kind: str) -> Column:
    return F.struct(found["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"), found["stop"].alias("stop"))


def _of_kind(text: Column, kind: str) -> Column:
    found = placed(text, PATTERNS[kind])
    if kind == "assign":  # a match that is too short is dropped, what it covers is not matched again
        value = lambda m: F.regexp_extract(m["match"], PATTERNS[kind], 1)
        found = F.filter(found, lambda m: F.length(value(m)) >= LEAST_VALUE)
    return F.transform(found, lambda m: _span(m, kind))


def base_spans(text: Column) -> Column:
    """``start, kind, stop`` of what the patterns find, by start, then kind; kinds as their places in ``KINDS``."""
    spans = F.array_sort(F.concat(*(_of_kind(text, kind) for kind in PATTERNS)))
    return F.when(text.rlike(_SIGN), spans).otherwise(F.array().cast(_SPAN))


def labelled_samples(docs: DataFrame, max_docs: int = MAX_TRAIN_DOCS) -> DataFrame:
    """``text, random``: values that the patterns find in a bounded number of documents, and the other runs there."""
    rows = docs.select("doc_id", "text").filter("doc_id is not null and text is not null")
    ids = rows.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_docs)
    # No more than max_docs ids.
    some = rows.join(F.broadcast(cut_lineage(ids, "training-ids")), "doc_id", "left_semi").select("text")
    text = F.col("text")
    found = lambda kind: F.transform(placed(text, PATTERNS[kind]), lambda m: m["match"])
    values = F.filter(F.transform(found("assign"), lambda m: F.regexp_extract(m, PATTERNS["assign"], 1)), lambda v: F.length(v) >= LEAST_VALUE)
    values = F.array_distinct(F.concat(values, found("access"), found("hex")))
    secrets = some.filter(text.rlike(_SIGN)).select(F.explode(values).alias("text"), F.lit(True).alias("random"))
    rest = F.regexp_replace(text, "|".join(f"(?:{p})" for p in PATTERNS.values()), " ")
    words = some.select(F.explode(F.regexp_extract_all(rest, F.lit(rf"{_RUN}{{4,}}+"), F.lit(0))).alias("text"), F.lit(False).alias("random"))
    return secrets.unionByName(words)


def _states(text: Column) -> Column:
    return F.transform(F.split(text, ""), lambda c: F.instr(F.lit(ALPHABET), c))


def markov_ratios(samples: DataFrame, smoothing: float = 1.0) -> list[float]:
    """The logarithm of the likelihood ratio of each character behind each other, trained on ``text, random``.

    Random strings are those of true ``random``, identifiers the others; rows of null are left out.  Every pair counts
    ``smoothing`` times besides, so without samples all ratios are 0.
    """
    held = samples.filter("text is not null and random is not null and text <> ''").groupBy("text", "random").agg(F.count(F.lit(1)).alias("n"))
    pairs = let(_states(F.col("text")), lambda s: F.zip_with(F.concat(F.array(F.lit(0)), F.slice(s, F.lit(1), F.size(s) - 1)), s, lambda a, b: a * _STATES + b))
    counted = held.select("random", "n", F.explode(pairs).alias("pair")).groupBy("random", "pair").agg(F.sum("n").alias("n"))
    counts = {False: [smoothing] * _STATES**2, True: [smoothing] * _STATES**2}
    for row in counted.collect():  # two for each pair of characters at most
        counts[row["random"]][row["pair"]] += row["n"]
    out = []
    for before in range(_STATES):
        line = slice(before * _STATES, (before + 1) * _STATES)
        totals = {kind: sum(c[line]) for kind, c in counts.items()}
        out += [math.log(r / totals[True]) - math.log(w / totals[False]) for r, w in zip(counts[True][line], counts[False][line])]
    return out


def log_ratio(run: Column, ratios: list[float]) -> Column:
    """How much likelier a run is as a random string than as an identifier, as a logarithm."""
    table = F.from_json(F.lit(str(ratios)), "array<double>")
    start = F.struct(F.lit(0).alias("before"), F.lit(0.0).alias("sum"))
    step = lambda acc, s: F.struct(s.alias("before"), (acc["sum"] + F.get(table, acc["before"] * _STATES + s)).alias("sum"))
    return F.aggregate(_states(run), start, step, lambda acc: acc["sum"])


def all_spans(text: Column, base: Column, ratios: list[float], threshold: float = THRESHOLD) -> Column:
    """``base`` and, in their order, the runs that the models call random and no span of ``base`` covers."""
    runs = placed(text, rf"{_RUN}{{{LEAST_RUN},}}+")
    likely = F.filter(runs, lambda m: m["match"].rlike("[0-9]") & m["match"].rlike("[A-Za-z]") & (log_ratio(m["match"], ratios) > threshold))
    both = F.array_sort(F.concat(base, F.transform(likely, lambda m: _span(m, MODEL))))
    model = KINDS.index(MODEL)

    def uncovered(spans: Column) -> Column:
        reach = running(F.transform(spans, lambda s: F.when(s["kind"] < model, s["stop"]).otherwise(0)), F.greatest, F.lit(0))
        return let(reach, lambda upto: F.filter(spans, lambda s, i: (s["kind"] < model) | (F.get(upto, i) < s["stop"])))

    # A span of base that starts with a run stands before it.
    return F.when(text.rlike(f"{_RUN}{{{LEAST_RUN}}}"), let(both, uncovered)).otherwise(base)


def find_secrets(docs: DataFrame, ratios: list[float], threshold: float = THRESHOLD, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, base, spans`` of every row's whole text: spans as ``kind, start, stop`` in code points, ends excluded.

    ``base`` holds what the patterns find, ``spans`` also the runs that the models call random.  A kind's spans do not
    overlap; those of different kinds may, but no span of the models lies within one of the patterns.  Null and empty
    texts have none, nor has an empty table any row.  Rows that repeat, or have no id, are each scanned.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    found = rows.withColumn("base", base_spans(F.col("text")))
    found = found.select("doc_id", "base", all_spans(F.col("text"), F.col("base"), ratios, threshold).alias("spans"))
    names = F.array(*map(F.lit, KINDS))
    named = lambda s: F.struct(F.get(names, s["kind"]).alias("kind"), s["start"].alias("start"), s["stop"].alias("stop"))
    return found.select("doc_id", *(F.transform(c, named).alias(c) for c in ("base", "spans")))


def spelled(spans: Column) -> Column:
    """Spans as ``kind:start:end``, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")
