"""Weak supervision: rules vote on documents or abstain, and what the votes agree on says how far to trust each.

Rules are pairs of conditions on counts of a text.  Their votes form patterns, of which there are at most three to the
power of the number of rules.  The patterns are counted in Spark; expectation-maximisation runs over the counts, so
it sees every document and costs the same for any number of them.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opsframe.llm import texts
from opsframe.storage import cut_lineage

GOOD, BAD, ABSTAIN = "+", "-", "0"
WINDOW = 5
_COUNTS = "n_words n_chars word_chars n_symbols n_upper n_letters n_stops n_distinct n_lines n_dup_lines n_repeat_words n_adjacent".split()

_SYMBOL = np.isin(np.arange(256), list(b"#*$%&|<>"))
_UPPER = (np.arange(256) >= 65) & (np.arange(256) <= 90)
_LETTER = np.zeros(256, bool)  # letters and digits; of a longer character its first byte counts
_LETTER[[*range(48, 58), *range(65, 91), *range(97, 123), *range(0xC0, 256)]] = True
_STOP = np.isin(np.arange(256), list(b".,;:?"))
_FIRST_BYTE = (np.arange(256) & 0xC0) != 0x80


def count_texts(part: texts.Texts) -> dict[str, np.ndarray]:
    """The counts of each text that rules look at."""
    data = part.data
    starts, ends, bounds = texts.words(part)
    inside = ~texts.SPACE[data]
    keys = texts.hashes(data, starts, ends)
    folded = texts.hashes(data, starts, ends, fold=True)

    firsts, where = texts.window_starts(bounds, WINDOW)
    covered = np.zeros(len(keys) + 1, np.int64)
    if len(firsts):
        runs = texts.per_text(texts.windows(keys, bounds, WINDOW)[0], where)
        _, nth, found = np.unique(runs, return_inverse=True, return_counts=True)
        again = firsts[found[nth] > 1]
        np.add.at(covered, again, 1)
        np.add.at(covered, again + WINDOW, -1)
    adjacent = np.zeros(len(keys), bool)
    adjacent[1:] = folded[1:] == folded[:-1]
    adjacent[bounds[:-1][np.diff(bounds) > 0]] = False  # the first word of a text

    _, first = np.unique(texts.per_text(folded, bounds), return_index=True)
    distinct = np.zeros(len(keys), bool)
    distinct[first] = True

    line_starts, line_ends, line_bounds = texts.lines(part)
    total = np.concatenate([[0], np.cumsum(inside)])
    worded = total[line_ends] > total[line_starts]
    lines = np.searchsorted(np.flatnonzero(worded), line_bounds)
    line_keys = texts.per_text(texts.hashes(data, line_starts[worded], line_ends[worded]), lines)
    _, first = np.unique(line_keys, return_index=True)
    is_first = np.zeros(len(line_keys), bool)
    is_first[first] = True

    by_byte = lambda flags: texts.sums(flags, part.offsets)
    return {
        "n_words": np.diff(bounds),
        "n_chars": by_byte(_FIRST_BYTE[data]),
        "word_chars": by_byte(_FIRST_BYTE[data] & inside),
        "n_symbols": by_byte(_SYMBOL[data]),
        "n_upper": by_byte(_UPPER[data]),
        "n_letters": by_byte(_LETTER[data]),
        "n_stops": texts.sums(_STOP[data[ends - 1]], bounds),
        "n_distinct": texts.sums(distinct, bounds),
        "n_lines": np.diff(lines),
        "n_dup_lines": texts.sums(~is_first, lines),
        "n_repeat_words": texts.sums(np.cumsum(covered[:-1]) > 0, bounds),
        "n_adjacent": texts.sums(adjacent, bounds),
    }


def document_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id`` and the counts of its whole text for every row; null texts count as empty."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    schema = T.StructType([rows.schema["doc_id"], *(T.StructField(c, T.LongType()) for c in _COUNTS)])

    def count(batches):
        for batch in batches:
            for some, part in texts.slices(batch, "text"):
                found = count_texts(part)
                columns = [some.column("doc_id"), *(pa.array(found[c].astype(np.int64)) for c in _COUNTS)]
                yield pa.record_batch(columns, names=["doc_id", *_COUNTS])

    return rows.mapInArrow(count, schema)


@dataclass(frozen=True)
class Rule:
    """Votes against a document where ``bad`` holds, for it where ``good`` holds, if it has that, and else abstains."""

    name: str
    bad: Callable[[], Column]
    good: Callable[[], Column] | None = None

    def vote(self) -> Column:
        against = F.when(self.bad(), BAD)
        return (against.when(self.good(), GOOD) if self.good else against).otherwise(ABSTAIN)


def _above(name: str, part: str, of: str, share: float) -> Rule:
    """Votes against texts with more than a share of ``part`` in ``of``; less of it is no merit."""
    return Rule(name, lambda: F.col(part) > share * F.col(of))


RULES = [
    _above("symbols", "n_symbols", "n_words", 0.1),
    Rule(
        "letters",
        lambda: F.col("n_letters") < 0.88 * F.col("word_chars"),
        lambda: F.col("n_letters") >= 0.94 * F.col("word_chars"),
    ),
    Rule(
        "stops",
        lambda: (F.col("n_stops") < 0.04 * F.col("n_words")) & (F.col("n_words") >= 30),
        lambda: F.col("n_stops").between(0.07 * F.col("n_words"), 0.3 * F.col("n_words")),
    ),
    _above("upper case", "n_upper", "word_chars", 0.3),
    _above("repeated runs", "n_repeat_words", "n_words", 0.2),
    _above("repeated lines", "n_dup_lines", "n_lines", 0.4),
    _above("repeated words", "n_adjacent", "n_words", 0.25),
    Rule("few words", lambda: F.col("n_distinct") < 0.3 * F.least(F.col("n_words"), F.lit(400))),
    Rule(
        "word length",
        lambda: ~F.col("word_chars").between(3 * F.col("n_words"), 7.5 * F.col("n_words")),
        lambda: F.col("word_chars").between(4 * F.col("n_words"), 6 * F.col("n_words")),
    ),
]


@dataclass(frozen=True)
class Model:
    """Share of good documents, and the probability of a vote against and for by class (bad, good) and rule.

    That a rule abstains says nothing, so a document without votes has the share of good documents as its quality.
    """

    prior: float
    votes: np.ndarray

    def posterior(self, patterns: list[str]) -> np.ndarray:
        """Probability of a good document for each pattern of votes."""
        logs = np.log(self.votes)
        odds = np.full(len(patterns), np.log(self.prior / (1 - self.prior)))
        for i, pattern in enumerate(patterns):
            for rule, vote in enumerate(pattern):
                if vote != ABSTAIN:
                    odds[i] += logs[1, rule, _KINDS.index(vote)] - logs[0, rule, _KINDS.index(vote)]
        return 1 / (1 + np.exp(np.clip(-odds, -700, 700)))


_KINDS = BAD + GOOD


def fit(patterns: list[str], counts: list[int], prior: float = 0.85, least_right: float = 0.8, rounds: int = 200) -> Model:
    """Expectation-maximisation over patterns of votes: the share of good documents, and how rules vote on good and bad.

    ``prior`` is the share that it starts from; each step estimates it again from all documents.  For the share, unlike
    for a document, it counts that rules abstain: else it would sink wherever few rules vote.

    Rules are taken to be right in ``least_right`` of their votes against and for: of the votes that a step ascribes
    to the wrong class, what exceeds the rest is ascribed to the right one.  Without this bound the classes would
    part along whatever rules go together most, as faults of different kinds seldom meet in one text.
    Every vote, and a document of either class, counts once more than it was seen.  It stops when no probability moves.
    """
    n_rules = len(patterns[0]) if patterns else 0
    start = np.array([[0.4, 0.4], [0.02, 0.7]])
    model = Model(prior, np.repeat(start[:, None, :], n_rules, axis=1))
    if not patterns:
        return model
    seen = np.array([[[vote == kind for kind in _KINDS] for vote in pattern] for pattern in patterns], float)
    weights = np.array(counts, float)
    for _ in range(rounds):
        good = model.posterior(patterns)
        by_class = np.stack([(1 - good) * weights, good * weights])
        votes = np.einsum("cp,prk->crk", by_class, seen)
        for kind, right in ((_KINDS.index(BAD), 0), (_KINDS.index(GOOD), 1)):
            total = votes[:, :, kind].sum(axis=0)
            wrong = np.minimum(votes[1 - right, :, kind], (1 - least_right) * total)
            votes[1 - right, :, kind], votes[right, :, kind] = wrong, total - wrong
        sizes = by_class.sum(axis=1)
        votes = np.minimum((votes + 1) / (sizes[:, None, None] + 2), 1)
        silent = np.log(np.maximum(1 - votes.sum(axis=2), 1e-6))
        logs = np.einsum("prk,crk->cp", seen, np.log(votes)) + np.einsum("pr,cr->cp", 1 - seen.sum(axis=2), silent)
        odds = np.log(model.prior / (1 - model.prior)) + logs[1] - logs[0]
        share = float((weights @ (1 / (1 + np.exp(np.clip(-odds, -700, 700)))) + 1) / (weights.sum() + 2))
        moved = max(abs(share - model.prior), float(np.abs(votes - model.votes).max()))
        model = Model(share, votes)
        if moved < 1e-9:
            break
    return model


def rule_quality(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    rules: list[Rule] | None = None,
    threshold: float = 0.5,
    prior: float = 0.85,
) -> DataFrame:
    """``doc_id``, the counts, ``base_failed``, ``votes``, ``quality`` and ``kept`` for every row.

    ``quality`` is the posterior probability of a good document; their share is estimated from all rows, starting from
    ``prior``.  A document is kept if it reaches ``threshold`` and does not fail the base rule: fewer than ten words, or
    more than a fifth of its words in runs of five that occur twice or more.  Null and empty texts have no words and
    fail.  Rows that repeat are judged each on their own.  At most twelve rules, so that patterns fit the driver.
    """
    rules = RULES if rules is None else rules
    if len(rules) > 12:
        raise ValueError("more than twelve rules")
    few, repeated = F.col("n_words") < 10, 100 * F.col("n_repeat_words") > 20 * F.col("n_words")
    voted = document_counts(docs, doc_id, text).select(
        "*", (few | repeated).alias("base_failed"), F.concat(*(rule.vote() for rule in rules)).alias("votes")
    )
    voted = cut_lineage(voted, "rule-votes")
    patterns = sorted((r["votes"], r["count"]) for r in voted.groupBy("votes").count().collect())
    names = [p for p, _ in patterns]
    model = fit(names, [c for _, c in patterns], prior)
    judged = [(p, float(q)) for p, q in zip(names, model.posterior(names))]
    table = docs.sparkSession.createDataFrame(judged, "votes string, quality double")
    return voted.join(F.broadcast(table), "votes").withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= threshold))
