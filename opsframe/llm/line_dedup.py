"""Repeated lines: found by a range-partitioned sort of line hashes, told as compressed keep bitmaps.

DataFrame functions only; texts never pass through Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opsframe.llm.columns import let
from opsframe.storage import cut_lineage

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_BLANK = " \t\n\x0b\x0c\r"


def split_lines(text: str | Column) -> Column:
    """The ``\\n``-split lines of a text; null and empty texts are one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: str | Column) -> Column:
    """What makes two lines equal: blanks at both ends do not count, nor does the case of A-Z."""
    return F.translate(F.btrim(line, F.lit(_BLANK)), _UPPER, _UPPER.lower())


def text_hash(text: str | Column) -> Column:
    """Tells rows of one id apart."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def line_hashes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_chars: int = 1) -> DataFrame:
    """One row per line whose key has ``min_chars`` code points: ``doc_id, text_hash, n_lines, pos, h1, h2``.

    Two 64-bit hashes stand for the key.  ``text_hash`` tells rows of one ``doc_id`` apart.
    """
    lines = docs.select(
        F.col(doc_id).alias("doc_id"), text_hash(F.col(text)).alias("text_hash"), split_lines(F.col(text)).alias("lines")
    )
    each = lines.select("doc_id", "text_hash", F.size("lines").alias("n_lines"), F.posexplode("lines").alias("pos", "line"))
    keyed = each.withColumn("key", line_key(F.col("line"))).filter(F.length("key") >= min_chars)
    return keyed.select(
        "doc_id", "text_hash", "n_lines", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2")
    )


def repeated_keys(hashed: DataFrame, min_docs: int) -> DataFrame:
    """Keys found in ``min_docs`` documents: ``h1, h2, n_docs, first_doc, first_text, first_pos``.

    The hashes are range-partitioned together with the document, so the lines of a hot key lie in many
    partitions; each partition streams its rows in order and passes on the first line of a key in a document.
    These are counted before they are shuffled.
    """
    ranged = hashed.repartitionByRange("h1", "h2", "doc_id")
    in_document = Window.partitionBy("h1", "h2", "doc_id").orderBy("text_hash", "pos")
    firsts = ranged.withColumn("nth", F.row_number().over(in_document)).filter(F.col("nth") == 1)
    first = F.min(F.struct("doc_id", "text_hash", "pos"))
    counted = firsts.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n_docs"), first.alias("first"))
    return counted.filter(F.col("n_docs") >= min_docs).select(
        "h1",
        "h2",
        "n_docs",
        F.col("first.doc_id").alias("first_doc"),
        F.col("first.text_hash").alias("first_text"),
        F.col("first.pos").alias("first_pos"),
    )


def keep_runs(dropped: Column, n_lines: Column) -> Column:
    """Run lengths of a bitmap, kept and dropped lines in turn and kept ones first, from sorted dropped positions."""
    starts = F.filter(dropped, lambda p, i: (i == 0) | (F.get(dropped, i - 1) != p - 1))
    ends = F.filter(dropped, lambda p, i: (i == F.size(dropped) - 1) | (F.get(dropped, i + 1) != p + 1))
    pairs = F.arrays_zip(starts.alias("a"), ends.alias("b"))
    before = lambda i: F.coalesce(F.get(ends, i - 1) + 1, F.lit(0))
    runs = F.transform(pairs, lambda r, i: F.array(r["a"] - before(i), r["b"] - r["a"] + 1))
    return F.concat(F.flatten(runs), F.array(n_lines - F.element_at(dropped, -1) - 1))


def keep_bitmaps(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    min_docs: int = 10,
    min_chars: int = 1,
    keep_first: bool = False,
) -> DataFrame:
    """Which lines stay, for each document that loses one: ``doc_id, text_hash, n_lines, n_dropped, keep_runs``.

    Lines whose key occurs in ``min_docs`` documents go everywhere; with ``keep_first`` the first of them, by
    document and position, stays.  ``keep_runs`` is the bitmap of the document's lines as run lengths, kept
    lines first: ``[3, 2, 1]`` keeps three lines, drops two and keeps one.

    Null texts are one empty line.  All rows of a null ``doc_id`` count as one document, as do the rows of any
    other repeated ``doc_id``; equal rows share a bitmap.  An empty table gives no row.
    """
    hashed = cut_lineage(line_hashes(docs, doc_id, text, min_chars), "lines")
    repeated = cut_lineage(repeated_keys(hashed, min_docs), "repeated-lines")
    # Both sides are read from storage, so adaptive execution can split the lines of a hot key.
    hits = hashed.join(repeated, ["h1", "h2"])
    if keep_first:
        same = F.col("doc_id").eqNullSafe(F.col("first_doc")) & (F.col("text_hash") == F.col("first_text"))
        hits = hits.filter(~(same & (F.col("pos") == F.col("first_pos"))))
    grouped = hits.groupBy("doc_id", "text_hash", "n_lines").agg(F.sort_array(F.collect_set("pos")).alias("dropped"))
    return grouped.select(
        "doc_id",
        "text_hash",
        "n_lines",
        F.size("dropped").alias("n_dropped"),
        keep_runs(F.col("dropped"), F.col("n_lines")).alias("keep_runs"),
    )


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, doc_id: str = "doc_id", text: str = "text", counts: bool = True) -> DataFrame:
    """``docs`` with the kept lines as text; a text that loses no line stays as it is, null included.

    Every column and row of ``docs`` stays.  With ``counts`` two columns are added: ``lines_before`` and
    ``lines_dropped``, which ``docs`` may not have.
    """
    marks = bitmaps.select(
        F.col("doc_id").alias("_mark_doc"), F.col("text_hash").alias("_mark_text"), "n_dropped", "keep_runs"
    )
    rows = docs.select(F.struct("*").alias("_row"))
    of_row = lambda name: F.col(f"_row.`{name}`")
    same = of_row(doc_id).eqNullSafe(F.col("_mark_doc"))
    joined = rows.join(marks, same & (text_hash(of_row(text)) == F.col("_mark_text")), "left")
    mask = F.flatten(F.transform("keep_runs", lambda n, i: F.array_repeat(i % 2 == 0, n)))
    lines = split_lines(of_row(text))
    # The mask is bound: as a plain column it would be worked out again for each line.
    kept = let(mask, lambda bits: F.array_join(F.filter(lines, lambda _, i: F.get(bits, i)), "\n"))
    new = F.when(F.col("keep_runs").isNull(), of_row(text)).otherwise(kept)
    added = [F.size(lines).cast("long").alias("lines_before"), F.coalesce("n_dropped", F.lit(0)).cast("long").alias("lines_dropped")]
    return joined.select(*(new.alias(c) if c == text else of_row(c).alias(c) for c in docs.columns), *(added if counts else []))
