"""Line-based records.

Lines have the columns ``file``, ``ordinal`` (from 0), ``n_lines`` of the file
and ``line``, so that every operator here works on one row at a time.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsframe.functions.sizes import int_div

# Lines per read and pair, length of a truncated file.
READ_LINES = 4
PAIR_LINES = 8
HEAD_LINES = 20_000


def text_lines(texts: DataFrame, file: str, text: str) -> DataFrame:
    """Lines of texts that are whole within one row.

    The count is taken before the lines are generated; in the same select it
    would be taken again for every line, and each line would carry the text.
    """
    lines = F.split(text, "\n")
    n_lines = F.coalesce(F.size(lines), F.lit(0)).cast("long")
    counted = texts.select(F.col(file).alias("file"), n_lines.alias("n_lines"), text)
    return counted.select("file", "n_lines", F.posexplode(lines).alias("_pos", "line")).select(
        "file", F.col("_pos").cast("long").alias("ordinal"), "n_lines", "line"
    )


def fastq_reads(lines: DataFrame) -> DataFrame:
    """Adds the number of the read and the place of the line in it."""
    return lines.withColumn("read", int_div(F.col("ordinal"), F.lit(READ_LINES))).withColumn(
        "field", (F.col("ordinal") % READ_LINES).cast("int")
    )


def deinterleave(lines: DataFrame) -> DataFrame:
    """Lines of mate 1 and mate 2: four lines each in turn; an incomplete pair at the end is dropped."""
    complete = F.col("n_lines") - F.col("n_lines") % PAIR_LINES
    mate = F.when(F.col("ordinal") % PAIR_LINES < READ_LINES, 1).otherwise(2)
    pair = int_div(F.col("ordinal"), F.lit(PAIR_LINES))
    return lines.filter(F.col("ordinal") < complete).select(
        "file",
        mate.alias("mate"),
        (pair * READ_LINES + F.col("ordinal") % READ_LINES).alias("mate_ordinal"),
        "line",
    )


def head_lines(lines: DataFrame, n: int = HEAD_LINES) -> DataFrame:
    """The first ``n`` lines of each file."""
    return lines.filter(F.col("ordinal") < n)


def chrom_filter_gtf(lines: DataFrame, chrom: str) -> DataFrame:
    """Lines that start with the chromosome as a whole word (``chr6`` but not ``chr60`` or ``chr6_alt``)."""
    if not re.search(r"\w$", chrom):
        raise ValueError(f"chromosome must end with a letter, digit or underscore: {chrom!r}")
    return lines.filter(F.col("line").rlike(r"^\Q" + chrom + r"\E\b"))


def chrom_filter_vcf(lines: DataFrame, chrom: str) -> DataFrame:
    """Header lines, and lines whose first column is the chromosome."""
    first = F.substring_index("line", "\t", 1)
    return lines.filter(F.col("line").startswith("#") | (first == chrom))


def line_rewrite(lines: DataFrame, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """Replaces a line by the text of the first rule whose token it starts with; others pass through."""
    line = F.col("line")
    rewritten = None
    for token, text in rules:
        branch = line.startswith(token)
        rewritten = F.when(branch, F.lit(text)) if rewritten is None else rewritten.when(branch, F.lit(text))
    return lines if rewritten is None else lines.withColumn("line", rewritten.otherwise(line))
